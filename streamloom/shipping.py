"""Send functions to executors by value, so the package need not be installed there."""

from __future__ import annotations

import sys

from pyspark import cloudpickle


def ship_by_value(module_name: str) -> None:
    """Call with ``__name__`` in a module whose functions or classes run inside tasks."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])
