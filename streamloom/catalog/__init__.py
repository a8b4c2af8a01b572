"""Every operator as a named query over the analytic tables, with the SQL it must agree with."""

from streamloom.catalog.registry import ORACLES, QUERIES  # noqa: F401
from streamloom.catalog import aggregates, joins, pipelines, projections, state_streams, streams, texts, versioned, windows  # noqa: F401
