"""Small inputs with known answers."""

CLICKS = [
    ("Mary", "./home", 1000), ("Alice", "./cart", 2000), ("Bob", "./prod?id=100", 3000),
    ("Bob", "./cart", 4000), ("Bob", "./home", 5000), ("Mary", "./home", 6000),
    ("Bob", "./cart", 7000), ("Bob", "./home", 8000), ("Bob", "./prod?id=10", 9000),
]
WORDS = ["ajisfo dfafdf fdja", "ajisfo dfaji ffdkha", "hello world", "hello flink", "hello spark"]
WORD_COUNTS = {
    "ajisfo": 2, "dfafdf": 1, "fdja": 1, "dfaji": 1, "ffdkha": 1, "hello": 3, "world": 1, "flink": 1, "spark": 1,
}
EVENTS = [
    ("Mary", "./home", 1000), ("Bob", "./cart", 2000), ("Mary", "./cart", 4000),
    ("Bob", "./home", 5000), ("Bob", "./cart", 2000), ("Bob", "./cart", 6000),
]
SENSORS = [("s1", 1, 1), ("s1", 1, 11), ("s2", 2, 2), ("s4", 3, 3), ("s1", 9, 5)]
LATE1 = [("Mary", "./home", t) for t in range(9000, 0, -1000)]
LATE2 = [("Mary", "./home", 1684768325249 - k * 1000) for k in range(1, 9)]


def clicks(spark, rows):
    from pyspark.sql import functions as F

    from streamloom.schemas import CLICK
    from streamloom.sources.collection import from_rows

    return from_rows(spark, rows, CLICK).withColumn("ts", F.timestamp_millis("timestamp"))


def one_file_per_row(path, rows):
    """Text files whose names and times keep the arrival order."""
    import os

    path.mkdir(parents=True, exist_ok=True)
    for i, row in enumerate(rows):
        name = path / f"{i:05d}.csv"
        name.write_text(",".join(map(str, row)) + "\n")
        os.utime(name, (1_700_000_000 + i, 1_700_000_000 + i))
    return str(path)
