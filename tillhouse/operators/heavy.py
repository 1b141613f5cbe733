"""Finding the keys that hold very many rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key with fewer rows than this is left whole.
LEAST = 1_000_000


def heavy_keys(df: DataFrame, keys: list[str], least: int = LEAST) -> DataFrame:
    """All keys with more than ``least`` rows, and the number of ``pieces`` each should be split into. One narrow count
    with map-side partial counts; the result has less than one row per ``least`` rows of the input, which bounds its broadcast: 16
    bytes per million rows.
    """
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > least)
    return counts.select(*keys, F.ceil(F.col("_n") / least).cast("int").alias("pieces"))
