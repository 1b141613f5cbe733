"""Key rules over dense whole-number keys by bitmaps.

A bit stands for a key. Each task turns its keys into bitmaps of 32,768 keys, so that at most 4 KB per range and task are shuffled, however many
rows there are, where comparing the keys themselves moves each of them. Meant for generated keys, which lie
close together; sparse keys are better counted by ``duplicate_keys``. NULL keys have no bit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_bits(df: DataFrame, key: str) -> DataFrame:
    """(bucket, bits, rows): which keys of each range occur, and how many rows have one of them."""
    number = F.col(key).cast("long")
    return df.where(number.isNotNull()).groupBy(F.bitmap_bucket_number(number).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits"), F.count("*").alias("rows"))


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """(rows, keys, surplus): rows with a key, different keys, and rows beyond the first of their key."""
    found = key_bits(df, key).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("keys"))
    return found.withColumn("surplus", F.col("rows") - F.col("keys"))


def orphan_keys(df: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """(orphans): different references without a parent, the bits that the parents lack."""
    child = key_bits(df, key).select("bucket", "bits", F.lit(0).cast("long").alias("parents"))
    known = key_bits(parent, parent_key).select("bucket", "bits", F.bitmap_count("bits").alias("parents"))
    both = child.unionByName(known).groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("either"), F.sum("parents").alias("parents"))
    lost = both.agg(F.coalesce(F.sum(F.bitmap_count("either") - F.col("parents")), F.lit(0)).alias("orphans"))
    return lost


def compare_keys(df: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """(rule, violations): surplus rows per key of ``parent`` and references of ``df`` without a parent."""
    twice = key_counts(parent, parent_key).select(F.lit("unique key").alias("rule"), F.col("surplus").alias("violations"))
    lost = orphan_keys(df, key, parent, parent_key).select(F.lit("reference").alias("rule"), F.col("orphans").alias("violations"))
    return twice.unionByName(lost)
