"""Tables that are stored dealt by key, so that joins and groups on the key need no shuffle.

Spark keeps the number of buckets and the key of such a table in its session catalog, not in the files: ``write_bucketed`` enters it, ``open_bucketed`` enters
one that an earlier session wrote. Tables that are to be joined in place need the same number of buckets. A bucket is one task of such a join,
so the number is chosen for the table's size at the time it matters, some hundred megabytes a bucket; a hot key is one bucket, for
which the plain join with its run-time split is the better way.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def write_bucketed(df: DataFrame, folder: str, keys: list[str], buckets: int) -> DataFrame:
    """Store ``df`` in ``folder`` with one sorted file per bucket, by one shuffle, and return the stored rows."""
    name = f"bucketed_{uuid.uuid4().hex}"
    (df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).format("parquet")
     .option("path", folder).saveAsTable(name))
    return df.sparkSession.table(name)


def open_bucketed(spark: SparkSession, folder: str, schema: T.StructType, keys: list[str], buckets: int) -> DataFrame:
    """The rows of a folder that ``write_bucketed`` filled with the same keys and number of buckets."""
    name = f"bucketed_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    listed = ", ".join(f"`{k}`" for k in keys)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({listed}) SORTED BY ({listed}) INTO {int(buckets)} BUCKETS "
              f"LOCATION '{folder}'")
    return spark.table(name)
