"""Insert or update by key, audit stamps, and the check that makes an upsert well defined."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.schemas import AUDIT, Table
from tillhouse.session import let_go, settle, shuffles_dropped
from tillhouse.sources.tables import DuplicateKeys, TableStore


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def require_unique(df: DataFrame, keys: list[str]) -> None:
    with shuffles_dropped(df.sparkSession):
        worst = duplicate_keys(df, keys).limit(1).collect()
    if worst:
        raise DuplicateKeys(f"more than one source row for {worst[0].asDict()}")


def upsert(target: DataFrame, source: DataFrame, keys: list[str], now: Column | datetime | None = None) -> DataFrame:
    """``target`` after each source row was inserted, or had replaced the row with its key.

    A source row is taken whole, so a NULL in it replaces a value. Columns the source lacks keep the
    target's value. With ``now``, new rows get both audit stamps and changed rows only the second.

    The source decides the cost: while it is small Spark broadcasts it, and the target is only streamed past it and never
    shuffled. A large source costs one shuffle of the target, and where columns are kept another one of its keys.
    """
    source = source.select([c for c in target.columns if c in source.columns and c not in AUDIT])
    kept = [c for c in target.columns if c not in source.columns]
    if not kept:
        return target.join(source.select(*keys), keys, "left_anti").unionByName(source)
    if now is not None:
        now = (now if isinstance(now, Column) else F.lit(now)).cast("timestamp")
    new = source.select(*keys, F.struct(F.lit(True).alias("_is_new"), *[c for c in source.columns if c not in keys]).alias("_new"))
    changed, inserted = [], []
    for name in target.columns:
        if name in keys:
            changed.append(F.col(name))
            inserted.append(F.col(name))
        elif name in kept:
            stamped = name in AUDIT and now is not None
            changed.append(F.when(F.col("_new").isNotNull(), now).otherwise(F.col(name)).alias(name)
                           if stamped and name == "modified_at" else F.col(name))
            inserted.append((now if stamped else F.lit(None).cast(target.schema[name].dataType)).alias(name))
        else:
            changed.append(F.when(F.col("_new").isNotNull(), F.col(f"_new.{name}")).otherwise(F.col(name)).alias(name))
            inserted.append(F.col(name))
    fresh = source.join(target.select(*keys), keys, "left_anti").select(inserted)
    return target.join(new, keys, "left").select(changed).unionByName(fresh)


def stamp(df: DataFrame, now: Column | datetime) -> DataFrame:
    """Audit stamps of newly inserted rows: one moment for the whole batch."""
    now = (now if isinstance(now, Column) else F.lit(now)).cast("timestamp")
    return df.withColumns({name: now for name in AUDIT})


def remove_from(store: TableStore, table: Table, keys: DataFrame) -> int:
    """Take the rows with these keys out of a stored table; only partitions that hold one are written again. Returns the number of rows
    that were found. The keys are read several times: pass stored rows."""
    name, key = table.name, list(table.key)
    wanted = keys.select(*key).distinct()
    found = settle(store.scan(name).join(wanted, key, "left_semi").select(*dict.fromkeys([*key, *store.split_columns(name)])))
    parts = store.parts_of(name, found)
    n = found.count()
    if n:
        store.replace_parts(name, store.within(name, parts).join(wanted, key, "left_anti"), parts)
    return n


def merge_into(store: TableStore, table: Table, source: DataFrame, now: datetime | None = None,
               checked: bool = False, spent: tuple[DataFrame, ...] = ()) -> int:
    """Upsert ``source`` into a stored table and return the number of rows that the written partitions hold. ``spent`` are settled frames that
    nothing but the source reads: they are deleted as soon as the change is computed.

    Only the partitions that hold or get a row of the source are read and written again. ``checked`` says that the
    source's keys are known to be unique. The source is read several times: pass stored rows.
    """
    name, keys = table.name, list(table.key)
    if not checked:
        require_unique(source, keys)
    source = store.split(name, source)
    columns, moving = store.split_columns(name), store.moving.get(name, [])
    parts = store.parts_of(name, source)
    if not (parts if columns else source.take(1)):
        let_go(*spent)
        return 0
    if store.scan(name).isEmpty():  # nothing to keep or to replace, so nothing that is read is overwritten
        empty = store.spark.createDataFrame([], store.scan(name).schema)
        written = store.append(name, upsert(empty, source, keys, now), checked=True)
        let_go(*spent)
        return written
    if moving:  # a row may lie in another partition than the one it goes to
        fixed = [c for c in columns if c not in moving]
        near = store.within(name, store.parts_of(name, source, fixed), fixed)
        parts = sorted({*parts, *store.parts_of(name, near.join(source.select(*keys), keys, "left_semi"))})
    return store.replace_parts(name, upsert(store.within(name, parts), source, keys, now), parts, spent)
