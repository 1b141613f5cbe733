"""Scalar expressions; every one is a built-in Spark expression, none is a UDF."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.schemas import CARD_RANGE


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def moment(text: str | datetime) -> Column:
    """Timestamp without zone."""
    return F.lit(str(text)).cast(T.TimestampNTZType())


def in_window(c: Column | str, start, end) -> Column:
    """Both ends belong to the window, so a row on a shared boundary is in both neighbours."""
    return col_of(c).between(_bound(start), _bound(end))


def _bound(value) -> Column:
    return value if isinstance(value, Column) else moment(value)


def date_parts(c: Column | str) -> dict[str, Column]:
    """Calendar parts of a timestamp. The weekday is 1 for Monday to 7 for Sunday. The second is
    the fractional second rounded half to even, so 59.5 and above give 60."""
    c = col_of(c)
    return {
        "year": F.year(c),
        "month": F.month(c),
        "day": F.dayofmonth(c),
        "day_of_week": (F.weekday(c) + 1).cast("int"),
        "hour": F.hour(c),
        "minute": F.minute(c),
        "second": F.bround(F.extract(F.lit("SECOND"), c), 0).cast("int"),
    }


def with_date_parts(df: DataFrame, c: str) -> DataFrame:
    return df.withColumns(date_parts(c))


def null_literal(c: Column | str) -> Column:
    """Text ``NULL`` for a NULL, else the value as quoted text with inner quotes doubled."""
    c = col_of(c)
    text = F.replace(c.cast("string"), F.lit("'"), F.lit("''"))
    return F.when(c.isNull(), F.lit("NULL")).otherwise(F.concat(F.lit("'"), text, F.lit("'")))


def comma_list(*cols: Column | str) -> Column:
    """Values joined by a comma; a NULL is left out."""
    return F.concat_ws(", ", *[col_of(c).cast("string") for c in cols])


def row_literal(*cols: Column | str) -> Column:
    """One row as text, NULLs spelt out."""
    return F.concat(F.lit("("), F.concat_ws(", ", *[null_literal(c) for c in cols]), F.lit(")"))


def typed_null(data_type: T.DataType) -> Column:
    return F.lit(None).cast(data_type)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns in declared order and type; a column the input lacks becomes a typed NULL."""
    have = set(df.columns)
    return df.select([
        (F.col(f.name).cast(f.dataType) if f.name in have else typed_null(f.dataType)).alias(f.name)
        for f in schema
    ])


def apply_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Add a default only where the column is absent; a NULL that was given stays a NULL."""
    return df.withColumns({n: F.lit(v) for n, v in defaults.items() if n not in df.columns})


def card_bounds(store_id: Column | str) -> tuple[Column, Column]:
    """Half-open range of the card keys that belong to a store."""
    store_id = col_of(store_id).cast("long")
    return store_id * CARD_RANGE, (store_id + 1) * CARD_RANGE


def with_targets(df: DataFrame, targets: list[str], name: str = "target") -> DataFrame:
    """Every row once per target."""
    return df.withColumn(name, F.explode(F.array(*[F.lit(t) for t in targets])))
