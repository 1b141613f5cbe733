"""Price of a line as of its receipt date, and the newest price."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.operators.heavy import LEAST, heavy_keys
from tillhouse.session import settle


def price_revisions(price: DataFrame) -> DataFrame:
    """One row per product and date; of two prices for one date the higher price id wins."""
    return price.groupBy("product_id", "set_date").agg(
        F.max_by("cost_sale", "price_id").alias("cost_sale"))


def latest_price(price: DataFrame) -> DataFrame:
    """Newest price of each product. An aggregate and not a window, so that a product with very
    many revisions is reduced before the shuffle."""
    return price_revisions(price).groupBy("product_id").agg(
        F.max("set_date").alias("set_date"), F.max_by("cost_sale", "set_date").alias("cost_sale"))


def asof_price(line: DataFrame, price: DataFrame, least: int = LEAST, sold: DataFrame | None = None) -> DataFrame:
    """``line`` (with ``product_id`` and ``check_date``) with ``price`` set to the sale price that
    held at the receipt date, NULL where no price had been set yet. A ``price`` column in the input
    is ignored, and so is a price without a date.

    Lines and revisions of a product are sorted together: one shuffle, any size. A product with more than ``least`` rows is
    cut into minutes, each starting with the price that held before it, and a minute that still has more is dealt to pieces.

    ``sold`` may give the lines' ``product_id`` more cheaply than ``line``; it only serves to find the
    products that need splitting, which is done first, by one narrow count.
    """
    line, revisions = line.drop("price"), price_revisions(price.where(F.col("set_date").isNotNull()))
    both = (line if sold is None else sold).select("product_id").unionByName(price.select("product_id"))
    heavy = settle(heavy_keys(both, ["product_id"], least).select("product_id"))
    if heavy.isEmpty():  # the same rows as below, by a plan without the parts for such products
        return _last_price(line, revisions, ["product_id"])
    return _asof_split(line, revisions, heavy, least)


def _last_price(line: DataFrame, revisions: DataFrame, group: list[str]) -> DataFrame:
    """Union of revisions and lines, last price before each line."""
    prices = revisions.select(*group, F.lit(0).alias("_kind"), F.col("set_date").alias("_at"),
                              F.col("cost_sale").alias("_price"))
    marked = line.withColumns({"_kind": F.lit(1), "_at": F.col("check_date")})
    order = Window.partitionBy(*group).orderBy(
        F.col("_at").asc_nulls_first(), "_kind").rowsBetween(Window.unboundedPreceding, 0)
    return (marked.unionByName(prices, allowMissingColumns=True)
            .withColumn("price", F.last("_price", ignorenulls=True).over(order))
            .where(F.col("_kind") == 1).drop("_kind", "_at", "_price"))


def _asof_split(line: DataFrame, revisions: DataFrame, heavy: DataFrame, least: int) -> DataFrame:
    """The same with each heavy product cut into minutes, where a minute starts with the price that held
    before it. Should one minute of one product still be heavy, its lines are dealt to pieces by
    a hash of the line, and each piece has its own copy of that minute's prices."""
    heavy = F.broadcast(heavy.withColumn("_heavy", F.lit(True)))
    group = ["product_id", "_slice"]

    def cut(df: DataFrame, at: str) -> DataFrame:
        days = F.datediff(F.to_date(at), F.lit("1970-01-01").cast("date")).cast("long")
        minute = days * 1440 + F.hour(at) * 60 + F.minute(at)
        return df.join(heavy, "product_id", "left").withColumn(
            "_slice", F.when(F.col("_heavy"), minute).otherwise(F.lit(0).cast("long")))

    lines, prices = cut(line, "check_date"), cut(revisions, "set_date")
    cut_lines, cut_prices = lines.where(F.col("_heavy")), prices.where(F.col("_heavy"))

    # The price that each minute of a heavy product starts with. A product has as many rows here as
    # there are minutes in the calendar, at most.
    closing = cut_prices.groupBy(*group).agg(F.max_by("cost_sale", "set_date").alias("_closing"))
    earlier = Window.partitionBy("product_id").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    opening = cut_lines.select(*group).distinct().join(closing, group, "full_outer").withColumn(
        "cost_sale", F.last("_closing", ignorenulls=True).over(earlier)).where(F.col("cost_sale").isNotNull())
    opening = opening.select(*group, "cost_sale", F.lit(None).cast(T.TimestampNTZType()).alias("set_date"))
    lines, prices = lines.drop("_heavy"), prices.drop("_heavy").unionByName(opening)

    busy = F.broadcast(heavy_keys(cut_lines.select(*group), group, least))
    pieces = F.coalesce(F.col("pieces"), F.lit(1))
    piece = F.pmod(F.xxhash64(*line.columns), pieces).cast("int")
    lines = lines.join(busy, group, "left").withColumn("_piece", piece).drop("pieces")
    copies = F.explode(F.sequence(F.lit(0), pieces - 1))
    prices = prices.join(busy, group, "left").withColumn("_piece", copies).drop("pieces")
    return _last_price(lines, prices, [*group, "_piece"]).drop("_slice", "_piece")


def before_first_price(line: DataFrame, price: DataFrame) -> DataFrame:
    """Lines (with ``product_id`` and ``check_date``) that ``asof_price`` leaves without a price: their product
    has none, or only later ones. Compares with one date per product, so nothing is sorted."""
    first = price.groupBy("product_id").agg(F.min("set_date").alias("_first"))
    priced = F.coalesce(F.col("_first") <= F.col("check_date"), F.lit(False))
    return line.join(first, "product_id", "left").where(~priced).drop("_first")


def price_lines(line: DataFrame, check: DataFrame, price: DataFrame, least: int = LEAST, sold: DataFrame | None = None) -> DataFrame:
    """Lines of a branch priced as of their receipt's date. A line without a receipt stays, unpriced."""
    dated = line.join(check.select("check_id", "check_date"), "check_id", "left")
    return asof_price(dated, price, least, sold=line if sold is None else sold)
