"""Products bought together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.functions.columns import in_window
from tillhouse.operators.slices import in_periods
from tillhouse.session import partitions, settle

BASKET = ["store_id", "check_id"]
PAIR = ["product_id", "supplier_id", "sub_product_id", "sub_supplier_id"]

# A basket with more lines than this is paired in blocks of this size, block by block.
BLOCK_LINES = 2_000


def pair_counts(sales: DataFrame, block_lines: int = BLOCK_LINES, stored: bool = False) -> DataFrame:
    """How many baskets hold both products, for each product > sub-product and their suppliers.

    ``sales`` has one row per basket and product. Pairs are counted in the task that makes them,
    so only distinct pairs per task are shuffled.

    The work for a basket grows with the square of its lines. A basket above ``block_lines`` is kept out of the plain
    self-join; its lines are dealt to blocks by product, and each pair of blocks is one join key, so the basket is spread
    over (lines / block_lines)^2 keys and each pair still is made exactly once. The sales are computed once; where no basket
    is large, the plan has no part for such baskets. ``stored`` says that ``sales`` are stored rows; if they are dealt by basket, the pairs are
    made where they lie.
    """
    lines = sales.select(*BASKET, "product_id", "supplier_id")
    lines = lines if stored else settle(lines)
    large = settle(lines.groupBy(*BASKET).agg(F.count("*").alias("_n"))
                   .where(F.col("_n") > block_lines)
                   .select(*BASKET, F.ceil(F.col("_n") / block_lines).cast("int").alias("blocks")))
    if large.isEmpty():
        return _count(_pairs(lines, lines, BASKET))
    cells = BASKET + ["_row", "_column"]
    small = lines.join(large.select(*BASKET), BASKET, "left_anti")
    block = F.pmod(F.xxhash64("product_id"), F.col("blocks")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = lines.join(large, BASKET).withColumn("_block", block)
    main = dealt.select(*BASKET, "product_id", "supplier_id", F.col("_block").alias("_row"), every.alias("_column"))
    sub = dealt.select(*BASKET, "product_id", "supplier_id", F.col("_block").alias("_column"), every.alias("_row"))
    # a fixed number of partitions: the few input rows would else be packed into few tasks
    n = partitions(lines.sparkSession)
    main, sub = main.repartition(n, *cells), sub.repartition(n, *cells)
    return _count(_pairs(small, small, BASKET).unionByName(_pairs(main, sub, cells)))


def _pairs(main: DataFrame, sub: DataFrame, keys: list[str]) -> DataFrame:
    # Renamed after the join only: a self-join then reads one and the same shuffle on both sides.
    together = [F.col(f"m.{k}") == F.col(f"s.{k}") for k in keys]
    ordered = F.col("m.product_id") > F.col("s.product_id")
    return main.alias("m").join(sub.alias("s"), together + [ordered]).select(
        "m.product_id", "m.supplier_id", F.col("s.product_id").alias("sub_product_id"),
        F.col("s.supplier_id").alias("sub_supplier_id"))


def _count(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy(*PAIR).agg(F.count("product_id").alias("amount"))


def pair_changes(before: DataFrame, after: DataFrame, block_lines: int = BLOCK_LINES) -> DataFrame:
    """By how much the counts change when the lines ``before`` of some baskets become ``after``: pairs that come count up, pairs that go count
    down. Both hold whole baskets, and only those that changed, so the work does not grow with the baskets that stay as they are."""
    gone = pair_counts(before, block_lines).withColumn("amount", -F.col("amount"))
    both = pair_counts(after, block_lines).unionByName(gone)
    return both.groupBy(*PAIR).agg(F.sum("amount").alias("amount")).where("amount <> 0")


def merge_counts(counts: DataFrame, changes: DataFrame) -> DataFrame:
    """``counts`` after ``changes``; pairs that no basket holds any more are gone. A count below zero is an error: the changes are not of these counts."""
    merged = counts.select(*PAIR, "amount").unionByName(changes.select(*PAIR, "amount")).groupBy(*PAIR).agg(F.sum("amount").alias("amount"))
    fits = F.when(F.col("amount") < 0, F.raise_error(F.lit("a pair is counted less than never")).cast("boolean")).otherwise(F.col("amount") > 0)
    return merged.where(fits)


def dated_sales(sale_fact: DataFrame, date: DataFrame, start, end) -> DataFrame:
    """Fact rows whose date is in the window, before anything else is done with them."""
    inside = date.where(in_window("date", start, end))
    wanted = inside.select("date_id", F.col("date").alias("check_date"))
    return in_periods(sale_fact, inside).join(wanted, "date_id")


def name_pairs(counts: DataFrame, product: DataFrame, supplier: DataFrame) -> DataFrame:
    """Product and supplier names for both sides of each counted pair."""
    goods = product.select("product_id", F.col("name").alias("product_name"), "vendor_code")
    makers = supplier.select("supplier_id", F.col("name").alias("supplier_name"))

    def second(df: DataFrame, key: str) -> DataFrame:
        return df.select([F.col(c).alias(f"sub_{key}" if c == key else f"{c}_2") for c in df.columns])

    named = (counts.join(goods, "product_id").join(makers, "supplier_id")
             .join(second(goods, "product_id"), "sub_product_id")
             .join(second(makers, "supplier_id"), "sub_supplier_id"))
    return named.select(
        "amount", "product_id", "product_name", "vendor_code", "supplier_name",
        F.col("sub_product_id").alias("product_id_2"), "product_name_2", "vendor_code_2", "supplier_name_2")


def product_pairs(sales: DataFrame, product: DataFrame, supplier: DataFrame,
                  block_lines: int = BLOCK_LINES) -> DataFrame:
    """The published report, most frequent pairs first. Names are joined after counting."""
    named = name_pairs(pair_counts(sales, block_lines), product, supplier)
    return named.orderBy(F.desc("amount"), "product_id", "product_id_2", "supplier_name", "supplier_name_2")


def basket_text(sales: DataFrame) -> DataFrame:
    """Products of each basket as one text, in the order of their numbers."""
    return sales.groupBy(*BASKET).agg(F.expr(
        "listagg(cast(product_id as string), ', ') within group (order by product_id)").alias("products"))
