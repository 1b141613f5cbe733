"""Sample branch data of any size. Each row is computed from its own number alone, so the result does
not depend on the partitioning, and columns that must be unique are so without a shared set.

Numbers are drawn with ``(a * id + b) mod P`` for a prime P: a permutation of 0..P-1. P is below 2^31,
which keeps all products inside a long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the largest prime below 2^31.
PRIME = 2_147_483_647

# Multiplier and shift of each independent draw.
DRAWS = {
    "number": (1_103_515_245, 12_345),
    "name": (48_271, 7),
    "birth": (69_621, 11),
    "card": (630_360_016, 13),
    "day": (16_807, 17),
    "time": (742_938_285, 19),
    "form": (950_706_376, 23),
    "code": (1_226_874_159, 29),
    "parent": (62_089_911, 31),
    "cost": (1_343_714_438, 37),
    "share": (397_204_094, 41),
    "size": (1_176_845_333, 43),
    "first": (1_583_458_089, 47),
    "step": (784_588_716, 53),
    "count": (1_226_874_159, 59),
    "round1": (1_343_714_438, 61),
    "round2": (950_706_376, 67),
    "round3": (1_176_845_333, 71),
    "round4": (630_360_016, 73),
}
# Spreads the halves of a permuted number before a draw.
SPREAD = 65_537
# A permutation of a rectangle walks on while it is outside of the wanted range: less than a quarter of the places, so this many steps never suffice
# with odds below 10^-38.
MOST_WALKS = 64


def _prime() -> Column:
    return F.lit(PRIME).cast("long")


def _permuted(kind: str, n: Column | str) -> Column:
    a, b = DRAWS[kind]
    n = F.col(n) if isinstance(n, str) else n
    return F.pmod(F.pmod(n.cast("long"), _prime()) * a + b, _prime())


def unique(kind: str, n: Column | str = "id") -> Column:
    """Different for different n: n keeps its round of P numbers and is permuted within it."""
    n = (F.col(n) if isinstance(n, str) else n).cast("long")
    return n - F.pmod(n, _prime()) + _permuted(kind, n)


def draw(kind: str, size, n: Column | str = "id") -> Column:
    """Number in 0..size-1. Squaring the unique draw breaks up its even steps."""
    u = _permuted(kind, n)
    size = size if isinstance(size, Column) else F.lit(size)
    return F.pmod(F.pmod(u * u, _prime()), size.cast("long"))


def _let(value: Column, build) -> Column:
    """``build`` of a value that is computed once."""
    return F.transform(F.array(value), build)[0]


def shuffled(n: Column | str, total: Column, key: Column | str) -> Column:
    """The ``n``-th number (from 0) of 0..total-1 in an order of its own for each ``key``: different n give different numbers, so the first k of an
    order are k draws without replacement, each computed alone.

    A Feistel network of four rounds permutes a rectangle of at least ``total`` places; a number outside is permuted again until it falls inside.
    """
    n, key = (F.col(c) if isinstance(c, str) else c for c in (n, key))
    width = F.ceil(F.sqrt(total.cast("double"))).cast("long")
    height = F.floor((total + width - 1) / width).cast("long")

    def mixed(half: Column, turn: int, size: Column) -> Column:
        return draw(f"round{turn}", size, half * SPREAD + key)

    def once(x: Column) -> Column:
        def rows(left1):
            def columns(right1):
                def again(left2):
                    return F.pmod(right1 + mixed(left2, 4, height), height) * width + left2
                return _let(F.pmod(left1 + mixed(right1, 3, width), width), again)
            return _let(F.pmod(F.call_function("div", x, width) + mixed(left1, 2, height), height), columns)
        return _let(F.pmod(F.pmod(x, width) + mixed(F.call_function("div", x, width), 1, width), width), rows)

    def walk(first):
        last = F.aggregate(F.sequence(F.lit(1), F.lit(MOST_WALKS)), first, lambda x, _: F.when(x < total, x).otherwise(once(x)))
        return F.when(first < total, first).otherwise(last)  # most numbers are inside at once

    return _let(_let(once(n.cast("long")), walk), lambda x: F.when(x < total, x).otherwise(
        F.raise_error(F.lit("no number in range")).cast("long")))


def _code(prefix: str, value: Column) -> Column:
    """Fixed-width text, wide enough for any number below 10^18."""
    return F.concat(F.lit(prefix), F.lpad(value.cast("string"), 18, "0"))


def _day(start: str, days: Column) -> Column:
    return F.date_add(F.lit(start).cast("date"), days.cast("int"))


def cards(ids: DataFrame, first_key: int) -> DataFrame:
    return ids.select(
        (F.col("id") + first_key).alias("card_id"),
        _code("4", unique("number")).alias("number"),
        _code("first-", unique("name")).alias("first_name"),
        _code("middle-", draw("parent", 1000)).alias("middle_name"),
        _code("last-", draw("code", 10000)).alias("last_name"),
        _day("1950-01-01", draw("birth", 18993)).alias("birth_date"))


def checks(ids: DataFrame, card_total, first_key: int) -> DataFrame:
    """Receipts of one year, all paid, on a card that exists."""
    day = _day("2017-01-01", draw("day", 365)).cast("timestamp_ntz")
    micros = draw("time", 86_400) * 1_000_000 + draw("first", 1_000_000)
    return ids.select(
        F.col("id").alias("check_id"),
        (draw("card", card_total) + first_key).alias("card_id"),
        (day + F.make_dt_interval(secs=(micros / 1_000_000).cast("decimal(18,6)"))).alias("check_date"),
        F.lit(True).alias("payed"),
        (draw("form", 2) + 1).cast("int").alias("payment_form"))


def suppliers(ids: DataFrame) -> DataFrame:
    return ids.select(F.col("id").alias("supplier_id"), _code("company-", unique("name")).alias("name"),
                      _code("78", unique("code")).alias("inn"))


def products(ids: DataFrame, supplier_total) -> DataFrame:
    """Names may repeat, vendor codes may not."""
    return ids.select(
        F.col("id").alias("product_id"), _code("product-", draw("name", 5000)).alias("name"),
        _code("7", unique("code")).alias("vendor_code"), draw("parent", supplier_total).alias("supplier_id"))


def prices(product_ids: DataFrame, revision_ids: DataFrame, product_total) -> DataFrame:
    """A first price for every product at the start of the year, then revisions of drawn products on
    drawn days. The sale price is 10 to 80 percent of the cost."""
    def cost(n: str) -> tuple[Column, Column]:
        cents = draw("cost", 100_000, n) + 1
        return ((cents / 100).alias("cost"),
                (F.floor(cents * (draw("share", 71, n) + 10) / 100) / 100).alias("cost_sale"))

    first = product_ids.select(
        F.lit("first").alias("kind"), F.col("id").alias("revision"), F.col("id").alias("product_id"),
        *cost("id"), F.lit("2017-01-01").cast("timestamp_ntz").alias("set_date"))
    later = revision_ids.select(
        F.lit("later").alias("kind"), F.col("id").alias("revision"),
        draw("parent", product_total).alias("product_id"), *cost("id"),
        _day("2017-01-01", draw("day", 365)).cast("timestamp_ntz").alias("set_date"))
    return first.unionByName(later)


def baskets(check_ids: DataFrame, product_total, most_products: int = 5, most_count: int = 5) -> DataFrame:
    """1..``most_products`` different products per check, drawn uniformly without replacement."""
    total = product_total if isinstance(product_total, Column) else F.lit(product_total)
    total = total.cast("long")
    size = F.least(draw("size", most_products) + 1, total)
    listed = check_ids.select(F.col("id").alias("check_id"), total.alias("_total"), F.explode(F.sequence(F.lit(0).cast("long"), size - 1)).alias("_nth"))
    counted = draw("count", most_count, F.col("check_id") * most_products + F.col("_nth")) + 1
    return listed.select("check_id", shuffled("_nth", F.col("_total"), "check_id").alias("product_id"),
                         F.lit(0.0).alias("price"), counted.cast("double").alias("cnt"))
