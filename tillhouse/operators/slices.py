"""The part of the warehouse that belongs to one store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.functions.columns import card_bounds, in_window
from tillhouse.schemas import CARD_EXTRACT


def find_store(store: DataFrame, db_name: str) -> DataFrame:
    """The store with this database name. The name need not be unique: the lowest id is taken."""
    return store.where(F.col("db_name") == db_name).orderBy("store_id").limit(1)


def cards_of_store(card: DataFrame, store: DataFrame, db_name: str) -> DataFrame:
    """Cards in the key range of the store; the bounds are scalar subqueries."""
    low, high = card_bounds("store_id")
    one = find_store(store, db_name).select(low.alias("low"), high.alias("high"))
    return card.where((F.col("card_id") >= one.select("low").scalar())
                      & (F.col("card_id") < one.select("high").scalar())).select(CARD_EXTRACT.fieldNames())


def in_periods(sale_fact: DataFrame, date: DataFrame) -> DataFrame:
    """Fact rows of the months that ``date`` has rows of. Where both are stored by ``period``, only the folders of these months
    are opened: the months, one row each, are found first and filter the scan at run time."""
    if "period" not in sale_fact.columns or "period" not in date.columns:
        return sale_fact
    return sale_fact.join(F.broadcast(date.select("period").distinct()), "period", "left_semi")


def sales_of_store(sale_fact: DataFrame, store: DataFrame, date: DataFrame, db_name: str, start, end) -> DataFrame:
    """Fact rows of the store with their receipt date, for dates in the window. The store's number is found by a subquery; a stored fact is
    opened in the folders of this store and these months only."""
    one = find_store(store, db_name).select("store_id")
    inside = date.where(in_window("date", start, end))
    days = inside.select("date_id", F.col("date").alias("check_date"))
    return in_periods(sale_fact.where(F.col("store_id") == one.scalar()), inside).join(days, "date_id")


def check_headers(sales: DataFrame) -> DataFrame:
    return sales.select("check_id", "card_id", "check_date", "payed", "payment_form").distinct()


def check_lines(sales: DataFrame) -> DataFrame:
    return sales.select("product_id", "check_id", "price", "cnt")


def recent_checks(card: DataFrame, check: DataFrame, most: int) -> DataFrame:
    """For each card its newest checks: the right side is evaluated per row of the left. Only equality
    may tie the two sides, else Spark would pair every card with every check."""
    owner = card.select(F.col("card_id").alias("owner"))
    own = check.where(F.col("card_id") == F.col("owner").outer())
    newest = own.orderBy(F.desc("check_date"), F.desc("check_id")).limit(most).select("check_id", "check_date")
    return owner.lateralJoin(newest).withColumnRenamed("owner", "card_id")
