"""Rows to send to several targets, and the status they leave."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.functions.columns import with_targets


def supplier_rows(extract: DataFrame) -> DataFrame:
    return extract.select("supplier_id", F.col("supplier_name").alias("name"), "inn").distinct()


def product_rows(extract: DataFrame) -> DataFrame:
    return extract.select("product_id", "name", "vendor_code", "supplier_id").distinct()


def price_rows(extract: DataFrame) -> DataFrame:
    return extract.select("price_id", "product_id", "cost", "cost_sale", "set_date").distinct()


def status(entity: str, rows: DataFrame, targets: list[str]) -> DataFrame:
    """(entity, target, rows): how many rows each target is sent. Counted once, then spread."""
    counted = rows.agg(F.count("*").alias("rows")).withColumn("entity", F.lit(entity))
    return with_targets(counted, targets).select("entity", "target", "rows")
