"""How often rows are shuffled, with broadcasts off."""

import os
import re

import pytest
from pyspark.sql import functions as F

from tillhouse.operators import baskets
from tillhouse.operators import upsert as U
from tillhouse.plans.retail_views import Retail
from tillhouse.schemas import CARD

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture
def shuffles(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")

    def count(df):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        return len(re.findall(r"(?<!Reused)Exchange hashpartitioning", plan))

    yield count
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lines_are_shuffled_once(spark, shuffles):
    """Lines by order, orders by order, and the four shuffles of the receipt's customer and nation."""
    assert shuffles(Retail(spark, FOLDER).sales()) <= 6


def test_upsert_with_stamps_reads_the_target_once(spark, shuffles):
    cards = Retail(spark, FOLDER).given("customer").select(
        F.col("c_custkey").alias("card_id"), *[F.lit("x").alias(c) for c in CARD.names if c not in ("card_id", "birth_date")],
        F.current_date().alias("birth_date"))
    merged = U.upsert(U.stamp(cards, F.current_timestamp()), cards.where("card_id % 3 = 0"), ["card_id"], F.current_timestamp())
    assert shuffles(merged) <= 4


def test_pairs_shuffle_the_lines_of_small_baskets_once_for_both_sides(spark, shuffles):
    lines = Retail(spark, FOLDER).given("lineitem").select(
        F.lit(1).alias("store_id"), F.col("l_orderkey").alias("check_id"), F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("supplier_id")).distinct()
    plain = baskets.pair_counts(lines)
    assert shuffles(plain) <= 6
