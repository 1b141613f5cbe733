"""The retail tables, derived from the given tables. All are whole tables; nothing is left out."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.functions.columns import moment
from tillhouse.schemas import CARD_RANGE


# Columns of the given tables; nothing is inferred from the files.
GIVEN = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}


def _days_after(start: str, days: Column) -> Column:
    return moment(start) + F.make_dt_interval(days.cast("int"))


@dataclass
class Retail:
    spark: SparkSession
    folder: str

    def given(self, name: str) -> DataFrame:
        return self.spark.read.schema(GIVEN[name]).parquet(f"{self.folder}/{name}.parquet")

    @property
    def size(self) -> int:
        """Bytes of the given tables that are there, as their folder lists them."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        files = path(self.folder).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        tables = [path(f"{self.folder}/{name}.parquet") for name in GIVEN]
        return sum(files.getContentSummary(t).getLength() for t in tables if files.exists(t))

    @cached_property
    def store(self) -> DataFrame:
        return self.given("region").select(
            (F.col("r_regionkey") + 1).cast("long").alias("store_id"), F.col("r_name").alias("db_name"))

    @cached_property
    def card(self) -> DataFrame:
        store_id = (F.col("n_regionkey") + 1).cast("long")
        joined = self.given("customer").join(self.given("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        return joined.select(
            (store_id * CARD_RANGE + F.col("c_custkey")).alias("card_id"),
            store_id.alias("store_id"),
            F.col("c_custkey").alias("local_id"),
            F.concat(F.lit("4"), F.lpad(F.col("c_custkey").cast("string"), 15, "0")).alias("number"),
            F.col("c_mktsegment").alias("first_name"),
            F.when(F.col("c_acctbal") >= 0, F.col("n_name")).alias("middle_name"),
            F.col("c_name").alias("last_name"),
            F.date_add(F.lit("1950-01-01").cast("date"), (F.col("c_custkey") % 18000).cast("int")).alias("birth_date"),
            _days_after("1995-01-01", F.col("c_custkey") * 37 % 2400).alias("modified_at"),
            F.col("c_acctbal").alias("balance"))

    @cached_property
    def supplier(self) -> DataFrame:
        return self.given("supplier").select(
            F.col("s_suppkey").alias("supplier_id"), F.col("s_name").alias("name"),
            F.col("s_nationkey").cast("string").alias("inn"), F.col("s_acctbal").alias("balance"))

    @cached_property
    def product(self) -> DataFrame:
        makers = self.given("supplier").agg(F.count("*")).scalar()
        return self.given("part").select(
            F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"),
            F.col("p_brand").alias("vendor_code"), F.pmod(F.col("p_partkey"), makers).alias("supplier_id"),
            F.col("p_size").alias("size"),
            _days_after("1995-01-01", F.col("p_partkey") * 37 % 2400).alias("created_at"))

    @cached_property
    def check(self) -> DataFrame:
        # Joined table by table and not with the card view: Spark then knows the size of each small side.
        joined = (self.given("orders")
                  .join(self.given("customer"), F.col("o_custkey") == F.col("c_custkey"))
                  .join(self.given("nation"), F.col("c_nationkey") == F.col("n_nationkey")))
        store_id = (F.col("n_regionkey") + 1).cast("long")
        return joined.select(
            F.col("o_orderkey").alias("check_id"),
            (store_id * CARD_RANGE + F.col("o_custkey")).alias("card_id"),
            F.col("o_orderdate").alias("check_date"),
            (F.col("o_orderstatus") == "F").alias("payed"),
            (F.col("o_orderkey") % 2 + 1).cast("int").alias("payment_form"),
            store_id.alias("store_id"))

    @cached_property
    def line(self) -> DataFrame:
        """One row per order and part: the quantities are added. Dealt by order and then grouped, so the join to the
        order that all users make next finds its rows in place; hardly any line is a copy that could be reduced before."""
        return self.given("lineitem").repartition("l_orderkey").groupBy("l_orderkey", "l_partkey").agg(
            F.max("l_suppkey").alias("supplier_id"),
            F.max(F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
            F.sum("l_quantity").alias("cnt")).select(
            F.col("l_orderkey").alias("check_id"), F.col("l_partkey").alias("product_id"),
            "supplier_id", "price", "cnt")

    @cached_property
    def price(self) -> DataFrame:
        unit = F.col("l_extendedprice") / F.col("l_quantity")
        return self.given("lineitem").groupBy("l_partkey", "l_shipdate").agg(
            F.max(unit * (F.col("l_tax") + 1)).alias("cost"), F.max(unit).alias("cost_sale")).select(
            (F.col("l_partkey") * 100_000
             + F.datediff(F.to_date("l_shipdate"), F.lit("1990-01-01").cast("date"))).alias("price_id"),
            F.col("l_partkey").alias("product_id"), "cost", "cost_sale", F.col("l_shipdate").alias("set_date"))

    def sales(self, start=None, end=None) -> DataFrame:
        """Sale lines with their receipt. The window is applied to the receipts, before the join."""
        heads = self.check
        if start is not None:
            heads = heads.where(F.col("check_date").between(moment(start), moment(end)))
        return self.line.join(heads, "check_id").select(
            "product_id", "card_id", "supplier_id", "check_id", "payed", "payment_form", "store_id",
            "check_date", "price", "cnt")

    @cached_property
    def moments(self) -> DataFrame:
        return self.given("events").select("event_id", F.col("ts").alias("moment"))
