"""Branch groups, pulls without a window, incremental pair counts, bucketed tables, key bitmaps."""

import os
import random
from collections import Counter
from datetime import datetime, timedelta
from itertools import combinations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.operators import baskets, bitmaps
from tillhouse.operators import generate as G
from tillhouse.operators.upsert import stamp
from tillhouse.plans import jobs
from tillhouse.schemas import CHECK_EXTRACT
from tillhouse.session import ensure_checkpoint_dir
from tillhouse.sources.buckets import open_bucketed, write_bucketed
from tillhouse.sources.extracts import changed_checks

NOW, LATER = datetime(2017, 6, 1), datetime(2018, 6, 1)
TAGGED = T.StructType(CHECK_EXTRACT.fields + [T.StructField("db_name", T.StringType())])
LINES = "store_id long, check_id long, product_id long, supplier_id long"


def shown(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_one_write_reaches_all_branches_of_a_group(spark, tmp_path):
    group = jobs.branch_group(spark, str(tmp_path))
    suppliers = G.suppliers(spark.range(3))
    assert shown(jobs._status(spark, jobs.send_to_all("supplier", suppliers, group, ["east", "west"], NOW))) == [
        ("supplier", "east", 3), ("supplier", "west", 3)]
    jobs.member(group, "north").append("supplier", stamp(G.suppliers(spark.range(1)), NOW))
    products = spark.createDataFrame([(1, "a", "v", 0), (2, "b", "w", 2)], "product_id long, name string, vendor_code string, supplier_id long")
    sent = jobs.send_to_all("product", products, group, ["east", "north"], NOW)
    # each branch's own suppliers decide
    assert sorted(sent) == [("product", "east", 2), ("product", "north", 1), ("product", "north: rejected", 1)]
    assert jobs.member(group, "west").read("product").count() == 0
    jobs.send_to_all("product", products.where("product_id = 1").withColumn("name", F.lit("new")), group, ["east"], LATER)
    got = {r["product_id"]: (r["name"], r["created_at"], r["modified_at"]) for r in jobs.member(group, "east").read("product").collect()}
    assert got == {1: ("new", NOW, LATER), 2: ("b", NOW, NOW)}
    assert [r["name"] for r in jobs.member(group, "north").read("product").collect()] == ["a"]


def warehouse_of(spark, root, products):
    warehouse = jobs.warehouse_store(spark, root)
    warehouse.append("store", spark.createDataFrame([(1, "e", "e", "east"), (2, "w", "w", "west")],
                                                    "store_id long, name string, address string, db_name string"))
    warehouse.append("card", G.cards(spark.range(3), 10_000_000))
    warehouse.append("product", spark.createDataFrame([(p, "p", "v", 1) for p in products], warehouse.tables["product"].schema))
    warehouse.append("supplier", spark.createDataFrame([(1, "s", "i")], warehouse.tables["supplier"].schema))
    return warehouse


def test_pulls_without_a_window_equal_one_pull_over_all(spark, tmp_path):
    warehouse = warehouse_of(spark, f"{tmp_path}/w", [1, 2])
    east = jobs.branch_store(spark, f"{tmp_path}/east")
    east.append("product", stamp(warehouse.read("product"), NOW))

    def sell(check, product, at):
        if check not in sold:
            east.append("check", stamp(spark.createDataFrame(
                [(check, 10_000_000, datetime(2017, 1, check), True, 1)],
                "check_id long, card_id long, check_date timestamp_ntz, payed boolean, payment_form int"), at))
        sold.append(check)
        east.append("line", stamp(spark.createDataFrame([(product, check, 1.0, 2.0)], "product_id long, check_id long, price double, cnt double"), at))

    sold = []
    sell(1, 1, NOW)
    sell(2, 1, NOW + timedelta(hours=1))
    assert shown(jobs.pull_changes(warehouse, {"east": east}))[0] == ("sale_fact", "warehouse", 2)
    sell(3, 1, NOW + timedelta(minutes=30))  # stamped before the mark, seen after it
    sell(1, 2, NOW + timedelta(hours=2))  # a line comes to an old receipt
    status = {r["target"]: r["rows"] for r in jobs.pull_changes(warehouse, {"east": east}).collect()}
    assert status["warehouse: late"] == 1
    fact = warehouse.read("sale_fact").select("check_id", "product_id")
    assert shown(fact) == [(1, 1), (1, 2), (2, 1), (3, 1)]
    assert warehouse.read("pulled").first()["mark"] == NOW + timedelta(hours=2)
    status = {r["target"]: r["rows"] for r in jobs.pull_changes(warehouse, {"east": east}).collect()}
    assert status["warehouse: late"] == 0 and warehouse.read("sale_fact").count() == 4


def test_pair_counts_stay_right_over_three_loads(spark, tmp_path):
    warehouse, showcase = warehouse_of(spark, f"{tmp_path}/w", range(1, 8)), jobs.showcase_store(spark, f"{tmp_path}/s")
    rng = random.Random(5)
    held = {}
    for load in range(3):
        receipts = {(name, c): rng.sample(range(1, 8), rng.randint(1, 5)) for name in ("east", "west") for c in rng.sample(range(12), 6)}
        held.update(receipts)
        tagged = spark.createDataFrame([(c, 10_000_000, datetime(2017, 1 + c % 3, 1 + load), True, 1, 2.0, 3.0, p, 1, name)
                                        for (name, c), products in receipts.items() for p in products], TAGGED)
        jobs.load_receipts(warehouse, showcase, tagged)
        want = Counter(pair for products in held.values() for pair in combinations(sorted(products), 2))
        got = {(r["sub_product_id"], r["product_id"]): r["amount"] for r in showcase.read("pair_counts").collect()}
        assert got == dict(want)
        assert warehouse.read("sale_fact").count() == sum(map(len, held.values()))


def test_changes_of_other_counts_are_an_error(spark):
    counts = spark.createDataFrame([(2, 1, 1, 1, 1)], "product_id long, supplier_id long, sub_product_id long, sub_supplier_id long, amount long")
    gone = counts.withColumn("amount", F.lit(-1).cast("long"))
    assert baskets.merge_counts(counts, gone).count() == 0
    with pytest.raises(Exception, match="less than never"):
        baskets.merge_counts(counts, gone.withColumn("amount", F.lit(-2).cast("long"))).collect()


def exchanges(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return plan.count("Exchange hashpartitioning")


def test_bucketed_tables_are_joined_and_paired_where_they_lie(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [(c % 3, c, p, 1) for c in range(60) for p in range(c % 5 + 1)]
        lines = spark.createDataFrame(rows, LINES)
        heads = lines.select("check_id", "store_id").distinct()
        check = write_bucketed(heads, f"{tmp_path}/check", ["check_id"], 4)
        line = write_bucketed(lines.drop("store_id"), f"{tmp_path}/line", ["check_id"], 4)
        joined = line.join(check, "check_id")
        assert exchanges(joined) == 0 and joined.count() == len(rows)
        sales = write_bucketed(joined, f"{tmp_path}/sales", baskets.BASKET, 4)
        assert exchanges(baskets._pairs(sales, sales, baskets.BASKET)) == 0
        assert shown(baskets.pair_counts(sales, stored=True)) == shown(baskets.pair_counts(lines))
        again = open_bucketed(spark, f"{tmp_path}/sales", sales.schema, baskets.BASKET, 4)
        assert exchanges(baskets._pairs(again, sales, baskets.BASKET)) == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_key_bitmaps(spark):
    keys = [None, 0, -5, 7, 7, 7, 32_768, 32_769, 10**12, 10**12]
    rows = spark.createDataFrame([(k,) for k in keys], "k long")
    assert tuple(bitmaps.key_counts(rows, "k").first()) == (9, 6, 3)
    assert tuple(bitmaps.key_counts(rows.limit(0), "k").first()) == (0, 0, 0)
    parents = spark.createDataFrame([(0,), (7,), (99,), (10**12,)], "p long")
    assert bitmaps.orphan_keys(rows, "k", parents, "p").first()["orphans"] == len({-5, 32_768, 32_769})


@pytest.mark.parametrize("total", [1, 2, 3, 5, 16, 200])
def test_an_order_of_its_own_for_each_key(spark, total):
    numbers = spark.range(total).crossJoin(spark.range(6).withColumnRenamed("id", "key"))
    got = numbers.select("key", G.shuffled("id", F.lit(total).cast("long"), "key").alias("x"), "id").collect()
    orders = {}
    for r in sorted(got):
        orders.setdefault(r["key"], {})[r["id"]] = r["x"]
    for order in orders.values():
        assert sorted(order.values()) == list(range(total))
    if total >= 16:
        assert len({tuple(o[i] for i in range(total)) for o in orders.values()}) == 6


def test_baskets_are_drawn_like_samples_without_replacement(spark):
    total = 60
    by_check = {}
    for r in G.baskets(spark.range(6000), total).collect():
        by_check.setdefault(r["check_id"], []).append(r["product_id"])

    def evenly(products):
        gaps = {(b - a) % total for a, b in zip(products, products[1:])}
        return len(gaps) == 1

    rng = random.Random(1)
    assert all(len(set(p)) == len(p) for p in by_check.values())
    large = [p for p in by_check.values() if len(p) >= 3]
    drawn = [rng.sample(range(total), len(p)) for p in large]
    assert abs(sum(map(evenly, large)) - sum(map(evenly, drawn))) <= 40  # about 1 in 180 baskets of three
    count = Counter(p for products in by_check.values() for p in products)
    mean = sum(count.values()) / total
    assert sum((count[p] - mean) ** 2 / mean for p in range(total)) < 120  # chi square of 59 degrees
    pairs = Counter(pair for products in by_check.values() for pair in combinations(sorted(products), 2))
    mean = sum(pairs.values()) / (total * (total - 1) / 2)
    assert sum((pairs[p] - mean) ** 2 / mean for p in combinations(range(total), 2)) < 2100  # 1,769 degrees


def test_a_pull_in_rounds_leaves_no_copies(spark, tmp_path, monkeypatch):
    warehouse = warehouse_of(spark, f"{tmp_path}/w", [1, 2])
    east = jobs.branch_store(spark, f"{tmp_path}/east")
    east.append("product", stamp(warehouse.read("product"), NOW))
    sold = [(1 + c % 2, c, float(c), 2.0) for c in range(1, 10)] + [(2, 2, 1.0, 1.0)]
    folder, rounds = ensure_checkpoint_dir(spark).removeprefix("file:"), []
    monkeypatch.setattr(jobs, "LINES_OF_ROUND", 3)
    monkeypatch.setattr(jobs, "changed_checks", lambda check, *more, **named: rounds.append(check.count()) or changed_checks(check, *more, **named))
    for moment in (NOW, NOW + timedelta(hours=2)):
        checks = [(c, 10_000_000, datetime(2017, 1, c), True, 1) for c in range(1, 10) if (c < 6) == (moment == NOW)]
        lines = spark.createDataFrame([x for x in sold if (x[1] < 6) == (moment == NOW)], "product_id long, check_id long, price double, cnt double")
        east.append("check", stamp(spark.createDataFrame(
            checks, "check_id long, card_id long, check_date timestamp_ntz, payed boolean, payment_form int"), moment))
        east.append("line", stamp(lines, moment))
        before = set(os.listdir(folder))
        jobs.pull_changes(warehouse, {"east": east})
        assert set(os.listdir(folder)) == before
    assert len(rounds) == 2 + 4 and sum(rounds[:2]) == 5 and sum(rounds[2:]) == 9
    assert shown(warehouse.read("sale_fact").select("product_id", "check_id", "price", "cnt")) == sorted(sold)
