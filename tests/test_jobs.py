"""All jobs in a row over generated branches, against plain Python."""

from collections import Counter
from datetime import datetime
from itertools import combinations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.operators import generate as G
from tillhouse.operators.upsert import DuplicateKeys, merge_into, stamp
from tillhouse.plans import jobs
from tillhouse.schemas import BRANCH_TABLES, CHECK_EXTRACT, SALE_FACT, SUPPLIER
from tillhouse.sources.branches import fan_in, read_rows
from tillhouse.sources.tables import TableStore
from tillhouse.streaming.feed import follow_checks

WINDOW = ("2016-01-01", "2018-01-01")
LOADED, SENT = datetime(2017, 6, 1), datetime(2018, 6, 1)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def fill_branch(spark, root, store_id, first_id):
    """One branch; both branches use the same products and, in part, the same receipt numbers."""
    branch = jobs.branch_store(spark, root)
    checks = spark.range(first_id, first_id + 60)
    prices = G.prices(spark.range(30), spark.range(40), 30).withColumn(
        "price_id", F.when(F.col("kind") == "first", F.col("revision")).otherwise(F.col("revision") + 1000))
    base = {
        "card": G.cards(spark.range(20), store_id * 10_000_000),
        "check": G.checks(checks, 20, store_id * 10_000_000),
        "supplier": G.suppliers(spark.range(6)),
        "product": G.products(spark.range(30), 6),
        "price": prices,
    }
    for name, df in base.items():
        branch.append(name, stamp(df, LOADED))
    lost = jobs.insert_lines(branch, G.baskets(checks, 30), now=LOADED)
    assert lost.count() == 0
    return branch


@pytest.fixture(scope="module")
def chain(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("chain"))
    names = {1: "east", 2: "west", 3: "south"}
    branches = {"east": fill_branch(spark, f"{root}/east", 1, 0), "west": fill_branch(spark, f"{root}/west", 2, 30)}
    south = jobs.branch_store(spark, f"{root}/south")
    warehouse, showcase = jobs.warehouse_store(spark, f"{root}/warehouse"), jobs.showcase_store(spark, f"{root}/show")
    warehouse.append("store", spark.createDataFrame(
        [(i, n, n, n) for i, n in names.items()], "store_id long, name string, address string, db_name string"))
    return branches, south, warehouse, showcase


def test_all_jobs(spark, chain):
    branches, south, warehouse, showcase = chain
    sent = jobs.publish_products(branches["east"], {"west": branches["west"], "warehouse": warehouse}, *WINDOW, now=SENT)
    assert rows(sent) == sorted([("supplier", "west", n_suppliers := sent.where("entity='supplier'").first()["rows"]),
                                 ("supplier", "warehouse", n_suppliers),
                                 ("product", "west", 30), ("product", "warehouse", 30),
                                 ("price", "west", 70), ("price", "warehouse", 70)], key=str)
    assert branches["west"].read("product").agg(F.min("created_at"), F.min("modified_at")).first() == (LOADED, SENT)
    assert branches["west"].read("price").count() == 70

    jobs.pull_cards(warehouse, branches, *WINDOW)
    assert warehouse.read("card").count() == 40

    for _ in range(2):  # the second run changes nothing
        status = jobs.pull_checks(warehouse, branches, *WINDOW)
        lines = {n: b.read("line").count() for n, b in branches.items()}
        assert rows(status) == [("sale_fact", "warehouse", sum(lines.values()))]
        fact = warehouse.read("sale_fact")
        assert fact.count() == fact.select("store_id", "check_id", "product_id").distinct().count() == sum(lines.values())
        times = {r[0] for b in branches.values() for r in b.read("check").join(b.read("line"), "check_id")
                 .select("check_date").distinct().collect()}
        dates = warehouse.read("date").collect()
        assert sorted(r["date_id"] for r in dates) == list(range(1, len(times) + 1))
        assert {r["date"] for r in dates} == times

    jobs.publish_products(branches["east"], {"south": south}, *WINDOW, now=SENT)
    assert rows(jobs.send_cards(warehouse, "south", south, "west", now=SENT)) == [("card", "south", 20)]
    jobs.send_checks(warehouse, "south", south, "west", *WINDOW, now=SENT)
    for table in ("card", "check", "line", "price", "product"):
        keep = [c for c in BRANCH_TABLES[table].names if c not in ("created_at", "modified_at")]
        assert rows(south.read(table).select(keep)) == rows(branches["west"].read(table).select(keep))
    sold = {(r["product_id"], r["check_id"]): r["price"] for r in south.read("line").collect()}
    jobs.send_checks(warehouse, "south", south, "west", *WINDOW, now=SENT, reprice=True)
    assert {(r["product_id"], r["check_id"]): r["price"] for r in south.read("line").collect()} == sold

    baskets, pairs = {}, Counter()
    for r in warehouse.read("sale_fact").collect():
        baskets.setdefault((r["store_id"], r["check_id"]), []).append((r["product_id"], r["supplier_id"]))
    for basket in baskets.values():
        pairs.update((high[0], low[0]) for low, high in combinations(sorted(basket), 2))
    status = jobs.find_product_pairs(warehouse, showcase, *WINDOW)
    published = showcase.read("product_pairs")
    assert {(r["product_id"], r["product_id_2"]): r["amount"] for r in published.collect()} == dict(pairs)
    assert rows(status) == [("product_pairs", "showcase", len(pairs))]

    # an empty window empties the report
    jobs.find_product_pairs(warehouse, showcase, "2030-01-01", "2031-01-01")
    assert showcase.read("product_pairs").count() == 0
    assert rows(jobs.pull_cards(warehouse, branches, "2030-01-01", "2031-01-01")) == [("card", "warehouse", 0)]


def test_lines_without_a_price_are_set_aside(spark, tmp_path):
    branch = jobs.branch_store(spark, str(tmp_path))
    moment = datetime(2017, 5, 1)
    branch.append("check", stamp(spark.createDataFrame(
        [(1, 1, moment, True, 1)], "check_id long, card_id long, check_date timestamp_ntz, payed boolean, payment_form int"), LOADED))
    branch.append("price", stamp(spark.createDataFrame(
        [(1, 1, 5.0, 4.0, moment), (2, 2, 5.0, 4.0, datetime(2017, 5, 2))],
        "price_id long, product_id long, cost double, cost_sale double, set_date timestamp_ntz"), LOADED))
    lines = spark.createDataFrame([(1, 1, 0.0, 2.0), (2, 1, 0.0, 3.0), (1, 77, 0.0, 1.0)], "product_id long, check_id long, price double, cnt double")
    lost = jobs.insert_lines(branch, lines, now=LOADED)
    assert sorted((r["product_id"], r["check_id"], r["price"]) for r in lost.collect()) == [(1, 77, None), (2, 1, None)]
    assert [tuple(r)[:4] for r in branch.read("line").collect()] == [(1, 1, 4.0, 2.0)]
    with pytest.raises(DuplicateKeys):
        jobs.insert_lines(branch, lines, now=LOADED)


def partitions_read(df, column):
    """Folders that the scan of a table with this column opened, after run-time pruning."""
    df.collect()
    found, waiting = [], [df._jdf.queryExecution().executedPlan()]
    while waiting:
        node = waiting.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            node = node.executedPlan()
        if "QueryStageExec" in node.getClass().getSimpleName():
            node = node.plan()
        if "FileSourceScanExec" in node.getClass().getSimpleName() and column in node.toString():
            found.append(node.metrics().apply("numPartitions").value())
        children = node.children()
        waiting += [children.apply(i) for i in range(children.size())]
    return max(found)


def test_only_touched_partitions_are_written(spark, tmp_path):
    store = TableStore(spark, str(tmp_path), {"sale_fact": SALE_FACT}, {"sale_fact": {"store_id": "store_id", "date_range": "date_id div 10"}},
                       {"sale_fact": ["date_range"]})

    def fact(store_id, check, price, date=1):
        return spark.createDataFrame([(1, 1, 1, check, True, 1, store_id, date, price, 1.0)], SALE_FACT.schema)

    def files():
        found = {}
        for path in store.scan("sale_fact").inputFiles():
            found.setdefault(path.split("/")[-3], set()).add(path)
        return found

    for s in (1, 2, 3):
        merge_into(store, SALE_FACT, fact(s, 10, 1.0))
    before = files()
    assert merge_into(store, SALE_FACT, fact(2, 10, 9.0).unionByName(fact(2, 11, 8.0))) == 2
    after = files()
    assert {p for p in after if after[p] != before[p]} == {"store_id=2"}
    got = sorted((r["store_id"], r["check_id"], r["price"]) for r in store.read("sale_fact").collect())
    assert got == [(1, 10, 1.0), (2, 10, 9.0), (2, 11, 8.0), (3, 10, 1.0)]
    assert partitions_read(store.within("sale_fact", ["store_id=3"], ["store_id"]), "store_id") == 1
    # a row that moves to another partition is gone from the one it leaves, even if that is left empty
    merge_into(store, SALE_FACT, fact(3, 10, 2.0, date=25))
    got = sorted((r["store_id"], r["check_id"], r["price"], r["date_id"]) for r in store.read("sale_fact").collect())
    assert got == [(1, 10, 1.0, 1), (2, 10, 9.0, 1), (2, 11, 8.0, 1), (3, 10, 2.0, 25)]
    with pytest.raises(DuplicateKeys):
        merge_into(store, SALE_FACT, fact(2, 10, 9.0).unionByName(fact(2, 10, 8.0)))


def test_append_then_replace(spark, tmp_path):
    store = TableStore(spark, str(tmp_path), BRANCH_TABLES)
    base = stamp(G.suppliers(spark.range(4)), LOADED)
    assert store.read("supplier").count() == 0
    assert store.append("supplier", base) == 4
    assert store.append("supplier", stamp(G.suppliers(spark.range(4, 6)), LOADED)) == 2
    assert store.read("supplier").count() == 6
    assert store.replace("supplier", store.read("supplier").where("supplier_id > 2")) == 3
    assert store.read("supplier").count() == 3
    assert store.replace("supplier", base.limit(0)) == 0
    assert store.read("supplier").count() == 0
    assert store.append("supplier", base) == 4 and store.read("supplier").count() == 4


def fill_parents(spark, store, cards, products, suppliers):
    store.append("card", spark.createDataFrame([(c, "1", "a", None, "b", datetime(1990, 1, 1).date()) for c in cards],
                                               store.tables["card"].schema))
    store.append("product", spark.createDataFrame([(p, "p", "v", 1) for p in products], store.tables["product"].schema))
    store.append("supplier", spark.createDataFrame([(s, "s", "i") for s in suppliers], store.tables["supplier"].schema))


def test_rows_that_break_rules_are_set_aside(spark, tmp_path):
    warehouse = jobs.warehouse_store(spark, str(tmp_path))
    warehouse.append("store", spark.createDataFrame([(1, "e", "e", "east")], "store_id long, name string, address string, db_name string"))
    fill_parents(spark, warehouse, [10_000_001], [1, 2, 3, 4, 5], [1])
    day = datetime(2017, 1, 1)
    schema = T.StructType(CHECK_EXTRACT.fields + [T.StructField("db_name", T.StringType())])
    tagged = [(1, 10_000_001, day, True, 1, 2.0, 3.0, 1, 1), (2, 99, day, True, 1, 2.0, 3.0, 1, 1), (3, 10_000_001, day, True, 7, 2.0, 3.0, 2, 1),
              (4, 10_000_001, None, True, 1, 2.0, 3.0, 3, 1), (5, 10_000_001, day, None, 1, None, 3.0, 4, 9),
              (6, 10_000_001, day, True, None, 2.0, 3.0, 77, 1)]
    status = jobs.load_checks(warehouse, spark.createDataFrame([(*t, "east") for t in tagged], schema))
    assert rows(status) == [("sale_fact", "warehouse", 1), ("sale_fact", "warehouse: rejected", 5)]
    assert {r["check_id"]: sorted(r["broken"]) for r in warehouse.rejected("sale_fact").collect()} == {
        2: ["reference: card_id"], 3: ["domain: payment_form"], 4: ["not null: check_date"],
        5: ["not null: payed", "not null: price", "reference: supplier_id"], 6: ["reference: product_id"]}
    assert warehouse.read("sale_fact").count() == 1 and warehouse.read("date").count() == 1


def test_no_row_breaks_a_stored_table(spark, tmp_path):
    branch = jobs.branch_store(spark, str(tmp_path))
    schema = "check_id long, card_id long, check_date timestamp_ntz, payment_form int"

    def checks(*ids, form=1):
        return stamp(spark.createDataFrame([(i, 1, datetime(2017, 1, 1), form) for i in ids], schema), LOADED)

    assert branch.append("check", checks(1, 2)) == 2
    assert {r["payed"] for r in branch.read("check").collect()} == {False}  # the default of an absent column
    for bad in (checks(None), checks(3, form=9), checks(3).withColumn("payed", F.lit(None).cast("boolean")),
                checks(3).drop("check_date")):
        with pytest.raises(Exception, match="not null|domain"):
            branch.append("check", bad)
    with pytest.raises(Exception, match="length"):
        branch.append("supplier", stamp(spark.createDataFrame([(1, "x" * 51, "1")], "supplier_id long, name string, inn string"), LOADED))
    for twice in (checks(5, 5), checks(2)):
        with pytest.raises(DuplicateKeys):
            branch.append("check", twice)
    assert branch.read("check").count() == 2


def test_lines_without_a_price_at_the_target_are_counted(spark, tmp_path):
    warehouse, south = jobs.warehouse_store(spark, f"{tmp_path}/w"), jobs.branch_store(spark, f"{tmp_path}/s")
    warehouse.append("store", spark.createDataFrame([(1, "e", "e", "east")], "store_id long, name string, address string, db_name string"))
    fill_parents(spark, warehouse, [10_000_001], [1, 2], [1])
    schema = T.StructType(CHECK_EXTRACT.fields + [T.StructField("db_name", T.StringType())])
    jobs.load_checks(warehouse, spark.createDataFrame(
        [(1, 10_000_001, datetime(2017, 1, 5), True, 1, 2.0, 3.0, p, 1, "east") for p in (1, 2)], schema))
    south.append("product", stamp(warehouse.read("product"), LOADED))
    south.append("price", stamp(spark.createDataFrame(
        [(1, 1, 5.0, 4.0, datetime(2017, 1, 1))], "price_id long, product_id long, cost double, cost_sale double, set_date timestamp_ntz"), LOADED))
    jobs.send_cards(warehouse, "south", south, "east", now=SENT)
    status = jobs.send_checks(warehouse, "south", south, "east", *WINDOW, now=SENT, reprice=True)
    assert rows(status) == [("check", "south", 1), ("line", "south", 1), ("line", "south: rejected", 1)]
    assert [tuple(r)[:4] for r in south.read("line").collect()] == [(1, 1, 4.0, 3.0)]
    assert [(r["product_id"], r["broken"]) for r in south.rejected("line").collect()] == [(2, ["not null: price"])]


def test_only_files_of_the_window_are_opened(spark, tmp_path):
    warehouse = jobs.warehouse_store(spark, str(tmp_path))
    warehouse.append("store", spark.createDataFrame([(1, "e", "e", "east")], "store_id long, name string, address string, db_name string"))
    fill_parents(spark, warehouse, [10_000_001], [1, 2], [1])
    schema = T.StructType(CHECK_EXTRACT.fields + [T.StructField("db_name", T.StringType())])
    for k in range(4):  # each load lies in a range of receipt numbers and a month of its own
        jobs.load_checks(warehouse, spark.createDataFrame(
            [(k * jobs.CHECK_RANGE, 10_000_001, datetime(2017, 1 + k, 5), True, 1, 2.0, 3.0, p, 1, "east") for p in (1, 2)], schema))
    dates = jobs._dates(warehouse, "2017-02-01", "2017-03-31")
    assert partitions_read(dates, "period") == 2
    sales = jobs.stored_sales(warehouse, "east", "2017-02-01", "2017-03-31")
    assert sales.count() == 4 and partitions_read(sales, "check_range") == 2
    plan = sales._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    assert jobs.stored_sales(warehouse, "east", "2020-01-01", "2020-02-01").count() == 0
    assert jobs.stored_sales(warehouse, "nowhere", "2017-02-01", "2017-03-31").count() == 0
    showcase = jobs.showcase_store(spark, f"{tmp_path}/show")
    assert jobs.find_product_pairs(warehouse, showcase, "2017-02-01", "2017-03-31").first()["rows"] == 1
    assert showcase.read("product_pairs").first()["amount"] == 2


def test_generated_keys(spark, tmp_path):
    branch = jobs.branch_store(spark, str(tmp_path))

    def load(first, last):
        cards = G.cards(spark.range(first, last), 0).withColumnRenamed("card_id", "row")
        jobs.insert_rows(branch, "card", cards, "row", store_id=2, now=LOADED)
        jobs.insert_rows(branch, "supplier", G.suppliers(spark.range(first, last)).withColumnRenamed("supplier_id", "row"), "row", now=LOADED)

    load(0, 5)
    load(100, 103)
    assert sorted(r["card_id"] for r in branch.read("card").collect()) == list(range(20_000_000, 20_000_008))
    assert sorted(r["supplier_id"] for r in branch.read("supplier").collect()) == list(range(1, 9))


def test_arriving_receipts_are_loaded_once(spark, tmp_path):
    warehouse = jobs.warehouse_store(spark, f"{tmp_path}/warehouse")
    warehouse.append("store", spark.createDataFrame([(1, "e", "e", "east")], "store_id long, name string, address string, db_name string"))
    schema = T.StructType(CHECK_EXTRACT.fields + [T.StructField("db_name", T.StringType())])
    fill_parents(spark, warehouse, cards=[10_000_000 + c for c in range(6)], products=[1, 2], suppliers=[1])

    def arrive(checks, db_name):
        spark.createDataFrame([(c, 10_000_000 + c, datetime(2017, 1, 1 + c), True, 1, 2.0, 3.0, p, 1, db_name)
                               for c in checks for p in (1, 2)], schema).write.mode("append").parquet(f"{tmp_path}/in")

    def run():
        arriving = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        follow_checks(warehouse, arriving, f"{tmp_path}/progress").awaitTermination()
        return warehouse.read("sale_fact").count(), warehouse.read("date").count()

    arrive([1, 2], "east")
    assert run() == (4, 2)
    arrive([2, 3], "east")
    arrive([4], "not registered")
    assert run() == (6, 3)
    assert run() == (6, 3)


def test_branches_are_tagged_and_their_copies_collapse(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "id long, v string")
    both = fan_in(["east", "west", "east"], lambda name: rows)
    assert sorted(map(tuple, both.collect())) == [
        (1, "a", "east"), (1, "a", "west"), (2, "b", "east"), (2, "b", "west")]


def test_delimited_rows(spark, tmp_path):
    (tmp_path / "suppliers.csv").write_text("1;one;7801\n2;two;7802\n")
    got = read_rows(spark, f"{tmp_path}/suppliers.csv", SUPPLIER, sep=";")
    assert got.schema.simpleString() == SUPPLIER.schema.simpleString()
    assert sorted(map(tuple, got.collect())) == [(1, "one", "7801"), (2, "two", "7802")]


def test_a_write_that_fails_changes_nothing(spark, tmp_path):
    store = TableStore(spark, str(tmp_path), BRANCH_TABLES)
    store.append("supplier", stamp(G.suppliers(spark.range(4)), LOADED))
    bad = stamp(G.suppliers(spark.range(50)), LOADED).withColumn("name", F.when(F.col("supplier_id") < 49, F.col("name")))
    for write in (store.append, store.replace):
        with pytest.raises(Exception, match="not null"):
            write("supplier", bad)
    assert store.read("supplier").count() == 4
    # a job may read the table it writes
    assert store.replace("supplier", store.read("supplier").where("supplier_id < 2")) == 2
    assert store.read("supplier").count() == 2
