"""The jobs between branches, warehouse and showcase.

Each takes table stores and a window, and returns a status frame (entity, target, rows). Rows that break a rule of the table
they are meant for, or refer to a row that the target lacks, are set aside in the target's store (``TableStore.rejected``) and
counted in a status line of their own, "<target>: rejected".

Sending and pulling are upserts or whole replacements, so such a job that failed half-way is simply run again. ``insert_lines`` and
``insert_rows`` add rows: run again after a success, they report the keys as duplicates.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.functions.columns import apply_defaults, conform, in_window, with_targets
from tillhouse.functions.keys import branch_keys, extend_date_dimension, next_keys
from tillhouse.operators import baskets, pricing, shares, slices
from tillhouse.operators.quality import mark_broken
from tillhouse.operators.upsert import merge_into, remove_from, require_unique, stamp
from tillhouse.schemas import (AUDIT, BRANCH_TABLES, CARD, CARD_RANGE, CHECK, LINE, MOMENT, PAIR_COUNTS, PRICE, PRODUCT, PULLED, SALE_FACT, SHOWCASE_TABLES, SUPPLIER,
                               WAREHOUSE_TABLES, Table)
from tillhouse.session import let_go, settle, settle_counted, shuffles_dropped, small_broadcasts
from tillhouse.sources.branches import fan_in
from tillhouse.sources.extracts import changed_checks, new_cards, new_checks, new_products
from tillhouse.sources.tables import TableStore

# Receipts per store and partition of the fact table.
CHECK_RANGE = 10_000_000
# Products per partition of the stored pair counts.
PRODUCT_RANGE = 1_000
# A pull of changes joins its receipts in rounds of so many lines of the branches, but in no more than so many rounds: each reads the branches' files.
LINES_OF_ROUND = 1_000_000
PULL_ROUNDS = 4
STATUS = "entity string, target string, rows long"
WITHOUT_AUDIT = {t.name: t for t in (CARD, CHECK, SUPPLIER, PRODUCT, PRICE, LINE)}  # stamps are set at the write


def branch_store(spark: SparkSession, root: str) -> TableStore:
    """Receipts and their lines are split by the same ranges of receipt numbers."""
    ranges = {"check_range": f"check_id div {CHECK_RANGE}"}
    return TableStore(spark, root, BRANCH_TABLES, {"check": ranges, "line": ranges})


def warehouse_store(spark: SparkSession, root: str) -> TableStore:
    """Cards are split by store; facts by store, range of receipt numbers and month; dates by month. As receipt numbers rise
    with time, a load touches the newest ranges only; a receipt whose date is corrected may move to another month."""
    return TableStore(spark, root, WAREHOUSE_TABLES, {
        "sale_fact": {"store_id": "store_id", "check_range": f"check_id div {CHECK_RANGE}", "period": "period"},
        "card": {"owner": f"card_id div {CARD_RANGE}"},
        "date": {"period": "year * 100 + month"}}, {"sale_fact": ["period"]})


def period_of(c: str) -> Column:
    """Year and month as one number."""
    return (F.year(c) * 100 + F.month(c)).cast("long")


def showcase_store(spark: SparkSession, root: str) -> TableStore:
    """Pair counts are split by ranges of product numbers, so that new receipts change the ranges of their products only."""
    return TableStore(spark, root, SHOWCASE_TABLES, {"pair_counts": {"product_range": f"product_id div {PRODUCT_RANGE}"}})


def moment_of_batch() -> datetime:
    return datetime.now(timezone.utc)


def _parents(store: TableStore, entity: str) -> dict[str, DataFrame]:
    """Tables that the rows of an entity refer to."""
    return {parent: store.read(parent) for parent in set(store.tables[entity].references.values())}


def _accept(store: TableStore, entity: str, target: str, rows: DataFrame, table: Table | None = None,
            parents: dict[str, DataFrame] | None = None) -> tuple[DataFrame, int, list[tuple]]:
    """Rows that obey all rules, computed once (``let_go`` takes them), their number, and the status of the others, which are set aside. Both are
    counted by the write."""
    fails = F.size("broken") > 0
    marked, n = settle_counted(mark_broken(rows, table or store.tables[entity], parents or _parents(store, entity)),
                               F.count_if(fails).alias("bad"), F.count_if(~fails).alias("good"), packed=True)
    good = marked.where(~fails).drop("broken")
    good.settled_in = marked.settled_in
    if not n.get("bad"):
        return good, n.get("good", 0), []
    return good, n["good"], [(entity, f"{target}: rejected", store.reject(entity, conform(
        marked.where(fails), T.StructType([*store.tables[entity].schema, T.StructField("broken", T.ArrayType(T.StringType()))]))))]


def _send(entity: str, rows: DataFrame, targets: dict[str, TableStore], now: datetime) -> list[tuple]:
    """Upsert the same rows into each target. They are computed once; each target's own parents decide on references."""
    rows = settle(rows)
    table = WITHOUT_AUDIT[entity]
    require_unique(rows, list(table.key))
    sent = []
    for name, store in targets.items():
        good, n, lost = _accept(store, entity, name, apply_defaults(rows, table.defaults), table)
        merge_into(store, store.tables[entity], good, now, checked=True)
        sent += [(entity, name, n), *lost]
    return sent


def branch_group(spark: SparkSession, root: str) -> TableStore:
    """The tables of many branches as one: the branch's name is the first partition column and part of every key, so one write
    reaches all of them."""
    ranges = {"check_range": f"check_id div {CHECK_RANGE}"}
    tables = {n: replace(t, columns=(("db_name", T.StringType(), False), *t.columns), key=("db_name", *t.key)) for n, t in BRANCH_TABLES.items()}
    return TableStore(spark, root, tables, {n: {"db_name": "db_name", **(ranges if n in ("check", "line") else {})} for n in tables})


def member(group: TableStore, name: str) -> TableStore:
    """One branch of a group; its tables are partitions of the group's."""
    split = {n: {c: e for c, e in s.items() if c != "db_name"} for n, s in group.split_by.items()}
    return TableStore(group.spark, group.root, BRANCH_TABLES, {n: s for n, s in split.items() if s}, within=f"db_name={name}")


def send_to_all(entity: str, rows: DataFrame, group: TableStore, names: list[str], now: datetime) -> list[tuple]:
    """Upsert the same rows into many branches by one plan: one join with the keys of all, one write. Each branch's own parents
    decide on references. Status rows are counted while the rows are marked."""
    table = group.tables[entity]
    given = replace(table, columns=tuple(c for c in table.columns if c[0] not in AUDIT))
    tagged = with_targets(apply_defaults(rows, table.defaults), names, "db_name")
    parents = {p: group.scan(p).where(F.col("db_name").isin(names)) for p in set(table.references.values())}
    fails = F.size("broken") > 0
    marked, n = settle_counted(mark_broken(tagged, given, parents, same=["db_name"]), *(
        F.count_if(F.col("db_name").eqNullSafe(F.lit(name)) & (fails if bad else ~fails)).alias(f"{name}{bad}") for name in names for bad in ("", ": rejected")))
    require_unique(marked, list(table.key))
    if any(n.get(f"{name}: rejected") for name in names):
        group.reject(entity, conform(marked.where(fails), T.StructType([*table.schema, T.StructField("broken", T.ArrayType(T.StringType()))])))
    merge_into(group, table, marked.where(~fails).drop("broken"), now, checked=True)
    return [(entity, f"{name}{bad}", n.get(f"{name}{bad}", 0)) for name in names for bad in ("", ": rejected")
            if not bad or n.get(f"{name}{bad}")]


def publish_to_all(source: TableStore, group: TableStore, names: list[str], start, end, now: datetime | None = None,
                   change_column: str = "created_at") -> DataFrame:
    """``publish_products`` to the branches of a group: one write per entity, however many branches."""
    now = now or moment_of_batch()
    extract = settle(new_products(source.read("price"), source.read("product"), source.read("supplier"), start, end, change_column))
    sent = []
    for entity, rows in (("supplier", shares.supplier_rows), ("product", shares.product_rows), ("price", shares.price_rows)):
        sent += send_to_all(entity, rows(extract), group, names, now)
    return _status(source.spark, sent)


def _status(spark: SparkSession, sent: list[tuple]) -> DataFrame:
    return spark.createDataFrame(sent, STATUS).distinct()


def _dates(warehouse: TableStore, start, end) -> DataFrame:
    """The date dimension in the months of the window."""
    first, last = (datetime.fromisoformat(str(t)) for t in (start, end))
    return warehouse.scan("date").where(F.col("period").between(first.year * 100 + first.month, last.year * 100 + last.month))


def insert_lines(branch: TableStore, line: DataFrame, now: datetime | None = None) -> DataFrame:
    """Add sale lines to a branch. The price that held at the receipt date replaces any price given,
    and the audit stamps are set. A key that exists already is an error. Returns the lines that are not written, with the
    rules they break: no price, no receipt, or a missing value."""
    line = apply_defaults(line, LINE.defaults)
    heads = branch.within("check", branch.parts_of("line", branch.split("line", line.where(F.col("check_id").isNotNull()))))
    priced = pricing.price_lines(line, heads, branch.read("price"))
    marked = settle(mark_broken(priced, LINE, {"check": heads}))
    branch.append("line", stamp(marked.where(F.size("broken") == 0), now or moment_of_batch()))
    return marked.where(F.size("broken") > 0)


def insert_rows(branch: TableStore, entity: str, rows: DataFrame, order: str, store_id: int = 0,
                now: datetime | None = None) -> DataFrame:
    """Add base rows to a branch and generate their keys where the rows have none: card keys in the range of the store,
    others from 1 on, always after the highest stored key and in the order of ``order``, a unique non-negative number.
    Returns (entity, target, rows) as the jobs do, with rejected rows in a line of their own."""
    table = WITHOUT_AUDIT[entity]
    key = table.key[0]
    if key not in rows.columns:
        stored = branch.read(entity)
        if entity == "card":
            owned = rows.withColumn("_store", F.lit(store_id).cast("long"))
            rows = branch_keys(owned, "_store", order, key, existing=stored)
        else:
            rows = next_keys(rows, order, key, stored)
    rows = conform(apply_defaults(rows, table.defaults), table.schema)
    good, _, lost = _accept(branch, entity, "branch", rows, table)
    added = branch.append(entity, stamp(good, now or moment_of_batch()))
    return _status(branch.spark, [(entity, "branch", added), *lost])


def publish_products(source: TableStore, targets: dict[str, TableStore], start, end,
                     now: datetime | None = None, change_column: str = "created_at") -> DataFrame:
    """Send one branch's products, suppliers and prices to other databases, parents first."""
    now = now or moment_of_batch()
    extract = settle(new_products(source.read("price"), source.read("product"), source.read("supplier"),
                                  start, end, change_column))
    sent = _send("supplier", shares.supplier_rows(extract), targets, now)
    sent += _send("product", shares.product_rows(extract), targets, now)
    sent += _send("price", shares.price_rows(extract), targets, now)
    return _status(source.spark, sent)


def pull_cards(warehouse: TableStore, branches: dict[str, TableStore], start, end) -> DataFrame:
    """Bring the branches' new cards to the warehouse; their keys lie in ranges of their own."""
    tagged = fan_in(list(branches), lambda n: new_cards(branches[n].read("card"), start, end), keyed=True)
    rows = tagged.where(F.col("card_id").isNotNull()).drop("db_name")
    return _status(warehouse.spark, _send("card", rows, {"warehouse": warehouse}, moment_of_batch()))


def pull_checks(warehouse: TableStore, branches: dict[str, TableStore], start, end) -> DataFrame:
    """Bring the branches' receipts to the fact table. The rows of all branches are put together by kind and joined once, branch and number
    being their key: one plan of few joins, and at most one broadcast a join, however many branches."""
    def lines(name: str) -> DataFrame:
        # Only the ranges that hold a receipt of the window: the other lines are not opened. A range is one row.
        ranges = branches[name].scan("check").where(in_window("check_date", start, end)).select("check_range").distinct()
        return branches[name].scan("line").join(F.broadcast(ranges), "check_range", "left_semi")

    return load_checks(warehouse, new_checks(_of_all(branches, "check"), fan_in(list(branches), lines, keyed=True), _of_all(branches, "product"),
                                             start, end, tags=("db_name",)))


def _of_all(branches: dict[str, TableStore], entity: str) -> DataFrame:
    """A table of all branches, each row with its branch's name."""
    return fan_in(list(branches), lambda n: branches[n].scan(entity), keyed=True)


def pull_changes(warehouse: TableStore, branches: dict[str, TableStore], overlap: timedelta = timedelta(hours=1)) -> DataFrame:
    """Bring what the branches stamped since the last pull to the fact table, without a window: the latest stamp that was pulled is kept per
    branch. A row may become visible after a later stamped one, so each pull goes back by ``overlap``; rows from before the mark that the fact
    lacked are counted as late. The mark moves only after the load, so a pull that failed is simply run again."""
    with small_broadcasts(warehouse.spark):
        return _pull_changes(warehouse, branches, overlap)


def _pull_changes(warehouse: TableStore, branches: dict[str, TableStore], overlap: timedelta) -> DataFrame:
    entity = "sale_fact"
    marks = {r["db_name"]: r["mark"] for r in warehouse.read("pulled").where(F.col("entity") == entity).collect()}  # a row per branch

    def mark(less: timedelta) -> Column:
        """The branch's mark, or NULL where nothing was pulled from it yet."""
        known = [F.when(F.col("db_name") == n, F.lit(marks[n] - less)) for n in branches if n in marks]
        return F.coalesce(*known, F.lit(None).cast("timestamp"))

    # the rows of all branches are joined once, as in pull_checks: a join for each branch would broadcast its products, and small heads, for each at once
    check, line, product = (_of_all(branches, t) for t in ("check", "line", "product"))
    rounds = max(1, min(PULL_ROUNDS, -(-line.count() // LINES_OF_ROUND)))
    taken = []
    for number in range(rounds):  # whole receipts, so that the shuffles of few of them are on disk at once
        own = F.pmod(F.hash("check_id"), F.lit(rounds)) == number
        changed = changed_checks(check.where(own), line.where(own), product, mark(overlap) if marks else None, tags=("db_name",))
        taken.append(settle(changed.withColumn("early", F.coalesce(F.col("stamp") <= mark(timedelta(0)), F.lit(False))), packed=True))
    tagged = reduce(DataFrame.unionByName, taken)
    known = warehouse.read("store").select("store_id", "db_name")
    early = tagged.where("early").select("db_name", "check_id", "product_id").join(known, "db_name")
    with shuffles_dropped(warehouse.spark):
        late = early.join(warehouse.read("sale_fact"), list(SALE_FACT.key), "left_anti").count()
        reached = tagged.groupBy("db_name").agg(F.max("stamp").alias("mark")).collect()  # a row per branch
    newer = [(r["db_name"], entity, max(r["mark"], marks.get(r["db_name"], r["mark"]))) for r in reached]
    status = load_checks(warehouse, tagged.drop("stamp", "early"), spent=tuple(taken))
    if newer:
        merge_into(warehouse, PULLED, warehouse.spark.createDataFrame(newer, PULLED.schema))
    return status.unionByName(_status(warehouse.spark, [(entity, "warehouse: late", late)]))


def load_checks(warehouse: TableStore, tagged: DataFrame, spent: tuple[DataFrame, ...] = ()) -> DataFrame:
    """Upsert tagged receipt lines into the fact; new timestamps get date keys first. Rows of a
    source that is not in the store table are left out. ``spent`` are settled frames that only ``tagged`` reads: of the copies that the steps write, no more
    are kept than the next step reads."""
    known = warehouse.read("store").select("store_id", "db_name")
    rows = tagged.where(F.col("check_id").isNotNull()).join(known, "db_name").drop("db_name")
    # the date key is made here, so its rule is that the receipt has a date
    table = replace(SALE_FACT, columns=tuple(("check_date", MOMENT, False) if n == "date_id" else (n, t, null)
                                             for n, t, null in SALE_FACT.columns))
    parents = {p: warehouse.read(p) for p in ("product", "card", "supplier")}
    rows, n, lost = _accept(warehouse, "sale_fact", "warehouse", apply_defaults(rows, SALE_FACT.defaults), table, parents)
    let_go(*spent)
    periods = warehouse.parts_of("date", rows.select(period_of("check_date").alias("period")))
    top = warehouse.read("date").agg(F.max("date_id")).first()[0]
    added = settle(extend_date_dimension(warehouse.within("date", periods), rows, "check_date", top=top or 0))
    warehouse.append("date", added, checked=True)
    fact = settle(date_rows(rows, warehouse.within("date", periods), period_of("check_date").alias("period")), packed=True)
    let_go(rows, added)
    merge_into(warehouse, SALE_FACT, fact, spent=(fact,))
    return _status(warehouse.spark, [("sale_fact", "warehouse", n), *lost])


def date_rows(rows: DataFrame, date: DataFrame, *more: Column) -> DataFrame:
    """Replace the receipt timestamp by its date key."""
    keys = date.select("date_id", F.col("date").alias("check_date"))
    return rows.join(keys, "check_date").select(*SALE_FACT.names, *more)


def send_cards(warehouse: TableStore, target_name: str, target: TableStore, db_name: str,
               now: datetime | None = None) -> DataFrame:
    """Send the cards of one store to a branch."""
    one = slices.find_store(warehouse.read("store"), db_name).select("store_id")
    own = warehouse.scan("card").where(F.col("owner") == one.scalar())
    rows = slices.cards_of_store(own, warehouse.read("store"), db_name)
    return _status(warehouse.spark, _send("card", rows, {target_name: target}, now or moment_of_batch()))


def stored_sales(warehouse: TableStore, db_name: str, start, end) -> DataFrame:
    """The store's fact rows in the window; only the folders of this store and these months are opened."""
    return slices.sales_of_store(warehouse.scan("sale_fact"), warehouse.read("store"), _dates(warehouse, start, end), db_name, start, end)


def send_checks(warehouse: TableStore, target_name: str, target: TableStore, db_name: str, start, end,
                now: datetime | None = None, reprice: bool = False) -> DataFrame:
    """Send the receipts of one store to a branch, as headers and lines. With ``reprice`` the branch's
    own price at the receipt date replaces the price that was sent."""
    now = now or moment_of_batch()
    sales = settle(stored_sales(warehouse, db_name, start, end))
    sent = _send("check", slices.check_headers(sales), {target_name: target}, now)
    lines = slices.check_lines(sales)
    if reprice:  # a line without a price at the target breaks NOT NULL there, so it is set aside and counted
        heads = target.within("check", target.parts_of("check", target.split("line", lines)))
        lines = pricing.price_lines(lines, heads, target.read("price")).drop("check_date")
    return _status(warehouse.spark, sent + _send("line", lines, {target_name: target}, now))


def find_product_pairs(warehouse: TableStore, showcase: TableStore, start, end) -> DataFrame:
    """Count the products bought together in the window and replace the showcase table. An empty
    window empties the table."""
    dates = _dates(warehouse, start, end)
    sales = baskets.dated_sales(warehouse.scan("sale_fact"), dates, start, end)
    # a stored table has no order, so the report is sorted where it is read
    pairs = baskets.name_pairs(baskets.pair_counts(sales), warehouse.read("product"), warehouse.read("supplier"))
    rows = showcase.replace("product_pairs", pairs)
    return _status(warehouse.spark, [("product_pairs", "showcase", rows)])


def load_receipts(warehouse: TableStore, showcase: TableStore, tagged: DataFrame) -> DataFrame:
    """Load whole receipts and keep the stored pair counts of all facts right without counting anew. A line that the fact has and the load of its
    receipt lacks is taken out. Only the pairs of the loaded receipts are made: those they had before count down, those they have now count up."""
    known = warehouse.read("store").select("store_id", "db_name")
    given = settle(tagged.join(known, "db_name"))
    receipts = settle(given.select(*baskets.BASKET).distinct())

    def lines() -> DataFrame:
        return settle(warehouse.read("sale_fact").join(receipts, baskets.BASKET, "left_semi"))

    before = lines()
    status = load_checks(warehouse, given.drop("store_id"))
    gone = settle(before.select(*SALE_FACT.key).join(given, list(SALE_FACT.key), "left_anti"))
    removed = remove_from(warehouse, SALE_FACT, gone)
    changes = settle(showcase.split("pair_counts", baskets.pair_changes(before, lines())))
    parts = showcase.parts_of("pair_counts", changes)
    if parts:
        held = showcase.within("pair_counts", parts)
        showcase.replace_parts("pair_counts", baskets.merge_counts(held, changes), parts)
    return status.unionByName(_status(warehouse.spark, [("sale_fact", "warehouse: removed", removed)]))
