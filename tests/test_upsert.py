from datetime import datetime

import pytest

from tillhouse.operators import upsert as U
from tillhouse.operators.quality import violations
from tillhouse.schemas import BRANCH_TABLES, CARD, CHECK

ROW = "id long, a string, b string"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_source_replaces_whole_rows_also_with_null(spark):
    target = spark.createDataFrame([(1, "x", "y"), (2, "x", "y")], ROW)
    source = spark.createDataFrame([(2, "n", None), (3, None, "n")], ROW)
    once = U.upsert(target, source, ["id"])
    assert rows(once.na.fill("-")) == [(1, "x", "y"), (2, "n", "-"), (3, "-", "n")]
    assert rows(U.upsert(once, source, ["id"]).na.fill("-")) == rows(once.na.fill("-"))


def test_missing_columns_are_kept(spark):
    target = spark.createDataFrame([(1, "x", "y")], ROW)
    source = spark.createDataFrame([(1, None), (2, "n")], "id long, a string")
    assert rows(U.upsert(target, source, ["id"]).na.fill("-")) == [(1, "-", "y"), (2, "n", "-")]


def test_audit_stamps(spark):
    old, new = datetime(2017, 1, 1), datetime(2018, 1, 1)
    target = U.stamp(spark.createDataFrame([(1, "x"), (2, "x")], "id long, a string"), old)
    merged = U.upsert(target, spark.createDataFrame([(2, "n"), (3, "n")], "id long, a string"), ["id"], now=new)
    assert rows(merged) == [(1, "x", old, old), (2, "n", old, new), (3, "n", new, new)]


def test_duplicate_source_key_raises(spark):
    source = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 1, "c")], "x int, y int, v string")
    U.require_unique(source, ["x", "y", "v"])
    with pytest.raises(U.DuplicateKeys):
        U.require_unique(source, ["x", "y"])


def test_table_rules(spark):
    checks = spark.createDataFrame(
        [(1, 1, datetime(2017, 1, 1), True, 1), (1, 2, None, None, 3), (2, 9, datetime(2017, 1, 1), True, None)],
        "check_id long, card_id long, check_date timestamp_ntz, payed boolean, payment_form int")
    cards = spark.createDataFrame([(1,), (2,)], "card_id long")
    found = {(r["rule"], r["column"]): r["violations"] for r in violations(checks, CHECK, {"card": cards}).collect()}
    assert found == {("not null", "check_id"): 0, ("not null", "card_id"): 0, ("not null", "check_date"): 1,
                     ("not null", "payed"): 1, ("unique key", "check_id"): 1, ("domain", "payment_form"): 1,
                     ("reference", "card_id"): 1}


def test_length_rule(spark):
    card = spark.createDataFrame([(1, "4" * 20, "f", None, "l" * 51, None)],
                                 "card_id long, number string, first_name string, middle_name string, "
                                 "last_name string, birth_date date")
    found = {(r["rule"], r["column"]): r["violations"] for r in violations(card, CARD).collect()}
    assert found[("length", "number")] == 1 and found[("length", "last_name")] == 1
    assert found[("length", "first_name")] == 0 and found[("not null", "birth_date")] == 1


def test_branch_tables_have_audit_columns():
    assert all(t.names[-2:] == ["created_at", "modified_at"] for t in BRANCH_TABLES.values())
