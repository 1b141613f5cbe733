import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tillhouse.operators import pricing
from tillhouse.operators.heavy import heavy_keys

DAY = datetime(2017, 1, 1)


def brute(lines, prices):
    best = {}
    for check, product, at in lines:
        known = [(d, i, c) for i, p, c, d in prices if p == product and d <= at]
        best[(check, product)] = max(known)[2] if known else None
    return best


def frames(spark, lines, prices):
    line = spark.createDataFrame(lines, "check_id long, product_id long, check_date timestamp_ntz")
    price = spark.createDataFrame(prices, "price_id long, product_id long, cost_sale double, set_date timestamp_ntz")
    return line.withColumn("price", F.lit(-1.0)), price


def random_case(seed, hot):
    """A third of the lines and of the revisions belong to one product; ``hot`` puts most in one minute."""
    rng = random.Random(seed)
    span = timedelta(seconds=20) if hot else timedelta(days=300)

    def at():
        return DAY + timedelta(days=5) + span * rng.random()

    lines = [(i, 1 if i % 3 == 0 else rng.randint(2, 30), at()) for i in range(600)]
    prices = [(i, 1 if i % 3 == 0 else rng.randint(2, 30), float(i), at()) for i in range(300)]
    prices += [(1000 + i, 1 + i % 30, 5000.0 + i, prices[i][3]) for i in range(60)]
    lines += [(2000 + i, prices[i][1], prices[i][3]) for i in range(100)]
    return lines, prices


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("least", [1, 15, 10**6])
def test_asof_equals_brute_force(spark, least, seed, hot):
    lines, prices = random_case(seed, hot)
    line, price = frames(spark, lines, prices)
    priced = pricing.asof_price(line, price, least=least)
    assert set(priced.columns) == {"check_id", "product_id", "check_date", "price"}
    got = [(r["check_id"], r["product_id"], r["price"]) for r in priced.collect()]
    assert len(got) == len(lines)
    expected = brute(lines, prices)
    assert {(c, p): v for c, p, v in got} == expected
    lost = pricing.before_first_price(line, price).select("check_id", "product_id").collect()
    assert {tuple(r) for r in lost} == {k for k, v in expected.items() if v is None}
    assert any(v is None for v in expected.values()) and any(v is not None for v in expected.values())


@pytest.mark.parametrize("hot", [False, True])
def test_only_a_busy_minute_is_dealt_to_pieces(spark, monkeypatch, hot):
    """Both rounds of the search for heavy keys, and the right rows whichever of them finds any."""
    lines, prices = random_case(6, hot)
    line, price = frames(spark, lines, prices)
    found = []

    def spy(*args):
        found.append(heavy_keys(*args))
        return found[-1]

    monkeypatch.setattr(pricing, "heavy_keys", spy)
    got = pricing.asof_price(line, price, least=60).collect()
    assert {(r["check_id"], r["product_id"]): r["price"] for r in got} == brute(lines, prices)
    assert len(found) == 2 and not found[0].isEmpty() and found[1].isEmpty() != hot


def test_copies_of_one_line_are_all_kept(spark):
    lines = [(7, 1, DAY + timedelta(days=1))] * 50
    line, price = frames(spark, lines, [(1, 1, 9.5, DAY)])
    for least in (10, 10**6):
        assert [r["price"] for r in pricing.asof_price(line, price, least=least).collect()] == [9.5] * 50


def test_split_product_is_dealt_to_many_groups(spark):
    lines, prices = random_case(3, False)
    line, price = frames(spark, lines, prices)
    heavy = heavy_keys(line.select("product_id"), ["product_id"], least=50)
    assert [r["product_id"] for r in heavy.collect()] == [1]
    assert heavy_keys(line.select("product_id"), ["product_id"], least=5000).isEmpty()


def test_all_heavy_keys_are_listed(spark):
    keys = spark.range(3000).select((F.col("id") % 1500).alias("k"))
    found = heavy_keys(keys, ["k"], least=1).collect()
    assert sorted(r["k"] for r in found) == list(range(1500)) and {r["pieces"] for r in found} == {2}


def test_price_without_a_date_is_ignored(spark):
    line, price = frames(spark, [(1, 1, DAY)], [(1, 1, 7.0, None)])
    assert [r["price"] for r in pricing.asof_price(line, price).collect()] == [None]


@pytest.mark.parametrize("least", [10**6, 1])
def test_line_without_a_date_has_no_price(spark, least):
    line, price = frames(spark, [(1, 1, None), (2, 1, DAY), (3, 1, DAY)], [(1, 1, 9.5, DAY), (2, 1, 8.5, DAY - timedelta(1))])
    got = {r["check_id"]: r["price"] for r in pricing.asof_price(line, price, least=least).collect()}
    assert got == {1: None, 2: 9.5, 3: 9.5}
    assert [r["check_id"] for r in pricing.before_first_price(line, price).collect()] == [1]


def test_product_without_any_price(spark):
    line, price = frames(spark, [(1, 8, DAY), (2, 1, DAY)], [(1, 1, 9.5, DAY)])
    assert [r["check_id"] for r in pricing.before_first_price(line, price).collect()] == [1]
    for least in (1, 10**6):
        assert {r["check_id"]: r["price"] for r in pricing.asof_price(line, price, least).collect()} == {1: None, 2: 9.5}


def test_tie_takes_the_higher_price_id(spark):
    _, price = frames(spark, [(1, 1, DAY)], [(1, 1, 10.0, DAY), (5, 1, 3.0, DAY), (4, 1, 7.0, DAY)])
    assert pricing.latest_price(price).first()["cost_sale"] == 3.0
