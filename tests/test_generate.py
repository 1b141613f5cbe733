from pyspark.sql import functions as F

from tillhouse.operators import generate as G


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def ids(spark, n, parts=3):
    return spark.range(n).repartition(parts).select("id")


def test_result_does_not_depend_on_partitioning(spark):
    for build in (lambda i: G.cards(i, 10), lambda i: G.baskets(i, 50), lambda i: G.prices(i, i, 50)):
        assert rows(build(ids(spark, 200, 2))) == rows(build(ids(spark, 200, 7)))


def test_unique_columns_are_unique_also_past_the_prime(spark):
    both = ids(spark, 5000).union(spark.range(G.PRIME, G.PRIME + 5000))
    assert G.cards(both, 0).select("number").distinct().count() == 10_000
    assert G.products(both, 20).select("vendor_code").distinct().count() == 10_000


def test_baskets(spark):
    for total in (1, 3, 50):
        df = G.baskets(ids(spark, 3000), total)
        sizes = df.groupBy("check_id").agg(F.count("*").alias("n"), F.countDistinct("product_id").alias("d"))
        assert sizes.where("n <> d").count() == 0 and sizes.count() == 3000
        assert {r["n"] for r in sizes.select("n").distinct().collect()} == set(range(1, min(5, total) + 1))
        low, high = df.agg(F.min("product_id"), F.max("product_id")).first()
        assert (low, high) == (0, total - 1)
        assert {r[0] for r in df.select("cnt").distinct().collect()} == {1.0, 2.0, 3.0, 4.0, 5.0}


def test_checks_and_prices(spark):
    checks = G.checks(ids(spark, 5000), 50, 10_000_000)
    low, high, first, last = checks.agg(
        F.min("card_id"), F.max("card_id"), F.min("check_date"), F.max("check_date")).first()
    assert (low, high) == (10_000_000, 10_000_049)
    assert first.year == last.year == 2017
    prices = G.prices(ids(spark, 50), ids(spark, 500), 50)
    assert prices.where("set_date = timestamp_ntz'2017-01-01 00:00:00'").select("product_id").distinct().count() == 50
    assert prices.where("cost_sale > cost * 0.8 or cost_sale > cost or product_id not between 0 and 49").count() == 0
