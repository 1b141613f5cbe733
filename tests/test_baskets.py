import random
from collections import Counter
from itertools import combinations

import pytest

from tillhouse.operators import baskets

SALES = "store_id long, check_id long, product_id long, supplier_id long"


def case(seed):
    """One basket holds a third of all rows; the same receipt number occurs in two stores."""
    rng = random.Random(seed)
    rows = [(1, 999, p, p % 4) for p in range(100)]
    for check in range(40):
        for store in (1, 2):
            rows += [(store, check, p, rng.randint(0, 3)) for p in rng.sample(range(30), rng.randint(1, 5))]
    return rows


def brute(rows):
    by_basket = {}
    for store, check, product, supplier in rows:
        by_basket.setdefault((store, check), []).append((product, supplier))
    pairs = Counter()
    for basket in by_basket.values():
        for low, high in combinations(sorted(basket), 2):
            pairs[(*high, *low)] += 1
    return pairs


def counted(df):
    return Counter({tuple(r[c] for c in baskets.PAIR): r["amount"] for r in df.collect()})


@pytest.mark.parametrize("block", [1, 4, 7, 60, 2000])
def test_pairs_equal_brute_force(spark, block):
    rows = case(block)
    assert counted(baskets.pair_counts(spark.createDataFrame(rows, SALES), block)) == brute(rows)


def test_many_large_baskets(spark):
    rows = case(5)
    assert counted(baskets.pair_counts(spark.createDataFrame(rows, SALES), 2)) == brute(rows)


def test_total_is_the_number_of_pairs_in_all_baskets(spark):
    rows = case(8)
    sizes = Counter((s, c) for s, c, _, _ in rows)
    total = sum(counted(baskets.pair_counts(spark.createDataFrame(rows, SALES))).values())
    assert total == sum(n * (n - 1) // 2 for n in sizes.values())


def test_empty(spark):
    assert baskets.pair_counts(spark.createDataFrame([], SALES)).count() == 0


def test_report_is_sorted_and_named(spark):
    rows = case(9)
    product = spark.createDataFrame([(p, "same name", f"v{p}") for p in range(100)], "product_id long, name string, vendor_code string")
    supplier = spark.createDataFrame([(s, f"s{s}") for s in range(4)], "supplier_id long, name string")
    got = baskets.product_pairs(spark.createDataFrame(rows, SALES), product, supplier).collect()
    assert len(got) == len(brute(rows))
    assert [r["amount"] for r in got] == sorted((r["amount"] for r in got), reverse=True)
    assert all(r["vendor_code_2"] == f"v{r['product_id_2']}" for r in got)
