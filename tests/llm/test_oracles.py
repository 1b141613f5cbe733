"""Queries against their SQL, over the given tables and a small one with hard rows."""

import duckdb
import pytest

from compare import compare, connect
from tillhouse.llm import oracles, queries


@pytest.mark.parametrize("name", list(oracles.ORACLES))
def test_against_sql(spark, folder, name):
    assert compare(spark, connect(folder), folder, queries.QUERIES[name], oracles.ORACLES[name]) == ""


def test_against_sql_on_hard_rows(spark, tmp_path):
    con = duckdb.connect()
    texts = ["a b c d e f g h i j", "A b c d e f g h i j", "a b c d e f g h i j k", "x", "x", "", None, "  \n", "p q r", "P q\tr", "é É é"] * 2
    rows = [(i, t, "en" if i % 3 else None, "a" if i % 2 else "b") for i, t in enumerate(texts)]
    vectors = [(1, [1.0, 0.0], 1), (2, [2.0, 0.1], 1), (3, [1.0, 0.0], None), (4, None, 1), (5, [0.0, 0.0], 1), (6, [float("nan"), 1.0], 1),
               (7, [1.0, 0.2], 1), (8, [1.0, 0.0], 2), (9, [1.0, 0.3], 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    for name in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    for name, sql in oracles.ORACLES.items():
        assert compare(spark, con, str(tmp_path), queries.QUERIES[name], sql) == "", name
