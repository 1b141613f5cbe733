"""The pipeline and its stages."""

import os
import subprocess
import sys
from collections import Counter

import brute
import corpus_pipeline
from tillhouse.llm import packing, quality, queries, toxicity


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "toxicity", "ngram_join", "best_fit_packing"]


def test_run_against_the_stages_one_by_one(spark, folder, docs):
    kept = {r.doc_id for r in quality.judge(docs).where("kept").collect()}
    rows = [r for r in docs.collect() if r.doc_id in kept]
    now = spark.createDataFrame(rows, docs.schema)
    model = toxicity.fit(now.where(~toxicity.held_out()), spark.read.parquet(f"{folder}/labels.parquet"))
    rows = [r for r in rows if model.score(r.text) < toxicity.THRESHOLD]
    similar = brute.similar([(r.doc_id, r.text) for r in rows], 5, 80)
    rows = [r for r in rows if similar[r.doc_id][1] == r.doc_id]
    want = packing.token_pieces(spark.createDataFrame(rows, docs.schema), queries.WORD_BPE, end_id=0).collect()
    got = corpus_pipeline.run(spark, folder).collect()
    assert Counter((r.doc_id, r.piece, r.length, r.ids_crc32) for r in got) == Counter(
        (r.doc_id, r.piece, r.length, r.ids_crc32) for r in want)
    assert 0 < len(rows) < docs.count()


def test_stages_keep_rows_as_they_are(spark, folder, docs, odd_docs, no_docs, tmp_path):
    spark.read.parquet(f"{folder}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    for table in (docs, odd_docs, no_docs):
        before = Counter(map(tuple, table.collect()))
        for name, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, table, str(tmp_path))
            assert after.dtypes == table.dtypes, name
            assert not Counter(map(tuple, after.collect())) - before, name


def test_rows_that_share_an_id_and_nothing_else_stay(spark, no_docs):
    rows = [(1, "a b c d e f g", "en", "s", 1), (1, "quite another text of one id here", "en", "s", 2), (2, "a b c d e f g", "en", "s", 1),
            (3, None, None, None, None), (None, "a b c d e f g", "en", "s", 1), (4, "h i j", "en", "s", 1), (4, "h i j", "en", "s", 1)]
    got = corpus_pipeline.one_of_each_group(spark, spark.createDataFrame(rows, no_docs.schema), "").collect()
    assert {r.text for r in got if r.doc_id == 1} == {"a b c d e f g", "quite another text of one id here"}
    assert Counter(r.doc_id for r in got) == Counter([1, 1, 3, None, 4])


def test_the_rest_works_without_these_folders(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for name in os.listdir(root):
        if name not in ("corpus_pipeline.py", "tillhouse", ".git"):
            os.symlink(os.path.join(root, name), tmp_path / name)
    os.unlink(tmp_path / "__spark_entry__.py")
    with open(os.path.join(root, "__spark_entry__.py")) as source:
        (tmp_path / "__spark_entry__.py").write_text(source.read())
    (tmp_path / "tillhouse").mkdir()
    for name in os.listdir(os.path.join(root, "tillhouse")):
        if name != "llm":
            os.symlink(os.path.join(root, "tillhouse", name), tmp_path / "tillhouse" / name)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'product_pairs' in q and not [n for n in q if n.startswith('op')]"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})
