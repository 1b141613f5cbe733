"""Quality rules: fixed rules, then robust multivariate outliers per language and source.

Each document becomes a vector of transformed statistics (``VECTOR``). For each cell, a language and source with at least
``MIN_ROWS`` documents that pass the fixed rules, a minimum-covariance-determinant estimate is made: from medians
and median deviations on, concentration steps take the ``SUPPORT`` share of rows that lie nearest by Mahalanobis
distance and estimate mean and covariance anew, until the determinants no longer fall; then one reweighted estimate from all
rows within the 97.5 % ellipse. Documents beyond the ``1 - REJECT_P`` quantile of chi-square are rejected.

Every step is an aggregate over all rows with partial sums before the shuffle, so a source with a third of all rows is
no heavier than others; what is handed around is one small row per cell. Smaller cells are pooled per language, and
what is still too small over all languages; a pool below ``MIN_ROWS`` rejects nothing by distance.

Most clean texts have no symbols, no repeated line and no repeated window, so the plain covariance is singular. ``FLOOR``, a
standard deviation per statistic that is never held against a text, is added to the diagonal.

Defined results: a null or empty text has no words and fails the fixed rules; null language or source is a value of its
own; repeated rows are judged each; an empty table gives no rows.
"""

from __future__ import annotations

from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.llm.memory import trimmed
from tillhouse.llm.text_stats import NAMES, text_stats
from tillhouse.session import settle

VECTOR = ["log_words", "word_length", "symbol_rate", "dup_line_rate", "repeat_share"]
FLOOR = [0.3, 0.3, 0.5, 1.0, 0.1]
SUPPORT = 0.75
MOST_STEPS = 6
MIN_ROWS = 50
REJECT_P = 1e-6
MIN_WORDS = 20
MOST_REPEATED_PERCENT = 30
RANK_ACCURACY = 2000  # the support is met up to this fraction of the rows
CELL = ["cell_lang", "cell_source"]


def chi2_quantile(q: float, p: int) -> float:
    """Wilson-Hilferty."""
    return p * (1 - 2 / (9 * p) + NormalDist().inv_cdf(q) * (2 / (9 * p)) ** 0.5) ** 3


def chi2_cdf(x: float, p: int) -> float:
    return NormalDist().cdf(((x / p) ** (1 / 3) - (1 - 2 / (9 * p))) / (2 / (9 * p)) ** 0.5)


def consistency(share: float, p: int) -> float:
    """Factor by which the covariance of the nearest ``share`` of normal rows is too small."""
    return share / chi2_cdf(chi2_quantile(share, p), p + 2)


def statistics(docs: DataFrame, *, text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """``docs`` without its text, and the integer statistics ``NAMES`` of every whole text. With ``row_col`` the text is a field of
    that struct, which stays whole."""
    kept = [c for c in docs.columns if row_col or c != text_col]
    schema = T.StructType([*(docs.schema[c] for c in kept), *(T.StructField(n, T.LongType()) for n in NAMES)])

    @trimmed
    def count(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                texts = pc.struct_field(batch.column(row_col), [text_col]) if row_col else batch.column(batch.num_columns - 1)
                found = np.array([text_stats(t) for t in texts.to_pylist()], np.int64).reshape(-1, len(NAMES))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:len(kept)], *(pa.array(found[:, k]) for k in range(len(NAMES)))], names=[*kept, *NAMES])

    return docs.select(*kept, *([] if row_col else [F.col(text_col).cast("string")])).mapInArrow(count, schema)


def _vectors(stats: DataFrame) -> DataFrame:
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return stats.withColumns({
        "base_failed": (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")),
        "log_words": F.log(n), "word_length": F.col("word_chars") / n,
        "symbol_rate": F.log1p(100 * F.col("n_symbols") / n),
        "dup_line_rate": F.log1p(1000 * F.col("n_dup_lines") / n),
        "repeat_share": F.col("n_repeat_words") / n})


def _cells(rows: DataFrame, min_rows: int) -> DataFrame:
    """``CELL`` of each (lang, source): itself if large enough, else pooled per language, else pooled over all."""
    sizes = rows.groupBy("lang_key", "source_key").agg(F.sum((~F.col("base_failed")).cast("long")).alias("n"))
    large = F.col("n") >= min_rows
    small = F.sum(F.when(~large, F.col("n")).otherwise(0)).over(Window.partitionBy("lang_key"))
    return sizes.withColumn("pooled", small).select(
        "lang_key", "source_key",
        F.when(large | (F.col("pooled") >= min_rows), F.col("lang_key")).otherwise("").alias("cell_lang"),
        F.when(large, F.col("source_key")).otherwise("").alias("cell_source"))


def _distance(center: str = "center", precision: str = "precision"):
    p = len(VECTOR)
    z = [F.col(v) - F.col(center)[i] for i, v in enumerate(VECTOR)]
    terms = [(1 if i == j else 2) * F.col(precision)[i * p + j] * z[i] * z[j] for i in range(p) for j in range(i, p)]
    return sum(terms[1:], terms[0])


def _moments(rows: DataFrame) -> DataFrame:
    p = len(VECTOR)
    sums = [F.avg(v).alias(f"m{i}") for i, v in enumerate(VECTOR)]
    products = [F.covar_pop(VECTOR[i], VECTOR[j]).alias(f"s{i}_{j}") for i in range(p) for j in range(i, p)]
    return rows.groupBy(*CELL).agg(F.count("*").alias("n"), *sums, *products)


def _estimate(moments: DataFrame, factor: float) -> DataFrame:
    """Mean, inverse covariance and log determinant of each cell."""
    p = len(VECTOR)

    def invert(frames):
        for frame in frames:
            out = []
            for row in frame.to_dict("records"):
                cov = np.array([[row[f"s{min(i, j)}_{max(i, j)}"] for j in range(p)] for i in range(p)])
                cov = factor * cov + np.diag(np.square(FLOOR))
                out.append((row["cell_lang"], row["cell_source"], row["n"], [row[f"m{i}"] for i in range(p)],
                            np.linalg.inv(cov).reshape(-1).tolist(), float(np.linalg.slogdet(cov)[1])))
            yield pd.DataFrame(out, columns=[*CELL, "n", "center", "precision", "log_det"])

    return settle(moments.mapInPandas(invert, "cell_lang string, cell_source string, n long, center array<double>, "
                                      "precision array<double>, log_det double"))


def _start(rows: DataFrame) -> DataFrame:
    """Medians and scaled median deviations."""
    p = len(VECTOR)
    middle = settle(rows.groupBy(*CELL).agg(
        *[F.percentile_approx(v, 0.5, RANK_ACCURACY).alias(f"m{i}") for i, v in enumerate(VECTOR)]))
    spread = rows.join(middle, CELL).groupBy(*CELL).agg(
        F.count("*").alias("n"),
        *[F.first(f"m{i}").alias(f"m{i}") for i in range(p)],
        *[F.pow(1.4826 * F.percentile_approx(F.abs(F.col(v) - F.col(f"m{i}")), 0.5, RANK_ACCURACY), 2).alias(f"s{i}_{i}")
          for i, v in enumerate(VECTOR)])
    zero = {f"s{i}_{j}": F.lit(0.0) for i in range(p) for j in range(i + 1, p)}
    return _estimate(spread.withColumns(zero), 1.0)


def robust_estimates(rows: DataFrame, *, support: float = SUPPORT, most_steps: int = MOST_STEPS) -> DataFrame:
    """One row per cell: n, center, precision, log_det."""
    p = len(VECTOR)
    model, last = _start(rows), None
    factor = consistency(support, p)
    for _ in range(most_steps):
        near = rows.join(model.select(*CELL, "center", "precision"), CELL).withColumn("distance", _distance())
        edge = settle(near.groupBy(*CELL).agg(F.percentile_approx("distance", support, RANK_ACCURACY).alias("edge")))
        model = _estimate(_moments(near.drop("center", "precision").join(edge, CELL).where("distance <= edge")), factor)
        total = model.agg(F.sum("log_det")).first()[0]
        if total is None or (last is not None and last - total < 1e-6 * max(1.0, abs(last))):
            break
        last = total
    inside = chi2_quantile(0.975, p)
    near = rows.join(model.select(*CELL, "center", "precision"), CELL).where(_distance() <= inside)
    return _estimate(_moments(near), consistency(0.975, p))


def judge(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source", min_rows: int = MIN_ROWS, reject_p: float = REJECT_P,
          whole_rows: bool = False) -> DataFrame:
    """One row per document: id_col, ``NAMES``, base_failed, kept, distance (null if no estimate applies). With
    ``whole_rows`` the column ``row``, a struct of all columns of ``docs``, stands in place of id_col."""
    named = docs.select(F.struct(*(docs.columns if whole_rows else [id_col])).alias("row"),
                        F.to_json(F.struct(F.col(lang_col).alias("v"))).alias("lang_key"),
                        F.to_json(F.struct(F.col(source_col).alias("v"))).alias("source_key"),
                        *([] if whole_rows else [F.col(text_col).alias("whole text")]))
    counted = statistics(named, text_col=text_col, row_col="row") if whole_rows else statistics(named, text_col="whole text")
    rows = _vectors(settle(counted))
    cells = settle(_cells(rows, min_rows))  # one row per language and source
    rows = rows.join(cells, ["lang_key", "source_key"], "left")
    passing = rows.where("NOT base_failed").select(*CELL, *VECTOR)
    model = robust_estimates(passing).where(F.col("n") >= min_rows * SUPPORT / 2)
    beyond = chi2_quantile(1 - reject_p, len(VECTOR))
    judged = rows.join(model.select(*CELL, "center", "precision"), CELL, "left").withColumn("distance", _distance())
    return judged.select(
        "row" if whole_rows else "row.*", *NAMES, "base_failed",
        (~F.col("base_failed") & (F.coalesce(F.col("distance"), F.lit(0.0)) <= beyond)).alias("kept"), "distance")
