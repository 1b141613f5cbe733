"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree: a node is a path of block elements with their classes, from the root down. The pages
that reach a node, its presentations (the different runs of child elements or texts) and its contents are counted over all
pages. With m pages at a node:

* presentation importance: entropy of the presentations, to the base m. A menu looks alike on every page, an article doesn't;
* content importance: 1 minus the mean entropy of the node's texts over pages. A text that k of m pages share has ``log_m k``;
* composite importance: the presentation's share is ``1 - DECAY ** presentations``, the rest is the content's. A branch is noise if
  every node in it that has texts is below ``LEAST_IMPORTANCE``, so it is those nodes that go.

Equal pages count once, and a node with fewer than ``LEAST_PAGES`` different pages has no importance, for lack of evidence. What a page
itself marks is a prior: on pages with ``article`` or ``main`` the importance is ``(1 - PRIOR) * composite``, plus ``PRIOR`` inside
of these. So a text that all pages share goes from ``main`` as well, and a varied branch beside an ``article`` stays; without evidence
the mark alone decides. Pages without a mark go by the composite, and keep what has no evidence. Parts that a class or id
names as menu, sidebar, notice and the like count as beside the content: they stay only where the counts speak for them. Parts
whose element or role says menu, footer, form or aside, and those named as advert, comments, shares or related texts, which
differ from page to page by nature, are no content, whatever the counts.

Counting is by partial sums per host, node and text, so a host with a third of all pages is no single task's work; the verdicts
come back as one row per host, with lists of nodes that have enough pages.

Defined results: a null, empty or text-free page has an empty text; a null url, or one without a host, shares the host "";
repeated rows are extracted each; unclosed and misnested elements are closed as browsers do; an empty table gives no rows.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.html_blocks import DROPPED, INSIDE, NAMED, blocks, path_hash
from tillhouse.session import settle

DECAY = 0.9
LEAST_PAGES = 4
LEAST_IMPORTANCE = 0.4
PRIOR = 0.25
PAGES_AT_ONCE = 256


def _parsed(pages: DataFrame) -> DataFrame:
    """id, url, host, page (hash of all texts), blocks: node, place, text."""
    kind = pages.schema["id"].dataType.simpleString()

    def parse(batches):
        item = pa.list_(pa.struct([("node", pa.int64()), ("place", pa.int32()), ("text", pa.string())]))
        for whole in batches:
            for at in range(0, whole.num_rows, PAGES_AT_ONCE):
                batch = whole.slice(at, PAGES_AT_ONCE)
                rows = [[{"node": path_hash(path), "place": place, "text": text} for path, place, text in blocks(page)]
                        for page in batch.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(rows, item)],
                                                 names=["id", "url", "blocks"])

    parsed = pages.select("id", "url", "html").mapInArrow(
        parse, f"id {kind}, url string, blocks array<struct<node: bigint, place: int, text: string>>")
    host = F.lower(F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))
    return settle(parsed.withColumn("host", F.xxhash64(host)))


def judged_nodes(parsed: DataFrame, *, least_pages: int = LEAST_PAGES,
                 least_importance: float = LEAST_IMPORTANCE) -> DataFrame:
    """host, and nodes: dull_inside (go from marked content), dull (go from pages without), varied (stay beside it)."""
    texts = parsed.select("host", F.xxhash64(F.col("blocks.text")).alias("page"), F.posexplode("blocks").alias("pos", "b")).where(
        F.col("b.place") != DROPPED)
    texts = settle(texts.select("host", "page", "pos", "b.node",
                                F.xxhash64("b.text").alias("text")).distinct())  # equal pages count once
    # content: in how many pages does each text of a node stand
    shared = texts.groupBy("host", "node", "text", "page").agg(F.lit(1).alias("one")).groupBy("host", "node", "text").agg(
        F.count("*").alias("k"))
    # presentation: the number of texts of a page at the node, by far the most common way in which runs of children differ
    looks = texts.groupBy("host", "node", "page").agg(F.count("*").alias("look"))
    looks = looks.groupBy("host", "node", "look").agg(F.count("*").alias("n"))
    m = looks.groupBy("host", "node").agg(F.sum("n").alias("m"), F.count("*").alias("n_looks"),
                                          F.sum(F.col("n") * F.log("n")).alias("n_log_n"))
    content = shared.groupBy("host", "node").agg(F.avg(F.log("k")).alias("mean_log_k"))
    log_m = F.log("m")
    look_importance = (log_m - F.col("n_log_n") / F.col("m")) / log_m
    share = 1 - F.pow(F.lit(DECAY), F.col("n_looks"))
    leaf = share * look_importance + (1 - share) * (1 - F.col("mean_log_k") / log_m)
    known = m.where(F.col("m") >= max(2, least_pages)).join(content, ["host", "node"]).withColumn("leaf", leaf)

    def nodes(which, name):
        return F.sort_array(F.collect_set(F.when(which, F.col("node")))).alias(name)

    weight = (1 - PRIOR) * F.col("leaf")
    return known.groupBy("host").agg(nodes(weight + PRIOR < least_importance, "dull_inside"),
                                     nodes(F.col("leaf") < least_importance, "dull"),
                                     nodes(weight >= least_importance, "varied"))


def main_text(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              least_pages: int = LEAST_PAGES, least_importance: float = LEAST_IMPORTANCE) -> DataFrame:
    """One row per page: id_col, url_col, text (blocks joined by a space), n_chars."""
    named = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
                         F.col(html_col).cast("string").alias("html"))
    parsed = _parsed(named)
    judged = settle(judged_nodes(parsed, least_pages=least_pages, least_importance=least_importance))
    marked = F.exists("blocks", lambda b: b["place"] == INSIDE)

    def among(name, b):
        return F.coalesce(F.array_contains(name, b["node"]), F.lit(False))

    kept = F.filter("blocks", lambda b: F.when(b["place"] == INSIDE, ~among("dull_inside", b)).otherwise(
        (b["place"] != DROPPED) & F.when(marked | (b["place"] == NAMED), among("varied", b)).otherwise(~among("dull", b))))
    out = parsed.join(judged, "host", "left").withColumn("text", F.array_join(kept["text"], " "))
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text",
                      F.char_length("text").cast("long").alias("n_chars"))
