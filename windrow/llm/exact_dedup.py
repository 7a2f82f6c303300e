"""Exact duplicates with a split between frequent and other digests; built-in expressions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.llm.common import land, pick, whole_text

#: Counters of the frequent-items summary. Its count of an item is off by at most ``3.5 / COUNTERS`` of the rows.
COUNTERS = 4096
#: Frequent digests that are looked at; with 100 bytes each their table has at most 50 kB.
CANDIDATES = 512


def exact_dedup(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, counters: int = COUNTERS, candidates: int = CANDIDATES
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their SHA-256 is; of equal texts the largest doc_id stays. A Misra-Gries summary (Spark's
    ``approx_top_k``, a frequent-items sketch that cuts all counters by their median) is built per task and merged,
    and names at most ``candidates`` digests. A second pass counts those exactly and takes their largest doc_id: the
    verified winners. Those that occur at least twice are broadcast (at most ``candidates`` rows), and their copies get
    their decision where they are, without a shuffle. All other digests are aggregated and joined in the ordinary way;
    none of them can be frequent.

    Texts are read once: ids and digests are landed first.
    NULL text counts as empty. Rows with the same doc_id and text share one decision and all count in group_size.
    A NULL doc_id counts as smaller than all others. No rows give no rows.
    """
    rows = land(pick(docs, doc_id=doc_id, text_sha256=F.sha2(whole_text(text), 256)), "digests")
    return decide(rows, counters, candidates)


def decide(rows: DataFrame, counters: int = COUNTERS, candidates: int = CANDIDATES) -> DataFrame:
    """Decisions for landed rows (doc_id, text_sha256)."""
    summary = rows.agg(F.expr(f"approx_top_k(text_sha256, {candidates}, {counters})").alias("top"))
    named = summary.select(F.explode("top.item").alias("text_sha256"))
    size = F.count(F.lit(1)).alias("group_size")
    winner = F.max("doc_id").alias("keep_id")
    verified = land(
        rows.join(F.broadcast(named), "text_sha256", "left_semi").groupBy("text_sha256").agg(size, winner).filter("group_size > 1"),
        "winners",
    )
    hot = rows.join(F.broadcast(verified), "text_sha256")
    rest = rows.join(F.broadcast(verified.select("text_sha256")), "text_sha256", "left_anti")
    cold = rest.join(rest.groupBy("text_sha256").agg(size, winner), "text_sha256")
    columns = ["doc_id", "keep_id", "group_size", F.expr("doc_id <=> keep_id").alias("kept"), "text_sha256"]
    return hot.select(*columns).unionByName(cold.select(*columns))


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of rows that repeat a doc_id and text, one stays.

    Texts are shuffled to their decisions once, at every size; repeated rows, the few, once more.
    """
    digest = "__text_sha256"
    found = exact_dedup(docs, doc_id, text).filter("kept").groupBy("doc_id", "text_sha256").agg(F.count("*").alias("copies"))
    found = land(found.select(F.col("doc_id").alias("__kept_id"), F.col("text_sha256").alias("__kept_sha"), "copies"), "kept")
    marked = docs.withColumn(digest, F.sha2(whole_text(text), 256))
    same = marked[doc_id].eqNullSafe(F.col("__kept_id")) & (F.col(digest) == F.col("__kept_sha"))
    single = marked.join(found.filter("copies = 1").hint("merge"), same, "left_semi")
    repeated = marked.join(found.filter("copies > 1"), same, "left_semi").dropDuplicates([doc_id, digest])
    return single.unionByName(repeated).drop(digest)
