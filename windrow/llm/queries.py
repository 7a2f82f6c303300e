"""The text operators applied to the whole test tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from windrow.llm import byte_bpe, merkle, packing, quality, toxicity, warc
from windrow.llm.collisions import collision_links
from windrow.llm.common import module_file, new_path
from windrow.llm.decontamination import decontaminate
from windrow.llm.exact_dedup import exact_dedup
from windrow.llm.hard_negatives import mine_hard_negatives
from windrow.llm.interpolation import interpolated_scores
from windrow.llm.secret_scan import scan_secrets
from windrow.llm.simhash import simhash_components


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_interpolation(spark: SparkSession, folder: str) -> DataFrame:
    return interpolated_scores(table(spark, folder, "documents"))


def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup(table(spark, folder, "documents"))


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "archives")
    warc.write_archives(table(spark, folder, "pages"), path)
    sound = "CASE WHEN gap IS NULL THEN true ELSE raise_error(concat('gap in an archive just written: ', gap, ' at ', start, ' in ', archive)) END"
    read = warc.read_archives(spark, path, payload=False).filter(sound)  # nothing is damaged here, so a gap is a lost page
    page_id, refers_to = (F.expr(f"try_cast({c} AS BIGINT)") for c in ("page", "refers"))
    named = read.withColumns({"page": warc.page_of("record_id"), "refers": warc.page_of("refers_to")})
    return named.select(
        page_id.alias("page_id"), "payload_bytes", "payload_digest", F.col("warc_type").alias("record_type"), refers_to.alias("refers_to")
    )


def op5_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    from public_tokenizers import PATTERN

    ranks = module_file("byte_bpe_50k.tiktoken")
    tokens = byte_bpe.decode(byte_bpe.encode(table(spark, folder, "documents"), ranks, PATTERN), ranks, PATTERN)
    return tokens.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("data", 256).alias("decoded_sha256"),
    )


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), module_file("word_bpe_49k.json"), special=True)


def op8_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = scan_secrets(table(spark, folder, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans", "n_lexed")


def op9_collisions(spark: SparkSession, folder: str) -> DataFrame:
    return collision_links(table(spark, folder, "embeddings"))


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_components(table(spark, folder, "documents"))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    return mine_hard_negatives(rows.withColumn("label", F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")))


def op12_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    n_items = F.size("items").cast("long").alias("n_items")
    return found.select("doc_id", "n_words", "n_hit", n_items, F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op13_manifest(spark: SparkSession, folder: str) -> DataFrame:
    found = merkle.verified(table(spark, folder, "documents"), merkle.without_line_ends())
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_interpolation": op1_interpolation,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_quality": op3_quality,
    "op4_warc": op4_warc,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_toxicity": op6_toxicity,
    "op7_packing": op7_packing,
    "op8_secret_scan": op8_secret_scan,
    "op9_collisions": op9_collisions,
    "op10_simhash": op10_simhash,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_decontamination": op12_decontamination,
    "op13_manifest": op13_manifest,
}

ORACLE: dict[str, str] = {
    "op2_exact_dedup": """
        WITH digests AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
        grouped AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM digests GROUP BY ALL)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
        FROM digests JOIN grouped USING (text_sha256)""",
    "op4_warc": """
        WITH sums AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
        named AS (
            SELECT page_id, payload_bytes, h, list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + ((('0x' || substr(h, 1 + 10 * (i // 8), 10))::BIGINT >> (35 - 5 * (i % 8))) & 31)::INTEGER, 1)), 'string_agg', '') AS payload_digest
            FROM sums),
        firsts AS (SELECT h, min(page_id) AS first_id FROM sums GROUP BY h)
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id <> first_id THEN first_id END AS refers_to
        FROM named JOIN firsts USING (h)""",
    "op9_collisions": """
        WITH RECURSIVE links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id
            WHERE list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.93),
        reached AS (
            SELECT vec_id AS a, vec_id AS b FROM embeddings
            UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
        least AS (SELECT a, min(b) AS component_id FROM reached GROUP BY a),
        degrees AS (SELECT a, count(*) AS n FROM links GROUP BY a)
        SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
        FROM embeddings e JOIN least ON least.a = vec_id LEFT JOIN degrees ON degrees.a = vec_id""",
    "op11_hard_negatives": """
        WITH base AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
        scores AS (
            SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
            FROM base a JOIN base b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
        positives AS (
            SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
        negatives AS (
            SELECT p.anchor_id, p.positive_id, s.other_id AS negative_id, p.positive_score, s.score AS negative_score,
                row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id)::INTEGER AS rank
            FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
                AND 100 * s.score BETWEEN 30 * p.positive_score AND 90 * p.positive_score)
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 10""",
    "op12_decontamination": r"""
        WITH docs AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        items AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        windows AS (
            SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[b + 1 : b + least(len(w), 10)], ' ') AS win
            FROM items, unnest(range(len(w) - least(len(w), 10) + 1)) AS t(b) WHERE len(w) > 0),
        sizes AS (SELECT DISTINCT size FROM windows),
        places AS (
            SELECT doc_id, size, b, array_to_string(w[b + 1 : b + size], ' ') AS win
            FROM docs, sizes, unnest(range(len(w) - size + 1)) AS t(b) WHERE len(w) >= size),
        met AS (SELECT p.doc_id, p.b, p.size, i.item_id FROM places p JOIN windows i ON i.size = p.size AND i.win = p.win),
        hits AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(b, b + size)) AS place FROM met) GROUP BY doc_id),
        held AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
            FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM met WHERE item_id IS NOT NULL) GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
            sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN held USING (doc_id)""",
    "op13_manifest": """
        WITH RECURSIVE tagged AS (
            SELECT doc_id, source, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(length(doc_id::VARCHAR)),
                    lambda i: list_prepend(256::BIGINT + ascii(substr(doc_id::VARCHAR, i + 1, 1)), repeat([0::BIGINT], 8))))),
                lambda c, x: CASE WHEN x >= 256 THEN xor(c, x - 256) ELSE xor(c >> 1, (c & 1) * 3988292384) END) AS crc,
                coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                    || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head, text
            FROM documents),
        hashed AS (
            SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                CASE WHEN crc & 1 = 1 THEN replace(text, chr(10), '') ELSE text END AS tampered, head
            FROM tagged),
        leaves AS (
            SELECT doc_id, source, leaf, sha256(head || coalesce(strlen(tampered) || ':' || tampered, '-')) AS claim,
                row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n
            FROM hashed),
        up AS (
            SELECT source, 0 AS lvl, pos, leaf AS h, n FROM leaves
            UNION ALL
            SELECT source, lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (n + 2) // 3 FROM up WHERE n > 1 GROUP BY source, lvl, pos // 3, n),
        subroots AS (
            SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS spos, count(*) OVER () AS sn FROM up WHERE n = 1),
        top AS (
            SELECT 0 AS lvl, spos AS pos, subroot AS h, sn AS n FROM subroots
            UNION ALL
            SELECT lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (n + 2) // 3 FROM top WHERE n > 1 GROUP BY lvl, pos // 3, n),
        runs AS (SELECT source, lvl, pos // 3 AS run, list(h ORDER BY pos) AS hs FROM up WHERE n > 1 GROUP BY ALL),
        top_runs AS (SELECT lvl, pos // 3 AS run, list(h ORDER BY pos) AS hs FROM top WHERE n > 1 GROUP BY ALL),
        climb AS (
            SELECT doc_id, leaf, source, 0 AS lvl, pos, claim AS h, '' AS proof, n FROM leaves
            UNION ALL
            SELECT c.doc_id, c.leaf, c.source, c.lvl + 1, c.pos // 3,
                sha256(array_to_string(hs[1 : c.pos % 3] || [c.h] || hs[c.pos % 3 + 2 :], '')),
                c.proof || array_to_string(hs[1 : c.pos % 3] || hs[c.pos % 3 + 2 :], ''), (c.n + 2) // 3
            FROM climb c JOIN runs r ON r.source IS NOT DISTINCT FROM c.source AND r.lvl = c.lvl AND r.run = c.pos // 3 WHERE c.n > 1),
        climb_top AS (
            SELECT doc_id, leaf, subroot, 0 AS lvl, spos AS pos, h, proof, sn AS n
            FROM climb JOIN subroots ON subroots.source IS NOT DISTINCT FROM climb.source WHERE n = 1
            UNION ALL
            SELECT c.doc_id, c.leaf, c.subroot, c.lvl + 1, c.pos // 3,
                sha256(array_to_string(hs[1 : c.pos % 3] || [c.h] || hs[c.pos % 3 + 2 :], '')),
                c.proof || array_to_string(hs[1 : c.pos % 3] || hs[c.pos % 3 + 2 :], ''), (c.n + 2) // 3
            FROM climb_top c JOIN top_runs r ON r.lvl = c.lvl AND r.run = c.pos // 3 WHERE c.n > 1)
        SELECT doc_id, leaf, subroot, top.h AS root, sha256(proof) AS proof_sha256, climb_top.h AS folded_root, climb_top.h = top.h AS verified
        FROM climb_top, top WHERE climb_top.n = 1 AND top.n = 1""",
}
