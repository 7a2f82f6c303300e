"""Deleted interpolation: maximum-likelihood n-gram estimates mixed by context-frequency buckets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.llm import words
from windrow.llm.common import arrow_schema, crunch, discard, expand, id_crc, land, pick, ship, sliced, string_parts, whole_text

#: Longest n-gram.
ORDER = 2
#: Folds of the ids: one is never learned from; the counts of one more are held out while weights are learned.
FOLDS, HELD_FOLD, DELETED_FOLD = 7, 2, 3
#: Tokens of one block of documents, and distinct n-grams of one bucket of keys, about.
BLOCK_TOKENS, BUCKET_KEYS = 1_000_000, 500_000
#: Buckets of context frequency: 0, 1, 2-3, 4-7, ...
BUCKETS = 48
EM_STEPS, EM_TOLERANCE = 25, 1e-5

LEARNED, DELETED, HELD = 0, 1, 2
END = np.uint64(0x51A7E5E0DD5A11CE)
START = np.uint64(0xB0A710ADED5EED5A)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the words of each text with an end after each, and the number of tokens of each text."""
    key, count = words.word_keys(*string_parts(texts))
    return np.insert(key, np.cumsum(count), END), count + 1


def gram_keys(key: np.ndarray, begin: np.ndarray, order: int) -> list[np.ndarray]:
    """Keys of the n-grams that end at each token, for n from 1 to ``order``; texts begin with start marks."""
    out, at = [key], np.arange(len(key))
    for n in range(2, order + 1):
        with np.errstate(over="ignore"):
            total = np.full(len(key), np.uint64(n))
            for back in range(n - 1, -1, -1):
                source = at - back
                part = np.where(source >= begin, key[np.maximum(source, 0)], START)
                total = words.mix(total * np.uint64(0x9E3779B97F4A7C15) + part)
        out.append(total)
    return out


BLOCK = "block bigint, part int, n bigint, ids array<{}>, lengths array<int>, folds array<int>, vocabulary binary, n_words bigint, tokens binary"


def to_blocks(docs: DataFrame, doc_id: str, text: str, block_tokens: int) -> DataFrame:
    """Documents gathered into blocks of about ``block_tokens`` tokens, those of the deleted fold in blocks of their own.

    A block holds its distinct word keys and, for each token, its place among them. Its number is made of the task and
    a counter; the table is landed, so only one attempt of each task counts.
    """
    fold = (id_crc(doc_id) % FOLDS).cast("int")
    part = F.when(fold == HELD_FOLD, HELD).when(fold == DELETED_FOLD, DELETED).otherwise(LEARNED)
    source = pick(docs, doc_id=doc_id, text=whole_text(text), fold=part, task=F.spark_partition_id())
    kind = source.schema["doc_id"].dataType
    names = ["block", "part", "n", "ids", "lengths", "folds", "vocabulary", "n_words", "tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bool, list] = {True: [], False: []}
        size = {True: 0, False: 0}
        number = 0

        def flush(deleted: bool) -> pa.RecordBatch:
            nonlocal number
            task, ids, lengths, folds, keys = zip(*held[deleted], strict=True)
            held[deleted], size[deleted] = [], 0
            vocabulary, place = np.unique(np.concatenate(keys), return_inverse=True)
            block = (task[0] << 32) + number
            number += 1
            lists = [pa.concat_arrays(ids), pa.array(np.concatenate(lengths), pa.int32()), pa.array(np.concatenate(folds), pa.int32())]
            lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists]
            numbers = [pa.array([x], pa.int64()) for x in (block, len(place), len(vocabulary))]
            blobs = [pa.array([crunch(vocabulary)], pa.binary()), pa.array([crunch(place.astype("<u4"))], pa.binary())]
            arrays = [numbers[0], pa.array([int(deleted)], pa.int32()), numbers[1], *lists, blobs[0], numbers[2], blobs[1]]
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in sliced(batches, "text"):
            deleted_rows = batch.column("fold").to_numpy() == DELETED
            for deleted in (True, False):
                some = batch.filter(pa.array(deleted_rows == deleted))
                if not some.num_rows:
                    continue
                key, count = tokens(some.column("text"))
                held[deleted].append((batch.column("task")[0].as_py(), some.column("doc_id"), count, some.column("fold").to_numpy(), key))
                size[deleted] += len(key)
                if size[deleted] >= block_tokens:
                    yield flush(deleted)
        for deleted in (True, False):
            if held[deleted]:
                yield flush(deleted)

    return land(source.mapInArrow(run, BLOCK.format(kind.simpleString())), "blocks")


class Block:
    """One row of the landed blocks, with its n-grams."""

    def __init__(self, row: dict, order: int):
        self.part = row["part"]
        self.lengths = np.asarray(row["lengths"], np.int64)
        vocabulary = expand(row["vocabulary"], "<u8", row["n_words"])
        key = vocabulary[expand(row["tokens"], "<u4", row["n"])]
        ends = np.cumsum(self.lengths)
        self.fold = np.repeat(np.asarray(row["folds"], np.int64), self.lengths)
        self.begin = np.repeat(ends - self.lengths, self.lengths)
        self.first = self.begin == np.arange(len(key))
        self.grams = gram_keys(key, self.begin, order)

    def distinct(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        return np.unique(self.grams[n - 1], return_inverse=True)


def count_requests(blocks: DataFrame, order: int, buckets: int) -> DataFrame:
    """Each block's distinct n-grams with their counts among learned and deleted documents, dealt to buckets of keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row, order)
                for n in range(1, order + 1):
                    keys, at = block.distinct(n)
                    counts = [np.bincount(at[block.fold == fold], minlength=len(keys)).astype("<u4") for fold in (LEARNED, DELETED)]
                    edges = np.searchsorted(keys, np.array([(b << 64) // buckets for b in range(1, buckets)], np.uint64)) if buckets > 1 else []
                    cuts = [0, *np.asarray(edges, np.int64).tolist(), len(keys)]
                    rows = [
                        {
                            "n": n,
                            "bucket": b,
                            "block": row["block"],
                            "size": hi - lo,
                            "keys": crunch(np.diff(keys[lo:hi], prepend=np.uint64(0))),
                            "learned": crunch(counts[0][lo:hi]),
                            "deleted": crunch(counts[1][lo:hi]),
                        }
                        for b, (lo, hi) in enumerate(zip(cuts, cuts[1:], strict=False))
                        if hi > lo
                    ]
                    for lo in range(0, len(rows), 512):
                        yield pa.RecordBatch.from_pylist(rows[lo : lo + 512], REQUEST_SCHEMA)

    return blocks.mapInArrow(run, REQUEST)


REQUEST = "n int, bucket int, block bigint, size bigint, keys binary, learned binary, deleted binary"
REQUEST_SCHEMA = arrow_schema(REQUEST)
ANSWER = "n int, bucket int, block bigint, size bigint, learned binary, both binary, new_learned bigint, new_both bigint"
ANSWER_SCHEMA = arrow_schema(ANSWER)


def answer_bucket(table: pa.Table) -> pa.Table:
    """Total the counts of one bucket and give each block the totals of its n-grams, in the order of its keys.

    The first row also says how many n-grams of the bucket occur among learned, and among all training documents.
    """
    rows = table.sort_by("block").to_pylist()
    keys = [np.cumsum(expand(r["keys"], "<u8", r["size"]), dtype=np.uint64) for r in rows]
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    learned = np.bincount(at, np.concatenate([expand(r["learned"], "<u4", r["size"]) for r in rows]), len(distinct)).astype("<u8")
    both = learned + np.bincount(at, np.concatenate([expand(r["deleted"], "<u4", r["size"]) for r in rows]), len(distinct)).astype("<u8")
    out, begin = [], 0
    for r in rows:
        mine = at[begin : begin + r["size"]]
        begin += r["size"]
        news = {"new_learned": 0, "new_both": 0} if out else {"new_learned": int((learned > 0).sum()), "new_both": int((both > 0).sum())}
        out.append({k: r[k] for k in ("n", "bucket", "block", "size")} | {"learned": crunch(learned[mine]), "both": crunch(both[mine])} | news)
    return pa.Table.from_pylist(out, ANSWER_SCHEMA)


def counts_of(block: Block, answers: pa.Table, column: str, order: int) -> list[np.ndarray]:
    """Count of the n-gram that ends at each token, for n from 1 to ``order``."""
    rows = answers.sort_by([("n", "ascending"), ("bucket", "ascending")])
    out = []
    for n in range(1, order + 1):
        mine = rows.filter(pa.compute.equal(rows.column("n"), n))
        parts = [expand(b.as_py(), "<u8", s.as_py()) for b, s in zip(mine.column(column), mine.column("size"), strict=True)]
        out.append(np.concatenate(parts).astype(np.int64)[block.distinct(n)[1]])
    return out


def estimates(block: Block, counts: list[np.ndarray], total: int, distinct: int, documents: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Bucket of each token's longest context, and its estimates of order 0 (uniform) to ``len(counts)``.

    An order whose context was not seen says nothing (0).
    """
    size = len(counts[0])
    out = [np.full(size, 1 / (distinct + 1)), counts[0] / max(total, 1)]
    context = np.full(size, total)
    for n in range(2, len(counts) + 1):
        before = np.concatenate(([0], counts[n - 2][:-1]))
        context = np.where(block.first, documents, before)
        out.append(np.divide(counts[n - 1], context, out=np.zeros(size), where=context > 0))
    return bucket_of(context), out


def bucket_of(context: np.ndarray) -> np.ndarray:
    return np.minimum(np.frexp(context.astype(np.float64))[1], BUCKETS - 1).astype(np.int64)


def learn_weights(held_out: DataFrame, order: int) -> np.ndarray:
    """Mixture weights of each bucket by expectation-maximisation over rows (bucket, p0 ... p_order, n)."""
    weights = np.full((BUCKETS, order + 1), 1 / (order + 1))
    for _ in range(EM_STEPS):
        terms = [F.lit([float(x) for x in weights[:, k]])[F.col("bucket")] * F.col(f"p{k}") for k in range(order + 1)]
        total = sum(terms[1:], terms[0])
        shares = [F.sum(F.col("n") * terms[k] / total).alias(f"s{k}") for k in range(order + 1)]
        new = weights.copy()
        for row in held_out.groupBy("bucket").agg(*shares).collect():  # at most BUCKETS rows
            share = np.array([row[f"s{k}"] for k in range(order + 1)])
            new[row["bucket"]] = share / share.sum()
        moved, weights = np.abs(new - weights).max(), new
        if moved < EM_TOLERANCE:
            break
    return weights


def fill_unseen(weights: np.ndarray, seen: set[int]) -> np.ndarray:
    """Buckets without held-out tokens take the weights of the nearest bucket that has some."""
    out = weights.copy()
    for b in range(len(weights)):
        if seen and b not in seen:
            out[b] = weights[min(seen, key=lambda s: (abs(s - b), s))]
    return out


def interpolated_scores(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    *,
    order: int = ORDER,
    block_tokens: int = BLOCK_TOKENS,
    bucket_keys: int = BUCKET_KEYS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    A text is its words, A-Z lowered, and one end. The probability of a token is a mixture of the uniform one, its
    share of all tokens, and its shares after the last one to ``order - 1`` tokens. The weights depend on how often the
    longest context was seen: they are learned on the counts of one fold of the training documents, while the others
    give the estimates; then all training documents give the estimates. ``score`` is the sum of log10 probabilities;
    ``base_score`` that of add-one unigrams.

    Documents are gathered into blocks; each block asks the buckets of all n-grams (by ranges of their keys) for the
    totals of its distinct n-grams and adds its own counts with the same rows. So counts are pre-aggregated, a frequent
    word is one entry per block, a bucket holds about ``bucket_keys`` entries (more where frequent words, with one for
    each block, fall into it), and tokens are never shuffled with strings. There is one request for each block and
    bucket, so their number grows with the square of the input. NULL texts count as empty: one token, the end. A NULL doc_id has the crc32 of an empty text.
    Without training documents every known probability is the uniform one, 1 / (V + 1) = 1. No rows give no rows.
    """
    ship(docs.sparkSession)
    blocks = to_blocks(docs, doc_id, text, block_tokens)
    each = blocks.select(F.explode(F.arrays_zip("lengths", "folds")).alias("d"))
    facts = each.groupBy(F.col("d.folds").alias("fold")).agg(F.sum("d.lengths").alias("tokens"), F.count("*").alias("documents"))
    facts = {r["fold"]: (r["tokens"], r["documents"]) for r in facts.collect()}  # three rows
    asked = blocks.agg(F.sum("n_words").alias("w"), F.sum("n").alias("n")).first()
    buckets = max(1, int(((asked["w"] or 0) + (order - 1) * (asked["n"] or 0)) // (order * bucket_keys)))
    learned, deleted = facts.get(LEARNED, (0, 0)), facts.get(DELETED, (0, 0))
    both = (learned[0] + deleted[0], learned[1] + deleted[1])

    requests = count_requests(blocks, order, buckets)
    answers = land(requests.groupBy("n", "bucket").applyInArrow(answer_bucket, ANSWER), "answers", "uncompressed")
    sizes = answers.filter("n = 1").agg(F.sum("new_learned").alias("l"), F.sum("new_both").alias("b")).first()
    v_learned, v_both = int(sizes["l"] or 0), int(sizes["b"] or 0)

    def deleted_rows(left: pa.Table, right: pa.Table) -> pa.Table:
        tables = []
        for row in left.to_pylist():
            block = Block(row, order)
            bucket, p = estimates(block, counts_of(block, right, "learned", order), learned[0], v_learned, learned[1])
            distinct, n = np.unique(np.column_stack([bucket, *p]), axis=0, return_counts=True)
            columns = [distinct[:, 0].astype(np.int32), *distinct[:, 1:].T, n]
            tables.append(pa.table(columns, schema=arrow_schema(estimated)))
        return pa.concat_tables(tables) if tables else arrow_schema(estimated).empty_table()

    estimated = "bucket int, " + "".join(f"p{k} double, " for k in range(order + 1)) + "n bigint"
    answers_of = answers.select("n", "bucket", "block", "size", "learned", "both")
    deleted_blocks = blocks.filter(F.col("part") == 1)
    mine = answers_of.drop("both").join(deleted_blocks.select("block"), "block", "left_semi")
    held_out = deleted_blocks.groupBy("block").cogroup(mine.groupBy("block")).applyInArrow(deleted_rows, estimated)
    held_out = land(held_out, "held-out")
    weights = learn_weights(held_out, order)
    weights = fill_unseen(weights, {r["bucket"] for r in held_out.select("bucket").distinct().collect()})
    discard(docs.sparkSession, held_out)

    kind = docs.schema[doc_id].dataType.simpleString()
    names = ["doc_id", "fold", "n_tokens", "n_known", "base_score", "score"]

    def score_rows(left: pa.Table, right: pa.Table) -> pa.Table:
        tables = []
        for at in range(left.num_rows):
            row = left.slice(at, 1).drop_columns(["ids"]).to_pylist()[0]
            block = Block(row, order)
            counts = counts_of(block, right, "both", order)
            bucket, p = estimates(block, counts, both[0], v_both, both[1])
            mixed = sum(weights[bucket, k] * p[k] for k in range(order + 1))
            begin = np.cumsum(block.lengths) - block.lengths
            base = np.log10((counts[0] + 1) / (both[0] + v_both + 1))
            sums = [np.add.reduceat(x, begin) for x in ((counts[0] > 0).astype(np.int64), base, np.log10(mixed))]
            ids = left.column("ids").combine_chunks()[at].values
            tables.append(pa.table([ids, pa.array(row["folds"], pa.int32()), block.lengths, *sums], names=names))
        return pa.concat_tables(tables)

    scored = blocks.groupBy("block").cogroup(answers_of.drop("learned").groupBy("block")).applyInArrow(
        score_rows, f"doc_id {kind}, fold int, n_tokens bigint, n_known bigint, base_score double, score double"
    )
    held_out, train_tokens = (F.col("fold") == HELD).alias("held_out"), F.lit(both[0]).cast("long").alias("train_tokens")
    return scored.select("doc_id", held_out, "n_tokens", "n_known", train_tokens, "base_score", "score")
