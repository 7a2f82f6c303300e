"""Toxicity of texts by a linear model whose scores must not move when identity terms are swapped."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.llm import words
from windrow.llm.common import id_crc, land, pick, ship, sliced, string_parts, whole_text

#: Labelled rows of each label that the model is fitted on at most, chosen by a hash of their id.
SAMPLE_ROWS = 20_000
#: Words that the model may use, identity terms aside; and the least evidence (G statistic) that a word needs.
MAX_WORDS, LEAST_EVIDENCE = 4096, 20.0
#: Beginnings of words that are features beside the words, in bytes.
PREFIX_BYTES = (4, 5, 6)
FOLDS, HELD_FOLD = 5, 0
THRESHOLD = 0.5
#: Weight of the penalty on score changes, and of the squared weights.
FAIRNESS, DECAY = 10.0, 1e-4
#: How much more a toxic text weighs than a clean one: to overlook one is the worse mistake.
TOXIC_WEIGHT = 4.0

#: Groups of identity terms; a term is swapped with the others of its group.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("girl", "boy"), ("female", "male"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"), ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "arab"), ("gay", "straight", "lesbian", "bisexual"), ("transgender", "cisgender"),
    ("immigrants", "citizens", "refugees"), ("immigrant", "citizen", "refugee"), ("disabled", "deaf", "blind"), ("old", "young", "elderly"),
)

#: Words are runs of letters and digits here; bytes above 127 belong to letters.
BREAKS = np.ones(256, bool)
BREAKS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def all_keys(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Text and key of every word, and of the beginnings of longer words, which stand for their inflected forms."""
    data, at = string_parts(texts)
    begin, end, count = words.spans(data, at, BREAKS)
    lowered = words.LOWER[data]
    owner = np.repeat(np.arange(len(at) - 1), count)
    owners, keys = [owner], [words.keys(lowered, begin, end)]
    for size in PREFIX_BYTES:
        long = end - begin > size
        owners.append(owner[long])
        keys.append(words.mix(words.keys(lowered, begin[long], begin[long] + size) ^ np.uint64(size)))
    return np.concatenate(owners), np.concatenate(keys)


def distinct(owner: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs, sorted."""
    order = np.lexsort((key, owner))
    owner, key = owner[order], key[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    return owner[new], key[new]


def hits(texts: pa.Array, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the sorted ``keys`` are present in each text: distinct (text, place in keys), sorted."""
    owner, key = all_keys(texts)
    if not len(keys):
        return owner[:0], owner[:0]
    at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
    hit = keys[at] == key
    return distinct(owner[hit], at[hit])


def term_keys(terms: tuple[str, ...]) -> list[int]:
    data, at = string_parts(pa.array(list(terms), pa.string()))
    return [int(k) for k in words.word_keys(data, at, BREAKS)[0]]


@dataclass(frozen=True)
class Model:
    """Weights of the words that are present in a text; ``keys`` are sorted."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, texts: pa.Array) -> np.ndarray:
        owner, at = hits(texts, self.keys)
        total = self.bias + np.bincount(owner, self.weights[at], len(texts))
        return 0.5 * (1 + np.tanh(total / 2))


class Rows:
    """A sparse matrix of zeros and ones: row and column of each one."""

    def __init__(self, row: np.ndarray, column: np.ndarray, height: int, width: int):
        self.row, self.column, self.height, self.width = row, column, height, width

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.column], self.height)

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, r[self.row], self.width)


def swaps(present: list[np.ndarray], groups: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Counterfactuals: each identity term of a text put as each other one of its group, as (term, other).

    ``other`` is -1 where the text holds it already. Everything else stays, so the change of a linear score is the
    difference of the two weights.
    """
    group_of = {term: group for group in groups for term in group}
    gone, plus = [], []
    for terms in present:
        for term in terms[np.isin(terms, list(group_of))].tolist() if group_of else ():
            for other in group_of[term]:
                if other != term:
                    gone.append(term)
                    plus.append(-1 if other in terms else other)
    return np.array(gone, np.int64), np.array(plus, np.int64)


def fit(present: list[np.ndarray], toxic: np.ndarray, weight: np.ndarray, width: int, groups: list[list[int]], *, fairness: float = FAIRNESS, decay: float = DECAY, steps: int = 400, rate: float = 0.05) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise weighted logistic loss + decay * |w|^2 + fairness * mean (score - swapped score)^2.

    Scores are the linear ones. ``present`` lists the words of each text. Full-batch Adam.
    """
    count = np.fromiter(map(len, present), np.int64, len(present))
    columns = np.concatenate(present) if len(present) else np.zeros(0, np.int64)
    x = Rows(np.repeat(np.arange(len(present)), count), columns, len(present), width)
    gone, plus = swaps(present, groups)
    n = len(gone)
    put = plus >= 0
    share = weight / weight.sum()
    base = float(np.clip((share * toxic).sum(), 1e-6, 1 - 1e-6))
    w, bias = np.zeros(width), np.log(base / (1 - base))
    mean, square = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, steps + 1):
        error = share * (0.5 * (1 + np.tanh((x.times(w) + bias) / 2)) - toxic)
        gradient = np.append(x.back(error) + decay * w, error.sum())
        if n and fairness:
            change = w[gone]
            change[put] -= w[plus[put]]
            gradient[:-1] += 2 * fairness / n * (np.bincount(gone, change, width) - np.bincount(plus[put], change[put], width))
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        move = rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    return w, float(bias)


def learn(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", *,
    terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS, sample_rows: int = SAMPLE_ROWS, max_words: int = MAX_WORDS, fairness: float = FAIRNESS,
) -> Model:
    """Fit on at most ``sample_rows`` texts of each label, none of the held-out fold.

    The chosen ids (at most twice ``sample_rows`` rows) are broadcast to the documents; of the texts of one id the least
    one counts. The sample is landed, and words are counted per label by a grouping; the ``max_words`` of most evidence and the identity terms are the features. The texts are weighted so
    that both labels have the share that they have among all labelled rows, times TOXIC_WEIGHT for toxic ones.
    """
    spark = docs.sparkSession
    ship(spark)
    usable = pick(labels, id=doc_id, label=F.col(label).cast("int")).filter((id_crc("id") % FOLDS != HELD_FOLD) & F.col("label").isin(0, 1))
    usable = usable.groupBy("id").agg(F.max("label").alias("label"))
    share = {row["label"]: row["n"] for row in usable.groupBy("label").agg(F.count("*").alias("n")).collect()}

    def chosen(value: int) -> DataFrame:
        return usable.filter(F.col("label") == value).orderBy(F.xxhash64("id"), "id").limit(sample_rows)

    ids = F.broadcast(chosen(0).unionByName(chosen(1)))
    texts = pick(docs, id=doc_id, text=whole_text(text)).join(ids, "id")
    texts = land(texts.groupBy("id", "label").agg(F.min("text").alias("text")).select("label", "text"), "sample")

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, "text", 16 << 20):
            owner, key = distinct(*all_keys(part.column("text")))
            toxic = part.column("label").to_numpy()[owner]
            found, at = np.unique(key, return_inverse=True)
            bad = np.bincount(at, toxic, len(found)).astype(np.int64)
            good = np.bincount(at, minlength=len(found)) - bad
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(good), pa.array(bad)], ["key", "good", "bad"])

    sampled = {row["label"]: row["n"] for row in texts.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n0, n1 = sampled.get(0, 0), sampled.get(1, 0)
    groups_keys = [term_keys(group) for group in terms]
    if not n0 or not n1:
        return Model(np.zeros(0, np.uint64), np.zeros(0), 4.0 if n1 else -4.0 if n0 else 0.0)
    counted = texts.mapInArrow(counts, "key bigint, good bigint, bad bigint").groupBy("key").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    parts = []
    for one, other, n in (("bad", "good", n1), ("good", "bad", n0)):
        value = F.col(one)
        expected = (value + F.col(other)) * F.lit(n / (n0 + n1))
        for seen, awaited in ((value, expected), (F.lit(n) - value, F.lit(n) - expected)):
            parts.append(F.when(seen > 0, seen * F.log(seen / awaited)).otherwise(0.0))
    evidence = 2 * (parts[0] + parts[1] + parts[2] + parts[3])
    best = counted.filter("good + bad >= 3").withColumn("evidence", evidence).filter(F.col("evidence") >= LEAST_EVIDENCE).orderBy(F.desc("evidence"), "key").limit(max_words)
    keys = {int(np.int64(row["key"]).view(np.uint64)) for row in best.select("key").collect()}
    # Beginnings of identity terms would carry what the swaps of whole terms are to even out.
    own = {int(k) for group in terms for k in all_keys(pa.array(list(group), pa.string()))[1]}
    keys = np.array(sorted((keys - own).union(*groups_keys)), np.uint64)

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, "text", 16 << 20):
            owner, at = hits(part.column("text"), keys)
            ends = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=part.num_rows))))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(at, pa.int32()))
            yield pa.RecordBatch.from_arrays([part.column("label"), lists], ["label", "hits"])

    found = texts.mapInArrow(present, "label int, hits array<int>").orderBy("label", F.xxhash64("hits")).toArrow()
    toxic = found.column("label").to_numpy().astype(float)
    texts_hits = [np.array(x, np.int64) for x in found.column("hits").to_pylist()]
    weight = np.where(toxic > 0, TOXIC_WEIGHT * share[1] / n1, share[0] / n0)
    groups = [[int(np.searchsorted(keys, np.uint64(k))) for k in group] for group in groups_keys]
    w, bias = fit(texts_hits, toxic, weight, len(keys), groups, fairness=fairness)
    return Model(keys, w, bias)


def score(text: Column, model: Model) -> Column:
    """Score of a text column without NULL; higher: more toxic."""

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], ["text"])
        parts = [model.score(part.column("text")) for part in sliced(iter([batch]), "text")]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return run(text)


def classify(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", *, threshold: float = THRESHOLD, **options: object) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted (1 if score >= threshold).

    The score depends on the words of the whole text only. NULL counts as empty and gets the score of an empty text.
    Rows are scored where they are, without a shuffle; repeated rows repeat their score. NULL labels are left out; a
    document with contradictory labels counts as toxic. With one label only, all scores are equal and on its side;
    without labels they are 0.5. No documents give no rows.
    """
    model = learn(docs, labels, doc_id, text, label, **options)
    source = pick(docs, doc_id=doc_id, text=whole_text(text))
    scored = source.select("doc_id", (id_crc() % FOLDS == HELD_FOLD).alias("held_out"), score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
