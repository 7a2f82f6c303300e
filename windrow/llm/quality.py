"""Quality of texts, learned from trusted positives and unlabelled text (non-negative risk)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.llm import words
from windrow.llm.common import id_crc, pick, ship, sliced, string_parts, whole_text

#: Rows of each kind (positives, unlabelled) that the model is fitted on at most, chosen by a hash of their id.
SAMPLE_ROWS = 20_000
FOLDS, HELD_FOLD = 5, 0
THRESHOLD = 0.3

#: Kinds of bytes whose shares describe a text.
BYTE_KINDS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789", "space": b" \t\r\x0b\x0c",
    "line": b"\n", "stop": b".", "comma": b",", "shout": b"!", "ask": b"?", "bar": b"|", "sign": b"#$%&*@^~", "math": b"+=<>_/\\",
    "quote": b"\"'`", "bracket": b"()[]{}", "dash": b"-:;",
}
KIND_OF = np.full(256, len(BYTE_KINDS), np.int64)
for _k, _members in enumerate(BYTE_KINDS.values()):
    KIND_OF[list(_members)] = _k
KIND_OF[128:] = len(BYTE_KINDS) + 1
N_KINDS = len(BYTE_KINDS) + 2
N_FEATURES = N_KINDS + 10


def features(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One row of N_FEATURES numbers for each text of a column, from its whole bytes."""
    n = len(at) - 1
    owner = np.repeat(np.arange(n), np.diff(at))
    shares = np.bincount(owner * N_KINDS + KIND_OF[data], minlength=n * N_KINDS).reshape(n, N_KINDS)
    size = np.maximum(np.diff(at), 1)
    begin, end, count = words.spans(data, at)
    key = words.keys(words.LOWER[data], begin, end)
    owner = np.repeat(np.arange(n), count)
    many = np.maximum(count, 1)
    order = np.lexsort((key, owner))
    new = np.ones(len(key), bool)
    new[1:] = (key[order][1:] != key[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    again = np.zeros(len(key), bool)
    again[1:] = (key[1:] == key[:-1]) & (owner[1:] == owner[:-1])
    length = end - begin

    def per_word(marks: np.ndarray) -> np.ndarray:
        return np.bincount(owner, marks, n) / many

    first, last = KIND_OF[data[begin]], KIND_OF[data[end - 1]]
    names = list(BYTE_KINDS)
    letters = (names.index("upper"), names.index("lower"), N_KINDS - 1)
    mean = per_word(length)
    rest = [
        np.log1p(count),
        np.log1p(size),
        mean / 10,
        np.sqrt(per_word((length - mean[owner]) ** 2)) / 10 if len(owner) else np.zeros(n),
        np.bincount(owner[order], new, n) / many,
        np.log1p(count) * (1 - np.bincount(owner[order], new, n) / many),
        per_word(again),
        per_word(first == names.index("upper")),
        per_word(np.isin(last, letters)),
        per_word(length == 1),
    ]
    return np.column_stack([np.sqrt(shares / size[:, None]), *rest]).astype(np.float64)


def feature_rows(texts: pa.Array) -> np.ndarray:
    return features(*string_parts(texts))


@dataclass(frozen=True)
class Model:
    """A logistic model over standardised features, their squares and hinges."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float

    def widen(self, x: np.ndarray) -> np.ndarray:
        return widen(x, self.centre, self.scale)

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.widen(x) @ self.weights)


def widen(x: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> np.ndarray:
    z = np.clip((x - centre) / scale, -8, 8)
    return np.column_stack([np.ones(len(z)), z, np.minimum(z * z, 16) / 4, np.maximum(z - 1, 0), np.maximum(-z - 1, 0)])


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(z / 2))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None = None, *, seed: int = 7) -> Model:
    """Minimise the non-negative risk; without positives or unlabelled rows every score is the prior (0.5 if not given)."""
    both = np.concatenate([positive, unlabelled])
    if not len(positive) or not len(unlabelled):
        known = 0.5 if prior is None else prior
        width = both.shape[1]
        weights = np.zeros(1 + 4 * width)
        weights[0] = np.log(known / (1 - known)) if 0 < known < 1 else 0.0
        return Model(np.zeros(width), np.ones(width), weights, known)
    centre, scale = unlabelled.mean(0), np.maximum(unlabelled.std(0), 1e-3)
    p, u = widen(positive, centre, scale), widen(unlabelled, centre, scale)
    if prior is None:
        prior = estimate_prior(p, u, seed)
    return Model(centre, scale, descend(p, u, prior), prior)


def descend(p: np.ndarray, u: np.ndarray, prior: float, *, steps: int = 400, rate: float = 0.05, decay: float = 1e-4) -> np.ndarray:
    """Full-batch Adam on prior * R(p, +) + max(0, R(u, -) - prior * R(p, -)) with logistic losses.

    While the second term is below zero its gradient is taken the other way, so it cannot be driven down by
    remembering the positives.
    """
    w = np.zeros(p.shape[1])
    mean, square = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        zp, zu = p @ w, u @ w
        sp, su = sigmoid(zp), sigmoid(zu)
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        up = p.T @ (sp - 1) * (prior / len(p))
        down = u.T @ su / len(u) - p.T @ sp * (prior / len(p))
        gradient = (up + down if negative >= 0 else -down) + decay * w
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        w = w - rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return w


def estimate_prior(p: np.ndarray, u: np.ndarray, seed: int = 7) -> float:
    """Share of positives among the unlabelled rows, without any negative label.

    A classifier of positives against unlabelled rows is fitted on one half. On the other half, above a score c the
    unlabelled rows hold at most the share of positives that the positives themselves have there: the prior is the
    ratio of both shares at the c whose upper confidence bound is least.
    """
    random = np.random.default_rng(seed)
    half_p, half_u = random.random(len(p)) < 0.5, random.random(len(u)) < 0.5
    if min(half_p.sum(), (~half_p).sum(), half_u.sum(), (~half_u).sum()) < 20:
        return 0.5
    w = descend_against(p[half_p], u[half_u])
    sp, su = np.sort(p[~half_p] @ w), np.sort(u[~half_u] @ w)
    cuts = np.unique(np.quantile(sp, np.linspace(0, 0.99, 200)))
    qp = 1 - np.searchsorted(sp, cuts) / len(sp)
    qu = 1 - np.searchsorted(su, cuts) / len(su)
    slack = np.sqrt(np.log(40) / 2 / len(sp)) + np.sqrt(np.log(40) / 2 / len(su))
    best = np.argmin((qu + slack) / np.maximum(qp, 1e-9))
    return float(np.clip(qu[best] / qp[best], 0.01, 0.99))


def descend_against(p: np.ndarray, u: np.ndarray, *, steps: int = 200, rate: float = 0.05) -> np.ndarray:
    """Logistic regression of positives against unlabelled rows, both with equal weight."""
    w = np.zeros(p.shape[1])
    mean, square = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        gradient = p.T @ (sigmoid(p @ w) - 1) / len(p) + u.T @ sigmoid(u @ w) / len(u) + 1e-4 * w
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        w = w - rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return w


def learn(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    *,
    sample_rows: int = SAMPLE_ROWS,
    prior: float | None = None,
) -> Model:
    """Fit on at most ``sample_rows`` trusted positives and as many unlabelled documents, none of the held-out fold.

    Only label 1 is read. Distinct ids are chosen (at most twice ``sample_rows``) and broadcast to the documents. Of the
    texts of one id the one of least hash counts, so at most one feature row for each chosen id comes to the driver.
    """
    ship(docs.sparkSession)
    learns = id_crc("id") % FOLDS != HELD_FOLD
    trusted = pick(labels, id=doc_id, label=label).filter(learns & (F.col("label") == 1)).select("id").distinct()
    any_ = pick(docs, id=doc_id).filter(learns).distinct()

    def chosen(rows: DataFrame, kind: str) -> DataFrame:
        return rows.orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("id", F.lit(kind).alias("kind"))

    ids = chosen(trusted, "p").unionByName(chosen(any_, "u"))
    source = pick(docs, id=doc_id, text=whole_text(text)).join(F.broadcast(ids), "id").select("id", "kind", F.xxhash64("text").alias("hash"), "text")
    id_kind = source.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, "text"):
            rows = feature_rows(part.column("text"))
            columns = [part.column(c) for c in ("id", "kind", "hash")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(list(rows), pa.list_(pa.float64()))], ["id", "kind", "hash", "x"])

    rows = source.mapInArrow(run, f"id {id_kind}, kind string, hash bigint, x array<double>")
    found = rows.groupBy("id", "kind").agg(F.min_by("x", "hash").alias("x")).select("kind", "x").toArrow()
    kinds = np.array(found.column("kind").to_pylist(), dtype=object)
    x = np.array(found.column("x").combine_chunks().flatten()).reshape(-1, N_FEATURES)
    return fit(ordered(x[kinds == "p"]), ordered(x[kinds == "u"]), prior)


def ordered(x: np.ndarray) -> np.ndarray:
    """Rows in an order that does not depend on how tasks ended."""
    return x[np.lexsort(x.T[::-1])] if len(x) else x


def score(text: Column, model: Model) -> Column:
    """Score of a text column without NULL; higher: better."""

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], ["text"])
        parts = [model.score(feature_rows(part.column("text"))) for part in sliced(iter([batch]), "text")]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return run(text)


def classify(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    *,
    threshold: float = THRESHOLD,
    sample_rows: int = SAMPLE_ROWS,
    prior: float | None = None,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted (1 if score >= threshold).

    The score depends on the whole text only. NULL counts as empty and gets the score of an empty text. Rows are scored
    where they are, without a shuffle; repeated rows repeat their score. A NULL label is no label. Without labels all
    scores are equal; no documents give no rows.
    """
    model = learn(docs, labels, doc_id, text, label, sample_rows=sample_rows, prior=prior)
    source = pick(docs, doc_id=doc_id, text=whole_text(text))
    scored = source.select("doc_id", (id_crc() % FOLDS == HELD_FOLD).alias("held_out"), score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", *, threshold: float = THRESHOLD, **options: int) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with all their columns."""
    model = learn(docs, labels, doc_id, text, **options)
    return docs.filter(score(whole_text(text), model) >= threshold)
