"""Token sequences of bounded length, packed best-fit with certified bin counts."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.llm.common import Remembered, arrow_schema, discard, land, pick, ship, sliced, whole_text

CAPACITY = 4096
END_ID = 1
#: Pieces that one task packs at once.
PART_ROWS = 100_000
#: Deals in turn that save no sequence, after which the packing stands although its count is above the bound.
VAIN_DEALS = 3
#: Words whose ids a Python worker remembers in each of two generations, and words that are encoded in one call.
REMEMBERED = 300_000
STEP = 512
#: ASCII signs (but the apostrophe, which begins tokens of its own) after an ASCII letter at the end of a word.
LAST_SIGNS = re.compile(rb"(?<=[a-z])([!-&(-/:-@\[-`{-~]+)(?=[ \t-\r]|$)")
#: A word that is one token, between words that are encoded together.
BORDER = b"\x01"


class WordIds:
    """Ids of words by a tokenizer file; equal words are encoded once.

    The tokenizer drops white space, so the ids of a text are those of its words (cut at ASCII white space) in turn. It
    lowers letters and parts letters from signs, so ASCII letters are lowered before, and ASCII signs at the end of a
    word become a word of their own. Texts with combining marks, which may join a letter, are only cut. With
    ``special`` the strings of special tokens in a text have their ids, as in the library's plain call, and texts where
    one may begin are only cut too; without it they are encoded as other text is.
    """

    def __init__(self, path: str, special: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        added = self.tokenizer.get_added_tokens_decoder().values() if special else ()
        self.whole = (b"\xcc", b"\xcd", *{token.content[:2].encode() for token in added})
        self.known: Remembered = Remembered(REMEMBERED)
        (self.border,) = self.tokenizer.encode(BORDER.decode(), add_special_tokens=False).ids

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        split = [(text if any(x in text for x in self.whole) else LAST_SIGNS.sub(rb" \1", text.lower())).split() for text in texts]
        self.known.turn()
        self.learn(self.known.missing(set().union(*split)))
        return [b"".join(map(self.known.__getitem__, words)) for words in split]

    def learn(self, words: list[bytes]) -> None:
        """Encode runs of words with a border between them; its id comes from no word without its byte."""
        odd = [w for w in words if BORDER in w]
        plain = words if not odd else [w for w in words if BORDER not in w]
        runs = [plain[at : at + STEP] for at in range(0, len(plain), STEP)]
        for at in range(0, len(runs), 32):
            some = runs[at : at + 32]
            joined = [(b" " + BORDER + b" ").join(run).decode() for run in some]
            for run, found in zip(some, self.tokenizer.encode_batch_fast(joined, add_special_tokens=False), strict=True):
                ids = np.array(found.ids, "<u4")
                borders = np.flatnonzero(ids == self.border)
                raw = ids.tobytes()
                begins = [0, *(4 * borders + 4).tolist()]
                ends = [*(4 * borders).tolist(), len(raw)]
                self.known.update(zip(run, (raw[b:e] for b, e in zip(begins, ends, strict=True)), strict=True))
        for word in odd:
            self.known[word] = np.array(self.tokenizer.encode(word.decode(), add_special_tokens=False).ids, "<u4").tobytes()


_words: dict[tuple[str, bool], WordIds] = {}


def word_ids(path: str, special: bool = False) -> WordIds:
    if (path, special) not in _words:
        _words[path, special] = WordIds(path, special)
    return _words[path, special]


def pieces(
    docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", *, capacity: int = CAPACITY, end_id: int = END_ID, special: bool = False
) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32): each text's ids and an end id, cut every ``capacity`` ids."""
    ship(docs.sparkSession)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end, step = word_ids(path, special), int(end_id).to_bytes(4, "little"), 4 * capacity
        for part in sliced(batches, "text"):
            at, rows = [], []
            for k, ids in enumerate(words.encode(part.column("text").to_pylist())):
                ids += end
                for piece, begin in enumerate(range(0, len(ids), step)):
                    cut = memoryview(ids)[begin : begin + step]
                    at.append(k)
                    rows.append((piece, begin // 4, len(cut) // 4, zlib.crc32(cut)))
            piece, start, length, crc = zip(*rows, strict=True)
            arrays = [pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
            yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(at)), *arrays], names)

    source = pick(docs, doc_id=doc_id, text=whole_text(text).cast("binary"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Bin of each length by best-fit decreasing; lengths come in falling order.

    Open bins are stacked by the room they have; one integer holds a bit for every room that some bin has.
    """
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    present, bins = 0, 0
    out = np.empty(len(lengths), np.int64)
    for k, length in enumerate(lengths.tolist()):
        fitting = present >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            bin_ = rooms[room].pop()
            if not rooms[room]:
                present ^= 1 << room
        else:
            room, bin_ = capacity, bins
            bins += 1
        out[k] = bin_
        if rest := room - length:
            if not rooms[rest]:
                present |= 1 << rest
            rooms[rest].append(bin_)
    return out


def lower_bound(counts: np.ndarray, capacity: int = CAPACITY) -> int:
    """Bins that items of length i (``counts[i]`` of them) need at least, by dual feasible functions.

    A function f is dual feasible if f-values of items that fit into one bin sum to one at most; so the sum over all
    items, rounded up, bounds the bins from below. Tried are the sum of lengths, for every e up to half a bin the
    function that takes lengths over 1 - e as whole bins and leaves out those under e, and the rounding functions
    u(x) = x if (k + 1) x is whole, else floor((k + 1) x) / k.
    """
    size = np.arange(capacity + 1)
    mass = counts * size
    best = -(-int(mass.sum()) // capacity)
    total, number = np.cumsum(mass), np.cumsum(counts)
    for e in range(1, capacity // 2 + 1):
        large = int(number[capacity] - number[capacity - e])
        middle = int(total[capacity - e] - total[e - 1])
        best = max(best, large - (-middle // capacity))
    for k in range(1, 21):
        scaled, rest = np.divmod((k + 1) * size, capacity)
        above = int((counts * np.where(rest == 0, size * k, scaled * capacity)).sum())
        best = max(best, -(-above // (k * capacity)))
    return best


PACKED = "item bigint, length bigint, part int, bin bigint, offset bigint, room bigint, gap bigint"


def pack_part(table: pa.Table, capacity: int) -> pa.Table:
    """Pack one part: bins are named by their smallest item; ``gap`` is bins less the bound, ``room`` what a bin has left."""
    item, length = table.column("item").to_numpy(), table.column("length").to_numpy()
    order = np.lexsort((item, -length))
    item, length = item[order], length[order]
    bin_ = best_fit(length, capacity)
    n = int(bin_.max()) + 1
    fill = np.bincount(bin_, length, n).astype(np.int64)
    name = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(name, bin_, item)
    by_bin = np.argsort(bin_, kind="stable")
    ends = np.cumsum(length[by_bin])
    first = np.concatenate(([True], bin_[by_bin][1:] != bin_[by_bin][:-1]))
    begin = ends - length[by_bin]
    offset = np.empty_like(length)
    offset[by_bin] = begin - np.repeat(begin[first], np.bincount(bin_, minlength=n))
    gap = n - lower_bound(np.bincount(length, minlength=capacity + 1), capacity)
    part = np.full(len(item), table.column("part")[0].as_py(), np.int32)
    columns = [item, length, part, name[bin_], offset, capacity - fill[bin_], np.full(len(item), gap)]
    return pa.table(columns, schema=arrow_schema(PACKED))


def pack(items: DataFrame, *, capacity: int = CAPACITY, part_rows: int = PART_ROWS) -> DataFrame:
    """Rows (item, sequence_id, offset) for landed rows (item, length): unique items of 1 to ``capacity`` tokens.

    Items that fill a sequence keep it alone. The others are dealt at random to parts of about ``part_rows`` items and
    packed best-fit decreasing; dual feasible functions certify a part whose bin count meets its lower bound. While
    the total is above the bound of the whole, parts with a gap give up their bins that have room, certified parts
    their one emptiest bin; these items are dealt anew and packed again, and the new packing stands if it has fewer
    bins. A sequence is named by the smallest item in it.
    """
    spark = items.sparkSession
    ship(spark)
    alone = items.filter(F.col("length") == capacity)
    rest = items.filter(F.col("length") < capacity)
    counts = np.zeros(capacity + 1, np.int64)
    for row in rest.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[row["length"]] = row["count"]
    bound = lower_bound(counts, capacity)

    def packed(loose: DataFrame, n: int, seed: int) -> DataFrame:
        parts = max(1, -(-n // part_rows))
        dealt = loose.withColumn("part", F.pmod(F.xxhash64("item", F.lit(seed)), F.lit(parts)).cast("int"))
        return land(dealt.groupBy("part").applyInArrow(lambda t: pack_part(t, capacity), PACKED), "packed")

    def bins(table: DataFrame) -> int:
        return table.filter("item = bin").count()

    now = packed(rest.select("item", "length"), int(counts.sum()), 0)
    used = bins(now)
    seed = vain = 0
    while used > bound and vain < VAIN_DEALS:
        seed += 1
        emptiest = now.filter("item = bin").groupBy("part").agg(F.max_by("bin", F.struct("room", "bin")).alias("bin"), F.lit(True).alias("last"))
        marked = now.join(emptiest, ["part", "bin"], "left").withColumn("loose", F.expr("CASE WHEN gap > 0 THEN room > 0 ELSE coalesce(last, false) END"))
        marked = land(marked, "marked")
        loose = marked.filter("loose")
        again = packed(loose.select("item", "length"), loose.count(), seed)
        fewer = bins(loose) - bins(again)
        if fewer <= 0:
            vain += 1
            discard(spark, marked, again)
            continue
        vain = 0
        step = land(marked.filter("NOT loose").select(now.columns).unionByName(again), "packed")
        discard(spark, now, marked, again)
        now, used = step, used - fewer
    return now.selectExpr("item", "bin AS sequence_id", "offset").unionByName(alone.selectExpr("item", "item AS sequence_id", "0L AS offset"))


def pack_documents(
    docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", *,
    capacity: int = CAPACITY, end_id: int = END_ID, part_rows: int = PART_ROWS, special: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Only texts of more than ``capacity`` ids (with their end id) are cut, into pieces of ``capacity`` and a last one.
    NULL and empty texts are one piece that holds the end id. Repeated rows are packed as often as they come; no rows
    give no rows. ``path`` is a tokenizer file that exists on every executor. With ``special`` (the
    queries set it) strings like <|endoftext|> in a text have the ids of special tokens, as the library gives them when
    it is called plainly; otherwise they are plain text.
    """
    found = pieces(docs, path, doc_id, text, capacity=capacity, end_id=end_id, special=special)
    found = land(found.withColumn("item", F.monotonically_increasing_id()), "pieces")
    placed = pack(found.select("item", "length"), capacity=capacity, part_rows=part_rows)
    return found.join(placed, "item").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
