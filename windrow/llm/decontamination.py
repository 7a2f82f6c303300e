"""Benchmark passages in documents: a set join over the rarest shingle of each window; built-in expressions only."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windrow.llm.common import land, pick, whole_text

#: Words of a window of an item.
WINDOW = 10
#: Words of a shingle.
SHINGLE = 5
#: Rows of a broadcast table at most: 32 MB of 64-bit shingles; windows and their items also keep to ``BROADCAST_CHARS``.
BROADCAST_ROWS = 500_000
BROADCAST_CHARS = 64 << 20
#: Copies of the smaller side of a join that is not broadcast, so that one frequent shingle is dealt to as many tasks.
SALTS = 16

# Fixed value: what parts words, once A-Z are lower case.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of a text without NULL; only A-Z are put in lower case."""
    plain = F.octet_length(text) == F.char_length(text)
    lowered = F.when(plain, F.lower(text)).otherwise(F.translate(text, ascii_uppercase, ascii_lowercase))
    return F.array_remove(F.split(lowered, BETWEEN), "")


def shingle_at(words: Column, at: Column, size: int) -> Column:
    """64 bits of the ``size`` words from place ``at`` (from 1); NULL if they reach over the end."""
    parts = [F.get(words, at + (i - 1)) for i in range(size)]
    return F.when(parts[-1].isNotNull(), F.xxhash64(F.lit(size), *parts))


def item_windows(items: DataFrame, item_id: str, text: str, window: int) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (win, length, words), and the items that hold them (win, item)."""
    worded = pick(items, item=F.col(item_id).cast("string"), words=words_of(whole_text(text))).filter("size(words) > 0")
    begins = F.expr(f"explode(sequence(1, greatest(size(words) - {window} + 1, 1)))")
    held = worded.select("item", "words", begins.alias("begin"))
    held = held.select("item", F.expr(f"slice(words, begin, {window})").alias("words")).distinct()
    distinct = land(held.select("words").distinct().withColumn("win", F.monotonically_increasing_id()), "windows")
    members = held.filter("item IS NOT NULL").join(distinct, "words").select("win", "item")
    return distinct.withColumn("length", F.size("words")), land(members, "members")


def met(rows: DataFrame, table: DataFrame, key: str, spread: list[str], chars: Column | None, most: int) -> DataFrame:
    """Inner join of many rows with a table: broadcast if its size allows, else with the table copied to salted keys."""
    size = table.agg(F.count(F.lit(1)), F.sum(F.lit(0) if chars is None else chars)).first()
    if size[0] <= most and (size[1] or 0) <= BROADCAST_CHARS:
        return rows.join(F.broadcast(table), key)
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int"))
    copies = table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies.hint("merge"), [key, "salt"]).drop("salt")


def shingle_rows(texts: DataFrame, sizes: list[int]) -> DataFrame:
    """Each text once with ``at`` 0 and no shingle, and once for every shingle of the given sizes."""
    rows = texts.withColumn("at", F.explode(F.sequence(F.lit(0), F.col("n_words"))))
    if len(sizes) == 1:
        return rows.withColumn("shingle", F.when(F.col("at") > 0, shingle_at(F.col("words"), F.col("at"), sizes[0])))
    rows = rows.withColumn("size", F.explode(F.when(F.col("at") > 0, F.array(*[F.lit(s) for s in sizes])).otherwise(F.array(F.lit(0)))))
    shingle = F.lit(None).cast("bigint")
    for s in sizes:
        shingle = F.when(F.col("size") == s, shingle_at(F.col("words"), F.col("at"), s)).otherwise(shingle)
    return rows.withColumn("shingle", shingle).drop("size")


def find_shingles(texts: DataFrame, shingles: DataFrame, sizes: list[int], window: int, most: int) -> tuple[DataFrame, DataFrame]:
    """All texts (row, doc_id, n_words), and where they hold one of the shingles, with the words around that place.

    With a broadcast table texts are read once, and nothing but what is found is written. A larger table is joined by
    the shuffle; then the words of all texts are landed first.
    """
    around = F.expr(f"slice(words, greatest(at - {window} + 1, 1), {2 * window} - 1)").alias("around")
    if shingles.count() <= most:
        marked = shingle_rows(texts, sizes).join(F.broadcast(shingles.withColumn("known", F.lit(True))), "shingle", "left")
        found = land(marked.filter("known OR at = 0").select("row", "doc_id", "n_words", "at", "shingle", F.when(F.col("at") > 0, around).alias("around")), "found")
        return found.filter("at = 0").select("row", "doc_id", "n_words"), found.filter("at > 0").drop("doc_id")
    texts = land(texts, "worded")
    places = shingle_rows(texts, sizes).filter("shingle IS NOT NULL").select("row", "at", "shingle")
    matched = met(places, shingles, "shingle", ["row", "at"], None, most)
    found = matched.join(texts.drop("doc_id"), "row").select("row", "n_words", "at", "shingle", around)
    return texts.select("row", "doc_id", "n_words"), land(found, "found")


def decontaminate(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", *,
    window: int = WINDOW, shingle: int = SHINGLE, most: int = BROADCAST_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, items (sorted texts of item ids), contaminated.

    A window is ``window`` consecutive words of an item, or all words of a shorter one. A word of a document is hit if
    it lies in an occurrence of a window. Seen as sets of shingles of ``shingle`` words (of shorter windows: of all
    their words), a window must be contained wholly, so by the prefix filter one shingle of each is necessary: the
    first in an order by rarity. Shingles of all windows are looked up in the documents once; what is found gives their
    frequencies, by which each window takes its rarest one (a window with a shingle that never occurs is out). Its
    places are joined with the window; the place of the shingle in the window gives that of the window, which must lie
    within the document (bounds on position and length), and all its words are compared.

    Tables that grow with the items are broadcast up to ``most`` rows, beyond that joined by salted keys.
    Windows that occur in one document are united by a running maximum of their ends.

    NULL texts have no words, items without words no windows. Rows of ``docs`` count one by one, repeated ones too. Of
    repeated items each counts once per id; an item without id hits words but is not listed. No rows give no rows.
    """
    windows, members = item_windows(items, item_id, item_text, window)
    parts = windows.withColumn("size", F.least("length", F.lit(shingle)))
    sizes = sorted(r[0] for r in parts.select("size").distinct().collect())  # at most ``shingle`` values
    exploded = parts.withColumn("offset", F.explode(F.expr("sequence(0, length - size)")))
    hashes = F.lit(None).cast("bigint")
    for s in sizes:
        hashes = F.when(F.col("size") == s, shingle_at(F.col("words"), F.col("offset") + 1, s)).otherwise(hashes)
    tokens = land(exploded.select("win", "offset", hashes.alias("shingle")), "tokens")

    texts = pick(docs, doc_id=doc_id, words=words_of(whole_text(text)))
    texts = texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", "words", F.size("words").alias("n_words"))
    every, found = find_shingles(texts, land(tokens.select("shingle").distinct(), "shingles"), sizes or [shingle], window, most)

    rarity = found.groupBy("shingle").agg(F.count(F.lit(1)).alias("times"))
    ranked = tokens.join(rarity, "shingle", "left").groupBy("win").agg(F.min(F.struct(F.coalesce("times", F.lit(0)).alias("times"), "shingle", "offset")).alias("first"))
    prefixes = land(ranked.filter("first.times > 0").select("win", "first.shingle", "first.offset").join(windows, "win"), "prefixes")
    begin = F.expr("at - offset")
    met_ = met(found, prefixes, "shingle", ["row", "at"], F.char_length(F.array_join("words", " ")), most).withColumn("begin", begin)
    fits = met_.filter("length <= n_words AND begin >= 1 AND begin + length - 1 <= n_words")
    same = f"slice(around, begin - greatest(at - {window} + 1, 1) + 1, length) = words"
    occurring = land(fits.filter(same).select("row", "win", "begin", F.expr("begin + length - 1").alias("end")), "occurring")

    earlier = F.max("end").over(Window.partitionBy("row").orderBy("begin", "end").rowsBetween(Window.unboundedPreceding, -1))
    new = occurring.withColumn("new", F.col("end") - F.greatest(F.col("begin") - 1, F.coalesce(earlier, F.lit(0))))
    hits = new.groupBy("row").agg(F.sum(F.greatest("new", F.lit(0))).alias("n_hit"))
    pairs = met(occurring.select("row", "win").distinct(), members, "win", ["row"], F.char_length("item"), most).select("row", "item")
    listed = pairs.groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    out = every.join(hits, "row", "left").join(listed, "row", "left")
    return out.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.col("n_hit").isNotNull().alias("contaminated"),
    )
