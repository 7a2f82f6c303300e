"""Merkle manifest of a table: a subtree per source, a root above them, and witnesses that grow as leaves are appended."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windrow.llm.blocks import by_group
from windrow.llm.common import discard, id_crc, land, pick, ship

ARITY = 3
#: Levels of one block: a task appends at most ``ARITY ** LEVELS`` = 729 leaves to one frontier.
LEVELS = 6
DIGEST = 32


def joined(digests: list[bytes]) -> bytes:
    """The digest of a run of nodes, which are hashed as hex text."""
    return sha256("".join([d.hex() for d in digests]).encode()).digest()


def height(count: int) -> int:
    """Levels above ``count`` nodes until one remains."""
    levels = 0
    while count > 1:
        count, levels = -(-count // ARITY), levels + 1
    return levels


def places(position: int, count: int) -> Iterator[tuple[int, int]]:
    """Place in its run and size of that run, for each level above one of ``count`` nodes."""
    while count > 1:
        begin = position - position % ARITY
        yield position - begin, min(ARITY, count - begin)
        position, count = position // ARITY, -(-count // ARITY)


def fold(digest: bytes, steps: Iterator[tuple[int, int]], witness: bytes) -> bytes:
    """The root that a node and its siblings lead to."""
    at = 0
    for place, size in steps:
        run = [witness[i : i + DIGEST] for i in range(at, at + DIGEST * (size - 1), DIGEST)]
        run.insert(place, digest)
        at += DIGEST * (size - 1)
        digest = joined(run)
    return digest


class Frontier:
    """Open subtrees while nodes are appended from the left, each with the partial witnesses of the nodes below it.

    A run that is full closes into one node of the next level, and every witness below it is extended by the siblings
    that have just been completed. ``close`` ends the open runs from the bottom, as the last runs of their levels.
    """

    def __init__(self) -> None:
        self.open: list[list[tuple[bytes, list[bytearray]]]] = [[]]
        self.witnesses: list[bytearray] = []

    def append(self, digest: bytes) -> None:
        self.witnesses.append(bytearray())
        self._push(0, digest, self.witnesses[-1:])

    def _push(self, level: int, digest: bytes, below: list[bytearray]) -> None:
        if level == len(self.open):
            self.open.append([])
        self.open[level].append((digest, below))
        if len(self.open[level]) == ARITY:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        digests = [digest for digest, _ in run]
        for i, (_, below) in enumerate(run):
            siblings = b"".join(digests[:i] + digests[i + 1 :])
            for witness in below:
                witness += siblings
        self._push(level + 1, joined(digests), [w for _, below in run for w in below])

    def close(self, levels: int) -> bytes:
        """Raise what is open to ``levels`` and return the node that is left there."""
        for level in range(levels):
            if level < len(self.open) and self.open[level]:
                self._complete(level)
        ((digest, _),) = self.open[levels]
        return digest


def append_blocks(levels: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What adds to rows sorted by (grp, block, pos) their witness inside the block and the block's root."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in by_group(batches, ["grp", "block"]):
            frontier = Frontier()
            for digest in group.column("digest").to_pylist():
                frontier.append(digest)
            root = frontier.close(min(levels, height(group.column("n")[0].as_py())))
            done = group.drop_columns(["block", "digest"])
            done = done.append_column("witness", pa.array([bytes(w) for w in frontier.witnesses], pa.binary()))
            done = done.append_column("block_root", pa.array([root] * group.num_rows, pa.binary()))
            yield from done.to_batches()

    return run


def block_of(levels: int) -> Column:
    return F.expr(f"pos DIV {ARITY**levels}")


def ascend(nodes: DataFrame, levels: int = LEVELS) -> list[DataFrame]:
    """Rounds of appends: the nodes (grp, pos, n, digest and others), then the roots of their blocks, and so on.

    Each round is landed with each node's witness up to its block's root. With the default ``levels`` a
    round has 1/729 of the rows of the one before. The last one has a single block in each group.
    """
    rounds = []
    while True:
        others = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema if f.name != "digest")
        order = ["grp", "block"]
        dealt = nodes.withColumn("block", block_of(levels)).repartition(*order).sortWithinPartitions(*order, "pos")
        done = land(dealt.mapInArrow(append_blocks(levels), f"{others}, witness binary, block_root binary"), "witnesses")
        rounds.append(done)
        if (done.agg(F.max("n")).first()[0] or 0) <= ARITY**levels:
            return rounds
        first = done.filter(F.expr(f"pos % {ARITY**levels} = 0"))
        nodes = first.select("grp", block_of(levels).alias("pos"), F.ceil(F.col("n") / ARITY**levels).alias("n"), F.col("block_root").alias("digest"))


def descend(rounds: list[DataFrame], above: DataFrame, levels: int = LEVELS) -> DataFrame:
    """The first round's rows with whole witnesses; ``above`` has grp, witness and what else holds for a whole group.

    What a block's root has learned is handed to the block's nodes, round by round, so no group is one join key.
    """
    upper = above.withColumn("block", F.lit(0).cast("bigint"))
    for done in reversed(rounds):
        named = upper.withColumnRenamed("witness", "higher").withColumnRenamed("grp", "_grp").withColumnRenamed("block", "_block")
        on = (F.col("grp") == F.col("_grp")) & (block_of(levels) == F.col("_block"))
        met = done.join(named, on).drop("_grp", "_block", "block_root")
        lower = met.withColumn("witness", F.concat("witness", "higher")).drop("higher")
        upper = lower.select("grp", F.col("pos").alias("block"), "witness", *[c for c in above.columns if c not in ("grp", "witness")])
    return lower


def in_order(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows sorted over all partitions and landed, with ``id`` (ascending) and ``part`` (the partition)."""
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return land(ranged.withColumn("id", F.monotonically_increasing_id()).withColumn("part", F.shiftright("id", 33)), "ordered")


def parts_of(ordered: DataFrame, group: list[str]) -> DataFrame:
    """Per part and group: the first id, the rows of the group in earlier parts, and all its rows (``n``)."""
    counted = ordered.groupBy("part", *group).agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("here"))
    by = Window.partitionBy(*group)
    before = F.sum("here").over(by.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    return counted.select("part", *group, "first_id", F.coalesce(before, F.lit(0)).alias("before"), F.sum("here").over(by).alias("n"))


POSITION = "id - first_id + before"


def field(column: str) -> Column:
    """A value with its length in bytes before it; NULL is a sign of its own."""
    value = F.col(column).cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_of(columns: list[str]) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(c) for c in columns]), 256))


def manifest(
    docs: DataFrame,
    columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    doc_id: str = "doc_id",
    source: str = "source",
    claimed: dict[str, Column] | None = None,
    levels: int = LEVELS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, leaf, subroot, root, witness, pos, n, source_pos, n_sources, claim.

    Leaves hash ``columns``; those of a source, by doc_id, are joined in threes until one is left, its subroot, and
    the subroots, by source, likewise. ``witness`` are the siblings from the leaf to the root (32 bytes each), whose
    places follow from the positions and counts. ``claim`` is the leaf of the row with the columns of ``claimed`` in
    place of its own, NULL where it is the same leaf.

    Rows are sorted over all partitions by (source, doc_id, leaf); a position is the place in its partition and the
    source's rows in earlier ones, so no source is ever in one task. Aligned blocks of 729 leaves are appended to one
    frontier each, which attaches partial witnesses to its open subtrees and extends them as siblings complete. Block
    roots are further appends, in blocks of their own, until a source has one left; then subroots. What higher rounds
    add to a witness is handed down along blocks.

    Rows that repeat a doc_id within a source stand by their leaf, equal rows in any order: each has its own witness. A
    NULL id comes first, a NULL source is a source of its own before all others. No rows give no rows.
    """
    ship(docs.sparkSession)
    used = pick(docs, **{c: c for c in dict.fromkeys([doc_id, source, *columns])})
    changed = {f"__{c}": (claimed or {}).get(c, F.col(c)).cast("string") for c in columns}
    claim = F.expr("nullif(claim, digest)") if claimed else F.lit(None).cast("binary")
    hashed = (
        used.withColumns(changed)
        .select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), leaf_of(list(columns)).alias("digest"), leaf_of(list(changed)).alias("claim"))
        .withColumn("claim", claim)
    )
    leaves = land(hashed.withColumn("salt", F.monotonically_increasing_id()), "leaves")
    ordered = in_order(leaves, ["source", "doc_id", "digest", "salt"])
    discard(docs.sparkSession, leaves)
    parts = parts_of(ordered, ["source"])
    sources = in_order(parts.select("source").distinct(), ["source"])
    ranked = sources.join(parts_of(sources, []).withColumnRenamed("n", "n_sources"), "part").select("source", F.expr(POSITION).alias("grp"), "n_sources")
    known = land(parts.join(ranked, parts["source"].eqNullSafe(ranked["source"])).drop(ranked["source"]), "parts")
    met = ordered.join(known, (ordered["part"] == known["part"]) & ordered["source"].eqNullSafe(known["source"]))
    nodes = met.select("grp", F.expr(POSITION).alias("pos"), "n", ordered["doc_id"], ordered["source"], "digest", F.col("digest").alias("leaf"), "claim")
    rounds = ascend(nodes, levels)
    n_sources = known.select("grp", "n_sources").distinct()
    tops = rounds[-1].filter("pos = 0").select("grp", F.col("block_root").alias("subroot")).join(n_sources, "grp")
    over = ascend(tops.select(F.lit(0).cast("bigint").alias("grp"), F.col("grp").alias("pos"), F.col("n_sources").alias("n"), F.col("subroot").alias("digest"), "subroot"), levels)
    whole = over[-1].filter("pos = 0").select("grp", F.lit(b"").alias("witness"), F.col("block_root").alias("root"))
    above = descend(over, whole, levels).select(F.col("pos").alias("grp"), "witness", "subroot", "root", F.col("n").alias("n_sources"))
    return descend(rounds, land(above, "subroots"), levels).withColumnRenamed("grp", "source_pos")


def folded(rows: DataFrame) -> DataFrame:
    """``manifest``'s rows with ``folded_root``, which the claim (else the leaf) and the witness lead to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("claim", "leaf", "pos", "n", "source_pos", "n_sources", "witness")
        for batch in batches:
            found = []
            for claim, leaf, pos, n, above, sources, witness in zip(*[batch.column(c).to_pylist() for c in names], strict=True):
                steps = [*places(pos, n), *places(above, sources)]
                found.append(fold(leaf if claim is None else claim, iter(steps), witness))
            yield batch.append_column("folded_root", pa.array(found, pa.binary()))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{schema}, folded_root binary")


def verified(docs: DataFrame, claimed: dict[str, Column], levels: int = LEVELS) -> DataFrame:
    """``manifest`` of ``docs`` and, for the claimed columns, whether the witnesses still lead to the root."""
    done = folded(manifest(docs, claimed=claimed, levels=levels))
    text = {c: F.lower(F.hex(c)).alias(c) for c in ("leaf", "subroot", "root", "folded_root")}
    return done.select(
        "doc_id", text["leaf"], text["subroot"], text["root"], F.sha2(F.lower(F.hex("witness")).cast("binary"), 256).alias("proof_sha256"),
        text["folded_root"], F.expr("folded_root = root").alias("verified"), "source", "pos", "n",
    )


def without_line_ends(doc_id: str = "doc_id", text: str = "text") -> dict[str, Column]:
    """Tampering to be found: line ends deleted from the texts of rows whose crc32 of the id is even."""
    return {text: F.when(id_crc(doc_id) % 2 == 0, F.replace(F.col(text), F.lit("\n"), F.lit(""))).otherwise(F.col(text))}
