"""Comparing the members of groups of any size in bounded pieces."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of one block; a pair of blocks is what one step of a task holds.
BLOCK_ROWS = 2048


def block_pairs(rows: DataFrame, keys: list[str], size: str, spread: Column, most: int = BLOCK_ROWS) -> DataFrame:
    """Rows of each group dealt to its pairs of blocks, sorted by (keys, block_a, block_b) within partitions.

    A group of ``size`` rows has ceil(size / most) blocks. Block i meets itself (block_a = block_b) and every other
    block once; ``block`` says to which of the two a row belongs. A hot group is spread over many tasks this way.
    """
    count = F.ceil(F.col(size) / F.lit(most)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    order = [*keys, "block_a", "block_b"]
    dealt = (
        rows.withColumn("blocks", count)
        .withColumn("block", F.pmod(spread, F.col("blocks")).cast("int"))
        .withColumn("other", other)
        .withColumn("block_a", F.least("block", "other"))
        .withColumn("block_b", F.greatest("block", "other"))
        .drop("other", "blocks", size)
    )
    return dealt.repartition(*order).sortWithinPartitions(*order)


def by_group(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Whole groups of rows that are sorted by ``keys``, each as one table; holds one group and one batch."""
    held: list[pa.RecordBatch] = []
    mark = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = columns[0][1:] != columns[0][:-1]
        for column in columns[1:]:
            new = new | (column[1:] != column[:-1])
        begins = [0, *(new.nonzero()[0] + 1).tolist(), batch.num_rows]
        for begin, end in zip(begins, begins[1:], strict=False):
            now = tuple(column[begin] for column in columns)
            if held and now != mark:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            mark = now
            held.append(batch.slice(begin, end - begin))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
