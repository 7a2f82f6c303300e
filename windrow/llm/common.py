"""What the text operators share: the shared folder, landed tables, shipped code, bounded Arrow batches."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that one step of a Python task takes from an Arrow batch at most (a longer text is taken alone).
SLICE_BYTES = 4 << 20


def shared_folder(spark: SparkSession) -> str:
    """A folder of this application that driver and executors share: below ``spark.checkpoint.dir``.

    Only where the session names none and is a local one (tests) a temporary folder takes its place.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="shared-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def land(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write a table to the shared folder and read it again: cuts the lineage and survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete landed tables that no later step reads."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for table in tables:
        for file in {f.rpartition("/")[0] for f in table.inputFiles()}:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(file)
            path.getFileSystem(hadoop).delete(path, True)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, for sessions whose executors lack it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="package-")) / f"{root.name}.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


def whole_text(text: str = "text") -> Column:
    """The text as it is; NULL counts as empty."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def id_crc(doc_id: str = "doc_id") -> Column:
    """crc32 of the id written as text; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")))


def pick(df: DataFrame, **columns: Column | str) -> DataFrame:
    """Only the named columns, so that others of any name cannot clash."""
    return df.select(*[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in columns.items()])


def sliced(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows whose texts hold about ``most`` bytes together."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at = np.cumsum(string_lengths(batch.column(column)), dtype=np.int64)
        begin = 0
        while begin < batch.num_rows:
            done = at[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(at, done + most, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end


ARROW_KINDS = {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary()}


def arrow_schema(columns: str) -> pa.Schema:
    """Arrow's schema for plain columns in Spark's notation (``a int, b string``)."""
    return pa.schema([(name, ARROW_KINDS[kind]) for name, kind in (part.split() for part in columns.split(","))])


def string_lengths(column: pa.Array) -> np.ndarray:
    return string_parts(column)[1][1:] - string_parts(column)[1][:-1]


def string_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all strings of a column, and where each begins in them (one more than there are rows)."""
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        wide = np.int64
    else:
        wide = np.int32
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, wide)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def crunch(array: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(array).tobytes(), codec="zstd", asbytes=True)


def expand(blob: bytes, kind: str, count: int) -> np.ndarray:
    size = count * np.dtype(kind).itemsize
    return np.frombuffer(pa.decompress(blob, decompressed_size=size, codec="zstd", asbytes=True), kind)


def module_file(name: str) -> str:
    """Path of a public vocabulary file beside the installed tokenizers."""
    import public_tokenizers

    path = public_tokenizers.path(name)
    if not os.path.exists(path):
        raise FileNotFoundError(path)
    return path


class Remembered(dict):
    """A dictionary that keeps what was used lately: entries of the last full generation can be taken back."""

    def __init__(self, most: int):
        self.most, self.old = most, {}

    def turn(self) -> None:
        """Begin a new generation if this one is full."""
        if len(self) > self.most:
            self.old = dict(self)
            self.clear()

    def missing(self, keys: set) -> list:
        """The keys that must be worked out; those of the last generation are taken back."""
        out = []
        for key in keys.difference(self):
            if (value := self.old.get(key)) is None:
                out.append(key)
            else:
                self[key] = value
        return out
