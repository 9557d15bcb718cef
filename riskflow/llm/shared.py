"""What the text operators share: scratch tables on the cluster's shared folder, text batches, byte and word hashing."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder

#: Bytes of text that a Python worker turns into words at once.
SLICE_BYTES = 1 << 20
#: A side of at most so many bytes, by its counted rows, may be broadcast.
BROADCAST_BYTES = 64 << 20


class Scratch:
    """Tables written to the shared folder so that a lost executor costs one stage, not the whole lineage."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path = spark, f"{shared_folder(spark)}/riskflow-{name}-{uuid.uuid4().hex[:12]}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.path}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def drop(self, name: str = "") -> None:
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}".rstrip("/"))
        at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def maybe_broadcast(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """df with a broadcast hint if its counted rows stay under BROADCAST_BYTES; else as it is, for a shuffled join."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def tidy() -> None:
    """Gives freed memory of a Python worker back to the system; the worker lives on and may sit idle."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        return


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that each piece has about `most` bytes of text; a single longer text stays whole. Tidies up at the end."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.binary_length(batch.column(text).cast(pa.large_string())).fill_null(0).to_numpy(zero_copy_only=False)
        part = np.cumsum(size) // most
        cuts = np.flatnonzero(np.diff(part)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            if b > a:
                yield batch.slice(a, b - a)
    tidy()


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizes 64-bit hashes so that all bits depend on all bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of each range, one range after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total, dtype=np.int64)
