"""Helpers shared by the text operators: table reads, scratch tables, byte arrays.

Inside tasks, a batch of texts is joined to one byte buffer and handled as
numpy arrays, in slices of ``SLICE_BYTES`` so that memory does not depend on
the size of an Arrow batch.  One text longer than that is a slice of its own.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.session import checkpoint_root, scratch_path, ship_package

SLICE_BYTES = 1 << 20
#: Bytes of an Arrow batch between Spark and a task's Python worker; one row may exceed it.
BATCH_BYTES = 4 << 20
U = np.uint64
MULT = U(0x9E3779B97F4A7C15)
SEED = U(0x632BE59BD9B4E019)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Make the package importable in tasks and the shared scratch folder known.

    Arrow batches are cut by bytes, so the memory of a task does not grow with the length
    of 10,000 texts (Spark's default batch).
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    ship_package(spark)
    checkpoint_root(spark)


def stored(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared scratch folder (or ``path``) and read it back.

    Cuts the lineage: a lost executor only costs tasks that read the files.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, "llm", name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of ended queries.

    Its cleaner follows the garbage collections of the driver, which may come late.
    Call it between stored steps: nothing that is still to run reads those files.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def drop_stored(spark: SparkSession, path: str) -> None:
    """Delete a stored table that no later query reads."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def give_back() -> None:
    """Return freed memory of this process to the machine; call it at the end of a task.

    Spark keeps a task's Python worker for later tasks.  The C library keeps what numpy and
    Arrow have freed, so an idle worker would hold the most that any task before has used.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def text_column(df: DataFrame, name: str = "text") -> Column:
    """The text, null as the empty string."""
    return F.coalesce(df[name].cast("string"), F.lit(""))


def slices(sizes: Sequence[int], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of at most ``limit`` bytes (one item may exceed it)."""
    lo = total = 0
    for i, n in enumerate(sizes):
        if i > lo and total + n > limit:
            yield lo, i
            lo, total = i, 0
        total += n
    if lo < len(sizes):
        yield lo, len(sizes)


def encoded(values: Sequence[str | None]) -> list[bytes]:
    """UTF-8 of each text; null gives no bytes."""
    return [b"" if v is None else v.encode("utf-8", "surrogatepass") for v in values]


def mixed(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that all bits depend on all bits."""
    h = h ^ (h >> U(31))
    h = h * U(0xBF58476D1CE4E5B9)
    h ^= h >> U(29)
    h = h * U(0x94D049BB133111EB)
    h ^= h >> U(32)
    return h


def byte_table(separators: str | set[int], lower: bool = True, nul: int = 0) -> bytes:
    """Translation table: separator bytes to 0, A-Z to a-z, other bytes as they are.

    Byte 0 separates words too, unless ``nul`` is another byte for it (0xFF is not in UTF-8).
    """
    seps = {ord(c) for c in separators} if isinstance(separators, str) else separators
    out = bytearray(range(256))
    for b in range(256):
        if b in seps:
            out[b] = 0
        elif lower and 65 <= b <= 90:
            out[b] = b + 32
    if 0 not in seps:
        out[0] = nul
    return bytes(out)


class Words:
    """Words of several texts as byte ranges of one buffer.

    ``table`` maps separator bytes to 0.  ``start``/``end`` are byte positions of
    the words, ``first[i]:first[i + 1]`` are the words of text ``i``.
    """

    def __init__(self, texts: Sequence[bytes], table: bytes):
        self.raw = b"\0".join([b"", *(t.translate(table) for t in texts), b"\0" * 16])
        buf = np.frombuffer(self.raw, np.uint8)
        inside = buf != 0
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        self.start, self.end = edges[0::2], edges[1::2]
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        begins = np.concatenate([[1], 1 + np.cumsum(sizes)]).astype(np.int64)
        self.first = np.searchsorted(self.start, begins)
        self._u64 = np.ndarray((len(self.raw) - 7,), "<u8", self.raw, 0, (1,))

    def hashes(self, at: np.ndarray | None = None) -> np.ndarray:
        """64-bit hashes of the words (or of those at the given indices)."""
        start = self.start if at is None else self.start[at]
        size = (self.end if at is None else self.end[at]) - start
        return hash_ranges(self._u64, start, size)

    def bytes(self, i: int) -> bytes:
        return self.raw[self.start[i]:self.end[i]]


def hash_ranges(u64: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hash byte ranges; ``u64[i]`` is the little-endian word at byte ``i``."""
    h = SEED ^ (size.astype(U) * MULT)
    if not len(start):
        return h

    def step(h, pos, left):
        v = u64[pos]
        short = np.minimum(left, 8)
        v = v & (~U(0) >> ((U(8) - short.astype(U)) * U(8)))
        h = (h ^ v) * MULT
        return h ^ (h >> U(32))

    h = step(h, start, size)
    live, off = np.flatnonzero(size > 8), 8
    while len(live):
        h[live] = step(h[live], start[live] + off, size[live] - off)
        off += 8
        live = live[size[live] > off]
    return mixed(h)


def joined_hash(word_hash: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive word hashes (length n - k + 1)."""
    n = len(word_hash) - k + 1
    h = np.full(max(n, 0), SEED, U)
    for j in range(k):
        if n > 0:
            h = (h ^ word_hash[j:j + n]) * MULT
            h ^= h >> U(32)
    return mixed(h)
