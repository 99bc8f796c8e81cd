"""Shared pieces: scratch tables, Arrow batches of texts, hashes and bounded broadcasts."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import weakref
from collections.abc import Iterator
from functools import lru_cache
from typing import ClassVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words: the characters 0x20 and 0x09 to 0x0D.
SPACE = r"[\x20\x09-\x0D]+"
#: Rows of a table that may be broadcast; larger ones are joined by shuffling.
BROADCAST_ROWS = 200_000
#: Bytes of their values, with 8 for a number and 16 for an element of an array.
BROADCAST_BYTES = 16 << 20
#: The same for a side whose broadcast spares the shuffle of all texts or lines of the corpus.
SPARING = {"limit": 2_000_000, "limit_bytes": 32 << 20}
#: Whether the shuffle files of a query go when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Paths of written tables.
_written: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def _delete(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the session may have ended before
        pass


def scratch(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir.

    Only a local session may do without that setting; it gets a folder below
    the machine's temporary one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the whole cluster shares")
        base = f"file://{tempfile.gettempdir()}/folioscan"
    return base.rstrip("/")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write df once to the shared folder and return a scan of it.

    Cuts the lineage: what reads the result survives the loss of executors
    without computing df again, so the shuffle files behind it go as soon as
    it is written. Its own files go by discard(), or when the driver's Python ends.
    """
    spark = df.sparkSession
    path = f"{scratch(spark)}/folioscan-{uuid.uuid4().hex}-{label}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    atexit.register(_delete, spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    _written[out] = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that materialise returned; nothing may read them any more."""
    for df in tables:
        path = _written.pop(df, None)
        if path:
            _delete(df.sparkSession, path)


def small(df: DataFrame, limit: int = BROADCAST_ROWS, limit_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """df with a broadcast hint if it has at most `limit` rows of `limit_bytes` in all, measured first; df itself beyond."""
    sizes = [F.octet_length(F.col(f"`{f.name}`")) if f.dataType.typeName() in ("string", "binary") else F.lit(16) * F.size(F.col(f"`{f.name}`")) if f.dataType.typeName() == "array" else F.lit(8) for f in df.schema.fields]
    wide = sum((F.coalesce(x, F.lit(0)) for x in sizes), F.lit(0)).cast("long")
    n, held = df.select(wide.alias("b")).agg(F.count("*"), F.coalesce(F.sum("b"), F.lit(0))).first()
    return F.broadcast(df) if n <= limit and held <= limit_bytes else df


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id (as long) and the text, under fixed names; other columns can't clash."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def strings(batch: pa.RecordBatch, name: str = "text") -> Iterator[str]:
    """The texts of a batch one at a time; null counts as empty."""
    for x in batch.column(name):
        yield x.as_py() or ""


def raw(batch: pa.RecordBatch, name: str = "text") -> Iterator[bytes]:
    """The UTF-8 bytes of the texts of a batch, one at a time; null counts as empty."""
    for x in batch.column(name).cast(pa.binary()):
        yield x.as_py() or b""


class Memo(dict):
    """A dict that computes missing entries and forgets all of them when there are too many; long keys aren't kept."""

    #: Length of a key up to which it is kept, so that a memo's bytes are bounded too.
    LONGEST = 64

    #: All memos of this process.
    made: ClassVar[list[Memo]] = []

    def __init__(self, compute, limit: int = 400_000):
        super().__init__()
        self.compute, self.limit = compute, limit
        Memo.made.append(self)

    @classmethod
    def only(cls, *kept: Memo) -> None:
        """Empty all other memos, as a worker serves one stage after another."""
        for memo in cls.made:
            if not any(memo is k for k in kept):
                memo.clear()

    def __missing__(self, key):
        value = self.compute(key)
        if len(key) <= self.LONGEST:
            if len(self) >= self.limit:
                self.clear()
            self[key] = value
        return value


@lru_cache(maxsize=1)
def _word_hashes() -> Memo:
    import xxhash

    return Memo(xxhash.xxh3_64_intdigest, 150_000)


def word_hashes() -> Memo:
    """64-bit hashes of words, as a Memo that a worker keeps from task to task; other memos are emptied."""
    memo = _word_hashes()
    Memo.only(memo)
    return memo


def hashed(words: list[bytes], memo: Memo) -> np.ndarray:
    return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (public splitmix constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def multipliers(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit constants."""
    start = np.uint64((seed * 0x9E3779B97F4A7C15 + 1) & (2**64 - 1))
    with np.errstate(over="ignore"):
        return mixed(start + np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def windows(hashes: np.ndarray, width: int, seed: int = 1) -> np.ndarray:
    """Hashes of all runs of `width` consecutive word hashes."""
    m = multipliers(width, seed)
    n = len(hashes) - width + 1
    out = hashes[:n] * m[0]
    for i in range(1, width):
        out += hashes[i : n + i] * m[i]
    return mixed(out)


def prefix_bits(key: Column) -> Column:
    """60 bits of the MD5 of a key, as a non-negative long; any SQL engine can repeat it."""
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")
