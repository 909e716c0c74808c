"""What the operators of this package share: words, Arrow helpers, sizes and written tables."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera_spark.session import checkpoint_dir, remove_scratch, scratch_path, ship_package

#: A word, as the contracts of all operators define it.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows of three or four numbers that may be broadcast, and only after they were counted.
BROADCAST_ROWS = 400_000

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

_MIX = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepared(spark: SparkSession) -> None:
    """The shared folder is known, workers can import this package, and batches of long texts stay
    small: the default of 10,000 rows a batch is lowered, any other setting is left alone."""
    checkpoint_dir(spark)
    ship_package(spark)
    if spark.conf.get(BATCH_ROWS) == "10000":
        spark.conf.set(BATCH_ROWS, "2000")


def written(df: DataFrame, name: str, partition_by: str | None = None) -> str:
    """Write a table into the shared folder and return its path: computed once, it survives a
    lost executor."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    path = written(df, name)
    frame = df.sparkSession.read.schema(df.schema).parquet(path)
    frame.scratch_path = path
    return frame


def discard(*frames: DataFrame) -> None:
    """Delete stored tables that nothing reads any more, and let go of finished shuffles."""
    for frame in frames:
        remove_scratch(frame.sparkSession, frame.scratch_path)
    release(frames[0].sparkSession)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished steps: it does so when the driver's objects
    that stand for them are collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def trim() -> None:
    """Give memory that a worker no longer uses back to the machine: workers are kept for later
    tasks, beside an executor that then wants the room itself."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def word_count(text: Column) -> Column:
    """Number of words of a text; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def lower_words(text: bytes | None) -> list[bytes]:
    """Words of a text with A-Z in lower case. ``bytes`` methods know ASCII only, and split on
    exactly the six white-space bytes of WORD."""
    return text.lower().split() if text else []


def byte_column(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    return batch.column(name).cast(pa.binary()).to_pylist()


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit (finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = values.astype(np.uint64, copy=True)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound; the same in every process."""

    def __init__(self, bound: int = 100_000):
        super().__init__()
        self._bound = bound

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self._bound:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)
_SPACES = np.zeros(256, bool)
_SPACES[[32, *range(9, 14)]] = True
#: Words from this length on are hashed one by one.
_LONG = 32


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First byte and hash of each word, the same hashes as of ``WordHashes``: xxh64 for all words of
    one length at a time."""
    import xxhash

    space = _SPACES[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]])))
    first, lengths = edges[::2], edges[1::2] - edges[::2]
    eight = np.ndarray(len(data) + 1, "<u8", buffer=data + bytes(8), strides=(1,))
    order = np.argsort(np.minimum(lengths, _LONG).astype(np.uint8), kind="stable")
    stops = np.cumsum(np.bincount(np.minimum(lengths, _LONG), minlength=_LONG + 1))
    out = np.empty(len(first), np.uint64)
    for length in range(1, _LONG):
        part = order[stops[length - 1] : stops[length]]
        if not len(part):
            continue
        at, done = first[part], 0
        h = np.full(len(part), _P5 + np.uint64(length))
        while length - done >= 8:
            h = _turned(h ^ _turned(eight[at + done] * _P2, 31) * _P1, 27) * _P1 + _P4
            done += 8
        rest = eight[at + done]
        if length - done >= 4:
            h = _turned(h ^ (rest & np.uint64(0xFFFFFFFF)) * _P1, 23) * _P2 + _P3
            rest >>= np.uint64(32)
            done += 4
        for _ in range(length - done):
            h = _turned(h ^ (rest & np.uint64(0xFF)) * _P5, 11) * _P1
            rest >>= np.uint64(8)
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
        out[part] = h ^ (h >> np.uint64(32))
    for k in order[stops[_LONG - 1] :].tolist():
        out[k] = xxhash.xxh64_intdigest(data[first[k] : first[k] + lengths[k]])
    return first, out


def text_shingles(texts: list[bytes | None], width: int = 5, together: int = 1 << 20) -> Iterator[np.ndarray]:
    """The shingles of each text, worked out for about so many bytes of texts together."""
    at = 0
    while at < len(texts):
        group, held = [], 0
        while at < len(texts) and (not group or held + len(texts[at] or b"") < together):
            group.append((texts[at] or b"").lower())
            held += len(group[-1]) + 1
            at += 1
        first, hashes = word_hashes(b" ".join(group))
        ends = np.searchsorted(first, np.cumsum([len(t) + 1 for t in group]))
        whole = shingles(hashes, width)
        for begin, end in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
            yield whole[begin : max(end - width + 1, begin)]


def shingles(hashes: np.ndarray, width: int = 5) -> np.ndarray:
    """One 64-bit hash per run of ``width`` words, in order of the text."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        total = hashes[:n].copy()
        for k in range(1, width):
            total = mixed(total * _MIX + hashes[k : k + n])
    return total


def small_or_plain(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint for a stored narrow table whose counted rows stay within the bound."""
    return F.broadcast(df) if df.count() <= rows else df
