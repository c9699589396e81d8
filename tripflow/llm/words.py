"""Words and documents, as every operator of this subpackage reads them.

A word is a maximal run of characters outside ``\\x20`` and ``\\x09-\\x0D``.
The column expressions stay JVM-side; the numpy half serves operators that
work on Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.session import scratch_path

WS_CLASS = r"[\x20\x09-\x0D]"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

U64 = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Bytes that belong to a word.
SOLID = ~_SPACE
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Odd base of the rolling polynomial and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
#: Texts are worked through in pieces of about this many bytes.
PIECE_BYTES = 4 << 20


def words_of(text: Column) -> Column:
    """Array of the words of a text (empty for NULL)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WS_CLASS + "+"), "")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The shuffles behind what is written meanwhile go when it is written."""
    was = spark.conf.get(_CLEAN_UP, "false")
    spark.conf.set(_CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEAN_UP, was)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a table in the shared folder and read back: cuts
    the lineage, and survives a lost executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_mod(id_col: str, m: int) -> Column:
    """crc32 of the id as text, modulo ``m``."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % F.lit(m)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: spreads every input bit over the word."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


_BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64)) | U64(1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
        np.multiply.accumulate(out, out=out)
    return out


_POW: list[np.ndarray] = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, kept between batches."""
    if len(_POW[0]) < n:
        _POW[0], _POW[1] = _powers(_BASE, n), _powers(_BASE_INV, n)
    return _POW[0][:n], _POW[1][:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Rolling polynomial sums; ``range_hash`` reads any byte range off them."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_CODE[data] * up[:-1], out=out[1:])
    return out


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes ``[start, end)``: depends on content only."""
    _, down = powers(len(sums))
    return mix((sums[end] - sums[start]) * down[start])


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of an Arrow string or binary column and each row's offsets
    (NULL counts as empty)."""
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.large_binary()
    column = column.cast(pa.large_string()).cast(wide) if pa.types.is_string(column.type) else column.cast(wide)
    if column.null_count:
        column = column.fill_null(b"")
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    if not len(offsets):
        offsets = np.zeros(1, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]: offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes (a longer text is its own range)."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


def word_bounds(data: np.ndarray, offsets: np.ndarray):
    """First and last + 1 byte of every word of some texts, in order, and the
    offsets of each text's words."""
    n = len(data)
    solid = np.zeros(n + 2, dtype=bool)
    solid[1:-1] = SOLID[data]
    edge = np.zeros(n + 1, dtype=bool)  # words end where a text ends
    edge[offsets] = True
    start = np.flatnonzero(solid[1:] & (~solid[:-1] | edge))
    end = np.flatnonzero(solid[:-1] & (~solid[1:] | edge))
    return start, end, np.searchsorted(start, offsets)


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case."""
    return _LOWER[data]


def word_hashes(data: np.ndarray, offsets: np.ndarray):
    """Hashes of all words of some texts, lower-cased, and each text's offsets."""
    data = lowered(data)
    start, end, by_text = word_bounds(data, offsets)
    return range_hash(prefix_sums(data), start, end), by_text
