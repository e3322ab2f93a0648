"""Small helpers that the operators of this package share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters between words; everything else belongs to a word.
GAP = r"[\x20\x09-\x0D]+"
# Python tasks work through an Arrow batch in slices of about so many bytes of text.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """The words of a text as an array; NULL gives no words."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != F.lit(""))


def text_slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a text column, each of about ``most`` bytes or one longer text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < len(ends):
        done = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield lo, hi
        lo = hi


def texts_between(texts: pa.Array, lo: int, hi: int) -> list[str]:
    """The texts of a row range, empty where NULL."""
    return [t or "" for t in texts.slice(lo, hi - lo).to_pylist()]


def give_back() -> None:
    """Return the memory that a task has freed to the system, as at its end: the worker lives on for other work."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim:
        trim(0)


def run_starts(counts: np.ndarray) -> np.ndarray:
    """Offsets 0, c0, c0+c1, ... including the total."""
    out = np.zeros(len(counts) + 1, dtype=np.int64)
    np.cumsum(counts, out=out[1:])
    return out


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The positions starts[k], ..., starts[k] + counts[k] - 1 of every k, one after another."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(np.asarray(starts, dtype=np.int64) - (ends - counts), counts) + np.arange(total, dtype=np.int64)


def within(classes: np.ndarray) -> np.ndarray:
    """For each element, how many equal elements stand before it."""
    order = np.argsort(classes, kind="stable")
    ordered = classes[order]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else np.zeros(0, dtype=np.int64)
    counts = np.diff(np.r_[first, len(ordered)])
    out = np.empty(len(classes), dtype=np.int64)
    out[order] = np.arange(len(classes)) - np.repeat(first, counts)
    return out


def long_type(name: str) -> T.StructField:
    return T.StructField(name, T.LongType())


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once per row, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def ascii_lower(text: Column) -> Column:
    """A text with A-Z lower-cased and all other characters as they are."""
    plain = F.octet_length(text) == F.char_length(text)  # then no other letters have a case
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, ascii_uppercase, ascii_lowercase))
