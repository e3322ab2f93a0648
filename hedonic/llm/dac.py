"""Token ids as directly addressable codes, written to and read from files.

An id is split into chunks of eight bits. The first chunks of all ids stand together in
level 0, with a bitmap that tells which ids go on; the second chunks of those stand in
level 1, and so on. The place of an id's next chunk is the number of set bits before its
place, which a rank directory (the count up to every 512th bit) and the bits of one
block of 512 give. So any token is read by itself, without decoding those before it.

File format: a Parquet data set (its pages uncompressed, so that a reader can address
them), one row per segment of whole documents in ascending order of their ids:
``part`` and ``segment`` (their order), ``doc_id``, ``start`` (first token of each
document, counted within the part), ``n_tokens`` (of each document) and ``codes``.
Beside it, ``offsets`` holds the tokens before each part. ``codes`` is, little-endian:
the magic ``DAC1``, the number of levels, then for each level its length, the chunks,
the bitmap and the rank directory (both empty in the last level).

Defined cases: a NULL or empty text is its end id alone; NULL document ids come first;
rows with equal ids are ordered by a hash of their texts, equal rows in any order;
an empty table gives an empty data set; other columns are not carried.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hedonic.llm.common import run_starts, table, text_slices, texts_between
from hedonic.llm.encoding import documents_of, library_encoder, with_end
from hedonic.session import scratch_path

MAGIC = b"DAC1"
RANK_BITS = 512
SEGMENT_TOKENS = 1 << 18
# Bytes of text encoded in one call: more of them share their words, whose table is looked through once a call.
ENCODED_BYTES = 1 << 22
TOKENIZER = "byte_bpe_50k.json"
END_ID = 2

FILE_SCHEMA = "part int, segment int, doc_id array<bigint>, start array<bigint>, n_tokens array<bigint>, codes binary"
OFFSET_SCHEMA = "part int, before bigint"


def encode(ids: np.ndarray) -> bytes:
    """The codes of non-negative ids of up to 64 bits."""
    rest, levels = np.asarray(ids, dtype=np.uint64), []
    while True:
        chunks, more = (rest & 0xFF).astype(np.uint8), rest >> 8
        goes_on = more > 0
        last = not goes_on.any()
        bitmap = b"" if last else np.packbits(goes_on, bitorder="little").tobytes()
        ranks = b"" if last else run_starts(np.add.reduceat(goes_on, np.arange(0, len(rest), RANK_BITS), dtype=np.int64))[:-1].astype("<u4").tobytes()
        levels.append((chunks, bitmap, ranks))
        if last:
            break
        rest = more[goes_on]
    out = [MAGIC, np.array([len(levels)], dtype="<u4").tobytes()]
    for chunks, bitmap, ranks in levels:
        out += [np.array([len(chunks)], dtype="<u4").tobytes(), chunks.tobytes(), bitmap, ranks]
    return b"".join(out)


class Codes:
    """Reads single tokens, ranges or all of a segment's codes."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("these are not directly addressable codes")
        count, at = int(np.frombuffer(data, "<u4", 1, 4)[0]), 8
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for level in range(count):
            n, at = int(np.frombuffer(data, "<u4", 1, at)[0]), at + 4
            chunks, at = np.frombuffer(data, np.uint8, n, at), at + n
            bits = 0 if level == count - 1 else -(-n // 8)
            blocks = 0 if level == count - 1 else -(-n // RANK_BITS)
            bitmap, at = np.frombuffer(data, np.uint8, bits, at), at + bits
            ranks, at = np.frombuffer(data, "<u4", blocks, at), at + 4 * blocks
            self.levels.append((chunks, bitmap, ranks))

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def __getitem__(self, i: int) -> int:
        """Token ``i``: one chunk per level, one block of the bitmap between two levels."""
        if not 0 <= i < len(self):
            raise IndexError(i)
        value, shift = 0, 0
        for chunks, bitmap, ranks in self.levels:
            value |= int(chunks[i]) << shift
            shift += 8
            if not len(bitmap) or not bitmap[i >> 3] >> (i & 7) & 1:
                break
            i = self._rank(bitmap, ranks, i)
        return value

    @staticmethod
    def _rank(bitmap: np.ndarray, ranks: np.ndarray, i: int) -> int:
        """The set bits before bit ``i``."""
        block = i // RANK_BITS
        first = block * RANK_BITS // 8
        inside = np.unpackbits(bitmap[first : (i >> 3) + 1], bitorder="little")[: i - block * RANK_BITS]
        return int(ranks[block]) + int(inside.sum())

    def between(self, lo: int, hi: int) -> np.ndarray:
        """Tokens lo, ..., hi - 1; only their own chunks are read."""
        lo, hi = max(lo, 0), min(hi, len(self))
        out, where, shift = np.zeros(max(hi - lo, 0), dtype=np.uint64), np.arange(max(hi - lo, 0)), 0
        for chunks, bitmap, ranks in self.levels:
            if lo >= hi:
                break
            out[where] |= chunks[lo:hi].astype(np.uint64) << np.uint64(shift)
            shift += 8
            if not len(bitmap):
                break
            bits = np.unpackbits(bitmap[lo >> 3 : (hi + 7) >> 3], bitorder="little")[lo & 7 :][: hi - lo].astype(bool)
            where, lo = where[bits], self._rank(bitmap, ranks, lo)
            hi = lo + len(where)
        return out.astype(np.uint32) if shift <= 32 else out

    def all(self) -> np.ndarray:
        return self.between(0, len(self))


def write_codes(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encode every whole text, add the end id and write the files below ``path``, in ascending order of the ids.

    One range shuffle orders the rows; a text hash as second key also splits a hot id.
    """
    ordered = (
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("tie"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .select("doc_id", "text")
    )

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encoder = TaskContext.get().partitionId(), library_encoder(tokenizer, keeps_space=True)
        number, before, names, counts, ids = 0, 0, [], [], []

        def closed() -> pa.RecordBatch:
            nonlocal number, before, names, counts, ids
            sizes = np.concatenate(counts)
            starts = before + run_starts(sizes)
            row = [[part], [number], [names], [starts[:-1]], [sizes], [encode(np.concatenate(ids))]]
            kinds = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            number, before, names, counts, ids = number + 1, int(starts[-1]), [], [], []
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(row, kinds)], names=["part", "segment", "doc_id", "start", "n_tokens", "codes"])

        open_tokens = 0
        for batch in batches:
            texts = batch.column("text")
            for lo, hi in text_slices(texts, ENCODED_BYTES):
                got, sizes = with_end(*encoder(texts_between(texts, lo, hi)), end_id)
                names += batch.column("doc_id").slice(lo, hi - lo).to_pylist()
                counts.append(sizes)
                ids.append(got)
                open_tokens += len(got)
                if open_tokens >= SEGMENT_TOKENS:
                    yield closed()
                    open_tokens = 0
        if names:
            yield closed()
        encoder.forget()

    ordered.mapInArrow(segments, FILE_SCHEMA).write.option("compression", "uncompressed").parquet(f"{path}/segments")
    spark = docs.sparkSession
    sizes = read_segments(spark, path).select("part", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, n: a + n).alias("n")).groupBy("part").agg(F.sum("n").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    sizes.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")).write.parquet(f"{path}/offsets")


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FILE_SCHEMA).parquet(f"{path}/segments")


def read_offsets(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(OFFSET_SCHEMA).parquet(f"{path}/offsets")


def token_at(spark: SparkSession, path: str, doc_id: int, position: int) -> int | None:
    """One token of one document, through the rank directory; None if there is no such token."""
    at = F.array_position("doc_id", F.lit(doc_id).cast("long")).cast("int")
    row = (
        read_segments(spark, path)
        .filter(F.array_contains("doc_id", F.lit(doc_id).cast("long")))
        .select("codes", (F.element_at("start", at) - F.element_at("start", F.lit(1))).alias("first"), F.element_at("n_tokens", at).alias("n"))
        .first()
    )
    return Codes(bytes(row["codes"]))[row["first"] + position] if row and 0 <= position < row["n"] else None


def read_documents(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """From the files, per document: doc_id, start (tokens of all documents before it), n_tokens, ids_crc32, and the ids if wanted."""
    schema = "part int, doc_id bigint, local bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<bigint>" if with_ids else "")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, sizes = Codes(row["codes"]).all().astype("<u4"), np.array(row["n_tokens"], dtype=np.int64)
                each = list(documents_of(ids, sizes))
                columns = [
                    pa.array(np.full(len(sizes), row["part"], dtype=np.int32)),
                    pa.array(row["doc_id"], pa.int64()),
                    pa.array(row["start"], pa.int64()),
                    pa.array(sizes),
                    pa.array([zlib.crc32(i.tobytes()) for i in each], pa.int64()),
                ]
                names = ["part", "doc_id", "local", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns, names = [*columns, pa.array([i.astype(np.int64) for i in each], pa.list_(pa.int64()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    # few segments per Arrow batch: each is some hundred kilobytes
    rows = read_segments(spark, path).select("part", "doc_id", "start", "n_tokens", "codes").mapInArrow(read, schema)
    # offsets have one row per written part, some thousands at most
    placed = rows.join(F.broadcast(read_offsets(spark, path)), "part")
    return placed.select("doc_id", (F.col("before") + F.col("local")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


def op5_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "codes")
    write_codes(table(spark, sf_dir, "documents"), path)
    return read_documents(spark, path)
