"""Token counts from flat, unindexed token files by a separator scan.

A token file is nothing but token codes of a fixed width, one after another; an end code
closes each document. The scan reads every file in blocks, finds the end codes of a block
with one vectorised comparison, and needs no index. A document may begin many blocks
before the one in which it ends: per block only the number of end codes and the place of
the last one are kept, and a prefix scan over those (sums and maxima, first over runs of
blocks, then within a run) gives every block the documents and the last end before it.

Files are written by Spark's own writer, each task's documents as one file. Files up to a
fixed size are read whole, larger ones in records by byte ranges, so that one file of any
length is scanned by many tasks.

Defined cases: a NULL or empty text is an end code alone, with 0 tokens; tokens after a
file's last end code are a document that is not complete; an empty file or table gives no
rows; a file whose length is no multiple of the width is an error; repeated rows are
counted each; other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hedonic.llm.common import table, text_slices, texts_between
from hedonic.llm.encoding import documents_of, library_encoder
from hedonic.session import scratch_path, written

TOKENIZER = "byte_bpe_50k.json"
# Written files: 16-bit little-endian codes, 0 ends a document, any other code is id + 1.
WIDTH, END_CODE = 2, 0
SEPARATOR = "\0\0"
BLOCK_TOKENS = 1 << 20
RUN_BLOCKS = 4096
# Files up to this size are read whole by one task, longer ones in records.
WHOLE_BYTES = 256 << 20


def write_token_files(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, doc_id: str = "doc_id", text: str = "text") -> None:
    """Token files below ``path``/kind=tokens, one per task, and beside them which document stands where.

    ``path``/kind=names has for each file the ids of its documents with their number in
    the file, but no token positions. Both come from one task, so they always agree.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, n = library_encoder(tokenizer, keeps_space=True), 0
        for batch in batches:
            texts = batch.column("text")
            for lo, hi in text_slices(texts):
                ids, counts = encoder(texts_between(texts, lo, hi))
                codes = (ids + 1).astype("<u2")
                names = batch.column("doc_id").slice(lo, hi - lo).to_pylist()
                numbers = np.arange(n, n + hi - lo)
                n += hi - lo
                yield pa.RecordBatch.from_arrays(
                    [pa.array(["tokens"] * (hi - lo)), pa.array(numbers), pa.array([c.tobytes() for c in documents_of(codes, counts)], pa.binary())], names=["kind", "n", "value"]
                )
                listed = [f"{k} {'' if name is None else name}".encode() for k, name in zip(numbers.tolist(), names)]
                yield pa.RecordBatch.from_arrays([pa.array(["names"] * (hi - lo)), pa.array(numbers), pa.array(listed, pa.binary())], names=["kind", "n", "value"])
        encoder.forget()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(encode, "kind string, n bigint, value binary")
    ordered = rows.sortWithinPartitions("kind", "n").select("kind", F.col("value").cast("string").alias("value"))
    # the writer closes every row with the separator, which is the end code
    ordered.write.partitionBy("kind").option("lineSep", SEPARATOR).text(path)


def _records(spark: SparkSession, path: str, tokens: int, width: int, most: int) -> DataFrame:
    """One long file as (file, at, data): records of equal length, read by byte ranges."""
    per = max(d for k in range(1, int(tokens**0.5) + 1) if tokens % k == 0 for d in (k, tokens // k) if d <= most)
    conf = {"fixedlengthinputformat.record.length": str(per * width)}
    base = "org.apache.hadoop.mapreduce.lib.input.FixedLengthInputFormat"
    rdd = spark.sparkContext.newAPIHadoopFile(path, base, "org.apache.hadoop.io.LongWritable", "org.apache.hadoop.io.BytesWritable", conf=conf)
    return rdd.map(lambda record: (path, record[0] // width, bytearray(record[1]))).toDF("file string, at bigint, data binary")


def find_ends(spark: SparkSession, path: str, width: int = WIDTH, end_code: int = END_CODE, block_tokens: int = BLOCK_TOKENS, whole_bytes: int = WHOLE_BYTES) -> DataFrame:
    """Per block: file, block, at (its first token), n (its tokens) and ends (places of end codes in the file)."""
    files = spark.read.format("binaryFile").load(path)
    short = files.filter(F.col("length") <= whole_bytes).select(F.col("path").alias("file"), F.lit(0).cast("long").alias("at"), F.col("content").alias("data"))
    for row in files.filter(F.col("length") > whole_bytes).select("path", "length").toLocalIterator():  # names of long files only
        if row["length"] % width:
            raise ValueError(f"{row['path']} ends within a token")
        short = short.unionByName(_records(spark, row["path"], row["length"] // width, width, block_tokens))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = np.dtype(f"<u{width}")
        for batch in batches:
            for file, at, data in zip(*(batch.column(c) for c in ("file", "at", "data"))):
                raw, first = data.as_buffer(), at.as_py()
                if raw.size % width:
                    raise ValueError(f"{file} ends within a token")
                tokens = np.frombuffer(raw, dtype=kind)
                for lo in range(0, len(tokens), block_tokens):
                    part = tokens[lo : lo + block_tokens]
                    ends = np.flatnonzero(part == end_code) + first + lo
                    columns = [pa.array([file.as_py()]), pa.array([first + lo]), pa.array([len(part)]), pa.array([ends], pa.list_(pa.int64()))]
                    yield pa.RecordBatch.from_arrays(columns, names=["file", "at", "n", "ends"])

    return short.mapInArrow(scan, "file string, at bigint, n bigint, ends array<bigint>")


def stitched(blocks: DataFrame, run_tokens: int = BLOCK_TOKENS * RUN_BLOCKS) -> DataFrame:
    """Per document: file, number (in the file), start, n_tokens and complete; by a prefix scan over blocks."""
    each = blocks.withColumns({"run": F.floor(F.col("at") / run_tokens), "some": F.size("ends").cast("long"), "last": F.try_element_at("ends", F.lit(-1))})
    runs = each.groupBy("file", "run").agg(F.sum("some").alias("some"), F.max("last").alias("last"))
    earlier = Window.partitionBy("file").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("file", "run", F.coalesce(F.sum("some").over(earlier), F.lit(0)).alias("run_some"), F.coalesce(F.max("last").over(earlier), F.lit(-1)).alias("run_last"))
    inside = Window.partitionBy("file", "run").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    placed = each.withColumns({"b_some": F.coalesce(F.sum("some").over(inside), F.lit(0)), "b_last": F.coalesce(F.max("last").over(inside), F.lit(-1))}).join(runs, ["file", "run"])
    before, last = F.col("run_some") + F.col("b_some"), F.greatest("run_last", "b_last")
    placed = placed.select("file", "ends", before.alias("before"), last.alias("last"))
    document = F.transform(
        "ends",
        lambda e, i: F.struct(
            (F.col("before") + i).alias("number"),
            (F.when(i == 0, F.col("last")).otherwise(F.get("ends", i - 1)) + 1).alias("start"),
            e.alias("end"),
        ),
    )
    closed = placed.select("file", F.inline(document)).select("file", "number", "start", (F.col("end") - F.col("start")).alias("n_tokens"), F.lit(True).alias("complete"))
    files = each.groupBy("file").agg(F.sum("n").alias("n"), F.sum("some").alias("number"), F.coalesce(F.max("last"), F.lit(-1)).alias("last"))
    rest = files.filter(F.col("n") > F.col("last") + 1)
    opened = rest.select("file", "number", (F.col("last") + 1).alias("start"), (F.col("n") - F.col("last") - 1).alias("n_tokens"), F.lit(False).alias("complete"))
    return closed.unionByName(opened)


def count_tokens(spark: SparkSession, path: str, width: int = WIDTH, end_code: int = END_CODE, block_tokens: int = BLOCK_TOKENS, whole_bytes: int = WHOLE_BYTES) -> DataFrame:
    """Per document in the token files of a folder: file, number, start, n_tokens, complete.

    The blocks are written once, so that the files are scanned once and not for every pass over the blocks.
    """
    blocks = written(find_ends(spark, path, width, end_code, block_tokens, whole_bytes), "token-blocks")
    return stitched(blocks, block_tokens * RUN_BLOCKS)


def _part(file: str) -> Column:
    return F.regexp_extract(file, r"part-(\d+)", 1).cast("int")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, part (its file), number and start in it, n_tokens (without the end code)."""
    path = scratch_path(spark, "tokens")
    write_token_files(table(spark, sf_dir, "documents"), path)
    counts = count_tokens(spark, f"{path}/kind=tokens").select(_part("file").alias("part"), "number", "start", "n_tokens")
    listed = spark.read.option("lineSep", SEPARATOR).text(f"{path}/kind=names").select(_part("_metadata.file_path").alias("part"), F.split("value", " ").alias("v"))
    names = listed.select("part", F.col("v")[0].cast("long").alias("number"), F.expr("try_cast(v[1] AS BIGINT)").alias("doc_id"))
    return names.join(counts, ["part", "number"]).select("doc_id", "part", "number", "start", "n_tokens")
