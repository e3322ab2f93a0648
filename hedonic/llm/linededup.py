"""Lines that many documents share are dropped from all but one of them.

Every line's key (stripped, A-Z lower-cased) is hashed to 128 bits. A table of those
hashes with their line numbers, in order within each text, is written once; documents are
counted per hash with a partial count in every task, so that a line which most documents
hold is one row per task in the shuffle. Hashes over the threshold, with the largest
document id that holds them, are joined back to the line numbers, and the numbers to drop
go back to their texts, which are put together again from the stretches between them.
No text is shuffled line by line, and everything is plain columns.

Defined cases: a NULL or empty text is one empty line; every row is a document, so repeated
rows count each, and rows with the largest id that holds a line all keep it; a NULL id is
smaller than any other; a line that a text repeats counts once, and is dropped or kept
everywhere in that text; an empty table gives no rows; columns that aren't asked for are
not carried, one that is named like a result is an error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hedonic.llm.common import ascii_lower, let, table
from hedonic.session import Lookup, written

MIN_CHARS = 20
MIN_DOCUMENTS = 3
STRIPPED = " \t\n\x0b\x0c\r"
RESULTS = ["n_lines", "n_dropped", "kept_text"]


def _text(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def _identity(doc_id: str, text: str) -> list[Column]:
    """A row's id and 128 bits of its text: rows that are equal in these lose the same lines."""
    return [F.col(doc_id).alias("_id"), F.xxhash64(_text(text)).alias("_t1"), F.xxhash64(F.lit(1), _text(text)).alias("_t2")]


def line_hashes(docs: DataFrame, doc_id: str, text: str, min_chars: int) -> DataFrame:
    """Per row its identity and ``lines``: hashes and line numbers of its keys of ``min_chars`` and more, in order."""
    keys = F.transform(F.split(ascii_lower(_text(text)), "\n", -1), lambda line, i: F.struct(F.btrim(line, F.lit(STRIPPED)).alias("key"), i.alias("at")))
    long_keys = F.filter(keys, lambda x: F.char_length(x["key"]) >= min_chars)
    hashed = F.transform(long_keys, lambda x: F.struct(F.xxhash64(x["key"]).alias("h1"), F.xxhash64(F.lit(1), x["key"]).alias("h2"), x["at"].alias("at")))
    return written(docs.select(*_identity(doc_id, text), F.sort_array(hashed).alias("lines")), "lines")


def shared_lines(lines: DataFrame, min_documents: int) -> DataFrame:
    """Hashes that at least so many documents hold, and ``keeper``, the largest id among those."""

    def first(x: Column, i: Column) -> Column:
        before = F.get("lines", i - 1)
        return (i == 0) | (before["h1"] != x["h1"]) | (before["h2"] != x["h2"])

    each = lines.select("_id", F.inline(F.filter("lines", first)))
    counted = each.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("_id").alias("keeper"))
    return counted.filter(F.col("n") >= min_documents).select("h1", "h2", "keeper")


def dropped_numbers(lines: DataFrame, shared: Lookup) -> DataFrame:
    """Per identity with lines to drop, their numbers in order."""
    hits = lines.select("_id", "_t1", "_t2", F.inline("lines")).join(shared.side, ["h1", "h2"]).filter(~F.col("_id").eqNullSafe(F.col("keeper")))
    return hits.groupBy("_id", "_t1", "_t2").agg(F.sort_array(F.collect_set("at")).alias("_drop"))


def without_lines(text: Column, drop: Column) -> Column:
    """A text without the lines of the given numbers (in order), as the stretches between those."""

    def stretches(lines: Column) -> Column:
        ends = F.concat(F.array(F.lit(-1)), drop, F.array(F.size(lines)))
        return let(ends, lambda b: F.flatten(F.transform(F.sequence(F.lit(0), F.size(b) - 2), lambda k: F.slice(lines, F.get(b, k) + 2, F.get(b, k + 1) - F.get(b, k) - 1))))

    return let(F.split(text, "\n", -1), lambda lines: F.array_join(stretches(lines), "\n"))


def drop_lines(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    keep: Sequence[str] = ("doc_id",),
    min_chars: int = MIN_CHARS,
    min_documents: int = MIN_DOCUMENTS,
) -> DataFrame:
    """The kept columns with n_lines (before dropping), n_dropped and kept_text of every row."""
    if set(keep) & set(RESULTS):
        raise ValueError(f"columns named like the results {RESULTS} must be renamed")
    lines = line_hashes(docs, doc_id, text, min_chars)
    drops = dropped_numbers(lines, Lookup(shared_lines(lines, min_documents)))
    drops = drops.select(F.col("_id").alias("_d"), F.col("_t1").alias("_d1"), F.col("_t2").alias("_d2"), "_drop")
    rows = docs.select(F.struct(*keep).alias("_row"), _text(text).alias("_text"), *_identity(doc_id, text))
    same = F.col("_id").eqNullSafe(F.col("_d")) & (F.col("_t1") == F.col("_d1")) & (F.col("_t2") == F.col("_d2"))
    n_lines = F.char_length("_text") - F.char_length(F.replace("_text", F.lit("\n"))) + 1
    return rows.join(drops, same, "left").select(
        "_row.*",
        n_lines.cast("long").alias("n_lines"),
        F.when(F.col("_drop").isNull(), 0).otherwise(F.size("_drop")).cast("long").alias("n_dropped"),
        F.when(F.col("_drop").isNull(), F.col("_text")).otherwise(without_lines(F.col("_text"), F.col("_drop"))).alias("kept_text"),
    )


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


OP11_SQL = r"""
WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM s),
k AS (SELECT doc_id, pos, line,
             translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.*, keeper IS NOT NULL AND keeper <> doc_id AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
