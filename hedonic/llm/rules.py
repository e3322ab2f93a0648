"""Quality rules as a short-circuit cascade of column expressions.

Each rule's cost and selectivity are estimated on a sample; the rules then run in the
order of rejections per cost, and a document's first rejection spares it the others. The
verdict is the same in any order, only the work differs. Everything is plain columns:
no Python runs on the executors, nothing is shuffled, and a text is never left.

Defined cases: a NULL text counts as empty; a text without words fails the base rules;
repeated rows are judged each alike; an empty table gives no rows; other columns of the
input pass through ``keep_documents`` untouched, whatever their names.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hedonic.llm.common import table, words_of
from hedonic.session import written

# Rows (expected number) on which cost and selectivity are estimated.
SAMPLE_ROWS = 4000
WINDOW = 8
MIN_WORDS = 20
REPEAT_PERCENT = 30
SYMBOLS = r"[#*$%&|<>]+"

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rule:
    """A name and the condition on which a document is rejected, over the measured columns."""

    name: str
    rejects: Column


def default_rules() -> list[Rule]:
    """The rules of the registered query; all are shares, so that the length of a text doesn't matter."""
    words, text = F.col("n_words"), F.col("_text")
    capitals = F.char_length(F.regexp_replace(text, r"[^\p{Lu}]+", ""))
    letters = F.char_length(F.regexp_replace(text, r"[^\p{L}]+", ""))
    marks = F.char_length(text) - F.char_length(F.regexp_replace(text, r"[!?]+", ""))
    lettered = F.size(F.filter("_words", lambda w: w.rlike(r"\p{L}")))
    longest = F.array_max(F.transform("_words", lambda w: F.char_length(w)))
    return [
        Rule("symbols", F.col("n_symbols") * 10 > words),
        Rule("word_length", (F.col("word_chars") < words * 2) | (F.col("word_chars") > words * 12)),
        Rule("duplicate_lines", F.col("n_dup_lines") * 100 > F.size("_lines") * 50),
        Rule("capitals", capitals * 100 > letters * 50),
        Rule("marks", marks * 100 > words * 50),
        Rule("words_without_letters", lettered * 100 < words * 60),
        Rule("longest_word", longest > 400),
    ]


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it.

    Unlike a column of its own, it stays computed once when a filter is moved below it.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def repeated_words(words: Column) -> Column:
    """The number of words in windows that are found twice or more.

    Windows are compared by 64-bit hashes within one text. A text without a repeated
    window, the usual case, stops at the count of distinct hashes. Otherwise the hashes
    are sorted with their places, and the places of equal neighbours cover their words.
    """

    def hashes(w: Column) -> Column:
        window = F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(F.slice(w, i + 1, WINDOW)))
        return F.when(F.size(w) >= WINDOW, window).otherwise(F.array().cast("array<bigint>"))

    def places(s: Column) -> Column:
        def same(x: Column, k: Column) -> Column:
            before, after = F.get(s, k - 1)["h"] == x["h"], F.get(s, k + 1)["h"] == x["h"]
            return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

        return F.sort_array(F.transform(F.filter(s, same), lambda x: x["i"]))

    def covered(at: Column) -> Column:
        reach = F.transform(at, lambda i, k: F.coalesce(F.least(F.get(at, k + 1) - i, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(reach, F.lit(0).cast("long"), lambda a, c: a + c)

    def count(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        found = _let(placed, lambda s: _let(places(s), covered))
        return F.when(F.size(F.array_distinct(h)) < F.size(h), found).otherwise(F.lit(0).cast("long"))

    return _let(words, lambda w: _let(hashes(w), count))


def measured(docs: DataFrame, text: str, keep: Sequence[str]) -> DataFrame:
    """The kept columns with the five measures, base_failed, and the text, words and lines that rules look at."""
    df = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    lines = F.filter(F.split("_text", "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    df = df.withColumns({"_words": words_of(F.col("_text")), "_lines": lines})
    df = df.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.char_length(F.array_join("_words", "")).cast("long"),
            "n_symbols": (F.char_length("_text") - F.char_length(F.regexp_replace("_text", SYMBOLS, ""))).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": repeated_words(F.col("_words")),
        }
    )
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_PERCENT)
    # A filter on these columns, moved below them, would compute them again; a row number,
    # being indeterminate, holds it where it is used (see ``verdict``).
    return df.withColumns({"base_failed": failed, "_here": F.monotonically_increasing_id()})


def cascade_order(docs: DataFrame, text: str, rules: Sequence[Rule]) -> list[Rule]:
    """The rules by rejections per cost on a sample, best first.

    The sample is written once with its measures; a rule's cost is the time of a pass
    that evaluates it, less the time of a pass that evaluates none.
    """
    rows = docs.count()
    fraction = min(1.0, SAMPLE_ROWS / rows) if rows else 1.0
    sample = written(measured(docs.sample(fraction, seed=7), text, []), "rule-sample").filter(~F.col("base_failed"))

    def timed(rejects: Column) -> tuple[float, float]:
        began = time.perf_counter()
        row = sample.agg(F.sum(F.when(rejects, 1).otherwise(0)), F.count("*")).first()
        return time.perf_counter() - began, (row[0] or 0) / max(row[1], 1)

    timed(F.length("_text") < 0)
    nothing = timed(F.length("_text") < 0)[0]
    worth = {}
    for rule in rules:
        seconds, rejected = timed(rule.rejects)
        # a rejection share of zero still orders by cost
        worth[rule.name] = (rejected + 1e-6) / max(seconds - nothing, 1e-3)
    return sorted(rules, key=lambda r: (-worth[r.name], r.name))


def verdict(rules: Sequence[Rule]) -> Column:
    """True if no rule rejects; a rule is evaluated only if those before it did not reject."""
    out = F.when(F.col("base_failed") | (F.col("_here") < 0), False)
    for rule in rules:
        out = out.when(F.coalesce(rule.rejects, F.lit(False)), False)
    return out.otherwise(True)


def judge(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), rules: Sequence[Rule] | None = None) -> DataFrame:
    """The kept columns with the measures, base_failed and kept."""
    ordered = cascade_order(docs, text, default_rules() if rules is None else rules)
    return measured(docs, text, keep).withColumn("kept", verdict(ordered)).select(*keep, *MEASURES, "base_failed", "kept")


def keep_documents(docs: DataFrame, text: str = "text", rules: Sequence[Rule] | None = None) -> DataFrame:
    """The documents that the rules keep, with exactly their own columns."""
    ordered = cascade_order(docs.select(text), text, default_rules() if rules is None else rules)
    whole = docs.select(F.struct("*").alias("_row"), F.col(text).alias("_source"))
    return measured(whole, "_source", ["_row"]).filter(verdict(ordered)).select("_row.*")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
g AS (SELECT doc_id, list_transform(range(1, len(words) - 6), lambda i: array_to_string(words[i:i + 7], ' ')) AS w
      FROM d WHERE len(words) >= 8),
s AS (SELECT doc_id, unnest(w) AS s, unnest(range(1, len(w) + 1)) AS i FROM g),
c AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM s),
p AS (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS later FROM c WHERE c > 1),
r AS (SELECT doc_id, sum(least(8, coalesce(later - i, 8))) AS n FROM p GROUP BY doc_id),
m AS (
  SELECT d.doc_id, t, words, lines, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed
         OR n_symbols * 10 > n_words
         OR word_chars < n_words * 2 OR word_chars > n_words * 12
         OR n_dup_lines * 100 > len(lines) * 50
         OR length(regexp_replace(t, '[^\p{Lu}]+', '', 'g')) * 100 > length(regexp_replace(t, '[^\p{L}]+', '', 'g')) * 50
         OR (length(t) - length(regexp_replace(t, '[!?]+', '', 'g'))) * 100 > n_words * 50
         OR len(list_filter(words, lambda w: regexp_matches(w, '\p{L}'))) * 100 < n_words * 60
         OR list_max(list_transform(words, lambda w: length(w))) > 400) AS kept
FROM b
"""
