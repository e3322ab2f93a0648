"""Documents with all the oddities that every operator must take, and brute-force helpers."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ["n_words", "kept", "shard", "slot", "score", "part", "fp", "length", "ids", "_text", "_row", "file", "number", "start", "value"]


def sentence(rnd, n):
    return " ".join("".join(rnd.choice("aeioutrnsl") for _ in range(rnd.randint(1, 9))) for _ in range(n))


def rows(seed=1):
    rnd = random.Random(seed)
    plain = [(i, sentence(rnd, rnd.randint(20, 120)) + ".", "en", "s", 1) for i in range(40)]
    out = plain + [
        (100, None, "en", None, None),
        (101, "", None, "s", 0),
        (102, " \t\n\x0b ", "en", "s", 5),
        (103, "one", "en", "s", 3),
        (104, "two words", "en", "s", 9),
        (105, "tab\tand\x0bfeed\x0cand\rreturn", "en", "s", 9),
        (106, " lead  double   trailing  \n\n end ", "en", "s", 9),
        (107, "Ünï cödé 日本語 \U0001f600 é\u0301 ΑΣ \x00 x", "en", "s", 9),
        (108, "a<|endoftext|>b <|endoftext|> c<|startoftext|>", "en", "s", 9),
        (109, "x" * 30_000, "en", "s", 9),
        (110, sentence(rnd, 20_000), "en", "s", 9),
        (111, "again and again and " * 400, "en", "s", 9),
        (112, "line one is here\n" * 30, "en", "s", 9),
        (113, "a | b | c # d $$ %% &&" * 20, "en", "s", 9),
        (114, "don't can't I'M we'll 1234 5,678.90", "en", "s", 9),
        (None, "a document without an id", "en", "s", 9),
        (None, "a document without an id", "en", "s", 9),
        (-5, plain[3][1], "en", "s", 1),
        (7, plain[7][1], "en", "s", 1),
        (7, plain[7][1], "en", "s", 1),
        (8, "another text under the id of a different one", "en", "s", 1),
    ]
    return out


def documents(spark, seed=1, clashing=False):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows(seed), SCHEMA).repartition(3)
    return df.withColumns({c: F.lit(c) for c in CLASHING}) if clashing else df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return WORD.findall(text or "")
