"""Quality by votes of the nearest labelled documents in a latent-semantic space.

Words are hashed into features; how many documents have a feature is counted over the
whole table. A bounded sample of labelled documents gives the latent space (a truncated
singular value decomposition of their weighted features) and the voters: their vectors
and labels are broadcast. Every document is then projected from its whole text and its
cosines with all voters are computed exactly, a block of documents at a time. The most
similar voters vote with the excess of their similarity over the least similar of them,
and votes are weighted so that both labels count the same in all.

The voters are the labelled documents with the smallest hashes of their ids, at most
``MAX_VOTERS`` of each label; that bound also bounds the broadcast (MAX_VOTERS * 2 *
DIMENSIONS four-byte numbers, under 1 MB).

Defined cases: a text without words, or a NULL text, has the zero vector, equal to no
voter, and scores the prior of one half; labels that are NULL, contradictory for one id or
without a document are left out; if one label is missing, every score is the other one's;
without any labels it is one half; repeated rows score alike; an empty table gives no
rows; other columns pass through ``keep_documents`` untouched, whatever their names.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hedonic.llm.common import give_back, table, text_slices, texts_between

FEATURES = 1 << 13
# The last feature counts words equal to the one before; features of form weigh more.
AGAIN, FORM_WEIGHT = FEATURES - 1, 4.0
DIMENSIONS = 32
MAX_VOTERS = 3000
NEIGHBOURS = 9
FOLDS = 5
KEPT_FROM = 0.3
MAX_WORDS = 200_000
# Documents whose cosines are computed at a time in a task.
BLOCK = 128


class _Shapes(dict):
    """Two features of a word: its spelling in lower case, and its shape (letters, digits, marks, upper case)."""

    def __missing__(self, word: str) -> tuple[int, int]:
        if len(self) > MAX_WORDS:
            self.clear()
        low = word.lower()
        ends = "".join("a" if c.isalpha() else "0" if c.isdigit() else c for c in word[-4:])
        shape = f"\0{ends if not word.isalpha() else ''}\0{'U' if word.isupper() and len(word) > 1 else 'T' if word[:1].isupper() else 'l'}"
        half = FEATURES // 2
        numbers = [zlib.crc32(x.encode("utf-8", "surrogatepass")) for x in (low, shape)]
        out = self[word] = (numbers[0] % half, half + numbers[1] % (half - 1))
        return out


_shapes = _Shapes()


def features_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For all texts: row, feature and how often it occurs, ordered by row."""
    rows, columns, counts = [], [], []
    for k, text in enumerate(texts):
        words = text.split()
        found = Counter(words)
        if not found:
            continue
        pairs = np.array([_shapes[w] for w in found], dtype=np.int64)
        times = np.fromiter(found.values(), dtype=np.int64, count=len(found))
        again = sum(map(eq, words, words[1:]))
        feature, place = np.unique(np.r_[pairs.T.reshape(-1), [AGAIN] * (again > 0)].astype(np.int64), return_inverse=True)
        total = np.bincount(place, weights=np.r_[times, times, [again] * (again > 0)])
        rows.append(np.full(len(feature), k))
        columns.append(feature)
        counts.append(total)
    if not rows:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
    return np.concatenate(rows), np.concatenate(columns), np.concatenate(counts)


def document_counts(docs: DataFrame) -> tuple[int, np.ndarray]:
    """The number of documents, and how many of them have each feature; over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(FEATURES, dtype=np.int64), 0
        for batch in batches:
            texts = batch.column("text")
            for lo, hi in text_slices(texts):
                seen += np.bincount(features_of(texts_between(texts, lo, hi))[1], minlength=FEATURES)
                n += hi - lo
        _shapes.clear()
        give_back()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(FEATURES + 1, dtype=np.int32)), pa.array(np.r_[seen, n])], names=["k", "n"])

    out = np.zeros(FEATURES + 1, dtype=np.int64)
    for row in docs.select("text").mapInArrow(count, "k int, n bigint").groupBy("k").agg(F.sum("n").alias("n")).collect():
        out[row["k"]] = row["n"]  # a row per feature, whatever the input
    return int(out[-1]), out[:-1]


@dataclass
class Model:
    """Feature weights, the latent basis, and the voters' vectors (unit length), labels and weights."""

    weights: np.ndarray
    basis: np.ndarray
    voters: np.ndarray
    labels: np.ndarray
    worth: np.ndarray
    neighbours: int = NEIGHBOURS

    def vectors(self, texts: list[str]) -> np.ndarray:
        """Unit vectors of the texts in the latent space; zero for texts without words."""
        out = np.zeros((len(texts), self.basis.shape[1]), dtype=np.float32)
        rows, columns, counts = features_of(texts)
        if len(rows):
            value = (np.log1p(counts) * self.weights[columns]).astype(np.float32)
            first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
            size = np.sqrt(np.add.reduceat(value * value, first))
            for lo in range(0, len(first), 64):
                at = np.r_[first, len(rows)][lo : lo + 65]
                part = slice(at[0], at[-1])
                out[rows[at[:-1]]] = np.add.reduceat(self.basis[columns[part]] * value[part, None], at[:-1] - at[0], axis=0)
            out[rows[first]] /= np.maximum(size, 1e-12)[:, None]
        return unit(out)

    def scores(self, texts: list[str]) -> np.ndarray:
        """For each text the weighted share of votes for label 1."""
        out = np.full(len(texts), 0.5)
        if not len(self.labels):
            return out
        vectors = self.vectors(texts)
        k = min(self.neighbours, len(self.labels))
        for lo in range(0, len(texts), BLOCK):
            block = vectors[lo : lo + BLOCK]
            cosines = (block @ self.voters.T).astype(np.float64)
            near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
            similarity = np.take_along_axis(cosines, near, axis=1)
            vote = (similarity - similarity.min(axis=1, keepdims=True) + 1e-3) * self.worth[near]
            some = np.abs(block).sum(axis=1) > 0
            out[lo : lo + BLOCK][some] = ((vote * self.labels[near]).sum(axis=1) / vote.sum(axis=1))[some]
        return np.clip(out, 0.0, 1.0)


def unit(vectors: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, size, out=np.zeros_like(vectors), where=size > 0)


def held_out(doc_id: Column) -> Column:
    """Whether labels of this document may not be learnt from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == 0


def labelled_features(docs: DataFrame, labels: DataFrame, label: str, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, feature and count of at most ``most`` documents of each label, and their labels.

    They are those with the smallest hashes of their ids among the labels of given documents
    (by ids alone), so that only a bounded set meets the texts. The texts stay in the tasks.
    """
    plain = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
    known = plain.filter(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("doc_id")))
    agreed = known.groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("other")).filter("y = other").drop("other")
    present = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    ordered = agreed.join(present, "doc_id", "left_semi").withColumn("h", F.xxhash64("doc_id"))
    chosen = ordered.filter("y = 0").orderBy("h", "doc_id").limit(most).unionByName(ordered.filter("y = 1").orderBy("h", "doc_id").limit(most))
    few = F.broadcast(chosen.select(F.col("doc_id").alias("_id"), "y"))  # 2 * most rows
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(few, F.col("id") == F.col("_id")).select("id", "y", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            for lo, hi in text_slices(column):
                rows, features, times = features_of(texts_between(column, lo, hi))
                cuts = np.searchsorted(rows, np.arange(1, hi - lo))
                lists = [pa.array(np.split(x, cuts), pa.list_(k)) for x, k in ((features, pa.int64()), (times, pa.float64()))]
                yield pa.RecordBatch.from_arrays([*[batch.column(c).slice(lo, hi - lo) for c in ("id", "y")], *lists], names=["id", "y", "feature", "times"])
        _shapes.clear()
        give_back()

    counted = texts.mapInArrow(count, "id bigint, y int, feature array<bigint>, times array<double>")
    # at most 2 * most rows of at most FEATURES numbers each
    found = counted.groupBy("id", "y").agg(F.min(F.struct("feature", "times")).alias("f")).select("id", "y", "f.feature", "f.times").orderBy("id").toArrow().combine_chunks()
    sizes = np.array([len(x) for x in found.column("feature")], dtype=np.int64)
    flat = [np.concatenate([c.flatten().to_numpy() for c in found.column(name).chunks] or [np.zeros(0)]) for name in ("feature", "times")]
    return np.repeat(np.arange(len(sizes)), sizes), flat[0].astype(np.int64), flat[1], found.column("y").to_numpy().astype(np.float64)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = MAX_VOTERS, dimensions: int = DIMENSIONS) -> Model:
    """The voters and their latent space."""
    n, seen = document_counts(docs)
    rows, columns, counts, y = labelled_features(docs, labels, label, most)
    weights = (np.log((1 + n) / (1 + seen)) + 0.1) * np.where(np.arange(FEATURES) < FEATURES // 2, 1.0, FORM_WEIGHT)
    matrix = np.zeros((len(y), FEATURES), dtype=np.float32)
    matrix[rows, columns] = np.log1p(counts) * weights[columns]
    size = np.linalg.norm(matrix, axis=1, keepdims=True)
    matrix /= np.where(size > 0, size, 1)
    width = min(dimensions, len(y))
    basis = np.zeros((FEATURES, 0), dtype=np.float32)
    if width:
        # randomised subspace iteration for the leading right singular vectors
        guess = np.random.default_rng(5).standard_normal((FEATURES, min(width + 10, FEATURES))).astype(np.float32)
        for _ in range(4):
            guess = np.linalg.qr(matrix.T @ (matrix @ guess))[0]
        basis = (guess @ np.linalg.svd(matrix @ guess, full_matrices=False)[2][:width].T).astype(np.float32)
    share = np.array([max((y == v).mean(), 1e-9) if len(y) else 1.0 for v in (0, 1)])
    return Model(weights, basis, unit(matrix @ basis), y, 0.5 / share[y.astype(int)] if len(y) else y)


def score(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The kept columns, and the score of the column ``text``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema) + ", score double"

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, scores = batch.column("text"), []
            for lo, hi in text_slices(texts):
                scores.append(shared.value.scores(texts_between(texts, lo, hi)))
            values = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(values)], names=[*keep, "score"])
        _shapes.clear()
        give_back()

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(judge, schema)


def keep_documents(docs: DataFrame, model: Model, threshold: float = KEPT_FROM) -> DataFrame:
    """The documents that score at least ``threshold``, with exactly their own columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            good = [shared.value.scores(texts_between(texts, lo, hi)) >= threshold for lo, hi in text_slices(texts)]
            if good:
                yield batch.filter(pa.array(np.concatenate(good)))
        _shapes.clear()
        give_back()

    return docs.mapInArrow(keep, docs.schema)


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")), ["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= KEPT_FROM).cast("int").alias("predicted"))
