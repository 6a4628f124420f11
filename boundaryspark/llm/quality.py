"""Quality classifier: supervised subword embeddings averaged per document, softmax output.

Method: every word gives itself and its character n-grams (3 to 5, with word ends marked) as hashed
features; a word that repeats its predecessor gives one more.  A document is the mean of its features'
learned vectors, a linear layer with softmax follows, and all weights are trained by stochastic gradient
descent in numpy.  Since the layer is linear, the trained vectors shrink to one number per feature for
scoring, and every whole text is scored in one pass without a shuffle.

Training uses a bounded sample of the labelled rows (`max_rows`, in the order of a hash of the id, and
texts up to `max_chars`), so the fit takes the same time at any input size; scoring covers all rows.

Edge cases: null and empty texts have the score of the bias alone; labels that are null are left out, the
highest label of an id holds; a null id is not held out; without labels every score is one half.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boundaryspark.llm.common import append_columns, table
from boundaryspark.llm.registry import query

BUCKETS = 1 << 17
MAX_ROWS = 2000
MAX_CHARS = 200_000
THRESHOLD = 0.3
FOLDS = 5
CACHED_WORDS = 250_000
REPEAT = zlib.crc32(b"\x00repeat") % BUCKETS


def word_features(word: str) -> list[int]:
    marked = f"<{word}>"
    grams = [marked[i:i + n] for n in (3, 4, 5) for i in range(len(marked) - n + 1) if n < len(marked)]
    return [zlib.crc32(g.encode("utf-8", "replace")) % BUCKETS for g in (marked, *grams)]


def text_features(text: str, known: dict[str, list[int]]) -> np.ndarray:
    """Feature of every occurrence."""
    out: list[int] = []
    last = None
    for word in text.split():
        features = known.get(word)
        if features is None:
            features = known[word] = word_features(word)
        out += features
        if word == last:
            out.append(REPEAT)
        last = word
    return np.array(out, np.int64)


@dataclass
class Model:
    """One number per feature and the bias: their mean is the log odds of label 1."""

    weights: np.ndarray
    bias: float

    def scorer(self):
        weights, bias, known = self.weights.astype(np.float64), self.bias, {}
        repeat = float(weights[REPEAT])

        def score(text: str) -> float:
            total, n, last = 0.0, 0, None
            for word in text.split():
                pair = known.get(word)
                if pair is None:
                    features = word_features(word)
                    pair = (float(weights[features].sum()), len(features))
                    if len(known) >= CACHED_WORDS:
                        known.clear()
                    if len(word) <= 64:
                        known[word] = pair
                total += pair[0]
                n += pair[1]
                if word == last:
                    total += repeat
                    n += 1
                last = word
            odds = bias + (total / n if n else 0.0)
            return float(1 / (1 + np.exp(-np.clip(odds, -30, 30))))
        return score


def fit(texts: list[str], labels: list[int], dim: int = 8, epochs: int = 6, rate: float = 1.0, seed: int = 7) -> Model:
    """Stochastic gradient descent over documents in a fixed shuffled order, with a falling rate."""
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 1 / dim, (BUCKETS, dim)).astype(np.float32)
    layer, bias = np.zeros((2, dim), np.float32), np.zeros(2, np.float32)
    known: dict[str, list[int]] = {}
    rows = []
    for text in texts:
        features, counts = np.unique(text_features(text, known), return_counts=True)
        rows.append((features.astype(np.int32), (counts / max(1, counts.sum())).astype(np.float32)))
    known.clear()
    layer[1] = rng.normal(0, 1 / dim, dim)
    steps, total = 0, max(1, epochs * len(rows))
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            features, shares = rows[k]
            step = rate * (1 - steps / total)
            steps += 1
            hidden = shares @ vectors[features] if len(features) else np.zeros(dim, np.float32)
            logits = layer @ hidden + bias
            error = np.exp(logits - logits.max())
            error /= error.sum()
            error[labels[k]] -= 1
            change = layer.T @ error
            layer -= step * np.outer(error, hidden)
            bias -= 0.05 * step * error
            # shares of frequent features are small: scale so that a document moves its features together
            if len(features):
                vectors[features] -= (step * len(features) ** 0.5) * shares[:, None] * change[None, :]
    return Model((vectors @ (layer[1] - layer[0])).astype(np.float32), float(bias[1] - bias[0]))


def held_out(doc_id) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def train(documents: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, max_chars: int = MAX_CHARS) -> Model:
    """Fit on labelled rows that are not held out."""
    wanted = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "quality")
    wanted = wanted.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    wanted = wanted.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).where(F.length("text") <= max_chars)
    rows = rows.join(F.broadcast(wanted), "doc_id").dropDuplicates(["doc_id"]).collect()
    rows.sort(key=lambda r: r["doc_id"])
    return fit([r["text"] for r in rows], [int(r["quality"] > 0) for r in rows])


def score_texts(df: DataFrame, model: Model, text: str = "text", keep_text: bool = True, into: str = "score") -> DataFrame:
    """Add `score` (or the name `into`), the probability of label 1."""
    state = []

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        if not state:
            state.append(model.scorer())
        column = batch.column(batch.schema.get_field_index(text))
        return [pa.array([state[0](x.as_py() or "") for x in column], pa.float64())]
    return append_columns(df, [T.StructField(into, T.DoubleType())], run, () if keep_text else (text,))


def keep_good(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `documents` that score at least `threshold`, with all their columns."""
    scored = score_texts(documents, train(documents, labels), into="_quality")
    return scored.where(F.col("_quality") >= threshold).select(*documents.columns)


@query("op6_quality")
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(documents, table(spark, sf_dir, "labels"))
    scored = score_texts(documents, model, keep_text=False)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
