"""Quality by compression: how much better a good dictionary fits than a bad one.

Two zstandard dictionaries are built from good and from bad labelled texts.
Every piece of a text is compressed with each; the difference of the two sizes
over their sum says which kind of text it resembles. A logistic curve, fitted
on labelled texts that built no dictionary, turns this difference into a
probability, together with the size a byte without a dictionary, which is small
for texts that repeat themselves, and the shortness. All three are bounded.

A few bytes say little, and a compressor's own bytes outweigh them. So the
shorter a text, the closer its score to the share of good labelled documents:
what speaks against it counts in proportion to its length, what speaks for it
only beyond the length of a line.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import hashed_sample

# The bounded sample of labelled rows a model is fitted on: so many documents
# of each label, by the hash of their id, none with more bytes than this.
TRAINING_DOCS = 2000
TRAINING_BYTES = 32_768
DICTIONARY_BYTES = 112_640
PIECE = 512
LEVEL = 3
THRESHOLD = 0.7
# Bytes at which a text's own evidence counts half; below them nothing lifts its
# score above the share of good documents, and from the second length on all does.
LINE = 64
SURE = 256
HELD_OUT = 2


def held_out(doc_id: Column) -> Column:
    """Documents whose labels nothing is learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


@dataclass
class Model:
    """Two dictionaries and a curve; without both labels only ``prior`` counts."""

    good: bytes
    bad: bytes
    middle: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    prior: float
    trained: bool = True

    def score(self, texts: list[str | None]) -> np.ndarray:
        encoded = [(t or "").encode("utf-8", "replace") for t in texts]
        empty = np.array([not t for t in encoded], dtype=bool)
        if not self.trained:
            return np.where(empty, 0.0, self.prior)
        x = (self._sizes(encoded) - self.middle) / self.spread
        raised = np.clip(np.column_stack([x, np.ones(len(x))]) @ self.weights, -40, 40)
        lengths = np.array([len(t) for t in encoded])
        return np.where(empty, 0.0, settled(1 / (1 + np.exp(-raised)), lengths, self.prior))

    def _sizes(self, texts: list[bytes]) -> np.ndarray:
        if not hasattr(self, "_compressors"):
            self._compressors = [_compressor(self.good), _compressor(self.bad)]
        return features(texts, *self._compressors)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_compressors"}


def _dictionary(texts: list[bytes]) -> bytes:
    pieces = [t[at : at + PIECE] for t in texts for at in range(0, len(t), PIECE)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, pieces, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too few pieces to choose from: all of them
        return b"".join(pieces)[-DICTIONARY_BYTES:]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    dictionary = zstandard.ZstdCompressionDict(content)
    dictionary.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=dictionary, write_content_size=False, write_dict_id=False
    )


def settled(found: np.ndarray, lengths: np.ndarray, prior: float) -> np.ndarray:
    """Scores drawn to the prior as far as the texts are short."""
    down = lengths / (lengths + LINE)
    up = np.clip((lengths - LINE) / (SURE - LINE), 0, 1)
    return prior + (found - prior) * np.where(found < prior, down, up)


def features(texts: list[bytes], good, bad) -> np.ndarray:
    """Normalised difference of the two sizes, plain size a byte, and the shortness."""
    plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
    out = np.zeros((len(texts), 3))
    for k, text in enumerate(texts):
        if not text:
            continue
        pieces = [text[at : at + PIECE] for at in range(0, len(text), PIECE)]
        a, b, c = (sum(len(by.compress(p)) for p in pieces) for by in (good, bad, plain))
        out[k] = (a - b) / (a + b), min(1.0, c / len(text)), max(len(text), LINE) ** -0.5
    return out


def fit(good: list[bytes], bad: list[bytes], good_share: float = 0.5) -> Model:
    """Half of each list builds the dictionaries, the other half the curve.

    ``good_share`` is the share of good ones among all labelled documents.
    """
    texts = [t for t in good if t], [t for t in bad if t]
    empty = np.empty(0)
    if min(map(len, texts)) < 2:
        return Model(b"", b"", empty, empty, empty, good_share, trained=False)
    dictionaries = [_dictionary(t[::2]) for t in texts]
    rest = [t[1::2] for t in texts]
    x = features(rest[0] + rest[1], *map(_compressor, dictionaries))
    y = np.repeat([1.0, 0.0], [len(rest[0]), len(rest[1])])
    middle, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    share = np.where(y == 1, good_share / len(rest[0]), (1 - good_share) / len(rest[1])) * len(y)
    return Model(*dictionaries, middle, spread, _logistic((x - middle) / spread, y, share), good_share)


def _logistic(x: np.ndarray, y: np.ndarray, share: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Weights by Newton's method; ``share`` says how much each row counts."""
    x = np.column_stack([x, np.ones(len(x))])
    weights = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -40, 40)))
        slope = x.T @ (share * (p - y)) + ridge * weights
        bend = (x * (share * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(weights))
        weights = weights - np.linalg.solve(bend, slope)
    return weights


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    docs_per_label: int = TRAINING_DOCS,
) -> Model:
    """A model from a bounded sample of the labelled documents that are not held out.

    Rows without id, text or label teach nothing, nor do documents whose labels
    disagree. The sample is at most ``docs_per_label`` documents of each label,
    each of at most ``TRAINING_BYTES`` bytes, chosen by a hash of the id.
    """
    doc_id, label = F.col("doc_id"), F.col("label")
    known = (
        labels.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("label"))
        .where(doc_id.isNotNull() & label.isin(0, 1) & ~held_out(doc_id))
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where(label == F.col("other"))
    )
    counts = {row["label"]: row["count"] for row in known.groupBy("label").count().collect()}
    good_share = counts.get(1, 0) / sum(counts.values()) if counts else 0.5
    chosen = hashed_sample(known.select("doc_id", "label"), "label", counts, docs_per_label)
    text = F.col(f"`{text_col}`")
    sample = (
        docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"))
        .join(F.broadcast(chosen.select("doc_id", "label")), "doc_id")
        .where(F.octet_length("text").between(1, TRAINING_BYTES))
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.min("text").alias("text"))
        .orderBy("doc_id")
        .collect()
    )
    by_label = {0: [], 1: []}
    for row in sample:
        by_label[row["label"]].append(row["text"].encode("utf-8", "replace"))
    return fit(by_label[1], by_label[0], good_share)


def score(text: Column, model: Model) -> Column:
    """Probability that a whole text is good; 0 for empty and NULL texts."""

    @F.pandas_udf("double")
    def of_texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(model.score(batch.tolist()))

    return of_texts(text)


def classify(
    docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row.

    NULL and empty texts have the score 0; a NULL id is not held out; repeated
    rows are rows like others; an empty table gives no rows. Without labels of
    both kinds all texts have the score of the labels' mean, 0.5 without any.
    A text of less than a line never scores above that mean; a very long one is
    compressed piece by piece. Other columns of the input are not looked at,
    whatever their names.
    """
    doc_id = F.col(f"`{id_col}`")
    return docs.select(
        doc_id.cast("long").alias("doc_id"),
        held_out(doc_id).alias("held_out"),
        score(F.col(f"`{text_col}`"), model).alias("score"),
    ).withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
