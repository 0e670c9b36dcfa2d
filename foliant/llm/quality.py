"""Operator 3: quality by Bradley-Terry pairwise ranking.

Surface statistics of a text (symbols, shouting, table debris, repetition, word
shapes, line shapes) are its features. Preference pairs put a document labelled 1
over one labelled 0; logistic loss on feature differences learns one weight per
feature, so a document's worth is a weighted sum. The cut is a quantile of the
worths of the labelled sample: the one that makes the fewest errors there. The
score is the logistic function of the distance to the cut.

The labelled sample is bounded (``max_labelled`` rows, chosen by a hash of the id)
and is the only thing collected: one row of features per document. All documents
are scored, map-side, from their whole texts.

Defined cases: null and empty texts have all-zero features and get a score like
any other; repeated rows are scored each, and learned once; labels other than 0 and 1 and null ids
are not learned; several labels of an id count as their greatest; without labels of
both kinds every score is 0.5; an empty table gives an empty result; further
columns of the input don't matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm._arrow import LOWER, SPACE, Block, blocks, grams, hash_runs, runs, words
from foliant.llm.shared import held_out, small_batches

MAX_LABELLED = 10_000
PAIRS_PER_DOCUMENT = 12

_UPPER, _LETTER, _DIGIT, _SYMBOL = (np.zeros(256, np.int64) for _ in range(4))
_UPPER[65:91] = 1
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = 1
_DIGIT[48:58] = 1
for _c in b"#$%&*+/<=>@\\^_`{|}~[]":
    _SYMBOL[_c] = 1
_LINE = np.zeros(256, bool)
_LINE[10] = True

FEATURES = ("symbols", "upper", "digits", "pipes", "shouts", "same_word", "same_bigram", "same_trigram", "same_line", "word_length", "word_spread", "short_words", "ends", "line_words", "log_words", "long_words", "lone_symbols", "top_word")


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(values))
    return (total[bounds[1:]] - total[bounds[:-1]]).astype(float)


def features(block: Block) -> np.ndarray:
    """Texts x features; every feature is a rate that doesn't grow with the text, but for the logarithm of its words."""
    d, off = block.data, block.offsets
    if not len(d):
        return np.zeros((len(block), len(FEATURES)))
    w = words(block, SPACE)
    at = w.bounds
    n = np.diff(at).astype(float)
    per_word, chars = np.maximum(n, 1), np.maximum(np.diff(off).astype(float), 1)
    letters = np.maximum(_sums(_LETTER[d], off), 1)
    size = (w.ends - w.starts).astype(float)
    last = d[w.ends - 1]
    text = np.repeat(np.arange(len(block)), np.diff(at))
    same = np.append(False, w.hashes[1:] == w.hashes[:-1])
    same[at[:-1][n > 0]] = False

    def repeated(values: np.ndarray, owner: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Share of a text's values that it had already."""
        order = np.lexsort((values, owner))
        v, o = values[order], owner[order]
        again = (v[1:] == v[:-1]) & (o[1:] == o[:-1])
        return np.bincount(o[1:][again], minlength=len(block)) / np.maximum(count, 1)

    two, ok2 = grams(w, 2)
    three, ok3 = grams(w, 3)
    ls, le = runs(LOWER[d], off, _LINE)
    line_text = np.searchsorted(off, ls, "right") - 1
    lines = np.maximum(np.bincount(line_text, minlength=len(block)), 1)
    order = np.lexsort((w.hashes, text))
    h, o = w.hashes[order], text[order]
    start = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (o[1:] != o[:-1]))) if len(h) else np.zeros(0, np.int64)
    top = np.zeros(len(block))
    np.maximum.at(top, o[start], np.diff(np.append(start, len(h))))
    mean = _sums(size, at) / per_word
    out = [
        _sums(_SYMBOL[d], off) / chars, _sums(_UPPER[d], off) / letters, _sums(_DIGIT[d], off) / chars, _sums(d == 124, off) / per_word, _sums(d == 33, off) / per_word,
        _sums(same, at) / per_word, repeated(two[ok2], text[ok2], n), repeated(three[ok3], text[ok3], n), repeated(hash_runs(LOWER[d], ls, le), line_text, lines),
        mean, np.sqrt(np.maximum(_sums(size**2, at) / per_word - mean**2, 0)), _sums(size <= 3, at) / per_word, _sums((last == 46) | (last == 63), at) / per_word,
        np.log1p(n / lines), np.log1p(n), _sums(size > 20, at) / per_word, _sums((size == 1) & (_LETTER[last] + _DIGIT[last] == 0), at) / per_word, top / per_word,
    ]
    return np.column_stack(out)


@dataclass
class Model:
    """Worth = weights . (features - mean) / spread; ``cut`` and ``scale`` turn it into a score."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    cut: float = 0.0
    scale: float = 1.0
    quantile: float = 0.0

    def worth(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -8, 8)
        return z @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip((self.worth(x) - self.cut) / self.scale, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, pairs: int = PAIRS_PER_DOCUMENT, l2: float = 1e-3, steps: int = 60) -> Model:
    """Bradley-Terry weights by Newton steps on the logistic loss of preference pairs, then the quantile cut."""
    n_features = x.shape[1] if x.ndim == 2 else len(FEATURES)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return Model(np.zeros(n_features), np.ones(n_features), np.zeros(n_features))
    mean, spread = x.mean(0), np.maximum(x.std(0), 1e-6)
    model = Model(mean, spread, np.zeros(n_features))
    z = np.clip((x - mean) / spread, -8, 8)
    rng = np.random.default_rng(7)
    more, less = (good, bad) if len(good) >= len(bad) else (bad, good)
    i, j = np.repeat(more, pairs), less[rng.integers(0, len(less), len(more) * pairs)]
    diff = (z[i] - z[j]) * (1.0 if more is good else -1.0)
    for _ in range(steps):
        p = 1 / (1 + np.exp(np.clip(diff @ model.weights, -30, 30)))  # chance that the pair is ranked wrongly
        gradient = diff.T @ p / len(diff) - l2 * model.weights
        curve = (diff * (p * (1 - p))[:, None]).T @ diff / len(diff) + (l2 + 1e-9) * np.eye(n_features)
        step = np.linalg.solve(curve, gradient)
        model.weights = model.weights + step * min(1.0, 4 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    worth = model.worth(x)
    order = np.argsort(worth)
    wrong = np.append(0, np.cumsum(np.where(y[order] == 1, 1, 0))) + np.append(np.cumsum(np.where(y[order][::-1] == 0, 1, 0))[::-1], 0)
    best = int(np.argmin(wrong))
    low, high = worth[order[max(best - 1, 0)]], worth[order[min(best, len(order) - 1)]]
    model.quantile, model.cut = best / len(order), float((low + high) / 2)
    model.scale = float(max(np.abs(worth - model.cut).mean() / 4, 1e-6))
    return model


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int, max_labelled: int, id_col: str, text_col: str) -> DataFrame:
    """(id, y, text) of at most ``max_labelled`` learnable documents, chosen by a hash of the id; of rows that share an id, the least text."""
    small_batches(docs)
    of = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label).cast("int").alias("y")).where("id is not null and y in (0, 1)")
    of = of.where(~held_out("id", folds, held)).groupBy("id").agg(F.max("y").alias("y"))
    chosen = of.orderBy(F.xxhash64("id"), "id").limit(max_labelled)  # at most max_labelled rows of 12 bytes
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    found = texts.join(F.broadcast(chosen), "id")
    return found.groupBy("id").agg(F.min("y").alias("y"), F.min("text").alias("text"))  # one row per id, however often it is repeated


def scored(docs: DataFrame, score: Callable[[Block], np.ndarray], id_col: str, text_col: str, folds: int, held: int) -> DataFrame:
    """(id, held_out, score, predicted) of every row, by a function from a block of texts to scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(block.first, len(block)), pa.array(score(block).astype(float))], ["id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "id long, score double")
    return rows.select(F.col("id").alias(id_col), held_out("id", folds, held).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "quality", folds: int = 3, held: int = 1, max_labelled: int = MAX_LABELLED) -> Model:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(2)):
                x = features(block)
                yield pa.RecordBatch.from_arrays([batch.column(k).slice(block.first, len(block)) for k in (0, 1)] + [pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))], ["id", "y", "x"])

    sample = labelled_sample(docs, labels, label, folds, held, max_labelled, id_col, text_col)
    rows = sample.select("id", "y", "text").mapInArrow(run, "id long, y int, x array<double>").toPandas()
    rows = rows.sort_values("id", kind="stable")  # the order of pairs doesn't depend on the partitions
    return fit(np.array(rows["x"].tolist(), float).reshape(len(rows), len(FEATURES)), rows["y"].to_numpy())


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "quality", folds: int = 3, held: int = 1, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """Every document with held_out, score (0 to 1) and predicted."""
    model = train(docs, labels, id_col, text_col, label, folds, held, max_labelled)
    return scored(docs, lambda block: model.score(features(block)), id_col, text_col, folds, held)


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **train_options) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text scores 0.5 or more."""
    model = train(docs, labels, id_col, text_col, **train_options)
    kind, place = docs.schema, docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [model.score(features(block)) >= 0.5 for block in blocks(batch.column(place))]
            if good:
                yield batch.filter(pa.array(np.concatenate(good)))

    return docs.mapInArrow(run, kind)
