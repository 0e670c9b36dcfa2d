"""Operator 3 against naive versions of its features, its loss and its quantile cut; the pipeline's stages on empty tables."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from foliant.llm import _arrow, quality

TEXTS = [
    "", " \n\t ", "Word", "One two two. THREE three|four!", "a b a b a b\na b a b a b\n\nlast line?", "| x | 12 | $ |\n| x | 13 | % |", "é日本 ñandú!! 12 34", "x" * 50 + " y", "- - - = = =", "The cat sat. The cat sat. The cat ran!",
    "line\nline\nLINE\nother", "tab\tseparated\x0bvertical\x0cfeed\rreturn", "A" * 30, "  lead and trail  ", "one.two three... four?",
]


def naive_features(text):
    raw = text.encode()
    low = bytes(b + 32 if 65 <= b <= 90 else b for b in raw)
    words, plain = re.findall(rb"[^\x20\x09-\x0D]+", low), re.findall(rb"[^\x20\x09-\x0D]+", raw)
    n, per, chars = len(words), max(1, len(words)), max(1, len(raw))
    if not raw:
        return [0.0] * len(quality.FEATURES)
    letter = lambda b: 65 <= b <= 90 or 97 <= b <= 122 or b >= 128
    letters = max(1, sum(map(letter, raw)))
    again = lambda items, count: (len(items) - len(set(items))) / max(1, count)
    grams = lambda k: [tuple(words[i : i + k]) for i in range(n - k + 1)]
    lines = [x for x in low.split(b"\n") if x]
    sizes = [len(w) for w in words]
    mean = sum(sizes) / per
    spread = math.sqrt(max(0.0, sum(s * s for s in sizes) / per - mean**2))
    symbols = b"#$%&*+/<=>@\\^_`{|}~[]"
    return [
        sum(b in symbols for b in raw) / chars, sum(65 <= b <= 90 for b in raw) / letters, sum(48 <= b <= 57 for b in raw) / chars, raw.count(b"|") / per, raw.count(b"!") / per,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / per, again(grams(2), n), again(grams(3), n), again(lines, max(1, len(lines))), mean, spread, sum(s <= 3 for s in sizes) / per,
        sum(w[-1:] in (b".", b"?") for w in plain) / per, math.log1p(n / max(1, len(lines))), math.log1p(n), sum(s > 20 for s in sizes) / per,
        sum(len(w) == 1 and not (letter(w[0]) or 48 <= w[0] <= 57) for w in plain) / per, max(Counter(words).values(), default=0) / per,
    ]


def test_features_equal_naive_ones(spark):
    docs = [r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    for some in (TEXTS, docs, [docs[0], "", docs[1]]):
        got = np.concatenate([quality.features(b) for b in _arrow.blocks(pa.array(some))])
        want = np.array([naive_features(t) for t in some])
        where = np.argwhere(~np.isclose(got, want, rtol=1e-9, atol=1e-9))
        assert not len(where), [(some[i][:60], quality.FEATURES[j], got[i, j], want[i, j]) for i, j in where[:5]]


def pairs_of(y, pairs):
    """The preference pairs of ``fit``, as (better, worse): every document of the larger class meets ``pairs`` of the other."""
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    more, less = (good, bad) if len(good) >= len(bad) else (bad, good)
    other = less[np.random.default_rng(7).integers(0, len(less), len(more) * pairs)]
    first = np.repeat(more, pairs)
    return (first, other) if more is good else (other, first)


@pytest.mark.parametrize("share", [0.3, 0.7])
def test_weights_minimise_the_pairwise_loss(share):
    rng = np.random.default_rng(2)
    y = (rng.random(200) < share).astype(int)
    x = rng.normal(size=(200, 5)) + y[:, None] * np.array([0.8, -0.5, 0.0, 0.2, 0.0])
    model = quality.fit(x, y, l2=0.01)
    z = np.clip((x - x.mean(0)) / x.std(0), -8, 8)
    better, worse = pairs_of(y, quality.PAIRS_PER_DOCUMENT)

    def loss(w):
        return sum(math.log1p(math.exp(-float((z[i] - z[j]) @ w))) for i, j in zip(better, worse, strict=True)) / len(better) + 0.005 * float(w @ w)

    at = loss(model.weights)
    for k in range(5):
        step = np.eye(5)[k] * 1e-4
        slope = (loss(model.weights + step) - loss(model.weights - step)) / 2e-4
        assert abs(slope) < 1e-5
        assert loss(model.weights + step * 1000) > at < loss(model.weights - step * 1000)


def test_the_cut_is_the_quantile_with_the_fewest_errors():
    rng = np.random.default_rng(3)
    y = (rng.random(120) < 0.5).astype(int)
    x = rng.normal(size=(120, 3)) + 0.7 * y[:, None]
    model = quality.fit(x, y)
    worth = model.worth(x)
    errors = lambda cut: int(((worth >= cut) != (y == 1)).sum())
    fewest = min(errors(c) for c in [*worth, worth.max() + 1])
    assert errors(model.cut) == fewest
    assert abs((worth < model.cut).mean() - model.quantile) < 1e-12
    assert ((model.score(x) >= 0.5) == (worth >= model.cut)).all()


def test_equal_worths_fall_on_one_side():
    x = np.repeat(np.array([[0.0], [1.0], [2.0]]), 20, axis=0)
    y = np.concatenate([np.zeros(20), np.tile([0, 1], 10), np.ones(20)]).astype(int)
    model = quality.fit(x, y)
    groups = [set((model.score(x[20 * k : 20 * k + 20]) >= 0.5).tolist()) for k in range(3)]
    assert groups[0] == {False} and groups[2] == {True} and len(groups[1]) == 1


def test_without_both_labels_all_stay():
    for y in (np.zeros(5, int), np.ones(5, int), np.zeros(0, int)):
        model = quality.fit(np.ones((len(y), len(quality.FEATURES))), y)
        assert (model.score(np.ones((3, len(quality.FEATURES)))) == 0.5).all()


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_an_empty_table(spark, name):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = dict(corpus_pipeline.STAGES)[name](spark, docs.where(F.lit(False)), "/root/testdata/sf0.001")
    assert out.count() == 0 and (name == "packing" or out.columns == docs.columns)


def test_passages_survive_clashing_columns(spark):
    from foliant.llm import substring

    passage = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(1, passage, 5, "a", True), (2, "before " + passage + " after", 6, "b", False), (None, passage, 7, None, None)], "doc_id long, text string, __id long, __spans string, __gone boolean")
    got = {r["doc_id"]: (r["text"], r["__id"], r["__spans"], r["__gone"]) for r in substring.remove_repeats(df).collect()}
    assert got[1] == (passage, 5, "a", True) and got[None] == (passage, 7, None, None)
    assert passage not in got[2][0] and got[2][1:] == (6, "b", False)
