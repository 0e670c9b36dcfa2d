"""The ten operators against brute force, round trips and held-out labels, with awkward tables."""

import hashlib
import math
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from foliant.llm import _arrow, decontamination, encode, licenses, lm, media, minhash, packing, quality, shared, substring, token_counts, toxicity

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, kept string, h long"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
ROWS = [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "one two"), (6, "One  TWO"), (7, LONG), (8, LONG + " end"), (9, "é b c 日本 <|endoftext|>"), (10, "a b c d e f"), (None, "no id"), (10, "a b c d e f")]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns whose names clash with internal ones."""
    return spark.createDataFrame([(i, t, None, None, len(t or ""), 7, "x", 1) for i, t in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] or "" for r in docs.collect()}


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(t or ""))


def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(encode.default_tokenizer())
    t.encode_special_tokens = True
    return t


def test_op1_histogram(docs, odd, texts):
    t = tokenizer()
    for df, all_texts in ((docs, list(texts.values())), (odd, [x for _, x in ROWS])):
        n = [len(t.encode(x or "", add_special_tokens=False).ids) for x in all_texts]
        h = token_counts.histogram(df)
        for r in h.collect():
            c = r["n_tokens"]
            assert r["n_docs"] == n.count(c)
            assert r["docs_longer"] == sum(x > c for x in n)
            assert r["tokens_longer"] == sum(x for x in n if x > c)
            assert r["kept_at_limit"] == sum(min(x, c) for x in n)
        assert [(r["docs_longer"], r["tokens_kept"]) for r in token_counts.limits(h, [5, 512]).collect()] == [(sum(x > c for x in n), sum(min(x, c) for x in n)) for c in (5, 512)]
        assert token_counts.quantiles(h, [0.5]).first()["n_tokens"] == sorted(n)[math.ceil(len(n) / 2) - 1]
    none = token_counts.histogram(docs.limit(0))
    assert none.count() == 0
    assert token_counts.limits(none, [8]).first()["tokens_kept"] == 0


def naive_path(symbols, i):
    """Kind of path of the hostile symbol at ``i``, by looking at every word around it."""
    t = toxicity
    near = lambda places: any(symbols[j] == t.TARGET for j in places if 0 <= j < len(symbols))
    ahead = near(range(i + 1, i + 1 + (t.AFTER_INSULT if symbols[i] == t.INSULT else t.AFTER_THREAT)))
    directed = ahead or (symbols[i] == t.INSULT and near(range(i - t.BEFORE, i)))
    negated = any(symbols[j] == t.NEGATION for j in range(max(0, i - t.SCOPE), i))
    return 4 * directed + 2 * negated + (t.REPORT in symbols[:i])


def test_op2_bimachine_equals_enumeration():
    rng = np.random.default_rng(5)
    clauses = [rng.choice(6, size=n, p=[0.55, 0.1, 0.1, 0.1, 0.1, 0.05]).tolist() for n in rng.integers(1, 40, 300)]
    flat, bounds = np.array(sum(clauses, [])), np.append(0, np.cumsum([len(c) for c in clauses]))
    got = toxicity.bimachine(flat, bounds)
    want = [naive_path(c, i) if c[i] in (toxicity.INSULT, toxicity.THREAT) else -1 for c in clauses for i in range(len(c))]
    assert got.tolist() == want


def test_op2_clauses():
    g = toxicity.fixed_grammar()
    texts = ["idiot", "The idiot light came on in the car.", "They shoot photos. Take out the trash.", "You came. Idiot light!", "I will kill you", "You idiot", "Idiots like you", "you are not an idiot", "he said you are an idiot", "you idiot, he said", "you " + "x " * 5 + "idiot", "you " + "x " * 4 + "idiot", "", None]
    scores = np.concatenate([g.score(b) for b in _arrow.blocks(pa.array(texts))])
    nothing = scores[-1]
    assert [bool(x > nothing) for x in scores] == [False, False, False, False, True, True, True, True, True, True, False, True, False, False]
    at = dict(zip(texts, scores, strict=True))
    assert at["you are not an idiot"] < at["he said you are an idiot"] < at["You idiot"] == at["you idiot, he said"]
    assert at["I will kill you"] >= 0.5
    x = np.concatenate([g.matches(b) for b in _arrow.blocks(pa.array(texts))])
    assert [x[texts.index(t), :8].nonzero()[0].tolist() for t in ("idiot", "You idiot", "you are not an idiot", "he said you are an idiot")] == [[0], [4], [6], [5]]


def test_op2_learns_classes_contexts_and_paths(spark):
    """Threats by the target behind them, negations by the clean documents, and whether bare insults count."""
    rows = []
    for i in range(120):
        a, b = f"w{i}a", f"w{i}b"
        rows += [(6 * i, f"{a} zorg you {b}. {b} moron here.", 1), (6 * i + 1, f"{a} calm words {b}", 0), (6 * i + 2, f"{b} hardly moron {a}", 0), (6 * i + 3, f"{b} plain {a}", 0)]
    d = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    g = toxicity.learn(d, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int"))
    assert g.words[b"zorg"][0] == toxicity.THREAT and g.words[b"zorg"][1] > 3
    assert g.words[b"hardly"] == (toxicity.NEGATION, 0.0)
    assert g.words[b"moron"] == (toxicity.INSULT, toxicity.FIXED_WEIGHT)
    (block,) = _arrow.blocks(pa.array(["a zorg you b", "b zorg b", "hardly zorg you"]))
    scores = g.score(block)
    assert scores[0] > max(0.5, scores[1], scores[2])


def test_op2_scores(spark, odd, labels):
    d, l = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")  # noqa: E741
    r = toxicity.score_toxicity(d, l).join(l, "doc_id").toPandas()
    held = r[r.held_out]
    assert (held.predicted == held.toxic).mean() > 0.97
    assert ((held.predicted == 1) & (held.toxic == 0)).mean() < 0.01
    o = toxicity.score_toxicity(odd, labels).collect()
    assert len(o) == len(ROWS)
    assert all(0 <= x["score"] <= 1 for x in o)
    assert toxicity.score_toxicity(odd, labels.limit(0)).count() == len(ROWS)
    assert toxicity.score_toxicity(odd.limit(0), labels).count() == 0
    assert all(x["held_out"] == (x["doc_id"] is not None and zlib.crc32(str(x["doc_id"]).encode()) % 5 == 0) for x in o)


def test_op3_scores(spark, docs, odd, labels):
    r = quality.score_quality(docs, labels).join(labels, "doc_id").toPandas()
    assert (r[r.held_out].predicted == r[r.held_out].quality).mean() > 0.95
    o = quality.score_quality(odd, labels).collect()
    assert len(o) == len(ROWS)
    assert all(0 <= x["score"] <= 1 for x in o)
    assert all(x["score"] == 0.5 for x in quality.score_quality(odd, labels.limit(0)).collect())
    assert quality.score_quality(odd.limit(0), labels).count() == 0
    kept = quality.keep_good(odd, labels)
    assert kept.columns == odd.columns
    assert kept.count() == sum(x["predicted"] for x in o)


def test_op3_ranking_orders_pairs():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3))
    y = (x[:, 0] - x[:, 2] > 0).astype(int)
    m = quality.fit(x, y)
    assert ((m.score(x) >= 0.5) == (y == 1)).mean() > 0.97
    assert m.weights[0] > 0 > m.weights[2]


def test_op4_tiling():
    a = list(range(100, 130))
    assert decontamination.tile(a, a, 5) == [(0, 0, 30)]
    turned = a[15:] + [1] + a[:15]
    assert sum(t[2] for t in decontamination.tile(turned, a, 5)) == 30
    assert decontamination.tile([1, 2, 3], a, 5) == []
    both = decontamination.tile(a + a, a, 5)
    assert sum(t[2] for t in both) == 30


def test_op4_overlaps(spark, docs, odd, texts):
    b = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.overlaps(docs, b).collect()}
    flat = lambda t: " ".join(re.findall(r"[0-9a-z\x80-\U0010ffff]+", lower(t)))
    items = {r["item_id"]: flat(r["text"]) for r in b.collect()}
    assert {(i, k) for i, t in texts.items() for k, x in items.items() if f" {x} " in f" {flat(t)} "} <= got
    assert {(r["doc_id"], r["item_id"]) for r in decontamination.overlaps(docs, b, block_bytes=2000).collect()} == got
    item = items[0].split()
    half = len(item) // 2
    mixed = spark.createDataFrame([(1, " ".join(item[half:] + ["x"] + item[:half])), (2, " ".join(item[:4])), (3, None)], "doc_id long, text string")
    assert [r["doc_id"] for r in decontamination.overlaps(mixed, b).collect()] == [1]
    short = spark.createDataFrame([(1, "one two"), (2, None), (3, " "), (1, "one two")], "item_id long, text string")
    assert Counter(r["doc_id"] for r in decontamination.overlaps(odd, short).collect()) == {4: 2, 5: 2, 6: 2}
    kept = decontamination.decontaminate(odd, short)
    assert (kept.columns, kept.count()) == (odd.columns, len(ROWS) - 3)
    assert decontamination.overlaps(odd, short.limit(0)).count() == 0
    assert decontamination.overlaps(odd.limit(0), short).count() == 0


def shingles(t, k=5):
    w = words(t)
    return frozenset([tuple(w[i : i + k]) for i in range(len(w) - k + 1)] or ([tuple(w)] if w else []))


def brute_components(texts, percent):
    sets = {i: shingles(t) for i, t in texts.items()}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize(("percent", "paired"), [(80, minhash.PAIRED), (85, minhash.PAIRED), (85, 2)])
def test_op5_equals_brute_force(spark, docs, texts, percent, paired):
    """With ``paired`` 2 every mixed bucket of more than two members skips the comparison by signature."""
    base = texts[1].split()
    near = {10_000 + i: " ".join(w if (j * 7 + i) % (25 + i) else f"edit{i}" for j, w in enumerate(base)) for i in range(40)}
    df = docs.select("doc_id", "text").unionAll(spark.createDataFrame(list(near.items()), "doc_id long, text string"))
    want = brute_components(texts | near, percent)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(df, percent=percent, paired=paired).collect()}
    assert got == want


def naive_tiles(doc, item, least):
    """Greedy string tiling by comparing every pair of places again for every tile."""
    free_d, free_i, out = [True] * len(doc), [True] * len(item), []
    while True:
        best = (0, 0, 0)
        for i in range(len(doc)):
            for j in range(len(item)):
                n = 0
                while i + n < len(doc) and j + n < len(item) and free_d[i + n] and free_i[j + n] and doc[i + n] == item[j + n]:
                    n += 1
                best = max(best, (n, -i, -j))
        n, i, j = best[0], -best[1], -best[2]
        if n < least:
            return out
        out.append((i, j, n))
        free_d[i : i + n] = [False] * n
        free_i[j : j + n] = [False] * n


def test_op4_tiles_equal_a_naive_search():
    rng = np.random.default_rng(8)
    for _ in range(60):
        item = rng.integers(0, 6, 60).tolist() if rng.random() < 0.5 else rng.permutation(60).tolist()
        cuts = sorted(rng.integers(0, 60, 4).tolist())
        parts = [item[a:b] for a, b in zip([0, *cuts], [*cuts, 60], strict=True)]
        doc = sum((parts[k] + rng.integers(100, 200, 2).tolist() for k in rng.permutation(5)), [])
        got, want = decontamination.tile(doc, item, 5), naive_tiles(doc, item, 5)
        assert sum(t[2] for t in got) == sum(t[2] for t in want)
        assert max([t[2] for t in got], default=0) == max([t[2] for t in want], default=0)
        assert all(doc[i : i + n] == item[j : j + n] for i, j, n in got)
        for side in (0, 1):
            spans = sorted((t[side], t[side] + t[2]) for t in got)
            assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_op4_queries_equal_a_naive_search(spark):
    """Which documents cover which items, for every pair of a small fixture with reordered, edited and partial passages."""
    rng = np.random.default_rng(4)
    items = [[f"i{n}w{k}" for k in range(24)] for n in range(6)]
    docs = []
    for i in range(80):
        body = [f"d{i}x{k}" for k in range(30)]
        for n in rng.choice(6, 2, replace=False):
            part = items[n][int(rng.integers(0, 12)) :][: int(rng.integers(4, 24))]
            half = len(part) // 2
            part = part[half:] + ["z"] + part[:half] if rng.random() < 0.5 else part
            at = int(rng.integers(0, len(body)))
            body = body[:at] + part + body[at:]
        docs.append((i, body))
    want = {(i, n) for i, d in docs for n, it in enumerate(items) if sum(t[2] for t in naive_tiles(d, it, 5)) >= 12}
    df = spark.createDataFrame([(i, " ".join(d)) for i, d in docs], "doc_id long, text string")
    b = spark.createDataFrame([(n, " ".join(it)) for n, it in enumerate(items)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.overlaps(df, b).collect()}
    assert got == want and 0 < len(want) < 160
    for size in (1 << 20, 200):  # one block of the benchmark, and many
        assert {r["doc_id"] for r in decontamination.decontaminate(df, b, block_bytes=size).collect()} == {i for i, _ in docs} - {i for i, _ in want}


def test_op5_odd(odd):
    r = {x["doc_id"]: x for x in minhash.near_duplicates(odd, percent=85).collect()}
    assert sorted(r) == list(range(1, 11))
    assert [r[i]["n_shingles"] for i in (1, 2, 3, 4, 10)] == [0, 0, 0, 1, 2]
    assert [r[i]["component_id"] for i in range(1, 11)] == [1, 2, 3, 4, 4, 4, 7, 7, 9, 10]
    kept = minhash.deduplicate(odd)
    assert (kept.columns, sorted(x["doc_id"] or 0 for x in kept.collect())) == (odd.columns, [0, 1, 2, 3, 4, 7, 9, 10, 10])
    assert minhash.near_duplicates(odd.limit(0)).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 100), (200, 201), (None, 3)]
    got = {r["id"]: r["component"] for r in shared.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 200: 200, 201: 200}


def test_op6_passages(spark, docs, texts):
    got = substring.passages(docs).collect()
    covered: dict = {}
    for r in got:
        assert r["source_id"] < r["doc_id"]
        assert r["end_word"] - r["start_word"] >= 50
        assert r["matched"] >= 0.8 * (r["end_word"] - r["start_word"])
        raw = texts[r["doc_id"]].encode()[r["start_byte"] : r["end_byte"]].decode()
        assert words(raw) == words(texts[r["doc_id"]])[r["start_word"] : r["end_word"]]
        covered.setdefault(r["doc_id"], set()).update(range(r["start_word"], r["end_word"]))
    first: dict = {}
    for i in sorted(texts):  # every exact run of 50 words that an earlier document has, but for runs of one phrase
        w = words(texts[i])
        grams = [tuple(w[p : p + 50]) for p in range(len(w) - 49)]
        for p, g in enumerate(grams):
            if g in first and len(set(g)) > 12:
                assert set(range(p, p + 50)) <= covered.get(i, set())
        for g in grams:
            first.setdefault(g, i)


def test_op6_removal(spark, odd):
    passage = " ".join(f"p{i}q" for i in range(60))
    df = spark.createDataFrame([(1, f"start one {passage} tail"), (2, f"Other {passage} end"), (3, passage), (4, "clean text"), (5, None), (6, "")], "doc_id long, text string").withColumn("n_chars", F.length("text").cast("long"))
    out = {r["doc_id"]: (r["text"], r["n_chars"]) for r in substring.remove_repeats(df).collect()}
    assert out == {1: (f"start one {passage} tail", len(passage) + 15), 2: ("Other end", 9), 4: ("clean text", 10), 5: (None, None), 6: ("", 0)}
    cut = substring.remove_repeats(odd)
    assert cut.columns == odd.columns
    assert substring.passages(odd.limit(0)).count() == 0


def test_op6_parts_in_different_documents(spark):
    """A long passage whose parts are in different earlier documents is found in the first that has all of it."""
    rows, want = [], set()
    for n in range(0, 400, 4):
        one, two = (" ".join(f"{x}{n}w{i}" for i in range(30)) for x in "ab")
        rows += [(n, one), (n + 1, two), (n + 2, f"{n} q {one} {two} r"), (n + 3, f"{one} {two} {n} s t")]
        want.add((n + 3, n + 2, 0, 60, 2, 62))
    got = substring.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["source_id"], r["start_word"], r["end_word"], r["source_start"], r["source_end"]) for r in got} == want


def test_op6_all_copies(spark):
    """Every copy of an earlier passage is found, and a run of one phrase or word longer than the first document's."""
    passage = " ".join(f"p{i}q" for i in range(55))
    far = " ".join(f"f{i}" for i in range(300))
    edited = " ".join("x" if i % 45 == 20 else f"e{i}" for i in range(90))
    rows = [(1, f"a {passage} b"), (2, " ".join(["c"] + [passage] * 13)), (3, f"{passage} {far} {passage}"), (4, "la " * 70), (5, "la " * 500), (6, " ".join(f"e{i}" for i in range(90))), (7, f"{edited} {far[700:]} g {edited}")]
    covered: dict = {}
    for r in substring.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        covered.setdefault(r["doc_id"], set()).update(range(r["start_word"], r["end_word"]))
    assert covered[2] == set(range(1, 716))
    assert covered[3] == {*range(55), *range(355, 410)}
    assert covered[5] == set(range(500))
    n = len(rows[-1][1].split())
    assert covered[7] >= {*range(90), *range(n - 90, n)}


def test_op6_chain_and_alignment():
    pos, src = np.array([0, 10, 20, 30, 12]), np.array([100, 110, 121, 131, 5])
    best = substring.chain(pos, src, 5)[0]
    assert best == [0, 1, 2, 3]
    doc = np.arange(100, dtype=np.uint64)
    other = np.concatenate([doc[:50], doc[51:]])
    a, b, c, d, m = substring._bridged(doc, other, substring.align(doc, other, [(5, 5), (60, 59)], 5))
    assert (a, b, c, d, m) == (0, 100, 0, 99, 99)


def test_op7_packing(docs, odd, texts):
    t = tokenizer()
    for df, rows in ((docs, list(texts.items())), (odd, ROWS)):
        got = packing.pack(df).collect()
        want = Counter()
        for i, x in rows:
            ids = [*t.encode(x or "", add_special_tokens=False).ids, 1]
            want[i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
        assert len({r["sequence_id"] for r in got}) == len(got)
        assert all(r["offset"] == 0 and r["length"] & (r["length"] - 1) == 0 and r["length"] <= 2048 and r["length"] == 1 << r["bucket"] for r in got)
        assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in got)
        back = Counter()
        now: list = []
        for r in got:  # pieces of a document follow one another
            if r["start"] == 0:
                now = []
            assert r["start"] == len(now)
            now += r["ids"]
            if len(now) == r["doc_tokens"]:
                back[r["doc_id"], len(now), zlib.crc32(np.array(now, "<u4").tobytes())] += 1
        assert back == want
    assert packing.pack(odd.limit(0)).count() == 0
    with pytest.raises(ValueError, match="power of two"):
        packing.pack(docs, max_tokens=1000)


def test_op8_scan(docs, odd, texts, spark):
    got = licenses.scan(docs).collect()
    notices = {"Licensed under the Apache License, Version 2.0", "Released under the MIT License", "licensed under the GNU General Public License, version 3", "Licensed under CC BY-NC 4.0", "All rights reserved"}
    assert {r["doc_id"] for r in got} == {i for i, t in texts.items() if any(n in t for n in notices)}
    assert all(texts[r["doc_id"]].encode()[r["start_byte"] : r["end_byte"]].decode() == r["span"] for r in got)
    edited = spark.createDataFrame([(1, "x y This work is licensed under a Creative Commons fine Attribution 4.0 International License z"), (2, "under the license")], "doc_id long, text string")
    r = licenses.scan(edited).collect()
    assert [(x["doc_id"], x["template"], x["matched"]) for x in r] == [(1, "CC-BY-4.0-text", 13)]
    assert licenses.scan(odd).count() == 0
    assert licenses.scan(odd.limit(0)).count() == 0


def test_op8_copies_close_together(spark):
    line, bits = "name: Released under the MIT License", "the MIT License "
    rows = [(1, "\n".join([line] * 100)), (2, bits * 60 + "Released under the MIT License"), (3, "Released under the MIT License " * 40), (4, bits * 60)]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r["start_word"] for r in got if r["doc_id"] == 1) == list(range(1, 600, 6))
    assert [(r["start_word"], r["end_word"]) for r in got if r["doc_id"] == 2] == [(180, 185)]
    assert sorted(r["start_word"] for r in got if r["doc_id"] == 3) == list(range(0, 200, 5))
    assert {r["doc_id"] for r in got} == {1, 2, 3}


def best_match(doc, item):
    """Most words in common of the item and any part of the document, by a full table (longest common subsequence of a part)."""
    best = 0
    for a in range(len(doc)):
        part = doc[a : a + len(item) + 4]
        row = [0] * (len(part) + 1)
        for x in item:
            new = [0]
            for j, y in enumerate(part):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        best = max(best, row[-1])
    return best


def test_op8_equals_unbanded_alignment(spark):
    """Edited copies of a notice: found exactly where an alignment without bands and seeds matches enough of it."""
    rng = np.random.default_rng(6)
    notice = licenses.TEMPLATES["CC-BY-4.0-text"]
    item = re.findall(r"[0-9a-z]+", notice.lower())
    rows = []
    for i in range(60):
        w = list(item)
        for _ in range(int(rng.integers(0, 6))):
            p = int(rng.integers(0, len(w)))
            w[p : p + 1] = [] if rng.random() < 0.3 else [f"e{i}"] if rng.random() < 0.6 else [w[p], "more"]
        rows.append((i, " ".join([f"a{k}" for k in range(5)] + w + [f"b{k}" for k in range(5)])))
    got = {r["doc_id"] for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), {"n": notice}).collect()}
    need = math.ceil(licenses.COVERAGE * len(item))
    want = {i for i, t in rows if best_match(t.split(), item) >= need}
    assert got <= want and len(got) >= 0.9 * len(want) and len(want) < 60


def test_op8_whole_licenses(spark):
    rows = [(1, "Copyright (c) 2020 x\n\n" + licenses.TEMPLATES["MIT-whole"]), (2, licenses.TEMPLATES["BSD-3-Clause-whole"]), (3, licenses.TEMPLATES["BSD-2-Clause-whole"]), (4, licenses.TEMPLATES["ISC-whole"])]
    got = {(r["doc_id"], r["template"]) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, "MIT-whole"), (2, "BSD-3-Clause-whole"), (3, "BSD-2-Clause-whole"), (4, "ISC-whole")}


def test_op9_media(docs, odd, texts):
    for df, rows in ((docs, list(texts.items())), (odd, ROWS)):
        got = media.media_table(df)
        want = Counter()
        for i, x in rows:
            raw = (x or "").encode()
            p = raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))
            want[i, len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:])] += 1
        assert Counter((r["doc_id"], r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) for r in got.collect()) == want
    index = media.store(docs)
    heads = {r["digest"]: (r["width"], r["height"]) for r in media.headers(media.places(index)).collect()}
    assert all(heads[r["digest"]] == (64, r["payload_bytes"] // 64) for r in index.collect())
    assert media.media_table(odd.limit(0)).count() == 0


def test_op9_shards_are_tar_files(docs, tmp_path):
    import tarfile

    index = media.store(docs, folder=f"file://{tmp_path}")
    found = {}
    for path in tmp_path.glob("*.tar"):
        with tarfile.open(path) as tar:
            for m in tar:
                found[m.name] = media.decode_png(tar.extractfile(m).read())
    assert all(hashlib.sha256(found[f"{r['digest']}.png"]).hexdigest() == r["digest"] for r in index.collect())


def brute_log(lattice, word):
    s = b" " + word.encode()
    total = [1.0] + [0.0] * len(s)
    for b in range(1, len(s) + 1):
        total[b] = sum(total[a] * math.exp(lattice.log_p[i]) for a in range(b) if (i := lattice.place.get(s[a:b])) is not None)
    return math.log10(total[-1])


def test_op10_lattice():
    m = lm.lattice(lm.default_vocabulary())
    two = np.array([m.log_p, np.roll(m.log_p, 7)])
    words_ = ["the", "éaux", "a" * 70]
    assert np.allclose(m.scores_by(pa.array(words_), two), [[math.log10(brute_spelled(m, p, w)) for p in two] for w in words_])
    sample = ["the", "thntsh", "éaux", "日本", "a" * 70, "x"]
    for w, got in zip(sample, m.scores(pa.array(sample)), strict=True):
        assert got == pytest.approx(brute_log(m, w), abs=1e-9)
    short, long = m.expectations(pa.array(["banana"]), np.array([2.0])), np.zeros(len(m.pieces))
    m.long_word(b" banana", 2.0, long)
    assert np.allclose(short, long)
    size = np.array([len(p) for p in m.pieces])
    assert (short * size).sum() == pytest.approx(2 * 7)


def test_op10_discount():
    lost, log_free = lm.discount(100, 20, 6, 3)
    assert lost == 0.5 and math.exp(log_free) == pytest.approx(0.1)  # 20 words lose half a count each
    assert lm.discount(0, 0, 0, 0) == (0.5, 0.0)


def test_op10_classes():
    rng = np.random.default_rng(2)
    x = np.zeros((90, lm.BUCKETS), np.float32)
    for i in range(90):  # three languages with words of their own
        np.add.at(x[i], rng.integers(0, 40, 120) + 100 * (i % 3), 1)
    c = lm.fit_classes(x, most=6)
    hashes, bounds = np.repeat(np.arange(lm.BUCKETS)[None], 90, 0)[x > 0].astype(np.uint64), np.append(0, np.cumsum((x > 0).sum(1)))
    of = c.of(hashes, bounds)
    assert all(len(set(of[i::3])) < len(c.log_share) for i in range(3)) and not set(of[0::3]) & set(of[1::3]) and not set(of[1::3]) & set(of[2::3])
    assert len(lm.fit_classes(np.zeros((0, lm.BUCKETS))).log_share) == len(lm.fit_classes(np.zeros((5, lm.BUCKETS))).log_share) == 1


def test_op10_classes_learn_from_every_training_document(spark):
    """Their shares are counts of all documents, and a round's sums are those of the definition over all documents."""
    rng = np.random.default_rng(4)
    most = {"a": 6000, "b": 3900, "c": 1600}  # three languages with words of their own
    texts = [" ".join(f"{tongue}{i}" for i in rng.integers(0, 30, 60)) for tongue, n in most.items() for _ in range(n)] + [None, "", "a1 b1", "a2 " * 900]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string").withColumn("learn", F.lit(True))
    docs = docs.unionAll(docs.where("id < 500").withColumn("learn", F.lit(False)))
    classes = lm.latent_classes(docs, len(texts))
    (block,) = _arrow.blocks(pa.array([" ".join(f"{tongue}{i}" for i in range(30)) for tongue in most]))
    w = _arrow.words(block)
    fit = np.array([classes.log_p[:, (w.of(i) % np.uint64(lm.BUCKETS)).astype(int)].sum(1) for i in range(3)])
    shares = np.bincount(fit.argmax(0), np.exp(classes.log_share), 3)
    assert np.abs(shares * len(texts) - list(most.values())).max() < 10
    table = lm.bucket_counts(docs)
    log_p, log_share = np.log(rng.dirichlet(np.ones(lm.BUCKETS), (2, 3))), np.log(rng.dirichlet(np.ones(3), 2))
    words_, docs_, likelihood = np.zeros((2, 3, lm.BUCKETS)), np.zeros((2, 3)), np.zeros(2)
    for t in texts:
        (block,) = _arrow.blocks(pa.array([t]))
        x = np.bincount((_arrow.words(block).hashes % np.uint64(lm.BUCKETS)).astype(int), minlength=lm.BUCKETS)
        x = x * min(1, 200 / max(x.sum(), 1))
        z = log_p @ x + log_share
        every = np.logaddexp.reduce(z, 1)
        p = np.exp(z - every[:, None])
        likelihood += every
        docs_ += p
        words_ += p[..., None] * x
    assert np.allclose(lm.class_sums(table, log_p, log_share), [*words_.ravel(), *docs_.ravel(), *likelihood])


def test_op7_new_segments_in_rows(texts):
    e = encode.Encoder(encode.default_tokenizer())
    plain = e._encode
    given = []
    e._encode = lambda some: given.extend(some) or plain(some)
    odd = [" \u00a0" * 5 + " x  y\u3000 z \u3000 \u3000", "a\u00a0 b \u0085 c", "\t tab\n\nline  two ", " 's 're'll 12ab ,,x ", "<|endoftext|> \x00 \x1c\x1d é 日本 😀", "", " ", "end"]
    lines = [t for t in texts.values()][:300] + odd
    for some in (lines, odd, lines[::-1]):
        for block in _arrow.blocks(pa.array(some)):
            n, known = len(given), len(e.first)
            ids, bounds = e.ids(block)
            for i in range(len(block)):
                assert ids[bounds[i] : bounds[i + 1]].tolist() == e.tokenizer.encode(block.text(i), add_special_tokens=False).ids
            assert len(given) - n < max(200, (len(e.first) - known) / 4)
    assert len(e.first) > 2000 and np.all(np.diff(e.keys.astype(object)) > 0)


def test_op10_words_together(texts):
    m = lm.lattice(lm.default_vocabulary())
    odd = ["", "a", "é", "日本語", "ab c", "x" * 64, "x" * 65, "y" * 300, "😀" * 9, "😀" * 16, "\0" * 64]
    some = pa.array(odd + sorted({w for t in texts.values() for w in t.lower().split()})[:6000])
    rng = np.random.default_rng(0)
    log_p, count = m.log_p + rng.normal(0, 1, (3, len(m.log_p))), rng.integers(0, 2, (len(some), 3)).astype(float)
    took = []
    for f, plain, of in ((m.scores_by, m.scores_apart, log_p), (m.expectations, m.expectations_apart, count)):
        begin = time.process_time()
        quick = f(some, of)
        middle = time.process_time()
        assert np.allclose(quick, plain(some, of), rtol=1e-9, atol=1e-9)
        took.append((middle - begin, time.process_time() - middle))
    assert sum(x for x, _ in took) < 0.7 * sum(x for _, x in took)
    assert np.allclose(m.expectations(some, count[:, 0]), m.expectations(some, count)[0]) and m.scores_by(some[:0], log_p).shape == (0, 3)
    keys = np.unique(rng.integers(0, 1 << 63, 1000).astype(np.uint64) * np.uint64(2) + np.uint64(1))
    keys[-1] = _arrow.MAX64
    values = np.concatenate([keys[::3], keys + np.uint64(5), [np.uint64(0), _arrow.MAX64]])
    for k in (keys, keys[:0], keys[:-1]):
        assert all(np.array_equal(x, y) for x, y in zip(lm.Places(k, 8).find(values), _arrow.HashIndex(k).find(values), strict=True))


def test_op10_word_counts_leave_in_small_batches(spark):
    """The merged words of a task reach the engine in batches of a bounded size, none lost."""

    class Taken:
        def mapInArrow(self, run, schema):
            self.run = run
            return self

        select = groupBy = agg = lambda self, *_: self

    taken, n = Taken(), 3 * lm.WORD_ROWS + 7
    lm.word_counts(taken, lm.Classes(np.zeros((1, lm.BUCKETS)), np.zeros(1)))
    texts = [" ".join(f"w{i}" for i in range(n)), None, "w0 w1", "w0"]
    given = list(taken.run(iter([pa.RecordBatch.from_arrays([pa.array([True, True, True, False]), pa.array(texts)], ["learn", "text"])])))
    assert max(b.num_rows for b in given) <= lm.WORD_ROWS
    got = [(r["word"], r["c0"]) for b in given for r in b.to_pylist()]
    assert len(got) == n + 1 and dict(got) == {f"w{i}": 1 + (i < 2) for i in range(n)} | {"": 3}


def brute_spelled(lattice, log_p, word):
    s = b" " + word.encode()
    total = [1.0] + [0.0] * len(s)
    for b in range(1, len(s) + 1):
        total[b] = sum(total[a] * math.exp(log_p[i]) for a in range(b) if (i := lattice.place.get(s[a:b])) is not None)
    return total[-1]


def test_op10_equals_brute_force(spark, texts):
    """Classes, counts, discounts and the marginal over classes and segmentations, all by their definitions."""
    rows = [(i, t) for i, t in texts.items()] + [(10_000, "the thntsh des neuwort"), (10_001, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    source = df.select(F.col("doc_id").alias("id"), "text", shared.learns("doc_id", 10, 0).alias("learn"))
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 10 == 0}
    classes = lm.latent_classes(source, len(rows) - len(held))
    k = len(classes.log_share)
    assert k > 1
    names = [f"c{i}" for i in range(k)]
    vocab = shared.cut(lm.word_counts(source, classes))
    model = lm.lattice(lm.default_vocabulary())
    (block,) = _arrow.blocks(pa.array([t for _, t in rows]), 1 << 60)
    w = _arrow.words(block)
    of = classes.of(w.hashes, w.bounds)
    counts = [Counter() for _ in range(k)]
    for (i, t), c in zip(rows, of, strict=True):
        if i not in held:
            counts[c].update([*words(t), ""])
    whole = sum(counts, Counter())
    got = {r["word"]: [r[c] for c in names] for r in vocab.collect()}
    assert {x: v for x, v in got.items() if sum(v)} == {x: [c[x] for c in counts] for x in whole}
    ends = [c[""] for c in counts]
    log_p, log_end = lm.fitted(vocab, model, names, ends, lm.ROUNDS)

    def lost(c):
        once, twice = (sum(v == n for v in c.values()) for n in (1, 2))
        d = once / (once + 2 * twice) if once and twice else 0.5
        return d, d * len(c) / c.total()

    discounts, (d, free) = [lost(c) for c in counts], lost(whole)

    def p(word, j):
        spelled = math.exp(log_end[j]) if word == "" else brute_spelled(model, log_p[j], word)
        every = max(whole[word] - d, 0) / whole.total() + free * spelled
        return max(counts[j][word] - discounts[j][0], 0) / counts[j].total() + discounts[j][1] * every

    scores = {r["doc_id"]: r["score"] for r in lm.score_documents(df).collect()}
    for i, t in [r for r in rows if len(words(r[1])) < 60][:40] + rows[-2:]:
        logs = [math.log10((ends[j] + 1) / (sum(ends) + k)) + sum(math.log10(p(x, j)) for x in [*words(t), ""]) for j in range(k)]
        top = max(logs)
        assert scores[i] == pytest.approx(top + math.log10(sum(10 ** (x - top) for x in logs)), abs=1e-6)


def test_op10_beats_the_base(spark):
    r = lm.score_documents(spark.read.parquet("/root/testdata/sf0.1/documents.parquet").repartition(4)).where("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert r[0] / r[2] > r[1] / r[2] + 0.1  # log10 per token


def test_op10_scores(docs, odd, texts):
    for df, rows in ((docs, list(texts.items())), (odd, ROWS)):
        held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
        count = Counter()
        for i, x in rows:
            if not held(i):
                count.update([*words(x), None])
        n, v = sum(count.values()), len(count)
        a = {(r["doc_id"], r["n_tokens"]): r for r in lm.score_documents(df, hot=50).collect()}
        b = {(r["doc_id"], r["n_tokens"]): r for r in lm.score_documents(df).collect()}
        for i, x in rows:
            tokens = [*words(x), None]
            r = a[i, len(tokens)]
            assert (r["held_out"], r["n_known"], r["train_tokens"]) == (held(i), sum(count[w] > 0 for w in tokens), n)
            assert r["base_score"] == pytest.approx(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens))
            assert r["score"] == pytest.approx(b[i, len(tokens)]["score"])  # hot words and joined ones score alike
            assert r["score"] < 0
    assert lm.score_documents(odd.limit(0)).count() == 0


def test_encoder_equals_the_library():
    t = tokenizer()
    odd_texts = [x or "" for _, x in ROWS] + ["  a b\n\n c  \n", "it's 'tis don't\n\tfoo  bar   ", "\u0085x\x1cy"]
    for block in _arrow.blocks(pa.array(odd_texts), 64):
        flat, bounds = encode.encoder(encode.default_tokenizer()).ids(block)
        for i in range(len(block)):
            assert list(flat[bounds[i] : bounds[i + 1]]) == t.encode(odd_texts[block.first + i], add_special_tokens=False).ids


def test_winnowing_guarantee():
    rng = np.random.default_rng(3)
    v = rng.integers(0, 1 << 62, 500).astype(np.uint64)
    bounds = np.array([0, 3, 3, 200, 500])
    kept = set(_arrow.winnow(v, np.ones(500, bool), bounds, 16).tolist())
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        assert all(kept & set(range(p, p + 16)) for p in range(a, b - 15))
        alone = _arrow.winnow(v[a:b], np.ones(b - a, bool), np.array([0, b - a]), 16) + a
        assert set(alone.tolist()) == {p for p in kept if a <= p < b}


def test_pipeline(spark, docs, texts):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "substrings", "decontamination", "packing"]
    before = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = shared.cut(stage(spark, before, SF))
        assert after.columns == docs.columns
        assert {r["doc_id"] for r in after.select("doc_id").collect()} <= {r["doc_id"] for r in before.select("doc_id").collect()}
        before = after
    good = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 0").collect()}
    left = {r["doc_id"] for r in before.collect()}
    assert not left & good
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, SF).select("doc_id").collect()} == left
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), SF).count() == 0
