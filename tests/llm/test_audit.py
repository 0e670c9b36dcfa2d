"""Operators 11 to 13 against their SQL and brute force, and blocks and common seeds of operator 4, with awkward tables."""

import hashlib
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from foliant.llm import decontamination, divergence, fingerprint, manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, m long, grp string, part int, term string, key string, start long"
LONG = "\n".join(" ".join(f"w{(i * j) % 977}x{i % 31}" for i in range(400)) for j in range(1, 60))
TEXTS = [None, "", " \n\t ", "One two", "two one\none", LONG, LONG + "\nend", "é日 b-c D", "a b c d e f", "\n\n", "a b c d e f"]


def odd_rows():
    """Nulls in every column, ties, repeated rows, one language without kept terms and one source with most rows."""
    rows = [(i % 9 if i % 7 else None, TEXTS[i % len(TEXTS)], ("en", "es", None, "", "ünï")[i * i % 5], ("a", "b", None)[i % 3] if i % 4 else "hot", i if i % 5 else None) for i in range(160)]
    rows += [(900, "only here", "xx", "s1", 3), (901, None, "xx", "s2", None), (902, "x", "yy", "s1", 2**63 - 1)] + [(3, "same row", "en", "a", 8)] * 40
    return rows


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, 5, "g", 1, "t", "k", 2) for r in odd_rows()], SCHEMA).repartition(5)


def in_duckdb(sql, df):
    con = duckdb.connect()
    con.register("documents", df.select("doc_id", "text", "lang", "source", "n_chars").toArrow())
    return Counter(tuple(r.values()) for r in con.sql(sql).to_arrow_table().to_pylist())


def rounded(rows, *columns):
    return Counter({tuple(round(v, 9) if i in columns else v for i, v in enumerate(r)): n for r, n in rows.items()})


def collected(df):
    return Counter(map(tuple, df.collect()))


def test_op11_equals_sql(spark, odd):
    assert collected(divergence.divergence(odd)) == in_duckdb(divergence.SQL, odd)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert collected(divergence.divergence(docs)) == in_duckdb(divergence.SQL, docs)
    assert divergence.divergence(odd.limit(0)).count() == 0


@pytest.mark.parametrize("cells", [1, 3, 50])
def test_op11_tiles_and_bands_change_nothing(odd, cells):
    assert collected(divergence.divergence(odd, cells=cells, min_docs=3)) == collected(divergence.divergence(odd, min_docs=3))


def test_op11_arithmetic_is_exact_beyond_64_bits():
    count = np.array([0, 7, 10**10, 3 * 10**13], np.int64)
    total = 10**14 + 19
    assert divergence.share(count, np.int64(total)).tolist() == [1 + 10**9 * (int(c) + 2) // total for c in count]
    assert divergence.top_terms(np.array([5, 9, 9, 1]), np.array([0, 3, 2, 1]), 2) == [(-9, 2, 2), (-9, 3, 1)]
    assert divergence.top_terms(np.array([], np.int64), np.array([], np.int64), 2) == []


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def naive_manifest(rows):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified), a list of levels at a time."""
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, more=0: sha("".join(enc(v) for v in (r[0], r[3], r[2], None if r[4] is None else r[4] + more, r[1])))
    order = sorted(rows, key=lambda r: (r[2] is not None, (r[2] or "").encode(), r[0] is not None, r[0] or 0, leaf(r)))
    names = list(dict.fromkeys(r[2] for r in order))
    low = {n: levels_of([leaf(r) for r in order if r[2] == n]) for n in names}
    high, out = levels_of([low[n][-1][0] for n in names]), []
    for g, n in enumerate(names):
        for i, r in enumerate(r for r in order if r[2] == n):
            h, proof = leaf(r, int(r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0)), ""
            for tree, at in ((low[n], i), (high, g)):
                for level in tree[:-1]:
                    other = level[at ^ 1] if at ^ 1 < len(level) else ""
                    proof, h, at = proof + other, sha(other + h if at & 1 else h + other), at >> 1
            out.append((r[0], low[n][0][i], low[n][-1][0], high[-1][0], sha(proof), h, h == high[-1][0]))
    return Counter(out)


@pytest.mark.parametrize("levels", [1, 2, 8])
def test_op12_equals_naive(odd, levels, monkeypatch):
    monkeypatch.setattr(manifest, "LEVELS", levels)
    got = collected(manifest.manifest(odd))
    assert got == naive_manifest(odd_rows())
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)


def test_op12_equals_sql(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for df in (docs, odd, docs.limit(1)):
        assert collected(manifest.manifest(df)) == in_duckdb(manifest.SQL, df)
    assert manifest.manifest(odd.limit(0)).count() == 0


def test_op13_equals_sql(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for df in (docs, odd, docs.limit(1)):
        assert rounded(collected(fingerprint.edits(df)), 5, 6) == rounded(in_duckdb(fingerprint.SQL, df), 5, 6)
    assert fingerprint.edits(odd.limit(0)).count() == 0


def naive_vector(text):
    out = np.zeros(fingerprint.SURE + fingerprint.LIKE, object)
    for p in text.split("\n") if text else []:
        h = sha(p)
        out[: fingerprint.SURE] += [int(h[8 * k : 8 * k + 8], 16) for k in range(fingerprint.SURE)]
        for clause in re.split("[.,;:!?]", p):
            words = re.findall(r"[^\x20\x09-\x0D]+", clause)
            for i in range(0, len(words), 3):
                m = hashlib.md5(" ".join(words[i : i + 3]).encode()).hexdigest()
                y = [int(m[:16], 16), int(m[16:], 16)]
                out[fingerprint.SURE :] += [2 * (y[j] >> b & 1) - 1 for j in range(2) for b in range(64)]
    return [(int(x) + 2**31) % 2**32 - 2**31 for x in out]


def test_op13_vectors_are_homomorphic(spark, odd):
    assert Counter((r["doc_id"], tuple(r["vector"])) for r in fingerprint.fingerprints(odd).collect()) == Counter((r[0], tuple(naive_vector(r[1] or ""))) for r in odd_rows())
    whole, part, rest, turned = "a b c d\nx y\n\nx y\nlast one here", "x y\n", "a b c d\nx y\nlast one here", "last one here\nx y\na b c d\n\nx y"
    df = spark.createDataFrame(list(enumerate((whole, part, rest, turned, "", None))), "doc_id int, text string")
    v = {r["doc_id"]: r for r in fingerprint.fingerprints(df).collect()}
    for i, text in enumerate((whole, part, rest, turned, "", "")):
        assert v[i]["vector"] == naive_vector(text)
    assert v[0]["fingerprint"] == v[3]["fingerprint"] != v[2]["fingerprint"]
    both = spark.createDataFrame([(v[0]["vector"], v[1]["vector"], v[2]["vector"])], "w array<int>, p array<int>, r array<int>")
    got = both.select(fingerprint.insert(F.col("r"), F.col("p")), fingerprint.delete(F.col("w"), F.col("p")), fingerprint.delete(F.col("w"), F.col("w"))).first()
    assert list(got[0]) == v[0]["vector"] and list(got[1]) == v[2]["vector"] and set(got[2]) == {0}


def test_op13_lots_of_pieces(spark, odd, monkeypatch):
    monkeypatch.setattr(fingerprint, "PACKED", 100)
    assert Counter((r["doc_id"], tuple(r["vector"])) for r in fingerprint.fingerprints(odd).collect()) == Counter((r[0], tuple(naive_vector(r[1] or ""))) for r in odd_rows())


def test_op13_runs_no_python(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = fingerprint.edits(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_op13_parts_hand_over_their_first_key(spark):
    """The ring of next documents closes over any number of parts."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    rows = spark.createDataFrame([(f"k{i}", (i * 37) % 101 if i % 10 else None, f"s{i:03d}", 1) for i in range(101)], "key string, id long, sha string, m long")
    want = [r["key"] for r in sorted(rows.collect(), key=lambda r: (r["id"] is None, -(r["id"] or 0), r["sha"]))]
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = {r["key"]: r["next"] for r in fingerprint.successors(rows).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == dict(zip(want, want[1:] + want[:1], strict=True))


def test_op4_blocks_are_bounded_whatever_repeats(spark):
    """Equal items are one text; texts are dealt by size, even where their hashes begin alike."""
    rows = [(i, "one and the same item of ten words in all here") for i in range(3000)] + [(5000 + i, f"item number {i} " + "w" * (i % 300)) for i in range(400)] + [(9000, "z" * 30_000), (9001, None)]
    items = decontamination._items(spark.createDataFrame(rows, "item_id long, text string"), "item_id", "text")
    dealt = list(decontamination._dealt(items, 20_000))
    texts = [t for _, part in dealt for t in part]
    assert sorted(texts) == sorted({t for _, t in rows if t}) and len(texts) == len(set(texts))
    assert all(sum(map(len, part)) <= 20_000 or len(part) == 1 for _, part in dealt)
    alike = spark.createDataFrame([(f"abc{i:061x}", "t" * 100) for i in range(64)], "item string, text string")
    ranges = list(decontamination._ranges(alike, 1000, 3))
    assert len(ranges) >= 7 and all(len(low) > 3 for low, _ in ranges)


@pytest.mark.parametrize("many", [64, 2, 0])
def test_op4_seeds_of_many_items_change_nothing(spark, many, monkeypatch):
    monkeypatch.setattr(decontamination, "MANY", many)
    ask = "please answer the following question in one short sentence"
    rows = [(i, f"{ask} what is fact {i} of chapter {i * 7} about river {i * 13} then") for i in range(90)] + [(200 + i, ask) for i in range(5)] + [(300, f"{ask} {ask}"), (301, "")]
    docs = [(1, f"Some text. {ask} what is fact 7 of chapter 49 about river 91 then more"), (2, f"only {ask} here"), (3, "what is fact 8 of chapter 56 about river 104 then"), (4, "nothing"), (5, None), (6, f"{ask} and {ask}")]
    b = spark.createDataFrame(rows, "item_id long, text string")
    d = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["covered"], round(r["coverage"], 6)) for r in decontamination.overlaps(d, b).collect()}
    want = {}
    for i, text in docs:
        for j, item in rows:
            x, y = ((t or "").lower().replace(".", "").split() for t in (text, item))
            tiles = decontamination.tile([zlib.crc32(w.encode()) for w in x], [zlib.crc32(w.encode()) for w in y], min(5, len(y))) if y else []
            covered = sum(t[2] for t in tiles)
            if y and covered >= max(1, -(-len(y) // 2)):
                want[i, j] = (covered, round(covered / len(y), 6))
    assert got == want and len(want) > 90
    gone = {i for i, _ in want}
    assert {r["doc_id"] for r in decontamination.decontaminate(d, b, block_bytes=500).collect()} == {i for i, _ in docs} - gone
