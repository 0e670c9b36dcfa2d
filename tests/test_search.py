"""Vector and full-text indexes, citation graph and procedural groups against brute force and their SQL."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliant.operators import fulltext, graph, store, vectors


def cosine(a, b):
    return round(float(np.dot(a, b) / (np.linalg.norm(a) * np.linalg.norm(b))), vectors.DIGITS)


@pytest.fixture(scope="module")
def points(spark):
    """Clusters, one very common vector, and vectors that are near to nothing."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] + rng.normal(size=8) * 0.3).tolist()) for i in range(300)] + [(i, [1.0] * 8) for i in range(300, 420)]
    rows += [(500, None), (501, [0.0] * 8), (502, [1.0, 2.0]), (503, [float("nan")] * 8), (504, [float("inf")] + [1.0] * 7), (505, [1.0] * 7 + [None]), (None, [1.0] * 8)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>"), {i: v for i, v in rows[:420]}


def naive_neighbours(known, queries, k):
    out = {}
    for q in queries:
        best = sorted(((-cosine(known[q], v), i) for i, v in known.items() if i != q))[:k]
        out[q] = [i for _, i in best]
    return out


def by_query(found):
    out = defaultdict(list)
    for r in sorted(found.collect(), key=lambda r: (r["query"], r["rank"])):
        out[r["query"]].append(r["id"])
    return dict(out)


@pytest.mark.parametrize("size", [16_384, 50])
def test_exact_neighbours(points, size, monkeypatch):
    df, known = points
    monkeypatch.setattr(vectors, "BLOCK", size)
    monkeypatch.setattr(vectors, "QUERIES", max(7, size // 10))
    asked = [q for q in known if q % 20 == 0]
    assert by_query(vectors.exact(df, df.where("vec_id % 20 = 0 or vec_id >= 500"), 8, 5)) == naive_neighbours(known, asked, 5)
    assert vectors.exact(df.limit(0), df, 8).count() == 0 == vectors.exact(df, df.limit(0), 8).count()


def test_vector_index_finds_what_is_near(points, monkeypatch):
    df, known = points
    asked = [q for q in known if q % 20 == 0]
    queries, want = df.where("vec_id % 20 = 0"), naive_neighbours(known, asked, 5)
    index = vectors.build(df.where("vec_id is null or vec_id < 200 or vec_id >= 250"), 8)
    index = vectors.add(index, df.where("vec_id >= 200 and vec_id < 250"))
    assert index.lists.count() == df.count()
    assert index.lists.where(F.col("cell") == vectors.NOWHERE).count() == 7
    got = by_query(vectors.search(index, queries, 5))
    assert sum(len(set(got[q]) & set(want[q])) for q in asked) >= 0.9 * sum(map(len, want.values()))
    assert by_query(vectors.search(index, queries, 5, probes=len(index.centres))) == want  # all cells: nothing is missed
    monkeypatch.setattr(vectors, "BLOCK", 30)  # the common vector's cell is dealt over parts
    monkeypatch.setattr(vectors, "QUERIES", 3)
    assert by_query(vectors.search(index, queries, 5, probes=len(index.centres))) == want
    again = vectors.load(df.sparkSession, index.path)
    assert again.probes == index.probes and (again.centres == index.centres).all()


def test_vector_index_reads_probed_cells_only(points):
    df, _ = points
    plan = vectors.search(vectors.build(df, 8), df.limit(1), 5)._jdf.queryExecution().optimizedPlan().toString()
    assert "Cartesian" not in plan and "Join Cross" not in plan


def test_queries_go_to_their_cells_in_batches_of_a_bound(points):
    import pyarrow as pa

    rng = np.random.default_rng(5)
    centres, v = rng.normal(size=(3000, 8)), rng.normal(size=(200, 8))
    batch = pa.RecordBatch.from_arrays([pa.array(range(200)), pa.array(v.tolist())], ["id", "v"])
    out = list(vectors._close(iter([batch]), centres, 1000))
    assert max(b.num_rows for b in out) <= 16_384 and sum(b.num_rows for b in out) == 200_000
    cells = {(i, c) for b in out for i, c in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True)}
    assert cells == {(i, c) for i, row in enumerate(np.argsort(-(v @ centres.T), axis=1)[:, :1000]) for c in row.tolist()}


def test_vector_index_of_little(spark, points):
    df, _ = points
    for some in (df.limit(0), df.where("vec_id = 1"), df.where("vec_id >= 500")):
        index = vectors.build(some, 8)
        assert vectors.search(index, df.where("vec_id = 2")).count() == some.where("vec_id = 1").count()


def test_recall_on_the_given_table(spark):
    e = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    q = e.where("vec_id % 20 = 0")
    want = {(r["query"], r["id"]) for r in vectors.exact(e, q, 64).collect()}
    got = {(r["query"], r["id"]) for r in vectors.search(vectors.build(e, 64), q).collect()}
    assert len(got & want) >= 0.9 * len(want)


TEXTS = [(1, "El amparo fue otorgado. El amparo"), (2, "Se OTORGÓ el amparo, otorgado"), (3, None), (4, ""), (5, "a a a a"), (6, "a b a b a"), (7, "ñandú 日本 x_1"), (None, "el amparo"), (8, "amparo " * 50 + "otorgado")]


def tokens(text):
    import unicodedata

    bare = "".join(c for c in unicodedata.normalize("NFD", (text or "").lower()) if unicodedata.category(c) != "Mn")
    return re.findall(r"\w+", bare)


def naive_bm25(docs, query, k):
    docs = {i: tokens(t) for i, t in docs if i is not None}
    mean, n = sum(map(len, docs.values())) / len(docs), len(docs)
    scores = Counter()
    for w in tokens(query):
        df = sum(w in d for d in docs.values())
        for i, d in docs.items():
            if (tf := d.count(w)):
                scores[i] += math.log(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(d) / mean))
    return [(i, round(s, 4)) for i, s in sorted(scores.items(), key=lambda x: (-round(x[1], 6), x[0]))[:k]]


@pytest.fixture(scope="module", params=[100_000, 2])
def index(spark, request):
    """In two segments; once with lists so short that common words are dealt over slices."""
    keep, fulltext.SLICE = fulltext.SLICE, request.param
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    made = fulltext.add(fulltext.build(docs.where("doc_id is null or doc_id < 5"), buckets=4), docs.where("doc_id >= 5"))
    yield made
    fulltext.SLICE = keep


QUERIES = [(1, "amparo otorgado"), (2, "A b"), (3, "nadie"), (4, ""), (5, None), (6, "NANDU"), (7, "amparo amparo x_1"), (8, "el")]


def test_ranked_search(spark, index):
    asked = spark.createDataFrame(QUERIES, "query long, text string")
    got = defaultdict(list)
    for r in sorted(fulltext.ranked(index, asked, 3).collect(), key=lambda r: (r["query"], r["rank"])):
        got[r["query"]].append((r["id"], round(r["score"], 4)))
    assert dict(got) == {q: want for q, t in QUERIES if (want := naive_bm25(TEXTS, t or "", 3))}


def test_phrases(spark, index):
    asked = [(1, "el amparo"), (2, "a b a"), (3, "a a"), (4, "amparo otorgado"), (5, "otorgado el"), (6, "b"), (7, ""), (8, "日本 X_1")]
    got = {(r["query"], r["id"]): r["hits"] for r in fulltext.phrases(index, spark.createDataFrame(asked, "query long, text string")).collect()}
    want = {}
    for q, p in asked:
        for i, t in TEXTS:
            p_, t_ = tokens(p), tokens(t)
            n = sum(t_[j : j + len(p_)] == p_ for j in range(len(t_) - len(p_) + 1)) if p_ else 0
            if n and i is not None:
                want[q, i] = n
    assert got == want


def test_index_survives_a_broken_build_and_merging(spark, index):
    asked = spark.createDataFrame(QUERIES, "query long, text string")
    before = sorted(map(tuple, fulltext.ranked(index, asked).collect()))
    # a build that stopped before its line in ``segments``
    spark.createDataFrame([("amparo", 99, 9)], "word string, documents long, occurrences long").write.parquet(f"{index.path}/words/segment=broken")
    assert sorted(map(tuple, fulltext.ranked(fulltext.load(spark, index.path), asked).collect())) == before
    merged = fulltext.compact(fulltext.load(spark, index.path))
    assert sorted(map(tuple, fulltext.ranked(merged, asked).collect())) == before
    assert merged.postings.select("segment").distinct().count() == 1


def test_search_opens_the_buckets_of_its_words(spark, index):
    wanted = spark.createDataFrame([("amparo", 1)], "word string, query long")
    plan = fulltext.postings_of(index, wanted)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters", 1)[1][:200]


def rows_shuffled(spark, job):
    """Rows that the stages of a job write for others."""
    def total():
        jvm, gateway = spark._jvm, spark.sparkContext._gateway
        stages = spark.sparkContext._jsc.sc().statusStore().stageList(jvm.java.util.ArrayList(), False, False, gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
        return {(s.stageId(), s.attemptId()): s.shuffleWriteRecords() for s in (stages.apply(i) for i in range(stages.size()))}

    before = total()
    job()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    return sum(n for stage, n in total().items() if stage not in before)


@pytest.fixture(scope="module")
def alike(spark):
    """Documents of common words, some with a rare one."""
    texts = [(i, "el amparo fue otorgado por la corte" + (f" x{i // 40}" if i % 40 == 0 else "")) for i in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    return docs, fulltext.build(docs, buckets=4), texts


def test_a_build_shuffles_no_postings(spark, alike):
    assert rows_shuffled(spark, lambda: fulltext.build(alike[0], buckets=4)) < 400  # of 2,810


def test_a_build_shuffles_its_words_once(spark):
    docs = spark.createDataFrame([(i, f"w{i}") for i in range(400)], "doc_id long, text string")
    assert rows_shuffled(spark, lambda: fulltext.build(docs, buckets=4)) < 600  # of 400 words


def test_ranked_search_makes_no_row_of_what_a_query_and_a_document_share(spark, alike):
    docs, index, texts = alike
    queries = docs.where("doc_id < 200").withColumnRenamed("doc_id", "query")
    assert rows_shuffled(spark, lambda: fulltext.ranked(index, queries, 3).collect()) < 12_000  # they share 560,000 words


@pytest.mark.parametrize("block, lot, slack", [(3, 1, 8), (50, 7, 1)])
def test_ranked_search_in_blocks_and_lots(spark, alike, monkeypatch, block, lot, slack):
    docs, index, texts = alike
    for name, value in (("BLOCK", block), ("LOT", lot), ("PARTS", slack), ("SHARED", 1)):
        monkeypatch.setattr(fulltext, name, value)
    asked = [(1, "amparo x3 x7"), (2, "el el corte"), (3, "x1"), (4, "nada"), (5, "x2 la")]
    got = defaultdict(list)
    for r in sorted(fulltext.ranked(index, spark.createDataFrame(asked, "query long, text string"), 4).collect(), key=lambda r: (r["query"], r["rank"])):
        got[r["query"]].append((r["id"], round(r["score"], 4)))
    assert dict(got) == {q: want for q, t in asked if (want := naive_bm25(texts, t, 4))}


@pytest.mark.parametrize("together, added, dense, cheaper", [(64, 500_000, 1024, 200), (3, 2, 0, 200), (5, 7, 2, 10**9), (200, 50, 1024, 10**9)])
def test_many_queries_are_scored_at_once(tmp_path, monkeypatch, together, added, dense, cheaper):
    """Words as rows of a matrix, as lists or as both; blocks of one task; ties; a query without an id."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    for name, value in (("TOGETHER", together), ("ADDED", added), ("DENSE", dense), ("CHEAPER", cheaper)):
        monkeypatch.setattr(fulltext, name, value)
    rng, calls, whole = np.random.default_rng(7), [], fulltext._sums
    monkeypatch.setattr(fulltext, "_sums", lambda first, last, *a: (calls.append(last - first), whole(first, last, *a))[1])
    docs = {i: {int(w): int(rng.integers(1, 4)) for w in rng.choice(30, rng.integers(0, 9), replace=False, p=np.arange(30, 0, -1) / 465)} for i in range(-20, 60)}
    docs |= {i + 100: d for i, d in docs.items()}  # each twice
    asked = [(q if q else None, {int(w): float(rng.integers(1, 9)) for w in rng.choice(33, rng.integers(0, 6), replace=False)}) for q in range(130)]
    mean = sum(sum(d.values()) for d in docs.values()) / len(docs)
    batches = []
    for block in range(3):
        rows = [(block, *r) for i, d in docs.items() if i % 3 == block for r in [(-1, i, sum(d.values())), *((w, i, n) for w, n in d.items())]]
        columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int64(), pa.int64(), pa.int32()), strict=True)]
        batches += pa.Table.from_arrays(columns, ["block", "code", "id", "n"]).to_batches(max_chunksize=70)
    lists = [pa.array([q for q, _ in asked], pa.int64()), pa.array([list(w) for _, w in asked], pa.list_(pa.int64())), pa.array([list(w.values()) for _, w in asked], pa.list_(pa.float64()))]
    pq.write_table(pa.Table.from_arrays(lists, ["query", "codes", "weights"]), f"{tmp_path}/a.parquet")
    got = [tuple(r.values()) for b in fulltext._search(f"file://{tmp_path}", mean, 4)(iter(batches)) for r in b.to_pylist()]
    want = []
    for q, words in asked:
        scores = {i: sum(v * d[w] * 2.2 / (d[w] + 1.2 * (0.25 + 0.75 * sum(d.values()) / mean)) for w, v in words.items() if w in d) for i, d in docs.items() if words.keys() & d.keys()}
        want += [(q, i, round(s, 6)) for i, s in sorted(scores.items(), key=lambda x: (-round(x[1], 6), x[0]))[:4]]
    assert [(q, i) for q, i, _ in got] == [(q, i) for q, i, _ in want] and all(abs(g[2] - w[2]) < 2e-6 for g, w in zip(got, want, strict=True))
    assert len(calls) == 3 * -(-130 // together)


def test_blocks_of_few_documents_go_to_all_cores(spark, alike, monkeypatch):
    monkeypatch.setattr(fulltext, "SMALL", 100, raising=False)
    plan = fulltext.ranked(alike[1], alike[0].withColumnRenamed("doc_id", "query"), 3)._jdf.queryExecution().logical().toString()
    assert spark.sparkContext.defaultParallelism == 4 and re.search(r"Repartition\w* .*\b4\b", plan), plan  # there was 1 block of 400 documents


def test_the_query_asks_all_turns_of_all_documents(spark, tmp_path):
    """Turns whatever their conversation's number, documents whatever their sign: as the query's SQL has them."""
    import duckdb

    from foliant.plans import registry

    spark.createDataFrame([(i, f"amparo x{i % 3}" + " corte" * (i % 4)) for i in range(-7, 12)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    turns = [(c, turn, f"x{c % 3} corte" if turn else "amparo") for c in (0, 1, 19, 20, 21, 40) for turn in (0, 1)]
    spark.createDataFrame(turns, "conv_id long, turn int, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    for name in ("documents", "conversations"):
        con.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    want = con.execute(registry.ORACLES["q83_ranked_search"]).fetchall()
    got = sorted(map(tuple, registry.QUERIES["q83_ranked_search"](spark, str(tmp_path)).collect()))
    assert got == sorted(want) and {q for q, *_ in got} == {c * 1000 + turn for c, turn, _ in turns}
    assert min(i for _, _, i, _ in got) == -7


def test_phrases_look_only_at_holders_of_the_rarest_word(spark, alike):
    index = alike[1]
    asked = spark.createDataFrame([(1, "la corte x3"), (2, "corte x30"), (3, "corte x5 la")], "query long, text string")
    found = []
    assert rows_shuffled(spark, lambda: found.extend(map(tuple, fulltext.phrases(index, asked).collect()))) < 400  # of 1,210
    assert found == [(1, 120, 1)]


def naive_pagerank(edges, rounds):
    edges = {(a, b) for a, b in edges if a is not None and b is not None and a != b}
    nodes = {x for e in edges for x in e}
    deg = Counter(a for a, _ in edges)
    rank = {x: 1 / len(nodes) for x in nodes}
    for _ in range(rounds):
        lost = sum(r for x, r in rank.items() if not deg[x])
        new = {x: 0.15 / len(nodes) + 0.85 * lost / len(nodes) for x in nodes}
        for a, b in edges:
            new[b] += 0.85 * rank[a] / deg[a]
        rank = new
    return rank


EDGES = [(1, 2), (2, 3), (3, 1), (3, 4), (5, 4), (4, 4), (1, 2), (None, 1), (7, 8), (8, 7)] + [(9, x) for x in range(20, 60)] + [(x, 10) for x in range(20, 90)]


@pytest.mark.parametrize("hot", [10_000, 5])
def test_pagerank_with_cycles_sinks_and_hubs(spark, hot, monkeypatch):
    for module in (graph, store):
        monkeypatch.setattr(module, "HOT_ROWS", hot)
    got = {r["id"]: r["rank"] for r in graph.pagerank(spark.createDataFrame(EDGES, "src long, dst long"), 6).collect()}
    want = naive_pagerank(EDGES, 6)
    assert got.keys() == want.keys() and all(abs(got[x] - want[x]) < 1e-12 for x in want)
    assert abs(sum(got.values()) - 1) < 1e-9


@pytest.mark.parametrize("hot", [10_000, 5])
def test_reach(spark, hot, monkeypatch):
    monkeypatch.setattr(store, "HOT_ROWS", hot)
    e = spark.createDataFrame(EDGES, "src long, dst long")
    seeds = spark.createDataFrame([(1,), (9,), (9,), (None,), (77,), (1000,)], "id long")
    want = {1: 0, 9: 0, 77: 0, 1000: 0, 2: 1, 3: 2, 4: 3, 10: 1} | {x: 1 for x in range(20, 60)}
    assert {r["id"]: r["depth"] for r in graph.reach(e, seeds).collect()} == want
    assert {r["id"]: r["depth"] for r in graph.reach(e, seeds, 1).collect()} == {k: v for k, v in want.items() if v <= 1}
    assert graph.reach(e, seeds.limit(0)).count() == 0


def test_what_falls_has_no_bound_of_steps(spark, tmp_path):
    """A chain of 19 citations and a cycle behind it, as the query's SQL has them."""
    import duckdb

    from foliant.plans import registry

    cites = [(20, 1)] + [(i, i - 1) for i in range(21, 40)] + [(41, 39), (42, 41), (43, 42), (41, 43), (50, 51), (40, 40), (44, None)]
    spark.createDataFrame(cites, "l_orderkey long, l_partkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    con = duckdb.connect()
    con.execute(f"create view lineitem as select * from '{tmp_path}/lineitem.parquet/*.parquet'")
    got = {r["id"]: r["depth"] for r in registry.QUERIES["q86_reach"](spark, str(tmp_path)).collect()}
    assert got == {i: i - 20 for i in range(20, 40)} | {40: 0, 41: 20, 42: 21, 43: 22} == dict(con.execute(registry.ORACLES["q86_reach"]).fetchall())


@pytest.fixture
def joins_shuffle(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rounds_of_pagerank_leave_out_what_nobody_cites(spark, joins_shuffle):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 1)] + [(i, i % 3 + 1) for i in range(100, 1100)], "src long, dst long")
    few, many = (rows_shuffled(spark, lambda n=n: graph.pagerank(e, n).collect()) for n in (1, 5))
    assert many - few < 1000  # a round had 1,000 edges


def test_rounds_of_reach_leave_out_what_leads_nowhere(spark, joins_shuffle):
    e = spark.createDataFrame([(i, i + 1) for i in range(1, 8)] + [(9, i) for i in range(100, 1100)], "src long, dst long")
    seeds, found = spark.createDataFrame([(1,)], "id long"), []
    few, many = (rows_shuffled(spark, lambda n=n: found.append(graph.reach(e, seeds, n).count())) for n in (1, 5))
    assert many - few < 1000 and found == [2, 6]  # a round had 1,000 edges


def naive_components(edges):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {x: find(x) for x in up}


@pytest.mark.parametrize("hot", [10_000, 5])
def test_components(spark, hot, monkeypatch):
    monkeypatch.setattr(store, "HOT_ROWS", hot)
    rng = np.random.default_rng(1)
    edges = [(a, b) for a, b in EDGES if a is not None] + [(i, i + 1) for i in range(200, 260)] + [(int(a), int(b)) for a, b in rng.integers(1000, 1200, (90, 2))] + [(5000, 5000)]
    got = {r["id"]: r["component"] for r in graph.components(spark.createDataFrame(edges + [(None, 3)], "a long, b long")).collect()}
    assert got == naive_components(edges)
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_shapes(spark):
    """A path in the order of its ids, a star, and a chain that zigzags settle in few rounds each."""
    path, zigzag = [(i, i + 1) for i in range(300)], [(1000 + i * 37 % 211, 1000 + (i + 1) * 37 % 211) for i in range(210)]
    edges = path + [(2000, 2001 + i) for i in range(100)] + zigzag
    got = {r["id"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long"), rounds=30).collect()}
    assert got == naive_components(edges)


def test_members_take_no_part_in_rounds(spark, monkeypatch):
    """Documents with one key follow their hub; only hubs of what has several keys are linked in the rounds."""
    seen, whole = [], graph.components
    monkeypatch.setattr(graph, "components", lambda edges, *a: (seen.extend(map(tuple, edges.collect())), whole(edges, *a))[1])
    stars = spark.createDataFrame([(i, 1) for i in range(1, 50)] + [(i, 60) for i in range(60, 90)] + [(95, 1), (95, 60), (95, 94), (94, 94), (99, 98), (98, 98)], "id long, hub long")
    got = {r["id"]: (r["component"], r["n"]) for r in graph._of_stars(stars, "id", F.count("*").alias("n")).collect()}
    assert got == {i: (1, 1) for i in [*range(1, 50), *range(60, 90), 94]} | {95: (1, 3), 98: (98, 1), 99: (98, 1)}
    assert sorted(seen) == [(60, 1), (94, 1)]


def test_dealt_left(spark, monkeypatch):
    monkeypatch.setattr(store, "HOT_ROWS", 3)
    rows = spark.createDataFrame([(i, i % 3) for i in range(30)], "id long, k long")
    got = store.dealt(rows, "k", "id", spark.createDataFrame([(0, "a"), (1, "b"), (7, "c")], "k long, v string"), how="left")
    assert sorted((r["id"], r["v"]) for r in got.collect()) == [(i, ("a", "b", None)[i % 3]) for i in range(30)]


def test_procedural_groups(spark):
    rows = [
        (1, "10-20", None, "p", None), (2, "10-20", "r1", None, None), (3, None, "r1", None, "d"),  # one case, 3 by a resolution
        (4, "11-20", None, None, "x"), (5, None, None, "p", None),  # 5 is proposed to 1's group
        (6, None, None, "q", "x"), (7, None, None, "q", "d"),  # 6 and 7 touch two identities: left alone
        (8, None, None, "s", None), (9, None, "r9", "s", None), (10, None, "r9", None, None),  # no identity anywhere
        (11, " ", "", None, None), (None, "10-20", None, None, None), (5, None, None, "p", None),
    ]
    d = spark.createDataFrame(rows, "id long, case string, ruling string, parties string, day string")
    got = {r["id"]: tuple(r)[1:] for r in graph.procedural_groups(d, [("expediente", "case"), ("resolucion", "ruling")], [("partes", "parties"), ("fecha", "day")]).collect()}
    assert got == {
        1: (1, 1, "expediente", 1, None, "firme"), 2: (1, 2, "expediente", 1, None, "firme"), 3: (1, 1, "resolucion", 1, None, "firme"),
        4: (4, 0, None, 4, None, "firme"), 5: (5, 0, None, 1, "partes", "propuesto"), 6: (6, 0, None, 6, "partes", "ambiguo"), 7: (7, 0, None, 7, "partes", "ambiguo"),
        8: (8, 0, None, 8, "partes", "propuesto"), 9: (9, 1, "resolucion", 8, "partes", "propuesto"), 10: (9, 1, "resolucion", 8, "partes", "propuesto"), 11: (11, 0, None, 11, None, "firme"),
    }
