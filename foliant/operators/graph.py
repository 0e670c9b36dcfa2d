"""Graphs of citations and links: weight by citation, what a ruling carries along, and groups by links of several strengths.

Iterations are joins and aggregates over edges; each round's result is written, so a lost
executor costs one round. What many edges share (a much cited document, a document that cites
very much) is combined before its shuffle or dealt over parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.operators import store
from foliant.operators.store import HOT_ROWS, cut, dealt, delete, discard, new_path, shuffles_go


def clean_edges(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Distinct edges (src, dst) without nulls and loops."""
    return edges.select(F.col(src).cast("long").alias("src"), F.col(dst).cast("long").alias("dst")).where("src <> dst").distinct()


def pagerank(edges: DataFrame, rounds: int = 10, damping: float = 0.85) -> DataFrame:
    """(id, rank) after a fixed number of rounds from equal ranks, which sum to 1; nodes are the ends of ``edges (src, dst)``.

    Nodes that cite nothing give their rank to all nodes alike. A node with very many
    citations out has its edges dealt over parts; one with very many in has its sum
    combined in each task before the shuffle. Loops and repeated edges count as none and once. Nodes that nobody
    cites all have the same rank, a number, so the rounds only read the edges of the others.
    """
    edges = cut(clean_edges(edges), "edges")
    cited = edges.select(F.col("dst").alias("src")).distinct().withColumn("cited", F.lit(True))
    sources = edges.groupBy("src").agg(F.count("*").alias("degree")).join(cited, "src", "full")
    sources = cut(sources.select("src", F.coalesce("degree", F.lit(0)).alias("degree"), F.coalesce("cited", F.lit(False)).alias("cited")), "nodes")
    n = sources.count()
    degrees = dealt(edges, "src", "dst", sources.where("degree > 0"), "degree")
    # edges of heavy sources are dealt once, before the rounds
    parts = F.when(F.col("degree") > HOT_ROWS, F.ceil(F.col("degree") / HOT_ROWS).cast("int")).otherwise(1)
    degrees = cut(degrees.select("src", "dst", "degree", "cited", F.pmod(F.xxhash64("dst"), parts).cast("int").alias("part")), "edges")
    spread = degrees.where("cited").select("src", "dst", "part")
    # what a node gets from those that nobody cites is their common rank times a constant
    fixed = degrees.where("not cited").groupBy(F.col("dst").alias("id")).agg(F.sum(1 / F.col("degree")).alias("fixed"))
    nodes = sources.where("cited").select(F.col("src").alias("id"), "degree").join(fixed, "id", "left")
    free = 1.0 / max(n, 1)
    ranks = cut(nodes.select("id", "degree", F.coalesce("fixed", F.lit(0.0)).alias("fixed"), F.lit(free).alias("rank")), "ranks")
    for _ in range(rounds):
        lost = ranks.where("degree = 0").agg(F.sum("rank")).first()[0] or 0.0
        sent = ranks.where("degree > 0").select(F.col("id").alias("src"), (F.col("rank") / F.col("degree")).alias("w"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
        got = spread.join(sent, ["src", "part"]).groupBy(F.col("dst").alias("id")).agg(F.sum("w").alias("w"))
        rank = (1 - damping) / max(n, 1) + damping * (F.coalesce("w", F.lit(0.0)) + F.col("fixed") * free + lost / max(n, 1))
        before, ranks = ranks, cut(ranks.select("id", "degree", "fixed").join(got, "id", "left").select("id", "degree", "fixed", rank.alias("rank")), "ranks")
        free = (1 - damping) / max(n, 1) + damping * lost / max(n, 1)
        discard(before)
    for done in (edges, degrees):
        discard(done)
    return ranks.select("id", "rank").unionAll(sources.where("not cited").select("src", F.lit(free)))


def reach(edges: DataFrame, seeds: DataFrame, rounds: int | None = None) -> DataFrame:
    """(id, depth): what can be reached from ``seeds (id)`` along ``edges (src, dst)``, and in how many steps at least; seeds have 0.

    A round joins the edges with what the last one found and takes away what is known; it ends
    when nothing new comes, after ``rounds`` at most. Edges to nodes that lead nowhere are
    left out of the rounds and read once after them. To ask what falls with an
    overturned ruling, the edges go from the cited document to the citing one.
    """
    spark = edges.sparkSession
    edges, base, path = cut(clean_edges(edges), "edges"), new_path(spark, "reach"), new_path(spark, "edges")
    onward = edges.select(F.col("src").alias("dst")).distinct().withColumn("onward", F.lit(True))
    ends = edges.groupBy("dst").agg(F.count("*").alias("n")).join(onward, "dst", "left").select("dst", "n", F.coalesce("onward", F.lit(False)).alias("onward"))
    with shuffles_go(spark):
        dealt(edges, "dst", "src", ends, "n").select("src", "dst", "onward").write.partitionBy("onward").parquet(path)
    discard(edges)
    split = spark.read.schema("src long, dst long, onward boolean").parquet(path)
    inner = split.where("onward").select("src", "dst")
    seeds.select(F.col("id").cast("long").alias("id")).dropna().distinct().write.parquet(f"{base}/depth=0")
    seen, depth = _found(spark, base), 0
    while rounds is None or depth < rounds:
        front = spark.read.schema("id long").parquet(f"{base}/depth={depth}").withColumnRenamed("id", "src")
        if front.isEmpty():
            break
        depth += 1
        with shuffles_go(spark):
            new = dealt(inner, "src", "dst", front).select(F.col("dst").alias("id")).distinct()
            new.join(seen.select("id"), "id", "left_anti").write.parquet(f"{base}/depth={depth}")
        seen = _found(spark, base)
    near = seen if rounds is None else seen.where(F.col("depth") < rounds)
    last = dealt(split.where("not onward").select("src", "dst"), "src", "dst", near.withColumnRenamed("id", "src")).groupBy(F.col("dst").alias("id")).agg((F.min("depth") + 1).alias("depth"))
    last = cut(last.join(seen.select("id"), "id", "left_anti"), "reached")
    delete(spark, path)
    return seen.unionAll(last.select("id", "depth"))


def _found(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.schema("id long, depth int").parquet(base)


def _plain(rows: DataFrame, key: str, by: str, other: DataFrame, count: str | None = None, how: str = "inner") -> DataFrame:
    """``store.dealt`` for tables in which no key can be hot."""
    return rows.join(other, key, how)


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component) of the ends of ``edges (a, b)``: the least id that each is connected with.

    Contraction: every node moves to the first of itself and its neighbours in a random order, another one each round,
    and edges are named anew by where their ends went, so there are fewer by a constant factor
    each round, whatever the shape. What nodes moved to is followed back from the last round to the first. Minima are combined before their
    shuffle, and the edges of nodes with very many are dealt over parts.
    """
    both = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).dropna()
    ends = cut(both.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    now, moves = ends.where("a <> b"), []
    while size := now.count():
        if len(moves) == rounds:
            raise RuntimeError("components did not settle")
        order = lambda c: F.xxhash64(c, F.lit(len(moves)))  # noqa: B023, E731
        around = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = around.groupBy("a").agg(F.min_by("b", order("b")).alias("m"), F.min(order("b")).alias("o"), F.count("*").alias("n"))
        # written before it is read twice: of equal hashes any is right, but the same one everywhere
        to = cut(first.select("a", F.when(order("a") < F.col("o"), F.col("a")).otherwise(F.col("m")).alias("m"), "n"), "moves")
        meet = dealt if size > store.HOT_ROWS else _plain  # with so few edges no node is hot
        half = meet(now, "a", "b", to, "n").select(F.col("m").alias("x"), "b")
        whole = meet(half, "b", "x", to.select(F.col("a").alias("b"), F.col("m").alias("y"), "n"), "n").where("x <> y")
        before, now = now, cut(whole.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), "links")
        if moves:
            discard(before)
        moves.append((to, meet))
    if moves:
        discard(now)
    found = None
    for to, meet in reversed(moves):
        to = to.select(F.col("a").alias("id"), "m")
        if found is not None:
            later = meet(to, "m", "id", found.select(F.col("id").alias("m"), "last"), how="left")
            to = later.select("id", F.coalesce("last", "m").alias("m"))
        found = cut(to.withColumnRenamed("m", "last"), "moved")
    alone = ends.where("a = b").select(F.col("a").alias("id"), F.col("a").alias("component"))
    if found is None:
        return alone
    least = found.groupBy("last").agg(F.min("id").alias("component"), F.count("*").alias("n"))
    out = dealt(found, "last", "id", least, "n").select("id", "component")
    return out.unionAll(alone.join(found.select("id"), "id", "left_anti"))


def shared_keys(documents: DataFrame, id_col: str, signals: list[tuple[str, str]]) -> DataFrame:
    """(id, rank, signal, key) of every document and signal with a value that isn't blank; ``signals`` are (name, column), first ones first."""
    each = [F.struct(F.lit(i).alias("rank"), F.lit(name).alias("signal"), F.col(c).cast("string").alias("key")) for i, (name, c) in enumerate(signals)]
    rows = documents.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.explode(F.array(*each)).alias("s")).select("id", "s.*")
    return rows.where(F.trim(F.coalesce("key", F.lit(""))) != "").distinct()


def _stars(keys: DataFrame, of: str) -> DataFrame:
    """``keys (.., rank, key)`` with ``hub``, the least ``of`` that has the key, for keys that several have: a key's rows become a star, never all pairs."""
    both = keys.withColumn("k", F.concat_ws(":", "rank", "key"))
    hubs = both.groupBy("k").agg(F.min(of).alias("hub"), F.max(of).alias("last"), F.count("*").alias("n")).where("hub < last").select("k", "hub", "n")
    return dealt(both, "k", of, hubs, "n").drop("k", "n")


def _of_stars(stars: DataFrame, of: str, *also: Column) -> DataFrame:
    """(``of``, component, and the aggregates ``also``), one row per ``of``: the least one it is connected with by ``stars (of, hub)``.

    No hub is more than its members, so each goes to its least hub, and only the hubs of
    what has several are linked with each other: members themselves take no part in the rounds.
    """
    each = cut(stars.groupBy(of).agg(F.min("hub").alias("home"), F.max("hub").alias("far"), F.count("*").alias("stars"), *also), "homes")
    several = each.where("home < far").select(of, "home", "stars")
    bridges = dealt(stars.select(of, "hub"), of, "hub", several, "stars").where("hub <> home")
    found = components(bridges.select(F.col("hub").alias("a"), F.col("home").alias("b"))).withColumnRenamed("id", "home")
    return dealt(each, "home", of, found, how="left").withColumn("component", F.coalesce("component", "home")).drop("home", "far", "stars")


def procedural_groups(documents: DataFrame, strong: list[tuple[str, str]], weak: list[tuple[str, str]], id_col: str = "id") -> DataFrame:
    """The table of procedural links: (id, group_id, links, signal, proposed_id, proposed_by, state), one row per document.

    ``strong`` and ``weak`` are signals (name, column) in order of priority; documents with the
    same value share a key. Strong keys make groups, named by their least id; ``links`` is the number of a
    document's strong keys that others have, ``signal`` the first of them. The first strong signal is a
    group's identity (its case number). Weak keys decide nothing, they propose: groups without
    identity that share weak keys are a cluster, and a cluster that shares them with exactly one group that
    has an identity is proposed to it; one that shares them with several is left alone
    (state ``ambiguo``), so no chain of weak keys ever brings two identities together. ``proposed_id`` is the least
    id of what would be one group, ``proposed_by`` the first weak signal of a group that others share, and
    ``state`` then ``propuesto``; ``firme`` are the groups that weak keys say nothing about, and those with an identity.

    Blank and null values are no keys, rows with a null id are left out, repeated ones are one.
    """
    ids = documents.select(F.col(id_col).cast("long").alias("id")).dropna().distinct()
    stars = cut(_stars(shared_keys(documents, id_col, strong), "id"), "stars")
    found = _of_stars(stars, "id", F.count("*").alias("links"), F.min_by("signal", "rank").alias("signal"))
    groups = cut(ids.join(found, "id", "left").select("id", F.coalesce("component", "id").alias("group_id"), F.coalesce("links", F.lit(0)).alias("links"), "signal"), "groups")

    of_group = groups.select("id", "group_id")
    named = shared_keys(documents, id_col, strong[:1]).join(of_group, "id").select("group_id").distinct().withColumn("named", F.lit(True))
    keys = shared_keys(documents, id_col, weak).join(of_group, "id").select("group_id", "rank", "signal", F.concat_ws(":", "rank", "key").alias("k")).distinct()
    keys = cut(keys.join(named, "group_id", "left").withColumn("named", F.coalesce("named", F.lit(False))), "weak")
    nameless = keys.where("not named")
    # what a key joins: any two groups, and the least and the last named one, which say whether there are none, one or several
    least = lambda c: F.min(F.when(c, F.col("group_id")))
    sides = keys.groupBy("k").agg(F.min("group_id").alias("x"), F.max("group_id").alias("y"), least(F.col("named")).alias("first"), F.max(F.when(F.col("named"), F.col("group_id"))).alias("last"), least(~F.col("named")).alias("hub"), F.count("*").alias("n"))
    met = cut(dealt(nameless, "k", "group_id", sides.where("x < y"), "n"), "met")
    by = _of_stars(met, "group_id", F.min_by("signal", "rank").alias("proposed_by"), F.min("first").alias("first"), F.max("last").alias("last"))
    joined = cut(by.withColumnRenamed("component", "cluster"), "clusters")
    around = joined.groupBy("cluster").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    lone = around.where("first = last")
    names = lone.groupBy("first").agg(F.least("first", F.min("cluster")).alias("name"))
    targets = around.join(names, "first", "left").select("cluster", F.coalesce(F.col("first") < F.col("last"), F.lit(False)).alias("several"), "name")
    proposals = joined.select("group_id", "cluster", "proposed_by").join(targets, "cluster").select(
        "group_id", "proposed_by", F.when(F.col("several"), F.col("group_id")).otherwise(F.coalesce("name", "cluster")).alias("target"), F.when(F.col("several"), "ambiguo").otherwise("propuesto").alias("state")
    )
    out = groups.join(proposals, "group_id", "left").join(names.withColumnRenamed("first", "group_id"), "group_id", "left")
    return out.select("id", "group_id", "links", "signal", F.coalesce("target", "name", "group_id").alias("proposed_id"), "proposed_by", F.coalesce("state", F.lit("firme")).alias("state"))
