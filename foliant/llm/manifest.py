"""Operator 12: a Merkle manifest of a dataset, with a proof for every row.

A row is a leaf: the SHA-256 of its columns, each with its length. Leaves of a language
ascend by id; runs of ``FAN`` consecutive nodes become the hash of their concatenated
digests until one is left, the language's subroot, and the subroots become the root
likewise. What is stored are the parents' preimages: the concatenated digests of their
children. A leaf joins the preimages of its ancestors; cutting its own 64 characters
out of each leaves its siblings, and splicing another digest in folds a changed leaf
up to the root that it would have.

Texts are hashed where they are read and never move. Places in the order come from a
range partitioning and the row counts of its parts, so no language is sorted in one
task. Levels are built ``LEVELS`` at a time in blocks of 2**LEVELS neighbours, one
aggregate for each block, so a table of N rows takes log(N) / LEVELS rounds, each
2**LEVELS times smaller than the one before. On the way down a block's path joins the
block once, not once per leaf.

Defined cases: null values are ``-`` in a leaf; a null lang is a group of its own, before
all others, and null ids come first in theirs; rows that share an id stand by their
leaves, equal rows have places of their own; a language with one row has its leaf as
subroot, one with one language its subroot as root; an empty table gives no rows;
further columns are neither hashed nor returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.llm.shared import cut

#: Children of a node, and levels of a block: 2**LEVELS nodes.
FAN = 2
LEVELS = 8
#: One leaf in ``TAMPER`` is changed to test its proof.
TAMPER = 7
DIGEST = 64
STEP = "array<struct<p:string,slot:int>>"


def encoded(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(*values: Column) -> Column:
    return F.sha2(F.concat(*map(encoded, values)), 256)


def leaves(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", lang_col: str = "lang", chars_col: str = "n_chars", text_col: str = "text") -> DataFrame:
    """(grp, doc_id, leaf, changed, m): the leaf of each row as it is and as tampered with, equal rows once with their number."""
    i, source, lang, n, text = F.col(id_col).cast("long"), *(F.col(c) for c in (source_col, lang_col, chars_col, text_col))
    one_more = n.cast("decimal(20,0)") + 1
    changed = F.when(F.crc32(i.cast("string")) % TAMPER == 0, leaf_hash(i, source, lang, one_more, text))
    rows = docs.select(
        F.when(lang.isNull(), "").otherwise(F.concat(F.lit("="), lang)).alias("grp"), i.alias("doc_id"), leaf_hash(i, source, lang, n, text).alias("leaf"), changed.alias("changed")
    )
    return rows.groupBy("grp", "doc_id", "leaf", "changed").agg(F.count("*").alias("m"))


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows (grp, m, ...)`` with ``start``, the number of rows before each in its group, and ``total``, the group's rows."""
    parts = cut(rows.repartitionByRange("grp", *order).withColumn("part", F.spark_partition_id()))
    sizes = parts.groupBy("grp", "part").agg(F.sum("m").alias("rows"))  # one row per part, and one more per group at most
    by_group = Window.partitionBy("grp")
    before = F.sum("rows").over(by_group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("grp", "part", F.coalesce(before, F.lit(0)).alias("base"), F.sum("rows").over(by_group).alias("total"))
    inside = F.sum("m").over(Window.partitionBy("grp", "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    return parts.withColumn("start", F.coalesce(inside, F.lit(0))).join(sizes, ["grp", "part"]).withColumn("start", F.col("base") + F.col("start")).drop("part", "base")


def blocks(rows: DataFrame, node: str, hash_of: str) -> DataFrame:
    """The next ``LEVELS`` levels over ``rows (grp, start, m, total, <node struct>)``.

    One row per block: (grp, block, total, children, p1..pLEVELS, top); ``p`` of a level is the array of its preimages.
    """
    wide = 1 << LEVELS
    ends = F.sequence(F.shiftright("start", LEVELS), F.shiftright(F.col("start") + F.col("m") - 1, LEVELS))
    runs = rows.withColumn("block", F.explode(ends)).groupBy("grp", "block").agg(F.max("total").alias("total"), F.sort_array(F.collect_list(F.struct("start", "m", node))).alias("runs"))
    low, high = F.col("block") * wide, F.col("block") * wide + wide
    many = lambda r: (F.least(r["start"] + r["m"], high) - F.greatest(r["start"], low)).cast("int")
    out = runs.select("grp", "block", "total", F.flatten(F.transform("runs", lambda r: F.array_repeat(r[node], many(r)))).alias("children"))
    out = out.withColumn("h", F.transform("children", lambda c: c[hash_of]))
    for k in range(1, LEVELS + 1):
        # a level exists where the group has more nodes than one below it
        more = F.col("total") > 1 << (k - 1)
        pairs = F.transform(F.sequence(F.lit(0), F.shiftright(F.size("h") - 1, 1)), lambda i: F.concat(F.get("h", i * 2), F.coalesce(F.get("h", i * 2 + 1), F.lit(""))))
        out = out.withColumn(f"p{k}", F.when(more, pairs))
        out = out.withColumn("h", F.when(F.col(f"p{k}").isNull(), F.col("h")).otherwise(F.transform(f"p{k}", lambda p: F.sha2(p, 256))))
    return out.withColumn("top", F.get("h", F.lit(0))).drop("h")


def steps(i: Column) -> Column:
    """Preimages of the ancestors of a block's child ``i`` inside the block, with its slot in each, upwards."""
    found = [F.struct(F.get(f"p{k}", F.shiftright(i, k)).alias("p"), F.shiftright(i, k - 1).bitwiseAND(1).alias("slot")) for k in range(1, LEVELS + 1)]
    return F.filter(F.array(*found), lambda s: s["p"].isNotNull())


def around(s: Column) -> tuple[Column, Column]:
    """What stands before and after a child's own digest in its parent's preimage."""
    return s["p"].substr(F.lit(1), s["slot"] * DIGEST), s["p"].substr(s["slot"] * DIGEST + DIGEST + 1, F.lit(DIGEST * FAN))


def siblings(path: Column) -> Column:
    return F.array_join(F.transform(path, lambda s: F.concat(*around(s))), "")


def folded(path: Column, digest: Column) -> Column:
    """The root that a leaf's digest leads to along its path."""

    def splice(h: Column, s: Column) -> Column:
        before, after = around(s)
        return F.sha2(F.concat(before, h, after), 256)

    return F.aggregate(path, digest, splice)


def tree(rows: DataFrame, node: str, hash_of: str) -> list[DataFrame]:
    """Stored blocks of all rounds, from the leaves up, until every group has one block."""
    rounds = [cut(blocks(rows, node, hash_of))]
    wide = 1 << LEVELS
    while (rounds[-1].agg(F.max("total")).first()[0] or 0) > wide:
        below = rounds[-1].where(F.col("total") > wide)
        above = below.select("grp", F.col("block").alias("start"), F.lit(1).alias("m"), F.ceil(F.col("total") / wide).alias("total"), F.struct(F.col("top").alias("h")).alias("node"))
        rounds.append(cut(blocks(above, "node", "h")))
    return rounds


def descend(block: DataFrame, path: DataFrame, extra: list[str], child: Column | None = None) -> DataFrame:
    """(grp, block, path, ...) of every child of ``block``, from those of the blocks themselves."""
    inside = lambda c, i: F.struct((F.col("block") * (1 << LEVELS) + i).alias("block"), F.concat(steps(i), F.col("path")).alias("path"), c.alias("c"))
    found = block.join(path, ["grp", "block"]).select("grp", *extra, F.explode(F.transform("children", inside)).alias("e"))
    return found.select("grp", *extra, "e.block", "e.path", "e.c")


def manifest(docs: DataFrame, **columns: str) -> DataFrame:
    """Every row with its leaf, subroot, root, the digest of its proof and what a tampered leaf folds to."""
    id_col = columns.get("id_col", "doc_id")
    low = tree(placed(leaves(docs, **columns), ["doc_id", "leaf"]).withColumn("node", F.struct("doc_id", "leaf", "changed")), "node", "leaf")
    done = F.col("total") <= 1 << LEVELS
    subroots = low[0].where(done).select("grp", "top")
    for r in low[1:]:
        subroots = subroots.unionByName(r.where(done).select("grp", "top"))
    langs = placed(subroots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "top", F.lit(1).alias("m")), ["name"])
    high = tree(langs.withColumn("node", F.struct("name", "top")), "node", "top")

    # downwards: the only block of the last round has no ancestors
    path = high[-1].select("grp", "block", F.col("top").alias("root"), F.array().cast(STEP).alias("path"))
    for r in reversed(high[1:]):
        path = descend(r, path, ["root"]).drop("c")
    path = descend(high[0], path, ["root"]).select(F.col("c.name").alias("grp"), F.col("c.top").alias("subroot"), "root", F.lit(0).cast("long").alias("block"), "path")
    extra, last = ["subroot", "root"], path
    for k in range(len(low) - 1, 0, -1):
        # groups whose last round this is enter with their subroot's path, the others with what came down
        down = descend(low[k], path, extra).drop("c")
        path = cut(down.unionByName(last.join(low[k].select("grp").distinct(), "grp", "left_anti")))
    whole = lambda i: F.concat(steps(i), F.col("path"))
    leaf = lambda c, i: F.struct(c["doc_id"].alias(id_col), c["leaf"].alias("leaf"), F.sha2(siblings(whole(i)), 256).alias("proof_sha256"), folded(whole(i), F.coalesce(c["changed"], c["leaf"])).alias("folded_root"))
    out = low[0].join(path, ["grp", "block"]).select("subroot", "root", F.explode(F.transform("children", leaf)).alias("e"))
    return out.select(f"e.{id_col}", "e.leaf", "subroot", "root", "e.proof_sha256", "e.folded_root", (F.col("e.folded_root") == F.col("root")).alias("verified"))


def _leaf_sql(add: int) -> str:
    part = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(({c})::VARCHAR)::VARCHAR || ':' || ({c})::VARCHAR END"
    return "sha256(" + " || ".join(map(part, ("doc_id", "source", "lang", f"n_chars::HUGEINT + {add}", "text"))) + ")"


def _folds_sql(name: str, start: str, nodes: str) -> str:
    """A recursion along the path of each row of ``start (rid, g, lvl, i, proof, h)`` in a tree of ``nodes (g, lvl, i, h)``."""
    other = "coalesce(n.h,'')"
    return f"""{name} AS ({start} UNION ALL
    SELECT f.rid, f.g, f.lvl+1, f.i//2, f.proof || {other}, sha256(CASE WHEN f.i%2=1 THEN {other} || f.h ELSE f.h || {other} END)
    FROM {name} f JOIN (SELECT g, max(lvl) AS last FROM {nodes} GROUP BY g) m ON m.g=f.g AND f.lvl<m.last LEFT JOIN {nodes} n ON n.g=f.g AND n.lvl=f.lvl AND n.i=CASE WHEN f.i%2=1 THEN f.i-1 ELSE f.i+1 END)"""


_LEVEL_SQL = "list_transform(range(0, len(l), 2), lambda i: sha256(l[i+1] || coalesce(l[i+2],'')))"
_NODES_SQL = "SELECT g, lvl, unnest(range(0, len(l))) AS i, unnest(l) AS h FROM"
#: The same in DuckDB; CRC-32 by its table of the reversed polynomial.
SQL = f"""WITH RECURSIVE crc AS (SELECT unnest(range(0,256)) AS i, 0 AS k, unnest(range(0,256)) AS c UNION ALL SELECT i, k+1, CASE WHEN c%2=1 THEN xor(c//2, 3988292384) ELSE c//2 END FROM crc WHERE k<8),
tab AS (SELECT list(c ORDER BY i) AS tab FROM crc WHERE k=8),
d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || lang, '') AS g, {_leaf_sql(0)} AS leaf, {_leaf_sql(1)} AS changed,
    xor(list_reduce(list_transform(string_split(doc_id::VARCHAR,''), lambda c: ascii(c)::BIGINT), lambda c, b: xor(tab[(xor(c,b)&255)+1], c//256), 4294967295), 4294967295) AS crc FROM documents, tab),
o AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf)-1 AS i FROM d),
low AS (SELECT g, 0 AS lvl, list(leaf ORDER BY i) AS l FROM o GROUP BY g UNION ALL SELECT g, lvl+1, {_LEVEL_SQL} FROM low WHERE len(l)>1),
lown AS ({_NODES_SQL} low),
sub AS (SELECT g, l[1] AS subroot, row_number() OVER (ORDER BY g)-1 AS i FROM low WHERE len(l)=1),
high AS (SELECT 0 AS g, 0 AS lvl, list(subroot ORDER BY i) AS l FROM sub UNION ALL SELECT g, lvl+1, {_LEVEL_SQL} FROM high WHERE len(l)>1),
highn AS ({_NODES_SQL} high),
{_folds_sql("f1", "SELECT rid, g, 0 AS lvl, i, '' AS proof, CASE WHEN coalesce(crc % 7 = 0, FALSE) THEN changed ELSE leaf END AS h FROM o", "lown")},
e1 AS (SELECT rid, g, arg_max(proof, lvl) AS proof, arg_max(h, lvl) AS h FROM f1 GROUP BY rid, g),
{_folds_sql("f2", "SELECT rid, 0 AS g, 0 AS lvl, s.i, proof, h FROM e1 JOIN sub s USING (g)", "highn")},
e2 AS (SELECT rid, arg_max(proof, lvl) AS proof, arg_max(h, lvl) AS h FROM f2 GROUP BY rid)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, e2.h AS folded_root, e2.h = root AS verified
FROM o JOIN sub USING (g) JOIN e2 USING (rid), (SELECT l[1] AS root FROM high WHERE len(l)=1)"""
