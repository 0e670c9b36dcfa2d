"""Operator 13: document fingerprints by a homomorphic multiset hash of paragraphs.

A text is the multiset of its paragraphs (what stands between line ends). Each
paragraph has a wide vector of whole numbers, and a document's vector is the sum of its
paragraphs' modulo 2**32: it doesn't depend on their order, and ``insert`` and ``delete``
of a paragraph add and subtract its vector without the rest of the text. The first ``SURE``
numbers are SHA-256 of the paragraph: equal ones mean equal multisets of paragraphs (by
chance, that is; it takes a wider sum to keep out somebody who looks for collisions). The other
``LIKE`` are the sum of a vector of ones and minus ones, the bits of MD5, for each piece of the
paragraph: three words, or fewer before a mark of punctuation or the line end. So products of two
documents' numbers estimate how many pieces they share, with an error of about 1 / sqrt(LIKE).

A vector is a Column expression of the text: Spark's own functions, in the row, nothing is
exploded or shuffled for it. Four sums share a 64-bit number while pieces
are added up. Texts are shuffled once, by row key; the next document of each row is found on keys
alone, by a range partitioning whose parts hand the first key of each to the one before, and sends
only as much of its beginning as the row's edited text takes, with its vector.

Defined cases: a null text is an empty one, which has no paragraph and the vector of zeros;
paragraphs are compared as they are, empty ones between line ends included; ids descend with null
last, rows that share an id stand by the SHA-256 of their texts, equal rows follow each
other; the only row of a table is its own next; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.functions.text import let
from foliant.llm.shared import cut

SURE, LIKE = 8, 128
MASK, WHOLE = (1 << 32) - 1, 1 << 32
#: Pieces whose bits are added up in lanes of 16 bits; more are added up in lots.
PACKED = (1 << 15) - 1
#: Up to three words with nothing but white space between them.
_WORD = r"[^\x09-\x0D\x20.,;:!?]+"
PIECE = rf"(?:{_WORD}[\x09\x0B-\x0D\x20]+){{0,2}}{_WORD}"


def bits(hexadecimal: Column, at: int, digits: int) -> Column:
    """``digits`` hexadecimal digits from ``at`` on as a long; 16 digits as a signed one."""
    return F.conv(F.substring(hexadecimal, at + 1, digits), 16, -10 if digits == 16 else 10).cast("long")


def _wrapped(x: Column) -> Column:
    """A long modulo 2**32 as an int, signed."""
    return ((x + WHOLE // 2).bitwiseAND(F.lit(MASK)) - WHOLE // 2).cast("int")


def _total(values: Column, of) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda s, x: s + of(x))


def _lane(q: int):
    return lambda x: F.shiftrightunsigned(x, 16 * q).bitwiseAND(F.lit(0xFFFF))


def vector(text: Column) -> Column:
    """array<int> of ``SURE + LIKE`` numbers: the fingerprint of a text."""
    paragraphs = F.when(text != "", F.split(text, "\n")).otherwise(F.array().cast("array<string>"))
    digests = F.transform(paragraphs, lambda p: F.sha2(p, 256))
    sure = let(digests, lambda d: F.array(*(_wrapped(_total(d, lambda h, k=k: bits(h, 8 * k, 8))) for k in range(SURE))))
    four = F.lit(sum(1 << 16 * q for q in range(4)))

    def ones(half: Column) -> Column:
        """How many of at most ``PACKED`` numbers have each of 64 bits: four sums share a number."""
        sums = [_total(half, lambda y, b=b: F.shiftrightunsigned(y, b).bitwiseAND(four)) for b in range(16)]
        return let(F.array(*sums), lambda s: F.concat(*(F.transform(s, _lane(q)) for q in range(4))))

    def like(half: Column, n: Column) -> Column:
        """64 numbers: twice the ones of each bit less the number of pieces."""
        lots = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / PACKED).cast("int")), lambda i: ones(F.slice(half, i * PACKED + 1, F.lit(PACKED))))
        many = F.aggregate(lots, F.array_repeat(F.lit(0).cast("long"), 64), lambda s, x: F.zip_with(s, x, lambda a, b: a + b))
        return F.transform(F.when(n <= PACKED, ones(half)).otherwise(many), lambda x: _wrapped(x * 2 - n))

    pieces = F.transform(F.regexp_extract_all(text, F.lit(PIECE), F.lit(0)), lambda p: F.md5(p))

    def half(digests: Column, j: int) -> Column:
        return let(F.transform(digests, lambda h: bits(h, 16 * j, 16)), lambda y: like(y, F.size(y)))

    return F.concat(sure, let(pieces, lambda m: F.concat(*(half(m, j) for j in range(LIKE // 64)))))


def insert(vector: Column, other: Column) -> Column:
    """The vector of two multisets together: that of a document with paragraphs inserted."""
    return F.zip_with(vector, other, lambda a, b: _wrapped(a.cast("long") + b))


def delete(vector: Column, other: Column) -> Column:
    """The vector of a document without the paragraphs that ``other`` is the vector of."""
    return F.zip_with(vector, other, lambda a, b: _wrapped(a.cast("long") - b))


def text_form(vector: Column) -> Column:
    return F.array_join(F.transform(vector, lambda a: F.lpad(F.lower(F.hex(a.cast("long").bitwiseAND(F.lit(MASK)))), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: 1 for equal vectors; else the shared pieces against those of the document with more, as the numbers estimate them."""
    like = lambda v: F.slice(v, SURE + 1, LIKE)
    product = lambda v, w: F.aggregate(F.zip_with(like(v), like(w), lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)
    most = F.greatest(product(a, a), product(b, b))
    return F.when(a == b, F.lit(1.0)).when(most == 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), product(a, b) / most))


def successors(rows: DataFrame) -> DataFrame:
    """(key, ..., next): the key of the next row by descending id; ``rows (key, id, sha, ...)`` are one per key.

    Each part of a range partitioning finds its rows' successors itself, but for its last row's, which is the first of the next part.
    """
    order = [F.desc_nulls_last("id"), F.asc("sha")]
    parts = cut(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    inside = parts.withColumn("next", F.lead("key").over(Window.partitionBy("part").orderBy(*order)))
    firsts = parts.groupBy("part").agg(F.min_by("key", F.struct(F.col("id").isNull(), -F.col("id").cast("decimal(20,0)"), "sha")).alias("first"))
    ring = F.array_sort(F.collect_list(F.struct("part", "first")))  # as many as the partitioning has parts
    ring = firsts.agg(ring.alias("r")).select(F.inline(F.transform("r", lambda p, i: F.struct(p["part"].alias("part"), F.get("r", (i + 1) % F.size("r"))["first"].alias("first")))))
    return inside.join(ring, "part").withColumn("next", F.coalesce("next", "first")).drop("part", "first")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, vector, fingerprint) of every row, without a shuffle."""
    rows = docs.select(F.col(id_col), vector(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("vector"))
    return rows.select(id_col, "vector", text_form(F.col("vector")).alias("fingerprint"))


def edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's fingerprint, that of its edited text (the last half of it replaced by the beginning of the next document's), and how alike they are."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.sha2(text, 256).alias("sha"))
    key = F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), F.col("sha")).alias("key")
    texts = rows.select(key, "text").groupBy("key").agg(F.max("text").alias("text"))

    skinny = rows.select(key, "id", "sha", F.char_length("text").cast("long").alias("n_chars")).groupBy("key", "id", "sha", "n_chars").agg(F.count("*").alias("m"))
    after = successors(skinny)
    # equal rows are each other's next, but for the last of them
    ways = F.array(F.struct("next", F.lit(1).cast("long").alias("m")), F.struct(F.col("key").alias("next"), (F.col("m") - 1).alias("m")))
    after = after.select("key", "id", "n_chars", F.explode(ways).alias("w")).where("w.m > 0").select("key", "id", "n_chars", "w.next", "w.m")

    half = F.floor(F.col("n_chars") / 2).cast("int")
    sent = texts.withColumnRenamed("key", "next").join(after, "next").select("key", "id", "n_chars", "m", F.substring("text", F.lit(1), half).alias("beginning"), vector(F.col("text")).alias("next_vector"))
    kept = F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int"))
    out = texts.join(sent, "key").select("id", "n_chars", "m", "next_vector", vector(F.col("text")).alias("vector"), F.concat(kept, "beginning").alias("edited"))
    out = out.select("id", "n_chars", "m", "next_vector", "vector", F.sha2("edited", 256).alias("edited_sha256"), vector(F.col("edited")).alias("edited_vector"))
    out = out.select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", text_form(F.col("vector")).alias("fingerprint"), text_form(F.col("edited_vector")).alias("edited_fingerprint"),
        likeness(F.col("vector"), F.col("edited_vector")).alias("near_edited"), likeness(F.col("vector"), F.col("next_vector")).alias("near_next"), "m",
    )
    return out.withColumn("m", F.explode(F.sequence(F.lit(1), F.col("m")))).drop("m")


_BITS_SQL = ", ".join(f"coalesce(sum(((y{j} >> {b}) & 1)::BIGINT*2-1),0)::BIGINT" for j in range(LIKE // 64) for b in range(64))
_SURE_SQL = ", ".join(f"coalesce(sum(('0x' || substr(h,{8 * k + 1},8))::BIGINT),0)::BIGINT" for k in range(SURE))
#: The same in DuckDB.
SQL = rf"""WITH d AS (SELECT doc_id, coalesce(text,'') AS text, row_number() OVER (ORDER BY doc_id DESC NULLS LAST, sha256(coalesce(text,''))) AS rn FROM documents),
e AS (SELECT d.rn, n.rn AS next_rn, d.doc_id, length(d.text) AS n_chars, d.text, substr(d.text,1,length(d.text)-length(d.text)//2) || substr(n.text,1,length(d.text)//2) AS edited
    FROM d JOIN d n ON n.rn = CASE WHEN d.rn = (SELECT max(rn) FROM d) THEN 1 ELSE d.rn+1 END),
u AS (SELECT rn, 0 AS kind, text AS t FROM e UNION ALL SELECT rn, 1, edited FROM e),
p AS (SELECT rn, kind, unnest(CASE WHEN t='' THEN [] ELSE string_split(t, chr(10)) END) AS p FROM u),
a AS (SELECT rn, kind, [{_SURE_SQL}] AS sure FROM (SELECT rn, kind, sha256(p) AS h FROM p) GROUP BY ALL),
m AS (SELECT rn, kind, md5(unnest(regexp_extract_all(t, '{PIECE}'))) AS m FROM u),
b AS (SELECT rn, kind, [{_BITS_SQL}] AS likes FROM (SELECT rn, kind, ('0x' || substr(m,1,16))::UBIGINT AS y0, ('0x' || substr(m,17,16))::UBIGINT AS y1 FROM m) GROUP BY ALL),
v AS (SELECT rn, kind, coalesce(sure, list_resize([0::BIGINT],{SURE},0)) AS sure, coalesce(likes, list_resize([0::BIGINT],{LIKE},0)) AS likes FROM u LEFT JOIN a USING (rn, kind) LEFT JOIN b USING (rn, kind)),
f AS (SELECT rn, kind, array_to_string(list_transform(list_concat(sure, likes), lambda x: lpad(lower(to_hex(((x % {WHOLE}) + {WHOLE}) % {WHOLE})),8,'0')),'') AS f, likes::DOUBLE[] AS l FROM v),
s AS (SELECT e.rn, doc_id, n_chars, sha256(edited) AS edited_sha256, o.f AS fingerprint, c.f AS edited_fingerprint, x.f AS next_fingerprint, o.l AS ol, c.l AS cl, x.l AS xl
    FROM e JOIN f o ON o.rn=e.rn AND o.kind=0 JOIN f c ON c.rn=e.rn AND c.kind=1 JOIN f x ON x.rn=e.next_rn AND x.kind=0),
l AS (SELECT *, list_dot_product(ol,ol) AS oo, list_dot_product(cl,cl) AS cc, list_dot_product(xl,xl) AS xx, list_dot_product(ol,cl) AS oc, list_dot_product(ol,xl) AS ox FROM s)
SELECT doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    CASE WHEN fingerprint=edited_fingerprint THEN 1.0 WHEN greatest(oo,cc)=0 THEN 0.0 ELSE greatest(0.0, oc/greatest(oo,cc)) END::DOUBLE AS near_edited,
    CASE WHEN fingerprint=next_fingerprint THEN 1.0 WHEN greatest(oo,xx)=0 THEN 0.0 ELSE greatest(0.0, ox/greatest(oo,xx)) END::DOUBLE AS near_next FROM l"""
