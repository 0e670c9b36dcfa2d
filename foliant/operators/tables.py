"""Relational operators over registers and logs: latest state, upsert, resume, ranges, samples, summaries."""

from __future__ import annotations

import math
import subprocess

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.functions.casenum import document_years, year_of
from foliant.functions.stats import Z95, cochran
from foliant.operators.store import cut, dealt


def keep(df: DataFrame, key: str, order: str, which: str = "last") -> DataFrame:
    """One row per key: the first or last by ``order``; ties by a hash of the row, so the choice is deterministic.

    An aggregate of whole rows rather than a window: it combines before the shuffle, so a
    key with very many rows isn't sorted in one task. Columns may be maps, which have no
    order: the row is carried along and only its hash is compared.
    """
    place = F.struct(F.col(order), F.xxhash64(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})).alias("__tie"))
    best = (F.max_by if which == "last" else F.min_by)(F.struct(*df.columns), place)
    return df.groupBy(F.col(key).alias("__key")).agg(best.alias("__best")).select("__best.*")


def latest(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """(key, value) with the latest value per key."""
    return df.groupBy(key).agg(F.max_by(value, F.struct(order, value)).alias(value))


def pending(wanted: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What is wanted and not done yet."""
    return wanted.join(done.select(key).distinct(), key, "left_anti")


def done_keys(log: DataFrame, key: str, outcome: str, order: str, ok: list[str], retry_failed: bool = True) -> DataFrame:
    """Keys that needn't be tried again: latest outcome is ok, or any outcome at all without ``retry_failed``."""
    state = latest(log, key, outcome, order)
    return state.where(F.col(outcome).isin(*ok)).select(key) if retry_failed else state.select(key)


def period_of(year: Column, periods: list[tuple[str, int, int]]) -> Column:
    """Name of the first period whose inclusive bounds hold the year: a range join on inline rows."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, low, high in periods:
        out = out.when(year.between(low, high), name)
    return out


#: The study's periods and seeds.
PERIODS = [("2003-2010", 2003, 2010), ("2011-2015", 2011, 2015), ("2016-2019", 2016, 2019), ("2020-2023", 2020, 2023)]
SEED_SAMPLE, SEED_STUDY = 20260829, 20260830


def shuffle_key(seed: int, stratum: Column | str, key: Column) -> Column:
    """Order by it for a seeded shuffle; of each stratum its own, so that a new stratum leaves the others' samples alone."""
    part = F.lit(stratum) if isinstance(stratum, str) else stratum.cast("string")
    return F.md5(F.concat_ws(":", F.lit(str(seed)), part, key.cast("string")))


def stratified_sample(df: DataFrame, key: str, stratum: str, seed: int, size: Column | None = None, error: float = 0.05, bound: int | None = None) -> DataFrame:
    """Exact-size sample without replacement per stratum, with ``stratum_n`` and ``sample_n``.

    ``size`` is a Column over ``stratum_n``; by default Cochran's with correction. ``bound`` is a
    number that no sample exceeds, if there is one (Cochran's has). With it each task keeps its first
    ``bound`` rows of a stratum before the shuffle, so a stratum with most of the rows isn't
    sorted in one task. Without one the cut is found by ``cut_by_prefix``; the rows are the same.
    """
    if size is None:
        bound = math.ceil(Z95**2 * 0.25 / error**2)
    n = df.groupBy(stratum).agg(F.count("*").alias("stratum_n"))
    n = n.withColumn("sample_n", (cochran(F.col("stratum_n"), error) if size is None else size).cast("long"))
    ranked = df.withColumn("__o", shuffle_key(seed, F.col(stratum), F.col(key)))
    if bound is None:
        return cut_by_prefix(ranked, n, key, stratum)
    w = Window.partitionBy(stratum).orderBy("__o", F.col(key).cast("string"))
    first = ranked.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= bound)
    return first.join(n, stratum).where("__r <= sample_n").drop("__o", "__r")


#: Hexadecimal digits of the order by which a stratum is counted: 16**4 slices.
PREFIX = 4
#: Strata up to this number go to every executor.
SHARED_STRATA = 100_000


def cut_by_prefix(ranked: DataFrame, sizes: DataFrame, key: str, stratum: str) -> DataFrame:
    """The first ``sample_n`` rows of each stratum by ``__o``, a hash in hexadecimal, without sorting any stratum.

    Rows are counted by the hash's first digits; the running count of these slices says
    which of them are whole in the sample and which one is cut. Whole ones are a filter; only the
    one that is cut, a stratum's 65,536th part, is sorted.
    """
    slice_of = F.substring("__o", 1, PREFIX)
    counts = ranked.groupBy(F.col(stratum).alias("__s"), slice_of.alias("__cut")).agg(F.count("*").alias("__c"))
    upto = F.sum("__c").over(Window.partitionBy("__s").orderBy("__cut"))  # 16**PREFIX rows at most
    counts = counts.withColumn("__upto", upto).join(sizes.withColumnRenamed(stratum, "__s"), "__s")
    # the slice in which the sample ends; of one that takes all or nothing, the last or the first
    end = F.greatest(F.col("sample_n"), F.lit(1))
    cuts = counts.where((F.col("__upto") - F.col("__c") < F.least(end, "stratum_n")) & (F.least(end, "stratum_n") <= F.col("__upto")))
    cuts = cut(cuts.select("__s", "__cut", "stratum_n", "sample_n", (F.col("sample_n") - F.col("__upto") + F.col("__c")).alias("__rest")), "cuts")
    if cuts.count() <= SHARED_STRATA:  # a row per stratum goes to the rows, so no task gets a stratum's rows
        placed = ranked.join(F.broadcast(cuts), F.col(stratum) == F.col("__s"))
    else:
        placed = dealt(ranked.withColumn("__s", F.col(stratum)), "__s", "__o", cuts, "stratum_n")
    placed = placed.withColumn("__p", slice_of)
    whole = placed.where("__p < __cut")
    part = placed.where("__p = __cut").withColumn("__r", F.row_number().over(Window.partitionBy("__s").orderBy("__o", F.col(key).cast("string")))).where("__r <= __rest").drop("__r")
    return whole.unionAll(part).drop("__o", "__s", "__cut", "__rest", "__p")


def quota_sample(df: DataFrame, key: str, stratum: str, seed: int, quota: int) -> DataFrame:
    return stratified_sample(df, key, stratum, seed, F.least(F.lit(quota).cast("long"), F.col("stratum_n")), bound=quota)


def plan_sample(df: DataFrame, key: str, stratum: str, seed: int, plan: dict[str, int]) -> DataFrame:
    """A quota of its own for each stratum; strata outside the plan give nothing."""
    quota = F.create_map(*[F.lit(x) for kv in plan.items() for x in kv])
    size = F.least(F.try_element_at(quota, F.col(stratum)).cast("long"), F.col("stratum_n"))
    return stratified_sample(df.where(F.col(stratum).isin(*plan)), key, stratum, seed, size, bound=max(plan.values()))


def shuffled(df: DataFrame, key: str, seed: int) -> DataFrame:
    """Global seeded order in which every prefix is a valid sample."""
    return df.orderBy(shuffle_key(seed, "orden", F.col(key)), F.col(key).cast("string"))


def design(sample: DataFrame, stratum: str, seed: int, error: float, census: DataFrame, key: str, note: str = "") -> DataFrame:
    """One row that a sample can be repeated from: seed, error, confidence, p, window, sizes of each stratum, and what the census was.

    ``strata`` is {stratum: {universe, sampled}}; ``since`` and ``until`` are the outer strata. ``census_hash``
    is a sum of row hashes of (key, stratum): the same for the same rows in any order.
    """
    per = sample.groupBy(stratum).agg(F.first("stratum_n").alias("universe"), F.count("*").alias("sampled"))
    entry = F.struct(F.col(stratum).cast("string").alias("k"), F.struct("universe", "sampled").alias("v"))
    drawn = per.agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("strata"), F.min(stratum).alias("since"), F.max(stratum).alias("until"), F.sum("universe").alias("total_n"), F.sum("sampled").alias("sampled"))
    whole = census.agg(F.count("*").alias("census_rows"), F.sha2(F.sum(F.xxhash64(key, stratum).cast("decimal(38,0)")).cast("string"), 256).alias("census_hash"))
    fixed = [F.lit(seed).alias("seed"), F.lit(error).alias("error"), F.lit(0.95).alias("confidence"), F.lit(0.5).alias("p"), F.lit(note).alias("note")]
    return drawn.join(whole, F.lit(True)).select(*fixed, "strata", "since", "until", "total_n", "sampled", "census_rows", "census_hash")  # one row each


def state_counts(df: DataFrame, state: str, alerts: str) -> DataFrame:
    """(field, state, n): rows by state, and how many have alerts."""
    each = F.array(F.struct(F.lit("state").alias("field"), F.col(state).alias("state"), F.lit(1).alias("n")), F.struct(F.lit("alerts").alias("field"), F.lit("with").alias("state"), (F.size(F.coalesce(F.col(alerts), F.array())) > 0).cast("int").alias("n")))
    return df.select(F.explode(each).alias("e")).groupBy("e.field", "e.state").agg(F.sum("e.n").alias("n"))


def weighted_total(sample: DataFrame, condition: Column) -> DataFrame:
    """Horvitz-Thompson estimate of how many of the universe meet ``condition``, with what was sampled."""
    w = F.col("stratum_n") / F.col("sample_n")
    return sample.agg(F.sum(F.when(condition, w).otherwise(0.0)).alias("estimate"), F.count_if(condition).alias("hits"), F.count("*").alias("sampled"))


def census_summary(census: DataFrame, as_of_year: int) -> DataFrame:
    """One row: distinct documents, distinct cases, documents by year and by type, missing dates, and underivable cases by reason.

    ``census (id, cases, kind, decided, ord)``; a repeated id counts once, by its first row. A
    document counts once per distinct year. The census is read once: each document gives a few
    (what, value) rows, which are counted together. The underivable cases themselves are a table
    of their own, ``underivable_cases``, as they may be many.
    """
    entry = lambda what, value, detail=None: F.struct(F.lit(what).alias("what"), value.cast("string").alias("value"), (F.lit(None).cast("string") if detail is None else detail).alias("detail"))
    docs = keep(census, "id", "ord", "first").withColumn("__y", F.transform("cases", lambda c: F.struct(c.alias("case"), year_of(c, as_of_year).alias("y"))))
    years = F.array_distinct(F.array_compact(F.transform("__y", lambda x: x["y"]["year"])))
    each = F.concat(
        F.array(entry("document", F.when(F.col("decided").isNull(), "undated").otherwise("dated")), entry("kind", F.coalesce("kind", F.lit("(sin tipo)")))),
        F.transform(years, lambda y: entry("year", y)), F.transform(F.array_distinct(F.coalesce("__y", F.array())), lambda x: entry("case", x["case"], x["y"]["reason"])),
    )
    counted = docs.select(F.explode(each).alias("e")).groupBy("e.what", "e.value").agg(F.count("*").alias("n"), F.max("e.detail").alias("detail"))
    # cases are many: they are counted by reason before anything is gathered
    small = counted.groupBy("what", F.when(F.col("what") == "case", F.col("detail")).otherwise(F.col("value")).alias("value")).agg(F.sum(F.when(F.col("what") == "case", 1).otherwise(F.col("n"))).alias("n"))
    as_map = lambda what: F.map_from_entries(F.array_sort(F.collect_list(F.when((F.col("what") == what) & F.col("value").isNotNull(), F.struct("value", "n")))))
    total = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))
    is_case = F.col("what") == "case"
    return small.agg(
        total(F.col("what") == "document").alias("documents"), total((F.col("what") == "document") & (F.col("value") == "undated")).alias("missing_date"), total(is_case).alias("cases"),
        total(is_case & F.col("value").isNotNull()).alias("underivable"), as_map("year").alias("by_year"), as_map("kind").alias("by_kind"), as_map("case").alias("by_reason"),
    )


def underivable_cases(census: DataFrame, as_of_year: int) -> DataFrame:
    """(case, reason) of every distinct case number without a year."""
    cases = keep(census, "id", "ord", "first").select(F.explode("cases").alias("case")).distinct()
    return cases.select("case", year_of(F.col("case"), as_of_year)["reason"].alias("reason")).where("reason is not null")


def by_year(census: DataFrame, as_of_year: int, *policies: str) -> DataFrame:
    """(policy, year, documents): documents per year under each of the policies of assigning years, from one scan."""
    entry = lambda policy, year: F.struct(F.lit(policy).alias("policy"), year.alias("year"))
    each = []
    for policy in policies:
        y = document_years(F.col("cases"), as_of_year, policy)
        each.append(F.transform(y, lambda x: entry("each", x)) if policy == "each" else F.array(entry(policy, y)))
    years = census.select("id", F.explode(F.concat(*each)).alias("e")).where("e.year is not null").select("id", "e.*")
    return years.groupBy("policy", "year").agg(F.countDistinct("id").alias("documents"))


def rates(df: DataFrame, group: str, effect: str, rule: str, disputed: str, total: bool = False) -> DataFrame:
    """Decisions on the merits by group: n, broad and strict counts of altering ones (strict without the disputed rule).

    With ``total``, a further row pools all groups (null group). A rate never goes without its n.
    """
    rows = df.where(F.col(effect).isin("altera", "mantiene") & F.col(group).isNotNull())
    broad, strict = F.col(effect) == "altera", (F.col(effect) == "altera") & (F.coalesce(F.col(rule), F.lit("")) != disputed)
    measures = [F.count("*").alias("n"), F.count_if(broad).alias("broad"), F.count_if(strict).alias("strict")]
    return rows.rollup(group).agg(*measures) if total else rows.groupBy(group).agg(*measures)


def weighted_accuracy(reviewed: DataFrame, sizes: DataFrame, renormalize: bool = False) -> DataFrame:
    """One row: reviewed n, right k, weighted rate. ``reviewed (stratum, right)``, ``sizes (stratum, size)``.

    Strata without any review add to the denominator only, unless ``renormalize``.
    """
    per = sizes.join(reviewed.groupBy("stratum").agg(F.count("*").alias("n"), F.count_if("right").alias("k")), "stratum", "left")
    rate = F.when(F.col("n") > 0, F.col("k") / F.col("n"))
    weight = F.when(F.col("n") > 0, F.col("size")) if renormalize else F.col("size")
    return per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("k"), F.lit(0)).alias("k"), (F.sum(F.coalesce(rate * F.col("size"), F.lit(0.0))) / F.sum(weight)).alias("weighted"))


def zero_filled_counts(df: DataFrame, column: str, domain: list[str]) -> DataFrame:
    """Counts of a closed domain, with 0 for values that don't occur."""
    every = df.sparkSession.createDataFrame([(d,) for d in domain], f"{column} string")
    return every.join(df.groupBy(column).agg(F.count("*").alias("n")), column, "left").select(column, F.coalesce("n", F.lit(0)).alias("n"))


def crosstab(df: DataFrame, row: str, column: str, values: list[str]) -> DataFrame:
    return df.groupBy(row).agg(*[F.count_if(F.col(column) == v).alias(v) for v in values])


def counts(df: DataFrame, column: str, missing: str | None = None) -> DataFrame:
    """Rows per value, most common first; ties by value. ``missing`` names the nulls, which are left as null otherwise."""
    value = F.coalesce(F.col(column), F.lit(missing)) if missing is not None else F.col(column)
    return df.groupBy(value.alias(column)).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def coverage(df: DataFrame, by: str, *fields: str) -> DataFrame:
    """n by group, and for each field how many have it and their percentage."""
    has = lambda f: F.count_if(F.coalesce(F.trim(F.col(f).cast("string")), F.lit("")) != "")
    return df.groupBy(by).agg(F.count("*").alias("n"), *[has(f).alias(f) for f in fields], *[F.round(100 * has(f) / F.count("*"), 1).alias(f"{f}_pct") for f in fields])


def term_fields(cards: DataFrame, attributes: str, term: str) -> DataFrame:
    """In which fields of a map a term occurs, and how often."""
    return cards.select(F.explode(attributes).alias("field", "value")).where(F.contains(F.lower("value"), F.lit(term.lower()))).groupBy("field").agg(F.count("*").alias("n"))


def progress(df: DataFrame, **conditions: Column) -> DataFrame:
    """One row: how many rows were processed and how many meet each condition."""
    return df.agg(F.count("*").alias("processed"), *[F.count_if(c).alias(name) for name, c in conditions.items()])


def reusable(wanted: DataFrame, previous: DataFrame, files: DataFrame, key: str) -> DataFrame:
    """Earlier downloads that may stand in for new ones: same key, and the file is there with the recorded size.

    ``previous (key, path, size)``, ``files (path, length)``; a key with several keeps the least path.
    """
    found = previous.join(files, "path").where("size = length and size > 0")
    return wanted.join(found.groupBy(key).agg(F.min(F.struct("path", "size")).alias("f")).select(key, "f.path", "f.size"), key)


def capped(df: DataFrame, n: int, hard_cap: int, *order: str) -> DataFrame:
    """The first ``n`` rows by ``order``; more than the hard cap is refused, not shortened."""
    if not 0 < n <= hard_cap:
        raise ValueError(f"limit {n} is not within 1..{hard_cap}")
    return df.orderBy(*order).limit(n)


def numbered(df: DataFrame, key: str, seed: int, name: str = "n") -> DataFrame:
    """Rows numbered from 1 in seeded order (``key`` names a row); rows that repeat a key follow each other.

    The order's first four digits cut it into 65,536 slices. Each is numbered by itself, on top of the rows before
    it, so that no task sorts all rows; a table of the slices' sizes is what is broadcast.
    """
    rows = df.withColumn("__order", shuffle_key(seed, "orden", F.col(key))).withColumn("__slice", F.substring("__order", 1, 4))
    sizes = rows.groupBy("__slice").agg(F.count("*").alias("__size"))
    before = sizes.select("__slice", (F.sum("__size").over(Window.orderBy("__slice")) - F.col("__size")).alias("__before"))
    within = F.row_number().over(Window.partitionBy("__slice").orderBy("__order", F.col(key).cast("string")))
    return rows.join(F.broadcast(before), "__slice").withColumn(name, within + F.col("__before")).select(*[c for c in df.columns if c != name], name)


def stamped(df: DataFrame, run_id: str, versions: dict[str, str], repository: tuple[str | None, bool | None] = (None, None), input_tokens: Column | None = None, output_tokens: Column | None = None) -> DataFrame:
    """Columns that name the run and what is behind each row: versions, the commit and whether it had changes, tokens used (null where no model was asked)."""
    commit, changed = repository
    none = F.lit(None).cast("long")
    about = {"git_commit": F.lit(commit).cast("string"), "git_changed": F.lit(changed).cast("boolean"), "input_tokens": none if input_tokens is None else input_tokens.cast("long"), "output_tokens": none if output_tokens is None else output_tokens.cast("long")}
    return df.withColumns({"run_id": F.lit(run_id), **{f"{k}_version": F.lit(v) for k, v in versions.items()}, **about})


def repository_state(folder: str = ".") -> tuple[str | None, bool | None]:
    """(commit, whether anything isn't committed) of a working copy; nulls where there is none."""
    run = lambda *a: subprocess.run(["git", "-C", folder, *a], capture_output=True, text=True, check=True).stdout.strip()
    try:
        return run("rev-parse", "HEAD"), bool(run("status", "--porcelain"))
    except (subprocess.CalledProcessError, FileNotFoundError):
        return None, None
