"""Indicators over decisions: rates of outcomes, stability, load, peers, confidence in the data, checks and review samples.

A rate never goes without its denominator, and an outlier is a signal to look at the cases, not a verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.functions.stats import wilson
from foliant.operators.store import dealt
from foliant.operators.tables import quota_sample


def latency(df: DataFrame, by: list[str], opened: str, closed: str) -> DataFrame:
    """n and days from ``opened`` to ``closed`` at the quartiles and the ninth decile; rows without both dates are counted apart."""
    days = F.datediff(closed, opened)
    r = df.groupBy(*by).agg(F.count(days).alias("n"), F.count_if(days.isNull()).alias("undated"), F.percentile(days, F.array(*[F.lit(x) for x in (0.25, 0.5, 0.75, 0.9)])).alias("p"))
    return r.select(*by, "n", "undated", *[F.col("p")[i].alias(f"p{q}") for i, q in enumerate((25, 50, 75, 90))])


def outcome_rates(df: DataFrame, by: list[str], outcome: str, outcomes: list[str]) -> DataFrame:
    """n and the share of each outcome among the rows that have one."""
    rows = df.where(F.col(outcome).isNotNull())
    return rows.groupBy(*by).agg(F.count("*").alias("n"), *[(F.count_if(F.col(outcome) == o) / F.count("*")).alias(f"{o}_rate") for o in outcomes])


def stability(df: DataFrame, by: list[str], effect: str) -> DataFrame:
    """Reviewed decisions, those kept, and the share of these with its interval."""
    r = df.where(F.col(effect).isin("mantiene", "altera")).groupBy(*by).agg(F.count("*").alias("reviewed"), F.count_if(F.col(effect) == "mantiene").alias("kept"))
    ci = wilson(F.col("kept"), F.col("reviewed"))
    return r.select(*by, "reviewed", "kept", (F.col("kept") / F.col("reviewed")).alias("rate"), ci["low"].alias("low"), ci["high"].alias("high"))


def load(df: DataFrame, opened: str, closed: str, unit: str = "month") -> DataFrame:
    """(period, filed, decided, backlog): what came, what went, and what is open at each period's end.

    The running sum is over one row per period (some thousands at most); rows are added up before.
    """
    step = lambda c, sign: df.where(F.col(c).isNotNull()).groupBy(F.date_trunc(unit, c).cast("date").alias("period")).agg(F.count("*").alias("n")).select("period", F.lit(sign).alias("sign"), "n")
    total = lambda sign: F.sum(F.when(F.col("sign") == sign, F.col("n")).otherwise(0))
    per = step(opened, 1).unionAll(step(closed, -1)).groupBy("period").agg(total(1).alias("filed"), total(-1).alias("decided"))
    return per.withColumn("backlog", F.sum(F.col("filed") - F.col("decided")).over(Window.orderBy("period")))


def peers(df: DataFrame, unit: str, group: str, hit: Column, id_col: str, least: int = 30, cases: int = 20) -> DataFrame:
    """Units against the rest of their peer group: n, rate, baseline, difference, interval, signal and example cases.

    ``signal`` is null below ``least`` rows, else whether the unit's interval leaves out the
    group's rate. The examples (least ids first) are a report, bounded by ``cases``.
    """
    rows = df.select(F.col(unit).alias("unit"), F.col(group).alias("peer_group"), hit.cast("int").alias("hit"), F.col(id_col).alias("id")).where("hit is not null")
    per = rows.groupBy("peer_group", "unit").agg(F.count("*").alias("n"), F.sum("hit").alias("k"))
    base = per.groupBy("peer_group").agg(F.sum("n").alias("group_n"), F.sum("k").alias("group_k"))
    j = per.join(base, "peer_group")
    ci = wilson(F.col("k"), F.col("n"))
    baseline = F.col("group_k") / F.col("group_n")
    signal = F.when(F.col("n") >= least, (baseline < ci["low"]) | (baseline > ci["high"]))
    out = j.select("peer_group", "unit", "n", "k", (F.col("k") / F.col("n")).alias("rate"), baseline.alias("baseline"), (F.col("k") / F.col("n") - baseline).alias("difference"), ci["low"].alias("low"), ci["high"].alias("high"), signal.alias("signal"))
    flagged = rows.where("hit = 1").join(out.where("signal").select("peer_group", "unit"), ["peer_group", "unit"])
    return out.join(_least_ids(flagged, ["peer_group", "unit"], "id", cases), ["peer_group", "unit"], "left")


def _least_ids(df: DataFrame, by: list[str], id_col: str, k: int) -> DataFrame:
    """(by, cases): the k least ids of each group, first within 64 salted parts, so no task holds a whole group."""
    part = df.groupBy(*by, F.pmod(F.xxhash64(id_col), F.lit(64)).alias("salt"))
    slim = part.agg(F.slice(F.array_sort(F.collect_set(id_col)), 1, k).alias("ids"))
    return slim.select(*by, F.explode("ids").alias("id")).groupBy(*by).agg(F.slice(F.array_sort(F.collect_set("id")), 1, k).alias("cases"))


def data_confidence(*flags: Column) -> Column:
    """Share of conditions that hold, 0 to 1; a null condition doesn't hold."""
    return sum((F.coalesce(f, F.lit(False)).cast("double") for f in flags), F.lit(0.0)) / len(flags)


def consistency(filed: Column, decided: Column, case: Column) -> Column:
    """Names of the checks that fail: order of dates, form of the case number; what is missing isn't judged."""
    return F.array_compact(F.array(F.when(decided < filed, F.lit("resuelto antes de presentado")), F.when(~case.rlike(r"^\s*[0-9]+-([0-9]{2}|[0-9]{4})\s*$"), F.lit("numero con otra forma"))))


def out_of_office(decisions: DataFrame, terms: DataFrame, id_col: str, court: str, decided: str, signers: str) -> DataFrame:
    """(id, incompatible, unknown): who signed a decision of a court on a day without being assigned to it then.

    ``terms (name, court, since, until)``: ``until`` is the last day, null while a term lasts. A name with
    no term in any court is ``unknown``, and so are all names of a decision without court or day: what
    isn't known isn't judged. Decisions without signers have no row. A name has few
    terms, so decisions that share a much-signing name are joined with these and not with each other.
    """
    one = decisions.select(F.col(id_col).alias("id"), F.col(court).alias("__court"), F.col(decided).cast("date").alias("__day"), F.explode(F.array_distinct(signers)).alias("name")).where("name is not null")
    spans = terms.where("name is not null").groupBy("name").agg(F.collect_set(F.struct("court", F.col("since").cast("date").alias("since"), F.coalesce(F.col("until").cast("date"), F.lit("9999-12-31").cast("date")).alias("until"))).alias("__terms"))
    met = dealt(one, "name", "id", spans)
    fits = F.exists("__terms", lambda x: (x["court"] == F.col("__court")) & F.col("__day").between(x["since"], x["until"]))
    judged = met.select("id", "name", F.when(F.col("__court").isNull() | F.col("__day").isNull(), "unknown").when(F.coalesce(fits, F.lit(False)), "fits").otherwise("incompatible").alias("__v"))
    absent = one.join(spans.select("name"), "name", "left_anti").select("id", "name", F.lit("unknown").alias("__v"))
    names = lambda v: F.array_sort(F.collect_set(F.when(F.col("__v") == v, F.col("name"))))
    return judged.unionAll(absent).groupBy("id").agg(names("incompatible").alias("incompatible"), names("unknown").alias("unknown")).withColumnRenamed("id", id_col)


def review_sample(df: DataFrame, key: str, seed: int, quota: int, reasons: dict[str, Column]) -> DataFrame:
    """At most ``quota`` rows for each reason to review, drawn by seed; a row may have several reasons. All rows are also due by "random"."""
    named = F.array_compact(F.array(F.lit("random"), *[F.when(c, F.lit(r)) for r, c in reasons.items()]))
    long = df.withColumn("reason", F.explode(named))
    return quota_sample(long, key, "reason", seed, quota)


def matched_difference(df: DataFrame, strata: list[str], treated: Column, hit: Column) -> DataFrame:
    """One row: rates of treated and others within strata that have both, weighted by the treated rows; n of both."""
    per = df.groupBy(*strata).agg(F.count_if(treated).alias("n1"), F.count_if(treated & hit).alias("k1"), F.count_if(~treated).alias("n0"), F.count_if(~treated & hit).alias("k0")).where("n1 > 0 and n0 > 0")
    w = F.col("n1")
    return per.agg(F.count("*").alias("strata"), F.sum("n1").alias("treated"), F.sum("n0").alias("others"), (F.sum("k1") / F.sum(w)).alias("treated_rate"), (F.sum(w * F.col("k0") / F.col("n0")) / F.sum(w)).alias("matched_rate"))


#: Pairs that one key may give; the rows of a key with more are named once each, as members of its group.
MOST_PAIRS = 10_000


def linked(left: DataFrame, right: DataFrame, id_left: str, id_right: str, signals: list[tuple[str, str, str]], most_pairs: int = MOST_PAIRS) -> DataFrame:
    """(id_left, id_right, signal, group_key): equi-joins by signals (name, left column, right column) in order of priority; a pair keeps its first.

    Blank and null values link nothing. A key that would give more than ``most_pairs`` pairs (a
    party with a million cases) isn't expanded: each of its rows is named once, with the key as
    ``group_key`` and the other side null; every left member is linked with every right one. Plain
    pairs have no ``group_key``.
    """
    pairs, groups = None, None
    for rank, (name, a, b) in enumerate(signals):
        # equal rows on either side are one before the join
        some = lambda df, c: df.where(F.coalesce(F.col(c).cast("string"), F.lit("")) != "")
        l = some(left, a).select(F.col(id_left).alias("a"), F.col(a).alias("__k")).distinct()  # noqa: E741
        r = some(right, b).select(F.col(id_right).alias("b"), F.col(b).alias("__k")).distinct()
        sizes = l.groupBy("__k").agg(F.count("*").alias("__l")).join(r.groupBy("__k").agg(F.count("*").alias("__r")), "__k")
        large = sizes.where(F.col("__l") * F.col("__r") > most_pairs).select("__k")  # few: each has some hundred rows at least
        signal = F.struct(F.lit(rank).alias("rank"), F.lit(name).alias("name")).alias("s")
        hits = l.join(large, "__k", "left_anti").join(r, "__k").where("a <> b").select("a", "b", signal)
        of = lambda side, other: side.join(large, "__k", "left_semi").select(*[(F.col(x) if x in side.columns else F.lit(None).cast(dict(other.dtypes)[x])).alias(x) for x in ("a", "b")], F.lit(name).alias("name"), F.col("__k").cast("string").alias("group_key"))
        members = of(l, r).unionAll(of(r, l))
        pairs = hits if pairs is None else pairs.unionAll(hits)
        groups = members if groups is None else groups.unionAll(members)
    first = pairs.groupBy("a", "b").agg(F.min("s").alias("s")).select("a", "b", "s.name", F.lit(None).cast("string").alias("group_key"))
    return first.unionAll(groups).select(F.col("a").alias(id_left), F.col("b").alias(id_right if id_right != id_left else f"linked_{id_right}"), F.col("name").alias("signal"), "group_key")
