"""A study of appeals: which rulings enter, how they are drawn, and the sheet on which people review what was read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.functions.casenum import year_of
from foliant.functions.ruling import DISPUTED, KEPT_POINT
from foliant.operators.responses import canonical_url
from foliant.operators.tables import PERIODS, SEED_STUDY, numbered, period_of, plan_sample, quota_sample

# The type that is studied (the whole value, never a part of one), the quota per period, the review plan and its sheet.
KIND = "Apelación de Sentencia de Amparo"
PER_PERIOD = 500
PLAN = {"mantiene": 40, "altera_regla_discutida": 30, "altera_otras_reglas": 30}
HUMAN_COLUMNS = ("VEREDICTO_HUMANO_altera_mantiene_otro", "VEREDICTO_CONTROLADO_altera_mantiene_no_aplica", "NOTA")
EARLIER_COLUMN = "veredicto_maquina_previo_2026-08-30"
SHEET = ("n", "expediente", "anio", "url_del_documento", *HUMAN_COLUMNS, "lo_que_leyo_la_maquina", "regla_que_disparo", "veredicto_maquina", EARLIER_COLUMN, "estrato", "id")


def in_years(df: DataFrame, year: str, since: int, until: int) -> DataFrame:
    """Rows of a window of years, both ends included; rows without a year are outside."""
    return df.where(F.col(year).between(since, until))


def eligible(cards: DataFrame, census: DataFrame, kind: str = KIND, periods: list[tuple[str, int, int]] = PERIODS) -> DataFrame:
    """Cards of one type whose document can be had, with its address and their period.

    ``cards (id, kind, year, ...)``, ``census (id, pdf)``: an inner join on the id; cards without a
    PDF and years outside all periods go. Of several census rows with an id one address is taken (the greatest).
    """
    addresses = census.where(F.coalesce("pdf", F.lit("")) != "").groupBy("id").agg(F.max("pdf").alias("pdf"))
    rows = cards.where(F.col("kind") == kind).withColumn("period", period_of(F.col("year"), periods)).where("period is not null")
    return rows.join(addresses, "id")


def study_sample(cards: DataFrame, census: DataFrame, per_period: int = PER_PERIOD, seed: int = SEED_STUDY, kind: str = KIND, periods: list[tuple[str, int, int]] = PERIODS) -> DataFrame:
    """``per_period`` eligible cards of each period (all, where there are fewer), drawn by seed."""
    return quota_sample(eligible(cards, census, kind, periods), "id", "period", seed, per_period)


def stratum_of(effect: Column, rule: Column) -> Column:
    """Stratum of a decision for review: kept, altered by the disputed rule, altered otherwise; null for the rest."""
    return F.when(effect == "mantiene", "mantiene").when(effect == "altera", F.when(rule == DISPUTED, "altera_regla_discutida").otherwise("altera_otras_reglas"))


def document_year(stratum_year: Column, cases: Column, as_of_year: int) -> Column:
    """The year under which a document is stored: its stratum's if it was drawn, else that of its first case."""
    return F.coalesce(stratum_year.cast("int"), year_of(F.try_element_at(cases, F.lit(1)), as_of_year)["year"])


def with_address(decisions: DataFrame, census: DataFrame, hosts: list[str], host: str) -> DataFrame:
    """``decisions`` with ``url``, the canonical address of the census; blank where the census has none."""
    urls = census.where(F.coalesce("pdf", F.lit("")) != "").groupBy("id").agg(F.max("pdf").alias("pdf")).select("id", canonical_url(F.col("pdf"), hosts, host)["url"].alias("url"))
    return decisions.join(urls, "id", "left").withColumn("url", F.coalesce("url", F.lit("")))


def review_rows(decisions: DataFrame, census: DataFrame, hosts: list[str], host: str, seed: int = SEED_STUDY, plan: dict[str, int] = PLAN) -> DataFrame:
    """The review sheet: a sample by stratum in seeded order, numbered from 1, with the address first and people's columns blank.

    ``decisions (id, cases, year, effect, rule, point)``. As many rows as ``plan`` asks for at most.
    """
    drawn = plan_sample(decisions.withColumn("estrato", stratum_of(F.col("effect"), F.col("rule"))), "id", "estrato", seed, plan)
    rows = numbered(with_address(drawn, census, hosts, host), "id", seed)
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    blank = [F.lit("").alias(c) for c in HUMAN_COLUMNS]
    return rows.select(
        "n", text(F.try_element_at("cases", F.lit(1))).alias("expediente"), text(F.col("year")).alias("anio"), F.col("url").alias("url_del_documento"), *blank,
        F.substring(text(F.col("point")), 1, KEPT_POINT).alias("lo_que_leyo_la_maquina"), text(F.col("rule")).alias("regla_que_disparo"), text(F.col("effect")).alias("veredicto_maquina"), F.lit("").alias(EARLIER_COLUMN), "estrato", "id",
    )
