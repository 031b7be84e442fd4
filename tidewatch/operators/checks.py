"""Quality of a batch: rules of six categories, measured in one pass over the rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CATEGORIES = ("completeness", "validity", "enrichment", "temporal", "distribution", "consistency")


@dataclass(frozen=True)
class Rule:
    """A measure of all rows that must stay at or under ``most``, or at or over ``least``; skipped below ``rows`` rows."""

    category: str
    name: str
    measure: Column
    most: float | None = None
    least: float | None = None
    severity: str = "fail"
    rows: int = 1


def share_of(bad: Column) -> Column:
    """Share of rows for which a condition holds; null does not hold."""
    return F.try_divide(F.count_if(F.coalesce(bad, F.lit(False))), F.count("*"))


def required(*columns: str, most: float = 0.0, severity: str = "fail") -> list[Rule]:
    """Null or blank values."""
    return [Rule("completeness", f"{c}_present", share_of(F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")), most=most, severity=severity) for c in columns]


def accepted(column: str, values: Sequence) -> Rule:
    return Rule("validity", f"{column}_accepted", share_of(~F.col(column).isin(*values)), most=0.0)


def between(column: str, low: float, high: float) -> Rule:
    return Rule("validity", f"{column}_range", share_of(~F.col(column).between(low, high)), most=0.0)


def covered(name: str, has: Column, least: float, rows: int = 20) -> Rule:
    return Rule("enrichment", f"{name}_coverage", share_of(has), least=least, severity="warn", rows=rows)


def not_before(column: str, cutoff: Column) -> Rule:
    return Rule("temporal", f"{column}_cutoff", share_of(F.col(column) < cutoff), most=0.0)


def spread(column: str, least: float, rows: int = 100) -> Rule:
    """A score that hardly varies is a sign of a default."""
    return Rule("distribution", f"{column}_spread", F.stddev_samp(column), least=least, severity="warn", rows=rows)


def agrees(name: str, condition: Column) -> Rule:
    return Rule("consistency", name, share_of(~condition), most=0.0)


def batch_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """A row for each rule: category, check, n_rows, actual, status (PASS, WARN, FAIL, SKIP). All measures come from one aggregation."""
    measured = df.agg(F.count("*").alias("n_rows"), *[r.measure.cast("double").alias(f"m{k}") for k, r in enumerate(rules)])
    rows = []
    for k, r in enumerate(rules):
        value = F.col(f"m{k}")
        bad = (value > r.most) if r.most is not None else (value < r.least)
        status = F.when((F.col("n_rows") < r.rows) | value.isNull(), "SKIP").when(bad, r.severity.upper()).otherwise("PASS")
        rows.append(F.struct(F.lit(r.category).alias("category"), F.lit(r.name).alias("check"), F.col("n_rows"), F.round(value, 6).alias("actual"), status.alias("status")))
    return measured.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def batch_status(report: DataFrame) -> DataFrame:
    """The whole batch in one row: FAIL over WARN over PASS, and the share of checks that passed of those that were not skipped."""
    n = lambda s: F.count_if(F.col("status") == s)
    ran = F.count_if(F.col("status") != "SKIP")
    return report.agg(F.when(n("FAIL") > 0, "FAIL").when(n("WARN") > 0, "WARN").otherwise("PASS").alias("status"), F.round(n("PASS") / F.nullif(ran, F.lit(0)), 6).alias("pass_rate"), n("SKIP").alias("n_skipped"))
