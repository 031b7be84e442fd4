"""Data-quality checks: named functions of the tables that return violations, and a report over them."""

from __future__ import annotations

from dataclasses import dataclass
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bindings import AS_OF, Tables
from .marts import ORACLES, query


@dataclass(frozen=True)
class Check:
    name: str
    severity: str
    violations: Callable[[Tables], DataFrame]
    sql: str


CHECKS: list[Check] = []


def _add(name: str, severity: str, violations: Callable[[Tables], DataFrame], sql: str) -> None:
    """A check with the SQL of its violations."""
    CHECKS.append(Check(name, severity, violations, sql))


def not_null(table: str, *columns: str) -> None:
    for c in columns:
        _add(f"not_null_{table}_{c}", "error", lambda t, c=c: t(table).where(F.col(c).isNull()).select(c), f"SELECT {c} FROM {table} WHERE {c} IS NULL")


def unique(table: str, *columns: str) -> None:
    _add(f"unique_{table}_{'_'.join(columns)}", "error", lambda t: t(table).groupBy(*columns).count().where("count > 1"), f"SELECT {', '.join(columns)} FROM {table} GROUP BY ALL HAVING COUNT(*) > 1")


def accepted(table: str, column: str, values: tuple) -> None:
    _add(f"accepted_{table}_{column}", "error", lambda t: t(table).where(~F.col(column).isin(*values)).select(column), f"SELECT {column} FROM {table} WHERE {column} NOT IN ({', '.join(repr(v) for v in values)})")


def relationship(table: str, column: str, to: str, key: str) -> None:
    _add(f"relationship_{table}_{column}", "error", lambda t: t(table).select(column).where(F.col(column).isNotNull()).join(t(to).select(F.col(key).alias(column)), column, "left_anti"), f"SELECT {column} FROM {table} WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {key} FROM {to} WHERE {key} IS NOT NULL)")


def holds(name: str, table: str, condition: str, severity: str = "error") -> None:
    other = condition.replace("get_json_object", "json_extract_string").replace("size(", "len(")
    _add(name, severity, lambda t: t(table).where(~F.expr(condition)), f"SELECT 1 FROM {table} WHERE NOT ({other})")


def share_at_most(name: str, table: str, bad: str, most: float, least_rows: int = 20, by: str | None = None) -> None:
    """Violated where the share of bad rows of a group (of all rows) is above the limit, given enough rows."""

    def run(t: Tables) -> DataFrame:
        return t(table).groupBy(*([by] if by else [])).agg(F.avg(F.expr(f"CASE WHEN {bad} THEN 1.0 ELSE 0.0 END")).alias("share"), F.count("*").alias("n")).where((F.col("n") >= least_rows) & (F.col("share") > most))

    _add(name, "warn", run, f"SELECT 1 FROM {table}{f' GROUP BY {by}' if by else ''} HAVING COUNT(*) >= {least_rows} AND avg(CASE WHEN {bad} THEN 1.0 ELSE 0.0 END) > {most}")


def spread_at_least(name: str, table: str, column: str, least: float, least_rows: int = 100) -> None:
    _add(name, "warn", lambda t: t(table).agg(F.stddev_samp(column).alias("spread"), F.count("*").alias("n")).where((F.col("n") >= least_rows) & (F.col("spread") < least)), f"SELECT 1 FROM {table} HAVING COUNT(*) >= {least_rows} AND stddev_samp({column}) < {least}")


for table, columns in {"events": ("event_id", "ts", "user_id", "event_type"), "documents": ("doc_id", "text"), "customer": ("c_custkey",), "orders": ("o_orderkey", "o_orderdate"), "lineitem": ("l_orderkey",), "pages": ("url",), "embeddings": ("embedding",)}.items():
    not_null(table, *columns)
for table, key in {"events": "event_id", "documents": "doc_id", "customer": "c_custkey", "orders": "o_orderkey", "nation": "n_nationkey", "region": "r_regionkey", "supplier": "s_suppkey", "part": "p_partkey", "pages": "url", "embeddings": "vec_id"}.items():
    unique(table, key)
unique("lineitem", "l_orderkey", "l_linenumber")
unique("conversations", "conv_id", "turn")
accepted("events", "event_type", ("signup", "purchase", "error", "click", "view"))
accepted("conversations", "role", ("user", "assistant", "system"))
accepted("labels", "toxic", (0, 1))
relationship("lineitem", "l_orderkey", "orders", "o_orderkey")
relationship("orders", "o_custkey", "customer", "c_custkey")
relationship("customer", "c_nationkey", "nation", "n_nationkey")
relationship("nation", "n_regionkey", "region", "r_regionkey")
relationship("labels", "doc_id", "documents", "doc_id")
holds("score_range_event_value", "events", "value BETWEEN 0 AND 500")
holds("no_future_events", "events", f"ts <= TIMESTAMP '{AS_OF} 23:59:59' + INTERVAL 1 HOUR")
holds("temporal_cutoff", "events", "ts >= TIMESTAMP '2024-01-01'")
holds("length_matches_text", "documents", "n_chars = length(text)", "warn")
holds("discount_range", "lineitem", "l_discount BETWEEN 0 AND 1")
holds("event_json_has_key", "events", "get_json_object(props, '$.k') IS NOT NULL")
holds("embedding_dimension", "embeddings", "size(embedding) = 64")
holds("order_total_positive", "orders", "o_totalprice > 0", "warn")
share_at_most("coverage_of_long_texts", "documents", "n_chars < 100", 0.5, by="source")
share_at_most("error_rate", "events", "event_type = 'error'", 0.3)
spread_at_least("distribution_event_value", "events", "value", 0.10)
spread_at_least("distribution_discount", "lineitem", "l_discount", 0.01)
_add("one_first_turn_per_conversation", "error", lambda t: t("conversations").groupBy("conv_id").agg(F.count_if(F.col("turn") == 0).alias("n")).where("n != 1"), "SELECT conv_id FROM conversations GROUP BY 1 HAVING COUNT(*) FILTER (WHERE turn = 0) <> 1")
_add("silent_event_type", "warn", lambda t: t("events").groupBy("event_type").agg(F.max("ts").alias("last")).where(F.col("last") < F.lit(AS_OF).cast("timestamp") - F.expr("interval 24 hours")), f"SELECT event_type FROM events GROUP BY 1 HAVING max(ts) < TIMESTAMP '{AS_OF} 00:00:00' - INTERVAL 24 HOUR")
_add("pair_bijection", "error", lambda t: _pairs(t).groupBy("id_b").count().where("count > 1"), f"SELECT id_b FROM ({ORACLES['int_cross_post_pairs']}) GROUP BY 1 HAVING COUNT(*) > 1")
_add("pair_window", "error", lambda t: _pairs(t).where("delta_seconds > 3600"), f"SELECT id_b FROM ({ORACLES['int_cross_post_pairs']}) WHERE delta_seconds > 3600")
_add("anomaly_needs_three", "error", lambda t: _anomalies(t).where("is_anomaly and n < 3"), f"SELECT day FROM ({ORACLES['mart_anomalies_daily']}) WHERE is_anomaly AND n < 3")
_add("current_row_per_person", "error", lambda t: _history(t).where("is_current").groupBy("person_id").count().where("count > 1"), f"SELECT person_id FROM ({ORACLES['dim_persons_scd2']}) WHERE is_current GROUP BY 1 HAVING COUNT(*) > 1")
_add("closed_rows_end_after_start", "error", lambda t: _history(t).where("valid_to <= valid_from"), f"SELECT person_id FROM ({ORACLES['dim_persons_scd2']}) WHERE valid_to <= valid_from")


def _pairs(t: Tables) -> DataFrame:
    from .marts import int_cross_post_pairs

    return int_cross_post_pairs(t)


def _anomalies(t: Tables) -> DataFrame:
    from .marts import mart_anomalies_daily

    return mart_anomalies_daily(t)


def _history(t: Tables) -> DataFrame:
    from .marts import dim_persons_scd2

    return dim_persons_scd2(t)


def report(t: Tables, checks: list[Check] | None = None) -> DataFrame:
    """One row a check: check, severity, violations, status. Checks run as one union of counts."""
    rows = [c.violations(t).agg(F.count("*").alias("violations")).select(F.lit(c.name).alias("check"), F.lit(c.severity).alias("severity"), "violations") for c in checks or CHECKS]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    status: Column = F.when(F.col("violations") == 0, "PASS").when(F.col("severity") == "warn", "WARN").otherwise("FAIL")
    return out.withColumn("status", status)


def _report_sql() -> str:
    rows = " UNION ALL ".join(f"SELECT '{c.name}' AS \"check\", '{c.severity}' AS severity, COUNT(*) AS violations FROM ({c.sql})" for c in CHECKS)
    return f"SELECT *, CASE WHEN violations = 0 THEN 'PASS' WHEN severity = 'warn' THEN 'WARN' ELSE 'FAIL' END AS status FROM ({rows})"


@query(_report_sql())
def quality_report(t: Tables) -> DataFrame:
    return report(t)


@query("""SELECT 'relationship_lineitem_l_orderkey' AS "check", COUNT(*) AS violations FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
  UNION ALL SELECT 'relationship_orders_o_custkey', COUNT(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
  UNION ALL SELECT 'unique_lineitem_l_orderkey_l_linenumber', COUNT(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1)
  UNION ALL SELECT 'length_matches_text', COUNT(*) FROM documents WHERE n_chars <> length(text)
  UNION ALL SELECT 'score_range_event_value', COUNT(*) FROM events WHERE NOT value BETWEEN 0 AND 500""")
def quality_core(t: Tables) -> DataFrame:
    named = ("relationship_lineitem_l_orderkey", "relationship_orders_o_custkey", "unique_lineitem_l_orderkey_l_linenumber", "length_matches_text", "score_range_event_value")
    return report(t, [c for c in CHECKS if c.name in named]).select("check", "violations")


_BATCH = """m AS (SELECT COUNT(*) AS n, avg((d.text IS NULL OR trim(d.text) = '')::INT) AS no_text, avg((d.lang IS NULL OR trim(d.lang) = '')::INT) AS no_lang, avg(coalesce(d.lang NOT IN ('en', 'fr', 'de'), FALSE)::INT) AS odd_lang, avg((NOT n_chars BETWEEN 1 AND 1000000)::INT) AS odd_length,
  avg((l.quality IS NOT NULL)::INT) AS labelled, avg((d.doc_id < 10)::INT) AS early, stddev_samp(n_chars) AS spread, avg((n_chars <> length(d.text))::INT) AS unequal FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY 1) l USING (doc_id)),
  r AS (SELECT unnest([{'category': 'completeness', 'check': 'text_present', 'actual': no_text, 'bad': no_text > 0, 'how': 'FAIL'}, {'category': 'completeness', 'check': 'lang_present', 'actual': no_lang, 'bad': no_lang > 0, 'how': 'FAIL'}, {'category': 'validity', 'check': 'lang_accepted', 'actual': odd_lang, 'bad': odd_lang > 0, 'how': 'FAIL'},
    {'category': 'validity', 'check': 'n_chars_range', 'actual': odd_length, 'bad': odd_length > 0, 'how': 'FAIL'}, {'category': 'enrichment', 'check': 'quality_coverage', 'actual': labelled, 'bad': labelled < 0.5, 'how': 'WARN'}, {'category': 'temporal', 'check': 'doc_id_cutoff', 'actual': early, 'bad': early > 0, 'how': 'FAIL'},
    {'category': 'distribution', 'check': 'n_chars_spread', 'actual': spread, 'bad': spread < 0.1, 'how': 'WARN'}, {'category': 'consistency', 'check': 'length_matches_text', 'actual': unequal, 'bad': unequal > 0, 'how': 'FAIL'}]) AS c, n FROM m),
  report AS (SELECT c.category, c."check", n AS n_rows, round(c.actual, 4)::DOUBLE AS actual, CASE WHEN c.bad THEN c.how ELSE 'PASS' END AS status FROM r)"""


def _batch(t: Tables) -> DataFrame:
    from ..operators import checks

    known = t("labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    rows = t("documents").join(known, "doc_id", "left")
    rules = [*checks.required("text", "lang"), checks.accepted("lang", ("en", "fr", "de")), checks.between("n_chars", 1, 1_000_000), checks.covered("quality", F.col("quality").isNotNull(), 0.5), checks.not_before("doc_id", F.lit(10)), checks.spread("n_chars", 0.1), checks.agrees("length_matches_text", F.col("n_chars") == F.length("text"))]
    return checks.batch_report(rows, rules)


@query(f"WITH {_BATCH} SELECT * FROM report")
def batch_quality(t: Tables) -> DataFrame:
    return _batch(t).withColumn("actual", F.round("actual", 4))


@query(f"WITH {_BATCH} SELECT CASE WHEN bool_or(status = 'FAIL') THEN 'FAIL' WHEN bool_or(status = 'WARN') THEN 'WARN' ELSE 'PASS' END AS status, round(avg((status = 'PASS')::INT), 6)::DOUBLE AS pass_rate, COUNT(*) FILTER (WHERE status = 'SKIP') AS n_skipped FROM report")
def batch_quality_status(t: Tables) -> DataFrame:
    from ..operators import checks

    return checks.batch_status(_batch(t))
