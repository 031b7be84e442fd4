"""Staging, gold, serving and extraction models that are plain SQL, written once for Spark and for the SQL they must agree with.

The reference models of this layer are SELECT statements, so they are kept as such and Catalyst
plans them. Where the two dialects differ a marker in double brackets stands for both.
"""

from __future__ import annotations

import re
from collections.abc import Container

from pyspark.sql import DataFrame

from ..components import discard, free_shuffles, scratch
from ..operators import graph
from .bindings import AS_OF, Tables
from .marts import ORACLES, QUERIES

#: Markers: name, and what it stands for in Spark and in the SQL of the comparison; {0}, {1} are its arguments.
MARKERS = {
    "k": ("CAST(get_json_object(props, '$.k') AS BIGINT)", "CAST(json_extract_string(props, '$.k') AS BIGINT)"),
    "days": ("datediff({1}, {0})", "date_diff('day', {0}, {1})"),
    "set": ("sort_array(collect_set({0}))", "list_sort(list(DISTINCT {0}))"),
    "list": ("sort_array(collect_list({0}))", "list_sort(list({0}))"),
    "array": ("array({0}, {1})", "list_value({0}, {1})"),
    "array1": ("array({0})", "list_value({0})"),
    "explode": ("explode({0})", "unnest({0})"),
    "size": ("size({0})", "len({0})"),
    "month_name": ("date_format({0}, 'MMMM')", "strftime({0}, '%B')"),
    "day_name": ("date_format({0}, 'EEEE')", "strftime({0}, '%A')"),
    "double": ("CAST({0} AS DOUBLE)", "CAST({0} AS DOUBLE)"),
    "days_of_month": ("explode(sequence(DATE '2024-01-01', DATE '2024-12-31', INTERVAL 1 DAY))", "unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-12-31', INTERVAL 1 DAY))"),
    "quantile": ("percentile({0}, {1})", "quantile_cont({0}, {1})"),
    "hash": ("sha2({0}, 256)", "sha256({0})"),
    "json_items": ("explode(from_json({0}, 'array<string>'))", "unnest(from_json({0}, '[\"VARCHAR\"]'))"),
    "concat": ("concat({0}, {1})", "list_concat({0}, {1})"),
    "dims": ("size(embedding)", "len(embedding)"),
    "exact": ("CAST(SUM(CAST({0} AS DECIMAL(18,4))) AS DOUBLE)", "CAST(SUM(CAST({0} AS DECIMAL(18,4))) AS DOUBLE)"),
}

BASE = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

#: Frames that several models start from.
FRAMES = {
    "ev": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts DESC, user_id NULLS FIRST, event_type NULLS FIRST, value NULLS FIRST, props NULLS FIRST) AS rn FROM events) x WHERE rn = 1",
    "silver": "SELECT event_id, ts, user_id, event_type, value, [[k]] AS topic, value >= 50 AS in_scope, CASE WHEN value >= 250 THEN 'ALERT' WHEN value >= 100 THEN 'WARNING' ELSE 'FAVORABLE' END AS label, round(value / 500, 6) AS confidence FROM ev",
    "articles": "SELECT d.doc_id, d.source, d.lang, d.text, d.n_chars, l.quality, l.toxic, DATE '2024-01-01' + CAST(d.doc_id % 30 AS INT) AS published_on FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id",
    "people": "SELECT c_custkey AS person_id, c_name AS person_name, c_mktsegment AS person_group, c_nationkey AS place_id FROM customer",
    "gold": """SELECT 'rss:' || CAST(doc_id AS STRING) AS gold_id, 'rss' AS source_type, published_on, a.doc_id AS person_id, person_name, person_group, CAST(NULL AS STRING) AS label, CAST(NULL AS DOUBLE) AS confidence, CAST(n_chars AS DOUBLE) AS engagement FROM articles a LEFT JOIN people p ON p.person_id = a.doc_id WHERE quality = 1
      UNION ALL SELECT 'social:' || CAST(event_id AS STRING), 'social', CAST(ts AS DATE), user_id, person_name, person_group, label, confidence, value FROM silver s LEFT JOIN people p ON p.person_id = s.user_id WHERE in_scope""",
    "series": "SELECT tenant, algorithm, day, series, members, run_at FROM (SELECT user_id % 4 AS tenant, event_type AS algorithm, CAST(ts AS DATE) AS day, [[k]] % 20 AS series, value AS members, ts AS run_at, row_number() OVER (PARTITION BY user_id % 4, event_type, CAST(ts AS DATE), [[k]] % 20 ORDER BY ts DESC, event_id DESC) AS rn FROM ev) x WHERE rn = 1",
    "scores": "SELECT tenant, algorithm, day, series, community, score, run_at FROM (SELECT user_id % 4 AS tenant, event_type AS algorithm, CAST(ts AS DATE) AS day, [[k]] % 20 AS series, user_id % 3 AS community, round(value / 500, 6) AS score, ts AS run_at, row_number() OVER (PARTITION BY user_id % 4, event_type, CAST(ts AS DATE), [[k]] % 20, user_id % 3 ORDER BY ts DESC, event_id DESC) AS rn FROM ev) x WHERE rn = 1",
    "topics": "SELECT topic % 10 AS topic_id, event_type AS topic_source, COUNT(*) AS n FROM silver GROUP BY topic % 10, event_type",
    "clusters": "SELECT label AS cluster, COUNT(*) AS size, min(vec_id) AS centroid_id FROM embeddings GROUP BY label",
}

MODELS: dict[str, str] = {
    # Staging: projections with their raw columns kept, and latest rows by grain.
    "stg_raw_articles": "SELECT doc_id, trim(source) AS source, lower(lang) AS lang, n_chars, [[hash:text]] AS text_sha256 FROM documents",
    "stg_article_stances": "SELECT doc_id, CASE WHEN toxic = 1 THEN 'against' WHEN quality = 1 THEN 'in_favor' ELSE 'neutral' END AS stance, quality IS NULL AS is_error FROM labels",
    "stg_mayor_endorsements": "SELECT conv_id, turn, lower(trim(role)) AS role, role AS role_raw, length(text) AS length FROM conversations",
    "stg_narrative_clusters": "SELECT vec_id, label AS cluster, label = 0 AS is_outlier FROM embeddings",
    "stg_narrative_embeddings": "SELECT vec_id, [[dims]] AS dimensions FROM embeddings",
    "stg_author_personas": "SELECT c_custkey AS persona_id, lower(trim(c_name)) AS author_id, c_name AS author_id_raw, lower(trim(c_mktsegment)) AS handle, c_mktsegment AS handle_raw FROM customer",
    "stg_author_communities": "SELECT user_id % 10 AS community_id, lower(trim(CAST(user_id AS STRING))) AS author_id, CAST(user_id AS STRING) AS author_id_raw, CAST(ts AS DATE) AS day FROM ev",
    "stg_event_shadow": """SELECT event_id, primary_severity, shadow_severity, shadow_severity - primary_severity AS severity_delta, primary_severity <> shadow_severity AS changed
      FROM (SELECT event_id, CASE label WHEN 'ALERT' THEN 2 WHEN 'WARNING' THEN 1 ELSE 0 END AS primary_severity, CASE WHEN value >= 200 THEN 2 WHEN value >= 120 THEN 1 ELSE 0 END AS shadow_severity FROM silver) x""",
    "stg_cluster_series": "SELECT * FROM series",
    "stg_community_scores": "SELECT * FROM scores",
    # Dimensions and facts.
    "dim_date_names": "SELECT CAST(d AS DATE) AS date_day, [[month_name:d]] AS month_name, [[day_name:d]] AS day_name FROM (SELECT [[days_of_month]] AS d) x",
    "vw_topic_ordinal": "SELECT topic_id, n FROM topics WHERE topic_source = 'click' AND topic_id >= 0",
    "fct_content_gold": "SELECT * FROM gold",
    "fct_events_engagement": """SELECT o_orderkey AS event_id, 1 + likes + 2 * comments + 3 * shares AS engagement_score, [[concat:[[array1:o_orderstatus]],[[array:o_orderpriority,c_mktsegment]]]] AS tags
      FROM (SELECT o_orderkey, o_orderstatus, o_orderpriority, c_mktsegment, COALESCE(likes, 0) AS likes, COALESCE(comments, 0) AS comments, COALESCE(shares, 0) AS shares FROM orders JOIN customer ON c_custkey = o_custkey
        LEFT JOIN (SELECT l_orderkey, COUNT(*) AS likes, CAST(SUM(l_quantity) AS BIGINT) AS comments, CAST(max(l_linenumber) AS BIGINT) AS shares FROM lineitem GROUP BY l_orderkey) x ON l_orderkey = o_orderkey) y""",
    "fct_article_stance_daily": "SELECT published_on AS day, CASE WHEN toxic = 1 THEN 'against' WHEN quality = 1 THEN 'in_favor' ELSE 'neutral' END AS stance, COUNT(*) AS n FROM articles WHERE quality IS NOT NULL GROUP BY 1, 2",
    "fct_author_persona_daily": "SELECT CAST(ts AS DATE) AS day, user_id % 50 AS persona_id, COUNT(DISTINCT event_type) AS n_platforms, [[set:event_type || ':' || CAST(user_id AS STRING)]] AS members FROM ev GROUP BY CAST(ts AS DATE), user_id % 50",
    "fct_community_score_daily": "SELECT day, community, tenant, algorithm, series, score, score >= 0.5 AS is_coordinated FROM scores",
    "fct_entity_sentiment_json": """SELECT event_id, entity, COUNT(*) AS mention_count, max(label) AS label FROM (SELECT event_id, [[json_items:entities]] AS entity FROM (SELECT event_id, '["' || event_type || '","' || label || '","' || event_type || '"]' AS entities FROM silver) x) y JOIN silver USING (event_id) GROUP BY event_id, entity""",
    "fct_coactivation_span": """SELECT day, author_a, author_b, n_shared, targets, min(ts) AS first_at, max(ts) AS last_at FROM (
        SELECT p.*, e.ts FROM pairs p JOIN acts e ON e.day = p.day AND e.author = p.author_a UNION ALL SELECT p.*, e.ts FROM pairs p JOIN acts e ON e.day = p.day AND e.author = p.author_b) x GROUP BY day, author_a, author_b, n_shared, targets""",
    "fct_tenant_buckets": "SELECT COALESCE(NULLIF(tenant_name, ''), 'all') AS tenant, COUNT(*) AS n FROM (SELECT CASE WHEN user_id % 3 = 0 THEN '' WHEN user_id % 3 = 1 THEN NULL ELSE event_type END AS tenant_name FROM ev) x GROUP BY 1",
    "mart_rule_version_shift": """SELECT day, n_a, n_b, round(mean_b - mean_a, 6) AS mean_shift FROM (SELECT CAST(ts AS DATE) AS day, SUM(CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END) AS n_a, SUM(CASE WHEN event_id % 2 = 1 THEN 1 ELSE 0 END) AS n_b,
        [[exact:CASE WHEN event_id % 2 = 0 THEN value END]] / NULLIF(SUM(CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END), 0) AS mean_a, [[exact:CASE WHEN event_id % 2 = 1 THEN value END]] / NULLIF(SUM(CASE WHEN event_id % 2 = 1 THEN 1 ELSE 0 END), 0) AS mean_b FROM ev GROUP BY CAST(ts AS DATE)) x""",
    # Serving.
    "candidates_engagement": "SELECT user_id AS person_id, COUNT(DISTINCT event_type) AS platforms, COUNT(*) AS posts, [[exact:value]] AS engagement, round([[exact:value]] / COUNT(*), 6) AS per_post FROM ev GROUP BY user_id",
    "candidates_endorsements": "SELECT conv_id, role, turn, length(text) AS length FROM conversations WHERE role = 'assistant' ORDER BY conv_id, turn",
    "coverage_platforms": "SELECT family, p.platform, COUNT(event_id) AS n FROM (SELECT 'view' AS platform, 'web' AS family UNION ALL SELECT 'click', 'web' UNION ALL SELECT 'purchase', 'app' UNION ALL SELECT 'fax', 'none') p LEFT JOIN ev ON event_type = p.platform GROUP BY family, p.platform",
    "alert_topics": "SELECT t.topic_id, t.topic_source, COUNT(*) AS n, round([[exact:confidence]] / COUNT(*), 6) AS avg_confidence FROM silver s JOIN topics t ON t.topic_id = s.topic % 10 AND t.topic_source = 'click' WHERE s.label = 'ALERT' GROUP BY t.topic_id, t.topic_source ORDER BY n DESC, t.topic_id LIMIT 15",
    "alert_coordinated_clusters": "SELECT s.tenant, s.algorithm, s.day, s.series, c.community, c.score, s.members FROM scores c JOIN series s ON s.tenant = c.tenant AND s.algorithm = c.algorithm AND s.day = c.day AND s.series = c.series WHERE c.score >= 0.4 AND s.members >= 10 ORDER BY c.score DESC, s.day DESC, s.tenant, s.algorithm, s.series, c.community LIMIT 10",
    "narratives_clusters": "SELECT cluster, size, centroid_id, substring(text, 1, 60) AS title FROM clusters LEFT JOIN documents ON doc_id = centroid_id",
    "narratives_recent": "SELECT doc_id, source, published_on, substring(text, 1, 40) AS title FROM articles ORDER BY published_on DESC, doc_id LIMIT 30",
    "feed_daily_volume": "SELECT published_on, source, COUNT(*) AS n, SUM(CASE WHEN n_chars < 200 THEN 1 ELSE 0 END) AS n_short FROM articles GROUP BY published_on, source",
    "freshness_levels": f"SELECT tracked, hours, CASE WHEN hours > 49 THEN 'error' WHEN hours > 25 THEN 'warn' ELSE 'pass' END AS level FROM (SELECT event_type AS tracked, 24 * [[days:CAST(max(ts) AS DATE),DATE '{AS_OF}']] AS hours FROM events GROUP BY event_type) x",
    # Extraction for jobs.
    "job_activations": f"SELECT event_id, user_id AS author, [[k]] AS target, ts FROM ev WHERE ts >= TIMESTAMP '{AS_OF} 00:00:00' - INTERVAL 7 DAY AND user_id IS NOT NULL",
    "job_personas": "SELECT c_custkey AS author_key, 'customer' AS platform, lower(c_name) AS handle FROM customer UNION ALL SELECT s_suppkey, 'supplier', lower(s_name) FROM supplier",
    "job_embeddings": "SELECT e.vec_id FROM embeddings e LEFT JOIN (SELECT doc_id FROM documents WHERE doc_id % 2 = 0) c ON c.doc_id = e.vec_id WHERE c.doc_id IS NULL",
    "job_narrative_source": "SELECT doc_id, published_on, substring(text, 1, 200) AS body FROM articles WHERE quality = 1 AND length(text) >= 200",
    "job_endorsement_bundles": f"""SELECT person_id, event_id, tag, position FROM (SELECT user_id AS person_id, event_id, [[explode:[[array:event_type,label]]]] AS tag, position FROM (SELECT user_id, event_id, event_type, label, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS position FROM silver
      WHERE ts >= TIMESTAMP '{AS_OF} 00:00:00' - INTERVAL 90 DAY AND user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')) x WHERE position <= 12) y""",
    "temporal_update": "SELECT event_id, CASE WHEN ts < TIMESTAMP '2024-01-05 00:00:00' THEN TIMESTAMP '2024-01-05 00:00:00' ELSE ts END AS ts, ts < TIMESTAMP '2024-01-05 00:00:00' AS changed FROM ev WHERE event_type <> 'error'",
    "recent_ids": f"SELECT DISTINCT user_id FROM events WHERE ts > TIMESTAMP '{AS_OF} 00:00:00' - INTERVAL 6 HOUR",
    "backfill_labels": "SELECT event_id, COALESCE(given, label) AS label, given IS NULL AS filled FROM (SELECT event_id, label, CASE WHEN event_id % 5 = 0 THEN NULL ELSE label END AS given FROM silver) x",
    # Scoring inputs and evaluation.
    "classifier_inputs": "SELECT event_id, COUNT(*) OVER (PARTITION BY user_id) AS volume, CAST(floor(value) AS BIGINT) AS engagement, [[double:least(COUNT(*) OVER (PARTITION BY user_id) / 10.0, 1.0)]] AS velocity FROM ev",
    "fetch_latencies": "SELECT event_type AS source, COUNT(*) AS n, round([[quantile:value,0.5]], 6) AS p50, round([[quantile:value,0.95]], 6) AS p95, round([[double:SUM(CASE WHEN value > 250 THEN 1 ELSE 0 END)]] / COUNT(*), 6) AS failure_rate FROM ev GROUP BY event_type",
    "evaluation_overall": """SELECT round(avg(f1), 6) AS macro_f1, round(max(accuracy), 6) AS accuracy FROM (SELECT truth, [[double:2.0 * max(hits) / (max(support) + max(guessed))]] AS f1, max(accuracy) AS accuracy FROM (
        SELECT c.truth, SUM(CASE WHEN j.quality = c.truth THEN 1 ELSE 0 END) AS support, SUM(CASE WHEN j.guess = c.truth THEN 1 ELSE 0 END) AS guessed, SUM(CASE WHEN j.guess = c.truth AND j.quality = c.truth THEN 1 ELSE 0 END) AS hits, [[double:SUM(CASE WHEN j.guess = j.quality THEN 1 ELSE 0 END) * 1.0 / COUNT(*)]] AS accuracy
        FROM (SELECT quality, CASE WHEN n_chars >= 1500 THEN 1 ELSE 0 END AS guess FROM articles WHERE quality IS NOT NULL) j CROSS JOIN (SELECT 0 AS truth UNION ALL SELECT 1) c GROUP BY c.truth) x GROUP BY truth) y""",
}

FRAMES |= {
    "acts": "SELECT DISTINCT CAST(ts AS DATE) AS day, user_id AS author, [[k]] AS target, ts FROM events",
    "days": "SELECT DISTINCT day, author, target FROM acts",
    "pairs": "SELECT a.day, a.author AS author_a, b.author AS author_b, COUNT(*) AS n_shared, [[list:a.target]] AS targets FROM days a JOIN days b ON a.day = b.day AND a.target = b.target AND a.author < b.author GROUP BY a.day, a.author, b.author",
}

#: Assertions: name, severity, rows that a violation is sought in (none: skipped), and the violations as a SELECT.
ASSERTIONS = (
    ("completeness_ids_dates", "error", "gold", "SELECT CASE WHEN gold_id IS NULL THEN 'id' ELSE 'date' END AS missing FROM gold WHERE gold_id IS NULL OR published_on IS NULL"),
    ("consistency_inscope_person_id", "error", "silver", "SELECT event_id FROM silver WHERE in_scope AND user_id IS NULL"),
    ("distribution_confidence", "warn", "silver", "SELECT 1 AS x FROM silver HAVING COUNT(*) >= 100 AND stddev_samp(confidence) < 0.024"),
    ("distribution_engagement", "warn", "gold", "SELECT 1 AS x FROM gold HAVING COUNT(*) >= 100 AND stddev_samp(engagement) < 0.10"),
    ("enrichment_person_coverage", "warn", "gold", "SELECT source_type FROM gold GROUP BY source_type HAVING COUNT(*) >= 20 AND SUM(CASE WHEN person_name IS NULL THEN 1 ELSE 0 END) * 1.0 / COUNT(*) > 0.5"),
    ("gold_lineage", "error", "gold", "SELECT gold_id FROM gold LEFT JOIN silver ON gold_id = 'social:' || CAST(event_id AS STRING) LEFT JOIN articles ON gold_id = 'rss:' || CAST(doc_id AS STRING) WHERE event_id IS NULL AND doc_id IS NULL"),
    ("trends_score_ranges", "warn", "silver", "SELECT event_type FROM silver GROUP BY event_type HAVING min(confidence) > avg(confidence) + 1e-9 OR max(confidence) < avg(confidence) - 1e-9 OR avg(confidence) > 1"),
    ("event_id_prefix", "error", "gold", "SELECT gold_id FROM gold WHERE NOT ((source_type = 'rss' AND gold_id LIKE 'rss:%') OR (source_type = 'social' AND gold_id LIKE 'social:%'))"),
    ("inscope_has_person", "error", "gold", "SELECT gold_id FROM gold WHERE source_type = 'social' AND (person_id IS NULL OR person_name IS NULL)"),
    ("person_denorm_co_null", "warn", "gold", "SELECT gold_id FROM gold WHERE (person_name IS NULL) <> (person_group IS NULL)"),
    ("sentiment_null_parity", "error", "gold", "SELECT gold_id FROM gold WHERE (label IS NULL) <> (confidence IS NULL)"),
    ("mentioned_sources_valid", "warn", "articles", "SELECT doc_id FROM articles WHERE source IS NOT NULL AND source NOT IN (SELECT DISTINCT source FROM documents WHERE source IS NOT NULL)"),
    ("no_future_events", "error", "silver", f"SELECT event_id FROM silver WHERE ts > TIMESTAMP '{AS_OF} 00:00:00' + INTERVAL 1 HOUR"),
    ("recent_data", "error", "silver", f"SELECT event_type FROM silver WHERE ts >= TIMESTAMP '{AS_OF} 00:00:00' - INTERVAL 7 DAY GROUP BY event_type HAVING max(ts) < TIMESTAMP '{AS_OF} 00:00:00' - INTERVAL 24 HOUR"),
    ("risk_score_range", "warn", "scores", "SELECT series FROM scores WHERE score < 0 OR score > 1"),
    ("label_implies_scope", "error", "silver", "SELECT event_id FROM silver WHERE label = 'ALERT' AND NOT in_scope"),
    ("relevant_has_topic", "error", "silver", "SELECT event_id FROM silver WHERE in_scope AND topic IS NULL"),
    ("rss_sentiment_coverage", "warn", "articles", "SELECT 1 AS x FROM articles HAVING SUM(CASE WHEN quality IS NULL THEN 1 ELSE 0 END) * 1.0 / NULLIF(COUNT(*), 0) > 0.05"),
    ("scope_semantics", "error", "silver", "SELECT event_id FROM silver WHERE in_scope <> (value >= 50)"),
    ("event_source_alignment", "error", "gold", "SELECT gold_id FROM gold WHERE (source_type = 'rss' AND label IS NOT NULL) OR (source_type = 'social' AND label IS NULL)"),
    ("score_ranges", "error", "silver", "SELECT CASE WHEN confidence < 0 OR confidence > 1 THEN 'confidence' ELSE 'value' END AS which FROM silver WHERE confidence < 0 OR confidence > 1 OR value < 0"),
    ("confidence_cross_layer", "error", "gold", "SELECT gold_id FROM gold g JOIN silver s ON g.gold_id = 'social:' || CAST(s.event_id AS STRING) WHERE abs(g.confidence - s.confidence) > 0.0001"),
    ("rss_sentiment_is_null", "warn", "gold", "SELECT gold_id FROM gold WHERE source_type = 'rss' AND confidence IS NOT NULL"),
    ("temporal_cutoff", "error", "gold", "SELECT gold_id FROM gold WHERE source_type = 'social' AND published_on < DATE '2024-01-05'"),
    ("temporal_ordering", "error", "series", "SELECT series FROM series WHERE day > CAST(run_at AS DATE)"),
    ("topic_id_bound", "warn", "topics", "SELECT topic_id FROM topics WHERE topic_id < -1"),
    ("topic_source_invariants", "error", "topics", "SELECT topic_id FROM topics WHERE topic_source IS NULL UNION ALL SELECT topic_id FROM topics WHERE topic_id IS NULL UNION ALL SELECT topic_id FROM topics WHERE n < 1"),
    ("regime_sentinel", "warn", "silver", "SELECT 1 AS x FROM silver HAVING SUM(CASE WHEN topic >= 0 THEN 1 ELSE 0 END) * 1.0 / COUNT(*) NOT BETWEEN 0.60 AND 0.80"),
    ("person_denorm_matches_dim", "error", "gold", "SELECT gold_id FROM gold g JOIN people p ON p.person_id = g.person_id WHERE NOT (g.person_name IS NOT DISTINCT FROM p.person_name) OR NOT (g.person_group IS NOT DISTINCT FROM p.person_group)"),
    ("silver_scope_consistency", "error", "gold", "SELECT gold_id FROM gold LEFT JOIN (SELECT 'social:' || CAST(event_id AS STRING) AS id, in_scope FROM silver UNION ALL SELECT 'rss:' || CAST(doc_id AS STRING), quality = 1 FROM articles) s ON s.id = gold_id WHERE COALESCE(NOT in_scope, TRUE)"),
    ("one_pair_a_day", "error", "pairs", "SELECT author_a FROM pairs GROUP BY day, author_a, author_b HAVING COUNT(*) <> 1"),
    ("pair_sizes", "error", "pairs", "SELECT author_a FROM pairs WHERE n_shared <> [[size:targets]]"),
    ("pair_order", "error", "pairs", "SELECT author_a FROM pairs WHERE author_a >= author_b"),
    ("series_have_scores", "error", "series", "SELECT s.series FROM series s LEFT JOIN scores c ON c.tenant = s.tenant AND c.algorithm = s.algorithm AND c.day = s.day AND c.series = s.series WHERE c.series IS NULL"),
    ("clusters_have_members", "error", "clusters", "SELECT cluster FROM clusters WHERE size < 1 OR centroid_id IS NULL"),
    ("nothing_to_check", "warn", "none", "SELECT 1 AS x FROM none"),
)
FRAMES["none"] = "SELECT event_id FROM events WHERE event_id IS NULL"


def _assertions(rows: str | None = None) -> str:
    rows = rows or " UNION ALL ".join(f"SELECT '{name}' AS name, '{severity}' AS severity, (SELECT COUNT(*) FROM {over}) AS n_rows, (SELECT COUNT(*) FROM ({what}) v) AS n_violations" for name, severity, over, what in ASSERTIONS)
    status = "CASE WHEN n_rows = 0 THEN 'SKIP' WHEN n_violations = 0 THEN 'PASS' WHEN severity = 'warn' THEN 'WARN' ELSE 'FAIL' END"
    return f"SELECT *, {status} AS status FROM ({rows}) r ORDER BY CASE {status} WHEN 'FAIL' THEN 0 WHEN 'WARN' THEN 1 WHEN 'SKIP' THEN 2 ELSE 3 END, name"


MODELS["quality_assertions"] = _assertions()
MODELS["quality_pass_rate"] = f"SELECT COUNT(*) AS n_checks, SUM(CASE WHEN status = 'PASS' THEN 1 ELSE 0 END) AS n_passed, round([[double:SUM(CASE WHEN status = 'PASS' THEN 1 ELSE 0 END) * 1.0 / NULLIF(SUM(CASE WHEN status = 'SKIP' THEN 0 ELSE 1 END), 0)]], 6) AS pass_rate FROM ({MODELS['quality_assertions']}) a"


def _split(arguments: str) -> list[str]:
    """Arguments at commas that no bracket holds."""
    out, depth = [""], 0
    for c in arguments:
        depth += (c in "([") - (c in ")]")
        if c == "," and depth == 0:
            out.append("")
        else:
            out[-1] += c
    return out


def render(sql: str, dialect: int) -> str:
    """A model's SQL for Spark (0) or for the comparison (1): markers from the inside out, then the frames that it names."""
    marker = re.compile(r"\[\[(\w+)(?::((?:(?!\[\[|\]\]).)*))?\]\]", re.S)
    while found := marker.search(sql):
        sql = sql[: found.start()] + MARKERS[found[1]][dialect].format(*_split(found[2] or "")) + sql[found.end() :]
    return sql if dialect == 0 else re.sub(r"\bAS STRING\b", "AS VARCHAR", sql)


def _frames(sql: str, held: Container[str] = ()) -> list[str]:
    """The frames that a statement rests on, those that others rest on first; what a held one rests on is not asked for."""
    out: list[str] = []
    for name, body in FRAMES.items():
        if re.search(rf"\b(?:FROM|JOIN) {name}\b", sql):
            out += [f for f in [*([] if name in held else _frames(body, held)), name] if f not in out]
    return list(dict.fromkeys(out))


def statement(sql: str, dialect: int, tables: str = "", held: dict[str, str] | None = None) -> str:
    """``held``: frames that were written as tables, and where."""
    held = held or {}
    used = [name for name in _frames(sql, held) if name not in held]
    ctes = [f"{name} AS (SELECT * FROM parquet.`{path}`)" for name, path in held.items()] + [f"{name} AS ({FRAMES[name]})" for name in used]
    if dialect == 0:
        every = " ".join([sql, *ctes])
        ctes = [f"{name} AS (SELECT * FROM parquet.`{tables}/{name}.parquet`)" for name in BASE if re.search(rf"\b(?:FROM|JOIN) {name}\b", every)] + ctes
    return render((f"WITH {', '.join(ctes)} " if ctes else "") + sql, dialect)


def _register(name: str, sql: str) -> None:
    def plan(spark, sf_dir: str) -> DataFrame:
        return spark.sql(statement(sql, 0, sf_dir))

    QUERIES[name] = plan
    ORACLES[name] = statement(sql, 1)


for _name, _sql in MODELS.items():
    _register(_name, _sql)

def fct_coactivation_span(spark, sf_dir: str) -> DataFrame:
    """As the model, by the operator: pairs and the authors' first and last instants come from the task that has the events."""
    return graph.coactivation_daily(Tables(spark, sf_dir).activations(), extent=True)


def _checked(spark, sf_dir: str) -> str:
    """The assertions' counts as rows in SQL. Frames are written once; statements with a join run one after the other, so that their shuffles do not add up; pairs are checked where they are found."""
    held: dict[str, str] = {}
    written = []
    for frame in ("ev", "silver", "gold", "series", "scores", "topics"):
        written.append(scratch(spark.sql(statement(f"SELECT * FROM {frame}", 0, sf_dir, held)), f"frame-{frame}"))
        held[frame] = written[-1]._scratch_path
    pairs = graph.daily_checks(Tables(spark, sf_dir).activations()).first()
    found = {"one_pair_a_day": (pairs["n"], pairs["twice"]), "pair_sizes": (pairs["n"], pairs["sizes"]), "pair_order": (pairs["n"], pairs["disorder"])}
    rest = [a for a in ASSERTIONS if a[0] not in found]
    for over in dict.fromkeys(a[2] for a in rest):
        mine = [a for a in rest if a[2] == over]
        together = [[a for a in mine if "JOIN" not in a[3]], *[[a] for a in mine if "JOIN" in a[3]]]
        n = spark.sql(statement(f"SELECT COUNT(*) AS n FROM {over}", 0, sf_dir, held)).first()["n"]
        for some in filter(None, together):
            got = spark.sql(statement("SELECT " + ", ".join(f"(SELECT COUNT(*) FROM ({what}) v) AS {name}" for name, _, _, what in some), 0, sf_dir, held)).first()
            found |= {name: (n, got[name]) for name, *_ in some}
            if len(some) == 1:
                free_shuffles(spark)
    discard(*written)
    return "SELECT * FROM VALUES " + ", ".join(f"('{name}', '{severity}', {found[name][0]}L, {found[name][1]}L)" for name, severity, *_ in ASSERTIONS) + " AS c(name, severity, n_rows, n_violations)"


def quality_assertions(spark, sf_dir: str) -> DataFrame:
    return spark.sql(_assertions(_checked(spark, sf_dir)))


def quality_pass_rate(spark, sf_dir: str) -> DataFrame:
    return spark.sql(render(MODELS["quality_pass_rate"].replace(MODELS["quality_assertions"], _assertions(_checked(spark, sf_dir))), 0))


for _plan in (fct_coactivation_span, quality_assertions, quality_pass_rate):
    QUERIES[_plan.__name__] = _plan

__all__ = ["ASSERTIONS", "MODELS", "Tables", "statement"]
