"""Staging, dimension, fact and mart models on the bound tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions.text import surrogate_key
from ..operators import series, tables
from .bindings import AS_OF, Tables, exact_avg

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a plan (Tables -> DataFrame) with the SQL that it must agree with."""

    def add(plan):
        QUERIES[plan.__name__] = lambda spark, sf_dir, plan=plan: plan(Tables(spark, sf_dir))
        if sql:
            ORACLES[plan.__name__] = sql
        return plan

    return add


LATEST = "ev AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts DESC, user_id NULLS FIRST, event_type NULLS FIRST, value NULLS FIRST, props NULLS FIRST) AS rn FROM events) WHERE rn = 1)"
CANON = LATEST + ", canon AS (SELECT e.*, c.c_name AS person_name, c.c_mktsegment AS person_group, c.c_nationkey AS place_id FROM ev e LEFT JOIN customer c ON c.c_custkey = e.user_id)"
AVG = "CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / COUNT(value)"


@query(f"""WITH {CANON} SELECT user_id AS person_id, person_name, person_group, CAST(date_trunc('week', ts) AS DATE) AS week_start,
  COUNT(*) AS mentions_total, COUNT(*) FILTER (WHERE event_type = 'view') AS n_view, COUNT(*) FILTER (WHERE event_type = 'error') AS n_error, {AVG} AS avg_value
  FROM canon GROUP BY 1, 2, 3, 4""")
def mentions_by_person_weekly(t: Tables) -> DataFrame:
    # Counts per person and week come before the join: the dimension meets a row a group, not a row an event.
    weekly = t.events().groupBy(F.col("user_id").alias("person_id"), cal.week_start(F.col("ts")).alias("week_start")).agg(F.count("*").alias("mentions_total"), F.count_if(F.col("event_type") == "view").alias("n_view"), F.count_if(F.col("event_type") == "error").alias("n_error"), exact_avg("value").alias("avg_value"))
    return weekly.join(t.people().drop("place_id"), "person_id", "left").select("person_id", "person_name", "person_group", "week_start", "mentions_total", "n_view", "n_error", "avg_value")


@query(f"WITH {LATEST} SELECT event_id, ts, user_id, event_type, value, props FROM ev")
def stg_latest_events(t: Tables) -> DataFrame:
    return t.events()


@query("""WITH u AS (SELECT 'click' AS src, event_id, ts FROM events WHERE event_type = 'click' UNION ALL SELECT 'view', event_id, ts FROM events WHERE event_type = 'view'
  UNION ALL SELECT 'purchase', event_id, ts FROM events WHERE event_type = 'purchase' UNION ALL SELECT 'signup', event_id, ts FROM events WHERE event_type = 'signup'),
  r AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts DESC) AS rn FROM u) SELECT src, event_id, ts FROM r WHERE rn = 1""")
def stg_raw_posts_union(t: Tables) -> DataFrame:
    e = t("events")
    parts = [e.where(F.col("event_type") == k).select(F.lit(k).alias("src"), "event_id", "ts") for k in ("click", "view", "purchase", "signup")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return tables.latest_by(out, ["event_id"], [F.desc("ts")])


@query(f"""WITH {LATEST} SELECT event_id, ts, user_id AS author_id_raw, lower(trim(CAST(user_id AS VARCHAR))) AS author_id, json_extract_string(props, '$.k') AS target, value >= 250 AS high_value
  FROM ev WHERE ts >= TIMESTAMP '2024-01-10 00:00:00'""")
def stg_silver_posts_cutoff(t: Tables) -> DataFrame:
    # The cutoff comes after the choice of the latest row, as it must: it is not a filter on the key.
    return t.events().where(F.col("ts") >= F.lit("2024-01-10").cast("timestamp")).select("event_id", "ts", F.col("user_id").alias("author_id_raw"), F.lower(F.trim(F.col("user_id").cast("string"))).alias("author_id"), F.get_json_object("props", "$.k").alias("target"), (F.col("value") >= 250).alias("high_value"))


@query("""SELECT d::DATE AS date_day, year(d)::INT AS year, month(d)::INT AS month, quarter(d)::INT AS quarter, week(d)::INT AS week_iso, CAST(date_trunc('week', d) AS DATE) AS week_start, (isodow(d) - 1)::INT AS dow,
  isodow(d) >= 6 AS is_weekend,
  (month(d) * 100 + day(d)) IN (101, 421, 501, 907, 1012, 1102, 1115, 1120, 1225) OR CAST(d::DATE AS VARCHAR) IN ('2024-02-13','2024-03-29','2024-05-30','2025-03-04','2025-04-18','2025-06-19','2026-02-17','2026-04-03','2026-06-04','2027-02-09','2027-03-26','2027-05-27') AS is_holiday,
  (month(d) * 100 + day(d)) = 1003 AS is_state_holiday,
  CASE WHEN d BETWEEN DATE '2026-01-01' AND DATE '2026-08-15' THEN 'pre_campaign' WHEN d BETWEEN DATE '2026-08-16' AND DATE '2026-10-04' THEN 'campaign' WHEN d BETWEEN DATE '2026-10-05' AND DATE '2026-10-25' THEN 'runoff' WHEN d BETWEEN DATE '2026-10-26' AND DATE '2026-12-31' THEN 'post' ELSE 'none' END AS phase
  FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2027-12-31', INTERVAL 1 DAY)) AS d)""")
def dim_dates(t: Tables) -> DataFrame:
    d = F.col("date_day")
    return series.calendar(t.spark, "2024-01-01", "2027-12-31", "date_day").select(d, F.year(d).alias("year"), F.month(d).alias("month"), F.quarter(d).alias("quarter"), F.weekofyear(d).alias("week_iso"), cal.week_start(d).alias("week_start"), F.weekday(d).alias("dow"), (F.weekday(d) >= 5).alias("is_weekend"), cal.is_national_holiday(d).alias("is_holiday"), cal.is_state_holiday(d).alias("is_state_holiday"), cal.electoral_phase(d).alias("phase"))


def _people_days(t: Tables) -> tuple[DataFrame, DataFrame]:
    """The dimension a day ago, and the seed of today in which some people moved, left or came."""
    c = t("customer").select(F.col("c_custkey").alias("person_id"), F.col("c_mktsegment").alias("role"), F.col("c_nationkey").alias("place"))
    old = tables.full_refresh(c.where("person_id % 11 != 0"), ["role", "place"], "person_id", "2024-01-01")
    seed = c.where("person_id % 13 != 0").withColumn("role", F.when(F.col("person_id") % 7 == 0, "MOVED").otherwise(F.col("role")))
    return old, seed


@query("""WITH c AS (SELECT c_custkey AS person_id, c_mktsegment AS role, c_nationkey AS place FROM customer), o AS (SELECT * FROM c WHERE person_id % 11 <> 0),
  n AS (SELECT person_id, CASE WHEN person_id % 7 = 0 THEN 'MOVED' ELSE role END AS role, place FROM c WHERE person_id % 13 <> 0)
  SELECT o.person_id, o.role, o.place, DATE '2024-01-01' AS valid_from, CASE WHEN n.person_id IS NOT NULL AND o.role IS NOT DISTINCT FROM n.role AND o.place IS NOT DISTINCT FROM n.place THEN NULL ELSE DATE '2024-02-01' END AS valid_to,
    n.person_id IS NOT NULL AND o.role IS NOT DISTINCT FROM n.role AND o.place IS NOT DISTINCT FROM n.place AS is_current FROM o LEFT JOIN n USING (person_id)
  UNION ALL SELECT n.person_id, n.role, n.place, DATE '2024-02-01', NULL, TRUE FROM n LEFT JOIN o USING (person_id)
  WHERE o.person_id IS NULL OR o.role IS DISTINCT FROM n.role OR o.place IS DISTINCT FROM n.place""")
def dim_persons_scd2(t: Tables) -> DataFrame:
    return tables.slowly_changing(*_people_days(t), "person_id", ["role", "place"], "2024-02-01")


@query("""SELECT md5(concat_ws('-', coalesce(CAST(n_nationkey AS VARCHAR), '_null_'), coalesce(n_name, '_null_'))) AS place_key, n_nationkey AS place_id, n_name AS place, r_name AS region, DATE '2024-01-01' AS valid_from, TRUE AS is_current
  FROM nation JOIN region ON n_regionkey = r_regionkey""")
def dim_places(t: Tables) -> DataFrame:
    n = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return n.select(surrogate_key(F.col("n_nationkey"), F.col("n_name")).alias("place_key"), F.col("n_nationkey").alias("place_id"), F.col("n_name").alias("place"), F.col("r_name").alias("region"), F.lit("2024-01-01").cast("date").alias("valid_from"), F.lit(True).alias("is_current"))


@query("SELECT DISTINCT source FROM documents WHERE source IS NOT NULL")
def dim_sources(t: Tables) -> DataFrame:
    return t("documents").select("source").where("source is not null").distinct()


@query("SELECT DISTINCT event_type AS platform, CASE event_type WHEN 'view' THEN 'web' WHEN 'click' THEN 'web' ELSE 'app' END AS family FROM events")
def dim_platforms(t: Tables) -> DataFrame:
    return t("events").select(F.col("event_type").alias("platform")).distinct().withColumn("family", F.when(F.col("platform").isin("view", "click"), "web").otherwise("app"))


@query(f"""WITH {LATEST} SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS topic_id, event_type AS topic_source, COUNT(*) AS n, {AVG} AS avg_value, min(ts) AS first_at, max(ts) AS last_at, CASE WHEN CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 < 5 THEN 'low' ELSE 'high' END AS topic_label
  FROM ev GROUP BY 1, 2, 7""")
def dim_topics(t: Tables) -> DataFrame:
    topic = (F.get_json_object("props", "$.k").cast("long") % 10).alias("topic_id")
    out = t.events().groupBy(topic, F.col("event_type").alias("topic_source")).agg(F.count("*").alias("n"), exact_avg("value").alias("avg_value"), F.min("ts").alias("first_at"), F.max("ts").alias("last_at"))
    return out.withColumn("topic_label", F.when(F.col("topic_id") < 5, "low").otherwise("high"))


@query(f"""WITH {CANON} SELECT 'ev:' || event_id AS event_id, ts AS published_at, user_id AS person_id, person_name, person_group, event_type AS platform, value AS engagement, CAST(NULL AS VARCHAR) AS status, ln(1 + value) AS trend_score,
  '{{"person_group":' || coalesce('"' || person_group || '"', 'null') || ',"k":' || json_extract_string(props, '$.k') || '}}' AS metadata_json FROM canon
  UNION ALL SELECT 'ord:' || o_orderkey, o_orderdate, o_custkey, c_name, c_mktsegment, 'order', o_totalprice, o_orderstatus, ln(1 + o_totalprice), NULL FROM orders LEFT JOIN customer ON c_custkey = o_custkey""")
def canonical_events(t: Tables) -> DataFrame:
    people = t.people().drop("place_id")
    a = t.events().select(F.concat(F.lit("ev:"), "event_id").alias("event_id"), F.col("ts").alias("published_at"), F.col("user_id").alias("person_id"), F.col("event_type").alias("platform"), F.col("value").alias("engagement"), "props")
    b = t("orders").select(F.concat(F.lit("ord:"), "o_orderkey").alias("event_id"), F.col("o_orderdate").alias("published_at"), F.col("o_custkey").alias("person_id"), F.lit("order").alias("platform"), F.col("o_totalprice").alias("engagement"), F.col("o_orderstatus").alias("status"))
    both = a.unionByName(b, allowMissingColumns=True).join(people, "person_id", "left")
    meta = F.to_json(F.struct("person_group", F.get_json_object("props", "$.k").cast("long").alias("k")), {"ignoreNullFields": "false"})
    return both.select("event_id", "published_at", "person_id", "person_name", "person_group", "platform", "engagement", "status", F.log(1 + F.col("engagement")).alias("trend_score"), F.when(F.col("props").isNotNull(), meta).alias("metadata_json")).withColumn("trend_score", F.round("trend_score", 6))


ORACLES["canonical_events"] = ORACLES["canonical_events"].replace("ln(1 + value) AS trend_score", "round(ln(1 + value), 6) AS trend_score").replace("ln(1 + o_totalprice)", "round(ln(1 + o_totalprice), 6)")


@query(f"""WITH {LATEST}, old AS (SELECT * FROM ev WHERE event_id % 3 <> 0), fresh AS (SELECT event_id, ts, user_id, event_type, value + 1 AS value, props FROM ev WHERE event_id % 2 = 0)
  SELECT event_id, ts, user_id, event_type, value, props FROM old WHERE event_id NOT IN (SELECT event_id FROM fresh) UNION ALL SELECT * FROM fresh""")
def fct_incremental_merge(t: Tables) -> DataFrame:
    e = t.events()
    return tables.upsert(e.where("event_id % 3 != 0"), e.where("event_id % 2 = 0").withColumn("value", F.col("value") + 1), ["event_id"])


@query(f"WITH {LATEST}, m AS (SELECT max(ts) AS mark FROM ev WHERE ts < TIMESTAMP '2024-01-20') SELECT event_id, ts FROM ev, m WHERE ts >= mark - INTERVAL 7 DAY")
def fct_high_water(t: Tables) -> DataFrame:
    e = t.events()
    return tables.above_mark(e, "ts", e.where(F.col("ts") < F.lit("2024-01-20").cast("timestamp")), inclusive=True, lookback_days=7).select("event_id", "ts")


@query("""WITH d AS (SELECT user_id AS author, CAST(json_extract_string(props, '$.k') AS BIGINT) AS target, CAST(ts AS DATE) AS day FROM events GROUP BY 1, 2, 3)
  SELECT a.day, a.author AS author_a, b.author AS author_b, COUNT(DISTINCT a.target) AS n_shared, list_sort(list(DISTINCT a.target)) AS targets FROM d a JOIN d b ON a.day = b.day AND a.target = b.target AND a.author < b.author GROUP BY 1, 2, 3""")
def fct_coactivation_daily(t: Tables) -> DataFrame:
    from ..operators.graph import coactivation_daily

    return coactivation_daily(t.activations())


@query(f"""WITH {LATEST} SELECT event_type AS entity, COUNT(*) AS n_mentions, COUNT(DISTINCT user_id) AS n_people, {AVG} AS avg_value, min(value) AS min_value, max(value) AS max_value, min(ts) AS first_at, max(ts) AS last_at, COUNT(DISTINCT json_extract_string(props, '$.k')) AS n_targets FROM ev GROUP BY 1""")
def fct_trends(t: Tables) -> DataFrame:
    return t.events().groupBy(F.col("event_type").alias("entity")).agg(F.count("*").alias("n_mentions"), F.countDistinct("user_id").alias("n_people"), exact_avg("value").alias("avg_value"), F.min("value").alias("min_value"), F.max("value").alias("max_value"), F.min("ts").alias("first_at"), F.max("ts").alias("last_at"), F.countDistinct(F.get_json_object("props", "$.k")).alias("n_targets"))


@query("""WITH m AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+')) AS entity FROM documents) SELECT doc_id, entity, COUNT(*) AS mention_count FROM m GROUP BY 1, 2""")
def fct_entity_explode(t: Tables) -> DataFrame:
    found = F.regexp_extract_all("text", F.lit(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+"), F.lit(0))
    return t("documents").select("doc_id", F.explode(found).alias("entity")).groupBy("doc_id", "entity").agg(F.count("*").alias("mention_count"))


@query("""WITH last AS (SELECT conv_id, text AS verdict, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn FROM conversations WHERE role = 'assistant'),
  first AS (SELECT conv_id, text AS question, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn FROM conversations WHERE role = 'user')
  SELECT f.conv_id, question, coalesce(verdict, 'none') AS verdict, CASE WHEN f.conv_id % 10 = 0 THEN 'manual' ELSE 'model' END AS decided_by FROM first f LEFT JOIN last l ON l.conv_id = f.conv_id AND l.rn = 1 WHERE f.rn = 1""")
def fct_latest_verdict(t: Tables) -> DataFrame:
    c = t("conversations")
    last = c.where("role = 'assistant'").groupBy("conv_id").agg(F.max_by("text", "turn").alias("verdict"))
    first = c.where("role = 'user'").groupBy("conv_id").agg(F.min_by("text", "turn").alias("question"))
    return first.join(last, "conv_id", "left").select("conv_id", "question", F.coalesce("verdict", F.lit("none")).alias("verdict"), F.when(F.col("conv_id") % 10 == 0, "manual").otherwise("model").alias("decided_by"))


@query(f"""WITH {LATEST}, c AS (SELECT CAST(ts AS DATE) AS day, user_id % 10 AS community_id, user_id, event_type FROM ev) SELECT day, community_id, COUNT(DISTINCT CAST(user_id AS VARCHAR) || '|' || event_type) AS n_members,
  list_sort(list(DISTINCT CAST(user_id AS VARCHAR) || '|' || event_type)) AS members FROM c GROUP BY 1, 2""")
def fct_community_daily(t: Tables) -> DataFrame:
    who = F.concat_ws("|", "user_id", "event_type")
    return t.events().groupBy(F.col("ts").cast("date").alias("day"), (F.col("user_id") % 10).alias("community_id")).agg(F.countDistinct(who).alias("n_members"), F.sort_array(F.collect_set(who)).alias("members"))


@query(f"""WITH {LATEST} SELECT user_id AS person_id, event_type AS platform, CAST(date_trunc('week', ts) AS DATE) AS week_start, COUNT(*) AS posts, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS engagement, {AVG} AS avg_engagement FROM ev GROUP BY 1, 2, 3""")
def mart_engagement_by_person_platform(t: Tables) -> DataFrame:
    return t.events().groupBy(F.col("user_id").alias("person_id"), F.col("event_type").alias("platform"), cal.week_start(F.col("ts")).alias("week_start")).agg(F.count("*").alias("posts"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("engagement"), exact_avg("value").alias("avg_engagement"))


@query(f"""WITH {LATEST}, c AS (SELECT user_id, CAST(ts AS DATE) AS day, COUNT(*) AS n FROM ev GROUP BY 1, 2), p AS (SELECT DISTINCT user_id FROM ev), d AS (SELECT CAST(unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30', INTERVAL 1 DAY)) AS DATE) AS day),
  g AS (SELECT p.user_id, d.day, coalesce(c.n, 0) AS n FROM p CROSS JOIN d LEFT JOIN c ON c.user_id = p.user_id AND c.day = d.day),
  w AS (SELECT *, avg(n) OVER f AS baseline_mean, round(stddev_samp(n) OVER f, 6) AS baseline_std FROM g WINDOW f AS (PARTITION BY user_id ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)),
  z AS (SELECT *, CASE WHEN baseline_std > 0 THEN round((n - baseline_mean) / baseline_std, 6) END AS z_score FROM w WHERE n > 0)
  SELECT user_id, day, n, round(baseline_mean, 6) AS baseline_mean, baseline_std, z_score, coalesce(z_score >= 2.0 AND n >= 3, FALSE) AS is_anomaly FROM z""")
def mart_anomalies_daily(t: Tables) -> DataFrame:
    e = t.events()
    counts = e.groupBy("user_id", F.col("ts").cast("date").alias("day")).agg(F.count("*").alias("n"))
    dense = series.densify(counts, e.select("user_id").distinct(), series.calendar(t.spark, "2024-01-01", AS_OF), "user_id")
    return series.anomalies(dense, "user_id", frame=7).withColumn("baseline_mean", F.round("baseline_mean", 6))


@query(f"""WITH {LATEST}, v AS (SELECT *, event_id % 2 AS regime FROM ev) SELECT CAST(ts AS DATE) AS day, COUNT(*) FILTER (WHERE regime = 0) AS n_a, COUNT(*) FILTER (WHERE regime = 1) AS n_b, COUNT(*) FILTER (WHERE value > 250 AND regime = 0) AS high_a, COUNT(*) FILTER (WHERE value > 250 AND regime = 1) AS high_b FROM v GROUP BY 1""")
def mart_rule_version_compare(t: Tables) -> DataFrame:
    a, b, high = F.col("event_id") % 2 == 0, F.col("event_id") % 2 == 1, F.col("value") > 250
    return t.events().groupBy(F.col("ts").cast("date").alias("day")).agg(F.count_if(a).alias("n_a"), F.count_if(b).alias("n_b"), F.count_if(high & a).alias("high_a"), F.count_if(high & b).alias("high_b"))


@query(f"""WITH {LATEST}, a AS (SELECT event_id AS id_a, user_id, ts AS ts_a FROM ev WHERE event_type = 'click'), b AS (SELECT event_id AS id_b, user_id, ts AS ts_b FROM ev WHERE event_type = 'view'),
  p AS (SELECT *, abs(epoch_us(ts_a) - epoch_us(ts_b)) AS gap FROM a JOIN b USING (user_id) WHERE abs(epoch_us(ts_a) - epoch_us(ts_b)) <= 3600000000),
  m AS (SELECT *, row_number() OVER (PARTITION BY id_a ORDER BY gap, id_b) AS ra, row_number() OVER (PARTITION BY id_b ORDER BY gap, id_a) AS rb FROM p)
  SELECT id_a, id_b, user_id, gap / 1000000.0::DOUBLE AS delta_seconds, sha256(CAST(least(id_a, id_b) AS VARCHAR)) AS group_id FROM m WHERE ra = 1 AND rb = 1""")
def int_cross_post_pairs(t: Tables) -> DataFrame:
    e = t.events()
    a = e.where("event_type = 'click'").select(F.col("event_id").alias("id_a"), "user_id", F.col("ts").alias("ts_a"))
    b = e.where("event_type = 'view'").select(F.col("event_id").alias("id_b"), "user_id", F.col("ts").alias("ts_b"))
    best = series.mutual_best(series.band_pairs(a, b, ["user_id"], "ts_a", "ts_b", 3600), "id_a", "id_b", "delta_seconds")
    return best.select("id_a", "id_b", "user_id", "delta_seconds", F.sha2(F.least("id_a", "id_b").cast("string").cast("binary"), 256).alias("group_id"))


@query("""SELECT p.event_id, p.ts, CASE WHEN q.qty >= 25 AND p.value >= 100 THEN q.qty END AS topic_id FROM events p LEFT JOIN (SELECT l_orderkey, max(l_quantity) AS qty FROM lineitem GROUP BY 1) q ON q.l_orderkey = p.event_id""")
def int_gold_enriched(t: Tables) -> DataFrame:
    gold = t("lineitem").groupBy(F.col("l_orderkey").alias("event_id")).agg(F.max("l_quantity").alias("qty"))
    return t("events").join(gold, "event_id", "left").select("event_id", "ts", F.when((F.col("qty") >= 25) & (F.col("value") >= 100), F.col("qty")).alias("topic_id"))


@query(f"""WITH {LATEST}, s AS (SELECT user_id, min(CAST(ts AS DATE)) AS started FROM ev GROUP BY 1) SELECT user_id, started, date_diff('day', started, DATE '{AS_OF}') AS age_days FROM s""")
def fct_series_age(t: Tables) -> DataFrame:
    return t.events().groupBy("user_id").agg(F.min(F.col("ts").cast("date")).alias("started")).withColumn("age_days", F.date_diff(F.lit(AS_OF).cast("date"), "started").cast("long"))


@query("""WITH c AS (SELECT label AS cluster, vec_id FROM embeddings) SELECT cluster, COUNT(*) AS size, max(CASE WHEN vec_id % 7 = 0 THEN vec_id END) AS centroid_id, list_sort(list(vec_id)) AS members FROM c GROUP BY 1""")
def fct_narrative_cluster_daily(t: Tables) -> DataFrame:
    return t("embeddings").groupBy(F.col("label").alias("cluster")).agg(F.count("*").alias("size"), F.max(F.when(F.col("vec_id") % 7 == 0, F.col("vec_id"))).alias("centroid_id"), F.sort_array(F.collect_list("vec_id")).alias("members"))


@query(ORACLES["mart_anomalies_daily"].replace("7 PRECEDING", "30 PRECEDING"))
def mart_anomalies_monthly(t: Tables) -> DataFrame:
    """The daily anomalies against a baseline of thirty days."""
    e = t.events()
    counts = e.groupBy("user_id", F.col("ts").cast("date").alias("day")).agg(F.count("*").alias("n"))
    dense = series.densify(counts, e.select("user_id").distinct(), series.calendar(t.spark, "2024-01-01", AS_OF), "user_id")
    return series.anomalies(dense, "user_id", frame=30).withColumn("baseline_mean", F.round("baseline_mean", 6))


@query("""WITH n AS (SELECT n_nationkey AS place_id, n_name AS place, n_regionkey AS region FROM nation), o AS (SELECT * FROM n WHERE place_id % 6 <> 0), f AS (SELECT place_id, place, CASE WHEN place_id % 5 = 0 THEN (region + 1) % 5 ELSE region END AS region FROM n WHERE place_id % 7 <> 0)
  SELECT o.place_id, o.place, o.region, DATE '2024-01-01' AS valid_from, CASE WHEN f.place_id IS NOT NULL AND f.region = o.region THEN NULL ELSE DATE '2024-02-01' END AS valid_to, f.place_id IS NOT NULL AND f.region = o.region AS is_current FROM o LEFT JOIN f USING (place_id)
  UNION ALL SELECT f.place_id, f.place, f.region, DATE '2024-02-01', NULL, TRUE FROM f LEFT JOIN o USING (place_id) WHERE o.place_id IS NULL OR o.region <> f.region""")
def dim_places_scd2(t: Tables) -> DataFrame:
    n = t("nation").select(F.col("n_nationkey").alias("place_id"), F.col("n_name").alias("place"), F.col("n_regionkey").alias("region"))
    old = tables.full_refresh(n.where("place_id % 6 != 0"), ["place", "region"], "place_id", "2024-01-01")
    seed = n.where("place_id % 7 != 0").withColumn("region", F.when(F.col("place_id") % 5 == 0, (F.col("region") + 1) % 5).otherwise(F.col("region")).cast(n.schema["region"].dataType))
    return tables.slowly_changing(old, seed, "place_id", ["place", "region"], "2024-02-01")
