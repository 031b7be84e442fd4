"""Dashboard, alert and job queries. Every clock is AS_OF."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..operators import tables
from ..operators.series import _micros
from .bindings import AS_OF, Tables, exact_avg
from .marts import AVG, CANON, LATEST, ORACLES, mart_anomalies_daily, query


@query(f"""WITH {LATEST}, n AS (SELECT COUNT(*) FILTER (WHERE ts > TIMESTAMP '2024-01-23') AS mentions_now, COUNT(*) FILTER (WHERE ts <= TIMESTAMP '2024-01-23' AND ts > TIMESTAMP '2024-01-16') AS mentions_before,
  COUNT(DISTINCT CASE WHEN ts > TIMESTAMP '2024-01-23' THEN user_id END) AS people_now, COUNT(*) FILTER (WHERE event_type = 'error' AND ts > TIMESTAMP '2024-01-23') AS errors_now FROM ev) SELECT * FROM n""")
def overview_kpis(t: Tables) -> DataFrame:
    now = F.col("ts") > F.lit("2024-01-23").cast("timestamp")
    before = ~now & (F.col("ts") > F.lit("2024-01-16").cast("timestamp"))
    return t.events().agg(F.count_if(now).alias("mentions_now"), F.count_if(before).alias("mentions_before"), F.countDistinct(F.when(now, F.col("user_id"))).alias("people_now"), F.count_if(now & (F.col("event_type") == "error")).alias("errors_now"))


@query(f"""WITH {CANON}, r AS (SELECT person_name, COUNT(*) AS n FROM canon WHERE ts > TIMESTAMP '2024-01-23' GROUP BY 1 ORDER BY n DESC, person_name LIMIT 1), p AS (SELECT COUNT(*) AS prior FROM canon WHERE ts <= TIMESTAMP '2024-01-23') SELECT * FROM r, p""")
def overview_hero(t: Tables) -> DataFrame:
    c = t.canonical()
    cut = F.lit("2024-01-23").cast("timestamp")
    top = c.where(F.col("ts") > cut).groupBy("person_name").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "person_name").limit(1)
    return top.crossJoin(F.broadcast(c.where(F.col("ts") <= cut).agg(F.count("*").alias("prior"))))


@query(f"WITH {LATEST} SELECT strftime(max(ts) - INTERVAL 3 HOUR, '%d/%m %H:%M') AS fresh_at, max(ts) AS last_ts FROM ev")
def overview_freshness(t: Tables) -> DataFrame:
    return t.events().agg(F.max("ts").alias("last_ts")).select(F.date_format(F.from_utc_timestamp("last_ts", "America/Fortaleza"), "dd/MM HH:mm").alias("fresh_at"), "last_ts")


@query(f"SELECT date_diff('day', DATE '{AS_OF}', DATE '2026-10-04') AS days_left, 'none' AS phase")
def overview_countdown(t: Tables) -> DataFrame:
    day = F.lit(AS_OF).cast("date")
    return t.spark.range(1).select(F.date_diff(F.lit("2026-10-04").cast("date"), day).cast("long").alias("days_left"), cal.electoral_phase(day).alias("phase"))


@query(f"""WITH {CANON} SELECT n_name AS place, COUNT(*) AS mentions FROM canon JOIN nation ON n_nationkey = place_id GROUP BY 1 ORDER BY mentions DESC, place LIMIT 25""")
def coverage_places(t: Tables) -> DataFrame:
    by_place = t.canonical().groupBy("place_id").agg(F.count("*").alias("mentions"))
    return by_place.join(t("nation"), F.col("n_nationkey") == F.col("place_id")).select(F.col("n_name").alias("place"), "mentions").orderBy(F.desc("mentions"), "place").limit(25)


@query(f"""WITH {CANON} SELECT person_name, COUNT(*) FILTER (WHERE event_type = 'purchase') AS favorable, COUNT(*) FILTER (WHERE event_type = 'error') AS negative, COUNT(*) AS total FROM canon WHERE person_group IN ('BUILDING', 'MACHINERY') GROUP BY 1 ORDER BY total DESC, person_name LIMIT 15""")
def candidates_ranking(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    return t.canonical().where(F.col("person_group").isin("BUILDING", "MACHINERY")).groupBy("person_name").agg(F.count_if(kind == "purchase").alias("favorable"), F.count_if(kind == "error").alias("negative"), F.count("*").alias("total")).orderBy(F.desc("total"), "person_name").limit(15)


@query(f"WITH {CANON} SELECT person_name, event_type, person_group, COUNT(*) AS n FROM canon GROUP BY 1, 2, 3")
def candidates_source_split(t: Tables) -> DataFrame:
    return t.canonical().groupBy("person_name", "event_type", "person_group").agg(F.count("*").alias("n"))


@query(f"WITH {CANON} SELECT CASE WHEN person_group = 'BUILDING' THEN 'incumbent' ELSE 'opposition' END AS side, COUNT(*) AS n, {AVG} AS avg_value FROM canon GROUP BY 1")
def candidates_groups(t: Tables) -> DataFrame:
    side = F.when(F.col("person_group") == "BUILDING", "incumbent").otherwise("opposition").alias("side")
    return t.canonical().groupBy(side).agg(F.count("*").alias("n"), exact_avg("value").alias("avg_value"))


@query(f"""WITH {LATEST}, top AS (SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 50)
  SELECT c_custkey AS person_id, c_name AS person_name, COUNT(event_id) AS mentions FROM top LEFT JOIN ev ON ev.user_id = c_custkey AND event_type = 'view' GROUP BY 1, 2""")
def candidates_top_with_zeroes(t: Tables) -> DataFrame:
    top = t("customer").orderBy(F.desc("c_acctbal"), "c_custkey").limit(50)
    views = t.events().where("event_type = 'view'").groupBy("user_id").agg(F.count("*").alias("mentions"))
    return top.join(views, F.col("user_id") == F.col("c_custkey"), "left").select(F.col("c_custkey").alias("person_id"), F.col("c_name").alias("person_name"), F.coalesce("mentions", F.lit(0)).alias("mentions"))


@query("SELECT source, COUNT(DISTINCT text) AS texts, COUNT(*) AS docs FROM documents GROUP BY 1 ORDER BY docs DESC, source LIMIT 20")
def coverage_feeds(t: Tables) -> DataFrame:
    # Texts are counted by hash and length, so that no text is shuffled.
    key = F.struct(F.xxhash64("text"), F.length("text"), F.crc32(F.col("text").cast("binary")))
    return t("documents").groupBy("source").agg(F.countDistinct(key).alias("texts"), F.count("*").alias("docs")).orderBy(F.desc("docs"), "source").limit(20)


@query(f"WITH {LATEST} SELECT isodow(ts) - 1 AS dow, hour(ts) AS hour, COUNT(*) AS n FROM ev GROUP BY 1, 2")
def coverage_schedule(t: Tables) -> DataFrame:
    return t.instants().groupBy(F.weekday("ts").cast("long").alias("dow"), F.hour("ts").cast("long").alias("hour")).agg(F.count("*").alias("n"))


@query(f"WITH {LATEST} SELECT event_type AS label, COUNT(*) AS n, COUNT(*) * 100.0::DOUBLE / SUM(COUNT(*)) OVER () AS pct FROM ev WHERE value >= 50 GROUP BY 1")
def alerts_sentiment_pct(t: Tables) -> DataFrame:
    n = t.events().where("value >= 50").groupBy(F.col("event_type").alias("label")).agg(F.count("*").alias("n"))
    return n.crossJoin(F.broadcast(n.agg(F.sum("n").alias("total")))).select("label", "n", (F.col("n") * 100.0 / F.col("total")).alias("pct"))


@query(f"WITH {LATEST} SELECT user_id, COUNT(*) AS n, {AVG} AS avg_value FROM ev GROUP BY 1 HAVING COUNT(*) >= 5 ORDER BY avg_value, user_id LIMIT 50")
def alerts_quality(t: Tables) -> DataFrame:
    return t.events().groupBy("user_id").agg(F.count("*").alias("n"), exact_avg("value").alias("avg_value")).where("n >= 5").orderBy("avg_value", "user_id").limit(50)


@query(f"WITH {LATEST} SELECT CAST(ts AS DATE) AS day, event_type, COUNT(*) AS n, {AVG} AS avg_value FROM ev WHERE ts >= TIMESTAMP '2024-01-15' GROUP BY 1, 2")
def trends_daily(t: Tables) -> DataFrame:
    return t.events().where(F.col("ts") >= F.lit("2024-01-15").cast("timestamp")).groupBy(F.col("ts").cast("date").alias("day"), "event_type").agg(F.count("*").alias("n"), exact_avg("value").alias("avg_value"))


@query(ORACLES["mart_anomalies_daily"].replace("SELECT user_id, day, n, round(baseline_mean", "SELECT * FROM (SELECT user_id, day, n, round(baseline_mean") + ") WHERE is_anomaly ORDER BY z_score DESC, day DESC, user_id LIMIT 10")
def alert_spikes(t: Tables) -> DataFrame:
    return mart_anomalies_daily(t).where("is_anomaly").orderBy(F.desc("z_score"), F.desc("day"), "user_id").limit(10)


@query("SELECT 'events' AS tracked, date_diff('minute', max(ts), TIMESTAMP '2024-02-01') AS minutes_stale FROM events UNION ALL SELECT 'orders', date_diff('minute', max(o_orderdate), TIMESTAMP '2024-02-01') FROM orders UNION ALL SELECT 'lineitem', date_diff('minute', max(l_shipdate), TIMESTAMP '2024-02-01') FROM lineitem")
def freshness(t: Tables) -> DataFrame:
    at = F.lit("2024-02-01").cast("timestamp")
    minutes = lambda ts: F.floor((_micros(at) / 60_000_000)) - F.floor(_micros(F.max(ts)) / 60_000_000)
    rows = [t(name).agg(minutes(ts).cast("long").alias("minutes_stale")).select(F.lit(name).alias("tracked"), "minutes_stale") for name, ts in (("events", "ts"), ("orders", "o_orderdate"), ("lineitem", "l_shipdate"))]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query(f"""WITH {LATEST} SELECT event_type AS platform, user_id % 20 AS handle, min(user_id) AS any_id, list_sort(list(DISTINCT CAST(json_extract_string(props, '$.k') AS BIGINT))) AS targets, COUNT(*) AS n FROM ev GROUP BY 1, 2 HAVING COUNT(*) >= 3""")
def job_author_extraction(t: Tables) -> DataFrame:
    return t.events().groupBy(F.col("event_type").alias("platform"), (F.col("user_id") % 20).alias("handle")).agg(F.min("user_id").alias("any_id"), F.sort_array(F.collect_set(F.get_json_object("props", "$.k").cast("long"))).alias("targets"), F.count("*").alias("n")).where("n >= 3")


@query(f"""WITH {LATEST}, k AS (SELECT user_id, event_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS position FROM ev WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')) SELECT user_id, event_id, ts, position FROM k WHERE position <= 12""")
def job_evidence_bundles(t: Tables) -> DataFrame:
    wanted = t("customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("user_id"))
    e = t.events().join(wanted, "user_id", "left_semi").select("user_id", "event_id", "ts")
    return tables.top_per_group(e, ["user_id"], [F.desc("ts"), F.col("event_id")], 12).withColumn("position", F.col("position").cast("long"))


@query(f"""WITH {CANON} SELECT event_id, 'id' AS path FROM canon WHERE user_id = 7 UNION ALL SELECT event_id, 'mention' FROM canon WHERE json_extract_string(props, '$.k') = '7' AND user_id IS DISTINCT FROM 7""")
def person_mentions(t: Tables) -> DataFrame:
    c = t.canonical()
    by_id = c.where("user_id = 7").select("event_id", F.lit("id").alias("path"))
    mention = c.where((F.get_json_object("props", "$.k") == "7") & ~F.col("user_id").eqNullSafe(F.lit(7))).select("event_id", F.lit("mention").alias("path"))
    return by_id.union(mention)


@query("""SELECT 'before_cutoff' AS problem, COUNT(*) AS n, min(ts) AS first_at, max(ts) AS last_at FROM events WHERE ts < TIMESTAMP '2024-01-05' UNION ALL SELECT 'backfill', COUNT(*), min(ts), max(ts) FROM events WHERE event_type = 'error'""")
def temporal_audit(t: Tables) -> DataFrame:
    e = t("events")
    say = lambda name, df: df.agg(F.lit(name).alias("problem"), F.count("*").alias("n"), F.min("ts").alias("first_at"), F.max("ts").alias("last_at"))
    return say("before_cutoff", e.where(F.col("ts") < F.lit("2024-01-05").cast("timestamp"))).unionByName(say("backfill", e.where("event_type = 'error'")))


#: The searches ask for every row whose id is divisible by 50.
_NEAR = """q AS (SELECT vec_id AS query_id, embedding::DOUBLE[] AS query FROM embeddings WHERE vec_id % 50 = 0),
  d AS (SELECT query_id, vec_id, label, round(greatest(0.0, least(2.0, 1 - list_dot_product(embedding::DOUBLE[], query) / (sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) * sqrt(list_dot_product(query, query))))), 9) AS distance FROM embeddings, q),
  r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS position FROM d)"""


def _asked(t: Tables) -> DataFrame:
    return t("embeddings").where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))


@query(f"WITH {_NEAR} SELECT query_id, vec_id, distance, position FROM r WHERE position <= 10")
def vector_search(t: Tables) -> DataFrame:
    from ..operators.similarity import nearest

    return nearest(t("embeddings"), _asked(t), 10).withColumn("position", F.col("position").cast("long"))


@query(f"""WITH {_NEAR} SELECT query_id, vec_id, r.label, distance, left(text, 80) AS snippet, quality FROM r LEFT JOIN documents ON doc_id = vec_id LEFT JOIN labels ON labels.doc_id = vec_id WHERE position <= 5""")
def rag_retrieval(t: Tables) -> DataFrame:
    from ..operators.similarity import nearest

    v = t("embeddings")
    hits = nearest(v, _asked(t), 5).join(v.select("vec_id", "label"), "vec_id")
    docs = t("documents").select(F.col("doc_id").alias("vec_id"), F.left("text", F.lit(80)).alias("snippet"))
    return hits.join(docs, "vec_id", "left").join(t("labels").select(F.col("doc_id").alias("vec_id"), "quality"), "vec_id", "left").select("query_id", "vec_id", "label", "distance", "snippet", "quality")
