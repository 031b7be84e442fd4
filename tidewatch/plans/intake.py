"""Intake on the bound tables: social adapters and dead letters, the URL frontier, cool-downs, feed health, compaction."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..components import shared_dir
from ..sources import social
from ..sources import tables as files
from .bindings import AS_OF, Tables
from ..streaming import events as streams
from .marts import LATEST, ORACLES, QUERIES, query

_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"


def _item(platform: str) -> Column:
    """An event as the platform's own JSON item."""
    pid, user = F.col("event_id").cast("string"), F.concat(F.lit("u"), "user_id")
    name, even, likes, k = F.concat(F.lit("User "), "user_id"), F.col("user_id") % 2 == 0, F.floor("value"), F.get_json_object("props", "$.k").cast("long")
    iso, epoch = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.unix_seconds(F.col("ts").cast("timestamp"))
    items = {
        "facebook": {"postId": pid, "url": F.concat(F.lit("https://f/"), pid), "time": iso, "pageName": user, "pageVerified": even, "text": F.col("event_type"), "likes": likes, "comments": k, "shares": F.lit(3)},
        "instagram": {"id": pid, "type": F.lit("Image"), "url": F.concat(F.lit("https://i/"), pid), "timestamp": iso, "ownerUsername": user, "ownerFullName": name, "ownerVerified": even, "caption": F.col("event_type"), "likesCount": likes, "commentsCount": k},
        "tiktok": {"id": pid, "webVideoUrl": F.concat(F.lit("https://t/"), pid), "createTime": epoch, "authorMeta": F.struct(user.alias("uniqueId"), name.alias("nickName"), even.alias("verified")), "text": F.col("event_type"), "diggCount": likes, "commentCount": k, "shareCount": F.lit(3)},
        "x": {"id": pid, "text": F.col("event_type"), "created_at": iso, "user": F.struct(user.alias("username"), name.alias("name"), even.alias("verified")), "public_metrics": F.struct(likes.alias("like_count"), k.alias("reply_count"), F.lit(3).alias("retweet_count")), "lang": F.lit("pt")},
    }
    return F.to_json(F.struct(*[c.alias(n) for n, c in items[platform].items()]))


def _lines(t: Tables, platform: str) -> DataFrame:
    """Every tenth line is no JSON, every tenth lacks its id."""
    whole = _item(platform)
    cut = F.regexp_replace(whole, r'"(postId|id)":"\d+",', "")
    return t.events().select(F.when(F.col("event_id") % 10 == 0, F.concat(F.lit("{"), whole)).when(F.col("event_id") % 10 == 1, cut).otherwise(whole).alias("raw"))


_SHOWN = ("post_id", "url", "handle", "display_name", "verified", "text", "likes", "comments", "shares", "is_repost", "content_hash")
_URL = {"facebook": "'https://f/' || event_id", "instagram": "'https://i/' || event_id", "tiktok": "'https://t/' || event_id", "x": "'https://x.com/u' || user_id || '/status/' || event_id"}


def _register(platform: str) -> None:
    def plan(spark, sf_dir: str) -> DataFrame:
        posts, _ = social.parse(_lines(Tables(spark, sf_dir), platform), platform)
        return posts.select(*_SHOWN, F.unix_seconds("published_at").alias("published_s"))

    name = "'u' || user_id" if platform == "facebook" else "'User ' || user_id"
    QUERIES[f"social_posts_{platform}"] = plan
    ORACLES[f"social_posts_{platform}"] = f"""WITH {LATEST} SELECT '{social.PREFIX[platform]}' || event_id AS post_id, {_URL[platform]} AS url, 'u' || user_id AS handle, {name} AS display_name, user_id % 2 = 0 AS verified, event_type AS text, CAST(floor(value) AS BIGINT) AS likes, {_K} AS comments,
      {"CAST(NULL AS BIGINT)" if platform == "instagram" else "CAST(3 AS BIGINT)"} AS shares, FALSE AS is_repost, sha256('{platform}:' || event_id || ':' || event_type) AS content_hash, CAST(floor(epoch(ts)) AS BIGINT) AS published_s FROM ev WHERE event_id % 10 > 1"""


for _platform in social.PREFIX:
    _register(_platform)


@query(f"""WITH {LATEST}, p AS (SELECT unnest(['facebook', 'instagram', 'tiktok', 'x']) AS platform)
  SELECT platform, CASE WHEN event_id % 10 = 0 THEN 'parse_error' WHEN platform = 'instagram' THEN 'non_post_item' ELSE 'schema_drift' END AS reason, COUNT(*) AS n FROM ev CROSS JOIN p WHERE event_id % 10 < 2 GROUP BY 1, 2""")
def social_dead_letters(t: Tables) -> DataFrame:
    dead = reduce(DataFrame.unionByName, [social.parse(_lines(t, p), p)[1] for p in social.PREFIX])
    return dead.groupBy("platform", "reason").agg(F.count("*").alias("n"))


def _frontier(t: Tables) -> DataFrame:
    """The URL frontier as some runs have left it."""
    at = F.timestamp_seconds(F.lit(1704067200) + F.col("page_id") * 3600)
    status = F.element_at(F.array(*[F.lit(s) for s in ("pending", "in_progress", "failed", "done")]), (F.col("page_id") % 4 + 1).cast("int"))
    return t("pages").select(F.concat(F.lit("u"), "page_id").alias("url"), F.lit("feed").alias("source_feed"), F.lit(None).cast("string").alias("title"), F.when(F.col("page_id") % 8 != 0, at).alias("published_at"), status.alias("status"), (F.col("page_id") % 5).cast("int").alias("attempt_count"), F.when(F.col("page_id") % 4 != 0, at).alias("last_attempt_at"))


_FRONTIER = """f AS (SELECT 'u' || page_id AS url, page_id, ['pending', 'in_progress', 'failed', 'done'][page_id % 4 + 1] AS status, CAST(page_id % 5 AS INT) AS attempt_count, CASE WHEN page_id % 8 <> 0 THEN TIMESTAMP '2024-01-01' + to_hours(CAST(page_id AS INT)) END AS published_at,
  CASE WHEN page_id % 4 <> 0 THEN TIMESTAMP '2024-01-01' + to_hours(CAST(page_id AS INT)) END AS last_attempt_at FROM pages)"""


@query(f"WITH {_FRONTIER} SELECT url FROM f WHERE status = 'pending' ORDER BY published_at DESC NULLS LAST, url LIMIT 20")
def frontier_claimed(t: Tables) -> DataFrame:
    claimed, _ = files.frontier_claim(_frontier(t), f"{AS_OF} 00:00:00", 20)
    return claimed.select("url")


@query(f"WITH {_FRONTIER} SELECT CASE WHEN status = 'in_progress' AND last_attempt_at < TIMESTAMP '2024-01-05' - INTERVAL 2 HOUR THEN 'pending' ELSE status END AS status, COUNT(*) AS n FROM f GROUP BY 1")
def frontier_after_reset(t: Tables) -> DataFrame:
    return files.frontier_stats(files.frontier_reset_stale(_frontier(t), "2024-01-05 00:00:00"))


@query(f"WITH {_FRONTIER} SELECT url, attempt_count FROM f WHERE status = 'failed' AND attempt_count < 3")
def frontier_retries(t: Tables) -> DataFrame:
    return files.frontier_retryable(_frontier(t)).select("url", "attempt_count")


@query(f"WITH {_FRONTIER} SELECT url, status FROM f WHERE NOT (status IN ('done', 'failed') AND coalesce(last_attempt_at < TIMESTAMP '2024-02-05' - INTERVAL 30 DAY, FALSE))")
def frontier_purged(t: Tables) -> DataFrame:
    return files.frontier_purge(_frontier(t), "2024-02-05 00:00:00").select("url", "status")


@query(f"WITH {_FRONTIER}, n AS (SELECT DISTINCT 'u' || doc_id AS url FROM documents) SELECT url, status FROM f UNION ALL SELECT url, 'pending' FROM n WHERE url NOT IN (SELECT url FROM f)")
def frontier_grown(t: Tables) -> DataFrame:
    found = t("documents").select(F.concat(F.lit("u"), "doc_id").alias("url"), F.col("source").alias("source_feed"), F.lit(None).cast("string").alias("title"), F.lit(None).cast("timestamp").alias("published_at"))
    return files.frontier_add(_frontier(t), found).select("url", "status")


def _fetches(t: Tables) -> DataFrame:
    return t.events().select(F.col("user_id").alias("domain"), F.col("user_id").alias("feed"), F.col("ts").alias("at"), (F.col("value") < 40).alias("ok"), F.col("value").alias("latency_ms"))


@query(f"""WITH {LATEST}, f AS (SELECT user_id AS domain, ts AS fetched_at, value < 40 AS ok FROM ev), s AS (SELECT *, sum(ok::INT) OVER (PARTITION BY domain ORDER BY fetched_at) AS island FROM f), r AS (SELECT *, sum((NOT ok)::INT) OVER (PARTITION BY domain, island ORDER BY fetched_at) AS streak FROM s)
  SELECT domain, fetched_at, ok, CAST(streak AS BIGINT) AS consecutive_failures, CAST(CASE WHEN streak >= 3 THEN least(3600, 900 * pow(2, streak - 3)) ELSE 0 END AS BIGINT) AS cooldown_seconds FROM r""")
def fetch_cooldowns(t: Tables) -> DataFrame:
    return files.cooldowns(_fetches(t)).select("domain", F.col("at").alias("fetched_at"), "ok", "consecutive_failures", "cooldown_seconds")


@query(f"""WITH {LATEST}, f AS (SELECT user_id AS feed, ts, value < 40 AS ok, value FROM ev), l AS (SELECT feed, max(ts) FILTER (WHERE ok) AS last_ok FROM f GROUP BY 1)
  SELECT feed, round(avg(ok::INT), 6) AS availability, round(CAST(SUM(CAST(value AS DECIMAL(18,4))) AS DOUBLE) / COUNT(*), 6) AS avg_latency_ms, COUNT(*) FILTER (WHERE last_ok IS NULL OR ts > last_ok) AS consecutive_failures FROM f JOIN l USING (feed) GROUP BY 1""")
def feed_health(t: Tables) -> DataFrame:
    return files.feed_health(_fetches(t)).select("feed", F.round("availability", 6).alias("availability"), F.round("avg_latency_ms", 6).alias("avg_latency_ms"), "consecutive_failures")


@query(f"""WITH {LATEST} SELECT event_type, user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC) AS r FROM ev) WHERE r = 1""")
def compacted_events(t: Tables) -> DataFrame:
    return files.compact(t.events(), "user_id", "ts", "event_type", files=4).select("event_type", "user_id", "event_id")


@query(f"""WITH {LATEST} SELECT DISTINCT user_id FROM ev WHERE ts > TIMESTAMP '2024-01-29 12:00:00'""")
def recent_authors(t: Tables) -> DataFrame:
    return files.recent_ids(t.events(), "user_id", "ts", F.lit("2024-01-29 12:00:00").cast("timestamp_ntz"))


@query("""SELECT * FROM (VALUES ('ingested_at', 'extra', NULL, 'date'), ('text', 'missing', 'string', NULL), ('doc_id', 'type', 'int', 'bigint')) v("column", kind, expected, found)""")
def schema_drift(t: Tables) -> DataFrame:
    from pyspark.sql.types import IntegerType, StructField, StructType

    d = t("documents")
    want = StructType([StructField(f.name, IntegerType() if f.name == "doc_id" else f.dataType) for f in d.schema.fields])
    return files.drift(d.drop("text").withColumn("ingested_at", F.lit(AS_OF).cast("date")), want)


def _messages(t: Tables) -> tuple[DataFrame, str]:
    """The events as a stream of base64 messages, each delivered twice and every seventh damaged; and a folder for its state."""
    base = f"{shared_dir(t.spark)}/stream-{uuid.uuid4().hex}"
    body = F.to_json(F.struct(F.concat(F.lit("h"), "event_id").alias("content_hash"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("published_at"), F.col("user_id").alias("person_id"), F.col("event_type").alias("source_type"), F.lit("text").alias("text"), F.col("value").alias("engagement")))
    coded = F.base64(F.when(F.col("event_id") % 7 == 0, F.lit("{")).otherwise(body).cast("binary"))
    once = t.events().select(F.regexp_replace(coded, r"\s", "").alias("value"))
    once.unionByName(once).write.text(f"{base}/in")
    return streams.file_stream(t.spark, f"{base}/in", "value string", "text"), base


def _labelled(batch: DataFrame) -> DataFrame:
    """What each message goes through on its way: the scope rule and the label."""
    return batch.withColumns({"in_scope": F.col("engagement") >= 50, "label": F.when(F.col("engagement") >= 250, "ALERT").when(F.col("engagement") >= 100, "WARNING").otherwise("FAVORABLE")})


@query(f"""WITH {LATEST} SELECT 'h' || event_id AS content_hash, user_id AS person_id, event_type AS source_type, value AS engagement, value >= 50 AS in_scope, CASE WHEN value >= 250 THEN 'ALERT' WHEN value >= 100 THEN 'WARNING' ELSE 'FAVORABLE' END AS label FROM ev WHERE event_id % 7 <> 0""")
def stream_upserts(t: Tables) -> DataFrame:
    raw, base = _messages(t)
    good, _ = streams.decode_messages(raw)
    streams.upsert_stream(streams.deduplicated(good, delay="40 days"), f"{base}/out", f"{base}/state", "content_hash", _labelled).awaitTermination()
    return streams.read_upserts(t.spark, f"{base}/out", "content_hash").select("content_hash", "person_id", "source_type", "engagement", "in_scope", "label")


@query(f"WITH {LATEST} SELECT DISTINCT 'ew==' AS payload FROM ev WHERE event_id % 7 = 0")
def stream_rejected(t: Tables) -> DataFrame:
    raw, base = _messages(t)
    _, bad = streams.decode_messages(raw)
    streams.upsert_stream(bad, f"{base}/out", f"{base}/state", "payload").awaitTermination()
    return streams.read_upserts(t.spark, f"{base}/out", "payload").select("payload")
