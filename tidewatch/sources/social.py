"""Social posts from raw JSON lines of four platforms, with a dead-letter table for what does not parse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import post_hash

#: Prefix of a platform's post ids.
PREFIX = {"facebook": "fb:", "instagram": "ig:", "tiktok": "tt:", "x": "x:"}
COLUMNS = ("post_id", "platform", "url", "handle", "display_name", "verified", "text", "language", "published_at", "likes", "comments", "shares", "views", "is_repost", "is_reply", "parent_post_id", "content_hash")


def _get(*paths: str) -> Column:
    """The first path of a JSON text that is there and not blank."""
    return F.coalesce(*[F.nullif(F.get_json_object("raw", f"$.{p}"), F.lit("")) for p in paths])


def _instant(*paths: str) -> Column:
    """ISO text, or seconds or milliseconds since 1970; null if neither (never the present)."""
    value = _get(*paths)
    number = value.try_cast("double")
    return F.when(number.isNotNull(), F.timestamp_micros((F.when(number > 1e10, number / 1000).otherwise(number) * 1e6).cast("long"))).otherwise(F.try_to_timestamp(value))


def _count(*paths: str) -> Column:
    return _get(*paths).try_cast("long")


def _flag(*paths: str) -> Column:
    return F.coalesce(F.lower(_get(*paths)) == "true", F.lit(False))


def _post(platform: str, **given: Column) -> DataFrame:
    none = {"is_repost": F.lit(False), "is_reply": F.lit(False), "parent_post_id": F.lit(None).cast("string"), "language": F.lit(None).cast("string"), "shares": F.lit(None).cast("long")}
    cols = none | given
    raw_id = cols["post_id"]
    cols["content_hash"] = post_hash(F.lit(platform), raw_id, cols["text"])
    cols["post_id"] = F.concat(F.lit(PREFIX[platform]), raw_id)
    cols["platform"] = F.lit(platform)
    return [cols[c].alias(c) for c in COLUMNS]


def _text(*paths: str) -> Column:
    return F.trim(F.coalesce(_get(*paths), F.lit("")))


def _parent(platform: str, *paths: str) -> Column:
    return F.concat(F.lit(PREFIX[platform]), _get(*paths))


def _facebook() -> tuple[Column, list[Column]]:
    at = _instant("time", "timestamp", "publishTime")
    reason = (
        F.when(_get("error").isNotNull() & _get("postId").isNull(), F.when(_get("error") == "not_available", "page_unavailable").otherwise("non_post_item"))
        .when(_get("postId").isNull() | _get("url").isNull() | at.isNull(), "schema_drift")
    )
    name = F.coalesce(_get("pageName", "userName", "user.name"), _get("user.id"))
    return reason, _post("facebook", post_id=_get("postId"), url=_get("url"), handle=_get("pageName", "user.profileUrl", "userName"), display_name=name, verified=_flag("pageVerified", "isVerified", "user.verified"), text=_text("text"), language=_get("language"), published_at=at, likes=_count("likes", "likesCount"), comments=_count("comments", "commentsCount"), shares=_count("shares", "sharesCount"), views=_count("viewsCount", "videoViewCount"), is_repost=_flag("isShared") | _get("sharedPostId").isNotNull(), parent_post_id=_parent("facebook", "sharedPostId", "parentPostId"))


def _instagram() -> tuple[Column, list[Column]]:
    pid, owner, at = _get("id", "pk", "postId", "shortCode", "shortcode"), _get("ownerUsername", "username", "owner.username"), _instant("timestamp", "takenAt", "taken_at", "takenAtTimestamp")
    link = F.coalesce(_get("url", "permalink", "postUrl"), F.concat(F.lit("https://www.instagram.com/p/"), _get("shortCode", "shortcode"), F.lit("/")))
    kind = _get("type")
    reason = F.when(pid.isNull() | (kind.isNotNull() & ~kind.isin("Image", "Video", "Sidecar", "GraphImage", "GraphVideo", "GraphSidecar", "Reel")), "non_post_item").when(owner.isNull() | at.isNull() | link.isNull(), "schema_drift")
    return reason, _post("instagram", post_id=pid, url=link, handle=owner, display_name=F.coalesce(_get("ownerFullName"), owner), verified=_flag("ownerVerified", "isVerified", "verified"), text=_text("caption"), published_at=at, likes=_count("likesCount"), comments=_count("commentsCount"), views=_count("videoViewCount"))


def _tiktok() -> tuple[Column, list[Column]]:
    at = _instant("createTimeISO", "createTime")
    sentinel = _get("noResults").isNotNull() | ((_get("note").isNotNull() | _get("error").isNotNull()) & _get("id").isNull()) | _flag("isSponsored") | _flag("isAd")
    reason = F.when(sentinel, "non_post_item").when(_get("id").isNull() | _get("authorMeta").isNull() | _get("webVideoUrl").isNull() | at.isNull(), "schema_drift")
    handle = _get("authorMeta.uniqueId", "authorMeta.name")
    return reason, _post("tiktok", post_id=_get("id"), url=_get("webVideoUrl"), handle=handle, display_name=F.coalesce(_get("authorMeta.nickName", "authorMeta.name"), handle), verified=_flag("authorMeta.verified"), text=_text("text"), language=_get("textLanguage", "locationLanguage"), published_at=at, likes=_count("diggCount"), comments=_count("commentCount"), shares=_count("shareCount"), views=_count("playCount"))


def _x() -> tuple[Column, list[Column]]:
    refs = F.coalesce(F.from_json(_get("referenced_tweets"), "array<struct<type:string,id:string>>"), F.array().cast("array<struct<type:string,id:string>>"))
    parent = F.try_element_at(F.filter(refs, lambda r: r["type"].isin("retweeted", "replied_to")), F.lit(1))
    handle, at = F.coalesce(_get("user.username"), F.lit("")), _instant("created_at")
    reason = F.when(_get("id").isNull() | F.get_json_object("raw", "$.text").isNull() | at.isNull(), "schema_drift")
    has = lambda kind: F.exists(refs, lambda r: r["type"] == kind)
    return reason, _post("x", post_id=_get("id"), url=F.concat(F.lit("https://x.com/"), handle, F.lit("/status/"), _get("id")), handle=handle, display_name=F.coalesce(_get("user.name"), handle), verified=_flag("user.verified"), text=_text("text"), language=_get("lang"), published_at=at, likes=_count("public_metrics.like_count"), comments=_count("public_metrics.reply_count"), shares=_count("public_metrics.retweet_count"), views=_count("public_metrics.impression_count"), is_repost=has("retweeted"), is_reply=has("replied_to"), parent_post_id=F.concat(F.lit(PREFIX["x"]), parent["id"]))


PLATFORMS = {"facebook": _facebook, "instagram": _instagram, "tiktok": _tiktok, "x": _x}


def expand_profiles(lines: DataFrame) -> DataFrame:
    """Profile items that nest their posts become a line for each post, with the profile's name and mark where the post has none."""
    posts = F.from_json(F.get_json_object("raw", "$.latestPosts"), "array<string>")
    nested = lines.where(F.get_json_object("raw", "$.latestPosts").isNotNull()).select(F.get_json_object("raw", "$.username").alias("u"), F.coalesce(F.get_json_object("raw", "$.isVerified"), F.get_json_object("raw", "$.verified"), F.lit("false")).alias("v"), F.explode_outer(posts).alias("post"))
    has = lambda *keys: F.coalesce(*[F.get_json_object("post", f"$.{k}") for k in keys]).isNotNull()
    name = F.when(has("ownerUsername", "username"), "").otherwise(F.concat(F.lit(',"username":"'), F.coalesce("u", F.lit("")), F.lit('"')))
    mark = F.when(has("ownerVerified", "isVerified", "verified"), "").otherwise(F.concat(F.lit(',"ownerVerified":'), "v"))
    filled = nested.where("post is not null").select(F.concat(F.expr("substring(post, 1, length(post) - 1)"), name, mark, F.lit("}")).alias("raw"))
    return lines.where(F.get_json_object("raw", "$.latestPosts").isNull()).select("raw").unionByName(filled)


def parse(lines: DataFrame, platform: str) -> tuple[DataFrame, DataFrame]:
    """(posts, dead letters) of JSON lines (column raw): every line is in exactly one of them."""
    if platform == "instagram":
        lines = expand_profiles(lines)
    reason, columns = PLATFORMS[platform]()
    broken = F.try_parse_json("raw").isNull()
    judged = lines.withColumn("reason", F.when(broken, "parse_error").otherwise(reason))
    posts = judged.where("reason is null").select(*columns)
    return posts, judged.where("reason is not null").select(F.lit(platform).alias("platform"), "reason", "raw")
