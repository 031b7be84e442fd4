"""Enrichment and evaluation queries on the bound tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import url
from ..operators import enrich
from .bindings import Tables
from .marts import LATEST, query


@query("""WITH p AS (SELECT l.quality AS t, CASE WHEN n_chars >= 1500 THEN 1 ELSE 0 END AS g FROM labels l JOIN documents USING (doc_id)), a AS (SELECT t AS label, COUNT(*) AS support, COUNT(*) FILTER (WHERE t = g) AS hits FROM p GROUP BY 1), b AS (SELECT g AS label, COUNT(*) AS guessed FROM p GROUP BY 1),
  m AS (SELECT coalesce(a.label, b.label) AS label, coalesce(support, 0) AS support, coalesce(CASE WHEN guessed > 0 THEN coalesce(hits, 0) / guessed::DOUBLE END, 0.0) AS precision, coalesce(CASE WHEN support > 0 THEN hits / support::DOUBLE END, 0.0) AS recall FROM a FULL JOIN b USING (label))
  SELECT label, support, round(precision, 9)::DOUBLE AS precision, round(recall, 9)::DOUBLE AS recall, round(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END, 9)::DOUBLE AS f1 FROM m""")
def evaluation_by_class(t: Tables) -> DataFrame:
    guess = t("documents").select("doc_id", F.when(F.col("n_chars") >= 1500, 1).otherwise(0).alias("g"))
    out = enrich.evaluation(t("labels").join(guess, "doc_id"), "quality", "g")
    return out.select("label", "support", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")])


@query(f"""WITH {LATEST}, m AS (SELECT event_id, CAST(user_id AS VARCHAR) AS author_id, unnest([event_type, 'k' || json_extract_string(props, '$.k'), event_type]) AS target, unnest(['type', 'key', 'again']) AS kind, unnest([0, 1, 2]) AS rank FROM ev)
  SELECT event_id, author_id, target, arg_min(kind, rank) AS target_kind FROM m GROUP BY 1, 2, 3""")
def activation_fan_out(t: Tables) -> DataFrame:
    e = t.events().select("event_id", F.col("user_id").cast("string").alias("handle"), F.array("event_type").alias("types"), F.array(F.concat(F.lit("k"), F.get_json_object("props", "$.k"))).alias("keys"), F.array("event_type").alias("again"))
    return enrich.fan_out(e, "handle", {"types": "type", "keys": "key", "again": "again"}, ["event_id"])


@query()
def entity_sentiments(t: Tables) -> DataFrame:
    words = enrich.lexicon_scorer(["good", "the", "and"], ["bad", "idiot", "stupid", "trash", "scum"])
    named = F.transform(F.array(F.lit("license"), F.lit("the"), F.lit("idiot")), lambda n: F.struct(n.alias("entity"), F.lit("term").alias("entity_type")))
    return enrich.entity_sentiment(t("documents").select("doc_id", "text", named.alias("entities")), "doc_id", "text", "entities", words)


@query("""SELECT page_id, NOT contains(url, '?') AND NOT regexp_matches(p, '/(tag|category|categoria|author|autor|page|pagina)/') AND (regexp_matches(p, '/[0-9]{4}/[0-9]{1,2}/') OR len(parts) >= 3 OR length(coalesce(parts[len(parts)], '')) > 20) AS is_article
  FROM (SELECT *, list_filter(string_split(p, '/'), lambda x: x <> '') AS parts FROM (SELECT page_id, url, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)', 1) AS p FROM pages))""")
def sitemap_articles(t: Tables) -> DataFrame:
    return t("pages").select("page_id", url.looks_like_article(F.col("url")).alias("is_article"))


@query("""WITH c AS (SELECT doc_id AS vec_id, length(text) AS value FROM documents WHERE doc_id % 2 = 0) SELECT vec_id, coalesce(value, -1) AS value FROM embeddings LEFT JOIN c USING (vec_id)""")
def embedding_cache(t: Tables) -> DataFrame:
    cache = t("documents").where("doc_id % 2 = 0").select(F.col("doc_id").alias("vec_id"), F.length("text").cast("long").alias("value"))
    return enrich.cached(t("embeddings").select("vec_id"), cache, ["vec_id"], lambda missing: missing.withColumn("value", F.lit(-1).cast("long")))


@query("""SELECT conv_id, turn, CASE WHEN length(text) % 2 = 0 THEN 'user' END AS value, CASE WHEN length(text) % 2 = 0 THEN NULL ELSE 'unknown_value' END AS error FROM conversations""")
def strict_verdicts(t: Tables) -> DataFrame:
    body = F.to_json(F.struct(F.when(F.length("text") % 2 == 0, "user").otherwise("other").alias("stance")))
    return t("conversations").select("conv_id", "turn", enrich.strict_verdict(body, "stance", ["user", "assistant"]).alias("v")).select("conv_id", "turn", "v.value", "v.error")


@query("""SELECT source, COUNT(*) AS fetched, avg(CASE WHEN n_chars >= 200 THEN 1.0 ELSE 0.0 END)::DOUBLE AS success_rate, CASE WHEN COUNT(*) > 20 AND avg(CASE WHEN n_chars >= 200 THEN 1.0 ELSE 0.0 END) < 0.3 THEN 'nogo' ELSE 'go' END AS status FROM documents GROUP BY 1""")
def run_verdicts(t: Tables) -> DataFrame:
    runs = t("documents").groupBy("source").agg(F.count("*").alias("fetched"), F.avg(F.when(F.col("n_chars") >= 200, 1.0).otherwise(0.0)).alias("success_rate"))
    return runs.select("source", "fetched", "success_rate", enrich.verdict(F.col("fetched"), F.col("success_rate"), F.lit(0), F.lit(False))["status"].alias("status"))


@query("""WITH s AS (SELECT source, COUNT(*) AS n FROM documents GROUP BY 1 UNION ALL SELECT 'projected_' || k, 50 FROM range(5) r(k)), t AS (SELECT SUM(n) AS total FROM s) SELECT round(SUM((n * 1.0 / total) * (n * 1.0 / total)), 9)::DOUBLE AS hhi, COUNT(*) AS n_sources FROM s, t""")
def projected_diversity(t: Tables) -> DataFrame:
    from ..operators.tables import concentration

    more = t.spark.range(250).select(F.concat(F.lit("projected_"), F.col("id") % 5).alias("source"))
    return concentration(t("documents").select("source").unionByName(more), "source").select(F.round("hhi", 9).alias("hhi"), "n_sources")


@query()
def resolution_scores(t: Tables) -> DataFrame:
    c = t("customer")
    return c.select("c_custkey", enrich.resolution_confidence(F.concat_ws(" ", "c_name", "c_mktsegment"), F.col("c_name"), F.col("c_custkey") % 5 == 0).alias("confidence"))
