"""Text, classification, graph, identity and vector operators on the bound tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..components import scratch
from ..functions import overlay, privacy, responses, text, url
from ..operators import graph, identity, series, similarity, tables
from .bindings import Tables
from .marts import LATEST, ORACLES, query

#: Keywords of the synthetic corpus, as a stand-in for a newsroom's topics.
TOPICS = {"english": (" the ", " and ", " that "), "french": (" les ", " est ", " une "), "german": (" und ", " der ", " ist "), "spanish": (" los ", " del ", " una "), "contact": ("@", "http"), "license": ("license", "licensed")}


def _topic_sql() -> str:
    count = lambda words: " + ".join(f"(contains(body, '{w}'))::INT" for w in words)
    cols = ", ".join(f"{count(words)} AS c{k}" for k, words in enumerate(TOPICS.values()))
    most = "greatest(" + ", ".join(f"c{k}" for k in range(len(TOPICS))) + ")"
    pick = " ".join(f"WHEN c{k} = {most} THEN {{}}" for k in range(len(TOPICS)))
    ids, names = pick.format(*[k + 1 for k in range(len(TOPICS))]), pick.format(*[f"'{n}'" for n in TOPICS])
    return f"""WITH b AS (SELECT doc_id, lower(coalesce(text, '')) AS body FROM documents), c AS (SELECT doc_id, {cols} FROM b)
      SELECT doc_id, CASE WHEN {most} = 0 THEN -1 {ids} END AS topic_id, CASE WHEN {most} = 0 THEN NULL {names} END AS topic_label, CASE WHEN {most} = 0 THEN 'unclassified' ELSE 'keyword_map' END AS topic_id_source FROM c"""


@query(_topic_sql())
def keyword_topics(t: Tables) -> DataFrame:
    return t("documents").select("doc_id", text.keyword_topic(F.col("text"), TOPICS).alias("t")).select("doc_id", "t.*")


@query()
def cleaned_text(t: Tables) -> DataFrame:
    return t("documents").select("doc_id", text.clean_text(F.col("text")).alias("cleaned"))


@query()
def content_hashes(t: Tables) -> DataFrame:
    return t("documents").select("doc_id", text.content_hash(F.col("source"), F.col("text")).alias("content_hash"))


@query("SELECT doc_id, sha256(source || ':' || doc_id || ':' || text) AS content_hash FROM documents")
def post_hashes(t: Tables) -> DataFrame:
    return t("documents").select("doc_id", text.post_hash(F.col("source"), F.col("doc_id"), F.col("text")).alias("content_hash"))


@query("""WITH f AS (SELECT doc_id, text, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents WHERE doc_id % 5 <> 0)
  SELECT doc_id FROM f WHERE rn = 1 AND text NOT IN (SELECT text FROM documents WHERE doc_id % 5 = 0)""")
def deduplicated_batch(t: Tables) -> DataFrame:
    d = t("documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("content_hash"))
    fresh = tables.unseen(d.where("doc_id % 5 != 0"), d.where("doc_id % 5 = 0"), "content_hash")
    return tables.first_seen(fresh, [F.col("doc_id")], "content_hash").select("doc_id")


@query("""WITH p AS (SELECT page_id, url, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1) AS s, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) AS h,
    regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/+$', '') AS path, regexp_extract(url, '\\?([^#]*)', 1) AS q FROM pages),
  k AS (SELECT *, list_sort(list_filter(string_split(q, '&'), lambda x: regexp_matches(x, '^[^=]+=.+') AND lower(split_part(x, '=', 1)) NOT IN ('utm_source','utm_medium','utm_campaign','utm_content','utm_term','utm_id','utm_cid','fbclid','gclid','dclid','yclid','msclkid','mc_eid','mc_cid','ref','via','_ga','_gl','origem','canal','campanha'))) AS kept FROM p)
  SELECT page_id, lower(s) || '://' || CASE WHEN lower(s) = 'http' THEN regexp_replace(lower(h), ':80$', '') WHEN lower(s) = 'https' THEN regexp_replace(lower(h), ':443$', '') ELSE lower(h) END || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN len(kept) = 0 THEN '' ELSE '?' || array_to_string(kept, '&') END AS canonical_url FROM k""")
def canonical_urls(t: Tables) -> DataFrame:
    return t("pages").select("page_id", url.canonical_url(F.col("url")).alias("canonical_url"))


@query()
def blocked_pages(t: Tables) -> DataFrame:
    status = F.when(F.col("page_id") % 9 == 0, 403).otherwise(200)
    p = t("pages").select("page_id", status.alias("status"), "html").select("page_id", "status", responses.block_signals(F.col("status"), F.col("html")).alias("s"), F.length("html").alias("chars"))
    return p.select("page_id", "s.*", responses.failure_class(F.col("status"), F.col("s"), F.col("chars"), F.lit(None).cast("string")).alias("failure"))


@query()
def parsed_pages(t: Tables) -> DataFrame:
    from ..sources.html import article

    return t("pages").select("page_id", article(F.col("html")).alias("a")).select("page_id", "a.*")


@query()
def redacted_documents(t: Tables) -> DataFrame:
    return t("documents").select("doc_id", privacy.redact(F.col("text")).alias("r")).select("doc_id", F.sha2(F.col("r.text").cast("binary"), 256).alias("redacted_sha256"), "r.n_email", "r.n_phone", "r.n_cpf", "r.n_cnpj")


@query("""SELECT lang, CASE WHEN lang IN ('en', 'fr') THEN lang ELSE 'und' END AS language, CASE WHEN lang IN ('en', 'fr') THEN 'declared' ELSE 'unknown_code' END AS reason, COUNT(*) AS n FROM documents GROUP BY 1, 2, 3""")
def language_codes(t: Tables) -> DataFrame:
    return t("documents").groupBy("lang").agg(F.count("*").alias("n")).select("lang", text.language_code(F.col("lang"), ("en", "fr")).alias("c"), "n").select("lang", "c.language", "c.reason", "n")


@query("""WITH s AS (SELECT source, COUNT(*) AS n FROM documents GROUP BY 1), t AS (SELECT SUM(n) AS total FROM s) SELECT SUM((n * 1.0 / total) * (n * 1.0 / total))::DOUBLE AS hhi, COUNT(*) AS n_sources, arg_max(source, (n, source)) AS dominant, max(n * 1.0 / total)::DOUBLE AS dominant_share, max(n * 1.0 / total) > 0.70 AS alert FROM s, t""")
def source_diversity(t: Tables) -> DataFrame:
    return tables.concentration(t("documents"), "source").withColumns({"hhi": F.round("hhi", 9), "dominant_share": F.round("dominant_share", 9)})


ORACLES["source_diversity"] = "SELECT round(hhi, 9) AS hhi, n_sources, dominant, round(dominant_share, 9) AS dominant_share, alert FROM (" + ORACLES["source_diversity"] + ")"


@query("""WITH n AS (SELECT COUNT(*) AS n FROM documents) SELECT * FROM (SELECT unnest(['doc_id', 'text', 'lang', 'source', 'n_chars']) AS "column", unnest([count(*) FILTER (WHERE doc_id IS NULL), count(*) FILTER (WHERE text IS NULL OR trim(text) = ''), count(*) FILTER (WHERE lang IS NULL OR trim(lang) = ''), count(*) FILTER (WHERE source IS NULL OR trim(source) = ''), count(*) FILTER (WHERE n_chars IS NULL)]) / count(*)::DOUBLE AS null_rate, FALSE AS critical FROM documents)""")
def null_profile(t: Tables) -> DataFrame:
    return tables.null_profile(t("documents"))


@query()
def political_overlay(t: Tables) -> DataFrame:
    e = t.events()
    r = series.reach(e, "user_id", "ts")
    polarity = (250 - F.col("value")) / 250
    out = e.join(r, "user_id").select("event_id", overlay.classify(polarity, F.col("volume"), F.col("velocity"), (F.col("value") * 20).cast("long")).alias("c"))
    return out.select("event_id", "c.label", "c.confidence", "c.risk_score", F.size("c.factors").alias("n_factors"), "c.rule_version")


@query()
def overlay_shadow(t: Tables) -> DataFrame:
    """Two threshold sets side by side: how labels move from one to the other."""
    e = t.events().withColumn("polarity", (250 - F.col("value")) / 250)
    r = series.reach(e, "user_id", "ts")
    tight = overlay.Thresholds(polarity_negative=-0.5, velocity_spike=0.6)
    args = (F.col("polarity"), F.col("volume"), F.col("velocity"), (F.col("value") * 20).cast("long"))
    both = e.join(r, "user_id").select(overlay.classify(*args)["label"].alias("primary_label"), overlay.classify(*args, t=tight)["label"].alias("shadow_label"))
    return both.groupBy("primary_label", "shadow_label").agg(F.count("*").alias("n"))


@query(f"""WITH {LATEST}, r AS (SELECT user_id, COUNT(*) AS volume, (epoch_us(max(ts)) - epoch_us(min(ts))) / 3600000000.0::DOUBLE AS span_hours FROM ev GROUP BY 1)
  SELECT user_id, volume, span_hours, CASE WHEN volume < 2 THEN 0.1 WHEN span_hours <= 0 THEN 0.5 ELSE least(1.0, volume / span_hours / 5) END::DOUBLE AS velocity FROM r""")
def reach_signals(t: Tables) -> DataFrame:
    return series.reach(t.events(), "user_id", "ts")


@query(f"""WITH {LATEST}, w AS (SELECT *, (epoch_us(TIMESTAMP '2024-01-30') - epoch_us(ts)) / 3600000000.0::DOUBLE AS age FROM ev), i AS (SELECT * FROM w WHERE age BETWEEN 0 AND 48), n AS (SELECT COUNT(*) AS total FROM i),
  e AS (SELECT user_id, COUNT(*) AS n, avg(exp(-ln(2.0) * age / 12.0)) AS recency, max(age) - min(age) AS span FROM i GROUP BY 1)
  SELECT user_id, n, round(0.35 * least(ln(1 + n) / ln(1 + greatest(total, 10)), 1.0) + 0.40 * recency + 0.25 * CASE WHEN n < 2 THEN 0.1 WHEN span <= 0 THEN 0.5 ELSE least(1.0, n / span / 5) END, 6)::DOUBLE AS trend_score FROM e, n""")
def trend_scores(t: Tables) -> DataFrame:
    return series.trend(t.events(), "user_id", "ts", F.lit("2024-01-30").cast("timestamp"))


@query("""WITH p AS (SELECT doc_id, CASE WHEN n_chars >= 1500 THEN 1 ELSE 0 END AS guess FROM documents), j AS (SELECT quality AS truth, guess FROM labels JOIN p USING (doc_id)) SELECT truth, COUNT(*) FILTER (WHERE guess = 0) AS guessed_0, COUNT(*) FILTER (WHERE guess = 1) AS guessed_1 FROM j GROUP BY 1""")
def confusion_matrix(t: Tables) -> DataFrame:
    guess = t("documents").select("doc_id", F.when(F.col("n_chars") >= 1500, 1).otherwise(0).alias("guess"))
    return t("labels").join(guess, "doc_id").groupBy(F.col("quality").alias("truth")).agg(F.count_if(F.col("guess") == 0).alias("guessed_0"), F.count_if(F.col("guess") == 1).alias("guessed_1"))


#: A window of three hours on the bundled month: pairs that meet at one target in that time.
_COACT = """e AS (SELECT DISTINCT user_id AS author, CAST(json_extract_string(props, '$.k') AS BIGINT) AS target, ts FROM events), w AS (SELECT DISTINCT target, ts AS "end" FROM e),
  f AS (SELECT w.target, w."end", e.author, min(e.ts) AS ts FROM w JOIN e ON e.target = w.target AND e.ts <= w."end" AND epoch_us(w."end") - epoch_us(e.ts) <= 3 * 3600000000 GROUP BY 1, 2, 3),
  p AS (SELECT DISTINCT a.author AS author_a, b.author AS author_b, a.target, greatest(a.ts, b.ts) AS anchor FROM f a JOIN f b ON a.target = b.target AND a."end" = b."end" AND a.author < b.author),
  c AS (SELECT author_a, author_b, COUNT(*) AS n_overlap, COUNT(DISTINCT target) AS n_targets FROM p GROUP BY 1, 2), l AS (SELECT DISTINCT author, target FROM e), s AS (SELECT author, COUNT(*) AS size FROM l GROUP BY 1),
  h AS (SELECT c.author_a, c.author_b, COUNT(*) AS shared FROM c JOIN l x ON x.author = c.author_a JOIN l y ON y.author = c.author_b AND y.target = x.target GROUP BY 1, 2),
  pairs AS (SELECT c.*, shared / (x.size + y.size - shared)::DOUBLE AS jaccard FROM c JOIN h USING (author_a, author_b) JOIN s x ON x.author = c.author_a JOIN s y ON y.author = c.author_b)"""


@query(f"WITH {_COACT} SELECT author_a, author_b, n_overlap, n_targets, jaccard FROM pairs")
def coactivation_pairs(t: Tables) -> DataFrame:
    return graph.coactivation(t.activations(), window_hours=3, min_overlap=1)


@query(f"WITH {_COACT} SELECT author_a, author_b, least(n_overlap / 20.0, 1.0)::DOUBLE AS synchrony_score, jaccard AS alignment_score, round((0.4 * least(n_overlap / 20.0, 1.0) + 0.4 * jaccard) / 0.8, 9)::DOUBLE AS composite_score FROM pairs")
def pair_scores(t: Tables) -> DataFrame:
    return graph.pair_scores(coactivation_pairs(t)).select("author_a", "author_b", "synchrony_score", "alignment_score", F.round("composite_score", 9).alias("composite_score"))


def _daily(t: Tables, **how) -> DataFrame:
    """Communities of each day's pairs, found where the day's events are."""
    return graph.window_communities(t.activations().withColumn("day", F.col("ts").cast("date")), window_hours=3, min_overlap=1, **how)


@query()
def communities_louvain(t: Tables) -> DataFrame:
    return _daily(t).withColumn("author", F.col("author").cast("long"))


@query()
def communities_labels(t: Tables) -> DataFrame:
    return _daily(t, algorithm="label_propagation").withColumn("author", F.col("author").cast("long"))


@query()
def community_scores(t: Tables) -> DataFrame:
    return _daily(t, scored=True)


@query()
def cluster_series(t: Tables) -> DataFrame:
    # The graphs are many times the work of their members' rows, which several steps read.
    return graph.track(scratch(_daily(t, plain=True), "members"), threshold=0.3)


@query("""WITH RECURSIVE e AS (SELECT DISTINCT n_nationkey + 1000 AS a, n_regionkey AS b FROM nation UNION SELECT c_nationkey + 1000, c_custkey + 10000 FROM customer), u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
  r(id, reach) AS (SELECT a, a FROM u UNION SELECT r.id, u.b FROM r JOIN u ON u.a = r.reach) SELECT id, min(reach) AS component FROM r GROUP BY 1""")
def connected_components(t: Tables) -> DataFrame:
    e = t("nation").select((F.col("n_nationkey") + 1000).cast("long").alias("a"), F.col("n_regionkey").cast("long").alias("b")).union(t("customer").select((F.col("c_nationkey") + 1000).cast("long"), F.col("c_custkey") + 10000))
    return graph.connected(e)


@query()
def personas(t: Tables) -> DataFrame:
    name = lambda c: F.regexp_replace(F.lower(c), r"[^a-z0-9]", "_")
    a = t("customer").select(F.concat(F.lit("c"), "c_custkey").alias("author_key"), F.lit("customer").alias("platform"), name(F.col("c_name")).alias("handle"), F.col("c_name").alias("display_name"))
    b = t("supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("author_key"), F.lit("supplier").alias("platform"), name(F.replace("s_name", F.lit("Supplier"), F.lit("Customer"))).alias("handle"), F.col("s_name").alias("display_name"))
    return identity.personas(a.unionByName(b))


@query()
def gazetteer_mentions(t: Tables) -> DataFrame:
    names = t.spark.createDataFrame([("General Public License", "gpl", "license"), ("MIT License", "mit", "license"), ("Apache License", "apache", "license"), ("All rights reserved", "reserved", "notice")], "name string, entity string, kind string")
    d = t("documents")
    return identity.gazetteer(d, "doc_id", F.col("text"), names)


@query(r"""WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS w, lower(text) AS body FROM documents WHERE text IS NOT NULL), p AS (SELECT doc_id, w, unnest(range(0, len(w))) AS pos FROM w),
  h AS (SELECT doc_id, CASE WHEN w[pos + 1] = 'general' AND w[pos + 2] = 'public' AND w[pos + 3] = 'license' THEN 'gpl' WHEN w[pos + 1] = 'mit' AND w[pos + 2] = 'license' THEN 'mit' WHEN w[pos + 1] = 'apache' AND w[pos + 2] = 'license' THEN 'apache'
    WHEN w[pos + 1] = 'license' AND NOT coalesce(w[pos] IN ('mit', 'apache') OR (w[pos] = 'public' AND w[pos - 1] = 'general'), FALSE) THEN 'plain' END AS entity FROM p), g AS (SELECT doc_id, list_sort(list(DISTINCT entity) FILTER (WHERE entity IN ('gpl', 'mit', 'apache'))) AS notice, list_sort(list(DISTINCT entity) FILTER (WHERE entity = 'plain')) AS word FROM h WHERE entity IS NOT NULL GROUP BY 1)
  SELECT d.doc_id, coalesce(notice, []) AS notice, coalesce(word, []) AS word, CAST([] AS VARCHAR[]) AS persons, len(coalesce(notice, [])) > 0 AS is_relevant FROM documents d LEFT JOIN g USING (doc_id)""")
def entity_extraction(t: Tables) -> DataFrame:
    """Longest names first: a license inside of a named license is no entity of its own."""
    names = t.spark.createDataFrame([("General Public License", "gpl", "notice"), ("MIT License", "mit", "notice"), ("Apache License", "apache", "notice"), ("license", "plain", "word")], "name string, entity string, kind string")
    return identity.extract(t("documents"), "doc_id", F.col("text"), names, ["notice", "word"], ["notice"])


@query()
def resolved_people(t: Tables) -> DataFrame:
    people = t("customer").select(F.col("c_custkey").alias("person_id"), F.col("c_name").alias("name"), F.concat(F.lit("c"), "c_custkey").alias("handle"), F.col("c_mktsegment").alias("city"), F.lit(None).cast("string").alias("party"))
    m = t("customer").select(F.col("c_custkey").alias("mention_id"), F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("C"), "c_custkey")).alias("handle"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("context"))
    return identity.resolve_people(m, people).drop("candidates")


@query(f"""WITH {LATEST} SELECT user_id % 20 AS content_id, CASE WHEN bool_or(event_type = 'view') THEN 1 END AS person_id, CASE WHEN bool_or(event_type = 'view') THEN 0.9 WHEN bool_or(event_type = 'click') THEN 0.55 ELSE 0.0 END::DOUBLE AS confidence,
  CASE WHEN bool_or(event_type = 'view') THEN 'IN_SCOPE' WHEN bool_or(event_type = 'click') THEN 'AMBIGUOUS' ELSE 'OUT_OF_SCOPE' END AS status FROM ev GROUP BY 1""")
def resolved_contents(t: Tables) -> DataFrame:
    """Several mentions a content: an alias in a corroborating context, a namesake in another one, an unknown name."""
    people = t.spark.createDataFrame([(1, "Maria Silva", "maria", "Natal", "ABC", ["Dona Maria"], "mayor", True), (2, "Joao Souza", "joao", "Caico", "XYZ", [], "governor", False)], "person_id int, name string, handle string, city string, party string, aliases array<string>, role string, is_incumbent boolean")
    kind = F.col("event_type")
    m = t.events().select(F.col("event_id").alias("mention_id"), (F.col("user_id") % 20).alias("content_id"), F.lit(None).cast("string").alias("handle"), F.when(kind == "view", "DONA MARIA").when(kind == "click", "João Souza").otherwise("Nobody").alias("name"), F.when(kind == "view", "em Natal hoje").otherwise("longe").alias("context"))
    return identity.resolve_best(identity.resolve_people(m, people).join(m.select("mention_id", "content_id"), "mention_id"), "content_id")


@query("""WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings), n AS (SELECT *, sqrt(list_dot_product(x, x)) AS len FROM v),
  p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.label = b.label AND a.vec_id < b.vec_id WHERE list_dot_product(a.x, b.x) / (a.len * b.len) >= 0.75), u AS (SELECT a, b FROM p UNION SELECT b, a FROM p),
  r(id, reach) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.id, u.b FROM r JOIN u ON u.a = r.reach), c AS (SELECT id, min(reach) AS component FROM r GROUP BY 1), s AS (SELECT component, COUNT(*) AS size FROM c GROUP BY 1)
  SELECT label, vec_id, CASE WHEN size >= 3 THEN component ELSE -1 END AS cluster, CASE WHEN size >= 3 THEN size ELSE 1 END AS size FROM v JOIN c ON c.id = v.vec_id JOIN s USING (component)""")
def narrative_clusters(t: Tables) -> DataFrame:
    return similarity.cosine_clusters(t("embeddings"), "label")


@query()
def centroid_roles(t: Tables) -> DataFrame:
    return similarity.centroid_roles(t("embeddings"), "label")


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS verdict, CASE WHEN json_extract_string(props, '$.k') IS NULL THEN 'invalid' END AS error FROM events""")
def strict_json(t: Tables) -> DataFrame:
    parsed = F.from_json("props", "k long")
    return t("events").select("event_id", parsed["k"].alias("verdict"), F.when(parsed["k"].isNull(), "invalid").alias("error"))
