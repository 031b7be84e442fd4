"""Enrichment with pluggable scorers: sentence and entity sentiment, fan-out, caches, evaluation, run verdicts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import fold_accents, sentences

#: Sentences that count for an entity.
MOST_SENTENCES = 5
#: Weights of a resolution's evidence: handle, name, dictionary, biography.
EVIDENCE = (0.30, 0.45, 0.15, 0.10)


def lexicon_scorer(positive: Sequence[str], negative: Sequence[str]) -> Callable[[Column], Column]:
    """The default scorer: (positive - negative) / (positive + negative) words, 0 without any. A model's UDF can take its place."""

    def score(text: Column) -> Column:
        words = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}]+"), F.lit(0))
        count = lambda of: F.size(F.filter(words, lambda w: w.isin(*of)))
        up, down = count(positive), count(negative)
        return F.when(up + down == 0, 0.0).otherwise((up - down) / (up + down))

    return score


def star_label(label: Column, score: Column) -> Column:
    """A model's label on a scale from -1 to 1: stars, or a signed confidence."""
    stars = F.regexp_extract(label, r"(\d)", 1)
    named = F.lower(label)
    return F.when(stars != "", (stars.try_cast("int") - 3) / 2.0).when(F.contains(named, F.lit("positive")), F.round(score, 4)).when(F.contains(named, F.lit("negative")), -F.round(score, 4)).otherwise(0.0)


def entity_sentiment(docs: DataFrame, key: str, text: str, entities: str, scorer: Callable[[Column], Column]) -> DataFrame:
    """Sentiment of each entity of a text: the mean of the first sentences that name it, else the text's own.

    ``entities``: array of (entity, entity_type). Columns: key, entity, entity_type, sentiment,
    mention_count, sentiment_source.
    """
    scored = F.transform(sentences(F.col(text)), lambda s: F.named_struct(F.lit("body"), F.lower(s), F.lit("score"), scorer(s)))
    d = docs.select(key, scorer(F.col(text)).alias("overall"), scored.alias("sentences"), F.explode(entities).alias("e"))
    hits = F.filter("sentences", lambda s: F.contains(s["body"], F.lower(F.col("e.entity"))))
    first = F.slice("hits", 1, MOST_SENTENCES)
    mean = F.aggregate(first, F.lit(0.0), lambda a, s: a + s["score"]) / F.greatest(F.size(first), F.lit(1))
    out = d.select(key, "overall", F.col("e.entity").alias("entity"), F.col("e.entity_type").alias("entity_type"), hits.alias("hits"))
    own = F.size("hits") > 0
    return out.select(key, "entity", "entity_type", F.round(F.when(own, mean).otherwise(F.col("overall")), 4).alias("sentiment"), F.size("hits").alias("mention_count"), F.when(own, "entity").otherwise("document").alias("sentiment_source"))


def fan_out(posts: DataFrame, author: str, mentions: dict[str, str], carry: Sequence[str]) -> DataFrame:
    """A row for each (post, target): the first kind in the given order wins, blank targets and posts without author go."""

    def named(k: int, kind: str):
        return lambda n: F.struct(F.lit(k).alias("rank"), F.lit(kind).alias("kind"), n.alias("target"))

    every = F.concat(*[F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), named(k, kind)) for k, (c, kind) in enumerate(mentions.items())])
    rows = posts.where(F.coalesce(F.col(author), F.lit("")) != "").select(*carry, F.col(author).alias("author_id"), F.explode(F.filter(every, lambda m: F.coalesce(m["target"], F.lit("")) != "")).alias("m"))
    return rows.groupBy(*carry, "author_id", F.col("m.target").alias("target")).agg(F.min_by("m.kind", "m.rank").alias("target_kind"))


def cached(rows: DataFrame, cache: DataFrame, keys: Sequence[str], compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Values from the cache where it has the keys, computed for the distinct rest; ``compute`` returns keys and value."""
    known = rows.join(cache, list(keys), "inner")
    missing = rows.join(cache.select(*keys), list(keys), "left_anti")
    return known.unionByName(missing.join(compute(missing.dropDuplicates(list(keys))), list(keys)))


def name_recall(name: Column, target: Column) -> Column:
    """Share of a target's name tokens that a name has."""
    tokens = lambda c: F.array_distinct(F.filter(F.split(fold_accents(F.coalesce(c, F.lit(""))), r"[^a-z0-9]+"), lambda t: F.length(t) > 1))
    want = tokens(target)
    return F.when(F.size(want) == 0, 0.0).otherwise(F.size(F.array_intersect(tokens(name), want)) / F.greatest(F.size(want), F.lit(1)))


def resolution_confidence(name: Column, target: Column, handle_matched: Column, bio: Column | None = None) -> Column:
    """Weighted evidence that a name is a target, 0 to 1."""
    handle = F.coalesce(handle_matched, F.lit(False))
    recall = name_recall(name, target)
    listed = F.when(handle | (fold_accents(name) == fold_accents(target)), 1.0).when(recall >= 0.5, 0.5).otherwise(0.0)
    told = F.lit(0.0) if bio is None else name_recall(bio, target)
    h, n, d, b = EVIDENCE
    return F.round(F.least(F.greatest(h * handle.cast("double") + n * recall + d * listed + b * told, F.lit(0.0)), F.lit(1.0)), 4)


def evaluation(pairs: DataFrame, truth: str, guess: str) -> DataFrame:
    """Per class: support, precision, recall, F1; one grouped pass, then arithmetic on a row a class."""
    cells = pairs.groupBy(F.col(truth).alias("t"), F.col(guess).alias("g")).agg(F.count("*").alias("n"))
    right = F.sum(F.when(F.col("t") == F.col("g"), F.col("n")).otherwise(0))
    by_truth = cells.groupBy(F.col("t").alias("label")).agg(F.sum("n").alias("support"), right.alias("hits"))
    by_guess = cells.groupBy(F.col("g").alias("label")).agg(F.sum("n").alias("guessed"))
    both = by_truth.join(by_guess, "label", "full_outer").na.fill(0, ["support", "hits", "guessed"])
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    out = both.select("label", "support", share("hits", "guessed").alias("precision"), share("hits", "support").alias("recall"))
    total = F.col("precision") + F.col("recall")
    return out.withColumn("f1", F.when(total > 0, 2 * F.col("precision") * F.col("recall") / total).otherwise(0.0))


def transitions(pairs: DataFrame, before: str, after: str) -> DataFrame:
    return pairs.groupBy(before, after).agg(F.count("*").alias("n"))


def verdict(fetched: Column, success_rate: Column, cooldowns: Column, warning: Column) -> Column:
    """(status, reasons) of a run."""
    reasons = F.filter(F.array(F.when(warning, "integrity_warning"), F.when((fetched > 20) & (success_rate < 0.3), "low_extraction_success_rate"), F.when((fetched > 0) & (cooldowns / F.greatest(fetched, F.lit(1)) > 0.5), "excessive_cooldown")), lambda r: r.isNotNull())
    return F.struct(F.when(F.size(reasons) > 0, "nogo").otherwise("go").alias("status"), reasons.alias("reasons"))


def strict_verdict(body: Column, field: str, accepted: Sequence[str], fallback: str | None = None) -> Column:
    """(value, error) of a model's JSON answer: an answer outside the accepted ones is the fallback, or an error."""
    value = F.get_json_object(body, f"$.{field}")
    ok = value.isin(*accepted)
    return F.struct(F.when(ok, value).otherwise(F.lit(fallback)).alias("value"), F.when(F.coalesce(ok, F.lit(False)) | F.lit(fallback is not None), None).otherwise(F.when(value.isNull(), "invalid_json").otherwise("unknown_value")).alias("error"))
