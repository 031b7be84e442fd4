"""Who is who: personas across platforms, people named in texts, gazetteers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache, reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..components import scratch
from ..functions.text import fold_accents
from .graph import connected


@lru_cache(maxsize=1 << 16)
def jaro_winkler_score(a: str, b: str, scale: float = 0.1) -> float:
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    used, pairs = [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                pairs.append(c)
                break
    m = len(pairs)
    if not m:
        return 0.0
    swapped = sum(x != y for x, y in zip(pairs, (c for c, u in zip(b, used, strict=True) if u), strict=True)) / 2
    jaro = (m / len(a) + m / len(b) + (m - swapped) / m) / 3
    prefix = 0
    for x, y in zip(a[:4], b[:4], strict=False):
        if x != y:
            break
        prefix += 1
    return jaro + prefix * scale * (1 - jaro)


@F.pandas_udf(DoubleType())
def jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    """Arrow batches: Spark has no such distance."""
    return pd.Series([None if x is None or y is None else jaro_winkler_score(x, y) for x, y in zip(a, b, strict=True)])


def persona_pairs(authors: DataFrame) -> DataFrame:
    """The accounts that ``personas`` compares: author keys, handles and folded names (_l, _r), n_shared (content hashes), enumerated."""
    hashes = F.col("content_hashes") if "content_hashes" in authors.columns else F.lit(None).cast("array<string>")
    a = authors.select("author_key", "platform", F.coalesce(hashes, F.array().cast("array<string>")).alias("hashes"), F.lower(F.trim("handle")).alias("handle"), fold_accents(F.trim(F.coalesce("display_name", F.lit("")))).alias("name"))
    stem = F.regexp_replace("handle", r"[^a-z]", "")
    content = F.transform(F.filter("hashes", lambda h: h != ""), lambda h: F.concat(F.lit("c:"), h))
    keys = F.array_distinct(F.filter(F.concat(content, F.array(F.concat(F.lit("h:"), F.substring("handle", 1, 4)), F.when(F.length("name") > 0, F.concat(F.lit("n:"), F.substring("name", 1, 5))), F.when(F.length(stem) > 0, F.concat(F.lit("s:"), stem)))), lambda k: k.isNotNull()))
    # A row for each account and key, so that a hash counts once.
    blocked = a.withColumn("key", F.explode(keys)).drop("hashes").dropDuplicates(["author_key", "key"])
    # Handles that differ only in their number do not meet unless they share content: equal handles, a handle without
    # number and one with it, and handles that differ before their number are what is left of a block, each joined by itself.
    blocked = blocked.withColumns({"bare": F.regexp_replace("handle", r"\d+$", ""), "number": F.regexp_extract("handle", r"(\d+)$", 1), "content": F.startswith("key", F.lit("c:"))})
    side = lambda d, s: d.select([F.col(c).alias(f"{c}_{s}") for c in d.columns])
    by = lambda *cs: [F.col(f"{c}_l") == F.col(f"{c}_r") for c in cs]
    plain, shared = blocked.where(~F.col("content")), blocked.where("content")
    left, right = side(plain, "l"), side(plain, "r")
    bares = plain.select("key", "platform", "bare").distinct()
    apart = side(bares, "l").join(side(bares, "r"), by("key")).where("platform_l < platform_r and bare_l != bare_r").select("key_l", "platform_l", "bare_l", "platform_r", "bare_r")
    met = [
        side(shared, "l").join(side(shared, "r"), by("key")),
        left.join(right, by("key", "bare", "number")),
        left.where("number_l = ''").join(right.where("number_r != ''"), by("key", "bare")),
        left.where("number_l != ''").join(right.where("number_r = ''"), by("key", "bare")),
        left.join(apart, ["key_l", "platform_l", "bare_l"]).join(right, (F.col("key_l") == F.col("key_r")) & (apart["platform_r"] == right["platform_r"]) & (apart["bare_r"] == right["bare_r"])).drop(apart["platform_r"], apart["bare_r"]),
    ]
    met = reduce(DataFrame.unionByName, met).where("platform_l < platform_r")
    each = ["handle_l", "handle_r", "name_l", "name_r"]
    enumerated = (F.col("bare_l") == F.col("bare_r")) & (F.col("number_l") != F.col("number_r")) & (F.col("number_l") != "") & (F.col("number_r") != "")
    met = met.withColumn("enumerated", enumerated)
    return met.groupBy("author_key_l", "author_key_r").agg(F.count_if("content_l").alias("n_shared"), F.first("enumerated").alias("enumerated"), *[F.first(c).alias(c) for c in each])


def personas(authors: DataFrame, handle_least: float = 0.90, name_least: float = 0.90, bridge_least: float = 0.60) -> DataFrame:
    """Accounts of one person on several platforms: (author_key, persona_id, confidence).

    ``authors``: author_key, platform, handle, display_name and, if there, content_hashes (an
    array). Only accounts that share a blocking key (start of the handle, start of the folded name,
    handle without digits, a content hash) are compared. Handles that differ only in their number
    are different people, unless they share content. Shared content bridges handles from
    ``bridge_least`` on; each shared hash adds 0.1 to their score, three at most. Accounts without
    a partner have no persona; a persona's confidence is its weakest match.
    """
    scored = persona_pairs(authors).withColumns({"hs": jaro_winkler("handle_l", "handle_r"), "ns": jaro_winkler("name_l", "name_r")})
    named = (F.length("name_l") > 0) & (F.length("name_r") > 0) & (F.col("ns") >= name_least)
    handled = F.col("hs") >= handle_least
    plain = F.greatest("hs", F.when(named, F.col("ns")).otherwise(0.0))
    bridge = F.when((F.col("n_shared") > 0) & (F.col("hs") >= bridge_least), F.least(F.lit(1.0), F.col("hs") + F.least(F.lit(0.3), 0.1 * F.col("n_shared"))))
    # As in the reference: handle and name together decide first, then shared content.
    score = F.when(~F.col("enumerated") & handled & named, plain).otherwise(F.coalesce(bridge, F.when(~F.col("enumerated") & (handled | named), plain)))
    match = scored.select(F.col("author_key_l").alias("a"), F.col("author_key_r").alias("b"), score.alias("score")).where("score is not null")
    match = scratch(match, "match")
    where = connected(match)
    weakest = match.join(where, F.col("a") == F.col("id")).groupBy("component").agg(F.min("score").alias("confidence"))
    return where.join(weakest, "component").select(F.col("id").alias("author_key"), F.substring(F.sha1(F.col("component").cast("string").cast("binary")), 1, 16).alias("persona_id"), "confidence")


def gazetteer(docs: DataFrame, key: str, text: Column, names: DataFrame, longest_first: bool = True) -> DataFrame:
    """Names of a catalogue in texts: key, entity, kind, first_at, n. ``names``: name, entity, kind.

    Word n-grams are joined to the folded names, so a catalogue of any size is one hash join. Only
    the key goes with the n-grams, not the text. With ``longest_first`` a name inside of a longer
    name's place does not count.
    """
    split = lambda c: F.regexp_extract_all(fold_accents(c), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    folded = names.select(F.array_join(split(F.col("name")), " ").alias("gram"), "entity", "kind").where("gram != ''").distinct()
    words = docs.select(key, F.posexplode(F.transform(split(text), lambda w: w)).alias("at", "word"))
    # Starts of names first: only words that begin a name are followed further.
    starts = folded.select(F.split_part("gram", F.lit(" "), F.lit(1)).alias("word"), "gram", "entity", "kind").withColumn("words", F.split("gram", " "))
    begun = words.join(F.broadcast(starts) if names.count() <= 100_000 else starts, "word")
    single = begun.where(F.size("words") == 1).select(key, "at", "entity", "kind", F.lit(1).alias("size"))
    rest = begun.where(F.size("words") > 1).select(key, "at", "entity", "kind", "gram", F.size("words").alias("size"), F.posexplode("words").alias("k", "want")).where("k > 0")
    follow = words.select(F.col(key).alias("_key"), (F.col("at")).alias("_at"), F.col("word").alias("_word"))
    met = rest.join(follow, (F.col(key) == F.col("_key")) & (F.col("at") + F.col("k") == F.col("_at")) & (F.col("want") == F.col("_word")))
    several = met.groupBy(key, "at", "entity", "kind", "gram", "size").agg(F.count("*").alias("found")).where("found = size - 1").select(key, "at", "entity", "kind", "size")
    hits = single.unionByName(several).distinct()
    if longest_first:
        over = hits.where("size > 1").select(F.col(key).alias("_key"), F.explode(F.sequence("at", F.col("at") + F.col("size") - 1)).alias("_at"), (F.col("at") + F.col("size")).alias("_end"), F.col("size").alias("_size")).distinct()
        hits = hits.join(over, (F.col(key) == F.col("_key")) & (F.col("at") == F.col("_at")) & (F.col("_size") > F.col("size")) & (F.col("_end") >= F.col("at") + F.col("size")), "left_anti")
    return hits.groupBy(key, "entity", "kind").agg(F.min("at").alias("first_at"), F.count("*").alias("n"))


def role_names(holders: DataFrame, titles: dict[str, Sequence[str]], links: Sequence[str] = ("de", "da", "do")) -> DataFrame:
    """Catalogue names for people called by their office ("prefeita de Natal"). ``holders``: entity, role, place; ``titles``: the words for a role."""
    rows = [(role, f"{title} {link}") for role, words in titles.items() for title in words for link in links]
    calls = holders.sparkSession.createDataFrame(rows, "role string, call string")
    return holders.join(calls, "role").select(F.concat_ws(" ", "call", "place").alias("name"), "entity", F.lit("role").alias("kind"))


def extract(docs: DataFrame, key: str, text: Column, names: DataFrame, kinds: Sequence[str], relevant: Sequence[str], incumbents: Sequence[str] = (), model: Column | None = None) -> DataFrame:
    """Entities of each text by kind: key, an array for each kind, persons, is_relevant.

    ``model``: an array of names that a statistical recognizer found (a UDF's column); persons are
    its names and those of the catalogue's person and role entries, without regard to case. A text
    is relevant if it has an entity of a ``relevant`` kind or names an incumbent. Texts without
    entities have empty arrays.
    """
    hits = gazetteer(docs, key, text, names)
    of = lambda *ks: F.array_sort(F.collect_set(F.when(F.col("kind").isin(*ks), F.col("entity"))))
    found = hits.groupBy(key).agg(*[of(k).alias(k) for k in kinds], of("person", "role").alias("_persons"), of(*relevant).alias("_relevant"))
    none = F.array().cast("array<string>")
    guessed = docs.select(key, (F.lit(None).cast("array<string>") if model is None else model).alias("_model"))
    out = guessed.join(found, key, "left").withColumn("persons", merge_mentions(F.col("_persons"), F.col("_model")))
    named = F.exists("persons", lambda p: F.lower(p).isin(*[i.lower() for i in incumbents])) if incumbents else F.lit(False)
    return out.select(key, *[F.coalesce(k, none).alias(k) for k in kinds], "persons", ((F.size(F.coalesce("_relevant", none)) > 0) | named).alias("is_relevant"))


#: Words of a context that speak for a role.
ROLE_WORDS = {"mayor": ("prefeito", "prefeita", "prefeitura"), "governor": ("governador", "governadora", "governo do estado"), "governor_candidate": ("candidato", "candidata", "campanha")}
#: Fixed value: the word of a context that speaks for an incumbent.
REGION_WORD = "rn"


def corroboration(context: Column, city: Column, party: Column, role: Column, incumbent: Column) -> Column:
    """What a folded context says for a person: 0.50, and more for the city, the party, the role and the region; 0.95 at most."""
    told = lambda part: (part != "") & F.contains(context, part)
    spoken = F.lit(False)
    for name, words in ROLE_WORDS.items():
        for w in words:
            spoken = spoken | ((role == name) & F.contains(context, F.lit(w)))
    region = incumbent & F.array_contains(F.split(context, r"\s+"), REGION_WORD)
    parts = ((told(city), 0.20), (told(party), 0.10), (spoken, 0.10), (region, 0.05))
    total = F.lit(0.50)
    for holds, more in parts:
        total = total + F.when(holds, more).otherwise(0.0)
    return F.when(F.trim(context) == "", 0.50).otherwise(F.least(F.round(total, 2), F.lit(0.95)))


def resolve_people(mentions: DataFrame, people: DataFrame, in_scope: float = 0.70, ambiguous: float = 0.40) -> DataFrame:
    """Best person of each mention: mention_id, person_id, confidence, status, candidates (three at most, if it is not in scope).

    ``mentions``: mention_id, handle, name, context (text). ``people``: person_id, name, handle,
    city, party and, if there, aliases (array), role, is_incumbent. A known handle decides. Else a
    whole name or alias does, unless the context does not corroborate it (a namesake). Else people
    that share a name token are scored by the context, and a lead under 0.15 is ambiguous.
    """
    has = lambda c, otherwise: F.col(c) if c in people.columns else F.lit(otherwise)
    aliases = F.transform(has("aliases", None).cast("array<string>"), fold_accents)
    p = people.select(
        "person_id", F.lower(F.ltrim(F.trim("handle"), F.lit("@"))).alias("p_handle"), fold_accents(F.col("name")).alias("p_name"), fold_accents(F.coalesce("city", F.lit(""))).alias("p_city"), fold_accents(F.coalesce("party", F.lit(""))).alias("p_party"),
        F.coalesce(has("role", ""), F.lit("")).alias("p_role"), F.coalesce(has("is_incumbent", False), F.lit(False)).alias("p_incumbent"), F.coalesce(aliases, F.array().cast("array<string>")).alias("p_aliases"),
    )
    m = mentions.select("mention_id", F.lower(F.ltrim(F.trim("handle"), F.lit("@"))).alias("m_handle"), fold_accents(F.trim(F.coalesce("name", F.lit("")))).alias("m_name"), fold_accents(F.coalesce("context", F.lit(""))).alias("context"))
    about = corroboration(F.col("context"), F.col("p_city"), F.col("p_party"), F.col("p_role"), F.col("p_incumbent"))
    names = p.select("*", F.explode(F.array_distinct(F.concat(F.array("p_name"), "p_aliases"))).alias("called")).where("called != ''")
    row = lambda df, tier, score: df.select("mention_id", "person_id", F.lit(tier).alias("tier"), score.alias("confidence"))
    by_handle = row(m.join(p, F.col("m_handle") == F.col("p_handle")), 1, F.lit(1.0))
    exact = F.when(F.trim("context") == "", 0.90).when(about >= 0.60, F.least(F.round(about + 0.20, 2), F.lit(0.97))).otherwise(0.55)
    by_name = row(m.join(names, F.col("m_name") == F.col("called")), 2, exact)
    tokens = lambda c: F.explode(F.array_distinct(F.filter(F.split(c, r"\s+"), lambda t: F.length(t) >= 3)))
    by_token = row(m.withColumn("t", tokens(F.col("m_name"))).join(names.withColumn("t", tokens(F.col("called"))), "t"), 3, about)
    every = by_handle.union(by_name).union(by_token).groupBy("mention_id", "tier", "person_id").agg(F.max("confidence").alias("confidence"))
    # The first tier that says anything speaks alone.
    first = every.join(every.groupBy("mention_id").agg(F.min("tier").alias("tier")), ["mention_id", "tier"])
    w = Window.partitionBy("mention_id").orderBy(F.desc("confidence"), "person_id")
    ranked = first.withColumns({"k": F.row_number().over(w), "next": F.lead("confidence").over(w)}).where("k <= 3")
    top = ranked.groupBy("mention_id", "tier").agg(F.min_by(F.struct("person_id", "confidence", "next"), "k").alias("best"), F.transform(F.array_sort(F.collect_list(F.struct("k", "person_id"))), lambda x: x["person_id"]).alias("candidates"))
    sure, close = F.col("best.confidence"), F.coalesce(F.col("best.confidence") - F.col("best.next") < 0.15, F.lit(False)) & (F.col("tier") == 3)
    status = F.when((sure >= in_scope) & ~close, "IN_SCOPE").when((sure >= ambiguous) | close, "AMBIGUOUS").otherwise("OUT_OF_SCOPE")
    found = top.select("mention_id", sure.alias("confidence"), status.alias("status"), F.col("best.person_id").alias("best_id"), "candidates")
    inside = F.col("status") == "IN_SCOPE"
    out = mentions.select("mention_id").join(found, "mention_id", "left")
    return out.select("mention_id", F.when(inside, F.col("best_id")).alias("person_id"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"), F.coalesce("status", F.lit("OUT_OF_SCOPE")).alias("status"), F.when(~inside, F.col("candidates")).alias("candidates"))


def resolve_best(resolved: DataFrame, content: str) -> DataFrame:
    """One result for each content: the surest in scope, else the surest ambiguous one, else the surest of the rest."""
    rank = F.when(F.col("status") == "IN_SCOPE", 0).when(F.col("status") == "AMBIGUOUS", 1).otherwise(2)
    return resolved.groupBy(content).agg(F.min_by(F.struct("person_id", "confidence", "status"), F.struct(rank, -F.col("confidence"), "mention_id")).alias("r")).select(content, "r.*")


def merge_mentions(*arrays: Column) -> Column:
    """Union of mention arrays in order, without regard to case; null arrays are empty."""
    every = F.concat(*[F.coalesce(a, F.array().cast("array<string>")) for a in arrays])
    return F.aggregate(every, F.array().cast("array<string>"), lambda acc, x: F.when(F.exists(acc, lambda y: F.lower(y) == F.lower(x)), acc).otherwise(F.concat(acc, F.array(x))))


def stop_entities(entities: Column, stop: Sequence[str]) -> Column:
    """Entities (text, label) without PERSON entries of a stop list, accents and case ignored."""
    return F.filter(entities, lambda e: ~((e["label"] == "PERSON") & fold_accents(e["text"]).isin(*[s.lower() for s in stop])))
