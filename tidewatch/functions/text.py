"""Text: folding, cleaning, content hashes, keyword topics, language codes."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Latin letters with their plain forms.
ACCENTED = "áàâãäåçéèêëíìîïñóòôõöúùûüýÿÁÀÂÃÄÅÇÉÈÊËÍÌÎÏÑÓÒÔÕÖÚÙÛÜÝ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUY"

#: Lines that news portals add to an article.
BOILERPLATE = (
    r"(?i)leia\s+(também|mais)\s*:.*$",
    r"(?i)siga\s+o?\s*\w+\s+no\s+(twitter|instagram|facebook).*$",
    r"(?i)inscreva-se\s+no\s+canal.*$",
    r"(?i)compartilhe\s+esta?\s+(notícia|matéria).*$",
    r"(?i)assine\s+(já|agora|o).*$",
    r"(?i)publicidade\s*$",
    r"(?i)veja\s+também\s*:.*$",
    r"(?i)(foto|imagem|crédito|reprodução)\s*:.*$",
)
MIN_LINE = 30


def fold_accents(text: Column) -> Column:
    """Lower case without Latin accents, for matching."""
    return F.lower(F.translate(text, ACCENTED, PLAIN))


@F.pandas_udf(StringType())
def unicode_normalize(text: pd.Series, form: pd.Series) -> pd.Series:
    """Unicode normalization, which Spark lacks; Arrow batches."""
    import unicodedata

    return pd.Series([None if t is None else unicodedata.normalize(f, t) for t, f in zip(text, form, strict=True)])


@F.pandas_udf(StringType())
def ascii_fold(text: pd.Series) -> pd.Series:
    """Compatibility decomposition with everything but ASCII dropped."""
    import unicodedata

    return pd.Series([None if t is None else unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode() for t in text])


def repair(text: Column) -> Column:
    """Scraping artefacts: hard blanks, zero-width characters, line ends."""
    out = F.translate(text, " ​‌‍﻿", " ")
    return F.replace(F.replace(out, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def clean_text(text: Column, normalize: bool = True) -> Column:
    """Article text without boilerplate and short lines.

    ``normalize`` composes Unicode first (the one step that leaves the JVM).
    """
    out = repair(unicode_normalize(text, F.lit("NFC")) if normalize else text)
    kept = F.filter(F.split(out, "\n"), lambda line: ~F.rlike(line, F.lit("|".join(BOILERPLATE))))
    out = F.regexp_replace(F.regexp_replace(F.array_join(kept, "\n"), r"[ \t]+", " "), r"\n{3,}", "\n\n")
    blank = r"^\s+|\s+$"
    lines = F.filter(F.split(out, "\n"), lambda line: (F.length(F.regexp_replace(line, blank, "")) >= MIN_LINE) | (F.length(F.regexp_replace(line, blank, "")) == 0))
    return F.regexp_replace(F.array_join(lines, "\n"), blank, "")


def content_hash(title: Column, content: Column) -> Column:
    """SHA-256 of title and content, folded to plain lower-case words."""
    folded = F.lower(ascii_fold(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(content, F.lit("")))))
    words = F.regexp_replace(F.regexp_replace(folded, r"[^\w\s]", ""), r"\s+", " ")
    return F.sha2(F.trim(words).cast("binary"), 256)


def post_hash(platform: Column, post_id: Column, text: Column) -> Column:
    return F.sha2(F.concat_ws(":", platform, post_id, text).cast("binary"), 256)


def surrogate_key(*columns: Column) -> Column:
    """md5 over the columns' text joined by hyphens, nulls by a placeholder."""
    return F.md5(F.concat_ws("-", *[F.coalesce(c.cast("string"), F.lit("_null_")) for c in columns]).cast("binary"))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def keyword_topic(text: Column, topics: dict[str, Sequence[str]]) -> Column:
    """(topic_id, topic_label, topic_id_source): the topic with most keywords, the first of equals; ids from 1, -1 for none."""
    names = F.array(*[F.lit(n) for n in topics])

    def counts(body: Column) -> Column:
        return F.array(*[sum((F.contains(body, F.lit(k)).cast("int") for k in words), F.lit(0)) for words in topics.values()])

    def best(c: Column) -> Column:
        none = F.array_max(c) == 0
        number = F.array_position(c, F.array_max(c)).cast("int")
        return F.named_struct(F.lit("topic_id"), F.when(none, -1).otherwise(number), F.lit("topic_label"), F.when(~none, F.element_at(names, number)), F.lit("topic_id_source"), F.when(none, "unclassified").otherwise("keyword_map"))

    return let(F.lower(F.coalesce(text, F.lit(""))), lambda body: let(counts(body), best))


def sentences(text: Column, min_length: int = 20) -> Column:
    """Sentences longer than ``min_length``, cut behind their closing mark."""
    return F.filter(F.transform(F.split(text, r"(?<=[.!?])\s+"), F.trim), lambda s: F.length(s) > min_length)


def language_code(tag: Column, known: Sequence[str] = ("pt", "en", "es", "fr", "de", "it")) -> Column:
    """(language, reason): the primary subtag if known, else und."""
    primary = F.lower(F.trim(F.split_part(F.translate(tag, "_", "-"), F.lit("-"), F.lit(1))))
    blank = tag.isNull() | (F.trim(tag) == "")
    return F.struct(F.when(~blank & primary.isin(*known), primary).otherwise("und").alias("language"), F.when(blank, "missing").when(primary.isin(*known), "declared").otherwise("unknown_code").alias("reason"))


def quick_relevance(text: Column, names: Sequence[str], acronym: str | None = None) -> Column:
    """Does a text name one of the names (four letters or more, accents folded), or the acronym as a word in capitals?"""
    folded = fold_accents(text)
    hits = [F.contains(folded, fold_accents(F.lit(n))) for n in names if len(n) >= 4]
    if acronym:
        hits.append(F.rlike(text, F.lit(rf"\b{acronym}\b")))
    out = F.lit(False)
    for h in hits:
        out = out | h
    return F.coalesce(out, F.lit(False))
