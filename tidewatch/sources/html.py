"""Articles from saved HTML, as expressions: JSON-LD first, then the page's own marks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A strategy's text counts if it has so many characters.
LEAST_TEXT = 100
_JSON_LD = r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"
_LD = "headline string, name string, articleBody string, datePublished string, dateCreated string, dateModified string"


def strip_tags(html: Column) -> Column:
    bare = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style|nav|footer|header|aside)\b.*?</\1>", " "), r"(?s)<[^>]*>", " ")
    plain = bare
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        plain = F.replace(plain, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(plain, r"\s+", " "))


def _first(html: Column, pattern: str) -> Column:
    return F.nullif(F.trim(F.regexp_extract(html, pattern, 1)), F.lit(""))


def article(html: Column) -> Column:
    """(title, body, published, strategy): each later strategy only if the text so far is short; all null without a title or a body."""
    ld = F.from_json(_first(html, _JSON_LD), _LD)
    paragraphs = F.array_join(F.transform(F.regexp_extract_all(html, F.lit(r"(?is)<p\b[^>]*>(.*?)</p>"), F.lit(1)), strip_tags), "\n")
    tagged = strip_tags(_first(html, r"(?is)<article\b[^>]*>(.*?)</article>"))
    page = strip_tags(F.coalesce(_first(html, r"(?is)<body\b[^>]*>(.*?)</body>"), html))
    long = lambda c: F.coalesce(F.length(F.trim(c)) >= LEAST_TEXT, F.lit(False))
    body = F.when(long(ld["articleBody"]), ld["articleBody"]).when(long(tagged), tagged).when(long(paragraphs), paragraphs).when(long(page), page)
    strategy = F.when(long(ld["articleBody"]), "json_ld").when(long(tagged), "article").when(long(paragraphs), "paragraphs").when(long(page), "page")
    title = F.coalesce(ld["headline"], ld["name"], _first(html, r'(?is)<meta[^>]*property="og:title"[^>]*content="([^"]*)"'), strip_tags(_first(html, r"(?is)<h1\b[^>]*>(.*?)</h1>")), strip_tags(_first(html, r"(?is)<title\b[^>]*>(.*?)</title>")))
    published = F.coalesce(F.try_to_timestamp(ld["datePublished"]), F.try_to_timestamp(ld["dateCreated"]), F.try_to_timestamp(ld["dateModified"]))
    return F.struct(title.alias("title"), body.alias("body"), published.alias("published"), strategy.alias("strategy"))
