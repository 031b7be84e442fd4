"""URLs in one canonical form, as an expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Parameters that only track a click.
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_content", "utm_term", "utm_id", "utm_cid", "fbclid", "gclid", "dclid", "yclid", "msclkid", "mc_eid", "mc_cid", "ref", "via", "_ga", "_gl", "origem", "canal", "campanha")


def canonical_url(url: Column) -> Column:
    """Lower-case scheme and host, no default port, tracking parameter, fragment or trailing slash; parameters sorted."""
    rest = F.regexp_replace(F.trim(url), r"#.*$", "")
    scheme = F.lower(F.regexp_extract(rest, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1))
    host = F.lower(F.regexp_extract(rest, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?]*)", 1))
    host = F.when(scheme == "http", F.regexp_replace(host, r":80$", "")).when(scheme == "https", F.regexp_replace(host, r":443$", "")).otherwise(host)
    path = F.regexp_replace(F.regexp_extract(rest, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(rest, r"\?(.*)$", 1)
    pairs = F.filter(F.split(query, "&"), lambda p: F.rlike(p, F.lit("^[^=]+=.+")) & ~F.lower(F.split_part(p, F.lit("="), F.lit(1))).isin(*TRACKING))
    kept = F.array_join(F.array_sort(pairs), "&")
    return F.when(url.isNull(), None).otherwise(F.concat(scheme, F.lit("://"), host, F.when(path == "", "/").otherwise(path), F.when(kept == "", "").otherwise(F.concat(F.lit("?"), kept))))


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?:]*)", 1))


def looks_like_article(url: Column) -> Column:
    """A sitemap URL without a query that has a date, three path segments, or a long last slug."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?]*([^?]*)", 1)
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    last = F.coalesce(F.try_element_at(parts, F.lit(-1)), F.lit(""))
    return ~F.contains(url, F.lit("?")) & ~F.rlike(path, F.lit(r"/(tag|category|categoria|author|autor|page|pagina)/")) & (F.rlike(path, F.lit(r"/\d{4}/\d{1,2}/")) | (F.size(parts) >= 3) | (F.length(last) > 20))
