"""Web responses: signs of a block, and why a fetch failed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Markers by kind of block.
MARKERS = {
    "cloudflare": ("cf-chl-bypass", "__cf_chl", "_cf_chl_opt", "checking your browser", "just a moment", "attention required"),
    "captcha": ("g-recaptcha", "h-captcha", "recaptcha", "hcaptcha", "please verify you are a human", "i'm not a robot", "turnstile"),
    "js_challenge": ("jschl-answer", "challenge-form", "challenge-platform", "/cdn-cgi/challenge-platform"),
    "waf": ("access denied", "request blocked", "you don't have permission", "incapsula", "sucuri", "akamai reference", "datadome", "perimetrix"),
}
EMPTY_BELOW, SMALL_BELOW = 512, 2048


def block_signals(status: Column, body: Column) -> Column:
    """(cloudflare, captcha, js_challenge, waf, empty_body, truncated_body, blocked)."""
    text = F.lower(F.coalesce(body, F.lit("")))
    found = {}
    for kind, markers in MARKERS.items():
        hit = F.lit(False)
        for m in markers:
            hit = hit | F.contains(text, F.lit(m))
        found[kind] = hit
    size = F.octet_length(F.coalesce(body, F.lit("")))
    marked = found["cloudflare"] | found["captcha"] | found["js_challenge"] | found["waf"]
    refused = F.coalesce(status.isin(403, 429, 503), F.lit(False)) & (size < SMALL_BELOW) & ~marked
    found["waf"] = found["waf"] | refused
    return F.struct(*[c.alias(k) for k, c in found.items()], (size == 0).alias("empty_body"), ((size > 0) & (size < EMPTY_BELOW)).alias("truncated_body"), (marked | refused).alias("blocked"))


def failure_class(status: Column, signals: Column, extracted_chars: Column, exception: Column) -> Column:
    """Transport error, then block, then HTTP status, then parser."""
    e = F.lower(F.coalesce(exception, F.lit("")))
    return (
        F.when(F.contains(e, F.lit("timeout")), "timeout")
        .when(F.contains(e, F.lit("connect")) | F.contains(e, F.lit("reset")), "connection_reset")
        .when(F.contains(e, F.lit("ssl")), "ssl_error")
        .when(signals["blocked"], "blocked_bot")
        .when((status >= 500) & (status < 600), "http_5xx")
        .when((status >= 400) & (status < 500), F.concat(F.lit("http_"), status.cast("string")))
        .when(signals["empty_body"], "empty_content")
        .when(extracted_chars == 0, "selector_missing")
        .otherwise("unknown")
    )
