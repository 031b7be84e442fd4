"""Redaction of personal data by ordered patterns."""

from __future__ import annotations

import hashlib
import hmac
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Category and pattern, applied in this order.
PATTERNS = (
    ("email", r"\b[\w._%+-]+@[\w.-]+\.[A-Za-z]{2,}\b"),
    ("cnpj", r"(?<!\d)\d{2}\.\d{3}\.\d{3}/\d{4}-\d{2}(?!\d)"),
    ("cpf", r"(?<!\d)\d{3}\.\d{3}\.\d{3}-\d{2}(?!\d)"),
    ("phone", r"(?<!\d)(?:\+55\s*)?\(?\d{2}\)?\s*9\d{4}[-.\s]?\d{4}(?!\d)"),
    ("phone", r"(?<!\d)(?:\+55\s*)?\(?\d{2}\)?\s*\d{4}[-.\s]?\d{4}(?!\d)"),
    ("cnpj", r"(?<!\d)\d{14}(?!\d)"),
    ("cpf", r"(?<!\d)\d{11}(?!\d)"),
)
#: Placeholders that are nobody's number.
ALLOWED = ("00000000000", "11111111111", "12345678901", "00000000000000", "12345678000100")


LEVELS = ("none", "masked", "pseudonymized", "dropped")


def level_of(setting: str | None) -> str:
    """The level that a setting names; masked where there is none."""
    level = (setting or "masked").lower()
    if level not in LEVELS:
        raise ValueError(f"unknown redaction level {setting!r}; one of {', '.join(LEVELS)}")
    return level


def redact(text: Column, level: str = "masked", key: bytes = b"") -> Column:
    """(text, counts by category): every match replaced by its category in brackets.

    ``level``: none leaves the text, dropped leaves nothing of a match, pseudonymized adds a tag
    that is the same for the same value and ``key``; null stays null.
    """
    if level == "none":
        return F.struct(text.alias("text"), *[F.lit(0).alias(f"n_{c}") for c in dict.fromkeys(c for c, _ in PATTERNS)])
    if level == "pseudonymized":
        return _tagged(key)(text)
    allowed = "(?!(?:" + "|".join(ALLOWED) + r")(?!\d))"
    counts: dict[str, Column] = {}
    for category, pattern in PATTERNS:
        guarded = pattern if category == "email" else allowed + pattern
        counts[category] = counts.get(category, F.lit(0)) + F.regexp_count(text, F.lit(guarded))
        text = F.regexp_replace(text, guarded, "" if level == "dropped" else f"[{category}]")
    return F.struct(text.alias("text"), *[n.alias(f"n_{c}") for c, n in counts.items()])


def _tagged(key: bytes):
    """The pseudonymizing form of ``redact``: Spark replaces by a fixed text only, so this one goes through Arrow."""
    if not key:
        raise ValueError("pseudonymized redaction needs a key")
    kinds = list(dict.fromkeys(c for c, _ in PATTERNS))
    rules = [(c, re.compile(p if c == "email" else r"(?!(?:" + "|".join(ALLOWED) + r")(?!\d))" + p)) for c, p in PATTERNS]
    tag = lambda c: lambda m: f"[{c}:{hmac.new(key, m[0].encode(), hashlib.sha256).hexdigest()[:8]}]"

    @F.pandas_udf("text string, " + ", ".join(f"n_{c} int" for c in kinds))
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            counts = dict.fromkeys(kinds, 0)
            for c, rule in rules if text is not None else ():
                text, n = rule.subn(tag(c), text)
                counts[c] += n
            rows.append((text, *counts.values()))
        return pd.DataFrame(rows, columns=["text", *[f"n_{c}" for c in kinds]])

    return run


def pseudonym(key: bytes):
    """An Arrow function that names values by a keyed hash, which Spark has no expression for."""

    @F.pandas_udf(StringType())
    def run(value: pd.Series) -> pd.Series:
        return value.map(lambda v: None if v is None else hmac.new(key, v.encode(), hashlib.sha256).hexdigest()[:8])

    return run
