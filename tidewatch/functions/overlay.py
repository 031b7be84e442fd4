"""The sentiment overlay: label, confidence, risk and decision factors from polarity and reach."""

from __future__ import annotations

import hashlib
from dataclasses import asdict, dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Thresholds:
    polarity_negative: float = -0.35
    polarity_warning: float = -0.10
    polarity_positive: float = 0.20
    volume_spike: int = 7
    volume_warning: int = 4
    velocity_spike: float = 0.45
    velocity_warning: float = 0.2
    engagement_high: int = 5000
    min_confidence_favorable: float = 0.30
    min_confidence_alert: float = 0.40

    def version(self) -> str:
        named = ":".join(f"{k}={v}" for k, v in sorted(asdict(self).items()))
        return hashlib.sha1(named.encode()).hexdigest()[:12]


def _reach(engagement: Column) -> Column:
    return F.least(F.log1p(F.greatest(engagement.cast("double"), F.lit(0.0))) / F.log1p(F.lit(50000.0)), F.lit(1.0))


def classify(polarity: Column, volume: Column, velocity: Column, engagement: Column, recurrence: Column | None = None, t: Thresholds | None = None) -> Column:
    """(label, confidence, risk_score, factors, rule_version) as one expression; rules in order of severity, then a gate on confidence."""
    t = t or Thresholds()
    recurrence = F.lit(0.0) if recurrence is None else recurrence
    fast, busy, loud = velocity >= t.velocity_warning, volume >= t.volume_warning, engagement >= t.engagement_high
    alert = (polarity <= t.polarity_negative) & (velocity >= t.velocity_spike) & ((volume >= t.volume_spike) | loud)
    warning = (polarity <= t.polarity_warning) & (fast | busy)
    favorable = (polarity >= t.polarity_positive) | ((polarity >= t.polarity_warning) & loud)

    def factor(name: str, value: Column, weight: float, source) -> Column:
        return F.struct(F.lit(name).alias("name"), value.cast("double").alias("value"), F.lit(weight).alias("weight"), (F.lit(source) if isinstance(source, str) else source).alias("source"))

    only = lambda condition, f: F.when(condition, F.array(f)).otherwise(F.array().cast("array<struct<name:string,value:double,weight:double,source:string>>"))
    spike = volume >= t.volume_spike
    factors = (
        F.when(alert, F.concat(F.array(factor("polarity_critical", polarity, 0.40, "gcp_nl_v2"), factor("velocity_high", velocity, 0.30, "trend_scorer"), factor("volume_or_engagement_spike", F.when(spike, volume.cast("double")).otherwise(engagement.cast("double")), 0.30, F.when(spike, "volume_24h").otherwise("engagement"))), only(recurrence >= 0.5, factor("recurrence_sustained", recurrence, 0.0, "stg_social__counts"))))
        .when(warning, F.concat(F.array(factor("polarity_negative", polarity, 0.50, "gcp_nl_v2")), only(fast, factor("velocity_elevated", velocity, 0.30, "trend_scorer")), only(busy, factor("volume_elevated", volume, 0.20, "volume_24h"))))
        .when(favorable, F.concat(F.array(factor("polarity_positive", polarity, 0.60, "gcp_nl_v2")), only(loud, factor("engagement_high", engagement, 0.40, "engagement"))))
        .otherwise(F.array(factor("insufficient_signal", polarity, 1.0, "default")))
    )
    weight = F.when(alert, 1.0).when(warning, 0.5 + F.when(fast, 0.3).otherwise(0.0) + F.when(busy, 0.2).otherwise(0.0)).when(favorable, 0.6 + F.when(loud, 0.4).otherwise(0.0)).otherwise(1.0)
    structural = 1.0 / (1.0 + F.exp(-3.0 * (weight - 0.9)))
    signal = 0.45 * F.least(F.abs(polarity), F.lit(1.0)) + 0.35 * F.least(F.greatest(velocity, F.lit(0.0)), F.lit(1.0)) + 0.20 * _reach(engagement)
    confidence = F.least(F.greatest(0.55 * structural + 0.45 * signal, F.lit(0.0)), F.lit(1.0))
    raw = F.when(alert, "ALERT").when(warning, "WARNING").when(favorable, "FAVORABLE").otherwise("WARNING")
    weak = ((raw == "FAVORABLE") & (confidence < t.min_confidence_favorable)) | ((raw == "ALERT") & (confidence < t.min_confidence_alert))
    risk = F.least(0.5 * F.greatest(-polarity, F.lit(0.0)) + 0.3 * F.greatest(velocity, F.lit(0.0)) + 0.2 * _reach(engagement), F.lit(1.0))
    return F.struct(F.when(weak, "WARNING").otherwise(raw).alias("label"), F.round(confidence, 4).alias("confidence"), F.round(risk, 4).alias("risk_score"), factors.alias("factors"), F.lit(t.version()).alias("rule_version"))
