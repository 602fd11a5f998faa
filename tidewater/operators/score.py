"""Numeric scores as projections: base, change, confidence and attention, sort keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

REGION_WEIGHT = {"AFRICA": 1.3, "MIDDLE EAST": 1.25, "ASIA": 1.2, "AMERICA": 1.15}
ACTION_WEIGHT = {"policy": 25, "product": 24, "funding": 22, "earnings": 18, "expansion": 18, "hiring": 12}
TIER_AUTHORITY = {"L1": 33, "L4-vertical": 29, "L3": 23, "L2": 20, "L5": 10}


def _lookup(key: Column, table: dict, default) -> Column:
    out = F.lit(default)
    for name, value in table.items():
        out = F.when(key == name, F.lit(value)).otherwise(out)
    return out


def amount_score(millions: Column) -> Column:
    """5 from 1000 million on, then 4 from 500, 3 from 100, 2 from 20, 1 from 5; null scores 0."""
    return F.when(millions >= 1000, 5).when(millions >= 500, 4).when(millions >= 100, 3).when(millions >= 20, 2).when(millions >= 5, 1).otherwise(0)


def base_score(amount: Column, kind: Column, layer: Column, industries: Column, trusted: Column, named: Column, region: Column) -> Column:
    """1 to 10: points times the region's weight, cut to an integer."""
    by_kind = F.when(kind.isin("ma", "earnings", "report", "model", "regional_policy"), 2).when(kind.isin("funding", "strategy"), 1).otherwise(0)
    by_layer = F.when(layer == "regional_policy", 3).when(layer == "industry_change", 2).when(layer == "company_action", 1).otherwise(0)
    points = amount_score(amount) + by_kind + by_layer + F.when(industries > 0, 1).otherwise(0) + F.when(trusted, 1).otherwise(0) + F.when(named, 1).otherwise(0)
    return F.least(F.greatest((points.cast("double") * _lookup(region, REGION_WEIGHT, 1.0)).cast("int"), F.lit(1)), F.lit(10))


def change_score(in_target: Column, explicit: Column, quantified: Column, action: Column, fits_scope: Column, countries: Column) -> Column:
    """struct(score, blocked): 0 and the reason where a gate is shut, else up to 100."""
    market = F.when(countries >= 3, 14).when(countries == 2, 11).when(countries == 1, 8).otherwise(0)
    points = F.when(quantified, 35).otherwise(20) + _lookup(action, ACTION_WEIGHT, 15) + F.when(fits_scope, 20).otherwise(12) + market
    blocked = F.when(~in_target, "out_of_target_industry").when(~explicit, "no_explicit_change")
    return F.struct(F.when(blocked.isNotNull(), 0).otherwise(F.least(points, F.lit(100))).alias("score"), blocked.alias("blocked"))


def authority(credibility: Column, tier: Column) -> Column:
    """Credibility times 3.5 within 8 to 35 where it is known, else by tier."""
    known = F.least(F.greatest(credibility * 3.5, F.lit(8.0)), F.lit(35.0))
    return F.when(F.coalesce(credibility, F.lit(0.0)) > 0, known).otherwise(_lookup(tier, TIER_AUTHORITY, 16).cast("double"))


def confidence(authority: Column, has_url: Column, has_source: Column, has_excerpt: Column, recent: Column, specific: Column, quantified: Column) -> Column:
    """Authority, traceability, recency and specificity, rounded half to even, at most 100."""
    trace = F.when(has_url, 10).otherwise(0) + F.when(has_source, 8).otherwise(0) + F.when(has_excerpt, 7).otherwise(0)
    points = authority + trace + F.when(recent, 15).otherwise(7) + F.when(specific, 10).otherwise(5) + F.when(quantified, 5).otherwise(0)
    return F.least(F.bround(points, 0).cast("int"), F.lit(100))


def attention(materiality: Column, relevance: Column, impact_known: Column, scope: Column, novel: Column, filtered: Column, urgent: Column) -> Column:
    """Materiality (at most 45), relevance, scope, novelty and urgency, at most 100."""
    points = (
        F.least(materiality, F.lit(45))
        + F.when(relevance >= 3, 20).otherwise(10)
        + F.when(impact_known, 5).otherwise(0)
        + F.when(scope == "qualified", 20).when(scope == "filtered", 0).otherwise(8)
        + F.when(filtered, 0).when(novel, 15).otherwise(10)
        + F.when(urgent, 10).otherwise(5)
    )
    return F.least(points, F.lit(100))


def grade(score: Column) -> Column:
    return F.when(score >= 80, "A").when(score >= 65, "B").when(score >= 50, "C").otherwise("D")


def level(score: Column) -> Column:
    return F.when(score >= 8, "A").when(score >= 6, "B").when(score >= 4, "C").otherwise("D")


def decayed(attention: Column, tier: Column, days: Column) -> Column:
    """Attention weighted by portfolio tier, losing 30 % a day."""
    weight = F.when(tier == "must", 1.3).when(tier == "strategic", 1.2).otherwise(1.0)
    return attention / 100.0 * weight * F.pow(F.lit(0.7), F.greatest(days, F.lit(0)))
