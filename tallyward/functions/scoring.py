"""Scores, tiers, reasons and losses as Column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# Tier presets as (lower bound, name), highest first, then the rest.
TIERS: dict[str, tuple[list[tuple[float, str]], str]] = {
    "core": ([(0.85, "critical"), (0.65, "high"), (0.4, "medium")], "low"),
    "scoring": ([(0.9, "CRITICAL"), (0.5, "HIGH"), (0.1, "MEDIUM")], "LOW"),
    "report": ([(0.8, "Critical"), (0.6, "High"), (0.4, "Medium"), (0.2, "Low")], "Very Low"),
    "config": ([(0.85, "critical"), (0.6, "high"), (0.3, "medium")], "low"),
}
# Impact levels, strict lower bounds.
IMPACT = ([(0.5, "Very High"), (0.3, "High"), (0.1, "Medium"), (0.05, "Low")], "Very Low")
# Colour of a report risk level.
RISK_COLOURS = {
    "Critical": "#e74c3c",
    "High": "#e67e22",
    "Medium": "#f39c12",
    "Low": "#27ae60",
    "Very Low": "#2980b9",
}
UNKNOWN_COLOUR = "#7f8c8d"
# Rule-score weights and saturation points per feature.
RULE_TERMS = {
    "amount": (0.35, 1500.0),
    "merchant_risk": (0.3, None),
    "velocity_1h": (0.2, 20.0),
    "distance_from_home": (0.15, 250.0),
}
RULE_FEATURES = list(RULE_TERMS)
# Reason name, feature and the value from which it applies.
REASONS = [
    ("high_amount", "amount", 500.0),
    ("merchant_risk", "merchant_risk", 0.6),
    ("high_velocity", "velocity_1h", 6.0),
    ("distance_from_home", "distance_from_home", 80.0),
]
NO_REASON = "baseline_pattern"


def clamp_probability(value: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.round(value, 4)))


def format_probability(value: Column, places: int = 4) -> Column:
    return F.round(value, places)


def _ladder(value: Column, steps: list[tuple[float, str]], rest: str, strict: bool) -> Column:
    out = None
    for bound, name in steps:
        hit = value > bound if strict else value >= bound
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return F.when(value.isNull(), F.lit(None)).otherwise(out.otherwise(rest))


def risk_tier(probability: Column, preset: str = "core") -> Column:
    """Tier name; the ``scoring`` preset gives null outside [0, 1] so callers can quarantine."""
    steps, rest = TIERS[preset]
    tier = _ladder(probability, steps, rest, strict=False)
    return F.when(probability.between(0.0, 1.0), tier) if preset == "scoring" else tier


def impact_level(importance: Column) -> Column:
    return _ladder(importance, *IMPACT, strict=True)


def risk_colour(level: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in RISK_COLOURS.items() for x in pair])
    return F.coalesce(F.try_element_at(table, level), F.lit(UNKNOWN_COLOUR))


def rule_term(feature: str, value: Column) -> Column:
    """One additive term of the rule score, of a column or of an array (NaN where there is no value)."""
    weight, full = RULE_TERMS[feature]
    if isinstance(value, np.ndarray):
        # like least(), which takes the bound where the value is missing or NaN
        return (value if full is None else np.fmin(value / full, 1.0)) * weight
    scaled = value if full is None else F.least(value / F.lit(full), F.lit(1.0))
    return scaled * F.lit(weight)


def rule_score(values: Mapping[str, Column] | None = None) -> Column:
    """Weighted rule score before clamping; ``values`` overrides feature columns (or holds an array for each)."""
    cols = {f: (values or {}).get(f, f) for f in RULE_FEATURES}
    cols = {f: F.col(c) if isinstance(c, str) else c for f, c in cols.items()}
    first, *rest = [rule_term(f, cols[f]) for f in RULE_FEATURES]
    for term in rest:
        first = first + term
    return first


def reasons(values: Mapping[str, Column] | None = None) -> Column:
    cols = {f: F.col(f) for f in RULE_FEATURES}
    cols.update(values or {})
    found = F.array_compact(F.array(*[F.when(cols[f] >= at, F.lit(name)) for name, f, at in REASONS]))
    return F.when(F.size(found) == 0, F.array(F.lit(NO_REASON))).otherwise(found)


def decision(probability: Column, threshold: float = 0.5) -> Column:
    return F.when(probability >= threshold, "fraud").otherwise("legitimate")


def over_threshold(score: Column, threshold: Column | float) -> Column:
    return (score >= threshold).cast("int")


def normalised_weights(weights: Mapping[str, float]) -> dict[str, float]:
    clipped = {m: max(float(w), 0.0) for m, w in weights.items()}
    total = sum(clipped.values()) or 1.0
    return {m: w / total for m, w in clipped.items()}


def blend(scores: Mapping[str, Column], weights: Mapping[str, float] | None = None) -> tuple[Column, dict[str, Column]]:
    """Weighted blend of a fixed model list: (blended score, per-model contributions).

    Without weights all models count alike; with weights, a model that has none
    counts 0, as does a negative weight, and a weight sum of 0 counts 1.  The
    score is the sum of the contributions, each rounded to 6 places, and is not
    clamped; no models give 0.
    """
    clipped = {m: 1.0 if weights is None else max(float(weights.get(m, 0.0)), 0.0) for m in scores}
    total_weight = sum(clipped.values()) or 1.0
    parts = {m: F.round(F.coalesce(scores[m], F.lit(0.0)) * F.lit(clipped[m] / total_weight), 6) for m in scores}
    total: Column = F.lit(0.0)
    for part in parts.values():
        total = total + part
    return F.round(total, 6), parts


def blend_map(scores: Column, weights: Column | None = None) -> Column:
    """``blend`` of a ``map<model, score>`` column: struct(score, contributions, label).

    The label is 1 from a blended score of 0.5.  An empty map scores 0; a null map
    gives nulls.
    """
    def weight(model: Column) -> Column:
        if weights is None:
            return F.lit(1.0)
        return F.greatest(F.coalesce(F.try_element_at(weights, model), F.lit(0.0)), F.lit(0.0))

    raw = F.map_from_entries(F.transform(F.map_keys(scores), lambda m: F.struct(m, weight(m))))
    total = F.aggregate(F.map_values(raw), F.lit(0.0), lambda a, w: a + w)
    total = F.when(total == 0, F.lit(1.0)).otherwise(total)
    parts = F.map_zip_with(scores, raw, lambda m, s, w: F.round(F.coalesce(s, F.lit(0.0)) * (w / total), 6))
    blended = F.aggregate(F.map_values(parts), F.lit(0.0), lambda a, p: a + p)
    return F.struct(F.round(blended, 6).alias("score"), parts.alias("contributions"), (blended >= 0.5).cast("int").alias("label"))


def outcome_type(label: Column, predicted: Column) -> Column:
    return (
        F.when((label == 1) & (predicted == 1), "TP")
        .when((label == 0) & (predicted == 1), "FP")
        .when((label == 1) & (predicted == 0), "FN")
        .otherwise("TN")
    )


def rule_points(rules: Sequence[tuple[Column, float]]) -> Column:
    """Sum of the points of the rules that hold."""
    total: Column = F.lit(0.0)
    for condition, points in rules:
        total = total + F.when(condition, F.lit(float(points))).otherwise(F.lit(0.0))
    return total


def logit(values: Mapping[str, Column], weights: Mapping[str, float], bias: float = 0.0) -> Column:
    total: Column = F.lit(float(bias))
    for name, weight in weights.items():
        total = total + values[name] * F.lit(float(weight))
    return total


def logistic(z: Column) -> Column:
    if isinstance(z, np.ndarray):
        with np.errstate(over="ignore"):
            return 1.0 / (1.0 + np.exp(-z))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def _bce_with_logits(z: Column, label: Column) -> Column:
    return F.greatest(z, F.lit(0.0)) - z * label + F.log1p(F.exp(-F.abs(z)))


def focal_loss(z: Column, label: Column, alpha: float = 0.25, gamma: float = 2.0) -> Column:
    """Focal loss from a logit, stable for large |z|."""
    p = logistic(z)
    p_t = F.when(label == 1, p).otherwise(1.0 - p)
    alpha_t = F.when(label == 1, F.lit(alpha)).otherwise(F.lit(1.0 - alpha))
    return alpha_t * F.pow(1.0 - p_t, F.lit(gamma)) * _bce_with_logits(z, label)


def weighted_bce(z: Column, label: Column, weight_0: Column, weight_1: Column) -> Column:
    """Class-weighted binary cross-entropy from a logit."""
    return F.when(label == 1, weight_1).otherwise(weight_0) * _bce_with_logits(z, label)
