"""Derived columns, bins and display text."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Abbreviation -> expansion, applied in this order as substring replacement.
ABBREVIATIONS = {
    "Amt": "Amount",
    "Num": "Number",
    "Avg": "Average",
    "Std": "Standard Deviation",
    "Max": "Maximum",
    "Min": "Minimum",
    "Txn": "Transaction",
    "30d": "30 Days",
    "7d": "7 Days",
    "24h": "24 Hours",
}
# Exploration bins, right-closed.
AMOUNT_EDGES = [0.0, 10.0, 50.0, 100.0, 500.0, float("inf")]
MERCHANT_RISK_EDGES = [0.0, 0.01, 0.05, 1.0]
MERCHANT_RISK_LABELS = ["Low", "Medium", "High"]


def literal_rows(rows: Sequence[dict], schema: str) -> Column:
    """A constant array of structs; one literal however many rows (the optimizer folds it)."""
    return F.from_json(F.lit(json.dumps(list(rows))), f"array<struct<{schema}>>")


def hour_from_elapsed(seconds: Column) -> Column:
    """Hour of day from seconds since the first row."""
    return F.pmod(F.floor(seconds / 3600.0), F.lit(24)).cast("int")


def log_amount(amount: Column) -> Column:
    return F.log1p(amount)


def parse_timestamp(text: Column, fmt: str | None = None) -> Column:
    """Lenient parse: text that is not a timestamp becomes null."""
    return F.try_to_timestamp(text, F.lit(fmt)) if fmt else F.try_to_timestamp(text)


def default_for_missing(value: Column, default) -> Column:
    return F.coalesce(value, F.lit(default))


def bin_label(low: float, high: float) -> str:
    show = lambda x: "inf" if x == float("inf") else f"{x:g}"
    return f"({show(low)}, {show(high)}]"


def right_closed_bin(value: Column, edges: Sequence[float], labels: Sequence[str] | None = None) -> Column:
    """Name of the bin ``(low, high]`` that holds the value; null outside all bins."""
    out = None
    for i, (low, high) in enumerate(zip(edges, edges[1:])):
        name = labels[i] if labels else bin_label(low, high)
        hit = (value > low) & (value <= high)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out


def bin_order(name: Column, edges: Sequence[float], labels: Sequence[str] | None = None) -> Column:
    """Position of a bin name, for ordered output."""
    names = list(labels) if labels else [bin_label(a, b) for a, b in zip(edges, edges[1:])]
    return F.array_position(F.array(*[F.lit(n) for n in names]), name).cast("int")


def readable_name(feature: Column) -> Column:
    """``avg_txn_amt_30d`` -> ``Average Transaction Amount 30 Days``."""
    words = F.initcap(F.trim(F.regexp_replace(F.translate(feature, "_", " "), " +", " ")))
    for short, long in ABBREVIATIONS.items():
        words = F.replace(words, F.lit(short), F.lit(long))
    return words


def currency_text(value: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(value, 2))


def number_text(value: Column, integer: bool = False) -> Column:
    return F.format_number(value, 0 if integer else 2)


def percent_text(share: Column, places: int = 1) -> Column:
    return F.format_string(f"%.{places}f%%", F.round(share * 100.0, places))
