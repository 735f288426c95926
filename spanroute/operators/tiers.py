"""Which tier a route serves, from its type, reach and span."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Route types that declare a tier, and those that have none.
DECLARED = {
    "national": [101, 102, 103, 105, 114, 202],
    "international": [201],
    "regional": [106, 109, 204, 208, 701, 903],
    "local": [108, 400, 401, 402, 403, 404, 405, 704, 901, 902],
}
OUT_OF_SCOPE = [(1100, 1199), (1500, 1599), (1600, 1799)]
BASIC = [0, 1, 2, 3, 4, 5, 6, 7, 11, 12]
FAMILIES = [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 12, 13, 14]
INTERCITY_KM, NEAR, PENALTY = 25.0, 0.2, 0.7


def near(value: Column, threshold: Column) -> Column:
    """Within a fifth of the threshold."""
    return F.coalesce(F.abs(value - threshold) <= NEAR * threshold, F.lit(False))


def decide(kind: Column, mode: Column, local: Column, regions: Column, span: Column, reference: Column, zone: Column, gap: Column) -> Column:
    """struct(tier, confidence, rule, margin): the first row of the decision table that holds.

    What was compared with a threshold and lies within a fifth of it has less confidence.
    """
    declared = F.lit(None).cast("string")
    for tier, kinds in DECLARED.items():
        declared = F.when(kind.isin(kinds), tier).otherwise(declared)
    out = F.lit(False)
    for lo, hi in OUT_OF_SCOPE:
        out = out | kind.between(lo, hi)
    known = kind.isin(BASIC) | ((kind >= 100) & F.floor(kind / 100).isin(FAMILIES))
    far = F.coalesce(gap >= INTERCITY_KM, F.lit(False))
    close = near(gap, F.lit(INTERCITY_KM))
    either = near(span, reference) | close

    def row(tier: str | Column, confidence: float, rule: str, margin: Column | None = None) -> Column:
        tier = F.lit(tier) if isinstance(tier, str) else tier
        margin = F.lit(False) if margin is None else margin
        return F.struct(tier.alias("tier"), F.when(margin, confidence * PENALTY).otherwise(F.lit(confidence)).alias("confidence"), F.lit(rule).alias("rule"), margin.alias("margin"))

    return (
        F.when(kind.isNull(), row("unknown", 0.0, "unknown")).when(declared.isNotNull(), row(declared, 0.95, "declared")).when(out, row("unknown", 0.0, "out_of_scope"))
        .when(~known, row("unknown", 0.0, "unknown")).when(local == "one_city", row("local", 0.9, "one_city"))
        .when((local == "one_metro") & (mode == "rail"), row("regional", 0.85, "metro_rail")).when(local == "one_metro", row("local", 0.85, "one_metro"))
        .when(zone & (regions < 2), row("regional", 0.75, "regional")).when(zone, row("regional", 0.75, "zone")).when(far, row("national", 0.75, "intercity", close))
        .when(regions < 2, row("regional", 0.75, "regional", close)).when(span.isNull() | reference.isNull(), row("regional", 0.6, "regional", close))
        .when(span > reference, row("national", 0.75, "regions_and_span", either)).otherwise(row("regional", 0.75, "regional", either))
    )


def needs_review(decision: Column) -> Column:
    return (decision["tier"] == "unknown") | (decision["confidence"] < 0.7) | decision["margin"]


def agreement(declared: Column, observed: Column) -> Column:
    """How declared and observed countries agree: unknown, same, within, partial or different."""
    both = F.size(F.array_intersect(declared, observed))
    return (
        F.when(F.coalesce(F.size(declared), F.lit(0)) * F.coalesce(F.size(observed), F.lit(0)) == 0, "unknown").when(both == 0, "different")
        .when((both == F.size(declared)) & (both == F.size(observed)), "same").when(both == F.size(observed), "within").otherwise("partial")
    )
