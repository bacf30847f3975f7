"""Matching of two record lists in tiers: each tier pairs what is unique on both sides and not matched yet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.functions.text import chosen_filled, chosen_name, symbol_key
from terrace.operators.ordering import cut


def unique_pairs(left: DataFrame, right: DataFrame, keys: list[str], method: str) -> DataFrame:
    """left_id, right_id and match_method where keys stand once on either side; an empty last key matches nothing."""
    one = lambda df, side: df.where(F.col(keys[-1]) != "").groupBy(*keys).agg(F.min(f"{side}_id").alias(f"{side}_id"), F.count(F.lit(1)).alias("n")).where("n = 1").drop("n")
    return one(left, "left").join(one(right, "right"), keys).select("left_id", "right_id", F.lit(method).alias("match_method"))


def override_pairs(left: DataFrame, right: DataFrame, overrides: DataFrame, method: str = "manual_override") -> DataFrame:
    """left_id, right_id and match_method of the listed pairs of which both records are there.

    overrides: left_id, right_id and place, one row for each left_id; of several pairs with one right_id the first counts.
    """
    there = overrides.join(left.select("left_id"), "left_id", "left_semi").join(right.select("right_id"), "right_id", "left_semi")
    return there.groupBy("right_id").agg(F.min_by("left_id", F.struct("place", "left_id")).alias("left_id")).select("left_id", "right_id", F.lit(method).alias("match_method"))


def tiered(left: DataFrame, right: DataFrame, exact: list[str], tiers: list[tuple[str, list[str]]], overrides: DataFrame | None = None) -> DataFrame:
    """left_id, right_id and match_method of every record, each in one row.

    exact: columns that name the same record; of several records with one name the last of either side counts, and the
    others go on to the tiers; then the tiers (method, keys) in order; then the overrides of records that
    are still unused; then what is left on each side.
    """
    last = lambda df, side: df.groupBy(*exact).agg(F.max(f"{side}_id").alias(f"{side}_id"))
    # Each tier's pairs are cut, so that the next ones don't work them out again.
    pairs = cut(last(left, "left").join(last(right, "right"), exact).select("left_id", "right_id", F.lit("exact").alias("match_method")))
    rest = lambda: (left.join(pairs, "left_id", "left_anti"), right.join(pairs, "right_id", "left_anti"))
    for method, keys in tiers:
        pairs = pairs.unionByName(cut(unique_pairs(*rest(), keys, method)))
    if overrides is not None:
        pairs = pairs.unionByName(cut(override_pairs(*rest(), overrides)))
    only_left = left.join(pairs, "left_id", "left_anti").select("left_id", F.lit(None).cast("long").alias("right_id"), F.lit("left_only").alias("match_method"))
    only_right = right.join(pairs, "right_id", "left_anti").select(F.lit(None).cast("long").alias("left_id"), "right_id", F.lit("right_only").alias("match_method"))
    return pairs.unionByName(only_left).unionByName(only_right)


def master_list(matches: DataFrame, left: DataFrame, right: DataFrame, generic: list[str]) -> DataFrame:
    """One row for each match: canonical_id, display_name, display_symbol, in_left and in_right as 0 and 1, and the method.

    left and right: left_id or right_id, name, symbol and slug. What only one side has is taken from it.
    """
    side = lambda df, s: df.select(f"{s}_id", *(F.col(c).alias(f"{s}_{c}") for c in ("name", "symbol", "slug")))
    both = matches.join(side(left, "left"), "left_id", "left").join(side(right, "right"), "right_id", "left")
    has = lambda s: F.col(f"{s}_id").isNotNull().cast("int")
    return both.select(
        F.coalesce(chosen_filled(F.col("left_slug"), F.col("right_slug")), F.lit("")).alias("canonical_id"), chosen_name(F.col("left_name"), F.col("right_name"), generic).alias("display_name"),
        symbol_key(chosen_filled(F.col("left_symbol"), F.col("right_symbol"))).alias("display_symbol"), has("left").alias("in_left"), has("right").alias("in_right"), "match_method",
    )
