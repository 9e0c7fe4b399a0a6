"""Screens: every advert is kept or excluded, with the stage, the reason and the rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.functions import rules as R
from vacantia.functions.patterns import ANY_CASE, text

from .extract import accepted_rule, blocked_title


def _verdict(keep: bool, reason: Column | str, rule: Column | str = "", review: Column | bool = False, tier: str = "") -> Column:
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(F.lit(keep).alias("keep"), lit(reason).alias("reason"), lit(rule).alias("rule"), lit(review).alias("review"), F.lit(tier).alias("tier"))


def non_tech() -> Column:
    label = text("primary_role")
    blocked, by_label, by_title = blocked_title(F.col("title")), accepted_rule(F.col("primary_role")), accepted_rule(F.col("title"))
    said = F.when(label != "", F.concat(F.lit("role label was '"), label, F.lit("'"))).otherwise("no role label")
    return (
        F.when(blocked != "", _verdict(False, F.concat(F.lit("title matches excluded role word: '"), blocked, F.lit("'")), "title_blocklist"))
        .when(by_label != "", _verdict(True, "", F.concat(F.lit("role_label:"), by_label)))
        .when(by_title != "", _verdict(True, "", F.concat(F.lit("title:"), by_title)))
        .otherwise(_verdict(False, F.concat(F.lit("role type not accepted ("), said, F.lit(")")), "role_not_accepted"))
    )


def off_track() -> Column:
    role, source = text("role_type"), F.coalesce(F.nullif(text("role_source"), F.lit("")), F.lit("unknown"))
    return (
        F.when(role.isin(*R.PUBLISHED_ROLES), _verdict(True, ""))
        .when(role == "", _verdict(False, "no role type -- title and description named no role", review=True))
        .otherwise(_verdict(False, F.concat(F.lit("role type is "), role, F.lit(", off track (from "), source, F.lit(")"))))
    )


def above_cohort() -> Column:
    years, level = F.col("experience_years"), F.coalesce(F.nullif(text("job_level"), F.lit("")), F.lit(R.UNKNOWN))
    shown = years.cast("string")
    or_else = lambda c, d: F.coalesce(F.nullif(text(c), F.lit("")), d if isinstance(d, Column) else F.lit(d))
    senior = F.regexp_extract(text("title"), ANY_CASE + R.SENIOR_TITLE, 0)
    return (
        F.when(years >= R.YEARS_TOO_MANY, _verdict(False, F.concat(F.lit("asks for "), shown, F.lit("+ years (from "), or_else("years_source", "unknown"), F.lit(": '"), or_else("years_evidence", F.concat(shown, F.lit(" years"))), F.lit("')")), review=or_else("years_source", "unknown") != "text"))
        .when(~level.isin(*R.PUBLISHED_LEVELS), _verdict(False, F.concat(F.lit("level is "), level, F.lit(" (from "), or_else("level_source", "unknown"), F.lit(": '"), or_else("level_evidence", "nothing recorded"), F.lit("')")), review=or_else("level_source", "unknown") == "description"))
        .when(senior != "", _verdict(False, F.concat(F.lit("title says '"), senior, F.lit("'"))))
        .when(level.isin(R.ENTRY, R.JUNIOR) & (years.isNull() | (years <= R.YEARS_TO_APPLY)), _verdict(True, "", tier=R.TIER_APPLY))
        .when(level.isin(R.ENTRY, R.JUNIOR), _verdict(True, F.concat(level, F.lit(" but asks "), shown, F.lit(" years")), tier=R.TIER_STRETCH))
        .when(level == R.MID, _verdict(True, F.concat(F.lit("mid level, asks "), F.coalesce(shown, F.lit("no")), F.lit(" years")), tier=R.TIER_STRETCH))
        .otherwise(_verdict(True, "level could not be established", review=True, tier=R.TIER_STRETCH))
    )


def screened(ads: DataFrame) -> DataFrame:
    """All adverts with kept, tier and the earliest screen that they failed. Kept ones have the rule that let them in."""
    ads = ads.withColumns({"_a": non_tech(), "_b": off_track(), "_c": above_cohort()})
    first = F.when(~F.col("_a.keep"), "_a").when(~F.col("_b.keep"), "_b").when(~F.col("_c.keep"), "_c")
    pick = lambda field: F.when(first == "_a", F.col(f"_a.{field}")).when(first == "_b", F.col(f"_b.{field}")).when(first == "_c", F.col(f"_c.{field}"))
    return ads.withColumns({
        "kept": first.isNull(),
        "tier": F.when(first.isNull(), F.col("_c.tier")).otherwise(""),
        "tier_reason": F.when(first.isNull(), F.col("_c.reason")).otherwise(""),
        "excluded_stage": F.coalesce(F.when(first == "_a", R.STAGE_NON_TECH).when(first == "_b", R.STAGE_OFF_TRACK).when(first == "_c", R.STAGE_ABOVE), F.lit("")),
        "excluded_reason": F.coalesce(pick("reason"), F.lit("")),
        "excluded_rule": F.coalesce(pick("rule"), F.col("_a.rule")),
        "needs_review": F.coalesce(pick("review"), F.col("_c.review")),
    }).drop("_a", "_b", "_c")


def screen_counts(ads: DataFrame) -> DataFrame:
    """One row: input, kept, and what each stage dropped."""
    of = lambda stage: F.count_if(F.col("excluded_stage") == stage)
    return ads.agg(F.count(F.lit(1)).alias("input"), F.count_if("kept").alias("kept"), of(R.STAGE_NON_TECH).alias("non_tech"), of(R.STAGE_OFF_TRACK).alias("off_track"), of(R.STAGE_ABOVE).alias("above_cohort"), F.count_if("needs_review").alias("to_review"))
