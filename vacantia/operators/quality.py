"""Reports and checks over the stages' outputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.functions import rules as R
from vacantia.functions.patterns import text
from vacantia.functions.text import identity, percent, report_cell

from .dedupe import deduplicate
from .extract import accepted_rule


def with_identity(ads: DataFrame) -> DataFrame:
    return ads.withColumn("_id", identity(F.col("job_url"), F.col("title"), F.col("company")))


def kept_minus_excluded(levelled: DataFrame, excluded: DataFrame) -> DataFrame:
    return with_identity(levelled).join(with_identity(excluded).select("_id").distinct(), "_id", "left_anti").drop("_id")


def counted(ads: DataFrame, column: str, blank: str = "(none)") -> DataFrame:
    """(value, n, first): most frequent first, ties by first appearance."""
    value = F.coalesce(F.nullif(text(column), F.lit("")), F.lit(blank))
    return ads.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("n"), F.min("_seq").alias("first")).orderBy(F.desc("n"), "first")


def level_counts(ads: DataFrame) -> DataFrame:
    return counted(ads, "job_level", R.UNKNOWN).select("value", "n")


def role_counts(ads: DataFrame) -> DataFrame:
    return counted(ads, "role_type").select("value", "n")


def fill_rates(ads: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, filled, total, pct); a figure of 0 counts as filled."""
    filled = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), (text(F.col(c).cast("string")) != "").alias("filled")) for c in columns)))
    tally = ads.select(filled.alias("f")).groupBy("f.column").agg(F.count_if("f.filled").alias("filled"), F.count(F.lit(1)).alias("total"))
    return tally.withColumn("pct", percent(F.col("filled"), F.col("total")))


def stage_counts(excluded: DataFrame) -> DataFrame:
    return counted(excluded, "excluded_stage").select("value", "n")


def flagged(ads: DataFrame, most: int = 10) -> DataFrame:
    return ads.where("needs_review").orderBy("_seq").limit(most)


def enrichment_headroom(ads: DataFrame) -> DataFrame:
    """One row: adverts whose keywords suffice, and what they would lose without enrichment."""
    enough = ~F.col("needs_ai_skills")
    return ads.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(enough).alias("enough"),
        F.count_if(enough & (text("blurb") != "")).alias("would_lose_blurb"), F.count_if(enough & (text("primary_role") != "")).alias("would_lose_role"),
    )


def fingerprints(ads: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, present): whether a stage that sets the column ran: it exists and some row has a value."""
    have = [c for c in columns if c in ads.columns]
    row = ads.agg(*(F.max(F.col(c).isNotNull()).alias(c) for c in have)) if have else None
    pairs = F.array(*(F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c), F.lit(False)).alias("present")) for c in have), *(F.struct(F.lit(c).alias("column"), F.lit(False).alias("present")) for c in columns if c not in have))
    base = row if row is not None else ads.sparkSession.range(1)
    return base.select(F.explode(pairs).alias("p")).select("p.*")


def reconcile(levelled: DataFrame, kept: DataFrame, excluded: DataFrame) -> DataFrame:
    size = lambda df, n: df.agg(F.count(F.lit(1)).alias(n)).withColumn("_one", F.lit(1))
    row = size(levelled, "levelled").join(size(kept, "kept"), "_one").join(size(excluded, "excluded"), "_one").drop("_one")
    return row.withColumn("balanced", F.col("levelled") == F.col("kept") + F.col("excluded"))


def duplicates_left(ads: DataFrame) -> DataFrame:
    size = lambda df, n: df.agg(F.count(F.lit(1)).alias(n)).withColumn("_one", F.lit(1))
    bare = ads.drop("duplicate_count")
    return size(bare, "a").join(size(deduplicate(bare), "b"), "_one").selectExpr("a - b as duplicates_left")


def bad_level_sources(ads: DataFrame) -> DataFrame:
    return ads.agg(F.count_if(F.col("level_source") == "ai").alias("from_ai"))


def funnel(stages: dict[str, DataFrame | None]) -> DataFrame:
    """(stage, n): a stage without a file has null, an empty one 0."""
    out = None
    for i, (name, df) in enumerate(stages.items()):
        n = next(iter(stages.values() if df is None else [df]))
        spark = next(d for d in stages.values() if d is not None).sparkSession
        row = spark.range(1).select(F.lit(i).alias("place"), F.lit(name).alias("stage"), F.lit(None).cast("long").alias("n")) if df is None else n.agg(F.count(F.lit(1)).alias("n")).select(F.lit(i).alias("place"), F.lit(name).alias("stage"), "n")
        out = row if out is None else out.unionByName(row)
    return out


def verdict(problems: Sequence[str]) -> int:
    """The exit code of a check run."""
    return 1 if problems else 0


def decision_buckets(levelled: DataFrame, excluded: DataFrame) -> DataFrame:
    """(screen, has_role, n): the first screen's decision against whether a role was found."""
    dropped = with_identity(excluded.where(F.col("excluded_stage") == R.STAGE_NON_TECH)).select("_id").distinct().withColumn("_hit", F.lit(True))
    joined = with_identity(levelled).join(dropped, "_id", "left")
    return joined.groupBy(F.when(F.col("_hit"), "dropped").otherwise("kept").alias("screen"), (text("role_type") != "").alias("has_role")).agg(F.count(F.lit(1)).alias("n"))


def decision_report(levelled: DataFrame, excluded: DataFrame) -> dict[str, DataFrame]:
    non_tech = excluded.where(F.col("excluded_stage") == R.STAGE_NON_TECH)
    return {"buckets": decision_buckets(levelled, excluded), "rules": counted(non_tech, "excluded_rule"), "sources": counted(levelled, "role_source"), "headroom": enrichment_headroom(levelled)}


def needs_a_look() -> Column:
    return (accepted_rule(F.col("title")) == "") | (text("role_source") == "search_term")


def sample(ads: DataFrame, size: int, seed: int = 0) -> DataFrame:
    """So many adverts, by a hash of identity and seed: the same ones every time."""
    return with_identity(ads).orderBy(F.xxhash64("_id", F.lit(seed)), "_seq").limit(size).drop("_id")


def target_for(size: int) -> int:
    return round(size * 18 / 20)


def _table(rows: list, columns: Sequence[str]) -> list[str]:
    return ["| " + " | ".join(columns) + " |", "|" + " --- |" * len(columns), *("| " + " | ".join("" if x is None else str(x) for x in r) + " |" for r in rows)]


def level_sheet(ads: DataFrame, size: int = 20, seed: int = 0) -> str:
    """A Markdown sheet for people to mark levels on. Bounded by ``size``."""
    rows = sample(ads, size, seed).select(report_cell(F.col("title")), report_cell(F.col("company"), 30), "job_level", "level_source", report_cell(F.col("level_evidence"), 40)).collect()
    return "\n".join(["# Level review", "", f"Target: {target_for(len(rows))} of {len(rows)} right", "", *_table([(i + 1, *r, "") for i, r in enumerate(rows)], ("#", "Title", "Company", "Level", "Source", "Evidence", "Right?")), ""])


def tech_sheet(ads: DataFrame, size: int = 60, seed: int = 0, share: float = 0.05) -> str:
    """A Markdown sheet of kept adverts, those that need a look first."""
    some = sample(ads, size, seed).withColumn("_flag", needs_a_look())
    rows = some.orderBy(F.desc("_flag"), "_seq").select(report_cell(F.col("title")), report_cell(F.col("company"), 30), report_cell(F.col("role_type"), 40), F.when(F.col("_flag"), "look").otherwise("")).collect()
    warning = [] if len(rows) >= 40 else ["Fewer than 40 adverts: too few to judge.", ""]
    return "\n".join(["# Non-tech review", "", f"Allowed: {int(len(rows) * share)} of {len(rows)} not tech", "", *warning, *_table([(i + 1, *r, "") for i, r in enumerate(rows)], ("#", "Title", "Company", "Role", "Flag", "Tech?")), ""])


def drops_sheet(excluded: DataFrame, size: int = 40, seed: int = 0) -> str:
    """A Markdown sheet of excluded adverts, with stage and reason, for people to mark wrong ones on."""
    rows = sample(excluded, size, seed).orderBy("excluded_stage", "_seq").select("excluded_stage", report_cell(F.col("title")), report_cell(F.col("company"), 30), report_cell(F.col("excluded_reason"), 60)).collect()
    return "\n".join(["# Drops review", "", f"Target: {target_for(len(rows))} of {len(rows)} rightly dropped", "", *_table([(i + 1, *r, "") for i, r in enumerate(rows)], ("#", "Stage", "Title", "Company", "Reason", "Right?")), ""])
