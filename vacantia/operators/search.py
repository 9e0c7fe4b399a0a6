"""Queries on the board: filters, facets, matches and orders."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.functions import rules as R
from vacantia.functions.patterns import text
from vacantia.functions.text import split_list

from .board import best_date


#: What a keyword is looked for in.
SEARCHED = ("title", "company", "blurb", "description_snippet")


@dataclass(frozen=True)
class Filters:
    search: str = ""
    role_types: Sequence[str] = ()
    levels: Sequence[str] = ()
    skills: Sequence[str] = ()
    work_policies: Sequence[str] = ()
    sources: Sequence[str] = ()
    employment_types: Sequence[str] = ()
    max_years: float | None = None

    def active(self) -> bool:
        return bool(self.search or self.role_types or self.levels or self.skills or self.work_policies or self.sources or self.employment_types or self.max_years)


@dataclass(frozen=True)
class Criteria:
    role_types: Sequence[str] = ()
    levels: Sequence[str] = ()
    skills: Sequence[str] = ()

    def can_search(self) -> bool:
        return bool(self.role_types or self.levels)


def job_skills() -> Column:
    return F.concat(split_list(F.col("must_have_skills")), split_list(F.col("nice_to_have_skills")))


def one_of(c: Column, wanted: Sequence[str]) -> Column:
    return c.isin(*wanted) if wanted else F.lit(True)


def mentions(keyword: str) -> Column:
    q = (keyword or "").strip().lower()
    if not q:
        return F.lit(True)
    hit = F.lit(False)
    for c in SEARCHED:
        hit = hit | F.lower(text(c)).contains(q)
    return hit


def filter_jobs(jobs: DataFrame, f: Filters = Filters()) -> DataFrame:
    level = F.coalesce(F.nullif(text("job_level"), F.lit("")), F.lit(R.UNKNOWN))
    years = F.col("experience_years").cast("string").try_cast("double")
    out = jobs.where(one_of(text("role_type"), f.role_types)).where(one_of(level, f.levels)).where(one_of(text("workplace_policy"), f.work_policies))
    out = out.where(one_of(text("source"), f.sources)).where(one_of(text("employment_type"), f.employment_types)).where(mentions(f.search))
    if f.skills:
        out = out.where(F.arrays_overlap(job_skills(), F.array(*map(F.lit, f.skills))))
    return out if f.max_years is None else out.where(F.coalesce(years <= f.max_years, F.lit(True)))


def facet_values(jobs: DataFrame) -> DataFrame:
    """(facet, value): the distinct values that are not blank; a missing level is unknown."""
    level = F.coalesce(F.nullif(text("job_level"), F.lit("")), F.lit(R.UNKNOWN))
    named = {"role_type": text("role_type"), "job_level": level, "workplace_policy": text("workplace_policy"), "source": text("source"), "employment_type": text("employment_type")}
    pairs = jobs.select(F.explode(F.array(*(F.struct(F.lit(k).alias("facet"), v.alias("value")) for k, v in named.items()))).alias("p")).select("p.*")
    return pairs.where("value != ''").distinct()


def offered(facets: DataFrame, levels: Sequence[str] = ("entry level", "junior")) -> DataFrame:
    """The facets that a search form offers: of the levels only those that the board is for."""
    return facets.where((F.col("facet") != "job_level") | F.col("value").isin(*levels))


def facet_skills(jobs: DataFrame, skip: Sequence[str] = (), most: int | None = None) -> DataFrame:
    """(skill, n, first): by frequency, ties by first appearance. Duplicates within an advert count."""
    seen = jobs.select("_seq", F.posexplode(job_skills()).alias("p", "skill")).groupBy("skill").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("_seq", "p")).alias("first"))
    out = seen.where(~F.col("skill").isin(*skip)) if skip else seen
    out = out.orderBy(F.desc("n"), "first")
    return out if most is None else out.limit(most)


def match_jobs(jobs: DataFrame, c: Criteria) -> DataFrame:
    """Adverts of the wanted tracks within the years that the wanted levels allow, with the evidence and the skills in common."""
    years = F.col("experience_years").cast("string").try_cast("double")
    ceilings = [R.YEARS_CEILING[x] for x in c.levels if x in R.YEARS_CEILING]
    out = jobs.where(one_of(text("role_type"), c.role_types))
    if ceilings:
        out = out.where(years.isNull() | (years <= max(ceilings)))
    evidence = F.when(years.isNotNull(), "years").when(F.col("level_source") == "title", "title-only").otherwise("unstated")
    wanted = F.array(*map(F.lit, c.skills)) if c.skills else F.array().cast("array<string>")
    return out.withColumns({"overlap": F.filter(wanted, lambda s: F.array_contains(job_skills(), s)), "evidence": evidence, "years": years})


def ranked(matches: DataFrame) -> DataFrame:
    """Most skills in common, then best evidence, then newest, then first."""
    rank = F.when(F.col("evidence") == "years", 0).when(F.col("evidence") == "title-only", 1).otherwise(2)
    return matches.orderBy(F.desc(F.size("overlap")), rank, F.desc(best_date()), "_seq")


def sort_keys(order: str) -> list[Column]:
    if order == "match":
        return []
    if order == "oldest":
        return [best_date().asc(), F.col("_seq").asc()]
    if order == "years-asc":
        return [F.col("experience_years").cast("string").try_cast("double").asc_nulls_last(), F.col("_seq").asc()]
    return [best_date().desc(), F.col("_seq").asc()]


def search(jobs: DataFrame, c: Criteria, keyword: str = "", order: str = "match") -> DataFrame:
    found = match_jobs(jobs, c).where(mentions(keyword))
    keys = sort_keys(order)
    return found.orderBy(*keys) if keys else ranked(found)
