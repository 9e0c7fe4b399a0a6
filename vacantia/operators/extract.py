"""Facts read from an advert's words, with the evidence: years of experience, level, role, skills. All native."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.functions import rules as R
from vacantia.functions import skills as S
from vacantia.functions.patterns import ANY_CASE, first_rule, first_rule_match, spans, strip, text, window
from vacantia.functions.text import split_list


def _number(c: Column) -> Column:
    words = F.create_map(*(F.lit(x) for pair in R.NUMBER_WORDS.items() for x in pair))
    token = F.lower(F.regexp_extract(c, ANY_CASE + R.NUMBER, 0))
    return F.coalesce(token.try_cast("int"), F.try_element_at(words, token))


def _credible(t: Column, start: Column, end: Column) -> Column:
    """Whether what stands around a number of years makes it a requirement."""
    after, before = window(t, end, end + 60), window(t, start - 60, start)
    rejected = window(t, start - 25, start).rlike(ANY_CASE + R.PERIOD_BEFORE) | window(t, end, end + 40).rlike(ANY_CASE + R.OTHER_AFTER) | window(t, end, end + 40).rlike(ANY_CASE + R.HISTORY_AFTER)
    asked = (
        after.rlike(rf"{ANY_CASE}^\W*(?:of\s+|in\s+|as\s+|with\s+)?\W*{R.EXPERIENCE}")
        | F.substring(after, 1, 45).rlike(rf"{ANY_CASE}\b{R.EXPERIENCE}\b")
        | before.rlike(ANY_CASE + R.ASKED_BEFORE)
        | window(t, start - 45, start).rlike(rf"{ANY_CASE}\b{R.EXPERIENCE}\b\W*$")
    )
    return ~rejected & asked


#: A text up to its last word for years (every mention ends with one), what is looked at behind it, and the word that this cuts.
UP_TO_YEARS = r"(?isU)^.*y(?:ea)?rs?\b.{0,60}\w*"


def year_mentions(c: Column) -> Column:
    """array<struct<years, pattern, quote, start, end>> in the patterns' order; no two overlap."""
    return F.get(F.transform(F.array(F.regexp_extract(text(c), UP_TO_YEARS, 0)), _year_mentions), F.lit(0))


def _year_mentions(t: Column) -> Column:
    def hits(label: str, pattern: str) -> Column:
        """Credible mentions by one pattern. A function of its own: a lambda's second parameter would be the element's index."""
        quote = lambda s: strip(F.regexp_replace(window(t, s["start"] - 20, s["end"] + 30), r"(?U)\s+", " "))
        made = F.transform(spans(t, ANY_CASE + pattern), lambda s: F.struct(_number(s["match"]).alias("years"), F.lit(label).alias("pattern"), quote(s).alias("quote"), s["start"].alias("start"), s["end"].alias("end")))
        return F.filter(made, lambda h: (h["years"] <= R.MOST_YEARS) & _credible(t, h["start"], h["end"]))

    found = [hits(label, p) for label, p in R.YEARS_PATTERNS]
    kind = "array<struct<years:int,pattern:string,quote:string,start:int,end:int>>"
    free = lambda taken, h: ~F.exists(taken, lambda x: (h["start"] < x["end"]) & (h["end"] > x["start"]))
    return F.when(t.rlike(r"(?iU)y(?:ea)?rs?\b"), F.aggregate(F.concat(*found).cast(kind), F.array().cast(kind), lambda taken, h: F.when(free(taken, h), F.concat(taken, F.array(h))).otherwise(taken).cast(kind))).otherwise(F.array().cast(kind))


def coerce_years(c: Column) -> Column:
    """A feed's own figure as a number from 0 to 20: the first one or two digits of it."""
    s = F.trim(c.cast("string"))
    whole = s.try_cast("double")
    n = F.when(s.rlike(r"^-?\d+(\.\d+)?$"), F.when(whole.between(0, R.MOST_YEARS), whole.cast("int"))).otherwise(F.regexp_extract(s, r"\d{1,2}", 0).try_cast("int"))
    return F.when(n.between(0, R.MOST_YEARS), n)


def with_years(ads: DataFrame) -> DataFrame:
    """The lowest figure that description and title ask for, else the feed's; where from, and the first three quotes."""
    feed = coerce_years(F.col("experience_years"))
    ads = ads.withColumns({"_in_text": year_mentions(F.col("description_snippet")), "_in_title": year_mentions(F.col("title"))}).withColumn("_found", F.concat("_in_text", "_in_title")).drop("_in_text", "_in_title")
    stated = F.size("_found") > 0
    return ads.withColumns({
        "years_source": F.when(stated, "text").when(feed.isNotNull(), "feed").otherwise(""),
        "years_evidence": F.when(stated, F.array_join(F.transform(F.slice("_found", 1, 3), lambda m: m["quote"]), " | ")).otherwise(""),
        "experience_years": F.when(stated, F.array_min(F.transform("_found", lambda m: m["years"]))).otherwise(feed).cast("int"),
    }).drop("_found")


def normalise_level(c: Column) -> Column:
    table = F.create_map(*(F.lit(x) for pair in R.LEVEL_SYNONYMS.items() for x in pair))
    return F.coalesce(F.try_element_at(table, F.lower(strip(text(c)))), F.lit(""))


def level_from_years(years: Column) -> Column:
    out = F.when(years.isNull(), F.lit(None).cast("string"))
    for most, level in R.YEARS_LEVELS:
        out = out.when(years <= most, level)
    return out.otherwise(R.LEAD)


def derived_level() -> Column:
    """struct<level, source, evidence, confidence>: by title, else years, else description."""
    years = F.col("experience_years")
    by_title, by_text = first_rule_match(text("title"), R.TITLE_LEVELS), first_rule_match(text("description_snippet"), R.DESCRIPTION_LEVELS)
    of = lambda level, source, evidence, confidence: F.struct(level.alias("level"), F.lit(source).alias("source"), evidence.alias("evidence"), confidence.alias("confidence"))
    return (
        F.when(by_title.isNotNull(), of(by_title["label"], "title", by_title["evidence"], F.lit("high")))
        .when(years.isNotNull(), of(level_from_years(years), "years", F.concat(years.cast("string"), F.lit(" years")), F.when(years >= 3, "high").otherwise("medium")))
        .when(by_text.isNotNull(), of(by_text["label"], "description", by_text["evidence"], F.lit("medium")))
        .otherwise(of(F.lit(R.UNKNOWN), "none", F.lit(""), F.lit("none")))
    )


def with_levels(ads: DataFrame) -> DataFrame:
    """Adds the level with its source, evidence and confidence; the first label that came from elsewhere is kept, so that running it again changes nothing."""
    if "ai_job_level" not in ads.columns:
        ads = ads.withColumn("ai_job_level", normalise_level(F.col("job_level")))
    return ads.withColumn("_l", derived_level()).withColumns({"job_level": F.col("_l.level"), "level_source": F.col("_l.source"), "level_evidence": F.col("_l.evidence"), "level_confidence": F.col("_l.confidence")}).drop("_l")


def with_roles(ads: DataFrame) -> DataFrame:
    by_title = first_rule(text("title"), R.TITLE_ROLES)
    by_text = first_rule(F.substring(text("description_snippet"), 1, R.DESCRIPTION_ROLE_CHARS), R.DESCRIPTION_ROLES)
    return ads.withColumns({"role_type": F.coalesce(by_title, by_text, F.lit("")), "role_source": F.when(by_title.isNotNull(), "title").when(by_text.isNotNull(), "description").otherwise("")})


def with_keyword_skills(ads: DataFrame, vocabulary: tuple[S.Skill, ...] = S.DEFAULT) -> DataFrame:
    """The feed's own skills and those that title and description name. ``ads`` is read twice (``skills.with_matches``)."""
    matched = S.with_matches(ads, S.haystack("title", "description_snippet"), "_matched", vocabulary)
    found = S.canonical(F.concat(split_list(F.col("must_have_skills")), F.col("_matched")), vocabulary)
    out = matched.withColumn("_s", found).withColumns({
        "must_have_skills": F.array_join("_s", ", "),
        "skills_source": F.when(F.size("_s") > 0, "keyword").otherwise(""),
        "needs_ai_skills": F.size("_s") < R.FEWEST_SKILLS,
    })
    return out.drop("_s", "_matched")


def with_official_skills(ads: DataFrame, vocabulary: tuple[S.Skill, ...] = S.DEFAULT) -> DataFrame:
    """After enrichment: both lists by official names, and where they came from."""
    ads = ads.withColumns({c: S.canonical_string(F.col(c), vocabulary) for c in ("must_have_skills", "nice_to_have_skills")})
    return ads.withColumn("skills_source", F.when(F.col("must_have_skills") == "", "").when(text("blurb") != "", "ai").otherwise(F.col("skills_source")))


def accepted_rule(c: Column) -> Column:
    return F.coalesce(first_rule(text(c), [(n, rf"\b(?:{p})") for n, p in R.ACCEPTED]), F.lit(""))


def blocked_title(c: Column) -> Column:
    """The leftmost blocked words of a title, else ''."""
    return F.regexp_extract(text(c), ANY_CASE + R.BLOCKED_PATTERN, 0)
