"""Feeds: readers of landed files, and normalisers that give every feed the same columns.

Nothing here fetches by itself: ``fetch`` is a plain function with retries for a landing job, and readers work on what
has landed. A feed that fails gives no rows and does not stop the others.
"""

from __future__ import annotations

import datetime as dt
import logging
import time
import urllib.error
import urllib.request
from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vacantia.functions import rules as R
from vacantia.functions import text as X
from vacantia.functions.patterns import text

log = logging.getLogger(__name__)
STRINGS = "source search_term title company company_logo company_url company_description company_industry company_size location city country workplace_policy primary_role other_roles must_have_skills nice_to_have_skills company_tech_stack experience_years job_level employment_type date_posted time_posted job_url job_url_direct description_snippet salary_currency salary_period".split()
DOUBLES, BOOLEANS = ("company_rating", "salary_min", "salary_max"), ("is_remote", "visa_sponsorship", "requires_work_auth")
ADVERT = T.StructType([*(T.StructField(c, T.StringType()) for c in STRINGS), *(T.StructField(c, T.DoubleType()) for c in DOUBLES), *(T.StructField(c, T.BooleanType()) for c in BOOLEANS)])


def conform(df: DataFrame) -> DataFrame:
    """The advert's columns with their types; missing ones are null. _seq, if there is one, stays."""
    cast = [(F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in ADVERT.fields]
    return df.select(*(["_seq"] if "_seq" in df.columns else []), *cast)


def read_adverts(spark: SparkSession, path: str, schema: T.StructType = ADVERT) -> DataFrame:
    """Adverts of JSON files (a glob may name several): {"jobs": [...]} or [...]. Missing or corrupt ones give no rows."""
    try:
        whole = spark.read.option("multiLine", True).schema(T.StructType([T.StructField("jobs", T.ArrayType(schema)), *schema.fields])).json(path)
    except AnalysisException as error:
        log.warning("no adverts in %s: %s", path, error.getCondition())
        return spark.createDataFrame([], schema)
    wrapped = whole.where("jobs is not null").select(F.inline("jobs"))
    return wrapped.unionByName(whole.where("jobs is null").drop("jobs").where(reduce(lambda a, b: a | b, (F.col(f.name).isNotNull() for f in schema.fields))))


def read_if_there(spark: SparkSession, path: str, schema: T.StructType = ADVERT) -> DataFrame | None:
    """None where there is no file, which is not the same as one without adverts."""
    try:
        spark.read.format("binaryFile").load(path).limit(0).count()
    except AnalysisException:
        return None
    return read_adverts(spark, path, schema)


def numbered(df: DataFrame, *order: str) -> DataFrame:
    """_seq, by columns that order the rows for good; in parts of the range, each counted by itself, so that no task holds all.

    Numbers depend on where the parts begin, so what is made of them must not be computed twice: write it through first.
    """
    keyed = df.withColumn("_h", F.struct(*order))
    parts = keyed.repartitionByRange("_h").sortWithinPartitions("_h")
    return parts.withColumn("_seq", F.monotonically_increasing_id()).drop("_h")


def union(feeds: dict[str, Callable[[], DataFrame]], skip: set[str] = frozenset()) -> DataFrame | None:
    """All feeds' adverts; one that raises is logged and left out."""
    got = []
    for name, make in feeds.items():
        if name in skip:
            continue
        try:
            got.append(conform(make()))
        except Exception:
            log.exception("feed %s left out", name)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), got) if got else None


LISTING = """jobListings array<struct<name string, id string, published_at string, primary_role_name string, years_experience int, employment_type string, currency_code string,
 remuneration_period string, remuneration_min double, remuneration_max double, description string, workplace_policy string, visa_sponsorship_available boolean, requires_work_authorisation boolean,
 company_profile struct<name string, id string, logo_small_url string, tech_stack array<struct<title string>>>, locations array<struct<city string, country string, display_address string>>,
 must_have_skill_experiences array<struct<skill string>>, nice_to_have_skills array<struct<skill string>>, other_roles array<struct<name string>>>>"""


def api_pages(pages: DataFrame) -> DataFrame:
    """Landed pages of the API feed (column json) as adverts at home. An empty page, or one that is no JSON, gives none."""
    j = pages.select(F.inline(F.from_json("json", LISTING)["jobListings"]))
    date = X.parse_date(F.col("published_at"))
    places = F.array_join(F.transform("locations", lambda p: F.coalesce(p["display_address"], F.concat_ws(", ", p["city"], p["country"]))), "; ")
    names = lambda c, f: F.array_join(F.transform(c, lambda x: x[f]), ", ")
    out = j.select(
        F.lit("api").alias("source"), X.clean_text(F.col("name")).alias("title"), X.clean_text(F.col("company_profile.name")).alias("company"), F.col("company_profile.logo_small_url").alias("company_logo"),
        names(F.col("company_profile.tech_stack"), "title").alias("company_tech_stack"), text(places).alias("location"), text(F.get(F.col("locations"), F.lit(0))["city"]).alias("city"), text(F.get(F.col("locations"), F.lit(0))["country"]).alias("country"),
        text("primary_role_name").alias("primary_role"), text(names(F.col("other_roles"), "name")).alias("other_roles"), text(names(F.col("must_have_skill_experiences"), "skill")).alias("must_have_skills"), text(names(F.col("nice_to_have_skills"), "skill")).alias("nice_to_have_skills"),
        F.col("years_experience").cast("string").alias("experience_years"), text("employment_type").alias("employment_type"), date["date"].alias("date_posted"), date["time"].alias("time_posted"),
        X.job_url(F.col("company_profile.id"), F.col("id")).alias("job_url"), X.clean_text(F.col("description"), 3000).alias("description_snippet"), text("workplace_policy").alias("workplace_policy"), (F.lower(text("workplace_policy")) == "remote").alias("is_remote"),
        F.nullif("remuneration_min", F.lit(0.0)).alias("salary_min"), F.nullif("remuneration_max", F.lit(0.0)).alias("salary_max"), text("currency_code").alias("salary_currency"), text("remuneration_period").alias("salary_period"),
        F.col("visa_sponsorship_available").alias("visa_sponsorship"), F.col("requires_work_authorisation").alias("requires_work_auth"),
    )
    return conform(out.where(X.at_home(F.col("location"))))


#: Names that stand for none.
UNLISTED = ("not listed", "unlisted", "confidential", "n/a", "none", "nan", "unknown", "company confidential")


#: Where the links of a source's company pages hold the company, and whether its name is put in title case.
COMPANY_PAGES = {"search": ("indeed.com/cmp/", False), "network": ("linkedin.com/company/", True)}


def company(c: Column, url: Column, description: Column, from_description: bool = True, source: str = "search") -> Column:
    """The company as listed, else by the link of its page at the source, else by the description."""
    listed = X.clean_text(c)
    host, titled = COMPANY_PAGES.get(source, COMPANY_PAGES["search"])
    found = [F.when(~F.lower(listed).isin(*UNLISTED), listed), X.company_from_url(url, host, titled)]
    if from_description:
        found.append(X.company_from_description(description))
    return F.coalesce(*(F.nullif(x, F.lit("")) for x in found), F.lit(""))


def search_frame(rows: DataFrame, source: str, home: str = "South Africa", from_description: bool = True) -> DataFrame:
    """Rows of a search feed (nested or flat) as adverts. Salaries of 0 are none; a location is a struct or a string."""
    have = rows.columns
    cell = lambda c: X.known_cell(F.col(c)) if c in have else F.lit(None).cast("string")
    nested = "location" in have and isinstance(rows.schema["location"].dataType, T.StructType)
    pay = F.col("compensation") if "compensation" in have else None
    money = lambda c: F.coalesce(F.nullif(pay[c].cast("double"), F.lit(0.0)) if pay is not None else F.lit(None).cast("double"), F.when((pay.isNull() if pay is not None else F.lit(True)), F.nullif(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0))) if c in have else F.lit(None).cast("double"))
    word = lambda c: text(F.coalesce(pay[c], cell(c)) if pay is not None else cell(c))
    part = lambda f: F.nullif(text(F.col("location")[f]), F.lit(""))
    place = F.concat_ws(", ", part("city"), part("state"), F.coalesce(part("country"), F.lit(home))) if nested else text(cell("location"))
    date = X.parse_date(cell("date_posted"))
    skills = F.array_join("skills", ", ") if "skills" in have and isinstance(rows.schema["skills"].dataType, T.ArrayType) else text(cell("skills"))
    out = rows.select(
        *(["_seq"] if "_seq" in have else []), F.lit(source).alias("source"), cell("search_term").alias("search_term"), X.clean_text(cell("title")).alias("title"),
        company(cell("company_name"), text(cell("company_url")), text(cell("description")), from_description, source).alias("company"), cell("company_logo").alias("company_logo"), cell("company_url").alias("company_url"),
        cell("company_description").alias("company_description"), cell("company_num_employees").alias("company_size"), cell("company_rating").alias("company_rating"), place.alias("location"),
        (text(F.col("location")["city"]) if nested else F.trim(F.split(place, ",")[0])).alias("city"), (F.coalesce(part("country"), F.lit(home)) if nested else F.lit(home)).alias("country"), cell("is_remote").alias("is_remote"), text(cell("work_from_home_type")).alias("workplace_policy"),
        text(cell("job_function")).alias("primary_role"), skills.alias("must_have_skills"), cell("experience_range").alias("experience_years"), text(cell("job_level")).alias("job_level"), text(cell("job_type")).alias("employment_type"),
        date["date"].alias("date_posted"), date["time"].alias("time_posted"), text(cell("job_url")).alias("job_url"), text(cell("job_url_direct")).alias("job_url_direct"), X.clean_text(cell("description"), 3000).alias("description_snippet"),
        money("min_amount").alias("salary_min"), money("max_amount").alias("salary_max"), word("currency").alias("salary_currency"), word("interval").alias("salary_period"),
    )
    return conform(out)


def newest_first(ads: DataFrame) -> DataFrame:
    return ads.orderBy(X.sort_key(F.col("date_posted"), F.col("time_posted")).desc(), "_seq")


def search_terms(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, *t) for i, t in enumerate(R.SEARCH_TERMS)], "place int, phrase string, role_type string, cadence string")


def terms_for(terms: DataFrame, day: Column, spread: bool = True) -> DataFrame:
    """Daily terms, and those of the parity of the day (a date, or a column of ``terms``); all of them if they are not spread."""
    return terms.where(F.col("cadence").isin("daily") | (F.col("cadence") == F.when(F.dayofyear(day) % 2 == 0, "even").otherwise("odd"))) if spread else terms


def role_for_term(phrase: str) -> str | None:
    return next((r for p, r, _ in R.SEARCH_TERMS if p == phrase), None)


def retry(call: Callable, tries: int = 3, delay: float = 2.0, backoff: float = 2.0, errors: tuple = (Exception,), never: tuple = (), again: Callable[[BaseException], bool] | None = None, sleep: Callable[[float], None] = time.sleep):
    """``call`` until it succeeds, waiting longer each time; errors of ``never``, or that ``again`` refuses, are raised at once."""
    for left in range(tries - 1, -1, -1):
        try:
            return call()
        except never:
            raise
        except errors as error:
            if not left or (again and not again(error)):
                raise
            sleep(delay)
            delay *= backoff


def fetch(url: str, seconds: float = 30.0, opener: Callable = urllib.request.urlopen) -> bytes | None:
    """The body, or None on an error of network or status."""
    try:
        with opener(url, timeout=seconds) as reply:
            return reply.read() if getattr(reply, "status", 200) < 400 else None
    except (urllib.error.URLError, TimeoutError, OSError) as error:
        log.warning("%s: %s", url, error)
        return None


def land_pages(get: Callable[[int], list | None], most: int = 50) -> list[list]:
    """Pages from 1 on, until one is empty or fails, or ``most`` are there."""
    out: list[list] = []
    for page in range(1, most + 1):
        found = get(page)
        if not found:
            break
        out.append(found)
    return out


def within_days(ads: DataFrame, today: dt.date, days: int) -> DataFrame:
    """Undated ones and those not before the cut-off."""
    posted = X.as_date(F.col("date_posted"))
    return ads.where(posted.isNull() | (posted >= F.date_sub(F.lit(today), days)))
