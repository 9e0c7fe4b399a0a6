"""Deduplication of adverts: by link, by title/company/city, and by the advert's text.

``_seq`` is the advert's place in its feed, its own, and stands for order: the first wins ties. All passes work on marks:
narrow rows with keys, ranks and tallies, of which each pass leaves one for each key, by aggregates that are merged
before and after a shuffle. An advert without a key has one of its own, so that blanks never meet in one task. Whole rows
are joined once, with what the passes leave. Tallies tell how many adverts each pass took, without running it again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.functions import text as T
from vacantia.functions.patterns import strip, text


def first_by_url(ads: DataFrame, trimmed: bool = True, drop_blank: bool = False) -> DataFrame:
    """The first advert of each link; those without a link all stay, or all go."""
    link = strip(text("job_url")) if trimmed else text("job_url")
    keyed = ads.withColumn("_key", link)
    firsts = keyed.where("_key != ''").groupBy("_key").agg(F.min("_seq").alias("_first"))
    kept = keyed.where("_key != ''").join(firsts, "_key").where("_seq = _first").drop("_key", "_first")
    return kept if drop_blank else kept.unionByName(keyed.where("_key = ''").drop("_key"))


def first_by_identity(ads: DataFrame) -> DataFrame:
    keyed = ads.withColumn("_key", T.identity(F.col("job_url"), F.col("title"), F.col("company")))
    return keyed.join(keyed.groupBy("_key").agg(F.min("_seq").alias("_seq")), ["_key", "_seq"], "left_semi").drop("_key")


def duplicate_key() -> Column:
    return F.struct(T.normalise_title(F.col("title")).alias("t"), T.normalise_company(F.col("company")).alias("c"), T.normalise_city(F.col("city"), F.col("location")).alias("p"))


def _bound(c: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once, however often f names it."""
    return F.get(F.transform(F.array(c), f), F.lit(0))


def marks(ads: DataFrame) -> DataFrame:
    """A narrow row for each advert: its own place (_from) and the one that it takes over (_seq), keys, what ranks it, and tallies.

    The third key is title, city and a digest of the text, where that is long enough to tell adverts apart.
    """
    own = F.concat(F.lit("#"), F.col("_seq").cast("string"))
    long = lambda s: F.when(F.length(s) >= T.MATCHABLE_DESCRIPTION, F.sha2(s, 256)).otherwise("")
    print_ = _bound(T.normalise(F.col("description_snippet")), long)

    def keys(of: Column) -> Column:
        key, x = of["key"], of["print"]
        named = F.when((key["t"] != "") & (key["c"] != ""), F.sha2(F.concat_ws("\n", key["t"], key["c"], key["p"]), 256)).otherwise(own)
        worded = F.when((key["t"] != "") & (x != ""), F.sha2(F.concat_ws("\n", key["t"], key["p"], x), 256)).otherwise(own)
        link = F.when(of["link"] != "", F.concat(F.lit("u"), of["link"])).otherwise(own)
        return F.struct(link.alias("link"), named.alias("key"), worded.alias("print"))

    found = _bound(F.struct(duplicate_key().alias("key"), print_.alias("print"), strip(text("job_url")).alias("link")), keys)
    place, one = F.col("_seq").cast("long"), F.lit(1).cast("long")
    again = F.col("duplicate_count") if "duplicate_count" in ads.columns else F.lit(0)
    made = ads.select(
        place.alias("_from"), place.alias("_seq"), found.alias("of"), F.length(text("description_snippet")).alias("length"), text("date_posted").alias("day"),
        again.cast("long").alias("again"), one.alias("came"), one.alias("links"), one.alias("keys"),
    )
    return made.select("_from", "_seq", "of.*", "length", "day", "again", "came", "links", "keys")


def _one_of_each(of: DataFrame, key: str, rank: Column, tallied: tuple[str, ...], again: Column | None) -> DataFrame:
    """Of each key the mark that ranks highest, in the place of the first one, with the sums of ``tallied``."""
    best = F.max_by(F.struct("_from", "link", "key", "print", "length", "day", "again", "came", "links", "keys"), rank).alias("r")
    sums = [F.sum(c).alias(f"_{c}") for c in tallied]
    took = of.groupBy(key).agg(best, F.min("_seq").alias("_seq"), *sums, *([] if again is None else [again.alias("_again")]))
    out = took.select("r.*", "_seq", *(f"_{c}" for c in tallied), *([] if again is None else ["_again"]))
    for c in (*tallied, *([] if again is None else ["again"])):
        out = out.withColumn(c, F.col(f"_{c}")).drop(f"_{c}")
    return out.select(of.columns)


def pass_links(of: DataFrame) -> DataFrame:
    return _one_of_each(of, "link", -F.col("_seq"), ("came",), None)


def pass_keys(of: DataFrame) -> DataFrame:
    """The fullest advert (longest description, then latest date, then first); again: how many others its key has."""
    return _one_of_each(of, "key", F.struct("length", "day", -F.col("_from")), ("came", "links"), F.sum(F.col("again") + 1) - 1)


def pass_texts(of: DataFrame) -> DataFrame:
    """As pass_keys, of adverts that agencies post again under another name; again: the first one's own plus the others."""
    return _one_of_each(of, "print", F.struct("length", "day", -F.col("_seq")), ("came", "links", "keys"), F.min_by("again", "_seq") + F.count(F.lit(1)) - 1)


def whole_rows(ads: DataFrame, left: DataFrame) -> DataFrame:
    """The adverts that are left, in their places, with duplicate_count. The one join, and shuffle, of whole rows."""
    columns = [c for c in ads.columns if c not in ("_seq", "duplicate_count")]
    took = left.select("_from", F.col("_seq").alias("_place"), F.col("again").alias("duplicate_count"))
    return ads.drop("duplicate_count").withColumn("_from", F.col("_seq").cast("long")).join(took, "_from").select(F.col("_place").alias("_seq"), *columns, "duplicate_count")


def by_key(ads: DataFrame) -> DataFrame:
    """Second pass; adds duplicate_count. An advert without title or company is compared with none."""
    return whole_rows(ads, pass_keys(marks(ads.drop("duplicate_count"))))


def by_text(ads: DataFrame) -> DataFrame:
    """Third pass: what agencies post again under another name."""
    return whole_rows(ads, pass_texts(marks(ads)))


def left_of(ads: DataFrame) -> DataFrame:
    """The marks that all three passes leave."""
    return pass_texts(pass_keys(pass_links(marks(ads.drop("duplicate_count")))))


def deduplicate(ads: DataFrame) -> DataFrame:
    return whole_rows(ads, left_of(ads))


def counts(ads: DataFrame) -> DataFrame:
    """One row: how many came, how many each pass took, how many are left; from the tallies of one run of the passes."""
    n = lambda c: F.coalesce(F.sum(c), F.lit(0))
    row = left_of(ads).agg(n("came").alias("a"), n("links").alias("b"), n("keys").alias("c"), F.count(F.lit(1)).alias("d"))
    return row.selectExpr("a as input", "a - b as by_url", "b - c as by_title_company_city", "c - d as by_same_advert_text", "d as output", "a - d as removed")


def key_from_row(rows: DataFrame) -> DataFrame:
    """The key of a sheet's rows, from their own columns."""
    place = F.split(text("Location"), ",")[0]
    return rows.withColumn("_key", F.struct(T.normalise_title(F.col("Job Title")).alias("t"), T.normalise_company(F.col("Company")).alias("c"), T.normalise(place).alias("p")))
