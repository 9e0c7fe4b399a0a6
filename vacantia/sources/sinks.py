"""Sinks: JSON and CSV files, the board, and append-only tables of strings."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.functions import rules as R
from vacantia.functions import text as X
from vacantia.functions.patterns import text
from vacantia.operators import board, dedupe

log = logging.getLogger(__name__)


def save_json(ads: DataFrame, path: str, csv: str | None = None) -> None:
    """One JSON object a line, and a CSV with a header if wanted. Written by all tasks; readers take the folder."""
    ads.write.mode("overwrite").json(path)
    if csv:
        flat = [F.array_join(c, ", ").alias(c) if t.startswith("array<string") else F.col(c) for c, t in ads.dtypes]
        ads.select(*flat).write.mode("overwrite").option("header", True).csv(csv)


def wrapped(ads: DataFrame, size: int = 1000, **facts: Column) -> DataFrame:
    """{page, count, jobs, ...}: pages of adverts by their numbers, ``size`` numbers a page, so that no row grows with the table."""
    advert = F.struct(*(F.col(c) for c in ["_seq", *(x for x in ads.columns if x != "_seq")]))
    paged = ads.groupBy(F.expr(f"_seq div {size}").alias("page"))
    return paged.agg(F.count(F.lit(1)).alias("count"), F.sort_array(F.collect_list(advert)).alias("jobs"), *(v.alias(k) for k, v in facts.items()))


def save_wrapped(ads: DataFrame, path: str, **facts: Column) -> None:
    """JSON objects with a list of jobs each, a line a page; what reads adverts takes them as it takes bare ones."""
    wrapped(ads, **facts).write.mode("overwrite").json(path)


def save_board(rows: DataFrame, path: str) -> None:
    board.ordered(rows).write.mode("overwrite").json(path)


def _s(c: str) -> Column:
    return text(F.col(c).cast("string"))


def sheet_rows(ads: DataFrame, stamp: str) -> DataFrame:
    """The sixteen columns of the sheet, all strings."""
    salary = X.sheet_salary(F.col("salary_min"), F.col("salary_max"), F.col("salary_currency"))
    values = (F.lit(stamp), _s("date_posted"), _s("title"), _s("company"), _s("primary_role"), _s("location"), X.title_case(_s("workplace_policy")), X.bullets(_s("must_have_skills")), X.bullets(_s("nice_to_have_skills")), _s("experience_years"), X.title_case(_s("job_level")), X.title_case(_s("employment_type")), salary, _s("blurb"), X.title_case(_s("source")), _s("job_url"))
    return ads.select(*(v.alias(n) for v, n in zip(values, R.SHEET_COLUMNS)))


def exclude_rows(ads: DataFrame, stamp: str) -> DataFrame:
    values = (F.lit(stamp), _s("excluded_stage"), _s("excluded_reason"), _s("title"), _s("company"), _s("primary_role"), _s("location"), X.title_case(_s("source")), _s("job_url"), F.substring(_s("description_snippet"), 1, 500), F.when(F.col("needs_review"), "YES").otherwise(""))
    return ads.select(*(v.alias(n) for v, n in zip(values, R.EXCLUDE_COLUMNS)))


#: Bits of a sheet's filter: 2 MiB, whatever the sheet's size.
FILTER_BITS = 1 << 24


def _bit(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(FILTER_BITS)) + 1  # bitmap functions count from 1


def _seen(keys: DataFrame) -> DataFrame:
    """A Bloom filter of a column ``_k``: bitmaps of 32,768 bits by bucket, FILTER_BITS bits together at most."""
    at = keys.select(_bit(F.col("_k")).alias("bit"))
    return at.groupBy(F.bitmap_bucket_number("bit").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("_bits"))


def without_keys(rows: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """Rows whose key (a string) is not among ``keys`` (a column ``_k``).

    Most of a day's rows are new to a large table: a filter of fixed size tells which are so for sure, and these are
    neither shuffled nor compared. Only rows that the filter may have seen meet the keys. A full filter passes none by,
    and every row is compared. Rows with a null or empty key all stay.
    """
    keyed = rows.withColumn("_k", key)
    bit = _bit(F.col("_k"))
    probed = keyed.where("_k != ''").withColumn("_bucket", F.bitmap_bucket_number(bit)).withColumn("_at", F.bitmap_bit_position(bit))
    told = probed.join(F.broadcast(_seen(keys.where("_k != ''"))), "_bucket", "left")  # FILTER_BITS / 8 bytes at most
    byte = F.conv(F.hex(F.substring("_bits", (F.col("_at").cast("int") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    told = told.withColumn("_maybe", F.coalesce(F.getbit(byte, F.col("_at").cast("int") % 8) == 1, F.lit(False)))
    maybe = told.where("_maybe").join(keys.select("_k").where("_k != ''").distinct(), "_k", "left_anti")
    return maybe.select(rows.columns).unionByName(told.where("not _maybe").select(rows.columns)).unionByName(keyed.where("coalesce(_k, '') = ''").select(rows.columns))


def _unlinked(ads: DataFrame, sheet: DataFrame) -> DataFrame:
    """Adverts whose link the sheet does not have; those without a link all stay."""
    return without_keys(ads, F.col("job_url"), sheet.select(F.col("Apply Link").alias("_k")))


def _comparable(key: Column) -> Column:
    return F.when((key["t"] != "") & (key["c"] != ""), F.concat_ws("\n", key["t"], key["c"], key["p"])).otherwise("")


def new_rows(ads: DataFrame, sheet: DataFrame) -> DataFrame:
    """Adverts whose link, and whose comparable key, the sheet does not have; first per link, newest first."""
    keys = dedupe.key_from_row(sheet).select(_comparable(F.col("_key")).alias("_k"))
    left = _unlinked(dedupe.first_by_url(ads, trimmed=False), sheet)
    return without_keys(left, _comparable(dedupe.duplicate_key()), keys).orderBy(F.desc(text("date_posted")), "_seq")


def new_excluded(ads: DataFrame, tab: DataFrame) -> DataFrame:
    """Those whose link the tab does not have; without a link, always."""
    return _unlinked(ads, tab)


def latest_first(sheet: DataFrame) -> DataFrame:
    """A sheet's rows by its first column, the date they were added, the newest first."""
    return sheet.orderBy(F.desc(sheet.columns[0]))


def migrated(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """A table with an older header: missing columns are '', others in the order of today's header."""
    return rows.select(*(text(F.col(f"`{c}`").cast("string")).alias(c) if c in rows.columns else F.lit("").alias(c) for c in columns))


def append(rows: DataFrame, path: str, columns: tuple[str, ...], batch: str) -> None:
    """Append a batch to a Parquet table of strings; created on the first run. A batch that is appended again replaces itself."""
    migrated(rows, columns).write.mode("overwrite").parquet(f"{path}/batch={batch}")


def is_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def existing(spark, path: str, columns: tuple[str, ...], but: str | None = None) -> DataFrame:
    """The table without the batch ``but``, or an empty one if there is none yet; any other fault is raised."""
    try:
        found = spark.read.parquet(path)
    except AnalysisException as error:
        if not is_missing(error):
            raise
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in columns))
    return migrated(found if but is None or "batch" not in found.columns else found.where(F.col("batch").cast("string") != but), columns)


def isolated(sinks: dict[str, Callable[[], None]], rescue: dict[str, Callable[[], None]] | None = None) -> list[str]:
    """Run every sink; those that raise are logged, saved by their rescue, and named."""
    failed = []
    for name, write in sinks.items():
        try:
            write()
        except Exception:
            log.exception("sink %s failed", name)
            failed.append(name)
            if rescue and name in rescue:
                rescue[name]()
    return failed


def source_counts(ads: DataFrame) -> DataFrame:
    return ads.groupBy(text("source").alias("source")).agg(F.count(F.lit(1)).alias("n"))
