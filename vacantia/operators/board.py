"""The board: a kept snapshot that each day's adverts are merged into and old ones leave.

Merging. An incoming advert takes the place of the board's advert with its link (the first such), else of the one with
its title/company/city (the last such). Each board row has one winner at most: the first incoming advert that found it.
Whoever replaces a row keeps the row's place and date_added; others are added at the end.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.functions import rules as R
from vacantia.functions.patterns import strip, text
from vacantia.functions.text import as_date

from .dedupe import duplicate_key


def best_date() -> Column:
    return F.coalesce(F.nullif(text("date_posted"), F.lit("")), text("date_added"))


def _found(board: DataFrame, incoming: DataFrame) -> DataFrame:
    """(_seq, _row) of the incoming adverts that find a row of the board. Blank links and keys meet nothing."""
    key = lambda df: df.select("_seq", strip(text("job_url")).alias("_url"), duplicate_key().alias("_key"))
    old, new = key(board), key(incoming)
    comparable = "_key.t != '' and _key.c != ''"
    by_url = old.where("_url != ''").groupBy("_url").agg(F.min("_seq").alias("_row"))
    by_key = old.where(comparable).groupBy("_key").agg(F.max("_seq").alias("_row"))
    hits = new.where("_url != ''").join(by_url, "_url").select("_seq", F.lit(0).alias("by"), "_row")
    hits = hits.unionByName(new.where(comparable).join(by_key, "_key").select("_seq", F.lit(1).alias("by"), "_row"))
    return hits.groupBy("_seq").agg(F.min_by("_row", "by").alias("_row"))


def merge(board: DataFrame, incoming: DataFrame, today: str, origin: bool = False) -> DataFrame:
    """Both have the same columns, _seq and date_added among them. ``origin``: adds _origin, kept, replaced or added."""
    columns = board.columns
    found = _found(board, incoming)
    winners = found.groupBy("_row").agg(F.min("_seq").alias("_seq"))
    last = board.agg(F.coalesce(F.max("_seq"), F.lit(-1)).alias("_last")).first()["_last"]
    kept_date = board.select(F.col("_seq").alias("_row"), F.col("date_added").alias("_added"))
    own = lambda df, d: df.withColumn("date_added", F.coalesce(F.nullif(text(d), F.lit("")), F.nullif(text("date_added"), F.lit("")), F.lit(today)))
    placed = incoming.join(winners.join(kept_date, "_row"), "_seq", "left")
    replaced = own(placed.where("_row is not null"), "_added").withColumn("_seq", F.col("_row")).select(columns)
    added = own(placed.where("_row is null"), "date_added").withColumn("_seq", F.col("_seq") + last + 1).select(columns)
    kept = board.join(winners.select(F.col("_row").alias("_seq")), "_seq", "left_anti").select(columns)
    parts = {"kept": kept, "replaced": replaced, "added": added}
    return reduce(DataFrame.unionByName, (df.withColumn("_origin", F.lit(name)) if origin else df for name, df in parts.items()))


def is_fresh(today: str, days: int = R.BOARD_DAYS, floor: int = R.BOARD_DAYS_FLOOR) -> Column:
    """Not those whose stated date is over ``days`` old and that were found over ``floor`` days ago; undated ones are."""
    posted, found, now = as_date(F.col("date_posted")), as_date(F.col("date_added")), F.to_date(F.lit(today))
    fresh = (F.coalesce(posted, found) >= F.date_sub(now, days)) | (found >= F.date_sub(now, floor))
    return F.coalesce(posted, found).isNull() | F.coalesce(fresh, F.lit(False))


def prune(board: DataFrame, today: str, days: int = R.BOARD_DAYS, floor: int = R.BOARD_DAYS_FLOOR) -> DataFrame:
    return board.where(is_fresh(today, days, floor))


def ordered(board: DataFrame) -> DataFrame:
    """Newest first; equal dates in the board's order."""
    return board.orderBy(F.desc(best_date()), "_seq")


def publish_counts(board: DataFrame, incoming: DataFrame, today: str) -> DataFrame:
    """One row, from one merge: each row of it tells where it comes from."""
    merged = merge(board, incoming, today, origin=True)
    row = merged.agg(F.expr("count_if(_origin != 'added')").alias("a"), F.expr("count_if(_origin != 'kept')").alias("b"), F.count(F.lit(1)).alias("c"), F.count_if(is_fresh(today)).alias("d"))
    return row.selectExpr("a as carried_over", "b as from_today", "c - d as pruned", "d as published")
