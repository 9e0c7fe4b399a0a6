"""The board as the state of a stream: what is kept of an advert stands under its identity and leaves by a timer.

The board of ``operators.board`` is written anew for each part of a day. Here only what changes is written: a drop of
adverts meets the states of its own identities and appends a row for each advert that comes onto the board or replaces one.

The identity is the link, else title, company and city, else the advert itself. Of a day's adverts with one identity
the first (by _seq) counts; one of a later day replaces it and keeps the day on which it was found, as long as it had not
left before. A row leaves on the first day on which ``board.is_fresh`` is false: the day after both its stated date is
``days`` old (without one, its finding) and its finding ``floor`` days. Each row tells that day, so that a board of any day can be
read from the changes; the timer frees the state once no drop that is still taken can need it.

Drops may come up to ``LATE`` behind the newest day; a day older than one that an identity has already had replaces
nothing. What is older still is late data, which the watermark leaves out. A drop that lands twice changes nothing.
Blank and null fields are equal. An empty drop changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from vacantia.functions import rules as R
from vacantia.functions.patterns import strip, text
from vacantia.functions.text import as_date
from vacantia.operators.dedupe import duplicate_key

#: How far behind the newest day a drop may be.
LATE = "2 days"
LANDED = "identity string, day date, seq long, posted date"
CHANGED = "identity string, day int, seq long, found int, leaves int"
_DAY_MS = 86_400_000


def identity() -> Column:
    link, key = strip(text("job_url")), duplicate_key()
    by_key = F.when((key["t"] != "") & (key["c"] != ""), F.concat(F.lit("k:"), F.to_json(key)))
    return F.sha2(F.when(link != "", F.concat(F.lit("l:"), link)).otherwise(F.coalesce(by_key, F.concat(F.lit("r:"), F.col("_seq")))), 256)


def land(ads: DataFrame, day: Column, folder: str) -> None:
    """Put a drop before the stream: one narrow row for each identity and day, however many adverts share it."""
    marks = ads.select(identity().alias("identity"), day.alias("day"), F.col("_seq").cast("long").alias("seq"), as_date(F.col("date_posted")).alias("posted"))
    first = marks.groupBy("identity", "day").agg(F.min(F.struct("seq", "posted")).alias("first"))
    first.select("identity", "day", "first.*").write.mode("append").parquet(f"{folder}/drops")


def _keeping(days: int, floor: int):
    def kept(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last, found, leaves = state.get if state.exists else (-1, -1, -1)
        out = []
        for day, seq, posted in sorted(row for part in parts for row in zip(part["day"], part["seq"], part["posted"])):
            if day <= last:
                continue
            last, found = day, found if leaves >= day else day
            leaves = max((posted if posted >= 0 else found) + days, found + floor) + 1
            out.append((key[0], day, seq, found, leaves))
        state.update((int(last), int(found), int(leaves)))
        state.setTimeoutTimestamp(max(int(leaves) * _DAY_MS, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(out, columns=["identity", "day", "seq", "found", "leaves"])

    return kept


def start(spark: SparkSession, folder: str, days: int = R.BOARD_DAYS, floor: int = R.BOARD_DAYS_FLOOR) -> StreamingQuery:
    """Take in all drops that have landed and stop; states and the changes go on from where the last run ended."""
    landed = spark.readStream.schema(LANDED).parquet(f"{folder}/drops")
    dated = landed.select("identity", F.col("day").cast("timestamp").alias("at"), F.unix_date("day").alias("day"), "seq", F.coalesce(F.unix_date("posted"), F.lit(-1)).alias("posted"))
    changes = dated.withWatermark("at", LATE).groupBy("identity").applyInPandasWithState(
        _keeping(days, floor), CHANGED, "last int, found int, leaves int", "append", GroupStateTimeout.EventTimeTimeout
    )
    to = changes.writeStream.format("parquet").outputMode("append").option("path", f"{folder}/changes")
    return to.option("checkpointLocation", f"{folder}/states").trigger(availableNow=True).start()


def as_of(changes: DataFrame, today: str) -> DataFrame:
    """The board at the end of a day: _seq of the advert, its day, date_added and the day on which it will leave."""
    now = F.unix_date(F.to_date(F.lit(today)))
    newest = changes.where(F.col("day") <= now).groupBy("identity").agg(F.max(F.struct("day", "seq", "found", "leaves")).alias("r")).select("r.*")
    date = lambda c: F.date_format(F.date_from_unix_date(c), "yyyy-MM-dd")
    return newest.where(F.col("leaves") > now).select(F.col("seq").alias("_seq"), date("day").alias("day"), date("found").alias("date_added"), date("leaves").alias("leaves"))
