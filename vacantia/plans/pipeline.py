"""The daily run: feeds to labelled adverts to screens to sinks."""

from __future__ import annotations

import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacantia.functions import rules as R
from vacantia.functions import skills as S
from vacantia.operators import board, dedupe, enrich, extract, quality, screen
from vacantia.sources import sinks


def labelled(ads: DataFrame, vocabulary: tuple[S.Skill, ...] = S.DEFAULT, provider: enrich.Provider | None = None) -> DataFrame:
    """Deduplicated, then skills, enrichment, years, levels (which read years), roles, and official skill names."""
    missing = {c: F.lit("") for c in enrich.FIELDS if c not in ads.columns}  # feeds have no blurb; only enrichment writes one
    unique = materialised(dedupe.deduplicate(ads.withColumns(missing) if missing else ads))
    found = extract.with_keyword_skills(unique, vocabulary)
    found = enrich.enrich(found, provider)
    return extract.with_official_skills(extract.with_roles(extract.with_levels(extract.with_years(found))), vocabulary)


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a temporary one only where that is unset and the session is local."""
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir", None)
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        if folder is None:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            folder = tempfile.mkdtemp(prefix="vacantia-")
        sc.setCheckpointDir(folder)
    return folder or sc._jsc.sc().getCheckpointDir().get()


def materialised(df: DataFrame) -> DataFrame:
    """``df`` computed once, into the shared folder.

    Screens and searches read labels many times over; a filter on them must not be pushed through the rules that make them.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint()


def screened(ads: DataFrame, **options) -> DataFrame:
    return screen.screened(materialised(labelled(ads, **options)))


def current_board(spark: SparkSession, folder: str, but: str | None = None) -> DataFrame | None:
    """The newest whole version of the board, not made by the batch ``but``; None before the first.

    Versions without _SUCCESS were never finished.
    """
    ended = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/board/*/_SUCCESS")
    found = ended.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(ended)
    versions = [x.getPath().getParent().getName() for x in found or ()]
    versions = [v for v in versions if but is None or v.partition(".")[2] != but]
    return spark.read.parquet(f"{folder}/board/{max(versions)}") if versions else None


def failures(ads: DataFrame, today: str, folder: str, provider: enrich.Provider | None = None, part: str = "0") -> tuple[list[str], bool]:
    """One day, or one part of a day: every sink is tried. Returns the sinks that failed, and whether an advert was kept.

    The labelled stage is written once and read by all that follow. Sheets and board hold each part as a batch of its own:
    a part that runs again, after a failure between the sinks or behind them, replaces its own rows and no others. The board
    is a new version each time, made from the last whole one of another part.
    """
    spark = ads.sparkSession
    stamp, batch = f"{today} 00:00:00", f"{today}-{part}"
    labels, screens = f"{folder}/labelled/{today}/part={part}", f"{folder}/screened/{today}/part={part}"
    labelled(ads, provider=provider).write.mode("overwrite").parquet(labels)
    screen.screened(spark.read.parquet(labels)).write.mode("overwrite").parquet(screens)
    rows = spark.read.parquet(screens)
    kept, excluded = rows.where("kept"), rows.where("not kept")

    def sheet() -> None:
        have = sinks.existing(spark, f"{folder}/sheet", R.SHEET_COLUMNS, but=batch)
        sinks.append(sinks.sheet_rows(sinks.new_rows(kept, have), stamp), f"{folder}/sheet", R.SHEET_COLUMNS, batch)

    def exclude() -> None:
        have = sinks.existing(spark, f"{folder}/excluded", R.EXCLUDE_COLUMNS, but=batch)
        sinks.append(sinks.exclude_rows(sinks.new_excluded(excluded, have), stamp), f"{folder}/excluded", R.EXCLUDE_COLUMNS, batch)

    def publish() -> None:
        incoming = kept if "date_added" in kept.columns else kept.selectExpr("*", "'' as date_added")
        old = current_board(spark, folder, but=batch)
        old = incoming.limit(0) if old is None else old.select(incoming.columns)
        merged = board.prune(board.merge(old, incoming, today), today)
        merged.write.parquet(f"{folder}/board/{time.time_ns():020d}.{batch}")

    some = not kept.isEmpty()
    wanted = {"sheet": sheet, "excluded": exclude, "board": publish} if some else {"excluded": exclude}
    failed = sinks.isolated(wanted, {"sheet": lambda: sinks.save_json(kept, f"{folder}/rescue/{today}/part={part}")})
    return failed, some


def run(ads: DataFrame, today: str, folder: str, provider: enrich.Provider | None = None, part: str = "0") -> int:
    """The exit code of a day: a failed sheet and a day without a kept advert are faults."""
    failed, some = failures(ads, today, folder, provider, part)
    return quality.verdict([x for x in failed if x == "sheet"] + ([] if some else ["no advert was kept"]))
