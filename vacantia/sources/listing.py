"""Paged feeds: reading landed pages side by side, and the rules by which a walk through pages stops.

A walk reads page 1, 2, ... and stops at the first page that is missing, has nothing, or has nothing new; with a cut-off,
also behind the first page of which something new is too old. Pages are read in parallel here, and what a walk would not have
reached is left out afterwards, by windows over one narrow row a page: pages behind the end change nothing, since
what is new on a page depends on the pages before it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from vacantia.functions import text as X


def walked(cards: DataFrame, term: str = "term", oldest: str | None = None) -> DataFrame:
    """The cards (term, page from 1 on, job_url, date_posted, ...) that a walk through each term's pages keeps.

    A link counts on the first page that has it; cards without a link are always new. ``oldest``: a date; older cards go,
    undated ones stay. Terms are walked on their own; rows with a null term or page go.
    """
    rows = cards.where(F.col(term).isNotNull() & F.col("page").isNotNull())
    link = F.coalesce(F.col("job_url"), F.lit(""))
    firsts = rows.where(link != "").groupBy(term, "job_url").agg(F.min("page").alias("_first"))
    # cards without a link join nothing, so that they never meet in one task
    dated = X.as_date(F.col("date_posted"))
    recent = F.lit(True) if oldest is None else F.coalesce(dated >= F.to_date(F.lit(oldest)), F.lit(True))
    linked = rows.where(link != "").join(firsts, [term, "job_url"]).withColumn("_new", F.col("page") == F.col("_first")).drop("_first")
    told = linked.select(*rows.columns, "_new").unionByName(rows.where(link == "").withColumn("_new", F.lit(True))).withColumn("_recent", F.col("_new") & recent)
    pages = told.groupBy(term, "page").agg(F.count_if("_new").alias("_news"), F.count_if("_recent").alias("_recents"))
    so_far = Window.partitionBy(term).orderBy("page")
    before = so_far.rowsBetween(Window.unboundedPreceding, -1)
    gap = F.col("page") != F.row_number().over(so_far)
    ends = pages.withColumn("_stop", gap | (F.col("_news") == 0)).withColumn("_last", F.col("_recents") < F.col("_news"))
    reached = ends.withColumn("_in", ~F.max("_stop").over(so_far) & ~F.coalesce(F.max("_last").over(before), F.lit(False))).where("_in").select(term, "page")
    return told.where("_recent").join(reached, [term, "page"]).select(cards.columns)


class _Range(InputPartition):
    def __init__(self, first: int, last: int):
        self.first, self.last = first, last


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.url, self.most, self.each, self.field = options["url"], int(options.get("most", 50)), int(options.get("pages", 10)), options.get("field", "")

    def partitions(self) -> list[InputPartition]:
        return [_Range(k, min(k + self.each - 1, self.most)) for k in range(1, self.most + 1, self.each)]

    def read(self, partition: _Range) -> Iterator[tuple]:
        """Each page's JSON, up to the range's first page that is missing, no JSON, or without an item."""
        from .feeds import fetch, retry

        packed = _packed(self.url.replace("{range}", str((partition.first - 1) // self.each))) if "{range}" in self.url else None
        for page in range(partition.first, partition.last + 1):
            url = self.url.replace("{page}", str(page))
            if packed is None and url.startswith(("http://", "https://")):
                body = retry(lambda: _there(fetch(url)), delay=1.5)  # noqa: B023
            else:
                body = _landed(url) if packed is None else packed.get(page)
                if body is None:
                    return
            try:
                held = json.loads(body)
            except ValueError:
                return
            if not (held.get(self.field) if self.field and isinstance(held, dict) else held):
                return
            yield page, body.decode("utf-8", "replace")


def _landed(uri: str) -> bytes | None:
    """A page's file, or the files of its folder in the order of their names; None if there is nothing."""
    from pyarrow import fs

    files, path = fs.FileSystem.from_uri(uri)
    kind = files.get_file_info(path).type
    if kind == fs.FileType.NotFound:
        return None
    parts = [path]
    if kind == fs.FileType.Directory:
        parts = sorted(f.path for f in files.get_file_info(fs.FileSelector(path)) if f.type == fs.FileType.File and not f.base_name.startswith((".", "_")))
    out = []
    for part in parts:
        with files.open_input_file(part) as f:
            out.append(f.read())
    return b"".join(out) if out else None


def _packed(uri: str) -> dict[int, bytes]:
    """Pages that were landed together, by number: lines of a number, a tab and the page's JSON."""
    lines = (line.partition(b"\t") for line in (_landed(uri) or b"").split(b"\n") if line)
    return {int(page): body for page, _, body in lines}


def _there(body: bytes | None) -> bytes:
    if body is None:
        raise OSError("no answer")
    return body


class Pages(DataSource):
    """spark.read.format("pages"): (page, json) of a paged feed, a range of pages a partition.

    Options: url with {page} in it (of a service, or of files or folders of files in any store that Arrow reads) or {range}
    (of folders that each hold the pages of a partition, numbered from 0), most (pages, 50), pages (of a partition, 10), field (whose emptiness makes a page empty; else the page itself).
    """

    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self) -> str:
        return "page int, json string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def read_pages(spark: SparkSession, url: str, **options) -> DataFrame:
    """The pages before the first that is missing or empty. Where that is, is told by how many pages each range has; ranges

    behind it have been read for nothing, and are not read again.
    """
    spark.dataSource.register(Pages)
    most, each = int(options.get("most", 50)), int(options.get("pages", 10))
    read = lambda last: spark.read.format("pages").options(url=url, **{**options, "most": last, "pages": each}).load()
    have = read(most).groupBy(F.expr(f"(page - 1) div {each}").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    ranges = spark.range(-(-most // each)).join(have, "id", "left").select((F.col("id") * each).alias("before"), F.coalesce("n", F.lit(0)).alias("n"))
    short = ranges.where(f"n < least({each}, {most} - before)").agg(F.min(F.expr("before + n"))).first()[0]
    last = most if short is None else short
    return read(max(last, 1)).where(F.col("page") <= last)
