"""Keyword search over a kept board by trigrams, so that a keyword reads the adverts that may hold it and no others.

Postings are rows (gram, _seq): each run of three characters of an advert's lower-cased searchable fields, once. They lie in
folders by a bucket of the gram, each in SPREAD files or so by _seq, so that a common gram is no one's alone, in order of
the gram: a search reads the folders of its grams' buckets, and there the row groups of its grams (both filters reach the
scan). Each part (a day's adverts) has a folder of its own, which is written anew if the part is run again.

A search keeps the adverts that have all of a keyword's grams, joins these with the adverts and looks for the keyword
itself: the result is that of ``search.mentions``. Keywords of fewer than three characters have no gram: they are looked
for in all adverts, in one pass for all of them; a blank keyword fits all. Null fields are empty ones; equal keywords
count once; an advert without text has no postings; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vacantia.functions.patterns import text

from .search import SEARCHED

SIZE, BUCKETS, SPREAD = 3, 32, 8
SCHEMA = "gram string, _seq long, bucket int"


def _fields() -> Column:
    """Lower-cased fields with a line end between them, which no keyword's gram has to pass over."""
    return F.lower(F.concat_ws("\n", *map(text, SEARCHED)))


def grams(keyword: str) -> list[str]:
    """Runs of three characters that together cover the keyword; none if it is shorter."""
    at = [*range(0, len(keyword) - SIZE + 1, SIZE), len(keyword) - SIZE]
    return sorted({keyword[i : i + SIZE] for i in at if i >= 0})


#: Texts whose grams are one batch.
_SLICE = 64


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, _seq): the runs of three characters of each text (as UTF-8), once; 21 bits a character make a run a number."""
    for whole in batches:
        for at in range(0, whole.num_rows, _SLICE):
            batch, found = whole.slice(at, _SLICE), []
            for body in batch.column(0).to_pylist():
                c = np.frombuffer(body.decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.uint64)
                found.append(np.unique(c[:-2] << np.uint64(42) | c[1:-1] << np.uint64(21) | c[2:]))
            codes = np.concatenate(found)
            chars = np.stack([(codes >> np.uint64(k) & np.uint64(0x1FFFFF)).astype("<u4") for k in (42, 21, 0)], axis=1)
            sizes = (1 + (chars >= 0x80) + (chars >= 0x800) + (chars >= 0x10000)).sum(axis=1)
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            held = pa.StringArray.from_buffers(len(codes), pa.py_buffer(offsets), pa.py_buffer(chars.tobytes().decode("utf-32-le").encode()))
            yield pa.RecordBatch.from_arrays([held, batch.column(1).take(pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found])))], ["gram", "_seq"])


def post(jobs: DataFrame, folder: str, part: str) -> None:
    """Write the postings of a part's adverts, which have a ``_seq`` that no other part has."""
    rows = jobs.select(_fields().cast("binary").alias("body"), F.col("_seq").cast("long").alias("_seq")).mapInArrow(_runs, "gram string, _seq long")
    rows = rows.withColumn("bucket", (F.crc32("gram") % BUCKETS).cast("int")).repartition("bucket", F.pmod("_seq", F.lit(SPREAD)))
    rows.sortWithinPartitions("bucket", "gram").write.partitionBy("bucket").mode("overwrite").parquet(f"{folder}/part={part}")


def postings(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(SCHEMA).option("basePath", folder).parquet(f"{folder}/part=*").select("gram", "_seq", "bucket")


def candidates(index: DataFrame, keywords: Sequence[str]) -> DataFrame:
    """(keyword, _seq) of the adverts that have all grams of a keyword; the keywords are lower-cased, none is short."""
    wanted = [(k, g) for k in keywords for g in grams(k)]
    sizes = {k: len(grams(k)) for k in keywords}
    asked = index.sparkSession.createDataFrame([(k, g, sizes[k]) for k, g in wanted], "keyword string, gram string, size int")
    asked_grams = sorted({g for _, g in wanted})
    own = index.where(F.col("bucket").isin(sorted({zlib.crc32(g.encode()) % BUCKETS for g in asked_grams})) & F.col("gram").isin(asked_grams))
    hits = own.join(F.broadcast(asked), "gram")  # as small as the question
    return hits.groupBy("keyword", "_seq").agg(F.count(F.lit(1)).alias("n"), F.first("size").alias("size")).where("n = size").select("keyword", "_seq")


def found(jobs: DataFrame, index: DataFrame, keywords: Sequence[str]) -> DataFrame:
    """(keyword, _seq): the adverts that mention each keyword, which is told trimmed and in lower case."""
    asked = sorted({(k or "").strip().lower() for k in keywords})
    long, short = [k for k in asked if len(k) >= SIZE], [k for k in asked if len(k) < SIZE]
    read = jobs.select("_seq", *SEARCHED)
    holds = lambda k: F.greatest(*(F.contains(F.lower(text(c)), k) for c in SEARCHED))
    out = read.select(F.lit("").alias("keyword"), "_seq").limit(0)
    if long:
        out = out.unionByName(candidates(index, long).join(read, "_seq").where(holds(F.col("keyword"))).select("keyword", "_seq"))
    if short:
        fits = F.filter(F.array(*map(F.lit, short)), lambda k: (k == "") | holds(k))
        out = out.unionByName(read.select(F.explode(fits).alias("keyword"), "_seq"))
    return out
