"""Enrichment by a pluggable provider: a short or failed reply loses no advert.

A provider gets a batch of rows and returns text: JSON, fenced or not, a list of objects or {"jobs": [...]}, each with the
number of the row in the batch from 1 on (job_id) or the advert's own (_seq). ``enrich`` joins replies back by the
advert's number. ``enrich_kept`` keeps them in a table by a digest of what was asked, so that equal adverts, later days
and lost executors ask nothing twice.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.functions.patterns import text

FIELDS = ("primary_role", "must_have_skills", "nice_to_have_skills", "job_level", "experience_years", "blurb")
#: A provider takes a batch of rows (job_id, title, company, snippet, skills) and returns a reply.
Provider = Callable[[Sequence[dict]], str]
SNIPPET, BATCH = 1000, 5


def needs_enrichment() -> Column:
    has = lambda c: text(F.col(c).cast("string")) != ""
    return ~(has("blurb") & has("primary_role")) & (~has("must_have_skills") | ~has("job_level"))


def parse_reply(reply: str) -> list[dict]:
    """The objects of a reply; [] if it can't be read."""
    body = re.sub(r"^\s*```(?:json)?\s*|\s*```\s*$", "", reply or "")
    try:
        found = json.loads(body)
    except ValueError:
        return []
    if isinstance(found, dict):
        found = found.get("jobs")
    return [x for x in found if isinstance(x, dict)] if isinstance(found, list) else []


def prompt(rows: Sequence[dict]) -> str:
    """What a provider may ask a language model about a batch."""
    told = "\n\n".join(f"[{r['job_id']}] {r['title']} at {r['company']}\nskills so far: {r.get('skills') or 'none'}\n{r['snippet']}" for r in rows)
    return (
        f"{told}\n\nFor each of the {len(rows)} adverts above give its number as job_id, primary_role, must_have_skills (3 to 8, comma-separated), "
        "nice_to_have_skills (2 to 5), experience_years (a whole number or null), job_level (intern, junior, mid, senior, lead, principal or empty) "
        'and blurb (one or two sentences). Answer with JSON alone: {"jobs": [...]}'
    )


def _answers(provider: Provider, rows: list[dict], batch: int) -> Iterator[tuple[dict, dict]]:
    """(row, object) of the rows that a reply names; a provider's failure leaves its batch as it was."""
    for at in range(0, len(rows), batch):
        some = [r | {"job_id": i} for i, r in enumerate(rows[at : at + batch], 1)]
        try:
            found = parse_reply(provider(some))
        except Exception:
            found = []
        by_id, by_seq = {r["job_id"]: r for r in some}, {r["_seq"]: r for r in some if "_seq" in r}
        for x in found:
            row = by_seq.get(x.get("_seq")) or by_id.get(x.get("job_id"))
            if row is not None:
                yield row, x


def _text_of(v) -> str | None:
    return None if v is None else ", ".join(map(str, v)) if isinstance(v, list) else str(v)


def _overwritten(ads: DataFrame) -> DataFrame:
    return ads.withColumns({f: F.coalesce(F.col(f"_new_{f}"), F.col(f).cast("string")) for f in FIELDS}).drop(*(f"_new_{f}" for f in FIELDS))


def enrich(ads: DataFrame, provider: Provider | None = None, batch: int = BATCH) -> DataFrame:
    """Fields that a reply has overwrite the advert's; without a provider nothing changes."""
    if provider is None:
        return ads
    schema = "_seq long, " + ", ".join(f"_new_{f} string" for f in FIELDS)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = {r["_seq"]: x for r, x in _answers(provider, frame.to_dict("records"), batch)}
            yield pd.DataFrame([(k, *(_text_of(x.get(f)) for f in FIELDS)) for k, x in out.items()], columns=["_seq", *(f"_new_{f}" for f in FIELDS)])

    new = _asked(ads, "_seq").mapInPandas(run, schema)
    return _overwritten(ads.join(new, "_seq", "left"))


def _asked(ads: DataFrame, *more: str) -> DataFrame:
    return ads.select(*more, *_asked_columns())


def enrich_kept(ads: DataFrame, provider: Provider, folder: str, batch: int = BATCH) -> DataFrame:
    """As ``enrich``, of adverts that need it, by replies that are kept in ``folder``; only what has no reply there is asked.

    New replies are written before they are read, so that what comes after asks nothing; a task that runs again asks
    for its own rows at most. What stays without a reply is asked again next time.
    """
    spark, columns = ads.sparkSession, ("title", "company", "snippet", "skills")
    digest = F.sha2(F.to_json(F.struct(*columns)), 256)
    schema = "ask string, " + ", ".join(f"_new_{f} string" for f in FIELDS)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = {r["ask"]: x for r, x in _answers(provider, frame.to_dict("records"), batch)}
            yield pd.DataFrame([(k, *(_text_of(x.get(f)) for f in FIELDS)) for k, x in out.items()], columns=["ask", *(f"_new_{f}" for f in FIELDS)])

    def kept() -> DataFrame:
        try:
            return spark.read.schema(schema).parquet(folder)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schema)

    keyed = ads.withColumn("_ask", F.when(needs_enrichment(), F.get(F.transform(F.array(F.struct(*_asked_columns())), lambda r: F.sha2(F.to_json(r), 256)), F.lit(0))))
    asked = _asked(ads.where(needs_enrichment())).distinct().withColumn("ask", digest)
    fresh = asked.join(kept().select("ask").distinct(), "ask", "left_anti")
    fresh.mapInPandas(run, schema).write.mode("append").parquet(folder)
    replies = kept().groupBy("ask").agg(*(F.min(f"_new_{f}").alias(f"_new_{f}") for f in FIELDS))  # two runs at once may both have asked
    # adverts that ask nothing are not shuffled by a common key
    none = [F.lit(None).cast("string").alias(f"_new_{f}") for f in FIELDS]
    told = keyed.where("_ask is not null").join(replies.withColumnRenamed("ask", "_ask"), "_ask", "left").drop("_ask")
    rest = keyed.where("_ask is null").drop("_ask").select("*", *none)
    return _overwritten(told.unionByName(rest))


def _asked_columns() -> list[Column]:
    return [text("title").alias("title"), text("company").alias("company"), F.substring(text("description_snippet"), 1, SNIPPET).alias("snippet"), text("must_have_skills").alias("skills")]
