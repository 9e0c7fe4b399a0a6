"""Deduplication against all earlier days, from what is kept of them.

Kept are two narrow tables: the links that were seen, and for each title/company/city what the second pass made of its
adverts. A day's adverts with a link that was seen go; the others are aggregated by key and merged with the key's row:
the best of two bests, the first of two places, sums of counts. The third pass runs over the kept rows, since a fuller
advert may take a key over and leave its old text's group.

Fed in order of ``_seq``, days give the same adverts, places and counts as one run over all of them. A day that is fed
again (after a run that broke off) starts from the state before it; states are tables that the caller keeps by day.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

from . import dedupe


class History(NamedTuple):
    links: DataFrame
    keys: DataFrame


def fed(history: History | None, ads: DataFrame) -> History:
    """The state after a day's adverts, whose places all come after the earlier days'. None: no day before."""
    day = dedupe.pass_links(dedupe.marks(ads.drop("duplicate_count")))
    if history is None:
        return History(_links(day), dedupe.pass_keys(day))
    known = day.join(history.links, "link", "left_anti").select(day.columns)
    return History(history.links.unionByName(_links(known)), dedupe.pass_keys(history.keys.unionByName(dedupe.pass_keys(known))))


def _links(day: DataFrame) -> DataFrame:
    return day.where("link like 'u%'").select("link")


def left(history: History) -> DataFrame:
    """The marks of the adverts that are left: own place, place taken, how many it stands for."""
    return dedupe.pass_texts(history.keys).select("_from", "_seq", "again")
