"""Regular expressions over columns: Unicode classes, spans of all matches, ordered rules.

Patterns run in the JVM with (?U), so that \\w, \\s and \\b know all letters, as they do in Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ANY_CASE, EXACT_CASE = "(?iU)", "(?U)"


def text(c: Column | str) -> Column:
    """Null as the empty string: both mean missing."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends; trim() knows only the space."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def spans(c: Column, pattern: str | Column) -> Column:
    """array<struct<start, end, match>> of all matches, left to right, 0-based; for patterns that never match nothing.

    A match starts where the match before it ends, and the gap between them.
    """
    found, gaps = F.regexp_extract_all(c, pattern if isinstance(pattern, Column) else F.lit(pattern), F.lit(0)), F.split(c, pattern, -1)
    none = F.struct(F.lit(0).alias("at"), F.lit(None).cast("array<struct<start:int,end:int,match:string>>").alias("spans"))

    def further(so_far: Column, x: Column) -> Column:
        start = so_far["at"] + F.length(x["gap"])
        end = start + F.length(x["match"])
        span = F.struct(start.alias("start"), end.alias("end"), x["match"].alias("match"))
        return F.struct(end.alias("at"), F.concat(F.coalesce(so_far["spans"], F.array().cast("array<struct<start:int,end:int,match:string>>")), F.array(span)).alias("spans"))

    both = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(found)).alias("gap"), found.alias("match"))
    return F.coalesce(F.aggregate(both, none, further, lambda a: a["spans"]), F.array().cast("array<struct<start:int,end:int,match:string>>"))


def first_rule(c: Column, rules: Sequence[tuple[str, str]], flags: str = ANY_CASE) -> Column:
    """The label of the first rule whose pattern is found, else null."""
    return F.coalesce(*(F.when(c.rlike(flags + p), F.lit(label)) for label, p in rules))


def first_rule_match(c: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """struct<label, evidence> of the first rule whose pattern is found, else null; evidence is the text that it found."""
    return F.coalesce(*(F.when(c.rlike(ANY_CASE + p), F.struct(F.lit(label).alias("label"), F.regexp_extract(c, ANY_CASE + p, 0).alias("evidence"))) for label, p in rules))


def window(c: Column, start: Column, end: Column) -> Column:
    """Characters from start to end, 0-based, both clamped to the text."""
    low = F.greatest(start, F.lit(0))
    return F.substring(c, low + 1, F.greatest(end - low, F.lit(0)))
