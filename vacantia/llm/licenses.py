"""License notices: exact base phrases, and a fuzzy search for short notices.

Fuzzy search. A notice that occurs with at most k edits holds at least one of any k + 1 disjoint pieces of it unchanged
(pigeonhole). All pieces of all notices stand in one Aho-Corasick automaton; each hit marks the stretch of text in which
the notice would have to lie, stretches of a notice that touch are merged, and the regex library's bounded-error
matching ({e<=k}, best match) verifies them and gives spans and edits. Matching runs on words joined by one space, and
one more behind the last, so that line breaks and punctuation within a notice cost no edits, and every match ends before
a space: the pattern asks for that space, and so never takes the end of a stretch for the end of a word. Spans are in words.

Null and empty texts: no words, no labels, score 0. Texts are searched whole. Repeated rows give repeated results; other
columns of the input are not read, so their names can't clash.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .words import lowered

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Exact phrases and their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: (label, notice in lower-case words); edits allowed: one for each EDIT_EVERY characters.
NOTICES = (
    ("agpl", "gnu affero general public license"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("artistic", "licensed under the artistic license"),
    ("boost", "distributed under the boost software license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by", "licensed under cc by"),
    ("cc-by", "licensed under the creative commons attribution"),
    ("cc-by-nc", "licensed under cc by nc"),
    ("cc-by-sa", "licensed under cc by sa"),
    ("cc0", "dedicated to the public domain"),
    ("epl", "licensed under the eclipse public license"),
    ("gpl", "licensed under the gnu general public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose"),
    ("lgpl", "gnu lesser general public license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mpl", "mozilla public license version"),
    ("reserved", "all rights reserved"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)
EDIT_EVERY = 12
SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label:string, first_word:long, n_words:long, edits:int>>"


def edits_of(notice: str) -> int:
    return max(1, len(notice) // EDIT_EVERY)


def pieces_of(notice: str) -> list[tuple[int, str]]:
    """k + 1 disjoint pieces that together are the notice, with their offsets."""
    k = edits_of(notice) + 1
    at = [len(notice) * i // k for i in range(k + 1)]
    return [(a, notice[a:b]) for a, b in zip(at, at[1:])]


@lru_cache(maxsize=1)
def _searcher():
    """The automaton over all pieces, and a pattern for each notice. In the pattern the notice stands between word ends."""
    seeds: dict[str, list[tuple[int, int]]] = {}
    for i, (_, notice) in enumerate(NOTICES):
        for at, piece in pieces_of(notice):
            seeds.setdefault(piece, []).append((i, at))
    machine = ahocorasick.Automaton()
    for piece, owners in seeds.items():
        machine.add_word(piece, (len(piece), owners))
    machine.make_automaton()
    return machine, [regex.compile(rf"(?b)(?<![^ ])(?:{regex.escape(n, literal_spaces=True)}){{e<={edits_of(n)}}}(?= )") for _, n in NOTICES]


def _inexact(pattern, joined: str, i: int, a: int, b: int) -> list[tuple[int, int, int, int]]:
    """Matches between a and b, in order, each the best of a window that holds any match beginning in its first half.

    What a window's best match leaves before it is searched again, so that a better match takes no other one away; the
    windows' size depends on the notice alone, so that time is in proportion to the stretch.
    """
    least, longest = (len(NOTICES[i][1]) + sign * edits_of(NOTICES[i][1]) for sign in (-1, 1))
    out, todo = [], [(a, b)]
    while todo:
        a, b = todo.pop()
        if b - a < least:
            continue
        m = pattern.search(joined, pos=a, endpos=min(b, a + 2 * longest) + 1)  # with what stands behind
        if m is None:
            todo.append((a + longest, b))
        else:
            out.append((i, m.start(), m.end(), sum(m.fuzzy_counts)))
            todo += [(a, m.start() - 1), (m.end(), b)]  # a match before it ends before a space of its own
    return sorted(out, key=lambda x: x[1])


def fuzzy_spans(joined: str) -> list[tuple[int, int, int, int]]:
    """(notice, start, end, edits) in characters of the joined words."""
    machine, patterns = _searcher()
    joined += " "
    marked: dict[int, list[tuple[int, int]]] = {}
    for end, (size, owners) in machine.iter(joined):
        for i, at in owners:
            start = end + 1 - size - at
            k = edits_of(NOTICES[i][1])
            a, b = max(0, start - k), min(len(joined) - 1, start + len(NOTICES[i][1]) + k)
            held = marked.setdefault(i, [])
            if held and a <= held[-1][1]:
                held[-1] = (min(a, held[-1][0]), max(b, held[-1][1]))
            else:
                held.append((a, b))
    out = []
    for i, stretches in sorted(marked.items()):
        notice = NOTICES[i][1]
        for a, b in stretches:
            gap = at = a
            while (exact := joined.find(notice, at, b)) >= 0:  # the commonest case needs no alignment
                at = exact + len(notice)
                if (exact == 0 or joined[exact - 1] == " ") and joined[at] == " ":
                    out += _inexact(patterns[i], joined, i, gap, exact - 1)
                    out.append((i, exact, at, 0))
                    gap = at
            out += _inexact(patterns[i], joined, i, gap, b)
    return out


def base_places(words: list[str], phrase: list[str]) -> list[int]:
    out, at = [], -1
    try:
        while True:
            at = words.index(phrase[0], at + 1)
            if words[at : at + len(phrase)] == phrase:
                out.append(at)
    except ValueError:
        return out


def scan(text: str | None) -> tuple:
    words = WORD.findall(lowered(text).decode("utf-8", "surrogatepass"))
    joined = " ".join(words)
    places, base = [], set()
    for phrase, label in BASE:
        if phrase in joined and (found := base_places(words, phrase.split())):
            places += found
            base.add(label)
    spans, labels, score = [], set(base), 1.0 if base else 0.0
    found = fuzzy_spans(joined)
    ends = list(accumulate((len(w) + 1 for w in words), initial=-1))[1:] if found else []  # where the words end, in joined
    for i, a, b, edits in found:
        label, notice = NOTICES[i]
        first = bisect.bisect_left(ends, a)
        spans.append({"label": label, "first_word": first, "n_words": bisect.bisect_left(ends, b) - first + 1, "edits": edits})
        labels.add(label)
        score = max(score, 1 - edits / len(notice))
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score, spans


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    spans = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("edits", pa.int32())]))
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), spans]
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
    for batch in batches:
        out = [scan(x) for x in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, k) for x, k in zip(zip(*out) if out else [()] * len(kinds), kinds))], ["doc_id", *names])


def license_scan(docs: DataFrame) -> DataFrame:
    """A row for each document: base counts, labels of both methods, score and the fuzzy spans."""
    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(_rows, SCHEMA)
