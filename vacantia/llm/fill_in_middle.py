"""Fill-in-middle: a text is cut at two token ends into prefix, middle and suffix, and written with the middle last.

Tokens are runs of A-Z and a-z, and single other characters. An Arrow-batched pandas UDF holds the ends of a text's tokens in one
compact array, so that both cuts are two lookups; cuts and forms follow from a hash of seed and doc_id, so that a task
that runs again gives the same rows.

Null and empty texts and texts that hold a sentinel are plain: the output is the text (null: empty), and nothing else is
cut. A null doc_id is hashed as an empty string. Every row is judged on its own: repeated rows give equal rows. Only
doc_id and text are read. An empty table gives an empty one. A text of m characters takes 4 m bytes more at most.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = regex.compile("[A-Za-z]+|[^A-Za-z]")
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Texts in a hundred that are cut, and of these in a hundred that have the suffix first.
CUT_PERCENT, SUFFIX_FIRST_PERCENT = 90, 20
COLUMNS = "n long, form string, prefix_chars long, middle_chars long, output string, output_sha256 string, restored_sha256 string"


def token_ends(text: str) -> array:
    """The code point behind each token."""
    return array("I", (m.end() for m in TOKEN.finditer(text)))


def seeds(seed: int, doc_id: int | None) -> tuple[int, ...]:
    """Four numbers of 32 bits."""
    digits = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digits[at : at + 8], 16) for at in range(0, 32, 8))


def cut(text: str, doc_id: int | None, seed: int) -> tuple[int, str, int | None, int | None, str]:
    """Number of tokens, form, characters of prefix and of middle, and output."""
    ends = token_ends(text)
    n = len(ends)
    h1, h2, h3, h4 = seeds(seed, doc_id)
    if not n or h3 % 100 >= CUT_PERCENT or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    first, last = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (ends[k - 1] if k else 0 for k in (first, last))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < SUFFIX_FIRST_PERCENT:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def restore(output: str, form: str) -> str:
    """The text that cut() had. Sentinels stand in no cut text, and none arises where two parts meet."""
    if form == "plain":
        return output
    one, two = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    left, middle = output.removeprefix(one).split(MIDDLE)
    left, right = left.split(two)
    prefix, suffix = (left, right) if form == "psm" else (right, left)
    return prefix + middle + suffix


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def _transform(seed: int):
    @F.pandas_udf(COLUMNS)
    def transform(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in COLUMNS.split(", ")]
        for ids, texts in batches:
            rows = []
            for doc_id, text in zip(ids, texts):
                n, form, a, b, output = cut(text or "", None if doc_id is None else int(doc_id), seed)
                rows.append((n, form, a, b, output, _digest(output), _digest(restore(output, form))))
            out = pd.DataFrame(rows, columns=names)
            yield out.astype({"prefix_chars": "Int64", "middle_chars": "Int64"})

    return transform


def fill_in_middle(docs: DataFrame, seed: int = 1) -> DataFrame:
    """doc_id, tokens, form, lengths of prefix and middle, the output, and digests of it and of the text rebuilt from it."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # as a string, so that pandas makes no doubles of ids beside a null one
    made = plain.select("doc_id", _transform(seed)(F.col("doc_id").cast("string"), "text").alias("fim"))
    return made.select("doc_id", "fim.*")
