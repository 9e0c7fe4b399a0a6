"""Benchmark decontamination by spaced seeds.

A mask fixes which of SPAN consecutive words a seed looks at; the others may differ, so a substitution in an unlooked-at
place does not break the seed. Seeds of all benchmark items are the build side of a hash join, whose probe side is every
position of every whole document. A hit fixes an alignment (document place, item place); verification walks the item
along that diagonal and keeps the alignment if a window of WINDOW words (the item, if it is shorter) has at least
AGREE of its words equal; of equally good windows the first of the first alignment is told. An item of SHORT to SPAN - 1
words has two seeds, of its even and of its odd places, so that one substitution, which is all that AGREE leaves it, keeps
one of them. A still shorter item stands in all sorts of running text: it matches a text that consists of its words alone.

Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased.

The benchmark is sent to the executors in blocks of at most BLOCK_CHARS characters, each with a pass of its own over the
documents, whose result is a table before the next begins: what is sent at once and what a worker holds have a fixed bound,
however large the benchmark. Texts go to the workers TEXTS_AT_ONCE at a time. Null or empty texts overlap nothing, an empty benchmark marks nothing, an empty table stays empty. Null items are skipped;
repeated rows give repeated results; very long texts are read whole; names of other columns can't clash.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .tables import batches_of, discard, through_table

#: Positions that each seed looks at, of SPAN.
MASKS = ((0, 1, 2, 4, 7, 8), (0, 2, 3, 5, 6, 8), (0, 1, 3, 4, 6, 7))
SPAN, WINDOW, AGREE, SHORT = 9, 20, 0.8, 5
BLOCK_CHARS = 16_000_000
#: Hits that are looked at together, of texts and items that repeat their words.
HITS_AT_ONCE = 1 << 20
#: Texts that go to a Python worker at once.
TEXTS_AT_ONCE = 512
_TABLE_BITS = 20
OVERLAP = "array<struct<item_id:long, doc_word:long, item_word:long, n_words:long, n_equal:long>>"


def masks_of(span: int) -> tuple[tuple[int, ...], ...]:
    """The masks for items that have ``span`` words (SPAN: or more)."""
    return MASKS if span == SPAN else (tuple(range(0, span, 2)), tuple(range(1, span, 2)))


def seeds(words: np.ndarray, mask: tuple[int, ...], salt: int, span: int = SPAN) -> np.ndarray:
    m = len(words) - span + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(m, np.uint64(salt + 1))
    for at in mask:
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[at : at + m]
    return W.mix(out)


def _slices(ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of places whose hits, counted up to each place by ``ends``, are HITS_AT_ONCE or one place's own."""
    a = 0
    while a < len(ends):
        done = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, done + HITS_AT_ONCE, "right")))
        yield a, b
        a = b


class Build:
    """The build side of one block of items: sorted seed hashes with their item and place, and a bit table before them."""

    def __init__(self, items: list[tuple[int, str]]):
        items = [(i, t) for i, t in items if t is not None and i is not None]
        self.ids = [i for i, _ in items]
        hashes, at = W.word_hashes([W.lowered(t) for _, t in items], punctuation=True)
        self.words = [hashes[at[k] : at[k + 1]] for k in range(len(items))]
        #: words -> hash of all of them -> items, of items too short for seeds
        self.tiny: dict[int, dict[int, list[int]]] = {}
        spans: dict[int, list[int]] = {}
        for k, words in enumerate(self.words):
            if len(words) >= SHORT:
                spans.setdefault(min(len(words), SPAN), []).append(k)
            elif len(words):
                self.tiny.setdefault(len(words), {}).setdefault(int(W.ngram_hashes(words, len(words))[0]), []).append(k)
        self.seeds = {span: self._sorted(owners, span) for span, owners in sorted(spans.items())}

    def _sorted(self, owners: list[int], span: int) -> tuple[np.ndarray, ...]:
        """Seeds of the items, in order, with their items and places, and the bit table before them."""
        found, owner, place = [], [], []
        for k in owners:
            for salt, mask in enumerate(masks_of(span)):
                h = seeds(self.words[k], mask, salt, span)
                found.append(h)
                owner.append(np.full(len(h), k))
                place.append(np.arange(len(h)))
        keys = np.concatenate(found)
        order = np.argsort(keys, kind="stable")
        table = np.zeros(1 << _TABLE_BITS, bool)
        table[(keys >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)] = True
        return keys[order], np.concatenate(owner)[order], np.concatenate(place)[order], table

    def hits(self, words: np.ndarray) -> list[tuple[int, int]]:
        """(item, diagonal) of all seed hits, each once; the diagonal is the document place of the item's first word."""
        longest = max(map(len, self.words), default=0)
        width = len(words) + longest + 1  # of the range of diagonals
        out = np.zeros(0, np.int64)
        for span, (keys, owner, place, table) in self.seeds.items():
            for salt, mask in enumerate(masks_of(span)):
                h = seeds(words, mask, salt, span)
                at = np.flatnonzero(table[(h >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)])
                left, right = np.searchsorted(keys, h[at], "left"), np.searchsorted(keys, h[at], "right")
                found = np.flatnonzero(right > left)
                at, left, many = at[found], left[found], (right - left)[found]
                ends = np.cumsum(many)
                for a, b in _slices(ends):
                    first = np.repeat(left[a:b] - (ends[a:b] - many[a:b]), many[a:b])
                    x = first + np.arange(ends[a] - many[a], ends[b - 1])
                    diagonal = np.repeat(at[a:b], many[a:b]) - place[x]
                    out = np.union1d(out, owner[x] * width + diagonal + longest)
        return list(zip((out // width).tolist(), (out % width - longest).tolist()))

    def overlaps(self, words: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """Verified (item id, document word, item word, words, equal words): the best window of each item."""
        best: dict[int, tuple] = {}
        for k, at in sorted(self.hits(words)):
            item = self.words[k]
            a, b = max(0, -at), min(len(item), len(words) - at)
            size = min(WINDOW, len(item))
            if b - a < size:
                continue
            equal = np.cumsum(np.concatenate(([0], item[a:b] == words[at + a : at + b])))
            sums = equal[size:] - equal[:-size]
            top = int(sums.argmax())
            if sums[top] >= AGREE * size and (k not in best or sums[top] > best[k][-1]):
                best[k] = (self.ids[k], at + a + top, a + top, size, int(sums[top]))
        if len(words) in self.tiny:
            n = len(words)
            for k in self.tiny[n].get(int(W.ngram_hashes(words, n)[0]), ()):
                best[k] = (self.ids[k], 0, 0, n, n)
        return [best[k] for k in sorted(best)]


def _probe(sent: bytes, column: int) -> Callable:
    """Adds what this block's items overlap to the last column; ``column`` holds the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        build = Build(pickle.loads(sent))
        for batch in batches:
            texts = [W.lowered(x) for x in batch.column(column).to_pylist()]
            hashes, at = W.word_hashes(texts, punctuation=True)
            found = batch.column(batch.num_columns - 1).to_pylist()
            names = ("item_id", "doc_word", "item_word", "n_words", "n_equal")
            for i in range(len(texts)):
                found[i] = [*found[i], *(dict(zip(names, x)) for x in build.overlaps(hashes[at[i] : at[i + 1]]))]
            yield batch.set_column(batch.num_columns - 1, batch.schema.field(batch.num_columns - 1), pa.array(found, batch.schema.field(batch.num_columns - 1).type))

    return run


def blocks_of(bench: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """Items, in blocks of BLOCK_CHARS (or of one item, if that is larger)."""
    held: list[tuple[int, str]] = []
    size = 0
    for row in bench.selectExpr("cast(item_id as long) item_id", "cast(text as string) text").toLocalIterator():
        if held and size + len(row.text or "") > BLOCK_CHARS:
            yield held
            held, size = [], 0
        held.append((row.item_id, row.text))
        size += len(row.text or "")
    if held:
        yield held


def find_overlaps(docs: DataFrame, bench: DataFrame, name: str = "overlaps") -> DataFrame:
    """``docs`` with a column ``name``: the benchmark items that each text holds, empty if none."""
    kept = docs.columns
    out, last = docs.withColumn(name, F.expr(f"cast(array() as {OVERLAP})")), None
    for block in blocks_of(bench):
        with batches_of(docs.sparkSession, TEXTS_AT_ONCE):
            out = through_table(out.mapInArrow(_probe(pickle.dumps(block), kept.index("text")), out.schema), "overlaps")
        if last is not None:
            discard(last)
        last = out
    return out


def contaminated(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """doc_id, whether the text holds a benchmark passage, how many items, their ids, and the largest share of equal words."""
    found = find_overlaps(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), bench)
    return found.select("doc_id", (F.size("overlaps") > 0).alias("contaminated"), F.size("overlaps").cast("long").alias("n_items"), F.array_sort(F.transform("overlaps", lambda x: x["item_id"])).alias("items"), F.array_max(F.transform("overlaps", lambda x: x["n_equal"] / x["n_words"])).alias("agreement"))


def clean(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The documents that hold no benchmark passage, unchanged."""
    name = "overlaps_"
    while name in docs.columns:
        name += "_"
    return find_overlaps(docs, bench, name).where(F.size(name) == 0).drop(name)
