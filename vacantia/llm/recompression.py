"""Repeated stretches of words, removed exactly, by recompression.

A window is WINDOW consecutive words. A round of recompression names runs of one symbol and then pairs: a hash deals the
symbols into left and right ones, and each left one takes the right one behind it. A name is a function of the names that it
replaces, so that it is the same wherever the same words stand and Spark's shuffles bring equal ones together without
a table of names. What a round does to the inside of a window depends on the window alone: only the first and last run,
a first symbol that is a right one and a last that is a left one may join what stands outside. The rest, its core, has the
same symbols wherever the window stands.

1. High-level symbols (BLOCK_ROUNDS rounds) cut every document into blocks. A block stands for the windows that start
   within; it is named by the digest of all their words. Blocks of one name are counted: all windows of a block that
   stands twice are repeated, verified at once however many they are. One of each name goes on.
2. In each of these a window is known by a stretch of SYMBOLS symbols, the one with the smallest hash within its core on
   level LEVEL, or on the highest below it that leaves so many. Neighbouring windows share it. Windows whose stretch stands
   in one place only can't be repeated. Most end here, with some ten rows for each hundred words.
3. The digests of the words of the other windows are counted: these are repeated or not.

Marks go back to the blocks and documents that hold them. A document of which all words go needs no text for that, so
that the texts that are read again belong to one document each, however large the groups of copies are.

Words are runs of characters other than space and 0x09-0x0D, compared unchanged. Null and empty texts have none; texts of
fewer words than a window lose none. Repeated rows, null doc_ids included, are documents of their own, so that each repeats the other.
Only doc_id and text are read. An empty table gives an empty one. Digests have 128 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .tables import batches_of, discard, through_table

WINDOW = 35
#: Rounds until a symbol is a block: each leaves some three quarters of the symbols of the last.
BLOCK_ROUNDS = 16
#: A stretch: some ten words of prose, shared by some ten windows.
SYMBOLS, LEVEL = 4, 3
_SLICE, _FLUSH = 256, 1 << 23
_EMPTY = hashlib.sha256(b"").hexdigest()


def one_spaced(text: str | None) -> bytes:
    """The words with one space between them."""
    return b" ".join((text or "").encode("utf-8", "surrogatepass").split())


def name_of(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def word_starts(data: bytes) -> np.ndarray:
    """Where the words of ``data`` start, and one place behind the last."""
    if not data:
        return np.zeros(1, np.int64)
    gaps = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    return np.concatenate([[0], gaps + 1, [len(data) + 1]])


def _is_left(names: np.ndarray, level: int) -> np.ndarray:
    return (W.mix(names + np.uint64(0x9E3779B97F4A7C15 * (level + 1) % (1 << 64))) & np.uint64(1)).astype(bool)


class Level:
    """Symbols of many documents, one behind the other: names, first words, and which of them begin a document."""

    def __init__(self, names: np.ndarray, places: np.ndarray, first: np.ndarray, number: int = 0):
        self.names, self.places, self.first, self.number = names, places, first, number

    def compressed(self) -> Level:
        """The next level; run_of, left, second and symbol_of tell where this one's symbols went."""
        fresh = np.ones(len(self.names), bool)
        fresh[1:] = (self.names[1:] != self.names[:-1]) | self.first[1:]
        self.run_of = np.cumsum(fresh) - 1
        at = np.flatnonzero(fresh)
        length = np.diff(np.append(at, len(fresh)))
        names = self.names[at]
        many = length > 1
        names[many] = W.mix(names[many] + W.mix(length[many].astype(np.uint64)))
        first, places = self.first[at], self.places[at]
        self.left = _is_left(names, self.number)
        second = np.zeros(len(names), bool)
        second[1:] = self.left[:-1] & ~self.left[1:] & ~first[1:]
        self.symbol_of = np.cumsum(~second) - 1
        at = np.flatnonzero(~second)
        out = names[at]
        takes = np.flatnonzero(second)
        out[self.symbol_of[takes]] = W.mix(W.mix(names[takes - 1]) * np.uint64(0xD6E8FEB86659FD93) + names[takes])
        return Level(out, places[at], first[at], self.number + 1)

    def core(self, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cores [begin, end) of this level as places in the next one; call compressed() before. Empty cores give begin >= end."""
        begin, end = self.run_of[begin] + 1, self.run_of[end - 1]
        sound = begin < end
        at, last = np.where(sound, begin, 0), np.where(sound, end - 1, 0)
        begin = self.symbol_of[at] + ~self.left[at]
        end = self.symbol_of[last] + ~self.left[last]
        return np.where(sound, begin, 0), np.where(sound, end, 0)


def _words(parts: list[bytes]) -> tuple[Level, np.ndarray]:
    """Level 0 of texts that have words, and the bounds of their words."""
    hashes, bounds = W.word_hashes(parts)
    first = np.zeros(len(hashes), bool)
    first[bounds[:-1]] = True
    return Level(hashes, np.arange(len(hashes)), first), bounds


def block_bounds(parts: list[bytes]) -> list[np.ndarray]:
    """For each text (of a window at least): where its blocks begin, and behind the last window's start."""
    level, bounds = _words(parts)
    for _ in range(BLOCK_ROUNDS):
        level = level.compressed()
    cuts = np.searchsorted(level.places, bounds)
    out = []
    for i in range(len(parts)):
        places, n = level.places[cuts[i] : cuts[i + 1]] - bounds[i], bounds[i + 1] - bounds[i] - WINDOW + 1
        out.append(np.append(places[places < n], n))
    return out


def _least(hashes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The place of the smallest of hashes[begin:end], the first of equal ones."""
    best, span = np.arange(len(hashes)), 1
    out, length = np.empty(len(begin), np.int64), end - begin
    while True:
        now = np.flatnonzero((length >= span) & (length < 2 * span))
        one, two = best[begin[now]], best[end[now] - span]
        out[now] = np.where(hashes[one] <= hashes[two], one, two)
        if not (length >= 2 * span).any():
            return out
        one, two = best[:-span], best[span:]
        best, span = np.where(hashes[one] <= hashes[two], one, two), 2 * span


def stretches(level: Level, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of windows that begin at ``begin``: the name of the stretch by which each is known, and the place of its first word."""
    name, place = np.empty(len(begin), np.uint64), np.empty(len(begin), np.int64)
    window, end = np.arange(len(begin)), begin + WINDOW
    while len(window):
        above = level.compressed()
        up, up_end = level.core(begin, end)
        stays = (up_end - up < SYMBOLS) | (level.number == LEVEL)
        if stays.any():
            hashes = W.mix(W.ngram_hashes(level.names, SYMBOLS) + np.uint64(level.number))
            at = _least(hashes, begin[stays], end[stays] - SYMBOLS + 1)
            name[window[stays]], place[window[stays]] = hashes[at], level.places[at]
        window, begin, end, level = window[~stays], up[~stays], up_end[~stays], above
    return name, place


def _long_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[bytes, np.ndarray]]]:
    """Texts of a window at least, one-spaced, with their word starts, in lists of bounded size."""
    held, size = [], 0
    for batch in batches:
        for text in batch.column(0):
            data = one_spaced(text.as_py())
            starts = word_starts(data)
            if len(starts) > WINDOW:
                held.append((data, starts))
                size += len(data)
            if size >= _FLUSH or len(held) >= _SLICE:
                yield held
                held, size = [], 0
    if held:
        yield held


def _blocks(with_words: bool) -> Callable:
    """Where the blocks of each text lie, and their names; or their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _long_texts(batches):
            rows: tuple[list, ...] = ([], [], [], [], [])
            for (data, starts), cuts in zip(held, block_bounds([data for data, _ in held])):
                name = name_of(data)
                for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                    words = data[starts[a] : starts[b + WINDOW - 1] - 1]
                    for column, value in zip(rows, (name, a, b, name_of(words), words if with_words else b"")):
                        column.append(value)
            kinds = (pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], ["name", "start", "stop", "block", "words"])

    return run


def _known_by(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of windows of blocks (id, name, start, words): neighbouring windows of one stretch make one row.

    ``place`` is a hash of the document and of the word at which the stretch begins.
    """
    for whole in batches:
        for at in range(0, whole.num_rows, 4 * _SLICE):
            batch = whole.slice(at, 4 * _SLICE)
            names, starts, parts = (batch.column(i).to_pylist() for i in range(1, 4))
            level, bounds = _words(parts)
            of = np.repeat(np.arange(len(parts)), np.diff(bounds) - WINDOW + 1)
            begin = np.arange(len(of)) + of * (WINDOW - 1)
            stretch, place = stretches(level, begin)
            document = np.array([int.from_bytes(x[:8], "little") for x in names], np.uint64)[of]
            place = W.mix(document + W.mix((place - bounds[of] + np.array(starts)[of]).astype(np.uint64)))
            fresh = np.ones(len(of), bool)
            fresh[1:] = (stretch[1:] != stretch[:-1]) | (place[1:] != place[:-1]) | (of[1:] != of[:-1])
            lows = np.flatnonzero(fresh)
            highs = np.append(lows[1:], len(of))
            base = bounds[of[lows]] - of[lows] * (WINDOW - 1)
            columns = [(lows - base).astype(np.int32), (highs - base).astype(np.int32), stretch[lows].astype(np.int64), place[lows].astype(np.int64)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of[lows])), *map(pa.array, columns)], ["id", "low", "high", "stretch", "place"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of the windows in the ranges of blocks (id, words, ranges), and their places in it."""
    for whole in batches:
        for k in range(0, whole.num_rows, _SLICE):
            batch = whole.slice(k, _SLICE)
            digests, ids, places = bytearray(), [], []
            for block, data, ranges in zip(*(batch.column(i).to_pylist() for i in range(3))):
                starts = word_starts(data).tolist()
                for r in ranges:
                    for at in range(r["low"], r["high"]):
                        digests += name_of(data[starts[at] : starts[at + WINDOW] - 1])
                    ids += [block] * (r["high"] - r["low"])
                    places += range(r["low"], r["high"])
            halves = np.frombuffer(bytes(digests), np.int64).reshape(-1, 2)
            columns = (np.ascontiguousarray(halves[:, 0]), np.ascontiguousarray(halves[:, 1]), np.array(ids, np.int64), np.array(places, np.int32))
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["one", "two", "id", "at"])


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, name of the text, number of words, digest of all words."""
    for batch in batches:
        data = [one_spaced(x.as_py()) for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(map(name_of, data), pa.binary()), pa.array([len(word_starts(x)) - 1 for x in data], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in data])],
            ["doc_id", "name", "n_words", "kept_sha256"],
        )


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for held in _long_texts(batches):
        yield pa.RecordBatch.from_arrays([pa.array([name_of(x) for x, _ in held], pa.binary()), pa.array([x for x, _ in held], pa.binary())], ["name", "words"])


def kept_words(data: bytes, spans: list[dict]) -> tuple[int, bytes]:
    """The number of words that go, and the others; a span is (start, stop, whole, at): all or some windows of a block."""
    words = data.split(b" ") if data else []
    edge = np.zeros(len(words) + 1, np.int32)
    for s in spans:
        at = np.arange(s["start"], s["stop"]) if s["whole"] else np.array(s["at"] or [], np.int64) + s["start"]
        np.add.at(edge, at, 1)
        np.add.at(edge, at + WINDOW, -1)
    gone = np.cumsum(edge[:-1]) > 0
    return int(gone.sum()), b" ".join([w for w, g in zip(words, gone.tolist()) if not g])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for k in range(0, whole.num_rows, _SLICE):
            batch = whole.slice(k, _SLICE)
            left = [kept_words(data, spans) for data, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([n for n, _ in left], pa.int64()), pa.array([x for _, x in left], pa.binary())], ["name", "n_removed", "kept"])


def repeated_windows(docs: DataFrame) -> DataFrame:
    """(name of a text, starts, stops and marks of its blocks, how many of its windows are repeated), of texts with such a window."""
    text = docs.select(F.col("text").cast("string").alias("text"))
    described = "name binary, start int, stop int, block binary, words binary"
    one_of_each = text.mapInArrow(_blocks(True), described).groupBy("block").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("name", "start")).alias("at"), F.first("words").alias("words"))
    blocks = through_table(one_of_each.select(F.monotonically_increasing_id().alias("id"), "block", "n", "at.name", "at.start", "words"), "blocks", "zstd")
    known = through_table(blocks.select("id", "name", "start", "words").mapInArrow(_known_by, "id long, low int, high int, stretch long, place long"), "stretches")
    again = through_table(known.groupBy("stretch").agg(F.min("place").alias("a"), F.max("place").alias("b")).where("a < b").select("stretch"), "again")
    met = known.select("id", "low", "high", "stretch").join(again, "stretch")
    ranges = through_table(met.groupBy("id").agg(F.collect_list(F.struct("low", "high")).alias("ranges")), "ranges")  # of one block's windows
    discard(known, again)
    windows = through_table(blocks.select("id", "words").join(ranges, "id").mapInArrow(_digests, "one long, two long, id long, at int"), "windows")
    repeated = through_table(windows.groupBy("one", "two").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("one", "two"), "repeated")
    single = windows.join(repeated, ["one", "two"]).groupBy("id").agg(F.collect_list("at").alias("at"))  # of one block
    of_blocks = blocks.select("id", "block", (F.col("n") > 1).alias("whole")).join(single, "id", "left").where("whole or at is not null")
    marks = through_table(of_blocks.select("block", "whole", F.when(~F.col("whole"), F.col("at")).alias("at")), "marks")
    discard(blocks, ranges, windows, repeated)
    places = text.mapInArrow(_blocks(False), described).select("name", "start", "stop", "block").distinct()
    marked = places.join(marks, "block").select("name", F.struct("start", "stop", "whole", "at").alias("span"))
    count = F.sum(F.expr("if(span.whole, span.stop - span.start, size(span.at))"))
    out = through_table(marked.groupBy("name").agg(F.collect_list("span").alias("spans"), count.alias("n_windows")), "spans")  # of one text's blocks
    discard(marks)
    return out


def without_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, digest of the kept words) of every document."""
    spans = repeated_windows(docs)
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    named = through_table(plain.mapInArrow(_named, "doc_id long, name binary, n_words long, kept_sha256 string"), "named")
    lengths = named.where(F.col("n_words") >= WINDOW).select("name", "n_words").distinct()
    judged = spans.join(lengths, "name").withColumn("all", F.col("n_windows") == F.col("n_words") - (WINDOW - 1))
    part = judged.where("not all").select("name", "spans")
    with batches_of(docs.sparkSession, _SLICE):
        rest = through_table(kept_texts(plain, part).select("name", "n_removed", F.sha2("kept", 256).alias("kept_sha256")), "kept")
    gone = judged.where("all").select("name", F.col("n_words").alias("n_removed"), F.lit(_EMPTY).alias("kept_sha256")).unionByName(rest)
    left = named.where(F.col("n_words") >= WINDOW).join(gone.withColumnRenamed("kept_sha256", "rest_sha256"), "name", "left")
    out = left.select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("rest_sha256", "kept_sha256").alias("kept_sha256"))
    return out.unionByName(named.where(F.col("n_words") < WINDOW).select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept_sha256"))


def kept_texts(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """(name, n_removed, kept words) of the texts that ``spans`` (name, spans) names."""
    text = docs.select("text").mapInArrow(_texts, "name binary, words binary")
    return text.join(spans, "name").select("name", "words", "spans").mapInArrow(_cut, "name binary, n_removed long, kept binary")
