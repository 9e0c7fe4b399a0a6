"""Quality rules by compression bands.

zstandard ratios (bytes before / after) of the whole document and of fixed chunks are held against limits that depend
on the length: a ratio above the band means repetitive text, below it text that does not compress (keys, encoded
binaries). The chunk rule looks at every chunk, so that a bad stretch of a long document counts in proportion; bytes after the last whole
chunk are looked at as a chunk over the last CHUNK_BYTES bytes. Shorter documents have no chunks: the limits of their own
length hold all their bytes.

Null and empty texts have no words: they fail the base rule. Repeated rows give repeated results. Other columns of the
input are not read, so their names can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from . import words as W

#: (bytes from, lowest ratio, highest ratio) of a whole document; the last row that fits the length holds.
DOCUMENT_BANDS = ((0, 0.0, 2.6), (256, 0.95, 2.8), (1024, 1.15, 3.2), (4096, 1.3, 3.8), (16384, 1.4, 4.6), (65536, 1.45, 6.0))
#: Chunks of this size, whose ratios have limits of their own; a document fails if more than this share of its chunks do.
CHUNK_BYTES, CHUNK_BAND, CHUNK_SHARE = 4096, (1.3, 3.8), 0.34
LEVEL = 3
SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, ratio double, worst_low double, worst_high double, n_chunks long, n_bad_chunks long, verdict string"
_SYMBOLS = "#*$%&|<>"
_WINDOW = 8


def repeat_words(words: np.ndarray, window: int = _WINDOW) -> int:
    """Words that lie in a window of so many words that the text holds twice or more."""
    grams = W.ngram_hashes(words, window)
    if len(grams) < 2:
        return 0
    _, inverse, counts = np.unique(grams, return_inverse=True, return_counts=True)
    hit = counts[inverse] > 1
    if not hit.any():
        return 0
    edge = np.zeros(len(words) + 1, np.int64)
    edge[: len(hit)] += hit
    edge[window : window + len(hit)] -= hit
    return int((np.cumsum(edge)[:-1] > 0).sum())


def dup_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
    return len(lines) - len(set(lines))


def bands(data: bytes, packer: zstandard.ZstdCompressor) -> tuple[float, float, float, int, int, str]:
    """Ratio of the whole, lowest and highest chunk ratio, chunks, chunks outside the band, verdict."""
    if not data:
        return 0.0, 0.0, 0.0, 0, 0, "empty"
    ratio = len(data) / len(packer.compress(data))
    _, low, high = [x for x in DOCUMENT_BANDS if x[0] <= len(data)][-1]
    starts = list(range(0, len(data) - CHUNK_BYTES + 1, CHUNK_BYTES))
    if starts and len(data) % CHUNK_BYTES:
        starts.append(len(data) - CHUNK_BYTES)
    found = [CHUNK_BYTES / len(packer.compress(data[i : i + CHUNK_BYTES])) for i in starts]
    bad = sum(not CHUNK_BAND[0] <= x <= CHUNK_BAND[1] for x in found)
    verdict = "repetitive" if ratio > high else "incompressible" if ratio < low else "bad chunks" if bad > CHUNK_SHARE * len(found) else "ok"
    return ratio, min(found, default=ratio), max(found, default=ratio), len(found), bad, verdict


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packer = zstandard.ZstdCompressor(level=LEVEL)
    for batch in batches:
        ids, texts = batch.column(0), ["" if x is None else x for x in batch.column(1).to_pylist()]
        raw = [x.encode("utf-8", "surrogatepass") for x in texts]
        hashes, at = W.word_hashes(raw)
        out = []
        for i, text in enumerate(texts):
            words = hashes[at[i] : at[i + 1]]
            n, repeats = len(words), repeat_words(words)
            failed = n < 20 or 100 * repeats > 30 * n
            found = bands(raw[i], packer)
            chars = len(text) - sum(map(text.count, " \t\n\v\f\r"))
            out.append((n, chars, sum(map(text.count, _SYMBOLS)), dup_lines(text), repeats, failed, not failed and found[-1] == "ok", *found))
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio", "worst_low", "worst_high", "n_chunks", "n_bad_chunks", "verdict"]
        kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 3 + [pa.int64()] * 2 + [pa.string()]
        yield pa.RecordBatch.from_arrays([ids, *(pa.array(x, k) for x, k in zip(zip(*out) if out else [()] * len(kinds), kinds))], ["doc_id", *names])


def compression_bands(docs: DataFrame) -> DataFrame:
    """A row for each document, with base counts, ratios and the verdict."""
    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(_rows, SCHEMA)
