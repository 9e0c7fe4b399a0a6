"""Word and shingle hashes of whole texts, vectorised over bytes.

A word is a run of bytes other than space and 0x09-0x0D. Hashes are 64-bit: a polynomial over the word's bytes by
prefix sums, so that a block of text costs a few array passes and no Python step per word, and then a mixer.
"""

from __future__ import annotations

import hashlib

import numpy as np

BLOCK = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_STEP = np.uint64(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: As _SPACE, but ASCII letters and digits and all bytes of other characters make words.
_PUNCTUATION = np.ones(256, dtype=bool)
_PUNCTUATION[[*range(48, 58), *range(97, 123), *range(128, 256)]] = False
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits whose output bits depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            held = np.full(max(n, BLOCK + 1024), base, np.uint64)
            held[0] = 1
            _powers[k] = np.cumprod(held, dtype=np.uint64)
    return _powers


def _block(data: bytes, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of ``data`` and the places where they start; ``apart``: which bytes stand between words."""
    a = np.frombuffer(data, np.uint8)
    space = np.ones(len(a) + 2, np.int8)
    space[1:-1] = apart[a]
    edge = np.diff(space)
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    power, inverse = _power_tables(len(a) + 1)
    sums = np.zeros(len(a) + 1, np.uint64)
    np.cumsum((a.astype(np.uint64) + np.uint64(1)) * power[: len(a)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts]), starts


def _cuts(data: bytes) -> list[bytes]:
    """``data`` in blocks of about BLOCK bytes, cut at white space only."""
    out, at = [], 0
    while len(data) - at > BLOCK:
        cut = at + BLOCK
        while cut < len(data) and not _SPACE[data[cut]]:
            cut += 1
        out.append(data[at:cut])
        at = cut
    return [*out, data[at:]]


def word_hashes(texts: list[bytes], punctuation: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts in order, and bounds: text i has the words from bounds[i] to bounds[i+1].

    punctuation: it separates words too (lower-case the texts before).
    """
    apart = _PUNCTUATION if punctuation else _SPACE
    hashes, counts = [], np.zeros(len(texts) + 1, np.int64)
    group: list[bytes] = []
    first = size = 0

    def flush(upto: int) -> None:
        nonlocal group, first, size
        if group:
            found, starts = _block(b"\n".join(group), apart)
            offsets = np.cumsum([0, *(len(x) + 1 for x in group)])
            counts[first + 1 : upto + 1] = np.diff(np.searchsorted(starts, offsets))
            hashes.append(found)
        group, first, size = [], upto, 0

    for i, text in enumerate(texts):
        if len(text) > BLOCK:
            flush(i)
            parts = [_block(x, apart)[0] for x in _cuts(text)]
            hashes += parts
            counts[i + 1] = sum(map(len, parts))
            first = i + 1
            continue
        group.append(text)
        size += len(text) + 1
        if size > BLOCK:
            flush(i + 1)
    flush(len(texts))
    return np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), np.cumsum(counts)


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash for each n consecutive words, in order."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = words[:m].copy()
    for j in range(1, n):
        out = out * _STEP + words[j : j + m]
    return mix(out)


def shingle_set(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct n-word shingles; a shorter text with a word counts as one shingle, a text without words has none."""
    if 0 < len(words) < n:
        return ngram_hashes(words, len(words))
    return np.unique(ngram_hashes(words, n))


def digest(sorted_set: np.ndarray) -> bytes:
    """128 bits that name a set of hashes."""
    return hashlib.blake2b(sorted_set.tobytes(), digest_size=16).digest()


def lowered(text: str | None) -> bytes:
    """UTF-8 with A-Z lower-cased; null counts as empty."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass").lower()
