"""Packing along a space-filling curve.

A document's ids are hashed into DIMENSIONS buckets (square roots of counts, unit length), projected to AXES dimensions
by a fixed Gaussian matrix, and each coordinate is cut into 2**BITS equal shares of the normal distribution that such
projections follow; no statistic of the corpus is needed. The Hilbert index of the cell is the sort key: documents near
each other on the curve are near each other in the projection.

Rows are range-partitioned and sorted by (key, doc_id, crc of the ids), so that any number of documents with one key, such
as copies, spreads over partitions. Within a partition documents are laid end to end and cut at SIZE ids: no padding. The
last sequence of a partition, which can be short, is cut further into sequences whose lengths are powers of two, which
need none either. Tokens are made once and written to the shared folder (compressed), because range partitioning reads
its input twice. A task holds one document and one open sequence at a time.

Null texts count as empty: they have the end id alone. Repeated rows are packed each. Only doc_id and text are read.
An empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import batches_of, size_of, through_table
from .tokens import encoder
from .words import mix

SIZE, END_ID = 1024, 0
DIMENSIONS, AXES, BITS = 256, 4, 10
PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
#: Texts that go to a Python worker at once.
TEXTS_AT_ONCE = 512
#: Rows of pieces sent at once; compressed bytes that a task packs, where there are more than the session's partitions hold.
_FLUSH, PART_BYTES = 4096, 32 << 20


def _projection() -> tuple[np.ndarray, np.ndarray]:
    noise = np.random.Generator(np.random.PCG64(20240229))
    return noise.standard_normal((DIMENSIONS, AXES)), np.array([NormalDist().inv_cdf(i / (1 << BITS)) for i in range(1, 1 << BITS)])


def cells(ids: list[np.ndarray]) -> np.ndarray:
    """Grid coordinates of documents, a row for each."""
    matrix, cuts = _projection()
    vectors = np.zeros((len(ids), DIMENSIONS))
    for i, x in enumerate(ids):
        counts = np.bincount((mix(x.astype(np.uint64)) % np.uint64(DIMENSIONS)).astype(np.int64), minlength=DIMENSIONS)
        root = np.sqrt(counts)
        vectors[i] = root / max(1.0, np.sqrt(counts.sum()))
    return np.searchsorted(cuts, vectors @ matrix).astype(np.int64)


def hilbert_keys(grid: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Index on the Hilbert curve of integer points with ``bits`` bits a coordinate: Gray-code the axes from the highest bit down, undoing the rotation of each level."""
    x = grid.T.copy()
    axes = len(x)
    level = 1 << (bits - 1)
    while level > 1:
        low = level - 1
        for i in range(axes):
            flip = (x[i] & level) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0]) ^ swap
            if i:
                x[i] ^= swap
        level >>= 1
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    level = 1 << (bits - 1)
    while level > 1:
        turn ^= np.where((x[-1] & level) != 0, level - 1, 0)
        level >>= 1
    x ^= turn
    key = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(axes):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def _keyed(path: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS_AT_ONCE):
                batch = whole.slice(at, TEXTS_AT_ONCE)
                ids = [np.append(encoder(path).encode(x or ""), np.uint32(END_ID)) for x in batch.column(1).to_pylist()]
                raw = [x.astype("<u4").tobytes() for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(hilbert_keys(cells(ids))), pa.array([zlib.crc32(x) for x in raw], pa.int64()), pa.array([packer.compress(x.astype("<u2").tobytes() if not len(x) or x.max() < 65536 else b"\0" + r) for x, r in zip(ids, raw)], pa.binary()), pa.array([len(x) for x in ids], pa.int64())],
                    ["doc_id", "key", "crc", "packed", "n"],
                )

    return run


def _unpack(data: bytes, n: int) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(data)
    return np.frombuffer(raw, "<u2").astype("<u4") if len(raw) == 2 * n else np.frombuffer(raw[1:], "<u4")


def powers_of_two(n: int) -> list[int]:
    """Distinct powers of two, falling, that add up to n."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


class Sequences:
    """Lays documents end to end; pieces come out once their sequence is complete."""

    def __init__(self, first: int, size: int):
        self.next, self.size, self.fill = first, size, 0
        self.open: list[tuple[int | None, int, np.ndarray, int]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[tuple]:
        at = 0
        while at < len(ids):
            piece = ids[at : at + self.size - self.fill]
            self.open.append((doc_id, at, piece, len(ids)))
            at += len(piece)
            self.fill += len(piece)
            if self.fill == self.size:
                yield from self._close([self.size])

    def end(self) -> Iterator[tuple]:
        yield from self._close(powers_of_two(self.fill))

    def _close(self, sizes: list[int]) -> Iterator[tuple]:
        pieces, at = self.open[::-1], 0
        for size in sizes:
            at = 0
            while at < size:
                doc_id, start, ids, total = pieces.pop()
                if len(ids) > size - at:
                    pieces.append((doc_id, start + size - at, ids[size - at :], total))
                    ids = ids[: size - at]
                yield doc_id, start, len(ids), ids.tobytes(), total, self.next, at
                at += len(ids)
            self.next += 1
        self.open, self.fill = [], 0


def _pack(size: int) -> Callable:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequences = Sequences(TaskContext.get().partitionId() << 40, size)
        rows: list[tuple] = []
        for batch in batches:
            for doc_id, data, n in zip(*(batch.column(k).to_pylist() for k in range(3))):
                for row in sequences.add(doc_id, _unpack(data, n)):
                    rows.append(row)
                    if len(rows) >= _FLUSH:
                        yield out(rows)
                        rows = []
        rows += sequences.end()
        if rows:
            yield out(rows)

    return run


def pack(docs: DataFrame, tokenizer: str, size: int = SIZE) -> DataFrame:
    """Pieces of all documents: whose, from which of its ids, the ids (little-endian unsigned 32-bit), and their place in a sequence."""
    keyed = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(_keyed(tokenizer), "doc_id long, key long, crc long, packed binary, n long")
    with batches_of(docs.sparkSession, TEXTS_AT_ONCE):
        held = through_table(keyed, "packing")
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), size_of(held) // PART_BYTES)
    return held.repartitionByRange(parts, "key", "doc_id", "crc").sortWithinPartitions("key", "doc_id", "crc").select("doc_id", "packed", "n").mapInArrow(_pack(size), PIECES)


def pieces(docs: DataFrame, tokenizer: str, size: int = SIZE) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pack(docs, tokenizer, size).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
