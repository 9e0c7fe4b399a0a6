"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained and run in numpy.

Inputs of a word: its own vector, if training saw the word in DOCS_OF_WORD documents or more, and the mean vector of its
character n-grams (3 to 6 bytes of ^word$, hashed). Two GRUs read WINDOW words, one each way; attention pools their
states; a logistic unit scores the window. A document's score is the highest of all its windows, which start every STRIDE
words and at the last place that fits, so that the whole text is covered and every inner word lies in two windows.

Training is learning from documents' labels with windows as instances: a positive document teaches through the window
that scores highest so far (at first by log odds of its words' features, then by the model), a negative one through
random windows. The sample is bounded: POSITIVES and NEGATIVES documents at most, with their whole texts, taken in the
order of a hash of the id as long as the texts of a label hold SAMPLE_CHARS characters at most (the first is always taken).
All else covers every row and the whole of every text.

Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. Null and empty texts get the network's score
of an empty window. Without labels the score is 0 everywhere. Repeated rows get equal scores; of labels that contradict
each other for a document the higher holds. Other columns of the inputs are not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words as W
from .tables import batches_of, through_table

WINDOW, STRIDE, UNITS, WIDTH = 32, 16, 12, 12
SIZES, BUCKETS, WORDS, DOCS_OF_WORD = (3, 4, 5, 6), 1 << 15, 20_000, 3
POSITIVES, NEGATIVES, SAMPLE_CHARS = 1000, 1500, 12_000_000
ROUNDS, STEPS, BATCH, RATE, THRESHOLD = 5, 140, 192, 0.01, 0.3
_CHUNK = 2048
#: Texts that go to a Python worker at once.
TEXTS_AT_ONCE = 256
#: Words of the vocabulary whose n-grams are made at once.
_WORDS_AT_ONCE = 2048


def split_words(data: bytes) -> list[bytes]:
    return data.translate(_APART).split()


_APART = bytes(c if not W._PUNCTUATION[c] else 32 for c in range(256))


def char_ngrams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of ^word$ for all words in order, and how many each has."""
    joined = np.frombuffer(b"".join(b"^" + w + b"$" for w in words), np.uint8).astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words], np.int64)
    owner = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(joined))  # bytes to the end of the word
    at, of = [], []
    h = np.zeros(len(joined), np.uint64)
    for k in range(max(SIZES)):
        h[: len(joined) - k] = h[: len(joined) - k] * np.uint64(0x100000001B3) + joined[k:] + np.uint64(1)
        if k + 1 in SIZES:
            fits = np.flatnonzero(left >= k + 1)
            at.append(W.mix(h[fits] + np.uint64(k)) % np.uint64(BUCKETS))
            of.append(owner[fits])
    at, of = np.concatenate(at).astype(np.int64), np.concatenate(of)
    order = np.argsort(of, kind="stable")
    return at[order], np.bincount(of, minlength=len(words))


def windows_of(n: int) -> np.ndarray:
    """Where the windows of a text of n words start."""
    if n <= WINDOW:
        return np.zeros(1, np.int64)
    starts = np.arange(0, n - WINDOW + 1, STRIDE)
    return starts if starts[-1] == n - WINDOW else np.append(starts, n - WINDOW)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    def __init__(self, known: np.ndarray, word_prior: np.ndarray, char_prior: np.ndarray):
        """known: sorted hashes of the words that have a vector; the priors start the first coordinate of the vectors."""
        r = np.random.Generator(np.random.PCG64(7))
        f = lambda *shape: (r.standard_normal(shape) * 0.1).astype(np.float32)
        self.known = known
        self.p = {"word": f(len(known) + 1, WIDTH), "char": f(BUCKETS, WIDTH), "wx": f(2 * WIDTH, 6 * UNITS), "bx": np.zeros(6 * UNITS, np.float32), "uf": f(UNITS, 3 * UNITS), "ub": f(UNITS, 3 * UNITS), "v": f(2 * UNITS), "w": f(2 * UNITS), "b": np.full(1, -2.0, np.float32)}
        self.p["word"][:-1, 0], self.p["char"][:, 0] = word_prior, char_prior
        self.p["word"][-1] = 0

    def inputs(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of distinct words: their rows of the word table, n-gram buckets, counts, and vectors."""
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 2 * WIDTH), np.float32)
        h, _ = W.word_hashes([b" ".join(words)], punctuation=True)
        at = np.minimum(np.searchsorted(self.known, h), max(0, len(self.known) - 1))
        row = np.where(self.known[at] == h, at, len(self.known)) if len(self.known) else np.zeros(len(h), np.int64)
        grams, counts = char_ngrams(words)
        ends = np.cumsum(counts)
        means = np.add.reduceat(self.p["char"][grams], ends - counts, axis=0) / counts[:, None]
        return row, grams, counts, np.concatenate((self.p["word"][row], means.astype(np.float32)), axis=1)

    def _gru(self, x: np.ndarray, u: np.ndarray, mask: np.ndarray | None, keep: list | None) -> np.ndarray:
        """States (T, B, UNITS) of inputs (T, B, 3 UNITS) in the order given."""
        n = UNITS
        h = np.zeros((x.shape[1], n), np.float32)
        out = np.empty((len(x), x.shape[1], n), np.float32)
        for t in range(len(x)):
            hu = h @ u
            zr = _sigmoid(x[t, :, : 2 * n] + hu[:, : 2 * n])
            z, r = zr[:, :n], zr[:, n:]
            c = np.tanh(x[t, :, 2 * n :] + r * hu[:, 2 * n :])
            new = c + z * (h - c)
            if mask is not None:
                new = np.where(mask[t][:, None], new, h)
            if keep is not None:
                keep.append((h, z, r, c, hu[:, 2 * n :]))
            h = out[t] = new
        return out

    def forward(self, gates: np.ndarray, mask: np.ndarray | None, keep: dict | None = None) -> np.ndarray:
        """Logits of windows; gates (T, B, 6 UNITS), mask (T, B)."""
        n = 3 * UNITS
        kf, kb = ([], []) if keep is not None else (None, None)
        hf = self._gru(gates[:, :, :n], self.p["uf"], mask, kf)
        hb = self._gru(gates[::-1, :, n:], self.p["ub"], None if mask is None else mask[::-1], kb)[::-1]
        h = np.concatenate((hf, hb), axis=2)
        e = h @ self.p["v"]
        if mask is not None:
            e = np.where(mask, e, -1e9)
        a = np.exp(e - e.max(axis=0))
        if mask is not None:
            a = a * mask
        a /= np.maximum(a.sum(axis=0), 1e-9)
        pooled = np.einsum("tb,tbd->bd", a, h)
        if keep is not None:
            keep.update(kf=kf, kb=kb, h=h, a=a, pooled=pooled)
        return pooled @ self.p["w"] + self.p["b"][0]

    def _gru_back(self, dh: np.ndarray, u: np.ndarray, mask: np.ndarray, keep: list) -> tuple[np.ndarray, np.ndarray]:
        n = UNITS
        dx, du, carry = np.zeros((*dh.shape[:2], 3 * n), np.float32), np.zeros_like(u), np.zeros_like(dh[0])
        for t in range(len(dh) - 1, -1, -1):
            h, z, r, c, hn = keep[t]
            whole = dh[t] + carry
            d = whole * mask[t][:, None]
            dc = d * (1 - z) * (1 - c * c)
            both = np.concatenate((d * (h - c) * z * (1 - z), dc * hn * r * (1 - r), dc * r), axis=1)
            dx[t] = np.concatenate((both[:, : 2 * n], dc), axis=1)
            du += h.T @ both
            carry = whole - d + d * z + both @ u.T
        return dx, du

    def gradients(self, words: list[bytes], which: np.ndarray, mask: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Of the weighted mean log loss of windows; which (T, B): places in ``words``."""
        p = self.p
        row, grams, counts, x = self.inputs(words)
        gates = (x @ p["wx"] + p["bx"])[which]
        k: dict = {}
        logit = self.forward(gates, mask, k)
        d = ((_sigmoid(logit) - y) * weight / weight.sum()).astype(np.float32)
        g = {"w": k["pooled"].T @ d, "b": np.array([d.sum()])}
        dpool = d[:, None] * p["w"]
        da = np.einsum("bd,tbd->tb", dpool, k["h"])
        de = k["a"] * (da - (k["a"] * da).sum(axis=0))
        g["v"] = np.einsum("tb,tbd->d", de, k["h"])
        dh = k["a"][:, :, None] * dpool + de[:, :, None] * p["v"]
        dxf, g["uf"] = self._gru_back(dh[:, :, :UNITS], p["uf"], mask, k["kf"])
        dxb, g["ub"] = self._gru_back(dh[::-1, :, UNITS:], p["ub"], mask[::-1], k["kb"])
        dg = np.zeros((len(words), 6 * UNITS), np.float32)
        np.add.at(dg, which.ravel(), np.concatenate((dxf, dxb[::-1]), axis=2).reshape(-1, 6 * UNITS))
        g["wx"], g["bx"] = x.T @ dg, dg.sum(axis=0)
        dx = dg @ p["wx"].T
        g["word"], g["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
        np.add.at(g["word"], row, dx[:, :WIDTH])
        g["word"][-1] = 0
        np.add.at(g["char"], grams, np.repeat(dx[:, WIDTH:] / counts[:, None], counts, axis=0))
        return g

    def scores(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The highest window score of each text, and where that window starts."""
        split = [split_words(x) for x in texts]
        index: dict[bytes, int] = {}
        places = [np.fromiter((index.setdefault(w, len(index)) for w in ws), np.int64, len(ws)) for ws in split]
        *_, x = self.inputs(list(index))
        table = np.concatenate((x @ self.p["wx"] + self.p["bx"], np.zeros((1, 6 * UNITS), np.float32)))
        pad = len(index)
        flat = np.concatenate([*places, np.full(WINDOW, pad)])
        offset = np.cumsum([0, *map(len, places)])
        starts = [windows_of(len(p)) for p in places]
        doc = np.repeat(np.arange(len(texts)), [len(s) for s in starts])
        first = np.concatenate(starts)
        best, where = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
        for a in range(0, len(doc), _CHUNK):
            d, s = doc[a : a + _CHUNK], first[a : a + _CHUNK]
            at = (offset[d] + s)[None, :] + np.arange(WINDOW)[:, None]
            mask = at < offset[d + 1][None, :]
            which = np.where(mask, flat[np.minimum(at, len(flat) - 1)], pad)
            p = _sigmoid(self.forward(table[which], None if mask.all() else mask))
            for i, k, q in zip(d.tolist(), s.tolist(), p.tolist()):
                if q > best[i]:
                    best[i], where[i] = q, k
        return best, where


def train(texts: list[bytes], labels: list[int]) -> Network:
    y = np.array(labels, np.float32)
    vocabulary = sorted({w for x in texts for w in split_words(x)})
    place = {w: i for i, w in enumerate(vocabulary)}
    docs = [np.fromiter((place[w] for w in split_words(x)), np.int64) for x in texts]  # words of one text at a time as objects
    del place
    n_pos, n_neg = max(1.0, float(y.sum())), max(1.0, float(len(y) - y.sum()))

    def odds(pos: np.ndarray, neg: np.ndarray) -> np.ndarray:
        """Log odds of documents with a feature, drawn to 0 where few have it."""
        return (np.log((pos + 0.5) / (n_pos + 1)) - np.log((neg + 0.5) / (n_neg + 1))) * (pos + neg) / (pos + neg + 3)

    blocks = range(0, len(vocabulary), _WORDS_AT_ONCE)
    made = [(g.astype(np.uint16), n) for g, n in (char_ngrams(vocabulary[a : a + _WORDS_AT_ONCE]) for a in blocks)]  # BUCKETS fit in 16 bits
    grams = np.concatenate([g for g, _ in made]) if made else np.zeros(0, np.uint16)
    counts = np.concatenate([n for _, n in made]) if made else np.zeros(0, np.int64)
    del made
    ends = np.cumsum(counts)
    word_in, char_in = np.zeros((2, len(vocabulary))), np.zeros((2, BUCKETS))
    for ids, label in zip(docs, labels):
        distinct = np.unique(ids)
        word_in[label, distinct] += 1
        if len(distinct):
            char_in[label, np.unique(np.concatenate([grams[ends[i] - counts[i] : ends[i]] for i in distinct]))] += 1
    word_odds, char_odds = odds(word_in[1], word_in[0]), odds(char_in[1], char_in[0])
    prior = word_odds.copy()
    for a in blocks:
        some, first = slice(a, a + _WORDS_AT_ONCE), ends[a] - counts[a]
        best = np.maximum.reduceat(char_odds[grams[first : ends[some][-1]]], ends[some] - counts[some] - first)
        prior[some] = np.maximum(word_odds[some], best)
    seen = word_in.sum(axis=0)
    chosen = np.argsort(-seen, kind="stable")[:WORDS]
    chosen = chosen[seen[chosen] >= DOCS_OF_WORD]
    hashes, _ = W.word_hashes([b" ".join(vocabulary[i] for i in chosen)], punctuation=True)
    order = np.argsort(hashes)
    net = Network(hashes[order], word_odds[chosen][order] * 0.5, char_odds * 0.5)

    def best_prior(ids: np.ndarray) -> int:
        if len(ids) <= WINDOW:
            return 0
        at = int(prior[ids].argmax())
        starts = windows_of(len(ids))
        return int(starts[np.abs(starts + WINDOW // 2 - at).argmin()])

    def best_windows(some: list[int]) -> np.ndarray:
        return np.concatenate([net.scores([texts[i] for i in some[a : a + 32]])[1] for a in range(0, len(some), 32)])

    r = np.random.Generator(np.random.PCG64(11))
    state = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    step = 0
    positive = [i for i in range(len(y)) if y[i] and len(docs[i])]
    negative = [i for i in range(len(y)) if not y[i] and len(docs[i])]
    epoch = 0
    while positive and negative and (epoch < ROUNDS or step < STEPS):  # a small sample is gone through more often
        if epoch:
            where = best_windows(positive)
            chosen_at = dict(zip(positive, where.tolist()))
        else:
            chosen_at = {i: best_prior(docs[i]) for i in positive}
        instances = [(i, s) for i, s in chosen_at.items()]
        for i in negative:
            starts = windows_of(len(docs[i]))
            instances += [(i, int(s)) for s in r.choice(starts, min(2, len(starts)), replace=False)]
        if epoch:  # the negative windows that score highest teach most
            instances += list(zip(negative, best_windows(negative).tolist()))
        r.shuffle(instances)
        share = len(positive) / max(1, len(instances))
        size = max(32, min(BATCH, len(instances) // 8))
        epoch += 1
        for a in range(0, len(instances), size):
            some = instances[a : a + size]
            ids = np.full((WINDOW, len(some)), -1, np.int64)
            for k, (i, s) in enumerate(some):
                got = docs[i][s : s + WINDOW]
                ids[: len(got), k] = got
            mask = ids >= 0
            distinct, which = np.unique(np.where(mask, ids, 0), return_inverse=True)
            label = y[[i for i, _ in some]]
            g = net.gradients([vocabulary[i] for i in distinct], which.reshape(ids.shape), mask, label, np.where(label > 0, min(4.0, 0.25 / share), 1.0).astype(np.float32))
            step += 1
            for key, d in g.items():
                m, v = state[key]
                m += 0.1 * (d - m)
                v += 0.001 * (d * d - v)
                net.p[key] -= (RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step) * m / (np.sqrt(v) + 1e-7)).astype(np.float32)
    return net


def sample(docs: DataFrame, labels: DataFrame) -> list[tuple[bytes, int]]:
    """The bounded sample of labelled texts, of rows that are not held out."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)").where(~held_out("doc_id"))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    some = [known.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for k, n in ((1, POSITIVES), (0, NEGATIVES))]
    picked = some[0].unionAll(some[1])
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    one = texts.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))  # at most POSITIVES + NEGATIVES rows are sent
    order = Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    size = F.length("text").cast("long")
    one = one.withColumn("held", F.sum(size).over(order)).where((F.col("held") <= SAMPLE_CHARS) | (F.col("held") == size)).drop("held")
    return [(W.lowered(r.text), r.toxic) for r in sorted(one.collect(), key=lambda r: r.doc_id)]


def held_out(column: str):
    return F.coalesce(F.pmod(F.crc32(F.col(column).cast("string")), F.lit(4)) == 2, F.lit(False))


def _score(sent: bytes | None, column: int, name: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = pickle.loads(sent) if sent else None
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS_AT_ONCE):
                batch = whole.slice(at, TEXTS_AT_ONCE)
                texts = [W.lowered(x) for x in batch.column(column).to_pylist()]
                yield batch.append_column(name, pa.array(net.scores(texts)[0] if net else np.zeros(len(texts)), pa.float64()))

    return run


def with_score(docs: DataFrame, labels: DataFrame, name: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text."""
    rows = sample(docs, labels)
    sent = pickle.dumps(train([t for t, _ in rows], [k for _, k in rows])) if len({k for _, k in rows}) == 2 else None
    return docs.mapInArrow(_score(sent, docs.columns.index("text"), name), docs.withColumn(name, F.lit(0.0)).schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    scored = with_score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), labels)
    judged = scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
    with batches_of(docs.sparkSession, TEXTS_AT_ONCE):
        return through_table(judged, "scores")


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold, unchanged."""
    name = "score_"
    while name in docs.columns:
        name += "_"
    with batches_of(docs.sparkSession, TEXTS_AT_ONCE):
        return through_table(with_score(docs, labels, name).where(F.col(name) < threshold).drop(name), "accepted")
