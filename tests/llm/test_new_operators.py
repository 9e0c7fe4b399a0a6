"""Operators 11 to 13 against brute force, with nulls, empty and long inputs, ties, repeats, no rows, and clashing columns."""

import hashlib
import math
import re
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from vacantia.llm import centroids, fill_in_middle, queries, recompression

DOCS = "doc_id long, text string, n long, form string, name string, words string, block int"


def documents(spark, texts, ids=None):
    return spark.createDataFrame([(i if ids is None else ids[i], t, 1, "x", "y", "z", 7) for i, t in enumerate(texts)], DOCS)


# --- 11


def brute_kmeans(vectors, k=8, rounds=10, seed=3):
    """(cluster, squared distance) by vector in plain Python integers, and the centroids."""
    points = [(i, [math.floor(1024 * x) for x in v]) for i, v in vectors if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    hashed = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in points if i is not None)
    centres = [v for _, v in hashed[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        groups = {}
        for _, v in points:
            groups.setdefault(nearest(v)[1], []).append(v)
        centres = [[math.floor(Fraction(sum(x), len(groups[j]))) for x in zip(*groups[j])] if j in groups else c for j, c in enumerate(centres)]
    return [(i, nearest(v)[1], nearest(v)[0]) for i, v in points], centres


def clouds(n, seed=1, spread=0.3):
    r = np.random.Generator(np.random.PCG64(seed))
    middles = r.normal(0, 0.3, (10, 64))
    return [(i, [float(x) for x in np.float32(middles[i % 10] + r.normal(0, spread, 64))]) for i in range(n)]


def table_of(spark, rows):
    return spark.createDataFrame([(i, v, "a", 1, 2.0) for i, v in rows], "vec_id long, embedding array<double>, v string, cluster int, distance double")


@pytest.mark.parametrize("listed", [1, 3, 7])
def test_clusters(spark, listed):
    rows = clouds(300)
    rows += [(1000 + i, rows[0][1]) for i in range(40)]  # one very common vector
    rows += [(5, rows[5][1]), (None, rows[6][1]), (None, rows[7][1])]  # a repeated row, rows without an id
    rows += [(2000, None), (2001, []), (2002, [0.5] * 63), (2003, [0.1] * 63 + [None]), (2004, [0.1] * 63 + [math.nan]), (2005, [math.inf] + [0.0] * 63), (2006, [-0.0001] * 64)]
    state, centres = centroids.drake(table_of(spark, rows), listed=listed)
    want, last = brute_kmeans(rows)
    got = [(r.vec_id, r.cluster, r.distance) for r in state.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert centres.tolist() == last


def test_cluster_digests_and_sums(spark):
    rows = clouds(60, 4)
    want, centres = brute_kmeans(rows)
    got = {r.vec_id: r for r in centroids.centroid_clusters(table_of(spark, rows)).collect()}
    assert len(got) == 60
    for i, c, d in want:
        r = got[i]
        assert (r.cluster, r.distance, r.inertia) == (c, d, sum(x for *_, x in want))
        assert r.cluster_inertia == sum(x for _, k, x in want if k == c)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest()


def test_ties_go_to_the_smaller_number(spark):
    """Equal starts: the first takes all, the others stay empty."""
    rows = [(i, [0.25] * 64) for i in range(12)] + [(100 + i, [0.25 + (i % 3 - 1) / 1024] + [0.25] * 63) for i in range(9)]
    want, centres = brute_kmeans(rows)
    state, last = centroids.drake(table_of(spark, rows))
    assert sorted((r.vec_id, r.cluster, r.distance) for r in state.collect()) == sorted(want)
    assert last.tolist() == centres


@pytest.mark.parametrize("n", [0, 1, 5])
def test_fewer_vectors_than_centroids(spark, n):
    rows = clouds(n)
    assert sorted((r.vec_id, r.cluster, r.distance) for r in centroids.centroid_clusters(table_of(spark, rows)).collect()) == sorted(brute_kmeans(rows)[0])
    assert centroids.centroid_clusters(table_of(spark, rows)).columns[:3] == ["vec_id", "cluster", "distance"]


def test_large_components_stay_exact(spark):
    rows = [(i, [(-1) ** (i + j) * (131071.9 - i - j) for j in range(64)]) for i in range(40)] + [(99, [131072.0] + [0.0] * 63)]
    want, _ = brute_kmeans(rows[:-1])
    assert sorted((r.vec_id, r.cluster, r.distance) for r in centroids.centroid_clusters(table_of(spark, rows)).collect()) == sorted(want)


def test_bounds_save_distances(spark):
    rows = clouds(400, 2, 0.05)
    state, _ = centroids.drake(table_of(spark, rows))
    assert state.agg(F.sum("found")).first()[0] < 0.5 * 400 * 8 * 11


# --- 12


def brute_fim(doc_id, text, seed=1):
    text = text or ""
    tokens = re.findall("[A-Za-z]+|[^A-Za-z]", text, re.S)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    n = len(tokens)
    if text == "" or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle(spark):
    texts = [None, "", "a", " ", "\n\n", "<P>", "a<S>b", "x <M> y", "<P <S <M", "é日本\U0001f600 abc", "ab1cd  Ef\t", "long text " * 50_000]
    texts += [f"some words {i}, <more> of them<" + "<S" * (i % 3) for i in range(300)]
    ids = [None, None, *range(2, len(texts) - 1), 17]
    rows = fill_in_middle.fill_in_middle(documents(spark, texts, ids)).collect()
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256, r.restored_sha256, r.output) for r in rows), key=str)
    want = []
    for i, t in zip(ids, texts):
        n, form, a, b, out = brute_fim(i, t)
        want.append((i, n, form, a, b, hashlib.sha256(out.encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest(), out))
    assert got == sorted(want, key=str)
    assert {form for _, _, form, *_ in got} == {"plain", "psm", "spm"}


def test_any_cut_is_rebuilt():
    for text in ("<", "<S", "a<S<", "<P", "><M", "<<<>>>", "M>a<", "S>P>M>"):
        for doc_id in range(200):
            *_, form, _, _, out = (brute_fim(doc_id, text))
            assert fill_in_middle.restore(out, form) == text
            assert fill_in_middle.cut(text, doc_id, 1)[4] == out


def test_no_documents_to_fill(spark):
    empty = fill_in_middle.fill_in_middle(documents(spark, ["a"]).where("false"))
    assert empty.count() == 0 and empty.columns[0] == "doc_id"


# --- 13


def words_of(seed, n, size=5000):
    return [f"w{x}" for x in np.random.Generator(np.random.PCG64(seed)).integers(0, size, n)]


def brute_repeats(texts):
    cut = [(t or "").encode().split() for t in texts]
    seen = {}
    for ws in cut:
        for i in range(len(ws) - 34):
            w = tuple(ws[i : i + 35])
            seen[w] = seen.get(w, 0) + 1
    out = []
    for ws in cut:
        gone = set()
        for i in range(len(ws) - 34):
            if seen[tuple(ws[i : i + 35])] > 1:
                gone.update(range(i, i + 35))
        out.append((len(ws), len(gone), hashlib.sha256(b" ".join(w for i, w in enumerate(ws) if i not in gone)).hexdigest()))
    return out


def against_brute(spark, texts, ids=None):
    got = recompression.without_repeats(documents(spark, texts, ids)).collect()
    want = brute_repeats(texts)
    ids = range(len(texts)) if ids is None else ids
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) == sorted(((i, *w) for i, w in zip(ids, want)), key=str)
    return want


def test_repeats(spark, monkeypatch):
    shared = [words_of(90 + k, n) for k, n in enumerate((34, 35, 36, 60, 300))]
    texts = [None, "", " \n\t ", "one", "one two"]
    for k in range(40):  # passages at any place, alone and side by side, one exactly a window
        ws = words_of(k, 80 + 7 * k)
        at = (13 * k) % len(ws)
        texts.append(" ".join(ws[:at] + shared[k % 5] + (shared[(k + 1) % 5] if k % 4 == 0 else []) + ws[at:]))
    texts += [texts[-1]] * 5 + [texts[-2].replace(" ", "\n")]  # exact copies, one of other blanks
    for k in range(30):  # near copies of one text, of one word each
        ws = words_of(777, 400)
        ws[(37 * k) % 400] = f"z{k}"
        texts.append(" ".join(ws))
    texts += [" ".join(words_of(778, 300)[k * 10 :]) for k in range(20)]  # each a part of the one before
    texts += [" ".join(["a"] * n) for n in (34, 35, 36, 400)]  # runs, periods, few symbols
    texts += [" ".join((["a", "b"] * 40)[k:]) for k in range(3)] + [" ".join(["a", "b", "c"] * 30), " ".join((["q"] * 20 + ["r"] * 15) * 2), "p " * 17 + "s " * 18]
    texts += [" ".join(words_of(k, 150, 2)) for k in range(600, 620)]
    texts += ["Same " + " ".join(words_of(901, 40)), "same " + " ".join(words_of(901, 40))]
    want = against_brute(spark, texts)
    assert sum(1 for _, n, _ in want if n) > 80 and sum(1 for a, n, _ in want if a > 35 and not n) > 5
    monkeypatch.setattr(recompression, "BLOCK_ROUNDS", 6)
    against_brute(spark, texts)


def test_repeats_of_rows_and_long_texts(spark):
    long = " ".join(words_of(1, 60_000, 50_000) + words_of(2, 100) + words_of(3, 60_000, 50_000) + words_of(2, 100))
    texts = [long, "x " * 50_000, " ".join(words_of(4, 50)), " ".join(words_of(4, 50)), " ".join(words_of(5, 70))]
    want = against_brute(spark, texts, [1, 2, 3, 3, None])
    assert [n for _, n, _ in want] == [200, 50_000, 50, 50, 0]


def test_no_repeats(spark):
    against_brute(spark, [])
    against_brute(spark, [None, "", " "])
    against_brute(spark, [" ".join(words_of(k, 500)) for k in range(4)])


def test_cores_hold_the_same_symbols_wherever_a_window_stands():
    window = words_of(7, 35, 4)
    for level in range(6):
        found = set()
        for k in range(30):
            text = " ".join(words_of(100 + k, k, 4) + window + words_of(200 + k, 30 - k, 4)).encode()
            at, _ = recompression._words([text])
            begin, end = np.array([k]), np.array([k + 35])
            for _ in range(level):
                above = at.compressed()
                begin, end = at.core(begin, end)
                at = above
                if begin[0] >= end[0]:
                    break
            found.add(tuple(at.names[begin[0] : max(begin[0], end[0])].tolist()))
        assert len(found) == 1


def test_stretches_are_the_least_of_their_range():
    r = np.random.Generator(np.random.PCG64(3))
    hashes = r.integers(0, 20, 500).astype(np.uint64)
    begin = r.integers(0, 450, 300)
    end = begin + r.integers(1, 50, 300)
    assert recompression._least(hashes, begin, end).tolist() == [b + int(np.argmin(hashes[b:e])) for b, e in zip(begin, end)]


def test_the_three_are_registered():
    for name in ("op11_drake_bounds", "op12_fill_in_middle", "op13_recompression"):
        assert name in queries.QUERIES and name in queries.ORACLES
