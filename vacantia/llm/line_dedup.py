"""Line deduplication: an exact set-similarity join of lines, by DataFrame functions alone.

A line is a \\n-separated part of a text; its tokens are the distinct lower-cased words between white space. Lines match
when 100 * intersection >= 90 * union. Lines are ordered by (doc_id, hash of the text, number of the line); a line goes if
any earlier line matches it, whether or not that one goes itself. Blank lines always stay.

Equal token sets are one set, known by its first line. Sets of 8 tokens or fewer match equal sets only. For the others:

- Tokens are ordered by rarity: by the count, over all texts, of the words in their hash bucket (classes of half a power
  of two), ties by hash. Any common order is exact; this one makes the groups below small.
- Prefix filter: two sets of n and m tokens that match differ by H = n + m - 2 * need tokens at most, and each of these
  lies in one gap between neighbours in the order of the common tokens. So among the first H + 1 such pairs of
  neighbours one stands side by side in both sets, and it ends within the first n div 5 + 2 tokens of the one set and
  m div 5 + 2 of the other. Pairs of neighbouring tokens in these prefixes are the keys.
- Length filter: sizes differ by a factor of 0.9 at most.
- Positional filter: what stands before and behind the common key in both sets must suffice for the overlap.
- Parity filter: a set's 64 bits hold the parity of its tokens by bucket, so that two sets differ in no more bits than in
  tokens, H at most.
- Verification: the token sets of the pairs left are intersected.

Sets that share a key are first held against one of them alone, the one with most copies. In a family of near copies
nearly all lines are decided by that. Only those that are not (no earlier match found yet) are held against all others of
their keys, so that a family costs its size and not its square. Groups are joined and filtered as they form, never gathered.

Null and empty texts have no line to remove and come back as they are; so does an empty table. Rows with equal doc_id and
text are one document, none of which is later than the other; null doc_ids come first. Very long texts are read whole.
Other columns are passed through, whatever their names.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import discard, releasing_shuffles, through_table

#: A match: OF * intersection >= SHARE * union.
SHARE, OF = 90, 100
#: Sets up to this size match equal ones only: one differing token leaves less than SHARE.
ALIKE = 8
#: Buckets of words whose counts tell how rare a word is, as a power of two; and how many are sent to the driver as one row.
BUCKET_BITS, SLICE = 18, 64
#: Documents of which lines are read again are told to the executors by so many bits of their texts' hashes.
MARK_BITS = 18


def _words(text: str, lines: bool = True) -> str:
    """SQL for the lower-cased words of ``text``, an empty one wherever two spaces meet; lines: whether it may have several."""
    apart = f"lower({text})"
    for space in ("\\t", "\\u000B", "\\u000C", "\\r", *(["\\n"] if lines else [])):
        apart = f"replace({apart}, '{space}', ' ')"
    return f"split({apart}, ' ')"


def _byte_table(values: DataFrame, bits: int) -> bytearray:
    """Rows (b, c) as a table of 1 << bits bytes that holds c at b, 0 elsewhere. What reaches the driver has that size."""
    cells = values.selectExpr(f"b div {SLICE} as slice", f"struct(cast(b % {SLICE} as int), cast(c as int)) as c")
    written = f"array_join(transform(sequence(0, {SLICE - 1}), i -> lpad(hex(coalesce(element_at(map_from_entries(cs), i), 0)), 2, '0')), '')"
    slices = cells.groupBy("slice").agg(F.collect_list("c").alias("cs")).selectExpr("slice", f"{written} as written")
    with releasing_shuffles(values.sparkSession):
        rows = slices.collect()
    out = bytearray(1 << bits)
    for row in rows:
        out[row.slice * SLICE : (row.slice + 1) * SLICE] = bytes.fromhex(row.written)
    return out


def rarity(text: DataFrame) -> list[int]:
    """For each bucket of word hashes a class that grows with the count of its words in all texts."""
    words = text.select(F.explode(F.expr(_words("text"))).alias("w"))
    counts = words.groupBy(F.expr(f"xxhash64(w) & {(1 << BUCKET_BITS) - 1}").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    return list(_byte_table(counts.selectExpr("b", "cast(2 * log2(n) as int) as c"), BUCKET_BITS))


def _hashes(line: str) -> Column:
    """The distinct hashes of a line's words."""
    hashed = F.transform(F.expr(_words(line, lines=False)), lambda w: F.xxhash64(w))
    return F.array_remove(F.array_distinct(hashed), F.xxhash64(F.lit("")))


def _tokens(line: str, classes: list[int]) -> Column:
    """A line's distinct tokens, rarest first: seven bits for the class, then 56 bits of the hash."""
    table = F.from_json(F.lit(json.dumps(classes)), "array<int>")  # folded into one literal

    def key(h: Column) -> Column:
        rare = F.coalesce(F.get(table, h.bitwiseAND(F.lit((1 << BUCKET_BITS) - 1)).cast("int")), F.lit(0))
        return F.shiftleft(rare.cast("long"), 56).bitwiseOR(F.shiftrightunsigned(h, 8))

    return F.sort_array(F.transform(_hashes(line), key))


def _need(a: str, b: str) -> str:
    """The overlap that sets of sizes a and b need, as SQL; exact in integers."""
    return f"(({SHARE} * ({a} + {b}) + {SHARE + OF - 1}) div {SHARE + OF})"


#: Whether the sets a and b may match, as SQL.
_MAY_MATCH = f"""{OF} * least(n_a, n_b) >= {SHARE} * greatest(n_a, n_b)
  and least(pos_a, pos_b) + least(n_a - pos_a, n_b - pos_b) >= {_need("n_a", "n_b")}
  and bit_count(bits_a ^ bits_b) <= n_a + n_b - 2 * {_need("n_a", "n_b")}
  and (n_a != n_b or {_need("n_a", "n_b")} < n_a)"""
_MEMBER = ("sig", "n", "pos", "bits")


def _side(members: DataFrame, side: str, *more: str) -> DataFrame:
    return members.select("key", *(F.col(c).alias(f"{c}_{side}") for c in (*_MEMBER, *more)))


def _sets(text: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All lines with the names of their sets; and the sets that are not empty, with keys."""
    classes = rarity(text)
    lines = text.select("doc_id", "th", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    sized = lines.select("doc_id", "th", "at", _tokens("line", classes).alias("tokens"))
    pair_keys = "transform(sequence(1, n div 5 + 1), i -> xxhash64(tokens[i - 1], tokens[i]))"
    parity = "aggregate(tokens, 0L, (x, t) -> x ^ shiftleft(1L, cast(t & 63 as int)))"
    described = sized.select("doc_id", "th", "at", F.size("tokens").alias("n"), "tokens").select(
        "doc_id", "th", "at", "n", F.xxhash64("tokens").alias("sig"), F.hash("tokens").alias("sig2"),
        F.expr(f"if(n > {ALIKE}, {parity}, null)").alias("bits"), F.expr(f"if(n > {ALIKE}, {pair_keys}, null)").alias("keys"),
    )
    lines = through_table(described, "lines")
    first = F.min(F.struct("doc_id", "th", "at")).alias("first")
    same = (F.first(c).alias(c) for c in ("n", "bits", "keys"))
    return lines, through_table(lines.where("n > 0").groupBy("sig", "sig2").agg(first, F.count(F.lit(1)).alias("copies"), *same), "line-sets")


def _members(sets: DataFrame) -> DataFrame:
    """A row for each set and each of its keys, of keys that several sets have."""
    some = sets.where("keys is not null").select("sig", "n", "bits", "copies", F.posexplode("keys").alias("at", "key"))
    dealt = some.select("key", "sig", "n", (F.col("at") + 2).alias("pos"), "bits", "copies").repartition("key")
    repeated = dealt.groupBy("key").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("key")
    return through_table(dealt.join(repeated.hint("shuffle_hash"), "key"), "line-keys")


def _known(text: DataFrame, sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """(sig, first, tokens) of the sets in ``pairs``, read from their first lines."""
    wanted = pairs.select(F.col("a").alias("sig")).unionByName(pairs.select(F.col("b").alias("sig"))).distinct()
    where = sets.select("sig", "first").join(wanted, "sig").groupBy("sig").agg(F.min("first").alias("first"))
    by_document = where.groupBy(F.col("first.doc_id").alias("_doc"), F.col("first.th").alias("_th"))
    places = through_table(by_document.agg(F.collect_list(F.struct("first.at", "sig")).alias("places")), "line-places")  # lines of one document
    marks = _byte_table(places.selectExpr(f"_th & {(1 << MARK_BITS) - 1} as b").distinct().withColumn("c", F.lit(1)), MARK_BITS)
    mark = F.substring(F.lit(marks), F.expr(f"cast(th & {(1 << MARK_BITS) - 1} as int) + 1"), F.lit(1))
    some = text.where(mark == F.lit(bytearray(b"\x01")))  # all documents that are wanted, and few others
    found = some.join(places, F.expr("th = _th and doc_id <=> _doc")).withColumn("parts", F.split("text", "\n"))
    line = F.transform("places", lambda p: F.struct(p["sig"].alias("sig"), p["at"].alias("at"), F.get(F.col("parts"), p["at"]).alias("line")))
    lines = found.select("doc_id", "th", F.size("parts"), F.explode(line).alias("p"))
    tokens = lines.select("p.sig", F.struct("doc_id", "th", "p.at").alias("first"), _hashes("p.line").alias("tokens"))
    known = through_table(tokens.groupBy("sig").agg(F.min(F.struct("first", "tokens")).alias("k")).select("sig", "k.*"), "line-tokens")  # equal rows repeat a line
    discard(places)
    return known


def _later(text: DataFrame, sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The later sets of the pairs (a, b) that match."""
    known = _known(text, sets, pairs)
    a, b = (known.select(F.col("sig").alias(k), F.col("tokens").alias(f"tokens_{k}"), F.col("first").alias(f"first_{k}")) for k in "ab")
    overlap = pairs.join(a, "a").join(b, "b").withColumn("both", F.size(F.array_intersect("tokens_a", "tokens_b")))
    matched = overlap.where(f"{OF} * both >= {SHARE} * (size(tokens_a) + size(tokens_b) - both)")
    later = matched.select(F.when(F.col("first_a") < F.col("first_b"), F.col("b")).otherwise(F.col("a")).alias("sig")).distinct()
    later = through_table(later, "line-later")
    discard(known)
    return later


def removed_lines(text: DataFrame) -> DataFrame:
    """(doc_id, th, at) of the lines that go; ``text`` has doc_id, text and th, a hash of the text."""
    lines, sets = _sets(text)
    members = _members(sets)

    strongest = members.groupBy("key").agg(F.max(F.struct("copies", *_MEMBER)).alias("p")).select("key", "p.*")
    one_side = _side(members, "b").join(_side(strongest, "a"), "key").where(f"sig_a != sig_b and {_MAY_MATCH}")
    pairs = through_table(one_side.select(F.col("sig_a").alias("a"), F.col("sig_b").alias("b")).distinct(), "line-pairs")
    later = _later(text, sets, pairs)

    open_ones = members.join(later, "sig", "left_anti")
    others = _side(open_ones, "b").join(_side(members, "a"), "key").where(f"sig_a != sig_b and {_MAY_MATCH}")
    others = others.select(F.least("sig_a", "sig_b").alias("a"), F.greatest("sig_a", "sig_b").alias("b")).distinct()
    done = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = through_table(others.join(done, ["a", "b"], "left_anti"), "line-pairs")
    discard(members, pairs)
    if not rest.isEmpty():
        later = later.unionByName(_later(text, sets, rest)).distinct()

    judged = sets.select("sig", "sig2", "first", "copies").join(later.withColumn("gone", F.lit(True)), "sig", "left")
    judged = judged.where("copies > 1 or gone")
    places = lines.select("doc_id", "th", "at", "sig", "sig2").join(judged, ["sig", "sig2"])
    gone = places.where(F.coalesce("gone", F.lit(False)) | (F.struct("doc_id", "th", "at") > F.col("first")))
    gone = through_table(gone.groupBy("doc_id", "th").agg(F.collect_set("at").alias("at")), "lines-gone")
    discard(rest, sets, lines)
    return gone


def _free(columns: list[str], *names: str) -> list[str]:
    """The names with as many _ before them as they need to differ from ``columns``."""
    out = []
    for name in names:
        while name.lower() in (c.lower() for c in columns):
            name = f"_{name}"
        out.append(name)
    return out


def with_kept_text(docs: DataFrame) -> tuple[DataFrame, str, str, str]:
    """``docs`` with three more columns and their names: the text that is kept, how many lines it had, how many went."""
    kept, total, went, mark, doc, at, parts = _free(docs.columns, "kept", "total", "went", "mark", "doc", "at", "parts")
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    gone = removed_lines(text.where("text is not null").withColumn("th", F.xxhash64("text")))
    gone = gone.select(F.col("doc_id").alias(doc), F.col("th").alias(mark), F.col("at").alias(at))
    whole = F.col("text").cast("string")
    both = docs.join(gone, (F.xxhash64(docs["text"].cast("string")) == gone[mark]) & docs["doc_id"].cast("long").eqNullSafe(gone[doc]), "left")
    both = both.withColumn(parts, F.split(whole, "\n"))
    stays = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col(at))
    rest = F.array_join(F.transform(stays, lambda i: F.get(F.col(parts), i)), "\n")
    both = both.withColumn(kept, F.when(F.col(at).isNull(), whole).otherwise(rest))
    both = both.withColumn(total, F.coalesce(F.when(whole.isNotNull(), F.size(parts)), F.lit(0)).cast("long"))
    both = both.withColumn(went, F.coalesce(F.when(F.col(at).isNotNull(), F.size(at)), F.lit(0)).cast("long"))
    return both.drop(mark, doc, at, parts), kept, total, went


def line_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed and the text that is left, of every document."""
    out, kept, total, went = with_kept_text(docs.select("doc_id", "text"))
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(total).alias("n_lines"), F.col(went).alias("n_removed"), F.col(kept).alias("text"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated lines taken out of text; documents of whose words nothing is left go."""
    out, kept, _, went = with_kept_text(docs)
    left = out.where((F.col(went) == 0) | F.col(kept).rlike(r"[^ \t-\r]"))
    changed = {"text": F.col(kept)}
    if "n_chars" in docs.columns:
        length = F.when(F.col(went) > 0, F.length(kept)).otherwise(F.col("n_chars"))
        changed["n_chars"] = length.cast(docs.schema["n_chars"].dataType)
    return left.select(*(changed.get(c, F.col(c)).alias(c) for c in docs.columns))
