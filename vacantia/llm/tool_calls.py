"""Tool calls of conversations: linked to their results, validated, ordered and written as canonical JSON.

By DataFrame functions alone. A message is (conv_id, turn, role, text).

- An assistant message that is a JSON object with ``tool_calls`` (objects with id, name, arguments) makes its calls; a
  message of role tool that is a JSON object with ``tool_call_id`` and ``content`` is a result.
- In a plain conversation an exchange is read as a call: a user message calls ``reply`` with its text, under an identifier
  made of conversation and turn; the assistant message of the next turn is the result; the call comes after the one two
  turns before, if there is one.

Calls and results are hash-joined by (conv_id, identifier). A call depends on the calls that its arguments name in
``"$ref": "id"`` members, and on the one it comes after. Its level is 0 without dependencies, else one more than the
highest of theirs (calls on a cycle, or behind one, have no level). (level, turn, place) is a topological order of
a conversation's calls. Arguments are validated against SCHEMAS: unknown names, missing or unknown members, wrong types
and lengths out of bounds are errors. Canonical JSON has sorted keys at every depth, no spaces, and no absent members.

Rows without conv_id or turn, or of unknown roles, make nothing. A null or empty text is an empty plain text. Equal rows
count once. Of several results for an identifier the first (turn, content) counts, the others give rows of status surplus
with an error; calls that share one are all kept, with an error. A result without a call gives a row of status orphan, and
so does a tool message without an identifier (or that is not JSON), with an error. Nothing is gathered by conversation, so
its size does not matter. Very long texts are read whole. Extra columns are not read. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import discard, through_table

#: name: {member: (type, required, least length or value, largest)}
SCHEMAS = {
    "reply": {"n_chars": ("integer", True, 1, None), "text": ("string", True, 1, 400)},
    "search": {"limit": ("integer", False, 1, 100), "query": ("string", True, 1, 1000)},
    "fetch": {"timeout": ("number", False, 0, 600), "url": ("string", True, 8, 2000)},
    "calculate": {"expression": ("string", True, 1, 500), "values": ("array", False, None, None)},
}
#: Names that variant types have here.
_TYPES = {"string": "STRING", "integer": "BIGINT", "number": "BIGINT|DOUBLE|FLOAT|DECIMAL.*", "boolean": "BOOLEAN", "array": "ARRAY.*", "object": "OBJECT.*"}
CALLS_SCHEMA = "struct<tool_calls: array<struct<id: string, name: string, arguments: string>>>"
RESULT_SCHEMA = "struct<tool_call_id: string, content: string>"


def plain_id(conv: str, turn: str) -> Column:
    return F.concat(F.lit("c"), F.col(conv).cast("string"), F.lit("-"), F.expr(turn).cast("string"))


def parse(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls (conv_id, turn, place, call_id, name, arguments, after) and results (conv_id, turn, call_id, content)."""
    rows = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.lower("role").alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).where("conv_id is not null and turn is not null").distinct()
    rows = rows.withColumn("tool_calls", F.when((F.col("role") == "assistant") & F.col("text").rlike(r"^\s*\{"), F.from_json("text", CALLS_SCHEMA)["tool_calls"]))
    plain = F.col("tool_calls").isNull()
    listed = rows.where(~plain).select("conv_id", "turn", F.posexplode("tool_calls").alias("place", "c")).select("conv_id", "turn", "place", "c.id", "c.name", "c.arguments").select("conv_id", "turn", "place", F.col("id").alias("call_id"), "name", "arguments", F.lit(None).cast("string").alias("after"))
    asked = rows.where("role = 'user'").select("conv_id", "turn", F.lit(0).alias("place"), plain_id("conv_id", "turn").alias("call_id"), F.lit("reply").alias("name"), F.to_json(F.struct(F.length("text").alias("n_chars"), "text")).alias("arguments"), plain_id("conv_id", "turn - 2").alias("after"))
    given = rows.where("role = 'tool'").withColumn("r", F.from_json("text", RESULT_SCHEMA)).select("conv_id", "turn", F.col("r.tool_call_id").alias("call_id"), F.col("r.content").alias("content"))
    said = rows.where((F.col("role") == "assistant") & plain).select("conv_id", "turn", plain_id("conv_id", "turn - 1").alias("call_id"), F.col("text").alias("content"))
    return listed.unionByName(asked), given.unionByName(said)


def errors_of(name: str, arguments: str) -> Column:
    """What is wrong with the arguments, as an array of strings in a fixed order."""
    tree = F.try_parse_json(F.col(arguments))
    kind = F.schema_of_variant(tree)
    found = F.when(tree.isNull(), F.array(F.lit("arguments: not JSON"))).when(~kind.rlike("^OBJECT"), F.array(F.lit("arguments: not an object")))
    for call, members in SCHEMAS.items():
        wrong = []
        for member, (want, required, least, most) in members.items():
            value = F.try_variant_get(tree, f"$.{member}", "variant")
            of = F.schema_of_variant(value)
            size = F.length(F.try_variant_get(tree, f"$.{member}", "string")) if want == "string" else F.try_variant_get(tree, f"$.{member}", "double")
            bad = F.when(value.isNull(), F.lit(f"{member}: missing") if required else F.lit(None)).when(~of.rlike(f"^({_TYPES[want]})$"), F.lit(f"{member}: not {want}"))
            if least is not None:
                bad = bad.when(size < least, F.lit(f"{member}: below {least}"))
            if most is not None:
                bad = bad.when(size > most, F.lit(f"{member}: above {most}"))
            wrong.append(bad)
        extra = F.array_sort(F.array_except(F.coalesce(F.json_object_keys(arguments), F.array().cast("array<string>")), F.array(*map(F.lit, members))))
        found = found.when(F.col(name) == call, F.concat(F.array_compact(F.array(*wrong)), F.transform(extra, lambda k: F.concat(k, F.lit(": unknown")))))
    return found.otherwise(F.array(F.concat(F.lit("name: unknown "), F.coalesce(F.col(name), F.lit("null")))))


#: Calls are put together over twice the way as long as that takes no more rows than so many for each link.
WORK = 16
_KEY = ["conv_id", "call_id"]


def levels(calls: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(conv_id, call_id, level) of the calls with an identifier; calls on or behind a cycle are left out.

    The latest of the earlier calls that a call needs is its stem; stems make trees. A need that stands further up the
    same tree is no longer than the way by the stems and goes. Where nothing else is left, levels are depths in the trees;
    otherwise they are longest ways over the stems and the needs that are left. Both come from tables of the calls that
    are 1, 2, 4, ... needs apart, so that rounds grow with the logarithm of the levels. Columns ``by`` tell which calls are
    earlier, then identifiers do, shorter ones first; any order gives the same levels.
    """
    named = calls.where("call_id is not null")
    nodes = named.groupBy(*_KEY).agg(F.min(F.struct(*by, F.length("call_id").alias("size"), "call_id")).alias("first"))
    refs = F.regexp_extract_all("arguments", F.lit(r'"\$ref"\s*:\s*"((?:[^"\\]|\\.)*)"'), F.lit(1))
    needs = F.concat(F.coalesce(refs, F.array().cast("array<string>")), F.array_compact(F.array("after")))
    wanted = named.select(*_KEY, F.explode(needs).alias("needs")).distinct()
    asked = nodes.select("conv_id", F.col("call_id").alias("needs"), F.col("first").alias("asked"))
    placed = wanted.join(asked, ["conv_id", "needs"]).join(nodes, _KEY)
    edges = through_table(placed.select(*_KEY, "needs", "asked", (F.col("asked") < F.col("first")).alias("earlier")), "call-edges")
    stems = edges.where("earlier").groupBy(*_KEY).agg(F.max("asked").alias("stem"))
    stems = through_table(stems.select(*_KEY, F.col("stem.call_id").alias("needs")), "call-stems")
    ups = _doubled(stems)
    depths = through_table(_depths(nodes, ups), "call-depths")
    others = edges.join(stems, [*_KEY, "needs"], "left_anti").select(*_KEY, "needs")
    left = through_table(_off_stems(others, depths, ups), "call-needs")
    if left.isEmpty():
        discard(edges, left, *ups)
        return depths
    ways = _doubled(through_table(stems.unionByName(left), "call-links"))
    discard(edges, left, *ups)
    return _longest(depths.select(*_KEY), ways)


def _doubled(links: DataFrame) -> list[DataFrame]:
    """Tables of the calls (conv_id, call_id, needs) that are 1, 2, 4, ... needs apart, by any way of so many.

    The last one is empty, unless there are cycles (no way without one is as long as all links are many) or the next one
    would take more than WORK rows for each link to make.
    """
    ways, size = [links], links.count()
    while not ways[-1].isEmpty() and 1 << (len(ways) - 1) <= size:
        at = ways[-1]
        into = at.groupBy("conv_id", F.col("needs").alias("call_id")).agg(F.count(F.lit(1)).alias("n"))
        rows = at.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("k")).join(into, _KEY).agg(F.sum(F.col("n") * F.col("k"))).first()[0]
        if (rows or 0) > WORK * size:
            break
        on = at.select("conv_id", F.col("call_id").alias("needs"), F.col("needs").alias("further"))
        ways.append(through_table(at.join(on, ["conv_id", "needs"]).select(*_KEY, F.col("further").alias("needs")).distinct(), "call-ways"))
    return ways


def _depths(nodes: DataFrame, ups: list[DataFrame]) -> DataFrame:
    """The depths of all calls in the trees: each goes up by the largest steps that there are."""
    state = nodes.select(*_KEY, F.col("call_id").alias("at"), F.lit(0).alias("level"))
    for k in reversed(range(len(ups))):
        up = ups[k].select("conv_id", F.col("call_id").alias("at"), F.col("needs").alias("up"))
        more = F.when(F.col("up").isNotNull(), 1 << k).otherwise(0)
        state = state.join(up, ["conv_id", "at"], "left").select(*_KEY, F.coalesce("up", "at").alias("at"), (F.col("level") + more).alias("level"))
    return state.select(*_KEY, "level")


def _off_stems(others: DataFrame, depths: DataFrame, ups: list[DataFrame]) -> DataFrame:
    """Those of the needs that do not stand further up in the tree of the call: its ancestor at their depth is another."""
    below = depths.select("conv_id", F.col("call_id").alias("needs"), F.col("level").alias("low"))
    state = others.join(depths, _KEY).join(below, ["conv_id", "needs"])
    state = state.select(*_KEY, "needs", F.col("call_id").alias("at"), (F.col("level") - F.col("low")).alias("rise"))
    for k, table in enumerate(ups):
        up = table.select("conv_id", F.col("call_id").alias("at"), F.col("needs").alias("up"))
        goes = F.col("rise").bitwiseAND(F.lit(1 << k)) != 0
        state = state.join(up, ["conv_id", "at"], "left").select(*_KEY, "needs", F.when(goes, F.col("up")).otherwise(F.col("at")).alias("at"), "rise")
    return state.where("rise <= 0 or not at <=> needs").select(*_KEY, "needs")


def _longest(nodes: DataFrame, ways: list[DataFrame]) -> DataFrame:
    """The levels of ``nodes``, from _doubled() tables of what they need.

    A call with a way of 2^k needs and none of 2^(k+1) is 2^k above the highest of the calls at the ends of these ways,
    which are all below 2^k.
    """
    known = through_table(nodes.join(ways[0].select(*_KEY).distinct(), _KEY, "left_anti").withColumn("level", F.lit(0)), "call-levels")
    for k, (table, longer) in enumerate(zip(ways, ways[1:])):
        here = table.join(longer.select(*_KEY).distinct(), _KEY, "left_anti")
        base = known.select("conv_id", F.col("call_id").alias("needs"), "level")
        new = here.join(base, ["conv_id", "needs"]).groupBy(*_KEY).agg((F.max("level") + (1 << k)).alias("level"))
        last, known = known, through_table(known.unionByName(new), "call-levels")
        discard(last)
    size, step = ways[0].count(), 1 << (len(ways) - 1)
    if step <= size and not ways[-1].isEmpty():  # the rest is too dense to double further
        known = known.unionByName(_peeled(ways[-1], step, known))
    discard(*ways[:-1])
    return known


def _peeled(table: DataFrame, step: int, known: DataFrame) -> DataFrame:
    """The levels of the calls of ``table``, ``step`` above the highest of the calls there, round by round."""
    edges = through_table(table.withColumn("level", F.lit(None).cast("int")), "call-edges")
    found = [edges.select(*_KEY, "level").limit(0)]
    while not edges.isEmpty():
        base = known.select("conv_id", F.col("call_id").alias("needs"), F.col("level").alias("base"))
        filled = edges.join(base, ["conv_id", "needs"], "left").withColumn("level", F.coalesce("level", F.col("base") + step)).drop("base")
        filled = through_table(filled, "call-edges")
        judged = filled.groupBy(*_KEY).agg(F.max("level").alias("level"), F.count_if(F.col("level").isNull()).alias("open"))
        known = through_table(judged.where("open = 0").select(*_KEY, "level"), "call-levels")
        if known.isEmpty():
            break
        found.append(known)
        discard(edges)
        edges = through_table(filled.join(known.select(*_KEY), _KEY, "left_anti"), "call-edges")
        discard(filled)
    return reduce(DataFrame.unionByName, found)


def link(messages: DataFrame) -> DataFrame:
    """A row for each call, and for each result that no call takes: identifiers, status, level, errors, canonical JSON."""
    key = ["conv_id", "call_id"]
    calls, results = parse(messages)
    calls, results = through_table(calls, "calls"), through_table(results, "results")
    first = results.where("call_id is not null").groupBy(*key).agg(F.min(F.struct(F.col("turn").alias("result_turn"), F.col("content").alias("result"))).alias("r")).select(*key, "r.*")
    named = calls.where("call_id is not null")
    often = named.groupBy(*key).agg(F.count(F.lit(1)).alias("times"))
    known = named.join(often.hint("shuffle_hash"), key).join(levels(calls, ("turn", "place")).hint("shuffle_hash"), key, "left").join(first.hint("shuffle_hash"), key, "left")
    blank = calls.where("call_id is null").select("*", F.lit(1).alias("times"), F.lit(None).cast("int").alias("level"), F.lit(None).cast("long").alias("result_turn"), F.lit(None).cast("string").alias("result"))
    rows = known.unionByName(blank)
    status = F.when(F.col("call_id").isNull(), "unnamed").when(F.col("result_turn").isNull(), "unanswered").when(F.col("level").isNull(), "cyclic").otherwise("answered")
    wrong = F.concat(F.when(F.col("times") > 1, F.array(F.lit("call_id: repeated"))).otherwise(F.array().cast("array<string>")), errors_of("name", "arguments"))
    rows = rows.withColumn("status", status).withColumn("errors", F.array_join(wrong, "; ")).withColumn("tidy", F.coalesce(F.to_json(F.try_parse_json("arguments")), F.lit("null")))
    rest = F.to_json(F.struct("call_id", "conv_id", "level", "name", "result", "result_turn", "status", "turn"))
    rows = rows.withColumn("json", F.concat(F.lit('{"arguments":'), "tidy", F.lit(","), F.substr(rest, F.lit(2))))
    out = ["conv_id", "turn", "place", "call_id", "name", "status", "level", "result_turn", "errors", "json"]
    return rows.select(*out).unionByName(_untaken(results, first, named).select(*out))


def _untaken(results: DataFrame, first: DataFrame, named: DataFrame) -> DataFrame:
    """Rows for the results without a call, without an identifier, and behind the first for theirs."""
    key = ["conv_id", "call_id"]
    given = results.select("conv_id", "call_id", F.col("turn").alias("result_turn"), F.col("content").alias("result"))
    lost = first.join(named.select(*key).distinct(), key, "left_anti").withColumn("status", F.lit("orphan"))
    lost = lost.unionByName(given.where("call_id is null").withColumn("status", F.lit("orphan")))
    again = given.where("call_id is not null").join(first.withColumnsRenamed({"result_turn": "first_turn", "result": "first_result"}), key)
    again = again.where("result_turn != first_turn or not result <=> first_result").select(*given.columns).withColumn("status", F.lit("surplus"))
    rows = lost.unionByName(again)
    return rows.select(
        "conv_id", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("int").alias("place"), "call_id", F.lit(None).cast("string").alias("name"), "status", F.lit(None).cast("int").alias("level"), "result_turn",
        F.when(F.col("status") == "surplus", "call_id: answered before").when(F.col("call_id").isNull(), "call_id: missing").otherwise("").alias("errors"), F.to_json(F.struct("call_id", "conv_id", "result", "result_turn", "status")).alias("json"),
    )
