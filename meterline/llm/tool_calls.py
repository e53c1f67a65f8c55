"""Tool calls and results: linked by identifier, ordered topologically, validated, as canonical JSON.

* *Link.* Calls and results are joined on (conversation, call id): a call is ``answered`` or
  ``unanswered``, a result ``linked`` or an ``orphan``.
* *Order.* A call may wait for another call of its conversation (``after``); a result follows its
  call. ``place`` is the greatest turn along the chain a call waits for and ``level`` the length
  of that chain (doubled, and one more for a result): ordering by (place, level, turn) keeps the order of the
  log as far as the dependencies allow. Chains are followed by doubling over written tables, so
  a chain of n calls takes log n rounds; a call in or behind a cycle has no level.
* *Validate.* Arguments must be a JSON object; a schema names each argument's type, whether it is
  required, its bounds or its allowed values. Errors are listed in order of the arguments.
* *Serialise.* JSON with keys in order and no white space; arguments that are no JSON stay text.

Only Spark SQL functions are used. No conversation is collected or ordered in one task: rows
carry their order. Defined cases: null conversation or call ids link to nothing (a call is
unanswered, a result an orphan); repeated calls and results each keep a row, and every
call of an identifier is answered by any result of it; a repeated call waits for every call that one
of its rows waits for, and all its rows have its greatest place and level; a call that waits for an unknown call has
the error "after: unknown call"; null arguments are invalid; null texts are null contents and
left out of the JSON; empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import text_or_empty, words
from meterline.workspace import materialize


@dataclass(frozen=True)
class Argument:
    """``kind`` is string, integer, number or boolean."""

    kind: str
    required: bool = True
    low: int | None = None
    high: int | None = None
    allowed: tuple[str, ...] = ()


LOG = ("conv_id", "turn", "kind", "call_id", "after", "name", "arguments", "content")
Schema = Mapping[str, Argument]
TOOLS: Mapping[str, Schema] = {
    "convert": {"unit": Argument("string", allowed=("char", "word")), "value": Argument("integer", low=0)},
    "lookup": {"key": Argument("string"), "strict": Argument("boolean", required=False)},
    "search": {"limit": Argument("integer", low=1, high=50), "query": Argument("string")},
}
_TYPES = {
    "string": r"^STRING$", "integer": r"^(BIGINT|DECIMAL\([0-9]+,0\))$", "number": r"^(BIGINT|DOUBLE|DECIMAL\([0-9]+,[0-9]+\))$",
    "boolean": r"^BOOLEAN$",
}


def derive(conversations: DataFrame) -> DataFrame:
    """Read plain conversations as a tool log: conv_id, turn, kind, call_id, after, name, arguments, content.

    The tables hold no tool calls, so an assistant's turn is read as a call and the user's turn
    after it as its result. The length of the text (L) picks the tool and its arguments, some of
    them invalid: ``search`` (L mod 3 = 0) for the first word with limit words mod 7; ``convert``
    (1) of L; ``lookup`` (2), without a key where 5 divides L. A call of even L waits for the
    assistant's previous turn, if there was one.
    """
    length = F.length(text_or_empty("text"))
    found = words(text_or_empty("text"))
    call_id = lambda turn: F.concat(F.lit("call-"), F.col("conv_id").cast("string"), F.lit("-"), turn.cast("string"))
    quoted = F.to_json(F.struct(F.coalesce(F.get(found, F.lit(0)), F.lit("")).alias("query")))
    search = F.concat(F.expr("substring(q, 1, length(q) - 1)"), F.lit(', "limit" : '), (F.size(found) % 7).cast("string"), F.lit("}"))
    convert = F.concat(F.lit('{ "value":'), length.cast("string"), F.lit(', "unit" : "char" }'))
    strict = F.when(length % 2 == 0, "true").otherwise("false")
    key = F.when(length % 5 == 0, F.lit("")).otherwise(F.concat(F.lit(', "key": "turn-'), F.col("turn").cast("string"), F.lit('"')))
    lookup = F.concat(F.lit('{"strict": '), strict, key, F.lit("}"))
    kind = F.when(F.col("role") == "assistant", "call").when((F.col("role") == "user") & (F.col("turn") > 0), "result").otherwise("message")
    is_call = F.col("kind") == "call"
    pick = length % 3
    return conversations.withColumn("q", quoted).withColumn("kind", kind).select(
        "conv_id", "turn", "kind",
        F.when(is_call, call_id(F.col("turn"))).when(F.col("kind") == "result", call_id(F.col("turn") - 1)).alias("call_id"),
        F.when(is_call & (length % 2 == 0) & (F.col("turn") >= 3), call_id(F.col("turn") - 2)).alias("after"),
        F.when(is_call, F.when(pick == 0, "search").when(pick == 1, "convert").otherwise("lookup")).alias("name"),
        F.when(is_call, F.when(pick == 0, search).when(pick == 1, convert).otherwise(lookup)).alias("arguments"),
        F.col("text").alias("content"),
    )


def schema_errors(name: Column, arguments: Column, parsed: Column, tools: Mapping[str, Schema] = TOOLS) -> Column:
    """The errors of a call's arguments, in order; ``parsed`` is the variant of ``arguments``."""
    per_tool: Column | None = None
    is_object = F.schema_of_variant(parsed).startswith("OBJECT")
    for tool, schema in sorted(tools.items()):
        checks = []
        for key, rule in sorted(schema.items()):
            value = F.try_variant_get(parsed, f"$['{key}']", "variant")
            kind = F.schema_of_variant(value)
            checks.append(F.when(kind.isNull(), F.lit(f"{key}: missing") if rule.required else F.lit(None))
                          .when(~kind.rlike(_TYPES[rule.kind]), F.lit(f"{key}: not {rule.kind}")))
            typed = kind.rlike(_TYPES[rule.kind])
            if rule.low is not None or rule.high is not None:
                number = F.try_variant_get(parsed, f"$['{key}']", "decimal(38,9)")
                if rule.low is not None:
                    checks.append(F.when(typed & (number < rule.low), F.lit(f"{key}: below {rule.low}")))
                if rule.high is not None:
                    checks.append(F.when(typed & (number > rule.high), F.lit(f"{key}: above {rule.high}")))
            if rule.allowed:
                checks.append(F.when(typed & ~F.try_variant_get(parsed, f"$['{key}']", "string").isin(*rule.allowed), F.lit(f"{key}: not allowed")))
        extra = F.array_sort(F.array_except(F.coalesce(F.json_object_keys(arguments), F.array().cast("array<string>")), F.array(*map(F.lit, sorted(schema)))))
        found = F.concat(F.array_compact(F.array(*checks)), F.transform(extra, lambda key: F.concat(key, F.lit(": unknown"))))
        this = name == tool
        per_tool = F.when(this, found) if per_tool is None else per_tool.when(this, found)
    known = F.array(F.lit("unknown tool")) if per_tool is None else per_tool.otherwise(F.array(F.lit("unknown tool")))
    return F.when(is_object, known).otherwise(F.array(F.lit("arguments: not an object")))


def levels(calls: DataFrame) -> DataFrame:
    """conv_id, call_id, level and place of every call identifier, over all calls its rows wait for.

    Each round doubles the stretch of its chains that a call has seen. A call without an answer
    after as many rounds as double the number of calls waits for itself. A call has one row, and
    where identifiers repeat with different ``after`` one for each call that many steps away.
    """
    key = ("conv_id", "call_id")
    named = calls.filter("conv_id IS NOT NULL AND call_id IS NOT NULL")
    nodes = materialize(named.groupBy(*key).agg(F.max("turn").alias("place")), "calls-nodes")
    known = nodes.select("conv_id", F.col("call_id").alias("jump"))
    waits = named.filter("after IS NOT NULL").select(*key, F.col("after").alias("jump")).distinct().join(known, ["conv_id", "jump"], "left_semi")
    state = materialize(nodes.join(waits, [*key], "left").select(
        *key, "place", "jump", F.when(F.col("jump").isNotNull(), 1).otherwise(0).cast("long").alias("steps")), "calls-state")
    for _ in range(nodes.count().bit_length() + 1):
        waiting = state.filter("jump IS NOT NULL")
        if waiting.isEmpty():
            break
        seen = state.select("conv_id", F.col("call_id").alias("jump"), F.col("place").alias("p"), F.col("jump").alias("j"), F.col("steps").alias("s"))
        moved = waiting.join(seen, ["conv_id", "jump"]).select(
            *key, F.greatest("place", "p").alias("place"), F.col("j").alias("jump"), (F.col("steps") + F.col("s")).alias("steps"))
        # Of the ways between two calls the longest counts, and the greatest turn on any of them.
        ways = state.filter("jump IS NULL").unionByName(moved).groupBy(*key, "jump")
        state = materialize(ways.agg(F.max("place").alias("place"), F.max("steps").alias("steps")), "calls-state")
    return state.groupBy(*key).agg(F.when(F.count("jump") == 0, F.max("steps")).alias("level"), F.max("place").alias("place"))


def link(log: DataFrame, tools: Mapping[str, Schema] = TOOLS) -> DataFrame:
    """One row per row of the log: place, level, turn, kind, call_id, status, errors, valid, json.

    Within a conversation (place, level, turn) is a topological order. Rows that are neither call
    nor result are placed at their turn with level -1.
    """
    key = ["conv_id", "call_id"]
    stored = materialize(log.select(*LOG), "calls-log")
    calls, results = stored.filter("kind = 'call'"), stored.filter("kind = 'result'")
    placed = materialize(levels(calls), "calls-levels")
    answered = materialize(results.filter("call_id IS NOT NULL").select(*key).distinct().withColumn("answered", F.lit(True)), "calls-answered")
    ids = placed.select("conv_id", F.col("call_id").alias("after"), F.lit(True).alias("after_known"))

    parsed = F.try_parse_json("arguments")
    checked = (calls.join(placed, key, "left").join(answered, key, "left").join(ids, ["conv_id", "after"], "left")
               .withColumn("errors", schema_errors(F.col("name"), F.col("arguments"), parsed)))
    lost = F.col("after").isNotNull() & F.col("after_known").isNull()
    errors = F.when(lost, F.array_append("errors", F.lit("after: unknown call"))).otherwise(F.col("errors"))
    of_calls = checked.select(
        "conv_id", F.coalesce("place", "turn").alias("place"), (2 * F.col("level")).alias("level"), "turn", "kind", "call_id",
        F.when(F.col("answered"), "answered").otherwise("unanswered").alias("status"), errors.alias("errors"),
        F.when(parsed.isNotNull(), F.to_json(F.struct(
            F.col("after"), parsed.alias("arguments"), F.col("call_id"), F.col("content"), F.col("name"), F.lit("call").alias("role"),
        ))).otherwise(F.to_json(F.struct(
            F.col("after"), F.col("arguments"), F.col("call_id"), F.col("content"), F.col("name"), F.lit("call").alias("role"),
        ))).alias("json"),
    )
    linked = results.join(placed, key, "left")
    # A call's row in ``placed`` shows that it exists, whether or not it has a level.
    of_results = linked.select(
        "conv_id", F.greatest("turn", F.coalesce("place", "turn")).alias("place"), F.coalesce(2 * F.col("level") + 1, F.when(F.col("place").isNull(), 0)).alias("level"),
        "turn", "kind", "call_id", F.when(F.col("place").isNotNull(), "linked").otherwise("orphan").alias("status"),
        F.array().cast("array<string>").alias("errors"),
        F.to_json(F.struct(F.col("call_id"), F.col("content"), F.lit("result").alias("role"))).alias("json"),
    )
    plain = stored.filter("kind NOT IN ('call', 'result') OR kind IS NULL").select(
        "conv_id", F.col("turn").alias("place"), F.lit(-1).cast("long").alias("level"), "turn", "kind", "call_id", F.lit("plain").alias("status"),
        F.array().cast("array<string>").alias("errors"),
        F.to_json(F.struct(F.col("content"), F.lit("message").alias("role"))).alias("json"),
    )
    return of_calls.unionByName(of_results).unionByName(plain).withColumn("valid", F.size("errors") == 0)
