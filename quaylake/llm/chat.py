"""Chat formatting: tool calls linked to results, ordered, validated, serialised.

``format_calls`` takes calls (conversation, id, tool name, arguments as JSON
text, turn, id of the call they depend on) and results (call id, content,
turn):

* results are hash-joined to calls by identifier; both sides are first reduced
  to one row per identifier, so neither repeated calls nor repeated results
  multiply rows;
* the level of a call in the topological order is the length of its chain of
  dependencies, found by pointer doubling (as many rounds as the logarithm of
  the longest chain); a call whose chain never ends lies on or behind a cycle;
* arguments are checked against the schema of their tool;
* each call becomes one canonical JSON text: keys in order, no blanks.

Only DataFrame expressions are used. Each call is a row of its own; nothing is
gathered per conversation, so a conversation may hold any share of all rows.

Every row of the inputs is in the result, and ``n_rows`` tells how many each row
stands for. Of repeated identifiers the first call (by turn, then content) and
the first result are linked; each other text of them is a row of status
``repeat``. Calls and results without an identifier are ``unlinked``; turns that are
neither are ``context``.

Defined cases: a result without a call has status ``orphan`` and no tool; a call
without a result ``pending``; equal rows are one row with their number; a
dependency on an unknown call is no dependency; NULL or malformed arguments are
an error of the call, not of the job; unknown tools and arguments are errors of
the call. Empty tables give no rows of their kind, texts may be of any length,
and columns other than those named are not read, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaylake.llm.common import only, stored


@dataclass(frozen=True)
class Argument:
    """Schema of one argument; ``kind``: string, integer, number or boolean."""

    name: str
    kind: str
    required: bool = True
    minimum: float | None = None
    maximum: float | None = None
    max_length: int | None = None


@dataclass(frozen=True)
class Tool:
    name: str
    arguments: tuple[Argument, ...]


_IS_KIND = {"string": "^STRING$", "integer": "^BIGINT$", "number": "^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$", "boolean": "^BOOLEAN$"}


def _distinct(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    """Distinct rows with their number ``_copies``, stored."""
    return stored(df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies")), name)


def _first_by_id(distinct: DataFrame, key: str, columns: list[str], count: str) -> DataFrame:
    """One row per key: the smallest (columns) struct with its ``_copies``, and how many
    rows there were."""
    row = F.struct(*columns)
    one = distinct.filter(F.col(key).isNotNull()).groupBy(key)
    one = one.agg(F.min(F.struct(row.alias("row"), "_copies")).alias("_one"), F.sum("_copies").alias(count))
    return one.select(key, *[F.col("_one.row")[c].alias(c) for c in columns], F.col("_one._copies").alias("_copies"), count)


def _others(distinct: DataFrame, firsts: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The distinct rows that are not the first of their key, and those without one,
    with their ``status``."""
    first = firsts.select(F.col(key).alias("_key"), F.struct(*columns).alias("_first"))
    again = distinct.join(first, F.col(key) == F.col("_key")).filter(~F.struct(*columns).eqNullSafe(F.col("_first")))
    again = again.select(*distinct.columns, F.lit("repeat").alias("status"))
    return again.unionByName(distinct.filter(F.col(key).isNull()).withColumn("status", F.lit("unlinked")))


def levels(calls: DataFrame) -> DataFrame:
    """``call_id`` and ``level`` (number of calls before it in its chain; NULL on or
    behind a cycle) of calls with unique ``call_id`` and a ``parent_id``."""
    ids = calls.select(F.col("call_id").alias("_known"))
    state = (
        calls.select("call_id", "parent_id")
        .join(ids, F.col("parent_id") == F.col("_known"), "left")
        .select("call_id", F.col("_known").alias("ahead"), F.when(F.col("_known").isNull(), 0).otherwise(1).cast("long").alias("steps"))
    )
    total = calls.count()
    state = stored(state, "chat-levels", total)
    left = state.filter("ahead IS NOT NULL").count()
    for _ in range(max(total, 1).bit_length() + 1):
        if not left:
            break
        jump = state.select(F.col("call_id").alias("_at"), F.col("ahead").alias("_ahead"), F.col("steps").alias("_steps"))
        moved = state.filter("ahead IS NOT NULL").join(jump, F.col("ahead") == F.col("_at"))
        moved = moved.select("call_id", F.col("_ahead").alias("ahead"), (F.col("steps") + F.col("_steps")).alias("steps"))
        state = stored(state.filter("ahead IS NULL").unionByName(moved), "chat-levels", total)
        left = state.filter("ahead IS NOT NULL").count()
    return state.select("call_id", F.when(F.col("ahead").isNull(), F.col("steps")).alias("level"))


def _argument_errors(spec: Argument, parsed: Column) -> list[Column]:
    path = f"$['{spec.name}']"
    value = F.try_variant_get(parsed, path, "variant")
    kind = F.schema_of_variant(value)
    missing = value.isNull() | (kind == "VOID")
    fits = kind.rlike(_IS_KIND[spec.kind])
    out = [F.when(~missing & ~fits, f"{spec.name}: not of kind {spec.kind}")]
    if spec.required:
        out.append(F.when(missing, f"{spec.name}: missing"))
    number = F.try_variant_get(parsed, path, "double")
    if spec.minimum is not None:
        out.append(F.when(fits & (number < spec.minimum), f"{spec.name}: below {spec.minimum:g}"))
    if spec.maximum is not None:
        out.append(F.when(fits & (number > spec.maximum), f"{spec.name}: above {spec.maximum:g}"))
    if spec.max_length is not None:
        length = F.length(F.try_variant_get(parsed, path, "string"))
        out.append(F.when(fits & (length > spec.max_length), f"{spec.name}: longer than {spec.max_length}"))
    return out


def errors(name: Column, arguments: Column, tools: list[Tool]) -> Column:
    """Array of texts: what is wrong with the arguments of a call."""
    parsed = F.try_parse_json(arguments)
    is_object = F.schema_of_variant(parsed).startswith("OBJECT")
    # the first case that applies decides
    chosen = F.when(arguments.isNull(), F.array(F.lit("arguments: missing")))
    chosen = chosen.when(parsed.isNull(), F.array(F.lit("arguments: not JSON")))
    chosen = chosen.when(~is_object, F.array(F.lit("arguments: not an object")))
    for tool in tools:
        known = F.lit([a.name for a in tool.arguments]) if tool.arguments else F.array().cast("array<string>")
        unknown = F.array_sort(F.array_except(F.json_object_keys(arguments), known))
        found = [e for a in tool.arguments for e in _argument_errors(a, parsed)]
        found = F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")
        extra = F.transform(unknown, lambda u: F.concat(u, F.lit(": unknown")))
        chosen = chosen.when(name == tool.name, F.concat(found, extra))
    return chosen.otherwise(F.array(F.lit("tool: unknown")))


def canonical_json(value: Column) -> Column:
    """JSON text with the keys of all objects in order and without blanks."""
    return F.to_json(F.parse_json(value))


_CALL = ["turn", "conv_id", "name", "arguments", "parent_id"]
_RESULT = ["turn", "content"]


def format_calls(calls: DataFrame, results: DataFrame, tools: list[Tool], context: DataFrame | None = None) -> DataFrame:
    """One row per call identifier (and per identifier that only results have), and one
    per other text (see above).

    calls: conv_id, call_id, name, arguments, turn, parent_id; results: call_id,
    content, turn; context: conv_id, role, content, turn. Further columns are
    ignored. Returns conv_id, call_id, name, level, status, valid, errors, n_calls,
    n_results, json and n_rows; rows of context have their role as name.
    """
    calls = _distinct(only(calls, "conv_id", "call_id", "name", "arguments", "turn", "parent_id"), ["call_id", *_CALL], "chat-distinct-calls")
    results = _distinct(only(results, "call_id", "content", "turn"), ["call_id", *_RESULT], "chat-distinct-results")
    one_call = stored(_first_by_id(calls, "call_id", _CALL, "n_calls"), "chat-calls")
    one_result = stored(_first_by_id(results, "call_id", _RESULT, "n_results"), "chat-results")
    answered = one_result.select("call_id", "content", F.col("_copies").alias("_answers"), "n_results")
    ordered = one_call.join(levels(one_call), "call_id", "left").withColumn("_call", F.lit(True))
    linked = ordered.join(answered, "call_id", "full")
    is_call = F.col("_call").isNotNull()
    status = (
        F.when(~is_call, "orphan")
        .when(F.col("level").isNull(), "cycle")
        .when(F.col("n_results").isNull(), "pending")
        .otherwise("linked")
    )
    zero = F.lit(0).cast("long")
    wrong = F.when(is_call, errors(F.col("name"), F.col("arguments"), tools)).otherwise(F.array(F.lit("call: missing")))
    shape = ["conv_id", "call_id", "name", "arguments", "content", "level", "status", "errors", "n_calls", "n_results", "n_rows"]
    main = linked.withColumns(
        {
            "status": status,
            "errors": wrong,
            "n_calls": F.coalesce("n_calls", zero),
            "n_results": F.coalesce("n_results", zero),
            "n_rows": F.coalesce("_copies", zero) + F.coalesce("_answers", zero),
        }
    ).select(*shape)
    none, level = F.lit(None).cast("string"), F.lit(None).cast("long").alias("level")
    more_calls = _others(calls, one_call, "call_id", _CALL).select(
        "conv_id", "call_id", "name", "arguments", none.alias("content"), level, "status",
        errors(F.col("name"), F.col("arguments"), tools).alias("errors"),
        F.col("_copies").alias("n_calls"), zero.alias("n_results"), F.col("_copies").alias("n_rows"),
    )
    no_conversation = F.lit(None).cast(main.schema["conv_id"].dataType).alias("conv_id")
    right = F.array().cast("array<string>").alias("errors")
    more_results = _others(results, one_result, "call_id", _RESULT).select(
        no_conversation, "call_id", none.alias("name"), none.alias("arguments"), "content", level, "status",
        right, zero.alias("n_calls"), F.col("_copies").alias("n_results"), F.col("_copies").alias("n_rows"),
    )
    found = main.unionByName(more_calls).unionByName(more_results)
    if context is not None:
        turns = only(context, "conv_id", "role", "content", "turn")
        turns = turns.groupBy("conv_id", "role", "content", "turn").agg(F.count(F.lit(1)).alias("n_rows"))
        found = found.unionByName(
            turns.select(
                "conv_id", identifier(F.col("conv_id"), F.col("turn")).alias("call_id"), F.col("role").alias("name"), none.alias("arguments"),
                "content", level, F.lit("context").alias("status"), right, zero.alias("n_calls"), zero.alias("n_results"), "n_rows",
            )
        )
    text = F.to_json(
        F.struct(
            F.try_parse_json("arguments").alias("arguments"),
            "errors",
            F.col("call_id").alias("id"),
            "level",
            "name",
            F.col("content").alias("result"),
            "status",
        ),
        {"ignoreNullFields": "false"},
    )
    return found.select(
        "conv_id",
        "call_id",
        "name",
        "level",
        "status",
        (F.size("errors") == 0).alias("valid"),
        F.concat_ws("; ", "errors").alias("errors"),
        "n_calls",
        "n_results",
        canonical_json(text).alias("json"),
        "n_rows",
    )


def identifier(conv_id: Column, turn: Column) -> Column:
    """``conversation:turn``, NULL where one of them is."""
    return F.concat(conv_id.cast("string"), F.lit(":"), turn.cast("string"))


# ------------------------------------------------ calls that a plain conversation holds
#: every user turn asks for a reply; its arguments are checked against these
REPLY_TOOLS = [
    Tool(
        "reply",
        (
            Argument("chars", "integer", minimum=40),
            Argument("prompt", "string", max_length=400),
            Argument("turn", "integer", minimum=0),
        ),
    )
]


def conversation_calls(conversations: DataFrame) -> DataFrame:
    """A call per user turn: it depends on the call of the exchange before."""
    turn = F.col("turn")
    arguments = F.to_json(
        F.struct(turn, F.col("text").alias("prompt"), F.length("text").alias("chars")), {"ignoreNullFields": "false"}
    )
    return conversations.filter("role = 'user'").select(
        "conv_id",
        identifier(F.col("conv_id"), turn).alias("call_id"),
        F.lit("reply").alias("name"),
        arguments.alias("arguments"),
        "turn",
        identifier(F.col("conv_id"), turn - 2).alias("parent_id"),
    )


def conversation_results(conversations: DataFrame) -> DataFrame:
    """A result per assistant turn: it answers the turn before."""
    answers = identifier(F.col("conv_id"), F.col("turn") - 1)
    return conversations.filter("role = 'assistant'").select(answers.alias("call_id"), F.col("text").alias("content"), "turn")


def conversation_context(conversations: DataFrame) -> DataFrame:
    """Turns of all other roles, or of none."""
    other = F.coalesce(~F.col("role").isin("user", "assistant"), F.lit(True))
    return conversations.filter(other).select("conv_id", "role", F.col("text").alias("content"), "turn")
