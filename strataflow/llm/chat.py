"""Chats with tool calls as canonical JSON lines.

Calls and results are linked by a hash join on chat and identifier, messages are put in an order in which
everything comes after what it depends on, arguments are checked against the schemas of the tools, and
each message becomes one line of JSON with sorted keys. Lines carry their place in the chat, so a chat of
any length is written by many tasks. Everything is DataFrame code.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged
from .common import running

#: Tools as ``{name: {argument: (type, required)}}``; types are those of JSON.
Schemas = dict[str, dict[str, tuple[str, bool]]]

_TYPES = {"string": "^STRING$", "integer": "^BIGINT$", "number": r"^(BIGINT|DOUBLE|DECIMAL.*)$", "boolean": "^BOOLEAN$",
          "array": "^ARRAY.*", "object": "^OBJECT.*"}

REFERENCE = r'"\$ref":"((?:[^"\\]|\\.)*)"'  # an argument that stands for the result of another call


def checked(name: Column, arguments: Column, schemas: Schemas) -> Column:
    """Whether arguments are a JSON object that suits the tool: all required ones, no others, of the right types.

    An unknown tool and a null or unreadable argument text are invalid. A JSON null counts as absent.
    """
    parsed = F.try_parse_json(arguments)
    valid = F.lit(False)
    for tool, wanted in schemas.items():
        tests = [F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT<"), F.lit(False))]
        names = F.coalesce(F.json_object_keys(arguments), F.array().cast("array<string>"))
        tests.append(F.size(F.array_except(names, F.array(*[F.lit(n) for n in wanted]).cast("array<string>"))) == 0)
        for argument, (kind, required) in wanted.items():
            value = F.try_variant_get(parsed, f"$['{argument}']", "variant")
            absent = value.isNull() | F.is_variant_null(value)
            found = F.coalesce(F.schema_of_variant(value).rlike(_TYPES[kind]), F.lit(False))
            tests.append(F.when(absent, F.lit(not required)).otherwise(found))
        valid = F.when(name == tool, reduce(Column.__and__, tests)).otherwise(valid)
    return F.coalesce(valid, F.lit(False))


def _link(call_id: str) -> Column:
    """Chat and id as one text; a null chat is a chat of its own."""
    return F.to_json(F.struct(F.col("conv_id"), F.col(call_id).alias("call_id")))


def linked(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Messages with a ``key`` and a ``link``, and the pairs ``key, after`` of what must come after what.

    ``messages``: ``conv_id, turn, kind`` (``message``, ``call`` or ``result``), ``role, text, call_id, name,
    arguments``. Ids hold within a chat: a result belongs to the first call of its id in its chat; further calls of
    an id, and results without a call or without an id, stand alone. Null ids have no link and are in no join.
    """
    link = F.when(F.col("call_id").isNotNull(), _link("call_id"))
    keyed = messages.withColumns({"key": F.monotonically_increasing_id(), "link": link})
    keyed = staged(keyed, "messages")
    calls = keyed.where("kind = 'call' AND link IS NOT NULL")
    first = calls.groupBy("link").agg(F.min(F.struct("turn", "key")).alias("c"))
    first = first.select("link", F.col("c.key").alias("after"))
    results = keyed.where("kind = 'result' AND link IS NOT NULL").select("link", "key")
    pairs = results.hint("shuffle_hash").join(first, "link").select("key", "after")
    # A result that names its call, and a call whose arguments name an earlier result of the chat.
    named = F.explode(F.regexp_extract_all("arguments", F.lit(REFERENCE), 1)).alias("named")
    references = calls.select("key", "conv_id", named).select("key", _link("named").alias("link"))
    answers = results.groupBy("link").agg(F.min("key").alias("after"))
    needs = pairs.unionByName(references.join(answers, "link").select("key", "after"))
    return keyed, staged(needs.distinct(), "needs")


def _chains(single: DataFrame) -> DataFrame:
    """``key, to, best, steps`` of messages that need one other: where their chain ends, by pointer doubling.

    ``single`` has ``key, to, best`` (the message's own turn and depth 0). ``best`` becomes the latest turn of the chain
    with the steps from there, ``steps`` the length of the chain. A chain that runs into a cycle never ends; after as
    many rounds as doubling takes for all messages, those whose ``to`` still needs another are in or behind one.
    """
    chain = staged(single.withColumn("steps", F.lit(1).cast("long")), "chains")
    for _ in range(chain.count().bit_length()):
        on = chain.select(F.col("key").alias("to"), F.col("to").alias("far"), F.col("best").alias("above"), F.col("steps").alias("more"))
        moved = chain.join(on, "to", "left")
        above = F.struct(F.col("above.at").alias("at"), (F.col("above.depth") + F.col("steps")).alias("depth"))
        moved = moved.select(
            "key", F.coalesce("far", "to").alias("to"), F.col("far").isNotNull().alias("moved"),
            F.when(F.col("far").isNull(), F.col("best")).otherwise(F.greatest("best", above)).alias("best"),
            (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
        )
        moved = staged(moved, "chains")
        chain = moved.drop("moved")
        if moved.where("moved").isEmpty():
            break
    return chain


def ordered(keyed: DataFrame, needs: DataFrame) -> DataFrame:
    """``key, at, depth, cyclic``: messages by their turn, moved behind what they need.

    ``at`` is the latest turn among a message's own and those of all it needs, and ``depth`` the number of steps to it
    within that turn. Messages that need one other are drawn together to chains, in as many rounds as the logarithm
    of their number. Messages that need several are settled when all these are: a round for each step of the longest
    row of such messages. What is never settled is in a cycle or behind one and keeps its own turn.
    """
    turns = keyed.select("key", F.coalesce(F.col("turn").cast("double"), F.lit(0.0)).alias("turn"))
    counts = needs.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("after").alias("to"))
    own = F.struct(F.col("turn").alias("at"), F.lit(0).cast("long").alias("depth"))
    nodes = needs.select(F.explode(F.array("key", "after")).alias("key")).distinct().join(turns, "key").join(counts, "key", "left")
    nodes = staged(nodes.select("key", F.coalesce("n", F.lit(0)).alias("n"), "to", own.alias("best")), "nodes")
    chain = _chains(nodes.where("n = 1").select("key", "to", "best"))
    chain = staged(chain.join(nodes.where("n = 1").select(F.col("key").alias("to")), "to", "left_anti"), "chains")

    settled = staged(nodes.where("n = 0").select("key", "best"), "settled")
    several = nodes.where("n > 1").select("key", "n", "best")
    if not several.isEmpty():
        # What each of several needs comes to: the end of its chain, and what the chain itself has.
        ends = needs.join(several.select("key"), "key").join(chain.withColumnsRenamed({"key": "after", "best": "c"}), "after", "left")
        ends = ends.join(nodes.where("n = 1").select(F.col("key").alias("after"), F.lit(True).alias("one")), "after", "left")
        ends = ends.where("one IS NULL OR to IS NOT NULL")  # a chain without an end settles nothing
        ends = staged(ends.select("key", F.coalesce("to", "after").alias("to"), "c", F.coalesce("steps", F.lit(0)).alias("steps")), "ends")
        while True:
            there = ends.join(settled.withColumnsRenamed({"key": "to", "best": "end"}), "to")
            far = F.struct(F.col("end.at").alias("at"), (F.col("end.depth") + F.col("steps") + 1).alias("depth"))
            near = F.struct(F.col("c.at").alias("at"), (F.col("c.depth") + 1).alias("depth"))
            reach = F.when(F.col("c").isNull(), far).otherwise(F.greatest(near, far))
            ready = there.groupBy("key").agg(F.count(F.lit(1)).alias("found"), F.max(reach).alias("reach"))
            ready = several.join(ready, "key").where("found = n").join(settled.select("key"), "key", "left_anti")
            ready = staged(ready.select("key", F.greatest("best", "reach").alias("best")), "settled")
            if ready.isEmpty():
                break
            settled = staged(settled.unionByName(ready), "settled")
    far = F.struct(F.col("end.at").alias("at"), (F.col("end.depth") + F.col("steps")).alias("depth"))
    chained = chain.join(settled.withColumnsRenamed({"key": "to", "best": "end"}), "to").select("key", F.greatest("best", far).alias("best"))
    found = nodes.select("key").join(settled.unionByName(chained), "key", "left")
    out = turns.join(found.withColumn("linked", F.lit(True)), "key", "left")
    return out.select(
        "key", F.coalesce("best.at", "turn").alias("at"), F.coalesce("best.depth", F.lit(0)).alias("depth"),
        (F.col("linked").isNotNull() & F.col("best").isNull()).alias("cyclic"),
    )


def canonical(role: Column, text: Column, kind: Column, call_id: Column, name: Column, arguments: Column) -> Column:
    """One message as JSON without spaces, keys in order; absent fields are left out. Readable arguments become an object."""
    parsed = F.to_json(F.try_parse_json(arguments))
    quoted = lambda c: F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r"(?s)^\{\"v\":(.*)\}$", 1)
    fields = [
        F.when(text.isNotNull(), F.concat(F.lit('"content":'), quoted(text))),
        F.when(role.isNotNull(), F.concat(F.lit('"role":'), quoted(role))),
        F.when((kind == "result") & call_id.isNotNull(), F.concat(F.lit('"tool_call_id":'), quoted(call_id))),
        F.when(
            kind == "call",
            F.concat(
                F.lit('"tool_calls":[{'),
                F.concat_ws(
                    ",",
                    F.when(arguments.isNotNull(), F.concat(F.lit('"arguments":'), F.coalesce(parsed, quoted(arguments)))),
                    F.when(call_id.isNotNull(), F.concat(F.lit('"id":'), quoted(call_id))),
                    F.when(name.isNotNull(), F.concat(F.lit('"name":'), quoted(name))),
                ),
                F.lit("}]"),
            ),
        ),
    ]
    return F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}"))


def formatted(messages: DataFrame, schemas: Schemas) -> DataFrame:
    """For each message: ``conv_id, position, role, kind, call_id, linked, valid, line``.

    ``position`` counts the messages of a chat from 0 in order of turn, moved behind what they need; ties
    go by kind, role, text and id, so only equal messages are interchangeable. ``linked``: a result has a
    call, a call has a result, in the same chat; null for messages. ``valid``: arguments suit the schema; null
    but for calls. Messages in a cycle of needs, or behind one, keep their own turn; a cycle costs no more rounds
    than a chain of its length. Null chat ids are one chat, null turns count as 0. Texts and arguments of any
    length are taken whole. Repeated rows are messages each; an empty table gives no rows. Further columns are
    not read.
    """
    wanted = ["conv_id", "turn", "kind", "role", "text", "call_id", "name", "arguments"]
    keyed, needs = linked(messages.select(*wanted))
    # Messages without an id take no part in the join by link, where they would all meet in one task.
    named = keyed.where("link IS NOT NULL").select("key", "kind", "link")
    both = named.groupBy("link").agg(F.bool_or(F.col("kind") == "result").alias("answered"), F.bool_or(F.col("kind") == "call").alias("called"))
    named = named.join(both, "link", "left").select("key", "answered", "called")
    rows = keyed.join(ordered(keyed, needs), "key").join(named, "key", "left")
    found = F.when(F.col("kind") == "call", F.coalesce("answered", F.lit(False)))
    found = F.when(F.col("kind") == "result", F.coalesce("called", F.lit(False))).otherwise(found)
    valid = F.when(F.col("kind") == "call", checked(F.col("name"), F.col("arguments"), schemas))
    lines = rows.select(
        "key", "conv_id", "at", "depth", "kind", "role", "call_id", found.alias("linked"), valid.alias("valid"),
        canonical(*[F.col(c) for c in ("role", "text", "kind", "call_id", "name", "arguments")]).alias("line"),
    )
    lines = staged(lines, "lines")
    tie = F.xxhash64("line")
    places = running(lines.select("key", "conv_id", "at", "depth", "kind", "role", tie.alias("tie")), ["at", "depth", "kind", "role", "tie"], {}, "conv_id")
    return lines.join(places.select("key", "position"), "key").select(
        "conv_id", "position", "role", "kind", "call_id", "linked", "valid", "line"
    )


#: The tool that :func:`with_calls` calls.
ANSWER: Schemas = {
    "answer": {"after": ("object", False), "limit": ("integer", True), "question": ("string", True)},
}


def with_calls(conversations: DataFrame) -> DataFrame:
    """Chats in which each assistant turn asks a tool and the tool gives the turn's text.

    A call is named after chat and turn. Its arguments have the message before, if there is one, as the question,
    the length of the answer as a limit, and from the second call on a reference to the result of the call before.
    """
    base = conversations.select("conv_id", "turn", "role", "text")
    ask = base.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("question"))
    ask = ask.groupBy("conv_id", "turn").agg(F.min("question").alias("question"))
    earlier = base.where("role = 'assistant'").select("conv_id", (F.col("turn") + 2).alias("turn")).distinct()
    earlier = earlier.withColumn("earlier", F.lit(True))
    turns = base.where("role = 'assistant'").join(ask, ["conv_id", "turn"], "left").join(earlier, ["conv_id", "turn"], "left")
    name = lambda turn: F.concat(F.lit("call_"), F.col("conv_id").cast("string"), F.lit("_"), turn.cast("string"))
    after = F.when(F.col("earlier"), F.struct(name(F.col("turn") - 2).alias("$ref")))
    arguments = F.to_json(F.struct("question", F.length("text").alias("limit"), after.alias("after")))
    empty = F.lit(None).cast("string")
    plain = base.where("role <> 'assistant' OR role IS NULL").select(
        "conv_id", "turn", F.lit("message").alias("kind"), "role", "text", empty.alias("call_id"), empty.alias("name"), empty.alias("arguments")
    )
    calls = turns.select(
        "conv_id", "turn", F.lit("call").alias("kind"), "role", empty.alias("text"), name(F.col("turn")).alias("call_id"),
        F.lit("answer").alias("name"), arguments.alias("arguments"),
    )
    results = turns.select(
        "conv_id", "turn", F.lit("result").alias("kind"), F.lit("tool").alias("role"), "text", name(F.col("turn")).alias("call_id"),
        empty.alias("name"), empty.alias("arguments"),
    )
    return plain.unionByName(calls).unionByName(results)
