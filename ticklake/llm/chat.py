"""Chat formatting: tool calls linked to their results, ordered, validated and written as canonical JSON.

DataFrame functions only.  The inputs are three tables:

*   calls: conv_id, call_id, turn, name, arguments (JSON text), depends_on (array of call ids);
*   results: conv_id, call_id, turn, content;
*   schemas: name, params (map of parameter to JSON type), required (array of parameters).

Linking: results are reduced to the first one (by turn, then content) of each identifier, and hash-joined with
the calls on (conversation, identifier).  Ordering: a call's stage is the longest chain of dependencies below it,
found by pointer jumping (:func:`_levels`).  Sorting a conversation by (stage, turn, call_id) is a topological
order; no conversation is gathered in one task for it.  Validation and
canonical JSON (sorted keys, no spaces) use Spark's variant type.

Defined cases: a null call_id links to nothing (``unidentified``); null conversation ids are one conversation;
a result without a call is a row of its own (``orphan_result``); rows that repeat a call all link to the
same result; a second result of a call is counted as an error; calls in or behind a cycle have a null
stage; null or broken arguments are ``arguments: no JSON object``; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ticklake.llm.common import written

#: JSON type of each kind of variant value, by the beginning of its type.
JSON_TYPES = {"STRING": "string", "BIGINT": "integer", "BOOLEAN": "boolean", "VOID": "null", "ARRAY": "array", "OBJECT": "object",
              "DOUBLE": "number", "FLOAT": "number"}


def _key() -> Column:
    return F.coalesce(F.col("conv_id").cast("string"), F.lit("\u0000"))


def stages(calls: DataFrame) -> DataFrame:
    """(key, call_id, stage, problem) of the calls whose stage is not 0 or whose dependencies have a problem."""
    known = calls.where("call_id is not null").select("key", "call_id").distinct()
    edges = calls.where("call_id is not null").select("key", "call_id", F.explode("depends_on").alias("dep")).where("dep is not null").distinct()
    its = known.select("key", F.col("call_id").alias("dep"), F.lit(True).alias("there"))
    edges = written(edges.join(its, ["key", "dep"], "left"), "chat-edges")
    missing = edges.where("there is null").select("key", "call_id").distinct()
    staged = _levels(edges.where("there").select("key", "call_id", "dep"))
    staged = staged.where("level is null or level > 0").select("key", "call_id", F.col("level").alias("stage"),
                                                               F.when(F.col("level").isNull(), "dependency: cycle").alias("problem"))
    found = staged.join(missing.withColumn("gone", F.lit("dependency: missing")), ["key", "call_id"], "full")
    stage_ = F.when(F.col("problem").isNull(), F.coalesce("stage", F.lit(0).cast("bigint")))
    return written(found.select("key", "call_id", stage_.alias("stage"), F.concat_ws("; ", "problem", "gone").alias("problem")), "chat-stages")


def _levels(edges: DataFrame) -> DataFrame:
    """(key, call_id, level) of the calls in edges: the longest chain of dependencies below each; null in or behind a cycle.

    Calls with one dependency point at it; the pointers jump over each other, so a chain takes rounds
    logarithmic in its length.  A call with several dependencies gets its level when all of them have theirs; each
    layer of such calls is one more run of rounds.  A pointer that still moves after the rounds that the largest
    conversation can need is in or behind a cycle: it is taken out, so that it is not moved again.
    """
    counted = edges.groupBy("key", "call_id").agg(F.count(F.lit(1)).alias("n"), F.min("dep").alias("dep"))
    nodes = edges.select("key", "call_id").unionByName(edges.select("key", F.col("dep").alias("call_id"))).distinct()
    state = written(nodes.join(counted, ["key", "call_id"], "left").select(
        "key", "call_id", F.when(F.col("n").isNull(), F.lit(0).cast("bigint")).alias("level"), F.when(F.col("n") == 1, F.col("dep")).alias("ptr"),
        F.lit(1).cast("bigint").alias("w"), F.lit(False).alias("moved")), "chat-levels")
    largest = state.groupBy("key").count().agg(F.max("count")).first()[0] or 0
    rounds = largest.bit_length() + 1  # by then every pointer outside a cycle has arrived
    while True:
        for _ in range(rounds):
            ends = state.select("key", F.col("call_id").alias("ptr"), F.col("level").alias("its_level"), F.col("ptr").alias("its_ptr"), F.col("w").alias("its_w"))
            jumping = state.where("level is null and ptr is not null").drop("moved").join(ends, ["key", "ptr"]).select(
                "key", "call_id", (F.col("its_level") + F.col("w")).alias("level"), F.coalesce("its_ptr", "ptr").alias("ptr"),
                (F.col("w") + F.when(F.col("its_level").isNull() & F.col("its_ptr").isNotNull(), F.col("its_w")).otherwise(0)).alias("w"),
                (F.col("its_level").isNotNull() | F.col("its_ptr").isNotNull()).alias("moved"))
            rest = state.where("level is not null or ptr is null").withColumn("moved", F.lit(False))
            state = written(rest.unionByName(jumping), "chat-levels")
            if state.where("moved and level is null").isEmpty():
                break
        else:
            endless = F.col("moved") & F.col("level").isNull()
            state = written(state.withColumn("ptr", F.when(~endless, F.col("ptr"))), "chat-levels")
        branches = state.where("level is null and ptr is null").select("key", "call_id").join(edges, ["key", "call_id"])
        ready = branches.join(state.select("key", F.col("call_id").alias("dep"), F.col("level").alias("its")), ["key", "dep"]) \
            .groupBy("key", "call_id").agg(F.count(F.lit(1)).alias("n"), F.count("its").alias("known"), F.max("its").alias("top")) \
            .where("n = known").select("key", "call_id", (F.col("top") + 1).alias("found"))
        ready = written(ready, "chat-branches")
        if ready.isEmpty():
            return state
        state = written(state.join(ready, ["key", "call_id"], "left").withColumn("level", F.coalesce("level", "found")).drop("found"), "chat-levels")


def _json_type(variant: Column) -> Column:
    kind = F.schema_of_variant(variant)
    out = F.when(kind.startswith("DECIMAL"), F.when(F.regexp_like(kind, F.lit(r"^DECIMAL\([0-9]+,0\)$")), "integer").otherwise("number"))
    for begin, name in JSON_TYPES.items():
        out = out.when(kind.startswith(begin), name)
    return out


def errors() -> Column:
    """Sorted array of what is wrong with ``arguments`` under ``params`` and ``required``."""
    given = F.from_json("arguments", "map<string,variant>")
    none = F.expr("cast(array() as array<string>)")
    types = F.transform(F.map_entries(given), lambda e: F.struct(e["key"].alias("name"), _json_type(e["value"]).alias("type")))
    wrong = F.transform(types, lambda t: F.when(~F.map_contains_key("params", t["name"]), F.concat(F.lit("unknown: "), t["name"])).when(
        (F.element_at("params", t["name"]) != t["type"]) & ~((F.element_at("params", t["name"]) == "number") & (t["type"] == "integer")),
        F.concat(F.lit("type: "), t["name"])))
    absent = F.transform(F.array_except("required", F.json_object_keys("arguments")), lambda p: F.concat(F.lit("missing: "), p))
    broken = F.try_parse_json("arguments").isNull() | F.json_object_keys("arguments").isNull()
    return F.when(F.col("params").isNull(), F.array(F.lit("tool: unknown"))) \
        .when(broken, F.array(F.lit("arguments: no JSON object"))) \
        .otherwise(F.array_sort(F.concat(F.filter(F.coalesce(wrong, none), lambda x: x.isNotNull()), F.coalesce(absent, none))))


def link(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """(conv_id, call_id, stage, turn, name, status, errors, message): one row per call and per orphan result."""
    calls = calls.select("conv_id", _key().alias("key"), "call_id", F.col("turn").cast("bigint").alias("turn"), "name", "arguments", "depends_on")
    order = stages(calls)
    first = results.where("call_id is not null").groupBy(_key().alias("r_key"), F.col("call_id").alias("r_call")) \
        .agg(F.min(F.struct("turn", "content")).alias("first"), F.count(F.lit(1)).alias("results"), F.first("conv_id").alias("r_conv"))
    nameless = results.where("call_id is null").select(F.lit(None).cast("string").alias("r_key"), F.lit(None).cast("string").alias("r_call"),
                                                       F.struct("turn", "content").alias("first"), F.lit(1).cast("bigint").alias("results"),
                                                       F.col("conv_id").alias("r_conv"))
    checked = calls.join(schemas.select(F.col("name").alias("tool"), "params", "required"), F.col("name") == F.col("tool"), "left") \
        .withColumn("errors", errors()).drop("tool", "params", "required")
    placed = checked.join(order, ["key", "call_id"], "left") \
        .withColumn("stage", F.when(F.coalesce("problem", F.lit("")).contains("cycle"), None).otherwise(F.coalesce("stage", F.lit(0).cast("bigint"))))
    both = placed.join(first.unionByName(nameless).hint("shuffle_hash"), (F.col("key") == F.col("r_key")) & (F.col("call_id") == F.col("r_call")), "full")
    is_call = F.col("key").isNotNull()
    all_errors = F.concat(F.coalesce("errors", F.expr("cast(array() as array<string>)")),
                          F.when(F.coalesce("problem", F.lit("")) != "", F.array("problem")).otherwise(F.expr("cast(array() as array<string>)")),
                          F.when(F.col("results") > 1, F.array(F.lit("result: repeated"))).otherwise(F.expr("cast(array() as array<string>)")))
    shaped = both.select(
        F.when(is_call, F.col("conv_id")).otherwise(F.col("r_conv")).alias("conv_id"), F.coalesce("call_id", "r_call").alias("call_id"),
        F.when(is_call, F.col("stage")).alias("stage"), F.when(is_call, F.col("turn")).otherwise(F.col("first.turn").cast("bigint")).alias("turn"), "name",
        F.when(~is_call, "orphan_result").when(F.col("call_id").isNull(), "unidentified").when(F.col("results").isNull(), "missing_result")
        .otherwise("linked").alias("status"),
        all_errors.alias("errors"), F.try_parse_json("arguments").alias("arguments"), F.col("first.content").alias("result"))
    message = F.to_json(F.struct("arguments", "call_id", "errors", "name", "result", "status", "turn"))  # keys in sorted order
    return shaped.withColumn("message", message).select("conv_id", "call_id", "stage", "turn", "name", "status",
                                                        F.array_join("errors", ", ").alias("errors"), "message")


# calls, results and schemas derived from a table of conversations without tools

TOOLS = "array('search', 'lookup', 'translate', 'unlisted')"


def call_id(conv: Column, turn: Column) -> Column:
    return F.concat(F.lit("call_"), F.substring(F.md5(F.concat_ws(":", conv.cast("string"), turn.cast("string"))), 1, 16))


def derived(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Calls, results and schemas that grow with a table (conv_id, turn, role, text).

    An assistant turn becomes a call whose arguments hold its whole text; a user turn becomes the result
    of the turn before it, whether that was a call or not.  A call depends on the call two turns earlier;
    in every 13th conversation on the one two turns later, in every 26th on both (a cycle), and in every
    17th on one that does not exist.  Every 5th turn's limit is text, every 7th conversation lacks it, and
    every 11th has a parameter that no schema knows.
    """
    c = conversations.select("conv_id", F.col("turn").cast("bigint").alias("turn"), "role", "text")
    conv, turn = F.col("conv_id"), F.col("turn")
    words = F.size(F.split(F.coalesce("text", F.lit("")), " "))
    limit = F.when(conv % 7 == 0, None).when(turn % 5 == 3, F.concat(F.lit('"'), words.cast("string"), F.lit('"'))).otherwise(words.cast("string"))
    query = F.to_json(F.struct(F.coalesce("text", F.lit("")).alias("query")))
    body = F.concat_ws(",", query.substr(F.lit(2), F.length(query) - 2), F.when(limit.isNotNull(), F.concat(F.lit('"limit":'), limit)),
                       F.when(conv % 11 == 0, F.lit('"extra":true')))
    earlier = F.when(turn >= 2, call_id(conv, turn - 2))
    later = call_id(conv, turn + 2)
    deps = F.when(conv % 26 == 0, F.array(earlier, later)).when(conv % 13 == 0, F.array(later)).when(conv % 17 == 0, F.array(F.lit("call_none"))) \
        .otherwise(F.array(earlier))
    calls = c.where("role = 'assistant'").select("conv_id", call_id(conv, turn).alias("call_id"), "turn",
                                                 F.expr(f"element_at({TOOLS}, cast(pmod(length(coalesce(text, '')), 4) as int) + 1)").alias("name"),
                                                 F.concat(F.lit("{"), body, F.lit("}")).alias("arguments"), deps.alias("depends_on"))
    results = c.where("role = 'user' and turn >= 1").select("conv_id", call_id(conv, turn - 1).alias("call_id"), "turn", F.col("text").alias("content"))
    spark = conversations.sparkSession
    schemas = spark.createDataFrame([("search", {"query": "string", "limit": "integer"}, ["query"]),
                                     ("lookup", {"query": "string", "limit": "integer"}, ["limit", "query"]),
                                     ("translate", {"query": "string", "limit": "number"}, ["query"])],
                                    "name string, params map<string,string>, required array<string>")
    return calls, results, schemas
