"""Link tool calls with their results, order them, check their arguments, write them as JSON.

Calls and results meet in a hash join on conversation and call id; of repeated ones the
earliest counts. A call may depend on results of other calls of its conversation. Its level
is the longest chain of calls below it: chains of calls with one dependency are followed by
pointer doubling, in logarithmically many rounds, and only calls with several wait for each
other in rounds. Calls of a cycle, or behind one, have no level and come last. Arguments are
parsed once and held against the tool's schema; calls are written as canonical JSON, with
sorted keys and no spaces. Only built-in functions are used.

Null conversation: a conversation of its own. Null call id: never linked, kept with a level
of 0. Dependencies on unknown or null ids, and on the call itself, are ignored (the latter is a
cycle and is reported as such). Null or unreadable arguments: an error, and null JSON.
Unknown tool: an error. Results without a call: in ``orphans``. Empty tables: no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportarium.llm.common import ranked, staged

#: JSON kinds by the type names that the variant functions give.
KINDS = {
    "string": "^STRING$",
    "integer": "^BIGINT$|^DECIMAL\\([0-9]+,0\\)$",
    "number": "^BIGINT$|^DECIMAL|^DOUBLE$|^FLOAT$",
    "boolean": "^BOOLEAN$",
    "array": "^ARRAY<",
    "object": "^OBJECT<",
}


def node(conversation: str = "conversation", call: str = "call_id") -> Column:
    """One key for a call: null conversations stay apart from all others."""
    return F.concat_ws(
        "\u0000", F.coalesce(F.col(conversation).cast("string"), F.lit("\u0001")), F.col(call)
    )


def earliest(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The first row of each call by position, then content, and how many there are."""
    picked = F.min(F.struct("position", *columns))
    return (
        rows.groupBy("conversation", "call_id")
        .agg(picked.alias("__first"), F.count(F.lit(1)).alias("__times"))
        .select("conversation", "call_id", "__first.*", "__times")
    )


def levels(calls: DataFrame) -> DataFrame:
    """node and level of the calls (conversation, call_id, depends_on); cycles have none."""
    nodes = calls.select(node().alias("node"))
    wanted = calls.select(
        node().alias("node"), "conversation", F.explode("depends_on").alias("needs")
    ).filter(F.col("needs").isNotNull())
    edges = wanted.select("node", node("conversation", "needs").alias("below")).distinct()
    edges = staged(edges.join(nodes.withColumnRenamed("node", "below"), "below", "left_semi"), "edges")
    single = edges.groupBy("node").agg(F.min("below").alias("below"), F.count(F.lit(1)).alias("n"))
    chains = staged(
        single.filter("n = 1").select("node", "below", F.lit(1).cast("long").alias("steps")),
        "chains",
    )
    several = staged(single.filter("n > 1").select("node"), "several")
    # Each round doubles how far a chain has been followed; a chain that goes on after as many
    # doublings as the number of its calls allows has no end.
    rounds = chains.count().bit_length() + 1
    for _ in range(rounds):
        lower = chains.select(
            F.col("node").alias("below"), F.col("below").alias("__end"), F.col("steps").alias("__more")
        )
        further = chains.join(lower, "below", "left")
        chains = staged(
            further.select(
                "node",
                F.coalesce("__end", "below").alias("below"),
                (F.col("steps") + F.coalesce("__more", F.lit(0))).alias("steps"),
                F.col("__end").isNotNull().alias("moved"),
            ),
            "chains",
        )
        going = not chains.filter("moved").isEmpty()
        chains = chains.drop("moved")
        if not going:
            break
    ended = chains.join(chains.select(F.col("node").alias("below")), "below", "left_anti")
    # Calls with one dependency or none stand on the end of their chain.
    stands = ended.select("node", F.col("below").alias("base"), "steps")
    bases = nodes.join(edges.select("node"), "node", "left_anti").withColumn("level", F.lit(0).cast("long"))
    done = staged(bases, "levels")
    waits = staged(
        edges.join(several, "node", "left_semi")
        .join(stands.withColumnRenamed("node", "below"), "below", "left")
        .select(
            "node",
            F.coalesce("base", "below").alias("base"),
            (F.coalesce("steps", F.lit(0)) + 1).alias("steps"),
        ),
        "waits",
    )
    while True:
        known = waits.join(done.withColumnRenamed("node", "base"), "base", "left")
        ready = staged(
            known.groupBy("node")
            .agg(
                F.max(F.col("level") + F.col("steps")).alias("level"),
                F.max(F.col("level").isNull()).alias("waiting"),
            )
            .filter("not waiting")
            .select("node", "level"),
            "ready",
        )
        if ready.isEmpty():
            break
        done = staged(done.unionByName(ready), "levels")
        waits = staged(waits.join(ready.select("node"), "node", "left_anti"), "waits")
    over = stands.join(done.withColumnRenamed("node", "base"), "base").select(
        "node", (F.col("level") + F.col("steps")).alias("level")
    )
    return done.unionByName(over)


def argument_errors(parsed: Column, schema: Column) -> Column:
    """What is wrong with an object's members, held against (name, kind, required) entries."""
    members = F.expr("cast(__arguments as map<string, variant>)")
    present = F.map_keys(members)
    names = F.transform(schema, lambda p: p["name"])
    missing = F.transform(
        F.filter(schema, lambda p: p["required"] & ~F.array_contains(present, p["name"])),
        lambda p: F.concat(F.lit("missing "), p["name"]),
    )

    def fits(kind: Column, found: Column) -> Column:
        ok = F.lit(False)
        for name, pattern in KINDS.items():
            ok = ok | ((kind == name) & found.rlike(pattern))
        return ok

    wrong = F.transform(
        F.filter(
            schema,
            lambda p: F.array_contains(present, p["name"])
            & ~fits(p["kind"], F.schema_of_variant(F.element_at(members, p["name"]))),
        ),
        lambda p: F.concat(F.lit("not "), p["kind"], F.lit(" "), p["name"]),
    )
    unknown = F.transform(
        F.array_sort(F.array_except(present, names)), lambda n: F.concat(F.lit("unknown "), n)
    )
    return F.concat(missing, wrong, unknown)


def link_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per call, with its place in a topological order of its conversation.

    ``calls``: conversation, call_id, position, tool, arguments (JSON), depends_on.
    ``results``: conversation, call_id, position, content.
    ``schemas``: tool, schema (array of name, kind, required); a row per tool.
    """
    content = ["tool", "arguments", "depends_on"]
    calls = calls.select("conversation", "call_id", "position", *content)
    results = results.select("conversation", "call_id", "position", "content")
    named = staged(earliest(calls.filter(F.col("call_id").isNotNull()), content), "calls")
    unnamed = calls.filter(F.col("call_id").isNull()).withColumn("__times", F.lit(1).cast("long"))
    answers = earliest(results.filter(F.col("call_id").isNotNull()), ["content"]).select(
        node().alias("__node"),
        F.col("position").alias("result_position"),
        F.col("content").alias("result"),
        F.col("__times").alias("n_results"),
    )
    depth = levels(named).withColumnRenamed("node", "__node")
    linked = (
        named.withColumn("__node", node())
        .join(answers, "__node", "left")
        .join(depth, "__node", "left")
        .unionByName(unnamed.withColumn("level", F.lit(0).cast("long")), allowMissingColumns=True)
        .drop("__node")
    )
    checks = schemas.select("tool", F.col("schema").alias("__schema"))
    checked = linked.join(checks, "tool", "left").withColumn(
        "__arguments", F.try_parse_json("arguments")
    )
    is_object = F.schema_of_variant("__arguments").startswith("OBJECT")
    errors = (
        F.when(F.col("__schema").isNull(), F.array(F.lit("unknown tool")))
        .when(F.col("__arguments").isNull(), F.array(F.lit("not JSON")))
        .when(~is_object, F.array(F.lit("not an object")))
        .otherwise(argument_errors(F.col("__arguments"), F.col("__schema")))
    )
    checked = checked.select(
        "conversation",
        "call_id",
        "position",
        "tool",
        F.to_json("__arguments").alias("arguments"),
        errors.alias("errors"),
        "result",
        "result_position",
        F.coalesce("n_results", F.lit(0)).alias("n_results"),
        F.col("__times").alias("n_calls"),
        "level",
    )
    order = [F.col("level").asc_nulls_last(), "position", "call_id"]
    return ranked(checked, ["conversation"], order, "place")


def canonical() -> Column:
    """A linked call's row as JSON with sorted keys; null members are left out."""
    return F.to_json(
        F.parse_json(
            F.to_json(
                F.struct(
                    F.try_parse_json("arguments").alias("arguments"),
                    F.col("call_id").alias("id"),
                    F.col("tool").alias("name"),
                    F.col("result"),
                )
            )
        )
    )


def orphans(calls: DataFrame, results: DataFrame) -> DataFrame:
    """Results whose call id no call has."""
    known = calls.filter(F.col("call_id").isNotNull()).select(node().alias("__node")).distinct()
    return results.withColumn("__node", node()).join(known, "__node", "left_anti").drop("__node")
