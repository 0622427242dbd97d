"""SQL statements out of query plans of any depth.

A body is parsed once, as a variant. Plans that hold their statements directly below the root,
the usual case, are read in their own row. The others are taken apart level by level: every
node of a level is exploded into its members, each with its path from the root, so that a plan of
any width is spread over tasks and what is done leaves the frontier. Several levels go in one job;
between jobs the narrow rows of the frontier are written down, which keeps the number of jobs at
a ``LEVELS``-th of the depth of the deepest plan.

Members of an object are visited in the order of their names, as a variant keeps them; elements
of a list in their own. A body the variant parser does not take (no JSON, a name twice, more
than some 1000 levels or 16 MB) gives one marker, whatever its size; without a body or a plan
there is no list at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportarium.session import staged

PAIRS = "array<struct<index: string, sql_query: string>>"

# Texts written where a provider has no statement.
NO_PLAN = "Error retrieving Query Plan"
UNREADABLE = "Query Plan cannot be read"
NO_SQL = "Data Provider using Universe does not find SQL in Query Plan"

# Schemas of plans that hold their statements directly: ``statement`` is an object or
# a list of objects, with nothing but the two texts in it.
_PAIR = r"OBJECT<`?\$`?: STRING, `?@index`?: (STRING|BIGINT)>"
_FLAT_ONE = rf"^OBJECT<statement: {_PAIR}>$"
_FLAT_LIST = rf"^OBJECT<statement: ARRAY<{_PAIR}>>$"
_PAIR_TYPE = "struct<`@index`: string, `$`: string>"

#: Mark behind a body, which shows that it was read to its end.
END = "end of body"
#: Levels taken apart in one job; in the first one only so many that what most plans hold is found
#: there, since pairs pass through the rest of the levels of their job.
LEVELS = 8
FIRST_LEVELS = 4
#: Nodes: an object all of whose members are visited, a list, and a pair that was found.
OBJECT, LIST, PAIR = "object", "list", "pair"
#: Place of an object's own pair: behind its members.
LAST = (1 << 31) - 1
_NODE = "struct<path: array<int>, kind: string, node: variant, index: string, sql_query: string>"


def _shape(value: Column) -> Column:
    return F.schema_of_variant(value)


def _own_pair(value: Column) -> tuple[Column, Column, Column]:
    """Whether an object has an index and a statement of its own, and the two as texts."""
    complete, texts = F.lit(True), []
    for key in ("$['@index']", "$['$']"):
        part = F.try_variant_get(value, key, "variant")
        text = F.try_variant_get(value, key, "string")
        scalar = ~F.coalesce(_shape(part).rlike("^(ARRAY|OBJECT)"), F.lit(True))
        complete = complete & scalar & F.coalesce(text != "", F.lit(True))
        texts.append(text)
    return complete, texts[0], texts[1]


def _node(path: Column, kind: str, node: Column) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(
        path.alias("path"), F.lit(kind).alias("kind"), node.alias("node"),
        none.alias("index"), none.alias("sql_query"),
    ).cast(_NODE)


def _pair(path: Column, value: Column) -> Column:
    """The own pair of an object, or null."""
    complete, index, sql = _own_pair(value)
    nothing = F.lit(None).cast("variant")
    found = F.struct(
        path.alias("path"), F.lit(PAIR).alias("kind"), nothing.alias("node"),
        index.alias("index"), sql.alias("sql_query"),
    ).cast(_NODE)
    return F.when(complete, found)


def _visited(path: Column, value: Column) -> Column:
    """An object to visit and, behind it, its own pair."""
    own = F.array_append(path, F.lit(LAST))
    return F.array_compact(F.array(_node(path, OBJECT, value), _pair(own, value)))


def _next_level(nodes: DataFrame) -> DataFrame:
    """Rows (id, n) with every open node replaced by what its members are to the walk.

    Members of an object are visited if they are objects, and gone through if they are lists. In
    a list, an object stands for its ``statement`` where that is not empty (a list is gone
    through, an object gives its own pair), and otherwise only for its own pair.
    """
    opened = F.when(F.col("n.kind") != PAIR, F.col("n.node"))
    members = nodes.withColumn("__open", opened)
    members = members.lateralJoin(
        members.sparkSession.tvf.variant_explode_outer(F.col("__open").outer())
    )
    # Shapes are looked up once per member, in steps of their own.
    members = members.select(
        "id", "n", "value", F.array_append("n.path", F.col("pos")).alias("__path"),
        _shape(F.col("value")).alias("__shape"),
        F.when(F.col("n.kind") == LIST, F.try_variant_get("value", "$.statement", "variant")).alias("__statement"),
    ).withColumn("__inner", _shape(F.col("__statement")))
    value, path, statement = F.col("value"), F.col("__path"), F.col("__statement")
    is_object, is_list = (F.startswith("__shape", F.lit(s)) for s in ("OBJECT", "ARRAY"))
    inner_object, inner_list = (F.startswith("__inner", F.lit(s)) for s in ("OBJECT", "ARRAY"))
    text = F.try_variant_get(statement, "$", "string")
    empty = (
        F.when(statement.isNull() | F.col("__inner").isin("VOID", "OBJECT<>"), True)
        .when(inner_list, F.try_variant_get(statement, "$[0]", "variant").isNull())
        .otherwise(~inner_object & text.isin("", "0", "false"))
    )
    instead = F.when(inner_list, F.array(_node(path, LIST, statement))).when(
        inner_object, F.array_compact(F.array(_pair(path, statement)))
    )
    following = (
        F.when(F.col("n.kind") == PAIR, F.array("n"))
        .when((F.col("n.kind") == OBJECT) & is_object, _visited(path, value))
        .when((F.col("n.kind") == OBJECT) & is_list, F.array(_node(path, LIST, value)))
        .when((F.col("n.kind") == LIST) & is_object & empty, F.array_compact(F.array(_pair(path, value))))
        .when((F.col("n.kind") == LIST) & is_object, instead)
    )
    return members.select("id", F.explode(following).alias("n"))


def _walked(plans: DataFrame) -> DataFrame:
    """id and statements of plans (id, plan) that are objects, in the order of the walk."""
    root = F.array().cast("array<int>")
    frontier = plans.select("id", F.explode(_visited(root, F.col("plan"))).alias("n"))
    found = None
    while True:
        for _ in range(FIRST_LEVELS if found is None else LEVELS):
            frontier = _next_level(frontier)
        level = staged(frontier, "plan-nodes")
        pairs = level.filter(F.col("n.kind") == PAIR).select("id", "n.path", "n.index", "n.sql_query")
        found = pairs if found is None else found.unionByName(pairs)
        frontier = level.filter(F.col("n.kind") != PAIR)
        if frontier.isEmpty():
            break
    ordered = F.array_sort(F.collect_list(F.struct("path", "index", "sql_query")))
    strip = F.transform(ordered, lambda p: F.struct(p["index"].alias("index"), p["sql_query"].alias("sql_query")))
    return found.groupBy("id").agg(strip.alias("statements"))


def with_statements(df: DataFrame, body: str, name: str = "statements") -> DataFrame:
    """The other columns and the (index, sql_query) pairs of the plan in response ``body``.

    Null for an empty plan; one marker for a body that cannot be read.
    """
    kept = [c for c in df.columns if c != body]
    # The parser stops where a value ends; a mark behind it shows that nothing else follows.
    closed = F.concat(F.lit("["), F.col(body), F.lit(f',"{END}"]'))
    parsed = df.select(
        *kept, F.col(body).isNotNull().alias("__given"), F.try_parse_json(closed).alias("__marked")
    )
    whole = F.coalesce(F.try_variant_get("__marked", "$[1]", "string") == END, F.lit(False))
    planned = parsed.withColumns(
        {"__whole": whole, "__plan": F.try_variant_get("__marked", "$[0].queryplan", "variant")}
    ).withColumn("__shape", _shape(F.col("__plan")))
    plan, shape = F.col("__plan"), F.col("__shape")
    nothing = (
        F.when(shape.isNull() | shape.isin("VOID", "OBJECT<>"), True)
        .when(shape.startswith("ARRAY"), F.try_variant_get(plan, "$[0]", "variant").isNull())
        .when(shape == "STRING", F.try_variant_get(plan, "$", "string") == "")
        .otherwise(False)
    )
    one = F.array(F.try_variant_get(plan, "$.statement", _PAIR_TYPE))
    many = F.try_variant_get(plan, "$.statement", f"array<{_PAIR_TYPE}>")
    named = lambda p: F.struct(
        p["@index"].alias("index"), p["$"].alias("sql_query")
    )
    complete = lambda p: (p["index"] != "") & (p["sql_query"] != "")
    is_one, is_many = shape.rlike(_FLAT_ONE), shape.rlike(_FLAT_LIST)
    flat = F.filter(F.transform(F.when(is_one, one).when(is_many, many), named), complete)
    marker = F.array(F.struct(F.lit("0").alias("index"), F.lit(UNREADABLE).alias("sql_query")))
    nested = F.col("__whole") & shape.startswith("OBJECT") & ~nothing & ~is_one & ~is_many
    read = (
        F.when(F.col("__given") & ~F.col("__whole"), marker.cast(PAIRS))
        .when(nothing, F.lit(None).cast(PAIRS))
        .when(is_one | is_many, flat.cast(PAIRS))
        .otherwise(F.array().cast(PAIRS))
    )
    plans = staged(
        planned.select(
            *kept,
            F.monotonically_increasing_id().alias("__id"),
            read.alias("__read"),
            F.when(nested, plan).alias("__nested"),
        ),
        "plans",
    )
    deep = plans.filter(F.col("__nested").isNotNull())
    if deep.isEmpty():
        return plans.select(*kept, F.col("__read").alias(name))
    walked = _walked(deep.select(F.col("__id").alias("id"), F.col("__nested").alias("plan")))
    walked = walked.select(F.col("id").alias("__id"), F.col("statements").alias("__walked"))
    return plans.join(walked, "__id", "left").select(
        *kept, F.coalesce("__walked", "__read").cast(PAIRS).alias(name)
    )


def property_value(properties: Column, key: str) -> Column:
    """``$`` of the last property whose ``@key`` is ``key``."""
    chosen = F.try_element_at(F.filter(properties, lambda p: p["@key"] == key), F.lit(-1))
    return chosen["$"]
