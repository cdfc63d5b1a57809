"""Chat formatting: tool-call linking, in DataFrame functions only.

``link`` joins calls and results by conversation and identifier, orders the calls of a conversation
topologically by their dependencies, validates the arguments against the tools' schemas, and serialises each
call with its result as canonical JSON (sorted keys at every depth, no blanks).

Calls and results are each reduced to one row per identifier by a partial aggregation before they meet in a full
join, so an identifier that very many rows repeat is no load on one task. No conversation is gathered: its order
is (place, step, turn, call_id). A call's place is its turn, or the place of a call it depends on, if that is
later; turns order all dependencies that point back, however long their chains, and only what depends on a
call of its own turn or later is moved. Calls of one place that depend on each other are told apart by the
step, the longest chain of such dependencies below a call. Both are found in rounds that shorten chains by pointer
doubling: what depends on a call with a single dependency is made to depend on that one, at the sum of the two
lengths. A chain of n calls takes about log2(n) rounds; only where several dependencies of a call stay open does a
round peel one layer.

Statuses: ``ok``, ``invalid`` (errors say why), ``no_result``, ``orphan_result``. Errors: ``json`` (arguments are
no JSON object), ``tool`` (unknown), ``missing:<p>``, ``type:<p>``, ``unknown:<p>``, ``dependency`` (on a call that
the conversation does not have), ``cycle`` (in one, or behind it at the same place; step is null), ``conflict``
(calls that differ share an identifier), ``id`` (none).

Defined cases: of calls that share an identifier the smallest (by turn, name, arguments) is taken, equal ones are
one; of several results the earliest is taken and ``n_results`` tells their number; calls and results without an
identifier are not linked, and stay a row each; a null conv_id is a conversation of its own, a null turn counts as turn 0; null arguments are
no JSON; a null result text is null in the JSON. Empty tables give empty results. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import let
from tidemark.session import materialize

KEY = ["conv_id", "call_id"]
#: JSON schema types and the variant types that satisfy them.
_TYPES = {"string": "^STRING$", "integer": "^BIGINT$", "number": "^(BIGINT|DOUBLE|DECIMAL.*)$",
          "boolean": "^BOOLEAN$", "object": "^OBJECT", "array": "^ARRAY"}


def argument_errors(arguments: Column, params: Column) -> Column:
    """Sorted error names of an arguments text against a schema: array of (param, type, required), null for an
    unknown tool."""
    def checked(m: Column) -> Column:
        def of_param(p: Column) -> Column:
            kind = F.schema_of_variant(F.get(F.map_values(F.map_filter(m, lambda k, v: k == p["param"])), F.lit(0)))
            fits = F.lit(False)
            for name, pattern in _TYPES.items():
                fits = fits | ((p["type"] == name) & F.coalesce(kind.rlike(pattern), F.lit(False)))
            return (F.when(~F.map_contains_key(m, p["param"]) & p["required"], F.concat(F.lit("missing:"), p["param"]))
                    .when(F.map_contains_key(m, p["param"]) & ~fits, F.concat(F.lit("type:"), p["param"])))

        known = F.transform(params, lambda p: p["param"])
        extra = F.transform(F.array_except(F.map_keys(m), known), lambda k: F.concat(F.lit("unknown:"), k))
        return (F.when(params.isNull(), F.array(F.lit("tool")))
                .when(m.isNull(), F.array(F.lit("json")))
                .otherwise(F.concat(F.filter(F.transform(params, of_param), lambda e: e.isNotNull()), extra)))

    return let(_object(arguments), checked)


def _object(arguments: Column) -> Column:
    return F.try_parse_json(arguments).try_cast("map<string,variant>")


def canonical(arguments: Column) -> Column:
    """Canonical JSON of a JSON text; null if it is none. A variant holds an object's fields sorted by name."""
    return F.to_json(F.try_parse_json(arguments))


def _quoted(c: Column) -> Column:
    """JSON string of a text, ``null`` for null."""
    whole = F.to_json(F.struct(c.alias("v")))
    return F.when(c.isNull(), F.lit("null")).otherwise(F.substring(whole, F.lit(6), F.length(whole) - 6))


def _on(a: str, b: str, left: str = "conv_id", right: str = "kc") -> Column:
    return F.col(left).eqNullSafe(F.col(right)) & (F.col(a) == F.col(b))


def _single(edges: DataFrame, *values: str) -> DataFrame:
    """(kc, ki, n, next, ...): how many edges each call has, and, where it is one, where that leads."""
    return edges.groupBy("conv_id", "call_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("dep").alias("next"), *[F.min(v).alias(f"next_{v}") for v in values]
    ).withColumnsRenamed({"conv_id": "kc", "call_id": "ki"})


def _places(edges: DataFrame) -> DataFrame:
    """(kc, ki, moved): the calls whose place is later than their turn, by edges (conv_id, call_id, turn, dep,
    dep_turn). Only conversations with a dependency that points forward are looked at."""
    forward = edges.where("dep_turn > turn").select(F.col("conv_id").alias("fc")).distinct()
    edges = materialize(edges.join(forward, F.col("conv_id").eqNullSafe(F.col("fc")), "left_semi"), "tool-forward")
    turns = edges.select("conv_id", "call_id", "turn").union(edges.select("conv_id", "dep", "dep_turn")).distinct()
    at = materialize(turns.withColumn("at", F.col("turn")), "tool-places")
    edges = edges.select("conv_id", "call_id", "dep")
    known = None
    # ``at`` only grows, up to the last turn, so the rounds end, with cycles too
    while (total := at.agg(F.sum("at")).first()[0]) != known:
        known = total
        other = at.select(F.col("conv_id").alias("dc"), F.col("call_id").alias("di"), F.col("at").alias("dep_at"))
        more = _single(edges).select(F.col("kc").alias("nc"), F.col("ki").alias("ni"), "n", "next")
        seen = materialize(edges.join(other, _on("dep", "di", right="dc")).join(more, _on("dep", "ni", right="nc"), "left")
                           .select("conv_id", "call_id", "dep", "dep_at", "n", "next"), "tool-seen")
        best = seen.groupBy("conv_id", "call_id").agg(F.max("dep_at").alias("best")).select(
            F.col("conv_id").alias("kc"), F.col("call_id").alias("ki"), "best")
        at = materialize(at.join(best, _on("call_id", "ki"), "left")
                         .select("conv_id", "call_id", "turn", F.greatest("at", "best").alias("at")), "tool-places")
        # a dependency without any of its own has told all that it can
        edges = (seen.where("n is not null").select(
            "conv_id", "call_id", F.when(F.col("n") == 1, F.col("next")).otherwise(F.col("dep")).alias("dep")).distinct())
    return at.where("at > turn").select(F.col("conv_id").alias("kc"), F.col("call_id").alias("ki"), F.col("at").alias("moved"))


def _steps(edges: DataFrame) -> DataFrame:
    """conv_id, call_id, step of the calls in edges (conv_id, call_id, dep); null in and behind a cycle.

    The step is the largest of ``low`` and of step(dep) + length over the edges that are left. A round without a call
    that has no edges left means that all of them are in cycles or behind one."""
    pending = materialize(edges.select("conv_id", "call_id").union(edges.select("conv_id", "dep")).distinct()
                          .withColumn("low", F.lit(0).cast("long")), "tool-pending")
    edges = edges.distinct().withColumn("length", F.lit(1).cast("long"))
    parts = []
    while not pending.isEmpty():
        state = materialize(pending.join(_single(edges, "length"), _on("call_id", "ki"), "left")
                            .select("conv_id", "call_id", "low", "n", "next", "next_length"), "tool-state")
        ready = state.where("n is null").select("conv_id", "call_id", F.col("low").cast("int").alias("step"))
        if ready.isEmpty():
            parts.append(state.select("conv_id", "call_id", F.lit(None).cast("int").alias("step")))
            break
        parts.append(ready)
        after = state.select(F.col("conv_id").alias("ac"), F.col("call_id").alias("ai"), F.col("low").alias("next_low"),
                             F.col("n").isNotNull().alias("next_open"))
        other = (state.withColumn("target", F.when(F.col("n") == 1, F.col("next")))
                 .join(after, _on("target", "ai", right="ac"), "left")
                 .select(F.col("conv_id").alias("kc"), F.col("call_id").alias("ki"), F.col("low").alias("dep_low"),
                         F.col("n").isNotNull().alias("open"), "target", "next_length", "next_low", "next_open"))
        seen = materialize(edges.join(other, _on("dep", "ki")).drop("kc", "ki"), "tool-seen")
        # what an edge already tells of the steps of its end and of the one that it will lead to
        told = F.col("length") + F.greatest("dep_low", F.col("next_low") + F.col("next_length"))
        low = seen.groupBy("conv_id", "call_id").agg(F.max(told).alias("least")).select(
            F.col("conv_id").alias("kc"), F.col("call_id").alias("ki"), "least")
        pending = materialize(state.where("n is not null").join(low, _on("call_id", "ki"))
                              .select("conv_id", "call_id", F.greatest("low", "least").alias("low")), "tool-pending")
        edges = (seen.where("open and coalesce(next_open, true)").select(
            "conv_id", "call_id", F.coalesce("target", "dep").alias("dep"),
            (F.col("length") + F.when(F.col("target").isNotNull(), F.col("next_length")).otherwise(0)).alias("length"))
            .groupBy("conv_id", "call_id", "dep").agg(F.max("length").alias("length")))
    out = pending.select("conv_id", "call_id", F.lit(None).cast("int").alias("step")).limit(0) if not parts else parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def ordered(calls: DataFrame) -> DataFrame:
    """conv_id, call_id, place, step, n_unknown; ``calls`` has one row per conv_id, call_id, with turn and
    depends_on."""
    nodes = materialize(calls.select(*KEY, F.coalesce("turn", F.lit(0)).cast("long").alias("turn")), "tool-nodes")
    wanted = (calls.select(*KEY, F.coalesce("turn", F.lit(0)).cast("long").alias("turn"),
                           F.explode(F.array_distinct("depends_on")).alias("dep")))
    known = nodes.select(F.col("conv_id").alias("kc"), F.col("call_id").alias("ki"), F.col("turn").alias("dep_turn"))
    found = materialize(wanted.join(known, _on("dep", "ki"), "left").drop("kc", "ki"), "tool-deps")
    unknown = (found.where("dep_turn is null").groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_unknown"))
               .select(F.col("conv_id").alias("uc"), F.col("call_id").alias("ui"), "n_unknown"))
    edges = found.where("dep_turn is not null")
    moved = _places(edges)
    other = moved.select(F.col("kc").alias("dc"), F.col("ki").alias("di"), F.col("moved").alias("dep_moved"))
    placed = (edges.join(moved, _on("call_id", "ki"), "left").join(other, _on("dep", "di", right="dc"), "left")
              .withColumn("place", F.coalesce("moved", "turn")).withColumn("dep_place", F.coalesce("dep_moved", "dep_turn")))
    same = materialize(placed.where("place = dep_place").select("conv_id", "call_id", "dep"), "tool-edges")
    steps = _steps(same).select(F.col("conv_id").alias("sc"), F.col("call_id").alias("si"), "step", F.lit(True).alias("tied"))
    return (nodes.join(moved, _on("call_id", "ki"), "left").join(steps, _on("call_id", "si", right="sc"), "left")
            .join(unknown, _on("call_id", "ui", right="uc"), "left")
            .select(*KEY, F.coalesce("moved", "turn").alias("place"),
                    F.when(F.col("tied"), F.col("step")).otherwise(F.lit(0)).alias("step"),
                    F.coalesce("n_unknown", F.lit(0)).alias("n_unknown")))


def link(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """conv_id, call_id, turn, place, step, status, errors (sorted, comma-joined), n_results, json.

    ``calls``: conv_id, call_id, turn, name, arguments, depends_on. ``results``: conv_id, call_id, turn, content.
    ``schemas``: name, param, type, required."""
    body = F.struct("turn", "name", "arguments", "depends_on")
    own = (calls.where(F.col("call_id").isNotNull()).groupBy(*KEY).agg(F.min(body).alias("c"), F.max(body).alias("z"))
           .select(*KEY, "c.*", (~F.col("c").eqNullSafe(F.col("z"))).alias("conflict")))
    own = materialize(own, "tool-calls")
    found = (results.where(F.col("call_id").isNotNull()).groupBy(*KEY)
             .agg(F.min(F.struct("turn", "content")).alias("r"), F.count(F.lit(1)).alias("n_results"))
             .select(F.col("conv_id").alias("rc"), F.col("call_id").alias("ri"), "r", "n_results"))
    order = ordered(own).select(F.col("conv_id").alias("lc"), F.col("call_id").alias("li"), "place", "step", "n_unknown")
    tools = schemas.groupBy(F.col("name").alias("tool")).agg(
        F.sort_array(F.collect_set(F.struct("param", "type", "required"))).alias("params"))
    linked = own.join(order, F.col("conv_id").eqNullSafe(F.col("lc")) & (F.col("call_id") == F.col("li")), "left")
    # calls without an identifier are only validated
    loose = calls.where(F.col("call_id").isNull()).select(
        *KEY, "turn", "name", "arguments", "depends_on", F.lit(False).alias("conflict"),
        F.lit(None).cast("long").alias("place"), F.lit(None).cast("int").alias("step"),
        F.lit(0).cast("long").alias("n_unknown"))
    linked = linked.select(*loose.columns).unionByName(loose).withColumn("is_call", F.lit(True))
    # a hash join: both sides have one row per identifier, so its tables are as large as a shuffle partition
    both = linked.join(found.hint("shuffle_hash"), F.col("conv_id").eqNullSafe(F.col("rc")) & (F.col("call_id") == F.col("ri")), "full")
    both = both.join(tools, F.col("name") == F.col("tool"), "left")
    is_call = F.coalesce("is_call", F.lit(False))
    flag = lambda cond, name: F.when(cond, F.array(F.lit(name))).otherwise(F.array().cast("array<string>"))
    errors = F.when(is_call, F.sort_array(F.array_distinct(F.concat(
        argument_errors(F.col("arguments"), F.col("params")), flag(F.col("call_id").isNull(), "id"),
        flag(F.col("conflict"), "conflict"), flag(F.col("n_unknown") > 0, "dependency"),
        flag(F.col("call_id").isNotNull() & F.col("step").isNull(), "cycle"))))).otherwise(F.array().cast("array<string>"))
    out = both.withColumn("errs", errors)
    arguments = F.coalesce(canonical(F.col("arguments")), _quoted(F.col("arguments")))
    ident = F.coalesce("call_id", "ri")
    json = F.concat(F.lit('{"arguments":'), F.when(is_call, arguments).otherwise(F.lit("null")), F.lit(',"id":'),
                    _quoted(ident), F.lit(',"name":'), _quoted(F.col("name")), F.lit(',"result":'),
                    _quoted(F.col("r.content")), F.lit("}"))
    status = (F.when(~is_call, "orphan_result").when(F.size("errs") > 0, "invalid")
              .when(F.col("r").isNull(), "no_result").otherwise("ok"))
    linked_rows = out.select(
        F.when(is_call, F.col("conv_id")).otherwise(F.col("rc")).alias("conv_id"), ident.alias("call_id"),
        F.coalesce("turn", "r.turn").alias("turn"), "place", "step", status.alias("status"),
        F.array_join("errs", ",").alias("errors"), F.coalesce("n_results", F.lit(0).cast("long")).alias("n_results"),
        json.alias("json"))
    lost = results.where(F.col("call_id").isNull()).select(
        "conv_id", F.col("call_id"), "turn", F.lit(None).cast("long").alias("place"), F.lit(None).cast("int").alias("step"), F.lit("orphan_result").alias("status"),
        F.lit("").alias("errors"), F.lit(1).cast("long").alias("n_results"),
        F.concat(F.lit('{"arguments":null,"id":null,"name":null,"result":'), _quoted(F.col("content")), F.lit("}")).alias("json"))
    return linked_rows.unionByName(lost)


#: Tools of the calls derived from ``conversations``.
TOOLS = [("search", "query", "string", True), ("search", "limit", "integer", False), ("search", "lang", "string", False),
         ("fetch", "path", "string", True), ("fetch", "depth", "integer", True),
         ("total", "values", "array", True), ("total", "exact", "boolean", False)]


def tool_schemas(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TOOLS, "name string, param string, type string, required boolean")


def _id(turn: Column) -> Column:
    return F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), turn.cast("string"))


def calls_of(conversations: DataFrame) -> DataFrame:
    """One call per assistant turn, with the turn's text among the arguments and some planted faults."""
    t, c = F.col("turn"), F.col("conv_id")
    fault, n = F.pmod(c * 7 + t, F.lit(11)), F.length(F.coalesce("text", F.lit("")))
    query = F.coalesce("text", F.lit(""))
    search = (F.when(fault == 0, F.to_json(F.struct(query.alias("query"), n.cast("string").alias("limit"))))
              .when(fault == 1, F.to_json(F.struct(F.lit("en").alias("lang"))))
              .otherwise(F.to_json(F.struct(query.alias("query"), n.alias("limit"), F.lit("en").alias("lang")))))
    fetch = (F.when(fault == 2, F.to_json(F.struct(query.alias("path"), t.alias("depth"), F.lit(1).alias("extra"))))
             .when(fault == 3, F.lit('{"path":"'))
             .otherwise(F.to_json(F.struct(query.alias("path"), t.alias("depth")))))
    total = F.to_json(F.struct(F.array(t, n.cast("long")).alias("values"), F.lit(True).alias("exact")))
    kind = F.pmod(c + t, F.lit(3))
    deps = F.concat(F.when(t >= 2, F.array(_id(t - 2))).otherwise(F.array().cast("array<string>")),
                    F.when(t >= 5, F.array(_id(t - 4))).otherwise(F.array().cast("array<string>")),
                    F.when((F.pmod(c, F.lit(50)) == 7) & (t == 1), F.array(_id(t + 2))).otherwise(F.array().cast("array<string>")))
    return conversations.where(F.col("role") == "assistant").select(
        "conv_id", _id(t).alias("call_id"), "turn",
        F.when(fault == 4, "lookup").when(kind == 0, "search").when(kind == 1, "fetch").otherwise("total").alias("name"),
        F.when(kind == 0, search).when(kind == 1, fetch).otherwise(total).alias("arguments"), deps.alias("depends_on"))


def results_of(conversations: DataFrame) -> DataFrame:
    """A user turn answers the call of the turn before."""
    return conversations.where(F.col("role") == "user").select(
        "conv_id", _id(F.col("turn") - 1).alias("call_id"), "turn", F.col("text").alias("content"))
