"""Chat formatting: linking tool calls with their results, in an order that respects references, as canonical JSON."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, materialise, table

CALL = re.compile(r"<tool_call>(.*?)</tool_call>", re.S)
KINDS = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "object": dict, "array": list, "null": type(None)}
EVENT = "turn long, seq int, kind string, call_id string, name string, refs array<string>, errors array<string>, json string"

PLACE = "struct<turn: bigint, seq: int, _event: bigint>"
#: References of a conversation that one task orders, at most, and of all conversations that it has at a time, about.
OWN_EDGES, TASK_EDGES = 500_000, 250_000

#: The tools of the registered query.
TOOLS = {
    "search": {"type": "object", "required": ["query", "turn"], "additionalProperties": False, "properties": {"query": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0}, "after": {"type": "array", "items": {"type": "object"}}}},
    "lookup": {"type": "object", "required": ["query", "turn"], "additionalProperties": False, "properties": {"query": {"type": "string", "minLength": 1, "maxLength": 160}, "turn": {"type": "integer", "minimum": 0}, "after": {"type": "array", "items": {"type": "object"}}}},
}


def canonical(value: object) -> str:
    """JSON with sorted keys and without spaces; characters beyond ASCII as they are unless UTF-8 cannot hold them. A number that JSON cannot hold is an error."""
    out = json.dumps(value, sort_keys=True, ensure_ascii=False, separators=(",", ":"), allow_nan=False)
    return json.dumps(value, sort_keys=True, separators=(",", ":"), allow_nan=False) if re.search("[\ud800-\udfff]", out) else out


def _finite(text: str) -> float:
    number = float(text)
    if not math.isfinite(number):
        raise ValueError(f"{text} is beyond the range of numbers")
    return number


def parsed(text: str) -> object:
    """A JSON value; NaN, infinities and numbers beyond the range of doubles are no JSON."""
    return json.loads(text, parse_constant=_finite, parse_float=_finite)


def _is(value: object, kind: str) -> bool:
    return isinstance(value, KINDS[kind]) and not (isinstance(value, bool) and kind in ("integer", "number"))


def violations(value: object, schema: dict, at: str = "arguments") -> list[str]:
    """What a value breaks of a schema: type (one or several), enum, bounds, lengths, items, properties, required, additionalProperties.

    In the order of a walk that goes down before it goes on. Types that JSON Schema does not name are not asked for.
    """
    out: list[str] = []
    left: list[tuple[object, dict | None, str]] = [(value, schema, at)]
    while left:
        value, schema, at = left.pop()
        if schema is None:
            out.append(at)
            continue
        kind = schema.get("type")
        kinds = [k for k in ([kind] if isinstance(kind, str) else kind or []) if k in KINDS]
        if kinds and not any(_is(value, k) for k in kinds):
            out.append(f"{at}: not of type {' or '.join(kinds)}")
            continue
        if "enum" in schema and value not in schema["enum"]:
            out.append(f"{at}: not one of the values")
        if isinstance(value, (int, float)) and not isinstance(value, bool):
            out += [f"{at}: under {schema['minimum']}"] if value < schema.get("minimum", value) else []
            out += [f"{at}: over {schema['maximum']}"] if value > schema.get("maximum", value) else []
        if isinstance(value, str):
            out += [f"{at}: shorter than {schema['minLength']}"] if len(value) < schema.get("minLength", 0) else []
            out += [f"{at}: longer than {schema['maxLength']}"] if len(value) > schema.get("maxLength", len(value)) else []
        below: list[tuple[object, dict | None, str]] = []
        if isinstance(value, list) and "items" in schema:
            below += [(v, schema["items"], f"{at}[{i}]") for i, v in enumerate(value)]
        if isinstance(value, dict):
            known = schema.get("properties", {})
            out += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
            for k in sorted(value):
                if k in known:
                    below.append((value[k], known[k], f"{at}.{k}"))
                elif schema.get("additionalProperties", True) is False:
                    below.append((None, None, f"{at}.{k}: unknown"))
        left += reversed(below)
    return out


def _references(value: object) -> set[str]:
    """Identifiers in {"$ref": id} anywhere in the arguments, however deep."""
    found, left = set(), [value]
    while left:
        value = left.pop()
        if isinstance(value, dict):
            if isinstance(value.get("$ref"), str):
                found.add(value["$ref"])
            left += value.values()
        elif isinstance(value, list):
            left += value
    return found


def _events(role: str | None, text: str | None, tools: dict) -> Iterator[tuple[str, str | None, str | None, list[str], list[str], str]]:
    """kind, identifier, name, references, errors and JSON of every call and result of a message."""
    if role == "assistant":
        for m in CALL.finditer(text or ""):
            try:
                call = parsed(m[1])
                name, own, arguments = call.get("name"), call.get("id"), call.get("arguments", {})
                errors = violations(arguments, tools[name]) if isinstance(name, str) and name in tools else ["unknown tool"]
                name = name if isinstance(name, str) else None
                made = canonical({"arguments": arguments, "id": own, "name": name})
            except (ValueError, AttributeError, RecursionError):
                yield "call", None, None, [], ["not a JSON object"], canonical(m[1])
                continue
            if not isinstance(own, str):
                errors.insert(0, "no identifier")
            yield "call", own if isinstance(own, str) else None, name, sorted(_references(arguments)), errors, made
    elif role == "tool":
        try:
            got = parsed(text or "")
            own = got.get("tool_call_id")
            made = canonical({"content": got.get("content"), "tool_call_id": own})
        except (ValueError, AttributeError, RecursionError):
            yield "result", None, None, [], ["not a JSON object"], canonical(text or "")
            return
        ok = isinstance(own, str)
        yield "result", own if ok else None, None, [], [] if ok else ["no identifier"], made


def extract_events(messages: DataFrame, tools: dict) -> DataFrame:
    """One row for every tool call in a message of the assistant and for every message of a tool."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("turn", pa.int64()), ("seq", pa.int32()), *((c, pa.string()) for c in ("kind", "call_id", "name")), ("refs", pa.list_(pa.string())), ("errors", pa.list_(pa.string())), ("json", pa.string())])
        for batch in batches:
            of, out = [], []
            for i, (turn, role, text) in enumerate(zip(*(batch.column(i).to_pylist() for i in range(1, 4)), strict=True)):
                made = [(turn, seq, *e) for seq, e in enumerate(_events(role, text, tools))]
                of += [i] * len(made)
                out += made
            columns = list(zip(*out, strict=True)) if out else [[] for _ in schema]
            convs = batch.column(0).take(pa.array(of, pa.int64()))
            yield pa.RecordBatch.from_arrays([convs, *(pa.array(c, f.type) for c, f in zip(columns, schema, strict=True))], names=["conv_id", *schema.names])

    rows = messages.select("conv_id", F.col("turn").cast("long"), "role", "text")
    return rows.mapInArrow(run, f"conv_id {messages.schema['conv_id'].dataType.simpleString()}, {EVENT}")


def _depths(edges: DataFrame, most: int, places: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """(_node, _depth) for every _from: the length of the longest chain of references that begins there, none on or behind a cycle; and ``places``.

    Steps are doubled: a round joins the pairs of calls 2^k steps apart with themselves. A call's longest chain is
    2^k steps, for the last k for which it has a pair, and the longest chain of those it meets there, so there are as many rounds as
    the logarithm of the longest chain. ``most`` calls at most are in a conversation; longer chains are cycles. A row of
    ``places`` (_node, _ready) becomes the latest place of the call and all that it refers to, directly or not.
    """
    steps, reach = materialise(edges.select("_from", "_to").distinct(), "steps"), 1
    depth = steps.select(F.col("_from").alias("_node"), F.lit(0).alias("_depth")).where("false")
    while not steps.isEmpty():
        if reach >= most:
            return depth.union(steps.select("_from", F.lit(None).cast("int")).distinct()), places
        if places is not None:
            met = steps.join(places.withColumnRenamed("_node", "_to"), "_to").groupBy(F.col("_from").alias("_node")).agg(F.max("_ready").alias("_met"))
            later = F.when(F.col("_met") > F.col("_ready"), F.col("_met")).otherwise(F.col("_ready"))
            old, places = places, materialise(places.join(met, "_node", "left").select("_node", later.alias("_ready")), "places")
            discard(old)
        on = steps.select(F.col("_from").alias("_to"), F.col("_to").alias("_next"))
        further = materialise(steps.join(on, "_to").select("_from", F.col("_next").alias("_to")).distinct(), "steps")
        ended = steps.join(further.select("_from").distinct(), "_from", "left_anti").join(depth.withColumnRenamed("_node", "_to"), "_to", "left")
        found = ended.groupBy(F.col("_from").alias("_node")).agg((F.max(F.coalesce("_depth", F.lit(0))) + reach).cast("int").alias("_depth"))
        old, depth = depth, materialise(depth.union(found), "depths")
        discard(old, steps)
        steps, reach = further, 2 * reach
    return depth, places


def sorted_calls(source: np.ndarray, target: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Level, latest place and wait of every call by Kahn's order: a call comes once all it refers to have come. The level is -1 on or behind a cycle.

    Calls are numbers, and refer from ``source`` to ``target``; ``place`` is that of each, no two alike. Time and memory grow with the references.
    """
    n = len(place)
    by = np.argsort(target, kind="stable")
    users, begin = source[by].tolist(), np.searchsorted(target[by], np.arange(n + 1)).tolist()
    missing = np.bincount(source, minlength=n).tolist()
    level, ready, wait = [0] * n, place.tolist(), [0] * n
    come = [i for i in range(n) if not missing[i]]
    for u in come:
        for v in users[begin[u] : begin[u + 1]]:
            level[v] = max(level[v], level[u] + 1)
            if ready[u] > ready[v]:
                ready[v], wait[v] = ready[u], wait[u] + 1
            elif ready[u] == ready[v]:
                wait[v] = max(wait[v], wait[u] + 1)
            missing[v] -= 1
            if not missing[v]:
                come.append(v)
    known = np.array(missing, dtype=np.int64) == 0
    return np.where(known, level, -1), np.array(ready, dtype=np.int64), np.array(wait, dtype=np.int64)


def _sorted_edges(edges: pa.Table) -> pa.Table:
    """(_call, _level, _ready, _wait) for every call of whole conversations that refers to others."""
    ends = [(edges.column(f"_{end}").combine_chunks(), edges.column(f"_{end}_place").combine_chunks()) for end in ("from", "to")]
    events, first = np.unique(np.concatenate([e.to_numpy(zero_copy_only=False) for e, _ in ends]), return_index=True)
    source, target = (np.searchsorted(events, e.to_numpy(zero_copy_only=False)) for e, _ in ends)
    places = pa.concat_arrays([p for _, p in ends]).take(pa.array(first))
    turn, seq = places.field("turn"), places.field("seq").to_numpy(zero_copy_only=False)
    order = np.lexsort((events, seq, turn.fill_null(0).to_numpy(zero_copy_only=False), turn.is_valid().to_numpy(zero_copy_only=False)))  # a null turn comes first
    place = np.empty(len(events), dtype=np.int64)
    place[order] = np.arange(len(events))
    level, ready, wait = sorted_calls(source, target, place)
    calls = np.unique(source)
    lost = level[calls] < 0
    return pa.table({
        "_call": pa.array(events[calls], pa.int64()), "_level": pa.array(level[calls], pa.int32(), mask=lost),
        "_ready": places.take(pa.array(order[ready[calls]], pa.int64(), mask=lost)), "_wait": pa.array(wait[calls], pa.int32(), mask=lost),
    })


def _order(edges: DataFrame, most: int, own_edges: int = OWN_EDGES) -> DataFrame:
    """(_call, _level, _ready, _wait) for every call that refers to others.

    ``edges`` has _conv, _from, _from_place, _to, _to_place, each pair once. Conversations of up to ``own_edges`` references are ordered whole, many in a task, in time
    that grows with the references; those of more by doubled steps, where no task has a whole conversation. Both give the same.
    """
    edges = edges.withColumn("_whole", F.xxhash64("_conv"))
    sizes = materialise(edges.groupBy("_whole").agg(F.count(F.lit(1)).alias("_size")), "conversation-sizes")
    large = sizes.where(F.col("_size") > own_edges).select("_whole")
    total = sizes.agg(F.sum("_size")).first()[0] or 0
    tasks = -(-total // TASK_EDGES) + 1
    small = edges.join(large, "_whole", "left_anti").withColumn("_task", F.pmod(F.col("_whole"), F.lit(tasks)))
    found = small.select("_task", "_from", "_from_place", "_to", "_to_place").groupBy("_task").applyInArrow(_sorted_edges, f"_call long, _level int, _ready {PLACE}, _wait int")
    if large.isEmpty():
        return found
    return found.unionByName(_order_by_steps(materialise(edges.join(large, "_whole", "left_semi").drop("_whole", "_conv"), "large-conversations"), most))


def _order_by_steps(edges: DataFrame, most: int) -> DataFrame:
    """(_call, _level, _ready, _wait) for every call that refers to others, by doubled steps.

    ``edges`` has _from, _from_place, _to, _to_place. The level is one more than that of the deepest call referred to. A call is ready at
    the latest place among itself and all it refers to, directly or not; where all references go back that is its own. It
    waits one more than those it refers to of the same place. Calls on or behind a cycle have none of these.
    """
    forward = not edges.where("_to_place > _from_place").isEmpty()
    own = edges.select(F.col("_from").alias("_node"), F.col("_from_place").alias("_own")).distinct()
    places = edges.select(F.col("_from").alias("_node"), F.col("_from_place").alias("_ready")).union(edges.select("_to", "_to_place")).distinct() if forward else None
    depth, places = _depths(edges, most, places)
    if not forward:
        return depth.join(own, "_node").select(F.col("_node").alias("_call"), F.col("_depth").alias("_level"), F.when(F.col("_depth").isNotNull(), F.col("_own")).alias("_ready"), F.when(F.col("_depth").isNotNull(), 0).alias("_wait"))
    late = materialise(depth.where("_depth IS NOT NULL").join(own, "_node").join(places, "_node").where("_ready > _own").select(F.col("_node").alias("_from"), F.col("_ready").alias("_from_ready")), "late")
    same = edges.join(late, "_from").join(places.toDF("_to", "_to_ready"), "_to").where("_from_ready = _to_ready")
    wait, _ = _depths(same, most)
    placed = depth.join(places, "_node").join(wait.toDF("_node", "_wait"), "_node", "left")
    known = F.col("_depth").isNotNull()
    return placed.select(F.col("_node").alias("_call"), F.col("_depth").alias("_level"), F.when(known, F.col("_ready")).alias("_ready"), F.when(known, F.coalesce("_wait", F.lit(0))).alias("_wait"))


def link_tool_calls(messages: DataFrame, tools: dict, own_edges: int = OWN_EDGES) -> DataFrame:
    """Calls and results of conversations, linked by identifier.

    ``messages`` has conv_id (of any type), turn, role, text. Calls are JSON objects (id, name, arguments) in
    ``<tool_call>`` tags of the assistant's messages; a result is a message of role tool with the JSON object (tool_call_id,
    content). Arguments may refer to the results of other calls as {"$ref": id}. Ordering a conversation by (ready_turn,
    ready_seq, wait, call_turn, call_seq, kind) puts every call after all that it refers to and every result after its call:
    a call is ready at the latest place among itself and all that it needs, and waits one more than those it needs of the same
    place. Its level is one more than that of the deepest call it refers to, 0 where it refers to none. Conversations of up to ``own_edges`` references
    are ordered within tasks; no larger one is gathered in one task.

    Returns one row per event: conv_id, turn, seq, kind, call_id, name, ready_turn, ready_seq, wait, level, call_turn, call_seq, other_turn (of the
    result or the call), status, errors, json (canonical). Status of a call: duplicate (not the first of its identifier), cycle,
    invalid (breaks its schema, refers to an unknown call, or cannot be read), unanswered or linked; of a result: duplicate, orphan or
    linked. JSON nested deeper than Python's parser goes (some thousands of levels) or with numbers beyond doubles counts as no JSON object. Other roles, null roles and texts give no events; a null conversation is a conversation; a null turn comes
    first; rows that repeat give duplicates; other columns are not read; an empty table gives an empty result.
    """
    events = materialise(extract_events(messages, tools).withColumn("_event", F.monotonically_increasing_id()), "events")
    place = F.struct("turn", "seq", "_event")
    # null identifiers and conversations get keys of their own kind
    keyed = events.withColumn("_key", F.to_json(F.struct("conv_id", "call_id"), {"ignoreNullFields": "false"}))
    firsts = materialise(keyed.where("call_id IS NOT NULL").groupBy("_key", "kind").agg(F.min(place).alias("_first")), "firsts")
    call = firsts.where("kind = 'call'").select("_key", F.col("_first._event").alias("_call"), F.col("_first").alias("_place"))
    result = firsts.where("kind = 'result'").select("_key", F.col("_first._event").alias("_result"), F.col("_first.turn").alias("_result_turn"))
    pairs = materialise(call.join(result, "_key", "full_outer"), "links")
    refs = keyed.where("kind = 'call'").select("_event", "conv_id", F.to_json(F.struct("conv_id"), {"ignoreNullFields": "false"}).alias("_conv"), place.alias("_from_place"), F.explode("refs").alias("call_id"))
    refs = refs.withColumn("_key", F.to_json(F.struct("conv_id", "call_id"), {"ignoreNullFields": "false"})).join(call, "_key", "left")
    refs = materialise(refs.select("_event", "_conv", "_from_place", "call_id", "_call", "_place"), "refs")
    unknown = refs.where("_call IS NULL").groupBy("_event").agg(F.array_sort(F.collect_set(F.concat(F.lit("unknown reference "), "call_id"))).alias("_unknown"))
    edges = refs.where("_call IS NOT NULL").select("_conv", F.col("_event").alias("_from"), "_from_place", F.col("_call").alias("_to"), F.col("_place").alias("_to_place")).distinct()
    edges = edges.join(call.select(F.col("_call").alias("_from")), "_from", "left_semi")
    edges = materialise(edges, "edges")
    most = keyed.where("kind = 'call'").groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    own = F.struct(F.lit(0).alias("_level"), F.col("_place").alias("_ready"), F.lit(0).alias("_wait"))
    known = _order(edges, most, own_edges).select("_call", F.struct("_level", "_ready", "_wait").alias("_w"))
    pairs = pairs.join(known, "_call", "left").withColumn("_order", F.when(F.col("_w").isNotNull(), F.col("_w")).when(F.col("_call").isNotNull(), own)).drop("_w")
    joined = keyed.join(materialise(pairs, "ordered"), "_key", "left").join(unknown, "_event", "left")
    errors = F.concat("errors", F.coalesce("_unknown", F.array().cast("array<string>")))
    of_call = (
        F.when(F.col("call_id").isNotNull() & (F.col("_event") != F.col("_call")), "duplicate")
        .when(F.col("call_id").isNotNull() & F.col("_order._ready").isNull(), "cycle")
        .when(F.size(errors) > 0, "invalid").when(F.col("_result").isNull(), "unanswered").otherwise("linked")
    )
    of_result = F.when(F.col("call_id").isNotNull() & (F.col("_event") != F.col("_result")), "duplicate").when(F.col("_call").isNull(), "orphan").otherwise("linked")
    is_call = F.col("kind") == "call"
    return joined.select(
        "conv_id", "turn", "seq", "kind", "call_id", "name", F.col("_order._ready.turn").alias("ready_turn"), F.col("_order._ready.seq").alias("ready_seq"), F.col("_order._wait").alias("wait"), F.col("_order._level").alias("level"),
        F.col("_place.turn").alias("call_turn"), F.col("_place.seq").alias("call_seq"), F.when(is_call, F.col("_result_turn")).otherwise(F.col("_place.turn")).alias("other_turn"),
        F.when(is_call, of_call).otherwise(of_result).alias("status"), F.array_join(errors, "; ").alias("errors"), "json",
    )


def as_tool_messages(conversations: DataFrame) -> DataFrame:
    """Conversations in the form of tool use: each user's turn is a call, each answer its result.

    Pairs of turns are counted in threes. A call refers to the one two turns before; of each three the second also refers ahead, to the
    call two turns after, and the third to the first instead, four turns before, so that no call needs itself.
    """
    of = lambda by: F.concat(F.lit("c"), "conv_id", F.lit("-"), F.col("turn") + by)
    third = F.floor(F.col("turn") / 2) % 3
    back = F.when(third == 2, of(-4)).when(F.col("turn") >= 2, of(-2))
    refs = F.array_compact(F.array(back, F.when(third == 1, of(2))))
    arguments = F.struct(
        F.when(F.size(refs) > 0, F.transform(refs, lambda r: F.struct(r.alias("$ref")))).alias("after"), F.col("turn").alias("turn"), F.col("text").alias("query")
    )
    name = F.when(F.col("turn") % 4 < 2, "search").otherwise("lookup")
    call = F.concat(F.lit("<tool_call>"), F.to_json(F.struct(name.alias("name"), of(0).alias("id"), arguments.alias("arguments"))), F.lit("</tool_call>"))
    result = F.to_json(F.struct(F.col("text").alias("content"), of(-1).alias("tool_call_id")))
    text = F.when(F.col("role") == "user", call).when(F.col("role") == "assistant", result)
    role = F.when(F.col("role") == "user", "assistant").when(F.col("role") == "assistant", "tool").otherwise(F.col("role"))
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"))


def op10_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls and results of all conversations in the form of tool use, with the level and place of each in the order of references."""
    return link_tool_calls(as_tool_messages(table(spark, sf_dir, "conversations")), TOOLS)


OP10_SQL = """
WITH RECURSIVE c AS (
  SELECT conv_id, turn, text, 'c' || conv_id || '-' || turn AS call_id, CASE WHEN turn % 4 < 2 THEN 'search' ELSE 'lookup' END AS name,
         CASE WHEN turn // 2 % 3 = 2 THEN 'c' || conv_id || '-' || (turn - 4) WHEN turn >= 2 THEN 'c' || conv_id || '-' || (turn - 2) END AS back,
         CASE WHEN turn // 2 % 3 = 1 THEN 'c' || conv_id || '-' || (turn + 2) END AS ahead
  FROM conversations WHERE role = 'user'),
r AS (SELECT conv_id, turn, text, 'c' || conv_id || '-' || (turn - 1) AS call_id FROM conversations WHERE role = 'assistant'),
known AS (SELECT c.*, b.call_id IS NOT NULL AS has_back, a.call_id IS NOT NULL AS has_ahead FROM c LEFT JOIN c b ON b.call_id = c.back LEFT JOIN c a ON a.call_id = c.ahead),
edge AS (SELECT call_id, back AS needs FROM known WHERE has_back UNION ALL SELECT call_id, ahead FROM known WHERE has_ahead),
walk AS (SELECT call_id, 0 AS level FROM known WHERE NOT has_back AND NOT has_ahead UNION ALL SELECT e.call_id, w.level + 1 FROM walk w JOIN edge e ON e.needs = w.call_id),
depth AS (SELECT call_id, max(level) AS level FROM walk GROUP BY 1),
e AS (
  SELECT k.*, r.turn AS other, d.level, CASE WHEN has_ahead THEN k.turn + 2 ELSE k.turn END AS ready_turn, CAST(has_ahead AS INTEGER) AS wait,
         concat_ws('; ', CASE WHEN length(k.text) < 1 THEN 'arguments.query: shorter than 1' END,
                   CASE WHEN name = 'lookup' AND length(k.text) > 160 THEN 'arguments.query: longer than 160' END,
                   array_to_string(list_sort(list_filter([CASE WHEN back IS NOT NULL AND NOT has_back THEN 'unknown reference ' || back END,
                                                          CASE WHEN ahead IS NOT NULL AND NOT has_ahead THEN 'unknown reference ' || ahead END], lambda x: x IS NOT NULL)), '; ')) AS found
  FROM known k LEFT JOIN r USING (conv_id, call_id) JOIN depth d ON d.call_id = k.call_id),
o AS (SELECT *, regexp_replace(found, '; $', '') AS errors FROM e)
SELECT conv_id, turn, 0 AS seq, 'call' AS kind, call_id, name, ready_turn, 0 AS ready_seq, wait, level, turn AS call_turn, 0 AS call_seq, other AS other_turn,
       CASE WHEN errors <> '' THEN 'invalid' WHEN other IS NULL THEN 'unanswered' ELSE 'linked' END AS status, errors,
       '{"arguments":{' || CASE WHEN back IS NOT NULL OR ahead IS NOT NULL THEN '"after":[' || concat_ws(',', '{"$ref":"' || back || '"}', '{"$ref":"' || ahead || '"}') || '],' ELSE '' END
         || '"query":' || CAST(to_json(text) AS VARCHAR) || ',"turn":' || turn || '},"id":"' || call_id || '","name":"' || name || '"}' AS json
FROM o
UNION ALL
SELECT r.conv_id, r.turn, 0, 'result', r.call_id, NULL, o.ready_turn, CASE WHEN o.turn IS NOT NULL THEN 0 END, o.wait, o.level, o.turn, CASE WHEN o.turn IS NOT NULL THEN 0 END, o.turn,
       CASE WHEN o.turn IS NULL THEN 'orphan' ELSE 'linked' END, '',
       '{"content":' || CAST(to_json(r.text) AS VARCHAR) || ',"tool_call_id":"' || r.call_id || '"}'
FROM r LEFT JOIN o ON o.conv_id = r.conv_id AND o.call_id = r.call_id
"""
