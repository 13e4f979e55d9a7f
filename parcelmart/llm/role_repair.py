"""Repair of damaged conversations by generalised LR parsing over the role grammar.

A repaired conversation is empty, or an optional `s` and then pairs `u a`, by the initials of its roles. The parser reads the rows
in order and holds a graph-structured stack. What may follow depends on the top of a stack alone (nothing, s, u or a), so stacks
with equal tops are merged into the one of least (cost, audit); a node links to the stack that it extends. Every row is kept,
reroled or deleted on every top, and `user` and `assistant` may be inserted before it, each at its weight.

Long conversations: rows get their global order from a range partitioning with local sorts, and are parsed in segments of
`block` rows, each from all four tops at once. The best ways through a segment are then linked segment by segment, which takes
one row per segment instead of the rows. Only what the result holds in one cell, the audit, is together in one place, and the
hash of a repaired conversation, which must see its bytes in order, reads one segment's text at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmart.llm.staging import staged

TOPS = ("", "s", "u", "a")
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: What may be put on a top, and the top that it gives.
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
ROLES = {"u": "user", "a": "assistant"}
_BLANK = " \t\n\x0b\x0c\r"

Stacks = dict[str, tuple[int, str]]


def _least(stacks: Stacks, top: str, cost: int, audit: str) -> None:
    if top not in stacks or (cost, audit) < stacks[top]:
        stacks[top] = cost, audit


def _inserted(stacks: Stacks) -> Stacks:
    """Also with what can be inserted: at most a user and an assistant, since more would come back to a top it has been on."""
    out = dict(stacks)
    for initial in "ua":
        for top, (cost, audit) in list(out.items()):
            if (top, initial) in NEXT:
                _least(out, NEXT[top, initial], cost + INSERT, audit + "I")
    return out


def _row(stacks: Stacks, kind: str) -> Stacks:
    """After a row. kind: D to be deleted, else its initial (x for any other), in upper case where it is truncated."""
    if kind == "D":
        # an insertion before it costs the same after it, where the audit is less
        return {top: (cost + DELETE, audit + "D") for top, (cost, audit) in stacks.items()}
    out: Stacks = {}
    initial, more = kind.lower(), TRUNCATED * kind.isupper()
    for top, (cost, audit) in _inserted(stacks).items():
        _least(out, top, cost + DELETE, audit + "D")
        if (top, initial) in NEXT:
            _least(out, NEXT[top, initial], cost + KEEP + more, audit + "K")
        for other in ROLES:
            if (top, other) in NEXT:
                _least(out, NEXT[top, other], cost + REROLE + more, audit + "R")
    return out


@lru_cache(maxsize=4096)
def ways(kinds: str) -> tuple[tuple[str, str, int, str], ...]:
    """(top before, top after, cost, audit): the cheapest way through the rows between every two tops."""
    found = []
    for before in TOPS:
        stacks: Stacks = {before: (0, "")}
        for kind in kinds:
            stacks = _row(stacks, kind)
        found += [(before, after, cost, audit) for after, (cost, audit) in stacks.items()]
    return tuple(found)


class _Node:
    """A top of the stack over a segment: the node below, the way from there and the cost of it all."""

    __slots__ = ("below", "audit", "cost", "top")

    def __init__(self, below: _Node | None, audit: str, cost: int, top: str):
        self.below, self.audit, self.cost, self.top = below, audit, cost, top


def _before(x: _Node, y: _Node) -> bool:
    """Whether x is less than y by (cost, audit); both stand over the same segments, and audits are compared from where they part."""
    if x.cost != y.cost:
        return x.cost < y.cost
    a, b = [], []
    while x is not y:
        a.append(x.audit)
        b.append(y.audit)
        x, y = x.below, y.below
    return "".join(reversed(a)) < "".join(reversed(b))


def linked(segments: list[list[tuple[str, str, int, str]]]) -> tuple[int, list[tuple[str, str]]]:
    """The least cost, and per segment the top below it and its audit."""
    nodes = {"": _Node(None, "", 0, "")}
    for k, held in enumerate(segments):
        if k == len(segments) - 1:
            held = _closed(held)
        new: dict[str, _Node] = {}
        for before, after, cost, audit in held:
            if before in nodes:
                node = _Node(nodes[before], audit, nodes[before].cost + cost, after)
                if after not in new or _before(node, new[after]):
                    new[after] = node
        nodes = new
    ends = [nodes[top] for top in ("", "a") if top in nodes]
    end = ends[0] if len(ends) == 1 or _before(ends[0], ends[1]) else ends[1]
    cost, path = end.cost, []
    while end.below is not None:
        path.append((end.below.top, end.audit))
        end = end.below
    return cost, path[::-1]


def _closed(held: list[tuple[str, str, int, str]]) -> list[tuple[str, str, int, str]]:
    """Also with what is inserted after the last row."""
    out = []
    for before in TOPS:
        stacks = _inserted({after: (cost, audit) for b, after, cost, audit in held if b == before})
        out += [(before, after, cost, audit) for after, (cost, audit) in stacks.items()]
    return out


def repair(kinds: str) -> tuple[int, str]:
    """(cost, audit) of rows given by kind."""
    cost, path = linked([list(ways(kinds))])
    return cost, "".join(audit for _, audit in path)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, n), damaged by crc32(`conv_id:turn`) % 20; n is 2 where the row is repeated.

    0 drops the row, 1 empties its text, 2 removes `.`, `!` and `?`, 3 repeats it, 4 sets the role to user. Nulls are one blank.
    """
    words = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(words("conv_id"), F.lit(":"), words("turn"))) % 20
    rows = conversations.select("conv_id", "turn", words("role").alias("role"), words("text").alias("text"), code.alias("code"))
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("code") == 4, "user").otherwise(F.col("role"))
    return rows.where("code != 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(F.col("code") == 3, 2).otherwise(1).alias("n"))


def _same(a: DataFrame, b: DataFrame, *keys: str) -> Column:
    """Equal keys, nulls too."""
    out = F.lit(True)
    for k in keys:
        out = out & a[k].eqNullSafe(b[k])
    return out


def _runs(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[tuple[tuple, list[dict]]]:
    """Rows that follow each other with the same keys."""
    rows = (row for batch in batches for row in batch.to_pylist())
    for key, held in groupby(rows, key=lambda r: tuple(r[k] for k in keys)):
        yield key, list(held)


def _batches(rows: Iterator[dict], schema: pa.Schema, most: int, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row.values() if isinstance(x, str | bytes))
        if len(held) >= most or size > limit:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


_COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")
_WAY = pa.list_(pa.struct([("a", pa.string()), ("b", pa.string()), ("cost", pa.int64()), ("audit", pa.string())]))


def _segment(key: tuple, rows: list[dict]) -> dict:
    """What one segment adds to its conversation; rows that are the same n times are a row and n - 1 duplicates."""
    out = dict.fromkeys(_COUNTS, 0) | {"conv_id": key[0], "seg": key[1]}
    kinds, last, turn = [], None, None
    for r in rows:
        initial, n = r["initial"], r["n"]
        if r["blank"]:
            fault, kind = "blank", "D"
        elif r["repeated"]:
            fault, kind = "duplicate", "D"
        else:
            kind = initial if initial in ("s", "u", "a") else "x"
            fault, kind = ("truncated", kind.upper()) if r["truncated"] else (None, kind)
        if fault:
            out[fault] += 1
        if n > 1:
            out["blank" if r["blank"] else "duplicate"] += n - 1
        kinds.append(kind + "D" * (n - 1))
        out["illegal"] += n - 1 + (last is not None and last + initial not in ("su", "ua", "au"))
        last = initial
        if r["turn"] is not None:
            out["turns"] += r["turn"] != turn
            turn = r["turn"]
    known = [r["turn"] for r in rows if r["turn"] is not None]
    ends = {"first": rows[0]["initial"], "last": last, "low": known[0] if known else None, "high": known[-1] if known else None}
    return out | ends | {"ways": [dict(zip(("a", "b", "cost", "audit"), w, strict=True)) for w in ways("".join(kinds))]}


def _joined(key: tuple, rows: list[dict]) -> Iterator[dict]:
    """A row for the conversation (seg is null), and for each of its segments the top below it and its audit."""
    sums = {c: sum(r[c] for r in rows) for c in _COUNTS}
    for x, y in zip(rows, rows[1:], strict=False):
        sums["illegal"] += x["last"] + y["first"] not in ("su", "ua", "au")
    known = [r for r in rows if r["low"] is not None]
    sums["turns"] -= sum(x["high"] == y["low"] for x, y in zip(known, known[1:], strict=False))
    gaps = known[-1]["high"] - known[0]["low"] + 1 - sums.pop("turns") if known else 0
    cost, path = linked([[(w["a"], w["b"], w["cost"], w["audit"]) for w in r["ways"]] for r in rows])
    sums.pop("turns", None)
    yield {"conv_id": key[0], "seg": None, "top": None, "audit": "".join(a for _, a in path), "gaps": gaps, "cost": cost} | sums
    for r, (top, audit) in zip(rows, path, strict=True):
        yield {"conv_id": key[0], "seg": r["seg"], "top": top, "audit": audit}


def _lines(rows: list[dict]) -> Iterator[str]:
    """Repaired `role:text` lines of a segment."""
    top, letters = rows[0]["top"], iter(rows[0]["audit"])
    for r in rows:
        for _ in range(r["n"]):
            while (letter := next(letters)) == "I":
                top = "a" if top == "u" else "u"
                yield f"{ROLES[top]}:"
            if letter == "K":
                top = r["role"][0]
                yield f"{r['role']}:{r['text']}"
            elif letter == "R":
                top = "a" if top == "u" else "u"
                yield f"{ROLES[top]}:{r['text']}"
    for _ in letters:
        top = "a" if top == "u" else "u"
        yield f"{ROLES[top]}:"


def _body(key: tuple, rows: list[dict]) -> dict:
    lines = list(_lines(rows))
    return {"conv_id": key[0], "seg": key[1], "n": len(lines), "body": "\n".join(lines).encode()}


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    rows = (row for batch in batches for row in batch.to_pylist())
    for conv, held in groupby(rows, key=lambda r: r["conv_id"]):
        digest, begun = hashlib.sha256(), False
        for r in held:
            if r["n"]:
                digest.update((b"\n" if begun else b"") + r["body"])
                begun = True
        yield {"conv_id": conv, "repaired_sha256": digest.hexdigest()}


def _ordered(rows: DataFrame, block: int) -> DataFrame:
    same = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))
    head = F.substring("text", 1, 200)
    order = same.repartitionByRange("conv_id", "turn", "role", head).sortWithinPartitions("conv_id", "turn", "role", "text")
    numbered = order.withColumn("at", F.monotonically_increasing_id())
    return staged(numbered.withColumn("seg", F.floor(F.col("at") / block).cast("long")), "turns")


def _parsed(turns: DataFrame) -> DataFrame:
    tail = F.rtrim(F.col("text"), F.lit(_BLANK))
    about = turns.select(
        "conv_id", "seg", "at", "turn", "n", F.substring("role", 1, 1).alias("initial"), (tail == "").alias("blank"),
        (~F.substring(tail, -1, 1).isin(".", "!", "?")).alias("truncated"),
        F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("content"),
    )
    again = about.groupBy(F.col("conv_id").alias("conv"), F.col("content").alias("same")).agg(F.min("at").alias("first"), F.count("*").alias("c"))
    marked = about.join(again.where("c > 1"), F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("content") == F.col("same")), "left")
    marked = marked.withColumn("repeated", F.coalesce(F.col("at") > F.col("first"), F.lit(False))).drop("conv", "same", "first", "c", "content")
    kind = turns.schema["conv_id"].dataType.simpleString()
    arrow = turns.select("conv_id", "turn").limit(0).toArrow().schema
    conv, turn = arrow.field("conv_id").type, arrow.field("turn").type

    fields = [(c, pa.int64()) for c in _COUNTS]
    ends = [("first", pa.string()), ("last", pa.string()), ("low", turn), ("high", turn)]
    segment = pa.schema([("conv_id", conv), ("seg", pa.int64()), *fields, *ends, ("ways", _WAY)])
    turn_kind = turns.schema["turn"].dataType.simpleString()
    schema = f"conv_id {kind}, seg long, {', '.join(f'{c} long' for c in _COUNTS)}, first string, last string, low {turn_kind}, high {turn_kind}, ways array<struct<a string, b string, cost long, audit string>>"
    segments = marked.repartition("seg").sortWithinPartitions("at")
    segments = segments.mapInArrow(lambda it: _batches((_segment(k, r) for k, r in _runs(it, "conv_id", "seg")), segment, 1000), schema)

    fields = [(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    whole = pa.schema([("conv_id", conv), ("seg", pa.int64()), ("top", pa.string()), ("audit", pa.string()), *fields])
    schema = f"conv_id {kind}, seg long, top string, audit string, {', '.join(f'{c} long' for c, _ in fields)}"
    joined = segments.repartition("conv_id").sortWithinPartitions("conv_id", "seg")
    joined = joined.mapInArrow(lambda it: _batches((x for k, r in _runs(it, "conv_id") for x in _joined(k, r)), whole, 1000), schema)
    return staged(joined, "parsed")


def repair_damaged(conversations: DataFrame, block: int = 64) -> DataFrame:
    """A row per conv_id of `conversations`: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    conversations has conv_id, turn, role, text; other columns are not read. Its rows are damaged first (see damaged). Rows of one
    conversation stand by turn, nulls first, then role and text, so ties and repeated rows have one order; a null conv_id is a
    conversation of its own. A conversation without rows after the damage has zeros, an empty audit and the hash of nothing. An
    empty table gives no rows. A segment has `block` rows at most.
    """
    ids = conversations.select("conv_id").distinct()
    turns = _ordered(damaged(conversations), block)
    parsed = _parsed(turns)
    kind = turns.schema["conv_id"].dataType.simpleString()
    conv = turns.select("conv_id").limit(0).toArrow().schema.field("conv_id").type
    slices = parsed.where("seg is not null").select("conv_id", "seg", "top", "audit")
    rows = turns.join(slices, _same(turns, slices, "conv_id", "seg"))
    rows = rows.select(turns["conv_id"], turns["seg"], "at", "n", "role", "text", "top", "audit")
    bodies = pa.schema([("conv_id", conv), ("seg", pa.int64()), ("n", pa.int64()), ("body", pa.binary())])
    body = rows.repartition("conv_id", "seg").sortWithinPartitions("conv_id", "seg", "at")
    body = body.mapInArrow(lambda it: _batches((_body(k, r) for k, r in _runs(it, "conv_id", "seg")), bodies, 1000), f"conv_id {kind}, seg long, n long, body binary")
    hashes = pa.schema([("conv_id", conv), ("repaired_sha256", pa.string())])
    hashed = body.repartition("conv_id").sortWithinPartitions("conv_id", "seg")
    hashed = hashed.mapInArrow(lambda it: _batches(_hashed(it), hashes, 10_000), f"conv_id {kind}, repaired_sha256 string")

    sums = parsed.where("seg is null")
    out = ids.join(sums, _same(ids, sums, "conv_id"), "left").join(hashed, _same(ids, hashed, "conv_id"), "left")
    long = [F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = hashlib.sha256().hexdigest()
    return out.select(ids["conv_id"], *long, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))
