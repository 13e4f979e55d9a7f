"""Near duplicates by a chosen-path similarity join.

A document is its set of distinct five-word shingles. Documents with the same set form one class. Every class has minwise
values under 64 hash functions; a tree's root splits the classes by one of them, and a node that stays large is split again
by further functions that its own path picks, two at a time, so that a pair of similarity 0.75 keeps 1.5 common children
per level. Small nodes compare their classes exhaustively. Independent trees repeat this: a pair at 0.75 that stays in
small root nodes is missed with probability 0.25 ** trees.

What keeps hot groups linear: every class is first compared with one class of each of its root nodes. The verified links
give provisional components; with more `rounds`, those that are not in a node's main component yet are compared with
other members of it. Only nodes that hold several components after that are looked at again, for pairs across components.
A node that is still large at the last level is compared in blocks, all of it: no cap on partners. Candidates whose minwise
values agree in fewer than `floor` of 184 places (5 standard deviations below 0.75) are put aside; all others are confirmed
on the full sets. Classes are named by 64 bits: two of n sets share a name with a chance of n * n / 2**65.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmart.llm import bytehash as H
from parcelmart.llm.staging import components, discard, staged, text_key

ROOTS = 24  # functions kept with 32 bits, for the roots of trees
FUNCTIONS = ROOTS + 160  # the others are kept with 16 bits
_RNG = np.random.default_rng(8)
_MULTIPLY = _RNG.integers(1, 1 << 63, FUNCTIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 1 << 63, FUNCTIONS, dtype=np.uint64)


def _sketch(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in H.pieces(whole, "_text"):
            values, begin = H.shingles(*H.flat(batch.column("_text")), width)
            values, begin = H.distinct(values, begin)
            n = np.diff(begin)
            full = np.flatnonzero(n)
            high = np.zeros((len(n), ROOTS), np.uint32)
            rest = np.zeros((len(n), FUNCTIONS - ROOTS), np.uint16)
            mark = np.zeros(len(n), np.uint64)
            if len(full):
                at = begin[:-1][full]
                for k in range(FUNCTIONS):
                    low = np.minimum.reduceat(values * _MULTIPLY[k] + _ADD[k], at)
                    if k < ROOTS:
                        high[full, k] = low >> np.uint64(32)
                    else:
                        rest[full, k - ROOTS] = H.mix(low) & np.uint64(0xFFFF)
                mark[full] = H.mix(np.add.reduceat(H.mix(values + np.uint64(1)), at) ^ (n[full].astype(np.uint64) * H.PLACE[9]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("_t1"),
                    batch.column("_t2"),
                    pa.array(n.astype(np.int64)),
                    pa.array(mark.view(np.int64)),
                    pa.array([high[i].tobytes() + rest[i].tobytes() for i in range(len(n))], pa.binary()),
                ],
                ["doc_id", "_t1", "_t2", "n_shingles", "node", "sketch"],
            )


def sketches(docs: DataFrame, width: int = 5) -> DataFrame:
    """(doc_id, _t1, _t2, n_shingles, node, sketch) per row of docs; node names the shingle set."""
    rows = docs.select("doc_id", F.col("text").alias("_text"), *text_key(F.col("text")))
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, _t1 long, _t2 long, n_shingles long, node long, sketch binary"
    return rows.mapInArrow(lambda it: _sketch(it, width), schema)


def _places(sketch) -> tuple[np.ndarray, np.ndarray]:
    every = np.frombuffer(b"".join(sketch), np.uint16).reshape(len(sketch), -1)
    return np.ascontiguousarray(every[:, : 2 * ROOTS]).view(np.uint32), every[:, 2 * ROOTS :]


def _share(a: tuple, b: tuple, i, j) -> np.ndarray:
    """Of two lists of sketches, the share of places in which a[i] and b[j] agree."""
    return ((a[0][i] == b[0][j]).sum(axis=1) + (a[1][i] == b[1][j]).sum(axis=1)) / FUNCTIONS


def _agreeing(batches: Iterator[pa.RecordBatch], floor: float) -> Iterator[pa.RecordBatch]:
    for x in batches:
        if x.num_rows:
            a, b = (_places(x.column(c).to_pylist()) for c in ("sketch_a", "sketch_b"))
            near = _share(a, b, slice(None), slice(None)) >= floor
            yield x.filter(pa.array(near)).select(["g", "a", "b"])


def _confirmed(asked: pa.Table, texts: pa.Table, width: int, percent: int) -> pa.Table:
    """Links (a, b) between near enough shingle sets, as few as connect what all of them connect.

    asked: (a, ra, b, rb) of candidates, lists b and rb per row; ra and rb name components known before. texts: (node, text).
    """
    sets: dict[int, np.ndarray] = {}
    for whole in texts.to_batches():
        for batch in H.pieces(whole, "text"):
            values, begin = H.shingles(*H.flat(batch.column("text")), width)
            sets |= {n: np.unique(values[i:j]) for n, i, j in zip(batch.column("node").to_pylist(), begin[:-1], begin[1:], strict=True)}
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while x in up:
            up[x] = x = up.get(up[x], up[x])
        return x

    found: list[tuple[int, int]] = []
    asked = asked.sort_by("a")
    for a, ra, b, rb in zip(*(asked.column(c).to_pylist() for c in ("a", "ra", "b", "rb")), strict=True):
        own, todo = sets[a], [(y, r) for y, r in dict(zip(b, rb, strict=True)).items() if top(r) != top(ra)]
        for k in range(0, len(todo), 256):
            part = [(y, r) for y, r in todo[k : k + 256] if top(r) != top(ra)]
            if part:
                size = np.array([len(sets[y]) for y, _ in part])
                every = np.concatenate([sets[y] for y, _ in part])
                at = np.minimum(np.searchsorted(own, every), len(own) - 1)
                both = np.add.reduceat((own[at] == every).astype(np.int64), np.cumsum(size) - size)
                for i in np.flatnonzero(100 * both >= percent * (len(own) + size - both)):
                    x, y = top(ra), top(part[i][1])
                    if x != y:
                        up[max(x, y)] = min(x, y)
                        found.append((a, part[i][0]))
    return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})


def _in_nodes(batches: Iterator[pa.RecordBatch], floor: float, blocks: int) -> Iterator[pa.RecordBatch]:
    """Per query row and block of sets, the base rows of its group in other components whose sketches agree often enough."""
    for t in H.whole_groups(batches, "g"):
        group, base = t.column("g").to_numpy(), t.column("is_base").to_numpy(zero_copy_only=False)
        order = np.lexsort((~base, group))
        name, root, tree, done, home = (t.column(c).to_numpy()[order] for c in ("node", "root", "tree", "done", "home"))
        twice = t.column("twice").to_numpy(zero_copy_only=False)[order]
        sketch = _places([x for x in np.array(t.column("sketch").to_pylist(), object)[order]])
        start = np.flatnonzero(np.diff(group[order], prepend=group[order[0]] - 1))
        bases = np.add.reduceat(base[order].astype(np.int64), start)
        asks = np.diff(np.append(start, len(name))) - bases
        upto = np.append(0, np.cumsum(bases * asks))
        for low in range(0, int(upto[-1]), 50_000):  # so many pairs at a time, of one group or several
            k = np.arange(low, min(low + 50_000, int(upto[-1])))
            of = np.searchsorted(upto, k, side="right") - 1
            k -= upto[of]
            b, q = start[of] + k % bases[of], start[of] + bases[of] + k // bases[of]
            other = (root[b] != root[q]) & (~twice[b] | (name[q] > name[b]))  # a pair of two query rows is met both ways round
            b, q = b[other], q[other]
            near = _share(sketch, sketch, b, q) >= floor
            b, q = b[near], q[near]
            # a pair is given out by the first root node that compares it, else by the nodes below roots
            k = np.arange(ROOTS)
            before = (sketch[0][b] == sketch[0][q]) & (k < tree[b][:, None]) & ((done[b][:, None] >> k) & 1 == 1)
            fresh = ~before.any(axis=1)
            b, q = b[fresh], q[fresh]
            g = home[q] * blocks + home[b]
            by = np.lexsort((g, q))
            b, q, g = b[by], q[by], g[by]
            first = np.flatnonzero((np.diff(q, prepend=-1) != 0) | (np.diff(g, prepend=-1) != 0))
            ends = pa.array(np.append(first, len(q)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(x[b])) for x in (name, root)]
            yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in (g[first], name[q[first]], root[q[first]])), *lists], ["g", "a", "ra", "b", "rb"])


def linked_sets(
    docs: DataFrame,
    rows: DataFrame,
    width: int = 5,
    percent: int = 75,
    trees: int = 20,
    levels: int = 6,
    small: int = 4096,
    block: int = 1024,
    floor: float = 0.59,
    rounds: int = 2,
    held: int = 1500,
) -> DataFrame:
    """(node, root): the components of the confirmed links between shingle sets; sets without any may be missing. `rows` is sketches(docs)."""
    sets = staged(
        rows.where("n_shingles > 0").groupBy("node").agg(F.first("sketch").alias("sketch"), F.min(F.struct("_t1", "_t2", F.coalesce("doc_id", F.lit(-1)).alias("_d"))).alias("t")), "sets"
    )
    blocks = max(1, sets.count() // held)
    # sets are dealt to blocks of about `held` by one minwise value, as near ones mostly share it; frequent values are split
    often = staged(sets.groupBy(F.substring("sketch", 1, 4).alias("v")).count().where(F.col("count") > held), "often")
    part = F.coalesce(F.pmod(F.xxhash64("node"), F.ceil(F.col("count") / held)), F.lit(0))
    homes = sets.withColumn("v", F.substring("sketch", 1, 4)).join(often, "v", "left")
    homes = homes.select("node", "sketch", F.pmod(F.xxhash64("v", part), F.lit(blocks)).alias("home"))
    value = lambda k: F.substring(F.col("sketch"), F.lit(4) * k + F.lit(1), F.lit(4))
    short = lambda k: F.substring(F.col("sketch"), F.lit(2) * k + F.lit(4 * ROOTS + 1), F.lit(2))
    roots = sets.select("node", F.posexplode(F.array(*[value(F.lit(k)) for k in range(trees)])).alias("tree", "v"))
    roots = roots.select("node", "tree", F.xxhash64("tree", "v").alias("path"))

    def confirm(asked: DataFrame, name: str) -> DataFrame:
        # a text goes once to each pair of blocks that needs it
        need = asked.groupBy("g").agg(F.array_union(F.collect_set("a"), F.array_distinct(F.flatten(F.collect_list("b")))).alias("x"))
        need = staged(need.select("g", F.explode("x").alias("node")), "need")
        keys = sets.join(need.select("node").distinct(), "node").select("node", "t.*")
        texts = docs.select("text", F.coalesce("doc_id", F.lit(-1)).alias("_d"), *text_key(F.col("text")))
        texts = staged(texts.join(keys, ["_t1", "_t2", "_d"]).groupBy("node").agg(F.first("text").alias("text")), "texts")
        sent = need.join(texts, "node").select(F.col("g").alias("h"), "node", "text")
        done = asked.groupBy("g").cogroup(sent.groupBy("h")).applyInArrow(lambda x, y: _confirmed(x, y, width, percent), "a long, b long")
        done = staged(done, name)
        discard(need, texts)
        return done

    side = lambda s: homes.select(F.col("node").alias(s), F.col("sketch").alias(f"sketch_{s}"), F.col("home").alias(f"home_{s}"))
    seen = now = None
    state = roots.withColumn("root", F.col("node"))
    for k in range(rounds):
        # one member per node of its tree: any at first, later one of the component that has most members there
        size = state.groupBy("path", "root").agg(F.count("*").alias("n"), F.min(F.struct(F.xxhash64("node", F.lit(k)), "node")).alias("m"))
        main = size.groupBy("path").agg(F.max(F.struct("n", "root", "m")).alias("x"), F.count("*").alias("roots")).where("roots > 1")
        main = staged(main.select("path", F.col("x.root").alias("main"), F.col("x.m.node").alias("b")), "main")
        # a class meets a component once, however many of its nodes that is the main one of
        pairs = state.join(main, "path").where("root != main").groupBy("node", "main").agg(F.min("b").alias("b"))
        pairs = pairs.select(F.greatest("node", "b").alias("a"), F.least("node", "b").alias("b")).distinct()
        if seen is not None:
            pairs = pairs.join(seen.select("a", "b"), ["a", "b"], "left_anti")
        pairs = staged(pairs, "pairs")
        near = pairs.join(side("b"), "b").join(side("a"), "a").withColumn("g", F.col("home_a") * blocks + F.col("home_b"))
        near = staged(near.mapInArrow(lambda it: _agreeing(it, floor), "g long, a long, b long"), "near")
        discard(main, pairs)
        if near.isEmpty():
            break
        seen = near if seen is None else seen.unionByName(near)
        asked = near.groupBy("g", "a").agg(F.collect_list("b").alias("b")).select("g", "a", F.col("a").alias("ra"), "b", F.col("b").alias("rb"))
        now = components(confirm(staged(asked, "asked"), "star_links"), now)
        state = roots.join(now, "node", "left").select("node", "tree", "path", F.coalesce("root", "node").alias("root"))
    if now is None:
        return sets.sparkSession.createDataFrame([], "node long, root long")

    # What stars did not connect: nodes that hold more than one component, level by level. What a level links is one component
    # for the next, so that a group is compared across few components by the time its nodes are many.
    named = homes
    level, above = state, None
    for depth in range(1, levels + 1):
        about = level.groupBy("path", "root").count().groupBy("path")
        about = about.agg(F.sum("count").alias("n"), F.max(F.struct("count", "root")).alias("x"), F.count("*").alias("roots"))
        about = about.where("roots > 1").select("path", "n", F.col("x.root").alias("main"), (F.col("n") - F.col("x.count")).alias("outside"))
        about = staged(about, "about")
        mixed = staged(level.join(about, "path"), "mixed")
        discard(about, *([above] if above is not None else []))
        above = mixed
        compare = (F.col("outside") <= small) | F.lit(depth == levels)
        if depth == 1:  # bit t: the root node in tree t compares this class
            done = mixed.where(compare).groupBy("node").agg(F.bit_or(F.expr("shiftleft(1L, tree)")).alias("done"))
            named = staged(named.join(done, "node", "left").withColumn("done", F.coalesce("done", F.lit(0).cast("long"))), "named")
        asked = staged(_compared(mixed.where(compare), named, block, floor, blocks), "asked")
        if not asked.isEmpty():
            now = components(confirm(asked, "node_links"), now)
        discard(asked)
        large = mixed.where(~compare)
        if depth == levels or large.isEmpty():
            break
        on = large.select("node", "path").join(sets.select("node", "sketch"), "node").join(now, "node", "left")
        pick = F.explode(F.array(*[F.pmod(F.xxhash64("path", F.lit(k)), F.lit(FUNCTIONS - ROOTS)) for k in range(2)])).alias("k")
        on = on.select("node", F.coalesce("root", "node").alias("root"), "path", "sketch", pick)
        path = F.xxhash64("path", "k", short(F.col("k").cast("int")))
        level = on.select("node", F.lit(ROOTS).alias("tree"), "root", path.alias("path")).distinct()
    return now


def _compared(level: DataFrame, named: DataFrame, block: int, floor: float, homes: int) -> DataFrame:
    """All pairs across components in each node, dealt out by blocks of base rows and blocks of query rows.

    level: (path, node, tree, root, n, main, outside). The component that fills most of a node, main, is only base. Every other row is base and query, so no pair is left out.
    """
    blocks = lambda n: F.greatest(F.ceil(n / block), F.lit(1)).cast("int")
    rows = level.withColumns({"bases": blocks(F.col("n")), "queries": blocks(F.col("outside"))})
    own = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    base = rows.select("path", "node", "tree", "root", own(F.col("bases")).alias("base"), every("queries").alias("query"), F.lit(True).alias("is_base"), (F.col("root") != F.col("main")).alias("twice"))
    asks = rows.where("root != main")
    asks = asks.select("path", "node", "tree", "root", every("bases").alias("base"), own(F.col("queries")).alias("query"), F.lit(False).alias("is_base"), F.lit(True).alias("twice"))
    dealt = base.unionByName(asks).join(named.select("node", "sketch", "done", "home"), "node")
    dealt = dealt.select(F.xxhash64("path", "base", "query").alias("g"), "node", "tree", "done", "home", "root", "is_base", "twice", "sketch")
    dealt = dealt.repartition("g").sortWithinPartitions("g")
    return dealt.mapInArrow(lambda it: _in_nodes(it, floor, homes), "g long, a long, ra long, b array<long>, rb array<long>")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 75, **how) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, _t1, _t2, _c) per row of docs (columns doc_id and text are read).

    Links join documents with 100 * intersection >= percent * union of shingle sets. component_id is the smallest doc_id
    reachable. Null or wordless text: no shingles, linked with nothing. Rows that repeat a doc_id are documents of their own;
    a null doc_id takes part in links but never names a component unless all of it is null. kept: doc_id is component_id.
    _c names the component of a row with shingles; component_id is the same in two components that share a doc_id.
    """
    rows = staged(sketches(docs, width), "sketches")
    joined = linked_sets(docs, rows, width, percent, **how)
    named = rows.drop("sketch").join(joined, "node", "left")
    alone = F.struct(F.lit(False).alias("set"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("id"))
    in_set = F.struct(F.lit(True).alias("set"), F.coalesce("root", "node").cast("string").alias("id"))
    named = staged(named.withColumn("_c", F.when(F.col("n_shingles") == 0, alone).otherwise(in_set)).drop("node", "root"), "named")
    least = staged(named.groupBy("_c").agg(F.min("doc_id").alias("component_id")), "least")
    out = named.join(least, "_c").withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    return out.select("doc_id", "n_shingles", "component_id", "kept", "_t1", "_t2", "_c")
