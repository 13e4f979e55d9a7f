"""Joins to reference data and to aggregated logs."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmart.operators.rows import keyed

LEFT, INNER = "left", "inner"


def single(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows, failing at run time when a key occurs twice."""
    rest = [c for c in df.columns if c not in keys]
    message = F.concat(F.lit(f"duplicate key {list(keys)}: "), F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))
    grouped = keyed(df, keys).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in rest]
    )
    checked = F.when(F.col("_n") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return grouped.filter(checked).drop("_n")


DEALT = "_dealt"


@dataclass(frozen=True)
class Deal:
    """How rows with hot keys were dealt out: the hashes of the hot keys, and over how many copies of the dimension's rows."""

    copies: int
    hot: tuple[int, ...] = ()


def _key_hash(columns: Sequence[Column]) -> Column:
    return F.xxhash64(*columns)


def hot_keys(df: DataFrame, keys: Sequence[str], share: float) -> tuple[int, ...]:
    """Hashes of the keys that hold at least ``share`` of the rows with a key, out of a heavy-hitter sketch.

    The sketch is merged map-side and has a fixed size; at most ``2 / share`` items and a count reach the driver. Its counts
    are never too low by more than a tenth of the share, so no hot key is missed; one that is not quite as hot does no harm.
    """
    k = max(1, math.ceil(2 / share))
    sketch = f"approx_top_k(h, {k}, {max(1024, 16 * k)})"
    rows = keyed(df.select(*keys), list(keys)).select(_key_hash([F.col(c) for c in keys]).alias("h"))
    total, items = rows.agg(F.count("*"), F.expr(sketch)).first()
    return tuple(sorted(x["item"] for x in items or () if x["count"] >= 0.9 * share * total))


def deal(df: DataFrame, keys: Sequence[str], share: float | None = None, copies: int = 64) -> tuple[DataFrame, Deal]:
    """``df`` with a column that spreads rows of NULL and hot keys over ``copies`` partitions in the lookups that follow.

    A NULL key finds nothing, so its rows may lie anywhere; left alone they are one huge group. Rows of a hot key are spread too
    if ``share`` is given, and each lookup then holds that key's few dimension rows ``copies`` times. All other rows stay with
    their key, so several lookups by the same key still share one shuffle. Finding the hot keys reads ``df`` once more. Rows are
    spread by a hash of all their columns (but maps), so a repeated task puts them where they were.
    """
    hot = hot_keys(df, keys, share) if share else ()
    columns = [F.col(k) for k in keys]
    missing = F.lit(False)
    for column in columns:
        missing = missing | column.isNull()
    spread = F.pmod(F.xxhash64(*[F.col(f.name) for f in df.schema.fields if "map<" not in f.dataType.simpleString()]), F.lit(copies))
    where = F.when(missing, spread)
    if hot:
        where = where.when(_key_hash(columns).isin(*hot), spread)
    return df.withColumn(DEALT, where.otherwise(F.lit(0)).cast("int")), Deal(copies, hot)


def _copied(dim: DataFrame, keys: Sequence[str], dealt: Deal) -> DataFrame:
    """Dimension rows with the place they are looked for in: place 0, or every place for a hot key."""
    key = _key_hash([F.col(k) for k in keys])
    home = F.pmod(key, F.lit(1)).cast("int")  # 0, and no literal: the join keeps it as a key
    if not dealt.hot:
        return dim.withColumn(DEALT, home)
    places = F.when(key.isin(*dealt.hot), F.sequence(F.lit(0), F.lit(dealt.copies - 1))).otherwise(F.array(home))
    return dim.withColumn(DEALT, F.explode(places))


def enrich(
    df: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str | Column],
    take: Mapping[str, str | Column] | None = None,
    how: str = LEFT,
    when: Column | None = None,
    unique: bool = False,
    dealt: Deal | None = None,
) -> DataFrame:
    """Add columns of ``dim`` by equality.

    ``on`` maps each key column of ``dim`` to the matching column or expression of ``df``; ``take``
    maps output names to columns or expressions of ``dim`` (default: all but the keys, unrenamed),
    so one dimension can serve several roles. ``when`` is a further ON condition over ``df``: a row
    that fails it survives without a match. With ``unique`` a repeated dimension key fails the run
    instead of multiplying rows.

    ``dealt`` says that ``df`` comes from ``deal`` by the same key columns, in the same order.

    No broadcast is forced: Spark broadcasts a side it knows, or measures at run time, to be small
    and sort-merges otherwise, splitting hot keys.
    """
    keys = list(on)
    if take is None:
        take = {c: c for c in dim.columns if c not in keys}
    # Joining by shared names keeps the plan short: one step, no key columns to drop after it.
    shared = when is None and all(isinstance(k, str) for k in on.values())
    shared = shared and len(set(on.values())) == len(keys) and not set(on.values()) & set(take)
    names = list(on.values()) if shared else [f"_key_{i}" for i in range(len(keys))]
    right = dim.select(
        *[F.col(k).alias(name) for k, name in zip(keys, names)],
        *[(F.col(c) if isinstance(c, str) else c).alias(out) for out, c in take.items()],
    )
    # NULL keys never match; dropping them keeps them out of the shuffle.
    right = keyed(right, names)
    if unique:
        right = single(right, names)
    if dealt:
        _check(df, right, list(on.values()), names)
        right = _copied(right, names, dealt)
    if shared:
        return df.join(right, [*names, DEALT] if dealt else names, how)
    condition = when
    if dealt:
        right = right.withColumnRenamed(DEALT, "_place")
        names.append("_place")
        on = {**on, "_place": DEALT}
    for left_key, name in zip(on.values(), names):
        equal = (F.col(left_key) if isinstance(left_key, str) else left_key) == F.col(name)
        condition = equal if condition is None else condition & equal
    return df.join(right, condition, how).drop(*names)


def _check(df: DataFrame, right: DataFrame, left_keys: Sequence[str | Column], names: Sequence[str]) -> None:
    """Hashes of keys only agree if their types do."""
    for left, name in zip(left_keys, names):
        if not isinstance(left, str) or DEALT not in df.columns:
            raise ValueError("lookups of dealt rows go by the columns the rows were dealt by")
        if df.schema[left].dataType != right.schema[name].dataType:
            raise ValueError(f"dealt key {left} is {df.schema[left].dataType}, its dimension has {right.schema[name].dataType}")
