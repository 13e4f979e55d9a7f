"""Row selection: live versions, date windows, n-th row per key."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from parcelmart.functions.times import DAY_MS, IST_MS


def keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with all keys present; the test reaches the files, which ``dropna`` does not."""
    present = F.lit(True)
    for key in keys:
        present = present & F.col(key).isNotNull()
    return df.filter(present)


def current_rows(df: DataFrame, flag: str = "current_active") -> DataFrame:
    """Live version of each row of a snapshot table."""
    return df.filter(F.col(flag) == 1)


def window_bound_ms(as_of: date, days: int, shift_ms: int = IST_MS) -> int:
    """First instant of the day ``days`` before ``as_of``, in epoch milliseconds."""
    return (as_of - date(1970, 1, 1)).days * DAY_MS - days * DAY_MS - shift_ms


def since(df: DataFrame, column: str, as_of: date, days: int, shift_ms: int = IST_MS) -> DataFrame:
    """Rows from the last ``days`` days before ``as_of``.

    The bound is a literal on the raw column, so it reaches the file statistics; formatting each
    value as a day and comparing text would give the same rows and read every file. ``shift_ms``
    is the day offset (0 for UTC days) and is ignored for DATE columns.
    """
    kind = df.schema[column].dataType
    if isinstance(kind, T.DateType):
        bound = F.lit(as_of - timedelta(days=days))
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        start = datetime(as_of.year, as_of.month, as_of.day) - timedelta(days=days, milliseconds=shift_ms)
        bound = F.lit(start.isoformat(sep=" ")).cast(kind)
    else:
        bound = F.lit(window_bound_ms(as_of, days, shift_ms))
    return df.filter(F.col(column) >= bound)


def latest(
    df: DataFrame,
    keys: Sequence[str],
    order: str | Column,
    n: int = 1,
    ascending: bool = False,
    tie: Sequence[str] | None = None,
) -> DataFrame:
    """The ``n``-th row per key by ``order``, newest first unless ``ascending``.

    Ties are broken by ``tie``, by default by all the other columns. Rows with a NULL key are left
    out: they match no join, and together they would be one huge group. Spark keeps at most ``n``
    rows per key in every map task before the shuffle, so a hot key stays cheap.
    """
    order_col = F.col(order) if isinstance(order, str) else order
    if tie is None:
        used = set(keys) | ({order} if isinstance(order, str) else set())
        tie = [f.name for f in df.schema.fields if f.name not in used and not isinstance(f.dataType, T.MapType)]
    by = [order_col.asc() if ascending else order_col.desc(), *[F.col(t).asc() for t in tie]]
    ranked = keyed(df, keys).withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*by))
    )
    return ranked.filter(F.col("_rank") == n).drop("_rank")
