"""Repeated lines, found by winnowing over line hashes; built-in expressions only.

From every line a window runs on until it holds `min_words` words. The line with the smallest hash in a window is its
fingerprint, so that a passage that repeats, however it is embedded, has a fingerprint in common with its copies wherever
it fills a window. Fingerprints that occur at one place only need no further look. Around the places of the others the
match is extended both ways to the windows they stand for, whole windows are compared, and all but the first occurrence
are later repeats. Later repeats that touch or overlap are one run, and the runs are cut out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelmart.llm.staging import staged, text_key

_KEY = ["_d", "_t1", "_t2"]


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"_d": F.coalesce("doc_id", F.lit(-(2**63)))} | dict(zip(_KEY[1:], text_key(F.col("text")), strict=True)))


def windows(docs: DataFrame, min_words: int = 5) -> DataFrame:
    """(key, i, last, fp, fp_at, w1, w2): each line's window, its last line, its fingerprint and place, its content."""
    lines = _keyed(docs.select("doc_id", "text")).select(*_KEY, F.posexplode(F.split("text", "\n")).alias("i", "line"))
    line = F.trim("line")
    words = F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1
    lines = lines.where(line != "").select(*_KEY, "i", F.xxhash64(line).alias("h"), words.alias("n"))
    upto = Window.partitionBy(*_KEY).orderBy("i")
    lines = lines.withColumn("above", F.lag("i").over(upto)).where("above is null or above != i")  # repeated rows count once
    lines = lines.withColumn("before", F.sum("n").over(upto) - F.col("n"))
    on = Window.partitionBy(*_KEY).orderBy("before").rangeBetween(0, min_words - 1)
    low = F.min(F.struct("h", "i")).over(on)
    held = F.collect_list("h").over(on)
    rows = lines.select(*_KEY, "i", F.max("i").over(on).alias("last"), low.alias("low"), held.alias("held"), F.sum("n").over(on).alias("n"))
    rows = rows.where(F.col("n") >= min_words)
    content = [F.xxhash64("held").alias("w1"), F.xxhash64("held", F.lit(7)).alias("w2")]
    return rows.select(*_KEY, "i", "last", F.col("low.h").alias("fp"), F.col("low.i").alias("fp_at"), *content)


def repeated_runs(docs: DataFrame, min_words: int = 5) -> DataFrame:
    """(key, runs): per document with later repeats, its sorted runs of lines (first, last)."""
    all_windows = staged(windows(docs, min_words), "windows")
    place = F.struct(*_KEY, "fp_at")
    shared = all_windows.groupBy("fp").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a < b").select("fp")
    near = staged(all_windows.join(staged(shared, "shared"), "fp"), "near")
    at = F.struct(*_KEY, "i")
    first = near.groupBy("w1", "w2").agg(F.min(at).alias("first"), F.max(at).alias("final")).where("first < final")
    later = near.join(staged(first.select("w1", "w2", "first"), "first"), ["w1", "w2"]).where(at > F.col("first"))
    order = Window.partitionBy(*_KEY).orderBy("i")
    reach = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(F.col("i") <= reach + 1, 0).otherwise(1)
    runs = later.select(*_KEY, "i", "last", fresh.alias("fresh")).withColumn("run", F.sum("fresh").over(order))
    runs = runs.groupBy(*_KEY, "run").agg(F.min("i").alias("first"), F.max("last").alias("last"))
    return runs.groupBy(*_KEY).agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("_runs"))


def dedup_lines(docs: DataFrame, min_words: int = 5) -> DataFrame:
    """docs with text less its later repeated lines, and n_lines and n_removed.

    A line goes if it lies in a window (the shortest run of lines from some line on with `min_words` words or more, blank
    lines aside) that also occurs earlier: in a smaller doc_id, or further up in the same text. Lines are compared trimmed of
    spaces; words are what single spaces part. Null text stays null with no lines. A null doc_id counts as smallest. Rows
    that agree in doc_id and text are one document and get the same text. Other columns pass through.
    """
    keep = docs.columns
    joined = _keyed(docs).join(staged(repeated_runs(docs, min_words), "runs"), _KEY, "left")
    lines = F.split("text", "\n")
    runs = F.coalesce("_runs", F.expr("cast(array() as array<struct<first:int,last:int>>)"))
    joined = joined.withColumns({"_lines": lines, "_runs": runs})
    gone = F.expr("aggregate(_runs, 0L, (n, r) -> n + r.last - r.first + 1)")
    gaps = F.expr(
        "transform(sequence(0, size(_runs)), k -> slice(_lines, if(k = 0, -1, get(_runs, k - 1).last) + 2,"
        " coalesce(get(_runs, k).first, size(_lines)) - if(k = 0, -1, get(_runs, k - 1).last) - 1))"
    )
    text = F.when(F.size("_runs") == 0, F.col("text")).otherwise(F.array_join(F.flatten(gaps), "\n"))
    n = F.coalesce(F.size("_lines"), F.lit(0)).cast("long")
    return joined.select(*[text.alias(c) if c == "text" else F.col(c) for c in keep], F.greatest(n, F.lit(0)).alias("n_lines"), gone.alias("n_removed"))
