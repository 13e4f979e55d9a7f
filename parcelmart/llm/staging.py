"""Intermediates in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Shuffle files go when the query that wrote them ends: what is staged is read from the table and never computed again.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """`spark.checkpoint.dir` of the session; a local session without it gets a folder of its own, a cluster an error."""
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoint-"))
        folder = sc.getCheckpointDir()
    return folder


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """The session with these settings, and as it was before at the end."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def staged(df: DataFrame, name: str) -> DataFrame:
    """The same rows from a table in the shared folder: cuts the lineage, and a lost executor costs only what it ran."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    with settings(spark, {CLEAN_UP: "true"}):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete staged tables that nothing will read again. Other tables are left as they are."""
    for table in tables:
        spark = table.sparkSession
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        own = jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
        own = own.getFileSystem(conf).makeQualified(own).toUri().getPath()
        for folder in {f.rpartition("/")[0] for f in table.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            if path.toUri().getPath().startswith(f"{own}/"):
                path.getFileSystem(conf).delete(path, True)


def text_key(text) -> list:
    """Two 64-bit hashes that stand for a text in joins; null counts as empty."""
    whole = F.coalesce(text, F.lit(""))
    return [F.xxhash64(whole).alias("_t1"), F.xxhash64(whole, F.lit(17)).alias("_t2")]


def components(edges: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(node, root) of every node of the undirected edges (a, b): root is the smallest node reachable.

    Contraction: every node goes to the least of itself and its neighbours, edges follow their ends, and those within one node
    go; so the table of edges shrinks with every round, by a constant share on average where names are hashes. A star takes two
    rounds. The smallest node of a component never moves, so it is what is left; the tables of moves, read backwards, give
    every node its root. Rounds are grouped minima and joins by node, which adaptive execution can split for a hub. `known` has
    the components of earlier edges: only what the new edges join is looked at then. Nothing reaches the driver.
    """
    two = edges.select("a", "b").where("a != b")
    if known is not None:
        two = _moved(two, known.withColumnsRenamed({"node": "a", "root": "m"}))
    left = staged(two.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "edges")
    moves: list[DataFrame] = []
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        moves.append(staged(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "moves"))
        after = _moved(left, moves[-1])
        after = staged(after.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "edges")
        discard(left)
        left = after
    roots = left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    for move in reversed(moves):
        further = roots.withColumnsRenamed({"node": "m"})
        roots = move.join(further, "m", "left").select(F.col("a").alias("node"), F.coalesce("root", "m").alias("root"))
    if known is not None:
        later = staged(roots, "roots")
        further = later.select(F.col("node").alias("root"), F.col("root").alias("_last"))
        first = known.join(further, "root", "left").select("node", F.coalesce("_last", "root").alias("root"))
        roots = first.unionByName(later.join(known.select("node"), "node", "left_anti"))
    return staged(roots, "roots")


def _moved(edges: DataFrame, moves: DataFrame) -> DataFrame:
    """Edges (a, b) with both ends where moves (a, m) puts them."""
    for end in ("a", "b"):
        to = moves.select(F.col("a").alias(end), F.col("m").alias("_to"))
        edges = edges.join(to, end, "left").withColumn(end, F.coalesce("_to", end)).drop("_to")
    return edges
