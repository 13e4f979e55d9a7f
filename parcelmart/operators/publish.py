"""Publish marts so that readers always find one whole version, and keep the intermediate tables of a run in order."""

from __future__ import annotations

import contextlib
import hashlib
import json
import tempfile
import uuid
from collections.abc import Iterator
from contextvars import ContextVar
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

VERSIONS, MANIFESTS = "_versions", "_manifests"
#: Shuffle files go when the query that wrote them ends: what is staged is read from the table and never computed again.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Conflict(RuntimeError):
    """Somebody else published the same target meanwhile."""


class _Files:
    """The file system of a path, whatever store it is in."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path(path).getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def names(self, folder: str) -> list[str]:
        if not self.exists(folder):
            return []
        return sorted(x.getPath().getName() for x in self.fs.listStatus(self.path(folder)))

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """A new file; fails if it is there."""
        stream = self.fs.create(self.path(name), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate data that driver and executors share, from ``spark.checkpoint.dir``.

    A local session without the setting gets a folder of its own; a cluster without it is an error, as no folder of one
    machine would do there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="parcelmart-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


@dataclass(frozen=True)
class Version:
    """A published version: its number, folder below the target, format and schema."""

    number: int
    folder: str
    fmt: str
    schema: StructType


def _manifest(files: _Files, base: str, name: str) -> Version | None:
    """The version a manifest names; None if the manifest is still being written, or its writer died meanwhile."""
    try:
        held = json.loads(files.read(f"{base}/{MANIFESTS}/{name}"))
        return Version(int(name.removesuffix(".json")), held["folder"], held["format"], StructType.fromJson(held["schema"]))
    except (ValueError, KeyError):
        return None


def versions(spark: SparkSession, target: str) -> list[Version]:
    """The versions of ``target`` that can be read, oldest first."""
    base = target.rstrip("/")
    files = _Files(spark, base)
    found = (_manifest(files, base, n) for n in files.names(f"{base}/{MANIFESTS}") if n.endswith(".json"))
    return [v for v in found if v]


def published(spark: SparkSession, target: str, number: int | None = None) -> DataFrame:
    """The newest version of ``target``, or the one of that number while it is kept."""
    held = [v for v in versions(spark, target) if number in (None, v.number)]
    if not held:
        raise FileNotFoundError(f"no published version {'' if number is None else number} in {target}")
    return _read(spark, target, held[-1])


def _read(spark: SparkSession, target: str, v: Version) -> DataFrame:
    return spark.read.schema(v.schema).format(v.fmt).load(f"{target.rstrip('/')}/{v.folder}").select(*v.schema.names)


def publish(
    df: DataFrame,
    target: str,
    fmt: str = "parquet",
    partition_by: tuple[str, ...] = (),
    distinct: bool = True,
    keep: int = 2,
    view: str | None = None,
) -> DataFrame:
    """Full refresh of ``target``: one write into a new version's folder, then a manifest that names it.

    Nothing is renamed or replaced, so this is as good on an object store as on a file system. Readers (``published``) take the
    newest manifest; until the new one is there they read the version before, whose files stay. A run that stops at any
    point leaves one whole version, and what it left half done is removed by the next. Manifests are numbered and created, never
    overwritten: of two runs that started from the same version one raises Conflict and leaves nothing. (Where a store lets
    two clients create one file at the same instant, run one writer per target.) The last ``keep`` versions stay for readers
    that have begun. ``view`` names a catalog view that is pointed at the new version. The result is read back, so whatever is
    built on it starts from files and not from this plan.
    """
    if keep < 1:
        raise ValueError("keep at least the version that is published")
    spark = df.sparkSession
    base = target.rstrip("/")
    files = _Files(spark, base)
    number = max((int(n.removesuffix(".json")) for n in files.names(f"{base}/{MANIFESTS}") if n.endswith(".json")), default=0) + 1
    folder = f"{VERSIONS}/{number:010d}-{uuid.uuid4().hex}"
    rows = df.distinct() if distinct else df
    version = Version(number, folder, fmt, StructType([f for f in rows.schema.fields]))
    writer = rows.write.format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(f"{base}/{folder}")
    _commit(files, base, version)
    if view:
        spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {fmt}.`{base}/{folder}`")
    _retain(files, base, versions(spark, base), keep)
    return _read(spark, base, version)


def _commit(files: _Files, base: str, version: Version) -> None:
    name = f"{base}/{MANIFESTS}/{version.number:010d}.json"
    text = json.dumps({"folder": version.folder, "format": version.fmt, "schema": version.schema.jsonValue()})
    try:
        if files.exists(name):
            raise Conflict(f"{base} was published by another run")
        files.create(name, text)
    except Exception as error:
        held = _manifest(files, base, name.rpartition("/")[2]) if files.exists(name) else None
        if held and held.folder == version.folder:
            return
        files.delete(f"{base}/{version.folder}")
        if held and not isinstance(error, Conflict):
            raise Conflict(f"{base} was published by another run") from error
        raise


def _retain(files: _Files, base: str, held: list[Version], keep: int) -> None:
    """Remove versions and manifests older than the last ``keep``, and folders of runs that can commit no more."""
    kept, last = held[-keep:], held[-1].number
    for name in files.names(f"{base}/{MANIFESTS}"):
        if name.endswith(".json") and int(name.removesuffix(".json")) < kept[0].number:
            files.delete(f"{base}/{MANIFESTS}/{name}")
    folders = {v.folder for v in kept}
    for name in files.names(f"{base}/{VERSIONS}"):
        if f"{VERSIONS}/{name}" not in folders and int(name.partition("-")[0]) <= last:
            files.delete(f"{base}/{VERSIONS}/{name}")


_run: ContextVar[str | None] = ContextVar("run", default=None)


@contextlib.contextmanager
def run(spark: SparkSession, name: str | None = None) -> Iterator[str]:
    """A run whose staged tables lie in one folder, which goes when the run ends well.

    After a failure a run with a ``name`` leaves them; the next run of that name reads those that are whole and whose plan and
    input files are the same, and computes the others. A run without a name leaves nothing either way. Runs don't nest: an inner
    one belongs to the outer.
    """
    if _run.get():
        yield _run.get()
        return
    folder = f"{shared_folder(spark)}/run-{name or uuid.uuid4().hex}"
    token = _run.set(folder)
    try:
        yield folder
    except BaseException:
        if name is None:
            _Files(spark, folder).delete(folder)
        raise
    else:
        _Files(spark, folder).delete(folder)
    finally:
        _run.reset(token)


def fingerprint(df: DataFrame) -> str | None:
    """What the rows of ``df`` follow from: its plan and input files. None if it starts from anything but files."""
    plan = df._jdf.queryExecution().analyzed().canonicalized()
    leaves = plan.collectLeaves()
    if any(leaves.apply(i).getClass().getSimpleName() != "LogicalRelation" for i in range(leaves.size())):
        return None
    fields = "spark.sql.debug.maxToStringFields"
    before = df.sparkSession.conf.get(fields)
    df.sparkSession.conf.set(fields, str(2**31 - 1))
    try:
        text = plan.toString()
    finally:
        df.sparkSession.conf.set(fields, before)
    return hashlib.sha256("\n".join([text, df.schema.json(), *sorted(df.inputFiles())]).encode()).hexdigest()


def stage(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back, which cuts its lineage; columnar files keep column pruning.

    Within a ``run`` the table lies in the run's folder and goes with it. zstd makes it smaller than the shuffle it replaces.
    """
    spark, folder = df.sparkSession, _run.get()
    same = fingerprint(df) if folder else None
    path = f"{folder or shared_folder(spark)}/stage-{same or uuid.uuid4().hex}"
    if not (same and _Files(spark, path).exists(f"{path}/_SUCCESS")):
        before = spark.conf.get(CLEAN_UP, "false")
        spark.conf.set(CLEAN_UP, "true")
        try:
            df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        finally:
            spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete staged tables that nothing will read again; other tables are left as they are.

    Those of a ``run`` stay until its end: a restarted run of the same name takes them over.
    """
    if _run.get():
        return
    for table in tables:
        spark = table.sparkSession
        files = _Files(spark, shared_folder(spark))
        own = files.fs.makeQualified(files.path(shared_folder(spark))).toUri().getPath()
        for folder in {f.rpartition("/")[0] for f in table.inputFiles()}:
            path = files.path(folder).toUri().getPath()
            if path.startswith(f"{own}/stage-"):
                files.delete(folder)
