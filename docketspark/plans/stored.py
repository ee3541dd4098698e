"""Tables written between the steps of an operator: the shared folder, blocks that delete them, totals of hot groups."""

from __future__ import annotations

import contextvars
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Paths of the tables written inside each `scratch` block that is open here, the innermost last.
_owned: contextvars.ContextVar[tuple[list[str], ...]] = contextvars.ContextVar("owned", default=())

#: Blocks that are open in each session, and the session's own setting.
_open: dict[str, list] = {}
_lock = threading.Lock()
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors and the driver can reach, as `spark.checkpoint.dir` names it.

    A local session without the setting gets a temporary folder; on a cluster the setting is required,
    as executors would write to their own disks.
    """
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or getattr(spark.sparkContext, "_own_shared", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = spark.sparkContext._own_shared = tempfile.mkdtemp(prefix="shared-")
    return folder.rstrip("/")


@contextmanager
def _shuffles_dropped(spark: SparkSession):
    """Queries run inside the block delete their shuffle files as they end, not when the driver next collects garbage.

    The session's own setting holds again after the last of the blocks that are open at once, in
    whatever order threads leave them. A task lost within a query still finds its files.
    """
    session = spark._jsparkSession.sessionUUID()
    with _lock:
        if session not in _open:
            _open[session] = [0, spark.conf.get(_CLEANUP)]
            spark.conf.set(_CLEANUP, "true")
        _open[session][0] += 1
    try:
        yield
    finally:
        with _lock:
            _open[session][0] -= 1
            if not _open[session][0]:
                spark.conf.set(_CLEANUP, _open.pop(session)[1])


def written(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Writes df as Parquet in the shared folder and reads it back: lineage ends there, and the write's shuffle files go.

    A surrounding `scratch` block deletes the table at its end; with keep, the block around that one
    does. Without a block it stays as long as the folder does, since a lazy result may still read it.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    with _shuffles_dropped(spark):
        df.write.parquet(path)
    blocks = _owned.get()[: -1 if keep else None]
    if blocks:
        blocks[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, paths: list[str]) -> None:
    """Deletes these folders."""
    conf = spark._jsc.hadoopConfiguration()
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)


@contextmanager
def scratch(spark: SparkSession):
    """Tables written inside the block, and those only, are deleted at its end: store what is built on them within it, with keep."""
    own: list[str] = []
    mark = _owned.set((*_owned.get(), own))
    try:
        yield
    finally:
        _owned.reset(mark)
        removed(spark, own)


def with_group(df: DataFrame, keys: list[str], by: str, **totals: tuple) -> DataFrame:
    """df with totals of each group of `keys` on all of its rows, no key's rows ever in one task.

    Totals are built and handed back by 64 parts of a group, told apart by a hash of the column `by`.
    Each total is (F.sum, F.min or F.max, column); df is read twice, and rows whose key is null go.
    """
    part = fresh(df, "part")
    split = df.withColumn(part, F.pmod(F.xxhash64(by), F.lit(64)).cast("int"))
    local = split.groupBy(*keys, part).agg(*[kind(c).alias(n) for n, (kind, c) in totals.items()])
    whole = local.groupBy(*keys).agg(*[kind(n).alias(n) for n, (kind, _) in totals.items()])
    return split.join(local.select(*keys, part).join(whole, keys), [*keys, part]).drop(part)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df does not have, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
