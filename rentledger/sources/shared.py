"""The folder that every executor can reach, and lineage cuts kept in it."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_LOCAL_FOLDERS: dict[str, str] = {}
_SCOPE: ContextVar[list[str] | None] = ContextVar("scope", default=None)


def shared_dir(spark: SparkSession) -> str:
    """Folder named by `spark.checkpoint.dir`, or set on the context.

    A session whose master is local may leave the setting out and gets a temporary folder of
    its own. On a cluster a missing setting is an error, as a machine-local folder would be lost with its
    machine. A `file:` path there is taken at its word: it must be a mount that all machines share.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS.setdefault(context.applicationId, tempfile.mkdtemp(prefix="rentledger-"))  # loads may share it
    return _LOCAL_FOLDERS[context.applicationId]


def durable(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the rows once below `folder`, the shared folder unless given, and go on from there.

    Reuse and lost executors then see the same rows. As a stored table they can
    be read in single columns, and their size is known when joins are planned. They are packed tightly, as all of them are
    written and read over the network. Inside `scratch` the rows go when it ends.
    """
    path = f"{folder or shared_dir(df.sparkSession)}/rows-{uuid.uuid4().hex}"
    if (scope := _SCOPE.get()) is not None and folder is None:
        scope.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Rows that `durable` stores inside the block in the shared folder are removed when it ends, also by an error.

    Write what is wanted of them before that: frames made inside the block cannot be read after it. Blocks may be
    nested, each owns what is stored directly in it. Other threads have a part in it if they run in a copy of the context.
    """
    made: list[str] = []
    before = _SCOPE.set(made)
    try:
        yield
    finally:
        _SCOPE.reset(before)
        for name in made:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What jobs planned inside the block have shuffled is removed as soon as each of them ends, for steps whose rows are stored.

    Else it stays on the executors' disks until the driver collects its garbage. This is the session's setting, put back at the end;
    frames that are run again shuffle again.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


#: Plans that give the same rows each time at the cost of reading them: stored tables and literal rows, in some columns, filtered.
_READ_AGAIN = {"LogicalRelation", "LocalRelation", "Range", "SubqueryAlias", "Project", "Filter"}


def stored_once(source: DataFrame) -> DataFrame:
    """The source itself where it can be read again: the same rows, for a scan at most. Else its rows, stored.

    Only stored tables, literal rows, columns and filters made of deterministic expressions are read again. Whatever else
    there is (a limit, a sample, random or time-dependent keys, subqueries, joins, groups, Python) is run once.
    """
    plan = source._jdf.queryExecution().analyzed()
    clock = source.sparkSession._jvm.org.apache.spark.sql.catalyst.trees.TreePattern.CURRENT_LIKE()
    nodes, plain = [plan], plan.subqueriesAll().isEmpty() and not plan.containsPattern(clock)
    while nodes and plain:
        node = nodes.pop()
        plain = node.getClass().getSimpleName() in _READ_AGAIN and node.deterministic()
        nodes.extend(node.children().apply(i) for i in range(node.children().size()))
    return source if plain else durable(source)
