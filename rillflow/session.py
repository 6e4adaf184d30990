"""Session set-up for tests and benchmarks, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from rillflow.sources.paths import delete


def local_session(app: str = "rillflow", cpus: int | str = 8, **conf: str) -> SparkSession:
    """A local session. On a cluster the caller brings a session of its own."""
    settings = {
        "spark.sql.shuffle.partitions": str(cpus if str(cpus).isdigit() else 8),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    Only a local master may fall back to a folder of its own; a cluster without
    the setting is an error, since a machine-local folder dies with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    fallback = tempfile.mkdtemp(prefix="rillflow-")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def _own_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/rillflow-{spark.sparkContext.applicationId}"


_scope: ContextVar[list[str] | None] = ContextVar("scratch scope", default=None)


def new_scratch(spark: SparkSession, name: str) -> str:
    """A fresh, not yet existing path below the shared scratch folder."""
    path = f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if _scope.get() is not None:
        _scope.get().append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Scratch folders named inside the block are deleted at its end.

    For a unit of work whose results are stored elsewhere by then, such as a
    batch of a stream.
    """
    made: list[str] = []
    token = _scope.set(made)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in made:
            delete(spark, path)


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote to scratch, once its results are stored elsewhere."""
    delete(spark, _own_folder(spark))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared scratch folder and read back.

    Used where a result feeds several plans or closes one round of an iteration.
    The written table survives lost executors, cuts the lineage, and later reads
    still prune columns and push filters.
    """
    path = new_scratch(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is written inside the block leaves no shuffle files behind.

    Otherwise they stay on the executors' disks until the driver happens to
    collect its garbage, those of every round of an iteration.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def settled(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """:func:`materialize` for what ``make`` returns; the scratch folders and shuffle files of the making are freed."""
    path = new_scratch(spark, name)
    with scratch_scope(spark), freed_shuffles(spark):
        df = make()
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def over_cores(scan: DataFrame, key: str) -> DataFrame:
    """Deal out a scan that has fewer splits than there are cores, by its key.

    For work that is heavy per row. A table of many splits comes back as it is,
    without a shuffle. Only for a plain scan: the splits are known from its plan.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= cores:
        return scan
    return scan.repartition(cores, key)
