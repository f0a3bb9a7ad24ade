"""Session helpers shared by all operators."""

from __future__ import annotations

import contextlib
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tracemill", cores: int | str = "*", shuffle: int = 8, **conf: str) -> SparkSession:
    """A local session with the settings that the tests and the bench use."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Reads one Parquet table; columns, if given, reach the scan."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


#: what :func:`spread` moves at most, by the optimizer's estimate
SPREAD_BYTES = 256 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor can read, from ``spark.checkpoint.dir``.

    Only where the session names none and runs in this one process (tests, a laptop) a
    folder of this machine is made and remembered in the session; on a cluster it is an error.
    """
    key = "spark.checkpoint.dir"
    found = spark.conf.get(key, None) or spark.sparkContext.getConf().get(key)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError(f"set {key} to a folder that all executors share; {spark.sparkContext.master} can't use one of this machine")
        made = spark.conf.get("spark.tracemill.localShared", None)
        if not made:
            made = tempfile.mkdtemp(prefix="tracemill-")
            spark.conf.set("spark.tracemill.localShared", made)
        found = made
    return found.rstrip("/")


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Cuts lineage by writing df to the shared folder and reading it back.

    The copy outlives any executor. Columns and types stay as they are.
    """
    path = f"{shared_dir(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_written: list[str] = []


def release(spark: SparkSession, since: int = 0) -> None:
    """Removes the tables that :func:`materialize` wrote in this process, but for the first ``since``; plans over them can't be read after."""
    jvm = spark.sparkContext._jvm
    while len(_written) > since:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """Removes at its end what was materialized inside; results must be written by then."""
    since = len(_written)
    try:
        yield
    finally:
        release(spark, since)


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt over all cores where df is a small table of fewer partitions than cores; else df as it is.

    For work that costs far more than moving a row. No more than ``SPREAD_BYTES`` are moved,
    whatever the cluster's size.
    """
    want = df.sparkSession.sparkContext.defaultParallelism
    plan = df._jdf.queryExecution()
    if int(str(plan.optimizedPlan().stats().sizeInBytes())) > SPREAD_BYTES:
        return df
    have = plan.toRdd().getNumPartitions()
    return df.repartition(want) if 0 < have < want else df


def by_key(df: DataFrame, *keys: str) -> DataFrame:
    """Rows of equal keys together, in as many partitions as a shuffle has or, if these are more, as there are cores.

    For functions of groups that cost far more than their rows' bytes tell: a shuffle by number isn't
    coalesced, so the groups stay spread over all cores.
    """
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism), *keys)


def ship_by_value(*modules) -> None:
    """Lets Python workers run functions of these modules without importing them.

    The functions travel inside the task, so executors need no copy of the library.
    """
    from pyspark import cloudpickle

    for m in modules:
        cloudpickle.register_pickle_by_value(m)


def env_path(name: str, default: str) -> str:
    return os.environ.get(name, default)
