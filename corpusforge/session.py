"""Session helpers: a local session for tests, and lineage cutting that outlives an executor."""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """A one-machine session for tests and the bench; clusters bring their own session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("corpusforge")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A local session without that setting gets a fresh temporary folder; a cluster session
    without it is an error, since a machine-local folder would be lost with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    made = tempfile.mkdtemp(prefix="corpusforge-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


_scratch: contextvars.ContextVar[str | None] = contextvars.ContextVar("corpusforge_scratch", default=None)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A database in the shared folder for the tables that ``cut_lineage`` writes inside the block.

    It goes with all its tables when the block ends, so a stage leaves only its outputs. What the
    block returns must have been computed or written before. A block inside another has its own.
    """
    name = f"corpusforge_{uuid.uuid4().hex}"
    place = f"{shared_dir(spark).rstrip('/')}/corpusforge/{name}".replace("'", "\\'")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{place}'")
    token = _scratch.set(name)
    try:
        yield name
    finally:
        _scratch.reset(token)
        spark.sql(f"DROP DATABASE {name} CASCADE")


def scratch_table(df: DataFrame, name: str) -> str:
    """Write ``df`` as a table of the scratch database around; its name, for ``drop_table``."""
    database = _scratch.get()
    if database is None:
        raise RuntimeError("use scratch_table inside scratch()")
    table = f"{database}.{name.replace('-', '_')}_{uuid.uuid4().hex}"
    df.write.format("parquet").saveAsTable(table)
    return table


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE {table}")


@contextlib.contextmanager
def tidy_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write go when it ends, for rounds that would otherwise pile them up."""
    before = spark.conf.get(TIDY, None)
    spark.conf.set(TIDY, "true")
    try:
        yield
    finally:
        spark.conf.unset(TIDY) if before is None else spark.conf.set(TIDY, before)


def cut_lineage(df: DataFrame, name: str, outlasts: bool = False) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and go on from that table.

    The table outlives executors, later plans start from it, and its size is known to Spark when
    it chooses between a broadcast and a shuffle. Inside ``scratch`` it goes with the block; outside
    it stays, since a returned plan may still read it; so does one that ``outlasts`` the block.
    """
    if _scratch.get() is not None and not outlasts:
        return df.sparkSession.table(scratch_table(df, name))
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/corpusforge/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(scan: DataFrame) -> DataFrame:
    """Rows of a file scan with fewer splits than twice the cores, dealt out evenly; else unchanged.

    For work that is heavy per row. A large input has splits enough and is left where it is. Only
    for scans: the number of splits of a plan with shuffles is not known before it has run.
    """
    wanted = 2 * scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(wanted) if scan.rdd.getNumPartitions() < wanted else scan


def dealt(df: DataFrame) -> DataFrame:
    """Rows dealt over twice the cores, for a derived table that is written once and read often."""
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism)


def tasks_for(spark: SparkSession, size: int, most: int = 64 << 20) -> int:
    """Shuffle partitions of at most ``most`` bytes each, never fewer than the session's own number."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // most))
