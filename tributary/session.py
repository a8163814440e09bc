"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_LOCAL_BASE: dict[str, str] = {}
_SHIPPED: set[str] = set()


def build_session(app: str = "tributary", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tuned for.

    Adaptive execution splits skewed join partitions and coalesces small ones;
    the broadcast threshold stays at Spark's default so that a side is only
    broadcast when its size is known to be small.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Give the workers this package, once per application.

    Functions that run in tasks are pickled by module name, so workers must be
    able to import the modules; Spark serves the archive from the driver.
    """
    context, home = spark.sparkContext, Path(__file__).parent
    if context.applicationId in _SHIPPED or not home.is_dir():
        return
    _SHIPPED.add(context.applicationId)
    # a place of the driver alone; the JVM may see the process-relative name differently
    archive = Path(tempfile.mkdtemp(prefix="tributary-code-")).resolve() / "tributary_package.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(home.rglob("*.py")):
            out.write(source, Path(home.name, source.relative_to(home)))
    context.addPyFile(str(archive))


def use_utc(spark: SparkSession) -> SparkSession:
    """Event times carry no zone; read and print them as UTC."""
    ship_package(spark)
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_base(spark: SparkSession) -> str:
    """The folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session
    without that setting gets a temporary folder of its own.
    """
    ship_package(spark)
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    context = spark.sparkContext
    app = context.applicationId
    if app not in _LOCAL_BASE:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        _LOCAL_BASE[app] = tempfile.mkdtemp(prefix="tributary-")
        context.setCheckpointDir(_LOCAL_BASE[app])
    return _LOCAL_BASE[app]


def work_dir(spark: SparkSession, kind: str) -> str:
    """A new, not yet existing folder path below the shared base."""
    return f"{shared_base(spark)}/tributary/{kind}-{uuid.uuid4().hex[:12]}"


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a static plan."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def plainly_small(df: DataFrame, limit: int) -> bool:
    """Whether a measuring job may be skipped; results do not depend on it.

    An estimate does not count what an explode or a Python function adds, so
    such plans are never taken for small.
    """
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    grows = any(name in plan for name in ("Generate ", "Expand ", "MapInPandas", "MapInArrow", "FlatMapGroups"))
    return not grows and estimated_bytes(df) <= limit


def settled(df: DataFrame) -> DataFrame:
    """Compute a result once and read it back from the shared folder.

    Its size is then known, so Catalyst broadcasts it exactly when it is small
    and the other side of a join is not shuffled in vain.
    """
    path = work_dir(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def on_one_machine(spark: SparkSession) -> bool:
    """Whether tasks run in the driver; ``local-cluster`` has executors of its own."""
    master = spark.sparkContext.master
    return master.startswith("local") and not master.startswith("local-cluster")


def state_partitions(spark: SparkSession) -> int:
    """Shuffle (and so state) partitions for a streaming query.

    ``spark.tributary.statePartitions`` wins, then an explicit number of shuffle
    partitions; otherwise there is one per core.  Every state partition syncs
    files in every micro-batch, so without the setting a local session, with
    one disk for all of them, takes a quarter of its cores.
    """
    context = spark.sparkContext
    chosen = spark.conf.get("spark.tributary.statePartitions", None)
    if chosen:
        return int(chosen)
    if on_one_machine(spark):
        return max(1, context.defaultParallelism // 4)
    explicit = context.getConf().get("spark.sql.shuffle.partitions", None)
    current = spark.conf.get("spark.sql.shuffle.partitions")
    return int(current) if explicit or current != "200" else context.defaultParallelism


def python_state(spark: SparkSession) -> dict[str, str]:
    """Setting for queries whose state functions run in Python.

    Their cost is the Python workers, so without ``spark.tributary.statePartitions``
    a local session takes half its cores.
    """
    context = spark.sparkContext
    if spark.conf.get("spark.tributary.statePartitions", None) or not on_one_machine(spark):
        return {}
    return {"spark.sql.shuffle.partitions": str(max(1, context.defaultParallelism // 2))}


def bounded_state(spark: SparkSession) -> dict[str, str]:
    """Settings for Python state functions whose state grows with the table.

    A store keeps what is written to it in native memory, beside the heap, until
    64 MB are full.  So on a cluster there is at most one store a core, however
    many shuffle partitions are set, and those of an executor share a bound.
    ``spark.tributary.statePartitions`` wins here too.
    """
    settings = python_state(spark) | {
        "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
        "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "100",
    }
    if not on_one_machine(spark) and not spark.conf.get("spark.tributary.statePartitions", None):
        settings["spark.sql.shuffle.partitions"] = str(min(state_partitions(spark), spark.sparkContext.defaultParallelism))
    return settings


def streaming_session(spark: SparkSession, **conf: str) -> SparkSession:
    """A sibling session whose settings do not leak into the caller's."""
    sibling = spark.newSession()
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(state_partitions(spark)),
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        # commit only the changes of a micro-batch, not a whole snapshot of the store
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        # progress tables are read after a query's end and must be whole
        "spark.sql.streaming.numRecentProgressUpdates": "100000",
        **conf,
    }
    for key, value in settings.items():
        sibling.conf.set(key, value)
    return sibling
