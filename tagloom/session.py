"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()
_own_scratch: dict[str, str] = {}

SPLIT_BYTES = 128 << 20
UNKNOWN_BYTES = 1 << 58  # Spark's stand-in for what it cannot size is larger


def build_session(app: str = "tagloom", **conf: str) -> SparkSession:
    """A session for local use and tests; a cluster brings its own."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return ship(builder.getOrCreate())


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).parent
        archive = Path(tempfile.mkdtemp(prefix="tagloom-")) / "tagloom.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for source in sorted(package.rglob("*.py")):
                z.write(source, source.relative_to(package.parent))
        context.addPyFile(str(archive))
        _shipped.add(context.applicationId)
    return spark


def cores(spark: SparkSession) -> int:
    """Tasks the session can run at once."""
    return spark.sparkContext.defaultParallelism


def splits(df: DataFrame) -> int:
    """About how many input splits the tables have that a frame reads, from their sizes.

    Sizes of joins are products and say nothing; a leaf of unknown size counts as small.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    return sum(size for size in sizes if size < UNKNOWN_BYTES) // SPLIT_BYTES + 1


#: Plan nodes that cost little beside reading the table again.
_PLAIN = {"Project", "Filter", "LogicalRelation", "DataSourceV2ScanRelation", "DataSourceV2Relation", "InMemoryRelation"}


def is_scan(df: DataFrame) -> bool:
    """Whether a frame is a stored table with at most filters and JVM expressions on it."""
    todo = [df._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName().split(" ")[0] not in _PLAIN:
            return False
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return True


def spread(df: DataFrame, tasks: int | None = None) -> DataFrame:
    """Spread costly row work over `tasks`, or over all cores when the input has few splits.

    A table with at least as many splits as cores stays where it is.
    """
    if tasks is None and splits(df) >= cores(df.sparkSession):
        return df
    return df.repartition(tasks or tasks_for(df))


def tasks_for(df: DataFrame) -> int:
    """As many tasks as there are cores, and more where the data needs more splits."""
    return max(cores(df.sparkSession), splits(df))


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named in spark.checkpoint.dir; one of our own only where unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_scratch:
        _own_scratch[app] = tempfile.mkdtemp(prefix="tagloom-")
    return _own_scratch[app]


def new_folder(spark: SparkSession, label: str) -> str:
    """Path of a folder under the shared scratch folder that nobody has used."""
    return f"{scratch_root(spark).rstrip('/')}/tagloom/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts lineage, so that costly steps before it run once and lost executors
    do not bring them back. `codec` compresses it; whole texts take a third less by zstd.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)
