"""Session helpers: the shared scratch folder and tables written into it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def get_session(app_name: str = "termloom", **conf: str) -> SparkSession:
    """A session with adaptive execution on; everything else is the cluster's choice."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a temporary one only for a local session without it."""
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_DIR} must name a folder that all executors share")
        app = context.applicationId
        if app not in _local_roots:
            _local_roots[app] = tempfile.mkdtemp(prefix="termloom-")
        root = _local_roots[app]
    return root.rstrip("/")


class Scratch:
    """Paths handed out while this is open, to be deleted together.

        with Scratch() as scratch:
            ...
        scratch.close()

    Leaving the block keeps the files, as lazy results still read them; ``close`` deletes them.
    """

    _open: list[Scratch] = []

    def __init__(self):
        self.paths: list[tuple[SparkSession, str]] = []

    def __enter__(self) -> Scratch:
        Scratch._open.append(self)
        return self

    def __exit__(self, *_) -> None:
        Scratch._open.remove(self)

    def close(self) -> None:
        for spark, path in self.paths:
            jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jvm_path, True)
        self.paths.clear()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the scratch folder that nothing has used before."""
    app = spark.sparkContext.applicationId
    path = f"{scratch_root(spark)}/{app}/{label}-{uuid.uuid4().hex}"
    if Scratch._open:
        Scratch._open[-1].paths.append((spark, path))
    return path


def materialize(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """Write ``df`` as a table and read it back: lineage is cut, lost executors cost nothing.

    ``by`` names a column of few values whose rows get files of their own, so that a filter on it opens no others.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = df.write if by is None else df.write.partitionBy(by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
