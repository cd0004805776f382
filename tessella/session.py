"""Session settings, scratch tables and their removal, and partition spreading."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "tessella", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time and adaptive execution; ``conf`` wins over the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_scratch: list[str] = []


def scratch_path(spark: SparkSession) -> str:
    """A fresh path under the shared folder the session names in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster a
    machine-local path would not outlive the executor or driver that wrote it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        sc = spark.sparkContext
        root = sc.getCheckpointDir()
        if not root:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="tessella-"))
            root = sc.getCheckpointDir()
    path = f"{root.rstrip('/')}/tessella-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def cleanup(spark: SparkSession) -> int:
    """Delete the scratch tables that this process wrote and return how many there were.

    Plans that still read them fail afterwards, so call it when their results are stored.
    """
    conf, removed = spark._jsc.hadoopConfiguration(), 0
    while _scratch:
        path = spark._jvm.org.apache.hadoop.fs.Path(_scratch.pop())
        removed += bool(path.getFileSystem(conf).delete(path, True))
    return removed


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Own the scratch tables written inside the block: they are deleted at its end."""
    kept = _scratch[:]
    _scratch.clear()
    try:
        yield
    finally:
        cleanup(spark)
        _scratch.extend(kept)


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back.

    Cuts the lineage, survives lost executors, and gives later plans exact file
    sizes, so Spark itself decides whether a join side is small enough to broadcast.
    """
    path = scratch_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def durable_by(df: DataFrame, key: str, path: str | None = None) -> DataFrame:
    """Store ``df`` dealt by ``key`` and read it back so that Spark knows the dealing.

    Later groupings on the key, alone or with other columns, need no exchange.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"tessella_{uuid.uuid4().hex}"
    writer = df.repartition(n, key).write.mode("overwrite").bucketBy(n, key).option("path", path)
    writer.format("parquet").saveAsTable(name)
    return spark.table(name)


def spread(df: DataFrame, per_core: int = 2) -> DataFrame:
    """Spread a *scan* over the cores when its files give too few partitions.

    Rows are dealt in turn, by no key, so later plans are the same as without it. A large
    input already has more splits than this and is returned unchanged. Pass a scan (or a
    projection of one): counting partitions above a shuffle would run that shuffle.
    """
    wanted = df.sparkSession.sparkContext.defaultParallelism * per_core
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted)
