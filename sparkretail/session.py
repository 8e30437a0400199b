"""SparkSession factory and shared-storage helpers.

Every operator in this package is a lazy ``DataFrame -> DataFrame`` function;
the session only pins the settings the semantics depend on (UTC session time
zone, ANSI casts) and turns on adaptive execution.
"""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Settings the library relies on. ANSI makes strict casts fail loudly (the
# reference's cast/parse_date), try_* functions are the lenient forms.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "sparkretail",
                shuffle_partitions: int | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's settings.

    On a cluster pass ``master=None`` and let spark-submit decide; tests pass
    ``local[*]`` and a small ``shuffle_partitions``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(BASE_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ship_package(spark)
    return spark


def pin_time_zone(spark: SparkSession) -> None:
    """Session time zone must be UTC for timestamp stamps and NTZ casts."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers, once per application: they find it
    wherever the driver was started."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix=f"{root.name}-code-")) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(archive))
    _SHIPPED.add(sc.applicationId)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session. Unset, it is an error on a cluster, whose executors
    do not see each other's folders; a ``local[n]`` session is one machine and
    gets a folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="sparkretail-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def _scratch_folder(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/sparkretail/{spark.sparkContext.applicationId}"


#: scratch paths handed out within each open ``temporary`` block
_TEMPORARY: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path in this application's part of the shared
    checkpoint folder."""
    path = f"{_scratch_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    if _TEMPORARY:
        _TEMPORARY[-1].append(path)
    return path


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def temporary(spark: SparkSession):
    """Scratch tables that are made within the block are deleted at its end:
    for intermediate results that nothing reads any more."""
    _TEMPORARY.append([])
    try:
        yield
    finally:
        for path in _TEMPORARY.pop():
            _delete(spark, path)


def materialize(df, name: str = "table", rows_per_file: int = 0):
    """Cut the lineage of a DataFrame that several jobs reuse: written once as
    Parquet to the shared folder (survives executor loss, unlike a cache, and
    each reader decodes only its columns). Files have ``rows_per_file`` at most, if given."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("maxRecordsPerFile", rows_per_file).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def content_key(spark: SparkSession, folder: str) -> str:
    """A hash over the names, sizes and times of all files below a folder:
    what is derived from its tables is stale once it changes. File metadata
    only; one row reaches the driver."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
             .select("path", "length", "modificationTime"))
    parts = F.xxhash64("path", "length", "modificationTime")
    row = files.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("size"),
                    F.bit_xor(parts).alias("names")).first()
    return f"{row.n}-{row.size}-{row.names}"


_STORED: dict[tuple[str, str, str], tuple[str, object]] = {}


def kept_once(spark: SparkSession, name: str, sf_dir: str, build, refresh: bool = False):
    """What ``build()`` gives, kept for every later use in the same application
    over the same input. Input that has changed since (``content_key``), or
    ``refresh``, builds anew; only the latest result is kept."""
    key, content = (spark.sparkContext.applicationId, sf_dir, name), content_key(spark, sf_dir)
    if refresh or key not in _STORED or _STORED[key][0] != content:
        _STORED[key] = content, build()
    return _STORED[key][1]


def stored_once(spark: SparkSession, name: str, sf_dir: str, build, refresh: bool = False):
    """The table that ``build()`` gives, written on first use and read back by
    every later query of the same application over the same input."""
    def write():
        df = build()
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return path, df.schema

    path, schema = kept_once(spark, name, sf_dir, write, refresh)
    return spark.read.schema(schema).parquet(path)


#: rows that one task sorts or sums in memory, more than once, without spilling
BUCKET_ROWS = 250_000


def parts_for(spark: SparkSession, rows: int = 0) -> int:
    """Three parts a core, but no more than shuffle partitions; more where the
    rows need them, so that a part does not grow with the table."""
    few = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism)
    return max(few, -(-rows // BUCKET_ROWS))


def in_parts(df, rows: int):
    """``df``, which has ``rows`` rows, in as many parts at least as bound a part's
    rows: for work that keeps, or sends to other executors, whole parts. Left as it
    is if it has them, however the session splits files."""
    needed = -(-rows // BUCKET_ROWS)
    return df if needed < 2 or df.rdd.getNumPartitions() >= needed else df.repartition(needed)


def bucketed_once(spark: SparkSession, name: str, sf_dir: str, build, by: str, sort: tuple[str, ...], refresh: bool = False,
                  rows=None):
    """``stored_once`` as a table bucketed by a key and sorted within: windows,
    group-bys and joins on that key read it without an exchange. As many buckets
    as ``parts_for`` gives for ``rows()``, about the number of rows to expect; each
    is written by one task."""
    def write() -> str:
        most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000"))
        buckets = min(parts_for(spark, rows() if rows else 0), most)
        table = f"{name}_{uuid.uuid4().hex[:12]}"
        (build().repartition(buckets, by).write.bucketBy(buckets, by).sortBy(*sort)
         .option("path", scratch_path(spark, name)).saveAsTable(table))
        return table

    return spark.table(kept_once(spark, name, sf_dir, write, refresh))


def forget_stored() -> None:
    """Let every table and model be built anew on its next use."""
    _STORED.clear()


def drop_scratch(spark: SparkSession) -> None:
    """Delete all scratch tables of this application in the shared folder and
    forget what was stored in them. Call it when no result is read any more."""
    forget_stored()
    _delete(spark, _scratch_folder(spark))
