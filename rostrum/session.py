"""Session, table and materialisation helpers shared by every operator."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest number of rows that a lookup read to the driver may have.
MAX_LOOKUP_ROWS = 10_000
#: Tables in the shared folder that this process wrote.
_WRITTEN: list[str] = []


def session(app: str = "rostrum", cpus: int | str = "*", **conf: str) -> SparkSession:
    """A local session with the settings the operators are tested under."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    } | conf
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    spark = builder.config(map=settings).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    share_package(spark)
    return spark


def share_package(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it, whatever their working folder; on a cluster without a shared folder, ship it with --py-files."""
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if here not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, here])


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """One Parquet table, with only the named columns if any are named."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def spread(df: DataFrame, bytes_each: int = 8 << 20) -> DataFrame:
    """On one machine, deals a small table to all cores: a file of one row group would be read and worked on by one. Elsewhere, and where there is more than a few MB a core, nothing is moved."""
    sc = df.sparkSession.sparkContext
    alone = sc.master == "local" or sc.master.startswith("local[")
    small = alone and size_in_bytes(df) < bytes_each * sc.defaultParallelism
    return df.repartition(sc.defaultParallelism) if small else df


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors share.

    Only where it is unset and the master is local, as in tests on one machine, a
    temporary folder is set in its place; on a cluster that is an error.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", "") or spark.conf.get("spark.checkpoint.dir", "")
    if not path:
        current = sc._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return current.get()
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="rostrum-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        path = f"file://{path}"
        sc.setCheckpointDir(path)
    return path


def materialize(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Cut the lineage: write df as Parquet into the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    _WRITTEN.append(path)
    if path.startswith("file:"):
        atexit.register(shutil.rmtree, path.removeprefix("file://"), ignore_errors=True)
    return spark.read.schema(df.schema).parquet(path)


def drop_materialized(spark: SparkSession) -> int:
    """Deletes the tables that this process wrote to the shared folder; returns their number. To be called when no plan reads them any more."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    done = 0
    while _WRITTEN:
        path = hadoop(_WRITTEN.pop())
        done += bool(path.getFileSystem(conf).delete(path, True))
    return done


def lookup_rows(df: DataFrame, limit: int = MAX_LOOKUP_ROWS) -> list:
    """The rows of a reference table, on the driver, behind a check of its size."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"a lookup of more than {limit} rows; raise the limit knowingly or join it as a table")
    return rows


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def size_in_bytes(df: DataFrame) -> int:
    """What the optimizer takes a table's size to be: of files, their size on disk. Where it knows none, the rows' texts are measured."""
    known = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if known < 1 << 60:
        return known
    text = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema if f.dataType.typeName() in ("string", "binary")]
    row = sum(text, F.lit(8 * (len(df.columns) - len(text))))
    return int(df.agg(F.sum(row)).first()[0] or 0)


def parts_for(df: DataFrame, bytes_each: int, most: int = 60_000) -> int:
    """Parts into which a table's rows are dealt, so that a part holds about `bytes_each` at every size of the table; at least one a shuffle partition."""
    return min(max(partitions(df.sparkSession), -(-size_in_bytes(df) // bytes_each)), most)


def sql_list(values: list[str]) -> str:
    quoted = (v.replace("'", "''") for v in values)
    return ", ".join(f"'{v}'" for v in quoted)


def r6(column: Column | str) -> Column:
    """A double rounded to six places, so that results compare by value."""
    return F.round(F.col(column) if isinstance(column, str) else column, 6)


def env_dir(default: str = "/root/testdata/sf0.1") -> str:
    return os.environ.get("BENCH_SF_DIR", default)
