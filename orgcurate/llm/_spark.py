"""Session helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application.

    Workers then import the operators as modules, so what a module keeps (token
    and word caches) lives as long as the worker process.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    with tempfile.NamedTemporaryFile(prefix=root.name, suffix=".zip", delete=False) as f:
        with zipfile.ZipFile(f, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(f.name)
    _SHIPPED.add(app)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below spark.checkpoint.dir, which driver and executors share.

    Only where the session names no such folder (tests, one machine) is a local
    one set, for checkpoint() as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = f"file://{tempfile.mkdtemp(prefix='orgcurate-shared-')}"
        spark.sparkContext.setCheckpointDir(base)
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """df written as a table in the shared folder and read again, and the table's path."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def written(df: DataFrame, name: str) -> DataFrame:
    """df written as a table in the shared folder and read again: cuts lineage, survives lost
    executors. The table stays as long as the folder, since results may be read from it later."""
    return written_at(df, name)[0]


def removed(spark: SparkSession, path: str) -> None:
    """Deletes a table of written_at that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_type(df: DataFrame, column: str) -> pa.DataType:
    return to_arrow_type(df.schema[column].dataType)
