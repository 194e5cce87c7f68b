"""Tables in versions (K3, K4, K8): a change of records is a new version beside the old one.

Layout below one folder, of any file system that Spark writes to:

- data/<version>-<random>/: the records, as Parquet or JSON
- log/<version>: one line, the folder's name and format

A version is there when its line is in the log. The line is written beside the log and renamed
into place after all data are written; a rename never replaces a line. So a failed or
unfinished write changes nothing for readers, and of two writers that started from the same
version one gets a Conflict and may try again on the new version.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Conflict(Exception):
    """Another writer has made this version meanwhile."""


class _Folder:
    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self.at = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.at(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, below: str) -> list[str]:
        p = self.at(f"{self.path}/{below}")
        return [f.getPath().getName() for f in self.fs.listStatus(p)] if self.fs.exists(p) else []

    def put(self, name: str, text: str) -> None:
        """A file of that name, unless there is one."""
        aside, place = self.at(f"{self.path}/_new-{uuid.uuid4().hex}"), self.at(f"{self.path}/{name}")
        out = self.fs.create(aside, False)
        out.write(bytearray(text.encode()))
        out.close()
        self.fs.mkdirs(place.getParent())
        if self.fs.exists(place) or not self.fs.rename(aside, place):
            self.fs.delete(aside, False)
            raise Conflict(name)


def versions(spark: SparkSession, path: str) -> list[int]:
    """The numbers of all versions, ascending."""
    return sorted(int(n) for n in _Folder(spark, path).names("log") if re.fullmatch(r"\d+", n))


def _entry(spark: SparkSession, path: str, version: int | None) -> dict:
    known = versions(spark, path)
    if not known or (version is not None and version not in known):
        raise ValueError(f"{path} has no version {'' if version is None else version}".rstrip())
    return json.loads(spark.read.text(f"{path.rstrip('/')}/log/{known[-1] if version is None else version}").first().value)


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A version's records, the newest one's by default."""
    e = _entry(spark, path, version)
    return spark.read.schema(e["schema"]).format(e["format"]).load(f"{path.rstrip('/')}/data/{e['folder']}")


def write_version(df: DataFrame, path: str, based_on: int | None = None, fmt: str = "parquet") -> int:
    """Writes df as the version after `based_on` (by default the newest) and gives its number."""
    spark = df.sparkSession
    known = versions(spark, path)
    number = (known[-1] if based_on is None and known else based_on or 0) + 1
    folder = f"{number}-{uuid.uuid4().hex}"
    df.write.format(fmt).save(f"{path.rstrip('/')}/data/{folder}")
    _Folder(spark, path).put(f"log/{number}", json.dumps({"folder": folder, "format": fmt, "schema": df._jdf.schema().toDDL()}))
    return number


def update(spark: SparkSession, path: str, changed: DataFrame, key: str) -> int:
    """K8: records of `changed` take the place of those with their key, or are added, in a new version."""
    from ..operators.history import upsert

    newest = (versions(spark, path) or [0])[-1]
    old = read_version(spark, path, newest)
    return write_version(upsert(old, changed.select(*old.columns), key), path, newest)


def forget(spark: SparkSession, path: str, keep: int) -> list[int]:
    """Takes all versions but the `keep` newest away, and data that belong to none; gives the numbers that went.
    Not while another writer is at work."""
    f, known = _Folder(spark, path), versions(spark, path)
    gone = known[: max(0, len(known) - keep)]
    kept = {_entry(spark, path, v)["folder"] for v in known if v not in gone}
    for v in gone:
        f.fs.delete(f.at(f"{f.path}/log/{v}"), False)
    for name in f.names("data"):
        if name not in kept:
            f.fs.delete(f.at(f"{f.path}/data/{name}"), True)
    return gone


def write_each(df: DataFrame, uri: str, key: str) -> int:
    """K3: one JSON file for each record, named after the last part of its key, written by the tasks; gives their number.

    uri: a folder that all executors reach, of a file system that Arrow knows (file, hdfs, s3, gs). Files are written
    whole, under names that depend on the key alone, so that a repeated task writes the same ones. Keys must be unique and not null."""
    safe = F.regexp_replace(F.regexp_extract(F.col(key).cast("string"), r"([^/]+)/*$", 1), r"[^\w.\-]", "_")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(uri)
        store.create_dir(base)
        for b in batches:
            for name, text in zip(b.column("name").to_pylist(), b.column("text").to_pylist(), strict=True):
                with store.open_output_stream(f"{base}/{name}.json") as f:
                    f.write(text.encode())
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"])

    rows = df.filter(F.col(key).isNotNull()).select(safe.alias("name"), F.to_json(F.struct(*df.columns)).alias("text"))
    return rows.mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
