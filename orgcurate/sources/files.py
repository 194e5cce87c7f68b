"""File sources and sinks."""

from __future__ import annotations

import codecs
import csv
import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import release_date, strip, version
from ..schema import V2


def curation_csv(spark: SparkSession, path: str, encoding: str = "utf-8") -> DataFrame:
    """Every cell a string, empty ones empty, quoted newlines kept, in one row each.

    A file with quoted newlines is one task; many files are many tasks."""
    df = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', inferSchema=False, encoding=encoding)
    return df.na.fill("")


def encodings(spark: SparkSession, path: str) -> DataFrame:
    """File and encoding of each file: by its byte order mark, else utf-8 where all of it
    decodes so, else windows-1252, or latin-1 where it has bytes that windows-1252 lacks."""

    def told(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame({"file": part["path"], "encoding": [encoding_of(bytes(raw)) for raw in part["content"]]})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(told, "file string, encoding string")


def encoding_of(raw: bytes) -> str:
    for mark, name in ((codecs.BOM_UTF8, "utf-8-sig"), (codecs.BOM_UTF32_LE, "utf-32"), (codecs.BOM_UTF32_BE, "utf-32"), (codecs.BOM_UTF16_LE, "utf-16"), (codecs.BOM_UTF16_BE, "utf-16")):
        if raw.startswith(mark):
            return name
    for name in ("utf-8", "windows-1252"):
        try:
            raw.decode(name)
            return name
        except UnicodeDecodeError:
            continue
    return "latin-1"


def with_line_numbers(df: DataFrame) -> DataFrame:
    """row_number as in the file, the header being line 1. Ranks within a partition are
    shifted by the sizes of the partitions before, so the rows themselves are not sorted."""
    d = df.withColumn("_id", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_id", 33))
    counts = d.groupBy("_part").agg(F.count("*").alias("_n"))  # one row for each partition
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = counts.select("_part", before.alias("_first"))
    rank = F.col("_id") - F.shiftleft("_part", 33) + F.col("_first")
    return d.join(F.broadcast(first), "_part").withColumn("row_number", (rank + 2).cast("int")).drop("_id", "_part", "_first")


def records(spark: SparkSession, path: str, schema: str = V2) -> DataFrame:
    """Records of a JSON dump or of a folder with one file each, and their file."""
    return spark.read.schema(schema).json(path, multiLine=True).withColumn("file", F.col("_metadata.file_name"))


def zipped_records(spark: SparkSession, path: str, schema: str = V2, newest: str = "schema_v2") -> DataFrame:
    """Records of the JSON member of each zip file, by preference the one whose name has `newest`."""

    def members(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for name, raw in zip(part["path"], part["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(raw)) as z:
                    names = sorted(n for n in z.namelist() if n.endswith(".json") and not n.startswith("__MACOSX"))
                    if not names:
                        raise ValueError(f"{name} has no JSON member")
                    best = next((n for n in names if newest in n), names[0])
                    out.append((name, z.read(best).decode("utf-8-sig")))
            yield pd.DataFrame(out, columns=["file", "text"])

    raw = spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(members, "file string, text string")
    kind = T.ArrayType(spark.createDataFrame([], schema).schema)
    return raw.select("file", F.explode(F.from_json("text", kind)).alias("r")).select("r.*", "file")


def snapshots(spark: SparkSession, path: str, schema: str = V2) -> DataFrame:
    """Records of dated zip files with their release_date."""
    return zipped_records(spark, path, schema).withColumn("release_date", release_date(F.col("file")))


def latest_release(listing: DataFrame, name: str = "name") -> DataFrame:
    """The newest version among file names `vX.Y...`; one row is the result."""
    return listing.filter(version(F.col(name))["major"].isNotNull()).orderBy(version(F.col(name)).desc(), F.col(name).desc()).limit(1)


def id_list(spark: SparkSession, path: str) -> DataFrame:
    """One id per line, without the address before it, lower case."""
    return spark.read.text(path).select(F.lower(F.regexp_replace(strip(F.col("value")), r"^https?://[^/]+/", "")).alias("id")).filter("id <> ''")


def funder_concepts(spark: SparkSession, path: str) -> DataFrame:
    """Funders of an RDF file: id, labels, status and country, joined by `; `."""
    schema = "`_rdf:about` string, `skosxl:prefLabel` struct<`skosxl:Label`:struct<`skosxl:literalForm`:string>>, `skosxl:altLabel` array<struct<`skosxl:Label`:struct<`skosxl:literalForm`:string>>>, `svf:status` string, `svf:country` string"
    d = spark.read.format("xml").option("rowTag", "skos:Concept").schema(schema).load(path)
    alt = F.transform(F.coalesce("skosxl:altLabel", F.array().cast("array<struct<`skosxl:Label`:struct<`skosxl:literalForm`:string>>>")), lambda a: a["skosxl:Label"]["skosxl:literalForm"])
    return d.select(F.col("`_rdf:about`").alias("id"), F.col("`skosxl:prefLabel`.`skosxl:Label`.`skosxl:literalForm`").alias("name"), F.array_join(alt, "; ").alias("aliases"), F.col("`svf:status`").alias("status"), F.col("`svf:country`").alias("country"))


def write_report(df: DataFrame, columns: list[str], path: str) -> bool:
    """K1: the columns as CSV with a header; nothing is written where there are no rows."""
    if df.isEmpty():
        return False
    df.select(*(F.col(f"`{c}`") for c in columns)).write.csv(path, header=True, mode="overwrite", quote='"', escape='"')
    return True


def write_records(df: DataFrame, path: str) -> None:
    """K3: records as JSON lines, without null fields; the files' number follows the data."""
    df.write.json(path, mode="overwrite", ignoreNullFields=True)


def json_array(df: DataFrame, order: str) -> Iterator[str]:
    """K4: the pieces of one JSON array of all records in order, streamed through the driver
    one partition at a time."""
    yield "["
    for k, r in enumerate(df.select(F.to_json(F.struct("*")).alias("j"), order).orderBy(order).toLocalIterator()):
        yield ("," if k else "") + "\n" + r.j
    yield "\n]\n"


def write_zip(df: DataFrame, wide: DataFrame, path: str, name: str, order: str = "id") -> None:
    """K4, K5: a zip file on the driver with `name`.json, one array, and `name`.csv, the wide table."""
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        with z.open(f"{name}.json", "w", force_zip64=True) as f:
            for piece in json_array(df, order):
                f.write(piece.encode())
        with z.open(f"{name}.csv", "w", force_zip64=True) as f, io.TextIOWrapper(f, "utf-8", newline="") as t:
            out = csv.writer(t)
            out.writerow(wide.columns)
            for r in wide.orderBy(order).toLocalIterator():
                out.writerow(["" if v is None else v for v in r])


def write_chunks(df: DataFrame, path: str, chunk: str = "chunk", fmt: str = "json") -> None:
    """K6, K7: one folder per chunk, its number in three digits or more; JSON or CSV with a header."""
    name = F.lpad(F.col(chunk).cast("string"), F.greatest(F.lit(3), F.length(F.col(chunk).cast("string"))), F.lit("0"))
    out = df.withColumn(chunk, name).write.mode("overwrite").partitionBy(chunk)
    out.option("header", True).csv(path) if fmt == "csv" else out.json(path)


def release_notes(added: DataFrame, updated: DataFrame, registry: DataFrame, identifier: str = "id", name: str = "name") -> DataFrame:
    """K9: part, place, line of the Markdown notes of a release: counts of all, added and updated
    records, then a table of those added and one of those updated, in order of their ids."""
    names = ("n_all", "n_added", "n_updated")
    ones = [d.select(*(F.lit(int(c == own)).cast("long").alias(c) for c in names)) for d, own in zip((registry, added, updated), names, strict=True)]
    row = ones[0].unionByName(ones[1]).unionByName(ones[2]).agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names))
    texts = [F.concat(F.lit("- **Total organizations**: "), (F.col("n_all") + F.col("n_added")).cast("string")), F.concat(F.lit("- **Records added**: "), F.col("n_added").cast("string")), F.concat(F.lit("- **Records updated**: "), F.col("n_updated").cast("string"))]
    out = row.select(F.explode(F.array(*(F.struct(F.lit("0 counts").alias("part"), F.lit(str(k)).alias("place"), t.alias("line")) for k, t in enumerate(texts)))).alias("r")).select("r.*")
    for part, d in (("1 added", added), ("2 updated", updated)):
        out = out.unionByName(d.select(F.lit(part).alias("part"), F.col(identifier).cast("string").alias("place"), F.concat_ws("|", F.col(identifier).cast("string"), name).alias("line")))
    return out.orderBy("part", "place")
