"""Content-addressed store of token ids.

Every document's ids, with END at the end, are cut where a rolling hash over WINDOW
ids says so, hence at the same places wherever the same ids occur. Chunks are stored
once, under the first 16 bytes of their SHA-256; a document is a recipe, the list of
its chunks; recipes lie in ascending doc_id order, in segments, and each segment has
a Merkle root over blocks of BLOCK recipes. Layout below one folder:

- chunks/: digest, n (ids), ids (n little-endian unsigned 16-bit integers, or 32-bit
  where wide is true because an id is over 65535)
- recipes/: segment, rank, doc_id, start, n_tokens, chunks (digests, 16 bytes each)
- roots/: segment, first_start, n_docs, n_tokens, root

Reading verifies that each chunk has its digest and that the recipes give the roots;
sums over documents are combined from sums over chunks, so that no ids are shuffled
for that. `documents_ids` gives the ids themselves.

Defined results: null and empty texts are one END; repeated doc_ids are stored each,
in order of their chunks; an empty table gives an empty store.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from . import bpe
from ._spark import arrow_type, shared_dir, ship
from ._text import U64, mix, power_pair, random_table

END = 1
WINDOW, LEAST, MEAN, MOST = 16, 64, 512, 4096
BLOCK = 1024


def cuts(ids: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Ends of chunks: where the hash of the last WINDOW ids is 0 modulo MEAN, at least
    LEAST and at most MOST ids apart, and at each document's end."""
    up, down = power_pair(len(ids) + 1)
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, U64), np.cumsum(values()[ids & 0xFFFF] * up[: len(ids)])])
        h = mix((total[WINDOW:] - total[:-WINDOW]) * down[: len(total) - WINDOW]) if len(ids) >= WINDOW else np.zeros(0, U64)
    wanted = np.flatnonzero(h & U64(MEAN - 1) == 0) + WINDOW
    out, k, last = [], 0, 0
    wanted = wanted.tolist()
    for e in end.tolist():
        while True:
            while k < len(wanted) and wanted[k] < last + LEAST:
                k += 1
            cut = min(e, last + MOST, wanted[k] if k < len(wanted) else e)
            out.append(cut)
            last = cut
            if cut == e:
                break
    return np.array(out, np.int64)


@lru_cache(maxsize=1)
def values() -> np.ndarray:
    return random_table(21, 1 << 16)


def unpacked(raw: bytes, wide: bool) -> np.ndarray:
    return np.frombuffer(raw, "<u4" if wide else "<u2").astype("<u4")


def digest(ids: np.ndarray) -> bytes:
    return hashlib.sha256(ids.astype("<u4").tobytes()).digest()[:16]


STAGED = "doc_id {}, n_tokens long, chunks binary, fresh array<struct<digest:binary,n:int,wide:boolean,ids:binary>>"
#: Digests that a task remembers, so as not to hand on the same chunk twice; beyond them the store itself keeps one copy.
SEEN = 1 << 16


def staged(docs: DataFrame, path: str) -> DataFrame:
    """Per document its recipe, and those of its chunks that its task meets first."""
    schema = to_arrow_schema(docs.sparkSession.createDataFrame([], STAGED.format(docs.schema["doc_id"].dataType.simpleString())).schema)
    item = schema.field("fresh").type.value_type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for b in batches:
            for i, j, ids, count in bpe.encoded(b, path):
                count = count + 1
                end = np.cumsum(count)
                full = np.full(int(end[-1]), END, "<u4")
                own = np.ones(len(full), bool)
                own[end - 1] = False
                full[own] = ids
                stop = cuts(full, end)
                start = np.append(0, stop[:-1])
                raw = full.tobytes()
                names = [hashlib.sha256(raw[4 * a : 4 * c]).digest()[:16] for a, c in zip(start.tolist(), stop.tolist(), strict=True)]
                new, here = [], set()
                for k, name in enumerate(names):
                    if name not in seen and name not in here:
                        here.add(name)
                        new.append(k)
                if len(seen) + len(here) <= SEEN:
                    seen |= here
                chunk_of = np.concatenate([[0], np.searchsorted(stop, end) + 1])  # each document's chunks end where it ends
                joined_names = b"".join(names)
                recipes = [joined_names[16 * x : 16 * y] for x, y in zip(chunk_of[:-1].tolist(), chunk_of[1:].tolist(), strict=True)]
                first, last = start[new], stop[new]
                wide = np.maximum.reduceat(full, start)[new] > 0xFFFF
                narrow = full.astype("<u2").tobytes()
                spelt = [raw[4 * x : 4 * y] if w else narrow[2 * x : 2 * y] for x, y, w in zip(first.tolist(), last.tolist(), wide.tolist(), strict=True)]
                parts = pa.StructArray.from_arrays([pa.array([names[k] for k in new], pa.binary()), pa.array(last - first, pa.int32()), pa.array(wide), pa.array(spelt, pa.binary())], fields=list(item))
                fresh = pa.ListArray.from_arrays(pa.array(np.searchsorted(np.array(new, np.int64), chunk_of), pa.int32()), parts)
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(i, j - i), pa.array(count, pa.int64()), pa.array(recipes, pa.binary()), fresh.cast(schema.field("fresh").type)], schema=schema)

    return docs.mapInArrow(run, STAGED.format(docs.schema["doc_id"].dataType.simpleString()))


def write(docs: DataFrame, path: str, folder: str) -> None:
    """Encodes docs (doc_id, text) with the tokenizer at path into a store at folder."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select("doc_id", "text")
    staged(docs, path).write.option("compression", "zstd").parquet(f"{folder}/staged")
    both = spark.read.parquet(f"{folder}/staged")
    chunks = both.select(F.explode("fresh").alias("c")).select("c.*")
    chunks.groupBy("digest").agg(F.first("n").alias("n"), F.first("wide").alias("wide"), F.first("ids").alias("ids")).write.option("compression", "zstd").parquet(f"{folder}/chunks")

    ordered = both.select("doc_id", "n_tokens", "chunks")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = ordered.repartitionByRange(n, "doc_id", "chunks").sortWithinPartitions("doc_id", "chunks")
    kind = f"segment int, rank long, doc_id {ordered.schema['doc_id'].dataType.simpleString()}, start long, n_tokens long, chunks binary, leaf string"
    schema = pa.schema([("segment", pa.int32()), ("rank", pa.int64()), ("doc_id", arrow_type(ordered, "doc_id")), ("start", pa.int64()), ("n_tokens", pa.int64()), ("chunks", pa.binary()), ("leaf", pa.string())])

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, rank, start = TaskContext.get().partitionId(), 0, 0
        for b in batches:
            m = len(b)
            count = b.column("n_tokens").to_numpy(zero_copy_only=False)
            before = start + np.cumsum(count) - count
            leaf = [hashlib.sha256(x).hexdigest() for x in b.column("chunks").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(m, segment), pa.int32()), pa.array(np.arange(rank, rank + m), pa.int64()), b.column("doc_id"), pa.array(before, pa.int64()), b.column("n_tokens"), b.column("chunks"), pa.array(leaf)], schema=schema)
            rank, start = rank + m, start + int(count.sum())

    ordered.mapInArrow(numbered, kind).write.option("compression", "zstd").parquet(f"{folder}/ranked")
    ranked = spark.read.parquet(f"{folder}/ranked")
    roots = merkle(ranked).collect()  # one row for each segment
    first, total = [], 0
    for r in sorted(roots, key=lambda r: r.segment):
        first.append((r.segment, total, r.n_docs, r.n_tokens, r.root))
        total += r.n_tokens
    spark.createDataFrame(first, "segment int, first_start long, n_docs long, n_tokens long, root string").coalesce(1).write.parquet(f"{folder}/roots")
    offsets = spark.read.parquet(f"{folder}/roots").select("segment", "first_start")
    whole = ranked.join(F.broadcast(offsets), "segment")  # one row for each segment
    whole.select("segment", "rank", "doc_id", (F.col("start") + F.col("first_start")).alias("start"), "n_tokens", "chunks").write.option("compression", "zstd").parquet(f"{folder}/recipes")


def merkle(recipes: DataFrame) -> DataFrame:
    """segment, n_docs, n_tokens, root: hashes of BLOCK leaves, of BLOCK such hashes, and of those."""
    leaf = F.sha2("chunks", 256).alias("leaf") if "leaf" not in recipes.columns else F.col("leaf")
    level = recipes.select("segment", F.col("rank"), F.lit(1).cast("long").alias("n_docs"), "n_tokens", leaf)
    for _ in range(2):
        level = level.groupBy("segment", F.floor(F.col("rank") / BLOCK).alias("rank")).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"), F.sha2(F.concat_ws(",", F.transform(F.array_sort(F.collect_list(F.struct("rank", "leaf"))), lambda x: x["leaf"])).cast("binary"), 256).alias("leaf"))
    return level.groupBy("segment").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"), F.sha2(F.concat_ws(",", F.transform(F.array_sort(F.collect_list(F.struct("rank", "leaf"))), lambda x: x["leaf"])).cast("binary"), 256).alias("root"))


class Corrupt(ValueError):
    """The store's files do not give what its manifest says."""


def verify(spark: SparkSession, folder: str) -> None:
    """Raises Corrupt unless the recipes give every segment's root."""
    want = spark.read.parquet(f"{folder}/roots")
    got = merkle(spark.read.parquet(f"{folder}/recipes"))
    key = ["segment", "n_docs", "n_tokens", "root"]
    if want.select(key).join(got.select(key), key, "full_outer").count() != want.count():
        raise Corrupt("recipes do not match the roots")


def sums(spark: SparkSession, folder: str) -> DataFrame:
    """digest, n, crc of each stored chunk, from its ids; raises where the digest does not fit."""
    schema = pa.schema([("digest", pa.binary()), ("n", pa.int64()), ("crc", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            crc = []
            for name, n, wide, raw in zip(*(b.column(c).to_pylist() for c in ("digest", "n", "wide", "ids")), strict=True):
                ids = unpacked(raw, wide)
                if len(ids) != n or digest(ids) != name:
                    raise Corrupt(f"chunk {name.hex()}")
                crc.append(zlib.crc32(ids.tobytes()))
            yield pa.RecordBatch.from_arrays([b.column("digest"), b.column("n").cast(pa.int64()), pa.array(crc, pa.int64())], schema=schema)

    return spark.read.parquet(f"{folder}/chunks").mapInArrow(run, "digest binary, n long, crc long")


def times(matrix: list[int], v: int) -> int:
    out = i = 0
    while v:
        if v & 1:
            out ^= matrix[i]
        v, i = v >> 1, i + 1
    return out


@lru_cache(maxsize=8192)
def advance(n: int) -> list[int]:
    """The 32 columns by which n further zero bytes change a CRC-32."""
    if n == 0:
        return [1 << i for i in range(32)]
    if n == 1:
        zero = zlib.crc32(b"\0")
        flip = [zlib.crc32(b"\0", 1 << i) ^ zero for i in range(32)]
        return flip
    half = advance(n // 2)
    both = [times(half, c) for c in half]
    return [times(advance(1), c) for c in both] if n & 1 else both


def joined(a: int, b: int, n: int) -> int:
    """CRC-32 of two strings one after another, from theirs and the second's length."""
    return times(advance(n), a) ^ b


def recipe_parts(spark: SparkSession, folder: str) -> DataFrame:
    r = spark.read.parquet(f"{folder}/recipes")
    names = F.transform(F.sequence(F.lit(0), (F.length("chunks") / 16 - 1).cast("int")), lambda i: F.substring(F.col("chunks"), i * 16 + 1, 16))
    return r.select("doc_id", "start", "n_tokens", F.posexplode(names).alias("part", "digest"))


def summaries(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    verify(spark, folder)
    parts = recipe_parts(spark, folder).join(sums(spark, folder), "digest", "left")
    docs = parts.groupBy("start").agg(F.first("doc_id").alias("doc_id"), F.first("n_tokens").alias("n_tokens"), F.array_sort(F.collect_list(F.struct("part", "n", "crc"))).alias("parts"), F.count("n").alias("found"), F.count("*").alias("many"))
    schema = pa.schema([("doc_id", arrow_type(docs, "doc_id")), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            crc = []
            for total, found, many, x in zip(*(b.column(c).to_pylist() for c in ("n_tokens", "found", "many", "parts")), strict=True):
                if found != many or sum(p["n"] for p in x) != total:
                    raise Corrupt("a recipe's chunks are not all there")
                v = x[0]["crc"]
                for p in x[1:]:
                    v = joined(v, p["crc"], 4 * p["n"])
                crc.append(v)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("start"), b.column("n_tokens"), pa.array(crc, pa.int64())], schema=schema)

    return docs.select("doc_id", "start", "n_tokens", "parts", "found", "many").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, start long, n_tokens long, ids_crc32 long")


def documents_ids(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, ids (array<int>) of every document, put together again from its chunks."""
    chunks = spark.read.parquet(f"{folder}/chunks").select("digest", "wide", "ids")
    docs = recipe_parts(spark, folder).join(chunks, "digest").groupBy("start").agg(F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_list(F.struct("part", "wide", "ids"))).alias("parts"))
    schema = pa.schema([("doc_id", arrow_type(docs, "doc_id")), ("start", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = [np.concatenate([unpacked(p["ids"], p["wide"]) for p in x]).astype(np.int32) for x in b.column("parts").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("start"), pa.array(ids, pa.list_(pa.int32()))], schema=schema)

    return docs.select("doc_id", "start", "parts").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, start long, ids array<int>")


def stored(docs: DataFrame, path: str) -> DataFrame:
    """Writes a store into the shared folder and gives its summaries, read from the files."""
    folder = shared_dir(docs.sparkSession, "tokens")
    write(docs, path, folder)
    return summaries(docs.sparkSession, folder)
