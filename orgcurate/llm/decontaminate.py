"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the windows of `window` consecutive words of the benchmark items.
Blocks of two words index a shift table: at each stop the block that ends the
current window says how many positions can be skipped because no pattern has that
block there. Where the shift is 0, the block selects a bucket of patterns with
that last block, and a comparison of the words' bytes confirms an occurrence.
Every document is scanned in many lanes at once, one numpy step moving all lanes.

A benchmark of at most BLOCK_BYTES is broadcast whole. Of a larger one the shift tables
alone are, at most `window` tables of 1 MB: tasks build them from their own items and the
least shifts count. Windows at which the shift is 0 are then joined with the patterns by
their hash, and their words compared. Either way gives the same rows.

Defined results: null text has no words; a document without words has no hits;
items without words give no pattern; items shorter than a window are one pattern;
repeated documents are reported each, repeated items once, by their id; a null item_id
counts as the empty one; `clean` keeps all columns of its input, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ._spark import arrow_type, ship, written
from ._text import U64, Words, combine, mix, ragged, slices, strings, table_of

WINDOW = 10
LANE = 256
#: Benchmark bytes that are broadcast; a larger benchmark is joined.
BLOCK_BYTES = 32 << 20
#: A row's number on the way, under a name that the input's columns will not have.
ROW = "decontamination row"
LUT, VALUES = table_of(lambda b: 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128, seed=7)
BITS = 20
SCANNED = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))), ("items", pa.list_(pa.string()))])
SCAN = "doc_id {}, n_words long, runs array<struct<s:int,e:int>>, items array<string>"


class Patterns:
    """Wu-Manber tables of patterns of one length."""

    def __init__(self, length: int, hashes: np.ndarray, items: np.ndarray, text: np.ndarray, at: np.ndarray):
        """hashes: (n, length) word hashes; items: item index of each; text: all patterns'
        word bytes; at: (n, length + 1) bounds of the words in text."""
        self.length, self.block = length, min(2, length)
        self.default = length - self.block + 1
        self.hashes, self.items, self.text, self.at = hashes, items, text, at
        self.shift = np.full(1 << BITS, self.default, np.uint8)
        for j in range(self.block - 1, length):
            h = self.blocks(*(hashes[:, j - k] for k in range(self.block)))
            np.minimum.at(self.shift, (h >> U64(64 - BITS)).astype(np.int64), length - 1 - j)
        last = self.blocks(*(hashes[:, length - 1 - k] for k in range(self.block)))
        self.order = np.argsort(last, kind="stable")
        self.suffix, self.first = np.unique(last[self.order], return_index=True)
        self.first = np.append(self.first, len(last))

    @staticmethod
    def blocks(last: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix(last if before is None else before * U64(0xC2B2AE3D27D4EB4F) + last)

    def find(self, w: Words, text: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position of the first word, pattern) of every occurrence in the slice's words."""
        k = self.length
        pos, h = stops(w, self.shift, k)
        if not len(pos):
            return pos, pos
        bucket = np.searchsorted(self.suffix, h)
        ok = (bucket < len(self.suffix)) & (self.suffix[np.minimum(bucket, len(self.suffix) - 1)] == h)
        pos, bucket = pos[ok] - k + 1, bucket[ok]
        out: list[tuple[np.ndarray, np.ndarray]] = []
        for a in range(0, len(pos), 1 << 14):  # bounds memory where a bucket is large
            p, b = pos[a : a + (1 << 14)], bucket[a : a + (1 << 14)]
            size = self.first[b + 1] - self.first[b]
            pattern = self.order[ragged(self.first[b], size)]
            p = np.repeat(p, size)
            for j in range(k):
                same = self.hashes[pattern, j] == w.h[p + j]
                p, pattern = p[same], pattern[same]
            out.append(self.confirm(p, pattern, text, at))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (pos[:0], pos[:0])

    def confirm(self, p: np.ndarray, pattern: np.ndarray, text: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keeps those whose words have the same lengths and bytes."""
        ok = np.ones(len(p), bool)
        for j in range(self.length):
            ok &= at[p + j + 1] - at[p + j] == self.at[pattern, j + 1] - self.at[pattern, j]
        p, pattern = p[ok], pattern[ok]
        size = at[p + self.length] - at[p]
        differ = text[ragged(at[p], size)] != self.text[ragged(self.at[pattern, 0], size)]
        bad = np.add.reduceat(differ, np.cumsum(size) - size) > 0 if len(p) else np.zeros(0, bool)
        return p[~bad], pattern[~bad]


def stops(w: Words, shift: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(position of the last word, hash of the last block) of the windows of k words at which
    the shift is 0; the others are skipped as far as the table allows."""
    n = np.diff(w.first)
    lanes = np.where(n >= k, -(-(n - k + 1) // LANE), 0)
    if not lanes.sum():
        return np.zeros(0, np.int64), np.zeros(0, U64)
    begin = np.repeat(w.first[:-1], lanes) + ragged(np.zeros(len(lanes), np.int64), lanes) * LANE
    stop = np.minimum(begin + LANE - 1, np.repeat(w.first[1:] - k, lanes)) + k - 1
    pos, found = begin + k - 1, []
    while len(pos):
        h = Patterns.blocks(*(w.h[pos - j] for j in range(min(2, k))))
        step = shift[(h >> U64(64 - BITS)).astype(np.int64)].astype(np.int64)
        hit = step == 0
        if hit.any():
            found.append((pos[hit], h[hit]))
            step[hit] = 1
        pos = pos + step
        on = pos <= stop
        pos, stop = pos[on], stop[on]
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64), np.zeros(0, U64))


def squeezed(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """The words' bytes without what lies between, and the n + 1 bounds of the words in them."""
    return w.bytes[w.inside], np.concatenate([[0], np.cumsum(w.end - w.start)])


def compiled(texts: list[str | None], window: int = WINDOW) -> list[Patterns]:
    """Tables for the items' windows, one for each pattern length."""
    data, off = strings(pa.array(texts, pa.large_string()))
    w = Words(data, off, LUT, VALUES)
    text, at = squeezed(w)
    by: dict[int, list[np.ndarray]] = {}
    for i, n in enumerate(np.diff(w.first).tolist()):
        if n:
            k = min(n, window)
            starts = np.arange(w.first[i], w.first[i + 1] - k + 1)
            by.setdefault(k, []).append(np.stack([np.full(len(starts), i), starts]))
    out = []
    for k, parts in sorted(by.items()):
        item, start = np.concatenate(parts, axis=1)
        across = start[:, None] + np.arange(k + 1)
        out.append(Patterns(k, w.h[across[:, :-1]], item, text, at[across]))
    return out


def runs_of(start: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Union of the intervals, sorted."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], start[1:] > end[:-1]])
    return list(zip(start[new].tolist(), end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)].tolist(), strict=True))


def scanned(batch: pa.RecordBatch, tables: list[Patterns], names: list[str], schema: pa.Schema, ids: bool = True) -> Iterator[pa.RecordBatch]:
    for i, j, part, bounds in slices(*strings(batch.column("text"))):
        w = Words(part, bounds, LUT, VALUES)
        text, at = squeezed(w)
        spans, items = [[] for _ in range(j - i)], [set() for _ in range(j - i)]
        for t in tables:
            p, k = t.find(w, text, at)
            row = w.row[p]
            order = np.argsort(row, kind="stable")
            for some in np.split(order, np.flatnonzero(np.diff(row[order])) + 1) if len(p) else ():
                r = int(row[some[0]])
                spans[r].append((p[some] - w.first[r], p[some] - w.first[r] + t.length))
                items[r].update(names[x] for x in np.unique(t.items[k[some]]).tolist())
        runs = [[{"s": s, "e": e} for s, e in runs_of(*(np.concatenate(y) for y in zip(*x, strict=True)))] if x else [] for x in spans]
        cols = [batch.column("doc_id").slice(i, j - i) if ids else pa.nulls(j - i, pa.int64()), pa.array(np.diff(w.first), pa.int64()), pa.array(runs, schema.field("runs").type), pa.array([sorted(x) for x in items], schema.field("items").type)]
        yield pa.RecordBatch.from_arrays(cols, schema=schema)


def fits(benchmark: DataFrame, most: int) -> bool:
    """Whether the benchmark is small enough to be broadcast."""
    size = benchmark.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64)).first()[0]
    return (size or 0) <= most


def searched(benchmark: DataFrame, window: int) -> Callable[[], tuple[list[Patterns], list[str]]]:
    """For a task: the tables of a small benchmark and the items' ids."""
    rows = [(r.i or "", r.text) for r in benchmark.select(F.col("item_id").cast("string").alias("i"), "text").collect()]  # as checked by `fits`
    shared = benchmark.sparkSession.sparkContext.broadcast(rows)
    return lambda: (compiled([t for _, t in shared.value], window), [i for i, _ in shared.value])


CELLS = 1 << 16
PATTERN = "k int, h long, item string, words string"


def patterns(benchmark: DataFrame, window: int) -> DataFrame:
    """k, h, item, words of every pattern of a benchmark of any size, each once."""
    schema = pa.schema([("k", pa.int32()), ("h", pa.int64()), ("item", pa.string()), ("words", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, part, bounds in slices(*strings(b.column("text"))):
                w = Words(part, bounds, LUT, VALUES)
                text, at = squeezed(w)
                for k in sorted(set(np.minimum(np.diff(w.first), window).tolist()) - {0}):
                    n = np.diff(w.first)
                    pos = ragged(w.first[:-1], np.where(np.minimum(n, window) == k, n - k + 1, 0))
                    item = [x or "" for x in b.column("i").slice(i, j - i).take(pa.array(w.row[pos])).to_pylist()]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pos), k), pa.int32()), pa.array(combine(w.h, k)[pos].view(np.int64)), pa.array(item, pa.string()), pa.array(spelt(text, at, pos, k), pa.string())], schema=schema)

    return benchmark.select(F.col("item_id").cast("string").alias("i"), "text").mapInArrow(run, PATTERN).distinct()


def spelt(text: np.ndarray, at: np.ndarray, pos: np.ndarray, k: int) -> list[str]:
    """The k words from each place, joined by spaces."""
    raw, edge = text.tobytes(), at.tolist()
    return [" ".join(raw[edge[p + x] : edge[p + x + 1]].decode() for x in range(k)) for p in pos.tolist()]


def shifts(benchmark: DataFrame, window: int) -> dict[int, np.ndarray]:
    """The shift table of each pattern length, the least of those that tasks make of their items."""
    schema = pa.schema([("k", pa.int32()), ("block", pa.int32()), ("cells", pa.binary())])

    def packed(least: dict[tuple[int, int], np.ndarray]) -> Iterator[pa.RecordBatch]:
        if least:
            k, block = zip(*least, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(block, pa.int32()), pa.array([x.tobytes() for x in least.values()], pa.binary())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            for t in compiled(b.column("text").to_pylist(), window):
                for x, cells in enumerate(np.split(t.shift, (1 << BITS) // CELLS)):
                    least[t.length, x] = np.minimum(least.get((t.length, x), 255), cells)
        yield from packed(least)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            for k, x, raw in zip(*(b.column(c).to_pylist() for c in ("k", "block", "cells")), strict=True):
                least[k, x] = np.minimum(least.get((k, x), 255), np.frombuffer(raw, np.uint8))
        yield from packed(least)

    kind = "k int, block int, cells binary"
    d = benchmark.select("text").mapInArrow(run, kind).withColumn("group", F.spark_partition_id() % 64)
    d = d.repartition("k", "block", "group").select("k", "block", "cells").mapInArrow(merged, kind).repartition("k", "block").mapInArrow(merged, kind)
    out: dict[int, np.ndarray] = {}
    for r in d.collect():  # at most `window` tables of 1 MB
        out.setdefault(r.k, np.zeros(1 << BITS, np.uint8))[r.block * CELLS : (r.block + 1) * CELLS] = np.frombuffer(r.cells, np.uint8)
    return out


def joined(docs: DataFrame, benchmark: DataFrame, window: int) -> DataFrame:
    """ROW, n_words, runs, items of docs (ROW, text), for a benchmark of any size."""
    shared = docs.sparkSession.sparkContext.broadcast(shifts(benchmark, window))
    schema = pa.schema([("row", pa.int64()), ("n_words", pa.int64()), ("k", pa.int32()), ("h", pa.int64()), ("at", pa.int32()), ("words", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.column(ROW).to_numpy()
            for i, j, part, bounds in slices(*strings(b.column("text"))):
                w = Words(part, bounds, LUT, VALUES)
                text, at = squeezed(w)
                empty = np.zeros(j - i, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(rows[i:j]), pa.array(np.diff(w.first), pa.int64()), pa.nulls(j - i, pa.int32()), pa.array(empty), pa.nulls(j - i, pa.int32()), pa.nulls(j - i, pa.string())], schema=schema)
                for k, shift in sorted(shared.value.items()):
                    pos = stops(w, shift, k)[0] - k + 1
                    yield pa.RecordBatch.from_arrays([pa.array(rows[i:j][w.row[pos]]), pa.nulls(len(pos), pa.int64()), pa.array(np.full(len(pos), k), pa.int32()), pa.array(combine(w.h, k)[pos].view(np.int64)), pa.array(pos - w.first[w.row[pos]], pa.int32()), pa.array(spelt(text, at, pos, k), pa.string())], schema=schema)

    found = written(docs.select(ROW, "text").mapInArrow(run, "row long, n_words long, k int, h long, at int, words string"), "windows")
    hits = found.filter("k is not null").join(patterns(benchmark, window), ["k", "h", "words"])
    by = hits.groupBy("row").agg(F.array_sort(F.collect_set(F.struct(F.col("at").alias("s"), (F.col("at") + F.col("k")).alias("e")))).alias("spans"), F.array_sort(F.collect_set("item")).alias("items"))
    none = F.array().cast("array<struct<s:int,e:int>>")
    step = lambda acc, x: F.when((F.size(acc) > 0) & (x["s"] <= F.element_at(acc, -1)["e"]), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["s"].alias("s"), F.greatest(F.element_at(acc, -1)["e"], x["e"]).alias("e"))))).otherwise(F.concat(acc, F.array(x)))
    runs = F.aggregate(F.coalesce("spans", none), none, step)
    d = found.filter("k is null").select("row", "n_words").join(by, "row", "left")
    return d.select(F.col("row").alias(ROW), "n_words", runs.alias("runs"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def numbered(docs: DataFrame) -> DataFrame:
    """docs with ROW, written, so that the numbers stay."""
    return written(docs.withColumn(ROW, F.monotonically_increasing_id()), "numbered")


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: n_words, the disjoint runs of hit words, the ids of the items hit."""
    ship(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    if not fits(benchmark, block_bytes):
        docs = numbered(docs)
        return docs.select("doc_id", f"`{ROW}`").join(joined(docs, benchmark, window), ROW).drop(ROW)
    schema = SCANNED.set(0, pa.field("doc_id", arrow_type(docs, "doc_id")))
    load = searched(benchmark, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, names = load()
        for batch in batches:
            yield from scanned(batch, tables, names, schema)

    return docs.mapInArrow(run, SCAN.format(docs.schema["doc_id"].dataType.simpleString()))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated: one row for each document."""
    s = scan(docs, benchmark, window, block_bytes)
    ids = F.array_sort(F.col("items"))
    return s.select(
        "doc_id",
        "n_words",
        F.aggregate("runs", F.lit(0).cast("long"), lambda a, r: a + r["e"] - r["s"]).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", ids).cast("binary"), 256).alias("items_sha256"),
        (F.size("runs") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents in which no benchmark window occurs, with all their columns, in one pass."""
    ship(docs.sparkSession)
    if not fits(benchmark, block_bytes):
        all_ = numbered(docs)
        hit = joined(all_, benchmark, window).filter(F.size("runs") > 0).select(ROW)
        return all_.join(hit, ROW, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
    schema = to_arrow_schema(docs.schema)
    load = searched(benchmark, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, names = load()
        for batch in batches:
            hit = [n > 0 for part in scanned(batch, tables, names, SCANNED, ids=False) for n in pc.list_value_length(part.column("runs")).to_pylist()]
            kept = batch.filter(pc.invert(pa.array(hit, pa.bool_())))
            yield pa.RecordBatch.from_arrays([kept.column(f.name).cast(f.type) for f in schema], schema=schema)

    return docs.mapInArrow(run, docs.schema)
