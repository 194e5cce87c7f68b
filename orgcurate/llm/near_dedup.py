"""Near-duplicate classes: improved consistent weighted sampling over TF-IDF shingles.

A shingle is WORDS consecutive words (runs of bytes other than ASCII white space, A-Z
lower-cased); a text of fewer words is one shingle. Its weight is its count in the
text times its inverse document frequency, which is counted over all documents in
BUCKETS hash cells; what other shingles add to a cell is estimated by the cells' median
and taken off, so that frequent shingles weigh less in a corpus of any size, and those
that do not stand out of their cell count as rare. Each of BANDS x ROWS samples picks a
shingle and a level with a chance that follows the weights, so that two texts agree on
a sample with a probability of their weighted Jaccard similarity; texts that agree on
all samples of a band are candidates, and the similarity itself, worked out on both
whole texts, decides. Classes are the connected components of the links.

The shingles of a group of copies are the more frequent, and so the lighter, the larger
the group is, while what a copy has of its own stays rare: by these weights alone copies
would grow apart with their number. Texts are therefore sampled and compared by their
counts alone as well (BANDS samples of each kind, all from the same random numbers), and
a link is a similarity of THRESHOLD by either kind of weights.

Texts with equal shingles and counts are one class from the start, by partial
aggregation. In a band's bucket each remaining text is first tested against the bucket's
first text and the one before it, which joins most of what is alike; buckets are split
by PARTS for that, so that none falls to one task whole. Then every pair that shares a
bucket and is not in one class yet is tested too. In buckets of more than BLOCK texts
most pairs are far below the threshold, so their texts are sampled again in LONG_BANDS
bands of LONG_ROWS, and pairs are those that agree on such a band. A bucket that is
still large is cut into blocks of LONG_BLOCKS x BLOCK texts or so, its largest class apart from the
rest; each pair of blocks but those within the largest class is a group of its own. So
no link between texts of a bucket depends on the order of doc_id. Texts whose similarity
is THRESHOLD by one kind of weights share a bucket in at least one band of these with
probability 1 - (1 - THRESHOLD**ROWS)**BANDS, over 0.99999, for either kind of bands.

Defined results: null, empty and blank texts and documents with a null doc_id are a
class of their own; the class id is the least doc_id of the class; rows that repeat a
doc_id get the same class only if their texts do; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._spark import removed, ship, written, written_at
from ._text import MULT, U64, Words, combine, mix, random_table, slices, strings, table_of

WORDS, THRESHOLD = 5, 0.8
BANDS, ROWS = 12, 2
LONG_BANDS, LONG_ROWS, LONG_BLOCKS = 40, 6, 4
BUCKETS, PARTS, BLOCK = 1 << 18, 1024, 64
#: Ids that may be broadcast: 8 MB.
FEW = 1 << 20
#: Cells that go through a shuffle as one value.
CELLS = 1 << 12
LUT, VALUES = table_of(lambda b: b != 32 and not 9 <= b <= 13, seed=41)


def shingles(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, count) of the distinct shingles of each row, in the order of rows."""
    w = Words(data, off, LUT, VALUES)
    n = np.diff(w.first)
    full = combine(w.h, WORDS)
    row = w.row[: len(full)]
    inside = row == w.row[WORDS - 1 :] if len(full) else np.zeros(0, bool)
    short = np.flatnonzero((n > 0) & (n < WORDS))
    with np.errstate(over="ignore"):
        parts = [mix(np.array([_poly(w.h[w.first[r] : w.first[r + 1]])], U64))[0] for r in short.tolist()]
    h = np.concatenate([full[inside], np.array(parts, U64)])
    row = np.concatenate([row[inside], short])
    order = np.argsort(h)
    order = order[np.argsort(row[order].astype(np.uint16) if len(n) < 1 << 16 else row[order], kind="stable")]
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    return row[at], h[at], np.diff(np.append(at, len(h)))


def _poly(h: np.ndarray) -> int:
    out = len(h)
    for x in h.tolist():
        out = (out * MULT + x) & ((1 << 64) - 1)
    return out


def bucket(h: np.ndarray) -> np.ndarray:
    return (h >> U64(40)).astype(np.int64) & (BUCKETS - 1)


@lru_cache(maxsize=1)
def gamma_tables() -> tuple[np.ndarray, np.ndarray]:
    """Quantiles of the Gamma(2, 1) distribution at 4,096 even steps, and logarithms of those at 65,536."""

    def quantiles(n: int) -> np.ndarray:
        p = (np.arange(n) + 0.5) / n
        x = np.sqrt(2 * p) + p
        for _ in range(60):
            x = np.maximum(x - (1 - (1 + x) * np.exp(-x) - p) / np.maximum(x * np.exp(-x), 1e-12), x / 2)
        return x

    return quantiles(1 << 12).astype(np.float32), np.log(quantiles(1 << 16)).astype(np.float32)


@lru_cache(maxsize=4)
def seeds(many: int) -> np.ndarray:
    return random_table(43, many)


def samples(row: np.ndarray, h: np.ndarray, weight: np.ndarray, n: int, many: int) -> np.ndarray:
    """(n, many) samples as 64-bit values; 0 for rows without shingles."""
    return samples_by(row, h, [weight], n, many)[0]


def samples_by(row: np.ndarray, h: np.ndarray, weights: list[np.ndarray], n: int, many: int) -> np.ndarray:
    """(kinds of weights, n, many) samples, those of all kinds from the same random numbers."""
    out = np.zeros((len(weights), n, many), U64)
    if not len(row):
        return out
    first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    size = np.diff(np.append(first, len(row)))
    logs = [np.log(w).astype(np.float32) for w in weights]
    spread, log_c = gamma_tables()
    with np.errstate(over="ignore"):
        for k, seed in enumerate(seeds(many).tolist()):
            u = mix(h ^ U64(seed))
            r = spread[(u >> U64(52)).astype(np.int64)]
            beta = (u & U64(0xFFFFFF)).astype(np.float32) * np.float32(2.0**-24)
            c = log_c[(u >> U64(36)).astype(np.int64) & 0xFFFF]
            for kind, log_w in enumerate(logs):
                t = np.floor(log_w / r + beta)
                log_a = c - r * (t + 1 - beta)
                best = np.flatnonzero(log_a == np.repeat(np.minimum.reduceat(log_a, first), size))
                best = best[np.concatenate([[True], row[best[1:]] != row[best[:-1]]])]
                out[kind, row[best], k] = mix(h[best] + t[best].astype(np.int64).view(U64) * U64(0x9E3779B97F4A7C15)) | U64(1)
    return out


def frequencies(docs: DataFrame) -> np.ndarray:
    """Documents by shingle cell, over all documents; the last number is that of documents.

    Each task sums its own counts first, 64 groups of tasks sum theirs, and BUCKETS + 1
    numbers come to the driver."""
    schema = pa.schema([("block", pa.int32()), ("n", pa.binary())])

    def packed(sums: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, many = np.zeros(BUCKETS, np.int64), 0
        for b in batches:
            for i, j, d, o in slices(*strings(b.column("text"))):
                _, h, _ = shingles(d, o)
                count += np.bincount(bucket(h), minlength=BUCKETS)
                many += j - i
        if many:
            yield packed({k: x for k, x in enumerate(np.split(count, BUCKETS // CELLS)) if x.any()} | {BUCKETS // CELLS: np.array([many])})

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for k, x in zip(b.column("block").to_pylist(), b.column("n").to_pylist(), strict=True):
                sums[k] = sums.get(k, 0) + np.frombuffer(x, np.int64)
        if sums:
            yield packed(sums)

    kind = "block int, n binary"
    d = docs.select("text").mapInArrow(run, kind).withColumn("group", F.spark_partition_id() % 64)
    d = d.repartition("block", "group").select("block", "n").mapInArrow(summed, kind).repartition("block").mapInArrow(summed, kind)
    out = np.zeros(BUCKETS + 1, np.int64)
    for r in d.collect():
        x = np.frombuffer(r.n, np.int64)
        out[r.block * CELLS : r.block * CELLS + len(x)] = x
    return out


def inverse(count: np.ndarray) -> np.ndarray:
    """Smoothed inverse document frequency of each cell. The median is what a cell holds by
    chance; a cell is that of a frequent shingle if it is three deviations above that."""
    cells, noise = count[:-1], float(np.median(count[:-1]))
    own = np.where(cells > noise + 3 * np.sqrt(noise), cells - noise, np.minimum(cells, 1))
    return (np.log((count[-1] + 1) / (own + 1)).clip(0) + 1).astype(np.float32)


def signatures(docs: DataFrame, idf, bands: int, rows: int) -> DataFrame:
    """doc_id, print (of all shingles with counts), keys (one for each band and kind of weights) of texts with words."""
    many = 2 * bands
    schema = pa.schema([("doc_id", pa.int64()), ("print", pa.int64()), ("keys", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("doc_id")
            for i, j, d, o in slices(*strings(b.column("text"))):
                row, h, n = shingles(d, o)
                s = samples_by(row, h, [n * idf.value[bucket(h)], n], j - i, bands * rows)
                s = s.transpose(1, 0, 2).reshape(j - i, many, rows)
                with np.errstate(over="ignore"):
                    key = mix(combine_rows(s) + np.arange(many, dtype=U64) * U64(0xBF58476D1CE4E5B9)).view(np.int64)
                    one = mix(h + n.astype(U64) * U64(0xD6E8FEB86659FD93))
                    whole = np.zeros(j - i, U64)
                    np.add.at(whole, row, one)  # the shingles are distinct: their sum is the same in any order
                    whole = mix(whole).view(np.int64)
                has = np.zeros(j - i, bool)
                has[row] = True
                at = np.flatnonzero(has)
                keys = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * many, pa.int32()), pa.array(key[at].ravel()))
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i).take(pa.array(at)), pa.array(whole[at]), keys], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, print long, keys array<long>")


def combine_rows(s: np.ndarray) -> np.ndarray:
    out = s[:, :, 0].copy()
    for k in range(1, s.shape[2]):
        out = out * U64(MULT) + s[:, :, k]
    return out


def candidates(firsts: DataFrame) -> DataFrame:
    """a < b: pairs to test, each text with two others of its bucket at most."""
    rows = firsts.select(F.explode("keys").alias("key"), "doc_id").withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)))
    w = Window.partitionBy("key", "part").orderBy("doc_id")
    rows = rows.select("key", "part", "doc_id", F.first("doc_id").over(w).alias("head"), F.lag("doc_id").over(w).alias("before"))
    heads = rows.filter(F.col("before").isNull()).select("key", "doc_id")
    v = Window.partitionBy("key").orderBy("doc_id")  # PARTS rows at most
    heads = heads.select("doc_id", F.first("doc_id").over(v).alias("head"), F.lag("doc_id").over(v).alias("before"))
    pairs = [x.select(F.col(c).alias("a"), F.col("doc_id").alias("b")) for x in (rows, heads) for c in ("head", "before")]
    out = pairs[0]
    for p in pairs[1:]:
        out = out.unionByName(p)
    return out.filter("a < b").distinct()


def similarity(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...]) -> float:
    """Weighted Jaccard similarity of two sets of (sorted hashes, weights), by the kind of weights that makes it greatest."""
    at = np.searchsorted(b[0], a[0])
    at[at == len(b[0])] = 0
    both = b[0][at] == a[0]
    best, at = 0.0, at[both]
    for x, y in zip(a[1:], b[1:], strict=True):
        common = float(np.minimum(x[both], y[at]).sum())
        total = float(x.sum() + y.sum()) - common
        best = max(best, common / total if total else 0.0)
    return best


def weighted(column: pa.Array, idf) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(sorted hashes, weights, counts) of each text's shingles."""
    out = []
    for i, j, d, o in slices(*strings(column)):
        row, h, n = shingles(d, o)
        w = n * idf.value[bucket(h)]
        cut = np.searchsorted(row, np.arange(j - i + 1))
        out += [(h[x:y], w[x:y], n[x:y]) for x, y in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
    return out


def only(df: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of these doc_ids. At most FEW ids are broadcast, so that no other row is moved;
    more are joined."""
    return df.join(F.broadcast(ids) if ids.count() <= FEW else ids, "doc_id", "left_semi")


def links(pairs: DataFrame, texts: DataFrame, idf, threshold: float) -> DataFrame:
    """The pairs whose whole texts are similar enough."""
    right = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    both = right.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a").select("a", "b", "text_a", "text_b")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), 1000):
                b = batch.slice(k, 1000)
                ok = [similarity(x, y) >= threshold for x, y in zip(weighted(b.column("text_a"), idf), weighted(b.column("text_b"), idf), strict=True)]
                yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], schema=schema).filter(pa.array(ok, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def mixed(labelled: DataFrame, least: int) -> DataFrame:
    """key, n, doc_id, root: the texts of each bucket of `least` or more texts in more than one class."""
    rows = labelled.select(F.explode("keys").alias("key"), "doc_id", "root")
    some = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high")).filter(f"low < high and n >= {least}")
    return rows.join(some.select("key", "n"), "key").select("key", "n", "doc_id", "root")


def blocks(rows: DataFrame, least: int) -> DataFrame:
    """key, i, j, block, doc_id, root: the texts of mixed buckets, under every pair of blocks
    (i <= j) that their own block is part of and that may hold new links. The blocks of the
    bucket's largest class come last and are paired with the others only. Blocks hold about
    `least` texts; in their number each text is repeated."""
    size = rows.groupBy("key", "root").agg(F.count("*").alias("size"))
    size = size.groupBy("key").agg(F.max_by("root", F.struct("size", "root")).alias("main"), F.max("size").alias("most"), F.sum("size").alias("n"))
    few = F.col("n") <= least
    size = size.select("key", "main", F.when(few, 1).otherwise(F.ceil((F.col("n") - F.col("most")) / least)).cast("long").alias("many"), F.when(few, 0).otherwise(F.ceil(F.col("most") / least)).cast("long").alias("last"))
    rows = rows.drop("n").join(size, "key")
    inside = (F.col("root") == F.col("main")) & (F.col("last") > 0)
    place = F.xxhash64("doc_id")
    rows = rows.withColumn("block", F.when(inside, F.col("many") + F.pmod(place, F.greatest("last", F.lit(1)))).otherwise(F.pmod(place, F.col("many"))))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.when(inside, F.col("many") - 1).otherwise(F.col("many") + F.col("last") - 1))))
    return rows.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "doc_id", "root")


def links_within(blocked: DataFrame, signed: DataFrame, texts: DataFrame, idf, threshold: float) -> DataFrame:
    """a, b: pairs of classes that hold texts of a bucket that are similar enough. A pair of
    texts is left out only if a link of its group has joined their classes already, or if
    an earlier band has it too, whose bucket tests it. signed: doc_id, and keys of all bands
    that these buckets are of (other keys that a pair shares are tested elsewhere)."""
    texts = texts.join(signed.select("doc_id", "keys"), "doc_id")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(t: pa.Table) -> pa.Table:
        key, i, j = (t.column(c)[0].as_py() for c in ("key", "i", "j"))
        block, root = (t.column(c).to_numpy() for c in ("block", "root"))
        keys = pa.concat_arrays(t.column("keys").chunks).flatten().to_numpy().reshape(len(t), -1)
        sets = weighted(pa.concat_arrays(t.column("text").chunks), idf)
        whole = np.array([[w.sum() for w in s[1:]] for s in sets])
        names, mine = np.unique(root, return_inverse=True)
        out = []
        for x in range(len(sets) - 1):
            band = int(np.flatnonzero(keys[x] == key)[0])
            at = np.arange(x + 1, len(sets))
            ok = ~(keys[at, :band] == keys[x, :band]).any(1)
            ok &= (np.minimum(whole[at], whole[x]) >= (threshold - 1e-9) * np.maximum(whole[at], whole[x])).any(1)  # a similarity is at most their ratio
            if i < j:
                ok &= block[at] != block[x]
            for y in at[ok].tolist():
                if mine[x] != mine[y] and similarity(sets[x], sets[y]) >= threshold:
                    out.append((names[mine[x]], names[mine[y]]))
                    mine[mine == mine[y]] = mine[x]
        return pa.table([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], schema=schema)

    return blocked.join(texts, "doc_id").groupBy("key", "i", "j").applyInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """node, root (the least node connected to it) of every node of the edges.

    Each round hangs every node under the least label around it and halves the paths;
    rounds go on until nothing changes, each written to the shared folder."""
    both = written(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    label = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("root")).select(F.col("a").alias("node"), "root")
    label, path = written_at(label, "labels")
    while True:
        near = both.join(label.select(F.col("node").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("low"))
        step = label.join(near.withColumnRenamed("a", "node"), "node").select("node", "root", F.least("root", "low").alias("low"))
        up = label.select(F.col("node").alias("low"), F.col("root").alias("up"))
        step, new = written_at(step.join(up, "low").select("node", F.least("low", "up").alias("root"), (F.least("low", "up") < F.col("root")).alias("moved")), "labels")
        removed(edges.sparkSession, path)  # the round before
        label, path = step.select("node", "root"), new
        if not step.filter("moved").limit(1).count():
            return label


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id, kept (whether it is its class's first) of every document."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select("doc_id", "text")
    idf = spark.sparkContext.broadcast(inverse(frequencies(docs)))  # BUCKETS numbers
    signed = written(signatures(docs, idf, BANDS, ROWS), "signatures")
    firsts = signed.filter("doc_id is not null").groupBy("print").agg(F.min_by("keys", "doc_id").alias("keys"), F.min("doc_id").alias("doc_id"))
    firsts = written(firsts.select("print", "doc_id", "keys"), "firsts")
    pairs = written(candidates(firsts.select("doc_id", "keys")), "pairs")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()  # every text that shares a bucket
    texts = written(only(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ids), "texts")  # later joins move no others
    found = written(links(pairs, texts, idf, threshold), "links")
    roots = components(found).withColumnRenamed("node", "doc_id")
    labelled = written(firsts.join(roots, "doc_id", "left").select("print", "doc_id", F.coalesce("root", "doc_id").alias("root"), "keys"), "labelled")
    rows = written(mixed(only(labelled, ids), 3), "mixed")  # the first pass has tested the pair of a bucket of two
    texts = written(only(texts, rows.select("doc_id").distinct()), "texts")
    few = blocks(rows.filter(F.col("n") <= BLOCK), BLOCK)
    near = links_within(few, labelled, texts, idf, threshold)
    crowd = texts.join(rows.filter(F.col("n") > BLOCK).select("doc_id").distinct(), "doc_id", "left_semi")
    again = written(signatures(crowd, idf, LONG_BANDS, LONG_ROWS).select("doc_id", "keys").dropDuplicates(["doc_id"]), "long-signatures")
    long_ = blocks(mixed(again.join(labelled.select("doc_id", "root"), "doc_id"), 2), LONG_BLOCKS * BLOCK)
    near = near.unionByName(links_within(long_, again, texts, idf, threshold))
    joined = components(written(near, "links"))
    joined = joined.select(F.col("node").alias("root"), F.col("root").alias("least"))
    heads = labelled.select("print", "root").join(joined, "root", "left").select("print", F.coalesce("least", "root").alias("class_id"))
    of = signed.select("doc_id", "print").join(heads, "print").select("doc_id", "class_id").filter("doc_id is not null")
    rest = docs.filter(F.coalesce(F.trim(F.regexp_replace("text", r"[\x09-\x0D]", " ")), F.lit("")).eqNullSafe("") | F.col("doc_id").isNull())
    rest = rest.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("doc_id").cast("long").alias("class_id"))
    return of.unionByName(rest).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))


def first_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are the first of their class, with all their columns. Of rows that
    repeat such a doc_id all stay."""
    kept = classes(docs, threshold).filter("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(kept, docs["doc_id"].cast("long").eqNullSafe(kept["kept_id"]), "left_semi")
