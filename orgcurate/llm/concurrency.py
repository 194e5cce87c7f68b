"""Peak concurrency of sales by nation: how many are open at each moment of change, and the peaks.

A sale is a span of time with a number of cents. Spans are cut at the edges of chunks of
CHUNK_S seconds: a span that begins and ends in one chunk is one piece, a longer one
leaves a piece in its first and a piece in its last chunk, and the chunks between only
count it. Equal pieces are summed before they meet, so that a chunk has at most a million
distinct ones (1,440 minutes) whatever the size of the input. Each nation-time chunk then has a static
centred interval tree over its moments; the nodes' endpoint lists carry cumulative counts
and cents, and every moment of change is stabbed. Chunks are carried forward by sums,
maxima and successors of one short row each, in two levels: EPOCH chunks of a nation, then
the nation's epochs (a few thousand for all dates that a timestamp can hold).

Defined results: times are rounded down to minutes, in UTC. Sales with a null start, and
those that end at or before their start, take no part; a sale without a non-null shipped_at
(or with a null sale_id) stays open. A null client, one that `clients` lacks or one of null
nation counts under -1; of a client's repeated rows the smallest nation counts. Repeated
sales count each. Totals that are null, not finite, or of 9e13 and more count 0 cents. Empty
tables give no rows; further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._spark import ship, written

CHUNK_S = 86_400
EPOCH = 1024
GRACE_S = 7 * 86_400
NO_NATION, ALL_NATIONS = -1, -2
BIGGEST = 9e13

SCHEMA = "nation_id int, chunk long, net_n long, net_cents long, carried_n long, carried_cents long, first_s long, top_n long, moments array<struct<from_s: long, to_s: long, n: long, cents: long, high: long>>"
MOMENT = pa.struct([(k, pa.int64()) for k in ("from_s", "to_s", "n", "cents", "high")])


class CentredTree:
    """A static centred interval tree over the ranks 1 to k.

    The nodes are the ranks in the order of a balanced search tree: a node's level is the
    number of its trailing zero bits. A span [first, last] of ranks lies at the highest node
    inside it. A node's spans are listed by their first rank and by their last, each list with
    cumulative weights, so that a stab takes two searches at each of the log k levels.
    """

    def __init__(self, k: int, first: np.ndarray, last: np.ndarray, weights: list[np.ndarray]):
        """first <= last, from 1 to k; weights: whole numbers of each span."""
        self.k, self.width = k, k + 2
        bits = np.frexp(((first - 1) ^ last).astype(np.float64))[1] - 1  # the highest bit in which they differ
        node = (last >> bits) << bits
        self.lists = []
        for edge in (first, last):
            key = node * self.width + edge
            order = np.argsort(key, kind="stable")
            self.lists.append((key[order], [np.concatenate([[0], np.cumsum(w[order])]) for w in weights]))

    def stab(self, ranks: np.ndarray) -> list[np.ndarray]:
        """The sums of each weight over the spans that hold each rank."""
        (firsts, by_first), (lasts, by_last) = self.lists
        out = [np.zeros(len(ranks), np.int64) for _ in by_first]
        for level in range(self.k.bit_length()):
            node = ((ranks >> (level + 1)) << (level + 1)) | (1 << level)
            left = ranks < node  # there a span holds the rank if it begins early enough, else if it ends late enough
            begun = np.searchsorted(firsts, node * self.width + ranks, "right"), np.searchsorted(firsts, node * self.width, "left")
            ending = np.searchsorted(lasts, (node + 1) * self.width, "left"), np.searchsorted(lasts, node * self.width + ranks, "left")
            for total, f, e in zip(out, by_first, by_last, strict=True):
                total += np.where(left, f[begun[0]] - f[begun[1]], e[ending[0]] - e[ending[1]])
        return out


def swept(nation: int, chunk: int, start: np.ndarray, end: np.ndarray, n: np.ndarray, cents: np.ndarray, absent: int) -> dict:
    """One chunk's row of SCHEMA. start, end: of pieces, `absent` where the span goes on beyond the chunk.

    Counts are without what covers the chunk wholly; `carried` is what came in and ends here."""
    comes, goes = start != absent, end != absent
    at = np.unique(np.concatenate([start[comes], end[goes]]))
    first = np.where(comes, np.searchsorted(at, start) + 1, 1)
    last = np.where(goes, np.searchsorted(at, end), len(at))
    real = first <= last  # what came in and ends at the first moment holds none
    tree = CentredTree(len(at), first[real], last[real], [n[real], cents[real]])
    held, held_cents = tree.stab(np.arange(1, len(at) + 1))
    carried, carried_cents = int(n[~comes].sum()), int(cents[~comes].sum())
    changed = (np.diff(held, prepend=carried) != 0) | (np.diff(held_cents, prepend=carried_cents) != 0)
    at, held, held_cents = at[changed], held[changed], held_cents[changed]
    high = np.maximum.accumulate(held) if len(held) else held
    return {
        "nation_id": nation, "chunk": chunk, "net_n": int(n[comes].sum() - n[goes].sum()), "net_cents": int(cents[comes].sum() - cents[goes].sum()),
        "carried_n": carried, "carried_cents": carried_cents, "first_s": int(at[0]) if len(at) else None, "top_n": int(high[-1]) if len(at) else None,
        "moments": (at, np.append(at[1:], absent)[: len(at)], held, held_cents, high),
    }


ABSENT = np.iinfo(np.int64).min


def chunk_rows(t: pa.Table) -> pa.Table:
    """The pieces of one nation and chunk to its row."""
    start, end = (t.column(c).fill_null(int(ABSENT)).to_numpy() for c in ("piece_from", "piece_to"))
    row = swept(t.column("nation_id")[0].as_py(), t.column("chunk")[0].as_py(), start, end, t.column("n").to_numpy(), t.column("cents").to_numpy(), int(ABSENT))
    at, to, *rest = row.pop("moments")
    values = pa.StructArray.from_arrays([pa.array(at), pa.array(to, mask=to == ABSENT), *map(pa.array, rest)], fields=list(MOMENT))
    arrays = [pa.array([row[c]], pa.int32() if c == "nation_id" else pa.int64()) for c in row]
    return pa.table([*arrays, pa.ListArray.from_arrays(pa.array([0, len(at)], pa.int32()), values)], names=[*row, "moments"])


def minute(c: Column) -> Column:
    """Seconds since 1970 of a time as written, rounded down to a minute. Times with a zone are shown in the session's."""
    return F.unix_date(c.cast("date")).cast("long") * 86_400 + F.hour(c) * 3_600 + F.minute(c) * 60


def spans(sales: DataFrame, lines: DataFrame, clients: DataFrame) -> DataFrame:
    """nation_id, start_s, end_s (null: never), cents of every sale that takes part.

    Both lookups are written tables of one row a key, so that Spark may split the sales of
    a hot client or sale among tasks (adaptive skew joins) in either join."""
    ends = written(lines.filter("sale_id IS NOT NULL AND shipped_at IS NOT NULL").groupBy("sale_id").agg((minute(F.max("shipped_at")) + GRACE_S).alias("end_s")), "sale-ends")
    homes = written(clients.filter("client_id IS NOT NULL AND nation_id IS NOT NULL").groupBy("client_id").agg(F.min("nation_id").cast("int").alias("nation_id")), "client-nations")
    cents = F.when(F.abs("total") < BIGGEST, F.floor(F.col("total") * 100 + 0.5)).otherwise(0)
    s = sales.filter("sold_at IS NOT NULL").select("sale_id", "client_id", minute(F.col("sold_at")).alias("start_s"), cents.alias("cents"))
    s = s.join(ends, "sale_id", "left").filter("end_s IS NULL OR end_s > start_s")
    return s.join(homes, "client_id", "left").select(F.coalesce("nation_id", F.lit(NO_NATION)).alias("nation_id"), "start_s", "end_s", "cents")


def pieces(s: DataFrame, chunk_s: int) -> DataFrame:
    """Distinct pieces of each nation and chunk with their number and cents. piece_from is null
    for a span that began in an earlier chunk, piece_to for one that goes on beyond this one."""
    a, b = (F.floor(F.col(c) / chunk_s) for c in ("start_s", "end_s"))
    null = F.lit(None).cast("long")

    def piece(chunk: Column, start: Column, end: Column) -> Column:
        return F.named_struct(F.lit("chunk"), chunk, F.lit("piece_from"), start, F.lit("piece_to"), end)

    whole = F.array(piece(a, F.col("start_s"), F.col("end_s")))
    parts = F.when(b == a, whole).when(b.isNull(), F.array(piece(a, F.col("start_s"), null))).otherwise(F.array(piece(a, F.col("start_s"), null), piece(b, null, F.col("end_s"))))
    both = F.explode(F.array(F.col("nation_id"), F.lit(ALL_NATIONS))).alias("nation_id")
    p = s.select("cents", both, parts.alias("parts")).select("nation_id", "cents", F.inline("parts"))
    return p.groupBy("nation_id", "chunk", "piece_from", "piece_to").agg(F.count("*").alias("n"), F.sum("cents").alias("cents"))


def carried(chunks: DataFrame) -> DataFrame:
    """For each nation and chunk: what is open all through it (base_n, base_cents), the highest count
    before it, the next chunk's first moment and the nation's peak, from short rows in two levels."""
    c = chunks.select("nation_id", "chunk", F.floor(F.col("chunk") / EPOCH).alias("epoch"), "net_n", "net_cents", "carried_n", "carried_cents", "first_s", "top_n")
    here, nation = (Window.partitionBy("nation_id", *k).orderBy(o) for k, o in ((["epoch"], "chunk"), ([], "epoch")))
    before, after = (Window.unboundedPreceding, -1), (1, Window.unboundedFollowing)

    def earlier(x: Column, w) -> Column:
        return F.coalesce(F.sum(x).over(w.rowsBetween(*before)), F.lit(0))

    sums = c.groupBy("nation_id", "epoch").agg(F.sum("net_n").alias("n"), F.sum("net_cents").alias("c"))
    sums = sums.select("nation_id", "epoch", earlier(F.col("n"), nation).alias("n0"), earlier(F.col("c"), nation).alias("c0"))
    c = c.join(sums, ["nation_id", "epoch"])
    c = c.withColumns({"base_n": F.col("n0") + earlier(F.col("net_n"), here) - F.col("carried_n"), "base_cents": F.col("c0") + earlier(F.col("net_cents"), here) - F.col("carried_cents")})
    c = c.withColumn("top", F.col("base_n") + F.col("top_n"))
    tops = c.groupBy("nation_id", "epoch").agg(F.max("top").alias("t"), F.min("first_s").alias("f"))
    tops = tops.select("nation_id", "epoch", F.max("t").over(nation.rowsBetween(*before)).alias("t0"), F.min("f").over(nation.rowsBetween(*after)).alias("f1"), F.max("t").over(Window.partitionBy("nation_id")).alias("peak"))
    c = c.join(tops, ["nation_id", "epoch"])
    seen = F.greatest("t0", F.max("top").over(here.rowsBetween(*before)))
    coming = F.coalesce(F.min("first_s").over(here.rowsBetween(*after)), "f1")
    return c.select("nation_id", "chunk", "base_n", "base_cents", seen.alias("seen"), coming.alias("coming"), "peak")


def peaks(sales: DataFrame, lines: DataFrame, clients: DataFrame, chunk_s: int = CHUNK_S) -> DataFrame:
    """nation_id, from_s, to_s, n_open, open_cents, high_open, is_peak of every moment of change. chunk_s: whole minutes."""
    ship(sales.sparkSession)
    trees = pieces(spans(sales, lines, clients), chunk_s).groupBy("nation_id", "chunk").applyInArrow(chunk_rows, SCHEMA)
    chunks = written(trees, "nation-chunks")
    rows = chunks.select("nation_id", "chunk", "moments").join(carried(chunks), ["nation_id", "chunk"])
    rows = rows.select("nation_id", "base_n", "base_cents", "seen", "coming", "peak", F.inline("moments"))
    n = F.col("base_n") + F.col("n")
    return rows.select(
        "nation_id", "from_s", F.coalesce("to_s", "coming").alias("to_s"), n.alias("n_open"), (F.col("base_cents") + F.col("cents")).alias("open_cents"),
        F.greatest("seen", F.col("base_n") + F.col("high")).alias("high_open"), (n == F.col("peak")).alias("is_peak"),
    )
