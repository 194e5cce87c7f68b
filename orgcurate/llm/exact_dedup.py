"""Exact duplicates by counting quotient filters.

Texts are compared without the characters [\\x20\\x09-\\x0D]. Every text has a 64-bit
fingerprint. Each partition builds a counting quotient filter of its fingerprints: the upper
bits of a fingerprint, the quotient, name a slot, the rest is the remainder; a slot holds its
remainders in ascending order with a count each. Filters merge without loss by
merging the sorted remainders of equal slots and adding the counts. They are exchanged in blocks of
neighbouring slots, so that a merge holds one block: about BLOCK fingerprints whatever the
size of the input.

A fingerprint counted once belongs to a text of its own, which is never moved. Texts whose
fingerprint is counted more than once are verified byte by byte: their copies are collapsed
in each batch before they are shuffled, and Spark groups what is left by the whole text. Rows find
their group by fingerprint and SHA-256, after the grouping by bytes has shown that no two
texts share both; if two did, the job would stop with an error rather than join them.

Defined results: a null text counts as empty; the empty texts, and those of white space alone, are
one group. Of equal texts the row with the most code points in the original stays, then the
smallest doc_id, null ids last; rows of the same id are each counted, and are all kept if
theirs is the id that stays. An empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import arrow_type, ship, written
from ._text import U64

SPACE = b" \t\n\x0b\x0c\r"
BLOCK = 1 << 16
SLOT_BITS = 10  # slots of a block, as a power of 2


def normalised(raw: bytes) -> bytes:
    return raw.translate(None, SPACE)


def fingerprint(raw: bytes) -> int:
    return xxhash.xxh3_64_intdigest(raw)


Print = Callable[[bytes], int]


class Filter:
    """A counting quotient filter over the fingerprints that share `prefix` as their upper bits.

    slots: how many distinct remainders each slot has; remainders, counts: of all slots one
    after another, ascending within a slot. With its prefix and slot a remainder is the whole
    fingerprint, so nothing is lost."""

    def __init__(self, bits: int, prefix: int, slots: np.ndarray, remainders: np.ndarray, counts: np.ndarray):
        self.bits, self.prefix, self.slots, self.remainders, self.counts = bits, prefix, slots, remainders, counts

    @classmethod
    def of(cls, bits: int, prefix: int, prints: np.ndarray, counts: np.ndarray) -> Filter:
        """From ascending distinct fingerprints."""
        low = 64 - bits - SLOT_BITS
        slot = (prints >> U64(low)) & U64((1 << SLOT_BITS) - 1)
        return cls(bits, prefix, np.bincount(slot.astype(np.int64), minlength=1 << SLOT_BITS), prints & U64((1 << low) - 1), counts)

    def prints(self) -> np.ndarray:
        """Its fingerprints, ascending."""
        low = 64 - self.bits - SLOT_BITS
        slot = np.repeat(np.arange(1 << SLOT_BITS, dtype=U64), self.slots)
        return (U64(self.prefix << (64 - self.bits) if self.bits else 0) | (slot << U64(low))) | self.remainders

    def packed(self) -> tuple[bytes, bytes, bytes]:
        """Slot lengths, remainders and the counts above one (as place and count)."""
        many = np.flatnonzero(self.counts > 1)
        return self.slots.astype("<u4").tobytes(), self.remainders.astype("<u8").tobytes(), np.stack([many, self.counts[many]]).astype("<i8").tobytes()

    @classmethod
    def unpacked(cls, bits: int, prefix: int, slots: bytes, remainders: bytes, many: bytes) -> Filter:
        r = np.frombuffer(remainders, "<u8")
        counts = np.ones(len(r), np.int64)
        place, value = np.frombuffer(many, "<i8").reshape(2, -1)
        counts[place] = value
        return cls(bits, prefix, np.frombuffer(slots, "<u4").astype(np.int64), r, counts)


def merged(filters: list[Filter]) -> Filter:
    """One filter of all: sorted runs of remainders are merged slot by slot, equal ones add their counts."""
    prints = np.concatenate([f.prints() for f in filters])
    counts = np.concatenate([f.counts for f in filters])
    order = np.argsort(prints, kind="stable")  # merges the runs, which are sorted
    prints, counts = prints[order], counts[order]
    first = np.flatnonzero(np.diff(prints, prepend=~prints[:1]) != 0)
    return Filter.of(filters[0].bits, filters[0].prefix, prints[first], np.add.reduceat(counts, first))


FILTERS = "block long, slots binary, remainders binary, many binary"


def filters(prints: DataFrame, bits: int) -> DataFrame:
    """Of one column of fingerprints (long), the filter of each partition, in blocks of equal upper bits.

    A partition's fingerprints are its own share of the input, 8 bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [b.column(0).to_numpy().view(U64) for b in batches]
        if not found:
            return
        p, n = np.unique(np.concatenate(found), return_counts=True)
        block = p >> U64(64 - bits) if bits else np.zeros(len(p), U64)
        cut = np.append(np.flatnonzero(np.diff(block, prepend=~block[:1]) != 0), len(p))
        for lo in range(0, len(cut) - 1, 256):
            each = [(int(block[a]), *Filter.of(bits, int(block[a]), p[a:b], n[a:b]).packed()) for a, b in zip(cut[lo : lo + 256], cut[lo + 1 : lo + 257], strict=False)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*each, strict=True), (pa.int64(), pa.binary(), pa.binary(), pa.binary()), strict=True)], names=["block", "slots", "remainders", "many"])

    return prints.mapInArrow(run, FILTERS)


def repeated(prints: DataFrame, bits: int) -> DataFrame:
    """Fingerprints (fp long) counted more than once in all partitions together, with their counts."""

    def of_block(t: pa.Table) -> pa.Table:
        f = merged([Filter.unpacked(bits, *row.values()) for row in t.select(["block", "slots", "remainders", "many"]).to_pylist()])
        many = f.counts > 1
        return pa.table([pa.array(f.prints()[many].view(np.int64)), pa.array(f.counts[many])], names=["fp", "n"])

    return filters(prints, bits).groupBy("block").applyInArrow(of_block, "fp long, n long")


def code_points(raw: bytes) -> int:
    if raw.isascii():
        return len(raw)
    b = np.frombuffer(raw, np.uint8)
    return int(np.count_nonzero((b & 0xC0) != 0x80))


def keys(docs: DataFrame, of: Print) -> DataFrame:
    """doc_id, n_chars, fp and sha (32 bytes) of every row."""
    id_type = arrow_type(docs, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for x in b.column("text"):
                raw = x.as_buffer().to_pybytes() if x.is_valid else b""
                norm = normalised(raw)
                out.append((code_points(raw), signed(of(norm)), hashlib.sha256(norm).digest()))
            n, fp, sha = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(fp, pa.int64()), pa.array(sha, pa.binary())], schema=schema)

    schema = pa.schema([("doc_id", id_type), ("n_chars", pa.int64()), ("fp", pa.int64()), ("sha", pa.binary())])
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_chars long, fp long, sha binary")


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def collapsed(docs: DataFrame, of: Print) -> DataFrame:
    """fp, norm (bytes), size, best (n_chars, ~doc_id): one row for equal texts of a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: dict[bytes, list] = {}
            for i, x in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                raw = x.as_buffer().to_pybytes() if x.is_valid else b""
                best = (code_points(raw), i is not None, -i - 1 if i is not None else 0)
                had = seen.setdefault(normalised(raw), [0, best])
                had[0] += 1
                had[1] = max(had[1], best)
            yield pa.RecordBatch.from_arrays(
                [pa.array([signed(of(t)) for t in seen], pa.int64()), pa.array(list(seen), pa.binary()), pa.array([v[0] for v in seen.values()], pa.int64()), pa.array([v[1][0] for v in seen.values()], pa.int64()), pa.array([v[1][2] if v[1][1] else None for v in seen.values()], pa.int64())],
                names=["fp", "norm", "size", "n_chars", "not_id"],
            )

    c = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "fp long, norm binary, size long, n_chars long, not_id long")
    return c.select("fp", "norm", "size", F.struct("n_chars", "not_id").alias("best"))


def groups(docs: DataFrame, many: DataFrame, of: Print) -> DataFrame:
    """fp, sha, group_size, keep_id of each text whose fingerprint is in `many`, grouped by its bytes."""
    c = collapsed(docs, of).join(many.select("fp"), "fp", "left_semi")
    # By the text alone: the join may then be split at hot fingerprints, and sums are made before texts move again.
    same = c.groupBy("norm").agg(F.first("fp").alias("fp"), F.sum("size").alias("group_size"), F.max("best").alias("best"))
    same = same.select("fp", F.unhex(F.sha2("norm", 256)).alias("sha"), "group_size", F.bitwise_not("best.not_id").alias("keep_id"))
    one = F.when(F.count("*") > 1, F.raise_error(F.lit("two texts share a fingerprint and a SHA-256")).cast("long")).otherwise(F.max("group_size"))
    return same.groupBy("fp", "sha").agg(one.alias("group_size"), F.max("keep_id").alias("keep_id"))


def deduplicated(docs: DataFrame, of: Print = fingerprint) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row. of: fingerprints of bytes, 64 bits."""
    ship(docs.sparkSession)
    k = written(keys(docs, of), "keys")
    bits = max(0, (max(1, k.count()) // BLOCK).bit_length())
    many = written(repeated(k.select("fp"), bits), "repeated")
    g = written(groups(docs, many, of), "groups").withColumn("grouped", F.lit(True))
    keep = F.when(F.col("grouped"), F.col("keep_id")).otherwise(F.col("doc_id"))
    return k.join(g, ["fp", "sha"], "left").select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), keep.eqNullSafe(F.col("doc_id")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256")
    )
