"""Exact removal of repeated strings of LENGTH bytes, by deep-shallow suffix sorting.

Sorting every suffix of the corpus would move the corpus many times over, so suffixes
are first dealt out by content: of the GRAM-byte strings inside a window of LENGTH
bytes the one with the least hash is its anchor, so equal windows have equal anchors,
at the same place. Neighbouring windows with the same anchor are one run.

1. Runs go to the task of their anchor's hash. Runs with the same 128-bit BLAKE2b digest of
   all their bytes are one class: all but its first are removed whole, so that copies of
   whole documents need not be sorted. An anchor with one class only can hold no other
   repetition.
2. For anchors with several classes, the first run of each brings its bytes, and the
   windows in these runs are sorted as suffixes: three-way multikey quicksort on words of
   8 bytes to SHALLOW bytes, then a blind trie for each group that still agrees. Each pass
   of the quicksort parts all open groups, each about its own pivot, in one set of array
   operations. Equal windows are next to each other; all but the first in (doc_id, start)
   order are removed.

Nothing grows with a group in one task but its classes: equal runs are told apart as a
sorted stream, and each task already sets aside the repetitions that it sees itself. An
anchor of more than HOT classes, such as one at the edge of a very common passage, is not
sorted in one task either: its windows are dealt out by a checksum of their bytes, each
batch sending the first of equal ones only, and sorted and compared in those parts.

Defined results: null and empty texts have no bytes and nothing to remove, texts under
LENGTH bytes lose nothing; rows with a null or a repeated doc_id are ordered among
themselves by their text and judged each.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ._spark import ship, written
from ._text import U64, mix, power_pair, ragged, random_table, slices, strings, trim

LENGTH, GRAM, SHALLOW = 100, 32, 40
#: Columns added to the documents on the way, under names that theirs will not have.
ID, SPANS = "suffix dedup id", "suffix dedup spans"
SPREAD = LENGTH - GRAM + 1
VALUES = random_table(31)
PLACE = U64((1 << 30) - 1)
SET_ASIDE = 1 << 62
#: Marks a row that holds many windows, each as doc_id, place and bytes.
PACKED = 1 << 61
#: Classes of an anchor beyond which its windows are dealt out, and windows of such a part.
HOT, PART = 512, 4096
#: Bytes of text whose runs a task holds at once.
TOGETHER = 8 << 20
#: Hot anchors that may be broadcast: 16 MB.
FEW = 1 << 20
RECORD = struct.Struct(f"<qq{LENGTH}s")
RUNS = pa.schema([("key", pa.int64()), ("class", pa.int64()), ("twin", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int64())])
FOUND = pa.schema([("doc_id", pa.int64()), ("at", pa.int64()), ("key", pa.int64())])


def runs_in(data: np.ndarray, off: np.ndarray, ids: np.ndarray) -> list[np.ndarray]:
    """key, class, twin, doc_id, at of every run of a slice. class and twin: the digest of its
    bytes. at: start << 16 | last - start << 8 | anchor - start."""
    n = len(data)
    none = [np.zeros(0, np.int64)] * 5
    if n < LENGTH:
        return none
    up, down = power_pair(n + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(n + 1, U64)
        np.cumsum(VALUES[data] * up[:n], out=total[1:])
        gram = mix((total[GRAM:] - total[:-GRAM]) * down[: n - GRAM + 1])
        low = (gram & ~PLACE) | np.arange(len(gram), dtype=U64)
        width = 1
        while 2 * width <= SPREAD:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        low = np.minimum(low[: len(low) - (SPREAD - width)], low[SPREAD - width :])
        anchor = (low & PLACE).astype(np.int64)  # of the window at each start
        row = np.repeat(np.arange(len(off) - 1), np.diff(off))[: len(anchor)]
        fits = np.arange(len(anchor)) + LENGTH <= off[1:][row]
        new = np.ones(len(anchor), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
        first = np.flatnonzero(new & fits)
        if not len(first):
            return none
        edge = np.append(np.flatnonzero(new | ~fits), len(anchor))
        last = edge[np.searchsorted(edge, first, side="right")] - 1
        a = anchor[first]
    raw = data.tobytes()
    digest = b"".join([hashlib.blake2b(raw[s:e], digest_size=16).digest() for s, e in zip(first.tolist(), (last + LENGTH).tolist(), strict=True)])
    whole = np.frombuffer(digest, np.int64).reshape(-1, 2)
    start = first - off[row[first]]
    return [gram[a].view(np.int64), whole[:, 0], whole[:, 1], ids[row[first]], start << 16 | (last - first) << 8 | (a - first)]


def together(doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs to remove, those that touch or overlap made one, of 256 starts at most."""
    if not len(doc):
        return doc, at
    start, last = at >> 16, at >> 8 & 255
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], (start + last)[order]
    rank = np.cumsum(np.concatenate([[0], doc[1:] != doc[:-1]])) * (int(end.max()) + 2)
    begin, reach = start + rank, np.maximum.accumulate(end + rank)
    first = np.flatnonzero(np.concatenate([[True], begin[1:] > reach[:-1] + 1]))
    a, e = begin[first], reach[np.append(first[1:], len(doc)) - 1]
    size = (e - a) // 256 + 1
    s = np.repeat(a, size) + 256 * ragged(np.zeros(len(a), np.int64), size)
    return np.repeat(doc[first], size), s - np.repeat(rank[first], size) << 16 | np.minimum(255, np.repeat(e, size) - s) << 8


def set_apart(parts: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Runs by class; of those in one class only the first keeps its key, the others are set
    aside, neighbours together, under keys of their own."""
    key, kind, twin, doc, at = (np.concatenate(x) for x in zip(*parts, strict=True))
    parts.clear()
    order = np.lexsort((at, doc, twin, kind, key))
    key, kind, twin, doc, at = (x[order] for x in (key, kind, twin, doc, at))
    later = np.zeros(len(key), bool)
    later[1:] = (key[1:] == key[:-1]) & (kind[1:] == kind[:-1]) & (twin[1:] == twin[:-1])
    d, a = together(doc[later], at[later])
    with np.errstate(over="ignore"):
        spread = mix(d.view(U64) * U64(0x9E3779B97F4A7C15) + a.view(U64)).view(np.int64)
    none = np.zeros(len(d), np.int64)
    key, kind, twin, doc, at = (np.append(x[~later], y) for x, y in ((key, spread), (kind, none), (twin, none), (doc, d), (at, a | SET_ASIDE)))
    for k in range(0, len(key), 200_000):
        yield pa.RecordBatch.from_arrays([pa.array(x[k : k + 200_000]) for x in (key, kind, twin, doc, at)], schema=RUNS)


def anchored(docs: DataFrame) -> DataFrame:
    """The runs of all documents, repetitions set apart within TOGETHER bytes of text or so."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for b in batches:
            ids = b.column("doc_id").to_numpy(zero_copy_only=False)
            for i, j, d, o in slices(*strings(b.column("text"))):
                parts.append(runs_in(d, o, ids[i:j]))
                size += len(d)
                if size > TOGETHER:
                    yield from set_apart(parts)
                    size = 0
        if parts:
            yield from set_apart(parts)

    return docs.mapInArrow(run, "key long, class long, twin long, doc_id long, at long")


def told_apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From runs sorted by key, class, twin, doc_id, at: those to remove (key null), and the first
    of each class where a key has several classes."""
    held: list[np.ndarray] | None = None  # the last first-of-class, which may prove to be needed
    sent = True
    before: tuple[int, int, int] | None = None
    for b in batches:
        key, kind, twin, doc, at = (b.column(c).to_numpy() for c in ("key", "class", "twin", "doc_id", "at"))
        if not len(key):
            continue
        aside = at & SET_ASIDE != 0
        out = [(doc[aside], at[aside] & ~SET_ASIDE, None)]
        key, kind, twin, doc, at = (x[~aside] for x in (key, kind, twin, doc, at))
        if len(key):
            same_key = np.zeros(len(key), bool)
            same_key[1:] = key[1:] == key[:-1]
            same = np.zeros(len(key), bool)
            same[1:] = same_key[1:] & (kind[1:] == kind[:-1]) & (twin[1:] == twin[:-1])
            if before is not None:
                same[0] = before == (int(key[0]), int(kind[0]), int(twin[0]))
            before = (int(key[-1]), int(kind[-1]), int(twin[-1]))
            out.append((*together(doc[same], at[same]), None))
            k, d, a = key[~same], doc[~same], at[~same]
            if held is not None:
                k, d, a = np.append(held[0], k), np.append(held[1], d), np.append(held[2], a)
            if len(k):
                tie = np.zeros(len(k), bool)
                tie[1:] = k[1:] == k[:-1]
                need = tie.copy()
                need[:-1] |= tie[1:]
                if held is not None and sent:
                    first_needed = need[0]
                    need[0] = False
                else:
                    first_needed = need[0]
                out.append((d[need], a[need], k[need]))
                sent = bool(need[-1]) or (len(k) == 1 and held is not None and sent) or (len(k) == 1 and first_needed)
                held = [k[-1:], d[-1:], a[-1:]]
        for d, a, k in out:
            if len(d):
                yield pa.RecordBatch.from_arrays([pa.array(d), pa.array(a), pa.nulls(len(d), pa.int64()) if k is None else pa.array(k)], schema=FOUND)


CONTEXT = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int64()), ("bytes", pa.binary())])


def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the runs that each document was asked for; of those at hot anchors the
    windows, dealt out, and what to remove of them already."""
    for b in batches:
        data, off = strings(b.column("text"))
        raw = data.tobytes()
        key, doc, at, text = [], [], [], []
        hot: dict[tuple[int, int], dict[bytes, tuple[int, int]]] = {}
        later: list[tuple[int, int]] = []
        for i, (d, wanted) in enumerate(zip(b.column("doc_id").to_pylist(), b.column("wanted").to_pylist(), strict=True)):
            for w in wanted:
                s, last = w["at"] >> 16, w["at"] >> 8 & 255
                run = raw[off[i] + s : off[i] + s + last + LENGTH]
                if w["n"] is None:
                    key.append(w["key"])
                    doc.append(d)
                    at.append(w["at"])
                    text.append(run)
                    continue
                parts = -(-w["n"] * SPREAD // PART)
                for k in range(last + 1):
                    window, place = run[k : k + LENGTH], (d, s + k)
                    first = hot.setdefault((w["key"], zlib.crc32(window) % parts), {})
                    one = first.get(window)
                    if one is None or place < one:
                        first[window] = place
                        place = one
                    if place is not None:
                        later.append(place)
        if hot:
            k, part = (np.array(x, np.int64).view(U64) for x in zip(*hot, strict=True))
            with np.errstate(over="ignore"):
                key += mix(k + (part + U64(1)) * U64(0xD6E8FEB86659FD93)).view(np.int64).tolist()
            for first in hot.values():
                doc.append(0)
                at.append(PACKED)
                text.append(b"".join(RECORD.pack(d, s << 16, window) for window, (d, s) in first.items()))
        if later:
            d, a = together(*(np.array(x, np.int64) for x in zip(*((d, s << 16) for d, s in later), strict=True)))
            with np.errstate(over="ignore"):
                key += mix(d.view(U64) + a.view(U64)).view(np.int64).tolist()  # anywhere
            doc += d.tolist()
            at += (a | SET_ASIDE).tolist()
            text += [b""] * len(d)
        yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(doc, pa.int64()), pa.array(at, pa.int64()), pa.array(text, pa.binary())], schema=CONTEXT)


def unpacked(b: pa.RecordBatch) -> tuple[pa.RecordBatch, pa.RecordBatch | None]:
    """The rows to compare, packed ones as one row for each window; and those set aside."""
    at = b.column("at").to_numpy()
    plain, packed, aside = at & (PACKED | SET_ASIDE) == 0, at & PACKED != 0, at & SET_ASIDE != 0
    if plain.all():
        return b, None
    done = None
    if aside.any():
        x = b.filter(pa.array(aside))
        done = pa.RecordBatch.from_arrays([x.column("doc_id"), pa.array(at[aside] & ~SET_ASIDE), pa.nulls(len(x), pa.int64())], schema=FOUND)
    if not packed.any():
        return b.filter(pa.array(plain)), done
    key, doc, place, text = [], [], [], []
    for k, d, p, raw in zip(*(b.column(c).to_pylist() for c in ("key", "doc_id", "at", "bytes")), strict=True):
        if p & PACKED:
            for d, p, window in RECORD.iter_unpack(raw):  # noqa: PLW2901
                key.append(k)
                doc.append(d)
                place.append(p)
                text.append(window)
        elif not p & SET_ASIDE:
            key.append(k)
            doc.append(d)
            place.append(p)
            text.append(raw)
    return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(doc, pa.int64()), pa.array(place, pa.int64()), pa.array(text, pa.binary())], schema=CONTEXT), done


def word_at(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """8 bytes from each place, as numbers that sort like the bytes."""
    out = np.zeros(len(at), U64)
    for j in range(8):
        out = out << U64(8) | text[at + j].astype(U64)
    return out


def blind_trie(text: bytes, places: list[int], depth: int) -> list[list[int]]:
    """Groups of places whose windows are equal, in the order of the windows. All agree to depth.

    Inner nodes have a depth and children by the byte there; a descent looks at those
    bytes only, then one comparison with the leaf's window finds where to branch.
    """
    root: list = [None]
    for p in places:
        window = text[p : p + LENGTH]
        node = root[0]
        if node is None:
            root[0] = (window, [p])
            continue
        while node.__class__ is list:
            node = node[1].get(window[node[0]]) or next(iter(node[1].values()))
        if node[0] == window:
            node[1].append(p)
            continue
        other, k = node[0], depth
        while other[k] == window[k]:
            k += 1
        parent, key, node = root, 0, root[0]
        while node.__class__ is list and node[0] < k:
            parent, key = node[1], window[node[0]]
            node = parent[key]
        if node.__class__ is list and node[0] == k:
            node[1][window[k]] = (window, [p])
        else:
            parent[key] = [k, {other[k]: node, window[k]: (window, [p])}]
    out, stack = [], [root[0]]
    while stack:
        node = stack.pop()
        if node.__class__ is list:
            stack += [node[1][c] for c in sorted(node[1], reverse=True)]
        else:
            out.append(node[1])
    return out


def parted(word: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One pass of the quicksort over groups that begin at `first`: an order that puts the words
    below, equal to and above the group's pivot, the median of its first, middle and last one,
    next to each other, where the parts begin in that order, and which are the equal ones."""
    size = np.diff(np.append(first, len(word)))
    ends = np.stack([word[first], word[first + size // 2], word[first + size - 1]])
    pivot = np.repeat(np.sort(ends, axis=0)[1], size)
    side = np.repeat(3 * np.arange(len(first)), size) + (word >= pivot) + (word > pivot)
    order = np.argsort(side, kind="stable")
    side = side[order]
    begin = np.flatnonzero(np.append(True, side[1:] != side[:-1]))
    return order, begin, side[begin] % 3 == 1


def shallow_groups(text: np.ndarray, at: np.ndarray, group: np.ndarray) -> Iterator[np.ndarray]:
    """Indices into at, in sets of two or more that agree to SHALLOW bytes within a group.

    Three-way multikey quicksort: the part equal to the pivot goes on with its next word, the
    others with the same one; parts of one member are done.
    """
    order = np.argsort(group, kind="stable")
    first = np.flatnonzero(np.append(True, np.diff(group[order]) != 0)) if len(order) else order
    depth = np.zeros(len(first), np.int64)
    word = word_at(text, at[order])
    while True:
        size = np.diff(np.append(first, len(order)))
        deep = (depth >= SHALLOW) & (size > 1)
        for a, n in zip(first[deep].tolist(), size[deep].tolist(), strict=True):
            yield order[a : a + n]
        open_ = (depth < SHALLOW) & (size > 1)
        if not open_.any():
            return
        rows = np.repeat(open_, size)
        order, word, depth, size = order[rows], word[rows], depth[open_], size[open_]
        first = np.cumsum(size) - size
        moved, begin, equal = parted(word, first)
        owner = np.searchsorted(first, begin, side="right") - 1
        order, word, depth, first = order[moved], word[moved], depth[owner] + 8 * equal, begin
        deeper = np.repeat(equal & (depth < SHALLOW), np.diff(np.append(first, len(order))))
        word[deeper] = word_at(text, at[order[deeper]] + np.repeat(depth, np.diff(np.append(first, len(order))))[deeper])


def sorted_groups(text: np.ndarray, at: np.ndarray, group: np.ndarray) -> Iterator[np.ndarray]:
    """Indices into at, in sets of two or more of one group whose windows of LENGTH bytes are
    equal: shallow_groups, then a blind trie for each set that it leaves."""
    raw = text.tobytes()
    for some in shallow_groups(text, at, group):
        places = at[some].tolist()
        of = dict(zip(places, some.tolist(), strict=True))
        for same in blind_trie(raw, places, SHALLOW):
            if len(same) > 1:
                yield np.array([of[p] for p in same])


def repeated(key: np.ndarray, doc: np.ndarray, at: np.ndarray, text: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(doc_id, start << 16) of the windows in these runs that an earlier one equals."""
    start, many, inner = at >> 16, at >> 8 & 255, at & 255
    anchor = off[:-1] + inner
    # A window has LENGTH bytes around its anchor: two equal ones agree on half of the rest before or after it.
    before, after = (LENGTH - GRAM) // 2 + 1, LENGTH - (LENGTH - GRAM) // 2
    n = len(text)
    up, down = power_pair(n + 1)
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, U64), np.cumsum(VALUES[text] * up[:n])])

        def shared(a: np.ndarray, b: np.ndarray, has: np.ndarray) -> np.ndarray:
            h = np.where(has, mix((total[np.where(has, b, 0)] - total[np.where(has, a, 0)]) * down[np.where(has, a, 0)] + key.view(U64)), mix(np.arange(len(a), dtype=U64)))
            _, back, count = np.unique(h, return_inverse=True, return_counts=True)
            return has & (count[back] > 1)

        right = shared(anchor, anchor + after, anchor + after <= off[1:])
        left = shared(anchor - before, anchor + GRAM, (inner >= before) & (anchor + GRAM <= off[1:]))
    near = np.where(right, np.maximum(0, inner - before + 1), np.where(left, 0, 1))
    far = np.where(left, np.where(right, many, np.minimum(many, inner - before)), np.where(right, many, -1))
    near = np.where(left, 0, near)
    size = np.maximum(0, far - near + 1)
    use = np.flatnonzero(size)
    if not len(use):
        return doc[:0], at[:0]
    owner = np.repeat(use, size[use])
    step = np.arange(len(owner)) - np.repeat(np.cumsum(size[use]) - size[use], size[use]) + near[owner]
    place, begin = off[owner] + step, start[owner] + step
    out_doc, out_at = [], []
    for same in sorted_groups(text, place, key[owner]):
        s = same[np.lexsort((begin[same], doc[owner[same]]))]
        out_doc.append(doc[owner[s[1:]]])
        out_at.append(begin[s[1:]] << 16)
    return (np.concatenate(out_doc), np.concatenate(out_at)) if out_doc else (doc[:0], at[:0])


def pieces(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The batches cut into parts of about `most` bytes, since comparing takes many times that."""
    for b in batches:
        rows = max(1, len(b) * most // max(1, b.nbytes))
        for k in range(0, len(b), rows):
            yield b.slice(k, rows)
    trim()


def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows to remove, from runs with their bytes in the order of their keys."""
    held: list[pa.RecordBatch] = []
    size = 0

    def flush(part: pa.Table) -> Iterator[pa.RecordBatch]:
        b = part.combine_chunks()
        if not len(b):
            return
        column = b.column("bytes").combine_chunks()
        column = column.cast(pa.large_binary())
        off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        text = np.frombuffer(column.buffers()[2], np.uint8)[off[0] : off[-1]]
        doc, at = repeated(*(b.column(c).to_numpy() for c in ("key", "doc_id", "at")), text, off - off[0])
        if len(doc):
            doc, at = together(doc, at)
            yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(at), pa.nulls(len(doc), pa.int64())], schema=FOUND)

    for piece in pieces(batches, 1 << 20):
        b, done = unpacked(piece)
        if done is not None:
            yield done
        if not len(b):
            continue
        held.append(b)
        size += b.nbytes
        if size > 2 << 20:  # all but the last key, which may go on
            t = pa.Table.from_batches(held)
            key = t.column("key").to_numpy()
            cut = int(np.searchsorted(key, key[-1]))
            yield from flush(t.slice(0, cut))
            t = t.slice(cut)
            held, size = t.to_batches(), t.nbytes
    if held:
        yield from flush(pa.Table.from_batches(held))


def numbered(docs: DataFrame) -> DataFrame:
    """docs with id: doc_id, or where that is null or repeated somewhere, ranks in its order."""
    odd = docs.select("doc_id").groupBy("doc_id").count().filter("count > 1 or doc_id is null").limit(1).count()
    if not odd:
        return docs.withColumn(ID, F.col("doc_id").cast("long"))
    ordered = docs.repartitionByRange("doc_id", F.md5(F.coalesce("text", F.lit("")).cast("binary"))).sortWithinPartitions("doc_id", F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    return written(ordered.withColumn(ID, F.monotonically_increasing_id()), "numbered")


def spans(docs: DataFrame) -> DataFrame:
    """docs (with ID) and SPANS, array<struct<s, e>>: byte intervals to remove, in any order, may overlap."""
    ship(docs.sparkSession)
    texts = docs.select(F.col(f"`{ID}`").alias("doc_id"), "text")
    runs = anchored(texts).repartition("key").sortWithinPartitions("key", "class", "twin", "doc_id", "at")
    found = written(runs.mapInArrow(told_apart, "doc_id long, at long, key long"), "runs")
    runs = found.filter("key is not null")
    hot = runs.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > HOT)
    runs = runs.join(F.broadcast(hot) if hot.count() <= FEW else written(hot, "hot"), "key", "left")  # a hot key's rows can be split
    wanted = runs.groupBy("doc_id").agg(F.collect_list(F.struct("key", "at", "n")).alias("wanted"))  # a document's own runs
    context = texts.join(wanted, "doc_id").mapInArrow(contexts, "key long, doc_id long, at long, bytes binary")
    more = context.repartition("key").sortWithinPartitions("key", "doc_id", "at").mapInArrow(compared, "doc_id long, at long, key long")
    start = F.shiftright("at", 16)
    span = F.struct(start.cast("int").alias("s"), (start + F.shiftright("at", 8).bitwiseAND(255) + LENGTH).cast("int").alias("e"))
    all_ = found.filter("key is null").unionByName(more).select(F.col("doc_id").alias(ID), span.alias("span"))
    return docs.join(all_.groupBy(f"`{ID}`").agg(F.collect_list("span").alias(SPANS)), ID, "left")


def merged(found: list[dict] | None) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted((x["s"], x["e"]) for x in found or ()):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    d = spans(numbered(docs.select("doc_id", "text"))).select("doc_id", "text", F.col(f"`{SPANS}`"))
    schema = pa.schema([("doc_id", to_arrow_schema(d.schema).field("doc_id").type), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text, found in zip(b.column("text").to_pylist(), b.column(SPANS).to_pylist(), strict=True):
                raw, cut, h, last = (text or "").encode(), merged(found), hashlib.sha256(), 0
                for s, e in cut:
                    h.update(raw[last:s])
                    last = e
                h.update(raw[last:])
                rows.append((len(raw), sum(e - s for s, e in cut), len(cut), h.hexdigest()))
            cols = zip(*rows, strict=True) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, f.type) for c, f in zip(cols, list(schema)[1:], strict=True))], schema=schema)

    return d.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def clean(docs: DataFrame) -> DataFrame:
    """docs with the repeated strings cut out of text, and n_chars, if there, set anew.

    A character goes if all its bytes do; documents of which nothing is left go too.
    """
    d = spans(numbered(docs))
    schema = to_arrow_schema(docs.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, keep = [], []
            for text, found in zip(b.column("text").to_pylist(), b.column(SPANS).to_pylist(), strict=True):
                if found:
                    raw, last, parts = text.encode(), 0, []
                    for s, e in merged(found):
                        while s < len(raw) and raw[s] & 0xC0 == 0x80:
                            s += 1
                        while e < len(raw) and raw[e] & 0xC0 == 0x80:
                            e -= 1
                        if e > s:
                            parts.append(raw[last:s])
                            last = e
                    new = b"".join([*parts, raw[last:]]).decode()
                    keep.append(bool(new.strip()))
                    text = new
                else:
                    keep.append(True)
                texts.append(text)
            cols = []
            for f in schema:
                c = b.column(f.name)
                if f.name == "text":
                    c = pa.array(texts, f.type)
                elif f.name == "n_chars":
                    c = pa.array([old if t is None else len(t) for t, old in zip(texts, c.to_pylist(), strict=True)], f.type)
                cols.append(c)
            yield pa.RecordBatch.from_arrays(cols, schema=schema).filter(pa.array(keep, pa.bool_()))

    return d.select(*(F.col(f"`{c}`") for c in docs.columns), F.col(f"`{SPANS}`")).mapInArrow(run, docs.schema)
