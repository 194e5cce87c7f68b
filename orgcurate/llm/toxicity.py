"""Toxicity scores from a small convolutional text classifier.

Words (runs of letters, lower-cased) are embedded by two hashes, of the whole word and
of its first bytes; filters of several widths run over the words, each text keeps every
filter's maximum, and a linear layer gives the logit. Embeddings begin near zero, so that
words that the training never met hardly move a maximum, however long the text. The model
is trained in numpy from all words of every labelled text outside the held-out third, clean
texts in pieces of PIECE words; scoring goes over every whole text. For scoring, the embedding
is multiplied into the filters once, so a filter is a sum of table rows.

Where the labelled rows are at most SAMPLE, with at most LETTERS characters of either label, they
are trained on the driver. Otherwise all are dealt by a hash of their id to blocks of about
BLOCK times that. In each of ROUNDS rounds tasks train each block from the common model, and
what they changed is averaged: dense parts over all blocks, a row of the embedding over the
blocks that changed it. Changes are summed as integers, so that their order does not matter.
Words then move as two hashes of 16 bits each. The driver gets a model of fixed size a round.

Thresholds are set by language on labelled rows that took no part in the training (a fifth of
them, of each block), the language being guessed from the text alone by its function words; of
blocks, counts by language and logit, rounded to one part of CELLS, reach the driver. A score is the
logit's distance to that threshold, scaled so that the threshold becomes PREDICTED.

Defined results: null and empty texts and texts without words score as the model scores
no words; without labelled texts of both kinds that have words every score is 0; a doc_id
labelled several times is toxic if one label says so, and one of its texts, the least (in blocks
that of the least words), is learnt from; repeated rows score alike; other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._spark import arrow_type, ship, written
from ._text import U64, Words, mix, slices, strings, table_of

#: So many labelled rows, with so many characters of the texts of either label, are trained on the driver.
SAMPLE, LETTERS = 8_000, 24_000_000
#: More are dealt to blocks of about so many times that; SPARE leaves room for blocks that get more than others.
BLOCK, SPARE = 2, 1.25
ROUNDS, UNIT, MOST, CELLS = 4, 1 << 36, 10_000, 1024  # changes are summed in parts of UNIT, and none is beyond MOST
PREDICTED = 0.7
BITS, DIM, WIDTHS, FILTERS = 17, 8, (1, 2, 3), 12
EPOCHS, BATCH, RATE, PREFIX = 8, 32, 0.01, 4  # more epochs where labels are few: STEPS rows in all
STEPS = 40_000
PIECE = 400  # words of a clean training text that are one example
LANGUAGES = {
    "en": "the of and to in is that for was with are this",
    "fr": "le les des une que est pour qui dans par sur et",
    "de": "der die und von zu das mit sich des auf ist nicht",
    "es": "el que los del las por con una para lo no su",
}
LUT, VALUES = table_of(lambda b: 65 <= b <= 90 or 97 <= b <= 122 or b >= 128, seed=51)


def tokens(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each word, bucket of its first PREFIX bytes, n_rows + 1 offsets); the two
    halves of the table are for words and for beginnings."""
    w = Words(data, off, LUT, VALUES)
    with np.errstate(over="ignore"):
        begin = np.zeros(len(w.start), U64)
        for j in range(PREFIX):
            at = w.start + j
            begin = begin * U64(0x100000001B3) + np.where(at < w.end, w.bytes[np.minimum(at, max(0, len(w.bytes) - 1))], 0).astype(U64)
        begin = mix(begin + U64(77))
    half = 1 << (BITS - 1)
    return (w.h >> U64(65 - BITS)).astype(np.int64), (begin >> U64(65 - BITS)).astype(np.int64) + half, w.first


def function_words() -> np.ndarray:
    """(languages, buckets) whether a bucket is one of the language's function words."""
    out = np.zeros((len(LANGUAGES), 1 << (BITS - 1)), np.float32)
    for k, words in enumerate(LANGUAGES.values()):
        data, off = strings(pa.array([words]))
        out[k, tokens(data, off)[0]] = 1
    return out


def language(word: np.ndarray, first: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Index of the language with the most function words in each text; the first of equals."""
    out = np.zeros((len(first) - 1, len(table)))
    some = np.flatnonzero(np.diff(first))
    if len(some):
        for k in range(len(table)):
            out[some, k] = np.add.reduceat(table[k][word], first[some])
    return out.argmax(1)


class Model:
    def __init__(self, seed: int = 61):
        r = np.random.default_rng(seed)
        self.embed = r.normal(0, 0.03, (1 << BITS, DIM)).astype(np.float32)
        self.filters = [r.normal(0, 0.4, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.out = r.normal(0, 0.2, len(WIDTHS) * FILTERS).astype(np.float32)
        self.out_bias = np.float32(-1)
        self.floor = np.zeros(len(LANGUAGES), np.float32)
        self.square = np.full(len(self.embed), 1e-9, np.float32)
        self.means, self.squares = ([np.zeros_like(p) for p in self.dense()] for _ in range(2))
        self.steps = 0

    def dense(self) -> list[np.ndarray]:
        return [*self.filters, *self.bias, self.out]

    def state(self) -> np.ndarray:
        """All that training changes: rows of the embedding with their sums of squares, then the other numbers, as many a row."""
        rest = np.concatenate([*(x.ravel() for x in (*self.dense(), *self.means, *self.squares)), [self.out_bias, self.steps]])
        rest = np.pad(rest, (0, -len(rest) % (DIM + 1)))
        return np.concatenate([np.column_stack([self.embed, self.square]), rest.reshape(-1, DIM + 1)]).astype(float)

    def set_state(self, state: np.ndarray) -> None:
        n = len(self.embed)
        self.embed, self.square = state[:n, :DIM].astype(np.float32), state[:n, DIM].astype(np.float32)
        rest = state[n:].ravel()
        for x in (*self.dense(), *self.means, *self.squares):
            x[...] = rest[: x.size].reshape(x.shape)
            rest = rest[x.size :]
        for x in self.squares:  # rounded changes may end just below 0
            np.maximum(x, 0, out=x)
        self.out_bias, self.steps = np.float32(rest[0]), round(rest[1])

    def train(self, texts: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, clean: int | None = None, seed: int = 62, part: range | None = None) -> None:
        """Adam with sparse steps for the embedding. texts: (word, beginning) buckets; clean:
        the number of whole clean texts, by which labels are balanced, however many pieces they are;
        part: those of EPOCHS to train, from the state that the ones before left; all if None."""
        r = np.random.default_rng(seed)
        dense, m1, m2, square = self.dense(), self.means, self.squares, self.square
        weight = np.where(y > 0, max(1.0, 0.5 * (len(y) - y.sum() if clean is None else clean) / max(1.0, y.sum())), 1).astype(np.float32)
        step = self.steps
        epochs = EPOCHS if part else max(EPOCHS, min(4 * EPOCHS, STEPS // max(1, len(texts))))
        for epoch in part or range(epochs):
            for some in np.array_split(r.permutation(len(texts)), max(1, len(texts) // BATCH)):
                step += 1
                rate = RATE * (1 - epoch / (epochs + 1))
                size = np.array([len(texts[i][0]) for i in some])
                gap = max(WIDTHS) - 1
                first = np.cumsum(size + gap) - size - gap
                total = int((size + gap).sum())
                a, b = np.zeros(total, np.int64), np.zeros(total, np.int64)
                real = np.zeros(total, np.float32)
                for i, f, n in zip(some, first, size, strict=True):
                    a[f : f + n], b[f : f + n] = texts[i]
                    real[f : f + n] = 1
                e = (self.embed[a] + self.embed[b]) * real[:, None]
                pooled, where = [], []
                for w, fl, bias in zip(WIDTHS, self.filters, self.bias, strict=True):
                    z = sum(e[j : total - gap + j] @ fl[j] for j in range(w)) + bias
                    z = np.concatenate([z, np.full((gap, FILTERS), -1e9, np.float32)])
                    z[real == 0] = -1e9
                    top = np.maximum.reduceat(z, first, axis=0)
                    row = np.repeat(np.arange(len(some)), size + gap)
                    at = np.zeros((len(some), FILTERS), np.int64)
                    hit_pos, hit_f = np.nonzero(z == top[row])
                    at[row[hit_pos][::-1], hit_f[::-1]] = hit_pos[::-1]
                    pooled.append(np.maximum(top, 0))
                    where.append(at)
                p = np.concatenate(pooled, 1)
                logit = p @ self.out + self.out_bias
                g = weight[some] * (1 / (1 + np.exp(-logit)) - y[some]).astype(np.float32) / len(some)
                grads = [np.zeros_like(x) for x in dense]
                ge = np.zeros_like(e)
                grads[-1] = p.T @ g
                back = g[:, None] * self.out
                for k, (w, fl, at) in enumerate(zip(WIDTHS, self.filters, where, strict=True)):
                    gz = back[:, k * FILTERS : (k + 1) * FILTERS] * (pooled[k] > 0)
                    grads[len(WIDTHS) + k] = gz.sum(0)
                    for j in range(w):
                        x = e[np.minimum(at + j, total - 1)]
                        grads[k][j] = np.einsum("bfd,bf->df", x, gz)
                        np.add.at(ge, np.minimum(at + j, total - 1).ravel(), (gz[:, :, None] * fl[j].T[None]).reshape(-1, DIM))
                hit = np.flatnonzero((ge != 0).any(1) & (real > 0))
                for idx in (a[hit], b[hit]):
                    if len(idx):
                        rows, inv = np.unique(idx, return_inverse=True)
                        s = np.zeros((len(rows), DIM), np.float32)
                        np.add.at(s, inv, ge[hit])
                        square[rows] += (s**2).mean(1)
                        self.embed[rows] -= 2 * rate * s / np.sqrt(square[rows])[:, None]
                for q, gr, u, v in zip(dense, grads, m1, m2, strict=True):
                    u += 0.1 * (gr - u)
                    v += 0.01 * (gr**2 - v)
                    q -= rate * (u / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
                self.out_bias -= np.float32(rate * g.sum())
        self.steps = step

    def tables(self) -> list[list[np.ndarray]]:
        """For each width and place in the filter: the embedding times the filter's part."""
        return [[self.embed @ fl[j] for j in range(w)] for w, fl in zip(WIDTHS, self.filters, strict=True)]

    def logits(self, tables: list[list[np.ndarray]], a: np.ndarray, b: np.ndarray, first: np.ndarray) -> np.ndarray:
        n = np.diff(first)
        pooled = np.zeros((len(n), len(WIDTHS) * FILTERS), np.float32)
        some = np.flatnonzero(n)
        if len(some):
            row_end = np.repeat(first[1:], n)
            place = np.arange(len(a))
            for k, (w, t) in enumerate(zip(WIDTHS, tables, strict=True)):
                z = t[0][a] + t[0][b]
                for j in range(1, w):
                    ok = place + j < row_end
                    x, y = a[j:], b[j:]
                    z[: len(x)] += (t[j][x] + t[j][y]) * ok[: len(x), None]
                z += self.bias[k]
                pooled[some, k * FILTERS : (k + 1) * FILTERS] = np.maximum(np.maximum.reduceat(z, first[some], axis=0), 0)
        return pooled @ self.out + self.out_bias


def pieces(texts: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], list[int]]:
    """Training texts, and the text each is from: toxic ones whole, since the toxic words may
    stand anywhere, and all of each clean one in pieces of PIECE words."""
    out, of = [], []
    for i, (a, b) in enumerate(texts):
        size = len(a) if y[i] else PIECE
        for s in range(0, len(a), size):
            out.append((a[s : s + size], b[s : s + size]))
            of.append(i)
    return out, of


def to_learn() -> Column:
    """Whether a row is outside the held-out third."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) != 1


def marks(labels: DataFrame) -> DataFrame:
    """doc_id, toxic of all ids to learn from."""
    lab = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & to_learn())
    return lab.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))


def blocks_of(docs: DataFrame, lab: DataFrame, rows: int, letters: int) -> int:
    """To how many blocks all labelled rows are dealt, so that each has at most about `rows` of them and `letters`
    characters of either label; 1 if all fit into one."""
    size = docs.filter(to_learn()).select("doc_id", F.length("text").alias("size")).filter("size > 0")
    sums = size.join(lab.hint("shuffle_hash"), "doc_id").groupBy("toxic").agg(F.count("*").alias("n"), F.sum("size").alias("size")).collect()
    full = max([sum(r.n for r in sums) / rows, *(r.size / letters for r in sums)])
    return 1 if full <= 1 else math.ceil(SPARE * full)


def block(blocks: int) -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int")


def labelled_texts(docs: DataFrame, labels: DataFrame, rows: int, blocks: int | None = None) -> list[tuple[object, int, str]]:
    """(doc_id, toxic, text) of the first block of about `rows` labelled rows, in the order of a hash of the id."""
    lab = marks(labels)
    ids = lab.filter(block(blocks or blocks_of(docs, lab, rows, LETTERS)) == 0)
    own = docs.filter(F.coalesce("text", F.lit("")) != "").join(F.broadcast(ids), "doc_id")  # about `rows` ids
    found = own.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).collect()
    return sorted(((r.doc_id, r.toxic, r.text) for r in found), key=lambda r: (zlib.crc32(b"order" + str(r[0]).encode()), r[0]))


def labelled_words(docs: DataFrame, lab: DataFrame, blocks: int) -> DataFrame:
    """block, toxic, words of every labelled row with words: four bytes a word, the blocks each in one file, in the order
    of a hash of the id. Labels grow with the documents, so that they are not broadcast."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = pa.schema([("doc_id", arrow_type(docs, "doc_id")), ("words", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, d, o in slices(*strings(batch.column("text"))):
                a, b, first = tokens(d, o)
                both = np.stack([a, b - (1 << (BITS - 1))], 1).astype("<u2")
                words = pa.Array.from_buffers(pa.binary(), j - i, [None, pa.py_buffer((4 * (first - first[0])).astype(np.int32)), pa.py_buffer(both)])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), words], schema=schema)

    cut = docs.filter(to_learn() & (F.coalesce("text", F.lit("")) != "")).mapInArrow(run, f"doc_id {kind}, words binary").filter("length(words) > 0")
    own = cut.join(lab.hint("merge"), "doc_id").groupBy("doc_id", "toxic").agg(F.min("words").alias("words"))
    place = F.crc32(F.concat(F.lit("order"), F.col("doc_id").cast("string")).cast("binary"))
    own = own.select("doc_id", block(blocks).alias("block"), place.alias("place"), "toxic", "words").repartitionById(blocks, "block").sortWithinPartitions("block", "place", "doc_id")
    return written(own.select("block", "toxic", "words"), "toxicity-words")


Texts = list[tuple[np.ndarray, np.ndarray]]


def by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Texts, np.ndarray]]:
    """(block, texts, labels) of the blocks of a task's rows of labelled_words."""
    at, texts, y = None, [], []
    for batch in batches:
        for k, toxic, words in zip(*(batch.column(c).to_pylist() for c in ("block", "toxic", "words")), strict=True):
            if k != at and texts:
                yield at, texts, np.array(y, np.float32)
                texts, y = [], []
            at = k
            pair = np.frombuffer(words, "<u2").reshape(-1, 2).T.astype(np.int32)
            texts.append((pair[0], pair[1] + np.int32(1 << (BITS - 1))))
            y.append(toxic)
    if texts:
        yield at, texts, np.array(y, np.float32)


def averaged(table: DataFrame, model: Model, part: range) -> bool:
    """Trains the model's next epochs on all blocks of labelled_words; False if there is no row to train on."""
    start = model.state()
    shared = table.sparkSession.sparkContext.broadcast(start)  # of fixed size
    columns = [f"c{i}" for i in range(DIM + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, texts, y in by_block(batches):
            apart = max(1, len(y) // 5)
            short, of = pieces(texts[apart:], y[apart:])
            if not short:
                continue
            own = Model()
            own.set_state(shared.value)
            own.train(short, y[apart:][of], int((y[apart:] == 0).sum()), [k, part.start], part)
            change = np.rint(np.clip(own.state() - shared.value, -MOST, MOST) * UNIT).astype(np.int64)
            row = np.flatnonzero(change.any(1) | (np.arange(len(change)) >= 1 << BITS))
            yield pa.RecordBatch.from_arrays([pa.array(row.astype(np.int32)), *map(pa.array, change[row].T)], names=["row", *columns])

    sums = table.mapInArrow(run, ", ".join(["row int", *(f"{c} long" for c in columns)]))
    sums = sums.groupBy("row").agg(F.count("*").alias("n"), *(F.sum(c).alias(c) for c in columns)).toArrow()  # at most as many rows as the state has
    shared.destroy()
    if not sums.num_rows:
        return False
    row, n = (sums.column(c).to_numpy() for c in ("row", "n"))
    start[row] += np.column_stack([sums.column(c).to_numpy() for c in columns]) / UNIT / n[:, None]
    model.set_state(start)
    return True


def apart_counts(table: DataFrame, model: Model) -> tuple[np.ndarray, ...]:
    """(logit, language, toxic, all): how many of the rows that the blocks set apart have a logit, rounded, and a language."""
    shared = table.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, tables = function_words(), shared.value.tables()
        for _, texts, y in by_block(batches):
            for k in range(0, max(1, len(y) // 5), BATCH):
                to = min(k + BATCH, max(1, len(y) // 5))
                logit, lang = rated(shared.value, tables, words, texts[k:to])
                cell = np.rint(np.clip(logit.astype(float), -40, 40) * CELLS).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(lang.astype(np.int32)), pa.array(y[k:to].astype(np.int64))], names=["cell", "lang", "toxic"])

    cells = table.mapInArrow(run, "cell int, lang int, toxic long").groupBy("cell", "lang").agg(F.sum("toxic").alias("toxic"), F.count("*").alias("n")).toArrow()
    shared.destroy()
    return cells.column("cell").to_numpy() / CELLS, *(cells.column(c).to_numpy() for c in ("lang", "toxic", "n"))


def rated(model: Model, tables: list[list[np.ndarray]], words: np.ndarray, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(logit, language) of each text."""
    first = np.concatenate([[0], np.cumsum([len(a) for a, _ in texts])])
    a, b = (np.concatenate([x[k] for x in texts]) for k in (0, 1))
    return model.logits(tables, a, b, first), language(a, first, words)


def learned(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """A model from all labelled rows outside the held-out third; a fifth of them sets the thresholds."""
    lab = marks(labels)
    if blocks_of(docs, lab, sample, LETTERS) > 1:
        model, table = Model(), labelled_words(docs, lab, blocks_of(docs, lab, BLOCK * sample, BLOCK * LETTERS))
        if table.select("toxic").distinct().count() < 2:
            return None
        each = EPOCHS // ROUNDS
        if not all(averaged(table, model, range(k, k + each)) for k in range(0, EPOCHS, each)):
            return None
        return with_floors(model, *apart_counts(table, model))
    cut, y = [], []
    for _, toxic, text in labelled_texts(docs, labels, sample, 1):
        data, off = strings(pa.array([text], pa.large_string()))
        a, b, _ = tokens(data, off)
        if len(a):
            cut.append((a, b))
            y.append(toxic)
    y = np.array(y, np.float32)
    apart = max(1, len(y) // 5)
    if len(y) < 2 or y.min() == y.max() or y[apart:].min() == y[apart:].max():
        return None
    model = Model()
    short, of = pieces(cut[apart:], y[apart:])
    model.train(short, y[apart:][of], int((y[apart:] == 0).sum()))
    logit, lang = rated(model, model.tables(), function_words(), cut[:apart])
    return with_floors(model, logit, lang, y[:apart], np.ones(apart))


def with_floors(model: Model, logit: np.ndarray, lang: np.ndarray, toxic: np.ndarray, n: np.ndarray) -> Model:
    """The model with its thresholds: of n texts of a logit and language so many are toxic."""
    whole = threshold(logit, toxic, n)
    for k in range(len(LANGUAGES)):
        mine = lang == k
        model.floor[k] = threshold(logit[mine], toxic[mine], n[mine]) if n[mine].sum() >= 50 and 0 < toxic[mine].sum() < n[mine].sum() else whole
    return model


def threshold(logit: np.ndarray, toxic: np.ndarray, n: np.ndarray) -> float:
    """The logit at which fewest are wrong, if of n texts with a logit so many are toxic; the middle of the widest such gap."""
    order = np.argsort(logit, kind="stable")
    s, t, c = logit[order], toxic[order], (n - toxic)[order]
    wrong = np.concatenate([[0], np.cumsum(t)]) + np.concatenate([[0], np.cumsum(c[::-1])])[::-1]
    edge = np.concatenate([[s[0] - 1], (s[1:] + s[:-1]) / 2, [s[-1] + 1]])
    width = np.concatenate([[0], np.diff(s), [0]])
    best = np.flatnonzero(wrong == wrong.min())
    return float(edge[best[np.argmax(width[best])]])


def scored(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select("doc_id", "text")
    shared = spark.sparkContext.broadcast(learned(docs, labels, sample))  # a model of fixed size
    schema = pa.schema([("doc_id", arrow_type(docs, "doc_id")), ("score", pa.float64())])
    at = np.log(PREDICTED / (1 - PREDICTED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        words, tables = function_words(), model.tables() if model else []
        for batch in batches:
            for i, j, d, o in slices(*strings(batch.column("text"))):
                score = np.zeros(j - i)
                if model:
                    a, b, first = tokens(d, o)
                    logit = model.logits(tables, a, b, first).astype(float)
                    score = 1 / (1 + np.exp(-np.clip(logit - model.floor[language(a, first, words)] + at, -40, 40)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), pa.array(np.round(score, 9))], schema=schema)

    out = docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= PREDICTED).cast("int").alias("predicted"))
