"""Language detection of names by two detectors learnt from labelled texts.

1. Character trigrams of lower-case words, a multinomial for each language with add-one smoothing.
2. Function words and letters: words, and letters beyond a to z, that at least half of a
   language's texts hold; names in a script of its own (Cyrillic, Greek, ...) get its language.

A model is one table, a row for each trigram or word with a whole-number weight for each language,
of at most GRAMS + WORDS rows, so it is broadcast; names are scored where they lie, in Arrow batches,
and trigrams of texts are counted by batch before they are shuffled: neither makes a row for each trigram.
Weights are ten-thousandths, so that sums do not depend on their order. `decided` is the rule for both.

Null names get no prediction; a name without letters gets none from either detector.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import written
from .deepdiff import let

UNIT = 10_000
GRAMS, WORDS = 50_000, 10_000  # most rows of a model of either kind
LANGUAGES = 200  # most languages of a model, the most frequent ones
SHARE = 0.5
KEPT = 5  # predictions of a detector
LETTERS = 1 << 22  # letters of a batch that are worked on at once

# Unicode scripts that point to one language.
SCRIPTS = {"Cyrillic": "ru", "Greek": "el", "Han": "zh", "Hiragana": "ja", "Katakana": "ja", "Hangul": "ko", "Arabic": "ar", "Hebrew": "he", "Thai": "th", "Devanagari": "hi", "Georgian": "ka", "Armenian": "hy"}


def words(text: Column) -> Column:
    """Lower-case words of letters."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda w: w != "")


def spaced(text: Column) -> Column:
    """The words with a blank before and after each: what trigrams are taken from."""
    return F.concat(F.lit(" "), F.array_join(words(text), " "), F.lit(" "))


def slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(from, to): runs of texts of about LETTERS letters."""
    ends = np.cumsum(pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False))
    i = 0
    while i < len(ends):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + LETTERS, "right")))
        yield i, j
        i = j


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, trigram) of all trigrams of spaced texts, in order; a trigram is three code points in one integer."""
    letters = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le"), np.uint32).astype(np.int64)
    row = np.repeat(np.arange(len(texts)), pc.utf8_length(texts).to_numpy(zero_copy_only=False))
    inside = row[2:] == row[:-2]
    return row[2:][inside], (letters[:-2] << 42 | letters[1:-1] << 21 | letters[2:])[inside]


def code(token: str) -> int:
    a, b, c = map(ord, token)
    return a << 42 | b << 21 | c


def token(code: int) -> str:
    return chr(code >> 42) + chr(code >> 21 & 0x1FFFFF) + chr(code & 0x1FFFFF)


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, token, n: how often each trigram is in a batch's texts (lang, x)."""
    for b in batches:
        for i, j in slices(b.column("x")):
            row, grams = trigrams(b.column("x").slice(i, j - i))
            lang = b.column("lang").slice(i, j - i).dictionary_encode()
            of = lang.indices.to_numpy()[row]
            for k, name in enumerate(lang.dictionary.to_pylist()):
                found, n = np.unique(grams[of == k], return_counts=True)
                yield pa.RecordBatch.from_pydict({"lang": pa.array([name] * len(found), pa.string()), "token": pa.array(map(token, found.tolist()), pa.string()), "n": pa.array(n, pa.int64())})


def signs(text: Column) -> Column:
    """Distinct words, and distinct letters beyond a to z."""
    w = words(text)
    letters = F.filter(F.split(F.regexp_replace(F.array_join(w, ""), "[a-z]", ""), ""), lambda c: c != "")
    return F.array_distinct(F.concat(w, F.transform(letters, lambda c: F.concat(F.lit("letter "), c))))


@dataclass
class Model:
    """languages: in order; table: kind (gram or sign), token, and a weight w0, w1, ... for each language;
    base: what each trigram of a name, known or not, counts for each language."""

    languages: list[str]
    table: DataFrame
    base: list[int]


def learnt(labelled: DataFrame, text: str, lang: str, grams: int = GRAMS, signs_kept: int = WORDS) -> Model:
    """From all labelled texts: they are counted where they lie, and only counts are shuffled."""
    d = labelled.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    found = d.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()
    many = {r.lang: r.n for r in sorted(found, key=lambda r: r.lang)}
    names = list(many)
    if not names:
        return Model([], d.sparkSession.createDataFrame([], "kind string, token string"), [])

    def counts(t: DataFrame) -> DataFrame:
        return t.groupBy("token").agg(*(F.sum(F.when(F.col("lang") == n, F.col("n")).otherwise(0)).alias(f"n{i}") for i, n in enumerate(names)))

    total = reduce(lambda a, b: a + b, (F.col(f"n{i}") for i in range(len(names))))
    g = written(counts(d.select("lang", spaced(F.col("text")).alias("x")).mapInArrow(counted, "lang string, token string, n long")), "trigrams")
    s = counts(d.select("lang", F.explode(signs(F.col("text"))).alias("token"), F.lit(1).cast("long").alias("n")))
    size = g.agg(F.count("*").alias("v"), *(F.sum(f"n{i}").alias(f"n{i}") for i in range(len(names)))).first()  # one row
    base = g.sparkSession.range(1).select(*(F.round(F.log(F.lit((size[f"n{i}"] or 0) + size["v"] + 1)) * UNIT).cast("long") for i in range(len(names)))).first()
    g = g.orderBy(total.desc(), "token").limit(grams).select(F.lit("gram").alias("kind"), "token", *(F.round(F.log(F.col(f"n{i}") + 1) * UNIT).cast("long").alias(f"w{i}") for i in range(len(names))))
    typical = [F.col(f"n{i}") >= SHARE * many[n] for i, n in enumerate(names)]
    of = reduce(lambda a, b: a + b, (t.cast("int") for t in typical))
    s = s.withColumn("of", of).filter("of > 0").orderBy(total.desc(), "token").limit(signs_kept).select(F.lit("sign").alias("kind"), "token", *(F.when(t, F.round(UNIT / F.col("of"))).otherwise(0).cast("long").alias(f"w{i}") for i, t in enumerate(typical)))
    return Model(names, g.unionByName(s), list(base))


def best(languages: list[str], ranks: Column, scores: Column) -> Column:
    """The KEPT best (lang, score) of whole-number ranks and scores from 0 to 1, both in the languages' order, which decides ties."""
    named = F.array(*map(F.lit, languages))
    made = F.transform(ranks, lambda r, i: F.named_struct(F.lit("r"), -r, F.lit("i"), i, F.lit("score"), F.get(scores, i)))
    kept = F.filter(F.array_sort(made), lambda x: x["score"] > 0)
    return F.transform(F.slice(kept, 1, KEPT), lambda x: F.named_struct(F.lit("lang"), F.get(named, x["i"]), F.lit("score"), x["score"]))


def shares(values: Column) -> Column:
    """Each value's share of their sum; nulls if that is 0."""
    return let(F.aggregate(values, F.lit(0.0), lambda a, x: a + x), lambda every: F.transform(values, lambda x: F.try_divide(x, every)))


NO_PREDICTION = "array<struct<lang:string,score:double>>"


def scored(model: Model):
    """For mapInArrow, from name, x (spaced), signs to name, g, s: for each language the sums of the weights of trigrams
    (null where there are none) and of signs."""
    known, many = model.table.toArrow(), len(model.languages)
    kinds = {k: known.filter(pc.equal(known["kind"], k)) for k in ("gram", "sign")}
    weights = {k: np.array([t[f"w{i}"].to_numpy() for i in range(many)], np.int64).reshape(many, -1).T for k, t in kinds.items()}
    grams = np.array([code(t) for t in kinds["gram"]["token"].to_pylist()], np.int64)
    order = np.argsort(grams)
    none = np.zeros((1, many), np.int64)  # for what the model does not have
    shared = model.table.sparkSession.sparkContext.broadcast((grams[order], np.concatenate([weights["gram"][order], none]) - np.array(model.base, np.int64), kinds["sign"]["token"].combine_chunks().cast(pa.string()), np.concatenate([weights["sign"], none])))

    def summed(row: np.ndarray, at: np.ndarray, of: np.ndarray, rows: int) -> np.ndarray:
        out = np.zeros((rows, many), np.int64)
        first = np.flatnonzero(np.diff(row, prepend=-1))
        for i in range(many if len(row) else 0):
            out[row[first], i] = np.add.reduceat(of[at, i], first)
        return out

    def arrays(sums: np.ndarray, null: np.ndarray | None = None) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.arange(len(sums) + 1) * many, pa.int32()), pa.array(sums.ravel()), mask=None if null is None else pa.array(null))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, gram_weights, tokens, sign_weights = shared.value
        for batch in batches:
            for i, j in slices(batch.column("x")):
                b = batch.slice(i, j - i)
                row, found = trigrams(b.column("x"))
                at = np.searchsorted(grams, found)
                at[at == len(grams)] = 0
                at = np.where(grams[at] == found, at, len(grams)) if len(grams) else np.zeros(len(found), np.int64)
                has = np.zeros(j - i, bool)
                has[row] = True
                g = summed(row, at, gram_weights, j - i)
                of = np.repeat(np.arange(j - i), pc.list_value_length(b.column("signs")).to_numpy(zero_copy_only=False))
                sign = pc.fill_null(pc.index_in(pc.list_flatten(b.column("signs")), value_set=tokens), len(tokens)).to_numpy()
                s = summed(of, sign, sign_weights, j - i)
                yield pa.RecordBatch.from_arrays([b.column("name"), arrays(g, ~has), arrays(s)], names=["name", "g", "s"])

    return run


def detected(names: DataFrame, name: str, model: Model) -> DataFrame:
    """name, by_grams, by_signs (arrays of lang, score, best first) of each distinct name."""
    n = names.select(F.col(name).alias("name")).filter("name is not null").distinct()
    if not model.languages:
        return n.select("name", F.array().cast(NO_PREDICTION).alias("by_grams"), F.array().cast(NO_PREDICTION).alias("by_signs"))
    t = n.select("name", spaced(F.col("name")).alias("x"), signs(F.col("name")).alias("signs")).mapInArrow(scored(model), "name string, g array<long>, s array<long>")
    odds = let(F.array_max("g"), lambda top: F.transform("g", lambda x: F.exp((x - top) / UNIT)))
    t = t.select("name", F.when(F.col("g").isNotNull(), best(model.languages, F.col("g"), shares(odds))).alias("grams"), best(model.languages, F.col("s"), shares(F.transform("s", lambda x: x.cast("double")))).alias("signs"))
    script = F.filter(F.array(*(F.when(F.col("name").rlike(rf"\p{{Is{s}}}"), F.named_struct(F.lit("lang"), F.lit(v), F.lit("score"), F.lit(1.0))) for s, v in SCRIPTS.items())), lambda x: x.isNotNull())
    has = F.size(script) > 0
    none = F.array().cast(NO_PREDICTION)
    return t.select("name", F.when(has, script).otherwise(F.coalesce("grams", none)).alias("by_grams"), F.when(has, script).otherwise(F.coalesce("signs", none)).alias("by_signs"))


def agreed(a: Column, b: Column) -> Column:
    """The language that both detectors put first, else null."""
    first, other = F.get(a, F.lit(0))["lang"], F.get(b, F.lit(0))["lang"]
    return F.when(first == other, first)


def decided(a: Column, b: Column, common: Column) -> Column:
    """What both put first; else, where the place has a list of common languages, in the first
    detector's order a language that both name with scores of 0.5 together and that is common or English,
    then the first common one of either detector. Null unless both predict something."""
    lang = lambda p, keep: F.get(F.filter(p, keep), F.lit(0))["lang"]
    is_common = lambda x: F.array_contains(common, x["lang"])
    both = lang(a, lambda x: (is_common(x) | (x["lang"] == "en")) & F.exists(b, lambda y: (y["lang"] == x["lang"]) & (x["score"] + y["score"] >= 0.5)))
    placed = F.when(common.isNotNull(), F.coalesce(both, lang(a, is_common), lang(b, is_common)))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.coalesce(agreed(a, b), placed))


def tagged(names: DataFrame, model: Model, common: DataFrame | None = None, place: str | None = None) -> DataFrame:
    """Rows of `names` (name, and further columns) whose language is decided, with detected_language and
    name_w_lang (`name*lang`). Names that have a tag are left out. common: place, langs (an array), one row a place,
    few enough to broadcast if Spark sees fit; without it both detectors must agree."""
    d = names.filter(~F.contains("name", F.lit("*"))).join(detected(names.filter(~F.contains("name", F.lit("*"))), "name", model), "name")
    if common is None:
        d = d.withColumn("detected_language", agreed(F.col("by_grams"), F.col("by_signs")))
    else:
        d = d.join(common.select(F.col("place").alias(place), "langs"), place, "left").withColumn("detected_language", decided(F.col("by_grams"), F.col("by_signs"), F.col("langs"))).drop("langs")
    return d.filter("detected_language is not null").drop("by_grams", "by_signs").withColumn("name_w_lang", F.concat_ws("*", "name", "detected_language"))
