"""Quality rules: a hashed n-gram log-likelihood ratio beside counted base rules.

Words and pairs of words are hashed to BUCKETS features. One multinomial is counted
on trusted documents (those labelled good), the other on all documents; a text's score is the mean, over its features, of the logarithm of the
ratio of the two smoothed probabilities. Every text at or above a threshold is kept:
no chance is involved. The threshold is that with the fewest mistakes on a fifth of the
labelled documents, which the model does not learn from; without documents of both labels
among them it is THRESHOLD. Everything is built-in column expressions. The model is one array
of BUCKETS numbers inside the plan, and no text is shuffled: features of documents, two bytes
each, and scores meet the labels in joins by doc_id.

Defined results: null and empty texts have no words, all counts 0, base_failed true
and kept false; without trusted documents or without words in them every score is 0
and only the base rules decide; repeated rows are counted and judged each; columns of documents
other than doc_id and text are not read (`filtered` keeps them all).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._spark import written

BUCKETS = 1 << 16
#: The threshold where there are no documents of one label.
THRESHOLD = -0.15
#: Scores are ordered within cells of one part of CELLS first, then cell by cell. A score is a mean of logarithms
#: of ratios of counts, so that cells are tens of thousands at most.
CELLS = 1024
SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"{SPACE}+"), lambda w: w != "")


def features(h: Column) -> Column:
    """Buckets of the words and of the neighbouring pairs, from the words' hashes."""
    pairs = F.zip_with(F.slice(h, 1, F.greatest(F.size(h) - 1, F.lit(0))), F.slice(h, 2, F.greatest(F.size(h), F.lit(1))), lambda a, b: F.xxhash64(a, b))
    return F.transform(F.concat(h, pairs), lambda x: x.bitwiseAND(BUCKETS - 1).cast("int"))


def hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def counted(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """bucket, good, raw: how often each bucket occurs in the texts of the trusted ids and in all texts;
    summed in each task before the shuffle. The ids grow with the labels, so they are dealt out, not broadcast."""
    half = BUCKETS // 2
    h = docs.select("doc_id", hashes(F.col("text")).alias("h"))  # a column of its own, else it is worked out at each use
    small = h.select("doc_id", F.transform(features(F.col("h")), lambda b: (b - half).cast("short")).alias("small"))
    marked = small.join(trusted.withColumn("mark", F.lit(1)).hint("shuffle_hash"), "doc_id", "left")
    # explode_outer: for explode a filter on the array's size is made and moved to the scan, where it works out all hashes anew
    each = marked.select(F.explode_outer("small").alias("b"), "mark").filter("b is not null").groupBy("b").agg(F.count("mark").alias("good"), F.count("*").alias("raw"))
    return each.select((F.col("b").cast("int") + half).alias("bucket"), "good", "raw")


def model(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """bucket, ratio: the log ratio of each of the BUCKETS features, to four digits."""
    spark = docs.sparkSession
    trusted = labels.filter((F.col("quality") == 1) & ~for_threshold()).select("doc_id").distinct()
    both = spark.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    both = both.join(F.broadcast(counted(docs, trusted)), "bucket", "left")  # at most BUCKETS rows
    both = written(both, "quality-model")
    total = both.agg(F.coalesce(F.sum("good"), F.lit(0)), F.coalesce(F.sum("raw"), F.lit(0))).first()
    share = lambda c, n: F.log((F.coalesce(c, F.lit(0)) + 0.5) / (n + 0.5 * BUCKETS))
    ratio = share("good", total[0]) - share("raw", total[1]) if total[0] else F.lit(0.0)
    return both.select("bucket", F.round(ratio, 4).alias("ratio"))


def for_threshold() -> Column:
    """Whether a labelled document sets the threshold instead of being learnt from."""
    return F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 4


def fitted(docs: DataFrame, labels: DataFrame, ratio: Column) -> float:
    """The threshold with the fewest mistakes on labelled documents that pass the base rules, in
    the middle between two scores; the lowest of such. One row for each cell of scores comes to the driver."""
    lab = labels.filter(F.col("quality").isin(0, 1) & for_threshold()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    some = verdict(base(docs.select("doc_id", "text").filter(for_threshold())), ratio, THRESHOLD).filter("not base_failed").select("doc_id", "score")
    scores = some.join(lab, "doc_id").groupBy("score").agg(F.sum("quality").alias("good"), F.count("*").alias("n"))
    within = Window.partitionBy("cell").orderBy("score")
    # change: in the number of mistakes, from keeping all of the cell to dropping the scores up to this one
    change = F.sum(2 * F.col("good") - F.col("n")).over(within.rowsBetween(Window.unboundedPreceding, 0))
    steps = scores.withColumn("cell", F.floor(F.col("score") * CELLS)).withColumns({"change": change, "next": F.lead("score").over(within)})
    best = F.min(F.when(F.col("next").isNotNull(), F.struct("change", "score", "next")))
    rows = steps.groupBy("cell").agg(F.sum("good").alias("good"), F.sum("n").alias("n"), F.min("score").alias("low"), F.max("score").alias("high"), best.alias("best")).orderBy("cell").collect()
    good, n = sum(r.good for r in rows), sum(r.n for r in rows)
    if not 0 < good < n:
        return THRESHOLD
    wrong, fewest, cut = n - good, n - good, rows[0].low  # all are kept
    for r, after in zip(rows, [*rows[1:], None], strict=True):
        places = [(wrong + r.best.change, r.best.score, r.best.next)] if r.best else []
        wrong += 2 * r.good - r.n
        if after:
            places.append((wrong, r.high, after.low))
        for mistakes, a, b in places:
            if mistakes < fewest:
                fewest, cut = mistakes, (a + b) / 2
    return cut


def embedded(ratios: DataFrame) -> Column:
    """The model as one constant array of the plan; it always has BUCKETS numbers."""
    numbers = [r.ratio for r in ratios.orderBy("bucket").collect()]
    return F.split(F.lit(",".join(map(str, numbers))), ",").cast("array<double>")


def base(docs: DataFrame) -> DataFrame:
    """docs with h (the words' hashes), the base counts and row_number.

    row_number is a fence: what depends on a column that is not deterministic is not moved
    below it. Without that, a filter on the verdict would be moved to the scan and would
    work out the hashes anew at each place where its condition names them."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\f\r")) != "")
    bare = text
    for c in SYMBOLS:
        bare = F.replace(bare, F.lit(c), F.lit(""))
    d = docs.withColumn("w", words(F.col("text"))).withColumn("lines", lines)
    d = d.withColumn("h", F.transform("w", lambda x: F.xxhash64(x))).withColumn("windows", F.expr(WINDOWS))
    return d.withColumns({
        "n_words": F.size("w").cast("long"),
        "word_chars": F.length(F.array_join("w", "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(bare)).cast("long"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        "n_repeat_words": F.expr(REPEATED),
        "row_number": F.monotonically_increasing_id(),
    }).drop("w", "lines", "windows").withColumn("n_words", F.when(F.col("row_number") >= 0, F.col("n_words")))


#: Hashes of the 5-word windows, in order.
WINDOWS = "transform(slice(h, 1, greatest(size(h) - 4, 0)), (x, i) -> xxhash64(x, h[i + 1], h[i + 2], h[i + 3], h[i + 4]))"
#: Words in windows found twice or more. The sort that finds the places runs only for texts that have such windows.
REPEATED = """
    CASE WHEN size(array_distinct(windows)) = size(windows) THEN 0L ELSE
    aggregate(
        sort_array(flatten(transform(array(sort_array(transform(windows, (x, i) -> struct(x AS h, i AS i)))),
            s -> filter(transform(s, (x, k) -> if((k > 0 AND s[k - 1].h = x.h) OR (k + 1 < size(s) AND s[k + 1].h = x.h), x.i, -1)), p -> p >= 0)))),
        struct(0L AS n, -5 AS last),
        (a, p) -> struct(a.n + least(5, p - a.last) AS n, p AS last),
        a -> a.n)
    END"""


def judged(docs: DataFrame, labels: DataFrame, threshold: float | None = None) -> DataFrame:
    """doc_id, the counts, score, base_failed and kept of every document; the threshold is fitted if None."""
    docs = docs.select("doc_id", "text")
    ratio = embedded(model(docs, labels))
    return verdict(base(docs), ratio, fitted(docs, labels, ratio) if threshold is None else threshold).drop("h", "text", "row_number")


def verdict(d: DataFrame, ratio: Column, threshold: float) -> DataFrame:
    f = features(F.col("h"))
    total = F.aggregate(f, F.lit(0.0), lambda a, b: a + F.get(ratio, b))
    d = d.withColumn("score", F.when((F.size("h") > 0) & (F.col("row_number") >= 0), total / (2 * F.size("h") - 1)).otherwise(0.0))
    d = d.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    return d.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))


def filtered(docs: DataFrame, labels: DataFrame, threshold: float | None = None) -> DataFrame:
    """The documents to keep, with all their columns; the threshold is fitted if None."""
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("text").alias("text"))
    ratio = embedded(model(docs.select("doc_id", "text"), labels))
    d = verdict(base(row), ratio, fitted(docs, labels, ratio) if threshold is None else threshold)
    return d.filter("kept").select("row.*")
