"""Language profiles and priorities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text


def profile(df: DataFrame, group: str, lang: str) -> DataFrame:
    """A1: n of each language in each group, with the group's total and greatest count."""
    n = df.filter(F.col(lang).isNotNull()).groupBy(group, lang).agg(F.count("*").alias("n"))
    w = Window.partitionBy(group)  # as many rows as there are languages
    return n.withColumn("total", F.sum("n").over(w)).withColumn("greatest", F.max("n").over(w))


def common(df: DataFrame, group: str, lang: str, share: float = 0.1, always: str | None = "en") -> DataFrame:
    """A2: languages with at least `share` of the group's total, and `always`."""
    p = profile(df, group, lang).filter(F.col("n") >= share * F.col("total")).select(group, lang)
    if always is None:
        return p
    return p.unionByName(df.filter(F.col(lang).isNotNull()).select(group, F.lit(always).alias(lang))).distinct()


def outliers(df: DataFrame, group: str, lang: str, share: float = 0.1) -> DataFrame:
    """A3, A4: languages under `share` of the group's most frequent one, other than English."""
    return profile(df, group, lang).filter((F.col("n") < share * F.col("greatest")) & (F.col(lang) != "en")).select(group, lang, "n")


def marked_outliers(df: DataFrame, place: str, lang: str, by_a: str, by_b: str, common_list: DataFrame | None = None, share: float = 0.1) -> DataFrame:
    """A4: every row with `outlier`: for English, whether one of the two detectors (arrays of languages, null
    as none) does not name it; for another language, whether it is neither in the place's list of common languages
    nor has `share` of its most frequent one. common_list: place, langs; rows without a language are outliers."""
    often = profile(df, place, lang).filter(F.col("n") >= share * F.col("greatest")).select(place, lang, F.lit(True).alias("_often"))
    d = df.join(often, [place, lang], "left")
    listed = F.lit(False)
    if common_list is not None:
        d = d.join(common_list.select(F.col("place").alias(place), F.col("langs").alias("_langs")), place, "left")
        listed = F.coalesce(F.array_contains("_langs", F.col(lang)), F.lit(False))
    named = [F.coalesce(F.array_contains(c, "en"), F.lit(False)) for c in (by_a, by_b)]
    outlier = F.when(F.col(lang) == "en", ~(named[0] & named[1])).otherwise(~(listed | F.coalesce("_often", F.lit(False))))
    return d.withColumn("outlier", outlier).select(*df.columns, "outlier")


def priority(count: Column, high: int = 100, low: int = 1, update: Column | None = None) -> Column:
    """A10: P1 from `high` on, P2 from `low` on or for updates, else P3."""
    middle = count >= low if update is None else (count >= low) | update
    return F.when(count >= high, "P1").when(middle, "P2").otherwise("P3")


def relabelled_names(records: DataFrame, given: DataFrame) -> DataFrame:
    """Names with the language that was given for their record and value, the last one
    where there are several. records: id, names. given: id, name, lang, position."""
    last = given.groupBy("id", "name").agg(F.max_by("lang", "position").alias("lang"))
    of = last.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("name", "lang"))).alias("_langs"))  # a record's own names
    new = F.transform("names", lambda n: n.withField("lang", F.coalesce(F.col("_langs")[n["value"]], n["lang"])))
    return records.join(of, "id", "left").withColumn("names", new).drop("_langs")


def usage(works: DataFrame, n: int = 10) -> DataFrame:
    """Affiliation, works (the first n by id, joined by `; `), n_works, n_authors. works:
    affiliation, work, author. Works are made distinct first, so no task gathers a whole group."""
    one = works.filter("affiliation <> ''").select("affiliation", "work").distinct()
    w = Window.partitionBy("affiliation").orderBy("work")
    first = one.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n).groupBy("affiliation").agg(F.array_join(F.array_sort(F.collect_list("work")), "; ").alias("works"))
    counts = one.groupBy("affiliation").agg(F.count("*").alias("n_works"))
    authors = works.filter("affiliation <> '' and author <> ''").select("affiliation", "author").distinct().groupBy("affiliation").agg(F.count("*").alias("n_authors"))
    return first.join(counts, "affiliation").join(authors, "affiliation", "left").withColumn("n_authors", F.coalesce("n_authors", F.lit(0)))


def longest_first(values: Column) -> Column:
    """T5: distinct values by length, the longest first; of equal lengths in their own order."""
    return F.transform(F.array_sort(F.transform(F.array_distinct(values), lambda v: F.struct((-F.length(v)).alias("k"), v.alias("v")))), lambda x: x["v"])


def initials(name: Column) -> Column:
    """Upper-case beginnings of one to three letters of all words, and the first letters of
    those words that begin with a capital, each distinct."""
    words = F.filter(F.split(name, r"\s+"), lambda w: w != "")
    of = lambda k: F.array_join(F.transform(words, lambda w: F.upper(F.left(w, F.lit(k)))), "")
    return F.array_distinct(F.array(*(of(k) for k in (1, 2, 3)), acronym(name)))


def top(values: Column, n: int) -> Column:
    """The first n of sorted (score, value), best first."""
    return F.slice(F.sort_array(values, asc=False), 1, n)


def acronym(name: Column) -> Column:
    """First letters of the capitalised words."""
    return F.array_join(F.transform(F.filter(F.split(name, r"[\s\-]+"), lambda w: w.rlike(r"^\p{Lu}")), lambda w: F.substring(w, 1, 1)), "")


def pseudo_acronyms(name: Column, most: int = 3) -> Column:
    """First letters of all words, of those that begin with a capital, and the first one to `most`
    letters of all words, in capitals; each also with letters folded to ASCII."""
    words = F.filter(F.split(name, r"\s+"), lambda w: w != "")
    of = lambda k: F.array_join(F.transform(words, lambda w: F.upper(F.left(w, F.lit(k)))), "")
    capitals = F.array_join(F.transform(F.filter(words, lambda w: w.rlike(r"^\p{Lu}")), lambda w: F.left(w, F.lit(1))), "")
    plain = F.array(*(of(k) for k in range(1, most + 1)), capitals)
    return F.array_distinct(F.concat(plain, F.transform(plain, text.folded)))


def acronym_languages(records: DataFrame, most: int = 3) -> DataFrame:
    """Id, acronym, name, lang of every acronym without a language: the last label or alias with a
    language one of whose pseudo acronyms holds the acronym; name and lang are null where none does. Records of
    the type company are left out. records: id, types, names (value, types, lang)."""
    kind = lambda n, *t: F.arrays_overlap(n["types"], F.array(*map(F.lit, t)))
    has = lambda n: F.coalesce(n["lang"], F.lit("")) != ""
    named = F.transform(F.filter("names", lambda n: has(n) & kind(n, "alias", "label")), lambda n: F.named_struct(F.lit("value"), n["value"], F.lit("lang"), n["lang"], F.lit("short"), pseudo_acronyms(n["value"], most)))
    d = records.filter(~F.coalesce(F.array_contains("types", "company"), F.lit(False))).select("id", named.alias("named"), F.explode(F.filter("names", lambda n: ~has(n) & kind(n, "acronym"))).alias("_short"))
    fits = F.filter("named", lambda n: F.exists(n["short"], lambda p: F.contains(p, F.upper(F.col("_short.value")))))
    last = F.try_element_at(fits, F.lit(-1))
    return d.select("id", F.col("_short.value").alias("acronym"), last["value"].alias("name"), last["lang"].alias("lang"))
