"""Field checks as predicates that give an error text or null."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text

# What the registry allows.
STATUSES = ["active", "inactive", "withdrawn"]
TYPES = ["archive", "company", "education", "facility", "funder", "government", "healthcare", "nonprofit", "other"]
LANGUAGES = "aa ab ae af ak am an ar as av ay az ba be bg bh bi bm bn bo br bs ca ce ch co cr cs cu cv cy da de dv dz ee el en eo es et eu fa ff fi fj fo fr fy ga gd gl gn gu gv ha he hi ho hr ht hu hy hz ia id ie ig ii ik io is it iu ja jv ka kg ki kj kk kl km kn ko kr ks ku kv kw ky la lb lg li ln lo lt lu lv mg mh mi mk ml mn mr ms mt my na nb nd ne ng nl nn no nr nv ny oc oj om or os pa pi pl ps pt qu rm rn ro ru rw sa sc sd se sg si sk sl sm sn so sq sr ss st su sv sw ta te tg th ti tk tl tn to tr ts tt tw ty ug uk ur uz ve vi vo wa wo xh yi yo za zh zu".split()
SHAPES = {
    "url": r"^https?://.*",
    "wikipedia": r"^(?:https?://[a-z]{2,3}.wikipedia.org/.*|delete)",
    "isni": r"^(?:[0]{4} [0-9]{4} [0-9]{4} [0-9]{3}[0-9X](\*preferred)?|delete)",
    "wikidata": r"^(?:Q[1-9]\d*(?:\*preferred)?|delete)$",
    "fundref": r"^(?:[1-9]\d*(?:\*preferred)?|delete)$",
    "geonames": r"^(?:[1-9]\d*(?:\*preferred)?|delete)$",
    "domain": r"^((?=[a-z0-9-]{1,63}\.)[a-z0-9]+(-[a-z0-9]+)*\.)+[a-z]{2,63}$",
}
#: Fixed value: what follows the registry's address in a record id.
ID_TAIL = r"0[a-z0-9]{6}[0-9]{2}"
#: The first schema's external ids, change types, and which fields each change type fits.
V1_IDS = {"ISNI": r"^[0]{4} [0-9]{4} [0-9]{4} [0-9]{3}[0-9X]", "Wikidata": r"^Q[1-9]\d*", "FundRef": r"^[1-9]\d+"}
V1_CHANGES = ["change", "add", "delete", "replace"]
V1_FIELDS = ["name", "status", "established", "wikipedia_url", "links", "types", "aliases", "acronyms", "Wikidata", "ISNI", "FundRef", "GRID", "labels", "relationships", "Geonames"]
V1_REPLACE = ["links", "types", "aliases", "acronyms", "labels", "ISNI", "FundRef", "Wikidata"]
V1_CHANGE = ["name", "status", "established", "wikipedia_url", "Geonames"]
V1_NOT_LISTS = ["name", "status"]


def status_error(x: Column) -> Column:
    return F.when(~F.lower(text.strip(x)).isin(STATUSES), F.lit("status not allowed"))


def type_error(x: Column) -> Column:
    return F.when(~F.lower(text.strip(F.split(x, r"\(").getItem(0))).isin(TYPES), F.lit("type not allowed"))


def acronym_error(x: Column) -> Column:
    return F.when(~F.split(x, r"\*").getItem(0).rlike("^[A-Z0-9 ]+$"), F.lit("acronym not upper case"))


def name_error(x: Column) -> Column:
    """at most one tag mark, not at the end, then a known two-letter code."""
    n = F.length(x) - F.length(F.replace(x, F.lit("*"), F.lit("")))
    lang = F.substring_index(x, "*", -1)
    return F.when(n == 0, "no language tag").when(n > 1, "several tag marks").when(lang == "", "empty language tag").when(~lang.isin(LANGUAGES), "unknown language code")


def shape_error(x: Column, kind: str) -> Column:
    return F.when(~x.rlike(SHAPES[kind]), F.lit(f"{kind} has the wrong shape"))


def id_error(x: Column, base: str) -> Column:
    """why a record id below the address `base` is none; empty ids pass."""
    v = text.strip(x)
    ok = (F.coalesce(v, F.lit("")) == "") | v.rlike(rf"^\Q{base}\E{ID_TAIL}$")
    return F.when(ok, F.lit(None)).when(F.contains(v, F.lit(" ")), "id contains white space").when(~v.startswith(base), "id has another address").otherwise("id has the wrong shape")


def name_format_error(x: Column) -> Column:
    """a name with a tag mark must have one only, followed by a known code of two letters;
    a name without one passes."""
    v = text.strip(x)
    n = F.length(v) - F.length(F.replace(v, F.lit("*"), F.lit("")))
    lang = F.substring_index(v, "*", -1)
    return F.when(n > 1, "several tag marks").when(v.endswith("*"), "empty language tag").when((n == 1) & ~lang.rlike(r"^\p{L}{2}$"), "language code is not two letters").when((n == 1) & ~F.lower(lang).isin(LANGUAGES), "unknown language code")


def v1_update_errors(x: Column) -> Column:
    """kinds of errors in `change.field==value; ...` of the first schema, part by part in order."""

    def of(part: Column) -> Column:
        kind, rest = text.strip(F.substring_index(part, ".", 1)), F.regexp_extract(part, r"(?s)^[^.]*\.(.*)$", 1)
        name = text.strip(F.substring_index(rest, "==", 1))
        found = F.array(
            F.when(~kind.isin(V1_CHANGES), F.lit("invalid change type")), F.when(~name.isin(V1_FIELDS), F.lit("invalid field name")),
            F.when(kind.isin("add", "delete") & name.isin(V1_NOT_LISTS), F.lit("incompatible change type")),
            F.when((kind == "replace") & ~name.isin(V1_REPLACE), F.lit("incompatible change type")), F.when((kind == "change") & ~name.isin(V1_CHANGE), F.lit("incompatible change type")),
        )
        return F.when(F.contains(part, F.lit(".")) & F.contains(rest, F.lit("==")), F.filter(found, lambda e: e.isNotNull())).otherwise(F.array(F.lit("invalid format")))

    return F.flatten(F.transform(F.filter(F.split(x, ";"), lambda p: p != ""), of))


def v1_id_errors(df: DataFrame) -> DataFrame:
    """(id, name, field, value) of external ids of the wrong shape. df: id, name,
    external_ids (map of type to struct(preferred string, all array))."""
    entry = df.select("id", "name", F.explode("external_ids").alias("field", "e"))
    d = entry.select("id", "name", "field", F.explode(F.concat(F.array("e.preferred"), F.coalesce("e.all", F.array().cast("array<string>")))).alias("value")).filter("value <> ''")
    wrong = reduce(lambda acc, kv: acc | (F.col("field") == kv[0]) & ~F.col("value").rlike(kv[1]), V1_IDS.items(), F.lit(False))
    return d.filter(wrong)


def with_text(df: DataFrame, column: str, phrase: str) -> DataFrame:
    """the rows whose text has the phrase in any case, with `n`, how often."""
    low = F.lower(column)
    return df.filter(F.contains(low, F.lit(phrase.lower()))).withColumn("n", F.size(F.split(low, rf"\Q{phrase.lower()}\E")) - 1)


def year_error(x: Column) -> Column:
    """not a number, or a number that is no year of four digits."""
    n = text.strip(x).try_cast("int")
    return F.when(n.isNull(), "year is no number").when(~n.between(1000, 9999), "year out of range")


def empty_error(x: Column, what: str) -> Column:
    return F.when(F.coalesce(text.strip(x), F.lit("")) == "", F.lit(f"{what} is empty"))


def first_error(*errors: Column) -> Column:
    """F8: the first that is not null."""
    return F.coalesce(*errors)


def preferred_error(all_: Column, preferred: Column) -> Column:
    """a preferred id must be among all ids, marks of preference aside."""
    ids = F.transform(F.split(all_, ";"), lambda v: text.strip(F.replace(v, F.lit("*preferred"), F.lit(""))))
    return F.when((preferred != "") & ~F.array_contains(ids, preferred), F.lit("preferred id not among all"))


def unpivoted(df: DataFrame, record: str, fields: dict[str, Column]) -> DataFrame:
    """(record, field, value): one row per record and field, the backbone of field checks."""
    pairs = F.array(*(F.struct(F.lit(k).alias("field"), c.cast("string").alias("value")) for k, c in fields.items()))
    return df.select(F.col(record).alias("record"), F.explode(pairs).alias("p")).select("record", "p.*")


def checked(eav: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(record, field, value, error) of the values that break their field's rule."""
    error = reduce(lambda acc, kv: F.when(F.col("field") == kv[0], kv[1]).otherwise(acc), rules.items(), F.lit(None).cast("string"))
    return eav.withColumn("error", error).filter("error is not null")


def edge_characters(eav: DataFrame) -> DataFrame:
    """F16: one row for each end of a value that has white space or punctuation there."""
    at = lambda pos, what: F.when(F.substring("value", pos, 1).rlike(f"^{text.EDGE}$"), F.lit(what))
    return eav.select("record", "field", "value", F.explode(F.filter(F.array(at(1, "leading"), at(-1, "trailing")), lambda x: x.isNotNull())).alias("issue"))


def unprintables(eav: DataFrame) -> DataFrame:
    """values with unprintable characters, and which, as sorted code points."""
    d = eav.withColumn("found", text.unprintable(F.col("value"))).filter(F.size("found") > 0)
    return d.select("record", "field", F.array_join(F.transform("found", lambda c: F.lpad(F.hex(F.ascii(c)), 8, "0")), ",").alias("unprintable"))


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    """F13, from the header alone."""
    return [c for c in required if c not in df.columns]


def is_update_file(df: DataFrame, key: str = "id") -> bool:
    """any row with a filled id makes it a file of updates. This runs a job."""
    return not df.filter(text.strip(F.coalesce(key, F.lit(""))) != "").isEmpty()
