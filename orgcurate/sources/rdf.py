"""Funder registries as RDF/XML, in the layouts of both vendors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The columns of the converted table; where a status or usage flag stands in an address.
FUNDER_COLUMNS = [
    "funder_id", "name", "status", "aliases", "acronyms", "abbrev_names", "funding_type", "funding_subtype", "tax_id", "region", "country_code",
    "country_geonames_id", "state_geonames_id", "affiliated_with", "narrower", "broader", "continuation_of", "replaced_by", "renamed_as", "created", "modified",
]
STATUS = r"^http://data\.(?:elsevier\.com/vocabulary/SciValFunders/FBstatus|crossref\.org/fundingdata/vocabulary)/"

_LABEL = "`skosxl:Label` struct<`skosxl:literalForm`:string>"
_REF = "struct<`_rdf:resource`:string>"
_TEXTS = {"funding_type": "fundingBodyType", "funding_subtype": "fundingBodySubType", "tax_id": "taxId", "region": "region"}
_REFS = {"country_geonames_id": "country", "state_geonames_id": "state", "continuation_of": "continuationOf", "renamed_as": "renamedAs", "affiliated_with": "affilWith", "replaced_by": "isReplacedBy"}


def _both(name: str) -> list[str]:
    """An element's names in the two layouts."""
    return [name, f"{'dct' if name == 'isReplacedBy' else 'svf'}:{name}"]


def _schema() -> str:
    alt = f"array<struct<{_LABEL.replace('` ', '`:', 1)},`emst:usageFlag`:{_REF},`fref:usageFlag`:{_REF}>>"
    fields = ["`_rdf:about` string", f"`skosxl:prefLabel` struct<{_LABEL.replace('` ', '`:', 1)}>", f"`skosxl:altLabel` {alt}", f"`rdf:type` array<{_REF}>", f"`fref:status` {_REF}"]
    fields += ["`schema:address` struct<`schema:postalAddress`:struct<`schema:addressCountry`:string>>", f"`skos:narrower` array<{_REF}>", f"`skos:broader` array<{_REF}>", "`dct:created` string", "`dct:modified` string"]
    fields += [f"`{n}` string" for x in _TEXTS.values() for n in _both(x)] + [f"`{n}` {_REF}" for x in _REFS.values() for n in _both(x)]
    return ", ".join(fields)


def _col(name: str, *inside: str) -> Column:
    c = F.col(f"`{name}`")
    for x in inside:
        c = c[x]
    return c


def _joined(values: Column) -> Column:
    """Joined by `; `, null where there are none."""
    return F.when(F.size(values) > 0, F.array_join(values, "; "))


def _texts(of: str) -> Column:
    return F.transform(F.coalesce(_col(of), F.array()), lambda x: x["_rdf:resource"])


def funders(spark: SparkSession, path: str) -> DataFrame:
    """One row for each concept, with FUNDER_COLUMNS, all strings. The vendor shows in which elements are there:
    one states its status by types (several are joined by `;`), the other by a status element, without which a
    funder is Active. Alternative labels are acronyms or abbreviated names where their flag says so, else aliases."""
    d = spark.read.format("xml").option("rowTag", "skos:Concept").schema(_schema()).load(path)
    alt = F.transform(F.coalesce("`skosxl:altLabel`", F.array()), lambda a: F.struct(a["skosxl:Label"]["skosxl:literalForm"].alias("label"), F.coalesce(a["emst:usageFlag"]["_rdf:resource"], a["fref:usageFlag"]["_rdf:resource"]).alias("flag")))
    labels = lambda keep: _joined(F.transform(F.filter(alt, keep), lambda a: a["label"]))
    types = F.transform(_texts("rdf:type"), lambda x: F.regexp_replace(x, STATUS, ""))
    out = {
        "funder_id": _col("_rdf:about"), "name": _col("skosxl:prefLabel", "skosxl:Label", "skosxl:literalForm"),
        "status": F.coalesce(F.regexp_replace(_col("fref:status", "_rdf:resource"), STATUS, ""), F.when(F.size(types) > 0, F.array_join(types, ";")), F.lit("Active")),
        "aliases": labels(lambda a: a["flag"].isNull()), "acronyms": labels(lambda a: F.lower(a["flag"]).endswith("acronym")), "abbrev_names": labels(lambda a: a["flag"].endswith("abbrevName")),
        "country_code": _col("schema:address", "schema:postalAddress", "schema:addressCountry"), "narrower": _joined(_texts("skos:narrower")), "broader": _joined(_texts("skos:broader")), "created": _col("dct:created"), "modified": _col("dct:modified"),
    }
    out |= {c: F.coalesce(*(_col(n) for n in _both(x))) for c, x in _TEXTS.items()}
    out |= {c: F.coalesce(*(_col(n, "_rdf:resource") for n in _both(x))) for c, x in _REFS.items()}
    return d.select(*(out[c].alias(c) for c in FUNDER_COLUMNS))


def links(table: DataFrame) -> DataFrame:
    """Distinct (narrower, broader) of funders, said by either side."""
    each = lambda c: F.explode(F.split(c, "; "))
    up = table.select(F.col("funder_id").alias("narrower"), each("broader").alias("broader"))
    return up.unionByName(table.select(each("narrower").alias("narrower"), F.col("funder_id").alias("broader"))).distinct()


def roots(table: DataFrame) -> DataFrame:
    """funder_id and root: the top of each funder's hierarchy, by joins. Of several broader funders the first by
    id is followed; what leads into a cycle has no root (null)."""
    from ..operators.relations import parents

    up = links(table).groupBy(F.col("narrower").alias("node")).agg(F.min("broader").alias("parent"))
    nodes = table.select(F.col("funder_id").alias("node")).distinct().join(up, "node", "left")
    known = nodes.select(F.col("node").alias("parent"), F.lit(True).alias("known"))
    h = nodes.join(known, "parent", "left").select("node", F.when(F.col("known"), F.col("parent")).alias("parent"))
    found = parents(h).withColumnRenamed("node", "funder_id")
    tops = h.filter("parent is null").select(F.col("node").alias("root"), F.lit(True).alias("top"))
    return found.join(tops, "root", "left").select("funder_id", F.when(F.col("top"), F.col("root")).alias("root"))
