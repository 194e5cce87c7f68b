"""Updates applied to whole records of schema v1 (G7): one typed fold for each kind of field.

The fields of a record do not depend on each other, so each is folded by itself over its own
updates in their order, in one expression over the record and its updates. Errors are kept in order, and what
is wrong changes nothing; the tool that this follows stops there.

- name, status, established, wikipedia_url: the last value holds, whatever the operation.
- links, types, aliases, acronyms: add appends (also what is there), replace leaves the value alone,
  delete takes the first such value away, or else is an error.
- labels, `text*language` by code or name: add, replace; delete takes the last label of that text. An unknown language is an error.
- Wikidata, ISNI, FundRef, GRID: add appends, and makes `value*preferred` the preferred one; the first
  id of a type is preferred. replace leaves the value alone. delete takes the first such value, the first of the rest
  is preferred if it was that one; the last id goes with its type, whatever the value.
- relationships: whatever the operation, the last relation to the record named goes, and so does the one that
  the other record has to this one, if it has.

Updates of unknown records are errors of a row with that id alone; null ids are not used.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The fields of each kind.
SCALARS = ["name", "status", "established", "wikipedia_url"]
LISTS = ["links", "types", "aliases", "acronyms"]
EXTERNAL = ["Wikidata", "ISNI", "FundRef", "GRID"]

ERRORS = "array<struct<position:bigint,error:string>>"


def without(items: Column, place: Column) -> Column:
    """A list without the element at a place from 1."""
    return F.concat(F.slice(items, F.lit(1), place - 1), F.slice(items, place + 1, F.size(items)))


def fold(ops: Column, value: Column, kind: str, step: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """(value, errors) after ops. step: of value and operation, the new value and whether there is an error."""
    seed = F.named_struct(F.lit("value"), value.cast(kind), F.lit("errors"), F.array().cast(ERRORS))

    def one(acc: Column, u: Column) -> Column:
        new, wrong = step(acc["value"], u)
        said = F.named_struct(F.lit("position"), u["position"], F.lit("error"), F.concat_ws(" ", u["op"], u["field"], u["value"]))
        return F.named_struct(F.lit("value"), F.when(wrong, acc["value"]).otherwise(new).cast(kind), F.lit("errors"), F.when(wrong, F.concat(acc["errors"], F.array(said))).otherwise(acc["errors"]))

    return F.aggregate(ops, seed, one)


def unknown(u: Column) -> Column:
    return ~u["op"].isin("add", "delete", "replace")


def in_list(have: Column, u: Column) -> tuple[Column, Column]:
    one, place = F.array(u["value"]), F.array_position(have, u["value"])
    new = F.when(u["op"] == "add", F.concat(have, one)).when(u["op"] == "replace", one).otherwise(without(have, place.cast("int")))
    return new, unknown(u) | ((u["op"] == "delete") & (place == 0))


def in_labels(codes: Column) -> Callable[[Column, Column], tuple[Column, Column]]:
    def step(have: Column, u: Column) -> tuple[Column, Column]:
        lang = F.get(F.split(u["value"], r"\*"), F.lit(1))
        code = F.when(F.array_contains(F.map_values(codes), lang), lang).otherwise(F.try_element_at(codes, lang))
        label = F.array(F.named_struct(F.lit("label"), F.get(F.split(u["value"], r"\*"), F.lit(0)), F.lit("iso639"), code))
        place = F.array_max(F.transform(have, lambda x, i: F.when(x["label"] == u["value"], i + 1)))
        new = F.when(u["op"] == "add", F.concat(have, label)).when(u["op"] == "replace", label).otherwise(without(have, place))
        return new, unknown(u) | F.when(u["op"] == "delete", place.isNull()).otherwise(code.isNull())

    return step


def in_ids(have: Column, u: Column) -> tuple[Column, Column]:
    plain = F.get(F.split(u["value"], r"\*"), F.lit(0))
    preferred = F.contains(u["value"], F.lit("preferred"))
    entry = lambda p, a: F.named_struct(F.lit("preferred"), p, F.lit("all"), a)
    place = F.array_position(have["all"], u["value"]).cast("int")
    rest = without(have["all"], place)
    added = F.when(have.isNull(), entry(F.when(preferred, plain).otherwise(u["value"]), F.array(F.when(preferred, plain).otherwise(u["value"])))).otherwise(
        entry(F.when(preferred, plain).otherwise(have["preferred"]), F.concat(have["all"], F.array(F.when(preferred, plain).otherwise(u["value"]))))
    )
    kept = entry(F.when(have["preferred"] == u["value"], F.get(rest, F.lit(0))).otherwise(have["preferred"]), rest)
    several = F.size(have["all"]) > 1
    new = F.when(u["op"] == "add", added).when(u["op"] == "replace", entry(u["value"], F.array(u["value"]))).when(several, kept)
    return new, unknown(u) | ((u["op"] == "delete") & (have.isNull() | several & (place == 0)))


def in_relations(have: Column, u: Column) -> tuple[Column, Column]:
    place = F.array_max(F.transform(have, lambda x, i: F.when(F.contains(x["id"], u["value"]), i + 1)))
    return F.when(place.isNull(), have).otherwise(without(have, place)), place.isNull() & (u["op"] != "mirror")


def apply_updates(records: DataFrame, updates: DataFrame, codes: dict[str, str]) -> DataFrame:
    """Records after their updates, with `errors` (texts in the updates' order).

    records: id and any of the fields above; external_ids is map<type, struct<preferred, all: array>>.
    updates: id, position, op, field, value. codes: language names to codes, as in the curation tool's list.
    A record's updates are gathered into its row, of a scalar only the last."""
    columns = set(records.columns)
    known = [*(c for c in (*SCALARS, *LISTS, "labels", "relationships") if c in columns), *(EXTERNAL if "external_ids" in columns else [])]
    u = updates.filter("id is not null").select("id", F.col("position").cast("bigint").alias("position"), "op", "field", "value")
    if "relationships" in known:  # the other side of each relation that goes
        u = u.unionByName(u.filter("field = 'relationships'").select(F.col("value").alias("id"), "position", F.lit("mirror").alias("op"), "field", F.col("id").alias("value")))
    scalar = F.col("field").isin(SCALARS)
    last = u.filter(scalar).groupBy("id", "field").agg(F.max_by(F.struct("position", "op", "value"), "position").alias("x")).select("id", "x.position", "x.op", "field", "x.value")
    u = u.filter(~F.coalesce(scalar, F.lit(False))).unionByName(last)
    ops = u.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("position", "op", "field", "value"))).alias("_ops"))
    d = records.withColumn("_known", F.lit(True)).join(ops, "id", "full_outer").withColumn("_ops", F.coalesce("_ops", F.array().cast("array<struct<position:bigint,op:string,field:string,value:string>>")))
    of = lambda f: F.filter("_ops", lambda x: x["field"] == f)
    table = F.create_map(*(F.lit(x) for pair in codes.items() for x in pair)) if codes else F.create_map().cast("map<string,string>")
    types = {f.name: f.dataType for f in records.schema.fields}
    done: dict[str, Column] = {}
    for f in known:
        if f in LISTS:
            done[f] = fold(of(f), F.coalesce(F.col(f), F.array().cast(types[f])), types[f].simpleString(), in_list)
        elif f == "labels":
            done[f] = fold(of(f), F.coalesce(F.col(f), F.array().cast(types[f])), types[f].simpleString(), in_labels(table))
        elif f == "relationships":
            done[f] = fold(of(f), F.coalesce(F.col(f), F.array().cast(types[f])), types[f].simpleString(), in_relations)
        elif f in EXTERNAL:
            done[f] = fold(of(f), F.try_element_at("external_ids", F.lit(f)), types["external_ids"].valueType.simpleString(), in_ids)
    invalid = F.transform(F.filter("_ops", lambda x: ~F.coalesce(x["field"].isin(known), F.lit(False))), lambda x: F.named_struct(F.lit("position"), x["position"], F.lit("error"), F.concat_ws(" ", F.lit("no such field"), x["field"])))
    missing = F.when(F.col("_known").isNull() & F.exists("_ops", lambda x: x["op"] != "mirror"), F.array(F.named_struct(F.lit("position"), F.lit(-1).cast("bigint"), F.lit("error"), F.lit("no such record")))).otherwise(F.array().cast(ERRORS))
    d = d.withColumns({f"_{f}": c for f, c in done.items()})
    out = {f: F.coalesce(F.get(F.transform(of(f), lambda x: x["value"]), F.size(of(f)) - 1).cast(types[f]), F.col(f)) for f in known if f in SCALARS}
    out |= {f: F.col(f"_{f}.value") for f in done if f not in EXTERNAL}
    if "external_ids" in columns:
        others = F.map_filter(F.coalesce("external_ids", F.create_map().cast(types["external_ids"])), lambda k, v: ~k.isin(EXTERNAL))
        entries = F.filter(F.array(*(F.named_struct(F.lit("key"), F.lit(f), F.lit("value"), F.col(f"_{f}.value")) for f in EXTERNAL)), lambda e: e["value"].isNotNull())
        out["external_ids"] = F.map_concat(others, F.map_from_entries(entries))
    errors = F.when(F.col("_known").isNull(), missing).otherwise(F.array_sort(F.concat(invalid, *(F.col(f"_{f}.errors") for f in done))))
    return d.filter(F.col("_known").isNotNull() | (F.size(missing) > 0)).select(*(F.when(F.col("_known").isNotNull(), out[c]).alias(c) if c in out else F.col(c) for c in records.columns), F.transform(errors, lambda e: e["error"]).alias("errors"))
