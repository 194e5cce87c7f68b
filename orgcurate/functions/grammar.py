"""The update grammar of curation cells (G1-G6). The parsers differ on purpose: what a bare
value means depends on which check reads the cell."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

OPS = "add|delete|replace"


def _parts(x: Column) -> Column:
    return F.filter(F.transform(F.split(x, ";"), strip), lambda p: p != "")


def _op(p: Column, bare: Column) -> Column:
    op = F.regexp_extract(p, rf"(?s)^({OPS})==", 1)
    return F.when(op != "", op).when(p == "delete", F.lit("delete")).otherwise(bare)


def _value(p: Column) -> Column:
    return F.when(p == "delete", F.lit("")).otherwise(strip(F.regexp_replace(p, rf"^(?:{OPS})==", "")))


def parse_bare_replace(x: Column) -> Column:
    """G1: array of (op, value); a bare value replaces."""
    return F.transform(_parts(x), lambda p: F.struct(_op(p, F.lit("replace")).alias("op"), _value(p).alias("value")))


def parse_sticky(x: Column) -> Column:
    """A bare value has the operation before it; replace if there is none."""
    seed = F.array().cast("array<struct<op:string,value:string>>")
    step = lambda acc, p: F.concat(acc, F.array(F.struct(_op(p, F.coalesce(F.try_element_at(acc, F.lit(-1))["op"], F.lit("replace"))).alias("op"), _value(p).alias("value"))))
    return F.aggregate(_parts(x), seed, step)


def parse_spans(x: Column) -> Column:
    """An operation holds until the next one, its values parted by semicolons; text
    before the first operation is dropped; without any, values replace; the whole cell
    `delete` deletes."""
    spans = F.filter(F.split(x, rf"(?i)(?=(?:{OPS})==)"), lambda s: s.rlike(rf"(?is)^(?:{OPS})=="))
    one = lambda s: F.transform(_parts(F.regexp_replace(s, rf"(?i)^(?:{OPS})==", "")), lambda v: F.struct(F.lower(F.regexp_extract(s, rf"(?i)^({OPS})==", 1)).alias("op"), v.alias("value")))
    bare = F.transform(_parts(x), lambda v: F.struct(F.lit("replace").alias("op"), v.alias("value")))
    whole = F.array(F.struct(F.lit("delete").alias("op"), F.lit("").alias("value")))
    return F.when(F.lower(strip(x)) == "delete", whole).when(F.size(spans) > 0, F.flatten(F.transform(spans, one))).otherwise(bare)


def spelt(parsed: Column) -> Column:
    """`op=value` joined by |, for reports."""
    return F.array_join(F.transform(parsed, lambda p: F.concat(p["op"], F.lit("="), p["value"])), "|")


def action_errors(x: Column, allowed: list[str], may_clear: bool = True) -> Column:
    """kinds of errors in the actions of a filled update cell, in a fixed order.

    allowed: the field's actions; may_clear: whether all its values may be deleted."""
    ops = F.array_distinct(F.transform(parse_spans(x), lambda v: v["op"]))
    whole, marked = F.lower(strip(x)) == "delete", F.contains(x, F.lit("==")) | (F.lower(strip(x)) == "delete")
    known = whole | x.rlike(rf"(?i)(?:{OPS})==")
    has = lambda o: F.array_contains(ops, o)
    found = F.array(
        F.when(marked & ~known, F.lit("update_syntax_invalid")),
        F.when(known & (F.size(ops) > 2), F.lit("update_action_conflict")),
        F.when(known & has("replace") & (has("add") | has("delete")), F.lit("update_action_conflict")),
        F.when(known & (F.size(F.array_except(ops, F.array(*map(F.lit, allowed)))) > 0), F.lit("update_action_invalid")),
        F.when(~marked & F.lit("add" in allowed), F.lit("update_ambiguous")),
    )
    return F.when(whole & F.lit(not may_clear), F.array(F.lit("update_action_invalid"))).otherwise(F.filter(found, lambda e: e.isNotNull()))


def from_issue(x: Column) -> Column:
    """`field.op==value | field2.delete_field` to `field:op==value`, joined by semicolons."""
    one = lambda p: F.concat(F.regexp_extract(p, r"^([\w.]+?)\.(?:add|delete|replace)", 1), F.lit(":"), F.regexp_extract(p, r"^[\w.]+?\.((?:add|delete|replace)\S*)", 1))
    return F.array_join(F.transform(F.filter(F.transform(F.split(x, r"\|"), strip), lambda p: p.rlike(r"^[\w.]+?\.(?:add|delete|replace)")), one), ";")


def merged_updates(x: Column) -> Column:
    """`field.op==a | field.op==b` with the values of one field and operation put
    together, in the order in which they come first; parts of another form are dropped."""
    shape = rf"(?s)^([\w.]+\.(?:{OPS}))==(.*)$"
    parts = F.filter(F.transform(F.split(x, r"\|"), strip), lambda p: p.rlike(shape))
    entries = F.transform(parts, lambda p: F.struct(F.regexp_extract(p, shape, 1).alias("key"), strip(F.regexp_extract(p, shape, 2)).alias("value")))
    keys = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    line = lambda k: F.concat(k, F.lit("=="), F.array_join(F.array_distinct(F.transform(F.filter(entries, lambda e: e["key"] == k), lambda e: e["value"])), ";"))
    return F.array_join(F.transform(keys, line), " | ")
