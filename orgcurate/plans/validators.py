"""The validators: each plans a report as a DataFrame; nothing runs until it is written.

A validator says which formats it reads and what else it needs; `plan_all` plans those
that can run with the given inputs. Each format is planned from its own input (unlike
tools that prefer one format wherever both are given).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import grammar, text
from ..operators import duplicates, fields, integrity, reshape
from ..schema import ACTIONS, KEPT, REQUIRED
from ..sources.files import with_line_numbers, write_report


class ConfigurationError(ValueError):
    """A validator was asked for by name without the inputs that it needs."""


@dataclass
class Context:
    """Inputs, as lazy tables: a curation CSV, records as JSON, the registry, places."""

    csv: DataFrame | None = None
    json: DataFrame | None = None
    registry: DataFrame | None = None
    places: DataFrame | None = None
    threshold: int = 85
    #: What record ids begin with.
    address: str = "https://reg.org/"

    def eav(self, fmt: str) -> DataFrame:
        """record, field, value of every filled value of the csv or json input."""
        if fmt == "json":
            return reshape.leaves(self.json.drop("file"), "id").withColumnRenamed("path", "field")
        df = with_line_numbers(self.csv)
        cells = [c for c in self.csv.columns if c not in ("id", "html_url")]
        pairs = F.array(*(F.struct(F.lit(c).alias("field"), F.col(f"`{c}`").alias("cell")) for c in cells))
        d = df.select(F.when(F.col("id") == "", F.concat(F.lit("row "), F.col("row_number").cast("string"))).otherwise(F.col("id")).alias("record"), F.explode(pairs).alias("p")).select("record", "p.*")
        return d.select("record", "field", F.explode(grammar.parse_bare_replace(F.col("cell"))).alias("u")).filter("u.op <> 'delete' and u.value <> ''").select("record", "field", "u.value")


@dataclass(frozen=True)
class Validator:
    name: str
    formats: tuple[str, ...]
    columns: tuple[str, ...]
    plan: Callable[[Context, str], DataFrame]
    needs: tuple[str, ...] = field(default=())

    def runnable(self, ctx: Context, fmt: str) -> bool:
        inputs = ("csv", "json") if fmt == "csv_json" else (fmt,)
        return all(getattr(ctx, k) is not None for k in (*inputs, *self.needs))


REGISTRY: dict[str, Validator] = {}


def register(name: str, formats: str, columns: str, needs: str = "") -> Callable:
    def add(plan: Callable[[Context, str], DataFrame]) -> Callable[[Context, str], DataFrame]:
        REGISTRY[name] = Validator(name, tuple(formats.split()), tuple(columns.split()), plan, tuple(needs.split()))
        return plan

    return add


NAMES = ("names.types.ror_display", "names.types.alias", "names.types.label")
PLACE = "locations.geonames_id"


def rules(v: Column) -> dict[str, Column]:
    """The check of each field; of several the first error counts (F8)."""
    shapes = {"links.type.website": "url", "links.type.wikipedia": "wikipedia", PLACE: "geonames", "domains": "domain"} | {f"external_ids.type.{k}.{p}": k for k in ("isni", "wikidata", "fundref") for p in ("all", "preferred")}
    plain = {"status": fields.status_error(v), "types": fields.type_error(v), "established": fields.year_error(v), "names.types.acronym": fields.first_error(fields.acronym_error(v), fields.name_error(v))}
    return plain | {c: fields.name_error(v) for c in NAMES} | {c: fields.shape_error(v, k) for c, k in shapes.items()} | {c: fields.empty_error(v, c) for c in ("city", "country")}


#: Fields that are not checked in update rows, and those that are not in records.
NOT_IN_UPDATES, NOT_IN_RECORDS = ("domains", "city", "country"), ("domains", "city", "country", "names.types.acronym", *NAMES)


@register("input_file_structure", "csv", "row_number field value message")
def input_file_structure(ctx: Context, fmt: str) -> DataFrame:
    missing = fields.missing_columns(ctx.csv, REQUIRED)
    if missing:  # nothing else can be said about such a file
        return ctx.csv.sparkSession.createDataFrame([(1, c, "", "missing column") for c in missing], "row_number int, field string, value string, message string")
    update = F.col("id") != ""
    value = lambda c: F.col(f"`{c}`")
    none = F.array().cast("array<string>")

    def wrong(c: str) -> Column:
        actions = F.when(update & (value(c) != ""), grammar.action_errors(value(c), ACTIONS[c], c not in KEPT)).otherwise(none)
        if not c.startswith("names."):
            return actions
        parts = F.filter(grammar.parse_bare_replace(value(c)), lambda u: (u["op"] != "delete") & (u["value"] != ""))
        return F.concat(actions, F.filter(F.transform(parts, lambda u: fields.name_format_error(u["value"])), lambda e: e.isNotNull()))

    bad_id = fields.id_error(F.col("id"), ctx.address)
    of_id = F.struct(F.lit("id").alias("field"), F.col("id").alias("value"), F.filter(F.array(bad_id), lambda e: e.isNotNull()).alias("wrong"))
    cells = F.array(of_id, *(F.struct(F.lit(c).alias("field"), value(c).alias("value"), wrong(c).alias("wrong")) for c in ACTIONS))
    d = with_line_numbers(ctx.csv).select("row_number", update.alias("is_update"), F.explode(cells).alias("c")).select("row_number", "is_update", "c.*")
    found = F.filter(F.array(
        F.when(F.col("value").rlike(r"[\r\n]"), F.lit("embedded newline")),
        F.when(~F.col("is_update") & F.col("value").rlike(rf"(?i)(?:{grammar.OPS})=="), F.lit("update syntax in a new record")),
        F.when(~F.col("is_update") & (F.col("value") == "") & F.col("field").isin("names.types.ror_display", "status", "types", PLACE), F.lit("required field is empty")),
    ), lambda e: e.isNotNull())
    return d.select("row_number", "field", text.truncated(F.col("value")).alias("value"), F.explode(F.concat(found, "wrong")).alias("message"))


def preferred_errors(df: DataFrame) -> DataFrame:
    """F9 for each kind of external id: record, field, value, error. df has cells as text."""
    kinds = [k for k in ("fundref", "isni", "wikidata") if f"external_ids.type.{k}.preferred" in df.columns]
    bare = lambda k: text.strip(F.replace(F.col(f"`external_ids.type.{k}.preferred`"), F.lit("*preferred"), F.lit("")))
    filled = lambda k: text.strip(F.col(f"`external_ids.type.{k}.all`")) != ""
    found = [F.struct(F.lit(f"external_ids.type.{k}.preferred").alias("field"), bare(k).alias("value"), F.when(filled(k), fields.preferred_error(F.col(f"`external_ids.type.{k}.all`"), bare(k))).alias("error")) for k in kinds]
    return df.select("record", F.explode(F.array(*found)).alias("p")).select("record", "p.*").filter("error is not null")


@register("validate_fields", "csv json", "record field value error")
def validate_fields(ctx: Context, fmt: str) -> DataFrame:
    checks = rules(F.col("value"))
    if fmt == "json":
        return fields.checked(extracted_values(ctx.json), {c: e for c, e in checks.items() if c not in NOT_IN_RECORDS})
    df = with_line_numbers(ctx.csv)
    here = [c for c in checks if c in ctx.csv.columns]
    parts = lambda c: F.filter(F.transform(F.split(F.col(f"`{c}`"), ";"), text.strip), lambda v: v != "")
    own = {c: F.array(F.col(f"`{c}`")) if c in ("city", "country") else F.when(F.size(parts(c)) > 0, parts(c)).otherwise(F.array(F.lit("null"))) if c == PLACE else parts(c) for c in here}
    new = df.filter("id = ''").withColumn("record", F.concat(F.lit("row "), F.col("row_number").cast("string")))
    cells = F.array(*(F.struct(F.lit(c).alias("field"), v.alias("values")) for c, v in own.items()))
    given = new.select("record", F.explode(cells).alias("p")).select("record", "p.field", F.explode("p.values").alias("value"))
    updated = ctx.eav("csv").filter(~F.col("record").startswith("row ") & ~F.col("field").isin(*NOT_IN_UPDATES))
    return fields.checked(given.unionByName(updated), {c: checks[c] for c in here}).unionByName(preferred_errors(new))


@register("leading_trailing", "csv json", "record field value issue")
def leading_trailing(ctx: Context, fmt: str) -> DataFrame:
    return fields.edge_characters(ctx.eav(fmt))


@register("unprintable-chars", "csv json", "record field unprintable")
def unprintable_chars(ctx: Context, fmt: str) -> DataFrame:
    return fields.unprintables(ctx.eav(fmt))


@register("duplicate_values", "csv json", "record value field1 field2")
def duplicate_values(ctx: Context, fmt: str) -> DataFrame:
    return duplicates.repeated_values(ctx.eav(fmt).distinct(), "record", "field", "value", fmt)


def websites(df: DataFrame) -> DataFrame:
    return df.select(F.col("id").alias("record"), text.host_of(reshape.first_link(F.col("links"))).alias("host"), reshape.display_name(F.col("names")).alias("name"))


def submitted_sites(ctx: Context, fmt: str) -> DataFrame:
    if fmt == "json":
        return websites(ctx.json)
    return ctx.csv.select(F.col("id").alias("record"), text.host_of(F.col("`links.type.website`")).alias("host"), text.clean_name(F.col("`names.types.ror_display`")).alias("name"))


@register("duplicate-urls", "csv json", "record name host registry_record registry_name", "registry")
def duplicate_urls(ctx: Context, fmt: str) -> DataFrame:
    own = submitted_sites(ctx, fmt)
    got = duplicates.same_key(own, websites(ctx.registry).withColumn("at", F.col("record")), "host", "at")
    return got.filter("record <> registry_record").select("record", "name", "host", "registry_record", "registry_name")


def exploded_domains(df: DataFrame, column: Column) -> DataFrame:
    return df.select(F.col("id").alias("record"), F.explode(column).alias("raw")).select("record", text.normalize_domain(F.col("raw")).alias("domain"), F.col("record").alias("at")).filter("domain is not null")


@register("duplicate-domains", "csv json", "record domain registry_record", "registry")
def duplicate_domains(ctx: Context, fmt: str) -> DataFrame:
    own = exploded_domains(ctx.json, F.col("domains")) if fmt == "json" else exploded_domains(ctx.csv, F.split("domains", ";"))
    got = duplicates.same_key(own, exploded_domains(ctx.registry, F.col("domains")), "domain", "at")
    return got.filter("record <> registry_record").select("record", "domain", "registry_record")


def record_ids(df: DataFrame) -> DataFrame:
    ids = F.flatten(F.transform("external_ids", lambda e: F.concat(F.coalesce(e["all"], F.array().cast("array<string>")), F.array(e["preferred"]))))
    return df.select(F.col("id").alias("record"), F.explode(F.array_distinct(ids)).alias("value")).select("record", text.normalize_whitespace(F.col("value")).alias("value")).filter("value <> ''")


@register("duplicate-external-ids", "csv json", "record other common_id", "registry")
def duplicate_external_ids(ctx: Context, fmt: str) -> DataFrame:
    own = record_ids(ctx.json) if fmt == "json" else ctx.eav("csv").filter(F.col("field").startswith("external_ids")).select("record", text.normalize_whitespace(F.col("value")).alias("value"))
    return duplicates.overlapping_ids(own, record_ids(ctx.registry), "record", "value")


def cell_names(columns: list[str]) -> Column:
    """The display name, aliases and labels of a curation row, as given."""
    parts = [F.split(F.col(f"`{c}`"), ";") if c != NAMES[0] else F.array(F.col(f"`{c}`")) for c in NAMES if c in columns]
    return F.filter(F.transform(F.concat(*parts), text.strip), lambda v: v != "")


def named_records(ctx: Context, fmt: str) -> DataFrame:
    """position, record, display, url, host, names, place of the submitted records."""
    if fmt == "json":
        kinds = F.array(*map(F.lit, ("ror_display", "alias", "label")))
        names = F.transform(F.filter("names", lambda n: F.arrays_overlap(n["types"], kinds) & (F.coalesce(n["value"], F.lit("")) != "")), lambda n: n["value"])
        place = F.get("locations", F.lit(0))["geonames_id"].cast("string")
        d = ctx.json.select(F.col("id").alias("position"), F.col("id").alias("record"), reshape.display_name(F.col("names")).alias("display"), reshape.first_link(F.col("links")).alias("url"), names.alias("names"), place.alias("place"))
    else:
        d = with_line_numbers(ctx.csv).select(F.col("row_number").alias("position"), F.when(F.col("id") == "", F.concat(F.lit("row "), F.col("row_number").cast("string"))).otherwise(F.col("id")).alias("record"), F.col(f"`{NAMES[0]}`").alias("display"), F.col("`links.type.website`").alias("url"), cell_names(ctx.csv.columns).alias("names"), text.strip(F.col(f"`{PLACE}`")).alias("place"))
    return d.withColumn("host", text.host_of(F.col("url")))


@register("in-release-duplicates", "csv json", "record1 record2 display1 url1 display2 url2 match_type score")
def in_release_duplicates(ctx: Context, fmt: str) -> DataFrame:
    own = named_records(ctx, fmt)
    side = lambda k, at: own.select(F.col("position").alias(at), F.col("record").alias(f"record{k}"), F.col("display").alias(f"display{k}"), F.col("url").alias(f"url{k}"))
    return duplicates.in_release(own, ctx.threshold).join(side(1, "first"), "first").join(side(2, "second"), "second")


@register("production-duplicates", "csv json", "record input_name matched matched_name score", "registry places")
def production_duplicates(ctx: Context, fmt: str) -> DataFrame:
    places = ctx.places.select(F.col("geonames_id").cast("string").alias("place"), F.col("country_code").alias("country"))
    own = named_records(ctx, fmt).join(places, "place").select("record", "country", F.explode("names").alias("name"))
    country = F.get("locations", F.lit(0))["geonames_details"]["country_code"]
    kinds = F.array(*map(F.lit, ("ror_display", "alias", "label")))
    known = ctx.registry.select(F.col("id").alias("record"), country.alias("country"), F.explode(F.filter("names", lambda n: F.arrays_overlap(n["types"], kinds))).alias("n")).select("record", "country", F.col("n.value").alias("name"))
    return duplicates.in_production(own, known, ctx.threshold)


@register("address-validation", "csv json", "record geonames_id city country place_city place_country issue", "places")
def address_validation(ctx: Context, fmt: str) -> DataFrame:
    if fmt == "json":
        own = ctx.json.select(F.col("id").alias("record"), F.explode("locations").alias("l")).select("record", F.col("l.geonames_id").cast("string").alias("geonames_id"), F.col("l.geonames_details.name").alias("city"), F.col("l.geonames_details.country_name").alias("country"))
    else:
        own = ctx.csv.select(F.col("id").alias("record"), text.strip(F.col("`locations.geonames_id`")).alias("geonames_id"), "city", "country").filter("geonames_id <> ''")
    return integrity.place_report(own, ctx.places.withColumn("geonames_id", F.col("geonames_id").cast("string")), "geonames_id")


def extracted_values(records: DataFrame) -> DataFrame:
    """record, field, value of the extracted fields of records."""
    e = reshape.extracted(records)
    pairs = F.array(*(F.struct(F.lit(c).alias("field"), F.col(f"`{c}`").alias("values")) for c in reshape.EXTRACTED if c != "id"))
    return e.select(F.get("id", F.lit(0)).alias("record"), F.explode(pairs).alias("p")).select("record", "p.field", F.explode("p.values").alias("value")).filter("value is not null")


def requested(ctx: Context) -> DataFrame:
    """record, field, op, value of the filled cells of rows with an id; the value is empty where
    a whole field is to go."""
    cells = [c for c in ctx.csv.columns if c in REQUIRED and c != "id" and c in reshape.EXTRACTED]
    pairs = F.array(*(F.struct(F.lit(c).alias("field"), F.col(f"`{c}`").alias("cell")) for c in cells))
    d = ctx.csv.filter("id <> ''").select(F.col("id").alias("record"), F.explode(pairs).alias("p")).select("record", "p.*").filter("cell <> ''")
    d = d.select("record", "field", F.explode(grammar.parse_sticky(F.col("cell"))).alias("u")).filter("u.value <> '' or u.op = 'delete'")
    value = F.when(F.col("field").startswith("names"), text.clean_name(F.col("u.value"))).otherwise(F.replace(F.col("u.value"), F.lit("*preferred"), F.lit("")))
    return d.select("record", "field", "u.op", value.alias("value"))


@register("new-record-integrity", "csv_json", "record field value type")
def new_record_integrity(ctx: Context, fmt: str) -> DataFrame:
    return integrity.new_record_gaps(requested(ctx).filter("op <> 'delete'").drop("op"), extracted_values(ctx.json))


@register("update-record-integrity", "csv_json", "record field op value status")
def update_record_integrity(ctx: Context, fmt: str) -> DataFrame:
    return integrity.update_gaps(requested(ctx), extracted_values(ctx.json))


def plan_all(ctx: Context, names: list[str] | None = None) -> dict[str, DataFrame]:
    """Reports by `{format}_{name}`; of validators for both inputs together by name.

    Unknown names are left out; a name asked for that cannot run raises, while with
    names None validators that cannot run are left out (§3.1)."""
    out: dict[str, DataFrame] = {}
    for name in names or list(REGISTRY):
        v = REGISTRY.get(name)
        if v is None:
            continue
        formats = [f for f in v.formats if v.runnable(ctx, f)]
        if names and not formats:
            raise ConfigurationError(f"{name} lacks its inputs")
        for f in formats:
            out[name if f == "csv_json" else f"{f}_{name}"] = v.plan(ctx, f).select(*v.columns)
    return out


def write_all(ctx: Context, folder: str, names: list[str] | None = None) -> list[str]:
    """Writes every report that has rows, and says which."""
    return [name for name, df in plan_all(ctx, names).items() if write_report(df, df.columns, f"{folder}/{name}")]
