"""Texts of curation issues to columns and back, and their selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import find_between, normalize_whitespace, quote_tail, strip

ID = r"https://[a-z]+\.org/0[a-z0-9]{6}[0-9]{2}"


def field(body: Column, label: str) -> Column:
    """The rest of the first line `label: value`; empty if there is none."""
    return strip(F.regexp_extract(body, rf"(?im)^\s*\Q{label}\E:[ \t]*([^\r\n]*)", 1))


def section(body: Column, header: str) -> Column:
    """The text under a Markdown header, up to the next one or the end."""
    return strip(F.regexp_extract(body, rf"(?is)(?:^|\n)#+\s*\Q{header}\E\s*\n(.*?)(?=\n#+\s|\z)", 1))


def record_ids(body: Column) -> Column:
    """Distinct record ids in the order in which they come."""
    return F.array_distinct(F.regexp_extract_all(body, F.lit(f"({ID})"), F.lit(1)))


# The lines of the request form, {} being the registry's name, and the headers of its sections.
LABELS = [
    "Name of organization:", "{} ID:", "Which part of the record needs to be changed?", "Description of change:", "Organizations affected by this change:",
    "{} ID(s) of organization(s) affected by this change:", "How should the record(s) be changed?", "Website:", "Domains:", "Link to publications:", "Organization type:",
    "Wikipedia page:", "Wikidata ID:", "ISNI ID:", "GRID ID:", "Crossref Funder ID:", "Aliases:", "Labels:", "Acronym/abbreviation:", "Related organizations:", "City:", "Country:",
    "Geonames ID:", "Year established:", "How will a {} ID for this organization be used?", "Other information about this request:",
]
UPDATE = "Update record:"
OTHER_SECTIONS = ["New record request:", "Merge/split/deprecate records:", "Add record:"]


def cleaned(body: Column, registry: str = "Registry") -> Column:
    """Without form lines that were left empty, without sections other than the update's,
    without an update section that has no content, and without runs of blank lines."""
    lines = F.filter(F.split(body, "\n"), lambda x: ~strip(x).isin([label.format(registry) for label in LABELS]))
    out = F.array_join(lines, "\n")
    ends = lambda own: "|".join(rf"\Q{h}\E" for h in [*OTHER_SECTIONS, UPDATE] if h != own)
    for header in OTHER_SECTIONS:
        out = F.regexp_replace(out, rf"(?s)\A(.*?)\n\Q{header}\E\n.*?(?=\n(?:{ends(header)})\n|\z)", "$1")
    content = F.regexp_extract(out, rf"(?s)\n\Q{UPDATE}\E\n\n(.*?)(?=\n(?:{ends(UPDATE)})\n|\z)", 1)
    out = F.when(F.contains(out, F.lit(f"\n{UPDATE}\n\n")) & (strip(content) == ""), F.replace(out, F.lit(f"\n{UPDATE}\n\n"), F.lit("\n"))).otherwise(out)
    return strip(F.regexp_replace(out, r"\n{3,}", "\n\n"))


def new_record(body: Column, labels: dict[str, str]) -> list[Column]:
    """One column for each (column name, label of its line)."""
    return [normalize_whitespace(field(body, label)).alias(name) for name, label in labels.items()]


def record_rows(issues: DataFrame, body: str, labels: dict[str, list[str]], display: str) -> DataFrame:
    """Issues with one column for each of labels, what follows the first of its labels that has
    anything after it on its line, and with what such a row is supplemented by.

    `types` loses what stands in brackets and gains `funder` where there is a funder id; the name in
    column `display` comes first among the labels; the Wikipedia address is encoded; a status that
    is empty is active. Nothing found, or a null body, is an empty text."""
    text = F.coalesce(body, F.lit(""))
    found = {c: F.coalesce(*(F.nullif(find_between(text, label, "\n"), F.lit("")) for label in of), F.lit("")) for c, of in labels.items()}
    out = issues.withColumns(found)
    col = lambda c: F.col(f"`{c}`")
    types = strip(F.substring_index(F.lower("types"), "(", 1))
    funder = (col("external_ids.type.fundref.all") != "") & ~F.contains(types, F.lit("funder"))
    return out.withColumns({
        "types": F.when(funder, F.concat_ws("; ", F.nullif(types, F.lit("")), F.lit("funder"))).otherwise(types),
        "links.type.wikipedia": quote_tail(col("links.type.wikipedia")),
        "names.types.label": F.concat_ws("; ", col(display), F.nullif(col("names.types.label"), F.lit(""))),
        "status": F.coalesce(F.nullif(F.col("status"), F.lit("")), F.lit("active")),
    })


def without_invented(original: Column, rewritten: Column) -> Column:
    """The rewritten text without record ids that the original does not have."""
    extra = F.array_except(record_ids(rewritten), record_ids(original))
    return strip(F.aggregate(extra, rewritten, lambda text, i: F.replace(text, i, F.lit(""))))


def related(body: Column) -> Column:
    """Array of (related id, type) from `<id> (type)` after `Related organizations:`."""
    line = field(body, "Related organizations")
    parts = F.regexp_extract_all(line, F.lit(rf"({ID}\s*\([A-Za-z]+\))"), F.lit(1))
    return F.transform(parts, lambda p: F.struct(F.regexp_extract(p, f"({ID})", 1).alias("related"), F.initcap(F.regexp_extract(p, r"\(([A-Za-z]+)\)", 1)).alias("type")))


def organization_type(body: Column) -> Column:
    """What the line `Organization type:` says; empty if there is none."""
    return strip(F.regexp_extract(body, r"Organization type:\s*(.+?)(?:\n|$)", 1))


def wanted(issues: DataFrame, required: str, excluded: str, least: int = 0) -> DataFrame:
    """Numbers of open issues that have one label and lack another, from `least` on, in
    order. issues: number, state, labels (array)."""
    has = lambda label: F.array_contains(F.coalesce("labels", F.array().cast("array<string>")), label)
    return issues.filter((F.col("state") == "open") & has(required) & ~has(excluded) & (F.col("number") >= least)).select("number").orderBy("number")


def selected(issues: DataFrame, phrase: str | None = None, low: int | None = None, high: int | None = None) -> DataFrame:
    """Issues whose title has the phrase, in any case, and whose number lies in the range."""
    out = issues if phrase is None else issues.filter(F.contains(F.lower("title"), F.lit(phrase.lower())))
    out = out if low is None else out.filter(F.col("number") >= low)
    return out if high is None else out.filter(F.col("number") <= high)
