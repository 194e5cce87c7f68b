"""Text functions as column expressions.

All stay inside the JVM. Unicode classes are spelled out, since Java's \\w and \\s are
ASCII only; letters newer than the JVM's tables are the one known difference.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\s\x1c-\x1f\x85   -     　]"
UNPRINTABLE = r"[\p{C}\p{Zl}\p{Zp}\p{Zs}&&[^ ]]"
EDGE = r"[\s!\"#$%&'()*+,\-./:;<=>?@\[\\\]^_`{|}~]"


def strip(x: Column) -> Column:
    """All Unicode white space at both ends, where trim() takes only the space."""
    return F.regexp_replace(x, rf"^{SPACE}+|{SPACE}+$", "")


def normalize_whitespace(x: Column) -> Column:
    return F.regexp_replace(strip(x), rf"{SPACE}+", " ")


def normalize_text(x: Column) -> Column:
    """Lower case without punctuation; letters, numbers, the underscore and white space stay."""
    return F.regexp_replace(F.lower(x), rf"(?:(?!{SPACE})[^\p{{L}}\p{{N}}_])+", "")


def normalize_url(x: Column) -> Column:
    """`//host[:port]` without www., path and scheme; null for text without a scheme."""
    return F.concat(F.lit("//"), host_of(x))


def host_of(x: Column) -> Column:
    """Lower-case authority without a leading www.; null where the text is no URL."""
    raw = F.lower(F.regexp_extract(F.trim(x), r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#\s]+)", 1))
    return F.nullif(F.regexp_replace(F.regexp_replace(raw, "^[^@]*@", ""), r"^www\.", ""), F.lit(""))


def normalize_host(x: Column) -> Column:
    """Host without port and www.; a missing scheme counts as https."""
    full = F.when(x.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), x).otherwise(F.concat(F.lit("https://"), x))
    return F.nullif(F.regexp_replace(host_of(full), r":\d+$", ""), F.lit(""))


def normalize_domain(x: Column) -> Column:
    """Trimmed, lower case, without one closing dot and a leading www.; null if nothing is left."""
    return F.nullif(F.regexp_replace(F.regexp_replace(F.lower(strip(x)), r"\.$", ""), r"^www\.", ""), F.lit(""))


def quote(x: Column) -> Column:
    """Percent encoding that leaves /, ~, and letters, digits and _.- as they are."""
    out = F.url_encode(x)
    for a, b in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def unquote(x: Column) -> Column:
    """Percent decoding that leaves stray percent signs and plus signs alone."""
    safe = F.replace(F.regexp_replace(x, r"%(?![0-9A-Fa-f]{2})", "%25"), F.lit("+"), F.lit("%2B"))
    return F.coalesce(F.try_url_decode(safe), x)


def normalize_wikipedia(x: Column) -> Column:
    """https, and the last path segment decoded and encoded anew."""
    secure = F.regexp_replace(x, "^http://", "https://")
    head, tail = F.regexp_extract(secure, r"^(.*/)[^/]*$", 1), F.regexp_extract(secure, r"([^/]*)$", 1)
    return F.concat(head, quote(unquote(tail)))


def clean_name(x: Column) -> Column:
    """What stands before the language tag."""
    return strip(F.split(x, r"\*").getItem(0))


def tagged(x: Column) -> Column:
    """`value*lang` as struct(value, lang)."""
    parts = F.split(x, r"\*")
    return F.struct(strip(parts.getItem(0)).alias("value"), F.when(F.size(parts) > 1, strip(F.get(parts, F.lit(1)))).alias("lang"))


def hyphens_to_spaces(x: Column) -> Column:
    return normalize_text(F.regexp_replace(x, "-", " "))


def make_printable(x: Column) -> Column:
    return F.regexp_replace(x, r"[\p{C}\p{Zl}\p{Zp}\p{Zs}&&[^ \n\r]]", "")


def find_between(x: Column, a: str, b: str) -> Column:
    """The text between the first a and the next b, stripped; empty if there is none."""
    return strip(F.regexp_extract(x, rf"(?s)\Q{a}\E(.*?)\Q{b}\E", 1))


def unprintable(x: Column) -> Column:
    return F.array_sort(F.array_distinct(F.regexp_extract_all(x, F.lit(f"({UNPRINTABLE})"), F.lit(1))))


def truncated(x: Column, most: int = 100) -> Column:
    return F.when(F.length(x) > most, F.concat(F.left(x, F.lit(most - 3)), F.lit("..."))).otherwise(x)


def escape_query(x: Column) -> Column:
    return F.regexp_replace(x, r"([+\-=!(){}\[\]^\"~*?:\\/&|])", r"\\$1")


#: Characters that a search takes as its own signs.
SEARCH_SIGNS = r"[*|\"',:;/\\&!?#@\[\]{}()<>]"


def search_name(x: Column) -> Column:
    """A name fit for a search: nothing in brackets, no signs of the search, single spaces."""
    return normalize_whitespace(F.regexp_replace(F.regexp_replace(x, rf"{SPACE}*\([^)]*\)", ""), SEARCH_SIGNS, " "))


def quote_tail(x: Column, start: int = 30) -> Column:
    """An address that is not encoded yet, encoded from its `start`th character on."""
    return F.when(unquote(x).eqNullSafe(x), F.concat(F.left(x, F.lit(start)), quote(F.substring(x, F.lit(start + 1), F.greatest(F.length(x), F.lit(1)))))).otherwise(x)


def funder_link(x: Column, base: str = "https://doi.org/10.13039/") -> Column:
    """The address of a funder id, which may be given as such an address or with its prefix."""
    return F.concat(F.lit(base), F.regexp_extract(strip(x), r"([0-9]+)$", 1))


#: Shapes of external identifiers in free text.
IDENTIFIERS = {"grid": r"((?i:grid)\.[0-9]{4,8}\.(?i:[0-9a-z]{1,2}))", "wikidata": r"\b(Q\d+)\b", "isni": r"\b(\d{4}\s\d{4}\s\d{4}\s\d{4}|\d{16})\b", "fundref": r"\b(50\d{8})\b"}


def mined_identifiers(x: Column) -> Column:
    """kind:value of every external identifier in the text, in order of kinds."""

    def of(kind: str, pattern: str) -> Column:
        return F.transform(F.array_distinct(F.regexp_extract_all(x, F.lit(pattern), F.lit(1))), lambda v: F.concat(F.lit(kind + ":"), F.regexp_replace(F.lower(v) if kind == "grid" else v, r"\s", "")))

    return F.array_distinct(F.flatten(F.array(*(of(k, p) for k, p in IDENTIFIERS.items()))))


def compare_key(x: Column) -> Column:
    return F.lower(F.regexp_replace(x, rf"{SPACE}+", ""))


def isni_link(x: Column) -> Column:
    return F.concat(F.lit("https://isni.org/isni/"), F.regexp_replace(x, r"\s+", ""))


def version(x: Column) -> Column:
    """struct(major, minor) of the first `vX.Y`, which compares as versions do."""
    part = lambda i: F.regexp_extract(x, r"v(\d+)\.(\d+)", i).try_cast("int")
    return F.struct(part(1).alias("major"), part(2).alias("minor"))


def release_date(x: Column) -> Column:
    return F.try_to_date(F.regexp_extract(x, r"(\d{4}-\d{2}-\d{2})", 1))


def _folding() -> tuple[str, str]:
    """Latin letters with marks, and the letters without, as far as Unicode takes them apart into one letter."""
    import unicodedata

    pairs = [(chr(c), unicodedata.normalize("NFKD", chr(c)).encode("ascii", "ignore").decode()) for a, b in ((0xC0, 0x250), (0x1E00, 0x1F00)) for c in range(a, b)]
    pairs = [(x, y) for x, y in pairs if len(y) == 1 and y.isalpha()]
    return "".join(x for x, _ in pairs), "".join(y for _, y in pairs)


# Letters that do not come apart, as they are spelt in ASCII.
SPELT = {"ß": "ss", "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "Ø": "O", "ø": "o", "Ł": "L", "ł": "l", "Đ": "D", "đ": "d", "Þ": "Th", "þ": "th", "ı": "i"}


def folded(x: Column) -> Column:
    """Latin letters without their marks, in the JVM; other letters stay."""
    for a, b in SPELT.items():
        x = F.replace(x, F.lit(a), F.lit(b))
    return F.translate(x, *_folding())
