"""HTML and URL helpers as Column expressions (regex, JVM-side).

Text extraction follows an HTML parser's ``get_text(" ", strip=True)`` after
removing script, style and noscript elements: every text node is decoded,
stripped, dropped when empty, and the rest joined by one space.  Comments and
the doctype are not text.  Attribute values are assumed to hold no ``>``.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

SEP = "\u0001"  # node boundary marker; never part of page text

# The named entities of HTML 4, and &apos;, from the standard library's table.
ENTITY_CHARS: dict[str, str] = {name: chr(code) for name, code in sorted(name2codepoint.items())} | {"apos": "'"}
_ENTITY = "&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"

_INVISIBLE = ("script", "style", "noscript")
# What ``str.strip()`` takes for a blank.
_WS_CLASS = "[ \\t\\n\\r\\f\\x0B\\x1C-\\x1F\\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000]"
SCHEME = r"[a-zA-Z][a-zA-Z0-9+.-]*"


def _entity(e: Column) -> Column:
    """The character of one entity, the entity itself if it stands for none."""
    name = F.substring(e, 2, 64).substr(F.lit(1), F.length(e) - 2)
    hexa = F.conv(F.regexp_extract(name, "^#[xX](.*)$", 1), 16, 10).cast("int")
    code = F.when(name.rlike("^#[xX]"), hexa).when(name.startswith("#"), F.substring(name, 2, 7).cast("int"))
    valid = code.between(2, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    named = F.create_map(*[F.lit(x) for kv in ENTITY_CHARS.items() for x in kv])
    return F.when(code.isNotNull(), F.when(valid, char).otherwise(e)).otherwise(
        F.coalesce(F.try_element_at(named, name), e))


def decode_entities(c: Column) -> Column:
    """Numeric and named entities replaced in one pass, so "&amp;lt;" gives "&lt;"."""
    found = F.transform(F.regexp_extract_all(c, F.lit(_ENTITY), F.lit(0)), _entity)
    pieces = F.zip_with(F.split(c, _ENTITY, -1), found, lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    return F.when(c.rlike(_ENTITY), F.array_join(pieces, "")).otherwise(c)


def strip_ws(c: Column) -> Column:
    return F.regexp_replace(c, f"^{_WS_CLASS}+|{_WS_CLASS}+$", "")


def without_invisible(html: Column) -> Column:
    """Markup with script/style/noscript elements and comments replaced by a
    node boundary (scripts first: they may contain markup-like strings)."""
    h = F.coalesce(html, F.lit(""))
    for tag in _INVISIBLE:
        h = F.regexp_replace(h, rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>", SEP)
    return F.regexp_replace(h, r"(?s)<!--.*?-->", SEP)


def visible_text(html: Column) -> Column:
    # Few nodes hold an entity; only these are decoded.  No entity stands for SEP.
    nodes = F.split(F.regexp_replace(without_invisible(html), r"<[^>]*>", SEP), SEP)
    cleaned = F.transform(nodes, lambda n: strip_ws(F.when(n.contains("&"), decode_entities(n)).otherwise(n)))
    return F.array_join(F.filter(cleaned, lambda n: n != F.lit("")), " ")


def title_text(html: Column) -> Column:
    raw = F.regexp_extract(without_invisible(html), r"(?is)<title\b[^>]*>(.*?)</title\s*>", 1)
    return strip_ws(decode_entities(raw))


def hrefs(html: Column) -> Column:
    """Distinct href values of <a> elements (outside scripts and comments), quoted
    either way or not at all."""
    value = "\"[^\">]*\"|'[^'>]*'|[^\\s\"'>]+"
    found = F.regexp_extract_all(without_invisible(html), F.lit(rf"(?is)<a\s(?:[^>]*?\s)??href\s*=\s*({value})"), 1)
    bare = F.transform(found, lambda v: F.when(v.rlike("^[\"']"), v.substr(F.lit(2), F.length(v) - 2)).otherwise(v))
    return F.array_distinct(F.transform(bare, decode_entities))


def url_host(url: Column) -> Column:
    """Third '/'-separated piece (the reference's host rule); null if absent."""
    return F.get(F.split(url, "/"), 2)


def has_host(url: Column) -> Column:
    return F.size(F.split(url, "/")) >= 3


def resolve(link: Column, base: Column) -> Column:
    """Absolute URL of ``link`` found on page ``base``; null for fragments and
    non-hierarchical schemes (mailto:, javascript:)."""
    origin = F.regexp_extract(base, rf"^({SCHEME}://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, rf"^({SCHEME}):", 1)
    basedir = F.regexp_extract(base, rf"^({SCHEME}://[^?#]*/)", 1)
    basedir = F.when(basedir == "", F.concat(origin, F.lit("/"))).otherwise(basedir)
    return (F.when(link.startswith("http"), link)
            .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
            .when(link.startswith("/"), F.concat(origin, link))
            .when(link.startswith("?"), F.concat(F.regexp_extract(base, "^([^?#]*)", 1), link))
            .when(link.startswith("#") | link.rlike(rf"^{SCHEME}:") | (link == ""), F.lit(None))
            .otherwise(F.concat(basedir, link)))


def first_words(text: Column, chars: int = 1000, words: int = 20) -> Column:
    """``" ".join(text[:chars].split()[:words])``."""
    parts = F.filter(F.split(F.substring(text, 1, chars), rf"{_WS_CLASS}+"), lambda w: w != F.lit(""))
    return F.array_join(F.slice(parts, 1, words), " ")
