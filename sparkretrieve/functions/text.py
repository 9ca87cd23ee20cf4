"""Column expressions on text. All native (JVM, codegen); no Python per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the studied library's for equal results:
# the token pattern (ASCII letters, digits and the characters _ . $ : / -),
# and the preview length of search results.
TOKEN_PATTERN = r"[A-Za-z0-9_.$:/-]+"
PREVIEW_CHARS = 700

# Every character Python's str.strip() treats as white space.
WHITESPACE_RE = (r"[\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
                 r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokenize(text: Column | str) -> Column:
    """every match of the token pattern, lower-cased *after* extraction."""
    matches = F.regexp_extract_all(F.coalesce(_col(text), F.lit("")), F.lit(TOKEN_PATTERN), 0)
    return F.transform(matches, lambda t: F.lower(t))


def safe_record_id(record_id: Column | str) -> Column:
    """``:`` ``/`` ``\\`` become ``_`` (file-name-safe id)."""
    return F.translate(_col(record_id), ":/\\", "___")


def preview(text: Column | str, n: int = PREVIEW_CHARS) -> Column:
    """First ``n`` characters (code points)."""
    return F.substring(_col(text), 1, n)


def py_strip(text: Column | str) -> Column:
    """Without the white space at both ends that Python's ``str.strip`` removes."""
    return F.regexp_replace(_col(text), rf"\A{WHITESPACE_RE}+|{WHITESPACE_RE}+\z", "")


def is_blank(text: Column | str) -> Column:
    """True for null, empty and all-white-space strings."""
    return _col(text).isNull() | (py_strip(text) == "")


def first_line_title(text: Column | str) -> Column:
    """Title rule of the corpus adapter: the whole first line."""
    return F.substring_index(_col(text), "\n", 1)


def render_map(m: Column | str) -> Column:
    """Map -> ``k=v;k=v`` sorted by key, for stable comparison output."""
    entries = F.transform(F.map_entries(_col(m)), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.array_join(F.array_sort(entries), ";")
