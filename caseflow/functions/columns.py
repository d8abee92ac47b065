"""Scalar column functions (I8-I21, B9/B17 helpers): all native Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Asset extension -> asset type.
ASSET_TYPE_BY_EXTENSION = {
    "png": "screenshot", "jpg": "screenshot", "jpeg": "screenshot", "gif": "screenshot",
    "log": "log", "txt": "log",
    "sql": "script", "ps1": "script", "sh": "script", "py": "script",
    "pdf": "document", "docx": "document", "xlsx": "document",
}
ASSET_TYPE_OTHER = "other"
# Number of leading tokens kept by the resolution-pattern label (I16) and its minimum length.
PATTERN_TOKENS = 12
PATTERN_MIN_LENGTH = 20


def hash_key(*parts: Column, sep: str = "|") -> Column:
    """SHA-256 hex of the parts joined by ``sep``; null parts are skipped."""
    return F.sha2(F.concat_ws(sep, *parts), 256)


def label(name: Column, *fallbacks: Column) -> Column:
    """First non-null of name and fallbacks."""
    return F.coalesce(name, *fallbacks)


def normalize_pattern(text: Column, strip_prefix: str | None = None) -> Column:
    """I16: resolution-pattern label.

    Non-alphanumerics -> space, trim, lower; kept only if longer than 20
    characters; then the first 12 space-separated tokens (repeated spaces give
    empty tokens, which count).  ``strip_prefix`` (ours) is a regular
    expression for a leading phrase (e.g. ``resolution for \\w+``) removed
    from the normalised text first, so that tickets can share a pattern.
    """
    t = F.lower(F.trim(F.regexp_replace(text, r"[^A-Za-z0-9]", " ")))
    if strip_prefix:
        t = F.trim(F.regexp_replace(t, "^(?:" + strip_prefix + ")", ""))
    return F.when(F.length(t) > PATTERN_MIN_LENGTH,
                  F.array_join(F.slice(F.split(t, " "), 1, PATTERN_TOKENS), " "))


def file_extension(name: Column) -> Column:
    """Lower-cased text after the last dot ('' when there is no dot)."""
    return F.lower(F.regexp_extract(name, r"\.([^.]*)$", 1))


def asset_type_from_name(name: Column) -> Column:
    """Asset type from the file extension."""
    m = F.create_map(*[x for kv in ASSET_TYPE_BY_EXTENSION.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return F.coalesce(F.element_at(m, file_extension(name)), F.lit(ASSET_TYPE_OTHER))


def iso_z(ts: Column) -> Column:
    """Timestamp -> ISO-8601 text with a trailing Z (UTC)."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def truncate(text: Column, n: int) -> Column:
    """First n characters."""
    return F.substring(text, 1, n)


def confidence(score: Column, scale: float = 4.0) -> Column:
    """min(1, score / 4)."""
    return F.least(F.lit(1.0), score / F.lit(scale))


def to_ts(text: Column) -> Column:
    """I8: ISO text -> timestamp; bad text gives null instead of an ANSI error."""
    return F.try_to_timestamp(text)


def try_cast(c: Column, dtype: str) -> Column:
    """Lenient cast (null on failure)."""
    return c.try_cast(dtype)


def split_keywords(text: Column) -> Column:
    """Split on comma, trim, drop empty."""
    return F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != "")


def json_struct(*cols: Column) -> Column:
    """Struct -> JSON text, null fields dropped (Spark's to_json rule)."""
    return F.to_json(F.struct(*cols))


def extract_links(html: Column) -> Column:
    """All href targets of an HTML field, in order."""
    return F.regexp_extract_all(html, F.lit(r'href="([^"]*)"'), 1)
