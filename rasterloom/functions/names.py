"""Native column expressions for keys, file names and paths (no UDFs)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Suffixes accepted by the audit and by ingest.
AUDIT_SUFFIXES = (".jpg", ".jpeg", ".png")
INGEST_SUFFIXES = (".jpg", ".jpeg", ".png", ".webp", ".bmp")

# Fixed value: the white space characters of Unicode, with the four separator controls.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(col: Column) -> Column:
    """Remove white space of any kind at both ends (plain ``trim`` only removes U+0020)."""
    return F.btrim(col.cast("string"), F.lit(WHITE_SPACE))


def normalize_key(col: Column, null_key: str = "drop") -> Column:
    """Key as stripped text. ``null_key='literal'`` turns nulls into the text ``nan``."""
    key = strip(col)
    if null_key == "literal":
        return F.coalesce(key, F.lit("nan"))
    if null_key != "drop":
        raise ValueError(f"null_key must be 'drop' or 'literal', not {null_key!r}")
    return key


def basename(path: Column) -> Column:
    """Last path component; trailing slashes and ``/.`` parts do not count."""
    inner = F.substring_index(F.regexp_replace(path, r"(/\.?)+$", ""), "/", -1)
    return F.when(path.contains("/"), inner).otherwise(path)


def suffix(path: Column) -> Column:
    """Suffix of the last component with its dot, or ``''``; leading and trailing dots make none."""
    name = basename(path)
    ending = F.substring_index(name, ".", -1)
    has_stem = F.length(name) > F.length(ending) + 1
    return F.when(has_stem & (ending != ""), F.concat(F.lit("."), ending)).otherwise("")


def has_suffix(path: Column, allowed: Sequence[str]) -> Column:
    return F.lower(suffix(path)).isin(*allowed)


def default_ext_any(name: Column) -> Column:
    """Append ``.jpg`` unless the name has any suffix at all."""
    return F.when(suffix(name) != "", name).otherwise(F.concat(name, F.lit(".jpg")))


def default_ext_image(name: Column) -> Column:
    """Null becomes ``''``; otherwise strip and append ``.jpg`` unless an audit suffix ends the name."""
    text = strip(name)
    lowered = F.lower(text)
    known = F.lit(False)
    for ext in AUDIT_SUFFIXES:
        known = known | lowered.endswith(ext)
    return F.when(name.isNull(), "").when(known, text).otherwise(F.concat(text, F.lit(".jpg")))


def is_junk(name: Column) -> Column:
    """Blank names and the literal text ``nan`` in any case."""
    return F.lower(strip(name)).isin("", "nan")


def raw_unsafe(member: Column) -> Column:
    """True for a member path that would resolve outside its target folder."""
    return member.rlike(r"(^/|(^|/)\.\.(/|$))")


def target_path(name: Column, folder: str = "images_standardized") -> Column:
    return F.concat_ws("/", F.lit(folder), name)
