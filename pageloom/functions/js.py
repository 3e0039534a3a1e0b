"""Expressions on script ``src`` values and JavaScript library names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pageloom.functions.url import url_path

# The first ".js" name in a source. It also takes names such as
# "cdn.js" from "cdn.jsdelivr.net" and "data.js" from "data.json"; the counts
# this library has to match include those.
LIBRARY = r"/?(?:js\.)?([^/?]+\.js)"
MINIFIED = r"\.min\."


def split_piped(piped: Column) -> Column:
    """'|'-joined text to an array; '' gives one empty element."""
    return F.split(piped, r"\|", -1)


def join_piped(items: Column) -> Column:
    """Array to '|'-joined text for flat files; empty and NULL arrays give ''."""
    return F.concat_ws("|", items)


def js_lib_name(src: Column) -> Column:
    """Library name of one source, ``.min.`` removed; NULL if there is none."""
    name = F.nullif(F.regexp_extract(src, LIBRARY, 1), F.lit(""))
    return F.regexp_replace(name, MINIFIED, ".")


def js_lib_names(srcs: Column) -> Column:
    """Library names of an array of sources, NULL where a source has none."""
    return F.transform(srcs, js_lib_name)


def clean_src(src: Column) -> Column:
    """Source without the quote and backslash wrappers of older extractions."""
    return F.regexp_replace(src, r"^[\\']+|[\\']+\z", "")


def js_lib_basename(src: Column, cut_at_comma: bool = False) -> Column:
    """Library name by the older rule: last path segment that mentions "js".

    ``.min.`` becomes ``.`` and a leading ``js.`` goes; a segment that is just
    "js" is no name. ``cut_at_comma`` keeps only what precedes the first comma.
    """
    name = F.element_at(F.split(url_path(clean_src(src)), "/", -1), -1)
    name = F.regexp_replace(name, r";.*", "")
    if cut_at_comma:
        name = F.split_part(name, F.lit(","), F.lit(1))
    short = F.regexp_replace(F.regexp_replace(name, MINIFIED, "."), r"^js\.", "")
    return F.when(F.contains(name, F.lit("js")) & (short != "js"), short)


def is_data_uri(src: Column) -> Column:
    return F.startswith(src, F.lit("data:"))


def drop_data_uris(piped: Column) -> Column:
    """'|'-joined sources without the inline ``data:`` ones."""
    return F.array_join(F.filter(split_piped(piped), lambda s: ~is_data_uri(s)), "|")


def uses_vendor(srcs: Column, needle: str) -> Column:
    """Whether any source of the array mentions ``needle``."""
    return F.exists(srcs, lambda s: F.contains(s, F.lit(needle)))
