"""Page expressions: title, meta tags, links and scripts, read by regular expressions.

One pattern cuts a page into comments, raw-text elements (script, style, ...) and
tags, from left to right, so that markup inside a comment, a script body or an
attribute value is never taken for a tag. Its loops are possessive: they run in
constant stack and never back up, whatever the page holds.
"""

from __future__ import annotations

from functools import cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from pageloom.functions.sql import bind, each, keep, literal

MISSING_TITLE = "\ufffd"

# What may stand between a tag name and its '>': blanks, and attributes with a
# quoted, unquoted or missing value.
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|(?!["'])[^\s>]*+)"""
_ATTRIBUTE = rf"[^\s/>][^\s/>=]*+(?:\s*+=\s*+{_VALUE})?+"
_ATTRIBUTES = rf"(?:[\s/]++|{_ATTRIBUTE})*+"


def _body(name: str) -> str:
    """Text up to the closing tag of a raw-text element, or to the end of the page."""
    return rf"(?:[^<]++|<(?!/{name}[\s/>]))*+"


_NAME_END = r"(?=[\s/>])"

# What is skipped: text, comments, raw-text elements, and every tag that is not wanted.
_SKIPPED = (
    r"(?:[^<]++|<(?:!--(?:-?>|(?:[^-]++|-(?!-!?>))*+(?:--!?>)?+)"
    rf"|(style|textarea|xmp|iframe|noembed|noframes){_NAME_END}{_ATTRIBUTES}>{_body(chr(92) + '1')}"
    rf"|(?!(?:a|meta|script|title){_NAME_END})(?:/?[a-z][^\s/>]*+{_ATTRIBUTES}>|[!?/][^>]*+>)?+))*+"
)

# One match per wanted tag, in group 2: title (with its text), script, a or meta. Groups
# 3 and 4 are empty marks telling which of title and script was met. A wanted name
# without its '>' is passed over like text; the last match is empty.
_TOKEN = (
    rf"(?is){_SKIPPED}(?:"
    rf"(<(?:title()|script()|a|meta){_NAME_END}{_ATTRIBUTES}>(?:\3{_body('title')})?+)(?:\4{_body('script')})?+"
    r"|<|\z)"
)


def normalize_html(text: Column, lowercase: bool = True, newline: str = "") -> Column:
    """Page text as the extraction expects it: trimmed, lower-cased, tabs to blanks.

    ``newline`` replaces line feeds: nothing for page features, a blank for the
    e-mail harvest.
    """
    text = F.trim(text)
    if lowercase:
        text = F.lower(text)
    return F.replace(F.replace(text, F.lit("\t"), F.lit(" ")), F.lit("\n"), F.lit(newline))


def payload_text(payload: Column) -> Column:
    """Bytes to text as UTF-8; bytes that are not become U+FFFD."""
    return F.call_function("make_valid_utf8", payload.cast("string"))


def page_tags(html: Column) -> Column:
    """The title, script, a and meta tags of a page, in document order."""
    return keep(F.regexp_extract_all(html, F.lit(_TOKEN), F.lit(2)), "x <> ''")


def _named(tags: Column, name: str) -> Column:
    # The four kept names differ in their first letter.
    return keep(tags, f"lower(substring(x, 2, 1)) = '{name[0]}'")


def _raw_attribute(tag: str, name: str) -> str:
    """SQL for the first attribute of that name with its quotes; '' when absent or without a value."""
    other = rf"(?!{name}[\s/>=]){_ATTRIBUTE}"
    pattern = rf"(?is)\A<[a-z][^\s/>]*+(?:[\s/]++|{other})*+{name}\s*+=\s*+({_VALUE})"
    return f"regexp_extract({tag}, {literal(pattern)}, 1)"


# An attribute value ``x`` without its quotes.
_UNQUOTED = """IF(startswith(x, '"') OR startswith(x, "'"), substring(x, 2, length(x) - 2), x)"""


def _values(tags: Column, name: str) -> Column:
    """The value of one attribute for every tag, as written; '' when absent."""
    return each(each(tags, _raw_attribute("x", name)), _UNQUOTED)


@cache
def _named_references() -> str:
    """SQL map from ``&name;`` to its characters."""
    pairs = [f"&{name}\x01{value}" for name, value in html5.items() if name.endswith(";")]
    return _text_map(pairs)


@cache
def _windows_1252() -> str:
    """SQL map for numeric references 128-159, which mean the Windows-1252 characters."""
    chars = [(code, bytes([code]).decode("cp1252", errors="ignore")) for code in range(0x80, 0xA0)]
    return _text_map([f"{code}\x01{char}" for code, char in chars if char])


def _text_map(pairs: list[str]) -> str:
    return f"str_to_map({literal(chr(2).join(pairs))}, {literal(chr(2))}, {literal(chr(1))})"


_PIECE = r"(?i)&(?:#[0-9]+;?|#x[0-9a-f]+;?|[a-z][a-z0-9]*;)|[^&]+|&"


@cache
def _decoded(text: str) -> str:
    """SQL for ``text`` with its character references replaced."""
    # Leading zeros mean nothing, and a number of more digits than these is beyond all characters.
    number = r"regexp_extract(p, '(?i)&#x?0*([0-9a-f]*)', 1)"
    code = f"""CASE WHEN length({number}) > 10 THEN 1114112L WHEN {number} = '' THEN 0L
        WHEN lower(substring(p, 3, 1)) = 'x' THEN try_cast(conv({number}, 16, 10) AS bigint) ELSE try_cast({number} AS bigint) END"""
    valid = "c BETWEEN 1 AND 1114111 AND NOT c BETWEEN 55296 AND 57343"
    char = f"decode(unhex(lpad(hex(IF({valid}, c, 65533L)), 8, '0')), 'UTF-32')"
    numeric = (
        f"get(transform(array({code}), c -> coalesce(try_element_at({_windows_1252()}, CAST(c AS string)), {char})), 0)"
    )
    piece = f"""
    CASE WHEN p = '&amp;' THEN '&'
         WHEN startswith(p, '&#') THEN coalesce({numeric}, p)
         WHEN startswith(p, '&') THEN coalesce(try_element_at({_named_references()}, p), p)
         ELSE p END
    """
    pieces = f"regexp_extract_all({text}, {literal(_PIECE)}, 0)"
    return f"IF(contains({text}, '&'), array_join(transform({pieces}, p -> {piece}), ''), {text})"


def decode_entities(text: Column) -> Column:
    """Character references to characters; names need their semicolon, numbers do not."""
    return bind(text, _decoded("x"))


def _decoded_values(tags: Column, name: str) -> Column:
    return each(keep(_values(tags, name), "x <> ''"), _decoded("x"))


def attributes(tags: Column, tag_name: str, name: str) -> Column:
    """Non-empty values of one attribute over all tags of one name, in order."""
    return _decoded_values(_named(tags, tag_name), name)


def title_of(tags: Column) -> Column:
    """Text of the first title, trimmed; U+FFFD when the page has none."""
    first = F.get(_named(tags, "title"), F.lit(0))
    text = decode_entities(F.regexp_replace(first, rf"(?is)\A<title{_ATTRIBUTES}>", ""))
    return F.coalesce(F.regexp_replace(text, r"(?U)\A\s+|\s+\z", ""), F.lit(MISSING_TITLE))


def meta_of(tags: Column, meta_name: str) -> Column:
    """``content`` of the last meta tag of that name; NULL without one."""
    name = f"regexp_replace({_raw_attribute('x', 'name')}, {literal(_AROUND)}, '')"
    matching = keep(_named(tags, "meta"), f"{name} = {literal(meta_name)}")
    content = bind(F.try_element_at(matching, F.lit(-1)), _raw_attribute("x", "content"))
    return decode_entities(bind(content, f"IF(x = '', NULL, {_UNQUOTED})"))


_AROUND = r"""\A["']|["']\z"""


# Fixed value: an e-mail address, optionally as a mailto link; the anchors say that it is the whole value.
EMAIL = r"(?i)\A(mailto:)?([a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+)\z"


def emails_of(tags: Column) -> Column:
    """Link targets that are an e-mail address; a mailto with a query is not one."""
    # Only a tag with an at sign, plain or as a character reference, can hold one.
    links = keep(_named(tags, "a"), "contains(x, '@') OR contains(x, '&')")
    return keep(_decoded_values(links, "href"), f"x RLIKE {literal(EMAIL)}")


def script_srcs_of(tags: Column, keep_data_uris: bool = True) -> Column:
    """Script sources in document order, optionally without inline ``data:`` ones."""
    srcs = attributes(tags, "script", "src")
    return srcs if keep_data_uris else keep(srcs, "NOT startswith(x, 'data:')")


def script_types_of(tags: Column) -> Column:
    """Script ``type`` values in document order."""
    return attributes(tags, "script", "type")


_ESCAPES = r"\\x[0-9a-fA-F]{2}|\\[nrt\\'\"]|[^\\]+|\\"
# The characters that a printed byte string escapes by a letter or sign of their own.
_ESCAPED = {"n": "0A", "r": "0D", "t": "09", "\\": "5C", "'": "27", '"': "22"}


def unescape_bytes(text: Column) -> Column:
    r"""Undo the escapes of printed byte strings (``\xNN``, ``\n``, ``\'`` …) and read the bytes as UTF-8.

    Each piece of the text becomes the hexadecimal form of its bytes; these are joined, and
    what is no UTF-8 becomes U+FFFD. Text with an ``\x`` that lacks its digits, or that ends
    inside an escape, cannot be repaired and stays as it is.
    """
    signs = " ".join(f"WHEN p = {literal(chr(92) + sign)} THEN '{code}'" for sign, code in _ESCAPED.items())
    piece = f"CASE WHEN p RLIKE {literal(r'\A\\x[0-9a-fA-F]{2}\z')} THEN substring(p, 3) {signs} ELSE hex(p) END"
    pieces = f"regexp_extract_all(x, {literal(_ESCAPES)}, 0)"
    repaired = f"make_valid_utf8(CAST(unhex(array_join(transform({pieces}, p -> {piece}), '')) AS string))"
    broken = literal(r"(?s)\A(?:[^\\]|\\[^x]|\\x[0-9a-fA-F]{2})*+\\(?:\z|x)")
    return bind(text, f"IF(contains(x, {literal(chr(92))}) AND NOT x RLIKE {broken}, {repaired}, x)")
