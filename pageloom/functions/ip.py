"""IP address expressions for IPv4 and IPv6 text, as plain 64-bit arithmetic.

An address is the struct ``(family, hi, lo)``: for IPv4 ``hi`` is 0 and ``lo`` the
address; for IPv6 the two 64-bit halves (as signed longs). A network is
``(family, prefix_len, hi, lo)`` with the host bits cleared. Text that is not an
address gives NULL, never an error.
"""

from __future__ import annotations

import ipaddress
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from pageloom.functions.sql import bind, literal

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_DOTTED = rf"(?:{_OCTET}\.){{3}}{_OCTET}"
IPV4 = rf"\A{_DOTTED}\z"
_IPV6_SIDE = r"(?i)\A(?:[0-9a-f]{1,4}(?::[0-9a-f]{1,4}){0,7})?\z"


# Value of dotted text cut at its dots, ``x``.
_OCTET_SUM = "(" + " + ".join(f"CAST(x[{i}] AS bigint) * {256 ** (3 - i)}" for i in range(4)) + ")"


def ip_to_int(ip: Column) -> Column:
    """IPv4 text to its integer; NULL for '-', IPv6, out-of-range octets, leading zeros."""
    return F.when(ip.rlike(IPV4), bind(F.split(ip, r"\."), _OCTET_SUM))


def int_to_ip(value: Column) -> Column:
    """Integer to dotted IPv4 text."""
    octets = [F.shiftright(value, shift).bitwiseAND(F.lit(255)).cast("string") for shift in (24, 16, 8, 0)]
    dot = F.lit(".")
    return F.concat(octets[0], dot, octets[1], dot, octets[2], dot, octets[3])


def _expand_tail(ip: Column) -> Column:
    """IPv6 text whose dotted tail, if any, is written as two groups."""
    tail = F.regexp_extract(ip, rf":({_DOTTED})\z", 1)
    groups = "concat(hex(shiftright(x, 16)), ':', hex(x & 65535))"
    expanded = F.concat(F.regexp_replace(ip, rf"{_DOTTED}\z", ""), bind(ip_to_int(tail), groups))
    return F.when(tail == "", ip).otherwise(expanded)


# The eight groups of an IPv6 text ``x``, already cut at "::" into one or two sides.
_EIGHT_GROUPS = f"""
CASE
  WHEN size(x) > 2 OR NOT forall(x, s -> s RLIKE {literal(_IPV6_SIDE)}) THEN NULL
  WHEN size(x) = 1 THEN IF(size(split(x[0], ':')) = 8, split(x[0], ':'), NULL)
  ELSE get(transform(
    array(struct(filter(split(x[0], ':'), g -> g <> '') AS l, filter(split(x[1], ':'), g -> g <> '') AS r)),
    y -> IF(size(y.l) + size(y.r) < 8,
            concat(y.l, array_repeat('0', 8 - size(y.l) - size(y.r)), y.r), NULL)), 0)
END
"""


def _half(first: int) -> str:
    """SQL for 64 bits out of four groups of ``x``."""
    words = [f"shiftleft(CAST(conv(x[{first + i}], 16, 10) AS bigint), {48 - 16 * i})" for i in range(4)]
    return "(" + " | ".join(words) + ")"


_V6_KEY = f"IF(x IS NULL, NULL, named_struct('family', 6, 'hi', {_half(0)}, 'lo', {_half(4)}))"


def ip_key(ip: Column) -> Column:
    """Struct (family, hi, lo) of an IPv4 or IPv6 text; NULL if it is neither."""
    v4 = bind(ip_to_int(ip), "IF(x IS NULL, NULL, named_struct('family', 4, 'hi', 0L, 'lo', x))")
    v6 = bind(bind(F.split(_expand_tail(ip), "::", -1), _EIGHT_GROUPS), _V6_KEY)
    return F.when(F.contains(ip, F.lit(":")), v6).otherwise(v4)


def _half_mask(bits: str) -> str:
    """SQL for a mask of the top ``bits`` of 64; below 1 nothing, above 63 everything."""
    return f"CASE WHEN {bits} <= 0 THEN 0L WHEN {bits} >= 64 THEN -1L ELSE shiftleft(-1L, 64 - ({bits})) END"


def mask(family: str, prefix_len: str) -> str:
    """SQL for the struct (hi, lo) of the network mask of a family at one prefix length."""
    v4 = f"named_struct('hi', 0L, 'lo', shiftleft(-1L, 32 - {prefix_len}) & 4294967295L)"
    v6 = f"named_struct('hi', {_half_mask(prefix_len)}, 'lo', {_half_mask(f'{prefix_len} - 64')})"
    return f"IF({family} = 4, {v4}, {v6})"


# A network from ``x``: its address key ``k``, prefix length ``n`` and mask ``m``.
_MASKED = """
named_struct('family', x.k.family, 'prefix_len', x.n, 'hi', x.k.hi & x.m.hi, 'lo', x.k.lo & x.m.lo)
"""
_WITH_MASK = f"named_struct('k', x.k, 'n', x.n, 'm', {mask('x.k.family', 'x.n')})"
_LONGEST = "IF(x.k.family = 4, 32, 128)"
# NULL length: the text after the '/' is no number or too large for the family.
_WITH_LENGTH = f"""
named_struct('k', x.k, 'n', CASE
  WHEN x.t IS NULL THEN {_LONGEST}
  WHEN try_cast(x.t AS int) BETWEEN 0 AND {_LONGEST} THEN try_cast(x.t AS int) END)
"""


def _length_text(network: Column) -> Column:
    """Text after the '/'; NULL without a '/'."""
    return F.when(F.contains(network, F.lit("/")), F.regexp_extract(network, r"\A[^/]*/([0-9]{1,3})\z", 1))


def cidr_key(network: Column) -> Column:
    """Network struct of CIDR text, host bits cleared; a bare address is a full-length network."""
    address = ip_key(F.split_part(network, F.lit("/"), F.lit(1)))
    parsed = bind(F.struct(address.alias("k"), _length_text(network).alias("t")), _WITH_LENGTH)
    masked = bind(bind(parsed, _WITH_MASK), _MASKED)
    return bind(masked, "IF(x.family IS NULL OR x.prefix_len IS NULL, NULL, x)")


def cidr_to_range(network: Column) -> Column:
    """Struct (start_ip, end_ip) of an IPv4 CIDR block, as integers; NULL for anything else."""
    address = ip_to_int(F.split_part(network, F.lit("/"), F.lit(1)))
    length = F.coalesce(_length_text(network), F.lit("32")).try_cast("int")
    body = """
    IF(x.a IS NULL OR x.n IS NULL OR x.n > 32, NULL, named_struct(
      'start_ip', x.a & shiftleft(-1L, 32 - x.n),
      'end_ip', (x.a & shiftleft(-1L, 32 - x.n)) + shiftleft(1L, 32 - x.n) - 1))
    """
    return bind(F.struct(address.alias("a"), length.alias("n")), body)


def broadcast_address(network: Column) -> Column:
    """Last address of an IPv4 CIDR block as dotted text."""
    return int_to_ip(cidr_to_range(network)["end_ip"])


_DOTTED_TEXT = re.compile(_DOTTED)


def _number(text: str | None) -> tuple[int, int] | None:
    if isinstance(text, str) and _DOTTED_TEXT.fullmatch(text):  # several times as fast as ``ipaddress``, which reads the rest
        a, b, c, d = text.split(".")
        return (4, int(a) << 24 | int(b) << 16 | int(c) << 8 | int(d))
    try:
        address = ipaddress.ip_address(text) if text else None
    except ValueError:
        return None
    return (address.version, int(address)) if address else None


def _cover(low: tuple[int, int] | None, high: tuple[int, int] | None) -> list[str] | None:
    if low is None or high is None or low[0] != high[0] or low[1] > high[1]:
        return None
    bits = 32 if low[0] == 4 else 128
    out, at, end = [], low[1], high[1]
    while at <= end:
        # as large as its first address and what is left allow
        size = min((at & -at).bit_length() - 1 if at else bits, (end - at + 1).bit_length() - 1)
        first = f"{at >> 24}.{at >> 16 & 255}.{at >> 8 & 255}.{at & 255}" if bits == 32 else ipaddress.IPv6Address(at)
        out.append(f"{first}/{bits - size}")
        at += 1 << size
    return out


def cover(first: str | None, last: str | None) -> list[str] | None:
    """The fewest networks that hold the addresses from ``first`` to ``last`` and no other; None if that is no range."""
    return _cover(_number(first), _number(last))


_COVER = StructType([StructField("networks", ArrayType(StringType())), StructField("width", StringType())])


@F.pandas_udf(_COVER)
def range_cover(first: pd.Series, last: pd.Series) -> pd.DataFrame:
    """``cover`` of columns, and the number of addresses as text that sorts like the number."""
    ends = [(_number(a), _number(b)) for a, b in zip(first, last)]
    found = [_cover(low, high) for low, high in ends]
    width = [None if n is None else f"{high[1] - low[1]:032x}" for n, (low, high) in zip(found, ends)]
    return pd.DataFrame({"networks": pd.Series(found, dtype=object), "width": pd.Series(width, dtype=object)})
