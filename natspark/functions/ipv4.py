"""Dotted addresses and their 32-bit numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_DOTTED = rf"\A{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}\z"


def ip_to_long(text: Column, strict: bool = False) -> Column:
    """The number of a dotted address. Other text is 0, as collectors have it, or raises if ``strict``."""
    part = [F.regexp_extract(text, _DOTTED, k).try_cast("bigint") for k in range(1, 5)]
    value = part[0] * (1 << 24) + part[1] * (1 << 16) + part[2] * (1 << 8) + part[3]
    other = F.raise_error(F.concat(F.lit("not an address: "), text)).cast("bigint") if strict else F.lit(0).cast("bigint")
    return F.when(text.rlike(_DOTTED), value).when(text.isNull(), None).otherwise(other)


def long_to_ip(value: Column) -> Column:
    octet = [F.shiftright(value, s).bitwiseAND(F.lit(255)).cast("string") for s in (24, 16, 8, 0)]
    return F.concat_ws(".", *octet)
