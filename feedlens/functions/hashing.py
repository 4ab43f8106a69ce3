"""Deterministic md5-derived integers (reproducible in any SQL engine)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_int32(c) -> Column:
    """First 8 hex digits of md5(utf-8 text) as a non-negative BIGINT."""
    x = F.col(c) if isinstance(c, str) else c
    return F.conv(F.substring(F.md5(F.encode(x, "utf-8")), 1, 8), 16, 10).cast("bigint")


def md5_bucket(c, dim: int) -> Column:
    return (md5_int32(c) % F.lit(dim)).cast("int")


def md5_sign(c, bit: int = 16) -> Column:
    """+1.0 when bit ``bit`` of the md5 integer is set, else -1.0."""
    h = md5_int32(c)
    return F.when(F.shiftright(h, bit).bitwiseAND(F.lit(1)) == 1, F.lit(1.0)).otherwise(F.lit(-1.0))
