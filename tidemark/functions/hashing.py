"""Row hashes, surrogate keys and keyed hashes, all as JVM expressions."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEPARATOR, NULL = "\x1f", "\x00"
_BLOCK = 64


def canonical(df: DataFrame, name: str) -> Column:
    """The text a value is hashed by: timestamps as microseconds, nested values as JSON, null as a mark that no text equals."""
    kind, c = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, T.TimestampNTZType):
        c = F.unix_micros(c.cast("timestamp"))
    elif isinstance(kind, T.TimestampType):
        c = F.unix_micros(c)
    elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        c = F.to_json(c)
    return F.coalesce(c.cast("string"), F.lit(NULL))


def joined(df: DataFrame, names: list[str]) -> Column:
    return F.concat_ws(SEPARATOR, *(canonical(df, n) for n in names)) if names else F.lit("")


def row_hash(df: DataFrame, names: list[str]) -> Column:
    """SHA-256 over the values; an empty text where there are no columns."""
    return F.sha2(joined(df, names), 256) if names else F.lit("")


def surrogate_key(df: DataFrame, names: list[str]) -> Column:
    """A positive 63-bit key of the values, the first bits of their SHA-256; 0 is left to the unknown member."""
    digest = F.sha2(joined(df, names), 256)
    part = lambda start, n: F.conv(F.substring(digest, start, n), 16, 10).cast("bigint")
    return F.greatest(F.shiftleft(part(1, 15), 3) + F.shiftright(part(16, 1), 1), F.lit(1).cast("bigint"))


def hmac_sha256(c: Column, key: bytes) -> Column:
    """HMAC-SHA256 in hex (RFC 2104) of a text column; null stays null."""
    padded = (hashlib.sha256(key).digest() if len(key) > _BLOCK else key).ljust(_BLOCK, b"\0")
    pad = lambda x: F.unhex(F.lit(bytes(b ^ x for b in padded).hex()))
    inner = F.unhex(F.sha2(F.concat(pad(0x36), F.encode(c, "UTF-8")), 256))
    return F.sha2(F.concat(pad(0x5C), inner), 256)
