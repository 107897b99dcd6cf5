"""Content hashes and shard ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sha256_hex(text: Column) -> Column:
    """SHA-256 of a text; null and the empty string give the empty string."""
    text = F.coalesce(text, F.lit(""))
    return F.when(text == "", F.lit("")).otherwise(F.sha2(text, 256))


def md5_hex(text: Column) -> Column:
    return F.md5(text)


def hex_to_long(digits: Column) -> Column:
    """Up to 15 hex digits as a number."""
    return F.conv(digits, 16, 10).cast("bigint")


def token_hash32(token: Column) -> Column:
    return hex_to_long(F.substring(F.md5(token), 1, 8))


def token_hash64(token: Column) -> Column:
    """First 16 md5 digits as a signed 64-bit number, built from two halves."""
    digest = F.md5(token)
    high, low = hex_to_long(F.substring(digest, 1, 8)), hex_to_long(F.substring(digest, 9, 8))
    return F.shiftleft(high, 32).bitwiseOR(low)


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def shard_id(key: Column, shards: int = 16, digits: int = 8) -> Column:
    prefix = F.substring(F.md5(F.coalesce(key, F.lit(""))), 1, digits)
    return F.pmod(hex_to_long(prefix), F.lit(shards)).cast("int")
