"""Identifiers from content."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_id(url: Column, index: Column) -> Column:
    """First 12 hex digits of the SHA-1 of `url:index`."""
    return F.substring(F.sha1(F.concat_ws(":", url, index.cast("string"))), 1, 12)


def set_fingerprint(c: Column) -> Column:
    """Aggregate: a digest of a bag of values, whatever their order; equal values count as often as they occur.

    Each value adds both 60-bit halves of its MD5 to a sum, so the state is two numbers and no group is
    ever collected; for a set feed it distinct rows. Null values add nothing.
    """
    return F.concat_ws("-", F.sum(number_of(c).cast("decimal(28,0)")).cast("string"), F.sum(number_of(c, 16).cast("decimal(28,0)")).cast("string"))


def number_of(c: Column, first: int = 1) -> Column:
    """60 bits of the MD5 of a value as a bigint, from that hex digit on."""
    return F.conv(F.substring(F.md5(c), first, 15), 16, 10).cast("bigint")


def content_key(*parts: Column) -> Column:
    """SHA-256 of parts, null and empty alike."""
    return F.sha2(F.concat_ws("\u001f", *[F.trim(F.coalesce(p.cast("string"), F.lit(""))) for p in parts]), 256)


def grouped_digest_sql(c: str) -> str:
    """The SQL of set_fingerprint()."""
    half = lambda k: f"cast(sum(cast('0x' || substr(md5({c}), {k}, 15) as hugeint)) as varchar)"
    return f"concat_ws('-', {half(1)}, {half(16)})"
