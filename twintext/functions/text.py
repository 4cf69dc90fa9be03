"""Text tests and ordering keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def valid_utf8(text: Column) -> Column:
    """True iff ``text`` (string or binary) is well-formed UTF-8; null is not.

    The test has to run on the bytes as stored: once a malformed string has
    been through a Python string the damage is no longer visible.
    """
    return F.coalesce(F.is_valid_utf8(text.cast("string")), F.lit(False))


def within_length(text: Column, limit: int) -> Column:
    """True iff ``text`` has at most ``limit`` code points; null is not."""
    return F.coalesce(F.char_length(text) <= limit, F.lit(False))


def order_key(row_id: Column, *salt: object) -> Column:
    """A reproducible pseudo-random sort key: md5 of ``salt:...:row_id``.

    The key is a pure function of the row, so a lost executor recomputes the
    same order, and the digest is uniform, so equal-width key ranges hold
    equally many rows whatever the ids look like.
    """
    parts = [F.lit(str(s)) for s in salt] + [row_id.cast("string")]
    return F.md5(F.concat_ws(":", *parts).cast("binary"))


def numeric_key(row_id: Column, low: int, high: int) -> Column:
    """Hex digits, as few as ``low``..``high`` needs, that sort as the id does."""
    digits = len(f"{high - low:x}")
    if high - low < 2**63:
        offset = row_id.cast("long") - F.lit(low).cast("long")
        return F.lpad(F.lower(F.hex(offset)), digits, "0")
    # A span beyond 63 bits: the sign bit is flipped instead.
    flipped = row_id.cast("long").bitwiseXOR(F.lit(-(2**63)).cast("long"))
    return F.lpad(F.lower(F.hex(flipped)), 16, "0")


def numeric_key_value(key: str, low: int, high: int) -> int:
    """The id behind a :func:`numeric_key`."""
    return int(key, 16) + (low if high - low < 2**63 else -(2**63))
