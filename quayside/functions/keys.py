"""Deterministic row keys (KEY-1..3).

The reference draws these from the clock and a random source. Here they are
a pure function of the row's natural key: the bytes of an MD5 digest pick
characters from a 62-letter alphabet, so a rerun (or a retried task) gives the
same keys. One digest gives 16 characters; longer keys append digests of the
key salted with ``#1``, ``#2``, ...
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Key alphabet and lengths of the reference.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
DEFAULT_LENGTH = 8
COMPOSITE_LENGTH = 45
COMPOSITE_PART_LENGTH = 10
COMPOSITE_HASH_CHARS = 15


# Byte value -> key character (character i of the alphabet for byte b is
# ALPHABET[b % 62]), as a 256-entry translation table built from the rule.
_BYTE_CHARS = "".join(chr(b) for b in range(256))
_KEY_CHARS = "".join(ALPHABET[b % len(ALPHABET)] for b in range(256))


def encoded(key: Column, n: int) -> Column:
    """``n`` alphabet characters derived from ``key`` (a string column):
    character i is ``ALPHABET[byte_i % 62]`` of the key's digest bytes.

    Each digest's 16 bytes are read as one Latin-1 string (one character per
    byte) and mapped with a single ``translate``: one JVM expression per
    digest instead of one per character."""
    parts = [F.md5(key)] + [F.md5(F.concat(key, F.lit(f"#{j}"))) for j in range(1, (n + 15) // 16)]
    mapped = [F.translate(F.decode(F.unhex(p), "ISO-8859-1"), _BYTE_CHARS, _KEY_CHARS) for p in parts]
    return F.substring(F.concat(*mapped) if len(mapped) > 1 else mapped[0], 1, n)


def surrogate_key(key: Column, prefix: str = "x", n: int = DEFAULT_LENGTH) -> Column:
    """KEY-1: one prefix character (``x`` if the prefix is not exactly one
    character) followed by ``n`` characters (``n <= 0`` means 8)."""
    if len(prefix) != 1:
        prefix = "x"
    if n <= 0:
        n = DEFAULT_LENGTH
    return F.concat(F.lit(prefix), encoded(key, n))


def surrogate_key_32(key: Column) -> Column:
    """KEY-2: a 32-character key."""
    return encoded(key, 32)


def composite_key(affiliate: Column, asin: Column, source: Column) -> Column:
    """KEY-3: ``ag<affiliate>X<asin>X<source>X<15 chars>``, affiliate and
    asin cut to 10 characters; the result is cut or padded to 45."""
    aff = F.substring(affiliate, 1, COMPOSITE_PART_LENGTH)
    asn = F.substring(asin, 1, COMPOSITE_PART_LENGTH)
    src = source.cast("string")
    seed = F.concat(aff, asn, src)
    head = F.concat(F.lit("ag"), aff, F.lit("X"), asn, F.lit("X"), src, F.lit("X"),
                    encoded(seed, COMPOSITE_HASH_CHARS))
    # The head has 20 characters at least, so this many can be needed (two digests).
    pad = encoded(F.concat(seed, F.lit("#pad")), COMPOSITE_LENGTH - 5 - COMPOSITE_HASH_CHARS)
    return F.substring(F.concat(head, pad), 1, COMPOSITE_LENGTH)


def encoded_sql(key: str, n: int) -> str:
    """DuckDB twin of :func:`encoded` (for oracles)."""
    parts = [f"md5({key})"] + [f"md5(concat({key}, '#{j}'))" for j in range(1, (n + 15) // 16)]
    hexes = f"concat({', '.join(parts)})" if len(parts) > 1 else parts[0]
    return (f"array_to_string(list_transform(range(0, {n}), lambda i: substr('{ALPHABET}', "
            f"CAST(('0x' || substr({hexes}, CAST(i * 2 + 1 AS INT), 2)) AS INTEGER) % 62 + 1, 1)), '')")
