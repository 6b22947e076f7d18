"""Keyed pseudonyms without leaving the JVM."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, functions as F

_BLOCK = 64  # bytes in a SHA-256 block


def hmac_pads(key: str | bytes) -> tuple[str, str]:
    """Hex of the key xor-ed with the inner and the outer pad."""
    raw = key.encode("utf-8") if isinstance(key, str) else key
    if not raw:
        raise ValueError("a salt is mandatory")
    if len(raw) > _BLOCK:
        raw = hashlib.sha256(raw).digest()
    raw = raw.ljust(_BLOCK, b"\0")
    return bytes(b ^ 0x36 for b in raw).hex(), bytes(b ^ 0x5C for b in raw).hex()


def pseudonym(identifier: Column, key: str | bytes) -> Column:
    """Hex HMAC-SHA256 of an identifier; a missing identifier counts as the empty string."""
    inner, outer = hmac_pads(key)
    message = F.encode(F.coalesce(identifier.cast("string"), F.lit("")), "UTF-8")
    digest = F.sha2(F.concat(F.unhex(F.lit(inner)), message), 256)
    return F.sha2(F.concat(F.unhex(F.lit(outer)), F.unhex(digest)), 256)
