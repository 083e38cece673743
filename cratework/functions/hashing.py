"""Hashes and identity digests as built-in column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from cratework.functions.text import let, trim_to_null

_WRAP = 1 << 32


def signed_32(c: Column) -> Column:
    """The unsigned 32-bit value in a BIGINT as a signed INT."""
    return F.when(c >= F.lit(_WRAP // 2), c - F.lit(_WRAP)).otherwise(c).cast("int")


def java_hash(c: Column | str) -> Column:
    """the 31-polynomial over the UTF-16 units of a text, wrapped to a signed 32-bit integer; null stays null.

    Units are groups of four digits of the hex form, cut once; the sum is kept in BIGINT below 2^37, which can't
    overflow.
    """
    c = F.col(c) if isinstance(c, str) else c
    units = F.regexp_extract_all(F.hex(F.encode(c, "UTF-16BE")), F.lit("...."), F.lit(0))
    total = F.aggregate(
        units, F.lit(0).cast("long"), lambda a, u: (a * 31 + F.conv(u, 16, 10).cast("long")).bitwiseAND(F.lit(_WRAP - 1))
    )
    return let(total, signed_32)


def fnv1_32(c: Column | str) -> Column:
    """FNV-1, 32 bits, over the UTF-8 bytes, as an unsigned value in BIGINT; null stays null."""
    c = F.col(c) if isinstance(c, str) else c
    units = F.regexp_extract_all(F.hex(F.encode(c, "UTF-8")), F.lit(".."), F.lit(0))
    byte = lambda u: F.conv(u, 16, 10).cast("long")
    # Offset basis 2166136261 and prime 16777619. The product stays below 2^57.
    return F.aggregate(
        units, F.lit(2166136261).cast("long"), lambda a, u: (a * F.lit(16777619)).bitwiseAND(F.lit(_WRAP - 1)).bitwiseXOR(byte(u))
    )


@dataclass(frozen=True)
class IdentityDomain:
    """The domain texts that frame digests and slots. They are part of the stored format: whoever must reproduce
    digests written elsewhere passes the domains used there."""

    digest: str
    slot: str


RELEASE_DOMAIN = IdentityDomain("cratework/release-relation-identity/v1", "cratework/release-relation-slot/v1")
CATALOGUE_DOMAIN = IdentityDomain("cratework/catalogue-relation-identity/v1", "cratework/catalogue-relation-slot/v1")


def _bytes(text: str) -> Column:
    return F.encode(F.lit(text), "UTF-8")


def _length_32(c: Column) -> Column:
    return F.unhex(F.lpad(F.hex(F.octet_length(c)), 8, "0"))


def digest_field(c: Column) -> Column:
    """F8: one framed field: byte 00 for null or blank, else byte 01, length (32 bits, big-endian) and UTF-8 bytes, trimmed."""
    frame = lambda t: F.when(t.isNull(), F.unhex(F.lit("00"))).otherwise(F.concat(F.unhex(F.lit("01")), _length_32(t), F.encode(t, "UTF-8")))
    return let(trim_to_null(c), frame)


def int_field(c: Column) -> Column:
    """an integer as decimal text, for ``identity_digest``."""
    return c.cast("string")


def identity_digest(domain: IdentityDomain, relation: str, fields: list[Column]) -> Column:
    """SHA-256 (BINARY, 32 bytes) of domain 00 relation 00 and the framed fields. Never null."""
    head = F.concat(_bytes(domain.digest), F.unhex(F.lit("00")), _bytes(relation), F.unhex(F.lit("00")))
    return F.unhex(F.sha2(F.concat(head, *[digest_field(c) for c in fields]), 256))


def compat_slot(domain: IdentityDomain, relation: str, digest: Column, attempt: int | Column = 0) -> Column:
    """first four bytes, signed, of SHA-256(slot domain 00 relation 00 digest attempt as 32 bits)."""
    at = F.lit(attempt).cast("long") if isinstance(attempt, int) else attempt.cast("long")
    frame = F.concat(
        _bytes(domain.slot), F.unhex(F.lit("00")), _bytes(relation), F.unhex(F.lit("00")), digest, F.unhex(F.lpad(F.hex(at), 8, "0"))
    )
    return let(F.conv(F.substr(F.sha2(frame, 256), F.lit(1), F.lit(8)), 16, 10).cast("long"), signed_32)


def valid_digest(c: Column) -> Column:
    """whether a stored digest has its 32 bytes (false for null)."""
    return F.coalesce(F.octet_length(c) == 32, F.lit(False))
