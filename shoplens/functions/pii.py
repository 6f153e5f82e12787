"""PII normalisation and keyed hashing with built-in functions only.

The hash runs inside the JVM (codegen), no Python worker. Spark has no
``hmac`` function, so HMAC-SHA256 is assembled from its definition:
``H((K ^ opad) || H((K ^ ipad) || m))`` with the key padded to the
SHA-256 block size. The pads are derived once on the driver; they appear
as literals in ``explain()`` output, so treat plan text as secret.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from shoplens.functions.text import strip

SHA256_BLOCK = 64
ALGORITHMS = ("hmac_sha256", "md5")

# Anything that is not a Unicode decimal digit (Python's \D on str).
_NON_DIGITS = r"\P{Nd}+"


def normalize_email(v: Column) -> Column:
    """strip + lower."""
    return F.lower(strip(v.cast("string")))


def normalize_phone(v: Column) -> Column:
    """Keep digits; an 11-digit number starting with 8 becomes 7...."""
    digits = F.regexp_replace(v.cast("string"), _NON_DIGITS, "")
    return (F.when((F.length(digits) == 11) & digits.startswith("8"),
                   F.concat(F.lit("7"), F.substring(digits, 2, 10)))
            .otherwise(digits))


def _pads(key: bytes) -> tuple[str, str]:
    if len(key) > SHA256_BLOCK:
        key = hashlib.sha256(key).digest()
    key = key.ljust(SHA256_BLOCK, b"\0")
    ipad = bytes(b ^ 0x36 for b in key).hex()
    opad = bytes(b ^ 0x5C for b in key).hex()
    return ipad, opad


def hmac_sha256_hex(v: Column, key: bytes) -> Column:
    ipad, opad = _pads(key)
    inner = F.sha2(F.concat(F.unhex(F.lit(ipad)), F.encode(v.cast("string"), "UTF-8")), 256)
    return F.sha2(F.concat(F.unhex(F.lit(opad)), F.unhex(inner)), 256)


def salted_md5_hex(v: Column, salt: bytes) -> Column:
    return F.md5(F.concat(F.unhex(F.lit(salt.hex())), F.encode(v.cast("string"), "UTF-8")))


@dataclass(frozen=True)
class PiiHasher:
    """Salt + algorithm. No default salt: a missing salt is an error, and an
    unknown algorithm name is rejected rather than silently falling back."""

    salt: bytes
    algorithm: str = "hmac_sha256"

    def __post_init__(self):
        if not self.salt:
            raise ValueError("PII salt is required (set it in the job config)")
        if self.algorithm not in ALGORITHMS:
            raise ValueError(f"unknown PII algorithm {self.algorithm!r}; use one of {ALGORITHMS}")

    def __repr__(self) -> str:  # never print the salt
        return f"PiiHasher(algorithm={self.algorithm!r}, salt=<hidden>)"

    @classmethod
    def from_text(cls, salt: str, algorithm: str = "hmac_sha256") -> "PiiHasher":
        return cls((salt or "").encode("utf-8"), algorithm)

    def hash(self, v: Column) -> Column:
        if self.algorithm == "md5":
            return salted_md5_hex(v, self.salt)
        return hmac_sha256_hex(v, self.salt)

    def email(self, v: Column) -> Column:
        return self.hash(normalize_email(v))

    def phone(self, v: Column) -> Column:
        return self.hash(normalize_phone(v))
