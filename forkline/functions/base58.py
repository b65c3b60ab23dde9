"""Base58 text of keys (32 bytes) and signatures (64 bytes)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: The alphabet of the encoding (fixed value).
ALPHABET = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
KEY_BYTES, SIGNATURE_BYTES = 32, 64
_VALUE = {c: i for i, c in enumerate(ALPHABET)}


def encode(raw: bytes) -> str:
    zeros = len(raw) - len(raw.lstrip(b"\0"))
    n, digits = int.from_bytes(raw, "big"), []
    while n:
        n, r = divmod(n, 58)
        digits.append(ALPHABET[r])
    return ALPHABET[0] * zeros + "".join(reversed(digits))


def decode(text: str) -> bytes | None:
    """The bytes, or None where a character isn't in the alphabet."""
    n = 0
    for c in text:
        if c not in _VALUE:
            return None
        n = n * 58 + _VALUE[c]
    zeros = len(text) - len(text.lstrip(ALPHABET[0]))
    return b"\0" * zeros + n.to_bytes((n.bit_length() + 7) // 8, "big")


def encoded(column: Column) -> Column:
    @F.pandas_udf("string")
    def f(raw: pd.Series) -> pd.Series:
        return raw.map(lambda x: None if x is None else encode(bytes(x)))

    return f(column)


def decoded(column: Column, length: int) -> Column:
    """The bytes where there are exactly `length` of them, else null."""

    @F.pandas_udf("binary")
    def f(text: pd.Series) -> pd.Series:
        return text.map(lambda x: None if x is None else raw if (raw := decode(x)) is not None and len(raw) == length else None)

    return f(column)
