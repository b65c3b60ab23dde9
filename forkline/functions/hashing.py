"""The event hash, in built-in functions."""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import KINDS


def little_endian(number: Column) -> Column:
    """The eight bytes of a bigint, lowest first; hex pairs are swapped, as reversing binary would treat it as text."""
    digits = F.lpad(F.hex(number), 16, "0")
    return F.unhex(F.concat(*[F.substring(digits, 15 - 2 * i, 2) for i in range(8)]))


def kind_ordinal(kind: Column) -> Column:
    return functools.reduce(lambda c, k: c.when(kind == k[1], F.lit(k[0])), enumerate(KINDS), F.when(F.lit(False), F.lit(0)))


def event_hash(slot: Column, source_seq: Column, kind: Column, payload: Column) -> Column:
    """Half of the SHA-256 over slot, sequence, the kind's ordinal and the payload, as 32 hex digits."""
    ordinal = F.unhex(F.lpad(F.hex(kind_ordinal(kind)), 2, "0"))
    return F.substring(F.sha2(F.concat(little_endian(slot), little_endian(source_seq), ordinal, payload), 256), 1, 32)
