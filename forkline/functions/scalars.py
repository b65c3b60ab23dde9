"""Scalar rules as column expressions."""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

LONG_MAX = 2**63 - 1
#: Bits of a backfilled event's number that its place in the block takes.
STRIDE_BITS = 20
#: Order in which kinds are processed, the chain's own first (fixed values).
KIND_PRIORITY = {"SlotUpdate": 0, "BlockMeta": 1, "Entry": 2, "Transaction": 3, "AccountUpdate": 4}
#: Errors by what follows from them (fixed values).
CATEGORY_OF = {"InvalidMessage": "malformed", "EventParse": "malformed", "EventValidation": "validation", "DatabaseQuery": "persistence", "DatabaseConnection": "persistence", "Serialization": "unknown"}
RETRYABLE = ("GrpcConnection", "StreamEnded", "DatabaseConnection", "ProcessingTimeout", "ChannelFull")
TO_DLQ = ("InvalidMessage", "EventParse", "EventValidation", "Serialization")
FATAL = ("RollbackFailed", "DlqWriteFailed", "Configuration")
SKIPPED = ("DuplicateSequence", "DuplicateKey")


def lookup(column: Column, table: dict, otherwise) -> Column:
    return functools.reduce(lambda c, kv: c.when(column == kv[0], F.lit(kv[1])), table.items(), F.when(F.lit(False), F.lit(otherwise))).otherwise(F.lit(otherwise))


def kind_priority(kind: Column) -> Column:
    return lookup(kind, KIND_PRIORITY, len(KIND_PRIORITY))


def error_category(error: Column) -> Column:
    return lookup(error, CATEGORY_OF, "processing")


def error_traits(error: Column) -> dict[str, Column]:
    return {"is_retryable": error.isin(*RETRYABLE), "should_dlq": error.isin(*TO_DLQ), "is_fatal": error.isin(*FATAL), "is_duplicate": error.isin(*SKIPPED)}


def account_data_size(encoding: Column, data: Column, size: Column) -> Column:
    """Bytes of raw data, three quarters of base64 text (padding counts), or the size that truncated data declares."""
    return F.when(encoding == "raw", F.octet_length(data).cast("long")).when(encoding == "base64", F.floor(F.octet_length(data) * 3 / 4).cast("long")).otherwise(size.cast("long"))


def backfill_sequence(slot: Column, index: Column) -> Column:
    """slot * 2^20 + index, and the largest bigint where that overflows; ordered by slot, then by place."""
    top = LONG_MAX >> STRIDE_BITS
    return F.when((slot > top) | ((slot == top) & (index > LONG_MAX - (top << STRIDE_BITS))), F.lit(LONG_MAX)).otherwise(F.shiftleft(slot.cast("long"), STRIDE_BITS) + index)


def sequence_next(n: Column) -> Column:
    return F.when(n == LONG_MAX, n).otherwise(n + 1)


def sequence_prev(n: Column) -> Column:
    return F.when(n > 0, n - 1)


def gap_to(a: Column, b: Column) -> Column:
    """How far b is beyond a, or null where it is before."""
    return F.when(b >= a, b - a)


def status_flags(status: Column) -> dict[str, Column]:
    return {"is_revocable": status.isin("Processing", "Confirmed"), "is_final": status.isin("Rooted", "Orphaned")}


def redact_url(url: Column) -> Column:
    """Credentials between :// and the first @ become ***; an address without them, or with an @ before, stays."""
    scheme, at = F.instr(url, "://"), F.instr(url, "@")
    hidden = F.concat(F.substr(url, F.lit(1), scheme - 1), F.lit("://***"), F.substr(url, at))
    return F.when((scheme > 0) & (at > scheme + 3), hidden).otherwise(url)


def overflow_policy(name: str) -> str:
    return name if name in ("drop_oldest", "drop_newest") else "block"


def page_size(n: int | None, default: int = 100, most: int = 1000) -> int:
    return min(most, max(1, default if n is None else n))
