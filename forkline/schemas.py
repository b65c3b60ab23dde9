"""Schemas of raw events, of the append-only logs, and of declared domain records."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


LONG, TEXT, BYTES, TIME, FLAG, INT = T.LongType(), T.StringType(), T.BinaryType(), T.TimestampType(), T.BooleanType(), T.IntegerType()
SLOTS = T.ArrayType(LONG)

#: Kinds in the order of the ordinals that the event hash uses, origins, statuses and categories (fixed values).
KINDS = ("SlotUpdate", "AccountUpdate", "Transaction", "BlockMeta", "Entry")
ORIGINS = ("live", "backfill", "replay")
STATUSES = ("Processing", "Confirmed", "Rooted", "Skipped", "Orphaned")
CATEGORIES = ("malformed", "validation", "processing", "persistence", "unknown")

#: A raw event: arrival is the total order in which a chain's events came; chains are independent.
RAW = _struct(arrival=LONG, source_seq=LONG, origin=TEXT, kind=TEXT, slot=LONG, parent_slot=LONG, payload=BYTES, received_at=TIME)
#: The wire form of a raw event.
WIRE = _struct(sequence=LONG, kind=INT, slot=LONG, parent_slot=LONG, payload=BYTES, received_at_ms=LONG)

EVENT_LOG = _struct(slot=LONG, source_seq=LONG, seq=LONG, origin=TEXT, kind=TEXT, parent_slot=LONG, data=TEXT, event_hash=TEXT, received_at=TIME, ord=LONG, at=TIME)
SLOT_LOG = _struct(slot=LONG, parent_slot=LONG, status=TEXT, block_hash=TEXT, block_time=TIME, transaction_count=INT, received_at=TIME, ord=LONG)
ACTION_LOG = _struct(slot=LONG, action=TEXT, ord=LONG, at=TIME)
REORG_LOG = _struct(id=TEXT, fork_slot=LONG, old_head=LONG, parent_slot=LONG, divergence_point=LONG, depth=INT, slots_rolled_back=SLOTS, slots_restored=SLOTS, divergence_is_bound=FLAG, ord=LONG, detected_at=TIME)
CURSOR_LOG = _struct(name=TEXT, slot=LONG, seq=LONG, source_seq=LONG, metadata=TEXT, updated_at=TIME, ord=LONG)
DLQ_LOG = _struct(
    id=TEXT, raw_payload=BYTES, sequence=LONG, slot=LONG, parent_slot=LONG, kind=TEXT, error_message=TEXT, error_category=TEXT, retry_count=INT, max_retries=INT, is_resolved=FLAG, failed_at=TIME, last_retry_at=TIME, resolved_at=TIME, received_at=TIME, ord=LONG
)
#: A block of the archive, as the RPC gives it.
BLOCK = _struct(
    slot=LONG,
    parentSlot=LONG,
    blockhash=TEXT,
    blockTime=LONG,
    transactions=T.ArrayType(_struct(transaction=_struct(signatures=T.ArrayType(TEXT), message=TEXT), meta=_struct(err=TEXT, fee=LONG, computeUnitsConsumed=LONG))),
)
#: Declared domain records that no operator fills.
ACCOUNT_DATA = _struct(encoding=TEXT, data=TEXT, size=LONG)
TRANSACTION_META = _struct(signature=TEXT, slot=LONG, index=INT, success=FLAG, fee=LONG, compute_units=LONG, account_keys=T.ArrayType(TEXT))
ACCOUNT_UPDATE = _struct(pubkey=TEXT, slot=LONG, lamports=LONG, owner=TEXT, executable=FLAG, rent_epoch=LONG, data=ACCOUNT_DATA)

#: All tables with their keys, as a migration would declare them.
TABLES = {"event_log": EVENT_LOG, "slot_log": SLOT_LOG, "action_log": ACTION_LOG, "reorg_log": REORG_LOG, "cursor_log": CURSOR_LOG, "dlq_log": DLQ_LOG}
