"""SQL twins of the named queries, for DuckDB over the driver's tables.

They know the derived chain's closed form (a slot is canonical unless it lies between a later fork's parent and the fork) and no tracker.
"""

from __future__ import annotations

#: Parameters of the queries.
P = {
    "after": 400,
    "kinds": ("Transaction", "Entry"),
    "slot": 17,
    "from_slot": 40,
    "to_slot": 90,
    "from_seq": 500,
    "to_seq": 700,
    "kind": "Transaction",
    "signature": "sig-42",
    "account": "acct-7",
    "lookup": 49,
    "history": 20,
    "dry_run": (10, 11, 12, 49),
    "purge_below": 100,
    "filled": (1, 500),
    "last_seen": 300,
    "first_seq": 1000,
    "dlq_slots": (1, 25, 50, 98, 122),
    "now_s": 1_706_745_600,
    "purge_days": 15,
    "first_arrival": 5_000_000,
    "first_batch": 400,
}

_BASE = """base AS (
  SELECT event_id, event_id + 1 AS source_seq, event_id // 4 AS i, event_id // 4 + 1 AS slot, user_id, props, epoch_us(ts) AS us,
    CASE event_type WHEN 'click' THEN 'Transaction' WHEN 'purchase' THEN 'AccountUpdate' WHEN 'view' THEN 'Entry' WHEN 'signup' THEN 'BlockMeta' WHEN 'error' THEN 'SlotUpdate' END AS kind,
    CASE WHEN (event_id // 4) % 50 = 49 THEN event_id // 4 - (1 + ((event_id // 4) // 50) % 5) ELSE event_id // 4 END AS parent_slot
  FROM events),
ev AS (SELECT *, row_number() OVER (ORDER BY event_id) AS seq FROM base WHERE event_id % 101 <> 100),
sl AS (SELECT slot, min(parent_slot) AS parent_slot, min(us) AS us, min(event_id) + 1 AS arrival FROM ev GROUP BY slot),
forks AS (SELECT *, slot - 1 - parent_slot AS depth FROM sl WHERE slot % 50 = 0),
lost AS (SELECT s.slot, min(f.us) AS us FROM sl s JOIN forks f ON f.parent_slot < s.slot AND s.slot < f.slot GROUP BY s.slot),
cur AS (SELECT e.*, l.slot IS NULL AS is_valid, l.us AS lost_us FROM ev e LEFT JOIN lost l USING (slot))"""


def _bytes(number: str) -> str:
    """Eight bytes of a number, lowest first."""
    digits = f"printf('%016x', {number})"
    return "unhex(" + " || ".join(f"substr({digits}, {15 - 2 * i}, 2)" for i in range(8)) + ")"


_ORDINAL = "unhex(CASE kind WHEN 'SlotUpdate' THEN '00' WHEN 'AccountUpdate' THEN '01' WHEN 'Transaction' THEN '02' WHEN 'BlockMeta' THEN '03' ELSE '04' END)"
_JSON = """'{"signature":"sig-' || event_id || '","message":{"accountKeys":["acct-' || user_id || '","acct-shared"]}}'"""


def _hash(payload: str) -> str:
    return f"substr(sha256({_bytes('slot')} || {_bytes('source_seq')} || {_ORDINAL} || encode({payload})), 1, 32)"


def _page(where: str, payload: str = "props", limit: int = 100, offset: int = 0) -> str:
    return f"SELECT slot, seq, source_seq, kind, parent_slot, {_hash(payload)} AS event_hash FROM cur WHERE is_valid AND {where} ORDER BY slot, seq LIMIT {limit} OFFSET {offset}"


def _text(numbers: str) -> str:
    return f"coalesce(array_to_string({numbers}, ','), '')"


_NOISY = """, noisy AS (
  SELECT source_seq * 4 AS arrival, source_seq, slot, props FROM ev
  UNION ALL SELECT source_seq * 4 + 1, source_seq, slot, props FROM ev WHERE source_seq % 37 = 5
  UNION ALL SELECT source_seq * 4 + 2, source_seq - 3, slot, props FROM ev WHERE source_seq % 53 = 7 AND source_seq > 3),
seen AS (SELECT *, max(source_seq) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM noisy),
cls AS (SELECT *, CASE WHEN seen IS NULL OR source_seq = seen + 1 THEN 'processed' WHEN source_seq = seen THEN 'duplicate' WHEN source_seq < seen THEN 'regression' ELSE 'gap' END AS outcome FROM seen)"""
_GAPS = """, gaps AS (
  SELECT source_seq, prev + 1 AS gap_start, source_seq - 1 AS gap_end FROM (SELECT source_seq, lag(source_seq) OVER (ORDER BY source_seq) AS prev FROM ev) WHERE source_seq > prev + 1)"""
_TRIED = """, dl AS (SELECT *, CASE WHEN slot % 2 = 1 THEN 1 WHEN slot % 4 = 0 THEN 3 ELSE 0 END AS retry_count, slot % 2 = 1 AS is_resolved FROM ev WHERE event_id % 97 = 0)"""
_ARCHIVE = """, tx AS (SELECT *, row_number() OVER (PARTITION BY slot ORDER BY source_seq) - 1 AS idx FROM base WHERE kind = 'Transaction')"""
_CURSORS = """, blocks AS (
  SELECT source_seq // 1000 AS block, max(slot) AS slot, max(seq) AS seq, max(source_seq) AS source_seq, arg_max(us, source_seq) AS us FROM ev GROUP BY 1),
cursors AS (
  SELECT CASE WHEN block % 2 = 0 THEN 'even' ELSE 'odd' END AS name, max(slot) AS slot, max(seq) AS seq, max(source_seq) AS source_seq, 'block-' || arg_max(block, source_seq) AS metadata, arg_max(us, source_seq) AS updated_at_us
  FROM blocks GROUP BY 1)"""
_EXPECTED = """, straight AS (SELECT unnest(range(1, (SELECT max(event_id) // 4 + 2 FROM base))) AS slot),
whole AS (SELECT slot FROM straight WHERE NOT (((slot - 1) // 50 + 1) * 50 <= (SELECT max(slot) FROM straight) AND slot < ((slot - 1) // 50 + 1) * 50 AND slot >= ((slot - 1) // 50 + 1) * 50 - 1 - ((slot - 1) // 50) % 5))"""
#: Errors with their category and whether they are retried, kept as dead letters, fatal or skipped.
_ERRORS = """(VALUES
  ('GrpcConnection', 'processing', true, false, false, false), ('StreamEnded', 'processing', true, false, false, false),
  ('InvalidMessage', 'malformed', false, true, false, false), ('SequenceGap', 'processing', false, false, false, false),
  ('DuplicateSequence', 'processing', false, false, false, true), ('SequenceRegression', 'processing', false, false, false, false),
  ('ForkDetected', 'processing', false, false, false, false), ('RollbackFailed', 'processing', false, false, true, false),
  ('EventParse', 'malformed', false, true, false, false), ('EventValidation', 'validation', false, true, false, false),
  ('ProcessingTimeout', 'processing', true, false, false, false), ('DatabaseConnection', 'persistence', true, false, false, false),
  ('DatabaseQuery', 'persistence', false, false, false, false), ('DuplicateKey', 'processing', false, false, false, true),
  ('Serialization', 'unknown', false, true, false, false), ('DlqWriteFailed', 'processing', false, false, true, false),
  ('BackfillCursor', 'processing', false, false, false, false), ('BackfillRange', 'processing', false, false, false, false),
  ('Configuration', 'processing', false, false, true, false), ('ChannelClosed', 'processing', false, false, false, false),
  ('ChannelFull', 'processing', true, false, false, false)) AS t(error, category, is_retryable, should_dlq, is_fatal, is_duplicate)"""


def oracle_sql() -> dict[str, str]:
    def q(body: str, *more: str) -> str:
        return f"WITH {_BASE}{''.join(more)} {body}"

    slots = lambda s: "(" + ", ".join(map(str, s)) + ")"
    kinds = "(" + ", ".join(f"'{k}'" for k in P["kinds"]) + ")"
    count = lambda where: f"(SELECT count(*) FROM ev WHERE {where})"
    return {
        # sources
        "wire_decode": q("SELECT source_seq, CASE WHEN source_seq % 29 <> 0 THEN kind END AS kind, slot, parent_slot, (us // 1000) * 1000 AS received_at_us, source_seq % 29 <> 0 AS decoded FROM ev"),
        "src_subscribe": q(f"SELECT source_seq, kind, slot FROM ev WHERE source_seq > {P['after']} AND kind IN {kinds}"),
        "src_status": q("SELECT max(source_seq) AS last_sequence, max(slot) AS max_slot FROM ev"),
        "script_emit": q("SELECT source_seq AS arrival, source_seq, slot, parent_slot, 'slot' || slot || '-ev' || (event_id % 4) AS label FROM base"),
        "script_contiguity": q("SELECT slot, min(parent_slot) AS parent_slot FROM base WHERE slot > 1 AND slot % 20 <> 11 AND parent_slot % 20 = 11 GROUP BY slot"),
        "rpc_block_explode": q(
            "SELECT slot, slot - 1 AS parent_slot, CAST(idx AS INTEGER) AS index, 'sig-' || event_id AS signature, source_seq % 7 <> 0 AS success, CASE WHEN source_seq % 5 <> 0 THEN source_seq * 10 ELSE 0 END AS fee FROM tx",
            _ARCHIVE,
        ),
        "rpc_fetch": q(
            "SELECT slot, slot - 1 AS parent_slot, CAST(k AS INTEGER) AS index, 'sig-' || slot || '-' || k AS signature, k = 2 OR (slot + k) % 5 <> 0 AS success, CASE WHEN k = 2 THEN 0 ELSE slot * 10 + k END AS fee "
            "FROM (SELECT slot, unnest(range(0, slot % 4)) AS k FROM (SELECT DISTINCT slot FROM base) WHERE slot % 7 <> 0)"
        ),
        # writes
        "events_upsert": q("SELECT slot, source_seq, seq, CASE WHEN source_seq % 10 = 0 THEN 'again-' || source_seq ELSE props END AS data, is_valid OR source_seq % 10 = 0 AS is_valid FROM cur"),
        "upsert_outcome": q("SELECT 'inserted' AS outcome, count(*) AS rows FROM ev UNION ALL SELECT 'updated', count(*) FROM ev WHERE source_seq % 10 = 0"),
        "redelivery_revives": q("SELECT slot, source_seq, is_valid OR slot % 2 = 0 AS is_valid, is_valid OR slot % 2 = 0 AS no_time FROM cur"),
        "slots_current": q("SELECT s.slot, s.parent_slot, CASE WHEN l.slot IS NULL THEN 'Processing' ELSE 'Orphaned' END AS status, l.slot IS NULL AS is_canonical, s.us AS received_at_us FROM sl s LEFT JOIN lost l USING (slot)"),
        "cursor_current": q("SELECT * FROM cursors", _CURSORS),
        "cursor_list": q("SELECT name, slot, source_seq FROM cursors ORDER BY name", _CURSORS),
        "batch_watermark": q("SELECT max(slot) AS slot, max(seq) AS seq, max(source_seq) AS source_seq FROM ev"),
        "metrics_snapshot": q(
            "SELECT 'ingest_emitted' AS metric, count(*) AS value FROM ev UNION ALL SELECT 'ingest_bytes', CAST(sum(strlen(props)) AS BIGINT) FROM ev UNION ALL SELECT 'processor_reorgs', count(*) FROM forks UNION ALL SELECT 'processor_slots_rolled_back', CAST(sum(depth) AS BIGINT) FROM forks"
        ),
        # reads
        "events_list": q(_page("true")),
        "events_by_slot": q(_page(f"slot = {P['slot']}")),
        "events_slot_range": q(_page(f"slot BETWEEN {P['from_slot']} AND {P['to_slot']}", limit=1000)),
        "events_seq_range": q(_page(f"seq BETWEEN {P['from_seq']} AND {P['to_seq']}", limit=1000)),
        "events_by_kind": q(_page(f"kind = '{P['kind']}'", limit=50, offset=20)),
        "events_by_signature": q(_page(f"'sig-' || event_id = '{P['signature']}'", _JSON, 1000)),
        "events_by_account": q(_page(f"'acct-' || user_id = '{P['account']}'", _JSON)),
        "events_valid": q("SELECT slot, source_seq, seq, kind, is_valid, lost_us AS invalidated_at_us FROM cur"),
        "slot_lookup": q(f"SELECT slot, parent_slot, CASE WHEN slot IN (SELECT slot FROM lost) THEN 'Orphaned' ELSE 'Processing' END AS status, slot NOT IN (SELECT slot FROM lost) AS is_canonical FROM sl WHERE slot = {P['lookup']}"),
        "canonical_slots": q("SELECT slot, parent_slot FROM sl WHERE slot NOT IN (SELECT slot FROM lost) ORDER BY slot"),
        "chain_head": q("SELECT max(slot) AS head FROM sl WHERE slot NOT IN (SELECT slot FROM lost)"),
        "event_counts": q("SELECT count(*) FILTER (is_valid) AS valid, count(*) FILTER (NOT is_valid) AS invalid, max(seq) FILTER (is_valid) AS max_seq, max(slot) FILTER (is_valid) AS max_slot, min(slot) AS min_slot FROM cur"),
        "status": q("SELECT count(*) FILTER (is_valid) AS valid, count(*) FILTER (NOT is_valid) AS invalid, max(seq) FILTER (is_valid) AS max_seq, max(slot) FILTER (is_valid) AS max_slot, min(slot) AS min_slot, max(slot) FILTER (is_valid) AS head FROM cur"),
        "resume_state": q(
            "SELECT c.slot AS cursor_slot, c.source_seq AS cursor_source_seq, (SELECT max(seq) FROM ev) AS max_seq, (SELECT count(*) FROM sl WHERE slot NOT IN (SELECT slot FROM lost)) AS canonical, CAST((SELECT sum(parent_slot) FROM sl WHERE slot NOT IN (SELECT slot FROM lost)) AS BIGINT) AS parents FROM cursors c WHERE name = 'odd'",
            _CURSORS,
        ),
        "reorg_history": q(
            f"SELECT slot AS fork_slot, parent_slot, parent_slot AS divergence_point, CAST(depth AS INTEGER) AS depth, {count('ev.slot > forks.parent_slot AND ev.slot < forks.slot')} AS events_invalidated, {_text('list_reverse(range(parent_slot + 1, slot))')} AS slots_rolled_back, false AS divergence_is_bound FROM forks ORDER BY us DESC, arrival DESC LIMIT {P['history']}"
        ),
        "reorg_audit": q(
            f"""SELECT slot AS fork_slot, slot - 1 AS old_head, parent_slot, parent_slot AS divergence_point, CAST(depth AS INTEGER) AS depth, {_text('list_reverse(range(parent_slot + 1, slot))')} AS slots_rolled_back, '' AS slots_restored, false AS divergence_is_bound,
  {count('ev.slot > forks.parent_slot AND ev.slot < forks.slot')} AS events_invalidated, 0 AS events_restored FROM forks
UNION ALL SELECT slot, slot - 1, slot - 3, slot - 3, 2, (slot - 1) || ',' || (slot - 2), '', false, {count('ev.slot IN (sl.slot - 1, sl.slot - 2)')}, 0 FROM sl WHERE slot % 50 = 25
UNION ALL SELECT slot, slot - 1, slot - 2, slot - 4, 1, '' || (slot - 1), (slot - 3) || ',' || (slot - 2), false, {count('ev.slot = sl.slot - 1')}, {count('ev.slot IN (sl.slot - 2, sl.slot - 3)')} FROM sl WHERE slot % 50 = 26"""
        ),
        "rollback_dry_run": q(f"SELECT count(*) AS events FROM cur WHERE is_valid AND slot IN {slots(P['dry_run'])}"),
        "purge_invalid": q(f"SELECT is_valid, count(*) AS rows, min(slot) AS min_slot FROM cur WHERE is_valid OR slot >= {P['purge_below']} GROUP BY is_valid"),
        "distinct_valid_slots": q("SELECT DISTINCT slot FROM cur WHERE is_valid"),
        # chain
        "chain_updates": q("SELECT CASE WHEN slot = 1 THEN 'initialised' WHEN slot % 50 = 0 THEN 'reorg' ELSE 'extended' END AS outcome, count(*) AS runs FROM sl GROUP BY 1"),
        "head_timeline": q("SELECT slot, CASE WHEN slot > 1 THEN slot - 1 END AS head_before, slot AS head_after FROM sl"),
        "ancestor_walk": q("SELECT slot AS fork_slot, slot - 4 AS divergence_point, (slot - 3) || ',' || (slot - 2) AS slots_restored FROM sl WHERE slot % 50 = 26"),
        "orphan_ranges": q("SELECT slot, parent_slot FROM sl WHERE slot IN (SELECT slot FROM lost)"),
        "rollback_apply": q("SELECT slot, source_seq, is_valid, lost_us AS invalidated_at_us FROM cur WHERE NOT is_valid"),
        "rollback_restore": q("SELECT slot, source_seq, true AS is_valid, true AS no_time FROM ev WHERE slot % 50 IN (23, 24) AND slot // 50 * 50 + 26 <= (SELECT max(slot) FROM ev)"),
        "gap_joins": q("SELECT slot, parent_slot, parent_slot AS divergence, true AS is_bound FROM sl WHERE slot % 50 = 12"),
        "late_slots": q("SELECT slot, source_seq, true AS is_valid FROM ev WHERE slot BETWEEN 5 AND 15"),
        "rooted_refusals": q(f"SELECT slot, parent_slot, {_text('list_reverse(range(parent_slot + 1, slot))')} AS orphaned FROM forks WHERE depth >= 3"),
        "depth_refusals": q("SELECT slot, parent_slot, CAST(depth AS INTEGER) AS depth, CAST(0 AS BIGINT) AS written FROM forks WHERE depth > 3"),
        "canonical_replay": q("SELECT slot, source_seq, kind FROM cur WHERE is_valid"),
        "chain_stats": q("SELECT count(*) AS divergences, CAST(coalesce(sum(depth), 0) AS BIGINT) AS slots_orphaned, CAST(max(depth) AS INTEGER) AS max_depth FROM (SELECT depth FROM forks UNION ALL SELECT 0 FROM sl WHERE slot % 50 = 12)"),
        "processor_stats": q(
            "SELECT count(*) FILTER (event_id % 97 <> 0) AS processed, count(*) FILTER (event_id % 97 = 0) AS dead_letters, (SELECT count(*) FROM forks) AS reorgs, (SELECT count(*) FROM sl WHERE slot % 50 = 12) AS gap_joins, CAST((SELECT sum(depth) FROM forks) AS BIGINT) AS slots_rolled_back FROM ev WHERE slot % 50 <> 11"
        ),
        "persister_stats": q("SELECT (SELECT count(*) FROM ev) AS events_written, (SELECT count(*) FROM sl) AS slots_written, (SELECT count(*) FROM forks) AS rollbacks, (SELECT count(*) FROM cur WHERE NOT is_valid) AS events_invalidated"),
        "rollback_depth_hist": q("SELECT CAST(depth AS INTEGER) AS depth, count(*) AS reorgs FROM forks GROUP BY 1"),
        "events_per_kind": q("SELECT kind, count(*) AS events FROM ev GROUP BY kind"),
        "pipeline_end_state": q("SELECT kind, is_valid, count(*) AS rows, CAST(sum(seq) AS BIGINT) AS seqs, CAST(sum(slot) AS BIGINT) AS slots FROM cur GROUP BY 1, 2"),
        # checks
        "check_duplicates": q("SELECT slot, source_seq, CAST(2 AS BIGINT) AS n FROM ev WHERE source_seq % 250 = 0"),
        "check_missing_slots": q("SELECT slot, series FROM (SELECT slot, 'chain' AS series FROM whole UNION ALL SELECT slot, 'straight' AS series FROM straight) e WHERE NOT EXISTS (SELECT 1 FROM cur WHERE is_valid AND cur.slot = e.slot)", _EXPECTED),
        "check_extra_slots": q("SELECT slot FROM sl WHERE slot NOT IN (SELECT slot FROM lost) AND slot NOT IN (SELECT slot FROM whole)", _EXPECTED),
        # sequences
        "sequence_classify": q("SELECT arrival, source_seq, seen, outcome, CASE WHEN outcome = 'gap' THEN seen + 1 END AS gap_start, CASE WHEN outcome = 'gap' THEN source_seq - 1 END AS gap_end FROM cls", _NOISY),
        "sequence_gaps": q("SELECT gap_start, gap_end, gap_end - gap_start + 1 AS missing FROM gaps", _GAPS),
        "gap_expand": q("SELECT unnest(range(gap_start, gap_end + 1)) AS source_seq FROM gaps", _GAPS),
        "gaps_after_fill": q(f"SELECT gap_start, gap_end, gap_end - gap_start + 1 AS missing FROM gaps WHERE NOT (gap_start >= {P['filled'][0]} AND gap_end <= {P['filled'][1]})", _GAPS),
        "sequence_stats": q(
            "SELECT count(*) FILTER (outcome IN ('processed', 'gap')) AS processed, count(*) FILTER (outcome = 'duplicate') AS duplicates, count(*) FILTER (outcome = 'regression') AS regressions, count(*) FILTER (outcome = 'gap') AS gaps, CAST(coalesce(sum(source_seq - seen - 1) FILTER (outcome = 'gap'), 0) AS BIGINT) AS missing, max(source_seq) AS last_sequence FROM cls",
            _NOISY,
        ),
        "ingest_accept": q(f"SELECT arrival, source_seq, slot FROM seen WHERE source_seq > greatest(coalesce(seen, 0), {P['last_seen']})", _NOISY),
        "ingest_stats": q(
            "SELECT count(*) AS received, count(*) FILTER (outcome IN ('processed', 'gap')) AS emitted, count(*) FILTER (outcome NOT IN ('processed', 'gap')) AS duplicates, CAST(sum(strlen(props)) AS BIGINT) AS bytes, count(*) FILTER (outcome = 'gap') AS gaps, max(source_seq) AS last_sequence FROM cls",
            _NOISY,
        ),
        "assign_seq": q(f"SELECT source_seq, seq + {P['first_seq'] - 1} AS seq FROM ev"),
        "buffer_gauges": q("SELECT source_seq // 16 AS tick, count(*) AS received, least(count(*), 10) AS depth, greatest(count(*) - 10, 0) AS dropped FROM ev GROUP BY 1"),
        "shed_model": q("SELECT source_seq, row_number() OVER (PARTITION BY source_seq // 16 ORDER BY source_seq) <= 10 AS kept FROM ev"),
        # scalars
        "events_hash": q(f"SELECT slot, source_seq, {_hash('props')} AS event_hash FROM ev"),
        "parse_envelope": q("SELECT source_seq, kind, slot, parent_slot, CAST(props::JSON ->> '$.k' AS BIGINT) AS k FROM ev"),
        "base58_roundtrip": q("SELECT source_seq, true AS key_ok, true AS signature_ok, true AS refused FROM ev"),
        "account_data_size": q("SELECT source_seq, CASE source_seq % 3 WHEN 0 THEN strlen(props) WHEN 1 THEN strlen(props) * 3 // 4 ELSE 1000 END AS size FROM ev"),
        "error_classify": f"SELECT error, category, is_retryable, should_dlq, is_fatal, is_duplicate FROM {_ERRORS}",
        "backfill_sequence": q("SELECT source_seq, slot * 1048576 + source_seq % 4 AS sequence, 9223372036854775807 AS saturated FROM ev"),
        "sequence_scalar": q("SELECT source_seq, source_seq + 1 AS next, CASE WHEN source_seq > 1 THEN source_seq - 2 END AS prev, CASE WHEN slot * 4 + source_seq % 7 - 3 >= source_seq THEN slot * 4 + source_seq % 7 - 3 - source_seq END AS gap FROM ev"),
        "kind_priority": q("SELECT kind, count(*) AS events, CAST(CASE kind WHEN 'SlotUpdate' THEN 0 WHEN 'BlockMeta' THEN 1 WHEN 'Entry' THEN 2 WHEN 'Transaction' THEN 3 ELSE 4 END AS INTEGER) AS priority FROM ev GROUP BY kind"),
        "slot_status_flags": q("SELECT slot, CASE WHEN gone THEN 'Orphaned' ELSE 'Processing' END AS status, NOT gone AS is_revocable, gone AS is_final FROM (SELECT slot, slot IN (SELECT slot FROM lost) AS gone FROM sl)"),
        "redact_url": q("SELECT DISTINCT user_id, CASE user_id % 3 WHEN 0 THEN 'postgres://***@host/' WHEN 1 THEN 'postgres://host/' ELSE 'mailto@host/' END || user_id AS shown FROM ev"),
        "handler_pipeline": q(
            "SELECT source_seq, slot, kind, CASE WHEN refused THEN NULL ELSE seq END AS seq, CASE WHEN refused THEN NULL ELSE is_valid END AS is_valid, CASE WHEN refused THEN 'validation' END AS error_category FROM (SELECT *, kind = 'Transaction' AND coalesce(CAST(props::JSON ->> '$.k' AS BIGINT) % 2, 1) <> 0 AS refused FROM cur)"
        ),
        "handler_validate": q("SELECT source_seq, CASE WHEN kind = 'Transaction' AND CAST(props::JSON ->> '$.k' AS BIGINT) % 2 = 1 THEN 'even' END AS rejected_by FROM ev"),
        # dead letters
        "dlq_rejects": q("SELECT source_seq, slot, parent_slot, kind, CASE WHEN event_id % 97 = 0 THEN 'malformed' END AS error_category, CASE WHEN event_id % 97 = 0 THEN CAST(0 AS INTEGER) END AS retry_count, CASE WHEN event_id % 97 = 0 THEN '{ bad' ELSE props END AS payload FROM ev"),
        "letters_store": q(
            f"SELECT source_seq AS sequence, slot, CASE WHEN slot IN {slots(P['dlq_slots'][3:])} THEN 'Resolved' ELSE 'Pending' END AS status, slot NOT IN {slots(P['dlq_slots'][3:])} AS can_retry, "
            f"CASE WHEN slot IN {slots(P['dlq_slots'][3:])} THEN {P['now_s']}000000 END AS resolved_at_us FROM ev WHERE event_id % 97 = 0 AND slot NOT IN {slots(P['dlq_slots'][:3])}"
        ),
        "api_responses": q(
            "SELECT request, CAST(code AS INTEGER) AS code, CAST(value AS BIGINT) AS value, CASE WHEN code = 500 THEN 'internal error' END AS shown FROM ("
            "SELECT 'commits' AS request, 2 AS code, 2 AS value UNION ALL SELECT unnest(['health/live', 'health/ready']), 200, NULL UNION ALL SELECT 'metrics', 503, NULL "
            "UNION ALL SELECT 'v1/status', 200, count(*) FILTER (is_valid) FROM cur UNION ALL SELECT 'v1/chain/head', 200, max(slot) FILTER (is_valid) FROM cur "
            f"UNION ALL SELECT 'v1/events/kind={P['kind']}/limit=1000', 200, least(1000, count(*)) FROM cur WHERE is_valid AND kind = '{P['kind']}' UNION ALL SELECT 'v1/events/kind=Nope', 400, NULL "
            f"UNION ALL SELECT 'v1/events/slot/{P['slot']}', 200, count(*) FROM cur WHERE is_valid AND slot = {P['slot']} UNION ALL SELECT 'v1/events/slot/x', 400, NULL "
            f"UNION ALL SELECT 'v1/slots/{P['lookup']}', 200, slot FROM sl WHERE slot = {P['lookup']} UNION ALL SELECT unnest(['v1/slots/999999999999', 'v1/nowhere']), 404, NULL UNION ALL SELECT 'v1/events/limit=1', 500, NULL)"
        ),
        "dlq_state": q(
            "SELECT source_seq AS sequence, slot, true AS kind_known, CAST(retry_count AS INTEGER) AS retry_count, CASE WHEN is_resolved THEN 'Resolved' WHEN retry_count >= 3 THEN 'Exhausted' ELSE 'Pending' END AS status, NOT is_resolved AND retry_count < 3 AS can_retry, CASE WHEN is_resolved THEN us + 3600000000 END AS resolved_at_us FROM dl",
            _TRIED,
        ),
        "dlq_unresolved": q("SELECT source_seq AS sequence, slot, CAST(retry_count AS INTEGER) AS retry_count FROM dl WHERE NOT is_resolved", _TRIED),
        "dlq_by_category": q("SELECT source_seq AS sequence, slot FROM dl WHERE NOT is_resolved", _TRIED),
        "dlq_by_slots": q(f"SELECT source_seq AS sequence, slot FROM dl WHERE NOT is_resolved AND slot IN {slots(P['dlq_slots'])}", _TRIED),
        "dlq_by_category_counts": q("SELECT 'malformed' AS error_category, count(*) AS entries, count(*) FILTER (NOT is_resolved) AS unresolved FROM dl", _TRIED),
        "dlq_age": q(f"SELECT source_seq AS sequence, {P['now_s']}000000 - us AS age_us FROM dl", _TRIED),
        "dlq_purge": q(f"SELECT source_seq AS sequence, is_resolved FROM dl WHERE NOT (is_resolved AND us + 3600000000 < {P['now_s']}000000 - {P['purge_days']} * 86400000000)", _TRIED),
        "dlq_replay": q("SELECT source_seq AS sequence, CAST(1 AS INTEGER) AS retry_count, true AS is_resolved FROM dl WHERE slot % 4 = 2 UNION ALL SELECT source_seq, 0, false FROM dl WHERE slot % 4 = 2", _TRIED),
        "replay_summary": q("SELECT count(*) AS attempted, count(*) FILTER (is_resolved) AS succeeded, count(*) FILTER (NOT is_resolved) AS failed, count(*) FILTER (is_resolved) / count(*) AS success_rate FROM dl", _TRIED),
        # backfill
        "backfill_candidates": q("SELECT slot, CAST(count(*) AS INTEGER) AS transactions FROM tx WHERE slot % 10 = 3 GROUP BY slot", _ARCHIVE),
        "backfill_events": q(
            f"SELECT row_number() OVER (ORDER BY slot, idx) + {P['first_arrival'] - 1} AS arrival, slot * 1048576 + idx AS source_seq, 'backfill' AS origin, slot, slot - 1 AS parent_slot, 'sig-' || event_id AS signature, CASE WHEN source_seq % 5 <> 0 THEN source_seq * 10 ELSE 0 END AS fee, CAST(props::JSON ->> '$.k' AS BIGINT) AS k FROM tx WHERE slot % 10 = 3",
            _ARCHIVE,
        ),
        "gap_to_slots": q("SELECT greatest(gap_end // 4 + 1 - least(gap_end - gap_start + 1, 1000), 0) AS start_slot, gap_end // 4 + 1 AS end_slot, CAST(1 AS INTEGER) AS priority, true AS is_gap_fill FROM gaps", _GAPS),
        "backfill_queue": q(
            "SELECT start_slot, end_slot, CAST(priority AS INTEGER) AS priority, is_gap_fill, end_slot - start_slot + 1 AS slots FROM (SELECT greatest(gap_end // 4 + 1 - least(gap_end - gap_start + 1, 1000), 0) AS start_slot, gap_end // 4 + 1 AS end_slot, 1 AS priority, true AS is_gap_fill FROM gaps UNION ALL SELECT 1, 500, 10, false UNION ALL SELECT 600, 700, 10, false)",
            _GAPS,
        ),
        "backfill_progress": q("SELECT kind, least(1.0::DOUBLE, greatest(0.0::DOUBLE, max(slot) / 2000::DOUBLE)) AS progress FROM ev GROUP BY kind"),
    }
