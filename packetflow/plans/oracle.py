"""The same queries in the SQL of DuckDB, written independently of the Spark operators."""

from __future__ import annotations

from packetflow.plans import fixtures as fx

# --- shared tables -------------------------------------------------------------------------------

TTL_MS = 604_800_000

PROTOCOL = """CASE upper(trim({0}))
    WHEN 'HTTPS' THEN 'HTTPS' WHEN 'TLS' THEN 'HTTPS' WHEN 'SSL' THEN 'HTTPS'
    WHEN 'TCP' THEN 'TCP' WHEN 'UDP' THEN 'UDP' WHEN 'ARP' THEN 'ARP' ELSE 'OTHER' END"""

DERIVED = {
    "seen_markers": (
        ["all_markers"],
        "SELECT transaction_id, marked_at_ms FROM all_markers WHERE seen",
    ),
    "docs": (
        ["cdc_feed"],
        """SELECT *, CASE WHEN json_valid(value) THEN
             CASE WHEN json_type(value) = 'OBJECT' THEN value END END AS doc FROM cdc_feed""",
    ),
    "parsed": (
        ["docs"],
        """SELECT arrival_seq, arrival_ms, doc,
             CASE WHEN value IS NULL OR trim(value) = '' THEN 'tombstone'
                  WHEN doc IS NULL THEN 'malformed'
                  WHEN doc ->> '$.__op' = 'd' THEN 'delete'
                  WHEN coalesce(trim(doc ->> '$.transaction_id'), '') = '' THEN 'no_key'
             END AS skip_reason,
             doc ->> '$.transaction_id' AS transaction_id,
             coalesce(doc ->> '$.client_id', '') AS client_id,
             coalesce(CAST(doc ->> '$.version' AS BIGINT), 0) AS version,
             coalesce(doc ->> '$.proto', 'OTHER') AS proto,
             coalesce(doc ->> '$.source_ip', '') AS source_ip,
             coalesce(doc ->> '$.dest_ip', '') AS dest_ip,
             coalesce(CAST(doc ->> '$.source_port' AS INT), 0) AS source_port,
             coalesce(CAST(doc ->> '$.dest_port' AS INT), 0) AS dest_port,
             CASE WHEN json_type(doc, '$.storedAt') IN ('UBIGINT', 'BIGINT')
                    THEN CAST(doc ->> '$.storedAt' AS BIGINT)
                  WHEN json_type(doc, '$.storedAt') = 'VARCHAR'
                    THEN epoch_us(try_cast(doc ->> '$.storedAt' AS TIMESTAMP)) // 1000
             END AS stored_at_ms
           FROM docs""",
    ),
    "recs": (["parsed"], "SELECT * FROM parsed WHERE skip_reason IS NULL"),
    "ledger": (
        ["recs"],
        """SELECT * FROM recs QUALIFY
             row_number() OVER (PARTITION BY transaction_id ORDER BY arrival_seq) = 1""",
    ),
    "staged": (
        ["recs"],
        f"SELECT *, {fx.STAGE} AS stage, {fx.STAGE_CLOCK} AS clock FROM recs",
    ),
    "firsts": (
        ["staged"],
        """SELECT * FROM staged QUALIFY row_number() OVER
             (PARTITION BY stage, transaction_id ORDER BY arrival_seq) = 1""",
    ),
    "past0": (["firsts"], "SELECT * FROM firsts WHERE stage = 0"),
    "past1": (
        ["firsts", "past0"],
        """SELECT * FROM firsts WHERE stage = 1
             AND transaction_id NOT IN (SELECT transaction_id FROM past0)""",
    ),
    "past2": (
        ["firsts", "past1"],
        """SELECT * FROM firsts WHERE stage = 2
             AND transaction_id NOT IN (SELECT transaction_id FROM past1)""",
    ),
    "past": (
        ["past0", "past1", "past2"],
        "SELECT * FROM past0 UNION ALL SELECT * FROM past1 UNION ALL SELECT * FROM past2",
    ),
    "stored": (
        ["past"],
        """SELECT * FROM past QUALIFY
             row_number() OVER (PARTITION BY transaction_id ORDER BY stage) = 1""",
    ),
    "stored_state": (
        ["past"],
        """SELECT client_id, version, proto AS last_proto, arrival_ms AS updated_at_ms FROM past
           QUALIFY row_number() OVER
             (PARTITION BY client_id ORDER BY version DESC, stage, arrival_seq) = 1""",
    ),
    "stored_stats": (
        ["stored"],
        """SELECT proto, count(*) AS packet_count, min(stored_at_ms) AS first_seen_ms,
             max(stored_at_ms) AS last_seen_ms FROM stored GROUP BY proto""",
    ),
    "ticking": (
        ["outbox_table"],
        f"""SELECT * EXCLUDE (topic), {fx.BLANK_TOPIC} AS topic FROM outbox_table""",
    ),
    "tick0": (
        ["ticking"],
        f"""SELECT id FROM ticking WHERE is_processed = 0 AND is_sequential = 0
             AND trim(topic) <> '' AND (is_processing = 0 OR expired_at_ms <= {fx.NOW_MS})
           ORDER BY date_timestamp_ms, id LIMIT 100""",
    ),
    "tick1": (
        ["ticking", "tick0"],
        f"""SELECT id FROM ticking WHERE is_processed = 0 AND is_sequential = 0
             AND trim(topic) <> '' AND (is_processing = 0 OR expired_at_ms <= {fx.NOW_MS + 1000})
             AND id NOT IN (SELECT id FROM tick0)
           ORDER BY date_timestamp_ms, id LIMIT 100""",
    ),
    "tick2": (
        ["ticking", "tick0", "tick1"],
        f"""SELECT id FROM ticking WHERE is_processed = 0 AND is_sequential = 0
             AND trim(topic) <> '' AND (is_processing = 0 OR expired_at_ms <= {fx.NOW_MS + 30000}
               OR id IN (SELECT id FROM tick1))
             AND id NOT IN (SELECT id FROM tick0)
           ORDER BY date_timestamp_ms, id LIMIT 100""",
    ),
    **{
        f"workers{tick}": (
            ["outbox_table", *[f"workers{n}" for n in range(tick)]],
            f"""SELECT id, worker, {tick} AS tick FROM (
                  SELECT *, CAST('0x' || substr(md5(id), 1, 8) AS BIGINT) % 4 AS worker
                  FROM outbox_table)
                WHERE is_processed = 0 AND is_sequential = 0
                  AND (is_processing = 0 OR expired_at_ms <= {fx.NOW_MS + 1000 * tick})
                """
            + ("" if tick else f"AND NOT {fx.ADDED_LATER} ")
            + "".join(f"AND id NOT IN (SELECT id FROM workers{n}) " for n in range(tick))
            + """QUALIFY row_number() OVER
                   (PARTITION BY worker ORDER BY date_timestamp_ms, id) <= 40""",
        )
        for tick in range(3)
    },
    "known": (
        ["recs"],
        f"SELECT DISTINCT transaction_id FROM recs WHERE arrival_ms <= {fx.NOW_MS}",
    ),
    "live": (
        ["seen_markers"],
        f"SELECT transaction_id FROM seen_markers WHERE marked_at_ms + {TTL_MS} > {fx.NOW_MS}",
    ),
    "fresh": (
        ["ledger", "live"],
        """SELECT * FROM ledger
           WHERE transaction_id NOT IN (SELECT transaction_id FROM live)""",
    ),
    "state_store": (
        ["recs"],
        """SELECT client_id, version, proto AS last_proto, arrival_ms AS updated_at_ms FROM recs
           QUALIFY row_number() OVER
             (PARTITION BY client_id ORDER BY version DESC, arrival_seq) = 1""",
    ),
    "state_fastpath": (
        ["ledger"],
        """SELECT client_id, version, proto AS last_proto, arrival_ms AS updated_at_ms FROM ledger
           QUALIFY row_number() OVER
             (PARTITION BY client_id ORDER BY version DESC, arrival_seq) = 1""",
    ),
    "proto_stats": (
        ["ledger"],
        """SELECT proto, count(*) AS packet_count, min(stored_at_ms) AS first_seen_ms,
             max(stored_at_ms) AS last_seen_ms FROM ledger GROUP BY proto""",
    ),
    "eligible": (
        ["outbox_table"],
        f"""SELECT * FROM outbox_table WHERE is_processed = 0 AND is_sequential = 0
            AND (is_processing = 0 OR expired_at_ms <= {fx.NOW_MS})""",
    ),
    "claims": (["eligible"], "SELECT * FROM eligible ORDER BY date_timestamp_ms, id LIMIT 100"),
    "worker_claims": (
        ["eligible"],
        f"""SELECT id, date_timestamp_ms, 1 AS is_processing,
              CAST({fx.NOW_MS} AS BIGINT) AS reserved_at_ms,
              CAST({fx.NOW_MS + 20000} AS BIGINT) AS expired_at_ms, worker, claim_rank
            FROM (SELECT *, CAST(row_number() OVER
                    (PARTITION BY worker ORDER BY date_timestamp_ms, id) AS INT) AS claim_rank
                  FROM (SELECT *, CAST('0x' || substr(md5(id), 1, 8) AS BIGINT) % 4 AS worker
                        FROM eligible))
            WHERE claim_rank <= 40""",
    ),
    "published": (
        ["outbox_table"],
        """SELECT id, topic, coalesce(partition_by, 'no-key') AS key,
             CAST(json_object('Topic', topic, 'Key', partition_by, 'Payload', raw_data,
               'PayloadType', message_type, 'Metadata', CAST(metadata AS JSON),
               'Created', strftime(make_timestamp(date_timestamp_ms * 1000),
                 '%Y-%m-%dT%H:%M:%S.%gZ')) AS VARCHAR) AS value,
             CASE WHEN trim(topic) = '' THEN 'blank topic' END AS error,
             is_processed, is_sequential
           FROM outbox_table""",
    ),
    "snapshots": (
        ["packet_request"],
        """SELECT sha256('ingest|' || event_id) AS transaction_id,
             CASE WHEN trim(source_ip) = '' THEN 'unknown' ELSE source_ip END AS client_id,
             ts_ms AS version, source_port, dest_port, source_ip, dest_ip, source_mac, dest_mac,
             proto
           FROM packet_request""",
    ),
    "envelopes": (
        ["topic_messages"],
        """SELECT *, CASE WHEN json_valid(value) THEN
             CASE WHEN json_type(value) = 'OBJECT' THEN value END END AS env
           FROM topic_messages""",
    ),
    "bodies": (
        ["envelopes"],
        """SELECT *, CASE WHEN json_valid(body) THEN
             CASE WHEN json_type(body) = 'OBJECT' THEN body END END AS snap
           FROM (SELECT * EXCLUDE (payload), env ->> '$.Payload' AS body FROM envelopes)""",
    ),
    "routed": (
        ["bodies"],
        f"""SELECT *, {PROTOCOL.format("snap ->> '$.proto'")} AS shard,
              coalesce(try_cast(attempts_header AS INT), 0) AS attempts,
              CASE WHEN env IS NULL THEN 'malformed_envelope'
                   WHEN coalesce(trim(body), '') = '' THEN 'empty_payload'
                   WHEN snap IS NULL THEN 'malformed_payload'
                   WHEN {PROTOCOL.format("snap ->> '$.proto'")} = 'ARP' THEN 'shard_down'
                   ELSE 'stored' END AS reason
            FROM bodies""",
    ),
    "verdicts": (
        ["routed"],
        """SELECT *, CASE WHEN reason IN ('empty_payload', 'stored') THEN 'settled'
             ELSE 'rejected' END AS verdict FROM routed""",
    ),
    "shard_docs": (
        ["verdicts"],
        """SELECT msg_offset,
             CASE WHEN trim(snap ->> '$.transaction_id') = ''
               THEN sha256(topic || '|' || msg_partition || '|' || msg_offset || '|0')
               ELSE snap ->> '$.transaction_id' END AS transaction_id,
             CASE WHEN trim(snap ->> '$.client_id') = '' THEN snap ->> '$.source_ip'
               ELSE snap ->> '$.client_id' END AS client_id,
             CAST(snap ->> '$.version' AS BIGINT) AS version,
             CAST(snap ->> '$.source_port' AS INT) AS source_port,
             CAST(snap ->> '$.dest_port' AS INT) AS dest_port,
             snap ->> '$.source_ip' AS source_ip, snap ->> '$.dest_ip' AS dest_ip,
             snap ->> '$.source_mac' AS source_mac, snap ->> '$.dest_mac' AS dest_mac,
             snap ->> '$.proto' AS proto,
             sha256('packet|' || topic || '|' || msg_partition || '|' || msg_offset || '|0')
               AS packet_id,
             msg_ts_ms AS stored_at_ms, shard, api_key
           FROM verdicts WHERE reason = 'stored'""",
    ),
    "change_events": (
        ["shard_docs"],
        """SELECT 'pcap.' || lower(shard) || '.pcap.packets' AS topic, shard,
             CAST(json_object('__op', 'c', 'packetId', packet_id,
               'transaction_id', transaction_id, 'client_id', client_id, 'version', version,
               'source_port', source_port, 'dest_port', dest_port, 'source_ip', source_ip,
               'dest_ip', dest_ip, 'source_mac', source_mac, 'dest_mac', dest_mac,
               'proto', proto, 'storedAt', stored_at_ms) AS VARCHAR) AS value
           FROM shard_docs""",
    ),
    "hashed": (
        ["topic_messages"],
        "SELECT msg_offset, sha256(api_key || chr(10)) AS api_key_hash FROM topic_messages",
    ),
    "valid": (
        [],
        """SELECT sha256(k || chr(10)) AS api_key_hash
           FROM (VALUES ('valid_api_key_1'), ('valid_api_key_2')) v(k)""",
    ),
    "callers": (
        ["calls"],
        """SELECT call_id, ts_ms, coalesce(subject, user_name, remote_ip, 'anonymous') AS caller,
             ts_ms - ts_ms % 21600000 AS window_start_ms FROM calls""",
    ),
}


def with_tables(sql: str, *names: str) -> str:
    """``sql`` preceded by the tables it names and those they are made from."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for needed in DERIVED[name][0] if name in DERIVED else ():
            visit(needed)
        order.append(name)

    for name in names:
        visit(name)
    parts: list[str] = []
    for name in order:
        if name in DERIVED:
            parts.append(f"{name} AS ({DERIVED[name][1]})")
        else:
            parts.extend(fx.ctes(name))
    return f"WITH {', '.join(parts)} {sql}"


# --- queries -------------------------------------------------------------------------------------

RECORD = (
    "arrival_seq, transaction_id, client_id, version, proto, source_ip, dest_ip, source_port, "
    "dest_port, stored_at_ms"
)
SNAPSHOT = (
    "transaction_id, client_id, version, source_port, dest_port, source_ip, dest_ip, source_mac, "
    "dest_mac, proto"
)
STATE = "client_id, version, last_proto, updated_at_ms"
STATS = "proto, packet_count, first_seen_ms, last_seen_ms"
CLAIM = "id, date_timestamp_ms, is_processing, reserved_at_ms, expired_at_ms"
CLAIMED = (
    f"id, date_timestamp_ms, 1 AS is_processing, CAST({fx.NOW_MS} AS BIGINT) AS reserved_at_ms, "
    f"CAST({fx.NOW_MS + 20000} AS BIGINT) AS expired_at_ms"
)
SLOT = "CAST('0x' || substr(md5(key), 1, 8) AS BIGINT) % 5"
LITTLE_ENDIAN = " || ".join(f"printf('%02x', (ms >> {8 * i}) & 255)" for i in range(8))
BLANKS = r"^[\s\v\x{0085}\p{Z}]+|[\s\v\x{0085}\p{Z}]+$"
ENVELOPE = """SELECT msg_offset, CAST(env IS NOT NULL AS INT) AS well_formed,
    env ->> '$.Topic' AS envelope_topic, env ->> '$.Key' AS envelope_key,
    env ->> '$.Payload' AS payload, env ->> '$.PayloadType' AS payload_type,
    env ->> '$.Metadata.origin' AS origin,
    epoch_us(CAST(replace(env ->> '$.Created', 'Z', '') AS TIMESTAMP)) // 1000 AS created_ms
    FROM envelopes"""
RESENT = """msg_offset, '{topic}' AS topic, msg_key AS key, value,
    attempts + 1 AS attempts, attempts + 1 AS attempts_header, {reason} AS failure_reason
    FROM verdicts WHERE verdict = 'rejected'"""

ORACLE: dict[str, str] = {
    "ingest_snapshot": with_tables(f"SELECT {SNAPSHOT} FROM snapshots", "snapshots"),
    "ingest_accepted": with_tables(
        "SELECT source_ip, count(*) AS accepted FROM packet_request GROUP BY source_ip",
        "packet_request",
    ),
    "batch_numbers": with_tables(
        """SELECT source_ip, event_id, (row_number() OVER
             (PARTITION BY source_ip ORDER BY event_id) - 1) // 10 AS batch_no
           FROM packet_request""",
        "packet_request",
    ),
    "outbox_append": with_tables(
        f"""SELECT sha256('outbox|' || transaction_id) AS id, version AS date_timestamp_ms,
              CAST(json_object({", ".join(f"'{c}', {c}" for c in SNAPSHOT.split(", "))})
                AS VARCHAR) AS raw_data,
              'SnapshotMessage' AS message_type, 'SnapshotTopic' AS topic,
              dest_ip AS partition_by, 0 AS is_processed, 0 AS is_sequential,
              CAST(json_object('proto', proto) AS VARCHAR) AS metadata,
              CAST(NULL AS BIGINT) AS reserved_at_ms, CAST(NULL AS BIGINT) AS expired_at_ms,
              0 AS is_processing
            FROM snapshots""",
        "snapshots",
    ),
    "outbox_eligible": with_tables(
        "SELECT id, date_timestamp_ms, is_processing, expired_at_ms FROM eligible", "eligible"
    ),
    "outbox_reserve": with_tables(f"SELECT {CLAIMED} FROM claims", "claims"),
    "outbox_worker_claims": with_tables(
        f"SELECT {CLAIM}, worker, claim_rank FROM worker_claims", "worker_claims"
    ),
    "claim_audit": with_tables(
        """SELECT count(id) AS claimed, count(DISTINCT id) AS distinct_claimed
           FROM worker_claims""",
        "worker_claims",
    ),
    "outbox_mark_processed": with_tables(
        """SELECT id, CASE WHEN id IN (SELECT id FROM claims) THEN 1 ELSE is_processed END
             AS is_processed FROM outbox_table""",
        "claims",
    ),
    "outbox_cleanup": with_tables(
        "SELECT id, topic FROM outbox_table WHERE is_processed = 0", "outbox_table"
    ),
    "relay_publish": with_tables(
        """SELECT id, topic, key, value, error FROM published
           WHERE id IN (SELECT id FROM claims)""",
        "claims",
        "published",
    ),
    "relay_tick": with_tables(
        f"""SELECT o.id,
              CASE WHEN c.id IS NULL THEN o.is_processed ELSE 1 END AS is_processed,
              CASE WHEN c.id IS NULL THEN o.is_processing ELSE 1 END AS is_processing,
              CASE WHEN c.id IS NULL THEN o.reserved_at_ms ELSE {fx.NOW_MS} END AS reserved_at_ms,
              CASE WHEN c.id IS NULL THEN o.expired_at_ms ELSE {fx.NOW_MS + 20000} END
                AS expired_at_ms
            FROM outbox_table o LEFT JOIN claims c ON o.id = c.id""",
        "claims",
    ),
    "message_headers": with_tables(
        f"""SELECT id, 0 AS header_no, 'timestamp' AS header_key,
              {LITTLE_ENDIAN} AS header_value_hex FROM rows_
            UNION ALL SELECT id, 1, 'type', lower(hex(message_type)) FROM rows_
            UNION ALL SELECT id, 2, 'proto', lower(hex(metadata ->> '$.proto')) FROM rows_
            WHERE metadata IS NOT NULL""".replace(
            "rows_", "(SELECT *, date_timestamp_ms AS ms FROM outbox_table)"
        ),
        "outbox_table",
    ),
    "partition_assignment": with_tables(
        f"SELECT id, key, {SLOT} AS partition_id FROM published", "published"
    ),
    "decode_envelope": with_tables(ENVELOPE, "envelopes"),
    "attempt_count": with_tables(
        """SELECT msg_offset, coalesce(try_cast(attempts_header AS INT), 0) AS attempts
           FROM topic_messages""",
        "topic_messages",
    ),
    "api_key_hash": with_tables("SELECT * FROM hashed", "hashed"),
    "auth_accepted": with_tables(
        "SELECT * FROM hashed WHERE api_key_hash IN (SELECT api_key_hash FROM valid)",
        "hashed",
        "valid",
    ),
    "auth_rejected": with_tables(
        "SELECT * FROM hashed WHERE api_key_hash NOT IN (SELECT api_key_hash FROM valid)",
        "hashed",
        "valid",
    ),
    "split_lines": f"""SELECT doc_id, CAST(unnest(range(len(lines))) AS INT) AS no, unnest(lines) AS line
        FROM (SELECT doc_id, list_filter(
            list_transform(string_split(text, chr(10)),
                lambda x: regexp_replace(x, '{BLANKS}', '', 'g')),
            lambda x: x <> '') AS lines FROM documents)""",
    "classify_protocol": with_tables(
        f"SELECT event_id, proto, {PROTOCOL.format('proto')} AS protocol FROM packet_request",
        "packet_request",
    ),
    "classify_payload": with_tables(
        f"""SELECT msg_offset, {PROTOCOL.format("doc ->> '$.proto'")} AS protocol
            FROM (SELECT msg_offset, CASE WHEN json_valid(payload) THEN
                    CASE WHEN json_type(payload) = 'OBJECT' THEN payload END END AS doc
                  FROM topic_messages)""",
        "topic_messages",
    ),
    "delivery_verdicts": with_tables(
        "SELECT msg_offset, verdict, reason, attempts FROM verdicts", "verdicts"
    ),
    "retry_messages": with_tables(
        f"SELECT {RESENT.format(topic='SnapshotTopic', reason='CAST(NULL AS VARCHAR)')} AND attempts + 1 < 3",
        "verdicts",
    ),
    "dead_letters": with_tables(
        "SELECT "
        + RESENT.format(topic="deadletter", reason="'max attempts exceeded'")
        + " AND attempts + 1 >= 3",
        "verdicts",
    ),
    "shard_documents": with_tables("SELECT * EXCLUDE (api_key) FROM shard_docs", "shard_docs"),
    "shard_counts": with_tables(
        "SELECT shard, count(*) AS documents FROM shard_docs GROUP BY shard", "shard_docs"
    ),
    "shard_change_feed": with_tables("SELECT * FROM change_events", "change_events"),
    "cdc_union_shards": with_tables("SELECT topic, value FROM change_events", "change_events"),
    "parse_change_events": with_tables(f"SELECT {RECORD} FROM recs", "recs"),
    "parse_stored_at": with_tables(
        """SELECT arrival_seq, stored_at_ms, CAST(stored_at_ms IS NULL AS INT) AS missing
           FROM recs""",
        "recs",
    ),
    "skipped_events": with_tables(
        """SELECT skip_reason, count(*) AS events FROM parsed
           WHERE skip_reason IS NOT NULL GROUP BY skip_reason""",
        "parsed",
    ),
    "payload_roundtrip": with_tables(
        """SELECT transaction_id, array_to_string(list_sort(json_keys(doc)), ',') AS payload_keys,
             array_to_string(list_sort(list_transform(json_keys(doc),
               lambda k: k || '=' || coalesce(doc ->> ('$."' || k || '"'), 'null'))), ',')
               AS payload_fields
           FROM ledger""",
        "ledger",
    ),
    "payload_field": with_tables(
        """SELECT transaction_id, doc ->> '$.proto' AS payload_proto,
             doc ->> '$.transaction_id' AS payload_transaction_id,
             doc ->> '$.storedAt' AS payload_stored_at FROM ledger""",
        "ledger",
    ),
    "projection_outcomes": with_tables(
        """SELECT outcome, count(*) AS events FROM (
             SELECT CASE
               WHEN p.skip_reason IS NOT NULL THEN 'Skipped'
               WHEN p.transaction_id IN (SELECT transaction_id FROM live) THEN 'FastPathSkip'
               WHEN row_number() OVER (PARTITION BY p.skip_reason, p.transaction_id
                                       ORDER BY p.arrival_seq) > 1 THEN 'FastPathSkip'
               WHEN p.transaction_id IN (SELECT transaction_id FROM known) THEN 'Duplicate'
               ELSE 'Projected' END AS outcome
             FROM parsed p) GROUP BY outcome""",
        "parsed",
        "live",
        "known",
    ),
    "fast_path_filter": with_tables(
        "SELECT arrival_seq, transaction_id, proto FROM fresh", "fresh"
    ),
    "marker_update": with_tables(
        f"""SELECT transaction_id, max(marked_at_ms) AS marked_at_ms FROM (
              SELECT * FROM seen_markers
              UNION ALL SELECT transaction_id, {fx.NOW_MS} FROM fresh)
            GROUP BY transaction_id HAVING max(marked_at_ms) + {TTL_MS} > {fx.NOW_MS}""",
        "seen_markers",
        "fresh",
    ),
    "ledger": with_tables(f"SELECT {RECORD} FROM ledger", "ledger"),
    "ledger_new_rows": with_tables(
        """SELECT arrival_seq, transaction_id, proto, version FROM ledger
           WHERE transaction_id NOT IN (SELECT transaction_id FROM known)""",
        "ledger",
        "known",
    ),
    "ledger_lookup": with_tables(
        f"SELECT {RECORD} FROM stored WHERE transaction_id = 'tx-1'", "stored"
    ),
    "client_lookup": with_tables(
        f"SELECT {STATE} FROM stored_state WHERE client_id = 'c1'", "stored_state"
    ),
    "client_state_store": with_tables(f"SELECT {STATE} FROM state_store", "state_store"),
    "client_state_fastpath": with_tables(f"SELECT {STATE} FROM state_fastpath", "state_fastpath"),
    "client_state_merge": with_tables(f"SELECT {STATE} FROM state_store", "state_store"),
    "packet_stats_by_proto": with_tables(f"SELECT {STATS} FROM proto_stats", "proto_stats"),
    "stats_incremental_merge": with_tables(f"SELECT {STATS} FROM proto_stats", "proto_stats"),
    "stats_protocols": with_tables(
        f"SELECT {STATS} FROM stored_stats ORDER BY packet_count DESC, proto", "stored_stats"
    ),
    "stats_clients": with_tables(
        f"SELECT {STATE} FROM stored_state ORDER BY updated_at_ms DESC, client_id LIMIT 100",
        "stored_state",
    ),
    "stats_total": with_tables("SELECT count(*) AS total_packets FROM stored", "stored"),
    "fixed_window_admission": with_tables(
        """SELECT call_id, caller, window_start_ms, CAST(row_number() OVER
             (PARTITION BY caller, window_start_ms ORDER BY ts_ms, call_id) <= 3 AS INT) AS admitted
           FROM callers""",
        "callers",
    ),
    "stream_topic_read": with_tables(ENVELOPE, "envelopes"),
    "stream_ledger": with_tables(
        f"SELECT {RECORD}, transaction_id AS payload_transaction_id FROM stored", "stored"
    ),
    "stream_fast_path": with_tables(
        f"""SELECT transaction_id, max(clock) AS marked_at_ms FROM past
            GROUP BY transaction_id
            HAVING max(clock) > {fx.NOW_MS + fx.STAGE_AFTER_MS[2] - TTL_MS}""",
        "past",
    ),
    "stream_dedup_state": with_tables(
        f"SELECT {RECORD}, transaction_id AS payload_transaction_id FROM stored", "stored"
    ),
    "stream_outcomes": with_tables(
        f"""SELECT batch_no, outcome, count(*) AS events FROM (
              SELECT {fx.STAGE.replace("arrival_seq", "e.arrival_seq")} AS batch_no,
                CASE WHEN skip_reason IS NOT NULL THEN 'Skipped'
                     WHEN e.arrival_seq IN (SELECT arrival_seq FROM stored) THEN 'Projected'
                     WHEN e.arrival_seq IN (SELECT arrival_seq FROM past) THEN 'Duplicate'
                     ELSE 'FastPathSkip' END AS outcome
              FROM parsed e) GROUP BY ALL""",
        "parsed",
        "past",
        "stored",
    ),
    "stream_stats_live": with_tables(
        """SELECT batch_no, proto, count(*) AS packet_count, min(stored_at_ms) AS first_seen_ms,
             max(stored_at_ms) AS last_seen_ms
           FROM stored JOIN (VALUES (0), (1), (2)) b(batch_no) ON stage <= batch_no
           GROUP BY batch_no, proto""",
        "stored",
    ),
    "stream_admission": with_tables(
        """SELECT call_id, caller, window_start_ms, CAST(row_number() OVER
             (PARTITION BY caller, window_start_ms ORDER BY ts_ms, call_id) <= 3 AS INT) AS admitted
           FROM callers""",
        "callers",
    ),
    "stream_merged_shards": with_tables(
        """SELECT shard, count(*) AS documents, count(*) AS events FROM shard_docs
           WHERE api_key LIKE 'valid%' GROUP BY shard""",
        "shard_docs",
    ),
    "stream_pattern": with_tables("SELECT topic, value FROM change_events", "change_events"),
    "stream_bounded": with_tables(
        f"""SELECT msg_offset // {fx.PART_MESSAGES} AS part, count(*) AS messages,
              1 AS parts_in_batch, count(*) AS messages_in_batch
            FROM topic_messages GROUP BY part""",
        "topic_messages",
    ),
    "stream_client_state": with_tables(f"SELECT {STATE} FROM stored_state", "stored_state"),
    "stream_stats": with_tables(f"SELECT {STATS} FROM stored_stats", "stored_stats"),
    "relay_ticks": with_tables(
        f"""SELECT id,
              CASE WHEN id IN (SELECT id FROM tick0) OR id IN (SELECT id FROM tick2)
                THEN 1 ELSE is_processed END AS is_processed,
              CASE WHEN t.after_ms IS NULL THEN is_processing ELSE 1 END AS is_processing,
              coalesce({fx.NOW_MS} + t.after_ms, reserved_at_ms) AS reserved_at_ms,
              coalesce({fx.NOW_MS} + t.after_ms + 20000, expired_at_ms) AS expired_at_ms,
              CAST(CASE t.after_ms WHEN 0 THEN 0 WHEN 30000 THEN 2 END AS BIGINT) AS sent_in
            FROM ticking LEFT JOIN (
              SELECT id, max(after_ms) AS after_ms FROM (
                SELECT id, 0 AS after_ms FROM tick0 UNION ALL SELECT id, 1000 FROM tick1
                UNION ALL SELECT id, 30000 FROM tick2) GROUP BY id) t USING (id)""",
        "tick0",
        "tick1",
        "tick2",
        "ticking",
    ),
    "relay_workers": with_tables(
        "SELECT * FROM workers0 UNION ALL SELECT * FROM workers1 UNION ALL SELECT * FROM workers2",
        "workers0",
        "workers1",
        "workers2",
    ),
    "stream_relay": with_tables(
        f"""SELECT id, topic, key, value, {SLOT} AS partition_id, error FROM published
            WHERE is_processed = 0 AND is_sequential = 0""",
        "published",
    ),
    "stream_route": with_tables(
        """SELECT 'shard' AS sink, packet_id AS item, shard AS detail FROM shard_docs
             WHERE api_key LIKE 'valid%'
           UNION ALL SELECT 'refused', CAST(msg_offset AS VARCHAR), sha256(api_key || chr(10))
             FROM verdicts
             WHERE api_key NOT LIKE 'valid%'
           UNION ALL SELECT CASE WHEN attempts + 1 < 3 THEN 'retry' ELSE 'dead_letter' END,
               CAST(msg_offset AS VARCHAR), CAST(attempts + 1 AS VARCHAR) FROM verdicts
             WHERE api_key LIKE 'valid%' AND verdict = 'rejected'""",
        "verdicts",
        "shard_docs",
    ),
    "stream_unreachable": with_tables(
        """SELECT 'shard' AS sink, packet_id AS item, shard AS detail FROM shard_docs
             WHERE api_key LIKE 'valid%'
           UNION ALL SELECT 'refused', CAST(msg_offset AS VARCHAR), sha256(api_key || chr(10))
             FROM verdicts
             WHERE api_key NOT LIKE 'valid%'
           UNION ALL SELECT CASE WHEN attempts + 1 < 3 THEN 'retry' ELSE 'dead_letter' END,
               CAST(msg_offset AS VARCHAR), CAST(attempts + 1 AS VARCHAR) FROM verdicts
             WHERE api_key LIKE 'valid%' AND verdict = 'rejected'""",
        "verdicts",
        "shard_docs",
    ),
    "stream_retry_to_dead_letter": with_tables(
        """SELECT msg_offset, msg_key AS key, value, greatest(attempts + 1, 3) AS attempts
           FROM verdicts WHERE verdict = 'rejected'""",
        "verdicts",
    ),
}
