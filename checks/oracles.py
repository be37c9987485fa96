"""DuckDB SQL that states, independently of the Spark code, what each query must return."""

from __future__ import annotations

from checks.inputs import SHARED

EVENTS_LOG = """
SELECT CAST(user_id % 4 AS INT) AS "partition", event_id AS "offset",
       epoch_us(ts) // 1000 AS timestamp_ms,
       CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0 THEN ''::BLOB
            ELSE user_id::VARCHAR::BLOB END AS key,
       CASE WHEN event_type = 'error' THEN NULL ELSE props::BLOB END AS value,
       CASE WHEN event_id % 3 = 0 THEN []
            WHEN event_id % 5 = 0 THEN [{'key': 'type', 'value': event_type::BLOB},
                                        {'key': 'type', 'value': NULL::BLOB}]
            ELSE [{'key': 'type', 'value': event_type::BLOB}] END AS headers
FROM events
"""

ORDERS_LOG = """
SELECT CAST(o_custkey % 8 AS INT) AS "partition", o_orderkey AS "offset",
       epoch_us(o_orderdate) // 1000 AS timestamp_ms,
       o_custkey::VARCHAR::BLOB AS key,
       (o_orderstatus || '|' || o_orderpriority)::BLOB AS value,
       [{'key': '', 'value': NULL::BLOB}][:0] AS headers
FROM orders
"""

HEADERS_TEXT = """len(headers)::VARCHAR || '[' || coalesce(array_to_string(list_transform(headers,
    lambda h: octet_length(h.key::BLOB)::VARCHAR || ':' || hex(h.key::BLOB) || '=' ||
              coalesce(octet_length(h.value)::VARCHAR || ':' || hex(h.value), '-')), ','), '')
    || ']'"""

RECORD_DIGEST = f"""sha256(encode(concat_ws('|',
    coalesce(timestamp_ms::VARCHAR, '-'),
    coalesce(octet_length(key)::VARCHAR, '-'),
    coalesce(octet_length(value)::VARCHAR, '-'),
    {HEADERS_TEXT})) || coalesce(key, ''::BLOB) || coalesce(value, ''::BLOB))"""


def with_tables(body: str, *names: str, log: str = EVENTS_LOG) -> str:
    """``body`` with the log and the named shared tables as common table expressions."""
    parts = [f"log AS ({log})"]
    tables = {t: t for t in ("events", "orders", "customer", "supplier", "traits")}
    for name in names:
        text = SHARED[name].format(partition='"partition"', **tables)
        parts.append(f"{name} AS ({text})")
    return f"WITH {', '.join(parts)}\n{body}"


def text_of(table: str, position: str = '"offset"', where: str = "TRUE", more: str = "") -> str:
    return f"""SELECT "partition", {position}, timestamp_ms, hex(key) AS key_hex,
       hex(value) AS value_hex, {HEADERS_TEXT} AS headers_text{more}
FROM {table} WHERE {where}"""


CUT = '(SELECT (max("offset") + 1) * 6 // 10 FROM log)'
END = '(SELECT max("offset") + 1 FROM log)'
SEQUENCED = """(SELECT * EXCLUDE ("offset"),
    row_number() OVER (PARTITION BY "partition" ORDER BY "offset") - 1 AS {name} FROM log)"""
BY_SEQ = SEQUENCED.format(name="seq")
BY_OFFSET = SEQUENCED.format(name='"offset"')


def digest_tree(partitions: int, fan_in: int) -> str:
    """CTEs ``parts`` (one row per declared partition) and ``root``."""
    return f"""seqd AS {BY_SEQ},
d AS (SELECT "partition", seq, {RECORD_DIGEST} AS rd FROM seqd),
leaf AS (SELECT "partition", seq // {fan_in} AS leaf, count(*) AS n,
                sha256(unhex(string_agg(rd, '' ORDER BY seq))) AS ld FROM d GROUP BY 1, 2),
block AS (SELECT "partition", leaf // {fan_in} AS block, sum(n) AS n,
                 sha256(unhex(string_agg(ld, '' ORDER BY leaf))) AS bd FROM leaf GROUP BY 1, 2),
whole AS (SELECT "partition", sum(n) AS n, sha256(unhex(string_agg(bd, '' ORDER BY block))) AS pd
          FROM block GROUP BY 1),
parts AS (SELECT p::INT AS "partition", coalesce(n, 0)::BIGINT AS records,
                 coalesce(pd, sha256('')) AS digest
          FROM range({partitions}) t(p) LEFT JOIN whole ON whole."partition" = p),
root AS (SELECT -1 AS "partition", sum(records)::BIGINT AS records,
                sha256('1|' || count(*)::VARCHAR || '|' ||
                       string_agg(digest, '' ORDER BY "partition")) AS digest FROM parts),
prints AS (SELECT * FROM parts UNION ALL SELECT * FROM root)"""


def manifest(log: str, partitions: int, fan_in: int) -> str:
    return f"""WITH log AS ({log}), {digest_tree(partitions, fan_in)}
SELECT p."partition", p.records, p.digest, min(s.seq) AS first_seq, max(s.seq) AS last_seq
FROM prints p LEFT JOIN seqd s ON s."partition" = p."partition" GROUP BY 1, 2, 3"""


ALL = ("traits", "declared_flat", "live_flat", "progress", "markers", "sources", "counts",
       "archives")

# First reason per topic, in the order in which a reconciliation looks for it.
DECIDED = """
wanted AS (SELECT d.*, CASE WHEN mode IN ('clone', 'stream') THEN c.partitions
                            WHEN mode = 'restore' THEN a.partitions
                            ELSE d.partitions END AS desired_partitions, a.archive_digest
           FROM declared_flat d LEFT JOIN counts c ON d.source_ref = c.source_ref
                LEFT JOIN archives a ON d.archive = a.archive),
shape AS (SELECT w.name, CASE
    WHEN l.partitions <> w.desired_partitions
    THEN 'partition count is ' || l.partitions || ' but expected ' || w.desired_partitions
    WHEN l.replication_factor <> w.replication_factor
    THEN 'replication factor is ' || l.replication_factor || ' but expected '
         || w.replication_factor
    WHEN l.stamp IS NULL OR l.stamp <> 'CreateTime'
    THEN 'config message.timestamp.type is ' || coalesce(l.stamp, 'not set')
         || ' but expected CreateTime'
    WHEN l.policy <> w.policy
    THEN 'config cleanup.policy is ' || l.policy || ' but expected ' || w.policy
    WHEN l.retention IS NULL OR l.retention <> w.retention
    THEN 'config retention.ms is ' || coalesce(l.retention, 'not set') || ' but expected '
         || w.retention END AS reason
    FROM wanted w JOIN live_flat l ON w.name = l.name),
restored AS (SELECT w.name, EXISTS (SELECT 1 FROM live_flat l JOIN markers m
                 ON m.dest_topic = l.name AND m.topic_id = l.topic_id
                 WHERE l.name = w.name AND m.archive_digest = w.archive_digest
                   AND m.format_version = 1 AND m.status = 'complete') AS restored
             FROM wanted w WHERE mode = 'restore'),
saved AS (SELECT DISTINCT dest_topic AS name, topic_id, source_cluster, source_topic,
                 source_topic_id FROM progress),
clones AS (SELECT s.name, CASE
    WHEN p.name IS NULL AND m.dest_topic IS NULL THEN 'existing clone topic has no trusted state'
    WHEN coalesce(p.topic_id, m.topic_id) <> l.topic_id
    THEN 'saved destination topic UUID is ' || coalesce(p.topic_id, m.topic_id)
         || ' but the topic now has ' || l.topic_id
    WHEN p.name IS NULL THEN 'saved state belongs to a different data mode'
    WHEN (p.source_cluster, p.source_topic, p.source_topic_id)
         <> (s.source_cluster, s.source_topic, s.source_topic_id)
    THEN 'saved clone source identity differs from the configured source' END AS reason
    FROM sources s JOIN live_flat l ON l.name = s.name LEFT JOIN saved p ON p.name = s.name
         LEFT JOIN markers m ON m.dest_topic = s.name),
reasons AS (SELECT w.*, l.name IS NOT NULL AS live, l.generation AS old_generation,
    CASE WHEN l.name IS NULL THEN NULL
         WHEN w.mode = 'empty' THEN 'configured empty topic must be recreated'
         WHEN s.reason IS NOT NULL THEN s.reason
         WHEN w.mode = 'restore' AND NOT r.restored
         THEN 'configured archive has not completed successfully'
         WHEN w.mode = 'clone' THEN c.reason END AS reason
    FROM wanted w LEFT JOIN live_flat l ON l.name = w.name LEFT JOIN shape s ON s.name = w.name
         LEFT JOIN restored r ON r.name = w.name LEFT JOIN clones c ON c.name = w.name),
decided AS (SELECT *, CASE WHEN NOT live THEN 'create' WHEN reason IS NOT NULL THEN 'recreate'
                           ELSE 'none' END AS action FROM reasons)
"""


def after_decisions(body: str) -> str:
    return with_tables("", *ALL).rstrip() + f", {DECIDED}\n{body}"


APPLY = """
, changed AS (SELECT * FROM decided WHERE action <> 'none'),
new_topics AS (SELECT name, coalesce(old_generation + 1, 1)::INT AS generation,
    desired_partitions AS partitions, coalesce(replication_factor, 1) AS replication_factor,
    'cleanup.policy=' || policy || ';message.timestamp.type=CreateTime;retention.ms='
        || retention AS config_text FROM changed),
topics AS (
    SELECT name, sha256('dest' || chr(10) || name || chr(10) || generation) AS topic_id,
           generation, partitions, replication_factor, config_text FROM new_topics
    UNION ALL
    SELECT name, topic_id, generation, partitions, replication_factor,
           concat_ws(';', 'cleanup.policy=' || policy, 'message.timestamp.type=' || stamp,
                     'retention.ms=' || retention)
    FROM live_flat WHERE name NOT IN (SELECT name FROM changed)),
kept_progress AS (SELECT dest_topic AS name, count(*) AS progress_rows FROM progress
                  WHERE dest_topic NOT IN (SELECT name FROM changed) GROUP BY 1),
kept_markers AS (SELECT dest_topic AS name, count(*) AS marker_rows FROM markers
                 WHERE dest_topic NOT IN (SELECT name FROM changed) GROUP BY 1)
SELECT t.*, coalesce(progress_rows, 0) AS progress_rows, coalesce(marker_rows, 0) AS marker_rows
FROM topics t LEFT JOIN kept_progress USING (name) LEFT JOIN kept_markers USING (name)
"""

AUDIT = """
, known AS (SELECT DISTINCT 'nation-' || c_nationkey AS instance FROM customer),
d AS (SELECT *, len(list_filter(string_split(modes_text, ','), lambda m: m <> '')) AS n_modes,
             modes_text IN ('clone', 'stream') AS reads,
             CASE WHEN modes_text IN ('clone', 'stream')
                   AND regexp_full_match(source_ref, '[^:]+:.+')
                  THEN regexp_extract(source_ref, '^[^:]+') END AS instance
      FROM raw_declared)
SELECT name, 'blank name' AS violation, '' AS detail FROM d WHERE trim(name) = ''
UNION ALL
SELECT name, 'not exactly one mode', modes_text FROM d WHERE n_modes <> 1
UNION ALL
SELECT name, 'malformed source', coalesce(source_ref, '') FROM d
WHERE reads AND instance IS NULL
UNION ALL
SELECT name, 'unknown source', instance FROM d
WHERE instance IS NOT NULL AND instance NOT IN (SELECT instance FROM known)
UNION ALL
SELECT name, 'missing archive', '' FROM d WHERE modes_text = 'restore'
   AND coalesce(archive, '') = ''
UNION ALL
SELECT name, 'partitions not positive', coalesce(partitions::VARCHAR, '') FROM d
WHERE modes_text IN ('manage', 'empty') AND coalesce(partitions, 0) <= 0
UNION ALL
SELECT name, 'replication not positive', replication_factor::VARCHAR FROM d
WHERE replication_factor <= 0
UNION ALL
SELECT name, 'reserved setting', setting FROM d WHERE setting = 'message.timestamp.type'
UNION ALL
SELECT name, 'duplicate destination', count(*)::VARCHAR FROM d GROUP BY name HAVING count(*) > 1
UNION ALL
SELECT name, 'source feeds several destinations', source_ref FROM d
WHERE instance IS NOT NULL AND source_ref IN (
    SELECT source_ref FROM d WHERE instance IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
"""

STATUS = """
WITH spread AS (SELECT 'topic-' || o_custkey AS topic, (o_orderkey % 4)::INT AS "partition",
                       o_orderkey, o_orderpriority, o_orderstatus FROM orders),
done AS (SELECT topic, "partition", max(o_orderkey) + 1 AS next_offset FROM spread
         WHERE o_orderstatus <> 'P' GROUP BY 1, 2),
failed AS (SELECT topic, "partition", 'consumer error at ' || max(o_orderkey) AS last_error
           FROM spread WHERE o_orderpriority LIKE '1%' GROUP BY 1, 2),
listed AS (SELECT 'topic-' || c_custkey AS topic, p::INT AS "partition"
           FROM customer, range(4) t(p))
SELECT topic, "partition", next_offset,
       CASE WHEN last_error IS NOT NULL THEN 'error' WHEN next_offset IS NOT NULL THEN 'ok'
            ELSE 'starting' END AS status, last_error
FROM listed LEFT JOIN done USING (topic, "partition") LEFT JOIN failed USING (topic, "partition")
"""

RUN = """
SELECT 'blank' AS topic, p::INT AS "partition", 0::BIGINT AS records,
       0::BIGINT AS high FROM range(3) t(p)
UNION ALL SELECT 'board', p::INT, 0, 0 FROM range(3) t(p)
UNION ALL SELECT 'ledger', (o_custkey % 8)::INT, count(*), count(*) FROM orders GROUP BY 2
UNION ALL SELECT 'replay', "partition", count(*), count(*) FROM log
          WHERE "offset" < {cut} GROUP BY 2
UNION ALL {live}
"""

PROGRESS = "dest_cluster, dest_topic, topic_id, source_cluster, source_topic, source_topic_id"

ORACLES = {
    "topic_scan": with_tables(text_of("log")),
    "topic_watermarks": with_tables(f"""
SELECT p::INT AS "partition", coalesce(low, {END}) AS low, {END} AS high
FROM range(6) t(p) LEFT JOIN (SELECT "partition", min("offset") AS low FROM log GROUP BY 1) b
     ON b."partition" = p"""),
    "bounded_scan": with_tables(text_of("log", where=f'"offset" < {CUT}')),
    "resume_scan": with_tables(
        text_of("log", where=f'"partition" = 3 OR "offset" >= {CUT}')
    ),
    "stream_from_end": with_tables(text_of("log", where=f'"offset" >= {CUT}')),
    "stream_from_progress": with_tables(
        text_of("log", where=f'"partition" = 3 OR "offset" >= {CUT}')
    ),
    "archive_scan": with_tables(text_of(BY_SEQ, "seq")),
    "archive_write": manifest(ORDERS_LOG, 9, 1024),
    "topic_append": with_tables(text_of(BY_OFFSET)),
    "identity_copy": with_tables(
        f"SELECT 'copy' AS topic, * EXCLUDE (\"offset\") FROM ({text_of('log')})"
    ),
    "record_digest": with_tables(
        f'SELECT "partition", "offset", {RECORD_DIGEST} AS record_digest FROM log'
    ),
    "archive_projection": with_tables(text_of(BY_SEQ, "seq")),
    "record_from_archive": with_tables(text_of(BY_OFFSET)),
    "partition_sequence": with_tables(
        """SELECT "partition", "offset",
       row_number() OVER (PARTITION BY "partition" ORDER BY "offset") - 1 AS seq FROM log""",
        log=ORDERS_LOG,
    ),
    # Positions after the cut continue those before it.
    "assign_offsets": with_tables(
        f"""SELECT * EXCLUDE (old) FROM ({text_of(
            '(SELECT * EXCLUDE ("offset"), "offset" AS old, row_number() OVER '
            '(PARTITION BY "partition" ORDER BY "offset") - 1 AS "offset" FROM log)',
            more=", old")}) WHERE old >= {CUT}"""
    ),
    "partition_contiguity": """
WITH ids AS (SELECT DISTINCT CASE WHEN o_custkey % 8 >= 5 THEN o_custkey % 8 + 1
                             ELSE o_custkey % 8 END::INT AS "partition" FROM orders),
numbered AS (SELECT "partition", (row_number() OVER (ORDER BY "partition") - 1)::INT AS expected
             FROM ids)
SELECT * FROM numbered WHERE "partition" <> expected ORDER BY expected LIMIT 1""",
    "topic_fingerprint": f"WITH log AS ({EVENTS_LOG}), {digest_tree(6, 1024)}\n"
    "SELECT * FROM prints",
    "roundtrip_check": f"""WITH log AS ({EVENTS_LOG}), seqd AS {BY_SEQ},
altered AS (SELECT * REPLACE (CASE WHEN contains(decode(value), '7') THEN ''::BLOB ELSE value END
                              AS value) FROM seqd),
l AS (SELECT "partition", seq, {RECORD_DIGEST} AS left_digest FROM seqd),
r AS (SELECT "partition", seq, {RECORD_DIGEST} AS right_digest FROM altered)
SELECT * FROM l JOIN r USING ("partition", seq) WHERE left_digest <> right_digest""",
    "partition_counts": """SELECT event_type AS topic,
       count(DISTINCT user_id % 16)::INT AS partitions FROM events GROUP BY 1""",
    "progress_fold": with_tables(
        'SELECT "partition", max("offset") + 1 AS next_offset FROM log GROUP BY 1'
    ),
    "progress_finish": with_tables("""SELECT p::INT AS "partition",
       coalesce(max("offset") + 1, 0) AS next_offset
FROM range(6) t(p) LEFT JOIN log ON log."partition" = p GROUP BY 1"""),
    "copy_status": STATUS,
    "state_upsert": with_tables(
        f"""SELECT {PROGRESS}, "partition",
       next_offset + CASE WHEN balance > 0 THEN 100 ELSE 0 END AS next_offset
FROM progress JOIN traits ON name = dest_topic WHERE balance <= 0 OR "partition" <> 2""",
        "traits", "progress",
    ),
    "state_reset": with_tables(
        """SELECT progress.* FROM progress JOIN traits ON name = dest_topic
WHERE mode <> 'clone'""",
        "traits", "progress",
    ),
    "clear_stateless": with_tables(
        """SELECT markers.* FROM markers JOIN traits ON name = dest_topic
WHERE mode IN ('clone', 'restore')""",
        "traits", "markers",
    ),
    "restore_matches": after_decisions("SELECT name, restored FROM restored"),
    "clone_state_mismatch": after_decisions("SELECT name, reason FROM clones"),
    "validate_sources": after_decisions("""
SELECT s.name, p.source_cluster AS saved_source_cluster, p.source_topic AS saved_source_topic,
       p.source_topic_id AS saved_source_topic_id, s.source_cluster, s.source_topic,
       s.source_topic_id
FROM sources s JOIN saved p ON p.name = s.name
WHERE (p.source_cluster, p.source_topic, p.source_topic_id)
      <> (s.source_cluster, s.source_topic, s.source_topic_id)"""),
    "mapping_audit": with_tables("", "raw_declared").rstrip() + AUDIT,
    "desired_partitions": after_decisions("SELECT name, mode, desired_partitions FROM wanted"),
    "topic_drift": after_decisions("SELECT name, reason FROM shape"),
    "reconcile_actions": after_decisions("SELECT name, mode, action, reason FROM decided"),
    "preflight": after_decisions(
        "SELECT name, reason FROM decided WHERE action = 'recreate' AND NOT force"
    ),
    "apply_actions": after_decisions("").rstrip() + APPLY,
    "dump_job": manifest(EVENTS_LOG, 4, 1024),
    "restore_job": with_tables(text_of(BY_OFFSET, more=", 'complete' AS marker")),
    "clone_bounded": with_tables(
        f"""SELECT * FROM ({text_of(BY_OFFSET)}) JOIN
(SELECT "partition", max("offset") + 1 AS next_offset FROM log GROUP BY 1) USING ("partition")"""
    ),
    "forward_new": with_tables(
        text_of(
            """(SELECT * EXCLUDE ("offset"), row_number() OVER
            (PARTITION BY "partition" ORDER BY "offset") - 1 AS "offset"
            FROM log WHERE "offset" >= """ + CUT + ")"
        )
    ),
    "run_all": with_tables(
        RUN.format(
            cut=CUT,
            live=f"""SELECT 'pulse', "partition", count(*), count(*) FROM log
          WHERE "offset" >= {CUT} GROUP BY 2""",
        )
    ),
    "restore_all": with_tables(
        RUN.format(cut=CUT, live="SELECT 'pulse', p::INT, 0, 0 FROM range(4) t(p)")
    ),
}
ORACLES["clone_continuous"] = ORACLES["clone_bounded"]
ORACLES["clone_backlog"] = ORACLES["clone_bounded"]
ORACLES["archive_differences"] = ORACLES["roundtrip_check"]
ORACLES["payload_sequence"] = """SELECT *, row_number() OVER (PARTITION BY "partition" ORDER BY "offset") - 1 AS seq FROM (
SELECT 0::INT AS "partition", doc_id * 3 AS "offset", strlen(text)::BIGINT AS n_bytes FROM documents
UNION ALL SELECT 1::INT, page_id * 2, strlen(html)::BIGINT FROM pages)"""
