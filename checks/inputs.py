"""Logs, topics and state derived from the test tables, for the registered queries.

Every input is a query over whole tables, so it grows with them. ``SHARED`` texts are valid both in
Spark SQL and in DuckDB, once their ``{table}`` names are filled in; the two logs need binary
values and have one text per dialect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("events", "orders", "customer", "supplier")

EVENT_PARTITIONS = 4
ORDER_PARTITIONS = 8

EVENTS_LOG = """
SELECT CAST(user_id % 4 AS INT) AS `partition`, event_id AS `offset`,
       unix_millis(CAST(ts AS TIMESTAMP)) AS timestamp_ms,
       CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0 THEN CAST('' AS BINARY)
            ELSE CAST(CAST(user_id AS STRING) AS BINARY) END AS key,
       CASE WHEN event_type = 'error' THEN NULL ELSE CAST(props AS BINARY) END AS value,
       CASE WHEN event_id % 3 = 0 THEN NULL
            WHEN event_id % 5 = 0 THEN array(
                named_struct('key', 'type', 'value', CAST(event_type AS BINARY)),
                named_struct('key', 'type', 'value', CAST(NULL AS BINARY)))
            ELSE array(named_struct('key', 'type', 'value', CAST(event_type AS BINARY))) END
            AS headers
FROM {events}
"""

ORDERS_LOG = """
SELECT CAST(o_custkey % 8 AS INT) AS `partition`, o_orderkey AS `offset`,
       unix_millis(CAST(o_orderdate AS TIMESTAMP)) AS timestamp_ms,
       CAST(CAST(o_custkey AS STRING) AS BINARY) AS key,
       CAST(o_orderstatus || '|' || o_orderpriority AS BINARY) AS value,
       CAST(array() AS ARRAY<STRUCT<key: STRING, value: BINARY>>) AS headers
FROM {orders}
"""

# Per customer, how many orders there are decides which kind of difference its topic shows.
SHARED = {
    "traits": """
SELECT c_custkey AS k, 'topic-' || CAST(c_custkey AS STRING) AS name,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'clone' WHEN 'AUTOMOBILE' THEN 'stream'
            WHEN 'MACHINERY' THEN 'restore' WHEN 'HOUSEHOLD' THEN 'manage' ELSE 'empty' END
            AS mode,
       c_nationkey AS nation, CAST(c_nationkey % 4 + 1 AS INT) AS width, c_acctbal AS balance,
       coalesce(n, 0) AS n
FROM {customer} LEFT JOIN (SELECT o_custkey, count(*) AS n FROM {orders} GROUP BY o_custkey) o
     ON c_custkey = o_custkey
""",
    "declared_flat": """
SELECT name, mode,
       CASE WHEN mode IN ('clone', 'stream') THEN
            'nation-' || CAST(nation AS STRING) || ':in-' || CAST(k AS STRING) END AS source_ref,
       CASE WHEN mode = 'restore' THEN 'archive-' || CAST(nation AS STRING) END AS archive,
       CASE WHEN mode IN ('manage', 'empty') THEN width END AS partitions,
       CASE WHEN balance > 0 THEN 3 END AS replication_factor,
       CASE WHEN balance >= 5000 THEN 'compact' ELSE 'delete' END AS policy,
       CAST(nation * 1000 AS STRING) AS retention,
       balance < 2000 AS force
FROM {traits}
""",
    "live_flat": """
SELECT name, 'id-' || CAST(k AS STRING) AS topic_id, CAST(n % 3 + 1 AS INT) AS generation,
       CAST(width + CASE WHEN n > 14 THEN 1 ELSE 0 END AS INT) AS partitions,
       CASE WHEN n = 13 THEN 2 ELSE 3 END AS replication_factor,
       CASE WHEN n = 10 THEN 'compact,delete' WHEN balance >= 5000 THEN 'compact'
            ELSE 'delete' END AS policy,
       CASE WHEN n <> 9 THEN CAST(nation * 1000 AS STRING) END AS retention,
       CASE WHEN n = 12 THEN 'LogAppendTime' WHEN n <> 11 THEN 'CreateTime' END AS stamp
FROM {traits} WHERE n > 5
""",
    "progress": """
SELECT 'dest' AS dest_cluster, name AS dest_topic,
       CASE WHEN t.n = 8 THEN 'old-' ELSE '' END || 'id-' || CAST(k AS STRING) AS topic_id,
       'nation-' || CAST(nation AS STRING) AS source_cluster,
       'in-' || CAST(k AS STRING) AS source_topic,
       CASE WHEN t.n = 7 THEN 'old-' ELSE '' END || 'in-id-' || CAST(k AS STRING)
            AS source_topic_id,
       CAST(o_orderkey % width AS INT) AS {partition}, max(o_orderkey) + 1 AS next_offset
FROM {traits} t JOIN {orders} ON o_custkey = k
WHERE mode IN ('clone', 'manage') AND t.n <> 6
GROUP BY 1, 2, 3, 4, 5, 6, 7
""",
    "markers": """
SELECT 'dest' AS dest_cluster, name AS dest_topic, 'id-' || CAST(k AS STRING) AS topic_id,
       CASE WHEN n = 11 THEN 'stale-' ELSE '' END || 'digest-' || CAST(nation AS STRING)
            AS archive_digest,
       CAST(CASE WHEN n = 8 THEN 0 ELSE 1 END AS INT) AS format_version,
       CASE WHEN n > 12 THEN 'in_progress' ELSE 'complete' END AS status
FROM {traits} WHERE mode IN ('restore', 'stream') OR (mode = 'clone' AND n = 6)
""",
    "sources": """
SELECT name, 'nation-' || CAST(nation AS STRING) AS source_cluster,
       'in-' || CAST(k AS STRING) AS source_topic, 'in-id-' || CAST(k AS STRING)
            AS source_topic_id
FROM {traits} WHERE mode = 'clone'
""",
    "counts": """
SELECT 'nation-' || CAST(nation AS STRING) || ':in-' || CAST(k AS STRING) AS source_ref,
       width AS partitions
FROM {traits} WHERE mode IN ('clone', 'stream')
""",
    "archives": """
SELECT 'archive-' || CAST(nation AS STRING) AS archive, max(width) AS partitions,
       'digest-' || CAST(nation AS STRING) AS archive_digest
FROM {traits} GROUP BY nation
""",
    # Names repeat between customers and suppliers; faults depend on the account balance.
    "raw_declared": """
SELECT CASE WHEN c_acctbal > 9950 THEN ' ' ELSE 'topic-' || CAST(c_custkey AS STRING) END AS name,
       CASE WHEN c_acctbal < -900 THEN '' WHEN c_acctbal < -800 THEN 'clone,stream'
            WHEN c_mktsegment = 'BUILDING' THEN 'clone' WHEN c_mktsegment = 'MACHINERY' THEN
            'restore' ELSE 'manage' END AS modes_text,
       CASE WHEN c_mktsegment <> 'BUILDING' THEN NULL WHEN c_acctbal < 0 THEN 'no-colon'
            WHEN c_acctbal < 300 THEN ':no-instance' WHEN c_acctbal < 600 THEN 'no-topic:'
            WHEN c_acctbal < 900 THEN 'elsewhere:in' ELSE
            'nation-' || CAST(c_nationkey AS STRING) || ':in:' ||
            CAST(CAST(c_acctbal AS INT) AS STRING) END AS source_ref,
       CASE WHEN c_acctbal > 1000 THEN 'archive' ELSE '' END AS archive,
       CASE WHEN c_acctbal > 200 THEN CAST(c_nationkey AS INT) END AS partitions,
       CASE WHEN c_acctbal > 5000 THEN CAST(c_nationkey - 2 AS INT) END AS replication_factor,
       CASE WHEN c_acctbal > 9000 THEN 'message.timestamp.type' ELSE 'retention.ms' END AS setting
FROM {customer}
UNION ALL
SELECT 'topic-' || CAST(s_suppkey AS STRING), 'stream',
       'nation-' || CAST(s_nationkey AS STRING) || ':shared', NULL, NULL, NULL, 'retention.ms'
FROM {supplier}
""",
}


class Inputs:
    """The derived tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark, self.folder = spark, folder
        for table in TABLES:
            frame = spark.read.parquet(f"{folder}/{table}.parquet")
            setattr(self, table, frame)

    def _sql(self, text: str, **more: DataFrame) -> DataFrame:
        tables = {**{t: getattr(self, t) for t in TABLES}, **more}
        used = {name: df for name, df in tables.items() if f"{{{name}}}" in text}
        return self.spark.sql(text, **used)

    def events_log(self) -> DataFrame:
        return self._sql(EVENTS_LOG)

    def orders_log(self) -> DataFrame:
        return self._sql(ORDERS_LOG)

    def payload_log(self) -> DataFrame:
        """Documents and pages as records of two partitions, of very different sizes, with gaps between offsets."""
        parts = [("documents", 0, "doc_id * 3", "source", "text"), ("pages", 1, "page_id * 2", "url", "html")]
        frames = [
            self.spark.read.parquet(f"{self.folder}/{table}.parquet").selectExpr(
                f"{n} AS partition", f"{offset} AS offset", "cast(null AS bigint) AS timestamp_ms", f"cast({key} AS binary) AS key",
                f"cast({value} AS binary) AS value", "cast(array() AS array<struct<key:string,value:binary>>) AS headers",
            )
            for table, n, offset, key, value in parts
        ]
        return frames[0].unionByName(frames[1])

    def shared(self, name: str) -> DataFrame:
        text = SHARED[name].replace("{partition}", "`partition`")
        if name in ("traits", "raw_declared"):
            return self._sql(text)
        return self._sql(text, traits=self.shared("traits"))

    def mappings(self) -> DataFrame:
        flat = self.shared("declared_flat")
        config = F.create_map(
            F.lit("cleanup.policy"), F.col("policy"), F.lit("retention.ms"), F.col("retention")
        )
        return flat.select(
            "name", "mode", "source_ref", "archive", "partitions", "replication_factor",
            config.alias("config"), "force",
        )

    def live(self) -> DataFrame:
        flat = self.shared("live_flat")
        names = ["cleanup.policy", "retention.ms", "message.timestamp.type"]
        full = F.create_map(
            *[x for n, c in zip(names, ["policy", "retention", "stamp"]) for x in (F.lit(n), c)]
        )
        config = F.map_filter(full, lambda _, v: v.isNotNull())
        return flat.select(
            "name", "topic_id", "generation", "partitions", "replication_factor",
            config.alias("config"),
        )
