"""The queries of the change-stream library, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.functions import names
from tidelog.functions.backoff import engine_backoff, publisher_backoff
from tidelog.functions.lsn import checkpoint_position, lsn_halves, lsn_number, lsn_text, start_position
from tidelog.functions.times import change_time
from tidelog.operators import metrics, replay
from tidelog.operators import publish as pub
from tidelog.operators import transactions as tx
from tidelog.operators.normalize import normalize, serialized
from tidelog.plans.folders import stored
from tidelog.sources import binary_messages, capture, json_messages
from tidelog.sources.changes import DATABASE, as_binary_messages, as_json_messages, changes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
BATCH = 3

#: The change log and its sequence, as SQL.
LOG = """
w AS (
  SELECT event_id AS ordinal, ts, user_id, event_type AS tbl, value, props, 1000 + CAST(floor(event_id / 7.0) AS BIGINT) AS txid,
         CASE WHEN event_id % 10 < 6 THEN 'INSERT' WHEN event_id % 10 < 9 THEN 'UPDATE' ELSE 'DELETE' END AS op
  FROM events
), q AS (
  SELECT *, row_number() OVER (PARTITION BY txid ORDER BY ordinal) - 1 AS seq, 23803648 + txid * 256 AS lsn_num,
         max(ts) OVER (PARTITION BY txid) AS commit_time
  FROM w
), e AS (
  SELECT *, concat('0/', hex(lsn_num)) AS lsn, concat('cdc.shop.public.', tbl) AS subject,
         concat('0/', hex(lsn_num), ':', txid, ':', op, ':public.', tbl, ':', seq) AS event_id
  FROM q
)
"""


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = ("WITH " + LOG if "FROM e" in sql or "FROM q" in sql or "FROM w" in sql else "") + sql
        return f

    return add


def log_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes(spark.read.parquet(f"{sf_dir}/events.parquet"))


def events_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded change events straight from the log, with subject and event_id."""
    log = tx.sequenced(log_of(spark, sf_dir)).withColumn("lsn", lsn_text(F.col("lsn_num")))
    c = F.col
    return log.withColumns(
        {
            "event_id": names.event_id(c("lsn"), c("txid"), c("op"), c("schema"), c("table"), c("seq")),
            "subject": names.subject(DATABASE, c("schema"), c("table")),
        }
    )


@query("""
SELECT event_id, concat('cdc.', lower(op)) AS event_type, 'shop' AS source, lsn, txid, tbl AS "table", op AS operation, subject,
       CAST(floor((seq + 1) / 3) AS BIGINT) AS batch_in_tx, CAST(commit_time AS VARCHAR) AS commit_time
FROM e
""")
def cdc_normalized_events(spark, sf_dir):
    e = events_of(spark, sf_dir).withColumns({"timestamp": F.col("ts"), "old_values": F.lit(None).cast("map<string,string>"), "new_values": F.lit(None).cast("map<string,string>")})
    batch = e.select("event_id", tx.batch_in_tx(F.col("seq"), BATCH).alias("batch_in_tx"), "*")
    n = normalize(batch.withColumn("txid", F.col("txid")), DATABASE)
    seq = F.split_part("event_id", F.lit(":"), F.lit(-1)).cast("long")
    time = F.regexp_replace(F.date_format("commit_time", "yyyy-MM-dd HH:mm:ss.SSSSSS"), r"\.?0+$", "")
    whole = F.date_format("commit_time", "yyyy-MM-dd HH:mm:ss")
    return n.select("event_id", "event_type", "source", "lsn", "txid", "table", "operation", "subject", tx.batch_in_tx(seq, BATCH).alias("batch_in_tx"), F.when(F.date_format("commit_time", "SSSSSS") == "000000", whole).otherwise(time).alias("commit_time"))


def _variant(image: str, name: str, kind: str):
    return F.try_variant_get(F.try_element_at(F.col(image), F.lit(name)), "$", kind)


def _decoded(e: DataFrame) -> DataFrame:
    return e.select(
        "ordinal",
        "lsn",
        "txid",
        "op",
        "schema",
        F.col("table").alias("tbl"),
        _variant("old_values", "id", "bigint").alias("before_id"),
        _variant("new_values", "id", "bigint").alias("after_id"),
        _variant("new_values", "user_id", "bigint").alias("user_id"),
        _variant("new_values", "value", "double").alias("value"),
        _variant("new_values", "props", "string").alias("props"),
        "seq",
    )


_DECODED = """
SELECT ordinal, lsn, txid, op, 'public' AS "schema", tbl, CASE WHEN op <> 'INSERT' THEN ordinal END AS before_id,
       CASE WHEN op <> 'DELETE' THEN ordinal END AS after_id, CASE WHEN op <> 'DELETE' THEN user_id END AS user_id,
       CASE WHEN op <> 'DELETE' THEN value END AS value, CASE WHEN op <> 'DELETE' THEN props END AS props, {seq} AS seq
FROM e
"""


@query(_DECODED.format(seq="CAST(0 AS BIGINT)"))
def cdc_decode_wal2json(spark, sf_dir):
    return _decoded(json_messages.decode(as_json_messages(log_of(spark, sf_dir))))


@query(_DECODED.format(seq="seq"))
def cdc_decode_pgoutput(spark, sf_dir):
    # decoding reads the messages three times: they are made once
    return _decoded(binary_messages.decode(stored(as_binary_messages(log_of(spark, sf_dir)), "messages")))


#: Tables that a truncation lists, not in the order of their relations' numbers.
_TRUNCATED = ["view", "click", "signup", "error", "purchase"]


@query(f"""
, k AS (SELECT tbl, min(ordinal) AS known FROM w GROUP BY tbl),
t AS (SELECT ordinal, txid, lsn_num, unnest({_TRUNCATED}) AS tbl, unnest(range({len(_TRUNCATED)})) AS place FROM q WHERE op = 'DELETE' AND txid % 3 = 0),
a AS (SELECT ordinal, txid, lsn_num, op, tbl, -1 AS place FROM q
      UNION ALL SELECT t.ordinal, txid, lsn_num, 'DDL', t.tbl, place FROM t JOIN k ON t.tbl = k.tbl AND known <= t.ordinal)
SELECT ordinal, txid, op, tbl, concat('0/', hex(lsn_num)) AS lsn, row_number() OVER (PARTITION BY txid ORDER BY ordinal, place) - 1 AS seq FROM a
""")
def cdc_decode_truncate(spark, sf_dir):
    """Truncations among other changes: an event for each listed relation, in the listed order."""
    log = log_of(spark, sf_dir)
    listed = F.array(*[F.lit(t) for t in _TRUNCATED]).alias("tables")
    truncated = log.where("op = 'DELETE' and txid % 3 = 0").select("txid", "ordinal", listed)
    e = binary_messages.decode(as_binary_messages(log, truncated))
    return e.select("ordinal", "txid", "op", F.col("table").alias("tbl"), "lsn", "seq")


@query("""
SELECT ordinal AS event_id, CASE ordinal % 8 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 7 THEN NULL
         WHEN 3 THEN epoch_us(date_trunc('second', ts)) WHEN 4 THEN epoch_us(ts) + 18000000000 WHEN 5 THEN epoch_us(date_trunc('second', ts)) + 18000000000
         ELSE epoch_us(ts) - 19800000000 END AS micros,
       ordinal % 8 = 7 AS is_error
FROM w
""")
def cdc_decode_timestamps(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    shown = lambda p, s: F.concat(F.date_format("ts", p), F.lit(s))
    forms = {
        1: F.lit("null"),
        2: F.lit(""),
        3: shown("yyyy-MM-dd'T'HH:mm:ss", "Z"),
        4: shown("yyyy-MM-dd HH:mm:ss.SSSSSS", "-05:00"),
        5: shown("yyyy-MM-dd HH:mm:ss", "-05"),
        6: shown("yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "+05:30"),
        7: shown("yyyy-MM-dd", ""),
    }
    text = F.lit(None).cast("string")
    for k, form in forms.items():
        text = F.when(F.col("event_id") % 8 == k, form).otherwise(text)
    time, bad = change_time(F.col("text"))
    return e.withColumn("text", text).select("event_id", F.unix_micros(time).alias("micros"), bad.alias("is_error"))


@query("""
SELECT ordinal, tbl, txid, row_number() OVER (PARTITION BY txid ORDER BY ordinal) - 1 AS seq FROM w WHERE tbl IN ('click', 'purchase')
""")
def cdc_table_filter(spark, sf_dir):
    messages = as_json_messages(log_of(spark, sf_dir))
    e = json_messages.decode(messages, ("public.click", "public.purchase")).drop("seq")
    return tx.sequenced(e).select("ordinal", F.col("table").alias("tbl"), "txid", "seq")


@query("""
SELECT ordinal, op, CASE WHEN op = 'DELETE' THEN 'no image' WHEN ordinal % 3 = 0 THEN 'null' WHEN ordinal % 3 = 1 THEN 'empty' ELSE 'absent' END AS note,
       op <> 'INSERT' AS has_before, op <> 'DELETE' AS has_after
FROM w
""")
def cdc_images_before_after(spark, sf_dir):
    """Three states of a value in an image: null, empty text, and absent (unchanged)."""
    log = log_of(spark, sf_dir)
    third = F.col("ordinal") % 3
    note = F.when(third == 0, F.lit(',{"name":"note","type":"text","value":null}')).when(third == 1, F.lit(',{"name":"note","type":"text","value":""}')).otherwise(F.lit(""))
    m = as_json_messages(log).withColumn("data", F.regexp_replace("data", r"\}\](,\"identity\"|\}$)", F.concat(F.lit("}"), note, F.lit("]$1"))))
    e = json_messages.decode(m)
    image = F.col("new_values")
    value = F.try_variant_get(F.try_element_at(image, F.lit("note")), "$", "string")
    state = F.when(image.isNull(), "no image").when(~F.map_contains_key(image, "note"), "absent").when(value.isNull(), "null").when(value == "", "empty")
    return e.select("ordinal", "op", state.alias("note"), F.col("old_values").isNotNull().alias("has_before"), image.isNotNull().alias("has_after"))


@query("SELECT txid, count(*) AS n_events, max(seq) AS last_seq, min(ordinal) AS first_ordinal FROM q GROUP BY txid")
def cdc_tx_sequence(spark, sf_dir):
    return tx.sequenced(log_of(spark, sf_dir)).groupBy("txid").agg(F.count(F.lit(1)).alias("n_events"), F.max("seq").alias("last_seq"), F.min("ordinal").alias("first_ordinal"))


@query("""
SELECT ordinal, txid, lsn_num AS commit_lsn, CASE WHEN txid % 4 = 0 THEN lsn_num ELSE lsn_num + 64 END AS position, epoch_us(commit_time) AS commit_micros
FROM q
""")
def cdc_commit_metadata(spark, sf_dir):
    log = log_of(spark, sf_dir)
    end = F.when(F.col("txid") % 4 == 0, F.lit(0)).otherwise(F.col("commit_lsn") + 64).alias("end_lsn")
    commits = log.groupBy("txid").agg(F.max("lsn_num").alias("commit_lsn"), F.max("ts").alias("commit_time")).select("txid", "commit_lsn", end, "commit_time")
    return tx.with_commit(log.select("ordinal", "txid"), commits).select("ordinal", "txid", "commit_lsn", "position", F.unix_micros("commit_time").alias("commit_micros"))


#: Definitions of relations by number, with the ordinal from which each holds.
_RELATIONS = [(0, 0, "public.signup", 1), (1, 0, "public.click", 1), (1, 500, "public.click", 2), (2, 0, "public.view", 1), (3, 300, "public.purchase", 1)]


@query("""
, r(rel, fr, rel_table, version) AS (VALUES (0, 0, 'public.signup', 1), (1, 0, 'public.click', 1), (1, 500, 'public.click', 2), (2, 0, 'public.view', 1), (3, 300, 'public.purchase', 1))
SELECT ordinal, q.rel, rel_table, version
FROM (SELECT ordinal, ordinal % 5 AS rel FROM w) q ASOF JOIN r ON q.rel = r.rel AND q.ordinal >= r.fr
""")
def cdc_relation_lookup(spark, sf_dir):
    relations = spark.createDataFrame(_RELATIONS, "rel long, ordinal long, rel_table string, version int")
    rows = log_of(spark, sf_dir).select("ordinal", (F.col("ordinal") % 5).alias("rel"))
    return tx.relation_as_of(rows, relations).select("ordinal", "rel", "rel_table", "version")


@query("""
SELECT ordinal, generate_subscripts(rels, 1) - 1 AS place, unnest(rels) AS rel
FROM (SELECT ordinal, list_transform(range(ordinal % 4), lambda x: (ordinal + x) % 5) AS rels FROM w WHERE op = 'DELETE')
""")
def cdc_truncate_fanout(spark, sf_dir):
    n = F.col("ordinal") % 4
    rels = F.when(n > 0, F.transform(F.sequence(F.lit(0), (n - 1).cast("int")), lambda x: (F.col("ordinal") + x) % 5))
    return tx.truncations(log_of(spark, sf_dir).where("op = 'DELETE'").select("ordinal", rels.alias("rels"))).select("ordinal", "place", "rel")


@query("""
SELECT txid, CAST(floor((seq + 1) / 3) AS BIGINT) AS batch_in_tx, count(*) AS n_events, min(seq) AS first_seq FROM q GROUP BY ALL
""")
def cdc_batch_boundaries(spark, sf_dir):
    q = tx.sequenced(log_of(spark, sf_dir))
    return q.groupBy("txid", tx.batch_in_tx(F.col("seq"), BATCH).alias("batch_in_tx")).agg(F.count(F.lit(1)).alias("n_events"), F.min("seq").alias("first_seq"))


@query("SELECT subject, count(*) AS n FROM e GROUP BY subject")
def cdc_subject_counts(spark, sf_dir):
    return events_of(spark, sf_dir).groupBy("subject").agg(F.count(F.lit(1)).alias("n"))


_PATTERNS = ["cdc.>", "cdc.shop.public.*", "cdc.*.*.click", "cdc.shop.>", "cdc.shop.public", "cdc.shop.public.view.>"]


@query("""
SELECT pattern, count(*) AS n FROM e JOIN (VALUES ('cdc.>', '^cdc([.].*)?$'), ('cdc.shop.public.*', '^cdc[.]shop[.]public[.][^.]+$'),
  ('cdc.*.*.click', '^cdc[.][^.]+[.][^.]+[.]click$'), ('cdc.shop.>', '^cdc[.]shop([.].*)?$'), ('cdc.shop.public', '^cdc[.]shop[.]public$'),
  ('cdc.shop.public.view.>', '^cdc[.]shop[.]public[.]view([.].*)?$')) p(pattern, re) ON regexp_matches(subject, re)
GROUP BY pattern
""")
def cdc_subject_wildcard(spark, sf_dir):
    hits = F.array(*[F.when(F.col("subject").rlike(names.subject_regex(p)), F.lit(p)) for p in _PATTERNS])
    e = events_of(spark, sf_dir).select(F.explode(F.array_compact(hits)).alias("pattern"))
    return e.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))


#: Payload limit of the poison queries, so that some events exceed it.
_LIMIT = 60


def _published(spark, sf_dir) -> DataFrame:
    """Events with a payload that grows with their number, and a table name that isn't a subject token for some."""
    e = events_of(spark, sf_dir)
    odd = F.when(F.col("ordinal") % 50 == 7, F.lit("bad table*")).otherwise(F.col("table"))
    e = e.withColumns({"table": odd, "operation": F.col("op"), "payload": F.repeat(F.lit("é"), (F.col("ordinal") % 40).cast("int"))})
    e = e.withColumn("subject", names.subject(DATABASE, F.col("schema"), F.col("table")))
    return e.withColumn("error", pub.poison_error(F.col("payload"), F.col("subject"), _LIMIT))


_ERROR = "CASE WHEN 2 * (ordinal % 40) > 60 THEN 'max payload' WHEN ordinal % 50 = 7 THEN 'bad subject' END"


@query(f"SELECT coalesce({_ERROR}, 'none') AS error, op, count(*) AS n FROM q GROUP BY ALL")
def cdc_poison_split(spark, sf_dir):
    return _published(spark, sf_dir).groupBy(F.coalesce("error", F.lit("none")).alias("error"), "op").agg(F.count(F.lit(1)).alias("n"))


@query(f"""
SELECT * FROM (
  SELECT concat('0/', hex(lsn_num), ':', txid, ':', op, ':public.', tbl, ':', seq) AS event_id,
         concat('dlq-0/', hex(lsn_num), ':', txid, ':', op, ':public.', tbl, ':', seq) AS msg_id,
         concat('cdc.dlq.shop.public.', CASE WHEN ordinal % 50 = 7 THEN 'bad_table_' ELSE tbl END) AS subject, 'shop' AS database, 'public' AS "schema",
         CASE WHEN ordinal % 50 = 7 THEN 'bad table*' ELSE tbl END AS "table", op AS operation, concat('0/', hex(lsn_num)) AS lsn, txid,
         {_ERROR} AS error, 2 * (ordinal % 40) AS payload_size, false AS truncated, repeat('é', CAST(ordinal % 40 AS INT)) AS payload_prefix
  FROM q) WHERE error IS NOT NULL
""")
def cdc_dead_letters(spark, sf_dir):
    _, poison = pub.split_by_policy(_published(spark, sf_dir), "dlq")
    return pub.dead_letters(poison, "cdc.dlq", DATABASE, F.lit(None).cast("timestamp")).drop("quarantined_at")


@query(f"""
SELECT policy, count(*) FILTER (error IS NULL) AS published, count(*) FILTER (error IS NOT NULL) AS quarantined,
       CASE policy WHEN 'dlq' THEN count(*) FILTER (error IS NOT NULL) ELSE 0 END AS dead_letters
FROM (SELECT {_ERROR} AS error FROM q) x, (VALUES ('dlq'), ('skip')) p(policy) GROUP BY policy
""")
def cdc_failure_policy(spark, sf_dir):
    out = None
    for policy in ("dlq", "skip"):
        good, poison = pub.split_by_policy(_published(spark, sf_dir).select("event_id", "error"), policy)
        # one row of sums, from both sides of the split
        both = good.select(F.lit(1).alias("g"), F.lit(0).alias("p")).union(poison.select(F.lit(0), F.lit(1)))
        n = both.agg(F.coalesce(F.sum("g"), F.lit(0)).alias("published"), F.coalesce(F.sum("p"), F.lit(0)).alias("quarantined"))
        n = n.select(F.lit(policy).alias("policy"), "published", "quarantined", F.when(F.lit(policy == "dlq"), F.col("quarantined")).otherwise(F.lit(0)).alias("dead_letters"))
        out = n if out is None else out.union(n)
    return out


@query("""
, r AS (SELECT txid AS batch, seq AS idx, ordinal % 9 <> 4 AS ok, lsn_num + seq AS position FROM q),
f AS (SELECT *, sum(CASE WHEN ok THEN 0 ELSE 1 END) OVER (PARTITION BY batch ORDER BY idx) AS failed FROM r)
SELECT batch, count(*) AS total, count(*) FILTER (ok) AS succeeded, count(*) FILTER (NOT ok) AS failed,
       coalesce(list_sort(list(idx) FILTER (NOT ok)), []) AS failed_idx, max(position) FILTER (failed = 0) AS last_position
FROM f GROUP BY batch
""")
def cdc_batch_result(spark, sf_dir):
    q = tx.sequenced(log_of(spark, sf_dir))
    r = q.select(F.col("txid").alias("batch"), F.col("seq").alias("idx"), (F.col("ordinal") % 9 != 4).alias("ok"), (F.col("lsn_num") + F.col("seq")).alias("position"))
    return tx.contiguous(r)


@query("""
SELECT count(*) FILTER (ordinal % 11 <> 0) AS acked, count(*) FILTER (ordinal % 11 = 0 AND ordinal % 2 = 0) AS timed_out,
       count(*) FILTER (ordinal % 11 = 0 AND ordinal % 2 = 1) AS cancelled FROM w
""")
def cdc_ack_tally(spark, sf_dir):
    o = F.col("ordinal")
    state = F.when(o % 11 != 0, "acked").when(o % 2 == 0, "timed_out").otherwise("cancelled")
    s = log_of(spark, sf_dir).select(state.alias("s"))
    return s.agg(*[F.count_if(F.col("s") == k).alias(k) for k in ("acked", "timed_out", "cancelled")])


@query("""
SELECT slot, "at", position, max(position) OVER (PARTITION BY slot ORDER BY "at" ROWS UNBOUNDED PRECEDING) AS acked
FROM (SELECT txid // 1000 AS slot, txid AS "at", 4294967296 * (txid % 3) + (txid * 7919) % 65536 AS position FROM (SELECT DISTINCT txid FROM w))
""")
def cdc_acked_lsn_monotonic(spark, sf_dir):
    t = log_of(spark, sf_dir).select("txid").distinct()
    acks = t.select(F.floor(F.col("txid") / 1000).cast("long").alias("slot"), F.col("txid").alias("at"), (4294967296 * (F.col("txid") % 3) + (F.col("txid") * 7919) % 65536).alias("position"))
    # through the text form, which doesn't sort as the positions do
    acks = acks.withColumn("position", lsn_number(lsn_text(F.col("position"))).cast("long"))
    return tx.acked_positions(acks, "slot", "at", "position")


@query()
def cdc_checkpoint_throttle(spark, sf_dir):
    t = log_of(spark, sf_dir).groupBy("txid").agg(F.max(F.unix_millis("ts")).alias("at"), F.max("lsn_num").alias("position"))
    return tx.throttled_flushes(t.withColumn("slot", F.col("txid") % 16), "slot", 60_000)


@query("""
SELECT DISTINCT ordinal % 12 + 1 AS attempt, least(pow(2.0, ordinal % 12), 8.0) AS engine_s, pow(2.0, least(ordinal % 12 + 1, 3)) AS publisher_s FROM w
""")
def cdc_retry_backoff(spark, sf_dir):
    a = log_of(spark, sf_dir).select((F.col("ordinal") % 12 + 1).alias("attempt")).distinct()
    return a.select("attempt", engine_backoff(F.col("attempt")).alias("engine_s"), publisher_backoff(F.col("attempt")).alias("publisher_s"))


def _deliveries(spark, sf_dir) -> DataFrame:
    """Every event once at its time; some again after 30 seconds (dropped) and some after 5 minutes (delivered)."""
    e = events_of(spark, sf_dir).select("ordinal", "event_id", "ts")
    again = e.where("ordinal % 3 = 0").select("ordinal", "event_id", (F.col("ts") + F.expr("interval 30 seconds")).alias("ts"))
    late = e.where("ordinal % 5 = 0").select("ordinal", "event_id", (F.col("ts") + F.expr("interval 300 seconds")).alias("ts"))
    return e.union(again).union(late)


@query("""
SELECT event_id, epoch_us(ts) AS micros FROM e UNION ALL SELECT event_id, epoch_us(ts) + 300000000 FROM e WHERE ordinal % 5 = 0
""")
def cdc_replay_dedup(spark, sf_dir):
    kept = replay.dedup_window(_deliveries(spark, sf_dir), "event_id", "ts", 120)
    return kept.select("event_id", F.unix_micros("ts").alias("micros"))


@query("""
SELECT state, count(*) AS n, CAST(sum(copies) AS BIGINT) AS copies FROM (
  SELECT CASE WHEN ordinal % 13 = 0 THEN 'missing' WHEN ordinal % 7 = 0 THEN 'duplicate' ELSE 'ok' END AS state,
         CASE WHEN ordinal % 13 = 0 THEN 0 WHEN ordinal % 7 = 0 THEN 2 ELSE 1 END AS copies FROM w) GROUP BY state
""")
def cdc_missing_and_duplicates(spark, sf_dir):
    e = log_of(spark, sf_dir).select("ordinal")
    first = e.where("ordinal % 13 <> 0")
    got = first.union(first.where("ordinal % 7 = 0"))
    return replay.reconcile(e, got, "ordinal").groupBy("state").agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("copies"))


def _latencies(spark, sf_dir) -> DataFrame:
    o = F.col("ordinal")
    return log_of(spark, sf_dir).select("table", "ts", "ordinal", (o * 7919 % 130000).alias("micros"))


_BOUNDS = "CASE WHEN m <= 100 THEN 0 WHEN m <= 500 THEN 1 WHEN m <= 1000 THEN 2 WHEN m <= 5000 THEN 3 WHEN m <= 10000 THEN 4 WHEN m <= 50000 THEN 5 WHEN m <= 100000 THEN 6 ELSE 7 END"


@query(f"""
SELECT bucket, [100.0, 500, 1000, 5000, 10000, 50000, 100000][bucket + 1]::DOUBLE AS le, count(*) AS n
FROM (SELECT {_BOUNDS} AS bucket FROM (SELECT ordinal * 7919 % 130000 AS m FROM w)) GROUP BY bucket
""")
def cdc_latency_histogram(spark, sf_dir):
    return metrics.histogram(_latencies(spark, sf_dir), "micros", metrics.BATCH_MICROS)


@query('SELECT tbl AS "table", round(avg(ordinal * 7919 % 130000), 6) AS mean FROM w GROUP BY tbl')
def cdc_latency_mean(spark, sf_dir):
    return _latencies(spark, sf_dir).groupBy("table").agg(F.round(metrics.mean("micros"), 6).alias("mean"))


def _quantile_sql(q: float) -> str:
    return f"""
SELECT {q} AS q, round(CASE WHEN sum(n) FILTER (b < 7) IS NULL OR {q} * t > sum(n) FILTER (b < 7) THEN 100000.0
  ELSE (SELECT lo + (hi - lo) * ({q} * t - below) / n FROM c c2 WHERE c2.cum >= {q} * t AND c2.b < 7 ORDER BY b LIMIT 1) END, 6) AS value
FROM c GROUP BY t"""


@query(f"""
, h AS (SELECT b, count(*) AS n FROM (SELECT {_BOUNDS} AS b FROM (SELECT ordinal * 7919 % 130000 AS m FROM w)) GROUP BY b),
c AS (SELECT b, n, sum(n) OVER (ORDER BY b) AS cum, sum(n) OVER (ORDER BY b) - n AS below, sum(n) OVER () AS t,
      CASE WHEN b = 0 THEN 0.0 ELSE [100.0, 500, 1000, 5000, 10000, 50000, 100000][b] END AS lo, [100.0, 500, 1000, 5000, 10000, 50000, 100000][b + 1] AS hi FROM h)
""" + " UNION ALL ".join(_quantile_sql(q) for q in (0.5, 0.9, 0.99)))
def cdc_latency_quantiles(spark, sf_dir):
    h = metrics.histogram(_latencies(spark, sf_dir), "micros", metrics.BATCH_MICROS)
    out = None
    for q in (0.5, 0.9, 0.99):
        one = metrics.histogram_quantile(h, q, metrics.BATCH_MICROS).select(F.lit(q).alias("q"), F.round("value", 6).alias("value"))
        out = one if out is None else out.union(one)
    return out


@query('SELECT tbl AS "table", epoch_us(time_bucket(INTERVAL 1 minute, ts)) AS start, count(*) AS n, count(*) / 60.0::DOUBLE AS per_second FROM w GROUP BY ALL')
def cdc_rate_per_minute(spark, sf_dir):
    r = metrics.rate(log_of(spark, sf_dir), "ts", by=("table",))
    return r.withColumn("start", F.unix_micros("start"))


@query("""
SELECT "table", start, round((total - lag(total) OVER (PARTITION BY "table" ORDER BY start)) / nullif((start - lag(start) OVER (PARTITION BY "table" ORDER BY start)) / 1e6, 0), 6) AS rate
FROM (SELECT "table", start, sum(n) OVER (PARTITION BY "table" ORDER BY start) AS total
      FROM (SELECT tbl AS "table", epoch_us(time_bucket(INTERVAL 1 hour, ts)) AS start, count(*) AS n FROM w GROUP BY ALL))
""")
def cdc_counter_rate(spark, sf_dir):
    r = metrics.rate(log_of(spark, sf_dir), "ts", "1 hour", 3600, ("table",))
    r = r.withColumn("total", F.sum("n").over(Window.partitionBy("table").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)))
    return metrics.counter_rate(r, "table", "start", "total").select("table", F.unix_micros("start").alias("start"), F.round("rate", 6).alias("rate"))


@query('SELECT tbl AS "table", max_by(lag_ms, ordinal) AS last_lag_ms, max(lag_ms) AS max_lag_ms FROM (SELECT *, ordinal * 31 % 5000 AS lag_ms FROM q) GROUP BY tbl')
def cdc_replication_lag(spark, sf_dir):
    log = log_of(spark, sf_dir)
    ingested = F.timestamp_micros(F.unix_micros("commit_time") + F.col("ordinal") * 31 % 5000 * 1000)
    lag = log.select("table", "ordinal", metrics.lag_ms(ingested, F.col("commit_time")).alias("lag_ms"))
    last = metrics.last_value(lag, "lag_ms", "ordinal", ("table",)).withColumnRenamed("value", "last_lag_ms")
    return last.join(lag.groupBy("table").agg(F.max("lag_ms").alias("max_lag_ms")), "table")


@query("""
SELECT op, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM w), 6)::DOUBLE AS percent,
       round(count(*) / ((SELECT epoch_us(max(ts)) - epoch_us(min(ts)) FROM w) / 1e6), 9) AS per_second FROM w GROUP BY op
""")
def cdc_op_mix(spark, sf_dir):
    per = log_of(spark, sf_dir).groupBy("op").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("a"), F.max("ts").alias("b"))
    # three or four rows, one for each kind of operation
    per = per.agg(F.sum("n").alias("t"), F.min("a").alias("a"), F.max("b").alias("b"), F.collect_list(F.struct("op", "n")).alias("x"))
    per = per.select("t", ((F.unix_micros("b") - F.unix_micros("a")) / 1e6).alias("s"), F.inline("x"))
    return per.select("op", "n", F.round(100.0 * F.col("n") / F.col("t"), 6).alias("percent"), F.round(F.col("n") / F.col("s"), 9).alias("per_second"))


@query("SELECT ordinal, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM w")
def cdc_event_props(spark, sf_dir):
    return log_of(spark, sf_dir).select("ordinal", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("SELECT event_id, op, txid, tbl, ordinal AS id, concat('cdc.', lower(op)) AS event_type, CAST(txid AS VARCHAR) AS meta_txid, op <> 'DELETE' AS has_after, op <> 'INSERT' AS has_before FROM (SELECT * REPLACE (concat(lsn, ':', txid, ':', op, ':public.', tbl, ':0') AS event_id) FROM e)")
def cdc_envelope_json(spark, sf_dir):
    """The serialized envelope, read back from its JSON."""
    n = serialized(normalize(json_messages.decode(as_json_messages(log_of(spark, sf_dir))), DATABASE))
    p = lambda path: F.get_json_object("payload", path)
    return n.select(
        p("$.event_id").alias("event_id"),
        p("$.operation").alias("op"),
        p("$.txid").cast("long").alias("txid"),
        p("$.table").alias("tbl"),
        F.coalesce(p("$.after.id"), p("$.before.id")).cast("long").alias("id"),
        p("$.event_type").alias("event_type"),
        p("$.metadata.txid").alias("meta_txid"),
        p("$.after").isNotNull().alias("has_after"),
        p("$.before").isNotNull().alias("has_before"),
    )


@query("""
SELECT event_id, concat('{"event_id":"', event_id, '","event_type":"cdc.', lower(op), '","source":"shop","timestamp":"', shown, '","commit_time":"', shown, '","lsn":"', lsn, '","txid":', txid,
  ',"schema":"public","table":"', tbl, '","operation":"', op, '",', CASE WHEN op <> 'INSERT' THEN concat('"before":{"id":', ordinal, '},') ELSE '' END,
  CASE WHEN op <> 'DELETE' THEN concat('"after":{"Z":null,"id":', ordinal, ',"note":"\\u003ca \\u0026 b\\u003e","user_id":', user_id, '},') ELSE '' END, '"metadata":{"txid":"', txid, '"}}') AS payload
FROM (SELECT *, concat(strftime(ts, '%Y-%m-%dT%H:%M:%S'), rtrim(rtrim(strftime(ts, '.%f'), '0'), '.'), 'Z') AS shown FROM e)
""")
def cdc_envelope_bytes(spark, sf_dir):
    """The serialized envelope byte by byte: sorted names, escapes, nulls within images, times without idle digits."""
    v = lambda c: c.cast("variant")
    key = F.create_map(F.lit("id"), v(F.col("ordinal")))
    after = F.create_map(F.lit("user_id"), v(F.col("user_id")), F.lit("note"), v(F.lit("<a & b>")), F.lit("id"), v(F.col("ordinal")), F.lit("Z"), F.lit(None).cast("variant"))
    images = {"old_values": F.when(F.col("op") != "INSERT", key), "new_values": F.when(F.col("op") != "DELETE", after)}
    e = events_of(spark, sf_dir).withColumns({**images, "timestamp": F.col("ts"), "commit_time": F.col("ts")})
    return serialized(normalize(e, DATABASE)).select("event_id", "payload")


@query("""
SELECT ordinal, concat(hex(ordinal * 3), '/', hex(ordinal * 7919)) AS lsn, CAST(CAST(ordinal * 3 AS HUGEINT) * 4294967296 + ordinal * 7919 AS VARCHAR) AS number,
       CASE WHEN ordinal % 10 = 0 THEN '0' ELSE CAST(CAST(ordinal * 3 AS HUGEINT) * 4294967296 + ordinal * 7919 AS VARCHAR) END AS start_at FROM w
""")
def cdc_lsn_roundtrip(spark, sf_dir):
    """Positions given by their halves; from ordinal 542,363 on the low one has nine digits, which are read as they stand."""
    rows = log_of(spark, sf_dir).select("ordinal", lsn_halves(F.col("ordinal") * 3, F.col("ordinal") * 7919).alias("lsn"))
    given = F.when(F.col("ordinal") % 10 == 0, F.lit("not a position")).otherwise(F.col("lsn"))
    return rows.select("ordinal", "lsn", lsn_number(F.col("lsn")).cast("string").alias("number"), start_position(given).cast("string").alias("start_at"))


@query("SELECT n_nationkey, list_filter([trim(x) FOR x IN string_split(concat(n_name, ' ,, ', lower(n_name), ' , '), ',')], lambda x: x <> '') AS items, lower(n_name) AS db FROM nation")
def cdc_text_settings(spark, sf_dir):
    n = spark.read.parquet(f"{sf_dir}/nation.parquet")
    items = names.csv_items(F.concat("n_name", F.lit(" ,, "), F.lower("n_name"), F.lit(" , ")))
    url = F.concat(F.lit("postgres://u:p@host:5432/"), F.lower("n_name"), F.lit("?sslmode=off"))
    return n.select("n_nationkey", items.alias("items"), names.url_database(url).alias("db"))


@query("""
SELECT slot, CASE WHEN max(n) IS NULL THEN '' ELSE concat(hex(max(n) // 4294967296), '/', hex(max(n) % 4294967296)) END AS lsn
FROM (SELECT txid % 5 AS slot, CASE WHEN txid % 5 <> 3 THEN 4294967296 * (txid % 20) + (txid * 7919) % 65536 END AS n FROM q) GROUP BY slot
""")
def cdc_slot_position(spark, sf_dir):
    """The position that each slot resumes from, of rows as the database gives them; one without a position has the empty text."""
    t = log_of(spark, sf_dir).select("txid").distinct()
    n = 4294967296 * (F.col("txid") % 20) + (F.col("txid") * 7919) % 65536
    rows = t.select((F.col("txid") % 5).alias("slot"), F.when(F.col("txid") % 5 != 3, lsn_text(n)).alias("lsn"))
    return capture.confirmed(rows)


@query("""
SELECT txid, CASE WHEN txid % 2 = 0 THEN lsn_num ELSE lsn_num + 8 END AS position FROM (SELECT DISTINCT txid, lsn_num FROM q)
""")
def cdc_checkpoint_positions(spark, sf_dir):
    t = log_of(spark, sf_dir).select("txid", "lsn_num").distinct()
    end = F.when(F.col("txid") % 2 == 0, F.lit(0).cast("long")).otherwise(F.col("lsn_num") + 8)
    return t.select("txid", checkpoint_position(F.col("lsn_num"), end).alias("position"))


@query("SELECT count(*) AS n, min(ordinal) AS first FROM w WHERE ts > (SELECT max(ts) FROM w) - INTERVAL 72 hours")
def cdc_retention(spark, sf_dir):
    log = log_of(spark, sf_dir)
    now = F.lit(log.agg(F.max("ts")).first()[0])
    return replay.retained(log, "ts", now, 72 * 3600).agg(F.count(F.lit(1)).alias("n"), F.min("ordinal").alias("first"))


@query('SELECT user_id, tbl AS "table", ordinal, op, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, tbl ORDER BY ordinal DESC) AS r FROM w) WHERE r = 1 AND op <> \'DELETE\'')
def cdc_current_state(spark, sf_dir):
    """An extension: the latest row of each user and table that isn't deleted."""
    log = log_of(spark, sf_dir).select("user_id", "table", "ordinal", "op", "value")
    return replay.current_state(log, ("user_id", "table"), ("ordinal",)).select("user_id", "table", "ordinal", "op", "value")


@query('SELECT ordinal, user_id, epoch_us(ts) AS valid_from, epoch_us(lead(ts) OVER (PARTITION BY user_id, tbl ORDER BY ordinal)) AS valid_to FROM w')
def cdc_history(spark, sf_dir):
    """An extension: validity of each version."""
    h = replay.history(log_of(spark, sf_dir), ("user_id", "table"), ("ordinal",), "ts")
    return h.select("ordinal", "user_id", F.unix_micros("valid_from").alias("valid_from"), F.unix_micros("valid_to").alias("valid_to"))


@query("""
SELECT c_mktsegment, op, count(*) AS n, round(sum(value), 4) AS total FROM w JOIN customer ON c_custkey = user_id GROUP BY ALL
""")
def cdc_customer_changes(spark, sf_dir):
    """An extension: changes joined with customers."""
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_mktsegment")
    j = log_of(spark, sf_dir).join(c, F.col("user_id") == F.col("c_custkey"))
    return j.groupBy("c_mktsegment", "op").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("SELECT subject, CAST(count(*) AS BIGINT) AS n, min(event_id) AS least, true AS in_order FROM e GROUP BY subject")
def cdc_ordered_publish(spark, sf_dir):
    """Events as a writer's task gets them: by subject, in log order. in_order is what each task finds in its rows."""
    o = pub.ordered(events_of(spark, sf_dir).select("subject", "event_id", "lsn_num", "seq"))

    def run(batches):
        import pyarrow as pa

        found: dict = {}
        for b in batches:
            for s, e, lsn, seq in zip(*(c.to_pylist() for c in b.columns)):
                n, least, last, ok = found.get(s, (0, e, (-1, -1), True))
                found[s] = n + 1, min(least, e), (lsn, seq), ok and last < (lsn, seq)
        rows = [(s, n, least, ok) for s, (n, least, _, ok) in found.items()]
        cols = list(zip(*rows)) if rows else [[]] * 4
        types = (pa.string(), pa.int64(), pa.string(), pa.bool_())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["subject", "n", "least", "in_order"])

    return o.mapInArrow(run, "subject string, n long, least string, in_order boolean")
