"""Small cases of the building blocks."""

import json
import struct

import pytest
from pyspark.sql import functions as F

from tidelog import config
from tidelog.functions import names
from tidelog.functions.lsn import lsn_number, lsn_text
from tidelog.functions.times import change_time
from tidelog.operators import metrics, publish
from tidelog.sources import binary_messages, capture, json_messages
from tidelog.streaming import run


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


@pytest.mark.parametrize(
    "text, micros, bad",
    [
        (None, None, False),
        ("", None, False),
        ("null", None, False),
        ("2024-01-15T10:30:00Z", 1705314600000000, False),
        ("2024-01-15 10:30:00.123456-05:00", 1705332600123456, False),
        ("2024-01-15 10:30:00-05", 1705332600000000, False),
        ("2024-01-15", None, True),
        ("2024-01-15 10:30:00", None, True),
        ("not-a-date", None, True),
    ],
)
def test_change_time(spark, text, micros, bad):
    time, error = change_time(F.lit(text).cast("string"))
    assert tuple(one(spark, F.unix_micros(time), error)) == (micros, bad)


def test_positions(spark):
    r = one(spark, lsn_number(F.lit("FFFFFFFF/FFFFFFFF")), lsn_number(F.lit("0/A")) < lsn_number(F.lit("0/10")), lsn_number(F.lit("x/1")), lsn_text(F.lit((1 << 32) + 26)))
    assert tuple(r) == ((1 << 64) - 1, True, None, "1/1A")


def test_positions_with_long_halves(spark):
    r = one(spark, lsn_number(F.lit("0/100000010")), lsn_number(F.lit("2/100000001")), lsn_number(F.lit("100000001/0")), lsn_number(F.lit("0/10000000000000000")))
    assert tuple(r) == ((1 << 32) + 16, 3 * (1 << 32) + 1, 1 << 32, None)


def test_names(spark):
    lit = F.lit
    r = one(
        spark,
        names.event_id(lit("0/16A1B8"), lit(42), lit("INSERT"), lit("public"), lit("users"), lit(0)),
        names.event_type(lit("DDL")),
        names.event_type(lit("OTHER")),
        names.dead_letter_subject(lit("cdc.dlq"), lit("appdb"), lit(""), lit("")),
        names.dead_letter_subject(lit(""), lit("db"), lit("s"), lit("bad table*")),
        names.csv_items(lit(" a, ,b ,")),
        names.url_database(lit("postgres://u@h:1/shop")),
    )
    assert tuple(r) == ("0/16A1B8:42:INSERT:public.users:0", "cdc.ddl", "cdc.unknown", "cdc.dlq.appdb._._", "_.db.s.bad_table_", ["a", "b"], "shop")


@pytest.mark.parametrize("text, size, cut", [("a" * 65636, 65636, 65536), ("small", 5, 5), ("é" * 40000, 80000, 65536), ("a" + "é" * 40000, 80001, 65535)])
def test_payload_prefix(spark, text, size, cut):
    r = spark.createDataFrame([(text,)], "p string").select(*names.payload_prefix(F.col("p"))).first()
    assert (r.payload_size, r.truncated, len(r.payload_prefix.encode())) == (size, size > 65536, cut)


def test_subject_regex():
    import re

    hit = lambda p, s: bool(re.match(names.subject_regex(p), s))
    assert hit("cdc.>", "cdc.a.b") and hit("cdc.>", "cdc") and hit(">", "x.y") and hit("a.*.c", "a.b.c")
    assert not hit("cdc.*", "cdc.a.b") and not hit("a.b", "axb") and not hit("cdc.>", "cdcx")


@pytest.mark.parametrize("subjects", [("cdc.dlq.postgres.>",), ("cdc.dlq.postgres.*.*",), ("cdc.>",), ("cdc.*.postgres.*.*",), ()])
def test_config_covered(subjects):
    config.Config(stream_subjects=subjects).validate()


@pytest.mark.parametrize("kw", [{"stream_subjects": ("cdc.postgres.>",)}, {"dlq_subject_prefix": "dead.cdc"}, {"stream_subjects": ("cdc.dlq.postgres.public.*",)}, {"dlq_subject_prefix": " "}, {"plugin": "x"}, {"batch_size": -1}, {"duplicate_window": 0}, {"publish_failure_policy": "x"}])
def test_config_rejected(kw):
    with pytest.raises(ValueError):
        config.Config(**kw).validate()


def test_config_from_environment():
    c = config.load({"DATABASE_URL": "postgres://h/shop", "BATCH_SIZE": "7", "DUPLICATE_WINDOW": "1m30s", "STREAM_SUBJECTS": "a.>, b.>,", "DEBUG": "true"})
    assert (c.database, c.batch_size, c.duplicate_window, c.stream_subjects, c.debug, c.max_pending) == ("shop", 7, 90.0, ("a.>", "b.>"), True, 256)
    assert config.load({"CDC_DATABASE_NAME": "x", "AWS_RDS_DATABASE": "y"}).database == "x"
    with pytest.raises(ValueError):
        config.load({"BATCH_SIZE": "many"})
    assert config.seconds("100ms") == 0.1


def test_json_messages(spark):
    rows = [
        ("wal2json", "0/1", 1, '{"action":"B","xid":5,"timestamp":null}'),
        ("wal2json", "0/2", 2, '{"action":"I","xid":5,"timestamp":"","schema":"s","table":"t","columns":[{"name":"a","type":"int","value":1},{"name":"a","type":"int","value":9007199254740993},{"name":"n","type":"text","value":null}]}'),
        ("pgoutput", "0/3", 3, "{}"),
        ("", "0/4", 4, '{"action":"X"}'),
        ("wal2json", "0/5", 5, '{"action":"T","schema":"s","table":"other"}'),
    ]
    m = spark.createDataFrame(rows, "plugin string, wal_start string, ordinal long, data string")
    got = {r.ordinal: r for r in json_messages.decode(m, ("s.t",)).withColumn("a", F.try_variant_get(F.try_element_at("new_values", F.lit("a")), "$", "bigint")).withColumn("has_n", F.map_contains_key("new_values", "n")).drop("old_values", "new_values").collect()}
    assert sorted(got) == [1, 2] and got[1].begin and got[2].a == 9007199254740993 and got[2].has_n
    bad = spark.createDataFrame([("wal2json", "0/1", 1, "{not-json")], m.schema)
    assert json_messages.decode(bad, fail=False).first().malformed
    with pytest.raises(Exception, match="malformed"):
        json_messages.decode(bad).collect()


def _row(kind, rel, cells, tag):
    out = tag + struct.pack(">I", rel) + kind + struct.pack(">H", len(cells))
    for c in cells:
        out += c if isinstance(c, bytes) else b"t" + struct.pack(">I", len(c)) + c.encode()
    return out


def test_binary_messages(spark):
    def relation(n, table):
        cols = b"".join(b"\0" + c.encode() + b"\0" + struct.pack(">Ii", o, -1) for c, o in (("id", 23), ("name", 25)))
        return b"R" + struct.pack(">I", n) + b"public\0" + table.encode() + b"\0d" + struct.pack(">H", 2) + cols

    log = [
        b"B" + struct.pack(">QqI", 0x20, 0, 42),
        relation(1, "a"),
        relation(2, "b"),
        _row(b"N", 1, ["7", ""], b"I"),
        _row(b"N", 1, ["x", b"n"], b"I"),
        _row(b"N", 9, ["1", "1"], b"I"),
        _row(b"N", 1, ["8", b"u"], b"U"),
        b"T" + struct.pack(">IB", 2, 0) + struct.pack(">II", 1, 2),
        b"C\0" + struct.pack(">QQq", 0x20, 0, 1000000),
    ]
    raw = spark.createDataFrame([("pgoutput", 42, i, 0, bytearray(d)) for i, d in enumerate(log)], "plugin string, txid long, ordinal long, step int, data binary")
    e = binary_messages.decode(raw)
    got = sorted((r.seq, r.op, r.table, r.lsn, r.position, r.txid, r.image) for r in e.withColumn("image", F.to_json("new_values")).drop("old_values", "new_values").collect())
    assert [g[:6] for g in got] == [(0, "INSERT", "a", "0/20", 32, 42), (1, "INSERT", "a", "0/20", 32, 42), (2, "UPDATE", "a", "0/20", 32, 42), (3, "DDL", "a", "0/20", 32, 42), (4, "DDL", "b", "0/20", 32, 42)]
    assert [json.loads(g[6]) if g[6] else None for g in got] == [{"id": 7, "name": ""}, {"id": "x", "name": None}, {"id": 8}, None, None]
    assert sorted((r.seq, r.op) for r in binary_messages.decode(raw, tables=("public.b",)).select("seq", "op").collect()) == [(0, "DDL")]


def _relation(n, table, columns):
    cols = b"".join(b"\0" + c.encode() + b"\0" + struct.pack(">Ii", o, -1) for c, o in columns)
    return b"R" + struct.pack(">I", n) + b"public\0" + table.encode() + b"\0d" + struct.pack(">H", len(columns)) + cols


def _begin(lsn, xid):
    return b"B" + struct.pack(">QqI", lsn, 0, xid)


def _commit(lsn, end):
    return b"C\0" + struct.pack(">QQq", lsn, end, 1000000)


def _raw(spark, log):
    """log: (transaction, message) in the order of the stream."""
    rows = [("pgoutput", t, i, 0, bytearray(d)) for i, (t, d) in enumerate(log)]
    return spark.createDataFrame(rows, "plugin string, txid long, ordinal long, step int, data binary")


def test_relations_hold_over_transactions(spark, tmp_path):
    """A relation that is sent once serves all later transactions, a changed one those after it, and both later micro-batches."""
    a, b = (("id", 23), ("x", 1700)), (("x", 1700), ("id", 23))
    first = [(1, _begin(16, 7)), (1, _relation(5, "t", a)), (1, _row(b"N", 5, ["1", "0.123456789012"], b"I")), (1, _commit(16, 0))]
    first += [(2, _begin(32, 8)), (2, _row(b"N", 5, ["2", "1e400"], b"I")), (2, _row(b"N", 6, ["2", "2"], b"I")), (2, _commit(32, 40))]
    second = [(3, _begin(48, 9)), (3, _row(b"N", 5, ["3", "99999999999999999999.5"], b"I")), (3, _relation(5, "t", b)), (3, _row(b"N", 5, ["4", "30"], b"I")), (3, _commit(48, 56)), (4, _begin(64, 10)), (4, _row(b"N", 5, ["5", "40"], b"I"))]

    def got(df, **kw):
        e = binary_messages.decode(df, **kw).withColumn("image", F.to_json("new_values"))
        return sorted((r.txid, r.seq, r.position, json.dumps(json.loads(r.image, parse_float=str), sort_keys=True)) for r in e.select("txid", "seq", "position", "image").collect())

    want = [(7, 0, 16, '{"id": 1, "x": "0.123456789012"}'), (8, 0, 40, '{"id": 2, "x": "1e400"}')]
    later = [(9, 0, 56, '{"id": 3, "x": "99999999999999999999.5"}'), (9, 1, 56, '{"id": 30, "x": 4}')]
    assert got(_raw(spark, first + second)) == want + later
    store = binary_messages.RelationStore(f"file://{tmp_path}/relations")
    for batch, (log, rows) in enumerate([(first, want), (second, later)]):
        for _ in range(2):  # a repeated batch finds what it found before
            known = store.known(spark, batch)
            assert got(_raw(spark, log), known=known) == rows
            history = binary_messages.relations(_raw(spark, log), ("ordinal", "step"))
            store.keep(history if known is None else known.unionByName(history), batch)
    assert got(_raw(spark, second)) == [(9, 0, 56, '{"id": 30, "x": 4}')]


def test_parsed_as_one_by_one():
    """A batch is parsed at once as message by message: all kinds of messages, empty tuples, odd kinds, bad UTF-8, cut texts."""
    import pyarrow as pa

    plain_ = [_begin(16, 7), _relation(5, "t", (("id", 23),)), _row(b"N", 5, [b"t" + struct.pack(">I", 2) + "é".encode(), b"n", b"u", ""], b"I"), _row(b"N", 6, [], b"I"), _row(b"K", 5, ["1"], b"D"), b"T" + struct.pack(">IBI", 1, 0, 5), _commit(16, 24), b"I" + struct.pack(">I", 9)]
    update = _row(b"K", 5, ["1", b"n"], b"U") + b"N" + struct.pack(">H", 1) + b"b" + struct.pack(">I", 2) + b"ab"
    odd = [_row(b"N", 5, [b"t" + struct.pack(">I", 1) + b"\xff"], b"I"), _row(b"N", 5, [b"t" + struct.pack(">I", 9) + b"ab"], b"I"), _row(b"N", 5, ["1"], b"I") + b"N" + struct.pack(">H", 0)]
    for log in ([*plain_, update, update], plain_[2:5], *[[update, o] for o in odd]):
        got = binary_messages.parsed(pa.array(log, pa.binary()))
        want = [binary_messages.parse(m) for m in log]
        for name, kind, _ in binary_messages.FIELDS:
            assert got[name].type == kind and got[name].to_pylist() == [m.get(name) for m in want], name
    with pytest.raises(struct.error):
        binary_messages.parsed(pa.array([b"I\0\0"], pa.binary()))


def test_relations_as_of_a_long_history(spark):
    """Every definition, those known before, and rows before the first and after the last; rows aren't compared with a whole history."""
    import bisect

    from tidelog.operators.transactions import relation_as_of

    places = {1: [None, *range(10, 4000, 10)], 2: [25], 3: [5, 6, 9_000_000]}
    history = spark.createDataFrame([(k, p, f"{k}:{p}") for k, ps in places.items() for p in ps], "rel long, ordinal long, name string")
    rows = [(n, n % 5) for n in (*range(0, 5000, 7), 8_999_999, 9_000_000, 9_000_001, 1 << 40)] + [(n, 3) for n in (4, 5, 6, 1 << 41)] + [(1, 1), (9, 1)]
    out = relation_as_of(spark.createDataFrame(rows, "ordinal long, rel long"), history)
    known = {k: [-1 if p is None else p for p in ps] for k, ps in places.items()}
    want = [(n, r, f"{r}:{places[r][i - 1]}") for n, r in rows if r in known and (i := bisect.bisect_right(known[r], n))]
    assert sorted(tuple(r) for r in out.select("ordinal", "rel", "name").collect()) == sorted(want)
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_truncations_in_listed_order_and_markers(spark):
    log = [(1, _begin(16, 7)), (1, _relation(1, "a", (("id", 23),))), (1, _relation(2, "b", (("id", 23),))), (1, b"T" + struct.pack(">IB", 3, 0) + struct.pack(">III", 2, 9, 1)), (1, _commit(16, 24))]
    log += [(2, _begin(32, 8)), (2, _commit(32, 40)), (3, _begin(48, 9))]
    e = binary_messages.decode(_raw(spark, log), markers=True).select("ordinal", "begin", "commit", "op", "table", "seq", "lsn", "position", "txid").collect()
    got = sorted((r.ordinal, r.begin, r.commit, r.op, r.table, r.seq, r.lsn, r.position, r.txid) for r in e)
    assert [g for g in got if g[3]] == [(3, False, False, "DDL", "b", 0, "0/10", 24, 7), (3, False, False, "DDL", "a", 1, "0/10", 24, 7)][::-1]
    assert [g for g in got if not g[3]] == [(0, True, False, None, None, None, "0/10", None, 7), (4, False, True, None, None, None, "0/10", 24, 7), (5, True, False, None, None, None, "0/20", None, 8), (6, False, True, None, None, None, "0/20", 40, 8)]
    with pytest.raises(Exception, match="cut short"):
        binary_messages.decode(_raw(spark, [(1, b"B\0\0"), (1, _commit(16, 24))]), markers=True).collect()


def test_policies(spark):
    e = spark.createDataFrame([("0", None), ("1", "max payload"), ("2", None)], "event_id string, error string")
    for policy in ("dlq", "skip"):
        good, poison = publish.split_by_policy(e, policy)
        assert sorted(r.event_id for r in good.collect()) == ["0", "2"] and [r.event_id for r in poison.collect()] == ["1"]
    with pytest.raises(Exception, match="publish failed"):
        publish.split_by_policy(e, "crash")[0].collect()
    with pytest.raises(Exception, match="publish failed"):
        publish.split_by_policy(e.withColumn("error", F.lit("timeout")), "dlq")[0].collect()


def test_retries():
    calls, waits = [], []

    def send():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("busy")

    assert publish.with_retries(send, 3, lambda e: False, waits.append) == 2 and waits == [1.0, 2.0]
    with pytest.raises(ValueError):
        publish.with_retries(lambda: (_ for _ in ()).throw(ValueError()), 3, lambda e: True, waits.append)
    assert capture.is_fatal(capture.ReplicationError("", "28P01")) and not capture.is_fatal(OSError())


def broken(mark):
    """A client that takes nothing of tables b until the file mark is there. Made here, so that workers get its code."""

    class Broken(publish.Client):
        def send(self, messages):
            import os

            def ack(subject):
                def wait_for(timeout):
                    if subject.endswith(".b") and not os.path.exists(mark):
                        raise TimeoutError("down")

                return wait_for

            return [ack(s) for s, _, _ in messages]

    return Broken


@pytest.mark.parametrize("unordered", [False, True])
def test_failed_batch_is_repeated_once_for_each_event(spark, tmp_path, unordered):
    """A sink that fails: the batch raises, and its repetition sends only what wasn't acknowledged."""
    rows = [(f"0/{i:X}", i, 7, "INSERT", "s", "ab"[i % 2], 0, None, None) for i in range(6)]
    e = spark.createDataFrame(rows, "lsn string, lsn_num long, txid long, op string, schema string, table string, seq long, old_values map<string,string>, new_values map<string,string>").withColumns({"timestamp": F.lit(None).cast("timestamp"), "commit_time": F.current_timestamp(), "begin": F.lit(False), "commit": F.lit(False)})
    c = config.Config(max_publish_retries=1, unsafe_unordered_async_publish=unordered)
    registry = metrics.Registry()
    letters = run.BatchStore(f"file://{tmp_path}/letters")
    mark = str(tmp_path / "up")
    sink = run.Delivery(broken(mark), c, f"file://{tmp_path}/results", letters, wait=lambda s: None, registry=registry)
    with pytest.raises(run.PublishError, match="down"):
        run.publish_batch(e, c, sink, letters, batch_id=4, registry=registry)
    open(mark, "w").close()
    run.publish_batch(e, c, sink, letters, batch_id=4, registry=registry)
    got = spark.read.schema(publish.DELIVERED).option("recursiveFileLookup", True).parquet(f"file://{tmp_path}/results").where("outcome = 'acked'").collect()
    assert sorted(r.event_id for r in got) == sorted(f"0/{i:X}:7:INSERT:s.{'ab'[i % 2]}:0" for i in range(6))
    v = registry.values
    assert v["cdc_publisher_jetstream_published_total"] == 6 and v["cdc_publisher_jetstream_ack_failures_total"] == 3 and v["cdc_engine_partial_batch_failures_total"] == 1
    assert v["cdc_publisher_publish_retries_total"] == (3 if unordered else 1) and sum(registry.histograms["cdc_engine_transform_latency_nanoseconds"]["counts"]) == 1


def test_repeated_batch_replaces_its_rows(spark, tmp_path):
    store = run.BatchStore(f"file://{tmp_path}/s")
    for n in (3, 3):
        store(spark.range(n), 0)
    store(spark.range(1), 1)
    assert store.read(spark, "id long").count() == 4


def test_client_choice(tmp_path):
    noop = publish.choose_client((" ",), True)()
    noop.send([("s", "p", "m")])[0](1.0)
    assert noop.last_subject == "s" and noop.ready() and run.readiness({"publisher": noop.ready()})[0] == 503
    with pytest.raises(ValueError, match="isn't allowed"):
        publish.choose_client((), False)
    folder = publish.choose_client((f"file://{tmp_path}/out",), False)()
    folder.send([("s", "p", "m")])[0](1.0)
    folder.close()
    assert [json.loads(x) for f in (tmp_path / "out").iterdir() for x in f.read_text().splitlines()] == [{"subject": "s", "payload": "p", "msg_id": "m"}]


def test_slot_checkpoint(spark):
    rows = spark.createDataFrame([("a", "0/FF"), ("a", "0/100"), ("b", None)], "slot string, lsn string")
    assert capture.slot_checkpoint(rows, "a") == "0/100" and capture.slot_checkpoint(rows, "b") == ""
    with pytest.raises(LookupError):
        capture.slot_checkpoint(rows, "c")


def test_quantile_of_empty(spark):
    e = spark.createDataFrame([], "micros long")
    h = metrics.histogram(e, "micros", (1, 2))
    assert metrics.histogram_quantile(h, 0.5, (1, 2)).first().value is None


def test_registry():
    r = metrics.Registry()
    r.observe("cdc_engine_batch_latency_microseconds", 500)
    r.observe("cdc_engine_batch_latency_microseconds", 10**6)
    r.add("cdc_engine_events_total", 3)
    text = r.text()
    assert 'le="500"} 1' in text and 'le="+Inf"} 2' in text and "cdc_engine_events_total 3" in text and len(metrics.SERIES) == 15
    assert run.readiness({"slot": "", "sink": "down", "db": "x"}) == (503, "sink: down; db: x") and run.readiness({})[0] == 200


def test_capture_stream_resumes_at_commits(spark, tmp_path):
    """Two runs on one checkpoint cover the log once; the messages after the last commit wait for it."""
    spark.dataSource.register(capture.CaptureSource)
    (tmp_path / "in").mkdir()

    def write(n, rows):
        (tmp_path / "in" / f"{n}.json").write_text("".join(json.dumps({"plugin": "wal2json", "wal_start": f"0/{o:X}", "ordinal": o, "data": "{}", "commit": c}) + "\n" for o, c in rows))

    def go():
        s = spark.readStream.format("tidelog_capture").option("path", f"file://{tmp_path}/in").load()
        q = s.writeStream.option("checkpointLocation", f"file://{tmp_path}/cp").option("path", f"file://{tmp_path}/out").trigger(availableNow=True).start()
        q.awaitTermination(120)
        return sorted(r.ordinal for r in spark.read.parquet(f"file://{tmp_path}/out").collect())

    write(0, [(0, False), (1, True), (2, False)])
    assert go() == [0, 1]
    write(1, [(3, True), (4, False)])
    assert go() == [0, 1, 2, 3]
    assert capture.position("1/A") == (1 << 32) + 10 and capture.position("?") == 0


def test_capture_feedback_and_faults(tmp_path):
    """The acknowledged position is told and found again, idle streams repeat it, bad lines are counted, new files alone are read."""
    (tmp_path / "in").mkdir()
    line = lambda o, c: json.dumps({"plugin": "pgoutput", "ordinal": o, "data64": "Qg==", "commit": c})
    (tmp_path / "in" / "0.json").write_text("\n".join([line(0, False), "{bad", '{"keepalive": "0/1"}', line(1, True), line(2, False)]))
    now, options = [0.0], {"path": f"file://{tmp_path}/in", "ackPath": f"file://{tmp_path}/ack"}
    with pytest.warns(UserWarning, match="read from its begin"):
        r = capture.CaptureReader(options, lambda: now[0])
    assert r.initialOffset() == {"ordinal": -1} and r.latestOffset() == {"ordinal": 1} and r.bad_lines == 1
    (tmp_path / "in" / "1.json").write_text("\n".join([line(3, True), line(4, True)]))
    opened, rows = [], r._rows
    r._rows = lambda p: opened.append(p) or rows(p)
    assert r.latestOffset() == {"ordinal": 4} and [p[-6:] for p in opened] == ["1.json"]
    parts = r.partitions({"ordinal": 1}, {"ordinal": 4})
    assert [x[2:] for p in parts for x in r.read(p)] == [(2, b"B", False, 2), (3, b"B", True, 2), (4, b"B", True, 4)]
    r.commit({"ordinal": 4})
    r.commit({"ordinal": 1})
    told = lambda: json.loads((tmp_path / "ack").read_text())
    assert told()["ordinal"] == 4
    now[0] = 50.0
    r.latestOffset()
    assert told()["at"] == 50.0 and capture.CaptureReader(options).initialOffset() == {"ordinal": 4}
    (tmp_path / "in" / "2.json").write_text('{"error": "terminating", "sqlstate": "57P01"}')
    with pytest.raises(capture.ReplicationError) as e:
        r.latestOffset()
    assert capture.is_fatal(e.value)


def test_capture_reads_small_files_together(tmp_path, monkeypatch):
    """A task reads files up to a number of lines, each with the transaction that is open at its begin; a larger file is a task's alone."""
    line = lambda o, c: json.dumps({"plugin": "pgoutput", "ordinal": o, "data64": "Qg==", "commit": c})
    files = [[(0, False), (1, False)], [(2, True), (3, False)], [(4, False)], [(5, False), (6, True), (7, False), (8, True), (9, True)], [(10, True)], [(11, False)]]
    for n, rows in enumerate(files):
        (tmp_path / f"{n}.json").write_text("\n".join(line(*r) for r in rows))
    monkeypatch.setattr(capture, "TASK_LINES", 4)
    r = capture.CaptureReader({"path": f"file://{tmp_path}", "plugin": "pgoutput"})
    parts = r.partitions({"ordinal": -1}, r.latestOffset())
    assert [[f.rpartition("/")[2] for f, _ in p.files] for p in parts] == [["0.json", "1.json"], ["2.json"], ["3.json"], ["4.json"]]
    got = [(x[2], x[5]) for p in parts for x in r.read(p)]
    assert got == [(0, 0), (1, 0), (2, 0), (3, 3), (4, 3), (5, 3), (6, 3), (7, 7), (8, 7), (9, 9), (10, 10)]


def test_capture_offers_never_go_back(tmp_path):
    """A limited reader that starts anew goes on from what was offered, not from the begin."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "0.json").write_text("\n".join(json.dumps({"ordinal": i, "data": "", "commit": True}) for i in range(6)))
    options = {"path": f"file://{tmp_path}/in", "ackPath": f"file://{tmp_path}/ack", "maxTransactions": "2"}
    with pytest.warns(UserWarning):
        assert [capture.CaptureReader(options).latestOffset()["ordinal"] for _ in range(4)] == [1, 3, 5, 5]
    with pytest.raises(ValueError, match="ackPath"):
        capture.CaptureReader(options | {"ackPath": ""})


def test_sink_description(spark, tmp_path):
    path = f"file://{tmp_path}/sink"
    publish.ensure_table(spark, path, {"storage": "file"})
    publish.ensure_table(spark, path, {"storage": "file"})
    with pytest.raises(ValueError, match="storage"):
        publish.ensure_table(spark, path, {"storage": "memory"})
