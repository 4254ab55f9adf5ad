import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import DataFrameReader, DataFrameWriter
from pyspark.sql import functions as F

from estrato.plans import silver
from estrato.session import path_exists
from estrato.sources.layers import read_layer, read_table
from estrato.streaming.events import FIELDS, decode, given_fields, has_required, parse_events, split_valid
from estrato.sources.lineage import LINEAGE, add_stream_lineage
from estrato.streaming.ingest import bronze_sink, deliver, jdbc_mirror, parquet_mirror, start_ingest
from estrato.streaming.ledger import EVENT_ID, OffsetLedger, _covered, offset_ranges, write_once
from frames import plan_of

GOOD = {"ano": 2027, "sigla_uf": "TO", "serie": 4, "rede": 3, "taxa_alfabetizacao": 41.25, "media_portugues": 655.5}
CAME = datetime(2024, 5, 1, 12, 29, 59, 250000)
EVENT_SCHEMA = "topic string, partition int, offset bigint, timestamp timestamp_ntz, value binary"
AT = datetime(2024, 5, 1, 9, 30, tzinfo=timezone(timedelta(hours=-3)))


def _raw(spark, *payloads):
    rows = []
    for offset, payload in enumerate(payloads):
        if isinstance(payload, dict):
            payload = json.dumps(payload)
        value = payload if payload is None or isinstance(payload, bytes) else payload.encode()
        rows.append(("events", 0, offset, CAME, None if value is None else bytearray(value)))
    return spark.createDataFrame(rows, EVENT_SCHEMA)


def _parse(spark, payload):
    return parse_events(_raw(spark, payload)).first()


def test_decode_valid_payload(spark):
    decoded = _raw(spark, b'{"rede": 3, "x": [true]}').select(decode(F.col("value")).cast("string").alias("v")).first().v
    assert json.loads(decoded) == {"rede": 3, "x": [True]}


@pytest.mark.parametrize("payload", [b'{"rede": 3', None, b"\xff\xfe", b""])
def test_decode_invalid_payload(spark, payload):
    assert _raw(spark, payload).select(decode(F.col("value")).isNull().alias("n")).first().n
    assert _parse(spark, payload).reject_reason == "decode"


@pytest.mark.parametrize(
    ("payload", "valid"),
    [(GOOD, True), ({"serie": 4, "rede": 3}, False), ({**GOOD, "taxa_alfabetizacao": None}, False)],
)
def test_required_fields(spark, payload, valid):
    rule = has_required(given_fields(decode(F.col("value"))))
    assert bool(_raw(spark, payload).select(F.coalesce(rule, F.lit(False)).alias("v")).first().v) is valid
    assert _parse(spark, payload).reject_reason == (None if valid else "required")


@pytest.mark.parametrize("payload", ["[1, 2]", "5", '"text"', "null", "{}", "true"])
def test_payloads_that_are_not_events(spark, payload):
    assert _parse(spark, payload).reject_reason == "required"


@pytest.mark.parametrize(
    ("field", "given", "stored"),
    [
        ("ano", "2023", 2023),
        ("ano", 2.7, 2),
        ("ano", -2.7, -2),
        ("ano", True, 1),
        ("ano", "2023.5", "coercion"),
        ("ano", "", "coercion"),
        ("ano", [1], "coercion"),
        ("ano", {"a": 1}, "coercion"),
        ("serie", "x", "coercion"),
        ("sigla_uf", "", ""),
        ("sigla_uf", 35, "35"),
        ("taxa_alfabetizacao", "85.5", 85.5),
        ("taxa_alfabetizacao", "abc", "coercion"),
        ("taxa_alfabetizacao", 90, 90.0),
        ("proporcao_aluno_nivel_0", 2.7, 2),
        ("proporcao_aluno_nivel_0", "2.7", "coercion"),
        ("proporcao_aluno_nivel_0", None, None),
        ("proporcao_aluno_nivel_8", "4.3", 4.3),
        ("proporcao_aluno_nivel_8", "", "coercion"),
    ],
)
def test_coercion(spark, field, given, stored):
    row = _parse(spark, {**GOOD, field: given})
    if stored == "coercion":
        assert row.reject_reason == "coercion"
    else:
        assert row.reject_reason is None
        assert row[field] == stored


def test_split_keeps_every_event(spark):
    accepted, rejected = split_valid(parse_events(_raw(spark, GOOD, "bad", {"ano": 1}, {**GOOD, "rede": "x"}, None)))
    assert accepted.count() == 1
    reasons = {r.offset: r.reject_reason for r in rejected.collect()}
    assert reasons == {1: "decode", 2: "required", 3: "coercion", 4: "decode"}
    assert set(rejected.columns) == {"topic", "partition", "offset", "timestamp", "value", "reject_reason"}


def _file_stream(spark, folder):
    return spark.readStream.schema(EVENT_SCHEMA).parquet(folder)


def _appender(path):
    def append(batch, batch_id):
        batch.write.mode("append").parquet(path)

    return append


def test_stream_survives_a_restart_without_repeating_events(spark, cfg, tmp_path):
    source, mirror, rejects = (str(tmp_path / n) for n in ("source", "mirror", "rejects"))

    def run():
        query = start_ingest(
            _file_stream(spark, source),
            str(tmp_path / "checkpoint"),
            mirror=_appender(mirror),
            bronze=bronze_sink(cfg, "uf", lambda: AT),
            rejects=_appender(rejects),
            available_now=True,
        )
        assert query.awaitTermination(120)

    _raw(spark, GOOD, "bad").write.parquet(source)
    run()
    run()
    _raw(spark, {**GOOD, "taxa_alfabetizacao": 90}).withColumn("offset", F.lit(7)).write.mode("append").parquet(source)
    run()
    bronze = read_layer(spark, cfg, "bronze", "uf_stream")
    assert sorted(r._execution_id for r in bronze.collect()) == [
        "stream_20240501T093000Z_offset0",
        "stream_20240501T093000Z_offset7",
    ]
    first = bronze.first()
    assert (first._source_system, first._ingestion_date) == ("kafka_stream", "2024-05-01")
    assert first._ingestion_timestamp_utc == "2024-05-01T09:29:59.250000-03:00"
    assert read_table(spark, mirror).count() == 2
    assert [r.reject_reason for r in read_table(spark, rejects).collect()] == ["decode"]
    # Both events have one key; silver keeps the later one.
    (row,) = silver.build(silver.UF, bronze).collect()
    assert row.taxa_alfabetizacao_pct == 90.0


def test_a_failing_mirror_keeps_the_batch_out_of_bronze(spark):
    written = []

    def broken(batch, batch_id):
        raise OSError("mirror is down")

    with pytest.raises(OSError, match="mirror"):
        deliver(_raw(spark, GOOD), 0, mirror=broken, bronze=lambda b, i: written.append(i), rejects=None)
    assert written == []


def test_a_failing_bronze_write_is_tolerated_only_on_request_and_behind_a_mirror(spark):
    mirrored, rejected = [], []

    def broken(batch, batch_id):
        raise OSError("bronze is down")

    def deliver_with(**sinks):
        deliver(_raw(spark, GOOD, "bad"), 3, bronze=broken, rejects=lambda b, i: rejected.append(b.count()), **sinks)

    deliver_with(mirror=lambda b, i: mirrored.append((i, b.count())), bronze_may_fail=True)
    assert mirrored == [(3, 1)]
    assert rejected == [1]
    with pytest.raises(OSError):
        deliver_with(mirror=None)
    with pytest.raises(OSError):
        deliver_with(mirror=lambda b, i: None)


def test_micro_batches_are_released(spark):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    deliver(_raw(spark, GOOD), 0, mirror=lambda b, i: b.count(), bronze=None, rejects=None)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_the_jdbc_mirror_appends_event_ids_and_the_15_business_columns(spark, monkeypatch):
    calls = []
    empty = spark.createDataFrame([], "topic string, partition int, offset bigint")
    monkeypatch.setattr(DataFrameReader, "jdbc", lambda self, url, table, properties=None: empty)
    monkeypatch.setattr(
        DataFrameWriter,
        "jdbc",
        lambda self, url, table, mode=None, properties=None: calls.append(
            (self._df.columns, url, table, mode, properties)
        ),
    )
    mirror = jdbc_mirror("jdbc:x://db/mirror", "uf", {"user": "u"})
    deliver(_raw(spark, GOOD), 0, mirror=mirror, bronze=None, rejects=None)
    assert calls == [([*EVENT_ID, *FIELDS], "jdbc:x://db/mirror", "uf", "append", {"user": "u"})]
    assert len(FIELDS) == 15


@pytest.mark.parametrize("partitions", [1, 2])
def test_the_newest_event_of_a_key_wins_inside_one_batch(spark, partitions):
    events = spark.createDataFrame(
        [("events", n % partitions, n, CAME, bytearray(json.dumps({**GOOD, "taxa_alfabetizacao": n}).encode()))
         for n in (9, 100, 8, 11, 10)],
        EVENT_SCHEMA,
    )
    accepted, _ = split_valid(parse_events(events))
    bronze = add_stream_lineage(accepted, "uf", AT).select(*FIELDS, *LINEAGE)
    (row,) = silver.build(silver.UF, bronze).collect()
    assert (row.taxa_alfabetizacao_pct, row._execution_id) == (100.0, "stream_20240501T093000Z_offset100")


def test_arrival_comes_before_offsets_of_another_partition(spark):
    late, early = datetime(2024, 5, 1, 12, 0, 1), datetime(2024, 5, 1, 12, 0, 0)
    events = spark.createDataFrame(
        [("events", 0, 5, late, bytearray(json.dumps({**GOOD, "taxa_alfabetizacao": 5}).encode())),
         ("events", 1, 900, early, bytearray(json.dumps({**GOOD, "taxa_alfabetizacao": 9}).encode()))],
        EVENT_SCHEMA,
    )
    accepted, _ = split_valid(parse_events(events))
    (row,) = silver.build(silver.UF, add_stream_lineage(accepted, "uf", AT).select(*FIELDS, *LINEAGE)).collect()
    assert row.taxa_alfabetizacao_pct == 5.0


def test_a_batch_that_is_delivered_again_leaves_no_event_twice(spark, tmp_path):
    mirror = parquet_mirror(str(tmp_path / "mirror"))
    for batch in (_raw(spark, GOOD), _raw(spark, GOOD, {**GOOD, "ano": 2028}), _raw(spark, GOOD, {**GOOD, "ano": 2028})):
        deliver(batch, 0, mirror=mirror, bronze=None, rejects=None)
    assert sorted(r.offset for r in read_table(spark, str(tmp_path / "mirror")).collect()) == [0, 1]


def test_rejects_without_a_sink_are_counted_and_logged(spark, caplog):
    with caplog.at_level("WARNING"):
        deliver(_raw(spark, GOOD, "bad", "worse", {"ano": 1}), 7, mirror=None, bronze=None, rejects=None)
    told = [r.getMessage() for r in caplog.records if "rejected" in r.getMessage()]
    assert sorted(told) == [
        "micro-batch 7: 1 events rejected (required)", "micro-batch 7: 2 events rejected (decode)",
    ]


def _spied(path, ledger, read, fail=()):
    """A mirror with a ledger that notes what it reads and writes; ``fail`` names writes that break half-way."""
    written = []

    def append(batch, batch_id):
        def held():
            read.append(batch_id)
            return read_table(batch.sparkSession, path) if path_exists(batch.sparkSession, path) else None

        def write(rows):
            half = rows.where("offset % 2 = 0") if batch_id in fail else rows
            half.write.mode("append").parquet(path)
            if batch_id in fail:
                raise OSError("connection lost")
            written.append(rows.count())

        write_once(batch.select(*EVENT_ID, *FIELDS), batch_id, OffsetLedger(ledger), held, write)

    return append, written


def _events(spark, *places):
    return spark.createDataFrame(
        [("events", p, n, CAME, bytearray(json.dumps({**GOOD, "ano": 2000 + n}).encode())) for p, n in places], EVENT_SCHEMA
    )


def test_a_ledger_knows_a_repeated_batch_without_reading_the_mirror(spark, tmp_path):
    path, read = str(tmp_path / "mirror"), []
    mirror, written = _spied(path, str(tmp_path / "ledger"), read)
    batches = [[(0, 1), (0, 2), (1, 900)], [(0, 3), (0, 5), (1, 901)]]
    for number, places in enumerate(batches):
        deliver(_events(spark, *places), number, mirror=mirror, bronze=None, rejects=None)
    deliver(_events(spark, *batches[1]), 1, mirror=mirror, bronze=None, rejects=None)
    assert (read, written) == ([], [3, 3])
    # Offset 4 lies between written ones but never came; offset 2 comes again with it, and twice.
    deliver(_events(spark, (0, 4), (0, 2), (0, 2), (1, 4)), 2, mirror=mirror, bronze=None, rejects=None)
    assert (read, written) == ([], [3, 3, 2])
    held = [(r.partition, r.offset) for r in read_table(spark, path).collect()]
    assert sorted(held) == [(0, 1), (0, 2), (0, 3), (0, 4), (0, 5), (1, 4), (1, 900), (1, 901)]


def test_a_write_that_broke_half_way_is_completed(spark, tmp_path):
    path, ledger, read = str(tmp_path / "mirror"), str(tmp_path / "ledger"), []
    broken, _ = _spied(path, ledger, read, fail={7})
    places = [(0, n) for n in range(6)] + [(1, 40), (1, 41)]
    with pytest.raises(OSError):
        deliver(_events(spark, *places), 7, mirror=broken, bronze=None, rejects=None)
    mirror, written = _spied(path, ledger, read)
    deliver(_events(spark, *places, (0, 6)), 7, mirror=mirror, bronze=None, rejects=None)
    assert (read, written) == ([7], [5])
    deliver(_events(spark, *places, (0, 6)), 8, mirror=mirror, bronze=None, rejects=None)
    assert (read, written) == ([7], [5])
    assert read_table(spark, path).count() == 9


def test_ranges_have_no_gaps(spark):
    events = spark.createDataFrame([("t", 0, n) for n in (1, 2, 3, 3, 7, 9, 10)] + [("u", 0, 2)], "topic string, partition int, offset long")
    found = sorted((r.topic, r.low, r.high) for r in offset_ranges(events).collect())
    assert found == [("t", 1, 3), ("t", 7, 7), ("t", 9, 10), ("u", 2, 2)]


def test_a_ledger_of_scattered_offsets_is_never_paired_with_the_events(spark, tmp_path):
    # Every second offset and block borders: the ranges are as many as the events.
    some = spark.range(0, 400_000, 2).selectExpr("'events' AS topic", "CAST(id % 4 AS INT) AS partition", "id AS offset")
    schema = "topic string, partition int, offset long"
    edges = spark.createDataFrame([("events", 9, n) for n in (-70_000, -1, 0, 65_535, 65_536, 131_072)] + [(None, 1, 7)], schema)
    first = some.union(edges)
    again = first.union(first).union(
        spark.createDataFrame([("events", 9, -2), ("events", 9, 65_537), (None, 1, 8), ("events", 1, None)], schema)
    )
    written = []

    def write(rows):
        plan = plan_of(rows)
        assert "Join" not in plan, plan
        written.append(sorted((r.topic or "", r.partition, r.offset or 0) for r in rows.where("partition in (1, 9)").collect()))

    for number, events in enumerate((first, again)):
        write_once(events, number, OffsetLedger(str(tmp_path / "ledger")), lambda: None, write)
    assert written[0] == sorted([("events", 9, n) for n in (-70_000, -1, 0, 65_535, 65_536, 131_072)] + [("", 1, 7)])
    assert written[1] == [("", 1, 8), ("events", 1, 0), ("events", 9, -2), ("events", 9, 65_537)]


def test_a_range_over_several_blocks_covers_all_of_its_offsets(spark):
    ranges = spark.createDataFrame([("t", 0, 5, 200_000), ("t", 0, 10, 12), ("t", 1, None, None)], "topic string, partition int, low long, high long")
    places = [("t", 0, n) for n in (4, 5, 11, 70_000, 140_000, 200_000, 200_001)] + [("t", 1, 9), ("u", 0, 9)]
    events = spark.createDataFrame(places, "topic string, partition int, offset long")
    outside = {tuple(r) for r in _covered(events, ranges, False).collect()}
    assert outside == {("t", 0, 4), ("t", 0, 200_001), ("t", 1, 9), ("u", 0, 9)}
    assert {tuple(r) for r in _covered(events, ranges, True).collect()} == set(places) - outside
