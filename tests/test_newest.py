import json
import random
from datetime import datetime, timedelta, timezone

from estrato.plans import silver
from estrato.sources.layers import read_layer, read_table, stream_table
from estrato.sources.lineage import LINEAGE, add_stream_lineage
from estrato.streaming.events import FIELDS, parse_events, split_valid
from estrato.streaming.ingest import bronze_sink, start_ingest
from estrato.streaming.newest import newest_only

SCHEMA = "topic string, partition int, offset bigint, timestamp timestamp, value binary"
START = datetime(2024, 5, 1, 12)
AT = datetime(2024, 5, 1, 9, 30, tzinfo=timezone(timedelta(hours=-3)))


def _event(year, minute, offset, partition=0, value=None, state="TO"):
    body = {
        "ano": year, "sigla_uf": state, "serie": 2, "rede": 5, "taxa_alfabetizacao": 10.0 + minute % 80,
        "media_portugues": 700 + offset,
    }
    came = None if minute is None else START + timedelta(minutes=minute)
    return ("events", partition, offset, came, bytearray(value or json.dumps(body).encode()))


class Feed:
    """A stream over files; every file is a micro-batch of its own."""

    def __init__(self, spark, cfg, folder, **how):
        self.spark, self.cfg, self.folder, self.how = spark, cfg, str(folder), how
        self.batches = 0
        self.progress = []

    def give(self, *batches):
        for rows in batches:
            frame = self.spark.createDataFrame(rows, SCHEMA).coalesce(1)
            frame.write.parquet(f"{self.folder}/in/{self.batches:03}")
            self.batches += 1
            raw = self.spark.readStream.schema(SCHEMA).option("recursiveFileLookup", True).parquet(f"{self.folder}/in")
            query = start_ingest(
                newest_only(raw, silver.UF.key, **self.how), f"{self.folder}/checkpoint",
                bronze=bronze_sink(self.cfg, "uf", lambda: AT), available_now=True,
            )  # started anew for each batch: the state comes from the checkpoint
            query.awaitTermination()
            self.progress.append(query.recentProgress[-1])

    def passed(self):
        rows = read_table(self.spark, self.cfg.path("bronze", stream_table("uf"))).collect()
        return sorted(int(r._execution_id.rpartition("offset")[2]) for r in rows)

    def kept(self):
        return self.progress[-1]["stateOperators"][0]["numRowsTotal"]


def _batch_result(spark, rows):
    accepted, _ = split_valid(parse_events(spark.createDataFrame(rows, SCHEMA)))
    return silver.build(silver.UF, add_stream_lineage(accepted, "uf", AT).select(*FIELDS, *LINEAGE))


def test_state_over_shuffled_repeated_and_late_events_equals_the_batch(spark, cfg, tmp_path):
    draw = random.Random(7)
    rows = [
        _event(draw.choice([2024, 2024, 2024, 2025, 2026]), draw.randrange(40), n, n % 3, state=draw.choice(["TO", " to", "AC"]))
        for n in range(240)
    ]
    rows += [("events", 2, 900, START, bytearray(b"no json")), ("events", 1, 901, START, None)]
    rows += [_event(2024, 39, 5000, 0), _event(2024, 39, 5000, 1)]  # equal arrival and offset in two partitions
    draw.shuffle(rows)
    feed = Feed(spark, cfg, tmp_path, lateness="5 minutes", idle_ms=1, spread=2)
    feed.give(rows[:100], rows[60:180], rows[180:], rows[:30])
    stored = read_layer(spark, cfg, "bronze", stream_table("uf"))
    found = silver.build(silver.UF, stored)
    assert sorted(map(str, found.collect())) == sorted(map(str, _batch_result(spark, rows).collect()))
    assert stored.count() < 120  # of 394 that came


def test_outdated_events_stop_and_a_restart_remembers(spark, cfg, tmp_path):
    feed = Feed(spark, cfg, tmp_path, spread=1)
    feed.give(
        [_event(2024, 5, 1), _event(2024, 9, 2), _event(2025, 1, 3)],
        [_event(2024, 8, 4), _event(2025, 1, 2)],  # earlier arrival; same arrival, smaller offset
        [_event(2024, 9, 2), _event(2024, 10, 5), _event(2024, 10, 5)],
    )
    assert feed.passed() == [2, 3, 5]
    assert feed.kept() == 2


def test_state_expires_behind_the_watermark_and_late_events_still_pass(spark, cfg, tmp_path):
    feed = Feed(spark, cfg, tmp_path, lateness="10 minutes", idle_ms=1, spread=1)
    feed.give([_event(2024, 0, 1), _event(2025, 100, 2)])
    assert feed.kept() == 2
    feed.give([_event(2026, 100, 3)], [_event(2026, 101, 4)])
    assert feed.kept() == 2  # 2024 lies behind minute 90, 2025 does not
    feed.give([_event(2024, 50, 5), _event(2025, 40, 6)])  # both behind the watermark
    assert feed.passed() == [1, 2, 3, 4, 5]


def test_events_without_an_arrival_pass_and_leave_the_state_alone(spark, cfg, tmp_path):
    feed = Feed(spark, cfg, tmp_path, spread=1)
    undated = ("events", 0, 7, None, _event(2024, 0, 7)[4])
    feed.give([_event(2024, 5, 1), undated], [undated, _event(2024, 6, 2), _event(2024, 4, 3)])
    assert feed.passed() == [1, 2, 7, 7]
