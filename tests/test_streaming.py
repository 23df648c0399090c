import json
import os
import random
from datetime import datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from roentra.operators import arrivals, scoring
from roentra.sources import files
from roentra.streaming import alerts as alert_stream, arrivals as arrival_stream, jobs as streaming_jobs, newest

TOPIC_SCHEMA = "value binary, partition int, offset long"


def messages(start, n):
    out = []
    for i in range(start, start + n):
        if i % 5 == 0:
            value = b"not json"
        elif i % 5 == 1:
            value = b'{"file_path":"x"}'
        elif i % 5 == 2:
            value = b"\xff\xfe"
        else:
            value = json.dumps({"patient_id": f"p{i}", "file_path": f"raw/{i}.dcm", "ingestion_timestamp": 1.5}).encode()
        out.append((bytearray(value), i % 2, i // 2))
    return out


def put(spark, folder, rows):
    spark.createDataFrame(rows, TOPIC_SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_manifest_stream_equals_batch_and_continues(spark, tmp_path):
    topic, out, progress = (str(tmp_path / n) for n in ("topic", "out", "progress"))
    clock = F.lit("2024-01-01T00:00:00+00:00")

    def run():
        stream = spark.readStream.schema(TOPIC_SCHEMA).parquet(topic)
        return arrival_stream.run_manifest(stream, out, progress, "json", clock)

    put(spark, topic, messages(0, 50))
    assert run() == {"seen": 50, "written": 20}
    assert run() == {"seen": 0, "written": 0}
    put(spark, topic, messages(50, 10))
    assert run() == {"seen": 10, "written": 4}

    batch = arrivals.arrival_manifest(spark.read.parquet(topic), clock)
    streamed = spark.read.schema(batch.schema).json(out)
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))
    assert batch.columns == [
        "patient_id", "file_path", "ingestion_timestamp", "kafka_offset", "kafka_partition", "consumed_at",
    ]


def test_valid_plus_rejected_is_everything(spark):
    topic = spark.createDataFrame(messages(0, 50), TOPIC_SCHEMA)
    reasons = {r["reason"]: r["n"] for r in arrivals.reject_counts(topic).collect()}
    assert reasons == {"not_json": 20, "no_patient_id": 10}
    assert arrivals.arrival_manifest(topic).count() + arrivals.rejected_messages(topic).count() == 50


@pytest.mark.parametrize(
    "text,reason",
    [
        ("[1]", "not_object"), ("null", "not_object"), ("7", "not_object"), ('"s"', "not_object"),
        ("", "not_json"), (None, "not_json"), ('{"a":1} x', "not_json"), ("1,2", "not_json"),
        ("{}", "no_patient_id"), ('{"a":{"patient_id":1}}', "no_patient_id"),
        ('{"patient_id":null}', None),
    ],
)
def test_reject_reason(spark, text, reason):
    data = None if text is None else bytearray(text.encode())
    topic = spark.createDataFrame([(data, 0, 0)], TOPIC_SCHEMA)
    rejected = arrivals.rejected_messages(topic).collect()
    assert [r["reason"] for r in rejected] == ([] if reason is None else [reason])


def test_message_without_optional_fields_is_kept(spark):
    topic = spark.createDataFrame([(bytearray(b'{"patient_id":7,"ingestion_timestamp":"x"}'), 0, 3)], TOPIC_SCHEMA)
    row = arrivals.arrival_manifest(topic).first()
    assert (row["patient_id"], row["file_path"], row["ingestion_timestamp"], row["kafka_offset"]) == ("7", None, None, 3)


def test_publisher_round_trip(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for name in ("a.dcm", "b.dcm", "c.txt"):
        (raw / name).write_bytes(b"x")
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")

    def run():
        return arrival_stream.run_publisher(
            files.stream_files(spark, str(raw), ".dcm"), progress, "json", {"path": out},
            F.lit("1704067200.5").cast("decimal(18,6)"),
        )

    assert run() == 2
    (raw / "d.dcm").write_bytes(b"x")
    assert run() == 1
    values = [json.loads(r["value"]) for r in spark.read.schema("value string").json(out).collect()]
    assert sorted(v["patient_id"] for v in values) == ["a", "b", "d"]
    assert all(v["ingestion_timestamp"] == 1704067200.5 for v in values)
    assert list(values[0]) == ["patient_id", "file_path", "ingestion_timestamp"]
    topic = spark.read.schema("value string").json(out).withColumn("offset", F.lit(0).cast("bigint"))
    assert arrivals.arrival_manifest(topic).count() == 3


def test_tasks_of_a_publication_follow_the_cores_not_the_files(spark, tmp_path, monkeypatch):
    raw, out = tmp_path / "raw", tmp_path / "out"
    raw.mkdir()
    for i in range(1500):
        (raw / f"{i}.dcm").write_bytes(b"x")
    runs, finish = [], streaming_jobs._finish
    monkeypatch.setattr(streaming_jobs, "_finish", lambda query: runs.append(query.runId) or finish(query))
    before = spark.conf.get(arrival_stream.LOOKUP_TASKS)
    stream = files.stream_files(spark, str(raw), ".dcm")
    published = arrival_stream.run_publisher(stream, str(tmp_path / "progress"), "parquet", {"path": str(out)})
    assert published == 1500 and spark.read.parquet(str(out)).distinct().count() == 1500
    tracker = spark.sparkContext.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(runs[0])]
    tasks = [tracker.getStageInfo(s).numTasks for j in jobs for s in j.stageIds]
    assert len(tasks) >= 2 and max(tasks) <= files.listing_parts(spark)
    assert len(list(out.glob("part-*"))) <= files.listing_parts(spark)
    assert spark.conf.get(arrival_stream.LOOKUP_TASKS) == before


def test_names_published_before_are_state_and_not_on_the_driver(spark, tmp_path):
    """Files that come late with an early time, names seen before, empty and hidden files; a batch that fails."""
    raw, out, progress = tmp_path / "raw", tmp_path / "out", tmp_path / "progress"
    raw.mkdir()

    def put(name, at, content=b"x"):
        (raw / name).write_bytes(content)
        os.utime(raw / name, (at, at))

    def run(at=None):
        stream = files.stream_files(spark, str(raw), ".dcm")
        return arrival_stream.run_publisher(stream, str(progress), "parquet", {"path": str(out)}, at)

    def published():
        return sorted(json.loads(r["value"])["patient_id"] for r in spark.read.parquet(str(out)).collect())

    put("a.dcm", 1.7e9), put("b c.dcm", 1.7e9), put("_no.dcm", 1.7e9), put("empty.dcm", 1.7e9, b"")
    (raw / "sub.dcm").mkdir()
    assert run() == 2 and published() == ["a", "b c"]
    assert run() == 0
    put("late.dcm", 1.0e9), put("a.dcm", 1.8e9, b"changed")
    with pytest.raises(StreamingQueryException):
        run(F.raise_error(F.lit("stopped")).cast("decimal(18,6)"))
    assert run() == 1 and published() == ["a", "b c", "late"]
    kept = [f for f in (progress / "sources").rglob("*") if f.is_file()]
    assert not any(b"dcm" in f.read_bytes() for f in kept)


def test_a_checkpoint_of_spark_s_own_source_goes_on(spark, tmp_path):
    (tmp_path / "raw").mkdir()

    def run():
        stream = files.stream_files(spark, str(tmp_path / "raw"), ".dcm", on_driver=True)
        return arrival_stream.run_publisher(stream, str(tmp_path / "progress"), "json", {"path": str(tmp_path / "out")})

    for i in range(2):
        (tmp_path / "raw" / f"{i}.dcm").write_bytes(b"x")
        assert run() == 1
    assert all(b"logOffset" in (tmp_path / "progress" / "offsets" / n).read_bytes() for n in "01")


def test_settings_are_put_back_when_a_stream_fails(spark):
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    for before in (None, "77"):
        spark.conf.set(key, before) if before else spark.conf.unset(key)
        found = spark.conf.get(key)
        with pytest.raises(RuntimeError), streaming_jobs.settings(spark, {key: 5}):
            assert spark.conf.get(key) == "5"
            raise RuntimeError
        assert spark.conf.get(key) == found
    spark.conf.unset(key)


def test_alert_stream_publishes_messages(spark, tmp_path):
    scored, out, progress = (str(tmp_path / n) for n in ("scored", "out", "progress"))
    rows = [(f"s{i}.png", i / 10, datetime(2024, 1, 1, i)) for i in range(10)]
    df = spark.createDataFrame(rows, "filename string, probability double, scored_at timestamp_ntz")
    df.coalesce(1).write.parquet(scored)
    stream = spark.readStream.schema(df.schema).parquet(scored)
    counts = alert_stream.run_alerts(stream, progress, "json", {"path": out}, as_messages=True)
    assert counts == {"seen": 10, "written": 2}
    topic = spark.read.schema("value string").json(out).union(
        spark.createDataFrame([("broken",)], "value string")
    )
    parsed = arrivals.parse_alerts(topic).collect()
    assert sorted((r["filename"], r["pneumonia_probability"]) for r in parsed) == [("s8.png", 0.8), ("s9.png", 0.9)]
    assert all(r["alert_timestamp"] is not None for r in parsed)


REPLAYED = "value binary, topic string, partition int, offset long, timestamp timestamp"


def timed(rows, hour):
    return [(v, "t", p, o, datetime(2024, 1, 1, hour)) for v, p, o in rows]


def test_replayed_messages_are_written_once(spark, tmp_path):
    """Twice in one batch, in two batches, and after a restart; late ones are counted."""
    topic, out, progress = (str(tmp_path / n) for n in ("topic", "out", "progress"))
    clock, replays = F.lit("2024-01-01T00:00:00+00:00"), arrival_stream.Replays(delay="2 hours")

    def add(rows):
        spark.createDataFrame(rows, REPLAYED).coalesce(1).write.mode("append").parquet(topic)

    def run():
        stream = spark.readStream.schema(REPLAYED).option("maxFilesPerTrigger", 1).parquet(topic)
        return arrival_stream.run_manifest(stream, out, progress, "json", clock, replays)

    first = timed(messages(0, 20), 1)
    add(first + first[:10])
    add(first[5:] + timed(messages(20, 10), 2))
    assert run() == {"seen": 55, "written": 12, "late": 0}
    add(first + timed(messages(30, 10), 2))
    assert run() == {"seen": 30, "written": 4, "late": 0}
    # Five hours on, the old messages are neither remembered nor taken.
    add(timed(messages(40, 10), 7))
    assert run()["written"] == 4
    add(first[:6])
    assert run() == {"seen": 6, "written": 0, "late": 6}

    once = spark.read.parquet(topic).dropDuplicates(["topic", "partition", "offset"])
    batch = arrivals.arrival_manifest(once, clock)
    streamed = spark.read.schema(batch.schema).json(out)
    assert sorted(map(str, streamed.collect())) == sorted(map(str, batch.collect()))


def test_replays_need_an_identity(spark):
    topic = spark.readStream.format("rate").load()
    with pytest.raises(ValueError, match="none of the columns"):
        arrival_stream.without_replays(topic, arrival_stream.Replays())


ALERTS = "filename string, pneumonia_probability double, alert_timestamp timestamp"


def test_the_newest_alerts_stand_after_every_batch(spark, tmp_path):
    rng = random.Random(4)
    source, path, progress = (str(tmp_path / n) for n in ("alerts", "newest", "progress"))
    assert newest.newest_alerts(spark, path).collect() == []
    for n in (3, 40, 0, 25, 60):
        rows = [
            (
                rng.choice([None, f"s{rng.randrange(30)}"]),
                rng.choice([None, rng.random()]),
                rng.choice([None, datetime(2024, 1, 1, rng.randrange(24), rng.randrange(3))]),
            )
            for _ in range(n)
        ]
        if rows:
            rows.append(rows[0])
        spark.createDataFrame(rows, ALERTS).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(ALERTS).parquet(source)
        newest.run_newest(stream, path, progress, keys=5)
        found = newest.newest_alerts(spark, path)
        expected = scoring.recent_alerts(spark.read.schema(ALERTS).parquet(source))
        assert list(map(tuple, found.collect())) == list(map(tuple, expected.collect()))
    # However many alerts there were, a key keeps no more than twenty.
    kept = newest.standing(spark, path).where("shard >= 0").groupBy("shard").count().collect()
    assert max(r["count"] for r in kept) <= 20


def test_a_repeated_batch_replaces_its_half(spark, tmp_path):
    path = str(tmp_path / "newest")
    for number, name in ((0, "a"), (1, "b"), (1, "c")):
        rows = [(number, 0, name, 0.9, datetime(2024, 1, 1)), (number, -1, None, None, None)]
        table = spark.createDataFrame(rows, newest.STANDING).coalesce(1)
        table.write.mode("overwrite").parquet(newest._half(path, number))
    assert [r["filename"] for r in newest.newest_alerts(spark, path).collect()] == ["c"]
    before = newest.standing(spark, path, before=1).where("shard >= 0").collect()
    assert [r["filename"] for r in before] == ["a"]


def test_newest_alerts_from_the_topic(spark, tmp_path):
    topic, path, progress = (str(tmp_path / n) for n in ("topic", "newest", "progress"))
    values = [
        json.dumps({"filename": f"s{i}", "pneumonia_probability": 0.9, "alert_timestamp": f"2024-01-01T{i:02}:00:00+00:00"})
        for i in range(24)
    ] + ["broken", "[1]"]
    spark.createDataFrame([(v,) for v in values], "value string").write.parquet(topic)
    newest.run_topic(spark.readStream.schema("value string").parquet(topic), path, progress, 5)
    found = newest.newest_alerts(spark, path, 5).collect()
    assert [r["filename"] for r in found] == ["s23", "s22", "s21", "s20", "s19"]


BODIES = [
    '{"patient_id":"p","file_path":"f","ingestion_timestamp":1.5,"device":{"site":"a","tags":[1,{"x":2}]}}',
    '{"patient_id":7,"ingestion_timestamp":"2.5"}', '{"patient_id":null}', '{"patient_id":{"x":1}}', '{"patient_id":true}',
    '{"patient_id":"p"} trailing', '{"file_path":"f"}', "[1]", "not json", "", None,
    '{"patient_id":1,"patient_id":2}', '{"patient_id":"p","file_path":{"a":[1,2]}}', '{"patient_id":"p","ingestion_timestamp":"x"}',
]


def test_bodies_have_the_rows_of_the_manifest_and_all_fields(spark, tmp_path):
    topic = spark.createDataFrame([(v, i % 2, i) for i, v in enumerate(BODIES)], "value string, partition int, offset long")
    bodies, manifest = arrivals.arrival_bodies(topic), arrivals.arrival_manifest(topic)
    assert sorted(map(str, bodies.drop("body").collect())) == sorted(map(str, manifest.collect()))
    bodies.write.parquet(str(tmp_path / "bodies"))
    stored = spark.read.parquet(str(tmp_path / "bodies"))
    found = arrivals.body_fields(stored, site=("$.device.site", "string"), x=("$.device.tags[1].x", "int"), bad=("$.device.site", "int"))
    (row,) = found.where("site IS NOT NULL").collect()
    assert (row["site"], row["x"], row["bad"]) == ("a", 2, None)
    shapes = {r["shape"]: r["n"] for r in arrivals.body_shapes(stored).collect()}
    assert shapes["OBJECT<patient_id: VOID>"] == 1 and shapes[None] == 1
    assert sum(shapes.values()) == manifest.count()
