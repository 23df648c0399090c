import io
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from roentra import workload
from roentra.operators import ingest, parsing
from roentra.plans import jobs
from roentra.sources import files
from roentra.sources.ranges import RangeReader, open_path


class Bytes:
    def __init__(self, data):
        self.data, self.asked = data, []

    def size(self):
        return len(self.data)

    def read_at(self, nbytes, offset):
        self.asked.append((offset, nbytes))
        return self.data[offset : offset + nbytes]


@pytest.mark.parametrize("block", [1, 7, 64, 10_000])
def test_a_range_reader_reads_as_a_file(block):
    rng = random.Random(block)
    data = rng.randbytes(500)
    plain, ranged = io.BytesIO(data), RangeReader(Bytes(data), block)
    for _ in range(200):
        what = rng.randrange(4)
        if what == 0:
            n = rng.choice([0, 1, 30, 600, -1])
            assert ranged.read(n) == plain.read(n)
        elif what == 1:
            assert ranged.readline() == plain.readline()
        else:
            where, by = rng.choice([(0, rng.randrange(520)), (1, rng.randrange(9)), (2, -rng.randrange(400))])
            assert ranged.seek(by, where) == plain.seek(by, where)
        assert ranged.tell() == plain.tell()


def test_only_what_is_asked_for_is_fetched():
    source = Bytes(b"head\n" + b"x" * 100_000)
    reader = RangeReader(source, 1000)
    assert reader.readline() == b"head\n" and reader.fetched == 1000
    reader.seek(0)
    assert reader.read(4) == b"head" and reader.fetched == 1000
    reader.seek(50_500)
    reader.read(10)
    assert reader.fetched == 2000 and len(source.asked) == 2


@pytest.mark.parametrize("prefix", ["", "file:", "file://"])
def test_files_are_opened_by_path_or_uri(tmp_path, prefix):
    (tmp_path / "a").write_bytes(b"some bytes")
    file = open_path(f"{prefix}{tmp_path}/a")
    assert file.size() == 10 and file.read_at(5, 5) == b"bytes"


def put(folder, name, body, header=None):
    line = json.dumps(header if header is not None else {"modality": "CR", "n_rows": 5})
    (folder / name).write_bytes(line.encode() + b"\n" + b"p" * body)


# A lambda goes to the tasks by value; they do not see this module.
first_line = lambda file: json.loads(file.readline())


def test_headers_from_first_bytes_equal_headers_from_whole_files(spark, tmp_path):
    for i in range(6):
        put(tmp_path, f"{i}.dcm", 400_000, {"modality": f"m{i}", "n_rows": i, "patient_age": "041Y"})
    put(tmp_path, "number.dcm", 400_000, {"n_rows": "many"})
    (tmp_path / "empty.dcm").write_bytes(b"")
    (tmp_path / "broken.dcm").write_bytes(b"no json\n" + b"p" * 400_000)
    whole = parsing.parse_headers(
        files.read_files(spark, str(tmp_path), ".dcm"), lambda b: json.loads(b.partition(b"\n")[0])
    )
    listing = files.list_versions(spark, str(tmp_path), ".dcm")
    ranged = parsing.parse_ranges(listing, first_line, block=4096, keep=["length"])
    assert sorted(map(str, ranged.drop("bytes_read", "length").collect())) == sorted(map(str, whole.collect()))
    read, length = (sum(r[c] for r in ranged.collect()) for c in ("bytes_read", "length"))
    assert 0 < read < length / 10


def test_a_file_that_is_gone_is_quarantined(spark):
    listing = spark.createDataFrame([("file:///no/such/file.dcm",)], "path string")
    row = parsing.parse_ranges(listing, first_line).first()
    assert row["error"] and row["bytes_read"] == 0


VERSIONS = "path string, modified timestamp, length long"


def test_unseen_files(spark):
    def table(rows):
        return spark.sql("SELECT * FROM VALUES " + ", ".join(
            f"('{p}', timestamp_seconds({t}), {n}L)" for p, t, n in rows) + " AS t(path, modified, length)")

    seen = table([("a/1", 10, 5), ("a/2", 20, 5), ("b/1", 50, 5)])
    listed = [
        ("a/1", 10, 5), ("a/2", 20, 5),  # as seen
        ("a/3", 15, 5),  # came late with an early time
        ("a/4", 20, 5),  # at the mark
        ("a/5", 30, 5), ("c/1", 1, 5),  # younger, and in a new folder
        ("a/1", 10, 6), ("b/1", 60, 5),  # changed in length, in time
    ]
    found = {(r["path"], r["length"]) for r in ingest.unseen(table(listed), seen).collect()}
    assert found == {("a/3", 5), ("a/4", 5), ("a/5", 5), ("c/1", 5), ("a/1", 6), ("b/1", 5)}
    nothing = spark.createDataFrame([], VERSIONS)
    assert ingest.unseen(table(listed), nothing).count() == 8
    assert ingest.unseen(nothing, seen).count() == 0


def test_files_seen_are_not_broadcast(spark, tmp_path):
    rows = spark.range(1000).selectExpr("concat('a/', id) AS path", "timestamp_seconds(id) AS modified", "id AS length")
    rows.write.parquet(str(tmp_path / "seen"))
    seen = spark.read.parquet(str(tmp_path / "seen"))
    listed = ingest.unseen(rows.unionByName(rows.withColumn("length", F.lit(-1))), seen)
    assert listed.count() == 1000
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and not any("BroadcastHashJoin" in p and "LeftAnti" in p for p in plan.splitlines())


def test_runs_open_new_and_changed_files_only(spark, tmp_path):
    raw, layout = tmp_path / "raw", jobs.Layout(str(tmp_path / "lake"))
    raw.mkdir()

    def run(name=None):
        listing = files.list_versions(spark, str(raw), ".dcm")
        return jobs.ingest_new_headers(listing, layout, first_line, run=name)

    assert run() == {"opened": 0, "failed": 0, "bytes_read": 0, "rows": 0}
    for i in range(5):
        put(raw, f"{i}.dcm", 10)
    (raw / "bad.dcm").write_bytes(b"no")
    first = run("first")
    assert (first["opened"], first["failed"], first["rows"]) == (6, 1, 5)
    assert run()["opened"] == 0
    put(raw, "6.dcm", 10)
    put(raw, "2.dcm", 30, {"modality": "changed"})
    os.utime(raw / "2.dcm", (2e9, 2e9))
    (raw / "bad.dcm").write_bytes(b'{"modality": "mended"}')
    later = run("later")
    assert (later["opened"], later["failed"], later["rows"]) == (3, 0, 7)
    # A run that is given again replaces itself.
    assert run("later") == later
    silver = {r["original_filename"]: r["modality"] for r in layout.read(spark, jobs.HEADERS).collect()}
    assert silver == {"0": "CR", "1": "CR", "2": "changed", "3": "CR", "4": "CR", "6": "CR", "bad": "mended"}
    assert layout.read(spark, jobs.HEADER_ERRORS).count() == 0


def test_large_files_of_a_query_take_no_disk_for_their_pixels(spark, tmp_path, monkeypatch):
    rows = [(i, f"Customer#{i}", i % 25, 10.0 * i, "BUILDING") for i in range(1, 41)]
    kinds = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    spark.createDataFrame(rows, kinds).write.parquet(str(tmp_path / "customer.parquet"))
    monkeypatch.setattr(workload, "_new_folder", lambda _, name: f"file://{tmp_path}/{name}")
    found = workload.new_headers(spark, str(tmp_path)).collect()
    raw = [os.stat(f) for f in (tmp_path / "raw").iterdir()]
    assert len(raw) == 40 and all(200_000 < f.st_size < 201_000 for f in raw)
    assert sum(f.st_blocks for f in raw) * 512 < 40 * 20_000
    # Every 11th file has no modality, every file that ends in 5 no number of rows.
    assert len(found) == 33 and {(r["opened"], r["opened_last"], r["read_a_part"]) for r in found} == {(40, 0, True)}


def test_tail_bytes_follow_the_content(spark, tmp_path):
    rows = spark.createDataFrame([("a", b"head"), ("b", b"")], "file_name string, content binary")
    workload._write_files(rows, f"file://{tmp_path}/raw", tail=3000)
    found = {f.name: f.read_bytes() for f in (tmp_path / "raw").iterdir()}
    assert found == {"a": b"head" + bytes(3000), "b": bytes(3000)}


def test_a_listing_has_no_task_for_every_few_files(spark, tmp_path):
    for i in range(1500):
        (tmp_path / f"{i}.dcm").write_bytes(b"x")
    listing = files.list_versions(spark, str(tmp_path), ".dcm")
    assert listing.rdd.getNumPartitions() <= files.listing_parts(spark)
    assert listing.distinct().count() == 1500
