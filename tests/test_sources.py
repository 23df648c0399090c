import json
import os
from unittest import mock

import pyarrow as pa
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from roentra import schemas
from roentra.operators import durable, parsing
from roentra.plans import audit, dashboard
from roentra.sources import files, jdbc, jsonlines, kafka, tables


@pytest.fixture
def folder(tmp_path):
    for name in ("b.dcm", "a.dcm", "c.DCM", "d.txt", "e.dcm"):
        (tmp_path / name).write_bytes(name.encode())
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "z.dcm").write_bytes(b"z")
    return str(tmp_path)


def test_list_files(spark, folder):
    listed = files.list_files(spark, folder, ".dcm")
    assert sorted(r["file_name"] for r in listed.collect()) == ["a.dcm", "b.dcm", "e.dcm"]
    assert "content" not in listed._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]
    first = files.list_files(spark, folder, ".dcm", limit=2)
    assert [r["file_name"] for r in first.collect()] == ["a.dcm", "b.dcm"]


def test_read_files(spark, folder):
    every = {r["file_name"]: bytes(r["content"]) for r in files.read_files(spark, folder, ".dcm").collect()}
    assert every == {n: n.encode() for n in ("a.dcm", "b.dcm", "e.dcm")}
    some = files.read_files(spark, folder, ".dcm", limit=2).collect()
    assert sorted(r["file_name"] for r in some) == ["a.dcm", "b.dcm"]
    assert files.read_files(spark, folder, ".none", limit=2).count() == 0


def of_the_folder(frame, folder):
    """Files of the folder that the driver holds for a scan of the frame."""
    return [f for f in frame.inputFiles() if f.startswith(f"file://{folder}/")]


def test_the_driver_holds_no_listing_of_list_files(spark, folder):
    listed = files.list_files(spark, folder, ".dcm")
    assert not of_the_folder(listed, folder) and listed.count() == 3


def test_the_driver_holds_no_listing_of_list_versions(spark, folder):
    listed = files.list_versions(spark, folder, ".dcm")
    assert not of_the_folder(listed, folder) and listed.count() == 3


def test_the_driver_holds_no_listing_of_read_files(spark, folder):
    read = files.read_files(spark, folder, ".dcm")
    assert not of_the_folder(read, folder) and read.count() == 3


@pytest.fixture
def odd_folder(folder, tmp_path):
    for name in ("a b.dcm", "50%41.dcm", "x\u00e4.dcm", "_no.dcm", ".no.dcm", "_k=v.dcm", "no.dcm._COPYING_", "empty.dcm"):
        (tmp_path / name).write_bytes(b"" if name == "empty.dcm" else name.encode())
    (tmp_path / "sub.dcm").mkdir()
    (tmp_path / "sub.dcm" / "y.dcm").write_bytes(b"y")
    os.symlink(tmp_path / "d.txt", tmp_path / "link.dcm")
    os.symlink(tmp_path / "nothing", tmp_path / "gone.dcm")
    os.utime(tmp_path / "b.dcm", ns=(10**18 + 123_456_789, 10**18 + 123_999_999))
    (tmp_path / "none").mkdir()
    return folder


@pytest.mark.parametrize("suffix", [".dcm", "", ".none"])
def test_a_listing_is_that_of_spark(spark, odd_folder, suffix):
    scan = files._scan(spark, odd_folder, suffix)
    listed = files.list_versions(spark, odd_folder, suffix)
    known = scan.select("path", F.col("modificationTime").alias("modified"), "length")
    assert listed.schema.simpleString() == known.schema.simpleString()
    assert sorted(listed.collect()) == sorted(known.collect())
    assert listed.count() == {".dcm": 8, "": 10, ".none": 0}[suffix]
    named = files.list_files(spark, odd_folder, suffix).collect()
    assert sorted((r["path"], r["length"]) for r in named) == sorted((r["path"], r["length"]) for r in known.collect())
    read = files.read_files(spark, odd_folder, suffix).select("path", "content").collect()
    assert sorted(read) == sorted(scan.select("path", "content").collect())


def test_patterns_are_resolved_by_spark(spark, folder):
    assert files.list_files(spark, f"{folder}/su[ab]", ".dcm").count() == 1
    assert files.list_files(spark, folder, ".{dcm,DCM}").count() == 4
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        files.list_files(spark, f"{folder}/none", ".dcm")


def test_contents_come_in_batches_bounded_by_size(tmp_path):
    for i in range(10):
        (tmp_path / str(i)).write_bytes(bytes([i]) * 1000)
    paths = pa.record_batch({"path": [f"file:{tmp_path}/{i}" for i in range(10)]})
    with mock.patch.object(files, "BATCH_BYTES", 2500):
        batches = list(files._contents(iter([paths])))
    assert [b.num_rows for b in batches] == [3, 3, 3, 1]
    assert [c for b in batches for c in b["content"].to_pylist()] == [bytes([i]) * 1000 for i in range(10)]


def test_parse_headers_quarantines(spark, tmp_path):
    (tmp_path / "a.dcm").write_text(json.dumps({"patient_id_raw": "p", "n_rows": 4, "patient_age": "051Y"}))
    (tmp_path / "b.dcm").write_text("broken")
    parsed = parsing.parse_headers(files.read_files(spark, str(tmp_path), ".dcm"), json.loads)
    good = parsing.parsed_rows(parsed).collect()
    assert len(good) == 1 and good[0]["n_rows"] == 4 and good[0]["modality"] is None
    bad = parsing.parse_errors(parsed).collect()
    assert len(bad) == 1 and bad[0]["file_path"].endswith("b.dcm") and bad[0]["error"]


def test_partitioned_write_and_pruned_read(spark, tmp_path):
    df = spark.range(10).select(
        "id", F.when(F.col("id") < 7, "train").when(F.col("id") < 9, "val").otherwise("test").alias("split")
    )
    path = str(tmp_path / "t")
    counts = tables.write_table(df, path, partition_by=["split"], big=F.count_if(F.col("id") > 4))
    assert counts == {"rows": 10, "big": 5}
    assert sorted(p.name for p in (tmp_path / "t").iterdir() if p.is_dir()) == ["split=test", "split=train", "split=val"]
    train = tables.read_table(spark, path).where("split = 'train'")
    assert train.count() == 7
    assert "PartitionFilters: [isnotnull(split" in train._jdf.queryExecution().toString()
    assert tables.write_table(df.limit(2), path)["rows"] == 2
    assert tables.read_table(spark, path).count() == 2


def test_write_of_no_rows_counts_zero(spark, tmp_path):
    df = spark.range(0).select("id")
    assert tables.write_table(df, str(tmp_path / "t"))["rows"] == 0


def test_csv_round_trip(spark, tmp_path):
    rows = [("p1", "p1", 1, "train", "CR", None, "M", "50-59", 10, 20, "raw/p1.dcm")]
    df = spark.createDataFrame(rows, schemas.MODEL_READY)
    tables.write_csv(df, str(tmp_path / "csv"))
    back = tables.read_csv(spark, str(tmp_path / "csv"), schemas.MODEL_READY)
    assert [tuple(r) for r in back.collect()] == rows
    assert back.schema == schemas.MODEL_READY
    assert tables.preview(back, 1).shape == (1, 11)


def test_json_lines_skip_broken_lines(spark, tmp_path):
    path = str(tmp_path / "log")
    assert jsonlines.read_json_lines(spark, path, schemas.AUDIT_LOG).count() == 0
    audit.log_run(spark, path, "job", 3, schema=None, notes="n")
    audit.log_run(spark, path, "job2", 4)
    (tmp_path / "log" / "part-broken.json").write_text('{"job_name": "x"\nnot json\n')
    runs = audit.read_runs(spark, path)
    assert {(r["job_name"], r["row_count"], r["notes"]) for r in runs.collect()} == {
        ("job", 3, "n"), ("job2", 4, None),
    }
    assert runs.where("run_timestamp IS NULL").count() == 0
    assert jsonlines.broken_lines(spark, path, schemas.AUDIT_LOG).count() == 2
    metrics = dashboard.ops_metrics(runs).first()
    assert (metrics["total_runs"], metrics["unique_jobs"]) == (2, 2)
    history = dashboard.run_history(runs, limit=1).collect()
    assert [r["job_name"] for r in history] == ["job2"]


def holds(predicate, value):
    """Evaluate a generated clause in plain SQL semantics."""
    import duckdb

    sql = f"SELECT coalesce({predicate}, false) FROM (SELECT ? AS k)"
    return duckdb.execute(sql, [value]).fetchone()[0]


@pytest.mark.parametrize("value", ["", "a", "m", "mm", "o'k", "z", None])
def test_range_predicates_cover_every_key_once(value):
    predicates = jdbc.range_predicates("k", ["m", "b", "o'k", "m"])
    assert len(predicates) == 4
    assert sum(holds(p, value) for p in predicates) == 1
    assert jdbc.range_predicates("k", []) == ["1 = 1"]


@pytest.mark.parametrize("value", [0, 1, 5, 6, -1, -4, -7, 2**63 - 1, -(2**63), None])
def test_modulo_predicates_cover_every_key_once(value):
    predicates = jdbc.modulo_predicates("k", 4)
    assert sum(holds(p, value) for p in predicates) == 1


class RecordingReader:
    def __init__(self):
        self.calls = []

    def jdbc(self, *args, **kwargs):
        self.calls.append((args, kwargs))

    def format(self, name):
        self.calls.append(("format", name))
        return self

    def options(self, **options):
        self.calls.append(("options", options))
        return self

    def load(self):
        return self


class RecordingSession:
    def __init__(self):
        self.read = RecordingReader()


def test_jdbc_reader_arguments():
    session = RecordingSession()
    jdbc.read_table(session, "jdbc:x", "raw_class_info", {"user": "u"}, ["a", "b"])
    jdbc.read_table(session, "jdbc:x", "raw_class_info", {"user": "u"})
    jdbc.read_query(session, "jdbc:x", "SELECT DISTINCT patient_id FROM raw_class_info", {"user": "u"})
    calls = session.read.calls
    assert calls[0] == (("jdbc:x", "raw_class_info"), {"predicates": ["a", "b"], "properties": {"user": "u"}})
    assert calls[1] == (("jdbc:x", "raw_class_info"), {"properties": {"user": "u"}})
    assert calls[3][1]["query"].startswith("SELECT DISTINCT")


def test_topic_options():
    options = kafka.topic_options("host:1", schemas.ARRIVALS_TOPIC)
    assert options["startingOffsets"] == "earliest" and options["subscribe"] == "dicom-ingestion"
    assert kafka.sink_options("host:1", schemas.ALERTS_TOPIC)["topic"] == "clinical-alerts"


def test_dicom_header_reads_the_tags(monkeypatch):
    """With a stand-in for the optional package; unset tags are None, numbers stay numbers."""
    import sys
    import types

    tags = {"PatientID": "p", "Rows": 1024, "PatientAge": "051Y"}
    reader = types.SimpleNamespace(dcmread=lambda stream, stop_before_pixels: tags)
    monkeypatch.setitem(sys.modules, "pydicom", reader)
    header = parsing.dicom_header(b"")
    assert set(header) == set(schemas.RAW_HEADER.fieldNames())
    assert (header["patient_id_raw"], header["n_rows"], header["modality"]) == ("p", 1024, None)


def test_scratch_needs_a_shared_folder_on_a_cluster():
    import types

    def session(master, folder):
        return types.SimpleNamespace(
            conf=types.SimpleNamespace(get=lambda key, default="/warehouse": folder or default),
            sparkContext=types.SimpleNamespace(master=master),
        )

    assert durable.shared_dir(session("yarn", "hdfs:///shared")) == "hdfs:///shared"
    assert durable.shared_dir(session("local[8]", None))
    with pytest.raises(ValueError):
        durable.shared_dir(session("yarn", None))
