import json
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from roentra import schemas
from roentra.adapters import view
from roentra.operators import epochs, gold, metrics, parsing
from roentra.plans import audit, jobs
from roentra.sources import files, tables

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def layout(spark, tmp_path_factory):
    """A whole run: files on disk -> headers, images, checks, gold, summaries."""
    raw = tmp_path_factory.mktemp("raw")
    out = jobs.Layout(str(tmp_path_factory.mktemp("lake")))
    headers = view(spark, SF_DIR, "fx_headers").collect()
    for row in headers:
        body = {f: row[f] for f in schemas.RAW_HEADER.fieldNames()}
        number = int(row["study_instance_uid"].split(".")[-1])
        body["image"] = [[number % 7, 1], [2, 300]]
        (raw / row["file_name"]).write_text(json.dumps(body))
    (raw / "broken.dcm").write_text("broken")
    source = files.read_files(spark, str(raw), ".dcm")
    header_counts = jobs.ingest_headers(source, out, json.loads)
    image_counts = jobs.ingest_images(source, out, lambda b: np.array(json.loads(b)["image"]), (2, 2))
    assert header_counts == image_counts == {"rows": len(headers), "failed": 1}
    jobs.run_all(view(spark, SF_DIR, "fx_class_info"), jobs.image_digests(spark, out), out)
    return out


def test_tables_have_their_declared_schemas(spark, layout):
    for table, schema in [
        (jobs.CLASS_INFO, schemas.CLASS_INFO), (jobs.HEADERS, schemas.HEADERS),
        (jobs.DQ_RESULTS, schemas.DQ_RESULTS), (jobs.CASE_COUNTS, schemas.CASE_COUNTS),
        (jobs.DEMOGRAPHICS, schemas.DEMOGRAPHICS), (jobs.DQ_SUMMARY, schemas.DQ_SUMMARY),
    ]:
        got = [(f.name, f.dataType) for f in layout.read(spark, table).schema]
        assert got == [(f.name, f.dataType) for f in schema], table
    gold_types = {f.name: f.dataType for f in layout.read(spark, jobs.MODEL_READY).schema}
    assert gold_types == {f.name: f.dataType for f in schemas.MODEL_READY}


def test_gold_invariants(spark, layout):
    model_ready = layout.read(spark, jobs.MODEL_READY)
    info, headers = layout.read(spark, jobs.CLASS_INFO), layout.read(spark, jobs.HEADERS)
    labelled = headers.join(
        info.select("patient_id").distinct(), F.col("original_filename") == F.col("patient_id"), "left_semi"
    )
    rows = model_ready.count()
    assert rows == labelled.count() > 0
    assert model_ready.groupBy("patient_id").agg(F.count_distinct("split").alias("n")).where("n > 1").count() == 0
    for table in (jobs.CASE_COUNTS, jobs.DEMOGRAPHICS):
        assert layout.read(spark, table).agg(F.sum("case_count")).first()[0] == rows
    patients = layout.read(spark, jobs.PATIENTS)
    n = patients.count()
    by_split = {r["split"]: r["count"] for r in patients.groupBy("split").count().collect()}
    assert by_split["train"] == int(n * 0.70) and by_split["val"] == int(n * 0.15)
    lazy = gold.model_ready(headers, info)
    assert sorted(map(str, lazy.collect())) == sorted(map(str, model_ready.select(lazy.columns).collect()))


def test_quality_rows(spark, layout):
    rows = layout.read(spark, jobs.DQ_RESULTS).collect()
    assert len(rows) == 10
    duplicates = next(r for r in rows if r["check_name"] == "duplicate_detection")
    images = jobs.read_images(spark, layout)
    assert duplicates["total_rows"] == images.count()
    assert duplicates["failing_rows"] == images.count() - images.select("content_hash").distinct().count()


def test_quarantine_tables(spark, layout):
    for errors in (layout.read(spark, jobs.HEADER_ERRORS), jobs.image_errors(spark, layout)):
        rows = parsing.sample_errors(errors).collect()
        assert len(rows) == 1 and rows[0]["file_path"].endswith("broken.dcm") and rows[0]["error"]


def test_no_table_holds_a_raw_patient_id(spark, layout):
    raw_ids = {r[0] for r in view(spark, SF_DIR, "fx_headers").select("patient_id_raw").collect() if r[0]}
    for table in (jobs.HEADER_STAGE, jobs.HEADERS, jobs.MODEL_READY):
        for row in layout.read(spark, table).collect():
            assert not raw_ids.intersection(str(v) for v in row)


def test_audit_trail(spark, layout):
    runs = {r["job_name"]: r for r in audit.read_runs(spark, layout.audit).collect()}
    assert set(runs) == {
        "silver_dicom_metadata_ingest", "postgres_metadata_ingest", "silver_dq_checks",
        "gold_model_ready", "gold_analytics_summary",
    }
    assert runs["silver_dq_checks"]["row_count"] == 10
    assert runs["gold_model_ready"]["row_count"] == layout.read(spark, jobs.MODEL_READY).count()
    assert runs["gold_model_ready"]["notes"].startswith("patients per split: train=")
    assert runs["silver_dicom_metadata_ingest"]["notes"].endswith("1 quarantined")


def test_manifest_job(spark, layout, tmp_path):
    topic = str(tmp_path / "topic")
    rows = [(bytearray(b'{"patient_id":"p","file_path":"f","ingestion_timestamp":1}'), 0, 0), (bytearray(b"x"), 0, 1)]
    schema = "value binary, partition int, offset long"
    spark.createDataFrame(rows, schema).write.parquet(topic)
    other = jobs.Layout(str(tmp_path / "lake"))
    counts = jobs.ingest_manifest(spark.readStream.schema(schema).parquet(topic), other)
    assert counts == {"seen": 2, "written": 1}
    manifest = spark.read.schema(schemas.IMAGE_MANIFEST).json(other.path(jobs.MANIFEST)).collect()
    assert manifest[0]["patient_id"] == "p" and manifest[0]["consumed_at"].endswith("+00:00")
    assert audit.read_runs(spark, other.audit).first()["row_count"] == 1


def test_one_pass_equals_two_and_opens_each_file_once(spark, layout, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for row in view(spark, SF_DIR, "fx_headers").limit(40).collect():
        body = {f: row[f] for f in schemas.RAW_HEADER.fieldNames()} | {"image": [[1, 2], [3, 300]]}
        (raw / row["file_name"]).write_text(json.dumps(body))
    (raw / "broken.dcm").write_text("broken")
    (raw / "no_image.dcm").write_text(json.dumps({"modality": "CR"}))
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    def pixels_of(content):
        return np.array(json.loads(content)["image"])

    source = files.read_files(spark, str(raw), ".dcm")
    watched = source.mapInPandas(counted, source.schema)
    one, two = (jobs.Layout(str(tmp_path / name)) for name in ("one", "two"))
    counts = jobs.ingest_files(watched, one, json.loads, pixels_of, (2, 2))
    assert counts == {"headers": 41, "headers_failed": 1, "images": 40, "images_failed": 2}
    assert read.value == 42
    jobs.ingest_headers(source, two, json.loads)
    jobs.ingest_images(source, two, pixels_of, (2, 2))
    for table in (jobs.HEADERS, jobs.HEADER_ERRORS):
        got, expected = ([tuple(r) for r in out.read(spark, table).collect()] for out in (one, two))
        assert sorted(map(str, got)) == sorted(map(str, expected))
    for read_part in (jobs.read_images, jobs.image_errors):
        got, expected = ([tuple(r) for r in read_part(spark, out).collect()] for out in (one, two))
        assert sorted(map(str, got)) == sorted(map(str, expected))


def test_small_and_coloured_images_are_stored(spark, tmp_path):
    rng = np.random.default_rng(1)
    images = [rng.integers(0, 255, shape).tolist() for shape in [(200, 200), (300, 100), (20, 30, 3)]]
    rows = [(f"raw/{i}.dcm", bytearray(json.dumps(m).encode())) for i, m in enumerate(images)]
    files = spark.createDataFrame(rows, "path string, content binary")
    out = jobs.Layout(str(tmp_path))
    counts = jobs.ingest_images(files, out, lambda b: np.array(json.loads(b)))
    assert counts == {"rows": 3, "failed": 0}
    stored = {r["image_id"]: r for r in jobs.read_images(spark, out).collect()}
    assert [len(stored[str(i)]["pixels"]) for i in range(3)] == [224 * 224, 224 * 224, 224 * 224 * 3]


def test_training_and_scoring_jobs(spark, layout):
    trained = jobs.train_classifier(spark, layout, reg_params=(0.1, 0.01), max_iter=5)
    assert trained.pos_weight > 0
    examples = layout.read(spark, jobs.EXAMPLES)
    assert examples.count() == layout.read(spark, jobs.MODEL_READY).count()
    log = layout.read(spark, jobs.RUN_METRICS)
    assert {r["metric"] for r in log.collect()} == {
        "training_set_size", "pos_weight", "reg_param", "train_loss", "val_loss", "val_auroc",
        "best_val_auroc", "test_loss", "test_auroc",
    }
    best = metrics.best_epoch(metrics.metric_values(log, "val_auroc")).collect()
    assert len(best) == 1 and best[0]["best_step"] in (0, 1)
    counts = jobs.score_images(spark, layout)
    predicted = layout.read(spark, jobs.PREDICTIONS)
    assert counts["rows"] == predicted.count() == jobs.read_images(spark, layout).count()
    assert [f.name for f in predicted.schema] == [*schemas.PREDICTION.fieldNames(), "run", "batch"]
    assert counts["alerts"] == predicted.where("high_confidence_positive").count()
    # A second run stands beside the first, and its own repetition takes its place.
    for _ in range(2):
        assert jobs.score_images(spark, layout, run="again") == counts
    predicted = layout.read(spark, jobs.PREDICTIONS)
    assert predicted.count() == 2 * counts["rows"] and predicted.select("run").distinct().count() == 2


def test_network_job_resumes_and_takes_bucketed_pixels(spark, layout):
    jobs.bucket_images(spark, layout, 4)
    phases = (epochs.Phase("one", 1, 1e-3, frozen=True), epochs.Phase("two", 2, 1e-3, cosine=True))
    options = dict(units=3, batches=2, bucketed=True, phases=phases)
    jobs.train_network(spark, layout, "first", stop_after=1, **options)
    trained = jobs.train_network(spark, layout, "first", **options)
    log = layout.read(spark, jobs.EPOCH_METRICS)
    assert sorted((r["run_name"], r["step"]) for r in log.where("metric = 'val_auroc'").collect()) == [
        ("one", 0), ("two", 0), ("two", 1),
    ]
    assert {r["metric"] for r in log.where("run_name = 'final_test_evaluation'").collect()} == {"test_loss", "test_auroc"}
    kept = epochs.from_table(layout.read(spark, jobs.NETWORK))
    assert (kept.weights == trained.best.weights).all()
    whole = jobs.train_network(spark, layout, "second", **options)
    assert (whole.best.weights == trained.best.weights).all()


def test_a_failing_step_stops_the_run(spark, tmp_path):
    layout = jobs.Layout(str(tmp_path / "empty"))
    info = spark.createDataFrame([("a", "Normal")], schemas.CLASS_INFO)
    digests = spark.createDataFrame([], "file_name string, content_hash string")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        jobs.run_all(info, digests, layout)
    assert [r["job_name"] for r in audit.read_runs(spark, layout.audit).collect()] == ["postgres_metadata_ingest"]


def test_uploads_become_predictions_and_alerts(spark, layout):
    from pyspark.ml.classification import LogisticRegressionModel

    model = LogisticRegressionModel.load(layout.path("models/classifier"))
    grey = [[[v] * 3 for v in row] for row in [[0, 255], [128, 64]]]
    rows = [
        ("a.png", "image/png", bytearray(json.dumps(grey).encode())),
        ("b.png", "image/png", bytearray(b"this is not a valid image file")),
        ("c.txt", "text/plain", bytearray(b"hello world")),
    ]
    uploads = spark.createDataFrame(rows, "filename string, content_type string, content binary")
    before = layout.read(spark, jobs.PREDICTIONS).count()
    counts = jobs.score_uploads(
        uploads, layout, model, lambda b: np.array(json.loads(b)), (2, 2), run="uploaded"
    )
    assert counts["rows"] == 1 and counts["rejected"] == 2
    rows = layout.read(spark, jobs.PREDICTIONS)
    assert rows.count() == before + 1
    row = rows.where("run = 'uploaded'").first()
    assert row["filename"] == "a.png" and 0 <= row["pneumonia_probability"] <= 1
    letters = layout.read(spark, jobs.DEAD_LETTERS).where("run = 'uploaded'").collect()
    assert sorted((r["filename"], r["rejected_because"]) for r in letters) == [
        ("b.png", "unreadable"), ("c.txt", "not_an_image"),
    ]


def files_of(path):
    return {f: f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


def test_one_split_is_rebuilt_alone(spark, layout):
    root = Path(layout.path(jobs.MODEL_READY))
    before = {s: files_of(root / f"split={s}") for s in ("train", "val", "test")}
    old = layout.read(spark, jobs.MODEL_READY)
    rows = sorted(map(str, old.collect()))
    in_val = old.where("split = 'val'").count()
    assert jobs.rebuild_split(spark, layout, "val") == in_val > 0
    after = {s: files_of(root / f"split={s}") for s in ("train", "val", "test")}
    assert after["train"] == before["train"] and after["test"] == before["test"]
    assert after["val"] != before["val"]
    assert sorted(map(str, layout.read(spark, jobs.MODEL_READY).collect())) == rows


def test_a_failed_rewrite_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(spark.range(10).selectExpr("id", "id % 2 p"), path, partition_by=["p"])
    broken = spark.range(100, 120).selectExpr("if(id = 119, raise_error('no'), id) id", "0 p")
    before = files_of(path)
    with pytest.raises(Exception, match="no"):
        tables.write_table(broken, path, partition_by=["p"], replace_partitions=True)
    assert {f: t for f, t in files_of(path).items() if "spark-staging" not in str(f)} == before
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == list(range(10))
    with pytest.raises(ValueError, match="replaced"):
        tables.write_table(spark.range(3), path, replace_partitions=True)


def upload(name, kind="image/png", grey=200):
    body = json.dumps([[[grey] * 3] * 2] * 2) if grey is not None else "broken"
    return (name, kind, bytearray(body.encode()))


def test_published_batches_are_repeated_without_a_trace(spark, tmp_path):
    """The second of three batches fails between its tables and its end."""
    schema = "filename string, content_type string, content binary"
    source, out = str(tmp_path / "in"), jobs.Layout(str(tmp_path / "lake"))
    batches = [
        [upload("a", grey=255), upload("b", grey=0), upload("x", "text/plain")],
        [upload("c", grey=255), upload("y", grey=None)],
        [upload("d", grey=255)],
    ]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
    failed = []

    def fail_once(number):
        if number == 1 and not failed:
            failed.append(number)
            raise RuntimeError("lost")

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        return jobs.publish_uploads(
            stream, out, "service", lambda: lambda x: x[:, 0], lambda b: np.array(json.loads(b)), (1, 1),
            F.lit("2024-01-01T00:00:00+00:00"), fail_once,
        )

    with pytest.raises(Exception, match="FOREACH_BATCH_USER_FUNCTION_ERROR"):
        run()
    counts = run()
    assert failed == [1] and counts == {"rows": 2, "rejected": 1, "alerts": 2}
    names = lambda table: sorted(r["filename"] for r in out.read(spark, table).collect())
    assert names(jobs.PREDICTIONS) == ["a", "b", "c", "d"]
    assert names(jobs.ALERTS) == ["a", "c", "d"]
    assert names(jobs.DEAD_LETTERS) == ["x", "y"]
    assert run() == {"rows": 0, "rejected": 0, "alerts": 0}
