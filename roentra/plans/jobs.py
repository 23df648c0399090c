"""The table-building jobs. Each writes its tables once and leaves an audit row."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import UTC, datetime
from typing import BinaryIO

import numpy as np
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from roentra import schemas
from roentra.functions import times
from roentra.operators import check_state, classifier, epochs, gold, headers, ingest, parsing, pixels, quality, scoring
from roentra.operators.skew import hot_keys
from roentra.plans.audit import log_run
from roentra.sources.buckets import read_bucketed, write_bucketed
from roentra.sources.ranges import RandomAccess, open_path
from roentra.sources.tables import is_table, read_table, write_table
from roentra.streaming.arrivals import run_manifest
from roentra.streaming.jobs import drain_batches


@dataclass(frozen=True)
class Layout:
    """Where the tables live, under one root, in one format."""

    root: str
    fmt: str = "parquet"

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    @property
    def audit(self) -> str:
        return self.path("bronze/audit_log")

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return read_table(spark, self.path(table), self.fmt)

    def exists(self, spark: SparkSession, table: str) -> bool:
        return is_table(spark, self.path(table), self.fmt)

    def write(self, df: DataFrame, table: str, **options) -> dict[str, int]:
        return write_table(df, self.path(table), self.fmt, **options)


# Where the tables lie under the root.
CLASS_INFO = "bronze/metadata_raw"
HEADERS = "silver/dicom_metadata"
HEADER_STAGE = "silver/dicom_parsed"
HEADER_VERSIONS = "silver/dicom_versions"
HEADER_ERRORS = "silver/dicom_errors"
IMAGES = "silver/images_processed"
DQ_RESULTS = "silver/dq_results"
CHECK_STATE = "silver/dq_state"
PATIENTS = "gold/patient_splits"
MODEL_READY = "gold/model_ready"
CASE_COUNTS = "gold/analytics_summary/case_counts"
DEMOGRAPHICS = "gold/analytics_summary/demographics"
DQ_SUMMARY = "gold/analytics_summary/dq_summary"
MANIFEST = "bronze/image_manifest"
EXAMPLES = "gold/training_examples"
BUCKETED_IMAGES = "silver/images_bucketed"
RUN_METRICS = "models/run_metrics"
EPOCH_METRICS = "models/epoch_metrics"
NETWORK = "models/network"
PREDICTIONS = "gold/predictions"
ALERTS = "gold/clinical_alerts"
UPLOADS = "silver/uploads_screened"
DEAD_LETTERS = "silver/uploads_rejected"


def ingest_class_info(class_info: DataFrame, layout: Layout) -> int:
    """Hospital label rows -> bronze, unchanged."""
    spark = class_info.sparkSession
    rows = layout.write(class_info, CLASS_INFO)["rows"]
    log_run(
        spark,
        layout.audit,
        schemas.JOB_LABELS_INGEST,
        rows,
        class_info.schema.simpleString(),
        "label table copied unchanged",
    )
    return rows


def ingest_headers(
    files: DataFrame,
    layout: Layout,
    parse: Callable[[bytes], Mapping[str, object]] = parsing.dicom_header,
) -> dict[str, int]:
    """Binary header files -> silver headers and a table of the files that failed.

    Every file is opened and parsed once: the parsed rows are staged, already
    de-identified, and both tables are cut from that stage.
    """
    spark = files.sparkSession
    parsed = headers.deidentified_headers(parsing.parse_headers(files, parse), keep=["error"])
    failed = layout.write(parsed, HEADER_STAGE, failed=F.count("error"))["failed"]
    staged = layout.read(spark, HEADER_STAGE)
    layout.write(parsing.parse_errors(staged), HEADER_ERRORS)
    silver = schemas.conform(parsing.parsed_rows(staged), schemas.HEADERS)
    rows = layout.write(silver, HEADERS)["rows"]
    log_run(
        spark,
        layout.audit,
        schemas.JOB_HEADERS_INGEST,
        rows,
        silver.schema.simpleString(),
        f"{rows} files parsed, {failed} quarantined",
    )
    return {"rows": rows, "failed": failed}


def ingest_new_headers(
    listing: DataFrame,
    layout: Layout,
    parse: Callable[[BinaryIO], Mapping[str, object]] = parsing.dicom_tags,
    open_file: Callable[[str], RandomAccess] = open_path,
    run: str | None = None,
) -> dict[str, int]:
    """Listed files (path, modified, length) -> silver headers; only new and changed files are opened,
    and of those only the bytes that the parser reads.

    Every run adds its parsed rows as a partition, which is the manifest of what was
    seen as well; silver takes the newest version of each file. The name of an earlier run
    replaces that run.
    """
    spark, name = listing.sparkSession, run or new_run("headers")
    versions = ["modified", "length", "bytes_read"]
    if layout.exists(spark, HEADER_VERSIONS):
        earlier = layout.read(spark, HEADER_VERSIONS).where(F.col("run") != name)
        seen = earlier.select(F.col("file_path").alias("path"), "modified", "length")
        listing = ingest.unseen(listing, seen)
    parsed = parsing.parse_ranges(listing, parse, open_file, keep=["modified", "length"])
    staged = headers.deidentified_headers(parsed, keep=["error", *versions])
    counts = layout.write(
        staged.withColumn("run", F.lit(name)),
        HEADER_VERSIONS,
        partition_by=["run"],
        replace_partitions=True,
        failed=F.count("error"),
        bytes_read=F.sum("bytes_read"),
    )
    rows = 0
    if layout.exists(spark, HEADER_VERSIONS):
        stored = layout.read(spark, HEADER_VERSIONS)
        last = ingest.newest(stored, "file_path", ["modified", "run"])
        layout.write(parsing.parse_errors(last), HEADER_ERRORS)
        silver = schemas.conform(parsing.parsed_rows(last), schemas.HEADERS)
        rows = layout.write(silver, HEADERS)["rows"]
    log_run(
        spark,
        layout.audit,
        schemas.JOB_HEADERS_INGEST,
        rows,
        notes=f"{counts['rows']} files opened, {counts['failed']} of them quarantined",
    )
    return {
        "opened": counts["rows"],
        "failed": counts["failed"],
        "bytes_read": counts["bytes_read"],
        "rows": rows,
    }


def ingest_images(
    files: DataFrame,
    layout: Layout,
    decode: Callable[[bytes], np.ndarray] = pixels.dicom_pixels,
    target: tuple[int, int] = schemas.TARGET_SIZE,
) -> dict[str, int]:
    """Binary image files -> processed pixels with their digest, and the files that failed.

    One write, partitioned by ``outcome``: pixels are never copied a second time,
    and readers of either part prune the other.
    """
    processed = pixels.preprocess_images(files, decode, target)
    counts = layout.write(
        processed.withColumn("outcome", F.when(F.col("error").isNull(), "ok").otherwise("failed")),
        IMAGES,
        partition_by=["outcome"],
        bad=F.count("error"),
    )
    return {"rows": counts["rows"] - counts["bad"], "failed": counts["bad"]}


def ingest_files(
    files: DataFrame,
    layout: Layout,
    parse: Callable[[bytes], Mapping[str, object]] = parsing.dicom_header,
    decode: Callable[[bytes], np.ndarray] = pixels.dicom_pixels,
    target: tuple[int, int] = schemas.TARGET_SIZE,
) -> dict[str, int]:
    """``ingest_headers`` and ``ingest_images`` in one pass over the files.

    The image table is written first and carries the de-identified header of each
    file; the header tables are cut from its narrow columns, so no pixel is read
    or written again.
    """
    spark = files.sparkSession
    once = pixels.read_files_once(files, parse, decode, target)
    own = [c for c in pixels.PROCESSED_COLUMNS if c != "file_path"]
    staged = headers.deidentified_headers(once, keep=[*own, "header_error"])
    counts = layout.write(
        staged.withColumn("outcome", F.when(F.col("error").isNull(), "ok").otherwise("failed")),
        IMAGES,
        partition_by=["outcome"],
        bad=F.count("error"),
        unparsed=F.count("header_error"),
    )
    stored = layout.read(spark, IMAGES).drop("error").withColumnRenamed("header_error", "error")
    layout.write(parsing.parse_errors(stored), HEADER_ERRORS)
    silver = schemas.conform(parsing.parsed_rows(stored), schemas.HEADERS)
    rows = layout.write(silver, HEADERS)["rows"]
    log_run(
        spark,
        layout.audit,
        schemas.JOB_HEADERS_INGEST,
        rows,
        silver.schema.simpleString(),
        f"{rows} files parsed, {counts['unparsed']} quarantined",
    )
    return {
        "headers": rows,
        "headers_failed": counts["unparsed"],
        "images": counts["rows"] - counts["bad"],
        "images_failed": counts["bad"],
    }


def read_images(spark: SparkSession, layout: Layout) -> DataFrame:
    """image_id, file_path, height, width, pixels, content_hash of every processed image."""
    stored = layout.read(spark, IMAGES).where("outcome = 'ok'")
    return stored.select(*[c for c in pixels.PROCESSED_COLUMNS if c != "error"])


def image_errors(spark: SparkSession, layout: Layout) -> DataFrame:
    return layout.read(spark, IMAGES).where("outcome = 'failed'").select("file_path", "error")


def image_digests(spark: SparkSession, layout: Layout) -> DataFrame:
    """(file_name, content_hash) for the duplicate check; pixels are not read."""
    return read_images(spark, layout).select(
        F.concat("image_id", F.lit(".png")).alias("file_name"), "content_hash"
    )


def run_quality_checks(
    spark: SparkSession, layout: Layout, digests: DataFrame, sample: int | None = None
) -> DataFrame:
    """All checks over silver and bronze -> results table. Failing checks do not fail the job."""
    results = quality.suite(
        layout.read(spark, HEADERS), layout.read(spark, CLASS_INFO), digests, sample=sample
    )
    rows = layout.write(results.coalesce(1), DQ_RESULTS)["rows"]
    log_run(spark, layout.audit, schemas.JOB_QUALITY, rows, notes=f"{rows} checks")
    return layout.read(spark, DQ_RESULTS)


def check_delivery(
    spark: SparkSession,
    layout: Layout,
    delivery: str,
    headers_rows: DataFrame,
    class_info: DataFrame,
    digests: DataFrame,
) -> DataFrame:
    """All checks over everything delivered so far; only this delivery is read.

    Its state replaces that of an earlier delivery of the same name.
    """
    state = check_state.delivery_state(headers_rows, class_info, digests)
    named = state.withColumn("delivery", F.lit(delivery)).coalesce(1)
    layout.write(named, CHECK_STATE, partition_by=["delivery"], replace_partitions=True)
    results = check_state.merged_results(layout.read(spark, CHECK_STATE))
    rows = layout.write(results.coalesce(1), DQ_RESULTS)["rows"]
    log_run(spark, layout.audit, schemas.JOB_QUALITY, rows, notes=f"{rows} checks, delivery {delivery}")
    return layout.read(spark, DQ_RESULTS)


def build_model_ready(spark: SparkSession, layout: Layout) -> dict[str, int]:
    """Labels + headers -> training table partitioned by split.

    Patients with label and split are written first: the split is computed
    once, its counts come with the write, and the join starts from a table.
    """

    def in_split(name: str):
        return F.count_if(F.col("split") == name)

    patients = gold.labelled_patients(layout.read(spark, CLASS_INFO))
    counts = layout.write(
        patients, PATIENTS, train=in_split("train"), val=in_split("val"), test=in_split("test")
    )
    found = layout.read(spark, HEADERS)
    hot = hot_keys(found, "original_filename")
    rows = gold.model_ready_rows(found, layout.read(spark, PATIENTS), hot)
    final = schemas.conform(rows, schemas.MODEL_READY)
    written = layout.write(final, MODEL_READY, partition_by=["split"])["rows"]
    log_run(
        spark,
        layout.audit,
        schemas.JOB_MODEL_READY,
        written,
        final.schema.simpleString(),
        f"patients per split: train={counts['train']}, val={counts['val']}, test={counts['test']}",
    )
    return {"rows": written, "patients": counts["rows"]}


def rebuild_split(spark: SparkSession, layout: Layout, split: str) -> int:
    """The training rows of one split anew, from the headers and the written patients of the split.

    Only this partition is replaced, at the end of the write: the files of the other
    splits stay, and a failed run leaves the old rows.
    """
    found = layout.read(spark, HEADERS)
    patients = layout.read(spark, PATIENTS).where(F.col("split") == split)
    rows = gold.model_ready_rows(found, patients, hot_keys(found, "original_filename"))
    final = schemas.conform(rows, schemas.MODEL_READY)
    written = layout.write(final, MODEL_READY, partition_by=["split"], replace_partitions=True)
    log_run(
        spark,
        layout.audit,
        schemas.JOB_MODEL_READY,
        written["rows"],
        final.schema.simpleString(),
        f"split {split} alone",
    )
    return written["rows"]


def build_summaries(spark: SparkSession, layout: Layout) -> dict[str, int]:
    """Case counts, demographics and check pass rates.

    The first two read disjoint columns of the same table, so each is its own pruned scan.
    """
    model_ready = layout.read(spark, MODEL_READY)
    results = layout.read(spark, DQ_RESULTS)
    rows = {
        "case_counts": layout.write(gold.case_counts(model_ready), CASE_COUNTS)["rows"],
        "demographics": layout.write(gold.demographics(model_ready), DEMOGRAPHICS)["rows"],
        "dq_summary": layout.write(quality.summary(results), DQ_SUMMARY)["rows"],
    }
    log_run(
        spark,
        layout.audit,
        schemas.JOB_SUMMARIES,
        sum(rows.values()),
        notes=", ".join(f"{table}={n}" for table, n in rows.items()),
    )
    return rows


def ingest_manifest(topic: DataFrame, layout: Layout) -> dict[str, int]:
    """Drain a streaming arrival topic into the image manifest."""
    counts = run_manifest(
        topic,
        layout.path(MANIFEST),
        layout.path("bronze/_image_manifest_progress"),
        "json",
        times.iso_utc(times.utc_now()),
    )
    log_run(
        topic.sparkSession,
        layout.audit,
        schemas.JOB_MANIFEST,
        counts["written"],
        notes=f"{counts['seen']} messages seen",
    )
    return counts


def bucket_images(spark: SparkSession, layout: Layout, buckets: int) -> None:
    """Pixels of the processed images, shuffled once to buckets of their id.

    Run it after new images; later training sets join them in place. Choose so many
    buckets that one holds some hundred MB of pixels.
    """
    images = read_images(spark, layout).select("image_id", "pixels")
    write_bucketed(images, layout.path(BUCKETED_IMAGES), "image_id", buckets)


def build_examples(spark: SparkSession, layout: Layout, bucketed: bool = False) -> DataFrame:
    """Gold rows + processed images -> examples table, partitioned by split.

    The many passes of a training read only their partition and never repeat the
    join. With ``bucketed`` the pixels come from ``bucket_images`` and are not
    shuffled, but for those of hot file names.
    """
    ready = layout.read(spark, MODEL_READY)
    if bucketed:
        images = read_bucketed(spark, layout.path(BUCKETED_IMAGES))
    else:
        images = read_images(spark, layout)
    layout.write(gold.training_examples(ready, images), EXAMPLES, partition_by=["split"])
    return layout.read(spark, EXAMPLES)


def train_classifier(
    spark: SparkSession, layout: Layout, bucketed: bool = False, **training
) -> classifier.TrainedClassifier:
    """Gold rows + processed images -> examples table, selected model, metric log."""
    stored = build_examples(spark, layout, bucketed)
    trained = classifier.train_weighted(
        gold.rows_of_split(stored, "train"), gold.rows_of_split(stored, "val"), **training
    )
    final = classifier.test_metrics(trained, gold.rows_of_split(stored, "test"))
    layout.write(trained.run_metrics.unionByName(final), RUN_METRICS)
    trained.model.write().overwrite().save(layout.path("models/classifier"))
    return trained


def train_network(
    spark: SparkSession,
    layout: Layout,
    run: str,
    units: int = 64,
    batches: int = 16,
    bucketed: bool = False,
    phases: Sequence[epochs.Phase] = epochs.PHASES,
    **training,
) -> epochs.Trained:
    """Gold rows + processed images -> examples, both phases of epochs, metric log, best network.

    ``run`` names the folder of the checkpoints: the same name goes on from the last
    whole epoch, on the mini-batches dealt at its start.
    """
    own = f"models/runs/{run}"
    if not layout.exists(spark, f"{own}/train"):
        stored = build_examples(spark, layout, bucketed)
        for name, parts in (("val", 1), ("test", 1), ("train", batches)):
            rows = gold.rows_of_split(stored, name)
            dealt = epochs.dealt_rows(rows, F.col("file_path"), parts)
            layout.write(dealt, f"{own}/{name}", partition_by=["batch"])
    train, val, test = (layout.read(spark, f"{own}/{name}") for name in ("train", "val", "test"))
    first = train.select(F.size("features").alias("n")).first()
    if first is None:
        raise ValueError("training rows must hold both classes")
    network = epochs.Network.start(first["n"], units)
    trained = epochs.train(
        train, val, network, phases, checkpoints=layout.path(f"{own}/checkpoints"), **training
    )
    scored = epochs.score(trained.best, test).drop("features")
    final = classifier.evaluation_rows(scored, trained.pos_weight)
    layout.write(trained.run_metrics.unionByName(final), EPOCH_METRICS)
    layout.write(epochs.as_table(spark, trained.best), NETWORK)
    return trained


def new_run(name: str) -> str:
    """A name for a run that no other run has, in order of time."""
    return f"{datetime.now(UTC):%Y%m%dT%H%M%S%f}-{name}"


def _published(
    spark: SparkSession, layout: Layout, scored: DataFrame, run: str, batch: int, stamp: Column
) -> dict[str, int]:
    """Scored rows (filename, probability, rejected_because) -> predictions, alerts and dead letters.

    The rows are written once; the three tables are cut from that. All are partitioned by
    run and batch and replace their own partitions only: nothing earlier is touched, and a
    batch that is published again takes its own place.
    """
    place = {"run": F.lit(run), "batch": F.lit(batch).cast("long")}
    own = f"run = '{run}' AND batch = {batch}"

    def write(df: DataFrame, table: str, **counts) -> dict[str, int]:
        return layout.write(
            df.withColumns(place), table, partition_by=list(place), replace_partitions=True, **counts
        )

    rejected = F.count("rejected_because")
    counts = write(
        scored.select("filename", "probability", "rejected_because"), UPLOADS, rejected=rejected
    )
    if not counts["rows"]:
        return {"rows": 0, "rejected": 0, "alerts": 0}
    stored = layout.read(spark, UPLOADS).where(own)
    good = stored.where("rejected_because IS NULL").select("filename", "probability")
    predicted = schemas.conform(scoring.predictions(good), schemas.PREDICTION)
    rows = write(predicted, PREDICTIONS)["rows"]
    alerts = write(scoring.clinical_alerts(predicted, stamp), ALERTS)["rows"]
    letters = stored.where("rejected_because IS NOT NULL")
    write(letters.select("filename", "rejected_because"), DEAD_LETTERS)
    return {"rows": rows, "rejected": counts["rejected"], "alerts": alerts}


def score_images(
    spark: SparkSession,
    layout: Layout,
    model: LogisticRegressionModel | None = None,
    run: str | None = None,
) -> dict[str, int]:
    """Processed images -> prediction rows and alert rows of a new run, beside those of earlier runs.

    The name of an earlier run replaces that run.
    """
    if model is None:
        model = LogisticRegressionModel.load(layout.path("models/classifier"))
    images = read_images(spark, layout).select(
        F.concat("image_id", F.lit(".png")).alias("filename"), "pixels"
    )
    scored = classifier.score(model, images).withColumn(
        "rejected_because", F.lit(None).cast("string")
    )
    stamp = times.iso_utc(times.utc_now())
    counts = _published(spark, layout, scored, run or new_run("images"), 0, stamp)
    return {"rows": counts["rows"], "alerts": counts["alerts"]}


def score_uploads(
    uploads: DataFrame,
    layout: Layout,
    model: LogisticRegressionModel | None = None,
    decode: Callable[[bytes], np.ndarray] = pixels.rgb_pixels,
    target: tuple[int, int] = schemas.TARGET_SIZE,
    run: str | None = None,
) -> dict[str, int]:
    """Uploads (filename, content_type, content) -> screened uploads, predictions, alerts and dead
    letters of a new run, beside those of earlier runs.

    Payloads are decoded and scored once, in the write of the screened table.
    """
    spark = uploads.sparkSession
    if model is None:
        model = LogisticRegressionModel.load(layout.path("models/classifier"))
    screened = scoring.score_uploads(uploads, classifier.logits(model), decode, target)
    stamp = times.iso_utc(times.utc_now())
    return _published(spark, layout, screened, run or new_run("uploads"), 0, stamp)


def publish_uploads(
    uploads: DataFrame,
    layout: Layout,
    run: str,
    load_model: Callable[[], Callable[[np.ndarray], np.ndarray]],
    decode: Callable[[bytes], np.ndarray] = pixels.rgb_pixels,
    target: tuple[int, int] = schemas.TARGET_SIZE,
    stamp: Column | None = None,
    watch: Callable[[int], None] = lambda batch: None,
) -> dict[str, int]:
    """Drain a stream of uploads: predictions, alerts and dead letters of every micro-batch.

    ``run`` names the stream and its checkpoint. A batch that fails between two tables is
    scored and published again under its number when the stream is started again, and
    replaces what it had written. ``watch`` is called when a batch is published.
    """
    totals = {"rows": 0, "rejected": 0, "alerts": 0}

    def each(batch: DataFrame, number: int) -> None:
        scored = scoring.score_uploads(batch, load_model, decode, target)
        at = times.iso_utc(times.utc_now()) if stamp is None else stamp
        counts = _published(batch.sparkSession, layout, scored, run, number, at)
        watch(number)
        for key, count in counts.items():
            totals[key] += count

    drain_batches(uploads, layout.path(f"silver/_uploads_progress/{run}"), each)
    return totals


def run_all(class_info: DataFrame, digests: DataFrame, layout: Layout) -> None:
    """Bronze -> checks -> gold -> summaries over ingested headers; stops at the first failure."""
    spark = class_info.sparkSession
    ingest_class_info(class_info, layout)
    run_quality_checks(spark, layout, digests)
    build_model_ready(spark, layout)
    build_summaries(spark, layout)
