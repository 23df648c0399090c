"""Every operator as a named query over the synthetic tables."""

from __future__ import annotations

import json
from collections.abc import Callable

import numpy as np
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from roentra import schemas
from roentra.adapters import base_table, stream_view, view
from roentra.functions import identity, scores, times
from roentra.operators import (
    arrivals,
    classifier,
    epochs,
    gold,
    headers,
    incremental,
    labels,
    metrics,
    parsing,
    pixels,
    quality,
    scoring,
    split,
)
from roentra.operators.durable import materialize, new_table_path
from roentra.operators.skew import hot_keys
from roentra.plans import audit, dashboard, jobs
from roentra.sources import buckets, files, jdbc, jsonlines, tables
from roentra.streaming import alerts as alert_stream, arrivals as arrival_stream, newest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PUBLISHED_AT = "1704067200.500000"
POS_WEIGHT = 2383 / 617


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _silver(spark, sf):
    return headers.deidentified_headers(view(spark, sf, "fx_headers"))


def _patients(spark, sf):
    """Written first, as the job does: one scan of the labels, whatever is filtered later."""
    return materialize(gold.labelled_patients(view(spark, sf, "fx_class_info")), "patients")


def _gold(spark, sf):
    return gold.model_ready_rows(_silver(spark, sf), _patients(spark, sf))


def _digests(spark, sf):
    return quality.file_digests(view(spark, sf, "fx_files"))


def _suite(spark, sf):
    return quality.suite(
        _silver(spark, sf), view(spark, sf, "fx_class_info"), _digests(spark, sf)
    )


def _topic(spark, sf):
    return view(spark, sf, "fx_arrivals").withColumnRenamed("kafka_offset", "offset")


def _alerts(spark, sf):
    return scoring.clinical_alerts(scoring.predictions(view(spark, sf, "fx_scores")))


# --- bronze and labels -------------------------------------------------------


@query
def bronze_class_info(spark, sf):
    return schemas.conform(view(spark, sf, "fx_class_info"), schemas.CLASS_INFO)


@query
def jdbc_key_parts(spark, sf):
    """Rows that each WHERE clause of a key split reads, over keys on both sides of zero."""
    clauses = jdbc.modulo_predicates("k", 7)
    counts = view(spark, sf, "fx_keys").agg(
        *[F.count_if(F.expr(c)).alias(f"c{i}") for i, c in enumerate(clauses)]
    )
    rows = [F.struct(F.lit(i).alias("part"), F.col(f"c{i}").alias("n")) for i in range(7)]
    return counts.select(F.inline(F.array(*rows)))


@query
def distinct_patients(spark, sf):
    return labels.distinct_count(view(spark, sf, "fx_class_info"), "patient_id")


@query
def binary_label(spark, sf):
    return labels.with_binary_label(view(spark, sf, "fx_class_info"))


@query
def patient_labels(spark, sf):
    return labels.patient_labels(view(spark, sf, "fx_class_info"))


# --- silver ------------------------------------------------------------------


@query
def silver_headers(spark, sf):
    return _silver(spark, sf)


@query
def age_buckets(spark, sf):
    return headers.age_bucket_counts(_silver(spark, sf))


@query
def header_value_counts(spark, sf):
    return headers.value_counts(view(spark, sf, "fx_headers"))


@query
def header_sample_counts(spark, sf):
    """The quick look at a new delivery: its first 200 files by name, out of all files."""
    return headers.value_counts(view(spark, sf, "fx_headers"), sample=200)


@query
def page_headers(spark, sf):
    return headers.page_headers(spark.read.parquet(f"{sf}/pages.parquet"))


def _parse_json_header(content: bytes) -> dict:
    header = json.loads(content)
    if header.get("modality") is None:
        raise ValueError("no modality")
    return header


def _header_files(spark, sf):
    # Some files have a word where a number of rows should be.
    number = F.when(F.col("file_path").endswith("5.dcm"), "many").otherwise(
        F.col("n_rows").cast("string")
    )
    raw = view(spark, sf, "fx_headers").withColumn("n_rows", number)
    content = F.to_json(F.struct(*schemas.RAW_HEADER.fieldNames())).cast("binary")
    return raw.select(F.col("file_path").alias("path"), content.alias("content"))


def _parsed(spark, sf):
    return parsing.parse_headers(_header_files(spark, sf), _parse_json_header)


@query
def parsed_headers(spark, sf):
    return headers.deidentified_headers(parsing.parsed_rows(_parsed(spark, sf)))


@query
def parse_errors(spark, sf):
    return parsing.parse_errors(_parsed(spark, sf))


@query
def error_sample(spark, sf):
    return parsing.sample_errors(parsing.parse_errors(_parsed(spark, sf)), 5)


@query
def processed_paths(spark, sf):
    name = identity.swap_suffix(identity.base_name(F.col("file_path")), ".dcm", ".png")
    rows = view(spark, sf, "fx_headers")
    return rows.select("file_path", identity.join_path("processed/", name).alias("processed_path"))


# --- files on disk ------------------------------------------------------------


def _write_files(files: DataFrame, folder: str, tail: int = 0) -> None:
    """Each row (file_name, content) as a file of its own in a folder all tasks reach.

    ``tail`` zero bytes follow the content: as a hole, which is listed and read like other
    bytes but takes no disk, where the store is a local file system.
    """

    def run(batches):
        store, place = pyarrow.fs.FileSystem.from_uri(folder)
        store.create_dir(place)
        holes = tail and isinstance(store, pyarrow.fs.LocalFileSystem)
        for batch in batches:
            for name, content in zip(batch["file_name"], batch["content"]):
                if holes:
                    with open(f"{place}/{name}", "wb") as out:
                        out.write(content)
                        out.truncate(len(content) + tail)
                    continue
                with store.open_output_stream(f"{place}/{name}") as out:
                    out.write(bytes(content))
                    out.write(bytes(tail))
            yield batch[["file_name"]]

    rows = files.select("file_name", F.col("content").cast("binary").alias("content"))
    rows.mapInPandas(run, "file_name string").write.format("noop").mode("overwrite").save()


def _named_header_files(spark, sf):
    """Header files by name, dealt out by path, so that a small table is written as files by all cores."""
    rows = _header_files(spark, sf).repartition(files.listing_parts(spark), "path")
    return rows.withColumn("file_name", identity.base_name(F.col("path")))


def _new_folder(spark, name):
    """A fresh folder as a URI."""
    path = new_table_path(spark, name)
    scheme, colon, rest = path.partition(":")
    if not colon:
        return f"file://{path}"
    return path if rest.startswith("//") else f"{scheme}://{rest}"


def _text_files(spark, sf):
    """The texts as files, some with a suffix in capitals."""
    rows = view(spark, sf, "fx_files")
    number = F.regexp_extract("file_name", "([0-9]+)", 1).cast("long")
    name = F.when(number % 7 == 0, F.upper("file_name")).otherwise(F.col("file_name"))
    folder = _new_folder(spark, "files")
    _write_files(rows.select(name.alias("file_name"), F.coalesce("content", F.lit("")).alias("content")), folder)
    return folder


@query
def files_listed(spark, sf):
    return files.list_files(spark, _text_files(spark, sf), ".png").select("file_name", "length")


@query
def files_read(spark, sf):
    found = files.read_files(spark, _text_files(spark, sf), ".png")
    return quality.file_digests(found)


@query
def published_files(spark, sf):
    """Events of the files of a folder: of those there at first, then of the others."""
    rows = _named_header_files(spark, sf)
    folder, out = _new_folder(spark, "raw"), new_table_path(spark, "events")
    early = F.pmod(F.xxhash64("file_name"), F.lit(2)) == 0
    for part in (rows.where(early), rows.where(~early)):
        _write_files(part, folder)
        arrival_stream.run_publisher(
            files.stream_files(spark, folder, ".dcm"), f"{out}/progress", "parquet",
            {"path": f"{out}/table"}, F.lit(PUBLISHED_AT).cast("decimal(18,6)"),
        )
    events = arrivals.parsed_messages(spark.read.schema("value string").parquet(f"{out}/table"))
    return events.select(
        F.col("event")["patient_id"].alias("patient_id"),
        identity.base_name(F.col("event")["file_path"]).alias("file_name"),
        F.col("event")["ingestion_timestamp"].cast("double").alias("stamp"),
    )


def _parse_json_line(file) -> dict:
    """The header is the first line; what follows stands for pixels and is not read."""
    return _parse_json_header(file.readline())


@query
def new_headers(spark, sf):
    """Silver headers after three runs over a growing folder of large files, and what they opened."""
    line = F.concat("content", F.lit(b"\n")).alias("content")
    large = _named_header_files(spark, sf).select("file_name", line)
    layout, folder = jobs.Layout(new_table_path(spark, "lake")), _new_folder(spark, "raw")
    early = F.pmod(F.xxhash64("file_name"), F.lit(2)) == 0
    counts = []
    for part in (large.where(early), large.where(~early), None):
        if part is not None:
            _write_files(part, folder, tail=200_000)
        listing = files.list_versions(spark, folder, ".dcm")
        counts.append(jobs.ingest_new_headers(listing, layout, _parse_json_line))
    opened = sum(c["opened"] for c in counts)
    share = sum(c["bytes_read"] for c in counts) / max(1, listing.agg(F.sum("length")).first()[0] or 1)
    found = layout.read(spark, jobs.HEADERS)
    return found.withColumn("file_path", identity.base_name(F.col("file_path"))).select(
        "original_filename", "modality", "patient_age_bucket", "rows", "file_path",
        F.lit(opened).cast("long").alias("opened"),
        F.lit(counts[2]["opened"]).cast("long").alias("opened_last"),
        F.lit(share < 0.5).alias("read_a_part"),
    )


# --- tables and logs ---------------------------------------------------------


@query
def table_round_trip(spark, sf):
    """Events written by type and read back: rows as the write counted them, and as read."""
    path = new_table_path(spark, "events")
    events = base_table(spark, sf, "events")
    written = tables.write_table(events, path, partition_by=["event_type"])["rows"]
    found = tables.read_table(spark, path).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return found.select("event_type", "n", F.lit(written).cast("bigint").alias("written"))


@query
def csv_round_trip(spark, sf):
    path = new_table_path(spark, "customers")
    rows = base_table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    tables.write_csv(rows, path)
    return tables.read_csv(spark, path, rows.schema)


@query
def json_lines_round_trip(spark, sf):
    """Two appends, and what reading them as a log finds."""
    path = new_table_path(spark, "audit")
    runs = view(spark, sf, "fx_audit").select("job_name", "row_count", "notes")
    jsonlines.append_json_lines(runs, path)
    jsonlines.append_json_lines(runs.where("row_count % 2 = 0"), path)
    return jsonlines.read_json_lines(spark, path, runs.schema)


@query
def clock_stamps(spark, sf):
    rows = base_table(spark, sf, "events")
    return rows.select("event_id", times.iso_utc(F.col("ts")).alias("stamp"))


def _log_with_broken_lines(spark, sf):
    """A log in which every fifth user's lines break off."""
    runs = view(spark, sf, "fx_audit").select("job_name", "row_count", "notes")
    line = F.to_json(F.struct(*runs.columns), {"ignoreNullFields": "false"})
    broken = F.when(F.col("row_count") % 5 == 0, F.lit('{"job_name": "cut')).otherwise(line)
    path = new_table_path(spark, "log")
    runs.select(broken.alias("value")).write.text(path)
    return path, runs.schema


@query
def log_lines_read(spark, sf):
    path, schema = _log_with_broken_lines(spark, sf)
    return jsonlines.read_json_lines(spark, path, schema)


@query
def packed_log(spark, sf):
    """A log of many small appends, packed, appended to and packed again: its rows and its files."""
    runs = view(spark, sf, "fx_audit").select("job_name", "row_count", "notes")
    path = new_table_path(spark, "log")
    for part in (runs.where("row_count % 2 = 0"), runs.where("row_count % 2 = 1")):
        jsonlines.append_json_lines(part.repartition(40, "notes"), path)
        jsonlines.pack(spark, path)
        jsonlines.remove_covered(spark, path)
    _, packed, _ = jsonlines.manifest(spark, path)
    found = jsonlines.read_json_lines(spark, path, runs.schema)
    return found.withColumn("files", F.lit(len(packed)).cast("long"))


@query
def log_lines_broken(spark, sf):
    path, schema = _log_with_broken_lines(spark, sf)
    lines = jsonlines.broken_lines(spark, path, schema)
    return lines.groupBy("line").agg(F.count(F.lit(1)).alias("n"))


def _layout(spark, sf):
    """All batch jobs over the given tables, into a new lake."""
    layout = jobs.Layout(new_table_path(spark, "lake"))
    jobs.ingest_headers(_header_files(spark, sf), layout, _parse_json_header)
    jobs.run_all(view(spark, sf, "fx_class_info"), _digests(spark, sf), layout)
    return layout


@query
def lake_case_counts(spark, sf):
    """The last table of the whole run, from files to summaries."""
    return _layout(spark, sf).read(spark, jobs.CASE_COUNTS)


@query
def lake_audit(spark, sf):
    """The audit rows of the whole run, without their times."""
    runs = audit.read_runs(spark, _layout(spark, sf).audit)
    return runs.select("job_name", "row_count", F.col("schema").isNotNull().alias("has_schema"))


# --- data quality ------------------------------------------------------------


@query
def dq_schema_completeness(spark, sf):
    return quality.schema_completeness(_silver(spark, sf))


@query
def dq_referential_integrity(spark, sf):
    return quality.referential_integrity(_silver(spark, sf), view(spark, sf, "fx_class_info"))


@query
def dq_duplicates(spark, sf):
    return quality.duplicate_detection(_digests(spark, sf))


@query
def dq_age_range(spark, sf):
    return quality.age_range_validity(_silver(spark, sf))


@query
def dq_results(spark, sf):
    return _suite(spark, sf)


@query
def dq_report(spark, sf):
    return quality.report(_suite(spark, sf))


@query
def dq_summary(spark, sf):
    rows = quality.summary(_suite(spark, sf))
    return rows.withColumn("pass_rate", F.round("pass_rate", 6))


@query
def duplicate_pairs(spark, sf):
    return quality.duplicate_pairs(view(spark, sf, "fx_files"))


def _third(df, key, i):
    return df.where(F.pmod(F.xxhash64(key), F.lit(3)) == i)


@query
def dq_merged(spark, sf):
    """The checks over three deliveries, none of which is read twice."""
    layout = jobs.Layout(new_table_path(spark, "lake"))
    silver, info, digests = _silver(spark, sf), view(spark, sf, "fx_class_info"), _digests(spark, sf)
    for i in range(3):
        results = jobs.check_delivery(
            spark,
            layout,
            f"delivery-{i}",
            _third(silver, "file_path", i),
            _third(info, "patient_id", i),
            _third(digests, "file_name", i),
        )
    return results


def _summaries(spark, sf):
    """Summaries after three deliveries: with wrong labels and strange headers, more, and put right."""
    state = incremental.Summaries(spark, new_table_path(spark, "summaries"))
    silver, info = _silver(spark, sf), view(spark, sf, "fx_class_info")
    hits = F.pmod(F.xxhash64("patient_id"), F.lit(4)) == 0
    wrong = info.where(hits).withColumn("class", F.lit("Lung Opacity"))
    strange = _third(silver, "file_path", 2).withColumn("modality", F.lit("XX"))

    def signed(df, weight):
        return df.withColumn("weight", F.lit(weight))

    first_labels = signed(info.where(~F.coalesce(hits, F.lit(False))).unionByName(wrong), 1)
    first = signed(_third(silver, "file_path", 0).unionByName(strange), 1)
    state.deliver(1, first, first_labels)
    state.deliver(2, signed(_third(silver, "file_path", 1), 1), first_labels.limit(0))
    put_right = signed(wrong, -1).unionByName(signed(info.where(hits), 1))
    headers_right = signed(strange, -1).unionByName(signed(_third(silver, "file_path", 2), 1))
    state.deliver(3, headers_right, put_right)
    return state


@query
def incremental_case_counts(spark, sf):
    return _summaries(spark, sf).case_counts()


@query
def incremental_demographics(spark, sf):
    return _summaries(spark, sf).demographics()


# --- gold and summaries ------------------------------------------------------


@query
def patient_split(spark, sf):
    return gold.labelled_patients(view(spark, sf, "fx_class_info")).select("patient_id", "split")


@query
def patient_split_two_way(spark, sf):
    """Shares that leave no test split."""
    patients = labels.patient_labels(view(spark, sf, "fx_class_info"))
    return split.assign_patient_splits(patients, train_share=0.8, val_share=0.2).select(
        "patient_id", "split"
    )


@query
def split_counts(spark, sf):
    patients = _patients(spark, sf)
    return split.split_counts(patients, gold.model_ready_rows(_silver(spark, sf), patients))


@query
def gold_model_ready(spark, sf):
    return _gold(spark, sf)


@query
def split_train(spark, sf):
    return gold.rows_of_split(_gold(spark, sf), "train")


@query
def case_counts(spark, sf):
    return gold.case_counts(_gold(spark, sf))


@query
def demographics(spark, sf):
    return gold.demographics(_gold(spark, sf))


@query
def class_weight(spark, sf):
    weight = labels.class_weight(gold.rows_of_split(_gold(spark, sf), "train"))
    return weight.withColumn("pos_weight", F.round("pos_weight", 6))


@query
def training_examples(spark, sf):
    hot = hot_keys(_silver(spark, sf), "original_filename")
    examples = gold.training_examples(_gold(spark, sf), view(spark, sf, "fx_pixels"), hot)
    return examples.select(
        "original_filename", "label", "split", F.size("pixels").alias("n_pixels")
    )


@query
def training_examples_bucketed(spark, sf):
    """The same from images kept in buckets of their id, which are not shuffled again."""
    images, path = view(spark, sf, "fx_pixels"), new_table_path(spark, "images")
    named = images.select(F.col("image_id").cast("string").alias("image_id"), "pixels")
    buckets.write_bucketed(named, path, "image_id", 16)
    hot = hot_keys(_silver(spark, sf), "original_filename")
    stored = buckets.read_bucketed(spark, path)
    examples = gold.training_examples(_gold(spark, sf), stored, hot)
    return examples.select(
        "original_filename", "label", "split", F.size("pixels").alias("n_pixels")
    )


# --- dashboard tables --------------------------------------------------------


@query
def ops_metrics(spark, sf):
    return dashboard.ops_metrics(view(spark, sf, "fx_audit"))


@query
def ops_run_history(spark, sf):
    return dashboard.run_history(view(spark, sf, "fx_audit"))


@query
def dash_case_volumes(spark, sf):
    return dashboard.case_volumes(gold.case_counts(_gold(spark, sf)))


@query
def dash_demographics(spark, sf):
    return dashboard.demographics_preview(gold.demographics(_gold(spark, sf)))


# --- arrival events ----------------------------------------------------------


@query
def arrival_events(spark, sf):
    files = view(spark, sf, "fx_headers").select(F.col("file_path").alias("path"))
    return arrivals.arrival_events(files, F.lit(PUBLISHED_AT).cast("decimal(18,6)"))


@query
def arrival_manifest(spark, sf):
    return arrivals.arrival_manifest(_topic(spark, sf))


@query
def arrival_rejects(spark, sf):
    return arrivals.reject_counts(_topic(spark, sf))


@query
def arrival_manifest_stream(spark, sf):
    """The manifest built by a streaming job over the whole events table."""
    topic = stream_view(spark, sf, "fx_arrivals").withColumnRenamed("kafka_offset", "offset")
    out = new_table_path(spark, "manifest")
    arrival_stream.run_manifest(topic, f"{out}/table", f"{out}/progress", fmt="parquet")
    return spark.read.schema(arrivals.arrival_manifest(topic).schema).parquet(f"{out}/table")


@query
def clinical_alerts_stream(spark, sf):
    """Alerts published by a streaming job over the whole events table."""
    scored = stream_view(spark, sf, "fx_scores")
    out = new_table_path(spark, "alerts")
    alert_stream.run_alerts(scored, f"{out}/progress", "parquet", {"path": f"{out}/table"})
    return spark.read.schema(alert_stream.flagged_alerts(scored).schema).parquet(f"{out}/table")


@query
def arrival_unknown_fields(spark, sf):
    """Messages with a nested field that no schema names, kept in a table and read by path."""
    site = F.concat(F.lit('{"device":{"site":"s'), (F.col("offset") % 7).cast("string"), F.lit('","tags":[1,'))
    more = F.concat(site, (F.col("offset") % 5).cast("string"), F.lit("]},"))
    value = F.when(F.startswith(F.col("value"), F.lit("{")), F.concat(more, F.expr("substring(value, 2)")))
    topic = _topic(spark, sf).withColumn("value", F.coalesce(value, F.col("value")))
    bodies = materialize(arrivals.arrival_bodies(topic), "bodies")
    found = arrivals.body_fields(
        bodies, site=("$.device.site", "string"), tag=("$.device.tags[1]", "bigint"), none=("$.device.no", "string")
    )
    return found.drop("body")


@query
def arrival_manifest_replayed(spark, sf):
    """The manifest of a topic whose messages come again, in other micro-batches and after a restart."""
    rows = view(spark, sf, "fx_arrivals").withColumnsRenamed(
        {"kafka_offset": "offset", "kafka_timestamp": "timestamp"}
    )
    rows = rows.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    out = new_table_path(spark, "manifest")
    # The given events span a month.
    replays = arrival_stream.Replays(delay="40 days")
    for delivered in (rows, rows.where("offset % 3 = 0"), rows):
        delivered.write.mode("append").parquet(f"{out}/topic")
        files = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 8)
        topic = files.parquet(f"{out}/topic")
        arrival_stream.run_manifest(
            topic, f"{out}/table", f"{out}/progress", fmt="parquet", replays=replays
        )
    return spark.read.schema(arrivals.arrival_manifest(rows).schema).parquet(f"{out}/table")


# --- predictions and alerts --------------------------------------------------


@query
def predictions(spark, sf):
    rows = scoring.predictions(view(spark, sf, "fx_scores"))
    return rows.select(*schemas.PREDICTION.fieldNames())


@query
def clinical_alerts(spark, sf):
    return _alerts(spark, sf)


@query
def recent_alerts(spark, sf):
    return scoring.recent_alerts(_alerts(spark, sf))


def _alert_topic(spark, sf):
    return alert_stream.alert_messages(_alerts(spark, sf))


@query
def topic_alerts(spark, sf):
    """The newest alerts out of the messages of their topic."""
    newest_rows = scoring.recent_alerts(arrivals.parse_alerts(_alert_topic(spark, sf)))
    return newest_rows.withColumn("alert_timestamp", F.col("alert_timestamp").cast("timestamp_ntz"))


@query
def standing_alerts(spark, sf):
    """The newest alerts as a stream over the topic keeps them, after many micro-batches."""
    out = new_table_path(spark, "newest")
    _alert_topic(spark, sf).repartition(12, "value").write.parquet(f"{out}/topic")
    files = spark.readStream.schema("value string").option("maxFilesPerTrigger", 4)
    newest.run_topic(files.parquet(f"{out}/topic"), f"{out}/table", f"{out}/progress")
    rows = newest.newest_alerts(spark, f"{out}/table")
    return rows.withColumn("alert_timestamp", F.col("alert_timestamp").cast("timestamp_ntz"))


@query
def alert_banners(spark, sf):
    return scoring.alert_banners(_alerts(spark, sf))


def _read_grey_square(content: bytes) -> np.ndarray:
    """Stand-in for an image format: a signature, then 4 x 4 grey bytes in hexadecimal digits."""
    if not content.startswith(b"GIF89a"):
        raise ValueError("no image")
    grey = np.frombuffer(bytes.fromhex(content[6:].decode()), dtype=np.uint8).reshape(4, 4)
    return np.stack([grey, grey, grey], axis=-1)


@query
def reject_non_image(spark, sf):
    uploads = view(spark, sf, "fx_uploads").withColumn("payload", F.col("payload").cast("binary"))
    screened = scoring.screen_uploads(uploads, _read_grey_square)
    return screened.select(
        "page_id", F.col("rejected_because").isNull().alias("accepted"), "rejected_because"
    )


# --- evaluation --------------------------------------------------------------


@query
def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(view(spark, sf, "fx_scores"))


@query
def classification_report(spark, sf):
    rows = metrics.classification_report(view(spark, sf, "fx_scores"))
    return rows.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query
def score_quality(spark, sf):
    return metrics.score_quality(view(spark, sf, "fx_gaps"))


@query
def confusion_matrix_gaps(spark, sf):
    """Rows without a label or a score count in no cell."""
    return metrics.confusion_matrix(view(spark, sf, "fx_gaps"))


@query
def auroc_gaps(spark, sf):
    return metrics.auroc(view(spark, sf, "fx_gaps")).select(F.round("auroc", 6).alias("auroc"))


@query
def auroc(spark, sf):
    return metrics.auroc(view(spark, sf, "fx_scores")).select(F.round("auroc", 6).alias("auroc"))


@query
def weighted_log_loss(spark, sf):
    loss = metrics.weighted_log_loss(view(spark, sf, "fx_logits"), POS_WEIGHT)
    return loss.select(F.round("loss", 6).alias("loss"))


@query
def sigmoid_scores(spark, sf):
    rows = view(spark, sf, "fx_logits")
    return rows.select("row_id", F.round(scores.sigmoid(F.col("logit")), 6).alias("probability"))


@query
def best_epoch(spark, sf):
    return metrics.best_epoch(view(spark, sf, "fx_run_metrics"))


# --- images ------------------------------------------------------------------


@query
def pixels_minmax(spark, sf):
    images = view(spark, sf, "fx_pixels").withColumn(
        "pixels", pixels.scale_to_byte(F.col("pixels"))
    )
    return pixels.pixels_long(images)


def _grid(images: DataFrame, width: int) -> DataFrame:
    long = pixels.pixels_long(images)
    column = F.col("pos") % width
    return long.select(
        "image_id", ((F.col("pos") - column) / width).cast("int").alias("r"), column.alias("c"), "v"
    )


@query
def pixels_resize(spark, sf):
    resized = pixels.resize_pixels(view(spark, sf, "fx_pixels"), (3, 3))
    return _grid(resized, 3).withColumn("v", F.round("v", 5))


@query
def pixels_enlarge(spark, sf):
    resized = pixels.resize_pixels(view(spark, sf, "fx_pixels"), (12, 12))
    return _grid(resized, 12).withColumn("v", F.round("v", 5))


@query
def pixels_mixed(spark, sf):
    """Fewer rows, more columns."""
    resized = pixels.resize_pixels(view(spark, sf, "fx_pixels"), (3, 12))
    return _grid(resized, 12).withColumn("v", F.round("v", 5))


@query
def images_processed(spark, sf):
    return _grid(pixels.preprocess_pixel_table(view(spark, sf, "fx_pixels"), (3, 3)), 3)


@query
def pixels_bilinear(spark, sf):
    resized = pixels.resize_pixels(view(spark, sf, "fx_pixels"), (3, 3), "bilinear")
    return _grid(resized, 3).withColumn("v", F.round("v", 5))


@query
def pixels_standardize(spark, sf):
    images = view(spark, sf, "fx_pixels").withColumn(
        "pixels", pixels.standardize_channels(pixels.scale_to_byte(F.col("pixels")))
    )
    channels = images.select("image_id", F.posexplode("pixels").alias("channel", "pixels"))
    return channels.select(
        "image_id", "channel", F.posexplode("pixels").alias("pos", "v")
    ).withColumn("v", F.round("v", 5))


def _parse_grey_rows(content: bytes) -> np.ndarray:
    grey = np.array(json.loads(content)).reshape(8, 8)
    return np.stack([grey, grey, grey], axis=-1)


@query
def upload_features(spark, sf):
    """All images as uploads of grey rows, resized to 4 x 4 and standardised."""
    grey = pixels.scale_to_byte(F.col("pixels"))
    uploads = view(spark, sf, "fx_pixels").select(
        F.col("image_id").cast("string").alias("filename"),
        F.to_json(grey).cast("binary").alias("content"),
    )
    features = pixels.upload_features(uploads, _parse_grey_rows, (4, 4))
    long = features.select("filename", F.posexplode("features").alias("at", "v"))
    position = F.col("at") % 16
    return long.select(
        "filename",
        ((F.col("at") - position) / 16).cast("int").alias("channel"),
        position.alias("pos"),
        F.round("v", 5).alias("v"),
    )


# --- models ------------------------------------------------------------------


def _linear_head():
    """A fixed linear model: weight i is ((37 i) mod 11 - 5) / 8."""
    weights = ((np.arange(64) * 37) % 11 - 5) / 8.0
    return lambda features: features @ weights


@query
def batch_scores(spark, sf):
    images = view(spark, sf, "fx_pixels").withColumn(
        "pixels", F.when(F.col("image_id") % 9 != 0, F.col("pixels"))
    )
    scored = scoring.score_batches(images, "pixels", _linear_head)
    return scored.select("image_id", F.round("probability", 6).alias("probability"))


def _upload_head():
    """A fixed linear model of 48 features: weight i is ((37 i) mod 11 - 5) / 8."""
    weights = ((np.arange(48) * 37) % 11 - 5) / 8.0
    return lambda features: features @ weights


@query
def upload_alerts(spark, sf):
    """From uploads to alerts: some are no images, some payloads are broken."""
    scored = scoring.score_uploads(_uploads(spark, sf), _upload_head, _parse_grey_rows, (4, 4))
    accepted = scored.where("rejected_because IS NULL")
    return alert_stream.flagged_alerts(accepted, F.lit(PUBLISHED_AT))


def _uploads(spark, sf):
    """All images as uploads of grey rows; a tenth are no images, a tenth are broken."""
    grey = F.to_json(pixels.scale_to_byte(F.col("pixels")))
    kind = F.col("image_id") % 10
    return view(spark, sf, "fx_pixels").select(
        F.col("image_id").cast("string").alias("filename"),
        F.when(kind == 0, "text/plain").otherwise("image/png").alias("content_type"),
        F.when(kind == 1, "broken").otherwise(grey).cast("binary").alias("content"),
    )


def _published(spark, sf, table):
    """Uploads as a stream of micro-batches, published by two runs."""
    layout = jobs.Layout(new_table_path(spark, "lake"))
    uploads = _uploads(spark, sf)
    uploads.repartition(6, "filename").write.parquet(layout.path("uploads"))
    for run in ("first", "second"):
        files = spark.readStream.schema(uploads.schema).option("maxFilesPerTrigger", 3)
        jobs.publish_uploads(
            files.parquet(layout.path("uploads")), layout, run, _upload_head,
            _parse_grey_rows, (4, 4), F.lit(PUBLISHED_AT),
        )
    return layout.read(spark, table).drop("batch")


@query
def published_alerts(spark, sf):
    return _published(spark, sf, jobs.ALERTS)


@query
def published_predictions(spark, sf):
    return _published(spark, sf, jobs.PREDICTIONS)


@query
def dead_letters(spark, sf):
    return _published(spark, sf, jobs.DEAD_LETTERS)


def _examples(spark, sf):
    """All images as training examples, split by image id."""
    images = view(spark, sf, "fx_pixels").select(
        F.col("image_id").cast("string").alias("image_id"),
        (F.col("label") >= 5).cast("int").alias("label"),
        "pixels",
    )
    # Training passes over the examples many times: write them once.
    return materialize(split.assign_patient_splits(images, "image_id"), "examples")


def _trained(examples):
    return classifier.train_weighted(
        gold.rows_of_split(examples, "train"), gold.rows_of_split(examples, "val")
    )


@query
def trained_scores(spark, sf):
    examples = _examples(spark, sf)
    scored = classifier.score(_trained(examples).model, gold.rows_of_split(examples, "test"))
    return scored.select("image_id", "label", F.round("probability", 6).alias("probability"))


@query
def test_evaluation(spark, sf):
    examples = _examples(spark, sf)
    return classifier.test_metrics(_trained(examples), gold.rows_of_split(examples, "test"))


@query
def candidate_metrics(spark, sf):
    return _trained(_examples(spark, sf)).run_metrics


@query
def training_facts(spark, sf):
    """What the training log says about its rows."""
    log = _trained(_examples(spark, sf)).run_metrics
    facts = log.where(F.col("metric").isin("training_set_size", "pos_weight"))
    return facts.select("metric", F.round("value", 6).alias("value"))


@query
def head_evaluation(spark, sf):
    """The evaluation of a test split, with a fixed model in the place of a trained one."""
    examples = _examples(spark, sf)
    pos_weight = labels.class_weight(gold.rows_of_split(examples, "train")).first()["pos_weight"]
    scored = scoring.score_batches(gold.rows_of_split(examples, "test"), "pixels", _linear_head)
    p = F.col("probability")
    rows = classifier.evaluation_rows(
        scored.withColumn("logit", F.log(p) - F.log(1 - p)), pos_weight
    )
    return rows.select("metric", F.round("value", 6).alias("value"))


@query
def fit_gradient(spark, sf):
    """Gradient of the training objective at the fitted weights: zero where it is least."""
    examples = _examples(spark, sf)
    train = gold.rows_of_split(examples, "train")
    trained = classifier.train_weighted(
        train, gold.rows_of_split(examples, "val"), reg_params=(0.1,), max_iter=500
    )
    rows = classifier.objective_gradient(trained, train, 0.1)
    return rows.select("feature", (F.round("gradient", 3) + F.lit(0.0)).alias("gradient"))


def _fixed_network() -> epochs.Network:
    """64 inputs under 3 units: weight k of the layer is ((37 k) mod 13 - 6) / 16, of the units'
    offsets (k - 1) / 8, of the head (k + 1) / 4, and 1/16 is added to the logit."""
    layer = ((np.arange(192) * 37) % 13 - 6) / 16
    units = np.arange(3)
    weights = np.concatenate([layer, (units - 1) / 8, (units + 1) / 4, [1 / 16]])
    return epochs.Network(64, 3, weights)


def _dealt(examples, split_name, batches):
    """Mini-batches of one split, with the bare pixels as features."""
    rows = gold.rows_of_split(examples, split_name)
    return epochs.deal(rows, F.col("image_id"), batches, F.col("pixels").cast("array<double>"))


@query
def step_gradient(spark, sf):
    """Mean loss and gradient over the training rows, summed over mini-batches, at fixed weights."""
    rows = _dealt(_examples(spark, sf), "train", 4)
    pos_weight = labels.class_weight(rows).first()["pos_weight"]
    network, tasks = _fixed_network(), epochs.count_tasks(rows)
    parts = [
        epochs.batch_gradient(rows.where(F.col("batch") == b), network, pos_weight, tasks)
        for b in range(4)
    ]
    n, loss, gradient = (sum(column) for column in zip(*[p for p in parts if p]))
    values = [("loss", 0, loss / n)] + [("slope", i, g) for i, g in enumerate((gradient / n).tolist())]
    found = spark.createDataFrame(values, "kind string, position long, value double")
    return found.withColumn("value", F.round("value", 6) + F.lit(0.0))


def _epochs(spark, sf, **options):
    examples = _examples(spark, sf)
    rows, val = _dealt(examples, "train", 2), _dealt(examples, "val", 1)
    return epochs.train(rows, val, epochs.Network.start(64, 8), **options)


@query
def epoch_facts(spark, sf):
    """Of every epoch of both phases the rate and the rows it read, as the metric log has them."""
    log = _epochs(spark, sf).run_metrics
    facts = log.where(F.col("metric").isin("learning_rate", "train_rows"))
    return facts.withColumn("value", F.round("value", 9))


@query
def epoch_metrics(spark, sf):
    """The whole metric log of both phases, stopped after five epochs and resumed."""
    path = new_table_path(spark, "epochs")
    _epochs(spark, sf, checkpoints=path, stop_after=5)
    return _epochs(spark, sf, checkpoints=path).run_metrics
