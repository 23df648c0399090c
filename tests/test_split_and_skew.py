import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from roentra.operators import gold, labels, skew, split


def expected_split(ids, seed=42):
    order = sorted(ids, key=lambda i: hashlib.sha256(f"{seed}:{i}".encode()).hexdigest())
    n = len(order)
    train_end = int(n * 0.70)
    val_end = train_end + int(n * 0.15)
    return {
        i: "train" if k < train_end else "val" if k < val_end else "test"
        for k, i in enumerate(order)
    }


@pytest.mark.parametrize("n", [1, 2, 3, 7, 20, 90, 1000])
@pytest.mark.parametrize("digits", [1, 4])
def test_split_matches_global_ranking(spark, n, digits):
    ids = [f"p{i}" for i in range(n)]
    df = spark.createDataFrame([(i,) for i in ids], "patient_id string").repartition(5)
    out = split.assign_patient_splits(df, prefix_digits=digits)
    got = {r["patient_id"]: r["split"] for r in out.collect()}
    assert got == expected_split(ids)


def test_split_truncates_like_double_arithmetic(spark):
    df = spark.range(90).select(F.col("id").cast("string").alias("patient_id"))
    counts = Counter(r["split"] for r in split.assign_patient_splits(df).collect())
    assert counts == {"train": 62, "val": 13, "test": 15}


def test_split_drops_null_ids_and_survives_no_patients(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "patient_id string")
    assert split.assign_patient_splits(df).count() == 2
    assert split.assign_patient_splits(df.where("false")).count() == 0


def test_split_does_not_depend_on_partitioning(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("patient_id"))
    one = {tuple(r) for r in split.assign_patient_splits(df.coalesce(1)).collect()}
    many = {tuple(r) for r in split.assign_patient_splits(df.repartition(13)).collect()}
    assert one == many


def skewed_headers(spark, n=6000):
    """A third of the rows on one key, many keys once, some NULL."""
    key = (
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 101 == 0, F.lit(None))
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 1500).cast("string")))
    )
    return spark.range(n).select(
        key.alias("original_filename"),
        F.concat(F.lit("f"), F.col("id").cast("string")).alias("file_path"),
    )


def patients(spark):
    ids = [("hot", 1), ("absent", 1)] + [(f"k{i}", i % 2) for i in range(1000)]
    return spark.createDataFrame(ids, "patient_id string, label int")


@pytest.mark.parametrize("join", [skew.salted_join, skew.hot_split_join])
@pytest.mark.parametrize("rows_per_salt", [1, 100, 1_000_000])
def test_skew_joins_equal_plain_join(spark, join, rows_per_salt):
    left, right = skewed_headers(spark), patients(spark)
    plain = left.join(right, left.original_filename == right.patient_id)
    spread = join(left, right, "original_filename", "patient_id", rows_per_salt)
    assert spread.columns == plain.columns
    assert Counter(map(tuple, spread.collect())) == Counter(map(tuple, plain.collect()))


@pytest.mark.parametrize("join", [skew.salted_join, skew.hot_split_join])
def test_hot_key_without_partner_is_dropped(spark, join):
    left = skewed_headers(spark)
    right = patients(spark).where("patient_id <> 'hot'")
    spread = join(left, right, "original_filename", "patient_id", 100)
    plain = left.join(right, left.original_filename == right.patient_id)
    assert spread.count() == plain.count()


def test_hot_rows_are_not_shuffled(spark):
    """The join task of the shuffled branch sees no hot row."""
    left, right = skewed_headers(spark), patients(spark)
    joined = skew.hot_split_join(left, right, "original_filename", "patient_id", 100)
    tasks = (
        joined.where("patient_id = 'hot'").groupBy(F.spark_partition_id().alias("p")).count()
    ).collect()
    assert len(tasks) == left.rdd.getNumPartitions()
    assert max(r["count"] for r in tasks) <= 2000 / len(tasks) + 1


def test_only_the_hot_key_is_reported(spark):
    hot = skew.hot_keys(skewed_headers(spark), "original_filename", 100)
    assert [tuple(r) for r in hot] == [("hot", 20)]
    assert skew.hot_keys(skewed_headers(spark), "original_filename") == []


def test_sampled_counts_find_a_hot_key(spark):
    """Large enough that only a sample of the keys is counted."""
    df = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k")
    )
    hot = skew.hot_keys(df, "k", 10_000)
    assert [r["hot_key"] for r in hot] == ["hot"]
    assert 5 <= hot[0]["salts"] <= 9


def test_hot_key_is_spread_over_salts(spark):
    left, right = skewed_headers(spark), patients(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = skew.salted_join(left, right, "original_filename", "patient_id", rows_per_salt=100)
        tasks = (
            joined.where("patient_id = 'hot'").groupBy(F.spark_partition_id().alias("p")).count()
        ).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(tasks) == 8
    assert max(r["count"] for r in tasks) < 2000 / 2


def test_gold_is_one_scan_of_the_labels(spark):
    info = spark.range(1000).select(
        (F.col("id") % 100).cast("string").alias("patient_id"), F.lit("Normal").alias("class")
    )
    patients = gold.labelled_patients(info)
    patients.collect()
    plan = patients._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0]
    assert final.count("ReusedExchange") == 2


def test_labels(spark):
    rows = [("a", "Normal"), ("a", "Lung Opacity"), ("b", None), ("c", "No Lung Opacity / Not Normal"),
            (None, "Normal")]
    info = spark.createDataFrame(rows, "patient_id string, class string")
    assert [r["label"] for r in labels.with_binary_label(info).collect()] == [0, 1, 0, 0, 0]
    got = {r["patient_id"]: r["label"] for r in labels.patient_labels(info).collect()}
    assert got == {"a": 1, "b": 0, "c": 0, None: 0}
    assert labels.distinct_count(info, "patient_id").first()["n"] == 4


def test_class_weight(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 617, 1).otherwise(0).alias("label"))
    row = labels.class_weight(df).first()
    assert (row["neg"], row["pos"]) == (2383, 617)
    assert round(row["pos_weight"], 2) == 3.86
    assert labels.class_weight(df.where("label = 0")).first()["pos_weight"] is None


def test_split_counts(spark):
    info = spark.range(200).select(
        F.col("id").cast("string").alias("patient_id"), F.lit("Normal").alias("class")
    )
    patients = gold.labelled_patients(info)
    rows = patients.where("CAST(patient_id AS INT) < 50")
    got = {r["split"]: (r["n_patients"], r["n_rows"]) for r in split.split_counts(patients, rows).collect()}
    assert {k: v[0] for k, v in got.items()} == {"train": 140, "val": 30, "test": 30}
    assert sum(v[1] for v in got.values()) == 50


@pytest.mark.parametrize(
    "train,val,expected",
    [
        (0.8, 0.2, {"train": 80, "val": 20}),
        (1.0, 0.0, {"train": 100}),
        (0.0, 1.0, {"val": 100}),
        (0.0, 0.0, {"test": 100}),
        (0.5, 0.0, {"train": 50, "test": 50}),
    ],
)
def test_split_with_shares_that_end_at_the_last_rank(spark, train, val, expected):
    ids = spark.range(100).select(F.col("id").cast("string").alias("patient_id"))
    rows = split.assign_patient_splits(ids, train_share=train, val_share=val).collect()
    assert Counter(r["split"] for r in rows) == expected


def test_equal_rows_of_a_hot_key_are_kept_and_spread(spark):
    left = spark.range(1000).select(F.lit("hot").alias("original_filename"), F.lit("f").alias("file_path"))
    others = spark.createDataFrame([("k1", "g"), (None, "h")], "original_filename string, file_path string")
    left = left.union(others)
    right = patients(spark)
    joined = skew.salted_join(left, right, "original_filename", "patient_id", rows_per_salt=100)
    plain = left.join(right, left.original_filename == right.patient_id)
    assert Counter(map(tuple, joined.collect())) == Counter(map(tuple, plain.collect()))


def test_a_gold_plan_runs_no_job(spark):
    headers = skewed_headers(spark).selectExpr(
        "*", "'m' modality", "'v' view_position", "'s' patient_sex", "'b' patient_age_bucket",
        "1 rows", "1 columns",
    )
    spark.sparkContext.setJobGroup("gold-plan", "building")
    rows = gold.model_ready_rows(headers, patients(spark).withColumn("split", F.lit("train")))
    assert spark.sparkContext.statusTracker().getJobIdsForGroup("gold-plan") == []
    spark.sparkContext.setJobGroup("", "")
    assert rows.count() > 0
