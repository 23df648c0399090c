import random

import pytest
from pyspark.sql import functions as F

from roentra.operators import check_state, gold, incremental, quality
from roentra.plans import jobs

HEADER = "original_filename string, modality string, view_position string, patient_sex string, patient_age_bucket string, weight long"
LABEL = "patient_id string, class string, weight long"


def rebuilt(spark, headers, labels):
    """Both summaries from the rows that are left."""
    patients = {}
    for i, c in labels:
        if i is not None:
            patients[i] = max(patients.get(i, 0), int(c == "Lung Opacity"))
    cases, people = {}, {}
    for name, modality, view, sex, age in headers:
        if name in patients:
            for table, key in ((cases, (modality, view)), (people, (sex, age))):
                key = (*key, patients[name])
                table[key] = table.get(key, 0) + 1
    return cases, people


def as_dict(df, by):
    return {tuple(r[c] for c in by): r["case_count"] for r in df.collect()}


@pytest.mark.parametrize("seed", range(3))
def test_deliveries_equal_a_rebuild(spark, tmp_path, seed):
    rng = random.Random(seed)
    state = incremental.Summaries(spark, str(tmp_path / "state"))
    assert state.case_counts().collect() == []
    headers, labels = [], []

    def some(pool, make, n):
        """Signed changes, and the rows that are left."""
        gone = [pool.pop(rng.randrange(len(pool))) for _ in range(min(len(pool), n // 3))]
        new = [make() for _ in range(n)]
        pool.extend(new)
        return [(*r, 1) for r in new] + [(*r, -1) for r in gone]

    def header():
        name = rng.choice([None, "hot", "hot", *[f"p{i}" for i in range(12)]])
        return (name, rng.choice(["CR", "DX", None]), rng.choice(["PA", None]), rng.choice("MF"), "20-29")

    def label():
        name = rng.choice([None, "hot", *[f"p{i}" for i in range(15)]])
        return (name, rng.choice(["Normal", "Lung Opacity", None]))

    for version in range(1, 5):
        dh = some(headers, header, rng.choice([0, 30]))
        dl = some(labels, label, rng.choice([0, 12]))
        changes = spark.createDataFrame(dh, HEADER), spark.createDataFrame(dl, LABEL)
        state.deliver(version, *changes)
        if version == 2:
            state.deliver(version, *changes)  # given again
        cases, people = rebuilt(spark, headers, labels)
        assert as_dict(state.case_counts(), incremental.CASES) == cases
        assert as_dict(state.demographics(), incremental.PEOPLE) == people
    assert state.last() == 4
    with pytest.raises(ValueError, match="does not follow"):
        state.deliver(6, *changes)


def test_a_delivery_that_broke_off_is_not_seen(spark, tmp_path, monkeypatch):
    state = incremental.Summaries(spark, str(tmp_path / "state"))
    one = spark.createDataFrame([("a", "CR", "PA", "M", "20-29", 1)], HEADER)
    label = spark.createDataFrame([("a", "Normal", 1)], LABEL)
    state.deliver(1, one, label)
    corrected = spark.createDataFrame([("a", "Normal", -1), ("a", "Lung Opacity", 1)], LABEL)

    def stop(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(incremental, "append_json_lines", stop)
        with pytest.raises(RuntimeError):
            state.deliver(2, one, corrected)
    assert as_dict(state.case_counts(), incremental.CASES) == {("CR", "PA", 0): 1}
    state.deliver(2, one, corrected)
    assert as_dict(state.case_counts(), incremental.CASES) == {("CR", "PA", 1): 2}


def test_old_headers_are_not_read_without_changed_patients(spark, tmp_path):
    """Terms whose change is empty contribute nothing, and labels that stay change nothing."""
    old = spark.createDataFrame([("a", 2, 1), ("b", 1, 0)], incremental.PATIENTS)
    more = spark.createDataFrame([("a", 1, 1), ("b", 3, 0)], incremental.PATIENTS)
    assert incremental.signed_patients(old, more).collect() == []
    other = spark.createDataFrame([("a", -2, -1), ("b", 0, 1), ("c", 1, 1)], incremental.PATIENTS)
    found = {tuple(r) for r in incremental.signed_patients(old, other).collect()}
    assert found == {("a", 1, -1), ("b", 0, -1), ("b", 1, 1), ("c", 1, 1)}


def random_frames(spark, n, seed):
    rng = random.Random(seed)
    fields = "patient_id_hash original_filename modality view_position patient_sex rows columns patient_age_bucket".split()
    pick = lambda *v: rng.choice([None, *v])
    headers = [
        (pick("h"), pick(*[f"p{rng.randrange(n)}"] * 5), pick("CR"), pick("PA"), pick("M"), pick(1), pick(2),
         rng.choice(["20-29", "130-139", "UNKNOWN", None]))
        for _ in range(n)
    ]
    kinds = "string string string string string int int string".split()
    schema = ", ".join(f"{f} {k}" for f, k in zip(fields, kinds))
    info = [(pick(*[f"p{rng.randrange(n)}"] * 5), "Normal") for _ in range(n)]
    digests = [(f"f{i}", pick(*[f"c{rng.randrange(n)}"] * 9)) for i in range(n)]
    return (
        spark.createDataFrame(headers, schema),
        spark.createDataFrame(info, "patient_id string, class string"),
        spark.createDataFrame(digests, "file_name string, content_hash string"),
    )


def by_check(df):
    return {(r["check_name"], r["field"]): r for r in df.collect()}


def test_merged_checks_equal_the_suite(spark, tmp_path):
    layout = jobs.Layout(str(tmp_path / "lake"))
    parts = [random_frames(spark, n, n) for n in (40, 0, 90)]
    for i, frames in enumerate(parts):
        results = jobs.check_delivery(spark, layout, f"d{i}", *frames)
    jobs.check_delivery(spark, layout, "d0", *parts[0])  # given again
    results = layout.read(spark, jobs.DQ_RESULTS)
    whole = [a.unionByName(b).unionByName(c) for a, b, c in zip(*parts)]
    expected = quality.suite(*whole)
    assert results.columns == expected.columns
    assert {k: tuple(r) for k, r in by_check(results).items()} == {
        k: tuple(r) for k, r in by_check(expected).items()
    }


def test_distinct_counts_are_within_the_bound(spark, monkeypatch):
    """A small sketch, far more values than it holds."""
    monkeypatch.setattr(check_state, "LOG_SIZE", 8)
    n = 30_000
    headers = spark.range(n).selectExpr(
        "'h' patient_id_hash", "concat('p', id) original_filename", "'CR' modality", "'PA' view_position",
        "'M' patient_sex", "1 rows", "1 columns", "'20-29' patient_age_bucket",
    )
    info = spark.range(n // 2, n + n // 2).selectExpr("concat('p', id) patient_id", "'Normal' class")
    digests = spark.range(n).selectExpr("concat('f', id) file_name", "concat('c', id % 20000) content_hash")
    states = [
        check_state.delivery_state(*(df.where(f"pmod(xxhash64({key}), 3) = {i}") for df, key in (
            (headers, "original_filename"), (info, "patient_id"), (digests, "file_name"))))
        for i in range(3)
    ]
    found = by_check(check_state.merged_results(states[0].unionByName(states[1]).unionByName(states[2])))
    exact = by_check(quality.suite(headers, info, digests))
    assert check_state.error_bound(n) < n * 0.27 and check_state.error_bound(100) == 0
    off = 0
    for key, row in exact.items():
        for column in ("failing_rows", "total_rows"):
            apart = abs(found[key][column] - row[column])
            assert apart <= (check_state.error_bound(n + n // 2) if key[0] in ("referential_integrity", "duplicate_detection") else 0)
            off += apart
    assert off > 0
