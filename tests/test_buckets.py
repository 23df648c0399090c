from pathlib import Path

import pytest

from roentra.operators import gold
from roentra.operators.skew import hot_keys
from roentra.sources import buckets


@pytest.fixture
def sides(spark, tmp_path):
    images = spark.range(500).selectExpr("cast(id as string) image_id", "array(id, id) pixels")
    path = str(tmp_path / "images")
    buckets.write_bucketed(images, path, "image_id", 6)
    ready = spark.range(300).selectExpr(
        "cast(id * 2 as string) original_filename", "1 label", "'train' split", "cast(id as string) file_path"
    )
    hot = spark.range(50).selectExpr("'7' original_filename", "0 label", "'val' split", "concat('h', id) file_path")
    return images, path, ready.unionByName(hot)


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, -1)
    yield
    spark.conf.set(key, before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def side_of_pixels(df):
    """The lines of the plan below the join that lead to the scan of the pixels."""
    lines = plan(df).split("\n")
    at = next(i for i, line in enumerate(lines) if "pixels" in line and "Scan parquet" in line)
    depth = len(lines[at])
    above = []
    for line in reversed(lines[:at]):
        indent = len(line) - len(line.lstrip(" :+-*()0123456789"))
        if indent < depth:
            depth = indent
            above.append(line)
        if "Join" in line:
            break
    return above


def test_pixels_are_joined_without_an_exchange(spark, sides, no_broadcast):
    images, path, ready = sides
    stored = buckets.read_bucketed(spark, path)
    in_place = gold.training_examples(ready, stored, hot=[])
    assert "Exchange" not in "\n".join(side_of_pixels(in_place))
    assert "Bucketed: true" in plan(in_place) and plan(in_place).count("Exchange") == 1
    shuffled = gold.training_examples(ready, images, hot=[])
    assert plan(shuffled).count("Exchange") == 2
    assert sorted(map(str, in_place.collect())) == sorted(map(str, shuffled.collect()))
    assert len(list(Path(path).glob("part-*.parquet"))) == 6


def test_hot_names_are_salted_beside_it(spark, sides, no_broadcast):
    images, path, ready = sides
    stored = buckets.read_bucketed(spark, path)
    hot = hot_keys(ready, "original_filename", 20)
    assert [r["hot_key"] for r in hot] == ["7"]
    found = gold.training_examples(ready, stored, hot=hot)
    expected = gold.training_examples(ready, images, hot=[])
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


def test_another_session_registers_the_table_again(spark, sides):
    images, path, _ = sides
    other = spark.newSession()
    other.sql(f"DROP TABLE IF EXISTS {buckets._table_name(path)}")
    stored = buckets.read_bucketed(other, path)
    assert "Bucketed: true" in plan(stored.groupBy("image_id").count())
    assert "Exchange" not in plan(stored.groupBy("image_id").count())
    assert sorted(map(str, stored.collect())) == sorted(map(str, images.collect()))


def test_a_table_is_replaced_with_other_buckets(spark, sides):
    _, path, _ = sides
    fewer = spark.range(5).selectExpr("cast(id as string) image_id", "array(id) pixels")
    buckets.write_bucketed(fewer, path, "image_id", 2)
    assert buckets.read_bucketed(spark, path).count() == 5
