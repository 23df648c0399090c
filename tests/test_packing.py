from pathlib import Path

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from roentra.sources import jsonlines

SCHEMA = StructType([StructField("id", LongType()), StructField("note", StringType())])


def append(path, start, n):
    """Appends as an appending job leaves them: a file each."""
    Path(path).mkdir(exist_ok=True)
    for i in range(start, start + n):
        line = '{"id":%d,"note":"n%d"}\n' % (i, i)
        Path(path, f"part-00000-{i:08d}-c000.json").write_text(line + ('{"id": cut\n' if i % 100 == 0 else ""))


def ids(spark, path):
    return sorted(r["id"] for r in jsonlines.read_json_lines(spark, path, SCHEMA).collect())


def test_a_thousand_appends_become_one_file(spark, tmp_path):
    path = str(tmp_path / "log")
    assert jsonlines.pack(spark, path) == {"packed": 0, "into": 0}
    append(path, 0, 1000)
    assert jsonlines.pack(spark, path) == {"packed": 1000, "into": 1}
    assert ids(spark, path) == list(range(1000))
    assert jsonlines.broken_lines(spark, path, SCHEMA).count() == 10
    # What comes later is read beside it, and packed in turn.
    append(path, 1000, 30)
    jsonlines.append_json_lines(spark.createDataFrame([(1030, None)], SCHEMA).coalesce(1), path)
    assert ids(spark, path) == list(range(1031))
    assert jsonlines.remove_covered(spark, path) == 1000
    assert ids(spark, path) == list(range(1031))
    assert jsonlines.pack(spark, path) == {"packed": 32, "into": 1}
    assert ids(spark, path) == list(range(1031))
    assert jsonlines.remove_covered(spark, path) == 31
    assert list(Path(path).glob("part-*")) == [] and ids(spark, path) == list(range(1031))
    assert jsonlines.pack(spark, path) == {"packed": 0, "into": 0}


def test_files_have_about_the_target_size(spark, tmp_path):
    path = str(tmp_path / "log")
    append(path, 0, 200)
    total = sum(f.stat().st_size for f in Path(path).glob("part-*"))
    assert jsonlines.pack(spark, path, total // 3) == {"packed": 200, "into": 4}
    assert ids(spark, path) == list(range(200))
    append(path, 200, 5)
    jsonlines.pack(spark, path, total // 3)
    assert ids(spark, path) == list(range(205))


@pytest.mark.parametrize("breaks_at", ["data", "manifest"])
def test_a_packing_that_breaks_off_changes_nothing(spark, tmp_path, monkeypatch, breaks_at):
    path = str(tmp_path / "log")
    append(path, 0, 20)
    jsonlines.pack(spark, path)
    append(path, 20, 20)

    def lost(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        if breaks_at == "data":
            patch.setattr(jsonlines.uuid, "uuid4", lost)
        else:  # the packed file is written, its manifest is not
            patch.setattr(type(spark), "createDataFrame", lost)
        with pytest.raises(RuntimeError, match="lost"):
            jsonlines.pack(spark, path)
    assert ids(spark, path) == list(range(40))
    # A manifest that is still being written has no file yet.
    (tmp_path / "log" / "_packed" / "manifest" / "000002-x" / "_temporary").mkdir(parents=True)
    assert ids(spark, path) == list(range(40))
    assert jsonlines.pack(spark, path)["into"] == 1
    assert ids(spark, path) == list(range(40))
