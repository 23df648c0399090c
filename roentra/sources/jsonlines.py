"""JSON-lines logs: append, read with broken lines skipped, and pack small files into large ones.

Every append leaves files of its own. ``pack`` copies the lines of small files, as they are,
into files of a given size under ``_packed`` and then writes a manifest, one file whose
appearance is the commit: it names the packed files and the files they stand for. Readers
take the packed files of the newest manifest and the files it does not cover, so a packing that
breaks off changes nothing, and covered files may stay or be removed at any time later.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

BROKEN = "_broken_line"
PACKED = "_packed"
MANIFEST = "number long, kind string, name string"
# Bytes of a packed file; smaller ones are packed again.
TARGET_BYTES = 128 * 1024 * 1024


def append_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("ignoreNullFields", "false").json(path)


def read_json_lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows of all readable lines; an absent path is an empty table."""
    reader = spark.read.schema(schema).option("mode", "DROPMALFORMED").format("json")
    return _load(spark, reader, path, schema)


def broken_lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The text of the lines ``read_json_lines`` skips."""
    text = StructType([StructField("line", StringType(), True)])
    lines = _load(spark, spark.read.schema(text).format("text"), path, text)
    with_text = StructType([*schema.fields, StructField(BROKEN, StringType(), True)])
    parsed = F.from_json("line", with_text, {"columnNameOfCorruptRecord": BROKEN})
    return lines.where(parsed[BROKEN].isNotNull())


def _listed(spark: SparkSession, folder: str) -> dict[str, int]:
    """Sizes of the files directly in a folder, by name."""
    lines = spark.read.format("binaryFile").option("pathGlobFilter", "part-*")
    try:
        found = lines.load(folder).select("path", "length").collect()
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    return {row["path"].rpartition("/")[2]: row["length"] for row in found}


def manifest(spark: SparkSession, path: str) -> tuple[int, set[str], set[str]]:
    """(number, packed files as folder/name, files they stand for) of the newest manifest, 0 without one."""
    try:
        rows = spark.read.schema(MANIFEST).json(f"{path}/{PACKED}/manifest/*").collect()
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0, set(), set()
    last = max((r["number"] for r in rows), default=0)
    names = {kind: {r["name"] for r in rows if (r["number"], r["kind"]) == (last, kind)} for kind in ("packed", "covered")}
    return last, names["packed"], names["covered"]


def _files(spark: SparkSession, path: str) -> list[str]:
    """What a reader reads: the whole folder, or by the newest manifest."""
    number, packed, covered = manifest(spark, path)
    if not number:
        return [path]
    own = sorted(set(_listed(spark, path)) - covered)
    return [f"{path}/{PACKED}/data/{name}" for name in sorted(packed)] + [f"{path}/{name}" for name in own]


def pack(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES) -> dict[str, int]:
    """Pack the small files of a log; returns how many files were packed and into how many.

    Files of the target size or more stay as they are. The driver holds the names of the
    files of the log. One packing of a log runs at a time; appends go on meanwhile.
    """
    number, packed, covered = manifest(spark, path)
    appended = {n: size for n, size in _listed(spark, path).items() if n not in covered}
    folders = {name.partition("/")[0] for name in packed}
    sizes = {
        f"{folder}/{name}": size
        for folder in folders
        for name, size in _listed(spark, f"{path}/{PACKED}/data/{folder}").items()
    }
    small = {n: size for n, size in appended.items() if size < target_bytes}
    again = {n: sizes[n] for n in packed if sizes[n] < target_bytes}
    if len(small) + len(again) < 2:
        return {"packed": 0, "into": 0}
    names = [f"{path}/{n}" for n in small] + [f"{path}/{PACKED}/data/{n}" for n in again]
    total = sum(small.values()) + sum(again.values())
    folder = uuid.uuid4().hex
    bins = max(1, -(-total // target_bytes))
    lines = spark.read.text(names)
    dealt = lines.coalesce(1) if bins == 1 else lines.repartition(bins)
    dealt.write.text(f"{path}/{PACKED}/data/{folder}")
    new = {f"{folder}/{n}" for n in _listed(spark, f"{path}/{PACKED}/data/{folder}")}
    rows = [(number + 1, "packed", n) for n in (packed - set(again)) | new]
    rows += [(number + 1, "covered", n) for n in covered | set(small)]
    commit = spark.createDataFrame(rows, MANIFEST).coalesce(1)
    commit.write.json(f"{path}/{PACKED}/manifest/{number + 1:06d}-{folder}")
    return {"packed": len(names), "into": len(new)}


def remove_covered(spark: SparkSession, path: str) -> int:
    """Delete the files that packed ones stand for; how many there were. For when no reader still
    reads by an older manifest."""
    _, _, covered = manifest(spark, path)
    place = spark._jvm.org.apache.hadoop.fs.Path
    store = place(path).getFileSystem(spark._jsc.hadoopConfiguration())
    return sum(store.delete(place(f"{path}/{name}"), False) for name in sorted(covered))


def _load(
    spark: SparkSession, reader: DataFrameReader, path: str, schema: StructType
) -> DataFrame:
    try:
        return reader.load(_files(spark, path))
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
