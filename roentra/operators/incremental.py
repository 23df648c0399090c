"""Summaries kept up to date by deliveries of changes, by the delta rule of a join.

Headers and label rows change by signed rows: ``weight`` 1 adds a row, -1 takes an
equal one away. A patient's state is two sums over label rows, how many there are and how many
are positive, so it adds up in any order. With old and changed headers H, dH and old and changed
patients P, dP, the counts over the join of both change by

    dH x P  +  H x dP  +  dH x dP

where a patient whose label changes is the old one with -1 and the new one with 1. Old
headers are read only for patients that change, old patients only for headers that change.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from roentra import schemas
from roentra.operators.labels import with_binary_label
from roentra.sources.jsonlines import append_json_lines, read_json_lines
from roentra.sources.tables import read_table, write_table

# By which columns the two summaries count.
CASES = ("modality", "view_position", "label")
PEOPLE = ("patient_sex", "patient_age_bucket", "label")
OF_HEADER = ("original_filename", "modality", "view_position", "patient_sex", "patient_age_bucket")
HEADER_LOG = "original_filename string, modality string, view_position string, patient_sex string, patient_age_bucket string, weight long"
PATIENTS = "patient_id string, label_rows long, positive long"
DONE = "version long"


def patient_changes(label_changes: DataFrame) -> DataFrame:
    """(patient_id, label_rows, positive): what signed label rows add to each patient."""
    weight, label = F.col("weight").cast("long"), F.col("label")
    rows = with_binary_label(label_changes).where(F.col("patient_id").isNotNull())
    sums = rows.groupBy("patient_id").agg(
        F.sum(weight).alias("label_rows"), F.sum(weight * label).alias("positive")
    )
    return sums.where("label_rows <> 0 OR positive <> 0")


def _labelled(patients: DataFrame, weight: int) -> DataFrame:
    """(patient_id, label, sign) of the patients that have label rows."""
    label = (F.col("positive") > 0).cast("int").alias("label")
    return patients.where("label_rows > 0").select(
        "patient_id", label, F.lit(weight).cast("long").alias("sign")
    )


def signed_patients(old: DataFrame, changes: DataFrame) -> DataFrame:
    """(patient_id, label, sign): patients that go, come or change their label."""
    touched = old.join(changes.select("patient_id"), "patient_id", "left_semi")
    new = touched.unionByName(changes).groupBy("patient_id").agg(
        F.sum("label_rows").alias("label_rows"), F.sum("positive").alias("positive")
    )
    both = _labelled(touched, -1).unionByName(_labelled(new, 1))
    net = both.groupBy("patient_id", "label").agg(F.sum("sign").alias("sign"))
    return net.where("sign <> 0")


def _counted(headers: DataFrame, patients: DataFrame, by: Sequence[str]) -> DataFrame:
    """Signed counts of the join."""
    joined = headers.join(patients, F.col("original_filename") == F.col("patient_id"))
    return joined.groupBy(*by).agg(F.sum(F.col("weight") * F.col("sign")).alias("case_count"))


def delta(
    old_headers: DataFrame,
    header_changes: DataFrame,
    old_patients: DataFrame,
    changed_patients: DataFrame,
    by: Sequence[str],
) -> DataFrame:
    """By how much the counts change: the three terms of the rule."""
    terms = [
        _counted(header_changes, _labelled(old_patients, 1), by),
        _counted(old_headers, changed_patients, by),
        _counted(header_changes, changed_patients, by),
    ]
    return reduce(DataFrame.unionByName, terms)


def added(counts: DataFrame, change: DataFrame, by: Sequence[str]) -> DataFrame:
    """Counts with a change, groups of none left out."""
    together = counts.unionByName(change).groupBy(*by).agg(F.sum("case_count").alias("case_count"))
    return together.where("case_count <> 0")


class Summaries:
    """The state under one folder: a version for every delivery.

    A version holds the signed headers of its delivery, all patients, and both
    summaries; a log line, written last, makes it valid. A delivery that broke off, or is
    given again, is written again from the version before; readers see whole versions only.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def last(self) -> int:
        """The newest whole version, 0 before the first."""
        done = read_json_lines(self.spark, f"{self.root}/done", self._schema(DONE))
        return done.agg(F.max("version")).first()[0] or 0

    def _schema(self, ddl: str):
        return self.spark.createDataFrame([], ddl).schema

    def _path(self, version: int, table: str) -> str:
        return f"{self.root}/{table}/version={version:06d}"

    def _read(self, version: int, table: str, ddl: str) -> DataFrame:
        if not version:
            return self.spark.createDataFrame([], ddl)
        return read_table(self.spark, self._path(version, table), schema=self._schema(ddl))

    def headers(self, version: int) -> DataFrame:
        """Signed headers of all deliveries up to a version."""
        if not version:
            return self.spark.createDataFrame([], HEADER_LOG)
        log = read_table(self.spark, f"{self.root}/headers", schema=self._schema(f"{HEADER_LOG}, version long"))
        return log.where(F.col("version") <= version).drop("version")

    def case_counts(self, version: int | None = None) -> DataFrame:
        number = self.last() if version is None else version
        return self._read(number, "cases", schemas.CASE_COUNTS.toDDL())

    def demographics(self, version: int | None = None) -> DataFrame:
        number = self.last() if version is None else version
        return self._read(number, "people", schemas.DEMOGRAPHICS.toDDL())

    def deliver(self, version: int, header_changes: DataFrame, label_changes: DataFrame) -> None:
        """Take signed headers and signed label rows as the next version, or as the last one again."""
        last = self.last()
        if version not in (last, last + 1) or version < 1:
            raise ValueError(f"version {version} does not follow version {last}")
        before = version - 1
        weight = F.col("weight").cast("long").alias("weight")
        write_table(header_changes.select(*OF_HEADER, weight), self._path(version, "headers"))
        change = read_table(self.spark, self._path(version, "headers"), schema=self._schema(HEADER_LOG))

        old = self._read(before, "patients", PATIENTS)
        changes = patient_changes(label_changes)
        write_table(changes, self._path(version, "patient_changes"))
        changes = self._read(version, "patient_changes", PATIENTS)
        new = old.unionByName(changes).groupBy("patient_id").agg(
            F.sum("label_rows").alias("label_rows"), F.sum("positive").alias("positive")
        )
        write_table(new.where("label_rows <> 0 OR positive <> 0"), self._path(version, "patients"))
        write_table(signed_patients(old, changes), self._path(version, "signed_patients"))
        signed = self._read(version, "signed_patients", "patient_id string, label int, sign long")

        for table, by, counts in (
            ("cases", CASES, self.case_counts(before)),
            ("people", PEOPLE, self.demographics(before)),
        ):
            moved = delta(self.headers(before), change, old, signed, by)
            write_table(added(counts, moved, by), self._path(version, table))
        if version > last:
            row = self.spark.createDataFrame([(version,)], DONE)
            append_json_lines(row.coalesce(1), f"{self.root}/done")
