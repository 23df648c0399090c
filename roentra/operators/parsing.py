"""Header parsing of binary files with a quarantine for files that do not parse."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import BinaryIO

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from roentra import schemas
from roentra.sources.ranges import BLOCK, RandomAccess, RangeReader, open_path

FIELDS = schemas.RAW_HEADER.fieldNames()
NUMBERS = {"n_rows", "n_columns"}
PARSED_SCHEMA = "file_path string, " + ", ".join(
    f"{f.name} {f.dataType.simpleString()}" for f in schemas.RAW_HEADER
) + ", error string"


def dicom_header(content: bytes) -> Mapping[str, object]:
    """Header fields of one DICOM file; needs the pydicom package on the executors."""
    import io

    import pydicom

    return _columns(pydicom.dcmread(io.BytesIO(content), stop_before_pixels=True))


def _columns(tags) -> Mapping[str, object]:
    found = {column: tags.get(tag) for column, tag in schemas.HEADER_TAGS.items()}
    return {
        column: value if value is None or column in NUMBERS else str(value)
        for column, value in found.items()
    }


def _converted(name: str, value: object) -> object:
    """The value in the type of its column; a value that has no such form is an error."""
    if value is None:
        return None
    if name not in NUMBERS:
        return str(value)
    try:
        number = int(value)
    except (TypeError, ValueError):
        raise ValueError(f"{name} is not a whole number") from None
    if not -(1 << 31) <= number < 1 << 31:
        raise ValueError(f"{name} is out of range")
    return number


def header_row(content: bytes, parse: Callable[[bytes], Mapping[str, object]]) -> list:
    """Values of ``FIELDS`` and the error text of one file; one of both is all NULL."""
    try:
        header = parse(content)
        return [*(_converted(f, header.get(f)) for f in FIELDS), None]
    except Exception as problem:  # quarantined, see ``error``
        return [*(None for _ in FIELDS), str(problem) or type(problem).__name__]


def parse_headers(
    files: DataFrame, parse: Callable[[bytes], Mapping[str, object]] = dicom_header
) -> DataFrame:
    """Binary files (path, content) -> one row per file: raw header fields, or ``error``.

    A file that does not parse, or has a field of the wrong type, is quarantined.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                [path, *header_row(content, parse)]
                for path, content in zip(batch["path"], batch["content"])
            ]
            frame = pd.DataFrame(rows, columns=["file_path", *FIELDS, "error"], dtype=object)
            yield frame

    return files.select("path", "content").mapInPandas(run, PARSED_SCHEMA)


def dicom_tags(file: BinaryIO) -> Mapping[str, object]:
    """``dicom_header`` of an open file: stops before the pixels, so they are not fetched."""
    import pydicom

    return _columns(pydicom.dcmread(file, stop_before_pixels=True))


def parse_ranges(
    listing: DataFrame,
    parse: Callable[[BinaryIO], Mapping[str, object]] = dicom_tags,
    open_file: Callable[[str], RandomAccess] = open_path,
    block: int = BLOCK,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Listed files (path) -> the rows of ``parse_headers``, ``bytes_read`` and the columns ``keep``.

    The listing carries no content: every file is opened in its task and fetched in blocks
    from the beginning, as far as the parser reads. A file that cannot be opened is
    quarantined like one that does not parse.
    """
    kept = [listing.schema[c] for c in keep]
    kind = f"{PARSED_SCHEMA}, bytes_read long"
    kind += "".join(f", {f.name} {f.dataType.simpleString()}" for f in kept)

    def row(path: str) -> list:
        fetched = 0

        def through_blocks(_: bytes) -> Mapping[str, object]:
            nonlocal fetched
            file = RangeReader(open_file(path), block)
            try:
                return parse(file)
            finally:
                fetched = file.fetched

        return [path, *header_row(b"", through_blocks), fetched]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["file_path", *FIELDS, "error", "bytes_read"]
        for batch in batches:
            frame = pd.DataFrame([row(p) for p in batch["path"]], columns=columns, dtype=object)
            for name in keep:
                frame[name] = batch[name].to_numpy()
            yield frame

    return listing.select("path", *keep).mapInPandas(run, kind)


def parsed_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("error").isNull()).drop("error")


def parse_errors(parsed: DataFrame) -> DataFrame:
    """Files that failed and why."""
    return parsed.where(F.col("error").isNotNull()).select("file_path", "error")


def sample_errors(errors: DataFrame, limit: int = 5) -> DataFrame:
    """A few failed files for a job's log."""
    return errors.orderBy("file_path").limit(limit)
