"""A stream of records in numbered segments, read in batches of so many records.

Segments are files of JSON lines that are complete when they appear and whose names ascend,
as those of a stream's archive.  Spark's own file source bounds a batch by files and always
begins with the first; this one bounds it by records, and may begin behind those there are.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from orderflow.constants import MICRO_BATCH_RECORDS
from orderflow.schema import ENVELOPE

FORMAT = "order_segments"
LATEST, EARLIEST = "latest", "earliest"


class SegmentSource(DataSource):
    """Options: ``path``, ``max_records`` and ``start`` (``latest`` or ``earliest``)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "sequence_number string, data string"

    def simpleStreamReader(self, schema) -> SegmentReader:  # noqa: ANN001, N802
        return SegmentReader(
            self.options["path"],
            int(self.options.get("max_records", MICRO_BATCH_RECORDS)),
            self.options.get("start", LATEST),
        )


class SegmentReader(SimpleDataSourceStreamReader):
    """An offset is a segment, the records read of it, and how many segments came before.

    The records of a batch pass through the driver, which their bound makes fit.
    """

    def __init__(self, path: str, max_records: int, start: str):
        if max_records < 1 or start not in (LATEST, EARLIEST):
            raise ValueError(f"max_records {max_records}, start {start!r}")
        self.path, self.max_records, self.start = path, max_records, start

    def _open(self):  # noqa: ANN202
        from pyarrow import fs

        if "://" in self.path or self.path.startswith("file:"):
            return fs.FileSystem.from_uri(self.path)
        return fs.LocalFileSystem(), self.path

    def _segments(self) -> list[str]:
        from pyarrow import fs

        files, folder = self._open()
        found = files.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        names = [info.base_name for info in found if info.type == fs.FileType.File]
        return sorted(name for name in names if not name.startswith((".", "_")))

    def _lines(self, name: str) -> Iterator[str]:
        files, folder = self._open()
        with files.open_input_stream(f"{folder}/{name}") as stream:
            rest = b""
            while block := stream.read(1 << 16):
                *lines, rest = (rest + block).split(b"\n")
                yield from (line.decode() for line in lines if line.strip())
            if rest.strip():
                yield rest.decode()

    def initialOffset(self) -> dict:  # noqa: N802
        names = self._segments()
        if self.start == EARLIEST or not names:
            return {"segment": "", "records": 0, "before": 0}
        records = sum(1 for _ in self._lines(names[-1]))
        return {"segment": names[-1], "records": records, "before": len(names) - 1}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        names = self._segments()
        before = sum(name < start["segment"] for name in names)
        if before != start["before"]:
            raise ValueError(f"segments before {start['segment']!r} came late, or went")
        rows: list[tuple] = []
        end = start
        for k, name in enumerate(names[before:], before):
            done = start["records"] if name == start["segment"] else 0
            for number, line in enumerate(self._lines(name)):
                if number < done:
                    continue
                if len(rows) == self.max_records:
                    return iter(rows), end
                rows.append(_record(line))
                end = {"segment": name, "records": number + 1, "before": k}
        return iter(rows), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:  # noqa: N802
        """The same records again, after a failure."""
        for name in self._segments():
            if not start["segment"] <= name <= end["segment"]:
                continue
            low = start["records"] if name == start["segment"] else 0
            for number, line in enumerate(self._lines(name)):
                if number >= low and (name < end["segment"] or number < end["records"]):
                    yield _record(line)

    def commit(self, end: dict) -> None:
        """Nothing to do: segments are not ours to delete."""


def _record(line: str) -> tuple:
    """A line that is no JSON object is a record without a number, to be rejected later."""
    try:
        record = json.loads(line)
        return record.get("sequence_number"), record.get("data")
    except (ValueError, AttributeError):
        return None, line


def read_segments(
    spark: SparkSession,
    path: str,
    max_records: int = MICRO_BATCH_RECORDS,
    start: str = LATEST,
) -> DataFrame:
    """Envelopes of a folder of segments, ``max_records`` a batch at most.

    ``start`` holds for a new checkpoint; an old one goes on where it was.  ``latest`` begins
    behind what is there.  A segment whose name is below one already read stops the query.
    The path must be one that Python can open.
    """
    spark.dataSource.register(SegmentSource)
    reader = spark.readStream.format(FORMAT).schema(ENVELOPE)
    return reader.option("max_records", max_records).option("start", start).load(path)
