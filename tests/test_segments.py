from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException

from orderflow.sources.segments import EARLIEST, LATEST, SegmentReader, read_segments
from orderflow.streaming.runs import drain


@pytest.fixture
def archive(spark, folder):
    class Archive:
        path, sizes = Path(folder, "segments"), []

        def add(self, name, *numbers):
            self.path.mkdir(exist_ok=True)
            lines = [json.dumps({"sequence_number": str(n), "data": f"d{n}"}) for n in numbers]
            (self.path / name).write_text("\n".join(lines) + "\n")

        def run(self, start=LATEST, max_records=100, fail_at=None):
            """Numbers by batch."""
            self.sizes = []

            def put(batch, batch_id):
                found = [int(r["sequence_number"]) for r in batch.collect()]
                if fail_at is not None and len(self.sizes) == fail_at:
                    raise OSError("sink is gone")
                if found:
                    self.sizes.append(len(found))
                    Path(folder, f"out-{batch_id}").write_text(json.dumps(found))

            stream = read_segments(spark, str(self.path), max_records, start)
            drain(stream.writeStream.foreachBatch(put), f"{folder}/check")

        def read(self):
            found = sorted(Path(folder).glob("out-*"), key=lambda p: int(p.name[4:]))
            return [n for p in found for n in json.loads(p.read_text())]

    return Archive()


def test_a_batch_has_a_hundred_records_at_most(archive):
    archive.add("00000", *range(250))
    archive.add("00001", *range(250, 280))
    archive.run(EARLIEST)
    assert archive.sizes == [100, 100, 80] and archive.read() == list(range(280))


def test_a_stream_starts_behind_what_is_there(archive):
    archive.add("00000", *range(50))
    archive.add("00001", *range(50, 70))
    archive.run()
    assert archive.read() == []
    archive.add("00002", *range(70, 90))
    archive.add("00003", *range(90, 210))
    archive.run()
    assert archive.sizes == [100, 40] and archive.read() == list(range(70, 210))
    # An old checkpoint goes on where it was, whatever start says.
    archive.add("00004", 210)
    archive.run(EARLIEST)
    assert archive.read() == list(range(70, 211))


def test_a_stream_may_start_before_the_first_segment(archive):
    archive.run()
    archive.add("00000", 1, 2)
    archive.run()
    assert archive.read() == [1, 2]


def test_a_batch_that_failed_is_read_again(archive):
    archive.add("00000", *range(7))
    archive.add("00001", *range(7, 25))
    with pytest.raises(StreamingQueryException, match="sink is gone"):
        archive.run(EARLIEST, 10, fail_at=1)
    archive.add("00002", 25)
    archive.run(EARLIEST, 10)
    assert archive.read() == list(range(26)) and max(archive.sizes) <= 10


def test_a_late_segment_is_not_passed_over(archive):
    archive.add("00005", 1)
    archive.run(EARLIEST)
    archive.add("00004", 2)
    archive.add("00006", 3)
    with pytest.raises(StreamingQueryException, match="came late"):
        archive.run()


def test_odd_lines_are_kept_for_the_rejects(folder):
    Path(folder, "00000").write_text('\n{bad\n[1]\n{"sequence_number": "3"}\n\n{"data": "é"}')
    reader = SegmentReader(folder, 100, EARLIEST)
    found, end = reader.read(reader.initialOffset())
    wanted = [(None, "{bad"), (None, "[1]"), ("3", None), (None, "é")]
    assert list(found) == wanted and end == {"segment": "00000", "records": 4, "before": 0}
    assert list(reader.readBetweenOffsets(reader.initialOffset(), end)) == wanted


@pytest.mark.parametrize(("bound", "start"), [(0, LATEST), (5, "middle")])
def test_options_are_checked(folder, bound, start):
    with pytest.raises(ValueError, match="max_records"):
        SegmentReader(folder, bound, start)


def test_long_records(folder):
    text = "x" * 300_000
    Path(folder, "00000").write_text(json.dumps({"sequence_number": "1", "data": text}) + "\n")
    reader = SegmentReader(f"file://{folder}", 1, EARLIEST)
    assert list(reader.read(reader.initialOffset())[0]) == [("1", text)]


def test_schema(spark, archive):
    archive.add("00000", 1)
    assert read_segments(spark, str(archive.path)).columns == ["sequence_number", "data"]
