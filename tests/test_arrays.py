"""JSON arrays of bounded size, and what a task holds for one."""

from __future__ import annotations

import json
import tracemalloc

import pyarrow as pa
import pytest

from opinionlake.sources.tables import write_json_arrays


def _batches(rows):
    return (pa.RecordBatch.from_arrays([pa.array(rows[i:i + 7], pa.string())], names=["value"]) for i in range(0, len(rows), 7))


@pytest.fixture
def packer(spark, tmp_path, monkeypatch):
    """The function that the tasks run."""
    seen = []
    frame = spark.range(1)
    keep = type(frame).mapInArrow

    def spy(self, func, *args, **kwargs):
        seen.append(func)
        return keep(self, func, *args, **kwargs)

    monkeypatch.setattr(type(frame), "mapInArrow", spy)
    write_json_arrays(frame, str(tmp_path / "arrays"))
    return seen[0]


def test_arrays_hold_all_rows_in_order(packer):
    rows = [json.dumps({"n": n, "t": "é😀" * (n % 5)}, ensure_ascii=False) for n in range(25_000)]
    arrays = [batch.column(0)[0].as_py() for batch in packer(_batches(rows))]
    assert [len(json.loads(a)) for a in arrays] == [10_000, 10_000, 5_000]
    assert [r for a in arrays for r in json.loads(a)] == [json.loads(r) for r in rows]
    assert list(packer(iter(()))) == []


def test_an_array_is_held_once(packer):
    # one wide character makes a Python string of the whole array four bytes a letter
    rows = ['{"t":"' + "a" * 20_000 + '"}'] * 700 + ['{"t":"😀"}']
    batches = list(_batches(rows))
    tracemalloc.start()
    sizes = [len(batch.column(0)[0].as_buffer()) for batch in packer(batches)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(sizes) > 14_000_000 and peak < 2 * sum(sizes)
