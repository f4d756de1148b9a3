"""Operators on streams get packed rows: few for each key, whatever the orders."""

from __future__ import annotations

import pyarrow as pa
import pytest

from orderwatch.plans import catalog
from orderwatch.streaming.late import Lateness
from orderwatch.streaming.live import KEYS, _added_up
from orderwatch.streaming.packed import ROWS, frame, packing, unpack
from orderwatch.streaming.panes import PANE, _added_up as bought, _dealt
from orderwatch.streaming.rolling import OWN, _to_cells

COUNT = 5000


def rows_of(batches):
    return [row for batch in batches for row in batch.to_pylist()]


def test_whole_numbers_beside_nulls_stay_exact():
    table = pa.table({"key": pa.array([2, 1, 2]), "n": pa.array([2**53 + 1, None, None], pa.int64()), "text": ["a", None, "c"]})
    found = rows_of(packing(["key"])(iter(table.to_batches())))
    assert [row["key"] for row in found] == [1, 2]
    whole = frame(unpack(found[1][ROWS]))
    assert pa.Table.from_pandas(whole, preserve_index=False).to_pylist() == [{"n": 2**53 + 1, "text": "a"}, {"n": None, "text": "c"}]


def test_a_window_part_gets_its_addresses_at_once():
    """F2."""
    orders = pa.table(
        {
            "window_start": pa.array([0] * COUNT),
            "window_end": pa.array([10] * COUNT),
            "part": pa.array([i % 2 for i in range(COUNT)], pa.int32()),
            "ip": [f"ip{i // 2}" for i in range(COUNT)],
            "amount": pa.array([1] * COUNT),
        }
    )
    found = rows_of(packing(KEYS, _added_up)(iter(orders.to_batches())))
    assert len(found) == 2
    assert sum(unpack(row[ROWS]).column("n").to_numpy().sum() for row in found) == COUNT


def test_a_cell_gets_its_orders_at_once():
    """F3 and F4."""
    orders = pa.table({"part": pa.array([0] * COUNT, pa.int32()), "ip": [f"ip{i}" for i in range(COUNT)], "at": pa.array(range(COUNT))})
    found = rows_of(_to_cells(COUNT, 2)(iter(orders.to_batches())))
    assert [row["cell"] for row in found] == [0, 1, 2]
    assert unpack(found[0][ROWS]).column("role").to_pylist() == [OWN] * COUNT


def test_late_orders_are_judged_by_window():
    """F7 and F8."""

    class Now:
        def getCurrentWatermarkInMs(self):  # noqa: N802
            return 1

    orders = pa.table({"window_end": pa.array([1000 if i % 2 else 2000 for i in range(COUNT)]), "order_id": pa.array(range(COUNT))})
    packed = [batch.to_pandas() for batch in packing(["window_end"])(iter(orders.to_batches()))]
    assert [len(some) for some in packed] == [2]
    late = list(Lateness(True).handleInputRows((0,), iter(packed), Now()))
    assert len(late) == 1 and late[0]["order_id"].tolist() == list(range(1, COUNT, 2))


def test_a_published_turn_may_have_several_files(spark, sf_dir, monkeypatch):
    """still one batch for each turn."""
    plain = sorted(map(tuple, catalog.shutdown(spark, sf_dir).collect()))
    written = []
    monkeypatch.setattr(catalog, "FILE_ROWS", 600)
    folder = catalog.run_folder
    monkeypatch.setattr(catalog, "run_folder", lambda spark: written.append(folder(spark)) or written[-1])
    assert sorted(map(tuple, catalog.shutdown(spark, sf_dir).collect())) == plain
    sizes = [len(spark.read.parquet(f"{written[0]}/topic/{i}").inputFiles()) for i in range(4)]
    assert len(plain) == 4 and sizes[0] > 1 and len(set(sizes)) == 1


def test_a_part_gets_what_was_bought_at_once():
    """and every part is told of a batch, also one that has nothing in it."""
    orders = pa.table(
        {
            "part": pa.array([1 + i % 2 for i in range(COUNT)], pa.int32()),
            "pane": pa.array([i % 3 for i in range(COUNT)]),
            "ip_address": [f"ip{i % 10}" for i in range(COUNT)],
            "product_name": pa.array([None] * COUNT, pa.string()),
            "spent": pa.array([2] * COUNT),
        }
    )
    found = {row["part"]: unpack(row[ROWS]) for row in rows_of(_dealt(4)(iter(orders.to_batches(max_chunksize=100))))}
    assert {part: rows.num_rows for part, rows in found.items()} == {0: 0, 1: 15, 2: 15, 3: 0}
    assert sum(sum(rows.column("copies").to_pylist()) for rows in found.values()) == COUNT


def test_many_sums_are_handed_on_in_one_piece():
    """Spark takes no column in several pieces."""
    count = 100_000
    sums = bought(pa.table({PANE: range(count), "copies": [1] * count, "spent": [1] * count}), [PANE])
    assert sums.column(PANE).num_chunks > 1
    assert isinstance(pa.Array.from_pandas(frame(sums)[PANE]), pa.Array)


def test_sums_are_exact_or_an_error():
    def table(*spent):
        return pa.table({PANE: [0] * len(spent), "copies": [1] * len(spent), "spent": pa.array(spent, pa.int64())})

    assert bought(table(2**62, 2**62 - 1, None), [PANE]).to_pylist() == [{PANE: 0, "copies": 3, "spent": 2**63 - 1}]
    assert bought(table(None, None), [PANE]).column("spent").to_pylist() == [None]
    with pytest.raises(pa.ArrowInvalid):
        bought(table(2**62, 2**62), [PANE])
