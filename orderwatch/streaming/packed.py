"""Many rows in one, as bytes of an Arrow table: on their way to a stateful operator, and in its state.

Handing a row to Python costs far more than what is done with it there, so an operator gets a few packed rows for each key
and works on whole columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa

#: Rows a task holds before it hands them on.
HELD = 200_000
#: The column of packed rows.
ROWS = "rows"


def pack(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def unpack(data: bytes) -> pa.Table:
    with pa.ipc.open_stream(data) as reader:
        return reader.read_all()


def unpack_all(packed: Iterable[bytes]) -> pa.Table:
    return pa.concat_tables([unpack(data) for data in packed])


def frame(table: pa.Table) -> pd.DataFrame:
    """For handing on. Columns stay Arrow's, so that whole numbers beside nulls stay exact; instants are pandas'. Each is
    in one piece, as Spark wants it: sums of more than 32,768 keys come in several."""
    return table.combine_chunks().to_pandas(types_mapper=lambda kind: None if pa.types.is_timestamp(kind) else pd.ArrowDtype(kind))


def chunked(batches: Iterable[pa.RecordBatch], held: int = HELD) -> Iterator[pa.Table]:
    """The rows of a task, about `held` at a time."""
    some, size = [], 0
    for batch in batches:
        some.append(pa.Table.from_batches([batch]))
        size += batch.num_rows
        if size > held:
            yield pa.concat_tables(some)
            some, size = [], 0
    if size:
        yield pa.concat_tables(some)


def by_key(table: pa.Table, keys: list[str]) -> Iterator[pa.RecordBatch]:
    """A row for each key: the key, which is of whole numbers and never null, and its rows without it, packed."""
    if not table.num_rows:
        return
    order = np.lexsort([table.column(key).to_numpy() for key in keys])
    table = table.take(pa.array(order)).combine_chunks()
    changed = np.zeros(table.num_rows, bool)
    changed[0] = True
    for key in keys:
        values = table.column(key).to_numpy()
        changed[1:] |= values[1:] != values[:-1]
    starts = np.flatnonzero(changed)
    ends, rest = [*starts[1:].tolist(), table.num_rows], table.drop_columns(keys)
    packed = [pack(rest.slice(start, end - start)) for start, end in zip(starts.tolist(), ends, strict=True)]
    columns = [table.column(key).take(pa.array(starts)).combine_chunks() for key in keys]
    yield pa.RecordBatch.from_arrays([*columns, pa.array(packed, pa.binary())], names=[*keys, ROWS])


def packing(
    keys: list[str], change: Callable[[pa.Table], pa.Table] = lambda table: table
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For `mapInArrow`: packs what `change` makes of the rows of a task by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunked(batches):
            yield from by_key(change(table), keys)

    return run
