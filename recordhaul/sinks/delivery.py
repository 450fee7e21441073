"""Delivery to a sink outside of Spark, which takes rows in calls and may refuse some of them.

Each task sends what it has read and tries a failed call again by itself, so one bad call costs its own rows and
not the batch. What is given up comes back as rows, which stay where they are: they reach neither the
driver nor another task. An error in computing the rows is not the sink's; it fails the task.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Takes rows; gives for each None or why it is refused for good. Whatever it raises fails the call.
Sender = Callable[[list[dict]], list[str | None]]

# Rows of a call, its tries, and the pause between them.
CALL_ROWS = 500
ATTEMPTS = 3
PAUSE_SECONDS = 2.0


def send_rows(
    rows: list[dict], send: Sender, attempts: int, pause: float, sleep: Callable[[float], None] = time.sleep
) -> tuple[list[str | None], int]:
    """Why each row is refused, or None; and the tries it took. No pause follows the last one."""
    for attempt in range(1, attempts + 1):
        try:
            refused = send(rows)
        except Exception:  # noqa: BLE001 - whatever the sink raises is tried again
            if attempt < attempts:
                sleep(pause)
            continue
        if len(refused) != len(rows):
            raise ValueError("the sink has to answer for every row")
        return refused, attempt
    return ["write_failed"] * len(rows), attempts


def deliver(
    rows: DataFrame,
    make_sender: Callable[[], Sender],
    call_rows: int = CALL_ROWS,
    attempts: int = ATTEMPTS,
    pause: float = PAUSE_SECONDS,
) -> DataFrame:
    """Send all rows; the rejected ones with ``reason`` and ``attempts``, and a row for each call.

    The row of a call has ``delivered``, how many it took, and nothing else. Sending happens when the result
    is computed, and again where a task is run again: what is sent should be told apart by a key. The
    sender is made once a task.
    """
    if min(call_rows, attempts) < 1:
        raise ValueError("calls and attempts must be at least 1")
    schema = T.StructType([
        *(T.StructField(f.name, f.dataType) for f in rows.schema),
        T.StructField("reason", T.StringType()),
        T.StructField("attempts", T.IntegerType()),
        T.StructField("delivered", T.LongType()),
    ])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        send = None
        for batch in batches:
            for begin in range(0, batch.num_rows, call_rows):
                part = pa.Table.from_batches([batch.slice(begin, call_rows)])
                send = send or make_sender()
                refused, tries = send_rows(part.to_pylist(), send, attempts, pause)
                reasons = pa.array(refused, pa.string())
                kept = part.filter(reasons.is_valid())
                none = pa.nulls(1, pa.string())
                count = kept.num_rows
                columns = [pa.concat_arrays([*c.chunks, pa.nulls(1, c.type)]) for c in kept.columns]
                columns += [
                    pa.concat_arrays([reasons.drop_null(), none]),
                    pa.concat_arrays([pa.array([tries] * count, pa.int32()), pa.nulls(1, pa.int32())]),
                    pa.concat_arrays([pa.nulls(count, pa.int64()), pa.array([part.num_rows - count])]),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(make, schema)
