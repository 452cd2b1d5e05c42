"""Run the keyed upsert for every micro-batch of a stream (``foreachBatch``)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..operators.tables import dedup_latest, upsert
from ..sources.keyed import upsert_keyed


def upsert_each_batch(read_target: Callable[[], DataFrame], write_target: Callable[[DataFrame], None],
                      keys, order) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: dedup the batch by key (latest by ``order``),
    upsert it into the current target, and hand the result to ``write_target``
    (which must write to a new location and switch the table, see
    ``sources.sinks.replace_table``). Batches replayed after a failure give the
    same table, since the upsert of a batch is idempotent for non-NULL keys."""

    def _run(batch: DataFrame, batch_id: int) -> None:
        src = dedup_latest(batch, keys, order, keep_null_keys=True)
        write_target(upsert(read_target(), src, keys))

    return _run


def upsert_keyed_each_batch(path: str, keys, order, *, stream: str, buckets: int = 256) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that upserts each batch into the table kept by key bucket at
    ``path`` (``sources.upsert_keyed``): only the buckets that the batch touches are read and
    written, and they are published in one step. The version says which batch of ``stream`` is in
    it, so a batch replayed after a failure changes nothing, rows without a key included."""

    def _run(batch: DataFrame, batch_id: int) -> None:
        upsert_keyed(dedup_latest(batch, keys, order, keep_null_keys=True), path, keys, buckets=buckets, stream=(stream, batch_id))

    return _run
