"""Streaming entry points.

The original notebooks are batch only (no stream source, watermark or state).
What they do per run -- pick up the newest raw snapshot and upsert it by key --
is offered here as a ``foreachBatch`` adaptor so the same batch functions can
be driven by a file-stream trigger; no stateful streaming operator is added.
"""

from .incremental import upsert_each_batch, upsert_keyed_each_batch

__all__ = ["upsert_each_batch", "upsert_keyed_each_batch"]
