"""Page snapshots as a stream, merged into the page table batch by batch: a batch rewrites the buckets of its titles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import Settings
from ..operators.merge import latest
from ..plans.crawl import update
from ..sources.pagetable import PageTable

#: Versions that stay for readers that are at work.
KEPT = 3


def merge_batch(snapshots: DataFrame, batch: int, path: str, settings: Settings = Settings()) -> None:
    """Merge one batch into the table; a batch that was merged before is not merged again."""
    table = PageTable(snapshots.sparkSession, path)
    table.merge(latest(snapshots, "title", "revision_id"), lambda old, new: update(old, new, F.current_timestamp(), settings)[0], batch)
    table.remove_old(KEPT)


def start_updates(snapshots: DataFrame, path: str, checkpoint: str, settings: Settings = Settings()) -> StreamingQuery:
    """Run until all that has arrived is merged into the page table at ``path``, which must be there.

    The table knows the last batch that it holds, so a batch that is run again
    after a failure leaves the same table.
    """
    writer = snapshots.writeStream.foreachBatch(lambda rows, batch: merge_batch(rows, batch, path, settings))
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
