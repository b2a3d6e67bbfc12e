"""Progress documents: one JSON file that says how a task or a streaming query stands, replaced whole each time."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener


def write_document(spark: SparkSession, path: str, **fields) -> dict:
    """Write the fields with ``updated_at`` (UTC) to ``path`` on any store; readers see the old document or the new one."""
    document = {**fields, "updated_at": datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")}
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    where, partial = hadoop.Path(path), hadoop.Path(f"{path}.partial")
    files = hadoop.FileContext.getFileContext(where.toUri(), conf)
    store = where.getFileSystem(conf)
    out = store.create(partial, True)
    try:
        out.write(bytearray(json.dumps(document, sort_keys=True).encode()))
    finally:
        out.close()
    over = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    over[0] = hadoop.Options.Rename.OVERWRITE
    files.rename(store.makeQualified(partial), store.makeQualified(where), over)
    return document


class ProgressDocuments(StreamingQueryListener):
    """Keeps the document of every query of a session at ``folder``/<query id>.json: running, idle, ended or failed."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _write(self, query: object, **fields) -> None:
        write_document(self.spark, f"{self.folder}/{query}.json", query_id=str(query), **fields)

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self._write(event.id, status="running", batch=None, rows=0)

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        self._write(p.id, status="running", batch=p.batchId, rows=p.numInputRows, rows_per_second=p.processedRowsPerSecond)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        self._write(event.id, status="idle")

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._write(event.id, status="failed" if event.exception else "ended", error=event.exception)
