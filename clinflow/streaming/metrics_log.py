"""What streaming queries observe, kept batch by batch without jobs of its own."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

ROW = (
    "query string, batch_id long, name string, n_ok long, n_failed long, n long, sum_ms long, min_ms long, "
    "max_ms long, bins array<long>"
)


class MetricsLog(StreamingQueryListener):
    """U4: observations of all queries of the session, a small file per query, batch and name below
    ``path``. A batch that is repeated after a restart replaces its own. Use it as in
    ``spark.streams.addListener(log)``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def onQueryStarted(self, event) -> None:  # noqa: ANN001, N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: ANN001, N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: ANN001, N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: ANN001, N802
        progress = event.progress
        for name, observed in progress.observedMetrics.items():
            row = {"query": str(progress.id), "batch_id": progress.batchId, "name": name}
            self._put(f"{row['query']}-{row['batch_id']}-{name}", json.dumps(row | observed.asDict(recursive=True)))

    def _put(self, name: str, text: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}.json")
        stream = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(path, True)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()

    def read(self) -> DataFrame:
        """A row per query, batch and name; ``bins`` is null where no latency was asked for."""
        return self.spark.read.schema(ROW).json(self.path)
