"""Incremental loading driven by arriving files: each batch of new cart files becomes one run.

The file source remembers which files it has seen, so a run reads new files only. A batch that is
replayed after a failure does no harm, because loading the same carts twice changes nothing.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from starmart.plans import job
from starmart.sources import records


def load_arrivals(spark: SparkSession, settings: job.Settings, snapshots: dict[str, str], carts_dir: str,
                  checkpoint: str, today: date | None = None) -> StreamingQuery:
    """Loads all cart files that have arrived since the last call; products and users are read in full."""
    arrivals = records.text_lines(spark.readStream.format("text").load(carts_dir))

    def load(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        sources = {entity: records.read_json_lines(session, path) for entity, path in snapshots.items()}
        # arrival decides what is new here, not the watermark
        job.run(session, settings, sources | {"carts": records.number_lines(batch)}, full_refresh=True, today=today)

    return (
        arrivals.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
