"""Incremental ingest: newly landed documents are upserted once."""

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelog.operators.ingest import document_runs, file_instant, file_origin, flatten_places
from tidelog.schemas import RAW_DOCUMENT
from tidelog.sources.log import LAYOUT, append_batch


def stream_documents(
    spark: SparkSession, path: str, files_per_batch: int = 1000, multi_line: bool = True
) -> DataFrame:
    """Documents as they land.  Files arrive in no particular order."""
    return (
        spark.readStream.schema(RAW_DOCUMENT)
        .option("multiLine", multi_line)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(path)
    )


def start_ingest(
    documents: DataFrame,
    root: str,
    checkpoint: str,
    layout: Sequence[str] = LAYOUT,
    location: tuple[float, float] | None = None,
) -> StreamingQuery:
    """Upsert what has landed so far, then stop; run again for what lands later.

    `location`: the search centre of all documents, instead of their own.  The commit comes
    from the document or its file, never from the order of arrival.  A micro-batch is one log batch, named after the checkpoint and its number, so a
    replayed one is recognised; several may add to the same commit.  Documents without usable
    places are commits, too.
    """
    # A new checkpoint counts from zero again, so its path is part of the name.
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def upsert(batch: DataFrame, number: int) -> None:
        places = flatten_places(batch, location=location, origin=F.col("__origin"))
        runs = document_runs(batch, location=location)
        append_batch(places, root, f"{stream}-{number:012d}", layout, runs)

    # What is known of a document's file is not known any more inside a micro-batch.
    return (
        documents.withColumns({"commit": file_instant(), "__origin": file_origin()})
        .writeStream.foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
