"""Raw documents, result pages and daily rows."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidelog.schemas import DAILY, DETAILS_RESPONSE, FAILED, RAW_DOCUMENT, SEARCH_RESPONSE


def read_documents(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Documents of a file or folder: one pretty-printed document per file, or one per line.

    One document per line is the form to land at scale: such files can be split.
    """
    return spark.read.schema(RAW_DOCUMENT).option("multiLine", multi_line).json(path)


def read_search_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed search responses, one per line, all pages of all requests."""
    return spark.read.schema(SEARCH_RESPONSE).json(path)


def read_details(spark: SparkSession, path: str) -> DataFrame:
    """Landed details responses, one per line."""
    return spark.read.schema(DETAILS_RESPONSE).json(path)


def write_documents(documents: DataFrame, path: str, one_per_file: bool = True) -> None:
    """Append documents as JSON, each in its own file or one per line."""
    writer = documents.write.mode("append")
    if one_per_file:
        writer = writer.option("maxRecordsPerFile", 1).option("pretty", True)
    writer.json(path)


def write_batch(documents: DataFrame, path: str, batch: str) -> None:
    """Write documents, one per line, as a batch of a folder of documents, replacing it."""
    documents.write.mode("overwrite").json(f"{path}/batch={batch}")


def write_failed(failed: DataFrame, path: str, batch: str) -> None:
    """Write the failed responses of a batch beside its documents, which readers do not see."""
    failed.write.mode("overwrite").json(f"{path}/_failed/batch={batch}")


def read_failed(spark: SparkSession, path: str) -> DataFrame:
    """Failed responses of all batches; none where nothing was collected."""
    return read_or_none(spark, FAILED, "json", f"{path}/_failed")


def read_or_none(spark: SparkSession, schema: T.StructType, kind: str, path: str) -> DataFrame:
    """A table, or no rows of its schema where nothing was ever written."""
    try:
        return spark.read.schema(schema).format(kind).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    """Daily popularity, JSON lines."""
    return spark.read.schema(DAILY).json(path)
