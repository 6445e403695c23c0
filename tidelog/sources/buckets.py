"""The log bucketed by entity: as-of reads and intervals meet without moving a record.

A compacted copy of the published log as a bucketed table: each entity's versions lie in one bucket,
in the order of their commits.  Windows and groups by location and entity then take the rows as they
are read.  A hot entity is no hot bucket: it has one row per commit at most.
"""

from pyspark.sql import DataFrame, SparkSession

from tidelog.schemas import LOG, RECORD_COLUMNS
from tidelog.sources.log import KEY, read_log

BUCKETS = 200


def write_bucketed(spark: SparkSession, root: str, table: str, buckets: int = BUCKETS) -> None:
    """Copy the published log of `root` to the folder `<root>/bucketed` and name it `table`.

    One exchange, by entity, and the last one: as many tasks as buckets, one file each.
    """
    (
        read_log(spark, root)
        .repartition(buckets, *KEY)
        .write.mode("overwrite")
        .bucketBy(buckets, *KEY)
        .sortBy(*KEY, "commit")
        .option("path", f"{root}/bucketed")
        .saveAsTable(table)
    )


def read_bucketed(spark: SparkSession, root: str, table: str, buckets: int = BUCKETS) -> DataFrame:
    """The bucketed log; a session that does not know the table yet is told of it.

    `buckets` must be those it was written with.
    """
    if not spark.catalog.tableExists(table):
        kinds = {f.name: f.dataType.simpleString() for f in LOG.fields}
        columns = ["location_key", "commit", *RECORD_COLUMNS]
        by = ", ".join(KEY)
        spark.sql(
            f"CREATE TABLE {table} ({', '.join(f'{c} {kinds[c]}' for c in columns)}) USING parquet "
            f"CLUSTERED BY ({by}) SORTED BY ({by}, commit) INTO {buckets} BUCKETS LOCATION '{root}/bucketed'"
        )
    return spark.table(table)
