"""A panel stored by entity: joins and entity windows over such tables shuffle nothing.

A bucketed table keeps all rows of an entity in one file, sorted by (entity, date). Two tables with the same number of
buckets are joined file by file, and a window over an entity's months reads them as they lie. One shuffle, when the
table is written, serves every later query.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from panelwise.runtime import col, shared_folder

#: Rows of a bucket, about, where the number of buckets is not given.
BUCKET_ROWS = 20_000_000


def write_bucketed(df: DataFrame, name: str | None = None, buckets: int | None = None, entity: str = "permno", date: str = "date", path: str | None = None) -> DataFrame:
    """``df`` as a table in ``buckets`` files by entity, sorted by (entity, date), on the shared folder unless ``path`` says otherwise.

    Tables that are to be joined need the same number of buckets. An entity has a row per month, so no bucket is much larger than others.
    """
    spark = df.sparkSession
    name = name or f"bucketed_{uuid.uuid4().hex}"
    buckets = buckets or max(1, -(-df.count() // BUCKET_ROWS))
    # One task per bucket, so one file per bucket.
    dealt = df.repartition(buckets, col(entity))
    dealt.write.bucketBy(buckets, entity).sortBy(entity, date).option("path", path or f"{shared_folder(spark)}/{name}").mode("overwrite").saveAsTable(name)
    return spark.table(name)


def entity_joins(spark: SparkSession) -> None:
    """Lets joins on (entity, date) use tables that are dealt by the entity alone. An entity's rows are few, so no task gets much more."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")


def drop_bucketed(spark: SparkSession, name: str) -> None:
    """Forgets the table and deletes its files."""
    path = spark.sql(f"describe formatted `{name}`").filter("col_name = 'Location'").first()["data_type"]
    spark.sql(f"drop table `{name}`")
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
