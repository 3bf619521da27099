"""Source files stored once for many runs, so that joins and incremental runs leave their texts where they are.

Files lie in folders by a hash of their repository and, inside, in buckets by repository and path, sorted.  A join on
repository and path meets texts in their buckets: only the other side is shuffled, whatever its size.  A run over some repositories
opens their folders alone, and tells their files from others in these folders by the paths, before texts are read.
A hot repository lies in one folder but in all buckets.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codesieve.operators.partitioning import join_wide

FILE = ["repository_id", "file_path"]
COLUMNS = [*FILE, "language", "content"]


@dataclass(frozen=True)
class StoredFiles:
    """A table of the session's catalog with the columns of ``source_files``, dealt to folders and buckets."""

    spark: SparkSession
    name: str
    folders: int
    buckets: int

    def folder_of(self, repository: Column) -> Column:
        return F.pmod(F.xxhash64(repository), F.lit(self.folders)).cast("int")

    def files(self) -> DataFrame:
        """All files."""
        return self.spark.table(self.name).select(*COLUMNS)

    def of(self, ids: DataFrame) -> DataFrame:
        """Files of the repositories whose ids the only column of ``ids`` holds; null and repeated ids have no effect.

        The numbers of their folders (at most ``folders``) become a filter of the plan, so other folders are not opened.
        """
        wanted = ids.toDF("repository_id").where("repository_id is not null").distinct()
        folders = [row[0] for row in wanted.select(self.folder_of(F.col("repository_id"))).distinct().collect()]
        there = self.spark.table(self.name).where(F.col("folder").isin(folders))
        paths = join_wide(there.select(*FILE), wanted, "repository_id", "left_semi")
        # The texts stream past the paths of their bucket: neither side is sorted, and only paths were shuffled.
        return there.select(*COLUMNS).join(paths.distinct().hint("shuffle_hash"), FILE, "left_semi")

    def add(self, files: DataFrame) -> None:
        """Store more files; those of one repository may come in several steps."""
        _written(files, self).mode("append").saveAsTable(self.name)


def _written(files: DataFrame, stored: StoredFiles):
    # Dealt as the buckets are, so that every task writes one file a folder.
    dealt = files.select(*COLUMNS).repartition(stored.buckets, *FILE).withColumn(
        "folder", stored.folder_of(F.col("repository_id")))
    return dealt.sortWithinPartitions("folder", *FILE).write.format("parquet").partitionBy("folder").bucketBy(
        stored.buckets, *FILE).sortBy(*FILE)


def store_files(files: DataFrame, name: str, path: str, folders: int = 1024, buckets: int = 256) -> StoredFiles:
    """Store ``source_files`` below ``path``, a folder that all executors share, as table ``name``.

    Take some four folders a repository, so that few share one, and buckets of a size that fits a task.  Rows without a repository or a
    path are stored, but no join finds them.
    """
    stored = StoredFiles(files.sparkSession, name, folders, buckets)
    _written(files, stored).option("path", path).saveAsTable(name)
    return stored


def open_files(spark: SparkSession, name: str, path: str, folders: int, buckets: int) -> StoredFiles:
    """Stored files of an earlier session, as table ``name``; folders and buckets as they were stored."""
    spark.sql(f"CREATE TABLE `{name}` (repository_id STRING, file_path STRING, language STRING, content STRING, folder INT) "
              f"USING parquet PARTITIONED BY (folder) CLUSTERED BY (repository_id, file_path) "
              f"SORTED BY (repository_id, file_path) INTO {int(buckets)} BUCKETS LOCATION '{path}'")
    spark.catalog.recoverPartitions(name)
    return StoredFiles(spark, name, folders, buckets)
