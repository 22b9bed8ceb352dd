"""Stage tables of a run in the shared folder of the cluster."""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter

from pyspark.sql import DataFrame, SparkSession

from tallyworks.sources.shared import new_folder

BUCKET_BYTES = 128 << 20  # of a written bucket, which one task reads
UNKNOWN = 1 << 60  # Spark takes a table of unknown size for larger than any
MOST_BUCKETS = 100_000  # that Spark allows by default
WIDER = 4  # a stage holds its inputs several times: rows are added and columns attached


def input_bytes(df: DataFrame) -> int:
    """Bytes of the tables ``df`` is made of, as Spark knows them from their files; a source of
    unknown size counts as nothing."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(size for size in sizes if size < UNKNOWN)


class RunStore:
    """Writes the stages of one run and reads them back.

    A written stage cuts the lineage, survives lost executors and has a known size, by
    which Spark picks its joins.  A stage kept by a column has ``buckets`` buckets, each read by
    one task.  Where ``buckets`` is not given, the first such stage sets it for the run, from the
    bytes of its inputs over ``bucket_bytes``, at least as many as the session has shuffle
    partitions; a stage whose largest bucket turns out to be over ``bucket_bytes`` is split into
    as many more.  ``save_to`` names a folder that gets a copy of every stage under its name.
    ``close`` drops the run's tables and files; what is left goes when the application ends.
    """

    def __init__(self, spark: SparkSession, name: str = "run", buckets: int | None = None,
                 save_to: str | None = None, bucket_bytes: int = BUCKET_BYTES):
        self.spark, self.save_to, self.bucket_bytes = spark, save_to, bucket_bytes
        self.run = uuid.uuid4().hex
        self.folder = new_folder(spark, name)
        self.buckets, self.fixed = buckets, buckets is not None
        self.tables: list[str] = []

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def plan_buckets(self, *inputs: DataFrame) -> int:
        """Set the buckets of the run from the tables it starts from, if none were given."""
        if self.buckets is None:
            size = WIDER * sum(map(input_bytes, inputs))
            least = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            self.buckets = min(MOST_BUCKETS, max(least, math.ceil(size / self.bucket_bytes)))
        return self.buckets

    def keep(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        """Write ``df`` and read it back.

        With ``by`` the table is bucketed, so that later windows and joins on that column,
        alone or with others, read it without a shuffle.  ``df`` should be hashed by the
        column already: each task then writes the buckets it holds and no others.
        """
        if by is None:
            df.write.mode("errorifexists").parquet(self.path(name))
            kept = self.spark.read.schema(df.schema).parquet(self.path(name))
        else:
            buckets = self.plan_buckets(df)
            kept = self._bucketed(df, name, by, buckets)
            largest = max(self._bucket_sizes(name).values(), default=0)
            if not self.fixed and largest > self.bucket_bytes:
                more = min(MOST_BUCKETS, buckets * math.ceil(largest / self.bucket_bytes))
                kept = self._bucketed(kept.repartition(more, by), f"{name}_split", by, more)
        if self.save_to is not None:
            kept.write.mode("errorifexists").parquet(f"{self.save_to}/{name}")
        return kept

    def _bucketed(self, df: DataFrame, name: str, by: str, buckets: int) -> DataFrame:
        table = f"stage_{self.run}_{name}"
        (df.write.mode("errorifexists").format("parquet").bucketBy(buckets, by)
         .option("path", self.path(name)).saveAsTable(table))
        self.tables.append(table)
        return self.spark.table(table)

    def _bucket_sizes(self, name: str) -> Counter[str]:
        """Bytes of each bucket, by the numbers in the names of its files."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        files = place.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(place)
        sizes: Counter[str] = Counter()
        for file in files:
            bucket = re.search(r"_(\d+)(?:\.c\d+)?\.", file.getPath().getName())
            if bucket:
                sizes[bucket[1]] += file.getLen()
        return sizes

    def close(self) -> None:
        for table in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self.tables.clear()
        place = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)
