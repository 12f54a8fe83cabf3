"""Change-tracking snapshots, type 2 (SCD-1).

A versions table holds every state of each key with ``valid_from``,
``valid_to`` and ``is_current``. Merging a new snapshot closes versions whose
tracked values changed or whose key disappeared, opens versions for changed
and new keys, and keeps everything else. One full outer join on the key
(unique on both sides, so nothing fans out) is read once: each joined row is
exploded into its one or two versions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from personalens.sources.store import Folder


def _same(cols: list[str]) -> Column:
    return reduce(lambda a, b: a & b,
                  [F.col(f"p.{c}").eqNullSafe(F.col(f"s.{c}")) for c in cols])


def scd2_merge(versions: DataFrame, snapshot: DataFrame, key: str, tracked: list[str],
               as_of: str) -> DataFrame:
    history = versions.where(~F.col("is_current")).select(key, *tracked, "valid_from", "valid_to", "is_current")
    return history.unionByName(merged_versions(versions.where(F.col("is_current")), snapshot, key, tracked, as_of))


def merged_versions(current: DataFrame, snapshot: DataFrame, key: str, tracked: list[str], as_of: str) -> DataFrame:
    """The current versions after a snapshot, and those that it closes."""
    day = F.lit(as_of).cast("date")
    cols = [key, *tracked]
    current, snap = current.alias("p"), snapshot.select(*cols).alias("s")
    j = current.join(snap, F.col(f"p.{key}") == F.col(f"s.{key}"), "full")
    in_p, in_s = F.col(f"p.{key}").isNotNull(), F.col(f"s.{key}").isNotNull()
    unchanged = in_p & in_s & _same(tracked)
    # The one or two versions that a joined row stands for.
    kept = F.struct(*[F.col(f"p.{c}").alias(c) for c in cols], F.col("p.valid_from").alias("valid_from"),
                    F.when(unchanged, F.col("p.valid_to")).otherwise(day).alias("valid_to"), unchanged.alias("is_current"))
    opened = F.struct(*[F.col(f"s.{c}").alias(c) for c in cols], day.alias("valid_from"),
                      F.lit(None).cast("date").alias("valid_to"), F.lit(True).alias("is_current"))
    one, other = F.when(in_p, kept), F.when(in_s & ~unchanged, opened)
    return j.select(F.explode(F.filter(F.array(one, other), lambda v: v.isNotNull())).alias("v")).select("v.*")


def first_versions(snapshot: DataFrame, key: str, tracked: list[str], as_of: str) -> DataFrame:
    """A versions table holding one current version per key."""
    return snapshot.select(key, *tracked, F.lit(as_of).cast("date").alias("valid_from"),
                           F.lit(None).cast("date").alias("valid_to"),
                           F.lit(True).alias("is_current"))


class VersionStore:
    """A versions table that grows by one merge at a time, each reading and writing its current part only.

    Every merge writes one table, partitioned by ``is_current`` and bucketed by
    the key, below ``target/merges/<day>``: its versions that are current from
    that day on, and those that the day closed. The current part of the last merge is
    the whole current state; the closed parts of all merges are the history and are
    never written again. As stored rows lie in buckets of the key, the join
    shuffles the snapshot alone. CURRENT names the last merge and is replaced by
    one rename, so a failed merge leaves the table as it was and may be run again.
    """

    def __init__(self, spark: SparkSession, target: str, key: str, tracked: list[str], buckets: int | None = None):
        self.spark, self.folder = spark, Folder(spark, target)
        self.key, self.tracked = key, tracked
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.columns = [key, *tracked, "valid_from", "valid_to", "is_current"]

    def merge(self, snapshot: DataFrame, as_of: str) -> None:
        """Take in the state of all keys on a day (text yyyy-mm-dd), later than every day before."""
        last = self.folder.read("CURRENT")
        if last is not None and as_of <= last:
            raise ValueError(f"{as_of} is not after the last merge, {last}")
        self._write(self.after(snapshot, as_of), as_of)
        self.folder.replace("CURRENT", as_of)
        if last is not None:
            self.folder.remove(f"merges/{last}/is_current=true")  # superseded; its closed part stays

    def after(self, snapshot: DataFrame, as_of: str) -> DataFrame:
        """What a merge writes: current versions and those closed on that day."""
        last = self.folder.read("CURRENT")
        if last is None:
            return first_versions(snapshot, self.key, self.tracked, as_of)
        return merged_versions(self._table(last).where("is_current"), snapshot, self.key, self.tracked, as_of)

    def versions(self) -> DataFrame:
        """All versions, closed and current."""
        last = self.folder.read("CURRENT")
        if last is None:
            raise ValueError("nothing was merged yet")
        parts = [self._table(last).where("is_current")]
        parts += [self._table(day).where("NOT is_current") for day in self.folder.names("merges") if day <= last]
        return reduce(DataFrame.unionByName, [p.select(*self.columns) for p in parts])

    def _name(self, day: str) -> str:
        return f"versions_{abs(hash(self.folder.top)) % 10**12}_{day.replace('-', '')}"

    def _write(self, df: DataFrame, day: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self._name(day)}")
        (df.select(*self.columns).repartition(self.buckets, self.key).write.mode("overwrite").partitionBy("is_current")
         .bucketBy(self.buckets, self.key).option("path", self.folder.full(f"merges/{day}")).saveAsTable(self._name(day)))

    def _table(self, day: str) -> DataFrame:
        """A merge's table; named in this session's catalog if another one wrote it."""
        name = self._name(day)
        if not self.spark.catalog.tableExists(name):
            fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self._schema(day))
            self.spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet PARTITIONED BY (is_current) "
                           f"CLUSTERED BY (`{self.key}`) INTO {self.buckets} BUCKETS LOCATION '{self.folder.full(f'merges/{day}')}'")
            self.spark.sql(f"MSCK REPAIR TABLE {name}")
        return self.spark.table(name)

    def _schema(self, day: str):
        return self.spark.read.parquet(self.folder.full(f"merges/{day}")).select(*self.columns).schema
