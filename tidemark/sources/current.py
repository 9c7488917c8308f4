"""The current-state table: one row per key, upserted batch by batch, read in SQL by its name.

Three kinds of catalog objects, all as Spark has them:

- ``<name>_changes``, an external table partitioned by commit. A batch's newest rows are one partition. Writing it
  again replaces that partition (dynamic partition overwrite), so a repeated batch leaves what it left before.
- ``<name>_base_<commit>``, all rows as of a commit, bucketed by key and never changed.
- ``<name>``, a view: the base's rows whose key no later commit has, and the last later change of each key. The base
  is read in its buckets and not shuffled.

A batch with random keys touches every file of a keyed table, so a batch writes its own rows alone, and `merge` makes a
new base once the changes are a set share of the old one. What a merge replaced is deleted by the next one, so queries
planned before a merge have as long as that to end. One writer at a time.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import quoted
from tidemark.operators.latest import latest_per_key
from tidemark.schema import COMMIT, KEY, ORDERS, PARTITION, TIEBREAK, TS
from tidemark.session import sql_settings
from tidemark.sources import files
from tidemark.sources.tables import (
    drop_table,
    ensure_database,
    ensure_table,
    name_parts,
    partition_numbers,
    planned_bytes,
    text_literal,
)

MB = 1024 * 1024
# Bytes of a batch's files for each task that ranks its rows; unpacked they are a few times as many.
BATCH_SPLIT = 32 * MB
BASE_FOLDER = re.compile(r"base-(\d+)-(\d+)")


class CurrentTable:
    """One row per key under a catalog ``name``, with insert-or-replace by batch; files are under ``location``.

    - ``bucket_size`` is the aimed bytes of a bucket. Each base has as many buckets as its size asks for.
    - ``sort_by`` orders the rows of a bucket, so that a filter on these columns skips most pages of a bucket's file,
      much as it would skip partitions. Pass () where nobody filters by date.
    - ``merge_ratio``: changes beyond this share of the base, and of ``merge_size`` bytes at least, are merged into
      a new base. None leaves that to calls of `merge`.
    """

    def __init__(
        self,
        spark: SparkSession,
        name: str,
        location: str,
        schema: T.StructType = ORDERS,
        keys: Sequence[str] = (KEY,),
        order_by: str = TS,
        tiebreak: Sequence[str] = TIEBREAK,
        sort_by: Sequence[str] = (PARTITION,),
        bucket_size: int = 1024 * MB,
        min_buckets: int = 8,
        merge_ratio: float | None = 0.25,
        merge_size: int = 64 * MB,
    ) -> None:
        unknown = {*keys, order_by, *tiebreak, *sort_by} - set(schema.fieldNames())
        if unknown:
            raise ValueError(f"columns not in the schema: {sorted(unknown)}")
        self.spark = spark
        self.database, self.short_name = name_parts(spark, name)
        self.name = quoted(self.database, self.short_name)
        self.changes = quoted(self.database, f"{self.short_name}_changes")
        self.location = location.rstrip("/")
        self.schema = schema
        self.keys = list(keys)
        self.order_by = order_by
        self.tiebreak = list(tiebreak)
        self.sort_by = list(sort_by)
        self.bucket_size = bucket_size
        self.min_buckets = min_buckets
        self.merge_ratio = merge_ratio
        self.merge_size = merge_size
        ensure_database(spark, self.database)
        ensure_table(
            spark,
            self.changes,
            f"{self.location}/changes",
            T.StructType([*schema.fields, T.StructField(COMMIT, T.LongType())]),
            [COMMIT],
            replace_partitions=True,
        )
        if not spark.catalog.tableExists(self.name):
            self._register()

    # -- reading ---------------------------------------------------------------------------

    def read(self) -> DataFrame:
        """The current rows: what SQL finds under the name. Sessions keep file lists, which this renews."""
        self.spark.catalog.refreshTable(self.changes)
        return self.spark.table(self.name)

    def is_empty(self) -> bool:
        return self.read().isEmpty()

    def base(self) -> int | None:
        """The commit that the base holds all rows of."""
        found = self._properties().get("tidemark.base")
        return None if found is None else int(found)

    def commits(self) -> list[int]:
        """Commits after the base, in order."""
        base = self.base()
        return [c for c in partition_numbers(self.spark, self.changes, COMMIT) if base is None or c > base]

    def next_commit(self) -> int:
        base = self.base()
        return max([-1 if base is None else base, *self.commits()]) + 1

    def loaded_through(self) -> int | None:
        """The last raw batch that the initial load read."""
        found = self._properties().get("tidemark.raw_batch")
        return None if found is None else int(found)

    # -- writing ---------------------------------------------------------------------------

    def load(self, rows: DataFrame, size: int, raw_batch: int | None = None) -> None:
        """Write the first base from rows that are one per key and come from ``size`` bytes.

        With as many shuffle partitions as buckets, the shuffle that made the rows unique also places
        them in buckets, and they are not shuffled again.
        """
        if not self.is_empty():
            raise ValueError(f"{self.name} already has rows")
        buckets = self._bucket_count(size)
        commit = self.next_commit()
        with sql_settings(rows.sparkSession, {"spark.sql.shuffle.partitions": str(buckets)}):
            self._write_base(rows, commit, buckets)
        self._show(commit, raw_batch)

    def apply(self, batch: DataFrame, commit: int) -> bool:
        """Upsert the newest row per key of a batch; False if a base holds that commit already.

        Commits rise; only the last one may come again, with the same rows. Rows replace those of earlier commits
        whatever their timestamps are. Rows with a NULL key match nothing, so each commit that has any adds one.
        """
        base = self.base()
        if base is not None and commit <= base:
            return False
        newest = latest_per_key(batch, self.keys, self.order_by, self.tiebreak)
        rows = newest.select(*self._names(), F.lit(commit).cast("long").alias(COMMIT))
        size = planned_bytes(batch)
        sized = {} if size is None else {"spark.sql.shuffle.partitions": str(size // BATCH_SPLIT + 1)}
        # The session of a micro-batch is the stream's own.
        with sql_settings(batch.sparkSession, sized):
            rows.write.insertInto(self.changes, overwrite=True)
        if self._merge_is_due():
            self.merge()
        return True

    def merge(self) -> bool:
        """Make a base of all commits but the last, which may come again; False if there are none.

        The base is written beside the old one, then the view is replaced, and then what the old base had replaced
        is deleted. A crash leaves the view as it was or as it will be.
        """
        before, commits = self.base(), self.commits()
        if len(commits) < 2:
            return False
        upto = commits[-2]
        self.spark.catalog.refreshTable(self.changes)
        rows = self.spark.sql(self._query(before, upto))
        self._write_base(rows, upto, self._bucket_count(self._size(before, upto)))
        self._show(upto, self.loaded_through())
        if before is not None:
            self._delete_before(before)
        return True

    # -- inside ----------------------------------------------------------------------------

    def _names(self) -> list[str]:
        return [quoted(name) for name in self.schema.fieldNames()]

    def _base_name(self, commit: int) -> str:
        return quoted(self.database, f"{self.short_name}_base_{commit}")

    def _properties(self) -> dict[str, str]:
        return {row["key"]: row["value"] for row in self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").collect()}

    def _later(self, base: int | None, upto: int | None = None) -> str:
        low = -1 if base is None else base
        return f"{COMMIT} > {low}" + ("" if upto is None else f" AND {COMMIT} <= {upto}")

    def _query(self, base: int | None, upto: int | None = None) -> str:
        """SQL for the rows as of a commit, or of the last."""
        names, keys = ", ".join(self._names()), [quoted(key) for key in self.keys]
        later = self._later(base, upto)
        any_null = " OR ".join(f"{key} IS NULL" for key in keys)
        newest = f"""
            SELECT {names} FROM (
                SELECT *, row_number() OVER (
                    PARTITION BY {', '.join(keys)}, CASE WHEN {any_null} THEN {COMMIT} END ORDER BY {COMMIT} DESC
                ) AS _rank
                FROM {self.changes} WHERE {later}
            ) WHERE _rank = 1"""
        if base is None:
            return newest
        same = " AND ".join(f"c.{key} = b.{key}" for key in keys)
        return f"""
            SELECT {names} FROM {self._base_name(base)} b
            WHERE NOT EXISTS (SELECT 1 FROM {self.changes} c WHERE {later} AND {same})
            UNION ALL {newest}"""

    def _show(self, base: int | None, raw_batch: int | None = None) -> None:
        """Put the view over a base in force: one change of the catalog."""
        found = {"tidemark.base": base, "tidemark.raw_batch": raw_batch}
        properties = ", ".join(f"'{key}' = '{value}'" for key, value in found.items() if value is not None)
        given = f"TBLPROPERTIES ({properties})" if properties else ""
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name} {given} AS {self._query(base)}")

    def _register(self) -> None:
        """Find the newest whole base, for catalogs that do not outlive a session."""
        base = None
        for commit, folder in self._base_folders():
            if "_SUCCESS" in files.list_names(self.spark, f"{self.location}/{folder}"):
                base = (commit, folder)
        if base is not None:
            buckets = int(BASE_FOLDER.fullmatch(base[1])[2])
            columns = ", ".join(f"{quoted(field.name)} {field.dataType.simpleString()}" for field in self.schema)
            self.spark.sql(
                f"CREATE EXTERNAL TABLE IF NOT EXISTS {self._base_name(base[0])} ({columns}) USING parquet "
                f"CLUSTERED BY ({', '.join(map(quoted, self.keys))}) INTO {buckets} BUCKETS "
                f"LOCATION {text_literal(f'{self.location}/{base[1]}')}"
            )
        self._show(base and base[0])

    def _base_folders(self) -> list[tuple[int, str]]:
        names = filter(BASE_FOLDER.fullmatch, files.list_names(self.spark, self.location))
        return sorted((int(BASE_FOLDER.fullmatch(name)[1]), name) for name in names)

    def _write_base(self, rows: DataFrame, commit: int, buckets: int) -> None:
        writer = (
            # No shuffle if the rows already are in this partitioning.
            rows.select(*self._names())
            .repartition(buckets, *map(quoted, self.keys))
            .write.format("parquet")
            .mode("overwrite")
            .bucketBy(buckets, *self.keys)
            .option("path", f"{self.location}/base-{commit}-{buckets}")
        )
        if self.sort_by:
            writer = writer.sortBy(*self.sort_by)
        writer.saveAsTable(self._base_name(commit))

    def _delete_before(self, base: int) -> None:
        """Delete the bases before one, and the commits that it holds."""
        for commit, folder in self._base_folders():
            if commit < base:
                drop_table(self.spark, self._base_name(commit))
                files.delete_tree(self.spark, f"{self.location}/{folder}")
        old = [c for c in partition_numbers(self.spark, self.changes, COMMIT) if c <= base]
        if old:
            listed = ", ".join(f"PARTITION ({COMMIT} = {commit})" for commit in old)
            self.spark.sql(f"ALTER TABLE {self.changes} DROP IF EXISTS {listed}")
        for commit in old:
            files.delete_tree(self.spark, f"{self.location}/changes/{COMMIT}={commit}")

    def _size(self, base: int | None, upto: int | None = None) -> int:
        changes = planned_bytes(self.spark.table(self.changes).where(self._later(base, upto)))
        return (changes or 0) + self._base_size(base)

    def _base_size(self, base: int | None) -> int:
        return 0 if base is None else planned_bytes(self.spark.table(self._base_name(base))) or 0

    def _merge_is_due(self) -> bool:
        if self.merge_ratio is None or len(self.commits()) < 2:
            return False
        base = self.base()
        size = self._base_size(base)
        return self._size(base) - size > max(self.merge_ratio * size, self.merge_size)

    def _bucket_count(self, size: int) -> int:
        return max(self.min_buckets, -(-size // self.bucket_size))
