"""Parquet tables: layered store with published versions, merges by key, intermediate tables.

A table that is written by this module has versions (see ``versions``): replacing it, merging a batch and replacing a
slice all write new folders and publish a version that names them and those that stay as they were. Raw
tables are plain folders of batches, other Parquet folders are read as they are.
"""

from __future__ import annotations

import atexit
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from urllib.parse import unquote
from uuid import uuid4
from zlib import crc32

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelkit.operators.cleaning import latest_by
from panelkit.sources import batches, versions
from panelkit.sources.storage import delete_folder
from panelkit.sources.storage import file_system as _files
from panelkit.sources.versions import Change, ConcurrentWrite, Marks, Version
from panelkit.sources.versions import rebalanced as _rebalanced  # noqa: F401

_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate data.

    The checkpoint directory that the session has set, else ``spark.checkpoint.dir``. Where neither is set a local
    session gets one in its warehouse; a cluster has to name a folder that its machines share.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir() or context.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
        context.setCheckpointDir(folder)
    return folder


_frames: dict[str, SparkSession] = {}


@atexit.register
def _delete_frames() -> None:
    """Intermediate tables of this application go with it."""
    for path, spark in _frames.items():
        try:
            if spark.sparkContext._jsc is not None:
                delete_folder(spark, path)
        except Exception:  # the session's JVM may be gone already
            return


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage: write the frame to the shared folder once and go on from the written table.

    For results that are small next to what they are computed from and are used more than once.
    Written as Parquet, so later steps still read only the columns they need, and lost executors
    cost a read rather than the computation. ``release`` deletes it; else it goes when the application ends.
    """
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/frame-{uuid4().hex}"
    _frames[path] = df.sparkSession
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(df: DataFrame) -> None:
    """Delete the files of a ``checkpointed`` frame that nothing will read any more."""
    folders = {name.rpartition("/")[0].rpartition("/")[2] for name in df.inputFiles()}
    for path in [p for p in _frames if p.rpartition("/")[2] in folders]:
        delete_folder(_frames.pop(path), path)


def between_years(df: DataFrame, first: int, last: int, column: str = "year") -> DataFrame:
    """Rows of a closed range of years; prunes partitions of tables partitioned by year."""
    return df.filter(F.col(column).between(first, last))


def _plain(spark: SparkSession, path: str) -> DataFrame | None:
    """A folder without versions as a table, None if there is none; one that cannot be read is an error."""
    files, where = _files(spark, path)
    if not files.exists(where):
        return None
    try:
        return batches.read(spark, path)
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA" and not _has_data(files, where):
            return None
        raise


def _has_data(files, where) -> bool:
    found = files.listFiles(where, True)
    while found.hasNext():
        if not found.next().getPath().getName().startswith(("_", ".")):
            return True
    return False


def overwrite_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), marks: Marks | None = None) -> Version:
    """Replace a table, schema included, by a new version; a write that fails leaves the old one.

    Of two writers at once the later one's version comes last; both are published.
    """

    def write(_: Version | None) -> Change:
        folder, names = versions.write_folder(df, path, partition_by)
        return Change(folder, df.schema, tuple(partition_by), None, names, marks=marks or {})

    return versions.commit(df.sparkSession, path, write)


def _touched(old: DataFrame, batch: DataFrame, partition: str) -> DataFrame:
    """The rows of a table in the partitions that a batch touches.

    The bounds of the batch prune the scan when it is planned, its distinct values at run time.
    NULL is a partition of its own, read only if the batch has it.
    """
    low, high, unknown = batch.agg(F.min(partition), F.max(partition), F.count_if(F.col(partition).isNull())).first()
    inside = F.col(partition).between(F.lit(low), F.lit(high))
    values = batch.filter(inside).select(F.col(partition).alias("_touched")).distinct()
    known = old.filter(inside).join(values, F.col(partition) == F.col("_touched"), "left_semi")
    return known.unionByName(old.filter(F.col(partition).isNull())) if unknown else known


def _joined(old: DataFrame, batch: DataFrame, keys: Sequence[str], order: str | None) -> DataFrame:
    """One row per key: the newest by ``order``, or without it the batch's where it has one."""
    if order:
        return latest_by(old.unionByName(batch, allowMissingColumns=True), keys, order)
    both = old.withColumn("_new", F.lit(False)).unionByName(batch.withColumn("_new", F.lit(True)), allowMissingColumns=True)
    return latest_by(both, keys, "_new").drop("_new")


def upsert_partitions(
    df: DataFrame,
    path: str,
    partition: str = "year",
    mode: str = "merge",
    keys: Sequence[str] = (),
    order: str = "ingested_at",
    schema: StructType | None = None,
    marks: Marks | None = None,
    meanwhile: Callable[[], None] | None = None,
) -> Version | None:
    """Publish a version with a batch in the partitions it touches and all others as they are.

    ``merge`` keeps the newest version per key of old and new rows, also where there is no table yet; ``override`` lets
    every row of the batch stand for the old one of its key, whatever its age;
    ``replace`` gives a touched partition exactly the rows of the batch, so that keys missing there go.
    Without the partition column the whole table is merged or replaced. A batch without rows changes
    nothing in a partitioned table. Rows whose partition value is NULL have a partition of their own. ``schema`` is
    that of a table without versions; without it the footers of its files are opened to find columns added over time.

    The batch is computed once; one that overrides should be a written frame. Readers of the version before see it unchanged, and a write that fails leaves it. If another
    writer publishes first, the merge is made again where it touched the same partitions. ``marks`` (how far other
    tables have been read) are published by the same file, so they never differ from the rows. ``meanwhile`` is called between
    writing and publishing, for tests.
    """
    if mode not in ("replace", "merge", "override"):
        raise ValueError(f"unknown mode {mode!r}")
    keyed = mode != "replace"
    if keyed and not keys:
        raise ValueError("merging needs the keys that tell rows apart")
    spark, partitioned = df.sparkSession, partition in df.columns
    by = (partition,) if partitioned else ()
    batch = checkpointed(latest_by(df, keys, order)) if mode == "merge" else df

    def old_rows(base: Version | None) -> DataFrame | None:
        if base is not None:
            return versions.read(spark, path, base)
        plain = _plain(spark, path)
        return spark.read.schema(schema).parquet(path) if plain is not None and schema else plain

    def write(base: Version | None) -> Change | None:
        old = old_rows(base)
        # Without versions, or with other partitions than now, the table is written as a whole.
        fits = base is not None and base.partition_by == by and partitioned
        rows = batch
        if old is not None and partitioned and partition not in old.columns:
            old = None  # an unpartitioned table gives way to a partitioned one
        if old is not None and partitioned:
            old = old.withColumn(partition, F.col(partition).cast(df.schema[partition].dataType))
        if old is not None and keyed:
            kept = _touched(old, batch, partition) if fits else old
            rows = _joined(kept, batch, keys, order if mode == "merge" else None)
        elif old is not None and partitioned and not fits:
            rows = old.join(batch.select(partition).distinct(), partition, "left_anti").unionByName(batch, allowMissingColumns=True)
        folder, names = versions.write_folder(rows, path, by)
        if meanwhile:
            meanwhile()
        if not fits:
            seen = {} if keyed or partitioned else None
            return Change(folder, rows.schema, by, None, names, seen, marks or {})
        if not names and not marks:
            delete_folder(spark, f"{path.rstrip('/')}/{folder}")
            return None
        seen = {name: base.folder_of(name) for name in names} if keyed else None
        return Change(folder, rows.schema, by, frozenset(names), names, seen, marks or {})

    try:
        return versions.commit(spark, path, write)
    finally:
        if batch is not df:
            release(batch)


def _value_in(name: str) -> str:
    """The value in a partition's name, as text."""
    return unquote(name.partition("=")[2])


def replace_slice(df: DataFrame, path: str, column: str, value: str | bool | int) -> Version:
    """Replace the rows of one partition value by the given rows; running it again changes nothing.

    The rows may come from the slice itself: the version before stays until the new one is published, and a failure leaves
    it. An empty frame leaves the slice empty. If another writer changes the slice in the meantime it is an error, as the
    rows may come from what the slice held before.
    """
    spark, text = df.sparkSession, str(value).lower() if isinstance(value, bool) else str(value)
    started = versions.current(spark, path)
    if started is None or started.partition_by != (column,):
        raise ValueError(f"{path} is no table with versions partitioned by {column}")
    before = {f.partition("/")[2]: f for f in started.folders if _value_in(f.partition("/")[2]) == text}
    rows, tried = df.filter(F.col(column) == value), []

    def write(base: Version | None) -> Change:
        if tried:
            raise ConcurrentWrite(f"the rows of {column}={text} at {path} were changed by another writer")
        tried.append(base)
        folder, names = versions.write_folder(rows, path, (column,))
        touched = frozenset({*before, *names})
        seen = {name: before.get(name) for name in touched}
        change = Change(folder, rows.schema, (column,), touched, names, seen)
        if not change.holds(base):
            delete_folder(spark, f"{path.rstrip('/')}/{folder}")
            raise ConcurrentWrite(f"the rows of {column}={text} at {path} were changed by another writer")
        return change

    return versions.commit(spark, path, write)


@dataclass(frozen=True)
class TableStore:
    """Tables in layers under one root folder, also reachable through SQL."""

    spark: SparkSession
    root: str

    def path(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    def exists(self, layer: str, name: str) -> bool:
        return self.version(layer, name) is not None or _plain(self.spark, self.path(layer, name)) is not None

    def version(self, layer: str, name: str) -> Version | None:
        """The current version of a table; None if it has none."""
        return versions.current(self.spark, self.path(layer, name))

    def read(
        self, layer: str, name: str, schema: StructType | None = None, version: int | None = None, **types: str
    ) -> DataFrame:
        """A table as it is now, or as it was in the version before that is named by its number.

        What has been read stays as it is while others publish, until the version after the next one. Columns missing in
        older files are NULL. A plain folder without ``schema`` is opened file by file to merge the schemas.
        ``types`` sets the type of partition columns where their folder names do not tell.
        """
        path = self.path(layer, name)
        at = versions.current(self.spark, path) if version is None else versions.version(self.spark, path, version)
        table = versions.read(self.spark, path, at, schema) if at else batches.read(self.spark, path, schema)
        return table.withColumns({c: F.col(c).cast(t) for c, t in types.items()}) if types else table

    def overwrite(self, df: DataFrame, layer: str, name: str, partition_by: Sequence[str] = ()) -> None:
        overwrite_table(df, self.path(layer, name), partition_by)

    def upsert(self, df: DataFrame, layer: str, name: str, **options) -> None:
        upsert_partitions(df, self.path(layer, name), **options)

    def replace_slice(self, df: DataFrame, layer: str, name: str, column: str, value) -> None:
        replace_slice(df, self.path(layer, name), column, value)

    def ensure_database(self, layer: str) -> None:
        self.spark.sql(
            f"CREATE DATABASE IF NOT EXISTS `{layer}` LOCATION '{self.root.rstrip('/')}/{layer}'"
        )

    def ensure_table(self, layer: str, name: str) -> None:
        """Enter the table's current version in the catalog, under the table's name.

        The name is a view of a table that stands for the version, with the folders of its partitions. Replacing the view is one
        step, so the name is always there and never half of a version, and its columns may change.
        """
        self.ensure_database(layer)
        path, at = self.path(layer, name), self.version(layer, name)
        listed = {t.name: t.tableType for t in self.spark.catalog.listTables(f"`{layer}`") if not t.isTemporary}
        # Tables of another root may have the same name.
        mark = f"_{crc32(path.encode()):08x}"
        own = f"{name}__v{at.number if at else 0}{mark}"
        if at is None:
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS `{layer}`.`{own}` USING parquet LOCATION '{path}'")
            if any(c.isPartition for c in self.spark.catalog.listColumns(f"`{layer}`.`{own}`")):
                self.spark.catalog.recoverPartitions(f"`{layer}`.`{own}`")
        elif own.lower() not in {n.lower() for n in listed}:
            self._enter(layer, own, path, at)
        if listed.get(name, "VIEW") != "VIEW":
            self.spark.sql(f"DROP TABLE `{layer}`.`{name}`")
        columns = ", ".join(f"`{c}`" for c in self.spark.table(f"`{layer}`.`{own}`").columns if not c.startswith(batches.BATCH))
        self.spark.sql(f"CREATE OR REPLACE VIEW `{layer}`.`{name}` AS SELECT {columns} FROM `{layer}`.`{own}`")
        for old in listed:
            number = old.removesuffix(mark).rpartition("__v")[2]
            if old.lower().startswith(f"{name}__v".lower()) and old.endswith(mark) and at and int(number) < at.number - 1:
                self.spark.sql(f"DROP TABLE IF EXISTS `{layer}`.`{old}`")

    def _enter(self, layer: str, own: str, path: str, at: Version) -> None:
        root, by = path.rstrip("/"), at.partition_by
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in at.schema.fields)
        parts = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in by)})" if by else ""
        where = root if by else f"{root}/{at.folders[0]}"
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS `{layer}`.`{own}` ({fields}) USING parquet {parts} LOCATION '{where}'")
        specs = []
        for folder in at.folders if by else ():
            values = [_value_in(part) for part in folder.split("/")[1:]]
            quoted = ["null" if v == _NO_VALUE else "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values]
            spec = ", ".join(f"`{c}` = {v}" for c, v in zip(by, quoted))
            specs.append(f"PARTITION ({spec}) LOCATION '{root}/{folder}'")
        if specs:
            self.spark.sql(f"ALTER TABLE `{layer}`.`{own}` ADD IF NOT EXISTS {' '.join(specs)}")

    def register_views(self, layer: str, names: Sequence[str]) -> None:
        """Make tables queryable with ``spark.sql`` under their own names, prefixed by the layer."""
        for name in names:
            self.read(layer, name).createOrReplaceTempView(f"{layer}_{name}")
