"""Reports on large partitioned tables, kept as one row per partition and renewed where partitions changed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.operators.partials import entity_pairs, partial_report
from panelkit.sources import versions
from panelkit.sources.tables import TableStore, checkpointed, release

LAYER, FOLDER = "reports", "_folder"


def _folder(part: str, folders: Sequence[str]) -> Column:
    """The folder of the partition that a row is in."""
    value = F.coalesce(F.col(part).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))
    known = F.create_map(*[F.lit(x) for f in folders for x in (f.rpartition("=")[2], f)])
    return known[value]


def refresh_partials(
    store: TableStore, layer: str, name: str, columns: Sequence[str], entity: str | None = None, period: str | None = None,
    means: Sequence[str] = (), exact: bool = False,
) -> tuple[DataFrame, DataFrame | None]:
    """The partial reports of a table that is partitioned by one column of plain values, and its entities' pairs if ``exact``.

    Partitions are told apart by the folder that the table's version names, which is another one after each change of their
    rows. So what is kept shows by itself what has to be made again, and what is gone.
    """
    at = store.version(layer, name)
    if at is None or len(at.partition_by) != 1:
        raise ValueError(f"{layer}.{name} has no versions partitioned by one column")
    part, own, path = at.partition_by[0], f"{layer}_{name}_partials", store.path(layer, name)
    kept = store.read(LAYER, own) if store.exists(LAYER, own) else None
    known = {r[0] for r in kept.select(FOLDER).collect()} if kept is not None else set()
    changed = [f for f in at.folders if f not in known]
    if changed or known - set(at.folders):
        rows = versions.read(store.spark, path, at, names=[f.partition("/")[2] for f in changed])
        if changed:
            fresh = partial_report(rows, part, columns, entity, period, means).withColumn(FOLDER, _folder(part, changed))
        else:
            fresh = kept.limit(0)
        if kept is not None:
            fresh = fresh.unionByName(kept.filter(F.col(FOLDER).isin(*at.folders)), allowMissingColumns=True)
        fresh = checkpointed(fresh)
        if exact and changed:
            pairs = entity_pairs(rows, part, entity).withColumn(FOLDER, _folder(part, changed))
            store.upsert(pairs, LAYER, f"{own}_entities", partition=part, mode="replace")
        # Last, as it tells what has been made.
        store.overwrite(fresh, LAYER, own)
        release(fresh)
    if not exact:
        return store.read(LAYER, own), None
    pairs = store.read(LAYER, f"{own}_entities").filter(F.col(FOLDER).isin(*at.folders))
    return store.read(LAYER, own), pairs
