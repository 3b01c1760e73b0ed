"""Packing token pieces into sequences: dominance reduction, then best fit.

How full a sequence gets depends only on how many pieces there are of each length, so the packing is
found on those counts, at most one per length, whatever the number of documents. Pieces take their
places by their rank among the pieces of their length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm.word_ids import word_ids
from panelkit.sources.tables import checkpointed

#: Pieces of one length that are ranked in one window partition.
RANKED_TOGETHER = 250_000


def token_pieces(
    df: DataFrame, tokenizer: str, capacity: int, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per piece: id, ``piece``, ``start``, ``length``, ``ids_crc32``.

    A document is the ids of its text and the end id; only one longer than ``capacity`` is cut,
    into pieces of that length and a rest. NULL text is empty and gives one piece, the end id.
    """
    id_type = df.schema[id_column].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, width = word_ids(tokenizer), 4 * capacity
        for batch in batches:
            rows, piece, start, length, crc = [], [], [], [], []
            for row, text in enumerate(batch.column(1)):
                ids = memoryview(words.document(text.as_py()))
                for k in range(0, len(ids), width):
                    part = ids[k : k + width]
                    rows.append(row)
                    piece.append(k // width)
                    start.append(k // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32())]
                + [pa.array(x, pa.int64()) for x in (start, length, crc)],
                names=["id", "piece", "start", "length", "ids_crc32"],
            )

    pieces = df.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text")).mapInArrow(
        cut, f"id {id_type}, piece int, start long, length long, ids_crc32 long"
    )
    return pieces.withColumnRenamed("id", id_column)


def _dominating(left: np.ndarray, size: int, room: int) -> tuple[int, ...] | None:
    """The set of items to put with one of ``size`` that is at least as good as any other set, if one is known.

    A set is as good as another if the other's items can be swapped for parts of its own: then a
    packing with the other turns into one with this set that takes no more sequences.
    """
    left[size] -= 1
    try:
        sizes = np.flatnonzero(left[: room + 1])
        if not len(sizes):
            return ()
        largest = int(sizes[-1])
        if largest == room:
            return (largest,)
        smallest = np.repeat(sizes[:3], np.minimum(left[sizes[:3]], 3))[:3].cumsum()
        fit = int((smallest <= room).sum())
        if fit == 1:
            return (largest,)
        if fit == 3:
            return None
        # At most two items fit. y: the smaller of two; x: the largest to go with it.
        y = sizes[sizes <= room // 2]
        y = y[(left[y] > 1) | (np.searchsorted(sizes, room - y, "right") - 1 > np.searchsorted(sizes, y))]
        x = sizes[np.searchsorted(sizes, room - y, "right") - 1]
        if int((x + y).max()) <= largest:
            return (largest,)
        left[largest] -= 1
        rest = np.flatnonzero(left[: room - largest + 1])
        left[largest] += 1
        if len(rest) and rest[-1] >= y.max():
            return (largest, int(rest[-1]))
        return None
    finally:
        left[size] += 1


def reduce_by_dominance(counts: np.ndarray, capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], np.ndarray]:
    """Sequences that some best packing has, as (sizes, how many), and the counts of what is left.

    From the largest size down, one item and at most two others are fixed together where that set
    dominates all sets around the item. Passes go on until none fixes anything. A set stays
    dominating while copies of it last, so all of them are fixed at once.
    """
    left, fixed, before = counts.astype(np.int64), [], -1
    while before != len(fixed):
        before = len(fixed)
        for size in np.flatnonzero(left)[::-1].tolist():
            while left[size] and (others := _dominating(left, size, capacity - size)) is not None:
                needed = np.bincount((size, *others), minlength=len(left))
                used = np.flatnonzero(needed)
                times = int((left[used] // needed[used]).min())
                left[used] -= times * needed[used]
                fixed.append(((size, *others), times))
    return fixed, left


def best_fit(left: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit in decreasing order on counts: the same sequences as item by item.

    Sequences of the same content are kept together with their number. An item goes where the
    least room is left; there it leaves the least room again, so a sequence takes as many of a
    size as fit before the next one does.
    """
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    rooms: list[int] = []

    def put(room: int, content: tuple[int, ...], times: int) -> None:
        if times:
            if room not in open_:
                open_[room] = []
                rooms.insert(bisect_left(rooms, room), room)
            open_[room].append((content, times))

    for size in np.flatnonzero(left)[::-1].tolist():
        n = int(left[size])
        while n and (k := bisect_left(rooms, size)) < len(rooms):
            room = rooms.pop(k)
            groups, each = open_.pop(room), room // size
            for content, times in groups:
                full = min(times, n // each)
                n -= full * each
                some = n if full < times else 0
                n -= some
                put(room - each * size, content + (size,) * each, full)
                if some:
                    put(room - some * size, content + (size,) * some, 1)
                put(room, content, times - full - bool(some))
            if rooms[k : k + 1] == [room] and not n:
                break
        each = capacity // size
        put(capacity - each * size, (size,) * each, n // each)
        put(capacity - n % each * size, (size,) * (n % each), int(n % each > 0))
    return [group for groups in open_.values() for group in groups]


def plan_sequences(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    fixed, left = reduce_by_dominance(counts, capacity)
    return fixed + best_fit(left, capacity)


def _slots(plan: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows (size, first rank, sequence base, items of the size a sequence, offset), by size and rank."""
    base, taken, found = 0, {}, []
    for content, times in plan:
        offset = 0
        for size in sorted(set(content), reverse=True):
            each = content.count(size)
            found.append((size, taken.get(size, 0), base, each, offset))
            taken[size] = taken.get(size, 0) + times * each
            offset += size * each
        base += times
    return np.array(sorted(found), dtype=np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, capacity: int, *order: str) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``; ``order`` tells pieces of a length apart.

    ``length`` must be between 1 and ``capacity``. What goes to the driver is one count per length, at
    most ``capacity``; what goes back is a plan of the same order. A length of which there are many
    pieces (copies of a document, full pieces) is ranked in parts of about ``RANKED_TOGETHER``.
    """
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in pieces.groupBy("length").count().collect():
        if length is None or not 1 <= length <= capacity:
            raise ValueError(f"a piece of length {length} does not fit {capacity}")
        counts[length] = n
    slots = _slots(plan_sequences(counts, capacity))
    parts = int(counts.sum()) // RANKED_TOGETHER + 1
    ranked = pieces.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(parts)))
    sizes = ranked.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    number = F.row_number().over(Window.partitionBy("length", "_part").orderBy(*order))
    ranked = ranked.withColumn("_rank", number - 1).join(starts, ["length", "_part"])
    ranked = ranked.select(*pieces.columns, (F.col("_rank") + F.col("_before")).alias("_rank"))
    key = slots[:, 0] * (1 << 40) + slots[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
            at = np.searchsorted(key, length * (1 << 40) + rank, "right") - 1
            _, first, base, each, offset = slots[at].T
            nth = rank - first
            batch = batch.drop_columns(["_rank"])
            batch = batch.append_column("sequence_id", pa.array(base + nth // each))
            yield batch.append_column("offset", pa.array(offset + nth % each * length))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(place, f"{fields}, sequence_id long, offset long")


def packed_documents(
    df: DataFrame, tokenizer: str, capacity: int = 4096, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Documents cut into pieces and packed into as few sequences as this method finds.

    Rows repeated with the same id are packed once each. An empty table gives no rows; NULL ids
    are kept. Columns besides id and text are not looked at. The pieces (five numbers each, no
    text or ids) are written to the shared folder, as counts and ranks are taken from them.
    """
    pieces = checkpointed(token_pieces(df, tokenizer, capacity, id_column, text_column))
    return pack(pieces, capacity, id_column, "piece", "ids_crc32")
