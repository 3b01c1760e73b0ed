"""Removal of long byte strings that occur more than once, by suffix sorting.

Each window of ``WINDOW`` bytes names the piece of ``SEED`` bytes inside it whose hash is smallest (the leftmost
of equal ones): its seed. Equal windows have equal seeds at equal places, so windows are compared only
where seeds recur. Consecutive windows with one seed are kept together as a context: the bytes around the seed. All
contexts of a seed are sorted twice, by what follows and by what precedes the seed, in a mergesort that compares
by prefix hashes; two windows are equal if their contexts agree far enough on both sides.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import text_or_empty
from panelkit.sources.tables import checkpointed

WINDOW, SEED = 200, 50
#: Seeds that a window has to choose from, so also the most windows of a context.
CHOICE = WINDOW - SEED + 1
#: Contexts of one seed that are sorted in one task; windows of more frequent seeds are told apart by digests.
SORTED_TOGETHER = 2048
#: Contexts that a task sorts at a time, and windows of a text that it looks at together.
CONTEXTS, BLOCK = 8192, 1 << 20

_BASE = 0x9E3779B97F4A7C15  # any odd number has an inverse modulo 2^64
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _powers(base: int, n: int) -> np.ndarray:
    found, done = np.ones(n, np.uint64), 1
    while done < n:
        step = min(done, n - done)
        found[done : done + step] = found[:step] * np.uint64(pow(base, done, 1 << 64))
        done += step
    return found


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    n = BLOCK + 2 * WINDOW
    return _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)


def _scattered(x: np.ndarray) -> np.ndarray:
    """A one-to-one mixing, so that the order of hashes has nothing to do with the bytes."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _leftmost_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest of each ``width`` consecutive values, the leftmost of equal ones.

    Running minima from the left and the right of blocks of that width cover any stretch of it with one of each.
    """
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, _NONE)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    place = np.arange(blocks.size).reshape(blocks.shape)
    ahead = np.minimum.accumulate(blocks, axis=1)
    first = np.ones(blocks.shape, bool)
    first[:, 1:] = blocks[:, 1:] < ahead[:, :-1]
    ahead_at = np.maximum.accumulate(np.where(first, place, -1), axis=1).ravel()
    turned, turned_place = blocks[:, ::-1], place[:, ::-1]
    back = np.minimum.accumulate(turned, axis=1)
    # The further left an equal value, the smaller its place: keep the smallest place at the minimum.
    at_minimum = np.where(turned == back, turned_place, -1)
    newest = np.maximum.accumulate(np.where(at_minimum >= 0, np.arange(width), -1), axis=1)
    back_at = np.take_along_axis(turned_place, newest, axis=1)[:, ::-1].ravel()
    left, right = back_at[:n], ahead_at[width - 1 : width - 1 + n]
    return np.where(padded[left] <= padded[right], left, right)


def contexts_of(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Seed hash, first window, last window and place of the seed of each context of a text."""
    powers, inverse = _tables()
    found = []
    for begin in range(0, len(text) - WINDOW + 1, BLOCK):
        part = np.frombuffer(text, np.uint8, min(len(text) - begin, BLOCK + WINDOW - 1), begin)
        with np.errstate(over="ignore"):
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum((part.astype(np.uint64) + np.uint64(1)) * powers[: len(part)], out=sums[1:])
            seeds = _scattered((sums[SEED:] - sums[:-SEED]) * inverse[: len(part) - SEED + 1])
        at = _leftmost_minima(seeds, CHOICE)
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        last = np.append(first[1:], len(at)) - 1
        found.append((seeds[at[first]].view(np.int64), first + begin, last + begin, at[first] + begin))
    if not found:
        return (np.zeros(0, np.int64),) * 4
    return tuple(np.concatenate(x) for x in zip(*found))


def _common(prefix: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common beginning of rows ``a`` and ``b``: binary search for the longest equal prefix hash."""
    low, high = np.zeros(len(a), np.int64), np.full(len(a), prefix.shape[1] - 1)
    while (open_ := low < high).any():
        middle = (low + high + 1) >> 1
        same = prefix[a, middle] == prefix[b, middle]
        low, high = np.where(open_ & same, middle, low), np.where(open_ & ~same, middle - 1, high)
    return low


def suffix_sorted(symbols: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows by group, then by symbols, and what each has in common with the row before (-1: other group).

    A bottom-up mergesort in which all runs of a level are merged at once: a row's place is its rank in its own
    run plus that in the other, found by binary search with comparisons in logarithmic time over prefix hashes. At
    the end neighbours are compared byte by byte; where a hash had collided, the rows are sorted by their bytes.
    """
    n, width = symbols.shape
    with np.errstate(over="ignore"):
        prefix = np.zeros((n, width + 1), np.uint64)
        np.cumsum((symbols.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, width), axis=1, out=prefix[:, 1:])
    padded = np.concatenate([symbols, np.zeros((n, 1), symbols.dtype)], axis=1)

    def before(a: np.ndarray, b: np.ndarray, ties: np.ndarray) -> np.ndarray:
        at = _common(prefix, a, b)
        x, y = padded[a, at], padded[b, at]
        less = np.where(x == y, ties, x < y)
        return np.where(group[a] == group[b], less, group[a] < group[b])

    order, run = np.arange(n), 1
    while run < n:
        place = np.arange(n)
        number, inside = place // run, place % run
        other = (number ^ 1) * run
        size = np.clip(n - other, 0, run)
        low, high = np.zeros(n, np.int64), size.copy()
        first = number % 2 == 0
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_]) >> 1
            # Rows of the first run go before equal rows of the second.
            ahead = before(order[other[open_] + middle], order[open_], ~first[open_])
            low[open_[ahead]] = middle[ahead] + 1
            high[open_[~ahead]] = middle[~ahead]
        merged = np.empty(n, np.int64)
        merged[number // 2 * 2 * run + inside + low] = order
        order, run = merged, 2 * run
    common, sound = _verified(symbols, group, order)
    if not sound:
        order = np.lexsort([*symbols.T[::-1], group])
        common, _ = _verified(symbols, group, order)
    return order, common


def _verified(symbols: np.ndarray, group: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, bool]:
    """Common beginnings of neighbours by their bytes, and whether the order is right."""
    n, width = symbols.shape
    common = np.full(n, -1, np.int64)
    differs = symbols[order[1:]] != symbols[order[:-1]]
    at = np.where(differs.any(axis=1), differs.argmax(axis=1), width)
    same = group[order[1:]] == group[order[:-1]]
    common[1:] = np.where(same, at, -1)
    inside = np.minimum(at, width - 1)
    ascending = (at == width) | (symbols[order[:-1], inside] < symbols[order[1:], inside])
    return common, bool((~same | ascending).all() and (group[order[1:]] >= group[order[:-1]]).all())


def repeated_windows(contexts: list[bytes], seed_at: np.ndarray, group: np.ndarray) -> list[np.ndarray]:
    """For each context the places in it of windows that another context of its group has too.

    The contexts of a group differ. With its seed ``d`` bytes from its beginning, a window agrees with another if
    the contexts have ``d`` bytes before the seed and ``WINDOW - d`` from it on in common: if they are in the same
    stretch of both orders, where stretches end between neighbours with less in common.
    """
    n = len(contexts)
    length = np.fromiter(map(len, contexts), np.int64, n)
    after, ahead = np.zeros((n, WINDOW), np.uint16), np.zeros((n, CHOICE), np.uint16)
    for i, context in enumerate(contexts):
        values, at = np.frombuffer(context, np.uint8).astype(np.uint16) + 1, int(seed_at[i])
        after[i, : len(values) - at] = values[at : at + WINDOW]
        ahead[i, :at] = values[:at][::-1]
    stretches = []
    for symbols in (after, ahead):
        order, common = suffix_sorted(symbols, group)
        stretches.append((order, common))
    found: list[list[int]] = [[] for _ in range(n)]
    label = np.empty(n, np.int64)
    for d in range(CHOICE):
        start = seed_at - d
        has = np.flatnonzero((start >= 0) & (start + WINDOW <= length))
        if len(has) < 2:
            continue
        both = np.zeros(n, np.int64)
        for (order, common), least in zip(stretches, (WINDOW - d, d)):
            label[order] = np.cumsum(common < least)
            both = both * (n + 1) + label
        _, back, count = np.unique(both[has], return_inverse=True, return_counts=True)
        for i in has[count[back] > 1].tolist():
            found[i].append(int(start[i]))
    return [np.sort(np.array(x, np.int64)) for x in found]


def _covered(starts: np.ndarray) -> list[int]:
    """Begin, end, begin, end... of the bytes that windows with sorted starts cover."""
    cut = np.flatnonzero(np.diff(starts) > WINDOW)
    return np.stack(
        [starts[np.append(0, cut + 1)], starts[np.append(cut, len(starts) - 1)] + WINDOW], axis=1
    ).ravel().tolist()


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _compressed(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """id, hash and compressed text of each row, for joins that move texts."""
    id_type = df.schema[id_column].dataType.simpleString()

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor()
        for batch in batches:
            data = pa.array([packer.compress(t.as_py()) for t in batch.column("text")], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], data], names=["id", "text_hash", "data"])

    return _texts(df, id_column, text_column).mapInArrow(shrink, f"id {id_type}, text_hash long, data binary")


def _texts(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = text_or_empty(text_column)
    return df.select(
        F.col(id_column).alias("id"), F.xxhash64(text).alias("text_hash"), text.cast("binary").alias("text")
    )


def _same_row(left: DataFrame, right: DataFrame):
    return left["id"].eqNullSafe(right["id"]) & (left["text_hash"] == right["text_hash"])


def _contexts(df: DataFrame, id_type: str, seeds_only: bool) -> DataFrame:
    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [contexts_of(text.as_py())[0] for text in batch.column("text")]
            values, count = np.unique(np.concatenate(own), return_counts=True) if own else (np.zeros(0, np.int64),) * 2
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(count)], names=["seed", "n"])

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, parts, digests = [], [], []
            for i, text in enumerate(batch.column("text")):
                data = text.as_py()
                seed, first, last, at = contexts_of(data)
                parts.append((seed, first, last - first + WINDOW, at - first))
                row.append(np.full(len(seed), i))
                digests += [_digest(data[a : b + WINDOW]) for a, b in zip(first.tolist(), last.tolist())]
            if not row:
                continue
            where = pa.array(np.concatenate(row))
            columns = [pa.array(np.concatenate(x)) for x in zip(*parts)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(where),
                    batch.column("text_hash").take(where),
                    columns[0],
                    pa.array(digests, pa.binary()),
                    columns[1],
                    columns[2].cast(pa.int32()),
                    columns[3].cast(pa.int32())
                ],
                names=["id", "text_hash", "seed", "digest", "first", "size", "seed_at"],
            )

    if seeds_only:
        return df.mapInArrow(seeds, "seed long, n long")
    return df.mapInArrow(
        contexts, f"id {id_type}, text_hash long, seed long, digest binary, first long, size int, seed_at int"
    )


_FETCHED = pa.schema(
    [
        ("seed", pa.int64()),
        ("digest", pa.binary()),
        ("contexts", pa.int64()),
        ("seed_at", pa.int32()),
        ("context", pa.binary())
    ]
)
_COVERED = "seed long, digest binary, covered array<int>"


def _sorted_groups(contexts: DataFrame) -> DataFrame:
    """Covered bytes of contexts by suffix sorting, seed by seed, many seeds at a time."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def done(rows: list[tuple]) -> pa.RecordBatch:
            seeds = np.array([r[0] for r in rows], np.int64)
            windows = repeated_windows(
                [r[3] for r in rows],
                np.array([r[2] for r in rows], np.int64),
                np.cumsum(np.append(0, np.diff(seeds) != 0))
            )
            hit = [i for i, w in enumerate(windows) if len(w)]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(seeds[hit]),
                    pa.array([rows[i][1] for i in hit], pa.binary()),
                    pa.array([_covered(windows[i]) for i in hit], pa.list_(pa.int32()))
                ], names=["seed", "digest", "covered"]
            )

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("seed", "digest", "seed_at", "context"))):
                if len(held) >= CONTEXTS and held[-1][0] != row[0]:
                    yield done(held)
                    held = []
                held.append(row)
        if held:
            yield done(held)

    return contexts.repartition("seed").sortWithinPartitions("seed").mapInArrow(search, _COVERED)


def _digested_groups(contexts: DataFrame) -> DataFrame:
    """Covered bytes of contexts of very frequent seeds: windows by 128-bit digests, which combine before the shuffle."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, start, digests = [], [], []
            for i, data in enumerate(batch.column("context").to_pylist()):
                for at in range(len(data) - WINDOW + 1):
                    row.append(i)
                    start.append(at)
                    digests.append(_digest(data[at : at + WINDOW]))
            where = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("seed").take(where),
                    batch.column("digest").take(where),
                    pa.array(start, pa.int32()),
                    pa.array(digests, pa.binary())
                ],
                names=["seed", "digest", "start", "window"]
            )

    rows = contexts.select("seed", "digest", "context").mapInArrow(
        windows, "seed long, digest binary, start int, window binary"
    )
    shared = checkpointed(rows.groupBy("window").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("window"))
    starts = rows.join(shared, "window", "left_semi").groupBy("seed", "digest").agg(
        F.sort_array(F.collect_list("start")).alias("starts")
    )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            covered = [_covered(np.array(s, np.int64)) for s in batch.column("starts").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("seed"), batch.column("digest"), pa.array(covered, pa.list_(pa.int32()))],
                names=["seed", "digest", "covered"]
            )

    return starts.mapInArrow(merge, _COVERED)


def repeated_spans(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id``, ``text_hash`` and ``spans`` (begin, end, begin, end... in bytes, any order) of rows with repeated windows.

    What moves: a number per recurring-seed candidate, then contexts as digests and places, and texts
    (compressed) once, to fetch the bytes of one copy of each context whose seed has several. A context that
    occurs twice is repeated as a whole; it stands for all its copies when compared with the others.
    """
    id_type = df.schema[id_column].dataType.simpleString()
    texts = _texts(df, id_column, text_column)
    seeds = _contexts(texts, id_type, True).groupBy("seed").agg(F.sum("n").alias("n")).filter("n > 1").select("seed")
    found = checkpointed(_contexts(texts, id_type, False).join(checkpointed(seeds), "seed", "left_semi"))
    copy = F.struct("id", "text_hash", "first", "size", "seed_at")
    distinct = checkpointed(
        found.groupBy("seed", "digest").agg(F.count(F.lit(1)).alias("n"), F.min(copy).alias("copy"))
    )
    sizes = checkpointed(distinct.groupBy("seed").agg(F.count(F.lit(1)).alias("contexts")).filter("contexts > 1"))
    fetch = distinct.join(sizes, "seed").select("seed", "digest", "contexts", "copy.*")
    fetch = fetch.groupBy("id", "text_hash").agg(
        F.collect_list(F.struct("seed", "digest", "contexts", "first", "size", "seed_at")).alias("wanted")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            for data, wanted in zip(batch.column("data"), batch.column("wanted").to_pylist()):
                text = unpacker.decompress(data.as_py())
                yield pa.RecordBatch.from_pylist(
                    [{k: w[k] for k in ("seed", "digest", "contexts", "seed_at")} | {"context": text[w["first"] : w["first"] + w["size"]]} for w in wanted],
                    _FETCHED
                )

    packed = _compressed(df, id_column, text_column)
    fetched = packed.join(fetch, _same_row(packed, fetch)).select("data", "wanted")
    # Rows that repeat in id and text would fetch the same bytes again.
    contexts = fetched.mapInArrow(
        cut, "seed long, digest binary, contexts long, seed_at int, context binary"
    ).dropDuplicates(["seed", "digest"])
    contexts = checkpointed(contexts)
    some = _sorted_groups(contexts.filter(F.col("contexts") <= SORTED_TOGETHER))
    many = _digested_groups(contexts.filter(F.col("contexts") > SORTED_TOGETHER))
    whole = distinct.filter("n > 1").select("seed", "digest", F.array(F.lit(0), F.col("copy.size")).alias("covered"))
    covered = checkpointed(
        whole.unionByName(
            some.join(whole.select("seed", "digest"), ["seed", "digest"], "left_anti")
        ).unionByName(many.join(whole.select("seed", "digest"), ["seed", "digest"], "left_anti"))
    )
    placed = found.join(covered, ["seed", "digest"]).select(
        "id", "text_hash", F.transform("covered", lambda x: x + F.col("first")).alias("spans")
    )
    return placed.groupBy("id", "text_hash").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def merged(spans: list[int]) -> list[tuple[int, int]]:
    """Maximal spans, in order, of spans that may overlap or touch."""
    pairs = np.sort(np.array(spans, np.int64).reshape(-1, 2), axis=0)
    cut = np.flatnonzero(pairs[1:, 0] > pairs[:-1, 1])
    return list(zip(pairs[np.append(0, cut + 1), 0].tolist(), pairs[np.append(cut, len(pairs) - 1), 1].tolist()))


def without_repeats(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` (the bytes that stay).

    Removed is each byte of a ``WINDOW``-byte string that starts anywhere else too, in the same text or another,
    overlaps included, judged on the texts as they come. ``kept`` is binary, as cuts may fall inside a
    character. NULL text is empty. Rows that repeat are copies like any others, with NULL ids or the same id
    too. Texts shorter than ``WINDOW`` bytes stay as they are. An empty table gives no rows; other columns are not looked at.
    """
    id_type = df.schema[id_column].dataType.simpleString()
    spans = checkpointed(repeated_spans(df, id_column, text_column))
    packed = _compressed(df, id_column, text_column)
    joined = packed.join(spans, _same_row(packed, spans), "left").select(packed["id"], "data", "spans")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            sizes, removed, counts, kept = [], [], [], []
            for data, spans in zip(batch.column("data"), batch.column("spans").to_pylist()):
                text = unpacker.decompress(data.as_py())
                gone = merged(spans) if spans else []
                ends = [0, *(b for _, b in gone)]
                kept.append(b"".join([text[a:b] for a, b in zip(ends, [*(a for a, _ in gone), len(text)])]))
                sizes.append(len(text))
                removed.append(len(text) - len(kept[-1]))
                counts.append(len(gone))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    *(pa.array(x, pa.int64()) for x in (sizes, removed, counts)),
                    pa.array(kept, pa.binary())
                ],
                names=["id", "n_bytes", "n_removed", "n_spans", "kept"]
            )

    return joined.mapInArrow(
        remove, f"id {id_type}, n_bytes long, n_removed long, n_spans long, kept binary"
    ).withColumnRenamed("id", id_column)
