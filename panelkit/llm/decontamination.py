"""Benchmark passages in documents, by greedy string tiling.

Words of the benchmark are numbered; a document becomes the numbers of its words, 0 for all others. Where five
numbers in a row also stand in an item, that item is tiled with the document: the longest match of words
not yet used is marked first, then the next, down to five words. The share of the item that
tiles cover does not depend on the order in which its parts stand in the document.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import groupby
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

#: Words of the shortest tile, and the share of an item that has to be covered.
LEAST_WORDS, COVERAGE = 5, 0.8
#: Words of the shortest item that contaminates. One word alone is no sign of an item; its tiles are reported all the same.
TELLING_WORDS = 2
#: Bytes of benchmark text that are broadcast at once; a larger benchmark goes over the documents in blocks.
BLOCK_BYTES = 16 << 20

# Scripts written without spaces: Thai, Lao, Burmese, Khmer, Japanese kana, Chinese characters.
_BARE = (
    "\u0e01-\u0e4e\u0e81-\u0ece\u1000-\u103f\u1780-\u17d3\u3005-\u3007\u3041-\u3096\u309d-\u309f\u30a1-\u30fa\u30fc-\u30ff\u31f0-\u31ff"
    "\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
)
_UNSEGMENTED = re.compile(f"[{_BARE}]")
_WORD = re.compile(r"[^\W_]+")
_WORD_OR_CHARACTER = re.compile(rf"[{_BARE}]|(?:(?![{_BARE}])[^\W_])+")
_BASE = np.uint64(0x9E3779B97F4A7C15)  # any odd number


def words(text: str | None) -> list[str]:
    """Runs of letters and digits in lower case; of scripts without spaces, each character."""
    text = (text or "").lower()
    return (_WORD_OR_CHARACTER if _UNSEGMENTED.search(text) else _WORD).findall(text)


def rolling(values: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hash (modulo 2^64) of each run of ``size`` values, from running sums in one pass."""
    with np.errstate(over="ignore"):
        total = np.zeros(max(0, len(values) - size + 1), np.uint64)
        for k in range(size):
            total = total * _BASE + values[k : len(values) - size + 1 + k]
    return total


def running(values: list[int], size: int, free: list[bool]) -> Iterator[tuple[int, int]]:
    """Place and running Karp-Rabin hash of each run of ``size`` values that are all free."""
    mask, base = (1 << 64) - 1, int(_BASE)
    leaving = pow(base, size, 1 << 64)
    hashed = length = 0
    for i, value in enumerate(values):
        if not free[i] or not value:
            hashed = length = 0
            continue
        hashed, length = (hashed * base + value) & mask, length + 1
        if length > size:
            hashed = (hashed - values[i - size] * leaving) & mask
        if length >= size:
            yield i - size + 1, hashed


def tiles(item: list[int], text: list[int], least: int = LEAST_WORDS) -> list[tuple[int, int, int]]:
    """Greedy tiling: (place in item, place in text, length) of matches, longest first, none overlapping.

    A search length sets which matches are looked for; a longer match found moves it up, else it is halved until
    the least length has been done. 0 in ``text`` matches nothing. Of matches of equal length the
    first in the item, then in the text, is taken.
    """
    free_item, free_text = [True] * len(item), [True] * len(text)
    found, size = [], max(least, len(item) // 2)
    while True:
        places = defaultdict(list)
        for at, key in running(item, size, free_item):
            places[key].append(at)
        matches, longest = [], 0
        for b, key in running(text, size, free_text):
            for a in places.get(key, ()):
                length = 0
                while (
                    a + length < len(item) and b + length < len(text) and item[a + length] == text[b + length] and free_item[a + length] and free_text[b + length]
                ):
                    length += 1
                if length >= size:
                    matches.append((-length, a, b))
                    longest = max(longest, length)
        if longest > 2 * size:
            size = longest
            continue
        heapify(matches)
        while matches:
            length, a, b = heappop(matches)
            free = [x and y for x, y in zip(free_item[a : a - length], free_text[b : b - length])]
            if all(free):
                free_item[a : a - length] = free_text[b : b - length] = [False] * -length
                found.append((a, b, -length))
                continue
            # A longer tile has used a part: what is left of the match waits for its own turn.
            start = 0
            for is_free, part in groupby(free):
                size_of = len(list(part))
                if is_free and size_of >= size:
                    heappush(matches, (-size_of, a + start, b + start))
                start += size_of
        if size == least:
            return found
        size = max(least, size // 2)


def before(one: tuple, other: tuple) -> bool:
    """Whether an item's (coverage, id) goes before another's: the more covered, then the smaller id, NULL last."""
    if one[0] != other[0] or not one[0]:
        return one[0] > other[0]
    return one[1] is not None and (other[1] is None or one[1] < other[1])


class Benchmark:
    """Items of one block: their words as numbers and the places of their seeds."""

    def __init__(self, rows: list[tuple[Any, str]], least: int = LEAST_WORDS):
        self.least, self.numbers, self.items = least, {}, []
        self.short: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        seeds: dict[int, set[int]] = defaultdict(set)
        for item_id, text in rows:
            own = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words(text)]
            if len(own) >= least:
                for key in rolling(np.array(own, np.uint64), least).tolist():
                    seeds[key].add(len(self.items))
                self.items.append((item_id, own))
            elif own:  # shorter than a tile: one exact tile of its own length
                self.short[len(own)][int(rolling(np.array(own, np.uint64), len(own))[0])].append(len(self.items))
                self.items.append((item_id, own))
        self.short = {size: dict(keys) for size, keys in self.short.items()}
        self.seeds = dict(seeds)
        self.sorted_seeds = np.array(sorted(seeds), np.uint64)

    def look(self, text: str | None) -> tuple[Any, float, list[tuple[Any, int, int, int]]]:
        """The item covered best (then with the smallest id), its coverage and the tiles of all items found:
        (item, place in item, place in the document in words, length)."""
        known = self.numbers.get
        values = np.array([known(w, 0) for w in words(text)], np.uint64)
        found = self._short_tiles(values)
        best = (0.0, None)
        for item_id, _, _, length in found:
            if length >= TELLING_WORDS and before((1.0, item_id), best):
                best = (1.0, item_id)
        if len(values) < self.least or not len(self.sorted_seeds):
            return best[1], best[0], found
        keys = rolling(values, self.least)
        at = np.minimum(np.searchsorted(self.sorted_seeds, keys), len(self.sorted_seeds) - 1)
        hits = np.flatnonzero(self.sorted_seeds[at] == keys)
        if not len(hits):
            return best[1], best[0], found
        # Tiles lie in runs of known words; only runs with a seed matter, each followed by a 0.
        inside = np.concatenate(([False], values > 0, [False]))
        starts, ends = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(~inside[1:] & inside[:-1])
        runs = np.unique(np.searchsorted(starts, hits, "right") - 1)
        runs = runs[runs >= 0]
        places = np.concatenate(
            [np.arange(starts[r], ends[r] + 1) for r in runs.tolist()]
        ) if len(runs) else np.zeros(0, np.int64)
        near = np.append(values, np.uint64(0))[places].tolist()
        for number in sorted({n for h in hits.tolist() for n in self.seeds[int(keys[h])]}):
            item_id, item = self.items[number]
            own = tiles(item, near, self.least)
            share = sum(length for _, _, length in own) / len(item)
            if before((share, item_id), best):
                best = (share, item_id)
            found += [(item_id, a, int(places[b]), length) for a, b, length in own]
        return best[1], best[0], found

    def _short_tiles(self, values: np.ndarray) -> list[tuple[Any, int, int, int]]:
        """The first place of each item that is shorter than a tile."""
        found = []
        for size, items in self.short.items():
            keys = rolling(values, size)
            seen = set()
            for at in np.flatnonzero(np.isin(keys, np.fromiter(items, np.uint64, len(items)))).tolist():
                for number in items[int(keys[at])]:
                    item_id, item = self.items[number]
                    if number not in seen and values[at : at + size].tolist() == item:
                        seen.add(number)
                        found.append((item_id, 0, at, size))
        return found


def blocks(
    benchmark: DataFrame, id_column: str = "item_id", text_column: str = "text", least: int = LEAST_WORDS
) -> list[Broadcast]:
    """The benchmark as broadcast blocks of about ``BLOCK_BYTES`` of text each."""
    spark = benchmark.sparkSession
    rows = benchmark.select(
        F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text")
    ).dropna(subset=["text"])
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    many = size // BLOCK_BYTES + 1
    block = F.pmod(F.xxhash64("id", "text"), F.lit(many))
    return [
        spark.sparkContext.broadcast(
            Benchmark([tuple(r) for r in rows.filter(block == k).orderBy("id", "text").collect()], least)
        ) for k in range(many)
    ]


def contaminated(
    df: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", coverage: float = COVERAGE
) -> DataFrame:
    """One row per input row: id, ``contaminated``, ``item_id``, ``coverage``, ``tiles``.

    ``item_id`` is the benchmark item covered best (NULL if none has a tile), equal shares going to the
    smallest id and to an item with a NULL id last; it has the type that the benchmark gives it. A document is contaminated
    from ``coverage`` on, by items without an id too. NULL and empty texts are clean. Items of
    fewer than ``LEAST_WORDS`` words are found where all of their words stand in a row; those of fewer than
    ``TELLING_WORDS`` are among the ``tiles`` only, those without words (NULL text included) never found. Items that repeat
    count once each. Texts are read whole, however long. No row moves: the benchmark comes to the documents, block by block if it is large.
    """
    id_type, item_type = df.schema[id_column].dataType.simpleString(), benchmark.schema["item_id"].dataType
    item = item_type.simpleString()
    tile = f"array<struct<item_id: {item}, item_start: int, doc_start: int, length: int>>"
    arrow_item = to_arrow_type(item_type)
    arrow_tile = pa.struct([
        ("item_id", arrow_item), ("item_start", pa.int32()), ("doc_start", pa.int32()), ("length", pa.int32())
    ])
    rows = df.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    rows = rows.withColumns(
        {
            "item_id": F.lit(None).cast(item_type),
            "coverage": F.lit(0.0),
            "tiles": F.array().cast(tile),
        }
    )
    for block in blocks(benchmark):

        def look(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                item_ids, shares, tiled = (batch.column(k).to_pylist() for k in ("item_id", "coverage", "tiles"))
                for i, text in enumerate(batch.column("text")):
                    item_id, share, own = block.value.look(text.as_py())
                    if before((share, item_id), (shares[i], item_ids[i])):
                        item_ids[i], shares[i] = item_id, share
                    tiled[i] = tiled[i] + [dict(zip(("item_id", "item_start", "doc_start", "length"), t)) for t in own]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        batch.column(1),
                        pa.array(item_ids, arrow_item),
                        pa.array(shares, pa.float64()),
                        pa.array(tiled, pa.list_(arrow_tile))
                    ],
                    names=["id", "text", "item_id", "coverage", "tiles"],
                )

        rows = rows.mapInArrow(look, f"id {id_type}, text string, item_id {item}, coverage double, tiles {tile}")
    return rows.select(
        F.col("id").alias(id_column),
        (F.col("coverage") >= coverage).alias("contaminated"),
        "item_id",
        "coverage",
        "tiles"
    )


def decontaminated(
    df: DataFrame, benchmark: DataFrame, text_column: str = "text", coverage: float = COVERAGE
) -> DataFrame:
    """The rows, with all their columns (whatever their names), that are not contaminated by any item, as ``contaminated``
    tells. Rows stay as they are and where they are; an empty table stays empty."""
    at = df.columns.index(text_column)
    for block in blocks(benchmark):

        def keep(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(
                    pa.array([block.value.look(text.as_py())[1] < coverage for text in batch.column(at)], pa.bool_())
                )

        df = df.mapInArrow(keep, df.schema)
    return df
