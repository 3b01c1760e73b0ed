"""Ranked lexical search: items against all documents by dense blocked matrix products.

The items' terms are the only vocabulary. Documents are reduced once to their counts of those terms; tiles of items times
vocabulary (0 and 1) are then multiplied with tiles of vocabulary times documents (integer impacts) in float64. A tile
of the vocabulary is cut where the largest possible sum of impacts would reach 2^53, so each partial product is exact; the
partial sums are added as 64-bit integers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from panelkit.llm.common import text_or_empty
from panelkit.sources.tables import checkpointed, release

#: Documents that an item gets at most.
MOST = 50
#: Text of the items that are searched for in one pass over the documents, each counted with so many bytes besides.
ITEM_BYTES, ITEM_COST = 1 << 22, 256
#: Sides of the tiles.
ITEM_TILE, TERM_TILE, DOCUMENT_TILE = 256, 2048, 512
#: Candidates per item, on average, that a task holds before it sorts the best from them.
HELD = 200
#: Impacts are below this, whatever the counts.
FULL = 1_000_000
#: Shares of a task's results that are ranked by themselves first.
SHARES = 32

# Fixed table: ASCII letters in lower case, digits and all bytes beyond ASCII are parts of terms, the rest is space.
_PARTS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8: runs of letters and digits of ASCII and of all characters beyond."""
    return text.translate(_PARTS).split()


def weight(documents: int, having: int) -> int:
    """A term's weight: the rarer among the documents, the higher."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * having + 1)))


def impacts(counts: np.ndarray, weights: np.ndarray, lengths: np.ndarray, documents: int, total: int) -> np.ndarray:
    """What each count of a term adds to the score of its document, in 64-bit integers."""
    spread = 50 + 50 * lengths * documents // max(total, 1)
    return weights * (1_000_000_000 * counts // (1000 * counts + 20 * spread))


def _blocks(items: DataFrame, item_column: str, text_column: str) -> Iterator[tuple[list, dict[bytes, int], list]]:
    """Blocks of items: their ids, the vocabulary (numbers from 1) and the term numbers of each item.

    An item is in the block that its id is hashed to, and there are as many blocks as the text of all items asks for, so
    that the driver holds one block at a time.
    """
    texts = items.select(F.col(item_column).alias("id"), text_or_empty(text_column).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text") + F.lit(ITEM_COST))).first()[0] or 0
    blocks = -(-size // ITEM_BYTES)
    for block in range(blocks):
        own = texts.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block) if blocks > 1 else texts
        numbers: dict[bytes, int] = {}
        found: dict[object, set[int]] = {}
        for row in own.toLocalIterator():
            known = found.setdefault(row.id, set())
            known.update(numbers.setdefault(t, len(numbers) + 1) for t in terms(row.text.encode()))
        if numbers:
            yield list(found), numbers, [sorted(f) for f in found.values()]


def _counted(documents: DataFrame, id_column: str, text_column: str, numbers: dict[bytes, int]) -> DataFrame:
    """A row per document with terms: its id, ``n`` (all its terms) and the vocabulary's ``terms`` and ``counts`` in it."""
    id_type = documents.schema[id_column].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = numbers.get
        for batch in batches:
            rows, sizes, known, counts, ends = [], [], [], [], [0]
            for i, text in enumerate(batch.column("text").cast(pa.binary())):
                words = terms(text.as_py())
                if not words:
                    continue
                own, times = np.unique(np.array(list(filter(None, map(number, words))), np.int32), return_counts=True)
                rows.append(i)
                sizes.append(len(words))
                known.append(own)
                counts.append(times)
                ends.append(ends[-1] + len(own))
            if rows:
                places = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(pa.array(rows, pa.int64())), pa.array(sizes, pa.int64()),
                        pa.ListArray.from_arrays(places, pa.array(np.concatenate(known), pa.int32())),
                        pa.ListArray.from_arrays(places, pa.array(np.concatenate(counts), pa.int32())),
                    ],
                    names=["id", "n", "terms", "counts"],
                )

    return documents.select(F.col(id_column).alias("id"), text_or_empty(text_column).alias("text")).mapInArrow(
        count, f"id {id_type}, n long, terms array<int>, counts array<int>"
    )


def _term_tiles(bounds: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of the terms whose largest impacts add up to less than 2^53 and that fit a tile."""
    found, first, total = [], 0, 0
    for at, bound in enumerate(map(int, bounds)):
        if at > first and (total + bound >= 1 << 53 or at - first >= TERM_TILE):
            found.append((first, at))
            first, total = at, 0
        total += bound
    return [*found, (first, len(bounds))] if len(bounds) else []


class _Best:
    """The highest scores per item among the documents seen so far; equal scores by ascending id, NULL ids last."""

    def __init__(self, items: int, most: int, id_type: pa.DataType):
        self.most, self.least = most, np.ones(items, np.int64)
        self.items, self.scores = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        self.ids, self.held = [pa.array([], id_type)], 0

    def add(self, first: int, scores: np.ndarray, ids: pa.Array) -> None:
        """Scores of a tile of items, from the ``first`` on, and of the documents with these ids."""
        item, document = np.nonzero(scores >= self.least[first : first + len(scores), None])
        self.items.append(item + first)
        self.scores.append(scores[item, document])
        self.ids.append(ids.take(pa.array(document)))
        self.held += len(item)
        if self.held > HELD * len(self.least):
            self.sort()

    def sort(self) -> None:
        item, score = np.concatenate(self.items), np.concatenate(self.scores)
        ids = pa.concat_arrays(self.ids)
        rank = pc.rank(ids, "ascending", null_placement="at_end", tiebreaker="min").to_numpy()
        order = np.lexsort((rank, -score, item))
        item = item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        full = item[place == self.most - 1]
        self.least[full] = score[order][place == self.most - 1]
        kept = order[place < self.most]
        self.items, self.scores = [item[place < self.most]], [score[kept]]
        self.ids, self.held = [ids.take(pa.array(kept))], 0


def _scored(counted: DataFrame, item_ids: list, wanted: Sequence[Sequence[int]], weights: np.ndarray, documents: int,
            total: int, most: int, item_type) -> DataFrame:
    """Each task's highest scores per item: ``item_id``, ``id``, ``score``."""
    id_type = counted.schema["id"].dataType.simpleString()
    arrow_type = to_arrow_type(item_type)
    sizes = [len(w) for w in wanted]
    item_of, term_of = np.repeat(np.arange(len(wanted)), sizes), np.concatenate([np.array(w, np.int64) for w in wanted])

    def tile_scores(first: int, term: np.ndarray, column: np.ndarray, impact: np.ndarray, width: int) -> np.ndarray:
        """Scores of the items of a tile in a tile of documents."""
        here = (item_of >= first) & (item_of < first + ITEM_TILE)
        scores = np.zeros((min(ITEM_TILE, len(wanted) - first), width), np.int64)
        present = np.zeros(len(weights), bool)
        present[term] = True
        asked = np.unique(term_of[here & present[term_of]])
        place = np.full(len(weights), -1)
        place[asked] = np.arange(len(asked))
        at, own_item, own_term = place[term], item_of[here] - first, place[term_of[here]]
        for low, high in _term_tiles(weights[asked] * FULL):
            left = np.zeros((len(scores), high - low))
            inside = (own_term >= low) & (own_term < high)
            left[own_item[inside], own_term[inside] - low] = 1
            right = np.zeros((high - low, width))
            inside = (at >= low) & (at < high)
            right[at[inside] - low, column[inside]] = impact[inside]
            scores += (left @ right).astype(np.int64)
        return scores

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None
        for batch in batches:
            best = best or _Best(len(wanted), most, batch.schema.field("id").type)
            for start in range(0, len(batch), DOCUMENT_TILE):
                tile = batch.slice(start, DOCUMENT_TILE)
                known, width = tile.column("terms"), len(tile)
                column = np.repeat(np.arange(width), np.diff(known.offsets.to_numpy()))
                term = known.flatten().to_numpy().astype(np.int64)
                counts = tile.column("counts").flatten().to_numpy().astype(np.int64)
                impact = impacts(counts, weights[term], tile.column("n").to_numpy()[column], documents, total)
                for first in range(0, len(wanted), ITEM_TILE):
                    best.add(first, tile_scores(first, term, column, impact, width), tile.column("id"))
        if best is not None:
            best.sort()
            names = pa.array(item_ids, arrow_type).take(pa.array(best.items[0]))
            yield pa.RecordBatch.from_arrays([names, best.ids[0], pa.array(best.scores[0])], names=["item_id", "id", "score"])

    return counted.mapInArrow(score, f"item_id {item_type.simpleString()}, id {id_type}, score long")


def ranked(
    documents: DataFrame, items: DataFrame, most: int = MOST, id_column: str = "doc_id", text_column: str = "text",
    item_column: str = "item_id", item_text_column: str = "text",
) -> DataFrame:
    """The highest-scoring documents of each item: item id, ``rank`` from 1, document id, ``score`` above 0.

    An item's terms count once each. Equal scores rank by ascending document id, so the result does not depend on how
    documents are spread; each tile, task and share keeps its best by that order.

    NULL and empty texts have no terms: such documents are not counted, such items get no rows, nor do items whose
    terms no document has. Rows of ``items`` with the same id (or NULL) are one item with the terms of all of them. NULL document
    ids rank behind others of the same score, and documents with equal ids stay documents of their own. Very long texts are read
    whole; a document then is one count per term of the items. An empty table gives no rows. Other columns are not looked at.
    """
    spark = documents.sparkSession
    id_type, item_type = documents.schema[id_column].dataType, items.schema[item_column].dataType
    out = StructType([
        StructField(item_column, item_type), StructField("rank", IntegerType()), StructField(id_column, id_type),
        StructField("score", LongType()),
    ])
    result = None
    for item_ids, numbers, wanted in _blocks(items, item_column, item_text_column):
        counted = checkpointed(_counted(documents, id_column, text_column, numbers))
        n, total = counted.agg(F.count(F.lit(1)), F.sum("n")).first()
        weights = np.zeros(len(numbers) + 1, np.int64)
        for row in counted.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
            weights[row["term"]] = weight(n, row["count"])
        scored = checkpointed(_scored(counted, item_ids, wanted, weights, n, total or 0, most, item_type))
        release(counted)
        best = [F.col("score").desc(), F.col("id").asc_nulls_last()]
        share = F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(SHARES)).cast("int")
        first = Window.partitionBy("item_id", "share").orderBy(*best)
        few = scored.withColumn("share", share).withColumn("place", F.row_number().over(first)).filter(F.col("place") <= most)
        last = Window.partitionBy("item_id").orderBy(*best)
        found = few.withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= most)
        found = found.select(F.col("item_id").alias(item_column), "rank", F.col("id").alias(id_column), "score")
        result = found if result is None else result.unionByName(found)
    return spark.createDataFrame([], out) if result is None else result
