"""Near-duplicates by SimHash fingerprints, found with BK-trees.

``near_duplicates`` links fingerprints of the contract's width and radius. ``without_near_duplicates`` has settings of its
own: wide fingerprints over five-word shingles propose pairs, and the exact similarity of the shingle sets decides.
"""

from __future__ import annotations

import math
import random
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import text_or_empty
from panelkit.llm.components import components
from panelkit.sources.tables import checkpointed

#: Fixed by the contract: words in a shingle, seed of the hash, bits that may differ.
SHINGLE, SEED, RADIUS = 4, 42, 4
#: Fingerprints that share a bucket by chance, at most about; keys get longer with more fingerprints to keep it so.
BY_CHANCE = 4
#: Fingerprints in one tree.
TREE = 4096
#: Removing near-duplicates: words in a shingle, and the least Jaccard similarity of the shingle sets.
SET_SHINGLE, SIMILARITY = 5, 0.8
#: Bits of the wide fingerprint, in 64-bit fingerprints of different hashes, and bits that candidates may differ in:
#: at the least similarity 39 of 256 are expected to (48 in texts of a few shingles), with a deviation of 6.
WIDE, WIDE_RADIUS = 4, 64
#: Wide fingerprints that share a bucket by chance, at most about, and the share of pairs at the least similarity that
#: may meet in no bucket.
WIDE_BY_CHANCE, MISSED = 16, 0.005


def fingerprint(text: bytes) -> int:
    """The 64-bit SimHash of a text in UTF-8, as an unsigned number; 0 without words.

    ``bytes.lower`` and ``bytes.split`` know ASCII only: A-Z are lowered, words end at the six ASCII
    white space characters.
    """
    words = text.lower().split()
    if not words:
        return 0
    size = min(SHINGLE, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)[: len(words) - size + 1]
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[size - 1 :].tolist())]
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return int(np.packbits(2 * bits.sum(axis=0) > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Id, ``text_hash`` (64 bits that with the id tell rows apart) and ``fingerprint`` (its 64 bits as a long) of each
    row; NULL text is empty."""
    id_type = df.schema[id_column].dataType.simpleString()
    text = text_or_empty(text_column)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(text.as_py()) for text in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(np.array(found, np.uint64).view(np.int64))],
                names=["id", "text_hash", "fingerprint"]
            )

    return (
        df.select(F.col(id_column).alias("id"), F.xxhash64(text).alias("text_hash"), text.cast("binary").alias("text"))
        .mapInArrow(each, f"id {id_type}, text_hash long, fingerprint long")
        .withColumnRenamed("id", id_column)
    )


class BKTree:
    """Numbers by Hamming distance: a child hangs on the edge of its distance to the parent."""

    def __init__(self) -> None:
        self._root: tuple[int, dict] | None = None

    def add(self, value: int) -> None:
        if self._root is None:
            self._root = (value, {})
            return
        node, edges = self._root
        while (distance := (node ^ value).bit_count()) in edges:
            node, edges = edges[distance]
        edges[distance] = (value, {})

    def near(self, value: int, radius: int) -> Iterator[int]:
        """All numbers within the radius; by the triangle inequality only edges that close can lead there."""
        stack = [self._root] if self._root else []
        while stack:
            node, edges = stack.pop()
            distance = (node ^ value).bit_count()
            if distance <= radius:
                yield node
            if edges:
                low, high = distance - radius, distance + radius
                stack += [child for edge, child in edges.items() if low <= edge <= high]


def tree_links(own: Iterable[int], others: Iterable[int] | None, radius: int) -> list[tuple[int, int]]:
    """Links that connect what is connected within the radius: among ``own``, or between it and ``others``.

    At most one link per number: pairs that others connect already are left out.
    """
    tree, parent, links = BKTree(), {}, []

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    def query(value: int) -> None:
        for near in tree.near(value, radius):
            a, b = root(near), root(value)
            if a != b:
                parent[b] = a
                links.append((near, value))

    for value in own:
        if others is None:
            query(value)
        tree.add(value)
    for value in others or ():
        query(value)
    return links


def near_links(values: DataFrame, column: str = "fingerprint", radius: int = RADIUS, blocks: int | None = None) -> DataFrame:
    """Links ``a``-``b`` between distinct 64-bit numbers that differ in 1 to ``radius`` bits.

    Links join exactly what chains of such pairs join; not each pair is listed. Numbers within the
    radius agree in ``blocks - radius`` blocks of bits, so each choice of blocks makes a bucket key and every
    pair meets in a bucket. More blocks make longer keys and smaller buckets, for more copies of each
    number; the result is the same, so by default their number follows that of the values (six blocks
    and 15 keys up to eight million, seven and 35 up to half a billion, ...). A bucket of more than ``TREE`` numbers is cut into shards, and
    each shard's tree is asked by its own shard and by the later ones, in tasks of their own.
    """
    if blocks is None:
        blocks, many = radius + 2, values.count()
        while many > BY_CHANCE << 64 * (blocks - radius) // blocks:
            blocks += 1
    edge = [64 * i // blocks for i in range(blocks + 1)]
    masks = [
        sum(
            ((1 << edge[i + 1]) - (1 << edge[i])) for i in chosen
        ) for chosen in combinations(range(blocks), blocks - radius)
    ]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = F.explode(
        F.array(
            *[
                F.struct(F.lit(i).alias("mask"), F.col(column).bitwiseAND(F.lit(m)).alias("key")) for i,
                m in enumerate(signed)
            ]
        )
    )
    rows = values.select(F.col(column).alias("value"), keys.alias("_k")).select("value", "_k.mask", "_k.key")
    sizes = rows.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    sizes = checkpointed(sizes.select("mask", "key", F.ceil(F.col("n") / TREE).cast("int").alias("shards")))
    own = F.pmod(F.xxhash64("value"), F.col("shards")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("shards") - 1),
        lambda s: F.struct(F.least(s, F.col("own")).alias("tree"), F.greatest(s, F.col("own")).alias("asks")),
    )
    rows = rows.join(sizes, ["mask", "key"]).withColumn("own", own).withColumn("_p", F.explode(pairs))
    rows = rows.select("mask", "key", "_p.tree", "_p.asks", "own", "value")
    group = ["mask", "key", "tree", "asks"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, own, value in _groups(batches, group, ["own", "value"]):
            first = [v for o, v in zip(own, value) if o == key[2]]
            second = None if key[2] == key[3] else [v for o, v in zip(own, value) if o == key[3]]
            if links := tree_links(first, second, radius):
                both = np.array(links, np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])

    return rows.repartition(*group).sortWithinPartitions(*group, "value").mapInArrow(search, "a long, b long").distinct()


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str], values: list[str]) -> Iterator[tuple]:
    """Groups of rows that lie together, over the bounds of batches: key, then a list per value column (unsigned)."""
    key, held = None, [[] for _ in values]
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in keys]
        changes = np.zeros(batch.num_rows, bool)
        changes[0] = True
        for column in columns:
            changes[1:] |= column[1:] != column[:-1]
        starts = np.flatnonzero(changes).tolist()
        data = [batch.column(v).to_numpy().astype(np.int64).view(np.uint64) for v in values]
        for start, end in zip(starts, starts[1:] + [batch.num_rows]):
            this = tuple(int(c[start]) for c in columns)
            if this != key:
                if key is not None:
                    yield key, *held
                key, held = this, [[] for _ in values]
            for kept, column in zip(held, data):
                kept += column[start:end].tolist()
    if key is not None:
        yield key, *held


def near_duplicates(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: id, ``text_hash``, ``fingerprint`` (16 hex digits), ``component_id``.

    Fingerprints link if at most ``RADIUS`` bits differ; the component is named by the smallest id that
    is reachable over links. Trees see distinct fingerprints only, so copies cost nothing there. Texts
    without words (NULL among them) share fingerprint zero. NULL ids name no component unless it has no
    others; repeated ids keep a row each. An empty table gives no rows; other columns are not looked at.
    """
    rows = checkpointed(fingerprints(df, id_column, text_column))
    values = checkpointed(rows.groupBy("fingerprint").agg(F.min(id_column).alias("_first")))
    found = checkpointed(components(near_links(values)))
    rooted = values.join(found.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    rooted = checkpointed(rooted.select("fingerprint", "_first", F.coalesce("root", "fingerprint").alias("root")))
    named = rooted.groupBy("root").agg(F.min("_first").alias("component_id"))
    named = checkpointed(rooted.join(named, "root").select("fingerprint", "component_id"))
    joined = rows.join(named, "fingerprint")
    return joined.select(
        id_column, "text_hash", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def shingle_set(text: bytes, size: int = SET_SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; a text of fewer words is one shingle, one without words has none."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    size = min(size, len(words))
    digest = xxhash.xxh3_64_intdigest
    joined = [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)]
    return np.unique(np.fromiter(map(digest, joined), np.uint64, len(joined)))


def wide_fingerprint(hashes: np.ndarray) -> bytes:
    """SimHash of ``WIDE`` times 64 bits of a shingle set: each shingle's hash is mixed anew for each 64 of them."""
    total = np.zeros(64 * WIDE, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)]
        mixed = np.empty((len(part), WIDE), "<u8")
        with np.errstate(over="ignore"):
            for k in range(WIDE):  # splitmix64
                z = part + np.uint64((k + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
                z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
                z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
                mixed[:, k] = z ^ (z >> np.uint64(31))
        total += np.unpackbits(mixed.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * total > len(hashes), bitorder="little").tobytes()


def _set_name(hashes: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(hashes.tobytes())).astype(np.int64))


def leader_pairs(values: list[tuple[int, int]], radius: int) -> list[tuple[int, int, bool]]:
    """Pairs of nodes whose fingerprints are near, for a bucket of (node, fingerprint): all but those of two followers.

    A node near a leader follows it, any other leads. A group of near copies costs a pair per follower, not
    the square of its size; the third value says that the second node follows.
    """
    leaders, followers = BKTree(), BKTree()
    leading, following, pairs = {}, defaultdict(list), []
    for node, value in values:
        near = [leading[v] for v in leaders.near(value, radius)]
        if near:
            if value not in following:
                followers.add(value)
            following[value].append(node)
            pairs += [(n, node, True) for n in near]
        else:
            pairs += [(n, node, False) for v in followers.near(value, radius) for n in following[v]]
            leaders.add(value)
            leading[value] = node
    return pairs


def cross_pairs(values: list[tuple[int, int, int]], radius: int) -> list[tuple[int, int, bool]]:
    """All pairs of near nodes with different roots, for a bucket of (node, fingerprint, root)."""
    groups = defaultdict(list)
    for node, value, root in values:
        groups[root].append((node, value))
    tree, nodes, pairs = BKTree(), defaultdict(list), []
    if len(groups) < 2:
        return pairs
    for k, group in enumerate(sorted(groups.values(), key=len, reverse=True)):
        if k:
            pairs += [(n, node, False) for node, value in group for v in tree.near(value, radius) for n in nodes[v]]
        for node, value in group:
            if value not in nodes:
                tree.add(value)
            nodes[value].append(node)
    return pairs


def bucket_keys(values: int) -> list[list[int]]:
    """Places of the bits of each bucket key: as many as keep chance buckets small for so many fingerprints, and as
    many keys as let all but ``MISSED`` of the pairs at the least similarity meet in one."""
    bits = max(8, math.ceil(math.log2(max(2, values) / WIDE_BY_CHANCE)))
    same = (1 - math.acos(2 * SIMILARITY / (1 + SIMILARITY)) / math.pi) ** bits
    rng = random.Random(SEED)
    return [rng.sample(range(64 * WIDE), bits) for _ in range(math.ceil(math.log(MISSED) / math.log(1 - same)))]


def _bucket_pairs(values: DataFrame, places: list[list[int]], across: bool) -> DataFrame:
    """Candidates ``a``-``b`` with ``follows``, from ``node``, ``print`` (and ``root`` for pairs across roots only)."""
    powers = [1 << i for i in range(len(places[0]))]

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = np.frombuffer(b"".join(batch.column("print").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            bits = np.unpackbits(raw, axis=1, bitorder="little").astype(np.int64)
            for k, chosen in enumerate(places):
                key = pa.array(bits[:, chosen] @ np.array(powers, np.int64))
                number = pa.array(np.full(batch.num_rows, k, np.int32))
                yield pa.RecordBatch.from_arrays([number, key, *batch.columns], names=["k", "key", "node", "print", "root"])

    rows = values.select("node", "print", "root" if across else F.lit(0).cast("long").alias("root"))
    rows = rows.mapInArrow(keyed, "k int, key long, node long, print binary, root long")
    large = rows.groupBy("k", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > TREE)
    large = checkpointed(large.select("k", "key", F.ceil(F.col("n") / TREE).cast("int").alias("shards")))
    shards = F.coalesce("shards", F.lit(1))
    own = F.pmod(F.xxhash64("node"), F.col("shards")).cast("int")
    # Shards meet in twos, each pair of them in a task of its own.
    twos = F.transform(
        F.sequence(F.lit(0), F.col("shards") - 1),
        lambda s: F.struct(F.least(s, F.col("own")).alias("low"), F.greatest(s, F.col("own")).alias("high")),
    )
    rows = rows.join(large, ["k", "key"], "left").withColumn("shards", shards).withColumn("own", own)
    rows = rows.withColumn("_t", F.explode(twos)).select("k", "key", "_t.low", "_t.high", "node", "print", "root")
    group = ["k", "key", "low", "high"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(held: list) -> list[tuple[int, int, bool]]:
            if len(held) < 2:
                return []
            if across:
                return cross_pairs(held, WIDE_RADIUS)
            return leader_pairs([h[:2] for h in held], WIDE_RADIUS)

        def batch_of(pairs: list) -> pa.RecordBatch:
            a, b, follows = zip(*pairs)
            arrays = [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(follows, pa.bool_())]
            return pa.RecordBatch.from_arrays(arrays, names=["a", "b", "follows"])

        key, held, pairs = None, [], []
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in group))
            for this, node, value, root in zip(keys, *(batch.column(c).to_pylist() for c in ("node", "print", "root"))):
                if this != key:
                    pairs += found(held)
                    key, held = this, []
                held.append((node, int.from_bytes(value, "little"), root))
            if len(pairs) > 10_000:
                yield batch_of(pairs)
                pairs = []
        if pairs := pairs + found(held):
            yield batch_of(pairs)

    made = rows.repartition(*group).sortWithinPartitions(*group, "node").mapInArrow(search, "a long, b long, follows boolean")
    made = made.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.col("follows"))
    return made.distinct()


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a``-``b`` whose shingle sets (``node``, ``shingles``) have a Jaccard similarity of ``SIMILARITY``."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("left"), batch.column("right")):
                x, y = (np.frombuffer(v.as_py(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= SIMILARITY * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b").join(left.hint("merge"), "a").join(right.hint("merge"), "b").select(
        "a", "b", "left", "right"
    ).mapInArrow(confirm, "a long, b long")


def similar_links(df: DataFrame, prints: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Links between shingle sets (named by their hash) of at least ``SIMILARITY``; they join what chains of such pairs
    join, of all pairs that meet in a bucket. ``prints`` has ``node``, ``print``, ``id`` and ``text_hash`` of the rows."""
    values = checkpointed(
        prints.groupBy("node").agg(
            F.first("print").alias("print"), F.min(F.struct("id", "text_hash")).alias("row")
        )
    )
    places = bucket_keys(values.count())
    marked = checkpointed(_bucket_pairs(values, places, False))
    pairs = checkpointed(marked.select("a", "b").distinct())
    # Texts of the sets in pairs only; the ids have no bound, so they are not broadcast.
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = checkpointed(values.join(nodes, "node").select("node", "row.id", "row.text_hash"))
    text = text_or_empty(text_column)
    texts = df.select(F.col(id_column).alias("id"), F.xxhash64(text).alias("text_hash"), text.cast("binary").alias("text"))
    same = texts["id"].eqNullSafe(wanted["id"]) & (texts["text_hash"] == wanted["text_hash"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py()).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.binary())], names=["node", "shingles"])

    sets = texts.join(wanted.hint("merge"), same).select("node", "text").mapInArrow(read, "node long, shingles binary")
    sets = checkpointed(sets.dropDuplicates(["node"]))
    links = checkpointed(_similar(pairs, sets))
    # Two followers have not been compared; where their links do not join them, they are now.
    roots = checkpointed(components(links))
    followers = checkpointed(marked.filter("follows").select(F.explode(F.array("a", "b")).alias("node")).distinct())
    again = values.join(followers, "node").join(roots, "node", "left")
    again = again.select("node", "print", F.coalesce("root", "node").alias("root"))
    more = _bucket_pairs(checkpointed(again), places, True).select("a", "b").distinct().join(pairs, ["a", "b"], "left_anti")
    return links.union(checkpointed(_similar(checkpointed(more), sets)))


def without_near_duplicates(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of the smallest id of each group of near-duplicates; all columns stay. Rows with NULL id stay only alone.

    Near-duplicates share at least ``SIMILARITY`` of their ``SET_SHINGLE``-word shingles (Jaccard, computed exactly), or
    a chain of such texts joins them. Texts without words (NULL among them) are copies of each other. Candidates are
    pairs of wide SimHash fingerprints within ``WIDE_RADIUS`` bits that meet in a bucket; ``MISSED`` sets how many
    pairs at the least similarity may not meet.

    The rows that go are the fewer, so they are what the texts are joined with. Their number has no bound, so
    they are never broadcast: the join is a sort-merge join at any size, which adaptive execution can split.
    """
    id_type = df.schema[id_column].dataType.simpleString()
    text = text_or_empty(text_column)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, made = [], []
            for text in batch.column(2):
                hashes = shingle_set(text.as_py())
                nodes.append(_set_name(hashes))
                made.append(wide_fingerprint(hashes))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(nodes, pa.int64()), pa.array(made, pa.binary())],
                names=["id", "text_hash", "node", "print"]
            )

    prints = df.select(
        F.col(id_column).alias("id"), F.xxhash64(text).alias("text_hash"), text.cast("binary").alias("text")
    ).mapInArrow(each, f"id {id_type}, text_hash long, node long, print binary")
    prints = checkpointed(prints)
    found = checkpointed(components(similar_links(df, prints, id_column, text_column)))
    firsts = prints.groupBy("node").agg(F.min("id").alias("first")).join(found, "node", "left")
    firsts = checkpointed(firsts.select("node", "first", F.coalesce("root", "node").alias("root")))
    named = firsts.groupBy("root").agg(F.min("first").alias("kept"))
    named = checkpointed(firsts.join(named, "root").select("node", "kept"))
    gone = prints.join(named, "node").filter(~F.col("id").eqNullSafe(F.col("kept"))).select("id", "text_hash").distinct()
    gone = checkpointed(gone)
    same = df[id_column].eqNullSafe(gone["id"]) & (
        F.xxhash64(F.coalesce(df[text_column].cast("string"), F.lit(""))) == gone["text_hash"]
    )
    return df.join(gone.hint("merge"), same, "left_anti")
