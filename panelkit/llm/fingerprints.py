"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests, by DataFrame functions only.

A sketch has three rows of cells. A digest goes into one cell of each; a cell holds how many digests came, and the exclusive or of
them and of their check values. Subtracting the sketches of two versions leaves the digests in which they differ. A cell with
just one is peeled: its digest is known, and is taken out of its other cells, which may make these peelable. If digests are left
in the end, the sketch was too small: it is made again larger, as many small sketches (blocks), each for the digests with the same leading
bits, and again with more blocks for the digests of those blocks that fail. So the work is in proportion to the number of digests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm.common import text_or_empty
from panelkit.sources.tables import checkpointed

#: Rows of a sketch and cells in a row (a power of two), the same for fingerprints and blocks.
ROWS, CELLS = 3, 4
#: Digests per block that a larger sketch is made for, and how many times as many blocks the next one has.
LOAD, LARGER = 3, 16
#: Characters from which on a paragraph of one line ends with a sentence.
LINE = 200
#: Documents and characters that a part of the order holds at most, about.
PART_ROWS, PART_CHARS = 1 << 18, 1 << 25
#: Parts per shuffle partition at least, so that those that get more parts than others do not get many more.
PARTS_EACH = 4

# Digests have 62 bits, in bits 1 to 62 of a long; the lowest bit is set for those of the version that is subtracted.
_DIGEST, _TOP = 0x7FFFFFFFFFFFFFFE, 63


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def paragraphs(text: Column) -> Column:
    """The paragraphs of a text: its lines, long ones cut where a sentence ends after ``LINE`` characters."""
    found = F.regexp_extract_all(text, F.lit(rf"[^\n]{{{LINE},}}?[.!?。！？]+(?=\s)|[^\n]+"), F.lit(0))
    return F.filter(found, lambda p: p.rlike(r"\S"))


def digests(text: Column) -> Column:
    """The digests of a text's paragraphs, in ascending order; the second and later times that one occurs have their own."""
    each = F.sort_array(F.transform(paragraphs(text), lambda p: F.xxhash64(p)))

    def numbered(found: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(found) - 1), lambda i: (i == 0) | (found[i] != found[F.greatest(i - 1, F.lit(0))])
        )
        return _let(starts, lambda at: F.flatten(F.transform(at, lambda start, k: F.transform(
            F.sequence(F.lit(0), F.when(k + 1 < F.size(at), at[F.least(k + 1, F.size(at) - 1)]).otherwise(F.size(found)) - start - 1),
            lambda again: F.xxhash64(found[start], again).bitwiseAND(F.lit(_DIGEST)),
        ))))

    made = _let(each, lambda found: F.when(F.size(found) > 0, numbered(found)))
    return F.coalesce(F.sort_array(F.array_distinct(made)), F.array().cast("array<long>"))


def _check(digest: Column) -> Column:
    """A value by which a cell with one digest is told from a cell in which several happen to look like one."""
    return F.xxhash64(digest).bitwiseAND(F.lit(0xFFFFFFFF))


def _is_in(digest: Column, cell: Column) -> Column:
    """Whether a digest belongs in a cell, by its number: two of the lowest bits name the one in each row."""
    bits = CELLS.bit_length() - 1
    row = F.call_function("shiftright", cell, F.lit(bits))
    own = F.call_function("shiftright", digest, row * F.lit(bits) + F.lit(1))
    return own.bitwiseAND(F.lit(CELLS - 1)) == cell.bitwiseAND(F.lit(CELLS - 1))


def _with(cells: Column, found: Column, times: int) -> Column:
    """The cells after each of the signed digests went in (``times`` 1) or out (-1)."""

    def put(cell: Column, d: Column) -> Column:
        plain = d.bitwiseAND(F.lit(_DIGEST))
        return F.struct(
            (cell["n"] + F.when(d.bitwiseAND(F.lit(1)) == 0, times).otherwise(-times)).alias("n"),
            cell["key"].bitwiseXOR(plain).alias("key"), cell["check"].bitwiseXOR(_check(plain)).alias("check"),
        )

    return F.transform(
        cells, lambda cell, i: F.aggregate(found, cell, lambda a, d: F.when(_is_in(d, i), put(a, d)).otherwise(a))
    )


def sketch(found: Column) -> Column:
    """The cells (structs of ``n``, ``key``, ``check``) of signed digests."""
    empty = F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("key"), F.lit(0).cast("long").alias("check"))
    return _with(F.array_repeat(empty, ROWS * CELLS), found, 1)


def subtracted(cells: Column, other: Column) -> Column:
    """The sketch of the digests in which two versions differ."""
    return F.zip_with(cells, other, lambda a, b: F.struct(
        (a["n"] - b["n"]).alias("n"), a["key"].bitwiseXOR(b["key"]).alias("key"), a["check"].bitwiseXOR(b["check"]).alias("check")
    ))


def peeled(cells: Column) -> Column:
    """What peeling gives: ``plus`` and ``minus``, the number of digests on either side, and ``done`` if nothing is left."""

    def alone(left: Column) -> Column:
        """The signed digests of the cells that hold one."""
        one = F.filter(left, lambda c: (F.abs(c["n"]) == 1) & (_check(c["key"]) == c["check"]))
        return F.array_distinct(F.transform(one, lambda c: c["key"].bitwiseOR(F.when(c["n"] < 0, 1).otherwise(0).cast("long"))))

    def state(left: Column, found: Column) -> Column:
        return _let(left, lambda c: F.struct(c.alias("cells"), alone(c).alias("next"), found.alias("found")))

    def step(now: Column, _: Column) -> Column:
        taken = state(_with(now["cells"], now["next"], -1), F.concat(now["found"], now["next"]))
        return F.when(F.size(now["next"]) == 0, now).otherwise(taken)

    rounds = F.array(*[F.lit(k) for k in range(ROWS * CELLS)])
    end = F.aggregate(rounds, state(cells, F.array().cast("array<long>")), step)
    return _let(end, lambda e: _let(
        F.size(F.filter(e["found"], lambda d: d.bitwiseAND(F.lit(1)) == 1)),
        lambda minus: F.struct(
            (F.size(e["found"]) - minus).alias("plus"), minus.alias("minus"),
            (~F.exists(e["cells"], lambda c: (c["n"] != 0) | (c["key"] != 0) | (c["check"] != 0))).alias("done"),
        ),
    ))


def _told(plus: Column, minus: Column, left: Column, bits: Column) -> Column:
    return F.struct(plus.alias("plus"), minus.alias("minus"), left.alias("left"), bits.alias("bits"))


def _in_blocks(left: Column, bits: Column) -> Column:
    """Signed digests (sorted, at least one) by a sketch per block of those with the same leading ``bits``.

    Digests of blocks that cannot be peeled are ``left``.
    """

    def block(i: Column) -> Column:
        return F.call_function("shiftrightunsigned", left[i], F.lit(_TOP) - bits)

    places = F.sequence(F.lit(0), F.size(left) - 1)
    starts = F.filter(places, lambda i: (i == 0) | (block(i) != block(F.greatest(i - 1, F.lit(0)))))

    def parts(at: Column) -> Column:
        end = lambda k: F.coalesce(F.get(at, k + 1), F.size(left))
        return F.transform(at, lambda start, k: _let(F.slice(left, start + 1, end(k) - start), lambda own: F.struct(
            peeled(sketch(own)).alias("found"), own.alias("own")
        )))

    def total(made: Column, side: str) -> Column:
        done = lambda a, p: a + F.when(p["found"]["done"], p["found"][side]).otherwise(0)
        return F.aggregate(made, F.lit(0), done)

    return _let(_let(starts, parts), lambda made: _told(
        total(made, "plus"), total(made, "minus"),
        F.flatten(F.transform(F.filter(made, lambda p: ~p["found"]["done"]), lambda p: p["own"])), bits,
    ))


def _settled(own: Column, other: Column) -> Column:
    """What two versions (structs of ``digests`` and ``cells``) differ in: ``plus`` and ``minus`` digests, those ``left``.

    Their fingerprints are subtracted and peeled; if that fails, larger sketches are made once.
    """
    none = F.array().cast("array<long>")
    # Nothing can be left if both are empty, so there is at least one digest where peeling fails.
    n = F.size(own["digests"]) + F.size(other["digests"])
    bits = F.greatest(F.ceil(F.log2(n / F.lit(LOAD))), F.lit(1)).cast("int")
    both = F.sort_array(F.concat(own["digests"], F.transform(other["digests"], lambda d: d.bitwiseOR(F.lit(1)))))
    return _let(peeled(subtracted(own["cells"], other["cells"])), lambda base: F.when(
        base["done"], _told(base["plus"], base["minus"], none, F.lit(0))
    ).otherwise(_let(both, lambda left: _in_blocks(left, bits))))


def _larger(told: Column) -> Column:
    """The same after larger sketches of what was left."""
    more = LARGER.bit_length() - 1
    return F.when(F.size(told["left"]) == 0, told).otherwise(
        _let(_let(told["left"], lambda left: _in_blocks(left, told["bits"] + more)), lambda now: _told(
            told["plus"] + now["plus"], told["minus"] + now["minus"], now["left"], now["bits"]
        ))
    )


def _packed(cells: Column) -> Column:
    """A fingerprint as text: for each cell 8 hexadecimal digits of ``n``, 16 of ``key`` and 8 of ``check``."""
    digits = lambda value, n: F.lpad(F.lower(F.hex(value)), n, "0")
    return F.array_join(
        F.transform(cells, lambda c: F.concat(digits(c["n"], 8), digits(c["key"], 16), digits(c["check"], 8))), ""
    )


def _likeness(own: Column, told: Column) -> Column:
    """Digests that both versions have, of all that either has; 1 for two without any."""
    every = own + told["minus"]
    return F.when(every == 0, F.lit(1.0)).otherwise((own - told["plus"]) / every)


def _place(key: Column, bounds: Column, n: int) -> Column:
    """The number of the last of ``n`` ascending bounds that is not above a key, by binary search."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(n.bit_length()))])
    return F.aggregate(
        steps, F.lit(0), lambda at, step: F.when((at + step <= n) & (F.get(bounds, at + step - 1) <= key), at + step).otherwise(at)
    ) - 1


def with_next(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Every row's ``id``, ``text`` and ``digests``, and as ``next`` the latter two of the row that follows in descending order of ids.

    Rows are dealt into parts of the order that have about as many rows and characters, by bounds of which
    the driver holds two per part. The first row of each part goes to the part before as well, where the
    last row finds it, and that of the first part to the last one. So texts move once.
    """
    spark = df.sparkSession
    texts = df.select(F.col(id_column).alias("id"), text_or_empty(text_column).alias("text"))
    texts = texts.withColumn("hash", F.xxhash64("text"))
    n, chars = texts.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    least = PARTS_EACH * int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(n, max(-(-n // PART_ROWS), -(-chars // PART_CHARS), least)))
    # Ids as they are, NULL first, as in the comparison of structs.
    keys = texts.select("id", "hash").repartitionByRange(parts, F.col("id").asc_nulls_first(), "hash")
    key = F.struct("id", "hash")
    ends = keys.groupBy(F.spark_partition_id()).agg(F.min(key).alias("low"), F.max(key).alias("high"))
    ends = ends.agg(F.to_json(F.sort_array(F.collect_list("low"))), F.to_json(F.sort_array(F.collect_list("high")))).first()
    kind = f"array<struct<id: {df.schema[id_column].dataType.simpleString()}, hash: long>>"
    low, high = (F.from_json(F.lit(text), kind) for text in ends)
    size = spark.range(1).select(F.size(low)).first()[0]
    placed = texts.withColumn("part", _place(key, low, max(size, 1))).withColumn("digests", digests(F.col("text")))
    again = F.when(key == F.get(high, F.col("part")), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    dealt = placed.withColumn("again", F.explode(again))
    dealt = dealt.withColumn("part", F.when(F.col("again"), (F.col("part") + 1) % max(size, 1)).otherwise(F.col("part")))
    order = Window.partitionBy("part").orderBy("again", F.col("id").desc_nulls_last(), F.col("hash").desc())
    following = F.lead(F.struct("text", "digests")).over(order)
    return dealt.select("id", "text", "digests", "again", following.alias("next")).filter(~F.col("again"))


def fingerprints(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next``.

    A document's edited text is its own with the last half of its characters (rounded down) replaced by as many from the
    start of the next document, or all that has, in descending order of ids; the first follows the last. A fingerprint is the
    sketch of the text's paragraphs. Two are alike by the share of paragraphs that both have, which follows from what
    their difference gives back, retried larger until it gives back all.

    NULL text is the empty text, which has no paragraphs, as has one of white space; two such are alike by 1. Equal
    paragraphs of a text count each. Very long texts are sketched in blocks, so their work is in proportion to their length.
    NULL ids come last; rows with equal ids are ordered by a hash of their texts, and repeated rows follow each other. A single
    document is its own next. An empty table gives no rows. Other columns are not looked at.
    """
    pairs = with_next(df, id_column, text_column)
    n_chars = F.length("text")
    half = F.floor(n_chars / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n_chars - half), F.substring("next.text", F.lit(1), half))
    # Three texts per row, their sketches and two differences: each is one expression over an array.
    rows = pairs.select(
        "id", n_chars.cast("long").alias("n_chars"), F.sha2(edited, 256).alias("edited_sha256"),
        F.array("digests", digests(edited), "next.digests").alias("each"),
    )
    cells = lambda found: F.transform(found, lambda d: F.struct(d.alias("digests"), sketch(d).alias("cells")))
    made = _let(cells(F.col("each")), lambda each: F.struct(
        F.transform(F.slice(each, 1, 2), lambda v: _packed(v["cells"])).alias("packed"),
        F.size(each[0]["digests"]).alias("size"),
        F.transform(F.slice(each, 2, 2), lambda v: _settled(each[0], v)).alias("told"),
    ))
    state = checkpointed(rows.select("id", "n_chars", "edited_sha256", made.alias("made")).select(
        "id", "n_chars", "edited_sha256", "made.*"
    ))
    again, told = F.transform("told", _larger), None
    while True:
        done = F.forall("told", lambda t: F.size(t["left"]) == 0)
        told = state.filter(done) if told is None else told.unionByName(state.filter(done))
        state = state.filter(~done)
        if state.isEmpty():
            break
        state = checkpointed(state.withColumn("told", again))
    size = F.col("size")
    return told.select(
        F.col("id").alias(id_column), "n_chars", "edited_sha256",
        F.col("packed")[0].alias("fingerprint"), F.col("packed")[1].alias("edited_fingerprint"),
        _likeness(size, F.col("told")[0]).alias("near_edited"),
        _likeness(size, F.col("told")[1]).alias("near_next"),
    )
