"""Line deduplication by a log-template tree of fixed depth.

Lines go down a tree by their number of tokens and their leading tokens; at its leaves stand templates, in
which variable fields are generalised. Numbers and the like are variable anywhere; of the tokens
behind the leading ones, one of a few fields (equal stretches of the line) may differ as a whole. A line recurs
if one of its templates is found in enough documents; more of them where a field differs, as that may be what a line says.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import text_or_empty
from panelkit.sources.tables import checkpointed

#: Tokens that a line has at least to be looked at: every line that is not blank.
LEAST_TOKENS = 1
#: Leading tokens that make the path to a leaf.
LEADING = 2
#: Fields behind the leading tokens; one of them may vary, so templates keep four fifths of those tokens.
FIELDS = 5
#: Documents (distinct texts) with a template from which on its lines are dropped.
DOCUMENTS = 5
#: The same for templates with a field that differs: at least so many, and this share of all distinct texts.
FIELD_DOCUMENTS, FIELD_SHARE = 20, 1e-5

#: Constant tokens that a template with variable ones keeps at least, and their share of its tokens.
CONSTANT, CONSTANT_SHARE = 2, 0.4

# Fixed pattern of variable tokens: digits anywhere, web and mail addresses.
_VARIABLE = re.compile(r"\d|://|www\.|@\w", re.I)
ANY = "<*>"


def _telling(found: list[str]) -> bool:
    """Whether enough tokens are constant for a template to say where a line comes from."""
    return len(found) - found.count(ANY) >= max(CONSTANT, CONSTANT_SHARE * len(found))


def tokens(line: str) -> list[str]:
    """Tokens of a line between white space, those that vary by their kind replaced by a wildcard.

    A line with too few others, such as a row of numbers, keeps all as they are.
    """
    found = line.split()
    if not _VARIABLE.search(line):
        return found
    made = [ANY if _VARIABLE.search(t) else t for t in found]
    return made if _telling(made) else found


def leaf(found: list[str], leading: int = LEADING) -> str:
    """The path down the tree: number of tokens, then the leading ones."""
    return "\x00".join([str(len(found)), *found[:leading]])


def templates(found: list[str], leading: int = LEADING, fields: int = FIELDS) -> list[str]:
    """The line's template with all tokens, then those with one field generalised.

    A line with fewer tokens than fields behind the leading ones has one field less for each that it lacks, so
    that no field is empty; with two tokens behind them or fewer only the template with all tokens is left. So it is
    for lines that kept their variable tokens. A template always keeps enough constant tokens.
    """
    rest = found[leading:]
    many = min(fields, len(rest))
    exact = "\x00".join(found)
    if many < 3 or _VARIABLE.search(exact):
        return [exact]
    cut = [len(rest) * k // many for k in range(many + 1)]
    head = "\x00".join(found[:leading])
    return [exact] + [
        "\x00".join([head, *rest[:a], ANY * (b - a), *rest[b:]])
        for a, b in zip(cut, cut[1:]) if _telling(found[:leading] + rest[:a] + [ANY] * (b - a) + rest[b:])
    ]


def _hash(text: str) -> int:
    value = xxhash.xxh3_64_intdigest(text)
    return value - (1 << 64) if value >> 63 else value


_LINE = "text_hash long, leaf long, templates array<long>, fresh array<boolean>, line int"


def _lines(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """A row per line that is looked at: the document's id and hash of its text, ``leaf`` and ``templates`` as hashes
    (the line itself first, then those with a field that differs), which of these are ``fresh`` (not seen further up in the document), and its place."""
    id_type = df.schema[id_column].dataType.simpleString()
    text = text_or_empty(text_column)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, leaves, made, fresh, numbers = [], [], [], [], []
            for i, text in enumerate(batch.column("text")):
                seen = set()
                for number, line in enumerate(text.as_py().split("\n")):
                    found = tokens(line)
                    if len(found) < LEAST_TOKENS:
                        continue
                    own = [_hash(t) for t in templates(found)]
                    rows.append(i)
                    leaves.append(_hash(leaf(found)))
                    made.append(own)
                    fresh.append([t not in seen for t in own])
                    numbers.append(number)
                    seen.update(own)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(at), batch.column("text_hash").take(at), pa.array(leaves, pa.int64()), pa.array(made, pa.list_(pa.int64())),
                 pa.array(fresh, pa.list_(pa.bool_())), pa.array(numbers, pa.int32())],
                names=["id", "text_hash", "leaf", "templates", "fresh", "line"],
            )

    return df.select(
        F.col(id_column).alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text")
    ).mapInArrow(split, f"id {id_type}, {_LINE}")


def recurring_lines(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", documents: int = DOCUMENTS
) -> DataFrame:
    """Lines to drop: ``id``, ``text_hash`` and ``dropped``, their places from 0, for documents that have any.

    Level by level: leaves with too few lines cannot hold a template of enough documents, so only the lines of
    the others are counted by template. Counts combine before the shuffle, and lines meet the
    templates in joins that adaptive execution splits, so one line in a third of all documents is no harm.
    Copies of a text count once: of the templates in enough rows, those in enough distinct texts recur.
    """
    lines = checkpointed(_lines(df, id_column, text_column))
    leaves = checkpointed(
        lines.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= documents).select("leaf")
    )
    texts = lines.select("text_hash").distinct().count()
    least = F.when(F.col("varies"), max(FIELD_DOCUMENTS, FIELD_SHARE * texts)).otherwise(documents)

    def often(rows: DataFrame) -> DataFrame:
        """Templates and the number of rows that have them, if that may be enough."""
        counted = rows.groupBy("template").agg(F.count(F.lit(1)).alias("n"))
        return checkpointed(counted.filter(F.col("n") >= documents))

    each = lines.join(leaves, "leaf", "left_semi").select(
        "id", "text_hash", "line", F.posexplode(F.arrays_zip("templates", "fresh")).alias("place", "t")
    )
    each = checkpointed(each.select(
        "id", "text_hash", "line", F.col("t.templates").alias("template"), "t.fresh", (F.col("place") > 0).alias("varies")
    ))
    each = checkpointed(each.join(often(each.filter("fresh")).drop("n"), "template", "left_semi"))
    recurring = often(each.filter("fresh").select("template", "text_hash").distinct())
    found = each.join(recurring, "template").filter(F.col("n") >= least)
    return checkpointed(
        found.groupBy("id", "text_hash").agg(F.sort_array(F.collect_set("line")).alias("dropped"))
    )


def without_recurring_lines(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", count: str | None = None
) -> DataFrame:
    """The rows with all their columns and, in ``text_column``, the lines that do not recur.

    A line recurs if at least ``DOCUMENTS`` distinct texts have it, numbers and the like aside, or ``FIELD_DOCUMENTS`` of them
    (and a share of ``FIELD_SHARE`` of all) have lines that differ from it in one field. All of its occurrences
    go, from every document. Texts are read whole, however long. Rows with the same text count once, so that copies of a document, which are for
    deduplication of documents to sort out, do not make each other's lines recur. NULL text stays NULL; an empty
    table stays empty. ``count`` names a column that then gets the number of lines dropped (none may have that name).
    """
    drops = recurring_lines(df, id_column, text_column)
    # The row travels as one struct, so that its columns may have any names.
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
        F.col(id_column).alias("own_id"),
        F.xxhash64(text_or_empty(text_column)).alias("own_hash")
    )
    joined = rows.join(
        drops.hint("merge"), F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_hash") == F.col("text_hash")), "left"
    ).select("row", "dropped")
    at, kinds = df.columns.index(text_column), df.schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns, dropped = batch.column("row").flatten(), batch.column("dropped").to_pylist()
            texts = columns[at].to_pylist()
            for i, gone in enumerate(dropped):
                if gone:
                    gone = set(gone)
                    texts[i] = "\n".join([line for k, line in enumerate(texts[i].split("\n")) if k not in gone])
            columns[at] = pa.array(texts, columns[at].type)
            if count:
                columns.append(pa.array([len(gone or ()) for gone in dropped], pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, names=[f"c{k}" for k in range(len(columns))])

    types = [f.dataType.simpleString() for f in kinds] + ["bigint"] * bool(count)
    schema = ", ".join(f"c{k} {t}" for k, t in enumerate(types))
    return joined.mapInArrow(cut, schema).toDF(*kinds.names, *([count] if count else []))
