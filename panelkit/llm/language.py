"""Language of whole texts: candidates by script, then the best path over word scores.

Each word gets a score per language from its letter triples. A Viterbi pass over the words of a text, in
which a change of language costs a penalty, cuts mixed text into spans; the language with the
most letters names the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import sampled

#: Labelled rows per language that are learned from (those with the smallest hashed id), at most.
SAMPLE_ROWS = 2_000
#: Letter triples are hashed into so many cells; the model is a table of languages by cells.
CELLS = 1 << 17
#: What a change of language costs, in natural log units.
SWITCH = 8.0
#: A script belongs to a language if it writes this share of its letters.
SCRIPT_SHARE = 0.01
#: Characters times languages that are scored at a time.
SCORED = 2_000_000
#: Share of a text's letters that its language has to hold for the text to be recognised. Texts of two or three
#: languages are; only medleys are not.
LEAST_SHARE = 0.3
NONE = "und"

#: First and last code points of scripts, from the Unicode blocks.
SCRIPTS = {
    "latin": [
        (0x41, 0x24F),
        (0x250, 0x2AF),
        (0x1E00, 0x1EFF),
        (0x2C60, 0x2C7F),
        (0xA720, 0xA7FF),
        (0xFB00, 0xFB06),
        (0xFF21, 0xFF5A)
    ],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF), (0xFB1D, 0xFB4F)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F), (0xA8E0, 0xA8FF)],
    "bengali": [(0x980, 0x9FF)],
    "gurmukhi": [(0xA00, 0xA7F)],
    "gujarati": [(0xA80, 0xAFF)],
    "tamil": [(0xB80, 0xBFF)],
    "telugu": [(0xC00, 0xC7F)],
    "kannada": [(0xC80, 0xCFF)],
    "malayalam": [(0xD00, 0xD7F)],
    "sinhala": [(0xD80, 0xDFF)],
    "thai": [(0xE00, 0xE7F)],
    "lao": [(0xE80, 0xEFF)],
    "tibetan": [(0xF00, 0xFFF)],
    "georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF), (0x2D00, 0x2D2F)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7FF)],
    "ethiopic": [(0x1200, 0x139F)],
    "khmer": [(0x1780, 0x17FF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9D)],
    "han": [(0x2E80, 0x2FDF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)],
}


@lru_cache(maxsize=1)
def _characters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point: whether it is a letter, its lower case (where that is one character), its script (0: another)."""
    lower = np.arange(0x110000, dtype="<u4")
    points = lower.tobytes().decode("utf-32-le", "surrogatepass")
    letter = np.fromiter((c.isalpha() for c in points), bool, len(points))
    for i in np.flatnonzero(letter).tolist():
        if len(folded := points[i].lower()) == 1:
            lower[i] = ord(folded)
    script = np.zeros(len(points), np.uint8)
    for number, ranges in enumerate(SCRIPTS.values(), 1):
        for first, last in ranges:
            script[first : last + 1] = number
    return letter, lower, script


@dataclass(frozen=True)
class Words:
    """The words of some texts, one after the other, as arrays."""

    cells: np.ndarray  # of each letter's triple
    first: np.ndarray  # place of each word's first letter in cells
    letters: np.ndarray  # in each word
    text: np.ndarray  # number of the text each word is in
    start: np.ndarray  # of each word in its text, in characters
    end: np.ndarray
    script: np.ndarray  # of each word's first letter


def words_of(texts: list[str]) -> Words:
    is_letter, lower, script = _characters()
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.cumsum(lengths + 1) - lengths - 1
    points = np.frombuffer(("\n" + "\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), "<u4")
    letter = is_letter[points]
    places = np.flatnonzero(letter)
    folded = np.where(letter, lower[points], 0).astype(np.uint32)
    # Multipliers of a hash of three characters; any odd numbers do.
    mixed = folded[places - 1] * np.uint32(0x9E3779B1) + folded[places] * np.uint32(0x85EBCA77) + folded[places + 1] * np.uint32(0xC2B2AE3D)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x2C1B3C6D)
    first = np.flatnonzero(~letter[places - 1])
    start = places[first] - 1
    text = np.searchsorted(begins, start, "right") - 1
    letters = np.diff(np.append(first, len(places)))
    return Words(
        (mixed >> np.uint32(15)).astype(np.int64),
        first,
        letters,
        text,
        start - begins[text],
        start - begins[text] + letters,
        script[points[places[first]]]
    )


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    scores: np.ndarray  # cells by languages: log probability of a triple
    scripts: np.ndarray  # scripts by languages: whether the language is written in it


def fit(
    labelled: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    rows: int = SAMPLE_ROWS
) -> Model:
    """Learn from at most ``rows`` texts per language; rows with NULL id, text or language are left out.

    Triples are counted on Spark. The driver gets one count per language and cell that occurs and
    one per language and script, whatever the size of the input.
    """
    given = labelled.select(
        F.col(id_column).alias("id"),
        F.col(text_column).cast("string").alias("text"),
        F.col(lang_column).cast("string").alias("lang")
    )
    given = given.dropna()
    chosen = sampled(given, rows, "id", "lang").distinct()
    sample = given.join(F.broadcast(chosen), ["id", "lang"])  # at most ``rows`` ids per language

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.table({"text": batch.column("text"), "lang": batch.column("lang")}).to_pandas()
            for lang, own in texts.groupby("lang")["text"]:
                cells, scripts = np.zeros(CELLS, np.int64), np.zeros(len(SCRIPTS) + 1, np.int64)
                for text in own:
                    words = words_of([text])
                    np.add.at(cells, words.cells, 1)
                    scripts += np.bincount(words.script, weights=words.letters, minlength=len(scripts)).astype(np.int64)
                seen = np.flatnonzero(cells)
                what = np.concatenate([seen, -1 - np.arange(len(scripts))])
                many = np.concatenate([cells[seen], scripts])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(what), pa.string()), pa.array(what), pa.array(many)],
                    names=["lang", "cell", "n"]
                )

    counts = sample.mapInArrow(
        count, "lang string, cell long, n long"
    ).groupBy("lang", "cell").agg(F.sum("n").alias("n")).toPandas()
    languages = tuple(sorted(counts["lang"].unique()))
    triples, scripts = np.zeros((CELLS, len(languages))), np.zeros((len(SCRIPTS) + 1, len(languages)))
    for k, lang in enumerate(languages):
        own = counts[counts["lang"] == lang]
        cell, n = own["cell"].to_numpy(), own["n"].to_numpy()
        triples[cell[cell >= 0], k] = n[cell >= 0]
        scripts[-1 - cell[cell < 0], k] = n[cell < 0]
    smooth = 0.1
    scores = np.log((triples + smooth) / (triples.sum(axis=0) + smooth * CELLS)).astype(np.float32)
    share = scripts / np.maximum(1, scripts.sum(axis=0))
    return Model(languages, scores, share >= SCRIPT_SHARE)


def best_path(scores: np.ndarray, first: np.ndarray, length: np.ndarray, switch: float) -> np.ndarray:
    """The language of each word on the best path of each text (Viterbi), for many texts step by step.

    ``scores``: words by languages; text ``i`` has ``length[i]`` words from ``first[i]``, one at least. What came
    before gives a word's languages a lead of ``switch`` at most. Where a word's best language leads by twice
    that, all paths go through it, so texts are cut there: the next word starts with the same lead for it.
    The parts, in order of their length, take each step together, so that a step costs a few array operations.
    """
    if scores.shape[1] > 1:
        ranked = np.partition(scores, -2, axis=1)
        last = np.zeros(len(scores), bool)
        last[first + length - 1] = True
        cut = np.flatnonzero((ranked[:, -1] - ranked[:, -2] >= 2 * switch) & ~last)
        scores = scores.copy()
        lead = np.full((len(cut), scores.shape[1]), -switch, scores.dtype)
        lead[np.arange(len(cut)), scores[cut].argmax(axis=1)] = 0
        scores[cut + 1] += lead
        ends = np.flatnonzero(last)
        first = np.sort(np.concatenate([first, cut + 1]))
        length = np.sort(np.concatenate([ends, cut])) - first + 1
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    came = np.zeros(scores.shape, np.int16)
    own = np.arange(scores.shape[1], dtype=np.int16)
    total = scores[first].astype(np.float64)
    steps = int(length[0]) if len(length) else 0
    active = np.searchsorted(-length, -np.arange(steps), "left")  # texts with more words than the step's number
    for step in range(1, steps):
        n = active[step]
        now, at = total[:n], first[:n] + step
        best = now.argmax(axis=1)
        changed = now[np.arange(n), best][:, None] - switch
        stay = now >= changed
        came[at] = np.where(stay, own, best[:, None])
        total[:n] = np.where(stay, now, changed) + scores[at]
    state = total.argmax(axis=1)
    labels = np.zeros(len(scores), np.int16)
    for step in range(steps - 1, -1, -1):
        n = active[step]
        at = first[:n] + step
        labels[at] = state[:n]
        state[:n] = came[at, state[:n]]
    return labels


def _label_some(texts: list[str], model: Model, switch: float) -> tuple[np.ndarray, np.ndarray, Words, np.ndarray]:
    kinds = len(model.languages)
    words = words_of(texts)
    if not kinds or not len(words.first):
        return np.full(len(texts), -1), np.zeros(len(texts)), words, np.zeros(0, np.int16)
    scores = np.add.reduceat(model.scores[words.cells], words.first, axis=0)
    written = model.scripts[words.script]
    # Languages not written in a word's script are out of the question, unless no language is.
    scores[~written & written.any(axis=1)[:, None]] -= 1e6
    length = np.bincount(words.text, minlength=len(texts))
    has = np.flatnonzero(length)
    path = best_path(scores, (np.cumsum(length) - length)[has], length[has], switch)
    letters = np.bincount(
        words.text * kinds + path, weights=words.letters, minlength=len(texts) * kinds
    ).reshape(-1, kinds)
    total = letters.sum(axis=1)
    score = np.where(total > 0, letters.max(axis=1) / np.maximum(1, total), 0.0)
    return np.where(total > 0, letters.argmax(axis=1), -1), score, words, path


@dataclass(frozen=True)
class Labels:
    language: np.ndarray  # number of each text's language, -1: none
    score: np.ndarray
    spans: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # of each text: starts, ends, languages


def label(texts: pa.Array, model: Model, switch: float = SWITCH, spans: bool = True) -> Labels:
    """Languages, scores and spans of texts (NULL: empty), some at a time."""
    sizes = pc.fill_null(pc.utf8_length(texts), 0).to_pylist()
    language, score = np.full(len(texts), -1), np.zeros(len(texts))
    none = np.zeros(0, np.int64)
    found = [(none, none, none)] * len(texts)
    most = SCORED // max(1, len(model.languages))
    first = 0
    while first < len(sizes):
        last, size = first + 1, sizes[first]
        while last < len(sizes) and size + sizes[last] <= most:
            size += sizes[last]
            last += 1
        own = range(first, last)
        some = [text or "" for text in texts.slice(first, last - first).to_pylist()]
        language[first:last], score[first:last], words, path = _label_some(some, model, switch)
        if spans and len(path):
            begins = np.ones(len(path), bool)
            begins[1:] = (words.text[1:] != words.text[:-1]) | (path[1:] != path[:-1])
            at = np.flatnonzero(begins)
            ends = np.append(at[1:], len(path)) - 1
            cut = np.searchsorted(words.text[at], np.arange(len(own) + 1))
            for i, a, b in zip(own, cut[:-1].tolist(), cut[1:].tolist()):
                found[i] = (words.start[at[a:b]], words.end[ends[a:b]], path[at[a:b]])
        first = last
    return Labels(language, score, found)


_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])


def identify(
    df: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text", switch: float = SWITCH
) -> DataFrame:
    """One row per input row: id, ``lang_pred``, ``score``, ``spans``.

    ``lang_pred`` is ``und`` and the score 0 for NULL text and text without a letter; else the score is the
    share of the letters that lie in spans of that language. ``spans`` lists start and end (in characters)
    and language from first to last. Equal shares go to the language first in alphabetical order. With
    nothing to learn from every text is ``und``. Texts are read whole; no other column is looked at.
    """
    id_type = df.schema[id_column].dataType.simpleString()
    shared = df.sparkSession.sparkContext.broadcast(model)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*shared.value.languages, NONE], object)
        for batch in batches:
            found = label(batch.column(1), shared.value, switch)
            start, end, path = (
                np.concatenate(x) if x else np.zeros(0, np.int64) for x in (list(zip(*found.spans)) or [()] * 3)
            )
            spans = pa.StructArray.from_arrays(
                [
                    pa.array(start, pa.int32()),
                    pa.array(end, pa.int32()),
                    pa.array(names[path.astype(np.int64)], pa.string())
                ],
                fields=list(_SPAN)
            )
            offsets = np.cumsum([0, *(len(x[0]) for x in found.spans)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(names[found.language], pa.string()),
                    pa.array(found.score),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans)
                ],
                names=["id", "lang_pred", "score", "spans"],
            )

    return (
        df.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
        .mapInArrow(
            each,
            f"id {id_type}, lang_pred string, score double, spans array<struct<start: int, end: int, lang: string>>"
        )
        .withColumnRenamed("id", id_column)
    )


def recognised(
    df: DataFrame, model: Model, text_column: str = "text", least: float = LEAST_SHARE, switch: float = SWITCH
) -> DataFrame:
    """The rows, with all their columns, whose text has a language that holds at least ``least`` of its letters."""
    shared, at = df.sparkSession.sparkContext.broadcast(model), df.columns.index(text_column)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = label(batch.column(at), shared.value, switch, spans=False)
            yield batch.filter(pa.array((found.language >= 0) & (found.score >= least)))

    return df.mapInArrow(each, df.schema)


def held_out(id_column: str = "doc_id"):
    """Whether a row is kept for testing: CRC-32 of the id as text leaves 0 when divided by 5. NULL ids are not."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 5 == 0, F.lit(False))


def predicted_languages(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang"
) -> DataFrame:
    """Learn from the rows that are not held out and predict all: id, ``held_out`` and what ``identify`` gives."""
    model = fit(df.filter(~held_out(id_column)), id_column, text_column, lang_column)
    return identify(df, model, id_column, text_column).withColumn("held_out", held_out(id_column))
