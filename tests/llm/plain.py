"""The pipeline's stages in plain Python, over lists of rows."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tests.llm.test_decontamination import plain_tiles
from tests.llm.test_line_dedup import brute as plain_lines


def language(rows, benchmark):
    """On these tables every text with a letter has a language for three tenths of it."""
    return [r for r in rows if r["text"] and any(c.isalpha() for c in r["text"])]


def lines(rows, benchmark):
    texts = {i: (text, gone) for i, text, gone in plain_lines([(r["doc_id"], r["text"]) for r in rows])}
    found = []
    for r in rows:
        text, gone = texts[r["doc_id"]]
        found.append(r | {"text": text, "n_chars": len(text) if gone else r["n_chars"]})
    return found


def shingles(text):
    """The five-word shingles of a text, its words if there are fewer; only A to Z are lower-cased."""
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def near_duplicates(rows, benchmark):
    """Groups joined by texts with a Jaccard similarity of 0.8 or more; pairs come from shared shingles, all of them."""
    sets, having = [shingles(r["text"]) for r in rows], defaultdict(list)
    for k, own in enumerate(sets):
        for shingle in own or [None]:
            having[shingle].append(k)
    group = list(range(len(rows)))

    def top(k):
        while group[k] != k:
            group[k] = k = group[group[k]]
        return k

    for k, own in enumerate(sets):
        for other, shared in Counter(j for shingle in own or [None] for j in having[shingle] if j < k).items():
            if sets[other] == own or shared >= 0.8 * len(own | sets[other]):
                a, b = top(k), top(other)
                group[max(a, b)] = min(a, b)
    least = {}
    for k, r in enumerate(rows):
        least[top(k)] = min(least.get(top(k), r["doc_id"]), r["doc_id"])
    return [r for k, r in enumerate(rows) if r["doc_id"] == least[top(k)]]


def decontamination(rows, benchmark):
    from panelkit.llm.decontamination import words

    found = []
    for r in rows:
        own, bad = words(r["text"]), False
        for item in map(words, benchmark):
            numbers = {w: k + 1 for k, w in enumerate(dict.fromkeys(item))}
            text = [numbers.get(w, 0) for w in own]
            if len(set(text)) > 5 and sum(map(bool, text)) >= 0.8 * len(item):
                bad |= sum(
                    n for _,
                    _,
                    n in plain_tiles([numbers[w] for w in item], [t for k, t in enumerate(text) if t or text[k - 1]], 5)
                ) >= 0.8 * len(item)
        if not bad:
            found.append(r)
    return found


def pieces(rows):
    tokenizer, found = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), []
    for r in rows:
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), 4096):
            part = ids[k : k + 4096]
            found.append((r["doc_id"], k // 4096, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return sorted(found)
