"""Token ids of whole texts, word by word.

The public word tokenizer drops white space and never forms a token across it, so the ids of a text
are those of its words one after the other. Words repeat, so their ids are kept while a worker lives;
``tests/llm`` compares this with encoding whole texts.
"""

from __future__ import annotations

import re
from functools import lru_cache

from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

END_ID = 1
#: Python's split() also cuts at these four, which are not white space to the tokenizer.
_SEPARATORS = re.compile(r"[\x1c-\x1f]")
_ASCII_SPACE = re.compile(r"[\x20\x09-\x0D]+")
#: Words in which case folding and the cut into runs are plain: no apostrophes, special tokens, marks or
#: white space, and each character is its own normal form.
_PLAIN = re.compile(r"[!-&(-;=-~\xa1-\u017f]+")
#: Runs that the tokenizer separates, in lower case: letters, single digits, anything else.
_RUNS = re.compile(
    r"[a-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u017f]+|[0-9\xb2\xb3\xb9\xbc-\xbe]|[^a-z0-9\xaa\xb5\xba\xb2\xb3\xb9\xbc-\xbe\xc0-\xd6\xd8-\xf6\xf8-\u017f]+"
)


class WordIds(dict):
    """Word -> ids as little-endian unsigned 32-bit bytes; emptied when it holds ``most`` words."""

    def __init__(self, path: str, most: int = 600_000):
        super().__init__()
        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self._bytes = ByteLevel(add_prefix_space=False, use_regex=False)
        self._most = most
        self.largest = max(END_ID, self._tokenizer.get_vocab_size() - 1)

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self._most:
            self.clear()
        if not _PLAIN.fullmatch(word):
            found = self._joined(self._tokenizer.encode(word, add_special_tokens=False).ids)
        else:
            lower = word.lower()
            runs = _RUNS.findall(lower)
            if len(runs) > 1 or lower != word:
                found = b"".join([self[run] for run in runs])
            else:
                spelled = word if word.isascii() else self._bytes.pre_tokenize_str(word)[0][0]
                found = self._joined([token.id for token in self._model.tokenize(spelled)])
        self[word] = found
        return found

    @staticmethod
    def _joined(ids: list[int]) -> bytes:
        return b"".join([i.to_bytes(4, "little") for i in ids])

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        words = [w for w in _ASCII_SPACE.split(text) if w] if _SEPARATORS.search(text) else text.split()
        return b"".join([self[w] for w in words])

    def document(self, text: str | None) -> bytes:
        """The ids of a document with the end id."""
        return self.encode(text) + END_ID.to_bytes(4, "little")


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """One per worker process and tokenizer file."""
    return WordIds(path)
