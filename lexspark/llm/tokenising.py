"""Token ids of whole texts, word by word.

The tokenizers in use never join characters across ASCII white space: their normaliser and their split
work between such characters only. Their normaliser folds A-Z, and their split separates a letter from a
full stop or comma that follows it. So each distinct word, folded and without these two, is encoded once by
the tokenizers library and remembered, and the ids of a text are those of its words in order. The
tests compare this with encoding whole texts.
"""

from __future__ import annotations

import os
import re
import struct

END_ID = 1
#: Words remembered by a worker before the older half is forgotten. It bounds memory, not results.
MEMO_WORDS = 600_000
#: A full stop or comma between an ASCII letter and white space is a token of its own.
STOPS = re.compile(rb"(?<=[A-Za-z])[.,](?=[ \t-\r]|\Z)")

_loaded: dict[str, "WordTokenizer"] = {}


class WordTokenizer:
    def __init__(self, path: str, memo_words: int | None = None) -> None:
        self.memo_words = MEMO_WORDS if memo_words is None else memo_words
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _learn(self, words: set[bytes]) -> None:
        new = []
        for word in [w for w in words if w not in self.young]:
            ids = self.old.get(word)
            if ids is None:
                new.append(word)
            else:
                self.young[word] = ids
        encoded = self.tokenizer.encode_batch_fast([w.decode("utf-8") for w in new], add_special_tokens=False)
        for word, found in zip(new, encoded, strict=True):
            ids = found.ids
            self.young[word] = struct.pack(f"<{len(ids)}I", *ids)

    @staticmethod
    def words(text: str | None) -> list[bytes]:
        data = text.encode("utf-8", "replace") if text else b""
        if b"<|" in data:  # may name a special token, which must be met as it is written
            return data.split()
        return STOPS.sub(rb" \g<0>", data).lower().split()

    def encode(self, texts: list[str | None], end_id: int = END_ID) -> list[bytes]:
        """Per text its ids and the end id, as little-endian unsigned 32-bit integers."""
        end = struct.pack("<I", end_id)
        out = []
        for text in texts:
            words = self.words(text)
            self._learn(set(words))
            out.append(b"".join(map(self.young.__getitem__, words)) + end)
            if len(self.young) > self.memo_words:
                self.old, self.young = self.young, {}
        return out


def word_tokenizer(path: str, memo_words: int | None = None) -> WordTokenizer:
    """The tokenizer of this worker; workers are used again, and so is what they remember."""
    if path not in _loaded:
        _loaded[path] = WordTokenizer(path)
    _loaded[path].memo_words = MEMO_WORDS if memo_words is None else memo_words
    return _loaded[path]


def forget_words() -> None:
    """Called by other work in a worker that may have encoded before: it needs the memory itself."""
    _loaded.clear()
