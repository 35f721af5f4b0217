"""Token ids of whole texts under a public tokenizer file, with a bounded cache of words."""

from __future__ import annotations

import os
from functools import cache
from unicodedata import is_normalized

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Ends every document.
END_ID = 1


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> list[str]:
    """The letter that a byte-level tokenizer writes for each byte: itself if it is printable, else the next free one."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(other)) for b in range(256)]


class WordIds:
    """Ids of texts under a tokenizer that drops white space, so that a text's ids are those of its words in turn.

    Words that were seen are looked up. A new word of letters alone is one
    token group for the tokenizer, so its merges are asked directly; a mark of
    punctuation at its end is a group of its own. All other words are encoded
    by the whole tokenizer. When the cache is full it starts anew, so memory
    is bounded.
    """

    MARKS = frozenset(",.;:!?")

    def __init__(self, path: str, words: int = 600_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model
        self.words = words
        self.letters = _byte_letters()
        self.marks = {m: self._whole(m) for m in self.MARKS}
        self.seen: dict[str, bytes] = {"": b""}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint16).tobytes()

    def _group(self, word: str) -> bytes | None:
        """Ids of a word of letters; None if it is not one, or if lower case or composition would change that."""
        if word.isascii():
            if not word.isalpha():
                return None
            plain = word.lower()
        else:
            plain = "".join(c.lower() for c in word)
            if not (plain.isalpha() and word.isalpha() and is_normalized("NFC", word) and is_normalized("NFC", plain)):
                return None
            plain = "".join([self.letters[b] for b in plain.encode()])
        return np.array([t.id for t in self.merges.tokenize(plain)], np.uint16).tobytes()

    def _learn(self, new: list[str]) -> None:
        for word in new:
            ids = None
            if word[-1] in self.marks and len(word) > 1:
                stem = self.seen.get(word[:-1]) or self._group(word[:-1])
                if stem is not None and word[-2].isalpha():
                    ids = stem + self.marks[word[-1]]
            else:
                ids = self._group(word)
            self.seen[word] = self._whole(word) if ids is None else ids

    def encode(self, text: str) -> np.ndarray:
        """The ids of the text as 16-bit unsigned integers."""
        parts = text.encode().lower().decode().replace("\n", " ").split(" ")  # bytes: only A-Z changes
        new = [w for w in set(parts) if w not in self.seen]
        if new:
            if len(self.seen) + len(new) > self.words:
                self.seen = {"": b""}
                new = [w for w in set(parts) if w]
            self._learn(new)
        return np.frombuffer(b"".join(map(self.seen.__getitem__, parts)), np.uint16)


@cache
def word_ids(path: str) -> WordIds:
    """One encoder for each worker process."""
    return WordIds(path)
