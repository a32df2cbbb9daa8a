"""Token ids of whole texts by the `tokenizers` library, in Arrow batches.

The library's byte-level BPE never merges across the pieces that its
pre-tokenizer cuts, so a piece has the same ids wherever it stands.  Texts of
plain characters are therefore split at blanks, each new word is cut into pieces, and each
new piece goes to the library's model; the ids of words met before are kept.  Texts with any other character, with blanks beside other white
space, or with the string of an added token (such as ``<|endoftext|>``, which the library gives its own id) go to the library whole.
Both ways give the library's ids with its defaults.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# The byte-level vocabulary's alphabet and cutting pattern, as the tokenizer file has them.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(rf"[\x20-\x7e\n{_LETTERS}]*")
_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s{_LETTERS}0-9]+|\s+(?!\S)|\s+")
#: Words and pieces whose ids a worker keeps.
CACHE = 700_000


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 bytes
    stand for themselves, the others get the letters from 256 on in ascending order."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Known(dict):
    """Ids by word or piece: the first `CACHE` met are kept, among them all frequent ones."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, key: str) -> bytes:
        ids = self.encode(key)
        if len(self) < CACHE:
            self[key] = ids
        return ids


class Encoder:
    """Encodes columns of texts; one per Python worker and vocabulary file."""

    _open: dict[str, "Encoder"] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        added = (t.content for t in self.whole.get_added_tokens_decoder().values())
        self.added = re.compile("|".join(map(re.escape, added)) or r"(?!)")
        self.model = self.whole.model
        self.letters = str.maketrans({chr(b): c for b, c in _byte_letters().items()})
        self.blank = _byte_letters()[32]
        self.words = _Known(self._word)  # each with the blank before it
        self.pieces = _Known(self._piece)

    @classmethod
    def at(cls, path: str) -> "Encoder":
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def _spelt(self, spelt: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(spelt)]).tobytes()

    def _piece(self, piece: str) -> bytes:
        return self._spelt(piece.encode().decode("latin-1").translate(self.letters))

    def _word(self, word: str) -> bytes:
        """Ids of a blank and a word."""
        if word.isalpha():
            return self._spelt(self.blank + word) if word.isascii() else self._piece(" " + word)
        if (head := word[:-1]).isalpha():  # letters and one other character: two pieces
            return self.words[head] + self.pieces[word[-1]]
        return b"".join([self.words[p[1:]] if p[0] == " " and p[1:].isalpha() else self.pieces[p] for p in _PIECES.findall(" " + word)])

    def _plain(self, text: str) -> bytes:
        """Ids of a text that is cut at blanks; its first word has none before it."""
        words = text.split(" ")
        first = b"".join(map(self._piece, _PIECES.findall(words[0])))
        return first + b"".join(map(self.words.__getitem__, words[1:]))

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers; null is empty."""
        values = [x or "" for x in texts.to_pylist()]
        plain = [_PLAIN.fullmatch(x) is not None and not ("  " in x or "\n " in x or " \n" in x or x.endswith(" ") or self.added.search(x))
                 for x in values]
        out = [self._plain(x) if ok else b"" for x, ok in zip(values, plain)]
        odd = [i for i, ok in enumerate(plain) if not ok]
        for i, e in zip(odd, self.whole.encode_batch_fast([values[i] for i in odd], add_special_tokens=False)):
            out[i] = little_endian(np.array(e.ids, dtype=np.uint32))
        return out


def little_endian(ids: np.ndarray) -> bytes:
    return ids.astype("<u4", copy=False).tobytes()
