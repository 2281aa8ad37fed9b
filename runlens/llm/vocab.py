"""Token ids of whole texts by a public tokenizer, in bulk.

``WordTokenizer`` serves the lower-casing word tokenizer ``word_bpe_49k.json``.
A text of printable Latin-1 characters (letters, digits, ASCII signs, white
space) is cut into the tokenizer's own word pieces here; each distinct piece
goes through the tokenizer's merges once and the text becomes a gather over a
table of ids.  Any other text goes through the tokenizer whole.  Ids are
those of ``Tokenizer.encode`` either way (tested on both kinds).  The table
is emptied when it holds ``limit`` pieces, which bounds a worker's memory;
results do not depend on it.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np

# letters, digits, signs of Latin-1 that the pieces below cover
PLAIN = re.compile("[\\t\\n\\r -~À-ÖØ-öø-ÿ]*")
# fixed value: the tokenizer's own piece pattern, for lower-cased Latin-1
PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-z0-9ß-öø-ÿ]+")
SPECIAL = re.compile(r"<\|(?:start|end)oftext\|>")


def _byte_letters() -> dict[int, int]:
    """Byte-level alphabet: printable bytes stand for themselves, the others
    for the code points from 256 on, in order."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in own]
    return {b: 256 + i for i, b in enumerate(rest)}


BYTE_LETTERS = _byte_letters()


class _Places(dict):
    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = place = len(self)
        self.fresh.append(piece)
        return place


class WordTokenizer:
    def __init__(self, path: str, special_as_text: bool = False, limit: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self.special_as_text = special_as_text
        self.model = self.tokenizer.model
        self.limit = limit
        self._clear()

    def _clear(self) -> None:
        self.places = _Places()
        self.flat = np.zeros(0, np.uint32)
        self.begin = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)

    def _learn(self) -> None:
        """Merge the pieces met for the first time."""
        fresh, self.places.fresh = self.places.fresh, []
        if not fresh:
            return
        merge = self.model.tokenize
        ids, size = [], []
        for piece in fresh:
            if not piece.isascii():
                piece = piece.encode().decode("latin-1").translate(BYTE_LETTERS)
            got = [t.id for t in merge(piece)]
            ids += got
            size.append(len(got))
        size = np.array(size, dtype=np.int64)
        self.begin = np.concatenate([self.begin, np.cumsum(size) - size + len(self.flat)])
        self.size = np.concatenate([self.size, size])
        self.flat = np.concatenate([self.flat, np.array(ids, dtype=np.uint32)])

    def _is_plain(self, text: str) -> bool:
        return PLAIN.fullmatch(text) is not None and (self.special_as_text or "oftext|>" not in text
                                                      or not SPECIAL.search(text))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after the other, and where each text begins
        (len + 1 offsets); null texts have none."""
        if len(self.places) > self.limit:
            self._clear()
        parts: list[list[str]] = []
        whole: dict[int, np.ndarray] = {}
        for i, text in enumerate(texts):
            if not text:
                parts.append([])
            elif self._is_plain(text):
                parts.append(PIECES.findall(text.lower()))
            else:
                parts.append([])
                whole[i] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        count = np.array([len(p) for p in parts], dtype=np.int64)
        at = np.fromiter(map(self.places.__getitem__, chain.from_iterable(parts)), np.int64, int(count.sum()))
        self._learn()
        size, begin = self.size[at], self.begin[at]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.repeat(begin - (ends - size), size) + np.arange(total)]
        offsets = np.append(0, np.append(0, ends)[np.cumsum(count)])
        if whole:
            rows = [whole.get(i, ids[offsets[i]:offsets[i + 1]]) for i in range(len(texts))]
            ids = np.concatenate(rows)
            offsets = np.append(0, np.cumsum([len(r) for r in rows]))
        return ids, offsets


_loaded: dict[tuple, WordTokenizer] = {}


def word_tokenizer(path: str, special_as_text: bool = False) -> WordTokenizer:
    """One per Python worker."""
    key = (path, special_as_text)
    if key not in _loaded:
        _loaded[key] = WordTokenizer(path, special_as_text)
    return _loaded[key]


def public_path(name: str) -> str:
    """Place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def slices(batch, rows: int = 256):
    """Runs of rows, so that only a few texts are Python strings at a time."""
    for first in range(0, batch.num_rows, rows):
        yield batch.slice(first, rows)
