"""Token ids of whole texts, with the library called once per distinct piece of text.

For tokenizers that drop white space a text has the ids of its pieces, one after another, where
pieces are what lies between ASCII white space, cut once more between an ASCII letter and a mark
after it: normalisation, special strings, the split into words and the merges never reach across
such a place. A-Z are lower-cased before pieces are told apart, except between white space where other than
ASCII stands: a capital may compose with a mark there where its lower-case form would not, or the other way
round, and the library composes first. Where a text holds the opening of a special string, it is cut at white space only and
keeps its case. A bounded table of pieces, found by 64-bit hash, spares the library all repeats.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np

from wardline.llm.scan import HashTable, Words, join, lower_ascii, slices

#: Pieces kept by one worker, about 40 bytes each; beyond it the table starts anew.
TABLE_PIECES = 1_500_000

#: Words the library's normaliser and pre-tokenizer leave as one piece: lower-case Latin letters.
_PLAIN = re.compile("[a-zß-öø-ÿ]+")


class PieceEncoder:
    """Encodes UTF-8 texts with a tokenizers file that drops white space, adding no special tokens."""

    def __init__(self, definition: str, limit: int = TABLE_PIECES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self._library = Tokenizer.from_str(definition)
        self._library.no_padding()
        self._library.no_truncation()
        self.vocabulary = max(self._library.get_vocab(with_added_tokens=True).values()) + 1
        self.dtype = np.uint16 if self.vocabulary <= 1 << 16 else np.uint32
        self._specials = [t.content.encode() for t in self._library.get_added_tokens_decoder().values()]
        self._openings = {s[:2] for s in self._specials}
        # Plain words need neither normalising nor splitting: the same model behind a blank split.
        self._merger = Tokenizer.from_str(definition)
        self._merger.no_padding()
        self._merger.no_truncation()
        self._merger.normalizer = normalizers.Sequence([])
        self._merger.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self._limit = limit
        self._clear()

    def _clear(self) -> None:
        self._table = HashTable()
        self._ids = np.zeros(1 << 16, self.dtype)
        self._bounds = np.zeros(1 << 16, np.int64)

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """The library's ids of each piece."""
        decoded = [p.decode("utf-8", "replace") for p in pieces]
        out: list = [None] * len(decoded)
        plain = [i for i, p in enumerate(decoded) if _PLAIN.fullmatch(p)]
        for at in range(0, len(plain), 100):
            some = plain[at : at + 100]
            found = self._merger.encode(" ".join([decoded[i] for i in some]), add_special_tokens=False)
            for i in some:
                out[i] = []
            for number, word in zip(found.ids, found.word_ids, strict=True):
                out[some[word]].append(number)
        rest = [i for i, ids in enumerate(out) if ids is None]
        found = self._library.encode_batch([decoded[i] for i in rest], add_special_tokens=False)
        for i, e in zip(rest, found, strict=True):
            out[i] = e.ids
        return out

    def _learn(self, hashes: np.ndarray, pieces: list[bytes]) -> None:
        ids = self.encode_pieces(pieces)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        used, known = int(self._bounds[self._table.size]), self._table.size
        while used + sizes.sum() > len(self._ids):
            self._ids = np.concatenate([self._ids, np.zeros_like(self._ids)])
        while known + len(ids) + 1 > len(self._bounds):
            self._bounds = np.concatenate([self._bounds, np.zeros_like(self._bounds)])
        self._ids[used : used + int(sizes.sum())] = np.fromiter(chain.from_iterable(ids), self.dtype, int(sizes.sum()))
        self._bounds[known + 1 : known + 1 + len(ids)] = used + np.cumsum(sizes)
        self._table.add(hashes)

    def pieces(self, bodies: list[bytes]) -> tuple[Words, np.ndarray]:
        """The pieces of texts, and how many each text has."""
        buffer, at = join(bodies)
        special = any(opening in buffer for opening in self._openings)
        found = Words(buffer if special else lower_ascii(buffer), marks=not special)
        return found, found.counts(at)

    def encode(self, bodies: list[bytes], end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and the number of ids of each text; ``end`` closes each text."""
        if self._table.size > self._limit:
            self._clear()
        words, counts = self.pieces(bodies)
        number = self._table.find(words.hashes)
        unknown = np.flatnonzero(number < 0)
        if len(unknown):
            hashes, first = np.unique(words.hashes[unknown], return_index=True)
            self._learn(hashes, [words.piece(i) for i in unknown[first]])
            number[unknown] = self._table.find(words.hashes[unknown])
        starts = self._bounds[number]
        sizes = self._bounds[number + 1] - starts
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        ids = self._ids[np.arange(total) + np.repeat(starts - (ends - sizes), sizes)]
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        if end is not None:
            ids = np.insert(ids, bounds[1:], end)
            return ids, np.diff(bounds) + 1
        return ids, np.diff(bounds)

    def each(self, bodies: list[bytes], end: int | None = None):
        """The ids of each text, in turn."""
        for start, stop in slices(bodies):
            ids, sizes = self.encode(bodies[start:stop], end)
            yield from np.split(ids, np.cumsum(sizes)[:-1])


_ENCODERS: dict[int, PieceEncoder] = {}


def encoder(definition: str) -> PieceEncoder:
    """The worker's encoder for a tokenizer definition, kept between tasks."""
    key = hash(definition)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = PieceEncoder(definition)
    return _ENCODERS[key]


def definition(path: str) -> str:
    """A tokenizers file: a fixed size of a few MB, whatever the corpus."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def default_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
