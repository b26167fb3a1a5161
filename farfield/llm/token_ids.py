"""Token ids of whole texts by remembered pieces: the same ids as the tokenizer gives, many times faster."""

from __future__ import annotations

import re
from array import array

import numpy as np

#: White space separates pieces in word_bpe_49k.json, and its pieces never reach over white space. In texts of these
#: characters only, normalisation is lower-casing, and the pieces are those of PIECE; other texts go to the tokenizer.
PLAIN = re.compile(r"[\t-\r -~À-ÖØ-öø-ÿ]*")
PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")
#: Pieces that a worker remembers; beyond, it forgets all and starts anew.
REMEMBERED = 400_000
CHUNK = 1_000_000
#: The letter by which a byte-level model names each byte: printable ones of Latin-1 themselves, the rest from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_OTHERS = [b for b in range(256) if b not in _PRINTABLE]
LETTERS = {b: chr(b) for b in _PRINTABLE} | {b: chr(256 + i) for i, b in enumerate(_OTHERS)}


class WordIds:
    """Ids of texts under a BPE tokenizer with word ends, as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.known: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn(self, pieces: set[str]) -> None:
        """The model alone, on a piece's bytes in its own letters: what is left of the tokenizer's work for one piece."""
        tokenize = self.model.tokenize
        for piece in pieces:
            own = piece if piece.isascii() and piece.isprintable() else "".join([LETTERS[b] for b in piece.encode()])
            self.known[piece] = array("I", [t.id for t in tokenize(own)]).tobytes()

    def __call__(self, texts: list[str]):
        """Yields the bytes of each text's ids."""
        at = 0
        while at < len(texts):
            pieces, size = [], 0
            while at < len(texts) and (size < CHUNK or not pieces):
                text = texts[at]
                plain = PLAIN.fullmatch(text) and "<|" not in text
                pieces.append(PIECE.findall(text.lower()) if plain else text)
                size += len(text)
                at += 1
            if len(self.known) > REMEMBERED:
                self.known.clear()
            known = self.known
            self._learn(set().union(*[ps for ps in pieces if type(ps) is list]).difference(known))
            for ps in pieces:
                yield b"".join(map(known.__getitem__, ps)) if type(ps) is list else self._whole(ps)


_loaded: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One for each worker process, so that what it remembers serves the following tasks too."""
    if path not in _loaded:
        _loaded[path] = WordIds(path)
    return _loaded[path]
