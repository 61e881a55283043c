"""Ids of texts by the tokenizers library, which sees each distinct piece of text once.

A byte-level BPE model never joins ids across the pieces into which its pattern cuts a text, so the
ids of a piece can be kept. Finding offsets and cutting is most of the library's work, and the pieces
of a corpus repeat. Texts with characters from U+0250 on, whose classes depend on the version of
Unicode, and tokenizers of another kind go through the library whole.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from functools import lru_cache

import numpy as np

# Pieces kept by a worker, and the longest that is kept: some 100 MB.
MOST_PIECES, LONGEST_PIECE = 600_000, 40
# Characters that go through the library at once: it takes about a hundred bytes for an id.
CHUNK = 1 << 18
LAST = 0x24F
INT = next(code for code in "il" if array(code).itemsize == 4)


def _class(kind: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(LAST + 1) if unicodedata.category(chr(c))[0] == kind)


def _pieces() -> re.Pattern:
    """The pattern of byte-level pre-tokenizing, for characters up to ``LAST``."""
    letter, number, space = _class("L"), _class("N"), r"\t-\r \x85\xa0"
    return re.compile(
        rf"'(?:[stmd]|re|ve|ll)| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+"
        rf"|[{space}]+(?![^{space}])|[{space}]+"
    )


def byte_letters() -> str:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it can be seen."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return "".join(chr(b if b in seen else next(rest)) for b in range(256))


class _Known(dict):
    """Ids by piece, as the bytes of 32-bit integers; asks the model for those not met before."""

    def __init__(self, model) -> None:
        self.tokenize, self.letters = model.tokenize, byte_letters()

    def __missing__(self, piece: str) -> bytes:
        written = piece.encode().decode("latin-1").translate(self.letters)
        ids = array(INT, [t.id for t in self.tokenize(written)]).tobytes()
        if len(self) < MOST_PIECES and len(piece) <= LONGEST_PIECE:
            self[piece] = ids
        return ids


class Encoder:
    """Ids of texts by a tokenizer file; strings of special tokens are ordinary text."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        cut = made.get("pre_tokenizer") or {}
        self.by_pieces = (
            made["model"]["type"] == "BPE"
            and cut.get("type") == "ByteLevel"
            and cut.get("use_regex", True)
            and not cut.get("add_prefix_space")
            and not made.get("normalizer")
            and not made["model"].get("dropout")
            and all(t["special"] for t in made.get("added_tokens", []))
        )
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.known, self.cut = _Known(self.tokenizer.model), _pieces().findall
        self.beyond = re.compile(f"[^\x00-{chr(LAST)}]").search

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and how many each text has."""
        coded = []
        for text in texts:
            if not self.by_pieces or self.beyond(text):
                ids = np.array(self._whole([text])[0], np.int32)
            else:
                ids = np.frombuffer(b"".join(map(self.known.__getitem__, self.cut(text))), np.int32)
            coded.append(ids)
        counts = np.fromiter(map(len, coded), np.int64, len(coded))
        return np.concatenate([np.zeros(0, np.int32), *coded]), counts


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each file and worker, so that pieces are kept from task to task."""
    return Encoder(path)
