"""Ids of whole texts by a public tokenizer, with repeated pieces encoded once per worker.

Both vocabularies cut a text into pieces before any merge, and at white space the
cut depends on nothing but the characters beside it:
- the word vocabulary drops white space, so a text is cut at any space or line feed;
- in the byte vocabulary a space leads the next piece and a line feed is a piece,
  where no two white-space characters stand together. Other texts, and those with
  NUL, go to the tokenizer whole.
A piece not seen yet is cut once more between a Latin letter and ASCII
punctuation other than the apostrophe. Texts with the mark of a special token go to
the tokenizer whole.

A piece of plain letters is one word that normalizing and cutting leave as it is, so it
goes straight to the tokenizer's model, in the letters that its byte level gives. Which letters
are plain is asked of the tokenizer.

Where white space is dropped, many texts are cut at once: the cuts are found in their bytes, Arrow
numbers the distinct pieces, and only these are looked up; their ids are then taken by number.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa

END_ID = 1
CACHE = 1_200_000  # plain pieces that a worker keeps; later ones are encoded each time
MARKED = 6  # one in so many of them may be kept beside for pieces with punctuation; later ones are put together from their parts

_LETTER = "A-Za-zÀ-ÖØ-öø-įı-ɏ"  # without the capital I with a dot, whose lower case ends in a mark
_MARKED = re.compile(f"(?<=[{_LETTER}])(?=[!-&(-/:-@[-`{{-~])")
_LETTERS = frozenset(chr(c) for c in range(0x250) if re.match(f"[{_LETTER}]", chr(c)))
_ENDS = frozenset(".,;:!?|")
_CUTS = bytes(chr(b) in "\n " or bool(_MARKED.match("a" + chr(b), 1)) for b in range(128)) + bytes(128)  # 1 for a byte at which a piece may end
_ASCII_LETTER = np.array([chr(b).isalpha() and b < 128 for b in range(256)])


def _latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _plain_letters(tokenizer) -> dict[str, str]:
    """Letters that normalizing keeps and that stay in one word, with what the model reads for each; a space where it leads a word."""
    normal, cut = tokenizer.normalizer, tokenizer.pre_tokenizer
    kept = [c for c in sorted(_LETTERS) if ord(c) < 256 and (normal is None or normal.normalize_str(c) == c)]
    read = {c: cut.pre_tokenize_str(c) for c in kept}
    letters = {c: found[0][0] for c, found in read.items() if len(found) == 1}
    led = cut.pre_tokenize_str(" a")
    if normal is None and len(led) == 1 and led[0][0].endswith(letters["a"]):
        letters[" "] = led[0][0][: -len(letters["a"])]
    return letters


class _Pieces(dict):
    """Piece -> its ids as little-endian 32-bit integers."""

    def __init__(self, tokenizer, room: int):
        super().__init__()
        self.encode_piece, self.room, self.marked = tokenizer.encode, room, room // MARKED
        letters = _plain_letters(tokenizer)
        self.word = tokenizer.model.tokenize
        self.letters = str.maketrans(letters)
        self.inner, self.leads = frozenset(letters) - {" "}, " " in letters
        self.reads_ascii = all(letters.get(c) == c for c in "abcdefghijklmnopqrstuvwxyz")

    def is_plain(self, piece: str) -> bool:
        word = piece[1:] if self.leads and piece[:1] == " " else piece
        return bool(word) and self.inner.issuperset(word)

    def encode(self, piece: str) -> bytes:
        return array("I", self.encode_piece(piece, add_special_tokens=False).ids).tobytes()

    def __missing__(self, piece: str) -> bytes:
        as_it_is = self.reads_ascii and piece.isascii() and piece.isalpha() and piece.islower()
        if as_it_is or self.is_plain(piece):
            ids = array("I", [t.id for t in self.word(piece if as_it_is else piece.translate(self.letters))]).tobytes()
            if len(self) < self.room:
                self[piece] = ids
            return ids
        if piece[-1:] in _ENDS and piece[-2:-1] in _LETTERS:  # the usual mark after a word
            parts = (piece[:-1], piece[-1])
        else:
            parts = _MARKED.split(piece)
        if len(parts) > 1:
            ids = b"".join([self[p] for p in parts])
            if self.marked:
                self.marked -= 1
                self[piece] = ids
            return ids
        ids = self.encode(piece)
        if len(self) < self.room:
            self[piece] = ids
        return ids


class Encoder:
    """ids(text): the tokenizer's ids of the whole text as little-endian 32-bit integers."""

    def __init__(self, path: str, room: int = CACHE):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.pieces = _Pieces(self.tokenizer, room)
        self.keeps_space = len(self.tokenizer.encode("\n").ids) > 0

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        if "<|" in text:
            return self.pieces.encode(text)
        if not self.keeps_space:
            if _latin(text):  # lower case is the same in any library there
                text = text.lower()
            parts = text.replace("\n", " ").split(" ")
        elif "\0" in text or text.replace("\n", " ").split(" ") != text.split():
            return self.pieces.encode(text)
        else:
            parts = text.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")
        return b"".join(map(self.pieces.__getitem__, parts))

    def document(self, text: str) -> bytes:
        """Ids of a text and the end id."""
        return self.ids(text) + END_ID.to_bytes(4, "little")

    def documents(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, the end id after each, and how many each has with it."""
        if self.keeps_space or not texts:
            found = [self.document(text) for text in texts]
            return as_ids(b"".join(found)), np.array([len(ids) // 4 for ids in found], dtype=np.int64)
        whole, lines = {}, []
        for k, text in enumerate(texts):
            if "<|" in text:
                whole[k], text = self.document(text), ""
            elif _latin(text):
                text = text.lower()
            lines.append(text.encode())
        closes = np.cumsum([len(line) + 1 for line in lines]) - 1  # the line feed after each text
        lines.append(b"")
        pieces, last = _distinct(b"\n".join(lines), closes)
        found = [*map(self.pieces.__getitem__, pieces.dictionary.to_numpy(zero_copy_only=False)), END_ID.to_bytes(4, "little"), *whole.values()]
        # After a text's last piece stands its end id, or all its ids where it went to the tokenizer whole.
        ends = np.full(len(texts), len(pieces.dictionary), dtype=np.int32)
        ends[list(whole)] = np.arange(len(whole)) + len(pieces.dictionary) + 1
        order = np.insert(pieces.indices.to_numpy(), last + 1, ends)
        taken = pa.array(found, pa.large_binary()).take(pa.array(order))
        _, where, body = taken.buffers()
        bounds = np.frombuffer(where, dtype=np.int64)[np.append(0, last + np.arange(len(texts)) + 2)] // 4
        return as_ids(body)[: bounds[-1]], np.diff(bounds)


def _distinct(raw: bytes, closes: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Pieces of UTF-8 texts that end in a line feed each (`closes`), numbered by distinct ones, and the last piece of each text."""
    data = np.frombuffer(raw, dtype=np.uint8)
    cuts = np.flatnonzero(np.frombuffer(raw.translate(_CUTS), dtype=bool))
    space = data.take(cuts) <= 32
    letter = data.take(cuts - 1)  # before the first byte the last one, a line feed
    latin = (letter >= 0x80) & (letter != 0x97) & (letter != 0xB7) & (data.take(cuts - 2, mode="wrap") == 0xC3)
    kept = np.flatnonzero(space | latin | _ASCII_LETTER.take(letter))
    cuts, space = cuts.take(kept), space.take(kept)
    bounds = np.zeros(len(cuts) + 1, dtype=np.int64)
    bounds[1:] = cuts - (np.cumsum(space) - space)  # places without the white space
    body = raw.translate(None, b"\n ")
    pieces = pa.Array.from_buffers(pa.large_string(), len(cuts), [None, pa.py_buffer(bounds), pa.py_buffer(body)])
    return pieces.dictionary_encode(), np.searchsorted(cuts, closes)


@lru_cache(maxsize=4)
def encoder(path: str, room: int = CACHE) -> Encoder:
    """One encoder per worker and vocabulary."""
    return Encoder(path, room)


def as_ids(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, dtype="<u4")
