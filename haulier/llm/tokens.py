"""Whole-text encoding with public tokenizers, helped by a memory of the pieces and words already seen."""

from __future__ import annotations

import array
import os
import re
import sys
from collections.abc import Iterable

import numpy as np

from .common import worker_memory

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Pieces and bare words kept per worker in each of two generations: together at most about 250 MB.
MEMORY_PIECES, MEMORY_WORDS = 400_000, 200_000
LONGEST_PIECE = 64

#: Marks that end a piece and that the tokenizers cut off from the letters in front.
_TAIL = ".,;:!?*%$#&"
#: Letters that normalisation leaves alone but for their case. A zero in front: no space stands before the word.
_PLAIN = re.compile("\0?[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch


def _byte_letters() -> dict[int, str]:
    """The letters that byte-level vocabularies write bytes with: printable ones are themselves, others follow from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


BYTE_LETTERS = _byte_letters()
_ABOVE_SPACE = {byte: letter for byte, letter in BYTE_LETTERS.items() if byte > 0x20}
_LETTER_BYTES = {ord(letter): byte for byte, letter in BYTE_LETTERS.items()}


class Memory:
    """A dictionary of bounded size in two generations: a full one becomes the old one, and what is asked for again moves on."""

    def __init__(self, size: int) -> None:
        self._size, self.new, self._old = size, {}, {}

    def turn(self) -> None:
        """Start a new generation if this one is full."""
        if len(self.new) > self._size:
            self._old, self.new = self.new, {}

    def lacks(self, keys: set[str]) -> set[str]:
        """The keys that neither generation knows; those of the old one move on."""
        unknown = keys.difference(self.new)
        absent = unknown.difference(self._old)
        if len(absent) < len(unknown):
            known = unknown.difference(absent)
            self.new.update(zip(known, map(self._old.__getitem__, known), strict=True))
        return absent

    def forget_long(self, keys: Iterable[str]) -> None:
        for key in keys:
            if len(key) > LONGEST_PIECE:
                del self.new[key]


_CLOSING = frozenset(_TAIL)


def _irregular(piece: str) -> bool:
    """Whether other white space than one space or line end stands at or in the piece."""
    return piece != "\n" and (piece := piece.removeprefix("\0")).split() != [piece]


class PieceEncoder:
    """Encodes texts piece by piece where that gives the ids of the whole text.

    The tokenizers cut a text at white space before they merge, so the ids of a text are the ids of its pieces in a row.
    Pieces repeat, so each is encoded once and remembered; a piece of letters and closing marks is put together from a remembered word
    and its tail, so that new pieces are mostly known words. Texts that cannot be cut this way are encoded whole. A subclass says how to cut and
    how to encode. Pieces start with a zero where no space stands in front of them, if the tokenizer cares.
    """

    code = "H"
    #: Whether white space has ids of its own.
    _spaced = True

    def __init__(self, pieces: int = MEMORY_PIECES, words: int = MEMORY_WORDS) -> None:
        # One memory for both: most pieces are bare words.
        self._pieces, self._tails = Memory(pieces + words), {}

    @property
    def dtype(self) -> str:
        """numpy type of the ids: little-endian, two or four bytes."""
        return "<u2" if self.code == "H" else "<u4"

    def _bytes(self, ids: list[int]) -> bytes:
        packed = array.array(self.code, ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def _cut(self, text: str) -> list[str] | None:
        """Pieces whose ids are the text's ids in a row; None where only the whole text gives them."""
        raise NotImplementedError

    def _whole(self, texts: list[str]) -> list[bytes]:
        raise NotImplementedError

    def _odd(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces of any kind."""
        raise NotImplementedError

    def _plain(self, words: list[str]) -> list[bytes]:
        """Ids of pieces of plain letters only, many at a time."""
        return self._odd(words)

    def _tail_ids(self, tail: str) -> bytes:
        """Ids of closing marks behind a letter."""
        raise NotImplementedError

    def encode(self, texts: Iterable[str], together: int = 256) -> list[bytes]:
        """Little-endian ids of each text, as bytes. Unseen pieces of ``together`` texts are encoded in one call."""
        texts, out = list(texts), []
        for begin in range(0, len(texts), together):
            some = texts[begin : begin + together]
            self._pieces.turn()
            cuts = [self._cut(text) if text else [] for text in some]
            pieces: set[str] = set()
            for cut in cuts:
                pieces.update(cut or ())
            missing = self._pieces.lacks(pieces)
            irregular = self._learn(missing) if missing else set()
            if irregular:
                # Runs of white space: the texts that have them are encoded whole, and such pieces never come into the memory.
                cuts = [None if cut and not irregular.isdisjoint(cut) else cut for cut in cuts]
            whole = iter(self._whole([text for text, cut in zip(some, cuts, strict=True) if cut is None]))
            known = self._pieces.new.__getitem__
            out.extend([next(whole) if cut is None else b"".join(map(known, cut)) for cut in cuts])
            self._pieces.forget_long(missing - irregular)
        return out

    def _learn(self, missing: set[str]) -> set[str]:
        """Bring the ids of unknown pieces into the memory; returns the pieces that only their whole text can give."""
        cores = {piece: piece.rstrip(_TAIL) for piece in missing if piece[-1:] in _CLOSING}
        words = missing.difference(cores)
        plain = set(filter(_PLAIN, words))
        others = list(words.difference(plain))
        closed = [(piece, core) for piece, core in cores.items() if _PLAIN(core)]
        more = self._pieces.lacks({core for _, core in closed}.difference(plain))
        plain = [*plain, *more]
        known = self._pieces.new
        if plain:
            known.update(zip(plain, self._plain(plain), strict=True))
        if closed:
            tail = self._tail
            known.update([(piece, known[core] + tail(piece[len(core) :])) for piece, core in closed])
        others += cores.keys() - dict(closed).keys()
        irregular = set(filter(_irregular, others)) if self._spaced else set()
        odd = [piece for piece in others if piece not in irregular] if irregular else others
        if odd:
            known.update(zip(odd, self._odd(odd), strict=True))
        self._pieces.forget_long(more)
        return irregular

    def _tail(self, tail: str) -> bytes:
        if tail not in self._tails:
            if len(self._tails) > 10_000:
                self._tails.clear()
            self._tails[tail] = self._tail_ids(tail)
        return self._tails[tail]


class Encoder(PieceEncoder):
    """A byte-level tokenizer of the ``tokenizers`` library: ids as of its ``encode(text, add_special_tokens=False)``.

    A single space belongs to the word behind it, unless the tokenizer drops white space. Texts with runs of white space that a cut
    at spaces could change are encoded whole, and so are texts that may hold a special token. ``plain_specials``: the names of special tokens are ordinary text.
    Words of plain letters go straight to the merges of the model, many in one call, without normaliser and patterns.
    """

    def __init__(self, path: str, pieces: int = MEMORY_PIECES, words: int = MEMORY_WORDS, *, plain_specials: bool = False) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        super().__init__(pieces, words)
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = self._plain_specials = plain_specials
        self._keeps_spaces = self._tokenizer.encode("a b", add_special_tokens=False).tokens != ["a</w>", "b</w>"]
        self._spaced = self._keeps_spaces
        self.code = "H" if self._tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "I"
        self._merges = Tokenizer(self._tokenizer.model)
        self._merges.pre_tokenizer = pre_tokenizers.Split(" ", "removed")
        names = [self._tokenizer.id_to_token(i) or "" for i in range(self._tokenizer.get_vocab_size(with_added_tokens=True))]
        self._marked = np.array([name.startswith(BYTE_LETTERS[0x20]) if self._keeps_spaces else name.endswith("</w>") for name in names])

    def token_bytes(self) -> list[bytes]:
        """The bytes of every id of a vocabulary that keeps spaces."""
        n = self._tokenizer.get_vocab_size(with_added_tokens=True)
        names = [self._tokenizer.id_to_token(i) or "" for i in range(n)]
        return [bytes(_LETTER_BYTES.get(ord(c), 0x3F) for c in name) for name in names]

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [self._bytes(x.ids) for x in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def _cut(self, text: str) -> list[str] | None:
        if "<|" in text and not self._plain_specials:
            return None
        if not self._keeps_spaces:
            return text.replace("\n", " ").split(" ")
        if "\0" in text:
            return None
        text = text[1:] if text[0] == " " else "\0" + text
        return text.replace("\n", " \n \0").split(" ")

    def _text_of(self, piece: str) -> str:
        if not self._keeps_spaces:
            return piece
        if piece[:1] == "\0":
            return piece[1:]
        return piece if piece == "\n" else " " + piece

    def _odd(self, pieces: list[str]) -> list[bytes]:
        return self._whole([self._text_of(piece) for piece in pieces])

    def _tail_ids(self, tail: str) -> bytes:
        return self._whole([tail])[0]

    def _plain(self, words: list[str]) -> list[bytes]:
        if self._keeps_spaces:
            later = [word for word in words if word[0] != "\0"]
            if len(later) < len(words):
                ids = dict(zip(later, self._plain(later), strict=True)) if later else {}
                first = [word for word in words if word[0] == "\0"]
                ids.update(zip(first, self._odd(first), strict=True))
                return [ids[word] for word in words]
        letters = " ".join(words)
        letters = "\x01" + letters.replace(" ", " \x01") if self._keeps_spaces else letters.lower()
        if not letters.isascii():
            letters = letters.encode().decode("latin-1").translate(_ABOVE_SPACE)
        encoded = self._merges.encode_batch_fast([letters.replace("\x01", BYTE_LETTERS[0x20])], add_special_tokens=False)[0]
        ids = np.array(encoded.ids, dtype=self.dtype)
        # The first token of a word shows the space in front of it, or the last one the end of the word.
        cuts = np.flatnonzero(self._marked[ids]) if self._keeps_spaces else np.flatnonzero(self._marked[ids])[:-1] + 1
        ends = [*(cuts[1:] if self._keeps_spaces else cuts).tolist(), len(ids)]
        if len(ends) != len(words):
            return self._odd(words)
        raw, size = ids.tobytes(), ids.itemsize
        return [raw[size * i : size * j] for i, j in zip([0, *ends], ends, strict=False)]


class PieceModelEncoder(PieceEncoder):
    """A ``sentencepiece`` model that adds a space in front: ids as of its ``encode(text)``.

    Whether its pieces allow the cuts is read from its vocabulary: none may hold a space behind another letter, a line end, or a
    closing mark behind a letter; else texts are encoded whole.
    """

    def __init__(self, path: str, pieces: int = MEMORY_PIECES, words: int = MEMORY_WORDS) -> None:
        import sentencepiece

        super().__init__(pieces, words)
        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self._model.id_to_piece(i) for i in range(self._model.get_piece_size())]
        self.code = "H" if len(names) <= 1 << 16 else "I"
        pairs = {pair for name in names for pair in zip(name, name[1:], strict=False)}
        at_spaces = not any(b == "▁" != a or "\n" in (a, b) for a, b in pairs) and "\n" not in names
        at_tails = not any(a.isalpha() and b in _TAIL for a, b in pairs)
        self._head = self._model.encode("\n")
        self._cuts = at_spaces and at_tails and self._model.encode("\na b\nc") == [
            *self._head, *self._model.encode("\na")[len(self._head) :], *self._model.encode("b"), self._head[-1], *self._model.encode("\nc")[len(self._head) :]
        ]

    def token_bytes(self) -> list[bytes]:
        model = self._model
        kinds = ((i, model.id_to_piece(i)) for i in range(model.get_piece_size()))
        return [bytes([int(name[3:5], 16)]) if model.is_byte(i) else name.replace("▁", " ").encode() for i, name in kinds]

    def _whole(self, texts: list[str]) -> list[bytes]:
        return list(map(self._bytes, self._model.encode(texts, num_threads=1))) if texts else []

    def _cut(self, text: str) -> list[str] | None:
        if not self._cuts or "\0" in text or "▁" in text:
            return None
        return text.replace("\n", " \n \0").split(" ")

    def _odd(self, pieces: list[str]) -> list[bytes]:
        # A line end in front takes the added space; both are cut off again.
        front = [piece[0] in "\0\n" for piece in pieces]
        texts = [piece if not cut else piece if piece == "\n" else "\n" + piece[1:] for piece, cut in zip(pieces, front, strict=True)]
        encoded = self._model.encode(texts, num_threads=1)
        # Of a line end alone only the added space goes.
        skip = [0 if not cut else len(self._head) - 1 if piece == "\n" else len(self._head) for piece, cut in zip(pieces, front, strict=True)]
        return [self._bytes(ids[n:]) for ids, n in zip(encoded, skip, strict=True)]

    def _tail_ids(self, tail: str) -> bytes:
        return self._odd(["\0" + tail])[0]


_ENCODERS: dict[tuple[str, bool], PieceEncoder] = worker_memory()


def encoder(path: str, *, plain_specials: bool = False) -> PieceEncoder:
    """One encoder per worker process, with a memory that lasts over its tasks."""
    if (path, plain_specials) not in _ENCODERS:
        _ENCODERS[path, plain_specials] = PieceModelEncoder(path) if path.endswith(".model") else Encoder(path, plain_specials=plain_specials)
    return _ENCODERS[path, plain_specials]


def in_slices(batch, rows: int = 256, size: int = 4 << 20) -> Iterable:
    """Slices of an Arrow batch of at most ``rows`` rows and, beyond one row, about ``size`` bytes of text."""
    begin = 0
    lengths = batch.column("text").nbytes / max(1, batch.num_rows)
    step = max(1, min(rows, int(size / max(1.0, lengths))))
    while begin < batch.num_rows:
        yield batch.slice(begin, step)
        begin += step
