"""Whole-text token ids for the two vocabularies used here.

Both give exactly what the tokenizers library gives for the whole text with
``add_special_tokens=False``; tests compare them on every given document.
"""

from __future__ import annotations

import base64
import functools
import re
import sys
from array import array

import numpy as np

REMEMBERED = 700_000  # pieces a Python worker remembers; the first ones met stay
LONGEST_REMEMBERED = 48
# a run of letters up to a Latin letter that a printable ASCII character other than a letter follows
_CORE = re.compile(r"[^\W\d_]++(?<=[A-Za-zÀ-ÖØ-öø-įı-ɏ])(?=[!-@\[-`{-~])")
_LATIN_1 = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch  # one or two bytes each, composed, lower case of the same kind


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where it is printable Latin-1, else 256 and up."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(0x100, 0x200))
    return [chr(b) if b in set(plain) else chr(next(other)) for b in range(256)]


def _closed(word: bytes) -> bytes:
    """A lower-case Latin-1 word whose last byte shows that the word ends: a capital, or 0 to 63 for a second byte."""
    return word[:-1] + bytes([word[-1] - (32 if word[-1] < 128 else 128)])


def tokenizer_path(name: str) -> str:
    """Path of a vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def load_tokenizer(path: str):
    """A library tokenizer without truncation or padding."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


class WordEncoder(dict):
    """Packed ids for a vocabulary that drops white space (``word_bpe_49k.json``).

    Such a tokenizer ends a pre-token at white space and after every run of
    letters, so a text's ids are those of its pieces between spaces and line ends in order,
    and a piece's ids are those of its leading letters and of the rest.  Pieces
    recur; their ids are looked up.  New runs of Latin-1 letters are encoded from the
    ranks of the vocabulary's tokens of such letters, which is faster than the
    library; the library encodes all else that is new.
    """

    def __init__(self, path: str, dtype: str = "<u4"):
        super().__init__()
        self._kind = {"<u2": "H", "<u4": "I"}[dtype]
        self.tok = load_tokenizer(path)
        self._cores: dict[str, bytes] = {}
        special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self._special = re.compile("|".join(map(re.escape, special)) or "(?!)").search
        apart = [*self.tok.encode("a", add_special_tokens=False).ids, *self.tok.encode("b", add_special_tokens=False).ids]
        if any(set(" \n") & set(s) for s in special) or any(
                self.tok.encode(f"a{space}b", add_special_tokens=False).ids != apart for space in " \n"):
            raise ValueError("this vocabulary does not drop white space")
        # ids ascend in the order of merges; the last byte of a token that ends a word is another one
        self._letters = None
        byte_of = {symbol: b for b, symbol in enumerate(byte_symbols()) if chr(b) in "abcdefghijklmnopqrstuvwxyz\xc3" or 0x80 <= b < 0xC0}
        ranks = {}
        for token, rank in self.tok.get_vocab().items():
            name = token.removesuffix("</w>")
            if name and all(c in byte_of for c in name) and (name == token or name[-1] != "\xc3"):
                raw = bytes(byte_of[c] for c in name)
                ranks[raw if name == token else _closed(raw)] = rank
        if len([r for r in ranks if len(r) == 1]) == 26 + 1 + 64 + 26 + 64:
            import tiktoken

            self._letters = tiktoken.Encoding("letters", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})

    def _ids(self, piece: str) -> bytes:
        return self._packed(self.tok.encode(piece, add_special_tokens=False).ids)

    def _packed(self, ids: list[int]) -> bytes:
        out = array(self._kind, ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def _core(self, piece: str) -> bytes:
        latin = self._letters is not None and _LATIN_1(piece)
        key = piece.lower() if latin or piece.isascii() else piece
        got = self._cores.get(key)
        if got is None:
            # one piece: the pattern has nothing to cut
            got = self._packed(self._letters._encode_single_piece(_closed(key.encode()))) if latin else self._ids(piece)
            if len(self._cores) < REMEMBERED and len(key) <= LONGEST_REMEMBERED:
                self._cores[key] = got
        return got

    def __missing__(self, piece: str) -> bytes:
        if self._special(piece):
            got = self._ids(piece)
        elif piece.isalpha() or not (cut := _CORE.match(piece)):
            got = self._core(piece)
        else:
            got = self._core(cut[0]) + self._core(piece[cut.end():])
        if len(self) < REMEMBERED and len(piece) <= LONGEST_REMEMBERED:
            self[piece] = got
        return got

    def encode(self, text: str | None) -> bytes:
        """Packed ids of a whole text (null: empty)."""
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" "))) if text else b""


class ByteEncoder:
    """Packed ids for a byte-level vocabulary (``byte_bpe_50k``), by its rank file.

    Texts that hold a special token's string go to the library, which gives it
    the special id; all others are encoded from the ranks, which is faster.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        self.tok = load_tokenizer(path)
        self._special = tuple(t.content for t in self.tok.get_added_tokens_decoder().values())
        with open(path.removesuffix(".json") + ".tiktoken", "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._ranks = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text (null: empty) as little-endian unsigned 32-bit integers."""
        if not text:
            return np.zeros(0, "<u4")
        if any(s in text for s in self._special):
            return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4")
        return np.array(self._ranks.encode_ordinary(text), "<u4")


@functools.lru_cache(maxsize=1)
def word_encoder(path: str, dtype: str) -> WordEncoder:
    """The encoder of this Python worker: what it remembers serves the worker's later tasks too."""
    return WordEncoder(path, dtype)


@functools.lru_cache(maxsize=1)
def byte_encoder(path: str) -> ByteEncoder:
    """The encoder of this Python worker."""
    return ByteEncoder(path)
