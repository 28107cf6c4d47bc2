"""BPE encoding as a bounded-lookahead streaming transducer, and incremental decoding.

Encoding rests on one fact about merge lists whose parts are made before they
are used: a sequence of tokens is the BPE encoding of a string exactly if every
two neighbours are *compatible*, that is, if no merge across their border would
have been applied before both were complete.  So the last token of every
prefix's encoding follows from the last tokens of shorter prefixes, from left
to right, with one look at each token that ends there.  The encoding of the
whole string is the chain of these last tokens, read back from its end; a token
is *stable*, and emitted, as soon as the chains of all prefixes that a future
token can still start from run through it.

How far back that is, the merge list bounds.  Compare the merging of a text with
that of the same text and more behind it, merge by merge.  Up to some border both
have the same tokens.  The border moves left only when, in one of the two, the token
before it merges with what starts at it; that token, or what it became, then starts
at the new border, so the next such merge has a right part that begins with it,
and a higher rank.  :attr:`Merges.lookahead` is the most bytes that such a chain of
merges of rising rank moves the border.  Tokens of a prefix that end that far before
its end are *stable*: no continuation changes them.  The transducer emits them,
checks that the tokens behind them go on from there, and holds the symbols of two
such windows, however long the text.

Decoding is incremental too: :class:`Decoder` is fed ids and gives text as soon
as it is certain, either as the tokenizers library's ``decode`` does for this
vocabulary (tokens joined by spaces) or as running text, where a state machine
holds back the bytes of an unfinished character.

Texts are read in slices, cut at white space or, where there is none, before a
character that does not compose with the one before it, so that normalisation,
pre-tokens and symbols hold a slice at a time.  (A run of combining marks is one
slice: their order is a matter of the whole run.)  Results equal the library's with
``add_special_tokens=False``.

Defined results: null counts as empty and has no ids; special tokens' strings
give their ids, as in the library; equal texts give equal results; repeated
rows and null ids keep their rows; other columns are not read.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import json
import sys
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.tokens import byte_symbols, tokenizer_path

VOCABULARY = "word_bpe_49k.json"
# Fixed by the vocabulary file: what counts as white space, its pre-token pattern, its end-of-word mark.
WHITE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PRE_TOKEN = rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{WHITE}\p{{L}}\p{{N}}]+"
LONGEST_FIXED = 3  # characters of the longest pre-token that is not a run
END = "</w>"

SLICE = 8192
REMEMBERED = 300_000
LONGEST_REMEMBERED = 32
PAIRS_REMEMBERED = 1_000_000
NEVER = 1 << 60


class Merges:
    """A merge list: ranks, token parts, compatibility, reachability and lookahead."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.vocab: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in [*self.vocab.items(), *self.special.items()]}
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.made: dict[int, int] = {}  # rank at which a token is made; single symbols: -1
        for r, (a, b) in enumerate(spec["model"]["merges"]):
            left, right, whole = self.vocab[a], self.vocab[b], self.vocab[a + b]
            if whole in self.parts or self.made.get(left, -1) >= r or self.made.get(right, -1) >= r:
                raise ValueError("the merge list is not in an order that a transducer can follow")
            self.rank[left, right] = r
            self.parts[whole], self.made[whole] = (left, right), r
        self.size = {t: len(s.removesuffix(END)) for s, t in self.vocab.items()}
        self.longest = max(self.size.values())
        self._fits: dict[int, bool] = {}
        self._right: dict[int, list[tuple[int, int]]] = {}
        self._left: dict[int, list[tuple[int, int]]] = {}
        self.lookahead = self._lookahead()
        # tokens that their own string does not encode to are never used
        self.usable: dict[str, int] = {}
        unusable: set[int] = set()
        for name, t in sorted(self.vocab.items(), key=lambda x: self.made.get(x[1], -1)):
            if t in self.parts:
                a, b = self.parts[t]
                if a in unusable or b in unusable or self._crosses(a, b, self.made[t]):
                    unusable.add(t)
                    continue
            self.usable[name] = t
        # every end of a usable token -> its id where it is a usable token itself, else -1
        self.tails = {name[i:]: -1 for name in self.usable for i in range(len(name) - (len(END) if name.endswith(END) else 0))}
        self.tails.update(self.usable)

    def _lookahead(self) -> int:
        """Most bytes by which a chain of merges of rising rank moves the border of what two texts share."""
        farthest: dict[int, int] = {}  # token -> most bytes of a chain whose first right part begins with it
        waiting: dict[int, list[tuple[int, int]]] = {}
        most = 0
        for (left, right), rank in sorted(self.rank.items(), key=lambda x: -x[1]):
            for token, chain in waiting.pop(rank, ()):  # parts of a right part: there until this rank
                farthest[token] = max(farthest.get(token, 0), chain)
            chain = self.size[left] + farthest.get(left, 0)
            most = max(most, chain)
            for token, until in self._spine(right, 0):
                if until == NEVER:
                    farthest[token] = max(farthest.get(token, 0), chain)
                else:
                    waiting.setdefault(until, []).append((token, chain))
        return most

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """The parts of ``token`` at one edge, outermost first, each with the rank at which it is used up."""
        known = self._left if side == 0 else self._right
        found = known.get(token)
        if found is None:
            found, until, t = [], NEVER, token
            while True:
                found.append((t, until))
                if t not in self.parts:
                    break
                until, t = self.made[t], self.parts[t][side]
            known[token] = found
        return found

    def _crosses(self, left: int, right: int, before: int) -> bool:
        """Whether a merge across the border of two neighbours is applied below rank ``before``.

        A merge of two edge parts is applied while both are there: before the
        left one is used up, and not after the right one is (of equal merges the
        leftmost goes first).
        """
        rank = self.rank
        for x, x_until in self._spine(left, 1):
            for y, y_until in self._spine(right, 0):
                r = rank.get((x, y))
                if r is not None and r < before and r < x_until and r <= y_until:
                    return True
        return False

    @functools.cached_property
    def bytes(self) -> dict[int, bytes]:
        """The bytes of every id in running text, a space at each end of a word."""
        byte = {s: b for b, s in enumerate(byte_symbols())}
        found = {i: bytes(byte[c] for c in n.removesuffix(END)) + b" " * n.endswith(END) for n, i in self.vocab.items()}
        return found | {i: n.encode() for n, i in self.special.items()}

    def compatible(self, left: int, right: int) -> bool:
        pair = left << 20 | right
        known = self._fits.get(pair)
        if known is None:
            known = not self._crosses(left, right, NEVER)
            if len(self._fits) < PAIRS_REMEMBERED:
                self._fits[pair] = known
        return known


class WordTransducer:
    """Encodes one pre-token, fed in pieces of byte symbols; emits tokens once stable."""

    def __init__(self, merges: Merges):
        self.m = merges
        self.buffer = ""  # symbols from position ``base`` on
        self.base = 0
        self.emitted = 0
        self.last: dict[int, tuple[int, int]] = {}  # position -> last token of that prefix, where it starts

    def _extend(self, first: int, stop: int, ending: str) -> None:
        """Find the last token of every prefix that ends at ``first`` to ``stop - 1``."""
        text, base, last, known = self.buffer, self.base, self.last, self.m.tails
        floor = self.emitted
        for end in range(first, stop):
            ends = []
            start = end - 1
            tail = text[start - base:end - base] + ending
            while (token := known.get(tail)) is not None:
                if token >= 0:
                    ends.append((token, start))
                start -= 1
                if start < floor:
                    break
                tail = text[start - base] + tail
            while True:
                token, start = ends.pop()  # the longest first; one of them fits
                if start == 0 or ((before := last.get(start)) is not None and self.m.compatible(before[0], token)):
                    last[end] = (token, start)
                    break

    def _chain(self, end: int) -> list[int]:
        """The tokens from what is emitted to ``end``, which must go on from there."""
        out = []
        while end > self.emitted:
            token, end = self.last[end]
            out.append(token)
        if end != self.emitted:
            raise AssertionError("an emitted token was not stable")
        return out[::-1]

    def feed(self, symbols: str) -> list[int]:
        """Take more symbols, none of them the word's last; return the tokens that are stable now."""
        out: list[int] = []
        step = self.m.lookahead
        for at in range(0, len(symbols), step):
            end = self.base + len(self.buffer)
            piece = symbols[at:at + step]
            self.buffer += piece
            self._extend(end + 1, end + len(piece) + 1, "")
            if end + len(piece) - self.emitted > 2 * step:
                out += self._stable(end + len(piece))
        return out

    def _stable(self, end: int) -> list[int]:
        """The tokens that end at least the lookahead before ``end``."""
        border = end
        while border > end - self.m.lookahead:
            border = self.last[border][1]
        if border <= self.emitted:
            return []
        out = self._chain(border)
        for p in range(self.emitted, border):
            self.last.pop(p, None)
        self.buffer = self.buffer[border - self.base:]
        self.base = self.emitted = border
        return out

    def finish(self, symbol: str) -> list[int]:
        """Take the word's last symbol; return all remaining tokens."""
        end = self.base + len(self.buffer) + 1
        self.buffer += symbol
        self._extend(end, end + 1, END)
        return self._chain(end)


class Encoder(dict):
    """Streams texts to ids; remembers the ids of short pre-tokens (bounded)."""

    def __init__(self, path: str):
        super().__init__()
        import regex

        self.m = Merges(path)
        self._symbols = byte_symbols()
        self._table = str.maketrans({chr(b): s for b, s in enumerate(self._symbols)})
        self._pre = regex.compile(PRE_TOKEN)
        self._letters, self._others = regex.compile(r"\p{L}*"), regex.compile(rf"[^{WHITE}\p{{L}}\p{{N}}]*")
        self._white = regex.compile(f"[{WHITE}]")
        self._special = regex.compile("|".join(regex.escape(s) for s in self.m.special))

    @functools.cached_property
    def _joining(self) -> set[str]:
        """Characters that may compose with the one before them."""
        pairs = (unicodedata.decomposition(chr(c)).split() for c in range(sys.maxunicode + 1))
        seconds = {chr(int(p[1], 16)) for p in pairs if len(p) == 2 and not p[0].startswith("<")}
        return seconds | {chr(c) for c in (*range(0x1161, 0x1176), *range(0x11A8, 0x11C3))}

    def _begins(self, char: str) -> bool:
        """Whether what is before this character has no part in its normal form."""
        if char.isascii():
            return True
        first = unicodedata.normalize("NFD", char)[0]
        return not unicodedata.combining(first) and first not in self._joining

    def _slices(self, text: str, start: int, stop: int) -> Iterator[tuple[str, bool]]:
        """``text[start:stop]`` in order, and whether each slice ends at white space or the end."""
        while stop - start > SLICE:
            found = self._white.search(text, start + SLICE, min(stop, start + 2 * SLICE))
            end = found.start() if found else start + SLICE
            while end < stop and not self._begins(text[end]):
                end += 1
            yield text[start:end], found is not None or end == stop
            start = end
        if start < stop:
            yield text[start:stop], True

    @staticmethod
    def _normal(text: str) -> str:
        if text.isascii():
            return text.lower()
        text = unicodedata.normalize("NFC", text)
        # letter by letter: the library knows no final sigma
        return "".join(c.lower() for c in text) if "Σ" in text else text.lower()

    def _bytes_of(self, text: str) -> str:
        return text.encode("utf-8", "replace").decode("latin-1").translate(self._table)

    def word(self, pre_token: str) -> list[int]:
        """Ids of one pre-token, by the transducer."""
        symbols = self._bytes_of(pre_token)
        t = WordTransducer(self.m)
        return t.feed(symbols[:-1]) + t.finish(symbols[-1])

    def __missing__(self, pre_token: str) -> list[int]:
        got = self.word(pre_token)
        if len(self) < REMEMBERED and len(pre_token) <= LONGEST_REMEMBERED:
            self[pre_token] = got
        return got

    def _plain(self, text: str, start: int, stop: int) -> Iterator[list[int]]:
        """Lists of ids of a stretch without special tokens; a run longer than a slice is fed as it comes."""
        carry, run = "", None  # characters not settled yet; the rest of an open run
        word, held = None, ""  # its transducer, and its last symbol so far
        for part, closed in self._slices(text, start, stop):
            part = carry + self._normal(part)
            at, ids, carry = 0, [], ""
            if run is not None:
                at = run.match(part).end()
                symbols = held + self._bytes_of(part[:at])
                ids, held = word.feed(symbols[:-1]), symbols[-1]
                if at == len(part) and not closed:
                    yield ids
                    continue
                ids, run = ids + word.finish(held), None
            if closed:
                yield ids + [i for w in self._pre.findall(part, at) for i in self[w]]
                continue
            for m in self._pre.finditer(part, at):
                if m.end() < len(part) and m.start() + LONGEST_FIXED <= len(part):
                    ids += self[m[0]]
                    continue
                if m.end() == len(part) and len(m[0]) > max(LONGEST_FIXED, SLICE // 2):
                    run = self._letters if self._letters.match(m[0]).end() else self._others
                    symbols, word = self._bytes_of(m[0]), WordTransducer(self.m)
                    ids, held = ids + word.feed(symbols[:-1]), symbols[-1]
                else:
                    carry = part[m.start():]
                break
            yield ids

    def stream(self, text: str | None) -> Iterator[list[int]]:
        """Lists of ids, in order, a slice's worth at a time."""
        text, start = text or "", 0
        for found in self._special.finditer(text) if "<|" in text else ():
            yield from self._plain(text, start, found.start())
            yield [self.m.special[found[0]]]
            start = found.end()
        yield from self._plain(text, start, len(text))

    def encode(self, text: str | None) -> list[int]:
        return [i for ids in self.stream(text) for i in ids]


@functools.lru_cache(maxsize=1)
def encoder_of(path: str) -> Encoder:
    """The encoder of this Python worker: what it remembers serves the worker's later tasks too."""
    return Encoder(path)


class Decoder:
    """Ids to text, piece by piece.

    ``spaced``: tokens joined by single spaces, as the library's ``decode`` gives
    for a vocabulary without a decoder.  Otherwise running text: bytes of the
    tokens, a space at each end of a word, undecodable bytes as U+FFFD.
    """

    def __init__(self, merges: Merges, spaced: bool = True):
        self.spaced = spaced
        self._names = merges.names
        self._first = True
        self._utf8 = codecs.getincrementaldecoder("utf-8")("replace")
        self._bytes = {} if spaced else merges.bytes

    def feed(self, ids: list[int]) -> str:
        """The text that these ids make certain."""
        if not self.spaced:
            return self._utf8.decode(b"".join([self._bytes[i] for i in ids]))
        text = " ".join([self._names[i] for i in ids])
        if ids and not self._first:
            text = " " + text
        self._first = self._first and not ids
        return text

    def finish(self) -> str:
        """What an unfinished character at the end leaves."""
        return self._utf8.decode(b"", final=True)


def transduce(documents: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids, decoded`` of every document: its ids, and the text they decode to."""
    path = path or tokenizer_path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                ids, texts = [], []
                for text in part.column(1).to_pylist():
                    ids.append(encoder.encode(text))
                    texts.append(Decoder(encoder.m).feed(ids[-1]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(texts, pa.string())],
                                                 names=["doc_id", "ids", "decoded"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, ids array<int>, decoded string")


def round_trip(documents: DataFrame, path: str | None = None) -> DataFrame:
    """Every document encoded and decoded; each slice's ids are decoded and digested as they come.

    ``doc_id, n_tokens, ids_sha256, decoded_sha256`` (tokens joined by spaces), and
    ``running_chars, running_sha256`` of the running text that the byte machine gives.
    """
    path = path or tokenizer_path(VOCABULARY)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, running_chars long, running_sha256 string"
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                n, chars, of_ids, of_text, of_running = 0, 0, hashlib.sha256(), hashlib.sha256(), hashlib.sha256()
                decoder, machine = Decoder(encoder.m), Decoder(encoder.m, spaced=False)
                for ids in encoder.stream(text):
                    if ids:
                        of_ids.update((" " * (n > 0) + " ".join(map(str, ids))).encode())
                        of_text.update(decoder.feed(ids).encode())
                        running = machine.feed(ids)
                        of_running.update(running.encode())
                        n, chars = n + len(ids), chars + len(running)
                of_text.update(decoder.finish().encode())
                rest = machine.finish()
                of_running.update(rest.encode())
                rows.append((doc_id, n, of_ids.hexdigest(), of_text.hexdigest(), chars + len(rest), of_running.hexdigest()))
            cols = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "running_chars", "running_sha256"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
