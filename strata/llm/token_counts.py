"""Edit-aware token counts: a kept tree of pre-tokens per document, re-encoded only where edits touch it.

A document's pre-tokens are the leaves of a tree, ``BLOCK`` to a bottom node;
every node knows the characters and tokens below it.  An edit finds its place by
descending along the character sums.  Pre-tokens that end at least ``CONTEXT``
characters before the edit cannot have looked at it and stay; from there the
text is cut into pre-tokens again until a cut falls on an old one behind the
edit, after which everything is as before.  Only those pre-tokens are encoded,
and the sums on the way to the root are updated.

Trees are kept: :func:`build_trees` encodes every text once and gives a table of
leaves (``doc_id, text, lengths, tokens``), which its caller writes.
:func:`apply_edits` joins edits to such a table and gives the table after them;
it restores a tree from its leaves without cutting or encoding the text, so
every later round encodes what its own edits touch and no more.

Token counts are those of a byte-level vocabulary (``byte_bpe_50k``) for
ordinary text: special tokens' strings count as text.

Defined results: a null text counts as empty (0 tokens); null or no edits leave a
document as it is; null places count as 0 and null additions as empty; an edit
reaching past the end stops there; edits apply one after the other (by ``seq``, then
by their other values where that repeats), each to the text that the one before
left; edits of an unknown or null id touch nothing; every row of a repeated id gets
that id's edits; repeated rows and null ids keep their rows; empty tables give
empty tables; other columns are not read.  A very long text is one row and one tree; all
edits of one document are one task's work, since each needs the one before.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Callable, Iterator
from itertools import accumulate, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.tokens import LONGEST_REMEMBERED, REMEMBERED, tokenizer_path

VOCABULARY = "byte_bpe_50k.tiktoken"
BLOCK = 32
CONTEXT = 3  # a cut depends on at most two characters behind it ('re, white space before a word)
#: The edits of the query: what is replaced by what, first match first.
REDACTIONS = (("mail", r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+", "[MAIL]"), ("address", r"\b\d{1,3}(?:\.\d{1,3}){3}\b", "[ADDRESS]"),
              ("key", r"\b[0-9a-f]{32,}\b", "[KEY]"), ("number", r"\+?\d[\d ()-]{7,}\d", "[NUMBER]"))
Edit = tuple[int, int, str]  # start, characters removed, what is added
TREES = "doc_id long, text string, lengths array<int>, tokens array<int>"
EDITED = TREES + ", n_tokens_before long, n_edits long, n_chars long, n_tokens long, encoded_chars long"


class PreTokens(dict):
    """Cuts texts into pre-tokens and counts the tokens of each; remembers counts (bounded)."""

    def __init__(self, path: str):
        super().__init__()
        import public_tokenizers
        import regex
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._encode = tiktoken.Encoding("counts", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                         special_tokens={}).encode_ordinary
        self._pattern = regex.compile(public_tokenizers.PATTERN)
        self.cut = self._pattern.findall

    def __missing__(self, pre_token: str) -> int:
        n = len(self._encode(pre_token))
        if len(self) < REMEMBERED and len(pre_token) <= LONGEST_REMEMBERED:
            self[pre_token] = n
        return n

    def pieces(self, text: str) -> Iterator[str]:
        """The pre-tokens of a text one by one."""
        return (m.group() for m in self._pattern.finditer(text))


@functools.lru_cache(maxsize=1)
def pre_tokens(path: str) -> PreTokens:
    """The counts that this Python worker remembers."""
    return PreTokens(path)


class CountTree:
    """Pre-tokens of one document with sums over a binary tree of blocks."""

    def __init__(self, words: list[str], counts: list[int], pre: PreTokens):
        self.pre = pre
        self.encoded_chars = 0
        self._build(*([some[i:i + BLOCK] for i in range(0, len(some), BLOCK)] or [[]] for some in (words, counts)))

    @classmethod
    def of_text(cls, text: str, pre: PreTokens) -> CountTree:
        """The tree of a new text, all of which is encoded."""
        words = pre.cut(text)
        return cls(words, [pre[w] for w in words], pre)

    @classmethod
    def of_leaves(cls, text: str, lengths: list[int], tokens: list[int], pre: PreTokens) -> CountTree:
        """A kept tree; nothing is cut or encoded."""
        return cls([text[a:b] for a, b in pairwise(accumulate(lengths, initial=0))], tokens, pre)

    def leaves(self) -> tuple[str, list[int], list[int]]:
        """``text, lengths, tokens``: what keeps the tree."""
        return self.text(), [len(w) for b in self.blocks for w in b], [n for b in self.counts for n in b]

    def _build(self, blocks: list[list[str]], counts: list[list[int]]) -> None:
        self.blocks, self.counts = blocks, counts
        self.half = 1 << max(0, len(blocks) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.half), [0] * (2 * self.half)
        for i in range(len(blocks)):
            self._sum_block(i)
        for node in range(self.half - 1, 0, -1):
            self._sum_node(node)

    def _sum_block(self, i: int) -> None:
        self.chars[self.half + i] = sum(map(len, self.blocks[i]))
        self.tokens[self.half + i] = sum(self.counts[i])

    def _sum_node(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    def text(self) -> str:
        return "".join(w for b in self.blocks for w in b)

    def _find(self, at: int) -> tuple[int, int]:
        """The block that holds character ``at`` (the last one for the end), and where it starts."""
        node, start = 1, 0
        while node < self.half:
            node *= 2
            if at >= start + self.chars[node] and self.chars[node + 1]:
                start += self.chars[node]
                node += 1
        return min(node - self.half, len(self.blocks) - 1), start

    def edit(self, start: int, removed: int, added: str) -> None:
        """Replace ``removed`` characters from ``start`` on by ``added``."""
        start = min(max(0, start), self.n_chars)
        end = min(start + max(0, removed), self.n_chars)
        first, at = self._find(max(0, start - CONTEXT - 1))
        # go back to a cut that nothing in the edit could have moved
        words, kept = self.blocks[first], 0
        head = at
        while kept < len(words) and head + len(words[kept]) <= start - CONTEXT:
            head += len(words[kept])
            kept += 1
        if kept == 0 and head > start - CONTEXT and first:
            first -= 1
            words = self.blocks[first]
            head -= self.chars[self.half + first]
            while kept < len(words) and head + len(words[kept]) <= start - CONTEXT:
                head += len(words[kept])
                kept += 1
        # old words from the cut on, as far as the edit reaches and then as far as needed
        shift = len(added) - (end - start)
        block, inside, reach, old = first, kept, head, []
        cuts: set[int] = set()

        def take(until: int) -> None:
            nonlocal block, inside, reach
            while reach < until and block < len(self.blocks):
                if inside >= len(self.blocks[block]):
                    if block + 1 >= len(self.blocks):
                        return
                    block, inside = block + 1, 0
                    continue
                word = self.blocks[block][inside]
                old.append(word)
                reach += len(word)
                inside += 1
                if reach >= end:
                    cuts.add(reach + shift)

        ahead = 64
        while True:
            take(end + ahead)
            joined = "".join(old)
            new_text = joined[:start - head] + added + joined[end - head:]
            whole = reach >= self.n_chars
            new, place, settled = [], head, False
            for word in self.pre.pieces(new_text):
                # the last characters taken may be cut otherwise by what follows them
                if not whole and place + len(word) > reach + shift - CONTEXT:
                    break
                new.append(word)
                place += len(word)
                if place in cuts and place >= start + len(added):
                    settled = True
                    break
            if settled or whole:
                break
            ahead *= 4
        # put the new words in the place of the old ones up to the settled cut
        gone = place - shift if settled else reach
        block, inside, reach = first, kept, head
        while reach < gone:
            if inside >= len(self.blocks[block]):
                block, inside = block + 1, 0
                continue
            reach += len(self.blocks[block][inside])
            inside += 1
        self.encoded_chars += sum(map(len, new))
        changed = range(first, block + 1)
        for leaves, middle in ((self.blocks, new), (self.counts, [self.pre[w] for w in new])):
            whole_block = leaves[first][:kept] + middle + leaves[block][inside:]
            for i in changed:
                leaves[i] = []
            leaves[first] = whole_block
        if len(self.blocks[first]) > 4 * BLOCK:
            self._build(*([b for b in (*leaves[:first], *[leaves[first][i:i + BLOCK] for i in range(0, len(leaves[first]), BLOCK)],
                                       *leaves[first + 1:]) if b] for leaves in (self.blocks, self.counts)))
            return
        above = set()
        for i in changed:
            self._sum_block(i)
            above.add((self.half + i) // 2)
        while above and 0 not in above:
            for node in above:
                self._sum_node(node)
            above = {node // 2 for node in above}


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


_LEAVES = [("doc_id", pa.int64()), ("text", pa.string()), ("lengths", pa.list_(pa.int32())), ("tokens", pa.list_(pa.int32()))]
_SUMS = [(name, pa.int64()) for name in ("n_tokens_before", "n_edits", "n_chars", "n_tokens", "encoded_chars")]

ROWS = 64  # rows of a batch whose leaves are held at a time


def _lists(column: pa.ListArray) -> list[np.ndarray]:
    """The lists of a column without nulls, as arrays over its own memory."""
    bounds = column.offsets.to_numpy()
    values = column.values.to_numpy()
    return [values[a:b] for a, b in pairwise(bounds.tolist())]


def build_trees(documents: DataFrame, path: str | None = None) -> DataFrame:
    """The kept tree of every document: ``doc_id, text, lengths, tokens`` (of its pre-tokens, in order)."""
    path = path or tokenizer_path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pre, schema = pre_tokens(path), pa.schema(_LEAVES)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                out = []
                for doc_id, text in zip(*(c.to_pylist() for c in batch.slice(start, ROWS).columns), strict=True):
                    words = pre.cut(text or "")
                    out.append((doc_id, text or "", np.fromiter(map(len, words), np.int32, len(words)),
                                np.fromiter(map(pre.__getitem__, words), np.int32, len(words))))
                yield _batch(out, schema)

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, TREES)


def _edited(trees: DataFrame, edits_of: Callable[[], Callable[[str, list | None], list[Edit]]], path: str | None, keep: bool = True) -> DataFrame:
    """``trees`` after the edits that ``edits_of()`` finds for a text and its ``edits`` column, with their sums."""
    path = path or tokenizer_path(VOCABULARY)
    schema = pa.schema([_LEAVES[0], *(_LEAVES[1:] if keep else ()), *_SUMS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pre, edits_for = pre_tokens(path), edits_of()
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                out, part = [], batch.slice(start, ROWS)
                lengths_of, tokens_of = (_lists(c) for c in part.columns[2:4])
                for row, (doc_id, text, given) in enumerate(zip(*(part.column(k).to_pylist() for k in (0, 1, 4)), strict=True)):
                    edits, lengths, tokens = edits_for(text, given), lengths_of[row], tokens_of[row]
                    encoded, before = 0, int(tokens.sum())
                    chars, after = len(text), before
                    if edits:
                        tree = CountTree.of_leaves(text, lengths.tolist(), tokens.tolist(), pre)
                        for e in edits:
                            tree.edit(*e)
                        encoded, chars, after = tree.encoded_chars, tree.n_chars, tree.n_tokens
                        if keep:
                            text, lengths, tokens = tree.leaves()
                    out.append((doc_id, *((text, lengths, tokens) if keep else ()), before, len(edits), chars, after, encoded))
                yield _batch(out, schema)

    given = trees if "edits" in trees.columns else trees.withColumn("edits", F.lit(None).cast("array<int>"))
    columns = EDITED if keep else "doc_id long, " + EDITED.removeprefix(TREES + ", ")
    return given.select("doc_id", "text", "lengths", "tokens", "edits").mapInArrow(run, columns)


def apply_edits(trees: DataFrame, edits: DataFrame, path: str | None = None) -> DataFrame:
    """A table of trees after ``edits`` (``doc_id, seq, start, removed, added``), with the sums of every document.

    ``n_tokens_before``, ``n_edits``, ``n_chars``, ``n_tokens``, and ``encoded_chars``: the
    characters that the edits made the tree encode again.  The first four columns are
    the trees for the next round.
    """
    by_document = edits.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("_of")).agg(
        F.sort_array(F.collect_list(F.struct(
            "seq", F.coalesce(F.col("start"), F.lit(0)).cast("int").alias("start"),
            F.coalesce(F.col("removed"), F.lit(0)).cast("int").alias("removed"),
            F.coalesce(F.col("added"), F.lit("")).alias("added")))).alias("edits"))
    leaves = trees.select("doc_id", "text", "lengths", "tokens")
    joined = leaves.join(by_document, F.col("doc_id") == F.col("_of"), "left").drop("_of")
    return _edited(joined, lambda: lambda _, given: [(e["start"], e["removed"], e["added"]) for e in given or ()], path)


def _redactions() -> Callable[[str, list | None], list[Edit]]:
    """Finds the edits that blank out personal data and secrets in a text."""
    import regex

    pattern = regex.compile("|".join(f"(?P<{name}>{p})" for name, p, _ in REDACTIONS))
    any_of = regex.compile(r"[@\d]|[a-f]{32}").search  # every redaction holds one of these
    added = {name: by for name, _, by in REDACTIONS}

    def find(text: str, _: list | None) -> list[Edit]:
        out, shift = [], 0
        for m in pattern.finditer(text) if any_of(text) else ():
            by = added[m.lastgroup]
            out.append((m.start() + shift, m.end() - m.start(), by))
            shift += len(by) - (m.end() - m.start())
        return out

    return find


def redacted(trees: DataFrame, path: str | None = None) -> DataFrame:
    """A table of trees after the redactions of their texts, with sums as :func:`apply_edits` gives them."""
    return _edited(trees.select("doc_id", "text", "lengths", "tokens"), _redactions, path)


def redacted_counts(trees: DataFrame, path: str | None = None) -> DataFrame:
    """The sums alone: token counts of every document before and after its redactions."""
    sums = _edited(trees.select("doc_id", "text", "lengths", "tokens"), _redactions, path, keep=False)
    return sums.select("doc_id", F.col("n_tokens_before").alias("n_tokens"), "n_edits", F.col("n_chars").alias("edited_chars"),
                       F.col("n_tokens").alias("edited_tokens"), "encoded_chars")
