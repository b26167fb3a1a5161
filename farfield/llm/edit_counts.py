"""Token counts that follow edits: segment trees over a document's pre-tokens, re-encoding only what edits touch."""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farfield.llm.common import small_batches

#: In texts of these characters only, PIECE finds the same pre-tokens as the tokenizer's own pattern.
PLAIN = re.compile(r"[\t-\r -~À-ÖØ-öø-ÿ]*")
PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[^\sA-Za-zÀ-ÖØ-öø-ÿ0-9]+|\s+(?!\S)|\s+")
#: Characters before an edit that a pre-token's end may depend on: white space and contractions look so far ahead.
AHEAD = 2
REMEMBERED = 400_000
#: The edits of the registered query: addresses and long numbers are masked.
MASKS = ((re.compile(r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+"), "[MAIL]"), (re.compile(r"\d[\d -]{5,}\d"), "[NUMBER]"))

Edit = tuple[int, int, str]


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Counter:
    """Counts the tokens of pre-tokens, remembering those it has seen."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.known: dict[str, int] = {}

    def pattern_for(self, text: str):
        return PIECE if PLAIN.fullmatch(text) else self.pattern

    def counts(self, pieces: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for piece in {p for p in pieces if p not in known}:
            known[piece] = len(self.encoding._encode_single_piece(piece))
        return np.fromiter((known[p] for p in pieces), dtype=np.int64, count=len(pieces))


class PretokenTree:
    """A segment tree: leaves hold the token counts of pre-tokens, inner nodes their sums."""

    def __init__(self, text: str, counter: Counter):
        self.text, self.counter = text, counter
        pieces = counter.pattern_for(text).findall(text)
        self.n = len(pieces)
        #: starts of the pre-tokens, and the end of the text
        self.bounds = np.zeros(self.n + 1, dtype=np.int64)
        np.cumsum(np.fromiter(map(len, pieces), dtype=np.int64, count=self.n), out=self.bounds[1:])
        level = counter.counts(pieces)
        self.levels = [level]
        while len(level) > 1:
            level = np.add.reduceat(level, np.arange(0, len(level), 2))
            self.levels.append(level)

    @property
    def total(self) -> int:
        return int(self.levels[-1][0]) if self.n else 0

    def replace(self, first: int, last: int, count: int) -> None:
        """The pre-tokens first..last-1 become a region of count tokens, held by the first leaf; sums above follow."""
        leaves = self.levels[0]
        leaves[first:last] = 0
        leaves[first] += count
        lo, hi = first, last
        for below, level in zip(self.levels, self.levels[1:], strict=False):
            lo, hi = lo // 2, (hi + 1) // 2
            level[lo:hi] = np.add.reduceat(below[2 * lo : 2 * hi], np.arange(0, len(below[2 * lo : 2 * hi]), 2))

    def apply(self, edits: list[Edit]) -> tuple[str, int]:
        """Applies (start, end, replacement) edits of the text, sorted and apart; the new text and the pre-tokens re-encoded.

        A region begins with the pre-token that holds the character AHEAD before an edit; from there the pattern
        runs over the new text until it ends a pre-token where an old one ended, behind the region's last edit. What
        follows depends on nothing before, so its pre-tokens stay.
        """
        parts, at = [], 0
        for start, end, new in edits:
            parts += [self.text[at:start], new]
            at = end
        edited = "".join([*parts, self.text[at:]])
        if not edits:
            return edited, 0
        pattern = self.counter.pattern_for(edited)
        shifts = np.concatenate([[0], np.cumsum([len(new) - (end - start) for start, end, new in edits])]).tolist()
        old = self.bounds.tolist()
        done = redone = i = 0
        if not self.n:
            # nothing stood here: all of the new text is the region
            pieces = pattern.findall(edited)
            self.n, self.bounds, self.levels = 1, np.array([0, 0]), [np.zeros(1, dtype=np.int64)]
            self.replace(0, 1, int(self.counter.counts(pieces).sum()))
            return edited, len(pieces)
        while i < len(edits):
            first = max(done, int(np.searchsorted(self.bounds, max(0, edits[i][0] - AHEAD), side="right")) - 1)
            first = min(first, self.n - 1)
            pieces, shift = [], shifts[i]
            place, last = old[first] + shift, None
            i += 1
            for m in pattern.finditer(edited, place):
                while i < len(edits) and m.end() - shifts[i] > edits[i][0] - AHEAD:
                    i += 1  # the next edit is too near to stop before it
                pieces.append(m.group())
                back = m.end() - shifts[i]
                if back >= edits[i - 1][1]:
                    k = int(np.searchsorted(self.bounds, back))
                    if k <= self.n and old[k] == back and k > first:
                        last = k
                        break
            last = self.n if last is None else last
            if last == self.n:
                i = len(edits)
            self.replace(first, last, int(self.counter.counts(pieces).sum()))
            redone += len(pieces)
            done = last
        return edited, redone


def mask_edits(text: str) -> list[Edit]:
    """Where MASKS match: edits in order, the first pattern first where two overlap."""
    found: list[Edit] = []
    for pattern, new in MASKS:
        found += [(m.start(), m.end(), new) for m in pattern.finditer(text)]
    out, at = [], 0
    for edit in sorted(found, key=lambda e: e[0]):
        if edit[0] >= at:
            out.append(edit)
            at = edit[1]
    return out


_counters: dict[str, Counter] = {}


def edit_counts(docs: DataFrame, edits_of: Callable[[str], list[Edit]] = mask_edits, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """One row per document: id, n_pretokens, n_tokens, n_edits, n_reencoded (pre-tokens), n_tokens_edited.

    Counts are those of the whole texts before and after the edits. Null texts count as empty; rows that share an id
    are counted each; an empty table gives an empty result; other columns are ignored.
    """
    path = path or vocabulary_path()
    names = ["id", "n_pretokens", "n_tokens", "n_edits", "n_reencoded", "n_tokens_edited"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _counters:
            _counters[path] = Counter(path)
        counter = _counters[path]
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                tree, edits = PretokenTree(text or "", counter), edits_of(text or "")
                n, before = tree.n, tree.total
                rows.append((n, before, len(edits), tree.apply(edits)[1], tree.total))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([r[i] for r in rows], type=pa.int64()) for i in range(5)]], names=names)

    small_batches(docs.sparkSession)
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
    return own.mapInArrow(count, ", ".join(f"{n} long" for n in names)).withColumnRenamed("id", id_col)
