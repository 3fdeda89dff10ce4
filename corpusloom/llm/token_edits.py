"""Edit-aware token counts.

A document's state is its pre-token list (byte-pair tokens never cross
pre-tokens) with a segment tree over their token counts.  An edit re-splits
only from a little before its start to the first old pre-token border behind it
where the splits agree again, re-encodes those pre-tokens, and updates the sums
of the leaves that changed.  The pre-token pattern looks ahead by one character
past a pre-token only and never behind, so borders that agree stay in step.

The tree's leaves are blocks of pre-tokens; an edit rewrites the blocks that it
touches and the sums on their paths.

Cases: a null text is empty (no tokens); edits out of range are clipped to the
text; edits apply in order, each to the result of the one before; repeated rows
are counted each; an empty table gives no rows; texts of any length are counted
whole; extra columns are not read, and the result has its own columns only.
"""

from __future__ import annotations

import base64
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

from .common import chunks

#: The published pre-token pattern of the byte-level vocabularies.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
BLOCK, BACK, MEMO = 64, 4, 200_000


class Memo(dict):
    """Token counts of short pre-tokens; emptied when full."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, piece: str) -> int:
        n = len(self.encode(piece))
        if len(piece) < 64:
            if len(self) >= MEMO:
                self.clear()
            self[piece] = n
        return n


class Counter:
    """Token counts of pre-tokens by a rank file's vocabulary, with a bounded memo."""

    def __init__(self, ranks: bytes):
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.encode = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=table, special_tokens={}).encode_ordinary
        pattern = regex.compile(PATTERN)
        self.find, self.iter = pattern.findall, pattern.finditer
        self.one = Memo(self.encode).__getitem__

    def whole(self, text: str) -> int:
        return len(self.encode(text))


class Tree:
    """Pre-token lengths and token counts of a text, in blocks with their sums."""

    def __init__(self, text: str, counter: Counter):
        self.text, self.counter = text, counter
        pieces = counter.find(text)
        self.n_pretokens = len(pieces)
        self._blocks(list(map(len, pieces)), list(map(counter.one, pieces)))
        self.reencoded = 0

    def _blocks(self, lens: list[int], counts: list[int]) -> None:
        at = range(0, len(lens), BLOCK)
        self.leaf_lens, self.leaf_counts = [lens[i : i + BLOCK] for i in at], [counts[i : i + BLOCK] for i in at]
        # Levels above the blocks: each node sums two below, so an update touches one path.
        self.levels = [list(zip(map(sum, self.leaf_lens), map(sum, self.leaf_counts), strict=True))]
        while len(self.levels[-1]) > 1:
            low = self.levels[-1]
            self.levels.append([(low[i][0] + (low[i + 1][0] if i + 1 < len(low) else 0), low[i][1] + (low[i + 1][1] if i + 1 < len(low) else 0)) for i in range(0, len(low), 2)])

    @property
    def total(self) -> int:
        return self.levels[-1][0][1] if self.levels[-1] else 0

    def _find(self, pos: int) -> tuple[int, int]:
        """The leaf that holds character ``pos`` and the leaf's first character, by descent from the root."""
        i = start = 0
        for level in range(len(self.levels) - 1, 0, -1):
            i *= 2
            low = self.levels[level - 1]
            if pos >= start + low[i][0] and i + 1 < len(low):
                start += low[i][0]
                i += 1
        return i, start

    def _update(self, leaf: int) -> None:
        self.levels[0][leaf] = (sum(self.leaf_lens[leaf]), sum(self.leaf_counts[leaf]))
        i = leaf
        for level in range(1, len(self.levels)):
            i //= 2
            low = self.levels[level - 1]
            a = low[2 * i]
            b = low[2 * i + 1] if 2 * i + 1 < len(low) else (0, 0)
            self.levels[level][i] = (a[0] + b[0], a[1] + b[1])

    def edit(self, start: int, length: int, new: str) -> int:
        """Replaces ``length`` characters at ``start``; returns the token total."""
        old = self.text
        start = max(0, min(start, len(old)))
        end = max(start, min(start + max(0, length), len(old)))
        text = old[:start] + new + old[end:]
        if not self.leaf_lens:
            done = self.reencoded
            self.__init__(text, self.counter)
            self.reencoded = done + self.n_pretokens
            return self.total
        # Back to a border at least BACK characters before the edit.
        leaf, at = self._find(max(0, start - BACK))
        borders = [at]
        for x in self.leaf_lens[leaf]:
            borders.append(borders[-1] + x)
        k = bisect_right(borders, max(0, start - BACK)) - 1
        k = min(k, len(borders) - 2)
        if k > 0:
            k -= 1
        first, shift = borders[k], len(new) - (end - start)
        # New pre-tokens until a border that the old text also has behind the edit.
        lens, counts, pos, tail = [], [], first, start + len(new)
        old_leaf, old_k, old_at = leaf, k, first
        synced = False
        for m in self.counter.iter(text, first):
            lens.append(m.end() - m.start())
            counts.append(self.counter.one(m.group()))
            pos = m.end()
            if pos >= tail:
                while old_at < pos - shift and old_leaf < len(self.leaf_lens):
                    if old_k >= len(self.leaf_lens[old_leaf]):
                        old_leaf, old_k = old_leaf + 1, 0
                        continue
                    old_at += self.leaf_lens[old_leaf][old_k]
                    old_k += 1
                if old_at == pos - shift and old_at >= end:
                    synced = True
                    break
        if not synced:
            old_leaf, old_k = len(self.leaf_lens) - 1, len(self.leaf_lens[-1])
        self.reencoded += len(lens)
        self.text = text
        # Leaves leaf..old_leaf are replaced; in place where the result still fits.
        old_leaf = min(old_leaf, len(self.leaf_lens) - 1)
        head_l, head_c = self.leaf_lens[leaf][:k], self.leaf_counts[leaf][:k]
        new_l = head_l + lens + self.leaf_lens[old_leaf][old_k:]
        new_c = head_c + counts + self.leaf_counts[old_leaf][old_k:]
        slots = old_leaf - leaf + 1
        if len(new_l) <= 4 * BLOCK * slots:
            step = -(-len(new_l) // slots) if new_l else 1
            for i in range(slots):
                self.leaf_lens[leaf + i] = new_l[i * step : (i + 1) * step]
                self.leaf_counts[leaf + i] = new_c[i * step : (i + 1) * step]
                self._update(leaf + i)
        else:
            flat = lambda of, mid: [x for b in of[:leaf] for x in b] + mid + [x for b in of[old_leaf + 1 :] for x in b]
            self._blocks(flat(self.leaf_lens, new_l), flat(self.leaf_counts, new_c))
        return self.total


def count_edits(docs: DataFrame, vocab_path: str, rows: int = 512) -> DataFrame:
    """Token counts before and after the ``edits`` of each row.

    ``docs`` has doc_id, text and edits (array of struct start, length, text, by
    characters).  Returns doc_id, n_pretokens, n_tokens, n_edits, n_reencoded
    (pre-tokens that the edits encoded anew) and n_tokens_edited.
    """
    with open(vocab_path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value)
        names = ["doc_id", "n_pretokens", "n_tokens", "n_edits", "n_reencoded", "n_tokens_edited"]
        for b in chunks(batches, rows):
            out: list[list[int]] = [[] for _ in names[1:]]
            for text, edits in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                tree = Tree(text or "", counter)
                before, pieces = tree.total, tree.n_pretokens
                todo = [e for e in edits or [] if e is not None]
                for e in todo:
                    tree.edit(e["start"] or 0, e["length"] or 0, e["text"] or "")
                for col, v in zip(out, (pieces, before, len(todo), tree.reencoded, tree.total), strict=True):
                    col.append(v)
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(x, pa.int64()) for x in out]], names)

    return docs.selectExpr("cast(doc_id as long) doc_id", "text", "edits").mapInArrow(run, "doc_id long, n_pretokens long, n_tokens long, n_edits long, n_reencoded long, n_tokens_edited long")
