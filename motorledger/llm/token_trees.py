"""Edit-aware token counts: a segment tree over the pre-tokens of every document.

The leaves of a document's tree are runs of pre-tokens; a node holds the characters and the
tokens below it. An edit finds its leaves by descending the tree, goes back to a boundary that
the edit cannot have moved, and pre-tokenises and encodes from there until the new boundaries
fall on old ones again. Only those leaves are replaced, and only the sums above them change.
The tokenizer's added tokens, such as an end mark, are cut out of a text before the pattern is
used, as the library does; each is a pre-token of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motorledger.llm.tokens import REMEMBERED, encoder, tokenizer_path

#: The pre-token pattern of byte-level BPE. Fixed value of the tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LEAF = 32  # pre-tokens in a new leaf
#: A pre-token is settled once so many characters behind it are unchanged (longest look-ahead),
#: and as many more as an added token that reaches into the change can have in front of it.
CONTEXT = 3
_PRE = regex.compile(PATTERN)
_counts: dict[str, dict[str, int]] = {}


class Counter:
    """Tokens per pre-token, remembered by the worker."""

    def __init__(self, path: str):
        self.tokenizer = encoder(path).tokenizer
        added = [t for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        if any(t.lstrip or t.rstrip or t.single_word for t in added):
            raise ValueError("added tokens that depend on the characters beside them are not handled")
        names = sorted((t.content for t in added), key=len, reverse=True)  # the longest one counts
        self.added = regex.compile("|".join(map(regex.escape, names))) if names else None
        self.context = CONTEXT + max(map(len, names), default=1) - 1
        self.known = _counts.setdefault(path, {})
        self.encoded = 0

    def __call__(self, parts: list[str]) -> np.ndarray:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        found = np.fromiter(map(self.known.get, parts, repeat(-1)), np.int64, len(parts))
        if len(at := np.flatnonzero(found < 0)):
            missing = list(dict.fromkeys(parts[i] for i in at.tolist()))
            done = self.tokenizer.encode_batch_fast(missing, add_special_tokens=False)
            self.known.update(zip(missing, [len(e.ids) for e in done]))
            self.encoded += len(missing)
            found[at] = [self.known[parts[i]] for i in at.tolist()]
        return found


def _pre_tokens(text: str, begin: int, count: Counter) -> Iterator[regex.Match]:
    """Pre-tokens from the boundary ``begin`` on; look-ahead ends at an added token."""
    for mark in count.added.finditer(text, begin) if count.added else ():
        yield from _PRE.finditer(text, begin, mark.start())
        yield mark
        begin = mark.end()
    yield from _PRE.finditer(text, begin)


def _parts(text: str, count: Counter) -> list[str]:
    if count.added and count.added.search(text):
        return [found.group() for found in _pre_tokens(text, 0, count)]
    return _PRE.findall(text)


class Tree:
    """Heap-shaped sums: row 1 is the root, leaves start at ``self.base``; columns are characters, tokens."""

    def __init__(self, leaves: np.ndarray):
        self.count = len(leaves)
        self.base = 1 << max(0, self.count - 1).bit_length()
        self.sums = np.zeros((2 * self.base, 2), np.int64)
        self.sums[self.base : self.base + self.count] = leaves
        self._sum(self.base)

    def _sum(self, below: int) -> None:
        while below > 1:
            row = self.sums[below : 2 * below].reshape(-1, 2, 2).sum(1)
            below //= 2
            self.sums[below : 2 * below] = row

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    @property
    def leaves(self) -> np.ndarray:
        return self.sums[self.base : self.base + self.count]

    def find(self, at: int) -> tuple[int, int]:
        """The leaf that holds character ``at`` (the last one at the end) and the characters before it."""
        node, before = 1, 0
        while node < self.base:
            node *= 2
            left = int(self.sums[node, 0])
            if at - before >= left:
                before += left
                node += 1
        leaf = node - self.base
        if leaf >= self.count:
            leaf, before = self.count - 1, int(self.sums[1, 0] - self.leaves[self.count - 1, 0]) if self.count else 0
        return max(leaf, 0), before

    def replace(self, first: int, stop: int, new: np.ndarray) -> None:
        """Put ``new`` in place of the leaves from ``first`` to ``stop``; sums above them are renewed."""
        if len(new) == stop - first:  # the shape stays: walk up from the changed leaves only
            low, high = self.base + first, self.base + stop
            self.sums[low:high] = new
            while low > 1 and high > low:
                low, high = low // 2, (high - 1) // 2 + 1
                self.sums[low:high] = self.sums[2 * low : 2 * high].reshape(-1, 2, 2).sum(1)
            return
        self.__init__(np.concatenate([self.leaves[:first], new, self.leaves[stop:]]))


def _leaves(parts: list[str], count: Counter) -> np.ndarray:
    if not parts:
        return np.zeros((0, 2), np.int64)
    pairs = np.stack([np.fromiter(map(len, parts), np.int64, len(parts)), count(parts)], axis=1)
    return np.add.reduceat(pairs, np.arange(0, len(parts), LEAF), axis=0)


def build(text: str, count: Counter) -> Tree:
    return Tree(_leaves(_parts(text, count), count))


def apply_edit(text: str, tree: Tree, start: int, stop: int, new: str, count: Counter) -> tuple[str, int]:
    """Replace ``text[start:stop]`` by ``new`` and bring ``tree`` up to date; the text and the characters re-read.

    Places outside the text are moved to its ends.
    """
    start = min(max(start, 0), len(text))
    stop = min(max(stop, start), len(text))
    edited = text[:start] + new + text[stop:]
    if not tree.count:
        fresh = _leaves(_parts(edited, count), count)
        tree.__init__(fresh)
        return edited, len(edited)
    first, begin = tree.find(max(start - count.context, 0))
    # a leaf's first boundary counts as settled only if the context behind it is unchanged
    while first > 0 and begin + count.context > start:
        first -= 1
        begin -= int(tree.leaves[first, 0])
    if first == 0:
        begin = 0
    elif begin + count.context > start:
        first, begin = 0, 0
    shift = len(new) - (stop - start)
    last, last_begin = tree.find(stop)
    ends: dict[int, int] = {}  # old leaf ends behind the edit, in new places
    end, probe = last_begin, last
    parts: list[str] = []
    at, settled = begin, None
    for found in _pre_tokens(edited, begin, count):
        parts.append(found.group())
        at = found.end()
        if at < start + len(new):
            continue
        while probe < tree.count and end + shift < at:
            end += int(tree.leaves[probe, 0])
            probe += 1
            ends[end + shift] = probe
        if at in ends and at >= stop + shift:
            settled = ends[at]
            break
    tree.replace(first, tree.count if settled is None else settled, _leaves(parts, count))
    return edited, at - begin


def pack(tree: Tree) -> bytes:
    """The stored form of a tree: characters and tokens of its leaves."""
    return tree.leaves.astype("<u4").tobytes()


def unpack(data: bytes) -> Tree:
    return Tree(np.frombuffer(data, "<u4").reshape(-1, 2).astype(np.int64))


def _tree_column(path: str):
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        count = Counter(path)
        for texts in parts:
            yield pa.array([pack(build(t or "", count)) for t in texts.to_pylist()], pa.binary())

    run.__annotations__ = {"parts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "binary")


def with_trees(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Every row with a column ``tree``, to be stored beside the text; a null text has an empty tree.

    A column of that name is replaced; a repeated row gets its tree twice; an empty table stays empty.
    """
    return docs.withColumn("tree", _tree_column(path or tokenizer_path())(F.col("text").cast("string")))


_DONE = "n_before long, n_after long, n_edits int, n_reread long, n_chars long, tree binary, edited string"


def _edit_column(path: str, keep_text: bool):
    def run(parts: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        count = Counter(path)
        for texts, trees, edits in parts:
            rows = []
            for text, data, changes in zip(texts.to_pylist(), trees.to_pylist(), edits.to_pylist()):
                text, tree = text or "", unpack(data or b"")
                before, reread, done = tree.tokens, 0, 0
                for change in changes or []:
                    if change is None or change["start"] is None or change["stop"] is None:
                        continue
                    text, seen = apply_edit(text, tree, change["start"], change["stop"], change["new"] or "", count)
                    reread += seen
                    done += 1
                rows.append((before, tree.tokens, done, reread, len(text), pack(tree), text if keep_text else None))
            columns = list(zip(*rows)) if rows else [()] * 7
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.string()]
            names = ["n_before", "n_after", "n_edits", "n_reread", "n_chars", "tree", "edited"]
            yield pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    run.__annotations__ = {"parts": Iterator[tuple[pa.Array, pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, _DONE)


def edited_counts(trees: DataFrame, edits: Column, path: str | None = None, keep_text: bool = True) -> DataFrame:
    """Every row of ``trees`` (``text`` and ``tree``) with a column ``q`` of what the edits did.

    ``edits`` is an array of structs ``start``, ``stop``, ``new``, in characters of the text as it is
    after the edits in front of it. Null edits, and edits without a place, change nothing; a null
    ``new`` deletes; places outside the text are moved to its ends. ``q`` has ``n_before`` and ``n_after``
    tokens, ``n_edits`` applied, ``n_reread`` characters looked at again, ``n_chars``, the new ``tree`` and text.
    A repeated row is edited twice with one result; a column of ``trees`` named ``q`` is replaced.
    """
    done = _edit_column(path or tokenizer_path(), keep_text)(F.col("text").cast("string"), F.col("tree"), edits)
    rows = trees.select(F.struct("*").alias("doc"), done.alias("q"))
    return rows.select(*[F.col("doc").getField(c).alias(c) for c in trees.columns if c.lower() != "q"], "q")
