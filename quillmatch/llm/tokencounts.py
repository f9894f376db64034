"""Token counts that follow edits.

A document is kept as a tree over segments of its text: each leaf has a
segment's length and token count, each inner node the sums below it.  Segments
end where the pre-tokeniser always ends a token, whatever stands around:
between a character and a single white-space character (space or line feed)
that has no white space beside it.  So a document's count is the sum of its
segments' counts.

An edit replaces the characters start to end by a text.  The leaves that it
touches are taken out with one leaf of context on either side; only their text
is encoded anew, cut into segments and put back, and the sums above are
updated on the way (a treap with a priority from a counter's hash, so trees are
repeatable).  A count after an edit costs the touched region and the logarithm
of the number of segments.

Edits refer to the text as the edits before them left it.  An edit that lies
outside of it is cut to it; one with a null bound or with end before start is
left out and counts as none.  Null texts count as empty and have no tokens.
Rows with a null id and repeated rows are counted each.  Edits at one place are
applied in their order.  Texts of any length are counted whole; one without a
safe place is a single segment, and each edit of it costs its length.  Columns
whose names clash with the results', in any case, are replaced.  An empty table
gives an empty one.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import append_columns, as_bytes, texts, tokenizer_path
from .encoding import ByteEncoder, encoder

SEGMENT = 400
#: A place where a segment may end: before a lone space or line feed.
SAFE = re.compile(r"(?<=\S)(?=[ \n]\S)")


def segments(text: str, size: int = SEGMENT) -> list[str]:
    """Pieces of at least size characters (but for the last) that end at safe places."""
    out, at, search = [], 0, SAFE.search
    while len(text) - at > size:
        m = search(text, at + size)
        if not m:
            break
        out.append(text[at : m.start()])
        at = m.start()
    if at < len(text):
        out.append(text[at:])
    return out


class _Node:
    __slots__ = ("chars", "left", "priority", "right", "sum_chars", "sum_tokens", "text", "tokens")

    def __init__(self, text: str, tokens: int, priority: int):
        self.text, self.chars, self.tokens, self.priority = text, len(text), tokens, priority
        self.left: _Node | None = None
        self.right: _Node | None = None
        self.sum_chars, self.sum_tokens = self.chars, tokens

    def pull(self) -> _Node:
        a, b = self.left, self.right
        self.sum_chars = self.chars + (a.sum_chars if a else 0) + (b.sum_chars if b else 0)
        self.sum_tokens = self.tokens + (a.sum_tokens if a else 0) + (b.sum_tokens if b else 0)
        return self


def _merge(a: _Node | None, b: _Node | None) -> _Node | None:
    if a is None or b is None:
        return a or b
    if a.priority > b.priority:
        a.right = _merge(a.right, b)
        return a.pull()
    b.left = _merge(a, b.left)
    return b.pull()


def _split(node: _Node | None, chars: int) -> tuple[_Node | None, _Node | None]:
    """Leaves that begin before the place chars, and the others."""
    if node is None:
        return None, None
    before = node.left.sum_chars if node.left else 0
    if before < chars:
        node.right, rest = _split(node.right, chars - before - node.chars)
        return node.pull(), rest
    first, node.left = _split(node.left, chars)
    return first, node.pull()


def _leaves(node: _Node | None) -> list[_Node]:
    out, stack = [], []
    while node or stack:
        while node:
            stack.append(node)
            node = node.left
        node = stack.pop()
        out.append(node)
        node = node.right
    return out


class TokenTree:
    """A document's segments with their token counts."""

    def __init__(self, count: Callable[[str], int], text: str = "", size: int = SEGMENT, known: list[tuple[int, int]] | None = None):
        """known: lengths and counts of the segments as ``leaves`` gave them, if they were kept."""
        self.count, self.size, self.made, self.encoded = count, size, 0, 0
        if known is not None and sum(n for n, _ in known) == len(text):
            at, nodes = 0, []
            for n, k in known:
                nodes.append(self._node(text[at : at + n], k))
                at += n
            self.root = self._join(nodes)
        else:
            self.root = self._build(text)

    def _node(self, text: str, tokens: int) -> _Node:
        self.made += 1
        return _Node(text, tokens, (self.made * 0x9E3779B97F4A7C15) >> 20 & 0xFFFFFFFF)

    def _join(self, nodes: list[_Node]) -> _Node | None:
        root = None
        for node in nodes:
            root = _merge(root, node)
        return root

    def _build(self, text: str) -> _Node | None:
        self.encoded += len(text)
        return self._join([self._node(s, self.count(s)) for s in segments(text, self.size)])

    @property
    def tokens(self) -> int:
        return self.root.sum_tokens if self.root else 0

    @property
    def chars(self) -> int:
        return self.root.sum_chars if self.root else 0

    @property
    def text(self) -> str:
        return "".join([n.text for n in _leaves(self.root)])

    def leaves(self) -> list[tuple[int, int]]:
        return [(n.chars, n.tokens) for n in _leaves(self.root)]

    def edit(self, start: int, end: int, text: str) -> int:
        """Replaces characters start to end; the document's count after that."""
        start, end = max(0, min(start, self.chars)), max(0, min(end, self.chars))
        head, rest = _split(self.root, start)  # the last leaf of head may reach over start
        middle, tail = _split(rest, max(0, end - (head.sum_chars if head else 0)))
        # context: the leaf that start lies in or that ends at it and the one before it, and the one after
        reach = 0
        for _ in range(2):
            if head:
                cut = head.sum_chars - (last := _last(head)).chars
                head, taken = _split(head, cut) if cut else (None, head)
                middle, reach = _merge(taken, middle), reach + last.chars
        if tail:
            first = _first(tail).chars
            taken, tail = _split(tail, first)
            middle = _merge(middle, taken)
        base = head.sum_chars if head else 0
        old = "".join([n.text for n in _leaves(middle)])
        new = old[: start - base] + text + old[max(start, end) - base :]
        self.root = _merge(_merge(head, self._build(new)), tail)
        return self.tokens


def _last(node: _Node) -> _Node:
    while node.right:
        node = node.right
    return node


def _first(node: _Node) -> _Node:
    while node.left:
        node = node.left
    return node


# Patterns of personal data that the redaction edits replace.
PERSONAL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+|\b\d{1,3}(?:\.\d{1,3}){3}\b|\b\d{13,19}\b|\+?\d[\d -]{8,}\d", re.A)


def redactions(text: str) -> list[tuple[int, int, str]]:
    """Edits that put a mark in place of e-mail addresses, IP addresses, card and phone numbers, in order."""
    out, shift, mark = [], 0, "[removed]"
    if "@" not in text and not any(map(text.__contains__, "0123456789")):
        return out
    for m in PERSONAL.finditer(text):
        out.append((m.start() + shift, m.end() + shift, mark))
        shift += len(mark) - (m.end() - m.start())
    return out


EDITS = "array<struct<start: long, end: long, text: string>>"
LEAVES = "array<struct<chars: long, tokens: long>>"
_EDIT_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("text", pa.string())]))
_LEAF_TYPE = pa.list_(pa.struct([("chars", pa.int64()), ("tokens", pa.int64())]))


def _kernel(path: str, size: int, work: Callable[[ByteEncoder, pa.RecordBatch], list]):
    return lambda: lambda batch: work(encoder(path), batch)


def count(docs: DataFrame, text_col: str = "text", tokenizer: str | None = None, size: int = SEGMENT, keep: list[str] | None = None) -> DataFrame:
    """Appends n_tokens and ``leaves``, the segments' lengths and counts, for ``recount``; such columns are replaced."""

    def work(own: ByteEncoder, batch: pa.RecordBatch) -> list:
        leaves = [[(len(s), own.count(s)) for s in segments(t.decode("utf-8", "replace"), size)] for t in texts(batch.column(0))]
        rows = [[{"chars": c, "tokens": n} for c, n in x] for x in leaves]
        return [pa.array([sum(n for _, n in x) for x in leaves], pa.int64()), pa.array(rows, _LEAF_TYPE)]

    path = tokenizer or tokenizer_path("byte_bpe_50k.json")
    return append_columns(docs, _kernel(path, size, work), [as_bytes(text_col)], f"n_tokens long, leaves {LEAVES}", docs.columns if keep is None else keep)


def find_edits(docs: DataFrame, find: Callable[[str], list[tuple[int, int, str]]] = redactions, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Appends ``edits`` as find gives them; such a column is replaced."""

    def kernel():
        def work(batch: pa.RecordBatch) -> list:
            found = [find(t.decode("utf-8", "replace")) for t in texts(batch.column(0))]
            return [pa.array([[{"start": a, "end": b, "text": c} for a, b, c in x] for x in found], _EDIT_TYPE)]

        return work

    return append_columns(docs, kernel, [as_bytes(text_col)], f"edits {EDITS}", docs.columns if keep is None else keep)


def recount(docs: DataFrame, text_col: str = "text", edits_col: str = "edits", leaves_col: str = "leaves", tokenizer: str | None = None, size: int = SEGMENT, keep: list[str] | None = None) -> DataFrame:
    """Appends n_edits, tokens_after, chars_after, encoded_chars (what had to be encoded again), edited_text and edited_leaves; such columns are replaced."""

    def work(own: ByteEncoder, batch: pa.RecordBatch) -> list:
        rows = []
        edits, leaves = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        for raw, given, kept in zip(texts(batch.column(0)), edits, leaves, strict=True):
            good = [e for e in given or [] if e and e["start"] is not None and e["end"] is not None and e["end"] >= e["start"]]
            if not good:
                text = raw.decode("utf-8", "replace")
                known = kept or []
                if sum(x["chars"] for x in known) != len(text):
                    known = [{"chars": len(s), "tokens": own.count(s)} for s in segments(text, size)]
                rows.append((0, sum(x["tokens"] for x in known), len(text), 0, text, known))
                continue
            tree = TokenTree(own.count, raw.decode("utf-8", "replace"), size, [(x["chars"], x["tokens"]) for x in kept or []])
            before = tree.encoded
            for e in good:
                tree.edit(e["start"], e["end"], e["text"] or "")
            rows.append((len(good), tree.tokens, tree.chars, tree.encoded - before, tree.text, [{"chars": c, "tokens": n} for c, n in tree.leaves()]))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), _LEAF_TYPE]
        return [pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)]

    path = tokenizer or tokenizer_path("byte_bpe_50k.json")
    inputs: list[Column] = [as_bytes(text_col), F.col(edits_col), F.col(leaves_col)]
    ddl = f"n_edits long, tokens_after long, chars_after long, encoded_chars long, edited_text string, edited_leaves {LEAVES}"
    return append_columns(docs, _kernel(path, size, work), inputs, ddl, docs.columns if keep is None else keep)
