"""Sum-of-squares online packing of token sequences into windows.

Each task packs its own rows in one pass.  ``counts[h]`` is the number of open
windows that hold h tokens.  A document's whole windows are closed at once; its
remainder goes to the fill level (or to a new window) that makes the sum of the
squared counts smallest, ties to the fullest window.  A full window is closed
and its pieces are returned.

At the end of a task the windows still open are items themselves: largest first,
each goes by the same rule to a level of a new array, whole.  So the window of
every remainder is one that the level array chose.  An open window that is left
over is cut at powers of two if ``split_open`` is set, since sequences of such a
length need no padding; else it is one sequence to be padded.

Memory is bounded by the open windows, at most one for each level in the usual
case.  A lost task is repeated alone; a window's number is made of its task's
number and its own, so it is repeatable wherever the order of rows is.

Null texts count as empty.  An empty text is a document of one token, the end
id.  Texts of any length are encoded whole, and their whole windows are closed
as they are cut.  Rows with a null id are packed alike.  Repeated rows are
packed each.  Equal sums of squares go to the fullest window.  Of the input only
the id and the text are read, so other columns can't clash.  An empty table
gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, slices, texts, tokenizer_path
from .encoding import encoder

Piece = tuple[object, int, bytes, int]
"""Document's id, first token, ids, the document's tokens."""


class SumOfSquares:
    def __init__(self, window: int):
        self.window = window
        self.counts = np.zeros(window + 1, np.int64)
        self.open: list[list[list[Piece]]] = [[] for _ in range(window)]

    def level(self, size: int) -> int:
        """The fill level to put size tokens on; 0 is a new window."""
        n, w = self.counts, self.window
        change = 2 * (n[size : w + 1] - n[: w - size + 1]) + 2
        change[0] = 2 * n[size] + 1
        change[-1] -= 1  # a full window is closed and counts no more
        usable = n[: w - size + 1] > 0
        usable[0] = True
        change = np.where(usable, change, np.iinfo(np.int64).max)
        return len(change) - 1 - int(np.argmin(change[::-1]))

    def put(self, held: list[Piece], size: int) -> list[Piece] | None:
        """The window's pieces if these, of so many tokens, fill it."""
        h = self.level(size)
        if h:
            held = self.open[h].pop() + held
            self.counts[h] -= 1
        if h + size == self.window:
            return held
        self.open[h + size].append(held)
        self.counts[h + size] += 1
        return None

    def place(self, piece: Piece) -> list[Piece] | None:
        """The window's pieces if the piece fills it."""
        return self.put([piece], len(piece[2]) // 4)

    def finish(self, split_open: bool) -> Iterator[list[Piece]]:
        """Puts the open windows together, whole, and closes them."""
        last = SumOfSquares(self.window)
        for h in range(self.window - 1, 0, -1):
            for held in self.open[h]:
                if full := last.put(held, h):
                    yield full
        self.__init__(self.window)
        for h in range(self.window - 1, 0, -1):
            for held in last.open[h]:
                yield from binary(held, h) if split_open else [held]


def binary(held: list[Piece], total: int) -> Iterator[list[Piece]]:
    """The pieces of a window of so many tokens, cut into sequences whose lengths are different powers of two, the longest first."""
    rest = held[::-1]
    for bit in range(total.bit_length() - 1, -1, -1):
        need, part = (total >> bit & 1) << bit, []
        while need:
            doc, start, ids, n = rest.pop()
            take = ids[: 4 * need]
            part.append((doc, start, take, n))
            need -= len(take) // 4
            if len(take) < len(ids):
                rest.append((doc, start + len(take) // 4, ids[len(take) :], n))
        if part:
            yield part


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 1024, end_id: int = 0,
    tokenizer: str | None = None, split_open: bool = True, with_ids: bool = True,
) -> DataFrame:
    """One row per piece: id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked for, ids."""
    path = tokenizer or tokenizer_path("byte_bpe_50k.json")
    end = np.array([end_id], "<u4").tobytes()
    source = docs.select(F.col(id_col).alias("id"), as_bytes(text_col).alias("text"))
    kind = source.schema["id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(kind)
    types = [("id", id_type), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
    types += [("ids", pa.list_(pa.int32()))] if with_ids else []
    ddl = f"id {kind.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, packer = encoder(path), SumOfSquares(window)
        number = TaskContext.get().partitionId() << 36
        rows: list[tuple] = []

        def close(held: list[Piece]) -> None:
            nonlocal number
            offset = 0
            for doc, start, ids, total in held:
                n = len(ids) // 4
                rows.append((doc, start, n, zlib.crc32(ids), total, number, offset, *([np.frombuffer(ids, "<u4").astype(np.int32)] if with_ids else [])))
                offset += n
            number += 1

        def drain() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) if rows else [[] for _ in types]
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, types, strict=True)], names=[n for n, _ in types])
            rows.clear()
            return out

        for batch in slices(batches):
            for doc, text in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True):
                ids = coder.encode(text.decode("utf-8", "replace")) + end
                total, whole = len(ids) // 4, len(ids) // (4 * window) * window
                for start in range(0, whole, window):
                    close([(doc, start, ids[4 * start : 4 * (start + window)], total)])
                if whole < total and (full := packer.place((doc, whole, ids[4 * whole :], total))):
                    close(full)
            yield drain()
        for held in packer.finish(split_open):
            close(held)
        yield drain()

    out = source.mapInArrow(run, ddl)
    return out.withColumnRenamed("id", id_col)
