"""Sum-of-squares packing of token documents into fixed windows.

Each Spark partition packs its documents online. A document's full windows stand alone; its rest goes to the fill level
that minimises the sum, over levels, of the squared number of partially filled windows, tracked in one array of counts
per level. What is open at the end, or when ``open_limit`` windows are open, is laid end to end and cut into full
windows; the last part of a partition becomes windows of power-of-two lengths, which need no padding.

Defined results: null text is the empty text (only the end id); repeated rows and ids are separate documents; an empty
table gives no pieces. Sequence ids are (partition << 40) + a running number.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from lakelayer.llm.common import col, small_batches, text_or_empty
from lakelayer.llm.tokens import chunks, encoder

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long")


class Packer:
    """Online packer of one partition. Pieces are (doc, start, ids as bytes, tokens of the document)."""

    def __init__(self, window: int, open_limit: int, first_id: int = 0):
        self.window, self.open_limit, self.next_id = window, open_limit, first_id
        self.counts = np.zeros(window + 1, np.int64)          # open windows by fill level
        self.at: list[list[list]] = [[] for _ in range(window)]
        self.n_open = 0
        self.done: list[tuple] = []

    def _emit(self, pieces: list) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            self.done.append((doc, start, n, zlib.crc32(ids), total, self.next_id, offset))
            offset += n
        self.next_id += 1

    def level(self, n: int) -> int:
        """The fill level to put ``n`` tokens on; 0 opens a window. Ties go to the fullest level."""
        w, c = self.window, self.counts
        open_ = c[1:w - n + 1]                                # levels 1 .. w - n
        best, cost = 0, 2 * int(c[n]) + 1
        if len(open_):
            after = c[1 + n:w + 1]
            change = 2 * (after - open_) + 2
            change[-1] = 1 - 2 * int(open_[-1])               # a window that becomes full leaves the array
            change = np.where(open_ > 0, change, np.iinfo(np.int64).max)
            k = len(change) - 1 - int(np.argmin(change[::-1]))
            if change[k] <= cost:
                best = k + 1
        return best

    def add(self, doc, ids: bytes) -> None:
        w, total, start = self.window, len(ids) // 4, 0
        while total - start >= w:
            self._emit([(doc, start, ids[4 * start:4 * (start + w)], total)])
            start += w
        n = total - start
        if not n:
            return
        h = self.level(n)
        pieces = self.at[h].pop() if h else []
        if h:
            self.counts[h] -= 1
            self.n_open -= 1
        pieces.append((doc, start, ids[4 * start:], total))
        if h + n == w:
            self._emit(pieces)
        else:
            self.counts[h + n] += 1
            self.at[h + n].append(pieces)
            self.n_open += 1
            if self.n_open > self.open_limit:
                self._relay(last=False)

    def _relay(self, last: bool) -> None:
        """Lay all open windows end to end and cut them into full ones; the rest stays open, or ends in powers of two."""
        w = self.window
        stream = [p for level in reversed(self.at) for pieces in level for p in pieces]
        self.at = [[] for _ in range(w)]
        self.counts[:] = 0
        self.n_open = 0
        left = sum(len(p[2]) // 4 for p in stream)
        room = w if left >= w or not last else 1 << (left.bit_length() - 1) if left else 0
        cur: list = []
        fill = 0
        for doc, start, ids, total in stream:
            n, used = len(ids) // 4, 0
            while used < n:
                take = min(n - used, room - fill)
                cur.append((doc, start + used, ids[4 * used:4 * (used + take)], total))
                used, fill, left = used + take, fill + take, left - take
                if fill == room:
                    self._emit(cur)
                    cur, fill = [], 0
                    room = w if left >= w or not last else 1 << (left.bit_length() - 1) if left else 0
        if cur:
            self.counts[fill] += 1
            self.at[fill].append(cur)
            self.n_open = 1

    def finish(self) -> None:
        self._relay(last=True)

    def take(self) -> list[tuple]:
        out, self.done = self.done, []
        return out


def pack(df: DataFrame, tokenizer: str, end_id: int, window: int = 2048, open_limit: int = 4096,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence, and the CRC-32 of its ids."""
    small_batches(df.sparkSession)
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(tokenizer), np.array([end_id], "<i4").tobytes()
        packer = Packer(window, open_limit, TaskContext.get().partitionId() << 40)

        def rows():
            got = packer.take()
            cols = list(zip(*got)) if got else [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in cols], names)

        for b in batches:
            docs = b.column(0).to_pylist()
            for i, j, texts in chunks(b.column(1)):
                ids, at = enc.encode_column(texts)
                raw = ids.tobytes()
                for doc, first, last in zip(docs[i:j], at[:-1].tolist(), at[1:].tolist()):
                    packer.add(doc, raw[4 * first:4 * last] + end)
                yield rows()
        packer.finish()
        yield rows()

    return (df.select(col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
            .mapInArrow(run, SCHEMA))
