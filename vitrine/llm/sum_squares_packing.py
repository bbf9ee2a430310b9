"""Online packing of documents into token sequences by the sum-of-squares rule.

Every task packs the documents of its part of the table as they come. A level array
counts the open sequences at each fill level; a document goes to the level that leaves
the smallest sum of squared counts. What is still open at the end of a part is poured
together, cut where needed, so nothing is padded.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from vitrine.llm.common import batch_of, slices, texts
from vitrine.llm.tokens import encoder

LENGTH = 1024
MAX_OPEN = 4096  # open sequences a task holds; more are poured together at once
PART_BITS = 40
PIECES = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])


class Packer:
    """Sequences of one part. A piece is (doc_id, start, ids as bytes, doc_tokens)."""

    def __init__(self, first_sequence: int):
        self.next = first_sequence
        self.levels = np.zeros(LENGTH + 1, np.int64)
        self.open: dict[int, list[list]] = {}
        self.count = 0
        self.rows: list[tuple] = []

    def close(self, pieces: list) -> None:
        offset = 0
        for doc_id, start, ids, total in pieces:
            n = len(ids) // 4
            self.rows.append((doc_id, start, n, zlib.crc32(ids), total, self.next, offset))
            offset += n
        self.next += 1

    def level_for(self, size: int) -> int:
        """The fill level, 0 for a new sequence, whose use leaves the smallest sum of squares; the fullest of equals."""
        here, there = self.levels[:LENGTH - size + 1], self.levels[size:]
        change = 2 * there + 1
        change[-1] = 0  # a full sequence is closed
        change[1:] += 1 - 2 * here[1:]
        change[1:][here[1:] == 0] = np.iinfo(np.int64).max
        return len(change) - 1 - int(change[::-1].argmin())

    def put(self, piece: tuple) -> None:
        size = len(piece[2]) // 4
        level = self.level_for(size)
        if level:
            pieces = self.open[level].pop()
            self.levels[level] -= 1
            self.count -= 1
        else:
            pieces = []
        pieces.append(piece)
        if level + size == LENGTH:
            self.close(pieces)
        else:
            self.hold(level + size, pieces)

    def hold(self, level: int, pieces: list) -> None:
        self.open.setdefault(level, []).append(pieces)
        self.levels[level] += 1
        self.count += 1
        if self.count > MAX_OPEN:
            self.pour(last=False)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        total, width = len(ids) // 4, 4 * LENGTH
        whole = len(ids) // width * width
        for at in range(0, whole, width):
            self.close([(doc_id, at // 4, ids[at:at + width], total)])
        if whole < len(ids):
            self.put((doc_id, whole // 4, ids[whole:], total))

    def pour(self, last: bool) -> None:
        """Cut the open sequences into full ones; the rest stays open, or at the last goes into lengths that are
        powers of two, which need no padding."""
        waiting = [p for level in sorted(self.open, reverse=True) for pieces in self.open[level] for p in pieces]
        self.open, self.count = {}, 0
        self.levels[:] = 0
        left = sum(len(p[2]) // 4 for p in waiting)
        target, pieces, filled = LENGTH, [], 0
        for doc_id, start, ids, total in waiting:
            while ids:
                if not filled and left < LENGTH and last:
                    target = 1 << (left.bit_length() - 1)
                take = min(len(ids) // 4, target - filled)
                pieces.append((doc_id, start, ids[:4 * take], total))
                ids, start, filled, left = ids[4 * take:], start + take, filled + take, left - take
                if filled == target:
                    self.close(pieces)
                    pieces, filled = [], 0
        if pieces:
            self.hold(filled, pieces)

    def taken(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        return batch_of(PIECES, **dict(zip(PIECES.names, zip(*rows))))


def pack_part(path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(TaskContext.get().partitionId() << PART_BITS)
        for batch in batches:
            for part in slices(batch):
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), encoder(path).documents(part.column("text").to_pylist())):
                    packer.add(doc_id, ids)
                if packer.rows:
                    yield packer.taken()
        packer.pour(last=True)
        if packer.rows:
            yield packer.taken()
    return run


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset for every piece of every document.

    Sequences have LENGTH ids, but for at most log2(LENGTH) shorter ones per part of
    the table, whose lengths are powers of two. Null and empty texts are one end id.
    Repeated rows are documents of their own; a null doc_id stays null.
    """
    return texts(docs).mapInArrow(pack_part(tokenizer_path), ", ".join(f"{n} long" for n in PIECES.names))
