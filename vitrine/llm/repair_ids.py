"""Token ids in files compressed by Re-Pair grammars.

Documents are sorted over the cluster and every task writes its range as segments.
In a segment the most frequent pairs of neighbouring symbols are replaced by
nonterminals, again and again until no pair occurs MIN_COUNT times or the 16-bit symbols
are used up; rules and expansion lengths are stored, so any document can be decoded alone.

A segment is one binary value of a Parquet table: eight little-endian 32-bit counts
(format, documents, rules, symbols, then zeros), doc ids (64-bit) and their validity
bytes, ids per document and first symbol per document (32-bit), the rules (two 16-bit
symbols each), their expansion lengths (32-bit), and the symbols (16-bit). Symbols
below TERMINALS are ids, others TERMINALS plus the number of a rule.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import batch_of, slices, texts
from vitrine.llm.tokens import encoder
from vitrine.session import fresh_path

FORMAT = 1
TERMINALS, SYMBOLS = 50_304, 65_536
SEGMENT_IDS = 1 << 20
PAIRS_A_ROUND, MIN_COUNT, SLOT_BITS = 4_096, 16, 20
FILES = pa.schema([("part", pa.int32()), ("segment", pa.int32()), ("base", pa.int64()), ("n_ids", pa.int64()), ("data", pa.binary())])
FILE_SCHEMA = "part int, segment int, base long, n_ids long, data binary"
READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def choose(pairs: np.ndarray, counts: np.ndarray, most: int) -> list[int]:
    """The most frequent pairs such that no symbol is the first of one and the second of another: they never overlap, but for
    the pair of a symbol with itself, which then is the only one of that symbol."""
    order = np.argsort(-counts, kind="stable")[:4 * most]
    first, second, out = set(), set(), []
    for pair in pairs[order].tolist():
        a, b = pair >> 16, pair & 0xFFFF
        if a not in second and b not in first and (a != b or a not in first and a not in second):
            first.add(a)
            second.add(b)
            out.append(pair)
            if len(out) == most:
                break
    return out


def slot(pairs: np.ndarray) -> np.ndarray:
    return (pairs * np.uint32(0x9E3779B1)) >> np.uint32(32 - SLOT_BITS)


def frequent(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that occur MIN_COUNT times, and how often."""
    ordered = np.sort(pairs)
    heads = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])[:len(ordered)])
    counts = np.diff(np.append(heads, len(ordered)))
    often = counts >= MIN_COUNT
    return ordered[heads][often], counts[often]


def every_other(at: np.ndarray) -> np.ndarray:
    """Which of some ascending places to take so that no two are neighbours, from the left."""
    n = np.arange(len(at))
    begins = np.concatenate([[True], np.diff(at) != 1])[:len(at)]
    return (n - np.maximum.accumulate(np.where(begins, n, 0))) % 2 == 0


def compress(ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Symbols, document ends (exclusive) among them, and rules. A document's last symbol never joins the next document's first."""
    symbols = ids.astype(np.uint32)
    last = np.zeros(len(ids), bool)
    last[ends - 1] = True
    rules: list[int] = []
    newest, before = 0, np.zeros(1 << SLOT_BITS, bool)
    while len(symbols) > 1 and len(rules) < SYMBOLS - TERMINALS:
        pair = symbols[:-1] << np.uint32(16) | symbols[1:]
        slots = slot(pair)
        free = ~last[:-1]
        # A pair that is frequent now was so before, or has a symbol of the last round (at first: any).
        fresh = symbols >= newest
        often, counts = frequent(pair[free & (fresh[:-1] | fresh[1:] | before[slots])])
        before[:] = False
        before[slot(often)] = True
        newest = TERMINALS + len(rules)
        chosen = choose(often, counts, min(PAIRS_A_ROUND, SYMBOLS - TERMINALS - len(rules)))
        if not chosen:
            break
        known = np.array(chosen, np.uint32)
        taken, numbers = np.unique(slot(known), return_index=True)  # of pairs in one slot the rarer waits for the next round
        known = known[numbers]
        table = np.zeros(1 << SLOT_BITS, np.uint16)
        table[taken] = np.arange(len(known))
        place = table[slots]
        at = np.flatnonzero((known[place] == pair) & free)
        twins = symbols[at] == symbols[at + 1]
        twins[twins] = ~every_other(at[twins])
        at = at[~twins]
        symbols[at] = TERMINALS + len(rules) + place[at]
        last[at] = last[at + 1]
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        symbols, last = symbols[keep], last[keep]
        rules += known.tolist()
    return symbols.astype(np.uint16), np.flatnonzero(last) + 1, rules


def expansion_lengths(rules: np.ndarray) -> np.ndarray:
    lengths = np.ones(TERMINALS + len(rules), np.int64)
    for i, (a, b) in enumerate(rules.tolist()):
        lengths[TERMINALS + i] = lengths[a] + lengths[b]
    return lengths[TERMINALS:]


@dataclass
class Segment:
    """A parsed segment; `ids` decodes one document or all of them."""

    doc_ids: np.ndarray
    valid: np.ndarray
    n_ids: np.ndarray
    first: np.ndarray
    rules: np.ndarray
    lengths: np.ndarray
    symbols: np.ndarray

    @classmethod
    def build(cls, doc_ids: list[int | None], ids: list[bytes]) -> Segment:
        n = np.array([len(x) // 4 for x in ids], np.uint32)
        flat = np.frombuffer(b"".join(ids), "<u4")
        if len(flat) and flat.max() >= TERMINALS:
            raise ValueError(f"a token id of {flat.max()} does not fit this format, whose ids are below {TERMINALS}")
        symbols, ends, rules = compress(flat, np.cumsum(n, dtype=np.int64))
        pairs = np.array([(p >> 16, p & 0xFFFF) for p in rules], np.uint16).reshape(-1, 2)
        return cls(np.array([x or 0 for x in doc_ids], np.int64), np.array([x is not None for x in doc_ids], np.uint8), n,
                   np.concatenate([[0], ends[:-1]]).astype(np.uint32), pairs, expansion_lengths(pairs).astype(np.uint32), symbols)

    def dump(self) -> bytes:
        counts = np.array([FORMAT, len(self.doc_ids), len(self.rules), len(self.symbols), 0, 0, 0, 0], "<u4")
        parts = (counts, self.doc_ids.astype("<i8"), self.valid, self.n_ids.astype("<u4"), self.first.astype("<u4"),
                 self.rules.astype("<u2"), self.lengths.astype("<u4"), self.symbols.astype("<u2"))
        return b"".join(x.tobytes() for x in parts)

    @classmethod
    def load(cls, data: bytes) -> Segment:
        form, docs, rules, symbols = np.frombuffer(data, "<u4", 4).tolist()
        if form != FORMAT:
            raise ValueError(f"unknown segment format {form}")
        out, at = [], 32
        for kind, n in (("<i8", docs), ("u1", docs), ("<u4", docs), ("<u4", docs), ("<u2", 2 * rules), ("<u4", rules), ("<u2", symbols)):
            out.append(np.frombuffer(data, kind, n, at))
            at += out[-1].nbytes
        out[4] = out[4].reshape(-1, 2)
        return cls(*out)

    def expansions(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and length of each symbol's expansion in one flat array, and that array."""
        lengths = np.concatenate([np.ones(TERMINALS, np.int64), self.lengths])
        begin = np.cumsum(lengths) - lengths
        flat = np.empty(int(lengths.sum()), np.uint32)
        flat[:TERMINALS] = np.arange(TERMINALS)
        for i, (a, b) in enumerate(self.rules.tolist()):
            at, la, lb = begin[TERMINALS + i], lengths[a], lengths[b]
            flat[at:at + la] = flat[begin[a]:begin[a] + la]
            flat[at + la:at + la + lb] = flat[begin[b]:begin[b] + lb]
        return begin, lengths, flat

    def ids(self, document: int | None = None) -> np.ndarray:
        begin, lengths, flat = self.expansions()
        symbols = self.symbols
        if document is not None:
            end = self.first[document + 1] if document + 1 < len(self.first) else len(symbols)
            symbols = symbols[self.first[document]:end]
        n = lengths[symbols]
        shift = np.repeat(begin[symbols] - (np.cumsum(n) - n), n)
        return flat[shift + np.arange(len(shift))].astype("<u4")


def write_part(path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, base = TaskContext.get().partitionId(), 0, 0
        docs, ids, size = [], [], 0

        def segment() -> pa.RecordBatch:
            return batch_of(FILES, part=[part], segment=[number], base=[base], n_ids=[size], data=[Segment.build(docs, ids).dump()])

        for batch in batches:
            for piece in slices(batch):
                for doc, own in zip(piece.column("doc_id").to_pylist(), encoder(path).documents(piece.column("text").to_pylist())):
                    if docs and size + len(own) // 4 > SEGMENT_IDS:
                        yield segment()
                        number, base, docs, ids, size = number + 1, base + size, [], [], 0
                    docs.append(doc)
                    ids.append(own)
                    size += len(own) // 4
        if docs:
            yield segment()
    return run


def write_ids(docs: DataFrame, path: str, tokenizer_path: str | None = None) -> None:
    """Write the segments of all documents, in ascending doc_id order, as a Parquet table at `path`.

    Null doc_ids come first. Null and empty texts are one end id. Repeated rows are
    documents of their own, side by side.
    """
    source = texts(docs)
    ranged = source.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    ranged.mapInArrow(write_part(tokenizer_path), FILE_SCHEMA).write.parquet(path)


def read_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for before, data in zip(batch.column("before").to_pylist(), batch.column("data")):
            found = Segment.load(data.as_buffer())
            ids = memoryview(found.ids().tobytes())
            ends = np.cumsum(found.n_ids, dtype=np.int64)
            begin = ends - found.n_ids
            yield batch_of(READ, doc_id=[d if v else None for d, v in zip(found.doc_ids.tolist(), found.valid.tolist())],
                           start=begin + before, n_tokens=found.n_ids.astype(np.int64),
                           ids_crc32=[zlib.crc32(ids[4 * a:4 * b]) for a, b in zip(begin.tolist(), ends.tolist())])


def read_ids(spark, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the segments at `path`."""
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    # One row per task of the sort: bounded by the cluster's settings, not by the data.
    sizes = sorted((r["part"], r["n"]) for r in files.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    starts, total = [], 0
    for part, n in sizes:
        starts.append((part, total))
        total += n
    offsets = spark.createDataFrame(starts, "part int, _start long")
    return files.join(F.broadcast(offsets), "part").select((F.col("base") + F.col("_start")).alias("before"), "data").mapInArrow(
        read_segments, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    path = fresh_path(docs.sparkSession, "ids")
    write_ids(docs, path, tokenizer_path)
    return read_ids(docs.sparkSession, path)
