"""Divergence of the sources of a language, from bitmaps of terms with equal counts.

The kept terms of a language are numbered and cut into words of 64. For each group
(language, source) and each count there is a bitmap, stored word by word, of the terms
which the group holds that often. Two bitmaps ANDed give the terms with count c here and
count d there, and popcount the cell of the pair's joint table; its f is a function of c
and d alone. Cells with a zero follow by complement, from the sizes of the levels, so a
term that neither of two groups holds costs nothing. Numbers go by frequency: words of
rare terms have few levels, which are the dense ones.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vitrine.llm.common import batch_of, slices, written

MIN_DOCS = 30
TOP_TERMS = 50
SCALE = 1_000_000_000
SMOOTH = 5
WORD_BITS = 64
# A task hands its counts on at this many entries, a text is split in pieces of this many bytes,
# and two lists of bitmaps are combined in blocks of this many rows: bounds of memory, without effect on results.
MAX_ENTRIES = 500_000
PIECE = 4 << 20
BLOCK = 1024
# ASCII letters fold to lower case, all other ASCII separates terms.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))

COUNTED = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64()), ("docs", pa.int64())])
JOINT = pa.schema([("g", pa.int64()), ("h", pa.int64()), ("joint", pa.int64())])


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """Terms of a text, a bounded piece at a time; no term is cut."""
    folded, start = text.translate(FOLD), 0
    while start < len(folded):
        end = folded.find(b" ", start + PIECE)
        end = len(folded) if end < 0 else end
        yield folded[start:end].split()
        start = end


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term by group, summed in the task; a row with an empty term names each group."""
    counts: dict[tuple, Counter] = {}
    docs: dict[tuple, Counter] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), found in counts.items():
            n, held = len(found), docs[lang, source]
            yield batch_of(COUNTED, lang=[lang] * n, source=[source] * n, term=list(found), n=list(found.values()),
                           docs=[held[t] for t in found])
        counts.clear()
        docs.clear()

    for batch in batches:
        for part in slices(batch):
            columns = [part.column(c).to_pylist() for c in ("lang", "source", "text")]
            for lang, source, text in zip(*columns):
                key = (lang, source)
                if key not in counts:
                    counts[key], docs[key] = Counter({b"": 0}), Counter()
                seen: set[bytes] = set()
                for terms in pieces(text):
                    counts[key].update(terms)
                    seen.update(terms)
                docs[key].update(seen)
            if sum(map(len, counts.values())) >= MAX_ENTRIES:
                yield from flush()
    yield from flush()


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + SMOOTH) / (total + SMOOTH * terms)), in whole numbers."""
    top = F.lit(SCALE).cast("decimal(10,0)") * (n + SMOOTH).cast("decimal(20,0)")
    return F.call_function("div", top, (total + SMOOTH * terms).cast("decimal(20,0)")) + 1


def joint_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From bitmap words sorted by (lang, word, g): for each pair of groups the sum over joint cells of their
    size times f(c, d) - f(c, 0) - f(0, d) + f(0, 0), which is what the cell adds to the sums over single levels."""
    sums: dict[tuple[int, int], int] = {}

    def combine(rows: list[np.ndarray]) -> None:
        g, p, zero, bits = rows
        for a in range(0, len(g), BLOCK):
            for b in range(0, len(g), BLOCK):
                x, y = slice(a, a + BLOCK), slice(b, b + BLOCK)
                cells = np.bitwise_count(bits[x, None] & bits[None, y]).astype(np.int64)
                gain = (np.abs(p[x, None] - p[None, y]) - np.abs(p[x, None] - zero[None, y])
                        - np.abs(zero[x, None] - p[None, y]) + np.abs(zero[x, None] - zero[None, y]))
                left, right = (np.flatnonzero(np.r_[True, g[z][1:] != g[z][:-1]]) for z in (x, y))
                total = np.add.reduceat(np.add.reduceat(cells * gain, left, 0), right, 1)
                for i, one in enumerate(g[x][left].tolist()):
                    for other, value in zip(g[y][right].tolist(), total[i].tolist()):
                        if one != other:
                            sums[one, other] = sums.get((one, other), 0) + value

    def flush() -> pa.RecordBatch:
        keys = list(sums)
        out = batch_of(JOINT, g=[k[0] for k in keys], h=[k[1] for k in keys], joint=list(sums.values()))
        sums.clear()
        return out

    key, held = None, []
    for batch in batches:
        at = list(zip(batch.column("lang").to_pylist(), batch.column("word").to_pylist()))
        columns = [batch.column(c).to_numpy() for c in ("g", "p", "zero")] + [batch.column("bits").to_numpy().view(np.uint64)]
        starts = [i for i in range(len(at)) if i == 0 or at[i] != at[i - 1]]
        for start, end in zip(starts, starts[1:] + [len(at)]):
            if at[start] != key and held:
                combine([np.concatenate(c) for c in zip(*held)])
                held = []
                if len(sums) >= MAX_ENTRIES:
                    yield flush()
            key = at[start]
            held.append([c[start:end] for c in columns])
    if held:
        combine([np.concatenate(c) for c in zip(*held)])
    yield flush()


def divergence(docs: DataFrame) -> DataFrame:
    """lang, source, part, item, value, rank: for each group its distance to every other source of the language
    (`pair`) and the terms it holds more of than the language as a whole (`term`, the first TOP_TERMS).

    Null text, lang and source count as ''. A language keeps the terms in MIN_DOCS or more of its documents, repeated rows
    counted each. A share is p = 1 + floor(SCALE * (count + SMOOTH) / (N + SMOOTH * V)), N the group's occurrences
    of kept terms, V the number of kept terms; a pair's value sums abs(p - q) over all of them, 0 where V is 0.
    Ties go to the item whose UTF-8 bytes are smaller. A group without terms has pairs and no terms, an
    only source no pairs, an empty table no rows. Other columns are not read.
    """
    source = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")],
                         F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    counted = source.mapInArrow(count_terms, "lang string, source string, term binary, n long, docs long")
    counts = written(counted.groupBy("lang", "source", F.col("term").cast("string").alias("term"))
                     .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "group-terms")
    found = counts.filter("term != ''")
    kept = found.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total")).filter(F.col("docs") >= MIN_DOCS)
    order = ("lang", F.desc("total"), "term")
    numbered = written(kept.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "lang", "term", "total", F.monotonically_increasing_id().alias("number")), "kept-terms")
    rows = written(found.join(numbered, ["lang", "term"]).select("lang", "source", "term", "n", "total", "number"), "kept-counts")

    languages = numbered.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_total"))
    totals = rows.groupBy("lang", "source").agg(F.sum("n").alias("group_total"))
    sized = (counts.filter("term = ''").select("lang", "source").join(totals, ["lang", "source"], "left").join(languages, "lang", "left")
             .na.fill(0, ["group_total", "lang_total", "v"]))
    # Where a language keeps no term nothing is summed; 1 only keeps the division defined.
    zero = F.when(F.col("v") > 0, share(F.lit(0), F.col("group_total"), F.greatest("v", F.lit(1)))).otherwise(0)
    groups = written(sized.withColumns({"g": F.monotonically_increasing_id(), "zero": zero}), "groups")

    shared = rows.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("group_total"), F.col("v")))
    level = shared.withColumns({"word": F.col("number").bitwiseAND(-WORD_BITS), "bit": F.expr(f"shiftleft(1L, int(number & {WORD_BITS - 1}))")})
    bitmaps = written(level.groupBy("lang", "word", "g", "n", "p", "zero").agg(F.bit_or("bit").alias("bits")), "bitmaps")
    joint = (bitmaps.select("lang", "word", "g", "p", "zero", "bits").repartition("lang", "word").sortWithinPartitions("lang", "word", "g")
             .mapInArrow(joint_cells, "g long, h long, joint long").groupBy("g", "h").agg(F.sum("joint").alias("joint")))
    sizes = bitmaps.groupBy("lang", "g", "n", "p", "zero").agg(F.sum(F.bit_count("bits")).cast("long").alias("size"))

    one, other = groups.alias("one"), groups.alias("other")
    pairs = one.join(other, (F.col("one.lang") == F.col("other.lang")) & (F.col("one.g") != F.col("other.g"))).select(
        F.col("one.lang").alias("lang"), F.col("one.source").alias("source"), F.col("other.source").alias("item"), F.col("one.g").alias("g"),
        F.col("other.g").alias("h"), (F.col("one.v") * F.abs(F.col("one.zero") - F.col("other.zero"))).alias("zeros"))
    # What the levels of one group add against a group that holds none of their terms, the same for both directions.
    alone = (sizes.alias("s").join(other, (F.col("s.lang") == F.col("other.lang")) & (F.col("s.g") != F.col("other.g")))
             .groupBy(F.col("s.g").alias("g"), F.col("other.g").alias("h")).agg(F.sum(F.col("s.size") * (
                 F.abs(F.col("s.p") - F.col("other.zero")) - F.abs(F.col("s.zero") - F.col("other.zero")))).alias("alone")))
    back = alone.select(F.col("g").alias("h"), F.col("h").alias("g"), F.col("alone").alias("back"))
    summed = pairs.join(alone, ["g", "h"], "left").join(back, ["g", "h"], "left").join(joint, ["g", "h"], "left")
    value = F.col("zeros") + sum((F.coalesce(F.col(c), F.lit(0)) for c in ("alone", "back", "joint")), F.lit(0))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    paired = (summed.select("lang", "source", F.lit("pair").alias("part"), "item", value.cast("long").alias("value"))
              .withColumn("rank", F.row_number().over(best)))
    q = share(F.col("total"), F.col("lang_total"), F.col("v"))
    terms = (shared.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - q).alias("value"))
             .filter("value > 0").withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= TOP_TERMS))
    return paired.unionByName(terms)
