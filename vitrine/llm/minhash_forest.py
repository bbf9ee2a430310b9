"""Near-duplicate documents with an LSH forest over MinHash signatures.

Every distinct shingle set gets one signature per tree. The rows of a tree are
sorted, and neighbours in that order with a long common prefix are candidates;
they are confirmed on the full sets. Regions that still hold several components
are searched again with a prefix as deep as the crowd in them asks for, and sets in
such crowds in as many further trees as make up for the depth. Of a crowd, only sets meet
that share enough shingles with other components of it to be linked at all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrine.llm.common import batch_of, mixed, odd_numbers, slices, texts, windows, word_hashes, written
from vitrine.operators.components import components

SHINGLE_WORDS = 5
TREES, DEPTH, MIN_DEPTH = 16, 8, 3
REGION_ROWS = 12
BLOCK_ROWS = 1024
FACTORS = odd_numbers(TREES * DEPTH, 11)
KEY_BYTES = 1 + 4 * DEPTH

SIGNED = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("fp", pa.binary()), ("sig", pa.binary())])
ROWS = pa.schema([("key", pa.binary()), ("fp", pa.binary())])
PAIRS = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("lcp", pa.int32()), ("part", pa.int32()), ("at", pa.int32()),
                   ("key", pa.binary())])
SETS = pa.schema([("fp", pa.binary()), ("members", pa.binary())])
ELEMENTS = pa.schema([("id", pa.int64()), ("root", pa.int64()), ("element", pa.int64())])
LINKS = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("linked", pa.bool_())])


def shingle_set(text: bytes | None) -> np.ndarray:
    """Sorted distinct 64-bit values of the five-word shingles; of all words where there are fewer."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = word_hashes(words)
    if len(words) < SHINGLE_WORDS:
        return mixed(windows(hashes, len(words)) + np.uint64(len(words)))
    return np.unique(windows(hashes, SHINGLE_WORDS))


def fingerprint(members: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(members.tobytes())


def signature(members: np.ndarray, factors: np.ndarray = FACTORS) -> bytes:
    """The upper halves of the smallest member under each of the multiplications."""
    low = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(members), BLOCK_ROWS):
        np.minimum(low, (members[i:i + BLOCK_ROWS, None] * factors).min(axis=0), out=low)
    return (low >> np.uint64(32)).astype(">u4").tobytes()


def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            sets = [shingle_set(t) for t in part.column("text").to_pylist()]
            yield batch_of(SIGNED, doc_id=part.column("doc_id"), n_shingles=[len(s) for s in sets],
                           fp=[fingerprint(s) if len(s) else None for s in sets],
                           sig=[signature(s) if len(s) else None for s in sets])


def tree_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, fps = [], []
        for fp, sig in zip(batch.column("fp").to_pylist(), batch.column("sig").to_pylist()):
            keys += [bytes((t,)) + sig[4 * DEPTH * t:4 * DEPTH * (t + 1)] for t in range(TREES)]
            fps += [fp] * TREES
        yield batch_of(ROWS, key=keys, fp=fps)


def common_depth(keys: list[bytes]) -> np.ndarray:
    """Values each key shares with the one before it, from the root of its tree."""
    raw = np.frombuffer(b"".join(keys), np.uint8).reshape(-1, KEY_BYTES)
    values = np.ascontiguousarray(raw[:, 1:]).view(">u4")
    same = (values[1:] == values[:-1]) & (raw[1:, :1] == raw[:-1, :1])
    return np.cumprod(same, axis=1).sum(axis=1)


def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adjacent rows of a sorted partition with a common prefix, and the partition's first and last row."""
    part, last, first = TaskContext.get().partitionId(), None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, fps = batch.column("key").to_pylist(), batch.column("fp").to_pylist()
        first = first or (keys[0], fps[0])
        if last:
            keys, fps = [last[0], *keys], [last[1], *fps]
        last = keys[-1], fps[-1]
        depth = common_depth(keys)
        at = np.flatnonzero(depth >= MIN_DEPTH).tolist()
        none = [None] * len(at)
        yield batch_of(PAIRS, a=[fps[i] for i in at], b=[fps[i + 1] for i in at], lcp=depth[at].tolist(), part=none, at=none,
                       key=none)
    if last:
        yield batch_of(PAIRS, a=[first[1], last[1]], b=[None] * 2, lcp=[None] * 2, part=[part] * 2, at=[0, 1],
                       key=[first[0], last[0]])


def ordered(a: str = "a", b: str = "b") -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def sorted_neighbours(rows: DataFrame) -> DataFrame:
    """(a, b, score): neighbours over all trees, the score being the sum of their common depths."""
    spread = rows.repartitionByRange("key", "fp").sortWithinPartitions("key", "fp")
    found = written(spread.mapInArrow(neighbours, "a binary, b binary, lcp int, part int, at int, key binary"), "forest")
    # Two rows for each partition of the sort: bounded by the cluster's settings, not by the data.
    ends = found.filter("b is null").withColumn("b", F.lead("a").over(Window.orderBy("part", "at"))).withColumn(
        "next", F.lead("key").over(Window.orderBy("part", "at")))
    shared = sum((F.substring("key", 1, 1 + 4 * k) == F.substring("next", 1, 1 + 4 * k)).cast("int") for k in range(1, DEPTH + 1))
    across = ends.filter("at = 1 and b is not null").select("a", "b", shared.cast("int").alias("lcp")).filter(F.col("lcp") >= MIN_DEPTH)
    pairs = found.filter("b is not null").select("a", "b", "lcp").unionByName(across).filter("a <> b")
    return written(pairs.select(*ordered(), "lcp").groupBy("a", "b").agg(F.sum("lcp").alias("score")), "pairs")


def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            sets = [s for s in (shingle_set(t) for t in part.column("text").to_pylist()) if len(s)]
            yield batch_of(SETS, fp=[fingerprint(s) for s in sets], members=[s.tobytes() for s in sets])


def confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x, y in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist()):
                both = (len(x) + len(y)) // 8
                inter = both - len(np.unique(np.frombuffer(x + y, np.uint64)))
                out.append(100 * inter >= percent * (both - inter))
            yield batch_of(LINKS, a=batch.column("a"), b=batch.column("b"), linked=out)
    return run


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, linked) by the full sets; sizes alone rule out most of the others first."""
    left = sets.select(F.col("fp").alias("a"), F.col("members").alias("sa"))
    right = sets.select(F.col("fp").alias("b"), F.col("members").alias("sb"))
    met = pairs.select("a", "b").join(left, "a").join(right, "b").filter(
        (100 * F.least(F.length("sa"), F.length("sb"))) >= (percent * F.greatest(F.length("sa"), F.length("sb"))))
    return written(met.mapInArrow(confirm(percent), "a binary, b binary, linked boolean").filter("linked").select("a", "b"), "links")


def grouped(links: DataFrame) -> DataFrame:
    """(node, root) of the nodes that have a link."""
    nodes = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))).distinct()
    return written(components(nodes, links), "roots")


def rooted(df: DataFrame, roots: DataFrame | None, *columns: str) -> DataFrame:
    """Adds r_<column>, the root of the node in each column."""
    for c in columns:
        if roots is None:
            df = df.withColumn(f"r_{c}", F.col(c))
        else:
            df = df.join(roots.select(F.col("node").alias(c), F.col("root").alias("_r")), c, "left").withColumn(
                f"r_{c}", F.coalesce("_r", c)).drop("_r")
    return df


def merged(roots: DataFrame | None, links: DataFrame) -> DataFrame | None:
    """Roots after further links."""
    if links.isEmpty():
        return roots
    if roots is None:
        return grouped(links)
    between = rooted(links, roots, "a", "b").select(F.col("r_a").alias("a"), F.col("r_b").alias("b")).filter("a <> b").distinct()
    above = grouped(between)
    old = roots.join(above.select(F.col("node").alias("root"), F.col("root").alias("_top")), "root", "left").select(
        "node", F.coalesce("_top", "root").alias("root"))
    # A root of `above` may itself never have been a node of the earlier links.
    return written(old.unionByName(above).groupBy("node").agg(F.min("root").alias("root")), "roots")


def further_trees(percent: int) -> int:
    """Trees of full depth, besides the first, that find a pair at the threshold as surely as TREES trees of MIN_DEPTH."""
    if not 0 < percent < 100:
        return 0
    p = percent / 100
    return max(0, math.ceil(TREES * math.log1p(-p ** MIN_DEPTH) / math.log1p(-p ** DEPTH)) - TREES)


def further_rows(trees: int):
    """A value of each further tree's whole key, for every set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = odd_numbers(trees * DEPTH, 13)
        for batch in batches:
            keys, fps = [], []
            for fp, own in zip(batch.column("fp").to_pylist(), batch.column("members").to_pylist()):
                sig = signature(np.frombuffer(own, np.uint64), factors)
                keys += [xxhash.xxh3_128_digest(bytes((t & 255, t >> 8)) + sig[4 * DEPTH * t:4 * DEPTH * (t + 1)]) for t in range(trees)]
                fps += [fp] * trees
            yield batch_of(ROWS, key=keys, fp=fps)
    return run


def elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each shingle of each set."""
    for batch in batches:
        for part in slices(batch, "members"):
            own = part.column("members").to_pylist()
            at = pa.array(np.repeat(np.arange(len(own)), [len(x) // 8 for x in own]))
            yield batch_of(ELEMENTS, id=part.column("id").take(at), root=part.column("root").take(at), element=np.frombuffer(b"".join(own), np.int64))


def able_sets(crowd: DataFrame, sets: DataFrame, roots: DataFrame | None, percent: int) -> DataFrame:
    """(fp, n, shared) of the sets in a crowd that could be linked with another component of it: of n shingles, those found in
    several components are all that such a pair can have in common."""
    held = rooted(sets.join(crowd, "fp", "left_semi"), roots, "fp")
    each = written(held.select(F.xxhash64("fp").alias("id"), F.xxhash64("r_fp").alias("root"), "members").mapInArrow(
        elements, "id long, root long, element long"), "elements")
    common = each.groupBy("element").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("element")
    shared = each.join(common, "element", "left_semi").groupBy("id").agg(F.count(F.lit(1)).alias("shared"))
    sizes = sets.join(crowd, "fp", "left_semi").select("fp", F.xxhash64("fp").alias("id"), F.expr("cast(length(members) div 8 as long)").alias("n"))
    return written(sizes.join(shared, "id").filter(100 * F.col("shared") >= percent * F.col("n")).select("fp", "n", "shared"), "able")


def able_pair(percent: int) -> F.Column:
    """Whether two sets can be linked by what each shares with other components; true where that was not counted."""
    most = F.least("shared_a", "shared_b")
    return most.isNull() | (100 * most >= percent * (F.col("n_a") + F.col("n_b") - most))


def both_ends(rows: DataFrame, on: str) -> list[DataFrame]:
    """The rows as either end of a pair."""
    return [rows.select(on, F.col("fp").alias(end), F.col("r_fp").alias(f"r{end}"), F.col("n").alias(f"n_{end}"), F.col("shared").alias(f"shared_{end}"))
            for end in "ab"]


def further_pairs(able: DataFrame, sets: DataFrame, roots: DataFrame | None, tested: DataFrame, percent: int) -> DataFrame:
    """Untested pairs between different components that share a key of a further tree, among the able sets of crowded regions."""
    rows = sets.join(able, "fp", "left_semi").mapInArrow(further_rows(further_trees(percent)), "key binary, fp binary")
    placed = written(rooted(rows, roots, "fp"), "further")
    several = placed.groupBy("key").agg(F.min("r_fp").alias("lo"), F.max("r_fp").alias("hi")).filter("lo < hi").select("key")
    x, y = both_ends(placed.join(several, "key", "left_semi").join(able, "fp"), "key")
    pairs = x.join(y, "key").filter("ra < rb").filter(able_pair(percent)).select(*ordered()).distinct()
    return written(pairs.join(tested, ["a", "b"], "left_anti"), "further-pairs")


def crowded_pairs(rows: DataFrame, sets: DataFrame, roots: DataFrame | None, tested: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Untested pairs between different components of one region, and the able sets in regions that took a deeper prefix.

    A region is a prefix of one tree: MIN_DEPTH values, or as many more as it takes
    to have at most REGION_ROWS rows; the deepest prefix holds what is left, whole.
    Components already joined are never compared inside, so a crowd of copies gives no pairs;
    of a crowd of different texts, sets whose own shingles alone keep them apart give none.
    """
    region = F.substring("key", 1, 1 + 4 * MIN_DEPTH)
    placed = rooted(rows, roots, "fp").withColumn("region", region)
    mixed_regions = placed.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.min("r_fp").alias("lo"), F.max("r_fp").alias("hi")
                                                 ).filter("lo < hi and n > 2").select("region")
    left = written(placed.join(mixed_regions, "region", "left_semi").select("key", "fp", "r_fp"), "regions")
    depths = left.select("*", F.explode(F.sequence(F.lit(MIN_DEPTH), F.lit(DEPTH))).alias("k")).withColumn(
        "region", F.expr("substring(key, 1, 1 + 4 * k)"))
    sizes = depths.groupBy("region").agg(F.count(F.lit(1)).alias("n"))
    chosen = written(depths.join(sizes, "region").filter((F.col("n") <= REGION_ROWS) | (F.col("k") == DEPTH)).groupBy("key", "fp", "r_fp").agg(
        F.min("k").alias("k")).select(F.expr("substring(key, 1, 1 + 4 * k)").alias("region"), "fp", "r_fp", "k"), "chosen")
    deep = F.col("k") > MIN_DEPTH
    able = able_sets(written(chosen.filter(deep).select("fp").distinct(), "crowd"), sets, roots, percent)
    none = F.lit(None).cast("long")
    x, y = both_ends(chosen.filter(deep).join(able, "fp").unionByName(chosen.filter(~deep).withColumns({"n": none, "shared": none})), "region")
    pairs = x.join(y, "region").filter("ra < rb").filter(able_pair(percent)).select(*ordered()).distinct()
    return written(pairs.join(tested.select("a", "b"), ["a", "b"], "left_anti"), "crowded"), able


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row.

    Two documents are linked if 100 * intersection >= percent * union of their
    shingle sets. Equal sets share one node, so copies cost one row each and no
    pairs. No text or no words: an empty set, linked with nothing. A null doc_id:
    never linked, component_id null, kept true. Rows repeating a doc_id are judged
    one by one. Two documents at the threshold share a prefix of three values in
    at least one of 16 trees with probability 1 - 2e-7 at 85 and 1 - 1.1e-5 at 80
    percent; in crowded regions further trees keep to the same bound.
    """
    source = texts(docs)
    signed = written(source.mapInArrow(sign, "doc_id long, n_shingles long, fp binary, sig binary"), "signed")
    linked = signed.filter("fp is not null and doc_id is not null")
    nodes = linked.groupBy("fp").agg(F.min(F.struct("doc_id", "sig")).alias("s")).select("fp", "s.doc_id", "s.sig")
    rows = nodes.select("fp", "sig").mapInArrow(tree_rows, "key binary, fp binary")
    pairs = sorted_neighbours(rows)
    ids = pairs.select(F.col("a").alias("fp")).unionByName(pairs.select(F.col("b").alias("fp"))).distinct()
    wanted = written(nodes.join(ids, "fp", "left_semi"), "wanted")
    sets = written(source.join(wanted.select("doc_id").distinct(), "doc_id", "left_semi").mapInArrow(members, "fp binary, members binary")
                   .dropDuplicates(["fp"]), "sets")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "score"))
    best = both.groupBy("a").agg(F.max(F.struct("score", "b")).alias("s")).select("a", F.col("s.b").alias("b"))
    roots = merged(None, verified(best.select(*ordered()).distinct(), sets, percent))
    apart = rooted(pairs, roots, "a", "b").filter("r_a <> r_b").select("a", "b")
    roots = merged(roots, verified(apart.join(best.select(*ordered()).distinct(), ["a", "b"], "left_anti"), sets, percent))
    found, able = crowded_pairs(wanted.select("fp", "sig").mapInArrow(tree_rows, "key binary, fp binary"), sets, roots, pairs, percent)
    roots = merged(roots, verified(found, sets, percent))
    if further_trees(percent) and not able.isEmpty():
        tested = pairs.select("a", "b").unionByName(found)
        roots = merged(roots, verified(further_pairs(able, sets, roots, tested, percent), sets, percent))
    placed = rooted(signed.select("doc_id", "n_shingles", "fp"), roots, "fp")
    lowest = placed.filter("fp is not null and doc_id is not null").groupBy("r_fp").agg(F.min("doc_id").alias("lowest"))
    return placed.join(lowest, "r_fp", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("lowest", "doc_id")).alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("lowest", "doc_id"), F.lit(True)).alias("kept"))
