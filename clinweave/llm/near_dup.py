"""Near-duplicates by an LSH forest over MinHash signatures.

Each text class (texts with the same shingle set) gets `trees` labels of `levels` MinHash values. For every tree the
labels are sorted over the cluster, so near copies stand next to each other and share a prefix with their neighbours.
A region holds neighbours whose labels share LEAST values; where it is crowded, its labels are told apart one level
deeper, region by region.

Candidates come in three rounds. The first ties every member to its region's smallest node at each depth. Pairs are
confirmed on full shingle sets and give components. The second takes the regions
of at most CROWD members that still hold several components, and gives all pairs across components.
So a group of thousands of near copies costs a few pairs per member. The third compares, on full sets, all members of
crowded regions that still hold several components with all of other components: blocks of members meet pair by pair,
so the work is spread, and only links leave a pair of blocks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinweave.llm.components import components
from clinweave.llm.shared import checkpointed, written
from clinweave.llm.words import mix, pieces, shingle_sets, words_of
from clinweave.session import ship_package

TREES = 16
LEVELS = 8
LEAST = 4
CROWD = 48
#: Weight of a block of the last round: its shingles, and MEMBER for each member.
BLOCK = 1 << 20
MEMBER = 4096
#: Shared shingles of two blocks that are counted at once.
COLUMNS = 4096


def _hash_family(count: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * count + 1, dtype=np.uint64))
    return (seeds[:count] | np.uint64(1)).astype(np.uint32), seeds[count:].astype(np.uint32)


def signature(shingles: np.ndarray, factors: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """One 16-bit MinHash value per hash function."""
    low = shingles.astype(np.uint32)
    least = np.empty(len(factors), np.uint32)
    for k, (factor, mask) in enumerate(zip(factors, masks, strict=True)):
        least[k] = ((low ^ mask) * factor).min()
    return (mix(least.astype(np.uint64)) & np.uint64(0xFFFF)).astype(np.uint16)


def _describe(size: int):
    factors, masks = _hash_family(TREES * LEVELS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            sets = shingle_sets(words_of(piece.column("text"), lower=True), size)
            prints = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            signs = [signature(s, factors, masks).tobytes() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(prints, pa.binary()), pa.array(signs, pa.binary())],
                ["doc_id", "n_shingles", "print", "sign"],
            )

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            sets = shingle_sets(words_of(piece.column("text"), lower=True), size)
            ends = np.cumsum([0] + [len(s) for s in sets]).astype(np.int32)
            flat = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [piece.column("node"), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["node", "shingles"]
            )

    return run


def _labels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per tree and class."""
    for batch in batches:
        signs = np.frombuffer(b"".join(batch.column("sign").to_pylist()), ">u2")
        signs = signs.reshape(batch.num_rows, TREES, LEVELS)
        nodes, parts = batch.column("node"), batch.column("part")
        for tree in range(TREES):
            flat = np.ascontiguousarray(signs[:, tree]).tobytes()
            width = LEVELS * 2
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(nodes), tree, np.int32)),
                 pa.array([flat[k : k + width] for k in range(0, len(flat), width)], pa.binary()), nodes, parts],
                ["tree", "label", "node", "part"],
            )


def region_pairs(trees: np.ndarray, labels: np.ndarray, nodes: np.ndarray, parts: np.ndarray, across: bool) -> np.ndarray:
    """Candidate pairs (a, b), a < b, of one sorted run; `labels` has one row of LEVELS values per class.

    The first round (not `across`) ties members to the smallest node of their region, and splits crowded regions at the
    next depth. The second gives all pairs of different parts in regions of at most CROWD members; larger ones are
    compared in full by the third round, and give none here.
    """
    count = len(nodes)
    if count < 2:
        return np.zeros((0, 2), np.int64)
    same = labels[1:] == labels[:-1]
    shared = np.where(trees[1:] == trees[:-1], np.cumprod(same, axis=1).sum(axis=1), -1)
    found, active = [np.zeros((0, 2), np.int64)], np.ones(count, bool)

    for depth in range(LEAST, LEAST + 1 if across else LEVELS + 1):
        joined = (shared >= depth) & active[1:] & active[:-1]
        region = np.concatenate(([0], np.cumsum(~joined)))
        heads = np.flatnonzero(np.concatenate(([True], ~joined)))
        sizes = np.diff(np.append(heads, count))[region]
        crowded = active & (sizes > CROWD)
        if across:
            small = active & (sizes > 1) & ~crowded
            for step in range(1, min(CROWD, count - 1) + 1):
                at = np.flatnonzero(small[:-step] & (region[step:] == region[:-step]))
                if not len(at):
                    break
                at = at[parts[at] != parts[at + step]]
                found.append(np.stack([nodes[at], nodes[at + step]], 1))
        else:
            hubs = np.minimum.reduceat(nodes, heads)[region]
            at = np.flatnonzero(active & (sizes > 1))
            found.append(np.stack([hubs[at], nodes[at]], 1))
        active = crowded
        if not active.any():
            break
    pairs = np.concatenate(found)
    pairs.sort(axis=1)
    pairs = pairs[pairs[:, 0] < pairs[:, 1]]
    if not len(pairs):
        return pairs
    pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
    return pairs[np.concatenate(([True], (pairs[1:] != pairs[:-1]).any(axis=1)))]


_ROW = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("tree", pa.int32()), ("label", pa.binary())])


def _scan_run(across: bool, edges: bool):
    """Candidate pairs of one partition of sorted labels; with `edges`, also the rows at its two ends.

    A region may be cut by a partition border. The CROWD rows at either end go on to a second scan, where the ends of
    neighbouring partitions meet. Such a row has its node in `a` and its part in `b`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held)
        trees, nodes, parts = (rows.column(c).to_numpy() for c in ("tree", "node", "part"))
        texts = rows.column("label").to_pylist()
        labels = np.frombuffer(b"".join(texts), ">u2").reshape(len(nodes), LEVELS)
        pairs = region_pairs(trees, labels, nodes, parts, across)
        for k in range(0, len(pairs), 100_000):
            part = pairs[k : k + 100_000]
            nothing = [pa.nulls(len(part), pa.int32()), pa.nulls(len(part), pa.binary())]
            yield pa.RecordBatch.from_arrays([pa.array(part[:, 0]), pa.array(part[:, 1]), *nothing], schema=_ROW)
        if edges:
            ends = sorted({*range(min(CROWD, len(nodes))), *range(max(0, len(nodes) - CROWD), len(nodes))})
            columns = [pa.array(nodes[ends]), pa.array(parts[ends]), pa.array(trees[ends].astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([texts[k] for k in ends], pa.binary())], schema=_ROW)

    return run


def candidates(classes: DataFrame, across: bool) -> DataFrame:
    """Pairs (a, b), a < b, of classes (node, sign, part) that meet in some tree; with `across`, of different parts."""
    labels = classes.select("node", "sign", "part").mapInArrow(_labels, "tree int, label binary, node bigint, part bigint")
    schema = "a bigint, b bigint, tree int, label binary"
    order = ("tree", "label", "node")
    runs = written(
        labels.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_scan_run(across, True), schema), "forest"
    )
    ends = runs.where("label is not null").select("tree", "label", F.col("a").alias("node"), F.col("b").alias("part"))
    prefix = F.substring("label", 1, 2 * LEAST)
    seams = ends.repartition("tree", prefix).sortWithinPartitions(*order).mapInArrow(_scan_run(across, False), schema)
    return runs.where("label is null").select("a", "b").union(seams.select("a", "b")).distinct()


def _agreement(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        one, two = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16) for c in ("sign", "other"))
        share = (one == two).reshape(batch.num_rows, -1).mean(axis=1)
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(share)], ["a", "b", "share"])


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets are similar enough. Row by row in the JVM: two long texts are never held in a batch."""
    other = sets.select(F.col("node").alias("b"), F.col("shingles").alias("others"))
    both = F.size(F.array_intersect("shingles", "others"))
    return (
        pairs.select("a", "b").join(sets.withColumnRenamed("node", "a"), "a").join(other, "b")
        .where(100 * both >= percent * (F.size("shingles") + F.size("others") - both)).select("a", "b")
    )


def block_links(rows: pa.Table, percent: int) -> np.ndarray:
    """Links (a, b) of two blocks (side 0 and 1), or within one (side 0 alone), that tie their parts together.

    Every pair of different parts is compared on full sets. Of several links that join the same parts one is given.
    """
    rows = rows.combine_chunks()
    node, part, side = (rows.column(c).to_numpy() for c in ("node", "part", "side"))
    sets = rows.column("shingles").combine_chunks()
    values, ends = sets.flatten().to_numpy(), np.concatenate(([0], np.cumsum(sets.value_lengths().to_numpy())))
    owner = np.repeat(np.arange(len(node)), np.diff(ends))
    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1) if side.any() else left
    sizes = np.diff(ends)
    # shingles of both sides, numbered
    _, names = np.unique(values, return_inverse=True)
    one, two = np.isin(owner, left), np.isin(owner, right)
    held = np.bincount(names[one], minlength=len(values)) > 0
    held &= np.bincount(names[two], minlength=len(values)) > 0
    number = np.cumsum(held) - 1
    place = np.zeros(len(node), np.int64)
    common = np.zeros((len(left), len(right)))

    def spread(mine: np.ndarray, ids: np.ndarray, first: int) -> np.ndarray:
        place[mine] = np.arange(len(mine))
        among = np.isin(owner, mine) & held[names]
        at, column = place[owner[among]], number[names[among]] - first
        inside = (column >= 0) & (column < COLUMNS)
        matrix = np.zeros((len(mine), COLUMNS), np.float32)
        matrix[at[inside], column[inside]] = 1
        return matrix

    for first in range(0, int(held.sum()), COLUMNS):
        common += spread(left, names, first) @ spread(right, names, first).T
    union = sizes[left][:, None] + sizes[right][None, :] - common
    hits = (100 * common >= percent * union) & (part[left][:, None] != part[right][None, :])
    top = {p: p for p in part.tolist()}

    def root(p: int) -> int:
        while top[p] != p:
            top[p] = p = top[top[p]]
        return p

    found = []
    for x, y in zip(*(k.tolist() for k in np.nonzero(hits)), strict=True):
        a, b = left[x], right[y]
        one_root, two_root = root(int(part[a])), root(int(part[b]))
        if one_root != two_root:
            top[one_root] = two_root
            found.append((min(node[a], node[b]), max(node[a], node[b])))
    return np.array(found, np.int64).reshape(-1, 2)


def _block_links(percent: int):
    def run(rows: pa.Table) -> pa.Table:
        found = block_links(rows, percent)
        return pa.table({"a": found[:, 0], "b": found[:, 1]})

    return run


def crowded(signs: DataFrame) -> DataFrame:
    """(tree, prefix, node) of the members of all regions of more than CROWD classes; `signs` is (node, sign)."""
    labels = signs.withColumn("part", F.col("node")).mapInArrow(_labels, "tree int, label binary, node bigint, part bigint")
    labels = labels.select("tree", F.substring("label", 1, 2 * LEAST).alias("prefix"), "node")
    large = labels.groupBy("tree", "prefix").agg(F.count("*").alias("n")).where(F.col("n") > CROWD).drop("n")
    return written(labels.join(large, ["tree", "prefix"]), "near-crowded")


def families(members: DataFrame, groups: DataFrame) -> DataFrame:
    """(family, node, part) of the members of crowded regions that hold several components. A family is what such regions
    reach by shared members: every pair of a region is in one family, and a pair that meets in several trees only once.
    """
    parts = members.join(groups, "node", "left").select("tree", "prefix", "node", F.coalesce("component", "node").alias("part"))
    mixed = parts.groupBy("tree", "prefix").agg(F.min("node").alias("hub"), F.min("part").alias("low"), F.max("part").alias("high"))
    mixed = mixed.where("low < high").select("tree", "prefix", "hub")
    tied = checkpointed(parts.join(mixed, ["tree", "prefix"]).select(F.col("hub").alias("a"), F.col("node").alias("b"), "part").distinct())
    reached = components(tied.select("a", "b"))
    named = tied.select(F.col("b").alias("node"), "part").distinct().join(reached, "node")
    return checkpointed(named.select(F.col("component").alias("family"), "node", "part"))


def links_between(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that tie together the parts of each family (family, node, part), from all pairs of different parts.

    A part that fills a block has blocks of its own, which do not meet each other; the others share blocks. Blocks hold
    sets of one size class, and classes meet that are near enough for the threshold.
    """
    step = math.log(100 / max(percent, 1)) * (1 + 1e-6) + 1e-6
    rows = members.join(sets, "node").withColumn("class", F.floor(F.ln(F.size("shingles").cast("double")) / step))
    rows = rows.withColumn("weight", F.size("shingles").cast("long") + MEMBER)
    key = ["family", "class"]
    weighed = rows.groupBy(*key, "part").agg(F.sum("weight").alias("weight"))
    weighed = checkpointed(weighed.withColumn("own", F.when(F.col("weight") >= BLOCK, F.col("part"))))
    count = F.ceil(F.sum("weight") / F.lit(BLOCK)).cast("int")
    owners = checkpointed(weighed.groupBy(*key, F.coalesce("own", F.lit(-1)).alias("own"), F.col("own").isNull().alias("pool")).agg(count.alias("n")))
    blocks = owners.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).select(
        "family", "class", "own", "pool", "k", F.struct("class", "pool", "own", "k").alias("block")
    )
    other = blocks.select("family", *(F.col(c).alias(f"{c}2") for c in ("class", "own", "pool", "k", "block")))
    apart = F.expr("not (not pool and not pool2 and own = own2) and block <= block2 and abs(class - class2) <= 1")
    pairs = blocks.join(other, "family").where(apart).select("family", "block", "block2")
    ends = pairs.select("family", "block", "block2", F.lit(0).alias("side"), F.col("block").alias("mine")).union(
        pairs.where("block <> block2").select("family", "block", "block2", F.lit(1), F.col("block2"))
    )
    owned = weighed.select(*key, "part", F.coalesce("own", F.lit(-1)).alias("own"), F.col("own").isNull().alias("pool"))
    dealt = rows.join(owned, [*key, "part"]).join(owners, [*key, "own", "pool"])
    # whole parts of a pool stay together, so that a block of one part needs no look inside
    k = F.pmod(F.xxhash64(F.when(F.col("pool"), F.col("part")).otherwise(F.col("node"))), F.col("n")).cast("int")
    dealt = dealt.withColumn("k", k).withColumn("mine", F.struct("class", "pool", "own", "k"))
    meet = dealt.select("family", "mine", "node", "part", "shingles").join(ends, ["family", "mine"])
    meet = meet.select("family", "block", "block2", "side", "node", "part", "shingles")
    return meet.groupBy("family", "block", "block2").applyInArrow(_block_links(percent), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of `docs` (doc_id bigint, text): doc_id, n_shingles, component_id, kept.

    Texts are lower-cased (A-Z) and cut into words; a set holds the distinct shingles of `size` words, or the whole
    sequence of a shorter text. Two texts are linked when 100 * intersection >= percent * union; a component is all that
    links reach. component_id is its smallest doc_id, and that row is kept. A null or empty text has an empty set, is
    linked with nothing and kept. A row without doc_id cannot be named in a link: it is returned with a null
    component_id and kept. Repeated rows share a component. Further columns of `docs` are ignored.
    """
    ship_package(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    described = written(
        docs.mapInArrow(_describe(size), "doc_id bigint, n_shingles bigint, print binary, sign binary"), "near-signs"
    )
    classes = written(
        described.where("print is not null and doc_id is not null").groupBy("print")
        .agg(F.min("doc_id").alias("node"), F.first("sign").alias("sign")),
        "near-classes",
    )
    # a doc_id should stand on one text; if it stands on several, any of their links counts for it
    signs = classes.select("node", "sign")

    def alike(pairs: DataFrame) -> DataFrame:
        """Pairs whose signatures agree enough: five standard deviations below the threshold and more."""
        floor = percent / 100 - 5 * (percent / 100 * (1 - percent / 100) / (TREES * LEVELS)) ** 0.5
        other = signs.select(F.col("node").alias("b"), F.col("sign").alias("other"))
        pairs = pairs.join(signs.withColumnRenamed("node", "a"), "a").join(other, "b")
        shares = pairs.mapInArrow(_agreement, "a bigint, b bigint, share double")
        return checkpointed(shares.where(F.col("share") >= floor))

    def with_sets(pairs: DataFrame) -> DataFrame:
        ends = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
        texts = docs.withColumnRenamed("doc_id", "node").join(ends, "node", "left_semi").dropDuplicates(["node"])
        return written(texts.mapInArrow(_sets(size), "node bigint, shingles array<bigint>"), "near-sets")

    def apart(pairs: DataFrame, groups: DataFrame) -> DataFrame:
        """Pairs whose ends are not in one component yet."""
        for side in "ab":
            named = groups.select(F.col("node").alias(side), F.col("component").alias(f"of_{side}"))
            pairs = pairs.join(named, side, "left").withColumn(f"of_{side}", F.coalesce(f"of_{side}", side))
        return pairs.where("of_a <> of_b").select("a", "b")

    # first the likeliest partner of every class, then what is left between different components
    pairs = alike(candidates(signs.withColumn("part", F.col("node")), across=False))
    best = pairs.groupBy("b").agg(F.max_by("a", "share").alias("a"))
    links = checkpointed(_confirmed(best, with_sets(best), percent))
    groups = components(links)
    parts = signs.join(groups, "node", "left").select("node", "sign", F.coalesce("component", "node").alias("part"))
    across = candidates(parts, across=True).join(pairs.select("a", "b"), ["a", "b"], "left_anti")
    left = apart(pairs.join(best, ["a", "b"], "left_anti").select("a", "b"), groups).union(alike(across).select("a", "b"))
    left = checkpointed(left)
    if not left.isEmpty():
        links = checkpointed(links.union(_confirmed(left, with_sets(left), percent)))
        groups = components(links)
    # last, what crowded regions still hold apart
    members = families(crowded(signs), groups)
    if not members.isEmpty():
        ends = members.select(F.col("node").alias("a"), F.col("node").alias("b"))
        groups = components(links.union(links_between(members, with_sets(ends), percent)))
    named = classes.select("print", "node").join(groups, "node", "left")
    named = named.select("print", F.coalesce("component", "node").alias("component_id"))
    return (
        described.select("doc_id", "n_shingles", "print").join(named, "print", "left")
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
        .select("doc_id", "n_shingles", "component_id", "kept")
    )
