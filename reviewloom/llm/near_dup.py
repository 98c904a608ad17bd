"""MinHash near-dedup by chosen paths.

Every document walks down a number of independent trees: at a node it chooses the shingle that
is smallest under the node's own hash, and that names the child. Similar documents choose alike,
so they meet in a node. A node with few documents is compared exhaustively there; one with many
branches again. Comparing there means sketches, with a threshold so low that hardly any true
link is lost; it gives groups, and inside a group every pair of documents is judged on its full
shingle sets, except that documents already connected need no further comparison.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import written
from reviewloom.llm.graph import components
from reviewloom.llm.hashing import WordHashes, mix, spaced_words, windows

SHINGLE = 5
#: A link: 100 * intersection >= LINK * union.
LINK = 75
#: Wanted share of the pairs at the threshold that meet in a node of the second level; it gives
#: the number of trees.
RECALL, DEPTH, NODE = 0.999, 4, 64
#: Documents compared at once on their full sets, and sketches of a side that meet in a task.
BLOCK, CHUNK = 256, 2_048
BINS = 128


def trees_for(recall: float, link: int = LINK, level: int = 2) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - (link / 100) ** level))


def shingle_set(words: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes of 5-word shingles; of the whole sequence where it is shorter."""
    return np.unique(windows(words, min(SHINGLE, len(words)))) if len(words) else words


def sketches(docs: DataFrame, id_col: str, text: str, trees: int, depth: int) -> DataFrame:
    """(id, text_hash, n_shingles, set_a, set_b, paths, sketch) of each row.

    set_a and set_b are two sums over the set, by which equal sets are known. paths holds the node
    of each tree and level; sketch holds 16 bits of the smallest hash in each of 128 ranges.
    """

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sets = [shingle_set(known.of(spaced_words(x, lower=True))) for x in part.column(2).to_pylist()]
                sizes = np.array([len(x) for x in sets])
                full = np.flatnonzero(sizes)
                nodes = np.zeros((len(sets), trees * depth), dtype=np.int64)
                bins = np.zeros((len(sets), BINS), dtype="<u2")
                sums = np.zeros((2, len(sets)), dtype=np.int64)
                if len(full):
                    every = np.concatenate([sets[i] for i in full])
                    lengths = sizes[full]
                    starts = np.cumsum(lengths) - lengths
                    sums[0, full] = np.add.reduceat(mix(every), starts).view(np.int64)
                    sums[1, full] = np.add.reduceat(mix(every + np.uint64(1)), starts).view(np.int64)
                    place = np.repeat(full, lengths) * BINS + (every >> np.uint64(57)).astype(np.int64)
                    first = np.ones(len(every), bool)
                    first[1:] = place[1:] != place[:-1]
                    bins.reshape(-1)[place[first]] = np.maximum(every[first] & np.uint64(0xFFFF), 1)
                    for tree in range(trees):
                        node = np.full(len(full), mix(np.array([tree + 1], np.uint64))[0])
                        for level in range(depth):
                            chosen = np.minimum.reduceat(mix(every ^ np.repeat(node, lengths)), starts)
                            node = mix(node + chosen)
                            nodes[full, tree * depth + level] = node.view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(sizes, pa.int64()), pa.array(sums[0]), pa.array(sums[1]),
                     pa.ListArray.from_arrays(
                         pa.array(np.arange(0, nodes.size + 1, trees * depth), pa.int32()), pa.array(nodes.reshape(-1))),
                     pa.array([x.tobytes() for x in bins], pa.binary())],
                    ["id", "text_hash", "n_shingles", "set_a", "set_b", "paths", "sketch"])

    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(made, f"id {kind}, text_hash long, n_shingles long, set_a long, set_b long,"
                                 " paths array<long>, sketch binary")


def _leaves(classes: DataFrame, trees: int, depth: int, most: int) -> tuple[DataFrame, DataFrame]:
    """(node, id): documents of the nodes to compare, each node of at most most + 1 documents; and
    (node, id, n): those of nodes that hold n, which is more, on the last level.

    A node with more branches; on the last level it is dealt to parts, each with the node's
    smallest id, which keeps the parts of one family together. What that does not connect is left
    to _left_apart.
    """
    level = classes.select("id", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(trees - 1)),
        lambda t: F.slice("paths", t * depth + 1, depth))).alias("tree", "path"))
    found = None
    for at in range(depth):
        level = level.withColumn("node", F.get("path", F.lit(at)))
        counts = level.groupBy("node").agg(F.count("*").alias("n"), F.min("id").alias("leader")).where("n > 1")
        level = written(level.drop("n", "leader").join(counts, "node"))
        leaf = level.where(F.col("n") <= most).select("node", "id")
        found = leaf if found is None else found.unionByName(leaf)
        level = level.where(F.col("n") > most)
    parts = F.ceil(F.col("n") / most)
    dealt = level.withColumn("node", F.xxhash64("node", F.pmod(F.xxhash64("id", "node"), parts)))
    leaders = dealt.select("node", F.col("leader").alias("id")).distinct()
    return (found.unionByName(dealt.select("node", "id")).unionByName(leaders).distinct(),
            level.select("node", "id", "n"))


class _Forest:
    """Union-find over places."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def _alike(sizes: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """Pairs of places that may be linked, by size and sketch."""
    return np.argwhere(np.triu(_may_link(sizes, bins, sizes, bins), 1))


def _may_link(sizes: np.ndarray, bins: np.ndarray, others: np.ndarray, other_bins: np.ndarray) -> np.ndarray:
    """Whether each may be linked with each other, by size and sketch: four deviations below the threshold."""
    held, other_held = bins > 0, other_bins > 0
    same = (bins[:, None, :] == other_bins[None, :, :]) & held[:, None, :]
    either = (held[:, None, :] | other_held[None, :, :]).sum(axis=2)
    share = same.sum(axis=2) / np.maximum(either, 1)
    link = LINK / 100
    least = link - 4 * np.sqrt(link * (1 - link) / np.maximum(either, 1))
    small, large = np.minimum.outer(sizes, others), np.maximum.outer(sizes, others)
    return (share >= least) & (100 * small >= LINK * large)


class _Ids(dict):
    """Union-find over ids; the smallest of a part is its root."""

    def __missing__(self, x):
        self[x] = x
        return x

    def root(self, x):
        while self[x] != x:
            self[x] = self[self[x]]
            x = self[x]
        return x

    def join(self, a, b) -> None:
        a, b = self.root(a), self.root(b)
        self[max(a, b)] = min(a, b)


def _links_of(forest: _Ids, kind: str) -> Iterator[pa.RecordBatch]:
    links = [(x, forest.root(x)) for x in list(forest) if forest.root(x) != x]
    for at in range(0, len(links), 10_000):
        some = list(zip(*links[at:at + 10_000], strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(x, arrow_type(kind)) for x in some], ["a", "b"])


def _candidates(leaves: DataFrame, classes: DataFrame, kind: str) -> DataFrame:
    """(a, b): the likely links in all nodes, as a forest for each partition."""

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = _Ids()
        for batch in batches:
            members = batch.column(0)
            flat = members.flatten()
            ids = flat.field("id").to_pylist()
            sizes = flat.field("n_shingles").to_numpy(zero_copy_only=False)
            bins = np.frombuffer(b"".join(flat.field("sketch").to_pylist()), "<u2").reshape(-1, BINS)
            ends = np.cumsum(pa.compute.list_value_length(members).to_numpy(zero_copy_only=False))
            start = 0
            for end in ends.tolist():
                for i, j in _alike(sizes[start:end], bins[start:end]).tolist():
                    forest.join(ids[start + i], ids[start + j])
                start = end
        yield from _links_of(forest, kind)

    nodes = (leaves.join(classes.select("id", "n_shingles", "sketch"), "id")
             .groupBy("node").agg(F.collect_list(F.struct("id", "n_shingles", "sketch")).alias("members"))
             .select("members"))
    return nodes.mapInArrow(compared, f"a {kind}, b {kind}")


def _left_apart(large: DataFrame, likely: DataFrame, classes: DataFrame, kind: str, chunk: int = CHUNK) -> DataFrame:
    """(a, b): the likely links that dealing the large nodes to parts has missed.

    large: (node, id, n) of the nodes; likely: (id, group) as connected so far. In a node of several
    groups every document outside the largest is compared with the whole node, chunk by chunk: that is
    each pair that is not connected yet. A family of near copies is one group and costs nothing here.
    """
    placed = large.join(likely, "id", "left").select("node", "id", "n", F.coalesce("group", "id").alias("group"))
    placed = written(placed)
    sizes = placed.groupBy("node", "group").agg(F.count("*").alias("size"))
    several = sizes.groupBy("node").agg(
        F.max(F.struct("size", "group")).alias("top"), F.sum("size").alias("all")).where("all > top.size").select(
        "node", F.col("top.group").alias("largest"), F.ceil(F.col("all") / chunk).alias("chunks"),
        F.ceil((F.col("all") - F.col("top.size")) / chunk).alias("parts"))
    rows = written(placed.select("node", "id", "group").join(several, "node").join(
        classes.select("id", "n_shingles", "sketch"), "id"))

    def dealt(count: str, salt: str):
        return F.pmod(F.xxhash64("id", F.lit(salt)), F.col(count))

    def every(count: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))

    member = F.struct("side", "id", "group", "n_shingles", "sketch").alias("member")
    left = (rows.where("group <> largest").withColumn("part", dealt("parts", "part"))
            .withColumn("chunk", every("chunks")).withColumn("side", F.lit(0)))
    right = rows.withColumn("chunk", dealt("chunks", "chunk")).withColumn("part", every("parts")).withColumn("side", F.lit(1))
    meeting = left.select("node", "part", "chunk", member).unionByName(right.select("node", "part", "chunk", member))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = _Ids()
        for batch in batches:
            for members in batch.column(0):
                flat = members.values
                ids, groups = flat.field("id").to_pylist(), flat.field("group").to_numpy(zero_copy_only=False)
                sizes = flat.field("n_shingles").to_numpy(zero_copy_only=False)
                bins = np.frombuffer(b"".join(flat.field("sketch").to_pylist()), "<u2").reshape(-1, BINS)
                side = flat.field("side").to_numpy(zero_copy_only=False)
                one, two = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
                for at in range(0, len(one), 32):
                    some = one[at:at + 32]
                    found = _may_link(sizes[some], bins[some], sizes[two], bins[two])
                    found &= groups[some][:, None] != groups[two][None, :]
                    for i, j in np.argwhere(found).tolist():
                        forest.join(ids[some[i]], ids[two[j]])
        yield from _links_of(forest, kind)

    nodes = meeting.groupBy("node", "part", "chunk").agg(F.collect_list("member").alias("members")).select("members")
    return nodes.mapInArrow(compared, f"a {kind}, b {kind}")


def shared_counts(sets: list[np.ndarray], others: list[np.ndarray] | None = None) -> np.ndarray:
    """Sizes of the intersections of all sets with all others (or with each other)."""
    both = sets + (others or [])
    lengths = [len(x) for x in both]
    value, place = np.unique(np.concatenate(both), return_inverse=True) if sum(lengths) else (np.zeros(0), np.zeros(0, int))
    often = np.bincount(place, minlength=len(value)) > 1
    column = np.cumsum(often) - 1
    owner = np.repeat(np.arange(len(both)), lengths)[often[place]]
    column = column[place[often[place]]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    n, m = len(sets), len(both)
    found = np.zeros((n, m - n if others else n), dtype=np.int64)
    for at in range(0, int(often.sum()), 4096):
        low, high = np.searchsorted(column, (at, at + 4096))
        held = np.zeros((m, 4096), dtype=np.float32)
        held[owner[low:high], column[low:high] - at] = 1
        found += np.rint(held[:n] @ held[n if others else 0:].T).astype(np.int64)
    return found


def linked(sets: list[np.ndarray], others: list[np.ndarray] | None = None, link: int = LINK) -> np.ndarray:
    """Whether 100 * intersection >= link * union, for all sets with all others."""
    inside = shared_counts(sets, others)
    one = np.array([len(x) for x in sets])[:, None]
    two = np.array([len(x) for x in (sets if others is None else others)])[None, :]
    return 100 * inside >= link * (one + two - inside)


def _grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[dict[str, list]]:
    """The columns of each run of rows with one key; only one run is held."""
    run: dict[str, list] = {}
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64).to_pydict()
            for i in range(len(part[key])):
                if run and run[key][0] != part[key][i]:
                    yield run
                    run = {}
                for name, values in part.items():
                    run.setdefault(name, []).append(values[i])
    if run:
        yield run


def _sets(texts: list[str], known: WordHashes) -> list[np.ndarray]:
    return [shingle_set(known.of(spaced_words(x, lower=True))) for x in texts]


def _linked_in_blocks(rows: DataFrame, kind: str) -> DataFrame:
    """(a, b, hub, n): verified links inside each block of rows (block, id, text, n).

    Each document of a block gets a row: b is the smallest id of its part (itself perhaps), hub
    the document with most links there, and n is passed on.
    """

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for run in _grouped(batches, "block"):
            ids = run["id"]
            links = linked(_sets(run["text"], known))
            np.fill_diagonal(links, False)
            forest = _Forest(len(ids))
            for i, j in np.argwhere(np.triu(links, 1)).tolist():
                forest.join(i, j)
            degree, roots = links.sum(axis=1), [forest.root(i) for i in range(len(ids))]
            hub: dict[int, int] = {}
            for i, r in enumerate(roots):
                if r not in hub or degree[i] > degree[hub[r]]:
                    hub[r] = i
            schema = arrow_type(kind)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, schema), pa.array([ids[r] for r in roots], schema),
                 pa.array([ids[hub[r]] for r in roots], schema), pa.array(run["n"], pa.int64())],
                ["a", "b", "hub", "n"])

    return (rows.repartition("block").sortWithinPartitions("block", "id")
            .mapInArrow(judged, f"a {kind}, b {kind}, hub {kind}, n long"))


def arrow_type(kind: str) -> pa.DataType:
    return pa.string() if kind == "string" else pa.int32() if kind == "int" else pa.int64()


def _linked_across(left: DataFrame, right: DataFrame, kind: str) -> DataFrame:
    """(a, b): for each document of left and each component met in a block of right, one verified
    link if there is any. left: (block, id, text, component) with the block of right to be met."""
    rows = left.withColumn("side", F.lit(0)).unionByName(right.withColumn("side", F.lit(1)))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for run in _grouped(batches, "block"):
            sides = np.array(run["side"])
            one, two = np.flatnonzero(sides == 0), np.flatnonzero(sides == 1)
            if not len(one) or not len(two):
                continue
            sets = _sets(run["text"], known)
            links = linked([sets[i] for i in one], [sets[i] for i in two])
            found = {}
            for i, j in np.argwhere(links).tolist():
                a, b = one[i], two[j]
                if run["component"][a] != run["component"][b]:
                    found.setdefault((a, run["component"][b]), b)
            schema = arrow_type(kind)
            yield pa.RecordBatch.from_arrays(
                [pa.array([run["id"][a] for a, _ in found], schema),
                 pa.array([run["id"][b] for b in found.values()], schema)], ["a", "b"])

    return (rows.repartition("block").sortWithinPartitions("block", "side", "id")
            .mapInArrow(judged, f"a {kind}, b {kind}"))


def _verified(groups: DataFrame, texts: DataFrame, kind: str, block: int) -> DataFrame:
    """(id, component): what links on full sets connect inside a group.

    groups: (id, group, n). A group of at most `block` documents is one block, whose parts are
    final. A larger one is dealt to blocks; the hubs of their parts are dealt to blocks again
    until they are one. What is then outside its group's largest part is compared with the whole
    group, block by block. Texts are joined by the same sort-merge join at every size.
    """
    rows = written(groups.join(texts.hint("merge"), "id"))
    parts = F.ceil(F.col("n") / block)
    dealt = rows.withColumn("block", F.xxhash64(
        "group", F.when(F.col("n") > block, F.pmod(F.xxhash64("id"), parts)).otherwise(0)))
    first = written(_linked_in_blocks(dealt.select("block", "id", "text", "n"), kind))
    done = first.where(F.col("n") <= block).select(F.col("a").alias("id"), F.col("b").alias("component"))
    large = rows.where(F.col("n") > block)
    if large.isEmpty():
        return done
    first = first.where(F.col("n") > block)
    edges = first.select("a", "b").where("a <> b")
    hubs = large.join(first.select("hub").distinct(), F.col("id") == F.col("hub"), "left_semi")
    tied = first.select(F.col("a"), F.col("hub").alias("b")).where("a <> b")
    edges = edges.unionByName(tied)
    before = None
    for salt in range(1, 20):
        hubs = hubs.drop("n").join(hubs.groupBy("group").agg(F.count("*").alias("n")), "group")
        dealt = hubs.withColumn("block", F.xxhash64(
            "group", F.pmod(F.xxhash64("id", F.lit(salt)), F.ceil(F.col("n") / block))))
        more = written(_linked_in_blocks(dealt.select("block", "id", "text", "n"), kind))
        edges = edges.unionByName(more.select("a", "b").where("a <> b")).unionByName(
            more.select("a", F.col("hub").alias("b")).where("a <> b"))
        hubs = written(hubs.join(more.select("hub").distinct(), F.col("id") == F.col("hub"), "left_semi"))
        left = hubs.groupBy("group").count().agg(F.max("count")).first()[0]
        if left <= block or (before and 2 * left > before):  # few links are left to find this way
            break
        before = left
    part = components(edges).withColumnsRenamed({"node": "id"})
    placed = written(large.join(part, "id", "left").withColumn("component", F.coalesce("component", "id")))
    sizes = placed.groupBy("group", "component").agg(F.count("*").alias("size"))
    largest = sizes.groupBy("group").agg(F.max(F.struct("size", "component")).alias("top"), F.count("*").alias("k"))
    apart = placed.join(largest.where("k > 1"), "group").where(F.col("component") != F.col("top.component"))
    chunk = F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / block)).cast("long")
    own = F.pmod(F.xxhash64("id", F.lit("own")), F.ceil(F.col("apart") / block)).cast("long")
    apart = apart.join(apart.groupBy("group").agg(F.count("*").alias("apart")), "group").withColumn("own", own)
    shape = apart.groupBy("group").agg(F.max("own").alias("last"))
    left = (apart.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("n") / block) - 1)))
            .select(F.xxhash64("group", "chunk", "own").alias("block"), "id", "text", "component"))
    right = (placed.join(shape, "group").withColumn("chunk", chunk)
             .withColumn("own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))))
             .select(F.xxhash64("group", "chunk", "own").alias("block"), "id", "text", "component"))
    across = written(_linked_across(left, right, kind))
    own = placed.select("id", "component")
    if across.isEmpty():
        return done.unionByName(own)
    one = own.select(F.col("id").alias("a"), F.col("component").alias("one"))
    two = own.select(F.col("id").alias("b"), F.col("component").alias("two"))
    pairs = across.join(one, "a").join(two, "b")
    merged = components(pairs.select(F.col("one").alias("a"), F.col("two").alias("b")).where("a <> b"))
    last = merged.select(F.col("node").alias("component"), F.col("component").alias("last"))
    return done.unionByName(own.join(last, "component", "left").select(
        "id", F.coalesce("last", "component").alias("component")))


def _groups(links: DataFrame) -> DataFrame:
    """(id, group) of the connected documents."""
    return written(components(links).select(F.col("node").alias("id"), F.col("component").alias("group")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", recall: float = RECALL,
                    depth: int = DEPTH, node: int = NODE, block: int = BLOCK) -> DataFrame:
    """(id, text_hash, n_shingles, component_id, kept) of each row of docs.

    Rows with equal sets are one class, known by its smallest id. A text that is null or has no
    word has an empty set and is linked with nothing. Repeated rows get equal results; rows with
    one id but different texts count as linked where either is. A row without an id takes the
    component of its class, and is kept only if that has none. Whole texts are read, however long;
    of a group the smallest id stays, so there are no ties. Other columns, whatever their names, are
    not read; an empty table gives an empty one.
    """
    trees = trees_for(recall)
    sketch = written(sketches(docs, id_col, text, trees, depth))
    kind = sketch.schema["id"].dataType.simpleString()
    own = ["set_a", "set_b", "n_shingles"]
    classes = written(
        sketch.where("n_shingles > 0").groupBy(*own).agg(
            F.min("id").alias("id"), F.first("paths").alias("paths"), F.first("sketch").alias("sketch"))
        .where("id IS NOT NULL"))
    leaves, large = _leaves(classes, trees, depth, node)
    likely = _groups(_candidates(leaves, classes, kind))
    if not large.isEmpty():
        apart = written(_left_apart(large, likely, classes, kind))
        if not apart.isEmpty():
            known = likely.select(F.col("id").alias("a"), F.col("group").alias("b")).where("a <> b")
            likely = _groups(known.unionByName(apart))
    groups = likely.join(likely.groupBy("group").agg(F.count("*").alias("n")), "group")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    part = _verified(groups, texts, kind, block).groupBy("id").agg(F.min("component").alias("component"))
    class_of = classes.select(*own, F.col("id").alias("class")).join(
        part.withColumnRenamed("id", "class"), "class", "left").select(
        *own, F.coalesce("component", "class").alias("component"))
    return sketch.select("id", "text_hash", *own).join(class_of, own, "left").select(
        F.col("id").alias(id_col), "text_hash", "n_shingles",
        F.coalesce("component", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component", "id"), F.col("component").isNull()).alias("kept"))
