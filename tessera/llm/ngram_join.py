"""N-gram Jaccard join: a MinHash LSH forest, then exact verification.

Texts that are equal are one node. A node's word shingles (five words; a
shorter text is one shingle) give ``trees`` labels of ``depth`` MinHash values,
one a prefix trie. Longest prefixes are matched first: the nodes below a trie
node are linked to one of them (a star, never all pairs), which alone rises to
the next shorter prefix. Prefixes are shortened level by level for the nodes
still short of the target recall: a node stops at the longest prefix at which
its least similar possible partner, which follows from its number of shingles
(``reachable``), is found with ``recall``, 1 - (1 - s**d)**trees. A pair is
found at the longer of its two nodes' last prefixes, which serves both. No
pair at the threshold needs less than ``prefix_depth`` values, so branches with
one node below such a prefix are cut off before.

The stars' components are put in trie order and cut into blocks of bounded
size. A task verifies, on the exact shingle sets, all pairs within a block or
between two blocks that share a prefix, and returns one row per node (links
and a spanning edge). A set travels once for each block that its own block
shares a prefix with, however large the component is. Classes are the
components of verified links.

No link between different texts is lost once its pair is a candidate, and
none is capped. The rows of texts that the verification moves are those of
candidates only.

Edge cases: null and empty texts, and texts of white space, have no shingles:
they never link and each *text* is a class of its own (equal ones share it);
very long texts count in the block size; repeated rows are copies; a null
key is ignored by ``class_id`` unless a class has no other (then null); only
key and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.components import components
from tessera.llm.scratch import appended, as_row, dropped, from_row, mixed, shingle_hashes, ship, text_steps, word_hashes, written

WORDS = 5
THRESHOLD = 0.8
TREES = 16
DEPTH = 8
RECALL = 0.9995
#: Nodes and shingles in a block; a verification task holds two blocks.
BLOCK_NODES, BLOCK_SHINGLES = 512, 1 << 22
#: Sets of up to so many shingles have a depth of their own; the possible similarities of larger ones come close to any.
SMALL = 16
#: Bits of the first label values that order a component's nodes.
PLACE_BITS = (32, 16, 16)


def prefix_depth(threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> int:
    """The longest prefix, shortened from ``depth``, at which a pair at the threshold is found with ``recall``."""
    d = depth
    while d > 1 and 1 - (1 - threshold ** d) ** trees < recall:
        d -= 1
    return d


def _constants(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    x = mixed(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
    return x[:n], x[n:] | np.uint64(1)


def reachable(size: int, threshold: float) -> float:
    """The least Jaccard similarity from ``threshold`` on that a set of ``size`` elements can have to another set."""
    least = 1.0
    for both in range(1, size + 1):
        others = math.floor(both / threshold - size + 1e-9)      # elements of the other set alone
        if others >= 0:
            least = min(least, both / (size + others))
    return least


def rest_bits(depth: int, shortest: int) -> int:
    """Bits of each label value beyond the shortest prefix, all of them in one long."""
    return min(16, 64 // (depth - shortest)) if depth > shortest else 0


def _small_sizes(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Distinct shingles of each text of at most ``SMALL``, else the number of its shingles."""
    counts = np.diff(at)
    row = np.repeat(np.arange(len(counts)), counts)
    few = counts[row] <= SMALL
    row, h = row[few], h[few]
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    return np.where(counts <= SMALL, np.bincount(row[new], minlength=len(counts)), counts)


def forest_labels(column, words: int, threshold: float, trees: int, depth: int, recall: float, seed: int = 1):
    """Per text: each tree's hash of the shortest prefix, its further values packed, place, shingles, depth to stop at.

    Texts without words have no labels.
    """
    flips, odds = _constants(trees * depth, seed)
    shortest = prefix_depth(threshold, trees, depth, recall)
    bits = rest_bits(depth, shortest)
    stops = np.array([shortest] + [prefix_depth(reachable(m, threshold), trees, depth, recall) for m in range(1, SMALL + 1)])
    prefixes: list = []
    rests: list = []
    places, sizes, deep = [], [], []
    for _, _, data, offsets in text_steps(column):
        h, at = shingle_hashes(*word_hashes(data, offsets), words)
        counts = np.diff(at)
        full = np.flatnonzero(counts)
        label = np.zeros((trees, len(full)), np.uint64)
        rest = np.zeros((trees, len(full)), np.uint64)
        place = np.zeros(len(counts), np.uint64)
        if len(full):
            left = 64
            for t in range(trees):
                for j in range(depth):
                    k = t * depth + j
                    least = np.minimum.reduceat((h ^ flips[k]) * odds[k], at[full])
                    value = mixed(least + np.uint64(k))
                    if j < shortest:
                        label[t] = mixed(label[t] + value)
                    else:
                        rest[t] |= (value >> np.uint64(64 - bits)) << np.uint64(bits * (depth - 1 - j))
                    if t == 0 and j < len(PLACE_BITS):
                        left -= PLACE_BITS[j]
                        place[full] |= (value >> np.uint64(64 - PLACE_BITS[j])) << np.uint64(left)
        for out, values in ((prefixes, label), (rests, rest)):
            found = iter(values.T.astype(np.int64))
            out += [next(found) if c else None for c in counts]
        small = _small_sizes(h, at)
        deep.append(np.where(small <= SMALL, stops[np.minimum(small, SMALL)], shortest))
        places.append(place.astype(np.int64))
        sizes.append(counts)
    whole = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (places, sizes, deep)]
    return prefixes, rests, *whole


def trie_edges(tries: DataFrame, depth: int, shortest: int) -> DataFrame:
    """(node, hub) of nodes that share a prefix, from the longest on; ``tries`` has node, deep, p and rest.

    A level's input is one node for each longer prefix, so a hot prefix sends
    at most one row a map task through the aggregation and one up a level.
    """
    bits = rest_bits(depth, shortest)
    edges = None
    rising = tries
    for d in range(depth, shortest - 1, -1):
        values = F.lit(0).cast("long") if d == shortest else F.shiftrightunsigned("rest", bits * (depth - d))
        level = rising.where(F.col("deep") <= d).withColumn("r", values)
        heads = written(level.groupBy("p", "r").agg(F.min(F.struct("deep", "node", "rest")).alias("h"),
                                                    F.count("*").alias("n")), "trie-level")
        hubs = heads.where("n > 1").select("p", "r", F.col("h.node").alias("hub"))
        found = level.join(hubs, ["p", "r"]).where("node <> hub").select("node", "hub")
        edges = found if edges is None else edges.unionByName(found)
        rising = heads.select("h.node", "h.deep", "p", "h.rest")
    return edges.distinct()


def blocked(groups: DataFrame) -> DataFrame:
    """``groups`` (comp, place, node, shingles, …) with ``block``: a component's nodes in trie order, cut at the bounds."""
    most_nodes, most_shingles = BLOCK_NODES, BLOCK_SHINGLES

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block = (TaskContext.get().partitionId() << 33) - 1
        comp, n, held = None, 0, 0
        for frame in frames:
            out = []
            for c, size in zip(frame["comp"], frame["shingles"]):
                if c != comp or n == most_nodes or held + size > most_shingles:
                    block, comp, n, held = block + 1, c, 0, 0
                n, held = n + 1, held + size
                out.append(block)
            yield frame.assign(block=np.array(out, np.int64))

    order = ["comp", "place", "node"]
    rows = groups.repartitionByRange(*order).sortWithinPartitions(*order)
    return rows.mapInPandas(cut, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in groups.schema) + ", block long")


def block_pairs(blocks: DataFrame, tries: DataFrame) -> DataFrame:
    """(block, i, j), i <= j: the tasks that a block's nodes go to, those of blocks that share a prefix and its own."""
    own = blocks.select("block").distinct().selectExpr("block", "block as i", "block as j")
    several = blocks.groupBy("comp").agg(F.min("block").alias("a"), F.max("block").alias("b")).where("a < b").select("comp")
    held = blocks.join(several, "comp", "left_semi").select("node", "block")
    seen = written(tries.select("node", "p").join(held, "node").select("p", "block").distinct(), "prefix-blocks")
    other = seen.select("p", F.col("block").alias("j"))
    cross = seen.join(other, "p").where("block < j").select(F.col("block").alias("i"), "j").distinct()
    cross = written(cross, "block-pairs")
    return (own.unionByName(cross.selectExpr("i as block", "i", "j"))
            .unionByName(cross.selectExpr("j as block", "i", "j")))


def shingle_sets(column, words: int) -> list[bytes]:
    """Sorted distinct shingle hashes of each text."""
    out = []
    for _, _, data, offsets in text_steps(column):
        h, at = shingle_hashes(*word_hashes(data, offsets), words)
        out += [np.unique(h[a:b]).tobytes() for a, b in zip(at, at[1:])]
    return out


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of the number of shared elements of every two sets.

    Elements of few sets are counted pair by pair, those of many sets by
    products of 0/1 matrices over slices of the elements.
    """
    m = len(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    values = np.concatenate(sets) if m else np.zeros(0, np.uint64)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    starts = np.flatnonzero(new)
    df = np.diff(np.append(starts, len(values)))
    counts = np.zeros(m * m, np.int64)
    for d in range(2, min(12, m) + 1):
        at = starts[df == d]
        if len(at):
            held = owner[at[:, None] + np.arange(d)]
            for i in range(d):
                for j in range(i + 1, d):
                    counts += np.bincount(held[:, i] * m + held[:, j], minlength=m * m) if len(at) * 4 > m * m else 0
                    if len(at) * 4 <= m * m:
                        np.add.at(counts, held[:, i] * m + held[:, j], 1)
    counts = counts.reshape(m, m)
    counts = counts + counts.T
    many = np.flatnonzero(df > 12)
    for lo in range(0, len(many), 4096):
        part = many[lo:lo + 4096]
        sizes = df[part]
        column = np.repeat(np.arange(len(part)), sizes)
        at = np.repeat(starts[part] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
        held = np.zeros((m, len(part)), np.float32)
        held[owner[at], column] = 1
        counts += np.rint(held @ held.T).astype(np.int64)
    return counts


def verified(nodes: list[str], copies: np.ndarray, sets: list[np.ndarray], left: np.ndarray, threshold: float):
    """(links, root) per node of one block pair; ``left`` marks the first block (all of it: one block)."""
    sizes = np.array([len(s) for s in sets])
    both = shared_counts(sets)
    linked = both >= threshold * (sizes[:, None] + sizes[None, :] - both) - 1e-9
    linked &= both > 0
    np.fill_diagonal(linked, False)
    if not left.all():
        linked &= left[:, None] != left[None, :]
    links = linked @ copies
    label = np.arange(len(nodes))
    while True:                                   # least label over links until nothing moves
        nxt = np.minimum(label, np.where(linked, label[None, :], len(nodes)).min(1, initial=len(nodes)))
        nxt = nxt[nxt]
        if (nxt == label).all():
            return links, label
        label = nxt


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS,
                    threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH,
                    recall: float = RECALL) -> DataFrame:
    """One row per row of ``docs``: key, class_id (least key of the class), n_links, class_size, text_md5, class_md5.

    ``n_links`` counts the rows whose text is linked to this row's: equal
    texts, and texts with a Jaccard similarity from ``threshold`` on.
    """
    ship(docs.sparkSession)
    shortest = prefix_depth(threshold, trees, depth, recall)

    def sign(column):
        prefixes, rests, places, sizes, deep = forest_labels(column, words, threshold, trees, depth, recall)
        return [pa.array(prefixes, pa.list_(pa.int64())), pa.array(rests, pa.list_(pa.int64())), pa.array(places, pa.int64()),
                pa.array(sizes, pa.int64()), pa.array(deep, pa.int32())]

    plain = F.coalesce(F.col(text).cast("string"), F.lit(""))
    base = docs.select(F.col(key).alias("k"), F.md5(plain).alias("node"), plain.alias("__x"))
    signed = written(appended(base, "__x", "prefixes array<long>, rests array<long>, place long, shingles long, deep int",
                              sign, keep_text=False), "signatures")
    facts = ["place", "shingles", "deep", "prefixes", "rests"]
    nodes = written(signed.groupBy("node").agg(F.min("k").alias("rep"), F.count("*").alias("copies"),
                                               *[F.first(c).alias(c) for c in facts]), "nodes")
    labels = nodes.select("node", "deep", F.explode(F.arrays_zip("prefixes", "rests")).alias("l")).select(
        "node", "deep", F.col("l.prefixes").alias("p"), F.col("l.rests").alias("rest"))
    roots = written(labels.groupBy("p").agg(F.count("*").alias("n")).where("n > 1").select("p"), "roots")
    tries = written(labels.join(roots, "p", "left_semi"), "tries")
    stars = trie_edges(tries, depth, shortest)
    groups = written(components(stars, "node", "hub").withColumnRenamed("label", "comp").join(
        nodes.select("node", "rep", "copies", "place", "shingles"), "node"), "candidates")
    blocks = written(blocked(groups).drop("place", "shingles"), "blocks")
    deals = block_pairs(blocks, tries)
    # One plan at every size: the texts meet their blocks by a shuffle, whether or not the blocks would fit a broadcast.
    texts = base.join(blocks.hint("merge"), (base.node == blocks.node) & base.k.eqNullSafe(blocks.rep)).select(
        blocks.node, "copies", "block", F.col("__x"))

    def sets(column):
        return [pa.array(shingle_sets(column, words), pa.binary())]

    held = appended(texts, "__x", "held binary", sets, keep_text=False)
    dealt = held.join(deals, "block")

    def check(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates("node").sort_values("node")
        links, roots = verified(list(frame["node"]), frame["copies"].to_numpy(np.int64),
                                [np.frombuffer(b, np.uint64) for b in frame["held"]],
                                (frame["block"] == frame["i"]).to_numpy(), threshold)
        names = frame["node"].to_numpy()
        return pd.DataFrame({"node": names, "root": names[roots], "links": links})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest, out, n = None, [], 0
        for frame in frames:
            if rest is not None:
                frame = pd.concat([rest, frame], ignore_index=True)
            cut = np.flatnonzero((frame[["i", "j"]] != frame[["i", "j"]].shift()).any(axis=1))
            for a, b in zip(cut, cut[1:]):
                out.append(check(frame.iloc[a:b]))
                n += b - a
            rest = frame.iloc[cut[-1]:]
            if n > 5000:
                yield pd.concat(out, ignore_index=True)
                out, n = [], 0
        if rest is not None and len(rest):
            out.append(check(rest))
        if out:
            yield pd.concat(out, ignore_index=True)

    tasks = dealt.repartition("i", "j").sortWithinPartitions("i", "j")
    found = written(tasks.mapInPandas(run, "node string, root string, links long"), "links")
    for table in (roots, tries, groups, blocks):
        dropped(table)
    classes = components(found, "node", "root")
    counted = found.groupBy("node").agg(F.sum("links").alias("links"))
    facts = (nodes.select("node", "rep", "copies").join(counted, "node", "left").join(classes, "node", "left")
             .withColumn("label", F.coalesce("label", "node")))
    facts = written(facts, "node-facts")
    sums = facts.groupBy("label").agg(F.min("rep").alias("class_id"), F.sum("copies").alias("class_size"))
    facts = facts.join(sums, "label").select("node", F.col("label").alias("class_md5"), "class_id", "class_size", (
        F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return signed.select("k", "node").join(facts, "node").select(
        F.col("k").alias(key), "class_id", "n_links", "class_size", F.col("node").alias("text_md5"), "class_md5")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``docs`` without all but one row of each class: that with the least key, of those the least text hash.

    Rows that repeat the kept one in key and text go as well.
    """
    found = written(near_duplicates(docs, key, text, **how), "classes")
    least = F.min(F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), F.col("text_md5").alias("node")))
    winners = found.groupBy("class_md5").agg(least.alias("w")).select(F.col("w.key").alias("wk"), F.col("w.node").alias("wn"))
    rows = as_row(docs, k=F.col(key), m=F.md5(F.coalesce(F.col(text).cast("string"), F.lit(""))))
    kept = rows.join(winners, F.expr("k <=> wk and m = wn"), "left_semi")
    if found.groupBy(key, "text_md5").agg(F.count("*").alias("n")).where("n > 1").limit(1).count():
        kept = kept.dropDuplicates(["k", "m"])
    return from_row(kept, docs.columns)
