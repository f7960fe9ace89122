"""N-gram Jaccard join by MinHash bands, verified exactly.

Every document is its set of hashed word shingles; documents with one set are
one class and only classes are compared.  This is an LSH forest reduced to fixed
bands: of each of ``TREES`` tries only one level is kept, a hash of as many
MinHash values as ``prefix_length`` gives, and two classes are candidates when
they share such a node.  That length is the longest, up to ``LONGEST``, at which
a pair just at the threshold shares a node with the target probability, so any
pair above it does so with more.  It depends on the constants only (4 here):
prefixes are not shortened on the data, as the similarity sought is fixed.

Classes that nodes hold together, directly or over others, form a cluster, so
all candidates of a class are in its cluster and a pair is met once.  A cluster
of ``g`` members is verified in about ``(g / BLOCK)**2 / 2`` tasks, none larger
than two blocks; a task compares the candidates among its pairs and gives each
member's number of links and a spanning forest, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Grams, Words, mix, pin, unused, word_blocks
from .components import contract

SHINGLE = 5
THRESHOLD = 0.8
TREES = 16
LONGEST = 8
RECALL = 0.999
BLOCK = 1024
#: Text taken at once.
TEXT_BYTES = 1 << 20
#: Columns of the membership matrix of a task that are multiplied at once.
COLUMNS = 4096
#: Where two similarities differ only by rounding.
TINY = 1e-9


def prefix_length(threshold: float, trees: int, longest: int, recall: float) -> int:
    """The longest prefix at which a pair at the threshold shares a trie node with the target probability."""
    for depth in range(longest, 1, -1):
        if 1 - (1 - threshold**depth) ** trees >= recall:
            return depth
    return 1


def shingle_sets(words: Words, size: int) -> list[np.ndarray]:
    """Each row's sorted distinct shingles; a row of fewer words is one shingle of all of them."""
    grams = Grams(words.hash)
    values, first, counts = grams.all(size), words.first, np.diff(words.first)
    out = []
    for low, n in zip(first[:-1].tolist(), counts.tolist(), strict=True):
        if n >= size:
            out.append(np.unique(values[low : low + n - size + 1]))
        else:
            out.append(grams.at(np.array([low]), n) if n else np.zeros(0, np.uint64))
    return out


def set_keys(sets: list[np.ndarray]) -> list[bytes]:
    """128 bits that depend on the set only."""
    return [np.array([mix(s).sum(dtype=np.uint64), mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) + np.uint64(len(s))]).tobytes() for s in sets]


def paths(sets: list[np.ndarray], trees: int, depth: int, seed: int = 5) -> np.ndarray:
    """Each set's node in each trie at the given depth: a hash of that many MinHash values."""
    rng = np.random.default_rng(seed)
    flip = rng.integers(0, 1 << 63, (trees, depth), np.int64).astype(np.uint64)
    factor = rng.integers(0, 1 << 63, (trees, depth), np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.zeros((len(sets), trees), np.uint64)
    full = [i for i, s in enumerate(sets) if len(s)]
    if not full:
        return out
    flat = np.concatenate([sets[i] for i in full])
    first = np.concatenate(([0], np.cumsum([len(sets[i]) for i in full])[:-1]))
    for tree in range(trees):
        node = np.full(len(full), np.uint64(tree))
        for level in range(depth):
            least = np.minimum.reduceat((flat ^ flip[tree, level]) * factor[tree, level], first)
            node = mix(node * np.uint64(0x9E3779B97F4A7C15) + least)
        out[full, tree] = node
    return out


def signatures(docs: DataFrame, id_col: str, text_col: str, size: int, trees: int, depth: int) -> DataFrame:
    """(id, set_key, n, nodes) of every row."""
    kind = dict(docs.dtypes)[id_col]

    def sign(batches):
        for batch in batches:
            for low, high, words in word_blocks(batch.column(1), TEXT_BYTES):
                sets = shingle_sets(words, size)
                nodes = paths(sets, trees, depth).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[low:high], pa.array(set_keys(sets), pa.binary()), pa.array([len(s) for s in sets], pa.int64()), pa.array(list(nodes), pa.list_(pa.int64()))],
                    ["id", "set_key", "n", "nodes"],
                )

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(sign, f"id {kind}, set_key binary, n long, nodes array<long>")


def full_sets(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(set_key, shingles) of every row."""

    def give(batches):
        for batch in batches:
            for _, _, words in word_blocks(batch.column(0), TEXT_BYTES):
                sets = shingle_sets(words, size)
                yield pa.RecordBatch.from_arrays([pa.array(set_keys(sets), pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], ["set_key", "shingles"])

    return docs.select(F.col(text_col)).mapInArrow(give, "set_key binary, shingles binary")


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all left with all right sets."""
    flat = np.concatenate([*left, *right])
    values, inverse, counts = np.unique(flat, return_inverse=True, return_counts=True)
    # What only one set holds is in no intersection.
    place = np.cumsum(counts > 1) - 1
    columns = np.where(counts[inverse] > 1, place[inverse], -1)
    row = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in (*left, *right)])
    shared = columns >= 0
    row, columns = row[shared], columns[shared]
    out = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(columns, kind="stable")
    row, columns = row[order], columns[order]
    cuts = np.searchsorted(columns, np.arange(0, int(counts.size and place[-1]) + 1 + COLUMNS, COLUMNS))
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        if a < b:
            matrix = np.zeros((len(left) + len(right), COLUMNS), np.float32)
            matrix[row[a:b], columns[a:b] - k * COLUMNS] = 1
            out += matrix[: len(left)] @ matrix[len(left) :].T
    return out


def verify(half: np.ndarray, sizes: np.ndarray, nodes: np.ndarray, sets: list[np.ndarray], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of each member (weighed by ``sizes``) and the first member of its linked group, over one task's pairs.

    ``half``: 0 for the members of the left block, 1 for the right one; all 0
    when the task is a block with itself.
    """
    m = len(sets)
    left, right = np.flatnonzero(half == 0), np.flatnonzero(half == 1)
    alone = not len(right)
    if alone:
        right = left
    pair = np.zeros((len(left), len(right)), bool)
    for tree in range(nodes.shape[1]):
        pair |= nodes[left, tree][:, None] == nodes[right, tree][None, :]
    if alone:
        pair &= left[:, None] < right[None, :]
    n = np.array([len(s) for s in sets], np.float64)
    need = threshold / (1 + threshold) * (n[left][:, None] + n[right][None, :]) - TINY
    pair &= np.minimum(n[left][:, None], n[right][None, :]) >= need
    links, root = np.zeros(m, np.int64), np.arange(m)
    if not pair.any():
        return links, root
    use_l, use_r = np.flatnonzero(pair.any(1)), np.flatnonzero(pair.any(0))
    both = overlaps([sets[i] for i in left[use_l]], [sets[i] for i in right[use_r]])
    linked = pair[np.ix_(use_l, use_r)] & (both >= need[np.ix_(use_l, use_r)])
    a, b = left[use_l], right[use_r]
    np.add.at(links, a, linked @ sizes[b])
    np.add.at(links, b, linked.T @ sizes[a])
    # Smallest label over the links until nothing changes.
    while True:
        least = np.where(linked, root[b][None, :], m).min(1)
        new = root.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, np.where(linked, new[a][:, None], m).min(0))
        new = new[new]
        if (new == root).all():
            return links, root
        root = new


def _tasks(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Verify each task of a partition sorted by task."""

    def done(rows: pa.Table) -> pa.RecordBatch | None:
        rows = rows.to_pydict()
        place: dict = {}
        for i, key in enumerate(rows["set_key"]):
            place.setdefault(key, i)
        at = list(place.values())
        sets = [np.frombuffer(rows["shingles"][i], np.uint64) for i in at]
        keys = [rows["set_key"][i] for i in at]
        own = np.array([rows["block"][i] for i in at])
        half = (own != rows["low"][0]).astype(np.int64)
        links, root = verify(half, np.array([rows["size"][i] for i in at], np.int64), np.array([rows["nodes"][i] for i in at], np.int64), sets, threshold)
        hit = np.flatnonzero(links)
        if not len(hit):
            return None
        return pa.RecordBatch.from_arrays([pa.array([keys[i] for i in hit], pa.binary()), pa.array(links[hit]), pa.array([keys[root[i]] for i in hit], pa.binary())], ["set_key", "links", "root"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        task = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(task[1:] != task[:-1]) + 1).tolist(), len(task)]
        for a, b in zip(cuts, cuts[1:]):
            if held and held[-1].column(0)[0].as_py() != task[a]:
                if (out := done(pa.Table.from_batches(held))) is not None:
                    yield out
                held = []
            held.append(batch.slice(a, b - a))
    if held and (out := done(pa.Table.from_batches(held))) is not None:
        yield out


def components(edges: DataFrame) -> DataFrame:
    """(node, label) from (a, b) edges: nodes have one label if and only if edges connect them."""
    return contract(edges).withColumnRenamed("root", "label")


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, threshold: float = THRESHOLD, trees: int = TREES, longest: int = LONGEST, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """For every row: ``id_col``, ``class_id``, ``n_links``, ``group_size`` (rows with the same shingle set).

    Two documents are linked when the Jaccard similarity of their sets of
    ``size``-word shingles is ``threshold`` or more; ``n_links`` counts the other
    rows linked with a row, copies among them.  ``class_id`` is the smallest id
    of the rows that links lead to, directly or over others.  Words are those of
    ``common.Words``; a text of fewer words is one shingle.  A row without words
    (a null or empty text) has no link and its own id as class.  Rows
    without an id are linked as others are, but a null id is no class id while
    there is another.  An empty table gives no row; other columns
    are ignored.
    """
    depth = prefix_length(threshold, trees, longest, recall)
    signed = pin(signatures(docs, id_col, text_col, size, trees, depth))
    classes = pin(signed.where("n > 0").groupBy("set_key").agg(F.min("id").alias("rep"), F.count("*").alias("size"), F.first("nodes").alias("nodes")))
    exploded = classes.select("set_key", F.posexplode("nodes").alias("tree", "node"))
    shared = pin(exploded.groupBy("tree", "node").agg(F.min("set_key").alias("least"), F.count("*").alias("g")).where("g > 1").drop("g"))
    clusters = components(exploded.join(shared, ["tree", "node"]).select(F.col("set_key").alias("a"), F.col("least").alias("b")))
    blocks = pin(clusters.groupBy("label").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")))
    members = pin(clusters.join(blocks, "label").withColumnRenamed("node", "set_key").join(classes, "set_key").withColumn("block", F.pmod(F.xxhash64("set_key"), "blocks").cast("int")))
    # The side to keep grows with the input: never a broadcast, whatever its size now.
    wanted = members.select("rep").distinct().hint("merge")
    texts = docs.select(F.col(id_col).alias("rep"), F.col(text_col).alias("text")).join(wanted, "rep", "left_semi")
    named = full_sets(texts, "rep", "text", size).withColumn("nameless", F.lit(False))
    # Where no row of a class has an id, any of its rows gives the set.
    others = full_sets(docs.where(F.col(id_col).isNull()), id_col, text_col, size).groupBy("set_key").agg(F.first("shingles").alias("shingles"))
    sets = named.unionByName(others.withColumn("nameless", F.lit(True)))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    tasks = members.withColumn("nameless", F.col("rep").isNull()).join(sets, ["set_key", "nameless"]).select("set_key", "label", "block", "size", "nodes", "shingles", other)
    low, high = F.least("block", "other"), F.greatest("block", "other")
    sized = tasks.select(F.xxhash64("label", low, high).alias("task"), low.alias("low"), "block", "set_key", "size", "nodes", "shingles").repartition("task").sortWithinPartitions("task")
    found = pin(sized.mapInArrow(lambda batches: _tasks(batches, threshold), "set_key binary, links long, root binary"))
    groups = components(found.select(F.col("set_key").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("set_key").agg(F.sum("links").alias("links"))
    labelled = classes.select("set_key", "rep", "size").join(links, "set_key", "left").join(groups.withColumnRenamed("node", "set_key"), "set_key", "left")
    labelled = labelled.withColumn("label", F.coalesce("label", "set_key"))
    least = labelled.groupBy("label").agg(F.min("rep").alias("class_id"))
    settled = pin(labelled.join(least, "label").select("set_key", "class_id", "size", F.coalesce("links", F.lit(0)).alias("links")))
    return signed.join(settled, "set_key", "left").select(
        F.col("id").alias(id_col), F.when(F.col("size").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce(F.col("links") + F.col("size") - 1, F.lit(0)).cast("long").alias("n_links"), F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose id is that of their class, with all their columns: one document of each group.

    Rows that share an id are one document and stay or go together; rows without an id stay.
    """
    found = near_copies(docs, id_col, text_col, **options)
    gone = unused(docs, "gone")
    # A row goes when its id is not a class id; the ids that go are joined, as there are fewer of them.
    less = found.where(F.col(id_col) != F.col("class_id")).select(F.col(id_col).alias(gone)).distinct()
    return docs.join(less, F.col(id_col) == F.col(gone), "left_anti")
