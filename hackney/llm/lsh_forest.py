"""N-gram Jaccard join by a MinHash LSH forest with exact verification.

Texts are compared as sets of five-word shingles (words: runs of non-blank
characters in lower case; a text of one to four words is one shingle).  Two
texts are linked if their sets' Jaccard similarity is 0.8 or more.

1. Texts with equal word sequences are one class; everything after works on
   one text a class, so copies are never expanded into pairs.
2. Each class gets a label in each of ``trees`` trees: ``LEVELS`` minhashes of
   eight bits, the first in the highest byte.  Labels in order are the leaves of
   a prefix trie; labels with equal first k bytes are below one node of level k.
3. A text starts with its whole labels and shortens its prefix a level at a time
   until a partner of the least similarity that its own set's size admits (of 7
   shingles 6/7, of many 0.8; `least_similarity`) is met in some tree with
   probability ``recall`` (`depths`).  Two texts meet in a tree if they agree on
   the longer of their two prefixes: their similarity is at least what either
   size admits, so the longer prefix has the target recall for this pair too.
4. The subtrees below the shortest prefix of any text are shuffled as units and
   sorted by label.  A large one is cut into blocks of at most about ``BLOCK``
   texts, and each pair of blocks is a tile.  In a tile the levels are walked
   from the longest prefix to the shortest; leaves that share no node with
   another leaf as far up as both go are dropped (`ascend`), and the rest is
   paired.  A pair counts in the first tree where it meets, so it is compared
   once.
5. Texts with such a pair are shipped to their tile, where the pairs'
   shingle sets are intersected exactly.  A tile returns, for each text, the
   number of links and one edge of a spanning forest, never the list of pairs.
6. Connected components over those edges (minimum labels with pointer jumping,
   each round written to the shared folder) are the near-duplicate groups.
7. Statistics are joined back by class, those of classes with very many rows (or
   of groups with very many classes) by broadcast of the counted few, so that no
   task gets the rows of one large group.

Edge cases: null and empty texts have no words and form one class without
links to others; rows with equal ids keep one row each; an id that is null is
never a group's id unless all of its group are; an empty table gives an empty
result; columns other than id and text are not read by `join`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hackney.llm.common import BROADCAST_KEYS, apart, drop_keys, named_apart, shuffle_partitions, stored, together

SHINGLE = 5
THRESHOLD = 0.8
TREES, RECALL = 28, 0.9999
LEVELS = 8                 # minhashes of eight bits in a label, which is one 64-bit number
SMALL = 64                 # sets up to this size admit few similarities; above, the threshold stands
BLOCK = 256
HOT = 1000                 # rows of one class, or classes of one group, that are joined apart
SEED = 20_011


# ---- how far a prefix is shortened

def depth_for(similarity: float = THRESHOLD, trees: int = TREES, recall: float = RECALL) -> int:
    """The longest prefix at which a pair of ``similarity`` meets in at least
    one tree with probability ``recall``."""
    for depth in range(LEVELS, 0, -1):
        if 1 - (1 - min(1.0, similarity) ** depth) ** trees >= recall:
            return depth
    raise ValueError("even prefixes of length one miss the target recall: use more trees")


def least_similarity(n: int, threshold: float = THRESHOLD) -> float:
    """The least similarity of ``threshold`` or more that a set of ``n`` can
    have with any other set."""
    found = 1.0
    for m in range(math.ceil(threshold * n - 1e-9), math.floor(n / threshold + 1e-9) + 1):
        shared = math.ceil(threshold * (n + m) / (1 + threshold) - 1e-9)
        if shared <= min(n, m):
            found = min(found, shared / (n + m - shared))
    return found


def depths(threshold: float = THRESHOLD, trees: int = TREES, recall: float = RECALL) -> np.ndarray:
    """The prefix length of a set of each size up to `SMALL`; at 0, of larger sets."""
    return np.asarray([depth_for(threshold, trees, recall),
                       *(depth_for(least_similarity(n, threshold), trees, recall) for n in range(1, SMALL + 1))])


def normalised(text: Column) -> Column:
    """Words in lower case with one blank between."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+", " "))


# ---- shingles and signatures (numpy, inside tasks)

def _odd_multipliers(n: int, bits: int) -> np.ndarray:
    kind = np.uint32 if bits == 32 else np.uint64
    return np.random.default_rng(SEED + bits).integers(0, 1 << bits, n, kind) | kind(1)


def _bounds(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each shingle in a normalised text (not empty)."""
    raw = np.frombuffer(data, np.uint8)
    gaps = np.flatnonzero(raw == 0x20)
    starts = np.concatenate([[0], gaps + 1])
    ends = np.concatenate([gaps, [len(raw)]])
    m = max(1, len(starts) - SHINGLE + 1)
    return starts[:m], ends[-m:]


def shingle_set(data: bytes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    starts, ends = _bounds(data)
    h = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((h(data[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)),
                                 np.uint64, len(starts)))


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Signer:
    """Labels of the forest's trees, and prefix lengths, for many texts at once."""

    BASE = 0x9E3779B97F4A7C15
    INVERSE = pow(BASE, -1, 1 << 64)

    def __init__(self, trees: int, depth_of: np.ndarray):
        self.trees, self.depth_of = trees, depth_of
        self.mult = _odd_multipliers(trees * LEVELS, 32)
        self.flip = np.random.default_rng(SEED).integers(0, 1 << 32, trees * LEVELS, np.uint32)
        self.power = self.inverse = np.zeros(0, np.uint64)

    def _rolling(self, data: bytes) -> np.ndarray:
        """A 32-bit hash of each shingle, from polynomial prefix hashes."""
        n = len(data)
        if len(self.power) <= n:
            self.power, self.inverse = _powers(2 * n + 2, self.BASE), _powers(2 * n + 2, self.INVERSE)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)) * self.power[:n], out=sums[1:])
        starts, ends = _bounds(data)
        h = (sums[ends] - sums[starts]) * self.inverse[starts]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        return (h >> np.uint64(32)).astype(np.uint32)

    def _depth(self, hashes: np.ndarray) -> int:
        n = len(hashes)
        return int(self.depth_of[len(np.unique(hashes)) if n <= SMALL else 0])

    def sign(self, datas: list[bytes]) -> tuple[np.ndarray, list[int]]:
        """(len(datas), trees) labels, and each text's prefix length; no text may
        be empty."""
        hashes = [self._rolling(d) for d in datas]
        lowest = np.empty((self.trees * LEVELS, len(datas)), np.uint32)
        at = 0
        while at < len(hashes):            # some texts at a time, to stay in the cache
            end, n = at, 0
            while end < len(hashes) and (n < 1 << 16 or end == at):
                n += len(hashes[end])
                end += 1
            block = np.concatenate(hashes[at:end])
            cuts = np.cumsum([0, *map(len, hashes[at:end - 1])])
            for k in range(len(self.mult)):
                mixed = (block ^ self.flip[k]) * self.mult[k]
                mixed ^= mixed >> np.uint32(15)
                lowest[k, at:end] = np.minimum.reduceat(mixed, cuts)
            at = end
        # A minhash is a small number; its low bits, mixed once more, are uniform.
        levels = ((lowest * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint64).reshape(self.trees, LEVELS, -1)
        label = np.zeros((self.trees, len(datas)), np.uint64)
        for k in range(LEVELS):
            label = (label << np.uint64(8)) | levels[:, k]
        return np.ascontiguousarray(label.T), [self._depth(h) for h in hashes]


def signed(docs: DataFrame, id_col: str, text_col: str, trees: int, depth_of: np.ndarray, row: Column) -> DataFrame:
    """``row, id, key, labels, depth`` of every row, stored.  ``key`` tells texts
    apart (MD5 of the words); ``labels`` is null for a text without words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(trees, depth_of)
        for batch in batches:
            datas = [t.encode() for t in batch.column(3).to_pylist()]
            some = [k for k, d in enumerate(datas) if d]
            labels: list = [None] * len(datas)
            depth: list = [None] * len(datas)
            if some:
                found, lengths = signer.sign([datas[k] for k in some])
                for k, p, n in zip(some, found.view(np.int64), lengths, strict=True):
                    labels[k], depth[k] = p, n
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(labels, pa.list_(pa.int64())), pa.array(depth, pa.int32())],
                ["row", "id", "key", "labels", "depth"])

    norm = normalised(F.col(text_col))
    rows = docs.select(row.alias("row"), F.col(id_col).cast("long").alias("id"),
                       F.unhex(F.md5(norm.cast("binary"))).alias("key"), norm.alias("norm"))
    return stored(rows.mapInArrow(run, "row long, id long, key binary, labels array<long>, depth int"), "signatures")


# ---- tiles

TILE = ["tree", "prefix", "block_a", "block_b"]


def _groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups with the groups' bounds, from batches sorted by
    the integer columns ``names``; only an unfinished group is carried over."""
    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if held is not None:
            rows = pa.concat_tables([held, rows]).combine_chunks()
        if not rows.num_rows:
            continue
        keys = [rows.column(n).to_numpy() for n in names]
        new = np.zeros(rows.num_rows, bool)
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
        cuts = np.flatnonzero(new)
        if len(cuts):
            last = int(cuts[-1])
            yield rows.slice(0, last), np.concatenate([[0], cuts])
            held = rows.slice(last)
        else:
            held = rows
    if held is not None and held.num_rows:
        yield held, np.asarray([0, held.num_rows])


def _labels(rows: pa.Table, trees: int) -> np.ndarray:
    column = rows.column("labels").combine_chunks()
    flat = column.flatten() if isinstance(column, pa.ListArray) else pa.concat_arrays(column.chunks).flatten()
    return flat.to_numpy().view(np.uint64).reshape(-1, trees)


def _width(depth: np.ndarray) -> np.ndarray:
    """Labels that agree on ``depth`` levels differ by less than this, bit by bit."""
    return np.uint64(1) << (np.uint64(8) * (np.uint64(LEVELS) - depth.astype(np.uint64)))


def ascend(leaves: np.ndarray, depth: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Which of the leaves (labels of one tree, in order inside each group that
    starts at a cut) share a node with another, at a level that neither has left.
    From the longest prefix up, a level at a time; a leaf goes up to its depth."""
    meets = np.zeros(len(leaves), bool)
    first = np.zeros(len(leaves), bool)
    first[cuts[cuts < len(leaves)]] = True
    apart_by = np.zeros(len(leaves), np.uint64)
    apart_by[1:] = leaves[1:] ^ leaves[:-1]
    for level in range(LEVELS, int(depth.min()) - 1, -1):
        node = np.cumsum(first | (apart_by >= _width(np.asarray(level)))) - 1
        here = depth <= level
        meets |= here & (np.bincount(node[here], minlength=node[-1] + 1)[node] > 1)
    return meets


def _own_pairs(labels: np.ndarray, depth: np.ndarray, blocks: np.ndarray, tree: int, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of a tile (between its two blocks, or inside its one block)
    that meet in ``tree`` and in none before."""
    width = _width(np.maximum(depth[:, None], depth[None, :]))
    own = (labels[:, tree][:, None] ^ labels[:, tree][None, :]) < width
    own &= np.tri(len(labels), k=-1, dtype=bool).T if a == b else (blocks == a)[:, None] & (blocks == b)[None, :]
    for t in range(tree):
        own &= (labels[:, t][:, None] ^ labels[:, t][None, :]) >= width
    return np.nonzero(own)


def _tiles(members: DataFrame) -> DataFrame:
    """Each member once a tile: bucket size -> number of blocks -> tiles."""
    n = F.ceil(F.col("bucket_size") / BLOCK)
    block = F.when(n == 1, F.lit(0)).otherwise(F.pmod(F.xxhash64("key"), n)).cast("long")
    other = F.explode(F.sequence(F.lit(0).cast("long"), (n - 1).cast("long")))
    return (members.withColumn("block", block).withColumn("other", other)
            .withColumn("block_a", F.least("block", "other")).withColumn("block_b", F.greatest("block", "other"))
            .drop("other", "bucket_size"))


def _in_tiles(members: DataFrame) -> DataFrame:
    n = shuffle_partitions(members.sparkSession)
    return members.repartition(n, *TILE).sortWithinPartitions(*TILE, "leaf", "key")


def _with_own_pairs(members: DataFrame, trees: int) -> DataFrame:
    """The tile members that have a pair to compare in their tile."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, cuts in _groups(batches, TILE):
            starts = cuts[cuts < rows.num_rows]
            leaf = rows.column("leaf").to_numpy().view(np.uint64)
            keep = ascend(leaf, rows.column("depth").to_numpy(), starts)
            group = (np.cumsum(np.bincount(starts, minlength=rows.num_rows)) - 1)[keep]
            rows = rows.filter(pa.array(keep))
            if not rows.num_rows:
                continue
            labels = _labels(rows, trees)
            tree, block, a, b, depth = (rows.column(n).to_numpy() for n in ("tree", "block", "block_a", "block_b", "depth"))
            keep = np.zeros(rows.num_rows, bool)
            starts = np.flatnonzero(np.diff(group, prepend=-1))
            sizes = np.diff(starts, append=rows.num_rows)
            two = starts[sizes == 2]       # most groups are pairs: all at once
            if len(two):
                width = _width(np.maximum(depth[two], depth[two + 1]))
                met = (labels[two] ^ labels[two + 1]) < width[:, None]
                before = np.arange(trees) < tree[two][:, None]
                own = met[np.arange(len(two)), tree[two]] & ~(met & before).any(axis=1)
                own &= (a[two] == b[two]) | (block[two] != block[two + 1])
                keep[two[own]] = keep[two[own] + 1] = True
            for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
                i, j = _own_pairs(labels[s:s + n], depth[s:s + n], block[s:s + n], int(tree[s]), int(a[s]), int(b[s]))
                keep[s + i] = keep[s + j] = True
            if keep.any():
                yield from rows.filter(pa.array(keep)).combine_chunks().to_batches()

    return _in_tiles(members).mapInArrow(run, members.select(*members.columns).schema)


class _Forest:
    """Union-find over the members of a tile."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)


def _verify(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the pairs (i, j) have a Jaccard similarity of ``threshold`` or
    more; sets are compared as numbers of a vocabulary of the tile."""
    sizes = np.asarray([len(s) for s in sets])
    vocabulary, codes = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    mark = np.zeros(len(vocabulary), np.int64)
    out = np.zeros(len(i), bool)
    order = np.argsort(i, kind="stable")
    for a in np.unique(i).tolist():
        at = order[np.searchsorted(i[order], a):np.searchsorted(i[order], a, side="right")]
        others = j[at]
        near = np.minimum(sizes[others], sizes[a]) >= threshold * np.maximum(sizes[others], sizes[a])
        at, others = at[near], others[near]
        if not len(at):
            continue
        own = codes[ends[a] - sizes[a]:ends[a]]
        mark[own] = 1
        shared = np.asarray([mark[codes[ends[o] - sizes[o]:ends[o]]].sum() for o in others.tolist()])
        mark[own] = 0
        out[at] = shared >= threshold * (sizes[a] + sizes[others] - shared) - 1e-9
    return out


def _links(members: DataFrame, trees: int, threshold: float) -> DataFrame:
    """``key, root, n_texts, n_docs`` a tile and text with a link: ``root`` is
    the smallest text linked to it inside the tile, directly or not."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, cuts in _groups(batches, TILE):
            labels = _labels(rows, trees)
            tree, block, a, b, size, depth = (
                rows.column(n).to_numpy() for n in ("tree", "block", "block_a", "block_b", "size", "depth"))
            keys, norm = rows.column("key").to_pylist(), rows.column("norm")
            out: list[list] = [[], [], [], []]
            ends = [*cuts[1:].tolist(), rows.num_rows] if cuts[-1] != rows.num_rows else cuts[1:].tolist()
            for s, e in zip(cuts.tolist(), ends, strict=False):
                i, j = _own_pairs(labels[s:e], depth[s:e], block[s:e], int(tree[s]), int(a[s]), int(b[s]))
                if not len(i):
                    continue
                sets = [shingle_set(t.encode()) for t in norm.slice(s, e - s).to_pylist()]
                linked = _verify(sets, i, j, threshold)
                i, j = i[linked], j[linked]
                texts_, docs_ = np.zeros(e - s, np.int64), np.zeros(e - s, np.int64)
                own = size[s:e]
                for x, y in ((i, j), (j, i)):
                    np.add.at(texts_, x, 1)
                    np.add.at(docs_, x, own[y])
                forest = _Forest(e - s)
                for x, y in zip(i.tolist(), j.tolist(), strict=True):
                    forest.join(x, y)
                for k in np.flatnonzero(texts_).tolist():
                    out[0].append(keys[s + k])
                    out[1].append(keys[s + forest.root(k)])
                    out[2].append(int(texts_[k]))
                    out[3].append(int(docs_[k]))
            if out[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(out, (pa.binary(), pa.binary(), pa.int64(), pa.int64()), strict=True)],
                    ["key", "root", "n_texts", "n_docs"])

    return _in_tiles(members).mapInArrow(run, "key binary, root binary, n_texts long, n_docs long")


# ---- components

def components(edges: DataFrame, a: str = "key", b: str = "root") -> DataFrame:
    """``node, label``: the smallest node of each node's connected component.
    Every round takes the least label among a node and its neighbours and then
    jumps to the label's own label; rounds go on until nothing changes."""
    one_way = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x <> y")
    both = stored(one_way.unionByName(one_way.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "edges")
    labels = stored(both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("label")), "labels")
    while True:
        near = (both.join(labels.withColumnRenamed("x", "y"), "y").groupBy("x").agg(F.min("label").alias("near")))
        stepped = labels.join(near, "x").select("x", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("x").alias("label"), F.col("label").alias("further"))
        moved = stored(stepped.join(jump, "label").select("x", "old", F.least("label", "further").alias("label")), "labels")
        labels = moved.select("x", "label")
        if not moved.where("old <> label").limit(1).count():
            return labels.withColumnRenamed("x", "node")


# ---- the join

def join_hot(many: DataFrame, one: DataFrame, key: str, weight: str) -> DataFrame:
    """``many`` joined on ``key`` to the stored ``one``, which has a row a key and
    in ``weight`` the number of its rows in ``many``.  Keys with more than `HOT`
    rows are joined apart, by broadcast if there are few of them, so that their
    rows stay where they are; if there are many, none is a large part."""
    hot = one.where(F.col(weight) > HOT)
    if not 0 < hot.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS:
        return many.join(one, key)
    cold = many.join(F.broadcast(hot.select(key)), key, "left_anti").join(one.where(F.col(weight) <= HOT), key)
    return cold.unionByName(many.join(F.broadcast(hot), key))


def _joined(docs: DataFrame, id_col: str, text_col: str, threshold: float, trees: int,
            recall: float, row: Column) -> tuple[DataFrame, DataFrame]:
    """``row, id, key`` of each row; and ``key, size, n_texts, n_links, group,
    class_id, kept, group_size`` of each class, stored: ``class_id`` is the least
    id of the class's group (none before null), ``kept`` that row."""
    depth_of = depths(threshold, trees, recall)
    rows = signed(docs, id_col, text_col, trees, depth_of, row)
    least = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("row")))
    classes = stored(rows.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.first("labels").alias("labels"),
                                             F.first("depth").alias("depth"), least.alias("least")), "classes")
    leaves = classes.select("key", F.posexplode("labels").alias("tree", "leaf")).select(
        "key", "tree", F.shiftrightunsigned("leaf", 8 * (LEVELS - int(depth_of.min()))).alias("prefix"))
    shared = leaves.groupBy("tree", "prefix").agg(F.count(F.lit(1)).alias("bucket_size")).where("bucket_size > 1")
    met = (leaves.join(shared, ["tree", "prefix"])
           .groupBy("key").agg(F.collect_list(F.struct("tree", "prefix", "bucket_size")).alias("met")))   # at most one a tree
    members = classes.join(met, "key").select("key", "size", "labels", "depth", F.explode("met").alias("m"))
    members = members.select("key", "size", "labels", "depth", F.col("m.tree").cast("long").alias("tree"), "m.prefix",
                             F.get("labels", "m.tree").alias("leaf"), "m.bucket_size")
    asked = stored(_with_own_pairs(_tiles(members), trees), "tile-members")
    norm = normalised(F.col(text_col))
    texts = (docs.select(F.unhex(F.md5(norm.cast("binary"))).alias("key"), norm.alias("norm"))
             .join(asked.select("key").distinct(), "key", "left_semi")
             .groupBy("key").agg(F.first("norm").alias("norm")))
    links = stored(_links(asked.join(texts, "key"), trees, threshold), "links")
    labels = components(links)
    counts = links.groupBy("key").agg(F.sum("n_texts").alias("n_texts"), F.sum("n_docs").alias("n_docs"))
    known = stored(classes.select("key", "size", "least").join(counts, "key", "left")
                   .join(labels.select(F.col("node").alias("key"), "label"), "key", "left")
                   .select("key", "size", "least", F.coalesce("n_texts", F.lit(0)).alias("n_texts"),
                           (F.coalesce("n_docs", F.lit(0)) + F.col("size") - 1).alias("n_links"),
                           F.coalesce("label", "key").alias("group")), "known")
    groups = stored(known.groupBy("group").agg(F.min("least").alias("first"), F.sum("size").alias("group_size"),
                                               F.count(F.lit(1)).alias("n_classes")), "groups")
    grouped = join_hot(known.drop("least"), groups, "group", "n_classes").select(
        "key", "size", "n_texts", "n_links", F.col("first.id").alias("class_id"), F.col("first.row").alias("kept"), "group_size")
    return rows.select("row", "id", "key"), stored(grouped, "grouped")


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
         trees: int = TREES, recall: float = RECALL) -> DataFrame:
    """One row a document: ``id, class_id`` (the smallest id of its connected
    group of copies and near copies), ``n_links`` (other documents it is linked
    to, copies included), ``n_texts`` (different texts it is linked to),
    ``n_copies`` (documents with the same words, itself included) and
    ``group_size``."""
    rows, grouped = _joined(docs, id_col, text_col, threshold, trees, recall, F.monotonically_increasing_id())
    return (join_hot(rows, grouped, "key", "size")
            .select(F.col("id").alias(id_col), "class_id", "n_links", "n_texts", F.col("size").alias("n_copies"), "group_size"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest id (of
    rows with that id, the first in the table).  Rows are told by a number that
    is stored with them: one computed anew in each scan follows the scan's
    splits, which change with the live cores."""
    given, id_col, text_col = docs, named_apart(docs, id_col), named_apart(docs, text_col)
    docs = stored(apart(docs).withColumn("row", F.monotonically_increasing_id()), "numbered")
    rows, grouped = _joined(docs, id_col, text_col, THRESHOLD, TREES, RECALL, F.col("row"))
    others = join_hot(rows, grouped, "key", "size").where("row <> kept").select("row")
    return together(drop_keys(docs, F.col("row"), others), given)
