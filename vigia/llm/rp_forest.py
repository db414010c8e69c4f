"""Nearest neighbours by inner product: a forest of random-projection trees.

**Fit.**  On a bounded sample (``SAMPLE_ROWS`` rows of least hash of ``vec_id``) the
driver grows ``TREES`` complete trees.  A node projects on the line between two
centroids found from a random pair, and splits at the median of the sample.  The
same sample sets how many leaves a search visits: as many as give ``RECALL`` of the
true neighbours of ``TRIALS`` sample rows within the sample.  Among more rows the
nearest are nearer, so the recall in the table is not lower.

**Index.**  Every row goes to its leaf in each tree.  Leaves are grouped into slots
(subtrees) of about ``BLOCK_ROWS`` rows, salted by id where one leaf alone is larger.

**Search.**  A query walks all trees through one priority queue ordered by the
squared margins that a branch is off, and notes the leaves it reaches.  It is sent to
a slot once, with a bit per leaf.  A slot holds its rows as one matrix and takes the
queries as a stream of blocks; what can be among the nearest is scored again,
exactly, in the order of the components.  The best of all slots are merged by query.

**Hot vectors.**  Of rows with the same vector only the ``k + 1`` least ids can be
results; the rest is left out in each task before the shuffle, and queries with the
same vector are searched as one and shared out at the end.

**Scale.**  Model and sample are bounded (2,044 nodes and 32,768 rows by default).  The
work of a search is the number of leaves visited times their rows.  Where the
vectors are noise around few centres, as in the test tables, 0.95 of the neighbours
need a large share of the leaves; the fitted number says how many.

**Defined cases.**  Vectors that are null, zero, of another length than most of the
sample, or hold null or non-finite components take no part, nor do rows without
``vec_id``.  Rows that repeat a ``vec_id`` are one item: it scores by its best pair
of vectors.  An empty table gives no rows; fewer candidates than ``k`` give all.
Ties go to the smaller ``vec_id``.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TREES, LEAF_ROWS, MOST_DEPTH = 4, 64, 9
SAMPLE_ROWS, TRIALS, RECALL = 32_768, 256, 0.95
BLOCK_ROWS = 16_384
#: Queries that meet the rows of a slot at a time.
QUERY_ROWS = 512
EVERY, NEAREST = 20, 20


@dataclass(frozen=True)
class Forest:
    """``normals`` (tree, node, component) and ``offsets`` (tree, node) of complete trees; node i has the children 2i+1 and 2i+2."""

    normals: np.ndarray
    offsets: np.ndarray
    depth: int
    visits: int

    @property
    def nodes(self) -> int:
        return (1 << self.depth) - 1

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """(tree, row): the leaf of each row, 0 to 2 ** depth - 1."""
        out = np.zeros((len(self.normals), len(vectors)), dtype=np.int64)
        for normals, offsets, node in zip(self.normals, self.offsets, out, strict=True):
            for _ in range(self.depth):
                beyond = np.einsum("ij,ij->i", vectors, normals[node]) > offsets[node]
                node[:] = 2 * node + 1 + beyond
        return out - self.nodes

    def margins(self, vectors: np.ndarray) -> np.ndarray:
        """(row, tree, node): signed distance from every split."""
        return np.einsum("ij,tnj->itn", vectors, self.normals, optimize=True) - self.offsets

    def reached(self, margins: np.ndarray, most: int) -> list[tuple[int, int]]:
        """(tree, leaf) in the order in which the shared queue reaches them, for one query."""
        margins, inner = margins.tolist(), self.nodes
        queue = [(0.0, tree, 0) for tree in range(len(margins))]
        found: list[tuple[int, int]] = []
        while queue and len(found) < most:
            off, tree, node = heapq.heappop(queue)
            own = margins[tree]
            while node < inner:
                margin = own[node]
                near = 2 * node + 1 + (margin > 0)
                heapq.heappush(queue, (off + margin * margin, tree, 4 * node + 3 - near))
                node = near
            found.append((tree, node - inner))
        return found


def _direction(rows: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """The line between two centroids that a random pair of rows grows into, length 1; zero if all are equal."""
    a, b = rows[rng.choice(len(rows), 2, replace=False)]
    for _ in range(4):
        side = rows @ (a - b) > (a @ a - b @ b) / 2
        if side.all() or not side.any():
            break
        a, b = rows[side].mean(axis=0), rows[~side].mean(axis=0)
    length = np.linalg.norm(a - b)
    return (a - b) / length if length > 0 else np.zeros_like(a)


def _tree(rows: np.ndarray, depth: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    normals, offsets = np.zeros(((1 << depth) - 1, rows.shape[1])), np.zeros((1 << depth) - 1)
    held = {0: np.arange(len(rows))}
    for node in range(len(offsets)):
        own = held.pop(node)
        if len(own) > 1:
            some = own if len(own) <= 1000 else rng.choice(own, 1000, replace=False)
            normals[node] = _direction(rows[some], rng)
            along = rows[own] @ normals[node]
            offsets[node] = np.median(along)
            held[2 * node + 1], held[2 * node + 2] = own[along <= offsets[node]], own[along > offsets[node]]
        else:
            held[2 * node + 1], held[2 * node + 2] = own, own[:0]
    return normals, offsets


def _visits(forest: Forest, rows: np.ndarray, k: int, trials: int, recall: float) -> int:
    """Leaves to visit so that ``recall`` of the k nearest of the first ``trials`` rows are found among ``rows``."""
    queries = rows[:trials]
    scores = queries @ rows.T
    scores[np.arange(len(queries)), np.arange(len(queries))] = -np.inf
    k = min(k, len(rows) - 1)
    if k < 1:
        return 1
    true = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    leaves, margins = forest.leaves(rows), forest.margins(queries)
    first = np.full(true.shape, np.iinfo(np.int64).max)
    for i, near in enumerate(true):
        at = np.empty((len(leaves), 1 << forest.depth), dtype=np.int64)
        for order, (tree, leaf) in enumerate(forest.reached(margins[i], at.size)):
            at[tree, leaf] = order
        first[i] = at[np.arange(len(leaves))[:, None], leaves[:, near]].min(axis=0)
    return 1 + int(np.quantile(first, recall, method="higher"))


def fit(rows: np.ndarray, k: int = NEAREST, seed: int = 13) -> Forest:
    """A forest over sample ``rows`` (row, component)."""
    depth = 0
    while depth < MOST_DEPTH and len(rows) >> (depth + 1) >= LEAF_ROWS:
        depth += 1
    rng = np.random.default_rng(seed)
    grown = [_tree(rows, depth, rng) for _ in range(TREES if depth else 1)]
    forest = Forest(np.stack([n for n, _ in grown]), np.stack([o for _, o in grown]), depth, 1)
    return Forest(forest.normals, forest.offsets, depth, _visits(forest, rows, k, TRIALS, RECALL))


def valid_vectors(ids: pa.Array, vectors: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and float64 vectors of the rows that take part."""
    fits = pc.and_(pc.is_valid(ids), pc.fill_null(pc.equal(pc.list_value_length(vectors), dim), False))
    kept = vectors.filter(fits)
    flat = pc.cast(kept.flatten(), pa.float64()).to_numpy(zero_copy_only=False)
    matrix = np.asarray(flat, dtype=np.float64).reshape(-1, dim)
    good = np.isfinite(matrix).all(axis=1) & (matrix != 0).any(axis=1)
    return ids.filter(fits).to_numpy(zero_copy_only=False).astype(np.int64)[good], matrix[good]


def _equal_rows(matrix: np.ndarray) -> np.ndarray:
    """The number of the first of all equal rows, by row."""
    matrix = np.ascontiguousarray(matrix) + 0.0  # -0.0 is 0.0
    keys = matrix.view(np.dtype((np.void, matrix.dtype.itemsize * matrix.shape[1]))).ravel()
    _, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
    return first[inverse]


def least_ids(ids: np.ndarray, matrix: np.ndarray, most: int) -> np.ndarray:
    """Rows to keep: of equal vectors those with the ``most`` least different ids."""
    if not len(ids):
        return np.zeros(0, np.int64)
    group = _equal_rows(matrix)
    order = np.lexsort((ids, group))
    g, i = group[order], ids[order]
    fresh = np.ones(len(g), dtype=bool)
    fresh[1:] = (g[1:] != g[:-1]) | (i[1:] != i[:-1])
    order, g = order[fresh], g[fresh]
    starts = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
    rank = np.arange(len(g)) - np.repeat(starts, np.diff(np.r_[starts, len(g)]))
    return order[rank < most]


@dataclass(frozen=True)
class Layout:
    """Slots: the subtrees below the first ``levels`` splits of each tree, each in ``salts`` parts."""

    forest: Forest
    levels: int
    salts: int
    dtype: str

    @classmethod
    def of(cls, forest: Forest, rows: int, dtype: str) -> Layout:
        levels = 0
        while levels < forest.depth and rows >> levels > BLOCK_ROWS:
            levels += 1
        return cls(forest, levels, max(1, -(-(rows >> levels) // BLOCK_ROWS)), dtype)

    @property
    def span(self) -> int:
        """Leaves of a slot."""
        return 1 << (self.forest.depth - self.levels)

    def slot(self, tree, leaf):
        return ((tree << self.levels) + leaf // self.span) * self.salts


def keys_of(matrix: np.ndarray) -> list[bytes]:
    return [hashlib.md5(row.tobytes()).digest() for row in np.ascontiguousarray(matrix) + 0.0]


_SENT = "slot bigint, role int, leaf int, id bigint, q binary, bits binary, vector binary"


def _sent(slot, role: int, leaf, ids, q, bits, matrix: np.ndarray, dtype: str) -> pa.RecordBatch:
    n = len(matrix)
    raw = np.ascontiguousarray(matrix.astype(dtype)).tobytes()
    width = len(raw) // n if n else 0
    vectors = pa.array([raw[i * width : (i + 1) * width] for i in range(n)], pa.binary())
    columns = [
        pa.array(slot, pa.int64()),
        pa.array([role] * n, pa.int32()),
        pa.array(leaf, pa.int32()),
        pa.array(ids, pa.int64()),
        pa.array(q, pa.binary()),
        pa.array(bits, pa.binary()),
        vectors,
    ]
    return pa.record_batch(columns, ["slot", "role", "leaf", "id", "q", "bits", "vector"])


def _indexed(layout: Layout, dim: int, k: int):
    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, matrix = valid_vectors(batch.column(0), batch.column(1), dim)
            kept = least_ids(ids, matrix, k + 1)
            ids, matrix = ids[kept], matrix[kept]
            salt = ids % layout.salts
            for tree, leaf in enumerate(layout.forest.leaves(matrix)):
                none = [None] * len(ids)
                yield _sent(layout.slot(tree, leaf) + salt, 0, leaf % layout.span, ids, none, none, matrix, layout.dtype)

    return indexed


def _asked(layout: Layout, dim: int):
    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, span = layout.forest, layout.span
        for batch in batches:
            ids, matrix = valid_vectors(batch.column(0), batch.column(1), dim)
            matrix = matrix[least_ids(np.zeros(len(ids), np.int64), matrix, 1)]
            for start in range(0, len(matrix), QUERY_ROWS):
                part = matrix[start : start + QUERY_ROWS]
                slots, rows, bits = [], [], []
                for row, margins in enumerate(forest.margins(part)):
                    masks: dict[int, np.ndarray] = {}
                    for tree, leaf in forest.reached(margins, forest.visits):
                        slot = layout.slot(tree, leaf)
                        if slot not in masks:
                            masks[slot] = np.zeros(span, dtype=bool)
                        masks[slot][leaf % span] = True
                    for slot, mask in masks.items():
                        packed = np.packbits(mask).tobytes()
                        for salt in range(layout.salts):
                            slots.append(slot + salt)
                            rows.append(row)
                            bits.append(packed)
                q = keys_of(part)
                none = [None] * len(rows)
                yield _sent(slots, 1, none, none, [q[r] for r in rows], bits, part[rows], layout.dtype)

    return asked


def exact_scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products row by row, summed in the order of the components."""
    total = np.zeros(len(left))
    for j in range(left.shape[1]):
        total += left[:, j] * right[:, j]
    return total


class Block:
    """The rows of one slot as a matrix in order of leaf."""

    def __init__(self, ids: np.ndarray, leaf: np.ndarray, matrix: np.ndarray, span: int, k: int):
        kept = least_ids(ids, matrix, k + 1)
        kept = kept[np.argsort(leaf[kept], kind="stable")]
        self.ids, self.matrix, self.k = ids[kept], matrix[kept], k
        self.ends = np.searchsorted(leaf[kept], np.arange(span + 1))
        self.norm = float(np.sqrt((self.matrix**2).sum(axis=1).max(initial=0)))

    def nearest(self, queries: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, id, score) of the k + 1 nearest in the leaves that ``bits`` (query, leaf) names."""
        slack = 1e-12 * self.norm * np.sqrt((queries**2).sum(axis=1))
        level = np.full(len(queries), -np.inf)
        held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        fresh: list[tuple] = []
        for leaf in range(len(self.ends) - 1):
            a, b = self.ends[leaf], self.ends[leaf + 1]
            asking = np.flatnonzero(bits[:, leaf])
            if a == b or not len(asking):
                continue
            scores = queries[asking] @ self.matrix[a:b].T
            row, column = np.nonzero(scores >= level[asking][:, None])
            fresh.append((asking[row], a + column, scores[row, column]))
            if sum(len(f[0]) for f in fresh) > 64 * len(queries):
                held = self._best(held, fresh, level, slack)
                fresh = []
        query, place, _ = self._best(held, fresh, level, slack)
        score = exact_scores(queries[query], self.matrix[place])
        ids = self.ids[place]
        order = np.lexsort((ids, -score, query))
        query, ids, score = query[order], ids[order], score[order]
        return tuple(x[_rank(query) <= self.k] for x in (query, ids, score))

    def _best(self, held, fresh, level: np.ndarray, slack: np.ndarray):
        """What scores at the (k + 1)-th best of its query or, within rounding, above; ``level`` follows."""
        query, place, score = (np.concatenate([h, *(f[i] for f in fresh)]) for i, h in enumerate(held))
        order = np.lexsort((-score, query))
        query, place, score = query[order], place[order], score[order]
        last = _rank(query) == self.k
        level[query[last]] = score[last] - slack[query[last]]
        kept = score >= level[query]
        return [query[kept], place[kept], score[kept]]


def _rank(group: np.ndarray) -> np.ndarray:
    """How many of the same group come before, for sorted groups."""
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, np.int64)
    return np.arange(len(group)) - np.repeat(starts, np.diff(np.r_[starts, len(group)]))


def _searched(layout: Layout, dim: int, k: int):
    """Rows sorted by slot, then index rows before queries: one matrix at a time, queries in blocks."""

    def matrix_of(batch: pa.RecordBatch) -> np.ndarray:
        raw = b"".join(batch.column("vector").to_pylist())
        return np.frombuffer(raw, dtype=layout.dtype).astype(np.float64).reshape(-1, dim)

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts, block = None, [], None
        for batch in batches:
            slot, role = batch.column("slot").to_numpy(), batch.column("role").to_numpy()
            cuts = np.flatnonzero((slot[1:] != slot[:-1]) | (role[1:] != role[:-1])) + 1
            for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(slot)], strict=True):
                if slot[a] != current:
                    current, parts, block = slot[a], [], None
                own = batch.slice(a, b - a)
                if role[a] == 0:
                    parts.append((own.column("id").to_numpy(), own.column("leaf").to_numpy(), matrix_of(own)))
                    continue
                if block is None and parts:
                    block = Block(*(np.concatenate(x) for x in zip(*parts, strict=True)), layout.span, k)
                    parts = []
                for start in range(0, own.num_rows if block else 0, QUERY_ROWS):
                    some = own.slice(start, QUERY_ROWS)
                    packed = np.frombuffer(b"".join(some.column("bits").to_pylist()), np.uint8).reshape(some.num_rows, -1)
                    query, ids, score = block.nearest(matrix_of(some), np.unpackbits(packed, axis=1)[:, : layout.span])
                    yield pa.record_batch([some.column("q").take(pa.array(query)), pa.array(ids), pa.array(score)], ["q", "id", "score"])

    return searched


def _named(dim: int):
    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, matrix = valid_vectors(batch.column(0), batch.column(1), dim)
            yield pa.record_batch([pa.array(ids), pa.array(keys_of(matrix), pa.binary())], ["query_id", "q"])

    return named


def _sample(rows: DataFrame, n: int) -> tuple[np.ndarray, int]:
    """At most ``SAMPLE_ROWS`` valid vectors of least hash of their id, and their length: the most frequent one."""
    share = min(1.0, 1.2 * SAMPLE_ROWS / max(n, 1))
    hashed = rows.where("embedding IS NOT NULL AND size(embedding) > 0").withColumn("h", F.xxhash64("vec_id"))
    drawn = hashed.where(F.pmod("h", F.lit(1 << 20)) < int(share * (1 << 20))) if share < 1 else hashed
    table = drawn.orderBy("h", "vec_id").limit(SAMPLE_ROWS).toArrow().combine_chunks()
    if not table.num_rows:
        return np.zeros((0, 1)), 0
    ids, vectors = table.column("vec_id").chunk(0), table.column("embedding").chunk(0)
    lengths, counts = np.unique(pc.list_value_length(vectors).to_numpy(), return_counts=True)
    dim = int(lengths[np.argmax(counts)])
    return valid_vectors(ids, vectors, dim)[1], dim


def nearest(rows: DataFrame, queries: DataFrame, k: int = NEAREST) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest ``rows`` of each of ``queries``, its own id apart.

    Both have columns vec_id and embedding; ``queries`` may be a part of ``rows``.
    """
    spark = rows.sparkSession
    rows, queries = (x.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding").where("vec_id IS NOT NULL") for x in (rows, queries))
    n = rows.count()
    sample, dim = _sample(rows, n)
    if not len(sample):
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    dtype = "<f4" if rows.schema["embedding"].dataType.elementType.typeName() == "float" else "<f8"
    layout = Layout.of(fit(sample, k), n, dtype)
    indexed = rows.mapInArrow(_indexed(layout, dim, k), _SENT)
    asked = queries.mapInArrow(_asked(layout, dim), _SENT)
    sent = indexed.unionAll(asked).repartition("slot").sortWithinPartitions("slot", "role")
    found = sent.mapInArrow(_searched(layout, dim, k), "q binary, id bigint, score double")
    best = Window.partitionBy("q").orderBy(F.col("score").desc(), "id")
    # One shuffle: rows dealt by q serve the grouping by q and id as well.
    merged = found.repartition("q").groupBy("q", "id").agg(F.max("score").alias("score"))
    lists = merged.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).groupBy("q").agg(F.collect_list(F.struct("id", "score")).alias("near"))
    shared = queries.mapInArrow(_named(dim), "query_id bigint, q binary").join(lists, "q")
    pairs = shared.select("query_id", F.inline("near")).where("id <> query_id")
    scored = pairs.repartition("query_id").groupBy("query_id", "id").agg(F.max("score").alias("score"))
    by_query = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    ranked = scored.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op13_nearest_vectors(embeddings: DataFrame) -> DataFrame:
    """The 20 nearest of every row whose vec_id is divisible by 20, among all other rows."""
    return nearest(embeddings, embeddings.where(F.col("vec_id") % EVERY == 0))
