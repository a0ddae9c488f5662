"""Centroid clustering over Hilbert-ordered blocks with zone maps.

Vectors are laid along a Hilbert curve (range partitions of the curve index, sorted
inside), cut into blocks of neighbours and written once with each block's box of
componentwise minima and maxima. A round bounds the distances of every centroid to
the vectors of a block by the box alone: a centroid whose nearest point of the box
is farther than the farthest point for some other centroid, or that is farther than
the centroid next to the box's middle at every point of the box, can't be the nearest
of any of its vectors. The centroids that are left are compared exactly, as one
matrix product of integers in doubles.

Only ``k`` centroids, and ``k`` sums a task, travel between the rounds.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import saved

#: Vectors of a block; bits a component on the curve.
BLOCK, BITS = 128, 2
#: Integer components count as +-LIMIT beyond it: with at most 256 components, sums of products stay below 2 ** 53.
LIMIT = 1 << 22
SCALE = 256.0


def integer_rows(column: pa.ListArray, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and integer vectors of the rows with exactly ``dims`` components, all finite."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    at = np.flatnonzero(np.asarray(pc.equal(pc.fill_null(pc.list_value_length(column), -1), dims)))
    m = np.asarray(column.take(pa.array(at)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)).reshape(-1, dims)
    good = np.isfinite(m).all(1)
    with np.errstate(over="ignore"):
        return at[good], np.clip(np.floor(m[good] * SCALE), -LIMIT, LIMIT).astype(np.int32)


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Index on the Hilbert curve of integer points (rows, dims) below 2 ** bits, as big-endian bytes (rows, bytes).

    The transform of the axes to the transposed index by exchanges and inversions of
    low bits, then the Gray code; all rows at once.
    """
    x = cells.astype(np.uint32).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = np.uint32(q - 1)
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low).astype(np.uint32)
            x[0] ^= np.where(high, low, swap).astype(np.uint32)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[n - 1] & q) != 0, np.uint32(q - 1), np.uint32(0))
        q >>= 1
    x ^= t
    planes = np.concatenate([((x >> np.uint32(bits - 1 - j)) & 1).T for j in range(bits)], axis=1).astype(np.uint8)
    return np.packbits(planes, axis=1)


def box_bounds(lo: np.ndarray, hi: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest squared distance of each centroid to the points of each box: (boxes, centroids) twice."""
    c, lo, hi = centroids[None], lo[:, None], hi[:, None]
    near = np.maximum(np.maximum(lo - c, c - hi), 0.0)
    far = np.maximum(hi - c, c - lo)  # the farther of the two sides
    return (near * near).sum(2), (far * far).sum(2)


def box_candidates(lo: np.ndarray, hi: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """(boxes, centroids): whether a centroid can be the nearest one, or tie, somewhere in the box.

    d(p, c) - d(p, m) is linear in p, so its least value over the box is the sum of
    the least values of its components.
    """
    near, far = box_bounds(lo, hi, centroids)
    allowed = near <= far.min(1)[:, None]
    pivot = centroids[box_bounds((lo + hi) / 2, (lo + hi) / 2, centroids)[0].argmin(1)]
    diff = centroids[None] - pivot[:, None]
    most = np.maximum(lo[:, None] * diff, hi[:, None] * diff).sum(2)
    least = (centroids * centroids).sum(1)[None] - (pivot * pivot).sum(1)[:, None] - 2.0 * most
    return allowed & (least <= 0)


def nearest(block: np.ndarray, centroids: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of each vector's nearest centroid among ``some`` (ascending): exact, ties to the smaller."""
    c = centroids[some]
    d = (block * block).sum(1)[:, None] - 2.0 * (block @ c.T) + (c * c).sum(1)[None]
    best = d.argmin(1)
    return some[best], d[np.arange(len(d)), best].astype(np.int64)


def curve_blocks(vectors: DataFrame, dims: int = 64, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(ids, n, wide, vectors, lo, hi): the table of blocks in curve order, written once.

    Each component is quantised by its mean and deviation over all kept vectors, so
    the curve follows the data at any scale. Copies of one vector share a place on
    the curve; the id splits them over range partitions.
    """
    v = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).alias("e"))

    def moments(batches):
        n, s, ss = 0, np.zeros(dims), np.zeros(dims)
        for b in batches:
            m = integer_rows(b.column(0), dims)[1].astype(np.float64)
            n, s, ss = n + len(m), s + m.sum(0), ss + (m * m).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array([n] * dims, pa.int64()), pa.array(s), pa.array(ss)], ["d", "n", "s", "ss"])

    stats = v.select("e").mapInArrow(moments, "d int, n long, s double, ss double").groupBy("d").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss")).collect()
    mean, dev = np.zeros(dims), np.ones(dims)
    for r in stats:  # a row a component
        if r["n"]:
            mean[r["d"]] = r["s"] / r["n"]
            dev[r["d"]] = max(r["ss"] / r["n"] - mean[r["d"]] ** 2, 1e-9) ** 0.5

    def keyed(batches):
        for b in batches:
            at, m = integer_rows(b.column(1), dims)
            if not len(at):
                continue
            cells = np.clip(np.floor((m - mean) / dev * 1.5 + 2), 0, 3).astype(np.uint32)
            keys = hilbert_keys(cells)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), pa.array([k.tobytes() for k in keys], pa.binary()), pa.array([x.tobytes() for x in m], pa.binary())], ["id", "key", "v"])

    along = v.mapInArrow(keyed, "id long, key binary, v binary").repartitionByRange(F.col("key"), F.col("id"), F.xxhash64("v")).sortWithinPartitions("key", "id", "v")
    schema = "ids array<long>, n int, wide boolean, vectors binary, lo binary, hi binary"
    names = ["ids", "n", "wide", "vectors", "lo", "hi"]

    def cut(batches):
        ids: list = []
        parts: list[bytes] = []

        def rows(own_ids, own):
            m = np.frombuffer(b"".join(own), np.int32).reshape(-1, dims)
            wide = bool(np.abs(m).max() > 32767)
            return own_ids, len(own), wide, (m if wide else m.astype(np.int16)).tobytes(), m.min(0).tobytes(), m.max(0).tobytes()

        def batch(out):
            kinds = [pa.list_(pa.int64()), pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(map(list, zip(*out)), kinds)], names)

        for b in batches:
            ids += b.column(0).to_pylist()
            parts += b.column(2).to_pylist()
            if len(ids) >= BLOCK:
                full = len(ids) // BLOCK * BLOCK
                yield batch([rows(ids[i : i + BLOCK], parts[i : i + BLOCK]) for i in range(0, full, BLOCK)])
                ids, parts = ids[full:], parts[full:]
        if ids:
            yield batch([rows(ids, parts)])

    return saved(along.mapInArrow(cut, schema), "curve-blocks")


def _read(b: pa.RecordBatch, dims: int, centroids: np.ndarray):
    """For each block of an Arrow batch: ids, vectors as doubles, numbers of the centroids that its box allows."""
    rows = b.num_rows
    for first in range(0, rows, 64):  # the bounds of 64 boxes at once
        part = b.slice(first, 64)
        lo, hi = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.int32).reshape(-1, dims).astype(np.float64) for c in (4, 5))
        allowed = box_candidates(lo, hi, centroids)
        for i in range(part.num_rows):
            raw = np.frombuffer(part.column(3)[i].as_py(), np.int32 if part.column(2)[i].as_py() else np.int16)
            yield part.column(0)[i].values, raw.reshape(-1, dims).astype(np.float64), np.flatnonzero(allowed[i])


def first_centroids(blocks: DataFrame, dims: int, k: int, prefix: str) -> np.ndarray:
    """The ``k`` vectors with the smallest SHA-256 of ``prefix`` and their id (NULL: nothing), in that order; ties by components."""
    def least(batches):
        best: list[tuple] = []
        for b in batches:
            for i in range(b.num_rows):
                m = np.frombuffer(b.column(3)[i].as_py(), np.int32 if b.column(2)[i].as_py() else np.int16).reshape(-1, dims)
                best += [(hashlib.sha256(f"{prefix}{'' if x is None else x}".encode()).hexdigest(), r.tolist()) for x, r in zip(b.column(0)[i].values.to_pylist(), m)]
                best = sorted(best)[:k]
        yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in best], pa.string()), pa.array([r for _, r in best], pa.list_(pa.int32()))], ["h", "v"])

    rows = blocks.mapInArrow(least, "h string, v array<int>").orderBy("h", "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.float64).reshape(-1, dims)


def totals(blocks: DataFrame, dims: int, centroids: np.ndarray) -> dict[int, tuple[int, int, list[int], int, int]]:
    """number -> (vectors, sum of distances, sums of components) of one assignment, and over all: (blocks x centroids compared, blocks)."""
    k = len(centroids)

    def add(batches):
        n, d, s, tried, seen = np.zeros(k, np.int64), [0] * k, np.zeros((k, dims), np.int64), 0, 0
        for b in batches:
            for _, m, some in _read(b, dims, centroids):
                c, dist = nearest(m, centroids, some)
                n += np.bincount(c, minlength=k)
                hit = np.zeros((k, len(c)))
                hit[c, np.arange(len(c))] = 1.0
                s += (hit @ m).astype(np.int64)
                for j in np.unique(c):
                    d[j] += int(dist[c == j].sum())
                tried, seen = tried + len(some), seen + 1
        yield pa.RecordBatch.from_arrays([
            pa.array(range(k), pa.int32()), pa.array(n), pa.array([Decimal(x) for x in d], pa.decimal128(38, 0)), pa.array(list(s), pa.list_(pa.int64())),
            pa.array([tried] + [0] * (k - 1), pa.int64()), pa.array([seen] + [0] * (k - 1), pa.int64())], ["c", "n", "d", "s", "tried", "seen"])

    got = blocks.mapInArrow(add, "c int, n long, d decimal(38,0), s array<long>, tried long, seen long").groupBy("c").agg(
        F.sum("n").alias("n"), F.sum("d").alias("d"), F.array(*[F.sum(F.col("s")[i]) for i in range(dims)]).alias("s"), F.sum("tried").alias("tried"), F.sum("seen").alias("seen"))
    return {r["c"]: (r["n"], int(r["d"]), r["s"], r["tried"], r["seen"]) for r in got.collect()}  # k rows


def cluster(vectors: DataFrame, dims: int = 64, k: int = 40, rounds: int = 5, prefix: str = "2:", vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of each kept vector.

    Kept are vectors with exactly ``dims`` components, all finite; others, and NULL
    arrays, are left out. A component x counts as floor(256 x), held to +-2 ** 22.
    Centroids start as the ``k`` kept vectors with the smallest SHA-256 of ``prefix``
    and id (all of them if there are fewer), move ``rounds`` times to the floor of
    their vectors' mean, and stay where no vector is nearest. Ties go to the smaller
    number. Repeated rows count each; NULL ids stay NULL. Other columns are ignored.
    A table without a kept vector gives an empty table.
    """
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    blocks = curve_blocks(vectors, dims, vec_id, embedding)
    centroids = first_centroids(blocks, dims, k, prefix)
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], schema)
    for _ in range(rounds):
        for c, (n, _, s, *_) in totals(blocks, dims, centroids).items():
            if n:
                centroids[c] = [x // n for x in s]
    most = (1 << 63) - 1
    last = totals(blocks, dims, centroids)
    inertia = [min(last[c][1], most) for c in range(len(centroids))]
    every = min(sum(last[c][1] for c in last), most)
    sha = pa.array([hashlib.sha256(",".join(str(int(x)) for x in c).encode()).hexdigest() for c in centroids])
    names = [x.split()[0] for x in schema.split(", ")]

    def label(batches):
        for b in batches:
            for ids, m, some in _read(b, dims, centroids):
                c, dist = nearest(m, centroids, some)
                yield pa.RecordBatch.from_arrays([
                    ids.cast(pa.int64()), pa.array(c.astype(np.int32)), pa.array(dist), pa.array(np.array(inertia, np.int64)[c]),
                    pa.array(np.full(len(c), every, np.int64)), sha.take(pa.array(c))], names)

    return blocks.mapInArrow(label, schema)
