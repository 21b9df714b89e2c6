"""K-means inside every group at once.

A group's points lie in blocks of bounded size. Start points are drawn by their
squared distance from the starts before them, as a race: a point's time is
``-ln(u) / distance²`` with ``u`` from a hash of its key, and the first one to
arrive is taken, so ``k`` passes choose all starts whatever the order of rows.
A group that is one block is solved in its task; of a larger group each task
does one pass over its block, and sums and races are merged by Spark.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from reviewlens import constants as K
from reviewlens.functions.vectors import as_vector, unit_vector
from reviewlens.operators.blocks import per_block, point_blocks, points_of, single_rows, vector_sum
from reviewlens.session import materialize

#: Hashes are taken modulo this prime.
PRIME = (1 << 31) - 1


def race_factors(seed: int, restarts: int, k: int) -> np.ndarray:
    """(factor, offset) of the hash that draws start ``j`` of restart ``r``."""
    digests = [[hashlib.md5(f"{seed}|{r}|{j}".encode()).hexdigest() for j in range(k)] for r in range(restarts)]
    return np.array([[(int(d[:8], 16) % (PRIME - 1) + 1, int(d[8:16], 16) % PRIME) for d in row] for row in digests], dtype=np.int64)


def squared_distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Of every point to every center; a center that is not there is infinitely far."""
    out = np.stack([np.square(x - c).sum(axis=1) for c in centers], axis=1)
    return np.where(np.isnan(out), np.inf, out)


def arrivals(hashes: np.ndarray, factor: np.ndarray, distance: np.ndarray | None) -> np.ndarray:
    """Time at which each point arrives in the race for a start; without distances all run alike."""
    u = ((hashes * factor[0] + factor[1]) % PRIME + 1) / (PRIME + 1)
    lead = -np.log(u)
    if distance is None:
        return lead
    with np.errstate(divide="ignore"):
        return np.where(distance > 0, lead / distance, np.inf)


def first_arrival(times: np.ndarray, hashes: np.ndarray) -> int:
    """The earliest point; of equally early ones that of the lowest hash, then the first."""
    first = np.flatnonzero(times == times.min())
    return int(first[hashes[first].argmin()])


def starts_of(x: np.ndarray, hashes: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Start points of one restart, as many as there are factors."""
    chosen, nearest = [], None
    for factor in factors:
        chosen.append(x[first_arrival(arrivals(hashes, factor, nearest), hashes)])
        gap = np.square(x - chosen[-1]).sum(axis=1)
        nearest = gap if nearest is None else np.minimum(nearest, gap)
    return np.array(chosen)


def means_of(x: np.ndarray, cluster: np.ndarray, k: int) -> np.ndarray:
    """Mean of each cluster's points; NaN without points."""
    counts = np.bincount(cluster, minlength=k)
    sums = np.zeros((k, x.shape[1]))
    np.add.at(sums, cluster, x)
    with np.errstate(invalid="ignore"):
        return sums / np.where(counts > 0, counts, np.nan)[:, None]


class Bounds:
    """Assignment of points with an upper bound of the distance to the own center and a lower one of that to any other.

    When centers move, bounds move by as much; a point is compared with all
    centers only where its bounds no longer keep them apart.
    """

    #: Rounding that bounds allow for, as a share of the numbers in them.
    SLACK = 1e-9

    def __init__(self, x: np.ndarray, centers: np.ndarray):
        self.x = x
        self.cluster = np.zeros(len(x), dtype=np.int64)
        self.upper, self.lower = np.empty(len(x)), np.empty(len(x))
        self.compared = 0
        self._compare(np.arange(len(x)), centers)

    def _compare(self, rows: np.ndarray, centers: np.ndarray) -> None:
        self.compared += len(rows)
        gaps = squared_distances(self.x[rows], centers)
        own = gaps.argmin(axis=1)
        self.cluster[rows] = own
        at = np.arange(len(rows))
        self.upper[rows] = np.sqrt(gaps[at, own])
        gaps[at, own] = np.inf
        self.lower[rows] = np.sqrt(gaps.min(axis=1))

    def move(self, before: np.ndarray, after: np.ndarray) -> int:
        """Follow the centers; returns the number of points with another cluster."""
        step = np.sqrt(np.square(after - before).sum(axis=1))
        # a center that has lost its points is no one's neighbour any more, which only raises distances
        step = np.where(np.isnan(step), 0.0, step)
        others = np.array([np.delete(step, j).max(initial=0.0) for j in range(len(step))])
        self.upper += step[self.cluster]
        self.lower -= others[self.cluster]
        old = self.cluster.copy()
        slack = self.SLACK * (1 + self.upper)
        self._compare(np.flatnonzero(~(self.upper + slack < self.lower)), after)
        return int((old != self.cluster).sum())


def solved(x: np.ndarray, hashes: np.ndarray, factors: np.ndarray, iterations: int) -> tuple[np.ndarray, np.ndarray]:
    """Clusters and centers of the restart with the least inertia; the first one wins a tie."""
    k, best = factors.shape[1], None
    for factor in factors:
        centers = starts_of(x, hashes, factor)
        bounds = Bounds(x, centers)
        for _ in range(iterations):
            after = means_of(x, bounds.cluster, k)
            moved = bounds.move(centers, after)
            centers = after
            if not moved:
                break
        inertia = round(float(np.square(x - centers[bounds.cluster]).sum()), 6)
        if best is None or inertia < best[0]:
            best = inertia, bounds.cluster, centers
    return best[1], best[2]


def _labelled(blocks: DataFrame, by: list[str], label) -> DataFrame:
    """(group, _keys, _clusters, _found) of each block; ``label`` gives the clusters of a block's points, and centers where it found them."""
    kinds = dict(blocks.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in [*by, "_keys"]), "_clusters array<int>, _found array<array<double>>"])
    used = [c for c in blocks.columns if c not in (*by, "_keys")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in single_rows(batches):
            clusters, found = label(one.select(used).to_pylist()[0])
            columns = [*(one.column(c) for c in [*by, "_keys"]), pa.array([clusters.tolist()], pa.list_(pa.int32())),
                       pa.array([found], pa.list_(pa.list_(pa.float64())))]
            yield pa.RecordBatch.from_arrays(columns, names=[*by, "_keys", "_clusters", "_found"])

    return blocks.mapInArrow(run, schema)


def _with_centers(blocks: DataFrame, centers: DataFrame, by: list[str]) -> DataFrame:
    """Blocks with their group's centers, of which a group has no more than restarts times k."""
    packed = centers.groupBy(*by).agg(F.collect_list(F.struct("_restart", "cluster", "at")).alias("_centers"))
    return blocks.join(packed, by)


def _centers_of(row: dict, k: int, width: int) -> dict[int, np.ndarray]:
    """Centers by restart; NaN where a cluster has none."""
    out: dict[int, np.ndarray] = {}
    for c in row["_centers"]:
        out.setdefault(c["_restart"], np.full((k, width), np.nan))[c["cluster"]] = c["at"]
    return dict(sorted(out.items()))


def _raced_starts(blocks: DataFrame, by: list[str], factors: np.ndarray) -> DataFrame:
    """(group, _restart, cluster, at): the winners of one race per start over all blocks of a group."""
    restarts, k = factors.shape[:2]
    centers = None
    for j in range(k):
        def race(row: dict, j=j) -> list[tuple]:
            x, hashes = points_of(row), np.array(row["_hashes"])
            before = _centers_of(row, k, x.shape[1]) if j else {}
            found = []
            for r in range(restarts):
                nearest = squared_distances(x, before[r]).min(axis=1) if j else None
                times = arrivals(hashes, factors[r, j], nearest)
                i = first_arrival(times, hashes)
                found.append((r, float(times[i]), int(hashes[i]), x[i].tolist()))
            return found

        here = blocks if centers is None else _with_centers(blocks, centers, by)
        runs = per_block(here, by, race, _restart="int", time="double", hash="long", at="array<double>")
        won = runs.groupBy(*by, "_restart").agg(F.min(F.struct("time", "hash", "at"))["at"].alias("at"))
        won = won.select(*by, "_restart", F.lit(j).alias("cluster"), "at")
        centers = materialize(won if centers is None else centers.unionByName(won))
    return centers


def _split_groups(blocks: DataFrame, by: list[str], factors: np.ndarray, iterations: int) -> tuple[DataFrame, DataFrame]:
    """Labelled blocks and centers of groups with several blocks: one pass over the blocks per start and round."""
    k = factors.shape[1]

    def sums(row: dict) -> list[tuple]:
        x, hashes, out = points_of(row), np.array(row["_hashes"]), []
        for r, centers in _centers_of(row, k, x.shape[1]).items():
            cluster = squared_distances(x, centers).argmin(axis=1)
            for c in np.unique(cluster).tolist():
                mine = cluster == c
                out.append((r, c, int(mine.sum()), int(hashes[mine].sum()), x[mine].sum(axis=0).tolist()))
        return out

    place = [*by, "_restart", "cluster"]
    state = _raced_starts(blocks, by, factors).withColumns({"n": F.lit(None).cast("long"), "mark": F.lit(None).cast("long")})
    settled = state.limit(0)
    for _ in range(iterations):
        parts = per_block(_with_centers(blocks, state, by), by, sums, _restart="int", cluster="int", n="long", mark="long", total="array<double>")
        added = parts.groupBy(*place).agg(vector_sum("total").alias("total"), F.sum("n").alias("n"), F.sum("mark").alias("mark"))
        means = added.select(*place, F.transform("total", lambda x: x / F.col("n")).alias("at"), "n", "mark")
        before = state.select(*place, F.col("n").alias("_n"), F.col("mark").alias("_mark"))
        same = F.col("n").eqNullSafe(F.col("_n")) & F.col("mark").eqNullSafe(F.col("_mark"))
        both = materialize(means.join(before, place, "full_outer").withColumn("_moved", ~same))
        # the number and hashes of a cluster's points tell whether it has changed; a restart without a change has settled
        still = both.groupBy(*by, "_restart").agg(F.max("_moved").alias("_moved"))
        after = materialize(both.drop("_moved", "_n", "_mark").filter("n IS NOT NULL").join(still, [*by, "_restart"]))
        settled = settled.unionByName(after.filter("NOT _moved").drop("_moved"))
        state = after.filter("_moved").drop("_moved")
        if state.isEmpty():
            break
    centers = materialize(settled.unionByName(state))

    def inertia(row: dict) -> list[tuple]:
        x = points_of(row)
        return [(r, float(squared_distances(x, c).min(axis=1).sum())) for r, c in _centers_of(row, k, x.shape[1]).items()]

    parts = per_block(_with_centers(blocks, centers, by), by, inertia, _restart="int", inertia="double")
    total = parts.groupBy(*by, "_restart").agg(F.round(F.sum("inertia"), 6).alias("inertia"))
    won = total.groupBy(*by).agg(F.min(F.struct("inertia", "_restart"))["_restart"].alias("_restart"))
    best = materialize(centers.join(won, [*by, "_restart"], "left_semi"))

    def nearest(row: dict) -> tuple[np.ndarray, None]:
        x = points_of(row)
        (centers,) = _centers_of(row, k, x.shape[1]).values()
        return squared_distances(x, centers).argmin(axis=1), None

    return _labelled(_with_centers(blocks, best, by), by, nearest), best.select(*by, "cluster", "at")


def fit_kmeans(
    df: DataFrame, by: Sequence[str], key: str, vector: str = "embedding",
    k: int = K.CLUSTERS_PER_SENTIMENT, restarts: int = K.KMEANS_RESTARTS, iterations: int = K.KMEANS_ROUNDS,
    seed: int = K.SEED,
) -> tuple[DataFrame, DataFrame]:
    """K-means inside every group at once: members (``by``…, key, cluster) and centers (``by``…, cluster, center).

    Every restart draws its own starts and goes on until no point changes its
    cluster, for ``iterations`` rounds at the most; the one with the least
    inertia wins. Of equally near centers the lower number wins. Groups of up
    to k different points get a cluster for each of them. Centers come back
    with length one, clusters without members are left out. Rows with a null
    group or vector take no part; ``key`` is a key within a group, and the
    vectors of a group have one length.
    """
    by = list(by)
    points = df.select(*by, key, as_vector(vector).alias("_x")).dropna(subset=[*by, "_x"])
    digest = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))
    hashed = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % PRIME
    blocks = materialize(point_blocks(materialize(points), by, key, "_x", hashed))
    factors = race_factors(seed, restarts, k)

    def solve(row: dict) -> tuple[np.ndarray, list]:
        cluster, centers = solved(points_of(row), np.array(row["_hashes"]), factors, iterations)
        return cluster, [None if np.isnan(c).any() else c.tolist() for c in centers]

    labelled = materialize(_labelled(blocks.filter("_blocks = 1"), by, solve))
    centers = labelled.select(*by, F.posexplode("_found").alias("cluster", "at")).filter("at IS NOT NULL")
    large = blocks.filter("_blocks > 1")
    if not large.isEmpty():
        more, more_centers = _split_groups(large, by, factors, iterations)
        labelled, centers = labelled.unionByName(more), centers.unionByName(more_centers)
    member = F.explode(F.arrays_zip(F.col("_keys").alias("key"), F.col("_clusters").alias("cluster"))).alias("_m")
    members = labelled.select(*by, member).select(*by, F.col("_m.key").alias(key), F.col("_m.cluster").alias("cluster"))
    return members, centers.select(*by, "cluster", unit_vector("at").alias("center"))
