"""Centroid clustering (operator 12): k-means on integer vectors, where a tournament of bisectors
finds the nearest centroid.

Components become integers, so every sum, distance and comparison is exact and no result depends on
how rows are dealt. For each pair a < b of centroids, the points as near to a as to b are a
hyperplane: with the normal 2(b - a) and the threshold |b|^2 - |a|^2, a vector is nearer to b just
when its product with the normal is above the threshold. Starting with centroid 0, the winner so far
meets centroids 1, 2, ... in turn; a zero favours the smaller number, which the winner always has.
k - 1 such sign tests leave the nearest centroid, and its distance is computed once, at the end.

The integer vectors are made once and checkpointed, four bytes a component. A round is one scan of
them: tasks add up count and component sums of each cluster, and Spark adds the k rows of every task.
What the driver holds is k centroids. Rounds only depend on the centroids before, not on earlier
frames, so a lost executor costs a scan of its part.

Defined results: vectors that are null, have another number of components, or one that is null or
not finite, aren't kept and give no row. A component beyond ``LARGEST`` after scaling is taken as
``LARGEST``, so that distances fit a long; an inertia beyond a long is null. A null vec_id is passed
through but can't be a first centroid; rows that repeat count each; equal hashes (repeated ids) are
ordered by their packed vectors; with fewer kept vectors than ``k`` there are so many centroids; an empty
table gives no rows; other columns, whatever their names, are ignored."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm._graph import cut

COMPONENTS, SCALE, K, ROUNDS, SEED = 64, 1024, 8, 10, "3"
LARGEST = 1 << 27  # 64 * (2 * LARGEST)^2 is below 2^63

SCHEMA = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"


def integers(column, components: int = COMPONENTS, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of a list<double> column are kept, and their integer vectors."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.array(column.value_lengths().fill_null(-1))
    at = np.flatnonzero(sizes == components)
    flat = column.take(pa.array(at)).flatten()
    kept = np.zeros(len(sizes), bool)
    values = np.asarray(flat.to_numpy(zero_copy_only=False), np.float64).reshape(len(at), components)
    fine = np.isfinite(values).all(1)  # a null became NaN
    kept[at[fine]] = True
    scaled = np.floor(np.clip(values[fine] * scale, -LARGEST, LARGEST))
    return kept, scaled.astype(np.int64)


def bisectors(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normals and thresholds of all pairs, by the two numbers."""
    square = (centroids * centroids).sum(1)
    return 2 * (centroids[None, :, :] - centroids[:, None, :]), square[None, :] - square[:, None]


def tournament(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The number of every vector's nearest centroid."""
    normal, threshold = bisectors(centroids)
    winner = np.zeros(len(x), np.int64)
    for b in range(1, len(centroids)):
        side = np.einsum("ij,ij->i", x, normal[winner, b]) - threshold[winner, b]
        winner[side > 0] = b
    return winner


def distances(x: np.ndarray, centroids: np.ndarray, cluster: np.ndarray) -> np.ndarray:
    gap = x - centroids[cluster]
    return (gap * gap).sum(1)


def integer_vectors(table: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """``vec_id, packed``: the kept vectors, each component four bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, x = integers(batch.column("embedding"), components, scale)
            packed = [v.tobytes() for v in x.astype("<i4")]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").filter(pa.array(kept)), pa.array(packed, pa.binary())], names=["vec_id", "packed"])

    plain = table.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return plain.mapInArrow(run, "vec_id bigint, packed binary")


def unpacked(column, components: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(-1, components).astype(np.int64)


def first_centroids(vectors: DataFrame, k: int = K, seed: str = SEED, components: int = COMPONENTS) -> np.ndarray:
    """The vectors with the ``k`` smallest hashes of their id, in the order of the hash."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    picked = vectors.where("vec_id IS NOT NULL").orderBy(hashed, "packed").limit(k).collect()
    return unpacked(pa.array([bytes(r["packed"]) for r in picked], pa.binary()), components)


def sums(vectors: DataFrame, centroids: np.ndarray, components: int) -> dict[int, tuple[int, list[int], int]]:
    """For each cluster that isn't empty: its vectors, their component sums and distances."""
    k = len(centroids)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = unpacked(batch.column("packed"), components)
            cluster = tournament(x, centroids)
            far = distances(x, centroids, cluster)
            there = np.flatnonzero(np.bincount(cluster, minlength=k))
            # distances may be near 2^63 each: their sum is exact in two parts
            rows = [[int((cluster == c).sum()), *x[cluster == c].sum(0).tolist(), int((far[cluster == c] >> 31).sum()), int((far[cluster == c] & 0x7FFFFFFF).sum())] for c in there]
            yield pa.RecordBatch.from_arrays([pa.array(there, pa.int32()), pa.array(rows, pa.list_(pa.int64()))], names=["cluster", "parts"])

    n = components + 3
    # sums of parts are exact decimals: no row count overflows them
    total = [F.sum(F.col("parts")[i].cast("decimal(38,0)")).alias(f"p{i}") for i in range(n)]
    parts = vectors.select("packed").mapInArrow(add_up, "cluster int, parts array<bigint>").groupBy("cluster").agg(*total)
    out = {}
    for r in parts.collect():
        p = [int(r[f"p{i}"]) for i in range(n)]
        out[r["cluster"]] = (p[0], p[1:components + 1], (p[-2] << 31) + p[-1])
    return out


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(c)) for c in centroid).encode()).hexdigest()


def centroid_clusters(table: DataFrame, k: int = K, rounds: int = ROUNDS, seed: str = SEED, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every kept vector
    (see the module's docstring)."""
    vectors = cut(integer_vectors(table, components, scale))
    centroids = first_centroids(vectors, k, seed, components)
    for _ in range(rounds if len(centroids) else 0):
        for c, (count, total, _) in sums(vectors, centroids, components).items():
            centroids[c] = [t // count for t in total]
    last = sums(vectors, centroids, components) if len(centroids) else {}

    def fits(n: int) -> int | None:
        return n if n < 1 << 63 else None

    inertia = [fits(last[c][2]) if c in last else None for c in range(len(centroids))]
    whole = fits(sum(v[2] for v in last.values()))
    digests = [centroid_digest(c) for c in centroids]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = unpacked(batch.column("packed"), components)
            if not len(centroids):
                continue
            cluster = tournament(x, centroids)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(distances(x, centroids, cluster)),
                 pa.array([inertia[c] for c in cluster], pa.int64()), pa.array([whole] * len(x), pa.int64()),
                 pa.array([digests[c] for c in cluster], pa.string())],
                names=["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"])

    return vectors.mapInArrow(assign, SCHEMA)


def oracle(rounds: int = ROUNDS) -> str:
    """The same rounds as unrolled SQL (brute-force distances)."""
    sql = [f"""v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, [floor({SCALE} * x::DOUBLE)::BIGINT for x in embedding] AS e FROM embeddings
  WHERE len(embedding) = {COMPONENTS} AND len([x for x in embedding if x IS NOT NULL AND isfinite(x::DOUBLE)]) = {COMPONENTS}),
x AS MATERIALIZED (SELECT rid, unnest(e) AS x, unnest(range({COMPONENTS})) AS i FROM v),
s AS (SELECT rid, row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) - 1 AS k FROM v QUALIFY k < {K}),
c0 AS MATERIALIZED (SELECT s.k, x.i, x.x AS c FROM s JOIN x USING (rid))"""]
    for n in range(rounds + 1):
        sql.append(f"""d{n} AS (SELECT x.rid, c.k, sum((x.x - c.c) * (x.x - c.c))::BIGINT AS d FROM x JOIN c{n} c ON x.i = c.i GROUP BY x.rid, c.k),
a{n} AS MATERIALIZED (SELECT rid, k, d FROM d{n} QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, k) = 1)""")
        if n < rounds:
            sql.append(f"""m{n} AS (SELECT a.k, x.i, sum(x.x)::BIGINT AS t, count(*) AS n FROM a{n} a JOIN x USING (rid) GROUP BY a.k, x.i),
c{n + 1} AS MATERIALIZED (SELECT c.k, c.i, coalesce((m.t - ((m.t % m.n) + m.n) % m.n) // m.n, c.c) AS c FROM c{n} c LEFT JOIN m{n} m ON c.k = m.k AND c.i = m.i)""")
    return "WITH " + ",\n".join(sql) + f"""
SELECT v.vec_id, a.k::INTEGER AS cluster, a.d AS distance, (sum(a.d) OVER (PARTITION BY a.k))::BIGINT AS cluster_inertia,
       (sum(a.d) OVER ())::BIGINT AS inertia, h.sha AS centroid_sha256
FROM a{rounds} a JOIN v USING (rid) JOIN (SELECT k, sha256(string_agg(c::VARCHAR, ',' ORDER BY i)) AS sha FROM c{rounds} GROUP BY k) h USING (k)
"""


ORACLE = oracle()
