"""Centroid clustering of vectors in exact integers, filtered by a PCA rotation.

Each vector is stored with its leading rotated coordinates and the norm of the
rest. The squared distance of two vectors is at least that of their leading
coordinates plus the squared difference of the two norms; only centroids whose
bound is not above the best distance so far are compared, in integers. The
rotation decides how much is compared, never the result.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.llm.common import arrow_schema
from loomcast.session import checkpoint

#: Integer steps of a component's unit; components beyond ``LARGEST`` steps would not fit a long when squared.
SCALE, LARGEST = 256, 1 << 27
#: Vectors that are compared at once.
_ROWS = 4096
_STORED = "vec_id long, v array<int>, lead array<double>, rest double"
_NEAREST = "vec_id long, cluster int, distance long"
_SUMS = "cluster int, n long, sums array<long>"


def integer_vectors(vectors: DataFrame, dims: int, column: str = "embedding") -> DataFrame:
    """(vec_id, v): the vectors of ``dims`` finite components, each as floor(256 * x)."""
    x = F.transform(F.col(column), lambda c: c.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long"), x.alias("x"))
    sound = F.forall("x", lambda c: c.isNotNull() & (F.abs(c) < F.lit(float("inf"))))  # NaN is the largest of all
    rows = rows.filter((F.size("x") == dims) & sound)

    def step(c):
        fits = F.abs(c) < F.lit(LARGEST / SCALE)
        return F.when(fits, F.floor(c * SCALE).cast("int")).otherwise(F.raise_error(F.lit("a vector's component is too large")).cast("int"))

    return rows.select("vec_id", F.transform("x", step).alias("v"))


def _matrix(column: pa.Array, kind, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, width)


class Rotation:
    """The leading principal axes of a table of vectors, and its mean."""

    def __init__(self, axes: np.ndarray, mean: np.ndarray):
        self.axes, self.mean = axes, mean

    @classmethod
    def fitted(cls, vectors: DataFrame, dims: int, leading: int) -> Rotation:
        """Axes by the covariance of all vectors, which is summed in tasks; ``dims`` by ``dims`` numbers come back."""
        n, *mean = vectors.agg(F.count(F.lit(1)), *[F.avg(F.col("v")[i]) for i in range(dims)]).first()
        if n < 2:
            return cls(np.eye(dims)[:, :leading], np.zeros(dims))
        rows = vectors.select(array_to_vector(F.col("v").cast("array<double>")).alias("x"))
        return cls(PCA(k=leading, inputCol="x", outputCol="y").fit(rows).pc.toArray(), np.array(mean))

    def __call__(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leading coordinates of each row, and the norm of what they leave out."""
        centred = v - self.mean
        lead = centred @ self.axes
        return lead, np.sqrt(np.maximum((centred**2).sum(axis=1) - (lead**2).sum(axis=1), 0))


def nearest(v: np.ndarray, lead: np.ndarray, rest: np.ndarray, centroids: tuple) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid and squared distance of each row, ties to the smaller number; and how many were compared."""
    c, c_lead, c_rest = centroids
    bound = ((lead[:, None, :] - c_lead) ** 2).sum(axis=2) + (rest[:, None] - c_rest) ** 2
    # rounding errors are small next to the squared norms
    size = (lead**2).sum(axis=1) + rest**2
    bound -= 1e-9 * (size[:, None] + (c_lead**2).sum(axis=1) + c_rest**2) + 1
    order = np.argsort(bound, axis=1, kind="stable")
    cluster = np.full(len(v), len(c))
    best = np.full(len(v), np.iinfo(np.int64).max)
    live, compared = np.arange(len(v)), 0
    for place in range(len(c)):
        tried = order[live, place]
        may_win = bound[live, tried] <= best[live]
        live, tried = live[may_win], tried[may_win]
        if not len(live):
            break
        compared += len(live)
        d = ((v[live] - c[tried]) ** 2).sum(axis=1)
        wins = (d < best[live]) | ((d == best[live]) & (tried < cluster[live]))
        best[live[wins]], cluster[live[wins]] = d[wins], tried[wins]
    return cluster, best, compared


def _assigned(batches, centroids):
    """(vec_id, v, cluster, distance) of slices of stored vectors."""
    for batch in batches:
        for first in range(0, batch.num_rows, _ROWS):
            part = batch.slice(first, _ROWS)
            v = _matrix(part.column("v"), np.int64, centroids[0].shape[1])
            lead = _matrix(part.column("lead"), np.float64, centroids[1].shape[1])
            cluster, distance, _ = nearest(v, lead, part.column("rest").to_numpy(zero_copy_only=False), centroids)
            yield part.column("vec_id"), v, cluster, distance


def _summed(stored: DataFrame, centroids: tuple, dims: int) -> dict[int, tuple[int, list[int]]]:
    """Number and component sums of each cluster's vectors: one row per cluster and task, added up by Spark."""
    schema, k = arrow_schema(_SUMS), len(centroids[0])

    def run(batches):
        sums, n = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for _, v, cluster, _ in _assigned(batches, centroids):
            order = np.argsort(cluster, kind="stable")
            found, starts = np.unique(cluster[order], return_index=True)
            sums[found] += np.add.reduceat(v[order], starts, axis=0)
            n[found] += np.diff([*starts, len(v)])
        own = np.flatnonzero(n)
        columns = (own.astype(np.int32), n[own], list(sums[own]))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    parts = stored.select("vec_id", "v", "lead", "rest").mapInArrow(run, _SUMS)
    total = F.array(*[F.sum(F.col("sums")[i]) for i in range(dims)])
    return {r.cluster: (r.n, r.sums) for r in parts.groupBy("cluster").agg(F.sum("n").alias("n"), total.alias("sums")).collect()}


def cluster_vectors(
    vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, leading: int = 8, salt: str = "2:", column: str = "embedding"
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every sound vector, and the final centroids (k, dims).

    A vector counts if it has exactly ``dims`` components, none null or not
    finite; other rows have no result. The ``k`` vectors of least sha256 of
    ``salt`` and id (a null id as an empty text; equal hashes by their components)
    are the first centroids; with fewer vectors, all of them. Each round assigns
    every vector to the nearest centroid, ties to the smaller number, and moves
    centroids with vectors to the floor of their mean. Repeated rows are vectors
    of their own; an empty table has no rows and no centroids; other columns are
    not read. Components of 2 ** 19 or more raise an error, as distances would
    not fit a long.

    ``k`` centroids are sent to the tasks and ``k`` sums come back each round.
    """
    rows = integer_vectors(vectors, dims, column)
    rotation = Rotation.fitted(rows, dims, min(leading, dims))
    schema = arrow_schema(_STORED)

    def rotated(batches):
        for batch in batches:
            lead, rest = rotation(_matrix(batch.column("v"), np.float64, dims))
            columns = (batch.column("vec_id"), batch.column("v"), list(lead), rest)
            arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
            yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, schema, strict=True)], schema=schema)

    stored = checkpoint(rows.mapInArrow(rotated, _STORED))
    place = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    chosen = stored.select("v", place.alias("place")).orderBy("place", "v").limit(k).collect()
    c = np.array([r.v for r in chosen], np.int64).reshape(len(chosen), dims)
    for _ in range(rounds if len(c) else 0):
        sums = _summed(stored, (c, *rotation(c)), dims)
        moved = c.copy()
        for i, (n, total) in sums.items():
            moved[i] = [s // n for s in total]
        if (moved == c).all():
            break  # further rounds would change nothing
        c = moved
    final = (c, *rotation(c))
    out = arrow_schema(_NEAREST)

    def assign(batches):
        for ids, _, cluster, distance in _assigned(batches, final):
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())], schema=out)

    return stored.mapInArrow(assign, _NEAREST), c


def cluster_report(vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64) -> DataFrame:
    """``cluster_vectors`` with inertia per cluster and over all, and a digest of the vector's centroid.

    Inertia beyond a long raises an error. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    found, centroids = cluster_vectors(vectors, k, rounds, dims)
    found = checkpoint(found)
    sums = {r.cluster: int(r.s) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    total = reduce(int.__add__, sums.values(), 0)
    rows = [(i, s, total, digests[i]) for i, s in sorted(sums.items())]  # at most k
    about = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _rounds_in_sql(k: int, rounds: int, dims: int) -> str:
    """The same in SQL: every vector against every centroid, a round as two common tables."""
    assigned = """
a{i} as (
  select r, vec_id, v, w % {k} as cluster, ((w - w % {k}) // {k})::bigint as distance
  from (
    select r, any_value(vec_id) as vec_id, any_value(v) as v, min(d::hugeint * {k} + c) as w
    from (
      select s.r, s.vec_id, s.v, m.c,
        list_sum([(p[1] - p[2]) * (p[1] - p[2]) for p in list_zip(s.v, m.v)])::bigint as d
      from sound s, c{i} m
    ) group by r
  )
)"""
    moved = """
c{j} as (
  select o.c, coalesce(n.v, o.v) as v
  from c{i} o left join (
    select cluster, list(q order by place) as v from (
      select cluster, place, ((s - ((s % n) + n) % n) // n)::bigint as q
      from (
        select cluster, place, sum(x)::hugeint as s, count(*)::hugeint as n
        from (select cluster, unnest(v) as x, generate_subscripts(v, 1) as place from a{i})
        group by cluster, place
      )
    ) group by cluster
  ) n on o.c = n.cluster
)"""
    steps = [assigned.format(i=i, k=k) + "," + moved.format(i=i, j=i + 1) for i in range(rounds)]
    return (
        f"""
with sound as (
  select row_number() over () as r, vec_id, [floor(256 * x::double)::bigint for x in embedding] as v
  from embeddings
  where len(embedding) = {dims} and list_bool_and([x is not null and isfinite(x) for x in embedding])
), c0 as (
  select row_number() over (order by h) - 1 as c, v
  from (select sha256('2:' || vec_id::varchar) as h, v from sound order by h limit {k})
),"""
        + ",".join(steps)
        + ","
        + assigned.format(i=rounds, k=k)
        + f"""
select a.vec_id, a.cluster::int as cluster, a.distance,
  sum(a.distance) over (partition by a.cluster)::bigint as cluster_inertia,
  sum(a.distance) over ()::bigint as inertia,
  sha256(array_to_string(m.v, ',')) as centroid_sha256
from a{rounds} a join c{rounds} m on a.cluster = m.c
"""
    )


SQL = _rounds_in_sql(40, 5, 64)
