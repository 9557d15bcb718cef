"""Nearest neighbours by randomly rotated one-bit codes (after the published RaBitQ estimator).

Vectors are centred on the mean, scaled to length 1 and rotated by a fixed random rotation; a code keeps the sign of each
coordinate, packed, with two correction scalars: the distance to the centre and the inner product of the code with the
vector it stands for. From them a query estimates each squared distance with an error bound. In each block the vectors
with the best estimates are measured exactly; all whose lower bound doesn't exceed the k-th of these distances are
reranked exactly, in double precision. The first block's k-th distance is an upper bound for each query, and the others
give only rows within it. Winners are merged in levels of bounded groups. Every row is indexed.

Rows are dealt to blocks by a hash of their id and vector, queries to chunks; a task gets one block with one chunk, both of
bounded size, so no query set is broadcast.

Nulls and odd input: vectors that are null, zero or hold null or non-finite components take no part, nor do vectors whose
length isn't the most frequent one (ties: the larger); a null id takes no part; rows that repeat an id are candidates each,
but not for a query of that id; fewer than k candidates are all returned; an empty table gives no row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import Scratch

BLOCK, CHUNK, EPSILON = 8192, 4096, 3.0
#: Queries estimated at once, and cells whose winners one group merges.
TOGETHER, FAN = 64, 256
#: Squared distances are compared with this slack, so that rounding loses no row.
SLACK = 1 + 1e-6
CODES = "vec_id long, vector array<double>, code binary, norm double, fit double"


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector) of the rows that take part."""
    v = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vector")).filter("vec_id is not null and vector is not null and size(vector) > 0")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.filter(F.coalesce(finite, F.lit(False)) & F.exists("vector", lambda x: x != 0))


def rotation(dim: int, seed: int = 7) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed codes, distances to the centre, and inner products of code and unit vector."""
    away = vectors - centre
    norm = np.sqrt((away**2).sum(1))
    unit = (away / np.maximum(norm, 1e-300)[:, None]) @ turn
    return np.packbits(unit > 0, axis=1), norm, np.abs(unit).sum(1) / np.sqrt(vectors.shape[1])


def _array(column, dim: int) -> np.ndarray:
    return np.asarray(column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()).reshape(-1, dim)


def build_index(vectors: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """The coded rows and the centre; the dimension is the most frequent one."""
    rows = usable(vectors)
    dims = rows.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    dim = dims["dim"] if dims else 1
    rows = rows.filter(F.size("vector") == dim)
    mean = rows.agg(*[F.avg(F.col("vector")[i]).alias(str(i)) for i in range(dim)]).first()
    centre, turn = np.array([x or 0.0 for x in mean]), rotation(dim)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                code, norm, fit = encode(_array(batch.column("vector"), dim), centre, turn)
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("vector"), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(norm), pa.array(fit)], names=["vec_id", "vector", "code", "norm", "fit"])

    return rows.mapInArrow(run, CODES), centre


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of a and each row of b, summed in the order of the components."""
    total = np.zeros(len(b))
    for j in range(b.shape[1]):
        total += (b[:, j] - a[j]) ** 2
    return total


def _merged(found: DataFrame, k: int, *by: str) -> DataFrame:
    """The k nearest rows of each group; callers see to it that groups are small."""
    best = F.slice(F.array_sort(F.collect_list(F.struct("score", "vec_id"))), 1, k)
    return found.groupBy("query_id", *by).agg(best.alias("best"))


def search(index: DataFrame, centre: np.ndarray, queries: Column, k: int = 10, epsilon: float = EPSILON) -> DataFrame:
    """query_id, rank, vec_id and score, the distance, of the k nearest other rows for each row of the index that `queries` holds for."""
    dim, turn = len(centre), rotation(len(centre))
    scratch = Scratch(index.sparkSession, "codes")
    index = scratch.keep(index, "rows")
    counts = index.agg(F.count(F.lit(1)).alias("n"), F.count_if(queries).alias("q")).first()
    blocks, chunks = max(1, -(-counts["n"] // BLOCK)), max(1, -(-counts["q"] // CHUNK))
    rows = index.withColumn("block", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks)).cast("int"))
    asked = scratch.keep(index.filter(queries).select("vec_id", "vector").distinct(), "queries")
    asked = asked.withColumn("chunk", F.pmod(F.xxhash64("vec_id", "vector", F.lit(1)), F.lit(chunks)).cast("int"))

    def cell(rows: pa.Table, asks: pa.Table) -> pa.Table:
        out: dict[int, list[tuple[float, int]]] = {}
        number = 0
        if rows.num_rows and asks.num_rows:
            number = rows["block"][0].as_py() * chunks + asks["chunk"][0].as_py()
            ids, vectors = np.asarray(rows["vec_id"]), _array(rows["vector"], dim)
            norm, fit = np.asarray(rows["norm"]), np.maximum(np.asarray(rows["fit"]), 1e-9)
            bits = np.unpackbits(np.frombuffer(b"".join(rows["code"].to_pylist()), np.uint8).reshape(len(ids), -1), axis=1, count=dim)
            signs = (bits.astype(np.float32) * 2 - 1) / np.float32(np.sqrt(dim))
            wide = epsilon * np.sqrt(np.maximum(0, 1 - fit**2)) / fit / np.sqrt(max(1, dim - 1))
            wanted, targets = asks["vec_id"].to_pylist(), _array(asks["vector"], dim)
            known = asks["limit"].to_pylist()
            away = targets - centre
            far = np.sqrt((away**2).sum(1))
            turned = ((away / np.maximum(far, 1e-300)[:, None]) @ turn).astype(np.float32)
            for begin in range(0, len(wanted), TOGETHER):
                inner = turned[begin : begin + TOGETHER] @ signs.T
                for i, own in enumerate(inner, begin):
                    guess = norm**2 + far[i] ** 2 - 2 * norm * far[i] * own / fit
                    other = ids != wanted[i]
                    guess[~other] = np.inf
                    n = min(k, int(other.sum()))
                    if not n:
                        continue
                    least = guess - 2 * norm * far[i] * wide
                    limit = np.inf if known[i] is None else known[i] ** 2
                    if not (least <= limit * SLACK).any():
                        continue
                    first = np.argpartition(guess, n - 1)[:n]
                    limit = min(limit, exact(targets[i], vectors[first]).max())
                    near = np.union1d(np.flatnonzero((least <= limit * SLACK) & other), first)
                    score = np.sqrt(exact(targets[i], vectors[near]))
                    best = np.lexsort((ids[near], score))[:k]
                    out.setdefault(wanted[i], []).extend((float(score[j]), int(ids[near][j])) for j in best if score[j] ** 2 <= limit * SLACK)
        flat = [(query, number, v, d) for query, found in out.items() for d, v in sorted(found)[:k]]
        q, c, v, d = zip(*flat, strict=True) if flat else ((), (), (), ())
        return pa.table({"query_id": pa.array(q, pa.int64()), "cell": pa.array(c, pa.int64()), "vec_id": pa.array(v, pa.int64()), "score": pa.array(d, pa.float64())})

    def cells(rows: DataFrame, asked: DataFrame, first: int, last: int) -> DataFrame:
        base = rows.filter(F.col("block").between(first, last)).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
        asks = asked.withColumn("block", F.explode(F.sequence(F.lit(first), F.lit(last))))
        return base.groupBy("block", "chunk").cogroup(asks.groupBy("block", "chunk")).applyInArrow(cell, "query_id long, cell long, vec_id long, score double")

    # One block first: its k-th distance bounds that of all rows, so the other blocks give only rows within it.
    found = scratch.keep(cells(rows, asked.withColumn("limit", F.lit(None).cast("double")), 0, 0), "first")
    if blocks > 1:
        limits = found.groupBy(F.col("query_id").alias("vec_id")).agg(F.max("score").alias("limit"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= k)
        bounded = scratch.keep(asked.join(limits.select("vec_id", "limit"), "vec_id", "left"), "bounded")
        found = found.unionByName(cells(rows, bounded, 1, blocks - 1))
    # A group merges at most FAN cells of k rows each, so none follows the number of blocks.
    left = blocks * chunks
    while left > FAN:
        left = -(-left // FAN)
        step = found.withColumn("cell", F.floor(F.col("cell") / FAN).cast("long"))
        found = _merged(step, k, "cell").select("query_id", "cell", F.explode("best").alias("b")).select("query_id", "cell", "b.vec_id", "b.score")
    return _merged(found, k).select("query_id", F.posexplode("best").alias("pos", "b")).select("query_id", (F.col("pos") + 1).alias("rank"), F.col("b.vec_id").alias("vec_id"), F.col("b.score").alias("score"))


def nearest(vectors: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """The k nearest of each row whose vec_id is divisible by `every`."""
    index, centre = build_index(vectors)
    return search(index, centre, F.col("vec_id") % every == 0, k)
