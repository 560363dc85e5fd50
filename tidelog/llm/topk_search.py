"""Exact top-k inner-product search on an impact-ordered index.

Vectors are turned into integers and dealt over shards of bounded size. A
shard's index holds, per dimension, posting segments: the rows whose value
falls into one of a few equal ranges, with the smallest and largest value met.
A query weighs each segment by the most it can add to a score beyond the least
any row gets from that dimension, and processes segments by descending weight
(score at a time). After each slice, a row's score lies between what its
processed segments add at least, and what they add at most plus, for every
dimension still open, the largest weight not yet processed. Rows whose upper
bound is below the k-th lower bound are proven out; when few are left, or all
segments are done, the possible members are scored exactly.

Queries are grouped into blocks, and blocks and shards are each dealt over a
bounded number of parts. A task meets one part of both, and builds the index of
a shard once for all blocks of the part. It keeps the k best rows of each of its
queries over its shards; the worst of them is a bound that also proves out rows
of the next shards. A window with a pushed-down limit merges the tasks. Parts
are read again by each task that meets them: no copies of queries or shards are
shuffled, and none are broadcast, so neither the driver nor the disk holds more
than the vectors and the tasks' results.

Defined cases: vectors that are null, empty, or hold a null or non-finite
component, and rows with a null id, take no part; vectors of another length
than the query's are no candidates; rows equal in id and vector count once; a
row is never its own id's candidate; integers are limited to 60 bits and
scores to the range of a long; ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS = 4096
QUERY_BLOCK = 256
LEVELS = 16
SLICES = 5
SHARD_PARTS = 64    # tasks that a query's results come from, at most
PART_BLOCKS = 8     # query blocks in a part, about; more only beyond
BLOCK_PARTS = 256   # so many parts
SAFE = 1 << 27      # components up to this keep products and sums in 64 bits
LIMIT = 1 << 60


class Shard:
    """Impact-ordered index of one shard."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[order], x[order]
        low, high = self.x.min(0), self.x.max(0)
        width = (high - low) // LEVELS + 1
        level = (self.x - low) // width
        posts, dim, least, most = [], [], [], []
        for d in range(self.x.shape[1]):
            by = np.argsort(level[:, d], kind="stable")
            for own in np.split(by, np.flatnonzero(np.diff(level[by, d])) + 1):
                v = self.x[own, d]
                posts.append(own)
                dim.append(d)
                least.append(v.min())
                most.append(v.max())
        self.posts, self.dim = posts, np.array(dim)
        self.least, self.most = np.array(least, dtype=np.float64), np.array(most, dtype=np.float64)
        self.sizes = np.array([len(p) for p in posts])
        self.first = np.flatnonzero(np.r_[True, np.diff(self.dim) > 0])
        self.exact = np.abs(self.x).max(initial=0) > SAFE

    def possible(self, q: np.ndarray, k: int, floor: float = -np.inf) -> np.ndarray:
        """Rows that may be among the k best of query ``q`` and score ``floor`` at least."""
        n, dims = self.x.shape
        w = q[self.dim].astype(np.float64)
        a, b = w * self.least, w * self.most
        up, low = np.maximum(a, b), np.minimum(a, b)
        # for rounding of large sums
        room = 1e-9 * (1 + max(np.abs(a).max(initial=0), np.abs(b).max(initial=0)) * dims)
        base = np.minimum.reduceat(low, self.first)
        if floor > -np.inf:
            floor -= base.sum() + 1e-9 * abs(floor)
        base = base[self.dim]
        up, low = up - base, low - base
        order = np.argsort(-up, kind="stable")
        done = np.cumsum(self.sizes[order])
        cuts = np.searchsorted(done, np.arange(1, SLICES + 1) * (done[-1] / SLICES), side="left") + 1
        most, least, seen = np.zeros(n), np.zeros(n), np.zeros(n)
        rows, lo = np.arange(n), 0
        for hi in cuts:
            own = order[lo:hi]
            if len(own):
                at = np.concatenate([self.posts[s] for s in own])
                size = self.sizes[own]
                most += np.bincount(at, np.repeat(up[own], size), n)
                least += np.bincount(at, np.repeat(low[own], size), n)
                seen += np.bincount(at, minlength=n)
            lo = hi
            rest = up[order[hi]] if hi < len(order) else 0.0
            kth = np.partition(least, n - k)[n - k] if n > k else -np.inf
            rows = np.flatnonzero(most + (dims - seen) * rest + room >= max(kth, floor))
            if len(rows) <= max(4 * k, n // 64):
                break
        return rows

    def top(self, query_id: int, q: np.ndarray, k: int, floor: float = -np.inf) -> tuple[np.ndarray, np.ndarray]:
        """Exact (ids, scores) of the k best rows, ties to the smaller id; rows
        below ``floor`` may be left out."""
        # sums beyond 64 bits end at the range of a long, where bounds tell nothing
        big = self.exact or np.abs(q).max(initial=0) > SAFE
        rows = np.arange(len(self.ids)) if big else self.possible(q, k + int((self.ids == query_id).sum()), floor)
        rows = rows[self.ids[rows] != query_id]
        if big:
            score = np.array([max(1 - (1 << 63), min((1 << 63) - 1, int(sum(map(int, self.x[r] * q.astype(object))))))
                              for r in rows], dtype=np.int64)
        else:
            score = self.x[rows] @ q
        best = np.lexsort((self.ids[rows], -score))[:k]
        return self.ids[rows][best], score[best]


def integers(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, v, d): valid vectors as floor(scale * x), once per id and vector."""
    x = F.transform(F.col(vector_col), lambda e: e.cast("double"))
    finite = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf"))
    whole = F.transform(x, lambda e: F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.floor(e * F.lit(float(scale))))))
    return (vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull())
            .where((F.size(vector_col) > 0) & F.forall(x, finite))
            .select(F.col(id_col).cast("long").alias("id"), whole.alias("v"), F.size(vector_col).alias("d"))
            .distinct())


def _narrow(x: np.ndarray) -> bytes:
    """Integers as bytes, in the narrowest of the types of 2, 4 and 8 bytes that holds them all."""
    for t in (np.int16, np.int32):
        if np.iinfo(t).min <= x.min() and x.max() <= np.iinfo(t).max:
            return x.astype(t).tobytes()
    return x.tobytes()


def _wide(raw: bytes, n: int, d: int) -> np.ndarray:
    """``n`` vectors of ``d`` integers back from :func:`_narrow`."""
    return np.frombuffer(raw, dtype=f"i{len(raw) // (n * d)}").reshape(n, d).astype(np.int64)


def _packed(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """One row per group of ``keys``: ids and vectors as bytes, in the same order each time."""
    def one(key, pdf: pd.DataFrame) -> pd.DataFrame:
        ids, v = pdf["id"].to_numpy(np.int64), np.stack(pdf["v"].to_numpy()).astype(np.int64)
        order = np.argsort(ids, kind="stable")
        if len(np.unique(ids)) < len(ids):
            order = np.lexsort((*v.T[::-1], ids))
        return pd.DataFrame([[*key, ids[order].tobytes(), _narrow(v[order])]],
                            columns=[*keys, f"{name}_ids", f"{name}_x"])
    schema = ", ".join([f"{k} int" for k in keys] + [f"{name}_ids binary", f"{name}_x binary"])
    return rows.groupBy(*keys).applyInPandas(one, schema)


def search(vectors: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
           scale: int = 1024, shard_rows: int = SHARD_ROWS, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``vectors`` where the
    column function ``is_query(id)`` holds, its ``k`` best other rows."""
    rows = integers(vectors, id_col, vector_col, scale)
    n, nq = rows.agg(F.count(F.lit(1)), F.count(F.when(is_query(F.col("id")), 1))).first()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-nq // query_block))
    deal = lambda m: F.pmod(F.xxhash64("id", "v"), F.lit(m)).cast("int")
    index = _packed(rows.select("id", "v", "d", deal(shards).alias("shard")), ["d", "shard"], "c")
    asked = _packed(rows.where(is_query(F.col("id"))).select("id", "v", "d", deal(blocks).alias("block")),
                    ["d", "block"], "q")
    # every part of the one meets every part of the other in a task, shard by shard
    index = index.repartition(min(shards, SHARD_PARTS)).hint("shuffle_replicate_nl")
    asked = asked.repartition(min(-(-blocks // PART_BLOCKS), BLOCK_PARTS)).hint("shuffle_replicate_nl")
    units = index.join(asked, "d")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        built, best = None, {}
        for b in batches:
            for u in b.itertuples():
                if built != (u.d, u.shard):
                    ids = np.frombuffer(u.c_ids, dtype=np.int64)
                    built, shard = (u.d, u.shard), Shard(ids, _wide(u.c_x, len(ids), u.d))
                qids = np.frombuffer(u.q_ids, dtype=np.int64)
                own = best.setdefault((u.d, u.block), [(qid, (), ()) for qid in qids.tolist()])
                for j, q in enumerate(_wide(u.q_x, len(qids), u.d)):
                    qid, ids, score = own[j]
                    more, more_score = shard.top(qid, q, k, score[-1] if len(score) == k else -np.inf)
                    if len(more):
                        ids, score = np.r_[np.int64(ids), more], np.r_[np.int64(score), more_score]
                        order = np.lexsort((ids, -score))[:k]
                        own[j] = qid, ids[order], score[order]
        for (d, block), own in best.items():
            size = [len(ids) for _, ids, _ in own]
            if sum(size):
                yield pd.DataFrame({
                    "d": d, "block": block, "no": np.repeat(np.arange(len(own)), size),
                    "query_id": np.repeat(np.array([qid for qid, _, _ in own], dtype=np.int64), size),
                    "vec_id": np.concatenate([ids for _, ids, _ in own if len(ids)]),
                    "score": np.concatenate([score for _, _, score in own if len(score)])})

    found = units.mapInPandas(run, "d int, block int, no int, query_id long, vec_id long, score long")
    order = Window.partitionBy("d", "block", "no").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op8_impact_topk(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return search(vectors, lambda c: c % 100 == 0)


ORACLE = """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
           FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
             CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
