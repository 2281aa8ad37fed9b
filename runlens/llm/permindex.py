"""Permutation index: approximate nearest neighbours by inner product.

A vector is represented by the order of its ``near`` nearest pivots.  The
index is an inverted file per pivot: which vectors have it among their
nearest, and at which place.  A search reads the lists of the query's own
nearest pivots and adds up, for every vector met there, how much closer the
two orders are than orders without a common pivot: with places clipped at
``near``, the footrule distance (sum over all pivots of the difference of
places) is near * (near + 1) less twice the sum of min(near - place in the
query, near - place in the vector) over the common pivots.  The vectors of
the smallest footrule are reranked by the inner product of the original
vectors, in double precision.

* Pivots come from a sample of at most ``SAMPLE`` rows (smallest hash of the
  row number), leaving out what is almost parallel to a pivot already taken,
  so a very common vector fills no pivots.
* Inner products of vectors of different length: every vector gets one more
  component that brings it to the greatest norm (a query gets 0), after which
  the nearest by angle is the largest inner product.
* Rows are dealt to blocks of about ``BLOCK`` by row number, whatever they
  hold; each block has its own lists and vectors.  Queries are packed in
  groups of about ``GROUP``; every group meets every block once (a stated
  query set against all rows, in blocks) and leaves ``k`` rows a query and
  block.  Nothing but pivots and counts reaches the driver.
* In each block a ``SHARE`` of the rows (``FLOOR`` at least) with the smallest
  footrule is reranked, ties at the limit included.  This is the index's
  accuracy setting; recall against brute force is measured in the tests.

Cases: vectors that are null, empty, zero, or hold null, NaN or infinite
components take no part, nor do those whose length is not the most frequent
one (of equally frequent ones the greatest); rows without an id are
candidates (after all others in ties), not queries; repeated rows are found
one by one, and a query leaves out its own row only; fewer than ``k``
candidates give fewer rows; no valid row gives no result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runlens.llm.store import saved

PIVOTS, NEAR = 256, 64
SAMPLE = 4096
PARALLEL = 0.9  # pivots have a smaller cosine than this, while others are left
SHARE, FLOOR = 0.2, 1000
BLOCK, GROUP = 16_384, 1024
LAST = (1 << 63) - 1  # stands for a null id


@dataclass
class Index:
    """``rows``: row, id, vector of all valid vectors; ``blocks``: one row
    per block with its row numbers, ids, vectors and lists."""
    rows: DataFrame
    blocks: DataFrame
    pivots: np.ndarray
    near: int
    n_blocks: int


def valid(vector: Column) -> Column:
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
                      & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column) -> np.ndarray:
    """The rows of a list column of one length, as they are."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def lifted(vectors: np.ndarray, norm: float) -> np.ndarray:
    """Unit vectors with one more component, from the greatest norm."""
    x = vectors.astype(np.float64) / norm
    return np.hstack([x, np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", x, x)))[:, None]])


def nearest(vectors: np.ndarray, pivots: np.ndarray, near: int) -> np.ndarray:
    """Numbers of the nearest pivots of each row, nearest first."""
    return np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")[:, :near].astype(np.uint16)


def choose(sample: np.ndarray, wanted: int) -> np.ndarray:
    """Up to ``wanted`` rows in their order: first those that are not almost
    parallel to one already taken, then others."""
    taken, left = [], []
    for i, v in enumerate(sample):
        if len(taken) == wanted:
            break
        close = len(taken) > 0 and (sample[taken] @ v).max() >= PARALLEL
        (left if close else taken).append(i)
    return sample[(taken + left)[:wanted]]


def build(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", pivots: int = PIVOTS, near: int = NEAR,
          block: int = BLOCK) -> Index | None:
    """Index of all valid vectors; None where there are none."""
    own = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector")).where(valid(F.col("vector")))
    kind = own.schema["vector"].dataType.elementType.simpleString()
    if kind not in ("float", "double"):
        own, kind = own.withColumn("vector", F.col("vector").cast("array<double>")), "double"
    sizes = own.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n"))
    common = sizes.agg(F.max_by("size", F.struct("n", "size")).alias("size")).first().size
    if common is None:
        return None
    rows = saved(saved(own.where(F.size("vector") == common)).withColumn("row", F.monotonically_increasing_id()))
    doubles = F.transform("vector", lambda x: x.cast("double"))
    square = F.aggregate(doubles, F.lit(0.0), lambda acc, x: acc + x * x)
    told = rows.agg(F.count("*").alias("n"), F.max(square).alias("square")).first()
    norm = math.sqrt(told.square)
    sample = [r.v for r in rows.select(doubles.alias("v"), F.xxhash64("row").alias("h"), "row").orderBy("h", "row").limit(SAMPLE).collect()]
    chosen = choose(lifted(np.array(sample), norm), pivots)
    near = min(near, len(chosen))
    n_blocks = max(1, math.ceil(told.n / block))

    def lists(key, table):
        """One block: rows sorted by number; for every pivot its members and
        their places, one list after another."""
        table = table.sort_by("row")
        given = matrix(table.column("vector"))
        perm = nearest(lifted(given, norm), chosen, near)
        flat = perm.ravel()
        order = np.argsort(flat, kind="stable")
        member, place = np.divmod(order, near)
        return pa.table({
            "block": [key[0].as_py()], "rows": [table.column("row").to_numpy().tobytes()],
            "ids": [table.column("id").fill_null(LAST).to_numpy().tobytes()], "vectors": [given.tobytes()],
            "cuts": [np.searchsorted(flat[order], np.arange(len(chosen) + 1)).astype(np.int64).tobytes()],
            "members": [member.astype(np.uint32).tobytes()], "places": [place.astype(np.uint16).tobytes()]},
            schema=pa.schema([("block", pa.int32())] + [(c, pa.binary()) for c in COLUMNS]))

    ddl = "block int, " + ", ".join(f"{c} binary" for c in COLUMNS)
    blocks = saved(rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(n_blocks)).cast("int"))
                   .groupBy("block").applyInArrow(lists, ddl))
    return Index(rows, blocks, chosen, near, n_blocks)


COLUMNS = ("rows", "ids", "vectors", "cuts", "members", "places")


def search(index: Index, wanted: Column, k: int = 20, share: float = SHARE, floor: int = FLOOR, group: int = GROUP) -> DataFrame:
    """query_id, rank, id, score: the ``k`` best found for every indexed row
    with an id for which ``wanted`` (over ``id``) holds."""
    pivots, near = index.pivots, index.near
    kind = index.rows.schema["vector"].dataType.elementType.simpleString()
    dtype = np.dtype(np.float32 if kind == "float" else np.float64)
    width = pivots.shape[1] - 1
    queries = index.rows.where(wanted & F.col("id").isNotNull())
    n_groups = max(1, math.ceil(queries.count() / group))

    def pack(key, table):
        return pa.table({"group": [key[0].as_py()], "query_rows": [table.column("row").to_numpy().tobytes()],
                         "query_ids": [table.column("id").to_numpy().tobytes()], "queries": [matrix(table.column("vector")).tobytes()]},
                        schema=pa.schema([("group", pa.int32()), ("query_rows", pa.binary()), ("query_ids", pa.binary()), ("queries", pa.binary())]))

    # the second hash: the first one deals rows to blocks
    packed = (queries.withColumn("group", F.pmod(F.xxhash64(F.lit("group"), "row"), F.lit(n_groups)).cast("int"))
              .groupBy("group").applyInArrow(pack, "group int, query_rows binary, query_ids binary, queries binary"))
    left = saved(packed).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(index.n_blocks - 1))))
    right = index.blocks.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))))

    def best(asked, held):
        out = []
        if asked.num_rows and held.num_rows:
            row, ids, flat, cuts, member, place = (np.frombuffer(held.column(c)[0].as_py(), t) for c, t in zip(
                COLUMNS, (np.int64, np.int64, dtype, np.int64, np.uint32, np.uint16)))
            vectors = flat.reshape(len(row), width)
            weight = (near - place).astype(np.int32)
            limit = min(len(row), max(floor, math.ceil(share * len(row))))
            query_rows, query_ids = (np.frombuffer(asked.column(c)[0].as_py(), np.int64) for c in ("query_rows", "query_ids"))
            given = np.frombuffer(asked.column("queries")[0].as_py(), dtype).reshape(len(query_rows), width).astype(np.float64)
            # a query has no further component; its norm changes no order
            perms = nearest(given, pivots[:, :width], near)
            for i, q in enumerate(given):
                common = np.zeros(len(row), np.int32)  # what the footrule is less, halved
                for at, p in enumerate(perms[i]):
                    part = slice(cuts[p], cuts[p + 1])
                    common[member[part]] += np.minimum(weight[part], near - at)
                common[row == query_rows[i]] = -1
                least = max(0, np.partition(common, len(row) - limit)[len(row) - limit])
                found = np.flatnonzero(common >= least)
                # one row after another: the same sum for equal vectors
                score = np.einsum("ij,j->i", vectors[found].astype(np.float64), q)
                top = np.lexsort((row[found], ids[found], -score))[:k]
                found, score = found[top], score[top]
                out.append((np.full(len(top), query_rows[i]), np.full(len(top), query_ids[i]), row[found], ids[found], score))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 4 + [np.zeros(0)]
        return pa.table(dict(zip(("query_row", "query_id", "row", "id", "score"), columns)))

    found = (left.groupBy("group", "block").cogroup(right.groupBy("group", "block"))
             .applyInArrow(best, "query_row long, query_id long, row long, id long, score double"))
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "id", "row")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.nullif("id", F.lit(LAST)).alias("id"), "score"))
