"""Nearest neighbours by a block matrix join.

Vectors are quantised to int8. For each block of queries and block of
candidates, tiles of integer products give all inner products with a bound on
the quantisation error; pairs whose upper bound reaches the k-th best lower
bound are recomputed in double precision from the original vectors and kept in
a heap for each query. Heaps of the blocks are merged by heaps. The bounds are
strict, so the result is the exact one.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmix.llm.common import pick, stored

#: Each candidate is sent to every block of queries, so few and large ones make few copies of the table.
QUERY_BLOCK = 16_384
CANDIDATE_BLOCK = 4096
#: Rows and columns of one tile of products, a bound of memory.
TILE = 1024
#: Tasks that the cells are dealt to at most.
CELL_TASKS = 100_000
#: Block results that one merge takes together.
FAN_IN = 32
#: Queries that one merge takes together, as many or about that; a query has up to FAN_IN * k rows.
MERGED_QUERIES = 256
FOUND = "query_id long, vec_id long, score double"


class Quantised:
    """int8 codes of the rows, their scales, and norms for the error bound."""

    def __init__(self, rows: np.ndarray):
        exact = rows.astype(np.float64)
        self.scale = np.abs(exact).max(axis=1) / 127
        self.codes = np.rint(exact / self.scale[:, None]).astype(np.int8)
        near = self.codes * self.scale[:, None]
        self.norm = np.linalg.norm(exact, axis=1)
        self.near_norm = np.linalg.norm(near, axis=1)
        self.error = np.linalg.norm(exact - near, axis=1)


def product_bounds(a: Quantised, b: Quantised, some: slice) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all inner products of a's rows with ``some`` of b's.

    a.b - a'.b' = a.(b - b') + (a - a').b', so it is at most |a||b - b'| + |a - a'||b'|.
    Integer products of int8 are exact in single precision up to 1,000 components.
    """
    kind = np.float32 if a.codes.shape[1] <= 1000 else np.float64
    tile = a.codes.astype(kind) @ b.codes[some].astype(kind).T
    middle = tile * a.scale[:, None] * b.scale[some]
    slack = np.outer(a.norm, b.error[some]) + np.outer(a.error, b.near_norm[some])
    slack = slack + 1e-9 * (np.abs(middle) + np.outer(a.norm, b.norm[some]))  # rounding of the sums themselves
    return middle - slack, middle + slack


def first_of_equal(ids: np.ndarray, rows: np.ndarray, most: int) -> np.ndarray:
    """Places, by id, without rows that ``most`` equal ones with smaller ids precede: those are in no result."""
    order = np.argsort(ids, kind="stable")
    flat = np.ascontiguousarray(rows[order])
    _, group = np.unique(flat.view(np.dtype((np.void, flat.dtype.itemsize * flat.shape[1]))).ravel(), return_inverse=True)
    by_group = np.argsort(group, kind="stable")
    starts = np.flatnonzero(np.diff(group[by_group], prepend=-1))
    nth = np.arange(len(group)) - np.repeat(starts, np.diff(np.append(starts, len(group))))
    return order[np.sort(by_group[nth < most])]


def search_block(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> list[list]:
    """For each query a heap of (score, -vec_id), its k best in this block; a vec_id of several vectors has its best one."""
    keep = first_of_equal(ids, rows, k + 1)
    ids, rows = ids[keep], rows[keep]  # in order of ids
    out: list[list] = []
    with np.errstate(all="ignore"):  # products beyond the largest double are infinite, and stay so
        b = Quantised(rows)
        for at in range(0, len(queries), TILE):
            out += search_tiles(query_ids[at:at + TILE], queries[at:at + TILE], ids, rows, b, k)
    return out


def search_tiles(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, b: Quantised, k: int) -> list[list]:
    """The heaps of the queries of one tile; ``rows`` are in order of ``ids`` and ``b`` are their codes."""
    best: list[list] = [[] for _ in query_ids]
    repeated = bool((ids[1:] == ids[:-1]).any())
    a = Quantised(queries)
    floor = np.full(len(queries), -np.inf)
    for at in range(0, len(rows), TILE):
        some = slice(at, at + TILE)
        low, high = product_bounds(a, b, some)
        own = query_ids[:, None] == ids[some]
        low[own] = -np.inf
        low, high = np.nan_to_num(low, nan=-np.inf), np.nan_to_num(high, nan=np.inf)
        each = np.maximum.reduceat(low, np.unique(ids[some], return_index=True)[1], axis=1) if repeated else low
        if each.shape[1] >= k:
            floor = np.maximum(floor, np.partition(each, -k, axis=1)[:, -k])
        q, c = np.nonzero((high >= floor[:, None]) & ~own)
        for first in range(0, len(q), 1 << 14):
            qs, cs = q[first:first + (1 << 14)], c[first:first + (1 << 14)] + at
            scores = (queries[qs].astype(np.float64) * rows[cs].astype(np.float64)).sum(axis=1)
            for i, score, vec in zip(qs.tolist(), scores.tolist(), ids[cs].tolist()):
                heap, entry = best[i], (score, -vec)
                if repeated and (held := [n for n, e in enumerate(heap) if e[1] == -vec]):
                    if entry > heap[held[0]]:
                        heap[held[0]] = entry
                        heapq.heapify(heap)
                elif len(heap) < k:
                    heapq.heappush(heap, entry)
                elif entry > heap[0]:
                    heapq.heapreplace(heap, entry)
        floor = np.maximum(floor, [h[0][0] if len(h) == k else -np.inf for h in best])
    return best


def _found(query_ids: list, heaps: list[list]) -> pa.Table:
    flat = [(q, -v, s) for q, heap in zip(query_ids, heaps) for s, v in heap]
    columns = list(zip(*flat)) or [(), (), ()]
    return pa.table([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64())],
                    names=["query_id", "vec_id", "score"])


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, embedding, dim), without rows that take no part: a null id, a vector that is null,
    empty, zero or holds a null or non-finite component. Equal rows are one."""
    source = pick(vectors, id_col, vector_col).select(F.col(id_col).cast("long").alias("vec_id"),
                                                      F.col(vector_col).alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    zero = F.forall("embedding", lambda x: x == 0)
    return source.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(finite & ~zero).dropDuplicates(
        ["vec_id", "embedding"]).withColumn("dim", F.size("embedding"))


def search(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of largest inner product for each query row.

    ``is_query`` is a condition on vec_id. A query's own vec_id is no candidate.
    Vectors of different lengths are not compared. Ties go to the smaller
    vec_id. A query id that occurs with several vectors has their union as its candidates' scores.
    """
    held = stored(usable(vectors, id_col, vector_col), "vectors")
    sizes = held.groupBy("dim").agg(F.count("*").alias("n"), F.sum(F.when(is_query, 1).otherwise(0)).alias("m"))
    blocks = sizes.select("dim", F.ceil(F.col("n") / CANDIDATE_BLOCK).alias("blocks"),
                          F.ceil(F.col("m") / QUERY_BLOCK).alias("query_blocks")).where("query_blocks > 0")
    parted = held.join(blocks, "dim")  # a row for each vector length; the planner sizes it

    def dealt(rows: DataFrame, own: str, salt: int, other: str, name: str, other_name: str, query: bool) -> DataFrame:
        return rows.select(
            "vec_id", "embedding", "dim", F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.col(own)).cast("int").alias(name),
            F.explode(F.sequence(F.lit(0), F.col(other).cast("int") - 1)).alias(other_name), F.lit(query).alias("query"))

    candidates = dealt(parted, "blocks", 1, "query_blocks", "block", "query_block", False)
    queries = dealt(parted.where(is_query), "query_blocks", 2, "blocks", "query_block", "block", True)
    cells = candidates.unionByName(queries)

    def one(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        asks = np.asarray(table["query"])
        ids, dim = np.asarray(table["vec_id"]), table["dim"][0].as_py()
        vectors = table["embedding"].combine_chunks()
        rows = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(ids), dim)
        heaps = search_block(ids[asks], rows[asks], ids[~asks], rows[~asks], k)
        group = pa.scalar(table["block"][0].as_py(), pa.int32())
        out = _found(ids[asks].tolist(), heaps)
        return out.append_column("block", pa.array([group.as_py()] * len(out), pa.int32()))

    most, asked, tasks = sizes.agg(F.max(F.ceil(F.col("n") / CANDIDATE_BLOCK)), F.sum("m"), F.sum(
        F.ceil(F.col("n") / CANDIDATE_BLOCK) * F.ceil(F.col("m") / QUERY_BLOCK))).first()
    most, asked = most or 1, asked or 0
    # A task for each cell or so: cells are small in bytes and long in work, so their tasks must not be merged by size.
    cells = cells.repartition(min(max(int(tasks or 1), 1), CELL_TASKS), "dim", "query_block", "block")
    found = cells.groupBy("dim", "query_block", "block").applyInArrow(one, FOUND + ", block int")
    parts = 1
    while parts < most:
        parts *= FAN_IN
        found = merged(found, k, merge_parts(asked, parts >= most))
    if most == 1:
        found = merged(found, k, merge_parts(asked, True))
    return found.select("query_id", "rank", "vec_id", "score")


def merge_parts(queries: int, last: bool) -> int:
    """Groups that a merge deals the queries to: enough that a group's rows fit in memory, and for parallel work."""
    return max(64 if last else 1024, -(-queries // MERGED_QUERIES))


def merged(found: DataFrame, k: int, parts: int) -> DataFrame:
    """The k best of each query among ``FAN_IN`` blocks, by heaps."""
    def merge(table: pa.Table) -> pa.Table:
        heaps: dict[int, dict] = {}
        for q, v, s in zip(*[table[c].to_pylist() for c in ("query_id", "vec_id", "score")]):
            own = heaps.setdefault(q, {})
            own[v] = max(s, own.get(v, s))
        out = [(q, r, v, s) for q, own in heaps.items()
               for r, (v, s) in enumerate(heapq.nsmallest(k, own.items(), key=lambda e: (-e[1], e[0])), 1)]
        columns = list(zip(*out)) or [(), (), (), ()]
        block = table["block"][0].as_py()
        return pa.table([*[pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.float64()))],
                         pa.array([block] * len(out), pa.int32())], names=["query_id", "rank", "vec_id", "score", "block"])

    some = F.pmod(F.xxhash64("query_id"), F.lit(parts))
    up = found.select("query_id", "vec_id", "score", F.floor(F.col("block") / FAN_IN).cast("int").alias("block"))
    return up.withColumn("part", some).groupBy("part", "block").applyInArrow(
        merge, "query_id long, rank int, vec_id long, score double, block int")


def recall(found: DataFrame, exact: DataFrame) -> float:
    """Share of ``exact``'s (query_id, vec_id) that ``found`` has."""
    both = exact.select("query_id", "vec_id").join(found.select("query_id", "vec_id"), ["query_id", "vec_id"], "left_semi")
    return both.count() / max(1, exact.count())
