"""Exact top-k search by inner product: a Voronoi kNN join.

Vectors become integers, floor(scale * x), written as bytes of the narrowest kind that holds them all.
Pivots (a bounded sample of the vectors, by the order of a hash) divide the data into cells. Summaries
of the cells, their size and the greatest distance of a member from its pivot, bound every score from
above: for a query q and a vector x of the cell of pivot p, q.x <= q.p + |q| r. A first search of each
query against its best cells gives a lower bound of its k-th score; a cell is searched further only
for the queries whose upper bound reaches it, and only blocks of queries that have such a query
receive copies of its rows.

The unit of work is a block of queries against a lane. Cells follow each other on one line of places,
which is cut into lanes of equal length, and a row's place in its cell is drawn by lot, so a cell of a
third of all rows is in many lanes. A query goes once to each lane where it has cells, with the list of
these; a unit holds it against the members of its own cells, ``block_rows`` at a time, and returns at
most k rows for it. Batches are bounded by bytes, lanes and blocks by bytes and rows, so memory does
not grow with the input. Products are exact: by floating point where no sum can pass 2**24 (single)
or 2**53 (double), else by Python integers. There are as many pivots as the square root of the rows,
64 at least and 1,024 at most; they and their cells' summaries are all that reaches the driver.

Defined cases: vectors that are null, or hold a null or a non-finite component take no part, nor do
null ids; an empty vector scores 0 with all; vectors of unlike lengths, very long ones too, meet as if the shorter ended in zeros; components and
scores outside 64 bits stop at its ends; ties go to the smaller id; a repeated id is one more
candidate (and one more query under the same id, of which the results are merged); fewer candidates
than k give all of them; empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.shared import MIB, bounded_batches, materialize

LEAST_PIVOTS, MOST_PIVOTS, FIRST_CELLS, BLOCK_ROWS, LANE_ROWS, QUERY_ROWS = 64, 1024, 4, 1024, 262144, 65536
#: Bytes of vectors in a lane or block, and of what is routed at once; queries held against a cell at once;
#: lanes that a small input is cut into all the same, and units (so that all cores have work).
UNIT_BYTES, ROUTE_BYTES, TILE, LANES, UNITS = 16 * MIB, 8 * MIB, 2048, 6, 32
SINGLE, EXACT, LIMIT = 2.0**24, 2.0**53, 2**63 - 1
PAIRS = "query_id long, vec_id long, score long"


def matrix(rows: list) -> np.ndarray:
    """Rows side by side, shorter ones filled with zeros."""
    out = np.zeros((len(rows), max(map(len, rows), default=0)), np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def packed(lists: pa.Array, kind: str) -> pa.Array:
    """Lists of integers as bytes."""
    ends = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]].astype(kind)
    ends = (ends - ends[0]) * flat.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(ends), pa.py_buffer(flat)])


def unpacked(column, kind: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """(places, matrix) of vectors of like length, so that one long vector does not widen the others:
    where all are equally long, one pair; else one for each power of two."""
    column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) and column.num_chunks else column
    if not len(column):
        return []
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(column.buffers()[2] or b"", kind, count=ends[-1] // np.dtype(kind).itemsize)
    ends = ends // np.dtype(kind).itemsize
    sizes = np.diff(ends)
    if (sizes == sizes[0]).all():
        return [(np.arange(len(sizes)), flat[ends[0] : ends[-1]].reshape(len(sizes), sizes[0]))]
    out = []
    for power in np.unique(power_of := np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64)).tolist():
        at = np.flatnonzero(power_of == power)
        x = np.zeros((len(at), sizes[at].max()), kind)
        for i, place in enumerate(at.tolist()):
            x[i, : sizes[place]] = flat[ends[place] : ends[place + 1]]
        out.append((at, x))
    return out


def products(a: np.ndarray, b: np.ndarray, most: float) -> np.ndarray:
    """Exact inner products of all rows of a with all rows of b, of which no partial sum passes ``most``."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    if most < EXACT:
        kind = np.float32 if most < SINGLE else np.float64
        return a.astype(kind) @ b.astype(kind).T
    return np.clip(a.astype(object) @ b.astype(object).T, -LIMIT - 1, LIMIT).astype(np.int64) if width else np.zeros((len(a), len(b)), np.int64)


def largest(x: np.ndarray) -> float:
    return max(float(x.max(initial=0)), -float(x.min(initial=0)))


def best(row: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """The places of the k highest scores of each row, ties to the smaller id."""
    order = np.lexsort((ids, ~scores, row))
    row = row[order]
    head = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1]))) if len(row) else np.zeros(0, np.int64)
    return order[np.arange(len(row)) - np.repeat(head, np.diff(np.append(head, len(row)))) < k]


def reaching(query_ids: np.ndarray, ids: np.ndarray, scores: np.ndarray, low: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the scores that can be among the k highest of their row: those of ``low`` or
    more, and of rows with many of these the k best. ids: ascending. None is a query itself."""
    hit = scores >= low.astype(scores.dtype)[:, None]
    many = np.flatnonzero(np.count_nonzero(hit, axis=1) > 4 * k)
    if len(many):
        own = ids[None, :] == query_ids[many][:, None]
        part = np.where(own, -np.inf if scores.dtype.kind == "f" else -LIMIT - 1, scores[many])
        least = np.partition(part, part.shape[1] - k, axis=1)[:, [part.shape[1] - k]]
        above, level = (part > least) & ~own, (part == least) & ~own
        hit[many] &= above | (level & (np.cumsum(level, axis=1) <= k - np.count_nonzero(above, axis=1)[:, None]))
    row, column = np.nonzero(hit)
    other = ids[column] != query_ids[row]
    return row[other], column[other]


class Cells:
    """The pivots, with what the driver knows of their cells."""

    def __init__(self, pivots: np.ndarray):
        self.floats = pivots.astype(float)
        self.squares = (self.floats**2).sum(axis=1)
        self.norms = np.sqrt(self.squares)

    def inner(self, x: np.ndarray) -> np.ndarray:
        width = min(x.shape[1], self.floats.shape[1])
        return x[:, :width] @ self.floats[:, :width].T

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest pivot of each row, and the distance, rounded up."""
        x = x.astype(float)
        near = np.argmin(self.squares - 2 * self.inner(x), axis=1)
        width = min(x.shape[1], self.floats.shape[1])
        beyond = (x[:, width:] ** 2).sum(axis=1) + (self.floats[near, width:] ** 2).sum(axis=1)
        return near, np.sqrt(((x[:, :width] - self.floats[near, :width]) ** 2).sum(axis=1) + beyond) * (1 + 1e-9)

    def upper(self, q: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """No score of a query with a member of a cell is above this."""
        q = q.astype(float)
        norm = np.sqrt((q**2).sum(axis=1))[:, None]
        return self.inner(q) + norm * radius + norm * (radius + self.norms) * 1e-9 + 1


def in_parts(batches, column: str, kind: str, rows: int):
    """(batch, matrix) of at most ``rows`` rows with vectors of like length."""
    for batch in batches:
        for at, x in unpacked(batch.column(column), kind):
            for k in range(0, len(at), rows):
                yield batch.take(pa.array(at[k : k + rows])), x[k : k + rows]


def _assigning(cells: Cells, kind: str):
    def run(batches):
        lots = np.random.default_rng()
        coded = (pa.RecordBatch.from_arrays([b.column("id"), b.column("asks"), packed(b.column("v"), kind)], ["id", "asks", "x"]) for b in batches if b.num_rows)
        for batch, x in in_parts(coded, "x", kind, 1024):
            near, far = cells.assign(x)
            columns = {"id": batch.column("id"), "asks": batch.column("asks"), "x": batch.column("x").cast(pa.binary()), "cell": pa.array(near.astype(np.int32)), "far": pa.array(far), "lot": pa.array(lots.random(len(x)))}
            yield pa.RecordBatch.from_pydict(columns)

    return run


def _beginning(cells: Cells, radius: np.ndarray, sizes: np.ndarray, k: int, kind: str):
    """Each query's first cells: those of highest bound, ``FIRST_CELLS`` and what k members need."""

    def run(batches):
        for batch, x in in_parts(batches, "x", kind, 1024):
            order = np.argsort(np.where(sizes > 0, -cells.upper(x, radius), np.inf), axis=1, kind="stable")
            before = np.cumsum(sizes[order], axis=1) - sizes[order]
            first = ((np.arange(len(sizes)) < FIRST_CELLS) | (before <= k)) & (sizes[order] > 0)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(first.sum(axis=1))).astype(np.int32)), pa.array(order[first].astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "first"])

    return run


def _routing(cells: Cells, radius: np.ndarray, sizes: np.ndarray, span_cell: np.ndarray, span_lane: np.ndarray, kind: str, again: bool):
    """A row for each query and lane, with the query's cells there: its first ones, or ``again`` the
    others that its k-th score so far (``least``) does not rule out. A span is what a lane has of a cell."""
    heads = np.flatnonzero(np.concatenate(([True], span_lane[1:] != span_lane[:-1]))) if len(span_lane) else np.zeros(0, np.int64)

    def run(batches):
        for batch, x in in_parts(batches, "x", kind, 1024):
            if not len(heads):
                return
            step = max(1, ROUTE_BYTES // (len(heads) * (64 + x.shape[1] * x.itemsize) + 4 * len(span_cell)))
            for start in range(0, len(x), step):
                part, vectors = batch.slice(start, step), x[start : start + step]
                lists = part.column("first")
                first = np.zeros((len(vectors), len(sizes)), bool)
                first[np.repeat(np.arange(len(vectors)), lists.value_lengths().to_numpy()), lists.flatten().to_numpy()] = True
                if again:
                    first = ~first & (sizes > 0) & (cells.upper(vectors, radius) >= part.column("least").to_numpy()[:, None].astype(float))
                wanted = first[:, span_cell]
                counts = np.add.reduceat(wanted, heads, axis=1, dtype=np.int32)
                row, lane = np.nonzero(counts)
                if len(row):
                    here = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts[row, lane])).astype(np.int32)), pa.array(span_cell[np.nonzero(wanted)[1]].astype(np.int32)))
                    given = part.select(["id", "x", "home", "block", "least"]).take(pa.array(row))
                    yield pa.RecordBatch.from_arrays([*given.columns, pa.array(span_lane[heads][lane].astype(np.int32)), here], [*given.schema.names, "lane", "cells"])

    return run


def _needing(batches):
    """The blocks, lanes and cells of routes, each once a batch."""
    for batch in batches:
        lists = batch.column("cells")
        n = lists.value_lengths().to_numpy()
        rows = np.unique(np.stack((np.repeat(batch.column("block").to_numpy(), n), np.repeat(batch.column("lane").to_numpy(), n), lists.flatten().to_numpy())), axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(r) for r in rows], ["block", "lane", "cell"])


def _solving(k: int, kind: str, block_rows: int):
    def solve(queries: pa.Table, data: pa.Table) -> pa.Table:
        out = [(np.zeros(0, np.int64),) * 3]
        if queries.num_rows and data.num_rows:
            queries = queries.take(np.argsort(queries.column("home").to_numpy(), kind="stable"))
            data = data.take(np.lexsort((data.column("id").to_numpy(), data.column("cell").to_numpy())))
            out += list(found(queries, data))
        q, v, s = (np.concatenate(x) for x in zip(*out, strict=True))
        return pa.table({"query_id": q, "vec_id": v, "score": s})

    def found(queries: pa.Table, data: pa.Table):
        query_ids, least = (queries.column(c).to_numpy() for c in ("id", "least"))
        ids, cell = (data.column(c).to_numpy() for c in ("id", "cell"))
        parts = [(at, x, largest(x)) for at, x in unpacked(data.column("x"), kind)]
        lists = pa.concat_arrays(queries.column("cells").chunks)
        ends = np.append(0, np.cumsum(lists.value_lengths().to_numpy()))
        flat = lists.flatten().to_numpy()
        for places, vectors in unpacked(queries.column("x"), kind):
            for start in range(0, len(places), TILE):
                at, tile = places[start : start + TILE], vectors[start : start + TILE]
                low, high = least[at].copy(), largest(tile)
                own = np.concatenate([flat[ends[i] : ends[i + 1]] for i in at.tolist()])
                owner = np.repeat(np.arange(len(at)), ends[at + 1] - ends[at])
                order = np.argsort(own, kind="stable")
                own, owner = own[order], owner[order]
                held = [(np.zeros(0, np.int64),) * 3]
                for place, x, most in parts:
                    heads = np.flatnonzero(np.concatenate(([True], cell[place][1:] != cell[place][:-1], [True])))
                    for a, b in zip(heads[:-1].tolist(), heads[1:].tolist(), strict=True):
                        asking = owner[slice(*np.searchsorted(own, [cell[place[a]], cell[place[a]] + 1]))]
                        for c in range(a, b, block_rows) if len(asking) else ():
                            part = slice(c, min(b, c + block_rows))
                            scores = products(tile[asking], x[part], high * most * min(tile.shape[1], x.shape[1]))
                            row, column = reaching(query_ids[at[asking]], ids[place[part]], scores, low[asking], k)
                            held.append((asking[row], ids[place[part]][column], scores[row, column].astype(np.int64)))
                            if sum(len(h[0]) for h in held) > 64 * k * len(at):
                                held = [kept(held)]
                                full = np.flatnonzero(np.bincount(held[0][0], minlength=len(at)) >= k)
                                last = np.searchsorted(held[0][0], full, "right") - 1
                                low[full] = np.maximum(low[full], held[0][2][last])
                row, v, s = kept(held)
                yield query_ids[at[row]], v, s

    def kept(held):
        row, v, s = (np.concatenate(x) for x in zip(*held, strict=True))
        chosen = best(row, v, s, k)
        return row[chosen], v[chosen], s[chosen]

    return solve


def top(pairs: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k)


def knn_join(data: DataFrame, queries: Column, k: int = 20, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding", pivots: int | None = None, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS, lane_rows: int = LANE_ROWS) -> DataFrame:
    """The k highest scores of each row of ``data`` that ``queries`` (a condition) marks, among all
    other rows: query_id, rank, vec_id, score."""
    bounded_batches(data.sparkSession, 1024)
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(vector, lambda x: F.least(F.greatest(F.floor(F.least(F.greatest(x * scale, F.lit(-9e18)), F.lit(9e18))), F.lit(-(2**62))), F.lit(2**62)).cast("long"))
    rows = data.where(F.col(f"`{id_col}`").isNotNull() & fine).select(F.col(f"`{id_col}`").cast("long").alias("id"), whole.alias("v"), F.coalesce(queries, F.lit(False)).alias("asks"))
    total, asking, most, mean = rows.agg(F.count("*"), F.count_if("asks"), F.max(F.greatest(F.array_max("v"), -F.array_min("v"))), F.avg(F.size("v"))).first()
    kind = next(t for t in ("<i1", "<i2", "<i4", "<i8") if (most or 0) <= np.iinfo(t).max)
    fitting = max(1, int(UNIT_BYTES / (((mean or 0) + 1) * np.dtype(kind).itemsize)))
    lanes = max(-(-total // min(lane_rows, fitting)), min(LANES, -(-total // 1024)), 1)
    blocks = max(-(-asking // min(query_rows, fitting)), min(-(-UNITS // lanes), -(-asking // 64)), 1)
    pivots = pivots or int(min(max(total**0.5, LEAST_PIVOTS), MOST_PIVOTS))
    sample = rows.select("id", "v").orderBy(F.xxhash64("id"), "id").limit(pivots).collect()
    cells = Cells(matrix([r[1] for r in sample] or [[0]]))
    placed = materialize(rows.mapInArrow(_assigning(cells, kind), "id long, asks boolean, x binary, cell int, far double, lot double"), "cells")
    radius, sizes = np.zeros(len(cells.floats)), np.zeros(len(cells.floats), np.int64)
    for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("far")).collect():  # at most ``pivots`` rows
        radius[r["cell"]], sizes[r["cell"]] = r["far"], r["n"]
    length = -(-total // lanes) or 1
    begins = np.cumsum(sizes) - sizes
    spans = [(lane, c) for c in np.flatnonzero(sizes).tolist() for lane in range(int(begins[c]) // length, int(begins[c] + sizes[c] - 1) // length + 1)]
    span_lane, span_cell = np.array(spans, np.int64).reshape(-1, 2).T
    of_cell = lambda x: F.element_at(F.array(*[F.lit(int(i)).cast("long") for i in x]), F.col("cell") + 1)
    place = of_cell(begins) + F.least(F.floor(F.col("lot") * of_cell(sizes)), of_cell(sizes) - 1)
    laned = placed.select("id", "x", "cell", F.floor(place / length).cast("int").alias("lane"))
    asked = placed.where("asks").select("id", "x", F.col("cell").alias("home"), F.floor(F.col("lot") * 1e6 % blocks).cast("int").alias("block"))
    asked = materialize(asked.mapInArrow(_beginning(cells, radius, sizes, k, kind), "id long, x binary, home int, block int, first array<int>"), "asked")
    n, keys = 2 * blocks * lanes if blocks * lanes < 1000 else blocks * lanes, ["block", "lane"]

    def search(known: DataFrame, again: bool) -> DataFrame:
        routed = known.mapInArrow(_routing(cells, radius, sizes, span_cell, span_lane, kind, again), "id long, x binary, home int, block int, least long, lane int, cells array<int>")
        wanted = materialize(routed, "routes")
        needs = materialize(wanted.select("block", "lane", "cells").mapInArrow(_needing, "block int, lane int, cell int").distinct(), "needs")
        copies = laned.join(needs, ["lane", "cell"]).select("block", "lane", "cell", "id", "x")
        return wanted.repartition(n, *keys).groupBy(*keys).cogroup(copies.repartition(n, *keys).groupBy(*keys)).applyInArrow(_solving(k, kind, block_rows), PAIRS)

    none = F.lit(-LIMIT - 1).cast("long")
    begun = materialize(top(search(asked.withColumn("least", none), False), k).drop("rank"), "begun")
    least = begun.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") >= k).select("query_id", "least")
    known = asked.join(least, asked["id"] == least["query_id"], "left").select("id", "x", "home", "block", "first", F.coalesce("least", none).alias("least"))
    return top(begun.unionByName(search(known, True)), k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op3_knn_join(spark, sf_dir: str) -> DataFrame:
    """The 20 best partners of every twentieth vector of ``embeddings``."""
    return knn_join(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)


OP3_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, d.vec_id AS vec_id,
    CAST(coalesce(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * d.v[i])), 0) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id % 20 = 0 AND d.vec_id <> q.vec_id
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""
