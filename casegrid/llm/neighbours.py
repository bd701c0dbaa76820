"""Approximate nearest neighbours: a graph by NN-descent, queries by greedy search on it.

Building: vectors are compared exactly within blocks of their order along some random directions; then each
round joins every node with its neighbours (and some of the nodes that have it as neighbour), compares
these neighbours with each other, and gives every one of them its best new acquaintances. Only neighbours
that are new since the last round start comparisons. Blocks and lists have fixed sizes, so a round's work
grows with the number of vectors.

Searching: every query begins at itself, a node of the graph, and at the best of some sampled rows, so that a group
without links from outside is reached by its own queries. It keeps its best nodes so far, opens the best unopened ones, and scores their neighbours
on the original vectors in double precision, until none is left to open. Each round is a join of opened nodes
with the graph and of the neighbours found with blocks of vectors.

The measure is the inner product. For building, vectors are taken to have one more component that makes them equally long,
so that near means large inner product whatever their lengths. That component is never added: nearness is computed from
differences (half the squared distance, negated), so vectors that are short beside the longest keep their precision.
Vectors have single precision there. Searches begin at the longest vectors too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casegrid.llm.vectors import usual_length
from casegrid.operators.rows import quoted
from casegrid.operators.storage import stored

#: Neighbours kept per node; directions and block size of the start; rounds; new acquaintances per comparison.
NEIGHBOURS, DIRECTIONS, BLOCK, START, ROUNDS, BEST = 32, 8, 1024, 16, 3, 5
#: Nodes that have a node as neighbour: so many take part in its comparisons, so many are its neighbours in a search.
BACK, BACK_IN_SEARCH = 16, 32
#: Of the search: nodes kept, nodes opened in a round, starting points besides the query itself (and of how many sampled and how many of the longest rows), vectors in a block.
KEPT, OPENED, STARTS, SAMPLE, SEARCH_BLOCK = 400, 100, 32, 1024, 4096

_LISTS = "node long, ids array<long>, scores array<float>"


def usable_vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(node, vec array<double>): one row per id, without NULL ids and without vectors that are NULL, zero, non-finite or of
    another length than most."""
    vec = F.col(quoted(vector_col)).cast("array<double>")
    rows = table.select(F.col(quoted(id_col)).cast("long").alias("node"), vec.alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("node").isNotNull() & F.col("vec").isNotNull() & F.coalesce(finite, F.lit(False)))
    length = usual_length(table, vector_col)
    rows = rows.filter(F.size("vec") == F.lit(length if length is not None else -1))
    return rows.filter(F.exists("vec", lambda x: x != 0)).groupBy("node").agg(F.min("vec").alias("vec"))


def _matrix(column: pa.Array, kind: str = "f8") -> np.ndarray:
    """A list column of equally long rows as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def _lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    values = np.concatenate(rows) if rows else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _codes(vectors: DataFrame, longest: float) -> DataFrame:
    """(node, code): vectors in single precision, the longest of length 1."""

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = (_matrix(batch.column(1)) / longest).astype(np.float32)
            arrays = [batch.column(0), pa.array([c.tobytes() for c in x], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["node", "code"])

    return vectors.select("node", "vec").mapInArrow(coded, "node long, code binary")


def _decoded(codes: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(codes), np.float32).reshape(len(codes), -1)


def _nearness(x: np.ndarray) -> np.ndarray:
    """Minus half the squared distance of all pairs, with the component that makes all equally long: the inner product less 1."""
    x = x.astype(np.float64)
    square = (x * x).sum(axis=1)
    added = np.sqrt(np.maximum(0, 1 - square))
    apart = square[:, None] - square[None, :]
    beside = apart / np.maximum(added[:, None] + added[None, :], np.sqrt(np.abs(apart)) + 1e-300)
    return np.minimum(0, x @ x.T - (square[:, None] + square[None, :] + beside * beside) / 2).astype(np.float32)


def _start(codes: DataFrame, seed: int = 7) -> DataFrame:
    """Lists from exact comparison within blocks along random directions."""

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _decoded(batch.column(1).to_pylist())
            directions = np.random.default_rng(seed).standard_normal((x.shape[1], DIRECTIONS)).astype(np.float32)
            along = x @ directions
            for t in range(DIRECTIONS):
                arrays = [pa.array(np.full(len(x), t, np.int32)), pa.array(along[:, t]), *batch.columns]
                yield pa.RecordBatch.from_arrays(arrays, names=["t", "along", "node", "code"])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if held and (len(held) == BLOCK or held[-1][0] != row[0]):
                    yield _block(held)
                    held = []
                held.append(row)
        if held:
            yield _block(held)

    parts = int(codes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = codes.mapInArrow(projected, "t int, along float, node long, code binary")
    rows = rows.repartitionByRange(parts, "t", "along", "node").sortWithinPartitions("t", "along", "node")
    return rows.mapInArrow(compared, _LISTS)


def _block(rows: list[tuple]) -> pa.RecordBatch:
    nodes = np.array([row[2] for row in rows], np.int64)
    x = _decoded([row[3] for row in rows])
    near = _nearness(x)
    np.fill_diagonal(near, -np.inf)
    most = min(START, len(nodes) - 1)
    best = np.argpartition(-near, most - 1, axis=1)[:, :most] if most else np.empty((len(nodes), 0), np.int64)
    ids, scores = nodes[best], np.take_along_axis(near, best, axis=1)
    arrays = [pa.array(nodes), _lists(list(ids), pa.int64()), _lists(list(scores), pa.float32())]
    return pa.RecordBatch.from_arrays(arrays, names=["node", "ids", "scores"])


def _best_lists(entries: DataFrame, before: DataFrame | None) -> DataFrame:
    """(node, ids, scores, fresh) from (node, id, score) rows: the NEIGHBOURS best; fresh ones were not in ``before``."""
    rows = entries.groupBy("node", "id").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("score"), "id"))
    rows = rows.withColumn("place", place).filter(F.col("place") <= NEIGHBOURS)
    lists = rows.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("place", "id", "score"))).alias("e"))
    lists = lists.select("node", F.col("e.id").alias("ids"), F.col("e.score").alias("scores"))
    if before is None:
        return lists.withColumn("fresh", F.transform("ids", lambda _: F.lit(True)))
    old = before.select("node", F.col("ids").alias("old"))
    return lists.join(old, "node", "left").select(
        "node", "ids", "scores", F.transform("ids", lambda i: ~F.array_contains(F.coalesce("old", F.array().cast("array<long>")), i)).alias("fresh")
    )


def _entries(lists: DataFrame) -> DataFrame:
    return lists.select("node", F.explode(F.arrays_zip("ids", "scores")).alias("e")).select(
        "node", F.col("e.ids").alias("id"), F.col("e.scores").alias("score")
    )


def _acquainted(graph: DataFrame, codes: DataFrame, seed: int) -> DataFrame:
    """(node, id, score): what comparing each node's neighbours with each other brings them."""
    edges = graph.select("node", F.explode(F.arrays_zip("ids", "fresh")).alias("e"))
    ahead = edges.select(F.col("node").alias("at"), F.col("e.ids").alias("to"), F.col("e.fresh").alias("fresh"))
    back = ahead.select(F.col("to").alias("at"), F.col("at").alias("to"), "fresh")
    place = F.row_number().over(Window.partitionBy("at").orderBy(F.xxhash64("at", "to", F.lit(seed)), "to"))
    back = back.withColumn("place", place).filter(F.col("place") <= BACK).drop("place")
    worst = F.when(F.size("scores") >= NEIGHBOURS, F.array_min("scores")).otherwise(F.lit(-2.0)).cast("float")
    known = codes.join(graph.select("node", worst.alias("worst")), "node").withColumnRenamed("node", "to")
    met = ahead.union(back).join(known, "to").groupBy("at").agg(
        F.collect_list(F.struct("to", "fresh", "code", "worst")).alias("met")
    )

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[list[np.ndarray]] = [[], [], []]
            lists = batch.column(0)
            for k in range(len(lists)):
                entry = lists[k].values
                to, fresh, worst = (entry.field(f).to_numpy(zero_copy_only=False) for f in ("to", "fresh", "worst"))
                if len(to) < 2:
                    continue
                x = _decoded(entry.field("code").to_pylist())
                near = _nearness(x)
                near[~(fresh[:, None] | fresh[None, :]) | (to[:, None] == to[None, :]) | (near <= worst[:, None])] = -np.inf
                most = min(BEST, len(to) - 1)
                best = np.argpartition(-near, most - 1, axis=1)[:, :most]
                score = np.take_along_axis(near, best, axis=1)
                good = np.isfinite(score)
                for column, values in zip(found, (np.repeat(to, most).reshape(-1, most), to[best], score)):
                    column.append(values[good])
            if found[0]:
                arrays = [pa.array(np.concatenate(column)) for column in found]
                yield pa.RecordBatch.from_arrays(arrays, names=["node", "id", "score"])

    return met.select("met").mapInArrow(compared, "node long, id long, score float")


def build_graph(vectors: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(node, near): stored adjacency of `usable_vectors`; every row is in it."""
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x))
    longest = vectors.agg(F.max(norm).alias("longest")).first()["longest"] or 1.0
    codes = stored(_codes(vectors, longest))
    graph = stored(_best_lists(_entries(_start(codes)), None))
    for seed in range(rounds):
        entries = _entries(graph).unionByName(_acquainted(graph, codes, seed))
        graph = stored(_best_lists(entries, graph))
    ahead = _entries(graph)
    place = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("score"), "node"))
    back = ahead.withColumn("place", place).filter(F.col("place") <= BACK_IN_SEARCH)
    both = ahead.select("node", "id").union(back.select(F.col("id").alias("node"), F.col("node").alias("id")))
    return stored(both.groupBy("node").agg(F.collect_set("id").alias("near")))


_STATE = "q long, vec array<double>, ids array<long>, scores array<double>, opened array<boolean>, next array<long>"


def _next_state(q: list, vec: pa.Array, states: list[tuple[np.ndarray, np.ndarray, np.ndarray]], kept: int, begins: bool = False) -> pa.RecordBatch:
    ids, scores, opened, following = [], [], [], []
    for key, (i, s, o) in zip(q, states):
        order = np.lexsort((i, -s))[:kept]
        i, s, o = i[order], s[order], o[order]
        new = np.flatnonzero(~o)[:OPENED]
        o[new] = True
        for column, values in zip((ids, scores, opened, following), (i, s, o, np.append(i[new], key) if begins else i[new])):
            column.append(values)
    arrays = [pa.array(q, pa.int64()), vec, _lists(ids, pa.int64()), _lists(scores, pa.float64()), _lists(opened, pa.bool_()), _lists(following, pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, names=["q", "vec", "ids", "scores", "opened", "next"])


def _begun(queries: DataFrame, vectors: DataFrame, kept: int) -> DataFrame:
    square = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)
    any_of = vectors.orderBy(F.xxhash64("node"), "node").limit(SAMPLE).select("node", "vec")
    longest = vectors.orderBy(square.desc(), "node").limit(SAMPLE).select("node", "vec")
    sample = any_of.union(longest).dropDuplicates(["node"]).orderBy("node").toArrow()  # so many vectors, whatever the table
    nodes = sample.column("node").to_numpy()
    points = _matrix(sample.column("vec").combine_chunks()) if len(nodes) else np.empty((0, 0))
    shared = queries.sparkSession.sparkContext.broadcast((nodes, points))

    def begun(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, points = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            q, scores = batch.column(0).to_pylist(), _matrix(batch.column(1)) @ points.T
            states = []
            for key, row in zip(q, scores):
                best = np.argsort(-row, kind="stable")[: STARTS + 1]
                best = best[nodes[best] != key]
                states.append((nodes[best], row[best], np.zeros(len(best), bool)))
            yield _next_state(q, batch.column(1), states, kept, begins=True)

    return queries.select("node", "vec").mapInArrow(begun, _STATE)


def _asked(state: DataFrame, graph: DataFrame, blocks: int) -> DataFrame:
    """(block, q, vec, least, nodes): the neighbours of opened nodes that a query has not among its best."""
    opened = state.select("q", F.explode("next").alias("node")).join(graph, "node")
    near = opened.groupBy("q").agg(F.collect_list("near").alias("near"))  # at most OPENED lists
    rows = state.join(near, "q").select("q", "vec", "ids", "scores", "near")
    kept = KEPT

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for k in range(batch.num_rows):
                q, vec = batch.column(0)[k].as_py(), batch.column(1)[k].values.to_numpy()
                ids, scores = (batch.column(c)[k].values.to_numpy() for c in (2, 3))
                near = np.setdiff1d(batch.column(4)[k].values.flatten().to_numpy(), np.append(ids, q))
                least = scores.min() if len(scores) >= kept else -np.inf
                place = near % blocks
                for block in np.unique(place).tolist():
                    for column, value in zip(out, (block, q, vec, least, near[place == block])):
                        column.append(value)
            if out[0]:
                arrays = [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), _lists(out[2], pa.float64()), pa.array(out[3], pa.float64()), _lists(out[4], pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, names=["block", "q", "vec", "least", "nodes"])

    return rows.mapInArrow(packed, "block long, q long, vec array<double>, least double, nodes array<long>")


def _scored(asked: DataFrame, placed: DataFrame) -> DataFrame:
    """(q, ids, scores) of asked nodes above the query's least; a block's vectors come before its questions."""
    rows = placed.unionByName(asked.withColumn("kind", F.lit(1)))
    rows = rows.repartition("block").sortWithinPartitions("block", "kind", "q").select("block", "kind", "q", "vec", "least", "nodes")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, nodes, vectors, points, order = None, [], [], None, None
        for batch in batches:
            kinds, blocks = batch.column(1).to_numpy(), batch.column(0).to_numpy()
            q_out, ids_out, scores_out = [], [], []
            for k in range(batch.num_rows):
                if blocks[k] != block:
                    block, nodes, vectors, points = blocks[k], [], [], None
                vec = batch.column(3)[k].values.to_numpy()
                if kinds[k] == 0:
                    nodes.append(batch.column(2)[k].as_py())
                    vectors.append(vec)
                    continue
                if points is None:
                    order = np.argsort(nodes)
                    points, sorted_nodes = np.array(vectors)[order], np.array(nodes)[order]
                ids = batch.column(5)[k].values.to_numpy()
                scores = (points[np.searchsorted(sorted_nodes, ids)] * vec).sum(axis=1)
                good = scores >= batch.column(4)[k].as_py()
                if good.any():
                    q_out.append(batch.column(2)[k].as_py())
                    ids_out.append(ids[good])
                    scores_out.append(scores[good])
            if q_out:
                arrays = [pa.array(q_out, pa.int64()), _lists(ids_out, pa.int64()), _lists(scores_out, pa.float64())]
                yield pa.RecordBatch.from_arrays(arrays, names=["q", "ids", "scores"])

    return rows.mapInArrow(scored, "q long, ids array<long>, scores array<double>")


def _merged(state: DataFrame, scored: DataFrame, kept: int) -> DataFrame:
    new = scored.groupBy("q").agg(F.flatten(F.collect_list("ids")).alias("more"), F.flatten(F.collect_list("scores")).alias("of_more"))
    rows = state.drop("next").join(new, "q", "left")

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            states = []
            for k in range(batch.num_rows):
                ids, scores, opened = (batch.column(c)[k].values.to_numpy(zero_copy_only=False) for c in (2, 3, 4))
                if batch.column(5)[k].is_valid:
                    more, of_more = (batch.column(c)[k].values.to_numpy() for c in (5, 6))
                    ids, scores = np.append(ids, more), np.append(scores, of_more)
                    opened = np.append(opened, np.zeros(len(more), bool))
                states.append((ids, scores, opened.copy()))
            yield _next_state(batch.column(0).to_pylist(), batch.column(1), states, kept)

    return rows.select("q", "vec", "ids", "scores", "opened", "more", "of_more").mapInArrow(merged, _STATE)


def search_graph(queries: DataFrame, vectors: DataFrame, graph: DataFrame, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): for each (node, vec) of ``queries`` the ``k`` best found, not itself."""
    blocks = max(1, -(-vectors.count() // SEARCH_BLOCK))
    place = F.pmod(F.col("node"), F.lit(blocks))
    placed = stored(
        vectors.select(
            place.alias("block"), F.lit(0).alias("kind"), F.col("node").alias("q"), "vec",
            F.lit(0.0).alias("least"), F.array().cast("array<long>").alias("nodes"),
        )
    )
    state = stored(_begun(queries, vectors, KEPT))
    while state.filter(F.size("next") > 0).limit(1).count():  # what a query opens has not been open before
        state = stored(_merged(state, _scored(_asked(state, graph, blocks), placed), KEPT))
    best = state.select("q", F.slice(F.arrays_zip("ids", "scores"), 1, k).alias("best"))
    return best.select(F.col("q").alias("query_id"), F.posexplode("best").alias("place", "e")).select(
        "query_id", (F.col("place") + 1).alias("rank"), F.col("e.ids").alias("vec_id"), F.col("e.scores").alias("score")
    )


def nearest_neighbours(
    table: DataFrame,
    is_query,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows found nearest to each row for which ``is_query`` (over
    ``node``, its id) holds, the row itself left out; all others, if there are fewer.

    Nearness is the inner product, ties go to the smaller id. NULL vectors, vectors with NULL or non-finite components,
    zero vectors and rows with a NULL id take no part; of rows with one id the one with the least vector
    does. Vectors of another length than most take no part. An empty table gives no rows.
    """
    vectors = stored(usable_vectors(table, id_col, vector_col))
    graph = build_graph(vectors)
    return search_graph(vectors.filter(is_query), vectors, graph, k)
