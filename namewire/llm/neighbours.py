"""Near-duplicate vectors by a flat, robust-pruned graph.

Vectors of one label are dealt to overlapping shards around sampled centres. In each shard
every vector gets a short list of neighbours: near ones and far ones, pruned so that
none stands behind another. The lists of all shards are united. Searches then run in
each shard over the united lists: greedily from the shard's medoid, and from what they reach
on to every neighbour within range. Links are confirmed in double precision.

A pair that shares several shards counts in the smallest of them. Shards send on counts
and a spanning forest of their links, not the links. Recall is audited against brute
force for a bounded set of queries, over all links and as the mean of the queries, so that a clump
does not outweigh small groups. Shards are made to overlap more until both are high enough; if the last
attempt falls short, an error is raised and no result returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from namewire.llm.base import components, stored, table

COSINE, SLACK = 0.98, 0.02  # searches walk on over vectors this much below the range
CELL = 6144
NEAR, FAR, POOL, DEGREE, BEAM, STEPS, ALPHA = 16, 8, 48, 40, 16, 24, 1.2
APART = 0.9  # centres of one cell are less alike than this
AUDITED = 200
RECALL = 0.98


def _unit(vectors: pd.Series) -> np.ndarray:
    x = np.array(vectors.tolist(), np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _deal(wanted: int, overlap: int):
    """Cells around centres; rows whose cell cannot be divided keep it, marked."""
    def run(key: tuple, rows: pd.DataFrame, centres: pd.DataFrame) -> pd.DataFrame:
        if rows.empty:
            return rows[["node", "vector", "cell"]].assign(fixed=False)
        x = _unit(rows["vector"])
        c = _unit(centres.sort_values("node")["vector"]) if len(centres) else x[:1]
        apart: list[int] = []
        for k in range(len(c)):
            if len(apart) >= max(4, wanted) or (apart and (c[apart] @ c[k]).max() >= APART):
                continue
            apart.append(k)
        if len(apart) < 2:
            return rows[["node", "vector", "cell"]].assign(fixed=True)
        near = np.argsort(-(x @ c[apart].T), axis=1)[:, :overlap]
        parts = []
        for k in range(near.shape[1]):
            part = rows[["node", "vector"]].copy()
            part["cell"] = pd.util.hash_array(near[:, k].astype(np.uint64) + np.uint64(key[0] % (1 << 62))).view(np.int64)
            part["fixed"] = False
            parts.append(part)
        return pd.concat(parts)
    return run


def shards(vectors: DataFrame, cell: int = CELL, overlap: int = 2, levels: int = 6) -> DataFrame:
    """``node``, ``vector``, ``shard``, ``shards`` (all shards of the node): groups of about ``cell`` vectors at most.

    ``vectors`` has ``node``, ``vector`` and the long ``cell`` within which links are looked for.
    What stays too large, a clump of vectors all alike, is cut into blocks, with one shard
    for every two blocks.
    """
    schema = f"node long, vector {vectors.schema['vector'].dataType.simpleString()}, cell long, fixed boolean"
    todo, done = stored(vectors.select("node", "vector", "cell", F.lit(False).alias("fixed")), "cells"), None
    for level in range(levels):
        sizes = stored(todo.groupBy("cell").agg(F.count("*").alias("size"), F.bool_or("fixed").alias("stuck")), "sizes")
        sized = todo.join(sizes, "cell")
        ready = sized.where(f"size <= {cell} or stuck").select("node", "vector", "cell", "size")
        done = ready if done is None else done.unionByName(ready)
        large = sized.where(f"size > {cell} and not stuck")
        if sizes.where(f"size > {cell} and not stuck").isEmpty():
            break
        # about four centres a cell's worth of rows, 256 at most, and as many salts as tasks' worth
        large = large.withColumn("salts", F.ceil(F.col("size") / 8192).cast("int"))
        wanted = F.least(F.ceil(4 * F.col("size") / cell), F.lit(256))
        sample = large.where(F.pmod(F.xxhash64("node", F.lit(level)), F.col("size")) < wanted).select(
            "node", "vector", "cell", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
        ).toDF("node", "vector", "to_cell", "to_salt")
        rows = large.withColumn("salt", F.pmod(F.xxhash64("node", F.lit("salt")), F.col("salts")).cast("int"))
        todo = stored(rows.select("node", "vector", "cell", "salt").groupBy("cell", "salt").cogroup(
            sample.groupBy("to_cell", "to_salt")).applyInPandas(_deal(256, overlap), schema).dropDuplicates(["node", "cell"]),
            "cells")
    else:
        sizes = todo.groupBy("cell").agg(F.count("*").alias("size"))
        done = done.unionByName(todo.join(sizes, "cell").select("node", "vector", "cell", "size"))
    blocks = F.when(F.col("size") <= cell, 1).otherwise(F.ceil(2 * F.col("size") / cell)).cast("int")
    placed = done.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    placed = placed.withColumn("other", other).select("node", "vector", F.xxhash64(
        "cell", F.least("block", "other"), F.greatest("block", "other")).alias("shard"))
    placed = stored(placed.dropDuplicates(["node", "shard"]), "placed")
    return placed.join(placed.groupBy("node").agg(F.sort_array(F.collect_list("shard")).alias("shards")), "node")


def _prune(x: np.ndarray, own: np.ndarray, pool: np.ndarray, keep: int) -> np.ndarray:
    """Of each row's pool, nearest first, ``keep`` entries none of which stands behind an earlier one; -1 fills up."""
    n, width = pool.shape
    distance = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("nd,nwd->nw", x[own], x[pool])))
    order = np.argsort(distance, axis=1, kind="stable")
    pool, distance = np.take_along_axis(pool, order, 1), np.take_along_axis(distance, order, 1)
    alive = pool != own[:, None]
    out = np.full((n, keep), -1, np.int64)
    rows = np.arange(n)
    for k in range(keep):
        first = alive.argmax(axis=1)
        have = alive[rows, first]
        if not have.any():
            break
        chosen = pool[rows, first]
        out[have, k] = chosen[have]
        behind = ALPHA * np.sqrt(np.maximum(0, 2 - 2 * np.einsum("nd,nwd->nw", x[chosen], x[pool]))) <= distance
        alive &= ~behind & (pool != chosen[:, None])
    return out


def _build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Neighbour lists of a shard."""
    rows = rows.sort_values("node")
    x = _unit(rows["vector"]).astype(np.float32)
    nodes, n = rows["node"].to_numpy(), len(rows)
    if n < 2:
        return pd.DataFrame({"node": pd.Series([], dtype="int64"), "neighbours": pd.Series([], dtype=object)})
    draw = np.random.Generator(np.random.PCG64(3))
    lists: list[set[int]] = [set() for _ in range(n)]
    for low in range(0, n, 256):
        own = np.arange(low, min(n, low + 256))
        likeness = x[own] @ x.T
        pool = np.argpartition(-likeness, min(POOL, n - 1), axis=1)[:, : POOL + 1]
        near = _prune(x, own, pool, NEAR)
        far = _prune(x, own, draw.integers(0, n, (len(own), POOL)), FAR)
        for p, near_p, far_p in zip(own, near, far):
            for q in (*near_p, *far_p):
                if q >= 0:
                    lists[p].add(int(q))
        for p, near_p in zip(own, near):  # and back, so that every vector can be reached
            for q in near_p[near_p >= 0][:4]:
                if len(lists[int(q)]) < DEGREE:
                    lists[int(q)].add(int(p))
    return pd.DataFrame({"node": nodes, "neighbours": [nodes[sorted(s)].tolist() for s in lists]})


def search(x: np.ndarray, graph: np.ndarray, queries: np.ndarray, start: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """(query, found) pairs: greedy from ``start`` and from the query's own node, then over all that is in range."""
    fast, n, reach = x.astype(np.float32), len(x), cosine - SLACK
    q, rows = fast[queries], np.arange(len(queries))
    beam = np.full((len(queries), BEAM), -1, np.int64)
    beam[:, 0], beam[:, 1] = start, queries
    value = np.where(beam >= 0, np.einsum("nd,nbd->nb", q, fast[beam]), -2.0).astype(np.float32)
    value[:, 1] = np.where(queries == start, -2.0, -1.5)  # the query's node is walked from, but does not lead
    open_ = beam >= 0
    seen = np.zeros((len(queries), n), bool)
    seen[rows, start] = seen[rows, queries] = True
    for _ in range(STEPS):
        step = np.where(open_, value, -3).argmax(axis=1)
        live = open_[rows, step]
        if not live.any():
            break
        open_[rows, step] = False
        near = np.where(live[:, None], graph[beam[rows, step]], -1)
        fresh = (near >= 0) & ~seen[rows[:, None], near]
        r, k = np.nonzero(fresh)
        seen[r, near[r, k]] = True
        worth = np.full(near.shape, -3.0, np.float32)
        worth[r, k] = np.einsum("nd,nd->n", q[r], fast[near[r, k]])
        all_ids, all_values = np.c_[beam, near], np.c_[value, worth]
        all_open = np.c_[open_, fresh]
        best = np.argpartition(-all_values, BEAM - 1, axis=1)[:, :BEAM]
        beam, value = np.take_along_axis(all_ids, best, 1), np.take_along_axis(all_values, best, 1)
        open_ = np.take_along_axis(all_open, best, 1)
    del seen
    found = np.zeros((len(queries), n), bool)
    found[rows, queries] = True
    r, k = np.nonzero((value >= reach) & (beam >= 0))
    found[r, beam[r, k]] = True
    r, node = np.nonzero(found)
    while len(r):
        near = graph[node]
        who = np.repeat(r, near.shape[1])[near.reshape(-1) >= 0]
        near = near[near >= 0]
        fresh = ~found[who, near]
        both = np.unique(who[fresh] * n + near[fresh])
        r, node = both // n, both % n
        good = np.einsum("nd,nd->n", q[r], fast[node]) >= reach
        r, node = r[good], node[good]
        found[r, node] = True
    r, node = np.nonzero(found)
    exact = np.einsum("nd,nd->n", x[queries[r]], x[node]) >= cosine
    return r[exact], node[exact]


def _search(cosine: float):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node")
        nodes, x = rows["node"].to_numpy(), _unit(rows["vector"])
        copies, places = rows["copies"].to_numpy(), rows["shards"].tolist()
        shard, n = key[0], len(rows)
        single = np.array([len(p) == 1 for p in places])
        lists = [np.searchsorted(nodes, np.array(a, np.int64)) if a is not None else np.zeros(0, np.int64) for a in rows["neighbours"]]
        lists = [a[nodes[np.minimum(a, n - 1)] == np.array(b, np.int64)] if b is not None and len(a) else a[:0]
                 for a, b in zip(lists, rows["neighbours"])]
        graph = np.full((n, max([1, *map(len, lists)])), -1, np.int64)
        for k, a in enumerate(lists):
            graph[k, : len(a)] = a
        middle = x.mean(axis=0)
        start = int((x @ middle).argmax())
        counts, roots = np.zeros(n, np.int64), np.arange(n)

        def root(a: int) -> int:
            while roots[a] != a:
                roots[a] = a = roots[roots[a]]
            return a

        for low in range(0, n, 256):
            part = np.arange(low, min(n, low + 256))
            r, found = search(x, graph, part, start, cosine)
            a, b = part[r], found
            keep = a != b
            a, b = a[keep], b[keep]
            if not single.all():
                # of the shards that both are in, only the smallest counts the pair
                keep = np.array([single[i] or single[j] or min(set(places[i]) & set(places[j])) == shard for i, j in zip(a, b)], bool)
                a, b = a[keep], b[keep]
            np.add.at(counts, a, copies[b])
            for i, j in zip(a, b):
                i, j = root(int(i)), root(int(j))
                if i != j:
                    roots[max(i, j)] = min(i, j)
        return pd.DataFrame({"node": nodes, "found": counts, "root": nodes[[root(k) for k in range(n)]]})
    return run


def _brute(cosine: float, asked: pd.DataFrame):
    """Links of a bounded set of queries with all rows, block by block."""
    by_cell = {cell: (part["node"].to_numpy(), _unit(part["vector"])) for cell, part in asked.groupby("cell")}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for cell, rows in batch.groupby("cell"):
                if cell not in by_cell:
                    continue
                nodes, q = by_cell[cell]
                hit = (q @ _unit(rows["vector"]).T >= cosine) & (nodes[:, None] != rows["node"].to_numpy()[None])
                counts = hit @ rows["copies"].to_numpy()
                yield pd.DataFrame({"node": nodes, "truth": counts})
    return run


def near_duplicates(
    vectors: DataFrame, cosine: float = COSINE, cell: int = CELL, recall: float = RECALL, attempts: int = 5,
    id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label",
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` for every row.

    Vectors are compared only if their labels and lengths are equal. A vector that is null,
    empty, zero, or has null or non-finite components, or a null label, links with nothing.
    Equal vectors of one label are one node and count each; rows that repeat an id count as
    vectors of their own. A row without an id links with nothing, has no component and is
    kept. An empty table gives no row; other columns are not looked at, whatever their names. Vectors of
    doubles stay doubles. ``RuntimeError`` if the audited recall stays below ``recall``.
    """
    kind = vectors.schema[vector_column].dataType.simpleString()
    plain = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(label_column).cast("string").alias("label"),
                           F.col(vector_column).cast(kind if kind == "array<float>" else "array<double>").alias("vector"))
    sound = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()
             & F.coalesce(F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))), F.lit(False))
             & F.coalesce(F.exists("vector", lambda v: v != 0), F.lit(False)))
    marked = stored(plain.withColumn("sound", F.coalesce(sound, F.lit(False))).select(
        "vec_id", "vector", F.when(F.col("sound"), F.xxhash64("label", F.size("vector"))).alias("cell"),
        F.when(F.col("sound"), F.xxhash64("label", "vector")).alias("node")), "vectors")
    nodes = stored(marked.where("node is not null").groupBy("node").agg(
        F.min("vec_id").alias("id"), F.count("*").alias("copies"), F.first("vector").alias("vector"),
        F.first("cell").alias("cell")), "nodes")
    total = nodes.count()
    asked = nodes.where(F.pmod(F.xxhash64("node", F.lit("audit")), F.lit(max(1, total // AUDITED))) == 0).limit(2 * AUDITED)
    asked = asked.select("node", "cell", "vector").toPandas()
    truth = (nodes.select("node", "cell", "vector", "copies").mapInPandas(_brute(cosine, asked), "node long, truth long")
             .groupBy("node").agg(F.sum("truth").alias("truth")))
    truth = {r.node: r.truth for r in truth.collect()} if len(asked) else {}

    for attempt in range(attempts):
        placed = stored(shards(nodes, cell, 2 + attempt), "shards")
        lists = placed.select("node", "vector", "shard").groupBy("shard").applyInPandas(_build, "node long, neighbours array<long>")
        united = lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("neighbours"))).alias("neighbours"))
        ready = placed.join(united, "node", "left").join(nodes.select("node", "copies"), "node")
        found = stored(ready.groupBy("shard").applyInPandas(_search(cosine), "node long, found long, root long"), "found")
        counts = found.groupBy("node").agg(F.sum("found").alias("found"))
        audited = {r.node: r.found for r in counts.where(F.col("node").isin(list(truth))).collect()} if truth else {}
        linked = [k for k, links in truth.items() if links]
        got = [min(audited.get(k) or 0, truth[k]) for k in linked]
        overall = sum(got) / sum(truth[k] for k in linked) if linked else 1.0
        mean = sum(g / truth[k] for k, g in zip(linked, got)) / len(linked) if linked else 1.0
        if min(overall, mean) >= recall:
            break
    else:
        raise RuntimeError(f"recall {overall:.3f} of links, {mean:.3f} by query, is below {recall} after {attempts} attempts")

    joined = components(found.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    named = nodes.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node")).join(counts, "node", "left")
    lowest = named.groupBy("component").agg(F.min("id").alias("component_id"))
    named = named.join(lowest, "component").select(
        "node", "component_id", (F.coalesce("found", F.lit(0)) + F.col("copies") - 1).alias("links"))
    return (marked.select("vec_id", "node").join(named, "node", "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        (F.coalesce("component_id", "vec_id").eqNullSafe(F.col("vec_id"))).alias("kept")))


def op10_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "embeddings"))
