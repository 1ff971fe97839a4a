"""Approximate nearest neighbours: one hierarchical navigable small-world graph per shard, results merged."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize

#: Links of a node on upper layers and on the lowest; beam widths.
UPPER, LOWEST, BUILD_BEAM, SEARCH_BEAM = 16, 32, 64, 160
#: A table is cut into SHARDS graphs of LEAST_ROWS vectors or more, and into more only where one would pass SHARD_BYTES.
SHARDS, LEAST_ROWS, SHARD_BYTES = 4, 2048, 16 << 20
#: Nodes inserted together, and beam entries opened together.
BATCH, OPEN = 256, 4

INDEX = "dim int, shard int, ids array<long>, vectors array<float>, layer_sizes array<int>, nodes array<int>, links array<int>"


def beam(x: np.ndarray, links: np.ndarray, q: np.ndarray, entries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search of many queries at once: (ids, distances), ``width`` columns, nearest first; -1 and inf: none.

    ``links`` holds each node's neighbours (-1: none) in rows; ``entries`` each query's first nodes.
    """
    n, many = len(x), len(q)
    seen = np.zeros((many, n + 1), dtype=bool)
    seen[:, n] = True
    norms = np.einsum("nd,nd->n", x, x)

    def away(who: np.ndarray, ids: np.ndarray) -> np.ndarray:
        return norms[ids] - 2 * np.matmul(x[ids], q[who][:, :, None])[:, :, 0]

    ids = np.full((many, width), -1, dtype=np.int64)
    dist = np.full((many, width), np.inf, dtype=np.float32)
    opened = np.ones((many, width), dtype=bool)
    k = entries.shape[1]
    ids[:, :k], dist[:, :k], opened[:, :k] = entries, away(np.arange(many), entries), False
    np.put_along_axis(seen, entries, True, axis=1)
    live = np.arange(many)
    while len(live):
        todo = np.where(opened[live], np.inf, dist[live])
        pick = np.argsort(todo, axis=1)[:, :OPEN]
        ready = np.take_along_axis(todo, pick, axis=1) < np.inf
        on = ready[:, 0]
        live, pick, ready = live[on], pick[on], ready[on]
        if not len(live):
            break
        rows = live[:, None]
        opened[rows, pick] = True
        near = links[np.where(ready, ids[rows, pick], 0)]
        near = np.where(ready[:, :, None] & (near >= 0), near, n).reshape(len(live), -1)
        near = np.sort(near, axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = n
        fresh = ~seen[rows, near]
        seen[rows, near] = True
        safe = np.where(fresh, near, 0)
        d = np.where(fresh, away(live, safe), np.inf).astype(np.float32)
        all_ids, all_dist = np.hstack([ids[live], np.where(fresh, near, -1)]), np.hstack([dist[live], d])
        all_open = np.hstack([opened[live], ~fresh])
        best = np.argsort(all_dist, axis=1, kind="stable")[:, :width]
        ids[live], dist[live], opened[live] = (np.take_along_axis(a, best, axis=1) for a in (all_ids, all_dist, all_open))
    return ids, dist


def diverse(x: np.ndarray, ids: np.ndarray, dist: np.ndarray, most: int) -> np.ndarray:
    """Of each row's candidates (nearest first), ``most`` links: those nearer to the node than to any link already
    chosen, then the nearest of the rest; -1 fills up."""
    valid = np.isfinite(dist) & (ids >= 0)
    v = x[np.where(valid, ids, 0)]
    sq = np.einsum("bkd,bkd->bk", v, v)
    apart = sq[:, :, None] + sq[:, None, :] - 2 * np.matmul(v, v.transpose(0, 2, 1))
    chosen = np.zeros(ids.shape, dtype=bool)
    for k in range(ids.shape[1]):
        crowd = (chosen & (apart[:, k, :] < dist[:, k, None])).any(axis=1)
        chosen[:, k] = valid[:, k] & ~crowd & (chosen.sum(axis=1) < most)
    rank = np.where(chosen, 0, np.where(valid, 1, 2)) * ids.shape[1] + np.arange(ids.shape[1])
    order = np.argsort(rank, axis=1)[:, :most]
    out = np.where(np.take_along_axis(valid, order, axis=1), np.take_along_axis(ids, order, axis=1), -1)
    return np.hstack([out, np.full((len(out), most - out.shape[1]), -1, dtype=out.dtype)]) if out.shape[1] < most else out


def layer(x: np.ndarray, entries: np.ndarray, degree: int) -> np.ndarray:
    """Neighbour rows of one layer over ``x``: nodes are inserted in batches, each searching what is there already
    from its entry (a node of an earlier batch), compared within its batch, and linked both ways."""
    n = len(x)
    links = np.full((n, degree), -1, dtype=np.int64)
    at = 0
    while at < n:
        size = min(n - at, BATCH if at == 0 else min(BATCH, at))
        new = np.arange(at, at + size)
        norms = np.einsum("nd,nd->n", x[new], x[new])
        apart = norms[None, :] - 2 * x[new] @ x[new].T
        np.fill_diagonal(apart, np.inf)
        k = min(size, BUILD_BEAM)
        close = np.argsort(apart, axis=1, kind="stable")[:, :k]
        ids, dist = new[close], np.take_along_axis(apart, close, axis=1)
        if at:
            old, far = beam(x[:at], links[:at], x[new], np.minimum(entries[new], at - 1)[:, None], BUILD_BEAM)
            ids, dist = np.hstack([old, ids]), np.hstack([far, dist])
            best = np.argsort(dist, axis=1, kind="stable")[:, :BUILD_BEAM]
            ids, dist = np.take_along_axis(ids, best, axis=1), np.take_along_axis(dist, best, axis=1)
        # beam and batch distances leave out |q|^2, which the comparison between candidates needs
        links[new] = diverse(x, ids, dist + norms[:, None], degree)
        src, col = np.nonzero(links[new] >= 0)
        back(x, links, links[new][src, col], new[src])
        at += size
    return links


def back(x: np.ndarray, links: np.ndarray, to: np.ndarray, frm: np.ndarray) -> None:
    """Add links to -> frm; a node with too many keeps diverse ones."""
    order = np.argsort(to, kind="stable")
    to, frm = to[order], frm[order]
    degree = links.shape[1]
    while len(to):
        first = np.ones(len(to), dtype=bool)
        first[1:] = to[1:] != to[:-1]
        start = np.maximum.accumulate(np.where(first, np.arange(len(to)), 0))
        nth = np.arange(len(to)) - start
        now = nth < 16
        group = np.cumsum(first) - 1
        nodes = to[first]
        more = np.full((len(nodes), 16), -1, dtype=np.int64)
        more[group[now], nth[now]] = frm[now]
        for part in range(0, len(nodes), 512):
            who, extra = nodes[part : part + 512], more[part : part + 512]
            have = links[who]
            extra = np.where((extra[:, :, None] == have[:, None, :]).any(axis=2), -1, extra)
            cand = np.hstack([have, extra])
            room = (cand >= 0).sum(axis=1) <= degree
            packed = np.take_along_axis(cand, np.argsort(cand < 0, axis=1, kind="stable"), axis=1)
            links[who[room]] = packed[room][:, :degree]
            if (~room).any():
                full, c = who[~room], cand[~room]
                gap = x[np.where(c >= 0, c, 0)] - x[full][:, None, :]
                d = np.where(c >= 0, np.einsum("bkd,bkd->bk", gap, gap), np.inf)
                near = np.argsort(d, axis=1, kind="stable")
                links[full] = diverse(x, np.take_along_axis(c, near, axis=1), np.take_along_axis(d, near, axis=1), degree)
        to, frm = to[~now], frm[~now]


def augmented(x: np.ndarray) -> np.ndarray:
    """Inner products become distances: one more component makes all lengths equal (queries get 0 there)."""
    sq = np.einsum("nd,nd->n", x, x, dtype=np.float64)
    return np.hstack([x, np.sqrt(np.maximum(sq.max() - sq, 0))[:, None]]).astype(np.float32)


def build(ids: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, list[int], np.ndarray, np.ndarray]:
    """(order, layer sizes from the lowest, nodes, links): rows are renumbered so that each layer is a prefix."""
    rng = np.random.default_rng(len(ids))
    level = np.floor(-np.log(1 - rng.random(len(ids))) / np.log(UPPER)).astype(int)
    order = np.lexsort((ids, -level))
    y = augmented(x)[order]
    level = level[order]
    sizes = [int((level >= k).sum()) for k in range(level.max() + 1)]
    made: list[np.ndarray] = []
    entries = np.zeros(len(ids), dtype=np.int64)
    for k in reversed(range(len(sizes))):
        m = sizes[k]
        made.append(layer(y[:m], entries[:m], LOWEST if k == 0 else UPPER))
        if k:  # the nearest node of this layer is where a search enters the one below
            entries = np.concatenate([beam(y[:m], made[-1], y[p : p + 1024], np.minimum(entries[p : p + 1024], m - 1)[:, None], 8)[0][:, 0] for p in range(0, len(ids), 1024)])
    made.reverse()
    return order, sizes, np.concatenate([np.arange(m) for m in sizes]), np.concatenate([g.ravel() for g in made])


def search(vectors: np.ndarray, sizes: list[int], links: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, scores) of the ``k`` best found for each query by inner product in double precision."""
    y = augmented(vectors)
    p = np.hstack([q, np.zeros((len(q), 1), dtype=np.float32)]).astype(np.float32)
    graphs, at = [], 0
    for level, m in enumerate(sizes):
        d = LOWEST if level == 0 else UPPER
        graphs.append(links[at : at + m * d].reshape(m, d))
        at += m * d
    entry = np.zeros(len(q), dtype=np.int64)
    for level in reversed(range(1, len(sizes))):
        entry = beam(y[: sizes[level]], graphs[level], p, entry[:, None], 8)[0][:, 0]
    wide = int(SEARCH_BEAM * max(1.0, len(y) / 4096) ** 0.25)  # a larger graph asks for a wider beam
    found, _ = beam(y, graphs[0], p, entry[:, None], max(wide, k))
    exact = vectors.astype(np.float64)
    score = np.where(found >= 0, (exact[np.maximum(found, 0)] * q.astype(np.float64)[:, None, :]).sum(axis=2), -np.inf)
    return found, score


def shard_count(rows: int, dim: int, shards: int = SHARDS, shard_bytes: int = SHARD_BYTES) -> int:
    """Graphs for ``rows`` vectors: every query visits all of them, so there are as few as a task's memory allows."""
    most = max(LEAST_ROWS, shard_bytes // (4 * (dim + LOWEST + 4)))
    return max(min(shards, rows // LEAST_ROWS), -(-rows // most), 1)


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    v = F.col("vec")
    inf = float("inf")
    good = v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(inf))) & F.exists(v, lambda c: c != 0)
    return vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<float>").alias("vec")).where(F.col("id").isNotNull() & good)


def index(classes: DataFrame) -> DataFrame:
    """One row per shard (INDEX): ids, flat vectors, layer sizes, and the neighbour rows of all layers as one flat array."""

    def make(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rep")
        ids, x = pdf["rep"].to_numpy(), np.vstack(pdf["vec"].to_numpy()).astype(np.float32)
        order, sizes, nodes, links = build(ids, x)
        return pd.DataFrame({"dim": [x.shape[1]], "shard": [pdf["shard"].iloc[0]], "ids": [ids[order]], "vectors": [x[order].ravel()], "layer_sizes": [np.array(sizes)], "nodes": [nodes], "links": [links.astype(np.int32)]})

    return classes.select("dim", "shard", "rep", "vec").groupBy("dim", "shard").applyInPandas(make, INDEX)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", shards: int = SHARDS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of ``vectors`` with the largest inner product with each query,
    found by the graphs; the row with the query's own id is no candidate; ties go to the smaller id.

    Null ids, and vectors that are null, empty, zero or hold null or non-finite components, take no part on either
    side; only vectors of the query's length are candidates. Equal vectors are one node of a graph (thousands of
    copies would cut it into cliques); its ``k`` + 1 smallest ids, all that an answer can name, come back at the
    end. Nodes are dealt by a hash into ``shard_count`` shards: few while they fit ``shard_bytes``, so that the work
    of a query does not grow with the table, and each gets its graph (``index``), written to shared storage. Queries
    go to every shard, in blocks of a quarter of a shard's rows or more: a graph is sent once to each block's task,
    which holds one shard and one block. The shards' best are merged by exact scores in double precision.
    """
    rows = usable(vectors, id_col, vec_col)
    nth = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    first = rows.distinct().withColumn("nth", nth).where(F.col("nth") <= k + 1)
    classes = first.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("members"))
    classes = materialize(classes.select(F.element_at("members", 1).alias("rep"), F.size("vec").alias("dim"), "vec", "members"), "hnsw-classes")
    asked = materialize(usable(queries, id_col, vec_col).dropDuplicates(["id", "vec"]).withColumn("dim", F.size("vec")), "hnsw-queries")
    many = {r["dim"]: r["count"] for r in asked.groupBy("dim").count().collect()}  # one row per vector length
    sizes = []
    for r in classes.groupBy("dim").count().collect():
        n = shard_count(r["count"], r["dim"], shards, shard_bytes)
        sizes.append((r["dim"], n, max(1, -(-many.get(r["dim"], 0) // max(4096, r["count"] // n // 4)))))
    dealt = F.broadcast(vectors.sparkSession.createDataFrame(sizes, "dim int, shards int, blocks int"))
    graph = materialize(index(classes.join(dealt, "dim").withColumn("shard", F.pmod(F.xxhash64("rep"), F.col("shards")).cast("int"))), "hnsw-index")
    asked = asked.join(dealt, "dim").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    asked = asked.select("dim", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), "block", "id", "vec")
    spread = graph.join(dealt.select("dim", "blocks"), "dim").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")

    def ask(graph_pdf: pd.DataFrame, query_pdf: pd.DataFrame) -> pd.DataFrame:
        if graph_pdf.empty or query_pdf.empty:
            return pd.DataFrame({"query_id": [], "rep": [], "score": []})
        g = graph_pdf.iloc[0]
        ids = np.asarray(g["ids"])
        x = np.asarray(g["vectors"], dtype=np.float32).reshape(len(ids), -1)
        layers, links = [int(m) for m in g["layer_sizes"]], np.asarray(g["links"], dtype=np.int64)
        out = []
        for at in range(0, len(query_pdf), 512):
            part = query_pdf.iloc[at : at + 512]
            found, score = search(x, layers, links, np.vstack(part["vec"].to_numpy()).astype(np.float32), k + 1)
            reps = ids[np.maximum(found, 0)]
            best = np.lexsort((reps, -score), axis=1)[:, : k + 1]
            reps, score = np.take_along_axis(reps, best, axis=1), np.take_along_axis(score, best, axis=1)
            row, col = np.nonzero(np.isfinite(score))
            out.append(pd.DataFrame({"query_id": part["id"].to_numpy()[row], "rep": reps[row, col], "score": score[row, col]}))
        return pd.concat(out)

    keys = ["dim", "shard", "block"]
    found = spread.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(ask, "query_id long, rep long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "rep")
    merged = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
    named = merged.join(classes.select("rep", "members"), "rep").select("query_id", "score", F.explode("members").alias("vec_id"))
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    named = named.where("vec_id <> query_id").withColumn("rank", F.row_number().over(final).cast("int"))
    return named.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
