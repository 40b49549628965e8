"""Near-duplicate vectors by navigable small-world graphs.

Vectors are compared only under equal labels (and equal dimension), by cosine
in double precision. Equal vectors are one node with a multiplicity. The nodes
of a label are dealt by hash into shards of about ``shard_rows``; each shard
is a hierarchical navigable small-world graph: layer k holds every 16^k-th
node, neighbours are chosen by the diversity rule (a candidate is linked if it
is nearer to the node than to any neighbour chosen before), and nodes enter in
batches that double.

Every shard of a label is queried with the nodes of itself and of the shards
before it, so each pair of nodes meets once; a link counts for both. A beam search returns what the beam holds at or above
the threshold; where the whole beam is above it, the search is repeated with
twice the width, so a node with many links gets all of them and there is no
cap on partners. When a shard is built, a sample of its nodes is audited
against brute force: the beam doubles until the recall of links and of the ten
nearest reaches ``AUDIT``; at a beam as wide as the shard, the shard is
searched by brute force. Found pairs are verified by cosine; components are
the union of the links.

Shard pairs of a label are the method's query set against all rows, in blocks;
each is a group of its own with two shards in it, so a hot label only has more
groups.

Defined results: vectors that are null or zero, or hold a null or non-finite
component, and rows with a null label, link with nothing and are their own
component; repeated rows are copies and link; a null vec_id never names a
component unless all its ids are null; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .scratch import written

THRESHOLD = 0.98
SHARD_ROWS = 1024
NEIGHBOURS = 12
FIRST_BEAM = 32
AUDIT = 0.99
AUDIT_NODES = 128
LAYER_RATIO = 16
#: Rounding: a pair is verified if the graph's own cosine is within this of the threshold.
SLACK = 1e-9


def diverse(sims: np.ndarray, between: np.ndarray, keep: int) -> np.ndarray:
    """Mask of chosen candidates: (B, C) similarities to the node in
    descending order (-inf: none), (B, C, C) among the candidates."""
    chosen = np.zeros(sims.shape, dtype=bool)
    for c in range(sims.shape[1]):
        nearest = np.where(chosen, between[:, c], -np.inf).max(axis=1)
        chosen[:, c] = (sims[:, c] > -np.inf) & (sims[:, c] > nearest) & (chosen.sum(axis=1) < keep)
    # places left over go to the nearest of the rest
    for c in range(sims.shape[1]):
        chosen[:, c] |= (sims[:, c] > -np.inf) & (chosen.sum(axis=1) < keep)
    return chosen


class Graph:
    """A shard's graph over unit vectors (rows of ``vecs``)."""

    def __init__(self, vecs: np.ndarray, layers: list[np.ndarray] | None = None, beam: int = FIRST_BEAM):
        self.vecs, self.beam = vecs, beam
        self.layers = layers if layers is not None else self._build()

    def _build(self) -> list[np.ndarray]:
        sizes = [len(self.vecs)]
        while sizes[-1] > 2 * LAYER_RATIO:
            sizes.append(-(-sizes[-1] // LAYER_RATIO))
        return [self._layer(m) for m in sizes]

    def _layer(self, m: int) -> np.ndarray:
        """Neighbour table (m, 2 * NEIGHBOURS) of the first m nodes, -1 for none."""
        width = 2 * NEIGHBOURS
        table = np.full((m, width), -1, dtype=np.int32)
        done, size = 0, min(m, 2 * width)
        while done < m:
            new = np.arange(done, min(m, done + size))
            inside = self.vecs[new] @ self.vecs[new].T
            np.fill_diagonal(inside, -np.inf)
            ids, sims = np.broadcast_to(new, inside.shape), inside
            if done:
                got, s = self._search(table[:done], self.vecs[new], np.zeros(len(new), dtype=np.int64), FIRST_BEAM)
                ids, sims = np.concatenate([got, ids], axis=1), np.concatenate([s, sims], axis=1)
            top = min(FIRST_BEAM, sims.shape[1])
            order = np.argsort(-sims, axis=1, kind="stable")[:, :top]
            ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
            v = self.vecs[np.maximum(ids, 0)]
            chosen = diverse(sims, np.einsum("bcd,bed->bce", v, v), NEIGHBOURS)
            for i, x in enumerate(new.tolist()):
                table[x, : chosen[i].sum()] = ids[i][chosen[i]]
            for i, x in enumerate(new.tolist()):
                for y in ids[i][chosen[i]].tolist():
                    self._link(table, y, x)
            done += len(new)
            size = max(size, done)
        return table

    def _link(self, table: np.ndarray, y: int, x: int) -> None:
        row = table[y]
        if (row == x).any():
            return
        free = np.flatnonzero(row < 0)
        if len(free):
            row[free[0]] = x
            return
        ids = np.append(row, x)
        sims = self.vecs[ids] @ self.vecs[y]
        order = np.argsort(-sims, kind="stable")
        ids, sims = ids[order], sims[order]
        v = self.vecs[ids]
        table[y] = ids[diverse(sims[None], (v @ v.T)[None], len(row))[0]]

    def _search(self, table: np.ndarray, q: np.ndarray, entry: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Beams (ids, similarities) of all queries at once, best first."""
        n, rows = len(table), np.arange(len(q))
        beam = min(beam, n)
        ids = np.full((len(q), beam), -1, dtype=np.int64)
        sims = np.full((len(q), beam), -np.inf)
        opened = np.ones((len(q), beam), dtype=bool)
        seen = np.zeros((len(q), n), dtype=bool)
        ids[:, 0], sims[:, 0], opened[:, 0] = entry, np.einsum("qd,qd->q", q, self.vecs[entry]), False
        seen[rows, entry] = True
        while True:
            waiting = np.where(opened, -np.inf, sims)
            pos = waiting.argmax(axis=1)
            live = rows[waiting[rows, pos] > -np.inf]
            if not len(live):
                return ids, sims
            opened[live, pos[live]] = True
            nb = table[ids[live, pos[live]]]
            ok = (nb >= 0) & ~seen[live[:, None], np.maximum(nb, 0)]
            at, k = np.nonzero(ok)
            seen[live[at], nb[at, k]] = True
            s = np.full(nb.shape, -np.inf)
            s[at, k] = np.einsum("xd,xd->x", q[live[at]], self.vecs[nb[at, k]])
            all_s = np.concatenate([sims[live], s], axis=1)
            order = np.argsort(-all_s, axis=1, kind="stable")[:, :beam]
            ids[live] = np.take_along_axis(np.concatenate([ids[live], nb], axis=1), order, 1)
            sims[live] = np.take_along_axis(all_s, order, 1)
            opened[live] = np.take_along_axis(np.concatenate([opened[live], ~ok], axis=1), order, 1)

    def beams(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Descent through the layers, then a beam on the lowest."""
        if beam >= len(self.vecs):
            sims = q @ self.vecs.T
            return np.broadcast_to(np.arange(len(self.vecs)), sims.shape), sims
        entry = np.zeros(len(q), dtype=np.int64)
        for table in self.layers[:0:-1]:
            entry = self._search(table, q, entry, 4)[0][:, 0]
        return self._search(self.layers[0], q, entry, beam)

    def near(self, q: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) pairs with similarity ``least`` or more; the beam
        doubles for the queries whose whole beam is that near."""
        found, todo, beam = [], np.arange(len(q)), self.beam
        while len(todo):
            ids, sims = self.beams(q[todo], beam)
            full = (sims >= least).all(axis=1) if beam < len(self.vecs) else np.zeros(len(todo), dtype=bool)
            at, k = np.nonzero((sims >= least) & ~full[:, None])
            found.append((todo[at], ids[at, k]))
            todo, beam = todo[full], 2 * beam
        return np.concatenate([f[0] for f in found]) if found else todo, \
            np.concatenate([f[1] for f in found]) if found else todo

    def audit(self, least: float) -> float:
        """Widen ``beam`` until the sample passes; the last recall."""
        n = len(self.vecs)
        sample = np.arange(0, n, max(1, n // AUDIT_NODES))
        exact = self.vecs[sample] @ self.vecs.T
        ten = np.argsort(-exact, axis=1, kind="stable")[:, : min(10, n)]
        while True:
            a, b = self.near(self.vecs[sample], least)
            links = len(a) / max(1, int((exact >= least).sum()))
            ids, _ = self.beams(self.vecs[sample], self.beam)
            nearest = np.mean([np.isin(t, g).mean() for t, g in zip(ten, ids, strict=True)])
            if min(links, nearest) >= AUDIT or self.beam >= n:
                return min(links, nearest)
            self.beam *= 2


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row pair, in double precision."""
    return np.einsum("xd,xd->x", a, b) / (np.sqrt(np.einsum("xd,xd->x", a, a)) * np.sqrt(np.einsum("xd,xd->x", b, b)))


def unit(v: np.ndarray) -> np.ndarray:
    return v / np.sqrt(np.einsum("xd,xd->x", v, v))[:, None]


def _build_shard(least: float):
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("turn")  # a fixed order that has nothing to do with the vectors
        vecs = np.stack(pdf["v"].to_list())
        g = Graph(unit(vecs))
        recall = g.audit(least)
        first = pdf.iloc[0]
        return pd.DataFrame({"label": [first["label"]], "dim": [first["dim"]], "shard": [first["shard"]],
                             "nodes": [pdf["node"].to_numpy(np.int64).tobytes()], "vecs": [vecs.tobytes()],
                             "sizes": [[len(t) for t in g.layers]],
                             "tables": [b"".join(t.tobytes() for t in g.layers)], "beam": [g.beam], "recall": [recall]})
    return build


def _query_shards(least: float):
    """Cogroup of one graph and one shard of queries: verified links."""
    def run(graphs: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        u, v = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        for _, r in graphs.iterrows():
            nodes = np.frombuffer(r["nodes"], dtype=np.int64)
            vecs = np.frombuffer(r["vecs"], dtype=np.float64).reshape(len(nodes), -1)
            flat, layers, at = np.frombuffer(r["tables"], dtype=np.int32).reshape(-1, 2 * NEIGHBOURS), [], 0
            for m in r["sizes"]:
                layers.append(flat[at: at + m])
                at += m
            g = Graph(unit(vecs), layers, int(r["beam"]))
            for _, x in queries.iterrows():
                own = np.frombuffer(x["qnodes"], dtype=np.int64)
                q = np.frombuffer(x["qvecs"], dtype=np.float64).reshape(len(own), -1)
                a, b = g.near(unit(q), least - SLACK)
                ok = (own[a] != nodes[b]) & (cosines(q[a], vecs[b]) >= least)
                u.append(np.minimum(own[a], nodes[b])[ok])
                v.append(np.maximum(own[a], nodes[b])[ok])
        return pd.DataFrame({"u": np.concatenate(u), "v": np.concatenate(v)}).drop_duplicates()
    return run


def embedding_graphs(nodes: DataFrame, threshold: float, shard_rows: int) -> DataFrame:
    """One row per shard of (label, dim, node, v): the graph as arrays, the
    beam the audit settled on and its recall."""
    shards = nodes.groupBy("label", "dim").agg(F.ceil(F.count("*") / F.lit(shard_rows)).alias("shards"))
    dealt = (nodes.join(F.broadcast(shards) if shards.limit(10_001).count() <= 10_000 else shards, ["label", "dim"])
             .select("label", "dim", F.pmod(F.xxhash64("node", F.lit(1)), F.col("shards")).alias("shard"), "node",
                     F.xxhash64("node", F.lit(2)).alias("turn"), "v"))
    return dealt.groupBy("label", "dim", "shard").applyInPandas(
        _build_shard(threshold), "label string, dim int, shard bigint, nodes binary, vecs binary, sizes array<int>, "
                                 "tables binary, beam int, recall double")


def embedding_dedup(vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                    threshold: float = THRESHOLD, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """key, n_links, component_id, kept: one row per row of ``vectors``."""
    v = F.col("v")
    rows = vectors.select(F.col(key).alias("id"), F.col(label).cast("string").alias("label"),
                          F.col(vector).cast("array<double>").alias("v"))
    most = F.array_max(F.transform(v, F.abs))
    norm = F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x)
    fine = (F.col("label").isNotNull() & v.isNotNull() & ~F.exists(v, lambda x: x.isNull()) & (most > 0)
            & (most < float("inf")) & ~F.isnan(most))
    rows = rows.withColumn("node", F.when(F.coalesce(fine, F.lit(False)), F.xxhash64("label", "v")))
    # squares of very large or small numbers leave the range of doubles: the cosine is that of the scaled vector
    scaled = F.transform(v, lambda x: x / most)
    rows = rows.withColumn("v", F.when(F.col("node").isNotNull() & ~norm.between(1e-280, 1e280), scaled).otherwise(v))
    found = rows.filter("node IS NOT NULL")
    nodes = written(found.groupBy("node").agg(F.first("label").alias("label"), F.first("v").alias("v"),
                                              F.count("*").alias("copies"), F.min("id").alias("least"))
                    .withColumn("dim", F.size("v")), "nodes")
    graphs = written(embedding_graphs(nodes, threshold, shard_rows), "graphs")
    keys = graphs.select("label", "dim", "shard")
    pairs = written(keys.join(keys.withColumnRenamed("shard", "other"), ["label", "dim"]).filter("other <= shard"), "shard-pairs")
    task = ["label", "dim", "shard", "other"]
    side = pairs.join(graphs, ["label", "dim", "shard"])
    asks = pairs.join(graphs.select("label", "dim", F.col("shard").alias("other"), F.col("nodes").alias("qnodes"),
                                    F.col("vecs").alias("qvecs")), ["label", "dim", "other"])
    asks = asks.select(*(F.col(c).alias(f"q_{c}" if c in task else c) for c in asks.columns))
    links = written(side.groupBy(*task).cogroup(asks.groupBy(*(f"q_{c}" for c in task)))
                    .applyInPandas(_query_shards(threshold), "u bigint, v bigint").distinct(), "links")
    roots = connected_components(links)
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    counts = (both.join(nodes.select(F.col("node").alias("v"), "copies"), "v")
              .groupBy("u").agg(F.sum("copies").alias("others")))
    at = (nodes.select("node", "copies", "least").join(counts.withColumnRenamed("u", "node"), "node", "left")
          .join(roots, "node", "left")
          .select("node", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                  F.coalesce("root", "node").alias("root"), "least"))
    names = at.groupBy("root").agg(F.min("least").alias("component"))
    at = written(at.join(names, "root").select("node", "n_links", "component"), "node-links")
    out = rows.select("id", "node").join(at, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component"))
    return out.select(F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                      component.cast("bigint").alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


#: DuckDB SQL for ``embedding_dedup`` over ``embeddings`` (all links; the
#: graphs' recall is measured in the tests).
SQL = f"""
WITH RECURSIVE v AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= {THRESHOLD}),
reach(id, r) AS (SELECT a, b FROM link UNION SELECT reach.id, link.b FROM reach JOIN link ON reach.r = link.a)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, least(e.vec_id, coalesce(g.r, e.vec_id)) AS component_id,
       e.vec_id <= coalesce(g.r, e.vec_id) AS kept
FROM embeddings e LEFT JOIN (SELECT a, count(*) AS n FROM link GROUP BY a) n ON e.vec_id = n.a
LEFT JOIN (SELECT id, min(r) AS r FROM reach GROUP BY id) g ON e.vec_id = g.id
"""
