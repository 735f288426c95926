"""Embedding near-dedup by NN-descent."""

from __future__ import annotations

import logging
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, pick
from .components import connected_components

log = logging.getLogger(__name__)

#: Links need this cosine; neighbour lists hold neighbours from RELAXED on, of which links of links are made.
THRESHOLD, RELAXED = 0.98, 0.85
#: Neighbours in a list, vectors compared in a starting block, members joined around one vector, tables of starting blocks.
NEIGHBOURS, BLOCK, LOCAL, TABLES = 16, 256, 64, 10
ROUNDS, REPEATS = 4, 3
#: So many vectors at first, drawn from all, are compared with all others to audit recall, which must reach RECALL or the search goes on.
AUDIT, RECALL = 512, 0.995
#: More are drawn, up to MOST times AUDIT at once, until ENOUGH have links, but LIMIT times AUDIT at most: where links are
#: as rare as that, so is what could be missed, and an audit of all would grow with the square of the table.
ENOUGH, MOST, LIMIT = 200, 16, 16
#: Members of a component compared at a time.
TILE = 256
PLANES = 24
EDGES = "a long, b long, cosine double"
FOUND = EDGES + ", tie boolean"


def _unit(vectors: Iterable) -> np.ndarray:
    x = np.stack([np.asarray(v, np.float64) for v in vectors])
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def vectors(rows: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """id, label, vec, h, k: two digests of label and vector, so that equal ones share them; null where nothing may link."""
    rows = pick(rows, id_col, vec_col, label_col).toDF("id", "vec", "label")
    whole = F.forall("vec", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    some = F.exists("vec", lambda x: x != 0)
    good = F.coalesce(F.col("label").isNotNull() & F.col("id").isNotNull() & whole & some, F.lit(False))
    return rows.withColumn("h", F.when(good, F.xxhash64("label", "vec"))).withColumn("k", F.when(good, F.xxhash64(F.lit(1), "vec", "label")))


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """node, label, vec, copies, least (id), h, k for every different vector of a label; equality of digests is verified."""
    met = rows.where("h is not null").groupBy("h", "k").agg(F.count("*").alias("copies"), F.min("id").alias("least"), F.min(F.struct("label", "vec")).alias("x"), F.max(F.struct("label", "vec")).alias("y"))
    same = F.when(F.col("x") == F.col("y"), F.col("x.vec")).otherwise(F.raise_error(F.lit("two vectors share both digests")).cast(rows.schema["vec"].dataType))
    return met.select("h", "k", "copies", "least", F.col("x.label").alias("label"), same.alias("vec"), F.monotonically_increasing_id().alias("node"))


def _top(ids: np.ndarray, sims: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, ...]:
    """The NEIGHBOURS nearest from RELAXED on of each of ``rows``: a, b, cosine."""
    keep, sims = min(NEIGHBOURS, sims.shape[1]), sims[rows]
    best = np.argpartition(-sims, keep - 1, axis=1)[:, :keep]
    i, j = np.repeat(np.arange(len(rows)), keep), best.ravel()
    near = sims[i, j] >= RELAXED
    return ids[rows[i[near]]], ids[j[near]], sims[i[near], j[near]]


def _forest(roots: np.ndarray, near: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of roots that hold together all that the links of a block hold together: fewer than it has roots."""
    crossing, pairs = near & (roots[:, None] != roots[None, :]), []
    if not crossing.any():
        return pairs
    names, own = np.unique(roots, return_inverse=True)
    seen = np.zeros(len(names), bool)
    for first in np.unique(own[crossing.any(1)]).tolist():
        todo = [] if seen[first] else [first]
        seen[first] = True
        while todo:
            g = todo.pop()
            for v in np.flatnonzero(own == g):
                for w in np.unique(own[crossing[v] & ~seen[own]]).tolist():
                    seen[w] = True
                    pairs.append((names[g], names[w]))
                    todo.append(w)
    return pairs


def _compare(block: pd.DataFrame) -> pd.DataFrame:
    """Lists of the nearest in a block, for vectors whose list isn't full of links yet, and ties between roots that its links join."""
    ids, first = np.unique(block["node"].to_numpy(), return_index=True)
    roots, open_ = block["root"].to_numpy()[first], ~block["saturated"].to_numpy()[first]
    x = _unit([block["vec"].iat[i] for i in first])
    sims = x @ x.T
    np.fill_diagonal(sims, -1)
    a, b, cosine = _top(ids, sims, np.flatnonzero(open_))
    ties = np.array(_forest(roots, sims >= THRESHOLD), np.int64).reshape(-1, 2)
    tie = np.repeat([False, True], [len(a), len(ties)])
    return pd.DataFrame({"a": np.append(a, ties[:, 0]), "b": np.append(b, ties[:, 1]), "cosine": np.append(cosine, np.ones(len(ties))), "tie": tie})


def _codes(seed: int):
    """Signs of random projections: TABLES codes of PLANES bits for each vector."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for _, part in b.groupby(b["vec"].map(len)) if len(b) else []:
                x = _unit(part["vec"])
                planes = np.random.default_rng([seed, x.shape[1]]).standard_normal((x.shape[1], TABLES * PLANES))
                bits = ((x @ planes) > 0).reshape(len(x), TABLES, PLANES)
                codes = (bits << np.arange(PLANES)).sum(2)
                out.append(pd.DataFrame({"node": part["node"], "label": part["label"], "dim": x.shape[1], "codes": list(codes)}))
            yield pd.concat(out) if out else pd.DataFrame({"node": [], "label": [], "dim": [], "codes": []})

    return run


def first_lists(nodes: DataFrame, seed: int) -> DataFrame:
    """Edges of starting lists, and ties: vectors that random planes put on the same sides are compared in blocks of about BLOCK.

    A label takes as many planes as leave about BLOCK vectors together. Where more of them
    stay together, as copies do, chance parts them, in each table anew; no block grows.
    """
    kind = f"node long, label {nodes.schema['label'].dataType.simpleString()}, dim int, codes array<long>"
    coded = nodes.select("node", "label", "vec").mapInPandas(_codes(seed), kind)
    sizes = nodes.groupBy("label", F.size("vec").alias("dim")).agg(F.count("*").alias("n"))
    planes = F.greatest(F.lit(0), F.least(F.lit(PLANES), F.ceil(F.log2(F.col("n") / BLOCK)))).cast("int")
    coded = coded.join(sizes.select("label", "dim", planes.alias("planes")), ["label", "dim"])
    spread = coded.select("node", "label", "dim", "planes", F.posexplode("codes").alias("t", "code")).where((F.col("t") == 0) | (F.col("planes") > 0))
    spread = spread.withColumn("code", F.col("code").bitwiseAND(F.expr("shiftleft(1L, planes)") - 1)).drop("planes")
    spread = materialize(spread)
    key = ["label", "dim", "t", "code"]
    full = spread.groupBy(key).agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    blocks = spread.join(full, key).withColumn("part", F.pmod(F.xxhash64("node", "t", F.lit(seed)), F.col("parts")))
    return blocks.join(nodes.select("node", "vec", "root", "saturated"), "node").groupBy(*key, "part").applyInPandas(_compare, FOUND)


def nearest(edges: DataFrame) -> DataFrame:
    """Lists of the NEIGHBOURS nearest that ``edges`` name."""
    best = Window.partitionBy("a").orderBy(F.desc("cosine"), "b")
    one = edges.groupBy("a", "b").agg(F.max("cosine").alias("cosine"))
    return one.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= NEIGHBOURS).drop("nth")


def descend(nodes: DataFrame, lists: DataFrame, turn: int) -> DataFrame:
    """Edges and ties among the neighbours, either way, of each vector: neighbours of neighbours.

    Around a vector that very many have as neighbour, members are parted by chance into
    groups of about LOCAL, in each round anew. Where all members have full lists and one
    component, nothing is left to find.
    """
    own = lists.select(F.col("a").alias("v"), F.col("b").alias("node"))
    around = own.union(own.select(F.col("node").alias("v"), F.col("v").alias("node"))).distinct()
    around = around.join(nodes.select("node", "root", "saturated"), "node")
    full = around.groupBy("v").agg(F.ceil(F.count("*") / LOCAL).alias("parts"), (~F.bool_and("saturated") | (F.min("root") < F.max("root"))).alias("open"))
    parted = around.join(full.where("open").drop("open"), "v").withColumn("part", F.pmod(F.xxhash64("node", F.lit(turn)), F.col("parts")))
    return parted.join(nodes.select("node", "vec"), "node").groupBy("v", "part").applyInPandas(_compare, FOUND)


def tied(placed: DataFrame, ties: DataFrame) -> DataFrame:
    """``placed`` with the roots that ``ties`` (a, b: roots) make."""
    if ties.isEmpty():
        return placed
    roots = connected_components(ties).toDF("root", "new")
    return materialize(placed.join(roots, "root", "left").withColumn("root", F.coalesce("new", "root")).select(placed.columns))


def marked(placed: DataFrame, lists: DataFrame) -> DataFrame:
    """``placed`` with ``saturated`` where a list is full of links: further neighbours can't stand in it."""
    links = lists.where(F.col("cosine") >= THRESHOLD).groupBy(F.col("a").alias("node")).agg(F.count("*").alias("n")).where(F.col("n") >= NEIGHBOURS)
    return materialize(placed.drop("saturated").join(links, "node", "left").withColumn("saturated", F.col("n").isNotNull()).select(placed.columns))


def audit(placed: DataFrame, draws: int, first: int, last: int) -> tuple[DataFrame, int, int]:
    """Compare the vectors of draws ``first`` to ``last`` (of ``draws``, parted by chance) with all others.

    ``placed`` has node, label, vec and root. Gives ties (a, b: roots of the components that
    links of these vectors join), how many vectors have links, and how many of these have
    all of them in their own component. The vectors reach the driver, being some ``AUDIT`` a
    draw.
    """
    spark = placed.sparkSession
    draw = F.pmod(F.xxhash64("node", F.lit(1)), F.lit(draws))
    by_key: dict = {}
    for r in placed.where(draw.between(first, last)).select("node", "label", "vec", "root").toLocalIterator():
        by_key.setdefault((r["label"], len(r["vec"])), []).append((r["node"], r["root"], np.array(r["vec"], np.float64)))
    sent = spark.sparkContext.broadcast({k: (np.array([n for n, _, _ in v]), np.array([x for _, x, _ in v]), _unit(pd.Series([x for _, _, x in v]))) for k, v in by_key.items()})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for key, part in b.groupby([b["label"], b["vec"].map(len)]) if len(b) else []:
                if key not in sent.value:
                    continue
                ids, own, x = sent.value[key]
                a, root, sims = part["node"].to_numpy(), part["root"].to_numpy(), _unit(part["vec"]) @ x.T
                near = (sims >= THRESHOLD) & (a[:, None] != ids[None, :])
                some = near.any(0)
                yield pd.DataFrame({"node": ids[some], "a": own[some], "b": own[some]})
                i, j = np.nonzero(near & (root[:, None] != own[None, :]))
                yield pd.DataFrame({"node": ids[j], "a": own[j], "b": root[i]}).drop_duplicates()

    met = materialize(placed.select("node", "label", "vec", "root").mapInPandas(run, "node long, a long, b long").distinct())
    sent.unpersist()
    r = met.agg(F.count_distinct("node").alias("linked"), F.count_distinct(F.when(F.col("a") != F.col("b"), F.col("node"))).alias("short")).first()
    return met.where("a <> b").select("a", "b").distinct(), r["linked"], r["linked"] - r["short"]


def _count(group: pd.DataFrame) -> pd.DataFrame:
    """Links between two tiles of a component, counted for each member with the copies that stand for it."""
    left, right = group[group["side"] == 0], group[group["side"] == 1]
    same = group["i"].iat[0] == group["j"].iat[0]
    right = left if same else right
    if left.empty or right.empty:
        return pd.DataFrame({"node": [], "links": []})
    near = _unit(left["vec"]) @ _unit(right["vec"]).T >= THRESHOLD
    near &= left["node"].to_numpy()[:, None] != right["node"].to_numpy()[None, :]
    rows = [pd.DataFrame({"node": left["node"].to_numpy(), "links": near @ right["copies"].to_numpy()})]
    if not same:
        rows.append(pd.DataFrame({"node": right["node"].to_numpy(), "links": near.T @ left["copies"].to_numpy()}))
    return pd.concat(rows)


def count_links(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """node, links: a saturated list is enlarged to its whole component, in tiles; links only join members of one.

    Tiles send counts, never pairs. A component of m vectors is m² / TILE² comparisons of
    tiles, which is the one part that grows with the square of a group.
    """
    sizes = roots.groupBy("root").agg(F.ceil(F.count("*") / TILE).alias("tiles"))
    placed = roots.join(sizes, "root").withColumn("tile", F.pmod(F.xxhash64("node", F.lit(2)), F.col("tiles")))
    placed = placed.join(nodes.select("node", "vec", "copies"), "node")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))
    met = placed.select("*", other.alias("other"))
    met = met.select("root", "node", "vec", "copies", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), (F.col("tile") > F.col("other")).cast("int").alias("side"))
    return met.groupBy("root", "i", "j").applyInPandas(_count, "node long, links long").groupBy("node").agg(F.sum("links").alias("links"))


def near_vectors(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """A row per row: id, n_links, component_id, kept.

    Vectors of the same label and length link from a cosine of THRESHOLD on. Vectors that
    are null, empty or zero, or hold null or non-finite components, and rows whose label or
    id is null, link with nothing; their component_id is their id. Equal vectors are one
    node, with as many links more. Rows that repeat an id are rows of their own. An empty
    table gives no rows; other columns, whatever their names, are left out.

    Each search gives lists of neighbours and ties between components; a vector whose list
    is full of links gets no longer list then, but counts over its whole component
    (:func:`count_links`), so that links of a dense group are never written as pairs.
    """
    rows = materialize(vectors(rows, id_col, vec_col, label_col))
    nodes = materialize(distinct_vectors(rows))
    placed = materialize(nodes.select("node", "label", "vec", F.col("node").alias("root"), F.lit(False).alias("saturated")))
    lists, at, draws = None, 0, max(1, math.ceil(nodes.count() / AUDIT))
    for seed in range(REPEATS):
        met = materialize(first_lists(placed, seed))
        found = met.where("not tie").drop("tie")
        lists = materialize(nearest(found if lists is None else found.union(lists)))
        placed, size = marked(tied(placed, met.where("tie").select("a", "b")), lists), -1
        for turn in range(ROUNDS):
            met = materialize(descend(placed, lists, turn + seed * ROUNDS))
            lists = materialize(nearest(lists.union(met.where("not tie").drop("tie"))))
            placed = marked(tied(placed, met.where("tie").select("a", "b")), lists)
            r = lists.agg(F.count("*").alias("n"), F.sum("cosine").alias("s")).first()
            if (r["s"] or 0.0) <= size * 1.001:
                break
            size = r["s"] or 0.0
        # Each search is audited on vectors not drawn before. Where even the last is short, all the others follow, which finds every link.
        step, there, whole, short = 1, 0, 0, False
        begun = at
        while at < draws and (there < ENOUGH and at - begun < LIMIT or short and seed == REPEATS - 1):
            step = step if short and seed == REPEATS - 1 else min(step, LIMIT - at + begun)
            lost, linked, full = audit(placed, draws, at, at + step - 1)
            placed = tied(placed, lost)
            there, whole, at, step = there + linked, whole + full, at + step, min(MOST, step * 4)
            short = short or whole < RECALL * there
        log.info("search %d: %d of %d audited vectors with links have all of them in their component", seed + 1, whole, there)
        if not short or at >= draws:
            break
    many = placed.groupBy("root").agg(F.count("*").alias("n")).where("n > 1").select("root")
    roots = materialize(placed.join(many, "root", "left_semi").select("node", "root"))
    counted = materialize(count_links(nodes, roots))
    least = roots.join(nodes.select("node", "least"), "node").groupBy("root").agg(F.min("least").alias("component_id"))
    named = roots.join(least, "root").join(counted, "node").select("node", "links", "component_id")
    done = nodes.join(named, "node", "left").select("h", "k", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "least").alias("component_id"))
    both = rows.where("h is not null").select("id", "h", "k").join(done, ["h", "k"]).select("id", "n_links", "component_id")
    both = both.union(rows.where("h is null").select("id", F.lit(0).cast("long"), "id"))
    return both.select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
