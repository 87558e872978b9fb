"""Embedding near duplicates: exact threshold pairs by dual traversal of cover trees.

On unit vectors a cosine of at least c is a distance of at most t = sqrt(2 - 2 c). A cover tree nests balls whose radii
halve from level to level; two nodes are pruned when their centres are further apart than both covering radii and t,
and linked as a whole when they are nearer than t less both radii. Only node pairs in between are opened.

Equal vectors of a label are one point with a weight. The points of a label are dealt to cells around pivots (a
bounded sample of the points), large cells to chunks by hash. A chunk's points are one tree; points of other cells
come as visitors if the bisecting hyperplane leaves room for a link. Visitors are streamed, so a task holds one chunk
and one batch whatever the label's size. A task returns a row for each linked point (its number of links, one spanning
edge), never the pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import materialise
from tripflow.llm.components import connected_components

THRESHOLD = 0.93
CHUNK = 4000  # points of a tree
MAX_PIVOTS = 4096  # over all labels
LEAF = 24
#: Distances of unit vectors from dot products are good to about 1e-8 near zero; bounds allow for more.
_SLACK, _ROUNDING = 1e-7, 1e-6


class CoverTree:
    """Nested balls over unit vectors: nodes as (centre, covering radius, members, children)."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.nodes: list[tuple[int, float, np.ndarray, np.ndarray]] = []
        self.root = self._node(np.arange(len(x)), self._from(0, np.arange(len(x))))

    def _from(self, centre: int, members: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(2 - 2 * (self.x[members] @ self.x[centre]), 0))

    def _node(self, members: np.ndarray, near: np.ndarray) -> int:
        """A ball around the first member; balls of half its radius cover the members until few are left."""
        radius, children = float(near.max()), []
        # distances from dot products are good to 1e-7, so smaller balls are not split
        if len(members) > LEAF and radius > 1e-6:
            rest = members
            while len(rest):
                # distances of a block of centres at once
                block = self.x[rest[:64]] @ self.x[rest].T
                block = np.sqrt(np.maximum(2 - 2 * block, 0, out=block))
                taken = np.zeros(len(rest), bool)
                for k in range(len(block)):
                    if not taken[k]:
                        inside = (block[k] <= radius / 2) & ~taken
                        inside[k] = True
                        children.append(self._node(rest[inside], block[k][inside]))
                        taken |= inside
                rest = rest[~taken]
        self.nodes.append((members[0], radius + _SLACK, members, np.array(children, np.int64)))
        return len(self.nodes) - 1

    def opened(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Centres and radii of nodes, and which hold one point."""
        some = [self.nodes[k] for k in nodes]
        return np.array([n[0] for n in some], np.int64), np.array([n[1] for n in some]), np.array([len(n[2]) == 1 for n in some])


def dual(left: CoverTree, right: CoverTree, reach: float):
    """Node pairs that may hold links: yields ``(whole, i, j)``, index arrays into both trees.

    With ``whole`` all of i are linked with all of j; otherwise i and j are parallel arrays of pairs to be measured.
    Of a tree with itself each pair comes once.
    """
    itself = left is right
    stack = [(np.array([left.root]), np.array([right.root]), itself)]
    while stack:
        a, b, same = stack.pop()
        ca, ra, one_a = left.opened(a)
        cb, rb, one_b = right.opened(b)
        step = max(1, (1 << 20) // len(b))
        for at in range(0, len(a), step):
            rows = slice(at, at + step)
            d = np.sqrt(np.maximum(2 - 2 * (left.x[ca[rows]] @ right.x[cb].T), 0))
            radii = ra[rows, None] + rb[None, :]
            near = d <= radii + reach + _ROUNDING
            if same:
                near &= np.arange(at, at + len(d))[:, None] <= np.arange(len(b))[None, :]
            points = near & one_a[rows, None] & one_b[None, :]
            if same:
                points[np.arange(len(d)), np.arange(at, at + len(d))] = False  # a point with itself
                near[np.arange(len(d)), np.arange(at, at + len(d))] &= ~one_a[rows]
            i, j = np.nonzero(points)
            if len(i):
                yield False, ca[rows][i], cb[j]
            for i, j in zip(*np.nonzero(near & ~points)):
                x, y = left.nodes[a[at + i]], right.nodes[b[j]]
                own = same and at + i == j
                if not own and d[i, j] + radii[i, j] <= reach - _ROUNDING:
                    yield True, x[2], y[2]
                elif own:
                    if len(x[3]):
                        stack.append((x[3], x[3], True))
                    else:
                        p, q = np.triu_indices(len(x[2]), 1)
                        yield False, x[2][p], x[2][q]
                elif len(x[3]) and (x[1] >= y[1] or not len(y[3])):
                    stack.append((x[3], b[j : j + 1], False))
                elif len(y[3]):
                    stack.append((a[at + i : at + i + 1], y[3], False))
                else:
                    yield False, np.repeat(x[2], len(y[2])), np.tile(y[2], len(x[2]))


class Links:
    """Links found in a task: counts by point, and a spanning forest as the smallest point reached."""

    def __init__(self, n: int):
        self.count, self.root = np.zeros(n, np.int64), np.arange(n)
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, i: np.ndarray, j: np.ndarray, wi: np.ndarray, wj: np.ndarray) -> None:
        np.add.at(self.count, i, wj)
        np.add.at(self.count, j, wi)
        self.join(i, j)

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        self.held.append((i, j))
        self.size += len(i)
        if self.size > 1 << 20:
            self.settle()

    def settle(self) -> None:
        if not self.held:
            return
        i, j = (np.concatenate(x) for x in zip(*self.held))
        while True:
            low = np.minimum(self.root[i], self.root[j])
            if (low == self.root[i]).all() and (low == self.root[j]).all():
                break
            np.minimum.at(self.root, self.root[i], low)
            np.minimum.at(self.root, self.root[j], low)
            while (self.root[self.root] != self.root).any():
                self.root = self.root[self.root]
        self.held, self.size = [], 0


def _linked(links: Links, offsets: tuple[int, int], trees: tuple[CoverTree, CoverTree], raw: tuple, weights: tuple, cosine: float) -> None:
    """Add the links between two sets of points, which are numbered from ``offsets`` on in ``links``."""
    (x, nx), (y, ny), (wx, wy) = raw[0], raw[1], weights
    for whole, i, j in dual(*trees, np.sqrt(2 - 2 * cosine)):
        if whole:
            links.count[offsets[0] + i] += wy[j].sum()
            links.count[offsets[1] + j] += wx[i].sum()
            links.join(np.append(offsets[0] + i, np.full(len(j), offsets[0] + i[0])), np.append(np.full(len(i), offsets[1] + j[0]), offsets[1] + j))
            continue
        for at in range(0, len(i), 1 << 17):
            p, q = i[at : at + (1 << 17)], j[at : at + (1 << 17)]
            ok = np.einsum("ij,ij->i", x[p], y[q]) / (nx[p] * ny[q]) >= cosine
            p, q = p[ok], q[ok]
            links.add(offsets[0] + p, offsets[1] + q, wx[p], wy[q])


_POINT = "vec_id bigint, copies bigint, embedding array<double>"


def _usable() -> Column:
    """Is it a labelled vector of finite numbers that is not zero?"""
    e = F.col("embedding")
    finite = F.forall(e, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    there = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & e.isNotNull()
    return F.coalesce(there & finite & F.exists(e, lambda v: v != 0), F.lit(False))


def _dealt(points: DataFrame, pivots: list[tuple], reach: float) -> DataFrame:
    """Home rows (visit 0) and visits (1) of every point: ``label, size, cell, chunk, visit, point``.

    The home cell is that of the nearest pivot. A point y whose nearest pivot is j lies beyond the bisector of i and j
    from a point x of cell i, so x can only be linked with it if x is within ``reach`` of the bisector. Of two cells
    the smaller-numbered one visits, of two chunks of a cell too.
    """
    by: dict = {}
    for label, embedding in pivots:
        by.setdefault((label, len(embedding)), []).append(embedding)
    unit = {k: np.array(v) / np.linalg.norm(v, axis=1)[:, None] for k, v in by.items()}

    def run(batches):
        for batch in batches:
            labels, vectors = batch.column("label").to_pylist(), batch.column("embedding").to_pylist()
            rows, cells, visits = [], [], []
            for i, (label, v) in enumerate(zip(labels, vectors)):
                p = unit.get((label, len(v)))
                home = 0
                if p is not None:
                    x = np.array(v)
                    d = np.maximum(2 - 2 * (p @ (x / np.linalg.norm(x))), 0)  # squared distances
                    home = int(d.argmin())
                    gap = np.maximum(2 - 2 * (p @ p[home]), 1e-300)
                    beyond = (d - d[home]) / (2 * np.sqrt(gap)) <= reach + _ROUNDING
                    for cell in np.flatnonzero(beyond[home + 1 :]) + home + 1:
                        rows.append(i)
                        cells.append(int(cell))
                        visits.append(1)
                rows.append(i)
                cells.append(home)
                visits.append(0)
            yield pa.RecordBatch.from_arrays(
                [*batch.take(pa.array(rows, pa.int64())).columns, pa.array(cells, pa.int32()), pa.array(visits, pa.int32())],
                names=[*batch.schema.names, "cell", "visit"])

    return points.mapInArrow(run, "label string, vec_id bigint, copies bigint, embedding array<double>, cell int, visit int")


def _task(cosine: float):
    """Links of each (label, size, cell, chunk): its home rows come first, then its visitors, in sorted batches."""

    def run(batches):
        key = home = None
        points: list = []

        def matrix(rows):
            x = np.array([r[2] for r in rows], np.float64)
            norm = np.sqrt(np.einsum("ij,ij->i", x, x))
            return x, norm, np.array([r[1] for r in rows], np.int64), CoverTree(x / norm[:, None])

        def found(links, rows):
            links.settle()
            at = np.flatnonzero(links.count)
            yield pa.RecordBatch.from_pydict({
                "vec_id": pa.array([rows[i][0] for i in at], pa.int64()), "n": pa.array(links.count[at]),
                "peer": pa.array([rows[i][0] for i in links.root[at]], pa.int64())})

        def flush(rows, visiting):
            nonlocal home
            if not rows:
                return
            x, norm, weight, tree = matrix(rows)
            if not visiting:
                home = (rows, x, norm, weight, tree)
                links = Links(len(rows))
                _linked(links, (0, 0), (tree, tree), ((x, norm), (x, norm)), (weight, weight), cosine)
                yield from found(links, rows)
            elif home is not None:
                links = Links(len(home[0]) + len(rows))
                _linked(links, (0, len(home[0])), (home[4], tree), (home[1:3], (x, norm)), (home[3], weight), cosine)
                yield from found(links, home[0] + rows)

        for batch in batches:
            for k, visit, vec_id, copies, v in zip(*(batch.column(c).to_pylist() for c in ("key", "visit", "vec_id", "copies", "embedding"))):
                now = (k, visit)
                if now != key:
                    yield from flush(points, key is not None and key[1] == 1)
                    if key is None or key[0] != k:
                        home = None
                    points, key = [], now
                elif visit and len(points) >= CHUNK // 2:
                    yield from flush(points, True)
                    points = []
                points.append((vec_id, copies, v))
        yield from flush(points, key is not None and key[1] == 1)

    return run


def near_vectors(df: DataFrame, cosine: float = THRESHOLD, chunk: int = CHUNK) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``df`` (vec_id, embedding, label).

    Two vectors are linked if their labels are equal, their lengths too, and their cosine in double precision reaches
    the threshold. Null labels, ids and vectors, zero vectors and ones with a null or non-finite component link with
    nothing: they have no links and are a component of their own (with a null id, a null one). Equal vectors are
    linked with each other; a repeated row is a vector of its own. An empty table gives no rows.
    """
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
                     F.col("embedding").cast("array<double>").alias("embedding"))
    usable = rows.where(_usable())
    points = materialise(usable.groupBy("label", "embedding").agg(F.count("*").alias("copies"), F.min("vec_id").alias("vec_id"))
                         .select("label", "vec_id", "copies", "embedding"), "points")
    sizes = materialise(points.groupBy("label").agg(F.count("*").alias("n_label")), "labels")
    total = sizes.agg(F.sum("n_label").alias("n")).first()["n"] or 0
    every = max(chunk, -(-total // MAX_PIVOTS))
    drawn = F.pmod(F.xxhash64("vec_id", F.lit("pivot")), F.lit(every)) == 0
    pivots = [(r["label"], r["embedding"]) for r in points.where(drawn).select("label", "embedding").collect()]
    cells = materialise(_dealt(points, sorted(pivots, key=lambda p: (p[0], p[1])), float(np.sqrt(2 - 2 * cosine))), "dealt")

    homes = cells.where("visit = 0")
    counts = homes.groupBy("label", F.size("embedding").alias("size"), "cell").agg(F.count("*").alias("n")).withColumn(
        "chunks", F.ceil(F.col("n") / chunk).cast("int"))
    placed = cells.withColumn("size", F.size("embedding")).join(counts.drop("n"), ["label", "size", "cell"]).withColumn(
        "own", F.pmod(F.xxhash64("vec_id", F.lit("chunk")), F.col("chunks")).cast("int"))
    # at home to one chunk, a visitor to the chunks behind it; from other cells a visitor to all chunks
    first = F.when(F.col("visit") == 0, F.col("own")).otherwise(F.lit(0))
    placed = placed.withColumn("chunk", F.explode(F.sequence(first, F.col("chunks") - 1))).withColumn(
        "visit", F.when((F.col("visit") == 0) & (F.col("chunk") == F.col("own")), 0).otherwise(1))
    key = F.to_json(F.struct("label", "size", "cell", "chunk"))
    tasks = placed.select(key.alias("key"), "visit", "vec_id", "copies", "embedding")
    found = materialise(tasks.repartition("key").sortWithinPartitions("key", "visit", "vec_id").mapInArrow(
        _task(cosine), "vec_id bigint, n bigint, peer bigint"), "links")

    counted = found.groupBy("vec_id").agg(F.sum("n").alias("n"))
    parts = connected_components(found.select(F.col("vec_id").alias("a"), F.col("peer").alias("b")))
    result = points.select("label", "embedding", "copies", F.col("vec_id").alias("rep")).join(
        counted.withColumnRenamed("vec_id", "rep"), "rep", "left").join(parts.withColumnRenamed("id", "rep"), "rep", "left").select(
        "label", "embedding", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    able = usable.join(result, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    able = able.withColumn("kept", F.col("vec_id") == F.col("component_id"))
    other = rows.where(~_usable()).select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    return able.unionByName(other)


def op6_embedding_near_duplicates(spark, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings."""
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP6_SQL = f"""
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
    AND len(list_filter(embedding, lambda v: v <> 0)) > 0
), links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
  WHERE list_dot_product(x.e, y.e) / (sqrt(list_dot_product(x.e, x.e)) * sqrt(list_dot_product(y.e, y.e))) >= {THRESHOLD}
), reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links,
  least(vec_id, coalesce((SELECT min(b) FROM reach WHERE a = vec_id), vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce((SELECT min(b) FROM reach WHERE a = vec_id), vec_id)) AS kept
FROM embeddings"""
