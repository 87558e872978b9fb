"""M8 / M9: boosted trees evaluated by bit vectors over Arrow batches.

A tree model is a table of nodes (``tree_nodes``, what MLlib writes), and its tests are few: a feature has at most as
many thresholds as bins. For a chunk of rows every distinct test, sorted by feature and threshold, is one vector of
bits, a bit a row. A level of a tree is then a handful of bitwise operations on whole vectors: the rows that reach a
node and pass its test go right. The bits of the levels are the number of the leaf, so no row walks a tree.

Scoring keeps the columns that pass through as Arrow columns. Features and lookups stay what they are in training
(column expressions and broadcast joins), so a scored frame is one narrow stage. Requests are scored in that stage,
too: the trips of a request stay neighbours, and their predictions are put together as they come (no regrouping).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.plans.features import TripFeaturesModel
from tripflow.session import scratch_path

#: Rows of a chunk (a multiple of 64) and the deepest trees evaluated this way: a level has 2**depth vectors.
CHUNK, DEEPEST = 1 << 14, 12


def tree_nodes(model: GBTRegressionModel, path: str | None = None) -> DataFrame:
    """The nodes of a fitted model: ``tree, weight, node, feature, threshold, left, right, prediction, gain, rows``
    (feature -1 at a leaf). A row with a value up to the threshold goes left."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    path = path or scratch_path(spark, f"trees-{uuid.uuid4().hex}")
    model.write().overwrite().save(path)
    weights = spark.createDataFrame([(i, float(w)) for i, w in enumerate(model.treeWeights)], "tree int, weight double")
    n = F.col("nodeData")
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("node"), n["split"]["featureIndex"].alias("feature"),
        F.get(n["split"]["leftCategoriesOrThreshold"], 0).alias("threshold"), n["split"]["numCategories"].alias("categories"),
        n["leftChild"].alias("left"), n["rightChild"].alias("right"), n["prediction"].alias("prediction"), n["gain"].alias("gain"),
        n["rawCount"].alias("rows"))
    # a row for each tree
    return nodes.join(F.broadcast(weights), "tree")


def importance_from_nodes(nodes: DataFrame, names: list[str]) -> DataFrame:
    """O2: (feature, importance) of all features that split: their share of all gain, gains counting rows."""
    named = nodes.sparkSession.createDataFrame(list(enumerate(names)), "index int, name string")
    gains = nodes.where("feature >= 0").groupBy("feature").agg(F.sum(F.col("gain") * F.col("rows")).alias("gain"))
    total = gains.agg(F.sum("gain").alias("total"))
    # one row for each feature of the model
    return gains.crossJoin(F.broadcast(total)).join(F.broadcast(named), F.col("feature") == F.col("index")).select(
        F.col("name").alias("feature"), (F.col("gain") / F.col("total")).alias("importance"))


@dataclass
class Ensemble:
    """Tests sorted by feature and threshold; per tree, level by level, the tests of a complete tree and its leaves."""

    features: np.ndarray
    thresholds: np.ndarray
    tests: list[list[np.ndarray]]
    leaves: list[np.ndarray]

    @classmethod
    def of(cls, model: GBTRegressionModel) -> "Ensemble":
        """From a fitted model: its nodes are metadata of bounded size (trees times 2**(depth + 1))."""
        rows = tree_nodes(model).collect()
        if any((r["categories"] or -1) >= 0 and r["feature"] >= 0 for r in rows):
            raise ValueError("splits by category are not evaluated by bit vectors; the features here are numbers")
        pairs = sorted({(r["feature"], r["threshold"]) for r in rows if r["feature"] >= 0})
        number = {p: k + 1 for k, p in enumerate(pairs)}  # 0 sends every row left
        trees: dict[int, dict] = {}
        for r in rows:
            trees.setdefault(r["tree"], {})[r["node"]] = r
        tests, leaves = [], []
        for k in sorted(trees):
            level, own = [trees[k][0]], []
            while any(r["feature"] >= 0 for r in level):
                if len(own) == DEEPEST:
                    raise ValueError(f"a tree is deeper than {DEEPEST}")
                own.append(np.array([number[r["feature"], r["threshold"]] if r["feature"] >= 0 else 0 for r in level]))
                level = [trees[k][c] if r["feature"] >= 0 else r for r in level for c in (r["left"], r["right"])]
            tests.append(own)
            leaves.append(np.array([r["prediction"] * r["weight"] for r in level]))
        return cls(np.array([f for f, _ in pairs], np.int64), np.array([t for _, t in pairs]), tests, leaves)

    def _bits(self, x: np.ndarray) -> np.ndarray:
        """A vector of 64-bit words for each test: set where a row goes right (values above the threshold, and NaN)."""
        out = np.zeros((len(self.features) + 1, CHUNK // 8), np.uint8)
        for f in np.unique(self.features):
            at = np.flatnonzero(self.features == f)
            right = ~(x[f][None, :] <= self.thresholds[at][:, None])
            packed = np.packbits(right, axis=1)
            out[at + 1, : packed.shape[1]] = packed
        return out.view(np.uint64)

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Predictions of columns ``x`` (features, rows)."""
        out = np.zeros(x.shape[1])
        for lo in range(0, x.shape[1], CHUNK):
            part = x[:, lo : lo + CHUNK]
            n = part.shape[1]
            words = -(-n // 64)
            bits = np.ascontiguousarray(self._bits(part)[:, :words])
            total = np.zeros(n)
            for tests, leaves in zip(self.tests, self.leaves):
                reach = np.full((1, words), ~np.uint64(0))
                leaf = np.zeros(n, np.uint16)
                for depth, test in enumerate(tests):
                    right = reach & bits[test]
                    plane = np.bitwise_or.reduce(right, axis=0).view(np.uint8)
                    leaf = (leaf << np.uint16(1)) | np.unpackbits(plane, count=n)
                    if depth + 1 < len(tests):
                        below = np.empty((2 * len(test), words), np.uint64)
                        np.bitwise_xor(reach, right, out=below[0::2])
                        below[1::2] = right
                        reach = below
                total += leaves[leaf]
            out[lo : lo + n] = total
        return out


class EnsembleScorer:
    """A fitted pipeline (features, boosted trees) as a scorer: ``DataFrame`` -> the same columns and ``prediction``."""

    def __init__(self, model: PipelineModel):
        self.features: TripFeaturesModel = model.stages[0]
        self.ensemble = Ensemble.of(model.stages[-1])
        self._shared = None

    def _featured(self, df: DataFrame, keep: list[str]) -> tuple[DataFrame, list[str], list[str]]:
        """Feature columns of ``df`` beside the kept ones; a kept column with a feature's name travels under another."""
        names = self.features.physical_names()
        taken = {*names, "prediction"}
        carried = [f"__keep_{c}" if c in taken else c for c in keep]
        renamed = df.select("*", *[F.col(c).alias(t) for c, t in zip(keep, carried) if c != t])
        self.features.lookup_tables()  # made once, shared by the copies
        model = self.features.copy()
        model._set(keepCols=carried, featuresCol="")
        return model.transform(renamed).select(*carried, *[F.col(p).cast("double").alias(p) for p in names]), carried, names

    def _broadcast(self, spark):
        if self._shared is None:
            self._shared = spark.sparkContext.broadcast(self.ensemble)
        return self._shared

    def transform(self, df: DataFrame) -> DataFrame:
        """One narrow stage; an existing ``prediction`` is replaced."""
        keep = [c for c in df.columns if c != "prediction"]
        featured, carried, names = self._featured(df, keep)
        shared = self._broadcast(df.sparkSession)
        fields = {f.name: f for f in featured.schema.fields}
        schema = T.StructType([*[fields[c] for c in carried], T.StructField("prediction", T.DoubleType())])

        def run(batches):
            for batch in batches:
                x = np.stack([batch.column(p).to_numpy(zero_copy_only=False) for p in names]) if batch.num_rows else np.zeros((len(names), 0))
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in carried], pa.array(shared.value.predict(x))], names=[*carried, "prediction"])

        scored = featured.mapInArrow(run, schema)
        return scored.select(*[F.col(t).alias(c) for c, t in zip(keep, carried)], "prediction")

    def lookups_are_broadcast(self) -> bool:
        most = self.features.getOrDefault(self.features.broadcastMaxRows)
        return all(rows <= most for _, rows in self.features.lookup_tables().values())

    def score_requests(self, validated: DataFrame, metadata: dict, key: str = "request_id") -> DataFrame:
        """M9, as ``plans.scoring.score_requests``: status, predictions in trip order, model metadata.

        With broadcast lookups nothing moves a row, so the trips of a request are neighbours in a partition and its
        answer is put together there; a request whose trips were separated fails the job instead of answering wrongly.
        Lookups too large for that go the way of the regrouping shuffle. ``key`` may repeat: each row is a request.
        """
        from tripflow.plans.scoring import OK_STATUS, REJECTED_STATUS, neutral_trips, score_requests

        if not self.lookups_are_broadcast():
            return score_requests(validated, self, metadata, key)
        featured, _, names = self._featured(neutral_trips(validated, key, "n_trips"), [key, "valid", "pos", "n_trips"])
        shared = self._broadcast(validated.sparkSession)
        key_type = next(f for f in featured.schema.fields if f.name == key)
        schema = T.StructType([key_type, T.StructField("valid", T.BooleanType()), T.StructField("predictions", T.ArrayType(T.DoubleType()))])

        def run(batches):
            held = []
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = np.stack([batch.column(p).to_numpy(zero_copy_only=False) for p in names])
                score = shared.value.predict(x).tolist()
                keys, ok, out = [], [], []
                for k, valid, pos, n, y in zip(*(batch.column(c).to_pylist() for c in (key, "valid", "pos", "n_trips")), score):
                    if pos is None:
                        keys.append(k)
                        ok.append(valid)
                        out.append([])
                        continue
                    if pos != len(held) or (held and held[-1][0] != k):
                        raise RuntimeError(f"the trips of request {k} were separated")
                    held.append((k, y))
                    if len(held) == n:
                        keys.append(k)
                        ok.append(True)
                        out.append([v for _, v in held])
                        held = []
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, batch.column(key).type), pa.array(ok, pa.bool_()), pa.array(out, pa.list_(pa.float64()))],
                    names=[key, "valid", "predictions"])
            if held:
                raise RuntimeError(f"the trips of request {held[0][0]} were separated")

        answers = featured.mapInArrow(run, schema)
        return answers.select(
            key, F.when(F.col("valid"), F.lit(OK_STATUS)).otherwise(F.lit(REJECTED_STATUS)).alias("status"),
            F.when(F.col("valid"), F.col("predictions")).alias("predictions"),
            F.lit(metadata.get("model_name")).cast("string").alias("model_name"),
            F.lit(metadata.get("model_version")).cast("int").alias("model_version"),
            F.lit(metadata.get("model_alias")).cast("string").alias("model_alias"))
