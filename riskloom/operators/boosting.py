"""Boosted trees of all members in one barrier stage (L3, L4).

Boosting needs the sums of every tree level before the next one can start.  As
Spark jobs that is one job per level, round and member: hundreds of starts of a
job, however small the table.  Here every task of one barrier stage holds its
rows as numbered bins, sums them per node and bin, exchanges these sums with the
others and takes the same splits as they do: one exchange per level for all
members together.  ``allGather`` takes a second each time, so the tasks agree on
a folder by it once and exchange their sums as files of the shared checkpoint
folder, each of which is removed when all have read it.  A task holds about 100
bytes a row and a member; a file has at most 2^depth nodes, whatever the rows.

Loss, splits and stopping rules are those of MLlib's ``GBTClassifier`` (log
loss, weighted variance, equal-frequency bins, leaves at no gain), and the trees
are written as its saved model, so that loading, scoring and importances are
MLlib's own.  The bins are cut from the quantiles of all rows.
"""

from __future__ import annotations

import json
import os
import re
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import BarrierTaskContext, inheritable_thread_target
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

#: Steps of the quantile grid that bins are cut from, and its relative error.
GRID, ACCURACY = 2_000, 20_000
#: Seconds that a task waits for the sums of another.
PATIENCE = 3600
#: Impurity under which a node is not divided.
LEAST = 1e-14
NODES = ("member int, treeID int, nodeData struct<id:int,prediction:double,impurity:double,impurityStats:array<double>,"
         "rawCount:bigint,gain:double,leftChild:int,rightChild:int,"
         "split:struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,numCategories:int>>")


@dataclass(frozen=True)
class Settings:
    rounds: int
    depth: int
    step: float
    subsample: float
    min_rows: int
    seed: int


def settings(est: GBTClassifier) -> Settings:
    return Settings(est.getMaxIter(), est.getMaxDepth(), est.getStepSize(), est.getSubsamplingRate(),
                    est.getMinInstancesPerNode(), est.getSeed())


def barrier_slots(sc) -> int:
    """Tasks that run at once, by the settings that name them."""
    conf, known = sc.getConf(), [sc.defaultParallelism]
    one = int(conf.get("spark.task.cpus", "1"))
    cluster = re.match(r"local-cluster\[\s*(\d+)\s*,\s*(\d+)", sc.master)
    if cluster:
        known.append(int(cluster[1]) * (int(cluster[2]) // one))
    elif conf.get("spark.executor.instances") and conf.get("spark.executor.cores"):
        known.append(int(conf.get("spark.executor.instances")) * (int(conf.get("spark.executor.cores")) // one))
    return max(1, min(known))


def cut_points(values, weights, max_bins: int) -> list[float]:
    """MLlib's rule: midpoints of all distinct values if they are few, else of
    the values next to equal steps of the weight."""
    v, at = np.unique(np.asarray(values, dtype=np.float64), return_inverse=True)
    w = np.bincount(at, weights=weights, minlength=len(v))
    if len(v) <= max_bins:
        return ((v[:-1] + v[1:]) / 2).tolist()
    total = np.cumsum(w)
    target = total[-1] / max_bins * np.arange(1, max_bins)
    k = np.minimum(np.searchsorted(total, target), len(v) - 2)
    near = np.where((k > 0) & (np.abs(total[k - 1] - target) <= np.abs(total[k] - target)), k - 1, k)
    return ((v[near] + v[near + 1]) / 2)[np.unique(near, return_index=True)[1]].tolist()


def thresholds(rows: DataFrame, n_features: int, positive_weight: float, max_bins: int) -> list[list[float]]:
    """Cut points per feature from the quantiles of all rows of either class
    (``x``, ``y``), the positive ones weighing ``positive_weight``."""
    grid = [k / GRID for k in range(GRID + 1)]
    got = rows.groupBy("y").agg(F.count(F.lit(1)).alias("n"), *[
        F.percentile_approx(F.col("x")[k], grid, ACCURACY).alias(f"q{k}") for k in range(n_features)]).collect()
    out = []
    for k in range(n_features):
        values = np.concatenate([r[f"q{k}"] for r in got])
        weights = np.concatenate([np.full(len(r[f"q{k}"]), r["n"] * (positive_weight if r["y"] == 1 else 1.0)) for r in got])
        out.append(cut_points(values, weights, max_bins))
    return out


class Trees:
    """One member's state in a task: its rows' margins and the tree that grows."""

    def __init__(self, s: Settings, bins: list[np.ndarray], y: np.ndarray, weight: float, cuts: list[list[float]], part: int):
        self.s, self.bins, self.y, self.cuts, self.part = s, bins, y, cuts, part
        self.w = np.where(y == 1, weight, 1.0)
        self.weight, self.margin, self.done = weight, np.zeros(len(y)), []
        self.flat = np.concatenate(bins) if bins else np.zeros(0, np.uint8)
        self.own = np.arange(len(y))

    def start(self, m: int) -> None:
        """The targets of tree ``m`` and the rows that it is grown on."""
        sign = 2.0 * self.y - 1.0
        self.target = sign if m == 0 else 4 * sign / (1 + np.exp(np.clip(2 * sign * self.margin, -700, 700)))
        self.slot, self.value = np.zeros(len(self.y), dtype=np.int64), np.zeros(len(self.y))
        self.nodes, self.active = [{}], [0]
        self.take = None
        if self.s.subsample < 1:
            rng = np.random.default_rng((self.s.seed, m, self.part))
            self.take = np.flatnonzero(rng.random(len(self.y)) < self.s.subsample)
        of = (lambda a: a) if self.take is None else (lambda a: a[self.take])
        self.grown = [of(b) for b in self.bins]
        self.positive, self.pull = of(self.y).astype(np.int64), of(self.w * self.target)
        self.square = self.pull * of(self.target)

    def sums(self, level: int) -> np.ndarray:
        """Per active node its sum of squares, then per feature, node and bin
        the negative rows, the positive rows and the weighted targets; of the
        lowest level's nodes the totals alone."""
        a = len(self.active)
        if not a:
            return np.zeros(0)
        slot = self.slot if self.take is None else self.slot[self.take]
        out = [np.bincount(slot, weights=self.square, minlength=a + 1)[:a]]
        for bins, cuts in zip(self.grown, self.cuts):
            width = len(cuts) + 1
            if level == self.s.depth:
                bins, width = 0, 1
            key = slot * width + bins
            size = (a + 1) * width
            both = np.bincount(key + size * self.positive, minlength=2 * size)
            out += [both[:a * width], both[size:size + a * width], np.bincount(key, weights=self.pull, minlength=size)[:a * width]]
            if level == self.s.depth:
                break
        return np.concatenate(out).astype(np.float64)

    def split(self, level: int, sums: np.ndarray) -> None:
        """Divides the active nodes by the sums of all tasks; rows of a node
        that is not divided get its mean."""
        a = len(self.active)
        if not a:
            return
        square, at, best = sums[:a], a, None
        for f, cuts in enumerate(self.cuts):
            width = 1 if level == self.s.depth else len(cuts) + 1
            neg, pos, pull = (sums[at + k * a * width:at + (k + 1) * a * width].reshape(a, width) for k in range(3))
            at += 3 * a * width
            if best is None:
                raw, total = (neg + pos).sum(axis=1), pull.sum(axis=1)
                w = neg.sum(axis=1) + self.weight * pos.sum(axis=1)
                safe = np.where(w > 0, w, 1.0)
                mean, impurity = total / safe, np.maximum(square / safe - (total / safe) ** 2, 0.0)
                best, feature, cut = np.full(a, LEAST), np.full(a, -1), np.zeros(a, dtype=np.int64)
            if width == 1:
                if level == self.s.depth:
                    break
                continue
            n, s = np.cumsum(neg + pos, axis=1)[:, :-1], np.cumsum(pull, axis=1)[:, :-1]
            left = np.cumsum(neg + self.weight * pos, axis=1)[:, :-1]
            right = w[:, None] - left
            ok = (n >= self.s.min_rows) & (raw[:, None] - n >= self.s.min_rows) & (left > 0) & (right > 0)
            gain = s * s / np.where(ok, left, 1.0) + (total[:, None] - s) ** 2 / np.where(ok, right, 1.0)
            gain = np.where(ok, (gain - (total * mean)[:, None]) / safe[:, None], -np.inf)
            k = gain.argmax(axis=1)
            here = gain[np.arange(a), k]
            better = (here > best) & (impurity > LEAST)
            best, feature, cut = np.where(better, here, best), np.where(better, f, feature), np.where(better, k, cut)
        follow, places = [], np.full(a + 1, -1, dtype=np.int64)
        leaf = np.zeros(a + 1)
        for i, node in enumerate(self.active):
            d = self.nodes[node]
            d.update(prediction=float(mean[i]), impurity=float(impurity[i]), raw=int(raw[i]),
                     stats=[float(w[i]), float(total[i]), float(square[i])])
            if feature[i] < 0:
                leaf[i] = mean[i]
                continue
            d.update(gain=float(best[i]), feature=int(feature[i]), threshold=self.cuts[feature[i]][cut[i]],
                     left=len(self.nodes), right=len(self.nodes) + 1)
            places[i] = len(follow)
            follow += [d["left"], d["right"]]
            self.nodes += [{}, {}]
        # Rows of finished nodes stay in the last slot, which no sum reads.
        asks, upto = np.append(np.maximum(feature, 0), 0), np.append(cut, 0)
        self.value += leaf[self.slot]
        goes_right = self.flat[asks[self.slot] * len(self.y) + self.own] > upto[self.slot]
        to = places[self.slot]
        self.slot = np.where(to < 0, len(follow), to + goes_right)
        self.active = follow

    def finish(self, m: int) -> None:
        self.margin += (1.0 if m == 0 else self.s.step) * self.value
        self.done.append(self.nodes)


def node_rows(nodes: list[dict]) -> list[dict]:
    """A tree as MLlib's node table: numbered from the root, left before right,
    leaves of one prediction merged."""
    def merged(i: int) -> bool:
        d = nodes[i]
        if "left" not in d:
            return True
        both = merged(d["left"]), merged(d["right"])  # both sides, whatever the first gives
        if all(both) and nodes[d["left"]]["prediction"] == nodes[d["right"]]["prediction"]:
            del d["left"]
            return True
        return False

    def put(i: int) -> int:
        d, own = nodes[i], len(out)
        row = dict(id=own, prediction=d["prediction"], impurity=d["impurity"], impurityStats=d["stats"], rawCount=d["raw"],
                   gain=-1.0, leftChild=-1, rightChild=-1,
                   split=dict(featureIndex=-1, leftCategoriesOrThreshold=[], numCategories=-1))
        out.append(row)
        if "left" in d:
            row.update(gain=d["gain"], split=dict(featureIndex=d["feature"], leftCategoriesOrThreshold=[d["threshold"]], numCategories=-1))
            row["leftChild"] = put(d["left"])
            row["rightChild"] = put(d["right"])
        return own

    out: list[dict] = []
    merged(0)
    put(0)
    return out


class Exchange:
    """Sums of equal length of all tasks of a stage, added up in the same order by each."""

    def __init__(self, folder: str, part: int, parts: int):
        self.fs, self.folder = shared_fs(folder)
        self.part, self.parts, self.turn = part, parts, 0
        self.fs.create_dir(self.folder)

    def path(self, turn: int, part: int) -> str:
        return f"{self.folder}/{turn}-{part}"

    def read(self, part: int) -> np.ndarray:
        path, wait, late = self.path(self.turn, part), 0.0005, time.monotonic() + PATIENCE
        while self.fs.get_file_info(path).type == pafs.FileType.NotFound:
            if time.monotonic() > late:
                raise TimeoutError(f"no sums of task {part} in {self.folder}: is the checkpoint folder shared?")
            time.sleep(wait)
            wait = min(wait * 1.5, 0.02)
        with self.fs.open_input_stream(path) as f:
            return np.frombuffer(f.read())

    def total(self, own: np.ndarray) -> np.ndarray:
        path = self.path(self.turn, self.part)
        with self.fs.open_output_stream(path + ".part") as f:
            f.write(own.tobytes())
        self.fs.move(path + ".part", path)
        out = np.zeros(len(own))
        for part in range(self.parts):
            out += own if part == self.part else self.read(part)
        if self.turn:  # whoever wrote for this turn has read the last one
            self.fs.delete_file(self.path(self.turn - 1, self.part))
        self.turn += 1
        return out


def shared_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """The Arrow file system of a shared folder (file, hdfs, s3, gs) and the path in it."""
    if "://" not in uri or uri.startswith("file:"):
        return pafs.LocalFileSystem(), re.sub("^file:/*", "/", uri)
    return pafs.FileSystem.from_uri(uri)


def grow(rows: DataFrame, members: list[Settings], cuts: list[list[float]], weight: float, folder: str) -> DataFrame:
    """``member, treeID, nodeData`` of all members' trees from the rows (``x``,
    ``y``), in one barrier stage; its tasks meet in ``folder``."""
    def boost(batches):
        context = BarrierTaskContext.get()
        part, xs, ys = context.partitionId(), [], []
        # A stage that runs again meets elsewhere.
        names = context.allGather(uuid.uuid4().hex)
        exchange = Exchange(f"{folder}/{names[0]}", part, len(names))
        for b in batches:
            if b.num_rows:
                values = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, len(cuts))
                xs.append(np.array([np.searchsorted(c, values[:, k], side="left") for k, c in enumerate(cuts)], dtype=np.uint8))
                ys.append(b.column(1).to_numpy(zero_copy_only=False).astype(np.int8))
        table = np.concatenate(xs, axis=1) if xs else np.zeros((len(cuts), 0), np.uint8)
        y = np.concatenate(ys) if ys else np.zeros(0, np.int8)
        state = [Trees(s, list(table), y, weight, cuts, part) for s in members]
        for m in range(max(s.rounds for s in members)):
            at_work = [t for t in state if m < t.s.rounds]
            for t in at_work:
                t.start(m)
            for level in range(max(t.s.depth for t in at_work) + 1):
                busy = [t for t in at_work if t.active]
                if not busy:
                    break
                own = [t.sums(level) for t in busy]
                total, ends = exchange.total(np.concatenate(own)), np.cumsum([len(o) for o in own])
                for t, sums in zip(busy, np.split(total, ends[:-1])):
                    t.split(level, sums)
            for t in at_work:
                t.finish(m)
        if part == 0:
            for k, t in enumerate(state):
                for tree, nodes in enumerate(t.done):
                    found = [dict(member=k, treeID=tree, nodeData=d) for d in node_rows(nodes)]
                    yield pa.RecordBatch.from_pylist(found, schema=out_schema)

    leaf = pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())), ("numCategories", pa.int32())])
    node = pa.struct([("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()),
                      ("impurityStats", pa.list_(pa.float64())), ("rawCount", pa.int64()), ("gain", pa.float64()),
                      ("leftChild", pa.int32()), ("rightChild", pa.int32()), ("split", leaf)])
    out_schema = pa.schema([("member", pa.int32()), ("treeID", pa.int32()), ("nodeData", node)])
    return rows.mapInArrow(boost, NODES, barrier=True)


def _described(cls: str, uid: str, given: dict, defaults: dict, **more) -> str:
    from pyspark import __version__
    return json.dumps({"class": cls, "timestamp": int(time.time() * 1000), "sparkVersion": __version__, "uid": uid,
                       "paramMap": given, "defaultParamMap": defaults, **more})


def saved_model(spark, est: GBTClassifier, nodes: DataFrame, n_features: int, path: str) -> GBTClassificationModel:
    """The trees (``treeID, nodeData``) written as ``est``'s saved model and loaded."""
    given = {p.name: est.getOrDefault(p) for p in est.params if est.isSet(p)}
    defaults = {p.name: est.getOrDefault(p.name) if not est.isSet(p) else est._defaultParamMap[p]
                for p in est.params if est.hasDefault(p)}
    of_tree = [p.name for p in est.params if p.name in {
        "cacheNodeIds", "checkpointInterval", "featuresCol", "impurity", "labelCol", "leafCol", "maxBins", "maxDepth", "maxMemoryInMB",
        "minInfoGain", "minInstancesPerNode", "minWeightFractionPerNode", "predictionCol", "seed", "weightCol"}]
    tree = "org.apache.spark.ml.regression.DecisionTreeRegressionModel"
    trees = [(k, _described(tree, f"dtr_{uuid.uuid4().hex[:12]}", {n: given[n] for n in of_tree if n in given},
                            {n: defaults[n] for n in of_tree if n in defaults}), 1.0 if k == 0 else est.getStepSize())
             for k in range(est.getMaxIter())]
    head = _described("org.apache.spark.ml.classification.GBTClassificationModel", est.uid, given, defaults,
                      numFeatures=n_features, numTrees=len(trees))
    spark.createDataFrame([(head,)], "value string").coalesce(1).write.text(os.path.join(path, "metadata"))
    spark.createDataFrame(trees, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(os.path.join(path, "treesMetadata"))
    nodes.select("treeID", "nodeData").coalesce(1).write.parquet(os.path.join(path, "data"))
    return GBTClassificationModel.load(path)


def fit_boosted(ready: DataFrame, members: list[GBTClassifier], n_features: int, positive_weight: float) -> list[GBTClassificationModel]:
    """The members' models, fitted together.  ``ready``: their features and
    label columns; positive rows weigh ``positive_weight``, the others 1."""
    spark, first = ready.sparkSession, members[0]
    rows = ready.select(vector_to_array(first.getFeaturesCol()).alias("x"), F.col(first.getLabelCol()).cast("tinyint").alias("y"))
    cuts = thresholds(rows, n_features, positive_weight, first.getMaxBins())
    path = scratch_path(spark, "models", "boosted", uuid.uuid4().hex)
    slots = barrier_slots(spark.sparkContext)
    if ready.rdd.getNumPartitions() > slots:  # all tasks of the stage run at once
        rows = rows.repartition(slots)
    grow(rows, [settings(m) for m in members], cuts, positive_weight, os.path.join(path, "sums")).write.parquet(os.path.join(path, "nodes"))
    nodes = spark.read.parquet(os.path.join(path, "nodes"))
    save = inheritable_thread_target(spark)(lambda k: saved_model(
        spark, members[k], nodes.where(F.col("member") == k), n_features, os.path.join(path, str(k))))
    with ThreadPoolExecutor(len(members)) as pool:
        return list(pool.map(save, range(len(members))))
