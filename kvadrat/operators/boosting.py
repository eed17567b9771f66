"""Boosted trees on compact rows.

Spark's ``GBTRegressor`` holds an int for every feature of every row, some hundred of them where labels are one-hot,
and passes over all of them for each level of each tree. Here a row is one small code for each numeric column (its
bin) and each category (its label), since of the one-hot features of a category only one is not zero: the
statistics of all its features follow from one count by label. The trees are those that ``GBTRegressor`` grows:
the same thresholds (from all values, not from a sample of them), variance gains, losses, weights and limits,
each level one pass over the rows; only random draws (rows and features of a stochastic booster) are other ones.

Rows stay in blocks in the session's cache (memory, then disk), the errors of the last round beside them; a pass is a job, and errors
are checkpointed every ``CHECKPOINT_ROUNDS``. Up to ``TASK_ROWS`` rows the same passes are made inside one task. What is fitted is Spark's own ``GBTRegressionModel``.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, SparkContext, StorageLevel
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.serializers import PairDeserializer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kvadrat.session import checkpoint_dir, ship_package

#: Rows of a block, which are worked on at once, and about the rows of a partition.
BLOCK_ROWS, PARTITION_ROWS = 1 << 16, 1 << 20
#: Distinct values of a column from which values close to each other are counted together.
MOST_VALUES = 1 << 16
#: Bytes of the statistics of the nodes of one pass, and of all partitions together where the driver adds them up.
PASS_BYTES, DRIVER_BYTES = 1 << 26, 1 << 26
#: Up to so many rows one task makes all passes: it needs less time for one than Spark for a job.
TASK_ROWS = 1 << 19
CHECKPOINT_ROUNDS = 20
ORDERED, ONE_HOT, NOMINAL = "ordered", "one_hot", "nominal"


@dataclass(frozen=True)
class Field:
    """A column of codes. ``feature``: its place in the feature vector (of its first label, if one-hot)."""

    kind: str
    feature: int
    bins: int
    thresholds: tuple = ()

    @property
    def features(self) -> int:
        return self.bins - 1 if self.kind == ONE_HOT else 1  # an unseen label is no feature


# ---------------------------------------------------------------------------
# bins of numeric columns
# ---------------------------------------------------------------------------


def thresholds(low: np.ndarray, high: np.ndarray, n: np.ndarray, most: int) -> list[float]:
    """At most ``most`` thresholds between the values (groups of values from ``low`` to ``high``, in order) that
    ``n`` rows have each: all of them or, as Spark does, those nearest to equal shares of the rows."""
    middle = [(float(a) + float(b)) / 2 for a, b in zip(high[:-1], low[1:])]
    if len(middle) > most:
        stride, found, seen = float(n.sum()) / (most + 1), [], float(n[0])
        target = stride
        for i in range(1, len(n)):
            before, seen = seen, seen + float(n[i])
            if abs(before - target) < abs(seen - target):
                found.append(middle[i - 1])
                target += stride
        middle = found
    return [t for t in middle if not math.isnan(t)]


def _value_counts(df: DataFrame, columns: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(lowest, highest, rows) of the values of each column in order, from all rows; of a column with more than
    ``MOST_VALUES`` of them, values that agree in about three digits are one group."""
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("double").alias("v")) for i, c in enumerate(columns)]))
    counts = df.select(each.alias("_e")).groupBy("_e.i", "_e.v").agg(F.count(F.lit(1)).alias("n")).persist()
    distinct = {r["i"]: r["count"] for r in counts.groupBy("i").count().collect()}
    many = [i for i, k in distinct.items() if k > MOST_VALUES]
    size = F.when(F.col("v") != 0, F.floor(F.log2(F.abs("v")) * 1024)).otherwise(F.lit(0))
    near = F.when(F.col("i").isin(many), F.signum("v") * size).otherwise(F.lit(0.0)) if many else F.lit(0.0)
    own = F.when(~F.col("i").isin(many), F.col("v")) if many else F.col("v")
    groups = counts.groupBy("i", own.alias("own"), F.signum("v").alias("sign"), near.alias("near")).agg(
        F.min("v").alias("low"), F.max("v").alias("high"), F.sum("n").alias("n"))
    rows = groups.select("i", "low", "high", "n").collect()
    counts.unpersist()
    out = []
    for i in range(len(columns)):
        mine = sorted((r for r in rows if r["i"] == i), key=lambda r: (math.isnan(r["low"]), r["low"]))
        out.append(tuple(np.array([r[k] for r in mine], dtype=float) for k in ("low", "high", "n")))
    return out


def _labels(df: DataFrame, column: str) -> int:
    """Labels of an indexed column, the one for unseen labels among them."""
    attributes = df.schema[column].metadata["ml_attr"]
    return len(attributes["vals"]) if "vals" in attributes else int(attributes["num_vals"])


# ---------------------------------------------------------------------------
# trees
# ---------------------------------------------------------------------------


@dataclass
class Tree:
    """Nodes in the order of their making, the root first; ``child`` is the left one and the right one follows it, a
    leaf is its own child. Row lists ``right[node]`` tell which codes of the split's field go right."""

    n: list = field(default_factory=list)
    total: list = field(default_factory=list)
    squares: list = field(default_factory=list)
    gain: list = field(default_factory=list)
    child: list = field(default_factory=list)
    split: list = field(default_factory=list)  # (field, bin or labels that go left), None for a leaf
    levels: int = 0

    def add(self, n: float, total: float) -> int:
        self.n.append(n), self.total.append(total), self.squares.append(0.0), self.gain.append(-1.0)
        self.child.append(len(self.child)), self.split.append(None)
        return len(self.n) - 1

    def prediction(self) -> np.ndarray:
        n = np.array(self.n)
        return np.where(n > 0, np.array(self.total) / np.maximum(n, 1), 0.0)

    def walk(self, fields: list[Field]) -> tuple:
        """Arrays by which rows find their nodes: (levels, field, child, place in the table, table of right turns)."""
        wide = max(f.bins for f in fields)
        table, place, fields_ = [np.zeros(wide, np.uint8)], [], []
        at = wide
        for split in self.split:
            if split is None:
                place.append(0), fields_.append(0)
                continue
            f, left = split
            right = np.ones(fields[f].bins, np.uint8)
            if fields[f].kind == ORDERED:
                right[: left + 1] = 0
            elif fields[f].kind == ONE_HOT:  # the feature of a label: one goes right
                right[:] = 0
                right[left] = 1
            else:
                right[left] = 0
            table.append(right), place.append(at), fields_.append(f)
            at += fields[f].bins
        return self.levels, np.array(fields_), np.array(self.child), np.array(place), np.concatenate(table)


def nodes_of(codes: np.ndarray, walk: tuple) -> np.ndarray:
    levels, fields, child, place, table = walk
    node, rows = np.zeros(codes.shape[1], np.int64), np.arange(codes.shape[1])
    for _ in range(levels):
        node = child[node] + table[place[node] + codes[fields[node], rows]]
    return node


def statistics(codes: np.ndarray, node: np.ndarray, target: np.ndarray, m: int, bins: list[int]) -> np.ndarray:
    """(m, 2 x all bins): rows, and the sum of their targets, by node and code."""
    out, at, width = np.empty((m, 2 * sum(bins))), 0, sum(bins)
    for i, b in enumerate(bins):
        key = node * b
        key += codes[i]
        out[:, at : at + b] = np.bincount(key, minlength=m * b).reshape(m, b)
        out[:, width + at : width + at + b] = np.bincount(key, target, minlength=m * b).reshape(m, b)
        at += b
    return out


def best_splits(stats: np.ndarray, fields: list[Field], least: int, allowed: np.ndarray | None = None) -> list[tuple]:
    """For each node (gain, field, bin or labels that go left, rows left, sum left) of its best split, the first of
    equal ones in the order of features; gain 0 if there is none. ``allowed``: the features of each node."""
    m, width = stats.shape[0], stats.shape[1] // 2
    total_n, total_s = None, None
    gains, lefts, owners, at = [], [], [], 0
    for i, f in enumerate(fields):
        n, s = stats[:, at : at + f.bins], stats[:, width + at : width + at + f.bins]
        at += f.bins
        if total_n is None:
            total_n, total_s = n.sum(1)[:, None], s.sum(1)[:, None]
        order = None
        if f.kind == ORDERED:
            ln, ls = np.cumsum(n, 1)[:, :-1], np.cumsum(s, 1)[:, :-1]
        elif f.kind == ONE_HOT:
            ln, ls = total_n - n[:, :-1], total_s - s[:, :-1]
        else:
            order = np.argsort(np.where(n > 0, s / np.maximum(n, 1), np.inf), axis=1, kind="stable")
            ln = np.cumsum(np.take_along_axis(n, order, 1), 1)[:, :-1]
            ls = np.cumsum(np.take_along_axis(s, order, 1), 1)[:, :-1]
        rn, rs = total_n - ln, total_s - ls
        ok = (ln >= max(least, 1)) & (rn >= max(least, 1))
        if allowed is not None:
            ok &= allowed[:, f.feature : f.feature + f.features] if f.kind == ONE_HOT else allowed[:, f.feature : f.feature + 1]
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(ok, (ls * ls / ln + rs * rs / rn - total_s * total_s / total_n) / total_n, 0.0)
        gains.append(gain), lefts.append((ln, ls, order)), owners.append((i, gain.shape[1]))
    every = np.concatenate(gains, 1)
    best = every.argmax(1)
    ends = np.cumsum([k for _, k in owners])
    out = []
    for node in range(m):
        which = int(np.searchsorted(ends, best[node], side="right"))
        i, k = owners[which]
        place = int(best[node] - (ends[which] - k))
        ln, ls, order = lefts[which]
        left = order[node, : place + 1].copy() if order is not None else place
        gain = float(every[node, best[node]])
        # differences that only rounding makes are no gain
        if gain <= 1e-13 * float(total_s[node, 0] / max(total_n[node, 0], 1)) ** 2:
            gain = 0.0
        out.append((gain, i, left, float(ln[node, place]), float(ls[node, place])))
    return out


# ---------------------------------------------------------------------------
# boosting
# ---------------------------------------------------------------------------


def _target(error: np.ndarray, first: bool, loss: str) -> np.ndarray:
    """What a tree fits: the first one the label, the others the negative gradient of the loss."""
    if first:
        return error
    return 2 * error if loss == "squared" else np.where(error < 0, -1.0, 1.0)


def _drawn(seed: int, rate: float, part: int, block: int, n: int) -> np.ndarray | None:
    return None if rate >= 1 else np.random.default_rng([seed, part, block]).random(n) < rate


def _zipped(a: RDD, b: RDD) -> RDD:
    """Pairs of two frames of one element a partition; ``RDD.zip`` would write both anew for that."""
    return RDD(a._jrdd.zip(b._jrdd), a.ctx, PairDeserializer(a._jrdd_deserializer, b._jrdd_deserializer))


@dataclass(frozen=True)
class Settings:
    rounds: int
    step: float
    loss: str
    deepest: int
    least: int
    seed: int
    rate: float
    strategy: str


class JobPasses:
    """Passes over rows in the session's cache, one job each. Errors are checkpointed now and then."""

    def __init__(self, codes: RDD, errors: RDD):
        self.codes, self.errors, self.before, self.kept, self.steps = codes, errors, None, None, 0
        self.parts = codes.getNumPartitions()

    def step(self, walk: tuple, prediction: np.ndarray) -> None:
        def less(blocks):
            return [[e - prediction[nodes_of(c, walk)] for c, e in zip(cs, es)] for cs, es in blocks]

        new = _zipped(self.codes, self.errors).mapPartitions(less, preservesPartitioning=True).persist(StorageLevel.MEMORY_AND_DISK)
        self.steps += 1
        if self.steps % CHECKPOINT_ROUNDS == 0:
            new.checkpoint()
        self.before, self.errors = self.errors, new

    def every(self, passed, walk: tuple) -> list:
        """Results of ``passed`` for all partitions."""

        def run(part, blocks):
            return [passed(part, ((c, e, nodes_of(c, walk)) for cs, es in blocks for c, e in zip(cs, es)))]

        got = _zipped(self.codes, self.errors).mapPartitionsWithIndex(run).collect()
        self._made()
        return got

    def splits(self, passed, walk: tuple, m: int, node_bytes: int, chosen) -> list[tuple]:
        """Splits of nodes whose statistics are too many for the driver: nodes are dealt to tasks that add them up."""
        size = max(1, (1 << 20) // node_bytes)

        def pieces(part, blocks):
            out = passed(part, ((c, e, nodes_of(c, walk)) for cs, es in blocks for c, e in zip(cs, es)))[0]
            return [(i // size, out[i : i + size]) for i in range(0, m, size)]

        summed = _zipped(self.codes, self.errors).mapPartitionsWithIndex(pieces).reduceByKey(np.add, min(self.parts, math.ceil(m / size)))
        got = dict(summed.map(lambda piece: (piece[0], chosen(piece[1], piece[0] * size))).collect())
        return [s for k in sorted(got) for s in got[k]]

    def _made(self) -> None:
        """The errors are in the cache: drops those before, and the checkpoint before."""
        if self.before is not None:
            self.before.unpersist()
            self.before = None
            if self.errors.isCheckpointed():
                old, self.kept = self.kept, self.errors.getCheckpointFile()
                _delete(self.codes.ctx, old)

    def end(self) -> None:
        self.codes.unpersist(), self.errors.unpersist()
        _delete(self.codes.ctx, self.kept)


class TaskPasses:
    """Passes inside one task over rows so few that a job would cost more than the pass."""

    parts = 1

    def __init__(self, blocks: list):
        self.codes, self.errors = [c for c, _ in blocks], [e for _, e in blocks]
        self.nodes: list = []
        self.level = -1

    def step(self, walk: tuple, prediction: np.ndarray) -> None:
        self._to(walk)
        self.errors = [e - prediction[node] for e, node in zip(self.errors, self.nodes)]
        self.level = -1

    def _to(self, walk: tuple) -> None:
        levels, fields, child, place, table = walk
        if self.level < 0:
            self.nodes, self.level = [np.zeros(len(e), np.int64) for e in self.errors], 0
        while self.level < levels:
            for i, (c, node) in enumerate(zip(self.codes, self.nodes)):
                self.nodes[i] = child[node] + table[place[node] + c[fields[node], np.arange(len(node))]]
            self.level += 1

    def every(self, passed, walk: tuple) -> list:
        self._to(walk)
        return [passed(0, zip(self.codes, self.errors, self.nodes))]

    def splits(self, passed, walk: tuple, m: int, node_bytes: int, chosen) -> list[tuple]:
        return chosen(self.every(passed, walk)[0][0], 0)


def boost(rows: JobPasses | TaskPasses, fields: list[Field], s: Settings) -> tuple[list[Tree], list[float]]:
    """Trees and their weights."""
    trees: list[Tree] = []
    weights: list[float] = []
    for r in range(s.rounds):
        former = (trees[-1], weights[-1]) if trees else None
        if former:
            rows.step(former[0].walk(fields), former[0].prediction() * former[1])
        trees.append(_grow(rows, fields, s, r, former))
        weights.append(s.step if r else 1.0)
    _last_squares(rows, trees[-1], fields, s)
    return trees, weights


def _features_of_nodes(strategy: str, m: int, width: int, rng: np.random.Generator) -> np.ndarray | None:
    if strategy in ("all", "auto"):
        return None
    k = math.ceil(float(strategy) * width)
    allowed = np.zeros((m, width), bool)
    for row in allowed:
        row[rng.permutation(width)[:k]] = True
    return allowed


def _last_squares(rows, tree: Tree, fields: list[Field], s: Settings) -> None:
    r, m = s.rounds - 1, len(tree.n)

    def squares(part, blocks):
        out = np.zeros(m)
        for i, (_, e, node) in enumerate(blocks):
            out += _leaf_squares(node, _target(e, r == 0, s.loss), _drawn(s.seed + r, s.rate, part, i, len(e)), m)
        return out

    _fill_squares(tree, sum(rows.every(squares, tree.walk(fields))))


def _grow(rows, fields: list[Field], s: Settings, r: int, former: tuple[Tree, float] | None) -> Tree:
    """One tree. The first pass also fills in the squares of the tree before, whose errors it can restore."""
    seed, rng = s.seed + r, np.random.default_rng([s.seed + r, 1])
    bins = [f.bins for f in fields]
    width, codes = fields[-1].feature + fields[-1].features, sum(bins)
    node_bytes = 16 * codes
    most = max(1, PASS_BYTES // node_bytes)
    tree = Tree()
    active = [tree.add(0.0, 0.0)]
    while active and tree.levels < s.deepest:
        walk, found = tree.walk(fields), []
        for begin in range(0, len(active), most):
            some = active[begin : begin + most]
            m = len(some)
            place = np.full(len(tree.n), -1, np.int64)
            place[some] = np.arange(m)
            allowed = _features_of_nodes(s.strategy, m, width, rng)
            back = (former[0].walk(fields), former[0].prediction() * former[1], len(former[0].n)) if former and tree.levels == 0 else None

            def passed(part, blocks, place=place, m=m, back=back, loss=s.loss, rate=s.rate):
                out, squares = np.zeros((m, 2 * codes)), None if back is None else np.zeros(back[2])
                for i, (c, e, node) in enumerate(blocks):
                    if back is not None:
                        at = nodes_of(c, back[0])
                        squares += _leaf_squares(at, _target(e + back[1][at], r == 1, loss), _drawn(seed - 1, rate, part, i, len(e)), back[2])
                    node, target = place[node], _target(e, r == 0, loss)
                    keep, drawn = node >= 0, _drawn(seed, rate, part, i, len(e))
                    if drawn is not None:
                        keep &= drawn
                    if not keep.all():
                        keep = np.flatnonzero(keep)
                        c, node, target = c[:, keep], node[keep], target[keep]
                    out += statistics(c, node, target, m, bins)
                return out, squares

            def chosen(stats, at, allowed=allowed):
                return best_splits(stats, fields, s.least, None if allowed is None else allowed[at : at + len(stats)])

            if tree.levels == 0 or rows.parts * m * node_bytes <= DRIVER_BYTES:
                got = rows.every(passed, walk)
                stats = sum(g[0] for g in got)
                if back is not None:
                    _fill_squares(former[0], sum(g[1] for g in got))
                if tree.levels == 0:
                    tree.n[0], tree.total[0] = float(stats[0, : bins[0]].sum()), float(stats[0, codes : codes + bins[0]].sum())
                found += chosen(stats, 0)
            else:
                found += rows.splits(passed, walk, m, node_bytes, chosen)
        tree.levels += 1
        following = []
        for node, (gain, f, left, n, total) in zip(active, found):
            if gain <= 0:
                continue
            tree.gain[node], tree.split[node] = gain, (f, left)
            rest = tree.n[node] - n, tree.total[node] - total
            tree.child[node] = tree.add(n, total)
            tree.add(*rest)
            # fewer rows cannot be parted again
            following += [c for c in (tree.child[node], tree.child[node] + 1) if tree.n[c] >= 2 * max(s.least, 1)]
        active = following
    return tree


class CompactGBTRegressor(GBTRegressor):
    """``GBTRegressor`` that grows its trees on the columns the feature vector was assembled of: ``numeric`` ones, then
    ``categories`` (indexed labels), as one-hot features or as nominal ones."""

    def on(self, numeric: list[str], categories: list[str], one_hot: bool) -> "CompactGBTRegressor":
        self._numeric, self._categories, self._one_hot = numeric, categories, one_hot
        return self

    def _fields(self, df: DataFrame) -> tuple[list[Field], int]:
        """Fields of the rows, and how many rows there are."""
        counts = _value_counts(df, self._numeric)
        rows = int(counts[0][2].sum())
        most = min(self.getMaxBins(), rows) - 1
        out = []
        for low, high, n in counts:
            cut = thresholds(low, high, n, most)
            out.append(Field(ORDERED, len(out), len(cut) + 1, tuple(cut)))
        at = len(out)
        for c in self._categories:
            out.append(Field(ONE_HOT if self._one_hot else NOMINAL, at, _labels(df, c)))
            at += out[-1].features
        return out, rows

    def _blocks(self, df: DataFrame, fields: list[Field], parts: int) -> RDD:
        """(codes, labels) of the rows, a list of blocks a partition."""
        df = df.select(*self._numeric, *self._categories, F.col(self.getLabelCol()).cast("double"))
        have = df.rdd.getNumPartitions()
        df = df.repartition(parts) if have < parts else df.coalesce(parts) if have > parts else df
        cuts, wide = [np.array(f.thresholds) for f in fields if f.kind == ORDERED], max(f.bins for f in fields)
        kind = np.uint8 if wide <= 1 << 8 else np.uint16 if wide <= 1 << 16 else np.uint32
        block_rows, k = BLOCK_ROWS, len(fields)

        def packed(batches):
            held, n = [], 0

            def block():
                table = pa.Table.from_batches(held)
                columns = [c.to_numpy() for c in table.columns]
                codes = np.empty((k, table.num_rows), kind)
                for i, c in enumerate(columns[:-1]):
                    codes[i] = np.searchsorted(cuts[i], c, side="left") if i < len(cuts) else c
                return pa.record_batch([pa.array([codes.tobytes()], pa.binary()), pa.array([columns[-1].tobytes()], pa.binary())], ["codes", "labels"])

            for batch in batches:
                held.append(batch)
                n += batch.num_rows
                if n >= block_rows:
                    yield block()
                    held, n = [], 0
            if n:
                yield block()

        return df.mapInArrow(packed, "codes binary, labels binary").rdd.mapPartitions(
            lambda rs: [[(np.frombuffer(r[0], kind).reshape(k, -1), np.frombuffer(r[1])) for r in rs]])

    def _fit(self, dataset: DataFrame) -> GBTRegressionModel:
        spark = dataset.sparkSession
        ship_package(spark)
        fields, rows = self._fields(dataset)
        s = Settings(self.getMaxIter(), self.getStepSize(), self.getLossType(), self.getMaxDepth(), self.getMinInstancesPerNode(), self.getSeed(),
                     self.getSubsamplingRate(), self.getFeatureSubsetStrategy())
        parts = max(spark.sparkContext.defaultParallelism, math.ceil(rows / PARTITION_ROWS))
        both = self._blocks(dataset, fields, parts).persist(StorageLevel.MEMORY_AND_DISK)
        if rows <= TASK_ROWS:
            both.count()  # packed by all tasks
            trees, weights = both.coalesce(1).mapPartitions(lambda held: [boost(TaskPasses([b for part in held for b in part]), fields, s)]).first()
            both.unpersist()
        else:
            codes = both.map(lambda blocks: [c for c, _ in blocks]).persist(StorageLevel.MEMORY_AND_DISK)
            labels = both.map(lambda blocks: [y for _, y in blocks]).persist(StorageLevel.MEMORY_AND_DISK)
            codes.count(), labels.count()
            both.unpersist()
            passes = JobPasses(codes, labels)
            trees, weights = boost(passes, fields, s)
            passes.end()
        return self._model(spark, trees, weights, fields, fields[-1].feature + fields[-1].features)

    def _model(self, spark: SparkSession, trees: list[Tree], weights: list[float], fields: list[Field], width: int) -> GBTRegressionModel:
        """Spark's model, from files as its writer leaves them."""
        path = f"{checkpoint_dir(spark)}/booster-{uuid.uuid4().hex}"
        given = {p.name: v for p, v in self._paramMap.items()}
        default = {p.name: v for p, v in self._defaultParamMap.items()}
        about = dict(timestamp=int(time.time() * 1000), sparkVersion=spark.version)
        meta = {"class": "org.apache.spark.ml.regression.GBTRegressionModel", **about, "uid": self.uid, "paramMap": given,
                "defaultParamMap": default, "numFeatures": width, "numTrees": len(trees)}
        tree_meta = lambda: json.dumps(
            {"class": "org.apache.spark.ml.regression.DecisionTreeRegressionModel", **about, "uid": f"dtr_{uuid.uuid4().hex[:12]}",
             "paramMap": {k: given[k] for k in ("maxDepth", "seed") if k in given},
             "defaultParamMap": {k: v for k, v in default.items() if k in TREE_PARAMS}})
        spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.text(f"{path}/metadata")
        spark.createDataFrame([(i, tree_meta(), float(w)) for i, w in enumerate(weights)], "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
        rows = [row for i, tree in enumerate(trees) for row in _node_rows(i, tree, fields)]
        struct = pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())), ("numCategories", pa.int32())])
        node = pa.struct([("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())),
                          ("rawCount", pa.int64()), ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()), ("split", struct)])
        table = pa.table({"treeID": pa.array([r[0] for r in rows], pa.int32()), "nodeData": pa.array([r[1] for r in rows], node)})
        spark.createDataFrame(table).write.parquet(f"{path}/data")
        model = GBTRegressionModel.load(path)
        _delete(spark.sparkContext, path)
        return model


TREE_PARAMS = {"cacheNodeIds", "checkpointInterval", "featuresCol", "impurity", "labelCol", "leafCol", "maxBins", "maxDepth", "maxMemoryInMB",
               "minInfoGain", "minInstancesPerNode", "minWeightFractionPerNode", "predictionCol"}


def _leaf_squares(node: np.ndarray, target: np.ndarray, drawn: np.ndarray | None, m: int) -> np.ndarray:
    if drawn is not None:
        node, target = node[drawn], target[drawn]
    return np.bincount(node, target * target, minlength=m)


def _fill_squares(tree: Tree, leaves: np.ndarray) -> None:
    """Sums of squares of leaves, and of the nodes above: children come after their parent."""
    tree.squares = [float(x) for x in leaves]
    for i in range(len(tree.n) - 1, -1, -1):
        if tree.split[i] is not None:
            tree.squares[i] = tree.squares[tree.child[i]] + tree.squares[tree.child[i] + 1]


def _node_rows(number: int, tree: Tree, fields: list[Field]) -> list[tuple[int, dict]]:
    """The tree's nodes as Spark stores them, numbered from the root, left before right. A split into leaves
    that predict the same is none, as in Spark."""
    prediction, same = tree.prediction(), [False] * len(tree.n)
    for i in range(len(tree.n) - 1, -1, -1):
        if tree.split[i] is None:
            same[i] = True
        else:
            a, b = tree.child[i], tree.child[i] + 1
            same[i] = same[a] and same[b] and prediction[a] == prediction[b]
    rows: list[tuple[int, dict]] = []
    waiting = [(0, None, None)]
    while waiting:
        i, above, side = waiting.pop()
        n, mean = tree.n[i], float(prediction[i])
        node = len(rows)
        if above is not None:
            rows[above][1][side] = node
        leaf = same[i]
        if leaf:
            split = {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1}
        else:
            f, left = tree.split[i]
            if fields[f].kind == ORDERED:
                split = {"featureIndex": fields[f].feature, "leftCategoriesOrThreshold": [fields[f].thresholds[left]], "numCategories": -1}
            elif fields[f].kind == ONE_HOT:
                split = {"featureIndex": fields[f].feature + left, "leftCategoriesOrThreshold": [0.5], "numCategories": -1}
            else:
                split = {"featureIndex": fields[f].feature, "leftCategoriesOrThreshold": [float(x) for x in left], "numCategories": fields[f].bins}
        impurity = max(0.0, (tree.squares[i] - tree.total[i] * mean) / n) if n else 0.0
        rows.append((number, {
            "id": node, "prediction": mean, "impurity": impurity, "impurityStats": [n, tree.total[i], tree.squares[i]], "rawCount": int(n),
            "gain": -1.0 if leaf else tree.gain[i], "leftChild": -1, "rightChild": -1, "split": split}))
        if not leaf:
            waiting += [(tree.child[i] + 1, node, "rightChild"), (tree.child[i], node, "leftChild")]
    return rows


def _delete(sc: SparkContext, path: str | None) -> None:
    """Drops a scratch folder of this fit."""
    if path:
        at = sc._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)
