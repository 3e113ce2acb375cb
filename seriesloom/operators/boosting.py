"""Boosted regression trees, one model per series, all series in the same jobs.

Features become bin numbers by per-series quantiles, once. A level of a tree needs only
the sums of residuals by (node, feature, bin). A series of at most ``task_rows`` rows grows its
trees inside one task; a longer one is stored in chunks, and each level is one job in which
every chunk adds up its bins and the best split of a node is chosen per block of features.
Residuals are rounded to whole multiples of a small unit first, so sums do not depend on
their order and both ways give the same trees.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.group_ops import PandasCogroupedOps

from seriesloom.operators.filters import cast_features
from seriesloom.session import cut_lineage

BINS = 64
#: Longest series that one task takes whole, rows of a chunk, and rows scored at a time.
TASK_ROWS, CHUNK_ROWS, SCORE_ROWS = 200_000, 100_000, 50_000
#: Residuals are counted in this share of the series' range.
UNIT = 2.0**-20
#: Features of a block in which a split is chosen; rounds after which margins are stored.
BLOCK, STORE_EVERY = 8, 10

NODE = "round int, node int, feature int, bin int, cut double, value double, gain double, n long"
_NODE_TYPES = pa.schema([
    ("round", pa.int32()), ("node", pa.int32()), ("feature", pa.int32()), ("bin", pa.int32()),
    ("cut", pa.float64()), ("value", pa.float64()), ("gain", pa.float64()), ("n", pa.int64()),
])


@dataclass(frozen=True)
class Rules:
    rounds: int
    depth: int
    rate: float
    min_rows: int
    l2: float

    def step(self, round_: int) -> float:
        """The first tree counts in full."""
        return self.rate if round_ else 1.0


# ---- the work of one task ------------------------------------------------------------


def to_bins(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bin numbers, one row per feature: values up to edges[b] are in bins up to b; NaN is last."""
    return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)]).astype(np.uint8)


def histograms(bins: np.ndarray, place: np.ndarray, residual: np.ndarray, nodes: int):
    """Sums and counts by (node, feature, bin) of the rows of ``bins`` with a place >= 0."""
    use = place >= 0
    if not use.all():
        bins, place, residual = bins[:, use], place[use], residual[use]
    sums = np.empty((nodes, len(bins), BINS))
    counts = np.empty((nodes, len(bins), BINS))
    base = place * BINS
    for j, own in enumerate(bins):
        at = base + own
        sums[:, j] = np.bincount(at, residual, nodes * BINS).reshape(nodes, BINS)
        counts[:, j] = np.bincount(at, minlength=nodes * BINS).reshape(nodes, BINS)
    return sums, counts


def best_splits(sums: np.ndarray, counts: np.ndarray, rules: Rules):
    """Gain, feature, bin, left sum and left count of each node's best split (gain 0: none).

    Of equal gains the first feature and bin win. Gains are in squared residual units.
    """
    left, n_left = sums.cumsum(2), counts.cumsum(2)
    total, n = left[:, :1, -1:], n_left[:, :1, -1:]
    right, n_right = total - left, n - n_left
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left**2 / (n_left + rules.l2) + right**2 / (n_right + rules.l2) - total**2 / (n + rules.l2)
    gain[(n_left < rules.min_rows) | (n_right < rules.min_rows)] = 0
    flat = gain.reshape(len(gain), -1)
    best = flat.argmax(1)
    at = np.arange(len(gain))
    feature, bin_ = np.divmod(best, BINS)
    return flat[at, best], feature, bin_, left[at, feature, bin_], n_left[at, feature, bin_]


def placed(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, depth: int) -> np.ndarray:
    """The node (root 1, children 2i and 2i + 1) that each row reaches; leaves have feature -1."""
    node = np.ones(bins.shape[1], np.int64)
    rows = np.arange(bins.shape[1])
    for _ in range(depth):
        f = feature[node]
        right = bins[f, rows] > cut[node]
        node = np.where(f >= 0, 2 * node + right, node)
    return node


def grow(bins: np.ndarray, residual: np.ndarray, rules: Rules):
    """feature, bin, sum, count, gain per node of one tree, and each row's leaf."""
    size = 2 << rules.depth
    feature, cut = np.full(size, -1), np.zeros(size, np.int64)
    total, n, gains = np.zeros(size), np.zeros(size, np.int64), np.zeros(size)
    total[1], n[1] = residual.sum(), len(residual)
    node = np.ones(len(residual), np.int64)
    rows = np.arange(len(residual))
    for level in range(rules.depth):
        first = 1 << level
        place = np.where(node >= first, node - first, -1)
        gain, f, b, left, n_left = best_splits(*histograms(bins, place, residual, first), rules)
        good = np.flatnonzero(gain > 0)
        at = first + good
        feature[at], cut[at], gains[at] = f[good], b[good], gain[good]
        total[2 * at], n[2 * at] = left[good], n_left[good]
        total[2 * at + 1], n[2 * at + 1] = total[at] - left[good], n[at] - n_left[good]
        own = feature[node]
        node = np.where(own >= 0, 2 * node + (bins[own, rows] > cut[node]), node)
    return feature, cut, total, n, gains, node


def fit_series(x: np.ndarray, y: np.ndarray, base: float, scale: float, edges: list[np.ndarray], rules: Rules) -> list[tuple]:
    """Rows of NODE; round -1 has the base value."""
    bins = to_bins(x, edges)
    out = [(-1, 1, -1, 0, 0.0, base, 0.0, len(y))]
    margin = np.full(len(y), base)
    unit = scale * UNIT
    for t in range(rules.rounds):
        residual = np.rint((y - margin) / unit)
        feature, cut, total, n, gains, node = grow(bins, residual, rules)
        value = rules.step(t) * (total / np.maximum(n, 1) * unit)
        for k in np.flatnonzero(n).tolist():
            f = int(feature[k])
            at = float(edges[f][cut[k]]) if f >= 0 else 0.0
            out.append((t, k, f, int(cut[k]), at, float(value[k]), float(gains[k]) * unit**2, int(n[k])))
        margin += value[node]
    return out


class Trees:
    """A series' trees as arrays."""

    def __init__(self, nodes: dict[str, np.ndarray]):
        order = np.lexsort((nodes["node"], nodes["round"]))
        nodes = {k: v[order] for k, v in nodes.items()}
        self.base = float(nodes["value"][nodes["round"] < 0].sum())
        self.trees = []
        for t in np.unique(nodes["round"][nodes["round"] >= 0]):
            use = nodes["round"] == t
            size = 2 << int(nodes["node"][use].max()).bit_length() - 1
            feature, cut, bin_, value = np.full(size, -1), np.zeros(size), np.zeros(size, np.int64), np.zeros(size)
            at = nodes["node"][use]
            feature[at], cut[at], value[at], bin_[at] = (nodes[k][use] for k in ("feature", "cut", "value", "bin"))
            self.trees.append((feature, cut, bin_, value, size.bit_length() - 2))

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Rows of features; missing values go right."""
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, _, value, depth in self.trees:
            node = np.ones(len(x), np.int64)
            for _ in range(depth):
                f = feature[node]
                node = np.where(f >= 0, 2 * node + ~(x[rows, f] <= cut[node]), node)
            out += value[node]
        return out

    def add_margins(self, bins: np.ndarray, margin: np.ndarray) -> np.ndarray:
        for feature, _, bin_, value, depth in self.trees:
            margin = margin + value[placed(bins, feature, bin_, depth)]
        return margin


def _matrix(table: pa.Table, cols: Sequence[str]) -> np.ndarray:
    out = np.empty((table.num_rows, len(cols)))
    for j, c in enumerate(cols):
        out[:, j] = table.column(c).to_numpy()  # nulls become NaN
    return out


def _nodes(table: pa.Table) -> Trees:
    return Trees({c: table.column(c).to_numpy() for c in ("round", "node", "feature", "bin", "cut", "value")})


def _edges(row: dict, n: int) -> list[np.ndarray]:
    """Distinct finite edges of each feature, in order."""
    return [np.unique(np.array(row[f"__e{j}"] or [], np.float64)) for j in range(n)]


# ---- jobs ----------------------------------------------------------------------------


def together(left: DataFrame, right: DataFrame, *on: str) -> PandasCogroupedOps:
    """Cogroup tables that may stem from one another: the right side's columns are named anew."""
    right = right.select(*(F.col(c).alias(c) for c in right.columns))
    return left.groupBy(*on).cogroup(right.groupBy(*on))


@dataclass(frozen=True)
class Boosted:
    """``nodes`` holds every series' trees (columns of NODE beside the key)."""

    nodes: DataFrame
    cols: tuple[str, ...]
    key: str

    def save(self, path: str) -> None:
        self.nodes.write.mode("overwrite").parquet(path)

    @staticmethod
    def load(df: DataFrame, cols: Sequence[str], key: str = "ticker") -> Boosted:
        """From the stored nodes."""
        return Boosted(df, tuple(cols), key)

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``yhat``, null for series without a model.

        A series' rows are scored in slots of about SCORE_ROWS; its model is copied to each.
        """
        key, cols = self.key, self.cols
        counts = df.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / SCORE_ROWS).cast("long").alias("__slots"))
        slot = F.pmod(F.xxhash64(*df.columns), F.coalesce("__slots", F.lit(1)))
        rows = df.join(counts, key, "left").withColumn("__slot", slot).drop("__slots").select(*df.columns, "__slot")
        nodes = self.nodes.join(counts, key).withColumn("__slot", F.explode(F.sequence(F.lit(0), F.col("__slots") - 1)))

        def score(left: pa.Table, right: pa.Table) -> pa.Table:
            if right.num_rows and left.num_rows:
                yhat = pa.array(_nodes(right).predict(_matrix(left, cols)))
            else:
                yhat = pa.nulls(left.num_rows, pa.float64())
            return left.drop_columns(["__slot"]).append_column("yhat", yhat)

        schema = df.select("*", F.lit(None).cast("double").alias("yhat")).schema
        return together(rows, nodes.drop("__slots"), key, "__slot").applyInArrow(score, schema)

    def roll(self, state: DataFrame, names: Sequence[str], steps: int) -> DataFrame:
        """Feed predictions back: columns of ``state`` but ``names``, step, yhat.

        ``names`` are the features in the model's order, oldest value first.
        """
        rest = [c for c in state.columns if c not in names]

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            window = _matrix(left, names)
            path = np.full((steps, left.num_rows), np.nan)
            if right.num_rows:
                trees = _nodes(right)
                for s in range(steps):
                    path[s] = trees.predict(window)
                    window = np.column_stack([window[:, 1:], path[s]])
            at = np.repeat(np.arange(left.num_rows), steps)
            out = left.select(rest).take(pa.array(at))
            step = np.tile(np.arange(1, steps + 1, dtype=np.int32), left.num_rows)
            yhat = pa.array(path.T.reshape(-1), from_pandas=True)
            return out.append_column("step", pa.array(step)).append_column("yhat", yhat)

        schema = state.select(*rest, F.lit(0).alias("step"), F.lit(None).cast("double").alias("yhat")).schema
        return together(state, self.nodes, self.key).applyInArrow(run, schema)

    def importances(self, top: int | None = None) -> DataFrame:
        """key, feature, importance: each feature's share of its series' gains, largest first."""
        names = F.array(*map(F.lit, self.cols))
        every = self.nodes.where("round = -1").select(self.key, F.posexplode(names).alias("__j", "feature"))
        gains = self.nodes.where("feature >= 0").groupBy(self.key, F.col("feature").alias("__j")).agg(F.sum("gain").alias("__gain"))
        total = gains.groupBy(self.key).agg(F.sum("__gain").alias("__total"))
        share = F.coalesce(F.try_divide("__gain", "__total"), F.lit(0.0))
        out = every.join(gains, [self.key, "__j"], "left").join(total, self.key, "left").select(
            self.key, "feature", share.alias("importance")
        )
        if top is not None:
            from pyspark.sql import Window

            w = Window.partitionBy(self.key).orderBy(F.col("importance").desc(), "feature")
            out = out.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= top).drop("__rn")
        return out.orderBy(self.key, F.col("importance").desc(), "feature")


def boost_fit(
    df: DataFrame,
    cols: Sequence[str],
    target: str = "label",
    *,
    key: str = "ticker",
    rounds: int = 50,
    depth: int = 5,
    rate: float = 0.1,
    min_rows: int = 1,
    l2: float = 0.0,
    task_rows: int = TASK_ROWS,
    chunk_rows: int = CHUNK_ROWS,
) -> Boosted:
    """Squared-error boosting per series; rows without key or target are left out.

    Missing feature values have a bin of their own behind all others.
    """
    cols = list(cols)
    rules = Rules(rounds, depth, rate, min_rows, l2)
    named = {c: f"__x{j}" for j, c in enumerate(cols)}
    ready = cast_features(df, [*cols, target]).select(
        F.col(key), F.col(target).alias("__y"), *(F.col(c).alias(x) for c, x in named.items())
    ).where(F.col(key).isNotNull() & F.col("__y").isNotNull() & ~F.isnan("__y"))
    ready = cut_lineage(ready)
    shares = [i / BINS for i in range(1, BINS)]
    stats = cut_lineage(ready.groupBy(key).agg(
        F.count(F.lit(1)).alias("__n"), F.avg("__y").alias("__base"),
        F.max("__y").alias("__high"), F.min("__y").alias("__low"),
        *(
            F.percentile_approx(F.when(~F.isnan(x), F.col(x)), shares, 2000).alias(f"__e{j}")
            for j, x in enumerate(named.values())
        ),
    ))
    features = list(named.values())
    schema = f"`{key}` {ready.schema[key].dataType.simpleString()}, {NODE}"

    def scale_of(row: dict) -> float:
        return max(row["__high"] - row["__base"], row["__base"] - row["__low"]) or 1.0

    def fit(left: pa.Table, right: pa.Table) -> pa.Table:
        row = right.to_pylist()[0]
        rows = fit_series(
            _matrix(left, features), left.column("__y").to_numpy(), row["__base"], scale_of(row),
            _edges(row, len(features)), rules,
        )
        out = pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _NODE_TYPES.types)], schema=_NODE_TYPES)
        return out.add_column(0, key, right.column(key).take(pa.array(np.zeros(len(rows), np.int64))))

    small, large = stats.where(F.col("__n") <= task_rows), stats.where(F.col("__n") > task_rows)
    few = ready.join(small.select(key), key, "left_semi")
    nodes = together(few, small, key).applyInArrow(fit, schema)
    if not large.isEmpty():
        nodes = nodes.unionByName(_fit_large(ready, large, features, key, rules, chunk_rows, schema))
    return Boosted(cut_lineage(nodes), tuple(cols), key)


def _fit_large(ready, large, features, key, rules, chunk_rows, schema) -> DataFrame:
    n_features = len(features)
    kind = ready.schema[key].dataType.simpleString()
    slots = large.withColumn("__slots", F.ceil(F.col("__n") / chunk_rows).cast("long"))
    per_slot = slots.withColumn("__slot", F.explode(F.sequence(F.lit(0), F.col("__slots") - 1)))
    # `ready` is stored, so its rows keep their numbers.
    dealt = ready.withColumn("__row", F.monotonically_increasing_id()).join(slots.select(key, "__slots"), key)
    dealt = dealt.withColumn("__slot", F.pmod("__row", "__slots")).drop("__row", "__slots")

    def chunk(left: pa.Table, right: pa.Table) -> pa.Table:
        row = right.to_pylist()[0]
        bins = to_bins(_matrix(left, features), _edges(row, n_features))
        margin = np.full(left.num_rows, row["__base"])
        unit = (max(row["__high"] - row["__base"], row["__base"] - row["__low"]) or 1.0) * UNIT
        return pa.table({
            key: right.column(key), "unit": pa.array([unit]), "bins": pa.array([bins.tobytes()]),
            "y": pa.array([left.column("__y").to_numpy().tobytes()]), "margin": pa.array([margin.tobytes()]),
        })

    chunks = cut_lineage(
        together(dealt, per_slot, key, "__slot")
        .applyInArrow(chunk, f"`{key}` {kind}, unit double, bins binary, y binary, margin binary")
    )
    units = large.select(key, ((F.greatest(F.col("__high") - F.col("__base"), F.col("__base") - F.col("__low")))).alias("__range"))
    units = units.select(key, (F.when(F.col("__range") == 0, 1.0).otherwise(F.col("__range")) * UNIT).alias("unit"))
    edges = large.select(key, F.array(*(F.array_sort(F.array_distinct(f"__e{j}")) for j in range(n_features))).alias("edges"))
    one = "struct<round: int, node: int, feature: int, bin: int, value: double>"
    splits = f"`{key}` {kind}, node int, feature int, bin int, gain double, g double, n long, gl double, nl long"

    def with_nodes(pending: DataFrame) -> DataFrame:
        own = pending.groupBy(key).agg(F.collect_list(F.struct("round", "node", "feature", "bin", "value")).alias("nodes"))
        return chunks.join(own, key, "left").withColumn("nodes", F.coalesce("nodes", F.array().cast(f"array<{one}>")))

    def state(row: dict) -> tuple[np.ndarray, np.ndarray, Trees, Trees]:
        bins = np.frombuffer(row["bins"], np.uint8).reshape(n_features, -1)
        nodes = {c: np.array([x[c] for x in row["nodes"]]) for c in ("round", "node", "feature", "bin", "value")}
        nodes["cut"] = np.zeros(len(nodes["round"]))
        done = nodes["value"] != None  # noqa: E711  the tree being grown has no values yet
        past = Trees({k: v[done].astype(np.float64 if k in ("value", "cut") else np.int64) for k, v in nodes.items()})
        now = {k: v[~done] for k, v in nodes.items()} | {"value": np.zeros(int((~done).sum()))}
        return bins, np.frombuffer(row["margin"], np.float64), past, Trees({k: v.astype(np.int64) for k, v in now.items()})

    def level_sums(level: int):
        first = 1 << level

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict = {}
            for batch in batches:
                for k in range(batch.num_rows):
                    row = batch.slice(k, 1).to_pylist()[0]
                    bins, margin, past, now = state(row)
                    margin = past.add_margins(bins, margin)
                    residual = np.rint((np.frombuffer(row["y"], np.float64) - margin) / row["unit"])
                    if now.trees:
                        feature, _, cut, _, _ = now.trees[0]
                        wide = np.full(2 << level, -1), np.zeros(2 << level, np.int64)
                        size = min(len(feature), 2 << level)
                        wide[0][:size], wide[1][:size] = feature[:size], cut[:size]
                        node = placed(bins, *wide, level)
                    else:
                        node = np.ones(bins.shape[1], np.int64)
                    sums = histograms(bins, np.where(node >= first, node - first, -1), residual, first)
                    old = held.get(row[key])
                    held[row[key]] = sums if old is None else (old[0] + sums[0], old[1] + sums[1])
                    if len(held) * first * n_features * BINS * 16 > 1 << 27:
                        yield from emit(held)
                        held = {}
            yield from emit(held)

        def emit(held: dict) -> Iterator[pa.RecordBatch]:
            for name, (sums, counts) in held.items():
                rows = [
                    (name, first + k, b, sums[k, b : b + BLOCK].tobytes(), counts[k, b : b + BLOCK].tobytes())
                    for k in np.flatnonzero(counts[:, 0].sum(1)).tolist() for b in range(0, n_features, BLOCK)
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (None, pa.int32(), pa.int32(), pa.binary(), pa.binary()))],
                    [key, "node", "block", "sums", "counts"],
                )

        return run

    def choose(table: pa.Table) -> pa.Table:
        sums, counts = (
            sum(np.frombuffer(x, np.float64) for x in table.column(c).to_pylist()).reshape(1, -1, BINS) for c in ("sums", "counts")
        )
        gain, f, b, left, n_left = best_splits(sums, counts, rules)
        first = table.slice(0, 1)
        return pa.table({
            key: first.column(key), "node": first.column("node"),
            "feature": pa.array(f.astype(np.int32) + np.int32(first.column("block")[0].as_py())), "bin": pa.array(b.astype(np.int32)),
            "gain": pa.array(gain), "g": pa.array([float(sums[0, 0].sum())]), "n": pa.array([int(counts[0, 0].sum())]),
            "gl": pa.array(left), "nl": pa.array(n_left.astype(np.int64)),
        })

    spark = ready.sparkSession
    out = [large.select(
        key, F.lit(-1).alias("round"), F.lit(1).alias("node"), F.lit(-1).alias("feature"), F.lit(0).alias("bin"),
        F.lit(0.0).alias("cut"), F.col("__base").alias("value"), F.lit(0.0).alias("gain"), F.col("__n").alias("n"),
    )]
    pending = spark.createDataFrame([], schema)
    for t in range(rules.rounds):
        tree = spark.createDataFrame([], splits)
        for level in range(rules.depth):
            growing = tree.select(
                key, F.lit(t).alias("round"), "node", "feature", "bin", F.lit(None).cast("double").alias("value")
            )
            known = pending.select(key, "round", "node", "feature", "bin", "value").unionByName(growing)
            sums = with_nodes(known).mapInArrow(level_sums(level), f"`{key}` {kind}, node int, block int, sums binary, counts binary")
            blocks = sums.groupBy(key, "node", "block").applyInArrow(choose, splits)
            best = blocks.groupBy(key, "node").agg(
                F.max(F.struct("gain", (-F.col("feature")).alias("f"), "bin", "g", "n", "gl", "nl")).alias("s")
            ).select(
                key, "node", F.when(F.col("s.gain") > 0, -F.col("s.f")).otherwise(-1).alias("feature"),
                "s.bin", "s.gain", "s.g", "s.n", "s.gl", "s.nl",
            )
            tree = cut_lineage(tree.unionByName(best))
        last = 1 << rules.depth - 1
        ends = tree.where((F.col("feature") >= 0) & (F.col("node") >= last))
        leaves = ends.select(key, F.explode(F.array(
            F.struct((F.col("node") * 2).alias("node"), F.col("gl").alias("g"), F.col("nl").alias("n")),
            F.struct((F.col("node") * 2 + 1).alias("node"), (F.col("g") - F.col("gl")).alias("g"), (F.col("n") - F.col("nl")).alias("n")),
        )).alias("s")).select(key, "s.node", F.lit(-1).alias("feature"), F.lit(0).alias("bin"), F.lit(0.0).alias("gain"), "s.g", "s.n")
        every = tree.select(key, "node", "feature", "bin", "gain", "g", "n").unionByName(leaves)
        cut = F.when(F.col("feature") >= 0, F.get(F.get("edges", F.greatest("feature", F.lit(0))), F.col("bin"))).otherwise(0.0)
        grown = cut_lineage(every.join(units, key).join(edges, key).select(
            key, F.lit(t).alias("round"), "node", "feature", F.when(F.col("feature") >= 0, F.col("bin")).otherwise(0).alias("bin"),
            cut.alias("cut"), (F.lit(rules.step(t)) * (F.col("g") / F.col("n") * F.col("unit"))).alias("value"),
            (F.when(F.col("feature") >= 0, F.col("gain")).otherwise(0.0) * F.col("unit") * F.col("unit")).alias("gain"), "n",
        ))
        out.append(grown)
        pending = pending.unionByName(grown)
        if (t + 1) % STORE_EVERY == 0 and t + 1 < rules.rounds:

            def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    for k in range(batch.num_rows):
                        one_row = batch.slice(k, 1)
                        bins, margin, past, _ = state(one_row.to_pylist()[0])
                        margin = past.add_margins(bins, margin)
                        cols = [one_row.column(c) for c in (key, "unit", "bins", "y")]
                        yield pa.RecordBatch.from_arrays([*cols, pa.array([margin.tobytes()])], [key, "unit", "bins", "y", "margin"])

            chunks = cut_lineage(with_nodes(pending.select(key, "round", "node", "feature", "bin", "value")).mapInArrow(store, chunks.schema))
            pending = spark.createDataFrame([], schema)
    nodes = out[0]
    for x in out[1:]:
        nodes = nodes.unionByName(x)
    return nodes
