"""Near-duplicate vectors by a forest of random-projection trees with spill overlap.

1. Equal vectors become one, with their number; vectors without a direction (null, zero, not
   finite) are set aside.
2. A forest is fitted on at most `FIT_ROWS` vectors of least hash. A node is split along the
   random direction on which its vectors spread most, where they lie sparsest between the
   quartiles; a vector closer than the spill margin to the cut goes to both sides. Splitting
   ends at about `LEAF` vectors of the whole table, or where nearly all would go both ways.
3. Every vector is dealt to its leaves in all trees. Vectors of a leaf are compared in pairs
   of blocks, so a leaf may hold any number. A pair that meets in several leaves counts in
   the first of them only, which both vectors' lists of leaves tell; so no pairs are stored.
4. A task reports each vector's number of links and a spanning forest of them, from which the
   components follow.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.base import cut_lineage, register, table
from seriesloom.llm.jaccard import components, forest, in_blocks, numbered, _runs

COSINE = 0.9
TREES, LEAF, FIT_ROWS = 10, 512, 32_768
#: Directions of a tree, and those of them that a node tries.
DIRECTIONS, TRIES = 64, 8
#: Margin in standard deviations of the projected difference of a pair at the least cosine.
SPILL = 0.4
#: Least sample vectors of a node that is split, and the greatest share one side may have.
LEAST_FIT, SHARE = 32, 0.8
#: Vectors of a leaf that one side of a task holds, and rows of one numpy step.
BLOCK, STEP_ROWS = 1024, 8192


@dataclass
class Tree:
    """Split nodes have a direction's number, leaves -1; `below` has the two children or the leaf."""

    directions: np.ndarray
    split: np.ndarray
    cut: np.ndarray
    below: np.ndarray


def spill_margin(cosine: float, size: int) -> float:
    return SPILL * float(np.sqrt(2 * (1 - cosine) / max(size, 1)))


def best_cut(values: np.ndarray, margin: float) -> tuple[float, int]:
    """Where between the quartiles fewest values lie within the margin, and the larger side."""
    values = np.sort(values)
    n = len(values)
    tries = values[np.linspace(n // 4, n - 1 - n // 4, 17).astype(int)]
    tries = (tries[1:] + tries[:-1]) / 2
    left = np.searchsorted(values, tries + margin, "right")
    right = n - np.searchsorted(values, tries - margin, "left")
    k = int(np.argmin((left + right) * n + abs(left - right)))
    return float(tries[k]), int(max(left[k], right[k]))


def grow(sample: np.ndarray, rate: float, margin: float, first_leaf: int, seed: int) -> tuple[Tree, int]:
    """One tree on unit vectors of which each stands for 1 / rate vectors, and the next leaf's number."""
    rng = np.random.default_rng(seed)
    directions = rng.normal(size=(sample.shape[1], DIRECTIONS))
    directions /= np.linalg.norm(directions, axis=0)
    projected = sample @ directions
    split, cut, below = [-1], [0.0], [(0, 0)]
    stack = [(0, np.arange(len(sample)))]
    while stack:
        node, rows = stack.pop()
        if len(rows) > max(LEAF * rate, LEAST_FIT):
            tried = rng.choice(DIRECTIONS, TRIES, replace=False)
            spread = projected[np.ix_(rows, tried)].std(axis=0)
            for d in tried[np.argsort(-spread)].tolist():
                at, larger = best_cut(projected[rows, d], margin)
                if larger <= SHARE * len(rows):
                    values = projected[rows, d]
                    split[node], cut[node], below[node] = d, at, (len(split), len(split) + 1)
                    for side in (values <= at + margin, values >= at - margin):
                        stack.append((len(split), rows[side]))
                        split.append(-1)
                        cut.append(0.0)
                        below.append((0, 0))
                    break
        if split[node] < 0:
            below[node] = (first_leaf, first_leaf)
            first_leaf += 1
    return Tree(directions, np.array(split), np.array(cut), np.array(below, np.int32)), first_leaf


def leaves_of(tree: Tree, units: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) of all leaves that each vector is dealt to."""
    projected = units @ tree.directions
    row, node = np.arange(len(units)), np.zeros(len(units), np.int64)
    rows, leaves = [], []
    while len(row):
        end = tree.split[node] < 0
        rows.append(row[end])
        leaves.append(tree.below[node[end], 0])
        row, node = row[~end], node[~end]
        value, at = projected[row, tree.split[node]], tree.cut[node]
        left, right = value <= at + margin, value >= at - margin
        row, node = np.concatenate([row[left], row[right]]), np.concatenate([tree.below[node[left], 0], tree.below[node[right], 1]])
    return np.concatenate(rows), np.concatenate(leaves)


def unit_rows(vectors: pa.Array, size: int) -> np.ndarray:
    """Unit vectors in double precision, zeros behind shorter ones."""
    flat, offsets = pc.list_flatten(vectors).to_numpy(False).astype(np.float64), vectors.offsets.to_numpy()
    lengths = np.diff(offsets)
    out = np.zeros((len(vectors), size))
    out[np.repeat(np.arange(len(vectors)), lengths), np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], lengths)] = flat
    out /= abs(out).max(axis=1, keepdims=True)  # the squares of very long vectors would overflow
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def first_meeting(leaf: int, leaves: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs of rows have no leaf before `leaf` in common; -1 fills the lists' ends."""
    out = np.empty(len(a), bool)
    for part in range(0, len(a), STEP_ROWS):
        x, y = leaves[a[part : part + STEP_ROWS]], leaves[b[part : part + STEP_ROWS]]
        x = np.where(x < leaf, x, -1)
        out[part : part + STEP_ROWS] = ~((x[:, :, None] == y[:, None, :]) & (x >= 0)[:, :, None]).any(axis=(1, 2))
    return out


def link_vectors(rows: DataFrame, cosine: float = COSINE, trees: int = TREES, seed: int = 5) -> DataFrame:
    """row, class_row, n_links for each row of `rows` (row long unique, vector array of numbers).

    Vectors of equal length are linked where they meet in a leaf and their cosine, in double
    precision, reaches `cosine`. class_row is the least row that links reach, the row itself
    included. Null or empty vectors, zero vectors and vectors with a null, NaN or infinite
    component link with nothing; equal vectors link with each other. An empty table gives an
    empty result; other columns are ignored.
    """
    spark = rows.sparkSession
    spark_parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    # -0.0 becomes 0.0, so that equal vectors have equal bytes.
    vector = F.transform(F.col("vector").cast("array<double>"), lambda x: x + F.lit(0.0))
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(
        "vector", lambda x: x != 0
    )
    rows = rows.select("row", vector.alias("vector"))
    rows = rows.withColumn("same", F.when(sound, F.sha2(F.concat_ws(",", F.col("vector").cast("array<string>")), 256)))
    able = rows.where("same is not null")
    texts = able.groupBy("same").agg(F.min("row").alias("id"), F.count(F.lit(1)).alias("copies"))
    texts = cut_lineage(texts)
    one = cut_lineage(
        able.join(texts.select(F.col("id").alias("row"), "copies"), "row").select(F.col("row").alias("id"), "vector", "copies")
    )
    bounds = one.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    if not bounds[0]:
        return rows.select("row", F.col("row").alias("class_row"), F.lit(0).cast("long").alias("n_links"))
    count, size = bounds
    sample = one.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(FIT_ROWS).select("vector").toArrow()
    sample = unit_rows(sample.column("vector").combine_chunks(), size)
    margin, model, next_leaf = spill_margin(cosine, size), [], 0
    for k in range(trees):
        tree, next_leaf = grow(sample, len(sample) / count, margin, next_leaf, seed + k)
        model.append(tree)
    del sample
    held = spark.sparkContext.broadcast(model)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, STEP_ROWS):
                batch = whole.slice(at, STEP_ROWS)
                vectors = batch.column("vector")
                units = unit_rows(pa.concat_arrays([vectors]), size)
                found = [leaves_of(t, units, margin) for t in held.value]
                row, leaf = (np.concatenate(x) for x in zip(*found))
                order = np.lexsort((leaf, row))
                ends = np.cumsum(np.bincount(row, minlength=len(units)))
                leaves = pa.ListArray.from_arrays(
                    pa.array(np.append(0, ends).astype(np.int32)), pa.array(leaf[order].astype(np.int32))
                )
                lengths = pc.list_value_length(vectors).to_numpy(False)
                values = [u[:n].tobytes() for u, n in zip(units, lengths)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("copies"), pa.array(values), leaves],
                    ["id", "copies", "values", "leaves"],
                )

    dealt = cut_lineage(one.mapInArrow(deal, "id long, copies long, values binary, leaves array<int>"))
    entries = dealt.select("id", F.explode("leaves").alias("key"))
    sizes = entries.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = (
        in_blocks(entries, "key", sizes, BLOCK).join(dealt, "id")
        .repartition(spark_parts, "key", "i", "j")
        .sortWithinPartitions("key", "i", "j", "id")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pdf in _runs(batches, ["key", "i", "j"]):
            for (leaf, i, j), group in pdf.groupby(["key", "i", "j"], sort=False):
                found = _links(group, int(leaf), i != j, cosine, size)
                if found is not None:
                    yield found

    verified = cut_lineage(met.mapInArrow(compare, "a long, b long, n long"))
    links = verified.where("a = b").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("links"))
    roots = components(verified.where("a <> b").select("a", "b")).withColumnRenamed("node", "id")
    classed = (
        texts.join(roots, "id", "left").join(links, "id", "left")
        .select(
            "same", F.coalesce("root", "id").alias("class_row"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
        )
    )
    return rows.select("row", "same").join(classed, "same", "left").select(
        "row", F.coalesce("class_row", "row").alias("class_row"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")
    )


def _links(group, leaf: int, mixed: bool, cosine: float, size: int) -> pa.RecordBatch | None:
    """Links of one leaf's pair of blocks: (id, id, n) for counts, (a, b, 0) for a spanning forest."""
    ids, copies = group["id"].to_numpy(), group["copies"].to_numpy()
    width = np.fromiter(map(len, group["values"]), np.int64, len(group)) // 8
    units = np.zeros((len(group), size))
    for n in np.unique(width):
        use = np.flatnonzero(width == n)
        units[use, :n] = np.frombuffer(b"".join(group["values"].iloc[use]), np.float64).reshape(len(use), n)
    longest = max(map(len, group["leaves"]))
    leaves = np.full((len(group), longest), -1, np.int32)
    for k, own in enumerate(group["leaves"]):
        leaves[k, : len(own)] = own
    side = group["side"].to_numpy()
    left = np.flatnonzero(side == 0) if mixed else np.arange(len(ids))
    right = np.flatnonzero(side == 1) if mixed else left
    count, links = np.zeros(len(ids), np.int64), []
    for part in np.split(left, range(BLOCK // 4, len(left), BLOCK // 4)):
        a, b = np.nonzero(units[part] @ units[right].T >= cosine)
        a, b = part[a], right[b]
        good = width[a] == width[b]
        if not mixed:
            good &= a < b
        a, b = a[good], b[good]
        good = first_meeting(leaf, leaves, a, b)
        a, b = a[good], b[good]
        np.add.at(count, a, copies[b])
        np.add.at(count, b, copies[a])
        links += forest(zip(ids[a].tolist(), ids[b].tolist()))
    some = np.flatnonzero(count)
    if not len(some):
        return None
    a, b = (np.array(x, np.int64) for x in zip(*forest(iter(links))))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([ids[some], a])), pa.array(np.concatenate([ids[some], b])),
         pa.array(np.concatenate([count[some], np.zeros(len(a), np.int64)]))],
        ["a", "b", "n"],
    )


def near_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", **kw) -> DataFrame:
    """key, n_links, component_id (least key that links reach), kept, for each row of `vectors`.

    Where keys repeat or are null, rows are linked as rows of their own and kept is false for
    a null key.
    """
    rows = numbered(vectors.select(key, F.col(vector).alias("vector")), key)
    found = link_vectors(rows, **kw).join(rows.select("row", key), "row")
    names = found.groupBy("class_row").agg(F.min(key).alias("component_id"))
    return found.join(names, "class_row").select(
        key, "n_links", "component_id", F.coalesce(F.col(key) == F.col("component_id"), F.lit(False)).alias("kept")
    )


@register("op11_vectors")
def op11_vectors(spark, sf_dir):
    """Links and component of every embedding."""
    return near_vectors(table(spark, sf_dir, "embeddings"))
