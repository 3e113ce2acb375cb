"""Conditional least squares for autoregressive moving averages, from a first estimate.

The residuals of e_t = u_t - b1 e_(t-1) - ... follow a linear recurrence, and so do their
derivatives by all parameters. Gauss-Newton needs only sums of products of these columns. A
series of at most ``TASK_ROWS`` rows is refined inside one task. A longer one lies in blocks: a
first pass runs each block from a zero history, the histories at the seams follow from these
by the blocks' transition matrices (affine maps, composed in order), and a second pass adds
up the products from the true histories. Both give the same sums.

Seasonal factors multiply: (1 - ar)(1 - seasonal ar) z = c + regressors + (1 + ma)(1 + seasonal ma) e,
so the coefficients of all lags are a function of fewer parameters, linear in each of them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.plans.layout import POS
from seriesloom.session import cut_lineage

TASK_ROWS = 200_000
#: Rows filtered by one matrix product.
STEP = 64
ROUNDS, HALVINGS, TOLERANCE = 25, 8, 1e-8


@dataclass(frozen=True)
class Shape:
    """Which parameters there are; lags as in the model's lag polynomials."""

    constant: bool
    n_exog: int
    ar: tuple[int, ...]
    ma: tuple[int, ...]
    order: tuple[int, int, int]
    seasonal: tuple[int, int, int, int]

    @property
    def sizes(self) -> tuple[int, ...]:
        return (int(self.constant), self.n_exog, self.order[0], self.seasonal[0], self.order[2], self.seasonal[2])

    @property
    def history(self) -> int:
        return max([0, *self.ma])

    def expand(self, params: np.ndarray) -> np.ndarray:
        """Constant, regressors, and the coefficients of all ar and ma lags."""
        const, exog, ar, sar, ma, sma = np.split(params, np.cumsum(self.sizes)[:-1])
        out = [const if self.constant else np.zeros(1), exog]
        for own, season, lags, sign in ((ar, sar, self.ar, -1.0), (ma, sma, self.ma, 1.0)):
            wide = np.zeros(len(season) * self.seasonal[3] + 1)
            wide[0] = 1.0
            wide[self.seasonal[3] :: self.seasonal[3] or 1][: len(season)] = sign * season
            full = np.convolve(np.concatenate([[1.0], sign * own]), wide)
            out.append(sign * full[list(lags)] if lags else np.zeros(0))
        return np.concatenate(out)

    def chain(self, params: np.ndarray) -> np.ndarray:
        """Derivatives of `expand`, exact because it is linear in each parameter."""
        base = self.expand(params)
        eye = np.eye(len(params))
        return np.stack([self.expand(params + e) - base for e in eye], 1) if len(params) else np.zeros((len(base), 0))

    def first(self, free: np.ndarray) -> np.ndarray:
        """Parameters from coefficients of all lags estimated freely."""
        const, exog, ar, ma = np.split(free, np.cumsum([1, self.n_exog, len(self.ar)]))
        s, out = self.seasonal[3], [const if self.constant else np.zeros(0), exog]
        for own, lags, n, m in ((ar, self.ar, self.order[0], self.seasonal[0]), (ma, self.ma, self.order[2], self.seasonal[2])):
            at = dict(zip(lags, own))
            out += [np.array([at[i + 1] for i in range(n)]), np.array([at[s * (j + 1)] for j in range(m)])]
        return np.concatenate(out)

    def dense(self, lags: tuple[int, ...], coefs: np.ndarray) -> np.ndarray:
        out = np.zeros(max([0, *lags]))
        out[[k - 1 for k in lags]] = coefs
        return out

    def parts(self, params: np.ndarray) -> list[np.ndarray]:
        """Constant, regressors, ar lags, ma lags."""
        return np.split(self.expand(params), np.cumsum([1, self.n_exog, len(self.ar)]))

    def stable(self, params: np.ndarray) -> bool:
        """Both lag polynomials have all roots outside the unit circle."""
        _, _, ar, ma = self.parts(params)
        for lags, coefs, sign in ((self.ar, ar, -1.0), (self.ma, ma, 1.0)):
            poly = np.trim_zeros(np.concatenate([[1.0], sign * self.dense(lags, coefs)]), "b")
            if len(poly) > 1 and np.abs(np.roots(poly[::-1])).min() <= 1.0005:
                return False
        return True


class Recursion:
    """y_t = u_t - b1 y_(t-1) - ... - bq y_(t-q), many columns at a time, by blocks."""

    def __init__(self, b: np.ndarray):
        self.q = q = len(b)
        y = np.zeros((STEP + q, q + 1))  # columns: unit histories (latest first), unit impulse
        y[q - 1 - np.arange(q), np.arange(q)] = 1.0
        for t in range(q, STEP + q):
            y[t] = -(b[::-1] @ y[t - q : t]) if q else 0.0
            if t == q:
                y[t, q] += 1.0
        self.free = y[q:, :q]
        impulse = y[q:, q]
        lag = np.subtract.outer(np.arange(STEP), np.arange(STEP))
        self.forced = np.where(lag >= 0, impulse[np.abs(lag)], 0.0)

    def run(self, u: np.ndarray, history: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Columns of y, and the history (latest first) behind them."""
        out = np.empty_like(u)
        for a in range(0, len(u), STEP):
            n = min(STEP, len(u) - a)
            out[a : a + n] = self.forced[:n, :n] @ u[a : a + n] + self.free[:n] @ history
            history = np.concatenate([out[a : a + n][::-1], history])[: self.q]
        return out, history


def columns(x: np.ndarray, params: np.ndarray, shape: Shape, history: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Derivatives of e by all free coefficients, and e; and the history behind the rows.

    `x` has regressors, lagged values and the value; the history has q rows (latest first) of
    e, of its second filtering w, and of the other derivatives. d e / d b_j is -w_(t-j).
    """
    const, exog, ar, ma = shape.parts(params)
    q, filt = shape.history, Recursion(shape.dense(shape.ma, ma))
    inputs, z = x[:, :-1], x[:, -1]
    u = z - const[0] - inputs @ np.concatenate([exog, ar])
    direct = -np.column_stack([np.ones(len(x)), inputs])
    first, past_first = filt.run(np.column_stack([u, direct]), np.column_stack([history[:, :1], history[:, 2:]]))
    second, past_second = filt.run(first[:, :1], history[:, 1:2])
    past_w = np.concatenate([history[::-1, 1], second[:, 0]])  # oldest first
    lagged = [-past_w[q - j : q - j + len(x)] for j in shape.ma]
    out = np.column_stack([first[:, 1:], *lagged, first[:, :1]])
    return out, np.column_stack([past_first[:, :1], past_second, past_first[:, 1:]])


def blank(x_width: int, shape: Shape) -> np.ndarray:
    return np.zeros((shape.history, 2 + x_width))


def transition(params: np.ndarray, shape: Shape, n: int, x_width: int):
    """How a history moves over n rows without input: f(history)."""
    step = min(n, 1)
    q = shape.history
    b = shape.dense(shape.ma, shape.parts(params)[3])
    one = np.zeros((q, q))
    if q:
        one[0], one[1:, :-1] = -b, np.eye(q - 1)
    # e moves by `one`; w takes the new e as its input.
    joint = np.zeros((2 * q, 2 * q))
    joint[:q, :q], joint[q:, q:] = one, one
    if q:
        joint[q, :q] = one[0]
    far = np.linalg.matrix_power(joint, n) if step else np.eye(2 * q)

    def move(history: np.ndarray) -> np.ndarray:
        ew = far @ history[:, :2].T.reshape(-1)
        rest = far[:q, :q] @ history[:, 2:]
        return np.column_stack([ew.reshape(2, q).T, rest])

    return move


def products(cols: np.ndarray) -> np.ndarray:
    return cols.T @ cols


def start_state(free: np.ndarray, shape: Shape) -> dict:
    params = shape.first(free)
    for _ in range(60):  # a first estimate that is not stable moves towards zero
        if shape.stable(params):
            break
        moved = params.copy()
        moved[int(shape.constant) + shape.n_exog :] *= 0.9
        params = moved
    return {"trial": params, "best": params, "step": np.zeros(len(params)), "ssr": np.inf, "g": None, "halved": 0, "done": False}


def advance(state: dict, full: np.ndarray, shape: Shape) -> dict:
    """One step of Gauss-Newton from the products at the trial parameters."""
    state = dict(state)
    ssr = full[-1, -1]
    if np.isfinite(ssr) and ssr < state["ssr"]:
        small = state["ssr"] - ssr <= TOLERANCE * ssr
        d = shape.chain(state["trial"])
        jj, je = d.T @ full[:-1, :-1] @ d, d.T @ full[:-1, -1]
        state |= {"best": state["trial"], "ssr": ssr, "g": full, "halved": 0, "done": bool(small)}
        state["step"] = -np.linalg.pinv(jj, hermitian=True) @ je
    else:
        state |= {"step": state["step"] / 2, "halved": state["halved"] + 1}
    for _ in range(40):
        if shape.stable(state["best"] + state["step"]):
            break
        state["step"] = state["step"] / 2
    else:
        state["step"] = np.zeros(len(state["step"]))
    state["trial"] = state["best"] + state["step"]
    state["done"] = bool(state["done"] or state["halved"] > HALVINGS or np.abs(state["step"]).max(initial=0) < 1e-7)
    return state


def refine_rows(x: np.ndarray, free: np.ndarray, shape: Shape) -> dict:
    """The refined state of one series, all of whose rows are here."""
    state = start_state(free, shape)
    for _ in range(ROUNDS):
        cols, _ = columns(x, state["trial"], shape, blank(x.shape[1], shape))
        state = advance(state, products(cols), shape)
        if state["done"]:
            break
    cols, _ = columns(x, state["best"], shape, blank(x.shape[1], shape))
    return state | {"e": cols[-shape.history :, -1]}


SCHEMA = "free array<double>, params array<double>, ssr double, n bigint, g array<double>, e array<double>"


def _blob(table: pa.Table, names: list[str]) -> np.ndarray:
    order = np.argsort(table.column(POS).to_numpy(), kind="stable")
    return np.column_stack([table.column(c).to_numpy()[order] for c in names])


def refine(rows: DataFrame, free: DataFrame, names: list[str], shape: Shape, key: str, block: int, task_rows: int = TASK_ROWS) -> DataFrame:
    """key and SCHEMA: refined coefficients of each series in ``free`` (key, beta array).

    ``rows`` has the position and the columns ``names`` (regressors, lags, value); rows with a
    null are left out, which is meant for the first ones of a series, that lack lags.
    """
    kind = rows.schema[key].dataType.simpleString()
    rows = rows.select(key, POS, *names).dropna()
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    marked = cut_lineage(free.join(counts, key))
    few = marked.where(F.col("__n") <= task_rows)
    few = few.select(*(F.col(c).alias(c) for c in few.columns))

    def whole(left: pa.Table, right: pa.Table) -> pa.Table:
        beta = np.array(right.column("beta")[0].as_py(), np.float64)
        x = _blob(left, names)
        return _result(right.column(key), refine_rows(x, beta, shape), len(x), shape, key)

    small = rows.join(few.select(key), key, "left_semi")
    out = small.groupBy(key).cogroup(few.groupBy(key)).applyInArrow(whole, f"`{key}` {kind}, {SCHEMA}")
    many = marked.where(F.col("__n") > task_rows)
    if many.isEmpty():
        return out
    return out.unionByName(_refine_large(rows, many, names, shape, key, kind, block))


def _result(name, state: dict, n: int, shape: Shape, key: str) -> pa.Table:
    one = pa.list_(pa.float64())
    return pa.table({
        key: name, "free": pa.array([shape.expand(state["best"])], one), "params": pa.array([state["best"]], one),
        "ssr": pa.array([float(state["ssr"])]), "n": pa.array([n], pa.int64()),
        "g": pa.array([state["g"].ravel()], one), "e": pa.array([state["e"]], one),
    })


def _refine_large(rows, many, names, shape, key, kind, block) -> DataFrame:
    width = len(names)
    named = many.select(F.col(key).alias("__k"))

    def pack(table: pa.Table) -> pa.Table:
        return pa.table({
            key: table.column(key).slice(0, 1), "b": table.column("b").slice(0, 1),
            "n": pa.array([table.num_rows], pa.int64()), "x": pa.array([_blob(table, names).tobytes()]),
        })

    rows = rows.join(named, rows[key] == named["__k"], "left_semi").withColumn("b", F.floor(F.col(POS) / block).cast("long"))
    blocks = cut_lineage(rows.groupBy(key, "b").applyInArrow(pack, f"`{key}` {kind}, b long, n long, x binary"))
    array = pa.list_(pa.float64())
    state_schema = (
        f"`{key}` {kind}, trial array<double>, best array<double>, step array<double>, ssr double,"
        " g array<double>, halved int, done boolean, n bigint, e array<double>"
    )

    def begin(batches):
        for batch in batches:
            for row in batch.to_pylist():
                s = start_state(np.array(row["beta"]), shape)
                yield _state_batch(row[key], s, row["__n"], np.zeros(0))

    def _state_batch(name, s, n, e):
        g = [] if s["g"] is None else s["g"].ravel()
        return pa.RecordBatch.from_arrays(
            [pa.array([name]), *(pa.array([v], array) for v in (s["trial"], s["best"], s["step"])), pa.array([float(s["ssr"])]),
             pa.array([g], array), pa.array([s["halved"]], pa.int32()), pa.array([s["done"]]), pa.array([n], pa.int64()), pa.array([e], array)],
            [key, "trial", "best", "step", "ssr", "g", "halved", "done", "n", "e"],
        )

    def ends(batches):  # each block from a zero history
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                x = np.frombuffer(row["x"], np.float64).reshape(-1, width)
                _, last = columns(x, np.array(row["at"]), shape, blank(width, shape))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row[key]]), pa.array([row["b"]]), pa.array([row["n"]]), pa.array([row["at"]], array), pa.array([last.ravel()], array)],
                    [key, "b", "n", "at", "last"],
                )

    def seams(table: pa.Table) -> pa.Table:  # one small row for each block of a series
        table = table.sort_by("b")
        params = np.array(table.column("at")[0].as_py())
        now, begins = blank(width, shape), []
        moves: dict = {}
        for n, last in zip(table.column("n").to_pylist(), table.column("last").to_pylist()):
            begins.append(now.ravel())
            if n not in moves:
                moves[n] = transition(params, shape, n, width)
            now = moves[n](now) + np.array(last).reshape(now.shape)
        return pa.table({key: table.column(key), "b": table.column("b"), "begin": pa.array(begins, array)})

    def sums(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                x = np.frombuffer(row["x"], np.float64).reshape(-1, width)
                history = np.array(row["begin"]).reshape(shape.history, -1)
                cols, last = columns(x, np.array(row["at"]), shape, history)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row[key]]), pa.array([row["b"]]), pa.array([products(cols).ravel()], array), pa.array([last[::-1, 0]], array)],
                    [key, "b", "g", "tail"],
                )

    def total(table: pa.Table) -> pa.Table:
        g = np.sum([np.array(v) for v in table.column("g").to_pylist()], axis=0)
        last = int(np.argmax(table.column("b").to_numpy()))
        return pa.table({key: table.column(key).slice(0, 1), "sum": pa.array([g], array), "tail": table.column("tail").slice(last, 1)})

    def move(batches):
        for batch in batches:
            for row in batch.to_pylist():
                s = {k: np.array(row[k]) for k in ("trial", "best", "step")} | {k: row[k] for k in ("ssr", "halved", "done")}
                g, e = np.array(row["g"]), np.array(row["e"])
                full = np.array(row["sum"])
                full = full.reshape(int(round(len(full) ** 0.5)), -1)
                if full[-1, -1] < s["ssr"]:
                    e = np.array(row["tail"])
                s["g"] = g.reshape(full.shape) if len(g) else None
                yield _state_batch(row[key], advance(s, full, shape), row["n"], e)

    state = cut_lineage(many.mapInArrow(begin, state_schema))
    for _ in range(ROUNDS):
        at = state.where(~F.col("done")).select(F.col(key).alias("__k"), F.col("trial").alias("at"))
        if at.isEmpty():
            break
        placed = blocks.join(at, F.col(key) == F.col("__k")).drop("__k")
        from_zero = placed.mapInArrow(ends, f"`{key}` {kind}, b long, n long, at array<double>, last array<double>")
        begins = from_zero.groupBy(key).applyInArrow(seams, f"`{key}` {kind}, b long, begin array<double>")
        begins = begins.select(F.col(key).alias("__s"), F.col("b").alias("__b"), "begin")
        known = placed.join(begins, (F.col(key) == F.col("__s")) & (F.col("b") == F.col("__b"))).drop("__s", "__b")
        summed = known.mapInArrow(sums, f"`{key}` {kind}, b long, g array<double>, tail array<double>")
        summed = summed.groupBy(key).applyInArrow(total, f"`{key}` {kind}, sum array<double>, tail array<double>")
        summed = summed.select(F.col(key).alias("__k"), "sum", "tail")
        moved = state.join(summed, F.col(key) == F.col("__k")).drop("__k").mapInArrow(move, state_schema)
        state = cut_lineage(state.where("done").unionByName(moved))

    def finish(batches):
        for batch in batches:
            for row in batch.to_pylist():
                best = {"best": np.array(row["best"]), "ssr": row["ssr"], "g": np.array(row["g"]), "e": np.array(row["e"])}
                yield from _result(pa.array([row[key]]), best, row["n"], shape, key).to_batches()

    return state.mapInArrow(finish, f"`{key}` {kind}, {SCHEMA}")
