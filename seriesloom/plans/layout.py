"""Row layout for ordered work on series of any length.

A plain ``Window.partitionBy(ticker)`` puts a whole series into one task, which
fails when one series holds a large share of all rows. Here a series is cut into
buckets of equal row count, and each bucket carries a *halo*: copies of the rows
just before (and, for forward frames, just after) it. ROWS frames no longer than
the halo then give the same values as on the uncut series.

Steps, all lazy:

1. rows are grouped by (ticker, time slice); a slice bounds the rows one task
   sorts, and ``row_number`` counts within it;
2. slice sizes (a map-side combined count, one row per slice) are prefix-summed
   per ticker and joined back: position in series = slice start + row number.
   Running sums and "last value so far" are carried the same way;
3. ``bucket = position div rows``; edge rows are also emitted to the neighbour
   bucket as halo; windows run by (ticker, bucket).

A slice is bounded by time, so a busy one can hold many rows. ``Layout.slice_rows`` bounds it
by rows as well: the slices above it are split at quantiles of their own times, taken from a
mergeable sketch, for two more passes over the input a level.

``mode="plain"`` skips the cutting, for inputs whose series are known to be short.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesloom.session import cut_lineage

POS = "__pos"
BUCKET = "__bucket"
HALO = "__halo"
SLICE = "__slice"
_HELPERS = (POS, BUCKET, HALO, SLICE)
# Parts of a busy slice at one level, and levels at most.
_PARTS, _LEVELS = 64, 4


@dataclass(frozen=True)
class Layout:
    """How a table of series is keyed, ordered and cut."""

    key: str = "ticker"
    ts: str = "d"
    mode: str = "bucketed"
    rows: int = 16_384
    slice_days: int | None = None
    slice_by: Callable[[Column], Column] | None = field(default=None, compare=False)
    tie: tuple[str, ...] = ()
    # Tasks the buckets are spread over; default is spark.sql.shuffle.partitions.
    tasks: int | None = None
    # Rows of a slice at most (rows of one time stay together); None: slices by time alone.
    slice_rows: int | None = None

    def __post_init__(self) -> None:
        if self.mode not in ("bucketed", "plain"):
            raise ValueError(f"unknown layout mode: {self.mode}")
        if self.rows < 1:
            raise ValueError("rows per bucket must be positive")
        if self.slice_rows is not None and self.slice_rows < 1:
            raise ValueError("rows per slice must be positive")

    def order(self) -> list[Column]:
        return [F.col(self.ts), *(F.col(c) for c in self.tie)]

    def slice_column(self, df: DataFrame) -> Column:
        """Coarse time slice of a row; bounds what one task must sort."""
        ts = F.col(self.ts)
        if self.slice_by is not None:
            return self.slice_by(ts)
        days = self.slice_days
        if days is None:
            days = 1024 if isinstance(df.schema[self.ts].dataType, T.DateType) else 1
        day = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date"))
        return F.floor(day / F.lit(days)).cast("long")


def sliced(df: DataFrame, layout: Layout) -> DataFrame:
    """Add ``__slice``; with ``slice_rows`` the busy slices are split until they are small.

    A slice whose rows all have one time is not split. Rows without a key or a time stay in
    the first part of theirs.
    """
    cut = df.withColumn(SLICE, layout.slice_column(df))
    if layout.slice_rows is None:
        return cut
    by, ts = [layout.key, SLICE], F.col(layout.ts)
    for _ in range(_LEVELS):
        sizes = cut.groupBy(*by).agg(
            F.count(F.lit(1)).alias("__n"), F.min(ts).alias("__lo"), F.max(ts).alias("__hi")
        )
        busy = cut_lineage(
            sizes.where((F.col("__n") > layout.slice_rows) & (F.col("__lo") < F.col("__hi"))).select(*by)
        )
        if busy.isEmpty():
            break
        at = F.percentile_approx(ts, [k / _PARTS for k in range(1, _PARTS)], 100 * _PARTS)
        # Splitters lie below the last time, so that every split leaves rows on both sides.
        splits = (
            cut.join(busy, by, "left_semi").groupBy(*by).agg(at.alias("__at"), F.max(ts).alias("__hi"))
            .select(*by, F.filter("__at", lambda s: s < F.col("__hi")).alias("__at"), "__hi")
        )
        splits = cut_lineage(splits)
        part = F.size(F.filter("__at", lambda s: s < ts))
        last = (F.size("__at") == 0) & (ts == F.col("__hi"))
        part = F.when(F.col("__at").isNull() | ts.isNull(), 0).when(last, 1).otherwise(part)
        cut = (
            cut.join(splits, by, "left")
            .withColumn(SLICE, F.col(SLICE) * _PARTS + part)
            .drop("__at", "__hi")
        )
    return cut


def with_positions(
    df: DataFrame,
    layout: Layout = Layout(),
    *,
    pad: Sequence[str] = (),
    running: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add ``__pos`` (0-based place of the row in its series).

    ``pad`` columns get nulls replaced by the last value before them (leading
    nulls stay). ``running`` maps new column names to expressions whose running
    total, current row included, is wanted.
    """
    running = dict(running or {})
    if layout.mode == "plain":
        w = Window.partitionBy(layout.key).orderBy(*layout.order())
        upto = w.rowsBetween(Window.unboundedPreceding, 0)
        out = df.withColumns(
            {POS: (F.row_number().over(w) - 1).cast("long")}
            | {n: F.sum(e).over(upto) for n, e in running.items()}
        )
        return out.withColumns({c: F.last(c, True).over(upto) for c in pad})

    cut = sliced(df, layout)
    aggs = [F.count(F.lit(1)).alias("__n")]
    when = F.struct(*layout.order()) if layout.tie else F.col(layout.ts)
    for c in pad:
        aggs.append(
            F.max_by(F.col(c), F.when(F.col(c).isNotNull(), when)).alias(f"__last_{c}")
        )
    for name, e in running.items():
        aggs.append(F.sum(e).alias(f"__sum_{name}"))
    sizes = cut.groupBy(layout.key, SLICE).agg(*aggs)
    earlier = (
        Window.partitionBy(layout.key)
        .orderBy(SLICE)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = sizes.select(
        layout.key,
        SLICE,
        F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__start"),
        *(
            F.last(f"__last_{c}", True).over(earlier).alias(f"__from_{c}")
            for c in pad
        ),
        *(F.sum(f"__sum_{n}").over(earlier).alias(f"__upto_{n}") for n in running),
    )
    w = Window.partitionBy(layout.key, SLICE).orderBy(*layout.order())
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    local = cut.withColumns(
        {"__rn": F.row_number().over(w)}
        | {f"__run_{n}": F.sum(e).over(upto) for n, e in running.items()}
        | {f"__pad_{c}": F.last(c, True).over(upto) for c in pad}
    )
    joined = local.join(starts, [layout.key, SLICE], "left")
    exprs: dict[str, Column] = {
        POS: (F.col("__start") + F.col("__rn") - 1).cast("long")
    }
    for c in pad:
        exprs[c] = F.coalesce(f"__pad_{c}", f"__from_{c}")
    for n in running:
        exprs[n] = F.when(
            F.col(f"__run_{n}").isNull(), F.col(f"__upto_{n}")
        ).otherwise(F.col(f"__run_{n}") + F.coalesce(f"__upto_{n}", F.lit(0.0)))
    return joined.withColumns(exprs).select(
        *df.columns, POS, *(n for n in running if n not in df.columns)
    )


@dataclass(frozen=True)
class Laid:
    """A positioned, bucketed table plus the window its frames run on."""

    df: DataFrame
    layout: Layout

    @property
    def w(self) -> WindowSpec:
        return Window.partitionBy(self.layout.key, BUCKET).orderBy(POS)

    @property
    def pos(self) -> Column:
        """1-based row number in the whole series."""
        return F.col(POS) + 1

    def with_columns(self, cols: Mapping[str, Column]) -> Laid:
        return replace(self, df=self.df.withColumns(dict(cols)))

    def where(self, cond: Column) -> Laid:
        return replace(self, df=self.df.where(cond))

    def close(self, keep_pos: bool = False) -> DataFrame:
        """Drop halo copies and helper columns."""
        df = self.df.where(~F.col(HALO)) if HALO in self.df.columns else self.df
        drop = [c for c in _HELPERS if not (keep_pos and c == POS)]
        return df.drop(*drop)


def lay_out(
    df: DataFrame,
    layout: Layout = Layout(),
    *,
    back: int = 0,
    ahead: int = 0,
    pad: Sequence[str] = (),
    running: Mapping[str, Column] | None = None,
) -> Laid:
    """Prepare ``df`` for ROWS frames reaching ``back`` rows back and ``ahead`` forward."""
    placed = with_positions(df, layout, pad=pad, running=running)
    return bucket_rows(placed, layout, back=back, ahead=ahead)


def bucket_rows(
    placed: DataFrame, layout: Layout = Layout(), *, back: int = 0, ahead: int = 0
) -> Laid:
    """Cut an already positioned table into buckets with halos."""
    if layout.mode == "plain":
        return Laid(
            placed.withColumns({BUCKET: F.lit(0).cast("long"), HALO: F.lit(False)}),
            layout,
        )
    n = max(layout.rows, back, ahead)
    pos = F.col(POS)
    # A row without a position (null key) still belongs to one bucket.
    own = F.coalesce(F.expr(f"{POS} div {n}"), F.lit(0)).cast("long")
    offset = F.pmod(pos, F.lit(n))
    targets = [F.array(F.struct(own.alias("b"), F.lit(False).alias("h")))]
    empty = F.array().cast("array<struct<b:bigint,h:boolean>>")

    def copy_to(shift: int, cond: Column) -> Column:
        to = F.struct((own + shift).alias("b"), F.lit(True).alias("h"))
        return F.when(cond, F.array(to)).otherwise(empty)

    if back:
        targets.append(copy_to(1, offset >= n - back))
    if ahead:
        targets.append(copy_to(-1, (offset < ahead) & (own > 0)))
    if len(targets) == 1:
        out = placed.withColumns({BUCKET: own, HALO: F.lit(False)})
    else:
        out = (
            placed.withColumn("__t", F.explode(F.concat(*targets)))
            .withColumns({BUCKET: F.col("__t.b"), HALO: F.col("__t.h")})
            .drop("__t")
        )
    # Windows do much work per byte, so their tasks are not to be merged by size.
    tasks = layout.tasks or int(
        placed.sparkSession.conf.get("spark.sql.shuffle.partitions")
    )
    return Laid(out.repartition(tasks, layout.key, BUCKET), layout)
