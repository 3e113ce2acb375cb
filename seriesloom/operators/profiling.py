"""Table profiles and general preparation: describe, impute, dedupe, confusion matrix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.functions.rolling import trailing_mean
from seriesloom.plans.layout import Layout, lay_out
from seriesloom.plans.quantiles import exact_quantiles


def profile_schema(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, and the row count of the table."""
    entries = F.array(
        *(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("type"),
            )
            for i, f in enumerate(df.schema)
        )
    )
    return (
        df.agg(F.count(F.lit(1)).alias("n_rows"))
        .select("n_rows", F.explode(entries).alias("e"))
        .select("e.position", "e.column", "e.type", "n_rows")
    )


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max, one row per column.

    Moments come from one aggregate. Quartiles are exact order statistics found by
    bracketing, not by gathering a column in one task.
    """
    qs = (0.25, 0.5, 0.75)
    found = exact_quantiles(df, cols, qs)
    one_row = df.agg(
        *(
            F.struct(
                F.count(c).alias("n"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
            ).alias(c)
            for c in cols
        )
    )
    entries = F.array(
        *(
            F.struct(
                F.lit(c).alias("column"),
                *(F.col(f"{c}.{s}").alias(s) for s in ("n", "mean", "std", "min")),
                *(
                    F.lit(found[c][q]).cast("double").alias(name)
                    for q, name in zip(qs, ("q25", "median", "q75"))
                ),
                F.col(f"{c}.max").alias("max"),
            )
            for c in cols
        )
    )
    return one_row.select(F.explode(entries).alias("e")).select("e.*")


def impute_median(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Replace nulls by the column median (exact)."""
    found = exact_quantiles(df, cols, (0.5,))
    return df.withColumns(
        {
            c: F.coalesce(F.col(c), F.lit(found[c][0.5]).cast("double"))
            for c in cols
        }
    )


def standardize_text(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Lower case without surrounding white space."""
    return df.withColumns({c: F.trim(F.lower(F.col(c))) for c in cols})


def dedupe_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Keep the first row of each key by an explicit order.

    The minimum of one (order, row) struct is combined before the shuffle, so a
    key with many copies does not travel whole.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    first = F.min(F.struct(*order, *rest)).alias("__first")
    picked = df.groupBy(*keys).agg(first)
    return picked.select(
        *(F.col(c) if c in keys else F.col(f"__first.{c}").alias(c) for c in df.columns)
    )


def binary_rate(df: DataFrame, flag: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(F.col(flag).cast("double")).alias("rate"))


def derived_ratio(df: DataFrame, name: str, num: Column, den: Column) -> DataFrame:
    return df.withColumn(name, F.try_divide(num, den))


def rolling3(
    df: DataFrame, value: str, layout: Layout = Layout(), size: int = 3
) -> DataFrame:
    """Full-window mean of the last three rows, current row included."""
    laid = lay_out(df, layout, back=size - 1)
    return laid.with_columns(
        {f"avg_{size}": trailing_mean(F.col(value), size, laid.w)}
    ).close()


def confusion_matrix(
    df: DataFrame, label: str, pred: str, classes: Sequence[int]
) -> DataFrame:
    """One row per true class, one ``pred_<class>`` count column per predicted class."""
    return df.groupBy(F.col(label).alias("label")).agg(
        *(F.count_if(F.col(pred) == c).alias(f"pred_{c}") for c in classes)
    )


def classification_report(
    df: DataFrame, label: str, pred: str, classes: Sequence[int]
) -> DataFrame:
    """Precision, recall, F1 and support per class; an undefined ratio is 0."""
    counts = []
    for c in classes:
        true, said = F.col(label) == c, F.col(pred) == c
        counts += [
            F.count_if(true & said).alias(f"tp{c}"),
            F.count_if(said).alias(f"said{c}"),
            F.count_if(true).alias(f"true{c}"),
        ]
    entries = []
    for c in classes:
        tp = F.col(f"tp{c}").cast("double")
        zero = F.lit(0.0)
        precision = F.coalesce(F.try_divide(tp, F.col(f"said{c}")), zero)
        recall = F.coalesce(F.try_divide(tp, F.col(f"true{c}")), zero)
        f1 = F.coalesce(
            F.try_divide(2 * tp, F.col(f"said{c}") + F.col(f"true{c}")), zero
        )
        entries.append(
            F.struct(
                F.lit(c).alias("class"),
                precision.alias("precision"),
                recall.alias("recall"),
                f1.alias("f1"),
                F.col(f"true{c}").alias("support"),
            )
        )
    return df.agg(*counts).select(F.explode(F.array(*entries)).alias("e")).select("e.*")
