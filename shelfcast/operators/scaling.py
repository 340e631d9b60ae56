"""Standard scores per series and the check for leaking inputs."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.numeric import ratio
from shelfcast.operators.folds import Fold, positions, test_rows


def unpivot(df: DataFrame, keys: Iterable[str], columns: Iterable[str]) -> DataFrame:
    """One row per key and column: ``feature``, ``value``."""
    columns = list(columns)
    return df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        list(keys), columns, "feature", "value"
    )


def _usable(std: Column) -> Column:
    return F.when(std == 0, F.lit(1.0)).otherwise(std)


def scaler_stats(train: DataFrame, columns: Iterable[str], series: str = "barcode") -> DataFrame:
    """Mean and population deviation of each column, one long row per series and column.

    All columns are aggregated in one pass; a deviation of 0 becomes 1.
    """
    columns = list(columns)
    wide = train.groupBy(series).agg(
        *[F.avg(F.col(c).cast("double")).alias(f"{c}__mean") for c in columns],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"{c}__std") for c in columns],
    )
    pairs = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("feature"),
                    F.col(f"{c}__mean").alias("mean"),
                    _usable(F.col(f"{c}__std")).alias("std"),
                )
                for c in columns
            ]
        )
    )
    return wide.select(series, pairs.alias("s")).select(series, "s.feature", "s.mean", "s.std")


def scale(
    df: DataFrame, columns: Iterable[str], is_train: Column, series: str = "barcode", suffix: str = ""
) -> DataFrame:
    """Standard scores with the statistics of the train rows of each series.

    The statistics are window aggregates over the series, so data that already
    lies by series is neither shuffled again nor joined to itself.
    """
    whole = Window.partitionBy(series)
    scaled = {}
    for c in columns:
        x = F.col(c).cast("double")
        known = F.when(is_train, x)
        std = F.stddev_pop(known).over(whole)
        scaled[f"{c}{suffix}"] = (x - F.avg(known).over(whole)) / _usable(std)
    return df.withColumns(scaled)


def window_sums(
    long: DataFrame, moments: Mapping[str, tuple[Callable, Column]], fold: Fold, series: str = "barcode"
) -> DataFrame:
    """``moments`` (an aggregate and its input each) over the train part of every window.

    ``long`` has ``position`` and ``n`` of a row in its series, and ``feature``. Rows are
    aggregated once per block of ``step`` rows and a window adds up its blocks and the
    head of the block after them, instead of copying each row into the many windows
    that hold it. Aggregates are sums, minima and maxima.
    """
    blocks_per_window, head = divmod(fold.train, fold.step)
    in_head = F.col("position") % fold.step < head
    blocks = long.groupBy(series, "feature", "n", F.floor(F.col("position") / fold.step).cast("int").alias("window_id")).agg(
        *[f(v).alias(k) for k, (f, v) in moments.items()],
        *[f(F.when(in_head, v)).alias(f"{k}_head") for k, (f, v) in moments.items()],
    )
    order = Window.partitionBy(series, "feature").orderBy("window_id")

    def over_window(name: str) -> Column:
        f = moments[name][0]
        tail = F.lead(f"{name}_head", blocks_per_window).over(order) if head else None
        if not blocks_per_window:
            return F.col(f"{name}_head")
        body = f(name).over(order.rowsBetween(0, blocks_per_window - 1))
        if tail is None:
            return body
        if f is F.sum:
            return body + tail
        return F.least(body, tail) if f is F.min else F.greatest(body, tail)

    windows = blocks.select(series, "feature", "window_id", "n", *[over_window(k).alias(k) for k in moments])
    return windows.where(F.col("window_id") * fold.step + fold.length <= F.col("n"))


def scaler_by_window(
    df: DataFrame, columns: Iterable[str], fold: Fold = Fold(), series: str = "barcode"
) -> DataFrame:
    """``series, window_id, feature, mean, std`` of the train part of every window: what was known when it ended.

    Values are centred on the series mean first, which keeps the sums of squares
    accurate. Nulls are skipped. A column that is constant in a window has deviation 1.
    """
    columns = list(columns)
    whole = Window.partitionBy(series)
    mean = {c: F.avg(F.col(c).cast("double")).over(whole) for c in columns}
    placed = positions(df.select(series, "date", *columns), series)
    pairs = [F.struct((F.col(c).cast("double") - mean[c]).alias("x"), mean[c].alias("centre")) for c in columns]
    centred = placed.select(series, "position", "n", *[p.alias(c) for p, c in zip(pairs, columns)])
    long = centred.unpivot([series, "position", "n"], columns, "feature", "_pair")
    long = long.select(series, "position", "n", "feature", F.col("_pair.x").alias("_x"), F.col("_pair.centre").alias("_centre"))
    x = F.col("_x")
    moments = {
        "rows": (F.sum, F.when(x.isNotNull(), 1).otherwise(0)),
        "sx": (F.sum, x),
        "sxx": (F.sum, x * x),
        "lo": (F.min, x),
        "hi": (F.max, x),
        "centre": (F.max, F.col("_centre")),
    }
    sums = window_sums(long, moments, fold, series)
    average = ratio(F.col("sx"), F.col("rows"))
    variance = F.greatest(ratio(F.col("sxx"), F.col("rows")) - average * average, F.lit(0.0))
    std = F.when(F.col("lo") == F.col("hi"), F.lit(1.0)).otherwise(_usable(F.sqrt(variance)))
    return sums.select(series, "window_id", "feature", (average + F.col("centre")).alias("mean"), F.when(F.col("rows") > 0, std).alias("std"))


def scaled_test_rows(
    df: DataFrame, columns: Iterable[str], fold: Fold = Fold(), series: str = "barcode", keep: Iterable[str] = ("quantity",)
) -> DataFrame:
    """The test rows of every window, scaled by the statistics of that window's train part only.

    The statistics are turned to one row per window and joined, so a backtest has
    no look-ahead. Rows of windows without statistics do not exist: both follow
    from the same positions.
    """
    columns, keep = list(columns), list(keep)
    stats = scaler_by_window(df, columns, fold, series)
    named = F.map_from_entries(F.collect_list(F.struct("feature", F.struct("mean", "std"))))  # one entry per column
    wide = stats.groupBy(series, "window_id").agg(named.alias("_stats"))
    rows = test_rows(df.select(series, "date", *dict.fromkeys([*keep, *columns])), fold, series)
    kept = [F.col(c) if c not in columns else F.col(c).alias(f"raw_{c}") for c in keep]
    score = lambda c: (F.col(c).cast("double") - F.col("_stats")[c]["mean"]) / F.col("_stats")[c]["std"]
    return rows.join(wide, [series, "window_id"]).select(series, "window_id", "date", *kept, *[score(c).alias(c) for c in columns])


def leakage_correlations(
    df: DataFrame,
    columns: Iterable[str],
    fold: Fold = Fold(),
    series: str = "barcode",
    target: str = "quantity",
    threshold: float = 0.99,
) -> DataFrame:
    """Correlation of every column with the target in the train part of every window.

    Values are centred on the series mean first, which keeps the sums of squares
    accurate. Constant columns and targets give null and are never suspicious.
    """
    columns = list(columns)
    whole = Window.partitionBy(series)
    centred = positions(df.select(series, "date", target, *columns), series).select(
        series,
        "position",
        "n",
        *[(F.col(c).cast("double") - F.avg(F.col(c).cast("double")).over(whole)).alias(c) for c in columns],
        (F.col(target) - F.avg(target).over(whole)).alias("_y"),
    )
    long = centred.unpivot([series, "position", "n", "_y"], columns, "feature", "_x")
    moments = {
        "n_rows": (F.sum, F.lit(1)),
        "sx": (F.sum, F.col("_x")),
        "sy": (F.sum, F.col("_y")),
        "sxx": (F.sum, F.col("_x") * F.col("_x")),
        "syy": (F.sum, F.col("_y") * F.col("_y")),
        "sxy": (F.sum, F.col("_x") * F.col("_y")),
        "lox": (F.min, F.col("_x")),
        "hix": (F.max, F.col("_x")),
        "loy": (F.min, F.col("_y")),
        "hiy": (F.max, F.col("_y")),
    }
    windows = window_sums(long, moments, fold, series)
    count = F.col("n_rows")
    cov = count * F.col("sxy") - F.col("sx") * F.col("sy")
    var_x = count * F.col("sxx") - F.col("sx") * F.col("sx")
    var_y = count * F.col("syy") - F.col("sy") * F.col("sy")
    varies = (F.col("lox") < F.col("hix")) & (F.col("loy") < F.col("hiy"))
    corr = F.when(varies, ratio(cov, F.sqrt(F.greatest(var_x, F.lit(0.0))) * F.sqrt(F.greatest(var_y, F.lit(0.0)))))
    return windows.select(series, "window_id", "feature", corr.alias("corr")).withColumn(
        "suspicious", F.coalesce(F.abs("corr") > threshold, F.lit(False)).cast("int")
    )
