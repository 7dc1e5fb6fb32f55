"""Leakage-safe time splits. Each assigns roles to rows; none collects rows anywhere."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duescope.operators.ordered import date_at_quantile, running_totals
from duescope.storage import stored

DATE = "snapshot_date"


def quantile_split(df: DataFrame, test_share: float = 0.2, val_share: float = 0.15,
                   date: str = DATE, told: bool = False) -> DataFrame:
    """train / val / test by row-weighted date quantiles: the test cut on all rows, then the
    validation cut on the development rows.

    `told` looks the two dates up at once, for a stored `df`: the roles are then conditions on its
    dates, which are pushed into its scan, and need no copy of the rows.
    """
    def value(cut: DataFrame) -> Column:
        if not told:
            return cut.scalar()
        found = cut.first()  # none without rows
        return F.lit(found[0] if found else None).cast(cut.schema[0].dataType)

    test_cut = value(date_at_quantile(df, date, 1 - test_share))
    marked = df.withColumn("_dev", F.col(date) <= test_cut)
    val_cut = value(date_at_quantile(df.filter(F.col(date) <= test_cut), date, 1 - val_share))
    role = (
        F.when(~F.col("_dev"), "test").when(F.col(date) > val_cut, "val").otherwise("train")
    )
    return marked.withColumn("role", role).drop("_dev")


def fixed_split(df: DataFrame, train_until: dt.date, val_until: dt.date, date: str = DATE
                ) -> DataFrame:
    """Literal boundaries: train < train_until <= val < val_until <= test."""
    role = (
        F.when(F.col(date) < train_until, "train").when(F.col(date) < val_until, "val")
        .otherwise("test")
    )
    return df.withColumn("role", role)


def fold_bounds(df: DataFrame, n_splits: int, gap_days: int = 30, date: str = DATE, to_last: bool = True) -> DataFrame:
    """(fold, train_end, val_start, val_end) over the distinct dates, one row per fold.

    Folds hold equal counts of dates. The last fold validates up to the last date; without
    `to_last` it ends like the others, one date after its share or at the last date.
    Distinct dates are few (a calendar), so one array holds them.
    """
    dates = df.agg(F.array_sort(F.collect_set(date)).alias("d"))
    sized = dates.withColumns({
        "n": F.size("d"), "size": F.floor(F.size("d") / (n_splits + 1)).cast("int"),
    }).filter(F.col("size") > 0)
    folds = sized.withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(n_splits))))
    last = F.element_at("d", F.col("n"))
    stop = F.least(F.col("size") * (F.col("fold") + 1) + 1, F.col("n"))
    return folds.select(
        "fold", F.element_at("d", F.col("size") * F.col("fold")).alias("train_end"),
        F.when((F.col("fold") == n_splits) & F.lit(to_last), last)
        .otherwise(F.element_at("d", stop)).alias("val_end"),
    ).select(
        "fold", "train_end", F.date_add("train_end", gap_days).alias("val_start"), "val_end")


def walk_forward(df: DataFrame, n_splits: int = 5, gap_days: int = 30, date: str = DATE,
                 label: str = "target", to_last: bool = True, both_classes: bool = True) -> DataFrame:
    """Rows with (fold, role): train up to the fold's end, val after the embargo.

    Folds without validation rows are dropped, and with `both_classes` those with a single class in
    training.
    """
    bounds = fold_bounds(df, n_splits, gap_days, date, to_last)
    table = bounds.agg(F.array_sort(F.collect_list(F.struct(*bounds.columns)))).scalar()
    day = F.col(date)
    placed = (
        df.withColumn("_f", F.explode(table))
        .withColumn("role", F.when(day <= F.col("_f.train_end"), "train").when(
            day.between(F.col("_f.val_start"), F.col("_f.val_end")), "val"))
        .filter(F.col("role").isNotNull())
        .withColumn("fold", F.col("_f.fold")).drop("_f")
    )
    in_train = F.col("role") == "train"
    usable = placed.groupBy("fold").agg(
        F.count_if(~in_train).alias("val_rows"),
        F.min(F.when(in_train, F.col(label))).alias("lo"),
        F.max(F.when(in_train, F.col(label))).alias("hi"),
    ).filter((F.col("val_rows") > 0) & ((F.col("lo") < F.col("hi")) | F.lit(not both_classes)))
    return placed.join(usable.select("fold"), "fold", "left_semi")


def usable_bounds(df: DataFrame, n_splits: int = 5, gap_days: int = 30, date: str = DATE, label: str = "target",
                  to_last: bool = True) -> list[tuple[dt.date, dt.date, dt.date]]:
    """(train_end, val_start, val_end) of the folds `walk_forward` keeps. A fold is then a filter on
    one stored panel, which isn't multiplied by the folds."""
    bounds = [(r["train_end"], r["val_start"], r["val_end"]) for r in fold_bounds(df, n_splits, gap_days, date, to_last).orderBy("fold").collect()]
    if not bounds:
        return []
    day, y = F.col(date), F.col(label)
    found = df.agg(*[c.alias(f"{n}{i}") for i, (end, start, stop) in enumerate(bounds) for n, c in (
        ("v", F.count_if(day.between(F.lit(start), F.lit(stop)))), ("lo", F.min(F.when(day <= F.lit(end), y))), ("hi", F.max(F.when(day <= F.lit(end), y))))]).first()
    return [b for i, b in enumerate(bounds) if found[f"v{i}"] and found[f"lo{i}"] is not None and found[f"lo{i}"] < found[f"hi{i}"]]


def fold_diagnostics(folds: DataFrame, by: str = "country", label: str = "target",
                     min_rows: int = 30, min_positives: int = 100) -> DataFrame:
    """Rows and positives per fold, role and group, with a sparse flag."""
    return folds.groupBy("fold", "role", by).agg(
        F.count("*").alias("n"), F.count_if(F.col(label) == 1).alias("positives")
    ).withColumn(
        "sparse",
        ((F.col("n") < min_rows) | (F.col("positives") < min_positives)).cast("int"))


def last_rows_split(df: DataFrame, tie: Column, share: float = 0.15, at_least: int = 20,
                    date: str = DATE) -> DataFrame:
    """val = the last max(floor(n * share), at_least) rows by (date, tie), train = the rest.

    Whole dates are decided from the date histogram; only the rows of the one date that is
    split are ranked, by running counts over their tie keys.
    """
    keyed = df.withColumn("_tie", tie)
    histogram = stored(keyed.groupBy(date).agg(F.count("*").alias("n")))
    size = histogram.agg(F.sum("n")).scalar()
    wanted = F.greatest(F.floor(size * F.lit(share)), F.lit(at_least))
    later = running_totals(histogram, [], date, ["n"]).withColumns({
        "after": size - F.col("cum_n"), "wanted": wanted})
    split = later.filter(
        (F.col("after") < F.col("wanted")) & (F.col("wanted") <= F.col("after") + F.col("n"))
    ).agg(F.max(F.struct(
        F.col(date).alias("d"), (F.col("wanted") - F.col("after")).alias("take"), "n")))
    found = split.scalar()
    day, take, here = found["d"], found["take"], found["n"]
    ties = stored(
        keyed.filter(F.col(date) == day).groupBy("_tie").agg(F.count("*").alias("n")))
    ranked = running_totals(ties, [], "_tie", ["n"])
    first_in = ranked.filter(F.col("cum_n") > here - take).agg(F.min("_tie")).scalar()
    # fewer rows than wanted: no date is split and everything is validation
    inside = (F.col(date) > day) | ((F.col(date) == day) & (F.col("_tie") >= first_in))
    return keyed.withColumn(
        "role", F.when(F.coalesce(inside, F.lit(True)), "val").otherwise("train")).drop("_tie")


def guarded_val_split(df: DataFrame, tie: Column, val_share: float = 0.15, date: str = DATE,
                      label: str = "target") -> DataFrame:
    """Date-quantile train / val; if val has a single class, the last rows instead."""
    cut = date_at_quantile(df, date, 1 - val_share).scalar()
    by_date = df.withColumn("role", F.when(F.col(date) > cut, "val").otherwise("train"))
    classes = by_date.filter(F.col("role") == "val").agg(
        F.count_distinct(label).alias("k")).scalar()
    by_rows = last_rows_split(df, tie, val_share, 20, date)
    return by_date.filter(classes >= 2).unionByName(by_rows.filter(classes < 2))


def leave_one_out(df: DataFrame, pool: str = "cluster", group: str = "country") -> DataFrame:
    """Every row under each member of its pool as held_out: test when it is the own group.

    Multiplies rows by the number of groups in a pool, which is a short list.
    """
    members = df.groupBy(pool).agg(F.array_sort(F.collect_set(group)).alias("_members"))
    return (
        df.join(members, pool)
        .withColumn("held_out", F.explode("_members")).drop("_members")
        .withColumn("role", F.when(F.col(group) == F.col("held_out"), "test").otherwise("train"))
    )
