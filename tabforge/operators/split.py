"""K1-K3: deterministic folds and exact samples that scale.

A row's place in the shuffled order is ``md5(id:seed)`` (ties broken by the
id columns), so folds and samples are reproducible, independent of
partitioning, and recomputable after an executor loss. Ranks come from
``ranking.hash_rank`` (two-phase, bucketed): no window holds a whole class.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.functions.columns import quoted
from tabforge.operators.ranking import (MAX_BRACKET_ROWS, _Bracket, hash_rank, hash_sample, md5_key, order_statistics,
                                        with_row_index)

#: classes (a value of the label each) whose cuts are held as literals
MAX_CUT_CLASSES = 256


def _atomic_cols(df: DataFrame) -> list[str]:
    from pyspark.sql import types as T
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.AtomicType, T.NullType))]


def _key_cols(df: DataFrame, id_cols: list[str] | None) -> list[str]:
    # without an id, the whole row is the identity (rows equal in every column
    # are interchangeable)
    return list(id_cols) if id_cols else _atomic_cols(df)


def _tiebreak(df: DataFrame, keys: list[str], unique: bool, row_cols: list[str] | None = None) -> list:
    # unique ids: the id settles ties. Ids that may repeat: after the id, order
    # by a hash of the row (``row_cols``, default every atomic column)
    if unique:
        return list(keys)
    rest = [c for c in (row_cols or _atomic_cols(df)) if c not in keys]
    return list(keys) + ([md5_key(rest, 0)] if rest else [])


def assign_folds(df: DataFrame, k: int = 5, seed: int = 42, label: str | None = None,
                 id_cols: list[str] | None = None, fold_col: str = "fold",
                 n_buckets: int | None = None, n_classes_bound: int | None = None,
                 ids_unique: bool = True, row_cols: list[str] | None = None,
                 exact: bool = True, dealt: str = "turns") -> DataFrame:
    """K1 (``label`` given: stratified) / K2 (plain): ``fold_col`` in 0..k-1.

    Within each class the rows are ranked by ``md5(id:seed)`` and dealt out
    round-robin, so per class the fold sizes differ by at most one. With
    ``ids_unique=False`` ties between equal ids are broken by a hash of
    ``row_cols`` (default: all atomic columns) so the result stays
    deterministic when a task is recomputed. ``dealt="ranges"`` gives each fold
    one range of the shuffled order instead (see ``folds_by_cuts``), which moves
    no rows."""
    if k < 2:
        raise ValueError("k must be >= 2")
    if dealt not in ("turns", "ranges"):
        raise ValueError("dealt must be 'turns' or 'ranges'")
    if exact and dealt == "ranges":
        out = folds_by_cuts(df, k, seed, label, id_cols, fold_col, ids_unique, row_cols)
        if out is not None:
            return out
    keys = _key_cols(df, id_cols)
    key = md5_key(keys, seed)
    if not exact:
        # shuffle-free variant for very large inputs: fold = md5(id:seed) mod k.
        # Folds are balanced in expectation (relative spread ~ sqrt(k / n)),
        # not to within one row per class.
        return df.withColumn(fold_col, (F.conv(F.substring(key, 1, 8), 16, 10).cast("long") % k).cast("int"))
    groups = [label] if label else []
    ranked = hash_rank(df, key, group_cols=groups,
                       tiebreak=_tiebreak(df, keys, ids_unique and bool(id_cols), row_cols), n_buckets=n_buckets,
                       rank_col="_fold_rank", n_groups_bound=n_classes_bound if label else 1)
    # without a proven class bound no broadcast hint is given: AQE broadcasts
    # the offsets table on its measured size, or keeps a sort-merge join
    return ranked.withColumn(fold_col, ((F.col("_fold_rank") - 1) % k).cast("int")).drop("_fold_rank")


def _fold_key(key):
    """The md5 key's first 52 bits, which a double holds exactly."""
    return F.conv(F.substring(key, 1, 13), 16, 10).cast("double")


def folds_by_cuts(df: DataFrame, k: int, seed: int, label: str | None, id_cols: list[str] | None, fold_col: str = "fold",
                  ids_unique: bool = True, row_cols: list[str] | None = None, bracket_rows: int = MAX_BRACKET_ROWS,
                  max_classes: int = MAX_CUT_CLASSES) -> DataFrame | None:
    """K1 / K2 without moving rows: fold j holds the ranks from ceil(j n / k) on
    of each class's shuffled order, so a row's fold follows from comparing its
    key with the class's k - 1 cut keys. The cuts are exact order statistics of
    the keys (quantile sketches, then counts inside brackets; see
    ``ranking.order_statistics``); only classes x (k - 1) numbers reach the
    driver. Rows that share a cut's key are equal rows; those at a cut inside
    such a run are dealt by their place.

    None for more than ``max_classes`` values of the label: their rows are ranked
    instead. ``df`` is read several times and should be stored."""
    keys = _key_cols(df, id_cols)
    rest = [] if ids_unique and id_cols else [c for c in (row_cols or _atomic_cols(df)) if c not in keys]
    base = df.withColumn("_fk", _fold_key(md5_key(keys + rest, seed)))
    group = quoted(label) if label else F.lit(0)
    probs = [min(1.0, max(0.0, j / k + d)) for j in range(1, k) for d in (-4e-4, 4e-4)]
    classes = base.groupBy(group.alias("c")).agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("_fk", probs, 10_000).alias("q")) \
        .limit(max_classes + 1).collect()
    if len(classes) > max_classes:
        return None
    columns, brackets = {}, {}
    for i, r in enumerate(classes):
        in_class = group.isNull() if r["c"] is None else group == F.lit(r["c"])
        for j in range(1, k):
            rank = -(-j * r["n"] // k)
            if rank < r["n"]:
                columns[f"{i}/{j}"] = F.when(in_class, F.col("_fk"))
                brackets[f"{i}/{j}"] = _Bracket(rank, rank, float(r["q"][2 * j - 2]), float(r["q"][2 * j - 1]), r["n"] * 8e-4,
                                                most=bracket_rows)
    found = order_statistics(base.select("_fk", *([group.alias(label)] if label else [])), columns, brackets)
    cuts, runs = F.array().cast("array<double>"), {}
    for i, r in enumerate(classes):
        in_class = group.isNull() if r["c"] is None else group == F.lit(r["c"])
        mine = {j: found[f"{i}/{j}"][0] for j in range(1, k) if f"{i}/{j}" in found}
        cuts = F.when(in_class, F.array(*[F.lit(v) for v, _, _ in mine.values()]).cast("array<double>")).otherwise(cuts)
        for j, (value, first, n) in mine.items():
            if first < brackets[f"{i}/{j}"].k1:         # the cut is inside a run of equal keys
                runs.setdefault((i, value), (in_class, first, n, r["n"]))
    cut_folds = base.withColumn("_cuts", cuts).withColumn(
        fold_col, F.size(F.filter("_cuts", lambda v: v <= F.col("_fk"))).cast("int")).drop("_cuts")
    if not runs:
        return cut_folds.drop("_fk")
    tied = F.lit(False)
    parts = []
    for (_, value), (in_class, first, n, size) in runs.items():
        mine = F.coalesce(in_class, F.lit(False)) & (F.col("_fk") == F.lit(value))
        tied = tied | mine
        placed = with_row_index(base.filter(mine), "_place")
        parts.append(placed.withColumn(fold_col, F.floor((F.col("_place") + F.lit(first)) * k / F.lit(size)).cast("int"))
                     .drop("_fk", "_place"))
    out = cut_folds.filter(~tied).drop("_fk")
    for part in parts:
        out = out.unionByName(part)
    return out


def sample_exact(df: DataFrame, frac: float, seed: int = 42, id_cols: list[str] | None = None,
                 n_buckets: int | None = None, ids_unique: bool = True,
                 row_cols: list[str] | None = None) -> DataFrame:
    """K3: exactly ``max(int(n * frac), 1)`` rows (all rows when frac >= 1),
    the ones first in ``md5(id:seed)`` order."""
    if frac >= 1.0:
        return df
    n = df.count()
    n_keep = max(int(n * frac), 1)
    keys = _key_cols(df, id_cols)
    return hash_sample(df, md5_key(keys, seed), n_keep,
                       tiebreak=_tiebreak(df, keys, ids_unique and bool(id_cols), row_cols),
                       n_buckets=n_buckets, n_rows=n)


MAX_CLASSES = 64


def class_counts(df: DataFrame, label: str) -> list[tuple]:
    """Per-class row counts; refuses a label with more than MAX_CLASSES values
    (the collect is bounded)."""
    rows = (df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
            .limit(MAX_CLASSES + 1).collect())
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"label '{label}' has more than {MAX_CLASSES} classes")
    return [(r[label], int(r["n"])) for r in rows]


def class_weight_frame(df: DataFrame, label: str) -> DataFrame:
    """M8: ``balanced`` weights ``n / (n_classes * n_c)`` per class value."""
    counts = class_counts(df, label)
    total, k = sum(n for _, n in counts), len(counts)
    dtype = df.schema[label].dataType.simpleString()
    return df.sparkSession.createDataFrame([(v, n, total / (k * n)) for v, n in counts],
                                           f"`{label}` {dtype}, n long, weight double")


def with_class_weights(df: DataFrame, label: str, weight_col: str = "weight",
                       mode: str | None = "balanced") -> DataFrame:
    """Attach a weight column (1.0 when ``mode`` is None): a CASE over the
    bounded per-class weights, no join."""
    if mode is None:
        return df.withColumn(weight_col, F.lit(1.0))
    if mode != "balanced":
        raise ValueError(f"unsupported class_weight: {mode}")
    counts = class_counts(df, label)
    total, k = sum(n for _, n in counts), len(counts)
    expr = None
    for v, n in counts:
        cond = F.col(label) == F.lit(v)
        expr = F.when(cond, F.lit(total / (k * n))) if expr is None else expr.when(cond, F.lit(total / (k * n)))
    return df.withColumn(weight_col, expr.otherwise(F.lit(1.0)) if expr is not None else F.lit(1.0))
