"""Exact ranks and order statistics without a single-partition window.

Shared by folds / sampling (K1-K3), median imputation (A2) and ROC AUC (E1).

* ``hash_rank`` -- exact ``row_number() over (partition by g order by key)``
  in two phases: rows are spread over ``B`` order-preserving buckets of the
  key, a tiny ``(g, bucket) -> count`` table gives each bucket its running
  offset, and ``row_number`` runs per ``(g, bucket)``. A hot group (one label
  holding most rows) is split over all ``B`` buckets, so no task holds it.
* ``exact_medians`` -- exact median (mean of the two middle values) by
  bracketing the middle ranks with ``percentile_approx``, all columns
  together, and ranking only the few rows inside the brackets.
* ``broadcast_if_small`` -- broadcast only behind a proven row bound.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabforge.functions.columns import quoted

# rows one broadcast side may hold (bounded tables only: offsets, forests)
BROADCAST_ROW_LIMIT = 2_000_000
# target rows per rank bucket (one window task)
ROWS_PER_BUCKET = 2_000_000
_HEX8 = 4294967296  # 16 ** 8
# rows a median bracket may hold before it is narrowed further
MAX_BRACKET_ROWS = 2_000_000
# cells and accuracy of the quantiles that narrow a bracket, and rounds at most
GRID, GRID_ACCURACY = 256, 10_000
MAX_ROUNDS = 60


def broadcast_if_small(df: DataFrame, row_bound: int, limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Broadcast hint only when ``row_bound`` (a bound known by construction,
    not an estimate) is under ``limit``; otherwise leave the join to the planner
    (sort-merge / AQE)."""
    return F.broadcast(df) if row_bound <= limit else df


def md5_key(cols: list[Column | str], seed: int) -> Column:
    """Deterministic shuffle key: md5 of ``col1|col2|...:seed`` (hex)."""
    parts = [F.coalesce(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"),
                        F.lit("\\N")) for c in cols]
    return F.md5(F.concat(F.concat_ws("|", *parts), F.lit(f":{seed}")))


def _hex_bucket(key: Column, n_buckets: int) -> Column:
    """Order-preserving bucket of an md5 hex key (first 8 hex digits)."""
    if n_buckets <= 1:
        return F.lit(0)
    prefix = F.conv(F.substring(key, 1, 8), 16, 10).cast("long")
    return F.floor(prefix * F.lit(n_buckets) / F.lit(_HEX8)).cast("int")


def choose_buckets(n_rows: int, rows_per_bucket: int = ROWS_PER_BUCKET, max_buckets: int = 1 << 16) -> int:
    return int(min(max_buckets, max(1, math.ceil(n_rows / max(1, rows_per_bucket)))))


def shuffle_buckets(df: DataFrame) -> int:
    """Rank buckets: one per shuffle partition of the session. The count only
    sets how many window tasks share the ranking; every value gives the same
    ranks, and it does not depend on the input's files."""
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def with_row_index(df: DataFrame, index_col: str = "index") -> DataFrame:
    """``index_col`` 0..n-1 in the order of the partitions: counts per partition
    (one small job, no shuffle of rows) give each its offset. ``df`` should read
    stored rows, so that both passes see the same partitions."""
    place = F.monotonically_increasing_id()
    tagged = df.withColumn("_ix_row", place)
    counts = tagged.groupBy(F.shiftright("_ix_row", 33).alias("_ix_part")).agg(F.count(F.lit(1)).alias("_ix_n"))
    # one row a partition of the input: a window over it is bounded
    before = Window.orderBy("_ix_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_ix_part", F.coalesce(F.sum("_ix_n").over(before), F.lit(0)).alias("_ix_off"))
    return (tagged.withColumn("_ix_part", F.shiftright("_ix_row", 33)).join(F.broadcast(offsets), "_ix_part")
            .withColumn(index_col, F.col("_ix_off") + F.col("_ix_row").bitwiseAND(F.lit((1 << 33) - 1)))
            .drop("_ix_row", "_ix_part", "_ix_off"))


def hash_rank(df: DataFrame, key: Column, group_cols: list[str] | None = None,
              tiebreak: list[Column | str] | None = None, n_buckets: int | None = None,
              rank_col: str = "_rank", n_groups_bound: int | None = None) -> DataFrame:
    """Adds ``rank_col`` = 1-based row number ordered by ``key`` (then
    ``tiebreak``) within ``group_cols``.

    ``key`` must be an md5 hex string (uniform, order-preserving buckets).
    ``n_groups_bound`` bounds the number of groups (e.g. 2 for a binary
    label); it sizes the offsets table for the broadcast decision.
    """
    group_cols = list(group_cols or [])
    tiebreak = list(tiebreak or [])
    if n_buckets is None:
        n_buckets = shuffle_buckets(df)
    keyed = df.withColumn("_rk_b", _hex_bucket(key, n_buckets))
    counts = keyed.groupBy(*group_cols, "_rk_b").agg(F.count(F.lit(1)).alias("_rk_n"))
    w_off = Window.partitionBy(*group_cols).orderBy("_rk_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*group_cols, "_rk_b",
                            F.coalesce(F.sum("_rk_n").over(w_off), F.lit(0)).alias("_rk_off"))
    if not group_cols:
        bound = n_buckets                      # one offset row per bucket
    elif n_groups_bound is not None:
        bound = n_buckets * n_groups_bound     # proven by the caller
    else:
        bound = None                           # unknown: let AQE decide on measured size
    # null-safe: rows without a group value are a group of their own
    keys = [*group_cols, "_rk_b"]
    side = offsets.select(*[quoted(c).alias(f"_rk_k{i}") for i, c in enumerate(keys)], "_rk_off")
    side = broadcast_if_small(side, bound) if bound is not None else side
    joined = keyed.join(side, [quoted(c).eqNullSafe(F.col(f"_rk_k{i}")) for i, c in enumerate(keys)]) \
        .drop(*[f"_rk_k{i}" for i in range(len(keys))])
    # dealt as the window needs them, and keyed there: the shuffle carries no keys
    joined = joined.repartition(*[quoted(c) for c in keys]).withColumn("_rk_key", key)
    order = [F.col("_rk_key")] + [F.col(t) if isinstance(t, str) else t for t in tiebreak]
    w = Window.partitionBy(*group_cols, "_rk_b").orderBy(*order)
    return (joined.withColumn(rank_col, (F.col("_rk_off") + F.row_number().over(w)).cast("long"))
            .drop("_rk_key", "_rk_b", "_rk_off"))


def hash_sample(df: DataFrame, key: Column, n_keep: int, tiebreak: list[Column | str] | None = None,
                n_buckets: int | None = None, n_rows: int | None = None) -> DataFrame:
    """Exactly the ``n_keep`` rows with the smallest ``key`` (then tiebreak).

    Buckets that fall wholly under the cut pass through a filter (no shuffle);
    only the one bucket that straddles the cut is ranked."""
    tiebreak = list(tiebreak or [])
    if n_rows is None:
        n_rows = df.count()
    if n_buckets is None:
        n_buckets = choose_buckets(n_rows)
    keyed = df.withColumn("_rk_key", key).withColumn("_rk_b", _hex_bucket(F.col("_rk_key"), n_buckets))
    counts = keyed.groupBy("_rk_b").agg(F.count(F.lit(1)).alias("_rk_n"))
    w_off = Window.orderBy("_rk_b").rowsBetween(Window.unboundedPreceding, -1)
    # the counts table has at most n_buckets rows: a one-partition window over it is bounded
    offs = counts.select("_rk_b", "_rk_n", F.coalesce(F.sum("_rk_n").over(w_off), F.lit(0)).alias("_rk_off"))
    # the one bucket that straddles the cut (a single small row)
    cut = offs.where((F.col("_rk_off") < n_keep) & (F.col("_rk_off") + F.col("_rk_n") > n_keep)).collect()
    # buckets are ordered: every bucket before the straddling one is kept whole
    last_full = cut[0]["_rk_b"] if cut else n_buckets
    parts = []
    if last_full > 0:
        parts.append(keyed.where(F.col("_rk_b") < last_full))
    if cut:
        r = cut[0]
        order = [F.col("_rk_key")] + [F.col(t) if isinstance(t, str) else t for t in tiebreak]
        w = Window.partitionBy("_rk_b").orderBy(*order)
        part = (keyed.where(F.col("_rk_b") == r["_rk_b"])
                .withColumn("_rk_rn", F.row_number().over(w))
                .where(F.col("_rk_rn") <= n_keep - r["_rk_off"]).drop("_rk_rn"))
        parts.append(part)
    if not parts:
        return df.limit(0)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.drop("_rk_key", "_rk_b")


# ---------------------------------------------------------------------------
# exact median
# ---------------------------------------------------------------------------

def _accuracy_for(n: int) -> int:
    # rank error of percentile_approx is about n / accuracy; keep the bracket
    # (a few times that) near 1e5 rows, within the sketch's sane range
    return int(min(1_000_000, max(10_000, n // 50_000)))


def median_sketch_exprs(col: str, n_rows_hint: int | None = None) -> list[Column]:
    """Aggregate expressions for pass 1 of ``exact_medians`` (fusable into a
    bigger statistics ``agg``): valid count and a bracket of approximate
    quantiles around the middle."""
    acc = _accuracy_for(n_rows_hint or 0)
    eps = 4.0 / acc
    probs = [max(0.0, 0.5 - eps), min(1.0, 0.5 + eps)]
    c = quoted(col)
    return [F.count(c).alias(f"_med_n__{col}"),
            F.percentile_approx(c, probs, acc).alias(f"_med_q__{col}")]


@dataclass
class _Bracket:
    """Where the two middle values of a column lie."""

    k1: int                     # 0-based ranks of the two middle values
    k2: int
    lo: float
    hi: float
    inside: float               # values in [lo, hi]; an estimate until they are counted
    outer: tuple[float, float] = (-math.inf, math.inf)      # counted to hold both ranks
    settled: bool = False       # counted, and few or few different values inside
    most: int = 0               # values that a bracket may hold

    @property
    def wide(self) -> bool:
        return not self.settled and self.inside > self.most

    def narrow(self, below: int, upto: int, grid: list[float] | None) -> None:
        """From the counts of values under lo and up to hi, and quantiles inside."""
        if below > self.k1 or upto <= self.k2:
            # the sketch missed: look beside the bracket, inside the last sure one
            self.lo, self.hi = (self.outer[0], self.hi) if below > self.k1 else (self.lo, self.outer[1])
            if below > self.k1 and upto <= self.k2:
                self.lo, self.hi = self.outer
            self.inside = math.inf
            return
        self.inside, before, self.outer = upto - below, (self.lo, self.hi), (self.lo, self.hi)
        if self.inside <= self.most or not grid or self.lo == self.hi:
            self.settled = True
            return
        cells, eps = len(grid) - 1, 4.0 / GRID_ACCURACY
        first = math.floor(((self.k1 - below) / self.inside - eps) * cells)
        last = math.ceil(((self.k2 - below + 1) / self.inside + eps) * cells)
        self.lo, self.hi = max(self.lo, float(grid[max(0, first)])), min(self.hi, float(grid[min(cells, last)]))
        self.inside *= (last - first) / cells
        self.settled = (self.lo, self.hi) == before         # few different values: counting them is cheap


def order_statistics(df: DataFrame, columns: dict[str, Column], brackets: dict[str, _Bracket]) -> dict[str, list]:
    """For every bracket's column, (value, rank of its first row, rows) of the
    values at the ranks k1 and k2 of its non-null values in ascending order.

    Every round is ONE aggregate for all columns whose bracket is still wide: it
    counts the values under and in the bracket and takes a grid of quantiles
    inside it, from which the next bracket follows. When all brackets are small,
    one more job counts the values inside them: every row gives a (column,
    value-or-below) entry per column whose bracket top it is under, and a window
    partitioned by column ranks the bounded table of values. A bracket that
    missed its ranks is opened again. The jobs grow with the logarithm of the
    rows (a round divides a bracket by about ``GRID`` / 2), not with the columns."""
    out: dict[str, list] = {}
    open_ = dict(brackets)
    probs = [i / GRID for i in range(GRID + 1)]
    for _ in range(MAX_ROUNDS):
        if not open_:
            return out
        wide = {i: b for i, (c, b) in enumerate(open_.items()) if b.wide}
        if wide:
            names = list(open_)
            exprs = []
            for i, b in wide.items():
                c = columns[names[i]]
                exprs += [F.count_if(c < b.lo).alias(f"a{i}"), F.count_if(c <= b.hi).alias(f"b{i}"),
                          F.percentile_approx(F.when((c >= b.lo) & (c <= b.hi), c), probs, GRID_ACCURACY).alias(f"q{i}")]
            row = df.agg(*exprs).collect()[0]
            for i, b in wide.items():
                b.narrow(int(row[f"a{i}"]), int(row[f"b{i}"]), row[f"q{i}"])
            continue
        for name, found in _at_ranks(df, columns, open_).items():
            bracket = open_[name]
            if None not in found:
                out[name] = found
                del open_[name]
            else:
                bracket.lo, bracket.hi = bracket.outer
                bracket.inside, bracket.settled = math.inf, False
    raise RuntimeError(f"ranks of {sorted(open_)} did not settle in {MAX_ROUNDS} rounds")


def _at_ranks(df: DataFrame, columns: dict[str, Column], brackets: dict[str, _Bracket]) -> dict[str, list]:
    """(value, rank of its first row, rows) at both ranks of each bracket, None outside it."""
    pairs = []
    for i, (name, b) in enumerate(brackets.items()):
        c = columns[name]
        pairs.append(F.when(c <= F.lit(b.hi), F.struct(F.lit(i).alias("i"), F.when(c >= F.lit(b.lo), c.cast("double")).alias("v"))))
    exploded = df.select(F.explode(F.array(*pairs)).alias("p")).where(F.col("p").isNotNull()).select("p.i", "p.v")
    grouped = exploded.groupBy("i", "v").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("i").orderBy(F.col("v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    ranked = grouped.select("i", "v", "n", F.sum("n").over(w).alias("cum"))
    k1s, k2s = [F.element_at(F.array(*[F.lit(getattr(b, k)).cast("long") for b in brackets.values()]), F.col("i") + 1)
                for k in ("k1", "k2")]
    picks = ranked.where(F.col("v").isNotNull() & (F.col("cum") - F.col("n") <= k2s) & (F.col("cum") > k1s)).collect()

    def at(i: int, k: int):
        return next(((float(r["v"]), r["cum"] - r["n"], r["n"]) for r in picks
                     if r["i"] == i and r["cum"] - r["n"] <= k < r["cum"]), None)

    return {name: [at(i, b.k1), at(i, b.k2)] for i, (name, b) in enumerate(brackets.items())}


def exact_medians_from_sketches(df: DataFrame, sketches: dict[str, tuple[int, list[float] | None]],
                                accuracy: int = 10_000, bracket_rows: int | None = None) -> dict[str, float | None]:
    """Exact medians of several columns from their pass-1 sketches, all
    columns together."""
    most = MAX_BRACKET_ROWS if bracket_rows is None else bracket_rows
    brackets = {col: _Bracket((n - 1) // 2, n // 2, float(q[0]), float(q[1]), n * 8.0 / accuracy, most=most)
                for col, (n, q) in sketches.items() if n and q is not None}
    columns = {col: quoted(col) for col in brackets}
    found = order_statistics(df, columns, brackets)
    return {col: (found[col][0][0] + found[col][1][0]) / 2.0 if col in found else None for col in sketches}


def exact_medians(df: DataFrame, cols: list[str], bracket_rows: int | None = None) -> dict[str, float | None]:
    """Exact median of each column (nulls ignored); None for an all-null column."""
    if not cols:
        return {}
    exprs = []
    for c in cols:
        exprs += median_sketch_exprs(c, None)
    row = df.agg(*exprs).collect()[0]
    return exact_medians_from_sketches(
        df, {c: (int(row[f"_med_n__{c}"]), row[f"_med_q__{c}"]) for c in cols}, _accuracy_for(0), bracket_rows)
