"""Metadata-driven feature preparation.

``FeaturePrep(spec).fit(df)`` runs

* one statistics aggregate over all numeric features (valid count, mean,
  population variance, and the median sketch of median-imputed columns);
  the mean / std *after* imputation follow from these without a second scan;
* one vocabulary aggregate over all categorical features
  (``explode(array(struct(feature, value)))`` -> ``groupBy(feature, value)``,
  partially aggregated map-side, so a hot value is one row per task);
* for median-imputed columns, the exact bracket pass of ``ranking``.

``FeaturePrepModel.transform(df)`` is a single projection (one expression per
output column), so Catalyst prunes the scan to the used columns and whole-stage
codegen compiles it; it also accepts a streaming DataFrame.

Output order and names (fixed by the reference contract): every numeric
feature as ``<c>_missing``, ``<c>``; then each categorical feature as
``<c>_<value>`` ... , ``<c>_missing``; then each boolean feature as ``<c>``,
``<c>_missing``. Numeric values are imputed then standard-scaled with the
population std (zero std -> divide by 1). One-hot keeps every category and
maps an unseen value to all zeros.
"""

from __future__ import annotations

import json
import math
import warnings
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.functions.columns import quoted
from tabforge.operators.dictionary import Dictionary, encode, fit_dictionary
from tabforge.operators.ranking import _accuracy_for, exact_medians_from_sketches, median_sketch_exprs
from tabforge.sources.readers import to_bool_double, to_category, to_double
from tabforge.spec import FeatureSpec

MISSING_SUFFIX = "_missing"
SPARSE_SUFFIX = "_onehot"


def _encode_sparse(df: DataFrame, col: str, vocab: list[str]) -> DataFrame:
    """Replace the string column ``col`` by a sparse one-hot vector over
    ``vocab`` (Spark's StringIndexer / OneHotEncoder: the value -> index map is
    a JVM hash lookup, not a plan expression)."""
    from pyspark.ml.feature import OneHotEncoder, StringIndexerModel
    idx, vec = f"{col}__idx", f"{col}__vec"
    indexed = StringIndexerModel.from_labels(vocab, inputCol=col, outputCol=idx,
                                             handleInvalid="keep").transform(df)
    # the indexer's "keep" adds an unknown label as the last category; dropLast
    # removes exactly that slot, so unseen values encode as all zeros
    encoded = OneHotEncoder(inputCols=[idx], outputCols=[vec], dropLast=True,
                            handleInvalid="error").fit(indexed).transform(indexed)
    cols = [F.col(vec).alias(col) if c == col else quoted(c) for c in df.columns]
    return encoded.select(*cols)


@dataclass
class NumericStat:
    name: str
    impute: str
    fill: float
    mean: float          # mean after imputation
    scale: float         # population std after imputation (1.0 when zero)
    n_valid: int
    n_rows: int


@dataclass
class CategoryStat:
    name: str
    impute: str
    fill: str
    vocab: list[str]
    n_null: int
    sparse: bool = False      # encoded as one sparse vector column (large vocabulary)


def _q(name: str) -> Column:
    return quoted(name)


def imputed_moments(n: int, n_valid: int, mean: float | None, var_pop: float | None,
                    fill: float) -> tuple[float, float]:
    """Mean and population variance of a column after its ``n - n_valid``
    nulls are replaced by ``fill``, from the valid-value moments."""
    if n == 0:
        return 0.0, 0.0
    if n_valid == 0:
        return fill, 0.0
    m = n - n_valid
    mean2 = (n_valid * mean + m * fill) / n
    var2 = (n_valid * (var_pop + (mean - mean2) ** 2) + m * (fill - mean2) ** 2) / n
    return mean2, max(var2, 0.0)


def _safe_scale(var: float, mean: float) -> float:
    # constant column: scikit-style "zero std -> 1"; a tiny relative variance
    # from floating round-off also counts as constant
    if var <= 0.0 or var <= 1e-24 * max(1.0, mean * mean):
        return 1.0
    return math.sqrt(var)


class FeaturePrep:
    """Estimator: ``FeaturePrep(spec, target=..., passthrough=[...]).fit(df)``."""

    def __init__(self, spec: FeatureSpec, target: str | None = None,
                 passthrough: list[str] | None = None, indicator: str = "flag",
                 missing_indicators: bool = True, scale: bool = True,
                 max_categories: int = 100_000, median_relative_error: float = 0.0,
                 encoding: str = "columns"):
        if indicator not in ("flag", "fill_one"):
            raise ValueError("indicator must be 'flag' or 'fill_one'")
        if encoding not in ("columns", "vector", "dictionary"):
            raise ValueError("encoding must be 'columns', 'vector' or 'dictionary'")
        self.spec = spec
        self.target = target
        self.passthrough = list(passthrough or [])
        self.indicator = indicator
        self.missing_indicators = missing_indicators
        self.scale = scale
        self.max_categories = max_categories
        # "columns": one 0/1 column a category; "vector": one sparse vector column a feature;
        # "dictionary": the same vectors by joins with a stored dictionary, for any number of categories.
        # A choice of the caller, never of the data: the size of a vocabulary changes no schema
        self.encoding = encoding
        # 0 -> exact median; > 0 -> percentile_approx with that rank error (one pass)
        self.median_relative_error = median_relative_error

    def fit(self, df: DataFrame) -> "FeaturePrepModel":
        problems = self.spec.problems()
        if problems:
            raise ValueError("; ".join(problems))
        exclude = tuple(c for c in [self.target, *self.passthrough] if c)
        used = self.spec.used(df.columns, exclude=exclude)
        dtypes = {f.name: f.dataType for f in df.schema.fields}
        numeric = [f for f in used if f.type == "float"]
        categorical = [f for f in used if f.type == "category"]
        boolean = [f for f in used if f.type == "bool"]

        # -- pass 1: numeric statistics, one aggregate --------------------
        num_stats: list[NumericStat] = []
        if numeric:
            typed = df.select(*[to_double(_q(f.name), dtypes[f.name]).alias(f.name) for f in numeric])
            med_cols = [f.name for f in numeric if f.impute_method == "median"]
            agg_src = typed
            exprs = [F.count(F.lit(1)).alias("_n")]
            for f in numeric:
                exprs += [F.count(_q(f.name)).alias(f"nv__{f.name}"), F.avg(_q(f.name)).alias(f"mu__{f.name}"),
                          F.var_pop(_q(f.name)).alias(f"var__{f.name}")]
            approx = self.median_relative_error > 0
            for c in med_cols:
                if approx:
                    acc = int(max(1, round(1.0 / self.median_relative_error)))
                    exprs.append(F.percentile_approx(_q(c), 0.5, acc).alias(f"_med_a__{c}"))
                else:
                    exprs += median_sketch_exprs(c, None)
            row = agg_src.agg(*exprs).collect()[0]
            n = int(row["_n"])
            # all median-imputed columns resolved together (one job)
            if approx:
                medians = {c: row[f"_med_a__{c}"] for c in med_cols}
            else:
                medians = exact_medians_from_sketches(
                    typed, {c: (int(row[f"_med_n__{c}"]), row[f"_med_q__{c}"]) for c in med_cols},
                    _accuracy_for(0)) if med_cols else {}
            for f in numeric:
                nv = int(row[f"nv__{f.name}"])
                mu = row[f"mu__{f.name}"]
                var = row[f"var__{f.name}"]
                method = f.impute_method
                if nv == 0:
                    warnings.warn(f"feature '{f.name}' has no values; filled with 0.0")
                    fill = 0.0
                elif method == "median":
                    fill = medians[f.name]
                elif method == "0":
                    fill = 0.0
                else:
                    fill = float(mu)
                mean2, var2 = imputed_moments(n, nv, mu, var, fill)
                if nv == 0:
                    mean2, var2 = 0.0, 1.0
                if self.scale:
                    scale = _safe_scale(var2, mean2)
                else:
                    mean2, scale = 0.0, 1.0
                num_stats.append(NumericStat(f.name, method, float(fill), float(mean2), float(scale), nv, n))

        # -- pass 2: category vocabularies, one aggregate ------------------
        cat_stats: list[CategoryStat] = []
        words: Dictionary | None = None
        if categorical and self.encoding == "dictionary":
            words = fit_dictionary(df, {f.name: to_category(_q(f.name), dtypes[f.name]) for f in categorical},
                                   {f.name for f in categorical if f.impute_method == "most_frequent"})
            cat_stats = [CategoryStat(f.name, f.impute_method, words.fills[f.name], [], words.nulls[f.name], sparse=True)
                         for f in categorical]
        elif categorical:
            pairs = F.explode(F.array(*[
                F.struct(F.lit(f.name).alias("feature"),
                         to_category(_q(f.name), dtypes[f.name]).alias("value"))
                for f in categorical]))
            grouped = (df.select(pairs.alias("p")).select("p.feature", "p.value")
                       .groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")))
            # one job: a bounded collect. More rows than every feature may have
            # means some feature is over the limit (nothing unbounded reaches the driver)
            cap = (self.max_categories + 1) * len(categorical)
            rows = grouped.limit(cap + 1).collect()
            sizes: dict[str, int] = {}
            for r in rows:
                sizes[r["feature"]] = sizes.get(r["feature"], 0) + 1
            too_big = {k: v for k, v in sizes.items() if v > self.max_categories + 1}
            if too_big or len(rows) > cap:
                raise ValueError(f"categorical features exceed max_categories={self.max_categories}: "
                                 f"{too_big or 'at least one'}")
            by_feat: dict[str, list] = {f.name: [] for f in categorical}
            for r in rows:
                by_feat[r["feature"]].append((r["value"], int(r["n"])))
            for f in categorical:
                vals = by_feat[f.name]
                n_null = sum(n for v, n in vals if v is None)
                seen = sorted(v for v, n in vals if v is not None)
                if f.impute_method == "most_frequent" and seen:
                    best = max(n for v, n in vals if v is not None)
                    fill = min(v for v, n in vals if v is not None and n == best)
                else:
                    fill = "unknown"
                vocab = sorted(set(seen) | ({fill} if n_null > 0 else set()))
                cat_stats.append(CategoryStat(f.name, f.impute_method, fill, vocab, n_null,
                                              sparse=self.encoding == "vector"))

        return FeaturePrepModel(
            spec=self.spec, target=self.target, passthrough=self.passthrough,
            numeric=num_stats, categorical=cat_stats, boolean=[f.name for f in boolean],
            indicator=self.indicator, missing_indicators=self.missing_indicators, words=words)

    def fit_transform(self, df: DataFrame, **kw) -> DataFrame:
        return self.fit(df).transform(df, **kw)


@dataclass
class FeaturePrepModel:
    spec: FeatureSpec
    target: str | None
    passthrough: list[str]
    numeric: list[NumericStat]
    categorical: list[CategoryStat]
    boolean: list[str]
    indicator: str = "flag"
    missing_indicators: bool = True
    words: Dictionary | None = None         # of the "dictionary" encoding
    _names: list[str] = field(default=None, repr=False)

    # -- output plan ----------------------------------------------------------
    def _plan(self, dtypes: dict) -> list[tuple[str, Column]]:
        out: list[tuple[str, Column]] = []

        def dt(name):
            return dtypes.get(name, T.DoubleType())

        def indicator(name: str, raw: Column, numeric_raw: Column | None) -> Column:
            if self.indicator == "fill_one" and numeric_raw is not None:
                return F.coalesce(numeric_raw, F.lit(1.0))
            return raw.isNull().cast("double")

        for s in self.numeric:
            raw = to_double(_q(s.name), dt(s.name))
            if self.missing_indicators:
                out.append((s.name + MISSING_SUFFIX, indicator(s.name, raw, raw)))
            val = (F.coalesce(raw, F.lit(s.fill)) - F.lit(s.mean)) / F.lit(s.scale)
            out.append((s.name, val))
        for s in self.categorical:
            raw = to_category(_q(s.name), dt(s.name))
            filled = F.coalesce(raw, F.lit(s.fill))
            if s.sparse:
                # placeholder: the imputed string, encoded to a vector in transform()
                out.append((s.name + SPARSE_SUFFIX, filled))
            else:
                for v in s.vocab:
                    out.append((f"{s.name}_{v}", (filled == F.lit(v)).cast("double")))
            if self.missing_indicators:
                out.append((s.name + MISSING_SUFFIX, raw.isNull().cast("double")))
        for name in self.boolean:
            raw = to_bool_double(_q(name), dt(name))
            out.append((name, F.coalesce(raw, F.lit(0.0))))
            if self.missing_indicators:
                out.append((name + MISSING_SUFFIX, indicator(name, raw, raw)))
        # generated names may collide (a category literally named "missing", or
        # names that differ by case only): later duplicates get a numeric suffix
        taken: set[str] = set()
        named = []
        for name, expr in out:
            base, k = name, 0
            while name.lower() in taken:
                k += 1
                name = f"{base}__{k}"
            taken.add(name.lower())
            named.append((name, expr))
        return named

    def feature_columns(self, df: DataFrame) -> dict[str, Column]:
        """Output feature expressions by name (to embed in another projection);
        a sparse category appears as its imputed string."""
        dtypes = {f.name: f.dataType for f in df.schema.fields}
        return dict(self._plan(dtypes))

    @property
    def output_columns(self) -> list[str]:
        """Columns ``transform`` adds (a sparse category is one vector column)."""
        return [n for n, _ in self._plan({})]

    @property
    def feature_names(self) -> list[str]:
        """One name per slot of the assembled feature vector (sparse
        categories expanded to ``<c>_<value>``, or to ``<c>#<position>`` where
        the values are in a dictionary: ``vocabulary_frame`` has them)."""
        if self._names is None:
            sparse = {s.name + SPARSE_SUFFIX: s for s in self.categorical if s.sparse}
            names = []
            taken: set[str] = {n.lower() for n in self.output_columns if n not in sparse}
            for n in self.output_columns:
                if n not in sparse:
                    names.append(n)
                    continue
                st = sparse[n]
                for v in (range(self.words.width(st.name)) if self.words else st.vocab):
                    if self.words:
                        names.append(f"{st.name}#{v}")
                        continue
                    base = name = f"{sparse[n].name}_{v}"
                    k = 0
                    while name.lower() in taken:
                        k += 1
                        name = f"{base}__{k}"
                    taken.add(name.lower())
                    names.append(name)
            self._names = names
        return list(self._names)

    @property
    def slots(self) -> int:
        """Places of the assembled feature vector."""
        if self.words is None:
            return len(self.feature_names)
        return len(self.output_columns) - len(self.categorical) + sum(map(self.words.width, self.words.sizes))

    def transform(self, df: DataFrame, keep: list[str] | None = None,
                  assemble: bool = False, features_col: str = "features",
                  positional: str | None = None) -> DataFrame:
        """One projection: ``keep`` columns (default: passthrough + target when
        present) followed by the generated feature columns, in the order of
        ``output_columns``. ``positional``: name them by this prefix and their
        place instead, so that they can sit next to any original columns."""
        if keep is None:
            keep = [c for c in [*self.passthrough, self.target] if c and c in df.columns]
        dtypes = {f.name: f.dataType for f in df.schema.fields}
        needed = [s.name for s in self.numeric] + [s.name for s in self.categorical] + self.boolean
        missing = [c for c in needed if c not in df.columns]
        if missing:
            raise ValueError(f"Required feature(s) missing from the data: {missing}")
        plan = self._plan(dtypes)
        # category values become column names: columns are addressed by place
        # (safe names) until the last projection
        prefix = positional or "__feature_"
        names = [n for n, _ in plan]
        place = {n: f"{prefix}{i}" for i, n in enumerate(names)}
        out = df.select(*[_q(c) for c in keep], *[e.alias(place[n]) for n, e in plan])
        if self.words is not None:
            out = encode(out, {place[st.name + SPARSE_SUFFIX]: st.name for st in self.categorical}, self.words)
        for st in (x for x in self.categorical if x.sparse and self.words is None):
            out = _encode_sparse(out, place[st.name + SPARSE_SUFFIX], st.vocab)
        extra = []
        if assemble:
            from pyspark.ml.feature import VectorAssembler
            out = VectorAssembler(inputCols=[place[n] for n in names], outputCol="__features",
                                  handleInvalid="keep").transform(out)
            # without attributes: 0/1 slots stay numeric, and trees split them by threshold
            extra = [F.col("__features").alias(features_col, metadata={"ml_attr": {"num_attrs": self.slots}})]
        return out.select(*[_q(c) for c in keep], *[F.col(place[n]).alias(place[n] if positional else n) for n in names],
                          *extra)

    def impute(self, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """Imputed (not encoded, not scaled) feature columns: numeric ->
        ``coalesce(x, fill)``, category -> ``coalesce(c, fill)``, bool ->
        ``coalesce(b, 0.0)``."""
        if keep is None:
            keep = [c for c in [*self.passthrough, self.target] if c and c in df.columns]
        dtypes = {f.name: f.dataType for f in df.schema.fields}
        exprs = [F.coalesce(to_double(_q(s.name), dtypes[s.name]), F.lit(s.fill)).alias(s.name)
                 for s in self.numeric]
        exprs += [F.coalesce(to_category(_q(s.name), dtypes[s.name]), F.lit(s.fill)).alias(s.name)
                  for s in self.categorical]
        exprs += [F.coalesce(to_bool_double(_q(n), dtypes[n]), F.lit(0.0)).alias(n) for n in self.boolean]
        return df.select(*[_q(c) for c in keep], *exprs)

    def vocabulary_frame(self, spark: SparkSession) -> DataFrame:
        """A8 as a table: ``(feature, pos, category)``."""
        if self.words is not None:
            return self.words.table.select("feature", "pos", "category")
        return spark.createDataFrame(
            [(s.name, i, v) for s in self.categorical for i, v in enumerate(s.vocab)],
            "feature string, pos long, category string")

    def statistics_frame(self, spark: SparkSession) -> DataFrame:
        """Fitted numeric statistics: ``(feature, impute, fill, mean, scale)``."""
        return spark.createDataFrame(
            [(s.name, s.impute, s.fill, s.mean, s.scale) for s in self.numeric],
            "feature string, impute string, fill double, mean double, scale double")

    # -- persistence (S11) ----------------------------------------------------
    def save(self, spark: SparkSession, path: str) -> str:
        meta = {"spec": self.spec.to_records(), "target": self.target,
                "passthrough": self.passthrough, "boolean": self.boolean,
                "indicator": self.indicator, "missing_indicators": self.missing_indicators,
                "numeric_order": [s.name for s in self.numeric],
                "categorical_order": [s.name for s in self.categorical], "dictionary": self.words is not None}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").write.mode("overwrite").json(f"{path}/meta")
        spark.createDataFrame([tuple(asdict(s).values()) for s in self.numeric],
                              "name string, impute string, fill double, mean double, scale double, "
                              "n_valid long, n_rows long").write.mode("overwrite").parquet(f"{path}/numeric_stats")
        if self.words is not None:
            self.words.table.write.mode("overwrite").parquet(f"{path}/dictionary")
            spark.createDataFrame([(f, n, self.words.rows) for f, n in self.words.sizes.items()], "feature string, size long, n_rows long") \
                .write.mode("overwrite").parquet(f"{path}/dictionary_sizes")
        spark.createDataFrame([(s.name, s.impute, s.fill, i, v, s.n_null)
                               for s in self.categorical for i, v in enumerate(s.vocab)] or [],
                              "name string, impute string, fill string, pos int, value string, n_null long"
                              ).write.mode("overwrite").parquet(f"{path}/category_vocab")
        spark.createDataFrame([(s.name, s.impute, s.fill, s.n_null, s.sparse) for s in self.categorical] or [],
                              "name string, impute string, fill string, n_null long, sparse boolean"
                              ).write.mode("overwrite").parquet(f"{path}/category_fill")
        return path

    @staticmethod
    def load(spark: SparkSession, path: str) -> "FeaturePrepModel":
        meta = json.loads(spark.read.json(f"{path}/meta").collect()[0]["meta"])
        spec = FeatureSpec.from_records(meta["spec"])
        nums = {r["name"]: NumericStat(r["name"], r["impute"], r["fill"], r["mean"], r["scale"],
                                       r["n_valid"], r["n_rows"])
                for r in spark.read.parquet(f"{path}/numeric_stats").collect()}
        vocab: dict[str, list] = {}
        for r in spark.read.parquet(f"{path}/category_vocab").collect():
            vocab.setdefault(r["name"], []).append((r["pos"], r["value"]))
        cats = {r["name"]: CategoryStat(r["name"], r["impute"], r["fill"],
                                        [v for _, v in sorted(vocab.get(r["name"], []))], r["n_null"],
                                        bool(r["sparse"]))
                for r in spark.read.parquet(f"{path}/category_fill").collect()}
        # restore the fitted (data column) order
        numeric = [nums[n] for n in meta["numeric_order"]]
        categorical = [cats[n] for n in meta["categorical_order"]]
        words = None
        if meta.get("dictionary"):
            sizes = spark.read.parquet(f"{path}/dictionary_sizes").collect()      # one row a feature
            words = Dictionary(spark.read.parquet(f"{path}/dictionary"), {r["feature"]: r["size"] for r in sizes},
                               {c.name: c.n_null for c in categorical}, {c.name: c.fill for c in categorical},
                               max(r["n_rows"] for r in sizes))
        return FeaturePrepModel(spec=spec, target=meta["target"], passthrough=meta["passthrough"],
                                numeric=numeric, categorical=categorical, boolean=meta["boolean"],
                                indicator=meta["indicator"], missing_indicators=meta["missing_indicators"], words=words)


def select_features(df: DataFrame, spec: FeatureSpec, target: str | None,
                    training: bool = True, keep: list[str] | None = None) -> DataFrame:
    """P1 + P2: used features (use == 1) in data column order, then the target.

    Training requires the target; when scoring, a missing target stays missing."""
    if target and target not in df.columns and training:
        raise ValueError(f"the target column '{target}' does not exist")
    keep = list(keep or [])
    feats = [f.name for f in spec.used(df.columns, exclude=tuple(c for c in [target, *keep] if c))]
    tgt = [target] if target and target in df.columns else []
    return df.select(*[_q(c) for c in keep + feats + tgt])
