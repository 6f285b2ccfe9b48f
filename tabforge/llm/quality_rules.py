"""Quality rules with thresholds taken from the data.

Base counts come from one pass over the whole texts. For every (language,
source) a KLL quantile sketch of each rule's ratio is built by partial
aggregation (sketches of tasks merge, so a hot source is one sketch a task);
its quantiles give that group's fence, and the counts are joined with the
fences to filter. A document fails a rule if its ratio is above the group's
far-out fence q75 + 3 * (q75 - q25). Where most ratios of a group are equal
(mostly 0) that fence has no width; ``MARGIN`` keeps it off the median.

Defined cases: null text has no words and fails the base rules; null language
or source is a group of its own; repeated rows are judged one by one; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.llm import text as T
from tabforge.llm.common import handed_off

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
#: accuracy parameter of the sketches (rank error about 1.3 % at 200, 0.2 % at 1600)
SKETCH_K = 1600
FENCE_SPREAD = 3.0

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
_SCHEMA = ("doc_id long, lang string, source string, "
           + ", ".join(f"{c} long" for c in COUNTS))

#: rule -> ratio of base counts; higher is worse
RATIOS = {
    "symbols": "n_symbols / word_chars",
    "dup_lines": "n_dup_lines / n_lines",
    "repeats": "n_repeat_words / n_words",
    "long_words": "word_chars / n_words",
    "short_words": "n_words / word_chars",
}
#: rule -> (least distance of the fence from the median, the same as a share of the median)
MARGIN = {"symbols": (0.05, 0.0), "dup_lines": (0.2, 0.0), "repeats": (0.1, 0.0),
          "long_words": (0.0, 0.35), "short_words": (0.0, 0.35)}


def text_counts(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The base counts of a block of texts."""
    w = T.words(texts)
    data, rows = w.data, w.rows
    first = w.first()
    out = {"n_words": np.diff(first)}
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    out["word_chars"] = w.per_row(lead[w.end] - lead[w.start])
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
    out["n_symbols"] = symbols[w.row_end] - symbols[w.row_start]

    # lines that hold a word, and of those the ones equal to an earlier line of the text
    newline = np.flatnonzero(data == 10)
    start = np.union1d(w.row_start, newline + 1)
    start = start[start < len(data)]
    row = np.searchsorted(w.row_start, start, side="right") - 1
    end = np.minimum(np.concatenate([start[1:] - 1, [len(data)]]), w.row_end[row])
    keep = (np.searchsorted(w.start, end) > np.searchsorted(w.start, start)) & (end > start)
    row, start, end = row[keep], start[keep], end[keep]
    out["n_lines"] = np.bincount(row, minlength=rows)
    key = T.mix(T.span_hash(T.prefix_hash(data), start, end) + row.astype(T.U64) * T._SEEDS[0])
    _, kept = np.unique(key, return_index=True)
    out["n_dup_lines"] = out["n_lines"] - np.bincount(row[kept], minlength=rows)

    # words inside a window that the text holds twice or more
    at, h = T.windows(w, WINDOW)
    again = at[T.repeated(T.mix(h + w.row[at].astype(T.U64) * T._SEEDS[1]))]
    step = np.bincount(again, minlength=len(w.row) + 1) - np.bincount(again + WINDOW, minlength=len(w.row) + 1)
    out["n_repeat_words"] = w.per_row(np.cumsum(step)[: len(w.row)] > 0)
    return {k: v.astype(np.int64) for k, v in out.items()}


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, texts in T.blocks(batch.column("text")):
            c = text_counts(texts)
            head = [batch.column(k).slice(lo, len(texts)) for k in ("doc_id", "lang", "source")]
            yield pa.RecordBatch.from_arrays([*head, *[pa.array(c[k]) for k in COUNTS]],
                                             names=["doc_id", "lang", "source", *COUNTS])


def base_counts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"),
                       F.col("source").cast("string")).mapInArrow(T.tidied(_counts), _SCHEMA)


def fences(counts: DataFrame) -> DataFrame:
    """(lang, source, fence_<rule>): upper fence of each ratio in the group."""
    sketch = counts.filter("not base_failed").groupBy("lang", "source").agg(
        *[F.kll_sketch_agg_double(r, F.lit(SKETCH_K)).alias(r) for r in RATIOS])

    def q(rule: str, p: float):
        return F.kll_sketch_get_quantile_double(rule, F.lit(p))

    return sketch.select("lang", "source", *[
        F.greatest(q(r, 0.5) * (1 + MARGIN[r][1]) + MARGIN[r][0],
                   q(r, 0.75) + F.lit(FENCE_SPREAD) * (q(r, 0.75) - q(r, 0.25)))
        .alias(f"fence_{r}") for r in RATIOS])


def judge(docs: DataFrame) -> DataFrame:
    """Base counts, ``base_failed``, the rules each document fails and ``kept``."""
    counts = base_counts(docs).withColumns({
        "base_failed": F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"),
        **{r: F.expr(f"coalesce(try_divide(cast({e.split(' / ')[0]} as double), {e.split(' / ')[1]}), 0d)")
           for r, e in RATIOS.items()}})
    counts = handed_off(counts, "rule-counts")
    f = fences(counts).withColumnsRenamed({"lang": "_l", "source": "_s"})
    joined = counts.join(f, counts.lang.eqNullSafe(f._l) & counts.source.eqNullSafe(f._s), "left")
    failed = F.filter(F.array(*[F.when(F.col(r) > F.col(f"fence_{r}"), F.lit(r)) for r in RATIOS]),
                      lambda x: x.isNotNull())
    return joined.withColumn("failed_rules", F.when(F.col("base_failed"), F.array(F.lit("base"))).otherwise(failed)) \
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                (F.size("failed_rules") == 0).alias("kept"), "failed_rules", *[f"fence_{r}" for r in RATIOS])
