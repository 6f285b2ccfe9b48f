"""Scoring a stream: fitted preparation + model applied to a streaming DataFrame.

Both steps are stateless, row-wise projections (``FeaturePrepModel.transform``
is one ``select``; the Spark ML model transform is a narrow map), so a
``readStream`` source flows through them unchanged and any sink (files with a
checkpoint location for exactly-once output, or ``foreachBatch``) can take the
result. No state store is involved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tabforge.operators.model import score
from tabforge.operators.prepare import FeaturePrepModel
from tabforge.sources.readers import apply_types, normalize_nulls


def score_stream(stream: DataFrame, prep: FeaturePrepModel, model, problem_type: str,
                 keep: list[str] | None = None, typed: bool = False) -> DataFrame:
    """Streaming DataFrame in, streaming DataFrame of ``keep`` columns plus
    predictions out. ``typed=False`` applies the same null normalisation and
    metadata typing as the batch readers."""
    src = stream if typed else apply_types(normalize_nulls(stream), prep.spec, target=prep.target)
    keep = list(keep if keep is not None else [c for c in prep.passthrough if c in src.columns])
    feats = prep.transform(src, keep=keep, assemble=True, positional="__f")
    scored = score(model, feats, problem_type)
    preds = ["prediction_proba", "prediction_class"] if problem_type == "classification" else ["prediction"]
    return scored.select(*keep, *preds)


def start_scoring(stream: DataFrame, prep: FeaturePrepModel, model, problem_type: str,
                  path: str, checkpoint: str, keep: list[str] | None = None, fmt: str = "parquet",
                  trigger_once: bool = False):
    """Start a streaming query that appends scored rows to ``path``
    (``checkpoint`` must be on shared storage for recovery)."""
    out = score_stream(stream, prep, model, problem_type, keep)
    w = (out.writeStream.format(fmt).option("path", path)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()
