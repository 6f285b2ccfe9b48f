"""Quality by perplexity under an interpolated modified Kneser-Ney model.

The model is over UTF-8 bytes, ``ORDER`` symbols an n-gram. Every task counts
the n-grams of its trusted texts and lists those of all others, so the shuffle
carries distinct n-grams. Continuation counts, discounts and probabilities are
groupings and joins of these count tables, sharded by n-gram. Each n-gram that
any document asks for has its probability in the final table; documents are
scored against it shard by shard (``SHARD_GRAMS`` entries each, one pass a
shard, no shuffle), and a language's threshold is a quantile of the perplexity
of trusted documents kept out of training.

Trusted: a label of quality 1 that is not toxic. Of these, crc32(doc_id) mod 4
= 3 is kept out for the thresholds, all others train.

Defined cases: null or empty text has no perplexity and is not kept; a
language without kept-out trusted documents takes the threshold over all of
them; without any trusted document nothing is rejected for its perplexity;
null language is a language of its own; repeated rows are judged alike;
several labels of a document count as trusted if one is; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.llm import text as T
from tabforge.llm.common import handed_off

ORDER = 5
QUANTILE = 0.995
ACCURACY = 10_000
#: entries of one broadcast shard of the probability table (12 bytes each)
SHARD_GRAMS = 2_000_000
#: distinct n-grams a task holds before it hands them on
HELD_GRAMS = 500_000
_PAD = b"\x02"


def gram_codes(texts: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """(row, code) of the n-gram that ends at each byte of each text."""
    pad = _PAD * (order - 1)
    data = np.frombuffer(pad + pad.join(texts), np.uint8).astype(np.int64)
    length = np.fromiter(map(len, texts), np.int64, len(texts))
    row = np.repeat(np.arange(len(texts)), length)
    end = np.arange(len(row)) + (row + 1) * (order - 1)
    code = np.zeros(len(row), np.int64)
    for k in range(order - 1, -1, -1):
        code = (code << 8) | data[end - k]
    return row, code


def _summed(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    code, count = np.concatenate(codes), np.concatenate(counts)
    order = np.argsort(code, kind="stable")
    code, count = code[order], count[order]
    first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.empty(0, np.int64)
    return code[first], np.add.reduceat(count, first) if len(code) else count


def _count(order: int):
    def out(code: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(code), pa.array(count)], names=["gram", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts, held = [], [], 0
        for batch in batches:
            trains = np.asarray(batch.column("trains").to_pylist(), bool)
            for lo, texts in T.blocks(batch.column("text")):
                row, code = gram_codes(texts, order)
                mine = trains[lo:lo + len(texts)][row]
                for part, weight in ((code[mine], 1), (code[~mine], 0)):
                    g, n = np.unique(part, return_counts=True)
                    codes.append(g)
                    counts.append(n * weight)
                    held += len(g)
                if held > 2 * HELD_GRAMS:
                    code, count = _summed(codes, counts)
                    codes, counts, held = [code], [count], len(code)
                    if held > HELD_GRAMS:
                        yield out(code, count)
                        codes, counts, held = [], [], 0
        if held:
            yield out(*_summed(codes, counts))
    return run


def gram_counts(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, c) of all texts(text, trains): c counts only those that train."""
    return texts.select("text", "trains").mapInArrow(T.tidied(_count(order)), "gram long, c long") \
        .groupBy("gram").agg(F.sum("c").alias("c"))


def _discounts(n: list[int]) -> list[float]:
    """D1, D2, D3+ from the numbers of n-grams seen one to four times."""
    if not n[0]:
        return [0.5, 1.0, 1.5]
    y = n[0] / (n[0] + 2 * n[1])
    d = [i + 1 - (i + 2) * y * n[i + 1] / n[i] if n[i] else 0.5 * (i + 1) for i in range(3)]
    return [min(max(x, 0.0), i + 1.0) for i, x in enumerate(d)]


def probabilities(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, p) for every row of counts(gram, c)."""
    tables, discounts = {}, {}
    at = counts
    for k in range(order, 0, -1):
        tables[k] = handed_off(at, f"kn-{k}")
        seen = tables[k].agg(*[F.sum((F.col("c") == i).cast("long")).alias(f"n{i}") for i in range(1, 5)]).first()
        discounts[k] = _discounts([x or 0 for x in seen])
        at = tables[k].groupBy(F.col("gram").bitwiseAND(F.lit((1 << 8 * (k - 1)) - 1)).alias("gram")) \
            .agg(F.sum((F.col("c") > 0).cast("long")).alias("c"))
    lower = None
    for k in range(1, order + 1):
        c, d = F.col("c"), discounts[k]
        discount = F.when(c >= 3, d[2]).when(c == 2, d[1]).when(c == 1, d[0]).otherwise(0.0)
        rows = tables[k].select("gram", c, discount.alias("d"), F.shiftright("gram", 8).alias("ctx"))
        ctx = rows.groupBy("ctx").agg(F.sum("c").alias("total"), F.sum("d").alias("saved"))
        rows = rows.join(ctx, "ctx")
        if lower is None:
            rows = rows.withColumn("low", F.lit(1 / 256))
        else:
            rows = rows.withColumn("short", F.col("gram").bitwiseAND(F.lit((1 << 8 * (k - 1)) - 1))) \
                .join(lower.select(F.col("gram").alias("short"), F.col("p").alias("low")), "short")
        lower = rows.select("gram", F.when(F.col("total") > 0, (c - F.col("d") + F.col("saved") * F.col("low"))
                                           / F.col("total")).otherwise(F.col("low")).alias("p"))
    return lower


def _score(codes, logs, order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code_table, log_table = codes.value, logs.value
        for batch in batches:
            total = []
            for _, texts in T.blocks(batch.column("text")):
                row, code = gram_codes(texts, order)
                at = np.searchsorted(code_table, code)
                at[at == len(code_table)] = 0
                log = np.where(code_table[at] == code, log_table[at], 0.0) if len(code_table) else np.zeros(len(code))
                total.append(np.bincount(row, log, minlength=len(texts)))
            log = np.concatenate(total) if total else np.empty(0)
            yield batch.set_column(batch.schema.get_field_index("log"), "log",
                                   pa.array(log + batch.column("log").to_numpy()))
    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition's probabilities as two byte strings."""
    parts = [(b.column("gram").to_numpy(), np.log(b.column("p").to_numpy()).astype(np.float32)) for b in batches]
    if parts:
        yield pa.RecordBatch.from_arrays(
            [pa.array([np.concatenate(x).tobytes()], pa.binary()) for x in zip(*parts)], names=["grams", "logs"])


def _shard(model: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """One shard of the table on the driver, sorted: 12 bytes an entry."""
    rows = model.select("gram", "p").mapInArrow(T.tidied(_packed), "grams binary, logs binary").collect()
    gram = np.frombuffer(b"".join(r.grams for r in rows), np.int64)
    order = np.argsort(gram)
    return gram[order], np.frombuffer(b"".join(r.logs for r in rows), np.float32)[order]


def scored(docs: DataFrame, model: DataFrame, order: int = ORDER, shard_grams: int = SHARD_GRAMS) -> DataFrame:
    """doc_id, lang and the log-probability of every whole text."""
    spark = docs.sparkSession
    shards = max(1, -(-model.count() // shard_grams))
    out = docs.select("doc_id", "lang", "text", F.lit(0.0).alias("log"))
    for k in range(shards):
        grams, logs = _shard(model.filter(F.pmod(F.xxhash64("gram"), F.lit(shards)) == k))
        out = out.mapInArrow(T.tidied(_score(spark.sparkContext.broadcast(grams), spark.sparkContext.broadcast(logs), order)),
                             out.schema)
    return out.select("doc_id", "lang", "log", F.octet_length(F.coalesce("text", F.lit(""))).alias("n_bytes"))


def _kept_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 3


def classify(docs: DataFrame, labels: DataFrame, order: int = ORDER, quantile: float = QUANTILE,
             shard_grams: int = SHARD_GRAMS) -> DataFrame:
    """doc_id, lang, n_bytes, perplexity, threshold, kept."""
    docs = docs.select("doc_id", F.col("text").cast("string"), F.col("lang").cast("string"))
    trusted = labels.filter("quality = 1 and coalesce(toxic, 0) = 0").select("doc_id").distinct()
    train = trusted.filter(~_kept_out(F.col("doc_id"))).withColumn("trains", F.lit(True))
    # labels grow with the documents: never broadcast, at any size
    texts = docs.join(train.hint("merge"), "doc_id", "left").select("text", F.coalesce("trains", F.lit(False)).alias("trains"))
    model = handed_off(probabilities(gram_counts(texts, order), order), "kn-model")
    done = handed_off(scored(docs, model, order, shard_grams).withColumn(
        "perplexity", F.when(F.col("n_bytes") > 0, F.exp(-F.col("log") / F.col("n_bytes")))), "kn-scored")
    held = done.filter("perplexity is not null").join(trusted.filter(_kept_out(F.col("doc_id"))), "doc_id", "left_semi")
    cut = held.groupBy("lang").agg(F.percentile_approx("perplexity", quantile, ACCURACY).alias("cut")) \
        .withColumnRenamed("lang", "_l")
    overall = held.agg(F.percentile_approx("perplexity", quantile, ACCURACY)).first()[0]
    threshold = F.coalesce("cut", F.lit(overall).cast("double"))
    return done.join(cut, done.lang.eqNullSafe(cut["_l"]), "left").select(
        "doc_id", "lang", F.col("n_bytes").cast("long").alias("n_bytes"), "perplexity", threshold.alias("threshold"),
        (F.col("perplexity").isNotNull() & F.coalesce(F.col("perplexity") <= threshold, F.lit(True))).alias("kept"))
