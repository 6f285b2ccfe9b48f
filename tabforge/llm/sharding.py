"""Balanced label propagation: documents to shards of near equal bytes.

Documents with equal texts are linked. All documents are dealt by hash; then
linked ones move in rounds towards the shard that most of their neighbours are
in, as far as quotas allow: Spark joins of (group, shard, count) cells, never
of single links, so a hot group is at most one cell a shard. At last everything
above a shard's quota and all unlinked documents are dealt, large ones first,
to where bytes are missing, which evens the sizes out to about the size of the
smallest documents.

Law: ``bytes``. Size: UTF-8 bytes of the text plus 16.

Defined cases: null text has size 16 and no links; repeated rows are documents
of their own (linked by their text); an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabforge.llm.common import buckets_for, handed_off, running_total

SHARDS = 40
OVERHEAD = 16
ROUNDS = 12
#: share of a shard that linked documents may fill, so that others can even it out
QUOTA = 0.97
#: documents are dealt in tiers of sizes, each TIER times the next
TIER = 4


def _facts(docs: DataFrame) -> DataFrame:
    """One narrow row per document."""
    text = F.col("text").cast("string")
    facts = docs.select(
        "doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), F.unhex(F.md5(text)).alias("group"))
    return facts.withColumn("h", F.xxhash64("doc_id", "group", F.monotonically_increasing_id()))


def _loads(cells: DataFrame, shards: int, bytes_: Column) -> list[int]:
    """Bytes in each shard; ``shards`` rows."""
    out = [0] * shards
    for r in cells.groupBy("shard").agg(F.sum(bytes_).alias("b")).collect():
        out[r.shard] = int(r.b)
    return out


def _of(values: list, shard: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), shard.cast("int") + 1)


def _round(cells: DataFrame, loads: list[int], quota: float, number: int, shards: int) -> tuple[DataFrame, DataFrame]:
    """(proposals, cells with their best shard): each cell wants to go where its
    group has most members and there is room; ties fall by a hash."""
    room = [max(0.0, quota - b) for b in loads]
    tie = F.xxhash64("group", "shard")
    by_group = Window.partitionBy("group").orderBy(
        (_of(room, F.col("shard")) >= F.col("size")).desc(), F.desc("n"), tie)
    best = cells.withColumns({
        "best": F.first("shard").over(by_group), "most": F.first("n").over(by_group),
        "best_tie": F.first(tie).over(by_group),
        "open": F.first(_of(room, F.col("shard")) >= F.col("size")).over(by_group)})
    uphill = F.col("open") & (F.col("best") != F.col("shard")) & (
        (F.col("n") < F.col("most")) | ((F.col("n") == F.col("most")) & (tie > F.col("best_tie"))))
    best = best.withColumn("moves", F.when(uphill, F.col("n")).otherwise(0))
    return best, best.filter("moves > 0").groupBy(F.col("best").alias("shard")).agg(
        F.sum(F.col("moves") * F.col("size")).alias("demand"))


def propagate(cells: DataFrame, target: float, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """cells(group, size, shard, n) after label propagation under quotas."""
    quota = QUOTA * target
    for number in range(rounds):
        loads = _loads(cells, shards, F.col("n") * F.col("size"))
        best, wanted = _round(cells, loads, quota, number, shards)
        demand = {r.shard: int(r.demand) for r in wanted.collect()}
        if not demand:
            break
        share = [min(1.0, max(0.0, quota - loads[s]) / demand[s]) if s in demand else 0.0 for s in range(shards)]
        # a cell moves its share of members; the fraction of a member falls by a hash
        part = F.col("moves") * _of(share, F.col("best"))
        luck = F.pmod(F.xxhash64("group", "shard", F.lit(number)), F.lit(1 << 20)) / float(1 << 20)
        go = F.least(F.floor(part) + (luck < part - F.floor(part)).cast("long"), F.col("moves")).cast("long")
        moved = best.withColumn("go", go)
        stay = moved.select("group", "size", "shard", (F.col("n") - F.col("go")).alias("n"))
        gone = moved.filter("go > 0").select("group", "size", F.col("best").alias("shard"), F.col("go").alias("n"))
        cells = handed_off(stay.filter("n > 0").union(gone).groupBy("group", "size", "shard").agg(F.sum("n").alias("n")),
                           "shard-cells")
    return cells


def _filled(loads: list[int], more: int) -> list[float]:
    """How much of ``more`` bytes each shard takes to level all (water filling)."""
    order = sorted(range(len(loads)), key=loads.__getitem__)
    level, left = float(loads[order[0]]), float(more)
    for k in range(1, len(order) + 1):
        top = float(loads[order[k]]) if k < len(order) else float("inf")
        if (top - level) * k >= left:
            level += left / k
            break
        left -= (top - level) * k
        level = top
    return [max(0.0, level - b) for b in loads]


def _dealt(free: DataFrame, loads: list[int], shards: int) -> DataFrame:
    """Free documents (h, size) with their shard, tier by tier: a tier's running
    bytes are cut where the shards' missing bytes end."""
    tier = F.floor(F.log(F.col("size").cast("double")) / F.log(F.lit(float(TIER)))).cast("int")
    free = free.withColumn("tier", tier)
    free = handed_off(running_total(free, ["tier"], [F.col("h")], F.col("size"), "before", buckets_for(free.count())),
                      "shard-free")
    totals = {r.tier: int(r.b) for r in free.groupBy("tier").agg(F.sum("size").alias("b")).collect()}
    out = None
    for t in sorted(totals, reverse=True):
        cuts, at = [], 0.0
        for take in _filled(loads, totals[t])[:-1]:
            at += take
            cuts.append(at)
        middle = F.col("before") + F.col("size") / 2
        shard = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= middle)) if cuts else F.lit(0)
        mine = free.filter(F.col("tier") == t).withColumn("shard", shard.cast("int")).drop("before", "tier")
        loads = [a + b for a, b in zip(loads, _loads(mine, shards, F.col("size")))]
        out = mine if out is None else out.unionByName(mine)
    return out


def assign(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row."""
    facts = handed_off(_facts(docs), "shard-facts")
    total, rows = facts.agg(F.sum("size"), F.count(F.lit(1))).first()
    target, buckets = (total or 0) / shards, buckets_for(rows)
    cells = facts.filter("group is not null").groupBy("group", "size", F.pmod("h", F.lit(shards)).cast("int").alias("shard")) \
        .agg(F.count(F.lit(1)).alias("n"))
    several = cells.groupBy("group").agg(F.sum("n").alias("members")).filter("members > 1").select("group")
    cells = propagate(handed_off(cells.join(several, "group"), "shard-cells"), target, shards, rounds)
    # members of a group are interchangeable: the k-th goes where the running counts of its cells say
    upto = Window.partitionBy("group").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    lists = handed_off(cells.withColumn("past", F.sum("n").over(upto)).groupBy("group").agg(
        F.sort_array(F.collect_list(F.struct("past", "shard"))).alias("cells")), "shard-groups")
    linked = facts.join(lists.select("group"), "group", "left_semi")
    linked = running_total(linked, ["group"], [F.col("h")], F.lit(1), "k", MIN_MEMBER_BUCKETS).join(lists, "group")
    shard = F.element_at(F.filter("cells", lambda c: F.col("k") < c["past"]), 1)["shard"]
    linked = handed_off(linked.select(*facts.columns, shard.alias("shard")), "shard-linked")
    linked = running_total(linked, ["shard"], [F.col("h")], F.col("size"), "before", buckets)
    linked = handed_off(linked.withColumn("stays", F.col("before") + F.col("size") <= F.lit(target)).drop("before"),
                        "shard-held")
    held = linked.filter("stays").drop("stays")
    free = facts.join(lists.select("group"), "group", "left_anti").unionByName(
        linked.filter("not stays").drop("stays", "shard"))
    dealt = _dealt(free, _loads(held, shards, F.col("size")), shards)
    placed = handed_off(held if dealt is None else held.unionByName(dealt), "shard-placed")
    return running_total(placed, ["shard"], [F.col("h")], F.lit(1), "slot", buckets).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), F.hex("group").alias("group_md5"))


#: hash buckets over which the members of one group are ranked
MIN_MEMBER_BUCKETS = 64
