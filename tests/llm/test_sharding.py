import zlib
from collections import Counter

import pytest

from llm_helpers import SF, by_id, collected
from tabforge.llm import sharding as S


def check(docs, shards=S.SHARDS):
    rows = docs.select("doc_id", "text").collect()
    out = S.assign(docs, shards).collect()

    def size(t):
        return len((t or "").encode()) + 16

    assert by_id([(r.doc_id, r.size, r.text_crc32) for r in out]) == by_id(
        [(r.doc_id, size(r.text), zlib.crc32((r.text or "").encode())) for r in rows])
    assert {r.law for r in out} == {"bytes"} and {r.grown_shard for r in out} == {None}
    slots: dict[int, list] = {}
    for r in out:
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(slots) <= set(range(shards)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    load = Counter()
    for r in out:
        load[r.shard] += r.size
    load = [load[s] for s in range(shards)]
    assert max(load) - min(load) <= max(size(r.text) for r in rows) + 16
    groups: dict[str, list] = {}
    for r in out:
        if r.group_md5:
            groups.setdefault(r.group_md5, []).append(r.shard)
    return load, [g for g in groups.values() if len(g) > 1]


def test_awkward(awkward):
    load, groups = check(awkward, 7)
    assert groups


def test_given_table(spark):
    load, groups = check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    mean = sum(load) / len(load)
    assert max(load) < 1.03 * mean and min(load) > 0.97 * mean
    together = sum(len(set(g)) == 1 for g in groups)
    assert together > 0.9 * len(groups)


def test_hot_group_is_split_by_quota(spark):
    rows = [(i, "the same text everywhere " * 3) for i in range(400)] + [(1000 + i, f"text {i} " * 9) for i in range(800)]
    load, groups = check(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), 10)
    assert max(load) - min(load) <= 120
    assert len(groups) == 1 and len(set(groups[0])) <= 8       # of at least 4 that its bytes need


def test_all_linked_and_identical(spark):
    check(spark.createDataFrame([(1, "same")] * 200, "doc_id long, text string"), 6)
    check(spark.createDataFrame([(i // 2, f"pair {i // 2}") for i in range(400)], "doc_id long, text string"), 6)


def test_empty_and_few(spark, nothing):
    assert S.assign(nothing).count() == 0
    check(spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string"))


@pytest.mark.parametrize("loads,more", [([0, 0, 0], 9), ([5, 1, 3], 3), ([5, 1, 3], 30), ([7], 4), ([2, 2], 0)])
def test_water_filling(loads, more):
    take = S._filled(loads, more)
    assert abs(sum(take) - more) < 1e-9
    after = [a + b for a, b in zip(loads, take)]
    level = max(a for a, t in zip(after, take) if t) if more else max(after)
    assert all(t == 0 and a >= level - 1e-9 or abs(a - level) < 1e-9 for a, t in zip(after, take)) or not more
