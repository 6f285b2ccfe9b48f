import gc
import os
import random
import re
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from llm_helpers import by_id
from tabforge.llm import packing as P
from tabforge.llm import text as T
from tabforge.llm.queries import tokenizer_path


def pieces_of(text, tok, capacity):
    ids = np.asarray([*tok.encode(text or "", add_special_tokens=False).ids, P.END_ID], "<u4")
    return [(k, lo, len(ids[lo:lo + capacity]), zlib.crc32(ids[lo:lo + capacity].tobytes()))
            for k, lo in enumerate(range(0, len(ids), capacity))]


@pytest.mark.parametrize("capacity", [4096, 256])
def test_pieces_and_places(awkward, small, capacity):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path())
    for docs in (awkward, small):
        want = by_id([(r.doc_id, *p) for r in docs.select("doc_id", "text").collect()
                      for p in pieces_of(r.text, tok, capacity)])
        out = P.pack(docs, tokenizer_path(), capacity, group_pieces=400).collect()
        assert by_id([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out]) == want
        bins: dict[int, list] = {}
        for r in out:
            bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for b in bins.values():
            at = 0
            for offset, length in sorted(b):
                assert offset == at
                at += length
            assert at <= capacity
        groups = max(1, -(-len(want) // 400))
        assert len(bins) <= len(P.best_fit(np.asarray([w[3] for w in want]), capacity)) + 2 * (groups - 1)


def test_a_task_leaves_no_tables_in_its_worker():
    """Workers serve the other stages too: neither the encoder nor the powers stay."""
    rows = pa.table({"doc_id": [1, 2], "text": ["some words, more words", None]}).to_batches()
    out = list(T.tidied(P._token_pieces(tokenizer_path(), P.CAPACITY))(iter(rows)))
    assert [r["length"] > 0 for b in out for r in b.to_pylist()] == [True, True]
    gc.collect()
    assert not any(isinstance(x, P.WordEncoder) for x in gc.get_objects())
    assert sum(x.nbytes for x in T._powers) < 1000


def test_workers_do_not_grow_with_their_tasks(monkeypatch):
    """A worker runs many tasks: the tokenizer's word tables, one a task and thread, stayed in it."""
    monkeypatch.delenv("TOKENIZERS_PARALLELISM", raising=False)
    draw = random.Random(7)
    texts = [" ".join("".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=9)) for _ in range(500)) for _ in range(40)]
    rows = pa.table({"doc_id": range(len(texts)), "text": texts}).to_batches()

    def after_a_task() -> float:
        assert sum(b.num_rows for b in T.tidied(P._token_pieces(tokenizer_path(), P.CAPACITY))(iter(rows))) >= len(texts)
        gc.collect()
        return int(re.search(r"RssAnon:\s+(\d+)", Path("/proc/self/status").read_text())[1]) / 1024

    held, threads = [after_a_task() for _ in range(2)][-1], len(os.listdir("/proc/self/task"))
    assert max(after_a_task() for _ in range(6)) - held < 12       # MB; a table holds about 7
    assert len(os.listdir("/proc/self/task")) <= threads


@pytest.mark.parametrize("budget", [1, 100, 1 << 20])
def test_ids_do_not_depend_on_what_is_encoded_at_a_time(monkeypatch, budget):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path())
    texts = ["Some words, more words. it's 12 o'clock", None, "", "na\u00efve caf\u00e9! " * 30, "x" * 300, "a <|endoftext|> b", "tail words more"]
    monkeypatch.setattr(P, "ENCODED_BYTES", budget)
    monkeypatch.setattr(P, "STRING_WORDS", 2)
    rows = pa.table({"doc_id": range(len(texts)), "text": pa.array(texts, pa.string())}).to_batches()
    found = [tuple(r.values()) for b in P._token_pieces(tokenizer_path(), 50)(iter(rows)) for r in b.to_pylist()]
    assert found == [(k, *p) for k, t in enumerate(texts) for p in pieces_of(t, tok, 50)]


def test_a_group_is_packed_without_pandas():
    """A worker that loads pandas, or keeps a group's lists, is larger in every stage after it."""
    rows = pa.table({"doc_id": [2, None, 1], "piece": pa.array([0, 0, 0], pa.int32()), "start": [0, 0, 0], "length": [5, 4, 6],
                     "ids_crc32": [1, 2, 3], "_group": pa.array([3, 3, 3], pa.int32())})
    out = P._pack_group(10)(rows)
    assert out.column_names == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert [(r["doc_id"], r["sequence_id"] >> 32) for r in out.to_pylist()] == [(1, 3), (2, 3), (None, 3)]
    at = {r["doc_id"]: (r["sequence_id"], r["offset"]) for r in out.to_pylist()}
    assert at[1][0] == at[None][0] != at[2][0] and {at[1][1], at[None][1]} in ({0, 4}, {0, 6})
    assert not hasattr(P, "pd")


def test_hashes_do_not_depend_on_the_powers_at_hand():
    texts = [b"one two three", b"", b"three two one " * 40]
    T.give_back()
    grown = T.words(texts).hash
    T.powers(T.BLOCK_BYTES)
    assert np.array_equal(grown, T.words(texts).hash)
    up, down = (x[:5].tolist() for x in T.powers(5))
    assert up == [pow(T._BASE, k, 1 << 64) for k in range(5)] and down == [pow(T._INVERSE, k, 1 << 64) for k in range(5)]


def test_empty(nothing):
    assert P.pack(nothing, tokenizer_path()).count() == 0


def test_local_search_empties_bins():
    rng = np.random.default_rng(3)
    for trial in range(30):
        sizes = rng.integers(200, 700, 60)
        loose = [[i, i + 1] for i in range(0, 60, 2)]
        after = P.local_search([list(b) for b in loose], sizes, 1400)
        assert sorted(i for b in after for i in b) == list(range(60))
        assert all(sizes[b].sum() <= 1400 for b in after)
        assert len(after) < len(loose)
        assert (sum(sizes[b].sum() ** 2 for b in after) > sum(sizes[b].sum() ** 2 for b in loose))


def test_swaps_do_what_moves_cannot():
    # 6+3 and 5+4 of 10: exchanging 6 for... no move fits, one swap fills a bin
    sizes = np.array([6, 3, 5, 4])
    after = P.local_search([[0, 1], [2, 3]], sizes, 10)
    assert max(sizes[b].sum() for b in after) == 10
