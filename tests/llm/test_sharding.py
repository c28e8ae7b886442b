import os
import zlib
from collections import Counter

import pytest

from planmart.session import work_path

from planmart.llm import sharding as S

from .helpers import corpus, docs_df


def test_slots_sizes_and_positions(spark):
    rows = corpus()
    out, slot_map = S.shard(docs_df(spark, rows), 8)
    got = out.collect()
    size = lambda t: len((t or "").encode()) + 1
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (i, size(t), zlib.crc32((t or "").encode())) for i, t in rows)
    for shard in range(8):
        own = sorted(r.slot for r in got if r.shard == shard)
        assert own == list(range(len(own)))
    assert slot_map.count() == S.N_SLOTS
    loads = Counter()
    for r in got:
        loads[r.shard] += r.size
    # largest slot first to the least loaded shard: no two shards differ by more than one slot
    largest = max(r["bytes"] for r in slot_map.collect())
    assert max(loads.values()) - min(loads[k] for k in range(8)) <= largest


def test_growing_moves_slots_only_to_the_new_shard(spark):
    records = S.with_slots(docs_df(spark, corpus(n=400)), 64)
    totals = S.slot_totals(records, 64)
    path = work_path(spark, "slot-map")
    old = S.store_map(S.edit_map(totals, 4), path, 1)
    new = S.rebalance(path, totals, 5)
    before = {r.virtual_slot: r.shard for r in old.collect()}
    after = {r.virtual_slot: (r.shard, r.moved, r.version) for r in new.collect()}
    assert {v[2] for v in after.values()} == {2}
    moved = {s for s, (shard, m, _) in after.items() if m}
    assert moved and all(after[s][0] == 4 for s in moved)
    assert all(after[s][0] == before[s] for s in after if s not in moved)


def test_versions_are_kept_and_the_last_whole_one_is_read(spark):
    docs = docs_df(spark, corpus(n=100))
    path = work_path(spark, "slot-map")
    _, first = S.shard(docs, 4, 64, map_path=path)
    with pytest.raises(FileExistsError):
        S.shard(docs, 5, 64, map_path=path)
    totals = S.slot_totals(S.with_slots(docs, 64), 64)
    for shards in (5, 6):
        S.rebalance(path, totals, shards)
    os.makedirs(f"{path}/version=4")  # a write that did not end
    last = S.load_map(spark, path)
    assert {r.version for r in last.collect()} == {3} and {r.shard for r in last.collect()} == set(range(6))
    assert sorted(map(tuple, S.load_map(spark, path, 1).collect())) == sorted(map(tuple, first.collect()))
    with pytest.raises(LookupError):
        S.load_map(spark, path, 9)
    assert S.rebalance(path, totals, 6).first().version == 4


def test_an_even_map_is_left_alone(spark):
    totals = S.slot_totals(S.with_slots(docs_df(spark, [(i, "x" * 9) for i in range(500)]), 64), 64)
    old = S.edit_map(totals, 4)
    assert S.edit_map(totals, 4, old, 2).where("moved").count() <= 4


def test_shrinking_empties_the_last_shard(spark):
    totals = S.slot_totals(S.with_slots(docs_df(spark, corpus()), 64), 64)
    new = S.edit_map(totals, 3, S.edit_map(totals, 4), 2)
    assert {r.shard for r in new.collect()} == {0, 1, 2}


def test_empty_table(spark):
    out, slot_map = S.shard(docs_df(spark, []), 8)
    assert out.count() == 0 and slot_map.count() == S.N_SLOTS
