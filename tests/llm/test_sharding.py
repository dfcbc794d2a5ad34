from collections import Counter

import pytest

from ledgerlake.llm import sharding


def test_every_shard_claims_its_share_in_turn():
    owner = sharding.lookup_table()
    counts = Counter(owner)
    assert set(counts) == set(range(len(sharding.SHARDS)))
    assert max(counts.values()) - min(counts.values()) <= 1


def test_few_slots_move_when_a_shard_goes():
    names = list(sharding.SHARDS)
    before = sharding.lookup_table(names)
    less = names[:10] + names[11:]
    after = sharding.lookup_table(less)
    kept = [(a, less[b]) for a, b in zip(before, after, strict=True) if names[a] != names[10]]
    moved = sum(names[a] != b for a, b in kept)
    assert moved < 0.1 * len(kept)


def test_bad_parameters():
    with pytest.raises(ValueError):
        sharding.lookup_table(["a", "b"], 10)
    with pytest.raises(ValueError):
        sharding.lookup_table(["a", "a"], 11)
    with pytest.raises(ValueError):
        sharding.lookup_table(["a", "b", "c"], 2)


def test_odd_rows(odd_docs, no_docs):
    got = sharding.assign_shards(odd_docs).collect()
    assert len(got) == 10 and all(r.shard in sharding.SHARDS for r in got)
    assert len({(r.doc_id, r.slot, r.shard) for r in got}) == 8
    assert sharding.assign_shards(no_docs).count() == 0


def test_plan_is_native_and_has_no_shuffle(odd_docs):
    plan = sharding.assign_shards(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Join" not in plan
