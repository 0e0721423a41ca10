import heapq
import random
import zlib
from collections import Counter, defaultdict

import pytest

from ledgerwatch.llm import mixing, sharding
from ledgerwatch.llm.common import staged
from llm_fixtures import empty_documents, odd_documents, table


@pytest.mark.parametrize("seed", range(8))
def test_cycle_stays_within_a_block(seed):
    rng = random.Random(seed)
    weights = {f"s{i}": rng.randint(1, 30) for i in range(rng.randint(1, 9))}
    total = sum(weights.values())
    slots = mixing.cycle(weights)
    assert sorted(x for s in slots.values() for x in s) == list(range(total))
    for name, w in weights.items():
        served = 0
        for t in range(total + 1):
            assert abs(served - t * w / total) < 1
            served += t in set(slots[name])


def test_phases_place_every_block_once():
    plan = mixing.phases({"a": 5, "b": 3, "c": 2}, {"a": 17, "b": 40, "c": 1})
    seen = {}
    for source, first, last, start, length, slots in plan:
        for b in range(first, last):
            turn = b - first
            seen[source, b] = start + turn // len(slots) * length + slots[turn % len(slots)]
    assert Counter(s for s, _ in seen) == {"a": 17, "b": 40, "c": 1}
    assert sorted(seen.values()) == list(range(58))
    assert mixing.phases({"a": 1}, {}) == []


def test_schedule_of_a_table(spark):
    docs = table(spark, "documents").select("doc_id", "source")
    rows = mixing.schedule(docs, {"src0": 3, "src1": 2, mixing.REST: 5}, block=2).collect()
    assert len(rows) == docs.count() and len({r.place for r in rows}) == len(rows)
    blocks = sorted({(r.slot, r["class"]) for r in rows})
    assert [s for s, _ in blocks] == list(range(len(blocks)))
    left = Counter(c for _, c in blocks)
    served = Counter()
    for t, (_, c) in enumerate(blocks, 1):  # while all classes last
        served[c] += 1
        if any(served[x] == left[x] for x in left):
            break
        for name, w in {"src0": .3, "src1": .2, "rest": .5}.items():
            assert abs(served[name] - t * w) < 1


def test_mix_and_shards_keep_odd_rows(spark):
    docs = odd_documents(spark)
    mix = staged(mixing.mixed(docs, {"src0": 1}), "mix")
    assert mix.columns == docs.columns
    key = lambda df: sorted(map(str, df.collect()))
    assert key(mix) == key(docs)
    ordered = mixing.written_order(mix)
    out = sharding.shard_documents(ordered, 3, ("__lw_file", "__lw_row"))
    assert key(out.select(*docs.columns)) == key(docs)
    for _, rows in grouped(out.collect(), "shard").items():
        assert sorted(r.slot for r in rows) == list(range(len(rows)))
        by_slot = sorted(rows, key=lambda r: r.slot)
        places = [(r["__lw_file"], r["__lw_row"]) for r in by_slot]
        assert places == sorted(places)
    empty = empty_documents(spark)
    assert mixing.mixed(empty, {"src0": 1}).count() == 0
    assert sharding.shard_documents(empty, 3).count() == 0
    assert sharding.shard_report(empty).count() == 0 and mixing.mix_report(empty).count() == 0


def grouped(rows, name):
    out = defaultdict(list)
    for r in rows:
        out[r[name]].append(r)
    return out


def test_shards_match_longest_first(spark):
    docs = table(spark, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = sharding.shard_report(docs).collect()
    sizes, groups = Counter(), defaultdict(set)
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (
            len(raw) + 16, zlib.crc32(raw), "bytes", None)
        sizes[texts[r.doc_id]] += r.size
        groups[texts[r.doc_id]].add(r.shard)
    assert all(len(s) == 1 for s in groups.values())
    got = Counter()
    for r in rows:
        got[r.shard] += r.size
    loads = [0] * 40
    for size in sorted(sizes.values(), reverse=True):
        heapq.heapreplace(loads, loads[0] + size)
    assert sorted(got.values()) == sorted(loads)
    for shard in grouped(rows, "shard").values():
        ordered = sorted(shard, key=lambda r: r.slot)
        assert [r.slot for r in ordered] == list(range(len(ordered)))
        assert [r.doc_id for r in ordered] == sorted(r.doc_id for r in ordered)


def test_bundles_balance(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SINGLES", 20)
    rows = spark.range(20_000).selectExpr("cast(id as string) as `group`", "100 + id % 7 as size")
    loads = [r[0] for r in sharding.assigned(rows, 8).groupBy("shard").sum("size")
             .select("sum(size)").collect()]
    assert len(loads) == 8 and max(loads) - min(loads) < 0.02 * sum(loads) / 8
