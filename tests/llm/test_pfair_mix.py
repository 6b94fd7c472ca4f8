import random

import pytest

from cdclake.llm import pfair_mix as p
from tests.llm.conftest import rows


def place(row, k):
    return row["base"] + row["slots"][k]


def owners(blocks, weights):
    """Source and block of every slot."""
    owner = [None] * sum(blocks.values())
    for r in p.phases(blocks, weights):
        for k in range(r["last"] - r["first"]):
            assert owner[place(r, k)] is None
            owner[place(r, k)] = (r["source"], r["first"] + k)
    return owner


def test_every_block_has_one_slot_in_order():
    rng = random.Random(1)
    for _ in range(80):
        weights = {f"s{i}": rng.random() ** 3 + 0.001 for i in range(rng.randint(1, 12))}
        blocks = {s: rng.choice([0, 1, rng.randint(0, 2500)]) for s in weights}
        owner = owners(blocks, weights)
        assert None not in owner
        for s, n in blocks.items():
            assert [j for x, j in owner if x == s] == list(range(n))


def test_deviation_from_the_exact_weights():
    """Until the first source runs out: below one block at the end of every period, below two at every slot, hardly ever over one."""
    rng = random.Random(2)
    cases = [{f"s{i}": (1000 * (i + 1)) ** 0.5 for i in range(20)}, {"big": 1.0, "mid": 0.0437, "rare": 1 / 7000}]
    cases += [{f"s{i}": rng.random() ** rng.choice([1, 2, 4]) + 1e-4 for i in range(rng.randint(2, 40))} for _ in range(14)]
    over = total_slots = 0
    for weights in cases:
        total = sum(weights.values())
        size = max(p.PERIOD, -int(-total // min(weights.values())))
        slots = 5 * size
        owner = [s for s, _ in owners({s: int(w / total * slots) + 3 for s, w in weights.items()}, weights)]
        last = {s: t for t, s in enumerate(owner)}
        count = dict.fromkeys(weights, 0)
        for t in range(min(last.values()) + 1):
            count[owner[t]] += 1
            # the one that got the slot, and from time to time all others
            seen = weights if t % 61 == 0 or (t + 1) % size == 0 else [owner[t]]
            off = max(abs(count[s] - weights[s] / total * (t + 1)) for s in seen)
            assert off < (1 if (t + 1) % size == 0 else 2)
            over, total_slots = over + (off >= 1), total_slots + 1
    assert over < 0.01 * total_slots


def test_counts_of_periods():
    rng = random.Random(3)
    for _ in range(40):
        weights = {f"s{i}": rng.random() ** 6 + 1e-6 for i in range(rng.randint(1, 60))}
        shares, total = p.cumulated(weights), sum(weights.values())
        size, last = -int(-total // min(weights.values())), dict.fromkeys(weights, 0)
        for slots in sorted(rng.randrange(10**4) * size for _ in range(50)):
            now = p.quotas(shares, slots)
            assert sum(now.values()) == slots and all(now[s] >= n for s, n in last.items())
            assert all(abs(now[s] - w / total * slots) < 1 + 1e-6 for s, w in weights.items())
            last = now


def test_windows():
    """Blocks lie in their windows of release and deadline, but for late ones after the start of a period."""
    weights = {"a": 5.0, "b": 3.0, "c": 2.0}
    shares = p.cumulated(weights)
    for k in range(5):
        before, slots = p.earliest_deadline_first(shares, 100 * k, 100)
        for s, x in slots.items():
            for j, t in enumerate(x, before[s]):
                assert int(j * 10 / weights[s]) <= 100 * k + t < -int(-(j + 1) * 10 // weights[s])


def test_more_sources_than_are_scheduled(spark, monkeypatch):
    """The rarest share a schedule; each is spread over it by its weight."""
    monkeypatch.setattr(p, "MAX_SOURCES", 6)
    data = [(i, "big" if i % 3 == 0 else f"s{i % 40}") for i in range(4000)]
    table = p.mix(spark.createDataFrame(data, "doc_id bigint, source string")).collect()
    assert sorted(r.doc_id for r in table) == list(range(4000))
    assert len({(r.mix_slot, r.mix_offset) for r in table}) == 4000
    order = sorted(table, key=lambda r: (r.mix_slot, r.mix_offset))
    for s in ("s1", "s7", "s22"):  # evenly over the mix while all sources last
        places = [i for i, r in enumerate(order) if r.source == s]
        assert max(b - a for a, b in zip(places, places[1:], strict=False)) < 0.2 * len(order)


def test_thousands_of_sources(spark):
    data = [(i, f"s{i % 5000}") for i in range(12_000)]
    table = p.mix(spark.createDataFrame(data, "doc_id bigint, source string"))
    assert table.count() == 12_000 and table.select("mix_slot", "mix_offset").distinct().count() == 12_000


def test_every_document_gets_its_place(spark):
    sources = [(i, f"s{min(9, i % 30)}", f"text {i}") for i in range(3000)]  # the last source holds two thirds
    table = spark.createDataFrame(sources, "doc_id bigint, source string, text string")
    weights = {f"s{i}": 1 + i for i in range(10)}
    found = p.mix(table, weights).collect()
    assert sorted(r.doc_id for r in found) == list(range(3000))
    assert len({(r.mix_slot, r.mix_offset) for r in found}) == 3000
    by_source = {}
    for r in sorted(found, key=lambda r: (r.mix_slot, r.mix_offset)):
        by_source.setdefault(r.source, []).append(r)
    blocks = {s: -(-len(x) // p.BLOCK_ROWS) for s, x in by_source.items()}
    slots = {}
    for r in p.phases(blocks, weights):
        slots.setdefault(r["source"], []).extend(place(r, k) for k in range(r["last"] - r["first"]))
    for s, mixed in by_source.items():
        assert [(r.mix_slot, r.mix_offset) for r in mixed] == [(slots[s][i // p.BLOCK_ROWS], i % p.BLOCK_ROWS) for i in range(len(mixed))]


def test_written_files_follow_the_order(spark, tmp_path):
    table = spark.createDataFrame([(i, f"s{i % 3}") for i in range(500)], "doc_id bigint, source string")
    mixed = p.mix(table)
    expected = [r.doc_id for r in sorted(mixed.collect(), key=lambda r: (r.mix_slot, r.mix_offset))]
    ordered = p.in_order(table)
    assert ordered.columns == table.columns
    assert [r.doc_id for r in ordered.collect()] == expected


def test_edge_cases(messy, crowded, empty_docs):
    found = p.mix(messy)
    assert rows(found.drop("mix_slot", "mix_offset")) == rows(messy)
    assert rows(p.mix(crowded), "doc_id", "mix_slot", "mix_offset") == rows(found, "doc_id", "mix_slot", "mix_offset")
    assert p.mix(empty_docs).count() == 0
    with pytest.raises(ValueError):
        p.mix(messy, {"a": 0.0})
