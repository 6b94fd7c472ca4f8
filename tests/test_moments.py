import random
import statistics

import pytest
from pyspark.sql import functions as F

from cdclake.operators.features import zscore
from cdclake.operators.moments import COUNT, M2, MEAN, GroupStatistics, merge_moments, moments, taken_back, zscore_from_moments
from cdclake.session import scratch_path

ROW = "id long, card long, amt double"


def as_dict(states):
    return {r.card: (r[COUNT], r[MEAN], r[M2]) for r in states.collect()}


def close(found, wanted):
    found = {k: v for k, v in found.items() if v[0]}
    assert found.keys() == wanted.keys()
    for k, v in wanted.items():
        assert found[k][0] == v[0] and found[k][1:] == pytest.approx(v[1:], rel=1e-9, abs=1e-9)


def rows_of(rng, n, start=0):
    return [(start + i, rng.choice([1, 1, 1, 2, 3, None]), rng.choice([None, 5.0, rng.uniform(1, 900)])) for i in range(n)]


def test_merge_and_take_back(spark):
    rng = random.Random(1)
    a, b = (spark.createDataFrame(rows_of(rng, n), ROW) for n in (70, 40))
    whole = moments(a.union(b), "card", "amt")
    merged = merge_moments(moments(a, "card", "amt"), moments(b, "card", "amt"), "card")
    close(as_dict(merged), as_dict(whole))
    back = merge_moments(merged, taken_back(moments(b, "card", "amt")), "card")
    close(as_dict(back), {k: v for k, v in as_dict(moments(a, "card", "amt")).items() if v[0]})
    # nothing left of a group: no rounding stays behind
    nothing = merge_moments(moments(a, "card", "amt"), taken_back(moments(a, "card", "amt")), "card")
    assert set(as_dict(nothing).values()) == {(0, 0.0, 0.0)}


def plain(fact):
    out = {}
    groups = {}
    for _, card, amt in fact.values():
        groups.setdefault(card, []).extend([amt] if amt is not None else [])
    for i, (_, card, amt) in fact.items():
        values = groups[card]
        mean = statistics.fmean(values) if values else None
        sd = statistics.stdev(values) if len(values) > 1 else None
        z = 0.0 if not sd else (None if amt is None else (amt - mean) / sd)
        out[i] = (mean, sd, z)
    return out


def test_arrivals_give_the_scores_of_the_whole(spark):
    """New rows, changed amounts, changed cards, unchanged rows and repeats, over four arrivals."""
    rng = random.Random(7)
    root = scratch_path(spark, "statistics")
    cards = GroupStatistics(spark, root, ["id"], "card", "amt", buckets=4)
    fact = {}
    for arrival in range(4):
        part = rows_of(rng, 60, start=arrival * 60)
        part += [(i, card if rng.random() < 0.5 else rng.choice([1, 2, 9, None]), amt if rng.random() < 0.3 else rng.uniform(1, 900))
                 for i, card, amt in rng.sample(list(fact.values()), min(len(fact), 25))]
        frame = spark.createDataFrame(part, ROW)
        cards.update(frame, arrival)
        fact.update({r[0]: r for r in part})
        if arrival == 2:  # the same arrival once more
            cards.update(frame, arrival)
    table = spark.createDataFrame(list(fact.values()), ROW)
    close(as_dict(cards.states()), {k: v for k, v in as_dict(moments(table, "card", "amt")).items() if v[0]})
    scored = {r.id: (r.avg_amt, r.std_amt, r.z_score) for r in zscore_from_moments(table, cards.states(), "card", "amt").collect()}
    batch = {r.id: (r.avg_amt, r.std_amt, r.z_score) for r in zscore(table, "card", "amt").collect()}
    for i, wanted in plain(fact).items():
        for got, b, w in zip(scored[i], batch[i], wanted, strict=True):
            assert (got is None) == (w is None) == (b is None)
            assert w is None or (got == pytest.approx(w, rel=1e-8, abs=1e-8) and b == pytest.approx(w, rel=1e-8, abs=1e-8))


def test_an_arrival_that_failed_half_way_is_finished(spark, monkeypatch):
    """The states were written, the values were not: the same arrival again counts nothing twice."""
    rng = random.Random(3)
    first, second = rows_of(rng, 80), rows_of(rng, 50, start=40)
    cards = GroupStatistics(spark, scratch_path(spark, "statistics"), ["id"], "card", "amt", buckets=4)
    cards.update(spark.createDataFrame(first, ROW), 0)
    monkeypatch.setattr(cards.values, "upsert", lambda *_: (_ for _ in ()).throw(OSError("driver lost")))
    with pytest.raises(OSError):
        cards.update(spark.createDataFrame(second, ROW), 1)
    monkeypatch.undo()
    cards.update(spark.createDataFrame(second, ROW), 1)
    fact = {r[0]: r for r in first + second}
    whole = moments(spark.createDataFrame(list(fact.values()), ROW), "card", "amt")
    close(as_dict(cards.states()), {k: v for k, v in as_dict(whole).items() if v[0]})


def test_an_arrival_writes_only_what_it_changes(spark):
    cards = GroupStatistics(spark, scratch_path(spark, "statistics"), ["id"], "card", "amt", buckets=8)
    cards.update(spark.range(400).selectExpr("id", "id % 50 AS card", "CAST(id AS double) AS amt"), 0)
    before = {t: set(getattr(cards, t).read().inputFiles()) for t in ("values", "moments")}
    cards.update(spark.createDataFrame([(7, 7, 1000.0)], ROW), 1)
    for t, files in before.items():
        gone = files - set(getattr(cards, t).read().inputFiles())
        assert len(gone) == 1, t
    cards.update(spark.createDataFrame([(7, 7, 1000.0)], ROW), 2)  # nothing new
    assert cards.moments.read().where(F.col("_batch") == 2).count() == 0
