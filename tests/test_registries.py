"""Entity runs one after the other: numbers are never given twice, and nothing old is written again."""

from pyspark.sql import types as T

from cdclake.plans.jobs import Layout, build_entities
from cdclake.session import scratch_path
from cdclake.sinks.snapshots import SnapshotTable

TXN = ("TransactionID long, card1 long, card2 double, card3 double, card4 string, card6 string, addr1 double, addr2 double, "
       "P_emaildomain string")
IDENTITY = "TransactionID long, DeviceType string, DeviceInfo string, id_30 string, id_31 string, id_33 string"
REGISTRIES = {"client_numbers": "client_no", "description_card": "Card_Network_ID", "location": "LocationID",
              "device_fingerprint": "Device_ID", "master_card": "Card_Key"}


def txn(i):
    return (i, 100 + i, 1.0, 2.0, f"net{i}", "credit", float(i), 1.0, f"m{i}.com")


def source(spark, layout, ids):
    SnapshotTable(spark, layout.source("transaction"), use_delta=False).overwrite(spark.createDataFrame([txn(i) for i in ids], TXN))
    devices = [(i, "mobile", f"phone{i}", "os", "b", "s") for i in ids]
    SnapshotTable(spark, layout.source("identity"), use_delta=False).overwrite(spark.createDataFrame(devices, IDENTITY))


def state(spark, layout, name):
    rows = SnapshotTable(spark, layout.source(name), use_delta=False).read()
    key = REGISTRIES[name]
    return {tuple(r[c] for c in rows.columns if c != key): r[key] for r in rows.collect()}, set(rows.inputFiles())


def test_numbers_are_never_reused_and_a_rerun_writes_nothing(spark):
    layout = Layout(scratch_path(spark, "registries"))
    source(spark, layout, [1, 2, 3])
    build_entities(spark, layout)
    first = {n: state(spark, layout, n) for n in REGISTRIES}
    files = {n: set(SnapshotTable(spark, layout.source(n), use_delta=False).read().inputFiles()) for n in ("user_profile", "user_accounts", "card_issuing_bank")}
    assert set(build_entities(spark, layout).values()) == {0}
    for n in REGISTRIES:
        assert state(spark, layout, n) == first[n]
    for n, old in files.items():
        assert set(SnapshotTable(spark, layout.source(n), use_delta=False).read().inputFiles()) == old

    source(spark, layout, [1, 2])  # 3 is gone
    build_entities(spark, layout)
    source(spark, layout, [1, 2, 4])  # 4 must not get what was 3's
    build_entities(spark, layout)
    source(spark, layout, [1, 2, 3, 4])  # and 3 is as before
    assert all(n == 0 for t, n in build_entities(spark, layout).items() if t in REGISTRIES)
    for n in REGISTRIES:
        rows, now = state(spark, layout, n)
        assert len(set(rows.values())) == len(rows) == 4, n
        assert first[n][0].items() <= rows.items() and first[n][1] < now, n


def test_only_changed_profiles_are_rewritten(spark):
    from cdclake.sinks.snapshots import changed_rows

    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])
    old = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], schema)
    new = spark.createDataFrame([(1, "a"), (2, None), (3, "C"), (4, "d")], schema)
    assert sorted(r.k for r in changed_rows(old, new, ["k"], ["v"]).collect()) == [3, 4]
