
from cdclake.operators.gold import GOLD_COLUMNS, build_gold
from cdclake.sources import seeds


def _df(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_gold_one_row_per_transaction_and_defaults(spark):
    fact = _df(spark, [(1, 10, 12.5, 0, 0.5, "W", 7, 100.0, 1.0), (2, 20, 3.0, 1, 0.0, "Z", 99, None, None),
                       (None, 5, 1.0, 0, 0.0, "W", 7, None, None), (None, 6, 1.0, 0, 0.0, "W", 7, None, None)],
               "TransactionID long, TransactionDT long, TransactionAmt double, isFraud int, z_score double, ProductCD string, card1 long, addr1 double, addr2 double")
    mc = _df(spark, [(1, 7, "00000001", 7, 1), (2, 7, "00000002", 7, 1)], "Card_Key long, Card_Raw_ID long, Client_No string, Bank_ID long, Card_Network_ID long")
    banks = _df(spark, [(7, "Acme")], "Bank_ID long, Bank_Name string")
    nets = _df(spark, [(1, "visa", "credit")], "Card_Network_ID long, Network_Name string, Card_Type string")
    users = _df(spark, [("00000002", 3)], "client_no string, kyc_level short")
    accts = _df(spark, [("1900000000202", "00000002", True, "OPEN"), ("1900000000201", "00000002", True, "OPEN")],
                "account_number string, client_no string, is_primary boolean, account_status string")
    ident = _df(spark, [(1, "mobile", "phone")], "TransactionID long, DeviceType string, DeviceInfo string")
    devices = _df(spark, [(5, "phone", "ios"), (3, "phone", "android")], "Device_ID long, Device_Name string, OS_Version string")
    loc = _df(spark, [(1, 100.0, None, None, None), (2, 100.0, None, "EU", "FR")],
              "LocationID long, addr1 double, addr2 double, Region string, Country string")
    g = build_gold(fact, seeds.product_description(spark), mc, banks, nets, users, accts, ident, devices, loc)
    assert tuple(g.columns) == GOLD_COLUMNS
    rows = g.collect()
    assert len(rows) == 3  # fan-out sides de-duplicated; the two null-key rows collapse to one
    r1 = next(r for r in rows if r.TransactionID == 1)
    assert r1.client_no == "00000002" and r1.kyc_level == 3  # MAX per column of the card links
    assert r1.account_number == "1900000000201"  # smallest primary account
    assert r1.OS_Version == "android"  # smallest Device_ID for the device name
    assert (r1.Region, r1.Country) == ("Unknown", "Unknown")  # smallest (Region, Country) is the null pair
    assert r1.Bank_Name == "Acme" and r1.ProductDesc.startswith("Web Transaction")
    r2 = next(r for r in rows if r.TransactionID == 2)
    assert (r2.client_no, r2.kyc_level, r2.current_balance, r2.ProductDesc, r2.DeviceType) == ("Unknown", 0, "0", "Unknown", "Unknown")


def _lake(spark):
    """Small silver tables of every gold input."""
    from cdclake.plans.jobs import GOLD_INPUTS, Layout
    from cdclake.schemas import TABLES
    from cdclake.session import scratch_path
    from cdclake.sinks.snapshots import SnapshotTable

    layout = Layout(scratch_path(spark, "lake"))
    for name in GOLD_INPUTS:
        schema = TABLES[name].schema
        if name == "transaction":
            row = _df(spark, [(1, 10, 12.5, 0, 0.5, "W", 7, 100.0, 1.0)],
                      "TransactionID long, TransactionDT long, TransactionAmt double, isFraud int, z_score double, ProductCD string, card1 long, addr1 double, addr2 double")
        else:
            row = spark.createDataFrame([tuple(None for _ in schema)], schema)
        SnapshotTable(spark, layout.silver(name), use_delta=False).overwrite(row)
    return layout


def test_a_broken_or_missing_silver_table_stops_gold(spark):
    import glob
    import os
    import shutil

    import pytest

    from cdclake.plans.jobs import build_gold_job, gold_from_silver

    layout = _lake(spark)
    assert build_gold_job(spark, layout).count() == 1
    shutil.rmtree(layout.silver("location").removeprefix("file:"))
    with pytest.raises(FileNotFoundError):
        gold_from_silver(spark, layout)
    assert gold_from_silver(spark, layout, allow_missing=True).first().Region == "Unknown"
    folder = layout.silver("product_description").removeprefix("file:")
    for f in glob.glob(f"{folder}/*.parquet"):
        with open(f, "wb") as out:
            out.write(b"garbage")
        os.remove(f"{os.path.dirname(f)}/.{os.path.basename(f)}.crc")
    with pytest.raises(Exception):
        build_gold_job(spark, layout, allow_missing=True)


def test_a_failed_dimension_stops_the_run(spark, monkeypatch):
    import pytest

    from cdclake.plans import jobs

    monkeypatch.setattr(jobs, "build_silver_dimensions", lambda *a: {"location": "failed: x", "status": "ok"})
    monkeypatch.setattr(jobs, "build_silver_transaction", lambda *a: 1)
    monkeypatch.setattr(jobs, "build_gold_job", lambda *a, **b: pytest.fail("gold was built"))
    with pytest.raises(RuntimeError):
        jobs.run_all(spark, jobs.Layout("nowhere"))
