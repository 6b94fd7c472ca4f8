import os
import subprocess
import sys

from cdclake.plans.catalog import change_log
from cdclake.session import scratch_path
from tests.conftest import SF_SMALL

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_run_all_from_the_command_line(spark):
    root = scratch_path(spark, "cli")
    change_log(spark, SF_SMALL).repartition(4).write.parquet(f"{root}/records")
    out = subprocess.run(
        [sys.executable, "-m", "cdclake", "run-all", "--root", f"{root}/lake", "--records", f"{root}/records",
         "--master", "local[2]"],
        cwd=REPO, capture_output=True, text=True, timeout=600,
    )
    assert out.returncode == 0, out.stderr[-2000:]
    assert '"gold_rows": 1500' in out.stdout


def _job(*args):
    return subprocess.run(
        [sys.executable, "-m", "cdclake", *args, "--master", "local[2]"], cwd=REPO, capture_output=True, text=True, timeout=600
    )


def test_from_csv_to_gold(spark):
    """CSV files -> source tables -> entities and seeds -> change records -> gold; then one new client."""
    from pyspark.sql import functions as F

    from cdclake.plans import roles
    from cdclake.plans.jobs import Layout
    from cdclake.schemas import TABLES
    from cdclake.sinks.snapshots import SnapshotTable

    root = scratch_path(spark, "csv-lake")
    layout = Layout(f"{root}/lake")
    read = lambda name: SnapshotTable(spark, layout.source(name), use_delta=False).read()
    txn = roles.source_transaction(spark, SF_SMALL).drop("_changed_at")
    txn.where("TransactionID % 2 = 0").write.option("header", True).csv(f"{root}/train_transaction.csv")
    txn.where("TransactionID % 2 = 1").drop("isFraud").write.option("header", True).csv(f"{root}/test_transaction.csv")
    identity = roles.source_identity(spark, SF_SMALL)
    identity.toDF(*[c.replace("id_", "id-") for c in identity.columns]).write.option("header", True).csv(f"{root}/train_identity.csv")
    out = _job("load-source", "--root", layout.root, "--table", "transaction", "--files", f"{root}/test_transaction.csv", f"{root}/train_transaction.csv")
    assert out.returncode == 0 and '"rows_accepted": 1500, "rows_failed": 0' in out.stdout, out.stderr[-2000:]
    for args in (("load-source", "--table", "identity", "--files", f"{root}/train_identity.csv"), ("entities",), ("seeds",)):
        out = _job(args[0], "--root", layout.root, *args[1:])
        assert out.returncode == 0, out.stderr[-2000:]

    clients = {(r.addr1, r.P_emaildomain): r.client_no for r in read("client_numbers").collect()}
    assert len(clients) == len(set(clients.values())) > 10
    records = roles.transaction_records(
        read("transaction").withColumn("TransactionAmt", F.col("TransactionAmt").cast("double")).select(
            "TransactionID", F.coalesce("isFraud", F.lit(0)).alias("isFraud"), "TransactionDT", "TransactionAmt", "ProductCD",
            "card1", "card2", "card3", "card4", "card6", "addr1", "addr2", "P_emaildomain", F.timestamp_millis(F.lit(0)).alias("_changed_at"),
        )
    )
    dims = ["identity", "user_profile", "user_accounts", "master_card", "card_issuing_bank", "description_card",
            "device_fingerprint", "location", "product_description", "status", "blacklist_rules"]
    for name in dims:
        rows = read(name)
        keep = [c for c in rows.columns if dict(rows.dtypes)[c] != "timestamp"]
        records = records.unionByName(roles.dimension_records(name, rows.select(*keep), list(TABLES[name].key), F.lit(0)))
    records.write.parquet(f"{root}/records")
    out = _job("run-all", "--root", layout.root, "--records", f"{root}/records")
    assert out.returncode == 0 and '"gold_rows": 1500' in out.stdout, out.stderr[-2000:]
    gold = spark.read.parquet(layout.gold)
    assert gold.where("client_no <> 'Unknown' AND account_number <> 'Unknown'").count() > 500

    # one transaction of a new client: all old numbers stay
    extra = txn.limit(1).withColumns({"TransactionID": F.lit(10**9), "addr1": F.lit(-1.0), "P_emaildomain": F.lit("aaa.com")})
    extra.write.option("header", True).csv(f"{root}/more_transaction.csv")
    for args in (("load-source", "--table", "transaction", "--files", f"{root}/more_transaction.csv"), ("entities",)):
        assert _job(args[0], "--root", layout.root, *args[1:]).returncode == 0
    again = {(r.addr1, r.P_emaildomain): r.client_no for r in read("client_numbers").collect()}
    assert {k: again[k] for k in clients} == clients
    assert again[-1.0, "aaa.com"] == f"{len(clients) + 1:08d}"


def test_a_failing_job_exits_non_zero(spark):
    root = scratch_path(spark, "empty-lake")
    assert _job("gold", "--root", root).returncode != 0
