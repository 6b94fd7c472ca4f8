import pytest

from cdclake.plans import catalog

SF = "/root/testdata/sf0.001"


def events(spark):
    """Events in the order of their changes: time in milliseconds, then event id."""
    rows = spark.read.parquet(f"{SF}/events.parquet").selectExpr(
        "event_id", "user_id", "event_type", "unix_millis(CAST(ts AS timestamp)) AS ms"
    )
    return sorted(rows.collect(), key=lambda r: (r.ms, r.event_id))


def test_every_event_is_in_one_arrival(spark):
    earlier, later = catalog._split_activity(spark, SF)
    whole = catalog.activity_bronze(spark, SF)
    assert earlier.count() + later.count() == whole.count()


@pytest.mark.parametrize("name", ["upsert_merge", "upsert_roundtrip", "upsert_apply_deletes"])
def test_latest_state_is_that_of_the_whole_log(spark, name):
    latest = {}
    for r in events(spark):
        if name == "upsert_apply_deletes" or r.event_type != "error":
            latest[r.user_id] = r.event_type
    found = {r.user_id: r.event_type for r in catalog.QUERIES[name](spark, SF).collect()}
    assert found == {u: e for u, e in latest.items() if e != "error"}
