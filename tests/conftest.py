import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from cdclake.session import build_session

    s = build_session("local[4]", app_name="cdclake-tests", shuffle_partitions=4)
    yield s
    s.stop()


def envelope(key: dict | None, after: dict | None, op: str | None, ts: int | None, before: dict | None = None) -> str:
    import json

    return json.dumps({"payload": {"before": before, "after": after, "op": op, "source": {"ts_ms": ts}}})
