import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from weeklens.catalog import REFERENCE_CATALOG, WEEK_LABELS  # noqa: E402
from weeklens.frames import FACT_COLUMNS, Frames  # noqa: E402
from weeklens.session import build_session, ensure_checkpoint_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(cores=8, shuffle_partitions=8, app="weeklens-tests")
    ensure_checkpoint_dir(s)
    yield s


def make_frames(spark, rows, catalog=REFERENCE_CATALOG):
    """rows: dicts with COUNTRY/CITY/ZONE/ZONE_TYPE/ZONE_PRIORITIZATION/METRIC and a 'weeks' list (old -> new)."""
    data = []
    for r in rows:
        weeks = list(r.get("weeks", [None] * 9))
        weeks = [None] * (9 - len(weeks)) + weeks
        data.append((
            r.get("COUNTRY", "CO"), r.get("CITY", "Bogota"), r["ZONE"], r.get("ZONE_TYPE", "Wealthy"),
            r.get("ZONE_PRIORITIZATION", "Prioritized"), r["METRIC"], *[None if w is None else float(w) for w in weeks],
        ))
    schema = ", ".join(
        [f"{c} string" for c in FACT_COLUMNS[:6]] + [f"{w} double" for w in WEEK_LABELS]
    )
    return Frames(spark, spark.createDataFrame(data, schema), catalog)
