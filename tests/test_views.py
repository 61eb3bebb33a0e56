"""Views of the check tables leave no event out."""

from pathlib import Path

import pytest

from checks import views as V
from checks.queries import platform_from_sidecar, release_version, view

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no check tables")


@pytest.mark.parametrize("lines", [V.VERSION_LINES, V.PLATFORM_LINES])
def test_lines_of_all_events(spark, lines):
    events = {r.event_id for r in spark.read.parquet(f"{DATA}/events.parquet").select("event_id").collect()}
    rows = view(spark, str(DATA), lines).where("dir like 'd%'").collect()
    assert len(rows) == len(events) and {r.event_id for r in rows} == events


def test_directories_without_fields(spark):
    found = {r.dir: (r.major_version, r.minor_version) for r in release_version(spark, str(DATA)).collect()}
    assert {v for d, v in found.items() if d.startswith("n")} == {(-1, -1)}
    found = {r.dir: r.platform for r in platform_from_sidecar(spark, str(DATA)).collect()}
    assert {v for d, v in found.items() if d.startswith("n")} == {"Unknown"} and {v for d, v in found.items() if d.startswith("d")} != {"Unknown"}
