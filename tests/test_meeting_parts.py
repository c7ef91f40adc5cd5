"""Annotation files in parts of a few rows: the same rows as the SQL's, and no file that grows with its meeting."""

import os
import re

import duckdb
import pytest

from corvox.plans import meeting_queries as Q
from corvox.plans import registry
from tests.test_queries import DIR, told

NAMES = ["link_table_span", "meeting_sentence_rows", "meeting_topic_rows", "meeting_topic_sections", "meeting_speaker_rows", "reference_range_join"]


@pytest.fixture(scope="module")
def small(tmp_path_factory):
    """The events by another path, as files are written once for each."""
    d = tmp_path_factory.mktemp("events")
    os.symlink(f"{DIR}/events.parquet", d / "events.parquet")
    patch = pytest.MonkeyPatch()
    for name, n in (("IDS", 130), ("PART", 9), ("SPAN", 170)):
        patch.setattr(Q, name, n)
    yield str(d)
    patch.undo()


@pytest.mark.parametrize("name", NAMES)
def test_parts(spark, small, name):
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{small}/events.parquet'")
    got = con.execute(registry.ORACLES[name])
    names = [c[0] for c in got.description]
    want = sorted(tuple(told(v) for v in r) for r in got.fetchall())
    rows = registry.QUERIES[name](spark, small).collect()
    assert want and sorted(tuple(told(r[c]) for c in names) for r in rows) == want


@pytest.mark.parametrize(("name", "line", "most"), [("words", "<w |<vocalsound ", 9), ("acts", "<dact ", 9), ("links", "<summlink>", 1000), ("topics", "<topic ", 35), ("sentences", "<sentence ", 35)])
def test_files_are_bounded(spark, small, name, line, most):
    files = spark.read.option("wholetext", True).text(Q._written(spark.sparkContext.applicationId, spark, small, name)).collect()
    sizes = [len(re.findall(line, r["value"])) for r in files]
    assert len(files) > 25 and 0 < max(sizes) <= most


def test_links_against_all_pairs(spark):
    ids = [*range(-7, 90, 3), *range(380, 1300, 7), 399, 400, 401, 799, 800, 801]
    rows = [(u, i) for u in (1, 2) for i in ids if (i + u) % 4]
    got = Q.links_of(spark.createDataFrame(rows, "user_id long, x long"), spark.createDataFrame(rows, "user_id long, a long")).collect()
    rest = lambda n: abs(n) % 5 * (1 if n >= 0 else -1)
    assert sorted(map(tuple, got)) == sorted((u, x, a) for u, x in rows for v, a in rows if u == v and abs(a - x) < 400 and rest(a) == rest(x))
