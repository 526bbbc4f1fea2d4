"""Expected fixture counts from FIXTURES.md."""

import pytest

from zonecast.operators import prep, split
from zonecast.sources.fixture import KEY_COLUMNS, pitch_view, pitch_view_from_lineitem

EXPECTED = {  # sf: rows, strikes labelled, balls labelled, strikes after cleaning, balls after cleaning
    "0.001": (6000, 1683, 3062, 1465, 2629),
    "0.01": (60000, 17195, 30735, 15215, 26692),
}


@pytest.mark.parametrize("sf", sorted(EXPECTED))
def test_counts(spark, sf):
    raw = pitch_view(spark, f"/root/testdata/sf{sf}")
    a = prep.label_audit(raw).first()
    clean = prep.basic_cleaning(prep.label_outcomes(raw))
    c = {r["is_strike"]: r["count"] for r in clean.groupBy("is_strike").count().collect()}
    assert (a["n_input"], a["n_strikes"], a["n_balls"], c[1], c[0]) == EXPECTED[sf]


def test_generated_methods_are_short_enough_to_be_compiled(spark):
    """HotSpot interprets methods of over 8,000 bytes for good, about ten times slower."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the plan is known before it runs
    try:
        raw = pitch_view_from_lineitem(spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet"))
        clean = prep.basic_cleaning(prep.label_outcomes(raw))
        for df in (clean, clean.select(split.split_hash(KEY_COLUMNS), "is_strike")):
            made = df._jdf.queryExecution().debug().codegenToSeq()
            sizes = [made.apply(i)._3().maxMethodCodeSize() for i in range(made.size())]
            assert sizes and max(sizes) <= 8000, sizes
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
