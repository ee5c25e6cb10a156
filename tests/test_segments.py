import pytest
from pyspark.sql import functions as F

from clientlens.functions import segments


def _expected(r, f, m):
    if r >= 4 and f >= 4 and m >= 4:
        return "Champions"
    if f >= 4:
        return "Loyal"
    if r >= 4:
        return "Potential_Loyal" if f >= 2 else "New"
    if r <= 2:
        return "At_Risk" if f >= 3 else "Hibernating"
    return "Need_Attention"


def test_all_score_combinations(spark):
    grid = [(r, f, m) for r in range(1, 6) for f in range(1, 6) for m in range(1, 6)]
    df = spark.createDataFrame(grid, "r int, f int, m int").coalesce(1)
    got = df.select("r", "f", "m", segments.rfm_segment(F.col("r"), F.col("f"), F.col("m")))
    assert [tuple(x) for x in got.collect()] == [(*g, _expected(*g)) for g in grid]


def test_rank_of_unknown_segment(spark):
    df = spark.createDataFrame([("Champions",), ("Hibernating",), ("Odd",), (None,)], "s string")
    got = df.coalesce(1).select(segments.rfm_rank(F.col("s"))).collect()
    assert [r[0] for r in got] == [1, 7, 99, 99]


def test_rules_keep_unknowns_and_must_be_conditions(spark):
    df = spark.createDataFrame([(9, None), (9, "P"), (1, None)], "v int, seg string").coalesce(1)
    flagged = segments.with_rules(df, {"flag": "v > 5 AND seg IN ('P')"})
    assert [r["flag"] for r in flagged.collect()] == [None, True, False]
    with pytest.raises(ValueError, match="not a condition"):
        segments.with_rules(df, {"flag": "v + 1"})


@pytest.mark.parametrize(
    ("function", "values", "first_characters"),
    [
        (segments.age_band, [24, 25, 34, 64, 65, None], "122561"),
        (segments.tenure_band, [364, 365, 1094, 1095, 1825, None], "122341"),
        (segments.deposit_band, [0.0, -5.0, 5e7, 2e8, 5e8, 1e9], "012345"),
        (segments.utilisation_band, [0.0, 0.29, 0.3, 0.6, 0.9, None], "012344"),
        (segments.engagement_status, [None, 30, 31, 90, 91, 181], "C12234"),
        (segments.digital_persona, [0.8, 0.5, 0.1, 0.0, None], "DDHTT"),
    ],
)
def test_band_edges(spark, function, values, first_characters):
    rows = [(None if v is None else float(v),) for v in values]
    df = spark.createDataFrame(rows, "v double").coalesce(1)
    got = [r[0][0] for r in df.select(function(F.col("v"))).collect()]
    assert "".join(got) == first_characters
