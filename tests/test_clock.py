import pytest
from pyspark.sql import functions as F

from tests.fixtures import CLOCK
from tripgrid.functions import dep_time_24h, paste, to_number
from tripgrid.plans import with_clock, with_display


def test_golden_clock(spark):
    texts = spark.createDataFrame([(row[0],) for row in CLOCK], "departure string")
    columns = ["departure", "time", "meridian", "dep_time_24h", "departure_save"]
    found = with_display(with_clock(texts)).select(*columns).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(
        [(d, t and float(t) if t != 0 else 0.0, m, None if s is None else float(s), p) for d, t, m, s, p in CLOCK],
        key=repr,
    )


@pytest.mark.parametrize("time, meridian, expected", [
    (1200, "x", 2400), (1215, "a", 15), (1215, "x", 2415), (130, "x", 2530), (100, "p", 1300), (530, "a", 530),
])
def test_strict_midnight(spark, time, meridian, expected):
    clock = dep_time_24h(F.lit(float(time)), F.lit(meridian), strict_midnight=True)
    assert spark.range(1).select(clock).first()[0] == expected


def test_numbers(spark):
    texts = ["1", " 2.5 ", "-3", "1e2", ".5", "1d", "1f", "x", "", None, "NaN", "0x1A"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [r[0] for r in frame.coalesce(1).select(to_number(F.col("t"))).collect()]
    assert found == [1.0, 2.5, -3.0, 100.0, 0.5, None, None, None, None, None, None, None]


def test_missing_label_reads_na(spark):
    frame = spark.createDataFrame([("a", None), (None, "b"), (None, None)], "x string, y string")
    assert [r[0] for r in frame.coalesce(1).select(paste("x", "y")).collect()] == ["a - NA", "NA - b", "NA - NA"]
