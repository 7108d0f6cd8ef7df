"""Property test: banded neighbours equal plain windows on timestamps placed on
band edges and exactly one span apart (plus or minus one microsecond)."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerwarden.functions.columns import within
from ledgerwarden.operators.sequence import BAND, GHOST, banded

BASE = dt.datetime(2024, 1, 1)


@st.composite
def layouts(draw):
    span = draw(st.sampled_from([60, 3600]))
    factor = draw(st.sampled_from([1, 2, 6]))
    n = draw(st.integers(min_value=2, max_value=40))
    rows = []
    for i in range(n):
        k = draw(st.integers(min_value=0, max_value=4 * factor))      # half-span steps
        jitter = draw(st.sampled_from([-1, 0, 1]))                    # microseconds
        card = draw(st.sampled_from(["A", "B", "HOT", "HOT", "HOT"]))
        ts = BASE + dt.timedelta(seconds=k * span / 2, microseconds=jitter)
        rows.append((card, ts, f"{i:03d}"))
    return span, factor, rows


@settings(max_examples=12, deadline=None)
@given(layouts())
def test_banded_lead_and_lag3_match_plain(spark, layout):
    span, factor, rows = layout
    df = spark.createDataFrame(rows, "card string, ts timestamp_ntz, id string")
    span_txt = f"{span} seconds"
    w = Window.partitionBy("card").orderBy("ts", "id")
    plain_lead = df.select("id", F.lead("id").over(w).alias("nx"), F.lead("ts").over(w).alias("nt"), "ts") \
                   .where(within("nt", "ts", span_txt)).select("id", "nx")
    plain_lag = df.select("id", F.lag("id", 3).over(w).alias("p3"), F.lag("ts", 3).over(w).alias("t3"), "ts") \
                  .where(within("ts", "t3", span_txt)).select("id", "p3")
    wb = Window.partitionBy("card", BAND).orderBy("ts", "id")
    a = banded(df, "ts", span_txt, "lead", factor)
    band_lead = a.select("id", GHOST, F.lead("id").over(wb).alias("nx"), F.lead("ts").over(wb).alias("nt"), "ts") \
                 .where(~F.col(GHOST) & within("nt", "ts", span_txt)).select("id", "nx")
    b = banded(df, "ts", span_txt, "lag", factor)
    band_lag = b.select("id", GHOST, F.lag("id", 3).over(wb).alias("p3"), F.lag("ts", 3).over(wb).alias("t3"), "ts") \
                .where(~F.col(GHOST) & within("ts", "t3", span_txt)).select("id", "p3")
    assert sorted(plain_lead.collect()) == sorted(band_lead.collect())
    assert sorted(plain_lag.collect()) == sorted(band_lag.collect())
