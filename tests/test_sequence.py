"""The skew-safe neighbour operators equal plain per-key windows (brute force).

Data: events with a third of all rows moved onto one hot card.
"""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerwarden.functions.columns import time_bucket, within
from ledgerwarden.operators.sequence import BAND, GHOST, asof_carry, banded, neighbors
from conftest import SF_MID


@pytest.fixture(scope="module")
def skewed(spark):
    e = spark.read.parquet(f"{SF_MID}/events.parquet")
    card = F.when(F.col("event_id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("C"), F.col("user_id")))
    return e.select(card.alias("card"), F.col("ts"), F.col("event_id").cast("string").alias("id"),
                    F.col("event_type").alias("kind"))


@pytest.mark.parametrize("span,factor", [("1 hour", 1), ("1 hour", 6), ("20 minutes", 3), ("3 days", 2)])
def test_banded_lead_matches_plain(skewed, span, factor):
    w = Window.partitionBy("card").orderBy("ts", "id")
    plain = skewed.select("card", "ts", F.lead("ts").over(w).alias("nt"), F.lead("kind").over(w).alias("nk"))
    plain = plain.where(within("nt", "ts", span))
    aug = banded(skewed, "ts", span, "lead", factor)
    wb = Window.partitionBy("card", BAND).orderBy("ts", "id")
    mine = aug.select("card", "ts", GHOST, F.lead("ts").over(wb).alias("nt"), F.lead("kind").over(wb).alias("nk"))
    mine = mine.where(~F.col(GHOST) & within("nt", "ts", span)).drop(GHOST)
    assert sorted(plain.collect()) == sorted(mine.collect())


@pytest.mark.parametrize("span,factor", [("20 minutes", 1), ("20 minutes", 6), ("1 day", 2)])
def test_banded_lag3_matches_plain(skewed, span, factor):
    def lags(df, w):
        return [F.lag("ts", 3).over(w).alias("t3")] + [F.lag("kind", k).over(w).alias(f"k{k}") for k in (1, 2, 3)]
    w = Window.partitionBy("card").orderBy("ts", "id")
    plain = skewed.select("card", "ts", *lags(skewed, w)).where(within("ts", "t3", span))
    aug = banded(skewed, "ts", span, "lag", factor)
    wb = Window.partitionBy("card", BAND).orderBy("ts", "id")
    mine = aug.select("card", "ts", GHOST, *lags(aug, wb)).where(~F.col(GHOST) & within("ts", "t3", span))
    assert sorted(plain.collect()) == sorted(mine.drop(GHOST).collect())


@pytest.mark.parametrize("bucket", [3600.0, 86400.0 * 7])
def test_neighbors_match_lag_lead(skewed, bucket):
    w = Window.partitionBy("card").orderBy("ts", "id")
    plain = skewed.select("card", "id", F.lag("kind").over(w).alias("p"), F.lead("kind").over(w).alias("n"))
    bk = time_bucket("ts", skewed.schema["ts"].dataType, bucket)
    got = neighbors(skewed, ["card"], ["ts", "id"], ["kind"], bk, prev=True, nxt=True)
    mine = got.select("card", "id", F.col("_prev.kind").alias("p"), F.col("_next.kind").alias("n"))
    assert sorted(plain.collect()) == sorted(mine.collect())


def test_asof_carry_matches_range_join(skewed):
    versions = skewed.where(F.col("kind") == "purchase").select("card", F.col("ts").alias("vf"),
                                                                F.col("id").alias("vid"))
    probes = skewed.where(F.col("kind") == "view").select("card", F.col("id").alias("pid"), "ts")
    got = asof_carry(probes, versions, ["card"], "ts", "vf", ["vid"], [], 86400.0)
    mine = got.select("pid", F.col("_ver.vid").alias("vid"))
    cand = probes.join(versions, "card").where(F.col("vf") <= F.col("ts"))
    best = Window.partitionBy("pid").orderBy(F.col("vf").desc(), F.col("vid").desc())
    brute = cand.select("pid", "vid", F.row_number().over(best).alias("r")).where("r = 1").drop("r")
    nomatch = probes.join(brute, "pid", "left_anti").select("pid", F.lit(None).cast("string").alias("vid"))
    assert sorted(mine.collect()) == sorted(brute.unionByName(nomatch).collect())
