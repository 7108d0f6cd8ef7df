"""As-of lookups for keys with very many versions: binary search in sorted arrays, against a plain range join."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerwarden.operators import owner

T0 = dt.datetime(2020, 1, 1)


def table(spark, counts):
    """Versions of each key, an hour each, with a gap after every seventh."""
    rows = [(k, T0 + dt.timedelta(hours=i), T0 + dt.timedelta(hours=i + 1 if i % 7 else i, minutes=0 if i % 7 else 30), f"{k}{i}", i)
            for k, n in counts.items() for i in range(n)]
    rows += [("a", T0, T0, "empty", -1), (None, T0, T0 + dt.timedelta(days=999), "no key", -2)]
    return spark.createDataFrame(rows, "k string, _valid_from timestamp_ntz, _valid_until timestamp_ntz, name string, n int")


@pytest.mark.parametrize("counts", [{"a": 3, "b": 16}, {"a": 40, "b": 1, "c": 200}, {"a": 1500, "b": 2, "c": 257, "d": 256}])
def test_equals_a_range_join(spark, counts):
    v = table(spark, counts)
    events = spark.range(6000).select(
        F.col("id"), F.element_at(F.array(*[F.lit(x) for x in [*counts, "zz", None]]), (F.col("id") % (len(counts) + 2) + 1).cast("int")).alias("k"),
        F.when(F.col("id") % 50 != 0, F.expr(
            "timestampadd(MINUTE, CAST(pmod(hash(id), 100000) - 60 AS INT), TIMESTAMP_NTZ'2020-01-01 00:00:00')")).alias("t"))
    got = owner.version_at(events, v, "k", "t", ["name", "n"])
    assert got.columns == ["id", "k", "t", "name", "n"]
    w = v.withColumnRenamed("k", "vk")
    want = events.join(w, (F.col("k") == F.col("vk")) & (F.col("_valid_from") <= F.col("t")) & (F.col("t") < F.col("_valid_until")))
    assert sorted(map(tuple, got.collect())) == sorted((r.id, r.k, r.t, r.name, r.n) for r in want.collect()) != []


def test_a_key_with_many_versions_forms_no_pairs(spark):
    """5,000 versions and 20,000 events of one key: no join row beyond the events, none of the residual kind."""
    v = table(spark, {"hot": 5000})
    events = spark.range(20_000).select("id", F.lit("hot").alias("k"), F.expr(
        "timestampadd(MINUTE, CAST(id * 15 AS INT), TIMESTAMP_NTZ'2020-01-01 00:30:00')").alias("t"))
    got = owner.version_at(events, v, "k", "t", ["n"])
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    joins = [x for x in plan.split("\n") if "Join" in x]
    assert len(joins) == 2 and not any("_valid" in x for x in joins)
    assert all((r.t - T0) // dt.timedelta(hours=1) == r.n for r in got.collect()) and got.count() > 17_000


def hot_log(spark, n=9000):
    """A third of the rows are one key's, on one day; the others are spread over keys and a year."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 97).cast("string")).alias("k"),
        F.pmod(F.hash("id"), F.lit(3)).cast("string").alias("a"), F.col("id").alias("n"),
        F.when(F.col("id") % 3 == 0, F.expr("timestampadd(SECOND, CAST(id * 9 AS INT), TIMESTAMP_NTZ'2024-03-05 00:00:00')"))
        .otherwise(F.expr("timestampadd(MINUTE, CAST(pmod(hash(id, 5), 500000) AS INT), TIMESTAMP_NTZ'2024-01-01 00:00:00')")).alias("t"))


def test_a_hot_day_of_one_key_is_split_and_rows_stay(spark, monkeypatch):
    from ledgerwarden.operators import scd2, sequence
    log = hot_log(spark)

    def history():
        return scd2.scd2_from_log(log, ["k"], ["a"], "t", ["n"])

    def as_of():
        return scd2.scd2_as_of(log.select("k", "n", F.col("t").alias("at")), whole, ["k"], "at", ["a"])

    whole = history().cache()
    want, looked = sorted(map(str, whole.collect())), sorted(map(str, as_of().collect()))
    monkeypatch.setattr(sequence, "HOT_ROWS", 200)
    monkeypatch.setattr(sequence, "SAMPLE", 0.5)
    cells = sequence.hot_cells(log.select("k", F.lit(1).alias(sequence.BUCKET), F.expr("unix_micros(CAST(t AS TIMESTAMP))").alias("_us")), ["k"])
    points = {r.k: r["_points"] for r in cells.collect()}
    assert set(points) == {"hot"} and 12 <= len(points["hot"]) <= 63 and points["hot"] == sorted(points["hot"])
    split = sequence.split_cells(log.select("k", F.lit(1).alias(sequence.BUCKET), F.expr("unix_micros(CAST(t AS TIMESTAMP))").alias("_us")),
                                 cells, ["k"]).where("k = 'hot'").groupBy(sequence.BUCKET).count().collect()
    assert len(split) > 12 and max(r["count"] for r in split) < 400
    assert sorted(map(str, history().collect())) == want and sorted(map(str, as_of().collect())) == looked
    monkeypatch.setattr(sequence, "HOT_ROWS", 10 ** 9)
    assert sequence.hot_cells(log.select("k", F.lit(1).alias(sequence.BUCKET), F.lit(1).alias("_us")), ["k"]) is None
