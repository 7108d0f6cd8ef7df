"""Key filters of a fact's folders: which of them may hold a key of a batch.

Each folder of a fact written with unique keys has a blocked Bloom filter, a
table of 4 KB bitmaps: a key's hash chooses the bitmap, ``HASHES`` further
hashes the bits in it, about ``BITS_PER_KEY`` bits for each key. The smallest
and greatest key (by length, then text) are noted with it. A batch is tested
against the folders whose range it meets, by an equi-join on the bitmap; the
exact anti-join then reads only the folders that may hold one of its keys.
Everything is built and tested with SQL functions; only the names of folders
come to the driver.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwarden.operators.facts import append_unique
from ledgerwarden.plans.state import Manifest, Warehouse

FILTERS = "key_filters"
BITS_PER_KEY, HASHES, BITMAP_BITS = 32, 8, 32768


def _order(key: str):
    return F.struct(F.length(key).alias("n"), F.col(key).alias("k"))


def _places(key: str):
    return F.array(*[F.pmod(F.xxhash64(F.lit(i), key), F.lit(BITMAP_BITS)).cast("int") for i in range(1, HASHES + 1)])


def write_filter(wh: Warehouse, m: Manifest, name: str, schema, key: str = "trans_id") -> None:
    """The filter of the folder that this run appended to the fact ``name``; none where it appended nothing."""
    parts = [p for p in m.tables.get(name, {}).get("parts", []) if f"/{m.folder()}" in p]
    if not parts:
        return
    keys = wh._parts(parts, name, schema).select(key).where(F.col(key).isNotNull())
    told = keys.agg(F.count(F.lit(1)).alias("n"), F.min(_order(key)).alias("least"), F.max(_order(key)).alias("most")).first()
    if not told.n:
        m.tables.setdefault(FILTERS, {"parts": []})["parts"].append(json.dumps({"fact": parts[0], "bitmaps": 0}))
        return
    bitmaps = 1 << max(0, (told.n * BITS_PER_KEY // BITMAP_BITS).bit_length())
    path = f"{wh.root}/{FILTERS}/{m.folder()}-{name}"
    bits = (keys.select(F.pmod(F.xxhash64(key), F.lit(bitmaps)).alias("bitmap"), F.explode(_places(key)).alias("place"))
            .groupBy("bitmap").agg(F.bitmap_construct_agg(F.col("place").cast("long")).alias("bits")))
    bits.select(F.lit(parts[0]).alias("fact"), F.lit(bitmaps).cast("long").alias("bitmaps"), "bitmap", "bits").write.parquet(path)
    entry = {"fact": parts[0], "filter": path, "bitmaps": bitmaps, "least": list(told.least), "most": list(told.most)}
    t = m.tables.setdefault(FILTERS, {"parts": []})
    t["parts"] = t.get("parts", []) + [json.dumps(entry, sort_keys=True)]


def folders_with(wh: Warehouse, m: Manifest, name: str, batch: DataFrame, key: str = "trans_id") -> list[str]:
    """Folders of the fact that may hold a key of the batch; folders without a filter always may."""
    parts = m.tables.get(name, {}).get("parts", [])
    entries = {e["fact"]: e for e in map(json.loads, m.tables.get(FILTERS, {}).get("parts", []))}
    keys = batch.select(key).where(F.col(key).isNotNull())
    told = keys.agg(F.min(_order(key)).alias("least"), F.max(_order(key)).alias("most")).first()
    if told.least is None:
        return []
    least, most = list(told.least), list(told.most)
    known = [entries[p] for p in parts if p in entries]
    near = [e for e in known if e["bitmaps"] and not (_before(e["most"], least) or _before(most, e["least"]))]
    hit = set()
    if near:
        bits = wh.spark.read.schema("fact string, bitmaps long, bitmap long, bits binary").parquet(*[e["filter"] for e in near])
        sizes = F.array(*[F.lit(s).cast("long") for s in sorted({e["bitmaps"] for e in near})])
        asked = (keys.distinct().select(F.xxhash64(key).alias("h"), _places(key).alias("places"), F.explode(sizes).alias("bitmaps"))
                 .withColumn("bitmap", F.pmod("h", "bitmaps")))
        held = ("forall(places, p -> shiftright(CAST(conv(hex(substring(bits, p div 8 + 1, 1)), 16, 10) AS INT), p % 8) & 1 = 1)")
        hit = {r.fact for r in asked.join(bits, ["bitmaps", "bitmap"]).where(F.expr(held)).select("fact").distinct().collect()}
    return [p for p in parts if p not in entries or p in hit]


def _before(a: list, b: list) -> bool:
    """Key order: by length, then text (compared as UTF-8)."""
    return (a[0], a[1].encode()) < (b[0], b[1].encode())


def append_unseen(wh: Warehouse, m: Manifest, name: str, schema, batch: DataFrame, key: str = "trans_id") -> DataFrame:
    """``append_unique`` against the folders that may hold a key of the batch."""
    folders = folders_with(wh, m, name, batch, key)
    return append_unique(wh._parts(folders, name, schema), batch, key)
