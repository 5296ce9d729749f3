"""Categories by rank, and the sharding query's sizes and checksums, against plain versions."""

import zlib

import pytest
from pyspark.sql import functions as F

from docsieve.llm import shards

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("n", [1, 2, 20, 200, 256, 257, 3000])
def test_cells_are_scaled_ranks(spark, n):
    values = sorted(f"https://src{i}" for i in range(n))
    hot = [values[n // 2]] * 500
    df = spark.createDataFrame([(v,) for v in [*values, *hot, None]], "s string").repartition(5)
    want = {v: i * 256 // n for i, v in enumerate(values)} | {None: 0}
    got = {r.s: r.c for r in shards.bucketed(df, "s", "c").distinct().collect()}
    assert got == want
    plan = shards.bucketed(df, "s", "c")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange hash" not in plan


def test_cells_of_no_values(spark):
    df = spark.createDataFrame([(None,), (None,)], "s string")
    assert {r.c for r in shards.bucketed(df, "s", "c").collect()} == {0}
    assert shards.bucketed(df.limit(0), "s", "c").collect() == []


def test_query_against_plain(spark):
    docs = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    rows = shards.op6(spark, SF).collect()
    assert {(r.doc_id, r["size"], r.text_crc32) for r in rows} == {(d, len(t) + 1, zlib.crc32(t)) for d, t in docs.items()} and len(rows) == len(docs)
    per = {}
    for r in rows:
        per.setdefault(r.shard, []).append(r.slot)
    assert set(per) == set(range(16)) and all(sorted(v) == list(range(len(v))) for v in per.values())
    assert max(map(len, per.values())) - min(map(len, per.values())) <= 1


def test_scratch_copy_goes(spark, tmp_path):
    import os

    df = spark.createDataFrame([(i, f"text {i}", "en", f"s{i % 3}") for i in range(50)], "doc_id long, text string, lang string, source string")
    manifest = shards.write_shards(df, str(tmp_path / "s"), shards=4)
    root = shards.materialise(spark.range(1), "where")._docsieve_path.rsplit("/", 1)[0].removeprefix("file://")
    assert not [d for d in os.listdir(root) if "hilbert" in d or "categories" in d]
    assert manifest.agg(F.sum("rows")).first()[0] == 50
