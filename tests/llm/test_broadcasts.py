"""What Spark may broadcast: it sizes exploded rows and compressed tables too low, the driver must not gather them."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lakeops.llm import common, decontaminate, exact_dedup, simhash
from lakeops.llm.common import written


def broadcasts(df):
    """The plan below each broadcast of a run of ``df``, as text."""
    df.collect()
    lines = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    found = []
    for at, line in enumerate(lines):
        if "BroadcastExchange" in line:
            below = next((k for k in range(at + 1, len(lines)) if depth(lines[k]) <= depth(line)), len(lines))
            found.append("\n".join(lines[at:below]))
    return found


def stored_fps(spark):
    """Fingerprints in pairs two bits apart that share their lower half."""
    rows = spark.range(1000).select(F.explode(F.array(F.xxhash64("id"), F.xxhash64("id").bitwiseXOR(F.lit(3 << 40)))).alias("fp"))
    return written(rows, "test-fps")[0]


@pytest.mark.parametrize("heavy", [64, 1])
def test_segment_balls_are_not_broadcast(spark, heavy):
    links = simhash.hamming_links(stored_fps(spark), max_bits=2, heavy=heavy)
    assert not [plan for plan in broadcasts(links) if "Generate" in plan]
    assert links.select(F.least("a", "b"), F.greatest("a", "b")).distinct().count() >= 1000


@pytest.mark.parametrize("max_bits", [2, 3])
def test_whole_balls_are_not_broadcast(spark, max_bits):
    fps = stored_fps(spark).limit(40) if max_bits == 3 else stored_fps(spark)
    links = simhash._ball_links(written(fps, "test-fps")[0], max_bits)
    assert not [plan for plan in broadcasts(links) if "Generate" in plan]


def test_verdicts_of_exact_dedup_are_not_broadcast(spark):
    docs = spark.createDataFrame([(i, f"text {i % 7}") for i in range(40)], "doc_id long, text string")
    with exact_dedup.DigestIndex(spark) as index:
        verdict = exact_dedup.deduplicate(docs, index)
        assert broadcasts(verdict) == []
        assert verdict.where("kept").count() == 7 and verdict.count() == 40


def test_keys_over_the_bound_are_not_broadcast(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"some words that stand in number {i % 4}") for i in range(12)] * 2, "doc_id long, text string")
    docs, _ = written(docs, "test-docs")
    with exact_dedup.DigestIndex(spark) as index:
        few = exact_dedup.kept_documents(docs, index)
        assert broadcasts(few) and few.count() == 4
    monkeypatch.setattr(common, "BROADCAST_KEYS", 0)
    with exact_dedup.DigestIndex(spark) as index:
        kept = exact_dedup.kept_documents(docs, index)
        assert broadcasts(kept) == [] and kept.count() == 4
    near = simhash.one_per_group(docs)
    assert broadcasts(near) == [] and near.count() == 4


def test_seeds_of_texts_are_not_broadcast(spark):
    rnd = random.Random(3)
    hashes = [rnd.getrandbits(60) for _ in range(200)]
    texts = spark.range(400).select(F.sha2(F.col("id").cast("string"), 256).cast("binary").alias("digest"),
                                    F.array(*map(F.lit, hashes)).alias("hashes"))
    texts, _ = written(texts.coalesce(1), "test-texts")
    keys = [rnd.getrandbits(60) for _ in range(300)]
    seed_rows = spark.createDataFrame([(h, key, 204, pos) for key in keys for pos, h in enumerate(hashes)],
                                      "hash long, key long, size int, pos int")
    pairs = decontaminate.candidate_pairs(texts, seed_rows, 5, 0.5)
    assert not [plan for plan in broadcasts(pairs) if "Generate" in plan]
    assert pairs.count() == 400 * 300


def test_covered_runs_of_texts_are_not_broadcast(spark):
    item = "who was it that wrote this line on the old wall"
    docs = spark.createDataFrame([(i, f"{item} {i}") for i in range(30)] + [(99, "nothing of it")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    pairs = decontaminate.tiled_pairs(docs, benchmark)
    assert not [plan for plan in broadcasts(pairs) if "covered" in plan]
    assert pairs.count() == 30


def test_rows_of_op1_are_not_broadcast(spark):
    docs, _ = written(spark.range(500).selectExpr("id AS doc_id", "concat_ws(' ', 'some words of number', id % 50) AS text"), "test-docs")
    near = simhash.near_duplicates(docs)
    assert not [plan for plan in broadcasts(near) if re.search(r"Generate|FileScan parquet \[id#\d+L?,fp#", plan)]
    assert near.count() == 500 and near.select("component_id").distinct().count() <= 50
