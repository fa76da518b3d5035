"""Importance resampling and license scan against brute force."""

import math
import random
import re
import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from bondscope.llm import licenses, quality


def brute_licenses(text, templates):
    """Names of the templates with enough shingles inside some window, by trying every window."""
    w = [x for x in re.split(r"[^a-z0-9\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
    names = set()
    for name, wanted in templates:
        t = [x for x in re.split(r"[^a-z0-9]+", wanted.lower()) if x]
        need = set(zip(t, t[1:]))
        length = max(licenses.LEAST_LENGTH, 2 ** math.ceil(math.log2(len(t))))
        pairs = list(zip(w, w[1:]))
        for at in range(-length, len(pairs), length):
            if len(need & set(pairs[max(0, at):at + 2 * length])) >= math.ceil(len(need) * licenses.CONTAINED):
                names.add(name)
    return ",".join(sorted(names))


def test_licenses_equal_every_window(spark):
    rng = random.Random(2)
    templates = [*licenses.STATEMENTS, *licenses.TAGGED]
    rows = []
    for i in range(120):
        filler = [rng.choice(["the", "of", "license", "under", "public", "word", "4", "0"]) for _ in range(rng.choice([3, 20, 200]))]
        at = rng.randrange(len(filler))
        mark = templates[i % len(templates)][1] if i % 3 else ""
        rows.append((i, " ".join(filler[:at] + [mark] + filler[at:]), 1))
    rows += [(200, "This work is licensed under the GNU General Public License, version 3.", 1), (201, None, 1), (202, "", 1),
             (203, "one", 1), (None, "Licensed under CC BY-NC 4.0.", 1), (None, "Licensed under CC BY-NC 4.0.", 1),
             (204, "x " * 60_000 + "Released under the MIT License.", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, license int")
    found = licenses.scanned(docs, spark.createDataFrame(templates, "license string, text string")).collect()
    assert sorted((str(r.doc_id), r.licenses) for r in found) == sorted(
        (str(i), brute_licenses(t, templates)) for i, t, _ in rows)
    assert next(r for r in found if r.doc_id == 200).licenses == "GPL-3.0"
    assert licenses.scanned(docs.limit(0), spark.createDataFrame(templates, "license string, text string")).count() == 0


def test_only_rows_of_the_ids_pass_the_filter(spark):
    rows = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text")).union(
        spark.sql("SELECT CAST(NULL AS bigint), 't'"))
    ids = spark.range(0, 9000, 7).select(F.col("id").alias("doc_id"))
    assert sorted(r.doc_id for r in quality.rows_of(rows, ids).collect()) == list(range(0, 5000, 7))
    assert quality.rows_of(rows, ids.limit(0)).count() == 0


def test_resampling_follows_the_ratio_and_the_seed(spark):
    rows = [(i, ("fine clear prose " if i % 2 else "junk spam noise ") * (1 + i % 9), 0) for i in range(600)]
    docs = spark.createDataFrame([*rows, (None, None, 0), (900, "", 0)], "doc_id long, text string, kept int")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(100)], "doc_id long, quality int, toxic int")
    one = {r.doc_id: r for r in quality.resampled(docs, labels).collect()}
    bags = {i: quality.bag(t) for i, t, _ in rows}
    raw = sum(bags.values())
    target = sum(bags[i] for i in range(1, 100, 2))
    for i in (0, 1, 17, 500):
        ratio = sum(n * (math.log((target[b] + 1) / (target.sum() + quality.BUCKETS)) - math.log((raw[b] + 1) / (raw.sum() + quality.BUCKETS)))
                    for b, n in enumerate(bags[i]) if n)
        assert abs(one[i].log_ratio - ratio) < 1e-6
    assert sum(one[i].kept for i in range(1, 600, 2)) > sum(one[i].kept for i in range(0, 600, 2))
    # Where all documents are good the ratios are nearly even, and the seed alone draws.
    every = docs.select("doc_id", F.lit(1).alias("quality"))
    first, second = ({r.doc_id for r in quality.resampled(docs, every, seed=n).where("kept").collect()} for n in (1, 2))
    assert len(first - second) > 50


def test_memory_of_weights_does_not_grow_with_the_batch():
    """1000 bags at once would take 80 MB."""
    texts = [f"some words {i}" for i in range(1000)] + [None]
    ratio = np.linspace(-1, 1, quality.BUCKETS)
    tracemalloc.start()
    found = quality.weights(texts, ratio)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 10_000_000
    assert list(found.grams) == [int(quality.bag(t).sum()) for t in texts]
    assert np.allclose(found.log_ratio, [quality.bag(t) @ ratio for t in texts])


def test_ids_meet_the_rows_behind_the_filter(spark, tmp_path):
    """The bit filter runs before the texts are shuffled, also where the ids are too many to broadcast."""
    spark.range(2000).selectExpr("id AS doc_id", "'some text' AS text").write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    ids = rows.select("doc_id").where("doc_id % 3 = 0")
    found = quality.rows_of(rows, ids.hint("merge"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]  # outermost first
    assert "LeftSemi" not in plan and "_block" not in joins[0] and "_block" in joins[1]
    assert sorted(r.doc_id for r in found.collect()) == list(range(0, 2000, 3))
