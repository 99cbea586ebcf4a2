"""Top-k search against brute force and SQL, with small strips and parts so that every step takes place."""

import compare
import numpy as np
import pytest
from pyspark.sql import functions as F

from waymeter.llm import topk
from waymeter.llm.queries import ORACLE

SMALL = topk.Search(k=5, block=40, strip=100, part=8, step=3)


def asks():
    return F.col("vec_id") % 20 == 0

SCHEMA = "vec_id long, embedding array<double>, row string, strip long, score string"


def brute(rows, k):
    """(query_id, rank, vec_id, score) of rows (vec_id, vector), in Python's own integers."""
    whole = [(i, [int(np.floor(x * 64)) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for n, (i, v) in enumerate(whole):
        if i % 20 == 0:
            scores = sorted((-sum(x * y for x, y in zip(v, w)), j) for m, (j, w) in enumerate(whole) if m != n)
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(scores[:k], 1)]
    return sorted(out)


def searched(spark, rows, search=SMALL):
    frame = spark.createDataFrame([(i, v, "x", 7, "y") for i, v in rows], SCHEMA)
    return sorted(map(tuple, topk.top(frame, asks(), search).collect()))


def test_query_s_table_with_small_strips_equals_sql(spark):
    folder = "/root/testdata/sf0.1"
    found = topk.top(spark.read.parquet(f"{folder}/embeddings.parquet"), asks(), topk.Search(block=64, strip=300, part=16, step=7))
    assert compare.differences(found, compare.connect(folder), ORACLE["op11_topk"]) == []


@pytest.mark.parametrize("spread", [1.0, 1e5, 1e12])
def test_vectors_of_all_lengths(spark, spread):
    draw = np.random.default_rng(1)
    v = draw.standard_normal((420, 12)) * np.exp(draw.standard_normal((420, 1))) * np.r_[5.0, 3, np.ones(10)]
    v[100:180] = v[100]  # a third of what is near the top is one vector
    rows = [(k, (x * spread if spread < 1e12 or k % 7 else x * 1e-3).tolist()) for k, x in enumerate(v)]
    if spread == 1e12:
        with pytest.raises(Exception, match="int|long|Overflow"):
            searched(spark, rows)  # products beyond a long
    else:
        assert searched(spark, rows) == brute(rows, 5)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(None, [1.0, 2.0]), (0, None), (20, [1.0, None]), (40, [nan, 1.0]), (60, [1.0, -inf]), (80, []), (100, [0.0, 0.0]),
            (1, [1.0, 1.0]), (1, [1.0, 1.0]), (120, [1.0, 1.0]), (120, [1.0, 1.0]), (2, [-1.0, -0.001]), (3, [2.0]), (4, [1e-9, -1e-9, 3.0])]
    assert searched(spark, rows) == brute(rows, 5)
    assert searched(spark, rows[:6]) == [] == searched(spark, []) == searched(spark, [(7, [1.0]), (9, [1.0])])


def test_short_vectors_are_not_multiplied(spark, monkeypatch):
    """Rounds go from long to short, and later strips are never sent where they cannot reach the k-th score."""
    sent = []
    plain = topk.written
    monkeypatch.setattr(topk, "written", lambda df, label: sent.append(plain(df, label)) or sent[-1] if label == "cells" else plain(df, label))
    draw = np.random.default_rng(3)
    v = np.abs(draw.standard_normal((900, 4))) / (1 + np.arange(900))[:, None] * 100
    rows = [(k, x.tolist()) for k, x in enumerate(v)]
    assert searched(spark, rows) == brute(rows, 5)
    strips = {r.strip for df in sent for r in df.collect()}
    assert len(sent) == 4 and strips < set(range(9))
