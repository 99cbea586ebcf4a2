"""Near duplicates of texts and vectors where ids repeat, where candidates chain, and however rows are dealt."""

import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from waymeter.llm import bagminhash, vectors

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text):
    w = (text or "").encode().lower().split()
    return Counter(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter()


def components(texts):
    """Least id of each text's component, by comparing all pairs of (id, text)."""
    sets, top = [shingles(t) for _, t in texts], list(range(len(texts)))

    def root(k):
        while top[k] != k:
            k = top[k]
        return k

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 5 * (sets[i] & sets[j]).total() >= 4 * (sets[i] | sets[j]).total():
                top[max(root(i), root(j))] = min(root(i), root(j))
    groups = {}
    for k, (i, _) in enumerate(texts):
        groups.setdefault(root(k), []).append(i)
    return [min(groups[root(k)]) for k in range(len(texts))]


def test_chains_of_weak_candidates_are_not_one_product(spark, monkeypatch):
    """Neighbours share enough to meet in some bucket, never enough to be linked; the ends have nothing in common."""
    draw = random.Random(11)
    words = [f"w{draw.randrange(10**6)}" for _ in range(60 * 260)]
    texts = [(k, " ".join(words[60 * k // 2:60 * k // 2 + 66])) for k in range(240)]  # 36 of 66 words with the next
    texts += [(1000 + k, texts[5 * k][1] + " and more") for k in range(40)]
    monkeypatch.setattr(bagminhash, "BLOCK", 4)
    monkeypatch.setattr(bagminhash, "CENTRES", 0)  # all of it is left to the blocks
    tables = {}
    plain = bagminhash.written
    monkeypatch.setattr(bagminhash, "written", lambda df, label: tables.setdefault(label, plain(df, label)))
    rows = spark.createDataFrame([(i, t, None, None, 1) for i, t in texts], DOCUMENTS)
    found = {r.doc_id: r.class_id for r in bagminhash.near_duplicates(rows).collect()}
    assert found == {i: c for (i, _), c in zip(texts, components(texts))}
    in_bucket = [r.n for r in tables["apart"].groupBy("bucket").agg(F.count("*").alias("n")).collect()]
    classes = tables["apart"].select("class").distinct().count()
    assert classes > 100 and max(in_bucket) < 12
    # At most a product of blocks per bucket: far from all blocks of all classes with each other.
    meetings = tables["meetings"].count()
    assert meetings <= sum((n // 4 + 2) ** 2 for n in in_bucket) and tables["meetings"].select("bucket").distinct().count() <= len(in_bucket)


def test_rows_of_one_id(spark):
    draw = random.Random(12)
    text = [" ".join(f"w{draw.randrange(5000)}" for _ in range(80)) for _ in range(4)]
    rows = [
        (7, text[0], "en", "a", 1), (7, text[1], "en", "b", 2), (8, text[0] + " end", "en", "c", 3), (9, text[1] + " end", "de", "d", 4),
        (7, text[0], "de", "z", 9), (7, text[0], "en", "a", 1), (5, text[2], None, None, None), (None, text[2], "x", "y", 5), (None, text[2], "x", "y", 5),
        (3, "", "en", "s", 0), (3, None, "en", "s", 0), (4, " \n", "en", "s", 2), (6, text[0] + " and end", None, "q", 3),
    ]
    answers = []
    for parts in (1, 3, 7):
        frame = spark.createDataFrame(rows, DOCUMENTS).repartition(parts)
        answers.append(sorted(map(tuple, bagminhash.kept(frame).collect()), key=str))
    assert answers[0] == answers[1] == answers[2]
    left = [(r[0], r[1]) for r in answers[0]]
    # The group of the first text keeps its least id; that of the second text is another one.
    assert sorted(x for x in left if x[0] in (6, 7, 8, 9)) == sorted([(6, text[0] + " and end"), (7, text[1])])
    assert left.count((None, text[2])) == 2 and (5, text[2]) in left
    assert sum(i == 3 for i, _ in left) == 1 and (4, " \n") in left


def test_the_stage_keeps_one_row_of_each_group(spark):
    stage = dict(corpus_pipeline.STAGES)["minhash_near_dedup"]
    draw = random.Random(13)
    text = " ".join(f"w{draw.randrange(5000)}" for _ in range(60))
    rows = [(2, text, "en", "a", 1), (2, text, "de", "b", 2), (2, text + " x", "en", "c", 3)]
    for parts in (1, 4):
        made = stage(spark, spark.createDataFrame(rows, DOCUMENTS).repartition(parts), "").collect()
        assert len(made) == 1 and made[0].doc_id == 2


def test_links_of_vectors_that_share_an_id(spark):
    x, y = [1.0, 0.0, 0.0, 0.0], [0.0, 0.0, 1.0, 0.0]
    near_x, near_y = [1.0, 0.1, 0.0, 0.0], [0.0, 0.0, 1.0, 0.1]
    rows = [(7, x), (7, y), (8, near_x), (9, near_y), (5, [0.0, 0.05, 1.0, 0.1]), (7, x), (1, [0.0, 1.0, 0.0, 0.0])]
    frame = spark.createDataFrame([(*r, "a", 1.5, "b", 3, "k") for r in rows], "vec_id long, embedding array<double>, vec string, size double, class string, n long, key string")
    found = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in vectors.near_duplicates(frame.repartition(3)).collect())
    assert found == [(1, 0, 1, True), (5, 2, 5, True), (7, 2, 5, False), (7, 2, 7, True), (7, 2, 7, True), (8, 2, 7, False), (9, 2, 5, False)]


def test_vectors_equal_brute_force_with_random_ids(spark):
    draw = np.random.default_rng(14)
    base = draw.standard_normal((40, 16))
    v = np.concatenate([base, base[:25] + 0.1 * draw.standard_normal((25, 16)), base[:10]])
    ids = draw.integers(0, 30, len(v))
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    close = unit @ unit.T >= 0.9
    top = np.arange(len(v))
    for _ in range(len(v)):
        top = np.array([top[close[k]].min() for k in range(len(v))])
    want = sorted((int(ids[k]), int(close[k].sum()) - 1, int(ids[top == top[k]].min())) for k in range(len(v)))
    frame = spark.createDataFrame([(int(i), x) for i, x in zip(ids, v.tolist())], "vec_id long, embedding array<double>")
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in vectors.near_duplicates(frame.repartition(4)).collect()) == want
