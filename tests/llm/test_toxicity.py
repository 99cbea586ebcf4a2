"""The learnt model: the same however rows are dealt, from distinct texts, with terms and features as counted by hand."""

import math
import random
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from waymeter.llm import toxicity
from waymeter.llm.queries import learns_toxicity, table

FOLDER = "/root/testdata/sf0.1"


def words(body):
    return re.findall(r"[^\W\d_]+", body.lower())


def test_one_model_however_rows_are_dealt(spark):
    docs, labels = table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")
    models = [toxicity.train(docs.repartition(n), labels.repartition(n), learns_toxicity(F.col("doc_id"))) for n in (1, 7, 64)]
    assert models[0] == models[1] == models[2] and len(models[0].terms) > 20


def test_copies_go_and_shared_phrases_stay(spark):
    draw = random.Random(7)
    vocabulary = [f"w{k}" for k in range(3000)]
    plain = [" ".join(draw.choices(vocabulary, k=120)) for _ in range(40)]
    phrase = "all of these texts share one phrase of several words "
    rows = [(k, 0, phrase + t) for k, t in enumerate(plain)]
    near = [re.sub(r"^w\d+", "changed", t) for t in plain[:10]]  # one word of 120
    rows += [(100 + k, 0, phrase + t) for k, t in enumerate(near)]
    rows += [(200, 0, rows[3][2]), (200, 0, rows[3][2]), (201, 1, rows[3][2]), (300, 0, "two words"), (301, 0, ""), (302, 0, "")]
    frame = spark.createDataFrame([(*r, k % 3 == 0) for k, r in enumerate(rows)], "id long, toxic int, body string, weighs boolean")
    found = [{(r.toxic, r.body) for r in toxicity.distinct_texts(frame.repartition(n)).collect()} for n in (1, 5)]
    assert found[0] == found[1]
    left = {b for t, b in found[0] if t == 0}
    assert {"two words", ""} <= left and (1, rows[3][2]) in found[0]
    for k in range(40):
        copies = {rows[k][2]} | ({phrase + near[k]} if k < 10 else set())
        assert len(copies & left) == 1, k  # one of each group, none lost to the phrase
    assert len(left) == 42


def expected_terms(bodies):
    """(term, toxic texts, other texts) by counting, of rows (toxic, body)."""
    counts = {}
    for toxic, body in bodies:
        found = set()
        for w in words(body):
            found.add(w + "$")
            found |= {w[:k] for k in range(4, min(10, len(w)) + 1)}
        for term in found:
            counts.setdefault(term, [0, 0])[0 if toxic else 1] += 1
    return counts


def edits(a, b):
    line = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, line = line, [i]
        for j, y in enumerate(b, 1):
            line.append(min(before[j] + 1, line[-1] + 1, before[j - 1] + (x != y)))
    return line[-1]


class Plain(dict):
    """A word's best term by comparing it with every term: fewest edits, then highest odds."""

    def __init__(self, terms):
        super().__init__()
        self.terms = terms

    def __missing__(self, word):
        hits = []
        for term, odds in self.terms.items():
            whole = term.removesuffix("$")
            if term == whole:
                hits += [(0, -odds)] * word.startswith(term)
            elif abs(len(word) - len(whole)) <= 1:
                n = edits(word, whole)
                hits += [(n, -odds)] * (n == 0 or n == 1 and min(len(word), len(whole)) >= 5)
        self[word] = (-min(hits)[1], min(hits)[0]) if hits else None
        return self[word]


def expected_features(body, known):
    """By lines and words, without the operator's scanner; quotations in straight marks only."""
    every, quoted = [], []
    for line in body.lower().split("\n"):
        for k, part in enumerate(line.split('"')):
            found = words(part)
            every += found
            quoted += [k % 2 == 1] * len(found)
    hits = [(k, known[w]) for k, w in enumerate(every) if known[w]]
    open_ = [(k, h) for k, h in hits if not quoted[k]]
    if not hits:
        return [0.0] * 7
    exact, edited = [h[0] for _, h in open_ if h[1] == 0], [h[0] for _, h in open_ if h[1]]
    crowd = max((sum(0 <= p - k < 20 for p, _ in open_) for k, _ in open_), default=0)
    return [max(exact, default=0.0), math.log1p(len(exact)), max(edited, default=0.0), math.log1p(len(edited)),
            math.log1p(len(hits) - len(open_)), math.log1p(100 * len(open_) / len(every)), math.log1p(crowd)]


def test_terms_and_features_equal_counting(spark, monkeypatch):
    docs, labels = table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")
    kept = []
    plain = toxicity.distinct_texts
    monkeypatch.setattr(toxicity, "distinct_texts", lambda rows: kept.append(plain(rows).persist()) or kept[-1])
    model = toxicity.train(docs, labels, learns_toxicity(F.col("doc_id")))
    rows = [(r.toxic, r.body) for r in kept[0].where("NOT weighs").collect()]
    toxic, clean = sum(t for t, _ in rows), sum(1 - t for t, _ in rows)
    counts = expected_terms(rows)
    odds = {t: math.log((a + 0.5) / (toxic + 1)) - math.log((b + 0.5) / (clean + 1)) for t, (a, b) in counts.items()}
    least = max(toxicity.MIN_TEXTS, math.ceil(toxicity.SHARE * toxic))
    allowed = {t for t, (a, _) in counts.items() if a >= least and odds[t] >= toxicity.LOG_ODDS}
    assert set(model.terms) <= allowed and all(math.isclose(model.terms[t], odds[t]) for t in model.terms)
    # What is left out is said by a kept beginning of it, or by a longer term of nearly the same texts.
    for term in allowed - set(model.terms):
        assert any(term.startswith(k) for k in model.terms) or any(t.startswith(term.removesuffix("$")) for t in allowed if t != term)
    known, checked = Plain(model.terms), 0
    held = toxicity._Known(toxicity.Lexicon(model.terms))
    for body in pq.read_table(f"{FOLDER}/documents.parquet")["text"].to_pylist()[:400]:
        if body and not set(body) & set("“”«»„"):
            assert toxicity.features(body, held) == pytest.approx(expected_features(body, known))
            checked += any(expected_features(body, known))
    assert checked > 10


def test_fewer_labels_than_all_are_those_of_least_hash(spark):
    marked = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit(1).alias("toxic"))
    order = marked.orderBy(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)), "doc_id")
    for count in (10, 300, 4000, 9000):
        want = {r.doc_id for r in order.limit(count).collect()}
        assert {r.doc_id for r in toxicity._least_hashes(marked.repartition(3), count).collect()} == want


def test_the_pipeline_drops_planted_toxic_rows(spark):
    """Rows that hold strong terms of the table's own toxic texts, in no quotation, go; the same texts without stay."""
    docs, labels = table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")
    model = toxicity.train(docs, labels, learns_toxicity(F.col("doc_id")))
    strong = [t.removesuffix("$") for t in sorted(model.terms, key=model.terms.get) if t.endswith("$")][-4:]
    clean = [r.text for r in docs.join(labels.where("toxic = 0"), "doc_id").where("length(text) BETWEEN 400 AND 2000").orderBy("doc_id").limit(20).collect()]
    score = toxicity.scored(spark.createDataFrame([(k, t) for k, t in enumerate(clean)], "doc_id long, text string").unionByName(
        docs.select("doc_id", "text").where("false")), labels, learns_toxicity)
    assert score.count() == 20
    planted = [f"{strong[k % 4]} {strong[(k + 1) % 4]} you {strong[(k + 2) % 4]}. {t}" for k, t in enumerate(clean)]
    rows = [(10_000_000 + 2 * k + n, text) for k, pair in enumerate(zip(clean, planted)) for n, text in enumerate(pair)]
    extra = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    stage = dict(corpus_pipeline.STAGES)["toxicity"]
    left = {r.doc_id for r in stage(spark, docs.unionByName(extra.select(docs.columns)), FOLDER).where("doc_id >= 10000000").collect()}
    gone = {i for i, _ in rows} - left
    assert gone == {i for i, _ in rows if i % 2}
