"""Queries on given tables, against SQL or brute force."""

import math
import zlib
from collections import Counter

import compare
import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from waymeter.llm import packing, toxicity, vectors
from waymeter.llm.queries import ORACLE, QUERIES, WORD_BPE

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    assert compare.differences(QUERIES[name](spark, FOLDER), compare.connect(FOLDER), ORACLE[name]) == []


def test_bigram_model_equals_counting(spark):
    docs = pq.read_table(f"{FOLDER}/documents.parquet").to_pydict()
    texts = {i: (t or "").encode().lower().split() + [None] for i, t in zip(docs["doc_id"], docs["text"])}
    training = [t for i, t in texts.items() if zlib.crc32(str(i).encode()) % 7 != 2]
    c, pairs = Counter(w for t in training for w in t), Counter(p for t in training for p in zip([None, *t], t))
    after = Counter(v for _, v in pairs)
    kinds = Counter((u, min(n, 3)) for (u, _), n in pairs.items())

    def discounts(t):
        y = t[1] / (t[1] + 2 * t[2])
        return [0, 1 - 2 * y * t[2] / t[1], 2 - 3 * y * t[3] / t[2], 3 - 4 * y * t[4] / t[3]]

    d, e = discounts(Counter(pairs.values())), discounts(Counter(after.values()))
    rest = sum(e[min(n, 3)] for n in after.values()) / len(pairs)

    def p(u, v):
        lower = max(after[v] - e[min(after[v], 3)], 0) / len(pairs) + rest / (len(c) + 1)
        if not c[u]:
            return lower
        n = pairs[u, v]
        return max(n - d[min(n, 3)], 0) / c[u] + sum(d[k] * kinds[u, k] for k in (1, 2, 3)) / c[u] * lower

    for row in QUERIES["op7_kneser_ney"](spark, FOLDER).collect():
        t = texts[row.doc_id]
        assert math.isclose(row.score, sum(math.log10(p(u, v)) for u, v in zip([None, *t], t)), rel_tol=1e-9)
        assert math.isclose(row.base_score, sum(math.log10((c[w] + 1) / (c.total() + len(c) + 1)) for w in t), rel_tol=1e-9)


def test_near_duplicates_equal_brute_force(spark):
    docs = pq.read_table(f"{FOLDER}/documents.parquet").to_pydict()
    sets = {}
    for i, t in zip(docs["doc_id"], docs["text"]):
        w = (t or "").encode().lower().split()
        sets[i] = Counter(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter()
    top = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and sets[a] and 5 * (sets[a] & sets[b]).total() >= 4 * (sets[a] | sets[b]).total():
                low, high = sorted((top[a], top[b]))
                top = {k: low if v == high else v for k, v in top.items()}
    assert {r.doc_id: r.class_id for r in QUERIES["op10_bagminhash"](spark, FOLDER).collect()} == top


def test_vector_links_equal_brute_force(spark):
    rows = pq.read_table(f"{FOLDER}/embeddings.parquet").to_pydict()
    v = np.array(rows["embedding"], float)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    links = dict(zip(rows["vec_id"], (v @ v.T >= 0.9).sum(1) - 1))
    found = {r.vec_id: r.n_links for r in QUERIES["op6_embedding_neardup"](spark, FOLDER).collect()}
    assert found.keys() == links.keys()
    assert sum(found.values()) >= 0.9 * sum(links.values()) and all(found[k] <= links[k] for k in links)


def test_split_trees_find_what_brute_force_finds(spark):
    v = np.array(pq.read_table("/root/testdata/sf0.1/embeddings.parquet")["embedding"].to_pylist(), float)
    draw = np.random.default_rng(2)
    near = [v[k] + draw.standard_normal((n, 64)) * 0.25 * np.linalg.norm(v[k]) / 8 for k, n in [(0, 600), *((k, 1) for k in range(1, 301))]]
    v = np.concatenate([v, *near])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    links = (v @ v.T >= 0.9).sum(1) - 1
    forest = vectors.Forest(leaf=24)
    assert all(len(t.cuts) > 20 for t in vectors.fitted(v, forest, len(v)))
    rows = spark.createDataFrame([(k, x) for k, x in enumerate(v.tolist())], "vec_id long, embedding array<double>")
    found = {r.vec_id: r.n_links for r in vectors.near_duplicates(rows, forest).collect()}
    assert found.keys() == set(range(len(v))) and all(found[k] <= links[k] for k in found)
    for part in (range(1, 2000), range(2000, 2600)):
        assert sum(found[k] for k in part) >= 0.9 * sum(links[k] for k in part) > 0


def test_pipeline_equals_brute_force(spark, monkeypatch):
    folder = FOLDER  # nothing in it is predicted toxic
    docs = pq.read_table(f"{folder}/documents.parquet").to_pydict()
    texts = dict(zip(docs["doc_id"], docs["text"]))
    models, train = [], toxicity.train
    monkeypatch.setattr(toxicity, "train", lambda *args: models.append(train(*args)) or models[-1])
    rows = corpus_pipeline.run(spark, folder).collect()
    judged = compare.connect(folder).sql(f"SELECT doc_id FROM ({ORACLE['op8_quality']}) WHERE kept").fetchall()
    left = [i for i, in judged]
    assert 0 < len(left) < len(texts)

    def edits(a, b):
        line = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            before, line = line, [i]
            for j, y in enumerate(b, 1):
                line.append(min(before[j] + 1, line[-1] + 1, before[j - 1] + (x != y)))
        return line[-1]

    class Plain(dict):
        def __missing__(self, word):
            hits = []
            for term, odds in models[0].terms.items():
                whole = term.removesuffix("$")
                if term == whole:
                    hits += [(0, -odds)] * word.startswith(term)
                elif abs(len(word) - len(whole)) <= 1:
                    n = edits(word, whole)
                    hits += [(n, -odds)] * (n == 0 or n == 1 and min(len(word), len(whole)) >= 5)
            self[word] = (-min(hits)[1], min(hits)[0]) if hits else None
            return self[word]

    known, weights = Plain(), models[0].weights
    assert len(models) == 1
    clean = [i for i in left if sum(x * w for x, w in zip([*toxicity.features(texts[i], known), 1], weights)) < 0]
    assert 0 < len(clean) <= len(left)
    words = {i: (texts[i] or "").encode().lower().split() for i in clean}
    sets = {i: Counter(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) for i, w in words.items()}
    top = {i: i for i in clean}
    for a in clean:
        for b in clean:
            if a < b and not sets[a].keys().isdisjoint(sets[b]) and 5 * (sets[a] & sets[b]).total() >= 4 * (sets[a] | sets[b]).total():
                low, high = sorted((top[a], top[b]))
                top = {k: low if v == high else v for k, v in top.items()}
    once = set(top.values())
    assert 0 < len(once) < len(clean)
    library, want = Tokenizer.from_file(public_tokenizers.path(WORD_BPE)), []
    for i in once:
        ids, start = [*library.encode(texts[i], add_special_tokens=False).ids, 2], 0
        while start < len(ids):
            length = min(4096, 1 << (len(ids) - start).bit_length() - 1)
            want.append((i, start, length, zlib.crc32(np.array(ids[start:start + length], "<u4").tobytes()), len(ids)))
            start += length
    assert sorted((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == sorted(want)


def test_a_file_holds_pieces_of_one_length(spark):
    found = QUERIES["op1_packing"](spark, FOLDER)
    files = found.groupBy(F.input_file_name().alias("file")).agg(F.count_distinct("length").alias("n"), F.min("bucket").alias("bucket")).collect()
    assert len(files) > 1 and all(r.n == 1 and f"/bucket={r.bucket}/" in r.file for r in files)
    flat = packing.pieces(spark.read.parquet(f"{FOLDER}/documents.parquet"), public_tokenizers.path(WORD_BPE), with_ids=False)
    assert found.dtypes == flat.dtypes
    assert sorted(map(str, found.collect())) == sorted(map(str, flat.collect()))


def test_a_bucket_read_back_is_decoded(spark, tmp_path):
    """The written pieces alone, in order of their starts, give every document's ids and with them its text."""
    rows = pq.read_table(f"{FOLDER}/documents.parquet").to_pydict()
    texts = dict(zip(rows["doc_id"], rows["text"]))
    packed = packing.pieces(spark.read.parquet(f"{FOLDER}/documents.parquet"), public_tokenizers.path(WORD_BPE), narrow=True)
    packing.write_buckets(packed, str(tmp_path / "buckets"))
    library, found = Tokenizer.from_file(public_tokenizers.path(WORD_BPE)), {}
    for bucket in sorted((tmp_path / "buckets").glob("bucket=*")):
        length = 1 << int(bucket.name.removeprefix("bucket="))
        for r in pq.read_table(bucket).to_pylist():
            ids = packing.ids_of(r["ids"], public_tokenizers.path(WORD_BPE)).tolist()
            assert len(ids) == r["length"] == length and zlib.crc32(np.array(ids, "<u4").tobytes()) == r["ids_crc32"]
            found.setdefault(r["doc_id"], {})[r["start"]] = ids
    assert found.keys() == texts.keys()
    for i, parts in found.items():
        ids = [x for start in sorted(parts) for x in parts[start]]
        assert ids[-1] == packing.END_ID and sorted(parts)[0] == 0
        assert ids[:-1] == library.encode(texts[i] or "", add_special_tokens=False).ids
        if (texts[i] or "").isascii():  # this vocabulary ends words with a mark, lowers them and drops white space
            back = library.decode(ids[:-1], skip_special_tokens=False).replace("</w>", "").replace(" ", "")
            assert back == "".join((texts[i] or "").lower().split())


def test_languages_are_told_apart_on_held_out_texts(spark):
    lang = dict(zip(*(pq.read_table(f"{FOLDER}/documents.parquet")[c].to_pylist() for c in ("doc_id", "lang"))))
    rows = [r for r in QUERIES["op9_language_id"](spark, FOLDER).collect() if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in rows) >= 0.95 * len(rows)


def test_toxic_texts_are_told_apart_on_held_out_texts(spark):
    folder = "/root/testdata/sf0.1"
    toxic = dict(zip(*(pq.read_table(f"{folder}/labels.parquet")[c].to_pylist() for c in ("doc_id", "toxic"))))
    rows = [r for r in QUERIES["op3_toxicity"](spark, folder).collect() if r.held_out and r.doc_id in toxic]
    assert sum(r.predicted == toxic[r.doc_id] for r in rows) >= 0.97 * len(rows)
