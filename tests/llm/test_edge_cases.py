"""Nulls, empty and long texts, ties, repeated rows, empty tables, extra columns with clashing names."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from waymeter.llm import bagminhash, encoding, kneser_ney, language, packing, quality, token_counts, toxicity, vectors, warc
from waymeter.llm.queries import BYTE_BPE, WORD_BPE, learns_toxicity
from waymeter.llm.shared import remainder

WORD, BYTE = public_tokenizers.path(WORD_BPE), public_tokenizers.path(BYTE_BPE)
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, row string, score double, kept string, "
          "words string, length long, body string, bands string, quality string")
PROSE = " ".join(f"word{k % 97} and then some{k}" for k in range(60))
TEXTS = [
    None, "", " \n\t ", "a", "b <|endoftext|> C'est l'été\n\nΣΑΣ  x", "Same line\nSame line\n" + PROSE, PROSE, PROSE,
    "you idiot " * 30, "x" * 5000, "w " * 20_000, "\u0001 § ½ 日本語 テキスト", PROSE + " end",
]


def table(spark, rows):
    extra = ("x",) + (0.5,) + ("y", "z") + (3,) + ("b", "s", "q")
    return spark.createDataFrame([(*row, *extra) for row in rows], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "en" if k % 2 else None, "s" if k % 3 else None, None) for k, t in enumerate(TEXTS)]
    return table(spark, [*rows, rows[6], (None, PROSE, None, None, None), (None, None, "de", "s", 4)]).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(k, 1, int(k == 8)) for k in range(13)] + [(8, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")


def operators(spark, docs, labels, tmp_path):
    return {
        "packing": packing.pieces(docs, WORD),
        "encoding": encoding.digests(docs, WORD),
        "counts": token_counts.token_counts(docs, BYTE, str(tmp_path / "cache")),
        "toxicity": toxicity.scored(docs, labels, learns_toxicity),
        "kneser_ney": kneser_ney.scored(docs, remainder(F.col("doc_id"), 7) != 2),
        "quality": quality.scored(docs),
        "language": language.identified(docs, remainder(F.col("doc_id"), 4) != 2),
        "near": bagminhash.near_duplicates(docs),
    }


def test_every_row_has_its_answer(spark, docs, labels, tmp_path):
    for name, frame in operators(spark, docs, labels, tmp_path).items():
        ids = sorted(str(r.doc_id) for r in frame.collect())
        want = sorted(str(r.doc_id) for r in docs.select("doc_id").collect())
        assert (sorted(set(ids)) == sorted(set(want))) if name == "packing" else ids == want, name


def test_empty_tables_give_no_rows(spark, docs, labels, tmp_path):
    for name, frame in operators(spark, docs.limit(0), labels.limit(0), tmp_path).items():
        assert frame.count() == 0, name
    assert warc.archived(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    assert vectors.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_ids_and_decoded_text_are_the_library_s(docs):
    library = Tokenizer.from_file(WORD)
    for row in encoding.digests(docs.where("doc_id IS NOT NULL"), WORD).collect():
        ids = library.encode(TEXTS[row.doc_id] or "", add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    some = docs.where("doc_id = 4")
    assert encoding.decode(encoding.encode(some, WORD), WORD).first().text == library.decode(library.encode(TEXTS[4]).ids, skip_special_tokens=False)


def test_pieces_hold_every_id_once(docs):
    library = Tokenizer.from_file(WORD)
    rows = packing.pieces(docs.where("doc_id <> 6 AND doc_id IS NOT NULL"), WORD).collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    for doc in {r.doc_id for r in rows}:
        mine = sorted((r for r in rows if r.doc_id == doc), key=lambda r: r.start)
        want = np.array([*library.encode(TEXTS[doc] or "", add_special_tokens=False).ids, 2], "<u4").tobytes()
        assert b"".join(bytes(r.ids) for r in mine) == want
        for r in mine:
            assert r.length & (r.length - 1) == 0 and r.length <= 4096 and r.offset == 0 and r.doc_tokens == len(want) // 4
            assert r.ids_crc32 == zlib.crc32(bytes(r.ids)) and r.length == 1 << r.bucket


def test_counts_are_the_library_s_and_a_second_run_encodes_nothing(spark, docs, tmp_path):
    library, cache = Tokenizer.from_file(BYTE), str(tmp_path / "counts")
    for _ in range(2):
        for row in token_counts.token_counts(docs.where("doc_id IS NOT NULL"), BYTE, cache).collect():
            text = TEXTS[row.doc_id] or ""
            assert row.n_tokens == len(library.encode(text, add_special_tokens=False).ids)
            assert row.n_bytes == len(text.encode()) and row.over_limit == (row.n_tokens > 512)
        assert spark.read.parquet(cache).count() == len({t or "" for t in TEXTS})


def test_exact_and_near_copies_share_a_class(docs):
    found = {(r.doc_id, r.class_id) for r in bagminhash.near_duplicates(docs).collect()}
    assert {(6, 5), (7, 5), (12, 5), (None, None), (0, 0), (1, 1), (2, 2)} <= found


def test_overlap_is_the_multisets():
    (a, m), (b, n) = bagminhash.shingle_sets([PROSE * 2, PROSE + " tail"])
    least = sum(min(int(x), dict(zip(b, n)).get(k, 0)) for k, x in zip(a, m))
    got = bagminhash.overlap((a.tobytes(), m.astype("<u4").tobytes()), (b.tobytes(), n.astype("<u4").tobytes()))
    assert got == (least, int(m.sum() + n.sum()) - least)


def test_registers_estimate_the_weighted_overlap():
    draw = np.random.default_rng(1)
    keys = np.unique(draw.integers(1, 1 << 63, 300).astype(np.uint64))
    m, n = draw.integers(1, 9, len(keys)), draw.integers(1, 9, len(keys))
    best = bagminhash.signatures([(keys, m), (keys, n)], 4096)
    assert abs((best[0] == best[1]).mean() - np.minimum(m, n).sum() / np.maximum(m, n).sum()) < 0.04


def test_blocks_find_what_pairs_find():
    draw = np.random.default_rng(3)
    base = draw.integers(1, 1 << 62, 40).astype(np.uint64)
    sets = [np.unique(np.r_[base[: 40 - k], draw.integers(1, 1 << 62, k).astype(np.uint64)]) for k in range(0, 20)]
    packed = [(s.tobytes(), np.ones(len(s), "<u4").tobytes()) for s in sets]
    names = [bytes([k]) for k in range(20)]
    links = bagminhash.links_between(names, names, packed)
    joined = {n: n for n in names}
    for a, b in links:
        old, new = joined[a], joined[b]
        joined = {k: new if v == old else v for k, v in joined.items()}
    for i in range(20):
        for j in range(i):
            least, most = bagminhash.overlap(packed[i], packed[j])
            if 5 * least >= 4 * most:
                assert joined[names[i]] == joined[names[j]]


def test_vectors_that_cannot_be_compared(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [nan, 1.0]), (5, [None, 1.0]), (6, [0.0, 1.0]), (7, [1.0]), (7, [1.0]), (None, [1.0, 0.0]), (8, [1e-30, 1e-31])]
    found = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert {(0, 2, 0, True), (1, 2, 0, False), (8, 2, 0, False), (2, 0, 2, True), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True), (None, 0, None, True)} <= found


def test_a_large_group_of_near_vectors_keeps_its_links(spark, monkeypatch):
    monkeypatch.setattr(vectors, "MEET", 256)
    draw = np.random.default_rng(11)
    v = draw.standard_normal((4000, 64))
    v[:1300] = v[0] + draw.standard_normal((1300, 64)) * 0.25 * np.linalg.norm(v[0]) / 8
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    links = (v @ v.T >= 0.9).sum(1) - 1
    assert 1_000_000 < links.sum() < 1300 * 1299
    rows = spark.createDataFrame([(k, x) for k, x in enumerate(v.tolist())], "vec_id long, embedding array<double>")
    found = {r.vec_id: r for r in vectors.near_duplicates(rows, vectors.Forest(leaf=32)).collect()}
    assert len(found) == 4000 and all(found[k].n_links <= links[k] for k in found)
    assert sum(r.n_links for r in found.values()) >= 0.999 * links.sum()
    assert all(found[k].component_id == 0 for k in range(1300) if links[k])


def test_archives_of_odd_pages(spark):
    html = "<p>é</p>" * 200
    rows = [(1, "http://a.example/x", html), (2, None, html), (2, None, html), (3, "https://www.B.example?q", None), (None, "http://a.example/x", html), (4, "bad [url\r\n", "short"), (5, "http://a.example/w", "short")]
    found = warc.archived(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    keys = [(r.urlkey, r.captured) for r in found]
    assert keys == sorted(keys) and len(found) == len(rows)
    assert {(r.page_id, r.record_type, r.refers_to) for r in found} == {
        (1, "revisit", 2), (2, "response", None), (3, "response", None), (None, "revisit", 2), (4, "response", None), (5, "response", None)}
    one = next(r for r in found if r.page_id == 1)
    assert one.payload_digest == hashlib.sha1(html.encode()).hexdigest() and one.payload_bytes == len(html.encode())


def test_loser_tree_merges_any_runs():
    draw = np.random.default_rng(5)
    for k in range(9):
        runs = [sorted([(str(x), "t", int(x), None, "", None, 0, "", f"a{r}", p) for p, x in enumerate(draw.integers(0, 9, draw.integers(1, 9)))], key=warc._order) for r in range(k)]
        assert list(warc.merged(runs)) == sorted((x for r in runs for x in r), key=warc._order)


def test_misspelled_terms_are_found_and_quoted_ones_told_apart():
    known = toxicity._Known(toxicity.Lexicon({"worthless$": 5.0, "scum$": 6.0, "lowei": 4.0}))
    assert known["worthless"] == (5.0, 0) and known["wortless"] == known["worthlesss"] == known["worthlezs"] == (5.0, 1)
    assert known["scun"] is None and known["loweiung"] == (4.0, 0) and known["losei"] is None
    assert toxicity.features('he said "scum" here', known)[4] > 0 == toxicity.features('he said "scum" here', known)[0]
    assert toxicity.features(None, known) == [0.0] * toxicity.FEATURES


def test_abuse_after_a_german_quotation_is_open():
    known = toxicity._Known(toxicity.Lexicon({"scum$": 6.0}))
    after = toxicity.features("Er sagte „hallo“ und du scum", known)
    assert after[0] == 6.0 and after[4] == 0
    inside = toxicity.features("Er sagte „du scum“ und ging", known)
    assert inside[0] == 0 < inside[4]
    assert toxicity._quoted("a “b” c „d“ e „f” g «h» i") == [False, True] * 4 + [False]


def test_letters_decide_the_language(spark):
    rows = [(k, ("the and of with thing " if k % 2 else "der und die nicht zeit ") * 9, "en" if k % 2 else "de", None, None) for k in range(40)]
    rows += [(100, "1234 ,,,", "en", None, None), (101, None, "de", None, None), (102, "with the thing", None, None, None), (103, "nicht die zeit", None, None, None)]
    found = {r.doc_id: r.lang_pred for r in language.identified(table(spark, rows), remainder(F.col("doc_id"), 4) != 2).collect()}
    assert found[100] == found[101] == "und" and found[102] == "en" and found[103] == "de"


def test_stages_keep_columns_and_one_copy(spark, docs, labels, tmp_path):
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    at = spark.read.parquet(f"{folder}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        after = stage(spark, at, folder)
        assert after.columns == docs.columns
        after.write.parquet(f"{folder}/stage{k}")
        at = spark.read.parquet(f"{folder}/stage{k}")
    assert sorted(str(r.doc_id) for r in at.collect()) in (["5", "None"], ["6", "None"])
    assert corpus_pipeline.STAGES[-1][1](spark, at, folder).count() > 0
    empty = docs.limit(0)
    assert all(stage(spark, empty, folder).count() == 0 for _, stage in corpus_pipeline.STAGES)
