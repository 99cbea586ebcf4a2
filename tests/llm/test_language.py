"""Character models against counting in plain dictionaries, ties, and what the rejection bound is taken over."""

import math
import re
import zlib
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from waymeter.llm import language
from waymeter.llm.queries import QUERIES
from waymeter.llm.shared import remainder

FOLDER = "/root/testdata/sf0.001"
ORDER, DISCOUNT = 4, 0.75


def framed(text):
    for word in re.findall(r"[^\W\d_]+", (text or "").lower()):
        word = word if word.isascii() else "".join(c for c in word if c.isalpha())
        if word:
            yield f" {word} "


class Characters:
    """Interpolated Kneser-Ney of one language. Counts below the highest order are of different characters before,
    but raw where the n-gram begins a word."""

    def __init__(self, texts):
        raw = Counter()
        for text in texts:
            for word in framed(text):
                raw.update(word[max(0, end - ORDER):end] for end in range(2, len(word) + 1))
        self.counts = {}
        level = Counter({g: n for g, n in raw.items() if len(g) == ORDER})
        for size in range(ORDER, 0, -1):
            self.counts[size] = level
            below = Counter()
            for gram in level:
                below[gram[1:]] += 1
            below.update({g: n for g, n in raw.items() if len(g) == size - 1})
            level = below
        self.after = {size: defaultdict(list) for size in self.counts}
        for size, counts in self.counts.items():
            for gram, n in counts.items():
                self.after[size][gram[:-1]].append(n)

    def probability(self, history, char):
        p = 1 / (len(self.counts[1]) + 1)
        for size in range(1, min(ORDER, len(history) + 1) + 1):
            h = history[len(history) - size + 1:]
            seen = self.after[size].get(h)
            if seen:
                total = sum(seen)
                p = max(self.counts[size][h + char] - DISCOUNT, 0) / total + DISCOUNT * len(seen) / total * p
        return p

    def bits(self, word, known={}):
        key = id(self), word
        if key not in known:
            known[key] = -sum(math.log2(self.probability(word[:k], word[k])) for k in range(1, len(word)))
        return known[key]


def test_predictions_and_scores_equal_counting(spark):
    docs = pq.read_table(f"{FOLDER}/documents.parquet").to_pydict()
    held = {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in docs["doc_id"]}
    texts = defaultdict(list)
    for i, t, lang in zip(docs["doc_id"], docs["text"], docs["lang"]):
        if not held[i] and lang is not None and t is not None:
            texts[lang].append(t)
    models = {lang: Characters(some) for lang, some in sorted(texts.items())}
    assert len(models) > 2
    found = {r.doc_id: r for r in QUERIES["op9_language_id"](spark, FOLDER).collect()}
    assert found.keys() == set(docs["doc_id"])
    for i, t in zip(docs["doc_id"], docs["text"]):
        words, row = list(framed(t)), found[i]
        assert row.held_out == held[i]
        if not words:
            assert (row.lang_pred, row.score, row.bits_per_char) == ("und", 0.0, None)
            continue
        size = sum(len(w) - 1 for w in words)
        per = {lang: sum(map(model.bits, words)) / size for lang, model in models.items()}
        best = min(per, key=per.get)
        assert row.lang_pred == best and row.bits_per_char == pytest.approx(per[best], rel=1e-9)
        assert row.score == pytest.approx(1 / sum(2 ** ((per[best] - p) * min(size, language.SHARP)) for p in per.values()), rel=1e-6)


def test_a_tie_takes_the_first_language_by_name(spark):
    same = "every word of it is the same"
    rows = spark.createDataFrame([(k, same, lang) for k, lang in enumerate(["zz", "mm", "aa", "zz", "mm", "aa"])] + [(9, "of it", None)],
                                 "doc_id long, text string, lang string")
    found = language.identified(rows.repartition(3), F.lit(True)).collect()
    assert {r.lang_pred for r in found} == {"aa"} and all(math.isclose(r.score, 1 / 3) for r in found)


def test_the_bound_is_that_of_training_texts(spark):
    """Rows without a lang teach nothing, so their letters do not widen what a language accepts."""
    plain = [(k, "the cat sat on the mat and the dog ran to the cat " * 3, "en") for k in range(40)]
    odd = [(100 + k, "qzxw vkqj xzqv wqxk jvzq " * 4, None) for k in range(40)]
    rows = spark.createDataFrame(plain + odd, "doc_id long, text string, lang string")
    found = {r.doc_id: r.rejected for r in language.identified(rows, remainder(F.col("doc_id"), 4) != 9).collect()}
    assert not any(found[k] for k, *_ in plain) and all(found[k] for k, *_ in odd)
