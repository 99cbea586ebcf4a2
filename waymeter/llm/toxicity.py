"""Toxicity by a learnt lexicon: Levenshtein automata of a text's words, intersected with a trie of the terms.

Terms (whole words and word beginnings) are those that labelled toxic texts hold far more often than others. A
word is looked up by walking the trie with the bit states of its automaton, so that misspelled terms are found
without listing them. Hits count by where they stand: between quotation marks or not, alone or with others in a
window of words. A logistic model on those counts gives the score; its weights are fitted on labelled texts that
the lexicon has not seen.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymeter.llm.shared import slices, worker_state, written
from waymeter.llm.words import mixed, word_hashes

#: Labelled rows that lexicon and weights are fitted on, at most; chosen by a hash of the id.
LABELLED = 16_384
#: A term stands in this share of toxic texts, in MIN_TEXTS at least, and with these log odds of toxic texts.
SHARE, MIN_TEXTS, LOG_ODDS = 0.01, 4, 2.0
STEM_MIN, STEM_MAX = 4, 10
EDITS, EDIT_LENGTH = 1, 5
WINDOW = 20
#: Words that a worker remembers, and terms that a task counts before it sends them on.
ENTRIES = 100_000
#: Copies: pairs of least hashes by which they are found, and the share of common windows from which a text is one.
BANDS, COPY = 6, 0.5
END = "$"
WORD = re.compile(r"[^\W\d_]+")
SPAN = re.compile(r"(?P<word>[^\W\d_]+)|(?P<open>[“«„])|(?P<close>[”»])|(?P<both>\")|(?P<line>\n)")
FEATURES = 7


def terms_of(text: str | None) -> set[str]:
    """Words, marked by END, and beginnings of words."""
    words = set(WORD.findall((text or "").lower()))
    return {w + END for w in words} | {w[:k] for w in words for k in range(STEM_MIN, min(STEM_MAX, len(w)) + 1)}


def chosen(found: list[tuple[str, int, int]], toxic: int, clean: int) -> dict[str, float]:
    """Terms with their log odds from (term, toxic texts, other texts): of a chain of beginnings the longest that
    holds nearly as many texts, and nothing longer that it covers as well."""
    odds = {t: math.log((a + 0.5) / (toxic + 1)) - math.log((b + 0.5) / (clean + 1)) for t, a, b in found}
    texts = {t: a for t, a, _ in found}
    longest = {}
    for term in sorted(texts, key=len):
        for parent in (term[:-1],):
            if parent in texts and texts[term] >= 0.9 * texts[parent]:
                longest[parent] = term
    kept: dict[str, float] = {}
    for term in sorted(texts, key=lambda t: (len(t), t)):
        if term in longest:
            continue
        if any(term[:k] in kept and kept[term[:k]] >= odds[term] - 0.5 for k in range(STEM_MIN, len(term))):
            continue
        kept[term] = odds[term]
    return kept


class Lexicon:
    """A trie of terms. `find` intersects it with the automaton of a word."""

    def __init__(self, terms: dict[str, float]):
        self.terms = terms
        self.root: dict = {}
        for term in terms:
            node = self.root
            for c in term.removesuffix(END):
                node = node.setdefault(c, {})
            node.setdefault("", []).append(term)
        # An edit leaves either a term's first two characters or its last three alone.
        self.heads = {t[:2] for t in terms}
        self.tails = {t[-4:-1] for t in terms if t.endswith(END) and len(t) > EDIT_LENGTH}

    def find(self, word: str) -> tuple[float, int] | None:
        """Log odds and edits of the best term: fewest edits, then highest odds. Beginnings match unedited."""
        if word[:2] not in self.heads and word[-3:] not in self.tails:
            return None
        size, full = len(word), (1 << (len(word) + 1)) - 1
        masks: dict[str, int] = {}
        for k, c in enumerate(word):
            masks[c] = masks.get(c, 0) | 1 << k
        edits = EDITS if size >= EDIT_LENGTH else 0
        # Bit j of states[e]: the path so far equals the word's first j characters after e edits.
        start = [1]
        for _ in range(edits):
            start.append(start[-1] | (start[-1] << 1) & full)
        best: tuple[int, float] | None = None
        todo = [(self.root, start)]
        while todo:
            node, states = todo.pop()
            for term in node.get("", ()):
                if not term.endswith(END):
                    hit = 0 if states[0] else None
                else:
                    hit = next((e for e, s in enumerate(states) if s >> size & 1 and (e == 0 or len(term) > EDIT_LENGTH)), None)
                if hit is not None and (best is None or (hit, -self.terms[term]) < best):
                    best = hit, -self.terms[term]
            for c, child in node.items():
                if c == "":
                    continue
                mask = masks.get(c, 0)
                after = [(states[0] & mask) << 1]
                for e in range(1, edits + 1):
                    after.append(((states[e] & mask) << 1 | states[e - 1] | states[e - 1] << 1 | after[e - 1] << 1) & full)
                if any(after):
                    todo.append((child, after))
        return None if best is None else (-best[1], best[0])


class _Known(dict):
    def __init__(self, lexicon: Lexicon):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str):
        made = self[word] = self.lexicon.find(word)
        return made


def _quoted(text: str) -> list[bool]:
    """Of every word, in order, whether it stands between quotation marks of its line. “ closes what „ opened."""
    out, opened, straight = [], [], False
    for found in SPAN.finditer(text):
        kind = found.lastgroup
        if kind == "word":
            out.append(straight or bool(opened))
        elif kind == "both":
            straight = not straight
        elif kind == "line":
            opened, straight = [], False
        elif kind == "open" and not (found.group() == "“" and opened and opened[-1] == "„"):
            opened.append(found.group())
        elif opened:
            opened.pop()
    return out


def features(text: str | None, known: _Known) -> list[float]:
    """Greatest log odds and number of exact hits, the same of misspelled ones, hits in quotation marks, hits
    per hundred words, most hits in a window; numbers by log(1 + n), hits in quotation marks apart."""
    lowered = (text or "").lower()
    words = WORD.findall(lowered)
    hits = [(k, m) for k, m in enumerate(map(known.__getitem__, words)) if m is not None]
    if not hits:
        return [0.0] * FEATURES
    marks = _quoted(lowered)
    exact = [m[0] for k, m in hits if not marks[k] and m[1] == 0]
    edited = [m[0] for k, m in hits if not marks[k] and m[1]]
    places = [k for k, _ in hits if not marks[k]]
    first, most = 0, 0
    for last, place in enumerate(places):
        while place - places[first] >= WINDOW:
            first += 1
        most = max(most, last - first + 1)
    return [
        max(exact, default=0.0), math.log1p(len(exact)), max(edited, default=0.0), math.log1p(len(edited)),
        math.log1p(len(hits) - len(places)), math.log1p(100 * len(places) / len(words)), math.log1p(most),
    ]


def fitted(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic weights (the constant last) by Newton's method."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    penalty = np.r_[np.full(x.shape[1] - 1, ridge), 1e-3]
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass(frozen=True)
class Model:
    terms: dict[str, float]
    weights: tuple[float, ...]


def _known(model: Model) -> _Known:
    """One per worker, and emptied when it holds ENTRIES words."""
    held = worker_state(("lexicon", *sorted(model.terms.items())), lambda: _Known(Lexicon(model.terms)))
    if len(held) > ENTRIES:
        held.clear()
    return held


def _least_hashes(marked: DataFrame, count: int) -> DataFrame:
    """The `count` rows of distinct doc_ids whose hashes are least. Of many rows those below a bound that leaves some
    more are ordered (fewer than `count` below it have odds of 1 to 10**9 and more), so that no task sorts what each of
    the others would send it."""
    total, span = marked.count(), 1 << 30
    if total > 2 * count:
        marked = marked.where(F.pmod(F.xxhash64("doc_id"), F.lit(span)) < int((1.2 * count + 6 * count**0.5 + 50) / total * span))
    return marked.orderBy(F.pmod(F.xxhash64("doc_id"), F.lit(span)), "doc_id").limit(count)


def _sketched(rows: DataFrame) -> DataFrame:
    """Adds `windows`, the distinct hashes of a text's windows of three words, and `bands`, pairs of least values of
    them under different hashes."""
    seeds, names = mixed(np.arange(1, 2 * BANDS + 1, dtype=np.uint64)), rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets, bands = [], []
            for body in batch.column(names.index("body")).to_pylist():
                words, _ = word_hashes([body])
                if words.size < 3:
                    words = np.r_[words, np.zeros(3 - words.size, np.uint64)]
                found = np.unique(mixed(words[:-2] ^ mixed(words[1:-1] ^ mixed(words[2:]))))
                least = np.array([mixed(found ^ s).min() for s in seeds])
                sets.append(found.view(np.int64))
                bands.append(mixed(least[::2] ^ mixed(least[1::2])).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sets, pa.list_(pa.int64())), pa.array(bands, pa.list_(pa.int64()))],
                [*names, "windows", "bands"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("windows", T.ArrayType(T.LongType())),
                                              T.StructField("bands", T.ArrayType(T.LongType()))]))


def distinct_texts(rows: DataFrame) -> DataFrame:
    """Of rows (id, toxic, body, weighs) one for every text and label, without near copies of a text of that label.

    A row goes if it shares COPY of its windows of three words, or more, with the first row of one of its bands; a
    shared phrase alone drops nothing. First is the least hash of id and text, so the answer is the same however the
    rows are dealt. The rows are those that LABELLED bounds.
    """
    first = F.min(F.struct(F.xxhash64("id", "body").alias("place"), "id", "weighs")).alias("first")
    rows = rows.groupBy("toxic", "body").agg(first).select("first.place", "first.id", "toxic", "body", "first.weighs")
    rows = written(_sketched(rows), "sketched")
    name, head = ["toxic", "place", "id"], F.min(F.struct("place", "id")).alias("head")
    banded = rows.select(*name, F.posexplode("bands").alias("number", "band"))
    heads = banded.groupBy("toxic", "number", "band").agg(head, F.count("*").alias("n")).where("n > 1")
    pairs = banded.join(heads, ["toxic", "number", "band"]).where(F.struct("place", "id") != F.col("head")).select(
        *name, F.col("head.place").alias("head_place"), F.col("head.id").alias("head_id")).distinct()
    # Only texts of such pairs move with their windows.
    sets = rows.select(*name, "windows")
    first = sets.select("toxic", F.col("place").alias("head_place"), F.col("id").alias("head_id"), F.col("windows").alias("others"))
    shared = F.size(F.array_intersect("windows", "others")) / F.size(F.array_union("windows", "others"))
    copies = pairs.join(sets, name).join(first, ["toxic", "head_place", "head_id"]).where(shared >= COPY).select(*name).distinct()
    return rows.drop("windows", "bands").join(copies, name, "left_anti")


def train(docs: DataFrame, labels: DataFrame, training: Column) -> Model:
    """From the texts of labelled rows of `training` (a condition on doc_id of `labels`).

    At most LABELLED labels are used, so what is broadcast (they) and collected (terms with a share of those
    texts, features of the texts) is bounded. Of copies among their texts one is used, see `distinct_texts`. A doc_id with several labels is toxic if one says so; null labels
    do not count. Without both kinds of text nothing is learnt and every score is 0.
    """
    marked = labels.where(training & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        (F.max("toxic") > 0).cast("int").alias("toxic"))
    some = _least_hashes(marked, LABELLED)
    texts = docs.select(F.col("doc_id").alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("body"))
    rows = texts.join(F.broadcast(some.withColumnRenamed("doc_id", "id")), "id").select(
        "id", "toxic", "body", (F.pmod(F.xxhash64(F.lit("part"), "id"), F.lit(3)) == 0).alias("weighs"))
    # Copies of a toxic text would make terms of all its words.
    rows = distinct_texts(rows).select("toxic", "body", "weighs")
    rows = written(rows, "labelled")
    sizes = {(r.weighs, r.toxic): r["count"] for r in rows.groupBy("weighs", "toxic").count().collect()}
    toxic, clean = sizes.get((False, 1), 0), sizes.get((False, 0), 0)
    if not toxic or not clean:
        return Model({}, (0.0,) * FEATURES + (-30.0,))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list[int]] = {}

        def rows_() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([
                pa.array(list(seen), pa.string()), pa.array([v[1] for v in seen.values()], pa.int64()), pa.array([v[0] for v in seen.values()], pa.int64()),
            ], ["term", "toxic", "clean"])
            seen.clear()
            return made

        for batch in batches:
            for label, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for term in terms_of(body):
                    seen.setdefault(term, [0, 0])[label] += 1
                if len(seen) > ENTRIES:
                    yield rows_()
        yield rows_()

    least = max(MIN_TEXTS, math.ceil(SHARE * toxic))
    counts = rows.where("NOT weighs").select("toxic", "body").mapInArrow(count, "term string, toxic long, clean long")
    counts = counts.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where(F.col("toxic") >= least)
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    found = counts.where(odds >= LOG_ODDS).orderBy("term").collect()
    terms = chosen([(r.term, r.toxic, r.clean) for r in found], toxic, clean)
    held = Model(terms, ())
    table = _scores(rows.where("weighs").select(F.col("toxic"), "body"), held, "toxic").collect()
    # In one order, so that sums of doubles do not hang on the order of tasks.
    table.sort(key=lambda r: (r.toxic, r.features))
    y = np.array([r.toxic for r in table], float)
    if not len(y) or y.min() == y.max():
        return Model({}, (0.0,) * FEATURES + (-30.0,))
    return Model(terms, tuple(fitted(np.array([list(r.features) for r in table]), y).tolist()))


def _scores(rows: DataFrame, model: Model, carried: str) -> DataFrame:
    """The column `carried` with `features` and `score` of the column `body`, row by row."""
    weights = np.array(model.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            known = _known(model)
            out = [features(t, known) for t in batch.column(1).to_pylist()]
            x = np.array(out).reshape(len(out), FEATURES)
            score = 1 / (1 + np.exp(-np.clip(np.c_[x, np.ones(len(x))] @ weights, -30, 30))) if len(weights) else np.zeros(len(x))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.float64())), pa.array(score)], [carried, "features", "score"])

    schema = T.StructType([rows.schema[carried]]).add("features", T.ArrayType(T.DoubleType())).add("score", "double")
    return rows.select(carried, "body").mapInArrow(run, schema)


def scored(docs: DataFrame, labels: DataFrame, training) -> DataFrame:
    """doc_id, held_out, score, predicted, one row per row; `training` makes the condition from a doc_id column.

    A null or empty text has no hit and the score of such texts. Repeated rows and null doc_ids stay, other
    columns than doc_id and text are not read, an empty table gives no rows.
    """
    model = train(docs, labels, training(F.col("doc_id")))
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("body"))
    return _scores(rows, model, "doc_id").select(
        "doc_id", (~training(F.col("doc_id"))).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def kept(docs: DataFrame, labels: DataFrame, training) -> DataFrame:
    """The rows of `docs` that are not predicted toxic, with all their columns."""
    model = train(docs, labels, training(F.col("doc_id")))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("body"))
    return _scores(rows, model, "row").where("score < 0.5").select("row.*")
