"""Language identification by interpolated Kneser-Ney character models, one per language.

A word is its letters in lower case between two spaces; its characters are predicted from the ORDER - 1 before
them, within the word. Spark counts the n-grams of every language; the models lie in arrays sorted by n-gram
hash, mapped by the workers. A text takes the language whose model needs the fewest bits per character, and is
rejected where it needs more than nearly all training texts of that language do.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymeter.llm import shared
from waymeter.llm.words import mixed

ORDER = 4
DISCOUNT = 0.75
ENTRIES = 400_000
WORDS = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"
#: Share of a language's training texts that its rejection bound accepts, and the slack beyond it.
ACCEPTED, SLACK = 0.999, 1.1
BITS = 4


def letters(word: str) -> str:
    return word if word.isascii() else "".join(c for c in word if c.isalpha())


def words_of(text: str | None) -> list[str]:
    return WORDS.findall((text or "").lower())


def gram_hashes(codes: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the `length` characters that end at each place (the first length - 1 places are not theirs)."""
    h = np.full(len(codes), length, np.uint64)
    for back in range(length - 1, -1, -1):
        moved = np.r_[np.zeros(back, np.uint64), codes[: len(codes) - back]]
        h = mixed(h ^ (moved + np.uint64(1)))
    return h


@dataclass(frozen=True)
class Model:
    """Languages in ascending order, and for every kind of table its files by shard. Kind 2k holds, for n-grams
    of k + 1 characters, their discounted share; kind 2k + 1, for histories of k characters, the weight left."""

    languages: list[str]
    files: dict[tuple[int, int], tuple[str, str]]
    kinds: dict[str, int]


def _gram_counts(rows: DataFrame) -> DataFrame:
    """lang, gram, n: how often each n-gram of ORDER characters occurs, of fewer at the start of words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}

        def grams() -> pa.RecordBatch:
            out: dict[tuple[str, str], int] = {}
            for lang, words in seen.items():
                for word, n in words.items():
                    framed = f" {letters(word)} "
                    for end in range(2, len(framed) + 1 if len(framed) > 2 else 0):
                        key = lang, framed[max(0, end - ORDER):end]
                        out[key] = out.get(key, 0) + n
            seen.clear()
            return pa.RecordBatch.from_arrays([
                pa.array([k[0] for k in out], pa.string()), pa.array([k[1] for k in out], pa.string()), pa.array(list(out.values()), pa.int64()),
            ], ["lang", "gram", "n"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen.setdefault(lang, Counter()).update(words_of(text))
            if sum(map(len, seen.values())) > ENTRIES:
                yield grams()
        yield grams()

    return rows.mapInArrow(count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def train(rows: DataFrame) -> Model:
    """From rows of lang, text. The driver gets the languages and the files' names."""
    folder = shared.worker_folder(rows.sparkSession, "languages")
    top = shared.written(_gram_counts(rows), "grams")
    # Counts of an order below: the raw count where the gram starts a word, else the different characters before it.
    tables, level = [], top.withColumn("size", F.length("gram"))
    for size in range(ORDER, 0, -1):
        here = level.where(F.col("size") == size)
        history = F.substring("gram", 1, size - 1)
        weights = here.groupBy("lang", history.alias("gram")).agg(F.sum("n").alias("c"), F.count("*").alias("types"))
        shares = here.withColumn("h", history).join(weights.select("lang", F.col("gram").alias("h"), "c"), ["lang", "h"])
        d = F.lit(DISCOUNT)
        tables += [
            shares.select("lang", "gram", F.lit(2 * size - 2).alias("kind"), (F.greatest(F.col("n") - d, F.lit(0.0)) / F.col("c")).alias("value")),
            weights.select("lang", "gram", F.lit(2 * size - 1).alias("kind"), (d * F.col("types") / F.col("c")).alias("value")),
        ]
        if size > 1:
            lower = here.groupBy("lang", F.substring("gram", 2, size - 1).alias("gram")).agg(F.count("*").alias("n"))
            starts = level.where(F.col("size") == size - 1).select("lang", "gram", "n")
            level = lower.unionByName(starts).groupBy("lang", "gram").agg(F.sum("n").alias("n")).withColumn("size", F.lit(size - 1))
            if size > 2:
                level = level.unionByName(top.withColumn("size", F.length("gram")).where(F.col("size") < size - 1))
    every = tables[0]
    for one in tables[1:]:
        every = every.unionByName(one)
    every = shared.written(every, "gram-weights")
    languages = sorted(r[0] for r in every.select("lang").distinct().collect())
    place = {lang: k for k, lang in enumerate(languages)}

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = np.empty(batch.num_rows, np.uint64)
            for k, gram in enumerate(batch.column(1).to_pylist()):
                codes = np.frombuffer(gram.encode("utf-32-le"), "<u4").astype(np.uint64)
                hashes[k] = gram_hashes(codes, len(gram))[-1] if len(gram) else 0
            shard = (hashes >> np.uint64(64 - BITS)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), pa.array(shard), pa.array(hashes.view(np.int64)), batch.column(0), batch.column(3)],
                ["kind", "shard", "hash", "lang", "value"],
            )

    def keep(names: tuple, group: pa.Table) -> pa.Table:
        kind, shard = (n.as_py() for n in names)
        hashes = group["hash"].to_numpy().astype(np.int64).view(np.uint64)
        keys, row = np.unique(hashes, return_inverse=True)
        values = np.zeros((len(keys), len(languages)), "<f8")
        values[row, [place[x] for x in group["lang"].to_pylist()]] = group["value"].to_numpy()
        return pa.table({"kind": [kind], "shard": [shard], "keys": [shared.store_array(folder, "keys", keys.astype("<u8"))], "values": [shared.store_array(folder, "values", values)]})

    done = shared.written(
        every.select("lang", "gram", "kind", "value").mapInArrow(key, "kind int, shard long, hash long, lang string, value double")
        .groupBy("kind", "shard").applyInArrow(keep, "kind long, shard long, keys string, values string"),
        "language-files",
    ).collect()
    kinds = {r.lang: r.n for r in every.where("kind = 0").groupBy("lang").agg(F.count("*").alias("n")).collect()}
    return Model(languages, {(r.kind, r.shard): (r.keys, r["values"]) for r in done}, kinds)


class Opened:
    """The model as one worker sees it, and the words it has scored, by number."""

    def __init__(self, model: Model):
        self.model = model
        n = len(model.languages)
        self.files = {k: (shared.mapped_array(a, "<u8"), shared.mapped_array(b, "<f8").reshape(-1, n)) for k, (a, b) in model.files.items()}
        self.unseen = np.array([1 / (model.kinds[x] + 1) for x in model.languages])
        self.numbers: dict[str, int] = {}
        self.bits = np.empty((0, n))
        self.sizes = np.empty(0, np.int64)

    def _values(self, kind: int, hashes: np.ndarray) -> np.ndarray:
        distinct, back = np.unique(hashes, return_inverse=True)
        out = np.zeros((len(distinct), len(self.model.languages)))
        edges = np.searchsorted(distinct >> np.uint64(64 - BITS), np.arange((1 << BITS) + 1, dtype=np.uint64))
        for shard in np.flatnonzero(np.diff(edges)):
            keys, values = self.files.get((kind, int(shard)), (np.empty(0, np.uint64), None))
            if len(keys):
                some = distinct[edges[shard]:edges[shard + 1]]
                at = np.minimum(np.searchsorted(keys, some), len(keys) - 1)
                hit = np.flatnonzero(keys[at] == some)
                out[edges[shard] + hit] = values[at[hit]]
        return out[back]

    def learn(self, words: list[str]) -> None:
        """Bits of each new word in every language, and its number of characters with the space after it."""
        spelt = [letters(w) for w in words]
        sizes = np.array([len(w) + 1 if w else 0 for w in spelt], np.int64)
        text = "".join(f" {w} " for w in spelt)
        codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
        begins = np.cumsum([0, *(len(w) + 2 for w in spelt[:-1])]) if spelt else np.empty(0, np.int64)
        within = np.arange(len(codes)) - np.repeat(begins, [len(w) + 2 for w in spelt])
        probability = np.tile(self.unseen, (len(codes), 1))
        for size in range(1, ORDER + 1):
            fits = np.flatnonzero(within >= max(1, size - 1))
            share = self._values(2 * size - 2, gram_hashes(codes, size)[fits])
            if size == 1:
                weight = self._values(1, np.zeros(len(fits), np.uint64))
            else:
                weight = self._values(2 * size - 1, np.r_[np.uint64(0), gram_hashes(codes, size - 1)[:-1]][fits])
            # A history never seen leaves the whole weight to the shorter one.
            probability[fits] = share + np.where(weight > 0, weight, 1.0) * probability[fits]
        cost = np.where((within > 0)[:, None], -np.log2(probability), 0.0)
        spaces = np.r_[np.zeros((1, cost.shape[1])), np.cumsum(cost, axis=0)]
        made = spaces[begins + [len(w) + 2 for w in spelt]] - spaces[begins] if spelt else np.empty((0, cost.shape[1]))
        made[sizes == 0] = 0.0
        base = len(self.numbers)
        self.numbers.update({w: base + k for k, w in enumerate(words)})
        self.bits = np.r_[self.bits, made]
        self.sizes = np.r_[self.sizes, sizes]

    def read(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Bits of each text in every language, and its number of characters."""
        if len(self.numbers) > ENTRIES:
            self.numbers, self.bits, self.sizes = {}, self.bits[:0], self.sizes[:0]
        found = [words_of(t) for t in texts]
        new = sorted(set().union(*found).difference(self.numbers)) if found else []
        for at in range(0, len(new), 50_000):
            self.learn(new[at:at + 50_000])
        bits, sizes = np.zeros((len(texts), len(self.model.languages))), np.zeros(len(texts), np.int64)
        for k, words in enumerate(found):
            if words:
                at = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
                bits[k], sizes[k] = self.bits[at].sum(0), self.sizes[at].sum()
        return bits, sizes


def opened(model: Model) -> Opened:
    return shared.worker_state(pickle.dumps(model), lambda: Opened(model))


def identified(docs: DataFrame, training: Column) -> DataFrame:
    """doc_id, held_out, lang_pred, score, bits_per_char, rejected, one row per row.

    Models are learnt from rows of `training` whose text and lang are not null. lang_pred is `und` where the text
    is null or has no letter, or where nothing was learnt; a tie takes the first language by name. score is the
    share of the language among the languages' likelihoods per character, sharpened by SHARP characters.
    `rejected` marks letters that fit no language: more bits per character than SLACK times the bound that holds
    ACCEPTED of the training texts of the predicted language. Repeated rows and null doc_ids stay, other columns
    are not read, an empty table gives no rows.
    """
    rows = docs.select("doc_id", (~training).alias("held_out"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    learns = ~F.col("held_out") & F.col("lang").isNotNull() & F.col("text").isNotNull()
    model = train(rows.where(learns).select("lang", "text"))
    names = model.languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = opened(model)
        for batch in shared.text_slices(batches, 2):
            texts = batch.column(2).to_pylist()
            pred, score, cost = [UNKNOWN] * len(texts), np.zeros(len(texts)), [None] * len(texts)
            for a in range(0, len(texts) if names else 0, 500):
                bits, sizes = look.read(texts[a:a + 500])
                for k in np.flatnonzero(sizes):
                    per = bits[k] / sizes[k]
                    best = int(np.argmin(per))
                    pred[a + k], cost[a + k] = names[best], float(per[best])
                    score[a + k] = 1 / np.exp2((per[best] - per) * min(int(sizes[k]), SHARP)).sum()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(pred, pa.string()), pa.array(score), pa.array(cost, pa.float64()), batch.column(3)],
                ["doc_id", "held_out", "lang_pred", "score", "bits_per_char", "learnt"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    read = shared.written(
        rows.select("doc_id", "held_out", "text", learns.alias("learnt")).mapInArrow(
            run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, bits_per_char double, learnt boolean"),
        "languages-read",
    )
    # One row per language: as many as the model has.
    bound = read.where("learnt AND bits_per_char IS NOT NULL").groupBy("lang_pred").agg(
        (F.percentile_approx("bits_per_char", ACCEPTED, 10_000) * SLACK).alias("bound"))
    over = F.create_map(*(x for r in bound.collect() for x in (F.lit(r.lang_pred), F.lit(r.bound)))) if names else None
    rejected = F.coalesce(F.col("bits_per_char") > over[F.col("lang_pred")], F.lit(True)) if names else F.lit(True)
    return read.drop("learnt").withColumn("rejected", rejected)


#: Characters of evidence that a score counts at most.
SHARP = 40
