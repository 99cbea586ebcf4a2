"""Interpolated modified Kneser-Ney bigram model, counted by Spark, kept in sorted arrays, mapped by workers.

The vocabulary is an array of 64-bit word hashes in ascending order, cut into shards by the leading bits; a
word's number is its place in it. Bigrams are pairs of numbers, in arrays sorted within shards by a hash of the
pair, so that no word's followers meet in one task. Tasks count what they read in numpy and send a few
compressed runs of ascending numbers to each shard; the shards' tasks merge them into files of the model.

An occurrence of word v after word u has the probability
    max(c(uv) - D(c(uv)), 0) / c(u.)  +  (D1 n1(u.) + D2 n2(u.) + D3 n3(u.)) / c(u.) * P(v),
    P(v) = max(n(.v) - D'(n(.v)), 0) / n(..)  +  (D1' t1 + D2' t2 + D3' t3) / n(..) / (V + 1),
with Chen and Goodman's discounts from the counts of counts, one for one, two and three or more. Every text is
framed by an end token, which is also the word before the first; V + 1 leaves room for one unknown word, so the
probabilities after any word sum to one.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymeter.llm import shared
from waymeter.llm.words import mixed, word_hashes

END = np.uint64(0x5851F42D4C957F2D)
FLUSH = 1_500_000
#: Bytes of texts that are read at once.
PORTION = 4 << 20
BLOBS = "shard long, keys binary, counts binary"


@dataclass(frozen=True)
class Discounts:
    one: float
    two: float
    more: float

    @classmethod
    def of(cls, t1: int, t2: int, t3: int, t4: int) -> Discounts:
        """From the numbers of entries that occur once to four times; 0.5, 1 and 1.5 where those are too few."""
        if not (t1 and t2 and t3 and t4):
            return cls(0.5, 1.0, 1.5)
        y = t1 / (t1 + 2 * t2)
        found = 1 - 2 * y * t2 / t1, 2 - 3 * y * t3 / t2, 3 - 4 * y * t4 / t3
        return cls(*(min(max(d, 0.01), k) for d, k in zip(found, (0.99, 1.99, 2.99))))

    def values(self, counts: np.ndarray) -> np.ndarray:
        return np.choose(np.minimum(counts, 3).astype(np.int64), (0.0, self.one, self.two, self.more))


@dataclass(frozen=True)
class Model:
    """What a worker needs to open the model: file names by shard and a few sums."""

    bits: int
    words: list[tuple[str, str]]
    starts: list[int]
    bigrams: list[tuple[str, str, str]]
    stats: list[str]
    tokens: int
    types: int
    pairs: int
    discounts: Discounts
    lower: Discounts
    lower_counts: tuple[int, int, int]


def framed(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every text's words, each text followed by END, and the texts' numbers of tokens with it."""
    hashes, counts = word_hashes(texts, lower=True)
    sizes = counts + 1
    ends = np.cumsum(sizes) - 1
    out = np.full(int(sizes.sum()), END, np.uint64)
    inside = np.ones(len(out), bool)
    inside[ends] = False
    out[inside] = hashes
    return out, sizes


def _by_shard(keys: np.ndarray, counts: np.ndarray, shard: np.ndarray, order: np.ndarray | None = None) -> Iterator[tuple]:
    """(shard, packed keys, packed counts) of ascending keys per shard."""
    order = np.argsort(shard, kind="stable") if order is None else order
    keys, counts, shard = keys[order], counts[order], shard[order]
    first = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]) if len(shard) else np.empty(0, np.int64)
    for a, b in zip(first, np.r_[first[1:], len(shard)]):
        yield int(shard[a]), shared.packed_sorted(keys[a:b]), shared.packed(counts[a:b])


def _blobs(parts: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*parts)) if parts else ([], [], [])
    kinds = (pa.int64(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["shard", "keys", "counts"])


def _counted(tokens: Iterator[np.ndarray], shard_of) -> Iterator[pa.RecordBatch]:
    """Distinct keys of a stream with their counts, sent on whenever FLUSH of them have gathered."""
    keys, counts, size = [], [], 0
    for some in tokens:
        found, number = np.unique(some, return_counts=True)
        keys.append(found)
        counts.append(number.astype(np.uint64))
        size += len(found)
        if size > 2 * FLUSH:
            keys, counts = ([x] for x in shared.summed(keys, counts))
            size = len(keys[0])
            if size > FLUSH:
                yield _blobs(list(_by_shard(keys[0], counts[0], shard_of(keys[0]))))
                keys, counts, size = [], [], 0
    found, number = shared.summed(keys, counts)
    if len(found):
        yield _blobs(list(_by_shard(found, number, shard_of(found))))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[list[str | None]]:
    for batch in batches:
        for piece in shared.text_slices([batch], batch.num_columns - 1, PORTION):
            yield piece.column(batch.num_columns - 1).to_pylist()


def _merged(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return shared.summed(
        [shared.unpacked_sorted(k) for k in group["keys"].to_pylist()],
        [shared.unpacked(c) for c in group["counts"].to_pylist()],
    )


def _top_bits(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)


def pair_order(codes: np.ndarray) -> np.ndarray:
    return mixed(codes ^ np.uint64(0xD1B54A32D192ED03))


class Opened:
    """The model's arrays as one worker sees them. Look-ups go through the shards in order, each opened when its turn
    comes, so a bounded number of files is open whatever the number of shards."""

    def __init__(self, model: Model):
        self.model, self.files = model, shared.MappedArrays()

    def _arrays(self, uris: tuple[str, ...], kinds: tuple[str, ...]) -> list[np.ndarray]:
        return [self.files.get(uri, kind) for uri, kind in zip(uris, kinds)]

    def _split(self, shards: np.ndarray) -> Iterator[tuple[int, slice]]:
        edges = np.searchsorted(shards, np.arange(len(self.model.words) + 1))
        for k in np.flatnonzero(np.diff(edges)):
            yield int(k), slice(edges[k], edges[k + 1])

    def numbers(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers (-1: unknown) and counts of ascending word hashes."""
        number, count = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        for k, part in self._split(_top_bits(hashes, self.model.bits)):
            keys, counts = self._arrays(self.model.words[k], ("<u8", "<u8"))
            if len(keys):
                at = np.minimum(np.searchsorted(keys, hashes[part]), len(keys) - 1)
                hit = keys[at] == hashes[part]
                number[part] = np.where(hit, at + self.model.starts[k], -1)
                count[part] = np.where(hit, counts[at], 0)
        return number, count

    def pairs(self, codes: np.ndarray) -> np.ndarray:
        """Counts of bigrams, 0 where unseen."""
        place = pair_order(codes)
        order = np.argsort(place)
        place, out = place[order], np.zeros(len(codes), np.int64)
        for k, part in self._split(_top_bits(place, self.model.bits)):
            keys, counts, large = self._arrays(self.model.bigrams[k], ("<u8", "u1", "<u8"))
            if len(keys):
                at = np.minimum(np.searchsorted(keys, place[part]), len(keys) - 1)
                found = np.where(keys[at] == place[part], counts[at], 0).astype(np.int64)
                over = np.flatnonzero(found == 255)
                if len(over):  # counts that need more than a byte lie beside, as (place, count)
                    places = large[0::2]
                    found[over] = large[1::2][np.searchsorted(places, at[over].astype(np.uint64))]
                out[order[part]] = found
        return out

    def rows(self, numbers: np.ndarray) -> np.ndarray:
        """The statistics (n1, n2, n3 as history; n as follower) of ascending numbers."""
        out = np.zeros((4, len(numbers)), np.int64)
        edges = np.searchsorted(numbers, [*self.model.starts, 1 << 62])
        for k in np.flatnonzero(np.diff(edges)):
            part = slice(edges[k], edges[k + 1])
            stats, = self._arrays((self.model.stats[k],), ("<u4",))
            out[:, part] = stats.reshape(4, -1)[:, numbers[part] - self.model.starts[k]]
        return out

    def scores(self, texts: list[str | None]) -> dict[str, np.ndarray]:
        m = self.model
        hashes, sizes = framed(texts)
        distinct, place = np.unique(hashes, return_inverse=True)
        number, count = self.numbers(distinct)
        known = number >= 0
        stats = np.zeros((4, len(distinct)), np.int64)
        order = np.argsort(number[known])
        stats[:, np.flatnonzero(known)[order]] = self.rows(number[known][order])
        total, room = max(1, m.pairs), m.types + 1
        t1, t2, t3 = m.lower_counts
        rest = (m.lower.one * t1 + m.lower.two * t2 + m.lower.more * t3) / total if m.pairs else 1.0
        lower = np.maximum(stats[3] - m.lower.values(stats[3]), 0) / total + rest / room
        # Every token but the last of a text has a follower, and the end token has the next text's first: c(u.) = c(u).
        c_u, free = count, np.ones(len(distinct))
        d = m.discounts
        np.divide(d.one * stats[0] + d.two * stats[1] + d.more * stats[2], c_u, out=free, where=c_u > 0)
        # The word before a text's first is the end token.
        end = int(np.searchsorted(distinct, END))
        before = np.r_[end, place[:-1]]
        firsts = np.cumsum(sizes) - sizes
        before[firsts] = end
        u, v = number[before], number[place]
        seen = (u >= 0) & (v >= 0)
        codes, back = np.unique((u[seen].astype(np.uint64) << np.uint64(32)) | v[seen].astype(np.uint64), return_inverse=True)
        pair = np.zeros(len(place), np.int64)
        pair[seen] = self.pairs(codes)[back]
        p = free[before] * lower[place]
        raised = np.flatnonzero(pair)
        p[raised] += (pair[raised] - d.values(pair[raised])) / c_u[before[raised]]
        base = np.log10((count + 1) / (m.tokens + m.types + 1))
        return {
            "n_tokens": sizes.astype(np.int64),
            "n_known": np.add.reduceat((count > 0)[place].astype(np.int64), firsts),
            "base_score": np.add.reduceat(base[place], firsts),
            "score": np.add.reduceat(np.log10(p), firsts),
        }


def opened(model: Model) -> Opened:
    return shared.worker_state(pickle.dumps(model), lambda: Opened(model))


def train(texts: DataFrame) -> Model:
    """Counts the model of the column `text`; the driver gets file names and sums, as many as there are shards.

    The number of shards follows the number of scan tasks, so each holds much the same at any size.
    """
    rows = texts.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    bits = shared.power_of_two(shared.scan_partitions(rows)).bit_length() - 1
    shards = 1 << bits
    folder = shared.worker_folder(texts.sparkSession, "kneser-ney")

    def count_words(batches):
        yield from _counted((framed(t)[0] for t in _texts(batches)), lambda keys: _top_bits(keys, bits))

    def keep_words(key, group):
        keys, counts = _merged(group)
        files = shared.store_array(folder, "words", keys.astype("<u8")), shared.store_array(folder, "counts", counts.astype("<u8"))
        return pa.table({"shard": [key[0].as_py()], "size": [len(keys)], "tokens": [int(counts.sum())], "keys": [files[0]], "counts": [files[1]]})

    found = shared.written(
        rows.mapInArrow(count_words, BLOBS).groupBy("shard").applyInArrow(
            keep_words, "shard long, size long, tokens long, keys string, counts string"),
        "word-shards",
    ).collect()
    by = {r.shard: r for r in found}
    empty = shared.store_array(folder, "none", np.empty(0, "<u8"))
    words = [(by[k].keys, by[k].counts) if k in by else (empty, empty) for k in range(shards)]
    sizes = [by[k].size if k in by else 0 for k in range(shards)]
    starts = np.cumsum([0, *sizes])
    types, tokens = int(starts[-1]), sum(r.tokens for r in found)
    if types >= 1 << 32:
        raise ValueError("pairs are kept as two 32-bit numbers: the vocabulary is too large for them")
    part = Model(bits, words, starts[:-1].tolist(), [], [], tokens, types, 0, Discounts(0, 0, 0), Discounts(0, 0, 0), (0, 0, 0))
    bounds = starts[1:]

    def count_pairs(batches):
        model = opened(part)

        def codes():
            for some in _texts(batches):
                hashes, size = framed(some)
                distinct, place = np.unique(hashes, return_inverse=True)
                number = model.numbers(distinct)[0].astype(np.uint64)
                end = number[np.searchsorted(distinct, END)]
                v = number[place]
                u = np.r_[end, v[:-1]]
                u[np.cumsum(size) - size] = end
                yield (u << np.uint64(32)) | v

        yield from _counted(codes(), lambda keys: _top_bits(pair_order(keys), bits))

    def numbered(kind, ids, counts):
        """Sums per word number, by the shard of the word."""
        ids, counts = shared.summed([ids], [counts])
        for shard, keys, number in _by_shard(ids, counts, np.searchsorted(bounds, ids, side="right")):
            yield shard, kind, keys, number, ""

    def keep_pairs(key, group):
        codes, counts = _merged(group)
        place = pair_order(codes)
        order = np.argsort(place)
        large = np.flatnonzero(counts[order] >= 255)
        files = (
            shared.store_array(folder, "pairs", place[order].astype("<u8")),
            shared.store_array(folder, "pair-counts", np.minimum(counts[order], 255).astype("u1")),
            shared.store_array(folder, "large", np.stack([large.astype(np.uint64), counts[order][large]], 1).ravel().astype("<u8")),
        )
        u, v, one = codes >> np.uint64(32), codes & np.uint64(0xFFFFFFFF), np.ones(len(codes), np.uint64)
        many = np.minimum(counts, 3)
        out = [*(x for k in (1, 2, 3) for x in numbered(k - 1, u[many == k], one[many == k])), *numbered(3, v, one)]
        sums = [len(codes), *(int((counts == k).sum()) for k in (1, 2, 3, 4))]
        # The file names travel with the sums of some shard of words, so the final table names this attempt's files.
        out.append((key[0].as_py(), 4, shared.packed(np.array(sums, np.uint64)), b"", "\n".join(files)))
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("shard", "kind", "keys", "counts", "files"), zip(*out), (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.string()))})

    def keep_stats(key, group):
        shard = key[0].as_py()
        stats = np.zeros((4, sizes[shard]), np.int64)
        for kind, keys, counts in zip(group["kind"].to_pylist(), group["keys"].to_pylist(), group["counts"].to_pylist()):
            if kind < 4:
                stats[kind, shared.unpacked_sorted(keys).astype(np.int64) - int(starts[shard])] += shared.unpacked(counts).astype(np.int64)
        named = [(f, shared.unpacked(k).tolist()) for kind, k, f in zip(group["kind"].to_pylist(), group["keys"].to_pylist(), group["files"].to_pylist()) if kind == 4]
        files, sums = named[0] if named else ("", [0] * 5)
        kinds = [int((stats[3] == k).sum()) for k in (1, 2, 3, 4)]
        return pa.table({"shard": [shard], "stats": [shared.store_array(folder, "stats", stats.astype("<u4"))], "files": [files], "sums": [sums], "kinds": [[*kinds, int((stats[3] >= 3).sum())]]})

    merged = rows.mapInArrow(count_pairs, BLOBS).groupBy("shard").applyInArrow(
        keep_pairs, "shard long, kind long, keys binary, counts binary, files string")
    done = shared.written(
        merged.groupBy("shard").applyInArrow(keep_stats, "shard long, stats string, files string, sums array<long>, kinds array<long>"),
        "pair-shards",
    ).collect()
    of = {r.shard: r for r in done}
    t = np.sum([r.sums for r in done], axis=0).astype(int).tolist() if done else [0] * 5
    k = np.sum([r.kinds for r in done], axis=0).astype(int).tolist() if done else [0] * 5
    return Model(
        bits, words, starts[:-1].tolist(),
        [tuple(of[s].files.split("\n")) if s in of and of[s].files else (empty,) * 3 for s in range(shards)],
        [of[s].stats if s in of else empty for s in range(shards)],
        tokens, types, t[0], Discounts.of(*t[1:]), Discounts.of(*k[:4]), (k[0], k[1], k[4]),
    )


def scored(docs: DataFrame, training: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 of the model's probability).

    `training` says which rows the model learns from. A null or empty text is the end token alone. Repeated
    rows and null doc_ids stay, other columns are not read, an empty table gives no rows; without any training
    token every probability is that of the one unknown word, 1.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), (~training).alias("held_out"))
    model = train(rows.where(~F.col("held_out")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = opened(model)
        for batch in shared.text_slices(batches, 2, PORTION):
            got = look.scores(batch.column(2).to_pylist())
            rest = pa.array([model.tokens] * batch.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(got["n_tokens"]), pa.array(got["n_known"]), rest,
                 pa.array(got["base_score"]), pa.array(got["score"])],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return rows.select("doc_id", "held_out", "text").mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, n_tokens long, n_known long, "
        "train_tokens long, base_score double, score double",
    )
