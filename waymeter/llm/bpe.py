"""BPE encoding by forced boundaries, and decoding.

A pair of neighbouring bytes that occurs inside no token of the vocabulary is a certain cut for the merges. Of
those pairs the ones count here that also end a word for every rule before the merges: the second byte is ASCII (an
ASCII character never joins an earlier one under normalisation), or a Latin letter after white space; one is white
space or punctuation and the other not, no apostrophe (contractions look past it). Each fragment is encoded on its own, once for many occurrences,
and the ids are concatenated. A vocabulary whose words begin with their space keeps space and word together.
"""

from __future__ import annotations

import json
import re
import struct
from functools import cached_property, lru_cache

import numpy as np
from tokenizers import Tokenizer

from waymeter.llm.fragments import ENTRIES, Remembered, numbers
from waymeter.llm.shared import worker_state

_TAIL = b".,;:!?%$*&#|"
_WHITE = b" \t\n\v\f\r"
#: The first byte of U+00C0 to U+00FF in UTF-8, all letters but two, and the second bytes of those two.
_LATIN, _NO_LETTER = 0xC3, [0x97, 0xB7]
_ODD_SPACE = re.compile(r"[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def byte_of() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the rest from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def inner_pairs(tokens: list[str], suffix: str) -> np.ndarray:
    """[a, b]: whether byte b follows byte a inside some token."""
    found, units_of = np.zeros((256, 256), bool), byte_of()
    for token in tokens:
        units = [units_of[c] for c in (token.removesuffix(suffix) if suffix else token) if c in units_of]
        found[units[:-1], units[1:]] = True
    return found


class _Ids:
    """The ids of a fragment, as little-endian unsigned 32-bit numbers.

    Most are a word of Latin letters, perhaps behind a space or before punctuation. Every rule before the merges
    leaves such a word whole, so the merges alone are run on it; any other fragment takes the whole way.
    """

    def __init__(self, tokenizer: Tokenizer, lowers: bool, drops_space: bool):
        self.whole, self.merges = tokenizer.encode, tokenizer.model.tokenize
        self.lowers, self.drops_space = lowers, drops_space
        self.unit = {b: c for c, b in byte_of().items()}
        self.tails: dict[bytes, list[int]] = {b"": []}

    def _merged(self, text: str) -> list[int]:
        return [token.id for token in self.merges(text)]

    def _spelled(self, data: bytes) -> str:
        return data.decode() if data.isascii() else "".join(map(self.unit.__getitem__, data))

    def _tail(self, data: bytes) -> list[int]:
        found = self.tails.get(data)
        if found is None:
            found = self._merged(data.decode())
            if len(self.tails) < 1000:
                self.tails[data] = found
        return found

    def _ids(self, fragment: bytes) -> list[int]:
        core = fragment if self.drops_space or fragment[:1] != b" " else fragment[1:]
        word = core if self.drops_space else core.rstrip(_TAIL)
        plain = word.isalpha()  # ASCII letters alone
        if not plain and not word.isascii():
            text = word.decode("utf-8", "surrogatepass")
            plain = text.isalpha() and max(text) < "\u0250" and "\u0130" not in text
            if plain and self.lowers:
                word = text.lower().encode()
        elif plain and self.lowers:
            word = word.lower()
        if not plain:
            return self.whole(fragment.decode("utf-8", "surrogatepass"), add_special_tokens=False).ids
        if self.drops_space:
            return self._merged(self._spelled(word))
        head = "\u0120" if len(core) < len(fragment) else ""
        return self._merged(head + self._spelled(word)) + self._tail(core[len(word):])

    def __call__(self, fragments: list[bytes]) -> list[bytes]:
        return [struct.pack(f"<{len(ids)}I", *ids) for ids in map(self._ids, fragments)]


class FragmentEncoder:
    """Encodes whole texts through fragments. With `plain`, strings of special tokens are text as any other."""

    def __init__(self, vocabulary: str, plain: bool = False, entries: int = ENTRIES):
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = plain
        with open(vocabulary, encoding="utf-8") as file:
            data = json.load(file)
        suffix = data["model"].get("end_of_word_suffix") or ""
        self.drops_space, self.lowers = bool(suffix), "Lowercase" in str(data.get("normalizer"))
        self.known = Remembered(_Ids(self.tokenizer, self.lowers, self.drops_space), entries)
        specials = [] if plain else [t["content"].encode() for t in data["added_tokens"]]
        self.specials = re.compile(b"(" + b"|".join(map(re.escape, specials)) + b")") if specials else None
        white, mark, word, solid = (np.zeros(256, bool) for _ in range(4))
        white[list(_WHITE)] = True
        solid[33:127] = True
        word[[b for b in range(128) if chr(b).isalnum()]] = True
        mark[[b for b in range(33, 127) if not word[b] and chr(b) != "'"]] = True
        later = np.arange(256) >> 6 == 2  # the last byte of a character beyond ASCII
        kinds = (solid | later)[:, None] & white[None]
        after_letter = np.zeros((256, 256), bool)
        if self.drops_space:
            lead = np.arange(256) == _LATIN
            kinds |= white[:, None] & (solid | lead)[None] | word[:, None] & mark[None]
            after_letter |= (later & ~np.isin(np.arange(256), _NO_LETTER))[:, None] & mark[None]
        free = ~inner_pairs(list(data["model"]["vocab"]), suffix)
        self.white = white
        self.cuts, self.letter_cuts = (kinds & free).ravel(), (after_letter & free).ravel()

    def _parts(self, text: str) -> list[tuple[bytes, bool]]:
        """Stretches of the text that are cut on their own, in order, and whether one stays whole; nearly always one."""
        data = text.encode("utf-8", "surrogatepass")
        if not self.drops_space:
            return [(data, _ODD_SPACE.search(text) is not None)]
        if self.specials and self.specials.search(data):  # a special token is a fragment of its own
            return [(p, k % 2 == 1) for k, p in enumerate(self.specials.split(data)) if p]
        return [(data.lower() if self.lowers and b"<|" not in data else data, False)]

    def encode_many(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in order, and how many each text has; null is the empty text."""
        stretches, sizes, uncut = [], [], []
        for text in texts:
            parts = self._parts(text) if text else []
            uncut += [len(stretches) + k for k, (_, solid) in enumerate(parts) if solid]
            stretches += [p for p, _ in parts]
            sizes.append(sum(len(p) for p, _ in parts))
        buffer, bounds = b"".join(stretches), np.cumsum([0, *map(len, stretches)])
        whole = np.frombuffer(buffer, np.uint8)
        if not whole.size:
            return np.empty(0, "<u4"), np.zeros(len(texts), np.int64)
        cut = np.zeros(whole.size, bool)
        pairs = whole[:-1].astype(np.uint16) << np.uint16(8) | whole[1:]
        cut[1:] = self.cuts[pairs]
        if self.drops_space:  # punctuation after the second byte of a Latin letter
            cut[2:] |= self.letter_cuts[pairs[1:]] & (whole[:-2] == _LATIN)
        for k in uncut:
            cut[bounds[k]:bounds[k + 1]] = False
        cut[bounds[:-1]] = True
        starts = np.flatnonzero(cut)
        ends = np.r_[starts[1:], whole.size]
        if self.drops_space:  # white space alone has no ids
            keep = ~self.white[whole[starts]] | (ends - starts > 1)
            starts, ends = starts[keep], ends[keep]
        ids, counts = numbers(buffer, starts, ends, self.known)
        upto = np.r_[0, np.cumsum(counts)]
        return ids, np.diff(upto[np.searchsorted(starts, np.cumsum([0, *sizes]))])


class Decoder:
    """Ids to text: the tokens joined by spaces where the vocabulary file names no decoder, else by its decoder."""

    def __init__(self, vocabulary: str):
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.plain = self.tokenizer.decoder is None
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.tokens = [self.tokenizer.id_to_token(k) or "" for k in range(size)]
        self.digits = [str(k) for k in range(size)]

    def decode(self, ids: list[int]) -> str:
        if not self.plain:
            return self.tokenizer.decode(ids, skip_special_tokens=False)
        return " ".join(map(self.tokens.__getitem__, ids))

    def decimal(self, ids: list[int]) -> str:
        return " ".join(map(self.digits.__getitem__, ids))


class _Kept:
    """A vocabulary's encoder, counter and decoder, made when first used."""

    def __init__(self, vocabulary: str):
        self.vocabulary = vocabulary

    @cached_property
    def encoder(self) -> FragmentEncoder:
        return FragmentEncoder(self.vocabulary)

    @cached_property
    def plain(self) -> FragmentEncoder:
        return FragmentEncoder(self.vocabulary, plain=True)

    @cached_property
    def decoder(self) -> Decoder:
        return Decoder(self.vocabulary)


def _kept(vocabulary: str) -> _Kept:
    return worker_state(("bpe", vocabulary), lambda: _Kept(vocabulary))


@lru_cache
def size(vocabulary: str) -> int:
    """How many ids the vocabulary has, those of special tokens too."""
    return Tokenizer.from_file(vocabulary).get_vocab_size(with_added_tokens=True)


# Fragments stay known across a worker's tasks.


def encode_many(vocabulary: str, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in order, as little-endian unsigned 32-bit numbers, and how many each text has; null is
    the empty text. Callers hand over texts of bounded size in all, see `portions`."""
    return _kept(vocabulary).encoder.encode_many(texts)


def encode_each(vocabulary: str, texts: list[str | None]) -> list[bytes]:
    ids, counts = encode_many(vocabulary, texts)
    data, ends = ids.tobytes(), (4 * np.cumsum(counts)).tolist()
    return [data[i:j] for i, j in zip([0, *ends], ends)]


def encode(vocabulary: str, text: str | None) -> bytes:
    return encode_many(vocabulary, [text])[0].tobytes()


def counts(vocabulary: str, texts: list[str | None]) -> list[int]:
    return encode_many(vocabulary, texts)[1].tolist()


def decoder(vocabulary: str) -> Decoder:
    return _kept(vocabulary).decoder
