"""Ids of white-space separated words by a public tokenizer, each word encoded on its own.

The tokenizers this serves cut at white space before anything else, so the ids of a text are the ids
of its words in a row. That is what lets a word be encoded once and its ids be used everywhere.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Marks that end a word without being part of its last run of letters.
_TAIL = b".,;:!?)]}#*$%&\"-"
_LETTERS = frozenset(b"abcdefghijklmnopqrstuvwxyz")


def split_words(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case.

    The tokenizer lowers the case itself; doing it first makes words meet. Texts that may hold a
    special token's name keep their case, as upper-case spellings of it are ordinary text.
    """
    raw = text.encode()
    return raw.split() if b"<|" in raw else raw.lower().split()


def split_column(texts: pa.Array) -> pa.ListArray:
    """``split_words`` of a column of texts, null as empty; an empty word may stand at either end of a list."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    return pc.ascii_split_whitespace(pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts)))


def load_tokenizer(json_text: str):
    """The tokenizer with truncation and padding off."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(json_text)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class WordEncoder:
    """Ids of words. A word keeps a number, under which its ids lie in one array. When there are more than ``most``, words
    that were met once are dropped, and all if more than half were met again."""

    def __init__(self, json_text: str, most: int = 200_000):
        self.tokenizer = load_tokenizer(json_text)
        pieces = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(pieces.values()) + 1, bool)
        for piece, i in pieces.items():
            self.ends[i] = piece.endswith("</w>")
        self.most = most
        self._drop()

    def _drop(self) -> None:
        self.known: dict[bytes, int] = {}
        self.begin, self.size, self.met = np.empty(1 << 12, np.int64), np.empty(1 << 12, np.int32), np.zeros(1 << 12, bool)
        self.ids, self.used = np.empty(1 << 14, np.uint32), 0

    def _drop_rare(self) -> None:
        words = [word for word, number in self.known.items() if self.met[number]]
        numbers = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        ids, sizes = self._gather(numbers), self.size[numbers]
        self._drop()
        if len(words) <= self.most // 2:
            self._keep(words, ids, sizes)

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as bytes of unsigned 32-bit integers; repeats are welcome."""
        flat, sizes = self.encode_flat(words)
        raw, ends = flat.tobytes(), (4 * np.cumsum(sizes)).tolist()
        return [raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=False)]

    def encode_flat(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words in a row, and how many each has."""
        numbers = self._numbers(words)
        return self._gather(numbers), self.size[numbers]

    def encode_lists(self, words: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all lists in a row, and how many each list has. Distinct words alone become Python objects."""
        coded = words.flatten().cast(pa.binary()).dictionary_encode()
        flat, sizes = self.encode_flat(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        at = coded.indices.to_numpy()
        pieces = pa.ListArray.from_arrays(np.append(0, np.cumsum(sizes)).astype(np.int32), pa.array(flat))
        ends = words.offsets.to_numpy().astype(np.int64)
        so_far = np.append(0, np.cumsum(sizes[at]))
        return pieces.take(coded.indices).flatten().to_numpy(), np.diff(so_far[ends - ends[0]])

    def _numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each word; new ones are encoded."""
        if len(self.known) > self.most:
            self._drop_rare()
        known, before = self.known, len(self.known)
        found = list(map(known.get, words))
        missing = [i for i, number in enumerate(found) if number is None]
        if missing:
            self._learn(dict.fromkeys([words[i] for i in missing]))
            for i in missing:
                found[i] = known[words[i]]
        numbers = np.array(found, np.int64)
        self.met[numbers[numbers < before]] = True
        return numbers

    def _gather(self, numbers: np.ndarray) -> np.ndarray:
        """The ids of numbered words in a row."""
        n = self.size[numbers]
        ends = np.cumsum(n, dtype=np.int64)
        return self.ids[np.repeat(self.begin[numbers] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]

    def _keep(self, words: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        """Numbers words, whose ids are given in a row."""
        first, used = len(self.known), self.used
        last, self.used = first + len(words), used + len(ids)
        if last > len(self.begin):
            self.begin, self.size, self.met = (np.resize(x, last * 3 // 2) for x in (self.begin, self.size, self.met))
        if self.used > len(self.ids):
            self.ids = np.resize(self.ids, self.used * 3 // 2)
        self.begin[first:last] = used + np.cumsum(sizes) - sizes
        self.size[first:last] = sizes
        self.met[first:last] = False
        self.ids[used : self.used] = ids
        self.known.update(zip(words, range(first, last), strict=True))

    def _learn(self, new: dict[bytes, None]) -> None:
        """Encodes words that are not known, in their order, as they lie in memory."""
        known, before = self.known, len(self.known)
        plain, other, parts = {}, {}, []
        for word in new:
            if word.isalpha():
                plain[word] = None
                continue
            core = word.rstrip(_TAIL)
            if core and len(core) < len(word) and core[-1] in _LETTERS and b"<|" not in word:
                # a run of letters and a run of other marks never share a token
                tail = word[len(core):]
                parts.append((word, core, tail))
                if core not in known:
                    (plain if core.isalpha() else other)[core] = None
                if tail not in known:
                    other[tail] = None
            else:
                other[word] = None
        self._add(list(plain), list(other))
        if parts:
            whole, cores, tails = zip(*parts, strict=True)
            both = np.array([[known[x] for x in cores], [known[x] for x in tails]], np.int64).T.reshape(-1)
            self.met[both[both < before]] = True
            self._keep(list(whole), self._gather(both), self.size[both].reshape(-1, 2).sum(axis=1))

    def _add(self, plain: list[bytes], other: list[bytes]) -> None:
        """Ids of words of a to z, and of others. Words that are surely one run of letters are encoded in a row."""
        rest = []
        for word in other:
            text = word.decode(errors="replace")
            # Latin-1 letters keep their number and their class under the tokenizer's normaliser
            if text.isalpha() and text.encode("latin-1", "ignore").decode("latin-1") == text:
                plain.append(word)
            else:
                rest.append(word)
        for start in range(0, len(plain), 4096):
            part = plain[start : start + 4096]
            ids = np.array(
                self.tokenizer.encode_batch_fast([b" ".join(part).decode()], add_special_tokens=False)[0].ids,
                np.uint32,
            )
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(part):
                self._keep(part, ids[: stops[-1]], np.diff(stops, prepend=0))
            else:
                rest.extend(part)
        for start in range(0, len(rest), 4096):
            part = rest[start : start + 4096]
            found = [one.ids for one in self.tokenizer.encode_batch_fast([w.decode(errors="replace") for w in part], add_special_tokens=False)]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            self._keep(part, np.fromiter((i for ids in found for i in ids), np.uint32, int(sizes.sum())), sizes)


_ENCODERS: dict[int, WordEncoder] = {}


def worker_encoder(broadcast, most: int = 200_000) -> WordEncoder:
    """One encoder per Python worker and tokenizer, kept between tasks."""
    json_text = broadcast.value
    key = hash((json_text, most))
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = WordEncoder(json_text, most)
    return _ENCODERS[key]
