"""Token ids of whole texts, word by word, with a bounded cache in each Python worker."""

from __future__ import annotations

import json
import unicodedata
from array import array
from functools import cache
from itertools import chain
from pathlib import Path

import numpy as np
import regex
from tokenizers import Tokenizer

# The split pattern of the public tokenizer, and the bytes that
# byte-level vocabularies show as themselves (all others follow from 256 on).
SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
MARKS = ".,;:!?*#$%&|()[]{}-_+=/<>\"@~^"


# The steps of such a tokenizer file that this module carries out itself.
STEPS = {
    "normalizer": ["NFC", "Replace", "Lowercase"],
    "pre_tokenizer": ["Split", "ByteLevel"],
    "end_of_word_suffix": "</w>",
}


def _byte_letters() -> dict[int, str]:
    hidden = [b for b in range(256) if b not in SHOWN]
    return {b: chr(b) for b in SHOWN} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def _check(path: str) -> None:
    """Raises if the tokenizer at ``path`` works in other steps than this module."""
    rules = json.loads(Path(path).read_text(encoding="utf-8"))
    found = {
        "normalizer": [n["type"] for n in rules["normalizer"]["normalizers"]],
        "pre_tokenizer": [n["type"] for n in rules["pre_tokenizer"]["pretokenizers"]],
        "end_of_word_suffix": rules["model"]["end_of_word_suffix"],
    }
    split, levels = rules["pre_tokenizer"]["pretokenizers"]
    same = split["pattern"]["Regex"] == SPLIT.pattern and split["invert"] and split["behavior"] == "Removed"
    if found != STEPS or not same or levels["add_prefix_space"] or levels["use_regex"]:
        raise ValueError(f"{path}: not the word-level BPE that this encoder knows")


class WordEncoder:
    """Encodes as the word-level BPE tokenizer at ``path`` does, with ``add_special_tokens=False``.

    No piece of this vocabulary crosses white space, so a text is the chain of its
    words and each word is encoded once while it stays in the cache. At ``limit``
    words the cache is thinned out, see :meth:`_thin`. Texts with one of the vocabulary's special strings are
    left to the library, which cuts them around it. The file's steps are checked.
    """

    def __init__(self, path: str, limit: int = 300_000):
        _check(path)
        self.whole = Tokenizer.from_file(path)
        self.model, self.limit = self.whole.model, limit
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.letters = _byte_letters()
        self._reset()

    def _reset(self) -> None:
        self.words: dict[bytes, int] = {}
        self.parts: dict[str, list[int]] = {}
        self.flat, self.starts = array("I"), array("q", [0])
        self.met = np.zeros(0, np.int64)

    def _thin(self) -> None:
        """Words met once are forgotten; of the others the most frequent stay, half the limit at most."""
        stay = np.flatnonzero(self.met > 1)
        stay = np.sort(stay[np.argsort(-self.met[stay], kind="stable")[: self.limit // 2]])
        starts, flat = np.array(self.starts, np.int64), np.array(self.flat, np.uint32)
        sizes = starts[stay + 1] - starts[stay]
        ends = np.cumsum(sizes)
        ids = flat[np.repeat(starts[stay] - (ends - sizes), sizes) + np.arange(sizes.sum())]
        names, met = list(self.words), self.met[stay] // 2  # what is not met again goes next time
        self._reset()
        self.words = {names[k]: i for i, k in enumerate(stay.tolist())}
        self.flat.frombytes(ids.tobytes())
        self.starts.frombytes(ends.astype(np.int64).tobytes())
        self.met = met

    def _part(self, part: str) -> list[int]:
        ids = self.parts.get(part)
        if ids is None:
            # Printable ASCII shows as itself.
            shown = part if part.isascii() and part.isprintable() else part.encode().decode("latin-1").translate(self.letters)
            ids = self.parts[part] = [x.id for x in self.model.tokenize(shown)]
        return ids

    def _learn(self, new: list[bytes]) -> None:
        """Words without white space; joined, they are normalised and lower-cased all at once."""
        text = unicodedata.normalize("NFC", b"\n".join(new).decode())
        # A sigma is lower-cased by its place in the word, where the library does not look.
        lowered = ("".join(c.lower() for c in text) if "\u03a3" in text else text.lower()).split("\n")
        part, parts, known, flat, starts = self._part, self.parts, self.words, self.flat, self.starts
        for word, low in zip(new, lowered, strict=True):
            known[word] = len(known)
            core = low.rstrip(MARKS)
            if core.isalpha():
                flat.extend(parts.get(core) or part(core))
                if len(core) < len(low):
                    flat.extend(part(low[len(core) :]))
            else:
                for p in SPLIT.findall(low):
                    flat.extend(part(p))
            starts.append(len(flat))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and the number of ids of each text."""
        if len(self.words) > self.limit:
            self._thin()
        apart = {i for i, t in enumerate(texts) if any(s in t for s in self.special)}
        split = [[] if i in apart else t.encode().split() for i, t in enumerate(texts)]
        words = list(chain.from_iterable(split))
        new = [w for w in set(words) if w not in self.words]
        if new:
            self._learn(new)
        at = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
        met = np.bincount(at, minlength=len(self.words))
        met[: len(self.met)] += self.met
        self.met = met
        starts, flat = np.array(self.starts, np.int64), np.array(self.flat, np.uint32)
        sizes = starts[at + 1] - starts[at]
        ends = np.cumsum(sizes)
        ids = flat[np.repeat(starts[at] - (ends - sizes), sizes) + np.arange(sizes.sum())]
        counts = np.diff(np.concatenate([[0], ends])[np.cumsum([0, *map(len, split)])])
        return self._with(apart, texts, ids, counts) if apart else (ids, counts)

    def _with(self, apart: set[int], texts: list[str], ids: np.ndarray, counts: np.ndarray):
        """Ids and counts with those of the texts that the library encodes."""
        pieces = np.split(ids, np.cumsum(counts)[:-1])
        for i in apart:
            pieces[i] = np.array(self.whole.encode(texts[i], add_special_tokens=False).ids, np.uint32)
        return np.concatenate(pieces), np.array([len(p) for p in pieces])


@cache
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def small_groups(texts: list, most: int = 1 << 20):
    """Runs of positions whose texts hold about ``most`` characters together."""
    begin = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield begin, i
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield begin, len(texts)
