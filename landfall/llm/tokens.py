"""Token ids of whole texts, as the tokenizers library gives them, at the price of each distinct unit of text.

A tokenizer cuts a text into words before it merges, and both tokenizers here always cut where white space follows
something else. A text is therefore the sequence of its units (white space and what follows it), each of which has
the same ids wherever it stands. A task hands a unit to the library once and looks its ids up from then on. Units are
cut, told apart and replaced by their ids as Arrow columns; only distinct ones become Python objects.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterable
from functools import lru_cache
from itertools import compress

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

# Spark runs a task per core already.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# Unicode's White_Space, as code points (fixed values).
SPACES = "\t-\r \x85\xa0  -     　"

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"

# Units of texts whose ids include those of white space, and of texts whose white space is dropped.
WITH_SPACE = re.compile(f"[{SPACES}]*[^{SPACES}]+|[{SPACES}]+")
WITHOUT_SPACE = re.compile(f"[^{SPACES}]+")

_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
# A word with end marks: both tokenizers cut it before the marks, and keep the marks together.
_MARKED = re.compile(f"(\n?)( ?[{_LETTERS}]+)([.,;:!?]*)")

# Units one after another, each ended by a zero: line break, word and end marks, or else the unit as it is. Marks are
# ASCII's, without those of contractions and special tokens.
_PARTS = re.compile(rf"(?:(\n?)( ?[{_LETTERS}]+)([!-&(-/:;=?@\[-`{{}}~]*)|([^\0]*))\0")

# A text with none of these has no white space but single blanks and line breaks, and the mark is free to cut at.
_CUT = "\0"
_UNEVEN = ("  ", " \n", "\n ", "\n\n", _CUT, *(c for c in map(chr, range(1 << 14)) if c not in " \n" and re.match(f"[{SPACES}]", c)))
_SEPARATORS = "\x1c\x1d\x1e\x1f"  # white space to str.split, and not to the tokenizers

UNITS_KEPT = 500_000
UNITS_AT_ONCE = 4096


def tokenizer_path(name: str) -> str:
    return public_tokenizers.path(name)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves, others from 256."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def marked(unit: str) -> tuple[str, str, str] | None:
    """A unit as line break, word and end marks, if that is all it is. It is cut so by both tokenizers."""
    m = _MARKED.fullmatch(unit)
    return m.groups() if m else None


def spaced_units(text: str) -> list[str]:
    """The units that ``WITH_SPACE`` finds. Evenly spaced text is cut by plain replacements, at a third of the price."""
    if any(x in text for x in _UNEVEN):
        return WITH_SPACE.findall(text)
    units = text.replace(" ", _CUT + " ").replace("\n", _CUT + "\n").split(_CUT)
    if not units[0]:
        del units[0]
    return units


def bare_units(text: str) -> list[str]:
    """The units that ``WITHOUT_SPACE`` finds."""
    return WITHOUT_SPACE.findall(text) if any(x in text for x in _SEPARATORS) else text.split()


class UnitEncoder:
    """Encodes texts to little-endian unsigned 32-bit ids. Keeps at most about ``UNITS_KEPT`` units in memory."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spaced = self.tokenizer.encode(" a", add_special_tokens=False).ids
        self.lower = spaced == self.tokenizer.encode("a", add_special_tokens=False).ids
        self.cut = bare_units if self.lower else spaced_units
        self.word = "^[a-zß-öø-ÿ]+$" if self.lower else f"^ ?[{_LETTERS}]+$"
        self.kept: dict[str, bytes] = {}
        self.letters = {b: c for c, b in byte_letters().items()}

    def _words(self, words: Iterable[str]) -> None:
        """Words of letters, as the library's model merges them; nothing that comes before merging changes them."""
        merged, blank = self.tokenizer.model.tokenize, self.letters[32]
        for word in words:
            coded = word.replace(" ", blank) if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
            self.kept[word] = array("I", [t.id for t in merged(coded)]).tobytes()

    def _library(self, units: list[str]) -> None:
        for at in range(0, len(units), UNITS_AT_ONCE):
            some = units[at:at + UNITS_AT_ONCE]
            for unit, found in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                self.kept[unit] = array("I", found.ids).tobytes()

    def _learn(self, units: list[str]) -> None:
        """Ids of new units. A word alone costs the model's merging and little else."""
        kept = self.kept
        kept[""] = b""
        alone = pc.match_substring_regex(pa.array(units, pa.string()), self.word).to_numpy(zero_copy_only=False)
        self._words(compress(units, alone))
        units = list(compress(units, ~alone))
        plain = [unit for unit in units if _CUT not in unit]
        rest, parts = set(units).difference(plain), []
        for unit, (line, word, marks, other) in zip(plain, _PARTS.findall(_CUT.join([*plain, ""]))):
            if word:
                parts.append((unit, line, word.lower() if self.lower else word, marks))
            else:
                rest.add(other)
        ends = {x for _, line, _, marks in parts for x in (line, marks)}
        self._library(list(rest.union(ends).difference(kept)))
        self._words({word for _, _, word, _ in parts}.difference(kept))
        for unit, line, word, marks in parts:
            kept[unit] = kept[line] + kept[word] + kept[marks]

    def _cut_all(self, texts: list[str]) -> pa.ListArray:
        """The units of each text; of evenly spaced ones also empty units, which have no ids."""
        if any(x in text for text in texts for x in _UNEVEN):
            return pa.array([self.cut(text) for text in texts], pa.list_(pa.string()))
        if self.lower:
            return pc.split_pattern(pa.array([text.replace("\n", " ") for text in texts], pa.string()), " ")
        spaced = [text.replace(" ", _CUT + " ").replace("\n", _CUT + "\n") for text in texts]
        return pc.split_pattern(pa.array(spaced, pa.string()), _CUT)

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = self._cut_all(texts)
        units = cut.values.dictionary_encode()
        every = units.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = list(map(self.kept.get, every))
        new = [u for u, ids in zip(every, known) if ids is None]
        if len(self.kept) + len(new) > UNITS_KEPT:
            # What these texts share with earlier ones is what is common; the rest is given up.
            self.kept = {u: ids for u, ids in zip(every, known) if ids is not None}
        self._learn(new)
        known = [self.kept[u] if ids is None else ids for u, ids in zip(every, known)]
        ids = pa.array(known, pa.large_binary()).take(units.indices)
        _, ends, data = ids.buffers()
        ends = np.frombuffer(ends, np.int64)[cut.offsets.to_numpy()].tolist() if len(ids) else [0] * (len(texts) + 1)
        data = memoryview(data or b"")
        return [bytes(data[start:end]) for start, end in zip(ends, ends[1:])]


@lru_cache(maxsize=2)
def encoder(path: str) -> UnitEncoder:
    """The encoder of this Python worker, which goes on to the worker's next task with what it has learned."""
    return UnitEncoder(path)
