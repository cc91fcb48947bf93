"""Byte-level BPE by a transducer: frequent words with their ids in a minimal acyclic automaton, the rest merged exactly.

The automaton shares prefixes and suffixes of its words. Its arcs carry numbers whose sum along a word is the word's
number in the lexicon; the ids stand under that number. It is one flat block of arrays, which every executor maps into
memory from a file of its own, and which is walked for many words at once.
"""

from __future__ import annotations

import hashlib
import json
import mmap
import os
import re
import tempfile
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.arrow import annotate, slices, values
from landfall.llm.tokens import BYTE_BPE, SPACES, byte_letters, marked, spaced_units, tokenizer_path
from landfall.session import work_path

LEXICON_WORDS = 131_072
KEPT_UNITS = 400_000
COUNTED_AT_ONCE = 300_000

# How the byte-level tokenizer cuts a text into words before merging (a fixed format).
PRETOKEN = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACES}\p{{L}}\p{{N}}]+"
                         rf"|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")


NO_RANK = 1 << 40


def cut(unit: str) -> list[str]:
    """The words of a unit of text."""
    return [x for x in m if x] if (m := marked(unit)) else PRETOKEN.findall(unit)


class Bpe:
    """Vocabulary and merge ranks of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, vocab = byte_letters(), spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(re.search(f"[{SPACES}]", s) for s in self.special):
            raise ValueError("special tokens with white space are not supported")
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.of_byte = np.zeros(256, np.int64)
        self.bytes = [b""] * (1 + max([*vocab.values(), *self.special.values()]))
        for token, i in vocab.items():
            self.bytes[i] = bytes(letters[c] for c in token)
            if len(token) == 1:
                self.of_byte[letters[token]] = i
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)  # by rank
        self.rank = np.argsort(keys)
        self.pair = keys[self.rank]

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Ids of words, as little-endian 32-bit numbers: in each word the adjacent pair of lowest rank is merged,
        wherever it stands, until no pair has a rank; all words go through this side by side.

        A merge's product takes part in later-ranked pairs only, so all places of a pair can be merged in one sweep.
        """
        out = [b""] * len(words)
        number = np.array([i for i, w in enumerate(words) if w], np.int64)
        size = np.array([len(words[i]) for i in number], np.int64)
        symbols = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        rank, changed = np.full(len(symbols), NO_RANK, np.int64), np.arange(len(symbols))
        while len(number):
            end = np.cumsum(size)
            start = end - size
            # Only pairs that a merge has touched are looked up again.
            rank[changed] = self._ranks(symbols, changed)
            rank[end - 1] = NO_RANK  # a word's last symbol begins no pair
            lowest = np.minimum.reduceat(rank, start)
            going = lowest < NO_RANK
            stays = np.repeat(going, size)
            data, at = symbols[~stays].astype("<i4").tobytes(), 0
            for i, n in zip(number[~going].tolist(), (4 * size[~going]).tolist()):
                out[i] = data[at:at + n]
                at += n
            word = np.repeat(np.arange(len(number)), size)
            here = (rank == lowest[word]) & stays
            # Of places next to each other (a run of one symbol), every second one merges, from the left.
            place = np.arange(len(here))
            run = place - np.maximum.accumulate(np.where(here, 0, place + 1))
            here &= run % 2 == 0
            symbols[here] = self.made[rank[here]]
            keep = stays & ~np.append(False, here[:-1])
            changed = np.flatnonzero((here | np.append(here[1:], False))[keep])
            size = np.bincount(word[keep], minlength=len(number))[going]
            symbols, rank, number = symbols[keep], rank[keep], number[going]
        return out

    def _ranks(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """The ranks of the pairs that begin at ``places``; that of the last symbol of all is not defined."""
        key = symbols[places] << 32 | symbols[np.minimum(places + 1, len(symbols) - 1)]
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where(self.pair[at] == key, self.rank[at], NO_RANK)

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


class Automaton:
    """Builds the minimal automaton of sorted words, state by state, as its words come in."""

    def __init__(self, words: Iterable[bytes]):
        self.arcs: list[tuple] = []      # of finished states: (label, target) each
        self.final: list[bool] = []
        self.known: dict[tuple, int] = {}
        path: list[list] = [[[], False]]  # unfinished states along the last word: arcs, final
        last = b""
        for word in words:
            shared = len(os.path.commonprefix([last, word]))
            self._finish(path, last, shared)
            for _ in word[shared:]:
                path.append([[], False])
            path[-1][1] = True
            last = word
        self._finish(path, last, 0)
        self.root = self._state(path[0])

    def _finish(self, path: list[list], word: bytes, down_to: int) -> None:
        while len(path) - 1 > down_to:
            state = self._state(path.pop())
            path[-1][0].append((word[len(path) - 1], state))

    def _state(self, unfinished: list) -> int:
        key = (unfinished[1], *unfinished[0])
        if key not in self.known:
            self.known[key] = len(self.arcs)
            self.arcs.append(tuple(unfinished[0]))
            self.final.append(unfinished[1])
        return self.known[key]

    def arrays(self) -> dict[str, np.ndarray]:
        """Arcs sorted by (state, label); an arc's number counts the words that come before those through it."""
        words_from = np.zeros(len(self.arcs), np.int64)
        keys, target, number = [], [], []
        for state, arcs in enumerate(self.arcs):  # targets are finished before the states that lead to them
            n = int(self.final[state])
            for label, to in arcs:
                keys.append(state << 8 | label)
                target.append(to)
                number.append(n)
                n += words_from[to]
            words_from[state] = n
        return {"key": np.array(keys, np.int64), "target": np.array(target, np.int32),
                "number": np.array(number, np.int32), "final": np.array(self.final, np.uint8),
                "root": np.array([self.root], np.int32)}


NAMES = ("key", "target", "number", "final", "root", "first", "ids")


def compile_lexicon(words: Iterable[str], bpe: Bpe) -> bytes:
    """The transducer of ``words`` with their ids as one block of bytes: a header of JSON, then the arrays."""
    coded = sorted({w.encode() for w in words})
    arrays = Automaton(coded).arrays()
    ids = bpe.merge(coded)
    arrays["first"] = np.cumsum([0, *map(len, ids)]).astype(np.int32) // 4
    arrays["ids"] = np.frombuffer(b"".join(ids), np.int32)
    at, parts, header = 0, [], {}
    for name in NAMES:
        data = arrays[name].tobytes()
        data += b"\0" * (-len(data) % 8)
        header[name] = [arrays[name].dtype.str, len(arrays[name]), at]
        parts.append(data)
        at += len(data)
    head = json.dumps(header).encode()
    head += b" " * (-len(head) % 8)
    return len(head).to_bytes(8, "little") + head + b"".join(parts)


class Lexicon:
    """A transducer mapped into memory."""

    def __init__(self, block: bytes | mmap.mmap):
        n = int.from_bytes(block[:8], "little")
        for name, (kind, size, at) in json.loads(block[8:8 + n]).items():
            setattr(self, name, np.frombuffer(block, kind, size, 8 + n + at))

    @classmethod
    def map(cls, block: bytes) -> Lexicon:
        """Through an unnamed file in the executor's own temporary folder, which goes with the worker."""
        with tempfile.TemporaryFile() as f:
            f.write(block)
            f.flush()
            return cls(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The words' numbers, -1 where the lexicon does not have them; all words walk one byte at a time."""
        size = np.array([len(w) for w in words], np.int64)
        text = np.frombuffer(b"".join(words), np.uint8)
        first = np.cumsum(size) - size
        state, number = np.full(len(words), self.root[0], np.int64), np.zeros(len(words), np.int64)
        alive = np.flatnonzero(size > 0) if len(self.key) else np.zeros(0, np.int64)
        number[size == 0] = -1
        if not len(self.key):
            return np.full(len(words), -1)
        step = 0
        while len(alive):
            key = state[alive] << 8 | text[first[alive] + step]
            arc = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            there = self.key[arc] == key
            number[alive[~there]] = -1
            alive, arc = alive[there], arc[there]
            state[alive] = self.target[arc]
            number[alive] += self.number[arc]
            step += 1
            done = size[alive] == step
            ended = alive[done]
            number[ended[self.final[state[ended]] == 0]] = -1
            alive = alive[~done]
        return number

    def ids_of(self, number: int) -> bytes:
        return self.ids[self.first[number]:self.first[number + 1]].tobytes()


class Encoder:
    """Encodes whole texts. A unit of text is cut into words once; its words come from the lexicon or are merged."""

    def __init__(self, bpe: Bpe, lexicon: Lexicon):
        self.bpe, self.lexicon = bpe, lexicon
        self.units: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _learn(self, units: set[str]) -> None:
        bpe, words_of = self.bpe, {}
        for unit in units:
            if bpe.split_special and bpe.split_special.search(unit):
                parts = bpe.split_special.split(unit)
                words_of[unit] = [w for i, p in enumerate(parts) for w in ([p] if i % 2 else PRETOKEN.findall(p))]
            else:
                words_of[unit] = cut(unit)
        new = list({w for words in words_of.values() for w in words}.difference(self.words))
        coded = [w.encode("utf-8", "replace") for w in new]
        unseen = []
        for word, number in zip(new, self.lexicon.numbers(coded).tolist()):
            if word in bpe.special:
                self.words[word] = np.array([bpe.special[word]], "<i4").tobytes()
            elif number >= 0:
                self.words[word] = self.lexicon.ids_of(number)
            else:
                unseen.append(word)
        self.words.update(zip(unseen, bpe.merge([w.encode("utf-8", "replace") for w in unseen])))
        get = self.words.__getitem__
        for unit, words in words_of.items():
            self.units[unit] = b"".join(map(get, words))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        units_of = [spaced_units(t) for t in texts]
        every = set().union(*units_of)
        new = every.difference(self.units)
        if len(self.units) + len(new) > KEPT_UNITS:
            # What these texts share with earlier ones is what is common; the rest is given up.
            self.units = {u: self.units[u] for u in every if u in self.units}
            self.words = {w: self.words[w] for u in self.units for w in cut(u) if w in self.words}
        self._learn(new)
        get = self.units.__getitem__
        return [np.frombuffer(b"".join(map(get, units)), "<i4") for units in units_of]


@lru_cache(maxsize=1)
def worker_encoder(path: str, digest: str, block: Broadcast) -> Encoder:
    """The encoder of this Python worker, which goes on to the worker's next task with what it has learned."""
    return Encoder(Bpe(path), Lexicon.map(block.value))


def frequent_words(df: DataFrame, most: int = LEXICON_WORDS) -> list[str]:
    """The commonest words of all texts: all from some count upwards, so many as ``most`` allows.

    Tasks add up before the shuffle. The counts are written once; the least count comes from a histogram of some
    hundred powers of 2 ** (1/8), so that only the words themselves, ``most`` at the most, reach the driver.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units: Counter = Counter()

        def out() -> pa.RecordBatch:
            words: Counter = Counter()
            for unit, n in units.items():
                for w in cut(unit):
                    words[w] += n
            return pa.RecordBatch.from_pydict({"word": pa.array(list(words), pa.string()),
                                               "n": pa.array(list(words.values()), pa.int64())})
        for batch in batches:
            for part in slices(batch, "text"):
                for text in values(part, "text", ""):
                    units.update(spaced_units(text))
                if len(units) > COUNTED_AT_ONCE:
                    yield out()
                    units = Counter()
        yield out()

    spark, path = df.sparkSession, work_path(df.sparkSession, "words")
    (df.select("text").mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
     .where("n > 1").write.parquet(path))
    counts = spark.read.parquet(path)
    power = F.floor(F.log2("n") * 8).cast("int")
    total, least = 0, None
    for row in counts.groupBy(power.alias("power")).count().orderBy(F.desc("power")).collect():
        total += row["count"]
        if total > most:
            break
        least = row["power"]
    if least is None:
        return []
    return [r["word"] for r in counts.where(power >= least).select("word").collect()]


def encode(df: DataFrame, tokenizer: str | None = None, most: int = LEXICON_WORDS, keep_ids: bool = False) -> DataFrame:
    """``df`` with n_tokens, ids_sha256 and decoded_sha256 (and ids), as the byte-level tokenizer file gives them.

    ids_sha256 is of the decimal ids joined by commas, decoded_sha256 of the text that the ids decode to. A null text
    counts as empty. The file's special tokens are taken whole where a text has them. Rows are encoded one by one, so
    repeated rows stay; columns of ``df`` with these names are replaced; an empty table gives no rows.

    Words are counted over all texts; the commonest, ``most`` at most, make the lexicon, a block of a few MB at the default, which
    is broadcast. It decides the speed only: what it lacks is merged to the same ids.
    """
    path = tokenizer or tokenizer_path(BYTE_BPE)
    words = frequent_words(df, most)
    block = compile_lexicon(words, Bpe(path))
    shared, digest = df.sparkSession.sparkContext.broadcast(block), hashlib.sha256(block).hexdigest()

    def make():
        encoder = worker_encoder(path, digest, shared)
        bpe = encoder.bpe
        number = [str(i) for i in range(len(bpe.bytes))]

        def work(part: pa.RecordBatch) -> dict:
            out = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "ids": []}
            for ids in encoder.encode(values(part, "text", "")):
                plain = ids.tolist()
                out["n_tokens"].append(len(plain))
                out["ids_sha256"].append(hashlib.sha256(",".join(map(number.__getitem__, plain)).encode()).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(bpe.decode(plain).encode()).hexdigest())
                if keep_ids:
                    out["ids"].append(ids)
            return {"n_tokens": pa.array(out["n_tokens"], pa.int64()), "ids_sha256": pa.array(out["ids_sha256"], pa.string()),
                    "decoded_sha256": pa.array(out["decoded_sha256"], pa.string()),
                    "ids": pa.array(out["ids"], pa.list_(pa.int32()))}
        return work

    added = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if keep_ids else "")
    return annotate(df, "text", added, make)
