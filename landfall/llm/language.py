"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A trigram's vector binds its letters' vectors, permuted by place (rolled
two, one and no step), by multiplication; a text's vector bundles those of all its trigrams by addition. A language's
prototype bundles its texts; the language whose prototype has the largest cosine with a text is the answer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.arrow import annotate, slices, values

DIMENSIONS = 1024
SYMBOLS = 64
SEED = 20260
UNDETERMINED = "und"
LEAST_COSINE = 0.05  # where no levels are learned: random vectors have a cosine of 0.03 one way or the other
CHARS_AT_ONCE = 1 << 21

# Acceptance levels: of the learned texts of about a length, and of shorter ones where those are too few to tell, at most
# one in LEVEL_ROWS has a cosine with its own language below the quantile; text of other languages stays far below it.
LENGTHS = 40            # classes of texts by the power of two of their number of trigrams
CELLS = 256             # of cosines from 0 to 1
LEVEL_ROWS = 1_000
LEVEL_SHARE = 0.8       # of the quantile, for clean texts unlike those learned from


def letter_vectors(dimensions: int) -> np.ndarray:
    return np.random.default_rng(SEED).choice(np.array([-1, 1], np.int8), (SYMBOLS, dimensions))


def symbol_table() -> np.ndarray:
    """Symbol per code point of the basic plane: 0 is no letter, a to z have their own, other letters share the rest."""
    table = np.zeros(1 << 16, np.uint8)
    for code in range(1 << 16):
        letter = chr(code)
        if letter.isalpha():
            low = ord(letter.lower()[0])
            table[code] = low - 96 if 97 <= low <= 122 else 27 + low % (SYMBOLS - 27)
    return table


class Trigrams:
    """Trigram counts of texts; a run of other characters is one blank, which the text begins and ends with."""

    def __init__(self):
        self.table = symbol_table()

    def codes(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
        symbol = np.where(points < 1 << 16, self.table[np.minimum(points, (1 << 16) - 1)], 0)
        if (beyond := points >= 1 << 16).any():
            for i in np.flatnonzero(beyond):
                if chr(points[i]).isalpha():
                    symbol[i] = 27 + int(points[i]) % (SYMBOLS - 27)
        symbol = np.concatenate([[0], symbol, [0]]).astype(np.int32)
        symbol = symbol[(symbol > 0) | np.append(True, symbol[:-1] > 0)]
        if len(symbol) < 3:
            return np.zeros(0, np.int32)
        return symbol[:-2] * SYMBOLS * SYMBOLS + symbol[1:-1] * SYMBOLS + symbol[2:]

    def count(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The distinct trigrams of ``texts`` and the matrix of their counts, a row per text. Long texts go in parts of
        about ``CHARS_AT_ONCE`` characters, which are cut where a word ends."""
        codes, docs = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for i, text in enumerate(texts):
            own = self.codes(text) if len(text) <= CHARS_AT_ONCE else self._long(text)
            codes.append(own)
            docs.append(np.full(len(own), i))
        grams, column = np.unique(np.concatenate(codes), return_inverse=True)
        cells = np.concatenate(docs) * max(1, len(grams)) + column
        return grams, np.bincount(cells, minlength=len(texts) * len(grams)).reshape(len(texts), len(grams))

    def _long(self, text: str) -> np.ndarray:
        # Counts are kept as codes repeated; parts are cut between letters' runs, at a character that is no letter.
        parts, at = [], 0
        while at < len(text):
            end = min(len(text), at + CHARS_AT_ONCE)
            while end < len(text) and text[end].isalpha():
                end += 1
            parts.append(self.codes(text[at:end]))
            at = end
        return np.concatenate(parts)


class Space:
    """Turns trigram counts into bundled vectors. Trigram vectors are bound once per distinct trigram and kept."""

    def __init__(self, dimensions: int):
        letters = letter_vectors(dimensions)
        self.first, self.second, self.third = np.roll(letters, 2, axis=1), np.roll(letters, 1, axis=1), letters
        self.place = np.full(SYMBOLS ** 3, -1, np.int32)
        self.bound = np.zeros((0, dimensions), np.float32)

    def bundle(self, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        new = grams[self.place[grams] < 0]
        if len(new):
            if len(self.bound) + len(new) > 1 << 14:  # 64 MB at 1,024 dimensions
                self.place[:], self.bound, new = -1, self.bound[:0], grams
            a, b, c = new // SYMBOLS ** 2, new // SYMBOLS % SYMBOLS, new % SYMBOLS
            self.place[new] = len(self.bound) + np.arange(len(new))
            self.bound = np.concatenate([self.bound, (self.first[a] * self.second[b] * self.third[c]).astype(np.float32)])
        # Whole numbers far below 2^24 add up exactly in single precision, in any order; larger ones go by double.
        exact = np.float32 if counts.sum(axis=1).max(initial=0) < 1 << 24 else np.float64
        return counts.astype(exact) @ self.bound[self.place[grams]].astype(exact, copy=False)


@dataclass
class Prototypes:
    languages: list[str]
    vectors: np.ndarray  # a unit vector per language


def learn(df: DataFrame, dimensions: int = DIMENSIONS) -> Prototypes:
    """Prototypes of the languages of ``df`` (text, lang), from all its rows where both are given.

    Each task bundles its rows by language; what is shuffled and collected is a vector per language (the labels of a
    language column: a small set), of whole numbers, so the sums are the same in any order.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trigrams, space, sums = Trigrams(), Space(dimensions), {}
        for batch in batches:
            for part in slices(batch, "text"):
                lang = np.array(part.column("lang").to_pylist())
                grams, counts = trigrams.count(values(part, "text", ""))
                names, of = np.unique(lang, return_inverse=True)
                by_lang = np.zeros((len(names), len(grams)), np.int64)
                np.add.at(by_lang, of, counts)
                for name, vector in zip(names, space.bundle(grams, by_lang)):
                    sums[name] = sums.get(name, 0) + vector.astype(np.int64)
        if sums:
            yield pa.RecordBatch.from_pydict({"lang": list(sums), "v": pa.array(list(sums.values()), pa.list_(pa.int64()))})

    labelled = df.select("text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
    parts = labelled.mapInArrow(run, "lang string, v array<bigint>").select("lang", F.posexplode("v"))
    sums = parts.groupBy("lang", "pos").agg(F.sum("col").alias("v")).groupBy("lang").agg(
        F.sort_array(F.collect_list(F.struct("pos", "v"))).alias("v")).orderBy("lang").collect()
    vectors = np.array([[x["v"] for x in r["v"]] for r in sums], np.float64).reshape(len(sums), dimensions)
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return Prototypes([r["lang"] for r in sums], vectors / np.where(norms == 0, 1, norms))


def _lengths(counts: np.ndarray) -> np.ndarray:
    """The class of each text by its number of trigrams; a text without any is in the first."""
    return np.minimum(np.log2(np.maximum(counts.sum(axis=1), 1)).astype(np.int64), LENGTHS - 1)


def _cosines(vectors: np.ndarray, model: Prototypes) -> np.ndarray:
    norm = np.linalg.norm(vectors, axis=1)
    return np.stack([vectors @ v for v in model.vectors], axis=1) / np.where(norm == 0, 1, norm)[:, None]


def learn_levels(df: DataFrame, model: Prototypes) -> np.ndarray:
    """The least cosine to accept by class of length, from all rows of ``df`` (text, lang) that the prototypes know.

    Counted as histograms of cosines with the row's own language, by length; a table of at most ``LENGTHS * CELLS`` rows
    is collected. A class with fewer than ``LEVEL_ROWS`` rows takes in those of shorter texts. Its level is
    ``LEVEL_SHARE`` of the quantile 1 / ``LEVEL_ROWS``, and never above that of longer texts, so a class without rows
    has that of the nearest class that has some. Without any such row all levels are 0.
    """
    dimensions, place = model.vectors.shape[1], {name: i for i, name in enumerate(model.languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trigrams, space, cells = Trigrams(), Space(dimensions), np.zeros((LENGTHS, CELLS), np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                own = np.array([place.get(x, -1) for x in part.column("lang").to_pylist()])
                grams, counts = trigrams.count(values(part, "text", ""))
                rows = np.flatnonzero((own >= 0) & (counts.sum(axis=1) > 0))
                if len(rows):
                    cosine = _cosines(space.bundle(grams, counts[rows]).astype(np.float64), model)
                    cell = np.clip(cosine[np.arange(len(rows)), own[rows]] * CELLS, 0, CELLS - 1).astype(np.int64)
                    np.add.at(cells, (_lengths(counts[rows]), cell), 1)
        length, cell = np.nonzero(cells)
        yield pa.RecordBatch.from_pydict({"length": pa.array(length, pa.int32()), "cell": pa.array(cell, pa.int32()),
                                          "n": pa.array(cells[length, cell], pa.int64())})

    labelled = df.select("text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
    histogram = np.zeros((LENGTHS, CELLS), np.int64)
    if model.languages:
        counted = labelled.mapInArrow(run, "length int, cell int, n bigint").groupBy("length", "cell").agg(F.sum("n").alias("n"))
        for r in counted.collect():
            histogram[r["length"], r["cell"]] = r["n"]
    return levels_of(histogram)


def levels_of(histogram: np.ndarray) -> np.ndarray:
    """Acceptance levels from counts of rows by class of length and cell of the cosine."""
    levels = np.full(LENGTHS, np.inf)
    for length in range(LENGTHS):
        pool = np.zeros(CELLS, np.int64)
        for shorter in range(length, -1, -1):
            pool = pool + histogram[shorter]
            if pool.sum() >= LEVEL_ROWS:
                break
        if pool.any():
            levels[length] = LEVEL_SHARE / CELLS * np.searchsorted(np.cumsum(pool), pool.sum() / LEVEL_ROWS)
    levels = np.minimum.accumulate(levels[::-1])[::-1]
    return np.where(np.isinf(levels), 0, levels)


def _scorer(model: Prototypes, dimensions: int, least: float | np.ndarray):
    def make():
        levels = np.broadcast_to(least, LENGTHS)
        trigrams, space = Trigrams(), Space(dimensions)
        names = np.array([*model.languages, UNDETERMINED], dtype=object)

        def work(part: pa.RecordBatch) -> dict:
            texts = values(part, "text", "")
            grams, counts = trigrams.count(texts)
            if not len(grams) or not model.languages:
                return {"lang_pred": pa.array([UNDETERMINED] * len(texts)), "score": np.zeros(len(texts)),
                        "accepted": np.zeros(len(texts), bool)}
            vectors = space.bundle(grams, counts).astype(np.float64)
            cosine = _cosines(vectors, model)
            best = cosine.argmax(axis=1)
            score = np.clip(cosine[np.arange(len(texts)), best], 0, 1)
            blank = counts.sum(axis=1) == 0
            pred = np.where(blank, len(model.languages), best)
            return {"lang_pred": pa.array(names[pred], pa.string()), "score": np.where(blank, 0.0, score),
                    "accepted": ~blank & (score >= levels[_lengths(counts)])}
        return work
    return make


SCORED = "lang_pred string, score double, accepted boolean"


def identify(df: DataFrame, model: Prototypes, least: float | np.ndarray = LEAST_COSINE) -> DataFrame:
    """``df`` with lang_pred (``und`` if the text is null or has no letter), score (cosine, not below 0) and accepted.

    Ties go to the language first in order. Rows are judged one by one from their text alone; columns of ``df`` with
    these names are replaced; an empty table gives no rows. Without any labelled text to learn from all is ``und``.
    ``least`` is the least cosine accepted, one for all texts or, as ``learn_levels`` gives them, by length.
    """
    return annotate(df, "text", SCORED, _scorer(model, model.vectors.shape[1], least))


def keep_identified(df: DataFrame, model: Prototypes, least: float | np.ndarray) -> DataFrame:
    """The rows of ``df`` whose language is determined with a cosine of ``least`` (see ``identify``) or more, with
    ``df``'s columns."""
    return annotate(df, "text", SCORED, _scorer(model, model.vectors.shape[1], least), keep="accepted")
