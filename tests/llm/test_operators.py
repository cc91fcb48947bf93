"""Operators against the tokenizers library, brute force, exact round trips, SQL or held-out labels, on small tables."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from landfall.llm import (arrow, language, lexicon, licences, packing, quality, queries, repetition, search, simhash,
                          tokenfile, tokens, toxicity)
from landfall.session import work_path
from tests.compare import connect, difference

SF = "/root/testdata/sf0.001"
ODD = [None, "", " ", "\n\n a  b\t\n", "don't  stop<|endoftext|> now", "a   b　　c", "x\x1cy \x85z",
       "Été ÉTÉ été ß İstanbul ΣΑΣ", "漢字 123 456,789!?", "🙂 ok 🙂🙂", "word " * 3000, "same text here", "same text here",
       "<|startoftext|>x<|endoftext|>", "aaaaaaa aaaa aaaaa", "end.\nThe next, line; here"]


@pytest.fixture(scope="module")
def odd(spark):
    """Texts with every oddity, a repeated row, and columns whose names clash with the operators' own."""
    rows = [(i, t, None, 0.5) for i, t in enumerate(ODD)] + [(3, ODD[3], "x", None)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score double")


def library(name: str) -> Tokenizer:
    return Tokenizer.from_file(tokens.tokenizer_path(name))


def test_units_are_encoded_as_whole_texts_are():
    rng = random.Random(1)
    parts = ["ab", "Word", "é", " ", "  ", "\n", "\t", " ", " ", "\x1c", "'s", "'", ".", ",!", "12", "<|endoftext|>", "漢", "́"]
    texts = ["".join(rng.choices(parts, k=12)) for _ in range(3000)] + [t or "" for t in ODD]
    for name in (tokens.BYTE_BPE, tokens.WORD_BPE):
        own, whole = tokens.UnitEncoder(tokens.tokenizer_path(name)), library(name)
        for text, ids in zip(texts, own.encode(texts)):
            assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, (name, text)


def test_even_texts_are_not_cut_in_python_and_marks_go_to_the_library_once(monkeypatch):
    rng = random.Random(3)
    marks = ["###", "$$$", "%%%", "&&&", "***", ".###", "!?", "(", "`~", "\\]^_", ""]
    words = ["".join(rng.choices("abyzABYZéÑßÿ", k=rng.randint(1, 9))) for _ in range(2000)]
    texts = ["".join(rng.choice(words) + rng.choice(marks) + rng.choice(" \n") for _ in range(400)) for _ in range(20)]
    for name in (tokens.BYTE_BPE, tokens.WORD_BPE):
        own, whole, asked = tokens.UnitEncoder(tokens.tokenizer_path(name)), library(name), []
        given = own._library
        monkeypatch.setattr(own, "cut", None)
        monkeypatch.setattr(own, "_library", lambda units: (asked.extend(units), given(units)))
        for text, ids in zip([*texts, *texts], own.encode(texts) + own.encode(texts)):
            assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, (name, text)
        assert len(asked) == len(set(asked)) and set(asked) <= {" ", "\n", *marks}
        assert own.encode([]) == [] and own.encode(["", ""]) == [b"", b""]


def test_units_given_up_are_learned_again(monkeypatch):
    monkeypatch.setattr(tokens, "UNITS_KEPT", 50)
    for name in (tokens.BYTE_BPE, tokens.WORD_BPE):
        own, whole = tokens.UnitEncoder(tokens.tokenizer_path(name)), library(name)
        for k in range(0, 300, 20):
            texts = [f"the n{i} Word{chr(97 + i % 26) * (i % 7)}. of\n\x00 \x1c{i}\u2003x" for i in range(k, k + 30)]
            for text, ids in zip(texts, own.encode(texts)):
                assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, (name, text)
            assert len(own.kept) <= 300


def test_units_cut_by_plain_replacements_are_those_of_the_expressions():
    rng = random.Random(2)
    for letters in ("ab \n", "a  \n\n\t\xa0\x1c\0é\u3000\u2003"):
        for _ in range(20000):
            text = "".join(rng.choices(letters, k=rng.randint(0, 8)))
            assert tokens.spaced_units(text) == tokens.WITH_SPACE.findall(text), repr(text)
            assert tokens.bare_units(text) == tokens.WITHOUT_SPACE.findall(text), repr(text)


def test_lexicon_encoding_is_exact(spark, odd):
    found = {r["doc_id"]: r for r in lexicon.encode(odd.select("doc_id", "text"), most=40).collect()}
    whole = library(tokens.BYTE_BPE)
    for i, text in enumerate(ODD):
        ids = whole.encode(text or "", add_special_tokens=False).ids
        decoded = whole.decode(ids, skip_special_tokens=False)
        assert found[i]["n_tokens"] == len(ids)
        assert found[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert found[i]["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()
    assert lexicon.encode(odd.limit(0)).count() == 0


def test_automaton_is_minimal_and_numbers_its_words():
    words = sorted(w.encode() for w in ("sting", "string", "ring", "rings", "sing", "a", "été"))
    built = lexicon.Automaton(words)
    block = lexicon.compile_lexicon([w.decode() for w in words], lexicon.Bpe(tokens.tokenizer_path(tokens.BYTE_BPE)))
    assert lexicon.Lexicon(block).numbers([*words, b"rin", b"stings", b"", b"zz"]).tolist() == [*range(7), -1, -1, -1, -1]
    assert len(built.arcs) < len({w[:i] for w in words for i in range(len(w) + 1)})  # ends are shared


@pytest.mark.parametrize("planes", ["bit", "byte"])
def test_token_files_round_trip(spark, odd, planes):
    path = work_path(spark, "test-ids")
    tokenfile.write(odd, path, planes=planes)
    whole, start = library(tokens.BYTE_BPE), 0
    rows = sorted(tokenfile.read(spark, path, keep_ids=True).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == sorted([*range(len(ODD)), 3])
    for r in rows:
        ids = whole.encode(ODD[r["doc_id"]] or "", add_special_tokens=False).ids + [2]
        assert (r["start"], r["n_tokens"], r["ids"]) == (start, len(ids), ids)
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_packing_places_every_piece_once(spark, odd):
    rows = packing.pack(odd, capacity=64, keep_ids=True).collect()
    whole, held = library(tokens.WORD_BPE), {}
    for r in rows:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in held.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 64
    own = Counter((r["doc_id"], r["piece"], r["start"], tuple(r["ids"])) for r in rows)
    wanted: Counter = Counter()
    for i in [*range(len(ODD)), 3]:
        ids = whole.encode(ODD[i] or "", add_special_tokens=False).ids + [1]
        wanted.update((i, k, k * 64, tuple(ids[k * 64:(k + 1) * 64])) for k in range(-(-len(ids) // 64)))
    assert own == wanted
    assert packing.pack(odd.limit(0)).count() == 0


def test_plans_use_exact_fills():
    rng = np.random.default_rng(3)
    for capacity, n in ((10, 50), (100, 400), (4096, 3000)):
        counts = Counter(rng.integers(1, capacity + 1, n).tolist())
        plan = packing.patterns(counts, capacity)
        used: Counter = Counter()
        for lengths, copies in plan:
            assert sum(lengths) <= capacity
            for x in lengths:
                used[x] += copies
        assert used == counts
        bound = -(-sum(k * v for k, v in counts.items()) // capacity)
        largest = sum(v for k, v in counts.items() if 2 * k > capacity)
        assert sum(c for _, c in plan) <= 1.05 * max(bound, largest) + 1


def brute_components(prints: dict, radius: int) -> dict:
    ids, label = sorted(prints), {i: i for i in prints}
    for _ in ids:
        for a in ids:
            for b in ids:
                if bin(prints[a] ^ prints[b]).count("1") <= radius:
                    label[a] = label[b] = min(label[a], label[b])
    return label


@pytest.mark.parametrize("radius, cell_rows", [(4, 4096), (4, 4), (9, 8), (0, 4096)])
def test_links_find_every_pair(spark, radius, cell_rows):
    rng = random.Random(radius)
    prints = set()
    for _ in range(12):
        seed = rng.getrandbits(64)
        prints |= {seed} | {seed ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, radius + 2))) for _ in range(6)}
    signed = {p - (1 << 64) if p >> 63 else p for p in prints}
    classes = spark.createDataFrame([(p,) for p in signed], "fingerprint bigint")
    roots = {r["fingerprint"]: r["root"] for r in simhash.components(simhash.links(classes, radius, cell_rows)).collect()}
    wanted = brute_components({p: p & (2 ** 64 - 1) for p in signed}, radius)
    group: dict = {}
    for p in signed:
        group.setdefault(wanted[p], set()).add(roots.get(p, p))
    assert all(len(g) == 1 for g in group.values()) and len({min(g) for g in group.values()}) == len(group)


def test_near_duplicates_of_odd_texts(spark, odd):
    found = {r["doc_id"]: r for r in simhash.near_duplicates(odd).collect()}
    assert len(found) == len(ODD)
    assert [found[i]["fingerprint"] for i in (0, 1, 2)] == ["0" * 16] * 3 and found[2]["component_id"] == 0
    assert found[12]["component_id"] == found[11]["component_id"] == 11
    assert simhash.near_duplicates(odd.limit(0)).count() == 0
    nameless = spark.createDataFrame([(None, "a b c d e"), (7, "A B c d e"), (None, "")], odd.select("doc_id", "text").schema)
    assert sorted(map(str, (r["component_id"] for r in simhash.near_duplicates(nameless).collect()))) == ["7", "7", "None"]


def test_repetition_figures(spark, odd):
    rng, texts = random.Random(5), [t or "" for t in ODD]
    texts += [" ".join(rng.choices("abcd", k=rng.randint(0, 80))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in repetition.measure(df, least=4).collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", r["text"])
        n, longest = len(words), []
        windows = Counter(zip(words, words[1:], words[2:]))
        for i in range(n):
            best = 0
            for j in range(n):
                k = 0
                while j != i and max(i, j) + k < n and words[i + k] == words[j + k] and n <= 100:
                    k += 1
                best = max(best, k)
            longest.append(best)
        three = {i + d for i in range(n - 2) if windows[tuple(words[i:i + 3])] > 1 for d in range(3)}
        lines = [x for x in r["text"].split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r["n_words"], r["word_chars"], r["n_dup_lines"], r["n_repeat_words"]) == (
            n, sum(map(len, words)), len(lines) - len(set(lines)), len(three))
        if n <= 100:
            assert r["longest_repeat"] == max(longest, default=0)
            assert r["n_covered"] == len({i + d for i, k in enumerate(longest) if k >= 4 for d in range(k)})
    kept = repetition.keep_unrepetitive(odd)
    assert kept.columns == odd.columns and kept.count() == 0


def test_slices_are_bounded_by_rows_and_bytes():
    texts = ["x" * 10, None, ""] * 40 + ["y" * 500] + ["z"] * 30
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})
    parts = [arrow.values(part, "text", None) for part in arrow.slices(batch, "text", limit=100, rows=16)]
    assert sum(parts, []) == texts
    assert all(0 < len(p) <= 16 and sum(len(t or "") for t in p[1:]) < 100 for p in parts)
    assert list(arrow.slices(batch.slice(0, 0), "text")) == []


def test_many_short_texts_are_judged_as_one_by_one(spark):
    texts = [f"le chat {i}" if i % 2 else f"the cat {i}" for i in range(2500)]
    df = spark.createDataFrame([(i, t, "fr" if i % 2 else "en") for i, t in enumerate(texts)],
                               "doc_id bigint, text string, lang string").coalesce(1)
    rows = language.identify(df, language.learn(df)).collect()
    assert len(rows) == 2500 and all(r["lang_pred"] == r["lang"] for r in rows)


def test_language_on_held_out_texts(spark, odd):
    found = queries.op2_language(spark, SF).where("held_out").join(
        spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    assert found.where("lang = lang_pred").count() >= 0.97 * found.count()
    model = language.learn(spark.read.parquet(f"{SF}/documents.parquet"))
    rows = {r["doc_id"]: r for r in language.identify(odd, model).collect()}
    assert [rows[i]["lang_pred"] for i in (0, 1, 2)] == ["und"] * 3 and all(0 <= r["score"] <= 1 for r in rows.values())
    empty = language.learn(odd)
    assert {r["lang_pred"] for r in language.identify(odd, empty).collect()} <= {"und", "x"}


ITALIAN = ("Nel mezzo del cammin di nostra vita mi ritrovai per una selva oscura che la diritta via era smarrita e quanto a "
           "dir qual era è cosa dura questa selva selvaggia e aspra e forte che nel pensier rinova la paura ")
POLISH = ("Litwo ojczyzno moja ty jesteś jak zdrowie ile cię trzeba cenić ten tylko się dowie kto cię stracił dziś piękność "
          "twą w całej ozdobie widzę i opisuję bo tęsknię po tobie ")


def test_levels_reject_other_languages_and_keep_the_learned_ones(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", "lang")
    rng = random.Random(4)
    noise = [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(150)) for _ in range(5)]
    others = spark.createDataFrame([(-1 - i, t, None) for i, t in enumerate([6 * ITALIAN, 6 * POLISH, *noise])],
                                   "doc_id bigint, text string, lang string")
    fold = docs.where("doc_id % 3 <> 1")
    model = language.learn(fold)
    levels = language.learn_levels(fold, model)
    kept = {r["doc_id"] for r in language.keep_identified(docs.unionByName(others), model, levels).collect()}
    assert not [i for i in kept if i < 0], levels
    lettered = {r["doc_id"] for r in docs.collect() if any(c.isalpha() for c in r["text"] or "")}
    assert kept <= lettered and len(kept) >= 0.998 * len(lettered)


def test_levels_of_histograms(spark):
    cells = np.zeros((language.LENGTHS, language.CELLS), np.int64)
    assert not language.levels_of(cells).any()
    cells[8, 64], cells[8, 128], cells[12, 192] = 1, 1999, 5  # one row of 2,000 is below the quantile; five rows are too few
    levels = language.levels_of(cells)
    assert levels[8] == 0.8 * 128 / 256 and levels[12] == levels[8] and (levels[:8] == levels[8]).all()
    empty = spark.createDataFrame([], "text string, lang string")
    assert not language.learn_levels(empty, language.learn(empty)).any()


def test_bundles_are_sums_of_bound_letters():
    text, d = "abca", 64
    grams, counts = language.Trigrams().count([text])
    vector = language.Space(d).bundle(grams, counts)[0]
    v = language.letter_vectors(d).astype(int)
    s = [0, 1, 2, 3, 1, 0]
    assert vector.tolist() == sum(np.roll(v[a], 2) * np.roll(v[b], 1) * v[c] for a, b, c in zip(s, s[1:], s[2:])).tolist()


def test_quality_and_toxicity_on_held_out_labels(spark, odd):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    for run, label, least in ((queries.op4_quality, "quality", 0.95), (queries.op10_toxicity, "toxic", 0.85)):
        found = run(spark, sf).where("held_out").join(labels, "doc_id")
        assert found.where(F.col("predicted") == F.col(label)).count() >= least * found.count()
    model = quality.learn(odd, odd.select("doc_id", F.lit(1).alias("quality")).where("doc_id < 5"), epochs=1)
    assert quality.score(odd, model).where("score BETWEEN 0 AND 1").count() == len(ODD) + 1
    assert {r["score"] for r in quality.score(odd, quality.learn(odd, labels.limit(0))).collect()} == {0.5}
    model = toxicity.learn(odd, odd.where("doc_id = 11").select("doc_id"), 0.2, least=1)
    assert toxicity.score(odd, model).where("score BETWEEN 0 AND 1").count() == len(ODD) + 1
    model = toxicity.learn(odd, odd.limit(0), 0.2)
    assert all(abs(r["score"] - 0.2) < 1e-9 for r in toxicity.score(odd, model).collect())


def test_confirmed_ids_joined_either_way_give_one_model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    toxic = spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 1")
    one, other = (toxicity.learn(docs, toxic, 0.2, least=2, most_broadcast=n) for n in (0, 1000))
    assert one.number and one.number == other.number and one.bias == other.bias
    assert (one.weights == other.weights).all()


def test_search_and_licences_match_sql(spark):
    con, sql = connect(SF), queries.oracle_sql()
    for name in sql:
        assert difference(queries.QUERIES[name](spark, SF), con, sql[name]) is None, name


def test_search_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, 0.5]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (50, [1.0, -1.0]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (6, [None, 1.0]), (7, []), (100, [2.0]), (2, [0.5, 0.5]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    found = sorted(map(tuple, search.top_k(df, F.col("vec_id") % 50 == 0, k=2, shard_rows=2).collect()))
    assert found == [(0, 1, 1, 32768), (0, 2, 2, 32768), (50, 1, 0, 0), (50, 2, 1, 0)]
    assert search.top_k(df.limit(0), F.lit(True)).count() == 0


def test_licences(spark, odd):
    mit = dict(licences.KNOWN)["MIT"]
    texts = [(1, "Copyright (c) 2020 Some One\n\n" + licences.KNOWN[0][1].replace("sublicense", "sub-license")), (2, mit + " x"),
             (3, "a\nReleased under the MIT LICENCE!\nLicensed under CC BY-NC 4.0."), (4, None)]
    found = {r["doc_id"]: r for r in licences.scan(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()}
    assert (found[1]["licence"], found[2]["licence"], found[4]["licence"]) == ("MIT", None, None)
    assert (found[3]["notices"], found[4]["notices"]) == ("CC-BY-NC-4.0,MIT", "")
    assert licences.scan(odd).count() == len(ODD) + 1


def test_licences_are_the_same_beyond_the_map(spark, odd):
    texts = [(1, licences.KNOWN[0][1]), (2, "a\nReleased under the MIT LICENCE!\nLicensed under CC BY-NC 4.0."), (2, None),
             (None, "Released under the MIT License."), (None, "Released under the MIT License.")]
    for df in (spark.createDataFrame(texts, "doc_id bigint, text string"), odd, odd.limit(0)):
        near, far = licences.scan(df), licences.scan(df, most_known=3)
        assert near.schema.names == far.schema.names
        assert sorted(map(str, near.collect())) == sorted(map(str, far.collect()))
    none = licences.known_digests(spark).limit(0)
    assert {r["notices"] for r in licences.scan(odd, none).collect()} == {""}


def plain_fingerprint(text: str, words: int) -> int:
    word = text.encode().lower().split()
    if not word:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(word[k:k + words]), 42) for k in range(max(1, len(word) - words + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_pipeline_against_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    clean = corpus_pipeline.unrepetitive(spark, corpus_pipeline.identified(spark, docs, SF), SF)
    kept = {r["doc_id"]: r["text"] for r in clean.collect()}
    for i, text in [(r["doc_id"], r["text"]) for r in docs.collect()]:
        words = text.encode().split()
        seen = Counter(zip(words, words[1:], words[2:]))
        again = {k + d for k in range(len(words) - 2) if seen[tuple(words[k:k + 3])] > 1 for d in range(3)}
        assert i not in kept or len(words) >= 50 and 100 * len(again) <= 50 * len(words)
    assert len(kept) > 100
    prints = {i: plain_fingerprint(t, corpus_pipeline.WORDS) for i, t in kept.items()}
    groups = brute_components(prints, corpus_pipeline.RADIUS)
    packed = {r["doc_id"] for r in corpus_pipeline.run(spark, SF).select("doc_id").distinct().collect()}
    assert packed == set(groups.values()) and len(packed) < len(kept)
    whole = spark.createDataFrame(list(kept.items()), "doc_id bigint, text string")
    found = {r["doc_id"]: int(r["fingerprint"], 16) for r in simhash.near_duplicates(whole).collect()}
    assert found == prints


def test_pipeline_stages_take_odd_rows(spark, odd):
    docs = odd.withColumn("kept", F.lit("a")).withColumn("fingerprint", F.lit(1))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0
        out.count()
    assert corpus_pipeline.packed(spark, docs, SF).count() >= len(ODD) + 1


def test_a_rare_toxic_word_counts_over_all_texts(spark):
    word = F.expr("CASE WHEN id % 1000 = 0 THEN ' vilest' WHEN id % 50 = 0 THEN ' foul' ELSE '' END")
    docs = spark.range(20000, numPartitions=4).select(F.col("id").alias("doc_id"), F.concat(F.lit("plain text"), word).alias("text"))
    toxic = docs.where("doc_id % 50 = 0").select("doc_id")  # one in 20 of them has the word
    model = toxicity.learn(docs, toxic, 0.02, most_positive=200, most_unlabelled=200)
    assert "vilest" in model.number and "plain" not in model.number
    assert model.weights[model.number["vilest"]] > 0


def test_the_most_telling_features_are_kept_not_the_commonest(spark):
    rows = [("mild rarest", True)] * 10 + [("mild", True)] * 30 + [("mild", False)] * 20 + [("other", False)] * 200
    df = spark.createDataFrame(rows, "text string, confirmed boolean")
    assert toxicity.telling_features(df, 40 / 260, most=2) == ["^rare", "^rares"]


def test_rows_that_share_an_id_or_have_none_are_told_apart(spark):
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(1, "one text"), (1, "another text"), (1, "another text"), (1, text), (2, text.upper()), (None, text), (None, "third"),
            (None, "third"), (None, "Third")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = [(r["doc_id"], r["text"].lower()) for r in corpus_pipeline.one_of_each(spark, docs, SF).collect()]
    assert sorted(found, key=str) == sorted([(1, "one text"), (1, "another text"), (1, text), (None, "third")], key=str)
