"""Toxicity, LM scoring and token counts against brute force and held-out accuracy."""

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import docs, no_docs
from pyspark.sql import functions as F

from salesmart.llm import lm_scoring, token_counts, toxicity

public_tokenizers = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    return token_counts.read_vocabulary(MODEL)


# --- token counts ---------------------------------------------------------

def odd_texts(n=1500, seed=7):
    rng = random.Random(seed)
    parts = ["a", "b ", " ", "  ", "\t", "\n", "▁", "é", "漢", "\U0001f600", "x01", ".", "-", "the ", "ing", "<s>", "</s>",
             "\x00", "don't", " " * 17, " " * 90, "word" * 9]
    return ["", " ", "  "] + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 14))) for _ in range(n)]


def test_counts_equal_the_library(vocabulary):
    words = token_counts.WordCounts(token_counts.Transducer(vocabulary))
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for text in odd_texts():
        assert token_counts.count_text(text, words) == len(library.encode(text)), repr(text)


def test_state_maps_compose_at_any_cut(vocabulary):
    words = token_counts.WordCounts(token_counts.Transducer(vocabulary))
    rng = random.Random(8)
    for text in odd_texts(400, 9):
        whole = " " + text.replace("▁", " ")
        cuts = sorted(rng.randrange(len(whole) + 1) for _ in range(rng.randint(0, 6)))
        maps = [token_counts.state_map(whole[a:b], words) for a, b in itertools.pairwise([0, *cuts, len(whole)])]
        want = token_counts.counted(whole, words)
        assert token_counts.map_count(token_counts.scan(maps, words)[-1], words) == want
        left = maps[0]
        for m in maps[1:]:
            left = token_counts.compose(left, m, words)
        assert token_counts.map_count(left, words) == want


def test_token_counts_of_whole_tables(spark, vocabulary):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for chunk_bytes in (1 << 20, 100):  # the second cuts most texts into pieces
        got = token_counts.token_counts(docs(spark, extra=["n_tokens"]), vocabulary, chunk_bytes=chunk_bytes).collect()
        want = sorted(str((r["doc_id"], len((r["text"] or "").encode()), len(library.encode(r["text"] or ""))))
                      for r in docs(spark).collect())
        assert sorted(str(tuple(r)) for r in got) == want
    assert token_counts.token_counts(no_docs(spark), vocabulary).count() == 0


# --- LM scoring -----------------------------------------------------------

def brute_paths(word, pieces):
    """Sum over all segmentations of the products of piece probabilities."""
    sums = [1.0] + [0.0] * len(word)
    for end in range(1, len(word) + 1):
        sums[end] = sum(sums[begin] * pieces.get(word[begin:end], 0.0) for begin in range(end))
    return sums[-1]


def test_lattice_sums_match_brute_force():
    rng = random.Random(10)
    pieces = sorted({bytes([b]) for b in b" abc"} | {b"ab", b"abc", b" a", b" ab", b"ca", b"bcab"})
    p = np.array([rng.random() for _ in pieces])
    p /= p.sum()
    table = dict(zip(pieces, p))
    lattice = lm_scoring.Lattice(pieces, np.log(p))
    words = [bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 9))) for _ in range(60)] + [b"abc" * 50]
    for at, codes in lm_scoring.same_length(words):
        got = lattice.log_marginals(codes)
        for i, value in zip(at, got):
            assert value == pytest.approx(math.log(brute_paths(b" " + words[i], table)))
        expected = np.zeros(len(pieces))
        lattice.add_expected(codes, expected)
        # Each word's expected pieces cover its bytes exactly once.
        assert (expected * [len(x) for x in pieces]).sum() == pytest.approx(codes.size)


def test_scores_of_a_small_corpus(spark, vocabulary):
    rng = random.Random(11)
    words = ["alpha", "beta", "Gamma", "delta.", "été", "x"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 30))) + (" unseen" + str(i) if i % 9 == 0 else ""),
             "en", "s", 1) for i in range(80)] + [(100, None, None, None, None), (101, "", "en", "s", 0), (101, "", "en", "s", 0)]
    import zlib

    out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, *_ in rows}
    trained, texts = Counter(), 0
    for i, text, *_ in rows:
        if not out[i]:
            trained.update((text or "").encode().lower().split())
            texts += 1
    n, v = sum(trained.values()) + texts, len(trained) + 1
    results = [lm_scoring.score(docs(spark, rows, ["score"]), vocabulary, most_frequent=m).collect() for m in (3, 1000)]
    for got in results:
        assert len(got) == len(rows)
        texts_by_id = {r[0]: r[1] for r in rows}
        for r in got:
            tokens = (texts_by_id[r["doc_id"]] or "").encode().lower().split()
            base = sum(math.log10((trained[w] + 1) / (n + v + 1)) for w in tokens) + math.log10((texts + 1) / (n + v + 1))
            assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (out[r["doc_id"]], len(tokens) + 1, n)
            assert r["n_known"] == sum(w in trained for w in tokens) + 1
            assert r["base_score"] == pytest.approx(base) and r["score"] < 0
    first, second = ({(r["doc_id"], round(r["score"], 9)) for r in got} for got in results)
    assert first == second
    scores = {r["doc_id"]: r["score"] for r in results[0]}
    assert scores[0] < scores[100]  # an unseen word costs more than none
    assert lm_scoring.score(no_docs(spark), vocabulary).count() == 0


# --- toxicity -------------------------------------------------------------

def brute_kernel(s, t, order=toxicity.ORDER, decay=toxicity.DECAY):
    return sum(decay ** (a[-1] - a[0] + 1 + b[-1] - b[0] + 1)
               for a in itertools.combinations(range(len(s)), order)
               for b in itertools.combinations(range(len(t)), order)
               if all(s[i] == t[j] for i, j in zip(a, b)))


def test_kernel_matches_brute_force():
    rng = random.Random(12)
    strings = ["".join(rng.choice("abcd") for _ in range(rng.randint(3, 8))) for _ in range(12)]
    a, b = toxicity._codes(strings, 8, -1), toxicity._codes(strings[::-1], 8, -2)
    assert toxicity.raw_kernel(a, b) == pytest.approx([brute_kernel(s, t) for s, t in zip(strings, strings[::-1])])
    values = toxicity.Kernel(["idiot", "trash"]).values(["idiot", "idxiot", "table", "trasch", "xx" * 20])
    assert values[0, 0] == pytest.approx(1) and 0.4 < values[1, 0] < 1 and values[2].max() < 0.3 and 0.4 < values[3, 1] < 1


def test_units_are_folded():
    assert toxicity.units_of("You ID-10T! m.o.r.o.n") [:4] == [b"you", b"idiot", b"moron"][:4]
    assert b"scum" in toxicity.units_of("such s c u m here")
    assert toxicity.unit_windows("a" * 100) == ["a" * 40] * 4


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(13)
    syllables = ["ta", "lo", "mi", "ren", "do", "ka", "ste", "vu", "pel", "non"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    insults = ["idiot", "moron", "scumbag", "worthless"]
    rows, labels = [], []
    for i in range(500):
        toxic = i % 4 == 0
        words = [word() for _ in range(rng.randint(5, 60))]
        if toxic:
            for _ in range(2):
                words.insert(rng.randrange(len(words)), rng.choice(insults))
        rows.append((i, " ".join(words) + ".", "en", "s", 1))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_held_out_accuracy(spark, labelled):
    rows, labels = labelled
    gapped = [(1000, "ta lo id-iot mi ren w.o.r.t.h.l.e.s.s do", "en", "s", 1), (1001, "ren do ta m0ron lo i d i o t", "en", "s", 1),
              (1002, "ren worthxless do ta scuumbag lo", "en", "s", 1), (1003, "ta lo mi ren do", "en", "s", 1)]
    frame = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    model = toxicity.train(docs(spark, rows), frame)
    scored = toxicity.scored(docs(spark, rows + gapped, ["score"]), model).withColumn(
        "out", toxicity.held_out(F.col("doc_id"))).collect()
    truth = {i: t for i, _, t in labels}
    held = [(truth[r["doc_id"]], r["score"]) for r in scored if r["out"] and r["doc_id"] in truth]
    assert len(held) > 100 and sum((s >= toxicity.CUT) == bool(t) for t, s in held) >= 0.97 * len(held)
    by_id = {r["doc_id"]: r["score"] for r in scored}
    assert min(by_id[1000], by_id[1001], by_id[1002]) > 0.5 > by_id[1003]
    kept = toxicity.without_toxic(docs(spark, rows), frame)
    assert kept.columns == docs(spark).columns and 360 <= kept.count() <= 380


def test_toxicity_of_odd_rows(spark, labelled):
    rows, labels = labelled
    frame = spark.createDataFrame(labels + [(None, 1, 1), (3, None, None), (8, 1, 0)], "doc_id bigint, quality int, toxic int")
    model = toxicity.train(docs(spark, rows), frame)
    got = toxicity.scored(docs(spark), model).collect()
    assert len(got) == 10 and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.scored(no_docs(spark), model).count() == 0
    for only, share in ((0, 0.0), (1, 1.0)):
        constant = toxicity.train(docs(spark, rows), frame.where(f"toxic = {only}"))
        assert {r["score"] for r in toxicity.scored(docs(spark), constant).collect()} == {share}
    assert toxicity.train(no_docs(spark), frame) == {"constant": 0.0}


def test_kernel_values_are_whole():
    """Words with a character put between all letters keep their true kernel value, however low."""
    landmarks, gapped = ["stupid", "pathetic", "worthless"], ["sxtxuxpxixd", "pxaxtxhxextxixc", "wxoxrxtxhxlxexsxs"]
    words = gapped + ["zz9", "stoop", "été"]
    marked = lambda s: f"\x02{s}\x03"
    want = np.array([[brute_kernel(marked(w), marked(t))
                      / math.sqrt(brute_kernel(marked(w), marked(w)) * brute_kernel(marked(t), marked(t)))
                      for t in landmarks] for w in words])
    kernel = toxicity.Kernel(landmarks)
    got = kernel.values(words)
    assert got == pytest.approx(want, abs=1e-6) and 0.1 < got.diagonal().min() and got.diagonal().max() < 0.2
    weights = np.array([0.5, -2.0, 1.5])
    assert kernel.weighed(words, weights) == pytest.approx(want @ weights, abs=1e-6)
    known = toxicity.WordValues(landmarks, weights.tolist(), "value")
    known.learn({w.encode() for w in words})
    assert known.known.keys() == {w.encode() for w in words}
    kernel.place = None  # as with so many letters that the table is searched, not indexed
    assert kernel.values(words) == pytest.approx(want, abs=1e-6)


def test_fully_gapped_insults_rank_above_clean_words(spark, labelled):
    rows, labels = labelled
    gapped = [(2000, "ta lo wxoxrxtxhxlxexsxs mi ren do ka", "en", "s", 1),
              (2001, "ren do sxcxuxmxbxaxg ta lo mi pel", "en", "s", 1), (2002, "ren do ta lo mi pel", "en", "s", 1)]
    model = toxicity.train(docs(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    score = {r["doc_id"]: r["score"] for r in toxicity.scored(docs(spark, gapped), model).collect()}
    assert min(score[2000], score[2001]) > 5 * score[2002]


def test_units_bridge_blanks():
    for text in ("i - d - i - o - t", "i d i  o\tt", "1 d 1 0 t", "i · d · i · o · t"):
        assert b"idiot" in toxicity.units_of(f"you {text} there"), text
    assert "imbécil".encode() in toxicity.units_of("un i m b é c i l aquí")
    assert "дурак".encode() in toxicity.units_of("ты д у р а к")
    units = toxicity.every_unit("an id iot, a mo r on or worth less; shut up")
    assert {b"idiot", b"moron", b"worthless", b"shutup"} <= units


def test_split_insults_count(spark, labelled):
    rows, labels = labelled
    split = [(3000, "ta lo mi id iot mi ren do ka stelo", "en", "s", 1), (3001, "ren do ta i - d - i - o - t pel", "en", "s", 1),
             (3002, "ren do ta worth less lo mi pel", "en", "s", 1), (3003, "ren do ta lo mi pel", "en", "s", 1)]
    model = toxicity.train(docs(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    score = {r["doc_id"]: r["score"] for r in toxicity.scored(docs(spark, split), model).collect()}
    assert min(score[3000], score[3001], score[3002]) > 0.5 > score[3003], score


def test_highest_values_are_those_of_valuing_every_unit():
    draw = random.Random(4)
    landmarks = ["idiot", "moron", "table", "window", "aabbaabb", "éclair"]
    weights = [1.5, 2.0, -1.0, -0.5, 0.7, 0.3]
    values = toxicity.WordValues(landmarks, weights, "value")
    plain = toxicity.WordValues(landmarks, weights, "value")
    word = lambda: "".join(draw.choice("abdeilmnorstwé") for _ in range(draw.randrange(1, 14)))
    texts = ["", "a b", "x" * 95 + " idiot", "idioot " * 3, "aaa bbb"] + [
        " ".join(word() for _ in range(draw.randrange(1, 60))) for _ in range(150)]
    for part in toxicity._slices(values, texts, 40):
        units = [words for _, words in part]
        plain.learn(set().union(*units))
        want = [sorted((plain.known[w] for w in words if w in plain.known), reverse=True)[:3] for words in units]
        assert [len(x) for x in values.highest(units, 3)] == [len(x) for x in want]
        for a, b in zip(values.highest(units, 3), want):
            assert a == pytest.approx(b, abs=1e-9)


def test_units_as_ranges_are_those_of_every_text():
    draw = random.Random(6)
    word = lambda: "".join(draw.choice("abcé1.") for _ in range(draw.randrange(1, 7)))
    texts = ["", " ", "a", "a b c d", "ab c a bc", "i d i o t", "you i - d i  o\tt, 1 d", "ид иот д у р а к", "x" * 95 + " a x",
             "\xa0 a\xa0b \u2003 c", "a\x1cb \x1c c", "\x00 a\x00", "ΑΣ Σ", "İ i", "\U0001f600 a \U0001f600"] + [
        draw.choice(" \n").join(word() for _ in range(draw.randrange(0, 40))) for _ in range(200)]
    for most in (toxicity.JOINED, 20):
        units = toxicity.Units.of_texts(texts, most)
        want = [toxicity.every_unit(t, most) for t in texts]
        strings = units.strings(np.arange(len(units.begin)))
        got = [[] for _ in texts]
        for doc, unit in zip(units.doc.tolist(), units.unit.tolist()):
            got[doc].append(strings[unit].encode())
        assert [sorted(g) for g in got] == [sorted(w) for w in want]
        assert units.counts.tolist() == [len(w) for w in want]
        assert len(strings) == len(set(strings)) == len(set().union(*want))
    # A blank outside ASCII is part of its word: seven characters together, not five.
    assert "aaaa\xa0b\xa0".encode() not in toxicity.every_unit("aaaa\xa0b \xa0 c", 5)


def test_scoring_makes_no_set_of_strings(monkeypatch):
    """Scoring 500 texts puts the units of whole slices into arrays; strings are made of the few valued only."""
    draw = random.Random(8)
    word = lambda: "".join(draw.choice("abdeilmnorstw") for _ in range(draw.randrange(2, 8)))
    texts = [" ".join(word() for _ in range(200)) + " idioot" for _ in range(500)] + [None, ""]
    landmarks, weights = ["idiot", "moron", "table"], [1.5, 2.0, -1.0]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    plain = toxicity.WordValues(landmarks, weights, "value")
    want = []
    for text in texts[-50:]:
        plain.learn(units := plain.units(text or ""))
        best = sorted((plain.known[w] for w in units if w in plain.known), reverse=True)[:3]
        want.append(toxicity.document_features(best, len(units)))
    made, strings = [], toxicity.Units.strings
    monkeypatch.setattr(toxicity.Units, "strings", lambda self, units: made.append(len(units)) or strings(self, units))
    monkeypatch.setattr(toxicity, "every_unit", None)
    monkeypatch.setattr(toxicity, "SLICE_CHARS", 100_000)
    got = [row for out in toxicity._featured(landmarks, weights, 1, [0])([batch]) for row in out.column(1).to_pylist()]
    assert len(got) == len(texts) and 0 < sum(made) < 20_000
    for a, b in zip(got[-50:], want):
        assert a == pytest.approx(b, abs=1e-6)


def test_toxicity_of_texts_without_units(spark):
    rows = [(i, "a b" if i % 2 else "c d", "en", "a", 3) for i in range(40)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(40)], "doc_id bigint, quality int, toxic int")
    scores = {r.score for r in toxicity.scored(docs(spark, rows), toxicity.train(docs(spark, rows), labels)).collect()}
    assert scores == {0.5}


@pytest.mark.parametrize("parts", [1, 2, 7])
def test_training_sample_is_bounded_and_the_same(spark, parts):
    rows = [(8, f"text {i} of one id", "en", "a", 1) for i in range(300)] + [(2, "both", "en", "a", 1), (5, "both", "en", "a", 1)]
    labels = spark.createDataFrame([(8, 1, 0), (2, 1, 1), (5, 1, 0), (9, 1, 1)], "doc_id bigint, quality int, toxic int")
    kept = [i for i in (2, 5, 8) if zlib.crc32(str(i).encode()) % 3 != 1]
    got = toxicity.training_sample(docs(spark, rows).repartition(parts), labels, most=5).collect()
    assert len(got) == 5 * (8 in kept) + (2 in kept or 5 in kept)
    assert {r.s_label for r in got if r.s_text == "both"} <= {1 if 2 in kept else 0}
    again = toxicity.training_sample(docs(spark, rows).repartition(3), labels, most=5).collect()
    assert [tuple(r) for r in sorted(got)] == [tuple(r) for r in sorted(again)]


def test_without_toxic_keeps_columns_that_clash(spark, labelled):
    rows, labels = labelled
    frame = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    kept = toxicity.without_toxic(docs(spark, rows, ["tox_score", "score"]), frame)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "tox_score", "score"]
    assert {(r.tox_score, r.score) for r in kept.collect()} == {("clash", "clash")}
