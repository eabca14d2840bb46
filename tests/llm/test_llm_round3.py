"""Fill-in-middle, the Merkle manifest and MinHash near-duplicates against brute force."""

import random
import re
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from helpers import EMPTY, ROWS, docs, no_docs
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from salesmart.llm import fill_in_middle as fim, merkle, minhash

SPACE = r"\x20\x09-\x0D"
UNIT = re.compile(rf"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")


def units(text):
    return UNIT.findall(text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=" \t\nab \U0001f600<", max_size=60), st.integers(1, 20))
def test_units_do_not_depend_on_the_blocks(text, block):
    ends, at = [], 0
    for unit in units(text):
        at += len(unit)
        ends.append(at)
    assert list(fim.unit_ends(text, block)) == ends


def test_units_of_very_long_texts():
    text = "word  \n" * 400_000 + "x" * 3_000_000 + " " * 2_500_000 + "end" + " " * 5
    ends = fim.unit_ends(text)
    assert len(ends) == 400_000 + 3 and ends[-1] == len(text) and ends[0] == 4


def expected(doc_id, text):
    cut = units(text)
    n = len(cut)
    h = sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    if not text or h3 % 100 >= 50 or re.search("<[PSM]>", text):
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(cut[:a]), "".join(cut[a:b]), "".join(cut[b:])
    if h4 % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle_matches_brute_force(spark):
    rows = ROWS + [(i, f"a{i} <  b\t<S c {'<S>' * (i % 7 == 0)} d\U0001f600 e\n", "en", "a", i) for i in range(100, 200)]
    rows += [(10, "same text again and again", "en", "a", 1)] * 60
    df = fim.fill_in_middle(docs(spark, rows, ["N", "form", "f_row"])).withColumn(
        "back", fim.restored(F.col("output"), F.col("form")))
    got = df.collect()
    assert df.columns == ["doc_id", "text", "lang", "source", "n_chars", "f_row", "n", "form", "prefix_chars",
                          "middle_chars", "output", "back"]
    assert sorted(map(str, ((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got))) == sorted(
        map(str, ((r[0], *expected(r[0], r[1] or "")) for r in rows)))
    assert all(r.back == (r.text or "") and r.f_row == "clash" for r in got)
    assert {r.form for r in got} == {"plain", "spm", "psm"}
    assert fim.fill_in_middle(no_docs(spark)).count() == 0


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, lower=False):
    doc_id, text, lang, source, n_chars = row
    if lower and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return H(*map(field, (doc_id, source, lang, n_chars, text)))


def tower(hashes):
    """(top, for each node its (left, right) siblings by level)."""
    proofs, at, level = [[] for _ in hashes], list(range(len(hashes))), list(hashes)
    while len(level) > 1:
        runs = [level[i:i + 16] for i in range(0, len(level), 16)]
        for k, i in enumerate(at):
            run, j = runs[i // 16], i % 16
            proofs[k].append(("".join(run[:j]), "".join(run[j + 1:])))
        at, level = [i // 16 for i in at], [H(*run) for run in runs]
    return level[0], proofs


def brute_manifest(rows):
    trees = defaultdict(list)
    for row in rows:
        trees[row[3]].append((row[0] is not None, row[0] or 0, leaf_of(row), leaf_of(row, True)))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    tops = {s: tower([x[2] for x in sorted(trees[s])]) for s in names}
    root, above = tower([tops[s][0] for s in names])
    out = []
    for i, s in enumerate(names):
        for (named, key, leaf, lowered), proof in zip(sorted(trees[s]), tops[s][1]):
            proof = proof + above[i]
            now = lowered if named and zlib.crc32(str(key).encode()) % 5 == 0 else leaf
            for left, right in proof:
                now = H(left, now, right)
            out.append((key if named else None, leaf, tops[s][0], root, H(*[x for p in proof for x in p]), now, now == root))
    return out


def merkle_rows():
    rows = list(ROWS) + [(7000 + i, f"Text {i}", "en", "big", i) for i in range(300)]
    rows += [(i, "T", None, f"s{i:03d}", 1) for i in range(40)] + [(8000 + i, "Lone", "x", "sixteen", 4) for i in range(16)]
    rows += [(8100 + i, None, "x", "é", None) for i in range(17)] + [(None, "Hot", "en", "hot", 3)] * 280
    random.Random(3).shuffle(rows)
    return rows


@pytest.mark.parametrize("digits", [1, 2, 3])
def test_merkle_manifest_matches_brute_force(spark, digits):
    rows = merkle_rows()
    df = docs(spark, rows, ["m_tree", "n_hash", "kids"]).repartition(5)
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lowered = merkle.leaf_digest(*[F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
                                   if f == "text" else F.col(f) for f in merkle.FIELDS])
    made = merkle.manifest(df, carry=F.when(chosen, lowered), digits=digits)
    got = made.select("m_key", "m_leaf", "m_subroot", "m_root", merkle.digest(merkle.proof_text(F.col("m_proof"))),
                      merkle.folded(F.coalesce("m_carry", "m_leaf"), F.col("m_proof")).alias("f")).withColumn(
                          "ok", F.col("f") == F.col("m_root")).collect()
    want = brute_manifest(rows)
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert any(not w[-1] for w in want) and sum(w[-1] for w in want) > 0.8 * len(want)


def test_merkle_manifest_of_one_row_and_of_none(spark):
    one = merkle.manifest(docs(spark, ROWS[:1])).first()
    assert one.m_leaf == one.m_subroot == one.m_root == leaf_of(ROWS[0]) and one.m_proof == []
    assert merkle.manifest(no_docs(spark)).count() == 0


def shingles(text, words=4):
    w = re.findall(rf"[^{SPACE}]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()


def brute_components(rows, share=80):
    sets = [shingles(r[1]) for r in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= share * (len(sets[i]) + len(sets[j]) - both) and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    least = {}
    for g, r, s in zip(group, rows, sets):
        if r[0] is not None:
            least[g] = min(least.get(g, r[0]), r[0])
    return [(r[0], len(s), least.get(g)) for g, r, s in zip(group, rows, sets)]


def near_rows():
    """Chains and families of near copies, a passage that many share, a third of all rows equal, nulls."""
    draw = random.Random(11)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(6))
    rows, at = list(ROWS), 1000
    base = [word() for _ in range(60)]
    for _ in range(40):  # a family: one word changed
        rows.append((at, " ".join(base[:20] + [word()] + base[21:]), "en", "a", 0))
        at += 1
    chain = [word() for _ in range(80)]
    for _ in range(25):  # a chain: each changes the one before
        chain[draw.randrange(80)] = word()
        rows.append((at, " ".join(chain), "en", "a", 0))
        at += 1
    passage = [word() for _ in range(40)]
    for _ in range(60):  # a passage that makes up half of each
        rows.append((at, " ".join(passage + [word() for _ in range(draw.randrange(5, 40))]), "en", "a", 0))
        at += 1
    rows += [(at + i, "Copies  of one TEXT that\tmany rows hold", "en", "hot", 0) for i in range(60)]
    rows += [(None, "rows without an id that are alike", "en", "hot", 0)] * 30 + [(5000, " ".join(passage[:3]), "en", "a", 0)]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("cap,depth", [(512, 3), (6, 3), (6, 1), (2, 2)])
def test_minhash_components_match_brute_force(spark, cap, depth):
    rows = near_rows()
    got = minhash.near_duplicates(docs(spark, rows, ["p_id", "c", "p_key"]), cap=cap, depth=depth).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute_components(rows)))


def test_minhash_of_an_empty_table(spark):
    assert minhash.near_duplicates(no_docs(spark)).count() == 0
    blank = spark.createDataFrame([(1, None, None, None, None), (2, " \t", None, None, None)], EMPTY)
    assert sorted(map(tuple, minhash.near_duplicates(blank).collect())) == [(1, 0, 1), (2, 0, 2)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["a", "B", "cc", " ", "\n", "\x0b", "é"]), max_size=60), st.integers(1, 12))
def test_shingles_do_not_depend_on_the_blocks(parts, block):
    text = "".join(parts).encode()
    whole = minhash.shingle_hashes(text, 4, 1 << 30)
    assert minhash.shingle_hashes(text, 4, block).tolist() == whole.tolist()
    assert len(whole) == len(shingles(text.decode()))


def test_signatures_estimate_the_likeness():
    draw = random.Random(5)
    for share in (0.8, 0.5, 0.1):
        a = [draw.getrandbits(64) for _ in range(900)]
        both = round(len(a) * 2 * share / (1 + share))
        b = a[:both] + [draw.getrandbits(64) for _ in range(len(a) - both)]
        x, y = (minhash.signature(minhash.np.array(sorted(v), dtype=minhash.np.uint64)) for v in (a, b))
        assert abs((x == y).mean() - share) < 0.15
    assert minhash.least_equal(80) == 77 and minhash.least_equal(100) == minhash.HASHES
