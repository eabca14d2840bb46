"""MinHash near-duplicates: classes of documents whose shingle sets overlap.

A document's set holds its distinct word shingles.  Documents link when the
intersection of their sets has at least ``share`` of 100 parts of the union;
a document's component is the smallest id it reaches over links.

Method: ``HASHES`` strongly universal hash functions (multiply, add, shift on
32 bits of a shingle's XXH64) give a signature of minima.  Bands of ``ROWS``
minima are bucket keys; sets at the threshold share no band with probability
(1 - 0.8**4)**32, under 1e-7.  Pairs that meet in a bucket are checked on their
signatures, 5.6 standard deviations below the threshold, and then on the full
sets.  Components come from alternating large- and small-star steps.

Scale: equal sets are one class from the start.  No bucket is expanded into
pairs.  First every member of a bucket meets only the bucket's lead, the class
with the most company in its bands, and each class is verified against the best
of these partners; this joins a family of near copies, however large, in one
star around its original.  Then only buckets that hold several components are
left.  One with more than ``CAP`` members outside its
largest component is split by the minima of further bands, which drives apart
sets that share a passage only.  What is left is cut into parts of at most
``CAP`` members; the parts outside the largest component meet each other and
the parts of it, a task at a time.  The signatures show which members of a
meeting have a partner there, the full sets of those are fetched, and the task
returns links that join components, at most one less than its members.  Parts
always complete the work: nothing is capped.  Joins on hot classes are plain
equi-joins, which AQE splits.  All steps are written to the shared folder; the
driver sees counts only.

Defined cases: a text of fewer words than a shingle is one shingle; a null or
wordless text has the empty set, links with nothing and is its own component.
Repeated rows keep their rows and are one class.  A null id never is a
component's smallest id; if a component has no other, its id is null.  Very
long texts are hashed in blocks of whole words.  An empty table gives an empty
result.  Only key and text are read, so extra columns cannot clash.
"""

from __future__ import annotations

import math
import re
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from salesmart.llm.common import written
from salesmart.llm.simhash import components

SHINGLE_WORDS = 4
SHARE = 80
ROWS, BANDS = 4, 32
HASHES = ROWS * BANDS
CAP = 512
DEPTH = 3
BLOCK_BYTES = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_DRAWN = np.random.Generator(np.random.PCG64(13)).integers(0, 1 << 64, size=(2, HASHES), dtype=np.uint64)
_FACTORS, _TERMS = _DRAWN[0] | np.uint64(1), _DRAWN[1]


def shingle_hashes(text: bytes, words: int = SHINGLE_WORDS, block: int = BLOCK_BYTES) -> np.ndarray:
    """The sorted distinct XXH64 of the word shingles of one UTF-8 text; ASCII letters count as lower case."""
    digest, found, tail, at = xxhash.xxh64_intdigest, [], [], 0
    while at < len(text):
        stop = _SPACE.search(text, at + block) if at + block < len(text) else None
        until = stop.start() if stop else len(text)
        tokens = tail + text[at:until].lower().split()
        at = until
        if len(tokens) < words:
            tail = tokens
            continue
        tail = tokens[len(tokens) - words + 1:]
        joined = b" ".join(tokens)
        ends = np.cumsum(np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens)) + 1)
        starts = np.concatenate(([0], ends[:-words])).tolist()
        stops = (ends[words - 1:] - 1).tolist()
        found.append(np.unique(np.fromiter((digest(joined[a:b]) for a, b in zip(starts, stops)),
                                           dtype=np.uint64, count=len(starts))))
    if not found:
        return np.array([digest(b" ".join(tail))] if tail else [], dtype=np.uint64)
    return found[0] if len(found) == 1 else np.unique(np.concatenate(found))


def signature(hashes: np.ndarray) -> np.ndarray:
    """The least value of every hash function over a set of shingle hashes."""
    keys = hashes >> np.uint64(32)
    least = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint64)
    for at in range(0, len(keys), 1024):
        values = (_FACTORS[:, None] * keys[None, at:at + 1024] + _TERMS[:, None]) >> np.uint64(32)
        np.minimum(least, values.min(axis=1), out=least)
    return least.astype(np.uint32)


def least_equal(share: int = SHARE) -> int:
    """Equal minima that two sets at the threshold have but for a chance of about 1e-8."""
    t = share / 100
    return max(1, math.floor(HASHES * t - 5.6 * math.sqrt(HASHES * t * (1 - t))))


def prints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """(p_id, p_text, p_n, p_key, p_sig): the text's digest, the set's size, digest and signature."""
    def run(batches):
        for batch in batches:
            sizes, keys, signatures = [], [], []
            for value in batch.column(2).to_pylist():
                hashes = shingle_hashes(value or b"", words)
                sizes.append(len(hashes))
                keys.append(xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None)
                signatures.append(signature(hashes).tobytes() if len(hashes) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, type=pa.int64()), pa.array(keys, type=pa.binary()),
                 pa.array(signatures, type=pa.binary())], names=["p_id", "p_text", "p_n", "p_key", "p_sig"])

    rows = docs.select(F.col(key).cast("long").alias("p_id"), F.md5(F.col(text).cast("binary")).alias("p_text"),
                       F.col(text).cast("binary").alias("p_body"))
    return rows.mapInArrow(run, "p_id bigint, p_text string, p_n bigint, p_key binary, p_sig binary")


def _band_keys(first, seed):
    """An array of (band, key) of the bands from ``first`` on; ``seed`` is hashed into the key."""
    return F.transform(
        F.sequence(first, F.lit(BANDS - 1)),
        lambda i: F.struct(i.cast("byte").alias("band"),
                           F.xxhash64(seed, i, F.substring(F.col("c_sig"), i * (4 * ROWS) + 1, F.lit(4 * ROWS))).alias("key")))


def _equal_minima(pairs: DataFrame, classes: DataFrame, share: int) -> DataFrame:
    """(a, b, equal) of the pairs whose signatures and sizes allow a link."""
    least = least_equal(share)

    def run(batches):
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), dtype=np.uint32).reshape(-1, HASHES) for i in (2, 3))
            equal = (x == y).sum(axis=1)
            kept = pa.array(equal >= least)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(equal, type=pa.int64())],
                                             names=["a", "b", "equal"]).filter(kept)

    one = classes.select(F.col("c").alias("a"), F.col("c_n").alias("a_n"), F.col("c_sig").alias("a_sig"))
    two = classes.select(F.col("c").alias("b"), F.col("c_n").alias("b_n"), F.col("c_sig").alias("b_sig"))
    sized = pairs.join(two, "b").join(one, "a").where(
        F.least("a_n", "b_n") * 100 >= F.greatest("a_n", "b_n") * share)
    return sized.select("a", "b", "a_sig", "b_sig").mapInArrow(run, "a bigint, b bigint, equal bigint")


def class_sets(wanted: DataFrame, classes: DataFrame, docs: DataFrame, text: str, words: int) -> DataFrame:
    """(s, s_set), written: the shingle hashes of the classes ``c`` of ``wanted``, from one text of each."""
    def run(batches):
        for batch in batches:
            sets = [shingle_hashes(value, words).view(np.int64) for value in batch.column(1).to_pylist()]
            ends = np.cumsum([0, *map(len, sets)])
            values = pa.array(np.concatenate(sets) if sets else np.empty(0, dtype=np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.LargeListArray.from_arrays(pa.array(ends, type=pa.int64()), values)
                 .cast(pa.list_(pa.int64()))], names=["s", "s_set"])

    named = wanted.distinct().join(classes.select("c", "c_text"), "c")
    bodies = docs.select(F.md5(F.col(text).cast("binary")).alias("b_text"), F.col(text).cast("binary").alias("b_body"))
    one_each = (bodies.join(named, F.col("b_text") == F.col("c_text")).groupBy("c")
                .agg(F.first("b_body").alias("b_body")))
    return written(one_each.mapInArrow(run, "s bigint, s_set array<bigint>"), "minhash-sets")


def linked(pairs: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """The pairs (a, b) of classes whose full sets overlap enough, written."""
    found = (pairs.join(sets.select(F.col("s").alias("b"), F.col("s_set").alias("b_set")), "b")
             .join(sets.select(F.col("s").alias("a"), F.col("s_set").alias("a_set")), "a")
             .select("a", "b", F.size("a_set").alias("a_n"), F.size("b_set").alias("b_n"),
                     F.size(F.array_intersect("a_set", "b_set")).alias("both")))
    return written(found.where(F.col("both") * 100 >= (F.col("a_n") + F.col("b_n") - F.col("both")) * share)
                   .select("a", "b"), "minhash-links")


def _open_buckets(members: DataFrame) -> DataFrame:
    """``members`` (band, key, c, comp) of the buckets with several components, with ``big``, the largest
    component, and the rows in and outside it: ``inside``, ``outside``."""
    by_comp = members.groupBy("band", "key", "comp").agg(F.count(F.lit(1)).alias("rows"))
    stats = by_comp.groupBy(F.col("band").alias("o_band"), F.col("key").alias("o_key")).agg(
        F.max(F.struct("rows", "comp")).alias("most"), F.sum("rows").alias("all"), F.count(F.lit(1)).alias("comps"))
    stats = stats.where(F.col("comps") > 1).select(
        "o_band", "o_key", F.col("most.comp").alias("big"), F.col("most.rows").alias("inside"),
        (F.col("all") - F.col("most.rows")).alias("outside"))
    return members.join(stats, (F.col("band") == F.col("o_band")) & (F.col("key") == F.col("o_key"))).drop("o_band", "o_key")


_GROUP = ["band", "key", "t", "q"]


def _dealt(state: DataFrame, cap: int) -> DataFrame:
    """The members of ``state`` in the groups in which parts of their buckets meet: (band, key, t, q, side, c, comp).

    A bucket of at most ``cap`` rows is one part.  In a larger one the largest
    component and the others have parts of their own; parts of the largest
    component need not meet each other.
    """
    small = F.col("inside") + F.col("outside") <= cap
    free = F.when(small, F.lit(1)).otherwise(F.ceil(F.col("outside") / cap)).cast("int")
    bound = F.when(small, F.lit(0)).otherwise(F.ceil(F.col("inside") / cap)).cast("int")
    is_free = small | (F.col("comp") != F.col("big"))
    mix = F.xxhash64("c", F.lit(1))
    own = F.when(is_free, F.pmod(mix, F.col("free"))).otherwise(F.col("free") + F.pmod(mix, F.col("bound"))).cast("int")
    partners = F.sequence(F.lit(0), F.when(is_free, F.col("free") + F.col("bound")).otherwise(F.col("free")) - 1)
    meets = F.transform(partners, lambda other: F.struct(
        F.least(other, F.col("own")).alias("t"), F.greatest(other, F.col("own")).alias("q"),
        (other < F.col("own")).cast("int").alias("side")))
    return (state.withColumns({"free": free, "bound": bound}).withColumn("own", own)
            .select("band", "key", "c", "comp", F.explode(meets).alias("m"))
            .select("band", "key", "m.t", "m.q", "m.side", "c", "comp"))


def _by_group(dealt: DataFrame, work, schema: str) -> DataFrame:
    """``work(rows)`` of every group of ``dealt``: rows without the group's key, those of side 0 first."""
    names = [field.split()[0] for field in schema.split(", ")]
    types = {"byte": pa.int8(), "int": pa.int32(), "bigint": pa.int64()}
    kinds = [types[field.split()[1]] for field in schema.split(", ")]

    def batch_of(out):
        return pa.RecordBatch.from_arrays(
            [pa.array([int(row[i]) for row in out], type=kind) for i, kind in enumerate(kinds)], names=names)

    def run(batches):
        now, rows, out = None, [], []
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if row[:4] != now:
                    if len(rows) > 1:
                        out.extend(work(now, rows))
                    now, rows = row[:4], []
                rows.append(row[4:])
            if len(out) > 20000:
                yield batch_of(out)
                out = []
        if len(rows) > 1:
            out.extend(work(now, rows))
        yield batch_of(out)

    return (dealt.repartition(*_GROUP).sortWithinPartitions(*_GROUP, "side")).mapInArrow(run, schema)


def _hits(rows, band: int, level: int, share: int, apart):
    """(row, rows before it) that meet, are ``apart(row, rows)`` and have signatures and sizes that allow a link.

    Two classes share many buckets; they meet in the one of the first bands on which they agree.
    """
    least = least_equal(share)
    side, n = (np.array([r[i] for r in rows], dtype=np.int64) for i in (0, 3))
    sigs = np.frombuffer(b"".join(r[4] for r in rows), dtype=np.uint32).reshape(-1, HASHES)
    first = int((side == 0).sum())
    two_sides = first < len(rows)
    for at in range(first if two_sides else 1, len(rows)):
        until = first if two_sides else at
        sized = np.minimum(n[:until], n[at]) * 100 >= np.maximum(n[:until], n[at]) * share
        maybe = np.flatnonzero(sized & apart(at, until))
        if len(maybe):
            same = sigs[maybe] == sigs[at]
            agree = same.reshape(-1, BANDS, ROWS).all(axis=2)[:, :band + 1].sum(axis=1)
            maybe = maybe[(same.sum(axis=1) >= least) & (agree == level)]
            if len(maybe):
                yield at, maybe


def _crossing_links(state: DataFrame, classes: DataFrame, sets_of, cap: int, level: int, share: int) -> DataFrame:
    """(a, b) links that join the components of ``state``'s buckets, written; a forest for each meeting of parts.

    First the signatures alone show which members of a meeting have a partner
    in it; only their full sets are fetched, and compared within the task.
    """
    def members_with_partners(group, rows):
        comp = np.array([r[2] for r in rows], dtype=np.int64)
        found = np.zeros(len(rows), dtype=bool)
        for at, hits in _hits(rows, group[0], level, share, lambda at, until: comp[:until] != comp[at]):
            found[at] = True
            found[hits] = True
        yield from ((*group, *rows[i][:3]) for i in np.flatnonzero(found))

    def links(group, rows):
        parent = {r[2]: r[2] for r in rows}
        sets = [np.array(r[5], dtype=np.int64).view(np.uint64) for r in rows]

        def root(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        def apart(at, until):
            own = root(rows[at][2])
            return np.fromiter((root(r[2]) != own for r in rows[:until]), dtype=bool, count=until)

        for at, hits in _hits(rows, group[0], level, share, apart):
            joined = np.concatenate([sets[h] for h in hits])
            place = np.searchsorted(sets[at], joined)
            inside = sets[at].take(place, mode="clip") == joined
            sizes = np.array([len(sets[h]) for h in hits])
            both = np.add.reduceat(inside.astype(np.int64), np.cumsum(sizes) - sizes)
            for h in hits[both * 100 >= (sizes + len(sets[at]) - both) * share]:
                a, b = root(rows[at][2]), root(rows[h][2])
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    yield min(rows[at][1], rows[h][1]), max(rows[at][1], rows[h][1])

    signed = classes.select("c", "c_n", "c_sig")
    columns = [*_GROUP, "side", "c", "comp", "c_n", "c_sig"]
    chosen = written(_by_group(_dealt(state, cap).join(signed, "c").select(*columns), members_with_partners,
                               "band byte, key bigint, t int, q int, side int, c bigint, comp bigint"), "minhash-meetings")
    full = chosen.join(signed, "c").join(sets_of(chosen.select("c")), F.col("c") == F.col("s")).select(*columns, "s_set")
    return written(_by_group(full, links, "a bigint, b bigint").distinct(), "minhash-crossing")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS,
                    share: int = SHARE, cap: int = CAP, depth: int = DEPTH) -> DataFrame:
    """(p_id, p_n, p_component) of every row of ``docs``: its id, its set's size and its component's smallest id."""
    rows = written(prints(docs, key, text, words), "minhash-prints")
    classes = written(
        rows.where(F.col("p_n") > 0).groupBy("p_key")
        .agg(F.min("p_id").alias("c_id"), F.min("p_text").alias("c_text"), F.max("p_n").alias("c_n"),
             F.max("p_sig").alias("c_sig")).withColumn("c", F.monotonically_increasing_id()), "minhash-classes")

    members = classes.select(F.explode(_band_keys(F.lit(0), F.lit(0))).alias("m"), "c").select("m.band", "m.key", "c")
    shared = members.groupBy(F.col("band").alias("s_band"), F.col("key").alias("s_key")).agg(
        F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)
    crowded = written(members.join(shared, (F.col("band") == F.col("s_band")) & (F.col("key") == F.col("s_key")))
                      .select("band", "key", "c", "rows"), "minhash-buckets")
    # The original of a family shares more of its bands with the family than any of its copies does.
    company = crowded.groupBy(F.col("c").alias("w_c")).agg(F.sum("rows").alias("company"))
    leads = (crowded.join(company, F.col("c") == F.col("w_c")).groupBy(F.col("band").alias("l_band"), F.col("key").alias("l_key"))
             .agg(F.max_by("c", F.struct("company", -F.col("c"))).alias("pivot")))
    crowded = crowded.join(leads, (F.col("band") == F.col("l_band")) & (F.col("key") == F.col("l_key"))).select(
        "band", "key", "c", "pivot")

    stars = crowded.where(F.col("c") != F.col("pivot")).select(F.col("pivot").alias("a"), F.col("c").alias("b")).distinct()
    best = written(_equal_minima(stars, classes, share).groupBy("b").agg(F.max(F.struct("equal", "a")).alias("best"))
                   .select("best.a", "b"), "minhash-stars")
    def sets_of(wanted):
        return class_sets(wanted, classes, docs, text, words)

    links = linked(best, sets_of(best.select(F.explode(F.array("a", "b")).alias("c"))), share)
    state = _open_buckets(_labelled(crowded.select("band", "key", "c"), components(links)))

    found = [links]
    for level in range(1, depth + 1):
        state = written(state, "minhash-open")
        ready = state if level == depth else state.where(F.col("outside") <= cap)
        found.append(_crossing_links(ready, classes, sets_of, cap, level, share))
        split = state.where(F.col("outside") > cap)
        if level == depth or split.isEmpty():
            break
        split = split.where(F.col("band") < BANDS - 1).select("band", "key", "c", "comp").join(
            classes.select("c", "c_sig"), "c")
        state = _open_buckets(
            split.select(F.explode(_band_keys(F.col("band").cast("int") + 1, F.col("key"))).alias("m"), "c", "comp")
            .select("m.band", "m.key", "c", "comp"))
    named = written(_labelled(classes.select("c", "c_id", "p_key"), components(reduce(DataFrame.union, found))), "minhash-named")
    least = named.groupBy(F.col("comp").alias("l_comp")).agg(F.min("c_id").alias("l_id"))
    named = named.join(least, F.col("comp") == F.col("l_comp")).select(F.col("p_key").alias("n_key"), F.col("l_id"))
    return rows.join(named, F.col("p_key") == F.col("n_key"), "left").select(
        "p_id", "p_n", F.when(F.col("p_key").isNull(), F.col("p_id")).otherwise(F.col("l_id")).alias("p_component"))


def _labelled(members: DataFrame, roots: DataFrame) -> DataFrame:
    """``members`` with ``comp``, the component of ``c`` (its own number without a link)."""
    return (members.join(roots, F.col("c") == F.col("node"), "left")
            .withColumn("comp", F.coalesce("root", "c")).drop("node", "root"))
