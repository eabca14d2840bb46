"""URL filters, fingerprints, sharding and mixing against brute force."""

import hashlib
import random

import pytest
import xxhash
from helpers import docs, no_docs
from pyspark.sql import functions as F

from salesmart.llm import fingerprints, mixing, sharding, url_filter


# --- URL filters ----------------------------------------------------------

def brute_verdict(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = path = ""
    for i, c in enumerate(rest):
        if c in "/?#":
            host, path = rest[:i], rest[i:]
            break
    else:
        host = rest
    for mark in "?#":
        path = path.split(mark, 1)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), a == "block", h + p, a) for h, p, a in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[4] if best else "allow"


URLS = [None, "", "no scheme", "http://", "http://a.net", "http://a.net/", "HTTP://WWW.Example.NET/en/x?y#z",
        "http://example.net/en", "http://sub.example.com/de/a", "ftp://x.org/fr/", "http://notnet/x", "http://net/x",
        "http://xexample.com/de/", "a://b://c.net/", "http://org/fr/#/x", "http://example.net?x=/en/", "http://É.net/ü"]


def test_url_filter_matches_brute_force(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(None, "http://q.net/"), (3, "http://q.net/")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string").withColumn("host", F.lit("clash"))
    got = url_filter.filter_urls(pages, url_filter.rule_table(spark)).collect()
    assert got[0].asDict().keys() == {"page_id", "url", "host", "path", "rule", "verdict"}
    want = sorted(str((i, u, *brute_verdict(u, url_filter.RULES))) for i, u in rows)
    assert sorted(str((r["page_id"], r["url"], r["host"], r["path"], r["rule"], r["verdict"])) for r in got) == want


def test_url_rules_with_partial_paths_ties_and_nulls(spark):
    rules = [("a.com", "/ab", "block"), ("a.com", "/abc/d", "allow"), ("a.com", "/ab", "allow"), ("b.a.com", "", "allow"),
             (None, "/", "block"), ("x", None, "block")]
    urls = ["h://a.com/a", "h://a.com/abx", "h://a.com/abc/de", "h://c.b.a.com/abc", "h://b.a.com"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id bigint, url string")
    got = url_filter.filter_urls(pages, url_filter.rule_table(spark, rules)).orderBy("page_id").collect()
    assert [(r["rule"], r["verdict"]) for r in got] == [
        brute_verdict(u, [x for x in rules if None not in x])[2:] for u in urls]


def test_url_filter_of_empty_tables(spark):
    none = spark.createDataFrame([], "page_id bigint, url string")
    rules = url_filter.rule_table(spark)
    assert url_filter.filter_urls(none, rules).count() == 0
    one = spark.createDataFrame([(1, "h://a.net/")], "page_id bigint, url string")
    assert url_filter.filter_urls(one, rules.where("false")).first()["verdict"] == "allow"


# --- fingerprints ---------------------------------------------------------

def brute_winnow(text, gram, window):
    data, n = text.encode("utf-32-be"), len(text)
    if not n:
        return []
    hashes = [xxhash.xxh64_intdigest(data[4 * i:4 * (i + gram)], 42) for i in range(max(1, n - gram + 1))]
    found = []
    for s in range(max(1, len(hashes) - window + 1)):
        place = min(range(s, min(s + window, len(hashes))), key=lambda i: (hashes[i] >> 28, -i))
        if not found or found[-1][0] != place:
            found.append((place, hashes[place] - (1 << 64) if hashes[place] >> 63 else hashes[place]))
    return found


@pytest.mark.parametrize("gram,window,segment", [(16, 32, 256), (4, 5, 7), (3, 1, 4)])
def test_winnow_matches_brute_force(spark, gram, window, segment):
    rng = random.Random(5)
    texts = ["", "a", "abc", "abcd", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "é\U0001f600ü" * 30]
    texts += ["".join(rng.choice("abcé ") for _ in range(rng.randint(0, 700))) for _ in range(12)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").select(
        "text", fingerprints.winnow(F.col("text"), gram, window, segment).alias("m"))
    for r in df.collect():
        assert [(x["pos"], x["hash"]) for x in r["m"]] == brute_winnow(r["text"], gram, window), r["text"]


def test_edited_fingerprints_equal_the_operator_on_the_edited_text(spark):
    rng = random.Random(6)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(n)) for n in
             (0, 1, 2, 5, 15, 16, 17, 30, 46, 47, 48, 60, 93, 94, 95, 96, 140, 400, 900, 3, 900, 50, 0, 200)]
    rows = [(i, t) for i, t in enumerate(texts)]
    paired = fingerprints.with_next(spark.createDataFrame(rows, "doc_id bigint, text string"),
                                    "doc_id", "text", "mark", bucket_rows=5)
    got = fingerprints.with_edited(paired).withColumn("direct", fingerprints.winnow(F.col("edited"))).collect()
    assert len(got) == len(rows)
    for r in got:
        t, following = texts[r["doc_id"]], texts[(r["doc_id"] + 1) % len(texts)]
        half = len(t) // 2
        assert r["next"]["text"] == following
        assert r["edited"] == t[:len(t) - half] + following[:half]
        assert r["edited_mark"] == r["direct"]
        assert [tuple(x) for x in r["next"]["mark"]] == brute_winnow(following, 16, 32)


def test_fingerprints_of_odd_rows(spark):
    df = docs(spark).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    got = fingerprints.with_edited(fingerprints.with_next(df, "doc_id", "text", "mark", 3)).select(
        "doc_id", "text", fingerprints.digest(F.col("mark")).alias("d"),
        fingerprints.likeness(F.col("mark"), F.col("next.mark")).alias("n")).collect()
    assert len(got) == 10 and all(0 <= r["n"] <= 1 for r in got)
    by_text = {}
    for r in got:
        assert by_text.setdefault(r["text"], r["d"]) == r["d"]
    assert len(set(by_text.values())) == len(by_text)
    assert fingerprints.with_next(no_docs(spark).select("doc_id", "text"), "doc_id", "text", "mark").count() == 0


# --- sharding -------------------------------------------------------------

def sharded(df, **options):
    return sharding.shard_records(df, **options)


def test_shards_are_even_gapless_and_complete(spark):
    df = spark.range(0, 1003).selectExpr("id AS doc_id", "concat('text ', id % 7) AS text", "'x' AS shard")
    got = sharded(df, n_shards=40, bucket_bytes=2000).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(1003))
    by_shard = {}
    for r in got:
        by_shard.setdefault(r["shard"], []).append(r["slot"])
    assert set(by_shard) == set(range(40))
    assert {len(v) for v in by_shard.values()} == {25, 26}
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())
    again = sharded(df.repartition(3), n_shards=40, bucket_bytes=2000).collect()
    assert {(r["doc_id"], r["shard"], r["slot"]) for r in again} == {(r["doc_id"], r["shard"], r["slot"]) for r in got}
    other = sharded(df, n_shards=40, bucket_bytes=2000, seed=21).collect()
    assert sum((a["shard"], a["slot"]) == (b["shard"], b["slot"]) for a, b in zip(
        sorted(got, key=lambda r: r["doc_id"]), sorted(other, key=lambda r: r["doc_id"]))) < 30


def test_sharding_of_odd_rows(spark):
    got = sharded(docs(spark, extra=["slot"]), n_shards=3).collect()
    assert len(got) == 10 and got[0].asDict().keys() == {
        "doc_id", "text", "lang", "source", "n_chars", "shard", "slot"}
    assert sorted(sum(1 for r in got if r["shard"] == s) for s in range(3)) == [3, 3, 4]
    assert sharded(no_docs(spark)).count() == 0


def test_equal_records_spread_over_buckets(spark, tmp_path):
    spark.range(0, 6000).selectExpr(
        "if(id % 3 = 0, NULL, id) AS doc_id", "if(id % 3 = 0, 'the same text', concat('text ', id)) AS text",
        "id AS own", "repeat('x', 40) AS `odd.na``me`").repartition(4).write.parquet(str(tmp_path / "d"))
    df = spark.read.parquet(str(tmp_path / "d"))
    tagged, n_buckets = sharding.scattered(df, 20, "doc_id", "text", 8000)
    sizes = sorted(r["count"] for r in tagged.groupBy("s_bucket").count().collect())
    assert 60 < n_buckets < 120 and sizes[-1] < 2.2 * 6000 / n_buckets
    got = sharding.shard_records(df, n_shards=7, bucket_bytes=8000).collect()
    assert sorted(r["own"] for r in got) == list(range(6000))
    assert sorted((r["shard"], r["slot"]) for r in got) == [
        (s, i) for s in range(7) for i in range((s + 1) * 6000 // 7 - s * 6000 // 7)]
    with_small_files = sharding.shard_records(df, n_shards=7, bucket_bytes=8000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:  # files are split otherwise: the same shards
        again = sharding.shard_records(spark.read.parquet(str(tmp_path / "d")), n_shards=7, bucket_bytes=8000)
        assert sorted(map(str, again.collect())) == sorted(map(str, with_small_files.collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


# --- mixing ---------------------------------------------------------------

def brute_targets(sizes, weights=(3, 1, 2), share=1.5, epochs=2):
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = share * sum(sizes.values()), set()
    while True:
        rest = [s for s in order if s not in capped]
        if not rest:
            return {s: epochs * sizes[s] for s in order}
        level = (total - sum(epochs * sizes[s] for s in capped)) / sum(w[s] for s in rest)
        full = {s for s in rest if level * w[s] > epochs * sizes[s]}
        if not full:
            return {s: epochs * sizes[s] if s in capped else level * w[s] for s in order}
        capped |= full


def test_mix_meets_targets(spark):
    df = spark.range(0, 3000).selectExpr(
        "id AS doc_id", "repeat('w ', cast(1 + id * 7 % 13 AS int)) AS text",
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 50 = 1 THEN NULL ELSE concat('s', id % 5) END AS source")
    labels = spark.range(0, 3000, 2).selectExpr("id AS doc_id", "cast(id % 4 = 0 AS int) AS quality")
    got = mixing.mix(df, labels).join(df.select("doc_id", "source"), "doc_id").collect()
    sizes, taken, target = {}, {}, {}
    for r in got:
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        target[r["source"]] = r["target"]
    want = brute_targets(sizes)
    assert len(got) == 3000
    for s in sizes:
        assert target[s] == pytest.approx(want[s], abs=1e-6)
        assert abs(taken[s] - want[s]) <= 7
        assert {r["source_size"] for r in got if r["source"] == s} == {sizes[s]}
    again = mixing.mix(df.repartition(5), labels).collect()
    assert {(r["doc_id"], r["taken"]) for r in again} == {(r["doc_id"], r["taken"]) for r in got}
    picked = mixing.mixed_documents(df, labels).groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in picked} == {
        r["doc_id"]: r["taken"] // r["size"] for r in got if r["taken"]}


def brute_mix(rows, labels, seed, share):
    """Target of each source and words taken of each (source, id, text), from the draws that Spark makes."""
    sizes = {}
    for _, _, source, size, _ in rows:
        sizes[source] = sizes.get(source, 0) + size
    targets, taken = brute_targets(sizes, share=share), {}
    for source, target in targets.items():
        epochs = int(target // sizes[source]) if sizes[source] else 0
        rest, total = target - epochs * sizes[source], 0
        for key, i, text, size in sorted(
                ((draw / labels.get(i, 0.5), i, text, size) for i, text, s, size, draw in rows if s == source),
                key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
            extra = total + size / 2 <= rest
            total += size
            at = (source, i, text)
            taken[at] = taken.get(at, 0) + size * (epochs + extra)
    return targets, taken


@pytest.mark.parametrize("share, seed", [(1.3, 7), (0.6, 1), (1.5, 3), (0.9, 4)])
def test_mix_with_hot_rows_matches_brute_force(spark, tmp_path, share, seed):
    spark.range(0, 3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN NULL WHEN id % 30 = 1 THEN 11 ELSE id END AS doc_id",
        "CASE WHEN id % 3 = 0 THEN 'a b' WHEN id % 30 = 1 THEN 'five words are in here' "
        "ELSE repeat('w ', cast(id % 4 AS int)) END AS text",
        "CASE WHEN id % 3 = 0 OR id % 5 = 1 THEN 'hot' WHEN id % 7 = 0 THEN NULL ELSE 'cold' END AS source",
        "id AS m_at", "'x' AS c_last", "'y' AS size").repartition(5).write.parquet(str(tmp_path / "d"))
    df = spark.read.parquet(str(tmp_path / "d"))
    labels = spark.range(0, 3000, 2).selectExpr("id AS doc_id", "cast(id % 4 = 0 AS int) AS quality")
    weight = {i: 1.0 if i % 4 == 0 else 0.25 for i in range(0, 3000, 2)}
    draws = df.select("doc_id", "text", "source", mixing.word_count(F.col("text")),
                      mixing.exponential(seed, F.col("doc_id"), F.col("text"))).collect()
    targets, taken = brute_mix(list(map(tuple, draws)), weight, seed, share)
    got = mixing.mix(df.select("*"), labels, seed, share=share).collect()
    assert len(got) == 3000 and all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in got)
    picked = mixing.mixed_documents(df, labels, seed, share=share)
    assert picked.columns == df.columns
    found = {}
    for r in picked.collect():
        at = (r["source"], r["doc_id"], r["text"])
        found[at] = found.get(at, 0) + len(r["text"].split())
    assert {k: v for k, v in found.items() if v} == {k: v for k, v in taken.items() if v}
    assert sum(r["taken"] for r in got) == sum(taken.values())
    for source, target in targets.items():
        assert abs(sum(v for k, v in found.items() if k[0] == source) - target) <= 2.5


def test_key_ranges_are_even_for_every_quality(spark):
    rows = spark.range(0, 200000).select(mixing.exponential(7, F.col("id"), F.lit("t")).alias("e"))
    for quality in (mixing.GOOD, mixing.DEFAULT_QUALITY, mixing.BAD):
        ranges = rows.select((mixing._key_range(F.col("e") / quality) / (mixing.BUCKETS // 64)).cast("int").alias("r"))
        assert ranges.groupBy("r").count().agg(F.max("count")).first()[0] < 3.3 * 200000 / 64


def test_better_documents_are_taken_more_often(spark):
    df = spark.range(0, 2000).selectExpr("id AS doc_id", "'a b c' AS text", "'s' AS source")
    labels = spark.range(0, 2000).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS quality")
    extra = [r["doc_id"] % 2 for r in mixing.mix(df, labels).collect() if r["taken"] == 6]
    assert 0.4 < len(extra) / 2000 < 0.6 and sum(extra) / len(extra) > 0.65


def test_mixing_of_odd_rows(spark):
    got = mixing.mix(docs(spark, extra=["size", "taken"])).collect()
    assert len(got) == 10 and all(r["taken"] <= 2 * r["size"] for r in got)
    assert {r["taken"] for r in got if not r["size"]} == {0}
    assert mixing.mixed_documents(docs(spark, extra=["size"])).columns[-1] == "size"
    assert mixing.mix(no_docs(spark)).count() == 0
    assert mixing.mix(docs(spark, [(1, None, "en", "a", 0)])).first()["taken"] == 0


def test_sha_of_edited_text(spark):
    row = spark.range(1).select(F.sha2(F.lit("é\U0001f600"), 256).alias("h")).first()
    assert row["h"] == hashlib.sha256("é\U0001f600".encode()).hexdigest()
