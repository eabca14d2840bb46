"""License scans: exact set-similarity join of text blocks with license templates.

Base search: the places where the words of a phrase stand consecutively.

Method: a text's words are cut into blocks that overlap by half, so that every
stretch of up to half a block lies in one.  Half a block is ``BLOCK`` / 2 words,
doubled until it holds the whole template (``half_block``): templates of any
length are found wherever they stand.  Templates of like length share their
blocks.  A block matches a template if it holds at least the share ``threshold`` of the
template's distinct words.  Template words are ordered by their frequency in
the whole corpus, rarest first.  A template of n words of which a must be
held has the prefix of its n - a + 1 rarest words: a matching block holds one
of them (prefix filter).  A block needs a template words at all (length
filter), and the words after the first common one must suffice on both sides
(positional filter).  Candidates that pass are verified by intersection, which
must also hold all of the template's ``names``: the words that tell it from
other licenses of nearly the same words.

Scale: one pass counts the template words over all documents (map-side sums;
the result has one row per template word).  A second pass cuts the texts into
blocks where they are read and emits only blocks that hold a prefix word, as
rows of template words; these are joined to the prefix index on the word, in
Spark.  The index is bounded by the templates, which are a parameter and are
part of the plan.  No text is shuffled.

Defined cases: null and empty texts have no words, blocks or labels and score
zero.  Templates without words never match.  Repeated rows keep their rows; of
templates in one block each that is held gives its label.  An empty table
gives an empty result.  Columns beside id and text are never looked at,
whatever their names.
"""

from __future__ import annotations

import itertools
import math
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from salesmart.llm.common import written

#: The phrases of the base search and their labels.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
#: The templates of the similarity join and their labels.
TEMPLATES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("released under the mit license", "mit"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under a creative commons attribution noncommercial 4 0 international license", "cc-by-nc"),
    ("licensed under a creative commons attribution sharealike 4 0 international license", "cc-by-sa"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("all rights reserved", "all-rights-reserved"),
)
#: The words that name a license; a share of the other words of a template may be missing, these may not.
NAMES = ("mit", "apache", "2", "nc", "noncommercial", "sharealike", "gnu", "3")
THRESHOLD = 0.8
BLOCK = 32

_WORD_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased runs of ASCII letters and digits and of all non-ASCII characters."""
    return text.translate(_WORD_TABLE).split()


def phrase_places(joined: bytes, phrase: bytes) -> list[int]:
    """Word numbers at which the phrase starts in `` w0 w1 ... `` (blanks around every word)."""
    places, at, counted, seen = [], joined.find(phrase), 0, 0
    while at >= 0:
        seen += joined.count(b" ", counted, at)
        counted = at
        places.append(seen)
        at = joined.find(phrase, at + 1)
    return places


def half_block(n_words: int, block: int = BLOCK) -> int:
    """Words in half a block for a template of ``n_words`` words."""
    half = max(block // 2, 1)
    while half < n_words:
        half *= 2
    return half


def template_sets(templates=TEMPLATES, block: int = BLOCK) -> list[tuple[list[str], str, int]]:
    """(distinct words, label, half a block) of each template."""
    listed = [([w.decode() for w in words_of(t.encode())], label) for t, label in templates]
    return [(sorted(set(words)), label, half_block(len(words), block)) for words, label in listed]


def prefix_length(n: int, threshold: float) -> int:
    """A block that holds enough of n words holds one of this many of them, whichever they are."""
    return n - math.ceil(threshold * n) + 1 if n else 0


def word_frequencies(docs: DataFrame, vocabulary: set[str], text: str = "text") -> dict[str, int]:
    """Occurrences in all texts of the words of ``vocabulary`` (which bounds the result)."""
    wanted = {w.encode() for w in vocabulary}

    def run(batches):
        total: Counter = Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                if t:
                    found = Counter(words_of(t))
                    for word in wanted & found.keys():
                        total[word.decode()] += found[word]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), type=pa.string()), pa.array(list(total.values()), type=pa.int64())],
            names=["word", "n"])

    counts = docs.select(F.col(text).cast("binary").alias("l_text")).mapInArrow(run, "word string, n bigint")
    return {r["word"]: r["n"] for r in counts.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def prefix_index(spark, sets: list[tuple[list[str], str, int]], rank: dict[str, int], threshold: float,
                 names=()) -> DataFrame:
    """(word, half, place, template, words, names, need, label): the prefix words of each template."""
    rows = []
    for template, (words, label, half) in enumerate(sets):
        ordered = sorted(words, key=rank.__getitem__)
        rows += [(w, half, place, template, ordered, [w for w in ordered if w in names],
                  math.ceil(threshold * len(ordered)), label)
                 for place, w in enumerate(ordered[:prefix_length(len(ordered), threshold)])]
    return spark.createDataFrame(rows, "t_word string, t_half int, t_place int, t_template int, "
                                       "t_words array<string>, t_names array<string>, t_need int, t_label string")


def blocks_of(words: list[bytes], half: int, wanted: set[bytes], prefix: set[bytes]) -> list[tuple[int, set[bytes]]]:
    """(first word, words of ``wanted``) of every block that holds a word of ``prefix``."""
    if prefix.isdisjoint(words):
        return []
    marks = [(at, w) for at, w in enumerate(words) if w in wanted]
    last = max(-(-len(words) // half) - 2, 0)  # the blocks from here on would lie in the one before
    numbers = sorted({b for at, w in marks if w in prefix for b in (at // half, at // half - 1) if 0 <= b <= last})
    found, first = [], 0
    for number in numbers:
        while marks[first][0] < number * half:
            first += 1
        held = itertools.takewhile(lambda m: m[0] < (number + 2) * half, itertools.islice(marks, first, None))
        found.append((number * half, {w for _, w in held}))
    return found


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", phrases=PHRASES, templates=TEMPLATES,
         threshold: float = THRESHOLD, block: int = BLOCK, names=()) -> DataFrame:
    """One row per document: words, base places and labels, the blocks that match a template, labels, score.

    ``blocks`` holds (first word, label, containment) of every match; ``score``
    is the highest containment, or 1 where a phrase stands.  A block must hold
    those of ``names`` that are in the template; without any, the share decides.
    """
    spark = docs.sparkSession
    sets = template_sets(templates, block)
    vocabulary = {w for words, _, _ in sets for w in words}
    counts = word_frequencies(docs, vocabulary, text)
    rank = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}
    index = prefix_index(spark, sets, rank, threshold, names)
    by_half = defaultdict(lambda: (set(), set()))  # the words and the prefix words of the templates of a length
    for words, _, half in sets:
        wanted, prefix = by_half[half]
        wanted.update(w.encode() for w in words)
        prefix.update(w.encode() for w in sorted(words, key=rank.__getitem__)[:prefix_length(len(words), threshold)])
    kinds = [(half, *of) for half, of in sorted(by_half.items())]
    place = {w.encode(): i for w, i in rank.items()}
    sought = [(b" " + b" ".join(words_of(p.encode())) + b" ", label) for p, label in phrases]

    def one(content: bytes):
        words = words_of(content)
        joined = b" " + b" ".join(words) + b" "
        places, labels = [], set()
        for phrase, label in sought:
            found = phrase_places(joined, phrase)
            if found:
                places += found
                labels.add(label)
        blocks = [{"half": half, "start": start,
                   "words": [w.decode() for w in sorted(held, key=place.__getitem__)]}
                  for half, wanted, prefix in kinds for start, held in blocks_of(words, half, wanted, prefix)]
        return len(words), places, sorted(labels), blocks

    block_type = pa.list_(pa.struct([("half", pa.int32()), ("start", pa.int64()), ("words", pa.list_(pa.string()))]))

    def run(batches):
        for batch in batches:
            found = [one(t or b"") for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([f[0] for f in found], type=pa.int64()),
                 pa.array([f[1] for f in found], type=pa.list_(pa.int64())),
                 pa.array([f[2] for f in found], type=pa.list_(pa.string())),
                 pa.array([f[3] for f in found], type=block_type)],
                names=["l_row", "l_id", "n_words", "places", "base", "blocks"])

    rows = docs.select(F.monotonically_increasing_id().alias("l_row"), F.col(key).alias("l_id"),
                       F.col(text).cast("binary").alias("l_text"))
    shape = spark.createDataFrame([], "n_words bigint, places array<bigint>, base array<string>, "
                                      "blocks array<struct<half:int,start:bigint,words:array<string>>>").schema
    scanned = written(rows.mapInArrow(run, StructType([*rows.schema.fields[:2], *shape.fields])), "license-blocks")
    matches = block_matches(scanned, index).groupBy("m_row").agg(
        F.collect_set("t_label").alias("m_labels"), F.max("m_share").alias("m_score"),
        F.sort_array(F.collect_list(F.struct("m_start", "t_label", "m_share"))).alias("m_blocks"))
    both = scanned.join(matches, F.col("l_row") == F.col("m_row"), "left")
    labels = F.array_sort(F.array_union("base", F.coalesce("m_labels", F.array().cast("array<string>"))))
    return both.select(
        F.col("l_id").alias("doc_id"), "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places").alias("first_word"), F.array_max("places").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce("m_score", F.lit(0.0))).alias("score"),
        F.col("m_blocks").alias("blocks"))


def block_matches(scanned: DataFrame, index: DataFrame) -> DataFrame:
    """(m_row, m_start, t_template, t_label, m_share) of every block that holds enough of a template."""
    blocks = scanned.select(F.col("l_row").alias("m_row"), F.explode("blocks").alias("b")).select(
        "m_row", F.col("b.half").alias("m_half"), F.col("b.start").alias("m_start"), F.col("b.words").alias("m_words"))
    probes = blocks.select("*", F.posexplode("m_words").alias("m_place", "m_word"))
    candidates = (
        probes.join(index, (F.col("m_word") == F.col("t_word")) & (F.col("m_half") == F.col("t_half")))
        .where(F.size("m_words") >= F.col("t_need"))
        .where(F.least(F.size("t_words") - F.col("t_place"), F.size("m_words") - F.col("m_place"))
               >= F.col("t_need")))
    share = F.size(F.array_intersect("m_words", "t_words"))
    return (candidates.withColumn("m_held", share).where(F.col("m_held") >= F.col("t_need"))
            .where(F.size(F.array_except("t_names", "m_words")) == 0)
            .select("m_row", "m_start", "t_template", "t_label",
                    (F.col("m_held") / F.size("t_words")).alias("m_share"))
            .distinct())
