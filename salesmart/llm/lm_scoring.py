"""LM scoring: the likelihood of a text, summed over all its subword segmentations.

A text is its words (lower-case ASCII letters), each after a blank, and an
end.  The pieces are those of an existing subword vocabulary and all single
bytes.  A word's lattice has an arc for each piece at each place it fits; a
forward recursion in log space sums the probabilities of all segmentations.
Beside these paths a word seen in training has one arc over its whole length,
with its training frequency less a discount; what the discount leaves goes to
the piece paths.  So

    P(word) = (1 - P(end)) * (max(c - D, 0) + D * V * Z(word)) / N

with c the word's training count, N the training words, V the distinct ones
and Z the sum over the piece paths.  No piece crosses a blank, so the sum over
all segmentations of a text is the product over its words.  Piece
probabilities start from the vocabulary's own scores (ranks, as 1 / rank) and
are fitted to the distinct training words by expectation maximisation.

Scale: words are counted in the tasks and summed by word over all documents;
every further step but the last works on that table, one row per distinct
word, written to the shared folder: the expected piece counts (one row per
piece goes to the driver, a bound set by the vocabulary) and the word scores.
The ``MOST_FREQUENT`` most frequent words are broadcast, a fixed number;
documents sum those up where they are read.  Their other words are shuffled as
(row, word, count) to a join with the word scores and summed by row.  Words
too frequent for one task are thus never shuffled.

Defined cases: null and empty texts have only the end token.  A null id is
learned from.  Without training words the piece paths alone count.  Repeated
rows keep their rows.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from salesmart.llm.common import written

DISCOUNT = 0.75
ROUNDS = 2
MOST_FREQUENT = 100_000
FLUSH = 200_000
LOG10 = math.log(10)


class Lattice:
    """Forward and backward sums over the segmentations of words into pieces (byte strings)."""

    def __init__(self, pieces: list[bytes], log_probs: np.ndarray):
        self.log_probs = np.asarray(log_probs, dtype=float)
        self.sorted, self.ids = {}, {}
        self.seen = np.zeros(1 << 20, dtype=bool)
        sizes = np.array([len(p) for p in pieces])
        self.longest = int(sizes.max())
        for size in np.unique(sizes).tolist():
            ids = np.nonzero(sizes == size)[0]
            codes = np.frombuffer(b"".join(pieces[i] for i in ids), dtype=np.uint8).reshape(-1, size)
            marks = np.zeros(len(ids), dtype=np.uint64)
            for column in range(size):
                marks = self._extend(marks, codes[:, column])
            order = np.argsort(marks)
            self.sorted[size], self.ids[size] = marks[order], ids[order]
            self.seen[self._slot(marks)] = True

    @staticmethod
    def _extend(marks: np.ndarray, byte: np.ndarray) -> np.ndarray:
        return (marks + byte.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)

    @staticmethod
    def _slot(marks: np.ndarray) -> np.ndarray:
        return (marks >> np.uint64(44)).astype(np.int64)

    def arcs(self, codes: np.ndarray):
        """(starts, stops, rows, piece ids) of all pieces in words of one length, by start, and where each start begins."""
        n, length = codes.shape
        found = []
        marks = np.zeros((n, length + 1), dtype=np.uint64)
        for size in range(1, min(length, self.longest) + 1):
            marks = self._extend(marks[:, :-1], codes[:, size - 1:])
            known = self.sorted.get(size)
            if known is None:
                continue
            rows, starts = np.nonzero(self.seen[self._slot(marks)])
            wanted = marks[rows, starts]
            at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
            hit = known[at] == wanted
            found.append((starts[hit], starts[hit] + size, rows[hit], self.ids[size][at[hit]]))
        joined = [np.concatenate([f[i] for f in found]) for i in range(4)]
        order = np.argsort(joined[0], kind="stable")
        joined = [a[order] for a in joined]
        return joined, np.searchsorted(joined[0], np.arange(length + 1))

    def forward(self, codes: np.ndarray, arcs) -> np.ndarray:
        (starts, stops, rows, ids), begin = arcs
        alpha = np.full((codes.shape[1] + 1, len(codes)), -np.inf)
        alpha[0] = 0.0
        for start in range(codes.shape[1]):  # a row has each stop once per start
            part = slice(begin[start], begin[start + 1])
            at = (stops[part], rows[part])
            alpha[at] = np.logaddexp(alpha[at], alpha[start, rows[part]] + self.log_probs[ids[part]])
        return alpha

    def add_expected(self, codes: np.ndarray, out: np.ndarray) -> None:
        """Adds to ``out`` the expected number of each piece in the words."""
        arcs = self.arcs(codes)
        (starts, stops, rows, ids), begin = arcs
        alpha = self.forward(codes, arcs)
        beta = np.full_like(alpha, -np.inf)
        beta[-1] = 0.0
        weighed = self.log_probs[ids]
        for start in range(codes.shape[1] - 1, -1, -1):
            part = slice(begin[start], begin[start + 1])
            through = weighed[part] + beta[stops[part], rows[part]]
            peak = np.full(len(codes), -np.inf)
            np.maximum.at(peak, rows[part], through)
            total = np.bincount(rows[part], np.exp(through - peak[rows[part]]), minlength=len(codes))
            beta[start] = peak + np.log(total)
        share = np.exp(alpha[starts, rows] + weighed + beta[stops, rows] - alpha[-1][rows])
        out += np.bincount(ids, share, minlength=len(out))

    def log_marginals(self, codes: np.ndarray) -> np.ndarray:
        return self.forward(codes, self.arcs(codes))[-1]


def same_length(words: list[bytes], most: int = 160_000):
    """(positions, codes) of the words, each after a blank, in groups of one length of about ``most`` bytes."""
    sizes = np.array([len(w) for w in words])
    for size in np.unique(sizes).tolist():
        at = np.nonzero(sizes == size)[0]
        step = max(1, most // (size + 1))
        for i in range(0, len(at), step):
            part = at[i:i + step]
            joined = b"".join(b" " + words[p] for p in part)
            yield part, np.frombuffer(joined, dtype=np.uint8).reshape(len(part), size + 1)


def starting_pieces(vocabulary: dict[str, float]) -> tuple[list[bytes], np.ndarray]:
    """(pieces, log probabilities): the vocabulary's pieces of lower-case words and all bytes, weighed 1 / rank."""
    ranked = sorted(vocabulary, key=lambda p: (-vocabulary[p], p))
    weights: dict[bytes, float] = {}
    for rank, piece in enumerate(ranked, 1):
        content = piece.replace("▁", " ").encode()
        if content == content.lower() and b" " not in content[1:]:
            weights[content] = weights.get(content, 0.0) + 1 / rank
    for byte in range(256):
        weights.setdefault(bytes([byte]), 1 / (len(ranked) + 1 + byte))
    pieces = sorted(weights)
    w = np.array([weights[p] for p in pieces])
    return pieces, np.log(w / w.sum())


def words_of(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text else []


def count_words(docs: DataFrame) -> DataFrame:
    """(word, trained, used) over rows (l_train, l_text): occurrences in training texts and in all."""
    def run(batches):
        trained, used = Counter(), Counter()

        def flush():
            words = list(used)
            return pa.RecordBatch.from_arrays(
                [pa.array(words, type=pa.binary()), pa.array([trained[w] for w in words], type=pa.int64()),
                 pa.array([used[w] for w in words], type=pa.int64())], names=["word", "trained", "used"])

        for batch in batches:
            for train, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text)
                used.update(words)
                if train:
                    trained.update(words)
                if len(used) > FLUSH:
                    yield flush()
                    trained.clear()
                    used.clear()
        yield flush()

    parts = docs.mapInArrow(run, "word binary, trained bigint, used bigint")
    return written(parts.groupBy("word").agg(F.sum("trained").alias("trained"), F.sum("used").alias("used")),
                   "lm-words")


def fit_pieces(words: DataFrame, pieces: list[bytes], log_probs: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Log probabilities of the pieces, fitted to the training words, each counted once."""
    sc = words.sparkSession.sparkContext
    for _ in range(rounds):
        held = sc.broadcast((pieces, log_probs))

        def run(batches):
            lattice = Lattice(*held.value)
            out = np.zeros(len(held.value[0]))
            for batch in batches:
                for _, codes in same_length(batch.column(0).to_pylist()):
                    lattice.add_expected(codes, out)
            at = np.nonzero(out)[0]
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(out[at])], names=["piece", "n"])

        expected = (words.where("trained > 0").select("word").mapInArrow(run, "piece bigint, n double")
                    .groupBy("piece").agg(F.sum("n").alias("n")).collect())  # one row per piece at most
        counts = np.full(len(pieces), 0.01)
        for row in expected:
            counts[row["piece"]] += row["n"]
        # Rounded, so that the order in which tasks are summed does not show.
        log_probs = np.round(np.log(counts / counts.sum()), 9)
    return log_probs


def score_words(words: DataFrame, pieces: list[bytes], log_probs: np.ndarray, sizes: dict) -> DataFrame:
    """(word, used, known, base, score): log10 probabilities of one occurrence of each word."""
    held = words.sparkSession.sparkContext.broadcast((pieces, log_probs))
    total, distinct = sizes["tokens"], sizes["distinct"]
    n, v, log_other = sizes["words"], sizes["types"], math.log10(1 - _end_probability(sizes))

    def run(batches):
        lattice = Lattice(*held.value)
        for batch in batches:
            found = np.zeros(batch.num_rows)
            for at, codes in same_length(batch.column(0).to_pylist()):
                found[at] = lattice.log_marginals(codes)
            c = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
            if n:
                whole = np.log(np.maximum(np.maximum(c - DISCOUNT, 0) / n, 1e-320))
                found = np.where(c > 0, np.logaddexp(whole, math.log(DISCOUNT * v / n) + found),
                                 math.log(DISCOUNT * v / n) + found)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(c > 0),
                 pa.array(np.log10((c + 1) / (total + distinct + 1))), pa.array(found / LOG10 + log_other)],
                names=["word", "used", "known", "base", "score"])

    return written(words.select("word", "trained", "used").mapInArrow(
        run, "word binary, used bigint, known boolean, base double, score double"), "lm-word-scores")


def _end_probability(sizes: dict) -> float:
    return (sizes["texts"] + 0.5) / (sizes["tokens"] + 1)


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def score(docs: DataFrame, vocabulary: dict[str, float], key: str = "doc_id", text: str = "text",
          left_out: Column | None = None, most_frequent: int = MOST_FREQUENT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of ``docs``."""
    spark = docs.sparkSession
    left_out = held_out(F.col(key)) if left_out is None else left_out
    rows = docs.select(F.monotonically_increasing_id().alias("l_row"), F.col(key).alias("l_id"),
                       left_out.alias("l_out"), F.col(text).cast("binary").alias("l_text"))
    words = count_words(rows.select((~F.col("l_out")).alias("l_train"), "l_text"))
    texts = rows.where(~F.col("l_out")).count()
    learned = words.where("trained > 0").agg(F.sum("trained").alias("n"), F.count(F.lit(1)).alias("v")).first()
    sizes = {"texts": texts, "words": learned["n"] or 0, "tokens": (learned["n"] or 0) + texts,
             "types": learned["v"], "distinct": learned["v"] + (texts > 0)}
    pieces, log_probs = starting_pieces(vocabulary)
    scores = score_words(words, pieces, fit_pieces(words, pieces, log_probs), sizes)
    frequent = scores.orderBy(F.col("used").desc(), "word").limit(most_frequent).collect()
    held = spark.sparkContext.broadcast(
        {bytes(r["word"]): (int(r["known"]), r["base"], r["score"]) for r in frequent})
    total, distinct = sizes["tokens"], sizes["distinct"]
    end = (int(texts > 0), math.log10((texts + 1) / (total + distinct + 1)), math.log10(_end_probability(sizes)))
    schema = StructType([
        StructField("d_row", rows.schema["l_row"].dataType), StructField("d_id", rows.schema["l_id"].dataType),
        *spark.createDataFrame([], "d_out boolean, d_word binary, d_count bigint, d_tokens bigint, d_known bigint, "
                                   "d_base double, d_score double").schema.fields])

    def run(batches):
        table = held.value
        for batch in batches:
            columns = [[] for _ in schema.fields]
            ids, outs = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for row, id_, out, content in zip(batch.column(0).to_pylist(), ids, outs, batch.column(3).to_pylist()):
                tokens = words_of(content)
                known, base, model = end
                rest = []
                for word, n in Counter(tokens).items():
                    hit = table.get(word)
                    if hit is None:
                        rest.append((word, n))
                    else:
                        known += n * hit[0]
                        base += n * hit[1]
                        model += n * hit[2]
                # The document's own row; its word holds a blank, so it meets no score, and spreads by row.
                for column, value in zip(columns, (row, id_, out, b" %d" % row, 1, len(tokens) + 1, known, base, model)):
                    column.append(value)
                columns[0] += [row] * len(rest)
                columns[3] += [w for w, _ in rest]
                columns[4] += [n for _, n in rest]
                for at in (1, 2, 5, 6, 7, 8):
                    columns[at] += [None] * len(rest)
                if len(columns[0]) > 50_000:
                    yield _batch(columns, batch.schema.field(1).type)
                    columns = [[] for _ in schema.fields]
            yield _batch(columns, batch.schema.field(1).type)

    parts = rows.mapInArrow(run, schema)
    joined = parts.join(scores, F.col("d_word") == F.col("word"), "left")
    each = {"known": F.col("known").cast("long"), "base": F.col("base"), "score": F.col("score")}
    sums = [F.sum(F.coalesce(f"d_{name}", F.lit(0)) + F.coalesce(F.col("d_count") * one, F.lit(0))).alias(f"s_{name}")
            for name, one in each.items()]
    return (joined.groupBy("d_row").agg(F.max("d_id").alias("d_id"), F.max("d_out").alias("d_out"),
                                        F.max("d_tokens").alias("d_tokens"), *sums)
            .select(F.col("d_id").alias("doc_id"), F.col("d_out").alias("held_out"),
                    F.col("d_tokens").alias("n_tokens"), F.col("s_known").alias("n_known"),
                    F.lit(total).cast("long").alias("train_tokens"), F.col("s_base").alias("base_score"),
                    F.col("s_score").alias("score")))


def _batch(columns: list[list], id_type: pa.DataType) -> pa.RecordBatch:
    types = (pa.int64(), id_type, pa.bool_(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
    names = ("d_row", "d_id", "d_out", "d_word", "d_count", "d_tokens", "d_known", "d_base", "d_score")
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types)], names=names)
