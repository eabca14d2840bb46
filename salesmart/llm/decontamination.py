"""Benchmark decontamination by pigeonhole edit matching.

A benchmark item of n normalised characters is held to be in a document if
some stretch of the document is within k = floor(error_rate * n) edits of it.
The item is cut into k + 1 pieces; by the pigeonhole principle one of them
stands in that stretch unchanged.  Every exact piece hit (found with an
Aho-Corasick automaton of all pieces) is verified by Myers' bit-parallel
approximate search of the item in the stretch the hit allows.

Scale: the benchmark is the query set, searched against all documents in
blocks of items whose text is at most ``BLOCK_CHARS``; each block is one
automaton, built in the task that scans the documents with it, so memory is
bounded by the block and the documents stay where they are (no shuffle of
texts, no candidate table).  The blocks come to the driver one at a time.

Normalisation: lower case, white space collapsed to single blanks.  Pieces
shorter than ``MIN_PIECE`` would hit everywhere, so an item's k is lowered
until its pieces are that long.

Defined cases: null and empty items match nothing, null texts hold nothing;
items shorter than ``MIN_PIECE`` must stand as whole words.  Repeated items and
documents each give their own rows; an item without an id, or with a negative
one, is an item like any other.  Of stretches at equal distance the first found
counts.  Without documents or items the result is empty (no document is
dropped).  Extra columns pass unchanged, whatever their names.  Texts are
searched whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

ERROR_RATE = 0.06
MIN_PIECE = 12
BLOCK_CHARS = 4 << 20


def normalised(text: str | None) -> str:
    return " ".join(text.lower().split()) if text else ""


def error_budget(n: int, rate: float = ERROR_RATE, min_piece: int = MIN_PIECE) -> int:
    """Edits allowed in an item of n characters."""
    k = int(rate * n)
    while k and n // (k + 1) < min_piece:
        k -= 1
    return k


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """(offset, piece) of the k + 1 pieces, as even as possible."""
    edges = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(edges, edges[1:])]


def pattern_masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for at, char in enumerate(pattern):
        masks[char] = masks.get(char, 0) | (1 << at)
    return masks


def myers_search(masks: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """(least edit distance of the pattern to a stretch of ``text``, the first end of such a stretch).

    Myers (1999): the vertical differences of a column of the distance matrix
    as two bit vectors, here Python integers of m bits.
    """
    full, last = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, best_end = m, 0
    for at, char in enumerate(text, 1):
        match = masks.get(char, 0)
        diagonal = (((match & plus) + plus) ^ plus) | match | minus
        up = minus | (full & ~(diagonal | plus))
        down = plus & diagonal
        if up & last:
            score += 1
        elif down & last:
            score -= 1
        up = (up << 1) & full
        down = (down << 1) & full
        match |= minus
        plus = down | (full & ~(match | up))
        minus = up & match
        if score < best:
            best, best_end = score, at
    return best, best_end


class PieceIndex:
    """The pieces of a block of items, and the search of a text for the items."""

    def __init__(self, items: list[tuple[int | None, str]], rate: float = ERROR_RATE,
                 min_piece: int = MIN_PIECE):
        self.items, self.min_piece = [], min_piece
        owners: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            item = normalised(text)
            if not item:
                continue
            k = error_budget(len(item), rate, min_piece)
            for offset, piece in pieces(item, k):
                owners.setdefault(piece, []).append((len(self.items), offset))
            self.items.append((item_id, item, k, pattern_masks(item), pattern_masks(item[::-1])))
        self.automaton = ahocorasick.Automaton()
        for piece, owned in owners.items():
            self.automaton.add_word(piece, (len(piece), owned))
        if owners:
            self.automaton.make_automaton()

    def search(self, text: str | None) -> list[tuple[int | None, int, int, int]]:
        """(item id, distance, start, stop) of each item in the text, at its best stretch.

        Start and stop count characters of the normalised text.  Rows come by id, those without one last.
        """
        if not self.items or not text:
            return []
        text = normalised(text)
        best: dict[int, tuple[int, int, int]] = {}
        seen: set[tuple[int, int]] = set()
        for end, (size, owned) in self.automaton.iter(text):
            begin = end - size + 1
            for at, offset in owned:
                _, item, k, masks, backward = self.items[at]
                if at in best and best[at][0] == 0 or (at, begin - offset) in seen:
                    continue
                seen.add((at, begin - offset))
                low = max(0, begin - offset - k)
                stretch = text[low:begin - offset + len(item) + k]
                if len(item) < self.min_piece:
                    whole = f" {text[max(0, begin - 1):end + 2]} "
                    if f" {item} " not in whole:
                        continue
                exact = stretch.find(item)
                if exact >= 0:
                    best[at] = (0, low + exact, low + exact + len(item))
                    continue
                if not k:
                    continue
                distance, stop = myers_search(masks, len(item), stretch)
                if distance <= k and (at not in best or distance < best[at][0]):
                    _, length = myers_search_from_end(backward, len(item), stretch[:stop], distance)
                    best[at] = (distance, low + stop - length, low + stop)
        found = [(self.items[at][0], *where) for at, where in best.items()]
        return sorted(found, key=lambda hit: (hit[0] is None, hit[0] or 0, *hit[1:]))


def myers_search_from_end(backward: dict[str, int], m: int, stretch: str, distance: int) -> tuple[int, int]:
    """(distance, length) of the shortest suffix of ``stretch`` at that distance."""
    return myers_search(backward, m, stretch[::-1])


def item_blocks(benchmark: DataFrame, key: str, text: str,
                block_chars: int) -> Iterator[list[tuple[int | None, str]]]:
    """The items in blocks of at most ``block_chars`` characters (or one item)."""
    block, used = [], 0
    rows = benchmark.where(F.col(text).isNotNull()).select(F.col(key).cast("long"), text)
    for item_id, item in rows.toLocalIterator():
        if block and used + len(item) > block_chars:
            yield block
            block, used = [], 0
        block.append((item_id, item))
        used += len(item)
    if block:
        yield block


def scanned(docs: DataFrame, items: list[tuple[int | None, str]], text: str = "text", rate: float = ERROR_RATE,
            min_piece: int = MIN_PIECE, hits_name: str = "d_hits") -> DataFrame:
    """``docs`` with the column ``hits_name``: what of ``items`` each text holds."""
    held = docs.sparkSession.sparkContext.broadcast(items)  # one block, of bounded size
    at = docs.columns.index(text)
    schema = StructType([*docs.schema.fields, StructField(hits_name, ArrayType(StructType([
        StructField("item_id", LongType()), StructField("distance", IntegerType()),
        StructField("start", LongType()), StructField("stop", LongType())])))])
    hit_type = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32()),
                                   ("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches):
        index = PieceIndex(held.value, rate, min_piece)
        for batch in batches:
            hits = [[dict(zip(("item_id", "distance", "start", "stop"), h)) for h in index.search(t)]
                    for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hits, type=hit_type)],
                                             names=[*batch.schema.names, hits_name])

    return docs.mapInArrow(run, schema)


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
                 item_key: str = "item_id", item_text: str = "text", rate: float = ERROR_RATE,
                 block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, distance, start, stop) of every item found in a document."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("d_text"))
    found = None
    for items in item_blocks(benchmark, item_key, item_text, block_chars):
        part = (scanned(rows, items, "d_text", rate).select("doc_id", F.explode("d_hits").alias("h"))
                .select("doc_id", "h.item_id", "h.distance", "h.start", "h.stop"))
        found = part if found is None else found.unionByName(part)
    if found is None:
        return rows.select("doc_id", F.lit(None).cast("long").alias("item_id"), F.lit(0).alias("distance"),
                           F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("stop")).where("false")
    return found


def clean_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id",
                    item_text: str = "text", rate: float = ERROR_RATE,
                    block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` without those that hold an item; columns and other rows unchanged."""
    hits = "d_hits"
    while hits in {name.lower() for name in docs.columns}:
        hits += "_"
    for items in item_blocks(benchmark, item_key, item_text, block_chars):
        docs = scanned(docs, items, text, rate, hits_name=hits).where(F.size(hits) == 0).drop(hits)
    return docs
