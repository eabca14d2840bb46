"""Token counts by a compiled finite-state tokenizer.

The vocabulary is a BPE model whose pieces hold the space mark only at their
start (or are runs of it).  A text is a sequence of chunks, each a run of
blanks and the characters after it; no piece crosses from one chunk into the
next, so the tokenizer's state is the same at every chunk start.

Method: the merges are compiled into a deterministic transducer over
characters.  A tokenization is the BPE one exactly if every two neighbouring
tokens are what BPE makes of their joined text; so the last token at each
position follows from the last tokens at the positions a later token may
start from.  A state is that list of open positions with, for each, its last
token and its count relative to the current one; a transition carries the
change of the count.  States and transitions are made when first met and kept.

The state map of a stretch of text is (head, count, tail): what stands before
the first chunk start inside it, the tokens of the whole chunks, and what
stands after the last chunk start.  Maps compose associatively (``compose``),
so the map of a text is the prefix scan of the maps of its pieces, whatever
the cuts.

Scale: texts of up to ``CHUNK_BYTES`` are counted where they are read, with no
shuffle.  Longer ones are cut into pieces that are dealt over all tasks; only
their maps are gathered per text and scanned.  The vocabulary (some ten
thousand pieces) is broadcast; the transducer and the counts of words met are
bounded per task by ``MOST_STATES`` and ``MOST_WORDS`` and started again
beyond them, which costs time and changes nothing.

Defined cases: null and empty texts have no tokens.  Characters that the
vocabulary lacks count one token for each UTF-8 byte.  Special strings are
ordinary text, no begin or end token is added.  Repeated rows keep their rows.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

MARK = "▁"
CHUNK_BYTES = 1 << 20
MOST_STATES = 400_000
MOST_WORDS = 400_000
LIMIT = 4096


def read_vocabulary(path: str) -> dict[str, float]:
    """{piece: score} of the ordinary pieces of a sentencepiece BPE model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return {model.id_to_piece(i): model.get_score(i) for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))}


class Transducer:
    """The compiled tokenizer: counts tokens character by character."""

    def __init__(self, vocabulary: dict[str, float]):
        self.vocabulary = vocabulary
        if any(MARK in p.lstrip(MARK) or (p.startswith(MARK * 2) and p.strip(MARK)) for p in vocabulary):
            raise ValueError("a piece holds the space mark after another character")
        self.words_only = {p for p in vocabulary if p.strip(MARK)} | {MARK}
        self.starts = {p[:i] for p in self.words_only for i in range(1, len(p))}
        self.agree: dict[tuple[str, str], bool] = {}
        self.reachable: dict[str, bool] = {}
        self.blank_runs: dict[int, int] = {}
        self._fresh()

    def _fresh(self) -> None:
        self.states: dict[tuple, int] = {}
        self.spec: list[tuple] = []
        self.moves: list[dict[str, tuple[int, int]]] = []
        # Before the mark: one open position, no last token.
        self.zero = self._state((("", "", 0),))
        self.start, self.start_count = self._move(self.zero, MARK)

    def _state(self, spec: tuple) -> int:
        at = self.states.get(spec)
        if at is None:
            at = self.states[spec] = len(self.spec)
            self.spec.append(spec)
            self.moves.append({})
        return at

    def merged(self, text: str) -> list[str]:
        """BPE by its definition: again and again the best pair, the leftmost of equals.  For short texts."""
        parts, score = list(text), self.vocabulary
        while len(parts) > 1:
            best, where = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, where = s, i
            if where < 0:
                break
            parts[where:where + 2] = [parts[where] + parts[where + 1]]
        return parts

    def tokens_of(self, piece: str) -> int:
        return 1 if piece in self.vocabulary else len(piece.encode())

    def _whole(self, piece: str) -> bool:
        known = self.reachable.get(piece)
        if known is None:
            known = self.reachable[piece] = self.merged(piece) == [piece]
        return known

    def _neighbours(self, left: str, right: str) -> bool:
        pair = (left, right)
        known = self.agree.get(pair)
        if known is None:
            if len(self.agree) > MOST_STATES:
                self.agree.clear()
            known = self.agree[pair] = self.merged(left + right) == [left, right]
        return known

    def _move(self, state: int, char: str) -> tuple[int, int]:
        """The transition of ``state`` on ``char``: (next state, change of the count)."""
        open_positions = self.spec[state]
        for since, last, count in open_positions:  # the earliest start first: the longest token
            token = since + char
            if (not since or token in self.words_only and self._whole(token)) and (
                    not last or self._neighbours(last, token)):
                change = count + self.tokens_of(token)
                break
        else:
            raise AssertionError(f"no token ends with {char!r}")
        later = tuple((since + char, before, n - change) for since, before, n in open_positions
                      if since + char in self.starts)
        move = (self._state(later + (("", token, 0),)), change)
        self.moves[state][char] = move
        return move

    def word(self, text: str) -> int:
        """Tokens of the mark followed by ``text``, which holds no mark."""
        if len(self.spec) > MOST_STATES:
            self._fresh()
        state, total, moves = self.start, self.start_count, self.moves
        for char in text:
            move = moves[state].get(char)
            if move is None:
                move = self._move(state, char)
            state, change = move
            total += change
        return total

    def _first_token(self, text: str) -> str:
        """First token of ``text`` (no mark before it), by the last tokens of its prefixes."""
        longest = max(map(len, self.words_only))
        firsts, lasts = [""], [""]
        for end in range(1, len(text) + 1):
            for begin in range(max(0, end - longest), end):
                token = text[begin:end]
                if (end - begin == 1 or token in self.words_only and self._whole(token)) and (
                        not lasts[begin] or self._neighbours(lasts[begin], token)):
                    lasts.append(token)
                    firsts.append(firsts[begin] or token)
                    break
        return firsts[-1]

    def blanks(self, n: int) -> int:
        """Tokens of a run of n marks that nothing else is merged with."""
        if n > 64:  # a run fills whole pieces of the longest length from the left
            longest = max((len(p) for p in self.vocabulary if not p.strip(MARK)), default=1)
            whole = (n - 32) // longest
            return whole + self.blanks(n - whole * longest)
        if n not in self.blank_runs:
            self.blank_runs[n] = len(self.merged(MARK * n))
        return self.blank_runs[n]

    def chunk(self, blanks: int, text: str) -> int:
        """Tokens of a chunk: ``blanks`` marks and the characters after them."""
        if not text:
            return self.blanks(blanks)
        if blanks == 1:
            return self.word(text)
        # The last mark joins the word unless BPE leaves it alone; the others merge among themselves last.
        alone = self._neighbours(MARK, self._first_token(text))
        return self.word(text) - alone + self.blanks(blanks - 1 + alone)


class WordCounts(dict):
    """Counts of the words met, each after one blank."""

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.transducer = transducer

    def __missing__(self, word: str) -> int:
        if len(self) > MOST_WORDS:
            self.clear()
        count = self.transducer.word(word)
        if len(word) <= 64:
            self[word] = count
        return count


_COMPILED: dict[int, WordCounts] = {}


def compiled(vocabulary: dict[str, float]) -> WordCounts:
    """The counts of a vocabulary; a Python worker keeps the last one for its later tasks."""
    mark = hash(frozenset(vocabulary.items()))
    if mark not in _COMPILED:
        _COMPILED.clear()
        _COMPILED[mark] = WordCounts(Transducer(vocabulary))
    return _COMPILED[mark]


_CHUNK = re.compile(r"( +)([^ ]*)")


def counted(text: str, words: WordCounts) -> int:
    """Tokens of whole chunks: ``text`` is empty or starts with a blank."""
    if "  " not in text and not text.endswith(" "):
        return sum(map(words.__getitem__, text.split(" ")[1:])) if text else 0
    chunk = words.transducer.chunk
    return sum(words[m[2]] if len(m[1]) == 1 and m[2] else chunk(len(m[1]), m[2]) for m in _CHUNK.finditer(text))


StateMap = tuple[str, int, str | None]


def state_map(text: str, words: WordCounts) -> StateMap:
    """(head, count, tail) of a stretch; tail None: no chunk starts inside it, head is all of it."""
    inside = re.search(r"(?<=[^ ]) ", text)
    if inside is None:
        return text, 0, None
    first = inside.start()
    end = len(text.rstrip(" "))
    last = text.rfind(" ", first, end)
    last = len(text[:last + 1].rstrip(" ")) if last >= 0 else first
    if end < len(text):  # blanks at the end begin a chunk of their own
        last = end
    return text[:first], counted(text[first:last], words), text[last:]


def compose(a: StateMap, b: StateMap, words: WordCounts) -> StateMap:
    """The map of the stretch of ``a`` followed by that of ``b``."""
    if a[2] is None and b[2] is None:
        return state_map(a[0] + b[0], words)
    if a[2] is None:
        head, count, tail = state_map(a[0] + b[0], words)
        if tail is None:
            return head, b[1], b[2]
        return head, count + counted(tail, words) + b[1], b[2]
    if b[2] is None:
        head, count, tail = state_map(a[2] + b[0], words)
        return (a[0], a[1], head) if tail is None else (a[0], a[1] + counted(head, words) + count, tail)
    return a[0], a[1] + counted(a[2] + b[0], words) + b[1], b[2]


def map_count(m: StateMap, words: WordCounts) -> int:
    """Tokens of a whole text (that starts with a blank) from its map."""
    return counted(m[0], words) + m[1] + counted(m[2] or "", words)


def scan(maps: list[StateMap], words: WordCounts) -> list[StateMap]:
    """Inclusive prefix scan under ``compose`` in a logarithmic number of rounds."""
    maps, reach = list(maps), 1
    while reach < len(maps):
        maps = maps[:reach] + [compose(maps[i - reach], maps[i], words) for i in range(reach, len(maps))]
        reach *= 2
    return maps


def _fold(maps: list[StateMap], words: WordCounts) -> StateMap:
    """The last map of the scan, by rounds over neighbours."""
    while len(maps) > 1:
        maps = [compose(*maps[i:i + 2], words) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
    return maps[0]


def _blanked(text: str) -> str:
    return text.replace(MARK, " ")


def count_text(text: str | None, words: WordCounts) -> int:
    return counted(" " + _blanked(text), words) if text else 0


def token_counts(docs: DataFrame, vocabulary: dict[str, float], key: str = "doc_id", text: str = "text",
                 chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row of ``docs``."""
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = docs.select(F.col(key).alias("t_id"), F.col(text).alias("t_text"),
                       F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("t_bytes"))
    id_type = rows.schema["t_id"].dataType

    def count_whole(batches):
        words = compiled(held.value)
        for batch in batches:
            counts = [count_text(t, words) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(counts, type=pa.int64())],
                names=["t_id", "t_bytes", "t_tokens"])

    def map_pieces(batches):
        words = compiled(held.value)
        for batch in batches:
            maps = [state_map((" " if no == 0 else "") + _blanked(piece), words)
                    for no, piece in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], *[pa.array([m[i] for m in maps], type=kind)
                                       for i, kind in enumerate((pa.string(), pa.int64(), pa.string()))]],
                names=["t_row", "t_id", "t_bytes", "t_no", "head", "count", "tail"])

    def fold_maps(batches):
        words = compiled(held.value)
        for batch in batches:
            counts = [map_count(_fold([(m["head"], m["count"], m["tail"]) for m in maps], words), words)
                      for maps in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, type=pa.int64())],
                names=["t_id", "t_bytes", "t_tokens"])

    out = StructType([StructField("t_id", id_type), StructField("t_bytes", LongType()),
                      StructField("t_tokens", LongType())])
    short = rows.where(F.col("t_bytes") <= chunk_bytes).mapInArrow(count_whole, out)
    chars = F.length("t_text")
    cuts = F.sequence(F.lit(0), F.floor((chars - 1) / chunk_bytes).cast("int"))
    pieces = (rows.where(F.col("t_bytes") > chunk_bytes)
              .withColumn("t_row", F.monotonically_increasing_id())
              .select("t_row", "t_id", "t_bytes",
                      F.posexplode(F.transform(cuts, lambda i: F.substring(
                          "t_text", i * chunk_bytes + 1, F.lit(chunk_bytes)))).alias("t_no", "t_piece"))
              .repartition(F.xxhash64("t_row", "t_no")))
    maps = pieces.mapInArrow(map_pieces, StructType([
        StructField("t_row", LongType()), StructField("t_id", id_type), StructField("t_bytes", LongType()),
        *[f for f in pieces.schema.fields if f.name == "t_no"],
        *pieces.select(F.lit("").alias("head"), F.lit(0).cast("long").alias("count"),
                       F.lit(None).cast("string").alias("tail")).schema.fields]))
    gathered = (maps.groupBy("t_row").agg(
        F.first("t_id").alias("t_id"), F.first("t_bytes").alias("t_bytes"),
        F.sort_array(F.collect_list(F.struct("t_no", "head", "count", "tail"))).alias("maps"))
        .select("t_id", "t_bytes", "maps"))
    long = gathered.mapInArrow(fold_maps, out)
    return short.unionByName(long).select(F.col("t_id").alias(key), F.col("t_bytes").alias("n_bytes"),
                                          F.col("t_tokens").alias("n_tokens"))


def over_limit(tokens: Column, limit: int = LIMIT) -> Column:
    return tokens > limit
