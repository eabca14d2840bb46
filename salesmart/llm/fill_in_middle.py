"""Fill-in-middle transformation of documents.

A text is cut into n units, each a run of white space with the word after it
(or the white space that ends the text).  Two cuts fall after units drawn from
the document's id, and prefix, middle and suffix are put into the order psm
(prefix, suffix, middle) or spm (suffix, prefix, middle) behind their marks; a
share of the documents stays plain.  A document that holds a mark itself stays
plain, so that every output can be read back exactly (``restored``).

Method: one fullmatch of ``(unit)*`` with the regex library keeps every
repetition of its group.  The ends of the repetitions are the ends of all
units in code points: their number is n, and each cut is one look-up.  The
library's captures of one match are bounded by memory, so a text is matched in
blocks of at least ``BLOCK_CHARS`` characters that end where a unit ends; the
units of the blocks are those of the text.

Each document stands alone: there is no shuffle, and a task holds one text and
the ends of its units.

Defined cases: a null text counts as empty; an empty text is plain with n = 0.
A null id is hashed as no digits.  Repeated rows have equal results, an empty
table an empty one.  Other columns pass through; one that has the name of a
new column (in any case) is replaced by it.
"""

from __future__ import annotations

from array import array
from hashlib import sha256

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from salesmart.llm.common import with_columns_last

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_SPACE = r"\x20\x09-\x0D"
_UNITS = regex.compile(rf"([{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+)*")
_UNIT_END = regex.compile(rf"[^{_SPACE}](?=[{_SPACE}])")
BLOCK_CHARS = 1 << 20
NAMES = ["n", "form", "prefix_chars", "middle_chars", "output"]
_TYPE = "n long, form string, prefix_chars long, middle_chars long, output string"


def unit_ends(text: str, block: int = BLOCK_CHARS) -> array:
    """The ends of all units of ``text``, in code points."""
    ends, at = array("q"), 0
    while at < len(text):
        stop = _UNIT_END.search(text, at + block) if at + block < len(text) else None
        until = stop.end() if stop else len(text)
        ends.extend(_UNITS.fullmatch(text, at, until).ends(1))
        at = until
    return ends


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four unsigned 32-bit numbers of a document."""
    digest = sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]


def transformed(doc_id: int | None, text: str, seed: int, rate: int, spm_rate: int) -> dict:
    """The transformation of one document."""
    ends = unit_ends(text)
    n = len(ends)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or h3 % 100 >= rate or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return {"n": n, "form": "plain", "prefix_chars": None, "middle_chars": None, "output": text}
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (ends[k - 1] if k else 0 for k in (first, second))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm_rate:
        form, output = "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    else:
        form, output = "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return {"n": n, "form": form, "prefix_chars": a, "middle_chars": b - a, "output": output}


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 42,
                   rate: int = 50, spm_rate: int = 80) -> DataFrame:
    """``docs`` with n, form, prefix_chars, middle_chars and output.

    ``rate`` of 100 documents are transformed, ``spm_rate`` of 100 of those to
    the form spm.  The rates are drawn from the ids, so reruns agree.
    """
    def run(ids: pa.Array, texts: pa.Array) -> pa.Array:
        rows = [transformed(i.as_py(), t.as_py() or "", seed, rate, spm_rate) for i, t in zip(ids, texts)]
        return pa.array(rows, type=pa.struct([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                                              ("middle_chars", pa.int64()), ("output", pa.string())]))

    record = docs.select(F.struct("*").alias("f_row"))
    cut = F.arrow_udf(run, _TYPE)(F.col("f_row").getField(key).cast("long"), F.col("f_row").getField(text))
    found = record.select("f_row", cut.alias("f_cut"))
    return with_columns_last(found, "f_row", [F.col("f_cut").getField(n) for n in NAMES], NAMES)


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from.  No part holds a mark, so the marks split it into its parts."""
    parts = F.split(output, "<[PSM]>", -1)
    order = {"psm": (1, 3, 2), "spm": (2, 3, 1)}
    whole = {name: F.concat(*[parts.getItem(i) for i in at]) for name, at in order.items()}
    return (F.when(form == "psm", whole["psm"]).when(form == "spm", whole["spm"]).otherwise(output))
