"""Document fingerprints by winnowing.

Every run of ``GRAM`` code points of a text has a hash.  Of every ``WINDOW``
consecutive hashes the least is chosen, the rightmost of equals; the chosen
hashes with their positions are the fingerprint.  Any stretch of at least
``GRAM + WINDOW - 1`` code points that two texts share leaves a common hash in
both fingerprints, and no shared stretch under ``GRAM`` code points does.

Method: a text as UTF-32 bytes has its k-grams at fixed offsets, so each
hash is one slice and one XXH64, whatever the text's script.  The order hash
(36 bits) and the complement of the position make one long, whose least value
in a window is the least hash at its rightmost place.  A fold over
the longs keeps the least of the window and searches the window again only
when that one leaves it.  Windows are taken in segments of ``SEGMENT``, so that the arrays of a very
long text stay small.  All of it is Spark's own array functions.

The edited text of the registered query needs the next document by id.  Ids
are cut into buckets at approximate quantiles; a window function finds the
next row inside a bucket, and the first row of the next bucket that has one
is looked up in a table of one row per bucket.  The edited text is made of
prefixes of two texts; its fingerprint is theirs up to the seam, and only the
windows across the seam are hashed again.

Scale: fingerprints are made where the texts are read.  The one shuffle moves
each text and fingerprint to its bucket, whose size is a parameter
(``BUCKET_ROWS``) and does not grow with the input.

Defined cases: a null text is empty.  A text shorter than a gram is one gram;
an empty text has an empty fingerprint.  The likeness of two empty
fingerprints is 1, of an empty and another 0.  Rows without an id come first;
rows of the same id are ordered by text.  A single row is its own next row.
An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from salesmart.llm.common import written

GRAM = 16
WINDOW = 32
SEGMENT = 256
BUCKET_ROWS = 4000
MOST_BUCKETS = 1 << 16
_PLACES = (1 << 27) - 1  # positions take 27 bits: texts of up to 134 million code points


def _bound(value: Column, use) -> Column:
    """``use(value)``, with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _window_minima(keys: Column, window: int, first: Column) -> Column:
    """The least key of each run of ``window`` keys (of all, if fewer), each time it changes.

    The last least key holds until a lesser one comes or its place leaves the
    window; only then is the window searched again.  ``first`` is the place of
    the first key.
    """
    place = F.lit(_PLACES).cast("long")

    def step(found, key):
        last = F.element_at(found, -1)
        outside = last.bitwiseAND(place) - key.bitwiseAND(place) >= window
        at = (place - key.bitwiseAND(place)).cast("int") - first + 1
        again = F.array_min(F.transform(F.sequence(at - (window - 1), at), lambda i: F.element_at(keys, i)))
        return (F.when(key < last, F.array_append(found, key))
                .when(outside, F.array_append(found, again)).otherwise(found))

    return F.aggregate(F.slice(keys, F.lit(window + 1), F.size(keys)),
                       F.array(F.array_min(F.slice(keys, 1, window))), step)


def winnow(text: Column, gram: int = GRAM, window: int = WINDOW, segment: int = SEGMENT) -> Column:
    """array<struct<pos:int,hash:bigint>> of the chosen grams of a text."""
    return _bound(_text32(text), lambda b: _hashes_at(b, _places(b, gram, window, segment), gram))


def winnow_places(text: Column, gram: int = GRAM, window: int = WINDOW, segment: int = SEGMENT) -> Column:
    """Only the places of the chosen grams: with the text they give its fingerprint (``hashes_at``)."""
    return _bound(_text32(text), lambda b: _places(b, gram, window, segment))


def hashes_at(text: Column, places: Column, gram: int = GRAM) -> Column:
    """The fingerprint of a text from its chosen places."""
    return _bound(_text32(text), lambda b: _hashes_at(b, places, gram))


def _text32(text: Column) -> Column:
    """UTF-32 bytes.  To functions of an array's element they are one object; as a column each use would copy them."""
    return F.encode(F.coalesce(text, F.lit("")), "UTF-32")


def _gram_hash(text32: Column, place: Column, gram: int) -> Column:
    return F.xxhash64(F.substring(text32, place * 4 + 1, F.lit(gram * 4)))


def _hashes_at(text32: Column, places: Column, gram: int) -> Column:
    return F.transform(places, lambda p: F.struct(p.alias("pos"), _gram_hash(text32, p, gram).alias("hash")))


def _places(text32: Column, gram: int, window: int, segment: int) -> Column:
    chars = (F.length(text32) / 4).cast("int")
    grams = F.greatest(chars - (gram - 1), F.lit(1))
    windows = F.greatest(grams - (window - 1), F.lit(1))

    def chosen(number):
        first = number * segment
        stop = F.least(first + segment, windows)
        keys = F.transform(
            F.sequence(first, F.least(stop + (window - 1), grams) - 1),
            lambda p: F.shiftleft(F.shiftrightunsigned(_gram_hash(text32, p, gram), 28), 27) + (F.lit(_PLACES).cast("long") - p))
        return _bound(keys, lambda k: _window_minima(k, window, first))

    keys = F.flatten(F.transform(
        F.sequence(F.lit(0), ((windows - 1) / segment).cast("int")), chosen))
    # A place chosen in two segments is in both; one text has each place once.
    picked = F.transform(
        F.array_distinct(keys),
        lambda key: (F.lit(_PLACES) - key.bitwiseAND(F.lit(_PLACES).cast("long"))).cast("int"))
    return F.when(F.length(text32) == 0, F.array().cast("array<int>")).otherwise(picked)


def _order(mark) -> Column:
    """Hash and place of a chosen gram as one long: the least is the least hash, the rightmost of equals."""
    return (F.shiftleft(F.shiftrightunsigned(mark.getField("hash"), 28), 27)
            + (F.lit(_PLACES).cast("long") - mark.getField("pos")))


def _prefix_marks(marks: Column, chars: Column, gram: int, window: int) -> Column:
    """The fingerprint of a text's first ``chars`` code points (a window at least), from the text's own.

    The windows of the prefix are windows of the text; the last one's choice is
    the least of the chosen grams in it, and none after it belongs to the prefix.
    """
    grams = chars - (gram - 1)
    last = F.filter(marks, lambda x: (x.getField("pos") >= grams - window) & (x.getField("pos") < grams))
    place = F.lit(_PLACES).cast("long")
    return _bound(F.array_min(F.transform(last, _order)), lambda key: F.filter(
        marks, lambda x: x.getField("pos") <= place - key.bitwiseAND(place)))


def spliced(df: DataFrame, name: str, text: str, marks: Column, kept: str, next_marks: Column, added: str,
            gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``df`` with the fingerprint ``name`` of ``text``, made of prefixes of two texts with known fingerprints.

    The first ``kept`` (a column) code points are a prefix of the text of
    ``marks``, the other ``added`` ones of that of ``next_marks``.  Only the
    windows across the seam are hashed; the result is that of ``winnow``.
    """
    kept, added = F.col(kept), F.col(added)
    whole = gram + window - 1
    none = F.array().cast("array<struct<pos:int,hash:bigint>>")

    def moved(found, by):
        return F.transform(found, lambda x: F.struct((x.getField("pos") + by).alias("pos"), x.getField("hash").alias("hash")))

    begin = F.when(kept >= whole, kept - (whole - 1)).otherwise(0)
    end = F.when(added >= whole, kept + (whole - 1)).otherwise(kept + added)
    seam = F.when((kept >= whole) & (added == 0), none).otherwise(
        moved(winnow(F.substring(F.col(text), begin + 1, end - begin), gram, window), begin))
    parts = (df.withColumn("z_left", F.when(kept >= whole, _prefix_marks(marks, kept, gram, window)).otherwise(none))
             .withColumn("z_right", F.when(added >= whole, moved(_prefix_marks(next_marks, added, gram, window), kept))
                         .otherwise(none))
             .withColumn("z_seam", seam))
    # The chosen places rise from window to window, so those across the seam lie between the others.
    low = F.coalesce(F.try_element_at("z_left", F.lit(-1)).getField("pos"), F.lit(-1))
    high = F.coalesce(F.try_element_at("z_right", F.lit(1)).getField("pos"), F.lit(_PLACES))
    parts = parts.withColumn("z_low", low).withColumn("z_high", high)
    between = F.filter("z_seam", lambda x: (x.getField("pos") > F.col("z_low")) & (x.getField("pos") < F.col("z_high")))
    return parts.withColumn(name, F.concat("z_left", between, "z_right")).drop(
        "z_left", "z_right", "z_seam", "z_low", "z_high")


def digest(fingerprint: Column) -> Column:
    """A 16-digit hexadecimal number of the chosen hashes and their positions."""
    chained = F.aggregate(fingerprint, F.lit(42).cast("long"),
                          lambda acc, x: F.xxhash64(acc, x.getField("pos"), x.getField("hash")))
    return F.lower(F.lpad(F.hex(chained), 16, "0"))


def likeness(a: Column, b: Column) -> Column:
    """Shared hashes over all hashes of two fingerprints (0 to 1)."""
    x, y = a.getField("hash"), b.getField("hash")
    every = F.size(F.array_union(x, y))
    return F.when(every == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(x, y)) / every)


def _bucket(key: Column, bounds: list[int]) -> Column:
    """The number of bounds that are at most the key (none for a null key).

    Looked up in two levels, so that a row is compared with some hundreds of
    numbers at most.
    """
    if not bounds:
        return F.lit(0)
    at = F.coalesce(key.cast("long"), F.lit(-(1 << 63)))
    width = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[i:i + width] for i in range(0, len(bounds), width)]
    firsts = F.array(*[F.lit(g[0]).cast("long") for g in groups])
    inner = F.array(*[F.array(*[F.lit(x).cast("long") for x in g]) for g in groups])
    group = F.size(F.filter(firsts, lambda x: x <= at))
    within = F.size(F.filter(F.element_at(inner, F.greatest(group, F.lit(1))), lambda x: x <= at))
    return F.when(group == 0, 0).otherwise((group - 1) * width + within)


def with_next(rows: DataFrame, key: str, text: str, mark: str, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``rows`` with the fingerprint ``mark`` of ``text`` and ``next``, a struct of both of the next row by ``key``.

    Rows of one key are ordered by text; after the last row comes the first.
    """
    ids = rows.select(F.col(key).cast("long").alias("b_key"))
    buckets = max(1, min(MOST_BUCKETS, -(-ids.count() // bucket_rows)))
    bounds: list[int] = []
    if buckets > 1:
        shares = [i / buckets for i in range(1, buckets)]
        found = ids.agg(F.percentile_approx("b_key", shares, 100 * buckets).alias("q")).first()["q"]
        bounds = sorted(set(found or []))
    placed = rows.withColumn("b_bucket", _bucket(F.col(key), bounds))
    least = F.min(F.struct(F.col(key).isNotNull().alias("has"), F.col(key).alias("key"), F.col(text).alias("text")))
    heads = placed.groupBy("b_bucket").agg(least.alias("b_least"))  # one row per bucket
    ahead = Window.orderBy("b_bucket")
    following = heads.select(
        F.col("b_bucket").alias("h_bucket"),
        F.coalesce(F.lead("b_least.text").over(ahead), F.first("b_least.text").over(ahead)).alias("h_text"))
    following = written(following.withColumn("h_places", winnow_places(F.col("h_text"))), "fingerprint-next")
    order = [F.col(key).asc_nulls_first(), F.col(text).asc_nulls_first()]
    inside = Window.partitionBy("b_bucket").orderBy(*order)
    # Through the shuffle go the texts and the chosen places only.
    found = (placed.withColumn("b_places", winnow_places(F.col(text)))
             .withColumn("b_next", F.lead(F.struct(F.col(text).alias("text"), F.col("b_places").alias("places"))).over(inside))
             .join(following, F.col("b_bucket") == F.col("h_bucket"), "left")
             .withColumn("b_text", F.coalesce("b_next.text", "h_text"))
             .withColumn("b_next_places", F.coalesce("b_next.places", "h_places")))
    return (found.withColumn(mark, hashes_at(F.col(text), F.col("b_places")))
            .withColumn("next", F.struct(F.col("b_text").alias("text"),
                                         hashes_at(F.col("b_text"), F.col("b_next_places")).alias("mark")))
            .drop("b_next", "b_places", "b_text", "b_next_places", "h_text", "h_places", "b_bucket", "h_bucket"))


def with_edited(df: DataFrame) -> DataFrame:
    """``df`` (text, mark, next) with ``edited`` and its fingerprint ``edited_mark``.

    The edited text is ``text`` with its last floor(n / 2) code points replaced
    by the first as many, or all, of the next text.
    """
    half = F.floor(F.length("text") / 2).cast("int")
    # As columns of their own the lengths are counted once, not for every gram compared with them.
    edited = (df.withColumn("e_kept", F.length("text") - half)
              .withColumn("e_added", F.least(half, F.length("next.text")))
              .withColumn("edited", F.concat(F.substring("text", F.lit(1), F.col("e_kept")),
                                             F.substring(F.col("next.text"), F.lit(1), F.col("e_added")))))
    return spliced(edited, "edited_mark", "edited", F.col("mark"), "e_kept", F.col("next.mark"), "e_added").drop(
        "e_kept", "e_added")
