"""Document fingerprints by Order MinHash, in built-in functions only.

The k-mers of a text are its runs of ``k`` words. A word of more than ``LONG`` code points, as in
scripts without blanks, encoded data or minified code, stands for its overlapping runs of ``UNIT``
code points, so that an edit inside it changes a few k-mers and not all. Each k-mer carries its
occurrence number within the text, so that repeats count. A 36-bit hash of (k-mer, occurrence)
places every k-mer on a ring.
For each of ``sketches`` evenly spaced points, the next ``length`` k-mers on the ring are the
minimal ones of that point's order; they are put back into text order and their tuple is
hashed. Likeness is the share of equal tuples: it falls with edits and with moved passages.
One hash and one sort serve all sketches (rotations of one order instead of many orders).

All passes over a text are linear but for two primitive sorts: k-mers are packed as
hash << 27 | position, equal ones lie side by side, so occurrence numbers follow from stretches.

Defined results: null and empty texts, and texts of white space, have one empty k-mer; texts
with fewer than ``k`` words have their whole sequence as one. Rows with the same id are ordered
by text, rows without an id come last. An empty table gives an empty result. Input columns stay;
one named like an added column is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillflow.llm.frames import packed, text_of, unpacked

PLACE_BITS, HASH_BITS = 27, 36
LONG, UNIT = 32, 4
# ASCII white space as SQL string literals, which know no escape for the form feed.
SPACE_SQL, SPACE_CLASS_SQL = " \\t\\n\\u000B\\u000C\\r", "[ \\t-\\r]+"


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is evaluated once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def signature(text: str, k: int = 3, length: int = 2, sketches: int = 64) -> Column:
    """The tuple hashes of the text in a column, one for each sketch. ``sketches`` is a power of two."""
    down = f"shiftright({{}}, {PLACE_BITS})"
    place = f"({{}} & {(1 << PLACE_BITS) - 1}L)"
    point = f"cast(shiftright({{}}, {PLACE_BITS + HASH_BITS - sketches.bit_length() + 1}) as int)"
    run = ", ".join(f"get(wh, i + {j})" for j in range(k))
    pack = (f"shiftleft(shiftrightunsigned({{}}, {64 - HASH_BITS}), {PLACE_BITS})"
            " | cast({} as bigint)")

    # Stretches of equal values under ``by``: where each begins.
    def begins(array: str, by: str) -> str:
        return (f"filter(sequence(0, size({array}) - 1), i -> i = 0 or "
                f"{by.format(f'get({array}, i)')} <> {by.format(f'get({array}, i - 1)')})")

    kmers = (f"sort_array(transform(sequence(0, greatest(size(wh) - {k}, 0)), "
             f"i -> {pack.format(f'xxhash64({run})', 'i')}))")
    numbered = pack.format(f"xxhash64({down.format('x')}, {{}})", place.format("x"))
    repeated = ("flatten(transform(st, (s, g) -> transform(slice(km, s + 1, "
                "coalesce(get(st, g + 1), size(km)) - s), (x, o) -> " + numbered.format("o") + ")))")
    ring = (f"sort_array(if(size(st) = size(km), transform(km, x -> {numbered.format('0')}), "
            f"{repeated}))")
    # First k-mer at or after each point; past the last point the ring starts again.
    firsts = ("flatten(array(flatten(transform(bs, (s, g) -> array_repeat(s, "
              f"{point.format('get(rg, s)')} - if(g = 0, -1, {point.format('get(rg, get(bs, g - 1))')})))), "
              f"array_repeat(0, {sketches - 1} - {point.format('get(rg, size(rg) - 1)')})))")
    chosen = (f"transform(sequence(0, {length - 1}), j -> {_let('x', 'get(rg, (s + j) % size(rg))', f'shiftleft({place.format('x')}, {HASH_BITS}) | {down.format('x')}')})")
    mask = (1 << HASH_BITS) - 1
    tuples = f"transform(fs, s -> xxhash64(transform(sort_array({chosen}), y -> y & {mask}L)))"
    body = _let("rg", ring, _let("bs", begins("rg", point), _let("fs", firsts, tuples)))
    body = _let("km", kmers, _let("st", begins("km", down), body))
    unit = ", ".join(f"get(cs, i + {j})" for j in range(UNIT))
    units = _let("cs", "split(w, '')",
                 f"transform(sequence(0, size(cs) - {UNIT}), i -> xxhash64({unit}))")
    body = _let("wh", f"if(exists(ws, w -> char_length(w) > {LONG}), "
                f"flatten(transform(ws, w -> if(char_length(w) > {LONG}, {units}, array(xxhash64(w))))), "
                "transform(ws, w -> xxhash64(w)))", body)
    return F.expr(_let("ws", f"split(btrim({text}, '{SPACE_SQL}'), '{SPACE_CLASS_SQL}')", body))


def as_text(sig: Column) -> Column:
    """Eight hexadecimal digits for each sketch."""
    return F.array_join(F.transform(sig, lambda v: F.lpad(
        F.lower(F.hex(v.bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """The share of equal sketches."""
    equal = F.zip_with(a, b, lambda x, y: (x == y).cast("int"))
    return F.aggregate(equal, F.lit(0), lambda n, x: n + x) / F.size(a)


def slice_of(value: Column, cuts: list[int]) -> Column:
    """How many cuts lie below the value, found in two steps of about sqrt(len(cuts)) tests."""
    if not cuts:
        return F.lit(0)
    wide = max(1, int(len(cuts) ** 0.5))
    rows = [cuts[i:i + wide] for i in range(0, len(cuts), wide)]

    def below(array: Column) -> Column:
        return F.size(F.filter(array, lambda c: c < value))

    heads = F.lit([r[0] for r in rows]).cast("array<long>")
    table = F.array(*[F.lit(r).cast("array<long>") for r in rows])
    row = F.greatest(below(heads) - 1, F.lit(0))
    return row * wide + F.aggregate(
        F.get(table, row), F.lit(0), lambda n, c: n + (c < value).cast("int"))


def with_next(docs: DataFrame, slices: int, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """Packed rows (row, id, text, next_text) in descending order of id; the last meets the first.

    Ids are cut into slices at quantiles. The first row of every slice is added once more at
    the end of the slice above, so each neighbour is found inside one slice.
    """
    at = [i / slices for i in range(1, slices)]
    quantiles = docs.agg(F.percentile_approx(F.col(id_col).cast("long"), at, 10 * slices)
                         .alias("cuts")).first()["cuts"] if at else []
    cuts = sorted(set(quantiles or []))
    id_ = F.col(id_col).cast("long")
    rows = packed(docs, part=F.coalesce(slice_of(id_, cuts), F.lit(0)), id=id_,
                  text=text_of(F.col(text_col)))
    order = F.struct(F.col("id").isNull(), -F.col("id"), F.col("text"))
    heads = rows.groupBy("part").agg(F.min_by("text", order).alias("text"))
    # At most one row for each slice.
    down = Window.orderBy(F.col("part").desc())
    ends = heads.select("part", F.coalesce(
        F.lead("text").over(down),
        F.first("text").over(down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ).alias("text"))
    empty = F.lit(None)
    ends = ends.select("part", empty.cast("long").alias("id"), "text",
                       empty.cast(rows.schema["row"].dataType).alias("row"), F.lit(1).alias("end"))
    return rows.withColumn("end", F.lit(0)).unionByName(ends)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3,
                 length: int = 2, sketches: int = 64) -> DataFrame:
    """Adds to every row: n_chars, edited_text, fingerprint, edited_fingerprint, near_edited and
    near_next.

    The edited text has the last half of its code points replaced by as many from the start of
    the next text; ``near_edited`` and ``near_next`` are likenesses to it and to the next text.
    """
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = with_next(docs, 4 * width, id_col, text_col)
    signed = rows.withColumn("sig", signature("text", k, length, sketches))
    order = Window.partitionBy("part").orderBy(
        "end", F.col("id").desc_nulls_last(), "text")
    following = F.lead(F.struct("text", "sig")).over(order)
    found = signed.withColumn("next", following).where("end = 0").select(
        "row", "text", "sig", F.col("next.text").alias("next_text"),
        F.col("next.sig").alias("next_sig"), F.char_length("text").alias("n"))
    half = F.floor(F.col("n") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n") - half),
                      F.substring("next_text", F.lit(1), half))
    found = found.withColumn("edited", edited)
    found = found.withColumn("edited_sig", signature("edited", k, length, sketches))
    return unpacked(
        found, docs.columns,
        n_chars=F.col("n").cast("long"), edited_text=F.col("edited"),
        fingerprint=as_text(F.col("sig")), edited_fingerprint=as_text(F.col("edited_sig")),
        near_edited=likeness(F.col("sig"), F.col("edited_sig")),
        near_next=likeness(F.col("sig"), F.col("next_sig")))
