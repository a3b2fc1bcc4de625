"""MinHash near-dedup with HyperMinHash registers.

Each document's distinct word shingles are hashed once to 64 bits. The upper bits choose one of
``BINS`` registers; of the smallest remainder in each the count of leading zeros and the next
``MANTISSA`` bits are kept, 16 bits in all. Registers, with empty ones filled from others in a
fixed order, are banded; documents that share a band are candidates. A candidate pair is compared
by the share of equal registers, corrected for chance collisions, and only pairs within five
standard errors of the threshold are verified, on the full shingle sets.

Copies with one shingle set are one class. A band's members are never paired with each other:
in each round they meet one head only, and only the best estimate of each is verified. Verified
links join components. Rounds use other heads. At the end, bands whose components still differ
are settled without loss of a link: in those of at most ``FEW`` members all are compared with
all; members of larger ones, with all that they share a larger band with, are a family, and each is
taken as its difference from one of them, the centre, that shares its bands with the most. Members
meet only where their differences share one of their rarest shingles, as they must to reach the
threshold unless both link with the centre. A family of documents made from one template, too
unlike to link but alike enough to share bands, so meets where two have made the same change.

Defined results: null texts and texts without words have an empty set and link with nothing.
Texts with fewer words than a shingle have their whole sequence as one. Rows without an id link
with nothing and are kept, without a component. Rows are told apart by their number, not by
their id: rows that share an id are linked by their own texts, and one row of each component is
kept, that with the smallest id; of several such rows the one with the smallest set digest, then
any. An empty table gives an empty result. Other columns are unused.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillflow.llm.components import Components
from tillflow.llm.word_bpe import slices
from tillflow.session import scratch_path

BIN_BITS, MANTISSA = 8, 10
BINS = 1 << BIN_BITS
BANDS, ROWS = 36, 7
EMPTY = np.uint16(0xFFFF)
# Mean collision probability of two random registers, times 2 ** MANTISSA, for sets of like
# size (Yu and Weber, HyperMinHash, 2017).
CHANCE = 0.169919487159739
STAR_ROUNDS = 3
# Members of an open band up to which all of them are compared with each other.
FEW = 64
# Copies of a family's centre, each met by a part of the members.
COPIES = 64
SIGNATURE = ("row long, doc_id long, n_shingles long, digest binary, registers array<int>, "
             "filled array<long>, bands array<long>")

_random = np.random.default_rng(5)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = _random.integers(1, 1 << 63, 256, dtype=np.uint64)
_PLACE = _random.integers(1, 1 << 63, 1 << 12, dtype=np.uint64) | np.uint64(1)
# Attempt by attempt, where each register looks: every column is a permutation.
_PROBES = np.stack([_random.permutation(BINS) for _ in range(BINS)], axis=1)
_STEP = _random.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, A-Z lower-cased, and how many each text has."""
    raw = _LOWER[np.frombuffer(b"".join(t + b"\n" for t in texts), np.uint8)]
    inside = np.flatnonzero(~_IS_SPACE[raw])
    if not len(inside):
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    starts = np.flatnonzero(np.append(True, np.diff(inside) != 1))
    lengths = np.diff(np.append(starts, len(inside)))
    place = np.arange(len(inside)) - np.repeat(starts, lengths)
    weight = _PLACE[place & 4095]
    far = place > 4095
    if far.any():
        weight[far] = mixed(weight[far] + (place[far] >> 12).astype(np.uint64))
    words = mixed(np.add.reduceat(_BYTE[raw[inside]] * weight, starts) + lengths.astype(np.uint64))
    ends = np.cumsum([len(t) + 1 for t in texts])
    owner = np.searchsorted(ends, inside[starts], side="right")
    return words, np.bincount(owner, minlength=len(texts))


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words, counts = word_hashes(texts)
    rolled = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for k in range(size if len(rolled) else 0):
        rolled += words[k:k + len(rolled)] * _STEP[k]
    rolled = mixed(rolled)
    sets, at = [], 0
    for n in counts.tolist():
        if n >= size:
            sets.append(np.unique(rolled[at:at + n - size + 1]))
        elif n:
            whole = (words[at:at + n] * _STEP[:n]).sum(dtype=np.uint64, keepdims=True)
            sets.append(mixed(whole + np.uint64(n)))
        else:
            sets.append(np.empty(0, np.uint64))
        at += n
    return sets


def registers(shingles: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of a sorted set: leading zeros and mantissa of each bin's least."""
    out = np.full(BINS, EMPTY, np.uint16)
    if not len(shingles):
        return out
    bins = (shingles >> np.uint64(64 - BIN_BITS)).astype(np.int64)
    first = np.flatnonzero(np.append(True, bins[1:] != bins[:-1]))
    rest = shingles[first] << np.uint64(BIN_BITS)
    # The exponent of the float is exact for all but a rounding up at a power of two.
    top = rest >> np.uint64(32)
    high = np.where(top > 0, np.floor(np.log2(np.maximum(top, 1).astype(np.float64))) + 32,
                    np.floor(np.log2(np.maximum(rest & np.uint64(0xFFFFFFFF), 1).astype(np.float64))))
    high = high.astype(np.uint64)
    zeros = np.uint64(63) - high
    shifted = rest << (zeros + np.uint64(1)) % np.uint64(64)
    mantissa = shifted >> np.uint64(64 - MANTISSA)
    zeros = np.minimum(zeros, np.uint64(62))
    out[bins[first]] = (zeros << np.uint64(MANTISSA) | mantissa).astype(np.uint16)
    return out


def tokens(regs: np.ndarray) -> np.ndarray:
    """The filled registers as bin and value in one number; equal ones are equal registers."""
    bins = np.flatnonzero(regs != EMPTY)
    return (bins << 16 | regs[bins]).astype(np.int32)


def filled_bins(regs: np.ndarray) -> np.ndarray:
    """Which registers are filled, as bits."""
    bits = np.packbits(regs != EMPTY, axis=1, bitorder="little")
    return bits.view("<i8").astype(np.int64)


def band_keys(regs: np.ndarray) -> np.ndarray:
    """(sets, BANDS) keys. An empty register takes the first filled one in its own fixed order
    of all registers, so that the bands of small sets draw independently from the filled ones.
    """
    filled = regs != EMPTY
    dense = regs.copy()
    row, col = np.nonzero(~filled & filled.any(axis=1)[:, None])
    for order in _PROBES:
        if not len(row):
            break
        source = order[col]
        found = filled[row, source]
        dense[row[found], col[found]] = regs[row[found], source[found]]
        row, col = row[~found], col[~found]
    rows = dense.astype(np.uint64)[:, :BANDS * ROWS].reshape(len(regs), ROWS, BANDS)
    key = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(regs), 1))
    for r in range(ROWS):
        key = mixed(key * _STEP[r] + rows[:, r, :])
    return key.view(np.int64)


def may_reach(threshold: float, a: str, b: str) -> Column:
    """Whether the estimate of a joined pair lies within five standard errors of the threshold.

    Columns r, f and n with the suffixes ``a`` and ``b`` hold registers, filled bins and set
    sizes. The registers in use are a sample without replacement of the union, whose size at
    the threshold is known, so small sets are estimated almost exactly.
    """
    def of(name: str, side: str) -> Column:
        return F.col(name + side)

    equal = F.size(F.array_intersect(of("r", a), of("r", b)))
    words = BINS // 64
    either = sum((F.bit_count(of("f", a)[w].bitwiseOR(of("f", b)[w])) for w in range(words)),
                 F.lit(0))
    na, nb = of("n", a).cast("double"), of("n", b).cast("double")
    ratio = na / nb
    chance = F.lit(CHANCE * 4 / (1 << MANTISSA)) * ratio / ((1 + ratio) * (1 + ratio))
    jaccard = (equal / either - chance) / (1 - chance)
    sampled = F.least(either * (1 + threshold) / (na + nb), F.lit(1.0))
    error = F.sqrt(threshold * (1 - threshold) / either * F.greatest(1 - sampled, F.lit(0.02)))
    # Sets whose sizes differ too much cannot reach the threshold.
    sizes = F.least(na, nb) >= F.floor(threshold * F.greatest(na, nb))
    return sizes & (jaccard >= threshold - 5 * error)


def signatures(rows: DataFrame, shingle: int) -> DataFrame:
    """SIGNATURE of (row, doc_id, text)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in SIGNATURE.split(", ")]
        for whole in batches:
            for batch in slices(whole, 2):
                texts = [t or b"" for t in batch.column(2).cast(pa.binary()).to_pylist()]
                sets = shingle_sets(texts, shingle)
                regs = np.stack([registers(s) for s in sets])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0), batch.column(1),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                              for s in sets], pa.binary()),
                    pa.array([tokens(r) for r in regs], pa.list_(pa.int32())),
                    pa.array(list(filled_bins(regs)), pa.list_(pa.int64())),
                    pa.array(list(band_keys(regs)), pa.list_(pa.int64()))], names)

    return rows.mapInArrow(sign, SIGNATURE)


def set_rows(docs: DataFrame, shingle: int) -> DataFrame:
    """(id, shingles) of (id, text)."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1):
                texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
                found = [s.view(np.int64) for s in shingle_sets(texts, shingle)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["id", "shingles"])

    return docs.select("id", "text").mapInArrow(sets, "id long, shingles array<long>")


def estimated(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) that may reach the threshold, with the number of equal registers."""
    def side(x: str) -> DataFrame:
        return classes.select(F.col("id").alias(x), F.col("registers").alias("r" + x),
                              F.col("filled").alias("f" + x), F.col("n_shingles").alias("n" + x))

    sized = pairs.join(side("a"), "a").join(side("b"), "b")
    return sized.where(may_reach(threshold, "a", "b")).select(
        "a", "b", F.size(F.array_intersect("ra", "rb")).alias("equal"))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) with 100 * intersection >= percent * union of the full sets."""
    def side(x: str) -> DataFrame:
        return sets.select(F.col("id").alias(x), F.col("shingles").alias("s" + x))

    common = F.size(F.array_intersect("sa", "sb")).cast("long")
    sized = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").select(
        "a", "b", common.alias("common"), (F.size("sa") + F.size("sb")).alias("total"))
    return sized.where(100 * F.col("common") >= percent * (F.col("total") - F.col("common")))


def centred(members: DataFrame, sets: DataFrame) -> DataFrame:
    """In what the set of each member (id, comp, family, weight) differs from its family's centre,
    the set of the heaviest member: (id, comp, n, shingles, centre, centre_comp, centre_n).

    Two sets differ from each other in just what one of their differences holds and the other
    does not, whatever the centre, so the differences may be compared instead. Members made from
    one template share nearly all of their sets, but of the differences only what both changed.
    """
    heads = members.groupBy("family").agg(F.max(F.struct("weight", "id", "comp")).alias("head"))
    # Each copy is met by a part of a family, of which no task has to hold the whole.
    copies = heads.select("family", F.col("head.id").alias("id"), F.col("head.comp").alias("comp")
                          ).join(sets, "id").select(
        "family", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(COPIES - 1))).alias("copy"),
        F.col("id").alias("centre"), F.col("comp").alias("centre_comp"),
        F.size("shingles").cast("long").alias("centre_n"), F.col("shingles").alias("held"))
    placed = members.join(sets, "id").withColumn(
        "copy", F.pmod(F.xxhash64("id"), F.lit(COPIES).cast("long")))
    return placed.join(copies, ["family", "copy"]).select(
        "id", "comp", "family", F.size("shingles").cast("long").alias("n"),
        F.concat(F.array_except("shingles", "held"),
                 F.array_except("held", "shingles")).alias("shingles"),
        "centre", "centre_comp", "centre_n")


def excess(n: Column, differing: Column, percent: int) -> Column:
    """Two sets link if 2 * (100 + percent) times the shared part of their differences reaches
    the sum of their two numbers. Without a centre, the differences are the sets themselves.
    """
    return (100 + percent) * differing - (100 - percent) * n


def links_with_centre(beside: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of members with the centre of their family, whose excess is the smallest.

    So two members that link without a shared part of their differences both link with it.
    """
    differing = F.size("shingles").cast("long")
    return beside.where(excess(F.col("n") + F.col("centre_n"), differing, percent) <= 0).where(
        "comp <> centre_comp").select(F.col("id").alias("a"), F.col("centre").alias("b"))


def rare_shingles(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(id, comp, excess, shingle, left): the shingles at which members (id, comp) have to meet.

    ``sets`` are whole ones (id, shingles), or differences (id, n, shingles) of sets of n from a
    centre. Shingles held by one component only cannot be shared by a pair that is looked for, so
    they come first in the order of all shingles; the others follow by how many members hold
    them. ``left`` counts a member's shingles from this one to its last. A set of n that links
    with another differs from it by at most n * (100 - percent) / percent, so the first shingle
    that both hold lies where no more have passed; what lies later is left out.
    """
    if "n" not in sets.columns:
        sets = sets.withColumn("n", F.size("shingles").cast("long"))
    held = members.join(sets, "id").select(
        "id", "comp", "n", F.size("shingles").cast("long").alias("differing"),
        F.explode("shingles").alias("shingle"))
    met = held.groupBy("shingle").agg(
        F.count("*").alias("holders"), (F.min("comp") != F.max("comp")).alias("open")
    ).where("open").drop("open")
    of_member = Window.partitionBy("id")
    place = F.row_number().over(of_member.orderBy("holders", "shingle"))
    placed = held.join(met, "shingle").select(
        "id", "comp", "n", "differing", "shingle",
        (F.count("*").over(of_member) - place + 1).alias("left"))
    return placed.where(f"(differing - left) * {percent} <= n * {100 - percent}").select(
        "id", "comp", excess(F.col("n"), F.col("differing"), percent).alias("excess"),
        "shingle", "left")


def meeting_pairs(rare: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) of different components that may be alike, by where they meet.

    At the first shingle that two sets share, each must have as many left as they have to share
    in all; ``reach`` is the greatest excess of another set for which it has.
    Components meet first, so members of one component are never paired with each other.
    """
    held = rare.withColumn("reach", 2 * (100 + percent) * F.col("left") - F.col("excess"))
    comps = held.groupBy("shingle", "comp").agg(
        F.min("excess").alias("low"), F.max("reach").alias("far"))

    def side(rows: DataFrame, x: str) -> DataFrame:
        return rows.select("shingle", *[F.col(c).alias(f"{c}_{x}") for c in rows.columns
                                        if c != "shingle"])

    meetings = side(comps, "a").join(side(comps, "b"), "shingle").where(
        "comp_a < comp_b and low_a <= far_b and low_b <= far_a")
    some = meetings.join(side(held, "a"), ["shingle", "comp_a"]).where(
        "excess_a <= far_b and low_b <= reach_a")
    pairs = some.join(side(held, "b"), ["shingle", "comp_b"]).where(
        "excess_a <= reach_b and excess_b <= reach_a")
    return pairs.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, percent: int = 80, shingle: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): links at a similarity of ``percent`` or more."""
    return linked_rows(docs.select("doc_id", "text"), percent, shingle)[1].drop("row")


def without_copies(docs: DataFrame, percent: int = 80, shingle: int = 5) -> DataFrame:
    """The kept rows of ``docs`` with all their columns."""
    rows, found = linked_rows(docs, percent, shingle)
    copies = found.where(~F.col("kept")).select("row")
    return rows.join(copies, "row", "left_anti").select("doc.*")


def linked_rows(docs: DataFrame, percent: int, shingle: int) -> tuple[DataFrame, DataFrame]:
    """The written rows (row, doc) with their numbers, and what near_duplicates finds of each."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "near-dups")
    threshold = percent / 100

    def keep(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    rows = keep(docs.select(F.monotonically_increasing_id().alias("row"),
                            F.struct("*").alias("doc")), "rows")
    texts = rows.select("row", F.col("doc.doc_id").cast("long").alias("doc_id"), "doc.text")
    signed = keep(signatures(texts, shingle), "signatures")
    linkable = signed.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    classes = keep(linkable.groupBy("digest").agg(
        F.min(F.struct("doc_id", "row")).alias("first"), F.first("n_shingles").alias("n_shingles"),
        F.first("registers").alias("registers"), F.first("filled").alias("filled"),
        F.first("bands").alias("bands")).withColumn("id", F.col("first.row")), "classes")
    members = classes.select("id", F.explode("bands").alias("band"))
    shared = members.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band")
    buckets = keep(members.join(shared, "band"), "buckets")
    ids = buckets.select("id").distinct()
    wanted = texts.select(F.col("row").alias("id"), "text").join(ids, "id", "left_semi")
    sets = keep(set_rows(wanted, shingle), "sets")
    parts = Components(spark)

    for number in range(STAR_ROUNDS):
        here = parts.label(buckets, "id", "comp")
        order = F.col("id") if number == 0 else F.xxhash64("id", F.lit(number))
        heads = here.groupBy("band").agg(
            F.min_by(F.struct("id", "comp"), order).alias("head"),
            (F.min("comp") != F.max("comp")).alias("open")).where("open").select(
                "band", F.col("head.id").alias("head"), F.col("head.comp").alias("head_comp"))
        pairs = here.join(heads, "band").where("comp <> head_comp").select(
            F.col("id").alias("a"), F.col("head").alias("b")).distinct()
        best = estimated(pairs, classes, threshold).groupBy("a").agg(
            F.max_by("b", "equal").alias("b"))
        if not parts.add(verified(best, sets, percent)) and number:
            break

    here = parts.label(buckets, "id", "comp")
    unsettled = here.groupBy("band").agg(
        (F.min("comp") != F.max("comp")).alias("open"),
        F.count("*").alias("members")).where("open").select("band", "members")
    left = keep(here.join(unsettled, "band"), "unsettled")
    few = left.where(F.col("members") <= FEW).drop("members").join(classes.select(
        "id", "bands", F.col("registers").alias("r"), F.col("filled").alias("f"),
        F.col("n_shingles").alias("n")), "id")
    x, y = (few.select("band", *[F.col(c).alias(c + side) for c in few.columns if c != "band"])
            for side in ("_a", "_b"))
    # A pair that shares several bands counts at the first of them only; if that is a larger
    # one, both are among its members below.
    first = F.array_min(F.array_intersect("bands_a", "bands_b")) == F.col("band")
    rest = x.join(y, "band").where(
        (F.col("id_a") < F.col("id_b")) & (F.col("comp_a") != F.col("comp_b")) & first
        & may_reach(threshold, "_a", "_b")
    ).select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))
    parts.add(verified(rest, sets, percent))

    large = left.where(F.col("members") > FEW).select("band", "id", "members")
    families = Components(spark)
    families.add(large.join(large.groupBy("band").agg(F.min("id").alias("first")), "band").select(
        F.col("id").alias("a"), F.col("first").alias("b")))
    # The links just found may have settled some members of the larger bands.
    many = parts.label(large.groupBy("id").agg(F.sum("members").alias("weight")), "id", "comp")
    beside = keep(centred(families.label(many, "id", "family"), sets), "beside")
    parts.add(verified(links_with_centre(beside, percent), sets, percent))
    # What a family shares is its own matter: a bijection for each keeps them apart.
    own = F.xxhash64("family")
    deltas = beside.select("id", "n", F.transform(
        "shingles", lambda s: s.bitwiseXOR(own)).alias("shingles"))
    rare = keep(rare_shingles(parts.label(beside.select("id"), "id", "comp"), deltas, percent), "rare")
    parts.add(verified(estimated(meeting_pairs(rare, percent), classes, threshold), sets, percent))

    of_class = parts.label(classes.select("digest", "id", "first.doc_id"), "id", "comp")
    heads = of_class.groupBy("comp").agg(
        F.min(F.struct("doc_id", "digest", "id")).alias("head"))
    of_class = keep(of_class.join(heads, "comp").select(
        "digest", F.col("head.doc_id").alias("component_id"), F.col("head.id").alias("head")),
        "components")
    found = signed.join(of_class, "digest", "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    # Rows that link with nothing have no head, although their digest may be that of a class.
    links = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    return rows, found.select(
        "row", "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), own).alias("component_id"),
        (~links | (F.col("row") == F.col("head"))).alias("kept"))
