"""Near-duplicate documents: one-permutation MinHash, banded buckets, star-shaped candidate edges.

Two documents are linked when the Jaccard similarity of their shingle sets is at least
``num / den``; groups are the connected components of the links. Every link that counts
is confirmed on the full sets.

1.  Each text is hashed once (one permutation split into ``BINS`` bins; an empty bin copies
    the first full bin of its own random order, the optimal densification). Texts with equal
    sets form one class by the digest of the set, and only one document a class goes on, so
    thousands of copies cost one.
2.  ``BINS / ROWS`` band hashes a class make buckets. A pair at similarity 0.8 misses all
    of them with probability 5e-6, at 0.85 with 2e-9.
3.  In a bucket, the member that meets most others elsewhere is the centre, and only the
    star of edges from it is compared: n - 1 pairs, not n (n - 1) / 2.
4.  A bucket whose members are then still in several components may hide links between two
    members of which at least one is not linked with the centre c. They are found exactly,
    without comparing all pairs, from the differences D(m) = set(m) xor set(c): since
    |a xor b| = |D(a)| + |D(b)| - 2 |D(a) and D(b)|, such a pair must share a known least
    number of elements of D, so it shares one within a prefix of each D in any common order
    (prefix filtering). Elements outside c come first and those frequent among the members
    of c last; a sample of members only decides that order, never the result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm.bloom import BloomFilter
from tillstar.llm.components import components
from tillstar.llm.shingles import binary_values, long_lists, mix, shingle_hashes, slices
from tillstar.llm.storage import materialise

BINS, ROWS = 240, 6
ORDER_SAMPLE = 16

_rng = np.random.default_rng(20240607)
_FILL_ORDER = np.argsort(_rng.random((BINS, BINS)), axis=1)
_ODD = _rng.integers(1 << 62, size=ROWS, dtype=np.int64).astype(np.uint64) | np.uint64(1)
_BAND = np.arange(BINS // ROWS, dtype=np.uint64)


def shingle_set(text: bytes | None, words_per_shingle: int) -> np.ndarray:
    """The sorted distinct shingle hashes of a text: ASCII lower case, words between ASCII white space."""
    return np.unique(shingle_hashes(text.lower().split(), words_per_shingle)) if text else np.empty(0, np.uint64)


def band_hashes(shingles: np.ndarray) -> np.ndarray:
    """Band hashes of a non-empty sorted set of hashes. Ascending hashes fill ascending bins, so a bin's minimum is its first."""
    bins = ((shingles >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)
    first = np.flatnonzero(np.diff(bins, prepend=np.uint64(BINS)))
    signature, full = np.zeros(BINS, np.uint64), np.zeros(BINS, bool)
    signature[bins[first]], full[bins[first]] = shingles[first], True
    empty = np.flatnonzero(~full)
    if len(empty):
        order = _FILL_ORDER[empty]
        source = order[np.arange(len(empty)), full[order].argmax(axis=1)]
        signature[empty] = signature[source]
    return mix((signature.reshape(-1, ROWS) * _ODD).sum(axis=1) + _BAND)


def _sketches(docs: DataFrame, shingle: int, num: int, den: int) -> DataFrame:
    least = -(-num // (den - num)) if num < den else 1 << 30  # smaller sets link only when equal

    def run(batches):
        for batch in slices(batches, 1):
            sets = [shingle_set(t, shingle) for t in binary_values(batch.column(1))]
            digests = b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets)
            halves = np.frombuffer(digests, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(halves[:, 0]), pa.array(halves[:, 1]),
                 long_lists([band_hashes(s) if len(s) >= least else np.empty(0, np.uint64) for s in sets])],
                names=["id", "n", "d1", "d2", "bands"])

    return docs.mapInArrow(run, "id long, n long, d1 long, d2 long, bands array<long>")


def _sets(docs: DataFrame, shingle: int) -> DataFrame:
    def run(batches):
        for batch in slices(batches, 1):
            sets = [shingle_set(t, shingle) for t in binary_values(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), long_lists(sets)], names=["rep", "set"])

    return docs.mapInArrow(run, "rep long, set array<long>")


def _linked(both: Column, one: Column, other: Column, num: int, den: int) -> Column:
    return both * (num + den) >= (one + other) * num  # den * both >= num * (one + other - both)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 2, num: int = 80, den: int = 100) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id (smallest id of its group), kept (id = component_id).

    Null or wordless text: no shingles, alone in its group. Fewer words than a shingle: the
    whole sequence is the one shingle. Repeated rows get the same answer each; rows that share
    an id but not the text are judged each by its own text, but classes that have the
    same smallest id are one. Rows without id stay alone, with a null component_id, and
    are kept. Extra columns are ignored. An empty table gives an empty result.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sketches = materialise(_sketches(docs, shingle, num, den), "dedup-sketch")
    named = sketches.filter("id is not null and n > 0")
    classes = materialise(named.groupBy("d1", "d2").agg(F.min("id").alias("rep")), "dedup-classes", narrow=True)
    members = materialise(
        named.join(classes, ["d1", "d2"])
        .select("id", "n", "rep", F.when(F.col("id") == F.col("rep"), F.col("bands")).alias("bands")), "dedup-members")
    out = members.select("id", "n", "rep")
    groups = _groups(docs, members, shingle, num, den)
    if groups is not None:
        out = out.join(groups, "rep", "left").select("id", "n", F.coalesce("comp", "rep").alias("rep"))
    alone = sketches.filter("id is null or n = 0").select("id", "n", F.col("id").alias("rep"))
    return out.unionByName(alone).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("rep").alias("component_id"),
                                         F.coalesce(F.col("id") == F.col("rep"), F.lit(True)).alias("kept"))


def _groups(docs: DataFrame, members: DataFrame, shingle: int, num: int, den: int) -> DataFrame | None:
    """(rep, comp) of the class representatives that have confirmed links; None without candidates."""
    bands = members.filter("bands is not null").select("rep", F.explode("bands").alias("h"))
    buckets = materialise(bands.groupBy("h").agg(F.min("rep").alias("low"), F.max("rep").alias("high"), F.count("*").alias("size"))
                          .filter("low < high").select("h", "size"), "dedup-buckets", narrow=True)
    if buckets.isEmpty():
        return None
    shared = materialise(bands.filter(BloomFilter(buckets, "h").column(F.col("h"))).join(buckets, "h"), "dedup-shared", narrow=True)

    meets = materialise(shared.groupBy("rep").agg(F.sum(F.col("size") - 1).alias("meets")), "dedup-nodes", narrow=True)
    centres = (shared.join(meets, "rep").groupBy("h")
               .agg(F.max(F.struct("meets", (-F.col("rep")).alias("low"))).alias("top"))
               .select("h", (-F.col("top.low")).alias("c")))
    shared = materialise(shared.join(materialise(centres, "dedup-centres", narrow=True), "h").select("h", "rep", "c", "size"), "dedup-stars", narrow=True)

    # Sets of the documents in buckets; a document with several texts keeps each of them.
    listed = BloomFilter(meets.select(F.xxhash64("rep").alias("k")), "k")
    sets = docs.filter(F.col("id").isNotNull() & listed.column(F.xxhash64("id"))).join(meets.select(F.col("rep").alias("id")), "id", "left_semi")
    sets = materialise(_sets(sets, shingle).filter("size(set) > 0"), "dedup-sets")
    star = _compare(shared.filter("rep <> c").select("c", F.col("rep").alias("m")).distinct(), sets, num, den, differences=True)
    star = materialise(star, "dedup-star")
    links = star.filter("linked").select(F.col("c").alias("a"), F.col("m").alias("b"))

    groups = materialise(components(links).select(F.col("node").alias("rep"), "comp"), "dedup-groups", narrow=True)
    rest = _compare(_hidden_pairs(shared, star, groups, num, den), sets, num, den).filter("linked")
    rest = materialise(rest.select(F.col("c").alias("a"), F.col("m").alias("b")), "dedup-rest", narrow=True)
    if rest.isEmpty():
        return groups
    # Groups that a hidden link joins: components of the groups.
    of_a, of_b = (groups.select(F.col("rep").alias(x), F.col("comp").alias(f"{x}_comp")) for x in ("a", "b"))
    bridges = (rest.join(of_a, "a", "left").join(of_b, "b", "left")
               .select(F.coalesce("a_comp", "a").alias("a"), F.coalesce("b_comp", "b").alias("b")))
    joined = components(materialise(bridges, "dedup-bridges", narrow=True)).toDF("comp", "to")
    named = groups.join(joined, "comp", "left").select("rep", F.coalesce("to", "comp").alias("comp"))
    lone = joined.join(groups.select(F.col("rep").alias("comp")), "comp", "left_anti").select(F.col("comp").alias("rep"), F.col("to").alias("comp"))
    return named.unionByName(lone)


def _compare(pairs: DataFrame, sets: DataFrame, num: int, den: int, differences: bool = False) -> DataFrame:
    """Pairs (c, m) with ``linked`` from their full sets, and set(m) - set(c), set(c) - set(m) where asked."""
    out = (pairs.join(sets.select(F.col("rep").alias("m"), F.col("set").alias("sm")), "m")
           .join(sets.select(F.col("rep").alias("c"), F.col("set").alias("sc")), "c"))
    nm, nc = F.size("sm").cast("long"), F.size("sc").cast("long")
    if not differences:
        out = out.filter((nm * den >= nc * num) & (nc * den >= nm * num))
        return out.select("c", "m", _linked(F.size(F.array_intersect("sm", "sc")).cast("long"), nm, nc, num, den).alias("linked"))
    out = out.select("c", "m", nm.alias("nm"), nc.alias("nc"), F.array_except("sm", "sc").alias("extra"),
                     F.array_except("sc", "sm").alias("lack"))
    return out.withColumn("linked", _linked(F.col("nm") - F.size("extra"), F.col("nm"), F.col("nc"), num, den))


def _hidden_pairs(shared: DataFrame, star: DataFrame, groups: DataFrame, num: int, den: int) -> DataFrame:
    """Candidate pairs (c, m) of two members of a bucket in different components, by prefixes of their differences."""
    placed = (shared.filter("size > 2").join(groups, "rep", "left")
              .select("h", "rep", "c", F.coalesce("comp", "rep").alias("comp")))
    mixed = (placed.groupBy("h").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
             .filter("low < high").select("h"))
    todo = materialise(placed.join(mixed, "h", "left_semi").filter("rep <> c")
                       .select("c", F.col("rep").alias("m"), "comp").distinct(), "dedup-mixed", narrow=True)
    rows = star.join(todo, ["c", "m"])

    # Elements frequent among a sample of a large centre's members go last.
    sizes = todo.groupBy("c").agg(F.count("*").alias("size")).filter(F.col("size") >= ORDER_SAMPLE)
    frequent = (rows.join(materialise(sizes, "dedup-sizes", narrow=True), "c")
                .filter(F.pmod(F.xxhash64("m"), F.ceil(F.col("size") / ORDER_SAMPLE)) == 0)
                .select("c", F.explode(F.concat("extra", "lack")).alias("e"))
                .groupBy("c", "e").agg(F.count("*").alias("df")).filter("df > 1")
                .groupBy("c").agg(F.sort_array(F.collect_list(F.struct("df", "e"))).alias("often"))
                .select("c", F.col("often.e").alias("often")))
    rows = rows.join(materialise(frequent, "dedup-frequent", narrow=True), "c", "left")
    often = F.coalesce("often", F.array().cast("array<long>"))
    ordered = F.concat(F.array_except(F.array_sort("extra"), often), F.array_except(F.array_sort("lack"), often),
                       F.array_intersect(often, F.concat("extra", "lack")))

    # With g = (den - num) / (den + num): a link has |a xor b| <= g (|a| + |b|); m is unlinked with c when |D| > g (nm + nc).
    d, share = F.size("extra") + F.size("lack"), den + num
    half = d - F.floor((d * share + (F.col("nc") - F.col("nm")) * (den - num)) / (2 * share))
    far = F.least(d, F.floor(F.col("nm") * ((den - num) / share * (1 + den / num))) + 1)
    reach = F.when(F.col("linked"), half).otherwise(F.greatest(half, far))
    reach = F.greatest(F.least(reach, d), F.lit(0)).cast("int")
    elements = materialise(
        rows.select("c", "m", "comp", "linked", half.alias("half"), "nm", F.posexplode(F.slice(ordered, 1, reach)).alias("at", "e"))
        .select("c", "e", "m", "comp", "linked", "nm", (F.col("at") < F.col("half")).alias("near")), "dedup-prefix", narrow=True)
    one = elements.select("c", "e", *[F.col(x).alias(f"{x}1") for x in ("m", "comp", "linked", "nm", "near")])
    two = elements.select("c", "e", *[F.col(x).alias(f"{x}2") for x in ("m", "comp", "linked", "nm", "near")])
    pairs = one.join(two, ["c", "e"]).filter(
        "m1 < m2 and comp1 <> comp2 and not (linked1 and linked2) and (near1 or linked2) and (near2 or linked1)"
        f" and nm1 * {den} >= nm2 * {num} and nm2 * {den} >= nm1 * {num}")
    return pairs.select(F.col("m1").alias("c"), F.col("m2").alias("m")).distinct()
