"""Near-duplicate texts by MinHash bands and odd sketches, confirmed on full shingle sets.

1. Each text becomes its set of five-word shingles, a MinHash sample, band keys from the
   sample, and an odd sketch: a bitmap in which sample value i flips the bit its hash names.
   Two sketches differ where samples do, so the number of ones in their XOR estimates how
   many samples differ, closely where few do.
2. Texts with equal sets become one class. Nothing below sees a copy twice.
3. Classes that share a band are candidates. In a bucket each class is compared with the
   bucket's pivot (smallest class); sketches that are too far apart end the candidacy.
4. Each class is confirmed against the pivot nearest by sketch, on full sets. That settles
   most of a group without its pairs, and confirmed links form components.
5. In buckets that still hold several components, members outside the largest one are compared
   with all members of other components: by sketch, and on full sets where that leaves a chance,
   nearest first and only until two components are joined. A pair is tried in the first bucket
   it shares. Full sets come to the bucket once for each member that has a pair by sketch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heartwood.llm.common import components, give_back, mix, row_blocks, store, text_buffers, text_id
from heartwood.llm.words import spaced_words, word_hashes

SHINGLE = 5
#: a pair at similarity 0.75 shares no band with probability (1 - 0.75^4)^40 = 2.5e-7, one at 0.8
#: with 6e-10; one at 0.3 shares one with 28 %
BANDS, ROWS = 40, 4
SAMPLES = BANDS * ROWS
SKETCH_BITS = 512
#: six times the estimate's standard deviation at 0.75
SLACK = 0.25
#: members of a bucket on either side of a comparison in one task
MEMBERS = 2048
#: pairs whose sketches are compared at once, about
PAIRS = 50_000
BLOCK = 1 << 19

_SALTS = mix(np.arange(1, SAMPLES + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_XOR = (_SALTS >> np.uint64(32)).astype(np.uint32)
_TIMES = _SALTS.astype(np.uint32) | np.uint32(1)
_PLACES = [np.uint64(0x9E3779B97F4A7C15 * (2 * j + 3) % 2**64) for j in range(SHINGLE)]


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The set of each text: sorted 64-bit hashes of its distinct five-word shingles, of the
    whole word sequence if there are fewer words, nothing if there is no word."""
    (words,), owner = word_hashes(data, offsets, spaced_words())
    n = len(offsets) - 1
    first = np.searchsorted(owner, np.arange(n + 1))
    shingles = np.zeros(max(len(words) - SHINGLE + 1, 0), np.uint64)
    for j in range(SHINGLE if len(shingles) else 0):
        shingles += words[j : len(words) - SHINGLE + 1 + j] * _PLACES[j]
    shingles = mix(shingles)
    out = []
    for i in range(n):
        a, b = int(first[i]), int(first[i + 1])
        if b - a >= SHINGLE:
            s = np.sort(shingles[a : b - SHINGLE + 1])
            out.append(s[np.r_[True, s[1:] != s[:-1]]])
        elif b > a:
            few = np.array([b - a], np.uint64)
            for j in range(b - a):
                few = few + words[a + j : a + j + 1] * _PLACES[j]
            out.append(mix(few))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def minhash(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each of SAMPLES hash functions over a set."""
    low = np.full(SAMPLES, 2**32 - 1, np.uint32)
    narrow = (shingles >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(narrow), 1024):
        np.minimum(low, ((narrow[i : i + 1024, None] ^ _XOR) * _TIMES).min(axis=0), out=low)
    return low


def _bands_and_sketches(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Band keys (rows, BANDS) and odd sketches (rows, SKETCH_BITS / 64) of MinHash samples."""
    wide = samples.astype(np.uint64)
    keys = np.repeat(_SALTS[None, :BANDS], len(wide), axis=0)
    for j in range(ROWS):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + wide[:, j::ROWS])
    bit = (mix(wide + _SALTS) >> np.uint64(16)) % np.uint64(SKETCH_BITS)
    flips = np.zeros((len(wide), SKETCH_BITS), np.uint8)
    np.add.at(flips, (np.arange(len(wide))[:, None], bit), 1)
    return keys.view(np.int64), np.packbits(flips & 1, axis=1).view(np.int64)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_buffers(batch.column("text"))
        for lo, hi in row_blocks(offsets, BLOCK):
            piece = data[offsets[lo] : offsets[hi]]
            sets = shingle_sets(piece, offsets[lo : hi + 1] - offsets[lo])
            size = np.array([len(s) for s in sets], np.int64)
            keys, sketches = _bands_and_sketches(np.stack([minhash(s) for s in sets]))
            rows = batch.slice(lo, hi - lo)
            yield pa.record_batch(
                {
                    "doc_id": rows.column("doc_id"),
                    "text_a": rows.column("text_a"),
                    "text_b": rows.column("text_b"),
                    "n_shingles": size,
                    "set_a": np.array([s.sum(dtype=np.uint64) for s in sets]).view(np.int64),
                    "set_b": np.array(
                        [mix(s + np.uint64(1)).sum(dtype=np.uint64) for s in sets]
                    ).view(np.int64),
                    "bands": pa.array(list(keys), pa.list_(pa.int64())),
                    "sketch": pa.array(list(sketches), pa.list_(pa.int64())),
                }
            )
    give_back()


_SIGNATURE = (
    "doc_id long, text_a long, text_b long, n_shingles long, set_a long, set_b long, "
    "bands array<long>, sketch array<long>"
)


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sets of marked texts, once for rows on end with one text."""
    last = None
    for batch in batches:
        a, b = (batch.column(c).to_numpy() for c in ("text_a", "text_b"))
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        if len(a):
            new[0] = last != (a[0], b[0])
            last = (a[-1], b[-1])
        batch = batch.filter(pa.array(new))
        data, offsets = text_buffers(batch.column("text"))
        for lo, hi in row_blocks(offsets, BLOCK):
            piece = data[offsets[lo] : offsets[hi]]
            sets = shingle_sets(piece, offsets[lo : hi + 1] - offsets[lo])
            yield pa.record_batch(
                {
                    "node": batch.column("node").slice(lo, hi - lo),
                    "shingles": pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                }
            )
    give_back()


def estimated_similarity(a: Column, b: Column) -> Column:
    """Jaccard similarity from two odd sketches; sketches that differ in half their bits or
    more count as 0."""
    ones = F.aggregate(
        F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("long")),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    )
    far = 1 - 2 * ones / SKETCH_BITS
    return F.when(far <= 0, 0.0).otherwise(1 + SKETCH_BITS / (4 * SAMPLES) * F.log(far))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of ``pairs`` (a, b) those whose full sets are similar enough."""
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
    both = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - both
    return (
        pairs.select("a", "b")
        .join(two, "b")
        .join(one, "a")
        .where(100 * both >= percent * union)
        .select("a", "b")
    )


def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``estimated_similarity`` of odd sketches by rows."""
    ones = np.bitwise_count((a ^ b).view(np.uint64)).sum(axis=1)
    return 1 + SKETCH_BITS / (4 * SAMPLES) * np.log(np.maximum(1 - 2 * ones / SKETCH_BITS, 1e-9))


def _with_partner(least: float):
    """Arrow function on rows sorted by band, block, own_block and own (true first): those that
    have a candidate on the other side of their block pair, which is in another component, near by
    sketch, and shares no earlier band."""

    def read(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        out = {
            c: batch.column(c).to_numpy(zero_copy_only=False)
            for c in ("band", "block", "own_block", "own", "node", "inside")
        }
        for c in ("sketch", "bands"):
            values = batch.column(c).flatten().to_numpy()
            out[c] = values.reshape(batch.num_rows, -1)
        return out

    def marked(part: dict[str, np.ndarray]) -> pa.RecordBatch:
        n = len(part["band"])
        new = np.ones(n, bool)
        new[1:] = False
        for c in ("band", "block", "own_block"):
            new[1:] |= part[c][1:] != part[c][:-1]
        first = np.flatnonzero(new)
        stop = np.append(first[1:], n)
        owned = np.add.reduceat(part["own"].astype(np.int64), first)
        own = np.flatnonzero(part["own"])
        # the others of a row's block pair: their number, and where they begin
        times, begin = np.repeat(stop - first - owned, owned), np.repeat(first + owned, owned)
        until = np.cumsum(times)
        found = np.zeros(n, bool)
        at = 0
        while at < len(own):
            last = max(at + 1, int(np.searchsorted(until, until[at] - times[at] + PAIRS, "right")))
            k = times[at:last]
            i = np.repeat(own[at:last], k)
            j = np.arange(len(i)) + np.repeat(begin[at:last] - np.cumsum(k) + k, k)
            at = last
            apart = part["inside"][i] != part["inside"][j]
            i, j = i[apart], j[apart]
            near = _near(part["sketch"][i], part["sketch"][j]) >= least
            i, j = i[near], j[near]
            bands = part["bands"][i]
            earliest = (bands == part["bands"][j]).argmax(axis=1)
            here = bands[np.arange(len(i)), earliest] == part["band"][i]
            found[i[here]] = found[j[here]] = True
        keep = np.flatnonzero(found)
        names = ("band", "block", "own_block", "own", "node", "inside")
        return pa.record_batch({c: part[c][keep] for c in names})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []  # rows of the last block pair so far
        key = None
        for batch in batches:
            if not batch.num_rows:
                continue
            part = read(batch)
            end = tuple(part[c][-1] for c in ("band", "block", "own_block"))
            same = np.logical_and.reduce(
                [part[c] == x for c, x in zip(("band", "block", "own_block"), end)]
            )
            cut = int(np.argmax(same))
            if cut or key != end:
                done = [*held, {c: x[:cut] for c, x in part.items()}]
                whole = {c: np.concatenate([d[c] for d in done]) for c in part}
                if len(whole["band"]):
                    yield marked(whole)
                held = []
            held.append({c: x[cut:] for c, x in part.items()})
            key = end
        if held:
            yield marked({c: np.concatenate([d[c] for d in held]) for c in held[0]})
        give_back()

    return run


def _links_across(least: float, percent: int):
    """Arrow function on members of a bucket outside its main component and members of it all:
    confirmed links that join different components."""

    def lists(column: pa.ChunkedArray) -> list[np.ndarray]:
        return [x.values.to_numpy() for x in column.combine_chunks()]

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[int, int]] = []
        if left.num_rows and right.num_rows:
            band = key[0].as_py()
            node, inside = (left.column(c).to_pylist() for c in ("node", "inside"))
            others = right.column("node").to_pylist()
            of = right.column("inside").to_numpy()
            bits = np.stack(lists(right.column("sketch")))
            bands = np.stack(lists(right.column("bands")))
            sets, own_sets = lists(right.column("shingles")), lists(left.column("shingles"))
            sketches, own_bands = lists(left.column("sketch")), lists(left.column("bands"))
            root: dict[int, int] = {}

            def find(x: int) -> int:
                while root.setdefault(x, x) != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            for i in range(len(node)):
                near = _near(bits, sketches[i])
                first = (bands == own_bands[i]).argmax(axis=1)
                here = own_bands[i][first] == band
                at = np.flatnonzero((near >= least) & (of != inside[i]) & here)
                for x in at[np.argsort(-near[at], kind="stable")].tolist():
                    p, q = find(inside[i]), find(int(of[x]))
                    if p == q:
                        continue
                    both = len(np.intersect1d(own_sets[i], sets[x], assume_unique=True))
                    union = len(own_sets[i]) + len(sets[x]) - both
                    if 100 * both >= percent * union:
                        root[p] = q
                        out.append((node[i], others[x]))
        return pa.table(
            {
                "a": pa.array([max(e) for e in out], pa.int64()),
                "b": pa.array([min(e) for e in out], pa.int64()),
            }
        )

    return run


def _across(
    members: DataFrame,
    signs: DataFrame,
    sets: DataFrame,
    linked: DataFrame,
    least: float,
    percent: int,
) -> DataFrame:
    """Confirmed links (a, b) between different components that share a bucket.

    ``signs`` has node, sketch and bands, ``sets`` node and shingles. Both sides of a bucket,
    members outside its main component and all members, are dealt to blocks, and every two blocks
    meet: first without sets, which tells the rows that have a candidate, then only those with
    their sets.
    """
    placed = (
        members.select("band", "node")
        .join(linked, "node", "left")
        .select("band", "node", F.coalesce("component", "node").alias("inside"))
    )
    mixed = (
        placed.groupBy("band", "inside")
        .agg(F.count("*").alias("n"))
        .groupBy("band")
        .agg(
            F.max_by("inside", F.struct("n", "inside")).alias("home"),
            F.ceil(F.sum("n") / MEMBERS).cast("int").alias("blocks"),
            F.ceil((F.sum("n") - F.max("n")) / MEMBERS).cast("int").alias("own_blocks"),
            F.count("*").alias("parts"),
        )
        .where("parts > 1")
    )
    there = placed.join(mixed, "band").join(signs, "node")

    def dealt(rows: DataFrame, own: str, own_n: str, other: str, other_n: str) -> DataFrame:
        return rows.withColumn(
            own, F.pmod(F.xxhash64("node", F.lit(1)), F.col(own_n)).cast("int")
        ).withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other_n) - 1)))

    key = ["band", "block", "own_block"]
    names = [*key, "own", "node", "inside"]
    apart = dealt(there.where("inside <> home"), "own_block", "own_blocks", "block", "blocks")
    every = dealt(there, "block", "blocks", "own_block", "own_blocks")
    met = store(
        apart.withColumn("own", F.lit(True))
        .select(*names, "sketch", "bands")
        .unionByName(every.withColumn("own", F.lit(False)).select(*names, "sketch", "bands"))
        .repartition(*key)
        .sortWithinPartitions(*[F.col(c) for c in key], F.col("own").desc())
        .mapInArrow(
            _with_partner(least),
            "band long, block int, own_block int, own boolean, node long, inside long",
        )
    )
    facts = met.join(signs, "node").join(sets, "node")
    columns = [*key, "node", "inside", "sketch", "bands", "shingles"]

    def side(own: bool) -> DataFrame:  # both sides come from one frame
        rows = facts.where("own" if own else "not own")
        return rows.select(*[F.col(c).alias(c) for c in columns])

    return (
        side(True)
        .groupBy(*key)
        .cogroup(side(False).groupBy(*key))
        .applyInArrow(_links_across(least, percent), "a long, b long")
        .distinct()
    )


def _joined(linked: DataFrame, links: DataFrame) -> DataFrame:
    """``linked`` (node, component) after further links; only components become nodes of a graph."""
    of = linked.toDF("node", "inside")
    ends = links
    for end in ("a", "b"):
        ends = ends.join(of, F.col(end) == F.col("node"), "left").select(
            *[F.coalesce("inside", c).alias(c) if c == end else c for c in ("a", "b")]
        )
    merged = components(ends)
    moved = of.join(merged.toDF("inside", "component"), "inside", "left").select(
        "node", F.coalesce("component", "inside").alias("component")
    )
    return store(moved.union(merged))


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """Each row's near-duplicate component: doc_id, n_shingles, component_id, kept, and the two
    hashes that name its text.

    Words are what ASCII white space separates, A-Z lower-cased. Texts link at a Jaccard
    similarity of ``percent`` / 100 or more of their sets of five-word shingles; with fewer
    words the whole sequence is the one shingle; without words a text links with nothing.
    component_id is the smallest doc_id reachable by links, its own included; kept marks the
    rows that carry it. Rows with one doc_id are rows of one document each. A missing doc_id
    takes part, is never smallest, and is kept if the whole component has none. Other columns
    of ``docs`` play no role; an empty table gives an empty result.
    """
    named = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        *text_id(F.col("text")),
    )
    return _from_signatures(named, named.mapInArrow(_signatures, _SIGNATURE), percent)


def _from_signatures(named: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """``near_duplicates`` of texts with names and signatures. A class is its set's two hashes;
    its node is a number given once, when the classes are written."""
    signed = store(signatures)
    classes = store(
        signed.where("n_shingles > 0")
        .groupBy("set_a", "set_b")
        .agg(
            F.min("doc_id").alias("least"),
            F.min(F.struct("text_a", "text_b", "bands", "sketch")).alias("one"),
        )
        .select(
            F.monotonically_increasing_id().alias("node"), "set_a", "set_b", "least", "one.*"
        )
    )
    buckets = classes.select("node", F.explode("bands").alias("band"))
    shared = buckets.groupBy("band").agg(F.count("*").alias("n"), F.min("node").alias("pivot"))
    # few buckets have several members, so their keys are hashed and the many others not sorted
    several = shared.where("n > 1").hint("shuffle_hash")
    members = store(buckets.join(several, "band").select("band", "node", "pivot"))
    sketches = classes.select("node", "sketch")
    near = (
        members.where("node <> pivot")
        .select("node", "pivot")
        .distinct()
        .join(sketches, "node")
        .join(sketches.toDF("pivot", "pivot_sketch"), "pivot")
        .withColumn("similar", estimated_similarity(F.col("sketch"), F.col("pivot_sketch")))
        .select("node", "pivot", "similar")
    )
    least = percent / 100 - SLACK
    near = store(near)
    candidates = near.where(F.col("similar") >= least).select(
        F.col("node").alias("a"), F.col("pivot").alias("b"), "similar"
    )

    taking = members.select("node").union(members.select(F.col("pivot").alias("node"))).distinct()
    marked = taking.join(classes, "node").select("node", "text_a", "text_b")
    sets = store(
        named.join(marked, ["text_a", "text_b"])
        .select("text_a", "text_b", "text", "node")
        .mapInArrow(_full_sets, "node long, shingles array<long>")
        .groupBy("node")
        .agg(F.first("shingles").alias("shingles"))
    )

    best = candidates.groupBy("a").agg(F.max_by("b", F.struct("similar", "b")).alias("b"))
    linked = components(_confirmed(best, sets, percent))
    signs = classes.select("node", "sketch", "bands")
    across = store(_across(members, signs, sets, linked, least, percent))
    if not across.isEmpty():
        linked = _joined(linked, across)

    return _with_least(signed, classes, linked)


def _with_least(signed: DataFrame, classes: DataFrame, linked: DataFrame) -> DataFrame:
    """Rows with the smallest doc_id of their component, by their class."""
    placed = (
        classes.select("node", "set_a", "set_b", "least")
        .join(linked, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    names = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    per_class = placed.join(names, "component").select(
        "set_a", "set_b", F.lit(True).alias("classed"), "component_id"
    )
    smallest = F.when(F.col("classed"), F.col("component_id")).otherwise(F.col("doc_id"))
    some = F.col("n_shingles") > 0
    return (
        signed.withColumn("set_a", F.when(some, F.col("set_a")))
        .join(per_class, ["set_a", "set_b"], "left")
        .withColumn("component_id", smallest)
        .select(
            "doc_id",
            "n_shingles",
            "component_id",
            F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
            "text_a",
            "text_b",
        )
    )


def without_near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """``docs`` with one row of each near-duplicate component: the one with the smallest doc_id;
    of repeated rows with one doc_id and text one stays. All columns stay."""
    # a missing id as a value and a mark of its own: the join's keys are then those of the grouping
    key = [F.coalesce("_id", F.lit(0)).alias("_key"), F.col("_id").isNull().alias("_none")]
    names = ["text_a", "text_b", "_key", "_none"]
    keep = (
        near_duplicates(docs, percent)
        .where("kept")
        .withColumnRenamed("doc_id", "_id")
        .select("text_a", "text_b", *key)
        .distinct()
    )
    named = docs.select(
        F.struct(*docs.columns).alias("_row"),
        F.col("doc_id").cast("long").alias("_id"),
        *text_id(F.col("text")),
    ).select("_row", "text_a", "text_b", *key)
    return (
        named.join(keep, names, "left_semi")
        .groupBy(*names)
        .agg(F.first("_row").alias("_row"))
        .select("_row.*")
    )
