"""Operator 7: Jaccard join of word-shingle sets by PartEnum signatures.

Two sets are linked when 100 * |intersection| >= similarity * |union|.  Sizes
are cut into bands of ratio 100/similarity, so the smaller set of a linked pair
lies in the band of the larger one or the one below; a set is entered in both.
In a band linked sets differ in at most ``k`` shingles.  The hash domain of the
shingles is partitioned into ``n = k + 1 + weak + hot`` parts, and a set has one
signature per part: the hash of its shingles in it.  Subsets of ``sub[1]`` of
``sub[0]`` parts may be enumerated instead of single parts.  Linked sets agree
in at least ``1 + weak + hot`` signatures, so each set may leave out its
``weak`` signatures of least content (empty parts mostly) and, once counted,
its ``hot`` most frequent ones, and a linked pair still shares one: both orders
are the same for all sets.  A set with no shared signature left is linked to
nothing.

Candidates are verified on the exact sets.  Every set is first compared with the
one of its signature groups that shares most signatures.  What is then still in
different components is thinned: a set most of whose shingles no other set there
has cannot be linked, and a pair must be able to reach the similarity with the
shingles each has in common with any other, and by the parity sketches of both.  Of what is left the groups' leaders
are compared with their members, and then all that are still apart.  Copies (equal sets) are entered once, under
the set's 64-bit name, so groups of copies give no pairs at all.

Defined cases: a text that is null or has no word has the empty set and is
linked with nothing; repeated rows are copies; a null doc_id is kept and never
names a component while another id is there; an empty table gives no rows;
other input columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidewatch.llm.common import BROADCAST_ROWS, cut, few, ship, small_batches, text_key
from tidewatch.llm.components import components
from tidewatch.llm.hashing import mix, signed
from tidewatch.llm.shingles import set_names, shingle_sets

#: Bits of a signature that hold its band.
BAND_BITS = 7
BATCH = 2 << 20
#: 64-bit words of a parity sketch.
SKETCH = 16
#: Shingles of which a task counts the equal ones before they are shuffled.
SHARED = 1 << 18


@dataclass
class Bands:
    """Size bands and the number of parts in each."""

    top: np.ndarray     # largest size of each band
    k: np.ndarray       # most shingles in which linked sets of the band differ
    parts: np.ndarray
    weak: np.ndarray    # signatures of least content left out
    hot: np.ndarray     # most frequent signatures left out
    similarity: int

    @classmethod
    def of(cls, similarity: int, sub: tuple[int, int], weak: float, hot: float) -> Bands:
        n2, taken = sub
        top, low = [], 1
        while low < 2 ** 31 and len(top) < 2 ** BAND_BITS:
            top.append(low * 100 // similarity)
            low = top[-1] + 1
        top = np.array(top)
        k = (top + top * 100 // similarity) * (100 - similarity) // (100 + similarity)
        differ = n2 - taken                                # parts of a group that may differ
        extra_weak, extra_hot = np.ceil(weak * k).astype(int) + 1, np.ceil(hot * k).astype(int)
        parts = k // (differ + 1) + 1 + extra_weak + extra_hot
        return cls(top, k, parts, extra_weak, extra_hot, similarity)

    def at(self, size: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.top, size)


def signatures(shingles: np.ndarray, count: np.ndarray, bands: Bands, sub: tuple[int, int]) \
        -> tuple[np.ndarray, np.ndarray]:
    """(signatures of all sets, number per set).  A signature's low bits are its band."""
    n2, taken = sub
    own = bands.at(np.maximum(count, 1))
    below = bands.at(np.maximum(-(-count * bands.similarity // 100), 1))
    k_sets = np.arange(len(count))
    entry = np.concatenate([k_sets, k_sets[below < own]])
    band = np.concatenate([own, below[below < own]])
    use = (count[entry] > 0) & (bands.k[band] > 0)         # where k is 0 only equal sets are linked
    entry, band = entry[use], band[use]
    order = np.argsort(entry, kind="stable")
    entry, band = entry[order], band[order]
    slots = bands.parts[band] * n2
    first = np.cumsum(slots) - slots
    n = count[entry]
    begin = (np.cumsum(count) - count)[entry]
    inst = np.repeat(np.arange(len(entry)), n)
    h = shingles[begin[inst] + np.arange(len(inst)) - np.repeat(np.cumsum(n) - n, n)]
    part = (mix(h + band[inst].astype(np.uint64)) >> np.uint64(20)) % slots[inst].astype(np.uint64)
    slot = first[inst] + part.astype(np.int64)
    total = int(slots.sum())
    value = mix(h + np.uint64(11))
    low = np.bincount(slot, (value & np.uint64(0xFFFFFFFF)).astype(float), total).astype(np.uint64)
    high = np.bincount(slot, (value >> np.uint64(32)).astype(float), total).astype(np.uint64)
    size = np.bincount(slot, minlength=total)
    owner = np.repeat(np.arange(len(entry)), slots)
    place = np.arange(total) - first[owner]
    content = mix(mix(low + np.uint64(5)) ^ (high * np.uint64(0x9E3779B97F4A7C15)))
    if n2 > 1:                                             # subsets of the parts of each group
        group = content.reshape(-1, n2)
        sizes = size.reshape(-1, n2)
        chosen = list(itertools.combinations(range(n2), taken))
        content = np.concatenate([mix(sum(mix(group[:, c] + np.uint64(c)) for c in cs) + np.uint64(i))[:, None]
                                  for i, cs in enumerate(chosen)], axis=1)
        size = np.concatenate([sizes[:, list(cs)].sum(1)[:, None] for cs in chosen], axis=1)
        owner = np.repeat(owner.reshape(-1, n2)[:, 0], len(chosen))
        place = np.repeat(place.reshape(-1, n2)[:, 0], len(chosen))
        content, size = content.ravel(), size.ravel()
    sig = mix(content + place.astype(np.uint64) * np.uint64(0xD1342543DE82EF95) +
              (band[owner].astype(np.uint64) << np.uint64(50)))
    sig = (sig >> np.uint64(BAND_BITS) << np.uint64(BAND_BITS)) | band[owner].astype(np.uint64)
    per = slots // n2 * (len(list(itertools.combinations(range(n2), taken))) if n2 > 1 else 1)
    order = np.lexsort((sig, -size, owner))                # strongest content first
    rank = np.arange(len(sig)) - np.repeat(np.cumsum(per) - per, per)
    kept = order[rank < (per - bands.weak[band])[owner[order]]]
    out = sig[np.sort(kept)]
    number = np.bincount(entry[owner[kept]], minlength=len(count))
    return out, number


def verified(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs ``a, b`` of set names whose exact sets are similar enough."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "set_a", BATCH):
            good = []
            for x, y in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(x) + len(y) - len(np.unique(np.concatenate((x, y))))
                good.append(100 * both >= similarity * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(good)),
                                              batch.column("b").filter(pa.array(good))], names=["a", "b"])

    return pairs.join(sets.select(F.col("ref").alias("a"), F.col("members").alias("set_a")), "a") \
        .join(sets.select(F.col("ref").alias("b"), F.col("members").alias("set_b")), "b") \
        .select("a", "b", "set_a", "set_b").mapInArrow(check, "a long, b long")


def _apart(placed: DataFrame) -> DataFrame:
    """The rows of signature groups whose members are in different components."""
    mixed = placed.groupBy("sig").agg(F.min("label").alias("x"), F.max("label").alias("y")) \
        .where("x < y").select("sig")
    return placed.join(mixed, "sig", "left_semi")


def _labelled(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` with the component label of each ``ref``; its own name without links."""
    return rows.join(found.withColumnRenamed("node", "ref"), "ref", "left") \
        .withColumn("label", F.coalesce("label", "ref"))


def _shared(rest: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """``ref, size, common``: set size and number of shingles that another set of
    ``rest`` has too.  Sets with too few of them are linked to no other and left out."""

    def counted(refs: list[int], raws: list[bytes]) -> pa.RecordBatch:
        owner = np.repeat(np.array(refs, np.int64), [len(r) // 8 for r in raws])
        h, first, n = np.unique(np.frombuffer(b"".join(raws), np.int64), return_index=True, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(h), pa.array(owner[first]), pa.array(n)], names=["h", "ref", "n"])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        refs, raws, held = [], [], 0                       # what many sets share leaves a task once for all of them
        for batch in batches:
            for ref, raw in zip(batch.column("ref").to_pylist(), batch.column("members").to_pylist(), strict=True):
                refs.append(ref)
                raws.append(raw)
                held += len(raw) // 8
                if held >= SHARED:
                    yield counted(refs, raws)
                    refs, raws, held = [], [], 0
        if refs:
            yield counted(refs, raws)

    here = sets.join(rest.select("ref").distinct(), "ref", "left_semi")
    alone = here.select("ref", "members").mapInArrow(spread, "h long, ref long, n long") \
        .groupBy("h").agg(F.min("ref").alias("ref"), F.sum("n").alias("n")) \
        .where("n = 1").groupBy("ref").agg(F.count("*").alias("alone"))
    size = (F.octet_length("members") / 8).cast("long")
    return here.select("ref", size.alias("size")).join(alone, "ref", "left") \
        .withColumn("common", F.col("size") - F.coalesce("alone", F.lit(0))) \
        .where(100 * F.col("common") >= similarity * F.col("size")).select("ref", "size", "common")


def _sketches(sets: DataFrame) -> DataFrame:
    """``ref, o0 .. o15``: the parity of the number of shingles in each of 1024
    hash buckets.  A shingle that only one of two sets has turns one bit, so the
    bits in which two sketches differ are at most the shingles in which the sets do."""

    def odd(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                raw = part.column("members").to_pylist()
                row = np.repeat(np.arange(len(raw)), [len(r) // 8 for r in raw])
                h = mix(np.frombuffer(b"".join(raw), np.uint64) + np.uint64(23)) >> np.uint64(54)
                bits = np.bincount(row * 1024 + h.astype(np.int64), minlength=1024 * len(raw)) & 1
                words = np.packbits(bits.astype(np.uint8)).view(np.int64).reshape(len(raw), SKETCH)
                yield pa.RecordBatch.from_arrays([part.column("ref"), *(pa.array(words[:, k]) for k in range(SKETCH))],
                                                 names=["ref", *(f"o{k}" for k in range(SKETCH))])

    return sets.mapInArrow(odd, "ref long, " + ", ".join(f"o{k} long" for k in range(SKETCH)))


def classes(docs: DataFrame, *, words: int = 5, similarity: int = 80, sub: tuple[int, int] = (1, 1),
            weak: float = 0.2, hot: float = 0.08, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document, and ``text_key``, a hash
    of its text."""
    ship(docs.sparkSession)
    bands = Bands.of(similarity, sub, weak, hot)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_key(F.col("text"))[0].alias("text_key"))

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, max_bytes=BATCH):
            shingles, count = shingle_sets(batch.column("text").to_pylist(), words)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(count.astype(np.int64)),
                 pa.array(signed(set_names(shingles, count)))], names=["doc_id", "text_key", "n_shingles", "ref"])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()                             # copies within a task are entered once
        for batch in small_batches(batches, max_bytes=BATCH):
            shingles, count = shingle_sets(batch.column("text").to_pylist(), words)
            refs = signed(set_names(shingles, count))
            fresh = np.zeros(len(refs), bool)
            for k, r in enumerate(refs.tolist()):
                if count[k] and r not in seen:
                    fresh[k] = True
                    seen.add(r)
            if len(seen) > 2_000_000:
                seen.clear()
            shingles = shingles[np.repeat(fresh, count)]
            sig, number = signatures(shingles, count[fresh], bands, sub)
            ends = np.concatenate(([0], np.cumsum(number))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(refs[fresh]), pa.ListArray.from_arrays(pa.array(ends), pa.array(signed(sig)))],
                names=["ref", "sigs"])

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, max_bytes=BATCH):
            shingles, count = shingle_sets(batch.column("text").to_pylist(), words)
            ends = np.cumsum(count)
            yield pa.RecordBatch.from_arrays(
                [batch.column("want"), pa.array(signed(set_names(shingles, count))),
                 pa.array([shingles[b - n:b].tobytes() for b, n in zip(ends, count, strict=True)], pa.binary())],
                names=["want", "ref", "members"])

    base = cut(rows.mapInArrow(name, "doc_id long, text_key long, n_shingles long, ref long"))
    signed_sets = rows.select("text").mapInArrow(sign, "ref long, sigs array<long>") \
        .select("ref", F.explode("sigs").alias("sig")).repartition("sig")
    groups = signed_sets.groupBy("sig").agg(F.min("ref").alias("lo"), F.max("ref").alias("hi"),
                                            F.count("*").alias("n")).where("lo < hi").select("sig", "n")
    band = F.col("sig").bitwiseAND(2 ** BAND_BITS - 1).cast("int")
    allowed = F.element_at(F.array(*[F.lit(int(h)) for h in bands.hot]), band + 1)
    hottest = F.row_number().over(Window.partitionBy("ref", band).orderBy(F.desc("n"), "sig"))
    # one shuffle by set serves both windows: the hottest signatures of a set and the weight of the rest.
    # First every set is compared with one other: of the sets it shares a signature with, the one
    # that shares most itself, the likeliest link of all
    kept = cut(signed_sets.join(groups.hint("shuffle_hash"), "sig").distinct().repartition("ref")
               .withColumn("r", hottest).where(F.col("r") > allowed)
               .select("sig", "ref", F.sum("n").over(Window.partitionBy("ref")).alias("weight")))
    lead = kept.groupBy("sig").agg(F.max_by("ref", "weight").alias("lead"),
                                   F.max("weight").alias("weight"), F.count("*").alias("n")) \
        .where("n > 1").select("sig", "lead", "weight")
    kept = cut(kept.select("sig", "ref").join(lead, "sig"))
    star = cut(kept.where("ref <> lead").groupBy("ref").agg(F.max_by("lead", "weight").alias("lead"))
               .select(F.least("lead", "ref").alias("a"), F.greatest("lead", "ref").alias("b")).distinct())
    met = cut(kept.select("ref").distinct())
    wanted = cut(base.join(few(met, broadcast_rows), "ref").groupBy(F.col("ref").alias("want"))
                 .agg(F.min("doc_id").alias("id")))
    sets = cut(rows.join(few(wanted, broadcast_rows), F.col("doc_id").eqNullSafe(F.col("id")))
               .select("want", "text").mapInArrow(members, "want long, ref long, members binary")
               .where("want = ref").select("ref", "members").dropDuplicates(["ref"]))
    links = cut(verified(star, sets, similarity))
    found = components(links)
    # members of a signature group that are still apart
    rest = cut(_apart(cut(_labelled(kept.select("sig", "ref", "lead"), found))))
    left, facts = rest.select("ref").distinct().count(), None
    while left:                                            # until no set can be ruled out any more
        facts = cut(_shared(rest, sets, similarity))
        rest = cut(_apart(rest.join(few(facts.select("ref"), broadcast_rows), "ref", "left_semi")))
        left, before = rest.select("ref").distinct().count(), left
        if left > 0.9 * before:
            break
    if left:                                               # what is known of a set is put on the rows that are left only
        known = facts.join(_sketches(sets.join(rest.select("ref").distinct(), "ref", "left_semi")), "ref")
        rest = cut(rest.join(known, "ref"))
    # the intersection is at most what the set with fewer common shingles has of them, and the
    # shingles in which linked sets differ bound the bits in which their sketches do
    most = F.least("common_a", "common_b")
    odd = [f"o{k}" for k in range(SKETCH)]
    bits = sum((F.bit_count(F.col(o + "_a").bitwiseXOR(F.col(o + "_b"))) for o in odd), F.lit(0))
    enough = (100 * most >= similarity * (F.col("size_a") + F.col("size_b") - most)) & \
        ((100 + similarity) * bits <= (100 - similarity) * (F.col("size_a") + F.col("size_b")))
    for whole in (False, True):                            # with each group's leader, then all that are apart
        if not left:
            break
        one, two = (rest.select("sig", "lead", *[F.col(c).alias(c + t) for c in ("ref", "label", "size", "common", *odd)])
                    for t in ("_a", "_b"))
        one = one.drop("lead") if whole else one.where("ref_a = lead").drop("lead")
        order = F.col("ref_a") < F.col("ref_b") if whole else F.lit(True)
        pairs = one.join(two, "sig").where(F.col("label_a") != F.col("label_b")).where(order).where(enough) \
            .select(F.least("ref_a", "ref_b").alias("a"), F.greatest("ref_a", "ref_b").alias("b")).distinct() \
            .join(star, ["a", "b"], "left_anti")
        pairs = cut(pairs)
        more = cut(verified(pairs, sets, similarity))
        star = star.unionByName(pairs)
        if more.limit(1).count():
            links = links.unionByName(more)
            found = components(links)
            rest = cut(_apart(cut(_labelled(rest.drop("label"), found))))
            left = rest.limit(1).count()
    found = found.select(F.col("node").alias("ref"), "label")
    placed = base.join(few(found, broadcast_rows), "ref", "left") \
        .withColumn("label", F.when(F.col("n_shingles") > 0, F.coalesce("label", "ref")))
    least = cut(placed.where("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("least"),
                                                                       F.count("*").alias("n"))
                .where("n > 1").select("label", "least"))
    return placed.join(few(least, broadcast_rows), "label", "left") \
        .select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"), "text_key")


def keep_one(docs: DataFrame, *, broadcast_rows: int = BROADCAST_ROWS, **settings) -> DataFrame:
    """The rows of ``docs`` less all but one of each class: the document that names it.

    Documents without words all stay.  Rows that repeat an id and its text are one
    document; of rows that share an id in one class the smallest hash of the text stays.
    """
    found = cut(classes(docs, broadcast_rows=broadcast_rows, **settings))
    worded = found.where("n_shingles > 0")
    named = worded.where("doc_id = component_id").groupBy("doc_id").agg(F.min("text_key").alias("text_key"))
    other = found.where("n_shingles = 0 OR component_id IS NULL").select("doc_id", "text_key").distinct()
    stay = cut(named.unionByName(other).select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")))
    key = text_key(F.col("text"))[0]
    kept = docs.join(few(stay, broadcast_rows), F.col("doc_id").eqNullSafe(F.col("__id")) & (key == F.col("__key")),
                     "left_semi")
    again = cut(worded.groupBy("doc_id", "text_key").count().where("count > 1")
                .select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")))
    if not again.count():
        return kept
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (key == F.col("__key"))
    twice = kept.join(few(again, broadcast_rows), same, "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(few(again, broadcast_rows), same, "left_anti").unionByName(twice)
