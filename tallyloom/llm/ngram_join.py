"""Jaccard join on word shingles: segments of a partitioned universe, one-deletion neighbourhoods, exact verification.

Sets are cut into bands of sizes, each band into m segments of the hashed universe. Two sets that link differ in at most
H elements, so if the larger one asks at segments that together are worth H + 1, one of them must agree: an equal
segment is worth 1, a segment equal up to one deletion 2. Which segments a set asks is a matter of cost: empty segments
are left out unless the sum falls short without them, in small bands the longest segments are raised to deletions where the sum falls short, and later the most
frequent segments are given up as long as the rest is worth H + 1."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bitmap, bits_for, bound_batches, give_back, map_in_arrow, maybe_in, relieve_executors, whole_text, written
from .components import components
from .shingles import chunks, forget, mix, name_of, sets_of, text_sets

#: Bands up to this size index one-deletion neighbourhoods.
SMALL = 64
#: Entries in a bucket, on average.
BUCKET_ENTRIES = 1_500_000
#: Runs of equal segments with more sets than this compare with one of them first.
SHORT_RUN = 8
#: Share of segments beyond those that the pigeonhole needs.
SPARE = 1.18
PARITY_WORDS = 8
#: Sets of so many elements also carry parities in four times as many words, as the others hardly tell them apart.
WIDE_FROM, WIDE_WORDS = 384, 32
BOTH, ASKS, LISTED = 0, 1, 2  # how an entry takes part: as both sides, as the asking side, as the indexed side


def differ(a: int, b: int) -> int:
    """Largest symmetric difference of linked sets of these sizes: 7 * shared >= 3 * (a + b)."""
    return a + b - 2 * -(-3 * (a + b) // 7)


@lru_cache(maxsize=None)
def bands(upto: int = 1 << 40) -> np.ndarray:
    """First size of each band; the next is 4/3 as large, so linked sets are in one band or in neighbours."""
    out = [1]
    while out[-1] <= upto:
        out.append(-(-4 * out[-1] // 3))
    return np.array(out)


def band_of(n: int) -> int:
    return int(np.searchsorted(bands(), n, "right")) - 1


@lru_cache(maxsize=None)
def segments(band: int) -> int:
    """Number of segments: for the largest difference that any asking set has to this band, with some to spare."""
    low, high, above = int(bands()[band]), int(bands()[band + 1]) - 1, int(bands()[band + 2]) - 1
    most = max(asked(n, band) for n in {high, *range(max(low, above - 8), above + 1)})
    return math.ceil(SPARE * (most + 1)) + (1 if high > 3 else 0)


@lru_cache(maxsize=1 << 16)
def asked(n: int, band: int) -> int:
    """Largest difference of a set of n to smaller (or equal) sets of the band that it can link with; -1 if none."""
    low, high = max(int(bands()[band]), -(-3 * n // 4)), min(int(bands()[band + 1]) - 1, n)
    return max((differ(n, s) for s in range(max(low, high - 7), high + 1)), default=-1)


def entries_of(s: np.ndarray, band: int, view: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Keys, how each takes part, and by how much the asked segments exceed what is needed (they can be given up)."""
    m, n = segments(band), len(s)
    need = asked(n, band) + 1
    salt = np.uint64((band + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    where = (mix(s ^ np.uint64(0xA0761D6478BD642F)) % np.uint64(m)).astype(np.int64)
    part = mix(s + salt)
    sums, sizes = np.zeros(m, np.uint64), np.bincount(where, minlength=m)
    np.add.at(sums, where, part)
    at = np.arange(m, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    equal = mix(sums + mix(at + salt))
    full = sizes > 0
    spare = int(full.sum()) - need
    small = int(bands()[band + 1]) - 1 <= SMALL
    if not small:
        # All segments are listed; a set with too few filled ones asks at its empty ones as well, m being more than need.
        ask = full if spare >= 0 else np.ones(m, bool)
        spare = int(ask.sum()) - need
        if view == BOTH:
            return equal, np.where(ask, BOTH, LISTED).astype(np.int8), spare
        return equal[ask], np.full(int(ask.sum()), view, np.int8), spare
    # Small bands: all segments and all one-deletions are listed; short of the sum, the longest segments ask for more.
    raised = np.zeros(m, bool)
    empties = False
    if spare < 0:
        order = np.argsort(-sizes, kind="stable")[: int(full.sum())]
        raised[order[: min(-spare, len(order))]] = True
        empties = -spare > len(order)  # even so: equal empty segments count as well, and there are more segments than needed
    ask_equal = full | empties
    deleted = mix(sums[where] - part + mix(at + salt)[where])
    if view == BOTH:
        keys = np.concatenate([equal, deleted])
        kinds = np.concatenate([np.where(ask_equal, BOTH, LISTED), np.where(raised[where], BOTH, LISTED)])
    else:
        keys = np.concatenate([equal[ask_equal], deleted[raised[where]]])
        kinds = np.full(len(keys), ASKS)
    return keys, kinds.astype(np.int8), max(spare, 0)


def parity_of(s: np.ndarray) -> np.ndarray:
    """512 bits, each the parity of the elements that fall on it; two sets' bits differ in at most as many places as the
    sets do in elements."""
    bits = np.bincount((s >> np.uint64(55)).astype(np.int64), minlength=64 * PARITY_WORDS).astype(np.uint64) & np.uint64(1)
    return (bits.reshape(PARITY_WORDS, 64) << np.arange(64, dtype=np.uint64)).sum(1, dtype=np.uint64).view(np.int64)


def wide_parity_of(s: np.ndarray) -> np.ndarray | None:
    """2048 bits of the same kind, for large sets only."""
    if len(s) < WIDE_FROM:
        return None
    bits = np.bincount((s >> np.uint64(53)).astype(np.int64), minlength=64 * WIDE_WORDS).astype(np.uint64) & np.uint64(1)
    return (bits.reshape(WIDE_WORDS, 64) << np.arange(64, dtype=np.uint64)).sum(1, dtype=np.uint64).view(np.int64)


def sketch_of(s: np.ndarray) -> bytes:
    """The same with at least as many bits as elements (a power of two), so that long sets are told apart as well."""
    size = max(512, 1 << (len(s) - 1).bit_length()) if len(s) else 512
    return np.packbits(np.bincount((s & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1).tobytes()


def sketches_fit(a: bytes, b: bytes, na: int, nb: int) -> bool:
    """False only if the sets differ in too many elements. A longer sketch folds to the shorter one's size."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    size = min(len(x), len(y))
    x, y = (np.bitwise_xor.reduce(z.reshape(-1, size), axis=0) for z in (x, y))
    return int(np.bitwise_count(x ^ y).sum()) <= differ(na, nb)


PARITY = [f"p{k}" for k in range(PARITY_WORDS)]
SET = "doc_id long, n long, ref long, sketch binary, wide array<long>, " + ", ".join(f"{p} long" for p in PARITY)


def name_sets(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, size and name (ref) of each text's set, and its parities. Equal sets have one name."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    names = [x.split()[0] for x in SET.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [(len(s), name_of(s), sketch_of(s), wide_parity_of(s), parity_of(s)) for s in text_sets(batch.column(1))]
            parities = np.array([p for *_, p in sets], np.int64).reshape(len(sets), PARITY_WORDS)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x[0] for x in sets], pa.int64()), pa.array([x[1] for x in sets], pa.int64()), pa.array([x[2] for x in sets], pa.binary()), pa.array([x[3] for x in sets], pa.list_(pa.int64())), *(pa.array(parities[:, k]) for k in range(PARITY_WORDS))], names=names)
        forget()

    return map_in_arrow(rows, run, SET)


def packed_entries(docs: DataFrame, text_col: str, buckets: int) -> DataFrame:
    """bucket, blob: entries of many texts packed together. A set that a batch holds more than once is listed once."""
    rows = docs.select(whole_text(text_col).alias("text"))

    def pack(refs: list, sizes: list, spares: list, keys: list, kinds: list, owners: list) -> pa.RecordBatch | None:
        if not keys:
            return None
        key, kind, owner = np.concatenate(keys), np.concatenate(kinds), np.concatenate(owners)
        ref, size, spare = np.array(refs, np.int64), np.array(sizes, np.int32), np.minimum(np.array(spares, np.int32), 255)
        bucket = (key >> np.uint64(32)) % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        key, kind, owner, bucket = key[order], kind[order], owner[order], bucket[order]
        cuts = np.concatenate([[0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(key)]])
        blobs = []
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            own, place = np.unique(owner[a:b], return_inverse=True)
            # 48 bits of a key: a bucket holds some 2**21 of them, and a chance collision only adds a candidate.
            k, narrow, few = key[a:b], int(size[own].max()) < 1 << 16, len(own) < 1 << 14
            head = np.array([b - a, len(own), narrow, few], np.int32)
            what = (place << 2 | kind[a:b]).astype(np.uint16 if few else np.uint32)
            parts = (head, ref[own], size[own].astype(np.uint16 if narrow else np.int32), spare[own].astype(np.uint8), k.astype(np.uint32), (k >> np.uint64(48)).astype(np.uint16), what)
            blobs.append(b"".join(x.tobytes() for x in parts))
        return pa.RecordBatch.from_arrays([pa.array(bucket[cuts[:-1]].astype(np.int64)), pa.array(blobs, pa.binary())], names=["bucket", "blob"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def fresh() -> tuple:
            return [], [], [], [], [], []

        state, seen, held = fresh(), set(), 0
        for batch in batches:
            for _, data, ends in chunks(batch.column(0)):
                for s in sets_of(data, ends):
                    n = len(s)
                    if n == 0 or (ref := name_of(s)) in seen:
                        continue
                    seen.add(ref)
                    band = band_of(n)
                    views = [(band, BOTH)] + ([(band - 1, ASKS)] if band and asked(n, band - 1) >= 0 else [])
                    for b, view in views:
                        keys, kinds, spare = entries_of(s, b, view)
                        refs, sizes, spares, all_keys, all_kinds, owners = state
                        owners.append(np.full(len(keys), len(refs), np.int32))
                        refs.append(ref)
                        sizes.append(n)
                        spares.append(spare)
                        all_keys.append(keys)
                        all_kinds.append(kinds)
                        held += len(keys)
                if held > 700_000:
                    yield pack(*state)
                    state, seen, held = fresh(), set(), 0
        if (last := pack(*state)) is not None:
            yield last
        forget()

    return map_in_arrow(rows, run, "bucket long, blob binary")


HIT = "kind int, a long, b long, na int, nb int, spare int"


def unpack(blobs: list[bytes]) -> tuple[np.ndarray, ...]:
    """key, ref, size, spare, how of the entries whose key stands more than once. Only the keys of all are ever held."""
    views, keys = [], []
    for blob in blobs:
        n, owners, narrow, few = np.frombuffer(blob, np.int32, 4).tolist()
        at, view = 16, []
        for kind, count in ((np.int64, owners), (np.uint16 if narrow else np.int32, owners), (np.uint8, owners), (np.uint32, n), (np.uint16, n), (np.uint16 if few else np.uint32, n)):
            view.append(np.frombuffer(blob, kind, count, at))
            at += np.dtype(kind).itemsize * count
        *own, low, high, what = view
        views.append((*own, what))
        keys.append(high.astype(np.uint64) << np.uint64(32) | low)
    every = np.sort(np.concatenate(keys))
    shared = np.unique(every[1:][every[1:] == every[:-1]])
    del every
    parts = []
    for key, (ref, size, spare, what) in zip(keys, views):
        at = np.searchsorted(shared, key)
        keep = np.flatnonzero(shared[np.minimum(at, len(shared) - 1)] == key) if len(shared) else np.zeros(0, np.int64)
        place = (what[keep] >> 2).astype(np.int64)
        parts.append((key[keep], ref[place], size[place].astype(np.int32), spare[place].astype(np.int32), (what[keep] & 3).astype(np.int8)))
    return tuple(np.concatenate(x) for x in zip(*parts))


def counted(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different rows by their first two columns, and how often each stands."""
    order = np.lexsort((rows[:, 1], rows[:, 0]))
    rows = rows[order]
    first = np.flatnonzero(np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(1)])) if len(rows) else np.zeros(0, np.int64)
    return rows[first], np.diff(np.concatenate([first, [len(rows)]]))


def runs_to_hits(key: np.ndarray, ref: np.ndarray, size: np.ndarray, spare: np.ndarray, how: np.ndarray) -> tuple[np.ndarray, ...]:
    """Candidate pairs (a, b, how many segments must agree, how many do, who asks) and the members of long runs (key,
    ref, how, size, spare).

    At most H of the asked segments differ, so spare + 1 of them must agree. Who asks is the larger set (of equal ones
    the smaller ref), in which view it does so the last bit tells. In a run of up to SHORT_RUN sets all pairs of an asking and a listed set are candidates. In a longer one only those
    with its first listed set are; its members are handed on, for what they have in common beyond that."""
    if len(key) == 0:
        none = np.zeros(0, np.int64)
        return np.zeros((0, 4), np.int64), none, none, none, none, none, none
    order = np.lexsort((ref, how == ASKS, key))
    key, ref, size, spare, how = key[order], ref[order], size[order], spare[order], how[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (ref[1:] != ref[:-1]) | (how[1:] != how[:-1])
    key, ref, size, spare, how = key[fresh], ref[fresh], size[fresh], spare[fresh], how[fresh]
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    length = np.diff(np.concatenate([start, [len(key)]]))
    run = np.repeat(np.arange(len(start)), length)
    asks = np.bincount(run, how != LISTED, len(start)) > 0
    lists = how[start] != ASKS  # listed members come first
    use = (length > 1) & asks & lists
    short = use & (length <= SHORT_RUN)
    found = []

    def add(i: np.ndarray, j: np.ndarray) -> None:
        fits = (ref[i] != ref[j]) & (4 * np.minimum(size[i], size[j]).astype(np.int64) >= 3 * np.maximum(size[i], size[j]).astype(np.int64))
        fits &= ((how[i] != LISTED) & (how[j] != ASKS)) | ((how[j] != LISTED) & (how[i] != ASKS))
        i, j = i[fits], j[fits]
        swap = ref[i] > ref[j]
        i, j = np.where(swap, j, i), np.where(swap, i, j)
        by_b = (how[i] == LISTED) | (how[j] == ASKS) | ((how[j] != LISTED) & (how[i] != ASKS) & (size[j] > size[i]))
        who = np.where(by_b, j, i)
        found.append(np.stack([ref[i], ref[j], spare[who].astype(np.int64) + 1, 2 * by_b + (how[who] == ASKS)], 1))

    inside = np.flatnonzero(short[run])
    for step in range(1, SHORT_RUN):
        i = inside[inside + step < len(key)]
        i = i[run[i] == run[i + step]]
        add(i, i + step)
    long_ = np.flatnonzero((use & ~short)[run])
    add(start[run[long_]], long_)
    pairs, times = counted(np.concatenate(found)) if found else (np.zeros((0, 4), np.int64), np.zeros(0, np.int64))
    return pairs, times, key[long_].view(np.int64), ref[long_], how[long_], size[long_], spare[long_]


def hits_of(entries: DataFrame) -> DataFrame:
    names = [x.split()[0] for x in HIT.split(", ")]

    def run(table: pa.Table) -> pa.Table:
        pairs, times, key, ref, how, size, spare = runs_to_hits(*unpack([x.as_buffer() for c in table.column("blob").chunks for x in c]))
        zero = np.zeros(len(pairs), np.int32)
        columns = (np.concatenate([zero, np.ones(len(key), np.int32)]), np.concatenate([pairs[:, 0], key]), np.concatenate([pairs[:, 1], ref]),
                   np.concatenate([pairs[:, 2].astype(np.int32), how.astype(np.int32)]), np.concatenate([times.astype(np.int32), size.astype(np.int32)]), np.concatenate([pairs[:, 3].astype(np.int32), spare.astype(np.int32)]))
        found = pa.table([pa.array(c) for c in columns], names=names)
        del pairs, times, key, ref, how, size, spare, columns, zero
        give_back()
        return found

    bound_batches(entries.sparkSession)
    return entries.groupBy("bucket").applyInArrow(run, HIT)


def can_link(a: str, b: str) -> str:
    """Size and parity filters as SQL; they only reject pairs that can't link."""
    bits = " + ".join(f"bit_count({a}.{p} ^ {b}.{p})" for p in PARITY)
    most = f"{a}.n + {b}.n - 2 * ((3 * ({a}.n + {b}.n) + 6) div 7)"
    wide = f"aggregate(zip_with({a}.wide, {b}.wide, (v, w) -> bit_count(v ^ w)), 0, (s, c) -> s + c)"  # null if one has none
    return f"4 * least({a}.n, {b}.n) >= 3 * greatest({a}.n, {b}.n) and {bits} <= {most} and coalesce({wide} <= {most}, true)"


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Those of the pairs (a, b: refs) that link. One text for each set in a pair crosses the network, found by a bitmap
    of fixed size, and travels to each of its pairs as text, which packs better than hashes."""
    a, b = classes.drop("sketch").alias("a"), classes.drop("sketch").alias("b")
    close = pairs.alias("p").join(a, F.expr("p.a = a.ref")).join(b, F.expr("p.b = b.ref")).filter(can_link("a", "b"))
    close = close.select("p.a", "p.b", F.col("a.doc").alias("da"), F.col("b.doc").alias("db"), F.col("a.n").alias("na"), F.col("b.n").alias("nb"))
    sketch = lambda side: classes.select(F.col("ref").alias(side), F.col("sketch").alias(f"s{side}"))
    close = written(close, "close-pairs").join(sketch("a"), "a").join(sketch("b"), "b").select("a", "b", "da", "db", "na", "nb", "sa", "sb")

    def closer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = pa.array([sketches_fit(*(c[k].as_py() for c in batch.columns[6:]), *(c[k].as_py() for c in batch.columns[4:6])) for k in range(batch.num_rows)], pa.bool_())
            yield batch.select([0, 1, 2, 3]).filter(keep)

    close = written(map_in_arrow(close, closer, "a long, b long, da long, db long"), "closer-pairs")
    ends = written(close.select(F.col("a").alias("ref"), F.col("da").alias("doc")).union(close.select("b", "db")).distinct(), "pair-ends")
    bits = bits_for(ends.count())
    members = bitmap(ends.select("doc"), "doc", bits)
    rows = docs.select(F.col(id_col).cast("long").alias("t_doc"), whole_text(text_col).alias("text"))
    rows = maybe_in(rows, F.col("t_doc"), members, bits, "maybe").filter("maybe").select("t_doc", "text")
    texts = rows.join(ends, F.col("t_doc") == F.col("doc")).select("ref", "text")
    sides = close.select("a", "b").join(texts.select(F.col("ref").alias("a"), F.col("text").alias("text_a")), "a")
    sides = sides.join(texts.select(F.col("ref").alias("b"), F.col("text").alias("text_b")), "b").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            keep = np.zeros(len(a), bool)
            for k, (x, y) in enumerate(zip(text_sets(batch.column(2)), text_sets(batch.column(3)))):
                if name_of(x) == a[k] and name_of(y) == b[k]:  # ids may repeat with other texts
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    keep[k] = 100 * shared >= 75 * (len(x) + len(y) - shared)
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], names=["a", "b"])
        forget()

    return map_in_arrow(sides, run, "a long, b long").distinct()


def agreeing(hits: DataFrame) -> DataFrame:
    """Pairs of which enough segments agree, counting as agreed all that the asking set has in long runs."""
    pairs = hits.filter("kind = 0").groupBy("a", "b").agg(F.sum("nb").alias("agree"), F.max("na").alias("need"), F.max("spare").alias("who"))
    pairs = pairs.withColumn("asking", F.when(F.col("who") >= 2, F.col("b")).otherwise(F.col("a"))).withColumn("side", F.col("who") % 2 == 1)
    unseen = hits.filter(f"kind = 1 and na <> {LISTED}").groupBy(F.col("b").alias("u_ref"), (F.col("na") == ASKS).alias("u_side")).agg(F.count(F.lit(1)).alias("unseen"))
    rows = pairs.join(unseen, (F.col("asking") == F.col("u_ref")) & (F.col("side") == F.col("u_side")), "left")
    return rows.filter(F.col("agree") + F.coalesce("unseen", F.lit(0)) >= F.col("need")).select("a", "b")


def long_runs(hits: DataFrame) -> DataFrame:
    """key, ref, how, n, spare: members of the long runs."""
    return hits.filter("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("ref"), F.col("na").alias("how"), F.col("nb").alias("n"), "spare")


def mixed_runs(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Those of the long runs' members whose run holds sets of more than one component; the others have nothing more to
    tell."""
    members = members.select("key", "ref", "how", "n", "spare").join(roots.select(F.col("node").alias("r_node"), "root"), F.col("ref") == F.col("r_node"), "left")
    members = members.withColumn("root", F.coalesce("root", "ref")).drop("r_node")
    runs = members.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.count(F.lit(1)).alias("members")).filter("r0 <> r1").select(F.col("key").alias("m_key"), "members")
    return members.join(runs, F.col("key") == F.col("m_key")).drop("m_key")


def with_hubs(mixed: DataFrame) -> DataFrame:
    """Candidates of those runs: each member with its run's hub, the listed set that stands in most and longest runs, if
    that is in another component. In a group of near copies this is the set closest to what all are made of, which links
    with most that link at all; a member makes one row a run, however large the group is."""
    listed = mixed.filter(f"how <> {ASKS}")
    weights = listed.groupBy(F.col("ref").alias("w_ref")).agg(F.sum("members").alias("weight"))
    weighed = listed.select("key", "ref", "root").join(weights, F.col("ref") == F.col("w_ref"))
    hubs = weighed.groupBy(F.col("key").alias("h_key")).agg(F.max(F.struct("weight", "ref", "root")).alias("hub"))
    met = mixed.join(hubs, (F.col("key") == F.col("h_key")) & (F.col("root") != F.col("hub.root")))
    return met.select(F.least("ref", "hub.ref").alias("a"), F.greatest("ref", "hub.ref").alias("b")).distinct()


def across(mixed: DataFrame, classes: DataFrame) -> DataFrame:
    """Candidates of those runs: each asking set gives up its longest runs as far as its other segments suffice, and
    meets the listed sets of the rest that are in another component."""
    turn = F.row_number().over(Window.partitionBy("ref", "side").orderBy(F.desc("members"), "key"))
    asking = mixed.filter(f"how <> {LISTED}").withColumn("side", F.col("how") == ASKS).withColumn("turn", turn).filter("turn > spare").select("key", "ref", "root")
    listed = mixed.filter(f"how <> {ASKS}").select("key", "ref", "root")
    with_bits = lambda d: d.join(classes.withColumnRenamed("ref", "c_ref"), F.col("ref") == F.col("c_ref")).drop("c_ref", "doc", "sketch")
    x, y = with_bits(asking).alias("x"), with_bits(listed).alias("y")
    met = x.join(y, F.expr("x.key = y.key and x.root <> y.root and y.n <= x.n and " + can_link("x", "y")))
    return met.select(F.least("x.ref", "y.ref").alias("a"), F.greatest("x.ref", "y.ref").alias("b")).distinct()


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id (smallest id reachable by links, itself included).

    Words are lower-cased in A-Z; two texts link at a Jaccard similarity of 0.75 or more of their distinct 5-word
    shingles (the whole sequence if shorter). Null and empty texts have no shingles and link with nothing; a null id
    stays null, gets a null component and links nothing. Repeated rows stay. Extra columns are ignored; an empty table
    gives an empty result."""
    relieve_executors(docs.sparkSession)
    named = written(name_sets(docs, id_col, text_col), "sets")
    usable = named.filter("n > 0 and doc_id is not null")
    classes = written(usable.groupBy("ref").agg(F.min("doc_id").alias("doc"), F.max("n").alias("n"), F.max("sketch").alias("sketch"), F.max("wide").alias("wide"), *(F.max(p).alias(p) for p in PARITY)), "classes")
    shingles = classes.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, math.ceil(shingles * 0.8 / BUCKET_ENTRIES))
    relieve_executors(docs.sparkSession)
    hits = written(hits_of(packed_entries(docs, text_col, buckets)), "hits")
    edges = written(verified(agreeing(hits), classes, docs, id_col, text_col), "links")
    roots = written(components(edges), "roots")
    mixed = written(mixed_runs(long_runs(hits), roots), "mixed-runs")
    for candidates in (with_hubs, lambda left: across(left, classes)):  # the second finds all; the first leaves it few
        if mixed.isEmpty():
            break
        relieve_executors(docs.sparkSession)
        more = written(verified(candidates(mixed), classes, docs, id_col, text_col), "links")
        if not more.isEmpty():
            edges = edges.union(more)
            roots = written(components(edges), "roots")
            if candidates is with_hubs:
                mixed = written(mixed_runs(mixed, roots), "mixed-runs")
    top = roots.join(classes.select("ref", "doc"), F.col("node") == F.col("ref"))
    least = top.groupBy("root").agg(F.min("doc").alias("least"))
    final = top.select("node", "root").join(least, "root").select(F.col("node").alias("f_ref"), "least")
    by_class = classes.select("ref", "doc").join(final, F.col("ref") == F.col("f_ref"), "left").select(F.col("ref").alias("c_ref"), F.coalesce("least", "doc").alias("component_id"))
    linked = usable.select("doc_id", "n", "ref").join(by_class, F.col("ref") == F.col("c_ref")).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = named.filter("n = 0 or doc_id is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs whose id is the smallest of its component (or null), with their columns. Repeats of such a row all
    stay; rows without words link nothing and stay; an empty table stays empty."""
    found = near_components(docs, id_col, text_col)
    gone = found.filter("doc_id <> component_id").select(F.col("doc_id").alias("g_id")).distinct()
    names = {c: f"oe_{k}" for k, c in enumerate(docs.columns)}  # whatever the columns are called
    kept = docs.toDF(*names.values()).join(gone, F.col(names[id_col]) == F.col("g_id"), "left_anti")
    return kept.toDF(*names)
