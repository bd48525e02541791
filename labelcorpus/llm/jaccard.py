"""Exact n-gram Jaccard join: size-banded tiles, bitmap bounds, then sorted-array intersection.

Two texts link when the Jaccard similarity of their sets of 5-word shingles (A-Z lower-cased) is
at least 80 %. The result has one row per document with the smallest ``doc_id`` that links reach.

1. *Classes.* One pass hashes every text to its sorted set of 64-bit shingle hashes and keeps the
   set's size, a hash of the whole set (the class: equal sets are one class from here on) and a
   parity bitmap of 2 to 4 bits per shingle.
2. *Frequent shingles.* Every shingle of every text is counted (packed by hash range, about a
   byte more than four per shingle). Two bitsets of fixed size say which shingles occur more than
   once and which are the most frequent. They only set an order: rare shingles first.
3. *Candidates.* Sets that link share one of the first ``n - ceil(0.8 n) + 1`` shingles in any common
   order. All classes with such a shingle meet under a hub, the smallest class that has it; a hub's
   members are the union over its shingles, so a pair meets under few hubs, not once per shingle.
4. *Tiles.* A hub's members, sorted by size, are cut into tiles of at most ``tile`` classes, and only
   tiles whose sizes allow 80 % meet. Inside a tile pair, the bit count of the XOR of two
   bitmaps is a lower bound of the symmetric difference, so it bounds the overlap from above.
5. *Verification* intersects the sorted arrays. The first round checks a spanning forest of the
   most similar candidates of each tile pair; the second all candidates between different components,
   so large groups of near copies do not expand into all pairs and no link between components
   is missed.

64-bit hashes stand for shingles and sets; everything else is exact.

Defined cases: null, empty or white-space text has no shingles, links with nothing and is its
own component; with fewer words than a shingle the whole sequence is one shingle. Repeated rows are
rows of one class. A null ``doc_id`` takes part and never is the smallest. Extra columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .components import components
from .hashing import set_hash, shingle_sets, text_batches, word_hashes

#: Bits of the two broadcast bitsets (8 MB and 1 MB), and the share of them that may be set.
SEEN_BITS, HOT_BITS, FILL = 26, 23, 8


def _sets(column: pa.Array, k: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    for first, _, data, offsets in text_batches(column):
        yield first, shingle_sets(*word_hashes(data, offsets), k)


def _bitmap(s: np.ndarray, bits: int) -> np.ndarray:
    """Parity bitmap: bit i is the number of shingles that fall on it, modulo 2."""
    at = (s >> np.uint64(64 - bits)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=1 << bits).astype(np.uint8) & 1)


def _bitmap_bits(n: int) -> int:
    return max(6, math.ceil(math.log2(max(1, 2 * n))))


def _fold(b: np.ndarray, bits: int, to: int) -> np.ndarray:
    """The bitmap of the same set with fewer bits: neighbouring runs are XORed together."""
    if bits == to:
        return b
    flat = np.unpackbits(b).reshape(1 << to, -1)
    return np.packbits(np.bitwise_xor.reduce(flat, axis=1))


def set_facts(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, h (hash of the text as it is), n (set size), cls (class), bitmap for every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, sets in _sets(batch["text"], k):
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch["doc_id"][first: first + len(sets)],
                    "h": batch["h"][first: first + len(sets)],
                    "n": pa.array([len(s) for s in sets], pa.int64()),
                    "cls": pa.array([set_hash(s) for s in sets], pa.int64()),
                    "bitmap": pa.array([_bitmap(s, _bitmap_bits(len(s))).tobytes() for s in sets], pa.binary())})
    return docs.select("doc_id", "text", F.xxhash64("text").alias("h")).mapInArrow(
        run, "doc_id bigint, h bigint, n bigint, cls bigint, bitmap binary")


def shingle_counts(docs: DataFrame, k: int, n_shingles: int, per_bucket: int = 250_000) -> DataFrame:
    """Shingles found in more than one text: the top bits of their hash and the number of texts (clipped).

    Buckets by the hash's top bits grow in number with the input, so each holds about ``per_bucket``.
    """
    b = max(3, min(28, math.ceil(math.log2(max(1, n_shingles / per_bucket)))))
    low = np.uint64(32 - b) if b < 32 else np.uint64(0)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(held: list[np.ndarray]) -> pa.RecordBatch:
            h, c = np.unique(np.concatenate(held) >> low, return_counts=True)
            ids, c = (h >> np.uint64(32)).astype(np.int64), np.minimum(c, 255).astype(np.uint8)
            cut = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
            ends = np.append(cut[1:], len(ids))
            h = h.astype(np.uint32)
            return pa.RecordBatch.from_pydict({
                "bucket": pa.array(ids[cut], pa.int64()),
                "h": pa.array([h[i:j].tobytes() for i, j in zip(cut, ends)], pa.binary()),
                "c": pa.array([c[i:j].tobytes() for i, j in zip(cut, ends)], pa.binary())})
        held, size = [], 0
        for batch in batches:
            for _, sets in _sets(batch["text"], k):
                held += [s for s in sets if len(s)]
                size += sum(map(len, sets))
                if size > 4_000_000:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    def count(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        h = np.concatenate([np.frombuffer(x, np.uint32) for x in rows["h"]])
        c = np.concatenate([np.frombuffer(x, np.uint8) for x in rows["c"]]).astype(np.int64)
        order = np.argsort(h, kind="stable")
        h, c = h[order], c[order]
        cut = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        total = np.add.reduceat(c, cut)
        more = total > 1
        top = (np.uint64(key[0]) << np.uint64(32)) | h[cut][more].astype(np.uint64)
        # the same shift for every bucket: bits of the hash from the top
        return pd.DataFrame({"top": top.astype(np.int64), "df": np.minimum(total[more], 1 << 30)})

    packed = docs.select("text").mapInArrow(pack, "bucket bigint, h binary, c binary")
    return packed.groupBy("bucket").applyInPandas(count, "top bigint, df bigint").withColumn("bits", F.lit(b + 32))


def frequent_bitset(counts: DataFrame, bits: int) -> np.ndarray:
    """A bitset over the top ``bits`` of a hash for shingles in at least ``least`` texts.

    ``least`` is the smallest that fills at most one bit in ``FILL``; the size is fixed, so what reaches the
    driver does not grow with the input.
    """
    by = counts.groupBy(F.least(F.floor(F.log2("df") * 4), F.lit(120)).alias("g")).agg(
        F.count("*").alias("n"), F.min("df").alias("least")).collect()
    room, least = (1 << bits) // FILL, 1 << 31
    for r in sorted(by, key=lambda r: -r["g"]):
        room -= r["n"]
        if room < 0:
            break
        least = r["least"]
    return bitset(counts.filter(F.col("df") >= least).select(
        F.expr(f"shiftright(top, bits - {bits})").alias("i")), bits)


def bitset(places: DataFrame, bits: int, block: int = 19) -> np.ndarray:
    """A bitset of 2 ** bits bits with those at the column ``i`` set; blocks are filled in tasks."""
    size = min(block, bits)

    def fill(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        on = np.zeros(1 << size, np.uint8)
        on[rows["i"].to_numpy(np.int64) & ((1 << size) - 1)] = 1
        return pd.DataFrame({"block": [key[0]], "v": [np.packbits(on, bitorder="little").tobytes()]})
    made = places.distinct().groupBy(F.shiftright("i", size).alias("block")).applyInPandas(fill, "block bigint, v binary")
    out = np.zeros(1 << (bits - 3), np.uint8)
    for r in made.collect():  # 2 ** bits bits in all
        at = r["block"] << (size - 3)
        out[at: at + (1 << (size - 3))] = np.frombuffer(r["v"], np.uint8)
    return out.view(np.uint64)


def bit_of(bitset: np.ndarray, bits: int, h: np.ndarray) -> np.ndarray:
    at = h >> np.uint64(64 - bits)
    return ((bitset[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)).astype(bool)


def prefix_postings(docs: DataFrame, k: int, pct: int, seen, hot) -> DataFrame:
    """(token, cls) for the first ``n - ceil(n * pct / 100) + 1`` shingles in the order unseen, seen, hot, hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, owners = [], []
            for _, sets in _sets(batch["text"], k):
                for s in sets:
                    if not len(s):
                        continue
                    rank = bit_of(seen.value, SEEN_BITS, s).astype(np.int8) + bit_of(hot.value, HOT_BITS, s)
                    length = len(s) - -(-len(s) * pct // 100) + 1
                    picked = s[np.argsort(rank, kind="stable")[:length]]
                    tokens.append(picked)
                    owners.append(np.full(len(picked), set_hash(s)))
            if tokens:
                yield pa.RecordBatch.from_pydict({"token": np.concatenate(tokens).view(np.int64), "cls": np.concatenate(owners)})
    return docs.select("text").mapInArrow(run, "token bigint, cls bigint")


def hub_members(postings: DataFrame) -> DataFrame:
    """(hub, cls): every class that shares a token with the token's smallest class, the hub."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = hub = None
        for batch in batches:
            if not batch.num_rows:
                continue
            t, c = (batch[x].to_numpy() for x in ("token", "cls"))
            first = np.append(True, t[1:] != t[:-1])
            hubs = c[np.maximum.accumulate(np.where(first, np.arange(len(t)), 0))]
            if t[0] == token:  # the token goes on from the batch before
                hubs[: np.append(np.flatnonzero(first), len(t))[1]] = hub
            token, hub = t[-1], hubs[-1]
            pairs = np.unique(np.stack([hubs, c])[:, hubs != c], axis=1)
            if pairs.shape[1]:
                yield pa.RecordBatch.from_pydict({"hub": pairs[0], "cls": pairs[1]})
    spread = postings.repartition("token").sortWithinPartitions("token", "cls")
    found = spread.mapInArrow(run, "hub bigint, cls bigint").distinct()
    return found


def tile_rows(members: DataFrame, classes: DataFrame, pct: int, tile: int) -> DataFrame:
    """Members cut into tiles by size, once per pair of tiles that can hold a link (keys hub, ta, tb)."""
    hubs = members.select("hub").distinct().select("hub", F.col("hub").alias("cls"))
    m = members.unionByName(hubs).join(classes.select("cls", "n"), "cls")
    rank = F.row_number().over(Window.partitionBy("hub").orderBy("n", "cls")) - 1
    m = stored(m.withColumn("t", F.floor(rank / tile).cast("int")), "jaccard-tiles")
    spans = m.groupBy("hub", "t").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    a = spans.select("hub", F.col("t").alias("ta"), F.col("hi").alias("hi_a"))
    b = spans.select("hub", F.col("t").alias("tb"), F.col("lo").alias("lo_b"))
    pairs = a.join(b, "hub").filter((F.col("ta") <= F.col("tb")) & (F.col("lo_b") * pct <= F.col("hi_a") * 100)) \
        .select("hub", "ta", "tb")
    sides = pairs.select("hub", "ta", "tb", F.col("ta").alias("t"), F.lit(False).alias("right")).unionByName(
        pairs.filter("ta <> tb").select("hub", "ta", "tb", F.col("tb").alias("t"), F.lit(True).alias("right")))
    return sides.join(m, ["hub", "t"]).select("hub", "ta", "tb", "right", "cls")


def tile_candidates(rows: DataFrame, classes: DataFrame, comp: DataFrame | None, pct: int, forest: bool) -> DataFrame:
    """Candidate pairs (a < b) of each tile pair that the bitmaps allow.

    ``forest``: a spanning forest of the likeliest ones; else all between different components.
    """
    def overlaps(rows: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        # sorted by size: a row meets larger ones only, whose bitmap is as wide or twice as wide
        n, c, g, right = (rows[x] for x in ("n", "cls", "comp", "right"))
        one = not right.any()
        left, other = (np.arange(len(n)),) * 2 if one else (np.flatnonzero(~right), np.flatnonzero(right))
        wide = np.array([_bitmap_bits(x) for x in n.tolist()])
        maps = [np.frombuffer(x, np.uint8) for x in rows["bitmap"]]
        out_i, out_j, out_s = [], [], []
        for bits in np.unique(wide[left]).tolist():
            near = np.flatnonzero((wide == bits) | (wide == bits + 1))
            table = np.stack([_fold(maps[j], int(wide[j]), bits) for j in near.tolist()]).view(np.uint64)
            place = np.full(len(n), -1)
            place[near] = np.arange(len(near))
            among = other[place[other] >= 0]
            for i in left[wide[left] == bits].tolist():
                js = among[np.searchsorted(among, i, "right"):] if one else among
                js = js[(g[js] != g[i]) & (c[js] != c[i]) & (n[i] * 100 >= n[js] * pct)]
                if not len(js):
                    continue
                apart = np.bitwise_count(table[place[js]] ^ table[place[i]]).sum(axis=1, dtype=np.int64)
                most = (n[js] + n[i] - apart) // 2  # the overlap is at most this
                union = n[js] + n[i] - most
                ok = most * 100 >= union * pct
                out_i.append(np.full(int(ok.sum()), i))
                out_j.append(js[ok])
                out_s.append(most[ok] / union[ok])
        if not out_i:
            return (np.empty(0, np.int64),) * 3
        return np.concatenate(out_i), np.concatenate(out_j), np.concatenate(out_s)

    def pairs(rows: dict) -> tuple[np.ndarray, np.ndarray]:
        i, j, s = overlaps(rows)
        if forest and len(i):
            parent = list(range(len(rows["n"])))

            def root(x: int) -> int:
                while parent[x] != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                return x
            keep = []
            for e in np.argsort(-s, kind="stable").tolist():
                x, y = root(int(i[e])), root(int(j[e]))
                if x != y:
                    parent[x] = y
                    keep.append(e)
            i, j = i[keep], j[keep]
        c = rows["cls"]
        return np.minimum(c[i], c[j]), np.maximum(c[i], c[j])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come sorted by tile pair and size; a tile pair (at most two tiles) may span batches
        held = None
        for batch in chain(batches, [None]):  # None: the end
            if batch is not None:
                if not batch.num_rows:
                    continue
                part = pa.Table.from_batches([batch])
                held = part if held is None else pa.concat_tables([held, part])
            if held is None:
                continue
            col = {x: held[x].to_numpy() for x in ("hub", "ta", "tb", "n", "cls", "comp")}
            col["right"] = held["right"].to_numpy(zero_copy_only=False).astype(bool)
            new = np.flatnonzero((np.diff(col["hub"]) != 0) | (np.diff(col["ta"]) != 0) | (np.diff(col["tb"]) != 0)) + 1
            cuts = np.concatenate([[0], new, [] if batch is not None else [held.num_rows]]).astype(int)
            bitmaps, a, b = held["bitmap"].to_pylist(), [], []
            for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if y - x > 1:
                    got = pairs({k: v[x:y] for k, v in col.items()} | {"bitmap": bitmaps[x:y]})
                    a.append(got[0])
                    b.append(got[1])
            if a:
                yield pa.RecordBatch.from_pydict({"a": np.concatenate(a), "b": np.concatenate(b)})
            held = held.slice(int(cuts[-1])) if batch is not None else None

    r = rows.join(classes.select("cls", "n", "bitmap"), "cls")
    if comp is None:
        r = r.withColumn("comp", F.col("cls"))
    else:
        r = r.join(comp, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
        wanted = r.groupBy("hub", "ta", "tb").agg((F.min("comp") != F.max("comp")).alias("open")).filter("open")
        r = r.join(wanted.drop("open"), ["hub", "ta", "tb"], "left_semi")
    keys = ("hub", "ta", "tb")
    return r.select(*keys, "right", "cls", "comp", "n", "bitmap").repartition(*keys).sortWithinPartitions(
        *keys, "n", "cls").mapInArrow(run, "a bigint, b bigint").distinct()


def verified(docs: DataFrame, pairs: DataFrame, facts: DataFrame, k: int, pct: int) -> DataFrame:
    """The pairs that really link, by intersecting their sorted arrays.

    The arrays are made again from the texts, for one document per class in ``pairs``; a bitset of fixed
    size keeps the other texts out before anything is shuffled.
    """
    spark = docs.sparkSession
    need = pairs.select(F.col("a").alias("cls")).unionByName(pairs.select(F.col("b").alias("cls"))).distinct()
    bits = HOT_BITS
    wanted = spark.sparkContext.broadcast(bitset(need.select(F.shiftrightunsigned("cls", 64 - bits).alias("i")), bits))
    rep = facts.join(need, "cls", "left_semi").groupBy("cls").agg(F.min("doc_id").alias("doc_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, sets in _sets(batch["text"], k):
                cls = np.array([set_hash(s) for s in sets], np.int64)
                keep = np.flatnonzero(bit_of(wanted.value, bits, cls.view(np.uint64)) & np.array([len(s) > 0 for s in sets]))
                if len(keep):
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": batch["doc_id"].take(pa.array(first + keep)), "cls": cls[keep],
                        "s": pa.array([sets[i].tobytes() for i in keep.tolist()], pa.binary())})
    made = docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, cls bigint, s binary")
    # one row per class even where a doc_id is null or repeated
    sets = stored(made.alias("m").join(rep.alias("r"), (F.col("m.cls") == F.col("r.cls"))
                                       & F.col("m.doc_id").eqNullSafe(F.col("r.doc_id")))
                  .select("m.cls", "s").groupBy("cls").agg(F.first("s").alias("s")), "jaccard-sets")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["sa"], batch["sb"]):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = np.concatenate([x, y])
                both.sort(kind="stable")  # two sorted runs: a merge
                common = int((both[1:] == both[:-1]).sum())
                keep.append(common * 100 >= (len(both) - common) * pct)
            yield pa.RecordBatch.from_pydict({"a": batch["a"], "b": batch["b"]}).filter(pa.array(keep, pa.bool_()))
    p = pairs.join(sets.select(F.col("cls").alias("a"), F.col("s").alias("sa")), "a") \
        .join(sets.select(F.col("cls").alias("b"), F.col("s").alias("sb")), "b")
    return p.select("a", "b", "sa", "sb").mapInArrow(check, "a bigint, b bigint")


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, pct: int = 80,
                       tile: int = 512, row_hash: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id per row of ``docs`` (see the module docstring).

    ``row_hash`` adds h, the xxhash64 of the row's text, to tell rows with the same doc_id apart.
    """
    spark = docs.sparkSession
    d = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    facts = stored(set_facts(d, k), "jaccard-facts")
    total = facts.agg(F.sum("n")).first()[0] or 0
    counts = stored(shingle_counts(d, k, total), "jaccard-counts")
    seen, hot = (spark.sparkContext.broadcast(frequent_bitset(counts, bits)) for bits in (SEEN_BITS, HOT_BITS))
    postings = prefix_postings(d, k, pct, seen, hot)
    members = stored(hub_members(postings), "jaccard-members")
    classes = facts.filter("n > 0").groupBy("cls").agg(F.first("n").alias("n"), F.first("bitmap").alias("bitmap"))
    classes = stored(classes.join(members.select("cls").unionByName(members.select(F.col("hub").alias("cls"))).distinct(),
                                  "cls", "left_semi"), "jaccard-classes")
    rows = stored(tile_rows(members, classes, pct, tile), "jaccard-rows")
    first = stored(tile_candidates(rows, classes, None, pct, forest=True), "jaccard-pairs")
    links = stored(verified(d, first, facts, k, pct), "jaccard-links")
    comp = components(links)
    second = tile_candidates(rows, classes, comp, pct, forest=False).join(first, ["a", "b"], "left_anti")
    second = stored(second, "jaccard-pairs")
    links = links.unionByName(stored(verified(d, second, facts, k, pct), "jaccard-links"))
    comp = components(links)
    own = F.when(F.col("n") == 0, F.lit(None)).otherwise(F.coalesce("comp", "cls"))
    d = facts.select("doc_id", "h", "n", "cls").join(comp, "cls", "left").withColumn("comp", own)
    least_id = d.filter("comp is not null").groupBy("comp").agg(F.min("doc_id").alias("least"))
    return d.join(least_id, "comp", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"),
        *(["h"] if row_hash else []))
