"""Periodic run detection: maximal repetitions of words, by longest common extensions over a difference cover.

A run is a stretch of words with smallest period q that no neighbouring word extends, of at least ``most(6, 4 q)`` words
(``REPEATS`` = 4 times its period). The documents of a batch stand one after another, with a separator of its own
after each, and are searched together:

1. *Harmonic grid.* For each period q the places 0, q, 2q, ... are compared with those q further on: n/1 + n/2 + ... =
   n log n comparisons. A run repeats its words at distance q over at least 3q places, so the grid meets it.
2. *Longest common extension.* Suffixes are sorted at the places of a difference cover only (places i whose remainder
   modulo ``BLOCK`` is in a set that has every difference): by blocks, then by doubling. For two places i, j there is a
   shift below ``BLOCK`` that takes both onto the cover; the few words before are compared one by one, the rest is a range
   minimum over the common prefixes of neighbours in the sorted order (sparse table).
3. A place whose extension reaches at least 2q and that is the first of its run is extended to the left, by the same
   structure over the reversed words of the documents that have such places.

Python tasks hold one batch of ``BATCH_WORDS`` words, or one longer document, in arrays of O(n log n) numbers. There is
no shuffle.

Defined cases: null or empty text and text of blanks have no words, no runs and an empty collapsed text. Repeated rows
are searched one by one, extra columns are ignored, an empty table gives an empty result. Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 32
REPEATS = 4
SHORTEST = 6
BATCH_WORDS = 1 << 18
#: Grid places that go through the extension step at once.
CHUNK = 1 << 20
RUN_TYPE = "array<struct<start:bigint,length:bigint,period:bigint>>"


def difference_cover(block: int) -> np.ndarray:
    """Remainders such that every difference modulo ``block`` occurs between two: greedily, most new differences first."""
    cover = [0]
    while True:
        have = {(a - b) % block for a in cover for b in cover}
        if len(have) == block:
            return np.array(sorted(cover))
        cover.append(max(range(block), key=lambda x: (len(have | {(x - c) % block for c in cover}
                                                          | {(c - x) % block for c in cover}), -x)))


COVER = difference_cover(BLOCK)
#: Place of a remainder in the cover (-1: not in it), and the shift that takes two remainders onto it.
IN_COVER = np.full(BLOCK, -1, np.int64)
IN_COVER[COVER] = np.arange(len(COVER))
SHIFT = np.array([[next(d for d in range(BLOCK) if IN_COVER[(i + d) % BLOCK] >= 0 and IN_COVER[(j + d) % BLOCK] >= 0)
                   for j in range(BLOCK)] for i in range(BLOCK)])


def _refine(rank: np.ndarray, active: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Splits groups of equal rank by ``key``; a rank is the number of suffixes before its group. Returns those still tied."""
    order = np.lexsort((key, rank[active]))
    who, old, by = active[order], rank[active[order]], key[order]
    at = np.arange(len(who))
    new_group = np.ones(len(who), bool)
    new_group[1:] = old[1:] != old[:-1]
    new_part = new_group.copy()
    new_part[1:] |= by[1:] != by[:-1]
    group_at = np.maximum.accumulate(np.where(new_group, at, 0))
    part_at = np.maximum.accumulate(np.where(new_part, at, 0))
    rank[who] = old + part_at - group_at
    alone = new_part & np.append(new_part[1:], True)
    return who[~alone]


class Extensions:
    """Longest common extensions between places of one sequence of word numbers."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.n = n
        self.words = np.append(words, np.full(2 * BLOCK, -1, words.dtype))
        base = np.arange(0, n, BLOCK)
        places = (base[:, None] + COVER).ravel()
        places = places[places < n]
        m = len(places)
        rank = np.zeros(m, np.int64)
        active = np.arange(m)
        for t in range(BLOCK):
            if not len(active):
                break
            active = _refine(rank, active, self.words[places[active] + t])
        levels = []  # ranks by the first BLOCK * 2**k words
        span = BLOCK
        while len(active):
            levels.append(rank.astype(np.int32 if m < 2**31 else np.int64))
            after = places[active] + span
            key = np.where(after < n, rank[np.minimum(self.sample(after), m - 1)], -1)
            active = _refine(rank, active, key)
            span *= 2
        order = np.argsort(rank)
        self.rank = rank
        # Common prefixes of neighbours in the order: whole levels from the top down, then single words.
        a, b = places[order[:-1]], places[order[1:]]
        common = np.zeros(max(m - 1, 0), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            span = BLOCK << k
            at = np.flatnonzero((a + common < n) & (b + common < n))
            ia, ib = self.sample(a[at] + common[at]), self.sample(b[at] + common[at])
            common[at[levels[k][ia] == levels[k][ib]]] += span
        common += self.compared(a + common, b + common, np.full(len(a), BLOCK))
        self.table = [common.astype(np.int32 if n < 2**31 else np.int64)]
        width = 1
        while 2 * width <= len(common):
            last = self.table[-1]
            self.table.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def sample(self, place: np.ndarray) -> np.ndarray:
        """Number of a cover place among the cover places."""
        return place // BLOCK * len(COVER) + IN_COVER[place % BLOCK]

    def compared(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from i and j on, up to ``most`` (at most BLOCK) of them."""
        same = np.zeros(len(i), np.int64)
        at = np.arange(len(i))
        for t in range(BLOCK):
            at = at[(t < most[at]) & (np.maximum(i[at], j[at]) + t < self.n)]
            at = at[self.words[i[at] + t] == self.words[j[at] + t]]
            if not len(at):
                break
            same[at] += 1
        return same

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that are equal from places i and j (unequal to each other) on."""
        shift = SHIFT[i % BLOCK, j % BLOCK]
        same = self.compared(i, j, shift)
        at = np.flatnonzero((same == shift) & (np.maximum(i, j) + shift < self.n))
        if len(at):
            a = self.rank[self.sample(i[at] + shift[at])]
            b = self.rank[self.sample(j[at] + shift[at])]
            low, high = np.minimum(a, b), np.maximum(a, b)
            level = np.frexp((high - low).astype(np.float64))[1] - 1
            least = np.empty(len(at), np.int64)
            for k in np.unique(level):
                of = level == k
                row = self.table[k]
                least[of] = np.minimum(row[low[of]], row[high[of] - (1 << int(k))])
            same[at] += least
        return same


def grid(words: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places g and periods q of the grid whose words agree at g and g + q and 2q - 1 words further on, in chunks.

    ``words`` holds the documents in decreasing order of length, each with a separator: only the beginning of it is long
    enough for a period.
    """
    ends = np.cumsum(lengths + 1)
    held, size = [], 0
    for q in range(1, int(lengths[0]) // REPEATS + 1 if len(lengths) else 1):
        long = np.searchsorted(-lengths, -max(SHORTEST, REPEATS * q), side="right")
        if not long:
            break
        end = int(ends[long - 1])
        left, right = words[:end - q:q], words[q:end:q]
        at = np.flatnonzero(left == right) * q
        at = at[at + 3 * q - 1 < end]
        at = at[words[at + 2 * q - 1] == words[at + 3 * q - 1]]
        if len(at):
            held.append((at, np.full(len(at), q)))
            size += len(at)
        if size >= CHUNK:
            yield tuple(np.concatenate(c) for c in zip(*held))
            held, size = [], 0
    if held:
        yield tuple(np.concatenate(c) for c in zip(*held))


def find_runs(docs: list[np.ndarray]) -> list[np.ndarray]:
    """For each document, given as numbers that equal words share, its runs as rows (start, length, period) in order."""
    order = sorted(range(len(docs)), key=lambda d: -len(docs[d]))
    order = [d for d in order if len(docs[d]) >= SHORTEST]
    none = np.empty((0, 3), np.int64)
    out = [none] * len(docs)
    if not order:
        return out
    lengths = np.array([len(docs[d]) for d in order])
    starts = np.cumsum(lengths + 1) - lengths - 1
    most = 1 + max(int(docs[d].max()) for d in order)
    words = np.concatenate([np.append(docs[d], most + k) for k, d in enumerate(order)])
    forward = None
    found = []
    for place, period in grid(words, lengths):
        forward = forward or Extensions(words)
        reach = forward(place, place + period)
        long = reach >= np.maximum((REPEATS - 2) * period, SHORTEST - 2 * period)
        place, period, reach = place[long], period[long], reach[long]
        # In a run's later places the previous one reaches exactly one period more.
        later = np.zeros(len(place), bool)
        later[1:] = (period[1:] == period[:-1]) & (place[1:] == place[:-1] + period[1:]) & (reach[:-1] == reach[1:] + period[1:])
        found.append((place[~later], period[~later], reach[~later]))
    if not found:
        return out
    place, period, reach = (np.concatenate(c) for c in zip(*found))
    if not len(place):
        return out
    # The reversed words of the documents concerned, for the extension to the left.
    doc = np.searchsorted(starts, place, side="right") - 1
    some = np.unique(doc)
    ends = np.cumsum(lengths[some] + 1)
    backward = Extensions(np.concatenate([np.append(docs[order[d]][::-1], most + k) for k, d in enumerate(some)]))
    mirrored = ends[np.searchsorted(some, doc)] - 1 - (place - starts[doc])  # of the word before the place
    before = np.zeros(len(place), np.int64)
    inner = place > starts[doc]
    before[inner] = backward(mirrored[inner], mirrored[inner] - period[inner])
    first, after = place - before, place + reach + period
    fits = after - first >= np.maximum(SHORTEST, REPEATS * period)
    runs = np.stack([doc, first - starts[doc], after - first, period], axis=1)[fits]
    # Multiples of a run's period find the same stretch: its smallest period stays.
    runs = runs[np.lexsort((runs[:, 3], runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, :3] != runs[:-1, :3]).any(axis=1)
    runs = runs[new]
    runs = runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]
    cuts = np.searchsorted(runs[:, 0], np.arange(len(order) + 1))
    for k, d in enumerate(order):
        out[d] = runs[cuts[k]:cuts[k + 1], 1:]
    return out


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """True for words that no run holds beyond its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:-1]) == 0


def _batch(keys: list, texts: list[list[bytes]], kind: pa.DataType) -> pa.RecordBatch:
    import pandas as pd
    sizes = np.array([len(t) for t in texts], np.int64)
    numbers = pd.factorize(np.array([w for t in texts for w in t], dtype=object))[0].astype(np.int64)
    runs = find_runs(np.split(numbers, np.cumsum(sizes)[:-1]))
    collapsed = []
    for words, found in zip(texts, runs):
        if len(found):
            words = [w for w, keep in zip(words, kept_words(len(words), found)) if keep]
        collapsed.append(b" ".join(words))
    rows = np.concatenate(runs)
    offsets = np.append(0, np.cumsum([len(r) for r in runs])).astype(np.int32)
    structs = pa.StructArray.from_arrays([pa.array(rows[:, c]) for c in range(3)], names=["start", "length", "period"])
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, kind), pa.array(sizes), pa.ListArray.from_arrays(pa.array(offsets), structs),
         pa.array(collapsed, pa.binary()).cast(pa.string())], names=["key", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_words, runs (start, length, period in words; in order of start, then period) and collapsed (the text's words,
    joined by one space, without what repeats a run's first period) for every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, texts, size = [], [], 0
        for batch in batches:
            for k, t in zip(batch["k"], batch["t"]):
                words = (t.as_py() or "").encode().split()
                if keys and size + len(words) > BATCH_WORDS:
                    yield _batch(keys, texts, kind)
                    keys, texts, size = [], [], 0
                keys.append(k.as_py())
                texts.append(words)
                size += len(words)
        if keys:
            yield _batch(keys, texts, kind)
    from pyspark.sql.pandas.types import to_arrow_type
    field = docs.schema[key].dataType
    kind = to_arrow_type(field)
    out = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(
        run, f"key {field.simpleString()}, n_words bigint, runs {RUN_TYPE}, collapsed string")
    return out.withColumnRenamed("key", key)
