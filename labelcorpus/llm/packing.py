"""Best-fit packing of documents into fixed-length sequences, with certified bin counts.

1. Every text is encoded (a byte-level BPE from a file whose path is a parameter), an end id is added, and documents
   longer than a sequence are cut from the end, so that only their first piece is shorter.
2. Pieces are dealt by hash into groups of about ``group_pieces``; each group is packed by best fit
   decreasing. Dual feasible functions give a lower bound for the group's number of
   sequences; a group that meets its bound is certified optimal.
3. Groups with a gap give up the pieces of their unfilled sequences. These are dealt anew among such
   groups (the exchange) and packed again; the new packing replaces the old if it has
   fewer sequences. This repeats for ``rounds`` rounds.

No group grows with the input: the number of groups does.

Defined cases: null or empty text is one piece with the end id alone. Repeated rows are packed one by
one; equal lengths are ordered by key, piece and check sum. Extra columns are ignored unless
named in ``carry``. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

PIECE_SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def byte_ranks(path: str) -> tuple[dict[bytes, int], str]:
    """The vocabulary of a byte-level BPE file as bytes to id, and its pattern for cutting text.

    The file spells bytes as printable characters: those that print stand for themselves, the others are
    numbered from 256 in order. In such a vocabulary ids grow in the order of the merges.
    """
    spec = json.loads(open(path, encoding="utf-8").read())
    printing = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printing]
    byte_of = {chr(b): b for b in printing} | {chr(256 + i): b for i, b in enumerate(others)}
    special = {t["content"] for t in spec.get("added_tokens", [])}
    ranks = {bytes(byte_of[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    return ranks, r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def encoder(path: str) -> Callable[[str], bytes]:
    """A function from text to token ids as little-endian 32-bit bytes.

    It runs the file's vocabulary in the faster of two installed libraries; the ids are the same (tested). The text
    is cut at the file's added tokens (the longest at a place), which have their own ids.
    """
    import tiktoken
    ranks, pattern = byte_ranks(path)
    added = {t["content"]: t["id"] for t in json.loads(open(path, encoding="utf-8").read()).get("added_tokens", [])}
    cut = re.compile("(" + "|".join(re.escape(t) for t in sorted(added, key=len, reverse=True)) + ")").split
    fast = tiktoken.Encoding("bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def ordinary(text: str) -> list[int]:
        try:
            return fast(text)
        except BaseException as e:  # its pattern matcher gives up on very long runs of white space
            if type(e).__name__ != "PanicException":
                raise
        from tokenizers import Tokenizer
        return Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids

    def ids(text: str) -> list[int]:
        if not any(t in text for t in added):
            return ordinary(text)
        return [i for n, part in enumerate(cut(text)) for i in ([added[part]] if n % 2 else ordinary(part))]
    return lambda text: np.array(ids(text), "<u4").tobytes()


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int = 0, key: str = "doc_id",
           text: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and ids, little-endian 32-bit)."""
    end = array("I", [end_id]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                out: list[tuple] = []
                for doc, doc_text in zip(part["k"].to_pylist(), part["t"].to_pylist()):
                    ids = encode(doc_text or "") + end
                    n, start = len(ids) // 4, 0
                    while start < n:
                        stop = start + ((n - start) % capacity or capacity)
                        cut = ids[4 * start: 4 * stop]
                        out.append((doc, start, stop - start, zlib.crc32(cut), cut))
                        start = stop
                doc, start, length, crc, cut = zip(*out)
                first = np.flatnonzero(np.array(start) == 0)
                number = np.arange(len(start)) - np.repeat(first, np.diff(np.append(first, len(start))))
                cols = {"doc_id": pa.array(doc, pa.int64()), "piece": pa.array(number, pa.int32()),
                        "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()),
                        "ids_crc32": pa.array(crc, pa.int64())}
                yield pa.RecordBatch.from_pydict(cols | ({"ids": pa.array(cut, pa.binary())} if with_ids else {}))
    rows = docs.select(F.col(key).cast("bigint").alias("k"), F.col(text).alias("t"))
    return rows.mapInArrow(run, PIECE_SCHEMA + (", ids binary" if with_ids else ""))


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each length (given in decreasing order), and the free space of each bin."""
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by free space
    mask, free = 0, []
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, n in enumerate(lengths.tolist()):
        fits = mask >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = open_bins[room].pop()
            if not open_bins[room]:
                mask ^= 1 << room
        else:
            room, b = capacity, len(free)
            free.append(capacity)
        bins[i], offsets[i] = b, capacity - room
        free[b] = room = room - n
        if room:
            open_bins[room].append(b)
            mask |= 1 << room
    return bins, offsets, np.array(free, np.int64)


def lower_bound(lengths: np.ndarray, capacity: int, most_k: int = 50) -> int:
    """Fewest sequences that can hold the lengths, by three families of dual feasible functions.

    The identity; the threshold functions (over ``C - e`` counts whole, under ``e`` not at all) for every e up to
    half the capacity; and the rounding functions ``floor((k + 1) x / C) / k``, exact multiples kept.
    """
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1)
    total = np.append(0, np.cumsum(count * size))  # total[i]: words in lengths below i
    number = np.append(0, np.cumsum(count))
    e = np.arange(0, capacity // 2 + 1)
    whole = number[-1] - number[capacity - e + 1]
    middle = total[capacity - e + 1] - total[e]
    best = int((whole + -(-middle // capacity)).max())
    for k in range(1, most_k + 1):
        x = size * (k + 1)
        value = np.where(x % capacity == 0, size * k, (x // capacity) * capacity)  # times k * capacity
        best = max(best, -(-int((value * count).sum()) // (k * capacity)))
    return best


def pack_groups(items: DataFrame, capacity: int, shift: int) -> DataFrame:
    """Pack each ``grp`` of items; adds sequence_id, offset, free (of its sequence), bins and bound (of its group)."""
    names = [f for f in items.columns if f != "grp"]

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
        lengths = rows["length"].to_numpy(np.int64)
        bins, offsets, free = best_fit_decreasing(lengths, capacity)
        return rows[names].assign(sequence_id=(shift + int(key[0])) * 2**24 + bins, offset=offsets, free=free[bins],
                                  grp=int(key[0]), bins=len(free), bound=lower_bound(lengths, capacity))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in items.schema if f.name != "grp")
    return items.groupBy("grp").applyInPandas(
        run, fields + ", sequence_id bigint, offset bigint, free bigint, grp bigint, bins bigint, bound bigint")


def _dealt(items: DataFrame, n: int, group_pieces: int, salt: int) -> DataFrame:
    groups = max(1, round(n / group_pieces))
    return items.withColumn("grp", F.pmod(F.xxhash64(F.lit(salt), "doc_id", "piece", "ids_crc32"), F.lit(groups)).cast("bigint"))


def best_fit_packing(items: DataFrame, capacity: int = 2048, group_pieces: int = 20_000, rounds: int = 2,
                     carry: Sequence[str] = ()) -> DataFrame:
    """Pack rows of ``pieces`` (and the columns in ``carry``) into sequences of at most ``capacity`` ids."""
    items = items.select("doc_id", "piece", "start", "length", "ids_crc32", *carry)
    names = [*items.columns, "sequence_id", "offset"]
    items = stored(items, "packing-pieces")
    now = stored(pack_groups(_dealt(items, items.count(), group_pieces, 0), capacity, 0), "packing-packed")
    done = None  # sequences that stay as they are
    for turn in range(1, rounds + 1):
        gapped = (F.col("bins") > F.col("bound")) & (F.col("free") > 0)
        loose = now.filter(gapped)
        facts = loose.agg(F.count("*").alias("n"), F.count_distinct("sequence_id").alias("bins"),
                          F.count_distinct("grp").alias("groups")).first()
        if facts["groups"] < 2:  # nobody to exchange with
            break
        again = _dealt(loose.select(*items.columns), facts["n"], group_pieces, turn)
        again = stored(pack_groups(again, capacity, turn << 34), "packing-packed")
        if again.agg(F.count_distinct("sequence_id")).first()[0] >= facts["bins"]:
            break
        settled = now.filter(~gapped).select(*names)
        done = settled if done is None else done.unionByName(settled)
        now = again
    return now.select(*names) if done is None else done.unionByName(now.select(*names))
