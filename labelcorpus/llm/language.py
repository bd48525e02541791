"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text's subwords are the byte 2-, 3- and 4-grams of its lower-cased letters, with one blank for everything else, hashed
into a fixed number of buckets. The text's vector is the mean of its subwords' embeddings; a linear layer and a
softmax give the languages. Embeddings and layer are trained together by stochastic gradient descent in numpy, in
one task, on at most ``fit_rows`` distinct labelled texts per language, those with the smallest hash.
A tenth of the sample, not used for the gradient, calibrates a temperature and the score under which a
prediction is marked as rejected.

As everything after the lookup is linear, prediction uses one table of buckets by languages
(embeddings times layer): whole texts, vectorised over batches, no shuffle.

Defined cases: null text and text without a letter are ``und`` with score 0 and rejected. Without labelled rows
every text is ``und``; with one language all others are that language. A tie goes to the first language in code
point order. Very long texts are read whole. Repeated rows get the same prediction. Extra columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .hashing import text_batches

UNKNOWN = "und"
SIZES = (2, 3, 4)
#: ASCII that is no letter reads as a blank; A-Z is lower-cased here, other letters before.
_READ = np.array([b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)], np.uint64)
_READ[65:91] += 32


def subwords(data: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every subword of consecutive texts, and the number of each text's subwords."""
    x = _READ[data]
    # one blank before and after every text, so that all texts have subwords and none spans two texts
    n = len(offsets) - 1
    padded = np.insert(x, np.repeat(offsets, 2)[1:-1], 32) if n else x
    ends = offsets[1:] + 2 * np.arange(1, n + 1)
    starts = offsets[:-1] + 2 * np.arange(n)
    text = np.repeat(np.arange(n), ends - starts)
    hashes, owners, code = [], [], padded.copy()
    for size in range(2, max(SIZES) + 1):
        code = code[:-1] * np.uint64(256) + padded[size - 1:]
        if size in SIZES and len(code):
            ok = text[size - 1:] == text[: len(text) - size + 1]
            h = (code[ok] + np.uint64(size << 40)) * np.uint64(0x9E3779B97F4A7C15)
            hashes.append((h >> np.uint64(64 - (buckets.bit_length() - 1))).astype(np.int64))
            owners.append(text[: len(ok)][ok])
    if not hashes:
        return np.empty(0, np.int64), np.zeros(n, np.int64)
    h, owner = np.concatenate(hashes), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return h[order], np.bincount(owner, minlength=n)


def _one(text: bytes, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(text, np.uint8)
    h, _ = subwords(data, np.array([0, len(data)]), buckets)
    return np.unique(h, return_counts=True)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(rows: pd.DataFrame, buckets: int, dim: int, epochs: int, rate: float, seed: int) -> dict:
    """Languages, the table (buckets x languages), bias, temperature and the rejection threshold."""
    rng = np.random.default_rng(seed)
    langs = sorted(rows["lang"].unique())
    texts = [t.lower().encode() for t in rows["text"]]
    y = np.array([langs.index(x) for x in rows["lang"]])
    order = rng.permutation(len(texts))
    check, learn = order[: len(order) // 10], order[len(order) // 10:]
    emb = rng.normal(0, 1 / dim, (buckets, dim))
    layer, bias = np.zeros((dim, len(langs))), np.zeros(len(langs))
    steps, done = max(1, epochs * len(learn) * 2), 0

    def samples(i: int) -> list[bytes]:
        # the whole text and a short passage of it, so that short texts are seen too
        t, size = texts[i], int(rng.integers(10, 200))
        at = int(rng.integers(0, max(1, len(t) - size)))
        return [t, t[at: at + size]]
    for _ in range(epochs):
        for i in rng.permutation(learn).tolist():
            for t in samples(i):
                u, c = _one(t, buckets)
                c = c / max(1, c.sum())
                h = c @ emb[u]
                g = _softmax(h @ layer + bias)
                g[y[i]] -= 1
                step = rate * (1 - done / steps)
                done += 1
                back = layer @ g
                layer -= step * np.outer(h, g)
                bias -= step * 0.01 * g
                emb[u] -= step * np.outer(c, back) * len(u) ** 0.5
    table = emb @ layer
    logits, right = [], []
    for i in check.tolist():
        for t in samples(i):
            u, c = _one(t, buckets)
            logits.append((c / max(1, c.sum())) @ table[u] + bias)
            right.append(y[i])
    temperature, least = 1.0, 0.0
    if logits:
        z, r = np.array(logits), np.array(right)
        heats = np.geomspace(0.02, 50, 80)
        # smoothed labels: without errors in the check rows plain likelihood would want no doubt at all
        wish = np.full((len(r), len(langs)), 0.02 / len(langs))
        wish[np.arange(len(r)), r] += 0.98
        loss = [-(wish * np.log(_softmax(z / t) + 1e-12)).sum(1).mean() for t in heats]
        temperature = float(heats[int(np.argmin(loss))])
        p = _softmax(z / temperature)
        top, hit = p.max(1), p.argmax(1) == r
        by = np.argsort(-top)
        good = np.cumsum(hit[by]) / np.arange(1, len(by) + 1) >= 0.99
        least = float(top[by][np.flatnonzero(good).max()]) if good.any() else 1.0
    return {"langs": langs, "table": (table / temperature).astype(np.float32), "bias": bias / temperature, "least": least}


def fit(labelled: DataFrame, fit_rows: int = 600, buckets: int = 1 << 16, dim: int = 16, epochs: int = 3,
        rate: float = 0.5, seed: int = 1, most_rows: int = 38_400) -> dict:
    """Train on (text, lang) rows: every language, at most ``fit_rows`` distinct texts of each.

    From ``most_rows / fit_rows`` languages on each has an equal share of ``most_rows``, 20 texts at least.
    """
    seen = labelled.filter("text is not null and lang is not null and length(trim(text)) > 0") \
        .select("text", "lang", F.xxhash64("text").alias("k"))
    per = stored(seen.groupBy("lang").agg(F.approx_count_distinct("k").alias("n")), "language-counts")
    n_langs = per.count()
    if not n_langs:
        return {"langs": [], "table": np.zeros((buckets, 0), np.float32), "bias": np.zeros(0), "least": 1.0}
    want = min(fit_rows, max(20, most_rows // n_langs))
    # a share with small hashes, then at most so many of it, copies once: no sort of all rows
    share = F.least(F.lit(1.0), 1.5 * want / F.col("n")) * 2.0**64 - 2.0**63
    limits = per.select("lang", F.when(F.col("n") <= 1.5 * want, 2**63 - 1).otherwise(share.cast("bigint")).alias("limit"))
    few = seen.join(limits, "lang").filter(F.col("k") <= F.col("limit")).groupBy("lang", "k").agg(F.min("text").alias("text"))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("k"))
    rows = few.withColumn("_n", first).filter(F.col("_n") <= want).select("text", "lang", "k")
    rows = stored(rows, "language-fit")

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        m = train(rows.sort_values(["k", "text"]), buckets, dim, epochs, rate, seed)
        return pd.DataFrame({"langs": [m["langs"]], "table": [m["table"].tobytes()],
                             "bias": [m["bias"].tolist()], "least": [m["least"]]})
    m = rows.groupBy(F.lit(1).alias("one")).applyInPandas(
        run, "langs array<string>, table binary, bias array<double>, least double").first()
    langs = list(m["langs"])
    return {"langs": langs, "table": np.frombuffer(m["table"], np.float32).reshape(buckets, len(langs)),
            "bias": np.array(m["bias"]), "least": m["least"]}


def predict(docs: DataFrame, model: dict, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, lang_pred, score, rejected for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex
        letter, m = regex.compile(r"\p{L}").search, shared.value
        langs, table = m["langs"], m["table"]
        for batch in batches:
            raw = batch["t"].to_pylist()
            lettered = np.array([bool(t) and letter(t) is not None for t in raw], bool) & bool(langs)
            low = pa.array([t.lower() if ok else "" for t, ok in zip(raw, lettered)], pa.large_string())
            best, score = np.zeros(len(raw), np.int64), np.zeros(len(raw))
            if langs:
                for i, j, data, offsets in text_batches(low):
                    h, n = subwords(data, offsets, len(table))
                    z = np.add.reduceat(table[h], np.append(0, np.cumsum(n)[:-1]), axis=0, dtype=np.float64)
                    p = _softmax(z / np.maximum(n, 1)[:, None] + m["bias"])
                    best[i:j], score[i:j] = p.argmax(1), p.max(1)
            names = [langs[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), lettered)]
            score = np.where(lettered, score, 0.0)
            yield pa.RecordBatch.from_pydict({key: batch["k"], "lang_pred": pa.array(names, pa.string()), "score": pa.array(score),
                                              "rejected": pa.array((score < m["least"]) | ~lettered)})
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(
        run, f"`{key}` {kind}, lang_pred string, score double, rejected boolean")


def held_out(key: str, folds: int = 5):
    """True for a fixed fold of the keys; a null key is in no fold and is not learnt from either."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % folds == 0
