"""Conversation repair, periodic runs and byte BPE against brute force, on edge cases and on whole small tables."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\x0c\r"


# op11: Dijkstra over whole audits in a plain table ------------------------------------------------
def _plain_repair(rows):
    """(role, text) rows to cost, audit, turns by a table over (row, state) from the end, strings and all."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    add = {"": "u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}
    seen, faults = set(), []
    for role, text in rows:
        t = text.strip(SPACE)
        faults.append("blank" if not t else "duplicate" if (role, text) in seen else "" if t[-1] in ".!?" else "truncated")
        seen.add((role, text))
    after = None
    for i in range(len(rows), -1, -1):
        here = {}
        for s in ("", "s", "u", "a"):
            options = [(0, "", ())] if i == len(rows) and s in ("", "a") else []
            if i < len(rows):
                (role, text), f = rows[i], faults[i]
                c, a, t = after[s]
                options.append((c + 3, "D" + a, t))
                if f not in ("blank", "duplicate"):
                    more = int(f == "truncated")
                    if (s, role[:1]) in step:
                        c, a, t = after[step[s, role[:1]]]
                        options.append((c + more, "K" + a, ((role, text),) + t))
                    c, a, t = after[add[s]]
                    options.append((c + 2 + more, "R" + a, ((names[add[s]], text),) + t))
            here[s] = min(options, default=(10**9, "~", ()))
        for _ in range(3):  # insertions, until nothing changes
            for s in here:
                c, a, t = here[add[s]]
                here[s] = min(here[s], (c + 2, "I" + a, ((names[add[s]], ""),) + t))
        after = here
    cost, audit, turns = after[""]
    return cost, audit, turns, faults


def _expected(rows):
    """conv_id -> result row of the damaged rows, by plain loops."""
    out, convs = {}, {}
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        held = convs.setdefault(conv, [])
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        role = "user" if k == 4 else role
        held += [] if k == 0 else [(turn, role, text)] * (2 if k == 3 else 1)
    for conv, held in convs.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2].encode()))
        cost, audit, turns, faults = _plain_repair([r[1:] for r in held])
        numbers = [r[0] for r in held if r[0] is not None]
        initials = [r[1][:1] for r in held]
        out[conv] = (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, faults.count("blank"),
                     faults.count("duplicate"), faults.count("truncated"),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                     hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest())
    return out


def _conversations():
    rng = random.Random(11)
    rows = []
    for conv in range(120):
        for turn in range(rng.randrange(0, 9)):
            role = rng.choice(["user", "assistant", "system", "tool", "", None]) if rng.random() < 0.3 else ("user", "assistant")[turn % 2]
            text = rng.choice(["Yes.", "No", "Why?", "", None, " \t", "Fine!\n", f"Line {turn}.", "ends. x"])
            rows.append((conv, None if rng.random() < 0.1 else turn * rng.choice([1, 1, 2]), role, text))
    rows += [(None, 0, "user", "Hello."), (None, 1, "assistant", "Hi."), (500, None, "user", "a."), (500, None, "user", "a.")]
    rows += [(501, t, ("user", "assistant")[t % 2], f"Turn {t % 40}.") for t in range(300)]
    return rows + rows[:40]


@pytest.fixture(scope="module")
def conversations(spark):
    rows = [(*r, "clash") for r in _conversations()]
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, present string").repartition(3)


@pytest.mark.parametrize("most_rows", [2000, 5])
def test_conversations_against_a_plain_table(spark, conversations, most_rows):
    from labelcorpus.llm.conversations import digests, repair
    from labelcorpus.llm.queries import damaged_conversations
    rows = damaged_conversations(conversations)
    chunks = repair(rows, F.col("present"), most_rows=most_rows)
    got = {r["conv_id"]: tuple(r)[1:] for r in digests(chunks).collect()}
    assert got == _expected(_conversations())
    assert (chunks.filter("chunks > 1").count() > 10) == (most_rows == 5)


def test_conversations_of_the_table_and_none(spark):
    from labelcorpus.llm.conversations import digests, repair
    from labelcorpus.llm.queries import op11_conversation_repair
    rows = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    got = {r["conv_id"]: tuple(r)[1:] for r in op11_conversation_repair(spark, SF).collect()}
    assert got == _expected([tuple(r) for r in rows]) and len(got) > 5
    none = spark.createDataFrame([], "conv_id string, turn int, role string, text string")
    assert digests(repair(none)).collect() == []


def test_cheapest_against_all_paths():
    from labelcorpus.llm.conversations import cheapest
    for n in range(6):
        for shapes in itertools.product("suoAx", repeat=n):
            roles = {"s": "system", "u": "user", "o": "tool", "A": "assistant", "x": "user"}
            rows = [(roles[s], "" if s == "x" else f"{i}" + ("" if s == "A" else ".")) for i, s in enumerate(shapes)]
            assert cheapest("".join(shapes)) == _plain_repair(rows)[:2], shapes


def test_cheapest_between_states_composes():
    from labelcorpus.llm.conversations import ENDS, cheapest
    rng = random.Random(5)
    for _ in range(200):
        shapes = "".join(rng.choice("sSuUaAox") for _ in range(rng.randrange(2, 14)))
        cut = rng.randrange(1, len(shapes))
        paths = []
        for s in range(4):
            a, b = cheapest(shapes[:cut], 0, (s,)), cheapest(shapes[cut:], s, ENDS)
            paths += [(a[0] + b[0], a[1] + b[1])] if a and b else []
        assert min(paths) == cheapest(shapes)


# op12 ----------------------------------------------------------------------------------------
def _plain_runs(words):
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def _plain_periodic(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = _plain_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    return (len(runs), *(top or (None,) * 3), top and 1000 * top[1] // top[2],
            hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in dropped)).hexdigest())


def test_runs_against_brute_force():
    from labelcorpus.llm.periodic import find_runs
    rng = random.Random(7)
    for _ in range(300):
        docs = []
        for _ in range(rng.randrange(1, 7)):
            n, letters = rng.choice([0, 1, 5, 6, 7, 30, 100, 400]), rng.choice([1, 2, 3, 10, 1000])
            words = [rng.randrange(letters) for _ in range(n)]
            for _ in range(rng.randrange(3) if n > 10 else 0):
                start, period = rng.randrange(n), rng.randrange(1, 60)
                for i in range(start + period, rng.randrange(start, n)):
                    words[i] = words[i - period]
            docs.append(np.array(words, np.int64))
        for words, runs in zip(docs, find_runs(docs)):
            assert [tuple(r) for r in runs.tolist()] == _plain_runs(words.tolist())


def test_cover_has_every_difference_and_long_runs():
    from labelcorpus.llm.periodic import BLOCK, COVER, find_runs
    assert {(int(a) - int(b)) % BLOCK for a in COVER for b in COVER} == set(range(BLOCK)) and len(COVER) < BLOCK // 2
    n = 200_000
    for period in (1, 7, 49_999, 50_000):
        assert find_runs([np.arange(n) % period])[0].tolist() == [[0, n, period]]
    assert find_runs([np.arange(n) % 50_001])[0].tolist() == []


def test_periodic_query_on_tables_and_edge_rows(spark, tmp_path):
    from labelcorpus.llm.queries import op12_periodic_runs
    planted = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    rows = [(None, "a b " * 9, "x"), (planted, None, "x"), (planted, " \t\n", "x"), (planted, "one\x0btwo three four\r five six " * 20, "x"),
            (3, "", "x"), (3, "é " * 50, "x"), (3, "é " * 50, "x"), (5, "a b c d " * 500, "x"), (6, "x\xa0y " * 6, "x")]
    spark.createDataFrame(rows, "doc_id bigint, text string, runs string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, text string").write.parquet(f"{tmp_path}/none/documents.parquet")
    assert op12_periodic_runs(spark, f"{tmp_path}/none").count() == 0
    small = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    for folder, given in ((str(tmp_path), [r[:2] for r in rows]), (SF, [tuple(r) for r in small])):
        got = sorted((tuple(r) for r in op12_periodic_runs(spark, folder).collect()), key=repr)
        assert got == sorted(((d, *_plain_periodic(d, t)) for d, t in given), key=repr)


# op13 ----------------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def library():
    import public_tokenizers as P
    import tiktoken
    from labelcorpus.llm.bpe import read_ranks
    ranks = read_ranks(P.path("byte_bpe_50k.tiktoken"))
    return ranks, P.PATTERN, tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encoder_against_the_library(library):
    from labelcorpus.llm.bpe import Encoder
    ranks, pattern, plain = library
    enc, rng = Encoder(ranks, pattern), random.Random(13)
    sets = ["abcdefgh e tionsr", " \n\t.!'", "aab", "  a", "éü一丁가", "".join(map(chr, range(0x20, 0x600))), "😀😁🧑‍🚀"]
    for k in range(1500):
        text = "".join(rng.choice(sets[k % 7] if k % 2 else rng.choice(sets)) for _ in range(rng.randrange(60)))
        assert list(enc(text)) == plain.encode_ordinary(text), text
    for word in ("a", " ", "é", "ab", "!", "😀", "the", "=-"):
        assert list(enc(word * 20_000 + "x")) == plain.encode_ordinary(word * 20_000 + "x")
    assert len(enc(" " * 1_000_000 + "x")) == 1_000_000


def test_neighbours_against_merging(library):
    from labelcorpus.llm.bpe import Merges
    merges, rng = Merges(library[0]), random.Random(1)
    ids = list(merges.token)
    for _ in range(20_000):
        a, b = rng.choice(ids), rng.choice(ids[:2000])
        assert merges.neighbours(a, b) == (merges.merges(merges.token[a] + merges.token[b])[0] == [merges.token[a], merges.token[b]])


def test_words_together_alone_and_after_a_new_start(library, monkeypatch):
    from labelcorpus.llm import bpe
    ranks, pattern, plain = library
    rng = random.Random(4)
    texts = ["".join(rng.choice(["ab", "qu", "ion", "é", "  ", " ", "Zx", "7", "'s", "\x00", "---", "一"]) for _ in range(rng.randrange(200)))
             for _ in range(60)] + ["Unbelievably antidisestablishmentarianism! " * 3, "x" * 3000, ""]
    want = [plain.encode_ordinary(t) for t in texts]
    assert [np.frombuffer(x, '<u4').tolist() for x in bpe.Encoder(ranks, pattern).encode(texts)] == want
    enc = bpe.Encoder(ranks, pattern)
    words = [m.encode() for t in texts for m in enc.pattern.findall(t)]
    assert [i for w in words for i in enc.word(w)] == [i for ids in want for i in ids]
    for name, value in {"MOST_STATES": 20, "MOST_WORDS": 5, "MOST_PAIRS": 10, "TOGETHER": 3, "GATHERED": 100, "WRITE_EVERY": 16,
                        "LONGEST_TOGETHER": 6, "PAIR_SLOTS": 8}.items():
        monkeypatch.setattr(bpe, name, value)
    enc = bpe.Encoder(ranks, pattern)
    assert [np.frombuffer(x, '<u4').tolist() for x in enc.encode(texts)] == want and len(enc.opens) < 400


def test_utf8_machine_in_parts(library):
    from labelcorpus.llm.bpe import Decoder, Encoder
    ranks, pattern, _ = library
    enc, dec = Encoder(ranks, pattern), Decoder(ranks)
    text = "Grüße 😀 一 ￿ \x00 𐍈é"
    for cut in range(1, 6):
        ids = list(enc(text))
        assert "".join(dec.feed(ids[i:i + cut]) for i in range(0, len(ids), cut)) + dec.finish() == text
    rng = random.Random(2)
    for _ in range(3000):  # any bytes, one token each
        data = bytes(rng.choice([0x41, 0x80, 0xBF, 0xC1, 0xC3, 0xE0, 0xED, 0xA0, 0x9F, 0xF0, 0x90, 0xF4, 0x8F, 0xFF, 0xE4, 0xB8]) for _ in range(rng.randrange(9)))
        assert dec.feed([ranks[data[i:i + 1]] for i in range(len(data))]) + dec.finish() == data.decode("utf-8", "replace")


def test_bpe_query_on_tables_and_edge_rows(spark, tmp_path, library):
    from labelcorpus.llm.bpe import decode, encode, id_array
    from labelcorpus.llm.queries import op13_byte_bpe
    import public_tokenizers as P
    _, pattern, plain = library
    rows = [(1, None, "c"), (2, "", "c"), (2, "", "c"), (None, "a<|endoftext|>b", "c"), (4, " " * 300_000 + "é", "c"), (5, "x" * 200_000, "c")]
    spark.createDataFrame(rows, "doc_id bigint, text string, ids string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, text string").write.parquet(f"{tmp_path}/none/documents.parquet")
    assert op13_byte_bpe(spark, f"{tmp_path}/none").count() == 0
    small = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    for folder, given in ((str(tmp_path), [r[:2] for r in rows]), (SF, [tuple(r) for r in small])):
        got = sorted((tuple(r) for r in op13_byte_bpe(spark, folder).collect()), key=repr)
        want = []
        for doc, text in given:
            ids = np.array(plain.encode_ordinary(text or ""), "<u4")
            want.append((doc, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
        assert got == sorted(want, key=repr)
    path = P.path("byte_bpe_50k.tiktoken")
    ids = encode(spark.createDataFrame([(1, "Grüße 😀"), (2, None)], "doc_id int, text string"), path, pattern)
    arrays = ids.withColumn("ids", id_array(F.col("ids")))
    assert {r["doc_id"]: r["ids"] for r in arrays.collect()} == {1: plain.encode_ordinary("Grüße 😀"), 2: []}
    assert {r["doc_id"]: r["text"] for r in decode(arrays, path).collect()} == {1: "Grüße 😀", 2: ""}


# op2 on texts that the faster library gives up on ---------------------------------------------
def test_packing_encodes_very_long_white_space():
    import public_tokenizers as P
    from labelcorpus.llm.packing import encoder
    encode = encoder(P.path("byte_bpe_50k.json"))
    for n in (100_000, 1_000_000):
        ids = np.frombuffer(encode(" " * n + "x"), "<u4")
        assert len(ids) == n and set(ids[:-1].tolist()) == {220}
