"""Values and shapes past the usual sizes: nothing is dropped, cut, left in clear or padded without bound."""

from __future__ import annotations

import math
import random
import time

import pytest
from pyspark.sql import functions as F

from labelcorpus.llm import html_text, knn, pii


def _best(rows, every, k, scale=256):
    """Brute force in integers of any size; scores are kept to the 64-bit range."""
    whole = {i: [math.floor(scale * c) for c in v] for i, v in rows}
    out = set()
    for q, a in whole.items():
        if q % every:
            continue
        scored = sorted(((-min(max(sum(x * y for x, y in zip(a, b)), -2**63), 2**63 - 1), i) for i, b in whole.items() if i != q))
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])}
    return out


@pytest.mark.parametrize("power", [0, 20, 30, 100, 250])
def test_large_components_take_part(spark, power):
    rng = random.Random(power)
    rows = []
    for i in range(160):
        size = 2.0 ** rng.choice([0, power // 2, power])
        rows.append((i, [rng.choice([-1, 1]) * rng.random() * size for _ in range(rng.choice([3, 4]))]))
    rows += [(200 + i, rows[50][1]) for i in range(12)] + [(300, []), (301, [0.0])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    got = knn.top_k(table, every=10, k=5, pivots=9, data_block=16, query_block=4)
    assert {tuple(r) for r in got.collect()} == _best(rows, 10, 5)


def test_vectors_that_take_no_part(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [1.7e308, 0.0]), (None, [1.0])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {tuple(r) for r in knn.top_k(table, every=1, k=5).collect()}
    assert got == {(0, 1, 5, 2**63 - 1), (5, 1, 0, 2**63 - 1)}


def test_wide_table_keeps_text_and_bounds_padding():
    long = "w" * 50_000
    page = f"<table><tr><td>{long}</td><td>first</td></tr>" + "".join(
        f"<tr><td>r{i}</td><td>s{i}</td></tr>" for i in range(2000)) + "</table>"
    text = html_text.visible_text(page)
    lines = text.split("\n")
    assert lines[0] == long + "  first"
    assert lines[1] == "r0".ljust(html_text.WIDEST_CELL + 2) + "s0" and len(lines) == 2001
    assert len(text) < 4 * len(page)


def test_many_columns_bound_padding():
    head = "<tr>" + "".join(f"<td>{'c' * 70}</td>" for _ in range(900)) + "</tr>"
    page = "<table>" + head + "<tr><td colspan=899></td><td>end</td></tr>" * 500 + "</table>"
    lines = html_text.visible_text(page).split("\n")
    assert lines[1] == " " * html_text.WIDEST_LINE + "end" and len(lines) == 501


def test_spans_take_no_time_by_their_size():
    page = "<table>" + "<tr>" + "<td rowspan=65534 colspan=1000>x</td>" * 600 + "</tr>" + "<tr><td>a</td><td>b</td></tr>" * 300 + "</table>"
    start = time.perf_counter()
    text = html_text.visible_text(page)
    assert time.perf_counter() - start < 5
    assert text.count("x") == 600 and text.count("a") == 300


def test_rows_below_spans_keep_their_columns():
    page = ("<table><tr><td rowspan=2>a</td><td>b</td><td rowspan=3>c</td><td>d</td></tr><tr><td>e</td><td>f</td></tr>"
            "<tr><td>g</td><td>h</td><td>i</td></tr><tr><td>j</td><td>k</td><td>l</td><td>m</td></tr></table>")
    assert html_text.visible_text(page).split("\n") == ["a  b  c  d", "   e     f", "g  h     i", "j  k  l  m"]


def test_repeated_rows_and_long_page(spark):
    page = "<p>" + "word " * 200_000 + "</p>"
    table = spark.createDataFrame([(1, page), (1, page), (2, None), (3, "")], "page_id bigint, html string")
    got = html_text.extract(table).select("page_id", F.length("text").alias("n")).collect()
    assert sorted((r[0], r[1] if r[1] is not None else -1) for r in got) == [(1, 999_999), (1, 999_999), (2, -1), (3, 0)]


@pytest.mark.parametrize("mail", [
    "a" * 70 + "@firma.de", "a" * 5000 + ".b@firma.de", "müller@firma.de", "jörg.weiß@bücher.example", "x@" + "a." * 30 + "com"])
def test_whole_mail_addresses_are_replaced(spark, mail):
    table = spark.createDataFrame([(1, f"write to {mail} today"), (2, f"({mail})")], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in pii.pseudonymise(table, "key").collect()}
    name = got[1]["safe_text"].removeprefix("write to ").removesuffix(" today")
    assert got[1]["n_mail"] == 1 and name.count("@") == 1 and mail.split("@")[0][:3] not in name.split("@")[0][:3]
    assert got[2]["safe_text"] == f"({name})"


def test_long_words_without_mail_stay(spark):
    texts = ["a" * 1_000_000, "a." * 300_000, "a@" * 100_000, "x@" + "a." * 50_000]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    start = time.perf_counter()
    got = {r["doc_id"]: r["safe_text"] for r in pii.pseudonymise(table, "key").collect()}
    assert got == dict(enumerate(texts)) and time.perf_counter() - start < 60
