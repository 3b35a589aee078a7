"""Importance resampling against plain Python, over several segments."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given
from hypothesis import strategies as st
from millrace.llm import resampling

DOCS = "doc_id long, text string, weight string, place int, segment int, able string"
ID = st.one_of(st.none(), st.integers(-(2**63), 2**63 - 2))


def plain_words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain(rows, aims, percent=10, longest=1):
    def buckets(text):
        words = plain_words(text)
        runs = [" ".join(words[k : k + n]) for n in range(1, longest + 1) for k in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(run.encode()) % 10_000 for run in runs]

    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(buckets(text)[1])
    for text in aims:
        t.update(buckets(text)[1])
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (total_s + 10_000) / ((s[b] + 1) * (total_t + 10_000)))) for b in s}
    out, order = [], []
    for k, (doc_id, text) in enumerate(rows):
        n, found = buckets(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(found), weight, score, None])
        if n >= 20:
            order.append((-score, doc_id is None, doc_id, k))
    for rank, (*_, k) in enumerate(sorted(order)[: len(order) * percent // 100], start=1):
        out[k][4] = rank
    return Counter(map(tuple, out))


def corpus():
    rng = random.Random(4)
    word = lambda: rng.choice(["the", "Of", "été", "日本", "x7", "ÀB", "zeta"]) + str(rng.randrange(200))
    rows = [(k * 13 - 3000, rng.choice([" ", "\n", "-", "__"]).join(word() for _ in range(rng.randrange(60)))) for k in range(2500)]
    rows += [(77, " ".join(word() for _ in range(30)))] * 700  # one row, a fifth of the table
    rows += [(None, rows[-1][1]), (5, None), (6, ""), (7, "?!"), (8, "A" * 70_000), (9, "big " * 60_000)]
    rng.shuffle(rows)
    return rows, [rows[k][1] for k in range(40)] + [None, "", "unseen words"]


def test_against_plain_python(spark, work, monkeypatch):
    monkeypatch.setattr(resampling, "SEGMENT_ROWS", 100)
    rows, aims = corpus()
    docs = spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], DOCS).repartition(7)
    target = spark.createDataFrame([(a, 1) for a in aims], "text string, doc_id int")
    for percent in (10, 60, 100):
        found = resampling.resample(docs, target, work.__class__(spark, "draw"), percent=percent)
        assert Counter(map(tuple, found.collect())) == plain(rows, aims, percent)


def test_segments_are_even_though_rows_repeat(spark, work, monkeypatch):
    monkeypatch.setattr(resampling, "SEGMENT_ROWS", 100)
    rows = spark.createDataFrame([(3, 50, True)] * 3000 + [(k, k % 90, True) for k in range(3000)], "doc_id long, score long, able boolean")
    able = resampling.keep(resampling.sorted_runs(rows.repartition(5)), work, "runs")
    cuts = resampling.splitters(able)
    starts = resampling.segment_starts(able, cuts)
    sizes = np.diff([*starts, 6000])
    assert len(sizes) == 60 and sizes.sum() == 6000 and sizes.max() < 300


def test_longer_runs(spark, work):
    rows, aims = corpus()
    rows = rows[:300]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    target = spark.createDataFrame([(a,) for a in aims], "text string")
    found = resampling.resample(docs, target, work, longest=2, percent=30)
    assert Counter(map(tuple, found.collect())) == plain(rows, aims, 30, longest=2)


def test_empty_tables(spark, work):
    docs = spark.createDataFrame([(1, "a " * 30), (2, None)], "doc_id long, text string")
    again = work.__class__(spark, "none")
    assert resampling.resample(docs.limit(0), docs, work).collect() == []
    found = resampling.resample(docs, docs.limit(0).select("text"), again, percent=100).collect()
    assert Counter(map(tuple, found)) == plain([(1, "a " * 30), (2, None)], [], 100)


@given(st.lists(st.tuples(st.integers(-(2**62), 2**62), ID, st.integers(0, 2**50)), max_size=30))
def test_keys_sort_like_their_columns(rows):
    keys = resampling.keys_of(*(list(c) for c in zip(*rows, strict=True))) if rows else []
    want = sorted(range(len(rows)), key=lambda k: (-rows[k][0], rows[k][1] is None, rows[k][1] or 0, rows[k][2]))
    assert [rows[k] for k in sorted(range(len(rows)), key=lambda k: keys[k])] == [rows[k] for k in want]
