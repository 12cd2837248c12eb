import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from harborline.llm import contamination
from harborline.llm.fm_index import FMIndex, WaveletMatrix, suffix_array
from harborline.llm.words import word_spans, words


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=60), st.lists(st.integers(1, 4), min_size=1, max_size=4))
def test_index_finds_every_occurrence(s, pattern):
    index = FMIndex(np.array(s), 6, sample=3)
    rows, low, high = index.search(np.array([pattern]))
    owner, position = index.locate(rows, low, high)
    want = [k for k in range(len(s) - len(pattern) + 1) if s[k : k + len(pattern)] == pattern]
    assert sorted(position.tolist()) == want


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=50))
def test_suffix_array_and_ranks(s):
    a = np.array([*s, -1])
    assert suffix_array(a).tolist() == sorted(range(len(a)), key=lambda k: a[k:].tolist())
    w, s = WaveletMatrix(np.array(s), 10), np.array(s)
    for c in range(10):
        assert w.rank(np.full(len(s) + 1, c), np.arange(len(s) + 1)).tolist() == [int((s[:k] == c).sum()) for k in range(len(s) + 1)]
    got, rank = w.access(np.arange(len(s)))
    assert got.tolist() == s.tolist() and rank.tolist() == [int((s[:k] == s[k]).sum()) for k in range(len(s))]


def test_typography():
    plain = words("The office can't fit 12 co-op items, o'clock")
    for t in ("<b>The</b> OFFICE can’t ﬁt​ 12 co‐op\nitems — o’clock", "> The ｏｆｆｉｃｅ can't fit\n> 12 *co-op* items; o&#39;clock"):
        assert words(t) == plain, t
        assert [w for w, _, _ in word_spans(t)] == plain
    assert words(None) == words("  ") == words("<i></i>") == []
    text = "a<b>cd</b> É&amp;f"
    assert [text[x:y] for _, x, y in word_spans(text)] == ["a", "cd", "É", "f"]


def tables(spark, docs, items):
    d = spark.createDataFrame([(k, t, "x", 1) for k, t in docs], "doc_id bigint, text string, item_id string, first_word int")
    return d, spark.createDataFrame(items, "item_id bigint, text string")


def test_same_as_brute_force(spark):
    r = random.Random(3)
    vocabulary = [f"w{n}" for n in range(12)]
    some = lambda n: [r.choice(vocabulary) for _ in range(n)]
    items = [(k, some(30)) for k in range(8)]
    docs = []
    for k in range(60):
        t = some(r.randrange(0, 60))
        if r.random() < 0.6:
            w = r.choice(items)[1]
            a = r.randrange(0, 20)
            t = t[:10] + w[a : a + r.randrange(2, 12)] + t[10:]
        docs.append((k, t))
    want = {(d, i) for d, t in docs for i, w in items if {tuple(t[k : k + 5]) for k in range(len(t) - 4)} & {tuple(w[k : k + 5]) for k in range(len(w) - 4)}}
    d, e = tables(spark, [(k, " ".join(t)) for k, t in docs], [(k, " ".join(w)) for k, w in items])
    for size in (50, 100_000):  # many shards and pieces, or one
        got = {tuple(x) for x in contamination.passages(d, e, 5, size).select("doc_id", "item_id").collect()}
        assert got == want


def test_edges(spark):
    item = " ".join(f"word{n}" for n in range(20))
    docs = [(1, item), (1, item), (2, None), (3, ""), (4, " ".join(item.split()[:11])), (5, "x " * 400_000 + item.upper().replace(" ", "\n> ") + " y" * 10), (None, item), (6, "".join(item.split()))]
    d, e = tables(spark, docs, [(7, item), (7, item), (8, None), (9, "too short"), (None, item)])
    assert sorted(map(tuple, contamination.leaked(d, e).collect())) == [(1, 7), (5, 7)]
    spans = contamination.passages(d, e).where("doc_id = 5").collect()
    assert len(spans) == 1 and (spans[0].end_word - spans[0].first_word) == 20
    assert contamination.leaked(d.limit(0), e).count() == contamination.leaked(d, e.limit(0)).count() == 0
    assert contamination.report(d, e).first().documents == 2


@pytest.mark.parametrize("block", [1, 1 << 20])
def test_blocks_of_items(spark, block, monkeypatch):
    monkeypatch.setattr(contamination, "BLOCK_BYTES", block * 300)
    items = [(k, " ".join(f"i{k}w{n}" for n in range(14))) for k in range(6)]
    d, e = tables(spark, [(k, t) for k, t in items], items)
    assert sorted(map(tuple, contamination.leaked(d, e).collect())) == [(k, k) for k in range(6)]


def test_spans_merge_over_pieces_and_items(spark):
    text = " ".join(f"word{n}" for n in range(60))
    items = [(1, " ".join(text.split()[:30])), (2, " ".join(text.split()[20:60]))]
    d, e = tables(spark, [(5, "lead " * 50 + text + " tail" * 50)], items)
    for size in (13, 40, 100_000):
        assert sorted((r.item_id, r.first_word, r.end_word) for r in contamination.passages(d, e, 12, size).collect()) == [(1, 50, 80), (2, 70, 110)]
        (cut,) = contamination.removal_spans(d, e, 12, size).collect()
        assert (cut.first_word, cut.end_word) == (50, 110) and d.first().text[cut.start_char : cut.end_char] == text
    apart, _ = tables(spark, [(6, items[0][1] + " between them " + items[1][1])], items)
    assert contamination.removal_spans(apart, e).count() == 2
