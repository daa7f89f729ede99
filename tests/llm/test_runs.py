"""Periodic runs against a loop over all periods, and exact identities of spans."""

import re
import zlib

import numpy as np
import pytest

from railwatch.llm import blocks
from railwatch.llm.blocks import exact_numbers, same_spans, span_hashes
from railwatch.llm.runs import periodic_runs, runs, with_periods
from tests.llm.samples import no_docs, odd_docs

BITS = "".join("ab"[i.bit_count() % 2] for i in range(4096))
SWAPPED = BITS.translate(str.maketrans("ab", "ba"))


def all_runs(words, least, times):
    found = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, times * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((i, n, q) for (i, n), q in found.items())


@pytest.mark.parametrize("least,times", [(6, 4), (2, 2), (6, 3)])
def test_runs_equal_all_periods(least, times):
    rng = np.random.default_rng(3)
    for _ in range(300):
        texts = []
        for _ in range(rng.integers(1, 6)):
            blocks_ = [np.tile(rng.integers(0, 3, rng.integers(1, 7)), rng.integers(1, 8)) for _ in range(4)]
            texts.append(rng.choice([0, 1], rng.integers(0, 60)) if rng.random() < 0.4 else np.concatenate(blocks_))
        row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        got = [tuple(r) for r in runs(np.concatenate(texts).astype(np.int64), row, least, times).tolist()]
        assert got == [(k, *r) for k, t in enumerate(texts) for r in all_runs(t.tolist(), least, times)]


def test_long_texts_of_one_period():
    n = 200_000
    for words, want in ((np.zeros(n, np.int64), [0, 0, n, 1]), (np.tile(np.arange(500), n // 500), [0, 0, n, 500])):
        assert runs(words, np.zeros(n, np.int64)).tolist() == [want]


def test_collapsed_texts(spark):
    docs = spark.createDataFrame([
        (1, "go " * 9 + "x"), (2, "a b a b a b a b\tc  d"), (3, "one two three"), (4, " \t\n"), (5, None), (6, f"{BITS} {SWAPPED} " * 4),
    ], "doc_id long, text string")
    got = {r.doc_id: r for r in periodic_runs(docs).collect()}
    assert [tuple(x) for x in got[1].runs] == [(0, 9, 1)] and got[1].collapsed == "go x"
    assert [tuple(x) for x in got[2].runs] == [(0, 8, 2)] and got[2].collapsed == "a b c d"
    assert got[3].runs == [] and got[3].collapsed == "one two three" and got[3].n_words == 3
    assert all(got[k].runs == [] and got[k].collapsed == "" and got[k].n_words == 0 for k in (4, 5))
    assert [tuple(x) for x in got[6].runs] == [(0, 8, 2)] and got[6].collapsed == f"{BITS} {SWAPPED}"


def test_planted_periods(spark):
    docs = spark.range(400).selectExpr("id AS doc_id", "array_join(transform(sequence(0, id % 50), x -> concat('w', x)), ' ') AS text").collect()
    docs = [(r.doc_id, r.text) for r in docs] + [(None, "a b"), (7000, None), (7001, "")]
    got = dict(with_periods(spark.createDataFrame(docs, "doc_id long, text string")).collect())
    changed = 0
    for i, text in docs:
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        words = re.findall("[^\x20\x09-\x0D]+", text or "")
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k if k < a else a + (k - a) % p] for k in range(n)]
            changed += 1
            text = " ".join(words)
        assert got[i] == text
    assert changed > 20


def test_odd_documents(spark):
    docs = odd_docs(spark)
    rows = periodic_runs(docs).collect()
    assert len(rows) == docs.count() and rows[0].__fields__ == ["doc_id", "n_words", "runs", "collapsed"]
    long = next(r for r in rows if r.doc_id == 8)
    assert [tuple(x) for x in long.runs] == [(0, 24_000, 4)] and long.collapsed == "word other third fourth."
    assert periodic_runs(no_docs(spark)).collect() == []
    with pytest.raises(ValueError):
        periodic_runs(docs, times=1)


def test_hashes_of_alike_strings():
    """Two strings that every polynomial modulo 2 ** 64 takes for one."""
    for n in (1024, 4096):
        data = np.frombuffer((BITS[:n] + SWAPPED[:n] + BITS[:n]).encode(), np.uint8)
        start = np.array([0, n, 2 * n])
        value = span_hashes(data, start, start + n)
        assert value[0] == value[2] != value[1]
        assert same_spans(data, start[[0, 0]], data, start[[1, 2]], np.array([n, n])).tolist() == [False, True]


def test_numbers_stay_exact_where_hashes_collide(monkeypatch):
    monkeypatch.setattr(blocks, "span_hashes", lambda data, start, end: (end - start).astype(np.uint64) // 3)
    rng = np.random.default_rng(5)
    data = rng.integers(97, 99, 300).astype(np.uint8)
    start = rng.integers(0, 280, 200)
    end = start + rng.integers(0, 12, 200)
    number = exact_numbers(data, start, end)
    text = [data[a:b].tobytes() for a, b in zip(start, end, strict=True)]
    assert len(set(number.tolist())) == len(set(text)) == len(set(zip(number.tolist(), text, strict=True)))
