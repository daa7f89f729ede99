"""Line dedup against a plain count, its undoing, and its filters."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from railwatch.llm import lines
from railwatch.llm.lines import Cuckoo, LineState, without_frequent_lines
from tests.llm.samples import no_docs, odd_docs

SPACE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def plain(docs, store, least, points):
    seen = Counter(k for _, t in store for k in {key(x) for x in (t or "").split("\n")} if len(k) >= points)
    out = []
    for i, t in docs:
        own = (t or "").split("\n")
        kept = [x for x in own if len(key(x)) < points or seen[key(x)] < least]
        out.append((i, len(own), len(own) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def made(n, seed=1):
    rng = np.random.default_rng(seed)
    pool = ["Home", " home ", "HOME\t", "été", "", " ", "Ünder", "Line one\r", "line ONE", "x"]
    return [(i, "\n".join([*rng.choice(pool, rng.integers(0, 5)).tolist(), f"own {i % 37} {rng.integers(0, 4)}", *rng.choice(pool, 2).tolist()])) for i in range(n)]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("by_join", [False, True])
@pytest.mark.parametrize("least,points", [(10, 1), (3, 5)])
def test_lines_equal_a_plain_count(spark, monkeypatch, least, points, by_join):
    if by_join:
        monkeypatch.setattr(lines, "FILTER_BYTES", -1)
        monkeypatch.setattr(lines, "HOT_KEYS", 8)
    docs = [*made(300), (None, None), (7, "Home"), (7, "Home"), (8, "")]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    state = LineState(least_documents=least, least_points=points).insert(table)
    assert rows(without_frequent_lines(state, table)) == plain(docs, docs, least, points)


def test_insertions_and_deletions_in_any_order(spark, monkeypatch):
    monkeypatch.setattr(lines, "SHARD_KEYS", 16)
    a, b, c = ([(k * 1000 + i, t) for i, t in made(80, k)] for k in range(3))
    frame = lambda rows_: spark.createDataFrame(rows_, "doc_id long, text string")
    empty = LineState(least_documents=10)
    state = empty.insert(frame(a)).insert(frame(b)).insert(frame(c)).delete(frame(b))
    direct = empty.insert(frame(c + a))
    assert rows(state.counts) == rows(direct.counts)
    assert rows(without_frequent_lines(state, frame(a + c))) == plain(a + c, a + c, 10, 1)
    gone = state.delete(frame(a)).delete(frame(c))
    assert gone.counts.collect() == [] and rows(without_frequent_lines(gone.insert(frame(b)), frame(b))) == plain(b, b, 10, 1)
    with pytest.raises(Exception, match="had not been inserted"):
        gone.delete(frame(a))


def test_rare_keys_that_pass_a_filter_are_listed(spark, monkeypatch):
    """With fingerprints of few bits many rare keys pass; the list keeps the answer exact."""
    narrow = lambda self, keys: ((keys[:, 1].view(np.uint64) % np.uint64(3)).astype(np.int64) + 1, np.zeros(len(keys), np.int64))
    keys = np.frombuffer(b"".join(hashlib.sha256(bytes([k])).digest()[:16] for k in range(40)), "<i8").reshape(-1, 2)
    monkeypatch.setattr(Cuckoo, "places", narrow)
    held = Cuckoo.of(keys[:3])
    rare = keys[3:]
    passing = rare[held.holds(rare)]
    assert len(passing)
    members = lines.Members([(0, held.slots.tobytes(), passing.tobytes())], 1)
    assert members.frequent(keys).tolist() == [True] * 3 + [False] * 37


def test_cuckoo_filter_takes_out_what_it_took_in():
    keys = np.frombuffer(b"".join(hashlib.sha256(str(k).encode()).digest()[:16] for k in range(6000)), "<i8").reshape(-1, 2)
    held = Cuckoo.of(keys[:5000])
    assert held.holds(keys[:5000]).all() and held.holds(keys[5000:]).sum() <= 2
    for place in zip(*(x.tolist() for x in held.places(keys[:4000])), strict=True):
        held.remove(*place)
    assert held.holds(keys[4000:5000]).all() and held.holds(keys[:4000]).sum() <= 2
    with pytest.raises(KeyError):
        Cuckoo.room_for(9).remove(5, 0)
    full = Cuckoo(np.zeros((1, 4), np.uint32))
    assert all(full.add(k + 1, 0) for k in range(4))
    before = full.slots.copy()
    assert not full.add(9, 0) and (full.slots == before).all()


def test_odd_documents(spark):
    docs = odd_docs(spark)
    state = LineState(least_documents=3).insert(docs)
    got = rows(without_frequent_lines(state, docs))
    plain_rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got == plain(plain_rows, plain_rows, 3, 1)
    assert without_frequent_lines(LineState().insert(no_docs(spark)), no_docs(spark)).collect() == []
    assert without_frequent_lines(LineState(), no_docs(spark)).collect() == []
