"""MinHash near duplicates against plain Python."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pytest

from tarmac.llm import minhash

RNG = np.random.default_rng(11)
WORDS = [f"w{i}" for i in range(60)]
SCHEMA = "doc_id long, text string, key string, sid string, component_id string"


def shingle_set(text, size=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def brute(texts, percent=85):
    sets = [shingle_set(t) for t in texts]
    lead = list(range(len(sets)))

    def root(i):
        while lead[i] != i:
            i = lead[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(j)))
                lead[y] = x
    return [(len(s), root(i), root(i) == i) for i, s in enumerate(sets)]


def rows(spark, texts):
    return spark.createDataFrame([(i, t, "k", "s", "c") for i, t in enumerate(texts)], SCHEMA)


def run(spark, texts):
    got = {r["doc_id"]: r for r in minhash.near_duplicates(rows(spark, texts)).collect()}
    return [(got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) for i in range(len(texts))]


def edited(words, edits):
    w = list(words)
    for at in RNG.integers(0, len(w), edits):
        w[at] = f"edit{RNG.integers(1 << 40)}"
    return " ".join(w)


@pytest.fixture(scope="module")
def texts():
    out = ["", None, " \t\n", "one", "ONE", "one two", "one two", "a b c", "A b C", "é ü é ü"]
    for n in (5, 9, 20, 45, 90, 300):
        base = list(RNG.choice(WORDS, n))
        out += [edited(base, e) for e in (0, 0, 1, 1, 2, 3, 5, 9)]
    return out


@pytest.mark.parametrize("block", [4096, 2])
def test_classes_are_those_of_all_pairs(spark, texts, monkeypatch, block):
    # Blocks of two sets: nearly all bands have several.
    monkeypatch.setattr(minhash, "BLOCK", block)
    assert run(spark, texts) == brute(texts)


def test_texts_around_one_template(spark, monkeypatch):
    """Sets of a similarity of some 0.7 share many bands and must not be linked."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    base = list(RNG.choice(WORDS, 120))
    texts = [edited(base, 8) for _ in range(40)] + [edited(base, 2) for _ in range(20)]
    assert run(spark, texts) == brute(texts)


def test_a_very_long_text(spark):
    base = list(RNG.choice([f"v{i}" for i in range(5000)], 120_000))
    texts = [" ".join(base), edited(base, 500), "short text here"]
    assert [c for _, c, _ in run(spark, texts)] == [0, 0, 2]


def test_odd_tables(spark, texts):
    assert minhash.near_duplicates(rows(spark, []).limit(0)).count() == 0
    some = spark.createDataFrame([(1, "x y z"), (1, "x y z"), (None, "x y z"), (None, "other"), (None, None), (2, "X Y z")], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(some).collect()), key=str)
    assert got == sorted([(1, 1, 1, True), (1, 1, 1, True), (None, 1, 1, False), (None, 1, None, False), (None, 0, None, False), (2, 1, 1, False)], key=str)


def test_sketches_tell_similar_sets_from_others():
    def pair(share, n=400):
        both = RNG.integers(1, 1 << 62, int(n * share), dtype=np.uint64)
        own = [RNG.integers(1, 1 << 62, (n - len(both)) // 2, dtype=np.uint64) for _ in range(2)]
        sets = [np.concatenate((both, o)) for o in own]
        sketch = minhash.odd_sketch(minhash.minima(np.concatenate(sets), np.array([len(s) for s in sets])))
        return int(np.bitwise_count(sketch[0] ^ sketch[1]).sum())

    limit = minhash.most_flipped(85)
    assert all(pair(0.86) <= limit for _ in range(40)) and all(pair(0.4) > limit for _ in range(40))
    assert minhash.most_flipped(90) < limit < minhash.most_flipped(80)


def test_every_pair_across_classes_meets_once_in_some_block():
    """All sets of one band, dealt to blocks as the plan deals them, against all pairs."""
    n, blocks = 60, 4
    words = RNG.integers(0, 1 << 62, 200, dtype=np.uint64)
    sets = [np.sort(RNG.choice(words, 190, replace=False)) for _ in range(n)]
    value, sizes = np.concatenate(sets), np.array([len(s) for s in sets])
    sketch = np.hstack((minhash.odd_sketch(minhash.minima(value, sizes)), minhash.parities(value, sizes))).view(np.int64)
    of = RNG.choice([0, 0, 0, 1, 2, 3, 4], n)
    home = RNG.integers(0, blocks, n)
    rows = []
    for i in range(n):
        for b in [home[i]] if of[i] == 0 else range(blocks):
            rows.append((7, int(b), bool(b != home[i]), i, int(sizes[i]), int(of[i]), int(home[i]), bool(of[i] == 0), *sketch[i].tolist()))
    rows.sort(key=lambda r: r[:4])
    names = ["key", "block", "visit", "sid", "n", "component", "home", "largest", *minhash.SKETCH, *minhash.PARITY]
    batches = pa.Table.from_pylist([dict(zip(names, r, strict=True)) for r in rows]).to_batches(max_chunksize=13)
    got = [p for b in minhash._across(iter(batches), 60, None) for p in zip(*b.to_pydict().values(), strict=True)]
    assert sorted(got) == [(i, j) for i in range(n) for j in range(i + 1, n) if of[i] != of[j]]
    some = [p for b in minhash._across(iter(batches), 60, 1) for p in zip(*b.to_pydict().values(), strict=True)]
    assert set(some) <= set(got) and len(some) < len(got)


def test_parities_bound_the_difference():
    for _ in range(30):
        a, b = (np.unique(RNG.integers(0, 500, RNG.integers(0, 400), dtype=np.uint64)) for _ in range(2))
        p = minhash.parities(np.concatenate((a, b)), np.array([len(a), len(b)]))
        ones, apart = int(np.bitwise_count(p[0] ^ p[1]).sum()), len(np.setxor1d(a, b))
        assert ones <= apart and (apart - ones) % 2 == 0
