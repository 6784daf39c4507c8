"""Collocations against counting every phrase in plain Python."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tarmac.llm import phrases

RNG = np.random.default_rng(17)
SCHEMA = "doc_id long, text string, lang string, key string, n long, shard string"


def brute(rows, least, top):
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            f = counts.setdefault(lang, Counter())
            for size in (1, 2, 3):
                f.update(tuple(w[k : k + size]) for k in range(len(w) - size + 1))
    out = []
    for lang, f in counts.items():
        some = []
        for p, a in f.items():
            if len(p) == 1 or a < least:
                continue
            if len(p) == 2 and any(len(q) == 3 and p in (q[:2], q[1:]) and b >= least and 100 * b >= 50 * a for q, b in f.items()):
                continue
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            some.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(some)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -s))
    return sorted(out)


def run(spark, rows, least=phrases.LEAST, top=phrases.TOP):
    docs = spark.createDataFrame([(i, t, lang, "k", 1, "s") for i, (t, lang) in enumerate(rows)], SCHEMA).repartition(3)
    names = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r[c] for c in names) for r in phrases.collocations(docs, least, top).collect())


@pytest.fixture(scope="module")
def rows():
    words = "New york city of the and or en de é Ü x-1 #".split()
    share = np.arange(len(words), 0, -1) / sum(range(1, len(words) + 1))
    texts = []
    for i in range(120):
        w = RNG.choice(words, RNG.integers(0, 25), p=share).tolist()
        marks = RNG.choice(["", "", "", ",", ".", "\n", "\t", "!"], len(w)).tolist()
        texts.append((" ".join(a + m for a, m in zip(w, marks, strict=True)), ["en", "de", None, "und"][i % 4]))
    return [*texts, (None, "en"), ("", "fr"), (" ., ", "fr"), ("a a a a a a a a", "en"), ("a a a a", "en")]


@pytest.mark.parametrize("least,top", [(2, 2000), (5, 7), (10, 2000)])
def test_whole_results(spark, rows, least, top):
    assert run(spark, rows, least, top) == brute(rows, least, top)


@pytest.mark.parametrize("held,slots", [(16, 64), (1 << 20, 1 << 10)])
def test_shared_slots_and_small_sums_change_nothing(spark, rows, monkeypatch, held, slots):
    """With 64 slots most phrases share one, so all are activated after the first scan."""
    monkeypatch.setattr(phrases, "HELD", held)
    for name in ("FEWEST_SLOTS", "MOST_SLOTS"):
        monkeypatch.setattr(phrases, name, slots)
    progress = phrases.Progress()
    assert progress.shards == phrases.SHARDS
    assert run(spark, rows, 3, 50) == brute(rows, 3, 50)


def test_phrases_of_one_shard_are_found(spark):
    """The phrase is in few neighbouring rows, so it is activated late and counted in the last cycle."""
    rows = [("filler words here", "en")] * 30 + [("rare pair found", "en")] * 3 + [("filler words here", "en")] * 30 + [("rare pair found", "en")] * 7
    assert run(spark, rows) == brute(rows, 10, 2000)


def test_a_phrase_has_one_whole_cycle():
    progress = phrases.Progress()
    for activated in range(8):
        steps = [s for s in range(16) if progress.counted(np.array([activated]), s)[0]]
        assert len(steps) == 4 and {s % 4 for s in steps} == {0, 1, 2, 3} and steps[0] == activated + 1
    assert not any(progress.counted(np.array([phrases.NEVER]), s)[0] for s in range(16))


def test_a_very_long_text_and_an_empty_table(spark):
    text = " ".join(RNG.choice([f"v{i}" for i in range(300)], 60_000))
    assert run(spark, [(text, "en"), ("w " * 20, "en")]) == brute([(text, "en"), ("w " * 20, "en")], 10, 2000)
    assert run(spark, []) == []
    assert run(spark, [(None, None), ("", "en")]) == []


def test_blocks_keep_keys_and_counts_in_fewer_bytes():
    keys = np.unique(RNG.integers(0, 1 << 56, 4096, dtype=np.uint64))
    n = RNG.integers(1, 5, len(keys))
    block = phrases.pack(keys, n)
    got, counts = phrases.unpack(block)
    assert got.tolist() == keys.tolist() and counts.tolist() == n.tolist()
    assert len(zlib.compress(block)) < 7 * len(keys)
    whole, total = phrases.unpack(phrases._one_block([block, phrases.pack(keys[::2], n[::2])]))
    assert whole.tolist() == keys.tolist() and total.tolist() == [c * (2 - k % 2) for k, c in enumerate(n.tolist())]


def test_a_phrase_is_spelled_by_one_shard():
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * 4, "text": ["new york", "New York", "new york", "old york"], "shard": pa.array([0, 1, 2, 3], pa.int32())})
    keys = {}
    for _, _, _, _, words, joined in phrases._chunks(batch):
        two, pairs, _, _ = phrases._phrases(words, joined)
        keys = dict(zip(two.tolist(), pairs.tolist(), strict=True))
    slots = 1 << 16
    table = np.zeros(slots >> 6, np.uint64)
    slot = (keys[0] ^ (1 * phrases.APART)) & (slots - 1)
    table[slot >> 6] = np.uint64(1 << (slot & 63))
    said = [r for made in phrases._spelled(iter([batch]), table) for r in made.to_pylist()]
    assert [(r["phrase"], r["key"]) for r in said] == [("new york", np.array([keys[0]], np.uint64).view(np.int64)[0])]
    empty = batch.filter(pa.array([True, False, True, True]))
    assert not [r for made in phrases._spelled(iter([empty]), table) for r in made.to_pylist()]


def test_blocks_hold_no_bytes_that_are_all_zero():
    for keys, n in (([5], [1]), ([0, 1, 2, 1 << 63], [1, 256, 3, 1 << 40]), (list(range(7, 5000, 3)), [2] * 1665)):
        got, counts = phrases.unpack(phrases.pack(np.array(keys, np.uint64), np.array(n)))
        assert got.tolist() == keys and counts.tolist() == n
    keys = np.unique(RNG.integers(0, 1 << 56, 4096, dtype=np.uint64))
    assert len(phrases.pack(keys, np.ones(len(keys), np.int64))) < 8 * len(keys)


def test_counts_are_given_out_a_few_blocks_at_a_time(monkeypatch):
    monkeypatch.setattr(phrases, "GIVEN", 1 << 12, raising=False)
    keys = RNG.integers(0, 1 << 63, 40_000, dtype=np.uint64) * np.uint64(2)
    sums = phrases.Sums(6)
    got = [*sums.add(2, keys[:30_000]), *sums.add(2, keys[30_000:]), *sums.add(2, keys[:5]), *sums.flush(2)]
    assert len(got) > 16 and max(b.nbytes for b in got) < 1 << 14
    found = [phrases.unpack(row["block"]) for batch in got for row in batch.to_pylist()]
    assert sorted(np.concatenate([np.repeat(k, n.astype(int)) for k, n in found]).tolist()) == sorted([*keys.tolist(), *keys[:5].tolist()])
    parts = [row["part"] for batch in got for row in batch.to_pylist()]
    assert parts == sorted(set(parts)) and all((k >> np.uint64(58) == part).all() for part, (k, _) in zip(parts, found, strict=True))


def test_a_scan_is_sent_two_bits_a_slot():
    progress = phrases.Progress(since={1: RNG.choice(np.array([*range(9), phrases.NEVER], np.uint8), 1 << 12)})
    keys = RNG.integers(0, 1 << 63, 500, dtype=np.uint64)
    first = np.arange(499)
    at = progress.since[1][keys & np.uint64((1 << 12) - 1)].astype(int)
    for step in range(12):
        made = progress.since_bits(step)
        assert sum(table.nbytes for table in made[1]) == (1 << 12) // 4
        want = progress.counted(np.maximum(at[:-1], at[1:]), step)
        assert phrases._active(made[1], keys, first).tolist() == want.tolist()
    assert not phrases._active(None, keys, first).any()


def test_batches_are_small_while_phrases_are_counted_and_as_before_after(spark, rows, monkeypatch):
    name, seen, write = "spark.sql.execution.arrow.maxBytesPerBatch", set(), phrases.materialise

    def materialise(df, label):
        seen.add(spark.conf.get(name))
        return write(df, label)

    monkeypatch.setattr(phrases, "materialise", materialise)
    before = spark.conf.get(name)
    assert run(spark, rows) == brute(rows, 10, 2000)
    assert seen == {"4m"} and spark.conf.get(name) == before
