"""Buckets of suffixes: a common start is spread, and ids that are far apart come back."""

import hashlib
import tracemalloc

import numpy as np
import zstandard

from chronolens.llm import suffix


def plain(rows, length=50):
    """n_removed, n_spans and digest of each document, string by string."""
    seen, out = {}, {}
    for d, t in rows:
        raw = (t or "").encode()
        for i in range(len(raw) - length + 1):
            seen[raw[i:i + length]] = min(d, seen.get(raw[i:i + length], d))
    for d, t in rows:
        raw = (t or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - length + 1):
            if seen[raw[i:i + length]] < d:
                gone[i:i + length] = True
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out[d] = (int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


def test_a_common_start_does_not_fill_a_bucket():
    rng = np.random.default_rng(3)
    text = b"".join(b"        " + rng.integers(97, 123, 60, dtype=np.uint8).tobytes() for _ in range(3000))
    block = suffix.CoverBlock(np.array([1], "<i8").tobytes(), np.array([0, len(text)], "<i8").tobytes(), zstandard.compress(text))
    at = np.arange(3000) * 68  # all begin with the same eight bytes
    found = suffix.Suffixes(block, at[at + 50 <= len(text)], 50, 64, 4)
    assert np.diff(found.cuts).max() < 2.5 * 3000 / 64
    shares = [suffix.Suffixes(block, at, 50, 64, 4, 2, turn) for turn in (0, 1)]
    assert sorted(np.concatenate([s.place for s in shares]).tolist()) == list(range(len(at)))
    assert not set(shares[0].buckets) & set(shares[1].buckets)


def test_far_apart_ids_and_common_starts(spark):
    rng = np.random.default_rng(4)
    word = lambda n: rng.integers(97, 123, n, dtype=np.uint8).tobytes().decode()
    passages = [" " * 20 + word(70) for _ in range(6)]
    rows = []
    for i in range(40):
        d = int(rng.integers(-2**62, 2**62))
        rows.append((d, word(int(rng.integers(0, 80))) + passages[int(rng.integers(6))] + word(int(rng.integers(0, 80))) + (passages[i % 6] if i % 3 else "")))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    expected = plain(rows)
    for block in (400, 1 << 20):
        got = {r.doc_id: (r.dedup.n_removed, r.dedup.n_spans, r.dedup.kept_sha256) for r in suffix.dedup(docs, block=block, bucket=300).collect()}
        assert got == expected


def test_equal_keys_of_unlike_strings_do_not_tie():
    keys, docs, checks = np.array([7, 5, 7, 7, 5], np.uint64), np.array([0, 1, 2, 3, 4]), np.array([1, 9, 2, 1, 9], np.uint64)
    found = suffix.Keys(keys, docs, checks)
    assert list(zip(found.distinct.tolist(), found.checks.tolist(), found.first.tolist(), found.last.tolist())) == [(5, 9, 1, 4), (7, 1, 0, 3), (7, 2, 2, 2)]


def test_the_second_hash_decides_where_keys_are_equal(monkeypatch):
    real = suffix.window_keys
    monkeypatch.setattr(suffix, "window_keys", lambda raw, at, length, values=suffix._PLAIN, *more: real(raw, at, length, values, *more) if values is suffix._OTHER else np.zeros(len(at), np.uint64))
    text = b"x" * 50 + b"y" * 50 + b"x" * 50
    block = suffix.CoverBlock(np.array([1, 2, 3], "<i8").tobytes(), np.array([0, 50, 100, 150], "<i8").tobytes(), zstandard.compress(text))
    found = suffix.Suffixes(block, np.array([0, 50, 100]), 50, 4, 4).keys
    assert sorted(zip(found.first.tolist(), found.last.tolist())) == [(0, 2), (1, 1)]


def test_the_second_hash_grows_with_the_input():
    for size in (10**6, 10**9, 3 * 10**10, 10**14):
        assert size * size / 2 < 2.0 ** (64 + 8 * suffix.check_bytes(size) - 32)
    assert suffix.check_bytes(10**14) == 8


def test_hashing_a_block_takes_little_beside_its_keys():
    raw = np.random.default_rng(5).integers(0, 256, 2 << 20, dtype=np.uint8)
    at = np.arange(len(raw) - 50)
    suffix.window_keys(raw, at, 50)  # the powers are kept from one call to the next
    tracemalloc.start()
    keys = suffix.window_keys(raw, at, 50)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most - keys.nbytes < 8 << 20
    some = [0, 65_486, 65_535, 65_536, 1 << 20, len(at) - 1]
    assert suffix.window_keys(raw, np.array(some), 50).tolist() == keys[some].tolist()


def test_shares_of_the_buckets_remove_the_same(spark):
    rng = np.random.default_rng(6)
    word = lambda n: rng.integers(97, 123, n, dtype=np.uint8).tobytes().decode()
    passages = [word(90) for _ in range(4)]
    rows = [(i, word(30) + passages[i % 4] + word(30) + passages[i * 7 % 3]) for i in range(24)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    for passes in (1, 3):
        got = {r.doc_id: (r.dedup.n_removed, r.dedup.n_spans, r.dedup.kept_sha256) for r in suffix.dedup(docs, block=600, bucket=300, passes=passes).collect()}
        assert got == plain(rows)
