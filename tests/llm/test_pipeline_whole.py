"""The pipeline's rows against a plain Python version of its five stages, on planted copies, passages and items."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash

import corpus_pipeline

PIECES = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    return " ".join("".join(rng.choices("abdeiklmnorstuvé", k=rng.randint(2, 8))) for _ in range(n))


def words(t):
    return re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())


def lowered(t):
    return re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()).decode()


def upper(t):
    return re.sub("[a-z]+", lambda m: m[0].upper(), t)


def fingerprint(t):
    w = words(lowered(t))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def one_of_each(rows):
    """The document with the smallest doc_id of each group of linked fingerprints; null ids come last."""
    prints = [fingerprint(t) for _, t, *_ in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 2 and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    best = {}
    for r, g in zip(rows, group):
        order = (r[0] is None, r[0] or 0, (r[1] or "").encode())
        if g not in best or order < best[g][0]:
            best[g] = order, r
    return [r for _, r in best.values()]


def without_repeats(rows):
    """Bytes of 50-byte strings that start in a smaller doc_id go, but for parts of characters at the cuts."""
    first, out = {}, []
    for i, t, *rest in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - 49):
            if first.setdefault(raw[p:p + 50], i) != i:
                gone[p:p + 50] = b"\1" * 50
        kept, at = [], 0
        for c in t or "":
            n = len(c.encode())
            if not all(gone[at:at + n]):
                kept.append(c)
            at += n
        out.append((i, "".join(kept), *rest))
    return out


def clean(rows, items):
    shingles = lambda t, n: {b" ".join(w[k:k + n]) for w in [words(lowered(t))] for k in range(len(w) - n + 1)}

    def hit(t):
        for s in items:
            n = min(5, len(words(s)))
            if n and len(shingles(s, n) & shingles(t, n)) >= 0.8 * len(shingles(s, n)) - 1e-9:
                return True
        return False

    return [r for r in rows if not hit(r[1])]


def plain(rows, items):
    """(doc_id, n_tokens, ids_crc32, decoded_sha256) of all that the stages keep."""
    rows = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    rows = clean(without_repeats(one_of_each(rows)), items)
    from chronolens.llm import spm
    vocabulary = spm.Vocabulary(PIECES)  # its own test holds it against an exhaustive search
    out = []
    for i, t, *_ in rows:
        ids = np.array(vocabulary.encode(t), "<u4")
        out.append((i, len(ids), zlib.crc32(ids.tobytes()), hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


def corpus(lang):
    rng = random.Random(11)
    passage, item = prose(rng, 55), prose(rng, 30)
    texts = [prose(rng, rng.randint(60, 200)) for _ in range(24)]
    texts += [texts[0], texts[1] + ".", upper(texts[2]), texts[3].replace(" ", "\n")]  # copies and near copies
    texts += [prose(rng, 40) + " " + passage + " " + prose(rng, 40) for _ in range(4)] + [passage]
    texts += [prose(rng, 50) + " " + item + " " + prose(rng, 50), upper(item), " ".join(item.split()[:12]) + " " + prose(rng, 60)]
    texts += [None, "", " \n", "12 34 !?", "one", "é"]
    rows = [(i, t, lang(i), "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    return [*rows, rows[4], (None, prose(rng, 70), None, None, None)], [item, "", None, prose(rng, 20)]


@pytest.mark.parametrize("lang", [lambda i: ("en", "de", "fr", None)[i % 4], lambda i: None, lambda i: "und"], ids=["labelled", "unlabelled", "und"])
def test_pipeline_rows(spark, tmp_path, lang):
    rows, items = corpus(lang)
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = [(r.doc_id, r.n_tokens, r.ids_crc32, r.decoded_sha256) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    expected = plain(rows, items)
    assert sorted(got, key=str) == expected
    # each stage had something to do
    kept = {i for i, *_ in expected}
    assert not {24, 26, 33, 34, 36, 37, 38, 39} & kept and {0, 1, 2, 23, 28, 32, 35, 40, None} <= kept
