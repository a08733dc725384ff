"""Every operator against brute force on small inputs, with nulls, empty and long texts, repeats, empty tables and clashing columns."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from chronolens.llm import ann, chat, decontam, langid, lm, sharding, simhash, spm, suffix, token_output
from chronolens.llm.common import word_hashes, word_spans

rng = random.Random(5)
WORDS = ["the", "and", "house", "river", "der", "und", "haus", "über", "ciel", "été", "maison", "x", "12", "it's", "日本"]
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def text(n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


PASSAGE = text(40)
TEXTS = [None, "", " \n\t", "one", "One", text(300), text(120), text(5000), "  two  spaces ▁ ", "a" * 700]
TEXTS += [TEXTS[5], TEXTS[5] + " more", text(50) + " " + PASSAGE, PASSAGE + " " + text(60), text(30) + PASSAGE]
ROWS = [(i, t, "en" if i % 2 else "de", 7, "c") for i, t in enumerate(TEXTS)] + [(5, TEXTS[5], "en", 7, "c"), (None, PASSAGE, None, 7, "c")]
SCHEMA = "doc_id long, text string, lang string, score int, shard string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(t):
    return re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())


def test_sharding(docs, empty):
    rows = sharding.shard_documents(docs, 40).collect()
    assert len(rows) == len(ROWS)
    assert all(r.grown_shard in (r.shard, 40) and 0 <= r.shard < 40 for r in rows)
    for s in {r.shard for r in rows}:
        own = [r.slot for r in rows if r.shard == s]
        assert sorted(own) == list(range(len(own)))
    assert {(r.doc_id, r.text_crc32, r.size) for r in rows} == {(i, zlib.crc32((t or "").encode()), len((t or "").encode()) + 16) for i, t, *_ in ROWS}
    assert sharding.shard_documents(empty, 40).count() == 0


def test_sharding_moves_only_with_its_subtree(spark):
    rows = spark.range(4000).withColumnRenamed("id", "k")
    old = [sharding.Leaf(r, q, 4 * r + 2 * q + s) for r in range(3) for q in range(2) for s in range(2)]
    new = [sharding.Leaf(x.region, x.rack, x.shard, 3.0 if x.shard == 5 else 1.0) for x in old]
    got = sharding.place(sharding.place(rows, "k", old, "a"), "k", new, "b").collect()
    assert any(r.a != r.b for r in got)
    assert all(r.a // 4 == 1 or r.b // 4 == 1 for r in got if r.a != r.b)


def test_token_output(spark, docs, empty):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    folder = token_output.new_folder(spark)
    token_output.write_blocks(docs, folder, path, block=500)
    got = {}
    for r in token_output.digest(spark, folder).collect():
        got.setdefault(r.doc_id, []).append((r.start, r.n_tokens, r.ids_crc32))
    start = 0
    for i, t, *_ in sorted(ROWS, key=lambda r: (r[0] is not None, r[0])):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        assert (start, len(ids), zlib.crc32(ids.tobytes())) in got[i]
        start += len(ids)
    folder = token_output.new_folder(spark)
    token_output.write_blocks(empty, folder, path)
    assert token_output.digest(spark, folder).count() == 0


def test_huffman_lengths_and_round_trip():
    counts = np.array([1, 1, 2, 3, 5, 8, 13, 21, 34, 55])
    for limit in (4, 5, 9):
        n = token_output.code_lengths(counts, limit)
        assert n.max() <= limit and sum(2.0 ** -n) <= 1
    assert (counts * token_output.code_lengths(counts, 9)).sum() == 361 or sum(2.0 ** -token_output.code_lengths(counts, 9)) == 1
    ids = np.arange(10)
    by, lengths, codes = token_output.canonical(ids, token_output.code_lengths(counts, 5))
    code_of, length_of = np.zeros(10, np.uint32), np.zeros(10, np.uint8)
    code_of[by], length_of[by] = codes, lengths
    for size in (1, 63, 64, 65, 1000):
        flat = np.array(rng.choices(range(10), k=size), np.uint32)
        bits, marks = token_output.pack(flat, code_of, length_of)
        assert (token_output.Decoder(by, lengths).unpack(bits.tobytes(), marks, size) == flat).all()


def test_simhash(docs, empty):
    def fp(t):
        w = words(t)
        if not w:
            return 0
        h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 3]), 42) for i in range(max(1, len(w) - 2))]
        return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))

    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == len(ROWS)
    fps = {i: fp(t) for i, t, *_ in ROWS}
    group = {i: {i} for i in fps}
    for a in fps:
        for b in fps:
            if bin(fps[a] ^ fps[b]).count("1") <= 2 and group[a] is not group[b]:
                both = group[a] | group[b]
                for x in both:
                    group[x] = both
    for r in rows:
        assert r.fingerprint == f"{fps[r.doc_id]:016x}"
        assert r.component_id == min((x for x in group[r.doc_id] if x is not None), default=None)
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns and kept.count() == len({r.component_id for r in rows})
    assert simhash.near_duplicates(empty).count() == 0


def test_anchor_cover_finds_every_close_pair():
    base = np.array([rng.getrandbits(64) for _ in range(30)], np.uint64)
    for x in base:
        a, b = rng.sample(range(64), 2)
        y = x ^ np.uint64(1 << a) ^ np.uint64(1 << b)
        _, keys, home = simhash.anchors(np.array([x], np.uint64).view(np.int64))
        _, visits, _ = simhash.anchors(np.array([y], np.uint64).view(np.int64))
        assert home.sum() == 1 and keys[home][0] in visits


def test_language_id(spark, empty):
    said = {"en": ["the river", "and then the house"], "de": ["der fluss", "und dann das haus"], "fr": ["la rivière", "et puis la maison"], "es": ["el río", "y luego la casa"]}
    rows = [(i, " ".join(rng.choices(said[v], k=6)), v, 7, "c") for i, v in enumerate(list(said) * 30)]
    docs = spark.createDataFrame(rows + [(900, None, "en", 1, ""), (901, "12 !?", "en", 1, "")], SCHEMA)
    got = {r.doc_id: r for r in langid.predict(docs, langid.train(docs.where("doc_id < 60"))).collect()}
    assert all(got[i].lang_pred == v and 0 <= got[i].score <= 1 for i, _, v, *_ in rows)
    assert got[900].lang_pred == got[901].lang_pred == "und"
    assert {r.lang_pred for r in langid.predict(docs, langid.train(empty)).collect()} == {"und"}


def test_suffix_dedup(docs, empty):
    first, expected = {}, {}
    for i, t in sorted({(i, t or "") for i, t, *_ in ROWS}, key=lambda r: (r[0] is None, r[0])):
        raw = t.encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - 49):
            if first.setdefault(raw[p:p + 50], i) != i:
                gone[p:p + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(raw, gone) if not g)
        expected[i] = len(raw), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()
    for block in (1 << 10, 1 << 20):
        out = suffix.dedup(docs, block=block, bucket=1 << 10)
        assert out.columns == ["doc_id", "lang", "score", "shard", "dedup"]
        rows = out.select("doc_id", "dedup.*").collect()
        assert len(rows) == len(ROWS)
        for r in rows:
            assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == expected[r.doc_id]
    assert suffix.dedup(empty).count() == 0


def test_cover_has_every_difference():
    assert {(a - b) % suffix.MODULUS for a in suffix.COVER for b in suffix.COVER} == set(range(suffix.MODULUS))


def test_nearest(spark):
    x = np.random.default_rng(1).normal(size=(400, 8))
    x[50:60] = x[50]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(401, None), (402, [0.0] * 8), (403, [float("nan")] * 8), (404, [None] * 8)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(v, v.where("vec_id % 20 = 0"), k=5, factor=1.0, shard=50, asked=7, leaf=8).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = r.vec_id
    for q in range(0, 400, 20):
        s = np.cumsum(x * x[q], axis=1)[:, -1]
        best = [i for i in np.lexsort((np.arange(400), -s)) if i != q][:5]
        assert [got[q][k] for k in range(1, 6)] == best
    assert len(got) == 20
    assert ann.nearest(v.limit(0), v.limit(0)).count() == 0


def test_decontamination(spark, docs, empty):
    items = [(1, PASSAGE), (2, "one"), (3, None), (4, ""), (5, text(30) + " never " + text(3)), (6, PASSAGE + " tail")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    shingles = lambda t, n: {b" ".join(words(t)[i:i + n]) for i in range(len(words(t)) - n + 1)}
    expected = []
    for d, t, *_ in ROWS:
        for i, s in items:
            n = min(5, len(words(s)))
            if n and (share := len(shingles(s, n) & shingles(t, n)) / len(shingles(s, n))) >= 0.8 - 1e-9:
                expected.append((str(d), i, share))
    for block in (1 << 24, 200):
        got = [(str(r.doc_id), r.item_id, r.containment) for r in decontam.contaminated(docs, bench, block=block).collect()]
        assert sorted(got) == sorted(expected) and expected
    bad = {d for d, *_ in expected}
    assert decontam.clean(docs, bench).count() == sum(str(r[0]) not in bad for r in ROWS)
    assert decontam.contaminated(empty, bench).count() == decontam.contaminated(docs, bench.limit(0)).count() == 0


def test_language_model(docs, empty):
    from collections import Counter

    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, *_ in ROWS}
    count = Counter()
    for i, t, *_ in ROWS:
        if not held[i]:
            count.update([*words(t), None])
    n, v = sum(count.values()), len(count)
    for r in lm.score_documents(docs, block=1 << 12).collect():
        tokens = [*words(next(t for i, t, *_ in ROWS if i == r.doc_id)), None]
        base = sum(np.log10((count[w] + 1) / (n + v + 1)) for w in tokens)
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(tokens), sum(w in count for w in tokens), n, held[r.doc_id])
        assert abs(r.base_score - base) < 1e-6 * max(1, -base) and r.score <= 1e-9
    assert lm.score_documents(empty).count() == 0


def test_language_model_context_picks_the_word_in_its_class(spark):
    candidates = [f"w{i}" for i in range(200)]
    raw = np.frombuffer(" ".join(candidates).encode(), np.uint8)
    starts, ends, _ = word_spans(raw, np.array([0, len(raw)]))
    keys = word_hashes(raw, starts, ends)
    kind = lm.classes_of(np.full(200, 100), keys, np.zeros(200, np.int64), 600).tolist()
    one, two = [w for w, k in zip(candidates, kind) if k == kind[0]][:2]
    train = [i for i in range(400) if not lm.is_held_out(i)][:200]
    said = [(i, f"left {one}" if k % 2 else f"right {two}") for k, i in enumerate(train)]
    held = [i for i in range(400) if lm.is_held_out(i)][:2]
    rows = spark.createDataFrame([*said, (held[0], f"left {one}"), (held[1], f"left {two}")], "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r for r in lm.score_documents(rows, rounds=2).collect()}
    assert abs(got[held[0]].base_score - got[held[1]].base_score) < 1e-9
    assert got[held[0]].score > got[held[1]].score + 0.2


def test_language_model_grows_with_its_input():
    for n in (10 ** 4, 10 ** 6, 10 ** 10):
        assert n < 1 << lm.row_bits(n) < 10 * n
    keys = np.unique(np.random.default_rng(3).integers(0, 1 << 63, 5000).astype(np.uint64))
    kind = np.arange(len(keys)) % 7 + 1
    deep = lm.depths_of(keys, kind)
    leaves = [(c, int(k) >> 64 - 5 * int(d), int(d)) for k, c, d in zip(keys, kind.tolist(), deep)]
    assert len(set(leaves)) == len(keys)
    assert not any((c, p >> 5 * s, d - s) in set(leaves) for c, p, d in leaves[:300] for s in range(1, d + 1))


def test_chat(spark):
    hard = r"\### Assistant: </turn> ok \\ </turn>"
    turns = [("user", hard), ("a:ss", ""), ("assistant", "é\n" + hard)]
    formatted, spans = chat.render(turns)
    assert chat.parse(formatted) == turns
    assert [chat.unescape(formatted[a:b]) for a, b in spans] == ["é\n" + hard]
    records = ['{"prompt":"a","response":"b"}', '{"prompt":"a","response":"b","id":3}', '{"messages":[{"role":"user","content":"x"}]}', '{"conversations":[{"from":"human","value":"x"},{"from":"gpt","value":"y"}]}', '{"odd":1}', "{", None, '{"messages":[]}']
    rows = chat.format_chats(spark.createDataFrame([(i, r, 1) for i, r in enumerate(records)], "conv_id long, record string, formatted int")).orderBy("conv_id").collect()
    assert [r.layout for r in rows] == ["prompt", "prompt", "messages", "conversations", None, None, None, "messages"]
    assert chat.parse(rows[3].formatted) == [("user", "x"), ("assistant", "y")]


@pytest.mark.parametrize("chunk", [64, 1000])
def test_sentencepiece(docs, empty, chunk):
    from sentencepiece import SentencePieceProcessor

    v = spm.Vocabulary(PIECES)
    rows = spm.decode(spm.encode(docs, PIECES, chunk), PIECES).collect()
    assert len(rows) == len(ROWS) and any(r.n_chunks > 1 for r in rows)
    for r in rows:
        t = next(t for i, t, *_ in ROWS if i == r.doc_id) or ""
        assert list(r.ids) == v.encode(t) and r.decoded == t
    assert spm.encode(empty, PIECES).count() == 0
    assert [list(x) for x in v.encode_column(pa.array(["a  b", None, " the\n"]))] == [v.encode("a  b"), [], v.encode(" the\n")]
    # the best sum of the library's own n-best lattice over a vocabulary's scores is checked by an exhaustive search
    for w in ("the", "there", "nation", "étés"):
        unit = spm.SPACE + w

        def best(at=0):
            return max((v.scores.get(unit[at:e], v.unknown if e == at + 1 else -1e18) + best(e) for e in range(at + 1, len(unit) + 1)), default=0.0)

        assert v.best(unit)[0] == best()
    assert SentencePieceProcessor(model_file=PIECES).get_piece_size() == len(v.pieces)


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame(ROWS, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "never seen in any document at all")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    counts = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), out.schema)
        counts.append(docs.count())
    assert counts[0] == sum(any(c.isalpha() for c in t or "") for _, t, *_ in ROWS) and counts[1] < counts[0] and counts[1] == counts[2] == counts[3]
    assert corpus_pipeline.run(spark, str(tmp_path)).where(F.col("n_tokens") >= 0).count() == counts[-1]
