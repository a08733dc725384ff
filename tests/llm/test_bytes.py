"""Words that a polynomial hash modulo 2**64 cannot tell apart: a Thue-Morse word and its complement."""

from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from chronolens.llm import decontam, lm, spm, token_output
from chronolens.llm.common import short_keys, word_hashes

WORD = "".join("ab"[bin(i).count("1") & 1] for i in range(1 << 11))
OTHER = WORD.translate(str.maketrans("ab", "ba"))
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(1, f"one {WORD} end"), (2, f"one {OTHER} end"), (3, WORD)], SCHEMA).coalesce(1)


def test_token_ids(spark, docs):
    from tokenizers import Tokenizer
    import zlib

    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    folder = token_output.new_folder(spark)
    token_output.write_blocks(docs, folder, path)
    got = {r.doc_id: r.ids_crc32 for r in token_output.digest(spark, folder).collect()}
    for r in docs.collect():
        ids = tok.encode(r.text, add_special_tokens=False).ids + [2]
        assert got[r.doc_id] == zlib.crc32(np.array(ids, "<u4").tobytes())


def test_a_tokenizer_with_another_split_is_refused():
    for name in ("byte_bpe_50k.json",):
        with pytest.raises(ValueError):
            token_output._load(public_tokenizers.path(name))
    token_output._load(public_tokenizers.path("word_bpe_49k.json"))


def test_pieces_decode_to_their_own_text(docs):
    path = public_tokenizers.path("piece_bpe_32k.model")
    got = {r.doc_id: r.decoded for r in spm.decode(spm.encode(docs, path), path).collect()}
    assert got == {r.doc_id: r.text for r in docs.collect()}


def test_counts_of_the_language_model(docs):
    rows = docs.collect()
    count = Counter(w for r in rows if not lm.is_held_out(r.doc_id) for w in [*r.text.split(), None])
    n, v = sum(count.values()), len(count)
    texts = {r.doc_id: r.text for r in rows}
    for r in lm.score_documents(docs).collect():
        base = sum(np.log10((count[w] + 1) / (n + v + 1)) for w in [*texts[r.doc_id].split(), None])
        assert abs(r.base_score - base) < 1e-9


def test_benchmark_items(spark, docs):
    item = f"{WORD} {OTHER} {WORD} {WORD} {OTHER} {OTHER} {WORD}"
    bench = spark.createDataFrame([(9, item)], "item_id long, text string")
    found = decontam.contaminated(docs.unionByName(spark.createDataFrame([(4, "so " + item)], SCHEMA)), bench).collect()
    assert [(r.doc_id, r.item_id, r.containment) for r in found] == [(4, 9, 1.0)]


def test_hashes_of_short_and_long_words():
    words = [b"a", b"a\0", b"", b"ab", b"ba", b"1234567", b"12345678", WORD.encode(), OTHER.encode()]
    raw = np.frombuffer(b"|".join(words), np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = ends - [len(w) for w in words]
    assert len(set(word_hashes(raw, starts, ends).tolist())) == len(words)
    short = ends - starts <= 7
    assert len(set(short_keys(raw, starts[short], ends[short]).tolist())) == short.sum()
