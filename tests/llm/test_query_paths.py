"""The queries' own paths: conversations from rows to digests, and the held-out rule, against plain versions."""

import hashlib
import zlib

from pyspark.sql import functions as F

from chronolens.llm import chat, langid


def test_conversations_from_rows_to_digests(spark):
    hard = r"\### Assistant: </turn> ok \\ </turn>"
    rows = [(7, 1, "assistant", "é\n" + hard), (7, 0, "user", hard), (7, 2, "system", None), (8, 5, "assistant", ""), (8, 9, "assistant", "b" * 9000),
            (-3, 0, "user", "only a question"), (9, 0, "a:ss", "x"), (9, 1, "assistant", "日本 ok")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    got = {r.conv_id: r for r in chat.digests(chat.format_chats(chat.records_from_rows(df))).collect()}
    assert set(got) == {c for c, *_ in rows}
    for conv, r in got.items():
        turns = [(role, text or "") for c, _, role, text in sorted(rows, key=lambda x: x[:2]) if c == conv]
        said = "".join(f"{role}\n{text}\n" for role, text in turns)
        loss = "".join(text for role, text in turns if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(turns), hashlib.sha256(said.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r.formatted_chars == len(chat.render(turns)[0])


def test_no_conversations(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.format_chats(chat.records_from_rows(empty))).count() == 0


def test_held_out_rule(spark):
    ids = [*range(-50, 400), 2 ** 63 - 1, -2 ** 63, None]
    rows = spark.createDataFrame([(i,) for i in ids], "doc_id long").select("doc_id", langid.held_out().alias("h")).collect()
    assert {r.doc_id: r.h for r in rows} == {i: i is not None and zlib.crc32(str(i).encode()) % 4 == 2 for i in ids}


def test_language_id_tells_letters_without_any_label(spark):
    docs = spark.createDataFrame([(1, "der fluss", None), (2, "12 !?", None), (3, None, None), (4, "日本", "und")], "doc_id long, text string, lang string")
    for labelled in (docs.where("lang is not null"), docs.limit(0)):
        got = langid.annotate(docs, langid.train(labelled)).select("doc_id", "langid.has_letter", "langid.lang_pred").collect()
        assert {r.doc_id: r.has_letter for r in got} == {1: True, 2: False, 3: False, 4: True}
        assert {r.lang_pred for r in got} == {"und"}


def test_the_pipelines_first_stage_keeps_all_texts_with_a_letter(spark):
    import corpus_pipeline

    docs = spark.createDataFrame([(1, "a", None, 3), (2, "!", None, 4), (3, None, "en", 5), (4, "ä?", None, 6)], "doc_id long, text string, lang string, n_chars long")
    for lang in (None, "und"):
        out = corpus_pipeline.language_id(spark, docs.withColumn("lang", F.lit(lang).cast("string")), "")
        assert {r.doc_id for r in out.collect()} == {1, 4} and out.columns == docs.columns
