"""Language identification: held-out accuracy, and vectors against a slow bundle."""

from __future__ import annotations

import zlib

import numpy as np

from sparge.llm import langid
from sparge.llm.queries import op7_language_id


def test_held_out_accuracy(spark, folder):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = op7_language_id(spark, folder).collect()
    assert sorted(r.doc_id for r in got) == sorted(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 and r.lang_pred in {*lang.values(), "und"} for r in got)
    mine = [r for r in got if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in mine) >= 0.97 * len(mine)


def test_bundle_is_the_sum_of_bound_ngrams():
    profiles = langid.Profiles(dimensions=64)
    want = np.zeros(64)
    line = " ab éc "
    for i in range(len(line) - 2):
        gram = np.ones(64)
        for j, c in enumerate(reversed(line[i : i + 3])):
            gram = gram * np.roll(profiles.letter(ord(c)), j)
        want += gram
    assert np.allclose(profiles.bundle(["Ab, 12 Éc!", None, "7"]), [want, 0 * want, 0 * want])


def test_memory_bounds_change_nothing(monkeypatch):
    texts = ["the quick brown fox jumps", "über den zaun, und weiter", "日本語のテキスト"] * 20
    plain = langid.Profiles(dimensions=32).bundle(texts)
    monkeypatch.setattr(langid, "KEPT_NGRAMS", 7)
    assert np.allclose(langid.Profiles(dimensions=32).bundle(texts), plain)


def test_edges(spark):
    columns = "doc_id long, text string, lang string, label string, score int, c1 int"
    rows = [(1, "the cat and the hat", "en"), (2, "der hund und die katze", "de"), (3, None, "en"), (4, "12 34", None),
            (None, "the dog", None), (7, "und der und die", None), (7, "und der und die", None)]
    docs = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], columns)
    prototypes = langid.train(docs)
    assert set(prototypes) == {"en", "de"}
    found = [tuple(r) for r in langid.identify(docs).collect()]
    assert len(found) == 7 and {r[2] for r in found if r[0] in (3, 4)} == {"und"}
    left = langid.keep_known(docs, prototypes)
    assert left.columns == docs.columns and left.count() == 5
    assert langid.identify(docs.limit(0)).count() == 0
    assert {r.lang_pred for r in langid.identify(docs.withColumn("lang", docs.lang.substr(9, 1)).filter("doc_id is null")).collect()} == {"und"}


def test_tables_without_labels_are_kept(spark):
    """Nothing learned: texts with a letter stay, the same ones as with labels."""
    texts = ["the cat and the hat", "日本語", "é", None, "", "12 34", "_ !?", "7a"]
    docs = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    assert langid.train(docs) == {}
    left = langid.keep_known(docs, {})
    assert left.columns == docs.columns
    kept = sorted(r.doc_id for r in left.collect())
    assert kept == [0, 1, 2, 7]
    learned = langid.train(docs.withColumn("lang", docs.text.substr(1, 1)))
    assert kept == sorted(r.doc_id for r in langid.keep_known(docs, learned).collect())
    assert langid.keep_known(docs.limit(0), {}).count() == 0


def test_numerals_are_no_letters(spark):
    texts = {1: "½ ²³", 2: "① Ⅷ ٣", 3: "½ a", 4: "the cat and the hat"}
    docs = spark.createDataFrame([(i, t, "en") for i, t in texts.items()], "doc_id long, text string, lang string")
    found = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(docs, langid.train(docs), "text").select("doc_id", "lang_pred", langid.F.col("lang_score").alias("score")).collect()}
    assert found[1] == found[2] == ("und", 0.0) and found[3][0] == found[4][0] == "en"
    assert sorted(r.doc_id for r in langid.keep_known(docs, langid.train(docs)).collect()) == [3, 4]
    profiles = langid.Profiles(dimensions=32)
    assert np.allclose(profiles.bundle(["a½b ① c"]), profiles.bundle(["a b c"]))


def test_blocks_of_a_long_text_change_nothing(monkeypatch):
    texts = ["the quick brown fox, jumps 12 over", "über den zaun ½ und weiter", "日本語のテキスト", "", "a"]
    plain = langid.Profiles(dimensions=32).bundle(texts)
    for size in (1, 2, 5, 7):
        monkeypatch.setattr(langid, "BLOCK_CHARS", size)
        assert np.allclose(langid.Profiles(dimensions=32).bundle(texts), plain)
