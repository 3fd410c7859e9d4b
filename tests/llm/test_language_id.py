import random
import zlib

import pytest
from helpers import clash, documents, odd_rows

from shelfwatch.llm import language_id as L

PARTS = {"en": ["th", "e", "and", "ing", "er", "st"], "de": ["sch", "ung", "ei", "ü", "nd", "er"], "fr": ["eau", "é", "que", "ou", "ère", "tion"]}


def text(lang, seed, words):
    rng = random.Random(f"{lang}{seed}")
    return " ".join("".join(rng.choices(PARTS[lang], k=rng.randint(1, 3))) for _ in range(words)) + "."


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, text(lang, i, 3 + i % 90), lang, "a") for i, lang in enumerate(["en", "de", "fr"] * 150)]
    return documents(spark, [*rows, (9000, text("en", 1, 9), None, "a")])


def test_held_out_accuracy(spark, docs):
    held = L.fold("doc_id", 3) == 1
    model = L.learn(docs.where(~held))
    assert set(model.languages) == {"en", "de", "fr"}
    out = L.predict(clash(docs, "lang_pred", "score", "h"), model).where(held).where("lang is not null").collect()
    assert len(out) > 100 and sum(r["lang_pred"] == r["lang"] for r in out) >= 0.98 * len(out)
    assert all(0 <= r["score"] <= 1 for r in out)


def test_fold_is_the_checksum_of_the_id_as_text(spark):
    rows = spark.createDataFrame([(i,) for i in (-3, 0, 7, 123456789012)], "doc_id long")
    assert [r[0] for r in rows.select(L.fold("doc_id", 3)).collect()] == [zlib.crc32(str(i).encode()) % 3 for i in (-3, 0, 7, 123456789012)]


def test_narrow_margins_are_rejected():
    one = L.Classifier(L.Model(("a", "b"), (b"same text " * 200, b"same text " * 200)))
    lang, score, lead = one.predict("same text again")
    assert lang == "a" and score == 0.5 and lead < L.NARROW


def test_model_does_not_depend_on_order(docs):
    assert L.learn(docs) == L.learn(docs.orderBy("text").repartition(3))
    model = L.learn(docs.union(docs))
    assert model.dictionaries == L.learn(docs).dictionaries


def test_odd_rows(spark, docs):
    model = L.learn(docs)
    odd = documents(spark, [*odd_rows(), (30, "123 !?", "en", "a"), (31, "é", "fr", "a")])
    out = {r["doc_id"]: r for r in L.predict(odd, model).collect()}
    assert all(out[i]["lang_pred"] == "und" and out[i]["score"] == 0 for i in (1, 2, 3, 30))
    assert out[31]["lang_pred"] in model.languages and out[5]["lang_pred"] == out[6]["lang_pred"]
    assert L.predict(odd.limit(0), model).count() == 0
    nothing = L.learn(docs.limit(0))
    assert {r["lang_pred"] for r in L.predict(odd, nothing).collect()} == {"und"}
    single = L.learn(docs.where("lang = 'de'"))
    assert {r["lang_pred"] for r in L.predict(odd, single).collect()} == {"de", "und"}
