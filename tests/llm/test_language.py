import random

import pytest

pytest.importorskip("worktally.llm.language")
from pyspark.sql import functions as F

from worktally.llm.language import fit_model, is_word, label_code, segment_languages, sentences, stretches

SCHEMA = "doc_id bigint, text string, lang string, label string, start int"
WORDS = {
    "en": "the road work was not finished before rain and water stands near school wall since last month".split(),
    "hi": "सड़क का काम बारिश से पहले पूरा नहीं हुआ और पानी स्कूल की दीवार के पास भरा रहता है".split(),
    "mr": "रस्त्याचे काम पावसापूर्वी पूर्ण झाले नाही आणि पाणी शाळेच्या भिंतीजवळ साचते असे गावकऱ्यांनी सांगितले".split(),
    "ta": "சாலை பணி மழைக்கு முன் முடியவில்லை தண்ணீர் பள்ளி சுவர் அருகே தேங்கி நிற்கிறது".split(),
}


def _sentence(rng, lang, n=9):
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n)) + ("।" if lang == "hi" else ".")


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(8)
    rows = []
    for i in range(400):
        lang = rng.choice(list(WORDS))
        label = rng.choice(list(WORDS)) if rng.random() < 0.08 else lang
        rows.append((i, " ".join(_sentence(rng, lang) for _ in range(4)), label, "clash", 0))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def model(docs):
    return fit_model(docs)


def test_wrong_labels_make_no_class(model):
    assert sorted(model.classes) == [("en", "Latn"), ("hi", "Deva"), ("mr", "Deva"), ("ta", "Taml")]


def test_held_out_texts(model):
    rng = random.Random(9)
    for _ in range(200):
        lang = rng.choice(list(WORDS))
        found = stretches(" ".join(_sentence(rng, lang) for _ in range(2)), model)
        assert [f[0] for f in found] == [lang] and found[0][1] > 0.9


def test_mixed_texts(model):
    rng = random.Random(10)
    right = 0
    for _ in range(100):
        a, b = rng.sample(list(WORDS), 2)
        found = stretches(f"{_sentence(rng, a)} {_sentence(rng, a)} | {_sentence(rng, b)}\n{_sentence(rng, b)}", model)
        right += [f[0] for f in found] == [a, b]
    assert right >= 97


def test_what_makes_no_stretch(model):
    assert stretches("12.5 | --- / ??? <pad><pad> a@b.c https://x.y ee316c9a6195", model) == []
    for noise in ("<|endoftext|>", "[INST]", "12345", "&nbsp;&nbsp;", "Nobipur"):
        assert len(stretches("सड़क का काम बारिश से पहले पूरा नहीं हुआ। " + noise, model)) == 1
    assert is_word("b1ock") and not is_word("a1b2c3") and not is_word("5")
    assert [w for _, _, ws in sentences("Ab cd. 12 ef") for w in ws] == ["ab", "cd", "ef"]


def test_labels(spark):
    labels = ["en", "EN", " eng ", "English", "hi-IN", "gu_IN", "Marathi", "fr", "?", "", "  ", None, "und", "xx", "n/a", "unknown"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(labels)], "i int, x string")
    got = [r[0] for r in df.orderBy("i").select(label_code(F.col("x"))).collect()]
    assert got == ["en", "en", "en", "en", "hi", "gu", "mr", "other"] + [None] * 8


def test_rows_of_a_table(spark, docs, model):
    long = "the road work was not finished. " * 5000
    rows = [(1, None, "en", "c", 0), (2, "", "en", "c", 0), (3, " \n", None, "c", 0), (4, "12", "en", "c", 0), (5, long, "hi", "c", 0), (5, long, "hi", "c", 0)]
    got = segment_languages(spark.createDataFrame(rows, SCHEMA), model).collect()
    assert [(r.doc_id, r.label, r.segment_no, r.lang, r.n_segments) for r in got] == [(5, "hi", 0, "en", 1)] * 2
    assert segment_languages(docs.limit(0)).count() == 0
    assert segment_languages(docs.withColumn("lang", F.lit("?"))).count() == 0
