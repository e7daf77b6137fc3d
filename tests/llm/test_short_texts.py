"""What language is told by, and what is learned, when texts are short or empty."""

import pytest

from pagesieve.llm import language

WORDS = {"en": "the light and house with river from over that this", "de": "das licht und haus mit fluss von nach dass diese"}


@pytest.fixture(scope="module")
def dictionaries():
    return {name: b" " + " ".join(" ".join(words.split()[at:] + words.split()[:at]) for at in range(10)).encode() + b" " for name, words in WORDS.items()}


def test_a_few_words_have_a_language(dictionaries):
    packer = language.Packer(dictionaries)
    for lang, texts in {"en": ("House with river.", "River, house", "that light"), "de": ("Haus mit Fluss.", "Haus, Licht")}.items():
        for text in texts:
            sizes = packer.sizes(language.letters_of(text.encode()))
            name, score, margin, rejected = packer.judge(text.encode())
            assert (name, rejected) == (lang, False) and margin > 0 and score > 0, (text, sizes)


def test_too_short_texts_stay(spark, dictionaries):
    texts = ["House with river.", "Re.", "The.", "A", None, "", "12", "漢字漢字仮名交文章例"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {row.doc_id for row in language.keep_identified(docs, dictionaries).collect()} == {0, 1, 2, 3}
    assert language.keep_identified(docs, {}).count() == 0


def test_texts_without_letters_are_not_drawn(spark):
    rows = [(at, text, "en") for at in range(0, 3000, 3) for text in (None, "12 34", "  ")]
    rows = [(at, text, lang) for at, (_, text, lang) in enumerate(rows)]
    rows += [(5000 + at, "the light of the house", "en") for at in range(20)] + [(6000 + at, "das licht im haus", "de") for at in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = language.learn_dictionaries(docs)
    assert list(learned) == ["de", "en"]
    assert learned["en"].count(b" the light of the house ") == 20 and learned["de"].count(b" das licht im haus ") == 30
