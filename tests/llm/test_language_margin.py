"""Texts that no learned language fits are rejected, also where words settle a tie of sizes."""

import random

from farsight.llm import language

STEMS = {
    "en": "the and of to in house that with were they this from have which water people through would there about",
    "de": "der die und das nicht haus ist mit sich auf eine werden durch wasser leute würde diese über haben wenn",
    "fr": "le la les des une maison est dans avec pour qui que nous vous leur eau gens cette serait entre même",
}
FINNISH = "talo on vanha ja vesi virtaa hiljaa kun ihmiset kulkevat metsän läpi kohti järveä eikä kukaan puhu mitään"


def sentences(lang, seed, n):
    rng = random.Random(f"{lang}{seed}")
    return " ".join(rng.choice(STEMS[lang].split()) for _ in range(n))


def test_margin(table, spark):
    rows = [(k, sentences(lang, k, 60), lang) for lang in STEMS for k in range(40)]
    learned = language.language_dictionaries(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    rng = random.Random(3)
    letters = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    gibberish = [" ".join(letters(rng.randint(2, 9)) for _ in range(60)) for _ in range(20)]
    clean = [(1000 + k, sentences(lang, 900 + k, 40)) for k, lang in enumerate(list(STEMS) * 10)]
    strange = [(k, text) for k, text in enumerate([*gibberish, FINNISH])]
    found = {r["doc_id"]: r for r in language.identify(table(clean + strange), learned).collect()}
    assert not any(found[i]["rejected"] for i, _ in clean)
    assert all(found[i]["lang_pred"] == list(STEMS)[(i - 1000) % 3] for i, _ in clean)
    assert sum(found[i]["rejected"] for i, _ in strange) >= 20 and found[20]["rejected"]


def test_margin_holds_for_ties(table):
    learned = {"aa": b" xyz " * 3, "bb": b" xyw " * 3}
    model = language.CompressionClassifier(learned)
    text = "abcdefghijklmnopqrs tuvwabcz xyz"
    ties = [t for t in (text, text + " qqq", "xyz " + "k" * 40, "m" * 9 + " nopqrstu xyz") if len(set(model.sizes(language.plain(t)))) == 1]
    ties = [t for t in ties if 0 < model.best(t)[1] <= language.MARGIN]
    assert ties
    found = language.identify(table(list(enumerate(ties))), learned).collect()
    assert all(r["rejected"] for r in found)
