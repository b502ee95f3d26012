import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from sheaf.llm import langid
from sheaf.llm.queries import held_out

SOUNDS = {"aa": "the and of ing er th sh", "bb": "der die und ung sch ich keit", "cc": "el los que ción ado mente"}


def say(rng, language, n=40):
    sounds = SOUNDS[language].split()
    return " ".join("".join(rng.choice(sounds) for _ in range(rng.randint(1, 3))) for _ in range(n))


def sample(seed, n=150):
    rng = random.Random(seed)
    return [(i, say(rng, language, rng.randint(5, 60)), language) for i in range(n) for language in [rng.choice(sorted(SOUNDS))]]


@pytest.fixture
def model(docs):
    return langid.fit(docs(sample(1) + [(1000, None, "aa"), (1001, "text", None), (1002, "123", "bb")], ", lang string"))


def test_held_out_texts_are_told_apart(docs, model):
    rows = sample(2)
    found = langid.identify(docs(rows, ", score string").select("doc_id", "text", "score"), model).collect()
    assert sum(r.lang_pred == rows[r.doc_id][2] for r in found) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 and not r.rejected for r in found)


def test_texts_without_letters_and_foreign_ones(docs, model):
    rows = [(1, None), (2, ""), (3, "12 34 !!\n"), (4, "ждбцщ " * 50), (5, say(random.Random(3), "aa", 20_000))]
    found = {r.doc_id: r for r in langid.identify(docs(rows), model).collect()}
    assert [found[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and all(found[i].score == 0 and found[i].rejected for i in (1, 2, 3))
    assert found[4].rejected and found[4].lang_pred in SOUNDS
    assert found[5].lang_pred == "aa" and not found[5].rejected
    kept = langid.identified_only(docs([(i, t, "x") for i, t in rows], ", rejected string"), model)
    assert [tuple(r) for r in kept.collect()] == [(5, rows[4][1], "x")]


def test_the_model_depends_on_rows_only(docs, model):
    again = langid.fit(docs(sample(1)[::-1] + [(1000, None, "aa"), (1001, "text", None), (1002, "123", "bb")], ", lang string", 8))
    assert again.languages == model.languages and np.array_equal(again.idf, model.idf)
    assert np.allclose(np.sort(again.least), np.sort(model.least), atol=0.2)


def test_frequencies_count_all_texts(docs):
    rows = sample(4, 300)
    model = langid.fit(docs(rows, ", lang string"), sample=20)
    found = np.zeros(langid.DIMENSIONS)
    for _, text, _ in rows:
        found += langid.gram_counts(text) > 0
    assert np.allclose(model.idf, np.log((1 + len(rows)) / (1 + found)) + 1)


def test_grams_are_counted_by_definition():
    counts = langid.gram_counts("Ab,  b")
    # " ab b ": 6 single characters, 5 pairs, 4 triples
    assert counts.sum() == 15
    assert np.array_equal(counts, langid.gram_counts("aB 1 b!"))


def test_nothing_to_learn_from(docs):
    model = langid.fit(docs([], ", lang string"))
    assert [(r.lang_pred, r.score, r.rejected) for r in langid.identify(docs([(1, "text")]), model).collect()] == [("und", 0.0, True)]
    assert langid.identify(docs([]), model).count() == 0


def test_held_out_is_a_fifth(docs):
    import zlib

    found = docs([(i, "") for i in range(200)] + [(None, "")]).select("doc_id", held_out().alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found if r.doc_id is not None)


def plain_grams(text, n_most=3):
    """The n-grams of a text by their definition, counted in a dictionary."""
    codes = " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split(" ")) + " "
    while "  " in codes:
        codes = codes.replace("  ", " ")
    return Counter(codes[i : i + n] for n in range(1, n_most + 1) for i in range(len(codes) - n + 1))


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 50])
def test_grams_counted_in_pieces(monkeypatch, piece):
    texts = ["Ab,  b", "", "  .. a", "x", "?", "one  two\n\nthree" * 5, "ÄÖ 12 \U0001f600 é" * 7, "   a   b   "]
    whole = [langid.gram_counts(t) for t in texts]
    for text, counts in zip(texts, whole):
        assert (0 if counts is None else counts.sum()) == (sum(plain_grams(text).values()) if any(map(str.isalpha, text)) else 0)
    monkeypatch.setattr(langid, "PIECE", piece)
    for text, expected in zip(texts, whole):
        found = langid.gram_counts(text)
        assert (found is None) == (expected is None) and (found is None or np.array_equal(found, expected))


def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_against_a_plain_nearest_centroid_over_exact_grams(spark):
    """A plain model, dictionaries of exact n-grams and the mean of each language, predicts the same languages."""
    rows = documents(spark).where("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", "lang", held_out().alias("held"))
    found = {r.doc_id: r.lang_pred for r in langid.identify(rows, langid.fit(rows.where("NOT held"))).collect()}
    rows = [r for r in rows.collect() if any(map(str.isalpha, r.text))]
    train = [(plain_grams(r.text), r.lang) for r in rows if not r.held]
    seen = Counter(g for grams, _ in train for g in grams)

    def unit(grams):
        weighted = {g: math.log1p(n) * (math.log((1 + len(train)) / (1 + seen[g])) + 1) for g, n in grams.items()}
        norm = math.sqrt(sum(w * w for w in weighted.values()))
        return {g: w / norm for g, w in weighted.items()}

    centres = defaultdict(Counter)
    for grams, language in train:
        centres[language].update(unit(grams))
    norms = {language: math.sqrt(sum(w * w for w in c.values())) for language, c in centres.items()}
    held = [r for r in rows if r.held]
    same = right = 0
    for r in held:
        u = unit(plain_grams(r.text))
        best = max(sorted(centres), key=lambda x: sum(w * centres[x].get(g, 0.0) for g, w in u.items()) / norms[x])
        same += best == found[r.doc_id]
        right += r.lang == found[r.doc_id]
    assert len(held) > 100 and same / len(held) > 0.98 and right / len(held) > 0.98


def test_other_languages_of_the_same_letters_are_rejected(spark, docs):
    rows = documents(spark).select("doc_id", "text", "lang", held_out().alias("held"))
    model = langid.fit(rows.where("NOT held"))
    held = langid.identify(rows.where("held AND lang IS NOT NULL AND text IS NOT NULL"), model)
    kept, n = held.where("NOT rejected").count(), held.count()
    assert kept >= 0.99 * n
    others = [
        "La casa di mio nonno si trova vicino al fiume e ogni estate andiamo a trovarlo con tutta la famiglia. Il mercato apre"
        " presto la mattina, quando i pescatori tornano dal mare con le loro barche colorate.",
        "Dom mojego dziadka stoi blisko rzeki i każdego lata odwiedzamy go z całą rodziną. Targ otwiera się wcześnie rano,"
        " kiedy rybacy wracają z morza swoimi kolorowymi łodziami.",
        "Isoisäni talo on lähellä jokea ja joka kesä käymme siellä koko perheen kanssa. Tori avataan aikaisin aamulla, kun"
        " kalastajat palaavat mereltä värikkäillä veneillään.",
    ]
    found = langid.identify(docs([(i, text, "x") for i, text in enumerate(others)], ", lang_pred string"), model)
    assert found.where("rejected").count() == 3 and found.columns.count("lang_pred") == 1


def test_ties_between_centroids_and_repeated_rows(docs):
    model = langid.LanguageModel(
        np.ones(langid.DIMENSIONS), np.tile(langid.vector(langid.gram_counts("abc abc"), np.ones(langid.DIMENSIONS)), (2, 1)), ("a", "b"), np.zeros(2)
    )
    found = langid.identify(docs([(1, "abc abc")] * 3), model).collect()
    assert [(r.lang_pred, round(r.score, 5), r.rejected) for r in found] == [("a", 1.0, False)] * 3
