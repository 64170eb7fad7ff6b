import math
from collections import Counter

from ledgerloom.llm import langid
from ledgerloom.llm.ngrams import codes, pieces

SAID = {
    "en": "the cat and the dog were with that other thing which they had there",
    "de": "der hund und die katze waren nicht mit dem anderen ding welches sie dort hatten",
    "fr": "le chien et la chatte étaient avec cette autre chose que nous avions là",
}


def corpus(docs, n=30):
    rows = []
    for k, (lang, text) in enumerate(SAID.items()):
        words = text.split()
        rows += [(1000 * k + i, " ".join(words[(i * j + j) % len(words)] for j in range(3, 12)), lang) for i in range(n)]
    return docs(*rows)


def test_codes_meet_every_ngram_once():
    texts = ["abcabc", "", "x", "Äbc" * 50]
    for chars in (7, 1 << 20):
        parts = list(pieces(texts, 2, chars))
        assert sum(s for part in parts for _, _, s in part) == sum(map(len, texts))
    got = [Counter() for _ in texts]
    for numbers, begins, found in codes(texts, (1, 3), 16):
        for number, a, b in zip(numbers, begins, [*begins[1:], len(found)], strict=True):
            got[number].update(x for x in found[a:b].tolist() if x < 1 << 16)
    assert [sum(c.values()) for c in got] == [2 * len(t) - 2 if len(t) >= 3 else len(t) for t in texts]


def test_totals_agree_with_brute_force(docs):
    model = langid.fit(corpus(docs))
    for text in ("the dog", "le", "ü", "der hund " * 40):
        brute = [0.0] * 3
        for _, _, found in codes([text], langid.ORDERS, langid.BITS):
            for x in found.tolist():
                for k in range(3):
                    brute[k] += float(model.log_p[x, k])
        got = langid.totals(["zz", text], model.log_p)[1]
        assert all(math.isclose(a, b, rel_tol=1e-6) for a, b in zip(got, brute, strict=True))


def test_long_text_in_pieces_scores_as_in_one(docs, monkeypatch):
    model = langid.fit(corpus(docs))
    text = " ".join(SAID.values()) * 30
    whole = langid.totals([text], model.log_p)
    import ledgerloom.llm.ngrams as ngrams

    monkeypatch.setattr(ngrams, "PASS_CHARS", 101)
    monkeypatch.setattr(ngrams.pieces, "__defaults__", (101,))
    assert abs(langid.totals([text], model.log_p) - whole).max() < 1e-3


def test_held_out_languages_are_told(docs):
    rows = corpus(docs, 60)
    model = langid.fit(rows.filter("doc_id % 5 <> 0"))
    told = langid.identify(rows.filter("doc_id % 5 = 0"), model).collect()
    assert sum(r.lang == r.lang_pred for r in told) >= 0.95 * len(told)
    assert all(0 <= r.score <= 1 for r in told)


def test_odd_rows(odd, docs):
    model = langid.fit(corpus(docs))
    told = langid.identify(odd, model).collect()
    assert len(told) == odd.count()
    for r in told:
        if r.text is None or not any(c.isalpha() for c in r.text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in SAID
    kept = langid.reject(odd, model)
    assert kept.columns == odd.columns and kept.count() == sum(r.lang_pred != "und" and r.score >= 0.5 for r in told)
    assert langid.identify(odd.limit(0), model).collect() == []


def test_nothing_to_learn_from(odd):
    model = langid.fit(odd.limit(0))
    assert {(r.lang_pred, r.score) for r in langid.identify(odd, model).collect()} == {("und", 0.0)}


def test_of_very_many_languages_the_most_frequent_are_learned(spark, docs, monkeypatch):
    monkeypatch.setattr(langid, "LANGUAGES", 3)
    rows = [(k, f"word{k} text", f"l{k}") for k in range(10_000)] + [(20_000 + k, "the and of with", "en") for k in range(9)]
    rows += [(30_000 + k, "der die das und", "de") for k in range(9)]
    model = langid.fit(docs(*rows), key=["doc_id"])
    assert len(model.languages) == 3 and {"en", "de"} <= set(model.languages)
    told = langid.identify(docs((1, "the and of"), (2, "und die das")), model).collect()
    assert [r.lang_pred for r in told] == ["en", "de"]


def test_rows_that_repeat_id_and_text_are_cut_to_the_bound(spark, docs):
    model = langid.fit(docs(*[(1, "the same text", "en")] * 5000, *[(k, f"der text {k}", "de") for k in range(2, 30)]), per_language=50, key=["doc_id"])
    assert set(model.languages) <= {"de", "en"} and "de" in model.languages
