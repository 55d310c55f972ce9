"""Language ID against a plain version, word by word and text by text."""
import random

import numpy as np
import pytest

from tidemark.llm import langid

MASK = (1 << 64) - 1
MULT = 0x9E3779B97F4A7C15


def plain_features(word):
    cp = [2, *map(ord, word), 3]
    out = []
    for i in range(len(cp)):
        h = 0
        for n in range(1, min(4, len(cp) - i) + 1):
            h = ((h * 0x100000001B3) & MASK) ^ (((cp[i + n - 1] + n) * MULT) & MASK)
            if n > 1 or cp[i] > 3:
                out.append((((h ^ (h >> 29)) * MULT) & MASK) >> 48)
    total = 0
    for pos, c in enumerate(cp):
        p = ((c + 7) * MULT) & MASK
        total += (p ^ (p >> 31)) * (2 * pos + 1)
    return [*out, ((total * MULT) & MASK) >> 48]


def plain_predict(text, model, penalty):
    words, now = [], ""
    for c in (text or "").lower() + " ":
        if c.isalpha():
            now += c
        elif now:
            words.append(now)
            now = ""
    if not words or not model["langs"]:
        return "und", 0.0
    k, logp = len(model["langs"]), model["logp"].astype(float)
    scores = []
    for w in words:
        s = np.array([sum(logp[f, j] for f in plain_features(w)) for j in range(k)]) / 2
        s = np.maximum(s - s.max() - np.log(np.exp(s - s.max()).sum()), langid.WORD_FLOOR)
        block = max(i for i, (first, _) in enumerate(langid.SCRIPTS) if first <= ord(w[0]))
        can = model["scripts"][langid._NAMES.index(langid.SCRIPTS[block][1])]
        scores.append(np.where(can, s, 2 * langid.WORD_FLOOR) if can.any() else np.zeros(k))
    best, back = [scores[0]], []
    for s in scores[1:]:
        last = best[-1]
        back.append([j if last[j] >= last.max() - penalty else int(last.argmax()) for j in range(k)])
        best.append(np.maximum(last, last.max() - penalty) + s)
    labels = [int(best[-1].argmax())]
    for b in reversed(back):
        labels.append(b[labels[-1]])
    labels.reverse()
    held = [sum(len(w) for w, s, x in zip(words, scores, labels) if x == j and s.any()) for j in range(k)]
    return model["langs"][int(np.argmax(held))], max(held) / sum(map(len, words))


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(1)
    pools = {"aa": ["the", "house", "Straße", "über"], "bb": ["maison", "où", "été", "le"], "cc": ["дом", "это", "the"], "dd": ["дім", "що", "це"]}
    rows = [(i, k, " ".join(rng.choice(pools[k]) + rng.choice(["", "s", "en"]) for _ in range(30))) for i, k in enumerate(list(pools) * 40)]
    return langid.fit(spark.createDataFrame(rows, "doc_id long, lang string, text string"))


def test_predictions_equal_the_plain_version(model):
    rng = random.Random(2)
    pool = ["the", "houses", "maison", "été", "дом", "дім", "це", "日本", "x", "Ünter", "ß", "İi"]
    texts = [None, "", "12 ½ ² ①② _", "① the", "½maison²été"] + [
        " ".join(rng.choice(pool) + rng.choice(["", "s", "½", "7", ","]) for _ in range(rng.randrange(0, 25))) for _ in range(250)]
    got = langid._predict(texts, model, langid.SWITCH_PENALTY)
    for text, (lang, score, spans) in zip(texts, got):
        want, share = plain_predict(text, model, langid.SWITCH_PENALTY)
        assert (lang, round(score, 9)) == (want, round(share, 9)), text
        assert bool(spans) == any(c.isalpha() for c in text or "")


def test_number_signs_are_no_letters(spark, model):
    docs = spark.createDataFrame([(1, "½ ²"), (2, "①②"), (3, "Ⅳ ㊀ 〇"), (4, "ª the")], "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(docs, model).collect()}
    assert got[1] == got[2] == ("und", 0.0) and got[4][0] != "und"
    assert (got[3][0] == "und") == (not any(c.isalpha() for c in "Ⅳ㊀〇"))
    kept = langid.keep_identified(docs, model, 0.0)
    assert 4 in {r.doc_id for r in kept.collect()} and not {1, 2} & {r.doc_id for r in kept.collect()}


def test_letters_are_those_of_unicode():
    import sys
    for c in map(chr, range(sys.maxunicode + 1)):
        assert langid.LETTERS.findall(langid.lowered(c) if c != "\u0130" else c) == ([c.lower()] if c.isalpha() and c != "\u0130" else [c] * c.isalpha())


def test_junk_labels_do_not_make_the_model_grow(spark, monkeypatch):
    monkeypatch.setattr(langid, "MOST_LANGS", 3)
    rows = [(i, "de" if i % 3 else "fr", "das Haus" if i % 3 else "la maison") for i in range(60)] + [(100 + i, f"junk{i:03d}", "zz qq") for i in range(50)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, lang string, text string"))
    assert model["langs"] == ["de", "fr", "junk000"] and model["logp"].shape[1] == 3
