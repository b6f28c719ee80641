import random

from edge import frame, repeated
from pyspark.sql import functions as F

from dimforge.llm import langid

SYLLABLES = {"aa": "the ing tion ous and er", "bb": "que ment eau oi la ére", "cc": "sch ung keit zu ein öst"}


def corpus(n, seed):
    r = random.Random(seed)
    return [(i, " ".join(r.choice(SYLLABLES[lang].split()) + r.choice(SYLLABLES[lang].split()) for _ in range(r.randint(3, 40))), lang, "s", 1) for i in range(n) for lang in [r.choice(sorted(SYLLABLES))]]


def test_held_out_accuracy_and_the_inputs_of_a_prediction(spark):
    docs = frame(spark, corpus(600, 1)).cache()
    model = langid.train(docs.where(~langid.held_out(F.col("doc_id"))), seed_col="doc_id")
    assert model.langs == ["aa", "bb", "cc"]
    got = langid.predict(docs, model).join(docs.select("doc_id", "lang", langid.held_out(F.col("doc_id")).alias("out")), "doc_id").collect()
    out = [r for r in got if r.out]
    assert len(out) > 100 and sum(r.lang == r.lang_pred for r in out) >= 0.97 * len(out)
    assert all(0 <= r.score <= 1 for r in got)
    blind = docs.withColumns({"lang": F.lit(None).cast("string"), "source": F.lit("zz")})
    assert {r.doc_id: r.lang_pred for r in langid.predict(blind, model).collect()} == {r.doc_id: r.lang_pred for r in got}


def test_scores_match_a_plain_naive_bayes(monkeypatch):
    import numpy as np

    r = np.random.default_rng(1)
    model = langid.Model(["a", "b"], np.log(r.random((3 * langid.BUCKETS, 2))).astype(np.float32), np.log(np.array([0.3, 0.7])))
    texts = ["Hello wörld", None, "x", "ab " * 500, "Zz 9"]

    def plain(t):
        total = model.log_prior.copy()
        c = np.frombuffer(f" {t or ''} ".lower().encode("utf-32-le"), np.uint32)
        for order in langid.ORDERS:
            for i in range(len(c) - order + 1):
                total += model.log_prob[langid._buckets(c[i:i + order].copy(), order)[0]]
        return total

    for size in (1 << 20, 64):  # whole, and in pieces
        monkeypatch.setattr(langid, "_CHARS_AT_ONCE", size)
        best, prob = langid.score(model, texts)
        for t, k, p in zip(texts, best, prob):
            want = plain(t)
            assert k == want.argmax() and abs(p - 1 / np.exp(want - want.max()).sum()) < 1e-6


def test_undetermined_texts_repeats_and_empty_tables(spark):
    docs = frame(spark, repeated())
    model = langid.train(docs.where("lang IS NOT NULL"))
    got = langid.predict(docs, model).collect()
    assert len(got) == len(repeated())
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (102, 103, 104, 105))
    assert by_id[108].lang_pred in model.langs
    kept = {r.doc_id for r in langid.identified(docs, model).collect()}
    assert not kept & {102, 103, 104, 105} and 108 in kept and langid.identified(docs, model).columns == docs.columns
    nothing = frame(spark, [])
    empty = langid.train(nothing)
    assert empty.langs == [] and langid.predict(nothing, empty).count() == 0
    assert {r.lang_pred for r in langid.predict(docs, empty).collect()} == {"und"}
    sampled = langid.train(docs, max_rows=10)
    assert sampled.langs == ["de", "en"]


def test_lettered_documents_stay_when_no_language_can_be_learned(spark):
    unlabelled = frame(spark, [(*d[:2], None, *d[3:]) for d in repeated()])
    model = langid.train(unlabelled)
    kept = [r.text for r in langid.identified(unlabelled, model).collect()]
    assert model.langs == [] and kept and sorted(kept) == sorted(d[1] for d in repeated() if d[1] and any(map(str.isalpha, d[1])))
