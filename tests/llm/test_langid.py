import zlib

import numpy as np

from tidewater.llm import langid as L


def test_held_out_accuracy_and_score(spark):
    got = L.op3_langid(spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", "text")
    rows = got.join(truth, "doc_id").collect()
    assert len(rows) == got.count() == truth.count()
    out = [r for r in rows if r["held_out"] and r["lang"] and r["lang_pred"] != L.UNKNOWN]
    assert len(out) > 100 and np.mean([r["lang"] == r["lang_pred"] for r in out]) >= 0.97
    for r in rows:
        assert 0 <= r["score"] <= 1
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert (r["lang_pred"] == L.UNKNOWN) == (r["text"] is None or not any(c.isalpha() for c in r["text"]))


def test_edges(make_docs):
    learn = [(i, "the of and " * 9 if i % 2 else "der die und ß " * 9, "en" if i % 2 else "de", "s") for i in range(80)]
    rows = learn + [(901, None, "en", "s"), (902, "", "en", "s"), (903, "123 !!", "de", "s"), (None, "the of and", "xx", "s"),
                    (904, "the of and the", None, None), (904, "the of and the", None, None), (905, "der die und " * 20000, None, None)]
    got = L.identify(make_docs(rows)).collect()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert len(got) == len(rows)
    for k in (901, 902, 903):
        assert (by[k][0]["lang_pred"], by[k][0]["score"]) == (L.UNKNOWN, 0.0)
    assert by[904][0] == by[904][1] and by[904][0]["lang_pred"] == "en" and by[905][0]["lang_pred"] == "de"
    assert by[None][0]["held_out"] is False and "xx" not in {r["lang_pred"] for r in got}
    kept = L.keep_identified(make_docs(rows).selectExpr("*", "1 AS p", "2 AS doc"))
    assert kept.columns[-2:] == ["p", "doc"] and {901, 902, 903}.isdisjoint({r["doc_id"] for r in kept.collect()})
    assert L.identify(make_docs([])).count() == 0
    assert {r["lang_pred"] for r in L.identify(make_docs([(1, "some text", None, None)])).collect()} == {L.UNKNOWN}


def test_labels_of_held_out_rows_are_not_learned(make_docs):
    out = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2][:30]
    rows = [(i, "zz yy xx " * 5, "held", "s") for i in out] + [(1000 + k, "the of and " * 5, "en", "s") for k in range(40)]
    assert {r["lang_pred"] for r in L.identify(make_docs(rows)).collect()} <= {"en"}


def test_ngrams_against_a_plain_count():
    text = "Ab1é  b"
    line = " ab é b "
    grams = {}
    for n in (1, 2, 3):
        for i in range(len(line) - n + 1):
            grams[line[i:i + n]] = grams.get(line[i:i + n], 0) + 1
    at, count = L.ngram_counts(text)
    assert sorted(count.tolist()) == sorted(grams.values()) and len(at) == len(grams)


def test_temperature_lowers_log_loss():
    rng = np.random.default_rng(0)
    logits = rng.normal(size=(500, 3)) * 8
    labels = np.array([rng.choice(3, p=L._softmax(z / 4)) for z in logits])
    t = L.fit_temperature(logits, labels)
    assert 2.5 < t < 6.5


def test_ftrl_is_sparse_under_l1(monkeypatch):
    rng = np.random.default_rng(1)
    rows, labels = [], []
    for k in range(200):
        y = k % 2
        at = np.unique(np.r_[y, rng.integers(2, 300, 20)])
        rows.append((at, np.full(len(at), 1 / np.sqrt(len(at)))))
        labels.append(y)
    monkeypatch.setattr(L, "L1", 0.5)
    weights, bias = L.fit_ftrl(rows, np.array(labels), 2, 300)
    assert (weights == 0).mean() > 0.5 and weights[0, 0] > 0 > weights[0, 1]
