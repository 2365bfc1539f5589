"""A worker holds few rows of an Arrow batch as Python objects, however large the batch is."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tidewater.llm import langid, neardup, packing, pii

TEXTS = [f"w{k} some words of row {k} " * 100 + ("a@b.org" if k % 3 == 0 else "") for k in range(6000)]  # 15 MB


@pytest.fixture()
def peak():
    """The most that Python and numpy held while a function ran."""
    def measure(run):
        tracemalloc.start()
        out = run()
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most, out

    return measure


def test_redacted_texts_leave_in_slices(peak, monkeypatch):
    few, model = pa.array([None, *TEXTS[:400], None]), pii.trained()
    got = [t for x in pii.redactions([few, few], model) for t in x.to_pylist()]
    assert got == 2 * [None if t is None else pii.redacted(t, model) for t in few.to_pylist()]
    assert list(pii.redactions([pa.array([], pa.string())], model)) == []
    monkeypatch.setattr(pii, "redacted", lambda text, model: text.upper())
    texts = pa.array([None, *TEXTS, None])
    most, sizes = peak(lambda: [len(x) for x in pii.redactions([texts], model)])
    assert sum(sizes) == len(texts) and most < 6e6, most


def test_texts_to_predict_are_read_one_by_one(peak, monkeypatch):
    weights = np.random.default_rng(1).normal(size=(langid.DIM, 3)).astype(np.float32)
    model = langid.LanguageModel(["de", "en", "fr"], np.ones(langid.DIM), weights, np.zeros(3), 1.0)
    few = [None, "", "12", *TEXTS[:50]]
    got = pa.concat_arrays(langid.predictions([pa.array(few), pa.array(few)], model)).to_pylist()
    assert [(g["lang"], g["score"]) for g in got] == 2 * [model.predict(t) for t in few]
    monkeypatch.setattr(model, "predict", lambda text: ("en", float(len(text))))
    most, _ = peak(lambda: list(langid.predictions([pa.array(TEXTS)], model)))
    assert most < 6e6, most


def test_sets_leave_in_slices(peak, monkeypatch):
    monkeypatch.setattr(neardup, "OUT_ELEMENTS", 1 << 14)
    keys = [neardup.set_key(neardup.shingles(t)[0], t) for t in TEXTS]
    keys[5] = "another"
    names = ["rep", "key", "text"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(TEXTS))), pa.array(keys), pa.array(TEXTS)], names)
    most, got = peak(lambda: [b.column(0).to_pylist() for b in neardup.formed_sets([batch])])
    assert len(got) > 1 and sum(got, []) == [k for k in range(len(TEXTS)) if k != 5]
    assert most < 6e6, most
    row = next(neardup.formed_sets([batch.slice(7, 1)])).to_pylist()[0]
    elements = (neardup.shingles(TEXTS[7])[0] >> np.uint64(32)).astype(np.uint32).view(np.int32)
    assert row == {"rep": 7, "n": len(elements), "elements": elements.tolist()}


def test_tokenizing_copies_no_whole_batch():
    tokenizer, texts = packing.tokenizer_at(packing.vocabulary_path()), pa.array([None, *TEXTS])
    before, pool = pa.default_memory_pool(), pa.proxy_memory_pool(pa.default_memory_pool())
    pa.set_memory_pool(pool)
    try:
        lengths = [len(x) for x in tokenizer.encode(texts)]
    finally:
        pa.set_memory_pool(before)
    assert len(lengths) == len(texts) and lengths[0] == 0
    assert pool.max_memory() < 12e6, pool.max_memory()
