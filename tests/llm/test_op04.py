import random

import numpy as np

from obsmatch.llm import op04_language as op

SCHEMA = "doc_id bigint, text string, lang string, score int"
SOUNDS = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["schr", "ung", "öst", "ein"], "cc": ["тро", "ска", "ние", "по"]}


def corpus(n=240):
    rng = random.Random(3)
    out = []
    for k in range(n):
        lang = list(SOUNDS)[k % 3]
        text = " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(2, 40)))
        out.append((k, text, lang, 7))
    return out


def test_held_out_accuracy_and_odd_texts(llm):
    data = corpus()
    odd = [(1000, None, "aa", 1), (1001, "", "aa", 1), (1002, "123 !!", "bb", 1), (1003, "KA LO mitu", None, 1), (None, "kalo mi", "aa", 1), (1004, "ska " * 30_000 + "тро" * 100_000, None, 1)]
    docs = llm.createDataFrame(data + odd + data[:3], SCHEMA)
    got = op.language_query(docs).collect()
    assert len(got) == len(data) + len(odd) + 3
    by = {r["doc_id"]: r for r in got}
    wrong = [k for k, _, lang, _ in data if by[k]["lang_pred"] != lang]
    assert len(wrong) <= 2
    assert all(by[k]["lang_pred"] == "und" and by[k]["score"] == 0 for k in (1000, 1001, 1002))
    assert by[1003]["lang_pred"] == "aa" and by[1004]["lang_pred"] == "cc"
    assert all(0 <= r["score"] <= 1 for r in got)
    assert sum(r["held_out"] for r in got) > 60 and not by[None]["held_out"]


def test_scores_are_the_kernel_regression():
    """Folded weights equal explicit kernels with the landmarks."""
    texts, labels = zip(*[(t, lang) for _, t, lang, _ in corpus(60)])
    model = op.fit(list(texts), list(labels), landmarks=30)
    data, offsets = op.text_buffers(op.pa.array(texts))
    present = [set(p.tolist()) for p in op.grams(data, offsets)]
    assert present[0] == set(np.concatenate([op._present(op._FOLD[np.frombuffer(texts[0].encode(), np.uint8)])]).tolist())
    explicit = np.array([[sum(model.weights[list(p), c]) / np.sqrt(len(p)) for c in range(3)] for p in present])
    assert np.allclose(op.score(data, offsets, model), explicit)


def test_nothing_to_learn(llm):
    docs = llm.createDataFrame([(1, "text", None, 1)], SCHEMA)
    assert op.language_query(docs).collect()[0]["lang_pred"] == "und"
    assert op.language_query(llm.createDataFrame([], SCHEMA)).collect() == []


def varied(lang, size, seed):
    """Text of about ``size`` bytes whose words hardly repeat: syllables of ``lang`` between random letters."""
    rng = random.Random(seed)
    words = []
    while size > 0:
        word = "".join(rng.choice(MIXED[lang]) if rng.random() < 0.5 else chr(rng.randint(97, 122)) for _ in range(rng.randint(2, 7)))
        words.append(word)
        size -= len(word.encode()) + 1
    return " ".join(words)


MIXED = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["schr", "ung", "tz", "ein"], "cc": ["qua", "ous", "ize", "ght"], "dd": ["eau", "oix", "que", "ais"]}


def test_long_varied_texts_are_told_apart():
    """Every language's row of a whole text of some MB is nearly full; the slices' rows are not."""
    data = [(varied(lang, 2_500, 100 * k + j), lang) for j in range(30) for k, lang in enumerate(MIXED)]
    model = op.fit([t for t, _ in data], [lang for _, lang in data], landmarks=60)
    for size in (10_000, 1_000_000, 4_000_000):
        texts = [varied(lang, size, 7 + k) for k, lang in enumerate(MIXED)]
        outputs = op.score(*op.text_buffers(op.pa.array(texts)), model)
        assert [model.languages[b] for b in outputs.argmax(axis=1)] == list(MIXED), size
    # Half of a text in one language and the end in another: what comes last counts as well.
    mixed = varied("aa", 300_000, 1) + " " + varied("bb", 900_000, 2)
    assert model.languages[op.score(*op.text_buffers(op.pa.array([mixed])), model)[0].argmax()] == "bb"


def test_slices_hold_every_gram():
    text = np.frombuffer(varied("aa", 35_000, 5).encode(), np.uint8)
    whole = op._present(op._FOLD[text])
    parts = list(op.grams(text, np.array([0, len(text)])))
    assert len(parts) == 4 and np.array_equal(np.unique(np.concatenate(parts)), whole)


def test_every_label_is_learned(llm):
    """120 languages with syllables of their own, the rarest last."""
    rng = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyz"
    data = []
    for c in range(120):
        sounds = ["".join(rng.choice(letters) for _ in range(4)) for _ in range(5)]
        for j in range(12 if c < 100 else 9):
            data.append((len(data), " ".join(rng.choice(sounds) for _ in range(30)), f"l{c:03}", 1))
    docs = llm.createDataFrame(data, SCHEMA)
    model = op.learn(docs)
    assert len(model.languages) == 120
    got = {r["doc_id"]: r["lang_pred"] for r in op.identify(docs, model).collect()}
    assert all(got[k] == lang for k, _, lang, _ in data)


def test_spark_sums_are_those_of_one_fit_and_repeated_ids_count_once(llm, monkeypatch):
    data = corpus(60)
    ids = [k for k, _, lang, _ in data if lang == "aa"]
    docs = llm.createDataFrame([*data, *[data[ids[j]] for j in range(len(ids)) for _ in range(50)]], SCHEMA).repartition(5)
    used = llm.createDataFrame(data, SCHEMA).where(~op.held_out()).collect()
    one = op.fit([r["text"] for r in used], [r["lang"] for r in used])
    model = op.learn(docs, per_language=60)  # 60 rows would be two texts
    assert model.languages == one.languages and np.allclose(model.weights, one.weights, atol=1e-4)
    monkeypatch.setattr(op, "LANGUAGE_BYTES", 1)
    assert op.learn(docs).languages == one.languages
