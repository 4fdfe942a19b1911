"""Language ID, toxicity and language-model scores: held-out quality and awkward rows."""

from __future__ import annotations

import glob
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from texts_data import SCHEMA, awkward, prose, rows_of, words
from tokenizers import Tokenizer

from cashcycle.llm import attention, scoring, toxicity
from cashcycle.llm.langid import LanguageOptions, _shared, dictionaries, identify, keep_identified
from cashcycle.llm.scratch import Scratch

PATH = public_tokenizers.path("word_bpe_49k.json")


def languages() -> list[tuple]:
    syllables = {"aa": "ka ti mo re su la".split(), "bb": "sch ung ver ein ge ch".split(), "cc": "qu eau ion ent ou é".split()}
    rows, draw = [], random.Random(4)
    for k in range(240):
        lang = sorted(syllables)[k % 3]
        text = " ".join("".join(draw.choices(syllables[lang], k=draw.randint(1, 3))) for _ in range(draw.randint(3, 80)))
        rows.append((k, text, lang, "s", len(text)))
    return rows + [(900, None, "aa", "s", None), (901, "", None, "s", 0), (902, "12 !?", "bb", "s", 5), (903, "KATI MOSU", None, "s", 9)]


def test_letters_late_in_a_text_teach_the_language(spark):
    rows = [(k, "0123456789 " * 400 + t if lang == "aa" else t, lang, "s", 0) for k, t, lang, _, _ in languages()[:240] if t]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = {r.doc_id: r.lang_pred for r in identify(docs, docs.filter("doc_id % 4 <> 2")).collect()}
    assert np.mean([found[r[0]] == r[2] for r in rows if r[0] % 4 == 2]) > 0.95


def test_dictionaries_take_all_sampled_documents_and_whole_texts(spark):
    texts = [" ".join(f"w{chr(97 + k)}{chr(97 + j % 26)}" * 3 for j in range(3000)) for k in range(20)]
    docs = spark.createDataFrame([(k, t, "xx", "s", 0) for k, t in enumerate(texts)], SCHEMA)
    sample = dictionaries(docs, LanguageOptions(dictionary_bytes=8192))["xx"]
    assert 8000 < len(sample) <= 8192
    assert all(f"w{chr(97 + k)}".encode() in sample for k in range(20))
    assert _shared([b"ab", b"c" * 50], 12) == b"ab cccccccc" and _shared([b"ab", b"cd"], 99) == b"ab cd"


def test_language_id(spark, empty):
    docs = spark.createDataFrame(languages(), SCHEMA).repartition(3)
    train = docs.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2)
    found = {r.doc_id: r for r in identify(docs, train).collect()}
    held = [r for r in languages()[:240] if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert np.mean([found[r[0]].lang_pred == r[2] for r in held]) > 0.95
    assert [found[k].lang_pred for k in (900, 901, 902, 903)] == ["und", "und", "und", "aa"]
    assert all(0 <= r.score <= 1 for r in found.values())
    kept = keep_identified(docs.withColumnRenamed("source", "score"), train)
    assert kept.columns == ["doc_id", "text", "lang", "score", "n_chars"]
    assert kept.filter("doc_id >= 900").select("doc_id").collect()[0].doc_id == 903 and kept.count() > 230
    assert {r.lang_pred for r in identify(docs, empty).collect()} == {"und"}
    assert identify(empty, train).count() == 0


def test_toxicity(spark, empty):
    draw, rows, labels = random.Random(5), [], []
    for k in range(900):
        text = prose(2000 + k, 60).split()
        toxic = k % 6 == 0
        if toxic:
            text[draw.randint(0, 59)] = draw.choice(["badword", "Worstling,", "badwords"])
        rows.append((k, " ".join(text)))
        if k % 2 == 0:
            labels.append((k, 1, int(toxic)))
    rows += [(5000, None), (5001, ""), (5002, prose(6, 20000) + " badword")]
    labels += [(0, 1, 1), (5000, None, None), (None, 0, 1), (77777, 0, 1)]
    docs = spark.createDataFrame(rows_of(rows), SCHEMA).repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    model = toxicity.train(docs.filter(fold != 1), marks)
    found = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert len(found) == len(rows)
    right = [found[k].predicted == int(k % 6 == 0) for k in range(900) if zlib.crc32(str(k).encode()) % 3 == 1]
    assert np.mean(right) > 0.98
    assert found[5000].predicted == found[5001].predicted == 0 and found[5002].predicted == 1
    untaught = toxicity.train(docs, marks.filter("false"))
    assert {r.score for r in toxicity.score(docs, untaught).collect()} == {0.0}
    assert toxicity.score(empty, model).count() == 0


def test_risk_is_not_negative():
    """With few positives that a flexible model can learn by heart, weights stay bounded."""
    draw = np.random.default_rng(1)
    x = (draw.random((60, 80)) < 0.2).astype(np.float32)
    positive = np.arange(60) < 10
    weights, bias = toxicity.nn_pu(x, positive, 0.3, toxicity.ToxicityOptions(steps=2000))
    scores = 1 / (1 + np.exp(-(x @ weights + bias)))
    assert np.isfinite(scores).all() and scores[~positive].mean() > 0.1


OPTIONS = attention.AttentionOptions(width=8, key_width=4, context=4, scored=4, groups=4, group_size=4, batch=8)


def small_model():
    counts = np.array([9, 3, 0, 7, 1, 2, 8, 4, 6, 5, 1, 1, 2, 3, 1, 0, 2, 1, 0, 5], float)
    vocabulary = attention.Vocabulary.fit(counts, OPTIONS)
    model = attention.Model.start(vocabulary, OPTIONS)
    draw = np.random.default_rng(2)
    for name in model.w:
        model.w[name] += draw.normal(0, 0.3, model.w[name].shape).astype(np.float32)
    return model


def test_probabilities_sum_to_one_and_look_back_only():
    model = small_model()
    ids = np.array([3, 1, 15, 0, 6, 6, 2, 8, 19], np.uint32)

    def scores(own):
        x, target, _ = attention.windows(own, np.array([0, len(own)]), 4, model.vocabulary, OPTIONS)
        flat = target.reshape(-1)
        return model.log10(x, target).reshape(-1)[flat >= 0]

    whole = scores(ids)
    assert len(whole) == len(ids) + 1
    for cut in range(len(ids)):
        other = ids.copy()
        other[cut + 1 :] = 5
        assert np.allclose(scores(other)[: cut + 1], whole[: cut + 1], atol=1e-5)
    total = sum(10 ** scores(np.append(ids[:5], t).astype(np.uint32))[5] for t in range(20))
    assert total == pytest.approx(1, abs=1e-4)


def test_gradients():
    model = small_model()
    draw = np.random.default_rng(3)
    ids = draw.integers(0, 20, 60).astype(np.uint32)
    x, target, _ = attention.windows(ids, np.array([0, 25, 25, 60]), 4, model.vocabulary, OPTIONS)
    _, grads = model.gradients(x, target)
    for name, g in grads.items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        kept, losses = model.w[name][at], []
        for step in (0.02, -0.02):
            model.w[name][at] = kept + step
            losses.append(model.gradients(x, target)[0])
        model.w[name][at] = kept
        assert g[at] == pytest.approx((losses[0] - losses[1]) / 0.04, rel=0.05, abs=1e-4), name


def test_scores_and_base(spark, docs, empty):
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    options = scoring.ScoringOptions(PATH, frequent=50, min_steps=60)
    found = scoring.score(docs, docs.filter(~held), options).collect()
    assert len(found) == len(awkward())
    counts = Counter()
    for i, t, *_ in awkward():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update([*words(t), None])
    n, v = sum(counts.values()), len(counts)
    texts = {i: t for i, t, *_ in awkward()}
    for r in found:
        own = [*words(texts[r.doc_id]), None]
        want = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(counts[w] > 0 for w in own), n)
        assert r.base_score == pytest.approx(want) and r.score < 0
    assert scoring.score(empty, docs, options).count() == 0
    assert all(r.n_known == 0 and r.train_tokens == 0 for r in scoring.score(docs, empty, options).collect())


def test_model_learns_from_all_documents_at_any_size(spark):
    """Token counts are those of all training texts, however many trainer loads they are."""
    rows = rows_of((k, prose(6000 + k, 40)) for k in range(200))
    train = spark.createDataFrame(rows, SCHEMA).repartition(4)
    tokenizer = Tokenizer.from_file(PATH)
    counts = Counter(i for _, t, *_ in rows for i in tokenizer.encode(t, add_special_tokens=False).ids)
    for load in (500, 8_000_000):
        options = scoring.ScoringOptions(PATH, trainer_bytes=load, max_trainers=3, rounds=1, min_steps=1, model=OPTIONS)
        found = scoring.fit(train, options).vocabulary.counts
        assert {i: found[i] for i in counts} == counts
        assert found[options.end_id] == len(rows) + counts[options.end_id]


def test_weights_learn_from_every_window(spark):
    """The lessons are all windows of all training texts, marks before and behind them included."""
    texts = {k: prose(8000 + k, 5 + 90 * (k % 5)) for k in range(40)} | {99: ""}
    train = spark.createDataFrame(rows_of(texts.items()), SCHEMA).repartition(3)
    tokenizer = Tokenizer.from_file(PATH)
    options = scoring.ScoringOptions(PATH)
    want, width = Counter(), options.model.context + options.model.scored
    for text in texts.values():
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        for token, _ in attention.window_tokens(ids, np.array([0, len(ids)]), options.end_id, options.model):
            want.update(w.tobytes() for w in token)
    rows = scoring._lessons(train.select("doc_id", "text"), options).filter("octet_length(windows) > 0").collect()
    kind = scoring._token_kind(options)
    found = Counter(w.tobytes() for r in rows for w in scoring._unpacked_windows(bytes(r.windows), kind, width))
    assert found == want


def test_windows_are_written_and_read_a_few_rows_at_a_time(spark, monkeypatch):
    """Rows of half a MB, of which an executor would otherwise hold those of a whole file several times."""
    texts = [(k, prose(8700 + k, 60)) for k in range(24)]
    train = spark.createDataFrame(rows_of(texts), SCHEMA).coalesce(1)
    sizes, keep = [], Scratch.keep

    def kept(self, df, name, *more, **named):
        out = keep(self, df, name, *more, **named)
        if name == "lessons":
            for path in glob.glob(self.paths[name].removeprefix("file:").replace("///", "/") + "/*.parquet"):
                meta = pq.ParquetFile(path).metadata
                sizes.append([meta.row_group(k).num_rows for k in range(meta.num_row_groups)])
        return out

    monkeypatch.setattr(Scratch, "keep", kept)
    monkeypatch.setattr(scoring, "_TEXTS", 2)
    options = scoring.ScoringOptions(PATH, min_steps=1, model=OPTIONS)
    counts = scoring.fit(train.select("doc_id", "text"), options).vocabulary.counts
    assert [sum(s) for s in sizes] == [13] and max(sizes[0]) <= scoring._PIECES
    assert counts[options.end_id] >= len(texts)


def test_trainers_get_few_rows_of_windows_at_a_time(spark, monkeypatch):
    """All windows of a trainer in one batch would stand in its executor and its worker besides what it learns from."""
    texts = [(k, prose(8500 + k, 60)) for k in range(24)]
    train = spark.createDataFrame(rows_of(texts), SCHEMA).repartition(12)
    name, during = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before, mean = spark.conf.get(name), scoring._mean

    class Watched:
        def __init__(self, df):
            self.df = df

        def collect(self):
            during.append(int(spark.conf.get(name)))
            return self.df.collect()

    monkeypatch.setattr(scoring, "_mean", lambda trained, trainers: Watched(mean(trained, trainers)))
    options = scoring.ScoringOptions(PATH, min_steps=1, model=OPTIONS)
    scoring.fit(train.select("doc_id", "text"), options)
    assert during == [scoring._PIECES] and spark.conf.get(name) == before
