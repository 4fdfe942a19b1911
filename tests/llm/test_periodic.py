from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from texts_data import WORD, SCHEMA, awkward, prose, rows_of

from cashcycle.llm.periodic import RunOptions, document_runs, find_runs, run_digest, runs_of, with_periodic_tails
from cashcycle.llm.textops import mix


def plain_runs(words, exponent=4, shortest=6):
    found = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(shortest, exponent * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def repetitive(draw):
    words = [draw.randrange(draw.choice([1, 2, 3, 5])) for _ in range(draw.randint(0, 50))]
    if len(words) > 3 and draw.random() < 0.6:
        period, start = draw.randint(1, len(words) // 3), draw.randrange(len(words) // 2)
        words = [w if i < start else words[start + (i - start) % period] for i, w in enumerate(words)]
    if draw.random() < 0.4:
        words = words * draw.randint(1, 6)
    for _ in range(draw.randint(0, 2) if words else 0):
        words[draw.randrange(len(words))] = 9
    return words


@pytest.mark.parametrize("seed", range(4))
def test_all_runs_against_plain_version(seed):
    draw = random.Random(seed)
    for _ in range(150):
        texts = [repetitive(draw) for _ in range(draw.randint(1, 4))]
        options = RunOptions(draw.choice([3, 4, 4, 5]), draw.choice([3, 6, 6, 8]))
        want, at, closed, want_closed, at_closed = [], 0, [], [], 0
        for number, words in enumerate(texts):
            runs = plain_runs(words, options.exponent, options.shortest)
            want += [(at + s, n, q) for s, n, q in runs]
            want_closed += [(at_closed + s, n, q) for s, n, q in runs]
            at, at_closed = at + len(words), at_closed + len(words) + 1
            closed += [*words, 1000 + number]
        flat = mix(np.array([w for t in texts for w in t], np.uint64) + np.uint64(5))
        which = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        assert list(map(tuple, document_runs(flat, which, options).tolist())) == sorted(want, key=lambda r: (r[0], r[2]))
        assert sorted(map(tuple, runs_of(np.array(closed), options).tolist())) == sorted(want_closed)


def test_highly_periodic_long_texts():
    for words in (["a"] * 60000, ["a", "b", "a", "a", "b"] * 9000, (["a"] * 50 + ["b"]) * 800):
        symbols = np.unique(words + ["end"], return_inverse=True)[1]
        runs = runs_of(symbols)
        whole = [r for r in runs.tolist() if r[1] == len(words)]
        assert len(whole) == 1 and whole[0][2] == {60000: 1, 45000: 5, 40800: 51}[len(words)]


def periodic(words, start, period):
    return [w if i < start else words[start + (i - start) % period] for i, w in enumerate(words)]


def own_rows():
    base = prose(1, 900).split()
    rows = [r[:2] for r in awkward()]
    rows += [(500, " ".join(periodic(base, 100, 7))), (501, "la la " * 40 + "\n end"), (502, "x " * 5), (503, "x\t" * 6)]
    rows += [(504, " ".join(periodic(prose(2, 50000).split(), 20000, 4000))), (505, "é a é a é a é a b b b b b b"), (505, "y " * 9)]
    return rows


def test_documents_against_plain_version(spark):
    docs = spark.createDataFrame([(*r, k, "n") for k, r in enumerate(own_rows())], "doc_id long, text string, runs long, n_words string")
    found = find_runs(docs.repartition(3)).collect()
    want = []
    for doc_id, text in own_rows():
        words = WORD.findall(text or "")
        runs = sorted(plain_runs(words) if len(words) < 5000 else [], key=lambda r: (r[0], r[2]))
        runs = [(20000, 30000, 4000)] if doc_id == 504 else runs
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        want.append((doc_id, len(words), runs, " ".join(w for k, w in enumerate(words) if k not in gone)))
    assert sorted((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found) == sorted(want)


def altered(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_digest_of_documents_with_periodic_tails(spark):
    rows = [(k, prose(k, k % 97, 1 + k % 50)) for k in range(400)] + [(1000 + k, t) for k, t in enumerate([None, "", "one", " a  b\tc "] * 30)]
    found = run_digest(find_runs(with_periodic_tails(spark.createDataFrame(rows_of(rows), SCHEMA))))
    want = []
    for doc_id, text in rows:
        words = altered(doc_id, WORD.findall(text or ""))
        runs = sorted(plain_runs(words), key=lambda r: (r[0], r[2]))
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        milli = 1000 * best[1] // best[2] if runs else None
        lines = digest("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        want.append((doc_id, len(runs), *best, milli, lines, digest(" ".join(w for k, w in enumerate(words) if k not in gone))))
    got = [tuple(r) for r in found.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sum(r[1] > 0 for r in got) > 20


def test_empty_table_and_options(spark, empty):
    assert find_runs(empty).collect() == [] and run_digest(find_runs(empty)).collect() == []
    with pytest.raises(ValueError):
        RunOptions(exponent=2)
