from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from tidemark.llm import kneser

N = kneser.ORDER


def _normal(text):
    out = ""
    for c in text:
        c = " " if c.isspace() else "0" if c.isdecimal() else c
        if not (c == " " and out.endswith(" ")):
            out += c
    return kneser.START * (N - 1) + out


def _grams(text):
    whole = _normal(text or "")
    return [whole[k : k + N] for k in range(len(whole) - N + 1)]


def _brute(train, texts):
    """Textbook interpolated modified Kneser-Ney, recursively, with dictionaries."""
    counts = {N: Counter(g for t in train for g in _grams(t))}
    for k in range(N - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    discount, total, kinds = {}, defaultdict(int), defaultdict(Counter)
    for k, own in counts.items():
        c = [sum(1 for n in own.values() if n == i) for i in range(5)]
        discount[k] = (0.5, 0.5, 0.5)
        if min(c[1:]) > 0:
            y = c[1] / (c[1] + 2 * c[2])
            given = [i - (i + 1) * y * c[i + 1] / c[i] for i in (1, 2, 3)]
            discount[k] = tuple(min(max(d, 0.1), i - 0.1) for i, d in enumerate(given, 1))
        for g, n in own.items():
            total[k, g[:-1]] += n
            kinds[k, g[:-1]][min(n, 3)] += 1

    def probability(g):
        k = len(g)
        if k == 0:
            return 1 / (len(counts[1]) + 1)
        lower = probability(g[1:])
        if not total[k, g[:-1]]:
            return lower
        n = counts[k][g]
        weight = sum(discount[k][i - 1] * m for i, m in kinds[k, g[:-1]].items())
        return (max(n - discount[k][min(n, 3) - 1], 0) if n else 0) / total[k, g[:-1]] + weight / total[k, g[:-1]] * lower

    return [(len(_grams(t)), -sum(math.log(probability(g)) for g in _grams(t))) for t in texts]


def _text(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(["the", "of", "schön", "Re", "in", "x1", "\n"]) for _ in range(n))


def test_costs_equal_the_textbook(spark, documents):
    rows = [(k, _text(k, 5 + k)) for k in range(40)] + [(90, "unseen ŽŽ ???"), (91, ""), (92, None), (93, "a"), (None, "the of")]
    learn = spark.createDataFrame([(k,) for k in range(20)] + [(None,), (777,)], "doc_id long")
    held = [k for k in range(20) if zlib.crc32(str(k).encode()) % kneser.HOLD_OUT]
    expected = _brute([dict(rows)[k] for k in held], [t for _, t in rows])
    out = {r["doc"]: (r["chars"], r["cost"]) for r in kneser.perplexities(documents(rows), learn).collect()}
    for (i, _), (chars, cost) in zip(rows, expected):
        assert out[i][0] == chars and out[i][1] == pytest.approx(cost, rel=1e-5, abs=1e-4)


def test_table_finds_what_it_holds():
    r = np.random.default_rng(1)
    table, known = kneser.GramTable(4), {}
    for _ in range(20):
        keys = np.unique(r.integers(0, 3000, 400, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1))
        new = keys[table.find(keys) < 0]
        table.add(new)
        known |= {int(k): len(known) + n for n, k in enumerate(new)}
        assert table.find(keys).tolist() == [known[int(k)] for k in keys]
    assert table.find(np.array([7, 9], np.uint64) << np.uint64(40) | np.uint64(1)).tolist() == [-1, -1]


def test_junk_goes_and_clean_text_stays(spark, documents):
    good = [(k, _text(k, 60), "en", "s") for k in range(300)]
    junk = [(1000 + k, "".join(random.Random(k).choice("#$%&*QZXJK") for _ in range(200)), "en", "s") for k in range(20)]
    odd = [(2000, None, "en", "s"), (2001, "", None, "s"), (2002, "of", "xx", "s"), (2003, _text(3, 30), None, "s")]
    df = documents(good + junk + odd + [good[0], good[0]]).withColumnRenamed("source", "kept")
    learn = spark.createDataFrame([(k,) for k in range(0, 300, 2)], "doc_id long")
    out = kneser.classified(df, learn).collect()
    assert len(out) == df.count()
    lost = {r["doc_id"] for r in out if not r["kept"]}
    assert lost >= {r[0] for r in junk} and len(lost) <= 22 and not lost & {r[0] for r in odd}
    kept = kneser.keep_good(df, learn)
    assert kept.columns == df.columns and kept.count() == sum(r["kept"] for r in out)


def test_without_trusted_documents_all_stay(spark, documents):
    none = spark.createDataFrame([], "doc_id long")
    assert kneser.keep_good(documents([(1, "a b"), (2, None)]), none).count() == 2
    assert kneser.keep_good(documents([]), none).count() == 0


INSULTS = ["Vlottz", "Quipjaw", "Zugwump"]


@pytest.mark.parametrize("n", [60, 3000])
def test_few_odd_words_are_found_in_texts_of_any_length(spark, documents, n):
    good = [(k, _text(k, n if k % 2 else 60), "en", "s") for k in range(300)]
    words = [_text(5000 + k, n).split(" ") for k in range(30)]
    for k, own in enumerate(words):
        own[n // 2] = INSULTS[k % 3]
    rude = [(1000 + k, " ".join(own), "en", "s") for k, own in enumerate(words)]
    learn = spark.createDataFrame([(k,) for k in range(200)], "doc_id long")
    lost = {r["doc_id"] for r in kneser.classified(documents(good + rude), learn).collect() if not r["kept"]}
    recall = len(lost & {r[0] for r in rude}) / len(rude)
    assert recall == 1 and len(lost & {r[0] for r in good}) <= 6


def test_pieces_of_a_long_text_are_one_text(spark, documents, monkeypatch):
    rows = [(k, _text(k, 40)) for k in range(20)] + [(50, "the  \n\n  of Zugwump in" * 3 + " " * 40), (51, "of")]
    whole = [kneser._codes(t) for _, t in rows]
    monkeypatch.setattr(kneser, "CHUNK", 7)
    for (_, text), codes in zip(rows, whole):
        pieces = []
        for held, tags in kneser._chunks(iter([(text, 0)])):
            starts = kneser._starts(tags)
            pieces += [held[a + kneser.ORDER - 1 : b] for a, b in zip(starts, starts[1:])]
        assert np.concatenate([kneser._BEFORE, *pieces]).tolist() == codes.tolist()


@pytest.mark.parametrize("labelled", [0, 1, 4, 40])
def test_a_language_that_labels_hardly_cover_keeps_its_clean_documents(spark, documents, labelled):
    def other(seed, n):
        r = random.Random(seed)
        return " ".join(r.choice(["жизнь", "мир", "да", "книга", "не", "слово"]) for _ in range(n))

    good = [(k, _text(k, 60), "en", "s") for k in range(300)]
    rest = [(1000 + k, other(k, 40 + k % 30), "ru", "s") for k in range(100)]
    none = [(2000 + k, other(k, 50), None, "s") for k in range(20)]
    junk = [(3000 + k, "".join(random.Random(k).choice("#$%&*QZXJK") for _ in range(200)), "en", "s") for k in range(20)]
    learn = spark.createDataFrame([(k,) for k in (*range(200), *range(1000, 1000 + labelled))], "doc_id long")
    out = kneser.classified(documents(good + rest + none + junk), learn).collect()
    lost = {r["doc_id"] for r in out if not r["kept"]}
    assert len(lost & {r[0] for r in rest}) <= 5 and not lost & {r[0] for r in none} and lost >= {r[0] for r in junk}
    assert len(lost & {r[0] for r in good}) <= 6 and len(out) == 440
    assert {r["threshold"] is None for r in out if r["lang"] == "ru"} == {labelled == 0}


def test_memory_of_a_block_holds_no_list_of_its_grams():
    import tracemalloc

    r = random.Random(5)
    text = "".join(chr(r.randrange(0x4E00, 0x9000)) for _ in range(400_000))
    packed = zstandard.ZstdCompressor(level=1).compress(text.encode())
    documents = pa.table({"block": pa.array([0], pa.int32()), "doc": [1], "text_hash": [7], "packed": pa.array([packed], pa.binary())})
    grams = kneser._counted(documents, pa.table({"doc": [1]}))
    assert grams.num_rows > 399_000
    # as Spark hands them over, some thousand rows at a time
    names = pa.chunked_array([grams.column("gram").combine_chunks()[k : k + 10_000] for k in range(0, grams.num_rows, 10_000)])
    costs = pa.table({"gram": names, "cost": pa.array(np.full(grams.num_rows, 0.5, np.float32))})
    tracemalloc.start()
    found = kneser._added_up(documents, costs)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.column("chars").to_pylist() == [400_000] and found.column("cost").to_pylist() == [200_000.0]
    assert peak < 80e6, peak
