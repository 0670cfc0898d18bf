from __future__ import annotations

import random

from tidemark.llm import spacedseed


def _words(seed, n, of=4000):
    r = random.Random(seed)
    return [f"w{r.randrange(of)}" for _ in range(n)]


def _run(own, theirs):
    """Best score over all alignments, by brute force."""
    best = 0
    for shift in range(-len(theirs) + 1, len(own)):
        run = 0
        for k, w in enumerate(theirs):
            if 0 <= k + shift < len(own):
                run = max(run, 0) + (1 if own[k + shift] == w else -1)
                best = max(best, run)
    return best


def _items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_substituted_passages_are_found_and_clean_text_is_not(spark, documents):
    r = random.Random(6)
    items = [(k, _words(k, r.randint(15, 50))) for k in range(12)]
    docs, expected = [], set()
    for d in range(60):
        words = _words(1000 + d, 120)
        if d % 2:
            item, theirs = items[d % 12]
            copy = list(theirs)
            for k in range(7, len(copy), 9):  # one word in nine is another
                copy[k] = "changed"
            at = r.randrange(100)
            words[at:at] = copy
            expected.add((d, item))
        docs.append((d, words))
    found = spacedseed.overlaps(
        documents([(d, " ".join(w).capitalize() + ".") for d, w in docs]),
        _items(spark, [(i, ", ".join(w).upper()) for i, w in items]),
    ).collect()
    assert {(x["doc_id"], x["item_id"]) for x in found} == expected
    by_id, by_item = dict(docs), dict(items)
    for x in found:
        assert x["score"] == _run(by_id[x["doc_id"]], by_item[x["item_id"]])
        part = by_id[x["doc_id"]][x["first_word"] : x["first_word"] + x["n_words"]]
        assert part[0] in by_item[x["item_id"]] and part[-1] in by_item[x["item_id"]]


def test_slices_of_the_benchmark_find_the_same(spark, documents, monkeypatch):
    items = _items(spark, [(k, " ".join(_words(k, 20))) for k in range(6)])
    docs = documents([(k, "x y " + " ".join(_words(k % 6, 20))) for k in range(12)])
    whole = sorted(map(tuple, spacedseed.overlaps(docs, items).collect()))
    monkeypatch.setattr(spacedseed, "SLICE", 50)
    assert sorted(map(tuple, spacedseed.overlaps(docs, items).collect())) == whole and len(whole) == 12


def test_defined_cases(spark, documents):
    leak = " ".join(_words(1, 20))
    docs = documents([(1, leak), (1, leak), (1, "clean"), (2, None), (3, ""), (None, leak), (4, "many words " * 30_000)])
    docs = docs.withColumnRenamed("source", "_own")
    items = _items(spark, [(1, leak), (2, None), (3, ""), (4, "too short"), (5, leak), (None, None)])
    found = spacedseed.overlaps(docs, items).collect()
    assert sorted((repr(x["doc_id"]), x["item_id"]) for x in found) == [("1", 1), ("1", 5), ("None", 1), ("None", 5)]
    kept = spacedseed.without_overlaps(docs, items)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["text"] and r["text"][:5]) for r in kept.collect()) == [(1, "clean"), (2, None), (3, ""), (4, "many ")]
    assert spacedseed.without_overlaps(docs, items.where("false")).count() == 7
    assert spacedseed.without_overlaps(documents([]), items).count() == 0


def test_broadcast_rows_are_small_whatever_the_items(spark, documents, monkeypatch):
    sent = []
    broadcast = spacedseed.F.broadcast
    monkeypatch.setattr(spacedseed.F, "broadcast", lambda part: sent.append(part) or broadcast(part))
    monkeypatch.setattr(spacedseed, "SLICE", 1000)
    long, same = " ".join(_words(1, 600)), " ".join(_words(2, 20))
    items = _items(spark, [(0, long)] + [(k, same) for k in range(1, 81)])
    found = spacedseed.overlaps(documents([(1, long), (2, "x " + same), (3, "clean")]), items).collect()
    assert {(x["doc_id"], x["item_id"], x["score"]) for x in found} == {(1, 0, 600)} | {(2, k, 20) for k in range(1, 81)}
    assert all(set(dict(part.dtypes).values()) <= {"int", "bigint"} for part in sent)
    assert max(part.count() for part in sent) <= 1200 and len(sent) == 2


def test_a_seed_of_many_items_is_dealt_over_the_slices(spark, documents, monkeypatch):
    sent = []
    broadcast = spacedseed.F.broadcast
    monkeypatch.setattr(spacedseed.F, "broadcast", lambda part: sent.append(part.count()) or broadcast(part))
    monkeypatch.setattr(spacedseed, "SLICE", 200)
    same = " ".join(_words(3, 10))
    items = _items(spark, [(k, f"{same} t{k}") for k in range(60)])
    found = spacedseed.overlaps(documents([(1, same)]), items).collect()
    assert len(found) == 60 and max(sent) <= 300


def test_short_items_and_items_with_changes(spark, documents):
    items = [(n, _words(50 + n, n, 10**9)) for n in (*range(1, 13), 15)]
    docs, expected = [], set()
    for n, theirs in items:
        docs.append((100 * n, " ".join(["x", *theirs, "y"])))
        expected.add((100 * n, n))
        for k in range(1, n - 1):  # one inner word is another
            docs.append((100 * n + k, " ".join([*theirs[:k], "other", *theirs[k + 1 :]])))
            if n >= 8:
                expected.add((100 * n + k, n))
    four = list(items[-1][1])
    for k in (5, 7, 12, 13):
        four[k] = f"changed{k}"
    docs.append((9000, " ".join(four)))
    expected.add((9000, 15))
    found = spacedseed.overlaps(documents(docs), _items(spark, [(n, " ".join(w)) for n, w in items])).collect()
    assert {(x["doc_id"], x["item_id"]) for x in found} == expected


def test_scripts_without_blanks(spark, documents):
    item = "机器学习模型需要大量训练数据才能工作"
    thai = "ภาษาไทยเขียนติดกันโดยไม่เว้นวรรค"
    docs = documents([(1, f"今天我们说{item}。"), (2, item.replace("训", "测")), (3, "今天天气很好我们去公园散步"), (4, "xx " + thai), (5, "日本")])
    found = spacedseed.overlaps(docs, _items(spark, [(1, item), (2, thai), (3, "天气很好"), (4, "本日")])).collect()
    assert {(x["doc_id"], x["item_id"]) for x in found} == {(1, 1), (2, 1), (4, 2), (3, 3)}


def test_a_text_of_one_word_is_hashed_once_whatever_its_hits(spark, documents):
    items = _items(spark, [(1, "ha"), (2, "ha " * 12), (3, "ha ho")])
    n = 40_000
    docs = documents([(1, "ha " * n + "end"), (2, "ho " * n), (3, "nothing of it"), (4, None)])
    found = {(x["doc_id"], x["item_id"]): x for x in spacedseed.overlaps(docs, items).collect()}
    assert set(found) == {(1, 1), (1, 2)}
    assert found[1, 1]["score"] == 1 and found[1, 2]["score"] == 12
    assert found[1, 2]["first_word"] == 0 and found[1, 2]["n_words"] == 12
