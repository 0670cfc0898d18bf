from __future__ import annotations

import random
import re
from collections import Counter

from tidemark.llm import weakrules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measured(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    often = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(covered), sum(a == b for a, b in zip(words, words[1:])))


def test_features_equal_brute_force(spark, documents):
    r = random.Random(5)
    texts = [None, "", " \t\n\x0b", "a", "a b c d e f g", "a b c d e f g h", "a b c d e f g h " * 2, "x\n\nx\n x\ny"]
    for _ in range(300):
        texts.append("".join(r.choice(["a ", "b ", "cé ", "#d ", "\n", "\t\r", "|*", " "]) for _ in range(r.randint(0, 120))))
    texts += ["a b " * 3000, " ".join(map(str, range(5000))) + " " + " ".join(map(str, range(100, 120)))]
    df = weakrules.text_features(documents(list(enumerate(texts))))
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_echo_words")
    for row in df.collect():
        assert tuple(row[c] for c in columns) == measured(texts[row["doc_id"]]), texts[row["doc_id"]][:80]


def _voted(spark, n=4000, seed=2):
    """Votes of rules with known rates on good and bad documents of two kinds."""
    r = random.Random(seed)
    rows = []
    for _ in range(n):
        good = r.random() < 0.85
        kind = r.randrange(2)
        vote = lambda mine: 0 if r.random() < (0.001 if good or not mine else 0.9) else -1
        rows.append((good, vote(kind == 0), vote(kind == 0), vote(kind == 1), vote(kind == 1), 1 if r.random() < 0.9 else -1))
    names = [f"r{k}" for k in range(5)]
    rules = [weakrules.Rule(x, "false", "false") for x in names]
    return spark.createDataFrame(rows, "good boolean, " + ", ".join(f"vote_{x} int" for x in names)), rules


def test_estimated_rates_and_posterior(spark):
    voted, rules = _voted(spark)
    model = weakrules.fit(voted, rules)
    assert abs(model.good - 0.85) < 0.03
    for _, on_good, on_bad in model.by_rule[:4]:
        assert on_good[0] < 0.02 and 0.3 < on_bad[0] < 0.6
    judged = voted.withColumn("kept", weakrules.posterior(model) >= 0.5)
    wrong = judged.where("good <> kept").count()
    assert wrong < 0.03 * voted.count()


def test_defined_cases(spark, documents):
    rows = [(1, None), (2, ""), (3, "good words here " * 20), (3, "good words here " * 20), (None, "ABC!! " * 50)]
    out = weakrules.judged(weakrules.text_features(documents(rows).withColumnRenamed("source", "n_words"))).collect()
    assert len(out) == 5 and all(0 <= r["quality"] <= 1 for r in out)
    assert next(r for r in out if r["doc_id"] == 1)["n_words"] == 0
    assert weakrules.judged(weakrules.text_features(documents([]))).count() == 0
