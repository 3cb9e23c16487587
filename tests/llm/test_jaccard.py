import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest

from tickforge.llm import jaccard
from tickforge.llm.jaccard import Frequent, jaccard_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sets_of(texts, width=5):
    out = {}
    for i, t in texts.items():
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} or ({tuple(w)} if w else set())
    return out


def brute(texts, width=5):
    s = sets_of(texts, width)
    root = {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(texts), 2):
        if s[a] and s[b] and 100 * len(s[a] & s[b]) >= 75 * len(s[a] | s[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(s[i]), find(i)) for i in texts}


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(300)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    texts, i = {}, 0
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 6, 20, 60, 200, 250, 330, 500]))]
        if rng.random() < 0.5:
            base = base[: len(base) // 2] + passage + base[len(base) // 2 :]
        for _ in range(rng.choice([1, 1, 2, 4, 8])):
            copy = list(base)
            for _ in range(int(len(copy) * rng.choice([0, 0.01, 0.02, 0.03, 0.05]))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts[i] = " ".join(copy)
            i += 1
    return texts


def run(spark, texts):
    rows = spark.createDataFrame([(i, t, 7, "x") for i, t in texts.items()], "doc_id long, text string, n long, token string")
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join(rows)[0].collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_corpora(spark, seed, monkeypatch):
    if seed == 2:
        monkeypatch.setattr(jaccard, "FEW_IDS", -1)
        monkeypatch.setattr(jaccard, "GROUP", 2)
    texts = corpus(seed)
    assert run(spark, texts) == brute(texts)


def test_edges(spark):
    texts = {1: None, 2: "", 3: " \t\n", 4: "one", 5: "ONE ", 6: "one two three four", 7: "one two three four five", 8: "One two\nthree four five", 9: "a b a b a b a b a b", 10: "É", 11: "é", 12: "x" * 50_000}
    assert run(spark, texts) == brute(texts)
    assert run(spark, {}) == {}


def test_null_id_and_repeated_rows(spark):
    rows = spark.createDataFrame([(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (9, "a b c d e f")], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in jaccard_join(rows)[0].collect())
    assert got == [(-1, 2, None), (3, 2, 3), (3, 2, 3), (9, 2, 3)]


def test_links_connect_every_component(spark):
    texts = corpus(3)
    docs, links = jaccard_join(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))
    s, near = sets_of(texts), defaultdict(set)
    for r in links.collect():
        assert r.overlap == len(s[r.a] & s[r.b]) and 100 * r.overlap >= 75 * len(s[r.a] | s[r.b])
        near[r.a].add(r.b)
    assert {r.class_id for r in docs.where("class_id <> component_id").collect()} <= set(near) | {b for x in near.values() for b in x}


def test_hot_passages_and_chains(spark, monkeypatch):
    """Texts made mostly of one passage, and near copies of near copies that their hub does not reach."""
    monkeypatch.setattr(jaccard, "GROUP", 5)
    rng = random.Random(8)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    texts = {i: " ".join([rng.choice(vocabulary) for _ in range(rng.randint(4, 30))] + passage) for i in range(30)}
    chain = [rng.choice(vocabulary) for _ in range(100)]
    for i in range(100, 118):
        for _ in range(2):
            chain[rng.randrange(100)] = rng.choice(vocabulary)
        texts[i] = " ".join(chain)
    want = brute(texts)
    assert len({c for _, c in want.values()}) > 3
    assert run(spark, texts) == want


def test_sets_with_too_few_shingles_in_the_low_half(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SMALL", 16)
    monkeypatch.setattr(jaccard, "_HALF", np.uint64((1 << 64) // 4))
    texts = corpus(5)
    assert run(spark, texts) == brute(texts)


def test_frequent_shingles_are_spread(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "FREQUENT", 3000)
    monkeypatch.setattr(jaccard, "TOKENS", 50)
    texts = corpus(6)
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert jaccard._often(jaccard.shingle_sets(rows, "doc_id", "text", 5)).count() > 20
    assert run(spark, texts) == brute(texts)


def test_frequent_tokens_are_never_missed():
    rng = np.random.default_rng(4)
    often, true, sets = Frequent(most=300), Counter(), 2000
    for _ in range(sets):
        s = np.unique(np.concatenate([np.flatnonzero(rng.random(20) < 0.1), rng.integers(100, 1 << 40, 40)])).astype(np.uint64)
        often.add(s)
        true.update(s.tolist())
    token, count = often.found(50)
    assert {t for t, n in true.items() if n > sets / 50} <= set(token.tolist())
    assert len(often.token) <= 300 and all(c <= true[t] for t, c in zip(token.tolist(), count.tolist(), strict=True))
