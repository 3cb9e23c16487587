import random
import zlib
from collections import Counter
from itertools import combinations
from math import exp, sqrt

import numpy as np

from tickforge.llm.bytesops import utf8
from tickforge.llm.langid import CELLS, families, identify, predict, train, trigram_vectors
from tickforge.llm.sampling import per_class

WORDS = {
    "aa": "the and with that from this have which their would",
    "ab": "thee ond wid dat fram dis hav witch dheir wood",
    "zz": "été où ça très déjà après être même français garçon",
    "zy": "éte òu çe trèz dèja aprés étre mème franço garçan",
}


def texts(n, seed=1):
    rng = random.Random(seed)
    langs = list(WORDS)
    return [(i, " ".join(rng.choice(WORDS[langs[i % 4]].split()) for _ in range(rng.randint(8, 60))), langs[i % 4], 0.5) for i in range(n)]


def is_held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def test_held_out_accuracy_and_edges(spark):
    rows = [*texts(600), (1000, None, "aa", 0.0), (1001, "", "aa", 0.0), (1002, "123 !?", "aa", 0.0), (1003, texts(1)[0][1], None, 0.0), (None, texts(1)[0][1], "aa", 0.0), (1004, "x", None, 0.0), (1005, "THE AND WITH " * 5000, None, 0.0)]
    rows += [rows[5]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    got = identify(df).collect()
    assert len(got) == len(rows)
    right = [r.lang_pred == list(WORDS)[r.doc_id % 4] for r in got if r.doc_id is not None and r.doc_id < 600 and r.held_out]
    assert len(right) > 100 and np.mean(right) > 0.97
    by = {r.doc_id: r for r in got}
    for i in (1000, 1001, 1002):
        assert (by[i].lang_pred, by[i].score) == ("und", 0.0)
    assert by[1003].lang_pred == by[None].lang_pred == by[1005].lang_pred == "aa"
    assert all(0 <= r.score <= 1 and r.held_out == is_held("" if r.doc_id is None else r.doc_id) for r in got)
    assert sorted(map(repr, got)) == sorted(map(repr, identify(df.repartition(7)).collect()))


def test_held_out_rows_teach_nothing(spark):
    rows = [(i, t, lang) for i, t, lang, _ in texts(400)]
    poisoned = [(i, t, "zz" if is_held(i) else lang) for i, t, lang in rows]
    a, b = (identify(spark.createDataFrame(x, "doc_id long, text string, lang string")).orderBy("doc_id").collect() for x in (rows, poisoned))
    assert a == b


def test_few_languages(spark):
    schema = "doc_id long, text string, lang string"
    assert identify(spark.createDataFrame([], schema)).count() == 0
    assert {r.lang_pred for r in identify(spark.createDataFrame([(0, "abc", None)], schema)).collect()} == {"und"}
    one = identify(spark.createDataFrame([(i, "some words here", "en") for i in range(9)], schema)).collect()
    assert {r.lang_pred for r in one} == {"en"}


def test_vectors_do_not_depend_on_neighbours():
    import pyarrow as pa

    rows = ["Élan vital", "a", "", "ÉLAN VITAL", "xyz" * 100]
    both = trigram_vectors(*utf8(pa.array(rows)))
    for i, t in enumerate(rows):
        assert np.array_equal(both[i], trigram_vectors(*utf8(pa.array([t])))[0])
    assert np.array_equal(both[0], both[3]) and both.shape == (5, CELLS)


def test_families_join_the_alike():
    m = {"a": np.array([1.0, 0.1, 0]), "b": np.array([1.0, 0, 0.1]), "c": np.array([0, 1.0, 1.0]), "d": np.array([0, 1.0, 0.9])}
    assert sorted(families(m)) == [["a", "b"], ["c", "d"]]


def plain_vector(text):
    """Square roots of relative counts of hashed trigrams, byte by byte."""
    folded, before = [], 0
    for b in text.encode():
        if 65 <= b <= 90 or (before == 0xC3 and 0x80 <= b <= 0x9E and b != 0x97):
            folded.append(b + 32)
        else:
            folded.append(b if 97 <= b <= 122 or b >= 128 else 32)
        before = b
    cells = Counter()
    for x, y, z in zip(folded, folded[1:], folded[2:], strict=False):
        if (x, y, z) != (32, 32, 32):
            cells[((x << 16 | y << 8 | z) * 2654435761 % (1 << 32)) >> 20] += 1
    n = sum(cells.values())
    return {c: sqrt(k / n) for c, k in cells.items()}


def test_predictions_by_hand(spark):
    """Margins as sums over a text's trigrams: the family, then the votes of the pairs in it."""
    rows = [(i, t, lang) for i, t, lang, _ in texts(300)] + [(900, "ÉTÉ Où ça", None), (901, "The WITH 12 -- ça", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    m = train(df)
    squash = lambda x: 1 / (1 + exp(-max(-60, min(60, 4 * x))))
    for r in predict(df, m, keep=("doc_id", "text")).collect():
        v = plain_vector(r.text)
        margin = lambda w: sum(float(w[0][c]) * x for c, x in v.items()) + w[1]
        family = [margin(w) for w in m.family] or [0.0]
        f = family.index(max(family))
        sure = squash(family[f]) if m.family else 1.0
        votes = {a: [0, 0.0] for a in m.groups[f]}
        for a, b in combinations(m.groups[f], 2):
            p = squash(margin(m.pairs[a, b]))
            votes[a if p >= 0.5 else b][0] += 1
            votes[a][1] += p
            votes[b][1] += 1 - p
        best = max(votes, key=lambda a: votes[a][0] + votes[a][1] / (len(votes) + 1))
        assert r.lang_pred == best
        want = sure * (votes[best][1] / (len(votes) - 1) if len(votes) > 1 else 1)
        assert r.score == 0 or abs(r.score - want) < 1e-3


def test_sample_of_rows_without_ids_and_of_one_id(spark):
    for i in (None, 0):
        rows = [(i, t, lang) for _, t, lang, _ in texts(4000)] + [(i, "the and with", "aa")] * 3000
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        picked, counts = per_class(df, "lang", ["doc_id", "text"], 100)
        assert sum(counts.values()) == 7000
        assert 200 < picked.dropDuplicates().count() < 600
        assert {r.lang_pred for r in identify(df).collect()} == set(WORDS)
