"""Each stage against a plain version of it, on a small corpus with planted cases."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import public_tokenizers as P
import pytest
import tiktoken

import corpus_pipeline
from tests.llm.test_jaccard import sets_of
from tests.llm.test_mixing import reshare
from tickforge.llm.bpe import read_ranks

LANGS = {"en": "the of and to in that with his they were from have this which their".split(), "fr": "le les des une dans pour que qui avec être était où très même après".split()}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    r = random.Random(9)
    rows, labels = [], []
    for i in range(420):
        lang = "en" if i % 3 else "fr"
        words = [r.choice(LANGS[lang]) + r.choice(["", "", "s", "ed"]) for _ in range(r.randint(30, 150))]
        bad = i % 5 == 0
        if bad:
            words = [w.upper() + "!!" for w in words]
        rows.append([i, " ".join(words), lang, "abc"[i % 7 % 3]])
        labels.append((i, int(not bad), 0))
    for k in range(60):  # near and exact copies of clean documents
        words = rows[3 * k + 1][1].split()
        if k % 2 and len(words) > 60:
            words[5] = "changed"
        rows.append([1000 + k, " ".join(words), rows[3 * k + 1][2], "b"])
    rows += [[2000, None, "en", "a"], [2001, "", "en", None], [2002, "1234 56", "fr", "a"], [None, rows[2][1], "en", "a"], list(rows[7])]
    return [(i, t, lang, s, len(t or "")) for i, t, lang, s in rows], labels


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    rows, labels = corpus()
    at = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    docs, seen = spark.read.parquet(f"{at}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, at).write.parquet(f"{at}/{k}")
        docs = spark.read.parquet(f"{at}/{k}")
        seen.append((name, docs))
    return at, rows, seen


def test_names_and_columns(stages):
    _, rows, seen = stages
    assert [n for n, _ in seen] == ["language", "quality", "near-duplicates", "mixture", "tokens"]
    assert all(d.columns == ["doc_id", "text", "lang", "source", "n_chars"] for _, d in seen[:-1])


def test_language_drops_what_has_no_letter(stages):
    _, rows, seen = stages
    assert Counter(map(tuple, seen[0][1].collect())) == Counter(r for r in rows if any(c.isalpha() for c in r[1] or ""))


def test_quality_drops_the_bad_and_keeps_the_clean(stages):
    _, _, seen = stages
    before, after = (Counter(map(tuple, d.collect())) for _, d in seen[:2])
    assert after == Counter({r: n for r, n in before.items() if "!!" not in r[1]})


def test_one_of_each_group_stays(stages):
    _, _, seen = stages
    before, after = seen[1][1].collect(), seen[2][1].collect()
    texts = {r.doc_id: r.text for r in before if r.doc_id is not None}
    s = sets_of(texts)
    root = {i: i for i in texts}
    ids = sorted(texts)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if 100 * len(s[a] & s[b]) >= 75 * len(s[a] | s[b]):
                x, y = a, b
                while root[x] != x:
                    x = root[x]
                while root[y] != y:
                    y = root[y]
                root[max(x, y)] = min(x, y)
    assert sorted(r.doc_id for r in after if r.doc_id is not None) == [i for i in ids if root[i] == i]
    assert sum(r.doc_id is None for r in after) == 1 and len(after) < len(before)


def test_mixture_meets_the_targets(stages):
    _, _, seen = stages
    before, after = seen[2][1].collect(), seen[3][1].collect()
    held, got, largest = defaultdict(int), defaultdict(int), max(len(r.text.split()) for r in before)
    for r in before:
        held[r.source] += len(r.text.split())
    for r in after:
        got[r.source] += len(r.text.split())
    want = reshare(held)
    assert all(abs(got[k] - want[k]) <= largest for k in held)
    assert set(map(tuple, after)) <= set(map(tuple, before)) and max(Counter(map(tuple, after)).values()) <= 3


def test_tokens(stages):
    at, _, seen = stages
    bpe = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=read_ranks(P.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    want = Counter()
    for r in seen[3][1].collect():
        ids = bpe.encode_ordinary(r.text)
        want[r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest()] += 1
    assert Counter(map(tuple, seen[4][1].collect())) == want


def test_run_is_the_stages(spark, stages):
    at, _, seen = stages
    assert Counter(map(tuple, corpus_pipeline.run(spark, at).collect())) == Counter(map(tuple, seen[4][1].collect()))
    assert math.isfinite(corpus_pipeline.LEAST_SURE)


def through(spark, at, rows, extra=""):
    docs = spark.createDataFrame(rows, SCHEMA + extra)
    counts = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, at).write.parquet(f"{at}/x{k}")
        docs = spark.read.parquet(f"{at}/x{k}")
        assert k == 4 or docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        counts.append(docs.count())
    return docs, counts


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert through(spark, str(tmp_path), [])[1] == [0] * 5


def test_nulls_long_texts_and_clashing_columns(spark, tmp_path):
    spark.createDataFrame([(None, None, None), (1, None, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    clash = ", score double, size long, lang_pred string, _text string, taken int, component_id long, n_tokens string"
    more = (0.5, 1, "x", "y", 2, 3, "z")
    words = "one two three four five six seven eight nine ten"
    rows = [(None, None, None, None, None), (1, words, None, None, None), (2, words, "en", "a", 3), (2, words, "en", "a", 3), (3, "", "en", "a", 0), (4, "long " * 100_000, "en", "b", None), (None, "some other words", "en", None, 1), (5, "1 2 3", "fr", "b", 5)]
    docs, counts = through(spark, str(tmp_path), [r + more for r in rows], clash)
    assert counts[:3] == [5, 5, 3]
    assert {r.doc_id for r in docs.collect()} <= {None, 1, 4} and docs.where("decoded_sha256 is null").count() == 0


def test_language_drops_unlearned_languages(spark, tmp_path):
    rows, _ = corpus()
    strange = [
        "Mieleni minun tekevi, aivoni ajattelevi lähteäni laulamahan, saa'ani sanelemahan, sukuvirttä suoltamahan",
        "Litwo, ojczyzno moja, ty jesteś jak zdrowie, ile cię trzeba cenić, ten tylko się dowie, kto cię stracił",
        "Все счастливые семьи похожи друг на друга, каждая несчастливая семья несчастлива по-своему",
        "道可道非常道名可名非常名无名天地之始有名万物之母",
        "xq zvkj qwpt bnmz lkjh gfdq wrtz plmk zxcv qqjw hhgk vbtz mnpq " * 50,
        "if (!arr[i]) { free(buf); return -ENOMEM; } memcpy(dst, src, sizeof(struct node*));",
    ]
    rows = [r for r in rows if any(c.isalpha() for c in r[1] or "")] + [(4000, "x", None, "a", 1), (4001, "le", None, "a", 2), (4002, "with his", None, "a", 8)]
    planted = [(3000 + k, t, None, "a", len(t)) for k, t in enumerate(strange)]
    kept = corpus_pipeline.language(spark, spark.createDataFrame(rows + planted, SCHEMA), str(tmp_path))
    assert Counter(map(tuple, kept.collect())) == Counter(rows)


def test_rows_that_share_an_id_but_not_a_text(spark, tmp_path):
    r = random.Random(3)
    a, b, c, d = (" ".join(f"{w}{r.randint(0, 999)}" for _ in range(60)) for w in "abcd")
    near = d.replace(d.split()[30], "changed")
    rows = [(1, a), (7, a), (7, b), (7, b), (7, c), (9, c), (5, d), (5, near), (None, a), (8, None), (8, None), (8, "")]
    kept = corpus_pipeline.distinct(spark, spark.createDataFrame([(i, t, "en", "a", len(t or "")) for i, t in rows], SCHEMA), str(tmp_path))
    got = Counter((k.doc_id, k.text) for k in kept.collect())
    one = min(d, near, key=lambda t: hashlib.sha256(t.encode()).hexdigest())
    assert got == Counter([(1, a), (7, b), (7, c), (5, one), (None, a), (8, None), (8, "")])
