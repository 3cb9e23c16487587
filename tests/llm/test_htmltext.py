import html
import random
import re

from tickforge.llm.htmltext import FEATURES, blocks, default_tree, extract, labelled, main_text, plain_page, training_table

WORDS = "alpha beta gamma. delta, épsilon zeta &amp; 5&lt;6 &#233; &nbsp;x".split()


def page(seed):
    """A random page and its main text."""
    r = random.Random(seed)
    run = lambda a, b: " ".join(r.choice(WORDS) for _ in range(r.randint(a, b)))
    links = lambda n: "".join(f'<li><a href="/{k}">{run(1, 3)}</a></li>' for k in range(n))
    parts, want = [], []
    for k in range(r.randint(1, 8)):
        t = run(1, 60)
        want.append(t)
        parts.append(f"<h1>{t}</h1>" if k == 0 else f"<p>{t.replace(' ', '  ' if r.random() < 0.2 else ' ')}</p>" if r.random() < 0.8 else f"<p><b>{t}<br>")
    noise = [f"<nav><ul>{links(4)}</ul></nav>", f'<div class="ad">{run(5, 30)}</div>', f"<aside><p>{run(5, 40)}</p></aside>", f'<div class="cookie-notice"><p>{run(8, 30)}</p></div>', f"<form><label>{run(1, 4)}</label><input name=q></form>"]
    after = [f"<footer>&copy; {run(2, 12)}</footer>", f'<div id="comments"><p>{run(5, 40)}</p><p>{run(5, 40)}</p></div>']
    r.shuffle(noise)
    body = f"<script>var t='</p>';</script><style>p{{}}</style><!-- {run(3, 9)} -->"
    doc = f"<!DOCTYPE html><html><head><title>{run(3, 6)}</title></head><body>{''.join(noise[: r.randint(0, 5)])}<article>{body}{''.join(parts)}</article>{''.join(after[: r.randint(0, 2)])}"
    clean = [re.sub(r"\s+", " ", html.unescape(t)).strip() for t in want]
    return doc + ("</body></html>" if r.random() < 0.8 else ""), "\n".join(t for t in clean if t)


def test_random_pages():
    for seed in range(300):
        doc, want = page(seed)
        assert main_text(doc) == want, (seed, doc)


def accuracy(x, y):
    return sum((default_tree().predict(list(r)) > 0.5) == bool(v) for r, v in zip(x, y, strict=True)) / len(y)


def test_tree_fits_its_table():
    assert accuracy(*training_table()) > 0.97


def test_words_and_links_of_neighbours_decide_where_a_page_marks_nothing():
    """Pages of other seeds than those of the training table."""
    tree = default_tree()
    used = {FEATURES[f] for f in tree.feature if f >= 0}
    assert {"words", "links"} <= used and used & {"words_before", "links_before"} and used & {"words_after", "links_after"}
    x, y = labelled([plain_page(k) for k in range(10_000, 10_200)])
    assert not x[:, [FEATURES.index(k) for k in ("away", "inside", "content")]].any()
    assert accuracy(x, y) > 0.95
    alone = x.copy()
    alone[:, [FEATURES.index(k) for k in ("words_before", "links_before", "words_after", "links_after")]] = 0
    assert accuracy(alone, y) < accuracy(x, y) - 0.01


def test_names_scrambled():
    """Pages as in page(), whose element and class names say nothing."""
    right = total = main = 0
    for seed in range(400):
        doc, want = page(seed)
        doc = re.sub(r"<(/?)(?:article|nav|aside|footer|form)\b", r"<\1div", re.sub(r' (?:class|id)="[^"]*"', "", doc))
        got, known = blocks(doc), set(want.split("\n"))
        right += sum((default_tree().predict(f) > 0.5) == (t in known) for t, f in got)
        main += sum(t in known for t, _ in got)
        total += len(got)
    print("block accuracy with scrambled names", right / total, "if all or none were main text", max(main, total - main) / total)
    assert right > max(main, total - main)


HAND = [
    ("""<html><body><div id=top><a href=/>Home</a> <a href=/w>World</a> <a href=/s>Sport</a></div><table><tr><td>
<h2>River rises after a week of rain</h2><p>The river passed its banks on Tuesday night after seven days of rain, and the lower part of the town was cut off from the road to the north.</p>
<p>Nobody was hurt, said the mayor, who had slept in the town hall. Boats carried food and medicine to about forty houses during the morning.</p>
<p>More rain is expected.</p><p>The bridge, built in 1911, stays closed until engineers have looked at its piers, which will take at least three days.</p></td></tr></table>
<div><a href=/a>About us</a> <a href=/c>Contact</a> <a href=/p>Privacy</a></div></body></html>""", 5),
    ("""<header><a href=/>The Daily</a></header><main><h1>How to bake bread</h1><p>Mix flour and water and let the dough rest for an hour in a warm place.</p><p>Bake.</p></main><aside><p>Buy our very good flour today and save a third of its price until Sunday evening.</p></aside>""", 3),
]


def test_pages_labelled_by_hand():
    for doc, n in HAND:
        text = main_text(doc).split("\n")
        assert len(text) == n and not any(w in " ".join(text) for w in ("Home", "Privacy", "Daily", "Buy"))


def test_rows(spark):
    doc, want = page(1)
    rows = [(1, "u", doc, 5), (1, "u", doc, 5), (2, None, None, 5), (None, "v", "", 5), (3, "w", "no tags at all", 5), (4, "x", "<p", 5), (5, "y", "<article><p>" + "long words " * 200_000, 5), (6, "z", "<nav><a>1</a></nav>", 5)]
    got = extract(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).collect()
    by = {r.page_id: r for r in got}
    assert len(got) == len(rows) and [r.text for r in got if r.page_id == 1] == [want, want]
    assert by[2].text == by[None].text == by[6].text == "" and by[2].n_chars == 0
    assert by[5].n_chars == len(("long words " * 200_000).strip())
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_block_cuts():
    assert [t for t, _ in blocks("a<b>b</b>c<p>d  e\n f<br>g</p><!-- x > y -->h 1 < 2 <a title='>'>i</a>")] == ["abc", "d e f", "g", "h 1 < 2 i"]
    assert blocks("<script>alert('<p>x</p>')") == []


def test_names_do_not_hide_an_article():
    text = "<p>One two three four five six seven eight nine ten.</p><p>More of the same story, told at some length here.</p>"
    want = "One two three four five six seven eight nine ten.\nMore of the same story, told at some length here."
    for open_, shut in (("<article class='post tag-news'>", "</article>"), ("<main class='has-sidebar'>", "</main>"), ("<article class='share social'>", "</article>"), ("<div class='post tag-news'>", "</div>"), ("<div id=page class='has-sidebar'><article>", "</article></div>")):
        assert main_text(f"{open_}{text}{shut}<div class='site-footer'>Far away words</div>") == want
    assert main_text(f"<article><div class='entry-header'><h1>A title</h1></div>{text}<div class='post-comments'><p>Some reply to it</p></div></article>") == f"A title\n{want}"
