"""Quality rules, toxicity, main text of pages and URL filters."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import awkward, documents, empty, tuples
from tidemart.llm import html_text
from tidemart.llm.html_dom import parse
from tidemart.llm.html_text import Matching, Tree, main_text, merge, page_tree
from tidemart.llm.quality import Limits, judge_quality, keep_good
from tidemart.llm.toxicity import Automaton, Term, drop_toxic, features, fit_regression, score_documents, train
from tidemart.llm.url_filter import Rule, judge_urls, keep_allowed, resolve

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def base_counts(text):
    text = text or ""
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            covered |= set(range(i, i + 8))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_base_counts(spark):
    rnd = random.Random(6)
    texts = [
        "".join(rnd.choice(["a ", "b ", "Ab\n", "c\t", "# ", "é|", "\n", "a b a b a b a b a b ", "\u00a0", "\U0001f600 "]) for _ in range(rnd.randrange(60)))
        for _ in range(150)
    ]
    docs = documents(spark, [*texts, None], words=1, h1="x", n_words=2)
    found = judge_quality(docs).select("doc_id", *BASE, "base_failed")
    expected = []
    for i, t in enumerate([*texts, None]):
        c = base_counts(t)
        expected.append((i, *c, c[0] < 20 or 100 * c[4] > 30 * c[0]))
    assert tuples(found) == sorted(expected, key=repr)


def test_divergent_documents_go_and_the_language_is_learned(spark):
    rnd = random.Random(8)
    common, rare = ["the", "of", "and", "to", "in", "is"], ["bridge", "winter", "garden", "copper", "market", "silver"]
    good = [" ".join(rnd.choice(common if rnd.random() < 0.5 else rare) for _ in range(200)).capitalize() + "." for _ in range(60)]
    shouted, symbols = good[0].upper(), " ".join(w + "%%" for w in good[1].split())
    no_common = " ".join(rnd.choice(["the", "the", "xyzzyx"]) + rnd.choice(["", "", "q"]) for _ in range(300))
    docs = documents(spark, [*good, shouted, symbols, no_common])
    kept = {r.doc_id: r.kept for r in judge_quality(docs).collect()}
    assert all(kept[i] for i in range(60)) and not kept[60] and not kept[61] and not kept[62]
    assert keep_good(docs).count() == 60 and keep_good(docs).columns == docs.columns
    lenient = Limits(class_floor=2.0, max_word_distance=2.0)
    assert keep_good(docs, lenient).count() == 63


def test_long_texts_without_common_words_go(spark):
    rnd = random.Random(9)
    english = ["the", "of", "and", "to", "in", "is", "bridge", "winter", "garden", "copper", "market", "silver"]
    spanish = ["de", "la", "que", "el", "en", "los", "puente", "invierno", "jardin", "cobre", "mercado", "plata"]
    text = lambda words, n: " ".join(rnd.choice(words) for _ in range(n)).capitalize() + "."
    good = [text(english, rnd.randrange(60, 400)) for _ in range(60)]
    other, keywords, short = text(spanish, 300), text(english[6:], 300), text(english[6:], 90)
    kept = {r.doc_id: r.kept for r in judge_quality(documents(spark, [*good, other, keywords, short])).collect()}
    assert all(kept[i] for i in range(60)) and not kept[60] and not kept[61] and not kept[62]


def test_quality_of_the_labelled_corpus(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = judge_quality(docs).join(labels, "doc_id").groupBy("quality", "base_failed", "kept").count().collect()
    counts = {(r.quality, r.base_failed, r.kept): r["count"] for r in rows}
    good, good_lost = counts.get((1, False, True), 0), counts.get((1, False, False), 0)
    poor, poor_kept = counts.get((0, False, False), 0), counts.get((0, False, True), 0)
    assert good_lost <= 0.01 * good and poor_kept <= 0.4 * poor


def test_quality_of_awkward_rows(spark):
    rows = judge_quality(awkward(spark, common="x", found=1)).collect()
    expected = sorted(((r.doc_id, *base_counts(r.text)) for r in awkward(spark).collect() if r.doc_id != 4), key=repr)
    assert sorted((tuple(r)[:6] for r in rows if r.doc_id != 4), key=repr) == expected
    assert all(r.base_failed and not r.kept for r in rows)
    assert judge_quality(empty(spark)).count() == 0 and keep_good(empty(spark)).count() == 0


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] or a[i + 1 :] == b[i:] or a[i:] == b[i + 1 :]


def test_the_automaton_agrees_with_edit_distance():
    terms = ["idiot", "stupid", "ideal", "scum", "stumps"]
    automaton = Automaton([Term(t, False, len(t) >= 5) for t in terms] + [Term("gross", True, False)])
    rnd = random.Random(3)
    words = ["idiot", "idot", "idiott", "1diot", "idit", "xidiot", "stupids", "scum", "scom", "gross", "grossly", "grossest", "dot", "é"]
    words += ["".join(rnd.choice("idotsuple") for _ in range(rnd.randrange(1, 8))) for _ in range(3000)]
    for t in terms:
        for _ in range(60):
            i = rnd.randrange(len(t) + 1)
            words.append(rnd.choice([t[:i] + t[i + 1 :], t[:i] + "q" + t[i:], t[:i] + "o" + t[i + 1 :]]))
    bounds, owner, starts, ends, exact, near, joined = automaton.match([" ".join(words)])
    found = [joined[s:e] for s, e in zip(starts, ends, strict=True)]
    assert found == [w for w in words if w]
    for word, x, n in zip(found, exact.tolist(), near.tolist(), strict=True):
        whole = terms.index(word) if word in terms else (5 if word.startswith("gross") and len(word) > 5 else -1)
        assert x == whole, word
        almost = {i for i, t in enumerate(terms) if len(t) >= 5 and one_edit(t, word)}
        assert (n in almost) if almost else n == -1, (word, n)


def test_quoted_terms_weigh_less_and_close_ones_more():
    automaton = Automaton([Term("idiot", False, True)])
    filler = " ".join(["plain"] * 40)
    texts = [
        f"{filler} you idiot {filler}",
        f'{filler} he said "you idiot" then {filler}',
        f"{filler} they called him idiot {filler}",
        f"{filler} idiot idiot {filler}",
        f"{filler} idiot {filler} idiot {filler}",
        f"{filler} idoit {filler} idjot {filler}",
        filler,
        "",
    ]
    x = features(automaton, np.array([1.0]), texts)
    plain, quoted, reported, close, apart, misspelled, none, void = x
    assert quoted[0] < plain[0] and reported[0] < plain[0] and quoted[3] > 0 == plain[3]
    assert close[0] == pytest.approx(apart[0]) and close[2] > apart[2] > 0
    assert 0 < misspelled[0] < plain[0] and none[:4].sum() == 0 and void.sum() == 0


def test_regression_separates():
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(400, 2))
    y = (x[:, 0] + 0.1 * rnd.normal(size=400) > 0).astype(float)
    beta = fit_regression(x, y)
    p = 1 / (1 + np.exp(-(beta[0] + x @ beta[1:])))
    assert ((p > 0.5) == (y > 0)).mean() > 0.95
    assert fit_regression(x, np.zeros(400))[0] < 0


def test_held_out_labels_are_predicted(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = train(docs, labels)
    scored = score_documents(docs, model).join(labels, "doc_id").filter("held_out").toPandas()
    toxic, clean = scored[scored.toxic == 1], scored[scored.toxic == 0]
    assert toxic.predicted.mean() > 0.85 and clean.predicted.mean() < 0.02
    # No label of a held-out row, and no other column, has any part in the scores.
    changed = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = score_documents(docs.withColumn("lang", F.lit("xx")), train(docs.drop("lang", "source"), changed))
    assert again.exceptAll(score_documents(docs, model)).count() == 0


def test_toxicity_of_awkward_rows(spark):
    docs = awkward(spark, score=1, toxic="x")
    labels = spark.createDataFrame([(i, 0, None if i == 2 else i % 2) for i in range(8)] + [(None, 1, 1), (3, 0, 0)], "doc_id long, quality int, toxic int")
    model = train(docs, labels)
    out = score_documents(docs, model).collect()
    assert len(out) == 11 and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in out)
    assert {r.held_out for r in out if r.doc_id is None} == {False}
    assert drop_toxic(docs, model).columns == docs.columns
    nothing = train(docs, labels.limit(0))
    assert {r.score for r in score_documents(docs, nothing).collect()} == {0.0} and drop_toxic(docs, nothing).count() == 11
    assert score_documents(empty(spark), model).count() == 0 and train(empty(spark), labels).beta == ()


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="</p><p>no";</script></head><body>
<header class="site">Site name</header><nav><ul><li><a href="/a">{nav}</a><li><a href=/b>B</a></ul></nav>
<!-- <p>comment</p> --><div class="cookie-notice">We use cookies</div><div id="ad-1">Buy {nav}</div>
{main}
<aside>Related</aside><div class="comments"><p>first!</p></div><form><label>Name</label><input name=q></form>
<footer>&copy; Site &middot; {nav}</footer></body></html>"""


def test_articles_are_read_without_their_surroundings(spark):
    rows, expected = [], {}
    for i in range(12):
        body = f"<article><h1>Title &amp; {i}</h1><p>One <b>bold\n  text</b>&nbsp;here<br>{i}<p>Two &lt;{i}&gt; &eacute;<ul><li>x{i}<li>y</ul></article>"
        rows.append((i, "https://A.example.com/x", PAGE.format(nav=f"n{i}", main=body)))
        expected[i] = f"Title & {i}\n\nOne bold text here {i}\n\nTwo <{i}> é\n\nx{i}\n\ny"
    rows += [(20, None, None), (21, "https://b/x", ""), (22, "https://c/", "<p>cut off <a hre"), (23, "no url", "plain & simple")]
    expected |= {20: "", 21: "", 22: "cut off", 23: "plain & simple"}
    pages = spark.createDataFrame(rows + rows[:1], "page_id long, url string, html string").withColumns({"text": F.lit(1), "host": F.lit("z"), "shape": F.lit(2)})
    out = main_text(pages).collect()
    assert len(out) == 17 and {r.page_id: r.text for r in out} == expected
    assert all(r.n_chars == len(r.text) for r in out) and {r.url for r in out if r.page_id == 20} == {None}
    assert main_text(pages.limit(0)).count() == 0


def test_a_host_without_article_elements_shows_its_content_by_what_varies(spark):
    rnd = random.Random(4)
    rows, expected = [], {}
    for i in range(10):
        paragraphs = [" ".join(rnd.choice(["sun", "rain", "snow", "wind"]) for _ in range(20)) + f" {i}.{k}" for k in range(3)]
        content = "".join(f"<p>{p}</p>" for p in paragraphs)
        html = f"<body><div class=top>Always the same line</div><div class=left><div>Fixed</div></div><div class=body><h2>Head {i}</h2>{content}</div><div class=end>Always the end</div></body>"
        rows.append((i, "http://h.example/", html))
        expected[i] = "\n\n".join([f"Head {i}", *paragraphs])
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    assert {r.page_id: r.text for r in main_text(pages).collect()} == expected


def test_a_notice_in_every_article_of_a_host_is_template(spark):
    notice = "Readers like you make this site possible."
    rows, expected = [], {}
    for i in range(10):
        rows.append((i, "http://h.example/", f"<body><article><h1>Head {i}</h1><p>One {i}</p><p>{notice}</p><p>Two {i}</p><div>{notice}</div><h2>Summary</h2><p>End {i}</p></article>"))
        expected[i] = f"Head {i}\n\nOne {i}\n\nTwo {i}\n\nSummary\n\nEnd {i}"
    for i in range(20, 26):  # one page again and again
        rows.append((i, "http://again.example/", "<body><p>Outside</p><article><p>The same</p></article>"))
        expected[i] = "The same"
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    assert {r.page_id: r.text for r in main_text(pages).collect()} == expected


def tree(markup):
    return page_tree(parse(markup).root)


def test_trees_match_simply():
    page = tree("<div><p>a</p><p>b</p><ul><li>c</ul><p>d</p></div>")
    other = tree("<div><p>a</p><ul><li>c<li>e</ul></div><div></div>")
    wrapper = Tree("#page", 0)
    merge(wrapper, page)
    assert wrapper.children[0].children[0].label == "p" and Matching().score(wrapper, page) == 6
    assert Matching().pairs(wrapper.children[0].children, other.children[0].children) == [(0, 0), (1, 1)]
    merge(wrapper, other)
    assert wrapper.pages == 2 and [(c.label, c.pages) for c in wrapper.children[0].children] == [("p", 2), ("ul", 2), ("p", 1)]


def matches(a, b):
    """Simple tree matching by its definition, every alignment of the children tried."""
    if a.label != b.label:
        return 0

    def best(left, right):
        if not left or not right:
            return 0
        skipped = max(best(left[1:], right), best(left, right[1:]))
        both = matches(left[0], right[0])
        return max(skipped, both + best(left[1:], right[1:])) if both else skipped

    return 1 + best(a.children, b.children)


def test_matching_equals_its_definition():
    rnd = random.Random(23)

    def grown(depth):
        return Tree(rnd.choice("ab"), 1, [], [grown(depth - 1) for _ in range(rnd.randrange(4))] if depth else [])

    for _ in range(150):
        a, b = grown(3), grown(3)
        alike = [c.label for c in a.children] == [c.label for c in b.children]  # such rows are paired as they stand
        assert Matching().score(a, b) <= matches(a, b) and (alike or Matching().score(a, a) == matches(a, a))
        merged = Tree(a.label, 0)
        merge(merged, a)
        merge(merged, b)
        assert merged.pages == 2


@pytest.mark.parametrize("slots", [2000, 3])
def test_templates_do_not_depend_on_the_size_of_wrappers(spark, monkeypatch, slots):
    """Random template lines among varying paragraphs on hosts of both kinds; what goes is known from how the pages were made."""
    monkeypatch.setattr(html_text, "WRAPPER_SLOTS", slots)
    rnd = random.Random(29)
    rows, expected = [], {}
    for host in range(4):
        article, n = host % 2 == 0, 0
        top = "".join(f"<p class={c}>Line {c} of host {host}</p>" for c in ("aa", "bb", "cc"))
        for _ in range(12):
            i = len(rows)
            texts = [f"Page {i} text {k} " + " ".join(rnd.choice(["sun", "rain", "snow"]) for _ in range(20)) for k in range(20)]
            notice = f"<p>Read more on host {host}.</p>"
            body = "".join(f"<p>{t}</p>" + (notice if k == n % 20 else "") for k, t in enumerate(texts))
            n += 7
            inner = f"<h1>Title {i}</h1>{body}"
            html = f"{top}<article>{inner}</article><p class=zz>End of host {host}</p>" if article else f"<div>{top}</div><div class=x{'y' * (i % 3)}>{inner}</div>"
            rows.append((i, f"http://h{host}.example/{i}", html))
            expected[i] = "\n\n".join([f"Title {i}", *texts])
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    found = {r.page_id: r.text for r in main_text(pages).collect()}
    inside = {i for i in expected if (i // 12) % 2 == 0}
    assert {i: found[i] for i in inside} == {i: expected[i] for i in inside}
    # Without article elements three classes of the body are three slots of four pages, too few to call a text template.
    for i in set(expected) - inside:
        assert found[i].replace(f"\n\nRead more on host {i // 12}.", "") == expected[i]


def test_a_host_without_article_keeps_titles_and_second_parts(spark):
    page = (
        "<body><div class=top>Site name</div><div class=links><a href=/1>Varying {0}</a><br><a href=/2>Link {0}</a></div>"
        "<div id=content><h1>Title {0}</h1><div class=body><p>First {0} words.</p><p><a href=/x>A paragraph that is a link {0}</a></p></div></div>"
        "<div id=more><p>Second part {0}.</p><ul><li><a href=/y>Reference {0}</a></ul></div><div class=end>Always the end</div></body>"
    )
    assert shown(spark, [page.format(n) for n in range(8)]) == [
        "\n\n".join([f"Title {n}", f"First {n} words.", f"A paragraph that is a link {n}", f"Second part {n}.", f"Reference {n}"]) for n in range(8)
    ]


def test_near_copies_of_an_article_stay_whole(spark):
    shared = "".join(f"<p>Shared paragraph {k} of a story told again.</p>" for k in range(5))
    texts = [f"Shared paragraph {k} of a story told again." for k in range(5)]
    pages = [f"<article><h1>Title</h1>{shared}<p>Ending number {n}.</p></article>" for n in range(6)]
    assert shown(spark, pages) == ["\n\n".join(["Title", *texts, f"Ending number {n}."]) for n in range(6)]


def test_formulas_and_buttons_in_an_article_are_text(spark):
    pages = [f"<article><p>As <math><mi>x</mi><mo>=</mo><mn>{n}</mn></math> shows, press <button>Start {n}</button> now.</p></article>" for n in range(6)]
    assert shown(spark, pages) == [f"As x={n} shows, press Start {n} now." for n in range(6)]


def test_articles_of_comments_and_cards_are_not_the_pages(spark):
    page = (
        "<body class=has-sidebar><article><h1>Title {0}</h1><p>Text {0}.</p><article class=comment><p>Nested remark {0}</p></article></article>"
        "<div class=comments><article><p>A long remark of a reader, number {0}, longer than the text.</p></article></div>"
        "<aside><article><p>Card {0}</p></article></aside></body>"
    )
    assert shown(spark, [page.format(n) for n in range(6)]) == [f"Title {n}\n\nText {n}." for n in range(6)]


def test_a_very_long_page_is_read_whole(spark):
    body = "".join(f"<h2>Head {k}</h2><p>Text {k}.</p>" for k in range(1500))
    pages = [f"<article>{body}</article>", *(f"<article><p>Short {n}.</p></article>" for n in range(5))]
    long, *rest = shown(spark, pages)
    assert long == "\n\n".join(f"Head {k}\n\nText {k}." for k in range(1500)) and rest == [f"Short {n}." for n in range(5)]


def test_a_name_around_a_page_without_article_hides_nothing(spark):
    page = '<body class="has-sidebar"><div id=page class=no-comments><h1>Title {0}</h1><p>Text {0}.</p></div><nav>Menu {0}</nav></body>'
    assert shown(spark, [page.format(n) for n in range(6)]) == [f"Title {n}\n\nText {n}." for n in range(6)]


RULES = (Rule("net", "/", "block"), Rule("example.net", "/en/", "allow"), Rule("example.com", "/de/", "block"), Rule("org", "/fr/", "allow"))


def test_the_longest_rule_decides(spark):
    cases = [
        ("http://a.net/x", "a.net", "/x", "net/", "block"),
        ("https://NET/", "net", "/", "net/", "block"),
        ("http://x.example.net/en/1?q#f", "x.example.net", "/en/1", "example.net/en/", "allow"),
        ("http://example.net/EN/1", "example.net", "/EN/1", "net/", "block"),
        ("http://www.example.com/de/1.html", "www.example.com", "/de/1.html", "example.com/de/", "block"),
        ("http://notexample.com/de/1", "notexample.com", "/de/1", None, "allow"),
        ("http://a.org/fr/", "a.org", "/fr/", "org/fr/", "allow"),
        ("http://a.net", "a.net", "", None, "allow"),
        ("http://a.net?x=/y", "a.net", "", None, "allow"),
        ("nonsense", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("", "", "", None, "allow"),
        ("http://É.Net/a://b", "É.net", "/a://b", "net/", "block"),
    ]
    rows = [(i, c[0], None) for i, c in enumerate(cases)] + [(0, cases[0][0], "<p>"), (None, cases[0][0], "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"host": F.lit(1), "rule": F.lit("r"), "node": F.lit(2)})
    expected = [(r[0], *cases[r[0] or 0][1:]) for r in rows]
    assert tuples(judge_urls(pages, RULES)) == sorted(expected, key=repr)
    assert judge_urls(pages.limit(0), RULES).count() == 0 and judge_urls(pages, ()).filter("verdict = 'block'").count() == 0
    with pytest.raises(ValueError):
        judge_urls(pages, [Rule("a", "/", "maybe")])


def test_blocks_follow_redirects_and_canonical_links(spark):
    link = '<link rel="canonical" href="{}">'.format
    rows = [
        (1, "http://one.example/a", link("https://bad.net/a")),
        (2, "http://two.example/dir/b", link("../x")),
        (3, "https://three.example/c?x=1", '<meta http-equiv="refresh" content="0; url=http://one.example/a">'),
        (4, "http://four.example/d", link("http://good.example.net/en/1")),
        (5, "http://five.example/e", link("http://four.example/d")),
        (6, "http://four.example/d#part", '<META HTTP-EQUIV=refresh CONTENT="5;URL=https://bad.net/a">'),
        (7, "http://seven.example/f/g", "<link href=h rel=canonical>"),
        (8, "http://seven.example/f/h", ""),
        (9, "https://nine.example/", None),
        (10, "http://bad.net/z", link("http://one.example/other")),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    redirects = spark.createDataFrame([("http://seven.example/f/h", "http://x.net/y"), ("http://nine.example", None)], "a string, b string")
    verdicts = {r.page_id: r.verdict for r in judge_urls(pages, RULES, redirects).collect()}
    # 4, 5 and 6 hang together with an allowed alias, and through 6 so do 1 and 3; 7 and 8 redirect into a block.
    assert verdicts == {1: "allow", 2: "allow", 3: "allow", 4: "allow", 5: "allow", 6: "allow", 7: "block", 8: "block", 9: "allow", 10: "block"}
    without = {r.page_id: r.verdict for r in judge_urls(pages.filter("page_id <> 4"), RULES).collect()}
    assert without == {1: "block", 2: "allow", 3: "block", 5: "block", 6: "block", 7: "allow", 8: "allow", 9: "allow", 10: "block"}
    assert sorted(r.page_id for r in keep_allowed(pages, RULES, redirects).collect()) == [1, 2, 3, 4, 5, 6, 9]


LINKS = {
    "http://h.example/d/a.html": [
        ("../c", "http://h.example/c"), ("./x/../y", "http://h.example/d/y"), ("?p=2", "http://h.example/d/a.html?p=2"),
        ("/r/./s/..", "http://h.example/r/"), ("//o.example/z", "http://o.example/z"), ("b?x=1&amp;y=2#f", "http://h.example/d/b?x=1&y=2#f"),
        ("https&#58;//e.example/&#x71;", "https://e.example/q"), ("../../../up", "http://h.example/up"), (" \n", None), ("mailto:a@b", "mailto:a@b"),
    ],
    "odd://h.example/d/a": [("../c", "odd://h.example/c"), ("http://x.example/", "http://x.example/")],
    "http://h.example": [("c", "http://h.example/c")],
}


def test_links_are_resolved_like_a_browser():
    for base, cases in LINKS.items():
        assert [(t, resolve(t, base)) for t, _ in cases] == cases


def test_every_link_that_is_markup_counts(spark):
    """Relative, query-only, second and based links count; links in comments, scripts and other attributes do not."""
    canonical = '<link rel="{}" href="{}">'.format
    rows = [
        (1, "http://one.example/d/a", canonical("canonical", "../bad")),
        (2, "http://one.example/bad", canonical("canonical", "http://x.net/1")),
        (3, "http://three.example/p?q=1", canonical("canonical", "?q=2")),
        (4, "http://three.example/p?q=2", canonical("alternate", "http://four.example/") + canonical("shortcut Canonical", "http://x.net/2")),
        (5, "http://five.example/", canonical("canonical", "http://fine.example/") + "<link href='http://x.net/3' rel=canonical>"),
        (6, "http://six.example/", "<!-- " + canonical("canonical", "http://x.net/4") + " -->" + f"<script>'{canonical('canonical', 'http://x.net/5')}'</script>"),
        (7, "http://seven.example/", '<base href="http://x.net/d/">' + canonical("canonical", "e")),
        (8, "http://eight.example/", "<meta http-equiv=refresh content=\"0; URL='http://x.net/a;b c'\">"),
        (9, "http://nine.example/", '<link title="a > b" data-href="http://x.net/6" rel="canonical" href="/own">'),
        (10, "http://ten.example/", canonical("canonicals", "http://x.net/7") + "<p>" * 20_000),
        (11, "http://eleven.example/", canonical("canonical", "http://[bad/")),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    verdicts = {r.page_id: r.verdict for r in judge_urls(pages, [Rule("net", "/", "block")]).collect()}
    assert {i for i, v in verdicts.items() if v == "block"} == {1, 2, 3, 4, 5, 7, 8}


def test_aliases_equal_a_graph_search(spark):
    """Random links among pages, against a search through the graph with another resolver's nodes."""
    rnd = random.Random(17)
    hosts = ["a.example", "b.example", "c.net", "d.example"]
    urls = [f"http://{rnd.choice(hosts)}/{rnd.choice('xy')}/{n}" for n in range(120)]
    chosen = {n: rnd.sample(range(120), rnd.choice([0, 0, 1, 1, 2])) for n in range(120)}

    def written(n: int, m: int) -> str:
        (host, folder, name), (other, *_) = (urls[i].removeprefix("http://").split("/") for i in (m, n))
        return f"../{folder}/./{name}" if host == other else f"//{host}/{folder}/{name}"

    html = {n: "".join(f'<link rel=canonical href="{written(n, m)}">' for m in links) for n, links in chosen.items()}
    pages = spark.createDataFrame([(n, urls[n], html[n]) for n in range(120)], "page_id long, url string, html string")
    rules = [Rule("net", "/x/", "block"), Rule("a.example", "/y/", "allow")]
    near = {n: set(links) for n, links in chosen.items()}
    for n, links in chosen.items():
        for m in links:
            near[m].add(n)

    def own(n: int) -> str | None:
        return "block" if urls[n].startswith("http://c.net/x/") else "allow" if urls[n].startswith("http://a.example/y/") else None

    expected = {}
    for n in range(120):
        seen, todo = {n}, [n]
        while todo:
            new = near[todo.pop()] - seen
            seen |= new
            todo += new
        rules_met = {own(m) for m in seen}
        expected[n] = own(n) or ("block" if "block" in rules_met and "allow" not in rules_met else "allow")
    assert {r.page_id: r.verdict for r in judge_urls(pages, rules).collect()} == expected
    assert set(expected.values()) == {"allow", "block"}


ARTICLE = "<p>{0} one two three four five six seven.</p><p>{0} eight nine ten eleven twelve.</p>"


def shown(spark, htmls: list[str]) -> list[str]:
    pages = spark.createDataFrame([(i, f"http://h.example/{i}", h) for i, h in enumerate(htmls)], "page_id long, url string, html string")
    return [r.text for r in main_text(pages).orderBy("page_id").collect()]


def test_deep_pages_keep_their_text(spark):
    deep = ["<div>" * n + f"<article><h1>Title {n}</h1><p>Text of {n}.</p></article>" + "</div>" * n for n in (1, 300, 900, 5000)]
    inside = "<article><p>Before.</p>" + "<div>" * 5000 + "<p>Deep.</p>" + "</div>" * 5000 + "<p>After.</p></article>"
    assert shown(spark, [*deep, inside]) == [*(f"Title {n}\n\nText of {n}." for n in (1, 300, 900, 5000)), "Before.\n\nDeep.\n\nAfter."]


@pytest.mark.parametrize(
    "around",
    [
        '<body class="has-sidebar"><nav>menu</nav><article>{}</article></body>',
        '<body><div id="page" class="no-comments"><main>{}</main></div><div class="comments">{}</div></body>',
        '<body><div class="menu-open"><article>{}</article></div></body>',
    ],
)
def test_names_around_an_article_do_not_hide_it(spark, around):
    pages = [around.replace("{}", ARTICLE.format(f"w{n}"), 1).replace("{}", f"<p>comment {n}</p>") for n in range(6)]
    assert shown(spark, pages) == [f"w{n} one two three four five six seven.\n\nw{n} eight nine ten eleven twelve." for n in range(6)]


def test_names_inside_an_article_count_only_as_a_whole(spark):
    parts = [
        '<h2 id="related-work">Related work {}</h2>',
        '<section id="search-methods"><p>Methods {}.</p></section>',
        '<div class="post-header"><h1>Title {}</h1></div>',
        '<div class="notice-board"><p>Board {}.</p></div>',
        '<div class="advert"><p>Buy {}.</p></div>',
        '<div class="big share"><p>Share {}.</p></div>',
    ]
    pages = ["<article>" + "".join(p.format(n) for p in parts) + "</article>" for n in range(6)]
    assert shown(spark, pages) == [f"Related work {n}\n\nMethods {n}.\n\nTitle {n}\n\nBoard {n}." for n in range(6)]
