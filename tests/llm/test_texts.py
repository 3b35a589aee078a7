"""Page extraction and the two classifiers."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import zstandard
from millrace.llm import extraction, langid, quality
from millrace.llm.queries import QUERIES
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.01"
PAGE = "<html><head><title>t</title></head><body>{}</body></html>"
BODY = "<p>The first part of the story, which is long enough.</p><p>And the second one, quite as long as the first.</p>"
STORY = "The first part of the story, which is long enough. And the second one, quite as long as the first."

CASES = {
    "article": (f"<nav><a href=x>menu</a></nav><article><h1>Head</h1>{BODY}</article><footer>foot</footer>", f"Head {STORY}"),
    "plain": (f'<div class="menu"><a href=x>menu</a></div><div id="c"><h1>Head</h1>{BODY}</div><div class="side-bar ad">buy</div>', f"Head {STORY}"),
    "links": (f"<ul>{'<li><a href=x>another story to read now</a></li>' * 9}</ul><div>{BODY * 3}</div>", " ".join([STORY] * 3)),
    "raw": ('<article><script>var a = "</p>" < 3;</script><style>p > b {}</style><p>x</p><!-- <p>no</p> --></article>', "x"),
    "entities": ("<article><p>a &amp; b&nbsp;&lt;c&gt; &eacute;&#233;&#xe9; &amp;amp; &unknown; &copy</p></article>", "a & b <c> ééé &amp; &unknown; ©"),
    "inline": ("<article><p>wo<b>rd</b>s<br>and\n\n <i>more</i></p>text</article>", "words and more text"),
    "open": ("<article><p><b>one<br><p>two<ul><li>three<li>four</ul><table><tr><td>a<td>b<tr><td>c</table>", "one two three four a b c"),
    "inside": ('<article><header><h1>H</h1></header><p>x</p><form>f</form><aside>s</aside><div class="share-buttons">t</div>'
               '<section id="comments"><article>reader</article></section></article>', "H x"),
    "hidden": ('<article><p hidden>a</p><p style="display: none">b</p><p aria-hidden="true">c</p><p>d</p></article>', "d"),
    "names": ('<div class="layout with-sidebar"><article class="post related"><p>x</p></article></div>', "x"),
    "several": (f"<article><p>short</p></article><article>{BODY}</article>", STORY),
    "cut": ("<article><p>text that is <b>cut</b> &am", "text that is cut &am"),
    "none": ("<nav>only a menu</nav>", ""),
    "no markup": ("just words < 3 & more", "just words < 3 & more"),
}


@pytest.mark.parametrize("name", CASES)
def test_main_text(name):
    body, text = CASES[name]
    assert extraction.main_text(body if name in ("no markup", "cut", "open") else PAGE.format(body)) == text


MARKED = {
    "comments": f'<div class="story"><h1>Head</h1>{BODY * 2}</div><section id="comments">{"<article><p>One reader wrote this.</p></article>" * 9}</section>',
    "thread": f'<div class="story"><h1>Head</h1>{BODY * 2}</div><div class="thread">{"<article><p>One reader wrote this.</p></article>" * 20}</div>',
    "teasers": f'<div class="story"><h1>Head</h1>{BODY * 2}<article><p>Read this too, it is a teaser.</p></article></div>'
               '<article class="teaser"><p>And this one, which is about as long as a paragraph of the story is.</p></article>',
    "main": f'<main><h1>Head</h1><div>{BODY * 2}</div><article><p>Read this too, it is a teaser.</p></article></main>',
    "other boxes": f'<div class="related">{"<article><p>Another story, which is quite long here.</p></article>" * 3}</div><h1>Head</h1><div>{BODY * 2}</div>',
}


@pytest.mark.parametrize("name", MARKED)
def test_a_story_beside_articles(name):
    got = extraction.main_text(PAGE.format(MARKED[name]))
    assert f"{STORY} {STORY}" in got and got.removeprefix("Head ") == f"{STORY} {STORY}"


@pytest.mark.parametrize("name", [*CASES, *MARKED])
def test_densities_choose_on_every_page(name, monkeypatch):
    ran, real = [], extraction._dense
    monkeypatch.setattr(extraction, "_dense", lambda body: ran.append(1) or real(body))
    extraction.main_text(PAGE.format((CASES | {k: (v, "") for k, v in MARKED.items()})[name][0]))
    assert ran == [1]


@pytest.mark.parametrize("tag", ["article", "div", "td", "section"])
def test_headlines_stay_where_paragraphs_are_divs(tag):
    paragraphs = BODY.replace("<p>", "<div>").replace("</p>", "</div>")
    page = f"<nav><a href=x>menu</a></nav><{tag}><h1>Head</h1><div>{paragraphs * 4}</div><h2>Sub</h2>{paragraphs}</{tag}><div class=ad>buy</div>"
    want = "Head " + " ".join([STORY] * 4) + f" Sub {STORY}"
    assert extraction.main_text(PAGE.format(page)) == want


WORK = "<p>Others have looked into this before, at some length.</p><p>None of them went as far as we do here, it seems.</p>"
NAMED = {
    "slugs": (f'<article><h1>Head</h1>{BODY}<section id="related-work"><h2 id="search-results">Work</h2>{WORK}</section>'
              f'<div id="social-history">{WORK}</div><h2 id="comments">Last</h2><section id="search"><p>x</p></section></article>',
              f"Head {STORY} Work {{0}} {{0}} Last x"),
    "form": (f'<form id="aspnetForm" action="x"><input name=v><nav>menu</nav><h1>Head</h1>{BODY}</form>', f"Head {STORY}"),
    "form in an article": (f"<article>{BODY}<form>Send us your mail address</form></article>", STORY),
    "dense box": (f'<article>{BODY}<div class="notice">{WORK}</div></article>', f"{STORY} {{0}}"),
    "boxes": (f'<div class="story">{BODY * 3}</div><div class="cookie-notice">We use cookies</div><div class="widget links"><a href=x>a link to follow</a></div>'
              f'<section id="comments">{WORK}</section><div class="related-posts">{WORK}</div>', " ".join([STORY] * 3)),
    "only comments": (f'<div class="comments">{WORK}</div><nav>menu</nav>', "{0}"),
    "most of the page": (f'<div class="content sidebar-left"><div>{BODY}</div></div><footer>foot</footer>', STORY),
}


@pytest.mark.parametrize("name", NAMED)
def test_names_alone_drop_nothing(name):
    body, text = NAMED[name]
    work = "Others have looked into this before, at some length. None of them went as far as we do here, it seems."
    assert extraction.main_text(PAGE.format(body)) == text.format(work)


def test_pages(spark):
    long = "<article>" + "<p>" + "word " * 100_000 + "</p></article>"
    nested = "<div>" * 5000 + "<p>deep text</p>"
    rows = [(1, "u", None), (2, None, ""), (None, "u", CASES["article"][0]), (4, "u", long), (5, "u", nested), (5, "u", nested)]
    pages = spark.createDataFrame([(*r, "x", 9) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = [tuple(r) for r in extraction.extract(pages).collect()]
    words = ("word " * 100_000).strip()
    texts = ["", "", f"Head {STORY}", words, "deep text", "deep text"]
    assert got == [(i, u, t, len(t)) for (i, u, _), t in zip(rows, texts, strict=True)]
    assert extraction.extract(pages.limit(0)).collect() == []


def test_density_of_link_lists_is_low():
    root = extraction.parse(f"<body><ul>{'<li><a href=x>a link to follow</a></li>' * 5}</ul><div>{BODY}</div></body>")
    body = next(n for n in extraction._walk(root) if n.tag == "body")
    extraction._measure(body)
    lists, text = body.children()
    assert lists.density < text.density and body.total == pytest.approx(lists.density + text.density)


def test_quality_on_held_out_documents(spark):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    got = QUERIES["op7_quality_by_compression"](spark, SF_DIR).join(labels, "doc_id").where("held_out").collect()
    right = {v: np.mean([r["predicted"] == v for r in got if r["quality"] == v]) for v in (0, 1)}
    assert right[1] >= 0.95 and right[0] >= 0.85  # of 19 bad ones here
    assert all(0 <= r["score"] <= 1 for r in got)


def test_quality_learns_nothing_from_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{n}.parquet") for n in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    noise = docs.withColumn("lang", F.lit("x")).withColumn("source", F.lit(None).cast("string"))
    scores = [quality.classify(d, quality.train(d, b)).orderBy("doc_id").collect() for d, b in ((docs, labels), (noise, turned))]
    assert scores[0] == scores[1]


@pytest.fixture(scope="module")
def quality_model():
    rng = random.Random(9)
    words = [rng.choice("bcdfglmnprst") + rng.choice("aeiou") + rng.choice("nrst") + rng.choice(["", "ing", "ed"]) for _ in range(400)]
    good = [" ".join(rng.choice(words) for _ in range(n)) + "." for n in [2, 5] + [rng.randrange(20, 300) for _ in range(200)]]
    bad = [" ".join(rng.choice(words) + "!!!$$" for _ in range(rng.randrange(20, 300))) for _ in range(40)]
    return quality.fit([g.encode() for g in good], [b.encode() for b in bad], 0.8), good, bad


def test_quality_of_a_few_bytes_is_the_share_of_good_at_most(quality_model):
    model, _, bad = quality_model
    short = [b[:n] for b in bad for n in (1, 2, 5, 10, 20, 40)] + ["a", "!!!", "buy now", " ", "\n", "é", "日本", "0" * 40]
    scores = model.score(short)
    assert scores.max() <= 0.8 + 1e-12 and scores.min() > 0
    # What speaks against a text counts more, the more of it there is.
    means = [np.mean(model.score([b[:n] for b in bad])) for n in (1, 10, 40, 100, 400)]
    assert means == sorted(means, reverse=True) and means[-1] < 0.2


def test_quality_score_by_its_definition(quality_model):
    model, good, bad = quality_model
    for text in [*good[:20], *bad[:20], "a", "x" * 64, "y" * 100, "long " * 30_000]:
        raw = text.encode()
        pieces = [raw[k : k + 512] for k in range(0, len(raw), 512)]
        sizes = []
        for content in (model.good, model.bad, None):
            options = {"dict_data": zstandard.ZstdCompressionDict(content), "write_dict_id": False} if content else {}
            by = zstandard.ZstdCompressor(level=3, write_content_size=False, **options)
            sizes.append(sum(len(by.compress(p)) for p in pieces))
        a, b, c = sizes
        x = [(a - b) / (a + b), min(1, c / len(raw)), max(len(raw), 64) ** -0.5]
        raised = sum(w * (v - m) / s for w, v, m, s in zip(model.weights, x, model.middle, model.spread)) + model.weights[-1]
        found = 1 / (1 + math.exp(-max(-40, min(40, raised))))
        part = len(raw) / (len(raw) + 64) if found < 0.8 else max(0, min(1, (len(raw) - 64) / 192))
        assert model.score([text])[0] == pytest.approx(0.8 + (found - 0.8) * part, abs=1e-9)


@pytest.mark.parametrize("labelled", [[], [(1, 1)], [(1, 1), (2, 1)], [(None, 1), (1, None), (2, 7)]])
def test_quality_of_odd_rows_with_few_labels(spark, labelled):
    docs = spark.createDataFrame(
        [(1, "good text", 0.1, 3), (2, None, 0.1, 3), (None, "", 0.1, 3), (3, "a" * 200_000, 0.1, 3), (3, "a", 0.1, 3)],
        "doc_id long, text string, score double, predicted int",
    )
    labels = spark.createDataFrame(labelled, "doc_id long, quality int")
    model = quality.train(docs, labels)
    got = quality.classify(docs, model).collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got)
    assert [r["score"] for r in got[1:3]] == [0, 0] and not got[2]["held_out"]
    assert quality.classify(docs.limit(0), model).collect() == []


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op8_identify_language"](spark, SF_DIR).join(docs, "doc_id").where("held_out").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in got]) >= 0.98
    assert not any(r["rejected"] for r in got)


def test_language_of_odd_rows(spark):
    texts = {"en": "the house of the man and the thing that was there", "de": "das Haus und der Mann schön größer über nicht"}
    rows = [(k, texts[("en", "de")[k % 2]] + f" {'abcdefgh'[k % 8]}", ("en", "de")[k % 2], 0.3) for k in range(60)]
    docs = spark.createDataFrame([*rows, (None, "x", None, 0.1)], "doc_id long, text string, lang string, score double")
    models = langid.train(docs)
    odd = spark.createDataFrame(
        [(1, None), (2, ""), (3, "12 !?"), (4, "der Mann und das Haus"), (5, "Привет, как дела? " * 9), (None, "the man " * 50_000)],
        "doc_id long, text string",
    )
    got = langid.classify(odd, models).collect()
    assert [r["lang_pred"] for r in got[:4]] == ["und", "und", "und", "de"] and got[5]["lang_pred"] == "en"
    assert [r["rejected"] for r in got] == [True, True, True, False, True, False]
    assert all(0 <= r["score"] <= 1 for r in got) and not got[5]["held_out"]
    assert langid.classify(odd.limit(0), models).collect() == []
    nothing = langid.train(docs.where("lang = 'none'"))
    assert {r["lang_pred"] for r in langid.classify(odd, nothing).collect()} == {"und"}


def test_every_language_is_learnt(spark):
    """Rare ones among many, and one that has only long texts, begun by a table."""
    rng = random.Random(3)
    words = {f"l{k:02}": ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(40)] for k in range(70)}
    rows = [(k * 100 + n, " ".join(rng.choices(own, k=30)), name) for k, (name, own) in enumerate(words.items()) for n in range(8 + (k < 64))]
    long = ["".join(rng.choice("абвгдежзиклмнопрст") for _ in range(6)) for _ in range(40)]
    rows += [(10**6 + n, "12.5 | " * 5_000 + " ".join(rng.choices(long, k=5_000)), "long") for n in range(8)]
    models = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert models.languages == ["l%02d" % k for k in range(70)] + ["long"]
    asked = [(k, " ".join(rng.choices(own, k=30))) for k, own in enumerate([*words.values(), long])]
    got = langid.classify(spark.createDataFrame(asked, "doc_id long, text string"), models).orderBy("doc_id").collect()
    assert [r["lang_pred"] for r in got] == models.languages


def test_many_languages_share_a_bounded_sample():
    assert [langid.docs_of_each(n) for n in (0, 4, 16, 32, 10**5)] == [600, 600, 600, 300, 25]


def test_languages_in_several_arrays(monkeypatch):
    rng = random.Random(8)
    words = {f"l{k}": Counter("".join(rng.choice("abcdefgh"[k:]) for _ in range(4)) for _ in range(200)) for k in range(5)}
    tried = [*words["l0"], "zzz", "abz"]
    logs = []
    for together in (8, 2):
        monkeypatch.setattr(langid, "TOGETHER", together)
        logs.append(langid.learn(words).log_probabilities(tried)[0])
    assert logs[0] == pytest.approx(logs[1], rel=1e-5)


def kneser_ney(words, alphabet):
    """The same model one gram at a time, with dictionaries."""
    order, raw, before = langid.ORDER, Counter(), defaultdict(set)
    for word, times in words.items():
        text = "^" + word + "$"
        for end in range(1, len(text)):
            for k in range(1, order + 1):
                if end - k + 1 >= 0:
                    raw[text[end - k + 1 : end + 1]] += times
                    if end - k >= 0:
                        before[text[end - k + 1 : end + 1]].add(text[end - k])
    count = {g: raw[g] if len(g) == order or not before[g] else len(before[g]) for g in raw}
    followers = defaultdict(dict)
    for gram, n in count.items():
        followers[gram[:-1]][gram[-1]] = n
    def probability(context, char):
        lower = probability(context[1:], char) if context else 1 / alphabet
        seen = followers.get(context)
        if not seen:
            return lower
        total = sum(seen.values())
        own = max(seen.get(char, 0) - langid.DISCOUNT, 0) if char in seen else 0
        return (own + langid.DISCOUNT * len(seen) * lower) / total

    return probability


def test_kneser_ney_against_dictionaries():
    rng = random.Random(5)
    words = {name: Counter("".join(rng.choice(letters) for _ in range(rng.randrange(1, 8))) for _ in range(300))
             for name, letters in (("a", "abcde"), ("b", "cdefg"))}
    models = langid.learn(words)
    tried = [*list(words["a"])[:40], *list(words["b"])[:40], "zzz", "abz", "gfedcba", "e"]
    logs, lengths = models.log_probabilities(tried)
    # The characters of all languages, the edge, and one for what none has seen.
    alphabet = len({c for w in [*words["a"], *words["b"]] for c in w}) + 2
    for j, name in enumerate(models.languages):
        probability = kneser_ney(words[name], alphabet)
        for word, found in zip(tried, logs[:, j], strict=True):
            text, want = "^" + word + "$", 0.0
            for end in range(1, len(text)):
                want += math.log(probability(text[max(0, end - langid.ORDER + 1) : end], text[end]))
            assert found == pytest.approx(want, rel=1e-4), (name, word)
    assert lengths.tolist() == [len(w) + 1 for w in tried]
