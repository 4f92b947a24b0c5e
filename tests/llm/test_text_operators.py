"""Quality, toxicity, language, page text: edge cases, methods against brute force, held-out accuracy."""

import itertools
import random
import time

import numpy as np
import pytest

from caregauge.llm import html_text, langid, quality, toxicity
from caregauge.llm.common import table

SF = "/root/testdata/sf0.01"
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "a" * 300_000), (5, "Zwei Wörter"), (5, "Zwei Wörter"), (None, "no id"), (6, "\0\n\0")]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "x", "s", 1, 0.5) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double")


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(3)
    lines_of = np.array([1, 4, 3])
    unary, t = rng.normal(size=8), rng.normal(size=(2, 2))
    got = quality._sigmoid(sum(quality.forward_backward(unary, lines_of, t)))
    want, at = [], 0
    for n in lines_of:
        u = unary[at : at + n]
        weight = {
            ys: np.exp(sum(u[k] * y for k, y in enumerate(ys)) + sum(t[a, b] for a, b in zip(ys, ys[1:], strict=False)))
            for ys in itertools.product((0, 1), repeat=int(n))
        }
        want += [sum(w for ys, w in weight.items() if ys[k]) / sum(weight.values()) for k in range(n)]
        at += n
    assert np.allclose(got, want)


def test_line_features_of_each_line():
    own, size, lines_of = quality.line_features(["Ab ab ab\n\nXYZ 12!", "", None or "x"])
    assert lines_of.tolist() == [3, 1, 1]
    assert size.tolist() == [8, 0, 7, 0, 1]
    assert own[0, 8] == pytest.approx(1.0)  # one word of three repeats the one before
    assert own[2, 2] == 1.0 and own[3, 3] == 0.0
    before, after = quality.with_neighbours(own, lines_of)[:, 13:26], quality.with_neighbours(own, lines_of)[:, 26:]
    assert (before[[0, 3, 4]] == 0).all() and (after[[2, 3, 4]] == 0).all()
    assert (before[1] == own[0]).all() and (after[1] == own[2]).all()


def test_quality_of_held_out_documents(spark):
    documents, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = quality.learned(documents, labels, 4, 2)
    got = {r["doc_id"]: r["score"] for r in quality.scored(documents, model).collect()}
    held = [(r["quality"], got[r["doc_id"]]) for r in labels.where("crc32(cast(doc_id as string)) % 4 = 2").collect()]
    assert sum((s >= 0.7) == bool(y) for y, s in held) >= 0.97 * len(held)


def test_scores_don_t_depend_on_batches(spark, odd):
    documents, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = quality.learned(documents, labels, 4, 2)
    texts = [t for _, t in ODD] + ["One line.", "Two\nlines here."]
    together = quality.score_texts(texts, model)
    assert np.allclose(together, [quality.score_texts([t], model)[0] for t in texts])


@pytest.mark.parametrize("rows", ["odd", "none"])
def test_odd_rows(spark, odd, rows):
    docs = odd if rows == "odd" else odd.limit(0)
    n = len(ODD) if rows == "odd" else 0
    labels = spark.createDataFrame([(2, 0, 1), (5, 1, 0), (5, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for kept in (quality.scored(docs, quality.learned(docs, labels, 4, 9)), toxicity.scored(docs, toxicity.learned(docs, labels, 5, 9))):
        got = kept.collect()
        assert len(got) == n and all(0 <= r["score"] <= 1 for r in got)
        assert len({r["score"] for r in got if r["doc_id"] == 5}) <= 1
    got = langid.predicted(docs, langid.learned(docs, 5, 9)).collect()
    assert len(got) == n
    assert {r["lang_pred"] for r in got if r["doc_id"] in (1, 2, 3, 6)} <= {"und"}
    pages = docs.withColumnRenamed("text", "html").selectExpr("*", "html AS text")
    got = html_text.extracted(pages, ("doc_id",)).collect()
    assert len(got) == n and all(r["text"] is not None for r in got)


def test_no_labels_give_a_constant_score(spark, odd):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.learned(odd, labels, 4, 2) is None
    assert {r["score"] for r in quality.scored(odd, None).collect()} == {0.5}
    assert toxicity.learned(odd, labels, 5, 0)["stems"] == {}


def test_toxicity_folds_and_excepts():
    model = {"stems": {"idiot": 5.0, "trash": 4.0}, "exceptions": frozenset(["trash can"]), "curve": np.array([1.0, 1.0, -3.0])}
    machine = toxicity._matcher(model)
    measure = lambda *t: toxicity._measures(list(t), model, machine)[:, 0]
    same = measure("you idiot", "you 1D10T!", "you іdіоt", "you id​iot", "you idiots")
    assert (same == same[0]).all() and same[0] > 0
    assert measure("the trash can", "no", None, "videodiot")[:].tolist() == [0, 0, 0, 0]
    assert measure("trash talk")[0] == pytest.approx(np.log1p(4.0))
    assert measure("idiot idiot")[0] == pytest.approx(np.log1p(10.0))


def test_toxicity_folds_styled_letters_ligatures_and_accents():
    model = {"stems": {"idiot": 5.0, "filth": 4.0, "übel": 3.0}, "exceptions": frozenset(), "curve": np.array([1.0, 1.0, -3.0])}
    machine = toxicity._matcher(model)
    measure = lambda *t: toxicity._measures(list(t), model, machine)
    styled = ["".join(chr(first + ord(c) - ord("a")) for c in "idiot") for first in (0x1D41A, 0x1D4EA, 0x1D5BA, 0x1F130, 0x1F150, 0x1F170, 0x249C, 0x24D0)]
    same = measure("you idiot", *(f"you {x}" for x in styled), "you \u00eddi\u00f3t", "you i\u0301dio\u0301t", "you \u0407diot", "you i\ufe0fdiot")
    assert (same == same[0]).all() and same[0, 0] > 0
    assert (measure("\ufb01lth, \ufb01lthy", "filth, filthy")[:, 0] == np.log1p(8.0)).all()
    assert measure("\u00fcbel", "u\u0308bel", "ubel", "\U0001f600idiot")[:, 0].tolist() == pytest.approx([np.log1p(3.0)] * 2 + [0.0, np.log1p(5.0)])


def test_toxicity_matches_are_those_of_every_word():
    rng = random.Random(5)
    model = {"stems": {"ab": 2.0, "abc": 3.0, "ca": 1.0}, "exceptions": frozenset(), "curve": np.zeros(3)}
    machine = toxicity._matcher(model)
    texts = ["".join(rng.choice("abc 0-") for _ in range(rng.randint(0, 60))) for _ in range(300)]
    for text, got in zip(texts, toxicity._measures(texts, model, machine)[:, 0], strict=True):
        words = toxicity.folded_words(text)
        want = sum(max((v for k, v in model["stems"].items() if w.startswith(k)), default=0) for w in words)
        assert got == pytest.approx(np.log1p(want))


def test_toxicity_of_held_out_documents(spark):
    documents, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = toxicity.learned(documents, labels, 5, 0)
    got = {r["doc_id"]: r["score"] for r in toxicity.scored(documents, model).collect()}
    held = [(r["toxic"], got[r["doc_id"]]) for r in labels.where("crc32(cast(doc_id as string)) % 5 = 0").collect()]
    assert sum((s >= 0.5) == bool(y) for y, s in held) >= 0.95 * len(held)


def test_toxicity_does_not_depend_on_the_labels_ratio(spark):
    """The same rates of a word under each label: the same lexicon and nearly the same scores, whatever the ratio."""
    rng = random.Random(21)
    plain = ["".join(rng.choice("bcdfgklmnprs") + rng.choice("aeiou") for _ in range(3)) for _ in range(300)]
    said = lambda: " ".join(rng.choices(plain, k=30))
    toxic = [f"{said()} vermin {said()}" for _ in range(60)]
    clean = [f"{said()} vermin control {said()}" if k % 30 == 0 else said() for k in range(1200)]
    models = []
    for n in (60, 1200):
        texts = toxic + clean[:n]
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        labels = spark.createDataFrame([(k, int(k < 60)) for k in range(len(texts))], "doc_id long, toxic int")
        models.append(toxicity.learned(docs, labels, 5, 9))
    asked = spark.createDataFrame([(1, toxic[0]), (2, clean[1]), (3, None)], "doc_id long, text string")
    scores = [[r["score"] for r in toxicity.scored(asked, m).orderBy("doc_id").collect()] for m in models]
    assert [[x >= 0.5 for x in row] for row in scores] == [[True, False, False]] * 2
    assert np.allclose(*scores, atol=0.1)
    assert [set(m["stems"]) for m in models] == [{"vermin"}] * 2
    assert "vermin control" in models[1]["exceptions"]


def test_toxicity_neighbours_are_whole_words():
    model = {"stems": {"trash": 4.0}, "exceptions": frozenset(), "curve": np.zeros(3)}
    long = "x" * 200
    found, words = toxicity.matches([f"{long} trash {long}y", "trash", "no", "a trash"], model, toxicity._matcher(model))
    assert [(k, b, w, a) for k, b, w, a, _ in found] == [(0, long, "trash", long + "y"), (1, "", "trash", ""), (3, "a", "trash", "")]
    assert words.tolist() == [3, 1, 1, 2]


def phrases(text: str, sample: str) -> int:
    """Cross-parsing by looking pieces up in the sample."""
    at = count = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in sample:
            size += 1
        at, count = at + size, count + 1
    return count


def test_cross_parsing_equals_search_in_the_sample():
    rng = random.Random(11)
    samples = {k: "".join(rng.choice(a) for _ in range(400)) for k, a in (("x", "abca "), ("y", "bcde "))}
    parser = langid.CrossParser(samples)
    texts = ["".join(rng.choice("abcdez ,") for _ in range(rng.randint(1, 400))) for _ in range(60)]
    got = parser._phrases(texts)
    plain = lambda t: "".join(map(chr, langid.letters([t])[0][:-1]))
    for text, row in zip(texts, got, strict=True):
        assert row.tolist() == [phrases(plain(text), plain(samples[k])) for k in parser.languages]


def test_cross_parsing_of_many_scripts():
    """Hundreds of rare letters in each sample: all are told apart, and unseen ones are phrases."""
    rng = random.Random(12)
    ranges = {"ja": (0x4E00, 700), "zh": (0x4E00 + 700, 900), "ko": (0xAC00, 800), "el": (0x3B1, 25), "und2": (0x561, 38)}
    draw = lambda k, n: "".join(chr(ranges[k][0] + int(rng.random() ** 2 * ranges[k][1])) if rng.random() < 0.8 else " " for _ in range(n))
    samples = {k: draw(k, 3000) for k in ranges}
    parser = langid.CrossParser(samples)
    texts = [draw(k, 200) for k in ranges] + [samples[k][500:900] for k in ranges] + ["\u0e01\u0e02 \u0e03" * 30]
    got = parser._phrases(texts)
    plain = lambda t: "".join(map(chr, langid.letters([t])[0][:-1]))
    for text, row in zip(texts, got, strict=True):
        assert row.tolist() == [phrases(plain(text), plain(samples[k])) for k in parser.languages]
    best = [parser.languages[b] for b in parser.bits(texts).argmin(axis=1)]
    assert best[:10] == [*ranges, *ranges]


def test_long_texts_are_walked_in_chunks():
    parser = langid.CrossParser({"x": "abab " * 50, "y": "cdcd " * 50})
    long = "abab " * 5000
    one, two = parser.bits([long]), parser.bits(["cdcd", long])
    assert (one[0] == two[1]).all() and one[0, 0] < one[0, 1] and two[0, 1] < two[0, 0]


@pytest.mark.parametrize("small", ["abc", "the and of that is", "zq xk jw " * 30, None])
def test_a_small_sample_takes_no_document(spark, small):
    """A language of 3, 30 or 300 characters beside full ones changes no other prediction."""
    df = table(spark, SF, "documents").where("text IS NOT NULL")
    samples = langid.learned(df, 5, 0)
    texts = [r["text"] for r in df.select("text").collect()]
    full = langid.CrossParser(samples)
    more = langid.CrossParser({**samples, "xx": small or texts[0][:300]})
    assert [full.languages[k] for k in full.bits(texts).argmin(axis=1)] == [more.languages[k] for k in more.bits(texts).argmin(axis=1)]


def test_phrases_go_on_over_walks(monkeypatch):
    text = " ".join(" ".join(random.Random(k).choices(["ab", "abra", "cad", "bra", "dab", "é"], k=2000)) for k in range(3))
    parser = langid.CrossParser({"x": "abra cadabra dab bra", "y": "cad cad abra"})
    whole = [text, text[:700], "ab", text[:100]]
    monkeypatch.setattr(langid, "CHUNK", 10**6)
    want = parser._phrases(whole)
    for chunk in (3, 64, 512):
        monkeypatch.setattr(langid, "CHUNK", chunk)
        assert (parser._phrases(whole) == want).all()


def test_more_languages_than_are_learned(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 3)
    rows = [(k, f"wort {k} " * 5, ["de", "en", "fr"][k % 3] if k < 90 else f"junk{k}") for k in range(130)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(langid.learned(df, 5, 0)) == ["de", "en", "fr"]


def test_signs_beyond_the_basic_plane_are_no_letters():
    points, _ = langid.letters(["a\U0001f600b \U00010400\U0001d5d4"])
    assert "".join(map(chr, points)) == "a b \U00010400\U0001d5d4\0"


def test_language_of_held_out_documents(spark):
    documents = table(spark, SF, "documents")
    got = langid.predicted(documents, langid.learned(documents, 5, 0), ("doc_id", "lang")).where("crc32(cast(doc_id as string)) % 5 = 0").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.97 * len(got)


PAGE = """<html><head><title>T</title><script>var a="<p>x</p>"</script></head><body>
<nav><ul><li><a href=1>Home page</a><li><a href=2>News of today.</a></ul></nav><div class="cookie-notice"><p>We use cookies, as all do. Accept them.</p></div>
<main><article><h1>A title of the article, long enough</h1><p>First &eacute;t&eacute; paragraph, with <b>bold</b> text.<br>And   a line.
<p>Second one &lt;here&gt;, it goes on, and on. And <a href=3>a link</a> within.</p><aside>Related things, many.</aside><!-- hidden, text. -->
<form><p>Your mail, please.</p></form></article><div id="comments"><p>A reader says, nice. Very nice, indeed.</p></div></main><footer>Contact, imprint. All rights.</footer></body></html>"""


def test_page_text():
    assert html_text.main_text(PAGE) == (
        "A title of the article, long enough First été paragraph, with bold text. And a line. "
        "Second one <here>, it goes on, and on. And a link within."
    )


@pytest.mark.parametrize(
    ("page", "text"),
    [(None, ""), ("", ""), ("plain text", "plain text"), ("<p>a<p>b</div></p>c", "a b c"), ("<script>x", ""), ("<p>1 < 2 &amp; 3", "1 < 2 & 3"), ("<nav>x</nav>", "")],
)
def test_odd_pages(page, text):
    assert html_text.main_text(page) == text


LONG = "A paragraph of the article, which goes on, and on. " * 12
BESIDE = '<nav><a href=1>Home</a></nav><div class="sidebar"><p>Other news, of today.</p></div>'


@pytest.mark.parametrize(
    "wrapper",
    ['div class="content has-sidebar"', 'div class="post comments-open"', 'section id="search-results-article"', 'div class="share-price-story"', "form"],
)
def test_names_of_a_wrapper_don_t_empty_the_page(wrapper):
    page = f"<body>{BESIDE}<{wrapper}><h1>The title</h1><p>{LONG}<p>{LONG}</p></{wrapper.split()[0]}></body>"
    assert html_text.main_text(page) == f"The title {LONG}{LONG}".strip()


def test_names_of_all_sections_don_t_empty_the_page():
    page = "<body>" + BESIDE + "".join(f'<section class="notice"><p>{k}: {LONG}</p></section>' for k in range(10)) + "</body>"
    assert html_text.main_text(page) == "".join(f"{k}: {LONG}" for k in range(10)).strip()


def test_short_names_beside_a_short_article():
    assert html_text.main_text('<div class="ad">Buy this now, it is very cheap.</div><article><p>Short.</p></article>') == "Short."


ITEMS = [f"item number {k} of the list" for k in range(12)]


@pytest.mark.parametrize(
    ("part", "text"),
    [
        ("<ul>" + "".join(f"<li>{x}" for x in ITEMS) + "</ul>", " ".join(ITEMS)),
        ("<table>" + "".join(f"<tr><td>cell {k}<td>{k * k}</tr>" for k in range(10)) + "</table>", " ".join(f"cell {k} {k * k}" for k in range(10))),
        ("<pre>x = 1</pre><div><code>y = 2</code></div>", "x = 1 y = 2"),
        ("<blockquote>" + "".join(f"<div>verse {k}</div>" for k in range(8)) + "</blockquote>", " ".join(f"verse {k}" for k in range(8))),
    ],
)
def test_short_blocks_of_the_article_stay(part, text):
    page = f"<body><div><a href=1>Home</a></div><div><h1>Title</h1>{f'<p>{LONG}' * 5}{part}{f'<p>{LONG}' * 5}</div><div><a href=2>Imprint</a></div></body>"
    got = html_text.main_text(page)
    assert got == f"Title {LONG * 5}{text} {LONG * 5}".strip()


def test_heading_before_very_long_paragraphs():
    page = f"<body><h1>Title</h1><div>{f'<p>{LONG * 20}' * 30}</div></body>"
    assert html_text.main_text(page) == f"Title {LONG * 600}".strip()


SAID = "".join(f"<p>Paragraph {k} tells, with commas and stops, of the matter at hand; it goes on for a while.</p>" for k in range(8))
REPLIES = "".join(f"<div class='c'><b>User{k}</b> <span>May {k}</span><p>I think that this is fine, really; well said, thanks. It is so.</p></div>" for k in range(7))


@pytest.mark.parametrize(
    "page",
    [
        f"<h1>Title</h1><div class='post'>{SAID}</div><div class='comments'>{REPLIES}</div>",
        f"<div class='post'>{SAID}</div><div class='comments'>{REPLIES}</div>",
        f"<article><h1>Title</h1>{SAID}<section id='comments'>{REPLIES}</section></article>",
        f"<main><h1>Title</h1>{SAID}<div class='comments-area'>{REPLIES}</div></main>",
        f"<div class='cookie-consent'>{REPLIES}</div><article><h1>Title</h1><p>Paragraph of a short article.</p></article>",
        f"<div class='wrap'><h1>Title</h1>{SAID}</div><div class='sidebar'>{REPLIES}</div>",
        f"<div class='content has-sidebar'>{SAID}</div>",
        f"<div class='comments'><h1>Comments on the law</h1>{SAID}</div>",
    ],
)
def test_readers_and_side_matter_go_whatever_their_size(page):
    text = html_text.main_text(f"<html><body>{page}</body></html>")
    assert "I think" not in text and text.count("Paragraph") == page.count("Paragraph")


def test_deep_page_with_stray_end_tags_takes_linear_time():
    begin = time.monotonic()
    assert html_text.main_text("<div>" * 40_000 + "</x>" * 40_000 + "text") == "text"
    assert time.monotonic() - begin < 4


def test_hostile_page_takes_linear_time():
    assert html_text.main_text("<p " * 200_000) is not None
    assert html_text.main_text('<a "' * 100_000) is not None


def test_articles_of_the_pages(spark):
    pages, documents = table(spark, SF, "pages"), table(spark, SF, "documents")
    texts = {r["doc_id"]: "".join(r["text"].split()) for r in documents.collect()}
    got = html_text.extracted(pages).collect()
    named = [(r["text"], int(m)) for r in got if (m := r["url"].split("#")[0].split("?")[0].rstrip("/").rsplit("/", 1)[-1]).isdigit()]
    known = [("".join(t.split()), texts[k]) for t, k in named if k in texts]
    assert known and all(want in got and len(got) <= len(want) + 60 for got, want in known)
