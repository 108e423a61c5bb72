import html
import re

import pytest

from sitefold.llm.html_extraction import extract, first_pass, main_text, second_pass

PROSE = "The quick fox is in the house and it was on the way to the market for a while, with the others, but it has not been there since then."


def test_article_page_equals_a_plain_strip(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = {r.page_id: r.html for r in pages.collect()}
    for r in extract(pages).collect():
        body = re.search(r"<article>(.*?)</article>", rows[r.page_id], re.S)[1]
        body = re.sub(r"<[^>]*>", "", re.sub(r"</?(?:p|br|h1)\b[^>]*>", " ", body))
        assert r.text == " ".join(html.unescape(body).split())
        assert r.n_chars == len(r.text)


def test_boilerplate_goes_and_short_blocks_follow_their_neighbours():
    page = f"""<header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav><div class="cookie-notice">{PROSE}</div>
    <div class=content><h2>Title</h2><p>{PROSE}<p>Short.<p>{PROSE} &amp; <i>mo</i>re&nbsp;&lt;x&gt;</div><!-- {PROSE} -->
    <aside>{PROSE}</aside><section id="comments"><p>{PROSE}</p></section><form>{PROSE}</form><script>var a = "</p>{PROSE}";</script>
    <style>p {{}}</style><div class="ad">{PROSE}</div><footer>{PROSE}</footer>"""
    assert main_text(page) == f"Title {PROSE} Short. {PROSE} & more <x>"


def test_comments_and_notices_inside_an_article():
    page = f"<main><article><p>{PROSE}</p><div class='newsletter signup'>{PROSE}</div><p>End.</p><section class=comments><article>{PROSE}</article></section></article></main>"
    assert main_text(page) == f"{PROSE} End."


def test_rules():
    assert first_pass(PROSE, 0, 0) == 1 and first_pass(PROSE, len(PROSE), 0) == -1 and first_pass("Hi", 0, 0) == 0 and first_pass(PROSE, 0, -1) == -1
    assert second_pass([1, 0, 0, -1], [0] * 4, [0] * 4) == [True, True, False, False]
    assert second_pass([0, 0], [1, 1], [1, 1]) == [True, True]
    assert second_pass([1, 0, -1], [1] * 3, [1] * 3) == [True, True, False]


def test_defined_results(spark):
    rows = [(1, None, None, 1), (1, None, None, 1), (None, "u", "", 2), (2, "u", f"<p>{PROSE}", 3), (3, "u", "<p" * 1000 + "<<<>&&", 4)]
    got = extract(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).collect()
    assert sorted([(r.page_id, r.text, r.n_chars) for r in got if r.page_id != 3], key=str) == sorted([(1, "", 0), (1, "", 0), (None, "", 0), (2, PROSE, len(PROSE))], key=str)
    assert main_text(f"<div>{PROSE * 20000}</div>") == " ".join((PROSE * 20000).split())


def test_tags_that_do_not_close_themselves():
    assert main_text(f"<p>{PROSE}</p><script src=x/>var a = 1;</script><p>{PROSE}<script src='y'/>b()</script></p>") == f"{PROSE} {PROSE}"
    links = "".join(f"<a href=/x{k}/>{PROSE}</a> " for k in range(3))
    assert main_text(f"<p>{PROSE}</p><div>{links}</div>") == PROSE
    assert main_text(f"<svg><title/><path d='M0'/></svg><p>{PROSE}") == PROSE


def test_open_quotes_leave_no_markup():
    assert main_text(f'<p>{PROSE} <a href="x>link</a> end.</p>') == f"{PROSE} link end."
    assert main_text(f"<p title='a>b'>{PROSE}</p><p don't>{PROSE}</p><p class=\"x>y\">{PROSE}</p>") == f"{PROSE} {PROSE} {PROSE}"


def test_wrappers_that_look_like_boilerplate():
    for wrap in ('<div class="legal-news">{}</div>', "<form id=aspnetForm action=x>{}</form>", '<form><div class="page search">{}</div></form>'):
        assert main_text("<nav>Home</nav>" + wrap.format(f"<h1>Title</h1><p>{PROSE}</p><div class=ad>{PROSE}</div><p>{PROSE}</p>") + f"<footer>{PROSE}</footer>") == f"Title {PROSE} {PROSE}"
    assert main_text(f"<div class=cookie-notice>{PROSE}</div><div class='sponsor'>{PROSE} {PROSE} {PROSE}</div><p>{PROSE}</p>") == PROSE


def test_content_beside_a_teaser_article():
    body = "".join(f"<p>{PROSE}</p>" for _ in range(4))
    assert main_text(f"<article><a href=/x>Next: a teaser</a></article><div>{body}</div>").endswith(" ".join([PROSE] * 4))
    assert main_text(f"<article>{body}</article><div><p>{PROSE}</p></div>") == " ".join([PROSE] * 4)


def test_other_scripts():
    japanese = "吾輩は猫である。名前はまだ無い。どこで生れたかとんと見当がつかぬ。何でも薄暗いじめじめした所でニャーニャー泣いていた事だけは記憶している。吾輩はここで始めて人間というものを見た。"
    russian = "Все счастливые семьи похожи друг на друга, каждая несчастливая семья несчастлива по-своему. Все смешалось в доме Облонских."
    italian = "Quel ramo del lago di Como volge a mezzogiorno tra due catene non interrotte di monti. Tutto seni e golfi a seconda dello sporgere e del rientrare di quelli. Vien quasi a un tratto a ristringersi e a prender corso e figura di fiume."
    for text in (japanese, russian, italian):
        assert main_text(f"<nav><a href=/>Home</a></nav><div><h1>短い</h1><p>{text}</p></div><footer>{text}</footer>") == f"短い {text}"


def test_time_grows_in_proportion_to_depth():
    import time

    def spent(page):
        began = time.process_time()
        main_text(page)
        return time.process_time() - began

    for make in (lambda n: "<div>" * n + PROSE + "</div>" * n, lambda n: "<div class=ad>" * n + f"<p>{PROSE}</p>" + "</div>" * n, lambda n: "<p title=\"" * n + PROSE, lambda n: "<a href=x><b>" * n, lambda n: "<p '" * n + ">" + PROSE):
        spent(make(2000))
        assert spent(make(40000)) < 60 * max(spent(make(2000)), 0.005)


# A second implementation over a tree, for pages whose tags are all closed and quoted.


def random_page(r):
    """A page as a tree, and the texts of its main part."""
    sentence = lambda: " ".join(r.choice(["the", "of", "and", "to", "in", "is", "a", f"w{r.randrange(10**6)}"]) for _ in range(r.randrange(40, 80))) + "."
    junk = lambda: r.choice([
        f"<nav><ul><li><a href='/{r.randrange(99)}'>{sentence()}</a></li></ul></nav>", f"<aside><p>{sentence()}</p></aside>", f"<div class=\"{r.choice(['ad', 'cookie-notice', 'x sidebar', 'newsletter signup'])}\"><p>{sentence()}</p></div>",
        f"<script>var x = '<p>{sentence()}</p>';</script>", f"<style>p {{ color: red }}</style><!-- <p>{sentence()}</p> -->", f"<form action='/s'><label>{sentence()}</label><input value='a>b'></form>",
        f"<section id=\"comments\"><article><p>{sentence()} {sentence()}</p></article></section>", "<svg><text>no text</text></svg>",
    ])
    main, texts = [], []
    for _ in range(r.randrange(1, 8)):
        text = sentence()
        texts.append(text)
        marked = text.replace(" of ", f" <{'b' if r.random() < 0.5 else 'i'}>of</i></b> ", 1).replace(" and ", " &#97;n&#x64;\n\t ", 1)
        main.append(f"<p>{marked}</p>" if r.random() < 0.7 else f"<div>{marked}</div>")
        if r.random() < 0.4:
            main.append(junk())
    head = "<!DOCTYPE html><html><head><title>no</title></head><body>" + f"<header><p>{sentence()}</p></header>"
    tail = f"<footer><p>{sentence()}</p></footer></body></html>"
    inner = "".join(main)
    return head + junk() + (f"<article>{inner}</article>" if r.random() < 0.5 else f"<div>{inner}</div>") + junk() + tail, texts


def test_made_pages_give_their_main_texts():
    import random

    for seed in range(400):
        page, texts = random_page(random.Random(seed))
        assert main_text(page) == " ".join(texts), page


A = "The river runs through the old town and the people of the valley have fished in it for a very long time."
B = "In the evening the boats come home and the market opens with lamps on every stall along the water."


@pytest.mark.parametrize(
    "page, text",
    [
        # Names that hold a marking word beside others, alone and in an article, siblings alike.
        ("<article>" + "".join(f'<div class="elementor-widget"><p>{x}</p></div>' for x in (A, B, A, B)) + "</article>", f"{A} {B} {A} {B}"),
        ("".join(f'<div class="elementor-widget"><p>{x}</p></div>' for x in (A, B, A, B)), f"{A} {B} {A} {B}"),
        ("".join(f'<div class="widget"><p>{x}</p></div>' for x in (A, B)) + "<nav>Home</nav>", f"{A} {B}"),
        ("".join(f'<div class="ad-free-comments"><p>{x}</p></div>' for x in (A, B)), f"{A} {B}"),
        (f'<main><h1 class="page-header">Head line</h1><p>{A}</p></main>', f"Head line {A}"),
        (f'<article><p>{A}</p><p class="share-price">{B}</p></article>', f"{A} {B}"),
        (f'<article><p>{A}</p><section class="related work"><p>{B}</p></section></article>', f"{A} {B}"),
        (f'<article><p>{A}</p><div class="related-links"><ul><li><a href=a>One more</a></li><li><a href=b>Another one</a></li></ul></div></article>', A),
        # A paragraph that is a link is text, a list of links is none.
        (f'<article><p>{A}</p><p><a href="x">{B}</a></p><ul><li><a href="y">{B}</a></li></ul></article>', f"{A} {B}"),
        # Rights mentioned in a text, and a line on rights.
        (f"<p>{A} As in (c) above.</p><p>{B}</p><p>© 2024 The people of the valley and all of their friends, all rights reserved here.</p>", f"{A} As in (c) above. {B}"),
        # Lists without stop words between prose; pages of short text only; other languages in Latin script.
        (f"<p>{A}</p><ul><li>Quartz, feldspar, mica, hornblende, augite, olivine, magnetite, ilmenite</li></ul><p>{B}</p>", f"{A} Quartz, feldspar, mica, hornblende, augite, olivine, magnetite, ilmenite {B}"),
        ("<h1>Short page</h1><p>One sentence only.</p><nav>Home</nav>", "Short page One sentence only."),
        ("<p>Rzeka płynie przez stare miasto, a ludzie z doliny łowili w niej od bardzo dawna ryby.</p>", "Rzeka płynie przez stare miasto, a ludzie z doliny łowili w niej od bardzo dawna ryby."),
        # Hidden by style.
        (f'<article><p>{A}</p><div style="color:red; display: none"><p>{B}</p></div></article>', A),
    ],
)
def test_names_and_styles_beyond_the_usual(page, text):
    assert main_text(f"<html><body>{page}</body></html>") == text


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string, text int")
    assert extract(pages).columns == ["page_id", "url", "text", "n_chars"] and extract(pages).count() == 0
