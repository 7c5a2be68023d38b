"""Main text that stands below doubtful names, in links or outside the article."""

import pytest

from ratekit.llm import htmltext

LONG = "This is a paragraph of the article that has many of the words of a text in it and it goes on for a while so that it is long enough to be sure of."


@pytest.mark.parametrize("name", ["has-sidebar", "no-sidebar", "page-with-header", "content with-nav"])
def test_wrappers_keep_the_page(name):
    assert htmltext.main_text(f"<body><div class='{name}'><article><p>One.</p></article></div></body>") == "One."
    assert htmltext.main_text(f"<body><div class='{name}'><p>{LONG}</p></div></body>") == LONG


def test_an_article_below_a_name_stands_for_itself():
    assert htmltext.main_text("<div class=sidebar><p>x</p><article><p>One.</p></article></div>") == "One."
    assert htmltext.main_text("<aside><article><p>x</p></article></aside><article><p>One.</p></article>") == "One."
    assert htmltext.main_text("<article><p>One.</p></article><div class=related><article><p>x</p></article></div>") == "One."
    assert htmltext.main_text("<main><p>One.</p><div class=comments><article><p>x</p></article></div></main>") == "One."


@pytest.mark.parametrize("part", ["<section id='related-work'><p>It.</p></section>", "<h2 id='search'>It.</h2>", "<h2 id=notices>It.</h2>", "<div class='social-history'>It.</div>", "<section id=search>It.</section>"])
def test_article_parts_with_furniture_words_stay(part):
    assert htmltext.main_text(f"<article><p>One.</p>{part}</article>") == "One.\nIt."


@pytest.mark.parametrize("name", ["sidebar", "site-header", "cookie-banner", "comments-area", "ad"])
def test_furniture_names_still_go(name):
    assert htmltext.main_text(f"<div class='{name}'><p>{LONG}</p></div><div><p>{LONG}</p></div>") == LONG


@pytest.mark.parametrize(
    "links",
    ["<ul><li><a href=1>A. Person: a reference</a></li><li><a href=2>another</a></li></ul>", "<p>See <a href=1>the long title of another text</a></p>"],
)
def test_links_of_an_article_stay(links):
    words = [x for x in ("A. Person: a reference\nanother", "See the long title of another text") if x[:5] in links.replace("<a href=1>", "")][0]
    assert htmltext.main_text(f"<nav>Menu</nav><article><p>One.</p>{links}</article><footer>f</footer>") == "One.\n" + words
    assert htmltext.main_text(f"<nav>Menu</nav><article>{links}<div class=share>x</div></article>") == words
    assert htmltext.main_text(f"<div>{links}</div><article><p>One.</p></article>") == "One."


def test_title_and_lead_above_an_article_stay():
    page = f"<nav>Menu</nav><div><h1>Title</h1><p>{LONG}</p></div><article><p>One.</p></article><div>Imprint</div>"
    assert htmltext.main_text(page) == f"Title\n{LONG}\nOne."
    assert htmltext.main_text("<nav>Menu</nav><h1>Title</h1><article><p>One.</p></article><div>Imprint</div>") == "Title\nOne."


def test_a_main_text_beside_teaser_cards_stays():
    cards = "<article><h3><a href=1>Card</a></h3></article>"
    long = f"{LONG} {LONG}"
    assert htmltext.main_text(f"{cards}<div><h2>Head</h2><p>{long}</p><p>Short.</p><p>{long}</p></div><footer>f</footer>") == f"Card\nHead\n{long}\nShort.\n{long}"
    assert htmltext.main_text(f"<div><p>{LONG}</p><p>{LONG}</p></div>{cards}") == f"{LONG}\n{LONG}\nCard"


# -- wrappers, languages, hidden and barred blocks ----------------------------------


@pytest.mark.parametrize(
    "wrap",
    ["<div class='post sidebar-right'>{}</div>", "<form id=aspnetForm>{}</form>", "<div class='page-wrapper header'>{}</div>", "<div id=overlay><fieldset>{}</fieldset></div>"],
)
def test_an_element_with_the_page_in_it_is_a_wrapper(wrap):
    page = wrap.format(f"<h1>Title</h1><p>{LONG}</p><p>Short.</p><div class=sidebar><p>{LONG[:60]}</p></div>")
    assert htmltext.main_text(f"<nav>Menu of the page</nav>{page}") == f"Title\n{LONG}\nShort."
    # beside an article a name is believed
    assert htmltext.main_text(f"<article><p>One.</p></article>{page}").startswith("One.")


def test_comments_are_no_wrapper_however_long():
    assert htmltext.main_text(f"<div><p>{LONG}</p></div><div id=comments><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div>") == LONG
    assert htmltext.main_text(f"<article><p>One.</p></article><div id='responses'><p>{LONG}</p></div>") == "One."


def test_short_pages_keep_their_text_beside_furniture():
    page = "<div id='sidebar'>x</div><div><h1>Title</h1><p>Short text.</p></div><div class='footer'>f</div>"
    assert htmltext.main_text(page) == "Title\nShort text."


@pytest.mark.parametrize(
    "text",
    [
        "Сегодня утром жители деревни собрались на площади, чтобы послушать старого учителя. Он рассказал им о дороге через горы, о реке и о том, что было раньше. Потом все пошли домой, и снова стало тихо. Вечером выпал первый снег.",
        "今天早上，村民们聚集在广场上听老老师讲话。他告诉他们穿过山脉的道路、河流以及以前发生的事情。然后大家都回家了，又安静了下来。" * 4,
        "Ontem de manhã, os moradores da aldeia juntaram-se na praça para ouvir o velho professor. Ele falou sobre a estrada, o rio e aquilo que houve antes. Depois todos foram para casa. À noite caiu a primeira neve sobre os telhados.",
    ],
)
def test_long_paragraphs_of_any_language_stay(text):
    assert htmltext.main_text(f"<nav>Menu</nav><div><p>{text}</p></div><footer>f</footer>") == text


def test_long_blocks_without_sentences_go():
    words = "alpha beta gamma delta " * 12
    assert htmltext.main_text(f"<div><p>{LONG}</p></div><div>{words}</div>") == LONG


@pytest.mark.parametrize("name", ["ad-unit", "ad-slot", "google-ad", "advert-inline", "notice", "sponsored-box"])
def test_adverts_and_notices_in_an_article_go(name):
    assert htmltext.main_text(f"<article><p>One.</p><div class='{name}'><p>Buy it now.</p></div><p>Two.</p></article>") == "One.\nTwo."
    assert htmltext.main_text(f"<article><div class='no-ads ad-free'><p>One.</p></div></article>") == "One."


def test_cards_and_cookie_notices_beside_the_article_go():
    cards = "<div class='related-posts'><article><h3><a href=1>Card</a></h3><p>Read it.</p></article></div>"
    cookies = f"<div id='onetrust-banner-sdk'><p>{LONG}</p></div>"
    assert htmltext.main_text(f"{cookies}<main><p>One.</p>{cards}</main>") == "One."


@pytest.mark.parametrize("attrs", ["hidden", "class=x hidden=''", "style='color:red; display: none'", 'style="visibility:hidden"', "aria-hidden=true"])
def test_hidden_blocks_go(attrs):
    assert htmltext.main_text(f"<article><p>One.</p><div {attrs}><p>Unseen.</p></div><p title='a hidden gem'>Two.</p></article>") == "One.\nTwo."
    assert htmltext.main_text(f"<div {attrs}><p>{LONG}</p></div><div><p>{LONG[:90]}</p></div>") == LONG[:90].strip()


def test_formulas_quotes_and_footnotes_of_an_article_stay():
    page = "<article><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math>.</p><aside class='pull-quote'><p>A quote.</p></aside><footer class=footnotes><p>1. A note.</p></footer><footer>Imprint</footer></article>"
    assert htmltext.main_text(page) == "Let x=1.\nA quote.\n1. A note."


def _density_by_hand(blocks):
    """The two passes for plain paragraphs: (text, share of linked letters) -> kept, written out."""
    label = []
    for text, linked in blocks:
        words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
        dense = sum(w in htmltext.STOP_WORDS for w in words) / max(1, len(words))
        ends = sum(text[k] in ".!?" and (k + 1 == len(text) or text[k + 1] == " ") for k in range(len(text)))
        if linked > 0.5:
            label.append(0)
        elif len(text) < 70:
            label.append(None)
        elif dense >= 0.15 or (len(text) >= 200 and ends * 300 >= len(text)):
            label.append(1)
        else:
            label.append(0 if len(text) >= 200 and dense < 0.05 else None)
    out = []
    for k, x in enumerate(label):
        if x is None:
            near = sorted((abs(j - k), j > k, y) for j, y in enumerate(label) if y is not None)
            x = near[0][2] if near else 1
        out.append(x)
    return out


def test_two_passes_equal_the_rules_written_out():
    import random

    rng = random.Random(9)
    kinds = [LONG, LONG[:60], "gamma delta kappa sigma " * 3, "alpha beta gamma delta " * 12, "Menu", "Kto tam. Nikto tam. " * 12, "x"]
    for _ in range(400):
        made = [(rng.choice(kinds).strip(), rng.choice([0.0, 0.0, 0.0, 1.0])) for _ in range(rng.randint(1, 9))]
        page = "".join(f"<p><a href=1>{t}</a></p>" if linked else f"<p>{t}</p>" for t, linked in made)
        want = [t for (t, _), keep in zip(made, _density_by_hand(made)) if keep]
        assert htmltext.main_text(f"<body>{page}</body>") == "\n".join(want)
