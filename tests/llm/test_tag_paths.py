"""Main text of generated pages whose main text is known: recall and precision in words."""

import random
from collections import Counter

import pytest

from incident_analytics.llm import tag_paths

LONG = " ".join(["Some words of the text, and some more."] * 8)
WRAPPERS = ["page has-sidebar", "no-banner", "ad-free", "main-form", "discussion", "content-with-sidebar", "social", "news promo-off",
            "layout--nav", "post has-sidebar"]


@pytest.mark.parametrize("name", WRAPPERS)
def test_names_of_wrappers_lose_no_text(name):
    body = f"<h1>T</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p>"
    for page in (f'<body><nav>m</nav><div class="{name}">{body}</div></body>', f'<body><article><div id="{name}">{body}</div></article></body>',
                 f'<article class="{name}">{body}</article>', f'<main class="{name}">{body}</main>', f'<body class="{name}">{body}</body>',
                 f'<div class="{name}"><article>{body}</article></div>'):
        assert tag_paths.main_text(page) == f"T\n{LONG}\nShort.\n{LONG}"


def test_hinted_parts_go_and_formulas_stay():
    page = (f'<div id="wrap" class="has-nav"><div class="ad">Buy, buy!</div><div class="post"><p>{LONG}</p><p>Sum <math><mi>x</mi></math>.</p>'
            f'<p>{LONG}</p><div class="comments"><p>I, for one, agree.</p></div><div class="share-links">Share</div></div>'
            '<ul><li><a href="1">One</a></li><li><a href="2">Two</a></li><li><a href="3">Three</a></li></ul></div>')
    assert tag_paths.main_text(page) == f"{LONG}\nSum x.\n{LONG}"
    few = f'<article><p>{LONG}</p><p>See:</p><ul><li><a href="1">One</a></li><li><a href="2">Two</a></li></ul></article>'
    assert tag_paths.main_text(few) == f"{LONG}\nSee:\nOne\nTwo"
    ad = '<div class="ad">' + LONG + '</div><article><p>Short, true.</p></article>'
    assert tag_paths.main_text(ad) == "Short, true."


def generated(rng: random.Random) -> tuple[str, list[str]]:
    """A page and the words of its main text."""
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(1, 9))) for _ in range(400)]

    def sentence(least, most):
        return " ".join(rng.choices(words, k=rng.randint(least, most))).capitalize() + rng.choice([".", ".", "!", "?"])

    def noise(n):
        return " ".join("zz" + w for w in rng.choices(words, k=n))

    main, parts = [], []
    for k in range(rng.randint(4, 14)):
        text = sentence(2, 6) if rng.random() < 0.15 else " ".join(sentence(4, 14).replace(" ", ", ", 1) for _ in range(rng.randint(1, 6)))
        main.append(text)
        parts.append(rng.choice(["<p>{}</p>"] * 5 + ["<blockquote>{}</blockquote>", "<h2>{}</h2>", '<p class="lead">{}</p>']).format(text))
    links = "".join(f"<li><a href='/{k}'>{noise(rng.randint(1, 2))}</a></li>" for k in range(rng.randint(3, 8)))
    before = [f"<nav>{noise(5)}</nav>", f"<ul>{links}</ul>", f'<div class="site-header banner">{noise(6)}</div>', f'<div class="ad">{noise(12)}</div>',
              f'<div id="cookie-notice">{noise(9)}, zzok.</div>']
    after = [f'<div class="sidebar"><ul>{links}</ul></div>', f"<footer>&copy; {noise(6)}</footer>", f'<div class="footer">{noise(8)}</div>',
             f'<div class="newsletter signup">{noise(7)}.</div>', f"<form>{noise(3)}<input></form>",
             '<div id="comments">' + "".join(f"<p>{noise(rng.randint(3, 12))}.</p>" for _ in range(rng.randint(1, 3))) + "</div>"]
    inner = "".join(parts)
    for name in rng.sample(WRAPPERS + ["entry", "c1", "body-text"], k=rng.randint(1, 3)):
        inner = f'<{(tag := rng.choice(["div", "section"]))} class="{name}">{inner}</{tag}>'
    page = "".join(rng.sample(before, k=rng.randint(1, 4))) + inner + "".join(rng.sample(after, k=rng.randint(1, 5)))
    return f"<html><head><title>zz</title></head><body>{page}</body></html>", " ".join(main).split()


def test_recall_and_precision_without_article_or_main():
    rng, hit, want, got = random.Random(12), 0, 0, 0
    for _ in range(400):
        page, words = generated(rng)
        found, true = Counter(tag_paths.main_text(page).split()), Counter(words)
        hit += sum((found & true).values())
        want += sum(true.values())
        got += sum(found.values())
    print(f"recall {hit / want:.4f} precision {hit / got:.4f}")
    assert hit / want >= 0.99 and hit / got >= 0.97
