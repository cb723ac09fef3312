"""Labelled pages for operator 2: composed from templates, with the blocks of the article known.

The tables hold no labelled pages, so the random field of ``html_text`` is trained
on pages put together here: articles in several kinds of containers, among menus,
headers, notices, adverts, sidebars, forms, reader comments and footers, in random
order and nesting, with random words.
"""

from __future__ import annotations

import random

ARTICLE = [
    ("article", ""), ("article", 'class="post"'), ("main", ""), ("main", 'id="content"'), ("div", 'class="entry-content"'),
    ("div", 'class="article-body"'), ("section", 'class="story"'), ("div", 'itemprop="articleBody"'), ("div", 'id="main"'),
    ("td", 'class="text"'), ("div", 'class="post-content"'), ("div", ""),
]
MENU = [("nav", ""), ("nav", 'class="menu"'), ("div", 'id="nav"'), ("div", 'class="navbar"'), ("ul", 'class="menu"'), ("div", 'role="navigation"'),
        ("div", 'class="breadcrumb"'), ("div", 'class="pagination"'), ("ul", 'class="tags"'), ("div", 'class="share-buttons"')]
HEADER = [("header", ""), ("div", 'id="header"'), ("div", 'class="site-header"'), ("div", 'class="top-bar"'), ("div", 'role="banner"')]
FOOTER = [("footer", ""), ("div", 'id="footer"'), ("div", 'class="site-footer"'), ("div", 'role="contentinfo"'), ("div", 'class="copyright"')]
SIDE = [("aside", ""), ("div", 'class="sidebar"'), ("div", 'id="side"'), ("div", 'class="related-posts"'), ("div", 'class="widget"'), ("section", 'class="related"')]
NOTICE = [("div", 'class="cookie-banner"'), ("div", 'id="consent"'), ("div", 'class="notice"'), ("div", 'role="alert"'), ("div", 'class="alert"'),
          ("div", 'class="newsletter"'), ("div", 'class="popup"'), ("div", 'class="cookie-notice"'), ("div", 'role="dialog"'), ("div", 'class="subscribe"')]
ADVERT = [("div", 'class="ad"'), ("div", 'class="ads"'), ("div", 'class="advert"'), ("div", 'class="sponsored"'), ("div", 'class="promo"'),
          ("ins", 'class="ad"'), ("aside", 'class="ad"'), ("div", 'id="banner"'), ("div", 'class="advertisement"')]
FORM = [("form", ""), ("form", 'class="search"'), ("form", 'id="login"'), ("form", 'class="comment-form"')]
COMMENTS = [("section", 'class="comments"'), ("div", 'id="comments"'), ("ol", 'class="comment-list"'), ("div", 'class="discussion"'),
            ("div", 'class="responses"'), ("div", 'class="comment"'), ("ul", 'class="replies"')]
SYLLABLES = "an be ci der el fa ge ho in jo ka le mi na on pra que ra sto ti un ver wo xa ye zu é ß ä ñ ç th ing tion ment".split()


class _Writer:
    def __init__(self, seed: int):
        self.random = random.Random(seed)
        self.labels: dict[str, bool] = {}

    def words(self, n: int) -> str:
        return " ".join("".join(self.random.choice(SYLLABLES) for _ in range(self.random.randint(1, 4))) for _ in range(n))

    def block(self, main: bool, n: int, end: str = "") -> str:
        while True:
            text = self.words(n).capitalize() + end
            if text not in self.labels:
                self.labels[text] = main
                return text

    def prose(self, main: bool, lo: int, hi: int) -> str:
        parts = [self.words(self.random.randint(2, 14)).capitalize() + self.random.choice(".....?!") for _ in range(self.random.randint(lo, hi))]
        text = " ".join(parts)
        if self.random.random() < 0.15:
            text = " ".join(w + self.random.choice(["%%%", "$$$", "***", "###"]) for w in text.split())
        if text in self.labels:
            return self.prose(main, lo, hi)
        self.labels[text] = main
        return text

    def wrap(self, kind: tuple[str, str], inner: str) -> str:
        tag, attributes = kind
        return f"<{tag} {attributes}>{inner}</{tag}>" if attributes else f"<{tag}>{inner}</{tag}>"

    def pick(self, kinds: list) -> tuple[str, str]:
        return self.random.choice(kinds)

    def links(self) -> str:
        items = "".join(f'<li><a href="/{k}">{self.block(False, self.random.randint(1, 3))}</a></li>' for k in range(self.random.randint(2, 7)))
        return f"<ul>{items}</ul>"

    def article(self) -> str:
        r, out = self.random, []
        if r.random() < 0.85:
            out.append(f"<h1>{self.block(True, r.randint(2, 10), r.choice(['', '', '.']))}</h1>")
        for _ in range(r.randint(1, 14)):
            kind = r.random()
            if kind < 0.62:
                out.append(f"<p>{self.prose(True, 1, 9)}</p>")
            elif kind < 0.72:
                out.append(f"<p>{self.block(True, r.randint(1, 3), '.')}</p>")
            elif kind < 0.8:
                out.append(f"<p><b>{self.prose(True, 1, 3)}<br>")
            elif kind < 0.86:
                out.append(f"<h2>{self.block(True, r.randint(2, 6))}</h2>")
            elif kind < 0.9:
                out.append("<ul>" + "".join(f"<li>{self.prose(True, 1, 2)}</li>" for _ in range(r.randint(2, 4))) + "</ul>")
            elif kind < 0.93:
                out.append(f"<blockquote><p>{self.prose(True, 1, 3)}</p></blockquote>")
            elif kind < 0.95:
                out.append(f"<pre>{self.block(True, r.randint(3, 9))}</pre>")
            else:
                out.append(r.choice([self.advert, self.notice, self.share])())
        return "".join(out)

    def share(self) -> str:
        return self.wrap(self.pick(MENU), self.links())

    def advert(self) -> str:
        return self.wrap(self.pick(ADVERT), self.random.choice(["{}", "<p>{}</p>"]).format(self.prose(False, 1, 3)))

    def notice(self) -> str:
        return self.wrap(self.pick(NOTICE), f"<p>{self.prose(False, 1, 3)}</p>" + (f"<button>{self.block(False, 1)}</button>" if self.random.random() < 0.5 else ""))

    def side(self) -> str:
        inner = self.links() if self.random.random() < 0.6 else f"<h3>{self.block(False, 2)}</h3><p>{self.prose(False, 1, 4)}</p>"
        return self.wrap(self.pick(SIDE), inner)

    def form(self) -> str:
        return self.wrap(self.pick(FORM), f"<label>{self.block(False, 2)}</label><input name=q><p>{self.prose(False, 1, 2)}</p><button>{self.block(False, 1)}</button>")

    def comments(self) -> str:
        one = lambda: f'<div class="comment"><p>{self.prose(False, 1, 4)}</p></div>' if self.random.random() < 0.6 else f"<li><p>{self.prose(False, 1, 4)}</p></li>"
        return self.wrap(self.pick(COMMENTS), f"<h3>{self.block(False, 2)}</h3>" + "".join(one() for _ in range(self.random.randint(1, 6))))

    def page(self) -> str:
        r = self.random
        before = [self.wrap(self.pick(HEADER), self.block(False, 2) + self.links())] if r.random() < 0.5 else []
        before += [f() for f, p in ((self.share, 0.8), (self.notice, 0.3), (self.advert, 0.5), (self.form, 0.2), (self.side, 0.2)) if r.random() < p]
        r.shuffle(before)
        body = self.article()
        late = [f() for f, p in ((self.comments, 0.4), (self.share, 0.3), (self.form, 0.2)) if r.random() < p]
        if r.random() < 0.3:  # inside the article's own container
            body, late = body + "".join(late), []
        after = late + [f() for f, p in ((self.side, 0.4), (self.advert, 0.3), (self.notice, 0.2)) if r.random() < p]
        if r.random() < 0.85:
            after.append(self.wrap(self.pick(FOOTER), r.choice(["{}", "<p>{}</p>"]).format("&copy; " + self.foot())))
        middle = self.wrap(self.pick(ARTICLE), body)
        if r.random() < 0.4:
            middle = self.wrap(("div", r.choice(['class="wrapper"', 'class="container"', ""])), middle)
        return "<!DOCTYPE html><html><head><title>x</title></head><body>" + "".join(before) + middle + "".join(after) + "</body></html>"

    def foot(self) -> str:
        text = self.prose(False, 1, 2)
        del self.labels[text]
        self.labels["© " + text] = False
        return text


def labelled_pages(count: int, seed: int = 11) -> list[tuple[str, dict[str, bool]]]:
    """Pages with, for the text of each block, whether it belongs to the article."""
    out = []
    for k in range(count):
        writer = _Writer(seed * 1_000_003 + k)
        out.append((writer.page(), writer.labels))
    return out
