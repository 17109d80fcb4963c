"""Composed web pages with a known answer, to fit the extraction of main text on.

Layouts are drawn from patterns that are common on the web. The class token ``xanswer``
marks the container of the main text and ``xnoise`` what does not belong to it.
"""

from __future__ import annotations

import html
import random

_SYLLABLES = "an ber co da en fi go hu in ka le mo na or pi ra se tu vo wen".split()


class _Composer:
    def __init__(self, seed: int, prose: list[str]):
        self.r = random.Random(seed)
        self.prose = prose

    def words(self, low: int, high: int) -> str:
        n = self.r.randint(low, high)
        if self.prose and self.r.random() < 0.8:
            words = self.r.choice(self.prose).split()
            at = self.r.randrange(max(1, len(words) - n))
            words = words[at : at + n]
        else:
            words = ["".join(self.r.choices(_SYLLABLES, k=self.r.randint(1, 4))) for _ in range(n)]
        text = " ".join(words) or "x"
        return html.escape(text[:1].upper() + text[1:] + self.r.choice([".", ".", "", "!"]), quote=False)

    def sometimes(self, chance: float, make) -> str:
        return make() if self.r.random() < chance else ""

    def element(self, tag: str, token: str, inner: str, noise: bool = False, by: str | None = None) -> str:
        """The element; its token is a class, an id or both, or left out."""
        mark = " xnoise" if noise else ""
        by = by or self.r.choice(["class", "class", "id"])
        if by == "id" and token:
            return f'<{tag} id="{token}"' + (f' class="{mark.strip()}"' if mark else "") + f">{inner}</{tag}>"
        name = (token + mark).strip()
        return (f'<{tag} class="{name}">' if name else f"<{tag}>") + inner + f"</{tag}>"

    def links(self, low: int, high: int, words: int = 3) -> str:
        items = [f'<a href="/{i}">{self.words(1, words)}</a>' for i in range(self.r.randint(low, high))]
        kind = self.r.random()
        if kind < 0.7:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        return self.r.choice([" | ", " ", " &middot; "]).join(items)

    def menu(self) -> str:
        tag, token = self.r.choice([("nav", ""), ("nav", "main-nav"), ("div", "menu"), ("div", "navigation"), ("div", "navbar"), ("div", "breadcrumbs"), ("div", "")])
        return self.element(tag, token, self.links(3, 10), True)

    def header(self) -> str:
        tag, token = self.r.choice([("header", ""), ("header", "site-header"), ("div", "header"), ("div", "masthead"), ("div", "banner")])
        inner = self.r.choice(["<p>%s</p>", "<h2>%s</h2>", "<a href='/'>%s</a>", "%s"]) % self.words(1, 8)
        return self.element(tag, token, inner + self.sometimes(0.5, lambda: self.links(2, 6)), True)

    def footer(self) -> str:
        tag, token = self.r.choice([("footer", ""), ("footer", "site-footer"), ("div", "footer"), ("div", "copyright"), ("div", "legal")])
        inner = self.r.choice(["&copy; example &middot; %s", "<p>%s</p>", "%s", "<p>&copy; %s</p>"]) % self.words(3, 30)
        return self.element(tag, token, inner + self.sometimes(0.4, lambda: self.links(2, 8)), True)

    def advert(self) -> str:
        tag, token = self.r.choice([("div", "ad"), ("div", "ads"), ("div", "advert"), ("aside", "ad"), ("div", "sponsored"), ("div", "promo-box"), ("section", "advertisement"), ("p", "ad"), ("div", "ad-slot")])
        inner = self.words(3, 30) if tag == "p" or self.r.random() < 0.6 else f"<p>{self.words(3, 30)}</p>"
        return self.element(tag, token, inner + self.sometimes(0.3, lambda: f'<a href="/x">{self.words(1, 3)}</a>'), True)

    def notice(self) -> str:
        tag, token = self.r.choice([("div", "cookie-notice"), ("div", "cookies"), ("div", "notice"), ("section", "consent"), ("div", "alert"), ("div", "newsletter"), ("p", "notice"), ("div", "popup"), ("div", "modal")])
        inner = self.words(4, 35) if tag == "p" else f"<p>{self.words(4, 35)}</p>" + self.sometimes(0.5, lambda: f"<button>{self.words(1, 2)}</button>")
        return self.element(tag, token, inner, True)

    def form(self) -> str:
        label = self.words(1, 6)
        inner = f'<label>{label}</label><input name="q"><button>{self.words(1, 1)}</button>' + self.sometimes(0.4, lambda: f"<p>{self.words(3, 15)}</p>")
        return self.element("form", self.r.choice(["", "search", "signup", "login"]), inner, True)

    def sidebar(self) -> str:
        tag, token = self.r.choice([("aside", ""), ("aside", "sidebar"), ("div", "sidebar"), ("div", "widget"), ("div", "related"), ("section", "recommended"), ("div", "side-column sidebar")])
        inner = "".join(
            self.r.choice([lambda: f"<h3>{self.words(1, 4)}</h3>" + self.links(2, 7, 8), lambda: f"<p>{self.words(5, 60)}</p>", lambda: f"<div>{self.words(5, 30)}</div>"])()
            for _ in range(self.r.randint(1, 3))
        )
        return self.element(tag, token, inner, True)

    def comments(self) -> str:
        tag, token = self.r.choice([("div", "comments"), ("section", "comments"), ("div", "discussion"), ("ol", "comment-list"), ("div", "replies"), ("section", "reader-comments")])
        item = "li" if tag == "ol" else self.r.choice(["div", "article", "p"])
        one = lambda: self.words(5, 60) if item == "p" else self.r.choice(["<p>%s</p>", "<b>%s</b>", "%s"]) % self.words(1, 3) + f"<p>{self.words(5, 70)}</p>"
        inner = self.sometimes(0.6, lambda: f"<h3>{self.words(1, 3)}</h3>") + "".join(self.element(item, self.r.choice(["comment", "reply", ""]), one()) for _ in range(self.r.randint(1, 6)))
        return self.element(tag, token, inner + self.sometimes(0.3, self.form), True)

    def share(self) -> str:
        return self.element(self.r.choice(["div", "ul"]), self.r.choice(["share", "social", "tags", "meta", "byline"]), self.links(2, 4, 1) if self.r.random() < 0.6 else self.words(2, 6), True)

    def paragraph(self) -> str:
        text = self.words(1, 5) if self.r.random() < 0.1 else self.words(8, 120)
        kind = self.r.random()
        if kind < 0.12:
            return f"<p><b>{text}<br>"
        if kind < 0.24:
            return f"<p>{text}"
        if kind < 0.34:
            return f'<p>{text} <a href="/y">{self.words(1, 3)}</a> {self.words(2, 20)}</p>'
        return f"<p>{text}</p>"

    def body(self) -> str:
        out = [self.sometimes(0.75, lambda: self.r.choice(["<h1>%s</h1>", "<h2>%s</h2>", "<h1 class='title'>%s</h1>"]) % self.words(3, 12))]
        plain = self.r.random() < 0.1
        for _ in range(self.r.choice([1, 1, 2, 3, 4, 6, 9, 14, 22])):
            out.append(f"<div>{self.words(8, 90)}</div>" if plain else self.paragraph())
            out.append(self.sometimes(0.07, lambda: f"<h2>{self.words(1, 8)}</h2>"))
            out.append(self.sometimes(0.05, lambda: "<ul>" + "".join(f"<li>{self.words(2, 25)}</li>" for _ in range(self.r.randint(2, 6))) + "</ul>"))
            out.append(self.sometimes(0.04, lambda: f"<blockquote>{self.words(6, 50)}</blockquote>"))
            out.append(self.sometimes(0.03, lambda: f"<pre>{self.words(4, 30)}</pre>"))
            out.append(self.sometimes(0.03, lambda: "<table>" + "".join(f"<tr><td>{self.words(1, 4)}</td><td>{self.words(1, 4)}</td></tr>" for _ in range(3)) + "</table>"))
            out.append(self.sometimes(0.03, self.advert))
            out.append(self.sometimes(0.02, self.sidebar))
            out.append(self.sometimes(0.02, self.notice))
        return "".join(out) + self.sometimes(0.2, self.share) + self.sometimes(0.1, self.comments)

    def page(self) -> str:
        r = self.r
        kind = r.random()
        if kind < 0.55:
            main = f'<article class="xanswer">{self.body()}</article>'
        elif kind < 0.65:
            main = f'<main class="xanswer">{self.body()}</main>'
        else:
            token = r.choice(["content", "main-content", "post", "post-body", "entry", "story", "article-text", "page-body", "", "col-8"])
            main = f'<{r.choice(["div", "section"])} class="{token} xanswer">{self.body()}</DIV>'
            main = main.replace("</DIV>", "</section>" if main.startswith("<section") else "</div>")
        if r.random() < 0.3:
            main = self.element(r.choice(["main", "div", "section"]), r.choice(["", "container", "row", "main"]), main)
        before = [self.sometimes(0.5, self.header), self.sometimes(0.6, self.menu), self.sometimes(0.3, self.notice), self.sometimes(0.35, self.advert), self.sometimes(0.2, self.form), self.sometimes(0.2, self.sidebar)]
        after = [self.sometimes(0.3, self.share), self.sometimes(0.35, self.comments), self.sometimes(0.4, self.sidebar), self.sometimes(0.3, self.advert), self.sometimes(0.15, self.form), self.sometimes(0.7, self.footer), self.sometimes(0.1, self.notice)]
        r.shuffle(before)
        inner = "".join(before) + main + "".join(after)
        if r.random() < 0.3:
            inner = self.element("div", r.choice(["wrapper", "container", "page", "layout", ""]), inner)
        return f"<!DOCTYPE html><html><head><title>{self.words(2, 8)}</title><style>p{{margin:0}}</style></head><body>{inner}<script>f('</p>')</script></body></html>"


def compose(n: int, prose: list[str], seed: int = 7) -> list[str]:
    """So many pages; the same ones for the same prose."""
    return [_Composer(seed * 100_003 + i, prose).page() for i in range(n)]
