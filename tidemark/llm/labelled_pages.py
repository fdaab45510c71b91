"""Labelled pages: layouts of our own with invented words; blocks of the article carry data-main.

Layouts differ in the elements and class names by which they tell articles from the rest; what a page holds is drawn by a
seeded generator, so the set is the same everywhere.
"""

from __future__ import annotations

import random

SYLLABLES = "ba den or ti la mo ver si ka nel pu ri so ta un vo wes ya zo che lin dra fe gu".split()
#: What opens and closes the article.
SHELLS = (
    ("<article>", "</article>"), ('<article class="post">', "</article>"), ('<main><article id="story">', "</article></main>"),
    ('<div class="post-content">', "</div>"), ('<div id="content"><div class="entry">', "</div></div>"),
    ('<main role="main">', "</main>"), ('<section class="article-body">', "</section>"), ('<div itemprop="articleBody">', "</div>"),
    ('<table><tr><td class="story">', "</td></tr></table>"), ('<div class="wrap"><div class="col">', "</div></div>"), ("<div>", "</div>"),
)


class Draw:
    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def word(self) -> str:
        return "".join(self.r.choices(SYLLABLES, k=self.r.randint(1, 4)))

    def sentence(self, low: int = 5, high: int = 22) -> str:
        text = " ".join(self.word() for _ in range(self.r.randint(low, high)))
        return text.capitalize() + self.r.choice("....?!")

    def text(self, low: int = 1, high: int = 6) -> str:
        out = " ".join(self.sentence() for _ in range(self.r.randint(low, high)))
        if self.r.random() < 0.2:
            out = out.replace(" ", f' <a href="/{self.word()}">{self.word()}</a> ', 1)
        if self.r.random() < 0.2:
            out = f"<b>{self.word()}</b> {out}"
        return out

    def links(self, low: int = 3, high: int = 9) -> str:
        items = "".join(f'<li><a href="/{w}">{w} {self.word() if self.r.random() < .4 else ""}</a></li>'
                        for w in (self.word() for _ in range(self.r.randint(low, high))))
        return f"<ul>{items}</ul>"

    def one(self, *options: str) -> str:
        return self.r.choice(options)

    def main(self) -> str:
        """The article's blocks."""
        r, m, out = self.r, " data-main", []
        title = self.sentence(2, 9).rstrip(".")
        out.append(self.one(f"<h1{m}>{title}</h1>", f"<header><h1{m}>{title}</h1></header>", f"<h2{m}>{title}</h2>", ""))
        for _ in range(r.choice((1, 2, 3, 4, 6, 9, 14))):
            kind = r.random()
            if kind < 0.62:
                out.append(f"<p{m}>{self.text()}</p>")
            elif kind < 0.72:
                out.append(f"<p{m}>{self.sentence(1, 3)}</p>")
            elif kind < 0.80:
                out.append(f"<h{r.randint(2, 4)}{m}>{self.sentence(1, 6).rstrip('.')}</h2>")
            elif kind < 0.86:
                out.append("<ul>" + "".join(f"<li{m}>{self.sentence(2, 14)}</li>" for _ in range(r.randint(2, 5))) + "</ul>")
            elif kind < 0.90:
                out.append(f"<blockquote><p{m}>{self.text(1, 2)}</p></blockquote>")
            elif kind < 0.93:
                out.append(f"<figure><img src=x><figcaption{m}>{self.sentence(3, 10)}</figcaption></figure>")
            elif kind < 0.96:
                rows = "".join(f"<tr><td{m}>{self.word()}</td><td{m}>{self.sentence(1, 5)}</td></tr>" for _ in range(r.randint(2, 4)))
                out.append(f"<table>{rows}</table>")
            elif kind < 0.98:
                out.append(f"<pre{m}>{self.text(1, 2)}</pre>")
            else:
                out.append(self.advert())
        if r.random() < 0.15:  # paragraphs and bold text that nobody closed
            out.append(f"<p{m}><b>{self.sentence()}<br><p{m}>{self.text()}</p>")
        return "".join(out)

    def advert(self) -> str:
        return self.one(
            f'<div class="ad">{self.sentence()}</div>', f'<div class="advert banner"><p>{self.sentence()}</p></div>',
            f'<aside class="sponsored">{self.text(1, 2)}</aside>', f'<div id="promo"><a href="/x">{self.sentence(2, 6)}</a></div>',
            f'<ins class="adsbygoogle">{self.sentence(2, 6)}</ins>')

    def before(self) -> str:
        menu = self.links()
        return self.one("", f"<header><div class=logo>{self.word()}</div>{menu}</header>", f"<header><p>{self.sentence(2, 8)}</p></header>",
                        f'<div id="header"><h1>{self.word()}</h1><p>{self.sentence(2, 6)}</p></div>', f'<div class="masthead">{self.sentence(2, 6)}</div>') + self.one(
            f"<nav>{menu}</nav>", f'<div class="menu">{menu}</div>', f'<div id="navbar" role="navigation">{menu}</div>', menu,
            f'<div class="breadcrumb"><a href="/">{self.word()}</a> &gt; <a href="/a">{self.word()}</a></div>')

    def notice(self) -> str:
        return self.one("", "", f'<div class="cookie-notice"><p>{self.text(1, 2)}</p><button>OK</button></div>',
                        f'<div id="gdpr-consent">{self.sentence()} cookies {self.sentence()}</div>', f'<div class="alert" role="alert">{self.sentence()}</div>',
                        f'<div class="notice">{self.text(1, 2)}</div>', f'<div class="popup modal"><p>{self.text(1, 2)}</p></div>')

    def form(self) -> str:
        return self.one("", "", f'<form><label>{self.word()}</label><input><p>{self.sentence(2, 9)}</p><button>{self.word()}</button></form>',
                        f'<div class="newsletter"><h3>{self.sentence(2, 5)}</h3><form><p>{self.sentence()}</p><input></form></div>',
                        f'<form class="search"><select><option>{self.word()}<option>{self.word()}</select></form>')

    def side(self) -> str:
        return self.one("", f'<aside><h3>{self.word()}</h3>{self.links()}</aside>', f'<div class="sidebar"><h3>{self.word()}</h3><p>{self.text(1, 2)}</p>{self.links()}</div>',
                        f'<div id="side"><div class="widget"><p>{self.text(1, 3)}</p></div></div>', f'<div class="related"><h4>{self.word()}</h4>{self.links()}</div>',
                        f'<aside><p>{self.text(1, 3)}</p></aside>', f'<div class="share social">{self.links(2, 4)}</div>')

    def comments(self) -> str:
        own = [f"<p>{self.text(1, 3)}</p>" for _ in range(self.r.randint(1, 5))]
        return self.one("", f'<section id="comments"><h3>{self.r.randint(2, 90)} {self.word()}</h3>{"".join(f"<div class=comment><b>{self.word()}</b>{c}</div>" for c in own)}</section>',
                        f'<div class="comments">{"".join(own)}</div>', f'<ol class="commentlist">{"".join(f"<li class=comment>{c}</li>" for c in own)}</ol>',
                        f'<div id="disqus_thread">{"".join(own)}</div>', f'<section class="responses">{"".join(f"<article class=comment>{c}</article>" for c in own)}</section>')

    def after(self) -> str:
        return self.one(f"<footer>&copy; {self.word()} {self.sentence(2, 12)}</footer>", f"<footer><p>{self.text(1, 2)}</p>{self.links(2, 5)}</footer>",
                        f'<div id="footer"><p>&copy; {self.sentence(2, 9)}</p></div>', f'<div class="site-footer copyright">{self.text(1, 2)}</div>', "")

    def page(self) -> str:
        open_, close = self.one(*SHELLS[:1]) if self.r.random() < 0.25 else self.r.choice(SHELLS)
        inner = [self.main()]
        if self.r.random() < 0.3:
            inner.append(self.one(self.comments(), self.side(), self.form()))
        parts = [self.notice(), self.before(), self.advert() if self.r.random() < 0.6 else "", open_ + "".join(inner) + close,
                 self.form(), self.side(), self.comments(), self.after()]
        if self.r.random() < 0.2:
            parts[3], parts[5] = parts[5], parts[3]
        return f"<html><head><title>{self.sentence()}</title><style>p{{}}</style></head><body>{''.join(parts)}<script>var a='</p>';</script></body></html>"


def pages(n: int = 160, seed: int = 11) -> list[str]:
    draw = Draw(seed)
    return [draw.page() for _ in range(n)]
