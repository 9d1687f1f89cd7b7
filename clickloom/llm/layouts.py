"""Labelled pages to train on: texts of real pages, laid out anew in many ways.

Each page has its main text somewhere among menus, headers, footers, sidebars, notices,
adverts, forms and readers' comments. Elements, class names, order, and what is nested or
left out are drawn at random, so that neither names nor places alone tell main text. Blocks
of main text begin with ``MARK``.
"""

from __future__ import annotations

import random
from html import escape

from clickloom.llm.html_blocks import MARK

# Class names as they are common on the web.
MAIN = "content main post article entry story body text article-body post-content entry-content main-content story-body page-content".split()
NAV = "nav menu navbar navigation breadcrumb breadcrumbs topnav main-menu nav-links pagination toc".split()
HEADER = "header site-header masthead topbar banner logo branding".split()
FOOTER = "footer site-footer copyright bottom legal colophon footer-links".split()
SIDE = "sidebar side aside widget related recommended popular trending more-stories left-column right-column recent-posts tags".split()
NOTICE = "notice cookie cookies cookie-banner consent alert gdpr privacy popup modal newsletter-notice message".split()
AD = "ad ads advert advertisement sponsored promo promoted banner-ad sponsor adsbygoogle commercial".split()
FORM = "form search login signup subscribe newsletter contact-form".split()
COMMENT = "comment comments comment-list discussion replies reply respond thread user-comments responses".split()
SHARE = "share social sharing share-buttons follow".split()
NEUTRAL = "row col wrapper container inner box section grid block item wrap clearfix layout".split()
PHRASES = {
    "nav": "Home|About|Contact|News|Blog|Archive|Products|Services|Next|Previous|Log in".split("|"),
    "footer": "© 2024 All rights reserved|Privacy policy|Terms of use|Imprint|Powered by|Contact us|Sitemap".split("|"),
    "notice": "This site uses cookies to improve your experience|Accept all cookies|Please enable JavaScript|You have 3 free articles left|Sign up to continue reading".split("|"),
    "ad": "Advertisement|Sponsored|Buy now and save|Order today, free shipping|Limited offer|Promoted content".split("|"),
    "side": "Related articles|Most read|Recent posts|Popular|Tags|You may also like|Read more".split("|"),
    "form": "Search|Your email|Subscribe|Submit|Password|User name|Send".split("|"),
    "comment": "Reply|Great post, thanks|I disagree|Posted by|2 comments|Leave a comment|says".split("|"),
    "share": "Share|Tweet|Share on Facebook|Email this|Print|Follow us".split("|"),
}
_FILLER = "ta re no li ka so mu den per vo an st il or ge".split()


class Layout:
    """Draws pages from a seed; ``texts`` are texts of real pages, of any kind."""

    def __init__(self, seed: int, texts: list[str]):
        self.draw = random.Random(seed)
        self.texts = texts or [self._invented() for _ in range(200)]
        self.plain = False

    def _invented(self) -> str:
        words = ("".join(self.draw.choice(_FILLER) for _ in range(self.draw.randrange(1, 4))) for _ in range(self.draw.randrange(3, 60)))
        return " ".join(words).capitalize() + "."

    def words(self, low: int, high: int) -> str:
        own = self.draw.choice(self.texts).split() or ["x"]
        n = self.draw.randrange(low, high + 1)
        at = self.draw.randrange(max(1, len(own) - n + 1))
        return " ".join(own[at : at + n])

    def prose(self) -> str:
        """A text at full length, or some sentences' worth of one."""
        return self.draw.choice(self.texts) if self.draw.random() < 0.4 else self.words(1, self.draw.choice([4, 20, 60, 120]))

    def tag(self, names: list[str], inner: str, tags: tuple[str, ...] = ("div", "section"), semantic: str = "") -> str:
        draw = self.draw
        if semantic and draw.random() < 0.5:
            tag = semantic
            named = draw.random() < 0.5
        else:
            tag, named = draw.choice(tags), not self.plain
        attributes = ""
        if named:
            name = draw.choice(names)
            name = draw.choice([name, f"{name} {draw.choice(NEUTRAL)}", f"{draw.choice(NEUTRAL)}-{name}", name.title().replace("-", "")])
            attributes = f' {draw.choice(["class", "class", "id"])}="{name}"'
        elif draw.random() < 0.3:
            attributes = f' class="{draw.choice(NEUTRAL)}"'
        return f"<{tag}{attributes}>{inner}</{tag}>"

    def link(self, text: str) -> str:
        return f'<a href="/{self.draw.randrange(999)}">{escape(text)}</a>'

    def phrase(self, kind: str) -> str:
        return self.draw.choice(PHRASES[kind]) if self.draw.random() < 0.35 else self.words(1, 6)

    def links(self, kind: str, low: int = 3, high: int = 9) -> str:
        items = [self.link(self.phrase(kind)) for _ in range(self.draw.randrange(low, high))]
        style = self.draw.randrange(4)
        if style == 0:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        if style == 1:
            return "<ul>" + "".join(f"<li>{x}" for x in items) + "</ul>"
        return "".join(f"<div>{x}</div>" for x in items) if style == 2 else " | ".join(items)

    def nav(self) -> str:
        return self.tag(NAV, self.links("nav"), ("div", "ul", "section"), "nav")

    def header(self) -> str:
        inner = self.tag(HEADER, self.link(self.words(1, 3))) + (f"<p>{escape(self.words(2, 9))}</p>" if self.draw.random() < 0.5 else "")
        return self.tag(HEADER, inner + (self.nav() if self.draw.random() < 0.5 else ""), semantic="header")

    def footer(self) -> str:
        draw = self.draw
        inner = f"&copy; {escape(self.words(1, 4))} &middot; {escape(self.prose())}" if draw.random() < 0.5 else escape(self.phrase("footer"))
        inner = f"<p>{inner}</p>" if draw.random() < 0.5 else inner
        return self.tag(FOOTER, inner + (self.links("footer") if draw.random() < 0.4 else ""), semantic="footer")

    def ad(self) -> str:
        inner = escape(self.phrase("ad") if self.draw.random() < 0.4 else self.prose())
        inner = self.draw.choice([inner, f"<p>{inner}</p>", self.link(self.words(2, 8)), f"{inner}<br>{self.link(self.words(1, 3))}"])
        return f"<!-- ad {self.draw.randrange(99)} -->" * self.draw.randrange(2) + self.named(AD, inner, "aside")

    def named(self, names: list[str], inner: str, semantic: str = "") -> str:
        """Parts that nothing but a name tells from main text always have one."""
        plain, self.plain = self.plain, False
        out = self.tag(names, inner, semantic="")
        self.plain = plain
        return out

    def notice(self) -> str:
        return self.named(NOTICE, f"<p>{escape(self.phrase('notice') if self.draw.random() < 0.6 else self.prose())}</p><button>OK</button>")

    def form(self) -> str:
        inner = f'<label>{escape(self.phrase("form"))}</label><input name="q"><button>{escape(self.phrase("form"))}</button>'
        inner += f"<p>{escape(self.prose())}</p>" if self.draw.random() < 0.3 else ""
        inner += "<select><option>1<option>2</select>" if self.draw.random() < 0.2 else ""
        return self.draw.choice([f'<form action="/s">{inner}</form>', self.named(FORM, f"<form>{inner}</form>")])

    def side(self) -> str:
        draw = self.draw
        parts = [f"<h3>{escape(self.phrase('side'))}</h3>", self.links("side")]
        parts += [f"<p>{escape(self.prose())}</p>" for _ in range(draw.randrange(3))]
        inner = "".join(parts)
        return f"<aside>{inner}</aside>" if draw.random() < 0.3 else self.named(SIDE, inner)

    def share(self) -> str:
        return self.named(SHARE, self.links("share", 1, 4))

    def comments(self) -> str:
        draw, out = self.draw, []
        for _ in range(draw.randrange(1, 6)):
            body = "".join(f"<p>{escape(self.prose())}</p>" for _ in range(draw.randrange(1, 4)))
            inner = f"<b>{escape(self.words(1, 2))}</b> {escape(self.phrase('comment'))}{body}"
            out.append(draw.choice([f'<li class="comment">{inner}</li>', f'<article class="comment">{inner}</article>', f"<div class='reply'>{inner}</div>", f"<div>{inner}</div>"]))
        title = f"<h3>{escape(self.phrase('comment'))}</h3>" * draw.randrange(2)
        return self.named(COMMENT, title + "".join(out) + (self.form() if draw.random() < 0.4 else ""))

    def marked(self, tag: str, text: str) -> str:
        draw = self.draw
        text = escape(text)
        if draw.random() < 0.25 and " " in text:
            words = text.split(" ")
            at = draw.randrange(len(words))
            words[at] = draw.choice([f"<b>{words[at]}</b>", f'<a href="/x">{words[at]}</a>', f"<em>{words[at]}</em>", f"{words[at]}<br>"])
            text = " ".join(words)
        return f"<{tag}>{MARK}{text}" + (f"</{tag}>" if tag != "p" or draw.random() < 0.9 else "")

    def main(self) -> str:
        draw = self.draw
        kind = draw.choice(["p", "p", "p", "div"])
        parts = [self.marked(draw.choice(["h1", "h1", "h2"]), self.words(2, 12))] if draw.random() < 0.85 else []
        for _ in range(draw.choice([1, 2, 4, 8, 16, 24])):
            what = draw.random()
            if what < 0.75:
                lead = "<b>" if draw.random() < 0.1 else ""
                parts.append(lead + self.marked(kind, self.prose()))
            elif what < 0.82:
                parts.append(self.marked(draw.choice(["h2", "h3"]), self.words(1, 8)))
            elif what < 0.88:
                parts.append("<ul>" + "".join(self.marked("li", self.words(1, 25)) for _ in range(draw.randrange(1, 5))) + "</ul>")
            elif what < 0.91:
                parts.append(f"<blockquote>{self.marked('p', self.prose())}</blockquote>")
            elif what < 0.93:
                parts.append("<table><tr>" + "".join(self.marked("td", self.words(1, 4)) for _ in range(3)) + "</tr></table>")
            elif what < 0.95:
                parts.append(f"<figure><img src='x'>{self.marked('figcaption', self.words(3, 12))}</figure>")
            else:
                parts.append(draw.choice([self.ad, self.share, self.side, self.form, self.notice])())
        inner = "".join(parts)
        if draw.random() < 0.3:
            inner = f"<div class='{draw.choice(NEUTRAL)}'>{inner}</div>"
        if draw.random() < 0.35:
            return f"<article>{inner}</article>"
        tags = ("div", "section", "td") if draw.random() < 0.1 else ("div", "section")
        out = self.tag(MAIN, inner, tags, draw.choice(["article", "main"]))
        return f"<table><tr>{out}</tr></table>" if out.startswith("<td") else out

    def page(self) -> str:
        draw = self.draw
        self.plain = draw.random() < 0.15
        before = [f for f, share in ((self.notice, 0.2), (self.header, 0.4), (self.nav, 0.7), (self.ad, 0.4), (self.side, 0.2), (self.form, 0.15)) if draw.random() < share]
        after = [f for f, share in ((self.share, 0.2), (self.comments, 0.35), (self.side, 0.35), (self.form, 0.2), (self.ad, 0.2), (self.notice, 0.1)) if draw.random() < share]
        if draw.random() < 0.3:
            draw.shuffle(before)
        body = "".join(f() for f in before) + self.main() + "".join(f() for f in after)
        if draw.random() < 0.9:
            body += self.footer()
        if draw.random() < 0.3:
            body = self.tag(NEUTRAL, body)
        head = f"<head><title>{escape(self.words(2, 9))}</title><style>p{{margin:0}}</style></head>"
        return f"<!DOCTYPE html><html>{head}<body>{body}</body></html>"
