"""Labelled pages to train the extractor on: pages of the given table, and layouts drawn at random.

A drawn page marks each text with a private character that says whether it belongs to the article.
The marks are read off the parsed blocks and taken out again, so a page and its labels cannot differ.
"""

from __future__ import annotations

import random

MAIN, OTHER = "\ue000", "\ue001"

SYLLABLES = "an be ca de el fi go ha in ju ka lo mi no or pe qui ra se ti un va wi xo ye zu thr st en er ou al".split()


class Writer:
    """Draws texts and page parts."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def word(self) -> str:
        return "".join(self.r.choice(SYLLABLES) for _ in range(self.r.choice((1, 1, 2, 2, 3, 4))))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(low, high)))

    def sentence(self, low: int = 2, high: int = 22) -> str:
        text = self.words(low, high)
        if self.r.random() < 0.4:
            text = text.replace(" ", ", ", 1)
        return text[:1].upper() + text[1:] + self.r.choice("....?!")

    def prose(self, low: int = 1, high: int = 6) -> str:
        return " ".join(self.sentence() for _ in range(self.r.randint(low, high)))

    def pick(self, *choices: str) -> str:
        return self.r.choice(choices)

    def named(self, *names: str) -> str:
        """An attribute with one of the names, at times within a longer one or with a meaningless one."""
        name = self.pick(*names)
        shape = self.r.random()
        if shape < 0.08:
            return ""
        name = name if shape < 0.6 else self.pick(f"{name}-{self.word()}", f"{self.word()}-{name}", f"{name} {self.word()}", f"{self.word()}_{name}")
        return f' {self.pick("class", "class", "id")}="{name}"'

    # Parts of the article.

    def paragraph(self) -> str:
        shape, text = self.r.random(), self.prose()
        if shape < 0.15:
            text = self.words(1, 4) + self.pick("", ".")
        elif shape < 0.25:
            text = f'{text} <a href="/{self.word()}">{self.words(1, 3)}</a> {self.sentence()}'
        elif shape < 0.3:
            return f"<p><b>{MAIN}{text}<br><p>"
        elif shape < 0.36:
            return f"<p>{MAIN}{text}"
        elif shape < 0.42:
            return f"<div>{MAIN}{text}</div>"
        elif shape < 0.47:
            return f"<blockquote><p>{MAIN}{text}</p></blockquote>"
        elif shape < 0.52:
            return "<ul>" + "".join(f"<li>{MAIN}{self.words(1, 14)}</li>" for _ in range(self.r.randint(2, 5))) + "</ul>"
        elif shape < 0.55:
            return f"<pre>{MAIN}{self.words(3, 20)}</pre>"
        elif shape < 0.58:
            return f"<h2>{MAIN}{self.words(1, 6)}</h2>"
        elif shape < 0.61:
            return f"<table><tr><td>{MAIN}{self.words(1, 3)}</td><td>{MAIN}{self.words(1, 3)}</td></tr></table>"
        elif shape < 0.63:
            return f"<figure><img src=x><figcaption>{MAIN}{self.sentence()}</figcaption></figure>"
        elif shape < 0.67:
            text = " | ".join(self.words(1, 2) for _ in range(self.r.randint(4, 20)))
        return f"<p>{MAIN}{text}</p>"

    def article(self) -> str:
        parts = [f"<h1>{MAIN}{self.words(2, 12)}</h1>"] if self.r.random() < 0.85 else []
        for _ in range(self.r.randint(1, 12)):
            parts.append(self.paragraph())
            if self.r.random() < 0.06:
                parts.append(self.pick(self.advert(), self.share(), self.related()))
        body = "".join(parts)
        names = ("content", "post", "entry", "article", "story", "body", "text", "main")
        shape = self.r.random()
        if shape < 0.4:
            return f"<article{self.named(*names) if self.r.random() < 0.4 else ''}>{body}</article>"
        if shape < 0.55:
            return f"<main>{body}</main>"
        if shape < 0.65:
            return f"<main><article>{body}</article></main>"
        if shape < 0.72:
            return f"<section{self.named(*names)}>{body}</section>"
        if shape < 0.77:
            return f"<table><tr><td>{body}</td></tr></table>"
        return f"<div{self.named(*names)}>{body}</div>"

    # Everything else.

    def links(self, low: int, high: int) -> str:
        items = [f'<a href="/{self.word()}">{OTHER}{self.words(1, 3)}</a>' for _ in range(self.r.randint(low, high))]
        if self.r.random() < 0.7:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        return self.pick(" ", " | ").join(items)

    def menu(self) -> str:
        links = self.links(3, 9)
        return links if self.r.random() < 0.03 else self.pick(f"<nav>{links}</nav>", f"<nav>{links}</nav>", f"<div{self.named('nav', 'menu', 'navigation', 'breadcrumb', 'topbar')}>{links}</div>")

    def head(self) -> str:
        inside = f"<{self.pick('div', 'h1', 'p', 'h2')}>{OTHER}{self.words(1, 4)}</>".replace("</>", "</div>") + f"<p>{OTHER}{self.words(2, 9)}</p>"
        inside += self.pick("", self.menu(), f'<a href="/login">{OTHER}Sign in</a>')
        return self.pick(f"<header>{inside}</header>", f"<div{self.named('header', 'masthead', 'logo', 'banner', 'site-header')}>{inside}</div>")

    def foot(self) -> str:
        said = self.pick("&copy; ", "Copyright ", "© ") + self.words(1, 3) + self.pick("", " &middot; " + self.sentence(), " All rights reserved.", ". " + self.prose(1, 3))
        inside = self.pick(f"{OTHER}{said}", f"<p>{OTHER}{said}</p>") + self.pick("", self.links(2, 6), f"<p>{OTHER}Privacy policy, terms</p>")
        return self.pick(f"<footer>{inside}</footer>", f"<footer>{inside}</footer>", f"<div{self.named('footer', 'copyright', 'bottom', 'legal')}>{inside}</div>")

    def side(self) -> str:
        inside = f"<h3>{OTHER}{self.pick('Related', 'Popular', 'Recent posts', 'Latest', 'About', self.words(1, 3))}</h3>"
        inside += self.pick(self.links(3, 8), f"<p>{OTHER}{self.prose(1, 3)}</p>", f"<div>{OTHER}{self.prose(1, 2)}</div>" + self.links(1, 4))
        return self.pick(f"<aside>{inside}</aside>", f"<aside{self.named('sidebar', 'widget')}>{inside}</aside>", f"<div{self.named('sidebar', 'side', 'widget', 'rail', 'aside', 'column')}>{inside}</div>")

    def related(self) -> str:
        return f"<div{self.named('related', 'recommended', 'more', 'teaser', 'popular')}><h4>{OTHER}{self.pick('Related', 'Read more', 'More', self.words(1, 3))}</h4>{self.links(2, 5)}</div>"

    def notice(self) -> str:
        said = self.pick("We use cookies to ", "This site uses cookies. ", "Accept ", "Please note ", "", "") + self.prose(1, 3)
        tag = self.pick("div", "div", "section", "p", "aside", "dialog")
        return f"<{tag}{self.named('notice', 'cookie', 'banner', 'alert', 'consent', 'gdpr', 'warning', 'popup', 'message', 'disclaimer')}>{OTHER}{said}{self.pick('', '<button>' + OTHER + 'Accept</button>')}</{tag}>"

    def advert(self) -> str:
        said = self.pick("", "Advertisement ", "Sponsored ") + self.prose(1, 3)
        tag = self.pick("div", "div", "div", "aside", "section", "p")
        return f"<{tag}{self.named('ad', 'ad', 'ads', 'advert', 'advertisement', 'sponsored', 'promo', 'sponsor')}>{OTHER}{said}</{tag}>"

    def share(self) -> str:
        return f"<div{self.named('share', 'social', 'tags', 'meta', 'tools')}>{OTHER}{self.pick('Share', 'Tweet', 'Follow us', 'Tags: ' + self.words(1, 3))} {self.links(1, 4)}</div>"

    def form(self) -> str:
        return (f"<form{self.named('search', 'newsletter', 'login', 'subscribe', 'contact')}><label>{OTHER}{self.pick('Email', 'Search', 'Name', self.words(1, 2))}</label><input>"
                + self.pick("", f"<p>{OTHER}{self.sentence()}</p>", f"<select><option>{OTHER}{self.word()}<option>{OTHER}{self.word()}</select>")
                + f"<button>{OTHER}{self.pick('Subscribe', 'Send', 'Go', 'Log in')}</button></form>")

    def comments(self) -> str:
        head = f"<h3>{OTHER}{self.pick('Comments', '3 comments', 'Leave a reply', 'Discussion', 'Responses')}</h3>"
        names = ("comment", "comments", "discussion", "responses", "replies", "commentlist")
        said = [f"<div{self.named('comment', 'reply', 'comment-body')}><b>{OTHER}{self.word()}</b> <p>{OTHER}{self.prose(1, 4)}</p></div>"
                if self.r.random() < 0.5 else f"<li><p>{OTHER}{self.prose(1, 4)}</p></li>" for _ in range(self.r.randint(1, 6))]
        inside = (head if self.r.random() < 0.8 else "") + "".join(said)
        tag = self.pick("section", "div", "ol", "aside")
        return f"<{tag}{self.named(*names)}>{inside}</{tag}>"

    def page(self) -> str:
        r = self.r
        before = [part() for part in (self.head, self.menu, self.notice, self.advert, self.form, self.side, self.share) if r.random() < 0.35]
        after = [part() for part in (self.comments, self.side, self.related, self.advert, self.form, self.share, self.menu, self.notice) if r.random() < 0.3]
        if r.random() < 0.85:
            after.append(self.foot())
        r.shuffle(before)
        body = "".join([*before, self.article(), *after])
        if r.random() < 0.4:
            body = f"<div{self.named('wrapper', 'container', 'page', 'site', 'layout', 'content')}>{body}</div>"
        whole = f"<!DOCTYPE html><html><head><title>{self.words(2, 6)}</title></head><body>{body}"
        return whole + self.pick("</body></html>", "</body></html>", "")


def drawn_pages(count: int, seed: int = 7) -> list[str]:
    """Pages whose texts carry the marks."""
    writer = Writer(seed)
    return [writer.page() for _ in range(count)]
