"""Web pages as sequences of leaf blocks, and pages of invented layouts to learn from.

A block is the text between two tags of block elements, with the path of elements it lies in. ``invented_page`` writes a
page around given paragraphs in one of many layouts and marks the blocks of its article.
"""

from __future__ import annotations

import random
import re
from html import escape
from html.parser import HTMLParser
from typing import NamedTuple

# Elements of HTML. Those whose text is never shown, those without content, those that flow inside a line.
HIDDEN = frozenset("head title script style noscript template svg math iframe object audio video canvas datalist".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em embed font i img ins kbd label map mark meter nobr output "
    "picture progress q rp rt ruby s samp small source span strike strong sub sup time track tt u var wbr".split()
)
# A start tag of these ends an open element of the same set, up to the nearest of the scopes.
CLOSED_BY = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[^\x00-\x7f]+")
DEEPEST = 512  # elements of a path; what is nested deeper counts as lying in the last of them


class Block(NamedTuple):
    path: tuple[str, ...]  # elements from the outermost: "div content main" is an element and the words of its names
    text: str
    in_links: int  # characters inside links


class BlockReader(HTMLParser):
    """Collects the blocks of a page, as far as it goes; tags left open or closed in any order do not matter."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.tags: list[str] = []
        self.shown: list[str] = []
        self.parts: list[str] = []
        self.hidden: list[str] = []
        self.links = self.in_links = 0

    def read(self, html: str) -> list[Block]:
        self.feed(html)
        self.close()
        self._end_block()
        return self.blocks

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.hidden:
            if tag in HIDDEN:
                self.hidden.append(tag)
            elif tag == "body":
                self.hidden.clear()  # a head that was left open
            return
        if tag in HIDDEN:
            self.hidden.append(tag)
            if tag == "head":
                self._end_block()
        elif tag == "br":
            self.parts.append(" ")
        elif tag == "a":
            self.links = 1
        elif tag not in INLINE:
            self._end_block()
            self._close_open(tag)
            if tag not in VOID and len(self.tags) < DEEPEST:
                self.tags.append(tag)
                self.shown.append(self._element(tag, attrs))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag in ("svg", "math"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if self.hidden:
            if tag in self.hidden:
                del self.hidden[self.hidden.index(tag) :]
            return
        if tag == "a":
            self.links = 0
        elif tag not in INLINE:
            self._end_block()
            if tag in self.tags:
                self._cut(len(self.tags) - 1 - self.tags[::-1].index(tag))

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.parts.append(data)
            if self.links:
                self.in_links += len(data)

    def _element(self, tag: str, attrs: list[tuple[str, str | None]]) -> str:
        words = []
        for name, value in attrs:
            if value and name in ("class", "id", "role", "itemprop", "aria-label"):
                words += [w.lower() for w in NAME_PARTS.findall(value)]
        return " ".join([tag, *dict.fromkeys(words)]) if words else tag

    def _close_open(self, tag: str) -> None:
        if "p" in self.tags:  # no block element lies in a paragraph
            self._cut(len(self.tags) - 1 - self.tags[::-1].index("p"))
        same, scopes = CLOSED_BY.get(tag, ((), ()))
        for i in range(len(self.tags) - 1, -1, -1) if same else ():
            if self.tags[i] in scopes:
                break
            if self.tags[i] in same:
                self._cut(i)

    def _cut(self, size: int) -> None:
        del self.tags[size:]
        del self.shown[size:]
        self.links = 0

    def _end_block(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.blocks.append(Block(tuple(self.shown), text, min(self.in_links, len(text))))
            self.parts = []
            self.in_links = 0


def read_blocks(html: str | None) -> list[Block]:
    """The blocks of a page in order: white space inside is one space, character references are decoded."""
    return BlockReader().read(html) if html else []


# Invented layouts. Words that pages commonly use to name their parts.
ARTICLE_NAMES = "content article post entry story main text body page news blog".split()
OTHER_NAMES = {
    "menu": "nav menu navbar navigation breadcrumb breadcrumbs topnav links toc tabs skip".split(),
    "header": "header masthead head top topbar branding logo banner hero title".split(),
    "footer": "footer colophon copyright legal bottom foot credits imprint".split(),
    "sidebar": "sidebar side widget aside related recommended popular trending archive recent more rail teaser".split(),
    "notice": "notice cookie cookies consent gdpr alert message popup modal paywall warning privacy overlay info".split(),
    "advert": "ad ads advert advertisement sponsor sponsored promo promotion adsense banner commercial".split(),
    "form": "form search newsletter subscribe signup login contact register".split(),
    "comments": "comments comment discussion replies reply responses disqus reviews respond reader thread feedback".split(),
    "share": "share social follow tags categories meta pagination pager author byline buttons".split(),
}
OTHER_TAGS = {
    "menu": "nav nav ul div td".split(),
    "header": "header header div".split(),
    "footer": "footer footer div".split(),
    "sidebar": "aside aside div section td".split(),
    "notice": "div div section p aside".split(),
    "advert": "div div aside section".split(),
    "form": ["form"],
    "comments": "section div div ol".split(),
    "share": "div ul p".split(),
}
OTHER_ENDS = "list box area wrap wrapper container section block inner bar panel item".split()
FRAMES = "wrapper container page row col layout grid site outer inner root app body main".split()
PHRASES = {
    "notice": ["We use cookies to improve this site.", "Accept all", "Subscribe to read on", "Your browser is out of date."],
    "advert": ["Advertisement", "Sponsored", "Buy now", "Order today and save"],
    "form": ["Name", "E-mail", "Search", "Send", "Sign up", "Your message", "Password"],
    "comments": ["Comments", "Leave a reply", "Reply", "3 comments", "Anonymous says:"],
    "share": ["Share", "Tweet", "Next page", "Previous", "Filed under", "By the editors"],
    "sidebar": ["Related posts", "Most read", "Recent", "About us", "Archive"],
    "footer": ["© 2024", "All rights reserved", "Imprint", "Contact", "Privacy"],
    "menu": ["Home", "News", "About", "Skip to content"],
    "header": ["Home", "Log in", "The daily page"],
}
LOOSE_WORDS = "an ever lo mi ta ren sol kun del par tis om nel var ost ein hal por ske bru la do re"  # where no text is given
MARK = "\ue000"  # before the text of an article's block


class Inventor:
    """Pages of invented layouts around the paragraphs it is given."""

    def __init__(self, seed: int, prose: list[str]) -> None:
        self.rng = random.Random(seed)
        self.prose = prose
        self.wordy = False  # whether the parts around the article hold prose, too, so that only their names tell

    def chance(self, p: float) -> bool:
        return self.rng.random() < p

    def some(self, least: int, most: int) -> int:
        return min(self.rng.randint(least, most) for _ in range(2))

    def words(self, least: int, most: int) -> str:
        text = self.rng.choice(self.prose) if self.prose and self.chance(0.9) else ""
        words = text.split() or self.rng.choices(LOOSE_WORDS.split(), k=most)
        n = self.rng.randint(least, most)
        at = self.rng.randrange(max(1, len(words) - n + 1))
        return " ".join(words[at : at + n])

    def paragraph(self) -> str:
        if self.prose and self.chance(0.8):
            return self.rng.choice(self.prose)
        return ". ".join(self.words(4, 25).capitalize() for _ in range(self.rng.randint(1, 5))) + "."

    def noise(self) -> str:
        return "".join(self.rng.choices("abcdefghijklmnopqrstuvwxyz", k=self.rng.randint(2, 5))) + str(self.rng.randint(0, 99))

    def attributes(self, name: str | None) -> str:
        words = [name] if name else []
        if self.chance(0.25):
            words.insert(self.rng.randint(0, len(words)), self.noise())
        if not words:
            return ""
        if len(words) == 1 and self.chance(0.3):
            return f' id="{words[0]}"'
        return f' class="{" ".join(words)}"'

    def wrapped(self, tag: str, name: str | None, inner: str) -> str:
        return f"<{tag}{self.attributes(name)}>{inner}</{tag}>"

    def name_of(self, kind: str) -> str:
        word = self.rng.choice(OTHER_NAMES[kind])
        form = self.rng.random()
        join = self.rng.choice("--_")
        if form < 0.15:
            return f"{word}{join}{self.rng.choice(OTHER_ENDS)}"
        if form < 0.3:
            return f"{self.rng.choice([*ARTICLE_NAMES, 'site', 'top', 'left', 'right'])}{join}{word}"
        if form < 0.36:
            return word + self.rng.choice(OTHER_ENDS).capitalize()
        return word

    def other(self, kind: str) -> str:
        """A part of a page that is not its article."""
        tag = self.rng.choice(OTHER_TAGS[kind])
        # Elements that say what they are need no name.
        name = None if tag in ("nav", "header", "footer", "aside", "form") and self.chance(0.6) else self.name_of(kind)
        items = []
        for _ in range(1 if tag == "p" else self.some(1, 10 if kind in ("menu", "comments") else 5)):
            phrase = self.rng.choice(PHRASES[kind]) if kind in PHRASES and self.chance(0.1 if self.wordy else 0.25) else None
            often = 0.75 if kind == "comments" else 0.4 if kind in ("notice", "advert", "sidebar") else 0.08
            long = self.chance(0.8 if self.wordy else often)
            text = escape(phrase or (self.paragraph() if long else self.words(1, 8)))
            if kind == "footer" and self.chance(0.5):
                text = f"&copy; {text}"
            linked = {"menu": 0.9, "sidebar": 0.5, "share": 0.6, "footer": 0.3}.get(kind, 0.1)
            if self.chance(0.1 if self.wordy else linked):
                text = f'<a href="/">{text}</a>'
            if tag == "p":
                items.append(text)
            elif tag in ("ul", "ol"):
                inner = f"<p>{text}</p>" if self.chance(0.3) else text
                items.append(self.wrapped("li", self.rng.choice(OTHER_NAMES[kind]) if self.chance(0.2) else None, inner))
            else:
                inside = self.rng.choice(["p", "p", "div", "h3", "h4", "li", "span", ""])
                own = self.rng.choice(OTHER_NAMES[kind]) if self.chance(0.2) else None
                if self.wordy and self.chance(0.7):
                    inside = "p"
                if kind == "header" and self.chance(0.3):
                    inside = self.rng.choice(["h1", "h2"])
                items.append(self.wrapped(inside, own, text) if inside else f"{text} ")
        inner = "".join(items)
        if tag == "nav" and self.chance(0.6):
            inner = f"<ul>{''.join(f'<li>{i}</li>' for i in items)}</ul>"
        return self.wrapped(tag, name, inner)

    def article_block(self) -> str:
        kind = self.rng.random()
        text = MARK + escape(self.paragraph())
        short = MARK + escape(self.words(1, 10))
        if kind < 0.7:
            if self.chance(0.15):
                return f"<p><b>{text}<br>"  # left open
            if self.chance(0.1):
                return f'<p>{text} <a href="/">{escape(self.words(1, 4))}</a> {escape(self.words(1, 9))}</p>'
            return self.wrapped("p", None, text)
        if kind < 0.8:
            return self.wrapped(self.rng.choice(["h2", "h3"]), None, short)
        if kind < 0.88:
            rows = "".join(f"<li>{MARK}{escape(self.words(1, 20))}</li>" for _ in range(self.rng.randint(1, 5)))
            return f"<ul>{rows}</ul>" if self.chance(0.5) else f"<ol>{rows}</ol>"
        if kind < 0.93:
            return f"<blockquote><p>{text}</p></blockquote>" if self.chance(0.5) else f"<blockquote>{text}</blockquote>"
        if kind < 0.96:
            cells = "".join(f"<td>{MARK}{escape(self.words(1, 4))}</td>" for _ in range(self.rng.randint(2, 4)))
            return f"<table><tr>{cells}</tr></table>"
        return f"<div>{text}</div>" if kind < 0.99 else f"<pre>{text}</pre>"

    def article(self) -> str:
        blocks = [self.article_block() for _ in range(self.rng.choice([1, 2, 3, 4, 6, 8, 12, 20, 40]))]
        if self.chance(0.35):
            kind = self.rng.choice(["advert", "share", "sidebar", "notice", "form", "comments"])
            place = len(blocks) if kind == "comments" else self.rng.randint(0, len(blocks))
            blocks.insert(place, self.other(kind))
        if self.chance(0.85):
            heading = f"<h1>{MARK}{escape(self.words(1, 12))}</h1>"
            if self.chance(0.25):
                own = f"{self.rng.choice(ARTICLE_NAMES)}-{self.rng.choice(['header', 'title', 'head'])}"
                heading = self.wrapped(self.rng.choice(["header", "header", "div"]), own if self.chance(0.6) else None, heading)
            blocks.insert(0, heading)
        inner = "".join(blocks)
        form = self.rng.random()
        if form < 0.4:
            return self.wrapped("article", self.rng.choice(ARTICLE_NAMES) if self.chance(0.3) else None, inner)
        if form < 0.6:
            return self.wrapped("main", self.rng.choice(ARTICLE_NAMES) if self.chance(0.3) else None, inner)
        name = self.rng.choice(ARTICLE_NAMES)
        if self.chance(0.4):
            name += self.rng.choice("-_") + self.rng.choice([*ARTICLE_NAMES, "inner", "area", "wrap"])
        if form < 0.95:
            return self.wrapped(self.rng.choice(["div", "div", "section", "td"]), name, inner)
        return self.wrapped("div", None, inner)

    def page(self) -> str:
        """HTML of a page; the text of each block of its article begins with MARK."""
        self.wordy = self.chance(0.4)
        before = [k for k, p in (("notice", 0.3), ("header", 0.6), ("menu", 0.7), ("advert", 0.3)) if self.chance(p)]
        after = [k for k, p in (("share", 0.2), ("comments", 0.45), ("sidebar", 0.3), ("form", 0.2)) if self.chance(p)]
        if self.chance(0.3):
            before.append("sidebar")
        if self.chance(0.3):
            self.rng.shuffle(before)
        middle = [self.article(), *map(self.other, after)]
        if self.chance(0.4):
            middle = [self.wrapped(self.rng.choice(["div", "main"]), self.rng.choice(FRAMES), "".join(middle))]
        parts = [*map(self.other, before), *middle]
        if self.chance(0.25):
            parts.append(self.other(self.rng.choice(["advert", "notice", "form"])))
        if self.chance(0.8):
            parts.append(self.other("footer"))
        inner = "".join(parts)
        if self.chance(0.4):
            inner = self.wrapped("div", self.rng.choice(FRAMES), inner)
        if self.chance(0.15):
            return inner
        body = self.wrapped("body", self.rng.choice([*ARTICLE_NAMES, "home", "single"]) if self.chance(0.2) else None, inner)
        head = f"<head><title>{escape(self.words(1, 8))}</title></head>"
        return body if self.chance(0.1) else f"<!DOCTYPE html><html>{head}{body}</html>"


def invented_page(inventor: Inventor) -> tuple[list[Block], list[int]]:
    """Blocks of an invented page, and 1 for each of its article's."""
    blocks, labels = [], []
    for block in read_blocks(inventor.page()):
        labels.append(int(MARK in block.text))
        blocks.append(block._replace(text=block.text.replace(MARK, "")))
    return blocks, labels
