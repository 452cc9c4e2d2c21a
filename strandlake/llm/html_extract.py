"""Main text of web pages: a linear-chain conditional random field over DOM leaf blocks.

A page is cut into leaf blocks: the runs of text between block-level tags, each with its path of ancestors.
Features of a block are its ancestors' tags, the words of their class, id and role attributes, and traits of
its own text (length, share of link text, punctuation, marks of boilerplate). The field has two states, main
text and boilerplate; Viterbi gives the best sequence of the page, and the main blocks, joined by one space,
are its text.

Besides, each block knows its container (the innermost div, section, cell and the like), how much of the page's
text stands in it, and whether it lies in the cores of the page: the deepest containers that hold, with all that is
nested in them, half and four fifths of its text outside links. So an article without telling tags or names is found
by its weight, however its paragraphs are nested.

The field is trained on labelled pages of two kinds. training_pages() lays out TRAINING_PAGES with a fixed seed:
articles of several markups among menus, headers, footers, sidebars, notices, adverts, forms and reader comments,
with long boilerplate and short paragraphs, nested in plain divs or broken by br alone in part, many under names that
say nothing. labelled_pages() takes at most LABELLED_PAGES of the given pages that mark their main text by one `<article>`
and have LABELLED_CHARS characters at most, by least hash, and puts each in as it is and once more with article and main
renamed to div and without class, id and role, as long as all together have LABELLED_BLOCKS blocks at most. Parts of an
article whose tag or names mark them as a menu, side, notice, advert, form, footer or comment are no main text. The fit's
memory follows the number of blocks; pages are cut into chains of CHAIN blocks for it.

Defined results: a null or empty page, and one without main text, give "". Scripts, styles, templates,
comments and form controls are no text. Repeated rows are each extracted. An empty table gives an empty
result. Other columns are ignored, whatever their names. Broken markup (tags never closed or never opened,
cut-off comments) is read on to the end of the page, in linear time.
"""

from __future__ import annotations

import html as html_chars
import random
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.llm.text import table
from strandlake.session import spread

TRAINING_PAGES, LABELLED_PAGES = 1000, 200
LABELLED_CHARS, LABELLED_BLOCKS, CHAIN = 1 << 18, 40_000, 256

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*)>""", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role|aria-label|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
HIDDEN = re.compile(r"hidden|display\s*:\s*none", re.I)
ANY_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)

#: Elements whose content is no text, that hold no content, and that flow within a line.
RAW = frozenset("script style template svg iframe canvas textarea select button title head annotation annotation-xml".split())
RAW_TEXT = {tag: re.compile(f"</{tag}", re.I | re.A) for tag in "script style textarea title iframe".split()}
CONTAINERS = frozenset("article aside body center div footer form header main nav section td th".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr param mspace".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img math mi mn mo ms mtext mrow msup msub msubsup mfrac msqrt mroot mstyle mover munder munderover mmultiscripts mpadded mphantom menclose merror mtable mtr mtd semantics annotation annotation-xml".split())
CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
BARRIER = frozenset("ul ol dl table article section div main aside nav header footer form body html blockquote td th".split())
HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title head".split())
BLOCK_STARTS = frozenset("address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())


def hides(attributes: str) -> bool:
    """Whether the attributes of a tag hide it: hidden, display:none in style, or aria-hidden=true."""
    if not HIDDEN.search(attributes):
        return False
    for m in ANY_ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or (name == "style" and NO_DISPLAY.search(value)) or (name == "aria-hidden" and value.strip().rstrip("/").lower() == "true"):
            return True
    return False


@dataclass(slots=True)
class Block:
    text: str
    path: tuple[str, ...]
    links: int  # characters of link text
    home: int = 0  # number of its container
    mass: float = 1.0  # text of its container against the container that has most
    core: str = ""  # where it lies to the deepest containers of half and of four fifths of the page's text


def leaf_blocks(page: str) -> list[Block]:
    """Leaf blocks in page order, white space within each turned into single spaces."""
    blocks: list[Block] = []
    stack: list[tuple[str, str, int]] = []  # (tag, its entry in the path, number of its container)
    parts: list[str] = []
    links = skip = 0  # skip: open elements whose content is no text
    link_open = False

    def flush() -> None:
        nonlocal links
        if parts:
            text = " ".join(html_chars.unescape("".join(parts)).split())
            if text:
                blocks.append(Block(text, tuple(e for t, e, _ in stack if t not in INLINE), links, stack[-1][2] if stack else 0))
            parts.clear()
        links = 0

    def close(upto: int) -> None:
        nonlocal skip, link_open
        for tag, entry, _ in stack[upto:]:
            skip -= tag in RAW or entry == HIDE
            link_open &= tag != "a"
        del stack[upto:]

    at, n, parents = 0, len(page), [0]  # parents: the container around each container; 0 is the page
    while at < n:
        m = TOKEN.search(page, at)
        if stack and stack[-1][0] == "head" and page[at : m.start() if m else n].strip():
            close(len(stack) - 1)  # text ends the head, as does any element that has no place there
        if m is None:
            if not skip:
                parts.append(page[at:])
            break
        if m.start() > at and not skip:
            parts.append(page[at : m.start()])
            links += (m.start() - at) * link_open
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), None)
            if tag not in INLINE:
                flush()
            if k is not None and not (tag in INLINE and any(t in BARRIER for t, _, _ in stack[k:])):
                close(k)
            continue
        if stack and tag not in HEAD and (stack[-1][0] == "head" or tag == "body"):
            k = next((k for k, (t, _, _) in enumerate(stack) if t == "head"), None)
            if k is not None:
                close(k)
        if tag in VOID:
            if tag in ("br", "hr"):
                parts.append("\n")
            continue
        if tag not in INLINE:
            flush()
            shut = CLOSES.get(tag, ()) + (("p",) if tag in BLOCK_STARTS else ())
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in shut:
                    close(k)
                    break
                if stack[k][0] in BARRIER:
                    break
        attributes = m[3]
        entry = tag
        if attributes:
            if hides(attributes):
                entry = HIDE
            else:
                entry = " ".join([tag, *sorted({w for a in ATTRIBUTE.finditer(attributes) for name in (a[2] or a[3] or a[4] or "").split() for w in part_words(name)})])
            if attributes.endswith("/") and tag not in INLINE and tag not in BLOCK_STARTS:
                continue
        if tag in RAW_TEXT:
            end = RAW_TEXT[tag].search(page, at)
            at = end.start() if end else n
        home = stack[-1][2] if stack else 0
        if tag in CONTAINERS:
            parents.append(home)
            home = len(parents) - 1
        stack.append((tag, entry, home))
        skip += tag in RAW or entry == HIDE
        link_open |= tag == "a"
    flush()
    weigh(blocks, parents)
    return blocks


def weigh(blocks: list[Block], parents: list[int]) -> None:
    """Sets mass and core of the blocks; parents are numbered before what they contain."""
    own = [0] * len(parents)
    for b in blocks:
        own[b.home] += len(b.text) - b.links
    most = max(own)
    total, heaviest = own[:], [0] * len(parents)
    for c in range(len(parents) - 1, 0, -1):
        up = parents[c]
        total[up] += total[c]
        if not heaviest[up] or total[c] >= total[heaviest[up]]:
            heaviest[up] = c
    cores = []
    for share in (0.5, 0.8):
        core = 0
        while heaviest[core] and total[heaviest[core]] >= share * max(total[0], 1):
            core = heaviest[core]
        inside = [False] * len(parents)
        for c in range(core, len(parents)):
            inside[c] = c == core or (c > core and inside[parents[c]])
        cores.append((core, inside))
    for b in blocks:
        b.mass = own[b.home] / most if most else 1.0
        b.core = "".join("o" if b.home == core else "i" if inside[b.home] else "x" for core, inside in cores)


HIDE = "(hidden)"
_names: dict[str, list[str]] = {}


def part_words(name: str) -> list[str]:
    """Words of one class or id that name a part of a page: "siteFooter-top2" gives footer. Where other words stand
    beside them ("side-effects"), they are marked as doubtful: ~side."""
    if name not in _names:
        if len(_names) > 10_000:
            _names.clear()
        words = [w.lower() for w in re.findall(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])", name)]
        doubt = "" if all(w in PART_OF or w in NEUTRAL for w in words) else "~"
        _names[name] = [doubt + w for w in words if w in PART_OF]
    return _names[name]


#: Words that name a part of a page in class, id and role attributes, by the part.
PARTS = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs toc pagination pager tabs skip".split(),
    "header": "header masthead topbar logo branding hero".split(),
    "footer": "footer foot bottom colophon copyright legal".split(),
    "side": "sidebar side aside widget rail related recommended popular trending tags share social author bio complementary".split(),
    "notice": "notice cookie cookies consent gdpr alert popup modal overlay toast message warning disclaimer announcement subscribe newsletter paywall".split(),
    "advert": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion sponsors promoted adsense banner".split(),
    "form": "form search login signup contact feedback poll".split(),
    "comment": "comment comments discussion replies reply respond disqus thread reviews responses".split(),
    "main": "article content main post entry story body text page blog prose articlebody maincontent".split(),
}
NEUTRAL = frozenset("site page x box wide container wrapper wrap block area list item items inner outer top left right section row col column global primary secondary first last js widget wp the id".split())
REGIONS = frozenset("article aside footer form header main nav".split())
PART_OF = {w: part for part, ws in PARTS.items() for w in ws}
TRAITS = re.compile(r"(©|\ball rights reserved\b|\bcopyright\b)|(\bcookies?\b|\bprivacy policy\b)|(\bsubscribe\b|\bsign (?:up|in)\b|\blog in\b|\bread more\b|\bshare\b|\bclick here\b)|(\breply\b|\bsays:|\bposted by\b)", re.I)


def path_features(path: tuple[str, ...]) -> list[str]:
    out, nearest = [], []
    for entry in path:
        tag, *names = entry.split(" ")
        here = [f"part:{PART_OF[w]}" if w in PART_OF else f"maybe:{PART_OF[w[1:]]}" for w in names] + [f"region:{tag}"] * (tag in REGIONS)
        nearest = here or nearest
        out += [f"in:{tag}", *here]
    if path:
        out.append(f"own:{path[-1].split(' ')[0]}")
    return list(dict.fromkeys(out + [f"nearest:{x}" for x in nearest]))


def text_features(block: Block) -> list[str]:
    text = block.text
    n = len(text)
    out = ["bias", f"chars:{min(n.bit_length(), 10)}", f"links:{min(4, 4 * block.links // n)}", f"mass:{int(4 * block.mass)}", f"core:{block.core}"]
    out += [f"core:{block.core}:{min(n.bit_length(), 10) // 2}:{min(2, 2 * block.links // n)}"]
    if text[-1] in ".!?":
        out.append("sentence")
    out += [f"trait:{k}" for k in sorted({m.lastindex for m in TRAITS.finditer(text)})]
    return out


@dataclass
class Field:
    """weights: feature -> score of main text against boilerplate; move: 2 x 2 scores between neighbours."""

    weights: dict[str, float]
    move: list[list[float]]
    known: dict[tuple[str, ...], float] = field(default_factory=dict)

    def score(self, block: Block) -> float:
        s = self.known.get(block.path)
        if s is None:
            if len(self.known) > 50_000:
                self.known.clear()
            s = self.known[block.path] = sum(self.weights.get(f, 0.0) for f in path_features(block.path))
        return s + sum(self.weights.get(f, 0.0) for f in text_features(block))

    def decode(self, blocks: list[Block]) -> list[bool]:
        """Viterbi: the states of the best sequence, True for main text."""
        (bb, bm), (mb, mm) = self.move
        boiler = main = 0.0
        back: list[tuple[bool, bool]] = []
        for k, block in enumerate(blocks):
            s = self.score(block)
            if not k:
                boiler, main = 0.0, s
                continue
            from_main_b, from_main_m = main + mb > boiler + bb, main + mm > boiler + bm
            boiler, main = (main + mb if from_main_b else boiler + bb), s + (main + mm if from_main_m else boiler + bm)
            back.append((from_main_b, from_main_m))
        if not blocks:
            return []
        state = main > boiler
        states = [state]
        for b, m in reversed(back):
            state = m if state else b
            states.append(state)
        return states[::-1]

    def main_text(self, page: str) -> str:
        blocks = leaf_blocks(page)
        return " ".join(b.text for b, keep in zip(blocks, self.decode(blocks), strict=True) if keep)


def train(pages: list[tuple[list[Block], list[bool]]], rounds: int = 150, rate: float = 0.3, decay: float = 1e-3) -> Field:
    """Maximum conditional likelihood by AdaGrad. Chains of CHAIN blocks at most go through forward-backward together,
    longest first and place by place, so that nothing is padded: the k-th blocks of all chains that have one lie together."""
    chains = [(b[at : at + CHAIN], y[at : at + CHAIN]) for b, y in pages for at in range(0, len(b), CHAIN)]
    chains.sort(key=lambda c: -len(c[0]))
    alive = np.array([sum(len(b) > t for b, _ in chains) for t in range(len(chains[0][0]))])
    start = np.concatenate([[0], np.cumsum(alive)])
    names: dict[str, int] = {}
    rows, cols = array("q"), array("q")
    y = np.zeros(start[-1], int)
    for c, (blocks, label) in enumerate(chains):
        for t, block in enumerate(blocks):
            y[start[t] + c] = label[t]
            for f in path_features(block.path) + text_features(block):
                rows.append(start[t] + c)
                cols.append(names.setdefault(f, len(names)))
    rows, cols = np.frombuffer(rows, np.int64), np.frombuffer(cols, np.int64)
    w, move = np.zeros(len(names)), np.zeros((2, 2))
    seen_w, seen_move = np.full(len(names), 1e-6), np.full((2, 2), 1e-6)
    here = np.arange(alive[0], start[-1])  # blocks that have one before them in their chain, and those
    before = here - np.repeat(alive[:-1], alive[1:])
    chain = np.concatenate([np.arange(k) for k in alive])
    counted = np.zeros((2, 2))
    np.add.at(counted, (y[before], y[here]), 1)
    ends = np.array([start[len(b) - 1] + c for c, (b, _) in enumerate(chains)])
    for _ in range(rounds):
        s = np.zeros((len(y), 2))
        s[:, 1] = np.bincount(rows, w[cols], minlength=len(y))
        a, b = s.copy(), np.zeros_like(s)
        for t in range(1, len(alive)):
            old = a[start[t - 1] : start[t - 1] + alive[t]]
            a[start[t] : start[t + 1]] += np.logaddexp(old[:, :1] + move[0], old[:, 1:] + move[1])
        for t in range(len(alive) - 1, 0, -1):
            after = s[start[t] : start[t + 1]] + b[start[t] : start[t + 1]]
            b[start[t - 1] : start[t - 1] + alive[t]] = np.logaddexp(after[:, :1] + move[:, 0], after[:, 1:] + move[:, 1])
        z = np.logaddexp(a[ends, 0], a[ends, 1])[chain]
        p = np.exp(np.minimum(a[:, 1] + b[:, 1] - z, 0.0))
        gradient = np.bincount(cols, (y - p)[rows], minlength=len(names)) - decay * len(pages) * w
        pair = np.exp(np.minimum(a[before][:, :, None] + move + (s + b)[here][:, None, :] - z[here, None, None], 0.0))
        gradient_move = counted - pair.sum(0) - decay * len(pages) * move
        seen_w += gradient**2
        seen_move += gradient_move**2
        w += rate * gradient / np.sqrt(seen_w)
        move += rate * gradient_move / np.sqrt(seen_move)
    return Field({f: float(w[k]) for f, k in names.items()}, move.tolist())


def training_pages(n: int = TRAINING_PAGES, seed: int = 11, telling: float = 0.7) -> Iterator[tuple[list[Block], list[bool]]]:
    """Labelled pages; telling: share of names that say what part they are. Text of the main part begins each block with a mark that is taken off again."""
    r = random.Random(seed)
    mark = "⁣"
    stock = ["".join(r.choices("aeiourstnlmdch", k=r.randint(2, 9))) for _ in range(1000)]

    def words(least: int, most: int) -> str:
        return " ".join(r.choices(stock, k=r.randint(least, most))).capitalize() + r.choice((".", ".", ".", "!", "?", ""))

    def name(part: str, tells: float = telling) -> str:
        k = r.choice(("class", "class", "id"))
        if r.random() > tells:
            return r.choice(("", f' {k}="{r.choice(("c", "css-", "el_", "m", "sc-", "row-", "b"))}{r.randint(1, 99)}"', f' {k}="{r.choice(("wrap", "overflow-hidden", "box left", "clearfix", "panel", "cell", "unit"))}"'))
        return f' {k}="{r.choice(("", "site-", "page_", "x-"))}{r.choice(PARTS[part])}{r.choice(("", "-box", " wide", "_1"))}"'

    def nested(x: str, most: int = 3) -> str:
        for _ in range(r.choice((0, 0, r.randint(1, most)))):
            tag = r.choice(("div", "div", "div", "section"))
            x = f"<{tag}{name('main', 0.0)}>{x}</{tag}>"
        return x

    def menu(tells: float = telling) -> str:
        items = "".join(f'<li><a href="#">{words(1, 3)}</a></li>' for _ in range(r.randint(2, 9)))
        bare_items = "".join(r.choice(('<a href="#">%s</a> ', '<a href="#">%s</a> ', '<div><a href="#">%s</a></div>', '<div><a href="#">%s</a></div>', "<div>%s</div>")) % words(1, 3) for _ in range(r.randint(1, 9)))
        return r.choice((f"<nav><ul>{items}</ul></nav>", f"<div{name('menu', tells)}><ul>{items}</ul></div>", f"<ul{name('menu', tells)}>{items}</ul>", f"<div{name('menu', tells)}>{bare_items}</div>"))

    def prose(least: int, most: int, tag: str = "p") -> str:
        return "".join(f"<{tag}>{words(3, r.choice((12, 40, 120)))}" + r.choice((f"</{tag}>", f"</{tag}>", "")) for _ in range(r.randint(least, most)))

    def boiler(tells: float = telling) -> str:
        kind = r.choice(("menu", "header", "footer", "side", "notice", "advert", "form", "comment"))
        if kind == "menu":
            return menu(tells)
        inner = prose(1, 4) if r.random() < 0.5 else words(2, 30) + r.choice(("", f"<h3>{words(1, 4)}</h3>{prose(1, 3)}"))
        tag = {"header": "header", "footer": "footer", "side": "aside", "form": "form"}.get(kind)
        if kind == "footer" and r.random() < 0.5:
            inner = f"&copy; {words(2, 6)} {inner}"
        if kind == "form":
            inner = f"<label>{words(1, 3)}</label><input><p>{words(3, 20)}</p>"
        if kind == "comment":
            inner = "".join(f"<{t}>{words(1, 2)} says: {words(3, 60)}</{t}>" for t in [r.choice(("p", "li", "div"))] for _ in range(r.randint(1, 6)))
        if tag and r.random() < 0.5:
            return f"<{tag}>{inner}</{tag}>"
        tag = r.choice(("div", "div", "section", tag or "div"))
        return f"<{tag}{name(kind, tells)}>{nested(inner)}</{tag}>"

    def aside() -> str:
        """A part of an article that is none of its text, as its names say."""
        kind = r.choice(("side", "notice", "advert", "advert", "form", "comment", "menu", "footer"))
        tag = r.choice(("div", "div", "section", "p"))
        inner = words(2, r.choice((8, 30))) if tag == "p" or r.random() < 0.4 else prose(1, 3)
        return f"<{tag}{name(kind, 1.0)}>{inner}</{tag}>"

    def main() -> str:
        out = [f"<h1>{mark}{words(3, 9)}</h1>"] if r.random() < 0.8 else []
        style = r.choice(("p", "p", "p", "div", "nested", "br"))  # how paragraphs are set
        for _ in range(r.randint(1, 10)):
            kind = r.random()
            text = mark + words(1, r.choice((8, 30, 150)))
            if kind < 0.75 and style != "p":
                text = mark + words(4, r.choice((15, 30, 150)))
                out.append({"div": f"<div>{text}</div>", "nested": f"<div><div>{text}</div></div>", "br": f"{text}{r.choice(('<br>', '<br><br>', '<br/><br/>'))}{mark}{words(3, 40)}"}[style])
            elif kind < 0.75:
                out.append(f"<p>{r.choice(('', '<b>', '<a href=#>x</a> '))}{text}" + r.choice(("</p>", "</p>", "<br>")))
            elif kind < 0.83:
                out.append(f"<h2>{text}</h2>")
            elif kind < 0.87:
                odd = f"{r.choice([w for ws in PARTS.values() for w in ws])}-{r.choice(('effects', 'history', 'table', 'note', 'points', 'study'))}"
                out.append(f'<{r.choice(("div", "section"))} class="{odd}"><p>{text}</p><p>{mark}{words(5, 60)}</p></div></section>')
            elif kind < 0.9:
                out.append("<ul>" + "".join(f"<li>{mark}{words(2, 15)}</li>" for _ in range(r.randint(1, 4))) + "</ul>")
            elif kind < 0.95:
                out.append(f"<blockquote>{text}</blockquote>")
            else:
                out.append(aside())
        if r.random() < 0.3:
            out.insert(r.randint(0, len(out)), aside())
        body = nested("".join(out))
        if r.random() < 0.3:
            body += r.choice((boiler(1.0), ""))
        tag = r.choice(("article", "article", "main", "div", "div", "section"))
        names = name("main") if tag in ("div", "section") or r.random() < 0.3 else ""
        return f"<{tag}{names}>{body}</{tag}>"

    for _ in range(n):
        before, after = ("".join(nested(boiler(), 2) for _ in range(r.randint(0, 4))) for _ in range(2))
        core = nested(main()) if r.random() < 0.95 else ""
        if r.random() < 0.3:
            core = f"<main>{core}{boiler() if r.random() < 0.5 else ''}</main>"
        if r.random() < 0.15:  # laid out by a table
            before, core, after = (f"<td>{x}</td>" for x in (before, core, after))
            before, after = f"<table><tr>{before}", f"{after}</tr></table>"
        blocks = leaf_blocks(f"<html><head><title>{words(2, 6)}</title></head><body>{nested(before + core + after, 2)}</body></html>")
        labels = [mark in b.text for b in blocks]
        for b in blocks:
            b.text = b.text.replace(mark, "") or "."
        yield blocks, labels


_fields: list[Field] = []


def fitted() -> Field:
    """The field, trained once a process on TRAINING_PAGES pages."""
    if not _fields:
        _fields.append(train(list(training_pages())))
    return _fields[0]


NAMED, RENAMED = re.compile(r"""\s(?:class|id|role)\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>]+)""", re.I), re.compile(r"<(/?)(?:article|main)\b", re.I)


def bare(page: str) -> str:
    """The page with article and main as div, without class, id and role."""
    return NAMED.sub("", RENAMED.sub(r"<\1div", page))


def in_article(block: Block) -> bool:
    """Whether the block stands in an article and in no part of it that is none of its text, by tag or by name."""
    tags = [e.split(" ")[0] for e in block.path]
    if "article" not in tags:
        return False
    at = tags.index("article")
    names = {PART_OF.get(w) for e in block.path[at + 1 :] for w in e.split(" ")[1:]}
    return not {"nav", "aside", "footer", "form"} & set(tags[at:]) and not names & NOT_MAIN


NOT_MAIN = frozenset(PARTS) - {"main", "header"}


def labelled_pages(pages: list[str], most: int = LABELLED_BLOCKS) -> Iterator[tuple[list[Block], list[bool]]]:
    """Labelled blocks of pages that have one article, as they are and bare; pages by which there would be more than
    most blocks are left out."""
    used = 0
    for page in pages:
        blocks = leaf_blocks(page)
        if used + 2 * len(blocks) > most:
            continue
        used += 2 * len(blocks)
        labels = [in_article(b) for b in blocks]
        yield blocks, labels
        plain = leaf_blocks(bare(page))
        if [b.text for b in plain] == [b.text for b in blocks]:
            yield plain, labels


def fitted_to(pages: DataFrame, html_col: str = "html") -> Field:
    """The field, trained on TRAINING_PAGES laid out and on at most LABELLED_PAGES of the given pages."""
    h = F.col(html_col)
    one = (F.regexp_count(h, F.lit("(?i)<article\\b")) == 1) & (F.length(h) <= LABELLED_CHARS)
    marked = pages.where(one).select(h.alias("html"), F.xxhash64(h).alias("hash"))
    # hashes alone are sorted, and equal pages count once, so LABELLED_PAGES pages reach the driver at most
    last = marked.select("hash").distinct().orderBy("hash").limit(LABELLED_PAGES).agg(F.max("hash")).first()[0]
    rows = marked.where(F.col("hash") <= F.lit(last)).dropDuplicates(["hash"]).orderBy("hash").collect() if last is not None else []
    return train([*training_pages(), *labelled_pages([r.html for r in rows])]) if rows else fitted()


def extract(pages: DataFrame, model: Field | None = None, html_col: str = "html") -> DataFrame:
    """All columns of pages (one called text is replaced) and text, by a model or the one that fits the given pages.
    No shuffle; the model travels with the task."""
    model = model or fitted_to(pages, html_col)
    weights, move = model.weights, model.move
    if "text" in pages.columns:
        pages = pages.drop("text")
    names = pages.columns
    spot = names.index(html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Field(weights, move)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [own.main_text(h) if h else "" for h in part.column(spot).to_pylist()]
                keep = [k for k in range(len(names)) if k != spot]
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keep), pa.array(texts, pa.string())], names=[*(names[k] for k in keep), "text"])

    schema = pages.drop(html_col).withColumn("text", F.lit("")).schema
    return spread(pages).mapInArrow(run, schema)


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
