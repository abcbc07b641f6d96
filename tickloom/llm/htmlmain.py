"""Main text of web pages by sum-product on the element tree (operator 3).

Every block element of a page has one of three labels: *wrapper* (it holds content and other things), *content*, or
*other* (menus, adverts, comments, forms and so on).  Node potentials come from the element's name, its class, id and
role, and its own text; potentials between parent and child say, for instance, that what lies in a menu is not content.
As the elements form a tree, one pass of messages from the leaves up and one from the root down give the exact marginal
of every label.  Text runs of elements whose content marginal is ``LEAST`` or more are the main text.

The potentials are trained by likelihood on labelled pages.  No table holds labelled pages, so they are composed here
from many kinds of page parts, with and without speaking names, the label being known for each part.
"""

from __future__ import annotations

import math
import random
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import small
from tickloom.llm.dom import Page, attributes, read

LEAST = 0.5
WRAPPER, CONTENT, OTHER = 0, 1, 2

_GROUPS = {
    "container": "div section center span font", "root": "#page html body", "head": "head title noscript", "article": "article", "main": "main", "nav": "nav menu", "header": "header hgroup", "footer": "footer address",
    "aside": "aside dialog", "form": "form button select option textarea label fieldset legend input optgroup datalist output", "p": "p", "h1": "h1", "heading": "h2 h3 h4 h5 h6", "item": "li dt dd", "list": "ul ol dl",
    "cell": "td th", "table": "table thead tbody tfoot tr caption colgroup", "quote": "blockquote pre figure figcaption", "details": "details summary",
}
_GROUP = {t: g for g, ts in _GROUPS.items() for t in ts.split()}
#: What names of classes, ids and roles hint at.
_HINTS = {
    "main": r"article|content|main|post|entry|story|text|prose|copy|page-?body",
    "menu": r"nav|menu|breadcrumb|crumbs|pagination|pager|tabs|toolbar|toc|skip",
    "frame": r"header|masthead|footer|banner|contentinfo|topbar|bottom|logo|copyright|colophon|legal|site-",
    "side": r"side|aside|widget|related|recommend|complementary|more-|popular|trending|teaser|tags|author-box|meta",
    "advert": r"\bads?\b|\bad[-_]|[-_]ads?\b|advert|sponsor|promo|commercial|banner|dfp|taboola|outbrain|affiliate",
    "notice": r"cookie|consent|gdpr|notice|alert|popup|modal|overlay|paywall|subscribe|newsletter|signup|sign-up|warning|toast",
    "comment": r"comment|disqus|repl(?:y|ies)|discussion|respond|review|feedback|thread",
    "social": r"share|social|follow|like|tweet|facebook",
    "form": r"form|search|login|register|input|field|button|btn",
}
_HINT = {k: re.compile(v) for k, v in _HINTS.items()}
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


@lru_cache(maxsize=20_000)
def _named(tag: str, source: str) -> tuple[str, ...]:
    """Features of an element's name and attributes."""
    out = ["tag:" + _GROUP.get(tag, "unknown")]
    if source.strip():
        a = attributes(source)
        name = " ".join(a.get(k, "") for k in ("class", "id", "role", "itemprop")).lower()
        if name.strip():
            hints = [k for k, p in _HINT.items() if p.search(name)]
            bad = [k for k in hints if k != "main"]
            out += ["hint:" + k for k in bad]
            if "main" in hints:
                out.append("hint:main-and-more" if bad else "hint:main")
        if "hidden" in a or a.get("aria-hidden") == "true" or _HIDDEN.search(a.get("style", "")):
            out.append("hidden")
    return tuple(out)


def features(page: Page) -> list[tuple[str, ...]]:
    """Active features of every element."""
    n = len(page.tags)
    chars, linked, ends = [0] * n, [0] * n, [0] * n
    for node, text, in_links in page.runs:
        chars[node] += len(text)
        linked[node] += in_links
        ends[node] += text.count(". ") + text.count(", ") + (text[-1] in ".!?…")
    below = chars[:]
    for i in range(n - 1, 0, -1):
        below[page.parents[i]] += below[i]
    out = []
    for i in range(n):
        own = chars[i]
        own_size = "none" if not own else "tiny" if own < 25 else "short" if own < 80 else "long" if own < 300 else "huge"
        more = (
            "own:" + own_size,
            "links:" + ("none" if not own or not linked[i] else "few" if linked[i] < 0.4 * own else "most"),
            "ends:" + ("none" if not ends[i] else "one" if ends[i] < 2 else "many"),
            "below:" + ("none" if not below[i] else "short" if below[i] < 120 else "long" if below[i] < 800 else "huge"),
        )
        out.append(_named(page.tags[i], page.attrs[i]) + more + ("named:" + _GROUP.get(page.tags[i], "unknown") + ":" + own_size,))
    return out


class TreeModel:
    """Log potentials: ``node[feature][label]`` and ``edge[parent label][label]``."""

    def __init__(self):
        self.node: dict[str, list[float]] = {}
        self.edge = [[0.0] * 3 for _ in range(3)]
        self.seen: dict[tuple[str, ...], tuple[float, float, float]] = {}

    def potential(self, active: tuple[str, ...]) -> tuple[float, float, float]:
        got = self.seen.get(active)
        if got is None:
            z = [0.0, 0.0, 0.0]
            for f in active:
                w = self.node.get(f)
                if w:
                    z = [a + b for a, b in zip(z, w, strict=True)]
            top = max(z)
            if len(self.seen) > 50_000:
                self.seen.clear()
            got = self.seen[active] = tuple(math.exp(max(a - top, -60.0)) for a in z)
        return got

    def marginals(self, parents: list[int], phi: list[tuple[float, float, float]]) -> tuple[list, list, list]:
        """Marginals of every node, with the messages to and from its parent."""
        (a, b, c), (d, e, f), (g, h, i) = ([math.exp(x) for x in row] for row in self.edge)
        n = len(parents)
        up = [list(p) for p in phi]
        to_parent = [None] * n
        for k in range(n - 1, 0, -1):
            x, y, z = up[k]
            s = x + y + z
            x, y, z = x / s, y / s, z / s
            up[k] = (x, y, z)
            m = (a * x + b * y + c * z, d * x + e * y + f * z, g * x + h * y + i * z)
            to_parent[k] = m
            p = up[parents[k]]
            x, y, z = p[0] * m[0], p[1] * m[1], p[2] * m[2]
            s = x + y + z
            if s < 1e-200:
                x, y, z, s = x * 1e200, y * 1e200, z * 1e200, s * 1e200
            p[0], p[1], p[2] = x / s, y / s, z / s
        from_parent = [None] * n
        belief = [None] * n
        s = sum(up[0])
        belief[0] = tuple(x / s for x in up[0])
        for k in range(1, n):
            p, m = belief[parents[k]], to_parent[k]
            x, y, z = p[0] / m[0], p[1] / m[1], p[2] / m[2]
            s = x + y + z
            x, y, z = x / s, y / s, z / s
            from_parent[k] = (x, y, z)
            q = up[k]
            x, y, z = q[0] * (a * x + d * y + g * z), q[1] * (b * x + e * y + h * z), q[2] * (c * x + f * y + i * z)
            s = x + y + z
            belief[k] = (x / s, y / s, z / s)
        return belief, up, from_parent

    def content(self, page: Page) -> list[float]:
        """Content marginal of every element."""
        belief, _, _ = self.marginals(page.parents, [self.potential(f) for f in features(page)])
        return [b[CONTENT] for b in belief]


def fit(pages: list[tuple[Page, list[int]]], epochs: int = 25, rate: float = 0.15) -> TreeModel:
    """Maximum likelihood by stochastic gradient steps; expectations are exact marginals."""
    model = TreeModel()
    data = [(p.parents, features(p), labels) for p, labels in pages]
    for epoch in range(epochs):
        step = rate / (1 + 0.1 * epoch)
        for parents, active, labels in data:
            model.seen.clear()
            phi = [model.potential(f) for f in active]
            belief, up, down = model.marginals(parents, phi)
            e = [[math.exp(x) for x in row] for row in model.edge]
            grad_edge = [[0.0] * 3 for _ in range(3)]
            for k in range(len(parents)):
                for f in active[k]:
                    w = model.node.setdefault(f, [0.0, 0.0, 0.0])
                    for s in range(3):
                        w[s] += step * ((labels[k] == s) - belief[k][s]) - step * 1e-3 * w[s]
                if k:
                    pair = [[down[k][s] * e[s][t] * up[k][t] for t in range(3)] for s in range(3)]
                    total = sum(map(sum, pair))
                    for s in range(3):
                        for t in range(3):
                            grad_edge[s][t] += (labels[parents[k]] == s and labels[k] == t) - pair[s][t] / total
            for s in range(3):
                for t in range(3):
                    model.edge[s][t] = max(-8.0, min(8.0, model.edge[s][t] + 0.3 * step * grad_edge[s][t]))
    model.seen.clear()
    return model


#: Share of pages that are composed without named parts.
BARE = 0.2


class Composer:
    """Composes labelled pages: every part is written with a ``data-y`` attribute that names its label."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def words(self, a: int, b: int) -> str:
        r = self.r
        return " ".join("".join(r.choice(("an", "be", "chi", "do", "el", "fro", "ga", "hu", "in", "jo", "ka", "lem", "no", "or", "pi", "ra", "se", "tu", "ve", "wi")) for _ in range(r.randint(1, 3))) for _ in range(r.randint(a, b)))

    def prose(self, a: int, b: int) -> str:
        out = []
        for _ in range(self.r.randint(a, b)):
            s = self.words(4, 18)
            if self.r.random() < 0.4:
                s = f"{self.words(2, 5)}, {s}"
            out.append(s.capitalize() + self.r.choice("....!?"))
        return " ".join(out)

    def links(self, n: int, wrap: str = "li") -> str:
        return "".join(f"<{wrap}><a href='/{i}'>{self.words(1, 3)}</a></{wrap}>" for i in range(n))

    def part(self, tag: str, names: str, y: str, inner: str, bare: float = 0.0) -> str:
        r = self.r
        kind = r.choice(("class", "class", "id"))
        name = f" {kind}='{r.choice(names.split())}'"
        if r.random() < bare:
            name = ""
        semantic = tag not in ("div", "section")
        if semantic and r.random() < 0.45:
            tag, semantic = r.choice(("div", "div", "section")), False
            name = name or f" {kind}='{r.choice(names.split())}'"
        elif semantic and r.random() < 0.6:
            name = ""
        return f"<{tag} data-y='{y}'{name}>{inner}</{tag}>"

    def content(self) -> str:
        r, out = self.r, []
        if r.random() < 0.8:
            out.append(f"<h1>{self.words(2, 10)}</h1>")
        for _ in range(r.randint(1, 8)):
            k = r.random()
            if k < 0.62:
                text = self.prose(1, 6)
                if r.random() < 0.25:
                    text += f" <a href='/x'>{self.words(1, 4)}</a> " + self.prose(1, 2)
                out.append(f"<p>{text}</p>" if r.random() < 0.85 else f"<p>{text}")
            elif k < 0.72:
                out.append(f"<h{r.choice('23')}>{self.words(1, 6)}</h2>")
            elif k < 0.8:
                out.append("<ul>" + "".join(f"<li>{self.prose(1, 2) if r.random() < 0.6 else self.words(2, 8)}</li>" for _ in range(r.randint(2, 5))) + "</ul>")
            elif k < 0.85:
                out.append("<table>" + "".join("<tr>" + "".join(f"<td>{self.words(1, 4)}</td>" for _ in range(3)) + "</tr>" for _ in range(r.randint(2, 4))) + "</table>")
            elif k < 0.9:
                out.append(f"<blockquote><p>{self.prose(1, 2)}</p></blockquote>")
            elif k < 0.94:
                out.append(f"<div>{self.prose(1, 3)}</div>")
            elif k < 0.97:
                out.append(f"<p>{self.words(1, 6)}</p>")
            else:
                out.append(self.part("aside", "ad advert sponsored share-buttons related promo newsletter", "o", self.noise()))
        return "".join(out)

    def noise(self) -> str:
        r = self.r
        k = r.random()
        if k < 0.35:
            return self.prose(1, 3)
        if k < 0.6:
            return f"<p>{self.prose(1, 2)}</p>"
        if k < 0.8:
            return f"<ul>{self.links(r.randint(1, 5))}</ul>"
        return f"<a href='/y'>{self.words(2, 6)}</a>"

    def comments(self) -> str:
        one = self.r.choice(("<li><b>{n}</b> <p>{t}</p></li>", "<div class='comment'><span>{n}</span><p>{t}</p></div>", "<p>{n}: {t}</p>", "<article class='comment'><header>{n}</header><p>{t}</p></article>"))
        return f"<h3>{self.words(1, 2)}</h3>" + "".join(one.format(n=self.words(1, 2), t=self.prose(1, 4)) for _ in range(self.r.randint(1, 5)))

    def form(self) -> str:
        return f"<label>{self.words(1, 3)}</label><input name='a'><select><option>{self.words(1, 2)}<option>{self.words(1, 2)}</select><button>{self.words(1, 2)}</button>" + (f"<p>{self.prose(1, 1)}</p>" if self.r.random() < 0.4 else "")

    def bare_page(self) -> str:
        """A page without named parts: an article, often short, in none or many plain ``div``s; perhaps a menu and a footer."""
        r = self.r
        inner = re.sub(r"<(h1|h2|h3|p|ul|table|blockquote|div)>", r"<\1 data-y='c'>", self.content() if r.random() < 0.5 else "".join(f"<p>{self.prose(1, 6)}</p>" for _ in range(r.randint(1, 4))))
        for _ in range(r.choice((0, 0, 1, 1, 2, 3, 4, 5, 6, 8, 10))):
            inner = f"<div data-y='w'>{inner}</div>"
        menu = f"<ul data-y='o'>{self.links(r.randint(2, 8))}</ul>" if r.random() < 0.6 else f"<nav data-y='o'><ul>{self.links(r.randint(2, 8))}</ul></nav>"
        foot = f"<footer data-y='o'>{r.choice((self.words(2, 8), f'<p>{self.prose(1, 2)}</p>', f'<p>{self.words(3, 8)}.</p>'))}</footer>"
        inner = (menu if r.random() < 0.45 else "") + inner + (foot if r.random() < 0.45 else "")
        return f"<html data-y='w'><head data-y='o'><title>{self.words(2, 8)}</title></head><body data-y='w'>{inner}</body></html>"

    def page(self) -> str:
        r = self.r
        if r.random() < BARE:
            return self.bare_page()
        p = lambda x: r.random() < x
        before, after = [], []
        if p(0.4):
            before.append(self.part("header", "header masthead site-header topbar banner", "o", f"<div>{self.words(1, 3)}</div>" + (f"<p>{self.words(3, 9)}</p>" if p(0.5) else "") + (f"<h1>{self.words(1, 3)}</h1>" if p(0.2) else "")))
        if p(0.8):
            before.append(self.part("nav", "nav navbar main-menu menu navigation", "o", f"<ul>{self.links(r.randint(2, 8))}</ul>" if p(0.8) else self.links(4, "span")))
        if p(0.3):
            before.append(self.part("div", "cookie-banner consent cookie notice alert gdpr-popup", "o", self.prose(1, 3) + ("<button>ok</button>" if p(0.6) else "")))
        if p(0.45):
            before.append(self.part("div", "ad ads advert ad-slot sponsor promo advertisement", "o", self.prose(1, 4) if p(0.7) else self.noise()))
        if p(0.2):
            before.append(self.part("div", "breadcrumb breadcrumbs crumbs", "o", self.links(3, "span")))
        if p(0.2):
            before.append(f"<form data-y='o'>{self.form()}</form>")
        if p(0.35):
            (before if p(0.4) else after).append(self.part("aside", "sidebar side widget related-posts recommended", "o", f"<h3>{self.words(1, 3)}</h3>" + "".join(self.noise() for _ in range(r.randint(1, 3)))))
        if p(0.35):
            after.append(self.part("section", "comments comment-list discussion disqus responses reviews", "o", self.comments()))
        if p(0.2):
            after.append(self.part("div", "newsletter subscribe signup login", "o", f"<form>{self.form()}</form>"))
        if p(0.2):
            after.append(self.part("div", "ad ads advert sponsor promo", "o", self.noise()))
        if p(0.2):
            after.append(self.part("div", "share social related more-stories", "o", self.links(3, r.choice(("li", "span", "p")))))
        if p(0.8):
            after.append(self.part("footer", "footer site-footer colophon copyright legal", "o", r.choice((self.words(2, 8), f"<p>{self.prose(1, 2)}</p>", f"<ul>{self.links(4)}</ul><p>{self.words(3, 6)}</p>", self.prose(1, 1)))))
        body = self.part(r.choice(("article", "article", "main", "div")), "article content post entry story main-content article-body text", "c", self.content(), 0.3)
        k = r.random()
        if k < 0.25:
            body = f"<main data-y='w'>{body}{after.pop(0) if after and p(0.4) else ''}</main>"
        elif k < 0.45:
            body = f"<div data-y='w' class='{r.choice(('wrapper', 'container', 'page', 'row', 'layout', 'content'))}'>{before.pop() if before and p(0.4) else ''}{body}{after.pop(0) if after and p(0.5) else ''}</div>"
        elif k < 0.5:
            body = re.sub(r"^<(\w+) [^>]*>(.*)</\1>$", r"\2", body, flags=re.S)
            body = re.sub(r"<(h1|h2|h3|p|ul|table|blockquote|div)>", r"<\1 data-y='c'>", body)
        inner = "".join(before) + body + "".join(after)
        head = f"<head data-y='o'><title>{self.words(2, 8)}</title></head>"
        return f"<html data-y='w'>{head}<body data-y='w'>{inner}</body></html>"


def labels_of(page: Page) -> list[int]:
    """Labels of a composed page; parts without ``data-y`` have that of their parent."""
    out = [WRAPPER]
    for k in range(1, len(page.tags)):
        y = attributes(page.attrs[k]).get("data-y")
        out.append({"w": WRAPPER, "c": CONTENT, "o": OTHER}[y] if y else out[page.parents[k]])
    return out


@lru_cache(maxsize=1)
def trained(pages: int = 300, seed: int = 11) -> TreeModel:
    """The model, trained on composed pages (a few seconds, once for each driver)."""
    c = Composer(seed)
    read_pages = [read(c.page()) for _ in range(pages)]
    return fit([(p, labels_of(p)) for p in read_pages])


def main_text(source: str | None, model: TreeModel, least: float = LEAST) -> str:
    """The main text of one page: runs of content elements in page order, joined by one space."""
    page = read(source)
    if not page.runs:
        return ""
    content = model.content(page)
    return " ".join(text for node, text, _ in page.runs if content[node] >= least)


def extract(pages: DataFrame, model: TreeModel | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row; a narrow map over whole pages.

    Null and empty pages give an empty text; repeated rows stay; other columns are not read; an empty table gives no
    rows.
    """
    model = model or trained()

    def run(batches):
        for b in small(batches):
            texts = [main_text(t, model) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
