"""Main text of web pages by tag-path ratios.

A page is read into its text blocks, each with its root-to-leaf path of tags. Per path, the text length and the
punctuation are summed and divided by the number of blocks (text ratio and punctuation ratio); the
ratios of the blocks in page order are smoothed with a Gaussian and both are fused into one score. Paths whose mean
score reaches the threshold are content.

Blocks of content paths that are long and punctuated beside the others are the nodes that the text is built on. Kept are these and

* what lies between the first and the last of them, but blocks that are all links or of long text on another path;
* an article or main element that holds most of their text, whole, and nothing else then;
* the nearest heading before the first, with the text after it, and a heading after the last with the text of its section;
* blocks of content paths beside them in one element (in the body: with punctuation), and all of their common
  element where that is not the body and has no block of links; so too a single text beside that element.

Everything else goes, so a menu, a line of rights or a teaser needs no known name. Elements that are never content (menus, headers,
footers, sidebars, forms, scripts, styles) are not read, and names of furniture weigh: what such an element holds counts only
if it is most of the page's punctuated text.

Results for special inputs: null or empty html, and pages without a content block, give an empty text; unclosed and
misnested tags are closed as their parents end; an unfinished tag at the end is dropped; repeated rows give equal
results; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

THRESHOLD, SHARE = 0.5, 0.7 # of the standard deviation of the paths' scores, and of the largest
SIGMA, RADIUS = 1.0, 2      # Gaussian over neighbouring blocks
NEAR = 0.5                  # of the longest block's log length: what the text is built on

# Fixed names of the markup language and words that name page furniture.
SKIP = frozenset("script style noscript template head title svg math iframe object select textarea button option canvas video audio".split())
FURNITURE = frozenset("nav header footer aside form menu dialog fieldset label input".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q ruby rt rp s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
CLOSED_BY_SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
STOPS = frozenset("ul ol dl table article section div body html td th main".split())
NAMED = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar side menu nav navbar navigation breadcrumb breadcrumbs "
                  "header footer masthead comment comments reply replies respond cookie cookies consent notice notices alert popup modal newsletter subscribe share sharing social "
                  "related recommended widget login signup search pagination pager toolbar skip copyright".split())
# Words that may stand beside a furniture word in one class, and words that turn its meaning.
PARTS = frozenset("left right top bottom upper lower main site page global primary secondary mobile desktop box block bar list lists item items link links wrap wrapper container holder "
                  "slot slots unit area section row column inner outer panel group title text body post posts article articles story entry news blog user author "
                  "button buttons icons media form google wp div el id".split())
TURNED = frozenset("has have no not non with without is enable enabled disable disabled".split())
# Furniture words that name it as a class's last word whatever stands before.
LAST = NAMED - frozenset("side skip copyright promotion sponsor sponsored social share sharing search related recommended notice notices alert reply replies respond subscribe login signup".split())
TALK = frozenset("comment comments reply replies respond".split())      # text of readers, often more than the page's own
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*?)>""", re.S)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
UNFINISHED = re.compile(r"""<[/!?a-zA-Z](?:[^>"']|"[^"]*"|'[^']*'|["'])*\Z""", re.S)
PUNCTUATION = re.compile(r"[.,;:!?。，；：！？、]")
WORD = re.compile(r"[A-Za-z]+")
HEADING = re.compile(r"(?:^|/)h[1-6](?:/|$)")


def _named(token: str) -> set:
    """Furniture words of one class or id that make it the name of furniture."""
    words = [w for w in WORD.findall(token) if len(w) > 1]
    found = NAMED.intersection(words)
    if not found or TURNED.intersection(words):
        return set()
    return found if words[-1] in LAST or all(w in NAMED or w in PARTS for w in words) else set()


def _excluded(name: str, attributes: str) -> tuple[bool, set]:
    """Whether an element is excluded by its kind, and the furniture words that it is named by."""
    named: set = set()
    if name in SKIP or name in FURNITURE:
        return True, named
    if not attributes:
        return False, named
    for key, value in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'").lower()
        if key in ("class", "id"):
            if name not in ("body", "html", "article", "main") and not (key == "id" and HEADING.search(name)):
                named = named.union(*map(_named, value.split()))
        elif key == "role":
            if value in ROLES:
                return True, named
        elif key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and re.search(r"display\s*:\s*none", value)):
            return True, named
    return False, named


def blocks(page: str):
    """(element numbers from the root, tag path, text, whether some is not link text, named elements) of each text block.

    Blocks inside elements excluded by their kind are left out; (element number, words) of those named as furniture are given.
    """
    out, text, plain = [], [], False
    stack = [("", 0, False, ())]                   # (tag, element number, excluded, named elements)
    number, at = 0, 0

    def flush():
        nonlocal plain
        if text:
            joined = " ".join(entities.unescape("".join(text)).split())
            text.clear()
            if joined:
                held = [s for s in stack if s[0] not in INLINE]
                out.append((tuple(s[1] for s in held), "/".join(s[0] for s in held[1:]), joined, plain, held[-1][3]))
        plain = False

    def close(to):
        nonlocal stack
        if any(s[0] not in INLINE for s in stack[to:]):
            flush()
        del stack[to:]

    def say(piece):
        nonlocal plain
        if piece and not stack[-1][2]:
            text.append(piece)
            plain = plain or (all(s[0] != "a" for s in stack) and any(map(str.isalnum, piece)))

    for m in TAG.finditer(page):
        if m.start() < at:
            continue
        say(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == name:
                    close(k)
                    break
            else:
                if name not in INLINE:
                    flush()
            continue
        if name in ("br", "hr"):
            flush()
            continue
        if name in VOID:
            continue
        if name in CLOSES_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == "p":
                    close(k)
                    break
                if stack[k][0] in STOPS:
                    break
        if name in CLOSED_BY_SAME:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in CLOSED_BY_SAME[name]:
                    close(k)
                    break
                if stack[k][0] in STOPS:
                    break
        if name not in INLINE:
            flush()
        number += 1
        if name in ("script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math"):
            end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        excluded, named = _excluded(name, m[3])
        if named and name in INLINE:
            excluded, named = True, set()
        stack.append((name, number, stack[-1][2] or excluded, (*stack[-1][3], (number, named)) if named else stack[-1][3]))
    tail = page[at:]
    say(UNFINISHED.sub("", tail) if "<" in tail else tail)
    flush()
    return out


def _smooth(x):
    if len(x) < 2:
        return x
    k = np.exp(-0.5 * (np.arange(-RADIUS, RADIUS + 1) / SIGMA) ** 2)
    weights = np.convolve(np.ones(len(x)), k, mode="full")[RADIUS:RADIUS + len(x)]
    return np.convolve(x, k, mode="full")[RADIUS:RADIUS + len(x)] / weights


def _kept(found, chosen, marks):
    """Numbers of the blocks of the main text, given those whose path is content."""
    n = len(found)
    chains, plain = [f[0] for f in found], [f[3] for f in found]
    tags = [("", *f[1].split("/")) if f[1] else ("",) for f in found]
    heading = [bool(HEADING.search(f[1])) for f in found]
    size = np.log1p([len(f[2]) for f in found])
    some = [i for i in range(n) if chosen[i] and plain[i]] or [i for i in range(n) if chosen[i]]
    tall, marked = NEAR * max(size[i] for i in some), any(marks[i] for i in some)
    strong = [i for i in some if size[i] >= tall and (marks[i] or not marked)] or some
    # An article or main element that holds most of their text is the page's; else they stand for themselves.
    mass: dict = {}
    for i in strong:
        top = next((k for k in range(1, len(tags[i])) if tags[i][k] in ("article", "main")), None)
        if top:
            mass[chains[i][:top + 1]] = mass.get(chains[i][:top + 1], 0) + len(found[i][2])
    whole = [e for e in mass if 2 * sum(mass.values()) > sum(len(found[i][2]) for i in strong)]
    if whole:
        inside = [any(c[:len(e)] == e for e in whole) for c in chains]
        return [i for i in range(n) if inside[i]]
    first, last = strong[0], strong[-1]
    wide = float(np.median([size[i] for i in strong]))
    keep = {i for i in range(first, last + 1) if chosen[i] or heading[i] or (plain[i] and size[i] <= wide)}
    beside = {chains[i][:-1] for i in strong if len(chains[i]) > 1}
    for i in [*range(first), *range(last + 1, n)]:
        own = tags[i][len(chains[i]) - 2] not in ("", "html", "body") if len(chains[i]) > 1 else False
        if chosen[i] and plain[i] and chains[i][:-1] in beside and (own or marks[i]):
            keep.add(i)
    # Back to the nearest heading, over text that is no link, and headings right before it.
    start = min(keep)
    k = start - 1
    while k >= 0 and plain[k] and not heading[k]:
        k -= 1
    if k >= 0 and heading[k]:
        while k > 0 and heading[k - 1]:
            k -= 1
        keep.update(range(k, start))
    # A heading after the text keeps the text after it in its element.
    section = None
    for i in range(max(keep) + 1, n):
        if heading[i]:
            section = chains[i][:-1]
        if section is None or not plain[i] or chains[i][:len(section)] != section:
            break
        keep.add(i)
    # The text's own element and the one around it, where they are no frame of the whole page.
    low, high = min(chains[i] for i in strong), max(chains[i] for i in strong)
    depth = next((k for k, (a, b) in enumerate(zip(low, high)) if a != b), min(len(low), len(high)))
    for up in (low[:depth], low[:depth - 1]):
        if len(up) > 1 and tags[strong[0]][len(up) - 1] not in ("html", "body"):
            around = [i for i in range(n) if chains[i][:len(up)] == up]
            more = [i for i in around if not (low[:depth] == chains[i][:depth] or i in keep)]
            if all(plain[i] for i in around) and (len(up) == depth or len(more) < 2):
                keep.update(around)
    return sorted(keep)


def _unnamed(found):
    """The blocks outside of elements named as furniture, unless they hold most of the page's punctuated text.

    What such an element holds must look like a page's own text: two punctuated blocks, or a first heading, article or main
    element; only a first heading or main element overrules a name of readers' comments.
    """
    if not any(f[4] for f in found):
        return found
    total, elements = 0, {}
    for f in found:
        marks = len(PUNCTUATION.findall(f[2]))
        total += marks
        for number, named in f[4]:
            e = elements.setdefault(number, [named, 0, 0, set()])
            e[1] += marks
            e[2] += marks > 0
            e[3].update(f[1].split("/"))
    kept = set()
    for number, (named, marks, punctuated, tags) in elements.items():
        own = not tags.isdisjoint(("h1", "main")) or (not named & TALK and ("article" in tags or punctuated > 1))
        if own and 2 * marks > total:
            kept.add(number)
    return [f for f in found if all(n in kept for n, _ in f[4])]


def _scores(size, marks, which):
    """Score of each path, from text lengths, punctuation and path numbers of the blocks in page order."""
    nodes = np.bincount(which)
    by_text, by_mark = np.bincount(which, size) / nodes, np.bincount(which, marks) / nodes
    # Smoothed ratios of the blocks, fused: both count relative to their largest.
    a, b = _smooth(np.log1p(by_text)[which]), _smooth(np.log1p(by_mark)[which])
    score = a / max(a.max(), 1e-9) * (0.5 + 0.5 * b / max(b.max(), 1e-9))
    return np.bincount(which, score * size) / np.maximum(np.bincount(which, size), 1)


def content(page: str | None) -> str:
    found = _unnamed(blocks(page)) if page else []
    if not found:
        return ""
    _, which = np.unique([f[1] for f in found], return_inverse=True)
    size = np.array([len(f[2]) for f in found], float)
    marks = np.array([len(PUNCTUATION.findall(f[2])) for f in found], float)
    of_path = _scores(size, marks, which)
    chosen = of_path >= max(THRESHOLD * of_path.std(), of_path.max() * SHARE)
    return " ".join(found[i][2] for i in _kept(found, chosen[which], marks))


def extract(df: DataFrame, keep: list[str], page: str = "html") -> DataFrame:
    """(kept columns, text, n_chars) of every row."""
    source = df.select(*keep, page)
    kinds = ", ".join(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches):
        for batch in batches:
            texts = [content(v) for v in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*keep, "text", "n_chars"])

    return source.mapInArrow(run, f"{kinds}, text string, n_chars long")
