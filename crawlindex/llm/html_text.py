"""Main text of web pages by the maximum-scoring subsequence.

A page is a sequence of words and tags. Words score positive and tags negative,
words in links or outside the article negative too, with weights from labelled
pages: those that mark their own article. One linear scan finds the contiguous
region with the largest sum; its words, without those in boilerplate elements,
are the text.

Where a page marks its article, by an element or a name, the mark that holds the
page's main words is taken: of its words all score positive, and its tags
nothing, so nothing in it is lost. Marks that hold a smaller part, as teasers
and comments have them, are outside.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shipping import ship

LABELLED_PAGES = 2_000  # pages the weights are fitted on, at most
PRIOR = 50.0  # assumed in advance of each feature, at the prior weight

# HTML element names by their role, and words of class and id
# names by which pages mark what is not their article.
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_RAW = ("script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "xmp")
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt"
    " fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li"
    " main menu nav ol optgroup option p pre search section select summary table tbody tfoot"
    " thead tr ul".split()
)
_SPACES = frozenset("br td th wbr img".split())
_SKIPPED = frozenset(
    "nav footer aside button select option dialog menu search head object canvas audio"
    " video fieldset label datalist".split()
)
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark meter output"
    " picture progress q rp rt ruby s samp slot small span strike strong sub sup time tt u var"
    " html".split()
)
_NAMES = _VOID | _BLOCKS | _SPACES | _SKIPPED | _INLINE | frozenset(_RAW)  # with a weight each
_CLOSED_BY_BLOCK = frozenset(["p"])
_BOILERPLATE = frozenset(
    "ad ads adv advert advertisement advertising adsense banner billboard breadcrumb breadcrumbs"
    " byline comment comments consent cookie cookies copyright cta discussion disqus footer form"
    " gdpr login masthead menu menubar modal nav navbar navigation newsletter notice notices"
    " overlay pager pagination paywall popup privacy promo promotion promoted recommended"
    " recommendations related replies reply respond responses share sharing sidebar signup"
    " skip social sponsor sponsored subscribe subscription tags teaser toolbar toc tracking"
    " widget widgets".split()
)
_CONTENT = frozenset("article content entry main post story text".split())
# Words that say nothing of their own beside one of the boilerplate words.
_HOLDERS = frozenset(
    "area areas article articles bar blocks block blog body bottom box button buttons column"
    " container content entry global group header icons inner item items label layout left"
    " leaderboard link links list main module outer page panel post posts reader right row"
    " section site slot square stories story text thread title top unit user wrap wrapper".split()
)
_QUALIFIED = frozenset("has with no without is".split())
_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation"
    " search toolbar".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(
    r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?"
)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I) for name in _RAW}
_NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

# Weights where no page is labelled, and how far labelled pages may move them.
_PRIORS = {"word": 1.0, "link word": -0.5, "outside word": -1.0}
_TAG_PRIOR = -0.15
_RANGES = {"word": (0.5, 1.0), "link word": (-1.0, -0.1), "outside word": (-2.0, -0.5)}
_TAG_RANGE = (-0.3, -0.02)
_FREE = frozenset(["inner tag", "skipped tag"])  # these score nothing
_GAP = -3.0  # of tags between two words together, at most; empty tags tell little
_MOST = 0.5  # share of a group's words that makes a mark the article's

# How an element may be skipped: always, unless it holds the page's main words,
# or only if it consists of links.
_ALWAYS, _USUALLY, _IF_LINKS = 3, 2, 1


def _named(names: str) -> tuple[int, bool]:
    """How class or id names mark boilerplate, and whether they mark content.

    A name of boilerplate words and holders counts in full, as in "ad-slot"; one
    that starts or ends with such a word, as "share-price-report", in part.
    """
    kind, content = 0, False
    for name in names.split():
        parts = [p.lower() for p in _NAME_WORDS.findall(name)]
        if not parts or parts[0] in _QUALIFIED:
            continue
        if not _BOILERPLATE.isdisjoint(parts):
            known = all(p in _BOILERPLATE or p in _HOLDERS or len(p) == 1 for p in parts)
            if known:
                kind = _USUALLY
            elif parts[0] in _BOILERPLATE or parts[-1] in _BOILERPLATE:
                kind = max(kind, _IF_LINKS)
        elif all(p in _CONTENT for p in parts):
            content = True
    return kind, content


def _kind(name: str, attrs: str, in_article: bool) -> tuple[int, bool]:
    """How an element may be skipped, and whether its names mark content."""
    if name == "form" or name == "header" and not in_article:
        return _USUALLY, False
    if name in _SKIPPED:
        return _ALWAYS, False
    if name in ("html", "body") or not attrs or attrs.isspace():
        return 0, False
    values: dict[str, str] = {}
    for key, a, b, c in _ATTRIBUTE.findall(attrs):
        values.setdefault(key.lower(), html.unescape(a or b or c))
    if "hidden" in values or values.get("aria-hidden") == "true":
        return _ALWAYS, False
    if re.search(r"display\s*:\s*none", values.get("style", ""), re.I):
        return _ALWAYS, False
    role = values.get("role", "").lower()
    if role in _ROLES:
        return _USUALLY, False
    found = [_named(values.get(key, "")) for key in ("class", "id")]
    content = role == "main" or any(c for _, c in found)
    kind = 0 if content else max(k for k, _ in found)
    return kind, content


@dataclass
class _Element:
    name: str
    parent: int
    kind: int
    content: bool
    words: int = 0  # of it and all in it, but for what is always skipped
    links: int = 0  # those of them in links
    title: bool = False  # whether a title or a main element is in it


def scan(page: str) -> tuple[list[_Element], list[tuple[int, bool, object]]]:
    """The elements, and the tokens in order: (element, in a link, text), or for
    a tag (element, False, (name, breaks)), where breaks tells whether the tag
    breaks blocks (True), is white space (False), or is neither (None)."""
    elements = [_Element("", -1, 0, False)]
    tokens: list[tuple[int, bool, object]] = []
    path: list[int] = [0]
    still: Counter[str] = Counter()  # open elements by name
    place, links, articles = 0, 0, 0

    def text(value: str) -> None:
        tokens.append((path[-1], links > 0, html.unescape(value) if "&" in value else value))

    def pop() -> str:
        nonlocal links, articles
        name = elements[path.pop()].name
        still[name] -= 1
        links -= name == "a"
        articles -= name in ("article", "main")
        return name

    while True:
        match = _TOKEN.search(page, place)
        before = page[place : match.start() if match else len(page)]
        if before:
            text(before)
        if not match:
            return elements, tokens
        place = match.end()
        if match["cdata"]:
            text(match["cdata"])
        name = match["name"]
        if not name:
            continue
        name = name.lower()
        breaks = True if name in _BLOCKS else False if name in _SPACES else None
        if match["close"]:
            tokens.append((path[-1], False, (name, breaks)))
            if still[name]:
                while pop() != name:
                    pass
            continue
        if name in _RAW_END:
            end = _RAW_END[name].search(page, place)
            place = end.start() if end else len(page)
            tokens.append((path[-1], False, (name, None if name == "svg" else True)))
            if end:
                closing = page.find(">", place)
                place = closing + 1 if closing >= 0 else len(page)
            continue
        if breaks and elements[path[-1]].name in _CLOSED_BY_BLOCK:
            pop()
        if name == "a" and links:  # links do not nest
            at = max(k for k, i in enumerate(path) if elements[i].name == "a")
            del path[at]
            still["a"] -= 1
            links -= 1
        tokens.append((path[-1], False, (name, breaks)))
        if name in _VOID or match["attrs"].endswith("/") and name not in _BLOCKS:
            continue
        kind, content = _kind(name, match["attrs"], articles > 0)
        elements.append(_Element(name, path[-1], kind, content))
        path.append(len(elements) - 1)
        still[name] += 1
        links += name == "a"
        articles += name in ("article", "main")


def _counted(elements: list[_Element], tokens: list[tuple[int, bool, object]]) -> None:
    """Fill in the words of the elements."""
    always = [False] * len(elements)
    for i, e in enumerate(elements):
        always[i] = e.kind == _ALWAYS or e.parent >= 0 and always[e.parent]
        e.title = e.name in ("h1", "main")
    for i, in_link, value in tokens:
        if isinstance(value, str) and not always[i]:
            n = len(value.split())
            elements[i].words += n
            elements[i].links += n * in_link
    for i in range(len(elements) - 1, 0, -1):
        e, parent = elements[i], elements[elements[i].parent]
        parent.words += e.words
        parent.links += e.links
        parent.title |= e.title


def _skipped(elements: list[_Element]) -> list[bool]:
    """Whether each element is in boilerplate."""
    total = elements[0].words
    out = [False] * len(elements)
    for i, e in enumerate(elements):
        if e.parent >= 0 and out[e.parent]:
            out[i] = True
        elif e.kind == _USUALLY:
            # A form over the whole page, or a part with the page's title.
            main = 2 * e.words > total and (e.name == "form" or e.title)
            out[i] = not main
        elif e.kind == _IF_LINKS:
            out[i] = 2 * e.links > e.words
        else:
            out[i] = e.kind == _ALWAYS
    return out


def _article(
    elements: list[_Element], tokens: list[tuple[int, bool, object]], skipped: list[bool]
) -> tuple[list[bool], bool]:
    """Whether each element's own words belong to the article, and whether the
    page marks it.

    The words are grouped by the article element they are in. The main group is
    the largest, where a title counts for as much again. If an article element
    holds it, it is the article. If it lies in none, that is the outermost main
    or content element with most of the group. Article elements that hold less
    are outside, but for pages of several of like size without a title of their
    own, which are one article together.
    """
    group = [0] * len(elements)
    for i, e in enumerate(elements):
        if e.parent >= 0:
            group[i] = i if e.name == "article" else group[e.parent]
    words = [0] * len(elements)  # by group
    own = [0] * len(elements)  # by element, of its group
    for i, _, value in tokens:
        if isinstance(value, str) and not skipped[i]:
            n = len(value.split())
            words[group[i]] += n
            own[i] += n
    titles = {group[i] for i, e in enumerate(elements) if e.name == "h1" and not skipped[i]}
    best = max(range(len(elements)), key=lambda g: (words[g] * (1 + (g in titles)), -g))
    total = sum(words)
    if not total:
        return [False] * len(elements), False
    others = sorted((n for g, n in enumerate(words) if g != best), reverse=True)
    together = (
        best > 0 and best not in titles and 2 * words[best] <= total and 2 * others[0] >= words[best]
    )
    if best and not together:
        inside = [group[i] == best for i in range(len(elements))]
        return inside, True
    member = [together or group[i] == 0 for i in range(len(elements))]
    held = [n * m for n, m in zip(own, member, strict=True)]
    for i in range(len(elements) - 1, 0, -1):
        held[elements[i].parent] += held[i]
    most = _MOST * held[0]
    marks = [
        i
        for kind in ("main", "content")
        for i, e in enumerate(elements)
        if not skipped[i]
        and (e.name == "main" if kind == "main" else e.content)
        and held[i] > most
    ]
    if not marks:
        return member, together
    inside = [False] * len(elements)
    for i, e in enumerate(elements):
        inside[i] = i == marks[0] or e.parent >= 0 and inside[e.parent]
    return [a and b for a, b in zip(inside, member, strict=True)], True


def tokens_of(page: str, plain: bool = False) -> tuple[list[tuple[str, object, bool]], bool]:
    """The tokens (feature, text or block break, inside the article), and whether
    the page marks its article.

    Features are "word", "link word", "outside word" and "skipped word" with
    their text, and "tag <name>". In a marked article all words are "word" and
    all tags "inner tag", and what lies between its parts counts as skipped.
    With `plain` marks change no feature.
    """
    elements, raw = scan(page)
    _counted(elements, raw)
    skipped = _skipped(elements)
    inside, marked = _article(elements, raw, skipped)
    free = marked and not plain
    parts = [k for k, (i, _, value) in enumerate(raw) if inside[i] and not skipped[i] and isinstance(value, str)]
    first, last = (parts[0], parts[-1]) if parts else (0, -1)
    tokens: list[tuple[str, object, bool]] = []
    for k, (i, in_link, value) in enumerate(raw):
        between = free and first <= k <= last
        if not isinstance(value, str):
            name, breaks = value
            named = f"tag {name if name in _NAMES else 'other'}"
            feature = "skipped tag" if skipped[i] else "inner tag" if between else named
            tokens.append((feature, breaks, inside[i]))
            continue
        if skipped[i] or not plain and not inside[i] and (between or not marked):
            feature = "skipped word"
        elif free:
            feature = "word" if inside[i] else "outside word"
        else:
            feature = "link word" if in_link else "word"
        tokens.append((feature, value, inside[i]))
    return tokens, marked


def region(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous run with the largest sum; the first of
    equal ones, and an empty one if no score is positive."""
    best, best_at, total, start = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, best_at = total, (start, i + 1)
    return best_at


def main_text(page: str, weights: dict[str, float]) -> str:
    """Blocks of the best region, joined by line ends; empty if there is none."""
    tokens, _ = tokens_of(page)
    scores, gap = [], 0.0
    for feature, value, _ in tokens:
        if isinstance(value, str):
            score = weights.get(feature, _PRIORS.get(feature, 0.0)) * len(value.split())
            gap = 0.0 if score else gap
        else:
            score = 0.0 if feature in _FREE else weights.get(feature, _TAG_PRIOR)
            score = max(score, _GAP - gap)
            gap += score
        scores.append(score)
    start, end = region(scores)
    blocks, parts = [], []
    for feature, value, _ in tokens[start:end]:
        if value is True:
            blocks.append("".join(parts))
            parts = []
        elif value is False:
            parts.append(" ")
        elif isinstance(value, str) and feature in ("word", "link word"):
            parts.append(value)
    blocks.append("".join(parts))
    blocks = (" ".join(block.split()) for block in blocks)
    return "\n".join(block for block in blocks if block)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[tuple[str, bool]] = Counter()
    for batch in batches:
        for page in batch.column(0).to_pylist():
            tokens, marked = tokens_of(page or "", plain=True)
            if not marked:
                continue
            for feature, value, inside in tokens:
                n = len(value.split()) if isinstance(value, str) else 1
                counts[feature, inside] += n
    rows = [(f, inside, n) for (f, inside), n in counts.items()]
    names = ["feature", "inside", "n"]
    columns = zip(*rows, strict=True) if rows else ([], [], [])
    kinds = (pa.string(), pa.bool_(), pa.int64())
    yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def fit(pages: DataFrame) -> dict[str, float]:
    """Weights of the features: log odds of being inside the article.

    Fitted on LABELLED_PAGES pages with an article or main element at most, by a
    hash of the id, which bounds the broadcast list of ids. Without any, and for
    rare features, the weights are those of the priors. Words stay positive and
    tags negative, each in its range. They decide on pages that mark no article.
    """
    ship(pages.sparkSession)
    labelled = (
        pages.where(F.lower("html").rlike("<(article|main)[ >]"))
        .select("page_id")
        .distinct()
        .orderBy(F.xxhash64("page_id"), "page_id")
        .limit(LABELLED_PAGES)
    )
    counts = (
        pages.join(F.broadcast(labelled), "page_id", "left_semi")
        .select("html")
        .mapInArrow(_features, "feature string, inside boolean, n long")
        .groupBy("feature")
        .agg(
            F.sum(F.when(F.col("inside"), F.col("n"))).alias("inside"),
            F.sum(F.when(~F.col("inside"), F.col("n"))).alias("outside"),
        )
        .where("inside + outside >= 20 OR inside >= 20 OR outside >= 20")
        .collect()  # a feature for each name in _NAMES at most
    )
    total_in = sum(r["inside"] or 0 for r in counts) or 1
    total_out = sum(r["outside"] or 0 for r in counts) or 1
    weights = {}
    for row in counts:
        feature, n = row["feature"], (row["inside"] or 0) + (row["outside"] or 0)
        if feature.startswith("skipped"):
            continue
        prior = _PRIORS.get(feature, _TAG_PRIOR)
        odds = math.log(
            ((row["inside"] or 0) / total_in + 1e-4) / ((row["outside"] or 0) / total_out + 1e-4)
        )
        low, high = _RANGES.get(feature, _TAG_RANGE)
        weights[feature] = min(high, max(low, (n * odds + PRIOR * prior) / (n + PRIOR)))
    return weights


def extracted(text: str | Column, weights: dict[str, float]) -> Column:
    """Main text of a column of pages; null counts as empty and gives ''."""

    @F.arrow_udf(T.StringType())
    def extract(pages: pa.Array) -> pa.Array:
        return pa.array((main_text(p.as_py() or "", weights) for p in pages), pa.string())

    return extract(F.col(text) if isinstance(text, str) else text)


def main_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of `pages`. Null and empty
    pages have an empty text. Repeated rows give repeated rows."""
    text = extracted("html", fit(pages))
    return pages.select("page_id", "url", text.alias("text")).withColumn(
        "n_chars", F.length("text").cast("long")
    )
