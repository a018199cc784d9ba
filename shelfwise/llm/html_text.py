"""Main text of web pages by the maximum-scoring subsequence of their tokens.

A page is a sequence of words and tags.  Words score by the element they stand
in, tags by their name; the weights are log-odds learned from labelled pages,
which mark their article themselves with one <article> or <main> element.  One
linear scan finds the contiguous region with the highest sum.  Where a page has
one <article>, or one <main> and no <article>, what stands there and isn't left
out never costs more than a tag's least: lists, links and titles at its ends
belong to it.

Within the region, menus, adverts, comments, forms and the like are left out.
Whether an element is one of these is a linear model over its name and the words
of its class, id and role: weights start from the fixed values below and are
fitted to where such elements stand on the labelled pages.  An element that is
left out scores as its opening tag alone, however long it is, so that it doesn't
part an article in two.  The rest becomes blocks of text.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks, table

#: At most so many labelled pages teach the weights, drawn by a hash of their ids.
MAX_LABELLED = 800
#: Tags always cost something, words in an element that labels favour always gain.
TAG_COST, LEAST_GAIN = -0.02, 0.05

#: Elements that end a block of text, that have no end tag, and that hold no text of the page.
BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe svg math object canvas title".split())
#: Of these, what browsers read as raw text up to the end tag; and what may be self-closed.
RAW_TEXT = frozenset("script style noscript textarea iframe title".split())
FOREIGN = frozenset("svg math".split())
#: What speaks for (above 0) or against an element as part of an article before any page is seen:
#: its name, then words that say what an element is, and words that say where, or what kind of box, it is.
BIAS = 1.0
NAME_WEIGHTS = {"article": 6.0, "main": 6.0, "h1": 3.0, "h2": 1.5, "h3": 1.5, "h4": 1.5, "h5": 1.5, "h6": 1.5, "p": 1.0, "nav": -7.0, "footer": -5.0, "header": -5.0, "aside": -5.0, "form": -7.0, "button": -7.0, "select": -7.0, "dialog": -7.0, "menu": -7.0, "head": -9.0}
WORD_WEIGHTS = {w: -3.0 for w in "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments cookie cookies disqus footer menu modal nav navbar navigation newsletter notice notices popup promo promoted promotion related share sharing sidebar social sponsor sponsored subscribe widget".split()} | {"header": -2.0}
PLACE_WORDS = frozenset("area bar block body bottom box btn button buttons column container fixed form global group holder inner item items left link links list main mobile outer overlay page panel placeholder post posts primary right row secondary section signup site slot sticky text title toolbar top unit wrap wrapper zone".split())
#: Beginnings of words that say what an element is, whatever stands beside them in a class, and whole words of that kind; and
#: words that turn a class into a statement about a layout (``no-sidebar``, ``has-comments``).
SAYING_STEMS = {"comment": "comments", "sponsor": "sponsored", "cookie": "cookie", "consent": "cookie", "gdpr": "cookie", "advert": "advert", "adsby": "ads", "newslet": "newsletter", "disqus": "disqus", "subscri": "subscribe", "breadcrumb": "breadcrumb", "promo": "promo"}
SAYING_WORDS = {"ad": "ads", "ads": "ads", "replies": "comments", "reply": "comments", "respond": "comments", "related": "related", "share": "share", "sharing": "share", "social": "social", "taboola": "ads", "outbrain": "ads", "doubleclick": "ads"}
LAYOUT_WORDS = frozenset("no has with without is not hide hidden show enabled disabled open closed count single".split())
#: How firmly weights of names, and of words, hold to their start while they are fitted.
FIRM_NAME, FIRM_WORD = 200.0, 1.0
#: Elements whose end tag is often left out: a new one of the second group ends an open one of the first.
IMPLIED = {"p": BLOCK, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"])}

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*)*)(?:>|\Z)|([^<]+|<)", re.S)
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
SPACE = re.compile(r"\s+")


@dataclass(slots=True)
class Token:
    """A tag, or the text between two tags, with what holds where it stands."""

    feature: str
    words: int  # 0 for a tag
    text: str = ""
    block: bool = False  # a block ends here
    inside: bool = True  # not within an element that is never part of an article
    marked: int = 0  # within the page's own <main> (1) or <article> (2)
    features: tuple[str, ...] = ()  # of an element that opens and isn't within one that is left out


class Containers:
    """Which elements are no part of an article: those whose weights sum to less than 0."""

    def __init__(self, weights: dict[str, float] | None = None) -> None:
        self.weights = weights or {}
        self.known: dict[tuple[str, str, bool], bool] = {}

    @staticmethod
    def start(feature: str) -> float:
        return NAME_WEIGHTS.get(feature[5:], 0.0) if feature.startswith("name:") else WORD_WEIGHTS.get(feature[5:], 0.0)

    @staticmethod
    def features(name: str, attributes: str, within: bool = False) -> tuple[str, ...]:
        """The element's name, and what its class, id and role say that it is.

        A class counts by its parts if each says what or where an element is,
        one of them what: so ``site-footer`` gives ``footer``.  Some words say
        it beside any other (``reader-comments``, ``adsbygoogle``).  Any other
        class, such as ``no-sidebar``, is a word of its own.  ``within`` an
        article a header holds its title, so no name or word of it says a thing.
        """
        found = {f"name:inner {name}" if within and name == "header" else f"name:{name}"}
        if "=" in attributes:
            for m in NAMED.finditer(attributes):
                for said in "".join(m.groups("")).lower().split():
                    parts = {p for p in re.split(r"[^a-z]+", said) if p}
                    what = (parts & WORD_WEIGHTS.keys()) - ({"header"} if within else set())
                    loud = {SAYING_WORDS[p] for p in parts if p in SAYING_WORDS} | {w for p in parts for stem, w in SAYING_STEMS.items() if p.startswith(stem)}
                    if loud and not parts & LAYOUT_WORDS:
                        found |= {f"word:{p}" for p in loud}
                    elif what and parts <= WORD_WEIGHTS.keys() | PLACE_WORDS:
                        found |= {f"word:{p}" for p in what}
                    else:
                        found.add(f"word:{said}")
        return tuple(sorted(found))

    def score(self, features: tuple[str, ...]) -> float:
        """Of several words only the one that speaks loudest counts."""
        words = [self.weights.get(f, self.start(f)) for f in features if f.startswith("word:")]
        names = [self.weights.get(f, self.start(f)) for f in features if f.startswith("name:")]
        return BIAS + sum(names) + (max(words, key=abs) if words else 0.0)

    def outside(self, name: str, attributes: str, within: bool = False) -> bool:
        key = (name, attributes, within)
        if key not in self.known:
            if len(self.known) > 50_000:
                self.known.clear()
            self.known[key] = self.score(self.features(name, attributes, within)) < 0.0
        return self.known[key]

    @staticmethod
    def fit(counts: dict[tuple[str, ...], tuple[float, float]], steps: int = 60) -> Containers:
        """Logistic regression on elements within and outside labelled articles; weights are drawn back to their start."""
        names = sorted({f for features in counts for f in features})
        start = {f: Containers.start(f) for f in names}
        fitted = Containers(dict(start))
        firm = {f: FIRM_NAME if f.startswith("name:") else FIRM_WORD for f in names}
        for _ in range(steps):
            slope = {f: firm[f] * (fitted.weights[f] - start[f]) for f in names}
            curve = dict(firm)
            for features, (within, without) in counts.items():
                p = 1.0 / (1.0 + math.exp(-fitted.score(features)))
                words = [f for f in features if f.startswith("word:")]
                loudest = [max(words, key=lambda f: abs(fitted.weights[f]))] if words else []
                for f in [f for f in features if f.startswith("name:")] + loudest:
                    slope[f] += (within + without) * p - within
                    curve[f] += (within + without) * p * (1.0 - p)
            for f in names:
                fitted.weights[f] -= 0.5 * slope[f] / curve[f]
        return fitted


def tokens(page: str, containers: Containers | None = None) -> list[Token]:
    """Tags and texts of a page in order; a tag that isn't closed, or closed twice, does no harm.

    <html>, <body>, <main> and the page's first <article> are never left out,
    nor is an element around one of them.
    """
    containers = containers or Containers()
    found, around = _tokens(page, containers, frozenset())
    return _tokens(page, containers, around)[0] if around else found


@dataclass(slots=True)
class Open:
    """An open element: what it is, what holds within, and the place on the stack of the nearest block element, itself included."""

    name: str
    outside: bool
    marked: int
    place: int  # in the page, if it is left out, or else -1
    block: int
    inner: str  # the nearest block element or anchor


def _tokens(page: str, containers: Containers, spared: frozenset[int]) -> tuple[list[Token], frozenset[int]]:
    """The tokens, and where the elements start that are left out though they are around one that never is; those in ``spared`` aren't.

    Every step looks at the top of the stack alone, and each element leaves it once.
    """
    out: list[Token] = []
    stack: list[Open] = []
    opened: Counter[str] = Counter()
    left_out: list[int] = []  # places on the stack of elements that are left out, and not yet in ``around``
    around: set[int] = set()
    ends: dict[str, re.Match | None] = {}  # of RAW elements, the last one looked up
    place, articles = 0, 0

    def pop() -> str:
        name = stack.pop().name
        opened[name] -= 1
        if left_out and left_out[-1] == len(stack):
            left_out.pop()
        return name

    while m := TOKEN.match(page, place):
        place = m.end()
        closing, name, attributes, text = m.groups()
        if text is not None:
            top = stack[-1] if stack else None
            outside = top is not None and top.outside
            inner = top.inner if top else "body"
            out.append(Token(f"word:{'outside' if outside else inner}", len(text.split()), text, False, not outside, top.marked if top else 0))
        elif name:
            name, features = name.lower(), ()
            outside, marked = (stack[-1].outside, stack[-1].marked) if stack else (False, 0)
            if closing:
                if opened[name]:
                    while pop() != name:
                        pass
                marked = stack[-1].marked if stack else 0
            else:
                while stack and name in IMPLIED.get(stack[-1].name, ()):
                    pop()
                if name in IMPLIED["p"] and stack and stack[-1].block >= 0 and stack[stack[-1].block].name == "p":
                    at = stack[-1].block  # an open <p> ends even below inline elements that were never closed
                    while len(stack) > at:
                        pop()
                outside, marked = (stack[-1].outside, stack[-1].marked) if stack else (False, 0)
                articles += name == "article"
                never = name in ("html", "body", "main") or name == "article" and articles == 1
                if never:
                    around.update(stack[k].place for k in left_out)
                    left_out.clear()
                if name not in VOID and not attributes.endswith("/"):
                    left = not never and m.start() not in spared and containers.outside(name, attributes, marked == 2)
                    if not outside and not never:
                        features = containers.features(name, attributes, marked == 2)
                    marked = 2 if name == "article" else max(marked, int(name == "main"))
                    block = len(stack) if name in BLOCK else stack[-1].block if stack else -1
                    inner = name if name in BLOCK or name == "a" else stack[-1].inner if stack else "body"
                    if left:
                        left_out.append(len(stack))
                    outside = outside or left
                    stack.append(Open(name, outside, marked, m.start() if left else -1, block, inner))
                    opened[name] += 1
                if name in RAW:
                    place = _raw_end(page, place, name, attributes, ends)
            out.append(Token(f"tag:{'/' if closing else ''}{name}", 0, "", name in BLOCK, not outside, marked, features))
    return out, frozenset(around)


def _raw_end(page: str, place: int, name: str, attributes: str, ends: dict[str, re.Match | None]) -> int:
    """Where a RAW element that starts before ``place`` ends: up to its end tag nothing is text.

    Empty are a self-closed <svg> or <math>; another self-closed one without
    an end tag of its own; and without an end tag, all that browsers don't
    read as raw text.
    """
    closed = attributes.endswith("/")
    if closed and name in FOREIGN:
        return place
    if name not in ends or ((end := ends[name]) and end.start() < place):
        ends[name] = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, place)
    end = ends[name]
    if end is None:
        return place if closed or name not in RAW_TEXT else len(page)
    if closed and re.compile(rf"<{re.escape(name)}[\s/>]", re.I).search(page, place, end.start()):  # that end tag is another one's
        return place
    return end.start()


@dataclass
class Weights:
    by: dict[str, float] = field(default_factory=dict)
    containers: Containers = field(default_factory=Containers)

    @staticmethod
    def learn(counts: dict[str, tuple[float, float]]) -> Weights:
        """From each feature's counts within and outside labelled articles; several names joined by blanks are those of an element."""
        elements = {tuple(f.split(" ")[1:]): c for f, c in counts.items() if f.startswith("element ")}
        counts = {f: c for f, c in counts.items() if not f.startswith("element ")}
        within, without = (max(1.0, sum(c[k] for c in counts.values())) for k in (0, 1))
        odds = {f: math.log(((a + 0.5) / within) / ((b + 0.5) / without)) for f, (a, b) in counts.items()}
        return Weights({f: min(TAG_COST, w) if f.startswith("tag:") else (max(LEAST_GAIN, w) if counts[f][0] > counts[f][1] else w) for f, w in odds.items()}, Containers.fit(elements))

    def __call__(self, token: Token) -> float:
        if not token.inside:  # left out of the text later: only the tag that opens such an element costs something
            return 0.0
        if token.words:
            return self.by.get(token.feature, 0.5) * token.words  # 0.5: an element that no labelled page has
        return max(-4.0, self.by.get(token.feature, -0.1)) if token.feature.startswith("tag:") else 0.0


def best_region(scores: list[float]) -> tuple[int, int]:
    """The contiguous range with the largest positive sum, the first and longest of equals; (0, 0) if none is positive."""
    best, region, total, start = 0.0, (0, 0), 0.0, 0
    for k, s in enumerate(scores):
        if total <= 0.0:
            total, start = 0.0, k
        total += s
        if total > best:
            best, region = total, (start, k + 1)
    return region


def scores(found: list[Token], weights: Weights) -> list[float]:
    """Each token's score; within a page's only <article>, or its only <main> where it has none, a word always gains and a tag hardly costs."""
    opened = Counter(t.feature for t in found if t.feature in ("tag:article", "tag:main"))
    own = 2 if opened["tag:article"] == 1 else 1 if opened["tag:main"] == 1 and not opened["tag:article"] else 3
    out = []
    for t in found:
        score = weights(t)
        if t.inside and t.marked >= own:
            score = max(score, LEAST_GAIN * t.words if t.words else TAG_COST)
        out.append(score)
    return out


def extract(page: str, weights: Weights) -> str:
    """The main text of a page: blocks joined by a line break, white space within a block turned into one blank."""
    found = tokens(page, weights.containers)
    lo, hi = best_region(scores(found, weights))
    lines: list[str] = []
    parts: list[str] = []

    def close() -> None:
        line = SPACE.sub(" ", html.unescape("".join(parts))).strip()
        if line:
            lines.append(line)
        parts.clear()

    for t in found[lo:hi]:
        if t.block:
            close()
        elif t.feature == "tag:br":
            parts.append(" ")
        elif t.inside and t.text:
            parts.append(t.text)
    close()
    return "\n".join(lines)


def learn_weights(pages: DataFrame, limit: int = MAX_LABELLED) -> Weights:
    """Weights from at most ``limit`` pages with one <article> or <main> element; those of no page are the fixed ones.

    The driver gets one line for each name, class or set of them on these pages, and all of them count.
    """
    has = F.lower(F.col("html")).rlike(r"<(article|main)[\s>]")
    drawn = pages.where(has).select("page_id").orderBy(F.xxhash64("page_id"), "page_id").limit(limit).select(F.col("page_id").alias("_drawn")).distinct()
    sample = pages.select("page_id", "html").join(F.broadcast(drawn), F.col("page_id") == F.col("_drawn"), "left_semi").where(has)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, column="html"):
                within, without = Counter(), Counter()
                for page in part["html"].to_pylist():
                    found = tokens(page or "")
                    if sum(t.feature in ("tag:article", "tag:main") for t in found) == 1:
                        for t in found:
                            (within if t.marked and t.inside else without)[t.feature] += t.words or 1
                            if t.features:
                                (within if t.marked else without)["element " + " ".join(t.features)] += 1
                names = sorted(within.keys() | without.keys())
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array([c[n] for n in names], pa.int64()) for c in (within, without))], ["feature", "within", "without"])

    counted = sample.select("html").mapInArrow(count, "feature string, within long, without long").groupBy("feature").agg(F.sum("within").alias("a"), F.sum("without").alias("b"))
    return Weights.learn({r["feature"]: (float(r["a"]), float(r["b"])) for r in counted.orderBy("feature").collect()})


def extract_pages(pages: DataFrame, weights: Weights) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text.

    Null or empty html, and pages where no region scores above 0, give the
    empty text; repeated rows give equal texts; pages of any length count
    whole, in time proportional to it; other columns play no part.  An empty
    table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, column="html"):
                yield pa.RecordBatch.from_arrays([part["page_id"], part["url"], pa.array([extract(h, weights) for h in part["html"].to_pylist()], pa.string())], ["page_id", "url", "text"])

    plain = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    return plain.mapInArrow(run, "page_id long, url string, text string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract_pages(pages, learn_weights(pages)).withColumn("n_chars", F.length("text").cast("long"))
