"""Main text of web pages: the contiguous stretch whose words and tags score highest.

A page is read once, from left to right, into pieces of text, each with the element it stands in and the tags
before it. Words of content score above zero, other words and all tags below; the region with the highest sum
(found in one linear scan) is the article. What stands inside it in menus, adverts, forms or
comments is left out, unless that turns out to be a wrapper of the article.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import sampled

#: Labelled pages that weights are learned from (those with the smallest hashed id), at most.
SAMPLE_PAGES = 2_000
#: Features that the model keeps, those seen in most pages first.
FEATURES = 5_000

# Element names of HTML by what they mean for text.
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
    "summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
#: Elements that never hold text of an article, and those that rarely do.
DROPPED = frozenset(
    "applet audio button canvas dialog embed head iframe input map math noembed noframes noscript object "
    "option picture script select style svg template textarea title video".split()
)
OTHER = frozenset("aside footer form menu nav search".split())
LABELS = ("article", "main")
#: What a word gains inside an element labelled as an article, and loses outside if the page has one.
LABEL_BONUS = 1.0
#: Share of its cost that a tag before labelled text keeps.
LABEL_TAGS = 0.25
#: Words in class, id or role that mark what is not part of an article, and those that mark one.
OTHER_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner banners breadcrumb breadcrumbs comment comments complementary consent "
    "contentinfo cookie cookies copyright disqus footer gdpr login masthead menu menus nav navbar navigation newsletter notice notices "
    "outbrain pager pagination popup promo promos promotion promoted recommended related replies reply search share sharing sidebar "
    "signup skip social sponsor sponsored subscribe subscription taboola toolbar topbar widget widgets".split()
)
COMMENT_NAMES = frozenset("comment comments disqus replies reply".split())
#: Words that say in the first place of a class name that the rest of it is a property of the whole page.
PROPERTIES = frozenset("has have is no not show hide with without".split())
#: Elements and names that are no wrapper of the article however much they hold, unless they hold what the page marks as that.
NO_WRAPPERS = COMMENT_NAMES | frozenset(
    "ad ads advert adverts advertisement advertising breadcrumb breadcrumbs consent cookie cookies footer gdpr menu menus nav "
    "navbar navigation outbrain taboola".split()
)
#: Share of the words that are in nothing else of the kind from which on an element is a wrapper.
WRAPPER = 0.6
MAIN_NAMES = frozenset("article articlebody body content entry main post story text".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.S,
)
_NAMES = re.compile(r"(?:^|[\s\"'/])(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@dataclass(slots=True, eq=False)
class Other:
    """An element that by its tag or names is not part of an article, if it does not hold most of it."""

    names: frozenset[str]
    outer: tuple[Other, ...] = ()  # those of the kind around it
    own: int = 0  # words in it and in no other of the kind within it
    marked: int = 0  # words of what the page marks as its article, within it
    wrapper: bool = False


@dataclass(slots=True)
class Element:
    tag: str
    features: frozenset[str]
    labelled: bool  # stands in what the page itself marks as its article
    hard: bool  # stands in an element that never holds text
    marked: bool = False  # stands in any element with such a mark
    others: tuple[Other, ...] = ()  # from the outermost to the innermost
    around: int = 0  # how many of them are around the outermost mark

    @property
    def dropped(self) -> bool:
        return self.hard or any(not o.wrapper for o in self.others)


@dataclass(slots=True)
class Piece:
    text: str
    element: Element
    tags: list[Element]  # the elements that were opened or closed since the piece before
    block: int  # number of the block it belongs to
    words: int = 0


def _open(tag: str, attributes: str, parent: Element, label: str | None) -> Element:
    found = [next(filter(None, m.groups()), "") for m in _NAMES.finditer(attributes)] if "=" in attributes else []
    parts = [[n.lower() for n in _NAME.findall(text)] for value in found for text in value.split()]
    names = {n for own in parts for n in own}
    hard, others, around = parent.hard or tag in DROPPED, parent.others, parent.around
    if tag not in ("html", "body", "main"):
        telling = {n for own in parts if own and own[0] not in PROPERTIES for n in own}
        other = telling & (COMMENT_NAMES if tag == "article" else OTHER_NAMES)
        if (tag == "header" or "header" in telling) and not parent.labelled and tag != "article":
            other |= {"header"}
        if tag in OTHER:
            other |= {tag}
        if other:
            others = (*others, Other(frozenset(other), others))
    commented = any(o.names & COMMENT_NAMES for o in others)
    names_main = bool(names & {"main", "articlebody"})
    labelled = parent.labelled or (tag == label or label == "main" and names_main) and not hard and not commented
    marked = parent.marked or (tag in LABELS or names_main) and not hard and not commented
    if marked and not parent.marked:
        around = len(others)
    own = {tag} if tag == "a" else {f".{n}" for n in names if n not in LABELS}
    if tag in BLOCKS and tag not in LABELS:
        own.add(tag)
    return Element(tag, parent.features | own if own else parent.features, labelled, hard, marked, others, around)


def _find_wrappers(pieces: list[Piece]) -> None:
    """Tell which of the elements that are usually no part of an article are around it here.

    One that holds most of the words that the page marks as its article is, if they are not few. If it marks none, it is one that
    holds most of the words that are in no other of the kind, from the outermost inwards.
    """
    found: dict[int, Other] = {}
    free = plain = marked = 0  # words in none of the kind, those of them that are not marked, all that are
    for p in pieces:
        element, words = p.element, p.words
        if element.hard or not words:
            continue
        for o in element.others:
            found[id(o)] = o
        if element.marked:
            marked += words
            for o in element.others[: element.around]:
                o.marked += words
        if element.others:
            element.others[-1].own += words
        else:
            free += words
            plain += 0 if element.marked else words
    for o in found.values():
        # A teaser in a sidebar may be all that is marked; an article is more than what is around it.
        o.wrapper = 2 * o.marked > marked and o.marked >= plain
    if any(p.element.marked and p.words and not p.element.dropped for p in pieces):
        return
    for o in found.values():
        if o.own and o.own >= WRAPPER * (o.own + free) and not any(x.names & NO_WRAPPERS for x in (o, *o.outer)):
            for x in (o, *o.outer):
                x.wrapper = True
            free += o.own


def pieces_of(source: str) -> tuple[list[Piece], bool]:
    """The pieces of text of a page, and whether the page marks its article itself."""
    lowered = source.lower() if source.isascii() else re.sub(
        "[A-Z]+", lambda m: m[0].lower(), source
    )  # keeps all places
    label = next((x for x in LABELS if re.search(rf"<{x}[\s>/]", lowered)), None)
    if label is None and re.search(r"role\s*=\s*[\"']?main\b|itemprop\s*=\s*[\"']?articlebody\b", lowered):
        label = "main"
    root = Element("", frozenset(), False, False)
    stack, held = [root], Counter()
    pieces: list[Piece] = []
    tags: list[Element] = []
    block = at = 0

    def leave(name: str) -> None:
        while (gone := stack.pop()).tag != name:
            held[gone.tag] -= 1
        held[name] -= 1

    while at < len(source):
        token = _TOKEN.search(source, at)
        end = token.start() if token else len(source)
        if end > at:
            text = source[at:end]
            pieces.append(Piece(text, stack[-1], tags, block, 0 if stack[-1].hard else len(text.split())))
            tags = []
        if token is None:
            break
        at = token.end()
        closing, name, attributes = (token[1], token[2], token[3]) if token[2] else (token[4], token[5], token[6])
        if not name:
            continue
        tag = name.lower()
        block += tag in BLOCKS
        if closing:
            tags.append(stack[-1])
            if held[tag]:
                leave(tag)
            continue
        if tag in BLOCKS and tag != "br" and held["p"] and stack[-1].tag not in ("button", "object"):
            leave("p")
        if tag in ("li", "td", "th", "tr", "dd", "dt", "option") and stack[-1].tag == tag:
            leave(tag)
        if tag == "body" and held["head"]:
            leave("head")
        element = _open(tag, attributes, stack[-1], label)
        tags.append(element)
        if tag in RAW:
            close = lowered.find(f"</{tag}", at)
            at = len(source) if close < 0 else (lowered.find(">", close) + 1 or len(source))
        elif tag not in VOID and not (attributes.endswith("/") and element.hard):
            stack.append(element)
            held[tag] += 1
    _find_wrappers(pieces)
    return pieces, any(p.element.labelled and not p.element.dropped for p in pieces)


@dataclass(frozen=True)
class Weights:
    """What a word adds by the elements it stands in, and what a tag takes away."""

    word: float = 1.0
    tag: float = -0.5
    by_feature: dict[str, float] = field(default_factory=dict)

    def score(self, element: Element) -> float:
        total = self.word + sum(self.by_feature.get(f, 0.0) for f in element.features)
        return max(-3.0, min(3.0, total))


def best_region(scores: list[float], tags: list[float]) -> tuple[int, int] | None:
    """First and last of the contiguous pieces with the highest sum of their scores and the tags between them."""
    best, found, run, start = 0.0, None, 0.0, 0
    for i, (score, before) in enumerate(zip(scores, tags)):
        run += before
        if run <= 0:
            run, start = 0.0, i
        run += score
        if run > best:
            best, found = run, (start, i)
    return found


def main_text(source: str | None, weights: Weights) -> str:
    """The article of one page, a line per block; empty if no words score above zero."""
    if not source:
        return ""
    pieces, _ = pieces_of(source)
    dropped: dict[int, bool] = {}  # elements are shared by many pieces and tags

    def gone(element: Element) -> bool:
        found = dropped.get(id(element))
        if found is None:
            found = dropped[id(element)] = element.dropped
        return found

    labelled = any(p.element.marked and not gone(p.element) for p in pieces)
    scores, cache = [], {}
    for p in pieces:
        words = 0 if gone(p.element) else p.words
        if words:
            key = id(p.element)
            if key not in cache:
                bonus = (LABEL_BONUS if p.element.marked else -LABEL_BONUS) if labelled else 0.0
                cache[key] = weights.score(p.element) + bonus
            words *= cache[key]
        scores.append(words)
    costs = [weights.tag * (LABEL_TAGS if p.element.marked else 1.0) * sum(not gone(e) for e in p.tags) for p in pieces]
    region = best_region(scores, costs)
    if region is None:
        return ""
    blocks: list[list[str]] = []
    last = None
    for p in pieces[region[0] : region[1] + 1]:
        if gone(p.element):
            continue
        if p.block != last:
            blocks.append([])
            last = p.block
        blocks[-1].append(p.text)
    lines = (" ".join(html.unescape("".join(parts)).split()) for parts in blocks)
    return "\n".join(filter(None, lines))


def fit(pages: DataFrame, id_column: str = "page_id", html_column: str = "html", rows: int = SAMPLE_PAGES) -> Weights:
    """Learn weights from at most ``rows`` pages that label their own article by an element for it.

    Words inside and outside it are counted per feature (block elements, names in class and id) on Spark;
    the driver gets the ``FEATURES`` most frequent. Names that usually mark articles or other matter start with a
    few counts of their own. Without labelled pages those decide.
    """
    source = F.col(html_column).cast("string")
    labelled = pages.filter(source.rlike(r"(?i)<(article|main)[\s>/]")).select(
        F.col(id_column).alias("id"), source.alias("html")
    )
    chosen = sampled(labelled, rows, "id").distinct()
    sample = labelled.join(F.broadcast(chosen), "id", "left_semi")  # at most ``rows`` ids

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, outside, pages_with = Counter(), Counter(), Counter()
        for batch in batches:
            for source in batch.column("html").to_pylist():
                pieces, found = pieces_of(source)
                if not found:
                    continue
                seen = {"*"}
                for p in pieces:
                    where = inside if p.element.labelled and not p.element.dropped else outside
                    where["<>"] += len(p.tags)
                    if words := p.words:
                        where["*"] += words
                        for f in p.element.features:
                            where[f] += words
                        seen |= p.element.features
                pages_with.update(seen)
        names = list({*inside, *outside})
        yield pa.RecordBatch.from_pydict(
            {
                "feature": names,
                "inside": [inside[n] for n in names],
                "outside": [outside[n] for n in names],
                "pages": [pages_with[n] for n in names]
            }
        )

    counts = sample.mapInArrow(
        count, "feature string, inside long, outside long, pages long"
    ).groupBy("feature").agg(*[F.sum(c).alias(c) for c in ("inside", "outside", "pages")])
    found = {
        r.feature: r for r in counts.orderBy(
            F.desc(F.when(F.col("feature").isin("*", "<>"), F.lit(2**62)).otherwise(F.col("pages"))), "feature"
        ).limit(FEATURES + 2).collect()
    }
    prior = {f".{n}": (200, 20) for n in MAIN_NAMES} | {
        n: (400, 40) for n in ("p", "h1", "h2", "h3", "blockquote", "pre")
    } | {n: (40, 80) for n in ("li", "td", "ul", "table")}
    total_in, total_out = (found["*"].inside, found["*"].outside) if "*" in found else (0, 0)
    balance = math.log((total_in + 1) / (total_out + 1)) if total_in and total_out else 0.0
    by_feature = {}
    for name in {*prior, *found} - {"*", "<>", "html", "body"}:
        a, b = prior.get(name, (1, 1))
        inside, outside = (found[name].inside, found[name].outside) if name in found else (0, 0)
        share = balance if inside + outside else 0.0
        by_feature[name] = max(-2.0, min(2.0, (math.log((inside + a) / (outside + b)) - share) / 2))
    if "<>" not in found or not found["<>"].inside or not total_out:
        return Weights(by_feature=by_feature)
    # A tag weighs as much as words come to a tag between the density of articles and that of the rest.
    density = math.sqrt(total_in / found["<>"].inside * max(1, total_out) / max(1, found["<>"].outside))
    return Weights(tag=-max(0.2, min(2.0, density / 4)), by_feature=by_feature)


def extract(
    pages: DataFrame, weights: Weights, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """Id, url, ``text`` and ``n_chars`` (its code points) of each page; rows stay one to one.

    NULL or empty html gives an empty text. Nothing is cut. Repeated rows are read each; other columns are
    not looked at; an empty table gives no rows.
    """
    kinds = [pages.schema[c].dataType.simpleString() for c in (id_column, url_column)]
    shared = pages.sparkSession.sparkContext.broadcast(weights)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(source.as_py(), shared.value) for source in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(texts, pa.string()),
                    pa.array(map(len, texts), pa.int64())
                ], names=["id", "url", "text", "n_chars"]
            )

    return (
        pages.select(
            F.col(id_column).alias("id"),
            F.col(url_column).alias("url"),
            F.col(html_column).cast("string").alias("html")
        )
        .mapInArrow(each, f"id {kinds[0]}, url {kinds[1]}, text string, n_chars long")
        .withColumnsRenamed({"id": id_column, "url": url_column})
    )


def extracted_pages(pages: DataFrame) -> DataFrame:
    """Learn from the pages that label their article, then extract every page."""
    return extract(pages, fit(pages))
