"""Main text of web pages by the maximum-scoring run of a page's tokens.

A page is a row of words and tags.  Words score above nought, tags below it, how much depends on the tag;
the contiguous run with the largest sum, found in one scan, is the content.  Menus and footers are many
tags and few words, an article the reverse.  Weights come from labelled pages: those that mark their
article with an element of that name, the inside of which is what the run should be.  They start from the
shares of each token inside and outside and are mended as long as a labelled page comes out wrong.

From the run, text is taken block by block: references decoded, white space turned into single blanks,
trimmed, blocks joined by one \\n.  Scripts, styles, comments, forms, and elements that are menus, notices,
adverts, sidebars or reader comments by their name or a whole word of their class, id or role are left out
wherever they are, unless they hold the main or longest article element or, but for menus and the like by
name and what stands beside such an element, most of the page's words.  Headings are never left out.

Null, empty and tagless pages: a page without words has an empty text; one without tags is all content.
Unclosed scripts and the like and comments reach to the end of the page, an unfinished tag at its end is
dropped.  Words in drawings, formulas and objects are text like others, the tags there cost nothing.  Pages
that repeat are read each by itself.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from html import unescape
from itertools import accumulate
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled pages the weights are learnt from, at most, and their greatest length in characters.
SAMPLE, LONGEST = 500, 100_000

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|iframe)(?=[\s/>]|\Z)(?:[^>\"']|\"[^\"]*\"|'[^']*')*(?:>.*?</(?P=raw)\s*>|\Z|>.*\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|<[!?/](?:[^>]*)(?:>|\Z)"
    r"|<(?P<odd>/?[a-zA-Z][^>]*)(?:>|\Z)",
    re.S | re.I,
)
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rb rp rt s samp small span strike strong sub sup time tt u var wbr".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_NEVER = frozenset("head title nav aside form button select fieldset dialog menu footer".split())
#: Of these, those that hold nothing else however many words they have.
_ONLY = _NEVER - {"form", "fieldset", "dialog"}
#: Elements with tags of their own, which weigh nothing; objects stand for something like them.
_FOREIGN = frozenset(["svg", "math"])
_FREE = _FOREIGN | {"object", "param"}
#: Not left out by class, id or role.
_SPARED = frozenset("html body article main h1 h2 h3 h4 h5 h6".split()) | _VOID | _FOREIGN
_NAMED = re.compile(
    r"(?<![\w-])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))",
    re.I,
)
_KEYWORD = (
    r"(?:ads?|advert(?:s|isements?|ising|orials?)?|adbox|sponsor(?:s|ed|ships?)?|promo(?:s|ted|tions?|tional)?|banners?|cookies?|consent|notices?|alerts?|newsletters?|subscribe|subscription|popup|modal|"
    r"sidebar|side-bar|widgets?|comments?|comment-\w+|replies|disqus|respond|nav(?:s|bar|igation)?|menu(?:s|bar)?|breadcrumbs?|pagination|pager|share|sharing|social|"
    r"related|recommend(?:ed|ations?)|footer|masthead|site-header|page-header|topbar|complementary|contentinfo|search|login|signup|toolbar|skip-link)"
)
#: A whole word of an attribute, or several joined: cookie-notice, but not has-sidebar.
_KIND = re.compile(rf"(?<!\S){_KEYWORD}(?:[_-]{_KEYWORD})*(?!\S)", re.I)

WORD = "word"
#: Weights before any page is seen; other tags weigh ``_OTHER``.
_START = {WORD: 1.0, "p": -0.2, "b": -0.1, "br": -0.1, "i": -0.1, "em": -0.1, "strong": -0.1, "h1": -0.4, "h2": -0.4, "h3": -0.4, "header": -0.5, "section": -0.5, "div": -1.0, "a": -0.7, "ul": -0.5, "ol": -0.5, "li": -0.3}
_START |= dict.fromkeys("h4 h5 h6 blockquote pre table tbody thead tr td th dl dt dd figure figcaption hr img".split(), -0.3)
#: Tags that no drawing or formula has.
_PAGE = frozenset(_START) - {WORD, "a"} | {"body", "html", "article", "main"}
#: What is left out costs little, so that a run can pass an advert between two paragraphs; its words count nothing.
_OTHER, _LEFT_OUT = -3.0, -1.0

Weights = dict[str, float]


def tokens(page: str) -> list[tuple[str, bool, int, int]]:
    """Tags as (kind, is end, begin, end of the markup).  The kind of an element to leave out begins with '-'."""
    out, inside_article = [], 0
    for m in _TOKEN.finditer(page):
        name = m["name"]
        if name is None:
            out.append(("!", False, m.start(), m.end()))
            continue
        name, end = name.lower(), bool(m["end"])
        kind = name
        if name in _FOREIGN and not end and m["rest"].rstrip().endswith("/"):
            kind = "!"
        if name in ("article", "main"):
            inside_article += -1 if end else 1
        if name in _NEVER or not end and (name == "header" and inside_article <= 0 or name not in _SPARED and "=" in m["rest"] and any(_KIND.search(a or b or c) for a, b, c in _NAMED.findall(m["rest"]))):
            kind = "-" + name
        out.append((kind, end, m.start(), m.end()))
    return spared(page, foreign(out))


def ends(tags: list[tuple[str, bool, int, int]]) -> dict[int, int]:
    """The end tag of each element that has one."""
    found, opened = {}, {}
    for i, (kind, end, _, _) in enumerate(tags):
        name = kind.lstrip("-")
        if not end:
            opened.setdefault(name, []).append(i)
        elif opened.get(name):
            found[opened[name].pop()] = i
    return found


def foreign(tags: list[tuple[str, bool, int, int]]) -> list[tuple[str, bool, int, int]]:
    """The tags, those inside a drawing as '!svg' and those inside a formula as '!'; if it is not closed, up to the next tag of a page."""
    if not any(t[0] in _FOREIGN for t in tags):
        return tags
    closes, i = ends(tags), 0
    while i < len(tags):
        kind, end, _, _ = tags[i]
        if kind in _FOREIGN and not end:
            j = closes.get(i)
            if j is None:
                j = next((k for k in range(i + 1, len(tags)) if tags[k][0] in _PAGE or tags[k][0][0] == "-" and tags[k][0] != "-title"), len(tags))
            for k in range(i + 1, j):
                if tags[k][0].lstrip("-") not in _NEVER:
                    tags[k] = ("!svg" if kind == "svg" else "!", *tags[k][1:])
            i = j - 1
        i += 1
    return tags


def spared(page: str, tags: list[tuple[str, bool, int, int]]) -> list[tuple[str, bool, int, int]]:
    """The tags, those of elements that hold the main or longest article element or most of the words no longer to leave out."""
    closes = ends(tags)
    marked = [i for i in closes if tags[i][0][0] == "-"]
    if not marked:
        return tags
    sums, at = [0], 0  # the words before each tag, those of menus and the like not counted
    only = -1
    for i, (kind, _, begin, end) in enumerate(tags):
        sums.append(sums[-1] + (len(page[at:begin].split()) if i > only else 0))
        if i >= only and i in closes and kind[1:] in _ONLY and kind[0] == "-":
            only = closes[i]
        at = end
    total = sums[-1] + len(page[at:].split())
    articles = [i for i, t in enumerate(tags) if t[0] == "article" and not t[1]]
    held = [i for i, t in enumerate(tags) if t[0] == "main" and not t[1]]
    if articles:
        held.append(max(articles, key=lambda i: (sums[closes[i] + 1] if i in closes else total) - sums[i + 1]))
    held.sort()
    marked.sort()
    # Where an article stands in nothing that is marked, it is the content, and an advert beside it none, however short it is.
    covers = list(accumulate((closes[i] for i in marked), max))
    plain = [(i, closes.get(i, len(tags))) for i in held if not (k := bisect_right(marked, i)) or covers[k - 1] < i]
    for i in marked:
        j, name = closes[i], tags[i][0][1:]
        k = bisect_right(held, i)
        most = name not in _ONLY and 2 * (sums[j + 1] - sums[i + 1]) > total and (not plain or any(a < i < b for a, b in plain))
        if most or k < len(held) and held[k] < j:
            tags[i], tags[j] = (name, *tags[i][1:]), (name, *tags[j][1:])
    return tags


def left_out(tags: list[tuple[str, bool, int, int]]) -> list[tuple[int, int]]:
    """Spans of tags [i, j) of the elements to leave out; the outermost, in order."""
    spans, i, closes = [], 0, ends(tags)
    while i < len(tags):
        kind, end, _, _ = tags[i]
        if kind[0] == "-" and not end:
            j = closes.get(i)
            if j is None:  # never closed: up to the next block
                j = i + 1
                while j < len(tags) and tags[j][0].lstrip("-") in _INLINE:
                    j += 1
                j -= 1
            spans.append((i, j + 1))
            i = j
        i += 1
    return spans


def scored(page: str, tags: list[tuple[str, bool, int, int]], weights: Weights) -> tuple[list[float], list[float]]:
    """The weight of each tag and of the words in front of it, and behind the last."""
    of_tags, of_words, at = [], [], 0
    word = weights[WORD]
    out = {i for a, b in left_out(tags) for i in range(a, b)}
    for i, (kind, _, begin, end) in enumerate(tags):
        of_words.append(0.0 if i in out and i - 1 in out else word * len(page[at:begin].split()))
        of_tags.append(_LEFT_OUT if kind[0] == "-" else 0.0 if i in out or kind[0] == "!" or kind in _FREE else weights.get(kind, _OTHER))
        at = end
    of_words.append(word * len(page[at:].split()))
    return of_tags, of_words


def best_run(of_tags: list[float], of_words: list[float]) -> tuple[int, int] | None:
    """Texts [i, j] with the largest sum, the tags between them included; of equal ones the first.  Text i stands in front of tag i."""
    best, run, begin, found = 0.0, 0.0, 0, None
    for j, words in enumerate(of_words):
        if run <= 0:
            run, begin = 0.0, j
        run += words
        if run > best:
            best, found = run, (begin, j)
        if j < len(of_tags):
            run += of_tags[j]
    return found


def extract(page: str, weights: Weights) -> str:
    """The main text of a page."""
    tags = tokens(page)
    of_tags, of_words = scored(page, tags, weights)
    run = best_run(of_tags, of_words)
    if run is None:
        return ""
    skip = {i for a, b in left_out(tags) for i in range(a + 1, b)}  # texts in front of these tags
    blocks, part = [], []
    for i in range(run[0], run[1] + 1):
        begin = tags[i - 1][3] if i else 0
        end = tags[i][2] if i < len(tags) else len(page)
        if i not in skip and begin < end:
            part.append(page[begin:end])
        if i == len(tags):
            break
        kind = tags[i][0].lstrip("-")
        if kind in ("br", "!svg"):
            part.append(" ")
        elif kind not in _INLINE and kind not in _FREE and kind != "!":
            blocks.append("".join(part))
            part = []
    blocks.append("".join(part))
    cleaned = (" ".join(unescape(x).split()) for x in blocks if x)
    return "\n".join(x for x in cleaned if x)


def article(tags: list[tuple[str, bool, int, int]]) -> tuple[int, int] | None:
    """Texts [i, j] inside the first article element; up to the end of the page if it is not closed."""
    opens = next((i for i, t in enumerate(tags) if t[0] == "article" and not t[1]), None)
    if opens is None:
        return None
    closes = next((i for i, t in enumerate(tags) if t[0] == "article" and t[1]), len(tags))
    return opens + 1, closes


def learn(pages: list[str], rounds: int = 20) -> Weights:
    """Weights from pages that mark their article; ``_START`` where there are none.

    A token's weight starts as the logarithm of its chances inside and outside, above nought for words and
    below it for tags; then, as long as the run of a page is not its article, tags that it should have
    stopped at become heavier and those it should have passed lighter.
    """
    seen = []
    for page in pages:
        tags = tokens(page)
        span = article(tags)
        if span:
            seen.append((page, tags, span))
    weights = dict(_START)
    if not seen:
        return weights
    inside, outside = Counter(), Counter()
    for _, tags, (i, j) in seen:
        out = {k for a, b in left_out(tags) for k in range(a, b)}
        for k, (kind, *_) in enumerate(tags):
            if k not in out:
                (inside if i <= k < j else outside)[kind] += 1
    for kind in inside.keys() | outside.keys():
        if kind[0] not in "-!":
            chance = log((inside[kind] + 0.5) / (outside[kind] + 0.5))
            weights[kind] = min(-0.05, max(-30.0, -0.05 if chance > 0 else 2 * chance))
    for _ in range(rounds):
        wrong = 0
        for page, tags, (i, j) in seen:
            of_tags, of_words = scored(page, tags, weights)
            words = [k for k in range(i, j + 1) if of_words[k] > 0]
            run = best_run(of_tags, of_words)
            if not words or run is None or (run[0] == words[0] and run[1] == words[-1]):
                continue
            wrong += 1
            out = {k for a, b in left_out(tags) for k in range(a, b)}
            for k, (kind, *_) in enumerate(tags):
                if kind[0] in "-!" or k in out:
                    continue
                taken, meant = run[0] <= k < run[1], words[0] <= k < words[-1]
                if taken and not meant:
                    weights[kind] = max(-200.0, weights.get(kind, _OTHER) * 1.5 - 0.5)
                elif meant and not taken:
                    weights[kind] = min(-0.01, weights.get(kind, _OTHER) * 0.7)
        if not wrong:
            break
    return weights


def fit(pages: DataFrame, html: str = "html", key: str = "page_id") -> Weights:
    """Weights from ``SAMPLE`` labelled pages of ``LONGEST`` characters at most, chosen by a hash of their key."""
    labelled = pages.where(F.col(html).contains("<article") & (F.length(html) <= LONGEST) & F.col(key).isNotNull())
    chosen = labelled.select(F.col(key).alias("key")).distinct().orderBy(F.xxhash64("key"), "key").limit(SAMPLE)
    found = labelled.select(F.col(key).alias("key"), F.col(html).alias("html")).join(F.broadcast(chosen), "key")
    return learn([row["html"] for row in found.orderBy(F.xxhash64("key"), "key", "html").limit(SAMPLE).collect()])


def extracted(df: DataFrame, weights: Weights, html: str = "html", text: str = "text") -> DataFrame:
    """Adds the main text and n_chars, its code points, replacing columns of these names."""
    added = [text, "n_chars"]
    keep = [c for c in df.columns if c not in added or c == html]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = batch.column(keep.index(html))
            for at in range(0, batch.num_rows, 256):
                texts = [extract(x.as_py() or "", weights) for x in pages.slice(at, 256)]
                sizes = pa.array([len(x) for x in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([*batch.slice(at, 256).columns, pa.array(texts, pa.string()), sizes], names=[*keep, *added])

    old = df.select(*[f"`{c}`" for c in keep])
    return old.mapInArrow(run, ", ".join([f"`{c}` {t}" for c, t in old.dtypes] + [f"`{text}` string, n_chars long"]))
