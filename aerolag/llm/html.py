"""Main text of web pages by consensus paths of their hosts.

Every page scores the containers its text stands in. A container's path, its tags and classes with
numbers taken out, gets the page's votes in proportion to the score. Spark sums up the votes per host;
the path with most votes wins, and every page of the host is extracted again from the containers on it.
A page without such a container keeps the one it scored best itself. What stands beside a container in
the same article belongs to the text too.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolag.llm.tables import map_arrow, slices, small_side
from aerolag.storage import stage

#: Containers of at least this share of a page's best score have a vote.
VOTING_SHARE = 0.5
#: A container's text counts for the ones around it by this factor a level.
DECAY = 0.5

# Element names of HTML by what they mean here.
CONTAINERS = {"body", "main", "article", "section", "div", "td"}
BLOCKS = CONTAINERS | set(
    "html address aside blockquote caption center dd details dialog dl dt fieldset figcaption figure footer form h1 h2 h3"
    " h4 h5 h6 header hgroup hr li menu nav ol p pre summary table tbody tfoot th thead tr ul".split()
)
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "noframes", "xmp", "svg", "math"}
LEFT_OUT = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "select", "option", "head", "object", "canvas"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu", "form"}
NAMES = set(
    "ad ads adv advert adverts advertisement adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr"
    " notice notices alert popup modal overlay sidebar aside nav navbar navigation menu breadcrumb breadcrumbs pagination"
    " pager header masthead footer copyright comment comments respond disqus discussion reply replies social share sharing"
    " related recommended widget newsletter subscribe subscription signup login search toolbar".split()
)
#: Those of them that no part of an article is called. Inside one, the other names alone leave nothing out.
FOREIGN = NAMES - set(
    "notice notices alert aside menu header comment discussion reply replies social share sharing related recommended"
    " search promotion sponsor".split()
)
#: Those of them that readers' comments stand under.
COMMENTS = {"comment", "comments", "respond", "disqus", "discussion", "reply", "replies"}
#: Before a name, these say what an element around others has, not what it is.
MODIFIERS = {"has", "have", "with", "without", "no", "not", "is", "hide", "show"}
#: An element inside an article that is named for something else goes if so much of its text is links.
LINKED_SHARE = 0.5
#: Comments are left out beside an article of so many characters, or of as many as they have.
ARTICLE_CHARS = 200

_MARKUP = re.compile(
    r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)"
    r"""(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^>]*+(?:>|$))""",
    re.S,
)
# One attribute with all of its value, so that no value is taken for a name.
_ATTRIBUTE = re.compile(r"""([^\s/>=][^\s/>=]*+)(?:\s*=\s*(?:"([^"]*)(?:"|$)|'([^']*)(?:'|$)|([^\s>"'][^\s>]*)))?""")
_CLOSED_BY = {"p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
_END_OF_RAW = {tag: re.compile(rf"</{tag}\b[^>]*(?:>|$)", re.I) for tag in RAW}


def _names(classes: str, id: str) -> set[str]:
    """Names that classes or an id are, begin with or, unless a modifier goes before, end with."""
    found = set()
    for token in f"{classes} {id}".lower().split():
        parts = re.findall("[a-z]+", token)
        if parts:
            found.add(parts[0])
            if MODIFIERS.isdisjoint(parts):
                found.add(parts[-1])
    return found & NAMES


def _foreign(classes: str, id: str) -> bool:
    """Whether a class or the id says nothing but what no part of an article is."""
    for token in f"{classes} {id}".lower().split():
        parts = re.findall("[a-z]+", token)
        if parts and (parts[0] in FOREIGN if len(parts) == 1 else NAMES.issuperset(parts)):
            return True
    return False


class Page:
    """Elements of a page in order, as parallel lists, and its blocks of text with the element they stand in."""

    def __init__(self, source: str):
        self.parent, self.tag, self.path, self.named, self.foreign = [-1], [""], [""], [set()], [False]
        self.tagged_out, self.said_out = [False], [False]
        self.blocks: list[tuple[int, str, float]] = []
        self._parse(source)
        self._decide()

    def _open(self, parent: int, tag: str, attributes: str) -> int:
        found = {}
        if attributes and len(attributes) > 1:
            for name, double, single, bare in _ATTRIBUTE.findall(attributes):
                found.setdefault(name.lower(), html.unescape(double or single or bare))
        classes = sorted({re.sub("[0-9]+", "#", name.lower()) for name in found.get("class", "").split()})
        self.parent.append(parent)
        self.tag.append(tag)
        step = ".".join([tag, *classes])
        self.path.append(f"{self.path[parent]}/{step}" if tag in CONTAINERS else self.path[parent])
        self.named.append(set() if tag in ("html", "body") else _names(found.get("class", ""), found.get("id", "")))
        self.foreign.append(_foreign(found.get("class", ""), found.get("id", "")))
        self.said_out.append(found.get("role", "").lower() in ROLES or "hidden" in found)
        self.tagged_out.append(tag in LEFT_OUT or self.said_out[-1])
        return len(self.parent) - 1

    def _parse(self, source: str) -> None:
        stack = [0]
        text: list[str] = []
        in_link = linked = plain = 0

        def flush() -> None:
            nonlocal linked, plain
            block = " ".join(html.unescape("".join(text)).split())
            if block:
                self.blocks.append((stack[-1], block, linked / max(1, linked + plain)))
            text.clear()
            linked = plain = 0

        def add(part: str) -> None:
            nonlocal linked, plain
            text.append(part)
            if in_link:
                linked += len(part)
            else:
                plain += len(part)

        at = 0
        while at < len(source):
            markup = _MARKUP.search(source, at)
            if not markup:
                add(source[at:])
                break
            if markup.start() > at:
                add(source[at : markup.start()])
            at = markup.end()
            tag = markup["tag"]
            if tag is None:
                continue
            tag = tag.lower()
            if tag in RAW:
                if not markup["close"] and not markup["rest"].endswith("/>"):
                    end = _END_OF_RAW[tag].search(source, at)
                    at = end.end() if end else len(source)
            elif markup["close"]:
                if tag == "a":
                    in_link = 0
                elif tag == "p" or tag in BLOCKS or tag in LEFT_OUT:
                    for place in range(len(stack) - 1, 0, -1):
                        if self.tag[stack[place]] == tag:
                            flush()
                            del stack[place:]
                            break
            elif tag == "br":
                text.append(" ")
            elif tag == "a":
                in_link = 1
            elif tag in BLOCKS or tag in LEFT_OUT:
                flush()
                while len(stack) > 1 and tag in _CLOSED_BY.get(self.tag[stack[-1]], ()):
                    stack.pop()
                if tag not in VOID:
                    stack.append(self._open(stack[-1], tag, markup["rest"]))
        flush()

    def _decide(self) -> None:
        """Which elements are left out, with all inside: those tagged so, and those named for it.

        A named element stays if the article stands in it, or most of the page's unlinked text and no
        article beside it. One named for comments is no article, and stays only where no article of
        some length is found outside it. A page that has no article and would lose all of its text
        this way loses nothing by names. Inside an article, or the innermost container of most of the text, a name is
        a hint: see ``_belongs``. An article's own header stays if it has a heading.
        """
        size = len(self.tag)
        headed = [bool(re.fullmatch("h[1-6]", tag)) for tag in self.tag]
        for element in range(size - 1, 0, -1):
            headed[self.parent[element]] |= headed[element]
        comment = [bool(names & COMMENTS) for names in self.named]
        article = [int(tag in ("article", "main") and not own) for tag, own in zip(self.tag, comment)]
        holds = [bool(own) or tag == "h1" for own, tag in zip(article, self.tag)]
        tagged_out, inside_article, inside_comment = list(self.tagged_out), list(article), list(comment)
        around = [0] * size
        for element in range(1, size):
            above = self.parent[element]
            own_header = self.tag[element] == "header" and headed[element] and not self.said_out[element]
            if own_header and inside_article[above] and not inside_comment[above]:
                tagged_out[element] = False
            tagged_out[element] |= tagged_out[above]
            inside_article[element] |= inside_article[above]
            inside_comment[element] |= inside_comment[above]
            around[element] = around[above] + (article[above] and not inside_comment[above])
        text, within = [0.0] * size, [int(own and not hidden and not said) for own, hidden, said in zip(article, tagged_out, inside_comment)]
        outside = 0.0
        for element, block, link_share in self.blocks:
            if not tagged_out[element]:
                text[element] += len(block) * (1 - link_share)
                if inside_article[element] and not inside_comment[element] and not re.fullmatch("h[1-6]", self.tag[element]):
                    outside += len(block) * (1 - link_share)
        for element in range(size - 1, 0, -1):
            above = self.parent[element]
            text[above] += text[element]
            within[above] += within[element]
            holds[above] |= holds[element]
        belongs = self._belongs(tagged_out, inside_article, inside_comment, text, comment)
        self.out, stays = [False] * size, [False] * size
        for element in range(1, size):
            above = self.parent[element]
            most = 2 * text[element] > text[0]
            beside = within[0] - within[element] - around[element]
            if comment[element]:
                stays[element] = stays[above] or (
                    (holds[element] or most) and not beside and outside < min(ARTICLE_CHARS, text[element])
                )
                named = not stays[element] and not belongs[element]
            else:
                stays[element] = stays[above]
                named = bool(self.named[element]) and not holds[element] and not (most and not beside) and not belongs[element]
            self.out[element] = self.out[above] or tagged_out[element] or named
        if not within[0] and all(self.out[element] for element, _, _ in self.blocks):
            self.out = tagged_out

    def _belongs(self, tagged_out: list[bool], inside_article: list[int], inside_comment: list[bool], text: list[float], comment: list[bool]) -> list[bool]:
        """Named elements that are part of the article they stand in, whatever their names.

        That is all but those named for what no article holds, those whose text is mostly links, and readers'
        comments: elements named so that hold another one, or a form, or stand beside one like themselves.
        """
        size = len(self.tag)
        total, linked, nested, form = [0.0] * size, [0.0] * size, [0] * size, [False] * size
        for element, block, link_share in self.blocks:
            total[element] += len(block)
            linked[element] += len(block) * link_share
        for element in range(size - 1, 0, -1):
            above = self.parent[element]
            total[above] += total[element]
            linked[above] += linked[element]
            nested[above] += nested[element] + comment[element]
            form[above] |= form[element] or self.tag[element] in ("form", "textarea")
        # Without an article: the innermost container of most of the text that is named for nothing.
        core = 0
        if not any(tag in ("article", "main") for tag in self.tag):
            for element in range(1, size):
                plain = not self.named[element] and not tagged_out[element] and not inside_comment[element]
                if plain and self.tag[element] in CONTAINERS and 2 * text[element] > text[0]:
                    core = element
        alike: dict[tuple, int] = {}
        for element in range(1, size):
            if comment[element] and not re.fullmatch("h[1-6]", self.tag[element]):
                key = (self.parent[element], self.tag[element], frozenset(self.named[element]))
                alike[key] = alike.get(key, 0) + 1
        found, inside = [False] * size, [False] * size
        for element in range(1, size):
            above = self.parent[element]
            inside[element] = inside[above] or element == core
            if inside_comment[above] or not (inside_article[above] or inside[above]):
                continue
            key = (above, self.tag[element], frozenset(self.named[element]))
            readers = comment[element] and (nested[element] or form[element] or alike.get(key, 0) > 1 or self.tag[element] == "article")
            mostly_links = total[element] > 0 and linked[element] >= LINKED_SHARE * total[element]
            found[element] = not (self.foreign[element] or mostly_links or readers)
        return found

    def scores(self) -> dict[int, float]:
        """Score of every container with text."""
        found: dict[int, float] = {}
        for element, block, link_share in self.blocks:
            if self.out[element]:
                continue
            worth = len(block) * (1 - link_share)
            while element > 0 and worth >= 1:
                if self.tag[element] in CONTAINERS:
                    found[element] = found.get(element, 0.0) + worth * (1.25 if self.tag[element] in ("article", "main") else 1.0)
                    worth *= DECAY
                element = self.parent[element]
        return found

    def whole(self, chosen: set[int]) -> set[int]:
        """The elements that hold all of the article whose containers are ``chosen``.

        That is the article or main around a container. Where there is none, it is the outermost ancestor
        reached over steps on which the blocks that come in are not mostly links and no other article begins.
        """
        text, linked = [0.0] * len(self.tag), [0.0] * len(self.tag)
        articles = [int(tag in ("article", "main")) for tag in self.tag]
        for element, block, link_share in self.blocks:
            if not self.out[element]:
                text[element] += len(block)
                linked[element] += len(block) * link_share
        for element in range(len(self.tag) - 1, 0, -1):
            above = self.parent[element]
            if not self.out[element]:
                text[above] += text[element]
                linked[above] += linked[element]
                articles[above] += articles[element]
        found = set()
        for element in chosen:
            at = element
            while at > 0 and self.tag[at] not in ("article", "main"):
                at = self.parent[at]
            if not at:
                at = element
                while (above := self.parent[at]) > 0 and articles[above] == articles[at]:
                    if linked[above] - linked[at] > 0.5 * (text[above] - text[at]):
                        break
                    at = above
            found.add(at)
        return found

    def text_in(self, chosen: set[int]) -> str:
        """The blocks inside the chosen elements, in page order."""
        inside = [element in chosen for element in range(len(self.tag))]
        for element in range(1, len(self.tag)):
            inside[element] |= inside[self.parent[element]]
        return "\n".join(block for element, block, _ in self.blocks if inside[element] and not self.out[element])


def votes(source: str | None) -> dict[str, float]:
    """Paths of a page's containers with their share of its best score."""
    page = Page(source or "")
    scores = page.scores()
    best = max(scores.values(), default=0.0)
    found: dict[str, float] = {}
    for element, score in scores.items():
        if score >= VOTING_SHARE * best:
            found[page.path[element]] = max(found.get(page.path[element], 0.0), round(score / best, 6))
    return found


def extract(source: str | None, path: str | None) -> str:
    """Main text of a page: the whole article around the containers on ``path``, or around its own best one.

    The path counts where one of its containers has ``VOTING_SHARE`` of the page's best score; elsewhere it names
    a small box of this page, whatever it is on others.
    """
    page = Page(source or "")
    scores = page.scores()
    chosen = {element for element in scores if page.path[element] == path and page.tag[element] in CONTAINERS}
    best = max(scores.values(), default=0.0)
    if not any(scores[element] >= VOTING_SHARE * best for element in chosen):
        chosen = set()
    if not chosen and scores:
        chosen = {max(scores, key=lambda element: (scores[element], -element))}
    if not scores:
        return "\n".join(block for element, block, _ in page.blocks if not page.out[element])
    return page.text_in(page.whole(chosen))


def host_of(url: Column) -> Column:
    """Host of a URL in lower case without user and port; empty where there is none."""
    authority = F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(authority, "^.*@", ""), ":[0-9]*$", ""))


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path) that won the votes of the host's pages (host, html); of equal ones the first by name."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [
                (host, path, weight)
                for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist())
                for path, weight in votes(source).items()
            ]
            if rows:
                columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), (pa.string(), pa.string(), pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, ["host", "path", "weight"])

    cast = map_arrow(pages.select("host", "html"), vote, "host string, path string, weight double")
    # Whole millionths add up to the same in any order.
    sums = cast.groupBy("host", "path").agg(F.sum(F.round(F.col("weight") * 1e6).cast("long")).alias("votes"))
    return sums.groupBy("host").agg(F.min(F.struct(-F.col("votes"), F.col("path"))).alias("best")).select("host", F.col("best.path").alias("path"))


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page (page_id, url, html).

    A null or empty html, and a page of nothing but what is left out by its tags, has an empty text. Pages whose
    URL is null or has no host vote as one host. The winning paths are broadcast while they are small, and
    joined by host beyond that.
    """
    rows = pages.select(
        "page_id", "url", F.col("html").cast("string").alias("html"), host_of(F.col("url")).alias("host")
    )
    winners = stage(host_paths(rows), "host-paths")
    placed = rows.join(small_side(winners, "host", "path"), "host", "left").select("page_id", "url", "html", "path")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [extract(*pair) for pair in zip(batch.column("html").to_pylist(), batch.column("path").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    types = {name: rows.schema[name].dataType.simpleString() for name in ("page_id", "url")}
    return map_arrow(placed, read, f"page_id {types['page_id']}, url {types['url']}, text string, n_chars long")
