"""HTML extraction by equivalence classes of template tokens.

A page is a sequence of tokens: elements, told apart by the path of their open elements, and texts, told apart by path
and content. A token's occurrence vector says how often it stands in each page of a host. Tokens with equal vectors
form an equivalence class. A vector isn't kept but summed up: the pages that hold the token, its occurrences, and the
sum over pages of a hash of (page, occurrences). Equal vectors have equal sums, and sums of partial sums come from any
split of the pages, so a host with very many pages is no hot group.

A class is a candidate if it has at least LEAST_TOKENS tokens that stand in at least SUPPORT of the host's pages; pages without
any token, as empty ones, don't count. A token that no other shares its pages with is none, however often it stands. A second pass
over the pages tests the candidates: on a page, a class whose tokens stand k times each has to be k runs of its tokens in one order,
and every run has to lie whole in one gap between two tokens of the run around it. A class is valid if on AGREED of its
pages these hold with the same order and the same gap; others are dropped. The valid classes, nested in each other's
gaps, are the template.

What is left between the tokens of the template is the slots' text. A slot is boilerplate if its path passes through
an element that is made for it (navigation, footers, forms and the like, or an element with a class name of such a meaning), or
if most of the text stands in links: outside of article and main elements in what has its path in its gap, then in its class of
repeated elements, then in its frame. Within an article or main element nearly all of it has to. A class name outside of an article has no say about the article. The text of the remaining slots,
block by block, is the page's main text.

On a host with fewer than LEAST_PAGES pages nothing can be deduced from copies of texts; there the paths alone decide, and only the
text in article and main elements is taken if the page has any.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Collection, Iterable, Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adsettle.llm.base import bytes_of, join_by_frequency, query, table, with_text_columns
from adsettle.session import stage

LEAST_PAGES = 4
#: Tokens of a class, and share of a host's pages that they stand in, at least.
LEAST_TOKENS, SUPPORT = 2, 0.75
#: Share of the pages of a class that have to agree on its order and its gap.
AGREED = 0.9
#: Share of a slot's characters in links from which it is a menu, outside and inside of article and main elements.
LINKED, LINKED_CONTENT = 0.6, 0.9

# Elements by what they do.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe noembed noframes svg object canvas".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var nobr".split()
)
BOILERPLATE = set(
    "head title nav footer aside form button select textarea dialog menu fieldset datalist".split()
)
CLOSED_BY = {
    "p": set(
        "address article aside blockquote center details dialog div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 "
        "header hr main menu nav ol p pre section table ul".split()
    ),
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option", "optgroup"},
    "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"},
    "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"}, "head": {"body"},
}
#: Words of class, id and role names that mark boilerplate, and words that may stand beside one. A name is a mark if it is
#: made of these alone, the former at least once: site-header is one, entry-header, no-sidebar and social-history aren't.
MARKS = set(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright "
    "disqus footer header masthead menu nav navbar navigation newsletter notice notices pager pagination popup promo "
    "promoted promotion related replies reply respond share sharing sidebar social sponsor sponsored subscribe toolbar "
    "widget widgets".split()
)
BESIDE = set(
    "site global top bottom left right primary secondary box bar list block section container wrapper wrap inner area "
    "buttons links icons form thread".split()
)
CONTENT = {"article", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
NAMES = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")
SPACE = re.compile(r"[ \t\n\r\f\v   -     　]+")


@dataclass(slots=True)
class Slot:
    """One block of text of a page."""

    path: int
    at: int  # how many tokens stand before it
    bad: bool  # within an element made for boilerplate
    content: bool  # within an article or main element
    text: str
    linked: int  # characters of it in links


def names_of(attributes: str) -> list[list[str]]:
    """The names of class, id and role, each as its lower-case words."""
    names = (name for m in NAMES.finditer(attributes) for name in m[2].strip("\"'").split())
    return [[w.lower() for w in WORD.findall(name)] for name in names]


def is_mark(words: list[str]) -> bool:
    return not MARKS.isdisjoint(words) and all(w in MARKS or w in BESIDE for w in words)


@dataclass(slots=True)
class Page:
    """A page's blocks of text, its tokens in order, and the path around each path."""

    slots: list[Slot]
    tokens: list[int]
    parents: dict[int, int]


def blocks(html: str) -> Page:
    """The page's blocks of text and its tokens, in order.

    Inline elements belong to the block around them; a block ends where another element begins or ends. Elements left
    open are closed as far as the next end tag of an outer one. Raw elements and comments hold no text. A path is known by a
    hash of the path around it and its own element, so memory is linear however deep elements lie.
    """
    slots: list[Slot] = []
    tokens: list[int] = []
    parents: dict[int, int] = {}
    # name, path, within an element made for boilerplate, within one so marked, within article or main
    stack: list[tuple[str, int, bool, bool, bool]] = [("", 0, False, False, False)]
    parts: list[str] = []
    links = linked = 0
    at = 0

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = SPACE.sub(" ", unescape("".join(parts))).strip()
            if text:
                _, path, made, marked, content = stack[-1]
                slots.append(Slot(path, len(tokens), made or marked, content, text, linked))
                tokens.append(text_token(path, text))
            parts, linked = [], 0

    def open_element(name: str, attributes: str) -> None:
        while True:
            top = stack[-1][0]
            if name in CLOSED_BY.get(top, ()):
                stack.pop()
                continue
            # an element inside a paragraph's heading or the like is closed with it
            if top in HEADINGS and name in CLOSED_BY["p"]:
                stack.pop()
                continue
            break
        _, around, made, marked, content = stack[-1]
        own = names_of(attributes) if attributes else []
        path = path_token(around, name + "".join(sorted({f".{w}" for words in own for w in words})))
        parents[path] = around
        made = made or name in BOILERPLATE or (name == "header" and not content)
        if name in CONTENT and not content:
            marked = False
        elif name not in ("html", "body"):
            marked = marked or any(map(is_mark, own))
        stack.append((name, path, made, marked, content or name in CONTENT))
        tokens.append(path)

    position, find = 0, TOKEN.search
    size = len(html)
    while position < size:
        at = html.find("<", position)
        found = TOKEN.match(html, at) if at >= 0 else None
        if at < 0:
            parts.append(html[position:])
            break
        if not found:  # a bare less-than sign
            parts.append(html[position : at + 1])
            linked += (at + 1 - position) if links else 0
            position = at + 1
            continue
        if at > position:
            parts.append(html[position:at])
            if links:
                linked += at - position
        position = found.end()
        name = (found[2] or found[5] or "").lower()
        if not name:
            continue
        closing = found[1] or found[4]
        if name in RAW or name == "title":
            if not closing and not (found[3] or found[6] or "").endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(html, position)
                position = end.end() if end else size
            continue
        if name in INLINE:
            if name == "a":
                links = max(0, links - 1) if closing else links + 1
            continue
        if name == "br":
            parts.append(" ")
            continue
        flush()
        if name in VOID:
            continue
        if not closing:
            open_element(name, found[3] or found[6] or "")
            links = 0
        else:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == name:
                    del stack[depth:]
                    break
            links = 0
    flush()
    return Page(slots, tokens, parents)


def host_of(url):
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def path_token(around: int, label: str) -> int:
    return signed(xxhash.xxh64_intdigest(label, around & (1 << 64) - 1))


def text_token(path: int, text: str) -> int:
    return signed(xxhash.xxh64_intdigest(text, (path ^ 0x5BD1E995) & (1 << 64) - 1))


def token_vectors(pages: DataFrame) -> DataFrame:
    """(host, token, n_pages, total, vector) per host and token, summed in each task before the shuffle.

    Token 0 stands for the page itself; its n_pages are the host's pages that have tokens, its total is all of them.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict[tuple, list[int]] = {}
            for host, page, html in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), bytes_of(batch.column(2))
            ):
                counts = Counter(blocks((html or b"").decode()).tokens)
                own = sums.setdefault((host, 0), [0, 0, 0])
                own[0] += bool(counts)
                own[1] += 1
                weights: dict[int, int] = {}
                for token, n in counts.items():
                    if n not in weights:
                        weights[n] = xxhash.xxh64_intdigest(f"{page}:{n}") >> 16
                    own = sums.setdefault((host, token), [0, 0, 0])
                    own[0] += 1
                    own[1] += n
                    own[2] += weights[n]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([h for h, _ in sums], pa.string()),
                    pa.array([t for _, t in sums], pa.int64()),
                    *[pa.array([signed(v[i] & (1 << 64) - 1) for v in sums.values()], pa.int64()) for i in range(3)],
                ],
                names=["host", "token", "n_pages", "total", "vector"],
            )

    found = pages.select("host", "page", "html").mapInArrow(
        run, "host string, token long, n_pages long, total long, vector long"
    )
    # sums of 48-bit numbers stay within a decimal of 38 digits whatever the number of pages
    return found.groupBy("host", "token").agg(
        F.sum("n_pages").alias("n_pages"), F.sum("total").alias("total"),
        F.sum(F.col("vector").cast("decimal(38,0)")).alias("vector"),
    )


CLASS = "struct<once: boolean, tokens: array<long>>"


def candidate_classes(pages: DataFrame) -> DataFrame:
    """host, n (rows), n_pages (pages with tokens) and classes: of each candidate, whether its tokens stand once in a page,
    and the tokens.

    Classes are groups of equal (n_pages, total, vector) in at least SUPPORT of the pages, so a host can't have more of
    their tokens than its pages have on average, divided by SUPPORT.
    """
    least = SUPPORT * LEAST_PAGES  # what stands in fewer pages is valid on no host
    own = F.col("token") == 0
    vectors = stage(token_vectors(pages).filter(own | (F.col("n_pages") >= least)), "vectors")
    hosts = vectors.groupBy(F.col("host").alias("of")).agg(
        F.count("*").alias("n_tokens"),
        F.max(F.when(own, F.col("total"))).alias("n"),
        F.max(F.when(own, F.col("n_pages"))).alias("of_pages"),
    )
    hosts = stage(hosts, "hosts")
    tokens = vectors.filter(~own)
    of = hosts.select("of", "n_tokens", "of_pages")
    both = join_by_frequency(tokens, of, F.col("host"), "of", "n_tokens", vectors.count(), F.col("token"))
    share = SUPPORT * F.col("of_pages")
    classes = (
        both.filter((F.col("of_pages") >= LEAST_PAGES) & (F.col("n_pages") >= share))
        .groupBy("host", "n_pages", "total", "vector")
        .agg(F.sort_array(F.collect_list("token")).alias("tokens"))
        .filter(F.size("tokens") >= LEAST_TOKENS)
    )
    listed = F.sort_array(F.collect_list(F.struct((F.col("total") == F.col("n_pages")).alias("once"), "tokens")))
    named = hosts.select(F.col("of").alias("host"), "n", F.col("of_pages").alias("n_pages"))
    return named.join(classes.groupBy("host").agg(listed.alias("classes")), "host", "left")


def walk(tokens: list[int], of: dict[int, int], sizes: list[int]) -> tuple[dict[int, list], list[tuple[int, int]]]:
    """One page through classes (``of``: a token's class, ``sizes``: the tokens of each): of every class on the page, its
    order and its gaps, and of every token the gap that it stands in.

    A class's tokens make runs: the first one opens a run, and once all have come it is complete. While a run is open, each of
    its tokens closes a gap; runs of other classes that lie in the gap have to be complete by then. A run that isn't, or that meets
    one of its own tokens twice, is broken, and so is its class (its order is None). A gap is (class, tokens of the run so far),
    (-1, 0) outside of all.
    """
    found: dict[int, list] = {}
    open_: list[tuple[int, list[int]]] = []  # class and tokens so far
    opened: dict[int, int] = {}  # class: place in open_
    gaps: list[tuple[int, int]] = []

    def gap() -> tuple[int, int]:
        return (open_[-1][0], len(open_[-1][1])) if open_ else (-1, 0)

    def close(complete: bool) -> None:
        number, run = open_.pop()
        del opened[number]
        known = found[number]
        if not complete or (known[0] not in ("", tuple(run))):
            known[0] = None
        elif known[0] == "":
            known[0] = tuple(run)

    for token in tokens:
        number = of.get(token)
        if number is None:
            gaps.append(gap())
            continue
        if number in opened:
            while open_[-1][0] != number:
                close(False)
            run = open_[-1][1]
            if token in run:
                close(False)
        if number not in opened:
            known = found.setdefault(number, ["", set()])
            known[1].add(gap())
            opened[number] = len(open_)
            open_.append((number, []))
        gaps.append(gap())
        open_[-1][1].append(token)
        if len(open_[-1][1]) == sizes[number]:
            close(True)
    while open_:
        close(False)
    return found, gaps


def numbered(classes: list[dict] | None) -> tuple[dict[int, int], list[int]]:
    """The class of each token and the size of each class."""
    of = {token: i for i, c in enumerate(classes or ()) for token in c["tokens"]}
    return of, [len(c["tokens"]) for c in classes or ()]


def verdicts(pages: DataFrame) -> DataFrame:
    """(host, class, agreed): of the classes joined to every page, a number that stands for their order and gap on a page,
    0 for broken ones; counted in each task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[dict[int, int], list[int]]] = {}
        for batch in batches:
            counts: Counter = Counter()
            hosts, classes = batch.column(0).to_pylist(), batch.column(1)
            for i, html in enumerate(bytes_of(batch.column(2))):
                host = hosts[i]
                if host not in known:
                    if len(known) > 10_000:
                        known.clear()
                    known[host] = numbered(classes[i].as_py())
                if not known[host][1]:
                    continue
                found, _ = walk(blocks((html or b"").decode()).tokens, *known[host])
                for number, (order, gaps) in found.items():
                    # a gap's class is named by its own number, which is the same on all pages
                    said = 0 if order is None or len(gaps) > 1 else signed(xxhash.xxh64_intdigest(repr((order, gaps))) | 1)
                    counts[host, number, said] += 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.int32()),
                    pa.array([k[2] for k in counts], pa.int64()), pa.array(list(counts.values()), pa.int64()),
                ],
                names=["host", "class", "said", "pages"],
            )

    found = pages.select("host", "classes", "html").mapInArrow(run, "host string, class int, said long, pages long")
    per_sign = found.groupBy("host", "class", "said").agg(F.sum("pages").alias("pages"))
    return per_sign.groupBy("host", "class").agg(
        (F.max(F.when(F.col("said") != 0, F.col("pages"))) >= AGREED * F.sum("pages")).alias("agreed")
    )


def host_templates(pages: DataFrame) -> DataFrame:
    """host, n (rows), n_pages (pages with tokens), and the valid classes."""
    candidates = stage(candidate_classes(pages), "classes")
    total = pages.count()
    of = candidates.filter(F.size("classes") > 0).select(F.col("host").alias("of_host"), "n", "classes")
    joined = join_by_frequency(pages.select("host", "page", "html"), of, F.col("host"), "of_host", "n", total, F.col("page"))
    agreed = stage(verdicts(joined.filter(F.col("classes").isNotNull())).filter("agreed"), "agreed")
    held = agreed.groupBy("host").agg(F.collect_set("class").alias("held"))
    valid = F.filter("classes", lambda c, i: F.array_contains("held", i))
    return candidates.join(held, "host", "left").select(
        "host", "n", "n_pages", F.coalesce(valid, F.array().cast(f"array<{CLASS}>")).alias("classes")
    )


class Frames:
    """Of a page's paths, the innermost one around each that some tokens hold."""

    def __init__(self, parents: dict[int, int], tokens: Collection[int]):
        self.parents, self.known = parents, {0: 0}
        self.tokens = tokens

    def around(self, path: int) -> int:
        way = []
        while path not in self.known and path not in self.tokens:
            way.append(path)
            path = self.parents[path]
        found = self.known.get(path, path)
        for p in way:
            self.known[p] = found
        return found


def main_text(html: str, n_pages: int | None, classes: Collection[dict] = ()) -> str:
    """The text of the page's content slots. ``classes``: the host's valid ones, as dicts of once and tokens.

    Texts of the classes are the template's own; where nothing else is left, as on copies, they stay. Links are weighed
    by path in a gap, then by class of repeated elements, then by frame, each time in what is left.
    """
    page = blocks(html)
    left = [s for s in page.slots if not s.bad]
    if (n_pages or 0) < LEAST_PAGES:
        if any(s.content for s in left):
            return "\n\n".join(s.text for s in left if s.content)
        return "\n\n".join(s.text for s in without_menus(left, lambda s: s.path))
    of, sizes = numbered(list(classes))
    _, gaps = walk(page.tokens, of, sizes)
    once = Frames(page.parents, {t for c in classes if c["once"] for t in c["tokens"]})
    every = Frames(page.parents, of)
    # an article may have lists of links of its own, so there its gaps aren't asked
    places = [
        lambda s: None if s.content else (gaps[s.at], s.path),
        lambda s: every.around(s.path),
        lambda s: once.around(s.path),
    ]

    def without_all_menus(slots: list[Slot]) -> list[Slot]:
        for place in places:
            slots = without_menus(slots, place)
        return slots

    kept = without_all_menus([s for s in left if page.tokens[s.at] not in of]) or without_all_menus(left)
    return "\n\n".join(s.text for s in kept)


def without_menus(slots: list[Slot], place_of: Callable[[Slot], object]) -> list[Slot]:
    """The blocks that lie in no place whose text stands mostly in links; a place of None is none."""
    linked: Counter = Counter()
    length: Counter = Counter()
    for s in slots:
        linked[place_of(s)] += s.linked
        length[place_of(s)] += len(s.text)

    def menu(s: Slot) -> bool:
        place = place_of(s)
        return place is not None and linked[place] >= (LINKED_CONTENT if s.content else LINKED) * length[place]

    return [s for s in slots if not menu(s)]


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of (page_id, url, html).

    A null or empty html has an empty text. Pages without a host in their address, or without address, count as one
    host of unknown name, from which no template is deduced. Repeated rows count as pages of their own.
    """
    named = pages.select("page_id", "url", "html").withColumn("host", F.coalesce(host_of("url"), F.lit("")))
    keyed = named.withColumn("page", F.xxhash64("page_id", "url"))
    found = stage(host_templates(keyed.filter("host != ''")), "templates")
    total = named.count()
    both = join_by_frequency(
        named, found.withColumnRenamed("host", "of_host"), F.col("host"), "of_host", "n", total, F.col("page_id")
    )
    names = ["page_id", "url"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[dict]] = {}
        for batch in batches:
            hosts, sizes, classes = (batch.column(c) for c in ("host", "n_pages", "classes"))
            texts = []
            for i, html in enumerate(bytes_of(batch.column("html"))):
                host = hosts[i].as_py()
                if host not in known:
                    if len(known) > 10_000:
                        known.clear()
                    known[host] = classes[i].as_py() or []
                texts.append(main_text(html.decode(), sizes[i].as_py(), known[host]) if html else "")
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], pa.array(texts, pa.string())], names=[*names, "text"]
            )

    out = both.mapInArrow(run, "page_id long, url string, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))


@query()
def op2_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(table(spark, sf_dir, "pages"))
