"""Main text of web pages by template deduction (operator 5).

A page becomes a sequence of tokens: its block elements (as paths of tags with
classes) and the texts between them. Over the *distinct* pages of a host (by digest, so
copies of a page count once), tokens with the same occurrence vector (the same number of times on
each page) form an equivalence class; the vectors are compared by a commutative fingerprint, so a
host's pages meet only in counts and sums. Classes that are frequent (on SUPPORT
of the host's pages, MIN_PAGES at least) and large (MIN_TOKENS) are candidates. Each page then votes on them:

* A class is ordered if its tokens come in one order in each of its occurrences on each page. Of another, the
  tokens that change places are taken out as a class of their own; where all do, it is cut into the runs that
  stay together. Pieces below MIN_TOKENS go.
* Classes nest if each one's occurrences all stand in one place (between two tokens) of the same class around them, or in none.
  Of two that overlap otherwise the weaker (fewer pages, then fewer tokens) goes, and so does one that stands in several places.

Tokens of no valid class are told apart by the innermost valid class around them and the place in it, and the classes are
found anew with these roles, until a round finds the same ones as the round before. Their texts are the host's
template. What remains in its slots is data.

The template is taken off every page. The main text is chosen among the slots
left: never texts under navigation, headers, footers, sidebars, notices, adverts, forms and
reader comments (by element, role, or a whole word of class or id; words of html, body and the elements
around the page's h1 say nothing); where the page has <article> or <main>, the one
with the h1, else those at least half as long as the longest, else (when more new text lies
outside of them, as around teaser cards) what lies outside. If the template holds all of what was chosen, it
stays: a page that others repeat is its own content.

Contract cases: NULL and empty html give the empty text; broken markup is read
as far as it goes (an unclosed element ends with its parent, a paragraph where
the next block begins, a head where the body's first element or text does); a very long page takes time
and memory in proportion to its length, and the tokens of 500 pages are held at once; pages without a host form one
group; repeated rows give a row each; equally long articles are kept in page order; a NULL page_id is a page like others; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from hashlib import blake2b
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burnlens.llm.common import materialise

MIN_PAGES, SUPPORT, MIN_TOKENS = 3, 0.5, 4

# Elements of HTML by their role in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                    "small span strike strong sub sup time tt u var wbr br img").split())
CLOSES_PARAGRAPH = frozenset(("address article aside blockquote body details dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
                              "h5 h6 header hr html li main menu nav ol p pre section table tbody td tfoot th thead tr ul").split())
RAW = frozenset("script style textarea title iframe noscript".split())  # their content isn't markup
HEAD = frozenset("base link meta noscript script style template title".split())
FOREIGN = frozenset(("svg", "math"))  # where <x/> is an empty element
ASIDE = frozenset("nav header footer aside form menu dialog button select option input label svg object template head".split()) | RAW
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
# A word of a class or id names an aside if it is one of these, with such a word before it or such words after it.
ASIDE_NAME = re.compile(
    r"(?:(?:site|page|top|main|global|cookie|left|right|primary|secondary|bottom|post|user|reader)[-_])?"
    r"(?:ads?|advert|adverts|advertisement|advertising|adbox|adslot|banner|promo|promotion|sponsor|sponsored|sidebar|widgets?|menu|navbar|nav|"
    r"navigation|breadcrumbs?|header|masthead|topbar|footer|cookies?|consent|gdpr|notices?|alert|popup|modal|newsletter|subscribe|signup|login|"
    r"comments?|commentlist|replies|reply|disqus|share|sharing|social|related|recommended|recommendations|pagination|pager)"
    r"(?:[-_](?:bar|box|banner|slot|list|links?|area|section|block|container|wrapper|wrap|widget|notice|consent|form|menu|nav|unit|posts?|items?|"
    r"thread|text|inner|content|\d+))*", re.I)

#: Longest attribute value that may hold ">"; beyond, its quote is read as a character, so that broken pages are read in linear time.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]{0,4000}+\"|'[^']{0,4000}+'|[\"'])*+)(?:>|\Z)|<[!?][^>]*(?:>|\Z)|[^<]+|<", re.S)
ATTRIBUTE = re.compile(r"(class|id|role|hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW}


def _aside(tag: str, attributes: str) -> tuple[bool, bool, str]:
    """(by element, role or hidden, by class or id, the class) of an element."""
    sure, named, classes = tag in ASIDE, False, ""
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or name == "role" and value.strip().lower() in ASIDE_ROLES:
            sure = True
        elif name in ("class", "id"):
            classes = value if name == "class" else classes
            named = named or any(ASIDE_NAME.fullmatch(w) for w in value.split())
    return sure, named and tag not in ("html", "body"), classes


class Open(NamedTuple):
    """An element that isn't closed yet."""
    tag: str
    path: str
    aside: bool             # it or an element around it, by element, role or hidden
    named: tuple[int, ...]  # elements (numbers) around a place that class or id name an aside
    area: int               # the article or main element that it is in; 0: none
    article: bool           # within an article


class Block(NamedTuple):
    """A block element (text empty) or a block of text."""
    path: str
    aside: bool
    named: tuple[int, ...]
    area: int
    tag: str
    text: str


def blocks(page: str) -> Iterator[Block]:
    """The blocks of a page, in page order."""
    stack = [Open("", "", False, (), 0, False)]
    held: list[str] = []
    skip, depth = "", 0              # an inline aside and how often its tag is open
    endless: set[str] = set()        # raw elements without a further end tag
    at, number = 0, 0

    def block(text: str = "") -> Block:
        o = stack[-1]
        return Block(o.path, o.aside, o.named, o.area, o.tag, text)

    def flush() -> Iterator[Block]:
        if held:
            if text := " ".join(unescape("".join(held)).split()):
                yield block(text)
            held.clear()

    while at < len(page):
        m = TOKEN.match(page, at)
        at = m.end()
        tag = m[2]
        if tag is None:
            if m[0] == "<" or not m[0].startswith("<"):
                if stack[-1].tag == "head" and m[0].strip():
                    stack.pop()
                if not skip:
                    held.append(m[0])
            continue
        tag, closing, attributes = tag.lower(), bool(m[1]), m[3]
        if tag in INLINE or tag in VOID and tag != "hr":
            if tag == "br":
                held.append("\n")
            elif skip == tag:
                depth += -1 if closing else 1
                skip = skip if depth else ""
            elif not skip and not closing and tag not in VOID and attributes and any(_aside(tag, attributes)[:2]):
                skip, depth = tag, 1
            continue
        skip = ""
        yield from flush()
        if closing:  # closes its element and what is open in it
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
            continue
        if stack[-1].tag == "head" and tag not in HEAD:
            stack.pop()
        if tag in CLOSES_PARAGRAPH and stack[-1].tag == "p":
            stack.pop()
        if tag in ("li", "dd", "dt", "tr", "td", "th", "option") and stack[-1].tag == tag:
            stack.pop()
        if tag in RAW and tag not in endless:
            end = RAW_END[tag].search(page, at)
            if end:
                at = end.end()
                continue
            endless.add(tag)
        if tag in VOID or tag in FOREIGN and attributes.endswith("/"):
            continue
        number += 1
        o = stack[-1]
        sure, named, classes = _aside(tag, attributes) if attributes else (tag in ASIDE, False, "")
        inner = tag == "article" and o.article  # an article in an article is a comment on it
        path = o.path if len(stack) > 200 else f"{o.path}/{tag}.{classes}" if classes else f"{o.path}/{tag}"  # deeper nesting adds nothing
        area = number if tag == "article" and not o.article or tag == "main" and not o.area else o.area
        stack.append(Open(tag, path, o.aside or sure or inner, (*o.named, number) if named else o.named, area, o.article or tag == "article"))
        yield block()
    yield from flush()


def _hash(*parts: str) -> int:
    return int.from_bytes(blake2b("\0".join(parts).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _parts(batches: Iterable[pa.RecordBatch], names: str) -> Iterator[tuple[pa.RecordBatch, list]]:
    """500 rows at a time, and the named columns of each row."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 500):
            part = batch.slice(lo, 500)
            yield part, list(zip(*(part.column(n).to_pylist() for n in names.split())))


def _batch(rows: list[tuple], **types: pa.DataType) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types.values())], names=list(types))


SEQUENCES = "host string, page long, roles array<long>, texts array<boolean>"
LONGS = pa.list_(pa.int64())
SEQUENCE_TYPES = {"host": pa.string(), "page": pa.int64(), "roles": LONGS, "texts": pa.list_(pa.bool_())}


def _sequences(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The tokens of each page in page order, their roles, and whether they are texts."""
    for _, rows in _parts(batches, "host digest html"):
        out = []
        for host, digest, html in rows:
            found = [(_hash(b.path, b.text), bool(b.text)) for b in blocks(html)]
            out.append((host, digest, [r for r, _ in found], [t for _, t in found]))
        yield _batch(out, **SEQUENCE_TYPES)


def _occurrences(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """host, role, is_text, copies on the page, its first place there, page."""
    for _, rows in _parts(batches, "host page roles texts"):
        out: list[tuple] = []
        for host, page, roles, texts in rows:
            first: dict[int, int] = {}
            for at, role in enumerate(roles):
                first.setdefault(role, at)
            copies = Counter(roles)
            out += [(host, role, texts[at], copies[role], at, page) for role, at in first.items()]
        yield _batch(out, host=pa.string(), role=pa.int64(), is_text=pa.bool_(), copies=pa.int32(), at=pa.int32(), page=pa.int64())


class Level:
    """The classes of one round: tokens in order, strongest class first."""

    def __init__(self, classes: Iterable[Iterable[int]]):
        self.classes = [tuple(c) for c in classes]
        self.place = {t: (k, i) for k, c in enumerate(self.classes) for i, t in enumerate(c)}
        self.names = [_hash(*map(str, c)) for c in self.classes]

    def refine(self, roles: list[int]) -> list[int]:
        """Tokens of no class are told apart by the innermost class that they stand in and the place between its tokens."""
        out, stack = [], []  # stack: (class, its last token met) of each occurrence that isn't complete
        for role in roles:
            found = self.place.get(role)
            if found is None:
                out.append(_hash(str(role), str(self.names[stack[-1][0]]), str(stack[-1][1])) if stack else role)
                continue
            out.append(role)
            k, i = found
            if i:
                while stack and stack.pop()[0] != k:
                    pass
            if i + 1 < len(self.classes[k]):
                stack.append((k, i))
        return out

    def votes(self, roles: list[int]) -> set[tuple[int, int, int, int]]:
        """What a page says about the classes: (class, kind, ..., ...). OUT_OF_ORDER: a token that changes places with another;
        APART: a token that the next one doesn't follow at once; CROSSED: the weaker of two classes that
        overlap without nesting; INSIDE: the class (-1: none) and the place in it that an occurrence stands in."""
        met: dict[int, list[int]] = {}
        copies: Counter = Counter()
        for role in roles:
            if found := self.place.get(role):
                k, i = found
                met.setdefault(k, []).append(copies[role] * len(self.classes[k]) + i)
                copies[role] += 1
        out: set[tuple[int, int, int, int]] = set()
        for k, keys in met.items():
            n, least = len(self.classes[k]), [*keys, len(keys)]
            for j in range(len(keys) - 1, -1, -1):
                least[j] = min(least[j], least[j + 1])
            high = -1
            moved = set()
            for j, key in enumerate(keys):
                if high > key or least[j + 1] < key:
                    moved.add(key % n)
                high = max(high, key)
            if moved:
                following = dict(zip(keys, keys[1:]))
                out |= {(k, OUT_OF_ORDER, i, 0) for i in moved}
                out |= {(k, APART, key % n, 0) for key in keys if key % n + 1 < n and following.get(key) != key + 1}
        if out:
            return out
        stack: list[tuple[int, int]] = []
        gone: set[int] = set()
        for role in roles:
            k, i = self.place.get(role, (-1, 0))
            if k < 0 or k in gone:
                continue
            if i:
                while stack[-1][0] != k:  # open, and k goes on: they cross
                    other = stack[-1][0]
                    gone.add(max(k, other))
                    if k in gone:
                        break
                    stack.pop()
                if k in gone:
                    stack = [x for x in stack if x[0] != k]
                    continue
                stack.pop()
            else:
                out.add((k, INSIDE, *(stack[-1] if stack else (-1, 0))))
            if i + 1 < len(self.classes[k]):
                stack.append((k, i))
        return {(k, CROSSED, 0, 0) for k in gone} or out


OUT_OF_ORDER, APART, CROSSED, INSIDE = range(4)
CLASSES = "array<array<struct<role:long,is_text:boolean>>>"


def judged(classes: list[list], votes: Iterable[tuple[int, int, int, int]]) -> list[list]:
    """The classes left when those that aren't ordered are broken and those that don't nest go; the same list if all are valid."""
    by_kind: dict[int, dict[int, set]] = {kind: {} for kind in range(4)}
    for k, kind, x, y in votes:
        by_kind[kind].setdefault(k, set()).add((x, y))
    if moved := by_kind[OUT_OF_ORDER]:
        out = []
        for k, tokens in enumerate(classes):
            movers = {x for x, _ in moved.get(k, ())}
            if len(movers) < len(tokens):
                pieces = [[t for i, t in enumerate(tokens) if i not in movers], [t for i, t in enumerate(tokens) if i in movers]]
            else:  # runs that stay together on every page
                cuts = sorted(x + 1 for x, _ in by_kind[APART].get(k, ()))
                pieces = [tokens[a:b] for a, b in zip([0, *cuts], [*cuts, len(tokens)])]
            out += [p for p in pieces if len(p) >= MIN_TOKENS]
        return out
    if crossed := by_kind[CROSSED]:
        return [c for k, c in enumerate(classes) if k not in crossed]
    return [c for k, c in enumerate(classes) if len(by_kind[INSIDE].get(k, ())) <= 1]


def _levels(cache: dict, host: str, column: pa.Array, k: int) -> Level:
    if host not in cache:
        cache[host] = Level([t["role"] for t in c] for c in column[k].as_py())
    return cache[host]


def _vote(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache: dict[str, Level] = {}
    for part, rows in _parts(batches, "host roles"):
        out = set()
        for n, (host, roles) in enumerate(rows):
            out |= {(host, *v) for v in _levels(cache, host, part.column("classes"), n).votes(roles)}
        yield _batch(sorted(out), host=pa.string(), k=pa.int32(), kind=pa.int32(), x=pa.int32(), y=pa.int32())


def _judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for host, classes, votes in zip(*(batch.column(n).to_pylist() for n in ("host", "classes", "votes"))):
            left = judged(classes, [(v["k"], v["kind"], v["x"], v["y"]) for v in votes])
            out.append((host, left, len(left) == len(classes) and left == classes))
        yield _batch(out, host=pa.string(), classes=batch.schema.field("classes").type, valid=pa.bool_())


def _refine(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache: dict[str, Level] = {}
    frequent: dict[str, frozenset[int]] = {}
    for part, rows in _parts(batches, "host page roles texts"):
        out = []
        for n, (host, page, roles, texts) in enumerate(rows):
            if host not in frequent:
                frequent[host] = frozenset(part.column("frequent")[n].as_py())
            kept = [(r, t) for r, t in zip(roles, texts) if r in frequent[host]]
            refined = _levels(cache, host, part.column("classes"), n).refine([r for r, _ in kept])
            out.append((host, page, refined, [t for _, t in kept]))
        yield _batch(out, **SEQUENCE_TYPES)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def _source(pages: DataFrame) -> DataFrame:
    return pages.select(host_of(F.col("url")).alias("host"), F.col("page_id").cast("long").alias("page_id"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"), F.col("url").cast("string").alias("url"))


def _frequent(sequences: DataFrame, size: DataFrame) -> DataFrame:
    """host, role, is_text, pages, v1, v2 (the occurrence vector), place (page and place of the first by page) of
    the roles on enough pages."""
    seen = sequences.mapInArrow(_occurrences, "host string, role long, is_text boolean, copies int, at int, page long")
    each = F.xxhash64("page", "copies")
    vectors = seen.groupBy("host", "role", "is_text").agg(
        F.count(F.lit(1)).alias("pages"), F.sum(each.bitwiseAND(F.lit(2**40 - 1))).alias("v1"), F.sum(F.shiftrightunsigned(each, 24)).alias("v2"),
        F.min(F.struct("page", "at")).alias("place"))
    return vectors.join(size, "host").where((F.col("pages") >= MIN_PAGES) & (F.col("pages") >= SUPPORT * F.col("of"))).drop("of")


def _candidates(frequent: DataFrame) -> DataFrame:
    """host, classes: the large ones, each in the order of the first page that holds it (one page for all tokens of a class)."""
    token = F.struct(F.col("place.at").alias("at"), "role", "is_text")
    classes = (frequent.groupBy("host", "pages", "v1", "v2").agg(F.sort_array(F.collect_list(token)).alias("tokens"))
               .where(F.size("tokens") >= MIN_TOKENS))
    strong = classes.groupBy("host").agg(F.sort_array(F.collect_list(F.struct(-F.col("pages"), -F.size("tokens"), "tokens"))).alias("found"))
    return strong.select("host", F.expr("transform(found, c -> transform(c.tokens, t -> struct(t.role AS role, t.is_text AS is_text)))")
                         .cast(CLASSES).alias("classes"))


def _valid(sequences: DataFrame, classes: DataFrame) -> DataFrame:
    """host, classes: what is left of the candidates when every page agrees on their order and nesting."""
    open_, done = materialise(classes, "classes"), []
    while True:
        votes = (sequences.select("host", "roles").join(open_, "host").mapInArrow(_vote, "host string, k int, kind int, x int, y int").distinct()
                 .groupBy("host").agg(F.collect_list(F.struct("k", "kind", "x", "y")).alias("votes")))
        after = materialise(open_.join(votes, "host").mapInArrow(_judge, f"host string, classes {CLASSES}, valid boolean"), "classes")
        done.append(after.where("valid OR size(classes) = 0").drop("valid"))
        open_ = after.where("NOT valid AND size(classes) > 0").drop("valid")
        if open_.isEmpty():
            break
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def templates(pages: DataFrame) -> DataFrame:
    """host, fixed: the roles of the texts of the host's template; levels: the valid classes of the rounds before
    the last, by which a page's tokens get their roles."""
    source = _source(pages).withColumn("digest", F.xxhash64("html", F.lit(1)))
    sequences = materialise(source.select("host", "digest", "html").mapInArrow(_sequences, SEQUENCES)
                            .dropDuplicates(["host", "page"]), "sequences")  # a page once, however often it is repeated
    size = materialise(sequences.groupBy("host").agg(F.count(F.lit(1)).alias("of")), "sizes")
    rounds: list[DataFrame] = []
    before = None
    while True:  # roles are only ever split, so the rounds end
        frequent = materialise(_frequent(sequences, size), "frequent")
        now = _valid(sequences, _candidates(frequent))
        new = now if before is None else now.join(before, ["host", "classes"], "left_anti")
        new = materialise(new, "valid")
        rounds.append(new.withColumn("round", F.lit(len(rounds))))
        going = new.where("size(classes) > 0")
        if going.isEmpty():
            break
        known = frequent.groupBy("host").agg(F.collect_list("role").alias("frequent"))
        sequences = materialise(sequences.join(going.join(known, "host"), "host").mapInArrow(_refine, SEQUENCES), "sequences")
        before = new
    every = rounds[0]
    for r in rounds[1:]:
        every = every.unionByName(r)
    plain = "transform(filter(steps, s -> s.round < size(steps) - 1), s -> transform(s.classes, c -> transform(c, t -> t.role)))"
    return (every.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("round", F.col("classes").alias("classes")))).alias("steps"))
            .select("host", F.expr("array_sort(transform(filter(flatten(element_at(steps, -1).classes), t -> t.is_text), t -> t.role))").alias("fixed"),
                    F.expr(plain).alias("levels")))


def main_text(page: str, fixed: frozenset[int], levels: Iterable[Level] = ()) -> str:
    """The texts in the content slots of a page, by two line ends; ``fixed``:
    roles of the texts of the host's template, ``levels``: how tokens get them."""
    every = list(blocks(page))
    if levels:
        roles = [_hash(b.path, b.text) for b in every]
        for level in levels:
            roles = level.refine(roles)
        fixed_here = {id(b) for b, role in zip(every, roles) if role in fixed}
    else:
        fixed_here = {id(b) for b in every if b.text and not b.aside and _hash(b.path, b.text) in fixed} if fixed else set()
    found = [b for b in every if b.text and not b.aside]
    title = next((b for b in found if b.tag == "h1"), None)
    around = set(title.named) if title else set()
    live = [b for b in found if around.issuperset(b.named)]
    fresh = [b for b in live if id(b) not in fixed_here]
    length: Counter = Counter()
    for b in live:
        if b.area:
            length[b.area] += len(b.text)
    if length:
        outside = sum(len(b.text) for b in fresh if not b.area)
        if title in live and title.area:
            areas = {title.area} | ({0} if outside > length[title.area] else set())
        else:
            longest = max(length.values())
            areas = {0} if outside > longest else {a for a, n in length.items() if 2 * n >= longest}
        live, fresh = ([b for b in x if b.area in areas] for x in (live, fresh))
    return "\n\n".join(b.text for b in fresh or live)


def _extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    template: dict[str, tuple[frozenset[int], list[Level]]] = {}
    for part, rows in _parts(batches, "host html"):
        out = []
        for n, (host, html) in enumerate(rows):
            if host not in template:
                template[host] = (frozenset(part.column("fixed")[n].as_py() or ()), [Level(c) for c in part.column("levels")[n].as_py() or ()])
            out.append(main_text(html, *template[host]))
        yield pa.RecordBatch.from_arrays(
            [part.column("page_id"), part.column("url"), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
            names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    held = materialise(templates(pages), "templates")
    return _source(pages).join(held, "host", "left").select("host", "page_id", "url", "html", "fixed", "levels").mapInArrow(
        _extract, "page_id long, url string, text string, n_chars long")
