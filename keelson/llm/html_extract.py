"""Operator 2: main text of web pages by equivalence classes nested into a template per host.

A page is a sequence of tokens: start tags and runs of text, each in the role of
its path of open elements (names, with the words of class, id and role of boxes).
Per host, the tokens whose vector of occurrences over the host's distinct pages is the same form
an equivalence class; Spark finds the classes by an order-free digest of each token's
(page, count) pairs. Classes that hold a tag and occur on half of the pages, at least
on two, are candidates.

A second reading of all pages orders and nests them. An instance of a class starts
where one of its tags comes again; its slot is the nearest open element of
another class with the last tag seen of that class. A token's place is the tag of its own class before it and its
instance's slot. Tokens whose place is the same wherever they occur are ordered
and nested; they are the host's template, and what is not in it fills its slots.

The third reading takes the slots out: a block (text between two tags that break
the line) is a value of the slot it lies in, unless all its runs stand at their places in the template.
Names only label the slots: an element that is furniture by its
name, or by the words of its class, id or role, takes all it encloses out, and if a page has
blocks under a main element (article, main, or a content container; of an article in a
larger container, those in the article alone), these are its text. Otherwise
it is every block that is a slot's value. Inside a main element template blocks are
text too, as an article may stand on many pages; so are they on a page that has no
other block.

Hosts of one page have no two vectors to compare and are read by the labels. Hot hosts
are split: classes and places come from partial aggregates per (host, token), and pages are
read one by one with the host's template, whose size is at most twice the tokens of a mean page.

Defined results: a null or empty page has an empty text; a page without
``://`` in its URL belongs to the host ``''``; unclosed elements end with their
parent; the content of a script or another raw element ends with its own end tag
(without one, with the page), whatever signs it holds; quotes delimit values only after an
equals sign; text outside the body counts as furniture only in the head; texts hidden
by attributes or styles are kept; pages of any length are read whole;
repeated pages are extracted alike, and exact copies count once in the vectors; only ``page_id``, ``url`` and ``html`` are read.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Callable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import stash

# A template token occurs on at least this share of a host's pages, and on two.
FREQUENT = 0.5
LEAST_SUPPORT = 2

# Fixed values of HTML: elements whose content is no text, void elements,
# elements that break the line, and end tags implied by a start tag.
RAW = frozenset(("script", "style", "noscript", "template", "textarea", "title", "iframe", "noembed", "noframes", "xmp"))
UNSEEN = frozenset(("script", "style", "noscript", "template"))
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
INLINE = frozenset(("a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
                    "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time",
                    "tt", "u", "var", "wbr"))
CLOSES_P = frozenset(("address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figure", "footer", "form",
                      "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"))
CLOSES_SELF = frozenset(("li", "dt", "dd", "tr", "td", "th", "option", "thead", "tbody", "tfoot"))

# Elements that are furniture by name, and words of class, id or role that say so.
FURNITURE = frozenset(("nav", "footer", "aside", "form", "head", "button", "select", "menu", "dialog", "svg", "canvas", "object",
                       "audio", "video", *RAW))
FURNITURE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar side aside rail footer header masthead topbar toolbar cookie cookies consent notice gdpr "
    "alert popup modal overlay newsletter subscribe signup login form search share sharing social related recommended "
    "recommendations comment comments disqus replies reply respond widget pager pagination skip copyright legal "
    "complementary contentinfo".split())
MAIN_WORDS = frozenset("article articlebody content main post entry story maincontent postcontent entrycontent".split())
# Words beside which a furniture word still says furniture.
NEUTRAL_WORDS = frozenset("post entry article box block list links link button buttons bar area section wrapper wrap container "
                          "inner outer top bottom left right form text title item items panel group row col module".split())
# Elements that a word of their attributes may turn into furniture, outside and inside a main element.
BOXES = frozenset(("div", "section", "ul", "ol", "dl", "table", "p", "span", "header", "li", "details", "figure", "a", "iframe", "center"))
BOXES_INSIDE = frozenset(("div", "section", "ul", "ol", "header", "details", "figure", "center"))

# One attribute, or the end of the tag: quotes count after an equals sign only.
_ATTRIBUTE = re.compile(r"""[\s/]*(?:(>)|([^\s/>][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)(?:"|$)|'([^']*)(?:'|$)|([^\s>]*)))?|$)""", re.S)
_NAME = re.compile(r"[A-Za-z][^\s/>]*")
# A tag without attributes.
_PLAIN = re.compile(r"<(/?)([A-Za-z][^\s/>]*)>")
# The end tag of a raw element; nothing else ends its content.
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|$)", re.I) for name in RAW}
_WORDS = re.compile(r"[A-Za-z]+(?=[^A-Za-z]|$)|[A-Z]?[a-z]+")
# What a site's pages repeat is worked out once: results kept by a task, and the longest tag kept.
KEPT, KEPT_TAG = 1 << 14, 200


# Words that make furniture of a box outside a main element only: inside, a header holds the headline.
HEAD_WORDS = frozenset(("header", "masthead"))


def _attribute_words(attributes: list[tuple[str, str]], inside: int) -> tuple[set[str], bool, bool]:
    """Words of class, id and role; whether they say furniture and main.

    Names are judged one by one: ``post-comments`` is furniture, while
    ``content with-sidebar`` has a name that is main alone, which wins. Inside a main
    element a name is furniture only if all its words are, or say nothing:
    ``share-buttons`` is, ``side-effects`` is not.
    """
    every, furniture, main = set(), False, False
    for name, value in attributes:
        if name in ("class", "id", "role"):
            for part in value.split():
                words = {w.lower() for w in re.split(r"[^A-Za-z]+", part) if w} | {w.lower() for w in _WORDS.findall(part)}
                every |= words
                said = words & (FURNITURE_WORDS - HEAD_WORDS if inside else FURNITURE_WORDS)
                if said and not (inside and _other_words(part)):
                    furniture = True
                else:
                    main |= bool(words & MAIN_WORDS)
    return every, furniture and not main, main


def _other_words(part: str) -> set[str]:
    """Words of a name that neither say furniture nor say nothing."""
    whole = {w.lower() for w in re.split(r"[^A-Za-z]+", part) if w}
    split = {w.lower() for w in _WORDS.findall(part)}
    left = whole - FURNITURE_WORDS - NEUTRAL_WORDS
    return left if not (split - FURNITURE_WORDS - NEUTRAL_WORDS) == set() else set()


class Main:
    """A main element: whether it is an article, and the one it lies in."""

    __slots__ = ("article", "outer")

    def __init__(self, article: bool, outer: Main | None):
        self.article, self.outer = article, outer


class Element:
    """An open element: its role's digest, the element around it and how its content is read."""

    __slots__ = ("name", "token", "parent", "furniture", "main")

    def __init__(self, name: str, token: int, parent: Element | None, furniture: bool, main: Main | None):
        self.name, self.token, self.parent, self.furniture, self.main = name, token, parent, furniture, main


class Kept(dict):
    """Results of ``work`` by its arguments, forgotten when they grow too many; they do not travel to tasks."""

    def __init__(self, work: Callable):
        self.work = work

    def __missing__(self, key: tuple):
        if len(self) >= KEPT:
            self.clear()
        value = self[key] = self.work(*key)
        return value

    def __reduce__(self):
        return Kept, (self.work,)


def _said_by(names: tuple[tuple[str, str], ...], inside: bool) -> tuple[str, bool, bool]:
    """What ``_attribute_words`` finds in class, id and role, the words sorted and joined."""
    words, furniture, main = _attribute_words(names, inside)
    return ".".join(sorted(words)), furniture, main


_said = Kept(_said_by)


def _tag(page: str, at: int) -> tuple[list[tuple[str, str]], int]:
    """Attributes of the tag whose name ends at ``at``, and the place after the tag."""
    close = page.find(">", at, at + KEPT_TAG)
    if close >= 0:
        found = _short_tag[page[at:close + 1],]
        if found is not None:
            return found, close + 1
    found, at, closed = _attributes(page, at)
    return found, at if closed else len(page)


def _short_attributes(rest: str) -> list[tuple[str, str]] | None:
    """Attributes of a tag that ends at its first ``>``; None if that lies in a quoted value."""
    found, _, closed = _attributes(rest, 0)
    return found if closed else None


_short_tag = Kept(_short_attributes)


def _attributes(page: str, at: int) -> tuple[list[tuple[str, str]], int, bool]:
    found = []
    while True:
        m = _ATTRIBUTE.match(page, at)
        at = m.end()
        if not m.group(2):
            return found, at, bool(m.group(1))
        found.append((m.group(2).lower(), html.unescape(m.group(3) or m.group(4) or m.group(5) or "")))


def pieces(page: str) -> Iterator[tuple[str, str, list[tuple[str, str]]]]:
    """(kind, value, attributes): kind ``<``, ``/`` and ``>`` for start, empty and end tags, ``t`` for text.

    Text between tags is all of the page but for markup: a ``<`` that starts
    no tag is text, and the content of a raw element is skipped up to its own end tag
    (all that follows if there is none, as browsers do).
    """
    at, size = 0, len(page)
    while at < size:
        cut = page.find("<", at)
        if cut != at:
            yield "t", html.unescape(page[at:cut if cut >= 0 else size]), []
            if cut < 0:
                return
        at = cut
        # Most tags have no attributes.
        m = _PLAIN.match(page, at)
        if m is not None:
            name, at = m.group(2).lower(), m.end()
            if m.group(1):
                yield ">", name, []
                continue
            yield "<", name, []
            if name in _RAW_END:
                close = _RAW_END[name].search(page, at)
                at = close.start() if close else size
            continue
        after = page[at + 1:at + 2]
        if page.startswith("<!--", at):
            end = page.find("-->", at + 2)
            at = size if end < 0 else end + 3
        elif page.startswith("<![CDATA[", at):
            end = page.find("]]>", at)
            yield "t", page[at + 9:size if end < 0 else end], []
            at = size if end < 0 else end + 3
        elif after in ("!", "?") or after == "/" and not page[at + 2:at + 3].isalpha():
            end = page.find(">", at)
            at = size if end < 0 else end + 1
        elif after == "/" or after.isalpha() and after.isascii():
            m = _NAME.match(page, at + (2 if after == "/" else 1))
            if m is None:
                yield "t", "<", []
                at += 1
                continue
            name = m.group(0).lower()
            attributes, end = _tag(page, m.end())
            empty = page[end - 2:end] == "/>"
            at = end
            if after == "/":
                yield ">", name, []
                continue
            yield ("/" if empty else "<"), name, attributes
            if name in _RAW_END and not empty:
                close = _RAW_END[name].search(page, at)
                at = close.start() if close else size
        else:
            yield "t", "<", []
            at += 1


def tokens(page: str) -> Iterator[tuple[str, str, Element]]:
    """(kind, value, element) of a page: kind ``<``, ``>`` for tags, ``|`` for a line break, ``t`` for text."""
    stack = [Element("", 0, None, False, None)]
    for kind, name, attributes in pieces(page):
        if kind == "t":
            yield "t", name, stack[-1]
            continue
        if kind == ">":
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == name:
                    while len(stack) > k:
                        top = stack.pop()
                        yield ">", top.name, top
                    break
            else:
                if name == "p":
                    yield "|", name, stack[-1]
            continue
        if name in CLOSES_P:
            _close(stack, ("p",), stop=("button", "td", "th", "table", "article", "section", "div", "li"))
        if name in CLOSES_SELF:
            _close(stack, (name,) if name not in ("dt", "dd") else ("dt", "dd"), stop=("ul", "ol", "dl", "table"))
        if name == "body" and len(stack) > 1 and stack[-1].name == "head":
            stack.pop()
        parent = stack[-1]
        inside = main = parent.main
        named = tuple([a for a in attributes if a[0] in ("class", "id", "role")]) if attributes else ()
        short = sum(len(value) for _, value in named) < KEPT_TAG
        words, out, said = (_said[named, inside is not None] if short else _said_by(named, inside is not None)) if named else ("", False, False)
        boxes = BOXES_INSIDE if inside else BOXES
        furniture = parent.furniture or (out and name in boxes) or name in FURNITURE or (name == "header" and not inside)
        if not furniture and (name in ("article", "main") or said and name in BOXES) and (not inside or name == "article"):
            main = Main(name == "article", inside)
        role = name + "." + words if words and name in BOXES else name
        element = Element(name, (_kept_digest["<", parent.token, role] if len(role) < KEPT_TAG else _digest("<", parent.token, role)), parent, furniture, main)
        yield ("|" if name in VOID else "<"), name, element
        if name not in VOID and not (name in RAW and kind == "/"):
            stack.append(element)


def _close(stack: list[Element], names: tuple[str, ...], stop: tuple[str, ...]) -> None:
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].name in names:
            del stack[k:]
            return
        if stack[k].name in stop:
            return


def _digest(kind: str, within: int, value: str) -> int:
    return int.from_bytes(hashlib.blake2b(f"{kind}{within}\n{value}".encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


# Of tags and places, which come again on every page; runs of text rarely do.
_kept_digest = Kept(_digest)


def _text_token(element: Element, text: str) -> int:
    return _digest("t", element.token, " ".join(text.split()))


def page_tokens(page: str) -> dict[int, list]:
    """Per token digest: [count, whether it is a tag]."""
    out: dict[int, list] = {}
    for kind, value, element in tokens(page):
        # A stray end tag breaks the line but starts no element.
        if kind in "<|" and element.name == value:
            out.setdefault(element.token, [0, True])[0] += 1
        elif kind == "t" and element.name not in RAW and not value.isspace():
            out.setdefault(_text_token(element, value), [0, False])[0] += 1
    return out


class Instance:
    """One occurrence of a class on a page: its slot, its tokens so far and the last tag of them."""

    __slots__ = ("slot", "seen", "last")

    def __init__(self, slot: int):
        self.slot, self.seen, self.last = slot, set(), 0


class Reader:
    """Places of a host's class tokens on one page, asked for in page order."""

    def __init__(self, classes: Mapping[int, int]):
        self.classes, self.open = classes, {}

    def slot(self, element: Element | None, own: int | None) -> int:
        """The nearest open element of another class than ``own``, named by that class's last tag."""
        while element is not None:
            cls = self.classes.get(element.token)
            if cls is not None and cls != own:
                return self.open[cls].last
            element = element.parent
        return 0

    def tag(self, element: Element) -> int | None:
        cls = self.classes.get(element.token)
        if cls is None:
            return None
        instance = self.open.get(cls)
        if instance is None or element.token in instance.seen:
            instance = self.open[cls] = Instance(self.slot(element.parent, cls))
        place = _place(instance)
        instance.seen.add(element.token)
        instance.last = element.token
        return place

    def text(self, token: int) -> int | None:
        """Place of a text token; None if it is before its class's first tag or twice in an instance."""
        instance = self.open.get(self.classes[token])
        if instance is None or token in instance.seen:
            return None
        instance.seen.add(token)
        return _place(instance)


def _place(instance: Instance) -> int:
    return _kept_digest["@", instance.slot, str(instance.last)]


def page_places(page: str, classes: Mapping[int, int]) -> Iterator[tuple[int, int | None]]:
    """(token, place) of every occurrence of a class token on the page."""
    reader = Reader(classes)
    for kind, value, element in tokens(page):
        if kind in "<|" and element.name == value:
            place = reader.tag(element)
            if place is not None:
                yield element.token, place
        elif kind == "t" and element.name not in RAW and not value.isspace():
            token = _text_token(element, value)
            if token in classes:
                yield token, reader.text(token)


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        row, token, count, tag = [], [], [], []
        for i, page in enumerate(batch.column("html").to_pylist()):
            for digest, (n, is_tag) in page_tokens(page or "").items():
                row.append(i)
                token.append(digest)
                count.append(n)
                tag.append(is_tag)
        row = pa.array(row, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("host").take(row), batch.column("page").take(row), pa.array(token, pa.int64()),
             pa.array(count, pa.int64()), pa.array(tag, pa.bool_())], ["host", "page", "token", "n", "tag"])


def classes_of(pages: DataFrame) -> DataFrame:
    """``host, token, cls, tag``: the candidate classes of every host.

    ``pages`` has ``host, page`` (a digest of the content, so copies of a page count once) and ``html``.
    """
    seen = pages.mapInArrow(_occurrences, "host string, page long, token long, n long, tag boolean").distinct()
    size = stash(pages.select("host", "page").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
                 .filter(F.col("pages") >= LEAST_SUPPORT), "html-hosts")
    vector = (seen.groupBy("host", "token").agg(
        F.count(F.lit(1)).alias("support"), F.max("tag").alias("tag"),
        # Sums of two hashes name the vector whatever the order of its entries.
        F.sum(F.xxhash64("page", "n").cast("decimal(38,0)")).alias("v1"),
        F.sum(F.xxhash64("n", "page").cast("decimal(38,0)")).alias("v2")))
    frequent = stash(vector.join(size, "host")
                     .filter((F.col("support") >= F.col("pages") * FREQUENT) & (F.col("support") >= LEAST_SUPPORT))
                     .select("host", "token", "tag", F.xxhash64("host", "v1", "v2").alias("cls")), "html-frequent")
    tagged = frequent.filter("tag").select("host", "cls").distinct()
    return frequent.join(tagged, ["host", "cls"], "left_semi").select("host", "token", "cls", "tag")


# Ends of the range of longs: a place that no other equals.
_NO_PLACE = (-(1 << 63), (1 << 63) - 1)


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        known: dict[str, dict[int, int]] = {}
        found: dict[tuple[str, int], tuple[int, int]] = {}
        hosts = batch.column("host").to_pylist()
        lists = batch.column("tokens"), batch.column("classes")
        for i, page in enumerate(batch.column("html").to_pylist()):
            host = hosts[i]
            if host not in known:
                known[host] = dict(zip(lists[0][i].as_py(), lists[1][i].as_py()))
            for token, place in page_places(page, known[host]):
                low, high = _NO_PLACE if place is None else (place, place)
                at = found.get((host, token))
                found[host, token] = (low, high) if at is None else (min(low, at[0]), max(high, at[1]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([h for h, _ in found], pa.string()), pa.array([t for _, t in found], pa.int64()),
             pa.array([low for low, _ in found.values()], pa.int64()), pa.array([high for _, high in found.values()], pa.int64())],
            ["host", "token", "low", "high"])


def templates(pages: DataFrame) -> DataFrame:
    """``host, token, cls, place``: the template of every host; ``place`` is null for tags that are out of order or not nested.

    Such tags stay, as the places of others were read with them; their place fits nothing.
    """
    found = stash(classes_of(pages), "html-classes")
    read = _with_template(pages, _per_host(found, "token", "cls"), "inner", "host", "html", "tokens", "classes")
    at = (read.mapInArrow(_places, "host string, token long, low long, high long").groupBy("host", "token")
          .agg(F.min("low").alias("low"), F.max("high").alias("high")))
    place = F.when(F.col("low") == F.col("high"), F.col("low"))
    return (found.join(at, ["host", "token"]).select("host", "token", "cls", "tag", place.alias("place"))
            .filter("tag or place is not null").drop("tag"))


def _per_host(found: DataFrame, *columns: str) -> DataFrame:
    """One row a host: arrays ``tokens``, ``classes`` and, if given, ``places`` in the order of tokens."""
    names = dict(zip(columns, ("tokens", "classes", "places")))
    rows = found.groupBy("host").agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("rows"))
    return stash(rows.select(F.col("host").alias("__host"), *[F.col(f"rows.{c}").alias(n) for c, n in names.items()]), "html-templates")


def _with_template(rows: DataFrame, per_host: DataFrame, how: str, *columns: str) -> DataFrame:
    return rows.join(per_host, F.col("host") == F.col("__host"), how).select(*columns)


class Block:
    """Text between two breaks of the line: its slot, its labels and whether all of it is template."""

    __slots__ = ("slot", "main", "furniture", "fixed", "parts")

    def __init__(self, slot: int, main: Main | None, furniture: bool):
        self.slot, self.main, self.furniture, self.fixed, self.parts = slot, main, furniture, True, []

    @property
    def text(self) -> str:
        return " ".join("".join(self.parts).split())


def page_blocks(page: str, template: Mapping[int, tuple[int, int | None]]) -> list[Block]:
    """Blocks of a page in its order, read with the template ``{token: (class, place)}`` of its host."""
    reader = Reader({token: cls for token, (cls, _) in template.items()})
    blocks: list[Block] = []
    # The open block of text and of furniture: furniture amid a line does not break it.
    current: dict[bool, Block] = {}
    for kind, value, element in tokens(page):
        if kind in "<>|":
            if template and kind in "<|" and element.name == value:
                reader.tag(element)
            if kind == "|" and value != "wbr" or value not in INLINE and value not in UNSEEN:
                current = {}
            continue
        if element.name in RAW:
            continue
        block = current.get(element.furniture)
        if block is None:
            block = current[element.furniture] = Block(reader.slot(element, None) if template else 0, element.main, element.furniture)
            blocks.append(block)
        block.parts.append(value)
        if template and block.fixed and not value.isspace():
            token = _text_token(element, value)
            block.fixed = token in template and template[token][1] is not None and reader.text(token) == template[token][1]
        elif not template:
            block.fixed = False
    return [b for b in blocks if b.text]


def main_text(page: str, template: Mapping[int, tuple[int, int | None]]) -> str:
    """Text of the slots that are not furniture, blocks joined by one blank."""
    blocks = [b for b in page_blocks(page, template or {}) if not b.furniture]
    main = [b for b in blocks if b.main]
    # What lies in an article is the text, not what is around it in a larger container.
    around = set()
    for block in main:
        outer = block.main.outer if block.main.article else None
        while outer:
            if not outer.article:
                around.add(outer)
            outer = outer.outer
    kept = [b for b in main if b.main not in around] or [b for b in blocks if not b.fixed] or blocks
    return " ".join(b.text for b in kept)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        known: dict[str, dict[int, tuple[int, int | None]]] = {}
        texts = []
        lists = [batch.column(name) for name in ("tokens", "classes", "places")]
        hosts = batch.column("host").to_pylist()
        for i, page in enumerate(batch.column("html").to_pylist()):
            if hosts[i] not in known:
                token, cls, place = (column[i].as_py() or () for column in lists)
                known[hosts[i]] = dict(zip(token, zip(cls, place)))
            texts.append(main_text(page or "", known[hosts[i]]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def host_of():
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.substring(F.col("url"), at + 3, F.length("url"))).otherwise(F.lit(""))
    return F.coalesce(F.lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.lit(""))


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    rows = pages.select("page_id", "url", "html", host_of().alias("host"))
    found = templates(rows.filter("html is not null").select("host", F.xxhash64("html").alias("page"), "html"))
    joined = _with_template(rows, _per_host(found, "token", "cls", "place"), "left",
                            "page_id", "url", "html", "host", "tokens", "classes", "places")
    id_type = pages.schema["page_id"].dataType.simpleString()
    return joined.mapInArrow(
        _extract, f"page_id {id_type}, url string, text string, n_chars long")
