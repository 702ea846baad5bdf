"""Main text of web pages by templates deduced from equivalence classes of tokens (operator 11).

1. Every page is read into tokens: opening tags, closing tags and stretches of text, each told apart by the path of the elements
   around it. A token's occurrence vector says how often it occurs in each page of a host; all that is kept of it are sums of
   hashes of (page, count), so vectors are made by ordinary grouping and no page meets another in one task.
2. Tokens of a host with equal vectors form a class. A class is valid if it has `LARGE` tokens and occurs in `SUPPORT` of the pages
   (two at least); an element is part of the template if its opening and closing tag are in one valid class, so that
   both occur in the same pages and equally often. By their paths the valid classes nest into the host's template; what the template
   doesn't fix are its slots. Stretches of text that a valid class holds once a page, in most pages, belong to the template too.
3. Of the slots those are the article whose path leads through an article (or else a main) element. In a host without such
   elements it is the innermost template element that holds most of the text in slots. Slots below menus, headers, footers,
   sidebars, notices, adverts, forms, comments and the like, by tag, role or name, are never part of it.
4. Pages meet their host's template: templates of large hosts are broadcast, the others joined by shuffle. The text of the article's
   slots is read out, with character references decoded and white space folded. A page that lacks the template's article, or has no
   host, is a template of its own.

A template holds at most tokens-per-page / SUPPORT entries, so it fits one row whatever the size of a host.

Within an article or main element nothing is dropped for being the same on many pages: passages may repeat. Only where the article
was found by mass, texts that belong to the template are dropped.

Edge cases: a null or empty html gives an empty text; a null url, or one without a host, gives a page of its own; repeated rows are
pages each (their vectors agree); elements nested deeper than `DEPTH` share their parent's path; very long pages are read in one
pass, linear in their length; ties between elements go to the first path; an empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orestrata.llm.shared import cut, hot_join

SUPPORT = 0.05
CONSTANT = 0.5
LARGE = 3
MASS = 0.7
DEPTH = 64
LABEL = 80

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|textarea|title|noscript|template|iframe|xmp|svg)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<more>(?:[^>\"'<]|\"[^\"<]*\"|'[^'<]*')*+>|[^>]*>)"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|<[a-zA-Z][^>]*\Z",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr img".split()
)
# What an opening tag closes, up to the nearest element that holds such parts.
_CLOSES = {
    **dict.fromkeys(
        "address article aside blockquote center details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu "
        "nav ol p pre section table ul".split(),
        ({"p"}, {"button", "td", "th", "li", "body", "article", "div", "section"}),
    ),
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
_NEVER = frozenset("head nav aside footer form button select datalist dialog menu object audio video canvas fieldset".split())
_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())
_NAMES = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs footer sidebar aside widget ad ads advert adverts advertisement advertising "
    "sponsor sponsored promo banner cookie cookies consent gdpr notice notification alert newsletter subscribe subscription signup "
    "popup modal overlay share sharing social related recommended comment comments reply replies disqus respond login search "
    "pagination pager copyright skip toolbar form".split()
)
_OUTSIDE = frozenset("header masthead".split())


class Element:
    __slots__ = ("name", "path", "inline", "dropped", "outer")

    def __init__(self, name: str, path: str, inline: bool, dropped: bool, outer: bool) -> None:
        self.name, self.path, self.inline, self.dropped, self.outer = name, path, inline, dropped, outer


def _element(name: str, more: str, above: Element | None) -> Element:
    """`dropped`: no article; `outer`: none either unless it is inside of one."""
    names, role = [], ""
    for key, *values in _ATTRIBUTE.findall(more) if "=" in more else ():
        value = "".join(values)
        if key.lower() in ("class", "id"):
            names += value.split()
        else:
            role = value.strip().lower()
    parts = {p.lower() for n in names for p in _PARTS.findall(n)}
    label = ".".join([name, *sorted({re.sub(r"\d+", "0", n) for n in names}), *([f"@{role}"] if role else [])])[:LABEL]
    label = label.replace(">", "").replace(" ", "")
    return Element(
        name,
        f"{above.path}>{label}" if above else label,
        name in _INLINE,
        name in _NEVER or role in _ROLES or not parts.isdisjoint(_NAMES) or (above is not None and above.dropped),
        name in _OUTSIDE or not parts.isdisjoint(_OUTSIDE) or (above is not None and above.outer),
    )


def events(page: str) -> Iterator[tuple[str, Element | None, str]]:
    """(kind, element, text) in page order: "s" an element opens, "e" it closes, "t" text in it, " " a break without one.

    Bare inline tags don't open elements, so that one that is never closed changes nothing.
    """
    stack: list[Element] = []
    at = 0
    for found in _TOKEN.finditer(page):
        if found.start() > at:
            yield "t", stack[-1] if stack else None, page[at : found.start()]
        at = found.end()
        name = found["name"]
        if name is None:
            continue
        name = name.lower()
        if found["close"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].name == name:
                    yield "e", stack[k], ""
                    del stack[k:]
                    break
            else:
                if name not in _INLINE:
                    yield " ", None, ""
            continue
        if name in _VOID:
            if name not in _INLINE:
                yield " ", None, ""
            continue
        if name in _CLOSES:
            closed, held = _CLOSES[name]
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].name in closed:
                    del stack[k:]
                    break
                if stack[k].name in held:
                    break
        above = stack[-1] if stack else None
        element = _element(name, found["more"], above)
        if element.inline and element.path.endswith(f">{name}") and not element.dropped:
            continue
        if len(stack) >= DEPTH:
            element.path = above.path
        stack.append(element)
        yield "s", element, ""
    if at < len(page):
        yield "t", stack[-1] if stack else None, page[at:]


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text)


def tokens(page: str) -> tuple[Counter, dict]:
    """How often each token (kind, path, text's hash) occurs in a page, and the characters of its texts."""
    counts, chars = Counter(), {}
    for kind, element, text in events(page):
        if kind == " " or element is None:
            continue
        key = (kind, element.path, 0)
        if kind == "t":
            text = " ".join(text.split())
            if not text:
                continue
            key = (kind, element.path, _hash(text))
            chars[key] = 0 if element.dropped or element.outer else len(text)
        counts[key] += 1
    return counts, chars


class Template:
    """Paths of the article, whether elements mark it, and texts that belong to the template."""

    def __init__(self, main: set[str], marked: bool, fixed: set[tuple[str, int]]) -> None:
        self.main, self.marked, self.fixed = main, marked, fixed


def _tag(path: str) -> str:
    return path.rpartition(">")[2].partition(".")[0]


def _topmost(paths: set[str]) -> set[str]:
    return {p for p in paths if not any(p.startswith(q + ">") for q in paths)}


def deduced(rows: list[tuple[str, str, int, int, tuple, int]], pages: int, large: int = LARGE) -> Template:
    """The template of a host from its frequent tokens: kind, path, text's hash, pages, vector, characters.

    Kind "x" stands for all rare texts of a path. The characters of what can't be part of an article are 0.
    """
    classes = Counter(vector for kind, *_, vector, _ in rows if kind != "x")
    vectors = defaultdict(dict)
    for kind, path, _, _, vector, _ in rows:
        if kind in "se":
            vectors[path][kind] = vector
    valid = {p for p, v in vectors.items() if len(v) == 2 and v["s"] == v["e"] and classes[v["s"]] >= large}
    fixed, open_chars = set(), Counter()
    for kind, path, text, held, vector, chars in rows:
        if kind == "t" and pages > 1 and held >= CONSTANT * pages and classes[vector] >= large and path in valid:
            fixed.add((path, text))
        elif kind in "tx":
            open_chars[path] += chars
    mass = Counter()
    for path, chars in open_chars.items():
        names = path.split(">")
        for k in range(1, len(names) + 1):
            mass[">".join(names[:k])] += chars
    for wanted in (lambda p: _tag(p) == "article", lambda p: _tag(p) == "main" or p.endswith("@main") or p.endswith("@articlebody")):
        main = _topmost({p for p in valid if wanted(p) and mass[p] > 0})
        if main:
            return Template(main, True, fixed)
    total = max((mass[p] for p in valid), default=0)
    heavy = [p for p in valid if mass[p] > 0 and mass[p] >= MASS * total]
    return Template({min(heavy, key=lambda p: (-p.count(">"), p))} if heavy else set(), False, fixed)


def alone(page: str) -> Template:
    """A page as a template of its own: every element that is closed is part of it."""
    counts, chars = tokens(page)
    rows = [("s", path, 0, 1, (path,), 0) for kind, path, _ in counts if kind == "s"]
    rows += [("e", path, 0, 1, (path,), 0) for _, path, *_ in rows]
    rows += [("x", path, 0, 1, (), chars[kind, path, text]) for kind, path, text in counts if kind == "t"]
    made = deduced(rows, 1, large=2)
    return made if made.main else Template({""}, True, set())


def main_text(page: str, template: Template | None) -> str | None:
    """The text of the template's article; None if the page has none of its elements. The path "" is the whole page."""
    blocks, block = [], []
    inside: list[Element] = []
    seen = whole = "" in template.main

    def end() -> None:
        if block:
            blocks.extend("".join(block).split())
            block.clear()

    for kind, element, text in events(page):
        if kind == "t":
            if not (whole or inside) or (element is not None and element.dropped):
                continue
            if inside and not (element is not None and element.path.startswith(inside[-1].path)):
                continue
            if element is not None and element.outer and (whole or not template.marked):
                continue
            if not template.marked and element and (element.path, _hash(" ".join(text.split()))) in template.fixed:
                continue
            block.append(html.unescape(text))
            continue
        if kind == " " or not element.inline:
            end()
        if kind == "s":
            # An element that was left open ends with the one that holds it.
            while inside and not element.path.startswith(inside[-1].path + ">"):
                inside.pop()
            if not whole and not inside and element.path in template.main and not element.dropped:
                inside.append(element)
                seen = True
        elif kind == "e":
            while inside and (element is inside[-1] or not element.path.startswith(inside[-1].path)):
                inside.pop()
    end()
    return " ".join(blocks) if seen else None


def host_of(url: Column) -> Column:
    host = F.lower(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.when(host != "", host)


def templates(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """A row for each host: host, n (its pages), main (paths of the article), marked, fixed (texts as path and hash)."""
    rows = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html")).where("host is not null")
    schema = "host string, kind string, path string, text bigint, pages bigint, times bigint, low bigint, high bigint, chars bigint"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                sums: dict[tuple, list[int]] = {}
                for host, page in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    counts, chars = tokens(page or "")
                    key = xxhash.xxh3_64_intdigest(page or "")
                    vector = {n: xxhash.xxh3_64_intdigest(n.to_bytes(8, "little"), key) for n in set(counts.values()) | {1}}
                    for token, n in [*counts.items(), (("h", "", 0), 1)]:
                        own = sums.setdefault((host, *token), [0] * 5)
                        own[0] += 1
                        own[1] += n
                        own[2] += vector[n] & 0xFFFFFFFF
                        own[3] += vector[n] >> 32
                        own[4] += chars.get(token, 0) * n
                names = list(zip(*sums))
                columns = [pa.array(c, pa.string()) for c in names[:3]]
                columns.append(pa.array([t - (1 << 63) for t in names[3]], pa.int64()))
                columns += [pa.array(c, pa.int64()) for c in zip(*sums.values())]
                yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in schema.split(", ")])

    keys, values = ["host", "kind", "path", "text"], ["pages", "times", "low", "high", "chars"]
    found = cut(rows.mapInArrow(count, schema).groupBy(keys).agg(*(F.sum(v).alias(v) for v in values)))
    hosts = found.where("kind = 'h'").select("host", F.col("pages").alias("n"))
    total = hosts.agg(F.sum("n")).first()[0] or 0
    sizes = hosts.withColumn("of", F.col("n"))
    found = hot_join(found.where("kind <> 'h'"), sizes, ["host"], total)
    frequent = F.col("pages") >= F.greatest(F.lit(2), F.col("of") * SUPPORT)
    # Rare texts count for their path as a whole; then there are few rows of a host.
    rare = found.where((F.col("kind") == "t") & ~frequent).groupBy("host", "path", "of")
    rare = rare.agg(F.sum("pages").alias("pages"), F.sum("chars").alias("chars")).select(
        "host", F.lit("x").alias("kind"), "path", F.lit(0).cast("long").alias("text"), "pages",
        *(F.lit(0).cast("long").alias(v) for v in values[1:4]), "chars", "of"
    )
    few = found.select(*keys, *values, "of").unionByName(rare).where(frequent & (F.col("of") > 1))

    def build(table: pa.Table) -> pa.Table:
        columns = [table.column(c).to_pylist() for c in (*keys[1:], *values)]
        own = [(kind, path, text, held, (held, times, low, high), chars) for kind, path, text, held, times, low, high, chars in zip(*columns)]
        n = table.column("of")[0].as_py()
        made = deduced(own, n)
        fixed = sorted(f"{path} {text}" for path, text in made.fixed)
        texts = [pa.array([x], pa.list_(pa.string())) for x in (sorted(made.main), fixed)]
        columns = [table.column("host").combine_chunks()[:1], pa.array([n], pa.int64()), texts[0], pa.array([made.marked]), texts[1]]
        return pa.table(columns, ["host", "n", "main", "marked", "fixed"])

    return few.groupBy("host").applyInArrow(build, "host string, n bigint, main array<string>, marked boolean, fixed array<string>")


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """A row for each row of `pages`: id_col, url_col, text, n_chars (its code points)."""
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host_of(F.col(url_col)).alias("host")
    )
    found = cut(templates(rows, "url", "html"))
    total = found.agg(F.sum("n")).first()[0] or 0
    # Pages of hosts without a template, and those without a host, need no partner.
    facts = found.where(F.size("main") > 0)
    known = hot_join(rows, facts, ["host"], total)
    plain = rows.join(F.broadcast(facts.where(F.col("n") * 1000 > total).select("host")), "host", "left_anti")
    plain = plain.join(facts.where(F.col("n") * 1000 <= total).select("host"), "host", "left_anti")
    plain = plain.select(
        *known.columns[:-3],
        F.lit(None).cast("array<string>").alias("main"),
        F.lit(None).cast("boolean").alias("marked"),
        F.lit(None).cast("array<string>").alias("fixed"),
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[str, Template] = {}
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = []
                for k, page in enumerate(part.column(2).to_pylist()):
                    page = page or ""
                    text, host = None, part.column(3)[k].as_py()
                    if part.column(5)[k].is_valid:
                        if host not in made:
                            if len(made) > 1000:
                                made.clear()
                            fixed = (x.rpartition(" ") for x in part.column(6)[k].as_py())
                            main = set(part.column(4)[k].as_py())
                            made[host] = Template(main, part.column(5)[k].as_py(), {(p, int(t) + (1 << 63)) for p, _, t in fixed})
                        text = main_text(page, made[host])
                    if text is None:
                        text = main_text(page, alone(page)) or ""
                    texts.append(text)
                columns = [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "url", "text", "n_chars"])

    kind = pages.schema[id_col].dataType.simpleString()
    order = ["id", "url", "html", "host", "main", "marked", "fixed"]
    every = known.select(*order).unionByName(plain.select(*order))
    result = every.mapInArrow(read, f"id {kind}, url string, text string, n_chars bigint")
    return result.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")
