"""Main text of web pages, by wrappers inferred for each host.

A wrapper is a union-free regular expression over tokens: tags, text slots,
optional groups ``( )?`` and repeated groups ``( )+``. It is inferred from all
pages of a host: repeated runs of one shape become groups, and the wrapper is
aligned with one page's tokens after the other; where tags differ, what only
one side has becomes optional, and where texts differ the text becomes a slot.
A few pages at a time have a wrapper, a few wrappers are aligned to one, and so on.

The places of the wrapper's text, by their path of open elements, then say what
they are on each page of the host: constant text that several pages share
outside the article is furniture, as is all that stands in menus, headers, footers,
sidebars, notices, adverts, forms and reader comments. The texts and blocks
of all pages are counted by host, path and text, the path
with its classes and ids (digits masked) telling layouts apart: one that most
pages with its path have is constant too, and outside an article one that a
twentieth of them have. What is left of the article, or of the body on a page that has none, is the main text.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import text_hash
from tillroll.session import ensure_checkpoint_dir, materialize

#: Pages, and then wrappers, of a host that are aligned at a time, about.
ALIGNED = 8

#: Unlike pages that a block needs to be constant, and the share of those with
#: its path: in an article, and outside of it.
SUPPORT, SHARE, SHARE_OUTSIDE = 3, 0.5, 0.05

#: Steps of a path: an element further down has the path of the last of them.
DEPTH = 64

#: Size up to which the wrappers go to each executor; larger ones are joined by host.
BROADCAST_BYTES = 8 << 20

#: A tag ends before the next ``<`` outside quotes, so that unclosed ones cost no scan of the page.
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^<>]*>|<(/?)([a-zA-Z][^\s/<>]*)((?:[^<>\"']++|\"[^\"]*\"|'[^']*')*+)>", re.S)
_ATTR = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I | re.S)
_RAW = frozenset("script style textarea title template iframe noembed noframes xmp".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
_OUTSIDE = frozenset("nav footer aside form head button select option label fieldset noscript svg canvas object audio video dialog menu".split())
_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|cookies?|consent|notice|notification|alert|popup|modal|overlay|sidebar|side|menu|nav|navbar|navigation|"
    r"breadcrumbs?|footer|header|masthead|comments?|reply|replies|respond|disqus|share|sharing|social|related|recommended|newsletter|subscribe|signup|login|search|toolbar|widget)(?:$|[\s_-])",
    re.I,
)
#: Names of a layout, as no-sidebar, and of a header, which an article has too.
_DIGITS = re.compile(r"[0-9]+")
_STEP_NAMES = re.compile(r"\.[^/]*")
_LAYOUT = re.compile(r"\S*(?<![^\s_-])(?:no|not|has|with|without)[_-]\S*", re.I)
_HEADERS = re.compile(r"(?<![^\s_-])(?:header|masthead)(?![^\s_-])", re.I)
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog".split())
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


def _names(attrs: str) -> tuple[str, str]:
    """Class and id together, and role."""
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(attrs)} if attrs else {}
    return f"{found.get('class', '')} {found.get('id', '')}".strip(), found.get("role", "").strip().lower()


def _furniture(names: str, article: bool) -> bool:
    """Whether a class or id tells furniture; in an article, headers don't."""
    if not _NAMES.search(names):
        return False
    names = _LAYOUT.sub(" ", names)
    return bool(_NAMES.search(_HEADERS.sub("", names) if article else names))


def tokens(html: str) -> Iterator[tuple[str, str, str]]:
    """('<', tag, attributes), ('>', tag, '') and ('t', text, '') of a page;
    without comments, declarations and the content of raw elements."""
    at = text = 0
    while True:
        lt = html.find("<", at)
        m = _TAG.match(html, lt) if lt >= 0 else None
        if lt >= 0 and not m:
            at = lt + 1
            continue
        stop = len(html) if lt < 0 else lt
        if stop > text:
            yield "t", html[text:stop], ""
        if lt < 0:
            return
        at = text = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            if m[0].startswith("<![CDATA["):
                yield "t", m[0][9:].removesuffix("]]>"), ""
        elif m[1]:
            yield ">", tag, ""
        else:
            yield "<", tag, m[3]
            if tag in _RAW and not m[3].rstrip().endswith("/"):
                close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
                at = text = close.end() if close else len(html)
                yield ">", tag, ""


def texts(html: str, around: bool = True) -> Iterator[tuple[str, str, bool, bool, str | None]]:
    """Of each text: the path of open elements, itself, whether it stands in an
    article, whether in furniture; a None path is the edge of a block.

    The names of an article or main element don't count, unless it is within an
    article; without ``around``, nor do those of the elements that it stands in."""
    # Tag, path, in an article, in furniture, the same by tags and roles alone, in an article element.
    stack: list[tuple[str, str, bool, bool, bool, bool]] = []
    opened: Counter = Counter()
    for kind, value, attrs in tokens(html):
        if kind == "t":
            _, path, article, out, _, _ = stack[-1] if stack else ("", "", False, False, False, False)
            yield path, value, article, out, None
            continue
        if value not in _INLINE:
            yield "", "", False, False, value
        if kind == "<":
            if value in _VOID:
                if value == "br":
                    yield (stack[-1][1] if stack else ""), " ", bool(stack and stack[-1][2]), bool(stack and stack[-1][3]), None
                continue
            for known in _CLOSES.get(value, ()):
                if stack and stack[-1][0] == known:
                    opened[stack.pop()[0]] -= 1
            names, role = _names(attrs)
            _, path, article, out, tagged, nested = stack[-1] if stack else ("", "", False, False, False, False)
            here = value in ("article", "main") or role in ("main", "article")
            tagged = tagged or value in _OUTSIDE or value in _RAW or role in _ROLES or (value == "header" and not article)
            if here and not nested:
                out = tagged or (out and around)
            else:
                out = out or tagged or bool(names and value not in ("html", "body") and _furniture(names, article))
            nested = nested or value == "article" or role == "article"
            if not attrs.rstrip().endswith("/"):
                step = value if value not in _INLINE else ""
                label = f"{path}/{step}.{_DIGITS.sub('0', names)}" if names and step else f"{path}/{step}" if step else path
                # An element within itself, as unclosed markup makes it, repeats.
                same = len(stack) >= DEPTH or (step and path.endswith(f"/{step}"))
                stack.append((value, path if same else label, article or here, out, tagged, nested))
                opened[value] += 1
        elif opened[value]:
            while True:
                tag = stack.pop()[0]
                opened[tag] -= 1
                if tag == value:
                    break


# ----------------------------------------------------------------- inference


def fold(items: list) -> list:
    """Items with neighbouring runs of one shape folded to groups ('+', items)."""
    shapes = [_shape(x) for x in items]
    for width in range(1, 9):
        out: list = []
        own: list[str] = []
        k = 0
        while k < len(items):
            shape, n = shapes[k : k + width], 1
            while len(shape) == width and shapes[k + n * width : k + (n + 1) * width] == shape:
                n += 1
            if n > 1 and not (width == 1 and items[k][0] == "+"):
                out.append(("+", _same(items[k : k + width])))
                own.append(_shape(out[-1]))
                k += n * width
            else:
                out.append(items[k])
                own.append(shapes[k])
                k += 1
        items, shapes = out, own
    return items


def _same(unit: list) -> list:
    return [("t", None, x[2]) if x[0] == "t" else x for x in unit]


def _shape(x) -> str:
    """What an item is for alignment: its tag, a text's path, a group's inside."""
    if x[0] in "+?":
        inner = " ".join(_shape(y) for y in x[1])
        return f"({inner})+" if x[0] == "+" else inner
    return f"#{x[2]}" if x[0] == "t" else f"{x[0]}{x[1]}"


def page_items(html: str) -> list:
    """Tags and texts of a page, repeats folded."""
    items: list = []
    for path, value, _, _, tag in texts(html):
        if tag is not None:
            items.append(("<", tag, ""))
        elif text := " ".join(unescape(value).split()):
            items.append(("t", text, path))
    return fold(items)


def matched(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places of the longest rising run of matches between two lists of shapes,
    in which the k-th of a shape in one can only match the k-th in the other."""
    places: dict[str, list[int]] = defaultdict(list)
    for j, shape in enumerate(b):
        places[shape].append(j)
    used: Counter = Counter()
    tails: list[int] = []  # the least last place of runs of each length
    at: list[tuple[int, int]] = []
    ends: list[int] = []
    before: list[int] = []
    for i, shape in enumerate(a):
        k = used[shape]
        used[shape] += 1
        if k < len(places.get(shape, ())):
            j = places[shape][k]
            n = bisect_left(tails, j)
            tails[n : n + 1] = [j]
            ends[n : n + 1] = [len(at)]
            before.append(ends[n - 1] if n else -1)
            at.append((i, j))
    out, k = [], ends[-1] if ends else -1
    while k >= 0:
        out.append(at[k])
        k = before[k]
    return out[::-1]


def joined(x, y):
    """One item for two of one shape: texts that differ become a slot, and what
    is optional in either stays so."""
    if "?" in (x[0], y[0]):
        inside = [z[1] if z[0] == "?" else [z] for z in (x, y)]
        return ("?", [joined(u, v) for u, v in zip(*inside, strict=True)])
    return ("t", x[1] if x[1] == y[1] else None, x[2]) if x[0] == "t" else x


def align(wrapper: list, page: list) -> list:
    """The wrapper made to hold for the page too."""
    optional = lambda items: [x if x[0] == "?" else ("?", [x]) for x in items]
    pairs = matched([_shape(x) for x in wrapper], [_shape(x) for x in page])
    out: list = []
    i = j = 0
    for a, b in pairs:
        out += [*optional(wrapper[i:a]), *optional(page[j:b]), joined(wrapper[a], page[b])]
        i, j = a + 1, b + 1
    return [*out, *optional(wrapper[i:]), *optional(page[j:])]


def infer(pages: list[str]) -> list:
    return _inferred([page_items(html) for html in pages])


def _inferred(pages: list[list]) -> list:
    wrapper = pages[0] if pages else []
    for page in pages[1:]:
        wrapper = align(wrapper, page)
    return wrapper


def places(wrapper: list) -> dict[str, set]:
    """Path to the texts that stand there: None for a slot, or a constant."""
    out: dict[str, set] = {}
    for x in wrapper:
        if x[0] in "+?":
            for path, found in places(x[1]).items():
                out.setdefault(path, set()).update(found)
        elif x[0] == "t":
            out.setdefault(x[2], set()).add(x[1])
    return out


def wrapper_rules(pages: list[str]) -> str:
    """What extraction needs of a host's wrapper, as JSON: by path, the constants
    that two or more pages have, and, as repeats are slots, the texts that
    all of two or more pages with the path have. In articles, which on a page may say
    what others say, a constant is one of the aligned wrapper that ``SUPPORT`` unlike
    pages and ``SHARE`` of those with its path have."""
    held: Counter = Counter()
    with_path: Counter = Counter()
    for html in pages:
        own = {(path, " ".join(unescape(v).split())) for path, v, _, _, tag in texts(html) if tag is None and v.strip()}
        held.update(own)
        with_path.update({path for path, _ in own})
    constant: dict[str, set] = defaultdict(set)
    aligned = places(infer(pages))
    for path, found in aligned.items():
        constant[path].update(x for x in found if x and held[path, x] > 1)
    for (path, x), n in held.items():
        if x and 1 < n == with_path[path]:
            constant[path].add(x)
    article = _article_constants(pages, aligned)
    return json.dumps({"constant": {p: sorted(c) for p, c in sorted(constant.items()) if c}, "article": article, "pages": len(pages)})


def _article_constants(pages: list[str], aligned: dict[str, set]) -> dict[str, list[str]]:
    """By path, the blocks of articles that are constants of the wrapper."""
    rest: dict[tuple[str, str], Counter] = defaultdict(Counter)
    with_path: Counter = Counter()
    for html in pages:
        own = {(path, _plain(parts)) for path, inside, parts in blocks(html) if inside}
        longest = sorted({x for _, x in own}, key=lambda x: (-len(x), x))[:3]
        with_path.update({path for path, _ in own})
        for path, x in own:
            if x in aligned.get(path, ()):
                rest[path, x][tuple(y for y in longest if y != x)[:2]] += 1
    out: dict[str, list[str]] = defaultdict(list)
    for (path, x), others in sorted(rest.items()):
        n = others.total()
        if len(others) >= SUPPORT and 2 * max(others.values()) <= n and n >= SHARE * with_path[path]:
            out[path].append(x)
    return out


def expression(wrapper: list) -> str:
    """The wrapper as a regular expression to read."""
    out = []
    for x in wrapper:
        if x[0] in "+?":
            out.append(f"( {expression(x[1])} ){x[0]}")
        else:
            out.append(f"<{x[1]}>" if x[0] == "<" else "#text" if x[1] is None else repr(x[1]))
    return " ".join(out)


# ---------------------------------------------------------------- extraction


def main_texts(html: str) -> tuple[list, bool]:
    """The texts of a page, and whether an article has any. Articles that all
    stand in elements named as furniture aren't furniture for that."""
    for around in (True, False):
        found = list(texts(html, around))
        inside = [o for _, v, a, o, tag in found if tag is None and a and v.strip()]
        if not inside or not all(inside):
            break
    return found, bool(inside) and not all(inside)


def blocks(html: str) -> Iterator[tuple[str, bool, list[str]]]:
    """Path, whether in an article, and the texts of each block outside of
    furniture; of a page with an article, those in it."""
    found, article = main_texts(html)
    own: list[str] = []
    at = ("", False)
    for path, value, inside, out, tag in found:
        if tag is not None:
            if own:
                yield *at, own
            own = []
        elif not out and (inside or not article):
            if not own or value.strip():
                at = (path, inside)
            own.append(value)
    if own:
        yield *at, own


def _plain(parts: list[str]) -> str:
    return " ".join(unescape("".join(parts)).split())


def _mark(*parts: str) -> int:
    return text_hash("\n".join(parts).encode("utf-8", "surrogatepass"))


def _levels(path: str, inside: bool) -> set[str]:
    """The paths under which a block is counted: outside an article also that
    without names, which the layouts of a host share."""
    return {path} if inside else {path, _STEP_NAMES.sub("", path)}


def _item(host: str, path: str, block: str, inside: bool) -> int:
    """Mark of a block; the last bit says whether it stands in an article."""
    return _mark(host, path, block) & ~1 | inside


def _piece(host: str, path: str, text: str) -> int:
    """Mark of a text outside of articles, which a block may have several of."""
    return _mark("text", host, path, text)


def extract(html: str, rules: dict, shared: frozenset = frozenset(), host: str = "") -> str:
    """Main text of a page: its blocks without the constants of the wrapper and
    those ``shared`` on the host (by ``_item``, texts by ``_piece``), in page order, one a line."""
    constant, article = rules.get("constant", {}), rules.get("article", {})
    out = []
    for path, inside, parts in blocks(html):
        block = _plain(parts)
        if any(_item(host, x, block, inside) in shared for x in _levels(path, inside)):
            continue
        if inside and block in article.get(path, ()):
            continue
        if not inside and path in constant:
            parts = [x for x in parts if _plain([x]) not in constant[path]]
        if not inside and shared:
            parts = [x for x in parts if not x.strip() or _piece(host, path, _plain([x])) not in shared]
        if block := _plain(parts):
            out.append(block)
    return "\n".join(out)


def _page_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Host, path and block of each page, and its texts outside of articles (``piece``),
    with a signature of what else the page
    says: its two longest other blocks. A null item stands for the page's path."""
    for b in batches:
        cells: list[list] = [[], [], [], [], []]
        for host, html in zip(b.column("host").to_pylist(), b.column("html").to_pylist(), strict=True):
            found = list(blocks(html or ""))
            own = dict.fromkeys((level, x, inside) for path, inside, parts in found if (x := _plain(parts)) for level in _levels(path, inside))
            pieces = dict.fromkeys((path, x) for path, inside, parts in found if not inside for part in parts if (x := _plain([part])))
            longest = sorted({x for _, x, _ in own}, key=lambda x: (-len(x), x))[:3]
            whole = _mark(*longest[:2])
            rest = lambda x: _mark(*[y for y in longest if y != x][:2]) if x in longest[:2] else whole  # noqa: B023, E731
            key, paths = _mark(host), {path: _mark(host, path) for path, _, _ in own}
            rows = [(key, place, None, whole, False) for place in paths.values()]
            rows += [(key, paths[path], _item(host, path, x, inside), rest(x), False) for path, x, inside in own]
            places_of = {path: _mark("text", host, path) for path, _ in pieces}
            rows += [(key, place, None, whole, True) for place in places_of.values()]
            rows += [(key, places_of[path], _piece(host, path, x), rest(x), True) for path, x in pieces]
            for row in rows:
                for cell, v in zip(cells, row, strict=True):
                    cell.append(v)
        yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cells[:4]], pa.array(cells[4], pa.bool_())], names=["host_key", "place", "item", "rest", "piece"])


def shared_items(rows: DataFrame, constants: DataFrame) -> DataFrame:
    """host_key and items. Blocks that ``SUPPORT`` unlike pages of a host, and
    ``SHARE`` (or ``SHARE_OUTSIDE``) of those with a block at the path, have there; texts outside of
    articles that all of two or more pages with a text at the path have, or that are ``constants`` (item)
    of the host's wrapper and that ``SHARE_OUTSIDE`` of those pages have. Pages that say the
    same otherwise are alike; where they are most of a block's or text's pages, it is
    text of copies, and stays."""
    found = rows.select("host", "html").mapInArrow(_page_blocks, "host_key long, place long, item long, rest long, piece boolean")
    key = ["host_key", "place", "item", "piece"]
    alike = found.groupBy(*key, "rest").agg(F.count("*").alias("n"))
    counts = alike.groupBy(*key).agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.count("*").alias("unlike"))
    counts = materialize(counts.where(f"item IS NULL OR 2 * most <= n AND unlike >= if(piece, 2, {SUPPORT})"), "blocks")
    of = counts.where("item IS NULL").select("host_key", "place", F.col("n").alias("of"))
    some = counts.where("item IS NOT NULL").join(of, ["host_key", "place"])
    inside = F.col("item").bitwiseAND(1) == 1
    shared = some.where(~F.col("piece") & (F.col("n") >= F.when(inside, SHARE).otherwise(SHARE_OUTSIDE) * F.col("of")))
    known = constants.distinct().withColumn("constant", F.lit(True))
    texts_of = some.where("piece").join(known, "item", "left").where((F.col("n") == F.col("of")) | (F.col("constant") & (F.col("n") >= SHARE_OUTSIDE * F.col("of"))))
    return shared.select("host_key", "item").union(texts_of.select("host_key", "item")).groupBy("host_key").agg(F.collect_list("item").alias("items"))


_WRAPPERS = "host string, bucket long, wrapper string"


def host_wrappers(rows: DataFrame, aligned: int = ALIGNED) -> DataFrame:
    """host and wrapper (JSON) of all pages of the host with an html. Pages are dealt by hash to
    buckets of about ``aligned``, each of which gets a wrapper; those of neighbouring
    buckets are aligned, in rounds, until a host has one."""
    pages = rows.where("html <> ''")
    sizes = materialize(pages.groupBy("host").agg(F.ceil(F.count("*") / aligned).alias("buckets")), "hosts")
    dealt = pages.select("host", "html").join(sizes, "host").select("host", F.pmod(F.xxhash64("html"), F.col("buckets")).alias("bucket"), "html")

    def one(table: pa.Table, wrapper: str) -> pa.Table:
        return pa.table({"host": table.column("host")[:1], "bucket": table.column("bucket")[:1], "wrapper": [wrapper]})

    def learn(table: pa.Table) -> pa.Table:
        return one(table, json.dumps(infer(sorted(set(table.column("html").to_pylist())))))

    def merge(table: pa.Table) -> pa.Table:
        parts = sorted(zip(table.column("part").to_pylist(), table.column("wrapper").to_pylist(), strict=True))
        return one(table, parts[0][1] if len(parts) == 1 else json.dumps(_inferred([json.loads(w) for _, w in parts])))

    wrappers = dealt.groupBy("host", "bucket").applyInArrow(learn, _WRAPPERS)
    left = sizes.agg(F.max("buckets")).first()[0] or 0
    while left > 1:
        parts = materialize(wrappers, "wrappers").withColumnRenamed("bucket", "part")
        wrappers = parts.withColumn("bucket", F.expr(f"part div {aligned}")).groupBy("host", "bucket").applyInArrow(merge, _WRAPPERS)
        left = -(-left // aligned)
    return wrappers.select("host", "wrapper")


def _constants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The constants of wrappers, by ``_piece``."""
    for b in batches:
        items = [
            _piece(host, path, x)
            for host, wrapper in zip(b.column("host").to_pylist(), b.column("wrapper").to_pylist(), strict=True)
            for path, found in places(json.loads(wrapper)).items()
            for x in found
            if x
        ]
        yield pa.RecordBatch.from_arrays([pa.array(items, pa.int64())], names=["item"])


def main_text(pages: DataFrame, aligned: int = ALIGNED) -> DataFrame:
    """page_id, url, text (empty if none) and n_chars of each page.

    Wrappers are inferred from all pages of each host, ``aligned`` of them at a time, and
    applied to all, as are the blocks and texts counted over all pages. A null url is a host of its own; a null or empty
    html has an empty text. Repeated rows come back as often; long pages are read whole;
    extra columns are ignored; an empty table gives no rows.
    """
    ensure_checkpoint_dir(pages.sparkSession)
    host = F.lower(F.coalesce(F.regexp_extract("url", r"^[A-Za-z][\w+.-]*://([^/?#]*)", 1), F.lit("")))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"), host.alias("host"))
    constants = host_wrappers(rows, aligned).mapInArrow(_constants, "item long")
    wrappers = materialize(shared_items(rows, constants), "shared")
    size = wrappers.agg(F.sum(8 * F.size("items") + 8)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        wrappers = F.broadcast(wrappers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, frozenset] = {}
        for b in batches:
            out = []
            for host, html, items in zip(b.column("host").to_pylist(), b.column("html").to_pylist(), b.column("items"), strict=True):
                if host not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[host] = frozenset(items.as_py() or ())
                out.append(extract(html or "", {}, known[host], host))
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(out, pa.string()), pa.array([len(x) for x in out], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    keyed = rows.withColumn("host_key", F.xxhash64("host"))
    return keyed.join(wrappers, "host_key", "left").mapInArrow(run, "page_id long, url string, text string, n_chars long")
