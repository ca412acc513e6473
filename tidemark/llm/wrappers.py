"""Main text of web pages by wrappers inferred from pages of one host.

A page is a stream of tokens: tags (with class, id and role) and text.  A run of equal token groups
is one repeated group.  Streams of one host are aligned one after the other: tokens in common stay,
a mismatch becomes an optional group, and text tokens are slots, so the result is a union-free
regular expression that all pages of the host match.  It is inferred from the distinct streams only,
first among those of one task and salt, then among the partial wrappers, so a host with a third of
all pages gives a few rows.

A walk over the wrapper labels its slots: those inside an article or main element are content, unless
they lie in navigation, headers and footers of the page, side bars, notices, adverts, forms or
comments.  Without such an element the deepest one that holds most of the ordinary text is the
container.  Each page's stream is then found in its host's wrapper as a subsequence, every item of it,
and takes over the labels of places in the same open elements; an item that has no such place has its
label from the page's own open elements.
"""

from __future__ import annotations

import bisect
import difflib
import html as entities
import json
import re
import zlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import small_batches

SALTS = 16
LONGEST_GROUP = 12

# Names as HTML defines them
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rt
    rp s samp small span strike strong sub sup time tt u var wbr""".split())
CLOSES_P = frozenset("""address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3
    h4 h5 h6 header hr main menu nav ol p pre section table ul""".split())
SAME_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
               "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
IMPLIED_ENDS = frozenset("</p> </li> </dt> </dd> </tr> </td> </th> </option>".split())
SCOPES = frozenset("ul ol dl table tbody article section div body".split())

# What is not the article
DROPPED_TAGS = frozenset("""head title nav footer aside form button select textarea menu dialog script style noscript
    template iframe svg object canvas audio video""".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
DROPPED_NAMES = frozenset("""ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner
    nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar side aside widget notice notices
    cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription signup login share sharing social
    related recommended recommendations comment comments reply replies respond discussion disqus pagination pager
    search""".split())
KEPT_INSIDE_ARTICLE = frozenset(["header"])

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|textarea|iframe|svg|title)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"""|</?[a-zA-Z](?>[^>"']+|"[^"]*"|'[^']*')*+>"""
    r"|</?[a-zA-Z][^>]*(?:>|\Z)|<[!?/][^>]*(?:>|\Z)|[^<]+|<", re.S | re.I)
NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)")
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
NUMBER = re.compile(r"[0-9]+")
BLANK = re.compile(r"\s+")


def tokens(page: str) -> list[tuple[str, str]]:
    """``(symbol, text)``: the symbol of a tag has its class, id and role; ``#`` is text that is not blank.

    Comments, declarations and elements whose content is not text are left out.
    """
    out = []
    for m in TOKEN.finditer(page):
        whole = m.group()
        if whole[0] != "<" or whole == "<":
            if out and out[-1][0] == "#":
                out[-1] = ("#", out[-1][1] + whole)
            elif not whole.isspace():
                out.append(("#", whole))
            elif out and out[-1][0] in INLINE_SYMBOLS:
                out.append((" ", whole))
            continue
        if m.group(1) or whole[1] in "!?":
            continue
        name = NAME.match(whole)
        if not name:
            continue
        tag = name.group(1).lower()
        if whole[1] == "/":
            out.append((f"</{tag}>", ""))
            continue
        marks = []
        if "=" in whole and tag != "a":
            for key, *values in ATTRIBUTE.findall(whole):  # numbers in names differ from page to page
                marks += [f"{key[0].lower()}:{NUMBER.sub('0', v)}" for v in "".join(values).lower().split()]
        out.append((f"<{tag}{' ' + ' '.join(sorted(marks)) if marks else ''}>", ""))
    return out


INLINE_SYMBOLS = frozenset(x for t in INLINE for x in (f"<{t}>", f"</{t}>"))


def _tag(symbol: str) -> str:
    return symbol.strip("</>").split(" ", 1)[0]


def stream(page_tokens) -> tuple[list[str], list[int]]:
    """Symbols that shape the page, without inline markup, and where each stands among the tokens.

    End tags that HTML lets pages leave out are left out always.
    """
    symbols, at = [], []
    for i, (symbol, _) in enumerate(page_tokens):
        if symbol == " " or symbol in IMPLIED_ENDS or symbol != "#" and _tag(symbol) in INLINE and _tag(symbol) != "a":
            continue
        if symbol == "#" and symbols and symbols[-1] == "#":
            continue
        symbols.append(symbol)
        at.append(i)
    return symbols, at


def folded(symbols: list[str]) -> tuple[list, list[list[int]]]:
    """Runs of equal groups become one tuple; and the positions that each item stands for."""
    items, places = list(symbols), [[i] for i in range(len(symbols))]
    for size in range(1, LONGEST_GROUP + 1):
        out, held, i = [], [], 0
        while i < len(items):
            n = 1
            if i + 2 * size <= len(items) and items[i] == items[i + size]:
                while items[i + n * size:i + (n + 1) * size] == items[i:i + size] \
                        and i + (n + 1) * size <= len(items):
                    n += 1
            group = items[i:i + size]
            # a group opens and closes its own element, so that nested repeats stay apart
            if n > 1 and (size > 1 or isinstance(group[0], tuple)):
                out.append(group[0] if size == 1 else tuple(group))
                held.append([p for q in places[i:i + n * size] for p in q])
                i += n * size
            else:
                out.append(items[i])
                held.append(places[i])
                i += 1
        items, places = out, held
    return items, places


def _key(item) -> str:
    return item if isinstance(item, str) else json.dumps(item)


def aligned(wrapper: list[list], other: list[list]) -> list[list]:
    """Align two wrappers ``[key, optional, chars]``; what only one of them has becomes optional."""
    match = difflib.SequenceMatcher(None, [w[0] for w in wrapper], [o[0] for o in other], autojunk=False)
    out = []
    for kind, i, j, k, m in match.get_opcodes():
        if kind == "equal":
            out += [[w[0], w[1] or o[1], w[2] + o[2]] for w, o in zip(wrapper[i:j], other[k:m])]
        else:
            out += [[x[0], True, x[2]] for x in (*wrapper[i:j], *other[k:m])]
    return out


def _dropped(symbol: str, inside: bool) -> bool:
    tag, _, marks = symbol.strip("<>").partition(" ")
    if tag in DROPPED_TAGS or tag == "header" and not inside:
        return True
    for mark in marks.split():
        kind, _, value = mark.partition(":")
        if kind == "r" and value in DROPPED_ROLES:
            return True
        if kind in "ci" and not (tag in ("body", "html", "article", "main")) and (
                set(re.split(r"[-_]+", value)) & DROPPED_NAMES - (KEPT_INSIDE_ARTICLE if inside else frozenset())):
            return True
    return False


def _walk(symbols):
    """For each symbol ``(dropped, in article, open elements)`` as it is met."""
    stack = []  # (tag, dropped, article, number)
    for number, symbol in enumerate(symbols):
        if symbol[0] != "<":
            yield stack[-1][1:3] if stack else (False, False), [s[3] for s in stack]
            continue
        tag = _tag(symbol)
        if symbol[1] == "/":
            if any(s[0] == tag for s in stack):
                while stack.pop()[0] != tag:
                    pass
        elif tag not in VOID:
            closes = {"p"} if tag in CLOSES_P else SAME_CLOSES.get(tag, ())
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] in closes:
                    del stack[depth:]
                    break
                if stack[depth][0] in SCOPES:
                    break
            _, dropped, article, _ = stack[-1] if stack else ("", False, False, 0)
            stack.append((tag, dropped or _dropped(symbol, article), article or tag in ("article", "main")
                          or "r:main" in symbol.split(), number))
        yield stack[-1][1:3] if stack else (False, False), [s[3] for s in stack]


def _flat(item):
    if isinstance(item, str):
        yield item
    else:
        for x in item:
            yield from _flat(x)


@dataclass
class Labels:
    """Of a wrapper: per item its symbols' labels and open elements, places of each key, and what tells content."""
    content: list[list[bool]]
    paths: list[tuple]
    places: dict[str, list[int]]
    article: bool
    home: str | None

    def own(self, dropped: bool, article: bool, path: tuple) -> bool:
        """The label by open elements alone."""
        return not dropped and (article if self.article else self.home is None or self.home in path)


def labelled(wrapper: list[list]) -> Labels:
    """For each item of the wrapper, for each of its symbols: is it content."""
    items = [json.loads(w[0]) if w[0][0] == "[" else w[0] for w in wrapper]
    symbols = [s for item in items for s in _flat(item)]
    chars = []
    for item, w in zip(items, wrapper):
        flat = list(_flat(item))
        slots = max(1, flat.count("#"))
        chars += [w[2] / slots if s == "#" else 0 for s in flat]
    state = list(_walk(symbols))
    marked, home = any(article for (_, article), _ in state), None
    if marked:
        content = [article and not dropped for (dropped, article), _ in state]
    else:
        # the deepest element with most of the text that is neither dropped nor a link
        mass, total = {}, 0
        for (dropped, _), path, n, s in zip(*zip(*state), chars, symbols) if state else ():
            if s == "#" and not dropped and not any(_tag(symbols[p]) == "a" for p in path):
                total += n
                for p in path:
                    mass[p] = mass.get(p, 0) + n
        home = max((p for p, n in mass.items() if n >= 0.7 * total and _tag(symbols[p]) not in ("p", "b", "i")),
                   default=None)
        content = [not dropped and (home is None or home in path) for (dropped, _), path in state]
    out, paths, i = [], [], 0
    for item in items:
        n = len(list(_flat(item)))
        out.append(content[i:i + n])
        paths.append(tuple(symbols[p] for p in state[i][1]))
        i += n
    places = {}
    for i, w in enumerate(wrapper):
        places.setdefault(w[0], []).append(i)
    return Labels(out, paths, places, marked, None if home is None else symbols[home])


def _page_stream(page: str):
    page_tokens = tokens(page)
    symbols, at = stream(page_tokens)
    items, places = folded(symbols)
    return page_tokens, symbols, at, items, places


def embedded(labels: Labels, keys: list[str], paths: list[tuple]) -> list[int | None]:
    """For each item of a page its place in the wrapper, in order, or None.

    The wrapper holds the streams of all its pages, so each item lies between its earliest and its
    latest place.  Any choice up to the latest one leaves room for the rest, so the first place there
    with the same open elements is taken, else the first one.
    """
    latest, after = [None] * len(keys), None
    for k in range(len(keys) - 1, -1, -1):
        at = labels.places.get(keys[k], [])
        j = len(at) if after is None else bisect.bisect_left(at, after)
        if not j:
            continue
        latest[k] = after = at[j - 1]
    out, last = [None] * len(keys), -1
    for k, key in enumerate(keys):
        if latest[k] is None:
            continue
        at = labels.places[key]
        i = bisect.bisect_right(at, last)
        choice = [at[j] for j in range(i, bisect.bisect_right(at, latest[k]))]
        last = out[k] = next((p for p in choice if labels.paths[p] == paths[k]), choice[0])
    return out


def content_flags(labels: Labels, items, places, symbols) -> list[bool]:
    """Per symbol of a page: is it content, by the wrapper's label of its place, or by its own open elements."""
    state = list(_walk(symbols))
    paths = [tuple(symbols[p] for p in path) for _, path in state]
    flags = [labels.own(*marks, path) for (marks, _), path in zip(state, paths)]
    found = embedded(labels, [_key(x) for x in items], [paths[held[0]] for held in places])
    for i, held in zip(found, places):
        if i is not None and labels.paths[i] == paths[held[0]]:
            own = labels.content[i]
            for q, p in enumerate(held):
                flags[p] = own[q % len(own)]
    return flags


def text_of(page_tokens, at, flags) -> str:
    """Blocks of the flagged text; text continues its slot over inline markup."""
    blocks, held, on, nth = [], [], False, 0
    by_token = dict(zip(at, flags))
    for i, (symbol, raw) in enumerate(page_tokens):
        if i in by_token:
            on = by_token[i]
        if symbol in ("#", " "):
            if on:
                held.append(entities.unescape(raw))
        elif _tag(symbol) == "br":
            held.append(" ")
        elif _tag(symbol) not in INLINE:
            blocks.append("".join(held))
            held = []
    blocks.append("".join(held))
    return "\n".join(b for b in (BLANK.sub(" ", x).strip() for x in blocks) if b)


def host_of(url):
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1),
                              F.lit("")))


def wrappers(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """One row per host: ``host, wrapper`` (JSON list of ``[item, optional, characters]``)."""
    given = small_batches(pages).select(host_of(F.col(url)).alias("host"), F.col(html).alias("html"))

    def streams(batches):
        seen = {}

        def rows():
            parts = [json.dumps([[k, False, n] for k, n in zip(keys, sizes)]) for (_, keys), sizes in seen.items()]
            batch = pa.RecordBatch.from_arrays(
                [pa.array([host for host, _ in seen], pa.string()),
                 pa.array([zlib.crc32("".join(keys).encode()) % SALTS for _, keys in seen], pa.int32()),
                 pa.array(parts, pa.string())], names=["host", "salt", "wrapper"])
            seen.clear()
            return batch

        for batch in batches:
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                page_tokens, symbols, at, items, places = _page_stream(page or "")
                key = (host, tuple(_key(x) for x in items))
                sizes = [sum(len(page_tokens[at[p]][1]) for p in held) for held in places]
                seen[key] = [a + b for a, b in zip(seen[key], sizes)] if key in seen else sizes
                if len(seen) >= 2000:
                    yield rows()
        if seen:
            yield rows()

    def merge(table: pa.Table) -> pa.Table:
        # equal streams add up; the others are aligned, shorter ones first
        distinct = {}
        for part in map(json.loads, table["wrapper"].to_pylist()):
            key = tuple((k, optional) for k, optional, _ in part)
            sizes = [n for _, _, n in part]
            distinct[key] = [x + y for x, y in zip(distinct[key], sizes)] if key in distinct else sizes
        whole = None
        for key in sorted(distinct, key=lambda k: (len(k), k)):
            part = [[k, optional, n] for (k, optional), n in zip(key, distinct[key])]
            whole = part if whole is None else aligned(whole, part)
        return pa.table({"host": table["host"].slice(0, 1), "wrapper": pa.array([json.dumps(whole or [])])})

    shares = given.mapInArrow(streams, "host string, salt int, wrapper string").groupBy("host", "salt") \
        .applyInArrow(merge, "host string, wrapper string")
    return shares.groupBy("host").applyInArrow(merge, "host string, wrapper string")


def main_text(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """All columns of ``pages`` without ``html``, then ``text`` and ``n_chars``, which replace columns of these names.

    A null or empty page, or one without content, has an empty text.  A null address, or one without a host,
    belongs to the host "".  Repeated pages give repeated rows.
    """
    found = wrappers(pages, url, html).withColumnRenamed("host", "_host")
    kept = [c for c in pages.columns if c not in (html, "text", "n_chars")]
    held = [f"_{i}" for i in range(len(kept))]
    joined = pages.select(*[F.col(f"`{c}`").alias(h) for c, h in zip(kept, held)], F.col(html).alias("_html"),
                          host_of(F.col(url)).alias("_host")).join(found, "_host") \
        .select(*held, "_html", "wrapper")

    def run(batches):
        known, flags_of = {}, {}
        for batch in batches:
            texts = []
            for page, wrapper in zip(batch.column(len(kept)).to_pylist(), batch.column(len(kept) + 1).to_pylist()):
                if wrapper not in known:
                    if len(known) > 200:
                        known.clear()
                        flags_of.clear()
                    parsed = json.loads(wrapper)
                    known[wrapper] = (len(known), labelled(parsed))
                number, labels = known[wrapper]
                page_tokens, symbols, at, items, places = _page_stream(page or "")
                key = (number, tuple(symbols))
                if key not in flags_of:
                    if len(flags_of) > 2000:
                        flags_of.clear()
                    flags_of[key] = content_flags(labels, items, places, symbols)
                texts.append(text_of(page_tokens, at, flags_of[key]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(kept)], pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=[*kept, "text", "n_chars"])

    fields = [f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in kept]
    return joined.mapInArrow(run, ", ".join([*fields, "text string", "n_chars long"]))
