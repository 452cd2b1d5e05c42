"""HTML extraction (12): consensus paths of hosts.

1. Each page's containers (elements that hold blocks of text) are scored: the characters of their
   blocks, less three times those in links, times a prior for the element (article, names such as
   "entry-content", the whole body).
2. A page votes for the generalised path of each of its containers: tags, classes and ids from the
   root, with any part of a name that holds a digit made equal. The vote is the container's share of
   the page's best score, to the fourth power, as a whole number of millionths.
3. Spark adds up votes by host and path. A host's winners are the ``paths`` paths with the highest
   mean vote (one page more in the divisor, so that one page alone proves little).
4. Each page is read again and the containers of the first winning path that it has are extracted.
   Pages that have none, or no host, are extracted by their own best container.

Elements that are no part of an article by tag, role, state or name (menus, headers, footers,
sidebars, notices, adverts, forms, scripts, comments of readers) are left out everywhere. Markup is
read leniently in one linear pass: unclosed and misnested elements, raw text, broken tags.
"""

from __future__ import annotations

import html
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import staged, table

_TOKEN = re.compile(r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?\]\]>|<[!?][^>]*+(?:>|\Z)
    |<(/?)([A-Za-z][^\s/>]*+)((?:[^>"'=]++|=\s*"[^"]*"|=\s*'[^']*'|["'=])*+)>
    |</?[A-Za-z][^>]*+\Z|</[^A-Za-z][^>]*+(?:>|\Z)""", re.S | re.X)
_ATTRIBUTE = re.compile(r"""([A-Za-z_:@][-\w:.@]*+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']++)))?""")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_PART = re.compile(r"[^-_.:]*\d[^-_.:]*")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is text up to the end tag, and never part of an article.
RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript plaintext".split())
#: Elements that are no part of an article.
OUTSIDE = frozenset("head nav header footer aside form fieldset button select datalist menu dialog template svg canvas object audio video map".split()) | RAW
CONTAINERS = frozenset("html body main article section div td th center blockquote details figure li dd".split())
BLOCKS = CONTAINERS | OUTSIDE | frozenset("address caption dl dt figcaption h1 h2 h3 h4 h5 h6 hgroup hr ol p pre search summary table tbody tfoot thead tr ul".split())
#: Where the search for an element to close ends.
SCOPES = frozenset("td th table caption template object".split())
TABLE = frozenset("td th tr tbody thead tfoot caption table".split())
#: What a start tag closes if it is open, up to the nearest of the second set.
IMPLIED = {"li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
           "tr": ({"tr"}, {"table"}), "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "thead": ({"tbody", "thead", "tfoot"}, {"table"}), "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
           "option": ({"option"}, {"select", "datalist"}), "a": ({"a"}, SCOPES | {"p", "div"})}
#: Names (classes, ids) of elements that are no part of an article, and of those that likely are one.
NOT_ARTICLE = frozenset("""ad ads advert adverts advertisement advertising adsense adslot banner breadcrumb breadcrumbs byline captcha comment comments commentlist consent cookie cookies
    disclaimer disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notification notifications overlay pager pagination paywall popup promo promoted promotion
    recommended related reply replies respond rss search share sharing shares sidebar signup skip social sponsor sponsored sponsors subscribe subscription tags toolbar toc tracking widget widgets""".split())
NEGATED = frozenset("no non not without with has have is".split())
ARTICLE = frozenset("article articlebody body content entry main post story text".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Elements that keep their content whatever their names are.
KEEP = frozenset("html body main article".split())
DEPTH = 48
MILLION = 10**6


@lru_cache(1 << 14)
def element(tag: str, attributes: str) -> tuple[str, int, float]:
    """(generalised step of the path, whether it is left out: 1 for its tag or state, 2 for its name,
    prior of its score)."""
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)} if attributes and not attributes.isspace() else {}
    classes, id_ = html.unescape(found.get("class", "")).split(), html.unescape(found.get("id", "")).strip()
    step = tag + "".join(f".{c}" for c in sorted({_PART.sub("0", c) for c in classes})) + (f"#{_PART.sub('0', id_)}" if id_ else "")
    style = found.get("style", "").replace(" ", "").lower()
    out = 1 if (tag in OUTSIDE or "hidden" in found or found.get("aria-hidden", "").lower() == "true" or "display:none" in style or "visibility:hidden" in style
                or found.get("role", "").lower() in ROLES) else 0
    names = [[w.lower() for w in _NAME.findall(c)] for c in [*classes, id_]]
    if not out and tag not in KEEP and any(w in NOT_ARTICLE and not (i and n[i - 1] in NEGATED) for n in names for i, w in enumerate(n)):
        out = 2
    likely = tag in ("article", "main") or found.get("role", "").lower() in ("main", "article") or found.get("itemprop", "").lower() == "articlebody"
    prior = 0.8 if tag in ("html", "body") else 1.5 if likely else 1.3 if any(w in ARTICLE for n in names for w in n) else 1.0
    return step, out if tag not in ("html", "body") else 0, prior


class Page:
    """Containers of a page and the blocks of text in them, in page order."""

    def __init__(self, source: str, by_name: bool = True):
        self.parent, self.path, self.prior = [-1], [""], [0.8]  # the root: the page itself
        self.blocks: list[tuple[int, str, int]] = []  # container, text, characters in links
        self.article = self.named = False
        self._read(source, by_name)

    def _read(self, source: str, by_name: bool) -> None:
        open_: list[tuple[str, int, int, int]] = []  # tag, container, left out, inside a link
        count: dict[str, int] = {}
        pieces: list[str] = []
        state = (0, 0, 0)  # container, left out, inside a link
        linked = pos = 0

        def flush():
            nonlocal linked
            if pieces:
                text = " ".join("".join(pieces).split())
                if text:
                    self.blocks.append((state[0], text, linked))
                pieces.clear()
            linked = 0

        def close(depth):  # elements from this depth on end
            nonlocal state
            for tag, *_ in open_[depth:]:
                count[tag] -= 1
                if tag in BLOCKS:
                    flush()
            del open_[depth:]
            state = open_[-1][1:] if open_ else (0, 0, 0)

        def find(tags, stop):
            for i in range(len(open_) - 1, -1, -1):
                if open_[i][0] in tags:
                    return i
                if open_[i][0] in stop:
                    return -1
            return -1

        def say(text):
            nonlocal linked
            if text and not state[1]:
                text = html.unescape(text) if "&" in text else text
                pieces.append(text)
                if state[2]:
                    linked += len(text.strip())

        while pos < len(source):
            token = _TOKEN.search(source, pos)
            if token is None:
                say(source[pos:])
                break
            say(source[pos:token.start()])
            pos = token.end()
            if token[2] is None:
                continue
            tag = token[2].lower()
            if token[1]:
                if count.get(tag) and tag not in ("html", "body"):
                    at = find((tag,), SCOPES - TABLE if tag in TABLE else SCOPES)
                    if at >= 0:
                        close(at)
                elif tag in BLOCKS:
                    flush()
                continue
            if tag in ("html", "body") and count.get(tag):
                continue
            if tag in BLOCKS and count.get("p"):
                at = find(("p",), SCOPES)
                if at >= 0:
                    close(at)
            if tag in IMPLIED and any(count.get(t) for t in IMPLIED[tag][0]):
                at = find(*IMPLIED[tag])
                if at >= 0:
                    close(at)
            if tag in BLOCKS:
                flush()
            if tag in VOID:
                if tag == "br":
                    say(" ")
                continue
            step, out, prior = element(tag, token[3])
            if out == 2:
                self.named = True
                out = 1 if by_name else 0
            container, gone, link = state
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(source, pos)
                pos = end.start() if end else len(source)
                out = 1
            elif tag in CONTAINERS and not (gone or out):
                self.article |= tag in ("article", "main")
                self.parent.append(container)
                own = self.path[container]
                self.path.append(f"{own}>{step}" if own.count(">") < DEPTH else own)
                self.prior.append(prior)
                container = len(self.parent) - 1
            state = (container, gone or out, link or tag == "a")
            open_.append((tag, *state))
            count[tag] = count.get(tag, 0) + 1
        close(0)

    def scores(self) -> dict[str, float]:
        """Score of each path: that of its outermost containers together."""
        total = [0.0] * len(self.parent)
        for c, text, linked in self.blocks:
            total[c] += len(text) - 3 * linked
        for c in range(len(total) - 1, 0, -1):
            total[self.parent[c]] += total[c]
        out: dict[str, float] = {}
        for c, path in enumerate(self.path):
            if path != self.path[self.parent[c]] or c == 0:
                out[path] = out.get(path, 0.0) + total[c] * self.prior[c]
        return {p: s for p, s in out.items() if s > 0}

    def text(self, path: str) -> str:
        """The blocks within all containers of a path."""
        inside = [False] * len(self.parent)
        for c, p in enumerate(self.path):
            inside[c] = p == path or (c > 0 and inside[self.parent[c]])
        return "\n".join(t for c, t, _ in self.blocks if inside[c])

    def best(self) -> str | None:
        """Its own best path; where no container scores, that of the first article."""
        scores = self.scores()
        if scores:
            return min(scores, key=lambda p: (-scores[p], -p.count(">"), p))
        return next((p for p in self.path if re.search(r">(?:article|main)[^>]*$", p)), None)


def read(source: str | None) -> Page:
    """A page. If all its text is in elements left out for their names, and it has no article, names
    don't count."""
    page = Page(source or "")
    return Page(source or "", False) if page.named and not page.blocks and not page.article else page


def votes(page: Page) -> dict[str, int]:
    """Path -> vote in millionths; those below one are left out."""
    scores = page.scores()
    most = max(scores.values(), default=0)
    return {p: v for p, s in scores.items() if (v := int(MILLION * (s / most) ** 4))}


def extract(page: Page, paths: list[str] | None) -> str:
    """The text of the first of these paths that the page has, else of its own best container."""
    have = set(page.path)
    path = next((p for p in paths or () if p in have), None)
    path = page.best() if path is None else path
    return "" if path is None else page.text(path)


def host(url: Column) -> Column:
    """Lower-case host of an address, NULL without one."""
    found = F.lower(F.regexp_extract(url, r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:\s]+)", 1))
    return F.when(found != "", found)


def _votes(batches):
    schema = pa.schema([("host", pa.string()), ("path", pa.string()), ("vote", pa.int64())])
    for batch in batches:
        for i in range(0, batch.num_rows, 64):
            part = batch.slice(i, 64)
            out = [(h, p, v) for h, s in zip(*(part.column(c).to_pylist() for c in ("host", "html")), strict=True) for p, v in votes(read(s)).items()]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)


def _texts(batches):
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])
    for batch in batches:
        for i in range(0, batch.num_rows, 64):
            part = batch.slice(i, 64)
            text = [extract(read(s), p) for s, p in zip(*(part.column(c).to_pylist() for c in ("html", "paths")), strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url").cast(pa.string()), pa.array(text, pa.string())], schema=schema)


def winners(pages: DataFrame, paths: int = 8) -> DataFrame:
    """(host, paths: best first) from pages (host, html), by the mean of the votes."""
    cast = pages.where("host IS NOT NULL").mapInArrow(_votes, "host string, path string, vote long")
    mean = cast.groupBy("host", "path").agg((F.floor(F.sum("vote") / (F.count(F.lit(1)) + 1))).alias("mean"))
    depth = F.size(F.split("path", ">"))
    top = mean.select("host", F.struct((-F.col("mean")).alias("m"), (-depth).alias("d"), F.col("path").alias("p")).alias("x"))
    ranked = top.withColumn("r", F.row_number().over(Window.partitionBy("host").orderBy("x"))).where(F.col("r") <= paths)
    return ranked.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("r", F.col("x.p").alias("p")))).alias("l")).select("host", F.col("l.p").alias("paths"))


def extract_pages(pages: DataFrame, *, paths: int = 8, broadcast_bytes: int = 16 << 20, salts: int = 64, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row a page: page_id, url, text, n_chars (code points of the text).

    NULL and empty pages, and pages without text in a container, have the text ''. A page without a
    host (NULL url) takes part in no vote. Repeated rows are each a page, and each votes. Other
    columns are left out. The winners go to all tasks where they measure at most
    ``broadcast_bytes``; else pages are dealt by (host, salt), so that a hot host is ``salts`` groups.
    """
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                        F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).alias("html"), host(F.col(f"`{url_col}`").cast("string")).alias("host"))
    won = staged(winners(rows.select("host", "html"), paths), "winners")
    size = won.agg(F.sum(F.octet_length("host") + F.aggregate("paths", F.lit(32), lambda t, p: t + F.octet_length(p) + 16))).first()[0] or 0
    if size <= broadcast_bytes:
        rows = rows.join(F.broadcast(won), "host", "left")
    else:
        salt = F.pmod(F.xxhash64("page_id", "url", "html"), F.lit(salts)).cast("int")
        many = won.select("host", "paths", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
        rows = rows.withColumn("salt", salt).join(many, ["host", "salt"], "left")
    out = rows.select("page_id", "url", "html", "paths").mapInArrow(_texts, "page_id long, url string, text string")
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))
