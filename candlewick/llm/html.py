"""Main text of HTML pages by differencing against the nearest URL.

Pages are put in the order of host and URL path, and each is compared with its neighbours there: the longest
common subsequence of their text lines, those of menus and footers included, is what the site repeats. Shared
lines go; where the page's own markup says that they belong to the article, only if most pages of the host have
them there. Markup settles what no neighbour tells: lines that it says to be something else go as well, also
parts of lines. `removed_lines` counts what either of the two takes away.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import meets, numbered, sliced, split_by
from candlewick.sources.storage import stored

KEY = ["page_id", "url", "hh"]
CHROME, OPEN, BARE, ARTICLE, SUSPECT = range(5)  # what the markup says of a line
MATRIX_BITS = 1 << 29  # of the alignment held at once; longer pairs are halved
COMMON = 3  # different pages of a host, and more than half of them, that make prose in articles boilerplate
SALTS = 16  # parts of a host's lines

# Names of HTML and of common page parts.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes plaintext".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol "
    "p pre search section summary table tbody td tfoot th thead tr ul".split()
)
PROSE = set("p h1 h2 h3 h4 h5 h6 li pre blockquote dd dt td th caption figcaption".split())
NEVER = set(
    "nav footer aside form script style noscript template iframe svg math canvas object select option button "
    "textarea dialog menu head title label search".split()
)
PARTS = set(
    "nav navbar navigation menu sidebar footer ad ads advert adverts advertisement advertising adsense banner "
    "sponsor sponsored promo promotion cookie cookies consent gdpr notice notices popup modal newsletter subscribe "
    "subscription share sharing social comment comments disqus respond reply replies related recommended breadcrumb "
    "breadcrumbs pagination pager widget copyright toolbar login signup search skip masthead reviews".split()
)
#: Words that leave a name with one of the above what it is ("share-button"); with others it may be anything
#: ("notice-period").
BESIDE = set(
    "button buttons box bar block container wrapper wrap link links icon icons list posts articles section slot unit "
    "area form reader readers user visitor site page post article entry content main top bottom left right inline "
    "sticky fixed mobile desktop global primary secondary".split()
)
HEADERS = {"header", "topbar", "masthead"}
ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
CONTENT = set("article content main post entry story body text".split())
CLOSES = {  # an element that begins and those that it ends
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
    "tfoot": {"thead", "tbody", "tr", "td", "th"},
}
SCOPES = set("article aside blockquote body details div dl footer form header html main nav ol section table td th ul".split())

TOKEN = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<!\[CDATA\[(?P<data>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</(?=[^a-zA-Z])[^>]*(?:>|\Z)"""
    r"""|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>(?:=\s*"[^"]*"|=\s*'[^']*'|[^>])*+)(?:>|\Z)"""
    r"""|(?P<text>[^<]+|<)""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")


@dataclass(frozen=True)
class _State:
    """What the open elements say of the text inside them."""

    chrome: bool = False
    article: bool = False
    suspect: bool = False  # a name that may be a page part's, inside an article
    prose: bool = False

    def kind(self) -> int:
        if self.chrome:
            return CHROME
        if not self.article:
            return OPEN
        return SUSPECT if self.suspect else ARTICLE if self.prose else BARE


class _Page:
    """Text lines of a page, each with what the markup says of it.

    Every element has the state of its text with it, and the open elements of a name, the scopes and the blocks
    are found by their places, so the work for a tag does not grow with the depth of nesting.
    """

    def __init__(self) -> None:
        self.stack: list[tuple[str, _State, _State]] = []  # name, state inside, state of the line
        self.places: dict[str, list[int]] = {}
        self.scopes: list[int] = []
        self.blocks: list[int] = []
        self.lines: list[tuple[str, int]] = []
        self.buffer: list[tuple[str, bool]] = []  # text, page part
        self.line: _State | None = None  # of the first text of the line that is kept

    def now(self) -> tuple[_State, _State]:
        return self.stack[-1][1:] if self.stack else (_State(), _State())

    def text(self, text: str) -> None:
        inside, line = self.now()
        self.buffer.append((text, inside.chrome))
        if not inside.chrome and self.line is None and text.strip():
            self.line = line

    def flush(self) -> None:
        chrome = self.line is None
        line = " ".join("".join(t for t, c in self.buffer if c == chrome).split())
        if line:
            self.lines.append((line, CHROME if chrome else self.line.kind()))
        self.buffer.clear()
        self.line = None

    def push(self, name: str, inside: _State) -> None:
        at = len(self.stack)
        # An inline element changes what of a line is kept, not what kind of line it is.
        line = inside if name in BLOCKS else self.now()[1]
        self.stack.append((name, inside, line))
        self.places.setdefault(name, []).append(at)
        if name in SCOPES:
            self.scopes.append(at)
        if name in BLOCKS:
            self.blocks.append(at)

    def pop(self, size: int) -> None:
        if self.blocks and self.blocks[-1] >= size:
            self.flush()
        while len(self.stack) > size:
            self.places[self.stack.pop()[0]].pop()
        for places in (self.scopes, self.blocks):
            while places and places[-1] >= size:
                places.pop()

    def innermost(self, names: Iterable[str]) -> int:
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=-1)

    def ends(self, names: Iterable[str]) -> None:
        """Close the innermost of `names`, if it is open inside the innermost scope."""
        at = self.innermost(names)
        if at >= 0 and at >= (self.scopes[-1] if self.scopes else 0):
            self.pop(at)

    def end(self, name: str) -> None:
        """An end tag; one of an inline element closes nothing outside its block."""
        if name in BLOCKS:
            self.flush()
            at = self.innermost([name])
            if at >= 0:
                self.pop(at)
        else:
            self.ends([name])

    def begin(self, name: str, attributes: str) -> None:
        if name in BLOCKS:
            self.flush()
            self.ends(["p"])
        if name in CLOSES:
            self.ends(CLOSES[name])
        outer = self.now()[0]
        found = {k.lower(): v.strip("\"'").lower() for k, v in ATTRIBUTE.findall(attributes)}
        own = name in ("article", "main") or found.get("role") in ("main", "article")
        part, suspect, header = _names(name, found, outer.article, own)
        chrome = (
            outer.chrome
            or name in NEVER
            or part
            or (not outer.article and not own and (name == "header" or header))
            or found.get("role") in ROLES
            or "hidden" in found
            or found.get("aria-hidden") == "true"
            or "display:none" in found.get("style", "").replace(" ", "")
        )
        article = (outer.article or own) and not chrome
        self.push(name, _State(chrome, article, outer.suspect or suspect, outer.prose or name in PROSE))


def _names(name: str, found: dict[str, str], article: bool, own: bool) -> tuple[bool, bool, bool]:
    """(page part, perhaps a page part, header) by the class and id of an element.

    A name is a page part's if all its words say so. If only one of them does, that is enough for a container outside
    the article; inside, and for paragraphs and the like, neighbours must confirm it. So must the id of a paragraph,
    which may be no more than an anchor.
    """
    tokens = found.get("class", "").split() + ([] if name in PROSE else found.get("id", "").split())
    words = [set(re.findall("[a-z]+", t)) for t in tokens]
    sure = [bool(w & PARTS) and w <= PARTS | BESIDE for w in words]
    every = set().union(*words) | set(re.findall("[a-z]+", found.get("id", "")))
    rest = set().union(*(w for w, s in zip(words, sure, strict=True) if not s))
    content = bool(rest & CONTENT - {"text", "body"})
    header = bool(every & HEADERS)
    if name in ("html", "body", "main"):
        return False, False, header
    if any(sure) and not (content and not article) and not (own and every & CONTENT):
        return True, False, header
    maybe = bool(every & PARTS) and not content
    container = name in BLOCKS and name not in PROSE
    if maybe and not article and container and not (own and every & CONTENT):
        return True, False, header
    return False, maybe and article and name in BLOCKS, header


def page_lines(source: str) -> list[tuple[str, int]]:
    """(line, kind) of every text block of a page, white space joined and character references decoded."""
    page, at = _Page(), 0
    while at < len(source):
        token = TOKEN.match(source, at)
        if token is None:  # a tag that never ends
            break
        at = token.end()
        name = (token["name"] or "").lower()
        if token["text"] is not None:
            page.text(html.unescape(token["text"]))
        elif token["data"] is not None:
            page.text(token["data"])
        elif name and token["end"]:
            page.end(name)
        elif name == "br":
            page.text(" ")
        elif name == "hr":
            page.flush()
        elif name in RAW:
            close = re.compile(f"</{re.escape(name)}", re.I).search(source, at)
            at = close.start() if close else len(source)
            page.push(name, _State(chrome=True))
        elif name and name not in VOID and not (token["attributes"] or "").endswith("/") or name in BLOCKS:
            page.begin(name, token["attributes"] or "")
    page.flush()
    return page.lines


def _last_row(a: list[int], b: list[int]) -> list[int]:
    """Longest common subsequence of `a` with each beginning of `b`, by bit vectors."""
    match: dict[int, int] = {}
    for j, y in enumerate(b):
        match[y] = match.get(y, 0) | 1 << j
    full = (1 << len(b)) - 1
    v = full
    for x in a:
        m = match.get(x, 0)
        v = ((v + (v & m)) | (v & ~m)) & full
    out, total = [0], 0
    for j in range(len(b)):
        total += not v >> j & 1
        out.append(total)
    return out


def common_lines(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """Places in `a` and in `b` of one longest common subsequence."""
    low = 0
    while low < min(len(a), len(b)) and a[low] == b[low]:
        low += 1
    high = 0
    while high < min(len(a), len(b)) - low and a[-1 - high] == b[-1 - high]:
        high += 1
    x, y = a[low : len(a) - high], b[low : len(b) - high]
    if len(x) * len(y) > MATRIX_BITS and len(x) > 1:
        middle = len(x) // 2
        front, back = _last_row(x[:middle], y), _last_row(x[middle:][::-1], y[::-1])
        cut = max(range(len(y) + 1), key=lambda j: front[j] + back[len(y) - j])
        first, second = common_lines(x[:middle], y[:cut]), common_lines(x[middle:], y[cut:])
        inner = (first[0] + [i + middle for i in second[0]], first[1] + [j + cut for j in second[1]])
    else:
        inner = _traced(x, y)
    head, tail = list(range(low)), range(high, 0, -1)
    return (
        head + [i + low for i in inner[0]] + [len(a) - t for t in tail],
        head + [j + low for j in inner[1]] + [len(b) - t for t in tail],
    )


def _traced(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    match: dict[int, int] = {}
    for j, y in enumerate(b):
        match[y] = match.get(y, 0) | 1 << j
    full = (1 << len(b)) - 1
    rows = [full]
    for x in a:
        v, m = rows[-1], match.get(x, 0)
        rows.append(((v + (v & m)) | (v & ~m)) & full)
    # A zero bit j in row i says that line j lengthens the common subsequence of the first i lines.
    left, right, i, j = [], [], len(a), len(b)
    while i and j:
        if rows[i] >> (j - 1) & 1:
            j -= 1
        elif not rows[i - 1] >> (j - 1) & 1:
            i -= 1
        else:
            i, j = i - 1, j - 1
            left.append(i)
            right.append(j)
    return left[::-1], right[::-1]


def main_text(texts: list[str], kinds: list[int], shared: list[list[int]], common: list[int]) -> str:
    """The lines of the article; `shared` has for each neighbour the lines in common.

    A line is known by its place among those outside page parts. Prose inside an article element stays
    unless it is among `common`, lines shared with a neighbour that most pages of the host have in articles.
    Other lines there, and those under a name that may be a page part's, stay unless shared. Without an article
    element all lines outside page parts stay unless shared.
    """
    lines = [(t, k) for t, k in zip(texts, kinds, strict=True) if k != CHROME]
    inside = any(k != OPEN for _, k in lines)
    either = set().union(*shared)
    gone = {ARTICLE: set(common), **dict.fromkeys((BARE, SUSPECT) if inside else (OPEN,), either)}
    return "\n".join(t for i, (t, k) in enumerate(lines) if k in gone and i not in gone[k])


def _undecided(kinds: list[int]) -> bool:
    """Whether the text of a page depends on what its neighbours share with it."""
    return BARE in kinds or SUSPECT in kinds or (OPEN in kinds and ARTICLE not in kinds)


def _hashed(rows: DataFrame) -> DataFrame:
    """(rid, page_id, url, hh, undecided, hashes, kinds, prose, body, host, path) of every row.

    hashes and kinds are those of all lines, prose the different hashes of prose in articles, body is one hash of
    all lines outside page parts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            undecided, hashes, kinds, prose, body = [], [], [], [], []
            for source in batch.column("html").to_pylist():
                lines = page_lines(source or "")
                each = [xxhash.xxh64_intdigest(t) - (1 << 63) for t, _ in lines]
                of = [k for _, k in lines]
                undecided.append(_undecided(of))
                hashes.append(each)
                kinds.append(of)
                prose.append(sorted({h for h, k in zip(each, of, strict=True) if k == ARTICLE}))
                own = [h for h, k in zip(each, of, strict=True) if k != CHROME]
                body.append(xxhash.xxh64_intdigest(repr(own)) - (1 << 63))
            new = [
                pa.array(undecided, pa.bool_()),
                pa.array(hashes, pa.list_(pa.int64())),
                pa.array(kinds, pa.list_(pa.int8())),
                pa.array(prose, pa.list_(pa.int64())),
                pa.array(body, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), batch.column("hh"), *new],
                names=["page_id", "url", "hh", "undecided", "hashes", "kinds", "prose", "body"],
            )

    site = r"^\s*[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)"
    return rows.mapInArrow(
        run,
        "page_id long, url string, hh long, undecided boolean, hashes array<long>, kinds array<byte>, "
        "prose array<long>, body long",
    ).select(
        F.monotonically_increasing_id().alias("rid"),
        "*",
        F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), site, 1)).alias("host"),
        F.regexp_extract(F.coalesce("url", F.lit("")), site + r"([^?#]*)", 2).alias("path"),
    )


def _repeated(hashed: DataFrame) -> DataFrame:
    """(host, line): prose in the articles of most different pages of a host."""
    bodies = hashed.filter("host <> ''").groupBy("host", "body").agg(F.min("rid").alias("rid"))
    lines = bodies.join(hashed.select("rid", "prose"), "rid").select("host", F.explode("prose").alias("line"))
    often = lines.groupBy("host", "line").agg(F.count("*").alias("n")).filter(F.col("n") >= COMMON)
    pages = bodies.groupBy("host").agg(F.count("*").alias("n_pages"))
    return often.join(pages, "host").filter("2 * n > n_pages").select("host", "line")


def _common(places: DataFrame, aligned: DataFrame, hashed: DataFrame) -> DataFrame:
    """(rid, common): places of the lines shared with a neighbour that most pages of the host have in articles.

    A line of a large host is a hot key, so the pages are dealt over salts and the host's few lines copied.
    """
    repeated = _repeated(hashed).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    either = aligned.select("rid", F.array_distinct(F.flatten("shared")).alias("either"))
    own = F.filter(F.arrays_zip("hashes", "kinds"), lambda line: line["kinds"] != CHROME)
    found = (
        either.join(hashed.filter(F.size("prose") > 0).select("rid", own["hashes"].alias("hashes"), "prose"), "rid")
        .join(places.select("rid", "host"), "rid")
        .withColumn("place", F.explode("either"))
        .withColumn("line", F.expr("hashes[place]"))
        .filter("array_contains(prose, line)")
        .select("rid", "host", "line", "place", F.pmod(F.xxhash64("rid"), F.lit(SALTS)).cast("int").alias("salt"))
    )
    return found.join(repeated, ["host", "line", "salt"]).groupBy("rid").agg(
        F.sort_array(F.collect_list("place")).alias("common")
    )


def _shared(hashed: DataFrame) -> DataFrame:
    """(host, path, body, shared, parts, common): places of the lines that neighbours in the order of host and path have.

    shared is an array for each neighbour, of places outside page parts; parts has the places within them, counted
    apart. common is null or has those shared that are boilerplate even in an article. Copies under one path are one page there. A neighbour under another path that is a copy tells
    nothing.
    """
    least = F.min(F.struct(*KEY, "rid"))
    once = hashed.filter("host <> ''").groupBy("host", "path", "body").agg(least.alias("least"))
    once = once.select("host", "path", "body", "least.*")
    order = ["host", "path", *KEY]
    places = stored(numbered(once, order, "at", "url-order").drop(*KEY), "url-places")
    after = places.select(
        F.col("rid").alias("rid_b"),
        F.col("host").alias("host_b"),
        F.col("body").alias("body_b"),
        (F.col("at") - 1).alias("at_b"),
    )
    pairs = places.join(after, (F.col("at") == F.col("at_b")) & (F.col("host") == F.col("host_b")))
    lines = hashed.select("rid", "hashes", "kinds")
    given = (
        pairs.filter("body <> body_b")
        .select("rid", "rid_b")
        .join(lines, "rid")
        .join(lines.toDF("rid_b", "hashes_b", "kinds_b"), "rid_b")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rids, own, parts = [], [], []
            columns = (batch.column(c).to_pylist() for c in ("rid", "rid_b", "hashes", "hashes_b", "kinds", "kinds_b"))
            for rid, rid_b, a, b, kinds, kinds_b in zip(*columns, strict=True):
                for r, places, k in zip((rid, rid_b), common_lines(a, b), (kinds, kinds_b), strict=True):
                    rids.append(r)
                    for found, wanted in ((own, False), (parts, True)):
                        found.append(_places_among(places, [x == CHROME for x in k], wanted))
            numbers = pa.list_(pa.int32())
            arrays = [pa.array(rids, pa.int64()), pa.array(own, numbers), pa.array(parts, numbers)]
            yield pa.RecordBatch.from_arrays(arrays, names=["rid", "shared", "parts"])

    aligned = given.mapInArrow(run, "rid long, shared array<int>, parts array<int>")
    aligned = aligned.groupBy("rid").agg(  # two neighbours at most
        F.collect_list("shared").alias("shared"),
        F.array_distinct(F.flatten(F.collect_list("parts"))).alias("parts"),
    )
    aligned = stored(aligned, "page-aligned")
    common = _common(places, aligned, hashed)
    return (
        places.join(aligned, "rid")
        .join(common, "rid", "left")
        .select("host", "path", "body", "shared", "parts", "common")
    )


def _places_among(places: list[int], chrome: list[bool], wanted: bool) -> list[int]:
    """Places of lines among those that are (not) page parts, from places among all lines."""
    number = list(accumulate((c == wanted for c in chrome), initial=0))
    return [number[i] for i in places if chrome[i] == wanted]


def _texts(rows: DataFrame) -> DataFrame:
    """(page_id, url, text) from (page_id, url, html, shared, common)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = []
            columns = (batch.column(c).to_pylist() for c in ("html", "shared", "common"))
            for source, shared, common in zip(*columns, strict=True):
                lines = page_lines(source or "")
                texts.append(main_text([t for t, _ in lines], [k for _, k in lines], shared or [], common or []))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                names=["page_id", "url", "text"],
            )

    return rows.select("page_id", "url", "html", "shared", "common").mapInArrow(
        run, "page_id long, url string, text string"
    )


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) a row of `pages` (page_id, url, html, any other columns).

    A page is compared with those before and after it in the order of URL path and page_id among its
    host's; pages without a host (null or odd URLs) and single pages are judged by their markup alone. Null
    and empty html and pages without article text give empty texts. Rows that repeat all three columns
    are one page and get the same text, and so do pages of one host and path (URLs that differ in their
    query or fragment) with the same lines outside page parts. A page that has nothing but what a larger
    neighbour has gives an empty text, unless its markup says article. Prose in an article goes if a neighbour
    and more than half of the host's different pages, three at least, have it in theirs. No rows give no rows.

    Pages are aligned by the hashes of their lines. Only pages whose markup leaves lines undecided or whose
    articles have such prose meet the result again; the html of the others is never shuffled. On a page that no
    neighbour can be compared with, comments and notices without a telling name or element stay.
    """
    rows = _rows(pages)
    found = _compared(stored(_hashed(rows), "page-lines"))
    shared = found.filter("undecided OR common IS NOT NULL").select(*KEY, "shared", "common")
    shared = stored(shared, "page-shared")
    maybe, rest = split_by(rows, shared, *KEY)
    _, on = meets(shared, *KEY)
    other = shared.select(*[F.col(c).alias(f"_k_{c}") for c in KEY], "shared", "common")
    none = [
        F.lit(None).cast("array<array<int>>").alias("shared"),
        F.lit(None).cast("array<int>").alias("common"),
    ]
    undecided = maybe.join(other, on, "left")
    return _texts(undecided).unionByName(_texts(rest.select("*", *none)))


def _rows(pages: DataFrame) -> DataFrame:
    return pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), "html", F.xxhash64("html").alias("hh")
    )


def _compared(hashed: DataFrame) -> DataFrame:
    """Every page once, with what its neighbours share with it (null without neighbours)."""
    asked = hashed.select(*KEY, "host", "path", "body", "undecided", "kinds").dropDuplicates(KEY)
    return asked.join(_shared(hashed), ["host", "path", "body"], "left")


def removed_lines(pages: DataFrame) -> DataFrame:
    """(page_id, url, lines, by_neighbours, by_markup) of every different page: who removes how many lines.

    A line that a neighbour shares counts as removed by the neighbours, also if the markup would have removed it.
    """
    found = _compared(stored(_hashed(_rows(pages)), "page-lines"))
    own = F.filter("kinds", lambda k: k != CHROME)
    chrome = F.size("kinds") - F.size("own")
    inside = F.exists("own", lambda k: k != OPEN)
    none = F.array().cast("array<int>")
    either = F.coalesce(F.array_distinct(F.flatten("shared")), none)
    parts = F.size(F.coalesce("parts", none))
    common = F.size(F.filter(F.coalesce("common", none), lambda i: F.col("own")[i] == ARTICLE))
    others = F.size(F.filter("either", lambda i: F.col("own")[i] != ARTICLE))
    open_lines = F.size(F.filter("own", lambda k: k == OPEN))
    open_shared = F.size(F.filter("either", lambda i: F.col("own")[i] == OPEN))
    return (
        found.withColumn("own", own)
        .withColumn("either", either)
        .select(
            "page_id",
            "url",
            F.size("kinds").alias("lines"),
            (parts + common + others).alias("by_neighbours"),
            (chrome - parts + F.when(inside, open_lines - open_shared).otherwise(0)).alias("by_markup"),
        )
    )
