"""Main text of web pages: page structure, and a suffix array of each host for what structure leaves open.

Each page is read into blocks. Blocks in menus, headers, footers, sidebars, notices, adverts, forms and
comments are boilerplate by their tags, classes and roles. What is left is decided by repetition: token streams are taken
together by host, their suffixes sorted, and runs of ``RUN`` tokens or more that enough distinct pages have are boilerplate.

- A page that marks no article: runs of the blocks outside articles that stand in more than two distinct pages, or in both
  pages of a host that has two.
- A marked article: runs that stand in more than half of the distinct articles of its host, and in PAGES at least. Sentences
  that fewer articles share are theirs. An article of which more than ``COPIED`` would go is a near copy of others, no
  boilerplate, and stays whole.

Pages with the same text are copies and count as one page: a page is no boilerplate for being repeated. Blocks keep the
runs that aren't covered.

The sort is spread over tasks by the first RUN tokens, within which neighbours in the suffix array are compared; equal
suffixes are put together before they are sent, so a run that all pages of a host share is one row a task. Of articles, whose
suffixes would be many times the input, only those are sent that can be in so many articles: each host's pages are counted by
some bits of a run's hash (a count of all runs that share the bits, so no less than that of each), and a run whose bits too
few pages have can't be in enough articles.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslens.llm.common import clean, prepare, written

#: Tokens of a repeated run at least, and tokens of a suffix that are compared.
RUN, SUFFIX = 8, 12
#: Distinct pages of a host that have a run of boilerplate, at least; of two pages, both.
PAGES = 3
#: Share of an article's words that repetition takes at most; one that would lose more is a near copy.
COPIED = 0.9
#: Hosts whose counts a task holds at once, and tokens whose hashes it does.
HOSTS, TOKENS = 500, 300_000
#: Entries of a table that is broadcast at most; a larger one is joined by host.
SMALL = 100_000
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)>""", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
# Fixed values of the HTML standard: elements without content, with raw content, and that start a new line.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math select object".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul""".split())
DROPPED = frozenset("nav footer aside form menu dialog button fieldset head".split())
# Words in class, id, role or label by which pages mark what isn't their text.
MARKS = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu
breadcrumb breadcrumbs sidebar footer comment comments disqus reply replies respond share sharing social related recommended newsletter
subscribe subscription signup login cookie cookies consent gdpr notice notices notification popup modal overlay pagination pager toolbar
masthead contentinfo complementary alert disclaimer copyright search skip widget""".split())
HEADERS = frozenset("header masthead topbar banner".split())
CONTENT = frozenset("content article post entry story articlebody maincontent".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
MAIN, LOOSE, PLAIN = "main", "loose", "other"


@dataclass
class _Open:
    tag: str
    dropped: bool
    level: int       # 3 in an article, 2 in main, 1 in a content element, 0 elsewhere


@dataclass
class _Block:
    level: int
    dropped: bool
    parts: list[str] = field(default_factory=list)


def _words(attributes: str) -> tuple[set[str], bool]:
    """Words of class, id, role and label; whether the element is hidden."""
    found, hidden = set(), False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id", "role", "aria-label", "itemprop"):
            found.update(x.lower() for x in re.findall(r"[A-Z]?[a-z]+|[A-Z]+", value))
            found.add(value.lower())
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and "display:none" in value.lower().replace(" ", ""):
            hidden = True
    return found, hidden


def blocks(page: str | None) -> list[tuple[int, bool, str]]:
    """(level, dropped, text) of each block that has text, in page order; white space in it is one space."""
    if not page:
        return []
    out: list[_Block] = []
    stack: list[_Open] = [_Open("", False, 0)]
    fresh = True

    def text(s: str) -> None:
        nonlocal fresh
        if not s or s.isspace() and fresh:
            return
        top = stack[-1]
        if fresh or not out or (out[-1].level, out[-1].dropped) != (top.level, top.dropped):
            out.append(_Block(top.level, top.dropped))
            fresh = False
        out[-1].parts.append(s)

    def close(tags: set[str], until: frozenset[str]) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                del stack[i:]
                return
            if stack[i].tag in until:
                return
    at, n = 0, len(page)
    while at < n:
        m = _TAG.search(page, at)
        if m is None:
            rest = page[at:]
            cut = re.search(r"<[/a-zA-Z!?][^<>]*\Z", rest)       # a tag that the page's end cuts off
            text(rest[:cut.start()] if cut else rest)
            break
        text(page[at:m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        shut, attributes = bool(m[1] or m[4]), m[3] if m[2] else m[6]
        if tag in BLOCK:
            fresh = True
        if shut:
            if tag not in VOID and any(x.tag == tag for x in stack):
                close({tag}, frozenset())
            elif tag == "br":
                text(" ")
            continue
        if tag == "br":
            text(" ")
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if tag in BLOCK and tag not in ("body", "html"):
            close({"p"}, frozenset({"table", "td", "th", "button"}))
        if tag in CLOSED_BY:
            close(set(CLOSED_BY[tag]), frozenset({"ul", "ol", "dl", "table", "select"}))
        top = stack[-1]
        marks, hidden = _words(attributes) if attributes else (set(), False)
        dropped = top.dropped or hidden or tag in DROPPED
        if tag not in ("html", "body", "main") and marks & MARKS and not (tag == "article" and not marks & {"comment", "comments", "reply", "related"}):
            dropped = True
        if (tag == "header" or marks & HEADERS and tag in BLOCK) and top.level == 0:
            dropped = True
        level = max(top.level, 3 if tag == "article" or "articlebody" in marks else 2 if tag == "main" or "main" in marks and tag in BLOCK
                    else 1 if tag in BLOCK and marks & CONTENT and tag not in ("html", "body") else 0)
        if attributes and attributes.rstrip().endswith("/") and tag not in BLOCK:
            continue
        stack.append(_Open(tag, dropped, level))
    return [(b.level, b.dropped, t) for b in out if (t := " ".join(entities.unescape("".join(b.parts)).split()))]


def read_page(page: str | None) -> tuple[list[str], list[str], list[str]]:
    """(main, loose, other) texts of blocks: the article's; those of a page without one; boilerplate and what lies outside an article."""
    found = blocks(page)
    level = max((lv for lv, dropped, _ in found if not dropped), default=0)
    main = [t for lv, dropped, t in found if not dropped and lv == level and level]
    loose = [t for lv, dropped, t in found if not dropped and not level]
    other = [t for lv, dropped, t in found if dropped or lv < level]
    return main, loose, other


def host_of(url: str | None) -> str:
    m = re.match(r"\s*(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


def stream_of(blocks: list[str]) -> list[str]:
    """The tokens of blocks, with a mark after each block."""
    return [x for b in blocks for x in (*b.split(), "¶")]


def uncovered(blocks: list[str], starts: Iterable[int]) -> list[str]:
    """What is left of blocks without the runs that start at these places of their stream."""
    size = sum(len(b.split()) + 1 for b in blocks)
    edge = np.zeros(size + 1, np.int64)
    for i in starts:
        edge[i] += 1
        edge[i + RUN] -= 1
    gone, at, kept = np.cumsum(edge) > 0, 0, []
    for b in blocks:
        t = b.split()
        kept.append(" ".join(x for x, g in zip(t, gone[at:at + len(t)]) if not g))
        at += len(t) + 1
    return [k for k in kept if k]


def repeated_runs(streams: DataFrame) -> DataFrame:
    """(host, run): the first RUN tokens of suffixes that stand in PAGES or more distinct pages of a host, or in both of two.
    streams: host, tokens, one row for each distinct page."""
    def suffixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for h, t in zip(pdf["host"], (list(x) for x in pdf["tokens"])):
                told: set[str] = set()
                for x in {" ".join(t[i:i + SUFFIX]) for i in range(len(t) - RUN + 1)}:
                    run = " ".join(x.split(" ", RUN)[:RUN])
                    rows.append((h, x, run, 0 if run in told else 1))      # a page counts once for each run
                    told.add(run)
            yield pd.DataFrame(rows, columns=["host", "suffix", "run", "pages"])
    rows = (streams.mapInPandas(suffixes, "host string, suffix string, run string, pages long")
            .groupBy("host", "run", "suffix").agg(F.sum("pages").alias("pages")))
    hosts = streams.groupBy("host").agg(F.count("*").alias("of"))
    return (shared_runs(rows).join(hosts, "host").where(F.col("pages") >= F.least(F.lit(PAGES), F.col("of"))).select("host", "run"))


def shared_runs(rows: DataFrame) -> DataFrame:
    """(host, run, pages): runs that more than one page has. rows: host, run, suffix, and the pages whose first suffix of the run it is."""
    def neighbours(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows in suffix order: the distinct pages of a run are those of its neighbouring suffixes together."""
        held = None                      # (host, run, pages)
        for pdf in batches:
            out = []
            for h, r, n in zip(pdf["host"], pdf["run"], pdf["pages"]):
                if held and held[:2] == (h, r):
                    held = (h, r, held[2] + n)
                else:
                    if held and held[2] > 1:
                        out.append(held)
                    held = (h, r, n)
            yield pd.DataFrame(out, columns=["host", "run", "pages"])
        if held and held[2] > 1:
            yield pd.DataFrame([held], columns=["host", "run", "pages"])
    return (rows.repartition("host", "run").sortWithinPartitions("host", "run", "suffix")
            .mapInPandas(neighbours, "host string, run string, pages long"))


class _Hashes(dict):
    """The crc32 of each token asked for; TOKENS are held."""

    def __missing__(self, token: str) -> int:
        if len(self) >= TOKENS:
            self.clear()
        self[token] = found = zlib.crc32(token.encode("utf-8", "surrogatepass"))
        return found


def run_bits(tokens: list[str], hashes: _Hashes, width: int) -> np.ndarray:
    """For each run of tokens a number below width, a power of two: some bits of its hash."""
    n = len(tokens) - RUN + 1
    if n < 1:
        return np.zeros(0, np.int64)
    one = np.fromiter(map(hashes.__getitem__, tokens), np.uint64, len(tokens))
    code = np.zeros(n, np.uint64)
    for i in range(RUN):
        code = (code + one[i:i + n]) * np.uint64(0x9E3779B97F4A7C15)
    return ((code >> np.uint64(32)) & np.uint64(width - 1)).astype(np.int64)


def by_host(rows: DataFrame, table: DataFrame, column: str, how: str) -> DataFrame:
    """rows with column (an array) of a written table of hosts, which is broadcast if it is small."""
    entries = table.agg(F.sum(F.size(column) + 1)).first()[0] or 0
    return rows.join(F.broadcast(table) if entries <= SMALL else table, "host", how)


def article_runs(articles: DataFrame) -> DataFrame:
    """(host, runs): the runs that stand in more than half of a host's distinct articles, and in PAGES at least.
    articles: host, main (blocks, a line each), copies included; a written table."""
    # A copy adds to the counts of its host's runs, but not to its host's articles: no run is missed for it.
    hosts = (articles.groupBy("host", F.xxhash64("main").alias("told")).agg(F.lit(1).alias("one")).groupBy("host").agg(F.count("*").alias("of"))
             .where(F.col("of") >= PAGES).select("host", F.greatest(F.lit(PAGES), F.floor(F.col("of") / 2) + 1).cast("long").alias("least")))
    # Wide enough that an article sets an eighth of the bits; that decides how much is sent, not what is found.
    mean = articles.agg(F.avg(F.char_length("main"))).first()[0] or 0
    width = 1 << min(20, max(10, int(np.ceil(np.log2(8 * mean / 5 + 1)))))

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, held = _Hashes(), {}

        def rows() -> pd.DataFrame:
            return pd.DataFrame([(h, zlib.compress(n.tobytes(), 1)) for h, n in held.items()], columns=["host", "counts"])
        for pdf in batches:
            for h, main in zip(pdf["host"], pdf["main"]):
                if h not in held:
                    if len(held) >= max(1, HOSTS * 4096 // width):
                        yield rows()
                        held = {}
                    held[h] = np.zeros(width, "<u4")
                held[h][np.unique(run_bits(stream_of(main.split("\n")), hashes, width))] += 1
        yield rows()

    def enough(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows in order of hosts: the bits that enough articles have."""
        held = None                      # [host, least, counts]
        for pdf in batches:
            out = []
            for h, least, counts in zip(pdf["host"], pdf["least"], pdf["counts"]):
                if not held or held[0] != h:
                    out.append(held)
                    held = [h, least, np.zeros(width, np.int64)]
                held[2] += np.frombuffer(zlib.decompress(counts), "<u4")
            yield bits(out)
        yield bits([held])

    def bits(done: list) -> pd.DataFrame:
        rows = [(x[0], x[1], np.flatnonzero(x[2] >= x[1]).tolist()) for x in done if x]
        return pd.DataFrame([r for r in rows if r[2]], columns=["host", "least", "bits"])
    can = written(articles.select("host", "main").mapInPandas(counted, "host string, counts binary").join(hosts, "host")
                  .repartition("host").sortWithinPartitions("host").mapInPandas(enough, "host string, least long, bits array<int>"), "bits")

    def suffixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = _Hashes()
        for pdf in batches:
            rows = []
            for h, least, told, main, some in zip(pdf["host"], pdf["least"], pdf["told"], pdf["main"], pdf["bits"]):
                t, seen = stream_of(main.split("\n")), set()
                at = np.flatnonzero(np.isin(run_bits(t, hashes, width), some))
                for x in sorted({" ".join(t[i:i + SUFFIX]) for i in at}):      # in order: copies give the same rows
                    run = " ".join(x.split(" ", RUN)[:RUN])
                    rows.append((h, least, told, x, run, 0 if run in seen else 1))
                    seen.add(run)
            yield pd.DataFrame(rows, columns=["host", "least", "told", "suffix", "run", "pages"])
    asked = by_host(articles.select("host", "main", F.xxhash64("main").alias("told")), can, "bits", "inner")
    rows = (asked.mapInPandas(suffixes, "host string, least long, told long, suffix string, run string, pages long")
            .groupBy("host", "run", "suffix", "told").agg(F.max("pages").alias("pages"))
            .groupBy("host", "run", "suffix").agg(F.sum("pages").alias("pages")))
    return written(shared_runs(rows).join(can.select("host", "least"), "host").where("pages >= least")
                   .groupBy("host").agg(F.collect_list("run").alias("runs")), "article-runs")


def without_runs(main: str, runs: set[str]) -> str:
    """The article (blocks, a line each) without these runs, or whole if hardly anything of it would stay."""
    blocks = main.split("\n")
    t = stream_of(blocks)
    kept = uncovered(blocks, (i for i in range(len(t) - RUN + 1) if " ".join(t[i:i + RUN]) in runs))
    left, of = (sum(len(b.split()) for b in x) for x in (kept, blocks))
    return main if left < (1 - COPIED) * of else "\n".join(kept)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of pages (page_id, url, html; other columns are ignored).

    Null and empty html give the empty text. A null or odd url belongs to the host without a name. Rows that share a page_id
    are pages of their own; for repetition pages of a host with the same text are one. An empty table gives no rows. No text is cut, however long.
    """
    prepare(pages.sparkSession)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        n = TaskContext.get().partitionId() << 40
        for pdf in batches:
            rows = []
            for page, url, source in zip(clean(pdf["page_id"]), clean(pdf["url"]), clean(pdf["html"])):
                main, loose, other = read_page(source)
                # The stream: tokens of the blocks that aren't an article's, a mark between blocks.
                stream = stream_of([*loose, *other])
                told = hashlib.sha1("\0".join(("\n".join(main), *stream)).encode("utf-8", "surrogatepass")).hexdigest() if main or stream else None
                rows.append((n, page, url, host_of(url), "\n".join(main), loose, stream, told))
                n += 1
            yield pd.DataFrame(rows, columns=["page", "page_id", "url", "host", "main", "loose", "tokens", "told"]).astype({"page_id": "Int64"})
    found = written(pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
                    .mapInPandas(read, "page long, page_id long, url string, host string, main string, loose array<string>, tokens array<string>, told string"), "pages", "zstd")
    # One page of each group of copies, those without text left out.
    distinct = found.where("told is not null").groupBy("host", "told").agg(F.min("page").alias("page")).select("page")
    runs = written(repeated_runs(found.join(distinct, "page", "left_semi").select("host", "tokens")), "runs")

    # Only pages without an article ask which of their runs are repeated.
    def asked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for h, p, loose in zip(pdf["host"], pdf["page"], pdf["loose"]):
                t = stream_of(loose)
                rows += [(h, p, i, " ".join(t[i:i + RUN])) for i in range(len(t) - RUN + 1)]
            yield pd.DataFrame(rows, columns=["host", "page", "i", "run"])
    covered = (found.where("size(loose) > 0").select("host", "page", "loose").mapInPandas(asked, "host string, page long, i int, run string")
               .join(runs, ["host", "run"], "left_semi").groupBy("page").agg(F.collect_list("i").alias("covered")))

    def opened(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = ["\n".join(uncovered(list(loose), starts if starts is not None else ())) for loose, starts in zip(pdf["loose"], pdf["covered"])]
            yield pdf[["page_id", "url"]].assign(text=out)

    # Articles lose the runs that more than half of their host's articles have.
    def closed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            known: dict[str, set[str]] = {}
            out = []
            for h, main, some in zip(pdf["host"], pdf["main"], pdf["runs"]):
                if some is not None and h not in known:
                    known[h] = set(some)
                out.append(main if some is None else without_runs(main, known[h]))
            yield pdf[["page_id", "url"]].assign(text=out)
    gone = article_runs(found.where("main != ''").select("host", "main"))
    open_pages = (found.where("size(loose) > 0").select("page", "page_id", "url", "loose").join(covered, "page", "left")
                  .mapInPandas(opened, "page_id long, url string, text string"))
    whole = (by_host(found.where("size(loose) = 0").select("page_id", "url", "host", "main"), gone, "runs", "left")
             .mapInPandas(closed, "page_id long, url string, text string"))
    return whole.unionByName(open_pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
