"""Main text of web pages: markup where it says what a part is, suffixes of each host's pages where it doesn't.

Text inside an `article` or `main` element is the page's main text; text in menus, headers, footers, asides, forms,
adverts, notices and comments is not, wherever it is. Pages without text in such an element leave the rest open. What the
host repeats decides open text, and notices that main text holds without markup: the tokens of all pages of a host, whole,
are laid one after the other, and where `RUN` tokens or more in a row begin on distinct pages, they are a repeated run. A
repeated run is boilerplate and the tokens it covers go, unless it is main text somewhere: articles may share passages. Then
half of the host's pages, `COMMON` at least, must have it there.

Most suffixes cannot matter: their first `RUN` tokens come once, or only in main text and not on half of the pages. Tasks count
these under keys in a first pass, as phrases are (`phrases`), with weights so that the keys of all others reach `LEVEL`; a bit
table of bounded size then lets those through, and a few by chance. Spark sorts what is let through, the suffixes of each host by their first `DEPTH` tokens, equal ones of a task as one row, so a menu
of any number of pages is a few rows from each task. Each row of this suffix array gets the tokens it shares with the row
above; rows in a row that share `RUN` or more are an interval, a repeated run if its least and greatest page differ. An
interval that goes on in the next task's range is put together by its first tokens.

Repetition alone would drop passages that articles share and keep menus and footers that differ by page, hence the markup.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from lumisift.llm import phrases
from lumisift.llm.byte_pieces import small
from lumisift.llm.byte_words import Keys, mixed
from lumisift.llm.stored import stored

#: Tokens of a repeated run, and tokens that suffixes are sorted by.
RUN, DEPTH = 6, 12
#: A run in main text is boilerplate if it is there on half of the host's pages, and on so many.
COMMON = 10
#: What the tokens of a page are.
ELSEWHERE, OPEN, MAIN_TEXT = 0, 1, 2
_KINDS = {"main": MAIN_TEXT, "open": OPEN}
#: Bits of a key, and of the table of keys: a quarter of the pages' bytes, within bounds. These and the classes of hosts by a
#: hash, each with the size of its smallest, bound memory only: they decide how many suffixes are let through by chance.
KEY_BITS, LEAST_BITS, MOST_BITS, CLASSES = 34, 1 << 20, 1 << 29, 1 << 18
#: Copies of a run that goes, which may be on all pages of a host.
SALTS = 16
#: What the weights of a key add up to if it may matter.
LEVEL = 1 << 20
#: Elements of HTML by what their text is, and words of classes and ids that say so.
NEVER = set("script style noscript template head title iframe svg math object canvas audio video select textarea button form datalist".split())
CHROME = set("nav header footer aside dialog menu".split())
MAIN = {"article", "main"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
WORDS = set(
    "ad ads advert advertisement adverts banner sponsor sponsored promo promotion cookie cookies consent gdpr notice popup modal overlay nav navbar "
    "navigation menu breadcrumb breadcrumbs sidebar comment comments disqus respond share sharing social related newsletter subscribe login signup "
    "footer header masthead pagination pager widget toolbar".split()
)
#: Elements whose name says what they are, or may.
_TELLING = NEVER | CHROME | MAIN | set("h1 h2 h3 h4 h5 h6".split())
#: Between the tokens of a suffix: white space, which no token has.
SEPARATOR = b"\x1f"
#: Elements that end when another begins: their name, the names that end them, and those that shield them.
_BLOCKS = set(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "li main menu nav ol p pre section table ul".split()
)
_ENDED_BY = (
    ("p", _BLOCKS, set("table td th caption button object template".split())),
    ("li", {"li"}, set("ul ol menu dir table td th section article aside nav main".split())),
    *((name, {"dt", "dd"}, set("dl table td th section article aside nav main".split())) for name in ("dt", "dd")),
    *((name, set("td th tr tbody thead tfoot".split()), {"table"}) for name in ("td", "th")),
    ("tr", set("tr tbody thead tfoot".split()), {"table"}),
    *((name, set("tbody thead tfoot".split()), {"table"}) for name in ("tbody", "thead", "tfoot")),
    ("option", {"option", "optgroup"}, {"select", "datalist"}),
)
_ENDS = {tag: [(name, shields) for name, by, shields in _ENDED_BY if tag in by] for tag in set().union(*(by for _, by, _ in _ENDED_BY))}
_PART = re.compile(r"<!--(?:(?!>|->).*?(?:-->|\Z)|-?>)|<[!?][^>]*>|</?([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|</[^a-zA-Z][^>]*>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def _zone(tag: str, attributes: str, outer: str, in_article: bool) -> str:
    """What the text of an element is: main, chrome, never (not shown) or open, given what is around it."""
    if outer == "never" or tag in NEVER:
        return "never"
    if not attributes.strip("/ \t\r\n"):
        kind = {}
    else:
        kind = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
    if "hidden" in kind or kind.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", kind.get("style", "")):
        return "never"
    if outer == "chrome":
        return "title" if outer == "chrome" and in_article and re.fullmatch("h[1-6]", tag) else "chrome"
    if tag in CHROME or kind.get("role") in ROLES:
        return "chrome"
    if tag not in ("html", "body", "main") and (kind.get("class") or kind.get("id")):
        names = {w.lower() for w in _NAMES.findall(f"{kind.get('class', '')} {kind.get('id', '')}")}
        if names & WORDS:
            return "chrome"
    if tag in MAIN or kind.get("role") == "main":
        return "main"
    return outer


def parts(page: str | None) -> list[tuple[str, str]]:
    """Texts of a page in order with what they are (main, chrome or open); white space marks the ends of blocks."""
    out: list[tuple[str, str]] = []
    stack: list[tuple[str, tuple]] = []  # open elements and what is around them
    held: dict[str, int] = {}  # how many of each are open
    zone, at, page = "open", 0, page or ""
    in_article = article_header = False
    position = 0
    while True:
        m = _PART.search(page, position)
        text = page[at : m.start() if m else len(page)]
        if text and zone != "never":
            out.append(("main" if zone == "title" else zone, html.unescape(text)))
        if not m:
            return out
        at = position = m.end()
        tag = m[1].lower() if m[1] else ""
        if not tag:
            continue
        if tag in BLOCK:
            out.append(("main" if zone == "title" else zone if zone != "never" else "open", " "))
        closing = page[m.start() + 1] == "/"
        for name, shields in ((tag, ()),) if closing else _ENDS.get(tag, ()):
            if held.get(name) and (depth := _innermost(stack, name, shields)) is not None:
                zone, in_article, article_header = stack[depth][1]
                for other, _ in stack[depth:]:
                    held[other] -= 1
                del stack[depth:]
        if closing:
            continue
        if tag in ("script", "style"):  # their content is not markup
            end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = position = end.end() if end else len(page)
        elif tag not in VOID and not m[2].endswith("/"):
            stack.append((tag, (zone, in_article, article_header)))
            held[tag] = held.get(tag, 0) + 1
            if not m[2] and tag not in _TELLING:
                continue
            was = zone
            zone = _zone(tag, m[2], zone, article_header)
            in_article = in_article or (zone == "main" and tag in MAIN)
            article_header = article_header or (tag == "header" and was == "main" and zone == "chrome")


def _innermost(stack: list[tuple[str, tuple]], name: str, shields: set[str] | tuple) -> int | None:
    """The place of the innermost open element of a name, if no shield is open inside it."""
    for i in range(len(stack) - 1, -1, -1):
        if stack[i][0] == name:
            return i
        if stack[i][0] in shields:
            return None
    return None


def marked(page: str | None) -> tuple[list[str], np.ndarray]:
    """All tokens of a page in order, and what markup says that they are."""
    found = parts(page)
    words, kinds, sizes = [], [], []
    i = 0
    while i < len(found):
        j = i
        while j < len(found) and found[j][0] == found[i][0]:
            j += 1
        own = "".join([t for _, t in found[i:j]]).split()
        words += own
        kinds.append(_KINDS.get(found[i][0], ELSEWHERE))
        sizes.append(len(own))
        i = j
    return words, np.repeat(np.array(kinds, np.int8), np.array(sizes, np.int64))


def tokens(page: str | None) -> tuple[str | None, list[str], np.ndarray]:
    """The main text of a page by its markup, or None if no element says which it is; all its tokens, and which are open."""
    words, kinds = marked(page)
    main = " ".join(w for w, kind in zip(words, kinds, strict=True) if kind == MAIN_TEXT) if (kinds == MAIN_TEXT).any() else None
    return main, words, kinds == OPEN


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


@dataclass
class _Laid:
    """The tokens of some pages one after the other, as text with `SEPARATOR` behind each, and their runs: the tokens with
    which they begin, keys by host, and whether they are main text and have to do with what is to be decided."""

    text: bytes
    start: np.ndarray
    end: np.ndarray
    page: np.ndarray
    at: np.ndarray
    keys: np.ndarray
    written: np.ndarray
    asks: np.ndarray

    @classmethod
    def of(cls, hosts: list[str], pages: list[str | None]) -> _Laid:
        found = [marked(page) for page in pages]
        text = SEPARATOR.decode().join([w for words, _ in found for w in words] + [""]).encode("utf-8", "replace")
        page = np.repeat(np.arange(len(pages)), [len(words) for words, _ in found])
        kinds = np.concatenate([np.zeros(0, np.int8), *(kinds for _, kinds in found)])
        letters = np.frombuffer(text, np.uint8)
        end = np.flatnonzero(letters == SEPARATOR[0])
        start = np.append(0, end + 1)[: len(end)]
        at = np.arange(max(0, len(page) - RUN + 1))
        at = at[page[at] == page[at + RUN - 1]]
        salt = np.array([xxhash.xxh3_64_intdigest(host) for host in hosts], np.uint64)[page[at]]
        own = Keys(8)
        keys = mixed(own.spans(own.running(letters), start[at], end[at + RUN - 1]) + salt) >> np.uint64(64 - KEY_BITS)
        many = lambda kind: np.diff(np.append(0, np.cumsum(kinds == kind))[np.stack([at, at + RUN])], axis=0)[0]
        written, has_main = many(MAIN_TEXT) == RUN, np.zeros(len(pages), bool)
        has_main[page[kinds == MAIN_TEXT]] = True
        return cls(text, start, end, page, at, keys, written, np.where(has_main[page[at]], written, many(OPEN) > 0))


def host_sizes(pages: DataFrame) -> DataFrame:
    """`host, all` of pages `id, url`: the number of a host's pages."""

    @pandas_udf("string")
    def host(urls: pd.Series) -> pd.Series:
        return urls.map(host_of, na_action=None)

    return pages.select(host("url").alias("host"), "id").groupBy("host").agg(F.count_distinct("id").alias("all"))


def _class(host: str) -> int:
    return xxhash.xxh3_64_intdigest(host) % CLASSES


def keys_that_matter(pages: DataFrame) -> np.ndarray:
    """A bit table that holds the keys of all runs of the pages `id, version, url, html` that come twice or more, not only
    in main text, or on half of a host's pages, `COMMON` at least."""
    size = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    shares = -(-size // phrases.SHARE) or 1

    @pandas_udf("int")
    def klass(hosts: pd.Series) -> pd.Series:
        return hosts.map(_class)

    smallest = host_sizes(pages).groupBy(klass("host").alias("class")).agg(F.min("all").alias("all")).toArrow()  # CLASSES rows at most
    wanted = np.full(CLASSES, COMMON, np.int64)
    wanted[smallest["class"].to_numpy()] = np.maximum(COMMON, -(-smallest["all"].to_numpy() // 2))
    weights = np.maximum(1, LEVEL >> np.log2(wanted).astype(np.int64)).astype(np.int32)  # few different ones
    shared = pages.sparkSession.sparkContext.broadcast(weights)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, weight = phrases.Sums(LEVEL, shares, KEY_BITS), shared.value
        for batch in small(batches, 100):
            hosts = [host_of(x) for x in batch.column(0).to_pylist()]
            laid = _Laid.of(hosts, batch.column(1).to_pylist())
            own = weight[np.array([_class(host) for host in hosts], np.int64)][laid.page[laid.at]]
            sums.add(laid.keys, np.where(laid.written, own, np.int32(LEVEL - 1)))
            yield from sums.hand_on()
        yield from sums.hand_on(all_of_it=True)

    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (size // 4).bit_length()))
    table, _ = phrases.bit_table(pages.select("url", "html").mapInArrow(count, phrases.COUNTED), LEVEL, bits)
    shared.destroy()
    return table


def suffixes(pages: DataFrame, matter: Broadcast | None = None) -> DataFrame:
    """`host, start, key, suffix, id, version, asks, written` of pages `id, version, url, html`: every suffix of their tokens
    that is `RUN` long and whose run the table of those that matter, if given, lets through, up to `DEPTH` tokens, and its first
    `RUN` as a hash of 64 bits; `written` if those are main text, `asks` if they have to do with what is to be decided."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = phrases.Tables([matter]) if matter is not None else None
        for batch in small(batches, 100):
            ids, versions, urls, htmls = (c.to_pylist() for c in batch.columns)
            hosts = [host_of(url) for url in urls]
            laid = _Laid.of(hosts, htmls)
            on = tables.holds(1, laid.keys) if tables else np.ones(len(laid.at), bool)
            at = laid.at[on]
            page = laid.page[at]
            last = np.searchsorted(laid.page, page, "right") - 1
            spans = zip(laid.start[at].tolist(), laid.end[at + RUN - 1].tolist(), laid.end[np.minimum(at + DEPTH - 1, last)].tolist(), strict=True)
            both = [(laid.text[a:b], laid.text[a:c]) for a, b, c in spans]
            columns = [
                pa.array([hosts[i] for i in page], pa.string()), pa.array(at - np.searchsorted(laid.page, page), pa.int32()),
                pa.array([xxhash.xxh3_64_intdigest(run) - (1 << 63) for run, _ in both], pa.int64()), pa.array([x for _, x in both], pa.binary()),
                pa.array([ids[i] for i in page], pa.int64()), pa.array([versions[i] for i in page], pa.int64()), pa.array(laid.asks[on]), pa.array(laid.written[on]),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["host", "start", "key", "suffix", "id", "version", "asks", "written"])

    return pages.mapInArrow(run, "host string, start int, key bigint, suffix binary, id bigint, version bigint, asks boolean, written boolean")


def suffix_array(found: DataFrame) -> DataFrame:
    """`host, suffix, key, a, b, rank, common`: the distinct suffixes of each host in order, the least and greatest page
    that has them, their rank, and the tokens shared with the one above in the same task's range, 0 for its first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        host, above = None, []
        for batch in batches:
            common = []
            for own, suffix in zip(batch.column("host").to_pylist(), batch.column("suffix").to_pylist(), strict=True):
                words = suffix.split(SEPARATOR)
                common.append(next((i for i, (x, y) in enumerate(zip(above, words)) if x != y), min(len(above), len(words))) if own == host else 0)  # noqa: B905
                host, above = own, words
            yield batch.append_column("common", pa.array(common, pa.int32()))

    distinct = found.groupBy("host", "suffix", "key").agg(F.min("id").alias("a"), F.max("id").alias("b"))
    distinct = stored(distinct, "distinct")  # ranges are chosen from it before it is sorted
    ranked = distinct.repartitionByRange("host", "suffix").sortWithinPartitions("host", "suffix").withColumn("rank", F.monotonically_increasing_id())
    return ranked.mapInArrow(run, "host string, suffix binary, key bigint, a bigint, b bigint, rank bigint, common int")


def repeated_runs(array: DataFrame) -> DataFrame:
    """`host, key` of the intervals of a suffix array that share `RUN` tokens and come from several pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        interval = None
        for batch in batches:
            done = []
            for host, key, a, b, common in zip(*(batch.column(n).to_pylist() for n in ("host", "key", "a", "b", "common")), strict=True):
                if interval and common >= RUN:
                    interval = (host, interval[1], min(a, interval[2]), max(b, interval[3]))
                    continue
                if interval:
                    done.append(interval)
                interval = (host, key, a, b)
            yield _intervals(done)
        if interval:
            yield _intervals([interval])

    pieces = array.mapInArrow(run, "host string, key bigint, a bigint, b bigint")
    return pieces.groupBy("host", "key").agg(F.min("a").alias("a"), F.max("b").alias("b")).where("a <> b").select("host", "key")


def _intervals(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"host": pa.string(), "key": pa.int64(), "a": pa.int64(), "b": pa.int64()}
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds.values())], list(kinds))


def boilerplate(found: DataFrame, pages: DataFrame) -> DataFrame:
    """`host, key` of the repeated runs among suffixes that are no main text anywhere, or that of half of the host's pages,
    `COMMON` at least."""
    written = found.where("written").groupBy("host", "key").agg(F.count_distinct("id").alias("pages"))
    common = written.where(F.col("pages") >= COMMON).join(host_sizes(pages), "host").where("2 * pages >= all").select("host", "key", F.lit(True).alias("common"))
    runs = repeated_runs(suffix_array(found)).join(written, ["host", "key"], "left").join(common, ["host", "key"], "left")
    return runs.where("pages is null or common").select("host", "key")


def main_text(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Id, url, main text and its number of characters of every page.

    A null page has an empty text, a null url is a host of its own. Rows with equal id and page count as one page, a
    null id as one id. Other columns are left out; an empty table gives no rows.
    """
    pages = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-1)).alias("id"), F.xxhash64(html_col).alias("version"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    matter = df.sparkSession.sparkContext.broadcast(keys_that_matter(pages))  # MOST_BITS at most
    found = stored(suffixes(pages, matter), "suffixes")
    matter.destroy()
    salt = F.pmod(F.xxhash64("id", "version"), F.lit(SALTS)).cast("int").alias("salt")
    asking = found.where("asks").select("host", "key", "start", "id", "version", salt)
    gone = boilerplate(found, pages).select("host", "key", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    covered = asking.join(gone, ["host", "key", "salt"]).groupBy("id", "version").agg(F.collect_set("start").alias("covered"))  # a page's own
    covered = stored(covered, "covered").withColumnsRenamed({"id": "__id", "version": "__version"})

    @pandas_udf("string")
    def text(pages: pd.Series, covered: pd.Series) -> pd.Series:
        out = []
        for page, starts in zip(pages, covered, strict=True):
            words, kinds = marked(page)
            keep = kinds == (MAIN_TEXT if (kinds == MAIN_TEXT).any() else OPEN)
            for i in starts if starts is not None else ():
                keep[i : i + RUN] = False
            out.append(" ".join(w for w, k in zip(words, keep, strict=True) if k))
        return pd.Series(out, dtype=object)

    own = df.select(F.col(id_col).alias("page"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    key = F.coalesce(F.col("page").cast("long"), F.lit(-1))
    both = own.join(covered, (key == F.col("__id")) & (F.xxhash64("html") == F.col("__version")), "left")
    made = both.select(F.col("page").alias(id_col), F.col("url").alias(url_col), text("html", "covered").alias("text"))
    return made.withColumn("n_chars", F.length("text").cast("long"))
