"""Main text of web pages by nearest-URL page differencing.

Pages of a host are ordered by URL path, and each is paired with the neighbour whose path
shares the longer beginning. Pages of a host with equal lines count as one page there, the one
of the first path, so that no page is paired with its copy. The lines of the two pages are aligned by longest common
subsequence, and shared lines, the host's template, are deleted. An exact check follows: what
the markup itself names as menu, header, footer, notice, advert, form or comment goes even
where it is not shared, and what it names as article stays even where it is, since hosts serve
one article under several addresses. Pages that name no article keep the lines left over, and
so do pages whose named article is short beside these.

Only line hashes travel for the pairing. Pages are put in order by range, so that a host with
a third of all pages is cut over many tasks.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakegate.llm.common import list_array, rows_at_most, table
from lakegate.plans.staging import stage

# Elements and names by the HTML standard and common usage.
_RAW = "script|style|iframe|textarea|title|noembed|noframes|xmp"
# What these hold is no text of the page, if they are closed; other elements may stand in them.
_HIDDEN = frozenset("svg object select canvas audio video template noscript datalist".split())
_SKIPPED = frozenset("head nav header footer aside form button dialog menu".split())
_BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section "
    "summary table tbody td tfoot th thead tr ul".split()
)
_CONTAINERS = frozenset(
    "article aside body button details dialog div dl fieldset figure footer form head header main menu nav ol "
    "section span table td tr ul".split()
) | _HIDDEN
_BOILERPLATE_NAMES = (
    r"(?:ads?|adverts?|advertisements?|advertising|sponsored|sponsor|promos?|promotion|banner|cookies?|"
    r"consent|gdpr|notices?|notification|alert|newsletter|subscribe|subscription|sidebar|side-bar|menu|navbar|nav|"
    r"navigation|breadcrumbs?|masthead|topbar|header|footer|comments?|disqus|replies|respond|share|sharing|social|"
    r"related|recommended|popup|modal|overlay|login|signup|search|pagination|pager|widget|toolbar|skip-link)"
)
_BOILERPLATE = re.compile(rf"(?:^|[\s_-]){_BOILERPLATE_NAMES}(?:$|[\s_-])")
_BOILERPLATE_WHOLE = re.compile(rf"(?<!\S){_BOILERPLATE_NAMES}(?!\S)")
_BESIDE = re.compile(r"(?<!\S)(?:with|without|has|no|is|show)[_-]\S+")
# An article inside one of these, if it is closed, is a teaser or a comment.
_SEALED = frozenset("aside nav footer".split())
_SEALED_ROLES = frozenset("navigation contentinfo complementary".split())
_BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu form".split())
_ARTICLE_NAMES = frozenset(
    "content main main-content article article-body article-content post post-body post-content entry "
    "entry-content story story-body".split()
)

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({_RAW})(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?>[^>\"']+|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*>|</?[a-zA-Z!?][^>]*\Z|</?\Z",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)

OPEN, ARTICLE, NAMED_BOILERPLATE = 0, 1, 2
# The open lines that are not shared stay beside a named article if they are so many times longer.
OUTWEIGHS = 2


def _kind(name: str, attributes: str, outer: int, sealed: bool) -> tuple[int, bool]:
    """What the inside of an element is, given what stands around it; whether it seals articles off.

    ``sealed`` says that a closed element around it does. Classes are judged word by word, ids
    as a whole: they may be the slug of a headline. An article's own names are not judged, nor
    are the ids of sections inside one.
    """
    marks: dict[str, str] = {}
    for key, *values in _ATTRIBUTE.findall(attributes):
        marks[key.lower()] = next((v for v in values if v), "").lower()
    role = marks.get("role")
    if name in ("article", "main") or role in ("main", "article"):
        return (NAMED_BOILERPLATE if sealed else ARTICLE), False  # also inside what was never closed
    # A name such as with-sidebar says what stands beside the text.
    classes, ids = (_BESIDE.sub(" ", marks.get(key, "")) for key in ("class", "id"))
    if outer == ARTICLE and (name == "section" or "section" in classes.split()):
        ids = ""
    whole = _BOILERPLATE_WHOLE.search(classes) or _BOILERPLATE_WHOLE.search(ids)
    if name != "body" and (whole or _BOILERPLATE.search(classes) or role in _BOILERPLATE_ROLES):
        return NAMED_BOILERPLATE, bool(whole) or name in _SEALED or role in _SEALED_ROLES
    if name == "header" and outer == ARTICLE:
        return ARTICLE, False
    if name in _SKIPPED:
        return NAMED_BOILERPLATE, name in _SEALED
    names = {*classes.split(), *ids.split()}
    if outer == OPEN and (marks.get("itemprop") == "articlebody" or _ARTICLE_NAMES & names):
        return ARTICLE, False
    return outer, False


def _closed(tags: list[tuple[str, bool]]) -> list[bool]:
    """For each start or end tag (name, whether it ends), whether it starts an element with an end of its own."""
    out, inside = [False] * len(tags), []
    counts: dict[str, int] = {}
    for i, (name, ends) in enumerate(tags):
        if not ends:
            inside.append(i)
            counts[name] = counts.get(name, 0) + 1
        elif counts.get(name):
            while True:
                last = inside.pop()
                counts[tags[last][0]] -= 1
                if tags[last][0] == name:
                    out[last] = True
                    break
    return out


def _is_empty(name: str, attributes: str) -> bool:
    """Whether a start tag with a slash is the whole element: not so for those that hide what they hold."""
    return attributes.endswith("/") and (name in ("svg", "math") or name not in _HIDDEN)


def lines(page: str | None) -> tuple[list[str], list[int]]:
    """The text blocks of a page in order, and what the markup says of each."""
    texts: list[str] = []
    kinds: list[int] = []
    inside: list[tuple[str, int, bool, bool]] = []
    held: list[str] = []
    kind, sealed, at = OPEN, False, 0

    def flush() -> None:
        text = " ".join(html.unescape("".join(held)).split())
        held.clear()
        if text:
            texts.append(text)
            kinds.append(kind)

    page = page or ""
    found = []
    for token in _TOKEN.finditer(page):
        closes, name, attributes = (token[2], token[3], token[4]) if token[3] else (token[5], token[6], token[7])
        name = "" if token[1] or not name else name.lower()
        found.append((token.start(), token.end(), closes, name, attributes))
    tags = [(t[3], bool(t[2])) for t in found if t[3] in _CONTAINERS and (t[2] or not _is_empty(t[3], t[4]))]
    closed = iter(_closed(tags))
    names: dict[str, int] = {}  # how many elements of a name are open
    hidden = 0  # how many open ones hide what they hold
    for start, end, closes, name, attributes in found:
        if not hidden:
            held.append(page[at:start])
        at = end
        if not name:
            continue
        if name in _BLOCKS and not hidden:
            flush()
        if name not in _CONTAINERS:
            continue
        if not closes:
            if _is_empty(name, attributes):
                continue
            has_end, now, seals = next(closed), kind, False
            hides = has_end and name in _HIDDEN
            if not hidden and name not in _HIDDEN:
                now, seals = _kind(name, attributes, kind, sealed)
                if now != kind:
                    flush()
            inside.append((name, kind, sealed, hides))
            names[name] = names.get(name, 0) + 1
            hidden += hides
            kind, sealed = now, (has_end and seals) or sealed
        else:
            next(closed)
            if not names.get(name):
                continue
            before = kind
            while True:
                last, outer, sealed, hid = inside.pop()
                names[last] -= 1
                hidden -= hid
                if last == name:
                    break
            if outer != before:
                kind, after = before, outer
                flush()
                kind = after
    if not hidden:
        held.append(page[at:])
    flush()
    return texts, kinds


def _rows_of_lcs(a: list[int], b: list[int]) -> list[int]:
    """Bit j of row i is 0 where a[:i + 1] and b[: j + 1] have one line more in common than with b[:j]."""
    where: dict[int, int] = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    row, out = full, []
    for x in a:
        hit = row & where.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
        out.append(row)
    return out


_BITS_HELD = 1 << 27


def shared(a: list[int], b: list[int]) -> list[int]:
    """Positions in ``a`` of one longest common subsequence with ``b``."""
    start, limit = 0, min(len(a), len(b))
    while start < limit and a[start] == b[start]:
        start += 1
    end = 0
    while end < limit - start and a[-1 - end] == b[-1 - end]:
        end += 1
    middle = a[start : len(a) - end], b[start : len(b) - end]
    inner = _shared_middle(*middle) if middle[0] and middle[1] else []
    return [*range(start), *(start + i for i in inner), *range(len(a) - end, len(a))]


def _shared_middle(a: list[int], b: list[int]) -> list[int]:
    if len(a) > 1 and len(a) * len(b) > _BITS_HELD:
        # Too large to hold all rows: cut both where the two halves have most in common.
        half = len(a) // 2
        one, width = (1 << len(b)) - 1, len(b)
        head, tail = _last_row(a[:half], b) ^ one, _last_row(a[half:][::-1], b[::-1]) ^ one
        before = np.concatenate(([0], np.cumsum(_bits(head, width))))
        after = np.concatenate(([0], np.cumsum(_bits(tail, width))))[::-1]
        cut = int(np.argmax(before + after))
        return [*shared(a[:half], b[:cut]), *(half + i for i in shared(a[half:], b[cut:]))]
    rows = _rows_of_lcs(a, b)
    i, j, out = len(a) - 1, len(b) - 1, []
    while i >= 0 and j >= 0:
        if rows[i] >> j & 1:
            j -= 1
        elif i and not rows[i - 1] >> j & 1:
            i -= 1
        else:
            out.append(i)
            i, j = i - 1, j - 1
    return out[::-1]


def _last_row(a: list[int], b: list[int]) -> int:
    row = (1 << len(b)) - 1
    full, where = row, {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    for x in a:
        hit = row & where.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
    return row


def _bits(number: int, width: int) -> np.ndarray:
    raw = number.to_bytes((width + 7) // 8, "little")
    return np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little")[:width]


def _line_hashes(host: str, texts: list[str]) -> tuple[np.ndarray, int]:
    """A hash of each line, and one of the host with all of them, equal for copies."""
    own = [xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")) for t in texts]
    hashes = np.array(own, np.uint64).view(np.int64)
    key = xxhash.xxh3_64(host.encode("utf-8", "surrogatepass"))
    key.update(b"\0" + hashes.tobytes())
    return hashes, key.intdigest() - (1 << 63)


def _hash_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows_at_most(batches, 256):
        keys, hashes, counts = [], [], []
        for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            own, key = _line_hashes(host, lines(page)[0])
            keys.append(key)
            hashes.append(own)
            counts.append(len(own))
        flat = np.concatenate(hashes) if hashes else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(keys, pa.int64()),
                batch.column("host"),
                batch.column("path"),
                list_array(counts, pa.array(flat)),
            ],
            names=["key", "host", "path", "lines"],
        )


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each line of a page, whether it is shared with the other page; how many it shares."""
    for batch in rows_at_most(batches, 1024):
        marks, counts = [], []
        columns = (batch.column(c).to_pylist() for c in ("lines", "other", "copied"))
        for own, other, copied in zip(*columns):
            mark = np.zeros(len(own), bool)
            if own and other:
                mark[shared(own, other)] = True
            marks.append(mark)
            counts.append(len(own) if copied else int(mark.sum()))
        flat = np.concatenate(marks) if marks else np.empty(0, bool)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("key"),
                list_array([len(m) for m in marks], pa.array(flat)),
                pa.array(counts, pa.int32()),
            ],
            names=["key", "shared", "count"],
        )


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of a page that may be its text: those of the named article and the open ones.

    The open ones are left out where they could not outweigh the article, even if none is shared.
    """
    for batch in rows_at_most(batches, 256):
        keys, texts, places, counts, named = [], [], [], [], []
        for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            found, kinds = lines(page)
            keys.append(_line_hashes(host, found)[1])
            size = [sum(len(t) for t, k in zip(found, kinds) if k == kind) for kind in (OPEN, ARTICLE)]
            wanted = (OPEN, ARTICLE) if size[0] > OUTWEIGHS * size[1] else (ARTICLE,)
            own = [i for i, kind in enumerate(kinds) if kind in wanted]
            texts += [found[i] for i in own]
            places += own
            counts.append(len(own))
            named += [kinds[i] == ARTICLE for i in own]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row"),
                pa.array(keys, pa.int64()),
                list_array(counts, pa.array(named, pa.bool_())),
                list_array(counts, pa.array(texts, pa.string())),
                list_array(counts, pa.array(places, pa.int32())),
            ],
            names=["row", "key", "named", "texts", "places"],
        )


def _host() -> Column:
    address = F.coalesce(F.col("url"), F.lit(""))
    return F.lower(F.regexp_extract(address, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))


def template_lines(pages: DataFrame) -> DataFrame:
    """One row per host and list of lines: key, shared and count.

    ``shared`` says of each line whether the nearest page of the host with other lines has it
    too, ``count`` how many lines the nearest page has too: all, if the host has a copy.
    """
    address = F.coalesce(F.col("url"), F.lit(""))
    slim = pages.select(
        _host().alias("host"),
        F.regexp_extract(address, r"^(?:(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*)?(.*)$", 1).alias("path"),
        "html",
    )
    hashed = slim.mapInArrow(_hash_lines, "key long, host string, path string, lines array<long>")
    different = hashed.groupBy("key").agg(
        F.first("host").alias("host"),
        F.min("path").alias("path"),
        F.first("lines").alias("lines"),
        (F.count(F.lit(1)) > 1).alias("copied"),
    )
    different = stage(different, "page-lines")
    # A page without lines tells nothing of another. Addresses can be long; the splitters hold
    # their beginnings only.
    ordered = different.where(F.size("lines") > 0).select("key", "host", "path")
    ordered = ordered.repartitionByRange("host", F.substring("path", 1, 64), "key")
    ordered = ordered.sortWithinPartitions("host", F.substring("path", 1, 64), "path", "key")
    placed = stage(ordered.withColumn("at", F.monotonically_increasing_id()), "page-order")
    part = F.shiftright("at", 33)
    # One row per range: where the next range that has rows begins.
    ends = placed.groupBy(part.alias("part")).agg(F.min("at").alias("first"), F.max("at").alias("last"))
    ends = ends.select("last", F.lead("first").over(Window.orderBy("part")).alias("jump"))
    chain = placed.join(ends, F.col("at") == F.col("last"), "left").withColumn(
        "next", F.when(F.col("last").isNull(), F.col("at") + 1).otherwise(F.col("jump"))
    )
    after = placed.select(*(F.col(c).alias(f"n_{c}") for c in ("at", "host", "path", "key")))
    pairs = chain.join(after, (F.col("next") == F.col("n_at")) & (F.col("host") == F.col("n_host")))
    alike = F.char_length(_common_start("path", "n_path"))

    def side(key: str, other: str, before: bool) -> Column:
        values = {"key": F.col(key), "with": F.col(other), "alike": alike, "before": F.lit(before)}
        return F.struct(*(v.alias(k) for k, v in values.items()))

    both = F.array(side("key", "n_key", False), side("n_key", "key", True))
    pairs = pairs.select(F.inline(both))
    # The neighbour with the longer common beginning; of two alike, the one before.
    best = pairs.groupBy("key").agg(F.max(F.struct("alike", "before", "with"))["with"].alias("with"))
    own = different.select("key", "lines", "copied").join(best, "key", "left")
    other = different.select(F.col("key").alias("with"), F.col("lines").alias("other"))
    met = own.join(other, "with", "left").select("key", "lines", "other", "copied")
    return met.mapInArrow(_align, "key long, shared array<boolean>, count int")


def _common_start(a: str, b: str) -> Column:
    """The path segments that two paths begin with."""
    cut = [F.split(F.col(c), "/") for c in (a, b)]
    same = F.zip_with(cut[0], cut[1], lambda x, y: F.when(x == y, x))
    differs = F.array_position(F.transform(same, lambda x: x.isNull()), F.lit(True))
    count = F.when(differs > 0, differs - 1).otherwise(F.size(same)).cast("int")
    return F.array_join(F.slice(cut[0], F.lit(1), count), "/")


def extract(pages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The rows of ``pages`` with ``text``, the main text ("" if there is none), and ``shared_lines``.

    ``shared_lines`` counts the page's lines that its nearest page has too: all, where the host
    has a copy of it. Its text is told by the nearest page with other lines. Null html counts
    as empty. Rows without a url form a host of their own. A page alone on its host, but for
    copies, is not paired. Rows that repeat in full get one text each. An empty table gives no rows. Columns
    of ``pages`` with the names of the two are replaced; the others, or those in ``keep``, are
    carried along.
    """
    own = [c for c in (keep or pages.columns) if c not in ("text", "shared_lines")]
    found = template_lines(pages).withColumnRenamed("key", "_key")
    rows = pages.select(F.struct(*own).alias("row"), _host().alias("host"), "html")
    schema = T.StructType(
        [
            rows.schema["row"],
            T.StructField("key", T.LongType()),
            T.StructField("named", T.ArrayType(T.BooleanType())),
            T.StructField("texts", T.ArrayType(T.StringType())),
            T.StructField("places", T.ArrayType(T.IntegerType())),
        ]
    )
    split = rows.mapInArrow(_split, schema).join(found, F.col("key") == F.col("_key"), "left")

    def article(text: Column, number: Column) -> Column:
        return F.get(F.col("named"), number)

    def unshared(text: Column, number: Column) -> Column:
        gone = F.get(F.col("shared"), F.get(F.col("places"), number))
        return ~article(text, number) & ~F.coalesce(gone, F.lit(False))

    def length(texts: Column) -> Column:
        return F.aggregate(texts, F.lit(0).cast("long"), lambda n, text: n + F.char_length(text))

    outweighs = length(F.filter("texts", unshared)) > OUTWEIGHS * length(F.filter("texts", article))
    split = split.withColumn("outweighs", outweighs)
    return split.select(
        "row.*",
        F.array_join(
            F.filter("texts", lambda t, i: article(t, i) | (F.col("outweighs") & unshared(t, i))), "\n"
        ).alias("text"),
        F.coalesce("count", F.lit(0)).alias("shared_lines"),
    )


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages, keep=["page_id", "url"]).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "shared_lines"
    )


QUERIES = {"op2_html_text": (op2_html_text, None)}
