"""Main text of web pages: markup structure, and a host-wide search for repeated token runs.

A page is read into blocks of text. Blocks inside menus, headers, footers, asides, forms, adverts,
notices, reader comments and the like are junk. The whole token stream of every page, outside its article and inside it, is
searched for long runs that a share of the host's distinct pages has (prefix doubling over the host's suffixes, see ``runs``, of
the windows that pass a filter, see ``windows``). A page that marks no article keeps the other runs of its blocks that are no
junk, since what its host repeats is boilerplate. Where a page marks its article (or its main part), the text is that part's
other blocks, without the runs that the host repeats inside and outside its articles: what only articles repeat is a quote.
Copies of a page count as one page, so they keep their text, and copies of an article count as one.
"""

from __future__ import annotations

import re
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterstone.llm.common import stored, tidied
from quarterstone.llm.runs import repeated_windows
from quarterstone.llm.windows import frequent_tokens

LONG = 8  # tokens of a run from which on its repetition counts
LEAST_PAGES = 3  # distinct page contents of a host that a run of boilerplate is on, at least
SHARE = 0.02  # of the host's distinct page contents

# fixed values: names in the HTML standard, and words that pages use for parts that are not content
RAW = "script style noscript template textarea select iframe object svg math title audio video canvas".split()
BLOCKS = set("""address article aside blockquote body br dd details dialog div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr
    ul caption center option""".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
JUNK_TAGS = set("nav footer aside form button dialog menu fieldset".split())
JUNK_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
JUNK_WORDS = set("""ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies
    consent gdpr notice notices notification alert sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header
    masthead comment comments commentlist disqus respond reply replies share sharing social related recommended subscribe
    newsletter signup login popup modal overlay widget toolbar pagination pager skip""".split())
# words that make a class name say what an element has or how it stands, not what it is: has-sidebar, comments-open
STATES_BEFORE = set("has with without no not is hide hides show shows js".split())
STATES_AFTER = set("open closed enabled disabled on off active allowed visible count".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(?P<raw>" + "|".join(RAW) + r")\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][\w:-]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*+)(?:>|\Z)",
    re.S | re.I)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def is_junk(tag: str, attrs: str) -> bool:
    if tag in JUNK_TAGS:
        return True
    for name, a, b, c in ATTRIBUTE.findall(attrs) if attrs.strip(" /") else ():
        name, value = name.lower(), a or b or c
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
        if name == "role" and value.lower() in JUNK_ROLES:
            return True
        if name in ("class", "id") and tag not in ("article", "main") and any(map(names_junk, value.split())):
            return True
    return False


def names_junk(name: str) -> bool:
    """Whether a class name or id stands for a part that is not content."""
    words = [w.lower() for w in PART.findall(name)]
    return not (JUNK_WORDS.isdisjoint(words) or words[0] in STATES_BEFORE or words[-1] in STATES_AFTER)


def blocks(html: str) -> list[tuple[str, bool, bool]]:
    """(text, in article or main part, junk) of each block in page order.

    Unclosed elements are tolerated: only containers are followed, an end tag without a start does
    nothing, and an article's start ends a junk element that was left open before it, unless that
    one holds reader comments or is inside the article itself.
    """
    out: list[tuple[str, bool, bool]] = []
    text: list[str] = []
    marked, main = 0, 0  # open article and main elements
    junk: list[str] = []  # tags of nested equal junk elements; the first decides
    holds_comments = junk_inside = False
    inner = 0  # articles opened inside the junk
    heading = 0
    header = 0  # open header elements of an article; only their headings are content
    at = 0

    def flush():
        if text:
            words = unescape("".join(text)).split()
            if words:
                out.append((" ".join(words), marked > 0 or main > 0, bool(junk) or bool(header and not heading)))
            text.clear()

    for m in MARKUP.finditer(html):
        if m.start() > at:
            text.append(html[at:m.start()])
        at = m.end()
        if m.group().startswith("<![CDATA["):
            text.append(m.group()[9:].removesuffix("]]>"))
            continue
        tag = (m["tag"] or "").lower()
        if not tag:
            if m["raw"]:
                text.append(" ")
            continue
        if tag not in BLOCKS and tag not in JUNK_TAGS and not junk and tag not in ("span", "section"):
            continue
        attrs, closing = m["attrs"], bool(m["end"])
        if tag in BLOCKS:
            flush()
        if tag in HEADINGS:
            heading = 0 if closing else 1
        if junk:
            if tag in ("article", "main") and not closing and not junk_inside and not holds_comments and not is_junk(tag, attrs):
                junk.clear()
            elif tag in ("article", "main") and tag != junk[0] and (not closing or inner):
                inner += -1 if closing else 1
                continue
            elif tag == junk[0] and tag not in VOID:
                if closing:
                    flush()
                    junk.pop()
                elif not attrs.endswith("/"):
                    junk.append(tag)
                continue
            elif closing and tag in ("article", "main") and junk_inside:
                junk.clear()
            else:
                continue
        if closing:
            if tag == "article":
                marked, header = max(0, marked - 1), 0
            elif tag == "main":
                main = max(0, main - 1)
            elif tag == "header":
                header = max(0, header - 1)
            continue
        if tag in VOID or attrs.endswith("/"):
            continue
        if tag == "header" and marked:
            header += 1
        elif tag == "header" or is_junk(tag, attrs) and tag not in ("body", "html"):
            flush()
            junk.append(tag)
            inner = 0
            holds_comments = "comment" in attrs.lower() or "disqus" in attrs.lower()
            junk_inside = marked > 0 or main > 0
        elif tag == "article":
            marked += 1
        elif tag == "main":
            main += 1
    if at < len(html):
        text.append(html[at:])
    flush()
    return out


def block_key(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _article_batches(batches):
    """Text of the pages that mark their article, without the blocks and the tokens that are boilerplate of their host."""
    for batch in batches:
        out = []
        for page_id, url, inside, gone, cut in zip(*(batch.column(k).to_pylist() for k in range(5))):
            if gone or cut:
                gone, cut, at, kept = set(gone or []), set(cut or []), 0, []
                for block in inside:
                    tokens = block.split(" ")
                    if block_key(block) not in gone:
                        kept += [t for i, t in enumerate(tokens, at) if i not in cut]
                    at += len(tokens)
                inside = kept
            text = " ".join(inside)
            out.append((page_id, url, text, len(text)))
        yield _batch(out, TEXTS)


def _stream_batches(batches):
    """Each page's blocks outside the text of a marked article and inside it, with the numbers of their tokens."""
    for batch in batches:
        out = []
        for page_id, url, html in zip(*(batch.column(k).to_pylist() for k in range(3))):
            found = blocks(html)
            outside = [(t, junk) for t, part, junk in found if not part] + [(t, True) for t, part, junk in found if part and junk]
            inside = [t for t, part, junk in found if part and not junk]
            loose = [t for t, _ in outside]
            out.append((page_id, url, bool(inside), loose, [junk for _, junk in outside], inside, _count(loose), _count(inside)))
        yield _batch(out, STREAMS)


def _count(found: list[str]) -> int:
    return sum(t.count(" ") + 1 for t in found)


def _covered_batches(batches):
    """Host, number of pages and key of each block that runs of boilerplate cover from end to end; of equal ones in a stream one."""
    for batch in batches:
        out = []
        for host, pages, loose, covered in zip(*(batch.column(k).to_pylist() for k in range(4))):
            gone, at, found = set(covered), 0, set()
            for block in loose:
                end = at + block.count(" ") + 1
                if gone.issuperset(range(at, end)):
                    found.add(block_key(block))
                at = end
            out += [(host, pages, key) for key in found]
        yield _batch(out, [("host", pa.string()), ("pages", pa.int64()), ("block", pa.int64())])


def _unique_batches(batches):
    """What is left of the streams of unmarked pages without junk blocks and covered tokens."""
    for batch in batches:
        out = []
        for page_id, url, loose, junk, covered in zip(*(batch.column(k).to_pylist() for k in range(5))):
            gone, at, kept = set(covered or []), 0, []
            for block, is_junk_block in zip(loose, junk):
                tokens = block.split(" ")
                if not is_junk_block:
                    kept += [t for i, t in enumerate(tokens, at) if i not in gone]
                at += len(tokens)
            text = " ".join(kept)
            out.append((page_id, url, text, len(text)))
        yield _batch(out, TEXTS)


STREAM = ("page_id long, url string, is_marked boolean, loose array<string>, loose_junk array<boolean>, inside array<string>, "
          "n_loose long, n_inside long")
STREAMS = [("page_id", pa.int64()), ("url", pa.string()), ("is_marked", pa.bool_()), ("loose", pa.list_(pa.string())),
           ("loose_junk", pa.list_(pa.bool_())), ("inside", pa.list_(pa.string())), ("n_loose", pa.int64()), ("n_inside", pa.int64())]
TEXTS = [("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())]


def _batch(rows: list[tuple], columns: list[tuple]) -> pa.RecordBatch:
    values = list(zip(*rows)) or [[]] * len(columns)
    return pa.RecordBatch.from_arrays([pa.array(v, kind) for v, (_, kind) in zip(values, columns)], [name for name, _ in columns])


def _host() -> Column:
    return F.lower(F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1), F.lit("")))


def _boilerplate_blocks(parsed: DataFrame, covered: DataFrame, sizes: DataFrame, sizes_in: DataFrame) -> DataFrame:
    """``at`` (host) and ``gone``, the keys of blocks that are boilerplate inside the host's articles too, however short. Runs of
    boilerplate cover such a block outside the articles of enough distinct pages, and it is a block of enough distinct articles.
    Each is on a share of its host's articles, which bounds a host's list."""
    def enough(met: DataFrame, sizes: DataFrame) -> DataFrame:
        return met.join(sizes, "host").filter(F.col("n") >= F.col("enough")).select("host", "block")

    leads = parsed.select("seq", "loose").join(covered, F.col("seq") * 4 == F.col("seg"))
    blocks_out = leads.select("host", "pages", "loose", "covered").mapInArrow(tidied(_covered_batches), "host string, pages long, block long")
    outside = stored(enough(blocks_out.groupBy("host", "block").agg(F.sum("pages").alias("n")), sizes), "outside")
    found = (parsed.filter("is_marked").select("host", "in1", "inside").mapInArrow(tidied(_inside_batches), "host string, article long, block long")
             .join(outside, ["host", "block"], "left_semi"))
    both = enough(_counted(found, ["host", "block"], ["article"], "n"), sizes_in)
    return stored(both.groupBy(F.col("host").alias("at")).agg(F.collect_list("block").alias("gone")), "gone")


def _inside_batches(batches):
    """Host, article and key of each block of an article."""
    for batch in batches:
        rows = [(host, article, key) for host, article, inside in zip(*(batch.column(k).to_pylist() for k in range(3)))
                for key in {block_key(t) for t in inside}]
        yield _batch(rows, [("host", pa.string()), ("article", pa.int64()), ("block", pa.int64())])


def main_text(pages: DataFrame, long: int = LONG, least_pages: int = LEAST_PAGES, share: float = SHARE) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points).

    A null or empty html gives the empty text. Character references are decoded, white space inside a
    block becomes one space, blocks are joined by one space in page order. The host is the url's; all
    pages without one form a host of their own. A run of ``long`` tokens or more is boilerplate if it is on ``least_pages`` pages of
    the host and on the ``share`` of them; pages with equal streams are one page, and so are those that have the run in equal
    articles. Inside articles it must be outside the articles of as many pages, and in as many distinct articles. Repeated rows
    come back as often as given.
    """
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    parsed = stored(rows.mapInArrow(tidied(_stream_batches), STREAM), "streams").withColumn("row", F.monotonically_increasing_id())
    # a dense number for each page: its partition's number and its place there
    place = F.col("row").bitwiseAND((1 << 33) - 1)
    first = parsed.agg((F.coalesce(F.max(place), F.lit(0)) + 1).alias("widest"), F.coalesce(F.sum(F.col("n_loose") + F.col("n_inside")), F.lit(0)).alias("tokens")).first()
    parsed = parsed.withColumn("seq", F.shiftright("row", 33) * first["widest"] + place).drop("row").withColumn("host", _host())
    for name, text in (("out", F.array_join("loose", " ")), ("in", F.array_join("inside", " "))):
        parsed = parsed.withColumn(f"{name}1", F.xxhash64(text)).withColumn(f"{name}2", F.xxhash64(F.lit(29), text))
    out_key, in_key = ["host", "out1", "out2"], ["host", "in1", "in2"]
    # distinct contents of a host, each with the number of one of its pages; then its distinct streams outside articles and its
    # distinct articles, numbered by one of their pages: 4 * page, with their numbers of pages, and 4 * page + 2
    contents = stored(parsed.groupBy(*out_key, "in1", "in2", "is_marked").agg(F.min("seq").alias("lead")), "contents")
    outer = stored(contents.groupBy(*out_key).agg((F.min("lead") * 4).alias("seg"), F.count("*").alias("pages")), "outer")
    inner = stored(contents.filter("is_marked").groupBy(*in_key).agg((F.min("lead") * 4 + 2).alias("seg")), "inner")

    def enough(distinct: DataFrame) -> DataFrame:
        return stored(distinct.groupBy("host").agg(F.greatest(F.lit(float(least_pages)), F.count("*") * share).alias("enough")), "sizes")

    sizes, sizes_in = enough(contents), enough(inner)
    loose = parsed.select((F.col("seq") * 4).alias("seq"), "host", F.col("loose").alias("blocks"))
    inside = parsed.filter("is_marked").select((F.col("seq") * 4 + 2).alias("seq"), "host", F.col("inside").alias("blocks"))
    streams = loose.join(outer.select(F.col("seg").alias("seq")), "seq", "left_semi").unionByName(inside)
    found = frequent_tokens(loose.unionByName(inside), streams, sizes, first["tokens"], long, least_pages)
    segments = outer.select("host", F.col("seg").alias("seq"), "pages").unionByName(
        inner.select("host", F.col("seg").alias("seq"), F.lit(1).cast("bigint").alias("pages")))
    # a stream that several pages have is there twice, since the search keeps what is in two sequences
    twice = F.when(F.col("pages") > 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    found = (found.join(segments.select("seq", "pages"), "seq").withColumn("twin", F.explode(twice)).withColumn("seq", F.col("seq") + F.col("twin")))
    tokens = stored(
        found.select("seq", F.col("pos").cast("bigint").alias("pos"), (F.col("seq") * (1 << 26) + F.col("pos")).alias("at"),
                     F.xxhash64("host", "token").alias("key1"), F.hash("token", "host").alias("key2"),
                     F.when(F.col("begins"), F.array(F.lit(long))).otherwise(F.array().cast("array<int>")).alias("lengths")), "tokens")
    windows = stored(repeated_windows(tokens, across=True).join(segments, "seq").withColumn("is_inside", F.col("seq") % 4 == 2), "windows")
    run = ["host", "length", "rank"]
    hits = windows.select(*run, "seq", "pages", "is_inside").distinct()
    counts = stored(hits.groupBy(*run).agg(F.coalesce(F.sum(F.when(~F.col("is_inside"), F.col("pages"))), F.lit(0)).alias("n_out"),
                                           F.count_if(F.col("is_inside")).alias("n_in")), "counts")
    # a run counts once for each page that has it outside its article, and once for each article of other pages
    split = hits.join(counts.filter((F.col("n_out") > 0) & (F.col("n_in") > 0)).select("length", "rank"), ["length", "rank"], "left_semi")
    pairs = (contents.filter("is_marked").join(inner.withColumnRenamed("seg", "seq"), in_key)
             .join(outer.select(*out_key, F.col("seg").alias("around")), out_key).select("seq", "around"))
    around = split.filter(~F.col("is_inside")).select("length", "rank", F.col("seq").alias("around"))
    others = (split.filter("is_inside").select(*run, "seq").join(pairs, "seq").join(around, ["length", "rank", "around"], "left_anti"))
    counted = stored(counts.join(_counted(others, run, ["seq"], "n_more"), run, "left").join(sizes, "host").withColumn(
        "n", F.col("n_out") + F.when(F.col("n_out") > 0, F.coalesce("n_more", F.lit(0))).otherwise(F.col("n_in"))), "counted")
    boilerplate = counted.filter(F.col("n") >= F.col("enough")).select("length", "rank")
    both = (counted.filter(F.col("n_out") >= F.col("enough")).drop("enough").join(sizes_in, "host").filter(F.col("n_in") >= F.col("enough"))
            .select("length", "rank"))
    covered = stored(_positions(windows.filter(~F.col("is_inside")).join(boilerplate, ["length", "rank"], "left_semi"), "covered").join(outer, "seg"), "covered")
    cut = stored(_positions(windows.filter("is_inside").join(both, ["length", "rank"], "left_semi"), "cut").join(inner, "seg").select(*in_key, "cut"), "cut")
    kind = "page_id long, url string, text string, n_chars long"
    unique = (parsed.filter(~F.col("is_marked")).join(covered.select(*out_key, "covered"), out_key, "left")
              .select("page_id", "url", "loose", "loose_junk", "covered").mapInArrow(tidied(_unique_batches), kind))
    gone = _boilerplate_blocks(parsed, covered, sizes, sizes_in)
    articles = (parsed.filter("is_marked").join(gone, F.col("host") == F.col("at"), "left").join(cut, in_key, "left")
                .select("page_id", "url", "inside", "gone", "cut"))
    return articles.mapInArrow(tidied(_article_batches), kind).unionByName(unique)


def _counted(rows: DataFrame, keys: list[str], what: list[str], name: str) -> DataFrame:
    """How many different values of ``what`` a key has."""
    return rows.select(*keys, *what).distinct().groupBy(*keys).agg(F.count("*").alias(name))


def _positions(windows: DataFrame, name: str) -> DataFrame:
    """The places of a stream's tokens that windows cover."""
    return (windows.select("seq", F.explode(F.sequence("pos", F.col("pos") + F.col("length") - 1)).alias("pos")).distinct()
            .groupBy(F.col("seq").alias("seg")).agg(F.collect_list("pos").alias(name)))
