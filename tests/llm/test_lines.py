from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quarterstone.llm import lines, pages, runs
from tests.llm.helpers import clashing, documents


def brute(texts, least):
    """Lines in any run of ``least`` words or more that is found earlier, by trying all runs."""
    kept = [[(i, x) for i, x in enumerate(t.split("\n")) if x.strip(" \t\r\x0b\x0c")] for t in texts]
    gone = [set() for _ in texts]
    seen = {}
    for d, own in enumerate(kept):
        for a in range(len(own)):
            for b in range(a + 1, len(own) + 1):
                run = tuple(x for _, x in own[a:b])
                if sum(len(x.split()) for x in run) >= least:
                    if run in seen and seen[run] != (d, a):
                        gone[d] |= {i for i, _ in own[a:b]}
                    seen.setdefault(run, (d, a))
    return ["\n".join(x for i, x in enumerate(t.split("\n")) if i not in g) if g else t for t, g in zip(texts, gone)]


TEXT = st.lists(st.sampled_from(["a", "b c", "d e f", "", " ", "g h i j k l m n o p"]), max_size=12).map("\n".join)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(TEXT, min_size=1, max_size=6))
def test_runs_against_all_runs(spark, texts):
    rows = documents(spark, list(enumerate(texts)))
    got = {r.doc_id: r.text for r in lines.dedup_lines(rows, 5).collect()}
    assert [got[d] for d in range(len(texts))] == brute(texts, 5)


def test_windows_cover_every_long_run():
    import numpy as np

    words = np.array([3, 1, 1, 9, 2, 2, 2])
    found = {(i, i + n) for i, ns in enumerate(lines.window_lengths(words, 5)) for n in ns}
    for a in range(7):
        for b in range(a + 1, 8):
            if words[a:b].sum() >= 5:
                inside = [w for w in found if a <= w[0] and w[1] <= b]
                assert set(range(a, b)) == {k for x, y in inside for k in range(x, y)}


def test_passage_in_many_documents(spark):
    passage = "\n".join(f"line {k} of a passage shared by all" for k in range(8))
    rows = [(d, f"own opening words of document number {d}\n{passage}\nown closing words of document number {d}") for d in range(40)]
    got = {r.doc_id: r for r in lines.dedup_lines(documents(spark, rows)).collect()}
    assert got[0].text == rows[0][1]
    for d in range(1, 40):
        assert got[d].text == f"own opening words of document number {d}\nown closing words of document number {d}" and got[d].removed == list(range(1, 9))


def test_odd_rows(spark):
    long = "one two three four five six seven eight nine ten"
    rows = [(1, None), (2, ""), (3, long), (3, long), (3, f"{long}\nmore"), (None, long), (4, "\n\n"), (-5, "short\nlines"), (5, "short\nlines"),
            (9, "\n".join([long] * 3000))]
    names = ("seq", "at", "pos", "rank", "_lines", "_id", "_copy", "_gone", "_row", "text1", "uid")
    got = lines.dedup_lines(clashing(documents(spark, rows), *names, "lines", "removed")).collect()
    assert len(got) == len(rows) and all(r[name] == "clash" for r in got for name in names)
    texts = sorted((str(r.doc_id), str(r.text)) for r in got)
    third = [r.text for r in got if r.doc_id == 3]
    assert sum(long in t for t in third) == 1 and len(third) == 3
    assert ("None", "") in texts and ("1", "None") in texts and ("4", "\n\n") in texts and ("5", "short\nlines") in texts and ("9", "") in texts
    assert lines.dedup_lines(documents(spark, [])).count() == 0


def test_documents_without_id_stay_apart(spark):
    """Two texts whose hashes agree in their last eight decimal digits."""
    import xxhash

    shared = "one passage of ten words or more that two texts share"
    seen, pair = {}, None
    for k in range(200_000):
        text = f"opening of text {k} with a few words of its own\n{shared}" if k % 2 else f"a clean text {k} that shares nothing with others\nits second line {k} has more than ten words in all here"
        digest = xxhash.xxh64_intdigest(text.encode(), 42)
        other = seen.setdefault((digest - (digest >> 63 << 64)) % 10 ** 8, (k, text))
        if (other[0] + k) % 2:
            pair = [text, other[1]]
            break
    rows = [(1, shared), *((None, t) for t in pair), (None, pair[0]), (None, pair[0])]
    got = sorted(r.text for r in lines.dedup_lines(documents(spark, rows)).collect())
    assert got == sorted([shared, *(t.removesuffix("\n" + shared) for t in pair), "", ""])


def test_page_structure():
    assert pages.blocks("<p>a &amp; b") == [("a & b", False, False)]
    assert pages.blocks("") == [] and pages.blocks("x < y <b") == [("x < y", False, False)]
    page = ("<html><body><nav>menu</nav><div class='cookie-notice'><div>we use</div>cookies</div><article><header><h1>Title</h1><p>by line</p></header>"
            "<p>One <b>bo</b>ld<br>two<p>three&nbsp; &#233;<form>mail<input></form><script>var t='</p>';</script><section id=comments><article>nice</article></section>"
            "<p>end</article><aside>more</aside><footer>foot</footer>")
    text = " ".join(t for t, inside, junk in pages.blocks(page) if inside and not junk)
    assert text == "Title One bold two three é end"
    assert [b for b in pages.blocks('<div class="ad">left open<article><p>kept</p></article>') if b[1]] == [("kept", True, False)]


def page_rows(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], "page_id bigint, url string, html string, text string, pos string")


def test_repeated_runs_of_a_host(spark):
    notice = "please read our long standing terms of use before you go on reading here"
    rows = [(k, "http://a.example/x", f"<div>{notice}</div><p>{k} told here is something of its own</p>") for k in range(5)]
    rows += [(10, "http://b.example/", f"<div>{notice}</div><p>other host</p>"), (11, "http://a.example/y", f"<article>{notice}</article>"),
             (12, None, None), (13, "no url", ""), (None, "http://a.example", "<p>x</p>"), (14, "http://c.example", "<p>q</p>" * 20_000)]
    got = {r.page_id: r for r in pages.main_text(page_rows(spark, rows)).collect()}
    assert [got[k].text for k in range(5)] == [f"{k} told here is something of its own" for k in range(5)]
    assert got[10].text == f"{notice} other host" and got[11].text == notice
    assert (got[12].text, got[12].n_chars, got[13].text, got[None].text) == ("", 0, "", "x") and got[14].n_chars == 39_999
    assert pages.main_text(page_rows(spark, [])).count() == 0


def test_classes_that_tell_a_state_are_no_junk():
    for html in ('<article class="post comments-open"><p>kept</p></article>', '<main class="site-main has-sidebar"><p>kept</p></main>',
                 '<div class="content with-sidebar"><p>kept</p></div>', '<article class="related-post" id="comments"><p>kept</p></article>'):
        assert [(t, junk) for t, _, junk in pages.blocks(html)] == [("kept", False)], html
    for name in ("sidebar", "sidebar-left", "site-footer", "cookieBanner", "post-comments"):
        assert [junk for _, _, junk in pages.blocks(f'<div class="x {name}">gone</div>')] == [True], name


def test_copies_and_stories_of_few_pages_stay_whole(spark):
    story = " ".join(f"word{i}" for i in range(60))
    rows = [(1, "http://a.example/1", f"<p>{story}</p>"), (2, "http://a.example/2", f"<p>{story}</p>"), (3, "http://a.example/3", f"<p>{story}</p>"),
            (4, "http://b.example/4", f"<p>First</p><p>{story}</p>"), (5, "http://b.example/5", f"<p>Second</p><p>{story}</p>")]
    got = {r.page_id: r.text for r in pages.main_text(page_rows(spark, rows)).collect()}
    assert got == {1: story, 2: story, 3: story, 4: f"First {story}", 5: f"Second {story}"}


def test_unmarked_copies_of_the_pages(spark):
    """Without their article tags, pages lose their boilerplate and little else: words against those of the marked page."""
    import re

    from tests.llm.helpers import FOLDER, tables

    given = [(r["page_id"], r["url"], r["html"]) for r in tables("pages").to_pylist()]
    marked = {r.page_id: r.text.split() for r in pages.main_text(page_rows(spark, given)).collect()}
    bare = [(i, u, re.sub(r"</?(?:article|main)\b[^>]*>", "", html or "")) for i, u, html in given]
    got = {r.page_id: r.text.split() for r in pages.main_text(page_rows(spark, bare)).collect()}
    both = sum(sum((Counter(got[i]) & Counter(marked[i])).values()) for i in marked)
    precision, recall = both / sum(map(len, got.values())), both / sum(map(len, marked.values()))
    print("precision", precision, "recall", recall)
    assert precision >= 0.9 and recall >= 0.9


def test_page_query_keeps_articles(spark):
    from html import unescape
    import re

    from quarterstone.llm import queries
    from tests.llm.helpers import FOLDER, tables

    got = {r.page_id: r.text for r in queries.op3_host_repeats_main_text(spark, FOLDER).collect()}
    for row in tables("pages").to_pylist():
        article = re.search(r"<article>(.*?)</article>", row["html"], re.S).group(1)
        parts = (" ".join(unescape(re.sub("<[^>]+>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)>", article))
        assert got[row["page_id"]] == " ".join(p for p in parts if p)


def test_windows_of_long_runs(spark):
    """Lengths beyond several doublings, against all windows."""
    sequences = ["abcdefghijkl" * 2, "xxabcdefghijk", "aaaaaaaaaaaaaaaaaaaaaa", "cdefghijklab"]
    for length in (1, 3, 4, 7, 11):
        rows = [(s, p, s * 1000 + p, ord(c), 0, [length] if p + length <= len(text) else [])
                for s, text in enumerate(sequences) for p, c in enumerate(text)]
        frame = spark.createDataFrame(rows, "seq bigint, pos bigint, at bigint, key1 bigint, key2 bigint, lengths array<int>")
        got = {(r.seq, r.pos) for r in runs.repeated_windows(frame).collect()}
        seen, want = set(), set()
        for s, text in enumerate(sequences):
            for p in range(len(text) - length + 1):
                if text[p:p + length] in seen:
                    want.add((s, p))
                seen.add(text[p:p + length])
        assert got == want


def test_host_repeats_decide_inside_articles(spark):
    """A block that a host repeats inside and outside its articles goes; what articles quote from each other stays."""
    from quarterstone.llm import pages

    notice, quote = "Sign up today and get our weekly letter free of charge", "this quoted sentence of nine words stands in articles only"

    def page(i):
        foot, advert = f"<div>{notice}</div>" * (i < 6), f"<p>{notice}</p>" * (i % 2)
        return i, f"http://h/{i}", f"<body>{foot}<p>loose number {i}</p><article><p>Story {i}.</p>{advert}<p>{quote}</p></article></body>"

    rows = spark.createDataFrame([page(i) for i in range(12)], "page_id long, url string, html string")
    assert {r.page_id: r.text for r in pages.main_text(rows).collect()} == {i: f"Story {i}. {quote}" for i in range(12)}


def test_articles_are_searched_too(spark):
    """What a host repeats is found inside its articles: on pages without one, and in paragraphs that are else their own."""
    notice, foot = "sign up today and get our weekly letter free of charge", "all rights of this page and its pictures are kept by us"
    rows = [(i, f"http://h/{i}", f"<nav>to page {i}</nav><article><p>Story {i}.</p><p>{notice}</p></article>") for i in range(4)]
    rows += [(4, "http://h/4", f"<p>{notice}</p><p>no article here</p>")]
    rows += [(i, f"http://h/{i}", f"<article><p>Own text {i} and {foot}</p></article><div>{foot}</div>") for i in range(5, 9)]
    # copies of one article count once, also on pages that differ elsewhere
    tale = " ".join(f"word{k}" for k in range(20))
    rows += [(i, f"http://t/{i}", f"<nav>place {i}</nav><article><p>{tale}</p></article>") for i in range(9, 14)] + [(14, "http://t/14", f"<p>{tale}</p>")]
    # a box inside an article is outside of its text
    rows += [(i, f"http://b/{i}", f"<article><p>News {i}</p><aside>{notice}</aside></article>") for i in range(15, 18)]
    rows += [(i, f"http://b/{i}", f"<article><p>More {i}, {notice}</p></article>") for i in range(18, 21)]
    want = {i: f"Story {i}. {notice}" for i in range(4)} | {4: "no article here"} | {i: f"Own text {i} and" for i in range(5, 9)}
    want |= {i: tale for i in range(9, 15)} | {i: f"News {i}" for i in range(15, 18)} | {i: f"More {i}," for i in range(18, 21)}
    assert {r.page_id: r.text for r in pages.main_text(page_rows(spark, rows)).collect()} == want


def test_windows_on_enough_pages_pass(spark):
    """Against all windows of random streams, counted in several groups; few others pass."""
    import random

    from quarterstone.llm import windows

    draw = random.Random(3)
    streams = [("a" if s % 3 else "b", [draw.choice("abc") for _ in range(draw.randrange(30))]) for s in range(60)]
    pages_of = Counter((host, w) for host, t in streams for w in {tuple(t[p:p + 5]) for p in range(len(t) - 4)})
    enough = {"a": 4.5, "b": 3.0}
    want = {(s, q) for s, (host, t) in enumerate(streams) for p in range(len(t) - 4) if pages_of[host, tuple(t[p:p + 5])] >= enough[host] for q in range(p, p + 5)}
    frame = spark.createDataFrame([(s, host, [" ".join(t[:7]), " ".join(t[7:])] if len(t) > 7 else t) for s, (host, t) in enumerate(streams)], "seq long, host string, blocks array<string>")
    sizes = spark.createDataFrame(list(enough.items()), "host string, enough double")
    before, windows.CHUNK_TOKENS = windows.CHUNK_TOKENS, 200
    try:
        got = windows.frequent_tokens(frame, frame, sizes, sum(len(t) for _, t in streams), 5, 3).collect()
    finally:
        windows.CHUNK_TOKENS = before
    assert want and want <= {(r.seq, r.pos) for r in got} and len(got) == len({(r.seq, r.pos) for r in got}) < sum(len(t) for _, t in streams)
    assert all(streams[r.seq][1][r.pos] == r.token and streams[r.seq][0] == r.host for r in got)
