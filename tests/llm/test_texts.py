"""Personal data, pages, quality, outliers and leaks against plain Python."""

import random
import re
import time
from collections import Counter

import numpy as np
import pytest

pytest.importorskip("tessella.llm")

from tessella.llm.decontaminate import Seeds, benchmark_leaks, runs_of, tile, tokens, without_leaks  # noqa: E402
from tessella.llm.html import extract_text, render  # noqa: E402
from tessella.llm.pii import all_spans, find_personal_data, luhn, plain_spans  # noqa: E402
from tessella.llm.quality import Neighbours, classify_quality, fit_neighbours, held_out  # noqa: E402
from tessella.llm.rules import COUNTS, reject_outliers, robust_distances, text_counts  # noqa: E402
from tessella.llm.words import shingles, word_hashes, windows  # noqa: E402

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base(text):
    found = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (
                kind == "email"
                or kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))
                or kind == "card" and 14 <= len(digits) <= 19 and luhn(digits)
                or kind == "phone" and 10 <= len(digits) <= 15
            ):
                found.append((m.start(), kind, m.end()))
    return sorted(found, key=lambda s: (s[0], list(BASE).index(s[1]), s[2]))


def test_plain_spans_as_the_patterns_find_them():
    rng = random.Random(5)
    pieces = ["a@b", "@", ".com", "x_y", "1", "255", ".", "256.", "+", " (0", ") ", "-", "4111 1111 1111 1111", "é", "+1 (523) 555-1055", "\n", "00012.1.1.1", "c@d-e.org"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(14)))
        assert plain_spans(text) == base(text), text


@pytest.mark.parametrize(
    ("text", "kind", "source"),
    [
        ("write john [at] example [dot] com now", "email", "john [at] example [dot] com"),
        ("write john.d(at)example.org now", "email", "john.d(at)example.org"),
        ("mail john at example dot com please", "email", "john at example dot com"),
        ("mail john@example dot com please", "email", "john@example dot com"),
        ("mail john@example[.]com please", "email", "john@example[.]com"),
        ("é john＠example．com", "email", "john＠example．com"),
        ("mail jоhn@example.com", "email", "jоhn@example.com"),
        ("jo​hn@exam­ple.com!", "email", "jo​hn@exam­ple.com"),
        ("ip one nine two dot one six eight dot zero dot one.", "ip", "one nine two dot one six eight dot zero dot one"),
        ("ip １９２.168.0.1 it is", "ip", "１９２.168.0.1"),
        ("call plus one five two three five five five one zero five five today", "phone", "plus one five two three five five five one zero five five"),
        ("Anruf plus vier neun drei null eins zwei drei vier fünf sechs sieben heute", "phone", "plus vier neun drei null eins zwei drei vier fünf sechs sieben"),
        ("card four one one one one one one one one one one one one one one one ok", "card", "four one one one one one one one one one one one one one one one"),
        ("card ４１１１-1111-1111-1111", "card", "４１１１-1111-1111-1111"),
        ("from 192 dot 168 dot 1 dot 20 it came", "ip", "192 dot 168 dot 1 dot 20"),
        ("from 192[.]168[.]1[.]20", "ip", "192[.]168[.]1[.]20"),
        ("mail hein.19 at mail5.example.com ining", "email", "hein.19 at mail5.example.com"),
        ("call +1 (5O5) 555-l234 now", "phone", "+1 (5O5) 555-l234"),
        ("call +1 five two three 555 one 0 five five", "phone", "+1 five two three 555 one 0 five five"),
        ("a Hein.19 AT Mail5 DOT Example DOT Com b", "email", "Hein.19 AT Mail5 DOT Example DOT Com"),
    ],
)
def test_disguises_map_back_to_their_characters(text, kind, source):
    _, added = all_spans(text)
    assert (text.index(source), kind, text.index(source) + len(source)) in added


@pytest.mark.parametrize(
    ("text", "kind", "source"),
    [
        ("mail: john dot doe at example dot com, please", "email", "john dot doe at example dot com"),
        ("mail: john[dot]doe[at]example[dot]com, please", "email", "john[dot]doe[at]example[dot]com"),
        ("mail: john [dot] q [dot] doe (at) example.org now", "email", "john [dot] q [dot] doe (at) example.org"),
        ("mail: john a\u200bt example do\u200bt com please", "email", "john a\u200bt example do\u200bt com"),
        ("ip \u043ene nine two dot one six eight dot zero dot one.", "ip", "\u043ene nine two dot one six eight dot zero dot one"),
    ],
)
def test_disguises_compose(text, kind, source):
    _, added = all_spans(text)
    assert (text.index(source), kind, text.index(source) + len(source)) in added


@pytest.mark.parametrize("n", [1, 2, 5, 8, 40, 300])
def test_addresses_of_any_length_are_taken_whole(n):
    labels = [f"l{i}" for i in range(n)]
    for at, dot in ((" [at] ", " [dot] "), (" at ", " dot "), ("(at)", "."), ("@", " dot "), ("_at_", "_dot_")):
        for local in ("jane", "jane" * 60, dot.join(["jane", "k" * 90, "z_y"]), dot.join(labels)):
            if at in ("(at)", "@") and local != "jane":
                local = local.replace(dot, ".")
            source = local + at + dot.join([*labels, "com"])
            text = f"mail: {source}, please"
            assert (6, "email", 6 + len(source)) in all_spans(text)[1], text


def test_a_loose_dot_behind_a_plain_one_ends_the_sentence():
    text = "write jane [at] mail.com . thanks"
    assert all_spans(text)[1] == [(6, "email", 24)]


def test_long_lettered_numbers_and_ids():
    text = "call +1 2O2 555 O1 99 now, card 4111 1111 IIII 1111 or 00192 dot 168 dot 0 dot 0001"
    found = {text[s:e] for s, _, e in all_spans(text)[1]}
    assert found >= {"+1 2O2 555 O1 99", "4111 1111 IIII 1111", "00192 dot 168 dot 0 dot 0001"}


@pytest.mark.parametrize("text", ["a." * 200_000 + "[at] b", "(" * 400_000, "x [at] a [dot] " * 30_000, "1 " * 200_000 + "x", "a_" * 150_000 + "b[at]b.c", "a at b.c " * 40_000])
def test_hostile_disguises_take_linear_time(text):
    start = time.time()
    all_spans(text)
    assert time.time() - start < 10


@pytest.mark.parametrize(
    "text",
    ["", "meet me at noon", "look at example.com", "one two things at a point", "the dot and the at sign", "a (at) b", "Привет, мир", "x = a[at] + b", "café — naïve ½ price"],
)
def test_clean_texts_stay_clean(text):
    assert all_spans(text) == ([], [])


def test_personal_data_of_rows(spark, documents, long_text):
    texts = [None, "", "a@b.cc a@b.cc", "nine one " + "9" * 60_000, long_text + "x@y.zz", "a@b.cc a@b.cc", "@ at " * 20_000]
    got = {r.doc_id: r for r in find_personal_data(documents(texts)).collect()}
    assert len(got) == len(texts)
    assert got[0].spans == got[1].spans == got[3].spans == got[6].spans == ""
    assert got[2].spans == got[5].spans == "email:0:6,email:7:13"
    assert got[4].spans == f"email:{len(long_text)}:{len(long_text) + 6}"
    assert find_personal_data(documents([])).count() == 0


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain", "plain"),
        ("<p>a<p>b", "a\n\nb"),
        ("<div>a</div><div>b</div>", "a\nb"),
        ("a<br>b<br><br>c", "a\nb\n\nc"),
        ("x  \n y <b> z</b>", "x y z"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e", "- a\n- b\n  - c\n- d\n\ne"),
        ("<ol start=9><li>a<li>b</ol>", "9. a\n10. b"),
        ("<table><tr><td>a<td>bb<tr><th>ccc<td>d</table>z", "a   | bb\nccc | d\n\nz"),
        ("<table><td>a<table><td>in</table><td>b</table>", "a  | b\n\nin"),
        ("<table><td rowspan=2>a<td>b<tr><td>c<tr><td>d<td>e</table>", "a | b\n  | c\nd | e"),
        ("<table><td>x<td rowspan=3>y<td>z<tr><td>1<td>2<tr><td>3<td>4<tr><td>5<td>6<td>7</table>", "x | y | z\n1 |   | 2\n3 |   | 4\n5 | 6 | 7"),
        ("<table><tbody><td rowspan=0>a<td>b<tr><td>c<tbody><tr><td>d<td>e</table>", "a | b\n  | c\nd | e"),
        ("<table><td colspan=2 rowspan=2>a<td>b<tr><td>c<tr><td>d<td>e<td>f</table>", "a |   | b\n  |   | c\nd | e | f"),
        ("<table><td><p>a<p>b<td><ul><li>c<li>d</ul></table>", "a | - c\n  | - d\nb"),
        ("<table><caption>t</caption><td>a<table><td>b<td>c<tr><td>dd<td>e</table></table>", "t\na\n\nb  | c\ndd | e"),
        ("<svg><title>n</title><defs><text>o</text></defs><text>a</text><text>b <tspan>c</tspan></text></svg>", "a\nb c"),
        ("x <math><mi>a</mi><mo>+</mo><mn>1</mn><annotation>no</annotation></math> y", "x a+1 y"),
        ("a<textarea>\n b &amp; <i>\n\n c</textarea>d", "a\n b & <i>\n\n c\nd"),
        ("<p>a <select><optgroup label=g><option>b<option>c</select></p>d", "a\ng\nb\nc\n\nd"),
        ("<pre>a\n<ul><li>b<li>c\nd</ul>\n\n\ne\n</pre>f", "a\n\n- b\n- c\n  d\n\n\n\n\ne\n\nf"),
        ("<div style='visibility:hidden'>a<b style='visibility: visible'>b</b>c</div>d", "b\nd"),
        ("<div style='display:none'>a<b style='visibility:visible;display:block'>b</b></div>d", "d"),
        ("<style>.x, #y , p.z{color:red;display:none} .v{visibility:hidden}</style><b class='q x'>a</b><b id=y>b</b><i class=z>c</i><p class=z>d<p>e<u class=v>f</u>", "c\n\ne"),
        ("<style>/* .a{display:none} */ @media print{.a{display:none}} .a{display:none} b.a{display:inline} .c .a{display:none}</style><b class=a>b</b><i class=a>c</i>", "b"),
        ("<style>.a{display:none!important}</style><b class=a style='display:inline'>x</b><b hidden style='display:block'>y</b>", "y"),
        ("<script>x<p></script><style>y</style>z<!-- c -->", "z"),
        ("<p hidden>a</p><p style='display: none'>b</p><p>c", "c"),
        ("<head><title>t</title><body>b", "b"),
        ("<pre> a\n  b </pre>c", " a\n  b\n\nc"),
        ("<p><b>a<p>b</b>c", "a\n\nbc"),
        ("<h1>T</h1>x<hr>y", "T\n\nx\n---\ny"),
        ("a &amp; b&nbsp;c &lt;", "a & b\xa0c <"),
        ("<img alt='pic'> <input type=hidden value=q>x", "pic x"),
        ("<blockquote>q</blockquote>r", "  q\n\nr"),
        ("<dl><dt>t<dd>d</dl>", "t\n  d"),
        ("</p>x</div><", "x<"),
        ("<tr><td>a</td></tr>", "a"),
    ],
)
def test_pages_are_laid_out(html, text):
    assert render(html) == text


def test_deep_and_broken_pages():
    assert render("<div>" * 5000 + "x" + "</span>" * 10) == "x"
    assert render("<p>a<!-- never ends") == "a"
    assert render("a<b c='d") == "a"
    assert render("a<!DOCTYPE x><?pi?></ bogus>b<A HREF=x/y Title=\"1>2\">c</A><br/>d") == "abc\nd"


@pytest.mark.parametrize(
    "piece",
    ["<!--", "<a ", "<", "&", "<div>", "<ul><li>", "<p>x", "<table><tr><td>", "<table><tr><td rowspan=9>x", "<pre>\n", "<style>.a{display:none}", "<style>@media{", "<select><option>", "<script>", "</b>", "<b>x", '<a href="', "<li>x", "<b><p>"],
)
def test_hostile_pages_take_linear_time(piece):
    start = time.perf_counter()
    render("<ol>" + piece * 20_000)
    assert time.perf_counter() - start < 20


def test_pages_of_rows(spark):
    pages = ["<p>a<p>b", None, "", "<p>a<p>b", "<table><tr><td>" + "x" * 300_000 + "<td>y" + "<tr><td>z<td>w" * 2_000 + "</table>", "<p>" + "word " * 200_000]
    df = spark.createDataFrame(list(enumerate(pages)), "page_id long, html string").selectExpr("*", "1 AS text", "2 AS n_chars")
    got = {r.page_id: r for r in extract_text(df).collect()}
    assert {i: (r.text, r.n_chars, r.n_lines) for i, r in got.items() if i < 4} == {0: ("a\n\nb", 4, 3), 1: ("", 0, 0), 2: ("", 0, 0), 3: ("a\n\nb", 4, 3)}
    assert got[4].n_lines == 2_001 and got[4].n_chars == 300_004 + 2_000 * 6
    assert got[5].n_chars == 200_000 * 5 - 1
    assert extract_text(df.limit(0)).count() == 0


def test_words_seen_are_those_of_a_plain_walk():
    """Every visible word is there, in order, and none that is hidden: random trees against a recursion."""
    rng = random.Random(23)
    names = ["div", "p", "span", "ul", "pre", "svg", "section", "blockquote"]

    def grow(depth, shown):
        tag, style = rng.choice(names), rng.choice(["", "", "", "display:none", "visibility:hidden", "visibility:visible"])
        shown = None if style == "display:none" or shown is None else {"visibility:hidden": False, "visibility:visible": True}.get(style, shown)
        inner, words = "", []
        for _ in range(rng.randrange(4)):
            if depth and rng.random() < 0.6:
                html, more = grow(depth - 1, shown)
                inner, words = inner + html, words + more
            else:
                word = f"w{rng.randrange(10**6)}"
                inner, words = inner + f" {word} ", words + ([word] if shown else [])
        closed = "div" if tag == "p" else tag  # a paragraph would be closed by the blocks in it
        return f"<{closed} style='{style}'>{inner}</{closed}>", words

    for _ in range(300):
        html, words = grow(5, True)
        assert re.findall(r"w[0-9]+", render(html)) == words, html


def brute_counts(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    found = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + j for i in range(len(words) - 4) if found[tuple(words[i : i + 5])] > 1 for j in range(5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_counts_as_counted_one_by_one():
    rng = random.Random(3)
    for _ in range(500):
        text = "".join(rng.choice(["a ", "b ", "é\x85 ", "\n", "#* ", "c\t", "\xa0", "a b c d e f ", "x\n\n", "\r\n"]) for _ in range(rng.randrange(40)))
        assert text_counts(text.encode())[:5] == brute_counts(text), text
    assert text_counts(None)[:5] == brute_counts(None)


def test_words_of_long_texts_do_not_depend_on_pieces():
    text = b"alpha beta \xc3\xa9psilon " * 300_000
    hashes = word_hashes(text)
    assert len(hashes) == 900_000 and len(set(hashes.tolist())) == 3
    assert word_hashes(b"alpha")[0] == hashes[0]
    assert len(windows(hashes[:4], 5)) == 0 and len(shingles(b"One two")) == 1
    assert (shingles(b"A b c d e f") == shingles(b"a B\nc d e F")).all()


def concentrated(points, core, floor=1e-4):
    """The two starts refined to the end; the smaller determinant wins."""
    best = None
    mad = 1.4826 * np.median(abs(points - np.median(points, 0)), 0)
    for mean, cov in ((np.median(points, 0), np.diag(mad**2)), (points.mean(0), np.cov(points.T, bias=True))):
        for _ in range(20):
            cov = cov + floor * np.eye(points.shape[1])
            d2 = np.einsum("ij,jk,ik->i", points - mean, np.linalg.inv(cov), points - mean)
            inner = points[d2 <= np.sort(d2)[int(np.ceil(core * len(d2))) - 1]]
            mean, cov = inner.mean(0), np.cov(inner.T, bias=True)
        size = np.linalg.slogdet(cov + floor * np.eye(points.shape[1]))[1]
        if best is None or size < best[0]:
            best = size, mean
    return best


def test_minimum_determinant_as_in_numpy(spark):
    rng = np.random.default_rng(1)
    points = np.r_[rng.normal(0, 1, (300, 2)) @ [[1, 0.5], [0, 1]], rng.normal(9, 0.3, (60, 2))]
    df = spark.createDataFrame([("c", float(a), float(b)) for a, b in points], "cell string, x0 double, x1 double")
    fit = robust_distances(df, ["x0", "x1"]).collect()
    assert len(fit) == 1
    assert fit[0].centre == pytest.approx(concentrated(points, 0.75)[1], abs=1e-6)
    assert abs(np.array(fit[0].centre)).max() < 0.4  # the far group has no say


def test_outliers_of_documents(spark, documents, long_text):
    rng = random.Random(8)
    clean = [" ".join(f"{'wordsandmore'[: rng.randrange(2, 12)]}{rng.randrange(999)}" for _ in range(rng.randrange(60, 300))) + "." for _ in range(300)]
    texts = [*clean, "## $$ %% && " * 30 + clean[0], None, "", "too short", "one two three four five six " * 10, long_text, "!!? " + " ".join(f"A{i}!!!" for i in range(90)), clean[1]]
    langs = [None if i % 2 else "en" for i in range(len(texts))]
    got = {r.doc_id: r for r in reject_outliers(documents(texts, langs=langs)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        n, _, _, _, again = expected = brute_counts(t)
        assert tuple(got[i][c] for c in COUNTS[:5]) == expected
        assert got[i].base_failed == (n < 10 or 100 * again > 20 * n)
        assert not (got[i].base_failed and got[i].kept)
    assert all(got[i].kept for i in range(300)) and got[307].kept
    assert not got[300].kept and not got[306].kept
    assert reject_outliers(documents([])).count() == 0
    assert [r.kept for r in reject_outliers(documents([clean[0], None])).collect()].count(True) == 1


def varied(rng, n):
    """Clean texts of different lengths."""
    return [" ".join(f"{'wordsandmore'[: rng.randrange(2, 12)]}{rng.randrange(999)}" for _ in range(rng.randrange(60, 300))) + "." for _ in range(n)]


@pytest.mark.parametrize("share", [0.5, 0.8])
def test_copies_do_not_set_the_estimates(spark, documents, share):
    rng = random.Random(9)
    clean = varied(rng, 200)
    copies = [clean[0]] * round(200 * share / (1 - share))
    junk = ["## $$ %% && " * 30 + clean[1], "!!? " + " ".join(f"A{i}!!!" for i in range(90))]
    got = {r.doc_id: r.kept for r in reject_outliers(documents([*clean, *copies, *junk])).collect()}
    n = len(clean) + len(copies)
    assert all(got[i] for i in range(n))
    assert not any(got[i] for i in range(n, len(got)))


@pytest.mark.parametrize("junk", [0.3, 0.45])
def test_many_alike_outliers_are_rejected(spark, documents, junk):
    rng = random.Random(10)
    n = round(300 * (1 - junk))
    bad = ["\n".join("!!! " + t.upper() + " !!!" for t in text.split()) for text in varied(rng, 300 - n)]
    got = {r.doc_id: r for r in reject_outliers(documents([*varied(rng, n), *bad])).collect()}
    assert not any(r.base_failed and i < n for i, r in got.items())
    assert all(got[i].kept for i in range(n))
    assert not any(got[i].kept for i in range(n, 300))


def test_quality_of_held_out_documents(spark, documents):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9)))
    good = [" ".join(word() for _ in range(rng.randrange(30, 200))) + "." for _ in range(150)]
    bad = [" ".join(word().upper() + "!!" for _ in range(rng.randrange(30, 200))) for _ in range(80)]
    bad += [(word() + " ") * rng.randrange(40, 200) for _ in range(70)]
    docs = documents([*good, *bad, None, "", "x"])
    labels = spark.createDataFrame([(i, int(i < 150), 0) for i in range(300)] + [(1, None, 0), (5, 1, 1)], "doc_id long, quality int, toxic int")
    scored = classify_quality(docs, labels, per_class=100).select("*", held_out(docs.doc_id).alias("out")).collect()
    assert set(docs.columns) <= set(scored[0].asDict())
    test = [(r.doc_id < 150, r.score >= 0.3) for r in scored if r.out and r.doc_id < 300]
    assert len(test) > 40 and sum(a == b for a, b in test) >= 0.95 * len(test)
    assert all(0 <= r.score <= 1 for r in scored) and len(scored) == 303
    model = fit_neighbours(docs, labels, per_class=100)
    assert len(model.labels) <= 200
    assert scored[300].score == scored[301].score == pytest.approx(model.prior)
    assert classify_quality(docs.limit(0), labels).count() == 0
    assert {r.score for r in classify_quality(docs, labels.limit(0)).collect()} == {0.5}


def test_votes_as_counted_one_by_one():
    rng = np.random.default_rng(4)
    counts = rng.integers(0, 5, (40, 2066)).astype(np.float32)
    model = Neighbours(np.ones(2048, np.float32), rng.normal(size=(2066, 8)).astype(np.float32), np.zeros((0, 8)), rng.integers(0, 2, 30).astype(float), 0.5, 7)
    model.vectors = model.embed(counts[:30])
    for i, got in enumerate(model.score(counts)):
        cos = model.vectors @ model.embed(counts[i : i + 1])[0]
        near = sorted(range(30), key=lambda j: -cos[j])[:7]
        weight = [max(0.0, float(cos[j])) ** 16 for j in near]
        assert got == pytest.approx(sum(w * model.labels[j] for w, j in zip(weight, near, strict=True)) / sum(weight), abs=1e-4)


def tiled(item, text, least):
    """Greedy string tiling as published: rescan for the longest unmarked match each time."""
    a, b, tiles = [False] * len(item), [False] * len(text), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(text)):
                n = 0
                while i + n < len(item) and j + n < len(text) and item[i + n] == text[j + n] and not a[i + n] and not b[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return sum(a), tiles
        a[i : i + n] = [True] * n
        b[j : j + n] = [True] * n
        tiles += 1


def test_tiles_as_published():
    rng = random.Random(6)
    for _ in range(150):
        item = [rng.choice("abcde") for _ in range(rng.randrange(5, 30))]
        text = []
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(item))
            text += item[at : at + rng.randrange(3, 14)] + [rng.choice("abcdexyz") for _ in range(rng.randrange(4))]
        seeds = Seeds([" ".join(item).encode()], 3)
        got = seeds.matches(" ".join(text).encode(), 0.0)
        covered, _ = tiled(item, text, 3)
        # Among matches of equal length either may be marked first, which can shift the rest a little.
        assert abs((got[0][1] if got else 0) - covered) <= 4
        for m in got:
            assert m[1] <= len(item)


def test_tiles_do_not_overlap():
    words = tokens(b"a b c d e a b c d e a b c")
    found = windows(words, 3)
    pairs = np.array([(i, j) for i in range(len(found)) for j in range(len(found)) if found[i] == found[j]])
    tiles = tile(runs_of(pairs), len(words), len(words), 3)
    assert tiles == [(0, 0, 13)]


def test_runs_do_not_depend_on_the_pairs_held_at_once(monkeypatch):
    rng = random.Random(16)
    for _ in range(60):
        items = [" ".join(rng.choice("abc") for _ in range(rng.randrange(3, 25))).encode() for _ in range(4)]
        text = " ".join(rng.choice("abcd") for _ in range(rng.randrange(60))).encode()
        seeds = Seeds(items, 3)
        whole = seeds.matches(text, 0.3)
        words, found = tokens(text), windows(tokens(text), 3)
        for item, covered, n in whole:
            own = windows(tokens(items[item]), 3)
            pairs = np.array([(i, j) for i in range(len(own)) for j in range(len(found)) if own[i] == found[j]])
            tiles = tile(runs_of(pairs), seeds.sizes[item], len(words), 3)
            assert (sum(t[2] for t in tiles), len(tiles)) == (covered, n)
        monkeypatch.setattr("tessella.llm.decontaminate.PAIRS", 3)
        assert seeds.matches(text, 0.3) == whole
        monkeypatch.undo()


def test_a_long_repetitive_text_is_compared_whole():
    seeds = Seeds([b"a " * 60, b"a b " * 30], 5)
    start = time.time()
    assert seeds.matches(b"a " * 400_000 + b"x " + b"a b " * 40, 0.5) == [(0, 60, 1), (1, 60, 1)]
    assert time.time() - start < 60


def test_short_items_are_compared_whole(spark, documents):
    docs = documents(["What is, two plus", "so what is two plus", "What is two", "", None, "what is two plus"])
    bench = spark.createDataFrame([(1, "what is two plus"), (2, "!"), (3, None), (4, "What is two plus?")], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.covered, r.item_words, r.coverage) for r in benchmark_leaks(docs, bench).collect())
    assert got == [(d, i, 4, 4, 1.0) for d in (0, 5) for i in (1, 4)]
    assert sorted(r.doc_id for r in without_leaks(docs, bench).collect()) == [1, 2, 3, 4]


def test_leaks_in_any_order(spark, documents, long_text):
    item = " ".join(f"word{i}" for i in range(40))
    parts = item.split()
    mixed = " ".join([*parts[20:], "and then", *parts[:20]])
    texts = [
        f"before {item} after", f"start {mixed} end", f"x {item.upper().replace(' ', ', ')} y", " ".join(parts[:15]), "clean text of words",
        None, "", long_text + item, f"before {item} after", " ".join(parts[i] for i in range(0, 40, 2)),
    ]
    docs = documents(texts)
    bench = spark.createDataFrame([(7, item, "z"), (8, None, "z"), (9, "", "z"), (10, "clean text", "z"), (11, item, "z")], "item_id long, text string, doc_id string")
    for block_mb in (8, 0.0001):
        got = benchmark_leaks(docs, bench, block_mb=block_mb) if block_mb == 8 else None
        if got is not None:
            rows = {(r.doc_id, r.item_id): (r.covered, r.item_words, r.tiles) for r in got.collect()}
            assert set(rows) == {(d, i) for d in (0, 1, 2, 7, 8) for i in (7, 11)}
            assert rows[0, 7] == (40, 40, 1) and rows[1, 7] == (40, 40, 2)
    assert sorted(r.doc_id for r in without_leaks(docs, bench).collect()) == [3, 4, 5, 6, 9]
    assert without_leaks(docs, bench).columns == docs.columns
    assert benchmark_leaks(docs.limit(0), bench).count() == benchmark_leaks(docs, bench.limit(0)).count() == 0


def test_blocks_of_a_large_benchmark_agree(spark, documents):
    rng = random.Random(9)
    items = [" ".join(f"v{rng.randrange(500)}" for _ in range(200)) * 30 for _ in range(300)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = documents([f"a {items[5]} b", items[200], "none of it"])
    one = sorted(map(tuple, benchmark_leaks(docs, bench, block_mb=64).collect()))
    many = sorted(map(tuple, benchmark_leaks(docs, bench, block_mb=1).collect()))
    assert one == many and {r[0] for r in one} == {0, 1}
