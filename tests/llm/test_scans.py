"""Operators that read each row for itself: extraction, licences, secrets."""

import hashlib
import math
import re
import time
from collections import Counter

import pytest

from hitflow.llm import extract, licenses, queries, secrets

SF_DIR = "/root/testdata/sf0.001"
SCORES = extract.weights({})

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header><a href=/>Home</a> Site</header><nav><ul><li><a href=a>One</a></li></ul></nav>
<div class="cookie-notice">We use cookies to make this site work well</div>
<article><h1>Big title</h1><p>First paragraph with <a href="x">a link of words</a> and more &eacute;t&eacute; &amp; caf&#233;.
<p>Second <b>bold</b>   one<br>goes on and is long enough.
<div class="ad">Buy now this product is cheap</div><aside>Side words here</aside>
<ul><li>item one of the list<li>item two of the list</ul>
<form><label>Name</label><input></form><script>if (a<b) "</p>"</script><p>The end is here.</p></article>
<section class="comments"><h2>Comments</h2><p>Great article, I liked it a lot.</p></section><footer>&copy; 2020</footer></body></html>"""


def test_article_is_found_and_the_rest_left_out():
    assert extract.main_text(PAGE, SCORES).split("\n\n") == [
        "Big title",
        "First paragraph with a link of words and more été & café.",
        "Second bold one goes on and is long enough.",
        "item one of the list",
        "item two of the list",
        "The end is here.",
    ]


LONG = [f"This is sentence number {i} of a text that goes on for a while, as articles do." for i in range(8)]
BODY = "".join(f"<p>{line}</p>" for line in LONG)
MENU = "<nav><ul>" + "".join(f"<li><a href=/{i}>Menu entry {i}</a></li>" for i in range(12)) + "</ul></nav>"
FOOT = "<footer><p>All rights reserved by the owner of this site</p></footer>"


@pytest.mark.parametrize(
    "html",
    [
        f"<html><body>{MENU}<div><h1>The title</h1>{BODY}</div>{FOOT}</body></html>",
        f"<html><body><form action=x>{MENU}<h1>The title</h1>{BODY}{FOOT}</form></body></html>",
        f"<html><body><div>{MENU.removesuffix('</nav>')}</div><div><h1>The title</h1>{BODY}</div>{FOOT}</body></html>",
        f"<html><body>{MENU.removesuffix('</nav>')}<article><h1>The title</h1>{BODY}</article>{FOOT}</body></html>",
        f"<html><body>{MENU}<div class='search-result widget-area'><h1>The title</h1>{BODY}</div>{FOOT}</body></html>",
        f"<html><body>{MENU}<svg><main><h1>The title</h1>{BODY}</main>{FOOT}</body></html>",
        f"<html><body>{MENU}<script>var a = 1;<h1>The title</h1>{BODY}{FOOT}</body></html>",
        f"<html><body>{MENU}<main><h1>The title</h1><div class=ad><p>Buy this {'now ' * 20}</p></div>{BODY}</main>{FOOT}</body></html>",
        f"<html><body>{MENU}<div><h1>The title</h1>{BODY}</div><div id=comments>{BODY.replace('This', 'My') * 3}</div>{FOOT}</body></html>",
    ],
)
def test_articles_without_marks_or_in_odd_places(html):
    blocks = extract.main_text(html, SCORES).split("\n\n")
    assert [b for b in blocks if not b.startswith("Menu entry")] == ["The title", *LONG]
    assert len(blocks) <= len(LONG) + 1


@pytest.mark.parametrize("part", ["<b>", "</b>", "<div>", "</div>x", "<svg>", "<b>x", "<nav>y", "<form>", "<p>w", "<!--x", "<a '"])
def test_long_pages_take_linear_time(part):
    begin = time.monotonic()
    assert isinstance(extract.main_text(part * (1_000_000 // len(part)), SCORES), str)
    assert time.monotonic() - begin < 30


@pytest.mark.parametrize("html", [None, "", "<", "<p", "<nav>x", "<!-- open", "<script>x", "&amp", "</p></p>"])
def test_broken_pages_do_not_fail(html):
    assert isinstance(extract.main_text(html, SCORES), str)


def test_best_region_equals_all_regions():
    scores = [-1.0, 2.0, -0.5, 1.0, -3.0, 2.0, -1.0]
    start, end = extract.best_region(scores)
    every = [sum(scores[a:b]) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)]
    assert sum(scores[start:end]) == max(every)
    assert extract.best_region([-1.0]) == extract.best_region([]) == (0, 0)


def test_pages_equal_their_articles(spark):
    rows = {r.page_id: r for r in queries.op1_html_extraction(spark, SF_DIR).collect()}
    pages = queries.table(spark, SF_DIR, "pages").collect()
    assert len(rows) == len(pages)
    import html

    for page in pages:
        inner = page.html.split("<article>")[1].split("</article>")[0]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", inner)]
        assert rows[page.page_id].text == "\n\n".join(b for b in blocks if b)
        assert rows[page.page_id].n_chars == len(rows[page.page_id].text)


def test_odd_pages_in_a_table(spark):
    schema = "page_id bigint, url string, html string, text string, n_chars bigint"
    df = spark.createDataFrame([(1, None, None, "own", 3), (None, "u", "", None, None), (2, "u", PAGE, "", 0), (2, "u", PAGE, "", 0)], schema)
    assert sorted(r.n_chars > 0 for r in extract.extract(df).collect()) == [False, False, True, True]
    assert extract.extract(df.where("false")).count() == 0


@pytest.mark.parametrize(
    "source, sets",
    [
        ("mit", [{"mit"}]),
        ("mit or apache-2.0", [{"mit"}, {"apache-2.0"}]),
        ("mit or bsd and isc", [{"mit"}, {"bsd", "isc"}]),
        ("(mit or bsd) and isc", [{"mit", "isc"}, {"bsd", "isc"}]),
        ("gpl-2.0 with classpath-exception or mit", [{"gpl-2.0-with-classpath-exception"}, {"mit"}]),
        ("mit or mit and isc", [{"mit"}]),
    ],
)
def test_expressions(source, sets):
    assert [set(s) for s in licenses.choices(licenses.parse(source))] == sets


@pytest.mark.parametrize("source", ["", "or mit", "(mit", "mit and", "()", "(mit or bsd) with x"])
def test_malformed_expressions(source):
    assert licenses.parse(source) is None


def test_long_expressions_are_read_to_their_end():
    scanner = licenses.Scanner()
    names = [f"lic-{i}" for i in range(1000)]
    found = scanner.scan("x SPDX-License-Identifier: " + " OR ".join(names) + "\nor another line")
    assert found.labels == set(names) and found.score == 1.0 and found.expressions == [" or ".join(names)]
    pairs = scanner.scan("License-Expression: " + " and ".join(f"(a{i} or b{i})" for i in range(1000)))
    assert len(pairs.labels) == 2000
    assert scanner.scan("SPDX-License-Identifier: " + "(" * 3000 + "mit" + ")" * 3000).labels == {"mit"}


def test_expressions_evaluate_and_print():
    tree = licenses.parse("mit and (bsd or isc) or gpl-2 with classpath")
    assert licenses.written(tree) == "mit and (bsd or isc) or gpl-2-with-classpath"
    assert licenses.licences(tree) == ["bsd", "gpl-2-with-classpath", "isc", "mit"]
    for accepted in ({"mit"}, {"mit", "isc"}, {"gpl-2-with-classpath"}, {"bsd", "isc"}):
        assert licenses.satisfied(tree, accepted) == any(s <= accepted for s in licenses.choices(tree))


def test_licence_scan_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in queries.table(spark, SF_DIR, "documents").collect()}
    lower = {c: c + 32 for c in range(65, 91)}
    for row in queries.op6_license_scan(spark, SF_DIR).collect():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", docs[row.doc_id].translate(lower))
        places = [
            (i, label) for phrase, label in licenses.BASE.items() for i in range(len(words))
            if words[i : i + len(phrase.split())] == phrase.split()
        ]
        starts = [p[0] for p in places]
        assert (row.n_words, row.n_base, row.first_word, row.last_word) == (
            len(words), len(places), min(starts, default=None), max(starts, default=None)
        )
        assert row.base_labels == ",".join(sorted({p[1] for p in places}))
        assert set(row.base_labels.split(",")) - {""} <= set(row.labels.split(","))
        assert 0 <= row.score <= 1


def test_licence_scan_of_odd_rows(spark):
    text = "Under the MIT-license, UNDER the mit license.\nSPDX-License-Identifier: (MIT OR Apache-2.0) AND Zlib\nété cc by nc"
    df = spark.createDataFrame([(1, text, "x"), (None, None, "y"), (1, text, "x"), (2, "", "z")], "doc_id bigint, text string, labels string")
    rows = sorted(licenses.scan(df).collect(), key=lambda r: (r.n_words, r.doc_id or 0))
    assert [(r.n_words, r.n_base, r.score, r.labels) for r in rows[:2]] == [(0, 0, 0.0, "")] * 2
    assert rows[2] == rows[3]
    assert (rows[2].n_base, rows[2].first_word, rows[2].base_labels, rows[2].labels) == (3, 0, "cc-by-nc,mit", "apache-2.0,cc-by-nc,mit,zlib")
    assert rows[2].score == 1.0
    assert licenses.scan(df.where("false")).count() == 0


def _entropy(text):
    return -sum(c / len(text) * math.log2(c / len(text)) for c in Counter(text).values())


@pytest.mark.parametrize("text", ["a", "ab" * 30, "k3J9xQ2vL8mN5pR7tW1yZ4", "0123456789abcdef" * 3, "aaaaaaaaaaaaaaaaaaaaaaaab"])
def test_sliding_entropy_equals_fresh_counts(text):
    windows = [text[i : i + secrets.WINDOW] for i in range(max(1, len(text) - secrets.WINDOW + 1))]
    assert secrets.peak_entropy(text) == pytest.approx(max(map(_entropy, windows)))


def _base_spans(text):
    found = []
    pattern = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    pattern = re.sub(r"(?<![A-Za-z])(password\|passwd\|secret\|token\|api_\?key)", lambda m: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in m[1]), pattern)
    found += [(m.start(), m.end(), "assign") for m in re.finditer(pattern, text) if len(m[2]) >= 12]
    found += [(m.start(), m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found, key=lambda s: (s[0], secrets.KINDS.index(s[2])))


def test_secret_scan_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in queries.table(spark, SF_DIR, "documents").collect()}
    for row in queries.op9_secret_scan(spark, SF_DIR).collect():
        base = _base_spans(docs[row.doc_id])
        assert row.base_sha256 == hashlib.sha256(secrets.listed(base).encode()).hexdigest()
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(sum(s[2] == k for s in base) for k in secrets.KINDS[:3])


@pytest.mark.parametrize(
    "text",
    ["Password = 'abcDEF123456x'", "token=token:abcdefghijkl", "API_KEY:abcdefghijklmn ſecret=abcdefghijklmn", "xAKIAABCDEFGHIJKLMN0 AKIAAKIA1",
     "é secret  =  \"0123456789abcdef0123\"", "deadbeefdeadbeef", ""],
)
def test_base_patterns(text):
    assert [s for s in secrets.spans(text) if s[2] != "entropy"] == _base_spans(text)


def test_random_strings_are_found_and_harmless_ones_not():
    assert [s[2] for s in secrets.spans("key k3J9xQ2vL8mN5pR7tW1yZ4uB6 end")] == ["entropy"]
    for text in ("internationalisierungsmassnahmen", "example_k3J9xQ2vL8mN5pR7tW1yZ4", "123e4567-e89b-12d3-a456-426614174000", "a-long-name-of-a-file-2024"):
        assert not [s for s in secrets.spans(text) if s[2] == "entropy"]


def test_secret_scan_of_odd_rows(spark):
    df = spark.createDataFrame([(None, None), (1, ""), (1, "AKIA" + "A" * 14), (1, "AKIA" + "A" * 14)], "doc_id bigint, text string")
    assert Counter(r.spans for r in secrets.scan(df).collect()) == {"": 2, "access:0:18": 2}
    assert secrets.scan(df.where("false")).count() == 0
