"""Collocations, main text of pages and ranked lexical search against brute force."""

import html
import math
import random
import re
from collections import Counter

import pytest
from helpers import clashing, documents, rows

from vintagemart.llm import collocations, lexical, main_text, queries


def texts_with_phrases(seed, n=60):
    rng = random.Random(seed)
    texts = [None, "", " \t ", "...", "one", "ONE two\x01 , one two\x01", "x " * 3000]
    for i in range(n):
        words = []
        for _ in range(rng.randrange(1, 60)):
            words += rng.choice([["new", "york"], ["new", "york", "city"], ["b"], ["c", "d", "e", "f", "g"], ["The"], [f"w{rng.randrange(30)}"]])
        texts.append("".join(w + rng.choice([" ", " ", " ", "\t", ". ", "\n", "  "]) for w in words))
    return texts + texts[10:20]


def brute_collocations(pairs, least, most):
    counts, totals = Counter(), Counter()
    for lang, text in pairs:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    counts[lang, tuple(words[i : i + size])] += 1
    often = {k: a for k, a in counts.items() if a >= least and len(k[1]) > 1}
    out = []
    for (lang, p), a in often.items():
        around = [b for (other, q), b in often.items() if other == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
        if any(100 * b >= 80 * a for b in around):
            continue
        cuts = [(2_000_000 * a // (counts[lang, p[:k]] + counts[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.append((lang, -score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]], totals[lang]))
    ranked, seen = [], Counter()
    for lang, score, a, p, left, right, n in sorted(out):
        seen[lang] += 1
        if seen[lang] <= most:
            ranked.append((lang, seen[lang], p.decode(), -a, left, right, n, -score))
    return sorted(ranked)


@pytest.mark.parametrize("range_bytes", [collocations.RANGE_BYTES, 300])
def test_collocations(spark, monkeypatch, range_bytes):
    """With small ranges phrases go over many bounds, and blocks are merged."""
    monkeypatch.setattr(collocations, "RANGE_BYTES", range_bytes)
    texts = texts_with_phrases(3)
    langs = [[None, "en", "und", "en"][i % 4] for i in range(len(texts))]
    docs = spark.createDataFrame(list(zip(langs, texts)), "lang string, text string")
    got = collocations.collocations(clashing(docs).repartition(5), least=6, most=25)
    assert sorted(map(tuple, got.collect())) == brute_collocations(zip(langs, texts), 6, 25)
    assert dict(got.dtypes) == {"lang": "string", "phrase": "string"} | {c: "bigint" for c in ("rank", "a", "l", "r", "n", "score")}


def test_collocations_of_control_characters_and_equal_words(spark):
    texts = ["a\x00b a\x01 a a\x00b a\x01"] * 7 + ["z z z z z z"] * 5
    got = collocations.collocations(documents(spark, texts), least=6)
    assert sorted(map(tuple, got.collect())) == brute_collocations([("en", t) for t in texts], 6, 2000)


def test_collocations_of_nothing(spark):
    assert collocations.collocations(documents(spark, []).limit(0)).count() == 0
    assert collocations.collocations(documents(spark, [None, "", "one two"])).count() == 0


def test_collocation_scores_beyond_64_bits(spark):
    counts = spark.createDataFrame([(9 * 10**12,)], "a long")
    assert counts.select(collocations._times(collocations.SCORE_SCALE, counts.a).cast("string")).first()[0] == str(2_000_000 * 9 * 10**12)


def brute_search(docs, items, k):
    split = lambda t: re.findall(lexical.TERM, "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    found = [(i, Counter(split(t))) for i, t in docs]
    found = [(i, c, sum(c.values())) for i, c in found if c]
    n_docs, length = len(found), sum(n for _, _, n in found)
    having = Counter(t for _, c, _ in found for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(split(text))
    out = []
    for item, terms in asked.items():
        scored = []
        for i, c, n in found:
            m = 50 + (50 * n * n_docs) // length
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * having[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if c[t]
            )
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k], 1)]
    return out


@pytest.mark.parametrize("postings", [lexical.SEGMENT_POSTINGS, 40])
def test_search(spark, monkeypatch, postings):
    """With small segments the best so far are carried from one to the next."""
    monkeypatch.setattr(lexical, "SEGMENT_POSTINGS", postings)
    monkeypatch.setattr(lexical, "FIRST_ROUND", 2)
    rng = random.Random(5)
    words = [f"t{i}" for i in range(40)] + ["Élan", "a1", "élan", "日本"]
    texts = [None, "", "!?", "t1-T2_t3", "long " * 4000 + "t5"]
    texts += [" ".join(rng.choices(words, [1 / (i + 1) for i in range(len(words))], k=rng.randrange(1, 30))) for _ in range(300)]
    docs = [(i % 250, t) for i, t in enumerate(texts)] + [(None, "t1 t2"), (None, "t39 t38"), (7, "t39"), (7, "t39")]
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 9)))) for i in range(12)] + [(99, None), (98, "none here"), (3, "t17 T17"), (97, "t39")]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    got = lexical.search(clashing(table).repartition(3), clashing(spark.createDataFrame(items, "item_id long, text string")), k=10)
    assert rows(got, "item_id", "rank", "doc_id", "score") == sorted(brute_search(docs, items, 10), key=lambda r: tuple((v is None, str(v)) for v in r))


def test_search_stops_before_the_end(spark):
    """Of two lists that agree little has to be met; ties at the last place are kept."""
    import numpy as np

    n = 5000
    impacts = np.repeat(np.arange(n, 0, -1), 2) * 10
    segment = lexical.Segment(np.arange(n), np.zeros(n, dtype=bool), np.full(n, 2), np.tile([0, 1], n), impacts, 2)
    best = lexical.Best()
    assert segment.search(np.array([0, 1]), best, 3) < 100
    assert best.ids.tolist() == [0, 1, 2]
    flat = lexical.Segment(np.arange(n)[::-1].copy(), np.zeros(n, dtype=bool), np.ones(n, dtype=int), np.zeros(n, dtype=int), np.full(n, 5), 1)
    best = lexical.Best()
    assert flat.search(np.array([0]), best, 3) == n and best.ids.tolist() == [0, 1, 2]


def test_search_in_nothing(spark):
    docs, items = documents(spark, []).limit(0), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.search(docs, items).count() == 0
    assert lexical.search(documents(spark, ["a b"]), items.limit(0)).count() == 0
    assert lexical.search(documents(spark, [None, ""]), items).count() == 0


@pytest.fixture(scope="module")
def tree(spark):
    return main_text.fit(main_text.labelled_blocks(spark))


def test_main_text_of_given_pages(spark, small, tree):
    """No page of the table is labelled; each has its article in an element of its own."""
    pages = queries.table(spark, small, "pages")
    got = {r.page_id: r for r in main_text.extract(clashing(pages), tree).collect()}
    assert len(got) == pages.count()
    for r in pages.collect():
        article = r.html[r.html.index("<article>") + 9 : r.html.index("</article>")]
        parts = [" ".join(html.unescape(re.sub("</?b>", "", p)).split()) for p in re.split("</?(?:p|h1|br)>", article)]
        want = "\n".join(p for p in parts if p)
        assert (got[r.page_id].text, got[r.page_id].n_chars) == (want, len(want))


SENTENCE = "The quick brown fox jumps over the lazy dog while all the other animals of the wood look on and wonder what comes next."


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("<nav><a href=1>Home</a></nav><footer>End</footer>", ""),
        ("<article><p>a<br>b&nbsp; c &lt;p&gt; <!-- no <p> -->d</p><script>var x='</p>'</script><style>p{}</style><p>e</article>", "a b c <p> d\ne"),
        ("<article><p class='ad'>buy<p>tail &amp more &eacute;&#x41;", "tail & more éA"),
        ("<article><p>x <a title='a>b' href=y>link</a>ed</p><ul><li>one<li>two</ul><aside>no</aside><section class='reader-comments'><p>hi</p></section></article>",
         "x linked\none\ntwo"),
        (f"<body class='has-sidebar'><div id='site-header'>Site</div><div class='entry-content'><h2>T</h2><div>{SENTENCE}</div><form><p>{SENTENCE}</p></form></div>"
         f"<div class='cookieNotice'>{SENTENCE}</div><div class='sidebar'><p>{SENTENCE}</p></div></body>", f"T\n{SENTENCE}"),
        (f"<div role='navigation'>{SENTENCE}</div><main><header><h1>Head</h1></header>{SENTENCE}<div hidden>no</div></main>", f"Head\n{SENTENCE}"),
        (f"<ul><li><a href=1>Home page</a><li><a href=2>News</a></ul><p>{SENTENCE}</p><p>{SENTENCE}</p><p>{SENTENCE}</p><p><a href=3>Next page</a></p>",
         "\n".join([SENTENCE] * 3)),
        ("<article><p>" + "many words " * 50000 + "</p></article>", ("many words " * 50000).strip()),
        ("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>", "deep"),
    ],
)
def test_main_text(tree, page, text):
    found = main_text.blocks_of(page)
    main = tree.decide(main_text.features_of(found))
    assert "\n".join(b.text for b, m in zip(found, main) if m) == text


def test_main_text_of_no_pages_and_repeated_ones(spark, tree):
    pages = spark.createDataFrame([(1, "u", "<article>x</article>"), (1, "u", "<article>x</article>"), (None, None, None)], "page_id long, url string, html string")
    assert rows(main_text.extract(pages, tree), "page_id", "url", "text", "n_chars") == [(1, "u", "x", 1), (1, "u", "x", 1), (None, None, "", 0)]
    assert main_text.extract(pages.limit(0), tree).count() == 0


def test_tree_learns_from_other_labels(spark):
    """Labels decide: here what stands in a menu is wanted."""
    menu, article = "<nav data-main><p>menu</p></nav>", "<article><p>article</p></article>"
    other = main_text.fit(main_text.labelled_blocks(spark, [menu + article, article + menu, menu, article]))
    found = main_text.blocks_of("<article>x</article><nav>y</nav>")
    assert other.decide(main_text.features_of(found)).tolist() == [False, True]
