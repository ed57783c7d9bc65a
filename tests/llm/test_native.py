"""URL reputation, secret scan and source mix."""

import re

import pytest
from helpers import clashing, digest, documents, rows
from pyspark.sql import functions as F

from vintagemart.llm import mixing, queries, reputation, secrets

URLS = [
    ("http://A.Example.NET/en/1?x", "a.example.net", "/en/1", "example.net/en/"),
    ("https://example.com/de/", "example.com", "/de/", "example.com/de/"),
    ("https://badexample.com/de/", "badexample.com", "/de/", None),
    ("x://sub.org/fr/a#b", "sub.org", "/fr/a", "org/fr/"),
    ("x://a.org/en", "a.org", "/en", None),
    ("http://b.net", "b.net", "", None),
    ("http://b.net/", "b.net", "/", "net/"),
    ("http://b.net?q=/en/", "b.net", "", None),
    ("http://ÄB.net/x://y", "Äb.net", "/x://y", "net/"),
    ("no scheme.net/", "", "", None),
    ("", "", "", None),
    (None, "", "", None),
]


def test_urls_and_rules(spark):
    pages = clashing(spark.createDataFrame([(i, u[0]) for i, u in enumerate(URLS)], "page_id bigint, url string"))
    none = spark.createDataFrame([], "host string, bad int")
    got = {r.page_id: r for r in reputation.judge(pages, none, queries.URL_RULES).collect()}
    for i, (_, host, path, rule) in enumerate(URLS):
        verdict = {"net/": "block", "example.com/de/": "block"}.get(rule, "allow")
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, rule, verdict)
    assert reputation.judge(pages.limit(0), none, queries.URL_RULES).count() == 0


def test_hosts_are_shrunk_towards_their_domain(spark):
    counts = {"bad.a.com": (40, 38), "good.a.com": (400, 4), "few.a.com": (1, 1), "x.b.org": (50, 1), "y.b.org": (30, 29)}
    seen = [(h, int(i < k)) for h, (n, k) in counts.items() for i in range(n)] + [("x.b.org", None)]
    found = {r.host: r for r in reputation.host_reputation(spark.createDataFrame(seen, "host string, bad int")).collect()}
    assert found["bad.a.com"].bound > 0.5 and found["y.b.org"].bound > 0.5
    assert found["few.a.com"].bound < 0.5 and found["good.a.com"].mean < 0.1
    for host, (n, k) in counts.items():
        assert found[host].bound < found[host].mean
    pages = spark.createDataFrame([(i, f"http://{h}/") for i, h in enumerate([*counts, "new.c.com"])], "page_id bigint, url string")
    verdicts = reputation.judge(pages, spark.createDataFrame(seen, "host string, bad int"), []).collect()
    assert {r.host for r in verdicts if r.verdict == "block"} == {"bad.a.com", "y.b.org"}


@pytest.mark.parametrize("host, site, suffix, domain", [
    ("a.b.example.co.uk:8080", "a.b.example.co.uk", "co.uk", "example.co.uk"),
    ("me:pw@shop.example.com", "shop.example.com", "com", "example.com"),
    ("example.com", "example.com", "com", "example.com"),
    ("co.uk", "co.uk", "co.uk", "co.uk"),
    ("localhost:1", "localhost", "localhost", "localhost"),
    ("", "", "", ""),
])
def test_sites_suffixes_and_domains(spark, host, site, suffix, domain):
    row = spark.createDataFrame([(host,)], "host string").select(reputation.site_of(F.col("host")).alias("site"))
    found = row.select("site", *[c.alias(n) for n, c in zip(("suffix", "domain"), reputation.suffix_and_domain(F.col("site")))]).first()
    assert tuple(found) == (site, suffix, domain)


def test_names_below_a_shared_suffix_do_not_share_a_reputation(spark):
    """All of co.uk is no domain: a host without many pages follows its own one, whatever its port."""
    seen = [("a.bad.co.uk", 1)] * 60 + [("b.good.co.uk", 0)] * 400 + [("bad.org", 0)] * 50 + [("x.good.org", 0)] * 50
    outcomes = spark.createDataFrame(seen, "host string, bad int")
    pages = spark.createDataFrame([(1, "http://a.bad.co.uk:81/"), (2, "http://u@b.good.co.uk/"), (3, "http://bad.org/")], "page_id long, url string")
    got = {r.page_id: (r.host, r.verdict) for r in reputation.judge(pages, outcomes, []).collect()}
    assert got == {1: ("a.bad.co.uk:81", "block"), 2: ("u@b.good.co.uk", "allow"), 3: ("bad.org", "allow")}


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(found)


def listed(spans):
    return ",".join(f"{secrets.KIND_NAMES[k]}:{s}:{e}" for s, k, e in spans)


SECRETS = [
    None, "", "password=abcdef", "password: token: abcdefghij", "é😀 PASSWD = 'abc123' and token=x token=longer1",
    'x api-key apikey:"aB3/+=._-" API_KEY=12345', "AKIA" + "A1" * 9 + "AKIA0000", "AKIAAKIA" + "B" * 12, "0" * 23 + "g" + "a" * 24,
    "secret=" + "0f" * 30, "password=one123 password=two456\npassword=three7", "tokenſecret=abcdef", "to\u212aen=abcdefg",
    "password=abcdef " * 300, "zq9X7kP2vL4mT8wR1nB6cY3d and thousandthousandthousand",
]


def test_base_spans(spark):
    docs = clashing(documents(spark, [*SECRETS, SECRETS[9], (None, SECRETS[2], "s")]))
    for r in docs.join(secrets.scan(docs, None).withColumnRenamed("doc_id", "i"), F.col("doc_id").eqNullSafe(F.col("i"))).collect():
        spans = base_spans(r.text)
        kinds = [k for _, k, _ in spans]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(kinds.count(k) for k in range(3)), r.text
        assert r.base_sha256 == digest(listed(spans))
    assert secrets.scan(docs.limit(0), secrets.learn(docs.limit(0))).count() == 0


def plain_model(texts):
    """The two Markov models, counted in plain Python."""
    import math
    from collections import Counter

    counts = {True: Counter(), False: Counter()}

    def add(random, string):
        for a, b in zip(" " + string, string):
            counts[random][a, b] += 1

    for text in texts:
        if text is None:
            continue
        for m in ASSIGN.finditer(text):
            if len(m.group(2)) >= 6:
                add(True, m.group(2))
        for pattern in (secrets.ACCESS, secrets.HEX):
            for found in re.findall(pattern, text):
                add(True, found)
        for pattern in (ASSIGN, secrets.ACCESS, secrets.HEX):
            text = re.sub(pattern, " ", text)
        for word in re.findall("[A-Za-z0-9+/_=-]{6,}", text):
            if len(word) < 20:
                add(False, word)
    alphabet = " " + secrets.ALPHABET
    place = {c: i for i, c in enumerate(alphabet)}

    def logs(random):
        totals = Counter()
        grid = Counter()
        for (a, b), n in counts[random].items():
            totals[place.get(a, 0)] += n
            grid[place.get(a, 0), place.get(b, 0)] += n
        return {(a, b): math.log((grid[a, b] + 1) / (totals[a] + len(alphabet))) for a in range(len(alphabet)) for b in range(len(alphabet))}

    random, ordinary = logs(True), logs(False)
    return {k: random[k] - ordinary[k] for k in random}, place


def plain_spans(text, ratios, place, least):
    base = base_spans(text)
    added = []
    for m in re.finditer(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}", text or ""):
        codes = [0, *(place[c] for c in m.group())]
        mean = sum(round(ratios[a, b], 6) for a, b in zip(codes, codes[1:])) / len(m.group())
        if mean >= least and all(e <= m.start() or m.end() <= s for s, _, e in base):
            added.append((m.start(), 3, m.end()))
    return sorted(base + added)


def test_all_spans_are_those_of_a_plain_model(spark):
    docs = queries.table(spark, "/root/testdata/sf0.01", "documents")
    extra = [(10_000 + i, t) for i, t in enumerate(["key zq9X7kP2vL4mT8wR1nB6cY3d end", "http://ththe.example.org/thtion/thering-the-thousand", *SECRETS])]
    docs = docs.select("doc_id", "text").unionAll(spark.createDataFrame(extra, "doc_id long, text string"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    model = plain_model(texts.values())
    got = {r.doc_id: r.spans for r in secrets.scan(docs, secrets.learn(docs)).collect()}
    assert got == {i: listed(plain_spans(t, *model, secrets.LEAST_MEAN_RATIO)) for i, t in texts.items()}
    assert got[10_000] == "random:4:28"


def test_base_spans_of_a_table(spark):
    docs = queries.table(spark, "/root/testdata/sf0.01", "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in queries.op8_secret_scan(spark, "/root/testdata/sf0.01").collect():
        spans = base_spans(texts[r.doc_id])
        assert r.base_sha256 == digest(listed(spans))
        kept = r.spans.split(",") if r.spans else []
        assert [s for s in kept if not s.startswith("random:")] == [s for s in listed(spans).split(",") if s]


def test_random_runs_are_found_and_words_are_not(spark):
    docs = queries.table(spark, "/root/testdata/sf0.1", "documents")
    model = secrets.learn(docs)
    texts = ["key zq9X7kP2vL4mT8wR1nB6cY3d end", "thethrenerhenthererhatheringthen", "http://ththe.example.org/thtion/thering", "b7db7aa4A5fcc783-059fQ0"]
    got = {r.doc_id: r.spans for r in secrets.scan(documents(spark, texts), model).collect()}
    assert got[0] == "random:4:28" and got[1] == "" and got[2] == "" and got[3] != ""


def test_the_only_secrets_of_many_documents_are_learned_from(spark):
    """More documents than were once looked into, with matches in the last ones by hash of the id."""
    docs = spark.range(21_000).withColumn("rank", F.xxhash64(F.col("id").cast("string"))).orderBy("rank", "id")
    last = {r.id for r in docs.collect()[-200:]}
    held = F.col("id").isin(list(last))
    key = F.concat(F.lit("password="), F.translate(F.substring(F.base64(F.unhex(F.sha2(F.col("id").cast("string").cast("binary"), 256))), 1, 40), "=", ""))
    docs = docs.select(F.col("id").alias("doc_id"), F.when(held, key).otherwise(F.lit("ordinary thousand sentences")).alias("text"))
    model = secrets.learn(docs)
    assert model is not None
    texts = ["key zq9X7kP2vL4mT8wR1nB6cY3d end", "ordinary-thousand-sentences"]
    assert [r.spans for r in secrets.scan(documents(spark, texts), model).orderBy("doc_id").collect()] == ["random:4:28", ""]


def test_redaction(spark):
    docs = clashing(documents(spark, [*SECRETS, SECRETS[9]]))
    clean = secrets.redact(docs, None)
    assert clean.columns == docs.columns and clean.drop("text").exceptAll(docs.drop("text")).count() == 0
    for r in clean.collect():
        text, spans = SECRETS[r.doc_id] if r.doc_id < len(SECRETS) else SECRETS[9], None
        spans = base_spans(text)
        want, at = "", 0
        for start, _, end in spans:
            if start >= at:
                want += text[at:start] + "<secret>"
            at = max(at, end)
        assert r.text == (want + text[at:] if spans else text)


def sizes(n):
    return "w " * n


def test_mix_meets_its_targets(spark):
    docs = [(i, sizes(5 + i * 37 % 91), f"s{i % 4}") for i in range(800)] + [(900 + i, sizes(40), None) for i in range(100)]
    docs += [(2000, None, "s0"), (2001, "", "s1"), (2002, sizes(5000), "s9"), (None, sizes(7), "s2"), (3, sizes(8), "s3"), (3, sizes(8), "s3")]
    df = clashing(documents(spark, docs))
    found = mixing.taken(df).cache()
    total = sum(len((t or "").split()) for _, t, _ in docs)
    by = {r.source: r for r in found.groupBy("source").agg(
        F.sum(F.col("copies") * F.col("size")).alias("taken"), F.max("target").alias("target"), F.max("source_size").alias("size"), F.max("size").alias("most")).collect()}
    assert sum(r.target for r in by.values()) == pytest.approx(1.5 * total)
    for r in by.values():
        assert r.target <= 2 * r.size and abs(r.taken - r.target) <= 0.5 * r.most + 1
    assert found.where("copies > 2 or copies < 0").count() == 0 and found.count() == len(docs)
    assert found.exceptAll(mixing.taken(df.repartition(5))).count() == 0
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    assert mixed.count() == found.where("size > 0").agg(F.sum("copies")).first()[0]
    weighed = mixing.taken(df.withColumn("likes", F.when(F.col("doc_id") % 2 == 0, 3.0).otherwise(0.3)), weight_column="likes")
    share = {r.even: r.s for r in weighed.where("source = 's0' or source = 's1'").groupBy((F.col("id") % 2 == 0).alias("even")).agg(F.avg("copies").alias("s")).collect()}
    assert weighed.count() == len(docs) and len(share) == 2


def test_sources_at_their_cap_are_not_put_in_order(spark, monkeypatch):
    """Half of the sources meet their cap; none of their rows may reach the search for a boundary."""
    docs = documents(spark, [(i, sizes(20), f"s{i % 4}") for i in range(400)] + [(1000 + i, None, "s0") for i in range(5)])
    cuts = {}
    real = mixing.written

    def written(df, name):
        cuts[name] = real(df, name)
        return cuts[name]

    monkeypatch.setattr(mixing, "written", written)
    found = {r.id: r for r in mixing.taken(docs).collect()}
    whole = {r.source for r in cuts["mix-targets"].where("rest = 0").collect()}
    assert whole and whole.isdisjoint(r.source for r in cuts["mix-cuts"].collect())
    assert all(r.copies == round(r.target / r.source_size) for r in found.values() if r.source in whole)


def test_mix_of_nothing(spark):
    empty = documents(spark, [])
    assert mixing.taken(empty).count() == mixing.mix(empty).count() == 0
    blank = documents(spark, [(1, None, "a"), (2, "", None)])
    assert rows(mixing.taken(blank), "id", "target", "copies") == [(1, 0.0, 0), (2, 0.0, 0)]
    assert mixing.mix(blank).count() == 0


@pytest.mark.parametrize("sizes_, want", [({"a": 10, "b": 10}, {"a": 20.0, "b": 10.0}), ({"a": 1, "b": 100, "c": 1}, {"a": 2.0, "b": 149.0, "c": 2.0})])
def test_targets_stop_at_twice_the_source(spark, sizes_, want):
    sized = spark.createDataFrame(list(sizes_.items()), "source string, size bigint")
    assert {r.source: r.target for r in mixing.targets(sized).collect()} == pytest.approx(want)


def test_native_queries_run_no_python(spark, small):
    for query in (queries.op8_secret_scan, queries.op10_source_mix, queries.op2_url_reputation):
        plan = query(spark, small)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


def test_documents_of_a_source_have_chances_of_their_own(spark):
    """Within a source the order of the ranks is not that of the random numbers, and longer documents are likelier."""
    docs = documents(spark, [(i, sizes(4 if i % 2 else 400), "s1") for i in range(4000)] + [(9000 + i, sizes(3000), f"s{i % 2 * 2}") for i in range(600)])
    sized = docs.select(F.col("doc_id").alias("id"), "source", mixing.size_of(F.col("text")).alias("size"))
    sized = sized.withColumn("chance", F.floor(16 * F.sqrt("size")).cast("long")).withColumn("u", mixing.uniform(F.col("id"), F.col("size"), F.lit(0)))
    left = mixing.chances(sized, mixing.targets(sized))
    ranked = mixing._ranked(sized, left).where("source = 's1' and rank is not null").collect()
    by_number, by_rank = (lambda r: r.u), (lambda r: (r["rank"], r.u))
    assert len(ranked) == 4000 and sorted(ranked, key=by_number) != sorted(ranked, key=by_rank)
    for size in (4, 400):
        same = [r for r in ranked if r["size"] == size]
        assert sorted(same, key=by_number) == sorted(same, key=by_rank)
    taken = mixing.taken(docs).where("source = 's1'").groupBy("size", "target").agg(F.avg("copies").alias("share"), F.sum(F.col("copies") * F.col("size")).alias("taken"))
    found = {r["size"]: r for r in taken.collect()}
    assert found[400].share > found[4].share > 0
    assert abs(found[400].taken + found[4].taken - found[4].target) <= 200


def test_chances_of_one_and_more_are_certain(spark):
    """One document has nearly all words; a source without whole copies may still be sure to take it."""
    sized = spark.createDataFrame([("a", 10_000, 1600)] + [("a", 1, 16)] * 2000, "source string, size long, chance long")
    wanted = spark.createDataFrame([("a", 12_000, 11_000.0, 0, 11_000.0)], "source string, source_size long, target double, copies long, rest double")
    left = mixing.chances(sized, wanted).first()
    assert (left.sure, left.rest, left.scale) == (16, 1000.0, 32_000.0)


def test_rows_of_one_id_are_spread(spark):
    """A third of all rows is one row, another one id: each has a random number of its own, and the words still meet the target."""
    docs = documents(spark, [(1, sizes(10), "s0")] * 1500 + [(2, sizes(1 + i % 40), "s0") for i in range(1500)] + [(10 + i, sizes(30), f"s{i % 3}") for i in range(1500)]).repartition(6)
    sized = docs.select(F.col("doc_id").alias("id"), "source", mixing.size_of(F.col("text")).alias("size"))
    numbered = mixing._numbered(sized)
    assert numbered.count() == 4500
    assert numbered.groupBy("id", "source", "size").agg(F.count_distinct("copy").alias("n"), F.max("copy").alias("m"), F.count(F.lit(1)).alias("c")).where("n <> c or m <> c - 1").count() == 0
    found = mixing.taken(docs).cache()
    assert found.where("id = 1").select("copies").distinct().count() == 2
    assert found.exceptAll(mixing.taken(docs.coalesce(2))).count() == 0
    for r in found.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("taken"), F.max("target").alias("target")).collect():
        assert abs(r.taken - r.target) <= 20
    assert mixing.mix(docs).count() == found.agg(F.sum("copies")).first()[0]
