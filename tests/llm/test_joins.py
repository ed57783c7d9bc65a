"""Near duplicates, repeated passages and top-k search against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from helpers import clashing, digest, documents, rows
from pyspark.sql import functions as F

from vintagemart.llm import components, jaccard, queries, repeats, topk


def family(rng, n, words, edits):
    base = [f"w{rng.randrange(9999)}" for _ in range(words)]
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randrange(edits + 1)):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(9999)}"
        yield " ".join(copy)


def mixed_corpus(seed):
    rng = random.Random(seed)
    texts = [None, "", " \n ", "one two", "ONE Two", "one two three four five", "a a a a a a a a", "long " * 9000]
    for n, words, edits in ((40, 80, 6), (3, 30, 2), (12, 200, 40), (5, 12, 1)):
        texts += family(rng, n, words, edits)
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [f"u{i} {passage} " + " ".join(f"v{rng.randrange(9**6)}" for _ in range(150)) for i in range(25)]
    return texts + texts[5:9] + [texts[20].upper()]


def brute_classes(texts):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return [(i, len(s), find(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize("limit", [jaccard.REGION_GRAMS, 900])
def test_classes(spark, monkeypatch, limit):
    """With a small limit regions are split by pivots and at last compared by blocks."""
    real = jaccard.join_regions
    monkeypatch.setattr(jaccard, "join_regions", lambda *a: real(*a, limit=limit))
    texts = mixed_corpus(limit)
    docs = clashing(documents(spark, texts)).repartition(3)
    assert sorted(map(tuple, jaccard.classes(docs).collect())) == brute_classes(texts)


def test_cells_inside_a_region(monkeypatch):
    monkeypatch.setattr(jaccard, "CELL_POINTS", 4)
    monkeypatch.setattr(jaccard, "CELL_PIVOTS", 3)
    rng = random.Random(5)
    texts = [t for n in range(12) for t in family(rng, 9, 60, 5)]
    sets = jaccard.shingle_sets(texts)
    region = jaccard.Region(np.arange(len(sets)), sets)
    region.join()
    a, b = region.edges()
    assert list(b) == [c for _, _, c in brute_classes(texts)]


def test_one_document_of_each_class_stays(spark):
    texts = mixed_corpus(3)
    docs = clashing(documents(spark, texts))
    kept = jaccard.keep_smallest(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == [i for i, _, c in brute_classes(texts) if i == c]
    odd = documents(spark, [(None, "a b c d e f", "s"), (7, "a b c d e f", "s"), (7, "a b c d e f", "t"), (None, None, "s"), (7, "else", "s")])
    assert rows(jaccard.keep_smallest(odd), "doc_id", "text") == [(7, "a b c d e f"), (7, "else"), (None, None)]
    assert jaccard.keep_smallest(docs.limit(0)).count() == jaccard.classes(docs.limit(0)).count() == 0


@pytest.mark.parametrize("bits", [jaccard.FILTER_BITS, 40_000, 3])
def test_rows_of_regions_are_never_left_behind(spark, bits):
    texts = spark.range(2000).selectExpr("if(id = 7, null, id) as id", "concat('t', id) as text", "id * 31 as digest")
    chosen = texts.where("digest % 5 = 0 or id is null").selectExpr("struct(id, digest) as row")
    near = jaccard.maybe_chosen(texts, chosen, bits)
    assert near.columns == texts.columns
    wanted = {tuple(r.row) for r in chosen.collect()}
    found = [tuple(r) for r in near.collect()]
    assert wanted <= {(i, d) for i, _, d in found}
    assert set(found) <= {tuple(r) for r in texts.collect()}
    assert len(found) < 500 or bits == 3
    assert jaccard.maybe_chosen(texts, chosen.limit(0), bits).count() == 0


def test_prefix_holds_a_shared_shingle(spark):
    rng = random.Random(9)
    texts = list(family(rng, 60, 60, 3))
    sets = jaccard.shingle_sets(texts)
    rare = jaccard.rarity(documents(spark, texts).repartition(3), 5)
    seen = Counter(np.concatenate(sets).tolist())
    for a in sets:
        # Counts are never too low.
        assert all(n >= min(3, seen[g]) for g, n in zip(a.tolist(), rare.counts(a)[0].tolist()))
        for b in sets:
            if jaccard.links(a, b) and (a is not b):
                assert len(np.intersect1d(jaccard.prefix(a, rare), jaccard.prefix(b, rare)))


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 140)] + [(5, i) for i in range(6, 30)] + [(rng.randrange(60, 90), rng.randrange(60, 90)) for _ in range(30)]
    want = {}
    for a, b in edges:
        group = want.get(a, {a}) | want.get(b, {b})
        for x in group:
            want[x] = group
    found = components.components(spark.createDataFrame(edges, "a bigint, b bigint"))
    assert {r.node: r.root for r in found.collect()} == {n: min(g) for n, g in want.items() if n != min(g)}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.mark.parametrize("edges, rounds", [([(5, 1), (1, 7), (9, 2), (9, 9)], 0), ([(3, 2), (2, 1)], 1), ([(3, 1), (3, 2)], 1), ([], 0)])
def test_components_of_stars_take_no_round(spark, monkeypatch, edges, rounds):
    names, real = [], components.written
    monkeypatch.setattr(components, "written", lambda df, name: names.append(name) or real(df, name))
    found = components.components(spark.createDataFrame(edges, "a bigint, b bigint"))
    assert names == ["edges"] + ["stars"] * rounds
    roots = {node: 1 for node in (2, 3)} if rounds else {5: 1, 7: 1, 9: 2} if edges else {}
    assert {r.node: r.root for r in found.collect()} == roots


def test_counters_come_in_few_parts(spark, monkeypatch):
    parts, real = [], type(spark.range(1)).toLocalIterator
    monkeypatch.setattr(type(spark.range(1)), "toLocalIterator", lambda self, *a: parts.append(self.rdd.getNumPartitions()) or real(self, *a))
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    texts = [f"word{i % 7} and some more words here {i % 9}" for i in range(40)]
    try:
        for key, value in zip(before, (40, "false")):
            spark.conf.set(key, value)
        jaccard.classes(documents(spark, texts)).count()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert len(parts) >= 2 and max(parts) <= jaccard.PARTS


def test_sets_that_share_a_number_are_told_apart(spark, monkeypatch):
    """Numbers of three values only: nearly all sets share theirs with others."""
    real = jaccard.set_number
    monkeypatch.setattr(jaccard, "set_number", lambda grams, seed=jaccard.M1: real(grams, seed) % 3 if seed == jaccard.M1 else real(grams, seed))
    texts = mixed_corpus(11)[:60]
    assert sorted(map(tuple, jaccard.classes(documents(spark, texts).repartition(3)).collect())) == brute_classes(texts)


def test_many_equal_rows_are_one_before_they_are_joined(spark, monkeypatch):
    """A near copy brings the repeated row into a region; the region has its text once."""
    text = " ".join(f"w{i}" for i in range(200))
    docs = spark.range(3000).select(F.lit(5).cast("long").alias("doc_id"), F.lit(text).alias("text"))
    docs = docs.unionAll(spark.createDataFrame([(6, text + " more"), (7, "x")], "doc_id long, text string")).repartition(4)
    seen = []
    real = jaccard.join_regions
    monkeypatch.setattr(jaccard, "join_regions", lambda texts, chosen, *a: seen.append(chosen.count()) or real(texts, chosen, *a))
    monkeypatch.setattr(jaccard, "written", lambda df, name: seen.append((name, jaccard_written(df, name).count())) or jaccard_written(df, name))
    found = jaccard.classes(docs).groupBy("doc_id", "component_id").count()
    assert sorted(map(tuple, found.collect())) == [(5, 5, 3000), (6, 5, 1), (7, 7, 1)]
    assert ("members", 2) in seen
    assert sorted(r.doc_id for r in jaccard.keep_smallest(docs).collect()) == [5, 7]


jaccard_written = jaccard.written


def test_counters_in_two_bits():
    import numpy as np

    packed = np.zeros(4, dtype=np.uint8)
    for slots in ([0, 1, 1, 5, 15], [1, 1, 1, 5, 2], [15] * 9):
        jaccard._count_up(packed, np.array(slots, dtype=np.uint32))
    assert jaccard._unpacked(packed).tolist() == [1, 3, 1, 0, 0, 2] + [0] * 9 + [3]


def test_sets_that_share_few_shingles_stay_out_of_regions(spark, monkeypatch):
    """Each text shares a passage with the next one; counters too few for the corpus must not bring them into regions."""
    monkeypatch.setattr(jaccard, "FINE", 1 << 8)
    monkeypatch.setattr(jaccard, "WIDE", 1 << 6)
    rng = random.Random(4)
    texts = [" ".join([f"p{i} q{i} r{i} s{i} t{i} u{i}"] + [f"w{rng.randrange(10**6)}" for _ in range(80)] + [f"p{i + 1} q{i + 1} r{i + 1} s{i + 1} t{i + 1} u{i + 1}"]) for i in range(60)]
    copies = [texts[0] + " more", texts[30] + " and more"]
    seen, real = [], jaccard.join_regions
    monkeypatch.setattr(jaccard, "join_regions", lambda texts, chosen, *a: seen.extend(r.row.id for r in chosen.collect()) or real(texts, chosen, *a))
    found = jaccard.classes(documents(spark, texts + copies).repartition(5))
    assert sorted(map(tuple, found.collect())) == brute_classes(texts + copies)
    assert sorted(seen) == [0, 30, 60, 61]


@pytest.mark.parametrize("most, size", [(20_000, 7), (3, 7), (3, 1), (2, 10_000)])
def test_linked_sets_share_a_needed_key(monkeypatch, most, size):
    """The three steps of the first regions, in batches of any size and with keys of more sets than are held."""
    import pyarrow as pa

    monkeypatch.setattr(jaccard, "HELD_SETS", most)
    rng = random.Random(most + size)
    texts = [t for n, words, edits in ((25, 60, 4), (9, 150, 8), (6, 20, 1), (5, 9, 1)) for t in family(rng, n, words, edits)] + ["a b", "a b c d e f"]
    sets = {jaccard.set_number(g): g for g in jaccard.shingle_sets(texts)}

    def run(step, names, rows):
        table = pa.table({n: pa.array([r[i] for r in rows], pa.int64()) for i, n in enumerate(names)})
        return [tuple(r.values()) for b in step(jaccard.THRESHOLD, iter(table.to_batches(max_chunksize=size))) for r in b.to_pylist()]

    keyed = sorted((k, len(g), n) for n, g in sets.items() for k in jaccard.first_keys(g).view(np.int64).tolist())
    held = run(jaccard._held_by_others, ["key", "n", "set"], sorted(keyed + keyed[::3]))
    assert len(held) == len({r[:3] for r in held}) and {r[:3] for r in held} <= set(keyed)
    for key, n, number, holders in held:
        near = [m for k, m, _ in keyed if k == key and min(m, n) >= 0.8 * max(m, n)]
        assert min(len(near), most) >= 2 and holders >= min(len(near), most)
    needed = run(jaccard._needed, ["set", "n", "key"], [(s, n, k) for s, _, k, n in sorted((s, h, k, n) for k, n, s, h in held)])
    root = {n: n for n in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in run(jaccard._share_a_key, ["key", "n", "set"], sorted((k, n, s) for s, n, k in needed)):
        root[find(a)] = find(b)
    assert all(find(a) == find(b) for a, x in sets.items() for b, y in sets.items() if jaccard.links(x, y))


def test_rows_that_stay_are_not_moved(spark, monkeypatch):
    """Only rows that go, and rows equal in id and text, are dealt out anew; a null id and a repeated row come out right."""
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(i, f"{i} " + text.replace("w", f"v{i}_"), "s") for i in range(40)] + [(None, text, "s"), (50, text + " x", "s"), (51, text, "s"), (None, text, "s")]
    rows += [(60, "twice in all", "s"), (60, "twice in all", "t"), (None, "no id", "s"), (None, "no id", "s"), (None, None, "s"), (70, " ", "s"), (70, " ", "s")]
    docs = documents(spark, rows).repartition(4)
    marked, real = [], jaccard._flags
    monkeypatch.setattr(jaccard, "_flags", lambda chosen, bits: marked.append(sorted(map(str, (r.row.id for r in chosen.collect())))) or real(chosen, bits))
    kept = jaccard.keep_smallest(docs)
    assert kept.columns == docs.columns
    want = [(i, rows[i][1]) for i in range(40)] + [(50, text + " x"), (60, "twice in all"), (None, "no id"), (None, None), (70, " "), (70, " ")]
    found = [(r.doc_id, r.text) for r in kept.collect()]
    assert sorted(found, key=str) == sorted(want, key=str)
    assert marked[-1] == ["51", "60", "None", "None"]
    near = jaccard.keep_smallest(docs.where("doc_id is null or doc_id > 50"))
    assert sorted(map(str, ((r.doc_id, r.text) for r in near.collect()))) == sorted(map(str, [(51, text), *want[41:]]))


def brute_rest(texts, width):
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for i, w in enumerate(words):
        gone = set()
        for k in range(len(w) - width + 1):
            if seen[tuple(w[k : k + width])] > 1:
                gone.update(range(k, k + width))
        out.append((i, len(w), len(gone), digest(b" ".join(x for k, x in enumerate(w) if k not in gone))))
    return out


def rest(df):
    return sorted((r.doc_id, r.n_words, r.n_removed, digest(r.kept)) for r in df.collect())


@pytest.mark.parametrize("block, most", [(repeats.BLOCK, repeats.GROUP_RUNS), (3000, 1), (3000, 20)])
def test_repeated_passages(spark, monkeypatch, block, most):
    """Small blocks resolve in the shuffle what large ones resolve in the task; small groups have their prefixes extended."""
    monkeypatch.setattr(repeats, "BLOCK", block)
    monkeypatch.setattr(repeats, "GROUP_RUNS", most)
    monkeypatch.setattr(repeats, "HELD_ROWS", 3 if most == 1 else repeats.HELD_ROWS)
    rng = random.Random(block)
    passage = " ".join(f"p{i}" for i in range(50))
    texts = mixed_corpus(4) + ["be " * 400, "x " + passage + " y", passage, passage + " " + passage, "é " * 36]
    texts += [" ".join(rng.choice("abc") for _ in range(200)) for _ in range(5)]
    docs = clashing(documents(spark, texts)).repartition(4)
    assert rest(repeats.remove_repeats(docs)) == brute_rest(texts, 35)
    assert rest(repeats.remove_repeats(docs, width=9, gram=3)) == brute_rest(texts, 9)


def test_many_equal_rows_are_linear(spark):
    """20,000 equal rows: a row's runs are kept once, not once for each copy."""
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.range(20_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit(text).alias("text"))
    docs = docs.unionAll(spark.createDataFrame([(8, text + " more"), (9, "another " * 3)], "doc_id long, text string"))
    runs = repeats.repeated_runs(docs.repartition(8)).select(F.size("runs").alias("n")).collect()
    assert [r.n for r in runs] and max(r.n for r in runs) <= 60 - 34
    found = repeats.remove_repeats(docs.repartition(8)).groupBy("doc_id", "n_words", "n_removed").count()
    assert sorted(map(tuple, found.collect())) == [(7, 60, 60, 20_000), (8, 61, 60, 1), (9, 3, 0, 1)]


def test_subtrees_compare_words_not_keys():
    """One key for all rows: nodes part them, and every window's count is that of plain Python."""
    import numpy as np

    rng = random.Random(6)
    width, texts, offsets, counts = 6, [], [], []
    for _ in range(80):
        n = rng.randrange(1, 4)
        texts.append(" ".join(rng.choice("ab") for _ in range(n + width - 1)).encode())
        counts.append(n)
        offsets.append(rng.randrange(n - 1, n + 2))
    tree = repeats.Subtrees(np.zeros(80, dtype=np.int64), np.array(offsets), np.array(counts), texts, width)
    seen = Counter((o - i, tuple(t.split()[i : i + width])) for t, o, n in zip(texts, offsets, counts) for i in range(n))
    want = [(r, i) for r, (t, o, n) in enumerate(zip(texts, offsets, counts)) for i in range(n) if seen[o - i, tuple(t.split()[i : i + width])] > 1]
    assert list(zip(*(x.tolist() for x in tree.repeated()))) == want
    deep = [len(np.unique(level[level >= 0])) for level in tree.after]
    assert deep[0] == 1 and max(deep) > 2


def test_equal_hashes_of_different_windows_are_told_apart():
    import numpy as np

    one, two = np.array([5, 5, 5, 9, 9]), np.array([1, 2, 1, 3, 3])
    codes = repeats._equal(one, two)
    assert (codes[:, None] == codes).tolist() == [[(a, b) == (c, d) for c, d in zip(one, two)] for a, b in zip(one, two)]


def test_repeated_rows_and_empty_tables(spark):
    text = " ".join(map(str, range(40)))
    docs = documents(spark, [(1, text, "s"), (1, text, "s"), (None, "short", "s"), (None, None, "s")])
    got = rows(repeats.remove_repeats(docs))
    assert got == [(1, 40, 40, ""), (1, 40, 40, ""), (None, 0, 0, ""), (None, 1, 0, "short")]
    assert repeats.remove_repeats(docs.limit(0)).count() == 0


def brute_top(vectors, every, k):
    good = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in vectors
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, (qi, qv) in enumerate(good):
        if qi % every == 0:
            scored = [(-sum(a * b for a, b in zip(qv, v)), i) for c, (i, v) in enumerate(good) if c != q]
            out += [(qi, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.mark.parametrize("shard_rows, query_block", [(4096, 8192), (300, 3), (20, 2)])
def test_top_k(spark, monkeypatch, shard_rows, query_block):
    monkeypatch.setattr(topk, "FIRST_ROWS", 16)
    rng = np.random.default_rng(7)
    vectors = [(i, [float(np.float32(x)) for x in rng.normal(size=8) * 0.2]) for i in range(700)]
    vectors += [(700 + i, vectors[3][1]) for i in range(150)]  # one very common vector
    vectors += [(900, None), (950, []), (951, [0.1, None]), (1000, [float("nan")] * 8), (1050, [float("inf")] * 8), (None, vectors[0][1]),
                (50, vectors[50][1]), (100, vectors[9][1]), (1100, [0.0] * 8), (1150, [-0.5])]
    df = spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>")
    got = topk.top_k(clashing(df), shard_rows=shard_rows, query_block=query_block)
    assert sorted(map(tuple, got.collect())) == brute_top(vectors, 50, 5)


def test_top_k_of_few_rows(spark):
    schema = "vec_id bigint, embedding array<float>"
    assert topk.top_k(spark.createDataFrame([], schema)).count() == 0
    assert topk.top_k(spark.createDataFrame([(0, [1.0])], schema)).count() == 0
    two = spark.createDataFrame([(0, [1.0]), (1, [2.0])], schema)
    assert [tuple(r) for r in topk.top_k(two).collect()] == [(0, 1, 1, 256 * 512)]


def test_large_components_are_exact_whole_numbers(spark):
    """Scores beyond 64 bits count as the bounds, whatever the shards."""
    vectors = [(0, [1e15, 1.0]), (1, [1e15, 2.0]), (2, [1e15, 1.0]), (3, [-1e15, 0.0]), (4, [1e300, 0.0]), (5, [3.0, 3.0]), (6, [0.0, 1e7])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    top = 2**63 - 1
    want = [(1, top), (2, top), (4, top), (5, top), (6, 256 * 256 * 10**7), (3, -top - 1)]
    for shard_rows in (None, 2):
        for k in (2, 6):
            got = [(r.vec_id, r.score) for r in topk.top_k(df, k=k, shard_rows=shard_rows).orderBy("rank").collect()]
            assert got == want[:k]


def test_the_threshold_rises_from_chunk_to_chunk(monkeypatch):
    """Candidates in falling order: after the first chunk hardly any is probed to the end."""
    n = 4000
    vectors = np.zeros((n, 24))
    vectors[:, 0] = np.arange(n)
    vectors[:, 1:] = np.arange(n * 23).reshape(n, 23) % 7
    shard = topk.Shard(np.arange(n), np.arange(n), vectors)
    query = np.array([100.0] + [1.0] * 23)
    ended, least = [], []
    real = topk.Shard._competitive

    def counted(self, alive, *args):
        found = real(self, alive, *args)
        ended.append(len(found[0]))
        least.append(args[-1])
        return found

    monkeypatch.setattr(topk.Shard, "_competitive", counted)
    monkeypatch.setattr(topk, "CHUNK_ROWS", 500)
    ids, scores = shard.search(-1, query, 5)
    want = np.lexsort((np.arange(n), -(vectors @ query)))[:5]
    assert ids.tolist() == want.tolist() and scores.tolist() == (vectors @ query)[want].tolist()
    assert least[0] is None and least[1:] == sorted(least[1:]) and least[1] < least[-1]
    descending = topk.Shard(np.arange(n), np.arange(n), vectors[::-1].copy())
    ended.clear()
    descending.search(-1, query, 5)
    assert sum(ended[1:]) < 10


def test_rows_of_one_id_are_spread_over_shards(spark, monkeypatch):
    most = spark.sparkContext.accumulator(0)
    real = topk._best

    def best(k, left, right):
        if left.num_rows > 150:
            most.add(1)
        return real(k, left, right)

    monkeypatch.setattr(topk, "_best", best)
    rng = np.random.default_rng(3)
    vectors = [(50, [float(np.float32(x)) for x in rng.normal(size=4)]) for _ in range(400)] + [(50, [0.5] * 4)] * 3
    df = spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>")
    got = topk.top_k(df, shard_rows=40, query_block=100)
    assert sorted(map(tuple, got.collect())) == brute_top(vectors, 50, 5)
    assert most.value == 0
