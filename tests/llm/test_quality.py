"""Quality rules and toxicity."""

import pytest
from helpers import clashing, documents, rows
from pyspark.sql import functions as F

from vintagemart.llm import quality, queries, toxicity

SAMPLE = "/root/testdata/sf0.1"


def brute(text):
    data = (text or "").encode()
    words = data.split()
    chars = sum(len(w.decode()) for w in words)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if line.encode().split():
            repeated += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    marked = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            marked.update(range(i, i + 8))
    return len(words), chars, symbols, repeated, len(marked)


TEXTS = [None, "", "  \n", "one", "a b c d e f g h " * 4, "x " * 30, "a\u00a0b é\x85 ü", "a\n\nb\na\n a\nb ", "#* $% &|<>", "w" * 9000,
         " ".join(f"w{i}" for i in range(40)), " ".join(f"w{i % 13}" for i in range(60))]


@pytest.mark.parametrize("text", TEXTS)
def test_base_counts(text):
    assert quality.base_counts(text) == brute(text)


def test_base_counts_of_a_table(spark, small):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for r in queries.op4_quality_rules(spark, small).collect():
        want = brute(docs[r.doc_id]) if len(docs[r.doc_id] or "") < 4000 else quality.base_counts(docs[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.base_failed and r.kept)


def test_scores_do_not_depend_on_the_block():
    texts = [t for t in TEXTS if t]
    rng = quality.np.random.default_rng(1)
    model = quality.QualityModel(rng.normal(size=(quality.KINDS, quality.SLOTS)), 1.0, 0.0)
    together = model.probability(texts)
    assert [model.probability([t])[0] for t in texts] == pytest.approx(together, abs=1e-12)


def test_training_takes_4000_rows_and_does_not_depend_on_the_block(spark, monkeypatch):
    docs = spark.range(4500).selectExpr("id as doc_id", "concat('t', id) as text")
    labels = spark.range(4500).selectExpr("id as doc_id", "cast(id % 2 as int) as quality")
    assert quality.training_rows(docs, labels, "quality").count() == 4000
    sample = documents(spark, [f"{'good' if i % 2 else 'bad'} words {i} {i * 7}" for i in range(150)])
    sample = sample.select("text", (F.col("doc_id") % 2).cast("int").alias("label"))
    first = quality.fit(sample)
    monkeypatch.setattr(quality, "ROW_BLOCK", 1000)
    second = quality.fit(sample)
    assert first.weights == pytest.approx(second.weights, abs=1e-9)
    assert (first.slope, first.offset) == pytest.approx((second.slope, second.offset), rel=1e-6)
    assert (first.probability(["good words", "bad words"]) > 0.5).tolist() == [True, False]


def test_quality_on_rows_not_trained_on(spark):
    """Half of the labels train; the other half is judged."""
    docs, labels = (queries.table(spark, SAMPLE, t) for t in ("documents", "labels"))
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    model = quality.fit(quality.training_rows(docs, labels.where(half), "quality"))
    judged = quality.judge(docs.join(labels.where(~half).select("doc_id"), "doc_id"), model).join(labels, "doc_id").where("not base_failed")
    found = {(r.quality, r.kept): r["count"] for r in judged.groupBy("quality", "kept").count().collect()}
    assert found.get((1, False), 0) <= 0.01 * found[1, True]
    assert found.get((0, True), 0) <= 0.1 * found[0, False]


def test_quality_of_odd_rows_without_labels(spark):
    docs = clashing(documents(spark, [*TEXTS, TEXTS[4], (None, TEXTS[10], "s")]))
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    model = quality.fit(quality.training_rows(docs, none, "quality"))
    assert model is quality.KEEP_ALL
    got = quality.judge(docs, model)
    assert got.count() == len(TEXTS) + 2 and rows(got.where("kept"), "n_words") == rows(got.where("not base_failed"), "n_words")
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.count() == got.where("kept").count()
    assert quality.judge(docs.limit(0), model).count() == quality.keep_good(docs.limit(0), model).count() == 0


@pytest.mark.parametrize("n_good, n_bad", [(1, 9), (9, 1), (7, 193), (1, 1)])
def test_few_labels_of_a_class_still_train(spark, n_good, n_bad):
    texts = [(f"lovely clear prose number {i} about rivers", 1) for i in range(n_good)] + [(f"###$$$ @@@ {i} xxqq zzvv", 0) for i in range(n_bad)]
    model = quality.fit(spark.createDataFrame(texts, "text string, label int"))
    assert model is not quality.KEEP_ALL
    good, bad = model.log_odds(["clear prose about rivers", "xxqq ###$$$ zzvv"])
    assert good > bad


def test_training_rows_are_bounded_in_rows_and_text(spark, monkeypatch):
    """A very long text takes the room of many, but the first is always taken."""
    docs = documents(spark, ["word " * 200, "x" * 50_000, *["short text"] * 40])
    labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("quality"))
    assert quality.training_rows(docs, labels, "quality").count() == 42
    assert quality.training_rows(docs, labels, "quality", 5).count() == 5
    monkeypatch.setattr(quality, "SAMPLE_TEXT", 100)
    few = quality.training_rows(docs, labels, "quality").collect()
    assert 1 <= len(few) < 15
    assert sorted(map(tuple, few)) == sorted(map(tuple, quality.training_rows(docs.repartition(7), labels, "quality").collect()))


@pytest.fixture(scope="module")
def judged(spark):
    return queries.op5_toxicity(spark, SAMPLE).join(queries.table(spark, SAMPLE, "labels"), "doc_id").cache()


def test_toxicity_on_held_out_rows(judged):
    found = {(r.toxic, r.predicted): r["count"] for r in judged.where("held_out").groupBy("toxic", "predicted").count().collect()}
    assert found.get((0, 1), 0) <= 0.03 * found[0, 0]
    assert found.get((1, 0), 0) <= 0.15 * found[1, 1]
    assert judged.where("score < 0 or score > 1 or (score >= 0.3) <> (predicted = 1)").count() == 0


LEXICON = toxicity.Lexicon({"idiot": 5.0}, {"lowe": 4.0})


def kinds(text):
    found = toxicity.Matcher(LEXICON).features(text)
    return {toxicity.MATCHES[i][1:] for i in found.nonzero()[0]}


@pytest.mark.parametrize("text, want", [
    ("what an idiot.", {(0, 0, 0)}),
    ("you idiot", {(0, 0, 1)}),
    ("idiot, you said", {(0, 0, 0)}),
    ("he is not an idiot", {(1, 0, 1)}),
    ("not at all what one says of the idiot", {(0, 1, 0)}),
    ("they said idiot", {(0, 1, 1)}),
    ("the word “idiot” there", {(0, 1, 0)}),
    ("ein Loweiig wort", {(0, 0, 0)}),
    ("I will kill the lights", {(0, 0, 0)}),
    ("not here. idiot", {(0, 0, 0)}),
    ("idiotic", set()),
    ("", set()),
    (None, set()),
])
def test_clauses(text, want):
    assert kinds(text) == want


@pytest.mark.parametrize("text, weight", [
    ("I will find you", 3.0), ("we are going to hunt them", 3.0), ("ich werde dich finden", 3.0), ("je vais te trouver", 3.0), ("yo voy a encontrar a ellos", 3.0),
    ("I will kill you", 3.0), ("kill yourself", 3.0), ("te voy a matar", 3.0), ("I will kill the lights", 1.0),
    ("find you", 0.0), ("you will find the door", 0.0), ("I found you", 0.0), ("I will find the door. you", 0.0), ("I find you", 0.0),
])
def test_threats_are_clauses(text, weight):
    found = toxicity.Matcher(LEXICON).features(text)
    threats = [found[i] for i, m in enumerate(toxicity.MATCHES) if m[0] == toxicity.THREAT]
    assert sum(threats) * toxicity.UNIT == weight


@pytest.mark.parametrize("text, factor", [
    ("you idiot", 1.25), ("you are an idiot", 1.25), ("you are such a complete idiot", 1.25), ("du bist ein idiot", 1.25),
    ("an idiot", 1.0), ("you saw the man and the idiot", 1.0), ("idiot you", 1.0),
])
def test_insults_are_said_of_somebody(text, factor):
    assert toxicity.Matcher(LEXICON).features(text).sum() * toxicity.UNIT == pytest.approx(5.0 * factor)


def plain_features(text, lexicon):
    """The five readings of each clause one after the other, without a table of states."""
    import re

    out = [0.0] * len(toxicity.MATCHES)
    quoted = False
    clause = []
    for token in [*re.findall(r"[^\W\d_]+|[.,;:!?\n\"“”«»„]", (text or "").lower()), "."]:
        if token in toxicity.QUOTES:
            quoted = not quoted
        elif token not in toxicity.CLAUSE_ENDS:
            clause.append((*lexicon.classify(token), quoted))
        else:
            kinds = [k for k, _, _ in clause]
            aimed = int(toxicity.TARGET in kinds)
            for i, (kind, weight, inside) in enumerate(clause):
                before = kinds[:i]
                negated = int(toxicity.NEGATION in before[-3:])
                reported = int(toxicity.REPORT in before or inside)
                named = toxicity.TARGET in before
                factor = 0.0
                if kind == toxicity.INSULT:
                    # Back to somebody: over fillers, and over single other words that stand behind a filler.
                    said, k, gap = False, i - 1, 0
                    while k >= 0:
                        if kinds[k] == toxicity.TARGET:
                            said = not gap or kinds[k + 1] in (toxicity.COPULA, toxicity.FILLER)
                            break
                        if kinds[k] in (toxicity.COPULA, toxicity.FILLER):
                            gap = 0 if gap <= 1 else gap
                        elif kinds[k] == toxicity.INSULT or gap:
                            break
                        else:
                            gap = 1
                            if k and kinds[k - 1] not in (toxicity.COPULA, toxicity.FILLER):
                                break
                        k -= 1
                    out[toxicity.MATCHES.index((toxicity.INSULT, negated, reported, aimed))] += weight * (1.25 if said else 1.0)
                elif kind == toxicity.HARM:
                    factor = 3.0 if named else 1.0
                elif kind in (toxicity.SEEK, toxicity.TARGET):
                    state = 0
                    for n, k in enumerate(before):
                        there = toxicity.TARGET in kinds[:n]
                        if k == toxicity.HARM:
                            state = 0 if there else 3
                        elif k == toxicity.SEEK and state == 2:
                            state = 0 if there else 4
                        elif k == toxicity.TARGET and state > 2:
                            state = 0
                        elif k == toxicity.SPEAKER and state == 0:
                            state = 1
                        elif k == toxicity.INTENT and state == 1:
                            state = 2
                    if kind == toxicity.SEEK:
                        factor = 3.0 if state == 2 and named else 0.0
                    else:
                        factor = {3: 2.0, 4: 3.0}.get(state, 0.0)
                if factor:
                    out[toxicity.MATCHES.index((toxicity.THREAT, negated, reported, aimed))] += factor
            clause = []
            if token == "\n":
                quoted = False
    return [min(x, toxicity.ENOUGH) / toxicity.UNIT for x in out]


def test_the_composed_table_reads_as_five_readers_would():
    import random

    rng = random.Random(8)
    words = ["idiot", "you", "not", "said", "kill", "i", "will", "find", "are", "a", "tree", "Loweiig", ".", ",", "\n", '"']
    for _ in range(3000):
        text = " ".join(rng.choice(words) for _ in range(rng.randrange(1, 14)))
        assert toxicity.Matcher(LEXICON).features(text).tolist() == pytest.approx(plain_features(text, LEXICON)), text


def test_texts_that_only_share_a_word_all_count(spark):
    """Every toxic text holds the word with the least hash, half of them one insult and half another."""
    def text(i, *more):
        return " ".join([f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + k)}filler" for k in range(12)] + list(more))

    marks = sorted((f"shared{chr(97 + i)}{chr(97 + j)}" for i in range(26) for j in range(26)), key=lambda w: toxicity.blake2b(w.encode(), digest_size=8).hexdigest())
    toxic = [text(i, marks[0], "wretch" if i % 2 else "moron") for i in range(60)]
    clean = [text(100 + i, marks[0]) for i in range(200)]
    sample = spark.createDataFrame([(t, 1) for t in toxic] + [(t, 0) for t in clean], "text string, label int")
    assert set(toxicity.learn_lexicon(sample).words) == {"wretch", "moron"}


def test_near_copies_count_once_and_others_whole():
    def signature(words):
        return toxicity._signature(words)

    copied = [f"copied{i}" for i in range(100)]
    near = [[*copied[:50], f"changed{i}", *copied[51:]] for i in range(5)]
    far = [[*copied[:20], *(f"other{i}x{k}" for k in range(80))] for i in range(4)]
    sizes = toxicity.group_sizes(toxicity.np.array([signature(w) for w in (*near, *far, [])]))
    assert sizes.tolist() == [5] * 5 + [1] * 5


def test_toxicity_of_odd_rows(spark):
    texts = [None, "", "plain words", "you idiot " * 3000, "you idiot", "you idiot"]
    docs = clashing(documents(spark, [*texts, (None, "idiot", "s")]))
    model = toxicity.ToxicityModel(LEXICON, toxicity.PRIOR, toxicity.PRIOR_OFFSET)
    got = {r.doc_id: r for r in toxicity.toxicity(docs, model).collect()}
    assert got[0].score == got[1].score == got[2].score < 0.1 < got[4].score == got[5].score <= got[3].score
    assert got[None].held_out is False
    empty = toxicity.fit(spark.createDataFrame([], "text string, label int"))
    assert empty.lexicon == toxicity.Lexicon({}, {})
    assert toxicity.toxicity(docs.limit(0), empty).count() == 0
