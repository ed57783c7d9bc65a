"""BPE encoding and decoding, and token counts, against the libraries."""

import pytest
import sentencepiece
from helpers import clashing, digest, documents, rows
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from vintagemart.llm import bpe, queries, token_counts

WORDS = queries.vocabulary("word_bpe_49k.json")
PIECES = queries.vocabulary("piece_bpe_32k.model")
ODD = [None, "", " ", "  \n\t", "a" * 5000, "!" * 300, "don't WE'LL 's 't", "ΑΣ σΣ İI ß", "e\u0301 é x\u1c89", "a\x1cb\x85c\u3000d",
       "<|endoftext|>a <|startoftext|>", "<|ENDOFTEXT|>", "<s> </s>", "▁▁a ▁", "\n\n a  b \n", "日本語 0123", "x\0y", "\u0558\u088f"]


@pytest.fixture(scope="module")
def ours():
    return bpe.PairIndexBpe(WORDS)


@pytest.fixture(scope="module")
def theirs():
    return Tokenizer.from_file(WORDS)


def expected(theirs, text):
    ids = theirs.encode(text or "", add_special_tokens=False).ids
    return len(ids), digest(" ".join(map(str, ids))), digest(theirs.decode(ids, skip_special_tokens=False))


@pytest.mark.parametrize("text", [t for t in ODD if t])
def test_odd_texts(ours, theirs, text):
    assert ours.encode(text) == theirs.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("aAtThe 's!1éΣ")), max_size=40))
def test_any_text(text):
    ours, theirs = _both()
    ids = theirs.encode(text, add_special_tokens=False).ids
    assert ours.encode(text) == ids
    assert ours.decode(ids) == theirs.decode(ids, skip_special_tokens=False)


def _both(cache={}):
    if not cache:
        cache["both"] = bpe.PairIndexBpe(WORDS), Tokenizer.from_file(WORDS)
    return cache["both"]


def test_many_words_at_once_equal_one_by_one(ours, monkeypatch):
    words = ["the", "aaaaaaa", "xyzzy", "the", "", "ththth", "inininin"]
    together = ours.encode_words(words)
    assert together == [ours.encode_words([w])[0] if w else [] for w in words]
    # The vectorised and the one-by-one path merge alike.
    monkeypatch.setattr(bpe, "SHORT_LIST", 0)
    assert ours.encode_words(words) == together
    monkeypatch.setattr(bpe, "ROW_SYMBOLS", 3)
    assert ours.encode_words(words) == together


def test_round_trips_of_a_table(spark, small, theirs):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    want = sorted((r.doc_id, *expected(theirs, r.text)) for r in docs.collect())
    assert sorted(map(tuple, queries.op1_bpe_codec(spark, small).collect())) == want


def test_round_trips_of_odd_rows(spark, theirs, monkeypatch):
    docs = clashing(documents(spark, [*ODD, *ODD[:3], (None, "no id", "s")]))
    got = rows(bpe.round_trips(docs, WORDS))
    want = [(r.doc_id, *expected(theirs, r.text)) for r in docs.collect()]
    assert got == sorted(want, key=lambda r: tuple((v is None, str(v)) for v in r))
    assert bpe.round_trips(docs.limit(0), WORDS).count() == 0
    tokens = bpe.encoded(docs, WORDS)
    assert tokens.columns == [*docs.columns, "token_ids"]
    found = tokens.collect()
    assert all(r.token_ids == theirs.encode(r.text or "", add_special_tokens=False).ids for r in found)
    texts = {r.doc_id: r.text for r in bpe.decoded(tokens, WORDS).collect()}
    assert texts == {r.doc_id: theirs.decode(r.token_ids, skip_special_tokens=False) for r in found}


def test_ids_of_another_origin_are_decoded(spark, ours):
    known = ours.encode("the end")
    tokens = spark.createDataFrame([(1, known), (2, [10**8, known[0]]), (3, []), (4, None)], "n int, token_ids array<int>")
    found = {r.n: r.text for r in bpe.decoded(tokens, WORDS, columns=["n"]).collect()}
    assert found == {1: "the</w> end</w>", 2: "the</w>", 3: "", 4: ""}
    assert bpe.decoded(tokens.limit(0), WORDS).count() == 0


def test_a_full_cache_forgets_what_is_not_needed(ours):
    cache = bpe.RunCache(ours, limit=2)
    for runs in ({"one", "two"}, {"two", "three"}, {"four", "five", "six"}):
        cache.learn(runs)
        assert runs <= set(cache.of)
        assert all(list(memoryview(cache.of[r]).cast("i")) == ours.encode(r) for r in runs)


def test_vocabulary_of_another_layout_is_refused(tmp_path):
    with pytest.raises(ValueError):
        bpe.PairIndexBpe(queries.vocabulary("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([" ", "  ", "    ", "\n", "\n  ", "a", "The", "▁", "é", "日", "\t", "\r", "<s>", "\0", "0"]), max_size=10))
def test_counts_of_any_text(parts):
    text = "".join(parts)
    counts = token_counts.Counts(PIECES, {"a": 1})
    assert counts.of([text]) == [len(counts.pieces.model.encode(text))]


def test_indented_text_goes_through_both_tiers(library):
    """No text is given to the library whole: equal pieces of it are encoded once."""
    text = "def f(x):\n    if x:\n        return  x \n    return 1\n \n" * 40
    asked = []
    counts = token_counts.Counts(PIECES, {})
    real = counts.pieces.lengths
    counts.pieces = type("Asked", (), {"lengths": staticmethod(lambda keys: asked.extend(keys) or real(keys))})
    assert counts.of([text, text]) == [len(library.encode(text))] * 2
    assert len(asked) == len(set(asked)) < 20 and max(map(len, asked)) < 20


def test_counts_of_a_table(spark, small, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for r in queries.op3_token_counts(spark, small).collect():
        n = len(library.encode(docs[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 4096)


def test_counts_of_odd_rows(spark, library):
    docs = clashing(documents(spark, [*ODD, *ODD[:2], (None, "no id", "s")]))
    for table_size in (1, 1000):
        got = rows(token_counts.token_counts(docs, PIECES, 3, table_size=table_size), "doc_id", "n_bytes", "n_tokens", "over_limit")
        want = []
        for r in docs.collect():
            n = len(library.encode(r.text or ""))
            want.append((r.doc_id, len((r.text or "").encode()), n, n > 3))
        assert got == sorted(want, key=lambda r: tuple((v is None, str(v)) for v in r))
    assert token_counts.token_counts(docs.limit(0), PIECES, 3).count() == 0


def test_the_table_holds_what_is_frequent(spark):
    docs = documents(spark, ["often " * 50 + f"rare{i}" for i in range(40)]).repartition(7)
    assert token_counts.frequent(docs, size=3)[0] == "often"
    seen = token_counts.Counter({f"w{i}": 2 for i in range(9)} | {"top": 50})
    token_counts.shrink(seen, 3)
    assert len(seen) <= 3 and "top" in seen
