"""Each operator applied to its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bpe, collocations, jaccard, lexical, main_text, mixing, oracles, quality, repeats, reputation, secrets, token_counts, topk, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Fixed value: tokens a document may have before it is over the limit.
TOKEN_LIMIT = 4096


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Where a public vocabulary file is installed."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query
def op1_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trips(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"), TOKEN_LIMIT)


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(quality.training_rows(docs, table(spark, sf_dir, "labels"), "quality"))
    return quality.judge(docs, model)


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(~toxicity.held_out())
    return toxicity.toxicity(docs, toxicity.fit(quality.training_rows(docs, labels, "toxic", toxicity.SAMPLE_ROWS)))


# The rules for page urls.
URL_RULES = [
    reputation.Rule("net", "/", "block"),
    reputation.Rule("example.net", "/en/", "allow"),
    reputation.Rule("example.com", "/de/", "block"),
    reputation.Rule("org", "/fr/", "allow"),
]


@query
def op2_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    host, path = reputation.host_and_path(F.col("url"))
    # A page's path names the document it was made from; a bad page is one of low quality or a toxic one.
    document = F.regexp_extract(path, r"^/[^/]*/([0-9]{1,18})", 1).try_cast("long")
    bad = ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")
    outcomes = pages.select(host.alias("host"), document.alias("doc_id")).join(labels, "doc_id").select("host", bad.alias("bad"))
    return reputation.judge(pages, outcomes, URL_RULES)


@query
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.scan(docs, secrets.learn(docs))


@query
def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.taken(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@query
def op7_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query
def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


@query
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(table(spark, sf_dir, "documents"))


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query
def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(table(spark, sf_dir, "pages"), main_text.fit(main_text.labelled_blocks(spark)))


@query
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES |= {
    "op2_url_reputation": oracles.URL_REPUTATION,
    "op6_jaccard_join": oracles.JACCARD_JOIN,
    "op7_repeated_passages": oracles.REPEATED_PASSAGES,
    "op9_top_k": oracles.TOP_K,
    "op10_source_mix": oracles.SOURCE_MIX,
    "op11_collocations": oracles.COLLOCATIONS,
    "op13_lexical_search": oracles.LEXICAL_SEARCH,
}
