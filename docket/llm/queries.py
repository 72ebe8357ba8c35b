"""The registered queries: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from docket.llm import alignment, decontaminate, html_text, licenses, merkle, mixtures, near_dup, ngram_lm, packing, phrases, token_store, topk, toxicity

Query = Callable[[SparkSession, str], DataFrame]
PACK_TOKENIZER, STORE_TOKENIZER = "word_bpe_49k.json", "byte_bpe_50k.json"
PIECE_MODEL = "piece_bpe_32k.model"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licence phrases and notices in every document."""
    return licenses.summary(licenses.scan(table(spark, folder, "documents")))


def op5_repeated_phrases(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without words that windows of 13 repeat from earlier ones."""
    kept = phrases.remove_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op6_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return near_dup.classes(table(spark, folder, "documents").select("doc_id", "text"))


def op7_language_model(spark: SparkSession, folder: str) -> DataFrame:
    """Log probabilities of every document under a model of all words, pairs and triples of four fifths of them."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = toxicity.in_fold(F.col("doc_id"), 5, 1)
    trie = ngram_lm.train(docs.where(~held_out), least=1, order=ngram_lm.ORDER)
    return ngram_lm.score(docs, trie).select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(trie.total).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def op8_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The five best candidates of every vector whose id is divisible by 50."""
    vectors = table(spark, folder, "embeddings").select("vec_id", topk.quantised(F.col("embedding")).alias("vector"))
    return topk.exact_top_k(vectors, vectors.where("vec_id % 50 = 0"), 5)


def op9_html_text(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    return html_text.extract(table(spark, folder, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """The benchmark items that leak into documents."""
    return decontaminate.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """A toxicity score of every document; a quarter of the labels is held out."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = toxicity.in_fold(F.col("doc_id"), 4, 2)
    model = toxicity.fit(docs, table(spark, folder, "labels"), held_out)
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of all documents in windows of 2048 ids, end id 1."""
    packed = packing.pack(table(spark, folder, "documents"), tokenizer_path(PACK_TOKENIZER), end_id=1)
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op10_token_store(spark: SparkSession, folder: str) -> DataFrame:
    """All documents written as ids with end id 2, then read back by key."""
    docs = table(spark, folder, "documents")
    root, manifest = token_store.write_store(docs, tokenizer_path(STORE_TOKENIZER), end_id=2)
    stored = token_store.read_ids(spark, root, manifest, docs)
    return stored.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op11_mixture_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of all documents in as few sequences of 2048 ids as the plan over their lengths needs, end id 0."""
    packed = mixtures.pack(table(spark, folder, "documents"), tokenizer_path(PACK_TOKENIZER), end_id=0)
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Groups and links between the tokens of two tokenizers in every document."""
    return alignment.align(table(spark, folder, "documents"), tokenizer_path(STORE_TOKENIZER), tokenizer_path(PIECE_MODEL))


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The Merkle proof of every document; a seventh is tampered with by one more in n_chars."""
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    rows = merkle.manifest(
        table(spark, folder, "documents"),
        ["doc_id", "source", "lang", "n_chars", "text"],
        group="lang",
        changes={"n_chars": F.col("n_chars") + 1},
        where=tampered,
    )
    return rows.select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


QUERIES: dict[str, Query] = {
    "op1_license_scan": op1_license_scan,
    "op2_decontamination": op2_decontamination,
    "op3_toxicity": op3_toxicity,
    "op4_packing": op4_packing,
    "op5_repeated_phrases": op5_repeated_phrases,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_language_model": op7_language_model,
    "op8_topk": op8_topk,
    "op9_html_text": op9_html_text,
    "op10_token_store": op10_token_store,
    "op11_mixture_packing": op11_mixture_packing,
    "op12_token_alignment": op12_token_alignment,
    "op13_merkle_manifest": op13_merkle_manifest,
}
ORACLE: dict[str, str] = {
    "op1_license_scan": licenses.oracle(),
    "op5_repeated_phrases": r"""
with t as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
k as (select doc_id, i, ws[i] as x, array_to_string(ws[i:i + 12], ' ') as s, i + 12 <= len(ws) as whole
  from (select doc_id, ws, unnest(range(1, len(ws) + 1)) as i from t)),
m as (select s, min(doc_id) as lo from k where whole group by s),
gone as (select distinct k.doc_id, k.i + j.j as i from k join m on k.s = m.s cross join (select unnest(range(13)) as j) j
  where k.whole and m.lo < k.doc_id),
kept as (select doc_id, string_agg(x, ' ' order by i) as text from k anti join gone using (doc_id, i) group by doc_id),
n as (select doc_id, count(*) as n from gone group by doc_id)
select doc_id, cast(len(ws) as bigint) as n_words, cast(coalesce(n, 0) as bigint) as n_removed, sha256(coalesce(kept.text, '')) as kept_sha256
from t left join n using (doc_id) left join kept using (doc_id)
""",
    "op13_merkle_manifest": merkle.oracle(),
    "op8_topk": """
with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as q from embeddings
  where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as query_id, b.vec_id, cast(list_dot_product(a.q, b.q) as bigint) as score
  from v a join v b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id and len(a.q) = len(b.q)),
r as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from s)
select query_id, rank, vec_id, score from r where rank <= 5
""",
}
