"""The registered queries over the given tables, one per operator."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessella.llm import bpe, chat, codes, infill, jaccard, language, neighbours, repeats, topk, toxicity, warc
from tessella.llm.common import held_out, many_to_one, new_folder, table, written
from tessella.llm.mixing import mix, quality_weights
from tessella.llm.sharding import shard_by_bytes


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = quality_weights(table(spark, sf_dir, "labels"))
    return mix(table(spark, sf_dir, "documents"), weights).select("doc_id", "size", "source_size", "target", "taken")


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op3_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.near_vectors(table(spark, sf_dir, "embeddings"))


def op4_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    warc.write_warc(warc.page_records(table(spark, sf_dir, "pages")), folder)
    columns = "record_id string, record_type string, refers_to string, payload_digest string, payload_bytes long"
    records = warc.read_warc(spark, folder, columns, verify=True).where(F.col("record_type").isin("response", "revisit"))
    page = lambda c: F.regexp_extract(c, "^<urn:page:(-?[0-9]+)>$", 1)
    number = lambda c: F.when(page(c) != "", page(c).cast("long"))
    return records.select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to")
    )


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op5_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.coded(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_file(), "packed", "decoded")
    return coded.select(
        "doc_id",
        (F.octet_length("code.packed") / 4).cast("long").alias("n_tokens"),
        F.sha2("code.packed", 256).alias("ids_sha256"),
        F.sha2(F.col("code.decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.near_duplicates(table(spark, sf_dir, "documents"), width=3, share=90)
    return found.select("doc_id", "n_shingles", "component_id")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    score = toxicity.toxicity_of(toxicity.fit(docs, table(spark, sf_dir, "labels")))
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score("text").alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.3, 1).otherwise(0))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "cut.n_bytes", "cut.n_removed", "cut.n_spans", F.sha2("cut.kept", 256).alias("kept_sha256"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    predict = language.language_of(language.fit(docs))
    found = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), predict("text").alias("p"))
    return found.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"), F.col("p.rejected").alias("rejected"))


def op10_shard_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = shard_by_bytes(table(spark, sf_dir, "documents"))
    return shards.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    books = codes.fit(vectors, "embedding", "vec_id", parts=16, entries=64, rounds=2)
    coded = codes.compress(vectors, books, "embedding").select(
        "vec_id", F.struct("label").alias("group"), F.lower(F.hex("coded.code")).alias("code"),
        F.col("coded.error").alias("error"), F.col("coded.books").alias("codebooks_sha256"),
    )
    coded = written(coded, "codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38, 0)")), F.lit(2**63 - 1)).cast("long")
    return many_to_one(coded, coded.groupBy("group").agg(total.alias("label_error")), "group", "vec_id").select(
        "vec_id", "code", "error", "label_error", "codebooks_sha256"
    )


#: A conversation that says what a template may say.
HARD_TURN = "\\### Assistant: </turn> ok"


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("tree"), F.col("turn").alias("message"), "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    hard = spark.range(0, 2, 1, 1).select(F.lit(-7).cast("long").alias("tree"), F.col("id").alias("message"), role.alias("role"), F.lit(HARD_TURN).alias("text"))
    rows = rows.unionByName(hard)
    # each turn answers the one before it
    before = Window.partitionBy("tree").orderBy(F.col("message").asc_nulls_last())
    replies = rows.select("tree", "message").distinct().withColumn("parent", F.lag("message").over(before))
    paths = chat.reply_paths(replies.withColumn("score", F.lit(None).cast("double")))
    chats = chat.format_paths(paths, rows)
    turns = chat.turns_of(F.col("formatted"))
    said = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = chat.learned_text(F.col("formatted"), F.col("loss_spans"))
    read = chats.select("tree", F.size(turns).cast("long").alias("n_turns"), said.alias("said"), learned.alias("learned"), F.length("formatted").cast("long").alias("formatted_chars"))
    return read.select(
        F.col("tree").alias("conv_id"), "n_turns", F.sha2(F.col("said").cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"), "formatted_chars",
    )


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = infill.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    form, output = F.col("infill.form"), F.col("infill.output")
    return docs.select(
        "doc_id", "infill.n", "infill.form", "infill.prefix_chars", "infill.middle_chars",
        F.sha2(output.cast("binary"), 256).alias("output_sha256"),
        F.sha2(infill.restored(form, output).cast("binary"), 256).alias("restored_sha256"),
    )


QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_exact_topk": op2_exact_topk,
    "op3_nn_descent": op3_nn_descent,
    "op4_warc_round_trip": op4_warc_round_trip,
    "op5_bpe_round_trip": op5_bpe_round_trip,
    "op6_ngram_jaccard": op6_ngram_jaccard,
    "op7_toxicity": op7_toxicity,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_language": op9_language,
    "op10_shard_bytes": op10_shard_bytes,
    "op11_vector_codes": op11_vector_codes,
    "op12_chat_format": op12_chat_format,
    "op13_fill_in_middle": op13_fill_in_middle,
}
