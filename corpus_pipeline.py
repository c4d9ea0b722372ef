"""The training-corpus pipeline: stages that read documents, decide, and hand on what they keep.

Each stage works on all rows that its predecessor kept; all but the last return the columns of documents. Ids are
numbers, or texts of numbers. Columns beyond those of documents are handed on unread, whatever their names: while a
stage works, columns have numbers for names. A table without rows goes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shotframe.llm.common import materialize, table
from shotframe.llm.decontam import contaminated
from shotframe.llm.jaccard_join import jaccard_join
from shotframe.llm.langid import fit, language_id
from shotframe.llm.packing import pack_documents
from shotframe.llm.secret_scan import redacted, secret_scan
from shotframe.llm.tokens import vocabulary

#: A text of whose trigrams its language is known to have a smaller share than this is rejected, as is one without a
#: letter. Calibrated on labelled rows that nothing was learned from: see README.
LEAST_KNOWN = 0.5


def _numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """docs with columns column_0, column_1, ..., which clash with none that an operator adds, and the new name of each."""
    names = {c: f"column_{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter (null and empty ones too) and those that no language fits; lang becomes the
    predicted one where it was null. Rows are judged each for itself, so null and repeated ids change nothing."""
    rows, name = _numbered(docs)
    lang = name["lang"]
    tree = fit(rows, id_col=name["doc_id"], text_col=name["text"], lang_col=lang)
    found = language_id(rows, tree, id_col=name["doc_id"], text_col=name["text"], keep=tuple(rows.columns))
    found = found.where((F.col("lang_pred") != "und") & (F.col("known") >= LEAST_KNOWN))
    return found.withColumn(lang, F.coalesce(lang, "lang_pred")).select(rows.columns).toDF(*docs.columns)


def _own_keys(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows with an id, and key: the id, or a hash of id and text (2**62 or more) where an id has several texts."""
    named = rows.where(F.col(id_col).isNotNull())
    text = F.xxhash64(text_col)
    several = materialize(named.groupBy(id_col).agg(F.min(text).alias("x"), F.max(text).alias("y")).where("x <> y").select(id_col, F.lit(True).alias("several")), "several")
    if several.isEmpty():
        return named.withColumn("key", F.col(id_col))
    own = F.xxhash64(id_col, text_col).bitwiseAND((1 << 62) - 1).bitwiseOR(1 << 62)
    return materialize(named.join(several, id_col, "left").withColumn("key", F.when(F.col("several"), own).otherwise(F.col(id_col))).drop("several"), "keys")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of every group of near copies the document with the smallest id.

    Rows with a null id are no copy of anything and stay. Rows of the same id and text are one document, of which one row
    stays (any of them, if other columns differ). An id with several texts names none of them: each text is a document of
    its own, and comes after those whose id has one text. Documents without words are copies of nothing."""
    rows, name = _numbered(docs)
    keyed = _own_keys(rows, name["doc_id"], name["text"])
    kept = jaccard_join(keyed, id_col="key", text_col=name["text"]).where("component_id = key").select("key")
    named = keyed.join(kept, "key", "left_semi").dropDuplicates(["key"]).select(rows.columns)
    return named.union(rows.where(F.col(name["doc_id"]).isNull())).toDF(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item. The text decides, whatever its id: null and repeated ids change
    nothing, null and empty texts stay. Texts are told apart by 64 bits of hash."""
    rows, name = _numbered(docs)
    text = F.xxhash64(name["text"])
    leaks = contaminated(rows.select(text.alias("key"), F.col(name["text"]).alias("text")), table(spark, sf_dir, "benchmark"), id_col="key").select("key").distinct()
    return rows.withColumn("key", text).join(leaks, "key", "left_anti").select(rows.columns).toDF(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret by a mark; n_chars, if there is one, follows the text. Every row stays; null texts stay
    null, and rows of null or repeated ids are each searched."""
    rows, name = _numbered(docs)
    text = name["text"]
    found = secret_scan(rows, id_col=name["doc_id"], text_col=text, keep=tuple(rows.columns)).withColumn("clean", redacted(F.col(text), F.col("spans")))
    if "n_chars" in name:
        found = found.withColumn(name["n_chars"], F.when(F.size("spans") > 0, F.length("clean").cast("long")).otherwise(F.col(name["n_chars"])))
    return found.withColumn(text, F.col("clean")).select(rows.columns).toDF(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places the remaining documents' ids into sequences of 4096. A null or empty text is an end token; every row is a
    document of its own, whatever its id."""
    return pack_documents(docs, vocabulary("word_bpe_49k.json"), capacity=4096, end_id=2)


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("secrets", redact_secrets),
    ("packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; each one's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, f"stage{i}")
    return docs
