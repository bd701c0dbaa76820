"""A training-data pipeline of five operators over ``documents``; part of the ``casegrid.llm`` subpackage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes every stage's result to the shared
folder and reads it back as the next stage's input. All but the last stage keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casegrid.llm.decontaminate import find_contamination
from casegrid.llm.groups import beside_groups
from casegrid.llm.jaccard import jaccard_components
from casegrid.llm.packing import best_fit_packing
from casegrid.llm.queries import remainder, table, word_tokenizer
from casegrid.llm.substring import remove_repeated
from casegrid.llm.toxicity import fit_toxicity, score_toxicity
from casegrid.operators.rows import quoted
from casegrid.operators.storage import fits_broadcast, settled, stored

#: A document this likely to be toxic goes.
TOXIC = 0.3


def free(docs: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``docs`` has."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def without_rows(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id and hash of the text, also with a NULL id, are not in ``gone`` (doc_id, row)."""
    id_, row_ = free(docs, "_gone"), free(docs, "_row")
    gone = stored(gone.select(F.col("doc_id").alias(id_), F.col("row").alias(row_)).distinct())
    gone_rows = F.broadcast(gone) if fits_broadcast(gone) else gone
    row = F.xxhash64(docs["text"].cast("binary"))
    return docs.join(gone_rows, docs["doc_id"].eqNullSafe(gone[id_]) & (row == gone[row_]), "left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below TOXIC; the model learns from the labelled ones among ``docs``."""
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"), usable=remainder(4) != 2)
    return without_rows(docs, score_toxicity(docs, model).filter(F.col("score") >= TOXIC))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of rows linked by a Jaccard similarity of 0.8 or more on five-word shingles, one with the least id.

    Rows are told apart by id and text: of two rows with one id only the copy goes. A NULL id is larger than all others. Of
    rows that are alike in id and text one stays; rows without words all stay."""
    rows = docs.select("doc_id", "text", F.xxhash64("doc_id", F.col("text").cast("binary")).alias("key"))
    found = jaccard_components(rows.select("key", "text"), size=5, percent=80, id_col="key")
    found = found.filter("n_shingles > 0").groupBy(F.col("doc_id").alias("key")).agg(F.min("component_id").alias("group"), F.count("*").alias("rows"))
    found = stored(found.join(rows.select("key", "doc_id").distinct(), "key"))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key"))["key"]
    groups = stored(found.groupBy("group").agg(least.alias("stays"), F.count("*").alias("n")))
    judged = beside_groups(found, groups, "group", "n").select("key", (F.col("key") == F.col("stays")).alias("stays"), "rows")
    judged = stored(judged.filter("not stays or rows > 1"))
    key, gone = F.xxhash64(docs["doc_id"], docs["text"].cast("binary")), free(docs, "_key")
    left = docs.join(_small(judged.select(F.col("key").alias(gone))), key == F.col(gone), "left_anti")
    # rows alike in all that counts: one of each
    alike = stored(judged.filter("stays").select(F.col("key").alias(gone)))
    if not alike.limit(1).count():
        return left
    again = docs.join(_small(alike), key == F.col(gone)).dropDuplicates([gone]).drop(gone)
    return left.unionByName(again)


def _small(keys: DataFrame) -> DataFrame:
    return F.broadcast(keys) if fits_broadcast(keys) else keys


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 words or more that a document with a smaller id has too.

    Untouched texts stay as they are; documents of which nothing is left go."""
    id_, row_, text_ = (free(docs, name) for name in ("_id", "_row", "_text"))
    row = F.xxhash64(docs["text"].cast("binary"))
    cut = remove_repeated(docs, least=50).filter("n_removed > 0")
    cut = stored(cut.select(F.col("doc_id").alias(id_), F.col("row").alias(row_), F.col("text").alias(text_)))
    cut = cut.dropDuplicates([id_, row_])
    joined = docs.join(cut, (docs["doc_id"] == cut[id_]) & (row == cut[row_]), "left")
    kept = joined.filter(cut[text_].isNull() | (cut[text_] != ""))
    changed = {"text": F.coalesce(cut[text_], docs["text"])}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.coalesce(F.length(cut[text_]), docs["n_chars"])
    return kept.select(*[changed[c].cast(t).alias(c) if c in changed else docs[quoted(c)] for c, t in docs.dtypes])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of ten words of a benchmark item occurs."""
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"), window=10, with_row=True)
    return without_rows(docs, found.filter(F.size("spans") > 0))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of 4096 tokens."""
    return best_fit_packing(docs, word_tokenizer(), end_id=1, capacity=4096)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("repeated_passages", drop_repeated_passages),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: The toxicity models are not expressible in SQL; the tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. What a stage has stored for itself is deleted once its result is written."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = settled(lambda stage=stage, docs=docs: stage(spark, docs, sf_dir))
    return docs
