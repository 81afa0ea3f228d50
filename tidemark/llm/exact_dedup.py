"""Exact deduplication against a persistent index of digests.

The index is a table bucketed and sorted by digest. New data is reduced to one row per digest
before it is shuffled, compared with the index by a sort-merge anti-join in which the index is
not shuffled, and what is new is appended bucket by bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.stage import Run

#: The characters that do not count: space, tab, line feed, vertical tab, form feed, return.
WHITE = " \t\n\x0b\x0c\r"
BUCKETS = 64

_COLUMNS = "digest STRING, n_chars BIGINT, keep_id BIGINT"


def normalised(text: Column) -> Column:
    """The text without white space; NULL counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), WHITE, "")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, digest (SHA-256 of the normalised text), n_chars (code points as they were), row.

    ``row`` tells rows apart that repeat an id; it is fixed only once this has been written.
    """
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.sha2(normalised(F.col("text")), 256).alias("digest"),
        F.coalesce(F.char_length("text"), F.lit(0)).cast("long").alias("n_chars"),
        F.monotonically_increasing_id().alias("row"),
    )


class DigestIndex:
    """The digests seen so far, each with the id that was kept, as a table at ``path``.

    The table outlives the application: opened again at the same path it holds what was appended.
    One application at a time may append.
    """

    def __init__(self, spark: SparkSession, name: str, path: str, buckets: int = BUCKETS):
        self.spark, self.name, self.buckets = spark, name, buckets
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({_COLUMNS}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def unseen(self, best: DataFrame) -> DataFrame:
        """Rows of ``best`` (one per digest) that the index does not hold.

        The index arrives in its buckets, so only the new rows are shuffled.
        """
        known = self.rows().select("digest").hint("merge")
        return best.join(known, "digest", "left_anti")

    def append(self, rows: DataFrame) -> None:
        """Add digests that are not in the index. One task writes one bucket."""
        rows.select("digest", "n_chars", "keep_id").repartition(self.buckets, "digest").write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)


def groups(seen: DataFrame) -> DataFrame:
    """One row per digest: group_size and the row that stays.

    The text with most code points stays, then the smallest id, then the first row; a NULL id comes
    last. Reduced before the shuffle, so a text held by a third of all rows costs one row per task.
    """
    order = F.struct(-F.col("n_chars"), F.col("doc_id").isNull(), "doc_id", "row")
    return (
        seen.groupBy("digest")
        .agg(F.min(order).alias("best"), F.count("*").alias("group_size"))
        .select("digest", (-F.col("best.col1")).alias("n_chars"), F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"), "group_size")
    )


def deduplicated(run: Run, docs: DataFrame, index: DigestIndex) -> DataFrame:
    """Decide on every row of ``docs`` and append the new digests to ``index``.

    Returns doc_id, keep_id, group_size, kept, text_sha256, one row per row of ``docs``:

    * NULL or white text is the empty text, and all empty texts are one group.
    * A text the index already held is dropped whole; keep_id is then the id kept back then.
    * Rows repeating id and text are one group, and exactly one of them is kept.
    * An empty table gives no rows. Other columns of ``docs``, whatever their names, are not read.
    """
    seen = run.written(digests(docs), "digests")
    best = run.written(groups(seen), "groups")
    new = run.written(index.unseen(best), "new")
    known = index.rows().select("digest", F.col("keep_id").alias("known_id"))
    decided = best.join(new.select("digest", F.lit(True).alias("is_new")), "digest", "left").join(known.hint("merge"), "digest", "left")
    decided = run.written(
        decided.select(
            "digest",
            F.coalesce("is_new", F.lit(False)).alias("is_new"),
            F.when(F.col("is_new"), F.col("keep_id")).otherwise(F.col("known_id")).alias("keep_id"),
            "keep_row",
            "group_size",
        ),
        "decided",
    )
    index.append(new)
    return seen.join(decided, "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("is_new") & (F.col("row") == F.col("keep_row"))).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def kept(run: Run, docs: DataFrame, index: DigestIndex) -> DataFrame:
    """The rows of ``docs`` that stay, with all columns; of rows repeating id and text one."""
    stay = run.written(deduplicated(run, docs, index).where("kept").select("doc_id", "text_sha256"), "kept")
    repeated = run.written(docs.select("doc_id").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    rows = docs.select(F.struct("*").alias("row"), "doc_id", F.sha2(normalised(F.col("text")), 256).alias("digest"))
    same = rows["doc_id"].eqNullSafe(stay["doc_id"]) & (rows["digest"] == stay["text_sha256"])
    rows = rows.join(stay, same, "left_semi")
    if not repeated.isEmpty():
        rows = rows.dropDuplicates(["doc_id", "digest"])
    return rows.select("row.*")


def fresh(run: Run) -> DigestIndex:
    """An empty index that lives as long as the run's folder."""
    spark, name = run.spark, f"digest_index_{run.folder.rsplit('-', 1)[-1]}"
    return DigestIndex(spark, name, f"{run.folder}/index")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against an index that starts empty."""
    run = Run(spark, "op6")
    return deduplicated(run, spark.read.parquet(f"{sf_dir}/documents.parquet"), fresh(run))


OP6_SQL = r"""
WITH seen AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id) AS place,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM seen
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM ranked
"""
