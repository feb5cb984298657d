"""Exact dedup by a tree merge of sorted digest runs (operator 8).

Every row becomes a digest record.  Records are dealt into ``runs`` runs; a
run is sorted and merged by digest, then runs meet in rounds: in each round
``fan_in`` runs are merged into one, so after log_fan_in(runs) rounds one
record per digest is left.  A merge keeps, per digest, the best row (most code
points, then smallest id) and the number of rows.  The merge key is the
SHA-256 digest together with the normalised length and an independent 64-bit
hash, so two records only ever merge when all three agree: the identifier that
survives is verified at every level.

A hot text with a third of all rows is pre-aggregated inside each run before
anything meets, and no later round sees more than ``fan_in`` records of one
digest in a group.  The way back is as even: a row finds its group by
(digest, run), of which there are at most ``runs`` per digest.

Only DataFrame functions are used.

Defined results: null text counts as empty; empty texts are equal to each
other; ties go to the smallest id and null ids sort last; rows that repeat an
id are separate rows, and among those that are equal in all of this the first
of the table stays, so exactly one row of a group is kept; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankforge.llm.shared import cut_lineage, partitions, text_of, unused, with_row_key

#: Fixed by the definition of equality: the characters that don't count.
BLANKS = r"[\x20\x09-\x0D]+"
FAN_IN = 4
_KEY = ["digest", "n_bytes", "check"]


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, BLANKS, "")


def _merge(level: DataFrame, run: Column) -> DataFrame:
    """Merge the records of equal digest that meet in one run: the keys are
    sorted and neighbouring equal records fold into one."""
    return (level.groupBy(*_KEY, run.alias("run"))
            .agg(F.min("best").alias("best"), F.sum("n").alias("n")))


def _grouped(docs: DataFrame, id_col: str, text_col: str, row_col: str, fan_in: int = FAN_IN,
             runs: int | None = None) -> DataFrame:
    """The digest records with their group's ``best`` and ``size``, null for a
    text that is there once.  ``row_col`` decides between equal ids."""
    spark = docs.sparkSession
    rounds = 1
    while fan_in ** rounds < (runs or partitions(spark)):
        rounds += 1
    text = text_of(text_col)
    norm = docs.select(F.col(row_col).alias("row"), F.col(id_col).alias("id"), F.char_length(text).cast("long").alias("chars"),
                       normalised(text).alias("norm"))
    rows = cut_lineage(norm.select(
        "row", "id", F.unhex(F.sha2("norm", 256)).alias("digest"), F.octet_length("norm").cast("long").alias("n_bytes"),
        F.xxhash64("norm").alias("check"), (-F.col("chars")).alias("order"),
        F.pmod(F.xxhash64("row"), F.lit(fan_in ** rounds)).cast("int").alias("run")))

    best = F.struct(F.col("order"), F.col("id").isNull().alias("no_id"), F.col("id"), F.col("row"))
    first = _merge(rows.select(*_KEY, "run", best.alias("best"), F.lit(1).cast("long").alias("n")), F.col("run"))
    level = first
    for _ in range(rounds):
        level = _merge(level, F.floor(F.col("run") / fan_in).cast("int"))
    groups = level.where("n > 1").select(*_KEY, "best", F.col("n").alias("size"))

    found = first.select(*_KEY, "run").join(groups, _KEY)
    return rows.join(found, [*_KEY, "run"], "left")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                fan_in: int = FAN_IN, runs: int | None = None) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256."""
    row = unused(docs, "__row")
    out = _grouped(with_row_key(docs, row), id_col, text_col, row, fan_in, runs)
    alone = F.col("size").isNull()
    return out.select(F.col("id").alias(id_col), F.when(alone, F.col("id")).otherwise(F.col("best.id")).alias("keep_id"),
                      F.coalesce("size", F.lit(1).cast("long")).alias("group_size"),
                      (alone | (F.col("row") == F.col("best.row"))).alias("kept"),
                      F.lower(F.hex("digest")).alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, one row of each group, with all their columns."""
    row = unused(docs, "__row")
    own = with_row_key(docs, row)
    gone = _grouped(own, id_col, text_col, row).where("row <> best.row").select(F.col("row").alias(row))
    return own.join(gone, row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def op8_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
  FROM documents),
k AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM n)
SELECT doc_id, keep_id, group_size, keep_id = doc_id AS kept, text_sha256 FROM k
"""
