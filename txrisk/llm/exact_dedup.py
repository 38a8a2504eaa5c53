"""Exact deduplication by content sort (operator 9).

Texts are equal when they are identical after white space is deleted. Sampled splitters range-partition
the rows by their normalised bytes, an external sort places equal texts next to each other, and one pass
over each sorted partition compares every text with its neighbour in full. A run of equal texts may go on
in the next partition, because the splitters also cut inside a hot text: the first and last run of every
partition (two rows each) are matched by their whole text, and all others are complete already.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import SPACES, materialize, partition_id

#: Splitters compare this many leading characters, then the digest: their size stays bounded.
SPLITTER_CHARS = 32
#: Row ids that one run hands on at a time.
CHUNK_IDS = 4096

_RUNS = "run long, first boolean, head long, head_chars long, digest binary, border string, ids array<long>"


def normalised(column: str = "text") -> Column:
    return F.regexp_replace(F.coalesce(F.col(column), F.lit("")), SPACES + "+", "")


def _digest(norm: Column) -> Column:
    return F.unhex(F.sha2(norm.cast("binary"), 256))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of equal neighbours in one sorted partition, in pieces of at most CHUNK_IDS ids."""
    base = partition_id() << 33
    count, open_run, last = 0, None, None  # open_run: [first piece?, head, chars, digest, ids, starts the partition?]
    rows: list[tuple] = []

    def emit(run, border):
        rows.append((base + count, run[0], run[1], run[2], run[3], border, run[4]))
        run[0], run[4] = False, []

    def flush():
        columns = list(zip(*rows)) if rows else [[]] * 7
        types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.binary(), pa.string(), pa.list_(pa.int64())]
        names = ["run", "first", "head", "head_chars", "digest", "border", "ids"]
        out = pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)
        rows.clear()
        return out

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        norm, digest = batch.column("norm"), batch.column("digest")
        ids, chars = batch.column("doc_id").to_pylist(), batch.column("chars").to_pylist()
        # A run goes on where the whole text equals its neighbour's; the digest is only the quicker first look.
        new = np.ones(n, bool)
        if n > 1:
            near = pc.equal(digest.slice(1), digest.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            at = np.flatnonzero(near)
            same = pc.equal(norm.take(pa.array(at + 1)), norm.take(pa.array(at))).to_numpy(zero_copy_only=False)
            new[at[same.astype(bool)] + 1] = False
        if last is not None:
            new[0] = norm[0].as_py() != last
        starts = np.flatnonzero(new).tolist()
        if not new[0]:
            starts = [0, *starts]
        for k, a in enumerate(starts):
            b = starts[k + 1] if k + 1 < len(starts) else n
            if new[a]:
                if open_run is not None:
                    emit(open_run, last_text if open_run[5] else None)
                    count += 1
                open_run = [True, ids[a], chars[a], digest[a].as_py(), [], open_run is None]
                last_text = norm[a].as_py() if open_run[5] else None
            for c in range(a, b, CHUNK_IDS):
                if len(open_run[4]) + min(b, c + CHUNK_IDS) - c > CHUNK_IDS:
                    emit(open_run, None)
                open_run[4] += ids[c:min(b, c + CHUNK_IDS)]
        last = norm[n - 1].as_py()
        yield flush()
    if open_run is not None:
        emit(open_run, last)
        yield flush()


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the most code points stays, then the smallest id (a null id counts as the
    largest). Null texts count as empty, so all empty and blank texts are one group. Of repeated rows with
    the same id and text exactly one is kept. An empty table gives an empty result; other columns, whatever
    their names, are not read.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.char_length(text).cast("long").alias("chars"), normalised(text_col).alias("norm"),
    ).withColumn("digest", _digest(F.col("norm")))
    # The text itself is no splitter: its head and digest order it, and the id cuts inside a hot text.
    head = F.substring("norm", 1, SPLITTER_CHARS)
    order = [head, F.col("digest"), F.col("chars").desc(), F.col("doc_id").asc_nulls_last()]
    sorted_rows = keyed.repartitionByRange(parts, *order).sortWithinPartitions(head, "digest", "norm", F.col("chars").desc(), F.col("doc_id").asc_nulls_last())
    runs = materialize(sorted_rows.mapInArrow(_runs, _RUNS), "op9-runs")

    best = F.min(F.struct((-F.col("head_chars")).alias("neg"), F.col("head").isNull().alias("nil"), F.col("head").alias("id"), F.col("run").alias("run")))
    whole = runs.groupBy("run").agg(best.alias("best"), F.sum(F.size("ids")).alias("n"), F.max("border").alias("border"))
    inner = whole.where("border is null").select("run", "best", "n")
    # At most two rows per partition: equal whole texts are one group.
    edge = whole.where("border is not null").groupBy("border").agg(F.min("best").alias("best"), F.sum("n").alias("n"), F.collect_list("run").alias("runs"))
    groups = inner.unionByName(edge.select(F.explode("runs").alias("run"), "best", "n"))
    rows = runs.join(groups, "run").select("*", F.posexplode("ids").alias("pos", "doc_id"))
    return rows.select(
        "doc_id",
        F.col("best.id").alias("keep_id"),
        F.col("n").cast("long").alias("group_size"),
        ((F.col("best.run") == F.col("run")) & F.col("first") & (F.col("pos") == 0)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_first_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that :func:`exact_dedup` keeps, with all their columns."""
    kept = exact_dedup(docs).where("kept").select(F.col("doc_id").alias("__id"), F.unhex("text_sha256").alias("__digest"))
    d = docs.withColumn("__mark", _digest(normalised()))
    out = d.join(kept, d["doc_id"].cast("long").eqNullSafe(kept["__id"]) & (d["__mark"] == kept["__digest"]), "left_semi")
    # Repeated rows share id and text: one of them stays.
    one = Window.partitionBy("doc_id", "__mark").orderBy(F.char_length("text").desc_nulls_last())
    return out.withColumn("__nth", F.row_number().over(one)).where("__nth = 1").drop("__nth", "__mark")


def op9_exact_dedup(spark, sf_dir):
    from .common import read_table

    return exact_dedup(read_table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents
), g AS (
  SELECT doc_id, chars, norm, count(*) OVER (PARTITION BY norm) AS n,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY chars DESC, doc_id NULLS LAST) AS keep_id,
         row_number() OVER (PARTITION BY norm ORDER BY chars DESC, doc_id NULLS LAST) AS nth
  FROM t
)
SELECT doc_id, keep_id, n AS group_size, nth = 1 AS kept, sha256(norm) AS text_sha256 FROM g
"""
