"""Line dedup: drop lines that many documents share, all but one copy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canonlake.llm.common import SPACES, fresh, let, lower_az, staged


def line_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """All rows and columns of ``df``, with ``text_col`` rewritten and ``n_lines``, ``n_dropped`` (longs) added.

    Texts are split at newlines. A line's key is the line without white space at its ends and with A-Z in
    lower case. Keys of ``min_chars`` code points or more that stand in ``min_docs`` documents or more lose
    their lines everywhere but in the largest id that holds them; the rest is joined again in its order.

    Keys travel as 128-bit hashes. Counting goes by (hash, id), with partial sums before each shuffle, so a
    line that a third of all documents share never meets in one task. Hot hashes are written as a table, so
    the join back has its true size: small tables are broadcast by Spark's own size check, for others the
    skewed side of the join is split by adaptive execution. Texts are shuffled once, by id.

    Null text: stays null, one empty line. A null id is no document: its lines count nowhere and all stay.
    Rows that repeat an id count as one document; each row loses its own lines. Of documents that tie in a line the largest id
    keeps it. Very long texts are read whole; one text's lines meet again in one task. Input columns named
    ``n_lines`` or ``n_dropped`` are replaced, all others stay, whatever their names. An empty table gives an empty table.
    """
    source = df.drop("n_lines", "n_dropped")
    own, row, lost = fresh(source, "__ld_id", "__ld_row", "__ld_pos")
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = (
        source.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("row"), F.posexplode(F.split(lower_az(text), "\n", -1)).alias("pos", "line"))
        .select("id", "row", "pos", F.btrim("line", F.lit(SPACES)).alias("key"))
        .where((F.length("key") >= min_chars) & F.col("id").isNotNull())
        .select("id", "row", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))
    )
    hot = lines.groupBy("h1", "h2").agg(F.count_distinct("id").alias("docs"), F.max("id").alias("holder")).where(F.col("docs") >= min_docs)
    hot = staged(hot.select("h1", "h2", "holder"), "hot-lines")
    drops = (
        lines.join(hot, ["h1", "h2"])
        .where(F.col("id") != F.col("holder"))
        .groupBy(F.col("id").alias(own), F.col("row").alias(row))
        .agg(F.collect_set("pos").alias(lost))
    )
    joined = source.join(drops, (F.col(id_col) == F.col(own)) & (F.xxhash64(text) == F.col(row)), "left")
    n_lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    n_dropped = F.when(F.col(lost).isNull(), 0).otherwise(F.size(lost))
    joined = joined.withColumns({"n_lines": n_lines.cast("long"), "n_dropped": n_dropped.cast("long")})
    kept = F.array_except(F.sequence(F.lit(0), (F.col("n_lines") - 1).cast("int")), F.col(lost))
    rebuilt = let(F.split(text, "\n", -1), lambda parts: F.array_join(F.transform(kept, lambda i: F.get(parts, i)), "\n"))
    return joined.withColumn(text_col, F.when(F.col(lost).isNull(), F.col(text_col)).otherwise(rebuilt)).drop(own, row, lost)
