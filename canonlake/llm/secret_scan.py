"""Secret scans over an incremental ledger of blobs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from canonlake.llm.common import let, staged


@dataclass(frozen=True)
class Rule:
    """A pattern, the group that is measured and the least length of it. A change needs a new version."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


#: The base rules come first; their order breaks ties between spans that begin together.
BASE = (
    Rule("assign", 1, r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", 1, r"[0-9a-f]{24,}", 0, 24),
)
RULES = (*BASE, Rule("pem", 1, r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"), Rule("forge", 1, r"gh[pousr]_[A-Za-z0-9]{36,}"), Rule("web_token", 1, r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"))


def _lengths(text: Column, rule: Rule) -> Column:
    """For each match in its order: code points since the match before, of the match, of the measured group."""
    empty = F.array().cast("array<struct<gap:int,len:int,measured:int>>")
    every = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    measured = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    body = let(
        F.split(text, rule.pattern, -1),
        lambda gaps: let(measured, lambda m: F.transform(every, lambda x, i: F.struct(F.length(F.get(gaps, i)).alias("gap"), F.length(x).alias("len"), F.length(F.get(m, i)).alias("measured")))),
    )
    return F.when(F.rlike(text, F.lit(rule.pattern)), body).otherwise(empty)


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows (blob, rule, spans) for blobs with columns blob, text and todo (keys of the rules to run).

    Spark's functions return matched strings, not places; places are running sums of the lengths of the
    matches and of what lies between them. The window that sums spans the matches of one rule in one blob.
    A blob that comes twice is scanned and listed once; texts must not be null (callers give empty ones), and may have any
    length. A blob without matches has a row with no spans for each rule. No blobs: no rows.
    """
    pairs = F.array(*[F.struct(F.lit(r.key).alias("rule"), F.when(F.array_contains("todo", r.key), _lengths(F.col("text"), r)).alias("found"), F.lit(r.least).alias("least")) for r in rules])
    looked = blobs.select("blob", F.explode(F.filter(pairs, lambda p: p["found"].isNotNull())).alias("p")).select("blob", "p.rule", "p.found", "p.least")
    looked = staged(looked.dropDuplicates(["blob", "rule"]), "scanned")
    some = looked.where(F.size("found") > 0).select("blob", "rule", "least", F.posexplode("found").alias("pos", "m"))
    sofar = Window.partitionBy("blob", "rule").orderBy("pos")
    placed = some.withColumn("end", F.sum(F.col("m.gap") + F.col("m.len")).over(sofar)).where(F.col("m.measured") >= F.col("least"))
    span = F.struct((F.col("end") - F.col("m.len")).alias("start"), F.col("end").alias("end"))
    spans = placed.groupBy("blob", "rule").agg(F.sort_array(F.collect_list(span)).alias("spans"))
    none = F.array().cast(spans.schema["spans"].dataType)
    return looked.select("blob", "rule").join(spans, ["blob", "rule"], "left").withColumn("spans", F.coalesce("spans", none))


def secret_scan(df: DataFrame, ledger_path: str, path_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """A row for each row of ``df``: ``path_col``, ``blob`` and ``spans`` (start, kind place, end, kind) in order.

    Every version of a text is a blob, named by its SHA-256. The ledger at ``ledger_path`` has a row for each
    pair of blob and rule version that was ever scanned, with its spans, none included. Only pairs that it
    lacks are scanned, each blob in one of its copies; the ledger grows by them, and findings are joined back
    to all paths that hold the blob. Running again over the same texts scans nothing.

    Copies are found by hashes and ids alone. The texts are shuffled once, by id, never by content, so a
    text that a third of the rows share is no hot spot; the join back is one of narrow rows with a table of
    blobs that have findings, and adaptive execution splits its skewed side.

    Null text: empty, no spans. Null and repeated paths are kept as they come. Empty tables give empty
    tables. Only the two named columns are read, so clashing names do no harm. Texts of any length are read whole.
    """
    spark = df.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    blob = F.unhex(F.sha2(text, 256))
    paths = staged(df.select(F.col(path_col).alias("path"), blob.alias("blob")), "paths")
    wanted = F.array(*[F.lit(r.key) for r in rules])
    fresh = paths.groupBy("blob").agg(F.min("path").alias("holder"))
    if _exists(spark, ledger_path):
        seen = spark.read.parquet(ledger_path).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        fresh = fresh.join(seen, "blob", "left").withColumn("todo", F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>")))).drop("seen")
    else:
        fresh = fresh.withColumn("todo", wanted)
    fresh = fresh.where(F.size("todo") > 0)
    texts = df.select(F.col(path_col).alias("path"), text.alias("text"), blob.alias("own"))
    chosen = texts.join(fresh, texts["path"].eqNullSafe(fresh["holder"]) & (texts["own"] == fresh["blob"])).select("blob", "text", "todo")
    scan_blobs(chosen, rules).write.mode("append").parquet(ledger_path)
    ledger = spark.read.parquet(ledger_path)
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.key), F.lit(i))])
    kind = F.create_map(*[x for r in rules for x in (F.lit(r.key), F.lit(r.kind))])
    hits = ledger.where(F.col("rule").isin([r.key for r in rules]) & (F.size("spans") > 0)).dropDuplicates(["blob", "rule"])
    each = hits.select("blob", F.transform("spans", lambda s: F.struct(s["start"].alias("start"), order[F.col("rule")].alias("place"), s["end"].alias("end"), kind[F.col("rule")].alias("kind"))).alias("spans"))
    found = staged(each.groupBy("blob").agg(F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans")), "findings")
    out = paths.join(found, "blob", "left")
    return out.select(F.col("path").alias(path_col), "blob", F.coalesce("spans", F.array().cast(found.schema["spans"].dataType)).alias("spans"))


def _exists(spark, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)
