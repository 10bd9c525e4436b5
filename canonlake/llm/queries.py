"""The registered queries of this subpackage and their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canonlake.llm import decontaminate as decontamination
from canonlake.llm import line_dedup as lines
from canonlake.llm import packing, periodic_runs, phrases, sentencepieces
from canonlake.llm import quality_classifier as classifier
from canonlake.llm import quality_rules as quality
from canonlake.llm import secret_scan as secrets
from canonlake.llm import sharding
from canonlake.llm import simhash, suffix_dedup
from canonlake.llm import toxicity
from canonlake.llm.common import UPPER, LOWER, new_path, staged

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return keep


#: DuckDB text of the white space that keys lose.
SQL_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@query(
    "op1_line_dedup",
    f"""
    WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
    l AS (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM d),
    k AS (SELECT doc_id, pos, line, trim(translate(line, '{UPPER}', '{LOWER}'), {SQL_SPACES}) AS key FROM l),
    hot AS (SELECT key, max(doc_id) AS holder FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
    m AS (SELECT k.*, hot.key IS NOT NULL AND k.doc_id <> hot.holder AS lost FROM k LEFT JOIN hot USING (key))
    SELECT doc_id, count(*)::BIGINT AS n_lines, count_if(lost)::BIGINT AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
    FROM m GROUP BY doc_id
    """,
)
def op1_line_dedup(spark, sf_dir):
    out = lines.line_dedup(table(spark, sf_dir, "documents"), "doc_id", "text", min_chars=40, min_docs=5)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("op2_sharding")
def op2_sharding(spark, sf_dir):
    text = F.coalesce("text", F.lit(""))
    facts = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    path = new_path(spark, "shard-map")
    out = staged(sharding.shard_rows(facts, "doc_id", "size", 24, map_path=path), "sharded")
    # the map's second version, for a shard more: where each document would go
    edited = F.broadcast(sharding.rebalance(out, "size", path, 25).withColumnRenamed("shard", "rebalanced_shard"))  # a row for each virtual slot
    out = out.join(edited, "virtual_slot")
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "rebalanced_shard")


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


def _secret_oracle() -> str:
    keyword = "(" + "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key")) + ")"
    parts = []
    for place, rule in enumerate(secrets.RULES):
        pattern = rule.pattern.replace("(?i:(password|passwd|secret|token|api_?key))", keyword).replace("'", "''")
        parts.append(
            f"""SELECT doc_id, '{rule.kind}' AS kind, {place} AS place, {rule.least} AS least, unnest(regexp_extract_all(t, '{pattern}')) AS hit,
            unnest(regexp_extract_all(t, '{pattern}', {rule.group})) AS m, unnest(regexp_split_to_array(t, '{pattern}')) AS gap,
            generate_subscripts(regexp_split_to_array(t, '{pattern}'), 1) AS pos FROM d"""
        )
    listed = "coalesce(string_agg(concat(kind, ':', start, ':', stop), ',' ORDER BY start, place){where}, '')"
    base = "'assign', 'access', 'hex'"
    return f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    a AS ({" UNION ALL ".join(parts)}),
    w AS (SELECT *, sum(length(gap) + coalesce(length(hit), 0)) OVER (PARTITION BY doc_id, place ORDER BY pos) AS stop FROM a),
    f AS (SELECT doc_id, kind, place, stop::BIGINT AS stop, (stop - length(hit))::BIGINT AS start FROM w WHERE hit IS NOT NULL AND length(m) >= least),
    g AS (SELECT doc_id, count_if(kind = 'assign') AS n_assign, count_if(kind = 'access') AS n_access, count_if(kind = 'hex') AS n_hex,
    {listed.format(where=f" FILTER (kind IN ({base}))")} AS base, {listed.format(where="")} AS spans FROM f GROUP BY doc_id)
    SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (doc_id)
    """


@query("op5_secret_scan", _secret_oracle())
def op5_secret_scan(spark, sf_dir):
    out = secrets.secret_scan(table(spark, sf_dir, "documents"), new_path(spark, "ledger"), "doc_id", "text")
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in secrets.BASE]))
    return out.select(
        "doc_id", of("assign").alias("n_assign"), of("access").alias("n_access"), of("hex").alias("n_hex"), F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )


@query("op7_quality_rules")
def op7_quality_rules(spark, sf_dir):
    out = quality.quality_rules(table(spark, sf_dir, "documents"), "doc_id", "text", ("lang", "source"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")


@query("op10_simhash")
def op10_simhash(spark, sf_dir):
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text", bits=2)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


_SQL_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


@query(
    "op3_decontaminate",
    f"""
    WITH dw AS (SELECT doc_id, {_SQL_WORDS} AS w FROM documents),
    iw AS (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark),
    win AS (SELECT item_id, least(len(w), 10) AS l, array_to_string(w[p:p + least(len(w), 10) - 1], ' ') AS k
    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p FROM iw WHERE len(w) > 0)),
    ls AS (SELECT DISTINCT l FROM win),
    pos AS (SELECT doc_id, l, p, array_to_string(w[p:p + l - 1], ' ') AS k FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS p FROM dw, ls)),
    m AS (SELECT DISTINCT doc_id, pos.l AS l, p, item_id FROM pos JOIN win USING (l, k)),
    h AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + l)) AS q FROM m) GROUP BY doc_id),
    i AS (SELECT doc_id, count(*) AS n, string_agg(i, ',' ORDER BY i) AS s FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM m) GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(i.n, 0)::BIGINT AS n_items, sha256(coalesce(i.s, '')) AS items_sha256,
    h.n IS NOT NULL AS contaminated FROM dw LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id)
    """,
)
def op3_decontaminate(spark, sf_dir):
    out = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), "doc_id", "text", "item_id", "text", window=10)
    listed = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(listed, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def tokenizer_file() -> str:
    """Where the public byte-level vocabulary lies on this machine; executors have it at the same place."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


@query("op4_packing")
def op4_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_file(), "doc_id", "text", capacity=2048, end_id=0)


def _remainder(doc_id, n: int):
    """crc32 of the id as text, modulo n."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


@query("op8_quality_classifier")
def op8_quality_classifier(spark, sf_dir):
    allowed = lambda i: _remainder(i, 5) != 0
    out = classifier.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), allowed, "doc_id", "text", "quality")
    return out.select("doc_id", (_remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op9_toxicity")
def op9_toxicity(spark, sf_dir):
    allowed = lambda i: _remainder(i, 3) != 1
    out = toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), allowed, "doc_id", "text", "toxic")
    return out.select("doc_id", (_remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op6_suffix_dedup")
def op6_suffix_dedup(spark, sf_dir):
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"), "doc_id", "text").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text: a tenth of the texts, by the checksum of the id, repeat words of their own from some place on; the others are unchanged."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    n, g, a, p = F.size("words").cast("long"), F.expr("h div 10"), F.col("a"), F.col("p")
    out = docs.select("doc_id", "text", h.alias("h"), words.alias("words")).withColumn("a", F.when(n > 0, g % n))
    out = out.withColumn("p", 1 + F.expr("(size(words) - a) div (3 + h div 10 % 8)"))
    place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")
    repeated = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get("words", place(i))), " ")
    return out.select("doc_id", F.when(n > 0, repeated).otherwise(F.col("text")).alias("text"))


@query("op11_periodic_runs")
def op11_periodic_runs(spark, sf_dir):
    out = periodic_runs.periodic_runs(planted(table(spark, sf_dir, "documents")), "text", least=24, times=3)
    # runs come by start and period, so the first of equal exponents is the one to take
    higher = lambda best, run: best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"])
    kind = "struct<start: bigint, length: bigint, period: bigint>"
    best = F.aggregate("runs", F.lit(None).cast(kind), lambda best, run: F.when(higher(best, run), run).otherwise(best))
    told = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))), "")
    out = out.withColumn("best", best)
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *[F.col("best")[c].alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), F.sha2(told, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query(
    "op12_phrase_collocations",
    f"""
    WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
    w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
    i AS (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM w, range(1, 6) AS sizes(m) WHERE len(w) >= m),
    g AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS f FROM i GROUP BY ALL),
    t AS (SELECT lang, sum(f) AS n FROM g WHERE m = 1 GROUP BY lang),
    c AS (SELECT lang, m, phrase, string_split(phrase, ' ') AS parts, f AS a FROM g WHERE m > 1 AND f >= 100),
    k AS (SELECT *, array_to_string(parts[:k], ' ') AS first, array_to_string(parts[k + 1:], ' ') AS rest FROM (SELECT *, unnest(range(1, m)) AS k FROM c)),
    s AS (SELECT lang, k.phrase, a, k, x.f AS l, y.f AS r, n, (1000::HUGEINT * a::HUGEINT * n::HUGEINT) // (x.f::HUGEINT * y.f::HUGEINT) AS score
    FROM k JOIN t USING (lang) JOIN (SELECT lang, phrase AS first, f FROM g) x USING (lang, first) JOIN (SELECT lang, phrase AS rest, f FROM g) y USING (lang, rest)),
    low AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    held AS (SELECT lang, array_to_string(parts[b:b + z - 1], ' ') AS phrase, max(a) AS longer
    FROM (SELECT *, unnest(range(1, m - z + 2)) AS b FROM (SELECT *, unnest(range(2, m)) AS z FROM c)) GROUP BY ALL),
    kept AS (SELECT low.* FROM low LEFT JOIN held USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a)
    SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
    FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) WHERE rank <= 2000
    """,
)
def op12_phrase_collocations(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"), "text", "lang", max_words=5, min_count=100, share=100, top=2000)


def piece_model() -> str:
    """Where the public vocabulary of sentence pieces lies on this machine; executors have it at the same place."""
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


@query("op13_sentencepiece")
def op13_sentencepiece(spark, sf_dir):
    out = sentencepieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), piece_model(), "text", begin=True, end=True, back=True)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), "agrees")
