"""Entity resolution: candidates, reservation by birth date, verdicts, human decisions.

Records of either side are (id, name, birth_date, club), all text, with "" or null for what is unknown. Every step is a
join on a key (a token, a club and date, a candidate), never a pairing of all with all, and no result depends on
an order of processing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from canonlake.functions import scalars as S
from canonlake.operators import algebra

#: What writes a table once that several steps read; as it is, each step computes it anew.
Stage = Callable[[DataFrame], DataFrame]


def as_is(df: DataFrame) -> DataFrame:
    return df


# Verdicts and problems as people know them from the review files.
SHARED, SEVERAL_IN_CLUB, DATE_DIFFERS = "candidato-compartido", "varios-en-club", "fecha-discrepante"
SAME_DATE, SEVERAL, NO_DATE, NOBODY = "varios-misma-fecha", "varios-candidatos", "sin-fecha-que-verificar", "sin-candidato"
UNKNOWN_TOKEN, YES_AND_SKIP, SEVERAL_YES = "token-no-reconocido", "y-con-skip", "varios-y"
YES_WITHOUT, TAKEN, ID_ON_CANDIDATE, NO_CANONICAL = "y-sin-candidato", "tm-id-ya-tomado", "id-en-fila-con-candidato", "biwenger-sin-canonico"


def token_pairs(left: DataFrame, right: DataFrame, scope: list[str] | None = None, stage: Stage = as_is) -> DataFrame:
    """(left_id, right_id) whose token sets are non-empty and one of which holds the other, within equal ``scope`` columns.

    Both sides have id and tokens (distinct). An inverted index does it exactly: the smaller set lies in the larger
    one if and only if they share as many tokens as the smaller has. A pair is only formed under its rarest
    shared token side of the index, whose counts decide: a record is indexed under all its tokens, and looked
    up under its rarest one, in both directions. So a token that a third of the records share joins nothing unless
    it is all that a record has. ``stage`` writes the two indexes, which four joins read.
    """
    scope = scope or []

    def index(df: DataFrame, side: str) -> DataFrame:
        """A row for each record and each of its tokens."""
        own = df.select(*scope, F.col("id").alias(f"{side}_id"), F.col("tokens").alias(f"{side}_tokens")).where(F.size("tokens") > 0)
        return stage(own.withColumn("token", F.explode(f"{side}_tokens")))

    def inside(small: DataFrame, large: DataFrame, a: str, b: str) -> DataFrame:
        """Pairs in which all tokens of ``small`` are in ``large``: each small record meets the large ones of its token with the fewest of them."""
        counts = large.groupBy(*scope, "token").agg(F.count(F.lit(1)).alias("n"))
        each = small.join(counts, [*scope, "token"], "left")
        best = each.groupBy(*scope, f"{a}_id").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("best"), F.first(f"{a}_tokens").alias(f"{a}_tokens"))
        rarest = best.where("best.n > 0").select(*scope, f"{a}_id", f"{a}_tokens", F.col("best.token").alias("token"))
        return rarest.join(large, [*scope, "token"]).where(F.size(F.array_except(f"{a}_tokens", f"{b}_tokens")) == 0).select("left_id", "right_id")

    lefts, rights = index(left, "left"), index(right, "right")
    return inside(lefts, rights, "left", "right").unionByName(inside(rights, lefts, "right", "left")).distinct()


def team_matches(left: DataFrame, right: DataFrame) -> DataFrame:
    """(left_id, right_id) of teams of one competition that are each other's only candidate."""
    pairs = token_pairs(left, right, ["competition"])
    return only_pairs(pairs)


def team_verdicts(left: DataFrame, right: DataFrame, stage: Stage = as_is) -> tuple[DataFrame, DataFrame]:
    """Verdicts (left_id, right_id or null, motivo) of the teams of ``left``, and all candidates (left_id, right_id).

    Each other's only candidate is a match (an empty motivo). Elsewhere a candidate that another team claims too goes before mere
    ambiguity.
    """
    pairs = stage(token_pairs(left, right, ["competition"], stage))
    suitors = pairs.groupBy("right_id").agg(F.count(F.lit(1)).alias("suitors"))
    per = pairs.join(suitors, "right_id").groupBy("left_id").agg(F.count(F.lit(1)).alias("n"), F.max("suitors").alias("suitors"), F.min("right_id").alias("only"))
    judged = left.select(F.col("id").alias("left_id")).distinct().join(per, "left_id", "left")
    motivo = F.when(F.col("n").isNull(), NOBODY).when(F.col("suitors") > 1, SHARED).when(F.col("n") > 1, SEVERAL).otherwise("")
    verdicts = judged.withColumn("motivo", motivo)
    return verdicts.select("left_id", F.when(F.col("motivo") == "", F.col("only")).alias("right_id"), "motivo"), pairs


def only_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs in which either side has no other partner; degrees are grouped counts, combined before the shuffle."""
    wants = pairs.groupBy("left_id").agg(F.count(F.lit(1)).alias("wants"), F.min("right_id").alias("right_id")).where("wants = 1")
    suitors = pairs.groupBy("right_id").agg(F.count(F.lit(1)).alias("suitors")).where("suitors = 1")
    return wants.join(suitors, "right_id").select("left_id", "right_id")


def global_pool(players: DataFrame) -> DataFrame:
    """One record a source id, of its latest season."""
    return algebra.latest_per_key(players.where(F.col("id").isNotNull()), ["id"], [F.col("season").try_cast("int")])


def candidates(left: DataFrame, in_club: DataFrame, pool: DataFrame, stage: Stage = as_is) -> DataFrame:
    """(left_id, right_id, scope): of club, club-fecha and global the first kind that has any.

    ``left`` has id, tokens, birth_date and club (the canonical one, null if unknown); ``in_club`` the other
    source's squads with the same columns; ``pool`` all its records.
    """
    known = left.where(F.col("club").isNotNull())
    named = token_pairs(known, in_club, ["club"], stage).withColumn("scope", F.lit("club")).withColumn("rank", F.lit(0))
    born = (
        known.where(F.coalesce("birth_date", F.lit("")) != "")
        .select(F.col("id").alias("left_id"), "club", "birth_date")
        .join(in_club.where(F.coalesce("birth_date", F.lit("")) != "").select(F.col("id").alias("right_id"), "club", "birth_date"), ["club", "birth_date"])
        .select("left_id", "right_id", F.lit("club-fecha").alias("scope"), F.lit(1).alias("rank"))
        .distinct()
    )
    closer = stage(named.unionByName(born))
    rest = left.join(closer.select(F.col("left_id").alias("id")).distinct(), "id", "left_anti")
    wide = token_pairs(rest, pool, stage=stage).withColumn("scope", F.lit("global")).withColumn("rank", F.lit(2))
    best = closer.groupBy("left_id").agg(F.min("rank").alias("rank"))
    return closer.join(best, ["left_id", "rank"]).unionByName(wide).select("left_id", "right_id", "scope")


def reserved(pairs: DataFrame) -> DataFrame:
    """(right_id, owner) of candidates that the birth date adjudges to one left record alone.

    ``pairs`` has left_id, right_id and confirmed. Only a left record with exactly one confirmed candidate claims.
    """
    single = pairs.where("confirmed").groupBy("left_id").agg(F.count(F.lit(1)).alias("n"), F.min("right_id").alias("right_id")).where("n = 1")
    return single.groupBy("right_id").agg(F.count(F.lit(1)).alias("claims"), F.min("left_id").alias("owner")).where("claims = 1").select("right_id", "owner")


def resolve(left: DataFrame, right: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Verdicts (left_id, right_id or null, motivo) and the trimmed candidates (left_id, right_id).

    ``left`` and ``right`` have id and birth_date, ``pairs`` is what ``candidates`` returns. An empty motivo is an
    approved pair.
    """
    dated = (
        pairs.join(left.select(F.col("id").alias("left_id"), F.coalesce("birth_date", F.lit("")).alias("left_birth")), "left_id")
        .join(right.select(F.col("id").alias("right_id"), F.coalesce("birth_date", F.lit("")).alias("right_birth")), "right_id")
        .withColumn("confirmed", S.birth_matches(F.col("left_birth"), F.col("right_birth")))
    )
    owners = reserved(dated)
    owned = dated.join(owners, "right_id", "left")
    mine = owned.where("owner = left_id and confirmed").select("left_id", F.col("right_id").alias("proved")).distinct()
    # who is proved keeps only the proof; the others lose what is proved to be somebody else's
    trimmed = owned.join(mine, "left_id", "left").where(F.when(F.col("proved").isNotNull(), F.col("right_id") == F.col("proved")).otherwise(F.col("owner").isNull() | (F.col("owner") == F.col("left_id"))))
    suitors = trimmed.groupBy("right_id").agg(F.count_distinct("left_id").alias("suitors"))
    counted = trimmed.join(suitors, "right_id")
    per_left = counted.groupBy("left_id").agg(
        F.max("scope").alias("scope"),
        F.max("suitors").alias("suitors"),
        F.count(F.lit(1)).alias("n"),
        F.count_if("confirmed").alias("n_confirmed"),
        F.min("right_id").alias("only"),
        F.min(F.when(F.col("confirmed"), F.col("right_id"))).alias("only_confirmed"),
        F.max(S.birth_compatible(F.col("left_birth"), F.col("right_birth"))).alias("dates_agree"),
        F.max((F.col("left_birth") == "") | (F.col("right_birth") == "")).alias("date_missing"),
    )
    judged = left.select(F.col("id").alias("left_id")).join(per_left, "left_id", "left")
    scope = F.col("scope")
    motivo = (
        F.when(F.col("n").isNull(), NOBODY)
        .when(F.col("suitors") > 1, SHARED)
        .when((scope == "club") & (F.col("n") > 1), SEVERAL_IN_CLUB)
        .when((scope == "club") & F.col("dates_agree"), "")
        .when(scope == "club", DATE_DIFFERS)
        .when((scope == "club-fecha") & (F.col("n") == 1), "")
        .when(scope == "club-fecha", SAME_DATE)
        .when(F.col("n_confirmed") == 1, "")
        .when(F.col("n_confirmed") > 1, SAME_DATE)
        .when(F.col("n") > 1, SEVERAL)
        .when(F.col("date_missing"), NO_DATE)
        .otherwise(DATE_DIFFERS)
    )
    verdicts = judged.withColumn("motivo", motivo)
    chosen = F.when(F.col("motivo") == "", F.when(scope == "global", F.col("only_confirmed")).otherwise(F.col("only")))
    return verdicts.select("left_id", chosen.alias("right_id"), "motivo"), trimmed.select("left_id", "right_id")


def attachable(left: DataFrame, mapping: DataFrame, source: str, third: str, skips: DataFrame) -> DataFrame:
    """Left records with a canonical id that the third source may still be attached to: not mapped, not skipped."""
    own = mapping.where(F.col("fuente") == source).select(F.col("id_en_fuente").alias("id"), "canonical_id")
    done = mapping.where(F.col("fuente") == third).select("canonical_id").union(skips.select("canonical_id"))
    return left.join(own, "id").join(done.distinct(), "canonical_id", "left_anti")


def classify_decisions(review: DataFrame, taken: DataFrame, allow_id: bool = True) -> tuple[DataFrame, DataFrame]:
    """Actions (left_id, action, right_id) and problems (left_id, right_id, decision, motivo) of marked review rows.

    ``review`` has left_id, right_id ("" without a candidate) and decision; ``taken`` has right_id. All marked rows of
    a left id are judged together. Where two left ids claim one right id, the lower left id, in text
    order, gets it.
    """
    marked = review.withColumns({"kind": S.decision_kind(F.col("decision"), allow_id), "named": S.player_of_token(F.col("decision"))}).where(F.col("kind").isNotNull())
    marked = marked.withColumn("right_id", F.coalesce("right_id", F.lit("")))
    is_ = lambda k: F.count_if(F.col("kind") == k)
    groups = marked.groupBy("left_id").agg(
        is_("unknown").alias("unknown"),
        is_("yes").alias("yes"),
        is_("id").alias("ids"),
        is_("skip").alias("skip"),
        F.max(F.when(F.col("kind") == "yes", F.col("right_id"))).alias("yes_id"),
        F.max(F.when(F.col("kind") == "id", F.col("named"))).alias("named_id"),
        F.max(F.when(F.col("kind") == "id", F.col("right_id"))).alias("id_row_candidate"),
    )
    positives = F.col("yes") + F.col("ids")
    target = F.when(F.col("yes") == 1, F.col("yes_id")).otherwise(F.col("named_id"))
    groups = groups.withColumn("target", F.when(positives == 1, target)).join(taken.select(F.col("right_id").alias("target"), F.lit(True).alias("is_taken")).distinct(), "target", "left")
    problem = (
        F.when(F.col("unknown") > 0, UNKNOWN_TOKEN)
        .when((positives > 0) & (F.col("skip") > 0), YES_AND_SKIP)
        .when(positives > 1, SEVERAL_YES)
        .when((F.col("yes") == 1) & (F.col("target") == ""), YES_WITHOUT)
        .when((F.col("ids") == 1) & (F.col("id_row_candidate") != ""), ID_ON_CANDIDATE)
        .when(F.col("is_taken"), TAKEN)
    )
    judged = groups.withColumn("problem", problem)
    # claims of one right id by several groups: the first in text order takes it; a right id is claimed by few people
    claim = Window.partitionBy("target").orderBy("left_id")
    claims = judged.where("problem is null and target is not null").withColumn("turn", F.row_number().over(claim))
    late = claims.where("turn > 1").select("left_id", F.lit(TAKEN).alias("late"))
    judged = judged.join(late, "left_id", "left").withColumn("problem", F.coalesce("problem", "late"))
    actions = judged.where("problem is null").select("left_id", F.when(F.col("target").isNotNull(), "yes").otherwise("skip").alias("action"), F.col("target").alias("right_id"))
    told = marked.join(judged.where("problem is not null").select("left_id", "problem"), "left_id")
    blamed = F.when(F.col("problem").isin(UNKNOWN_TOKEN, YES_AND_SKIP), F.lit(True)).otherwise(F.col("kind").isin("yes", "id"))
    return actions, told.where(blamed).select("left_id", "right_id", "decision", F.col("problem").alias("motivo"))


def numbered(new: DataFrame, mapping: DataFrame, prefix: str, digits: int, order: list[str], stage: Stage = as_is) -> DataFrame:
    """``new`` with canonical ids that follow the highest one of ``mapping``, in order.

    Rows are dealt out in ranges of the order and numbered within them; a range begins where the counts of those before it end.
    Only those counts, a row a range, meet in one window. ``stage`` writes the numbered ranges, which are read twice.
    """
    start = mapping.agg(F.coalesce(F.max(S.canonical_number(F.col("canonical_id"))), F.lit(0)).alias("__start"))
    dealt = new.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = stage(dealt.withColumns({"__range": F.spark_partition_id(), "__place": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    begins = dealt.groupBy("__range").agg(F.count(F.lit(1)).alias("__n")).withColumn("__begin", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    number = F.col("__start") + F.col("__begin") + F.col("__place") + 1
    return dealt.join(begins, "__range").join(F.broadcast(start)).withColumn("canonical_id", S.canonical_id(prefix, number, digits)).drop("__range", "__place", "__begin", "__start")


def preserve_decisions(rows: DataFrame, old: DataFrame, approved: DataFrame, keys: list[str], left: str) -> DataFrame:
    """Regenerated review rows with the decisions of unresolved people on the same keys, and old rows with a decision that were not regenerated."""
    kept = old.where(F.trim("decision") != "").join(approved.select(F.col("id").alias(left)).distinct(), left, "left_anti")
    carried = kept.select(*keys, F.col("decision").alias("__decision")).dropDuplicates(keys)
    new = rows.join(carried, keys, "left").withColumn("decision", F.coalesce("__decision", "decision")).select(*rows.columns)
    return new.unionByName(algebra.without_keys(kept, rows, keys).select(*rows.columns))


def searched_identity(hits: DataFrame, wanted: DataFrame) -> DataFrame:
    """(query_id, right_id or null, motivo) of search results.

    ``hits`` has query_id, right_id, kind, sport, tokens and birth_date of the found profile; ``wanted`` query_id, tokens and
    birth_date. Only football players with compatible names count.
    """
    found = wanted.join(hits.where("kind = 'player' and sport = 'football'").select("query_id", "right_id", F.col("tokens").alias("__t"), F.col("birth_date").alias("__b")), "query_id", "left")
    fits = F.coalesce(S.compatible(F.col("tokens"), F.col("__t")), F.lit(False))
    per = found.groupBy("query_id").agg(
        F.count_distinct(F.when(fits, F.col("right_id"))).alias("n"),
        F.max(F.when(fits, F.col("right_id"))).alias("only"),
        F.max(F.when(fits, S.birth_matches(F.col("birth_date"), F.col("__b")))).alias("agrees"),
        F.max(F.when(fits, (F.coalesce("birth_date", F.lit("")) == "") | (F.coalesce("__b", F.lit("")) == ""))).alias("missing"),
    )
    motivo = F.when(F.col("n") == 0, "sin-ficha").when(F.col("n") > 1, SEVERAL).when(F.col("missing"), NO_DATE).when(F.col("agrees"), "").otherwise(DATE_DIFFERS)
    return per.withColumn("motivo", motivo).select("query_id", F.when(F.col("motivo") == "", F.col("only")).alias("right_id"), "motivo")


def enqueue_review(review: DataFrame, fresh: DataFrame, left: str) -> DataFrame:
    """The review rows with those of the entities in ``fresh`` replaced."""
    return algebra.keyed_replace(review, fresh, [left])


def safe_identity(profile: DataFrame, mapping: DataFrame, births: DataFrame, source: str, own_source: str) -> DataFrame:
    """(id, outcome) for profiles (id, birth_date): may a history be stored under this id?

    Two hops, from the profile's id to its canonical one and on to the own source's id, then the dates are compared. The
    outcome is ``unmapped`` where a hop is missing, else ``agrees`` (also where a date is unknown) or ``differs``.
    """
    theirs = mapping.where(F.col("fuente") == source).select(F.col("id_en_fuente").alias("id"), "canonical_id")
    own = mapping.where(F.col("fuente") == own_source).select("canonical_id", F.col("id_en_fuente").alias("__own"))
    known = births.where(F.coalesce(F.col("birth_date").cast("string"), F.lit("")) != "").groupBy(F.col("id").cast("string").alias("__own")).agg(F.min(F.col("birth_date").cast("string")).alias("__born"))
    text = profile.select(F.col("id").cast("string").alias("id"), F.coalesce(F.col("birth_date").cast("string"), F.lit("")).alias("birth_date"))
    found = text.join(theirs, "id", "left").join(own, "canonical_id", "left").join(known, "__own", "left")
    outcome = F.when(F.col("__own").isNull(), "unmapped").when(S.birth_compatible(F.col("birth_date"), F.coalesce("__born", F.lit(""))), "agrees").otherwise("differs")
    return found.select("id", outcome.alias("outcome"))


def named_player(queries: DataFrame, mapping: DataFrame, source: str) -> DataFrame:
    """(query, id or null) of texts that name a player: a canonical id, a profile link, or an id in digits."""
    theirs = mapping.where(F.col("fuente") == source).select(F.col("canonical_id").alias("__c"), F.col("id_en_fuente").alias("__id"))
    found = queries.join(theirs, F.col("query") == F.col("__c"), "left")
    return found.select("query", F.when(F.rlike("query", F.lit("^p\\d+$")), F.col("__id")).otherwise(S.player_of_token(F.col("query"))).alias("id"))
