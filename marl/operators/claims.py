"""The life of claims as folds of append-only tables: live edges, standing decisions, maturity, merges.

An edge ties an event to a claim by a verb; its identity is (event_id, verb, claim_id) and its versions are rows with
`active` and `at`. A decision is a row (verb, target, at) that may name an edge or a pair. Nothing is rewritten: a retraction is a
newer version, and a rejected merge outlives every later version of its edge.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marl.functions import scores
from marl.functions.scores import age_days
from marl.operators.folds import latest, minus, terminal
from marl.operators.temporal import entrenchment

IDENTITY = ["event_id", "verb", "claim_id"]
VERBS = ("corroborates", "contradicts")
# The decisions that end a claim, the standing at which it is active, and the days in which evidence keeps it so.
ENDED, ACTIVE, ACTIVE_DAYS, SUGGEST_DAYS = ("retire", "reject", "merge", "supersede"), 0.5, 90.0, 30.0
REJECT_MERGE, REOPEN = "reject-merge", "reopen"


def edge_id(event: Column, verb: Column, claim: Column) -> Column:
    return F.concat_ws("|", event, verb, claim)


class Rejected(NamedTuple):
    edges: DataFrame
    pairs: DataFrame
    epochs: DataFrame
    reopened: DataFrame


def rejected(decisions: DataFrame) -> Rejected:
    """What rejected merges say, each as a table: `edges` (edge), `pairs` (a, b; a <= b), `epochs` (event_id, epoch) counted by
    event, and `reopened` (event_id, at), the latest rejection or reopening.

    `decisions` has (verb, target, at, edge, pair). The event of a rejection is its target, else the first part of its
    edge; an edge also keeps its event and claim apart. Pairs of other than two members are ignored.
    """
    said = decisions.where(F.col("verb") == REJECT_MERGE)
    parts = F.split("edge", r"\|")
    event = F.coalesce("target", F.when(F.size(parts) == 3, parts[0]))
    edges = said.where("edge is not null").select("edge").distinct()
    both = said.where(F.size(parts) == 3).select(F.array_sort(F.array(parts[0], parts[2])).alias("p")).union(said.where("size(pair) = 2").select(F.array_sort("pair")))
    pairs = both.select(F.col("p")[0].alias("a"), F.col("p")[1].alias("b")).distinct()
    epochs = said.select(event.alias("event_id")).where("event_id is not null").groupBy("event_id").agg(F.count("*").alias("epoch"))
    again = decisions.where(F.col("verb").isin(REJECT_MERGE, REOPEN)).select(F.when(F.col("verb") == REOPEN, F.col("target")).otherwise(event).alias("event_id"), "at")
    return Rejected(edges, pairs, epochs, again.where("event_id is not null").groupBy("event_id").agg(F.max("at").alias("at")))


def live_edges(edges: DataFrame, gone: DataFrame | None = None, order: list[str] = ["at"]) -> DataFrame:
    """The latest version of each edge if it is active, of a known verb, and not among the rejected edges `gone` (edge)."""
    now = latest(edges, IDENTITY, order).where(F.col("active") & F.col("verb").isin(*VERBS))
    if gone is None:
        return now
    return minus(now.withColumn("edge", edge_id(*map(F.col, IDENTITY))), gone, ["edge"]).drop("edge")


def retracted(edges: DataFrame, at: Column) -> DataFrame:
    """Rows to append that retract `edges`; everything but `active` and `at` stays as it was."""
    return edges.withColumn("active", F.lit(False)).withColumn("at", at)


def done_key(key: Column, epoch: Column) -> Column:
    """The key under which an event is marked as processed: a rejected merge gives it a new one."""
    return F.when(F.coalesce(epoch, F.lit(0)) > 0, F.concat(key, F.lit("#e"), epoch.cast("string"))).otherwise(key)


def live_claims(claims: DataFrame, decisions: DataFrame, order: list[str] = ["at"]) -> DataFrame:
    """Claims (claim_id, born, ...), the latest version of each, without those whose latest decision ends them and binds.

    A decision (verb, target, at) that is older than the claim's birth meant what had the id before and does not bind.
    """
    now = latest(claims, ["claim_id"], order)
    last = latest(decisions.where("target is not null").select("target", "verb", "at"), ["target"], ["at", "verb"])
    ended = now.join(last.select(F.col("target").alias("claim_id"), "verb", F.col("at").alias("_at")), "claim_id")
    ended = ended.where(F.col("verb").isin(*ENDED) & (F.col("born").isNull() | (F.col("_at") >= F.col("born"))))
    return minus(now, ended.select("claim_id"), ["claim_id"])


def folded(edges: DataFrame, events: DataFrame) -> DataFrame:
    """(claim_id, support, sessions, against, against_sessions, repos, files, scope, scope_repo, confidence, surprise, insight,
    research, fingerprint) of claims with a live edge.

    `events` has (event_id, session_id, repo, files, confidence, markers), one row an event. The scope is cross-cutting where the supporting events
    come from two repositories or more and no file is in two of them; the repository is named where there is but one.
    An edge whose event is missing still counts as support.
    """
    both = edges.join(events.select("event_id", "repo", "files", "confidence", "markers", F.col("session_id").alias("_s")), "event_id", "left").withColumn("session", F.coalesce("session_id", "_s"))
    pro, con = F.col("verb") == "corroborates", F.col("verb") == "contradicts"
    distinct = lambda c, name: F.count_distinct(F.when(c, F.col(name)))
    top = lambda name: F.max(F.when(pro, F.coalesce(F.col(f"markers.{name}"), F.lit(0.0)))).alias(name)
    ids = F.array_sort(F.collect_set(F.when(pro, edge_id(*map(F.col, IDENTITY)))))
    one = both.groupBy("claim_id").agg(
        distinct(pro, "event_id").alias("support"), distinct(pro, "session").alias("sessions"), distinct(con, "event_id").alias("against"), distinct(con, "session").alias("against_sessions"),
        F.array_sort(F.collect_set(F.when(pro, F.col("repo")))).alias("repos"), F.coalesce(F.max(F.when(pro, F.coalesce("confidence", F.lit(0.5)))), F.lit(0.5)).alias("confidence"),
        top("surprise"), top("insight"), top("research"), F.substring(F.sha2(F.array_join(ids, "\n"), 256), 1, 16).alias("fingerprint"),
    )
    per_file = both.where(pro).select("claim_id", "event_id", F.explode("files").alias("file")).where("file is not null").groupBy("claim_id", "file").agg(F.count_distinct("event_id").alias("n"))
    files = per_file.groupBy("claim_id").agg(F.array_sort(F.collect_set("file")).alias("files"), F.max(F.col("n") > 1).alias("shared"))
    out = one.join(files, "claim_id", "left").withColumn("files", F.coalesce("files", F.array().cast("array<string>")))
    crossing = (F.size("repos") >= 2) & ~F.coalesce("shared", F.lit(False))
    return out.withColumn("scope", F.when(crossing, "cross-cutting").otherwise("local")).withColumn("scope_repo", F.when(F.size("repos") == 1, F.col("repos")[0]).otherwise("global")).drop("shared")


def standing(edges: DataFrame, session: str, repo: str, ts: str, now: str, mature: float = scores.MATURE) -> DataFrame:
    """(claim_id, support, contradictions, entrenchment, youngest, active, mature) of claims by their live edges.

    `edges` carries the session of each, its repository and its valid time; sittings, not sessions, are counted. A claim is active by a
    standing of ACTIVE or by a supporting session of the last ACTIVE_DAYS days, and mature by a standing of `mature`. A session of unknown
    time is fresh. `youngest` is the age in days of the newest supporting session, null without one.
    """
    weights = entrenchment(edges, "claim_id", session, repo, ts, F.col("verb") == "contradicts", now)
    age = F.when((F.col("verb") == "corroborates") & F.col(session).isNotNull(), age_days(F.col(ts), now))
    young = edges.groupBy("claim_id").agg(F.min(age).alias("youngest"))
    net = F.coalesce("entrenchment", F.lit(0.0))
    out = young.join(weights, "claim_id", "left").withColumn("entrenchment", net)
    return out.select("claim_id", F.coalesce("support", F.lit(0)).alias("support"), F.coalesce("contradictions", F.lit(0)).alias("contradictions"), "entrenchment", "youngest", ((net >= ACTIVE) | F.coalesce(F.col("youngest") <= ACTIVE_DAYS, F.lit(False))).alias("active"), (net >= mature).alias("mature"))


def bar_text(entrench: Column, mature: Column, sessions: Column, bar: float = scores.MATURE) -> Column:
    """One line on how a claim stands to the bar."""
    told = F.format_string(f"%.2f of {bar:g} from %d sessions", entrench, sessions)
    return F.when(mature, F.concat(F.lit("mature: "), told)).when(entrench > 0, F.concat(F.lit("growing: "), told)).otherwise(F.concat(F.lit("contested: "), told))


def importance(entrench: Column, confidence: Column) -> Column:
    return entrench * F.coalesce(confidence, F.lit(0.5))


def trusted(claims: DataFrame, decisions: DataFrame, stand: DataFrame) -> DataFrame:
    """Live claims whose latest binding decision accepts them and that are mature."""
    last = latest(decisions.where("target is not null").select("target", "verb", "at"), ["target"], ["at", "verb"]).where(F.col("verb").isin("accept", "edit"))
    ok = claims.join(last.select(F.col("target").alias("claim_id"), F.col("at").alias("_at")), "claim_id").where(F.col("born").isNull() | (F.col("_at") >= F.col("born"))).drop("_at")
    return ok.join(stand.where("mature").select("claim_id"), "claim_id", "left_semi")


def merged(edges: DataFrame, merges: DataFrame, at: Column, blocked: DataFrame | None = None) -> DataFrame:
    """Edge versions to append so that each winner of `merges` (loser, winner) has its loser's edges: the winner gains those whose event and
    verb it has not, and the loser's are retracted.

    `edges` are live. Chains of merges are followed to their end, rounds are dropped, and a pair that is `blocked` (a, b) is refused
    and moves nothing. Several losers of one winner give an event and verb once, the one of the least loser.
    """
    asked = merges.where(F.col("loser") != F.col("winner"))
    if blocked is not None:
        asked = asked.withColumn("a", F.least("loser", "winner")).withColumn("b", F.greatest("loser", "winner")).join(blocked.select("a", "b").distinct(), ["a", "b"], "left_anti").select("loser", "winner")
    ends = terminal(asked).where("winner is not null")
    mine = edges.join(ends.withColumnRenamed("loser", "claim_id"), "claim_id")
    have = edges.select(F.col("claim_id").alias("winner"), "event_id", "verb").distinct()
    gained = mine.join(have, ["winner", "event_id", "verb"], "left_anti").withColumn("repointed_from", F.col("claim_id"))
    rest = [c for c in edges.columns if c not in IDENTITY]
    once = gained.groupBy("winner", "event_id", "verb").agg(F.min_by(F.struct(*rest, "repointed_from"), "claim_id").alias("r"))
    gains = once.select(F.col("winner").alias("claim_id"), "event_id", "verb", "r.*").withColumn("active", F.lit(True)).withColumn("at", at)
    return gains.select(*edges.columns, "repointed_from").union(retracted(mine.select(*edges.columns), at).withColumn("repointed_from", F.lit(None).cast(edges.schema["claim_id"].dataType)))


def children(edges: DataFrame, valid: DataFrame, kind: str = "generalizes", order: list[str] = ["at"]) -> DataFrame:
    """(src, children): what each valid node generalizes, sorted; `edges` has versions of (src, kind, dst) with active and at, `valid` (id)."""
    now = latest(edges, ["src", "kind", "dst"], order).where(F.col("active") & (F.col("kind") == kind))
    for end in ("src", "dst"):
        now = now.join(valid.select(F.col("id").alias(end)).distinct(), end, "left_semi")
    return now.groupBy("src").agg(F.array_sort(F.collect_set("dst")).alias("children"))


def assigned_tags(assignments: DataFrame, redirects: DataFrame, order: list[str] = ["at"]) -> DataFrame:
    """(concept_id, tags): of the latest assignment of each concept (concept_id, tags, at) the tags at the end of their redirects (loser, winner), sorted and once; dropped tags are left out."""
    now = latest(assignments, ["concept_id"], order)
    each = now.select("concept_id", F.explode("tags").alias("tag")).where("tag is not null")
    led = terminal(redirects).select(F.col("loser").alias("tag"), F.struct("winner").alias("to"))
    ended = each.join(led, "tag", "left").select("concept_id", F.when(F.col("to").isNull(), F.col("tag")).otherwise(F.col("to.winner")).alias("tag")).where("tag is not null")
    sets = ended.groupBy("concept_id").agg(F.array_sort(F.collect_set("tag")).alias("tags"))
    return now.select("concept_id").join(sets, "concept_id", "left").select("concept_id", F.coalesce("tags", F.array().cast("array<string>")).alias("tags"))


def valid_times(raw: DataFrame) -> DataFrame:
    """(session_id, valid): when each session happened, by the latest version of its raw text (source_id, source_kind, fetched_at, content_hash, mtime); null where it does not say."""
    rows = raw.where(F.col("source_kind").isin("transcript", "document"))
    return latest(rows.select("source_id", "fetched_at", "content_hash", "mtime"), ["source_id"], ["fetched_at", "content_hash"]).select(F.col("source_id").alias("session_id"), F.col("mtime").alias("valid"))
