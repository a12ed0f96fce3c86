"""Cohesion of groups over ballots, counting the members who could have voted.

A member who is eligible and silent counts as absent. Eligible members are not listed: how many a group has on a date
follows from where its members' spans begin and end, by a running sum over dates, so no product of members and ballots
is ever made. Only votes that were cast are joined, each to its own member's spans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemill.functions.values import rate
from lakemill.operators.dedupe import latest, tasks_for
from lakemill.operators.intervals import eligible, islands
from lakemill.operators.lineage import settled

#: Positions that express a choice, in the order in which ties are decided.
CHOICES = ("for", "against", "abstain")


def eligible_counts(members: DataFrame, spans: DataFrame, ballots: DataFrame) -> DataFrame:
    """ballots(grp, ballot, date, ...) with n_eligible.

    members(member, grp), spans(member, first, last): a member without any span is eligible at all times. A ballot
    without a date is open to all members of the group, as a missing date excludes nobody.
    """
    merged = islands(spans.withColumn("first", F.coalesce("first", F.lit("0001-01-01").cast("date"))), ["member"], "first", "last")
    placed = members.join(merged, "member", "left")
    starts = placed.select("grp", F.coalesce("first", F.lit("0001-01-01").cast("date")).alias("date"), F.lit(1).alias("step"))
    ends = placed.where("last is not null").select("grp", F.date_add("last", 1).alias("date"), F.lit(-1).alias("step"))
    steps = starts.union(ends).groupBy("grp", "date").agg(F.sum("step").alias("step"))
    days = ballots.where("date is not null").select("grp", "date").distinct().withColumn("step", F.lit(0))
    order = Window.partitionBy("grp").orderBy("date").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    running = steps.union(days).groupBy("grp", "date").agg(F.sum("step").alias("step")).withColumn("n_dated", F.sum("step").over(order))
    size = members.groupBy("grp").agg(F.count("*").alias("n_members"))
    counted = ballots.join(running.select("grp", "date", "n_dated"), ["grp", "date"], "left").join(size, "grp")
    return counted.select(*ballots.columns, F.when(F.col("date").isNull(), F.col("n_members")).otherwise(F.coalesce("n_dated", F.lit(0))).cast("long").alias("n_eligible"))


def last_votes(members: DataFrame, spans: DataFrame, votes: DataFrame, ballots: DataFrame, tasks: int | None = None) -> DataFrame:
    """(grp, member, ballot, date, position, allowed): each member's last vote on a ballot, and whether they were
    eligible at its date.

    votes(member, ballot, position, pos); pos orders a member's votes on a ballot and tells them apart. A member's spans
    are gathered beforehand, so a vote meets one row. Votes are the many; so the other sides, a row for each ballot and
    member, are hashed, and votes are not sorted for the joins.
    """
    own = spans.groupBy("member").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    placed = members.join(own, "member", "left").hint("shuffle_hash")
    dated = ballots.select("ballot", "date").hint("shuffle_hash")
    last = latest(votes, ["member", "ballot"], ["position"], "pos", tasks).join(dated, "ballot").join(placed, "member")
    return last.select("grp", "member", "ballot", "date", "position", eligible(F.col("date"), F.col("spans")).alias("allowed"))


def cohesion(members: DataFrame, spans: DataFrame, votes: DataFrame, ballots: DataFrame, quorum: float = 0.5) -> DataFrame:
    """One row for each group and ballot on which a member of the group voted and someone was eligible.

    ballots(ballot, date): votes on other ballots are left out. A null position counts as absent; positions outside the
    known six count as present only.
    """
    tasks = tasks_for(votes)
    return _cohesion(members, spans, last_votes(members, spans, votes, ballots, tasks), quorum, tasks)


def _cohesion(members: DataFrame, spans: DataFrame, last: DataFrame, quorum: float, tasks: int) -> DataFrame:
    """cohesion() of last_votes(). The counts by group and ballot are written once, as their dates are needed as well.

    Votes come by member, so those of a group on a ballot are apart and hardly fewer if counted where they are; they are
    dealt to so many tasks and counted there, as a task keeps a row for each group and ballot it meets.
    """
    n, allowed = F.col("n_eligible"), F.col("allowed")
    counts = last.repartition(tasks, "grp", "ballot").groupBy("grp", "ballot", "date").agg(
        *[F.count_if(allowed & (F.col("position") == p)).alias(f"n_{p}") for p in (*CHOICES, "nonvoting", "excused")],
        F.count_if(allowed & F.col("position").isNotNull() & (F.col("position") != "absent")).alias("n_stated"),
    )
    counts = settled(counts)
    stated = [c for c in counts.columns if c not in ("grp", "ballot", "date")]
    rows = eligible_counts(members, spans, counts).where("n_eligible > 0").select("grp", "ballot", "date", "n_eligible", *stated)
    rows = rows.withColumn("n_absent", n - F.col("n_stated"))
    top = F.greatest(*[f"n_{p}" for p in CHOICES])
    majority = F.when(top == 0, None)
    for p in CHOICES:
        majority = majority.when(F.col(f"n_{p}") == top, p)
    present = n - F.col("n_absent") - F.col("n_excused")
    aligned = F.when(top > 0, top).otherwise(0)
    return rows.select(
        "grp", "ballot", "date", "n_eligible", *[f"n_{p}" for p in (*CHOICES, "nonvoting", "excused")], "n_absent", majority.alias("majority"),
        rate(present, n).alias("participation"), (F.try_divide(present.cast("double"), n.cast("double")) >= quorum).alias("quorum"),
        rate(aligned, n).alias("coherence"), rate(aligned, present).alias("coherence_present"),
    )


def member_gaps(members: DataFrame, spans: DataFrame, votes: DataFrame, ballots: DataFrame, quorum: float = 0.5) -> DataFrame:
    """Each member's participation and alignment against the mean of their group's rounded rates over its ballots.

    A member counts on the ballots of the group at whose date they are eligible; present means one of CHOICES here.
    """
    tasks = tasks_for(votes)
    last = settled(last_votes(members, spans, votes, ballots, tasks))
    group = settled(_cohesion(members, spans, last, quorum, tasks).select("grp", "ballot", "date", "participation", "coherence", "majority"))
    means = group.groupBy("grp").agg(F.avg("participation").alias("mean_participation"), F.avg("coherence").alias("mean_coherence"))
    days = group.where("date is not null").groupBy("grp", "date").agg(F.count("*").alias("n"))
    order = Window.partitionBy("grp").orderBy("date")
    upto = days.select("grp", "date", F.sum("n").over(order).alias("upto"))
    # Ballots of a group inside a span: ballots up to its end less those before its start, each found as of a date.
    merged = islands(spans, ["member"], "first", "last")
    placed = members.join(merged, "member", "left").withColumn("last", F.coalesce("last", F.lit("9999-12-31").cast("date"))).withColumn("first", F.coalesce("first", F.lit("0001-01-01").cast("date")))
    marks = placed.select("grp", "member", F.col("last").alias("date"), F.lit(1).alias("sign")).union(placed.select("grp", "member", F.date_sub("first", 1).alias("date"), F.lit(-1).alias("sign")))
    # Marks fall on few dates, however many members a group has, so the window runs over distinct dates. Of a date's rows
    # the ballots come first, so a mark sees all up to its own day.
    asked = marks.select("grp", "date").distinct().select("grp", "date", F.lit(None).cast("long").alias("upto"), F.lit(1).alias("kind"))
    seen = asked.union(upto.select("grp", "date", "upto", F.lit(0)))
    filled = seen.withColumn("upto", F.coalesce(F.last("upto", True).over(Window.partitionBy("grp").orderBy("date", "kind").rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)))
    reached = filled.where("kind = 1").select("grp", "date", "upto")
    eligible = marks.join(reached, ["grp", "date"]).groupBy("grp", "member").agg(F.sum(F.col("sign") * F.col("upto")).cast("long").alias("n_ballots"))
    own = last.where("allowed").join(group.select("grp", "ballot", "majority"), ["grp", "ballot"])
    own = own.groupBy("grp", "member").agg(F.count_if(F.col("position").isin(*CHOICES)).alias("n_present"), F.count_if(F.col("position") == F.col("majority")).alias("n_aligned"))
    rows = eligible.join(own, ["grp", "member"], "left").fillna(0, ["n_present", "n_aligned"]).join(means, "grp")
    rows = rows.withColumns({"participation": rate(F.col("n_present"), F.col("n_ballots")), "coherence": rate(F.col("n_aligned"), F.col("n_ballots"))})
    return rows.select(
        "grp", "member", "n_ballots", "n_present", "n_aligned", "participation", "coherence",
        F.round(F.col("participation") - F.col("mean_participation"), 4).alias("participation_gap"), F.round(F.col("coherence") - F.col("mean_coherence"), 4).alias("coherence_gap"),
    )
