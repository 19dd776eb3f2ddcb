"""Shards of equal size that keep linked documents together: balanced label propagation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ROW, cut, ranked, texts_of


def balanced_labels(members: DataFrame, n_rows: int, n_shards: int, rounds: int) -> DataFrame:
    """(__row, label) of the linked documents; ``members`` is cut: (__row, link), a row for each link of a document.

    Labels start from a hash of the first link, so that a small group starts together. In each round a
    document wants the label that most of its neighbours have, if that is more than share its own now, or as
    many and the label is smaller (this breaks circles). No shard may hold more linked documents than its quota:
    of those who want in, the ones with the largest gain get the free places. What a link holds is summed to one row of counts
    before it meets its members, so nothing is emitted for pairs of neighbours.
    """
    quota = [n_rows // n_shards + (s < n_rows % n_shards) for s in range(n_shards)]
    first = members.groupBy(ROW).agg(F.min("link").alias("link"))
    start = first.select(ROW, F.pmod(F.xxhash64("link"), F.lit(n_shards)).cast("int").alias("label"), F.lit(0).alias("gain"))
    labels = cut(_within_quota(cut(start), quota, None))
    for _ in range(rounds):
        counts = (
            members.join(labels, ROW)
            .groupBy("link")
            .agg(*[F.sum((F.col("label") == s).cast("long")).alias(f"n{s}") for s in range(n_shards)])
        )
        pulls = (
            members.join(counts, "link")
            .groupBy(ROW)
            .agg(*[F.sum(f"n{s}").alias(f"n{s}") for s in range(n_shards)])
            .join(labels, ROW)
        )
        held = {r["label"]: r["count"] for r in labels.groupBy("label").count().collect()}
        free = [quota[s] - held.get(s, 0) for s in range(n_shards)]
        scores = F.array(*[F.struct(F.col(f"n{s}").alias("n"), F.lit(-s).alias("minus")) for s in range(n_shards) if free[s] > 0])
        if not any(f > 0 for f in free):
            break
        here = F.element_at(F.array(*[F.col(f"n{s}") for s in range(n_shards)]), F.col("label") + 1)
        wants = cut(
            pulls.withColumn("best", F.array_max(scores))
            .withColumn("here", here)
            .filter((F.struct(F.col("best.n"), F.col("best.minus")) > F.struct(F.col("here"), -F.col("label"))))
            .select(ROW, (-F.col("best.minus")).cast("int").alias("label"), (F.col("best.n") - F.col("here") + 1).alias("gain"))
        )
        moves = _within_quota(wants, free, labels)
        moved = cut(moves)
        if moved.isEmpty():
            break
        labels = cut(
            labels.join(moved.select(ROW, F.col("label").alias("to")), ROW, "left").select(
                ROW, F.coalesce("to", "label").alias("label")
            )
        )
    return labels


def _within_quota(wants: DataFrame, quota: list[int], placed: DataFrame | None) -> DataFrame:
    """The rows of ``wants`` (__row, label, gain; cut) that get a place; without ``placed`` all others go where room is left."""
    spark = wants.sparkSession
    # Gains are met whole levels at a time; inside the level that a quota cuts, ranks decide.
    levels = wants.groupBy("label", F.floor(F.log2(F.col("gain") + 1)).alias("level")).agg(F.count("*").alias("n"))
    above = Window.partitionBy("label").orderBy(F.col("level").desc()).rowsBetween(Window.unboundedPreceding, -1)
    bounds = levels.withColumn("before", F.coalesce(F.sum("n").over(above), F.lit(0))).drop("n")
    places = spark.createDataFrame([(s, q) for s, q in enumerate(quota)], "label int, quota long")
    ranks = ranked(wants.withColumn("level", F.floor(F.log2(F.col("gain") + 1))), ["label", "level"], [ROW], "rank")
    judged = (
        ranks.join(bounds, ["label", "level"])
        .join(F.broadcast(places), "label")
        .withColumn("fits", F.col("rank") + F.col("before") < F.col("quota"))
    )
    if placed is not None:
        return judged.filter("fits").select(ROW, "label")
    judged = cut(judged.select(ROW, "label", "fits"))
    held = {r["label"]: r["count"] for r in judged.filter("fits").groupBy("label").count().collect()}
    rest = [q - held.get(s, 0) for s, q in enumerate(quota)]
    return judged.filter("fits").select(ROW, "label").unionByName(fill(judged.filter(~F.col("fits")).select(ROW), rest))


def fill(rows: DataFrame, room: list[int]) -> DataFrame:
    """(__row, label): ``rows`` (cut: __row) dealt to labels by rank until each one's ``room`` is used."""
    ranks = ranked(rows.withColumn("__all", F.lit(0)), ["__all"], [ROW], "rank")
    ends, end = [], 0
    for places in room:
        end += max(0, places)
        ends.append(end)
    # Places of a label end where those of the next begin: a binary search in a constant array, however many labels.
    table = F.array(*[F.lit(e).cast("long") for e in ends])
    powers = F.array(*[F.lit(1 << i) for i in reversed(range(len(ends).bit_length()))])
    label = F.aggregate(powers, F.lit(0), lambda at, p: F.when(F.get(table, at + p - 1) <= F.col("rank"), at + p).otherwise(at))
    return ranks.select(ROW, label.alias("label"))


def shard_documents(
    docs: DataFrame, n_shards: int = 24, rounds: int = 6, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: shards whose row counts differ by one at most.

    Documents with equal texts are linked; those without a link fill what the linked ones leave. A group
    larger than a shard goes to as few shards as the quotas allow. ``slot`` numbers a shard's rows from 0.
    Null and empty texts are one group of size 8 each. Rows are placed one by one, so repeated rows and null
    identifiers have places of their own; no rows give no rows; other columns are ignored.
    """
    text = F.col("text")
    rows = cut(
        texts_of(docs, id_col, text_col).select(
            "doc_id",
            ROW,
            (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.unhex(F.sha2(text, 256)).alias("link"),
        )
    )
    n = rows.count()
    groups = rows.groupBy("link").agg(F.count("*").alias("n")).filter("n > 1").select("link")
    members = cut(rows.select(ROW, "link").join(groups, "link"))
    linked = balanced_labels(members, n, n_shards, rounds)
    held = {r["label"]: r["count"] for r in linked.groupBy("label").count().collect()}
    room = [n // n_shards + (s < n % n_shards) - held.get(s, 0) for s in range(n_shards)]
    single = cut(rows.select(ROW).join(linked.select(ROW), ROW, "left_anti"))
    labels = cut(linked.unionByName(fill(single, room)))
    placed = cut(rows.drop("link").join(labels.withColumnRenamed("label", "shard"), ROW))
    return ranked(placed, ["shard"], [ROW], "slot").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int"),
        F.col("slot").cast("long"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
