"""Documents linked by the Jaccard similarity of their shingles: token-combination prefixes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut
from tidemark.llm.shingles import (
    DOC,
    NO_ID,
    TEXT_HASH,
    TOKEN_BITS,
    Comparison,
    Plan,
    classes_of,
    few_apart,
    keyed,
    may_reach,
    named,
    not_too_many_own,
    prefix_length,
    signature_rows,
    signature_units,
    with_key,
)
from tidemark.llm.tokens import U64, mix

#: Size groups: neighbours differ by this factor, which no two similar sets exceed twice over.
GROUP_STEP = 1.25
SMALL = 8
#: Different classes that one round draws from signatures of the same classes.
HUB_DRAWS = 4
#: 64-bit words of parities that a class carries into the last round; 1,024 bits part sets of up to some 2,000 tokens.
MARKS = 16


def combination_prefixes(percent: int, frequent_bits: int):
    """The signatures of sets: rare tokens of the extended prefix, and pairs of its frequent tokens.

    Tokens are sorted from rare to frequent. If the prefix of each set is ``m`` tokens longer than the plain one, two
    similar sets have m + 1 tokens of it in common. Either one of those is rare: it is indexed alone. Or all
    are frequent: of m classes, made by a hash, two fall into one class, and pairs within a class are indexed.
    m grows with the set (an eighth of its prefix), so a set has a few pairs for each frequent token, and
    it is taken from a size group that both sets share: each set is indexed under its own group and the one
    below. Sets too small to have m + 1 tokens in common for sure, and their partners, index every token alone as well.

    The place of a single token is its place in the set's order. If two similar sets share any rare token, the
    first one that they share is rare. Otherwise two of their first m + 1 common tokens make a shared pair, whose first
    token has at most m - 1 common ones before it: a pair's place is that token's place less m - 1.
    """
    if percent < 50:
        raise ValueError("percent is at least 50")
    step = np.log(max(GROUP_STEP, 100 / percent))

    def extension(group: np.ndarray) -> np.ndarray:
        nominal = np.exp(np.maximum(group, 0) * step) * (100 - percent) / 100
        return np.maximum(1, (nominal / 8).astype(np.int64))

    def signatures(tokens: np.ndarray, sizes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        full = np.flatnonzero(sizes)
        units = np.repeat(full, sizes[full])
        place = np.arange(len(tokens)) - offsets[units]
        group = np.floor(np.log(np.maximum(1, sizes)) / step + 1e-9).astype(np.int64)
        plain = prefix_length(sizes, percent)
        most = np.minimum(plain + extension(group), sizes)
        inside = place < most[units]
        tokens, units, place = tokens[inside], units[inside], place[inside]
        rare = (tokens >> U64(TOKEN_BITS)) < U64(frequent_bits)
        tokens = tokens & U64((1 << TOKEN_BITS) - 1)
        alone = rare | (sizes[units] <= SMALL)
        found = [(units[alone], mix(tokens[alone], 5), place[alone], rare[alone])]
        tokens, units, place = tokens[~rare], units[~rare], place[~rare]
        for below in (0, 1):
            m = extension(group - below)
            fits = place < np.minimum(plain + m, sizes)[units]
            t, u, p = tokens[fits], units[fits], place[fits]
            cls = (mix(t, 6) % m[u].astype(U64)).astype(np.int64)
            order = np.lexsort((p, cls, u))
            t, u, p, cls = t[order], u[order], p[order], cls[order]
            for ahead in range(1, len(t)):
                same = (u[ahead:] == u[:-ahead]) & (cls[ahead:] == cls[:-ahead])
                if not same.any():
                    break
                first, second = np.flatnonzero(same), np.flatnonzero(same) + ahead
                pair = mix(t[first], 7) + mix(t[second], 8) + (group[u[first]] - below + 2).astype(U64) * U64(0x9E3779B97F4A7C15)
                found.append((u[first], mix(pair, 9), np.maximum(0, p[first] - m[u[first]] + 1), np.zeros(len(first), bool)))
        # Signatures show a prefix token by token only if none of its tokens is frequent.
        shown = most.copy()
        shown[units] = 0
        unit, sig, place, single = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(unit, kind="stable")
        return unit[order], sig[order], place[order], shown, single[order]

    return signatures


def merged_labels(edges: DataFrame) -> DataFrame:
    """(label, smaller) for ``edges`` (x, y) between labels: the smallest label of the component of each.

    Labels pass along edges in both directions and then jump to the label of their label, until nothing changes.
    """
    both = cut(edges.select("x", "y").unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct())
    known = cut(both.groupBy("x").agg(F.min(F.least("x", "y")).alias("smaller")).withColumnRenamed("x", "label"))
    while True:
        heard = both.join(known.withColumnRenamed("label", "y"), "y").groupBy(F.col("x").alias("label")).agg(F.min("smaller").alias("heard"))
        nearer = cut(known.join(heard, "label").select("label", F.least("smaller", "heard").alias("now"), "smaller"))
        jump = nearer.select(F.col("label").alias("now"), F.col("now").alias("further"))
        after = cut(
            nearer.join(jump, "now", "left").select("label", F.coalesce("further", "now").alias("now"), "smaller")
        )
        settled = after.filter("now != smaller").isEmpty()
        known = after.select("label", F.col("now").alias("smaller"))
        if settled:
            return known


def blocks(rows: DataFrame) -> DataFrame:
    """``rows`` with (block, merged) for sig: classes that share a signature share a block, in fewer pairs if signatures overlap.

    Near copies that are not similar enough share hundreds of signatures, and would meet under each. The signatures that have the same
    class as their first one, by a hash, are merged if all their classes together make fewer pairs than the
    signatures do one by one. A class then stands at the smallest of its places: that weakens the positional filter and loses nothing.
    """
    sigs = rows.groupBy("sig").agg(F.min(F.xxhash64("cid")).alias("block"), F.count("*").alias("c"))
    apart = sigs.groupBy("block").agg(F.sum(F.col("c") * F.col("c")).alias("apart"))
    dealt = rows.join(sigs.select("sig", "block"), "sig")
    own = [c for c in rows.columns if c not in ("sig", "place")]
    together = cut(dealt.groupBy("block", *own).agg(F.min("place").alias("place")))
    merged = cut(
        together.groupBy("block").agg(F.count("*").alias("c")).join(apart, "block").filter(F.col("c") * F.col("c") < F.col("apart")).select("block")
    )
    alone = dealt.join(merged, "block", "left_anti").withColumn("block", F.col("sig")).withColumn("merged", F.lit(False))
    joined = together.join(merged, "block").withColumn("merged", F.lit(True))
    columns = ["block", "merged", *own, "place"]
    return alone.select(columns).unionByName(joined.select(columns))


def link_classes(rows: DataFrame, compare: Comparison, star_rounds: int) -> DataFrame | None:
    """(cid, label) of the classes that are linked to another; None without any link.

    ``rows``: sig, cid, n, place, own. In a star round one class of each signature is compared with the signature's other
    classes and then leaves it, so work follows the rows. It is drawn by one of ``HUB_DRAWS`` hashes, so that signatures
    of the same classes draw some different ones. Classes that are already connected are not compared again, and a signature whose classes are all connected is done. After
    ``star_rounds`` what is left is dealt to blocks and compared in pairs of which at least one class has few enough tokens of its own (a
    signature without such a class is done) and whose parities differ in few enough bits.
    """
    percent = compare.plan.percent
    rows = rows.withColumn("light", 100 * (F.col("n") - F.col("own")) >= percent * F.col("n"))
    labels = tested = None
    for turn in range(star_rounds + 1):
        if labels is not None:
            rows = rows.drop("label").join(labels, "cid", "left").withColumn("label", F.coalesce("label", "cid"))
        else:
            rows = rows.withColumn("label", F.col("cid"))
        hubs = rows.groupBy("sig").agg(
            F.min_by(F.struct("cid", "n", "place", "own", "label"), F.xxhash64(F.pmod(F.xxhash64("sig"), F.lit(HUB_DRAWS)), "cid")).alias("hub"),
            F.min("label").alias("low"),
            F.max("label").alias("high"),
            F.max("light").alias("any"),
        )
        rows = cut(rows.join(hubs.filter("low != high and any").drop("low", "high", "any"), "sig"))
        if rows.isEmpty():
            break
        names = {"cid": "b", "n": "n_b", "place": "place_b", "own": "own_b", "label": "label_b", "light": "light_b"}
        right = [F.col(c).alias(n) for c, n in names.items()]
        if turn < star_rounds:
            hub = {"cid": "a", "n": "n_a", "place": "place_a", "own": "own_a", "label": "label_a"}
            met = rows.select(*[F.col(f"hub.{c}").alias(n) for c, n in hub.items()], *right)
        else:
            marked = blocks(rows.drop("hub")).join(compare.classes.select("cid", "marks"), "cid")
            left = marked.filter("light").select("block", "merged", *[F.col(c).alias({"cid": "a"}.get(c, f"{c}_a")) for c in [*names, "marks"]])
            met = left.join(marked.select("block", "merged", *right, F.col("marks").alias("marks_b")), ["block", "merged"]).filter("a < b or not light_b")
            met = met.filter(few_apart(percent, "n_a", "marks_a", "n_b", "marks_b", compare.plan.marks))
        first = F.col("a") < F.col("b")
        pairs = (
            met.filter((F.col("label_a") != F.col("label_b")) & (F.col("a") != F.col("b")))
            .filter(may_reach(percent, "n_a", "place_a", "n_b", "place_b") & not_too_many_own(percent, "n_a", "own_a", "n_b", "own_b"))
            .select(
                F.least("a", "b").alias("a"),
                F.greatest("a", "b").alias("b"),
                F.when(first, F.col("label_a")).otherwise(F.col("label_b")).alias("label_a"),
                F.when(first, F.col("label_b")).otherwise(F.col("label_a")).alias("label_b"),
            )
            .distinct()
        )
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = cut(pairs)
        links = compare.links(pairs.select("a", "b"))
        if not links.isEmpty():
            edges = links.join(pairs, ["a", "b"]).select(F.col("label_a").alias("x"), F.col("label_b").alias("y"))
            moved = merged_labels(edges)
            if labels is None:
                labels = cut(moved.select(F.col("label").alias("cid"), F.col("smaller").alias("label")))
            else:
                # labels that moved, and classes that were alone until now
                kept = labels.join(moved, "label", "left").select("cid", F.coalesce("smaller", "label").alias("label"))
                new = moved.join(labels.select(F.col("cid").alias("label")), "label", "left_anti")
                labels = cut(kept.unionByName(new.select(F.col("label").alias("cid"), F.col("smaller").alias("label"))))
        seen = pairs.select("a", "b")
        tested = seen if tested is None else tested.unionByName(seen)
        rows = rows.filter(F.col("cid") != F.col("hub.cid")).drop("hub")
    return labels


def linked_documents(
    docs: DataFrame,
    percent: int = 80,
    k: int = 5,
    frequent_bits: int = 5,
    star_rounds: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc, text_hash, n_shingles, component (smallest doc reachable by links; NO_ID for null), component_hash.

    ``component_hash`` is the text_hash of that document, the smallest one if several have its identifier: with repeated or
    null identifiers, only both together name one document of the group.

    Two documents are linked if the union of their sets of ``k``-word shingles has ``percent`` % of its shingles
    in common. Documents with equal sets are one class from the start. Texts without words have no shingles
    and no links, those of fewer than ``k`` words have one shingle. Null text is empty, a null identifier counts as larger than
    any other, repeated rows are linked by their equal sets. No rows give no rows; other columns are ignored.

    ``frequent_bits``: tokens whose count has at least that many bits are indexed in pairs. It moves work, never results.
    """
    source = keyed(docs, id_col, text_col)
    plan = Plan(k, percent, marks=MARKS)
    units = signature_units(source, plan, combination_prefixes(percent, frequent_bits), all_units=True)
    classes = classes_of(units)
    repeated = not units.groupBy("doc", "text_hash").count().filter("count > 1").isEmpty()
    labels = link_classes(signature_rows(classes, "own"), Comparison(source, classes, plan, repeated), star_rounds)
    parts = classes.select("cid", "class", F.struct("first.doc", "first.text_hash").alias("lowest"))
    if labels is not None:
        parts = parts.join(labels, "cid", "left").withColumn("label", F.coalesce("label", "cid"))
        lowest = parts.groupBy("label").agg(F.min("lowest").alias("lowest"))
        parts = parts.select("class", "label").join(lowest, "label").select("class", "lowest")
    else:
        parts = parts.select("class", "lowest")
    return units.select("doc", "text_hash", F.col("n").cast("long").alias("n_shingles"), "class").join(
        parts, "class", "left"
    ).select(
        "doc",
        "text_hash",
        "n_shingles",
        F.coalesce("lowest.doc", "doc").alias("component"),
        F.coalesce("lowest.text_hash", "text_hash").alias("component_hash"),
    )


def ngram_components(docs: DataFrame, percent: int = 80, k: int = 5, **options) -> DataFrame:
    """doc_id, n_shingles, component_id of every row; see linked_documents."""
    found = linked_documents(docs, percent, k, **options)
    return found.select(
        F.nullif("doc", F.lit(NO_ID)).alias("doc_id"), "n_shingles", F.nullif("component", F.lit(NO_ID)).alias("component_id")
    )


def one_of_each(docs: DataFrame, percent: int = 80, k: int = 5, **options) -> DataFrame:
    """The rows of ``docs``, all columns, without near duplicates: of each component the smallest doc_id stays.

    Of several documents of a component with that identifier, or all without one, the smallest hash of the text decides. Documents without words stay. Of rows that repeat identifier and text one stays.
    """
    found = linked_documents(docs, percent, k, **options)
    gone = found.filter("n_shingles > 0 and (doc != component or text_hash != component_hash)").select("doc", "text_hash").distinct()
    kept = with_key(docs).join(named(gone), [DOC, TEXT_HASH], "left_anti")
    if not found.groupBy("doc", "text_hash").count().filter("count > 1").isEmpty():
        kept = kept.dropDuplicates([DOC, TEXT_HASH])
    return kept.select(*docs.columns)
