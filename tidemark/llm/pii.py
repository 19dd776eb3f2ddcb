"""Personal data in texts: generators propose spans, boosted trees weigh them, thresholds select. DataFrame functions only."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ROW, cut, texts_of
from tidemark.llm.shingles import DOC, NO_ID, TEXT_HASH, named, with_key

KINDS = ["email", "ip", "card", "phone"]

#: The base patterns, in the order of KINDS. They find what the plain forms
#:   [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+    [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#:   [0-9]([\x20-]?[0-9])+                                \+[0-9][\x20().0-9-]+[0-9]
#: find, leftmost and without overlap. No quantifier has to give back what it took, so possessive ones are the
#: same and need no stack; a match begins where a run of its characters does, or right after the match before (\G), so
#: a run of any length is looked at once.
BASE_PATTERNS = [
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    r"[0-9](?:[\x20-]?[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]
#: Looser forms: (kind, pattern). Bounded repetitions; what they propose overlaps the base spans and each other.
LOOSE_PATTERNS = [
    (
        "email",
        r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}+\x20?(?:@|\(at\)|\[at\]|\{at\})\x20?[a-z0-9-]{1,63}+"
        r"(?:\x20?(?:\.|\(dot\)|\[dot\]|\{dot\})\x20?[a-z0-9-]{1,63}+){1,8}+",
    ),
    ("card", r"(?<![0-9.])[0-9](?:[\x20./_-]?[0-9]){12,18}+(?![0-9])"),
    ("phone", r"(?<![0-9.+])\(?[0-9]{2,4}+\)?[\x20./-][0-9]{3,4}+[\x20./-][0-9]{3,4}+(?![0-9])"),
    ("phone", r"(?<![0-9.+])00[1-9][\x20().0-9-]{6,24}[0-9]"),
]
#: Words that announce a kind, among the characters before a span.
CUES = {
    "email": "mail|contact|write|reach",
    "ip": r"\bip\b|address|host|server",
    "card": "card|visa|credit|debit|payment|account",
    "phone": "phone|tel|call|mobile|cell|fax|contact",
}
FEATURES = ["kind", "valid", "digits", "separator", "mark", "before", "after", "cue"]
#: Least numbers of digits of the groups that ``digits`` counts up.
DIGIT_STEPS = (1, 7, 8, 10, 12, 16, 17)
CONTEXT = 32
PROPOSAL = "array<struct<pattern int, match string, gap int, pre string, post string>>"


def _matches(text: Column, number: int, pattern: str) -> Column:
    """The matches of a pattern with the lengths and ends of the text between them."""
    gaps = F.split(text, pattern, -1)
    behind = F.slice(gaps, 2, F.size(gaps) - 1)
    each = F.zip_with(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.slice(gaps, 1, F.size(gaps) - 1), lambda m, gap: F.struct(m.alias("match"), gap.alias("gap")))
    return F.zip_with(
        each,
        behind,
        lambda e, post: F.struct(
            F.lit(number).alias("pattern"),
            e["match"].alias("match"),
            F.char_length(e["gap"]).alias("gap"),
            F.right(e["gap"], F.lit(CONTEXT)).alias("pre"),
            F.left(post, F.lit(1)).alias("post"),
        ),
    )


def proposals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(__row, doc_id, text_hash, found), cut: what each pattern matches in each text, in order, with the text between matches as a length and its ends."""
    text = F.col("text")
    patterns = [*BASE_PATTERNS, *[p for _, p in LOOSE_PATTERNS]]
    found = [
        F.when(F.regexp_like(text, F.lit(p)), _matches(text, number, p).cast(PROPOSAL)).otherwise(F.array().cast(PROPOSAL))
        for number, p in enumerate(patterns)
    ]
    return cut(texts_of(docs, id_col, text_col).select(ROW, "doc_id", F.xxhash64(text).alias("text_hash"), F.concat(*found).alias("found")))


def placed(found: DataFrame) -> DataFrame:
    """A row per proposal: __row, doc_id, pattern, kind (0 to 3), start, end (code points, end exclusive), match, pre, post, base."""
    rows = found.filter(F.size("found") > 0).select(ROW, "doc_id", F.posexplode("found").alias("i", "p")).select(ROW, "doc_id", "i", "p.*")
    before = Window.partitionBy(ROW, "pattern").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.char_length("match")
    kind = F.element_at(F.array(*[F.lit(k) for k in range(len(KINDS))], *[F.lit(KINDS.index(k)) for k, _ in LOOSE_PATTERNS]), F.col("pattern") + 1)
    ended = rows.withColumn("end", F.sum(F.col("gap") + size).over(before))
    spans = ended.select(ROW, "doc_id", "pattern", kind.alias("kind"), (F.col("end") - size).alias("start"), "end", "match", "pre", "post")
    return spans.withColumn("base", (F.col("pattern") < len(KINDS)) & checked(F.col("kind"), F.col("match")))


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def checked(kind: Column, match: Column) -> Column:
    """The base checks: parts of an address, Luhn and length of a card, length of a number."""
    digits, n = digits_of(match), F.char_length(digits_of(match))
    parts = F.forall(F.split(match, r"\."), lambda p: F.regexp_like(p, F.lit("^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})$")))
    card = n.between(16, 19) & F.call_function("luhn_check", F.when(n.between(16, 19), digits).otherwise(F.lit("1")))
    return F.when(kind == 0, True).when(kind == 1, parts).when(kind == 2, card).otherwise(n.between(8, 15))


def with_features(spans: DataFrame) -> DataFrame:
    """``spans`` (kind, match, pre, post) with FEATURES: small whole numbers of the form and of what stands around it."""
    match, kind = F.col("match"), F.col("kind")
    n = F.char_length(digits_of(match))
    plain = F.regexp_replace(match, r"[0-9A-Za-z]", "")
    separators = [F.contains(plain, F.lit(c)).cast("int") for c in (" ", "-", ".")]
    one = F.when(separators[0] == 1, 1).when(separators[1] == 1, 2).when(separators[2] == 1, 3).otherwise(0)
    form = F.when(kind == 0, F.regexp_like(match, F.lit(r"(?i)\.[a-z]{2,}$|dot[\])}]\x20?[a-z]{2,}$")))
    valid = form.when(kind == 2, F.call_function("luhn_check", F.when(n.between(1, 30), digits_of(match)).otherwise(F.lit("1")))).otherwise(
        checked(kind, match)
    )
    cue = F.lit(False)
    for k, name in enumerate(KINDS):
        cue = cue | ((kind == k) & F.regexp_like(F.lower("pre"), F.lit(CUES[name])))

    def around(text: Column) -> Column:
        return (
            F.when(F.regexp_like(text, F.lit(r"^\s?$")), 0).when(F.regexp_like(text, F.lit(r"^\p{L}$")), 1).when(F.regexp_like(text, F.lit("^[0-9]$")), 2).otherwise(3)
        )

    return spans.withColumns(
        {
            "valid": F.coalesce(valid, F.lit(False)).cast("int"),
            "digits": sum(((n >= least).cast("int") for least in DIGIT_STEPS), F.lit(0)),
            "separator": F.when(separators[0] + separators[1] + separators[2] > 1, 4).otherwise(one),
            "mark": F.when(F.startswith(match, F.lit("+")), 1)
            .when(F.regexp_like(match, F.lit(r"(?i)[(\[{](?:at|dot)[)\]}]")), 3)
            .when(F.contains(match, F.lit("(")), 2)
            .otherwise(0),
            "before": around(F.right("pre", F.lit(1))),
            "after": around(F.col("post")),
            "cue": cue.cast("int"),
        }
    )


def variants(kind: Column, match: Column) -> Column:
    """A base span as it stands and in the looser forms in which the same data is written."""
    none = F.array().cast("array<string>")
    loose = (
        F.when(kind == 0, F.array(F.replace(match, F.lit("@"), F.lit(" (at) ")), F.replace(match, F.lit("@"), F.lit("[at]")), F.replace(match, F.lit("@"), F.lit(" @ "))))
        .when(kind == 2, F.array(F.regexp_replace(digits_of(match), "([0-9]{4})(?=[0-9])", "$1."), F.regexp_replace(digits_of(match), "([0-9]{4})(?=[0-9])", "$1/")))
        .when(kind == 3, F.array(F.concat(F.lit("00"), F.substring(match, 2, 1 << 20)), F.regexp_extract(match, r"(\(?[0-9]{2,4}\)?[ ./-][0-9]{3,4}[ ./-][0-9]{3,4})$", 1)))
        .otherwise(none)
    )
    return F.concat(F.array(match), F.filter(loose, lambda v: v != ""))


Tree = float | tuple[int, int, "Tree", "Tree"]


@dataclass(frozen=True)
class Model:
    """Boosted trees over FEATURES: (feature, cut, tree up to the cut, tree above) or a leaf; thresholds by kind, None where nothing is added."""

    start: float
    trees: tuple[Tree, ...]
    thresholds: tuple[float | None, ...]

    def score(self) -> Column:
        def column(tree: Tree) -> Column:
            if not isinstance(tree, tuple):
                return F.lit(float(tree))
            feature, at, low, high = tree
            return F.when(F.col(FEATURES[feature]) <= at, column(low)).otherwise(column(high))

        return sum((column(t) for t in self.trees), F.lit(self.start))

    def selected(self) -> Column:
        """Whether a proposal reaches the threshold of its kind."""
        chosen = F.lit(False)
        for kind, threshold in enumerate(self.thresholds):
            if threshold is not None:
                chosen = chosen | ((F.col("kind") == kind) & (self.score() >= threshold))
        return chosen


def evaluated(tree: Tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), float(tree))
    feature, at, low, high = tree
    return np.where(x[:, feature] <= at, evaluated(low, x), evaluated(high, x))


def grown(x: np.ndarray, slope: np.ndarray, curve: np.ndarray, depth: int, rate: float, ridge: float = 1.0) -> Tree:
    """A regression tree on the first and second derivatives of the loss."""
    total, weight = slope.sum(), curve.sum()
    best = None
    if depth:
        for feature in range(x.shape[1]):
            for at in np.unique(x[:, feature])[:-1].tolist():
                left = x[:, feature] <= at
                a, b = slope[left].sum(), curve[left].sum()
                gain = a * a / (b + ridge) + (total - a) ** 2 / (weight - b + ridge) - total * total / (weight + ridge)
                if gain > 1e-9 and (best is None or gain > best[0]):
                    best = gain, feature, at, left
    if best is None:
        return -rate * total / (weight + ridge)
    _, feature, at, left = best
    return feature, at, grown(x[left], slope[left], curve[left], depth - 1, rate), grown(x[~left], slope[~left], curve[~left], depth - 1, rate)


def boosted(x: np.ndarray, good: np.ndarray, bad: np.ndarray, rounds: int = 30, depth: int = 3, rate: float = 0.3) -> tuple[float, tuple[Tree, ...]]:
    """Trees fitted to weighted rows by logistic loss."""
    start = math.log((good.sum() + 1) / (bad.sum() + 1))
    margin, trees = np.full(len(x), start), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        tree = grown(x, (good + bad) * p - good, (good + bad) * p * (1 - p), depth, rate)
        margin += evaluated(tree, x)
        trees.append(tree)
    return start, tuple(trees)


def calibrated(margin: np.ndarray, x: np.ndarray, good: np.ndarray, bad: np.ndarray, precision: float, support: int) -> tuple[float | None, ...]:
    """For each kind the lowest score whose calibrated share of good held-out weight is ``precision`` or more; None without ``support`` good ones.

    Calibration is isotonic: neighbouring scores are pooled until the share of good ones rises with the score.
    """
    out = []
    for kind in range(len(KINDS)):
        of = x[:, 0] == kind
        pools: list[list[float]] = []  # lowest score, good, all
        for at in np.unique(margin[of]).tolist():
            here = of & (margin == at)
            pools.append([at, good[here].sum(), (good + bad)[here].sum()])
            while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
                _, right, all_ = pools.pop()
                pools[-1][1] += right
                pools[-1][2] += all_
        fits = [p for p in pools if p[1] >= precision * p[2]]
        out.append(fits[0][0] - 1e-9 if sum(p[1] for p in fits) >= support else None)
    return tuple(out)


def training_cells(spans: DataFrame) -> DataFrame:
    """(FEATURES, held, good, bad): all proposals of the corpus, counted by their features; at most some 40,000 rows twice.

    Good are base spans, as they stand and in looser forms; bad are proposals of which no character lies in a base
    span. ``held`` marks the documents (a fifth, by hash) that calibrate and are not learned from.
    """
    held = (F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(5)) == 0).alias("held")
    good = spans.filter("base").select("kind", held, F.explode(variants(F.col("kind"), F.col("match"))).alias("match"), "pre", "post", F.lit(1).alias("label"))
    bad = spans.filter("not base and not touches").select("kind", held, "match", "pre", "post", F.lit(0).alias("label"))
    counted = with_features(good.unionByName(bad)).groupBy(*FEATURES, "held")
    return counted.agg(F.sum("label").alias("good"), F.sum(1 - F.col("label")).alias("bad"))


def train(spans: DataFrame, precision: float = 0.8, support: int = 5) -> Model:
    """``spans``: see touching. Learns from counts over all proposals, which alone come to the driver."""
    rows = sorted(tuple(r) for r in training_cells(spans).collect())
    if not rows:
        return Model(0.0, (), (None,) * len(KINDS))
    table = np.array([[float(v) for v in r] for r in rows])
    x, held, good, bad = table[:, : len(FEATURES)].astype(np.int64), table[:, -3] > 0, table[:, -2], table[:, -1]
    start, trees = boosted(x[~held], good[~held], bad[~held])
    margin = start + sum((evaluated(t, x) for t in trees), np.zeros(len(x)))
    return Model(start, trees, calibrated(margin[held], x[held], good[held], bad[held], precision, support))


def touching(spans: DataFrame) -> DataFrame:
    """``spans`` with ``touches``: whether a base span of the same text shares a character with the row's span."""
    before = Window.partitionBy(ROW).orderBy("start", F.desc("base"), "end", "pattern")
    ends = F.max(F.when(F.col("base"), F.col("end"))).over(before.rowsBetween(Window.unboundedPreceding, -1))
    # The same order backwards: a frame that runs to the end would be computed anew for every row.
    behind = Window.partitionBy(ROW).orderBy(F.desc("start"), "base", F.desc("end"), F.desc("pattern"))
    starts = F.min(F.when(F.col("base"), F.col("start"))).over(behind.rowsBetween(Window.unboundedPreceding, -1))
    apart = (F.coalesce(ends, F.lit(0)) <= F.col("start")) & (F.coalesce(starts, F.col("end")) >= F.col("end"))
    return spans.withColumn("touches", ~apart)


def selected_spans(spans: DataFrame, model: Model) -> DataFrame:
    """(__row, kind, start, end, base): base spans, and proposals apart from them that the model selects.

    Of selected ones that overlap each other in a chain, the first stays.
    """
    base = spans.filter("base").select(ROW, "kind", "start", "end", "base")
    if not any(t is not None for t in model.thresholds):
        return base
    extra = with_features(spans.filter("not base and not touches")).filter(model.selected())
    earlier = Window.partitionBy(ROW).orderBy("start", F.desc("end"), "kind", "pattern").rowsBetween(Window.unboundedPreceding, -1)
    first = extra.withColumn("reach", F.max("end").over(earlier)).filter(F.coalesce("reach", F.lit(0)) <= F.col("start"))
    return base.unionByName(first.select(ROW, "kind", "start", "end", "base"))


def find_personal_data(docs: DataFrame, precision: float = 0.8, support: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans (``kind:start:end``, comma-joined), n_added: one row per row of ``docs``.

    Base spans: matches of BASE_PATTERNS, leftmost and without overlap in each kind, that pass the checks; they always stay. Generators of
    high recall (the base patterns and LOOSE_PATTERNS) propose more spans; trees boosted on form and context, learned from
    the corpus itself (see training_cells), score them, and those join in that reach their kind's threshold: the
    lowest score whose calibrated share of good held-out proposals is ``precision``, with ``support`` good ones at least.
    Looser forms that the corpus holds itself count as bad there, so a form that is mostly something else is not added.
    Without base spans nothing is learned and nothing added.

    Null and empty texts have no spans and the digest of nothing. Texts of any length are read whole; patterns need no
    stack and look at a run of characters once. Repeated rows each get their row; null identifiers stay null; no rows give no rows;
    other columns are ignored.
    """
    found = proposals(docs, id_col, text_col)
    spans = cut(touching(placed(found)))
    chosen = selected_spans(spans, train(spans, precision, support))
    name = F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("kind") + 1)
    listed = chosen.withColumn("span", F.struct("kind", "start", "end", F.concat_ws(":", name, "start", "end").alias("text")))
    told = lambda rows: F.array_join(F.transform(F.sort_array(rows), lambda s: s["text"]), ",")
    by_text = listed.groupBy(ROW).agg(
        *[F.sum((F.col("base") & (F.col("kind") == k)).cast("long")).alias(f"n_{kind}") for k, kind in enumerate(KINDS)],
        F.sum((~F.col("base")).cast("long")).alias("n_added"),
        told(F.collect_list(F.when(F.col("base"), F.col("span")))).alias("base"),
        told(F.collect_list("span")).alias("spans"),
    )
    counts = [F.coalesce(f"n_{kind}", F.lit(0)).alias(f"n_{kind}") for kind in KINDS]
    return (
        found.select(ROW, "doc_id")
        .join(by_text, ROW, "left")
        .select(
            "doc_id",
            *counts,
            F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
            F.coalesce("spans", F.lit("")).alias("spans"),
            F.coalesce("n_added", F.lit(0)).alias("n_added"),
        )
    )


def redact(docs: DataFrame, precision: float = 0.8, support: int = 5) -> DataFrame:
    """``docs``, all columns, with every span of find_personal_data in ``text`` replaced by its kind in angle brackets.

    Spans that overlap become one piece with the kinds of both. Texts without spans, null ones too, stay as they are.
    """
    found = proposals(docs)
    spans = cut(touching(placed(found)))
    chosen = selected_spans(spans, train(spans, precision, support))
    names = found.select(ROW, F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), "text_hash")
    earlier = Window.partitionBy(ROW).orderBy("start", F.desc("end"), "kind").rowsBetween(Window.unboundedPreceding, -1)
    apart = chosen.withColumn("reach", F.coalesce(F.max("end").over(earlier), F.lit(0))).filter(F.col("end") > F.col("reach"))
    tag = F.concat(F.lit("<"), F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("kind") + 1), F.lit(">"))
    piece = F.struct(F.greatest("start", "reach").cast("int").alias("start"), F.col("end").cast("int").alias("end"), tag.alias("tag"))
    listed = apart.groupBy(ROW).agg(F.sort_array(F.collect_list(piece)).alias("pieces")).join(names, ROW)
    known = listed.groupBy("doc", "text_hash").agg(F.first("pieces").alias("pieces"))
    marked = with_key(docs).join(named(known, "pieces"), [DOC, TEXT_HASH], "left")
    pieces = F.col("__tm_pieces")
    parts = F.transform(
        pieces,
        lambda p, i: F.concat(
            F.substring("text", F.when(i > 0, F.get(pieces, i - 1)["end"]).otherwise(0) + 1, p["start"] - F.when(i > 0, F.get(pieces, i - 1)["end"]).otherwise(0)),
            p["tag"],
        ),
    )
    text = F.concat(F.array_join(parts, ""), F.substring("text", F.element_at(pieces, -1)["end"] + 1, F.char_length("text")))
    return marked.withColumn("text", F.when(pieces.isNull(), F.col("text")).otherwise(text)).select(*docs.columns)
