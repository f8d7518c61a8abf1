"""Personal data: fixed rules, and spans that boosted trees select among high-recall candidates.

Four rules find email addresses, network addresses, payment cards and telephone numbers. Generators
propose more spans, which may overlap: groups of digits, addresses with a sign or word for "at",
handles, and groups of hexadecimal digits. Each candidate is described by discrete features of its
format and of the characters around it, without the mark that decides a rule (plus sign, the sign for "at", Luhn
digit, part range, top-level domain). Known positives are the candidates that meet a valid span of a rule and, for
the kinds that no rule finds, those with a cue such as "user" or "device" in the text just before; all others
are unlabelled, because a personal span that lacks its mark looks like them. Gradient-boosted trees of depth two estimate the
chance of a candidate to be a known positive. Where positives are known or not by chance, that is the chance to be
personal times the share of positives that are known, and this share is the mean chance of the known ones
(measured on every second document by hash, held out of the fit, for each generator; fewer than ``LEAST_HELD`` say
nothing and select nothing). Candidates whose chance, so corrected, is at least ``SURE`` are added where they
are clear of the rules' spans, of overlapping ones those of the first generator. The fit covers all documents; it needs only
how often each combination of features occurs with each label, and those combinations have a proven
bound.

The trees are columns, the matches are SQL functions, and text is read once; Spark runs no Python on
the executors. Patterns never repeat a scan from inside a run of characters they have passed, and
repeat groups without keeping ways back; a candidate's context is the gap before its match; spans of a
row meet in order of their place, by running maxima. So long texts cost linear time and no stack.

Null and empty texts have no spans. Spans are code points with the end exclusive. Repeated rows each
get their row.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailflow.llm.common import stored

# Fixed patterns of the rules, written so that a run is tried from its start, or from where the match
# before ended, only.
EMAIL = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
RULES = ("email", "ip", "card", "phone")

# Generators of candidates, by kind.
GENERATORS = {
    "number": r"[0-9](?:[\x20().-]{0,2}[0-9])++",
    "address": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++(?:@|\x20?[(\[]at[)\]]\x20?)[A-Za-z0-9.-]+",
    "handle": r"(?<![A-Za-z0-9._%+-])@[A-Za-z0-9_]{3,}",
    "device": r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){3,7}(?![0-9A-Fa-f:])",
}
CUES = r"(?i)(?:tel|phone|fax|mobil|call|mail|contact|card|visa|account|iban|ssn|addr|login|user|handle|follow|device|mac\b|host)"
AROUND = 24  # code points of context before a candidate

# Feature names with their numbers of values; the product bounds the combinations.
FEATURES = {"kind": 4, "digits": 7, "groups": 5, "letters": 3, "sign": 5, "before": 5, "after": 5, "lead": 5, "cue": 2}
AT = r"\x20?[(\[]at[)\]]\x20?"
CUED = ("handle", "device")  # kinds that no rule finds
TREES, RATE, LEAST_SHARE_OF_LEAF = 40, 0.3, 5.0
SURE, LEAST_HELD = 0.85, 10


#: Matches whose places are summed one after another; the sums of such blocks are added in turn, so
#: that a text with very many matches does not cost the square of their number.
BLOCK = 256


def spans_of(text: str, pattern: str, around: bool = False) -> Column:
    """[start, end, value] of every match in the text column, leftmost and non-overlapping.

    ``around`` adds the ``context`` in the gap before the match and the character ``next`` to it.
    """
    literal = pattern.replace("\\", "\\\\").replace("'", "\\'")
    kept = ", 'context', right(x.gap, " + str(AROUND) + "), 'next', x.next" if around else ""
    types = "start:int,end:int,value:string" + (",context:string,next:string" if around else "")
    hits = f"regexp_extract_all({text}, '{literal}', 0)"
    # The gap after the last match has none, so its place in the list of matches is null.
    pairs = f"""transform(array(split({text}, '{literal}', -1)), g ->
      zip_with(zip_with(g, {hits}, (a, h) -> named_struct('gap', a, 'hit', h)), slice(g, 2, size(g)),
        (p, b) -> named_struct('gap', p.gap, 'hit', p.hit, 'next', left(b, 1))))[0]"""
    span = f"named_struct('start', s.at + length(x.gap), 'end', s.at + length(x.gap) + length(x.hit), 'value', x.hit{kept})"
    blocks = f"""transform(array({pairs}), p -> transform(sequence(0, size(p) - 1, {BLOCK}), b -> aggregate(
      slice(p, b + 1, {BLOCK}), named_struct('at', 0, 'out', cast(array() AS array<struct<{types}>>)),
      (s, x) -> if(x.hit IS NULL, s, named_struct('at', s.at + length(x.gap) + length(x.hit), 'out', concat(s.out, array({span}))))
    )))[0]"""
    rest = ", 'context', y.context, 'next', y.next" if around else ""
    moved = f"transform(x.out, y -> named_struct('start', y.start + s.at, 'end', y.end + s.at, 'value', y.value{rest}))"
    return F.expr(
        f"""flatten(aggregate({blocks},
          named_struct('at', 0, 'out', cast(array() AS array<array<struct<{types}>>>)),
          (s, x) -> named_struct('at', s.at + x.at, 'out', concat(s.out, array({moved}))), s -> s.out))"""
    )


def _no_spans() -> Column:
    return F.expr("cast(array() AS array<struct<start:int,end:int,value:string>>)")


def _valid(kind: str, value: Column) -> Column:
    """Whether a match of a rule passes its check."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        part = lambda x: F.regexp_replace(x, "^0+", "")
        small = lambda x: (F.length(part(x)) < 3) | ((F.length(part(x)) == 3) & (part(x) <= "255"))
        return F.forall(F.split(value, "[.]"), small)
    if kind == "card":
        return F.length(digits).between(16, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def _passes(kind: str):
    return lambda span: _valid(kind, span["value"])


def _bucket(value: Column, *bounds: int) -> Column:
    """Number of bounds that the value reaches."""
    out = F.lit(0)
    for bound in bounds:
        out = out + (value >= bound).cast("int")
    return out


def _character(value: Column) -> Column:
    """Class of a character: none, blank, letter, digit, other; a plus sign counts as a blank."""
    return (
        F.when(value == "", 0)
        .when(value.rlike(r"[\s+]"), 1)
        .when(value.rlike(r"\p{L}"), 2)
        .when(value.rlike(r"[0-9]"), 3)
        .otherwise(4)
    )


def _lead(context: Column) -> Column:
    """Class of the last character before a candidate that is no blank, sign or bracket: none, letter, digit, colon or equals, other."""
    last = F.right(F.regexp_replace(context, r"[\s+(\[]+$", ""), F.lit(1))
    return F.when(last == "", 0).when(last.rlike(r"\p{L}"), 1).when(last.rlike("[0-9]"), 2).when(last.rlike("[:=]"), 3).otherwise(4)


def _described(kind: int, c: Column) -> Column:
    """A candidate with its features and whether a cue is before it."""
    value, context = F.regexp_replace(c["value"], AT, "@"), c["context"]
    digits = F.length(F.regexp_replace(value, "[^0-9]", ""))
    sign = F.when(value.contains("("), 4).when(value.contains("-"), 3).when(value.contains("."), 2).when(value.contains(" "), 1)
    features = {
        "kind": F.lit(kind),
        "digits": _bucket(digits, 1, 7, 10, 13, 16, 20),
        "groups": F.least(F.regexp_count(value, F.lit("[A-Za-z0-9]+")), F.lit(5)) - 1,
        "letters": _bucket(F.length(F.regexp_replace(value, "[^A-Za-z]", "")), 1, 6),
        "sign": F.coalesce(sign, F.lit(0)),
        "before": _character(F.right(context, F.lit(1))),
        "after": _character(c["next"]),
        "lead": _lead(context),
        # Where a cue makes the label, the trees must not see it.
        "cue": F.lit(0) if tuple(GENERATORS)[kind] in CUED else context.rlike(CUES),
    }
    numbers = [v.cast("int").alias(k) for k, v in features.items()]
    return F.struct(c["start"].alias("start"), c["end"].alias("end"), *numbers, context.rlike(CUES).alias("cued"))


def _describer(kind: int):
    return lambda candidate: _described(kind, candidate)


def proposed(docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """[row, doc_id, held, email, ip, card, phone, candidates] of every row: spans of the rules, and candidates with features."""
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", body.alias("body"))
    digit = F.col("body").rlike("[0-9]")
    at = F.col("body").contains("@")
    worth = {"email": at, "ip": digit, "card": digit, "phone": F.col("body").contains("+")}
    patterns = dict(zip(RULES, (EMAIL, IP, CARD, PHONE), strict=True))
    found = rows.withColumns(
        {
            kind: F.when(worth[kind], F.filter(spans_of("body", patterns[kind]), _passes(kind))).otherwise(_no_spans())
            for kind in RULES
        }
    )
    able = {"number": digit, "address": at | F.col("body").contains("at"), "handle": at, "device": F.col("body").contains(":")}
    # Seven digits are the fewest of a telephone number.
    enough = lambda s: F.length(F.regexp_replace(s["value"], "[^0-9]", "")) >= 7
    described = []
    for number, (kind, pattern) in enumerate(GENERATORS.items()):
        spans = spans_of("body", pattern, around=True)
        spans = F.transform(F.filter(spans, enough) if kind == "number" else spans, _describer(number))
        described.append(F.when(able[kind], spans).otherwise(F.array()))
    plain = [F.transform(kind, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias(kind) for kind in RULES]
    held = (F.pmod(F.xxhash64("body"), F.lit(2)) == 0).alias("held")
    text = [F.col("body").alias("text")] if keep_text else []
    made = found.select("doc_id", held, *plain, F.concat(*described).alias("candidates"), *text)
    return made.withColumn("row", F.monotonically_increasing_id())


def _meets(blocking: Column) -> Column:
    """Whether a span [row, start, end, kind] overlaps one of the ``blocking`` spans of its row.

    In order of starts, some span before it ends behind its start, or the next one after it starts before its
    end. Both are running values, one from each side.
    """
    place, earlier = ("start", "end", "kind"), (Window.unboundedPreceding, -1)
    up = Window.partitionBy("row").orderBy(*place).rowsBetween(*earlier)
    down = Window.partitionBy("row").orderBy(*[F.desc(c) for c in place]).rowsBetween(*earlier)
    before = F.max(F.when(blocking, F.col("end"))).over(up)
    after = F.min(F.when(blocking, F.col("start"))).over(down)
    return F.coalesce(before > F.col("start"), F.lit(False)) | F.coalesce(after < F.col("end"), F.lit(False))


def labelled(rows: DataFrame) -> DataFrame:
    """[row, held, start, end, features..., met, label] of every candidate of stored ``proposed`` rows.

    ``label`` is 1 for known positives, else 0. Only rows with candidates take part, and only their places move.
    """
    some = rows.where(F.size("candidates") > 0)
    rules = F.concat(*RULES)
    spans = some.select("row", "held", "candidates", rules.alias("rules"))
    each = spans.select("row", "held", F.explode("candidates").alias("c")).select("row", "held", "c.*")
    marks = spans.select("row", F.explode("rules").alias("s")).select("row", "s.*", F.lit(-1).alias("kind"))
    placed = each.unionByName(marks, allowMissingColumns=True)
    placed = placed.withColumn("met", _meets(F.col("kind") == -1)).where("kind >= 0")
    cued = F.col("kind").isin([k for k, name in enumerate(GENERATORS) if name in CUED]) & F.col("cued")
    return placed.select("row", "held", "start", "end", *FEATURES, "met", (F.col("met") | cued).cast("int").alias("label"))


@dataclass(frozen=True)
class Split:
    """A tree of depth two: feature values on one side of each question, and four leaves."""

    first: tuple[str, int]
    seconds: tuple[tuple[str, int], tuple[str, int]]
    leaves: tuple[float, float, float, float]


@dataclass(frozen=True)
class SpanModel:
    start: float
    trees: tuple[Split, ...]
    bounds: tuple[float | None, ...]  # of the raw score, by generator; None selects nothing

    def score(self, feature) -> Column:
        """Raw score of a candidate; ``feature`` gives the column of a name."""
        total = F.lit(self.start)
        for tree in self.trees:
            inner = [F.when(feature(n) >= v, tree.leaves[2 * k + 1]).otherwise(tree.leaves[2 * k]) for k, (n, v) in enumerate(tree.seconds)]
            name, value = tree.first
            total = total + F.when(feature(name) >= value, inner[1]).otherwise(inner[0])
        return total

    def raw(self, row: dict) -> float:
        total = self.start
        for tree in self.trees:
            side = int(row[tree.first[0]] >= tree.first[1])
            name, value = tree.seconds[side]
            total += tree.leaves[2 * side + int(row[name] >= value)]
        return total


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def _best(rows: list[dict]) -> tuple[tuple[str, int], float]:
    """The question that gains most on gradients ``g`` and curvatures ``h``."""
    g, h = sum(r["g"] for r in rows), sum(r["h"] for r in rows)
    best, gain = ("kind", 0), 0.0
    for name, values in FEATURES.items():
        by = [[0.0, 0.0] for _ in range(values)]
        for r in rows:
            by[r[name]][0] += r["g"]
            by[r[name]][1] += r["h"]
        lg = lh = 0.0
        for value in range(1, values):
            lg, lh = lg + by[value - 1][0], lh + by[value - 1][1]
            new = lg * lg / (lh + 1) + (g - lg) ** 2 / (h - lh + 1) - g * g / (h + 1)
            if new > gain + 1e-9:
                best, gain = (name, value), new
    return best, gain


def fit(rows: list[dict]) -> SpanModel:
    """Boosted trees from counted feature combinations: rows of FEATURES with ``held``, ``yes`` and ``no``."""
    learn = [dict(r) for r in rows if not r["held"]]
    yes, no = sum(r["yes"] for r in learn), sum(r["no"] for r in learn)
    start = math.log((yes + 1) / (no + 1))
    for r in learn:
        r["f"] = start
    trees = []
    for _ in range(TREES if yes and no else 0):
        for r in learn:
            p, n = _sigmoid(r["f"]), r["yes"] + r["no"]
            r["g"], r["h"] = r["yes"] - n * p, n * p * (1 - p)
        first, gain = _best(learn)
        if gain <= 0:
            break
        seconds, leaves = [], []
        for side in (False, True):
            part = [r for r in learn if (r[first[0]] >= first[1]) == side]
            question, _ = _best(part)
            seconds.append(question)
            for high in (False, True):
                leaf = [r for r in part if (r[question[0]] >= question[1]) == high]
                leaves.append(RATE * sum(r["g"] for r in leaf) / (sum(r["h"] for r in leaf) + LEAST_SHARE_OF_LEAF))
        trees.append(Split(first, tuple(seconds), tuple(leaves)))
        for r in learn:
            side = int(r[first[0]] >= first[1])
            name, value = seconds[side]
            r["f"] += leaves[2 * side + int(r[name] >= value)]
    model = SpanModel(start, tuple(trees), ())
    held = [[(model.raw(r), r["yes"], r["no"]) for r in rows if r["held"] and r["kind"] == kind] for kind in range(len(GENERATORS))]
    return SpanModel(start, model.trees, tuple(map(calibrated, held)))


def calibrated(scored: list[tuple[float, int, int]]) -> float | None:
    """The raw score of a chance of ``SURE`` to be personal, from held-out (score, known positives, others)."""
    known = sum(yes for _, yes, _ in scored)
    if known < LEAST_HELD:
        return None
    share = SURE * sum(yes * _sigmoid(score) for score, yes, _ in scored) / known
    return math.log(share / (1 - share))


def train(candidates: DataFrame) -> SpanModel:
    """The model of ``labelled`` candidates; combinations are counted by Spark."""
    names = list(FEATURES)
    counted = candidates.groupBy("held", *names).agg(F.sum("label").alias("yes"), F.sum(1 - F.col("label")).alias("no"))
    return fit(sorted((r.asDict() for r in counted.collect()), key=lambda r: [r[n] for n in ("held", *names)]))


def added_spans(candidates: DataFrame, model: SpanModel) -> DataFrame:
    """[row, added]: candidates above their bound that are clear of the rules' spans and of earlier generators' spans."""
    score = model.score(F.col)
    high = F.lit(False)
    for kind, bound in enumerate(model.bounds):
        if bound is not None:
            high = high | ((F.col("kind") == kind) & (score >= F.lit(bound)))
    spans = candidates.where(~F.col("met") & high).select("row", "start", "end", "kind")
    blocked = F.lit(False)
    for kind in range(1, len(GENERATORS)):
        blocked = F.when(F.col("kind") == kind, _meets(F.col("kind") < kind)).otherwise(blocked)
    clear = spans.withColumn("blocked", blocked).where("NOT blocked")
    return clear.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("kind", "start", "end"))).alias("added"))


def selected(rows: DataFrame) -> DataFrame:
    """Stored ``proposed`` rows with the added spans as ``added`` in place of the candidates."""
    candidates = stored(labelled(rows), "candidates")
    added = stored(added_spans(candidates, train(candidates)), "added")
    none = F.expr("cast(array() AS array<struct<kind:int,start:int,end:int>>)")
    return rows.drop("candidates").join(added, "row", "left").withColumn("added", F.coalesce("added", none))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """[doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans] of every row."""
    out = selected(stored(proposed(docs), "proposed"))
    named = lambda kind: lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"])
    base = F.concat(*[F.transform(kind, named(kind)) for kind in RULES])
    kinds = F.array(*map(F.lit, GENERATORS))
    more = F.transform("added", lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"], s["end"]))
    return out.select(
        "doc_id",
        *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in RULES],
        F.sha2(F.array_join(base, ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.concat(base, more), ",").alias("spans"),
    )


def redacted(docs: DataFrame, mask: str = "[private]") -> DataFrame:
    """[doc_id, text] with every span, and spans that overlap together, replaced by one mask."""
    out = selected(stored(proposed(docs, keep_text=True), "proposed"))
    plain = lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))
    spans = F.array_sort(F.concat(*RULES, F.transform("added", plain)))
    return out.withColumn("spans", spans).select(
        "doc_id",
        F.expr(
            f"""aggregate(spans, named_struct('at', 0, 'out', ''), (s, x) -> named_struct(
              'at', greatest(s.at, x.end),
              'out', if(x.start >= s.at, concat(s.out, substring(text, s.at + 1, x.start - s.at), '{mask}'), s.out)),
              s -> concat(s.out, substring(text, s.at + 1)))"""
        ).alias("text"),
    )
