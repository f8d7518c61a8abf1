"""URL filter: host and path rules, then the ratio of two character language models.

A rule is a host, a path prefix and a verdict. It fits a URL of its host or any subdomain whose path
begins with the prefix, and the longest rule that fits decides. URLs that no rule decides are judged
by two smoothed variable-order Markov models of characters, one trained on accepted and one on
rejected URLs. A context is kept where training saw it ``LEAST_SEEN`` times or more, so what the models know
grows with the input; a character is
scored in the longest kept context, whose estimate is backed off to the next shorter one. The score is
the mean log-likelihood difference a character, and the bound is calibrated on URLs held out of
training: it rejects at most ``FALSE_REJECTED`` of the accepted ones.

URLs are reduced to host and path, lower-cased, with characters outside a fixed alphabet taken as one
symbol. Each distinct text is scored once, and each distinct character with its context has its ratio computed
once. Everything is SQL functions on narrow rows; counts of contexts are broadcast only where they
are counted to be few, else joined by shuffle.

Null URLs and URLs without ``://`` have an empty host and path, fit no rule and score 0. Without
accepted or rejected samples the models do not differ, all scores are 0 and everything is accepted.
Repeated rows each get their row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailflow.llm.common import broadcast_up_to, stored

ORDER = 4
LEAST_SEEN = 4
PRIOR = 4.0  # weight of the shorter context in characters
FALSE_REJECTED = 0.01
HELD_OUT = 5  # every fifth text calibrates
STEPS = 100  # calibration steps to a unit of score
FEW = 200_000  # rows up to which a table of the models is broadcast

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYMBOLS = "abcdefghijklmnopqrstuvwxyz0123456789./-_"
OTHER, START = "~", "^"
ALPHABET = SYMBOLS + OTHER + "$"  # with the end


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def parts_of(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path of a URL; empty where there is none."""
    after = F.when(F.instr(url, "://") > 0, F.expr("substring({0}, instr({0}, '://') + 3)".format("__url")))
    host = F.regexp_extract(after, r"^[^/?#]*", 0)
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _UPPER.lower()), F.lit("")), F.coalesce(path, F.lit(""))


def with_rules(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """[page_id, host, path, rule, ruled] of every row; rule and its verdict are null where none fits."""
    host, path = parts_of(F.col("__url"))
    parts = pages.select("page_id", F.col("url").cast("string").alias("__url")).select(
        "page_id", host.alias("host"), path.alias("path")
    )
    name = verdict = F.lit(None).cast("string")
    # The longest rule is asked first.
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        own = (F.col("host") == rule.host) | F.endswith(F.col("host"), F.lit("." + rule.host))
        fits = own & F.startswith(F.col("path"), F.lit(rule.path))
        name = F.when(fits, F.lit(rule.name)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return parts.select("*", name.alias("rule"), verdict.alias("ruled"))


def reduced(text: Column) -> Column:
    """The text in the alphabet of the models."""
    lower = F.translate(text, _UPPER, _UPPER.lower())
    return F.regexp_replace(lower, f"[^{SYMBOLS.replace('-', '')}-]", OTHER)


def grams(texts: DataFrame, *keep: str) -> DataFrame:
    """[keep..., gram] with a row for each character and the end: up to ``ORDER`` characters before it, and itself."""
    padded = F.concat(F.lit(START * ORDER), F.col("text"), F.lit("$"))
    at = F.explode(F.sequence(F.lit(1), F.length("text") + 1)).alias("__at")
    return texts.select(*keep, padded.alias("__padded"), at).select(
        *keep, F.expr(f"substring(__padded, __at, {ORDER + 1})").alias("gram")
    )


def _context(order: int) -> Column:
    return F.expr(f"substring(gram, {ORDER - order + 1}, {order})") if order else F.lit("")


def train(samples: DataFrame, least_seen: int = LEAST_SEEN) -> list[tuple[DataFrame, DataFrame]]:
    """Counts by order, 0 first, from samples [text, label, n], label 1 accepted.

    For each order the kept contexts [context, all_yes, all_no] and the cells [context, symbol, yes, no].
    """
    counted = stored(
        grams(samples, "label", "n").groupBy("label", "gram").agg(F.sum("n").alias("n")),
        "grams",
    )
    tables = []
    for order in range(ORDER + 1):
        cells = counted.groupBy(_context(order).alias("context"), F.expr(f"substring(gram, {ORDER + 1}, 1)").alias("symbol")).agg(
            F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).cast("double").alias("yes"),
            F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).cast("double").alias("no"),
        )
        cells = stored(cells, f"cells{order}")
        known = cells.groupBy("context").agg(F.sum("yes").alias("all_yes"), F.sum("no").alias("all_no"))
        if order:
            known = known.where(F.col("all_yes") + F.col("all_no") >= least_seen)
        tables.append((stored(known, f"contexts{order}"), cells))
    return tables


def ratios(wanted: DataFrame, model: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """[gram, ratio] of the distinct grams ``wanted``: log of accepted over rejected chance, to nine decimals.

    The chance in a context is backed off to that in the next shorter one, whose own suffix is kept wherever
    it is; where a context is not kept, the shorter one stands.
    """
    even = F.lit(1.0 / len(ALPHABET))
    rows = wanted.select("gram", F.expr(f"substring(gram, {ORDER + 1}, 1)").alias("symbol"), even.alias("p_yes"), even.alias("p_no"))
    for order, (known, cells) in enumerate(model):
        rows = rows.withColumn("context", _context(order))
        rows = rows.join(broadcast_up_to(known, FEW), "context", "left")
        rows = rows.join(broadcast_up_to(cells, FEW), ["context", "symbol"], "left")
        seen = {c: F.coalesce(c, F.lit(0.0)) for c in ("yes", "no")}
        chance = {
            f"p_{c}": F.when(F.col(f"all_{c}").isNull(), F.col(f"p_{c}")).otherwise(
                (seen[c] + PRIOR * F.col(f"p_{c}")) / (F.col(f"all_{c}") + PRIOR)
            )
            for c in ("yes", "no")
        }
        rows = rows.withColumns(chance).select("gram", "symbol", "p_yes", "p_no")
    return rows.select("gram", F.round(F.log(F.col("p_yes") / F.col("p_no")), 9).alias("ratio"))


def scores(texts: DataFrame, model: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """[text, score] of distinct texts: the mean log ratio a character, to six decimals."""
    spread = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = grams(texts.repartition(spread, "text"), "text")
    known = stored(ratios(stored(rows.select("gram").distinct(), "wanted"), model), "ratios")
    rows = rows.join(broadcast_up_to(known, FEW), "gram")
    mean = F.sum("ratio") / F.count(F.lit(1))
    return rows.groupBy("text").agg(F.when(F.col("text") == "", 0.0).otherwise(F.round(mean, 6)).alias("score"))


def calibrated(held: DataFrame, false_rejected: float = FALSE_REJECTED) -> float:
    """The highest bound, in steps, below which at most a share of the accepted [label, score, n] lie."""
    step = F.floor(F.col("score") * STEPS)
    sums = held.where("label = 1").groupBy(step.alias("step")).agg(F.sum("n").alias("n"))
    rows = sorted(sums.collect())  # a row for each step of score, which the alphabet and the prior bound
    total, below, bound = sum(row["n"] for row in rows), 0, None
    for row in rows:
        bound = row["step"]
        below += row["n"]
        if below > false_rejected * total:
            break
    return 0.0 if bound is None else bound / STEPS


def judge(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """[page_id, host, path, rule, verdict, score] of every row of ``pages`` [page_id, url]."""
    ruled = stored(with_rules(pages, rules), "ruled").withColumn("text", reduced(F.concat("host", "path")))
    # A text can carry both verdicts where URLs differ in ways that the alphabet does not show.
    label = F.when(F.col("ruled") == "allow", 1).when(F.col("ruled") == "block", 0)
    distinct = stored(ruled.groupBy("text", label.alias("label")).agg(F.count(F.lit(1)).alias("n")), "texts")
    place = F.conv(F.substring(F.md5(F.col("text").cast("binary")), 1, 8), 16, 10).cast("long")
    held = place % HELD_OUT == 0
    samples = distinct.where(F.col("label").isNotNull() & ~held)
    model = train(samples)
    scored = stored(scores(distinct.select("text").distinct(), model), "scores")
    bound = calibrated(distinct.where(F.col("label").isNotNull() & held).join(scored, "text"))
    both = samples.agg(F.count_distinct("label")).first()[0] == 2
    accepted = F.col("score") >= F.lit(bound) if both else F.lit(True)
    verdict = F.coalesce("ruled", F.when(accepted, "allow").otherwise("block"))
    return ruled.join(scored, "text").select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
