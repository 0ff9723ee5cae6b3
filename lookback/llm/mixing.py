"""Mixing to target weights: iterative proportional fitting over (source, lang, topic) cells, then sampling.

Method.  Documents are summed to cells; a cell's mass starts as its tokens.  Raking scales the masses
of each source to the source's target share, then of each language, then of each topic, and again until every
share is met to ``TOLERANCE`` of the whole (in blocks of ``cycles`` cycles).  A document's weight is its cell's mass over the cell's tokens; its probability
is that weight over the largest weight, so the expected tokens of the sample have the raked shares, no
document needs to be repeated, and the choice uses a hash of seed and id: it is the same in every run.

Targets, by dimension: a number between 0 and 1 is a temperature (a value's share to that power,
normalised: 1 keeps the shares, 0 makes them equal), a frame (value, weight) names shares (values that
no document has are left out, values without a target get mass 0 and are never chosen).  A topic is any
column expression; ``topic_of`` is a default by the build of a text, as the tables have no topic.

Only DataFrame functions are used.  Texts are read once for the sums (reduced before the shuffle; a
source with a third of all rows is summed in each task first) and once for the output, joined with the
cells, whose size Spark knows when it plans that join.  Cells are raked by windows over each dimension.

Defined cases: null or empty text: 1 token (its end token), topic ``empty``; null source, language or
topic: a value of its own, written ``(null)``; an empty table gives no rows; rows that repeat an id
share their choice; all null ids share one; input columns called like one that is made are replaced.
"""

from __future__ import annotations

import functools
import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import without, written

#: Shares of the whole mass that a marginal may miss its target by, and blocks of cycles that are tried for that.
TOLERANCE, MOST_BLOCKS = 1e-9, 12
NULL = "(null)"
DIMS = ("source", "lang", "topic")


def tokens_of(text: Column) -> Column:
    """Words (runs of other characters than space, tab, newline, carriage return) and one end token."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), "[ \t\n\r]+"), lambda w: w != "")).cast("long") + 1


def topic_of(text: Column) -> Column:
    """The build of a text: empty, table, shout, symbols, brief (up to 500 characters) or prose."""
    def share(mark: str) -> Column:
        return (F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))) / F.length(text)

    return (F.when(text.isNull() | (F.length(text) == 0), "empty")
            .when(share("|") > 0.02, "table").when(share("!") > 0.05, "shout")
            .when(share("#") + share("%") + share("$") > 0.05, "symbols")
            .when(F.length(text) <= 500, "brief").otherwise("prose"))


def chance(id_col: Column, seed: int) -> Column:
    """A number from 0 to 1 by the seed and the id: the first 13 hex digits of an MD5."""
    digest = F.md5(F.concat(F.lit(f"{seed}/"), F.coalesce(id_col.cast("string"), F.lit(NULL))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(16 ** 13))


def rake(cells: DataFrame, targets: dict, cycles: int = 12, tolerance: float = TOLERANCE) -> DataFrame:
    """``cells`` (the dimensions and ``tokens``) with ``mass`` and ``weight``.

    Blocks of ``cycles`` cycles run until no marginal misses its target by more than ``tolerance`` of the whole.  Targets
    that the given cells can't meet together have no such end: then the blocks stop when one brings no marginal nearer,
    with a warning that names what is missed.
    """
    frame = cells.withColumn("mass", F.col("tokens").cast("double"))
    for dim, target in targets.items():
        if isinstance(target, DataFrame):
            value, weight = target.columns
            named = target.select(F.coalesce(F.col(value).cast("string"), F.lit(NULL)).alias(dim), F.col(weight).cast("double").alias(f"to_{dim}"))
            frame = frame.join(named, dim, "left").fillna(0.0, [f"to_{dim}"])
        else:
            share = F.sum("tokens").over(Window.partitionBy(dim)).cast("double")
            frame = frame.withColumn(f"to_{dim}", F.pow(share, F.lit(float(target))))
    # Shares among the values present: each value's target counts once, whatever its number of cells.
    sums = [F.sum(F.col(f"to_{d}") / F.col(f"n_{d}")).alias(f"sum_{d}") for d in targets]
    for d in targets:
        frame = frame.withColumn(f"n_{d}", F.count("*").over(Window.partitionBy(d)))
    frame = written(frame, "mix-cells")
    total = frame.agg(F.sum("tokens").alias("total"), *sums).first()
    if total["total"] is None:
        return frame.withColumn("weight", F.lit(1.0)).select(*cells.columns, "mass", "weight")
    goals = {d: F.col(f"to_{d}") * F.lit(float(total["total"]) / (total[f"sum_{d}"] or 1.0)) for d in targets}
    missed = float("inf")
    for _ in range(MOST_BLOCKS):
        for cycle in range(1, cycles + 1):
            for d, goal in goals.items():
                held = F.sum("mass").over(Window.partitionBy(d))
                frame = frame.withColumn("mass", F.when(held > 0, F.col("mass") * goal / held).otherwise(F.lit(0.0)))
            if cycle % 4 == 0 or cycle == cycles:
                frame = written(frame, "mix-cycle")
        before, missed = missed, _missed(frame, goals) / float(total["total"])
        if missed <= tolerance or not targets:
            break
        if missed > 0.99 * before:
            warnings.warn(f"mixing: the targets can't be met together; a marginal misses its own by {missed:.2g} of all tokens", stacklevel=2)
            break
    else:
        warnings.warn(f"mixing: after {MOST_BLOCKS * cycles} cycles a marginal misses its target by {missed:.2g} of all tokens", stacklevel=2)
    return frame.withColumn("weight", F.col("mass") / F.col("tokens")).select(*cells.columns, "mass", "weight")


def _missed(frame: DataFrame, goals: dict) -> float:
    """The largest difference of a marginal's mass from its target."""
    parts = [frame.groupBy(F.col(d).alias("value")).agg(F.abs(F.sum("mass") - F.max(goal)).alias("off")).select("off") for d, goal in goals.items()]
    return functools.reduce(lambda a, b: a.unionByName(b), parts).agg(F.max("off").alias("off")).first()["off"] if parts else 0.0


def mix(docs: DataFrame, targets: dict, cycles: int = 12, seed: int = 7, topic: Column | None = None,
        id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with ``mix_topic, mix_tokens, mix_weight, mix_probability, mix_kept``."""
    docs = without(docs, ("mix_topic", "mix_tokens", "mix_weight", "mix_probability", "mix_kept"))
    topic = topic_of(docs[text_col]) if topic is None else topic
    keyed = docs.select("*", *[F.coalesce(docs[d].cast("string"), F.lit(NULL)).alias(f"__lb_{d}") for d in DIMS[:2]],
                        F.coalesce(topic.cast("string"), F.lit(NULL)).alias("__lb_topic"), tokens_of(docs[text_col]).alias("__lb_tokens"))
    cells = (keyed.groupBy(*[f"__lb_{d}" for d in DIMS]).agg(F.sum("__lb_tokens").alias("tokens"))
             .select(*[F.col(f"__lb_{d}").alias(d) for d in DIMS], "tokens"))
    raked = written(rake(written(cells, "mix-sums"), targets, cycles), "mix-raked")
    top = raked.agg(F.max("weight").alias("top")).first()["top"] or 1.0
    weights = raked.select(*[F.col(d).alias(f"__lb_{d}") for d in DIMS], F.col("weight").alias("mix_weight"),
                           (F.col("weight") / F.lit(float(top))).alias("mix_probability"))
    out = keyed.join(weights, [f"__lb_{d}" for d in DIMS])
    return out.select(*docs.columns, F.col("__lb_topic").alias("mix_topic"), F.col("__lb_tokens").alias("mix_tokens"),
                      "mix_weight", "mix_probability", (chance(F.col(id_col), seed) < F.col("mix_probability")).alias("mix_kept"))
