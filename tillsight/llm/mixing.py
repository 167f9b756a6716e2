"""Mixing sources to target weights by iterative proportional fitting.

Documents are counted into cells (source, language, topic).  Each cell has a token weight;
raking scales the cells of each value of one margin after the other so that the weighted
tokens meet that margin's targets, until nothing moves any more.  A cell's sampling
probability is its weight times ``fraction``.  Weights are trimmed within the rounds where
that would exceed 1, so what such a cell lacks goes to others of the margin, and no value is
asked for more tokens than it has.  A document is sampled if a hash of its id and text lies
below its cell's probability: no shuffle, and the same choice at every run.

DataFrame and SQL functions only.  Cells and margins are tables like any other; the driver
sees only sums and one maximum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.llm.common import staged, unit_hash
from tillsight.plans.scratch import discard, stage

MARGINS = ("source", "lang", "topic")
FRACTION = 0.5
TEMPER = 0.7
TOLERANCE = 0.005
MAX_ROUNDS = 40
SEED = 3
_NONE = "\u0000none"


def token_count(text: Column) -> Column:
    """White-space separated words; null and empty texts have none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\r"))
    return F.when(trimmed == "", 0).otherwise(F.regexp_count(trimmed, F.lit(r"\s+")) + 1).cast("long")


def topic_of(text: Column, tokens: Column) -> Column:
    """A stand-in for a topic where a table has none, from measures that any text has: its length in UTF-8
    bytes, how many words a line has, and how many bytes a word."""
    size = F.octet_length(text)
    breaks = size - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))
    length = F.when(size < 600, "short").when(size < 4000, "medium").otherwise("long")
    layout = F.when(breaks * 12 >= tokens, "lines").otherwise("prose")
    wording = F.when(size < tokens * 5, "terse").when(size < tokens * 9, "plain").otherwise("dense")
    return F.when(tokens == 0, "empty").otherwise(F.concat_ws(" ", length, layout, wording))


def value_of(name: str) -> Column:
    """A margin's value as a string; nulls are a value of their own."""
    return F.coalesce(F.col(name).cast("string"), F.lit(_NONE))


def cell_table(docs: DataFrame, margins: tuple[str, ...], tokens: str) -> DataFrame:
    """Tokens by cell; partial sums are made before the shuffle, so a hot source costs nothing."""
    cells = docs.groupBy(*(value_of(m).alias(f"__{m}") for m in margins)).agg(F.sum(tokens).cast("double").alias("__tokens"))
    return staged(cells, "mixing-cells")


def tempered_targets(cells: DataFrame, margin: str, temper: float) -> DataFrame:
    """Target weights by value of a margin (``__m``, ``__target``): tokens to the power ``temper``."""
    have = cells.groupBy(F.col(f"__{margin}").alias("__m")).agg(F.sum("__tokens").alias("__have"))
    return have.select("__m", F.pow("__have", F.lit(temper)).alias("__target"))


def within_reach(wanted: DataFrame, total: float) -> DataFrame:
    """``__m`` and ``__target`` of ``wanted`` (a small staged table) scaled to ``total`` in all, none over its
    ``__most``; what that leaves goes to the others in proportion."""
    scale = 0.0
    while True:  # each round fixes at least one more value at its most, or ends
        full = F.col("__target") * scale >= F.col("__most") if scale else F.lit(False)
        taken, open_ = wanted.agg(F.sum(F.when(full, F.col("__most")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("__target")))).collect()[0]
        new = (total - (taken or 0.0)) / open_ if open_ else scale
        if new <= scale * (1 + 1e-9):
            break
        scale = new
    return wanted.select("__m", F.least(F.col("__target") * scale, F.col("__most")).alias("__target"))


def rake(
    cells: DataFrame, targets: dict[str, DataFrame], tolerance: float = TOLERANCE, max_rounds: int = MAX_ROUNDS, most: float = float("inf"),
) -> DataFrame:
    """``cells`` with ``__w``, the weight at which each margin's weighted tokens are in proportion to
    its targets and sum to all tokens.  No weight exceeds ``most``, and no value's target
    its tokens at that weight.  A value without a target gets weight 0.  Rounds end
    when no weight moves by over ``tolerance`` of itself, or after ``max_rounds`` (margins
    that contradict each other)."""
    spark = cells.sparkSession
    total = cells.agg(F.sum("__tokens")).collect()[0][0] or 0.0
    state = cells.withColumn("__w", F.lit(min(1.0, most))).withColumn("__before", F.col("__w"))
    for margin, target in targets.items():
        present = cells.groupBy(F.col(f"__{margin}").alias("__m")).agg((F.sum("__tokens") * F.lit(most)).alias("__most"))
        if most == float("inf"):  # also for values without tokens
            present = present.withColumn("__most", F.lit(most))
        reached = within_reach(staged(present.join(target, "__m"), "mixing-targets"), total)
        state = state.join(reached.select(F.col("__m").alias(f"__{margin}"), F.col("__target").alias(f"__target_{margin}")), f"__{margin}", "left")
    # Each step is written before the next one reads it twice, so plans do not grow with margins or rounds.
    paths: list[str] = []
    state = stage(spark, state, "mixing-step", paths)
    for _ in range(max_rounds):
        state = state.withColumn("__before", F.col("__w"))
        for margin in targets:
            state = stage(spark, fitted(state, margin, most), "mixing-step", paths)
            discard(spark, paths[:-1])
            del paths[:-1]
        moved = state.agg(F.max(F.abs(F.col("__w") - F.col("__before")) / F.greatest("__before", F.lit(1e-12)))).collect()[0][0]
        if (moved or 0.0) <= tolerance:
            break
    return state.select(*cells.columns, "__w")


def fitted(state: DataFrame, margin: str, most: float) -> DataFrame:
    """``state`` with the weights of each value of a margin scaled to its target, none over ``most``."""
    key, target = f"__{margin}", F.col(f"__target_{margin}")
    sums = state.groupBy(key).agg(F.sum(F.col("__tokens") * F.col("__w")).alias("__now"))
    factor = F.when(target.isNull(), 0.0).when(F.col("__now") > 0, target / F.col("__now")).otherwise(1.0)
    return state.join(sums, key).withColumn("__w", F.least(F.lit(most), F.col("__w") * factor)).drop("__now").select(*state.columns)


def calibrated(cells: DataFrame, fraction: float) -> DataFrame:
    """``cells`` with ``__p``: weights times ``fraction``, at most 1."""
    return cells.withColumn("__p", F.least(F.lit(1.0), F.col("__w") * F.lit(float(fraction))))


def mixed(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", margins: tuple[str, ...] = MARGINS, targets: dict[str, DataFrame] | None = None,
    fraction: float = FRACTION, temper: float = TEMPER, seed: int = SEED,
) -> DataFrame:
    """``docs`` with ``__tokens``, ``__p`` and ``__sampled``.  ``targets`` gives (``__m``, ``__target``) by
    margin, in any unit; without them they are tempered shares of what there is.  The sample is
    expected to have ``fraction`` of the tokens and to meet the targets, as far as the cells allow both.

    Nulls in a margin are a value of their own; null and empty texts have no tokens and the
    probability of their cell.  Rows equal in id and text share their fate.  An empty table
    gives no rows.
    """
    docs = docs.withColumn("__tokens", token_count(F.col(text_col)))
    if "topic" in margins and "topic" not in docs.columns:
        docs = docs.withColumn("__topic_of", topic_of(F.coalesce(F.col(text_col), F.lit("")), F.col("__tokens")))
        margins = tuple("__topic_of" if m == "topic" else m for m in margins)
        targets = {("__topic_of" if m == "topic" else m): t for m, t in (targets or {}).items()}
    cells = cell_table(docs, margins, "__tokens")
    wanted = {m: (targets or {}).get(m) for m in margins}
    wanted = {m: tempered_targets(cells, m, temper) if t is None else t for m, t in wanted.items()}
    cells = calibrated(rake(cells, wanted, most=1 / fraction), fraction)
    keys = [f"__{m}" for m in margins]
    probability = cells.select(*keys, "__p")
    with_keys = docs.select("*", *(value_of(m).alias(f"__{m}") for m in margins))
    chance = unit_hash(F.col(id_col), F.col(text_col), seed=seed)
    out = with_keys.join(probability, keys).withColumn("__sampled", chance < F.col("__p"))
    out = out.drop(*keys)
    return out.withColumnRenamed("__topic_of", "topic") if "__topic_of" in out.columns else out


def sample_mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The sampled rows of ``docs``, with its own columns."""
    return mixed(docs, id_col, text_col, **options).filter("__sampled").select(*docs.columns)
