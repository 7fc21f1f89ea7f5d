"""Mixing sources to target weights by a temperature, realised as budgeted block permutations.

A source's share of the tokens is raised to an exponent between 0 (all sources
alike) and 1 (as they are) and normalised.  The exponent is bisected: the
largest that still reaches the target entropy, but not less than what keeps
the repetitions under their limit.  A source's documents are dealt into blocks
of about ``block_tokens``; whole passes take every block, the last pass takes
blocks in a permuted order until the source's budget is spent, cutting only
the last block.  DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import store

STEPS, HALVINGS = 40, 8  # halvings of the exponent's range, in all and by one job
EXACT = "decimal(38,18)"
SLICE_BITS = 10  # the blocks of a source are summed up in slices by the leading bits of their order
BLOCK_TOKENS = 1_000_000
DIGITS = 6  # decimals of the exponent and the weights, so that equal inputs give equal mixes everywhere


def n_tokens(text: Column) -> Column:
    """Number of words between blanks; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def hash_number(*parts: Column) -> Column:
    """60-bit number from the md5 of the parts, joined by a slash."""
    return F.conv(F.substring(F.md5(F.concat_ws("/", *[p.cast("string") for p in parts]).cast("binary")), 1, 15), 16, 10).cast("long")


def _pow(x: Column, a: Column) -> Column:
    return F.exp(a * F.ln(x))


def _exponents(groups: DataFrame, exponents: Column, all_tokens: Column) -> DataFrame:
    """``i, a, z, entropy`` for every ``(i, a)`` of the array ``exponents``: what the sources' shares to the power ``a`` add up to, and the entropy of the mix.

    One partial aggregate over ``groups (tokens, sources)``.  Terms are added
    up as decimals, so that the order of addition doesn't matter.
    """
    wide = groups.select("tokens", "sources", F.explode(exponents).alias("x")).select("tokens", "sources", "x.i", "x.a")
    log = F.ln(F.col("tokens") / all_tokens)
    term = F.col("sources") * F.exp(F.col("a") * log)
    sums = wide.groupBy("i", "a").agg(F.sum(term.cast(EXACT)).cast("double").alias("z"), F.sum((term * log).cast(EXACT)).cast("double").alias("e"))
    return sums.select("i", "a", "z", (F.ln("z") - F.col("a") * F.col("e") / F.col("z")).alias("entropy"))


def _largest_exponent(groups: DataFrame, all_tokens: Column, least: float) -> float:
    """The largest exponent up to 1 at which the entropy is at least ``least`` (it falls as the exponent rises).

    The range is halved ``HALVINGS`` times a job: the points of all these
    halvings are evaluated at once, and one number comes back.
    """
    cuts = 1 << HALVINGS
    low, width = 0.0, 1.0
    for _ in range(0, STEPS, HALVINGS):
        width /= cuts
        point = lambda i: F.struct(i.alias("i"), (F.lit(low) + i * F.lit(width)).alias("a"))  # noqa: E731, B023
        points = F.transform(F.sequence(F.lit(1), F.lit(cuts)), point)
        low += (_exponents(groups, points, all_tokens).where(F.col("entropy") >= least).agg(F.max("i")).first()[0] or 0) * width
        if low >= 1.0:
            return 1.0
    return low


def source_plan(
    tokens: DataFrame, target_entropy: float = 0.92, max_passes: float = 2.0, block_tokens: int = BLOCK_TOKENS, total_tokens: int | None = None
) -> DataFrame:
    """One row per source of ``tokens (source, n_tokens)``: ``source, tokens, weight, budget, full_passes, rest, blocks``.

    ``target_entropy`` is the share of the largest possible entropy (ln of the
    number of sources) that the mix should have at least, if a flattening
    exponent can give it; ``max_passes`` limits how often a source is repeated
    and wins where both cannot be had.  Without ``total_tokens`` the budget is
    the least that leaves no document out: the source that is thinned most gets
    exactly one pass.  A source without tokens has weight 0 and one pass.
    """
    per = store(tokens.groupBy("source").agg(F.sum("n_tokens").alias("tokens")), "mix-sources")
    # Sources enter as counts per distinct size; the list of sizes stays a table.
    groups = store(per.where("tokens > 0").groupBy("tokens").agg(F.count("*").alias("sources")), "mix-sizes")
    sums = F.sum(F.col("tokens") * F.col("sources")), F.coalesce(F.sum("sources"), F.lit(0)), F.max("tokens"), F.min("tokens")
    all_tokens, n, top, bottom = groups.agg(*sums).first()  # four numbers
    whole, most, exponent, z = F.lit(float(all_tokens or 1)), F.lit(float(top or 1)), F.lit(1.0), F.lit(1.0)
    if n:
        by_entropy = _largest_exponent(groups, whole, target_entropy * math.log(n))
        # (most / fewest) ** (1 - a) passes of the smallest source for one pass of the largest.
        spread = math.log(top / bottom)
        by_passes = 0.0 if spread <= math.log(max_passes) else 1.0 - math.log(max_passes) / spread
        point = F.struct(F.lit(1).alias("i"), F.round(F.lit(max(by_entropy, by_passes)), DIGITS).alias("a"))
        found = _exponents(groups, F.array(point), whole).first()
        exponent, z = F.lit(found["a"]), F.lit(found["z"])

    least = most / (_pow(most / whole, exponent) / z)
    planned = per
    weight = F.when(F.col("tokens") > 0, _pow(F.col("tokens") / whole, exponent) / z).otherwise(0.0)
    budget = F.round(weight * (F.lit(float(total_tokens)) if total_tokens else least))
    budget = F.when(F.col("tokens") == most, F.greatest(budget, F.col("tokens"))).otherwise(budget) if not total_tokens else budget
    planned = planned.select("source", "tokens", F.round(weight, DIGITS).alias("weight"), budget.cast("long").alias("budget"))
    planned = planned.withColumn("full_passes", F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(1))
    return planned.select(
        "source", "tokens", "weight", "budget", "full_passes",
        F.when(F.col("tokens") > 0, F.col("budget") - F.col("full_passes") * F.col("tokens")).otherwise(0).alias("rest"),
        F.greatest(F.lit(1), F.ceil(F.col("tokens") / block_tokens)).cast("long").alias("blocks"),
    )


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: int = 1,
    keep: tuple[str, ...] = (),
    **plan_options,
) -> DataFrame:
    """``doc_id, source, n_tokens``, the columns named in ``keep``, ``pass, block, slot``: a row per document and pass.

    Within a source, (pass, block, slot, doc_id) is the order of the mix: each
    pass has its own permutation of blocks and of the documents inside a block.
    ``block`` is the number that orders the blocks of a pass, ``slot`` the one
    that orders the documents of a block.  A null source is a source of its own (of null
    name); null and empty texts have no tokens and are in every whole pass;
    rows that share an id are taken each for itself; ties are ordered by id.
    A column of ``keep`` that is named like one of the results is a ValueError.
    """
    if taken := {"doc_id", "source", "n_tokens", "pass", "block", "slot"}.intersection(keep):
        raise ValueError(f"columns to keep are named like results: {sorted(taken)}")
    names, keep = keep, tuple(f"kept_{i}" for i in range(len(keep)))
    kept = [F.col(name).alias(k) for name, k in zip(names, keep, strict=True)]
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), n_tokens(F.col(text_col)).alias("n_tokens"), *kept)
    rows = store(rows, "mix-rows")
    plan = store(source_plan(rows.select("source", "n_tokens"), **plan_options), "mix-plan")
    wide = rows.alias("r").join(plan.alias("p"), F.expr("r.source <=> p.source")).select("r.*", "full_passes", "rest", "blocks")
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    name = F.coalesce(F.col("source"), F.lit("null"))
    wide = wide.withColumn("home", hash_number(F.lit(seed), F.lit("home"), doc) % F.col("blocks"))

    last = F.col("full_passes")
    order = hash_number(F.lit(seed), F.lit("block"), last, name, F.col("home"))
    per_block = wide.where("rest > 0").groupBy("source", "home", "full_passes", "rest").agg(F.sum("n_tokens").alias("n"))
    per_block = store(per_block.withColumn("order", order).withColumn("slice", F.shiftright("order", 60 - SLICE_BITS)), "mix-last-pass")
    # Tokens before a block: those of the slices before its own, then those before it in its slice.
    above = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = per_block.groupBy("source", "slice").agg(F.sum("n").alias("n")).select("source", "slice", F.coalesce(F.sum("n").over(above), F.lit(0)).alias("above"))
    before = Window.partitionBy("source", "slice").orderBy("order", "home").rowsBetween(Window.unboundedPreceding, -1)
    per_block = per_block.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    per_block = per_block.alias("b").join(slices.alias("s"), F.expr("b.source <=> s.source and b.slice = s.slice"))
    per_block = per_block.select("b.source", "home", "rest", "n", (F.col("before") + F.col("above")).alias("before"))
    taken = store(per_block.where("before < rest").select("source", "home", (F.col("rest") - F.col("before")).alias("left"), "n"), "mix-blocks")

    part = wide.where("rest > 0").alias("w").join(taken.alias("t"), F.expr("w.source <=> t.source and w.home = t.home")).select("w.*", "left", "n")
    slot = hash_number(F.lit(seed), F.lit("doc"), last, doc)
    inside = Window.partitionBy("source", "home").orderBy(slot, "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    cut = part.where("n > left").withColumn("before", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).where("before < left").drop("before")
    partial = part.where("n <= left").unionByName(cut).select("doc_id", "source", "n_tokens", *keep, "home", F.col("full_passes").alias("pass"))
    whole = wide.where("full_passes > 0").select("doc_id", "source", "n_tokens", *keep, "home", F.explode(F.sequence(F.lit(0).cast("long"), F.col("full_passes") - 1)).alias("pass"))
    mixed = whole.unionByName(partial)
    return mixed.select(
        "doc_id", "source", "n_tokens", *[F.col(k).alias(name) for name, k in zip(names, keep, strict=True)], "pass",
        hash_number(F.lit(seed), F.lit("block"), F.col("pass"), name, F.col("home")).alias("block"),
        hash_number(F.lit(seed), F.lit("doc"), F.col("pass"), doc).alias("slot"),
    )
