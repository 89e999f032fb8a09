"""Mixing sources to target weights by temperature, in DataFrame operations.

Source shares p of all tokens are raised to an exponent a in [0, 1] and normalised: 1 is the natural mix, 0 the uniform one. The
exponent is found by section of [0, 1]: the flattest mix that repeats no source more often than allowed, or the mix nearest to the
natural one that has the wanted entropy. Each pass is one aggregate over the table of sources, for 31 inner points at once (five
halvings).

The weights are realised as budgeted block permutations. A source's documents fall into a fixed number of blocks by hash. An epoch is a
permutation of the blocks; a source gets as many whole epochs as its quota holds and of one more the blocks that fit, in the permutation's
order: a block that does not fit is passed over. What is left of the quota is filled from one of the blocks passed over, in pieces by a further hash,
so one very long document keeps no source below its weight by more than a piece. A source that has nothing by then gets its smallest piece.
A document comes once per epoch that has its block. The block number is part of the join key, so a hot source is spread.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from strata.llm.rows import others, packed, quoted, unpacked
from strata.llm.store import kept

BLOCKS = 256
POINTS = 32
PASSES = 6


def digits(text: Column, begin: int, count: int) -> Column:
    """A number from hexadecimal digits of the text's md5."""
    return F.conv(F.substring(F.md5(text), begin, count), 16, 10).cast("long")


def exponent(shares: DataFrame, max_epochs: float | None = None, entropy: float | None = None, budget: float | None = 1.0) -> float:
    """The exponent for ``shares`` (source, tokens), rounded up (entropy: down) to six digits. ``budget``: tokens to give out, in
    multiples of all tokens; None: as few as give every source a whole epoch. 1 if no exponent meets the limit or there is
    no token; with ``entropy`` (in nats) 0 if even the uniform mix has less."""
    if (max_epochs is None) == (entropy is None):
        raise ValueError("give max_epochs or entropy")
    total = shares.agg(F.sum("tokens")).first()[0]
    if not total:
        return 1.0
    p = shares.where("tokens > 0").select((F.col("tokens") / F.lit(float(total))).alias("p"))

    def at(points):
        a = F.col("a")
        rows = (p.withColumn("a", F.explode(F.array(*[F.lit(x) for x in points]))).groupBy("a")
                .agg(F.sum(F.pow("p", a)).alias("s"), F.sum(F.pow("p", a) * F.log("p")).alias("e"),
                     F.max(F.pow(F.col("p"), a - 1)).alias("most"), F.min(F.pow(F.col("p"), a - 1)).alias("least")).collect())
        found = {}
        for r in rows:
            if entropy is not None:
                found[r.a] = math.log(r.s) - r.a * r.e / r.s < entropy  # too pointed
            else:
                found[r.a] = (r.most / r.least if budget is None else budget * r.most / r.s) <= max_epochs
        return found

    ends = at([0.0, 1.0])
    if ends[0.0]:
        return 0.0
    if not ends[1.0]:
        return 1.0
    low, high = 0.0, 1.0  # the condition holds at high, not at low
    for _ in range(PASSES):
        points = [low + (high - low) * k / POINTS for k in range(1, POINTS)]
        holds = at(points)
        first = next((x for x in points if holds[x]), high)
        low, high = max([low, *(x for x in points if x < first)]), first
    return math.ceil(high * 1e6) / 1e6 if entropy is None else math.floor(low * 1e6) / 1e6


def fitting(parts: Column, room: Column) -> Column:
    """From an array of (turn, part, t) with at most ``BLOCKS`` entries: (left, taken), where each part is taken that still fits, in order
    of turn, the others are passed over, and ``left`` is the room that stays."""
    start = F.struct(room.cast("long").alias("left"), F.array().cast("array<long>").alias("taken"))
    return F.aggregate(F.array_sort(parts), start, lambda at, x: F.when(x["t"] <= at["left"], F.struct(
        (at["left"] - x["t"]).alias("left"), F.concat(at["taken"], F.array(x["part"])).alias("taken"))).otherwise(at))


def last_epochs(plan: DataFrame, filed: DataFrame, seed: int) -> DataFrame:
    """The last epoch of each source (s, b, epoch, turn, pieces; null pieces: the whole block), from ``plan`` (a source's blocks in that epoch) and
    ``filed`` (s, b, p and tokens of each document). Of the blocks that don't fit the one with the shortest longest document is cut into pieces."""
    entry = F.struct("turn", F.col("b").alias("part"), "t")
    chosen = plan.groupBy("s", "epoch", "whole", "rest").agg(F.collect_list(entry).alias("parts"), F.collect_list(  # at most blocks entries
        F.struct("longest", "turn", "b")).alias("cuts")).withColumn("fit", fitting(F.col("parts"), F.col("rest")))
    cut = F.array_min(F.filter("cuts", lambda x: ~F.array_contains(F.col("fit.taken"), x["b"])))
    chosen = kept(chosen.select("s", "epoch", "whole", "rest", "parts", F.col("fit.left").alias("left"), F.col("fit.taken").alias("taken"), cut.alias("cut")), "mix_last")
    whole = chosen.select("s", "epoch", F.explode(F.filter("parts", lambda x: F.array_contains("taken", x["part"]))).alias("x")).select(
        "s", F.col("x.part").alias("b"), "epoch", F.col("x.turn").alias("turn"), F.lit(None).cast("array<long>").alias("pieces"))
    # left > 0 with all blocks taken is not possible: rest is under the source's tokens
    asked = chosen.where("left > 0").select(F.col("s").alias("s2"), F.col("cut.b").alias("b2"), F.col("cut.turn").alias("turn"), "epoch", "left",
                                            ((F.col("whole") == 0) & (F.col("left") == F.col("rest"))).alias("bare"))
    mine = (F.col("s") == F.col("s2")) & (F.col("b") == F.col("b2"))
    pieces = filed.join(asked.select("s2", "b2"), mine).groupBy("s", "b", "p").agg(F.sum("tokens").alias("t"))
    place = F.md5(F.concat_ws("|", F.lit(str(seed)), "s", "epoch", "b", "p"))
    got = pieces.join(asked, mine).groupBy("s", "b", "epoch", "turn", "left", "bare").agg(
        F.collect_list(F.struct(place.alias("turn"), F.col("p").alias("part"), "t")).alias("parts"))  # at most BLOCKS entries
    least = F.array_min(F.transform(F.filter("parts", lambda x: x["t"] > 0), lambda x: F.struct(x["t"], x["part"])))["part"]
    fit = fitting(F.col("parts"), F.col("left"))
    nothing = F.col("bare") & (fit["left"] == F.col("left"))
    return whole.unionByName(got.select("s", "b", "epoch", "turn", F.when(nothing, F.array_union(fit["taken"], F.array(least))).otherwise(fit["taken"]).alias("pieces")))


def mix(docs: DataFrame, size: Column, max_epochs: float | None = None, entropy: float | None = None, budget: float | None = 1.0,
        seed: int = 1, source_col: str = "source", id_col: str = "doc_id", blocks: int = BLOCKS) -> DataFrame:
    """The mix: all columns of ``docs`` and tokens (``size``, null: 0), epoch (from 1) and turn (the place of the document's block in that epoch's
    permutation). A document has a row per epoch it is in; under a budget it may have none. A null source is a source
    of its own. Sources without tokens get one epoch; every source with a quota gets something. Repeated rows and rows of one id share a block and
    a piece. Result names replace columns of ``docs``; other columns may have any name. An empty table gives an empty mix."""
    names = others(docs, "tokens", "epoch", "turn")
    identity = F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(quoted(id_col)).cast("string"), F.lit("")))
    source = F.coalesce(F.concat(F.lit("="), F.col(quoted(source_col)).cast("string")), F.lit("null"))
    filed = docs.select(packed(names), F.coalesce(size, F.lit(0)).cast("long").alias("tokens"), source.alias("s"),
                        (digits(identity, 1, 8) % blocks).alias("b"), (digits(identity, 9, 8) % BLOCKS).alias("p"))
    sums = kept(filed.groupBy("s", "b").agg(F.sum("tokens").alias("t"), F.max("tokens").alias("longest")), "mix_blocks")  # at most blocks rows per source
    shares = kept(sums.groupBy("s").agg(F.sum("t").alias("tokens")), "mix_shares")
    a = exponent(shares, max_epochs, entropy, budget)
    total = float(shares.agg(F.sum("tokens")).first()[0] or 0)
    lean = F.pow(F.col("tokens") / F.lit(total), F.lit(a - 1))
    norm = shares.where("tokens > 0").agg(F.sum(F.pow(F.col("tokens") / F.lit(total), F.lit(a))).alias("s"), F.min(lean).alias("least")).first() if total else None
    scale = F.lit(1.0) if norm is None else lean / F.lit(norm.least) if budget is None else lean * F.lit(budget) / F.lit(norm.s)
    quota = F.floor(scale * F.col("tokens") + F.lit(0.5)).cast("long")
    quotas = shares.select("s", "tokens", F.when(F.col("tokens") > 0, quota).otherwise(0).alias("quota")).select(
        "s", F.when(F.col("tokens") > 0, F.expr("quota div tokens")).otherwise(1).alias("whole"),
        F.when(F.col("tokens") > 0, F.expr("quota % tokens")).otherwise(0).alias("rest"))
    plan = sums.join(quotas, "s").select("*", F.explode(F.sequence(F.lit(1), (F.col("whole") + 1).cast("int"))).alias("epoch"))
    place = F.md5(F.concat_ws("|", F.lit(str(seed)), "s", F.col("epoch").cast("string"), F.col("b").cast("string")))
    order = Window.partitionBy("s", "epoch").orderBy(place)  # at most blocks rows
    plan = plan.select("s", "b", "t", "longest", "epoch", "whole", "rest", F.row_number().over(order).alias("turn"))
    given = plan.where(F.col("epoch") <= F.col("whole")).select("s", "b", "epoch", "turn", F.lit(None).cast("array<long>").alias("pieces")).unionByName(
        last_epochs(plan.where((F.col("epoch") > F.col("whole")) & (F.col("rest") > 0)), filed.select("s", "b", "p", "tokens"), seed))
    given = given.select(F.col("s").alias("s2"), F.col("b").alias("b2"), "epoch", "turn", "pieces")
    out = filed.join(given, (F.col("s") == F.col("s2")) & (F.col("b") == F.col("b2")))
    out = out.where(F.col("pieces").isNull() | F.array_contains("pieces", F.col("p")))
    return out.select(*unpacked(names), "tokens", "epoch", "turn")
