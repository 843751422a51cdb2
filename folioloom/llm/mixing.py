"""Documents of several sources combined so that each source gives a target share.

Method. Temperature mixing: the weights of the sources are token shares raised to an
exponent and normalised; the exponent is found by bisection. With a target entropy it is
that of the natural token shares at which the weights reach it (``entropy_weights``). With
stated target shares the weights are these, tempered towards the shares of the room that
the repetition limits leave as far as the total asked for needs (``plan``): exponent 1 is
the targets themselves and holds while no limit is met; a larger total lowers it. Without a
total asked for, the total is the largest at which exponent 1 is within reach. The weights
are realised as budgeted block permutations: every source's texts stand in a fixed
pseudo-random order of blocks; whole passes repeat all texts, the last pass takes blocks up
to the budget, then texts of the block at the budget, and last the one text left that fits
the rest best.

Equal texts are one text: it is used at most ``max_repeats`` times under its least id, and
copies are left out before anything is encoded. Sizes are tokens of a public tokenizer.
Only sums by source reach the driver; a block holds about ``BLOCK_TEXTS`` texts whatever
the size of its source, and only the block at the budget is ordered.

Defined results: null, empty and blank texts are not chosen; source names are compared
without case and outer blanks; a source without texts gets nothing and its share is
reported as 0; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioloom.llm import tokenizer
from folioloom.session import materialise

#: Texts of one block, about.
BLOCK_TEXTS = 1024


def tempered(base: dict[str, float], pull: dict[str, float], exponent: float) -> dict[str, float]:
    """Normalised base^exponent * pull^(1 - exponent)."""
    raw = {s: (base[s] ** exponent) * (pull[s] ** (1 - exponent)) if base[s] > 0 and pull[s] > 0 else 0.0 for s in base}
    total = sum(raw.values()) or 1.0
    return {s: v / total for s, v in raw.items()}


def entropy(shares: dict[str, float]) -> float:
    return -sum(p * math.log(p) for p in shares.values() if p > 0)


def bisect_exponent(fits: Callable[[float], bool], low: float = 0.0, high: float = 1.0, rounds: int = 60) -> float:
    """The largest exponent in [low, high] that fits, for a condition that fails above some point."""
    if fits(high):
        return high
    for _ in range(rounds):
        middle = (low + high) / 2
        low, high = (middle, high) if fits(middle) else (low, middle)
    return low


def entropy_weights(natural: dict[str, float], target_entropy: float) -> dict[str, float]:
    """Weights natural^exponent whose entropy is the target (uniform if even that has less)."""
    flat = {s: 1.0 if p > 0 else 0.0 for s, p in natural.items()}
    exponent = bisect_exponent(lambda e: entropy(tempered(natural, flat, e)) >= target_entropy, 0.0, 8.0)
    return tempered(natural, flat, exponent)


def plan(tokens: dict[str, int], target: dict[str, float], repeats: dict[str, int], total: float | None = None, stretch: float = 1.0) -> dict[str, float]:
    """Token budget of each source; ``stretch`` multiplies the total that is within reach, where none is asked for."""
    room = {s: tokens.get(s, 0) * max(0, repeats[s]) for s in target}
    live = {s: target[s] for s in target if target[s] > 0 and room[s] > 0}
    whole = sum(live.values())
    if not live:
        return {s: 0.0 for s in target}
    live = {s: p / whole for s, p in live.items()}
    reach = min(room[s] / live[s] for s in live)
    total = min(total or reach * stretch, sum(room[s] for s in live))
    pull = {s: room[s] / sum(room[x] for x in live) for s in live}
    exponent = bisect_exponent(lambda e: all(total * w <= room[s] * (1 + 1e-9) for s, w in tempered(live, pull, e).items()))
    weights = tempered(live, pull, exponent)
    return {s: min(float(room[s]), total * weights.get(s, 0.0)) for s in target}


def _texts(documents: DataFrame, targets: DataFrame, tokenizers: str) -> DataFrame:
    """(source, doc_id, text_key, n_tokens): each distinct text of the target sources once, under its least id."""
    wanted = targets.select(F.lower(F.trim("source")).alias("source"), "target_share", "max_repeats").where("source is not null").dropDuplicates(["source"])
    named = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower(F.trim("source")).alias("in_source"), "text").where("trim(text) != '' and doc_id is not null")
    own = named.join(wanted.select("source"), F.col("in_source") == F.col("source"), "left_semi").withColumn("text_key", F.md5("text"))
    ids = own.select("doc_id", "text_key")
    several = ids.groupBy(F.col("text_key").alias("s_key")).agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least != most")
    # as a table its size is known, so few copies cost no shuffle of the texts
    copies = materialise(ids.join(several, F.col("text_key") == F.col("s_key")).where("doc_id != least").select(F.col("doc_id").alias("c_id"), F.col("text_key").alias("c_key")).distinct(), "copies")
    firsts = own.join(copies, (F.col("doc_id") == F.col("c_id")) & (F.col("text_key") == F.col("c_key")), "left_anti")
    sized = tokenizer.encode_tagged(firsts.select("doc_id", F.concat_ws("\u0001", "in_source", "text_key").alias("tag"), "text"), tokenizers)
    parts = F.split("tag", "\u0001")
    rows = sized.select("doc_id", parts[0].alias("source"), parts[1].alias("text_key"), F.size("ids").cast("long").alias("n_tokens")).where("n_tokens > 0")
    once = rows.groupBy("text_key").agg(F.min(F.struct("doc_id", "source", "n_tokens")).alias("x"))
    return once.select("x.source", "x.doc_id", "text_key", "x.n_tokens")


def mix(
    documents: DataFrame, targets: DataFrame, total: float | None = None, tokenizers: str = tokenizer.TOKENIZERS, stretch: float = 1.0, target_entropy: float | None = None
) -> DataFrame:
    """(doc_id, source, n_tokens, repeats, target_share, reached_share) of the chosen documents.

    ``target_entropy`` takes weights of that entropy from the natural token shares in place of
    the stated shares; ``target_share`` is then the weight.
    """
    spark = documents.sparkSession
    sized = materialise(_texts(documents, targets, tokenizers), "mix")
    aims = {r.source: r for r in targets.select(F.lower(F.trim("source")).alias("source"), "target_share", "max_repeats").where("source is not null and target_share is not null").dropDuplicates(["source"]).collect()}
    sums = {r.source: r for r in sized.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("texts")).collect()}
    tokens = {s: r.tokens for s, r in sums.items()}
    shares = {s: float(a.target_share) for s, a in aims.items()}
    if target_entropy is not None:
        whole = sum(tokens.get(s, 0) for s in aims) or 1
        shares = entropy_weights({s: tokens.get(s, 0) / whole for s in aims}, target_entropy)
    caps = {s: 1 if a.max_repeats is None else int(a.max_repeats) for s, a in aims.items()}
    budgets = plan(tokens, shares, caps, total, stretch)
    rows = []
    for s, budget in budgets.items():
        passes = int((budget + 0.5) // tokens[s]) if tokens.get(s) else 0
        blocks = sums[s].texts // BLOCK_TEXTS + 1 if s in sums else 1
        rows.append((s, shares[s], passes, max(0.0, budget - passes * tokens.get(s, 0)), caps[s], blocks))
    if not rows:
        return sized.select("doc_id", "source", "n_tokens", F.lit(0).alias("repeats"), F.lit(0.0).alias("target_share"), F.lit(0.0).alias("reached_share")).limit(0)
    budget_rows = F.broadcast(spark.createDataFrame(rows, "b_source string, target_share double, passes int, rest double, cap int, blocks long"))  # one row per target source

    order = F.xxhash64("text_key", F.lit(20))
    texts = sized.join(budget_rows, F.col("source") == F.col("b_source")).withColumn("place", order).withColumn("block", F.pmod(order, F.col("blocks")))
    by_block = texts.groupBy("source", "block").agg(F.sum("n_tokens").alias("tokens"))
    before = F.sum("tokens").over(Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    placed = by_block.select(F.col("source").alias("k_source"), F.col("block").alias("k_block"), F.col("tokens").alias("block_tokens"), F.coalesce(before, F.lit(0)).alias("start"))
    joined = texts.join(placed, (F.col("source") == F.col("k_source")) & (F.col("block") == F.col("k_block")))
    whole_block = F.col("start") + F.col("block_tokens") <= F.col("rest")
    split_block = ~whole_block & (F.col("start") < F.col("rest"))
    marked = joined.withColumn("whole", whole_block).withColumn("edge", split_block)
    inside = Window.partitionBy("source", "block").orderBy("place", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    edge = materialise(marked.where("edge").withColumn("upto", F.col("start") + F.sum("n_tokens").over(inside)).withColumn("taken", F.col("upto") <= F.col("rest")), "edge")
    left = edge.groupBy(F.col("source").alias("l_source")).agg(F.max("rest").alias("l_rest"), F.coalesce(F.max(F.when(F.col("taken"), F.col("upto"))), F.min("start")).alias("used"))
    gap = F.col("l_rest") - F.col("used")
    open_texts = marked.where("not edge and not whole").select("source", "doc_id", "n_tokens").unionByName(edge.where("not taken").select("source", "doc_id", "n_tokens"))
    fit = open_texts.join(F.broadcast(left), F.col("source") == F.col("l_source")).where(F.abs(F.col("n_tokens") - gap) < gap)  # one row per target source
    best = fit.groupBy(F.col("source").alias("f_source")).agg(F.min_by("doc_id", F.struct(F.abs(F.col("n_tokens") - gap).alias("off"), "doc_id")).alias("f_doc"))
    columns = ("doc_id", "source", "n_tokens", "target_share", "cap", "passes")
    last_pass = edge.select(*columns, "taken").unionByName(marked.where("not edge").select(*columns, F.col("whole").alias("taken")))
    fitted = last_pass.join(F.broadcast(best), (F.col("source") == F.col("f_source")) & (F.col("doc_id") == F.col("f_doc")), "left")
    repeats = F.least(F.col("cap"), F.col("passes") + (F.col("taken") | F.col("f_doc").isNotNull()).cast("int"))
    chosen = materialise(fitted.select("doc_id", "source", "n_tokens", "target_share", repeats.alias("repeats")).where("repeats > 0"), "chosen")
    sums = chosen.groupBy(F.col("source").alias("s_source")).agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("s_tokens"))
    all_tokens = sums.agg(F.sum("s_tokens").alias("all_tokens"))
    reached = sums.crossJoin(F.broadcast(all_tokens)).select("s_source", (F.col("s_tokens") / F.col("all_tokens")).alias("reached_share"))  # one row of totals
    return chosen.join(F.broadcast(reached), F.col("source") == F.col("s_source")).select("doc_id", "source", "n_tokens", "repeats", "target_share", "reached_share")


def reached_shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, reached_share, documents, tokens) of every target source."""
    got = mixed.groupBy(F.col("source").alias("g_source")).agg(F.max("reached_share").alias("reached_share"), F.count("*").alias("documents"), F.sum(F.col("n_tokens") * F.col("repeats")).alias("tokens"))
    named = targets.select(F.lower(F.trim("source")).alias("source"), "target_share").where("source is not null").dropDuplicates(["source"])
    return named.join(got, F.col("source") == F.col("g_source"), "left").select(
        "source", "target_share", F.coalesce("reached_share", F.lit(0.0)).alias("reached_share"), F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("tokens", F.lit(0)).alias("tokens")
    )
