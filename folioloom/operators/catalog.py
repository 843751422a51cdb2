"""Relational operators of a catalogue: filters, paging, nesting, upserts, logs, ordered-list rules.

All take and return DataFrames, none collects. Null handling is that of SQL unless a
docstring says otherwise.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioloom.session import materialise


def search(df: DataFrame, text: str, *columns: str) -> DataFrame:
    """Rows one of whose columns holds ``text``, letter case apart; ``%`` and ``_`` stay wildcards."""
    return df.where(reduce(lambda a, b: a | b, [F.col(c).ilike(f"%{text}%") for c in columns]))


def where_all(df: DataFrame, *predicates: Column | None) -> DataFrame:
    """Conjunction of the predicates that are given."""
    given = [p for p in predicates if p is not None]
    return df.where(reduce(and_, given)) if given else df


def page(df: DataFrame, number: int, limit: int, *order: Column) -> DataFrame:
    """One page in a stated order; page numbers from 1, 1 to 100 rows."""
    limit = min(max(limit, 1), 100)
    return df.orderBy(*order).offset((max(number, 1) - 1) * limit).limit(limit)


def ids_from_text(df: DataFrame, csv: str, column: str) -> DataFrame:
    """Rows whose column is one of a comma-separated list of numbers; other entries are skipped."""
    numbers = [int(x) for x in (p.strip() for p in csv.split(",")) if x.lstrip("+-").isdigit()]
    return df.where(F.col(column).isin(numbers))


def parse_time(text: Column) -> Column:
    """A time written in ISO form with ``T`` or with a blank; null if neither."""
    return F.coalesce(F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSX")), F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")))


def anti(left: DataFrame, column: str, *known: DataFrame) -> DataFrame:
    """Rows whose key is in none of the one-column frames ``known``."""
    ids = reduce(lambda a, b: a.union(b), known).distinct().toDF("known_id")
    return left.join(ids, F.col(column) == F.col("known_id"), "left_anti")


def semi(left: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Rows whose key is in the one-column frame ``ids``."""
    return left.join(ids.toDF("wanted_id"), F.col(column) == F.col("wanted_id"), "left_semi")


def nest(parents: DataFrame, key: str, children: DataFrame, child_key: str, order: str, fields: list[str], name: str) -> DataFrame:
    """Parents with an ordered array of child structs; an empty array without children."""
    packed = children.groupBy(F.col(child_key).alias("nest_key")).agg(F.sort_array(F.collect_list(F.struct(order, *[f for f in fields if f != order]))).alias(name))
    empty = F.array().cast(packed.schema[name].dataType)
    return parents.join(packed, F.col(key) == F.col("nest_key"), "left").withColumn(name, F.coalesce(name, empty)).drop("nest_key")


def upsert(stored: DataFrame, patch: DataFrame, key: str) -> DataFrame:
    """Stored rows with a patch merged in by key: given values win, nulls keep what is stored, new keys are added."""
    others = [c for c in stored.columns if c != key]
    p = patch.select(F.col(key).alias("p_key"), *[F.col(c).alias(f"p_{c}") for c in others if c in patch.columns])
    joined = stored.join(p, F.col(key) == F.col("p_key"), "full_outer")
    merged = [F.coalesce(F.col(f"p_{c}"), F.col(c)).alias(c) if c in patch.columns else F.col(c) for c in others]
    return joined.select(F.coalesce(key, "p_key").alias(key), *merged)


def partial_update(stored: DataFrame, patch: DataFrame, key: str, allowed: list[str]) -> DataFrame:
    """Stored rows with the allowed columns of a patch merged in by key; nulls keep what is stored, unknown keys and other columns are ignored."""
    given = [c for c in allowed if c in patch.columns and c in stored.columns and c != key]
    p = patch.dropDuplicates([key]).select(F.col(key).alias("p_key"), *[F.col(c).alias(f"p_{c}") for c in given])
    joined = stored.join(p, F.col(key) == F.col("p_key"), "left")
    return joined.select(*[F.coalesce(f"p_{c}", c).alias(c) if c in given else F.col(c) for c in stored.columns])


def with_log(stored: DataFrame, patch: DataFrame, key: str, fields: list[str], stamp: Column) -> tuple[DataFrame, DataFrame]:
    """The stored rows after a patch, and one log row (key, field, old_value, new_value, at) for each field that it changes."""
    return partial_update(stored, patch, key, fields), change_log(stored, patch, key, fields).withColumn("at", stamp)


def new_rows(keys: DataFrame, active: DataFrame, key: str, **values: Column) -> DataFrame:
    """Rows with a fresh id and the given values for every key that no active row holds, each key once."""
    fresh = keys.select(key).where(F.col(key).isNotNull()).distinct()
    open_keys = active.select(F.col(key).alias("a_key")).distinct()
    return fresh.join(open_keys, F.col(key) == F.col("a_key"), "left_anti").select(F.uuid().alias("id"), key, *[v.alias(n) for n, v in values.items()])


def within_budget(rows: DataFrame, page: str, order: list[str], budget: int) -> DataFrame:
    """The first rows in page order that a budget leaves, with ``budget_before``, what was left when their page began.

    Pages are counted first, so only rows of pages that the budget reaches are numbered.
    """
    sizes = rows.groupBy(F.col(page).alias("s_page")).agg(F.count("*").alias("on_page"))
    before = F.coalesce(F.sum("on_page").over(Window.orderBy("s_page").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row per page
    reached = sizes.withColumn("budget_before", F.lit(budget) - before).where("budget_before > 0").drop("on_page")
    place = F.row_number().over(Window.partitionBy(page).orderBy(*order))
    return rows.join(reached, F.col(page) == F.col("s_page")).drop("s_page").withColumn("place", place).where("place <= budget_before").drop("place")


def insert_ignore(stored: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Stored rows and those of the batch whose key is new; of equal new keys one stays."""
    fresh = batch.dropDuplicates([key]).join(stored.select(F.col(key).alias("s_key")), F.col(key) == F.col("s_key"), "left_anti")
    return stored.unionByName(fresh.select(*stored.columns))


def conflicts(stored: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the batch whose unique key is taken."""
    taken = stored.select(*[F.col(k).alias(f"s_{k}") for k in keys]).distinct()
    return batch.join(taken, reduce(and_, [F.col(k) == F.col(f"s_{k}") for k in keys]), "left_semi")


def shared_keys(rows: DataFrame, row_id: str, keys: list[str]) -> DataFrame:
    """Rows whose unique key another id holds too; keys with a null part are no conflict."""
    whole = reduce(and_, [F.col(k).isNotNull() for k in keys])
    w = Window.partitionBy(*keys)
    return rows.where(whole).withColumn("several", F.min(row_id).over(w) != F.max(row_id).over(w)).where("several").drop("several")


def replace_children(stored: DataFrame, batch: DataFrame, parent: str) -> DataFrame:
    """Children with those of every parent in the batch replaced by the batch's."""
    parents = batch.select(F.col(parent).alias("b_parent")).distinct()
    return stored.join(parents, F.col(parent) == F.col("b_parent"), "left_anti").unionByName(batch)


def set_values(stored: DataFrame, key: str, ids: DataFrame, **values: Column) -> DataFrame:
    """Stored rows with columns set where the key is in ``ids``."""
    marks = ids.toDF("m_key").distinct().withColumn("hit", F.lit(True))
    joined = stored.join(marks, F.col(key) == F.col("m_key"), "left")
    return joined.select(*[F.when(F.col("hit"), values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in stored.columns])


def change_log(old: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, field, old_value, new_value) of every tracked field that a patch changes; null in the patch means not given."""
    n = new.select(F.col(key).alias("n_key"), *[F.col(f).cast("string").alias(f"n_{f}") for f in fields])
    each = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("old_value"), F.col(f"n_{f}").alias("new_value")) for f in fields])
    changed = old.join(n, F.col(key) == F.col("n_key")).select(key, F.explode(each).alias("x")).select(key, "x.*")
    return changed.where("new_value is not null and not (old_value <=> new_value)")


def renumber(df: DataFrame, group: str, *order: Column, name: str = "position") -> DataFrame:
    """Dense numbers from 1 within a group."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(group).orderBy(*order)))


def first_of_equal(df: DataFrame, group: str, key: Column, *order: Column) -> DataFrame:
    """First row of every equal key within a group; rows with an empty or null key go."""
    keyed = df.withColumn("equal_key", key).where("equal_key != ''")
    rank = F.row_number().over(Window.partitionBy(group, "equal_key").orderBy(*order))
    return keyed.withColumn("equal_rank", rank).where("equal_rank = 1").drop("equal_key", "equal_rank")


def edge_trim(df: DataFrame, group: str, droppable: Column, order: list[Column], most: int = 3, keep_over: int = 3) -> DataFrame:
    """Without droppable rows at either end of a group, at most ``most`` a side, only in groups of more than ``keep_over``."""
    ahead = Window.partitionBy(group).orderBy(*order)
    behind = Window.partitionBy(group).orderBy(*[c.desc() for c in order])
    upto = ahead.rowsBetween(Window.unboundedPreceding, 0)
    from_end = behind.rowsBetween(Window.unboundedPreceding, 0)
    marked = df.withColumn("can_go", droppable.cast("int")).select(
        "*",
        F.row_number().over(ahead).alias("from_start_no"),
        F.row_number().over(behind).alias("from_end_no"),
        F.min("can_go").over(upto).alias("all_before"),
        F.min("can_go").over(from_end).alias("all_after"),
        F.count("*").over(Window.partitionBy(group)).alias("size_of_group"),
    )
    head = (F.col("all_before") == 1) & (F.col("from_start_no") <= most)
    tail = (F.col("all_after") == 1) & (F.col("from_end_no") <= most) & ~head
    kept = marked.withColumn("goes", (F.col("size_of_group") > keep_over) & (head | tail)).withColumn("left_over", F.sum((~F.col("goes")).cast("int")).over(Window.partitionBy(group)))
    out = kept.where("not goes or left_over = 0")
    return out.drop("can_go", "from_start_no", "from_end_no", "all_before", "all_after", "size_of_group", "goes", "left_over")


def sequence_gaps(df: DataFrame, group: str, number: str) -> DataFrame:
    """(group, missing): the number after which a sequence of three or more skips."""
    order = Window.partitionBy(group).orderBy(number)
    numbered = df.where(F.col(number).isNotNull()).select(group, F.col(number), F.lag(number).over(order).alias("before"), F.count("*").over(Window.partitionBy(group)).alias("many"))
    return numbered.where((F.col("many") >= 3) & (F.col(number) - F.col("before") > 1)).select(group, (F.col("before") + 1).alias("missing"))


def best_and_runner_up(scored: DataFrame, group: str, score: str, item: str) -> DataFrame:
    """(group, best, best_score, runner_up, runner_score); ties go to the smaller item."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.col(score).desc(), F.col(item)))
    top = scored.withColumn("rank", rank).where("rank <= 2")
    at = lambda n, c: F.max(F.when(F.col("rank") == n, F.col(c)))
    return top.groupBy(group).agg(at(1, item).alias("best"), at(1, score).alias("best_score"), at(2, item).alias("runner_up"), at(2, score).alias("runner_score"))


def top_two_matches(items: DataFrame, key: str, tokens: str, others: DataFrame | None = None, steps: tuple[float, ...] = (0.5, 0.0)) -> DataFrame:
    """(key, best, best_score, runner_up, runner_score): for each item the two others with the most similar token sets (Jaccard).

    ``others`` has the same columns; by default the items are matched among themselves.

    Exact, by prefix filtering: sets as similar as a bound share one of their rarest
    ``n - bound * n + 1`` tokens, so only these meet in the equi-join. An item with two
    matches at the first bound is done; the others go on to the next, the last being any
    shared token. Common tokens thus bring pairs together only for items with nothing better.
    """
    among = others is None
    both = items.select(F.lit(True).alias("mine"), F.col(key).alias("item"), tokens)
    both = both if among else both.unionByName(others.select(F.lit(False).alias("mine"), F.col(key).alias("item"), tokens))
    spread = both.select("mine", "item", F.explode(F.array_distinct(tokens)).alias("token"))
    uses = spread.groupBy(F.col("token").alias("u_token")).agg(F.count("*").alias("uses"))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("uses", "token"))), lambda x: x["token"])
    sets = materialise(spread.join(uses, F.col("token") == F.col("u_token")).groupBy("mine", "item").agg(ordered.alias("held")), "sets")
    right = sets.where(F.col("mine") == among).select(F.col("item").alias("other"), F.col("held").alias("other_held"))
    left, found = sets.where("mine").drop("mine"), None
    apart = F.col("item") != F.col("other") if among else F.lit(True)
    for at, bound in enumerate(steps):
        if bound:
            prefix = lambda c, b=bound: F.explode(F.slice(c, 1, (F.size(c) - F.ceil(F.size(c) * F.lit(b)) + 1).cast("int")))
            a, b = left.select("item", "held", prefix("held").alias("token")), right.select("other", "other_held", prefix("other_held").alias("o_token"))
            pairs = a.join(b, (F.col("token") == F.col("o_token")) & apart).dropDuplicates(["item", "other"])
            shared = F.size(F.array_intersect("held", "other_held"))
            scored = pairs.select("item", "other", (shared / (F.size("held") + F.size("other_held") - shared)).alias("score")).where(F.col("score") >= bound)
            met = materialise(scored, f"matches{at}")
            done = met.groupBy(F.col("item").alias("d_item")).agg(F.count("*").alias("n")).where("n >= 2").select("d_item")
            kept = met.join(done, F.col("item") == F.col("d_item"), "left_semi")
            left = left.join(done, F.col("item") == F.col("d_item"), "left_anti")
        else:  # every shared token meets, so their number is that of the joined rows
            a, b = left.select("item", F.size("held").alias("n"), F.explode("held").alias("token")), right.select("other", F.size("other_held").alias("o_n"), F.explode("other_held").alias("o_token"))
            shared = a.join(b, (F.col("token") == F.col("o_token")) & apart).groupBy("item", "other", "n", "o_n").agg(F.count("*").alias("both"))
            kept = shared.select("item", "other", (F.col("both") / (F.col("n") + F.col("o_n") - F.col("both"))).alias("score"))
        found = kept if found is None else found.unionByName(kept)
    return best_and_runner_up(found, "item", "score", "other").withColumnRenamed("item", key)


def multiset_difference(left: DataFrame, right: DataFrame, group: str, item: str) -> DataFrame:
    """(group, difference): sum of count differences over sum of counts of two multisets; 1 if both are empty."""
    a = left.groupBy(F.col(group).alias("a_group"), F.col(item).alias("a_item")).agg(F.count("*").alias("a"))
    b = right.groupBy(F.col(group).alias("b_group"), F.col(item).alias("b_item")).agg(F.count("*").alias("b"))
    both = a.join(b, (F.col("a_group") == F.col("b_group")) & (F.col("a_item") == F.col("b_item")), "full_outer")
    x, y = F.coalesce("a", F.lit(0)), F.coalesce("b", F.lit(0))
    return both.groupBy(F.coalesce("a_group", "b_group").alias(group)).agg((F.sum(F.abs(x - y)) / F.sum(x + y)).alias("difference"))


def gap_bonus(counts: DataFrame, targets: DataFrame, key: str, count: str, target: str, most: int = 300) -> DataFrame:
    """(key, bonus) of the categories below their share of the targets: ``most`` times the part of the share that is missing, rounded.

    Categories without a count have none yet; those at or above their share are left out.
    ``counts`` and ``targets`` have one row per category.
    """
    total = counts.agg(F.sum(count).alias("total"))
    whole = targets.agg(F.sum(target).alias("whole"))
    named = targets.select(F.col(key).alias("g_key"), F.col(target).alias("g_target"))
    joined = named.join(counts, F.col("g_key") == F.col(key), "left").crossJoin(F.broadcast(total)).crossJoin(F.broadcast(whole))  # one row of totals each
    aim = F.lit(100.0) / (F.col("whole") / F.col("g_target"))
    gap = F.greatest(F.lit(0.0), aim - F.coalesce(count, F.lit(0)) * 100.0 / F.col("total"))
    bonus = F.floor(gap / aim * most + F.lit(0.5))
    return joined.select(F.col("g_key").alias(key), F.least(bonus, F.lit(most)).cast("long").alias("bonus")).where("bonus > 0")


def segment_ends(df: DataFrame, group: str, offset: str, total: Column) -> DataFrame:
    """Each offset with the next larger one of its group, or the total; equal offsets share an end."""
    own = df.select(F.col(group).alias("e_group"), F.col(offset).alias("e_offset")).distinct()
    nexts = own.withColumn("segment_end", F.lead("e_offset").over(Window.partitionBy("e_group").orderBy("e_offset")))
    joined = df.join(nexts, (F.col(group) == F.col("e_group")) & (F.col(offset) == F.col("e_offset")))
    return joined.withColumn("segment_end", F.coalesce("segment_end", total)).drop("e_group", "e_offset")


def stop_after_known(pages: DataFrame, number: str, all_known: str, run: int) -> DataFrame:
    """Pages up to the first run of ``run`` consecutive pages that bring nothing new.

    ``pages`` has one row per page and is small beside the rows it stands for; its order is global.
    """
    order = Window.orderBy(number)
    marked = pages.withColumn("island", F.sum((~F.col(all_known)).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    counted = marked.withColumn("streak", F.sum(F.col(all_known).cast("int")).over(Window.partitionBy("island").orderBy(number).rowsBetween(Window.unboundedPreceding, 0)))
    reached = counted.withColumn("stopped", F.max((F.col("streak") >= run).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, -1)))
    return reached.where(F.coalesce("stopped", F.lit(0)) == 0).drop("island", "streak", "stopped")


def fill_down(df: DataFrame, group: str, order: str, column: str, name: str) -> DataFrame:
    """The last non-null value so far within a group."""
    return df.withColumn(name, F.last(column, ignorenulls=True).over(Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)))


def sanitize_path(path: Column) -> Column:
    """A path without empty and ``.`` parts, with ``..`` taking the part before it away."""
    parts = F.aggregate(
        F.split(path, "/"),
        F.array().cast("array<string>"),
        lambda acc, x: F.when(x == "..", F.when(F.size(acc) > 0, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc)).when((x == ".") | (x == ""), acc).otherwise(F.concat(acc, F.array(x))),
    )
    return F.array_join(parts, "/")
