"""Mixing sources to target weights by hierarchical budgeting.

The tree has one level per entry of ``levels`` (here domain, language, source) and its leaves are
the distinct paths in the data.  The token budget flows down: every node shares its budget among its children in
proportion to their weights, but no child gets more than its capacity, the tokens below it times ``max_epochs``.
What a child cannot take is shared among its siblings by the same rule, and only what a whole
family cannot take shows at the level above, as a smaller capacity of its ancestor.  All of it is integer
arithmetic, rounded down.  A leaf then takes whole epochs and, of the next epoch, the token-prefix of its
documents in the seeded order of that epoch: documents in order as long as their tokens fit.

The catalogue of nodes, one row per path, is all that windows see; documents only meet sums.  The
end of a prefix is found by summing tokens over 4,096 slices of the order, then over 4,096 slices of the slice
in which the budget ends; a leaf's rows are ordered only inside that last slice, so a leaf with
a third of all rows is never gathered.  The selection is a comparison with the leaf's cut, without shuffling texts.

Null texts count as empty and have 0 tokens; a leaf's documents without tokens come with the prefix they lie in.
Null path values form a node named ``null_name``.  Rows that repeat an id in one leaf share its place in the order and are
taken or left together.  Nodes of weight 0 or less, or of null weight, get nothing
and count for no capacity.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commentloom.llm.common import stored

#: (name, node, weight) for each level from the root; node and weight are expressions over the input's columns.
Level = tuple[str, Column, Column]

KEY_DIGITS = 15  # hexadecimal digits of a place in an epoch's order
_BIG = "decimal(38,0)"


def n_tokens(text: Column) -> Column:
    """Runs of characters other than white space."""
    return F.coalesce(F.regexp_count(text, F.lit("[^ \t\n\f\r]+")), F.lit(0)).cast("bigint")


def place(seed: str, epoch: Column, key: Column) -> Column:
    """A document's place in the order of an epoch, an integer of 60 bits."""
    mark = F.md5(F.concat_ws("|", F.lit(seed), epoch.cast("string"), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(mark, 1, KEY_DIGITS), 16, 10).cast("bigint")


def share_out(children: DataFrame, parent: list[str], node: str, weight: str, capacity: str, budget: str) -> DataFrame:
    """Adds ``share``: each child's part of its parent's ``budget``, at most its capacity, by weight otherwise.

    Children in the order of capacity per weight: as long as the even share of what is left covers a
    child's capacity the child is full, and all behind the last full one share the rest by weight.
    """
    order = Window.partitionBy(*parent).orderBy(F.col(capacity).cast("double") / F.col(weight).cast("double"), node)
    whole = Window.partitionBy(*parent)
    before = F.coalesce(F.sum(capacity).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast(_BIG)
    ahead = F.sum(weight).over(order.rowsBetween(0, Window.unboundedFollowing)).cast(_BIG)
    active = children.where(F.col(weight) > 0).withColumn("_before", before).withColumn("_ahead", ahead)
    full = F.col(capacity).cast(_BIG) * F.col("_ahead") <= F.col(weight).cast(_BIG) * (F.col(budget) - F.col("_before"))
    active = active.withColumn("_full", full)
    rest = F.col(budget) - F.coalesce(F.sum(F.when(F.col("_full"), F.col(capacity))).over(whole), F.lit(0))
    active = active.withColumn("_rest", rest.cast(_BIG))
    active = active.withColumn("_open", F.sum(F.when(~F.col("_full"), F.col(weight))).over(whole).cast(_BIG))
    fair = F.expr(f"CAST(_rest * CAST({weight} AS {_BIG}) AS {_BIG}) div _open")
    shared = F.when(F.col("_full"), F.col(capacity)).otherwise(fair).cast("bigint")
    return active.withColumn("share", shared).drop("_before", "_ahead", "_full", "_rest", "_open")


def budgets(leaves: DataFrame, names: list[str], budget: int, max_epochs: int) -> DataFrame:
    """Leaves (path, w_<level>, tokens) with their ``share`` of the budget in tokens."""
    may = F.least(F.lit(1), *[F.col(f"w_{n}") for n in names]) > 0
    leaves = leaves.withColumn("_cap", F.when(may, F.col("tokens") * max_epochs).otherwise(0).cast("bigint"))
    total = leaves.agg(F.sum("_cap")).first()[0] or 0
    level = leaves.withColumn("_root", F.lit("")).withColumn("_budget", F.lit(min(budget, int(total))).cast("bigint"))
    done = ["_root"]
    for name in names:
        path = [*done, name]
        nodes = level.groupBy(*path).agg(
            F.first(f"w_{name}").alias("_w"), F.sum("_cap").alias("_node_cap"), F.first("_budget").alias("_budget")
        )
        shared = share_out(nodes, done, name, "_w", "_node_cap", "_budget").select(*path, F.col("share").alias("_next"))
        level = level.drop("_budget").join(shared, path).withColumnRenamed("_next", "_budget")
        done = path
    return level.select(*names, "tokens", F.col("_budget").alias("share"))


def _ends(rows: DataFrame, names: list[str], by: str, left: str) -> DataFrame:
    """For each leaf the first value of ``by`` whose tokens no longer fit into ``left``, and what is left before it."""
    slices = rows.groupBy(*names, by).agg(F.sum("_n").alias("_sum"), F.first(left).alias("_left"))
    order = Window.partitionBy(*names).orderBy(by)
    slices = slices.withColumn("_upto", F.sum("_sum").over(order)).where(F.col("_upto") > F.col("_left"))
    first = slices.withColumn("_at", F.row_number().over(order)).where("_at = 1")
    return first.select(*names, F.col(by).alias("_end"), (F.col("_left") - F.col("_upto") + F.col("_sum")).alias("_rest"))


def mix(
    docs: DataFrame,
    levels: list[Level],
    id_col: str = "doc_id",
    text_col: str = "text",
    budget: tuple[int, int] = (3, 5),
    max_epochs: int = 2,
    seed: str = "mix",
    null_name: str = "none",
) -> DataFrame:
    """(_row, _path, _tokens, _epoch): a row for each epoch in which a document is taken.

    ``budget`` is a share of all tokens as a fraction; ``_row`` holds the input's columns and ``_path`` the node names.
    """
    names = [f"_l{i}" for i in range(len(levels))]
    nodes = [F.coalesce(node.cast("string"), F.lit(null_name)).alias(n) for n, (_, node, _) in zip(names, levels, strict=True)]
    weights = [F.coalesce(w, F.lit(0)).cast("bigint").alias(f"w_{n}") for n, (_, _, w) in zip(names, levels, strict=True)]
    narrow = docs.select(docs[id_col].alias("_id"), n_tokens(docs[text_col].cast("string")).alias("_n"), *nodes, *weights)
    narrow, _ = stored(narrow, "mix-tokens")
    leaves = narrow.groupBy(*names).agg(*[F.max(f"w_{n}").alias(f"w_{n}") for n in names], F.sum("_n").alias("tokens"))
    leaves, _ = stored(leaves, "mix-leaves")
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    shares = budgets(leaves, names, total * budget[0] // budget[1], max_epochs)
    whole = F.when(F.col("tokens") > 0, F.expr("share div tokens")).otherwise(F.lit(0)).cast("int")
    plan = shares.withColumn("_whole", whole).withColumn("_part", (F.col("share") - F.col("_whole") * F.col("tokens")).cast("bigint"))
    plan, _ = stored(plan.select(*names, "_whole", "_part"), "mix-plan")
    # Leaves whose prefix ends inside an epoch.
    begun = narrow.join(plan.where("_part > 0"), names).withColumn("_key", place(seed, F.col("_whole") + 1, F.col("_id")))
    begun = begun.withColumn("_s1", F.shiftright("_key", 48)).withColumn("_s2", F.shiftright("_key", 36))
    first = _ends(begun, names, "_s1", "_part").withColumnRenamed("_end", "_s1")
    inside = begun.join(first, [*names, "_s1"])
    second = _ends(inside, names, "_s2", "_rest").select(*names, F.col("_end").alias("_s2"), F.col("_rest").alias("_rest2"))
    last = inside.join(second, [*names, "_s2"])
    cuts = _ends(last, names, "_key", "_rest2").select(*names, F.col("_end").alias("_cut"))
    plan, _ = stored(plan.join(cuts, names, "left"), "mix-cuts")
    path = F.struct(*[F.col(n).alias(name) for n, (name, _, _) in zip(names, levels, strict=True)]).alias("_path")
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("_row"),
        docs[id_col].alias("_id"),
        n_tokens(docs[text_col].cast("string")).alias("_tokens"),
        *nodes,
    ).join(plan, names)
    # No cut although a part is left over would mean that the whole epoch fits, which the division excludes.
    taken = F.col("_whole") + F.when(
        (F.col("_part") > 0) & (place(seed, F.col("_whole") + 1, F.col("_id")) < F.col("_cut")), 1
    ).otherwise(0)
    rows = rows.withColumn("_taken", taken).where("_taken > 0")
    return rows.select("_row", path, "_tokens", F.explode(F.sequence(F.lit(1), F.col("_taken"))).alias("_epoch"))


# The mix of the registered query and of the pipeline.
DOMAINS = {"web": 5, "books": 3, "news": 2, "other": 1}
LANGUAGES = {"en": 6, "de": 2, "fr": 2, "es": 1}


def default_levels(lang: str = "lang", source: str = "source") -> list[Level]:
    """Domain by the number in the source's name, then language, then source."""
    number = F.regexp_extract(F.col(source), "([0-9]{1,9})", 1)
    domain = F.when(F.coalesce(number, F.lit("")) == "", "other").otherwise(
        F.element_at(F.array(*map(F.lit, ["web", "books", "news"])), (F.when(number != "", number).cast("int") % 3 + 1))
    )
    weigh = lambda node, table: F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), node), F.lit(1))
    return [
        ("domain", domain, weigh(domain, DOMAINS)),
        ("language", F.col(lang), weigh(F.coalesce(F.col(lang), F.lit("")), LANGUAGES)),
        ("source", F.col(source), F.lit(1)),
    ]
