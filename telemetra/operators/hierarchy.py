"""Parent-pointer hierarchy: root resolution and the unit-id backfill.

``process(process_id, level)``: ``level`` holds the parent's id, or ``'root'``.
Walking from a start node (index 0) upward, the outcome is decided at the first index
≤ MAX_DEPTH−1 where one of these happens: the node was already visited (``cycle``), the
node does not exist (``missing``), the node has no level (``null_level``), the node's level
is ``'root'`` (ok → its id is the unit). Otherwise the walk fails with ``depth``.

Set-at-a-time resolution by pointer doubling: after round k every open node knows its
ancestor 2^k hops up, closed nodes know their terminal and its distance. 7 rounds cover
128 ≥ MAX_DEPTH hops whatever the number of nodes. Each round is one join; every third
round is cut by staging the state as a table in the checkpoint folder (the self-join
doubles the plan per round). Nodes still
open after that are on, or lead into, a cycle (or a chain longer than 128): their first
128 ancestors are gathered by the same doubling over arrays — at most 128 ids per node,
only for these error nodes — and the first repeat within the first MAX_DEPTH nodes means
``cycle`` at that index.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from telemetra.session import materialize, release

from telemetra.constants import (
    MAX_DEPTH, OUTCOME_ERROR, OUTCOME_SKIPPED, OUTCOME_UPDATED, ROOT_LEVEL,
)
from telemetra.operators.filters import changed

ROUNDS = 7  # 2**7 = 128 >= MAX_DEPTH


def _nodes(process: DataFrame) -> DataFrame:
    return (process.select(F.col("process_id").cast("string").alias("node"),
                           F.col("level").cast("string").alias("level"))
                   .where(F.col("node").isNotNull())
                   .groupBy("node").agg(F.first("level", ignorenulls=True).alias("level")))


def _initial_state(process: DataFrame) -> DataFrame:
    nodes = _nodes(process)
    present = nodes.select(F.col("node").alias("_p"))
    s = nodes.join(present, nodes["level"] == present["_p"], "left")
    kind = (F.when(F.col("level") == ROOT_LEVEL, F.lit("root"))
             .when(F.col("level").isNull(), F.lit("null_level"))
             .when(F.col("_p").isNull(), F.lit("missing")))
    anc = F.when(F.col("level") == ROOT_LEVEL, F.col("node")).when(F.col("level").isNull(), F.col("node")) \
           .otherwise(F.col("level"))
    dist = F.when((F.col("level") == ROOT_LEVEL) | F.col("level").isNull(), F.lit(0)).otherwise(F.lit(1))
    # path = the nodes walked so far (indices 0 .. dist-1); kept only while the node is open
    path = F.when(kind.isNull(), F.array(F.col("node")))
    return s.select("node", anc.alias("anc"), dist.alias("dist"), kind.alias("kind"), path.alias("path"))


def _double(state: DataFrame) -> DataFrame:
    closed = state.where(F.col("kind").isNotNull())
    open_ = state.where(F.col("kind").isNull()).alias("o")
    # the state is a staged parquet table: the planner sees its real size and broadcasts it
    # only under spark.sql.autoBroadcastJoinThreshold (AQE re-checks at run time); a larger
    # state is a shuffle join with AQE skew splitting for hot ancestors
    right = state.select(F.col("node").alias("r_node"), F.col("anc").alias("r_anc"),
                         F.col("dist").alias("r_dist"), F.col("kind").alias("r_kind"),
                         F.col("path").alias("r_path"))
    stepped = (open_.join(right, F.col("o.anc") == F.col("r_node"), "inner")
                    .select(F.col("o.node").alias("node"), F.col("r_anc").alias("anc"),
                            (F.col("o.dist") + F.col("r_dist")).alias("dist"),
                            F.col("r_kind").alias("kind"),
                            F.when(F.col("r_kind").isNull(), F.concat(F.col("o.path"), F.col("r_path")))
                             .alias("path")))
    return closed.unionByName(stepped)


def resolve_roots(process: DataFrame) -> DataFrame:
    """For every process: ``unit_id`` (its root) or ``error`` in
    {cycle, missing, null_level, depth}, plus ``depth`` = index of the deciding node."""
    return _outcomes(_doubled(_initial_state(process)))


def _doubled(state: DataFrame) -> DataFrame:
    """The state after as many rounds as it takes to close it, or all of them."""
    state = state.transform(materialize)
    staged = state
    for r in range(ROUNDS):
        state = _double(state)
        # lineage is cut every third round (the plan holds at most 8 copies of the last
        # staged table in between); early exit once no node is open
        if r % 3 == 2 or r == ROUNDS - 1:
            state = state.transform(materialize)
            release(staged)          # the previous stage is no longer read
            staged = state
            if state.where(F.col("kind").isNull()).isEmpty():
                break
    return state


def _outcomes(state: DataFrame) -> DataFrame:
    limit = MAX_DEPTH - 1
    within = F.col("dist") <= limit
    # still open after 128 hops: the walk's ids are all distinct up to its first revisit and
    # every later id repeats one of them, so the first revisit index equals the number of
    # distinct ids among the first MAX_DEPTH (when that is below MAX_DEPTH) → cycle
    distinct_head = F.size(F.array_distinct(F.slice(F.col("path"), 1, MAX_DEPTH)))
    revisit = F.when(distinct_head < MAX_DEPTH, distinct_head)
    is_open = F.col("kind").isNull()
    ok = (F.col("kind") == "root") & within
    return state.select(
        F.col("node").alias("process_id"),
        F.when(ok, F.col("anc")).alias("unit_id"),
        F.when(ok, F.lit(None).cast("string"))
         .when(is_open & revisit.isNotNull(), F.lit("cycle"))
         .when(~is_open & within, F.col("kind"))
         .otherwise(F.lit("depth")).alias("error"),
        F.when(is_open, F.coalesce(revisit, F.lit(MAX_DEPTH)))
         .otherwise(F.least(F.col("dist"), F.lit(MAX_DEPTH))).cast("int").alias("depth"))


def affected_nodes(process: DataFrame, previous: DataFrame, changed_ids: DataFrame) -> DataFrame:
    """(node): the changed processes and all that lead up to one of them.

    One look at the whole table narrows it to the nodes whose root was that of a changed one,
    or that had none; from there the children of the last step's nodes are added until there
    are no new ones, reading that part only.
    """
    ids = changed_ids.select(F.col("process_id").cast("string").alias("node")).where("node IS NOT NULL").distinct().transform(materialize)
    units = previous.join(ids, previous["process_id"] == ids["node"], "left_semi").where("unit_id IS NOT NULL").select(F.col("unit_id").alias("_u")).distinct()
    near = previous.join(units, previous["unit_id"] == units["_u"], "left_semi").unionByName(previous.where("unit_id IS NULL")).select("process_id")
    part = _nodes(process).join(near, F.col("node") == near["process_id"], "left_semi").transform(materialize)
    found = front = ids
    while not front.isEmpty():
        up = front.select(F.col("node").alias("_p"))
        front = part.join(up, part["level"] == up["_p"], "left_semi").select("node").join(found, "node", "left_anti").transform(materialize)
        found = found.union(front).transform(materialize)
    release(part)
    return found


def update_roots(process: DataFrame, previous: DataFrame, changed_ids: DataFrame) -> DataFrame:
    """J2 after a change of few processes: ``resolve_roots(process)``, from its ``previous`` result.

    ``changed_ids`` has the ``process_id`` of every process that is new, gone or has another
    level. Only those and the nodes below them are resolved again; a walk that comes to a
    node that is not affected ends there and takes over what is known of it.
    """
    touched = affected_nodes(process, previous, changed_ids)
    nodes = _nodes(process).join(touched, "node", "left_semi").transform(materialize)
    known = previous.select(F.col("process_id").alias("_k"), F.col("unit_id").alias("_unit"), F.col("error").alias("_error"), F.col("depth").alias("_depth"))
    known = known.join(touched, known["_k"] == touched["node"], "left_anti").join(nodes.select(F.col("level").alias("_l")).distinct(), F.col("_k") == F.col("_l"), "left_semi").transform(materialize)
    begin = _initial_state(nodes.select(F.col("node").alias("process_id"), "level"))
    begin = begin.join(known.select("_k"), begin["anc"] == known["_k"], "left")
    closed = F.when((F.col("kind") == "missing") & F.col("_k").isNotNull(), F.lit("known")).otherwise(F.col("kind"))
    state = _doubled(begin.select("node", "anc", "dist", closed.alias("kind"), "path"))
    own = _outcomes(state.where("kind IS NULL OR kind <> 'known'"))
    met = state.where("kind = 'known'").join(known, F.col("anc") == F.col("_k"))
    depth = F.least(F.col("dist") + F.col("_depth"), F.lit(MAX_DEPTH))
    late = depth >= MAX_DEPTH
    taken = met.select(F.col("node").alias("process_id"), F.when(~late, F.col("_unit")).alias("unit_id"),
                       F.when(late, F.lit("depth")).otherwise(F.col("_error")).alias("error"), depth.cast("int").alias("depth"))
    rest = previous.join(touched, previous["process_id"] == touched["node"], "left_anti")
    return rest.unionByName(own).unionByName(taken)


def lookup_configs(configs: DataFrame, roots: DataFrame) -> DataFrame:
    """Each config finds its process's resolution; a process that does not exist is
    an error row (``missing`` at index 0), never a dropped config."""
    r = roots.select(F.col("process_id").alias("_pid"), F.col("unit_id").alias("resolved_unit_id"),
                     F.col("error").alias("_err"))
    out = configs.join(r, configs["process_id"] == r["_pid"], "left")
    return (out.withColumn("error", F.when(F.col("_pid").isNull(), F.lit("missing"))
                                     .otherwise(F.col("_err")))
               .drop("_pid", "_err"))


def backfill_outcomes(resolved_configs: DataFrame) -> DataFrame:
    """P21 + E3: ``outcome`` per config: error / skipped (already right) / updated."""
    return resolved_configs.withColumn(
        "outcome",
        F.when(F.col("error").isNotNull(), F.lit(OUTCOME_ERROR))
         .when(changed("resolved_unit_id", "unit_id"), F.lit(OUTCOME_UPDATED))
         .otherwise(F.lit(OUTCOME_SKIPPED)))


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    """A10: number of configs per outcome."""
    return outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def change_set(outcomes: DataFrame) -> DataFrame:
    """The rows to write: key (process_id, created_at) and the new unit_id."""
    return (outcomes.where(F.col("outcome") == OUTCOME_UPDATED)
                    .select("process_id", "created_at", F.col("resolved_unit_id").alias("new_unit_id")))


def apply_updates(configs: DataFrame, changes: DataFrame) -> DataFrame:
    """Set ``unit_id`` on the rows whose key is in the change set; other rows unchanged."""
    out = configs.join(changes, ["process_id", "created_at"], "left")
    return (out.withColumn("unit_id", F.coalesce(F.col("new_unit_id"), F.col("unit_id")))
               .drop("new_unit_id").select(*configs.columns))
