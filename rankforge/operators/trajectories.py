"""Trajectory operators over step tables.

Windows here are partitioned by episode / stream: an episode is capped by
``max_rounds`` steps and a stream by the producer's output limit, so a
partition never holds a hot, unbounded key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankforge.config import MAX_ROUND


def running_reward(steps: DataFrame, episode: str = "episode_id", order: str = "turn",
                   reward: str = "reward") -> DataFrame:
    """Cumulative reward per episode in step order."""
    w = Window.partitionBy(episode).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return steps.withColumn("running_reward", F.sum(reward).over(w))


def terminal_reward(reward, terminated) -> F.Column:
    """Reward counts only on a terminated step."""
    return F.when(terminated, reward).otherwise(F.lit(0.0))


def episode_outcome(steps: DataFrame, episode: str = "episode_id", order: str = "turn",
                    reward: str = "reward", done: str = "done",
                    max_rounds: int | None = MAX_ROUND) -> DataFrame:
    """Play steps in order until the first ``done`` or ``max_rounds``
    steps; the final reward is the reward of the last step played.
    Rows: episode, rounds, done, final_reward."""
    w = Window.partitionBy(episode).orderBy(order)
    s = steps.withColumn("_k", F.row_number().over(w))
    first_done = s.filter(F.col(done)).groupBy(episode).agg(F.min("_k").alias("_fd"))
    s = s.join(first_done, episode, "left")
    stop = F.coalesce(F.col("_fd"), F.lit(1 << 30))
    if max_rounds is not None:
        stop = F.least(stop, F.lit(max_rounds))
    played = s.filter(F.col("_k") <= stop)
    return played.groupBy(episode).agg(
        F.count(F.lit(1)).alias("rounds"),
        F.max_by(F.col(done), F.col("_k")).alias("done"),
        F.max_by(F.col(reward), F.col("_k")).alias("final_reward"))


def assemble_chat(steps: DataFrame, seed: Sequence[tuple[str, str]], episode: str = "episode_id",
                  order: str = "turn", content: str = "content") -> DataFrame:
    """Seed messages, then the observation and alternating
    assistant/user turns in step order: (episode, messages array)."""
    seeds = F.array(*[F.struct(F.lit(r).alias("role"), F.lit(c).alias("content")) for r, c in seed])
    msgs = steps.groupBy(episode).agg(
        F.array_sort(F.collect_list(F.struct(F.col(order).alias("k"), F.col("role"),
                                             F.col(content).alias("content")))).alias("_m"))
    body = F.transform("_m", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
    return msgs.select(episode, F.concat(seeds, body).alias("messages"))


def reassemble_lines(chunks: DataFrame, stream: str = "stream", pos: str = "pos",
                     chunk: str = "chunk", step: int = 1000, span: int = 1000) -> DataFrame:
    """Ordered chunks of a stream cut into lines (newline kept), the
    final partial line emitted.  A line is rebuilt from the pieces of the
    chunks it spans; lines are numbered by the running newline count, which
    is summed per ``step`` positions first, so no stream is ever concatenated
    or ordered whole.  A line that reaches over more than ``span`` positions
    comes in parts of so many positions, numbered from 0, so a line without an
    end is never gathered in one row.  Rows: stream, line_no, part, line."""
    from rankforge.operators.ops import running_before
    c = chunks.filter(F.col(chunk).isNotNull() & (F.length(chunk) > 0))
    c = c.withColumn("_nl", F.length(chunk) - F.length(F.replace(F.col(chunk), F.lit("\n"), F.lit(""))))
    c = running_before(c, stream, [pos], "_nl", "_before", F.floor(F.col(pos) / step))
    pieces = c.select(stream, pos, "_before",
                      F.posexplode(F.split(F.col(chunk), r"(?<=\n)", -1)).alias("_i", "_p"))
    pieces = pieces.filter(F.length("_p") > 0)
    pieces = pieces.withColumn("_line", F.col("_before") + F.col("_i"))
    long = pieces.groupBy(stream, "_line").agg(F.min(pos).alias("_from"), F.max(pos).alias("_to")) \
        .filter(F.col("_to") - F.col("_from") >= span).drop("_to")
    pieces = pieces.join(long, [stream, "_line"], "left") \
        .withColumn("part", F.coalesce(F.floor((F.col(pos) - F.col("_from")) / span), F.lit(0)).cast("int"))
    lines = pieces.groupBy(stream, "_line", "part").agg(
        F.array_sort(F.collect_list(F.struct(F.col(pos).alias("k"), F.col("_p").alias("p")))).alias("_ps"))
    return lines.select(stream, (F.col("_line") + 1).cast("int").alias("line_no"), "part",
                        F.array_join(F.transform("_ps", lambda x: x["p"]), "").alias("line"))


def expand_task_ids(df: DataFrame, tasks_in_order: Sequence[str], max_ids: int = 200,
                    ids: str = "ids", task: str = "task", data_len: str = "data_len",
                    flavour: str = "agent") -> DataFrame:
    """Per (request, task) the item ids to run.  ``ids`` is JSON: a
    list of lists gives one list per task (by task position); a flat list
    goes to the first task only; null runs ``range(min(data_len, 200))``.  In
    the ``item`` flavour a request has one task, and null or an empty list
    runs item 0.
    One output row per (request, task, idx)."""
    pos = F.array_position(F.array(*[F.lit(t) for t in tasks_in_order]), F.col(task)).cast("int")  # 1-based
    nested = F.startswith(F.coalesce(F.get_json_object(F.col(ids), "$[0]"), F.lit("")), F.lit("["))
    n = F.least(F.col(data_len).cast("bigint"), F.lit(max_ids).cast("bigint"))
    default = F.when(n > 0, F.sequence(F.lit(0).cast("bigint"), n - 1)).otherwise(F.array().cast("array<bigint>"))
    if flavour == "item":
        own = F.from_json(F.col(ids), "array<bigint>")
        zero = F.array(F.lit(0).cast("bigint"))
        return df.select("*", F.explode(F.when(F.coalesce(F.size(own), F.lit(0)) > 0, own).otherwise(zero)).alias("idx"))
    lst = (F.when(F.col(ids).isNull(), default)
           .when(nested, F.try_element_at(F.from_json(F.col(ids), "array<array<bigint>>"), pos))
           .when(pos == 1, F.from_json(F.col(ids), "array<bigint>")))
    return df.select("*", F.explode(lst).alias("idx"))
