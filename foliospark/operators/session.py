"""Sessions: supplements are folded into the question before them."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from foliospark.lexicon import DEFAULT, Lexicon


def fold(turns: DataFrame, lex: Lexicon = DEFAULT, header: str = "补充信息：") -> DataFrame:
    """turns: conv_id, turn, text. One row a question: conv_id, turn, query (with its supplements), n_supplements.
    Supplements before any question are left out."""
    marks = "^(?:" + "|".join(sorted(lex.supplements, key=len, reverse=True)) + ")"
    t = F.regexp_replace("text", r"(?U)^\s+|\s+$", "")
    rest = F.regexp_replace(F.regexp_replace(t, marks, ""), r"^[：: ]+", "")
    rows = turns.withColumn("extra", t.rlike(marks)).withColumn("said", F.when(t.rlike(marks), F.when(rest == "", t).otherwise(rest)).otherwise(t))
    w = Window.partitionBy("conv_id").orderBy("turn")
    rows = rows.withColumn("question", F.sum((~F.col("extra")).cast("int")).over(w)).where("question > 0")
    parts = F.array_sort(F.collect_list(F.struct("turn", "said", "extra")))
    out = rows.groupBy("conv_id", "question").agg(F.min("turn").alias("turn"), parts.alias("p"))
    extras = F.transform(F.filter("p", lambda x: x["extra"] & (x["said"] != "")), lambda x: F.concat(F.lit("- "), x["said"]))
    base = F.element_at("p", 1)["said"]
    query = F.when(F.size("p") == 1, base).otherwise(F.array_join(F.concat(F.array(base, F.lit(""), F.lit(header)), extras), "\n"))
    return out.select("conv_id", "turn", query.alias("query"), (F.size("p") - 1).alias("n_supplements"))


RESET, EXITS = "/reset", ("/exit", "exit", "quit")
STATE = "question string, supplements array<string>, ended boolean, turn long"


def _said(lex: Lexicon) -> tuple[Column, Column, Column]:
    """The stripped text, whether it is a supplement, and what it says without the mark."""
    marks = "^(?:" + "|".join(sorted(lex.supplements, key=len, reverse=True)) + ")"
    t = F.regexp_replace("text", r"(?U)^\s+|\s+$", "")
    rest = F.regexp_replace(F.regexp_replace(t, marks, ""), r"^[：: ]+", "")
    return t, t.rlike(marks), F.when(t.rlike(marks), F.when(rest == "", t).otherwise(rest)).otherwise(t)


def turn_queries(turns: DataFrame, lex: Lexicon = DEFAULT, header: str = "补充信息：") -> DataFrame:
    """What is asked at each turn (conv_id, turn, text): conv_id, turn, query, n_supplements.

    A question stands for itself, a supplement for the question before it with all its supplements so far. Blank turns ask nothing, `/reset` forgets the
    question, supplements without one are left out, and after `/exit`, `exit` or `quit` a conversation is over."""
    t, extra, said = _said(lex)
    rows = turns.select("conv_id", "turn", t.alias("t"), extra.alias("extra"), said.alias("said")).where("t <> ''")
    w = Window.partitionBy("conv_id").orderBy("turn")
    over = F.max(F.lower("t").isin(*EXITS).cast("int")).over(w)
    rows = rows.withColumn("over", over).where("over = 0").withColumn("reset", F.lower("t") == RESET)
    rows = rows.withColumn("part", F.sum((~F.col("extra")).cast("int")).over(w)).where("part > 0")
    each = Window.partitionBy("conv_id", "part").orderBy("turn")
    rows = rows.withColumn("base", F.first("said").over(each)).withColumn("dead", F.first("reset").over(each)).where("not dead")
    rows = rows.withColumn("extras", F.collect_list(F.when(F.col("extra"), F.col("said"))).over(each))
    lines = F.concat(F.array("base", F.lit(""), F.lit(header)), F.transform("extras", lambda x: F.concat(F.lit("- "), x)))
    query = F.when(F.size("extras") == 0, F.col("base")).otherwise(F.array_join(lines, "\n"))
    return rows.select("conv_id", "turn", query.alias("query"), F.size("extras").cast("long").alias("n_supplements"))


def stream_queries(turns: DataFrame, lex: Lexicon = DEFAULT, header: str = "补充信息：", idle: int | None = None) -> DataFrame:
    """turn_queries over a stream of turns, with a state for each conversation, dropped after `idle` milliseconds without a turn.
    (A query with `idle` goes on making batches, so it has no end under the trigger availableNow.)

    Turns of a conversation come in order from one micro-batch to the next (in one they are sorted); a turn
    that is no later than the last one handled is a repeated delivery and asks nothing."""
    t, extra, said = _said(lex)
    rows = turns.select("conv_id", "turn", t.alias("t"), extra.alias("extra"), said.alias("said"))

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        question, extras, ended, last = state.get if state.exists else (None, [], False, -1)
        extras, out = list(extras), []
        for r in pd.concat(list(frames)).sort_values("turn").itertuples():
            if ended or r.turn <= last:
                continue
            last = r.turn
            if not isinstance(r.t, str) or r.t == "":
                continue
            if r.t.lower() in EXITS:
                ended = True
            elif r.extra:
                if question is None:
                    continue
                extras.append(r.said)
                out.append((key[0], r.turn, "\n".join([question, "", header, *(f"- {x}" for x in extras)]), len(extras)))
            else:
                question, extras = (None, []) if r.t.lower() == RESET else (r.said, [])
                if question is not None:
                    out.append((key[0], r.turn, question, 0))
        state.update((question, extras, ended, int(last)))
        if idle is not None:
            state.setTimeoutDuration(idle)
        yield pd.DataFrame(out, columns=["conv_id", "turn", "query", "n_supplements"])

    kind = f"conv_id {turns.schema['conv_id'].dataType.simpleString()}, turn long, query string, n_supplements long"
    return rows.groupBy("conv_id").applyInPandasWithState(step, kind, STATE, "append", GroupStateTimeout.NoTimeout if idle is None else GroupStateTimeout.ProcessingTimeTimeout)
