"""PageRank over accounts that share devices."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from riskgraph.functions.skew import attach
from riskgraph.operators.sharing import Sharing, sharing
from riskgraph.session import materialise, materialise_with


# Iterations that run as one job; each reports its largest move.
STEPS_PER_JOB = 3


def pagerank(
    df: DataFrame,
    alpha: float = 0.85,
    max_iter: int = 100,
    rtol: float = 1e-5,
    atol: float = 1e-6,
    graph: Sharing | None = None,
) -> DataFrame:
    """(account_id, pagerank_score).

    Power iteration from 1/n without redistribution from isolated accounts. It stops
    when a step moves no score by more than atol + rtol * score, and returns the
    scores before that step.
    """
    graph = graph or sharing(df)
    n = graph.accounts.count()
    if n == 0:
        return graph.accounts.withColumn("pagerank_score", F.lit(None).cast("double"))
    ones = graph.accounts.withColumn("_one", F.lit(1))
    degrees = graph.gather(ones, "_one").select(
        "account_id", F.when(F.col("total") > 0, F.col("total")).otherwise(F.lit(1)).cast("double").alias("k")
    )
    degrees, size = materialise_with(degrees)
    outward = materialise(attach(graph.outward, degrees, "account_id", right_rows=size["rows"]))

    def step(state: DataFrame, seen: Observation) -> DataFrame:
        """One iteration; `_give` is the score per neighbour, recovered as the account's own share."""
        moved = graph.gather(state, "_give", outward, k=F.max("k")).select(
            "account_id", "k", (F.col("own") * F.col("k")).alias("_before"),
            (F.lit((1 - alpha) / n) + F.lit(alpha) * F.col("total")).alias("_pr"),
        ).withColumn("_give", F.col("_pr") / F.col("k"))
        excess = F.max(F.abs(F.col("_pr") - F.col("_before")) - (atol + rtol * F.abs(F.col("_before"))))
        return moved.observe(seen, excess.alias("excess"))

    state = degrees.select("account_id", "k", F.lit(1.0 / n).alias("_pr"), (F.lit(1.0 / n) / F.col("k")).alias("_give"))
    done = 0
    while done < max_iter:
        start, watched = state, []
        for _ in range(min(STEPS_PER_JOB, max_iter - done)):
            watched.append(Observation())
            state = step(state, watched[-1])
        state = materialise(state)
        for i, seen in enumerate(watched):
            if seen.get["excess"] <= 0:
                # Walk to the scores before the step that settled.
                for _ in range(i):
                    start = step(start, Observation())
                return start.select("account_id", F.col("_pr").alias("pagerank_score"))
        done += len(watched)
    return state.select("account_id", F.col("_pr").alias("pagerank_score"))
