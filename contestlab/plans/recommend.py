"""Opening decision for a table of upcoming contests."""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import (
    ElementwiseProduct,
    StandardScaler,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contestlab.columns import CONTEST, ContestColumns
from contestlab.constants import (
    FIELD_THRESHOLD,
    NO_HISTORY_RATE,
    REQUEST_TRAIN_PERCENT,
    SPLIT_SEED,
)
from contestlab.functions.outcome import draw_flag_int
from contestlab.functions.split import in_training
from contestlab.operators.attach import (
    BROADCAST_BYTES,
    Lookup,
    MeasuredTable,
    attach,
    measured,
    measured_at_once,
)
from contestlab.operators.rates import (
    outcome_cells,
    overall_rate,
    place_rate,
    unordered_pair_rate,
)
from contestlab.plans.features import AVERAGES, RATES, Table, score_lookups
from contestlab.plans.models import alphabetical_indexer, encode_unseen, indexed_name
from contestlab.sources.jobs import at_once
from contestlab.sources.scratch import TASK_ROWS, fit_partitions, laid_out, written

NUMBERS = AVERAGES + RATES


def encoded(c: ContestColumns = CONTEST) -> list[str]:
    return [c.side_a, c.side_b, c.city, c.venue]


def model_inputs(c: ContestColumns = CONTEST) -> list[str]:
    return [indexed_name(n) for n in encoded(c)] + NUMBERS


def request_rows(
    raw: DataFrame, neutral: str = "neutral", draw_winner: str = "toss_winner"
) -> DataFrame:
    """Answers of a form as flags: "Yes"/"No", and "Team 1"/"Team 2"."""
    return raw.withColumns(
        {
            "neutral": F.coalesce((F.col(neutral) == "Yes").cast("int"), F.lit(0)),
            "draw_winner_is_team1": F.coalesce(
                (F.col(draw_winner) == "Team 1").cast("int"), F.lit(0)
            ),
        }
    ).drop(*({neutral, draw_winner} - {"neutral", "draw_winner_is_team1"}))


def request_rates(history: DataFrame, c: ContestColumns = CONTEST) -> dict[str, MeasuredTable]:
    """Pair, overall and city rates, from one scan of the contests."""
    cells = written(outcome_cells(history, [c.city], c), "cells")
    return measured_at_once(
        {
            "pair": unordered_pair_rate(cells, c),
            "overall": overall_rate(cells, c),
            "city": place_rate(cells, c.city, c),
        },
        # The keys that each table is grouped by.
        {"pair": ["team", "opponent"], "overall": ["team"], "city": [c.city, "team"]},
    )


def matchup_features(
    requests: DataFrame,
    matches: DataFrame,
    averages: Table,
    c: ContestColumns = CONTEST,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rates as known when a request is made: the pair in either order, both
    sides over all seasons, and the city. No history gives the neutral rate."""
    made = at_once(
        matches.sparkSession,
        {"rates": partial(request_rates, matches, c), "averages": partial(measured, averages)},
    )
    rates = made["rates"]
    lookups = [
        ("pair", {"team": c.side_a, "opponent": c.side_b}, "h2h_win_rate"),
        ("overall", {"team": c.side_a}, "team1_season_win_rate"),
        ("overall", {"team": c.side_b}, "team2_season_win_rate"),
        ("city", {c.city: c.city, "team": c.side_a}, "team1_venue_win_rate"),
    ]
    out = attach(
        requests,
        *score_lookups(made["averages"], c),
        *[Lookup(rates[table], on, {"rate": name}) for table, on, name in lookups],
        broadcast_bytes=broadcast_bytes,
    )
    return out.withColumns({r: F.coalesce(r, F.lit(NO_HISTORY_RATE)) for r in RATES})


@dataclass(frozen=True)
class RequestModel:
    """``averages`` are the training means of the score averages; ``vectors``
    are the written inputs of both splits."""

    indexer: StringIndexerModel
    scorer: PipelineModel
    averages: dict[str, float]
    vectors: DataFrame
    dropped: int


def scaling(train: DataFrame, rows: int) -> PipelineModel:
    """Centre and divide by the population deviation of the training rows.

    StandardScaler divides by the sample deviation, hence the factor.
    """
    scaler = StandardScaler(
        inputCol="raw_features", outputCol="sample_scaled", withMean=True, withStd=True
    ).fit(train)
    factor = (rows / (rows - 1)) ** 0.5 if rows > 1 else 1.0
    width = len(scaler.mean)
    rescale = ElementwiseProduct(
        inputCol="sample_scaled", outputCol="features", scalingVec=Vectors.dense([factor] * width)
    )
    return PipelineModel(stages=[scaler, rescale])


def assembler(c: ContestColumns = CONTEST, missing: str = "error") -> VectorAssembler:
    if missing not in ("error", "skip"):
        raise ValueError(f"unknown missing: {missing}")
    return VectorAssembler(
        inputCols=model_inputs(c), outputCol="raw_features", handleInvalid=missing
    )


def request_vectors(
    features: DataFrame,
    percent: int = REQUEST_TRAIN_PERCENT,
    seed: int = SPLIT_SEED,
    c: ContestColumns = CONTEST,
    missing: str = "error",
) -> tuple[StringIndexerModel, DataFrame, int]:
    """Encoders fitted on all rows, the written vectors of both splits, and how
    many rows a missing number left out, which only ``missing="skip"`` allows."""
    table = written(
        features.select(
            c.key,
            draw_flag_int(c).alias("label"),
            in_training(c.key, percent=percent, seed=seed).alias("is_train"),
            *encoded(c),
            *[F.col(n).cast("double").alias(n) for n in NUMBERS],
        ),
        "request-features",
    )
    indexer = alphabetical_indexer(encoded(c)).fit(table)
    assembled = assembler(c, missing).transform(indexer.transform(table))
    kept = assembled.select(c.key, "label", "is_train", "raw_features")
    vectors = written(kept, "request-vectors")
    return indexer, vectors, table.count() - vectors.count()


def fit_request_model(
    features: DataFrame,
    inverse_penalty: float = 1.0,
    c: ContestColumns = CONTEST,
    missing: str = "error",
) -> RequestModel:
    """Regularised logistic regression for "the draw winner wins".

    The penalty is written as in C * loss + |w|^2 / 2, so MLlib's parameter,
    which weighs the mean loss, is 1 / (C * training rows).
    """
    indexer, vectors, dropped = request_vectors(features, c=c, missing=missing)
    rows = vectors.where("is_train").count()
    train = laid_out(vectors.where("is_train"), c.key, fit_partitions(rows, TASK_ROWS))
    scale = scaling(train, rows)
    regression = LogisticRegression(
        maxIter=200,
        regParam=1.0 / (inverse_penalty * rows),
        elasticNetParam=0.0,
        standardization=False,
    ).fit(scale.transform(train))
    means = dict(zip(model_inputs(c), scale.stages[0].mean))
    return RequestModel(
        indexer=indexer,
        scorer=PipelineModel(stages=[*scale.stages, regression]),
        averages={n: float(means[n]) for n in AVERAGES},
        vectors=vectors,
        dropped=dropped,
    )


def coefficients(model: RequestModel, c: ContestColumns = CONTEST) -> tuple[dict[str, float], float]:
    """The weight of each input as it is before scaling, and the intercept."""
    scaler, rescale, regression = model.scorer.stages
    weights, intercept = {}, regression.intercept
    parts = zip(model_inputs(c), scaler.mean, scaler.std, rescale.getScalingVec(), regression.coefficients)
    for name, mean, deviation, factor, weight in parts:
        weights[name] = float(weight * factor / deviation) if deviation else 0.0
        intercept -= weights[name] * float(mean)
    return weights, float(intercept)


def probability_of_win(scored: DataFrame) -> Column:
    return F.get(vector_to_array(scored["probability"]), F.lit(1))


def recommendation(probability: str = "probability", threshold: float = FIELD_THRESHOLD) -> Column:
    return F.when(F.col(probability) >= threshold, "FIELD").otherwise("BAT")


def score_requests(
    requests: DataFrame,
    model: RequestModel,
    threshold: float = FIELD_THRESHOLD,
    c: ContestColumns = CONTEST,
) -> DataFrame:
    """Probability and recommendation for requests with matchup features.

    Every request gets an answer: a side without scores takes, and shows, the
    training mean of the missing average, a rate without history the neutral
    one. NaN counts as missing.
    """
    columns = requests.columns
    if c.venue not in columns:
        requests = requests.withColumn(c.venue, F.lit(None).cast("string"))
    fillers = model.averages | {r: NO_HISTORY_RATE for r in RATES}
    filled = requests.withColumns(
        {
            n: F.coalesce(F.nanvl(F.col(n).cast("double"), F.lit(None)), F.lit(value))
            for n, value in fillers.items()
        }
    )
    vectors = assembler(c).transform(encode_unseen(filled, model.indexer))
    scored = model.scorer.transform(vectors)
    return scored.select(*columns, probability_of_win(scored).alias("p")).select(
        *columns, F.col("p").alias("probability"), recommendation("p").alias("recommendation")
    )
