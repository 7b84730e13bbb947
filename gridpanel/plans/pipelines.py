"""Two-stage forecasting pipelines: linear stage, residual stage, block scoring."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import models as M
from ..operators.normalise import denormalise_by_capacity
from ..operators.sizing import dimension
from ..session import cut_lineage
from . import backtest as B
from . import features as FB
from .fixtures import Panel, split_block


class Pipeline:
    """Features of one direction, in its own unit: production in target / capacity, consumption raw.

    Training rows are all blocks before the split, by the train rules: client
    facts of the same day, normalised target, rows without lags dropped. Test
    rows are all others, by the inference rules: facts and lags known two days
    earlier, missing lags 0. Lags are in the unit of the target."""

    def __init__(self, panel: Panel, target: DataFrame, consumption: bool):
        self.panel, self.normalise = panel, not consumption
        self.client = dimension(panel.client)           # joined by the history, the training and the test rows
        held = cut_lineage(target)                      # read by the history, the test rows, the template, the hours and their bounds
        block, of_direction = F.col("data_block_id"), F.col("is_consumption") == consumption
        self.split = split_block(held)
        self.rows = held.filter(of_direction).filter(block >= self.split)
        # not from the stored rows: forests deal bags by the order of the training rows, which would be another
        self.train_rows = target.filter(of_direction).filter(block < split_block(target))
        self.history = FB.history_of(held, self.client, self.normalise)
        self.fit_start = held.select(F.min(F.to_date("prediction_datetime"))).scalar()
        self.times = FB.hour_features(target.sparkSession, held, self.fit_start)

    def features(self, mode: str, calendar: bool = False) -> DataFrame:
        """Rows with client facts, target and lags; ``calendar`` adds what depends on the hour (``times``) as columns."""
        rows = self.train_rows if mode == "train" else self.rows
        out = FB.linear_features(rows, self.client, self.history, mode, normalise=self.normalise)
        return out.join(F.broadcast(self.times.drop("date")), "prediction_datetime", "left") if calendar else out      # a row an hour

    def in_target_units(self, scored: DataFrame) -> DataFrame:
        return denormalise_by_capacity(scored) if self.normalise else scored

    def submission(self, scored: DataFrame) -> DataFrame:
        """All test rows; what could not be scored is 0."""
        template = self.rows.select("row_id", "data_block_id", F.lit(0.0).alias("target"))
        return B.complete_submission(template, scored.select("row_id", F.col("prediction")))

    def production(self, train: DataFrame):
        """M1."""
        return M.fit_blocked_ols_by_hour(train, self.times, M.production_design(), M.ROW_LAGS)

    def consumption(self, train: DataFrame):
        """M2 + M3: a model for each business flag."""
        return M.fit_blocked_ols_by_hour(train, self.times, M.consumption_design(), M.ROW_LAGS, segments=["is_business"])

    def one_stage(self, fit) -> DataFrame:
        model = fit(self.features("train"))
        return self.submission(self.in_target_units(model.predict(self.features("inference"))))

    def two_stage(self, fit_first, fit_second) -> DataFrame:
        """Second stage on the first one's residuals, with prices and county weather."""
        train = cut_lineage(self.features("train"))          # fitted on, and scored for the second stage
        stage = FB.ForestStage(self.panel)
        first = fit_first(train)
        second = fit_second(stage.add(first.predict(train)))
        scored = second.predict(stage.add(first.predict(self.features("inference"))))
        return self.submission(self.in_target_units(scored))


def fit_forest_stage(train: DataFrame):
    """M4: 200 trees of 10,000 samples each, the reference's documented values."""
    return M.fit_residual_forest(train, num_trees=200, max_samples=10_000)
