"""One contract over all survival models: fit, predict, parameters.

Frames go in and come out; predictions are columns added per row.
"""

from __future__ import annotations

from abc import ABC, abstractmethod

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenurelens.operators import aft, cox
from tenurelens.operators import lifetable as LT
from tenurelens.sources.schemas import HORIZONS


class NotFitted(RuntimeError):
    """A prediction was asked of a model without parameters."""


class SurvivalModel(ABC):
    def __init__(self, name: str):
        self.name = name
        self.fitted = None

    def is_fitted(self) -> bool:
        return self.fitted is not None

    def parameters(self):
        if self.fitted is None:
            raise NotFitted(f"call fit() on {self.name} first")
        return self.fitted

    @abstractmethod
    def fit(self, df: DataFrame, duration: str = "duration_days", event: str = "is_churned") -> "SurvivalModel":
        """Estimate the model on one row per subject."""

    @abstractmethod
    def survival_at_horizons(self, df: DataFrame, horizons=HORIZONS) -> DataFrame:
        """`customer_id` (if present) and one `survival_prob_<h>d` column per horizon."""

    @abstractmethod
    def predict_median_survival(self, df: DataFrame) -> DataFrame:
        """The frame with `median_survival_days` added."""

    @abstractmethod
    def get_model_params(self) -> dict:
        """Hyperparameters and headline figures."""


class KaplanMeier(SurvivalModel):
    """Population curve: every row gets the same prediction."""

    def __init__(self, alpha: float = 0.05):
        super().__init__("kaplan_meier")
        self.alpha = alpha

    def fit(self, df, duration="duration_days", event="is_churned"):
        # one row per time, read again by every prediction
        self.fitted = LT.kaplan_meier(df, duration, event, alpha=self.alpha).persist()
        return self

    def curve(self) -> DataFrame:
        return self.parameters()

    def summary(self, horizons=(90, 180, 365)) -> DataFrame:
        return LT.km_summary(self.parameters(), horizons=horizons)

    def survival_at_horizons(self, df, horizons=HORIZONS):
        row = LT.km_summary(self.parameters(), horizons=horizons).first()
        ids = ["customer_id"] if "customer_id" in df.columns else []
        return df.select(*ids, *[F.lit(row[f"survival_prob_{h}d"]).alias(f"survival_prob_{h}d") for h in horizons])

    def predict_median_survival(self, df):
        median = LT.km_summary(self.parameters()).first()["median_survival_days"]
        return df.withColumn("median_survival_days", F.lit(median))

    def get_model_params(self):
        median = None
        if self.is_fitted():
            median = LT.km_summary(self.fitted).first()["median_survival_days"]
        return {"model_type": self.name, "alpha": self.alpha, "median_survival_days": median}


class CoxPH(SurvivalModel):
    """Keyword options go to the fit as they are."""

    def __init__(self, penalizer: float = 0.1, l1_ratio: float = 0.0, **options):
        super().__init__("cox_ph")
        self.options = {"penalizer": penalizer, "l1_ratio": l1_ratio, **options}

    def fit(self, df, duration="duration_days", event="is_churned"):
        self.fitted = cox.fit_cox(df, duration, event, **self.options)
        return self

    def fit_time_varying(self, long: DataFrame, covariates=None, start="start", stop="stop", event="is_churned"):
        own = {k: v for k, v in self.options.items() if k not in ("numeric", "categorical")}
        self.fitted = cox.fit_cox_intervals(long, covariates, start, stop, event, **own)
        return self

    def survival_at_horizons(self, df, horizons=HORIZONS):
        return self.parameters().survival_at_horizons(df, horizons)

    def predict_median_survival(self, df):
        return self.parameters().with_median(df)

    def predict_partial_hazard(self, df: DataFrame) -> DataFrame:
        return df.withColumn("partial_hazard", self.parameters().partial_hazard(df))

    def get_model_params(self):
        return self.parameters().params()


class ParametricAFT(SurvivalModel):
    def __init__(self, distribution: str = "weibull", penalizer: float = 0.0, covariates=None):
        if distribution not in aft.FAMILIES:
            raise ValueError(f"distribution must be one of {aft.FAMILIES}, got {distribution!r}")
        super().__init__(f"parametric_{distribution}")
        self.distribution, self.penalizer, self.covariates = distribution, penalizer, covariates

    def fit(self, df, duration="duration_days", event="is_churned"):
        self.fitted = aft.fit_aft(df, self.distribution, duration, event, self.covariates, self.penalizer)
        return self

    def survival_at_horizons(self, df, horizons=HORIZONS):
        return self.parameters().survival_at_horizons(df, horizons)

    def predict_median_survival(self, df):
        return df.withColumn("median_survival_days", self.parameters().median(df))

    def predict_expectation(self, df: DataFrame) -> DataFrame:
        return df.withColumn("expected_days", self.parameters().expectation(df))

    def get_model_params(self):
        return self.parameters().params()
