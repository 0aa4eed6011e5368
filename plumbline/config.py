"""Defaults, as frozen dataclasses.

``None`` in a call means "use the default"; ``[]`` and ``0`` are real values.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---- fixed values: they decide results and must not drift -------------------
MORTGAGE_RATE_30YR = 6.5
CPI = 320.0
REFERENCE_YEAR = 2026
BASE_MORTGAGE_RATE = 4.0
BASE_CPI = 230.0
TARGET = "SalePrice"
YEAR_SOLD = "Yr Sold"
IDENTIFIERS = ("Order", "PID")
INTERACTIONS = (
    ("Overall Qual", "Gr Liv Area"),
    ("Year Built", "Total Bsmt SF"),
    ("Garage Area", "Garage Cars"),
    ("1st Flr SF", "2nd Flr SF"),
    ("Overall Qual", "Year Built"),
)
HIGH_CARDINALITY = ("Neighborhood", "Exterior 1st", "Exterior 2nd")
# -----------------------------------------------------------------------------


@dataclass(frozen=True)
class MacroConfig:
    mortgage_rate_30yr: float = MORTGAGE_RATE_30YR
    cpi: float = CPI
    reference_year: int = REFERENCE_YEAR
    base_mortgage_rate: float = BASE_MORTGAGE_RATE
    base_cpi: float = BASE_CPI

    @property
    def adjustment_factor(self) -> float:
        return (self.cpi / self.base_cpi) * (self.base_mortgage_rate / self.mortgage_rate_30yr)


@dataclass(frozen=True)
class FeatureConfig:
    skewness_threshold: float = 0.75
    boxcox_lambda: float = 0.15
    smoothing: float = 10.0
    interactions: tuple[tuple[str, str], ...] = INTERACTIONS
    high_cardinality: tuple[str, ...] = HIGH_CARDINALITY


@dataclass(frozen=True)
class FitConfig:
    seed: int = 42
    test_size: float = 0.2
    folds: int = 5
    strata: int = 5
    moderate_iqr: float = 1.5
    extreme_iqr: float = 3.0
    # Spark jobs submitted at the same time for folds, learners and trials
    parallelism: int = 4


@dataclass(frozen=True)
class SearchConfig:
    n_trials: int = 100
    n_trials_quick: int = 10
    timeout: float = 3600.0


@dataclass(frozen=True)
class BayesianRidgeConfig:
    max_iter: int = 300
    tol: float = 1e-3
    alpha_1: float = 1e-6
    alpha_2: float = 1e-6
    lambda_1: float = 1e-6
    lambda_2: float = 1e-6


@dataclass(frozen=True)
class ShapConfig:
    max_display: int = 20
    sample_size: int = 100
    dependence_features: int = 3


@dataclass(frozen=True)
class LimeConfig:
    num_features: int = 10
    num_samples: int = 5000


@dataclass(frozen=True)
class QualityTargets:
    r2: float = 0.85
    rmse: float = 25_000.0
    overfit_gap: float = 0.1
    p_value: float = 0.05


@dataclass(frozen=True)
class LearnerConfig:
    """Spark ML parameters of the three base learners."""

    gbt_a: dict = field(
        default_factory=lambda: {
            "maxIter": 1000,
            "stepSize": 0.05,
            "maxDepth": 5,
            "subsamplingRate": 0.8,
            "featureSubsetStrategy": "0.8",
            "seed": 42,
        }
    )
    # same budget, grown differently so the ensemble is not two equal members
    gbt_b: dict = field(
        default_factory=lambda: {
            "maxIter": 1000,
            "stepSize": 0.05,
            "maxDepth": 4,
            "minInstancesPerNode": 20,
            "subsamplingRate": 0.8,
            "featureSubsetStrategy": "0.8",
            "seed": 43,
        }
    )
    rf: dict = field(
        default_factory=lambda: {
            "numTrees": 500,
            "maxDepth": 15,
            "minInstancesPerNode": 2,
            "featureSubsetStrategy": "all",
            "seed": 42,
        }
    )


MACRO = MacroConfig()
FEATURES = FeatureConfig()
FIT = FitConfig()
SEARCH = SearchConfig()
BAYES = BayesianRidgeConfig()
SHAP = ShapConfig()
LIME = LimeConfig()
QUALITY = QualityTargets()
LEARNERS = LearnerConfig()


def default(value, fallback):
    """``value`` unless it is ``None``; keeps ``0`` and ``[]``."""
    return fallback if value is None else value
