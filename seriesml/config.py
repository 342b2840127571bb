"""Configuration of a run: ten sections, checked on the driver."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from typing import Any

# Accepted names.
METHODS = ("dnn", "dt", "rf", "xgboost", "xgb", "lgbm", "lda", "qda", "svm", "linearregression", "ridgeregression", "lasso",
           "elasticnet", "sgd", "kneighbors", "kn", "gb", "gradientboosting")
EXPLANATIONS = ("shap", "lime", "all")
# Fields of parameter files that belong to networks not built here, fields without effect, other spellings.
NETWORK_FIELDS = {"train": ("activation_function", "early_stopping", "ff_dim", "head_size", "kernel_size", "maxpooling", "maxpooling_size",
                            "n_flattened_layers", "n_flattened_nodes", "n_heads", "n_transformer_blocks", "patience", "unit_type")}
IGNORED = {"train": (*NETWORK_FIELDS["train"], "dropout"), "evaluate": ("show_inputs",),
           "explain": ("generate_explanations",)}
RENAMED = {"evaluate": {"dropout_uncertainty_estimation": "uncertainty_estimation"}}


def _within(name: str, value: float, low: float, high: float | None = None) -> None:
    if value < low or (high is not None and value > high):
        raise ValueError(f"{name} is {value}, outside {low} to {'any' if high is None else high}")


@dataclass(frozen=True)
class Profile:
    dataset: str = ""


@dataclass(frozen=True)
class Clean:
    target: str = "target"
    classification: bool = False
    onehot_encode_target: bool = False
    combine_files: bool = True
    percentage_zeros_threshold: float = 1.0
    correlation_metric: str = "pearson"
    input_max_correlation_threshold: float = 1.0

    def __post_init__(self):
        _within("percentage_zeros_threshold", self.percentage_zeros_threshold, 0, 1)
        _within("input_max_correlation_threshold", self.input_max_correlation_threshold, 0)
        if self.correlation_metric not in ("pearson", "spearman"):
            raise ValueError(f"unknown correlation metric {self.correlation_metric}")


@dataclass(frozen=True)
class Featurize:
    variables_to_include: list[str] | None = None
    use_all_engineered_features_on_all_variables: bool = False
    add_sum: list[str] | None = None
    add_gradient: list[str] | None = None
    add_mean: list[str] | None = None
    add_maximum: list[str] | None = None
    add_minimum: list[str] | None = None
    add_min_max_range: list[str] | None = None
    add_slope: list[str] | None = None
    add_slope_sin: list[str] | None = None
    add_slope_cos: list[str] | None = None
    add_standard_deviation: list[str] | None = None
    add_variance: list[str] | None = None
    add_peak_frequency: list[str] | None = None
    rolling_window_size_sum: int = 10
    rolling_window_size_mean: int = 10
    rolling_window_size_max_min: int = 10
    rolling_window_size_standard_deviation: int = 10
    remove_features: list[str] | None = None
    target_min_correlation_threshold: float = 0.0

    def requests(self) -> dict[str, list[str]]:
        """Feature name -> columns."""
        return {f.name[4:]: list(getattr(self, f.name)) for f in fields(self)
                if f.name.startswith("add_") and getattr(self, f.name)}

    def lengths(self) -> dict[str, int]:
        return {f.name.removeprefix("rolling_window_size_"): getattr(self, f.name) for f in fields(self)
                if f.name.startswith("rolling_window_size_")}


@dataclass(frozen=True)
class Split:
    train_split: float = 0.7
    shuffle_files: bool = False
    shuffle_samples_before_split: bool = False

    def __post_init__(self):
        _within("train_split", self.train_split, 0, 1)


@dataclass(frozen=True)
class Scale:
    input_method: str | None = "minmax"
    output_method: str | None = None


@dataclass(frozen=True)
class Sequentialize:
    window_size: int = 10
    overlap: int = 0
    target_size: int = 1
    shuffle_samples: bool = False
    future_predict: bool = False


@dataclass(frozen=True)
class Train:
    seed: int = 0
    learning_method: str = "dt"
    ensemble: bool = False
    hyperparameter_tuning: bool = False
    params: dict[str, Any] = field(default_factory=dict)
    n_epochs: int = 100
    batch_size: int = 128
    n_layers: int = 1
    n_neurons: int | list[int] = 16
    dropout: float = 0.0

    def __post_init__(self):
        _within("dropout", self.dropout, 0, 1)
        if self.learning_method not in METHODS:
            raise ValueError(f"unknown learning method {self.learning_method}")


@dataclass(frozen=True)
class Evaluate:
    performance_metric: str = "r2"
    threshold_for_ensemble_models: float | str = "auto"
    uncertainty_estimation: bool = False
    uncertainty_estimation_sampling_size: int = 100
    show_inputs: bool = False


@dataclass(frozen=True)
class Explain:
    generate_explanations: bool = False
    number_of_background_samples: int | None = None
    number_of_summary_samples: int | None = None
    explanation_method: str = "shap"
    shapley_mode: str = "sampled"
    seed: int = 0

    def __post_init__(self):
        if self.explanation_method not in EXPLANATIONS:
            raise ValueError(f"unknown explanation method {self.explanation_method}")


@dataclass(frozen=True)
class CombineExplanations:
    combination_method: str = "avg"
    weighting_method: str = "softmax"
    agreement_method: str = "spearman"


@dataclass(frozen=True)
class Config:
    profile: Profile = field(default_factory=Profile)
    clean: Clean = field(default_factory=Clean)
    featurize: Featurize = field(default_factory=Featurize)
    split: Split = field(default_factory=Split)
    scale: Scale = field(default_factory=Scale)
    sequentialize: Sequentialize = field(default_factory=Sequentialize)
    train: Train = field(default_factory=Train)
    evaluate: Evaluate = field(default_factory=Evaluate)
    explain: Explain = field(default_factory=Explain)
    combine_explanations: CombineExplanations = field(default_factory=CombineExplanations)
    unused: tuple[str, ...] = ()

    @classmethod
    def from_mapping(cls, sections: Mapping[str, Mapping[str, Any]]) -> Config:
        """From nested mappings, such as a parsed YAML file. Unknown sections and fields are errors.

        `unused` names the fields that were given but have no effect: those of networks that are not built, and those that
        steer files, which are read and written outside of a run.
        """
        known = {f.name: f.default_factory for f in fields(cls) if f.name != "unused"}
        unknown = set(sections) - set(known)
        if unknown:
            raise ValueError(f"unknown sections: {', '.join(sorted(unknown))}")
        unused = tuple(f"{name}.{field_}" for name, values in sections.items() for field_ in (values or {})
                       if field_ in IGNORED.get(name, ()))
        return cls(**{name: _section(known[name], _known(name, values)) for name, values in sections.items()}, unused=unused)


def _known(name: str, values: Mapping[str, Any] | None) -> dict[str, Any]:
    """Without the fields of networks, other spellings replaced."""
    renamed = RENAMED.get(name, {})
    return {renamed.get(k, k): v for k, v in (values or {}).items() if k not in NETWORK_FIELDS.get(name, ())}


def _section(kind, values: Mapping[str, Any] | None):
    names = {f.name for f in fields(kind)}
    unknown = set(values or {}) - names
    if unknown:
        raise ValueError(f"unknown fields of {kind.__name__}: {', '.join(sorted(unknown))}")
    return kind(**dict(values or {}))
