"""All parameters of a run, checked and with weights renormalised."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields, replace

#: Weights that sum to 1 within this are left as they are.
WEIGHT_SLACK = 0.01


@dataclass(frozen=True)
class EngineConfig:
    input_customers: str = "customer.csv"
    input_products: str = "products.csv"
    input_invoices: str = "invoices.csv"
    model_approval_status: str = "Approved"
    min_order_count: int = 1
    recency_cutoff_days: int = 730
    max_k: int = 8
    min_cluster_customers: int = 6
    elbow_threshold: float = 10.0
    feature_groups: tuple[str, ...] = ("l2_qty", "brand", "functionality", "rfm")
    random_state: int = 42
    n_init: int = 15
    window_days: int = 0  #: 0: taken from the data
    min_lift: float = 1.2
    min_abs_freq: int = 2
    min_freq_ratio: float = 0.03
    decay_lambda: float = 0.001
    min_support: float = 0.01
    min_confidence: float = 0.05
    top_k: int = 5
    w_conf: float = 0.45
    w_supp: float = 0.20
    w_lift: float = 0.20
    w_recency: float = 0.15
    max_lift_normalise: float = 5.0
    l3_tiebreak_margin: float = 0.02
    weight_high: float = 1.3
    weight_med_pos: float = 1.0
    weight_med_neg: float = 0.4
    weight_low: float = 0.1
    score_cutoff: float = 0.08
    feedback_recency_days: int = 365
    # Options beyond the 32 parameters; the defaults do what the parameters alone say.
    gap_grain: str = "row"  #: "date": gaps between distinct dates
    mining_cutoff: bool = False  #: mine only what the recency cutoff leaves
    cap_score: bool = False
    has_price: bool = True

    def __post_init__(self) -> None:
        if self.top_k < 1 or self.max_k < 1 or self.n_init < 1:
            raise ValueError("top_k, max_k and n_init must be positive")
        if self.gap_grain not in ("row", "date"):
            raise ValueError("gap_grain is row or date")
        if self.max_lift_normalise <= 1:
            raise ValueError("max_lift_normalise must be over 1")

    @property
    def weights(self) -> tuple[float, float, float, float]:
        """Confidence, support, lift, recency; renormalised when they don't sum to 1."""
        raw = (self.w_conf, self.w_supp, self.w_lift, self.w_recency)
        total = sum(raw)
        return raw if abs(total - 1) <= WEIGHT_SLACK else tuple(w / total for w in raw)  # type: ignore[return-value]

    @classmethod
    def parse(cls, values: Mapping[str, object]) -> EngineConfig:
        """From strings, as parameter stores hold them; names in snake or camel case."""
        by_name = {f.name.replace("_", ""): f for f in fields(cls)}
        out = {}
        for key, value in values.items():
            f = by_name.get(key.replace("_", "").lower())
            if f is None:
                raise KeyError(key)
            default = f.default
            if isinstance(default, bool):
                out[f.name] = str(value).strip().lower() in ("true", "1", "yes")
            elif isinstance(default, tuple):
                out[f.name] = tuple(x.strip() for x in value.split(",")) if isinstance(value, str) else tuple(value)  # type: ignore[arg-type]
            else:
                out[f.name] = type(default)(value)  # type: ignore[call-arg]
        return cls(**out)

    @classmethod
    def small_data(cls) -> EngineConfig:
        """Relaxed thresholds for little history."""
        return replace(cls(), min_lift=1.0, min_freq_ratio=0.01, min_abs_freq=1, min_confidence=0.03, min_support=0.005, window_days=30)
