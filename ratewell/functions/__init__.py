from ratewell.functions.metrics import (
    batch_mean_rmse,
    masked_rmse,
    metrics_frame,
    mse,
    rmse,
)
from ratewell.functions.scalars import (
    clip,
    dot,
    formula_value,
    pair_hash,
    pair_key,
    presence,
    relu,
    sq_err,
)

__all__ = [
    "batch_mean_rmse",
    "masked_rmse",
    "metrics_frame",
    "mse",
    "rmse",
    "clip",
    "dot",
    "formula_value",
    "pair_hash",
    "pair_key",
    "presence",
    "relu",
    "sq_err",
]
