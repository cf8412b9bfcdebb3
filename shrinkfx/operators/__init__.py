"""DataFrame operators (all built on Spark's JVM operators; no Python UDFs)."""

from shrinkfx.operators.effects import EffectModel, effect, fit, mean_of, predict, rmse
from shrinkfx.operators.keys import attach, drop_present, keep_known, recode, stack
from shrinkfx.operators.split import HoldOut, close_holdout, split_with_return, stratified_split
from shrinkfx.operators.sweep import alpha_grid, fit_chain_arrays, grid_values, sweep_chain, sweep_single
from shrinkfx.operators.topn import top_n

__all__ = [
    "EffectModel", "effect", "fit", "mean_of", "predict", "rmse",
    "attach", "drop_present", "keep_known", "recode", "stack",
    "HoldOut", "close_holdout", "split_with_return", "stratified_split",
    "alpha_grid", "fit_chain_arrays", "grid_values", "sweep_chain", "sweep_single",
    "top_n",
]
