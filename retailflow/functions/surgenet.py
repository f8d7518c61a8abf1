"""Forward pass of the surge classifier: one LSTM layer and a sigmoid head, batched in NumPy."""

from __future__ import annotations

import numpy as np

from retailflow.config import HISTORY_FEATURES, HISTORY_STEPS

# Array names and the gate order of the stored weights.
WEIGHT_NAMES = ("w_input", "w_hidden", "b_input", "b_hidden", "w_head", "b_head")
GATES = ("input", "forget", "cell", "output")


def weight_shapes(units: int) -> dict[str, tuple[int, ...]]:
    """The shape of each array for a number of hidden units."""
    gates = len(GATES) * units
    return {
        "w_input": (gates, HISTORY_FEATURES),
        "w_hidden": (gates, units),
        "b_input": (gates,),
        "b_hidden": (gates,),
        "w_head": (1, units),
        "b_head": (1,),
    }


def weight_faults(weights) -> dict[str, str]:
    """What keeps weights from being used, by array: missing, type, shape, or not finite."""
    faults, arrays = {}, {}
    for name in WEIGHT_NAMES:
        try:
            arrays[name] = np.asarray(weights[name], dtype=np.float32)
        except (KeyError, TypeError) as problem:
            faults[name] = "missing" if isinstance(problem, KeyError) or weights is None else "type"
        except ValueError:
            faults[name] = "type"
    hidden = arrays.get("w_hidden")
    units = hidden.shape[1] if hidden is not None and hidden.ndim == 2 else 0
    for name, array in arrays.items():
        if not units or array.shape != weight_shapes(units)[name]:
            faults[name] = f"shape {array.shape}"
        elif not np.isfinite(array).all():
            faults[name] = "not finite"
    return faults


def valid_weights(weights) -> bool:
    """True when every array is there and the shapes fit each other."""
    return not weight_faults(weights)


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60.0, 60.0)))


def surge_probabilities(weights, flat_histories) -> np.ndarray:
    """Probability per history; zeros when no usable weights are given."""
    n = len(flat_histories)
    if n == 0 or not valid_weights(weights):
        return np.zeros(n, dtype=np.float32)
    w = {k: np.asarray(weights[k], dtype=np.float32) for k in WEIGHT_NAMES}
    steps = np.asarray(flat_histories, dtype=np.float32).reshape(n, HISTORY_STEPS, HISTORY_FEATURES)
    units = w["w_hidden"].shape[1]
    hidden = np.zeros((n, units), dtype=np.float32)
    cell = np.zeros((n, units), dtype=np.float32)
    bias = w["b_input"] + w["b_hidden"]
    driven = steps @ w["w_input"].T + bias
    for t in range(HISTORY_STEPS):
        gates = (driven[:, t] + hidden @ w["w_hidden"].T).reshape(n, len(GATES), units)
        cell = _sigmoid(gates[:, 1]) * cell + _sigmoid(gates[:, 0]) * np.tanh(gates[:, 2])
        hidden = _sigmoid(gates[:, 3]) * np.tanh(cell)
    return _sigmoid(hidden @ w["w_head"].T + w["b_head"])[:, 0].astype(np.float32)
