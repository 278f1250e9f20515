"""The multilayer perceptron: its shape, its parameters and the maths of one batch.

Spark decides which rows make a batch and where it runs; these helpers see one batch at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

from tabweave.operators.sparse_rows import ColumnGradient, SparseRows

# Slope of the leaky activation, norm epsilon, weight of a batch in running statistics.
LEAKY_SLOPE = 0.01
NORM_EPSILON = 1e-5
RUNNING_MOMENTUM = 0.1

ACTIVATIONS = ("relu", "leaky_relu", "tanh")
NORMS = (None, "batch", "layer")

Parameters = dict[str, np.ndarray]


@dataclass(frozen=True)
class MLPSpec:
    """Per hidden size one block of linear, norm, activation and dropout, then an output layer."""

    input_size: int
    hidden_size: int | Sequence[int]
    num_classes: int
    activation: str = "relu"
    dropout_rate: float = 0.3
    norm: str | None = None

    def __post_init__(self):
        if self.activation not in ACTIVATIONS:
            raise ValueError(f"activation '{self.activation}' is not one of {ACTIVATIONS}")
        if self.norm not in NORMS:
            raise ValueError(f"norm '{self.norm}' is not one of {NORMS}")

    @property
    def hidden_sizes(self) -> list[int]:
        return [self.hidden_size] if isinstance(self.hidden_size, int) else list(self.hidden_size)

    @property
    def linear_shapes(self) -> list[tuple[int, int]]:
        widths = [self.input_size, *self.hidden_sizes, self.num_classes]
        return list(zip(widths[1:], widths[:-1]))

    def shapes(self) -> dict[str, tuple[int, ...]]:
        """Name to shape of every parameter, in layer order; running statistics included."""
        out: dict[str, tuple[int, ...]] = {}
        last = len(self.linear_shapes) - 1
        for i, (rows, columns) in enumerate(self.linear_shapes):
            out[f"{i}.weight"], out[f"{i}.bias"] = (rows, columns), (rows,)
            if i < last and self.norm:
                out[f"{i}.gain"], out[f"{i}.shift"] = (rows,), (rows,)
                if self.norm == "batch":
                    out[f"{i}.running_mean"], out[f"{i}.running_var"] = (rows,), (rows,)
        return out


def is_running(name: str) -> bool:
    return ".running_" in name


# Deviation or bound of an initial weight as a function of a layer's input and output
# width. The leaky activation passes no slope, so it has the factor of relu.
INITIAL_SPREAD = {
    "kaiming_normal": lambda fan_in, fan_out: np.sqrt(2.0 / fan_in),
    "kaiming_uniform": lambda fan_in, fan_out: np.sqrt(6.0 / fan_in),
    "xavier_normal": lambda fan_in, fan_out: np.sqrt(2.0 / (fan_in + fan_out)),
    "xavier_uniform": lambda fan_in, fan_out: np.sqrt(6.0 / (fan_in + fan_out)),
    "default": lambda fan_in, fan_out: np.sqrt(1.0 / fan_in),
}


def init_params(spec: MLPSpec, init: str = "kaiming_normal", seed: int = 42) -> Parameters:
    """Seeded start weights; biases 0, norm gains 1. Unknown names mean the default, uniform, start."""
    rng = np.random.default_rng(seed)
    spread = INITIAL_SPREAD.get(init, INITIAL_SPREAD["default"])
    params: Parameters = {}
    for name, shape in spec.shapes().items():
        if name.endswith(".weight"):
            scale = spread(shape[1], shape[0])
            draw = rng.normal(0.0, scale, shape) if init.endswith("normal") else rng.uniform(-scale, scale, shape)
            params[name] = draw
        else:
            params[name] = np.ones(shape) if name.endswith((".gain", ".running_var")) else np.zeros(shape)
    return params


def flatten(params: Parameters, spec: MLPSpec) -> np.ndarray:
    return np.concatenate([params[n].ravel() for n in spec.shapes()])


def unflatten(values: np.ndarray, spec: MLPSpec) -> Parameters:
    out, at = {}, 0
    for name, shape in spec.shapes().items():
        size = int(np.prod(shape))
        out[name] = np.array(values[at : at + size], dtype=np.float64).reshape(shape)
        at += size
    return out


def _activate(z: np.ndarray, kind: str) -> np.ndarray:
    if kind == "tanh":
        return np.tanh(z)
    return np.maximum(z, LEAKY_SLOPE * z if kind == "leaky_relu" else 0.0)


def _activation_slope(z: np.ndarray, kind: str) -> np.ndarray:
    if kind == "tanh":
        return 1.0 - np.tanh(z) ** 2
    return np.where(z > 0, 1.0, LEAKY_SLOPE if kind == "leaky_relu" else 0.0)


def _times(x: np.ndarray | SparseRows, weights: np.ndarray) -> np.ndarray:
    return x.times(weights) if isinstance(x, SparseRows) else x @ weights.T


def forward(params: Parameters, x: np.ndarray | SparseRows, spec: MLPSpec, rng: np.random.Generator | None = None):
    """Outputs of a batch and what the backward step needs.

    With ``rng`` the batch is a training batch: dropout is on, batch norm uses the statistics of
    the batch and moves the running ones in ``params``.
    """
    training, tape, out = rng is not None, [], x
    for i in range(len(spec.hidden_sizes)):
        step = {"input": out}
        z = _times(out, params[f"{i}.weight"])
        z += params[f"{i}.bias"]
        if spec.norm:
            axis = 0 if spec.norm == "batch" else 1
            if spec.norm == "batch" and not training:
                mean, var = params[f"{i}.running_mean"], params[f"{i}.running_var"]
            else:
                mean, var = z.mean(axis=axis, keepdims=True), z.var(axis=axis, keepdims=True)
                if spec.norm == "batch":
                    if len(z) < 2:
                        raise ValueError("batch norm needs at least two rows in a training batch")
                    for which, seen in (("mean", mean[0]), ("var", var[0] * len(z) / (len(z) - 1))):
                        kept = params[f"{i}.running_{which}"]
                        params[f"{i}.running_{which}"] = kept + RUNNING_MOMENTUM * (seen - kept)
            step["inverse"] = 1.0 / np.sqrt(var + NORM_EPSILON)
            step["centered"] = (z - mean) * step["inverse"]
            z = step["centered"] * params[f"{i}.gain"] + params[f"{i}.shift"]
        step["z"] = z
        out = _activate(z, spec.activation)
        if training and spec.dropout_rate > 0:
            keep = 1.0 - spec.dropout_rate
            step["mask"] = (rng.random(out.shape) < keep) / keep if keep > 0 else np.zeros_like(out)
            out = out * step["mask"]
        tape.append(step)
    last = len(spec.hidden_sizes)
    tape.append({"input": out})
    return _times(out, params[f"{last}.weight"]) + params[f"{last}.bias"], tape


def backward(params: Parameters, tape: list, d_out: np.ndarray, spec: MLPSpec) -> Parameters:
    """Gradient of every trained parameter, given the gradient at the outputs.

    That of the first layer has only the columns that occur if the batch came as sparse rows.
    """
    grads: Parameters = {}
    last = len(spec.hidden_sizes)
    for i in range(last, -1, -1):
        step = tape[i]
        if i < last:
            if "mask" in step:
                d_out = d_out * step["mask"]
            d_out = d_out * _activation_slope(step["z"], spec.activation)
            if spec.norm:
                c = step["centered"]
                grads[f"{i}.gain"], grads[f"{i}.shift"] = (d_out * c).sum(axis=0), d_out.sum(axis=0)
                axis = 0 if spec.norm == "batch" else 1
                d_c = d_out * params[f"{i}.gain"]
                drift = d_c.mean(axis=axis, keepdims=True) + c * (d_c * c).mean(axis=axis, keepdims=True)
                d_out = step["inverse"] * (d_c - drift)
        given = step["input"]
        grads[f"{i}.weight"] = given.gradient(d_out) if isinstance(given, SparseRows) else d_out.T @ given
        grads[f"{i}.bias"] = d_out.sum(axis=0)
        if i:
            d_out = d_out @ params[f"{i}.weight"]
    return grads


def log_softmax(logits: np.ndarray) -> np.ndarray:
    shifted = logits - logits.max(axis=1, keepdims=True)
    return shifted - np.log(np.exp(shifted).sum(axis=1, keepdims=True))


def loss_and_gradient(outputs: np.ndarray, labels: np.ndarray, mode: str, weights: np.ndarray | None):
    """Batch loss and its gradient at the outputs: weighted cross-entropy or mean squared error."""
    if mode == "regression":
        error = outputs[:, 0] - labels
        return float(np.mean(error**2)), (2.0 * error / len(error))[:, None]
    y = labels.astype(np.int64)
    rows = np.arange(len(y))
    w = np.ones(len(y)) if weights is None else weights[y]
    log_p = log_softmax(outputs)
    gradient = np.exp(log_p)
    gradient[rows, y] -= 1.0
    return float(-(w * log_p[rows, y]).sum() / w.sum()), gradient * (w / w.sum())[:, None]


def gradient_norm(grads: Parameters) -> float:
    values = (g.values if isinstance(g, ColumnGradient) else g for g in grads.values())
    return float(np.sqrt(sum(float((g * g).sum()) for g in values)))


def descend(params: Parameters, grads: Parameters, lr: float) -> None:
    """One step against the gradient, in place."""
    for name, g in grads.items():
        if isinstance(g, ColumnGradient):
            params[name][:, g.columns] -= lr * g.values
        else:
            params[name] -= lr * g
