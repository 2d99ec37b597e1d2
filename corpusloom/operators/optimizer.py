"""Head state and the AdamW update."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# Published AdamW defaults, and the fine-tuning rate of the task.
LEARNING_RATE = 2e-5
BETAS = (0.9, 0.999)
EPSILON = 1e-8
WEIGHT_DECAY = 0.01


@dataclass
class HeadState:
    """Weights, both moments and the step count; size depends on the model alone."""

    weights: np.ndarray
    m: np.ndarray
    v: np.ndarray
    step: int = 0

    @classmethod
    def fresh(cls, weights: np.ndarray) -> "HeadState":
        weights = np.asarray(weights, dtype=np.float64)
        return cls(weights, np.zeros_like(weights), np.zeros_like(weights))


def initial_weights(classes: int, dim: int) -> np.ndarray:
    """A small fixed pattern, the same on every run: (7k + 3j) mod 11, centred, over 50."""
    k, j = np.mgrid[0:classes, 0:dim + 1]
    return ((7 * k + 3 * j) % 11 - 5) / 50.0


def adamw(
    state: HeadState, gradient: np.ndarray, lr: float = LEARNING_RATE,
    trainable: np.ndarray | None = None,
) -> HeadState:
    """One decoupled-decay Adam step; entries outside `trainable` keep their weight."""
    step = state.step + 1
    b1, b2 = BETAS
    m = b1 * state.m + (1 - b1) * gradient
    v = b2 * state.v + (1 - b2) * gradient**2
    scaled = (m / (1 - b1**step)) / (np.sqrt(v / (1 - b2**step)) + EPSILON)
    weights = state.weights * (1 - lr * WEIGHT_DECAY) - lr * scaled
    if trainable is not None:
        weights, m, v = (np.where(trainable, new, old) for new, old in
                         ((weights, state.weights), (m, state.m), (v, state.v)))
    return HeadState(weights, m, v, step)
