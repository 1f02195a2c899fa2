"""A gated recurrent language model in numpy with a class-factored output.

The state after the words so far predicts the class of the next word, and the word within
its class. Classes hold about equal shares of the counted words, frequent words in small
classes, so a prediction costs about (classes + words of a class) products.
"""

from __future__ import annotations

import numpy as np

HIDDEN, CLASSES, STEPS, STREAMS = 16, 48, 16, 1024
RATE, KEEP_MEAN, KEEP_SQUARE = 0.004, 0.9, 0.99
UNIT = np.float32


class Vocabulary:
    """Ids 0..n-1 by count; their classes, and each class's members."""

    def __init__(self, counts: np.ndarray, classes: int = CLASSES):
        share = np.cumsum(counts / max(counts.sum(), 1)) - counts / max(counts.sum(), 1) / 2
        self.of = np.unique((share * classes).astype(int), return_inverse=True)[1]
        self.members = [np.flatnonzero(self.of == c) for c in range(self.of.max() + 1)]
        self.place = np.concatenate([np.arange(len(m)) for m in self.members])[np.argsort(np.concatenate(self.members))]


def start(counts: np.ndarray, vocabulary: Vocabulary, hidden: int = HIDDEN) -> dict[str, np.ndarray]:
    """Parameters before training: the biases alone give the words' own frequencies."""
    draw = np.random.default_rng(11)
    small = lambda *shape: (draw.standard_normal(shape) * 0.1).astype(UNIT)
    words, classes = len(counts), len(vocabulary.members)
    logs = np.log(counts / counts.sum() + 1e-9).astype(UNIT)
    class_mass = np.bincount(vocabulary.of, counts, classes)
    return {
        "input": small(words, 3 * hidden),
        "state": small(hidden, 3 * hidden),
        "class": small(hidden, classes),
        "class_bias": np.log(class_mass / class_mass.sum() + 1e-9).astype(UNIT),
        "word": small(words, hidden),
        "word_bias": logs,
    }


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + UNIT(0.5)


def advance(p: dict[str, np.ndarray], state: np.ndarray, word: np.ndarray, trace: list | None = None) -> np.ndarray:
    """The state after reading one more word per row."""
    n = state.shape[1]
    given = p["input"][word]
    gates = _sigmoid(given[:, : 2 * n] + state @ p["state"][:, : 2 * n])
    keep, reset = gates[:, :n], gates[:, n:]
    held = reset * state
    new = np.tanh(given[:, 2 * n :] + held @ p["state"][:, 2 * n :])
    if trace is not None:
        trace.append((state, word, keep, reset, held, new))
    return new + keep * (state - new)


def _softmax(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities and log of the normalising sum."""
    top = x.max(axis=1, keepdims=True)
    e = np.exp(x - top)
    total = e.sum(axis=1, keepdims=True)
    return e / total, (np.log(total) + top)[:, 0]


def log_probability(
    p: dict[str, np.ndarray], vocabulary: Vocabulary, state: np.ndarray, word: np.ndarray, grad: dict | None = None
) -> tuple[np.ndarray, np.ndarray | None]:
    """Natural log-probability of ``word`` after ``state``; with ``grad``, its gradient is added there.

    Rows are taken class by class, so each class's word matrix is multiplied once.
    """
    kind = vocabulary.of[word]
    scores = state @ p["class"] + p["class_bias"]
    share, norm = _softmax(scores)
    rows = np.arange(len(word))
    out = scores[rows, kind] - norm
    back = None
    if grad is not None:
        share[rows, kind] -= 1
        grad["class"] += state.T @ share
        grad["class_bias"] += share.sum(axis=0)
        back = share @ p["class"].T
    order = np.argsort(kind, kind="stable")
    cuts = np.searchsorted(kind[order], np.arange(len(vocabulary.members) + 1))
    for c, members in enumerate(vocabulary.members):
        at = order[cuts[c] : cuts[c + 1]]
        if len(members) == 1 or not len(at):
            continue
        own = state[at]
        matrix = p["word"][members]
        scores = own @ matrix.T + p["word_bias"][members]
        share, norm = _softmax(scores)
        place = vocabulary.place[word[at]]
        here = np.arange(len(at))
        out[at] += scores[here, place] - norm
        if grad is not None:
            share[here, place] -= 1
            grad["word"][members] += share.T @ own
            grad["word_bias"][members] += share.sum(axis=0)
            back[at] += share @ matrix
    return out, back


def _window(p, vocabulary, state, words, fresh, grad) -> tuple[np.ndarray, float]:
    """Loss of a window of words (step x stream), truncated backpropagation included.

    ``fresh`` marks the words that begin a text: the state before them is zero.
    """
    states, trace = [], []
    for word, new in zip(words, fresh):
        state = state * ~new[:, None]
        states.append(state)
        state = advance(p, state, word, trace)
    n = state.shape[1]
    before = np.concatenate(states)
    value, back = log_probability(p, vocabulary, before, words.ravel(), grad)
    back = back.reshape(len(words), -1, n)
    carried = np.zeros_like(state)
    inputs = np.empty((len(words), *state.shape[:1], 3 * n), state.dtype)
    for t in range(len(words) - 1, -1, -1):
        old, word, keep, reset, held, new = trace[t]
        d_new = carried * (1 - keep) * (1 - new * new)
        d_keep = carried * (old - new) * keep * (1 - keep)
        d_held = d_new @ p["state"][:, 2 * n :].T
        d_reset = d_held * old * reset * (1 - reset)
        d_gates = np.concatenate([d_keep, d_reset], axis=1)
        grad["state"][:, : 2 * n] += old.T @ d_gates
        grad["state"][:, 2 * n :] += held.T @ d_new
        inputs[t, :, : 2 * n], inputs[t, :, 2 * n :] = d_gates, d_new
        carried = carried * keep + d_held * reset + d_gates @ p["state"][:, : 2 * n].T + back[t]
        carried *= ~fresh[t][:, None]
    flat, given = words.ravel(), inputs.reshape(-1, 3 * n)
    for k in range(3 * n):
        grad["input"][:, k] += np.bincount(flat, given[:, k], len(grad["input"]))
    return state, -float(value.sum())


def train(p: dict[str, np.ndarray], vocabulary: Vocabulary, words: np.ndarray, fresh: np.ndarray) -> dict[str, np.ndarray]:
    """One pass of Adam over a run of texts, cut into parallel streams of equal length.

    The state is carried from window to window of a stream. Words that do not fill the
    last window are used in a shorter one.
    """
    p = {k: v.copy() for k, v in p.items()}
    mean, square = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    streams = max(1, min(STREAMS, len(words) // STEPS))
    length = -(-len(words) // streams)
    pad = streams * length - len(words)
    words, fresh = np.append(words, words[:pad]), np.append(fresh, np.ones(pad, bool))
    words, fresh = words.reshape(streams, length).T, fresh.reshape(streams, length).T.copy()
    fresh[0] = True
    state = np.zeros((streams, p["state"].shape[0]), UNIT)
    for step, at in enumerate(range(0, length, STEPS), 1):
        grad = {k: np.zeros_like(v) for k, v in p.items()}
        state, _ = _window(p, vocabulary, state, words[at : at + STEPS], fresh[at : at + STEPS], grad)
        size = words[at : at + STEPS].size
        for k, g in grad.items():
            g /= size
            mean[k] += (1 - KEEP_MEAN) * (g - mean[k])
            square[k] += (1 - KEEP_SQUARE) * (g * g - square[k])
            right = np.sqrt(1 - KEEP_SQUARE**step) / (1 - KEEP_MEAN**step)
            p[k] -= UNIT(RATE * right) * mean[k] / (np.sqrt(square[k]) + UNIT(1e-7))
    return p


def score(p: dict[str, np.ndarray], vocabulary: Vocabulary, words: np.ndarray, of: np.ndarray, steps: int = 64) -> np.ndarray:
    """Natural log-probability of every text, the state carried through all its words.

    Texts go in step, longest first, so those still running are always the first rows.
    """
    length = np.diff(of)
    order = np.argsort(-length, kind="stable")
    first, length = of[:-1][order], length[order]
    out = np.zeros(len(order))
    state = np.zeros((len(order), p["state"].shape[0]), UNIT)
    done, last = 0, int(length[0]) if len(length) else 0
    while done < last:
        # fewer texts make longer windows
        active = int(np.searchsorted(-length, -done, "left"))
        stop = min(last, done + max(4, steps * 256 // max(active, 1)))
        states, rows, said = [], [], []
        for t in range(done, stop):
            n = int(np.searchsorted(-length, -t, "left"))  # texts with more than t words
            word = words[first[:n] + t]
            states.append(state[:n].copy())
            rows.append(np.arange(n))
            said.append(word)
            state[:n] = advance(p, state[:n], word)
        value, _ = log_probability(p, vocabulary, np.concatenate(states), np.concatenate(said))
        out += np.bincount(np.concatenate(rows), value, len(out))
        done = stop
    back = np.empty(len(order))
    back[order] = out
    return back
