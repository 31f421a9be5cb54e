"""A bidirectional gated recurrent network with attention pooling over words and their characters, in numpy.

A word's characters run through a small bidirectional GRU and are pooled by attention; the
pooled vector and the word's own embedding are the word's input. A window of words runs
through a second bidirectional GRU with attention pooling, and a logistic unit gives the
window's logit. The part that depends on the word alone ends in its gate inputs, a row of a
table: it is computed once for a distinct word however often the word occurs.

Sequences of a batch stand in descending order of length, so that at every step the ones
that still run are the first rows; no step is spent on padding.

What is only scored keeps nothing for a gradient (`states_of`, `vectors`): there each gate has
an array of its own, so that every step runs over memory that is in one piece.
"""

from dataclasses import dataclass

import numpy as np

CHARACTERS = 512
# Characters below this have an embedding of their own, the others share the rest.
PLAIN = 384
# Letters of a word that are read as one input; longer words are several inputs.
LONGEST = 24


@dataclass(frozen=True)
class Shape:
    """Sizes of the network: embeddings of characters and words, states, attention, window and its step."""

    character: int = 12
    character_state: int = 12
    word: int = 12
    state: int = 16
    attention: int = 12
    window: int = 32
    step: int = 24


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def character_ids(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(codes by word and place, lengths) of words of at most LONGEST characters."""
    lengths = np.array([len(w) for w in words], np.int64)
    joined = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    codes = np.where(joined < PLAIN, joined, PLAIN + joined * 40503 % 65521 % (CHARACTERS - PLAIN))
    table = np.zeros((len(words), max(int(lengths.max(initial=0)), 1)), np.int64)
    table[np.arange(table.shape[1]) < lengths[:, None]] = codes
    return table, lengths


def running(lengths: np.ndarray, steps: int) -> list[int]:
    """How many sequences, longest first, are longer than 0, 1, 2, ... steps."""
    return [int(x) for x in np.searchsorted(-lengths, -np.arange(steps), side="left")]


def both_ways(rows: np.ndarray, places: np.ndarray, active: list[int]) -> tuple[list, list]:
    """Gate inputs by step, for either direction, of sequences that are places of rows."""
    half = rows.shape[1] // 2
    found = [rows[places[t, :k]] for t, k in enumerate(active)]
    return [x[:, :half] for x in found], [x[:, half:] for x in found]


def gru(gates: list[np.ndarray], inner: np.ndarray, bias: np.ndarray, back: bool):
    """States by step from gate inputs by step (sequence, 3 units), and what the gradient needs."""
    steps, size, units = len(gates), len(gates[0]), len(inner)
    states: list = [None] * steps
    kept: list = [None] * steps
    state = np.zeros((size, units), inner.dtype)
    for t in reversed(range(steps)) if back else range(steps):
        k = len(gates[t])
        before = state[:k]
        asked = before @ inner
        update_reset = asked[:, : 2 * units] + gates[t][:, : 2 * units]
        np.negative(update_reset, out=update_reset)
        np.exp(update_reset, out=update_reset)
        update_reset += 1
        np.reciprocal(update_reset, out=update_reset)
        update, reset = update_reset[:, :units], update_reset[:, units:]
        pushed = asked[:, 2 * units :] + bias
        new = reset * pushed
        new += gates[t][:, 2 * units :]
        np.tanh(new, out=new)
        now = before - new
        now *= update
        now += new
        states[t], kept[t] = now, (before, update, reset, pushed, new)
        # Backwards, sequences that start at earlier steps still wait with an empty state.
        state = np.concatenate((now, state[k:])) if back and k < size else now
    return states, kept


def by_gate(rows: np.ndarray) -> np.ndarray:
    """Gate inputs (row, 6 units) as (6, row, units): three gates forwards, three backwards."""
    return np.ascontiguousarray(rows.reshape(len(rows), 6, -1).transpose(1, 0, 2))


def states_of(gates: np.ndarray, places: np.ndarray, active: list[int], inner: np.ndarray, bias: np.ndarray, back: bool) -> list[np.ndarray]:
    """The states that `gru` gives, of sequences that are places of `gates` (gate, row, units)."""
    steps, units = len(active), len(inner)
    # A product for each gate: narrow ones are several times as fast here as one over all three.
    parts = np.ascontiguousarray(inner.reshape(units, 3, units).transpose(1, 0, 2))
    states: list = [None] * steps
    state = np.zeros((active[0], units), inner.dtype)
    if back:
        state = state[: active[-1]]
    for t in reversed(range(steps)) if back else range(steps):
        k = active[t]
        if k > len(state):
            # Backwards, sequences that end here start with an empty state.
            state = np.concatenate((state, np.zeros((k - len(state), units), inner.dtype)))
        before, given = state[:k], gates.take(places[t, :k], axis=1)
        asked = np.matmul(before, parts)
        update_reset, new = asked[:2], asked[2]
        update_reset += given[:2]
        np.negative(update_reset, out=update_reset)
        np.exp(update_reset, out=update_reset)
        update_reset += 1
        np.reciprocal(update_reset, out=update_reset)
        new += bias
        new *= update_reset[1]
        new += given[2]
        np.tanh(new, out=new)
        state = before - new
        state *= update_reset[0]
        state += new
        states[t] = state
    return states


def gru_gradient(change: list[np.ndarray], kept: list, inner: np.ndarray, back: bool):
    """Gradients of (gates, inner, bias) from the gradient of the states."""
    steps, (size, units) = len(change), change[0].shape
    gates: list = [None] * steps
    inner_change, bias_change = np.zeros_like(inner), np.zeros(units, inner.dtype)
    carried = np.zeros((size, units), inner.dtype)
    for t in range(steps) if back else reversed(range(steps)):
        k = len(change[t])
        before, update, reset, pushed, new = kept[t]
        here = change[t] + carried[:k]
        new_change = here * (1 - update) * (1 - new * new)
        pushed_change = new_change * reset
        own = np.concatenate((here * (before - new) * update * (1 - update), new_change * pushed * reset * (1 - reset), new_change), axis=1)
        gates[t] = own
        asked = np.concatenate((own[:, : 2 * units], pushed_change), axis=1)
        inner_change += before.T @ asked
        bias_change += pushed_change.sum(axis=0)
        carried[:k] = here * update + asked @ inner.T
    return gates, inner_change, bias_change


def pooled(states: list[np.ndarray], size: int, keys: np.ndarray, offset: np.ndarray, query: np.ndarray):
    """Attention pooling over the steps of each sequence; one without steps gives zeros."""
    # No mark passes the sum of the query's sizes, so that no exponential overflows.
    most = np.abs(query).sum()
    seen = [np.tanh(x @ keys + offset) for x in states]
    shares = [np.exp(x @ query - most) for x in seen]
    total, found = np.full(size, 1e-30, query.dtype), np.zeros((size, len(keys)), query.dtype)
    for share, state in zip(shares, states, strict=True):
        total[: len(share)] += share
        found[: len(share)] += share[:, None] * state
    shares = [share / total[: len(share)] for share in shares]
    return found / total[:, None], (seen, shares)


def pooled_gradient(change: np.ndarray, found: np.ndarray, states: list, kept, keys: np.ndarray, query: np.ndarray):
    """Gradients of (states, keys, offset, query)."""
    seen, shares = kept
    middle = (change * found).sum(axis=1)
    keys_change, offset_change, query_change = np.zeros_like(keys), np.zeros_like(query), np.zeros_like(query)
    states_change = []
    for state, looked, share in zip(states, seen, shares, strict=True):
        k = len(share)
        marks = share * ((state * change[:k]).sum(axis=1) - middle[:k])
        query_change += marks @ looked
        looked_change = marks[:, None] * query * (1 - looked * looked)
        keys_change += state.T @ looked_change
        offset_change += looked_change.sum(axis=0)
        states_change.append(share[:, None] * change[:k] + looked_change @ keys.T)
    return states_change, keys_change, offset_change, query_change


def start(rng: np.random.Generator, shape: Shape, words: int) -> dict[str, np.ndarray]:
    """Weights to begin with; number 0 stands for words without an embedding of their own."""

    def drawn(*size: int) -> np.ndarray:
        return rng.normal(0, size[0] ** -0.5, size).astype(np.float32)

    found = {
        "characters": (0.3 * rng.normal(size=(CHARACTERS, shape.character))).astype(np.float32),
        "words": (0.1 * rng.normal(size=(words, shape.word))).astype(np.float32),
    }
    for name, given, units in (("c", shape.character, shape.character_state), ("w", shape.word + 2 * shape.character_state, shape.state)):
        found |= {
            f"{name}_in": drawn(given, 6 * units), f"{name}_in_bias": np.zeros(6 * units, np.float32),
            f"{name}_ahead": drawn(units, 3 * units), f"{name}_ahead_bias": np.zeros(units, np.float32),
            f"{name}_back": drawn(units, 3 * units), f"{name}_back_bias": np.zeros(units, np.float32),
            f"{name}_keys": drawn(2 * units, shape.attention), f"{name}_offset": np.zeros(shape.attention, np.float32),
            f"{name}_query": drawn(shape.attention),
        }
    return found | {"out": drawn(2 * shape.state), "out_bias": np.zeros(1, np.float32)}


def layer(p: dict, name: str, rows: np.ndarray, places: np.ndarray, lengths: np.ndarray):
    """One level: both directions over sequences of places (step, sequence) of gate rows, and the pooling."""
    # Every sequence counts at the first step; one without steps is pooled to zeros.
    active = [k for k in running(lengths, len(places)) if k] or [0]
    ahead_gates, back_gates = both_ways(rows, places, active)
    ahead, ahead_kept = gru(ahead_gates, p[f"{name}_ahead"], p[f"{name}_ahead_bias"], False)
    back, back_kept = gru(back_gates, p[f"{name}_back"], p[f"{name}_back_bias"], True)
    states = [np.concatenate(pair, axis=1) for pair in zip(ahead, back, strict=True)]
    found, kept = pooled(states, len(lengths), p[f"{name}_keys"], p[f"{name}_offset"], p[f"{name}_query"])
    return found, (found, states, kept, ahead_kept, back_kept, places, active)


def vectors(p: dict, name: str, gates: np.ndarray, places: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """What `layer` pools, from gate inputs `by_gate`."""
    active = [k for k in running(lengths, len(places)) if k] or [0]
    places = np.ascontiguousarray(places)
    ahead = states_of(gates[:3], places, active, p[f"{name}_ahead"], p[f"{name}_ahead_bias"], False)
    back = states_of(gates[3:], places, active, p[f"{name}_back"], p[f"{name}_back_bias"], True)
    states = [np.concatenate(pair, axis=1) for pair in zip(ahead, back, strict=True)]
    return pooled(states, len(lengths), p[f"{name}_keys"], p[f"{name}_offset"], p[f"{name}_query"])[0]


def layer_gradient(p: dict, name: str, change: np.ndarray, kept, size: int, into: dict) -> np.ndarray:
    """Adds the gradients of the level's weights to `into`; returns that of its `size` gate rows."""
    found, states, pool, ahead_kept, back_kept, places, active = kept
    states_change, *rest = pooled_gradient(change, found, states, pool, p[f"{name}_keys"], p[f"{name}_query"])
    for key, value in zip(("keys", "offset", "query"), rest, strict=True):
        into[f"{name}_{key}"] = value
    units, sides = found.shape[1] // 2, []
    for way, part, steps in (("ahead", slice(None, units), ahead_kept), ("back", slice(units, None), back_kept)):
        gates, inner, bias = gru_gradient([x[:, part] for x in states_change], steps, p[f"{name}_{way}"], way == "back")
        into[f"{name}_{way}"], into[f"{name}_{way}_bias"] = inner, bias
        sides.append(np.concatenate(gates))
    at = np.concatenate([places[t, :k] for t, k in enumerate(active)])
    return summed(np.concatenate(sides, axis=1), at, size)


def summed(rows: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
    """Sums of the rows by place."""
    order = np.argsort(places, kind="stable")
    at, first = np.unique(places[order], return_index=True)
    found = np.zeros((size, rows.shape[1]), rows.dtype)
    if len(at):
        found[at] = np.add.reduceat(rows[order], first, axis=0)
    return found


def letter_rows(p: dict) -> np.ndarray:
    return p["characters"] @ p["c_in"] + p["c_in_bias"]


def word_gates(p: dict, words: list[str], numbers: np.ndarray) -> np.ndarray:
    """The gate inputs that `word_rows` gives, `by_gate`."""
    codes, lengths = character_ids(words)
    order = np.argsort(-lengths, kind="stable")
    found = vectors(p, "c", by_gate(letter_rows(p)), codes[order].T, lengths[order])
    inputs = np.empty((len(words), p["words"].shape[1] + found.shape[1]), found.dtype)
    inputs[:, : p["words"].shape[1]] = p["words"][numbers]
    inputs[order, p["words"].shape[1] :] = found
    return by_gate(inputs @ p["w_in"] + p["w_in_bias"])


def word_rows(p: dict, words: list[str], numbers: np.ndarray):
    """The gate inputs of distinct words, a row each, and what the gradient needs."""
    codes, lengths = character_ids(words)
    order = np.argsort(-lengths, kind="stable")
    letters = letter_rows(p)
    found, kept = layer(p, "c", letters, codes[order].T, lengths[order])
    vectors = np.empty_like(found)
    vectors[order] = found
    inputs = np.concatenate((p["words"][numbers], vectors), axis=1)
    return inputs @ p["w_in"] + p["w_in_bias"], (order, kept, inputs, numbers)


def word_rows_gradient(p: dict, change: np.ndarray, kept, into: dict) -> None:
    order, steps, inputs, numbers = kept
    into["w_in"], into["w_in_bias"] = inputs.T @ change, change.sum(axis=0)
    inputs_change = change @ p["w_in"].T
    width = p["words"].shape[1]
    into["words"] = summed(inputs_change[:, :width], numbers, len(p["words"]))
    letters = layer_gradient(p, "c", inputs_change[order, width:], steps, CHARACTERS, into)
    into["c_in"], into["c_in_bias"] = p["characters"].T @ letters, letters.sum(axis=0)
    into["characters"] = letters @ p["c_in"].T


def window_logits(p: dict, table: np.ndarray, windows: np.ndarray, lengths: np.ndarray):
    """Logits of windows given by their words' rows in `table`, longest window first."""
    pool, kept = layer(p, "w", table, windows.T, lengths)
    return pool @ p["out"] + p["out_bias"], (pool, kept)


def scores(p: dict, gates: np.ndarray, windows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The logits that `window_logits` gives, from a table `by_gate`."""
    return vectors(p, "w", gates, windows.T, lengths) @ p["out"] + p["out_bias"]


def gradients(p: dict, words: list[str], numbers: np.ndarray, windows: np.ndarray, lengths: np.ndarray, labels: np.ndarray, weights: np.ndarray):
    """(loss, gradients of all weights) of the weighted cross entropy of some windows, longest first."""
    table, word_kept = word_rows(p, words, numbers)
    logits, (pool, kept) = window_logits(p, table, windows, lengths)
    loss = float((weights * (np.logaddexp(0, logits) - labels * logits)).sum())
    change = (weights * (sigmoid(logits) - labels)).astype(pool.dtype)
    into = {"out": pool.T @ change, "out_bias": change.sum(keepdims=True)}
    rows = layer_gradient(p, "w", change[:, None] * p["out"], kept, len(words), into)
    word_rows_gradient(p, rows, word_kept, into)
    return loss, into


class Adam:
    def __init__(self, p: dict[str, np.ndarray], rate: float):
        self.p, self.rate, self.turn = p, rate, 0
        self.mean = {k: np.zeros_like(v) for k, v in p.items()}
        self.square = {k: np.zeros_like(v) for k, v in p.items()}

    def step(self, change: dict[str, np.ndarray], most: float = 1.0) -> None:
        """One step down, with a gradient of length `most` at the most."""
        self.turn += 1
        length = np.sqrt(sum(float((g * g).sum()) for g in change.values()))
        scale = np.float32(min(1.0, most / max(length, 1e-12)))
        rate = self.rate * (1 - 0.999**self.turn) ** 0.5 / (1 - 0.9**self.turn)
        for k, g in change.items():
            self.mean[k] += np.float32(0.1) * (g * scale - self.mean[k])
            self.square[k] += np.float32(0.001) * ((g * scale) ** 2 - self.square[k])
            self.p[k] -= np.float32(rate) * self.mean[k] / (np.sqrt(self.square[k]) + np.float32(1e-8))
