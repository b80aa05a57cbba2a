"""A gated recurrent language model in numpy: forward pass, truncated backpropagation, averaging.

A token is one of ``CLASSES * MEMBERS`` ids; its probability is that of its class times
that within its class, each a softmax over the hidden state. Embedding and input matrix
are one table. The constants of the output start at the logarithms of counted
frequencies, so that an untrained model is the unigram model.
"""

from __future__ import annotations

import numpy as np

HIDDEN = 16
CLASSES = 64
MEMBERS = 64
IDS = CLASSES * MEMBERS
WINDOW = 24  # steps of truncated backpropagation
LANES = 128  # documents trained side by side
READ = 512  # documents scored side by side
FLUSH = 1 << 15  # hidden states that meet the output layer at once
RATE = 0.08

SHAPES = {
    "inputs": (IDS, 3 * HIDDEN),
    "gates": (HIDDEN, 2 * HIDDEN),
    "candidate": (HIDDEN, HIDDEN),
    "to_class": (HIDDEN, CLASSES),
    "class_bias": (CLASSES,),
    "to_member": (CLASSES, HIDDEN, MEMBERS),
    "member_bias": (CLASSES, MEMBERS),
    "start": (HIDDEN,),
}
Weights = dict[str, np.ndarray]


def untrained(frequencies: np.ndarray) -> Weights:
    """Random small weights; ``frequencies`` are counts by id."""
    rng = np.random.default_rng(5)
    weights = {name: (rng.standard_normal(shape) * 0.1).astype(np.float32) for name, shape in SHAPES.items()}
    share = (frequencies + 0.5).reshape(CLASSES, MEMBERS)
    weights["class_bias"] = np.log(share.sum(axis=1) / share.sum()).astype(np.float32)
    weights["member_bias"] = np.log(share / share.sum(axis=1, keepdims=True)).astype(np.float32)
    weights["to_class"] *= 0.1
    weights["to_member"] *= 0.1
    return weights


def flat(weights: Weights) -> np.ndarray:
    return np.concatenate([weights[name].ravel() for name in SHAPES])


def shaped(values: np.ndarray) -> Weights:
    found, at = {}, 0
    for name, shape in SHAPES.items():
        size = int(np.prod(shape))
        found[name] = values[at : at + size].reshape(shape).astype(np.float32)
        at += size
    return found


def recurrent(weights: Weights) -> np.ndarray:
    """All matrices that meet a hidden state, one below the other; those of the gates are negated, for their sigmoid."""
    return np.concatenate([-weights["gates"], weights["candidate"]], axis=1).T.copy()


def step(weights: Weights, ids: np.ndarray, hidden: np.ndarray) -> tuple[np.ndarray, ...]:
    """The next hidden states, and what backpropagation needs."""
    x, matrices = _inputs(weights, ids), recurrent(weights)
    met, gates, new, after = (np.empty((n * HIDDEN, len(ids)), x.dtype) for n in (3, 2, 1, 1))
    _step(x, matrices, hidden.T, met, gates, new, after)
    return after.T, gates[:HIDDEN].T, gates[HIDDEN:].T, met[2 * HIDDEN :].T, new.T


def _inputs(weights: Weights, ids: np.ndarray) -> np.ndarray:
    """What the ids add, one column for each, that of the gates negated."""
    x = np.ascontiguousarray(np.swapaxes(weights["inputs"][ids], -1, -2))
    gates = x[..., : 2 * HIDDEN, :]
    np.negative(gates, out=gates)
    return x


def _step(x: np.ndarray, matrices: np.ndarray, hidden: np.ndarray, met: np.ndarray, gates: np.ndarray, new: np.ndarray, after: np.ndarray) -> None:
    """One step in place. States are columns, so that all that belongs to a gate lies together."""
    np.matmul(matrices, hidden, out=met)
    np.add(x[: 2 * HIDDEN], met[: 2 * HIDDEN], out=gates)
    np.exp(gates, out=gates)
    gates += 1
    np.reciprocal(gates, out=gates)
    np.multiply(gates[HIDDEN:], met[2 * HIDDEN :], out=new)
    new += x[2 * HIDDEN :]
    np.tanh(new, out=new)
    np.subtract(hidden, new, out=after)
    after *= gates[:HIDDEN]
    after += new


def _by_class(ids: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """The order that puts ids of one class side by side, and where each class begins."""
    order = np.argsort((ids // MEMBERS).astype(np.uint16), kind="stable")
    return order, np.searchsorted(ids[order] // MEMBERS, np.arange(CLASSES + 1)).tolist()


def log_probabilities(weights: Weights, hidden: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Natural logarithms of the probabilities of the ids that follow the hidden states."""
    order, bounds = _by_class(ids)
    hidden, ids, every = hidden[order], ids[order], np.arange(len(ids))
    classes, members = ids // MEMBERS, ids % MEMBERS
    # A sum over exponentials times those of their constants: one product with a vector.
    logits = hidden @ weights["to_class"]
    chosen = logits[every, classes] + weights["class_bias"][classes] + weights["member_bias"].ravel()[ids]
    total = np.exp(logits, out=logits) @ np.exp(weights["class_bias"])
    within, constants = np.empty_like(total), np.exp(weights["member_bias"])
    for c, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
        if a < b:
            part = np.matmul(hidden[a:b], weights["to_member"][c], out=logits[a:b, :MEMBERS] if MEMBERS <= CLASSES else None)
            chosen[a:b] += part[every[: b - a], members[a:b]]
            np.matmul(np.exp(part, out=part), constants[c], out=within[a:b])
    found = np.empty_like(chosen)
    found[order] = chosen - np.log(total) - np.log(within)
    return found


def log_likelihoods(weights: Weights, texts: list[np.ndarray]) -> np.ndarray:
    """Of every complete document (ids, at least one), however long.

    Documents of like length go side by side; hidden states are carried from the
    first token to the last and meet the output layer many at a time.
    """
    total = np.zeros(len(texts))
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    states, targets, owners, held = [], [], [], 0

    def flush():
        nonlocal held
        if held:
            found = log_probabilities(weights, np.concatenate(states), np.concatenate(targets))
            np.add.at(total, np.concatenate(owners), found.astype(np.float64))
            states.clear(), targets.clear(), owners.clear()
            held = 0

    matrices, table = recurrent(weights), weights["inputs"] * np.repeat(np.array([-1, 1], weights["inputs"].dtype), [2 * HIDDEN, HIDDEN])
    for first in range(0, len(order), READ):
        lanes = np.array(order[first : first + READ])
        lengths = np.array([len(texts[i]) for i in lanes])
        hidden = np.repeat(weights["start"][:, None], len(lanes), axis=1)
        for begin in range(0, int(lengths[0]), WINDOW):
            width = min(WINDOW, int(lengths[0]) - begin)
            now = int(np.searchsorted(-lengths, -begin, side="left"))  # lanes longer than begin
            block = np.zeros((now, width), dtype=np.int16)
            for lane in range(now):
                part = texts[lanes[lane]][begin : begin + width]
                block[lane, : len(part)] = part
            block = np.ascontiguousarray(block.T)
            x, met, gates, new = (np.empty((n * HIDDEN, now), table.dtype) for n in (3, 3, 2, 1))
            before = np.empty((width + 1, HIDDEN, now), table.dtype)
            before[0] = hidden[:, :now]
            for t in range(width):
                x[:] = table.take(block[t], axis=0).T
                _step(x, matrices, before[t], met, gates, new, before[t + 1])
            hidden = before[width]
            # Columns of documents that have ended count for nothing.
            alive = np.searchsorted(-lengths[:now], -(begin + np.arange(width)), side="left")
            here = np.arange(now) < alive[:, None]
            states.append(np.swapaxes(before[:-1], 1, 2)[here])
            targets.append(block[here])
            owners.append(np.broadcast_to(lanes[:now], block.shape)[here])
            held += int(alive.sum())
            if held >= FLUSH:
                flush()
    flush()
    return total


def train(weights: Weights, texts: list[np.ndarray], rate: float = RATE) -> Weights:
    """One pass of truncated backpropagation over whole documents, state carried from
    window to window, with step sizes that shrink by the gradients seen (Adagrad)."""
    weights = {name: value.copy() for name, value in weights.items()}
    seen = {name: np.full(value.shape, 1e-2, np.float32) for name, value in weights.items()}
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    groups = [order[i : i + LANES] for i in range(0, len(order), LANES)]
    for group in [groups[i] for i in np.random.default_rng(len(texts)).permutation(len(groups))]:
        lengths = np.array([len(texts[i]) for i in group])
        hidden = np.tile(weights["start"], (len(group), 1))
        for begin in range(0, int(lengths[0]), WINDOW):
            alive = int(np.searchsorted(-lengths, -begin, side="left"))
            hidden = _window(weights, seen, [texts[i][begin : begin + WINDOW] for i in group[:alive]], hidden[:alive], rate, begin == 0)
    return weights


def _window(weights: Weights, seen: Weights, texts: list[np.ndarray], hidden: np.ndarray, rate: float, is_first: bool) -> np.ndarray:
    lanes, width = len(texts), max(map(len, texts))
    ids, mask = np.zeros((width, lanes), np.int16), np.zeros((width, lanes), bool)
    for lane, text in enumerate(texts):
        ids[: len(text), lane], mask[: len(text), lane] = text, True
    matrices, x = recurrent(weights), _inputs(weights, ids)
    met, gates, new, states = (np.empty((steps, n * HIDDEN, lanes), x.dtype) for n, steps in ((3, width), (2, width), (1, width), (1, width + 1)))
    states[0] = hidden.T
    for t in range(width):
        _step(x[t], matrices, states[t], met[t], gates[t], new[t], states[t + 1])
    before, update, reset, past = states[:-1], gates[:, :HIDDEN], gates[:, HIDDEN:], met[:, 2 * HIDDEN :]
    here = np.flatnonzero(mask)
    rows = np.swapaxes(before, 1, 2).reshape(-1, HIDDEN)
    grads, to_states = _output_gradients(weights, rows, ids.ravel(), here)
    back = np.ascontiguousarray(np.swapaxes(to_states.reshape(width, lanes, HIDDEN), 1, 2))
    # How a change of the next state moves the gates and the candidate.
    kept = 1 - update
    by_new = kept * (1 - new * new)
    by_update = kept * update
    by_update *= before - new
    by_reset = 1 - reset
    by_reset *= reset
    by_reset *= past
    # Beyond the end of a text nothing flows back, so its columns stay zero there.
    to_inputs, to_matrices = np.empty_like(x), np.empty_like(x)
    flow, across = np.zeros((HIDDEN, lanes), x.dtype), np.concatenate([weights["gates"], weights["candidate"]], axis=1)
    for t in range(width - 1, -1, -1):
        at, to_new = to_matrices[t], to_inputs[t, 2 * HIDDEN :]
        np.multiply(flow, by_new[t], out=to_new)
        np.multiply(flow, by_update[t], out=at[:HIDDEN])
        np.multiply(to_new, by_reset[t], out=at[HIDDEN : 2 * HIDDEN])
        np.multiply(to_new, reset[t], out=at[2 * HIDDEN :])
        flow *= update[t]
        flow += across @ at
        flow += back[t]
    to_inputs[:, : 2 * HIDDEN] = to_matrices[:, : 2 * HIDDEN]
    both = (before @ np.swapaxes(to_matrices, 1, 2)).sum(axis=0)
    grads["gates"], grads["candidate"] = both[:, : 2 * HIDDEN], both[:, 2 * HIDDEN :]
    if is_first:
        grads["start"] = flow.sum(axis=1)
    size = max(1.0, float(len(here))) ** 0.5
    for name, grad in grads.items():
        _move(weights[name], seen[name], grad / size, rate)
    found = ids.ravel()[here]
    order = np.argsort(found, kind="stable")
    found = found[order]
    first = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
    moved = np.swapaxes(to_inputs, 1, 2).reshape(-1, 3 * HIDDEN)[here[order]]
    _move_rows(weights["inputs"], seen["inputs"], found[first], np.add.reduceat(moved, first, axis=0) / size, rate)
    return states[-1].T


def _move_rows(weight: np.ndarray, seen: np.ndarray, rows: np.ndarray, grad: np.ndarray, rate: float) -> None:
    moved, step = seen[rows], weight[rows]
    moved += grad * grad
    seen[rows] = moved
    step -= rate * grad / np.sqrt(moved)
    weight[rows] = step


def _move(weight: np.ndarray, seen: np.ndarray, grad: np.ndarray, rate: float) -> None:
    seen += grad * grad
    weight -= rate * grad / np.sqrt(seen)


def _output_gradients(weights: Weights, hidden: np.ndarray, ids: np.ndarray, here: np.ndarray) -> tuple[Weights, np.ndarray]:
    """Gradients of the negative log-likelihood by the output weights and by the states; only the places ``here`` count."""
    order, bounds = _by_class(ids[here])
    here = here[order]
    h, chosen, every = hidden[here], ids[here], np.arange(len(here))
    # A state of one more entry, always 1, meets the constants in the same products.
    h = np.concatenate([h, np.ones((len(h), 1), h.dtype)], axis=1)
    to_class = np.concatenate([weights["to_class"], weights["class_bias"][None, :]])
    to_member = np.concatenate([weights["to_member"], weights["member_bias"][:, None, :]], axis=1)
    p = h @ to_class
    np.exp(p, out=p)
    p *= (1 / (p @ np.ones(CLASSES, p.dtype)))[:, None]
    p[every, chosen // MEMBERS] -= 1
    to_h = p @ weights["to_class"].T
    by_class = h.T @ p
    by_member = np.zeros_like(to_member)
    q, more = np.empty((len(here), MEMBERS), p.dtype), np.empty_like(to_h)
    spans = [(c, slice(a, b)) for c, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])) if a < b]
    for c, span in spans:
        np.dot(h[span], to_member[c], out=q[span])
    np.exp(q, out=q)
    q *= (1 / (q @ np.ones(MEMBERS, q.dtype)))[:, None]
    q[every, chosen % MEMBERS] -= 1
    for c, span in spans:
        np.dot(h[span].T, q[span], out=by_member[c])
        np.dot(q[span], weights["to_member"][c].T, out=more[span])
    to_h += more
    grads = {"to_class": by_class[:HIDDEN], "class_bias": by_class[HIDDEN], "to_member": by_member[:, :HIDDEN], "member_bias": by_member[:, HIDDEN]}
    back = np.zeros_like(hidden)
    back[here] = to_h
    return grads, back
