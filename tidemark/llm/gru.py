"""A bidirectional gated recurrent network with attention pooling, in numpy.

Inputs are words: an embedding of the word next to the scaled sum of the embeddings of its
character pieces, of three and six bytes. Words and pieces have embeddings if enough of
the documents learnt from hold them; others are zero, so that rare ones can't be learnt by
heart. Both directions read a window; attention weighs the words' states, and the weighted
state gives the logit of the window.
"""

from __future__ import annotations

import numpy as np

from tidemark.llm.ragged import flat_index, slice_hashes
from tidemark.llm.words import lower_ascii, word_places

WINDOW = 24
STRIDE = 12
BUCKETS = 1 << 18
PIECES = (3, 6)
LEAST_DOCUMENTS = 6
WORD_SIZE = CHAR_SIZE = 8
STATE = 8
_EDGE = np.array([not chr(b).isalnum() and b < 128 for b in range(256)])


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(40)).astype(np.int64) & (BUCKETS - 1)


class Words:
    """Words of texts: hash of the trimmed lower-case word, buckets of its pieces, owner."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        data = lower_ascii(data)
        starts, lengths, self.owner = word_places(data, offsets)
        for _ in range(4):
            lengths = lengths - ((lengths > 1) & _EDGE[data[np.maximum(starts + lengths - 1, 0)]] if len(starts) else 0)
            lead = (lengths > 1) & _EDGE[data[starts]]
            starts, lengths = starts + lead, lengths - lead
        hashes = slice_hashes(data, starts, lengths)
        _, first, self.place = np.unique(hashes, return_index=True, return_inverse=True)
        self.bucket = _bucket(hashes[first])
        # Pieces of the word between two marks.
        size = lengths[first]
        padded = np.full(int((size + 2).sum()), 1, dtype=np.uint8)
        begin = np.cumsum(size + 2) - (size + 2)
        padded[flat_index(begin + 1, size)] = data[flat_index(starts[first], size)]
        rows, buckets = [], []
        for width in PIECES:
            count = np.maximum(size + 3 - width, 0)
            at = flat_index(begin, count)
            rows.append(np.repeat(np.arange(len(size)), count))
            buckets.append(_bucket(slice_hashes(padded, at, np.full(len(at), width))))
        self.piece_row, self.piece = np.concatenate(rows), np.concatenate(buckets)
        self.scale = np.sqrt(np.maximum(np.bincount(self.piece_row, minlength=len(size)), 1)).astype(np.float32)[:, None]
        self.counts = np.bincount(self.owner, minlength=len(offsets) - 1)


def windows(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, length and text of all windows: every STRIDE words, and the last words."""
    more = np.maximum(-(-(counts - WINDOW) // STRIDE), 0) + (counts > 0)
    text = np.repeat(np.arange(len(counts)), more)
    step = np.arange(len(text)) - np.repeat(np.cumsum(more) - more, more)
    base = np.cumsum(counts) - counts
    first = np.minimum(step * STRIDE, np.maximum(counts[text] - WINDOW, 0))
    return base[text] + first, np.minimum(counts[text], WINDOW), text


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * (np.tanh(np.float32(0.5) * x) + np.float32(1))


def initial(word_at: np.ndarray, char_at: np.ndarray, seed: int = 11) -> dict[str, np.ndarray]:
    """Parameters; ``word_at`` and ``char_at`` give the embedding row of each bucket, 0 for none."""
    rng = np.random.default_rng(seed)
    sizes = {
        "word": (int(word_at.max()) + 1, WORD_SIZE), "char": (int(char_at.max()) + 1, CHAR_SIZE), "in": (WORD_SIZE + CHAR_SIZE, 6 * STATE),
        "uf": (STATE, 3 * STATE), "ub": (STATE, 3 * STATE), "att": (2 * STATE, STATE), "pick": (STATE, 1), "out": (2 * STATE, 1),
    }
    model = {k: (rng.standard_normal(s) * (0.1 if k in ("word", "char") else s[0] ** -0.5)).astype(np.float32) for k, s in sizes.items()}
    model["word"][0] = model["char"][0] = 0
    model |= {"in_b": np.zeros(6 * STATE, np.float32), "att_b": np.zeros(STATE, np.float32), "out_b": np.zeros(1, np.float32)}
    return model | {"word_at": word_at, "char_at": char_at}


def _inputs(model: dict, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Input vectors of the distinct words; embedding rows of known pieces, and their words."""
    rows = model["char_at"][words.piece]
    known = np.flatnonzero(rows)
    of, rows = words.piece_row[known], rows[known]
    chars = np.zeros((len(words.bucket), CHAR_SIZE), np.float32)
    for width in range(CHAR_SIZE):
        chars[:, width] = np.bincount(of, weights=model["char"][:, width][rows], minlength=len(chars))
    return np.concatenate([model["word"][model["word_at"][words.bucket]], chars / words.scale], axis=1).astype(np.float32), rows, of


def _run(steps: np.ndarray, u: np.ndarray, mask: np.ndarray, keep: list | None) -> np.ndarray:
    """States of one direction; ``steps`` are projected inputs by time, ``mask`` what is there."""
    h = np.zeros((steps.shape[1], STATE), np.float32)
    out = np.empty((len(steps), steps.shape[1], STATE), np.float32)
    for t in range(len(steps)):
        rec = h @ u
        gates = _sigmoid(steps[t, :, : 2 * STATE] + rec[:, : 2 * STATE])
        z, r = gates[:, :STATE], gates[:, STATE:]
        n = np.tanh(steps[t, :, 2 * STATE :] + r * rec[:, 2 * STATE :])
        new = n + z * (h - n)
        if keep is not None:
            keep.append((h, z, r, n, rec[:, 2 * STATE :]))
        h = np.where(mask[t], new, h)
        out[t] = h
    return out


def forward(model: dict, projected: np.ndarray, tokens: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
    """Logits of windows; tokens (time, window) index the projected distinct words."""
    there = mask[:, :, None]
    both = projected[tokens]
    ahead, behind = both[:, :, : 3 * STATE], both[:, :, 3 * STATE :]
    caches = ([], []) if keep is not None else (None, None)
    states = np.concatenate([_run(ahead, model["uf"], there, caches[0]), _run(behind[::-1], model["ub"], there[::-1], caches[1])[::-1]], axis=2)
    hidden = np.tanh(states @ model["att"] + model["att_b"])
    score = np.where(mask, (hidden @ model["pick"])[:, :, 0], np.float32(-1e9))
    weight = np.exp(score - score.max(axis=0))
    weight /= weight.sum(axis=0)
    pooled = np.einsum("tn,tnk->nk", weight, states)
    if keep is not None:
        keep |= {"caches": caches, "states": states, "hidden": hidden, "weight": weight, "pooled": pooled}
    return (pooled @ model["out"])[:, 0] + model["out_b"][0]


def _back(cache: list, u: np.ndarray, mask: np.ndarray, grad: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of one direction's projected inputs and recurrent weights."""
    steps = np.empty((*grad.shape[:2], 3 * STATE), np.float32)
    du, dh = np.zeros_like(u), np.zeros(grad.shape[1:], np.float32)
    for t in range(len(grad) - 1, -1, -1):
        h, z, r, n, rec = cache[t]
        dh = dh + grad[t]
        active = dh * mask[t]
        dn = active * (1 - z) * (1 - n * n)
        dz = active * (h - n) * z * (1 - z)
        dr = dn * rec * r * (1 - r)
        into = np.concatenate([dz, dr, dn * r], axis=1)
        steps[t] = np.concatenate([dz, dr, dn], axis=1)
        du += h.T @ into
        dh = dh * (1 - mask[t]) + active * z + into @ u.T
    return steps, du


def gradients(model: dict, words: Words, tokens: np.ndarray, mask: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, dict]:
    """Mean loss of labelled windows and its gradient."""
    x, rows, of = _inputs(model, words)
    keep: dict = {}
    logits = forward(model, x @ model["in"] + model["in_b"], tokens, mask, keep)
    p = _sigmoid(logits)
    total = weights.sum()
    loss = float(-(weights * np.where(labels > 0, np.log(p + 1e-7), np.log(1 - p + 1e-7))).sum() / total)
    dlogit = ((p - labels) * weights / total).astype(np.float32)
    g = {"out": keep["pooled"].T @ dlogit[:, None], "out_b": dlogit.sum(keepdims=True)}
    dpooled = dlogit[:, None] * model["out"][:, 0]
    weight, states, hidden = keep["weight"], keep["states"], keep["hidden"]
    dstates = weight[:, :, None] * dpooled
    dweight = np.einsum("tnk,nk->tn", states, dpooled)
    dscore = weight * (dweight - (weight * dweight).sum(axis=0))
    g["pick"] = np.einsum("tnk,tn->k", hidden, dscore)[:, None]
    dhidden = dscore[:, :, None] * model["pick"][:, 0] * (1 - hidden * hidden)
    g["att"], g["att_b"] = np.einsum("tnk,tnj->kj", states, dhidden), dhidden.sum(axis=(0, 1))
    dstates = (dstates + dhidden @ model["att"].T).astype(np.float32)
    there = mask[:, :, None].astype(np.float32)
    fore, g["uf"] = _back(keep["caches"][0], model["uf"], there, dstates[:, :, :STATE])
    back, g["ub"] = _back(keep["caches"][1], model["ub"], there[::-1], dstates[::-1, :, STATE:])
    dprojected = np.zeros((len(x), 6 * STATE), np.float32)
    flat = np.concatenate([fore, back[::-1]], axis=2).reshape(-1, 6 * STATE)
    order = np.argsort(tokens.ravel(), kind="stable")
    seen = tokens.ravel()[order]
    heads = np.flatnonzero(np.r_[True, seen[1:] != seen[:-1]])
    dprojected[seen[heads]] = np.add.reduceat(flat[order], heads, axis=0)
    g["in"], g["in_b"] = x.T @ dprojected, dprojected.sum(axis=0)
    dx = dprojected @ model["in"].T
    g["word"], g["char"] = np.zeros_like(model["word"]), np.zeros_like(model["char"])
    np.add.at(g["word"], model["word_at"][words.bucket], dx[:, :WORD_SIZE])
    np.add.at(g["char"], rows, (dx[:, WORD_SIZE:] / words.scale)[of])
    g["word"][0] = g["char"][0] = 0
    return loss, g


def batch_of(texts: list[str]) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words, tokens and mask of texts of at most WINDOW words each."""
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    words = Words(np.frombuffer(b"".join(raw), dtype=np.uint8), offsets)
    return words, *token_grid(words, np.cumsum(words.counts) - words.counts, words.counts)


def token_grid(words: Words, first: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and mask, by time and window."""
    time = np.arange(WINDOW)[:, None]
    mask = time < lengths
    return words.place[np.where(mask, first + time, 0)], mask


def train(texts: list[str], labels: np.ndarray, groups: np.ndarray, steps: int = 280, batch: int = 512, rate: float = 0.01, decay: float = 0.02) -> dict:
    """A model of labelled windows; ``groups`` tells which document a window is from.

    After two thirds of the ``steps`` on all windows, the windows of a document with label
    1 that score lowest are left out: its label need not hold for every window.
    """
    rng = np.random.default_rng(3)
    ready = {int(s): batch_of(texts[s : s + batch]) for s in range(0, len(texts), batch)}
    model = initial(*_known(ready, groups))
    first = {k: np.zeros_like(v) for k, v in model.items() if not k.endswith("_at")}
    second = {k: np.zeros_like(v) for k, v in first.items()}
    weights = np.where(labels > 0, 0.5 / max(labels.mean(), 1e-6), 0.5 / max(1 - labels.mean(), 1e-6)).astype(np.float32)
    step, epochs = 0, max(3, -(-steps // len(ready)))
    for epoch in range(epochs):
        if epoch == epochs - epochs // 3:
            weights = weights * _telling(model, ready, labels, groups)
        for start in rng.permutation(sorted(ready)).tolist():
            stop, step = start + batch, step + 1
            if not weights[start:stop].any():
                continue
            _, g = gradients(model, *ready[start], labels[start:stop].astype(np.float32), weights[start:stop])
            for k, value in g.items():
                first[k] += 0.1 * (value - first[k])
                second[k] += 0.001 * (value * value - second[k])
                pace = rate * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                if k in ("word", "char"):
                    model[k] *= np.float32(1 - rate * decay)
                model[k] -= (pace * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32)
    return model


def _known(ready: dict, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Embedding rows of the buckets of words and of pieces that enough documents hold."""
    _, document = np.unique(groups, return_inverse=True)
    size, out = int(document.max()) + 1, []
    pairs: tuple[list, list] = ([], [])
    for start, (words, _, _) in sorted(ready.items()):
        owner = document[start + words.owner]
        pairs[0].append(np.unique(words.bucket[words.place] * size + owner))
        met = np.unique(words.place * size + owner)
        order = np.argsort(words.piece_row, kind="stable")
        count = np.bincount(words.piece_row, minlength=len(words.bucket))
        heads = np.cumsum(count) - count
        word = met // size
        pieces = words.piece[order][flat_index(heads[word], count[word])]
        pairs[1].append(np.unique(pieces * size + np.repeat(met % size, count[word])))
    for some in pairs:
        held = np.bincount(np.unique(np.concatenate(some)) // size, minlength=BUCKETS)
        out.append(np.where(held >= LEAST_DOCUMENTS, np.cumsum(held >= LEAST_DOCUMENTS), 0).astype(np.int32))
    return out[0], out[1]


def _telling(model: dict, ready: dict, labels: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """1 for windows that count on: all of label 0, of label 1 the better half of a document."""
    logits = np.concatenate([forward(model, _inputs(model, w)[0] @ model["in"] + model["in_b"], t, m) for _, (w, t, m) in sorted(ready.items())])
    out = np.ones(len(labels), np.float32)
    for group in np.unique(groups[labels > 0]):
        at = np.flatnonzero(groups == group)
        out[at[logits[at] < np.median(logits[at])]] = 0
    return out


def score_windows(model: dict, words: Words, block: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """Logit and text of every window of all texts."""
    first, lengths, text = windows(words.counts)
    projected = _inputs(model, words)[0] @ model["in"] + model["in_b"]
    out = np.empty(len(first), np.float32)
    for start in range(0, len(first), block):
        part = slice(start, start + block)
        out[part] = forward(model, projected, *token_grid(words, first[part], lengths[part]))
    return out, text
