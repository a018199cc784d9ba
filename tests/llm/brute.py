"""Plain versions of trained operators, a document and a position at a time."""

import math
import re

import numpy as np

from shelfwise.llm import language, toxicity


def _states(network, side, data):
    h, u, g = np.zeros(network.inner[side].shape[0]), network.inner[side], network.gates[side]
    n, out = len(h), []
    for b in data:
        z = 1 / (1 + np.exp(-(h @ u[:, :n] + g[b, :n])))
        r = 1 / (1 + np.exp(-(h @ u[:, n : 2 * n] + g[b, n : 2 * n])))
        new = np.tanh(r * (h @ u[:, 2 * n :]) + g[b, 2 * n :])
        h = (1 - z) * new + z * h
        out.append(h)
    return out


def language_probabilities(network, data):
    """The mean over all bytes of a text; each window is read with its context on both sides."""
    total, n = np.zeros(len(network.languages)), network.inner[0].shape[0]
    for start in range(0, len(data), language.WINDOW):
        stop = min(start + language.WINDOW, len(data))
        lo, hi = max(0, start - language.CONTEXT), min(len(data), stop + language.CONTEXT)
        left, right = _states(network, 0, data[lo:hi]), _states(network, 1, data[lo:hi][::-1])[::-1]
        for k in range(start - lo, stop - lo):
            logits = left[k] @ network.label[:n] + right[k] @ network.label[n:] + network.bias
            e = np.exp(logits - logits.max())
            total += e / e.sum()
    return total / max(1, len(data))


def _features(text):
    out = set()
    for word in re.findall(r"[^\W\d_]+", text.lower()):
        out.add("w" + word)
        out |= {f"{k}{word[:k]}" for k in (4, 5) if len(word) > k}
    return out


def best_features(rows):
    """The features that tell a category best; rows are (text, marks)."""
    found, n, chosen = [_features(t) for t, _ in rows], len(rows), set()
    for k in range(len(rows[0][1])):
        pos, ranked = sum(y[k] for _, y in rows), []
        for f in set().union(*found):
            have = sum(f in x for x in found)
            both = sum(f in x and y[k] for x, (_, y) in zip(found, rows))
            if have < 3 or not 0 < pos < n:
                continue
            g2 = 0.0
            for seen, expected in ((both, have * pos / n), (have - both, have * (n - pos) / n), (pos - both, (n - have) * pos / n), (n - have - pos + both, (n - have) * (n - pos) / n)):
                g2 += 2 * seen * math.log(seen / expected) if seen else 0.0
            if g2 >= toxicity.LEAST_G2:
                ranked.append((-g2, f))
        chosen |= {f for _, f in sorted(ranked)[: toxicity.MAX_FEATURES]}
    return chosen


def chain_probabilities(chain, text):
    """Each category's probability, from the words of the text and the categories before."""
    found, out = _features(text), []
    for weights in chain.weights:
        total = weights[-1] + sum(weights[k] for f, k in chain.vocabulary.items() if f in found)
        total += sum(w * p for w, p in zip(weights[len(chain.vocabulary) :], out))
        out.append(1 / (1 + math.exp(-max(-30.0, min(30.0, total)))))
    return out
