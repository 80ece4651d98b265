"""Personal data: exact patterns, and a character-level bidirectional LSTM with a CRF for what they miss."""

from __future__ import annotations

import bisect
import functools
import hashlib
import io
import random
import re
import threading
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.llm.hashing import stretches
from citeweave.llm.shared import documents, map_batches

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

# ---- exact patterns ---------------------------------------------------------------

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match never starts or ends inside a run of digits, so the look-behind changes nothing but keeps long runs linear.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return re.sub("[^0-9]", "", s)


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches of local part, @, domain: found from each @, as the local part is the whole run before it."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            last = m.end()
            yield "email", start, last
        at = text.find("@", max(last, at + 1))


#: Every pattern needs one of these, so texts without them have no base spans.
_SIGN = re.compile("[0-9@]")


def base_spans(text: str) -> list[Span]:
    """Email, ip, card and phone by pattern, in that order and then by start."""
    found = list(_emails(text))
    found += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    found += [("card", *m.span()) for m in _CARD.finditer(text) if 16 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
    found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return found


def listed(spans: Sequence[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1], x[2])))


# ---- BiLSTM-CRF -------------------------------------------------------------------

#: Tags: outside, then begin and inside of each kind.
TAGS = 1 + 2 * len(KINDS)
#: Characters a window holds, characters after which the next one starts, characters of a training example; embedding and hidden sizes.
WINDOW, STRIDE, EXAMPLE, EMBED, HIDDEN = 256, 224, 96, 12, 12
#: Windows that are tagged together, and bytes of text whose windows are put together.
TOGETHER, STRETCH = 512, 1 << 21
_CODES = {chr(c): c - 31 for c in range(32, 127)} | {"\n": 97, "\t": 97, "\r": 97}
_OTHER, _PAD = 96, 98
_ALPHABET = 99
_TABLE = np.full(128, _OTHER, np.uint8)
for _c, _n in _CODES.items():
    _TABLE[ord(_c)] = _n


def codes(text: str) -> np.ndarray:
    """A code per character; all beyond ASCII share one."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _TABLE[np.minimum(points, 127)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def _allowed() -> tuple[np.ndarray, np.ndarray]:
    """Penalties of impossible tag pairs and first tags: inside needs begin or inside of its kind before it."""
    pairs, first = np.zeros((TAGS, TAGS), np.float32), np.zeros(TAGS, np.float32)
    for k in range(len(KINDS)):
        inside = 2 + 2 * k
        pairs[:, inside] = first[inside] = -1e4
        pairs[inside, inside] = pairs[inside - 1, inside] = 0
    return pairs, first


_PAIRS, _FIRST = _allowed()

#: Rows a pass holds of each time, and numbers it holds of as many windows as are tagged together at most.
_ROWS = 2 * HIDDEN + EMBED + 1
_HELD = 2 * TOGETHER * (WINDOW + 2) * _ROWS
_KEPT = threading.local()


def _memory(size: int) -> np.ndarray:
    """Numbers of any value, kept for the thread's next pass, as new pages take a good part of a pass's time. What more than _HELD need is not kept."""
    if size > _HELD:
        return np.empty(size, np.float32)
    if not hasattr(_KEPT, "numbers"):
        _KEPT.numbers = np.empty(_HELD, np.float32)
    return _KEPT.numbers[:size]


class Tagger:
    """Parameters and passes of the network. Both directions run as one batch of two."""

    def __init__(self, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        normal = lambda scale, *shape: rng.normal(0, scale, shape).astype(np.float32)
        self.p = {"embed": normal(0.3, _ALPHABET, EMBED), "wx": normal(0.25, 2, EMBED, 4 * HIDDEN), "wh": normal(0.25, 2, HIDDEN, 4 * HIDDEN), "b": np.zeros((2, 1, 4 * HIDDEN), np.float32), "out": normal(0.2, 2 * HIDDEN, TAGS), "bias": np.zeros(TAGS, np.float32), "move": normal(0.05, TAGS, TAGS)}
        self.p["b"][:, :, HIDDEN : 2 * HIDDEN] = 1
        self.sure = np.full(len(KINDS), 0.5)  # least certainty of an added span, by kind

    def _lstm(self, ids: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
        """Hidden states of both directions, (2, time, batch, hidden), each in its own order."""
        steps = np.stack([ids.T, ids.T[::-1]])
        x = np.matmul(self.p["embed"][steps].reshape(2, -1, EMBED), self.p["wx"]).reshape(2, ids.shape[1], ids.shape[0], -1) + self.p["b"][:, None]
        h = c = np.zeros((2, ids.shape[0], HIDDEN), np.float32)
        out, tape = np.empty((2, ids.shape[1], ids.shape[0], HIDDEN), np.float32), []
        for t in range(ids.shape[1]):
            z = x[:, t] + np.matmul(h, self.p["wh"])
            gates, cand = _sigmoid(z[:, :, : 3 * HIDDEN]), np.tanh(z[:, :, 3 * HIDDEN :])
            i, f, o = gates[:, :, :HIDDEN], gates[:, :, HIDDEN : 2 * HIDDEN], gates[:, :, 2 * HIDDEN :]
            before, h_before = c, h
            c = f * c + i * cand
            tc = np.tanh(c)
            h = o * tc
            out[:, t] = h
            if keep:
                tape.append((i, f, o, cand, before, tc, h_before))
        return out, tape

    def emissions(self, ids: np.ndarray) -> np.ndarray:
        """(batch, time, tags).

        The network of _lstm with features before windows in memory and sigmoids as
        hyperbolic tangents of halves, which takes a fraction of the time. Each time has
        _ROWS rows: the state of the forward direction before it, its character's
        embedding, ones, the state of the backward direction after it. What a direction
        reads is a slice of them, and its new state goes into the next time's rows, in
        memory that passes reuse.
        """
        n, steps = ids.shape
        one = HIDDEN + EMBED
        half = np.repeat(np.array([0.5, 1], np.float32), [3 * HIDDEN, HIDDEN])
        wh, wx, b = ((self.p[k] * half).transpose(0, 2, 1) for k in ("wh", "wx", "b"))
        wh = wh * np.float32(0.5)  # states are kept twice as large
        forward, backward = np.concatenate([wh[0], wx[0], b[0]], axis=1), np.concatenate([wx[1], b[1], wh[1]], axis=1)
        rows = _memory((steps + 2) * _ROWS * n).reshape(steps + 2, _ROWS, n)
        letters, order = np.ascontiguousarray(self.p["embed"].T), np.ascontiguousarray(ids.T)
        for t in range(steps):
            letters.take(order[t], axis=1, out=rows[t + 1, HIDDEN:one], mode="clip")
        rows[:, one] = 1
        rows[1, :HIDDEN] = rows[steps, one + 1 :] = 0
        z, c, tc = np.empty((2, 4 * HIDDEN, n), np.float32), np.zeros((2, HIDDEN, n), np.float32), np.empty((2, HIDDEN, n), np.float32)
        i, f, o, cand = (z[:, k * HIDDEN : (k + 1) * HIDDEN] for k in range(4))
        gates = z[:, : 3 * HIDDEN]
        for t in range(1, steps + 1):
            u = steps + 1 - t
            np.matmul(forward, rows[t, : one + 1], out=z[0])
            np.matmul(backward, rows[u, HIDDEN:], out=z[1])
            np.tanh(z, out=z)
            gates += 1
            c *= f
            np.multiply(i, cand, out=tc)
            c += tc
            c *= 0.5
            np.tanh(c, out=tc)
            np.multiply(tc[0], o[0], out=rows[t + 1, :HIDDEN])
            np.multiply(tc[1], o[1], out=rows[u - 1, one + 1 :])
        # From the ones before a time to the forward state after it, with nothing for its own rows.
        last = self.p["out"].T * np.float32(0.5)
        weights = np.concatenate([self.p["bias"][:, None], last[:, HIDDEN:], np.zeros((TAGS, _ROWS), np.float32), last[:, :HIDDEN]], axis=1)
        size = rows.itemsize * n
        around = np.ndarray((steps, weights.shape[1], n), np.float32, rows, one * size, (_ROWS * size, size, rows.itemsize))
        return np.matmul(weights, around).transpose(2, 0, 1)

    def outside(self, e: np.ndarray) -> np.ndarray:
        """Whether all tags outside are a window's best path, for each window it can be told of without decoding.

        Gains over that path are bounded by letting a stretch go on with the best inside
        tag of any kind and the best move: what no such stretch gains, no path does.
        """
        move = self.p["move"] + _PAIRS - self.p["move"][0, 0]
        begin, inside = np.arange(1, TAGS, 2), np.arange(2, TAGS, 2)
        enter, leave = move[0, begin].max(), move[1:, 0].max()
        next_begin, next_inside = move[1:][:, begin].max(), move[1:][:, inside].max()
        e = e.transpose(1, 2, 0)
        begins, on = e[:, 1::2].max(axis=1) - e[:, 0], e[:, 2::2].max(axis=1) - e[:, 0]
        gain = begins[0] + max(0.0, enter)
        most = gain.copy()
        on += next_inside
        np.maximum(on, begins + next_begin, out=on)
        begins += enter
        for start, more in zip(begins[1:], on[1:], strict=True):
            gain += more
            np.maximum(gain, start, out=gain)
            np.maximum(most, gain, out=most)
        return np.maximum(most + leave, gain) <= 0

    def marginals(self, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities of tags, summed probabilities of tag pairs, and log of the partition function, by sums that are scaled to one at each step."""
        n, steps, _ = e.shape
        top = e.max(axis=2, keepdims=True)
        p, move = np.exp(e - top) + 1e-30, np.exp(self.p["move"] + _PAIRS)
        forward, backward, scale = np.empty_like(p), np.ones_like(p), np.empty((n, steps, 1), p.dtype)
        a = p[:, 0] * np.exp(_FIRST)
        for t in range(steps):
            if t:
                a = (a @ move) * p[:, t]
            scale[:, t] = a.sum(axis=1, keepdims=True)
            a = forward[:, t] = a / scale[:, t]
        joint = p / scale
        for t in range(steps - 2, -1, -1):
            backward[:, t] = (backward[:, t + 1] * joint[:, t + 1]) @ move.T
        joint *= backward
        pair = move * (forward[:, :-1].reshape(-1, TAGS).T @ joint[:, 1:].reshape(-1, TAGS))
        return forward * backward, pair, np.log(scale).sum(axis=(1, 2)) + top.sum(axis=(1, 2))

    def decode(self, e: np.ndarray) -> np.ndarray:
        """Best tags of each window (Viterbi). Where each best path came from is only worked out along the paths taken."""
        n, steps, _ = e.shape
        e = np.ascontiguousarray(e.transpose(1, 2, 0))
        move, best = (self.p["move"] + _PAIRS)[:, :, None], np.empty_like(e)
        best[0] = e[0] + _FIRST[:, None]
        for t in range(1, steps):
            np.add((best[t - 1][:, None] + move).max(axis=0), e[t], out=best[t])
        tags = np.empty((n, steps), np.int64)
        tags[:, -1] = best[-1].argmax(axis=0)
        for t in range(steps - 1, 0, -1):
            tags[:, t - 1] = (best[t - 1] + move[:, tags[:, t], 0]).argmax(axis=0)
        return tags

    def gradients(self, ids: np.ndarray, tags: np.ndarray) -> tuple[dict[str, np.ndarray], float]:
        n, steps = ids.shape
        h, tape = self._lstm(ids, keep=True)
        joined = np.concatenate([h[0], h[1, ::-1]], axis=2)
        e = (joined @ self.p["out"] + self.p["bias"]).transpose(1, 0, 2)
        single, pair, z = self.marginals(e)
        rows = np.arange(n)[:, None]
        gold = e[rows, np.arange(steps), tags].sum(axis=1) + self.p["move"][tags[:, :-1], tags[:, 1:]].sum(axis=1)
        d_e = single.copy()
        d_e[rows, np.arange(steps), tags] -= 1
        np.subtract.at(pair, (tags[:, :-1].ravel(), tags[:, 1:].ravel()), 1)
        d_e = d_e.transpose(1, 0, 2) / n
        g = {"move": pair / n, "out": joined.reshape(-1, 2 * HIDDEN).T @ d_e.reshape(-1, TAGS), "bias": d_e.sum(axis=(0, 1))}
        d_joined = d_e @ self.p["out"].T
        d_h = np.stack([d_joined[:, :, :HIDDEN], d_joined[::-1, :, HIDDEN:]])
        d_z = np.empty((2, steps, n, 4 * HIDDEN), np.float32)
        dh_next = dc_next = np.zeros((2, n, HIDDEN), np.float32)
        wh = np.zeros_like(self.p["wh"])
        for t in range(steps - 1, -1, -1):
            i, f, o, cand, before, tc, h_before = tape[t]
            dh = d_h[:, t] + dh_next
            dc = dh * o * (1 - tc * tc) + dc_next
            dz = np.concatenate([dc * cand * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - cand * cand)], axis=2)
            d_z[:, t] = dz
            wh += np.matmul(h_before.transpose(0, 2, 1), dz)
            dh_next, dc_next = np.matmul(dz, self.p["wh"].transpose(0, 2, 1)), dc * f
        order = np.stack([ids.T, ids.T[::-1]])
        inputs = self.p["embed"][order].reshape(2, -1, EMBED)
        flat = d_z.reshape(2, -1, 4 * HIDDEN)
        g |= {"wh": wh, "wx": np.matmul(inputs.transpose(0, 2, 1), flat), "b": flat.sum(axis=1, keepdims=True)}
        g["embed"] = np.zeros_like(self.p["embed"])
        np.add.at(g["embed"], order.reshape(-1), np.matmul(flat, self.p["wx"].transpose(0, 2, 1)).reshape(-1, EMBED))
        return g, float((z - gold).mean())


def tags_of(length: int, spans: Sequence[Span]) -> np.ndarray:
    tags = np.zeros(length, np.int64)
    for kind, start, end in spans:
        tags[start:end] = 2 + 2 * KINDS.index(kind)
        tags[start] = 1 + 2 * KINDS.index(kind)
    return tags


def _batch(examples: Sequence[tuple[str, Sequence[Span]]]) -> tuple[np.ndarray, np.ndarray]:
    ids, tags = np.full((len(examples), EXAMPLE), _PAD, np.int64), np.zeros((len(examples), EXAMPLE), np.int64)
    for n, (text, spans) in enumerate(examples):
        ids[n, : len(text)] = codes(text)[:EXAMPLE]
        tags[n, : len(text)] = tags_of(len(text), spans)[:EXAMPLE]
    return ids, tags


def train(examples: Sequence[tuple[str, Sequence[Span]]], rounds: int = 700, batch: int = 64, rate: float = 0.02, seed: int = 11) -> Tagger:
    """Fit a tagger to labelled spans by Adam on the CRF's negative log-likelihood. Texts are cut or padded to EXAMPLE.

    One example in six is kept out of that, and places the thresholds of the kinds.
    """
    apart = len(examples) // 6
    ids, tags = _batch(examples[apart:])
    model, rng = Tagger(seed), np.random.default_rng(seed)
    first, second = ({k: np.zeros_like(v) for k, v in model.p.items()} for _ in range(2))
    for turn in range(1, rounds + 1):
        pick = rng.integers(0, len(ids), batch)
        grads, _ = model.gradients(ids[pick], tags[pick])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        step = rate * min(1.0, 2 * (1 - turn / (rounds + 1)))
        for k, g in grads.items():
            g = g * min(1, 5 / (norm + 1e-9))
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            model.p[k] -= (step * (first[k] / (1 - 0.9**turn)) / (np.sqrt(second[k] / (1 - 0.99**turn)) + 1e-7)).astype(np.float32)
    model.sure = thresholds(model, examples[:apart])
    return model


def thresholds(model: Tagger, examples: Sequence[tuple[str, Sequence[Span]]], precision: float = 0.97) -> np.ndarray:
    """Per kind the least mean probability of a decoded span's tags at which at least this share of the spans above it is labelled; 0.5 at least."""
    ids, _ = _batch(examples)
    found: list[list[tuple[float, bool]]] = [[] for _ in KINDS]
    for at in range(0, len(examples), TOGETHER):
        e = model.emissions(ids[at : at + TOGETHER])
        single, _, _ = model.marginals(e)
        for i, tags in enumerate(model.decode(e)):
            text, spans = examples[at + i]
            for kind, s, f in spans_of(tags[: len(text)]):
                found[KINDS.index(kind)].append((float(single[i, np.arange(s, f), tags[s:f]].mean()), (kind, s, f) in spans))
    out = np.full(len(KINDS), 0.5)
    for k, some in enumerate(found):
        some.sort(reverse=True)
        right = np.cumsum([ok for _, ok in some]) >= precision * np.arange(1, len(some) + 1)
        if len(some) and not right[-1]:
            out[k] = max(0.5, some[int(np.flatnonzero(right)[-1])][0] if right.any() else 1.0)
    return out


def spans_of(tags: np.ndarray) -> list[Span]:
    """The spans of a row of tags."""
    out = []
    for s in np.flatnonzero(tags % 2 == 1).tolist():
        f = s + 1
        while f < len(tags) and tags[f] == tags[s] + 1:
            f += 1
        out.append((KINDS[(int(tags[s]) - 1) // 2], s, f))
    return out


def labelled_examples(count: int = 6000, seed: int = 11) -> list[tuple[str, list[Span]]]:
    """Stretches of filler with labelled personal data, in forms the patterns know and forms they don't, and look-alikes that are none.

    A stretch may begin or end inside a span, of which the rest is labelled, as a window's edge may.
    """
    rng = random.Random(seed)
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    letters = lambda low, high: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(low, high)))
    signs = False  # junk: a sign, once or more, after every word
    pieces = ["th", "er", "on", "an", "re", "é", "ou", "ei", "sch", "ción", "ment", "la", "de", "ü", "st", "in", "a", "o", "qu", "ly", "ß", "ñ", "ing", "ver", "ge", "ê"]

    def word() -> str:
        w = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 5))) if rng.random() < 0.7 else letters(1, 9)
        w = w.capitalize() if rng.random() < 0.15 else w.upper() if rng.random() < 0.02 else w
        return w + rng.choice("#*$%&!?~^|=+_<>,:;-") * rng.randint(1, 4) if signs else w

    def name() -> str:
        n = "".join(rng.choice(pieces[:5] + pieces[11:13] + pieces[14:18]) for _ in range(rng.randint(1, 4))) if rng.random() < 0.5 else letters(2, 9)
        return n if n.isascii() else letters(2, 9)

    def email() -> str:
        user = rng.choice([name(), f"{name()}.{name()}", f"{name()}{number(2)}", f"{name()}.{number(2)}", f"{name()}_{name()}", f"{name()}-{name()}", f"{name()[:1]}.{name()}", f"{name().capitalize()}.{name().capitalize()}"])
        parts = [rng.choice([name(), f"mail{number(1)}", f"{name()}-{name()}"]), *rng.choice([[], [], ["example"], [name()]]), rng.choice(["com", "org", "net", "de", "fr", "io", "es", "edu", "co.uk"])]
        at, dot = rng.choice([("@", ".")] * 3 + [(" (at) ", "."), (" [at] ", "."), (" (at) ", " (dot) "), (" [at] ", " [dot] "), ("(at)", "."), ("[at]", "[dot]"), (" @ ", "."), ("(at)", "(dot)")])
        return user + at + dot.join(parts)

    def ip() -> str:
        return rng.choice([".", ".", ".", " . ", "[.]"]).join(str(rng.randint(0, 255)) for _ in range(4))

    def card() -> str:
        d = rng.choice("3456") + number(14)
        d += next(c for c in "0123456789" if luhn(d + c))
        return rng.choice(["", " ", "-", ".", "  ", " - ", "/"]).join(d[i : i + 4] for i in range(0, 16, 4))

    def phone() -> str:
        a, b, c = number(3), number(3), number(4)
        return rng.choice([
            f"+1 ({a}) {b}-{c}", f"+{number(2)} {a} {b} {c}", f"({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", f"+{number(1)}-{a}-{b}-{c}", f"+{number(1)}.{a}.{b}.{c}", f"00{number(2)} {a} {b}{c}", f"0{number(2)} {c} {c}", f"({a}){b}-{c}", f"1-{a}-{b}-{c}",
        ])

    def other() -> str:
        hexes = "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice([18, 32, 40])))
        return rng.choice([
            f"password={hexes}", f'token = "{hexes}"', "AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16)), f"version {number(1)}.{number(1)}", f"{number(1)}.{number(1)}.{number(1)}", hexes,
            f"{rng.randint(1900, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}", f"{rng.randint(10, 23)}:{number(2)}", f"${number(3)}.{number(2)}", number(rng.randint(1, 9)), f"{number(1)},{number(3)},{number(3)}", f"{rng.randint(10, 28)}/{rng.randint(10, 12)}/{rng.randint(1900, 2030)}",
            f"@{name()}", f"[{number(2)}]", f"({rng.randint(1900, 2030)})", f"{rng.randint(1900, 1999)}-{rng.randint(2000, 2030)}", f"pp. {number(3)}-{number(3)}", f"10.{number(4)}/{name()}.{number(4)}", f"n = {number(2)}, {number(3)}", f"x @ {number(2)}", f"{name()} at {name()}",
            f"ISBN 978-{number(1)}-{number(4)}-{number(4)}-{number(1)}", f"{number(5)}-{number(5)}", f"({number(1)}) {word()}", f"({word()}) {word()}", f"[{word()}]", f"https://{name()}.com/{name()}/{number(3)}", f"{name()}.{name()}.com", f"{number(3)}, {number(3)}, {number(3)}", f"#{number(6)}", f"{number(2)}%",
        ])

    makers: dict[str, Callable[[], str]] = {"email": email, "ip": ip, "card": card, "phone": phone}
    out = []
    for _ in range(count):
        text, spans, short, signs = "", [], rng.random() < 0.25, rng.random() < 0.08
        for _ in range(rng.randint(0, 3 if short else 14)):
            text += word() + rng.choice([" ", " ", " ", ", ", ".\n", ". ", "; ", "'"])
        for _ in range(rng.choice([0, 1, 1, 1, 2, 2])):
            kind = rng.choice([*KINDS, *KINDS, "other", "other", "other"])
            piece = makers[kind]() if kind in makers else other()
            text += rng.choice(["", "", "", "", "(", ": ", "<", '"'])
            if kind in makers:
                spans.append((kind, len(text), len(text) + len(piece)))
            text += piece + rng.choice([" ", " ", " ", ". ", ", ", "\n", ") ", "; ", "> ", '" ', ""])
            if text[-1].isalnum() and not short:
                text += rng.choice([" ", ".\n", ", "])
            for _ in range(rng.randint(0, 2) if short else rng.randint(0, 6)):
                text += word() + rng.choice([" ", " ", ". ", ", "])
        while len(text) < EXAMPLE and not short and rng.random() < 0.97:  # some texts end early
            text += word() + rng.choice([" ", " ", " ", ", ", ". "])
        cut = rng.randint(0, max(0, len(text) - EXAMPLE))
        seen = [(k, max(s, cut) - cut, min(e, cut + EXAMPLE) - cut) for k, s, e in spans]
        out.append((text[cut : cut + EXAMPLE], [(k, s, e) for k, s, e in seen if e - s >= 4]))
    return out


@functools.lru_cache(maxsize=2)
def _trained(seed: int) -> dict[str, np.ndarray]:
    model = train(labelled_examples(seed=seed), seed=seed)
    return model.p | {"sure": model.sure}


_TAGGERS: dict[int, Tagger] = {}


def default_tagger(spark: SparkSession, seed: int = 11) -> Tagger:
    """The tagger fitted to labelled_examples, in one task of the cluster and once per driver process."""
    if seed not in _TAGGERS:

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for _ in batches:
                out = io.BytesIO()
                np.savez(out, **_trained(seed))
                yield pd.DataFrame({"model": [out.getvalue()]})

        data = spark.range(1, numPartitions=1).mapInPandas(run, "model binary").first()[0]
        model = Tagger(seed)
        model.p = dict(np.load(io.BytesIO(bytes(data))))
        model.sure = model.p.pop("sure")
        _TAGGERS[seed] = model
    return _TAGGERS[seed]


def _valid(kind: str, piece: str, before: str, after: str) -> bool:
    """What tags can't see: no end inside a word, and the values that the kinds allow (an at in some spelling, parts up to 255, the check digit, numbers of digits)."""
    if not piece or before.isalnum() and piece[0].isalnum() or after.isalnum() and piece[-1].isalnum():
        return False
    digits = _digits(piece)
    if kind == "ip":
        parts = re.findall("[0-9]+", piece)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == "email":
        return re.search(r"@|\bat\b", piece) is not None
    return kind == "card" and 13 <= len(digits) <= 19 and luhn(digits) or kind == "phone" and 8 <= len(digits) <= 15


def _windows(text: str) -> list[tuple[int, np.ndarray]]:
    """(start, codes of windows STRIDE apart) that cover the whole text: those that it fills, then the last one, padded to a multiple of 32."""
    if not text:
        return []
    points, full = codes(text), max(0, -(-(len(text) - WINDOW) // STRIDE))
    rest = points[full * STRIDE :]
    last = np.full((1, -(-len(rest) // 32) * 32), _PAD, np.uint8)
    last[0, : len(rest)] = rest
    many = np.ndarray((full, WINDOW), np.uint8, points, 0, (STRIDE, 1)) if full else None
    return [*([(0, many)] if full else []), (full * STRIDE, last)]


def _best(spans: dict[Span, float]) -> list[Span]:
    """The spans of greatest total weight that don't overlap, in order (weighted interval scheduling)."""
    order = sorted(spans, key=lambda x: (x[2], x))
    ends = [x[2] for x in order]
    total, taken = [0.0], [False]
    before = [bisect.bisect_right(ends, x[1], 0, i) for i, x in enumerate(order)]
    for i, x in enumerate(order):
        with_x = total[before[i]] + spans[x]
        taken.append(with_x > total[-1])
        total.append(max(with_x, total[-1]))
    out, i = [], len(order)
    while i:
        if taken[i]:
            out.append(order[i - 1])
            i = before[i - 1]
        else:
            i -= 1
    return out[::-1]


def find(texts: Sequence[str], model: Tagger | None) -> list[tuple[list[Span], list[Span]]]:
    """Base and added spans of each text.

    Every window of every text is tagged. Decoded spans that no base span overlaps and that
    are as certain as the tagger asks of their kind are candidates, with the sum of their
    characters' surplus certainty as weight. What touches an inner
    edge, or windows disagree on, and is whole in no window is tagged again in a stretch around
    it, which grows until it holds all of the span, however long. Of a text's candidates the
    set of greatest weight without overlaps is added.
    """
    base = [base_spans(t) if _SIGN.search(t) else [] for t in texts]
    candidates: list[dict[Span, float]] = [{} for _ in texts]
    whole: list[list[tuple[int, int]]] = [[] for _ in texts]
    cut: dict[int, list[tuple[int, int]]] = {}

    starts, ends = ([np.sort([x[at] for x in own]) for own in base] for at in (1, 2))

    def in_base(n: int, s: int, f: int) -> bool:
        """Whether a base span overlaps: else as many start before f as end by s."""
        return len(starts[n]) > 0 and int(np.searchsorted(starts[n], f)) != int(np.searchsorted(ends[n], s, "right"))

    def opened(ids: np.ndarray) -> tuple[list[int], np.ndarray]:
        """The rows whose best path may hold a span, and their emissions."""
        e = model.emissions(ids)
        open_to = np.flatnonzero(~model.outside(e))
        return open_to.tolist(), e[open_to]

    def tagged(group: Sequence[tuple[int, int]], e: np.ndarray) -> list[tuple[int, int, int, int]]:
        """Tag the stretches (text, start). Whole spans become candidates; returns (place in group, text, start, end) of those cut at an inner edge."""
        width, tags = e.shape[1], model.decode(e)
        pieces, unsure = [], []
        for k in np.flatnonzero((tags > 0).any(axis=1)).tolist():
            n, w = group[k]
            text = texts[n]
            for kind, b, stop in spans_of(tags[k]):
                s, f = w + b, min(w + stop, len(text))
                if b == 0 and w > 0 or stop == width and f < len(text):
                    pieces.append((k, n, s, f))
                    continue
                whole[n].append((s, f))
                if not in_base(n, s, f) and _valid(kind, text[s:f], text[s - 1 : s] if s else "", text[f : f + 1]):
                    unsure.append((k, kind, b, stop))
        rows = sorted({k for k, *_ in unsure})
        single = dict(zip(rows, model.marginals(e[rows])[0], strict=True)) if rows else {}
        for k, kind, b, stop in unsure:
            n, w = group[k]
            sure = single[k][np.arange(b, stop), tags[k, b:stop]]
            if sure.mean() >= model.sure[KINDS.index(kind)]:
                span = (kind, w + b, min(w + stop, len(texts[n])))
                candidates[n][span] = max(candidates[n].get(span, 0.0), float((sure - 0.5).sum()))
        return pieces

    # Windows that wait for a pass, and those few that wait to be decoded, by width: a step over many rows costs little more than over one.
    waiting: dict[int, tuple[list[tuple[int, int]], list[np.ndarray]]] = {}
    undecoded: dict[int, tuple[list[tuple[int, int]], list[np.ndarray]]] = {}

    def decode_waiting(width: int) -> None:
        places, e = undecoded.pop(width)
        for _, n, s, f in tagged(places, np.concatenate(e)):
            cut.setdefault(n, []).append((s, f))

    def tag_waiting(width: int) -> None:
        places, ids = waiting.pop(width)
        open_to, e = opened(np.concatenate(ids))
        if open_to:
            open_places, rows = undecoded.setdefault(width, ([], []))
            open_places += [places[i] for i in open_to]
            rows.append(e)
            if len(open_places) >= TOGETHER:
                decode_waiting(width)

    for n, t in enumerate(texts if model else ()):
        for first, rows in _windows(t):
            for at in range(0, len(rows), TOGETHER):
                some, width = rows[at : at + TOGETHER], rows.shape[1]
                places, ids = waiting.setdefault(width, ([], []))
                places += [(n, first + (at + k) * STRIDE) for k in range(len(some))]
                ids.append(some)
                if len(places) >= TOGETHER:
                    tag_waiting(width)
    for width in list(waiting):
        tag_waiting(width)
    for width in list(undecoded):
        decode_waiting(width)

    pending: list[tuple[int, int, int]] = []
    for n in sorted(cut.keys() | {n for n, w in enumerate(whole) if w}):
        joined: list[list[int]] = []
        for s, f in sorted(whole[n] + cut.get(n, [])):
            if joined and s < joined[-1][1]:  # of one span
                joined[-1][1] = max(joined[-1][1], f)
            else:
                joined.append([s, f])
        known = set(whole[n])
        pending += [(n, s, f) for s, f in joined if (s, f) not in known and not in_base(n, s, f)]
    margin = 64
    while pending:
        widths: dict[int, list[tuple[int, int, int]]] = {}
        for x in pending:
            widths.setdefault(-(-(x[2] - x[1] + 2 * margin) // 64) * 64, []).append(x)
        pending = []
        for width, some in widths.items():
            step = max(1, TOGETHER * WINDOW // width)
            for at in range(0, len(some), step):
                group = some[at : at + step]
                places = [(n, max(0, s - margin)) for n, s, _ in group]
                rows = np.full((len(group), width), _PAD, np.uint8)
                for row, (n, w) in zip(rows, places, strict=True):
                    piece = codes(texts[n][w : w + width])
                    row[: len(piece)] = piece
                longer: dict[int, tuple[int, int, int]] = {}
                open_to, e = opened(rows)
                for k, n, s, f in tagged([places[i] for i in open_to], e):
                    i = open_to[k]
                    _, first, last = group[i]
                    if s < last and first < f:
                        _, a, b = longer.get(i, group[i])
                        longer[i] = (n, min(a, s), max(b, f))
                pending += longer.values()
        margin *= 2
    return [(own, _best(more)) for own, more in zip(base, candidates, strict=True)]


def mask(text: str, spans: Sequence[Span]) -> str:
    """The text with each span, or run of overlapping spans, as [KIND] of its first."""
    out, last = [], 0
    for kind, start, end in sorted(spans, key=lambda x: (x[1], -x[2])):
        if start >= last:
            out += [text[last:start], f"[{kind.upper()}]"]
        last = max(last, end)
    return "".join([*out, text[last:]])


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Tagger | None = None, masked: bool = False) -> DataFrame:
    """Personal data in every whole text.

    Returns doc_id, n_email, n_ip, n_card, n_phone (of the patterns), base_sha256, spans
    (kind:start:end in code points, of the patterns and the tagger), n_added, n_spans (both) and, if
    masked, the masked text. Null and empty texts have no spans. Rows are independent:
    repeated ones stay, ids (null ones too) pass untouched, extra columns are ignored, nothing is shuffled.
    """
    tagger = model or default_tagger(docs.sparkSession)
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added", "n_spans", *(["masked"] if masked else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in (x for batch in batches for x in stretches(batch, size=STRETCH)):
            found = find(texts, tagger)
            counts = [pa.array([sum(k == kind for k, _, _ in own) for own, _ in found], pa.int64()) for kind in KINDS]
            shas = [hashlib.sha256(listed(own).encode()).hexdigest() for own, _ in found]
            more = [pa.array([len(x) for _, x in found], pa.int64()), pa.array([len(own) + len(x) for own, x in found], pa.int64())]
            text = [pa.array([mask(t, [*own, *x]) for t, (own, x) in zip(texts, found, strict=True)], pa.string())] if masked else []
            yield pa.RecordBatch.from_arrays([part.column("id"), *counts, pa.array(shas, pa.string()), pa.array([listed([*own, *x]) for own, x in found], pa.string()), *more, *text], names)

    kind = docs.schema[id_col].dataType.simpleString()
    fields = f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long, n_spans long"
    return map_batches(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), run, fields + (", masked string" if masked else ""))


def masked_documents(docs: DataFrame, model: Tagger | None = None) -> DataFrame:
    """docs with every span of personal data in text as [KIND], and n_chars, if there, as the new text's. All else stays."""
    tagger = model or default_tagger(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, plain in (x for batch in batches for x in stretches(batch, size=STRETCH)):
            texts = part.column("text").to_pylist()
            counts = part.column("n_chars").to_pylist() if "n_chars" in part.schema.names else None
            for i, (own, more) in enumerate(find(plain, tagger)):
                if own or more:
                    texts[i] = mask(plain[i], [*own, *more])
                    if counts:
                        counts[i] = len(texts[i])
            new = {"text": texts} | ({"n_chars": counts} if counts is not None else {})
            yield pa.RecordBatch.from_arrays([pa.array(new[f.name], f.type) if f.name in new else part.column(f.name) for f in part.schema], schema=part.schema)

    return map_batches(docs, run, docs.schema)


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(documents(spark, sf_dir))
