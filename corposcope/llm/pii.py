"""Personal data: base patterns, and a character-level bidirectional LSTM with CRF transitions that adds spans."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

from corposcope.llm.common import portions

KINDS = ("email", "ip", "card", "phone")
#: The base patterns of the contract (fixed values).
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
#: IP again, linear in long runs of digits: a match starts where a run starts and never gives digits back.
IP_RUNS = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: Every span of the four kinds holds one of these, so text far from all of them holds none.
ANCHOR = re.compile(r"[0-9@]|[(\[{] ?at ?[)\]}]", re.I)

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, x in enumerate(reversed(digits)):
        n = int(x) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of EMAIL, found from each @ in time linear in the text."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = EMAIL.match(text, start) if start < at else None
        if m:
            yield m.span()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """The spans of the four base patterns, by kind, then start."""
    out: list[Span] = [("email", a, b) for a, b in emails(text)]
    out += [("ip", *m.span()) for m in IP_RUNS.finditer(text) if all(len(x.lstrip("0")) < 4 and int(x) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[ -]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


# --- the tagger -----------------------------------------------------------------------------------

#: Windows of the first round; those of each later round are twice as wide and as far apart.
WINDOW, STRIDE = 96, 48
SYMBOLS = 128
TAGS = 1 + 2 * len(KINDS)  # outside; then begin and inside of each kind


def coded(text: str) -> np.ndarray:
    """Character codes: ASCII as it is, 1 for other letters, 2 for the rest."""
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.where(raw < SYMBOLS, raw, 2).astype(np.int32)
    for i in np.flatnonzero(raw >= SYMBOLS):
        out[i] = 1 if text[i].isalpha() else 2
    return out


def allowed() -> np.ndarray:
    """Structure of the tags: an inside tag follows the begin or inside tag of its kind only. A window may start inside."""
    step = np.zeros((TAGS, TAGS))
    for k in range(len(KINDS)):
        inside = 2 + 2 * k
        step[:, inside] = -1e4
        step[[inside - 1, inside], inside] = 0
    return step


class Tagger:
    """Embedded characters, one LSTM each way, a linear layer, CRF transitions; trained by Adam on negative log likelihood."""

    def __init__(self, hidden: int = 24, width: int = 12, seed: int = 3) -> None:
        rng = np.random.default_rng(seed)
        self.hidden = hidden
        self.w = {"embed": rng.normal(0, 0.3, (SYMBOLS, width)), "out": rng.normal(0, 0.2, (2 * hidden, TAGS)), "bias": np.zeros(TAGS), "step": np.zeros((TAGS, TAGS)), "first": np.zeros(TAGS)}
        for side in "fb":
            self.w |= {f"x{side}": rng.normal(0, 0.25, (width, 4 * hidden)), f"h{side}": rng.normal(0, 0.2, (hidden, 4 * hidden)), f"c{side}": np.repeat([0.0, 1.0, 0.0, 0.0], hidden)}
        self.w = {k: v.astype(np.float32) for k, v in self.w.items()}

    def states(self, x: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States [time, batch, 2 hidden]; x is [batch, time]. Both directions go in one loop, the second over the reversed text."""
        n, w = self.hidden, self.w
        table = np.concatenate([w["embed"] @ w[f"x{s}"] + w[f"c{s}"] for s in "fb"])
        into = np.stack([w["hf"], w["hb"]])
        # one tanh for all four gates: sigmoid(z) is tanh(z / 2) / 2 + 1 / 2
        scale = np.repeat(np.float32([0.5, 0.5, 0.5, 1.0]), n)
        index = np.stack([x.T, x.T[::-1] + SYMBOLS], axis=1)
        h = c = np.zeros((2, len(x), n), np.float32)
        out = np.empty((len(index), 2, len(x), n), np.float32)
        for t in range(len(index)):
            z = np.tanh((table[index[t]] + h @ into) * scale)
            gates, g = 0.5 * z[..., : 3 * n] + 0.5, z[..., 3 * n :]
            i, f, o = gates[..., :n], gates[..., n : 2 * n], gates[..., 2 * n :]
            before = c
            c = f * c + i * g
            s = np.tanh(c)
            if keep is not None:
                keep.append((i, f, o, g, before, s, h))
            h = o * s
            out[t] = h
        return np.concatenate([out[:, 0], out[::-1, 1]], axis=2)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Emission scores [time, batch, tag]."""
        return self.states(x) @ self.w["out"] + self.w["bias"]

    def decode(self, x: np.ndarray) -> np.ndarray:
        """The best tag path [batch, time] by Viterbi."""
        e = self.scores(x)
        step = self.w["step"] + allowed()
        best, back = e[0] + self.w["first"], np.empty((len(e), x.shape[0], TAGS), np.int8)
        for t in range(1, len(e)):
            every = best[:, :, None] + step
            back[t] = every.argmax(axis=1)
            best = every.max(axis=1) + e[t]
        path = np.empty(x.shape, np.int8)
        path[:, -1] = best.argmax(axis=1)
        for t in range(len(e) - 1, 0, -1):
            path[:, t - 1] = back[t][np.arange(len(x)), path[:, t]]
        return path

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        kept: list[tuple] = []
        states = self.states(x, kept)
        e = (states @ self.w["out"] + self.w["bias"]).astype(np.float64)
        step, first = self.w["step"] + allowed(), self.w["first"].astype(np.float64)
        steps, rows, times = len(e), np.arange(len(x)), np.arange(len(e))[:, None]
        # forward and backward sums, each time scaled to one
        top = e.max(axis=2, keepdims=True)
        emit, pass_ = np.exp(e - top), np.exp(step)
        alpha, beta, size = np.empty_like(e), np.ones_like(e), np.empty((steps, len(x), 1))
        alpha[0] = emit[0] * np.exp(first)
        for t in range(steps):
            if t:
                alpha[t] = (alpha[t - 1] @ pass_) * emit[t]
            size[t] = alpha[t].sum(axis=1, keepdims=True)
            alpha[t] /= size[t]
        for t in range(steps - 2, -1, -1):
            beta[t] = (emit[t + 1] * beta[t + 1]) @ pass_.T
            beta[t] /= beta[t].sum(axis=1, keepdims=True)
        z = (np.log(size) + top).sum(axis=(0, 2))
        gold = e[times, rows, y.T].sum(axis=0) + first[y[:, 0]] + step[y[:, :-1], y[:, 1:]].sum(axis=1)
        d = alpha * beta
        d /= d.sum(axis=2, keepdims=True)
        d[times, rows, y.T] -= 1
        d /= len(x)
        onward = emit[1:] * beta[1:]
        pair = np.einsum("tbi,tbj->ij", alpha[:-1] / ((alpha[:-1] @ pass_) * onward).sum(axis=2, keepdims=True), onward) * pass_
        np.subtract.at(pair, (y[:, :-1], y[:, 1:]), 1)
        g = {"step": pair / len(x), "first": d[0].sum(axis=0), "out": np.einsum("tbh,tbk->hk", states, d, optimize=True), "bias": d.sum(axis=(0, 1))}
        down, n = (d @ self.w["out"].T).astype(states.dtype), self.hidden
        parts = np.stack([down[..., :n], down[::-1, :, n:]], axis=1)
        into = np.stack([self.w["hf"], self.w["hb"]])
        dh = dc = np.zeros((2, len(x), n), states.dtype)
        dz, held = np.empty((steps, 2, len(x), 4 * n), states.dtype), np.empty((steps, 2, len(x), n), states.dtype)
        for t in range(steps - 1, -1, -1):
            i, f, o, c, before, s, held[t] = kept[t]
            dh = dh + parts[t]
            dc = dc + dh * o * (1 - s * s)
            dz[t] = np.concatenate([dc * c * i * (1 - i), dc * before * f * (1 - f), dh * s * o * (1 - o), dc * i * (1 - c * c)], axis=2)
            dh, dc = dz[t] @ into.transpose(0, 2, 1), dc * f
        g["embed"] = np.zeros_like(self.w["embed"])
        for k, side in enumerate("fb"):
            flat = dz[:, k].reshape(-1, 4 * n)
            seen = (x.T if side == "f" else x.T[::-1]).reshape(-1)
            table = np.zeros((SYMBOLS, len(flat)), states.dtype)
            table[seen, np.arange(len(flat))] = 1
            table = table @ flat
            g[f"h{side}"] = held[:, k].reshape(-1, n).T @ flat
            g[f"c{side}"], g[f"x{side}"] = table.sum(axis=0), self.w["embed"].T @ table
            g["embed"] += table @ self.w[f"x{side}"].T
        return float((z - gold).mean()), g

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 7, batch: int = 48, rate: float = 0.03, seed: int = 5) -> float:
        rng, m, v, n, loss = np.random.default_rng(seed), {}, {}, 0, 0.0
        total = epochs * max(1, len(x) // batch)
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x) - batch + 1, batch):
                some = order[at : at + batch]
                loss, g = self.gradients(x[some], y[some])
                n += 1
                for k, d in g.items():
                    d = np.clip(d, -1, 1)
                    m[k] = 0.9 * m.get(k, 0) + 0.1 * d
                    v[k] = 0.99 * v.get(k, 0) + 0.01 * d * d
                    self.w[k] -= (rate * (1 - 0.9 * n / total) * (m[k] / (1 - 0.9**n)) / (np.sqrt(v[k] / (1 - 0.99**n)) + 1e-8)).astype(np.float32)
        return loss


# --- labelled spans ---------------------------------------------------------------------------------


def labelled(n: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """n windows of invented text with labelled spans of the four kinds, also in written-out forms that the
    base patterns miss, and with numbers, versions, dates and codes that are none: (codes, tags)."""
    rng = np.random.default_rng(seed)
    pick = lambda *xs: xs[int(rng.integers(len(xs)))]
    some = lambda a, b: "".join(map(str, rng.integers(0, 10, int(rng.integers(a, b + 1)))))

    def word() -> str:
        w = "".join(pick("an", "er", "th", "ou", "le", "qu", "é", "sch", "ión", "re", "st", "a", "o", "m", "t") for _ in range(int(rng.integers(1, 4))))
        return pick(w, w, w, w.title(), w.upper()) + pick("", "", "", ".", ",", "!!", "$$$")

    def host() -> str:
        return "".join(c for c in word().lower() if c.isascii() and c.isalnum()) or "mail"

    def email() -> str:
        long = pick(".", "", "_").join(host() * int(rng.integers(1, 4)) for _ in range(int(rng.integers(2, 7)))) if rng.random() < 0.8 else host()[0] * int(rng.integers(20, 70))
        name, tld = pick(host(), host(), f"{host()}.{some(1, 2)}", f"{host()}_{host()}", long), pick("com", "org", "net", "de", "fr")
        place = pick(host(), f"{host()}{some(1, 1)}.example")
        return pick(f"{name}@{place}.{tld}", f"{name} [at] {place} [dot] {tld}", f"{name} (at) {place} (dot) {tld}", f"{name}[at]{place}.{tld}", f"{name} @ {place}.{tld}")

    def ip() -> str:
        return pick(".", ".", ".", "[.]", " . ").join(str(int(rng.integers(0, 256))) for _ in range(4))

    def card() -> str:
        digits = pick("4", "5", "37") + some(14, 14)
        digits = digits[:15]
        digits += next(c for c in "0123456789" if luhn(digits + c))
        return pick("", "", " ", "-", ".", "_").join(digits[i : i + 4] for i in range(0, 16, 4))

    def phone() -> str:
        head = pick(f"({some(3, 3)}) ", f"{some(3, 3)}-", f"({some(3, 3)})")
        return pick("+1 ", "+49 ", "+", "", "") + head + some(3, 3) + "-" + some(4, 4)

    def other() -> str:
        return pick(some(1, 4), f"{some(1, 1)}.{some(1, 1)}", f"20{some(2, 2)}-0{some(1, 1)}-1{some(1, 1)}", some(16, 16), f"token = \"{''.join(pick(*'0123456789abcdef') for _ in range(32))}\"", f"@{host()}", f"{some(1, 2)}:{some(2, 2)}", f"{some(1, 3)},{some(3, 3)}", f"[{some(1, 2)}]", "(at)")

    makers = {"email": email, "ip": ip, "card": card, "phone": phone}
    xs, ys = np.zeros((n, WINDOW), np.int32), np.zeros((n, WINDOW), np.int32)
    for k in range(n):
        text, spans = "", []
        while len(text) < WINDOW + 40:
            kind = pick(None, None, None, None, "other", *KINDS)
            piece = word() if kind is None else other() if kind == "other" else makers[kind]()
            if kind in makers:
                spans.append((KINDS.index(kind), len(text), len(text) + len(piece)))
            text += piece + pick(" ", " ", " ", ", ", "\n") if kind else piece + " "
        cut = int(rng.integers(0, 40))
        xs[k] = coded(text)[cut : cut + WINDOW]
        for kind, a, b in spans:
            a, b = a - cut, b - cut
            ys[k, max(a, 0) : max(b, 0)] = 2 + 2 * kind  # spans that the edge cuts start or end there
            if 0 <= a < WINDOW:
                ys[k, a] = 1 + 2 * kind
    return xs, ys


@lru_cache(maxsize=2)
def trained(windows: int = 1536, epochs: int = 7, seed: int = 3) -> Tagger:
    """The tagger of this seed, fitted on so many labelled windows; once for each Python process, in a few seconds."""
    tagger = Tagger(seed=seed)
    tagger.fit(*labelled(windows, seed + 8), epochs=epochs)
    return tagger


# --- windows, reconciliation, checks ------------------------------------------------------------------


def around(position: int, stride: int) -> tuple[int, int]:
    """Numbers of the two windows that hold a position; a span of up to `stride` characters there is whole in one of them."""
    return position // stride - 1, position // stride


def windows(text: str) -> list[int]:
    """Starts of the windows that hold an anchor."""
    numbers: list[int] = []
    for m in ANCHOR.finditer(text):
        numbers += [n for n in around(m.start(), STRIDE) if n >= 0 and (not numbers or n > numbers[-1])]
    return [n * STRIDE for n in numbers]


def plausible(kind: str, text: str) -> bool:
    """Whether a span of the tagger can be read as its kind: an address has two sides and a dot, numbers are in range,
    a card's digits pass Luhn. The shape of the text is the tagger's business."""
    if kind == "email":
        sides = AT.split(text)
        return len(sides) == 2 and bool(sides[0]) and not re.search(r"\s", sides[0]) and bool(DOT.search(sides[1]))
    numbers = re.findall("[0-9]+", text)
    n = sum(map(len, numbers))
    if re.search(r"[^\W\d_]", text):
        return False
    if kind == "ip":
        return len(numbers) == 4 and all(len(x) < 4 and int(x) <= 255 for x in numbers)
    return 16 <= n <= 19 and luhn("".join(numbers)) if kind == "card" else 8 <= n <= 15


def hopeful(kind: str, text: str) -> bool:
    """Whether a longer span around a fragment can be plausible. An address holds its sign, so the windows that hold the
    sign answer for it; numbers have few digits, and no more than WINDOW characters."""
    if kind == "email":
        return len(AT.findall(text)) == 1 and not re.search(r"\s", DOTS.sub(".", AT.sub("@", text)).strip())
    return len(text) <= WINDOW and len(re.findall("[0-9]", text)) <= {"ip": 12, "card": 19, "phone": 15}[kind] and not re.search(r"[^\W\d_]", text)


#: The sign between the sides of an address, and a dot of its host; both may be written out.
AT = re.compile(r"\s*(?:@|[(\[{]\s?at\s?[)\]}])\s*", re.I)
DOTS = re.compile(r"\s?[(\[{]\s?dot\s?[)\]}]\s?", re.I)
DOT = re.compile(r"[A-Za-z0-9-](?:\.|\s?[(\[{]\s?dot\s?[)\]}]\s?)[A-Za-z0-9-]+", re.I)


def trimmed(kind: str, text: str, a: int, b: int) -> tuple[int, int]:
    """A span without the punctuation after it; one of an address starts with the last word before its sign."""
    body = text[a:b].rstrip(".,;:!?\"' \n")
    sign = AT.search(body) if kind == "email" else None
    skip = len(body[: sign.start()]) - len(body[: sign.start()].split()[-1]) if sign and body[: sign.start()].split() else 0
    return a + skip, a + len(body)


class Covered:
    """Characters that any of some spans cover, as disjoint intervals."""

    def __init__(self, spans) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, b in sorted((a, b) for _, a, b in spans):
            if self.ends and a <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def meets(self, a: int, b: int) -> bool:
        at = bisect_right(self.ends, a)
        return at < len(self.starts) and self.starts[at] < b


def reconciled(found: list[Span], base: list[Span]) -> list[Span]:
    """Spans of all windows of a text made one set: base spans stay, the rest are chosen so that none overlap
    and the characters they cover, counted once for each window that agrees, are most. Weighted interval
    scheduling: spans by their ends, the best of each prefix, and a walk back."""
    taken = Covered(base)
    votes = Counter(s for s in found if not taken.meets(s[1], s[2]))
    free = sorted(votes, key=lambda s: (s[2], s[1], s[0]))
    ends = [s[2] for s in free]
    best, before = [0], []
    for n, s in enumerate(free):
        before.append(bisect_right(ends, s[1], 0, n))
        best.append(max(best[n], best[before[n]] + votes[s] * (s[2] - s[1])))
    out, n = [], len(free)
    while n:
        if best[n] > best[n - 1]:
            out.append(free[n - 1])
            n = before[n - 1]
        else:
            n -= 1
    return out[::-1]


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def runs(path: np.ndarray) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the runs of tags of a window; one that the left edge cuts starts at 0."""
    out: list[tuple[str, int, int]] = []
    for i in np.flatnonzero(path).tolist():
        kind = KINDS[(path[i] - 1) // 2]
        if path[i] % 2 == 0 and out and out[-1][0] == kind and out[-1][2] == i:
            out[-1] = (kind, out[-1][1], i + 1)
        else:
            out.append((kind, i, i + 1))
    return out


def tag(texts: list[str], tagger: Tagger, most: int = 1024) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, added spans) of each text.

    A run of tags that the edge of its window cuts is no span. If nothing found so far covers any of it, the windows
    twice as wide that hold it are decoded in the next round, until no run is cut; so no span is too long.
    """
    base = [base_spans(t) if ANCHOR.search(t) else [] for t in texts]
    found: list[list[Span]] = [[] for _ in texts]
    todo = [(k, start) for k, text in enumerate(texts) for start in windows(text)]
    width, stride = WINDOW, STRIDE
    while todo:
        cut: list[tuple[int, Span]] = []
        each = max(1, most * WINDOW // width)
        for at in range(0, len(todo), each):
            some = todo[at : at + each]
            rows = [coded(texts[k][start : start + width]) for k, start in some]
            rows = [np.pad(x, (0, width - len(x)), constant_values=32) for x in rows]
            for (k, start), path in zip(some, tagger.decode(np.stack(rows)), strict=True):
                for kind, i, j in runs(path):
                    a, b = trimmed(kind, texts[k], start + i, start + j)
                    if (a == start and start) or (j == width and start + width < len(texts[k])):
                        cut.append((k, (kind, a, max(b, a + 1))))
                    elif plausible(kind, texts[k][a:b]):
                        found[k].append((kind, a, b))
        width, stride = 2 * width, 2 * stride
        known = {k: Covered([*base[k], *found[k]]) for k in {k for k, _ in cut}}
        todo = sorted({(k, n * stride) for k, (kind, a, b) in cut if not known[k].meets(a, b) and hopeful(kind, texts[k][a:b]) for n in around(a, stride) if n >= 0})
    return [(b, reconciled(f, b) if f else []) for f, b in zip(found, base, strict=True)]


def masked(text: str, spans: list[Span]) -> str:
    """text with every span replaced by its kind in brackets; overlapping spans become one."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def find_pii(docs: DataFrame, tagger: Tagger | None = None, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False, keep: list[str] | None = None, prefix: str = "") -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added, n_spans[, clean]) for every row; with `keep`, those columns instead of the id.
    `prefix` goes before the new names, where kept columns could clash with them.

    Null text counts as empty. The counts and base_sha256 are of the base spans, spans has base and
    added ones, n_added counts the latter. Base spans of different kinds may overlap; added ones
    overlap nothing. Offsets are code points, ends exclusive. clean, if asked for, is the text with
    spans masked (null where text is null). n_spans counts all. Texts of any length are read whole: patterns run over
    all of it, windows hold every digit, @ and written-out at, one of which every span holds, and grow with the spans
    that they cut, so a span may have any length. Repeated rows and ids, and rows without an id, have a row each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tagger or trained())

    columns = keep or [id_col]
    at = columns.index(text_col) if text_col in columns else len(columns)
    rows = docs.select(*columns, *[text_col] * (text_col not in columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            values = batch.column(at).to_pylist()
            texts = [x or "" for x in values]
            got = tag(texts, shared.value)
            base = [ordered(b) for b, _ in got]
            every = [ordered([*b, *more]) for b, more in got]
            out = [*batch.columns[: len(columns)]] + [pa.array([sum(s[0] == kind for s in b) for b in base], pa.int64()) for kind in KINDS]
            out += [pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b in base], pa.string()), pa.array([joined(b) for b in every], pa.string()), pa.array([len(more) for _, more in got], pa.int64()), pa.array([len(x) for x in every], pa.int64())]
            if with_text:
                out.append(pa.array([x if x is None else masked(x, s) for x, s in zip(values, every, strict=True)], pa.string()))
            yield pa.RecordBatch.from_arrays(out, schema.names)

    new = [*[(f"n_{k}", LongType()) for k in KINDS], ("base_sha256", StringType()), ("spans", StringType()), ("n_added", LongType()), ("n_spans", LongType()), *[("clean", StringType())] * with_text]
    schema = StructType([*rows.schema.fields[: len(columns)], *[StructField(prefix + n, t) for n, t in new]])
    return rows.mapInArrow(run, schema)


def op4_pii(spark, sf_dir: str) -> DataFrame:
    """doc_id, counts and digest of the base spans, and all spans of every document."""
    from corposcope.llm.common import table

    return find_pii(table(spark, sf_dir, "documents"))
