"""Personal data: base rules, and a character-level bidirectional LSTM with a CRF on top.

The rules find well-formed e-mail addresses, IP addresses, card and phone numbers. The network
learns from spans labelled in the documents by the rules and from variants of such
data that the rules do not know, and adds what it finds elsewhere. A text is read in
overlapping windows; the spans of all windows are reconciled over the whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardweave.llm.learning import Adam, hashed_share

KINDS = ("email", "ip", "card", "phone")
#: A window and the step to the next one, in code points.
WINDOW, STEP = 96, 48
HIDDEN = 24
#: Bounds of the learning sample: documents, their characters, and windows.
SAMPLE_ROWS, SAMPLE_CHARS, SAMPLE_WINDOWS = 600, 20_000, 1500
ROUNDS, BATCH = 600, 48
#: An added span's tags must be at least this likely on average.
CONFIDENCE = 0.9
_CLASSES = 130
_TAGS = 1 + 2 * len(KINDS)  # 0: outside; 1, 3, ...: a span begins; 2, 4, ...: it goes on
_NEVER = -1e4

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = frozenset("0123456789")
_HOST_CHARACTERS = _LOCAL - frozenset("._%+")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TELLING = re.compile(r"[0-9@]")


def _luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return sum(v if i % 2 == 0 else 2 * v - 9 * (v > 4) for i, v in enumerate(values)) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) in code points by the rules, by kind and start."""
    spans, free = [], 0
    at = text.find("@")
    while at >= 0:
        # The local part reaches back to the last match or the first character it cannot have.
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            spans.append((0, start, host.end()))
            free = host.end()
        at = text.find("@", max(at + 1, free))
    for m in _IP.finditer(text):
        # No part of more than three digits but zeros is at most 255.
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            spans.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and _luhn(digits):
            spans.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
            spans.append((3, *m.span()))
    return spans


def characters(text: str) -> np.ndarray:
    """A class for each code point: ASCII, letters beyond it, all others."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    return np.where(points < 128, points, np.where(points < 0x2000, 128, 129)).astype(np.int64)


class Tagger:
    """Bidirectional LSTM and CRF; ``values`` are its weights."""

    def __init__(self, values: dict[str, np.ndarray]):
        self.values = values

    @classmethod
    def fresh(cls, rng: np.random.Generator) -> Tagger:
        values = {}
        for side in ("f", "b"):
            values["x" + side] = rng.normal(0, 0.3, (_CLASSES, 4 * HIDDEN))
            values["x" + side][:, HIDDEN : 2 * HIDDEN] += 1.0  # remember at first
            values["h" + side] = rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN))
        values["out"] = rng.normal(0, 0.2, (2 * HIDDEN, _TAGS))
        values["bias"] = np.zeros(_TAGS)
        values["steps"] = np.zeros((_TAGS, _TAGS))
        return cls({k: v.astype(np.float32) for k, v in values.items()})

    def steps(self) -> np.ndarray:
        """Scores from tag to tag; a span goes on only behind its own kind."""
        allowed = np.ones((_TAGS, _TAGS), bool)
        for k in range(len(KINDS)):
            allowed[:, 2 + 2 * k] = False
            allowed[[1 + 2 * k, 2 + 2 * k], 2 + 2 * k] = True
        return np.where(allowed, self.values["steps"], _NEVER)

    def _run(self, ids: np.ndarray, side: str) -> list[tuple]:
        v, trace = self.values, []
        h = c = np.zeros((len(ids), HIDDEN), np.float32)
        for t in range(ids.shape[1]):
            z = v["x" + side][ids[:, t]] + h @ v["h" + side]
            gates = 1 / (1 + np.exp(-z[:, : 3 * HIDDEN]))
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            before, c = c, f * c + i * g
            tanh = np.tanh(c)
            trace.append((h, before, i, f, o, g, tanh))
            h = o * tanh
        trace.append((h,))
        return trace

    def _states(self, ids: np.ndarray) -> tuple[np.ndarray, list, list]:
        forward, backward = self._run(ids, "f"), self._run(ids[:, ::-1], "b")
        ahead = np.stack([x[0] for x in forward[1:]], axis=1)
        behind = np.stack([x[0] for x in backward[1:]], axis=1)[:, ::-1]
        return np.concatenate([ahead, behind], axis=2), forward, backward

    def emissions(self, ids: np.ndarray) -> np.ndarray:
        return self._states(ids)[0] @ self.values["out"] + self.values["bias"]

    def marginals(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of each tag at each place, and expected number of steps from tag to tag."""
        steps = self.steps()
        n = scores.shape[1]
        ahead, behind = np.empty_like(scores), np.zeros_like(scores)
        ahead[:, 0] = scores[:, 0]
        for t in range(1, n):
            ahead[:, t] = _logsum(ahead[:, t - 1, :, None] + steps, 1) + scores[:, t]
        for t in range(n - 2, -1, -1):
            behind[:, t] = _logsum(steps + (scores[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
        total = _logsum(ahead[:, -1], 1)
        expected = np.zeros_like(steps)
        for t in range(1, n):
            pair = ahead[:, t - 1, :, None] + steps + (scores[:, t] + behind[:, t])[:, None, :]
            expected += np.exp(pair - total[:, None, None]).sum(axis=0)
        return np.exp(ahead + behind - total[:, None, None]), expected

    def likely(self, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Probability of each tag at each place of sequences of these lengths."""
        steps, n = self.steps(), scores.shape[1]
        ahead, behind = np.empty_like(scores), np.zeros_like(scores)
        ahead[:, 0] = scores[:, 0]
        for t in range(1, n):
            on = (t < lengths)[:, None]
            ahead[:, t] = np.where(on, _logsum(ahead[:, t - 1, :, None] + steps, 1) + scores[:, t], ahead[:, t - 1])
        for t in range(n - 2, -1, -1):
            on = (t + 1 < lengths)[:, None]
            behind[:, t] = np.where(on, _logsum(steps + (scores[:, t + 1] + behind[:, t + 1])[:, None, :], 2), 0)
        return np.exp(ahead + behind - _logsum(ahead[:, -1], 1)[:, None, None])

    def decode(self, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The best tags of each sequence (Viterbi); what lies behind its length means nothing."""
        steps, n = self.steps(), scores.shape[1]
        best, back = scores[:, 0], np.zeros(scores.shape, np.int8)
        same = np.arange(_TAGS, dtype=np.int8)
        for t in range(1, n):
            on = (t < lengths)[:, None]
            paths = best[:, :, None] + steps
            back[:, t] = np.where(on, paths.argmax(axis=1), same)
            best = np.where(on, paths.max(axis=1) + scores[:, t], best)
        tags = np.empty(scores.shape[:2], np.int64)
        tags[:, -1] = best.argmax(axis=1)
        rows = np.arange(len(scores))
        for t in range(n - 1, 0, -1):
            tags[:, t - 1] = back[rows, t, tags[:, t]]
        return tags

    def gradients(self, ids: np.ndarray, tags: np.ndarray) -> dict[str, np.ndarray]:
        """Of the negative log likelihood of the tags, per window."""
        v = self.values
        states, forward, backward = self._states(ids)
        scores = states @ v["out"] + v["bias"]
        likely, expected = self.marginals(scores)
        likely[np.arange(len(ids))[:, None], np.arange(ids.shape[1]), tags] -= 1
        likely /= len(ids)
        expected /= len(ids)
        np.add.at(expected, (tags[:, :-1].ravel(), tags[:, 1:].ravel()), -1.0 / len(ids))
        out = {
            "out": np.tensordot(states, likely, ((0, 1), (0, 1))),
            "bias": likely.sum(axis=(0, 1)),
            "steps": expected,
        }
        back = likely @ v["out"].T
        self._back(ids, forward, back[:, :, :HIDDEN], "f", out)
        self._back(ids[:, ::-1], backward, back[:, ::-1, HIDDEN:], "b", out)
        size = np.sqrt(sum(float((g * g).sum()) for g in out.values()))
        return {k: (g * min(1.0, 5.0 / (size + 1e-9))).astype(np.float32) for k, g in out.items()}

    def _back(self, ids: np.ndarray, trace: list, given: np.ndarray, side: str, out: dict) -> None:
        dx, dh = np.zeros_like(self.values["x" + side]), np.zeros_like(self.values["h" + side])
        to_h = to_c = np.zeros((len(ids), HIDDEN), np.float32)
        for t in range(ids.shape[1] - 1, -1, -1):
            h, before, i, f, o, g, tanh = trace[t]
            own = given[:, t] + to_h
            cell = to_c + own * o * (1 - tanh * tanh)
            dz = np.concatenate(
                [cell * g * i * (1 - i), cell * before * f * (1 - f), own * tanh * o * (1 - o), cell * i * (1 - g * g)], axis=1
            )
            np.add.at(dx, ids[:, t], dz)
            dh += h.T @ dz
            to_h, to_c = dz @ self.values["h" + side].T, cell * f
        out["x" + side], out["h" + side] = dx, dh


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    most = x.max(axis=axis, keepdims=True)
    return np.squeeze(most, axis) + np.log(np.exp(x - most).sum(axis=axis))


def _variant(rng: np.random.Generator) -> tuple[int, str]:
    """Personal data of a random kind, well-formed or in a form that the rules do not know."""
    digits = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    letters = lambda n: "".join(chr(97 + x) for x in rng.integers(0, 26, n))
    pick = lambda *options: options[int(rng.integers(0, len(options)))]
    kind = int(rng.integers(0, len(KINDS)))
    if kind == 0:
        local = letters(int(rng.integers(2, 9) if rng.random() < 0.75 else rng.integers(9, 60))) + pick("", "." + digits(2), "_" + letters(3), digits(3))
        host = letters(int(rng.integers(3, 9))) + pick("", digits(1)) + pick(".com", ".org", ".example.com", ".net", ".de")
        return 0, local + pick("@", "@", " @ ", "@ ") + host
    if kind == 1:
        return 1, pick(".", ".", " . ").join(str(x) for x in rng.integers(0, 256, 4))
    if kind == 2:
        number = digits(15)
        number += next(d for d in "0123456789" if _luhn(number + d))
        return 2, pick("", " ", "-", ".", "/").join(number[k : k + 4] for k in range(0, 16, 4))
    area, first, last = digits(3), digits(3), digits(4)
    national = pick(f"({area}) {first}-{last}", f"{area}-{first}-{last}", f"{area}.{first}.{last}", f"({area}){first}-{last}")
    return 3, pick("+1 ", "+49 ", "+1-", "", "", "1-") + national


def _examples(texts: list[str], rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Windows and their tags: around labelled spans, with inserted data, and with neither."""
    ids, tags = [], []

    def add(text: str, spans: list[tuple[int, int, int]], middle: int) -> None:
        start = min(max(0, middle - int(rng.integers(WINDOW // 4, 3 * WINDOW // 4))), max(0, len(text) - WINDOW))
        row, own = np.zeros(WINDOW, np.int64), np.zeros(WINDOW, np.int64)
        part = characters(text[start : start + WINDOW])
        row[: len(part)] = part
        for kind, a, b in spans:
            a, b = a - start, b - start
            if b > 0 and a < WINDOW:
                own[max(a, 0) : b] = 2 + 2 * kind
                if a >= 0:
                    own[a] = 1 + 2 * kind
        ids.append(row)
        tags.append(own)

    each = max(2, SAMPLE_WINDOWS // max(1, 2 * len(texts)))
    for text in texts:
        spans = base_spans(text)
        others = [m.start() for m in _TELLING.finditer(text)]
        for kind, a, b in spans[:each]:
            add(text, spans, (a + b) // 2)
        for at in rng.permutation(np.array(others, np.int64))[:each].tolist():
            add(text, spans, at)
    source = texts or [""]
    for _ in range(SAMPLE_WINDOWS // 2):
        text = source[int(rng.integers(0, len(source)))]
        at = int(rng.integers(0, len(text) + 1))
        text = text[max(0, at - WINDOW) : at + WINDOW]
        text = _TELLING.sub("x", text)
        space = text.find(" ", min(len(text) // 2, WINDOW))
        space = len(text) if space < 0 else space + 1
        kind, data = _variant(rng)
        add(text[:space] + data + " " + text[space:], [(kind, space, space + len(data))], space + len(data) // 2)
    chosen = rng.permutation(len(ids))[: 2 * SAMPLE_WINDOWS]
    return np.array(ids)[chosen], np.array(tags)[chosen]


def train(texts: list[str], seed: int = 9) -> Tagger:
    """Fit by Adam on windows of ``texts``; without texts, on inserted data alone."""
    rng = np.random.default_rng(seed)
    tagger = Tagger.fresh(rng)
    ids, tags = _examples(texts, rng)
    optimiser = Adam(tagger.values, 0.02)
    for k in range(ROUNDS):
        optimiser.rate = 0.02 * (1 - k / ROUNDS) + 0.001
        rows = rng.integers(0, len(ids), BATCH)
        optimiser.step(tagger.gradients(ids[rows], tags[rows]))
    return tagger


def window_starts(length: int) -> list[int]:
    """Starts of overlapping windows that cover a text of ``length`` code points."""
    if length <= WINDOW:
        return [0]
    return [*range(0, length - WINDOW, STEP), length - WINDOW]


def reconcile(found: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int]]:
    """Of the spans (kind, start, end, confidence) of all windows, those kept: no two of them
    overlap, and the sum of confidence times length is the largest possible."""
    found = sorted(set(found), key=lambda s: (s[2], s[1], s[0], -s[3]))
    ends = [s[2] for s in found]
    best, choice = [0.0], []
    for _, start, end, confidence in found:
        before = int(np.searchsorted(ends, start, side="right"))
        before = min(before, len(best) - 1)
        gain = best[before] + confidence * (end - start)
        choice.append((gain > best[-1], before))
        best.append(max(gain, best[-1]))
    kept, k = [], len(found)
    while k:
        taken, before = choice[k - 1]
        if taken:
            kept.append(found[k - 1][:3])
        k = before if taken else k - 1
    return sorted(kept)


def _plausible(kind: int, value: str) -> bool:
    """What no network need learn: an address has an @; the others have no letter, and numbers that can be."""
    groups = re.findall("[0-9]+", value)
    digits = "".join(groups)
    if kind == 0:
        return re.fullmatch(r"[^\s@]+\s?@\s?[^\s@]+\.[^\s@]+", value) is not None
    if any(c.isalpha() for c in value):
        return False
    if kind == 1:
        return len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups)
    return 13 <= len(digits) <= 19 and _luhn(digits) if kind == 2 else 7 <= len(digits) <= 15


def _whole(kind: int, text: str, start: int, end: int) -> tuple[int, int]:
    """A span whose ends lie inside a word, such as a name longer than the network sees, reaches to the word's ends."""
    start_set, end_set = (_LOCAL, _HOST_CHARACTERS) if kind == 0 else (_DIGITS, _DIGITS)
    while start > 0 and text[start] in start_set and text[start - 1] in start_set:
        start -= 1
    while end < len(text) and text[end - 1] in end_set and text[end] in end_set:
        end += 1
    return start, end


def telling_runs(text: str) -> list[tuple[int, int]]:
    """First and last window (their numbers) of each stretch of overlapping windows with a digit or an @."""
    telling = np.array([m.start() for m in _TELLING.finditer(text)], np.int64)
    if not len(telling):
        return []
    starts = np.array(window_starts(len(text)))
    low, high = np.searchsorted(telling, starts), np.searchsorted(telling, starts + WINDOW)
    return _stretches(np.flatnonzero(high > low))


def _stretches(numbers: np.ndarray) -> list[tuple[int, int]]:
    cuts = np.flatnonzero(np.diff(numbers) > 1) + 1
    return [(int(part[0]), int(part[-1])) for part in np.split(numbers, cuts)]


def _stitched(tagger: Tagger, texts: list[str], runs: list[tuple[int, int, int]]) -> list[tuple[int, np.ndarray]]:
    """Start and emissions of each run (row, first and last window): every place is scored by the window it lies deepest in."""
    windows = [(row, k) for row, first, last in runs for k in range(first, last + 1)]
    starts = {row: window_starts(len(texts[row])) for row, _, _ in runs}
    scores = []
    for at in range(0, len(windows), 256):
        part = windows[at : at + 256]
        ids = np.zeros((len(part), WINDOW), np.int64)
        for i, (row, k) in enumerate(part):
            own = characters(texts[row][starts[row][k] : starts[row][k] + WINDOW])
            ids[i, : len(own)] = own
        scores.extend(tagger.emissions(ids))
    out, at = [], 0
    for row, first, last in runs:
        own, pieces = starts[row][first : last + 1], []
        edges = [own[0], *((a + b + WINDOW) // 2 for a, b in zip(own, own[1:])), min(own[-1] + WINDOW, len(texts[row]))]
        for start, low, high in zip(own, edges, edges[1:]):
            pieces.append(scores[at][low - start : high - start])
            at += 1
        out.append((own[0], np.concatenate(pieces)))
    return out


def _decoded(tagger: Tagger, emissions: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """The best tags of each run, over its whole length, and how likely each of them is."""
    out: list = [None] * len(emissions)
    order = sorted(range(len(emissions)), key=lambda i: len(emissions[i]))
    while order:
        n = max(1, min(len(order), _CELLS // max(1, len(emissions[order[0]]))))
        while n > 1 and n * len(emissions[order[n - 1]]) > _CELLS:
            n = n // 2
        part, order = order[:n], order[n:]
        lengths = np.array([len(emissions[i]) for i in part])
        scores = np.zeros((n, lengths.max(), _TAGS), np.float32)
        for k, i in enumerate(part):
            scores[k, : lengths[k]] = emissions[i]
        tags, likely = tagger.decode(scores, lengths), tagger.likely(scores, lengths)
        for k, i in enumerate(part):
            own = tags[k, : lengths[k]]
            out[i] = own, likely[k, np.arange(len(own)), own]
    return out


#: Places decoded at a time; a longer run is decoded alone.
_CELLS = 1 << 16


def model_spans(tagger: Tagger, texts: list[str]) -> list[list[tuple[int, int, int]]]:
    """What the network finds in each text, reconciled.

    Every span has an @ or digits, so stretches without either are not run. Windows that overlap are
    stitched and decoded as one, so a span may be of any length. One that reaches the edge of its stretch
    may go on behind it: the stretch then grows by its length on that side and is read again.
    """
    found: list[list[tuple[int, int, int, float]]] = [[] for _ in texts]
    waiting = [(row, first, last) for row, text in enumerate(texts) for first, last in telling_runs(text)]
    while waiting:
        longer = []
        stitched = _stitched(tagger, texts, waiting)
        for (row, first, last), (start, scores), (tags, likely) in zip(waiting, stitched, _decoded(tagger, [s for _, s in stitched])):
            text, own, cut = texts[row], [], [False, False]
            for begin in np.flatnonzero(tags % 2 == 1).tolist():
                kind, end = (int(tags[begin]) - 1) // 2, begin + 1
                while end < len(tags) and tags[end] == 2 + 2 * kind:
                    end += 1
                cut[0] |= begin == 0 and start > 0
                cut[1] |= end == len(tags) and start + end < len(text)
                sure, (a, b) = float(likely[begin:end].mean()), _whole(kind, text, start + begin, start + end)
                value = text[a:b]
                if sure >= CONFIDENCE and _plausible(kind, value) and value == value.strip():
                    own.append((kind, a, b, round(sure, 4)))
            if any(cut):
                more, most = last - first + 1, len(window_starts(len(text))) - 1
                longer.append((row, max(0, first - more * cut[0]), min(most, last + more * cut[1])))
            else:
                found[row] += own
        waiting = _joined(longer)
    return [reconcile(f) for f in found]


def _joined(runs: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Runs of one text that have met are one."""
    out: list[tuple[int, int, int]] = []
    for row, first, last in sorted(runs):
        if out and out[-1][0] == row and first <= out[-1][2] + 1:
            out[-1] = row, out[-1][1], max(last, out[-1][2])
        else:
            out.append((row, first, last))
    return out


def all_spans(base: list[tuple[int, int, int]], added: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The base spans and those added that touch none of them, by kind and start."""
    taken = np.array([(a, b) for _, a, b in base], np.int64).reshape(-1, 2)
    free = [s for s in added if not ((taken[:, 0] < s[2]) & (s[1] < taken[:, 1])).any()]
    return sorted([*base, *free])


def _labelled(tagger: Tagger):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        named = lambda spans: [{"kind": KINDS[k], "start": a, "end": b} for k, a, b in spans]
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                # Every rule needs a digit or an @.
                texts = [t if t and _TELLING.search(t) else "" for t in part.column("text").to_pylist()]
                base = [base_spans(t) for t in texts]
                spans = [all_spans(b, m) for b, m in zip(base, model_spans(tagger, texts))]
                columns = [pa.array([named(s) for s in x], kind) for x in (base, spans)]
                yield pa.record_batch([*part.columns, *columns], [*part.schema.names, "base_spans", "spans"])

    return run


def fit_tagger(df: DataFrame) -> Tagger:
    """Learn from at most SAMPLE_ROWS documents with a digit or an @, labelled by the rules.

    They are looked for among at most about forty times as many documents.
    """
    few = df.select("text").where(hashed_share(F.col("text"), 40 * SAMPLE_ROWS, df.count()))
    telling = few.where(F.col("text").rlike("[0-9@]") & (F.length("text") <= SAMPLE_CHARS))
    sample = telling.orderBy(F.xxhash64("text"), "text").limit(SAMPLE_ROWS)
    return train([row["text"] for row in sample.toLocalIterator()])


def find_personal_data(df: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """``df`` with base_spans, found by the rules, and spans, those and what the network adds.

    Spans are structs of kind, start and end in code points, end exclusive, by kind (in the
    order of KINDS) and start. A null or empty text has none. Input columns of these names are
    replaced; all others stay. Repeated rows have equal spans. No rows give no rows.
    """
    tagger = tagger or fit_tagger(df)
    df = df.drop("base_spans", "spans")
    kind = "array<struct<kind: string, start: bigint, end: bigint>>"
    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(_labelled(tagger), f"{fields}, base_spans {kind}, spans {kind}")


def personal_data_digest(df: DataFrame) -> DataFrame:
    """Counts and digest of the base spans, and all spans as text."""
    found = find_personal_data(df.select("doc_id", "text"))
    joined = lambda name: F.array_join(
        F.transform(name, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    count = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("bigint")
    counts = [count(kind).alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(joined("base_spans"), 256).alias("base_sha256"), joined("spans").alias("spans"))
