"""Secret scan: patterns propose candidates, and a small character convolutional network judges each with its surroundings.

Candidates are the base findings (kinds assign, access, hex), what matches a base pattern but is too short for it, runs of token
characters with digits or of unusual length, and words that follow a word such as "password" or "key". The network reads each over
its whole length, a long one in overlapping windows, with the text round it. Base findings stay whatever their score; another
candidate that scores over the threshold is added as kind `model`.

The network is trained on labelled findings: the base findings of every document, made-up credentials of usual forms set into
places of documents, and, as negatives, all other candidates and made-up harmless runs. The documents' windows are dealt into shards;
in each epoch a copy of the network goes over each shard and the made-up runs, and the copies' mean starts the next epoch. Its scores
are calibrated (Platt) on the documents and made-up runs it wasn't trained on, and the threshold is the highest that keeps `RECALL` of
their secrets; beyond as many windows as made-up ones, a class's windows of documents weigh as much as those together.
"""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from corvane.llm.common import free_name, lean, once, written

#: The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run of 24 or more, as a run is taken whole
KINDS = ("assign", "access", "hex", "model")
#: Other candidates: runs of token characters, 8 or more with a digit or 20 or more without; and what stands where a secret would.
RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])(?:(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_=-]{8,}|[A-Za-z0-9+/_=-]{20,})(?:\.[A-Za-z0-9+/_=-]{8,})*")
PLACE = re.compile(r"""\b(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|(?:access|private)[_ -]?key|auth(?:orization)?|bearer|credentials?|login)\b["']?[ \t]{0,2}(?:[:=]|is\b)?[ \t]{0,2}["']?(?:bearer |basic )?([A-Za-z0-9+/_.=!@#$%^&*-]{5,})""", re.IGNORECASE | re.ASCII)
#: Known heads of credentials, and runs so mixed that they may be one: such candidates are left without a label.
KNOWN = re.compile(r"(?:gh[a-z]_|sk[-_]|pk[-_]|xox|AIza|eyJ|glpat-|AKIA)")

#: Documents that lend places to made-up runs, and made-up runs of each class.
SAMPLE_DOCS, MADE_UP = 2000, 900
#: Windows of a shard, as a rule; tenths of the documents, and the part of the made-up runs, that are trained on.
SHARD, TRAINED_ON = 2048, 7
RECALL, SEED = 0.98, 20260102
BEFORE, INSIDE, AFTER = 24, 48, 16
#: Windows that are encoded at a time.
HELD_WINDOWS = 4096
WIDTH, CHANNELS, FILTERS, EPOCHS, BATCH, RATE = 5, 12, 24, 6, 64, 0.005

#: Character classes: 0 padding, 1 to 95 printable ASCII, then line breaks and other white space, non-ASCII letters, the rest.
_CLASSES = 99


def encode(text: str, start: int, stop: int) -> np.ndarray:
    """The classes of the characters before, inside and after a candidate of at most INSIDE characters, or a window of a longer one."""
    inside = text[start:stop]
    parts = (text[max(0, start - BEFORE) : start].rjust(BEFORE, "\0"), inside.ljust(INSIDE, "\0"), text[stop : stop + AFTER].ljust(AFTER, "\0"))
    return np.array([0 if c == "\0" else ord(c) - 31 if " " <= c <= "~" else 96 if c.isspace() else 97 if c.isalpha() else 98 for c in "".join(parts)], np.int64)


def windows(start: int, stop: int) -> list[tuple[int, int]]:
    """Windows of INSIDE characters, half overlapping, that cover a candidate; the last ends with it."""
    if stop - start <= INSIDE:
        return [(start, stop)]
    return [(a, a + INSIDE) for a in [*range(start, stop - INSIDE, INSIDE // 2), stop - INSIDE]]


def base(text: str) -> list[tuple[int, int, str]]:
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    return found + [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]


def merged(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Stretches that cover the same characters, ascending and apart."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def others(text: str, found: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """Candidates besides base findings, ascending and apart: short matches of the base patterns, runs, and words where a secret would stand.

    Of a run that base findings overlap, the parts that they leave and that are runs by themselves. One walk over both, in order.
    """
    wide = [m.span(2) for m in ASSIGN.finditer(text) if len(m[2]) < 6] + [m.span() for m in ACCESS.finditer(text) if len(m[0]) < 20]
    wide += [m.span(1) for m in PLACE.finditer(text)] + [m.span() for m in RUN.finditer(text)]
    taken, out, k = merged([x[:2] for x in found]), [], 0
    for start, stop in merged(wide):
        while k < len(taken) and taken[k][1] <= start:
            k += 1
        if k == len(taken) or taken[k][0] >= stop:
            out.append((start, stop))
            continue
        at, j = start, k
        while at < stop:
            cut = taken[j] if j < len(taken) and taken[j][0] < stop else (stop, stop)
            if cut[0] > at:
                out += [(at + x.start(), at + x.end()) for x in RUN.finditer(text[at : cut[0]])]
            at, j = max(at, cut[1]), j + 1
    return out


class Network:
    """Embedding, one convolution, maximum over places, one logistic unit; Adam on the cross entropy."""

    def __init__(self, seed: int = SEED) -> None:
        rng = np.random.default_rng(seed)
        self.w = {"embed": rng.normal(0, 0.3, (_CLASSES, CHANNELS)), "filter": rng.normal(0, (2 / (WIDTH * CHANNELS)) ** 0.5, (WIDTH * CHANNELS, FILTERS)), "bias": np.zeros(FILTERS), "out": rng.normal(0, 0.3, FILTERS), "end": np.zeros(1)}
        self.w = {k: v.astype(np.float32) for k, v in self.w.items()}
        self.moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.w.items()}
        self.step = 0.0
        self.scale, self.shift, self.threshold = 1.0, 0.0, 0.5

    def state(self) -> np.ndarray:
        """Weights, moments and step in one vector."""
        return np.concatenate([x.ravel().astype(np.float64) for k in self.w for x in (self.w[k], *self.moments[k])] + [[self.step]])

    def resume(self, state: np.ndarray) -> Network:
        at = 0
        for k, v in self.w.items():
            for x in (v, *self.moments[k]):
                x[...] = state[at : at + x.size].reshape(x.shape)
                at += x.size
        self.step = float(state[at])
        return self

    def _forward(self, x: np.ndarray):
        e = self.w["embed"][x]
        windows = np.lib.stride_tricks.sliding_window_view(e, WIDTH, axis=1).transpose(0, 1, 3, 2).reshape(len(x), x.shape[1] - WIDTH + 1, WIDTH * CHANNELS)
        h = windows @ self.w["filter"] + self.w["bias"]
        at = h.argmax(1)
        top = np.maximum(np.take_along_axis(h, at[:, None], 1)[:, 0], 0)
        return windows, at, top, top @ self.w["out"] + self.w["end"][0]

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self._forward(x[i : i + 512])[3] for i in range(0, len(x), 512)]) if len(x) else np.zeros(0)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.scale * self.logits(x) + self.shift)))

    def epoch(self, x: np.ndarray, y: np.ndarray, seed: list[int]) -> Network:
        """One pass over the windows in random order; both classes weigh the same."""
        weight = np.where(y > 0, 0.5 / max(1e-6, y.mean()), 0.5 / max(1e-6, 1 - y.mean()))
        order = np.random.default_rng(seed).permutation(len(x))
        for i in range(0, len(order), BATCH):
            own = order[i : i + BATCH]
            windows, at, top, z = self._forward(x[own])
            dz = (1 / (1 + np.exp(-z)) - y[own]) * weight[own] / len(own)
            dtop = dz[:, None] * self.w["out"] * (top > 0)
            rows = windows[np.arange(len(own))[:, None], at]  # batch, filter, window
            grads = {"out": dz @ top, "end": np.array([dz.sum()]), "bias": dtop.sum(0), "filter": np.einsum("bf,bfw->wf", dtop, rows)}
            dwin = (dtop[:, :, None] * self.w["filter"].T[None]).reshape(len(own), FILTERS, WIDTH, CHANNELS)
            de = np.zeros_like(self.w["embed"])
            places = at[:, :, None] + np.arange(WIDTH)
            np.add.at(de, x[own][np.arange(len(own))[:, None, None], places], dwin)
            grads["embed"] = de
            self.step += 1
            for k, g in grads.items():
                m, v = self.moments[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                self.w[k] -= (RATE * (m / (1 - 0.9**self.step)) / (np.sqrt(v / (1 - 0.999**self.step)) + 1e-8)).astype(np.float32)
        return self

    def calibrate(self, z: np.ndarray, y: np.ndarray, n: np.ndarray) -> None:
        """Platt scaling of n windows of each logit and class by Newton steps, then the highest threshold that keeps RECALL of the secrets."""
        secrets = float(n[y > 0].sum())
        t = np.where(y > 0, (secrets + 1) / (secrets + 2), 1 / (n.sum() - secrets + 2))
        a, b = 1.0, 0.0
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
            g, s = np.array([(n * (p - t) * z).sum() + 1e-3 * (a - 1), (n * (p - t)).sum() + 1e-3 * b]), n * p * (1 - p)
            h = np.array([[(s * z * z).sum() + 1e-3, (s * z).sum()], [(s * z).sum(), s.sum() + 1e-3]])
            a, b = np.array([a, b]) - np.clip(np.linalg.solve(h, g), -1, 1)
        self.scale, self.shift = float(a), float(b)
        score = 1 / (1 + np.exp(-(self.scale * z[y > 0] + self.shift)))
        order = np.argsort(score, kind="stable")
        below = np.cumsum(n[y > 0][order]) - n[y > 0][order]
        self.threshold = float(score[order][below <= (1 - RECALL) * secrets + 1e-9][-1]) if secrets else 0.5


def _take(rng: random.Random, alphabet: str, n: int) -> str:
    return "".join(rng.choice(alphabet) for _ in range(n))


MIXED = string.ascii_letters + string.digits
#: Made-up credentials by form.
SECRETS = {
    "hub": lambda r, w: "gh" + r.choice("pousr") + "_" + _take(r, MIXED, 36),
    "dash": lambda r, w: "sk-" + _take(r, MIXED, r.randint(24, 48)),
    "live": lambda r, w: r.choice(["sk_live_", "pk_live_", "rk_test_"]) + _take(r, MIXED, 24),
    "chat": lambda r, w: "xoxb-" + _take(r, string.digits, 12) + "-" + _take(r, MIXED, 24),
    "maps": lambda r, w: "AIza" + _take(r, MIXED + "_-", 35),
    "jwt": lambda r, w: "eyJ" + _take(r, MIXED + "_-", 30) + ".eyJ" + _take(r, MIXED + "_-", 40) + "." + _take(r, MIXED + "_-", 43),
    "base64": lambda r, w: _take(r, MIXED + "+/", r.choice([40, 64])),
    "mixed": lambda r, w: _take(r, MIXED, r.randint(20, 44)),
    "hex": lambda r, w: _take(r, "0123456789abcdef", r.choice([16, 24, 32, 40, 64])),
    "access": lambda r, w: "AKIA" + _take(r, string.ascii_uppercase + string.digits, r.choice([10, 16])),
    "uuid": lambda r, w: "-".join(_take(r, "0123456789abcdef", n) for n in (8, 4, 4, 4, 12)),
    "chosen": lambda r, w: r.choice(w) + _take(r, string.digits, r.randint(1, 4)) + r.choice(["", "!", "#"]) + r.choice(w)[:3],
    "typed": lambda r, w: _take(r, MIXED + "!@#$%", r.randint(8, 14)),
}
#: Forms that only their place gives away, and what stands there.
PLACED = {"chosen", "typed", "uuid", "hex"}
LEADS = ("password: ", "password is ", "passwd=", "pwd: ", 'secret = "', "api_key=", "token: ", "login: ", "access_key = ", "auth: ", "credentials: ")
#: What else leads to a run, and to a plain word where a secret would stand.
STARTS = (" ", " ", "\n", ' "', ": ", "=")
MENTIONS = (" password: ", " password is ", " the token ", " the secret ", " a login ", " token = ", " auth: ")
#: Made-up runs that are no secret: numbers, dates, versions, paths, names joined with marks, and plain words where a secret would stand.
HARMLESS = {
    "joined": lambda r, w: f"{r.choice(w)}-{r.choice(w)}-{r.choice(w)}-{_take(r, string.digits, 2)}-{r.choice(w)}",
    "named": lambda r, w: f"{r.choice(w)}_{r.choice(w)}_{_take(r, string.digits, 3)}_{r.choice(w)}",
    "path": lambda r, w: f"/{r.choice(w)}/{r.choice(w)}/{r.choice(w)}/{_take(r, string.digits, 4)}/",
    "time": lambda r, w: f"20{_take(r, string.digits, 2)}-{_take(r, string.digits, 2)}-{_take(r, string.digits, 2)}T{_take(r, string.digits, 2)}-{_take(r, string.digits, 2)}Z",
    "counted": lambda r, w: f"{r.choice(w)}{r.choice(w)}{r.choice(w)}{_take(r, string.digits, 1)}",
    "book": lambda r, w: f"978-{_take(r, string.digits, 1)}-{_take(r, string.digits, 4)}-{_take(r, string.digits, 4)}-{_take(r, string.digits, 1)}",
    "equal": lambda r, w: f"{r.choice(w)}=={r.choice(w)}=={_take(r, string.digits, 2)}--{r.choice(w)}",
    "number": lambda r, w: _take(r, string.digits, r.choice([8, 9, 10, 12, 16, 19])),
    "phone": lambda r, w: f"{_take(r, string.digits, 3)}-{_take(r, string.digits, 3)}-{_take(r, string.digits, 4)}",
    "long": lambda r, w: "".join(r.choice(w) for _ in range(5)).lower()[:32].ljust(20, "e"),
    "word": lambda r, w: r.choice(w),
    "version": lambda r, w: f"{r.choice(w)}-{_take(r, string.digits, 1)}-{_take(r, string.digits, 2)}-{_take(r, string.digits, 2)}",
}


def _labelled(text: str) -> Iterator[tuple[bytes, int]]:
    """Windows of a document's base findings (1) and of its other candidates (0); what may be a credential has no label."""
    found = base(text)
    sure = ((ASSIGN.match(text, a).start(2) if kind == "assign" else a, b, 1) for a, b, kind in found)
    rest = ((a, b, 0) for a, b in others(text, found) if not KNOWN.match(text, a) and not _may_be_secret(text[a:b]))
    for a, b, label in itertools.chain(sure, rest):
        for w in windows(a, b):
            yield encode(text, *w).astype(np.uint8).tobytes(), label


def _may_be_secret(run: str) -> bool:
    return len(run) >= 16 and bool(re.search("[0-9]", run)) and (bool(re.search("[a-z]", run) and re.search("[A-Z]", run)) or not re.search("[g-zG-Z/_=-]", run) and not run.isdigit())


def sample(docs: DataFrame, id_col: str, text_col: str, n: int = SAMPLE_DOCS) -> tuple[DataFrame | None, list[str]]:
    """The labelled windows of every document (None if there are none), and stretches of 300 characters of at most n documents as places.

    Windows are rows (doc, k, w, y) of a table in the scratch folder: the hash of the document's id and text, the window's number in it,
    its classes and its label. Repeated rows of docs count once. Only places come to the driver: they are where made-up runs are set.
    """
    hashed = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("t"))
    hash_of = F.xxhash64(F.coalesce("id", F.lit("")), "t").alias("h")
    total = docs.count()
    if not total:
        return None, []
    share = min(1.0, 1.2 * n / total)
    place = F.expr("substring(t, int(pmod(h, greatest(1, char_length(t) - 300))) + 1, 300)").alias("place")
    lent = hashed.select(hash_of, "t").where(F.pmod("h", F.lit(1_000_000)) < int(share * 1_000_000) + 1).select("h", place).distinct().orderBy("h", "place").limit(n)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = ((h, k, w, y) for h, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True) for k, (w, y) in enumerate(_labelled(t.as_py())))
            while held := list(itertools.islice(rows, HELD_WINDOWS)):
                columns = zip(zip(*held, strict=True), (pa.int64(), pa.int64(), pa.binary(), pa.int32()), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in columns], ["doc", "k", "w", "y"])

    found = written(once(hashed, "repeated").select(hash_of, "t").mapInArrow(run, "doc long, k long, w binary, y int"), "labelled")
    return found if found.head(1) else None, [r.place for r in lent.collect()]


def made_up(places: list[str], forms: dict, n: int, seed: int) -> list[tuple[str, int, int]]:
    """n runs of the forms in turn, set into places: (text, start, stop)."""
    rng, out, names = random.Random(seed), [], sorted(forms)
    words = sorted({w for t in places for w in re.findall(r"[A-Za-z]{3,12}", t)}) or ["word", "other", "some"]
    places = [t for t in places if len(t) > 40] or ["some text that is long enough to hold a finding or two"]
    for k in range(n):
        name, t = names[k % len(names)], rng.choice(places)
        at = max(0, t.find(" ", rng.randrange(len(t))))
        piece = forms[name](rng, words)
        if name in PLACED or name in SECRETS and rng.random() < 0.3:
            lead = " " + rng.choice(LEADS)
        else:
            lead = rng.choice(MENTIONS if name == "word" else STARTS[: len(STARTS) - (name in HARMLESS)])
        out.append((t[:at] + lead + piece + t[at:], at + len(lead), at + len(lead) + len(piece)))
    return out


def examples(places: list[str], secrets=None, harmless=None, n: int = MADE_UP, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Labelled windows of made-up secrets and harmless runs in these places."""
    x, y = [], []
    for label, forms in ((1, SECRETS if secrets is None else secrets), (0, HARMLESS if harmless is None else harmless)):
        for text, start, stop in made_up(places, forms, n, seed + label):
            x += [encode(text, *w) for w in windows(start, stop)]
            y += [label] * (len(x) - len(y))
    return np.array(x), np.array(y, np.float32)


def _read(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The windows and labels of a shard, in an order that doesn't depend on the tasks before."""
    rows = rows.sort_by([(c, "ascending") for c in ("doc", "k", "w", "y")])
    x = np.frombuffer(b"".join(rows["w"].to_pylist()), np.uint8).reshape(-1, BEFORE + INSIDE + AFTER)
    return x.astype(np.int64), rows["y"].to_numpy().astype(np.float32)


def dealt(found: DataFrame) -> DataFrame:
    """The labelled windows with their shard, and whether they are trained on: with all others of their document."""
    shards = -(-found.count() // SHARD)
    return found.withColumns({"shard": F.pmod(F.xxhash64("doc", "k"), F.lit(shards)), "trained_on": F.pmod(F.xxhash64("doc", F.lit("part")), F.lit(10)) < TRAINED_ON})


def mean_epoch(shards: DataFrame, net: Network, made: tuple[np.ndarray, np.ndarray], number: int) -> np.ndarray | None:
    """The mean state of copies of the network that went over a shard and the made-up windows each; None without a shard. Sums are decimal, so that reruns agree."""
    held = shards.sparkSession.sparkContext.broadcast((net.state(), made[0].astype(np.uint8), made[1]))

    def run(rows: pa.Table) -> pa.Table:
        state, x, y = held.value
        own, shard = _read(rows), rows["shard"][0].as_py()
        after = Network().resume(state).epoch(np.concatenate([own[0], x.astype(np.int64)]), np.concatenate([own[1], y]), [SEED + 1, number, shard]).state()
        return pa.table({"state": pa.array([after.tolist()], pa.list_(pa.float64()))})

    states = shards.where("trained_on").groupBy("shard").applyInArrow(run, "state array<double>")
    each = states.select(F.posexplode("state").alias("k", "x")).groupBy("k").agg(F.avg(F.col("x").cast("decimal(28,18)")).cast("double").alias("x"))
    rows = sorted(each.collect(), key=lambda r: r.k)  # a row for each number of the state
    return np.array([r.x for r in rows]) if rows else None


def counted(shards: DataFrame, net: Network) -> list[Row]:
    """How many windows that weren't trained on have a logit of z thousandths, rounded down, and label y."""
    held = shards.sparkSession.sparkContext.broadcast(net)

    def run(rows: pa.Table) -> pa.Table:
        x, y = _read(rows)
        pairs, n = np.unique(np.stack([y.astype(np.int64), thousandths(held.value.logits(x))]), axis=1, return_counts=True)
        return pa.table({"y": pairs[0], "z": pairs[1], "n": n.astype(np.int64)})

    each = shards.where("NOT trained_on").groupBy("shard").applyInArrow(run, "y long, z long, n long")
    return each.groupBy("y", "z").agg(F.sum("n").alias("n")).orderBy("y", "z").collect()


def thousandths(z: np.ndarray) -> np.ndarray:
    return np.floor(np.clip(z, -30, 30) * 1000).astype(np.int64)


def trained(found: tuple[DataFrame | None, list[str]], secrets=None, harmless=None) -> Network:
    """The network of all labelled windows, as sample() gives them, and of made-up runs of these forms."""
    labelled, places = found
    x, y = examples(places, secrets, harmless)
    part = np.random.default_rng(SEED).random(len(x)) < TRAINED_ON / 10
    shards = dealt(labelled) if isinstance(labelled, DataFrame) else None
    net = Network()
    for number in range(EPOCHS):
        state = mean_epoch(shards, net, (x[part], y[part]), number) if shards is not None else None
        net = net.epoch(x[part], y[part], [SEED + 1, number]) if state is None else net.resume(state)
    counts = counted(shards, net) if shards is not None else []
    most = {r: min(1.0, float((y[~part] == r).sum()) / max(1, sum(c.n for c in counts if c.y == r))) for r in (0, 1)}
    z = np.concatenate([thousandths(net.logits(x[~part])), [c.z for c in counts]])
    net.calibrate(z / 1000, np.concatenate([y[~part], [c.y for c in counts]]), np.concatenate([np.ones(len(z) - len(counts)), [c.n * most[c.y] for c in counts]]))
    return net


def spans(text: str | None, net: Network) -> tuple[list[tuple[int, int, str, float]], int]:
    """All findings (start, stop, kind, score), by start, then kind as listed; and how many candidates were scored."""
    if not text:
        return [], 0
    found = base(text)
    own = [(a, b, kind, ASSIGN.match(text, a).start(2) if kind == "assign" else a) for a, b, kind in found] + [(a, b, "model", a) for a, b in others(text, found)]
    best = np.zeros(len(own))
    parts = ((k, w) for k, (_, b, _, at) in enumerate(own) for w in windows(at, b))
    while held := list(itertools.islice(parts, HELD_WINDOWS)):
        np.maximum.at(best, [k for k, _ in held], net.scores(np.array([encode(text, *w) for _, w in held])))
    out = [(a, b, kind, float(s)) for (a, b, kind, _), s in zip(own, best, strict=True) if kind != "model" or s >= net.threshold]
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2]))), len(own)


def listed(found: list) -> str:
    return ",".join(f"{x[2]}:{x[0]}:{x[1]}" for x in found)


NAMES = {"n_assign": pa.int64(), "n_access": pa.int64(), "n_hex": pa.int64(), "base_sha256": pa.string(), "spans": pa.string(), "scores": pa.string(), "n_candidates": pa.int64()}


def scanned(docs: DataFrame, net: Network, text_col: str = "text") -> DataFrame:
    """docs with n_assign, n_access, n_hex, base_sha256 (of the base findings), spans (kind:start:stop of all findings; code points),
    scores (the network's, in the order of spans, base findings included) and n_candidates (how many it scored).

    Null and empty texts have none. Every candidate of the whole text is scored over its whole length: a long one by its highest window.
    Each row is scanned by itself, so repeated rows get equal findings; an empty table gives no rows. Columns of docs are kept, but for
    those named like the new ones, which are replaced.
    """
    held = docs.sparkSession.sparkContext.broadcast(net)

    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for text in batch:
                found, scored = spans(text.as_py(), held.value)
                own = [x for x in found if x[2] != "model"]
                out.append({f"n_{k}": sum(x[2] == k for x in own) for k in KINDS[:3]} | {"base_sha256": hashlib.sha256(listed(own).encode()).hexdigest(), "spans": listed(found), "scores": ",".join(f"{x[3]:.4f}" for x in found), "n_candidates": scored})
            yield pa.array(out, pa.struct(list(NAMES.items())))

    schema = "struct<" + ",".join(f"{k}:{'string' if v == pa.string() else 'bigint'}" for k, v in NAMES.items()) + ">"
    own = free_name("found", docs)
    out = docs.withColumn(own, F.arrow_udf(scan, schema)(F.col(text_col)))
    return out.withColumns({k: F.col(f"{own}.{k}") for k in NAMES}).drop(own)


def report(docs: DataFrame) -> DataFrame:
    """One row for each document: doc_id and what scanned() adds."""
    net = trained(sample(docs, "doc_id", "text"))
    return scanned(docs.select("doc_id", "text"), net).select("doc_id", *NAMES)
