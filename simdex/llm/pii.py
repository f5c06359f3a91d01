r"""Personal data (operator 6).

Method: candidate gradient boosting.  High-recall generators propose overlapping
spans of the kinds email, ip, card and phone (also disguised ones: ``at`` and
``dot`` spelt out, other separators, no leading plus); boosted trees score each
span from its format and the text around it; a threshold per kind, calibrated on
all texts the trees didn't see (a quarter, by hash), selects what is added.  Spans of the base definitions
are always kept; a selected span is added if it overlaps none of them, better
scores first.

The trees are fitted to the candidates of all texts.  Tasks find them; edges of bins are
quantiles of all of them; equal binned candidates are counted together.  A level of a tree needs the
sums of its nodes' bins only: these are added up by Spark, or, while the different binned candidates are at most
``LOCAL_VECTORS``, from their counts on the driver, which gives the same sums.  A candidate that is a base span
is an example; so is each base span in a disguise (the listed rewritings), put into
its own surroundings; the other candidates are counter-examples.

Base spans, leftmost and non-overlapping per kind (places count code points):
email ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+``; ip
``[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)`` with parts of at most 255; card
``[0-9]([\x20-]?[0-9])+`` of 12 to 19 digits that pass the Luhn test; phone
``\+[0-9][\x20().0-9-]+[0-9]`` of 9 to 15 digits.  A match that fails is dropped.

Defined results: a null text is empty and has no spans; ties go by start, then
kind as listed; rows repeat as they come; other columns are not looked at; an
empty table gives no rows, and where the texts have no example nothing is added.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sizing import stored
from .common import small_batches

KINDS = ("email", "ip", "card", "phone")
LOCAL_VECTORS = 50_000    # different binned candidates that are added up on the driver, at most
FOLDS = 4                 # of texts by their hash; the last is what the trees don't see
GRID = 100_000            # steps of a score that thresholds are told apart by
PRECISION = 0.98          # least precision on unseen candidates that a threshold must reach
LEAST_SCORE = 0.9         # no threshold is lower
CONTEXT = 24              # characters before and after a span that the trees see

Span = tuple[int, int, int]  # start, end, kind

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# a match begins and ends with a whole run of digits, so only a run's start is tried
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def digits_of(s: str) -> str:
    return "".join(_DIGIT.findall(s))


def emails(text: str) -> list[Span]:
    """The pattern's matches, found from each ``@`` instead of from each letter."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and _LOCAL.match(text, start - 1):
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, m.end(), 0))
            end = m.end()
        at = text.find("@", max(end, at + 1))
    return out


def base_spans(text: str) -> list[Span]:
    """The spans of the base definitions, by start, then kind."""
    out = emails(text)
    if _DIGIT.search(text):
        out += [(*m.span(), 1) for m in _IP.finditer(text)
                if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            d = digits_of(m[0])
            if 12 <= len(d) <= 19 and luhn(d):
                out.append((*m.span(), 2))
        if "+" in text:
            out += [(*m.span(), 3) for m in _PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[0], s[2]))


# -- candidates --------------------------------------------------------------

_AT = re.compile(r"@|\s?[(\[]\s?at\s?[)\]]\s?|\sat\s", re.I)
_LEFT = re.compile(r"[A-Za-z0-9._%+-]{1,64}$")
_RIGHT = re.compile(r"[A-Za-z0-9-]{1,64}((\s?[(\[]\s?dot\s?[)\]]\s?|\sdot\s|\s?\.\s?)[A-Za-z0-9-]{1,64})+", re.I)
_QUAD = re.compile(r"[0-9]{1,3}(\s?[.]\s?[0-9]{1,3}){3}")
_DIGITS = re.compile(r"[+(]?[0-9](?:[ ().\-/]{0,2}[0-9]){7,22}")


#: What a sentence doesn't have: such a candidate may be a disguised address, so it is no counter-example.
_DISGUISED = re.compile(r"[(\[]\s?(at|dot)\s?[)\]]|\sdot\s", re.I)


def candidates(text: str) -> list[Span]:
    """Overlapping spans that may be personal data, of every kind that fits."""
    out = []
    for m in _AT.finditer(text):
        left = _LEFT.search(text[max(0, m.start() - 64):m.start()])
        right = _RIGHT.match(text, m.end())
        if left and right:
            out.append((m.start() - len(left[0]), right.end(), 0))
    if _DIGIT.search(text):
        out += [(*m.span(), 1) for m in _QUAD.finditer(text)]
        for m in _DIGITS.finditer(text):
            n = len(digits_of(m[0]))
            if 12 <= n <= 19:
                out.append((*m.span(), 2))
            if 9 <= n <= 15:
                out.append((*m.span(), 3))
    return out


_HINTS = (re.compile(r"mail|contact|write|schreib|correo|courriel", re.I),
          re.compile(r"\bip\b|host|server|addr", re.I),
          re.compile(r"card|visa|karte|tarjeta|carte|pay", re.I),
          re.compile(r"phone|tel|call|fax|mobil", re.I))


def features(text: str, span: Span) -> list[float]:
    """Format of the span, and what stands around it."""
    a, b, kind = span
    s = text[a:b]
    d = digits_of(s)
    before, after = text[max(0, a - CONTEXT):a], text[b:b + CONTEXT]
    parts = re.split(r"\D+", s.strip("+( "))
    return [kind, len(s), len(d), s.count("@"), s.count("."), s.count("-"), s.count(" "),
            s.count("(") + s.count("["), float(s[:1] == "+"), float(luhn(d)) if d else 0.0,
            sum(map(str.isalpha, s)) / max(1, len(s)), len(parts), max(map(len, parts), default=0),
            min(map(len, parts), default=0),
            max((int(p) for p in parts if 0 < len(p) < 8), default=0),
            float(bool(re.search(r"\b(at|dot)\b", s, re.I))), len(re.split(r"[. )\]]", s)[-1]),
            float(before[-1:].isalnum()), float(after[:1].isalnum()),
            float(before[-1:].isspace() or not before), float(after[:1] in "-./+_"),
            float(before[-1:] in "-./+_" and bool(before)), *(float(bool(h.search(before))) for h in _HINTS),
            sum(map(str.isdigit, before + after)), float(bool(re.search(r"[=/:#]\s?\S*$", before)))]


#: Rewritings by which a base span becomes an example of a disguised one.
DISGUISES = (
    (lambda s: s.replace("@", " at ").replace(".", " dot "), lambda s: s.replace("@", "(at)"),
     lambda s: s.replace("@", " [at] ").replace(".", " [dot] ")),
    (lambda s: s.replace(".", " . "),),
    (lambda s: s.replace(" ", ".").replace("-", "."), lambda s: re.sub(r"\D", "", s),
     lambda s: "/".join(re.findall(r"\d{1,4}", digits_of(s)))),
    (lambda s: s.lstrip("+"), lambda s: re.sub(r"[ ]", "-", s).lstrip("+"),
     lambda s: "(" + digits_of(s)[:3] + ") " + digits_of(s)[3:6] + "-" + digits_of(s)[6:]),
)


# -- boosted trees -----------------------------------------------------------


class Boosted:
    """Binary gradient-boosted trees on binned features (logistic loss, Newton steps)."""

    def __init__(self, rounds: int = 40, depth: int = 4, rate: float = 0.2, bins: int = 32, l2: float = 2.0):
        self.rounds, self.depth, self.rate, self.bins, self.l2 = rounds, depth, rate, bins, l2
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(self.edges)], axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins)[1:-1])) for c in x.T]
        self.begin(y.mean())
        return self.grow(Sums(self._binned(x), y, np.ones(len(y))))

    def begin(self, mean: float) -> None:
        mean = np.clip(mean, 1e-3, 1 - 1e-3)
        self.start = float(np.log(mean / (1 - mean)))

    def grow(self, sums) -> Boosted:
        """Add the trees; ``sums(self, tree)`` gives for each node and bin of a feature the candidates' sums of
        gradients and of second derivatives, and how many they are."""
        size = 2 ** (self.depth + 1)
        for _ in range(self.rounds):
            feature, cut, value = tree = np.full(size, -1), np.zeros(size, np.int64), np.zeros(size)
            for level in range(self.depth):
                if level and not (feature[2 ** (level - 1):2 ** level] >= 0).any():
                    break
                grads, curves, counts = sums(self, tree)
                for at in range(2 ** level, 2 ** (level + 1)):  # node n has the children 2n and 2n + 1
                    n = counts[at, 0].sum()
                    if not n:
                        continue
                    gs, hs = grads[at, 0].sum(), curves[at, 0].sum()
                    value[at] = self.rate * gs / (hs + self.l2)
                    if n < 20:
                        continue
                    gl, hl = grads[at].cumsum(axis=1)[:, :-1], curves[at].cumsum(axis=1)[:, :-1]
                    gain = (gl ** 2 / (hl + self.l2) + (gs - gl) ** 2 / (hs - hl + self.l2) - gs ** 2 / (hs + self.l2))
                    j, k = np.unravel_index(int(gain.argmax()), gain.shape)
                    if gain[j, k] > 1e-6:
                        feature[at], cut[at] = j, k
                        value[2 * at] = self.rate * gl[j, k] / (hl[j, k] + self.l2)
                        value[2 * at + 1] = self.rate * (gs - gl[j, k]) / (hs - hl[j, k] + self.l2)
            self.trees.append(tree)
        return self

    def node(self, z: np.ndarray, tree: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
        """The node of a tree that each binned candidate comes to."""
        (feature, cut, _), node = tree, np.ones(len(z), np.int64)
        for _ in range(self.depth):
            f = feature[node]
            node = np.where(f >= 0, 2 * node + (z[np.arange(len(z)), f] > cut[node]), node)
        return node

    def score(self, z: np.ndarray, score: np.ndarray | None = None, done: int = 0) -> np.ndarray:
        """The sums of the trees from ``done`` on, added to the ``score`` of those before."""
        score = np.full(len(z), self.start) if score is None else score
        for tree in self.trees[done:]:
            score = score + tree[2][self.node(z, tree)]
        return score

    def predict(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.score(self._binned(x))))


class Sums:
    """The sums of ``Boosted.grow`` over binned candidates ``z`` with labels ``y``, each ``n`` times."""

    def __init__(self, z: np.ndarray, y: np.ndarray, n: np.ndarray):
        self.z, self.y, self.n, self.score, self.done = z, y, n, None, 0

    def __call__(self, model: Boosted, tree) -> np.ndarray:
        self.score = model.score(self.z, self.score, self.done)
        self.done = len(model.trees)
        p = 1 / (1 + np.exp(-self.score))
        size, bins = 2 ** (model.depth + 1), model.bins
        node = model.node(self.z, tree) * bins
        weights = (self.y - p) * self.n, p * (1 - p) * self.n, self.n
        return np.array([[np.bincount(node + c, w, size * bins).reshape(size, bins) for c in self.z.T]
                         for w in weights]).transpose(0, 2, 1, 3)


class Model:
    def __init__(self, trees: Boosted, thresholds: list[float]):
        self.trees, self.thresholds = trees, thresholds


def examples(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, labels, and the text's number of each candidate of some texts."""
    x, y, row = [], [], []
    for i, t in enumerate(texts):
        base = base_spans(t)
        known = set(base)
        for s in candidates(t):
            if any(s[0] < b and a < s[1] for a, b, k in base if (a, b, k) != s) and s not in known:
                continue  # part of a base span of another kind says nothing
            if s not in known and s[2] == 0 and _DISGUISED.search(t[s[0]:s[1]]):
                continue
            x.append(features(t, s))
            y.append(s in known)
            row.append(i)
        for a, b, kind in base:
            for change in DISGUISES[kind]:
                new = change(t[a:b])
                other = t[max(0, a - CONTEXT):a] + new + t[b:b + CONTEXT]
                at = min(a, CONTEXT)
                x.append(features(other, (at, at + len(new), kind)))
                y.append(True)
                row.append(i)
    return np.array(x, float).reshape(len(x), -1 if x else 0), np.array(y, float), np.array(row, np.int64)


def train(texts: list[str]) -> Model | None:
    """Trees from three quarters of the texts, thresholds from the others."""
    x, y, row = examples(texts)
    if not len(y) or y.min() == y.max():
        return None
    unseen = row % 4 == 3
    if unseen.all() or y[~unseen].min() == y[~unseen].max():
        return None
    trees = Boosted().fit(x[~unseen], y[~unseen])
    p = trees.predict(x[unseen])
    thresholds = []
    for kind in range(len(KINDS)):
        mine = x[unseen][:, 0] == kind
        order = np.argsort(-p[mine], kind="stable")
        scores, good = p[mine][order], y[unseen][mine][order]
        precision = np.cumsum(good) / np.arange(1, len(good) + 1)
        ok = np.nonzero(precision >= PRECISION)[0]
        ok = ok[scores[ok] >= LEAST_SCORE]
        # nothing is added of a kind that has no example
        thresholds.append(float(scores[ok[-1]]) if len(ok) and good.any() else 2.0)
    return Model(trees, thresholds)


def _matrix(column: pa.Array, width: int, dtype) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(len(column), width)


def candidate_rows(docs: DataFrame, text: str) -> DataFrame:
    """``(unseen, y, x)``: the ``examples`` of every text, their labels and features."""
    t = docs.where(F.col(text).isNotNull()).select(F.col(text).cast("string").alias("text")) \
        .select("text", (F.pmod(F.xxhash64("text"), F.lit(FOLDS)) == FOLDS - 1).alias("unseen"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y, row = examples(batch.column(0).to_pylist())
            upto = pa.array(np.arange(len(y) + 1, dtype=np.int32) * (x.shape[1] if len(y) else 0))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).take(pa.array(row)), pa.array(y.astype(bool)),
                 pa.ListArray.from_arrays(upto, pa.array(x.reshape(-1)))], ["unseen", "y", "x"])
    return small_batches(t).mapInArrow(run, "unseen boolean, y boolean, x array<double>")


def fit(docs: DataFrame, *, text: str = "text") -> Model | None:
    """Trees from the candidates of three quarters of all texts, thresholds from those of the others."""
    rows = stored(candidate_rows(docs, text), "candidates")
    seen = rows.where(~F.col("unseen"))
    total, good = seen.agg(F.count("*"), F.coalesce(F.sum(F.col("y").cast("bigint")), F.lit(0))).first()
    if not 0 < good < total:
        return None
    width = len(features("", (0, 0, 0)))
    trees = Boosted()
    steps = [float(q) for q in np.linspace(0, 1, trees.bins)[1:-1]]
    edges = seen.agg(*[F.percentile_approx(F.col("x")[j], steps, 10_000).alias(f"c{j}") for j in range(width)]).first()
    trees.edges = [np.unique(e) for e in edges]
    trees.begin(good / total)

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(2), width, float)
            z = np.ascontiguousarray(trees._binned(x).astype(np.uint8)) if len(x) else np.zeros((0, width), np.uint8)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(x[:, 0].astype(np.int32)),
                                              pa.array([r.tobytes() for r in z], pa.binary())], ["unseen", "y", "kind", "z"])
    vectors = stored(rows.mapInArrow(bins, "unseen boolean, y boolean, kind int, z binary")
                     .groupBy("unseen", "y", "kind", "z").agg(F.count("*").alias("n")), "vectors")
    seen = vectors.where(~F.col("unseen")).select("y", "z", "n")
    if seen.count() <= LOCAL_VECTORS:
        got = seen.orderBy("z", "y").collect()
        trees.grow(Sums(_unpacked([r["z"] for r in got], width), np.array([r["y"] for r in got], float),
                        np.array([r["n"] for r in got], float)))
    else:
        trees.grow(lambda model, tree: spark_sums(seen, model, tree, width))
    return Model(trees, thresholds(vectors.where("unseen"), trees, width))


def _unpacked(z: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(z), np.uint8).reshape(len(z), width).astype(np.int64)


def spark_sums(vectors: DataFrame, model: Boosted, tree, width: int) -> np.ndarray:
    """``Sums`` over ``vectors(y, z, n)``: tasks add up theirs, Spark the tasks'; a level's bins come to the driver."""
    shape = (3, 2 ** (model.depth + 1), width, model.bins)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            y, n = (batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in (0, 2))
            total += Sums(_unpacked(batch.column(1).to_pylist(), width), y, n)(model, tree)
        total = total.reshape(3, -1)
        has = np.nonzero(total[2])[0]
        yield pa.RecordBatch.from_arrays([pa.array(has), *(pa.array(t[has]) for t in total)], ["cell", "g", "h", "n"])
    out = np.zeros((3, int(np.prod(shape[1:]))))
    for r in vectors.mapInArrow(run, "cell bigint, g double, h double, n double").groupBy("cell") \
            .agg(F.sum("g"), F.sum("h"), F.sum("n")).collect():
        out[:, r[0]] = r[1:]
    return out.reshape(shape)


def thresholds(vectors: DataFrame, trees: Boosted, width: int) -> list[float]:
    """The least score of each kind at which ``vectors(y, kind, z, n)`` from it on are right often enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = 1 / (1 + np.exp(-trees.score(_unpacked(batch.column(2).to_pylist(), width))))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in (0, 1, 3)), pa.array((p * GRID).astype(np.int64))],
                                             ["y", "kind", "n", "cell"])
    cells = vectors.select("y", "kind", "z", "n").mapInArrow(run, "y boolean, kind int, n bigint, cell bigint") \
        .where(F.col("cell") >= LEAST_SCORE * GRID).groupBy("kind", "cell") \
        .agg(F.sum("n").alias("n"), F.sum(F.when(F.col("y"), F.col("n")).otherwise(0)).alias("good")).collect()
    out = []
    for kind in range(len(KINDS)):
        mine = sorted(((r["cell"], r["n"], r["good"]) for r in cells if r["kind"] == kind), reverse=True)
        cell, n, good = np.array(mine, float).reshape(-1, 3).T
        ok = np.nonzero(np.cumsum(good) >= PRECISION * np.cumsum(n))[0]
        # nothing is added of a kind that has no example
        out.append(float(cell[ok[-1]] / GRID) if len(ok) else 2.0)
    return out


# -- all spans ---------------------------------------------------------------


def added_spans(texts: list[str], bases: list[list[Span]], model: Model | None) -> list[list[Span]]:
    """What the trees add in each text; the candidates of all texts are scored together."""
    out: list[list[Span]] = [[] for _ in texts]
    if model is None:
        return out
    found = []
    for i, t in enumerate(texts):
        for s in candidates(t):
            if not any(s[0] < b and a < s[1] for a, b, _ in bases[i]):
                found.append((i, s))
    if not found:
        return out
    p = model.trees.predict(np.array([features(texts[i], s) for i, s in found], float))
    for q in sorted(range(len(found)), key=lambda q: (found[q][0], -p[q], found[q][1][0], found[q][1][2])):
        i, s = found[q]
        if p[q] >= model.thresholds[s[2]] and not any(s[0] < b and a < s[1] for a, b, _ in out[i]):
            out[i].append(s)
    return out


def digest(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def _rows(df: DataFrame, keep: list[str], text: str) -> DataFrame:
    return small_batches(df).select(*keep, F.col(text).cast("string").alias("__text"))


def find(docs: DataFrame, model: Model | None = None, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans)`` of every row; the counts and
    the digest are of the base spans."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some dozen small trees
    kind = docs.select(doc_id).schema[0].dataType.simpleString()
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            bases = list(map(base_spans, texts))
            added = added_spans(texts, bases, model)
            counts = [pa.array([sum(s[2] == k for s in b) for b in bases], pa.int64()) for k in range(4)]
            sha = [hashlib.sha256(digest(b).encode()).hexdigest() for b in bases]
            every = [digest(sorted(b + a, key=lambda s: (s[0], s[2]))) for b, a in zip(bases, added)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, pa.array(sha, pa.string()),
                                              pa.array(every, pa.string())], names)
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return _rows(d, ["doc_id"], "text").mapInArrow(
        run, f"doc_id {kind}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
             "base_sha256 string, spans string")


def redacted(text: str, spans: list[Span]) -> str:
    """``text`` with each span (overlapping ones together) replaced by its kind's name."""
    out, upto, last = [], 0, -1
    for a, b, k in sorted(spans, key=lambda s: (s[0], s[2])):
        if a >= last:
            out += [text[upto:a], f"[{KINDS[k].upper()}]"]
        upto = last = max(last, b)
    return "".join(out) + text[upto:]


def redact(docs: DataFrame, model: Model | None = None, *, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``docs`` with every span replaced, in the same columns; null texts stay null."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    cols = docs.columns
    at, chars_at = cols.index(text), cols.index(n_chars) if n_chars in cols else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            out, raw = list(batch.columns), batch.column(at).to_pylist()
            texts = [t or "" for t in raw]
            bases = list(map(base_spans, texts))
            added = added_spans(texts, bases, model)
            if any(bases) or any(added):
                new = [redacted(t, b + a) if b or a else t for t, b, a in zip(texts, bases, added)]
                new = [None if r is None else n for r, n in zip(raw, new)]
                out[at] = pa.array(new, pa.string())
                if chars_at is not None:
                    chars = [c if n == r else len(n) for c, n, r in
                             zip(batch.column(chars_at).to_pylist(), new, raw)]
                    out[chars_at] = pa.array(chars, batch.column(chars_at).type)
            yield pa.RecordBatch.from_arrays(out, names=cols)
    return small_batches(docs).mapInArrow(run, docs.schema)
