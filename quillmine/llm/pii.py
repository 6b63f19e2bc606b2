"""Personal data: exact patterns, and a skip-chain conditional random field that adds spans of like tokens.

The patterns (email, ip, card, phone) are scanned in linear time. The field labels tokens that hold a digit or an ``@``; all
other tokens are outside by definition, so they cut the chain and need no node. Neighbouring candidate tokens are linked by a
learned label-to-label potential. Distant tokens of a document that are equal, or whose digits are (six or more), are tied by a learned
agreement potential to the first such token, so any two mentions are two links apart, however many lie between. Tokens inside a
pattern's span are observed: their label is given, and it is what the links carry to the other mentions. Marginals come from loopy sum-product
message passing over all documents of a batch at once, damped; a document is done when none of its messages changes by more than TOLERANCE (or after ROUNDS rounds).

Weights are fitted here by pseudo-likelihood, with the patterns' own spans as labels, on a bounded sample of texts of any length, whose tokens' labels and
features the executors count out. A node's features are
its form (shape, length, check digit, its neighbours' shapes) and its context (the words around it). Patterns are
functions of the form, so a second copy of each token is learned from with its form hidden: only so do context and links get weights of
their own, which find mentions that no pattern fits. Runs of tokens with one label, sure enough (MARGIN), become
spans, if they overlap no span of a pattern.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("email", "ip", "card", "phone")
#: Bounds on the distinct texts that the field is fitted on, picked by a hash, and on the tokens of each that it learns from, at even steps.
SAMPLE_ROWS, SAMPLE_TOKENS = 3000, 256
#: Hashed features; the number after the last stands for a hidden one, without weight.
BUCKETS = 1 << 12
ROUNDS, TOLERANCE, DAMPING, MARGIN = 100, 1e-4, 0.3, 0.9
#: Features of a token's form come first, then those of its context.
FORM, CONTEXT = 6, 3
#: What keeps a pattern's token at its label.
_OBSERVED = 1e4

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"\S+")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_SHAPE = re.compile(r"([0-9]+)|([^\W\d_]+)")


def luhn(digits: str) -> bool:
    odd = sum(int(c) for c in digits[-1::-2])
    even = sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(c)] for c in digits[-2::-2])
    return (odd + even) % 10 == 0


def by_place(span: tuple[int, int, int]) -> tuple[int, int, int]:
    """By start, then kind, then end."""
    return span[0], span[2], span[1]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) by start, then kind, of the patterns' matches: leftmost, not overlapping within a kind."""
    found = []
    if "@" in text:
        end = last = 0
        for m in _DOMAIN.finditer(text):
            at = m.start()
            head = text[max(end, last) : at]
            size = len(head) - len(head.rstrip(_LOCAL))
            last = at + 1
            if size:
                found.append((at - size, m.end(), 0))
                end = m.end()
    if re.search("[0-9]", text):
        for m in _IP.finditer(text):
            if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
                found.append((m.start(), m.end(), 1))
        for m in _CARD.finditer(text):
            if 14 <= m.end() - m.start() and 14 <= len(digits := _NOT_DIGIT.sub("", m[0])) <= 19 and luhn(digits):
                found.append((m.start(), m.end(), 2))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                    found.append((m.start(), m.end(), 3))
    return sorted(found, key=by_place)


def _shape(token: str) -> str:
    return _SHAPE.sub(lambda m: f"d{min(len(m[1]), 20)}" if m[1] else "a", token)


def _check(core: str) -> str:
    """Whether a token of many digits has a check digit, and one of parts between dots holds bytes."""
    digits = _NOT_DIGIT.sub("", core)
    parts = core.split(".")
    known = luhn(digits) if 14 <= len(digits) <= 19 else "-"
    return f"{known}{all(p.isdecimal() and len(p) <= 3 and int(p) <= 255 for p in parts) if len(parts) == 4 else '-'}"


def _bucket(feature: str) -> int:
    return int.from_bytes(hashlib.blake2b(feature.encode("utf-8", "surrogatepass"), digest_size=4).digest(), "little") % BUCKETS


def _first_overlaps(spans: list[tuple[int, int, int]], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each range the number of the first span that it overlaps, or -1; ``spans`` in order of their starts.

    A span overlaps if it starts before the range's end and ends after its start. The first span that ends so late is the first at which
    the largest end so far is so late, which is found by bisection.
    """
    begin, until = np.array([s for s, _, _ in spans], np.int64), np.maximum.accumulate(np.array([e for _, e, _ in spans], np.int64))
    first = np.searchsorted(until, starts, side="right")
    return np.where((first < len(spans)) & (begin[np.minimum(first, len(spans) - 1)] < ends), first, -1)


class Graph:
    """Candidate tokens of many documents with their features and links."""

    def __init__(self, texts: list[str]):
        self.at: list[tuple[int, int, int]] = []  # document, start, end
        self.features: list[list[int]] = []
        self.chain: list[tuple[int, int]] = []
        self.skip: list[tuple[int, int]] = []
        self._known: dict[str, int] = {}
        for d, text in enumerate(texts):
            if _TRIGGER.search(text):
                self._add(d, text)

    def _add(self, d: int, text: str) -> None:
        words = [(m[0], m.start()) for m in _TOKEN.finditer(text)]
        cores = [w.strip(".,;:!?\"'") if _TRIGGER.search(w) else "" for w, _ in words]
        shapes = [_shape(c) if c else "-" for c in cores]
        first: dict[str, int] = {}

        def word(i: int) -> str:
            return "#" if not 0 <= i < len(words) else "0" if cores[i] else words[i][0].strip(".,;:!?\"'()").lower()

        for i, core in enumerate(cores):
            if not core:
                continue
            n, start = len(self.at), words[i][1] + words[i][0].index(core)
            self.at.append((d, start, start + len(core)))
            if i and cores[i - 1]:
                self.chain.append((n - 1, n))
            digits = _NOT_DIGIT.sub("", core)
            like = {first.setdefault(key, n) for key in ("t" + core.lower(), *(["d" + digits] if len(digits) >= 6 else []))}
            self.skip += [(other, n) for other in sorted(like) if other != n and not (other == n - 1 and i and cores[i - 1])]
            left, own, right = shapes[i - 1] if i else "-", shapes[i], shapes[i + 1] if i + 1 < len(shapes) else "-"
            form = (f"s{own}", f"l{min(len(core), 40)}", f"p{own[:2]}|{left[-3:]}", f"n{own[-2:]}|{right[:3]}", f"c{left}|{own}|{right}", f"k{_check(core)}")
            context = (f"b{word(i - 1)}", f"a{word(i + 1)}", f"2{word(i - 2)}|{word(i - 1)}")
            self.features.append([self._bucket(name) for name in (*form, *context)])

    def _bucket(self, name: str) -> int:
        if name not in self._known:
            self._known[name] = _bucket(name)
        return self._known[name]

    def labels(self, spans: list[list[tuple[int, int, int]]]) -> np.ndarray:
        """For each token, 1 + the kind of the first span (by start, then kind) that it overlaps, else 0."""
        out = np.zeros(len(self.at), np.int64)
        at = np.array(self.at, np.int64).reshape(-1, 3)
        edge = np.searchsorted(at[:, 0], np.arange(len(spans) + 1))
        for d, own in enumerate(spans):
            lo, hi = edge[d], edge[d + 1]
            if own and hi > lo:
                first = _first_overlaps(own, at[lo:hi, 1], at[lo:hi, 2])
                out[lo:hi] = np.where(first >= 0, np.array([k for _, _, k in own])[first] + 1, 0)
        return out


_OTHERS = FORM + CONTEXT
_EXAMPLE = 1 + _OTHERS + 2 + len(KINDS) + 1


def examples(text: str, most: int = SAMPLE_TOKENS) -> np.ndarray:
    """What pseudo-likelihood asks of a text's tokens, a row for each: label, features, labels left and right in the chain (or the number of labels), how many
    tokens of each label it is tied to. Links and labels are those of the whole text; of more than ``most`` tokens as many come, at even steps."""
    graph, k = Graph([text]), len(KINDS) + 1
    n = len(graph.at)
    out = np.full((n, _EXAMPLE), k, np.int32)
    if not n:
        return out
    y = graph.labels([base_spans(text)])
    out[:, 0], out[:, 1 : 1 + _OTHERS] = y, graph.features
    chain, skip = (np.array(links, np.int64).reshape(-1, 2) for links in (graph.chain, graph.skip))
    out[chain[:, 1], 1 + _OTHERS] = y[chain[:, 0]]
    out[chain[:, 0], 2 + _OTHERS] = y[chain[:, 1]]
    agree = np.zeros((n, k), np.int32)
    np.add.at(agree, (skip[:, 0], y[skip[:, 1]]), 1)
    np.add.at(agree, (skip[:, 1], y[skip[:, 0]]), 1)
    out[:, 3 + _OTHERS :] = agree
    return out if n <= most else out[(np.arange(most) * 2 + 1) * n // (2 * most)]


def fit(texts: list[str], rounds: int = 600) -> dict[str, np.ndarray]:
    return fit_examples(np.concatenate([np.zeros((0, _EXAMPLE), np.int32), *(examples(t) for t in texts)]), rounds)


def fit_examples(rows: np.ndarray, rounds: int = 600) -> dict[str, np.ndarray]:
    """Weights by pseudo-likelihood: a token's label given its features (all of them, and its context alone) and its linked tokens' labels."""
    k = len(KINDS) + 1
    w = {"node": np.zeros((BUCKETS + 1, k)), "pair": np.zeros((k, k)), "skip": np.zeros(1)}
    if not len(rows):
        w["node"][:BUCKETS, 0] = 1.0
        return w
    y, whole, left, right = rows[:, 0], rows[:, 1 : 1 + _OTHERS], rows[:, 1 + _OTHERS], rows[:, 2 + _OTHERS]
    hidden = whole.copy()
    hidden[:, :FORM] = BUCKETS
    x, n = np.concatenate([whole, hidden]), len(y)
    agree = rows[:, 3 + _OTHERS :].astype(np.float64)
    agree, hot = np.concatenate([agree, agree]), np.eye(k)[np.concatenate([y, y])]
    sums = {name: np.zeros_like(v) for name, v in w.items()}
    for _ in range(rounds):
        score = agree * w["skip"]
        for column in x.T:
            score += w["node"][column]
        # a token without a neighbour takes the row of zeros
        beside = np.concatenate([w["pair"], np.zeros((1, k))])[left] + np.concatenate([w["pair"].T, np.zeros((1, k))])[right]
        score += np.concatenate([beside, beside])
        p = np.exp(score - score.max(1, keepdims=True))
        g = (hot - p / p.sum(1, keepdims=True)) / n
        node = np.zeros_like(w["node"])
        for column in x.T:
            node += np.stack([np.bincount(column, g[:, j], BUCKETS + 1) for j in range(k)], axis=1)
        node[BUCKETS] = 0
        both = g[:n] + g[n:]
        pair, back = (np.stack([np.bincount(side, both[:, j], k + 1)[:k] for j in range(k)], axis=1) for side in (left, right))
        grads = {"node": node, "pair": pair + back.T, "skip": np.array([(g * agree).sum()])}
        for name, grad in grads.items():
            grad = grad - 1e-5 * w[name]
            sums[name] += grad * grad
            w[name] += 0.5 * grad / np.sqrt(sums[name] + 1e-12)
    w["skip"] = np.maximum(w["skip"], 0.0)
    return w


def marginals(graph: Graph, w: dict[str, np.ndarray], observed: np.ndarray | None = None, skips: bool = True) -> np.ndarray:
    """Label probabilities of every token by loopy sum-product message passing; exact where the links form no loop.

    ``observed``: for each token its given label, or 0. ``skips``: whether distant mentions are linked.
    """
    k = len(KINDS) + 1
    node = np.zeros((len(graph.at), k))
    for column in np.array(graph.features).T:
        node += w["node"][column]
    if observed is not None:
        given = np.flatnonzero(observed)
        node[given, observed[given]] += _OBSERVED
    edges = np.array(graph.chain + (graph.skip if skips else []), np.int64).reshape(-1, 2)
    of_skip = np.arange(len(edges)) >= len(graph.chain)
    potentials = np.where(of_skip[:, None, None], np.eye(k) * w["skip"], w["pair"])
    both = np.concatenate([potentials, potentials.transpose(0, 2, 1)])
    src = np.concatenate([edges[:, 0], edges[:, 1]])
    dst = np.concatenate([edges[:, 1], edges[:, 0]])
    back = np.r_[len(edges) : 2 * len(edges), 0 : len(edges)]
    message = np.zeros((2 * len(edges), k))
    doc = np.array([d for d, _, _ in graph.at], np.int64)[src] if len(edges) else src
    live = np.arange(2 * len(edges))  # messages of documents that have not settled yet

    def beliefs() -> np.ndarray:
        return node + np.stack([np.bincount(dst, message[:, j], len(node)) for j in range(k)], axis=1)

    for _ in range(ROUNDS):
        if not len(live):
            break
        out = (beliefs()[src[live]] - message[back[live]])[:, :, None] + both[live]
        top = out.max(1)
        new = top + np.log(np.exp(out - top[:, None, :]).sum(1))
        new -= new.max(1, keepdims=True)
        moved = np.abs(new - message[live]).max(1) > TOLERANCE
        message[live] = DAMPING * message[live] + (1 - DAMPING) * new
        # a document stops by itself, so its result does not depend on what else is in the batch
        live = live[np.isin(doc[live], doc[live[moved]])]
    belief = beliefs()
    p = np.exp(belief - belief.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def added_spans(texts: list[str], base: list[list[tuple[int, int, int]]], w: dict[str, np.ndarray], skips: bool = True) -> list[list[tuple[int, int, int]]]:
    """Spans of the field's labels, beside those of the patterns."""
    graph, out = Graph(texts), [[] for _ in texts]
    if not graph.at:
        return out
    p = marginals(graph, w, graph.labels(base), skips)
    label = np.where(p.max(1) >= MARGIN, p.argmax(1), 0)
    tied = {b: a for a, b in graph.chain}
    runs: dict[int, list[int]] = {}
    head: dict[int, int] = {}
    for i in np.flatnonzero(label).tolist():
        a = tied.get(i)
        head[i] = head[a] if a in head and label[a] == label[i] and label[i] in (3, 4) else i
        runs.setdefault(head[i], []).append(i)
    for first, members in runs.items():
        d, start, _ = graph.at[first]
        end = graph.at[members[-1]][2]
        kind, digits = int(label[first]) - 1, _NOT_DIGIT.sub("", texts[d][start:end])
        if kind == 2 and 14 <= len(digits) <= 19 and not luhn(digits):
            continue  # of a card's length without its check digit: no card, as for the pattern
        out[d].append((start, end, kind))
    for d, found in enumerate(out):
        if found and base[d]:
            starts, ends = (np.array([span[i] for span in found], np.int64) for i in (0, 1))
            out[d] = [span for span, other in zip(found, _first_overlaps(base[d], starts, ends).tolist(), strict=True) if other < 0]
    return out


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in spans)


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span replaced by ``<KIND>``; overlapping spans become one, named for the first."""
    out, at = [], 0
    for s, e, k in sorted(spans, key=by_place):
        if s >= at:
            out += [text[at:s], f"<{KINDS[k].upper()}>"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def sample_examples(docs: DataFrame, text_col: str = "text", rows: int = SAMPLE_ROWS) -> np.ndarray:
    """The :func:`examples` of at most ``rows`` distinct texts that hold a digit or an ``@``, of any length: those of the smallest hashes, so alike in any partitioning.

    Texts stay on the executors, which send numbers of a bounded size.
    """
    text = F.col(text_col)
    able = docs.select(text.alias("t"), F.xxhash64(text, F.lit(1)).alias("h")).where(text.rlike("[0-9@]"))
    picked = F.broadcast(able.select("h").distinct().orderBy("h").limit(rows))  # so many rows at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for h, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array([h]), pa.array([examples(t.as_py()).ravel()], pa.list_(pa.int32()))], ["h", "rows"])

    got = able.join(picked, "h").groupBy("h").agg(F.min("t").alias("t")).mapInArrow(run, "h long, rows array<int>").orderBy("h").toArrow()
    return np.concatenate([np.zeros((0, _EXAMPLE), np.int32), *(x.values.to_numpy().reshape(-1, _EXAMPLE) for x in got["rows"])])


def find_pii(docs: DataFrame, text_col: str = "text", weights: dict[str, np.ndarray] | None = None, redact: bool = False) -> DataFrame:
    """All of ``docs``' columns with ``base`` and ``spans``: arrays of (kind, start, end) in code points, end exclusive.

    ``base`` holds the patterns' spans, ``spans`` these and the field's, both by start, then kind. With ``redact``
    the text column is replaced as by :func:`redacted`. A null text is treated as empty (and stays null when redacted). Rows
    are handled one by one, so repeated rows and null ids come back as they are; an empty table gives no rows. Columns of
    ``docs`` named base or spans are replaced.
    """
    docs = docs.drop("base", "spans")
    weights = fit_examples(sample_examples(docs, text_col)) if weights is None else weights
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    place = docs.columns.index(text_col)
    span_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def structs(all_spans: list) -> pa.Array:
        return pa.array([[{"kind": KINDS[k], "start": s, "end": e} for s, e, k in spans] for spans in all_spans], span_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for whole in batches:
            for lo in range(0, whole.num_rows, 1000):
                batch = whole.slice(lo, 1000)
                nulls = [not t.is_valid for t in batch.column(place)]
                texts = [t or "" for t in batch.column(place).to_pylist()]
                base = [base_spans(t) for t in texts]
                every = [sorted(b + more, key=by_place) for b, more in zip(base, added_spans(texts, base, w), strict=True)]
                columns = list(batch.columns)
                if redact:
                    clean = [None if n else redacted(t, s) for t, s, n in zip(texts, every, nulls, strict=True)]
                    columns[place] = pa.array(clean, batch.schema.field(place).type)
                yield pa.RecordBatch.from_arrays([*columns, structs(base), structs(every)], [*batch.schema.names, "base", "spans"])

    kind = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("base", kind), T.StructField("spans", kind)]))


def digest(spans: str) -> Column:
    """The text of ``kind:start:end`` of an array of spans, comma-joined."""
    return F.array_join(F.transform(F.col(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count(kind: str, spans: str = "base") -> Column:
    return F.size(F.filter(F.col(spans), lambda s: s["kind"] == kind)).cast("long")
