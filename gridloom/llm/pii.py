"""Personal data in texts: exact patterns, and a skip-chain conditional random field that makes labels consistent.

Patterns give the base spans of four kinds. The field's nodes are the tokens that could belong to personal data (they
hold a digit or '@'); neighbouring tokens share chain potentials, and tokens that repeat or resemble each other
anywhere in the same document share skip potentials (two with each other, more of them with a hub that stands for what
they name: k links for k repeats, any two of them two steps apart). A hub has the label of the base spans among its tokens, if
these agree. Loopy message passing, until the messages of a document settle, spreads the labels of the base spans, which stay
fixed, to tokens that no pattern takes by itself, such as a telephone number repeated without its '+'. All documents of a slice
are passed at once as one graph.

The field is trained piecewise over all documents, whose labels are the base spans: node weights by multinomial
logistic regression, chain and skip potentials from how often labels meet. A token without a base span that is like one
with a base span is what the field has to find, so it is no example of anything there. All features are yes or no, so
what training needs are counts of (features, label) and of pairs of labels: each task sends those, and no text.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textops

KINDS = ("email", "ip", "card", "phone")
#: Pairs of like tokens of each label that training takes as seen before it counts: a corpus may hold no repeats to learn from.
SAME = 50
#: Messages have settled when none of the document's moves by more in a round.
SETTLED = 1e-3
#: Rounds that a document may take besides two for each of its nodes, of which no path has more.
SPARE_ROUNDS = 64

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_KEY = re.compile("[0-9@]")
_SPACE = re.compile(r"[\x20\x09-\x0D]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_DIGIT = re.compile(r"[0-9]")
_LETTER = re.compile(r"[^\W\d_]")
_MARK = re.compile("[\"'=:/]")

Span = tuple[int, int, int]


def _nodes(text: str) -> Iterator[tuple[int, int]]:
    """Words that hold a digit or '@', found from those outwards: linear in the text."""
    end, hit = 0, _KEY.search(text)
    while hit:
        start = hit.start()
        while start > end and not _SPACE.match(text, start - 1):
            start -= 1
        space = _SPACE.search(text, hit.end())
        end = space.start() if space else len(text)
        yield start, end
        hit = _KEY.search(text, end)


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, '@' and dotted domain, found from each '@' outwards: linear in the text."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        else:
            done = at + 1
        at = text.find("@", max(done, at + 1))


def base_spans(text: str | None) -> list[Span]:
    """(kind, start, end) in code points, by kind and start; the end is exclusive. Null and empty: none."""
    out: list[Span] = []
    if not text:
        return out
    if "@" in text:
        out += [(0, a, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m.group().split(".")):
                out.append((1, m.start(), m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16:
                digits = m.group().replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and luhn(digits):
                    out.append((2, m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 8 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                    out.append((3, m.start(), m.end()))
    return out


FEATURES = 22


def _features(token: str, before: str) -> int:
    """The yes-or-no features of a token and the one right before it, as bits."""
    digits = _NOT_DIGIT.sub("", token)
    n, letters = len(digits), len(_LETTER.findall(token))
    dots, first = token.count("."), token[0]
    f = 1 | (n > 0 and not letters) << 4 | (letters > 0) << 5 | 1 << 8 + (0 if n < 4 else 1 if n < 7 else 2 if n < 10 else 3 if n < 16 else 4 if n < 20 else 5) | (n == 0) << 21
    if "@" in token:
        f |= 2 | ("." in token.partition("@")[2].rstrip(".")) << 2 | (first == "@") << 3
    if dots == 3 and not letters:
        f |= 1 << 6 | all(p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in re.sub("[^0-9.]", "", token).split(".")) << 7
    if 16 <= n <= 19:
        f |= luhn(digits) << 14
    f |= ("(" in token and ")" in token) << 15 | ("-" in token) << 16 | (first == "+") << 17
    if before:
        f |= (before[0] == "+") << 18 | (")" in before) << 19
    return f | (_MARK.search(token) is not None) << 20


def _likeness(token: str) -> str:
    """What similar tokens have in common: a mail address without trimmings, else all digits, of a number the last seven."""
    if "@" in token:
        return token.lower().strip(".,;:!?()[]<>\"'#*$%&")
    digits = _NOT_DIGIT.sub("", token)
    if token.count(".") >= 3:
        return "d" + re.sub("[^0-9.]", "", token).strip(".")
    return digits[-7:] if len(digits) >= 7 else ""


_PLACE = 1 << np.arange(FEATURES, dtype=np.int64)


@dataclass
class Graph:
    #: Features of each node as bits.
    bits: np.ndarray
    fixed: np.ndarray
    chain: np.ndarray
    skip: np.ndarray
    place: list[tuple[int, int, int]]
    #: Nodes without a label that are like one with a label.
    unsure: np.ndarray
    #: Skip links that messages take: the hubs are numbered after the nodes.
    links: np.ndarray
    #: A hub's label, as in ``fixed``, and its document.
    hubs: np.ndarray
    hub_rows: np.ndarray

    @property
    def features(self) -> np.ndarray:
        return ((self.bits[:, None] & _PLACE) > 0).astype(np.float64)


def graph(texts: list[str], spans: list[list[Span]]) -> Graph:
    """Nodes of several documents and their links; ``fixed`` is a node's label (0: none, 1 + kind) or -1."""
    features, fixed, chain, skip, place, groups = [], [], [], [], [], []
    for row, (text, found) in enumerate(zip(texts, spans, strict=True)):
        by_start = sorted((a, b, k) for k, a, b in found)
        alike: dict[str, list[int]] = {}
        k, before, before_end, before_node = 0, "", -9, -1
        for a, b in _nodes(text):
            while k < len(by_start) and by_start[k][1] <= a:
                k += 1
            node = len(fixed)
            token = text[a:b]
            label = 1 + by_start[k][2] if k < len(by_start) and by_start[k][0] < b else -1
            features.append(_features(token, before if a - before_end <= 1 else ""))
            fixed.append(label)
            place.append((row, a, b))
            if a - before_end <= 1:
                chain.append((before_node, node))
            if like := _likeness(token):
                own = alike.setdefault(like, [])
                if own:
                    skip.append((own[-1], node))
                own.append(node)
            before, before_end, before_node = token, b, node
        groups += [(row, own) for own in alike.values() if len(own) > 1]
    links, hubs, hub_rows = [], [], []
    unsure = np.zeros(len(fixed), bool)
    for row, own in groups:
        if any(fixed[k] >= 0 for k in own):
            unsure[[k for k in own if fixed[k] < 0]] = True
        if len(own) == 2:
            links.append((own[0], own[1]))
            continue
        known = {fixed[k] for k in own if fixed[k] >= 0}
        links += [(k, len(fixed) + len(hubs)) for k in own]
        hubs.append(known.pop() if len(known) == 1 else -1)
        hub_rows.append(row)
    pairs = lambda x: np.array(x, np.int64).reshape(-1, 2)
    bits = np.array(features, np.int64)
    return Graph(bits, np.array(fixed, np.int64), pairs(chain), pairs(skip), place, unsure, pairs(links), np.array(hubs, np.int64), np.array(hub_rows, np.int64))


@dataclass
class Field:
    node: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    def beliefs(self, g: Graph) -> np.ndarray:
        """Posterior of each node's label by sum-product in log space; each document's messages go on until they settle."""
        labels = LABELS
        nodes = len(g.fixed)
        fixed = np.concatenate((g.fixed, g.hubs))
        local = np.concatenate((g.features @ self.node, np.zeros((len(g.hubs), labels))))
        held = fixed >= 0
        local[held] = -1e9  # more than any number of messages can outweigh
        local[held, fixed[held]] = 0.0
        edges = np.concatenate((g.chain, g.links))
        if len(edges):
            table = np.concatenate((np.repeat(self.chain[None], len(g.chain), 0), np.repeat(self.skip[None], len(g.links), 0)))
            source = np.concatenate((edges[:, 0], edges[:, 1]))
            target = np.concatenate((edges[:, 1], edges[:, 0]))
            table = np.concatenate((table, table.transpose(0, 2, 1)))
            back = np.concatenate((np.arange(len(edges)) + len(edges), np.arange(len(edges))))
            message = np.zeros((len(source), labels))
            row = np.concatenate((np.array([r for r, _, _ in g.place], np.int64), g.hub_rows))
            most = SPARE_ROUNDS + 2 * np.bincount(row)
            row = row[source]
            live, turn = np.arange(len(source)), 0
            while len(live):
                turn += 1
                total = local.copy()
                np.add.at(total, target[live], message[live])
                out = (total[source[live]] - message[back[live]])[:, :, None] + table[live]
                top = out.max(1)
                new = top + np.log(np.exp(out - top[:, None, :]).sum(1))
                new -= new.max(1, keepdims=True)
                new = 0.5 * message[live] + 0.5 * new
                moved = np.zeros(len(most))
                np.maximum.at(moved, row[live], np.abs(new - message[live]).max(1))
                message[live] = new
                live = live[((moved > SETTLED) & (turn < most))[row[live]]]
            np.add.at(local, target, message)
        local = local[:nodes]
        local -= local.max(1, keepdims=True)
        p = np.exp(local)
        return p / p.sum(1, keepdims=True)


LABELS = len(KINDS) + 1


def evidence(texts: list[str]) -> Counter[tuple[int, int, int]]:
    """Counts of what training needs: (0, features as bits, label) of nodes, (1, label, label) of neighbours, (2, label, label) of like tokens."""
    g = graph(texts, [base_spans(t) for t in texts])
    y, sure = np.maximum(g.fixed, 0), ~g.unsure
    out: Counter[tuple[int, int, int]] = Counter()
    for kind, rows in ((0, np.stack((g.bits, y), 1)[sure]), *((k, y[x[sure[x].all(1)]]) for k, x in ((1, g.chain), (2, g.skip)))):
        values, n = np.unique(rows, axis=0, return_counts=True)
        out.update({(kind, int(a), int(b)): int(c) for (a, b), c in zip(values, n, strict=True)})
    return out


def fit(counts: dict[tuple[int, int, int], int]) -> Field:
    """Piecewise training from ``evidence``. Without any node: a field that labels nothing."""
    nodes = sorted((a, b, n) for (kind, a, b), n in counts.items() if kind == 0)
    node = np.zeros((FEATURES, LABELS))
    if nodes:
        bits, y, n = np.array(nodes, np.int64).T
        x, share = ((bits[:, None] & _PLACE) > 0).astype(np.float64), n / n.sum()
        goal = np.eye(LABELS)[y] * share[:, None]
        for step in range(400):
            z = x @ node
            z -= z.max(1, keepdims=True)
            p = np.exp(z)
            p *= (share / p.sum(1))[:, None]
            node -= (2.0 / (1 + step / 100)) * (x.T @ (p - goal) + 1e-3 * node)
    else:
        node[0, 0] = 5.0

    def potential(kind: int, prior: np.ndarray) -> np.ndarray:
        m = prior.copy()
        for (of, a, b), k in counts.items():
            if of == kind:
                m[a, b] += k
        m = m + m.T
        share = m.sum(1) / m.sum()
        return np.log(m / m.sum()) - np.log(share)[:, None] - np.log(share)[None]

    return Field(node, potential(1, np.full((LABELS, LABELS), 1.0)), potential(2, np.full((LABELS, LABELS), 0.1) + SAME * np.eye(LABELS)))


def train(texts: list[str]) -> Field:
    """The field of a few texts."""
    return fit(evidence(texts))


def train_on(documents: DataFrame, text_column: str = "text") -> Field:
    """The field of all documents: one pass, of which each task sends counts alone (some thousands at most)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[tuple[int, int, int]] = Counter()
        for part in textops.slices(batches):
            counts.update(evidence([t for t in part.column(0).to_pylist() if t]))
        kind, a, b = (pa.array([k[i] for k in counts], pa.int64()) for i in range(3))
        yield pa.RecordBatch.from_arrays([kind, a, b, pa.array(counts.values(), pa.int64())], ["kind", "a", "b", "n"])

    got = documents.select(F.col(text_column).alias("text")).mapInArrow(rows, "kind long, a long, b long, n long")
    return fit({(r["kind"], r["a"], r["b"]): r["n"] for r in got.groupBy("kind", "a", "b").agg(F.sum("n").alias("n")).collect()})


def added_spans(texts: list[str], spans: list[list[Span]], field: Field, confidence: float = 0.5) -> list[list[Span]]:
    """Spans of tokens that no pattern takes but whose posterior of a kind exceeds ``confidence``; adjacent ones of a kind join."""
    out: list[list[Span]] = [[] for _ in texts]
    g = graph(texts, spans)
    if not (g.fixed < 0).any():
        return out
    p = field.beliefs(g)
    best = p.argmax(1)
    for k in np.flatnonzero((g.fixed < 0) & (best > 0) & (p[np.arange(len(best)), best] > confidence)):
        row, a, b = g.place[k]
        text, kind = texts[row], int(best[k]) - 1
        while a < b and not (text[a].isalnum() or text[a] in "+("):
            a += 1
        while b > a and not (text[b - 1].isalnum() or text[b - 1] == ")"):
            b -= 1
        if a == b:
            continue
        own = out[row]
        if own and own[-1][0] == kind and a - own[-1][2] <= 1:
            own[-1] = (kind, own[-1][1], b)
        else:
            own.append((kind, a, b))
    # what is too short to name anybody stays
    enough = lambda text, a, b: "@" in text[a:b] or sum(c.isdigit() for c in text[a:b]) >= 7
    return [[s for s in own if enough(text, s[1], s[2])] for text, own in zip(texts, out, strict=True)]


def _written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def _analysed(batches: Iterator[pa.RecordBatch], field: Field):
    for part in textops.slices(batches):
        texts = [t or "" for t in part.column(part.schema.get_field_index("text")).to_pylist()]
        base = [base_spans(t) for t in texts]
        yield part, texts, base, added_spans(texts, base, field)


def find(documents: DataFrame, field: Field, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Counts and spans of each row's whole text; one pass without a shuffle.

    Null and empty texts have no spans; repeated rows repeat; a null id stays null; other columns are ignored.
    """
    held = documents.sparkSession.sparkContext.broadcast(field)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, base, added in _analysed(batches, held.value):
            n = [[sum(s[0] == k for s in b) for b in base] for k in range(len(KINDS))]
            sha = [hashlib.sha256(_written(b).encode()).hexdigest() for b in base]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(x, pa.int64()) for x in n), pa.array(sha), pa.array([_written(b + m) for b, m in zip(base, added, strict=True)], pa.string()), pa.array([len(m) for m in added], pa.int64())],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"],
            )

    return documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")).mapInArrow(rows, SCHEMA)


def masked_text(text: str, spans: list[Span]) -> str:
    """The text with each span, or run of overlapping spans, replaced by its kind in brackets."""
    out, at = [], 0
    for a, b, k in sorted((a, b, k) for k, a, b in spans):
        if a >= at:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def mask(documents: DataFrame, field: Field) -> DataFrame:
    """``documents`` with personal data in ``text`` masked and ``n_chars`` counted anew; null texts stay null."""
    held = documents.sparkSession.sparkContext.broadcast(field)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts, base, added in _analysed(batches, held.value):
            at = part.schema.get_field_index("text")
            null = part.column(at).is_null().to_pylist()
            new = [None if no else masked_text(t, b + m) if b or m else t for t, b, m, no in zip(texts, base, added, null, strict=True)]
            part = part.set_column(at, part.schema.field(at), pa.array(new, part.schema.field(at).type))
            if (n := part.schema.get_field_index("n_chars")) >= 0:
                old = part.column(n).to_pylist()
                part = part.set_column(n, part.schema.field(n), pa.array([o if x is None else len(x) for o, x in zip(old, new, strict=True)], part.schema.field(n).type))
            yield part

    return documents.mapInArrow(rows, documents.schema)


def find_all(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """Trains the field on all rows and applies it to every row."""
    return find(documents, train_on(documents))
