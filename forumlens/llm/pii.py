"""Personal data: fixed patterns, and a skip-chain conditional random field that adds consistent mentions."""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens.llm.common import slices

KINDS = ("email", "ip", "card", "phone")
#: Label 0 is no entity; label k is KINDS[k - 1].
N_LABELS = 1 + len(KINDS)
#: Belief from which a token that no pattern matched is added.
MIN_BELIEF = 0.5
#: Agreeing skip edges assumed before any is seen.
PRIOR = 1000
#: Mailbox names of RFC 2142, which name a service and no person, and others like them.
ROLES = {
    "info", "marketing", "sales", "support", "abuse", "noc", "security", "postmaster", "hostmaster", "usenet", "news",
    "webmaster", "www", "uucp", "ftp", "admin", "contact", "hello", "help", "mail", "noreply", "office", "service", "team",
}
#: Message passing ends when no belief changes by more; from round CALM on messages are averaged with their last values,
#: which ends the swings that loops can cause.
TOLERANCE = 1e-4
CALM = 20
MAX_ROUNDS = 200
#: The least message, well within single precision.
TINY = np.float32(1e-25)

_SOME = re.compile(r"[0-9@]")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_EDGES = ".,;:!?()[]<>\"'"
_ROUND = str.maketrans("", "", "()")

Span = tuple  # start, end, label


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches of local part, @ and dotted domain, in time linear in the text."""
    done = 0
    at = text.find("@")
    while at >= 0:
        found = _DOMAIN.match(text, at)
        if found:
            before = text[done:at]
            local = len(before) - len(before.rstrip(_LOCAL))
            if local:
                yield at - local, found.end(), 1
                done = found.end()
                at = text.find("@", done)
                continue
        done = at + 1
        at = text.find("@", done)


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _matches(text: str) -> Iterator[tuple[int, int, int, bool]]:
    """The matches of the four patterns: start, end, label and whether the digits pass their test."""
    for a, b, label in _emails(text):
        yield a, b, label, True
    for m in _IP.finditer(text):
        yield m.start(), m.end(), 2, all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19:
            yield m.start(), m.end(), 3, _luhn(digits)
    for m in _PHONE.finditer(text):
        yield m.start(), m.end(), 4, 10 <= sum(c.isdigit() for c in m[0]) <= 15


def base_spans(text: str) -> list[Span]:
    """The matches of the four patterns, in the order of start and kind."""
    if not _SOME.search(text):
        return []
    return sorted([(a, b, label) for a, b, label, passed in _matches(text) if passed], key=lambda s: (s[0], s[2]))


def _fails(token: str) -> bool:
    """Whether a token is as long as a card's number and is none."""
    if len(token) < 14:
        return False
    digits = "".join(c for c in token if c in "0123456789")
    return 14 <= len(digits) <= 19 and not _luhn(digits)


def _bucket(n: int, borders: tuple[int, ...]) -> int:
    return sum(n >= b for b in borders)


#: Sizes of the parts of a token's pattern; their product bounds the number of patterns.
PARTS = (2, 8, 5, 2, 2, 2, 2, 2, 2)
_STEPS = np.cumprod([1, *PARTS[:0:-1]])[::-1].tolist()


def _pattern(token: str, rejected: bool) -> int:
    """The number of a token's pattern; `rejected` if it is in a match of a pattern that fails its test."""
    digits = sum(c.isdigit() for c in token)
    parts = (
        int("@" in token),
        _bucket(digits, (1, 2, 4, 6, 8, 10, 14)),
        _bucket(token.strip(_EDGES).count("."), (1, 2, 3, 4)),
        int(token.startswith("+")),
        int("(" in token),
        int("-" in token),
        int(any(c.isalpha() for c in token)),
        int(len(token) > 24),
        int(rejected),
    )
    return sum(p * step for p, step in zip(parts, _STEPS))


def _keys(token: str) -> list[str]:
    """What a token shares with others that mention the same thing: its letters and digits, and an address's local part."""
    core = token.strip(_EDGES).lower()
    keys = []
    plain = "".join(c for c in core if c.isalnum())
    if len(plain) >= 5 and plain not in ROLES:
        keys.append(plain)
    local = core.partition("@")[0]
    if local != core:
        local = "".join(c for c in local if c.isalnum())
        if len(local) >= 5 and local not in ROLES:
            keys.append(local)
    return keys


class Graph:
    """Tokens of one or more texts that can name an entity, and what joins them."""

    def __init__(self) -> None:
        self.owner, self.start, self.end, self.pattern, self.label = (array("q") for _ in range(5))
        #: Whether a node's token follows the token of the node before.
        self.chained = array("b")
        #: Keys of nodes, numbered over all texts.
        self.key, self.bearer = array("q"), array("q")
        self.keys = 0

    def add(self, number: int, text: str, matches: list[tuple[int, int, int, bool]]) -> None:
        """Nodes are tokens with a digit or @, and tokens that repeat the name in an address.

        A token's keys, and at the last token of a match of several tokens all its letters and digits, tell which tokens
        mention the same thing.
        """
        passed = sorted((a, b, label) for a, b, label, good in matches if good)
        # A number that begins like a phone number may run on into another one, so it tells nothing about its parts.
        failed = sorted((a, b) for a, b, label, good in matches if not good and label != 4)
        names = {k for a, b, label in passed if label == 1 for k in _keys(text[a:b])}
        at, bad, before, known = 0, 0, None, {}
        for k, m in enumerate(_TOKEN.finditer(text)):
            token, start, end = m[0], m.start(), m.end()
            if not _SOME.search(token) and not (names and names.intersection(_keys(token))):
                continue
            while at < len(passed) and passed[at][1] <= start:
                at += 1
            while bad < len(failed) and failed[bad][1] <= start:
                bad += 1
            span = next((s for s in passed[at : at + 4] if s[0] < end and s[1] > start), None)
            node = len(self.owner)
            self.owner.append(number)
            self.start.append(start)
            self.end.append(end)
            self.pattern.append(_pattern(token, (bad < len(failed) and failed[bad][0] < end) or _fails(token)))
            self.label.append(span[2] if span else 0)
            self.chained.append(before == k - 1)
            before = k
            keys = _keys(token)
            if span and span[0] < start and span[1] <= end:
                keys.append("".join(c for c in text[span[0] : span[1]].lower() if c.isalnum()))
            for key in dict.fromkeys(keys):
                own = known.setdefault(key, self.keys)
                self.keys += own == self.keys
                self.key.append(own)
                self.bearer.append(node)

    def joined(self) -> Joined:
        """The graph's edges as lines of nodes, for passes along them.

        Chain edges join tokens that follow one another. Skip edges join each bearer of a key with the next one; where the two
        also follow one another, one edge has both potentials. A token that no pattern matched is besides joined with
        the nearest matched bearers of its key, which are evidence, so a key may have any number of mentions.
        """
        n = len(self.owner)
        label, chained = np.array(self.label, dtype=np.int64), np.array(self.chained, dtype=bool)
        order = np.argsort(np.array(self.key, dtype=np.int64), kind="stable")
        key, node = np.array(self.key, dtype=np.int64)[order], np.array(self.bearer, dtype=np.int64)[order]
        place = np.arange(len(node))
        edge = np.zeros(len(node), dtype=bool)
        edge[1:] = key[1:] == key[:-1]
        first = np.maximum.accumulate(np.where(edge, 0, place)) if len(place) else place
        pair = np.full(len(node), -1, dtype=np.int64)
        pair[edge] = node[place[edge] - 1] * n + node[edge]
        follows = edge & chained[node] & (pair == (node - 1) * n + node)
        both = np.zeros(n, dtype=bool)
        both[node[follows]] = True
        # Two keys may join the same two nodes; one edge is enough.
        single = np.zeros(len(node), dtype=bool)
        single[np.unique(pair, return_index=True)[1]] = True
        skip = edge & ~follows & single

        matched = label[node] > 0
        back = np.maximum.accumulate(np.where(matched, place, -1)) if len(place) else place
        ahead = np.minimum.accumulate(np.where(matched, place, len(node))[::-1])[::-1] if len(place) else place
        last = np.searchsorted(first, first, side="right") - 1
        evidence = []
        for near, far in ((back, (back >= first) & (back < place - 1)), (ahead, (ahead <= last) & (ahead > place + 1))):
            held = ~matched & far
            evidence.append(np.stack([node[held], label[node[near[held]]]]))
        held = np.zeros(int(key.max(initial=-1)) + 1, dtype=bool)
        held[key[matched]] = True
        mention = np.zeros(n, dtype=bool)
        mention[node[held[key]]] = True
        return Joined(
            label, np.array(self.pattern, dtype=np.int64), mention & (label == 0),
            Lines.of(np.arange(n), np.where(chained, np.where(both, BOTH, CHAIN), NEW)),
            Lines.of(node, np.where(skip, SKIP, NEW)),
            np.concatenate(evidence, axis=1),
        )


#: Kinds of edges into a place on a line; NEW begins a line.
NEW, CHAIN, SKIP, BOTH = range(4)


@dataclass
class Lines:
    """Places on lines, one after the other: each place's node and the kind of the edge from the place before."""

    node: np.ndarray
    edge: np.ndarray

    @staticmethod
    def of(node: np.ndarray, edge: np.ndarray) -> Lines:
        """Places that no edge touches are left out."""
        touched = edge != NEW
        touched[:-1] |= edge[1:] != NEW
        return Lines(node[touched], edge[touched])

    def pairs(self, label: np.ndarray, kinds: tuple[int, ...]) -> np.ndarray:
        """Labels at both ends of the edges of some kinds."""
        at = np.flatnonzero(np.isin(self.edge, kinds))
        return np.stack([label[self.node[at - 1]], label[self.node[at]]])


@dataclass
class Joined:
    """A graph's nodes and edges as arrays; `mention` marks unmatched nodes that share a key with a matched one."""

    label: np.ndarray
    pattern: np.ndarray
    mention: np.ndarray
    chain: Lines
    skip: Lines
    evidence: np.ndarray


@dataclass(frozen=True)
class Model:
    """Log potentials: of the pattern parts, of neighbours, and the weight of equal labels over a skip edge.

    `seen` are the patterns that training met; others say nothing about a token. None: all are scored.
    """

    parts: np.ndarray
    chain: np.ndarray
    skip: float
    seen: np.ndarray | None = None

    def node_scores(self, patterns: np.ndarray) -> np.ndarray:
        different, place = np.unique(patterns, return_inverse=True)
        parts = np.stack(np.unravel_index(different, PARTS), axis=1)
        scores = self.parts[parts + _OFFSETS].sum(axis=1) + self.parts[-1]
        if self.seen is not None:
            scores[~np.isin(different, self.seen)] = 0
        return scores.astype(np.float32)[place]


_OFFSETS = np.concatenate([[0], np.cumsum(PARTS)[:-1]])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (pattern, label), of neighbouring labels and of labels over skip edges.

    Whether an unmatched mention of a matched thing is an entity is what the field is to find out: such tokens are not
    counted, neither as nodes nor at the ends of edges.
    """
    found: Counter = Counter()
    for batch in slices(batches, "text"):
        for text in batch.column("text").to_pylist():
            if text is None or not _SOME.search(text):
                continue
            graph = Graph()
            graph.add(0, text, list(_matches(text)))
            joined = graph.joined()
            label = np.where(joined.mention, -1, joined.label)
            pairs = [np.stack([joined.pattern, label]), joined.chain.pairs(label, (CHAIN, BOTH))]
            pairs.append(np.concatenate([joined.skip.pairs(label, (SKIP,)), joined.chain.pairs(label, (BOTH,))], axis=1))
            for kind, (a, b) in zip(("node", "chain", "skip"), pairs):
                known = (b >= 0) & (a >= 0)
                codes, n = np.unique(a[known] * N_LABELS + b[known], return_counts=True)
                for code, k in zip(codes.tolist(), n.tolist()):
                    found[kind, code // N_LABELS, code % N_LABELS] += k
    columns = list(zip(*[(*k, n) for k, n in found.items()])) or [[]] * 4
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64()]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["kind", "a", "b", "n"])


def train(docs: DataFrame, l2: float = 1.0, steps: int = 400) -> Model:
    """Potentials from all documents, piece by piece: tokens inside pattern matches are the labelled entities.

    Tasks count patterns and label pairs; at most 25,600 pattern counts and 50 pair counts reach the driver,
    whatever the corpus. Token potentials are a multinomial logistic regression over the parts of a pattern,
    chain potentials the smoothed association of neighbouring labels, and the skip weight the smoothed
    log-odds that two tokens with a common key carry the same label. Matches that fail their test are a part of the pattern of
    their tokens and count as no entity.
    """
    rows = (
        docs.select(F.col("text").cast("string"))
        .mapInArrow(_counts, "kind string, a long, b long, n long")
        .groupBy("kind", "a", "b")
        .agg(F.sum("n").alias("n"))
        .orderBy("kind", "a", "b")
        .collect()
    )
    pairs = {kind: np.zeros((N_LABELS, N_LABELS)) for kind in ("chain", "skip")}
    seen: dict[int, np.ndarray] = {}
    for r in rows:
        if r.kind == "node":
            seen.setdefault(r.a, np.zeros(N_LABELS))[r.b] += r.n
        else:
            pairs[r.kind][r.a, r.b] += r.n
    size = int(sum(PARTS)) + 1
    weights = np.zeros((size, N_LABELS))
    if seen:
        patterns = np.stack(np.unravel_index(np.array(sorted(seen)), PARTS), axis=1)
        counts = np.stack([seen[k] for k in sorted(seen)])
        x = np.zeros((len(patterns), size))
        x[np.arange(len(patterns))[:, None], patterns + _OFFSETS] = 1
        x[:, -1] = 1
        total = counts.sum()
        speed = np.zeros_like(weights)
        for _ in range(steps):
            score = x @ weights
            p = np.exp(score - score.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            gradient = x.T @ (p * counts.sum(axis=1, keepdims=True) - counts) / total + l2 / max(total, 1) * weights
            speed = 0.9 * speed - gradient
            weights = weights + speed
    chain = pairs["chain"] + pairs["chain"].T + 1
    share = chain.sum(axis=1) / chain.sum()
    potentials = np.clip(np.log(chain / chain.sum() / np.outer(share, share)), -3, 3)
    same = np.trace(pairs["skip"])
    skip = float(np.clip(np.log((same + PRIOR) / (pairs["skip"].sum() - same + 1)), 0, 8))
    return Model(weights, potentials, skip, np.array(sorted(seen), dtype=np.int64))


def _pass(lines: Lines, here: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """Messages along all lines: into each place, from the places before it on its line.

    `here` is what each place's node believes without its line. The places are cut into blocks of the root of their
    number. All blocks step at once: first to what a block makes of any message that comes in, then, once
    these are put together, to the messages themselves. The edges that begin lines pass nothing on.
    """
    n = len(lines.node)
    width = max(1, int(np.sqrt(n)))
    blocks = -(-n // width)
    rows = np.ones((blocks * width, N_LABELS), dtype=np.float32)
    rows[:n] = here
    edges = np.zeros(blocks * width + 1, dtype=np.int8)
    edges[:n] = lines.edge
    rows, into = rows.reshape(blocks, width, N_LABELS), edges[:-1].reshape(blocks, width)
    out_of = edges[1:].reshape(blocks, width)
    through = np.broadcast_to(np.eye(N_LABELS, dtype=np.float32), (blocks, N_LABELS, N_LABELS))
    for k in range(width):
        through = (through * rows[:, k, None, :]) @ tables[out_of[:, k]]
        through = through / through.sum(axis=(1, 2), keepdims=True)
    start = np.full((blocks, N_LABELS), 1 / N_LABELS, dtype=np.float32)
    for k in range(1, blocks):
        step = start[k - 1] @ through[k - 1]
        start[k] = step / step.sum()
    out = np.empty((blocks, width, N_LABELS), dtype=np.float32)
    now = np.where(into[:, :1] == NEW, np.float32(1 / N_LABELS), start)
    for k in range(width):
        out[:, k] = now
        now = ((now * rows[:, k])[:, None, :] @ tables[out_of[:, k]])[:, 0]
        now = now / now.sum(axis=1, keepdims=True)
    return out.reshape(-1, N_LABELS)[:n]


def beliefs(graph: Joined, model: Model) -> np.ndarray:
    """Marginal label probabilities by sum-product message passing; matched tokens are evidence.

    A round is a pass forward and backward along the chains of tokens, then along the lines of equal keys; a pass is exact on
    its lines, however long. Rounds go on until no belief changes by TOLERANCE. Without loops the result is exact.
    """
    n = len(graph.label)
    scores = model.node_scores(graph.pattern)
    held = np.flatnonzero(graph.label)
    scores[held] = -30
    scores[held, graph.label[held]] = 0
    np.add.at(scores, (graph.evidence[0], graph.evidence[1]), np.float32(model.skip))
    scores -= scores.max(axis=1, keepdims=True)
    agree = model.skip * np.eye(N_LABELS)
    tables = np.exp(np.stack([np.zeros_like(agree), model.chain, agree, model.chain + agree]))
    tables = (tables / tables.max(axis=(1, 2), keepdims=True)).astype(np.float32)

    def normal(logs: np.ndarray) -> np.ndarray:
        out = np.exp(logs - logs.max(axis=1, keepdims=True))
        return out / out.sum(axis=1, keepdims=True)

    sets = [lines for lines in (graph.chain, graph.skip) if len(lines.node)]
    logs = [np.zeros((len(lines.node), N_LABELS), dtype=np.float32) for lines in sets]
    total, belief = scores, normal(scores)
    for round_ in range(MAX_ROUNDS if sets else 0):
        for k, lines in enumerate(sets):
            here = np.maximum(normal(total[lines.node] - logs[k]), TINY)
            back = Lines(lines.node[::-1], np.append(lines.edge[1:], NEW)[::-1])
            both = np.log(np.maximum(_pass(lines, here, tables), TINY))
            both += np.log(np.maximum(_pass(back, here[::-1], tables.transpose(0, 2, 1))[::-1], TINY))
            logs[k] = both if round_ < CALM else (logs[k] + both) / 2
            total = scores.copy()
            for own, messages in zip(sets, logs):
                np.add.at(total, own.node, messages)
        before, belief = belief, normal(total)
        # One set of lines is without loops, and its passes are exact at once.
        if len(sets) == 1 and len(np.unique(sets[0].node)) == len(sets[0].node) or n and np.abs(belief - before).max() < TOLERANCE:
            break
    return belief


def spans(texts: list[str], model: Model) -> list[list[tuple[int, int, int, bool]]]:
    """(start, end, label, added) of each text, in the order of start and kind."""
    out: list[list] = []
    graph = Graph()
    for number, text in enumerate(texts):
        matches = list(_matches(text)) if _SOME.search(text) else []
        base = sorted([(a, b, label) for a, b, label, passed in matches if passed], key=lambda s: (s[0], s[2]))
        out.append([(a, b, label, False) for a, b, label in base])
        if _SOME.search(text):
            graph.add(number, text, matches)
    if graph.owner:
        joined = graph.joined()
        belief = beliefs(joined, model)
        best = belief.argmax(axis=1)
        mine = np.flatnonzero((best > 0) & (belief.max(axis=1) >= MIN_BELIEF) & (joined.label == 0))
        last = None
        for k in mine.tolist():
            owner, label, text = graph.owner[k], int(best[k]), texts[graph.owner[k]]
            token = text[graph.start[k] : graph.end[k]]
            marks = _EDGES.translate(_ROUND) if label == 4 else _EDGES
            start = graph.start[k] + len(token) - len(token.lstrip(marks))
            end = graph.end[k] - (len(token) - len(token.rstrip(marks)))
            if start >= end:
                continue
            # Cards and phone numbers may have several tokens; addresses have one.
            if last and last[0] == owner and last[2] == label > 2 and not text[last[1] : graph.start[k]].strip(_EDGES + " "):
                a = out[owner].pop()
                start = a[0]
            out[owner].append((start, end, label, True))
            last = (owner, end, label)
        for own in out:
            own.sort(key=lambda s: (s[0], s[2], s[1]))
    return out


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("added", pa.bool_())]))


def find_personal_data(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and spans (kind, start, end, added) of every document, in code points, end exclusive.

    Null texts count as empty and have no spans; a null doc_id stays null; rows that repeat are searched each
    for itself; other columns are ignored; an empty table gives an empty result. Pattern matches always stay;
    tokens no pattern matched are added when the field believes in one kind with a half or more.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = spans(["" if t is None else t for t in batch.column("text").to_pylist()], model)
            rows = [
                [{"kind": KINDS[label - 1], "start": a, "end": b, "added": added} for a, b, label, added in own]
                for own in found
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, _SPANS)], names=["doc_id", "spans"])

    schema = "doc_id long, spans array<struct<kind:string,start:long,end:long,added:boolean>>"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def redact(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with every span replaced by its kind in angle brackets; n_chars, if there, follows the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            new = []
            for text, own in zip(texts, spans(["" if t is None else t for t in texts], model)):
                parts, done = [], 0
                for a, b, label, _ in own:
                    if b > done:
                        parts += [text[done : max(a, done)], f"<{KINDS[label - 1].upper()}>"]
                        done = b
                new.append(None if text is None else "".join(parts) + text[done:])
            at = batch.schema.get_field_index("text")
            batch = batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))
            n = batch.schema.get_field_index("n_chars")
            if n >= 0:
                sizes = pa.array([None if t is None else len(t) for t in new], batch.schema.field(n).type)
                batch = batch.set_column(n, batch.schema.field(n), sizes)
            yield batch

    return docs.mapInArrow(run, docs.schema)


def _joined(spans_of: Column) -> Column:
    text = F.transform(
        spans_of, lambda s: F.concat(s["kind"], F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))
    )
    return F.array_join(text, ",")


def digests(found: DataFrame) -> DataFrame:
    """Counts of pattern matches by kind, the digest of their places, and all places as text."""
    base = F.filter("spans", lambda s: ~s["added"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [
        (F.size(base) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in KINDS
    ]
    return found.select(
        "doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans")
    )
