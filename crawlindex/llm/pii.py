"""Personal data by patterns and a skip-chain conditional random field.

Patterns give base spans, which stay. The field adds spans to them. Its
variables are candidate tokens: numbers and address-like words the patterns
leave out, and the base spans, whose labels are known. Neighbours in the text
and repeated or similar tokens, however distant, share potentials, so that a
number once written as a phone number is one wherever it comes again. Loopy
message passing gives each candidate its label. Base spans are observed, and
each candidate is linked to those similar to it themselves, so that no number
of repeats outvotes them.

The local, chain and skip potentials are log ratios of counts on a bounded
sample of documents (piecewise training). Base spans are the labels; the other
candidates count with the probabilities that the field of the round before gives
them (expectation maximisation). So a way of writing numbers that often repeats
known phone numbers becomes one of phone numbers itself.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import new_folder, removed, stored
from .shipping import ship

KINDS = ("email", "ip", "card", "phone")
LABELS = (*KINDS, "other")
OTHER = len(KINDS)
SAMPLE_DOCS = 5_000  # documents the potentials are fitted on, about
SAME_DIGITS = 7  # numbers with so many equal digits, at least, are similar
ROUNDS = 50  # of messages, after which steps get smaller until they converge
CONVERGED = 1e-4
PRIOR = 1.0  # count of each label assumed in advance
PRIOR_OTHER = 10.0  # the same of other than personal data, for each shape
PASSES = 3  # over the sample; in the first, candidates without a label are other
AGREE = 5.0  # log odds that similar tokens have one label, before any is counted
MOST_AGREE = 8.0
MOST_CHAIN = 0.5  # neighbours in the text tell little
_LITTLE = 1e-3  # probabilities that count for nothing
_DIGITS = 6

# The base patterns.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A run of digits that fails at its start fails at every later digit too.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_DIGIT = re.compile("[0-9]")
_NOT_DIGIT = re.compile("[^0-9]")
# Numbers with any separators, and addresses that spell out their signs.
_NUMBER = re.compile(r"[+(]?[0-9](?:[ ().\-/_:]{0,2}[0-9])*+")
_SPELLED = re.compile(
    r"[A-Za-z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]|\(@\)|\[@\]) ?[A-Za-z0-9-]{1,64}"
    r"(?:(?:\.| ?(?:\(dot\)|\[dot\]) ?)[A-Za-z0-9-]{1,64}){1,8}",
    re.I,
)
_WORD = re.compile(r"[A-Za-z0-9._%+-]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the patterns, by kind and start."""
    spans = [(0, a, b) for a, b in _emails(text)]
    if not _DIGIT.search(text):
        return spans
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            spans.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            spans.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
            spans.append((3, *m.span()))
    return spans


@dataclass
class Node:
    start: int
    end: int
    feature: str
    keys: tuple[str, ...]  # tokens that share one are similar
    label: int | None  # of a base span


def _shape(token: str) -> str:
    """Digits, country sign, brackets, separators, dots, letters, check digit:
    some 8,000 shapes can be made, a few dozen occur."""
    digits = _NOT_DIGIT.sub("", token)
    n = min(len(digits), 20)
    signs = ("+" if "+" in token else "") + ("(" if "(" in token else "")
    apart = [c for c in " -/" if c in token]
    between = apart[0] if len(apart) == 1 else "*" if apart or "_" in token or ":" in token else ""
    words = "@" if "@" in token else "w" if re.search("[A-Za-z]", token) else ""
    check = "L" if 13 <= len(digits) <= 19 and luhn(digits) else ""
    return f"{n}{signs}{between}{min(token.count('.'), 4)}{words}{check}"


def _keys(token: str) -> tuple[str, ...]:
    """What makes tokens similar: all their digits, the last of them, the
    address with its signs spelled, the name before them."""
    digits = _NOT_DIGIT.sub("", token)
    keys = []
    if not re.search("[A-Za-z]", token):
        if len(digits) >= SAME_DIGITS:
            keys.append(f"digits {digits}")
        if len(digits) >= SAME_DIGITS + 3:
            keys.append(f"digits {digits[-10:]}")
        return tuple(dict.fromkeys(keys))
    plain = token.lower().replace(" ", "")
    plain = re.sub(r"\(at\)|\[at\]|\(@\)|\[@\]", "@", plain)
    plain = re.sub(r"\(dot\)|\[dot\]", ".", plain).strip(".")
    keys.append(f"word {plain}")
    name = plain.partition("@")[0]
    if len(name) >= 5 and re.search("[0-9._+-]", name):
        keys.append(f"word {name}")
    return tuple(dict.fromkeys(keys))


def nodes_of(text: str, spans: list[tuple[int, int, int]]) -> list[Node]:
    """Candidates in order: base spans, and what else may be personal data."""
    taken: list[tuple[int, int]] = []
    nodes = []

    def free(start: int, end: int) -> bool:
        at = bisect_left(taken, (start, end))
        return not (
            (at < len(taken) and taken[at][0] < end) or (at > 0 and taken[at - 1][1] > start)
        )

    def add(start: int, end: int, label: int | None) -> None:
        token = text[start:end]
        nodes.append(Node(start, end, _shape(token), _keys(token), label))
        insort(taken, (start, end))

    for kind, start, end in sorted(spans, key=lambda s: (s[1], s[0])):
        if free(start, end):
            add(start, end, kind)
    if _DIGIT.search(text):
        for m in _NUMBER.finditer(text):
            if sum(c.isdigit() for c in m[0]) >= SAME_DIGITS and free(*m.span()):
                add(*m.span(), None)
    if "at" in text or "AT" in text or "@" in text:
        for m in _SPELLED.finditer(text) if re.search(r"[(\[](?:at|@)[)\]]", text, re.I) else ():
            if free(*m.span()):
                add(*m.span(), None)
        names = {k for n in nodes if n.label == 0 for k in n.keys}
        names = {k.removeprefix("word ") for k in names}
        for m in _WORD.finditer(text) if names else ():
            if len(m[0]) >= 5 and m[0].lower().strip(".") in names and free(*m.span()):
                add(*m.span(), None)
    return sorted(nodes, key=lambda n: n.start)


def _links(nodes: list[Node]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Chain links of neighbours; skip links of similar tokens: of a candidate
    to the first base span of each kind, or where there is none to the candidate
    before, of a base span to the one before. Many repeats give as many links."""
    chain = [(i - 1, i) for i in range(1, len(nodes))]
    hubs: dict[str, dict[int, int]] = {}
    for i, node in enumerate(nodes):
        for key in node.keys if node.label is not None else ():
            hubs.setdefault(key, {}).setdefault(node.label, i)
    last: dict[str, int] = {}
    skip = []
    for i, node in enumerate(nodes):
        for key in node.keys:
            if node.label is None and key in hubs:
                skip += [(min(i, j), max(i, j)) for j in hubs[key].values()]
                continue
            if key in last:
                skip.append((last[key], i))
            last[key] = i
    return chain, sorted(set(skip))


@dataclass
class Potentials:
    local: dict[str, np.ndarray]  # log P(label | shape)
    other: np.ndarray  # of shapes not seen
    chain: np.ndarray
    skip: np.ndarray


def marginals(
    local: np.ndarray, links: list[tuple[int, int, np.ndarray]]
) -> np.ndarray:
    """Of each node's labels, by loopy sum-product message passing."""
    if not links:
        beliefs = local
    else:
        a = np.array([x for x, _, _ in links])
        b = np.array([y for _, y, _ in links])
        table = np.stack([t for _, _, t in links])
        source, target = np.concatenate([a, b]), np.concatenate([b, a])
        table = np.concatenate([table, table.transpose(0, 2, 1)])
        back = np.concatenate([np.arange(len(a)) + len(a), np.arange(len(a))])
        messages = np.zeros((len(source), local.shape[1]))
        for turn in count():
            step = 0.5 ** (1 + turn // ROUNDS)  # ends in any case
            sums = local.copy()
            np.add.at(sums, target, messages)
            cavity = sums[source] - messages[back]
            scores = cavity[:, :, None] + table
            peak = scores.max(1, keepdims=True)
            new = peak[:, 0] + np.log(np.exp(scores - peak).sum(1))
            new -= new.max(1, keepdims=True)
            moved = np.abs(new - messages).max()
            if moved <= CONVERGED:
                messages = new
                break
            if step * moved <= CONVERGED**2:
                break
            messages = (1 - step) * messages + step * new
        beliefs = local.copy()
        np.add.at(beliefs, target, messages)
    p = np.exp(beliefs - beliefs.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def added_spans(
    text: str, spans: list[tuple[int, int, int]], potentials: Potentials
) -> list[tuple[int, int, int]]:
    """What the field finds beyond the base spans."""
    nodes = nodes_of(text, spans)
    if all(n.label is not None for n in nodes):
        return []
    best = beliefs(nodes, potentials).argmax(1)
    return [
        (int(k), n.start, n.end)
        for n, k in zip(nodes, best, strict=True)
        if n.label is None and k != OTHER
    ]


def beliefs(nodes: list[Node], potentials: Potentials) -> np.ndarray:
    """Probabilities of each node's labels; base spans have theirs."""
    local = np.stack([potentials.local.get(n.feature, potentials.other) for n in nodes])
    # A shape says half as much as one similar base span, at most. The rest is
    # more than the two neighbours in the text can say.
    local = np.maximum(local, local.max(1, keepdims=True) - potentials.skip.max() / 2)
    chain, skip = _links(nodes)
    links = []
    for pairs, table in ((chain, potentials.chain), (skip, potentials.skip)):
        for i, j in pairs:
            # Base spans are observed: what they say is fixed, and they hear nothing.
            if nodes[i].label is not None:
                local[j] += table[nodes[i].label]
            elif nodes[j].label is not None:
                local[i] += table[:, nodes[j].label]
            else:
                links.append((i, j, table))
    found = marginals(local, links)
    for i, node in enumerate(nodes):
        if node.label is not None:
            found[i] = np.eye(len(LABELS))[node.label]
    return found


def _count(potentials: Potentials | None):
    """Counts of labels by shape and of pairs of labels by link; without
    potentials a candidate without a label is other."""

    def count_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[tuple[str, int, int]] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                nodes = nodes_of(text or "", base_spans(text or ""))
                if not nodes:
                    continue
                if potentials:
                    p = beliefs(nodes, potentials)
                else:
                    p = np.eye(len(LABELS))[[OTHER if n.label is None else n.label for n in nodes]]
                for node, own in zip(nodes, p, strict=True):
                    for label in np.flatnonzero(own > _LITTLE).tolist():
                        counts["local " + node.feature, label, 0] += own[label]
                for kind, links in zip(("chain", "skip"), _links(nodes), strict=True):
                    for i, j in links:
                        both = np.outer(p[i], p[j])
                        for a, b in np.argwhere(both > _LITTLE).tolist():
                            counts[kind, a, b] += both[a, b]
        rows = [(*key, float(n)) for key, n in counts.items()]
        columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
        kinds = (pa.string(), pa.int32(), pa.int32(), pa.float64())
        yield pa.record_batch(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["what", "a", "b", "n"]
        )

    return count_


def fit(docs: DataFrame) -> Potentials:
    """Potentials from about SAMPLE_DOCS documents, those with the smallest
    hashes of their id and text; none are needed, then only priors count."""
    spark = docs.sparkSession
    ship(spark)
    parts = 1 << 30
    share = min(parts, parts * SAMPLE_DOCS // max(1, docs.count()))
    names = [c for c in ("doc_id", "text") if c in docs.columns]
    chosen = F.pmod(F.xxhash64(*names, F.lit(5)), F.lit(parts)) < share
    sample = stored(docs.where(chosen).select("text"), folder := new_folder(spark, "pii"))
    potentials = None
    for _ in range(PASSES):
        rows = (
            sample.mapInArrow(_count(potentials), "what string, a int, b int, n double")
            .groupBy("what", "a", "b")
            .agg(F.sum("n").alias("n"))
            .collect()  # a row for each shape and label that occur, and for each pair of labels
        )
        potentials = _potentials(rows)
    removed(spark, folder)
    return potentials


def _potentials(rows) -> Potentials:
    prior = np.array([PRIOR] * len(KINDS) + [PRIOR_OTHER])
    local: dict[str, np.ndarray] = {}
    pairs = {kind: np.full((len(LABELS), len(LABELS)), 0.0) for kind in ("chain", "skip")}
    # Sums of doubles depend on their order in the last digits; those are cut.
    for row in rows:
        n = round(row["n"], _DIGITS)
        if row["what"] in pairs:
            pairs[row["what"]][row["a"], row["b"]] += n
            pairs[row["what"]][row["b"], row["a"]] += n
        else:
            seen = local.setdefault(row["what"].removeprefix("local "), prior.copy())
            seen[row["a"]] += n
    return Potentials(
        {k: np.log(n / n.sum()) for k, n in local.items()},
        np.log(prior / prior.sum()),
        _chain(pairs["chain"]),
        _skip(pairs["skip"]),
    )


def _chain(pairs: np.ndarray) -> np.ndarray:
    """Log ratio of a pair's frequency to that of its labels on their own."""
    joint = (pairs + PRIOR) / (pairs + PRIOR).sum()
    own = joint.sum(1)
    return np.clip(np.log(joint / np.outer(own, own)), -MOST_CHAIN, MOST_CHAIN)


def _skip(pairs: np.ndarray) -> np.ndarray:
    """Log odds that a token similar to one of a kind is of that kind, by how
    often similar tokens were of one kind or of two.

    Pairs of a kind and other do not count against it: they are there because
    patterns know no context, which is what the field is to mend. Tokens that
    are other agree as kinds do in the middle.
    """
    kinds = pairs[:OTHER, :OTHER]
    agree = np.diag(kinds)
    odds = np.log((agree + 1) / (kinds.sum(1) - agree + math.exp(-AGREE)))
    odds = np.clip(odds, 0.0, MOST_AGREE)
    return np.diag(np.append(odds, np.median(odds)))


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span replaced by its kind; of overlapping spans the
    first one's kind stands for all."""
    parts, done, covered = [], 0, 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if start >= covered:
            parts += [text[done:start], f"<{KINDS[kind].upper()}>"]
        covered = max(covered, end)
        done = covered
    return "".join(parts) + text[done:]


_FOUND = T.StructType(
    [T.StructField(f"n_{kind}", T.LongType()) for kind in KINDS]
    + [
        T.StructField("base_sha256", T.StringType()),
        T.StructField("spans", T.StringType()),
        T.StructField("n_added", T.LongType()),
    ]
)


def found(text: str | Column, potentials: Potentials) -> Column:
    """Struct of n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans
    (all, in code points) and n_added. Null texts count as empty."""

    @F.arrow_udf(_FOUND)
    def find(texts: pa.Array) -> pa.Array:
        rows = []
        for value in texts:
            text = value.as_py() or ""
            base = base_spans(text)
            more = added_spans(text, base, potentials)
            kinds = Counter(k for k, _, _ in base)
            digest = hashlib.sha256(joined(base).encode()).hexdigest()
            rows.append((*(kinds[k] for k in range(OTHER)), digest, joined(base + more), len(more)))
        columns = list(zip(*rows, strict=True)) or [()] * 7
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
        return pa.StructArray.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], _FOUND.names
        )

    return find(F.col(text) if isinstance(text, str) else text)


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id and what `found` gives for its text."""
    spans = found("text", fit(docs)).alias("found")
    return docs.select("doc_id", spans).select("doc_id", "found.*")


def without_personal_data(docs: DataFrame) -> DataFrame:
    """`docs` with every span in `text` replaced; null texts stay null. A column
    n_chars is brought in line where there is one."""
    potentials = fit(docs)

    @F.arrow_udf(T.StringType())
    def redact(texts: pa.Array) -> pa.Array:
        out = []
        for value in texts:
            text = value.as_py()
            if text:
                base = base_spans(text)
                text = redacted(text, base + added_spans(text, base, potentials))
            out.append(text)
        return pa.array(out, pa.string())

    clean = docs.withColumn("text", redact("text"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.length("text").cast(kind))
    return clean
