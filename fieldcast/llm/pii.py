"""Operator 1: personal data, by patterns and a skip-chain conditional random field.

Patterns find the base spans. The field then labels other tokens of the document: a phone
number without its country code, a card written with other separators, the local part of an
address. Tokens are nodes, in every document, whether it has a base span or not. Neighbours, at
most ``GAP`` characters apart, share a chain potential, and tokens with a common key (equal or
similar forms) share a skip potential over any distance. Loopy sum-product passes messages until
labels of one entity agree. Base spans are clamped; what the field adds has a posterior of
``SURE`` or more. All potentials are learned from the node sequences of real texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from fieldcast.llm.common import give_back, write_shared

KINDS = ["email", "ip", "card", "phone"]
LABELS = ["none", *KINDS]
SURE = 0.9
ROUNDS = 20            # of message passing at most
SAMPLE = 4000          # texts that the potentials are learned on, a quarter for each kind
FIRST_SPANS = 20       # base spans of a kind in each of them at most, and as many other tokens
LONGEST = 200          # characters of a span that is learned from
GAP = 24               # characters between neighbours of the chain at most
STEPS = 400            # of gradient descent
SPANS = "kind string, start int, end int"

# The base patterns, in forms that cannot run twice over the same characters.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
#: Tokens that may be personal data in another form: with digits or an at sign, without
#: surrounding punctuation; or runs of digit groups.
NUMBERS = re.compile(r"[(+]?[0-9](?:[\x20().:/\[\]-]{0,2}[0-9])*")
TOKEN = re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+@-]*")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches. An address starts where the run of local characters
    before its at sign does, or where the last address ended."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL_CHARS:
            start -= 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            last = domain.end()
            out.append((start, last))
            at = text.find("@", last)
        else:
            last = at + 1  # characters before a failed sign are never looked at again
            at = text.find("@", last)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base spans, in order."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if not DIGIT.search(text):
        return out
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def same_letters(word: str) -> list[str]:
    """The key of words that differ in their separators only."""
    bare = re.sub("[^a-z0-9]", "", word.lower())
    return ["~" + bare] if len(bare) >= 6 and re.search("[0-9]", bare) and re.search("[a-z]", bare) else []


def keys_of(kind: int, text: str) -> list[str]:
    """What a token shares with other forms of the same entity."""
    if kind == 0:
        local, _, domain = text.lower().partition("@")
        keys = ["@" + text.lower()]
        if len(local) >= 5 and re.search("[0-9._+-]", local):
            keys += ["@" + local, *same_letters(local)]
        return keys
    if kind == 1:
        return ["." + ".".join(str(int(p)) if len(p) < 9 else p for p in re.findall("[0-9]+", text))]
    digits = re.sub("[^0-9]", "", text)
    return ["#" + digits] + (["#" + digits[-10:], "#" + digits[-7:]] if kind == 3 else [])


def token_keys(text: str) -> list[str]:
    """Keys of a token that is no base span."""
    groups = re.findall("[0-9]+", text)
    digits = "".join(groups)
    if not re.fullmatch(r"[0-9()+.:/\[\]\x20-]*", text):
        return ["@" + text.lower(), *same_letters(text)] if len(text) >= 5 and re.search("[0-9._+-]", text) else []
    keys = ["." + ".".join(str(int(g)) if len(g) < 9 else g for g in groups)] if len(groups) == 4 else []
    if len(digits) >= 7:
        keys.append("#" + digits)
        if len(digits) > 10:
            keys.append("#" + digits[-10:])
        if len(digits) > 7:
            keys.append("#" + digits[-7:])
    return keys


def shape(text: str) -> np.ndarray:
    """Features of a token alone."""
    digits = sum(c in "0123456789" for c in text)
    letters = sum(c.isalpha() for c in text)
    groups = len(re.findall("[0-9]+", text))
    return np.array([
        1.0, digits == 0, 0 < digits < 7, 7 <= digits < 9, 9 <= digits <= 11, 12 <= digits <= 19, digits > 19,
        groups == 1, groups == 4, 2 <= groups <= 3, groups > 4, letters > 0, "@" in text, "." in text,
        "-" in text or " " in text, "(" in text, "+" in text], np.float64)


WIDTH = 17


@dataclass
class Field:
    """Log-potentials: of a token's features, of neighbours, and of tokens with a common key."""

    unary: np.ndarray   # features x labels
    chain: np.ndarray   # labels x labels, symmetric
    skip: np.ndarray    # labels x labels, symmetric


def nodes_of(text: str) -> tuple[list[tuple[int, int, int, list[str]]], list[tuple[int, int, int]]]:
    """((start, end, kind or -1, keys) of each node in order, base spans)."""
    base = base_spans(text)
    if not base and not DIGIT.search(text):
        return [], base
    found = [(a, b, k, keys_of(k, text[a:b])) for a, k, b in base]
    known = {key for node in found for key in node[3]}
    taken, reach = [], -1
    for a, _, b in base:
        if a <= reach and taken:
            taken[-1][1] = reach = max(reach, b)
        else:
            taken.append([a, b])
            reach = b
    free, last = [], 0
    for a, b in [*taken, [len(text), len(text)]]:
        free.append((last, a))
        last = b
    local_known = any(key.startswith("@") for key in known)
    for a, b in free:
        for pattern in ((NUMBERS, TOKEN) if local_known else (NUMBERS,)):
            for m in pattern.finditer(text, a, b):
                word = m[0].rstrip(".-")
                keys = token_keys(word)
                if keys and (pattern is NUMBERS or any(k in known for k in keys)):
                    found.append((m.start(), m.start() + len(word), -1, keys))
    found.sort(key=lambda n: (n[0], n[1] - n[0], n[2]))
    return found, base


def edges_of(nodes) -> list[tuple[int, int, int]]:
    """(node, node, 0 for a chain edge or 1 for a skip edge). A node is tied to the last node
    and to the last base node with each of its keys, so edges grow in step with the nodes."""
    out, last, clear = set(), {}, {}
    for i, (start, _, kind, keys) in enumerate(nodes):
        if i and 0 <= start - nodes[i - 1][1] <= GAP:
            out.add((i - 1, i, 0))
        for key in keys:
            for seen in (last, clear):
                if key in seen and seen[key] != i:
                    out.add((seen[key], i, 1))
            last[key] = i
            if kind >= 0:
                clear[key] = i
    for i, (_, _, kind, keys) in enumerate(nodes):  # base spans that come later in the text
        if kind < 0:
            for key in keys:
                if key in clear and clear[key] > i:
                    out.add((i, clear[key], 1))
    return sorted(out)


def posteriors(field: Field, nodes, edges, texts: list[str]) -> np.ndarray:
    """Marginals of the labels by loopy sum-product; base nodes are clamped to their kind."""
    unary = np.stack([shape(t) for t in texts]) @ field.unary
    for i, node in enumerate(nodes):
        if node[2] >= 0:
            unary[i] = -50.0
            unary[i, node[2] + 1] = 0.0
    if edges:
        a, b, kind = np.array(edges).T
        source, target = np.concatenate([a, b]), np.concatenate([b, a])
        potential = np.where(np.concatenate([kind, kind])[:, None, None] == 1, field.skip, field.chain)
        back = np.concatenate([np.arange(len(a)) + len(a), np.arange(len(a))])
        message = np.zeros((len(source), len(LABELS)))
        for _ in range(ROUNDS):
            belief = unary.copy()
            np.add.at(belief, target, message)
            out = belief[source] - message[back]
            new = np.logaddexp.reduce(out[:, :, None] + potential, axis=1)
            new -= new.max(1, keepdims=True)
            step = np.abs(new - message).max(initial=0)
            message = 0.5 * message + 0.5 * new
            if step < 1e-4:
                break
        np.add.at(unary, target, message)
    unary -= unary.max(1, keepdims=True)
    p = np.exp(unary)
    return p / p.sum(1, keepdims=True)


def all_spans(field: Field, text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base spans, all spans), each (start, kind, end) in order. Added spans do not overlap base
    spans; of two that overlap each other, the one with the earlier start and longer text stays."""
    nodes, base = nodes_of(text)
    if len(nodes) == len(base):
        return base, base
    texts = [text[n[0]:n[1]] for n in nodes]
    p = posteriors(field, nodes, edges_of(nodes), texts)
    best = p.argmax(1)
    added, reach = [], -1
    for i, node in sorted(enumerate(nodes), key=lambda x: (x[1][0], -x[1][1])):
        if node[2] < 0 and best[i] > 0 and p[i, best[i]] >= SURE and node[0] >= reach:
            added.append((node[0], int(best[i]) - 1, node[1]))
            reach = node[1]
    return base, sorted(base + added)


def variants(kind: int, text: str) -> list[str]:
    """Other forms of a base span, for training."""
    digits = re.sub("[^0-9]", "", text)
    if kind == 0:
        return [text.partition("@")[0]]
    if kind == 1:
        return [text.replace(".", "-"), text.replace(".", "[.]")]
    if kind == 2:
        return [mark.join(digits[i:i + 4] for i in range(0, len(digits), 4)) for mark in "./"]
    return [digits[-10:], f"({digits[-10:-7]}) {digits[-7:-4]}-{digits[-4:]}", f"{digits[-10:-7]}-{digits[-7:-4]}-{digits[-4:]}", f"{digits[-7:-4]}-{digits[-4:]}"]


def beside(nodes) -> list[tuple[int, int]]:
    """Kinds of the chain neighbours before and after each node: -1 for a token that is no base span,
    -2 where there is no neighbour."""
    out = [[-2, -2] for _ in nodes]
    for i in range(1, len(nodes)):
        if 0 <= nodes[i][0] - nodes[i - 1][1] <= GAP:
            out[i][0], out[i - 1][1] = nodes[i - 1][2], nodes[i][2]
    return [tuple(x) for x in out]


def training_rows(spans: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, labels and weights for pseudo-likelihood, of nodes (kind, text, kind before, kind
    after) as they stand in texts; a pair (kind, text) stands alone.

    Each other form of a base span occurs four times: tied to its base span it has the label, alone
    or tied to a number that is none it has none, and among its neighbours it has the label where one
    of them is of its kind. Tokens that are no base span count as none among theirs: most are, and the
    few that the field is to find are outweighed. Every kind weighs as much as any other, however many
    spans it has, and each other token as much as a form on average.
    """
    rows, labels, kinds = [], [], []
    none, of = np.zeros(len(LABELS)), np.eye(len(LABELS))
    for kind, text, *near in spans:
        near = [k for k in near if k >= -1]
        chain = sum((of[k + 1] for k in near), none)
        if kind < 0:
            found = [(text, chain, none, 0)]
        else:
            found = [(form, c, skip, label) for form in variants(kind, text) if token_keys(form) for c, skip, label in (
                (none, of[kind + 1], kind + 1), (none, none, 0), (none, of[0], 0),
                *([(chain, none, kind + 1)] if kind in near else []))]
        for form, c, skip, label in found:
            rows.append(np.concatenate([shape(form), c, skip]))
            labels.append(label)
            kinds.append(kind)
    at = np.array(kinds, np.int64) + 1
    counts = np.bincount(at, minlength=len(LABELS))
    weights = 1.0 / (np.maximum(counts, 1) * max((counts[1:] > 0).sum(), 1))
    weights[0] = 1.0 / max(counts[1:].sum() or counts[0], 1)
    return (np.array(rows).reshape(-1, WIDTH + 2 * len(LABELS)), np.array(labels, np.int64), weights[at])


def learn(spans: list[tuple]) -> Field:
    """Potentials by gradient descent on the pseudo-likelihood (a softmax over a node's features
    and the labels of its neighbours). Without spans the field adds nothing."""
    x, y, share = training_rows(spans)
    weights = np.zeros((WIDTH + 2 * len(LABELS), len(LABELS)))
    weights[0, 0] = 4.0  # a token is nothing unless something speaks for it
    for step in range(STEPS if len(x) else 0):
        logits = x @ weights
        p = np.exp(logits - logits.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(y)), y] -= 1
        weights -= 4.0 * (x.T @ (p * share[:, None]) + 1e-5 * weights)
    chain = weights[WIDTH:WIDTH + len(LABELS)]
    skip = weights[WIDTH + len(LABELS):]
    return Field(weights[:WIDTH], (chain + chain.T) / 2, (skip + skip.T) / 2)


NODE = pa.schema([("kind", pa.int32()), ("text", pa.string()), ("before", pa.int32()), ("after", pa.int32())])


def examples(text: str) -> set[tuple[int, str, int, int]]:
    """The nodes of a text to learn from: ``FIRST_SPANS`` of each kind, and as many others."""
    nodes, _ = nodes_of(text)
    out, counts = set(), dict.fromkeys(range(-1, len(KINDS)), 0)
    for (a, b, kind, _), near in zip(nodes, beside(nodes)):
        if counts[kind] < FIRST_SPANS and b - a <= LONGEST:
            counts[kind] += 1
            out.add((kind, text[a:b], *near))
    return out


def fit(docs: DataFrame, most: int = SAMPLE) -> Field:
    """Learn from the nodes of ``most`` texts, as many for each kind: of the texts that hold the
    kind, those with the smallest hash. A first pass over all rows finds the kinds of every text. The
    driver gets ``FIRST_SPANS`` nodes of a kind and text at most, of ``LONGEST`` characters at most.
    Repeated texts and nodes count once."""
    each = -(-most // len(KINDS))

    def kinds(batches):
        for batch in batches:
            rows = [(k, h) for h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                    for k in sorted({k for _, k, _ in base_spans(text)})]
            yield pa.RecordBatch.from_arrays([
                pa.array([k for k, _ in rows], pa.int32()), pa.array([h for _, h in rows], pa.int64())],
                names=["kind", "at"])
        give_back()

    def find(batches):
        for batch in batches:
            rows = sorted(set().union(*[examples(text) for text in batch.column(0).to_pylist()]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(NODE)], schema=NODE)
        give_back()

    texts = docs.where("text is not null").select(F.xxhash64("text").alias("at"), "text")
    held = write_shared(texts.mapInArrow(kinds, "kind int, at long"), "kinds").distinct()
    chosen = reduce(DataFrame.unionByName, [
        held.where(F.col("kind") == k).select("at").orderBy("at").limit(each) for k in range(len(KINDS))]).distinct()
    some = texts.join(F.broadcast(chosen), "at")  # about most ids: a proven bound
    found = write_shared(some.select("text").mapInArrow(find, "kind int, text string, before int, after int").distinct(), "nodes")
    return learn(sorted(tuple(r) for k in range(-1, len(KINDS)) for r in found.where(F.col("kind") == k).orderBy(
        F.xxhash64("text", "before", "after"), "text", "before", "after").limit(each * FIRST_SPANS).collect()))


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def found_column(text: Column, field: Field) -> Column:
    """struct(n_email, n_ip, n_card, n_phone, base, spans): counts of base spans, and base and
    all spans as kind:start:end, comma-joined. Null counts as the empty text."""

    @F.pandas_udf("n_email long, n_ip long, n_card long, n_phone long, base string, spans string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for text in texts:
                base, spans = all_spans(field, text or "")
                kinds = [k for _, k, _ in base]
                rows.append((*[kinds.count(k) for k in range(4)], written(base), written(spans)))
            yield pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base", "spans"])
        give_back()

    return run(text)


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans: one row per row of ``docs``.

    Repeated rows are repeated; null texts have no spans; other columns play no part. No shuffle.
    """
    field = fit(docs)
    return docs.select("doc_id", found_column(F.col("text"), field).alias("f")).select(
        "doc_id", "f.n_email", "f.n_ip", "f.n_card", "f.n_phone", F.sha2("f.base", 256).alias("base_sha256"), "f.spans")


def masked_column(text: Column, field: Field) -> Column:
    """The text with every span replaced by its kind in angle brackets."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([None if t is None else masked(field, t) for t in texts], dtype=object)
        give_back()

    return run(text)


def masked(field: Field, text: str) -> str:
    out, last = [], 0
    for a, k, b in all_spans(field, text)[1]:
        if a >= last:
            out += [text[last:a], f"<{KINDS[k]}>"]
        last = max(last, b)
    return "".join([*out, text[last:]])


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with masked texts and n_chars to match; columns are unchanged otherwise."""
    field = fit(docs)
    out = docs.withColumn("text", masked_column(F.col("text"), field))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)
