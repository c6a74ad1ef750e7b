"""Personal data: base patterns, and further spans by weak supervision."""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanestride.session import stage

KINDS = ["email", "ip", "card", "phone"]
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: A match from inside a run of digits would also start at the run's first digit, so the look-behind changes no match.
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]+")

#: Wider nets of the weak labelers.
LOOSE_NUMBER = re.compile(r"(?<![0-9])[+(]?[0-9](?:[\x20().-]{0,2}[0-9]){6,18}(?![0-9])")
LOOSE_EMAIL = re.compile(r"(?<![\w.])[A-Za-z0-9][\w.+-]{0,63}[ ]?[\[(](?:at|AT|@)[\])][ ]?[A-Za-z0-9-]{1,63}(?:[ ]?(?:\.|[\[(](?:dot|DOT|\.)[\])])[ ]?[A-Za-z0-9-]{2,63}){1,4}")

#: Gazetteers: top-level domains, first digits of card issuers.
DOMAINS = frozenset("com org net edu gov io de fr es uk eu info biz".split())
ISSUERS = ("4", "51", "52", "53", "54", "55", "34", "37", "36", "38", "6011", "65", "35", "22", "23", "24", "25", "26", "27")
#: Words that stand before personal data, and words that stand before other numbers.
NEAR = re.compile(r"\b(?:e-?mail|mail|contact|kontakt|contacto|correo|courriel|phone|tel|telefon|téléphone|teléfono|call|mobile|handy|fax|card|karte|carte|tarjeta|visa|ip|host|address|adresse)\b", re.I)
FAR = re.compile(r"\b(?:version|license|licence|isbn|issn|invoice|order|page|chapter|section|figure|token|password|secret|hash|commit|build|copyright|rfc)\b", re.I)
CONTEXT = 48  # characters before a span that context labelers read

LABELERS = ["pattern", "checksum", "gazetteer", "context", "boundary", "variety"]
FEATURES = ["email", "ip", "card", "phone", "length", "digits", "groups", "separators", "distinct", "plus", "bracket", "near", "far", "inner"]
ADD_AT = 0.9  # probability from which the classifier adds a span
EM_ROUNDS = 50
NEWTON_ROUNDS = 6
RIDGE = 1.0


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d)
        total += n if i % 2 == 0 else (2 * n - 9 if n > 4 else 2 * n)
    return total % 10 == 0


def octets(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0")[:3] or "0") <= 255 for p in text.split("."))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses: a local part never holds an @, so each @ decides alone."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        else:
            done = at + 1
        at = text.find("@", done)


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """((kind, start, end) that pass, those that the pattern finds and its check drops)."""
    good, bad = [(0, a, b) for a, b in emails(text)], []
    for m in IP.finditer(text):
        (good if octets(m.group()) else bad).append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() < 13:
            continue
        digits = "".join(DIGITS.findall(m.group()))
        if 13 <= len(digits) <= 19:
            (good if luhn(digits) else bad).append((2, m.start(), m.end()))
    for m in PHONE.finditer(text):
        (good if 9 <= sum(map(str.isdigit, m.group())) <= 15 else bad).append((3, m.start(), m.end()))
    return good, bad


def loose_spans(text: str, taken: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """Candidates of the wide nets that touch no base span; the kind is a guess from the shape."""
    cover = sorted((a, b) for _, a, b in taken)
    begins = [a for a, _ in cover]
    found = [(0, m.start(), m.end()) for m in LOOSE_EMAIL.finditer(text)] if "@" in text or "(at" in text.lower() or "[at" in text.lower() else []
    for m in LOOSE_NUMBER.finditer(text):
        digits = sum(map(str.isdigit, m.group()))
        dotted = m.group().count(".") == 3 and not re.search(r"[^0-9.]", m.group())
        found.append((1 if dotted else 2 if digits >= 13 else 3, m.start(), m.end()))
    for kind, a, b in found:
        i = int(np.searchsorted(begins, b))
        if not any(x < b and a < y for x, y in cover[max(0, i - 4):i]):
            yield kind, a, b


def describe(text: str, kind: int, a: int, b: int, valid: bool, strict: bool) -> tuple[list[int], list[float]]:
    """(votes of the labelers: 1 personal, -1 not, 0 abstains; features of the classifier)."""
    span, before = text[a:b], text[max(0, a - CONTEXT):a]
    digits = "".join(c for c in span if c.isascii() and c.isdigit())
    groups = len(DIGITS.findall(span))
    near, far = bool(NEAR.search(before)), bool(FAR.search(before))
    outer = text[a - 1:a] + text[b:b + 1]
    inner = any(c.isalnum() or c in "_=/\"#" for c in outer)
    checks = valid if strict else (luhn(digits) if kind == 2 else octets(span) if kind == 1 else None)
    known = (span.rsplit(".", 1)[-1].lower() in DOMAINS if kind == 0 else digits.startswith(ISSUERS) if kind == 2
             else 9 <= len(digits) <= 15 if kind == 3 else not span.startswith(("0.", "255.")))
    votes = [
        1 if strict and valid else -1 if strict else 0,
        0 if checks is None else 1 if checks else -1,
        1 if known else -1,
        1 if near and not far else -1 if far and not near else 0,
        -1 if inner else 1,
        -1 if digits and len(set(digits)) <= 2 else 0,
    ]
    separators = sum(not c.isalnum() for c in span)
    row = [float(kind == k) for k in range(4)] + [
        np.log1p(b - a), np.log1p(len(digits)), np.log1p(groups), np.log1p(separators), len(set(digits)) / 10.0,
        float(span.startswith("+")), float("(" in span or "[" in span), float(near), float(far), float(inner)]
    return votes, row


SPAN = "struct<kind:int,start:long,stop:long,base:boolean,votes:array<int>,features:array<double>>"


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, spans): all base spans and candidates of each whole text, with votes and features; null texts have none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("stop", pa.int64()), ("base", pa.bool_()),
                                   ("votes", pa.list_(pa.int32())), ("features", pa.list_(pa.float64()))]))
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                out = []
                for text in part.column(1):
                    t, row = text.as_py() or "", []
                    good, bad = base_spans(t)
                    wide = list(loose_spans(t, good + bad))
                    for group, valid, strict in ((good, True, True), (bad, False, True), (wide, False, False)):
                        for k, a, b in group:
                            votes, features = describe(t, k, a, b, valid, strict)
                            row.append({"kind": k, "start": a, "stop": b, "base": valid, "votes": votes, "features": features})
                    out.append(row)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out, kind)], ["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, f"doc_id long, spans array<{SPAN}>")


def reliabilities(patterns: np.ndarray, counts: np.ndarray, rounds: int = EM_ROUNDS) -> tuple[float, np.ndarray, np.ndarray]:
    """Expectation-maximisation of (prior, P(vote | class), posterior of each vote pattern).

    ``patterns`` holds distinct vote rows, ``counts`` how many candidates cast
    them; both are all that the estimate needs of the corpus.  The first
    posterior is a smoothed majority vote.
    """
    post = 1 / (1 + np.exp(-patterns.sum(axis=1)))
    prior, table = 0.5, np.full((2, patterns.shape[1], 3), 1 / 3)
    for _ in range(rounds):
        weight = np.stack([(1 - post) * counts, post * counts])
        prior = (weight[1].sum() + 1) / (counts.sum() + 2)
        for v in (-1, 0, 1):
            table[:, :, v + 1] = weight @ (patterns == v) + 1
        table /= table.sum(axis=2, keepdims=True)
        score = np.log([1 - prior, prior])[:, None] + np.stack([
            np.log(table[y][np.arange(patterns.shape[1]), patterns + 1]).sum(axis=1) for y in (0, 1)])
        post = 1 / (1 + np.exp(np.clip(score[0] - score[1], -50, 50)))
    return prior, table, post


@dataclass
class SpanModel:
    weights: np.ndarray  # FEATURES + 1, the last one the intercept
    accuracy: dict[str, dict[str, float]]  # kind -> labeler -> estimated accuracy of its votes

    def probability(self, features: np.ndarray) -> np.ndarray:
        z = np.hstack([features, np.ones((len(features), 1))]) @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def fit_spans(spans: DataFrame) -> SpanModel:
    """The final classifier, from (kind, votes, features) of all candidates of the corpus.

    Vote patterns are counted by Spark (their number is bounded by the
    labelers), each kind's reliabilities are estimated from the counts, and the
    posterior of a candidate's pattern is its soft label.  The classifier is a
    logistic regression by Newton steps whose sums Spark adds up; candidates of
    equal features and label are pooled first.
    """
    size = len(FEATURES) + 1
    rows = spans.groupBy("kind", "votes").agg(F.count("*").alias("n")).collect()  # at most kinds x 3^labelers
    labels, accuracy = [], {}
    for kind in sorted({r["kind"] for r in rows}):
        own = [r for r in rows if r["kind"] == kind]
        patterns, counts = np.array([r["votes"] for r in own]), np.array([r["n"] for r in own], float)
        prior, table, post = reliabilities(patterns, counts)
        labels += [(kind, list(map(int, p)), float(q)) for p, q in zip(patterns, post, strict=True)]
        accuracy[KINDS[kind]] = {name: float((1 - prior) * table[0, j, 0] + prior * table[1, j, 2]) / max(1e-9, float(
            (1 - prior) * (table[0, j, 0] + table[0, j, 2]) + prior * (table[1, j, 0] + table[1, j, 2]))) for j, name in enumerate(LABELERS)}
    model = SpanModel(np.zeros(size), accuracy)
    if not labels:
        return model
    soft = spans.sparkSession.createDataFrame(labels, "kind int, votes array<int>, label double")
    pooled = stage(spans.join(F.broadcast(soft), ["kind", "votes"]).groupBy("features", "label").agg(F.count("*").alias("n")))
    for _ in range(NEWTON_ROUNDS):
        weights = model.weights

        def run(batches: Iterator[pa.RecordBatch], weights: np.ndarray = weights) -> Iterator[pa.RecordBatch]:
            total = np.zeros((size, size + 1))
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                x = np.hstack([x, np.ones((len(x), 1))])
                p = 1 / (1 + np.exp(-np.clip(x @ weights, -50, 50)))
                n = batch.column(2).to_numpy().astype(float)
                total += np.hstack([x.T @ (x * (n * p * (1 - p))[:, None]), (x.T @ (n * (batch.column(1).to_numpy() - p)))[:, None]])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())], ["cell", "value"])

        cells = pooled.select("features", "label", "n").mapInArrow(run, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
        total = np.zeros(size * (size + 1))
        total[cells.column("cell").to_numpy()] = cells.column("value").to_numpy()
        total = total.reshape(size, size + 1)
        gradient = total[:, -1] - RIDGE * weights
        model.weights = weights + np.linalg.solve(total[:, :-1] + RIDGE * np.eye(size), gradient)
    return model


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def find_personal_data(docs: DataFrame, add_at: float = ADD_AT) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added for every document.

    Base spans are exact and always stay.  Of the other candidates those are
    added whose probability reaches ``add_at`` and that overlap no span
    already taken (likelier ones first, then by start).  Offsets are code
    points, ends exclusive.  Null and empty texts have no spans.
    """
    found = stage(candidates(docs))
    model = fit_spans(found.select(F.explode("spans").alias("s")).select("s.kind", "s.votes", "s.features"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[] for _ in range(7)]
            for spans in batch.column(1).to_pylist():
                base = [(s["kind"], s["start"], s["stop"]) for s in spans if s["base"]]
                rest = [s for s in spans if not s["base"]]
                taken, added = [(a, b) for _, a, b in base], []
                if rest:
                    p = shared.value.probability(np.array([s["features"] for s in rest]))
                    for i in np.lexsort(([s["start"] for s in rest], -p)):
                        a, b = rest[i]["start"], rest[i]["stop"]
                        if p[i] >= add_at and not any(x < b and a < y for x, y in taken):
                            taken.append((a, b))
                            added.append((rest[i]["kind"], a, b))
                for k in range(4):
                    cols[k].append(sum(s[0] == k for s in base))
                cols[4].append(hashlib.sha256(joined(base).encode()).hexdigest())
                cols[5].append(joined(base + added))
                cols[6].append(len(added))
            kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(cols, kinds, strict=True)]],
                                             ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])

    return found.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")
