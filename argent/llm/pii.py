"""Operator 3, personal data by weak supervision.

Candidates are the base patterns' matches (valid or not), long runs of mixed
letters and digits, assigned values, and e-mail addresses spelled out. Every
candidate gets votes from regular-expression, gazetteer and context labelers
(1 personal, 0 not, -1 no vote). Spark counts the vote and feature patterns of
the whole corpus; both spaces are finite, so what reaches the driver is
bounded by them and not by the input. Expectation-maximisation over the vote
patterns estimates each labeler's reliability, and a logistic span classifier
on features of text and context is trained towards its posteriors. A second
scan keeps the candidates that the classifier accepts. Valid base matches
always stay.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from argent.llm.common import load, texts

KINDS = ("email", "ip", "card", "phone", "secret")
BASE_KINDS = KINDS[:4]

_ANY = re.compile(r"[0-9@]| dot | DOT |\[dot\]|\(dot\)")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A run of digits has one start that can match, so others are not tried.
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SPELLED = re.compile(r"(?<!\S)[A-Za-z0-9._%+-]+ ?(?:@|\(at\)|\[at\]| at ) ?[A-Za-z0-9-]+(?: ?(?:\(dot\)|\[dot\]| dot | DOT ) ?[A-Za-z0-9-]+)+")
_MIXED = re.compile(r"[A-Za-z0-9+/_-]{16,}")
_DIGIT = re.compile("[0-9]")

# Gazetteers.
CUES = frozenset("password passwd pwd token secret key apikey api_key access_key email mail phone tel call fax card visa iban ip host contact".split())
PREFIXES = ("AKIA", "ASIA", "ghp_", "sk-", "xoxb-", "AIza")
ENDINGS = ("com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "info")
AGAINST = frozenset("version license licence section chapter page figure table release edition isbn doi".split())


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from each @ outwards: the local
    part is the whole run before it, as far as the previous match."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            last = m.end()
            yield start, last
        at = text.find("@", max(at + 1, last))


def patterns(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """(kind, start, end, valid) of every base pattern match."""
    for a, z in emails(text):
        yield "email", a, z, True
    for m in _IP.finditer(text):
        parts = m.group().split(".")
        yield "ip", m.start(), m.end(), all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        yield "card", m.start(), m.end(), 16 <= len(digits) <= 19 and luhn(digits)
    if "+" in text:
        for m in _PHONE.finditer(text):
            yield "phone", m.start(), m.end(), 8 <= len(_DIGIT.findall(m.group())) <= 15


def base_spans(text: str) -> list[tuple[str, int, int]]:
    if not _ANY.search(text):
        return []
    return [(k, a, z) for k, a, z, ok in patterns(text) if ok]


def _entropy(s: str) -> float:
    n = len(s)
    return -sum(c / n * math.log2(c / n) for c in Counter(s).values())


def _votes(kind: str, s: str, before: str, valid: bool) -> tuple[tuple[int, ...], tuple[int, ...]]:
    """Votes of the labelers, and the classifier's features (all 0 or 1)."""
    words = re.findall(r"[A-Za-z_]+", before.lower())[-2:]
    digits = sum(c.isdigit() for c in s)
    letters = sum(c.isalpha() for c in s)
    entropy = _entropy(s)
    cue = any(w in CUES for w in words)
    against = any(w in AGAINST for w in words)
    assigned = before.rstrip(' "\'')[-1:] in ("=", ":")
    mixed = digits >= 3 and letters >= 3
    upper_lower = s != s.lower() and s != s.upper()
    known = s.startswith(PREFIXES) or (kind == "email" and s.lower().endswith(ENDINGS))
    long = len(s) >= 16
    votes = (
        (1 if valid else 0) if kind in BASE_KINDS else -1,  # regular expression with its check
        1 if kind == "secret" and long and mixed else (0 if kind == "secret" and not digits else -1),  # shape
        1 if known else -1,  # gazetteer of endings and prefixes
        1 if cue else -1,  # gazetteer of cue words
        0 if against else -1,  # context: numbering of parts and versions
        1 if assigned else -1,  # context: an assigned value
        (1 if entropy >= 3.0 else 0) if kind == "secret" else -1,
        0 if len(s) < 7 else -1,  # too short to name anyone
    )
    features = (
        *(int(kind == k) for k in KINDS), int(long), int(len(s) >= 8), int(digits * 2 >= len(s)), int(letters > 0),
        int(mixed), int(upper_lower), int(entropy >= 2.5), int(entropy >= 3.2), int(cue), int(against), int(assigned),
        int(" " in s), int("." in s),
    )
    return votes, features


def candidates(text: str) -> Iterator[tuple[str, int, int, bool, tuple[int, ...], tuple[int, ...]]]:
    """(kind, start, end, valid base match, votes, features), valid base first."""
    if not _ANY.search(text):
        return
    taken = np.zeros(0)
    found = [(k, a, z, ok) for k, a, z, ok in patterns(text)]
    covered = sorted((a, z) for _, a, z, ok in found if ok)
    starts = np.array([a for a, _ in covered], dtype=np.int64)
    taken = np.maximum.accumulate(np.array([z for _, z in covered], dtype=np.int64)) if covered else taken

    def free(a: int, z: int) -> bool:  # touches no valid base match
        i = int(np.searchsorted(starts, z)) - 1
        return i < 0 or taken[i] <= a

    more = []
    if "dot" in text or "DOT" in text:
        more += [("email", m.start(), m.end(), False) for m in _SPELLED.finditer(text)]
    more += [("secret", m.start(), m.end(), False) for m in _MIXED.finditer(text) if _DIGIT.search(m.group())]
    for kind, a, z, ok in [*found, *(c for c in more if free(c[1], c[2]))]:
        votes, features = _votes(kind, text[a:z], text[max(0, a - 24) : a], ok)
        yield kind, a, z, ok, votes, features


def _code(v: tuple[int, ...]) -> str:
    return ",".join(map(str, v))


def _pattern_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seen = Counter((_code(c[4]), _code(c[5])) for t in batch.column(0) for c in candidates(t.as_py()))
        yield pa.record_batch(
            [pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.string()), pa.array(list(seen.values()), pa.int64())],
            ["votes", "features", "n"],
        )


@dataclass(frozen=True)
class SpanModel:
    """Labeler reliabilities (chance of a right vote for spans that are and are
    not personal), the prior, and the classifier's weights, the last the bias."""

    sensitivity: tuple[float, ...]
    specificity: tuple[float, ...]
    prior: float
    weights: tuple[float, ...]

    def score(self, features: tuple[int, ...]) -> float:
        z = self.weights[-1] + sum(w for w, x in zip(self.weights, features) if x)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def fit(votes: np.ndarray, features: np.ndarray, n: np.ndarray, rounds: int = 50) -> SpanModel:
    """EM over vote patterns, then Newton steps of a ridge logistic regression."""
    if not len(n):
        k = len(_votes("card", "1", "", False)[0])
        f = len(_votes("card", "1", "", False)[1])
        return SpanModel((0.8,) * k, (0.8,) * k, 0.5, (0.0,) * f + (-1.0,))
    yes, no = (votes == 1).astype(float), (votes == 0).astype(float)
    sens, spec, prior = np.full(votes.shape[1], 0.8), np.full(votes.shape[1], 0.8), 0.5
    post = np.full(len(n), 0.5)
    for _ in range(rounds):
        up = math.log(prior) + yes @ np.log(sens) + no @ np.log(1 - sens)
        down = math.log(1 - prior) + yes @ np.log(1 - spec) + no @ np.log(spec)
        post = 1 / (1 + np.exp(np.clip(down - up, -60, 60)))
        w1, w0 = n * post, n * (1 - post)
        # Two virtual votes at the starting reliability keep all values inside (0.5, 1).
        sens = np.clip((yes.T @ w1 + 1.6) / ((yes + no).T @ w1 + 2), 0.51, 0.999)
        spec = np.clip((no.T @ w0 + 1.6) / ((yes + no).T @ w0 + 2), 0.51, 0.999)
        prior = float(np.clip((w1.sum() + 1) / (n.sum() + 2), 0.01, 0.99))
    x = np.hstack([features.astype(float), np.ones((len(n), 1))])
    w = np.zeros(x.shape[1])
    scale = n / n.mean()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (scale * (post - p)) - 0.1 * w
        hess = (x * (scale * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w = w + np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return SpanModel(tuple(sens.tolist()), tuple(spec.tolist()), prior, tuple(w.tolist()))


def fit_spans(base: DataFrame, text_col: str = "text") -> SpanModel:
    """Train on the pattern counts of all texts."""
    counts = (
        base.select(F.col(text_col).alias("text")).mapInArrow(_pattern_counts, "votes string, features string, n long")
        .groupBy("votes", "features").agg(F.sum("n").alias("n"))
        .orderBy("votes", "features").collect()
    )
    ints = lambda rows: np.array([list(map(int, r.split(","))) for r in rows])
    return fit(ints([r.votes for r in counts]), ints([r.features for r in counts]), np.array([float(r.n) for r in counts]))


def _joined(spans: list[tuple[str, int, int]]) -> str:
    order = {k: i for i, k in enumerate(KINDS)}
    return ",".join(f"{k}:{a}:{z}" for k, a, z in sorted(set(spans), key=lambda s: (order[s[0]], s[1], s[2])))


def spans_of(text: str, model: SpanModel) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and all accepted spans."""
    base, accepted = [], []
    for kind, a, z, ok, _, features in candidates(text):
        if ok:
            base.append((kind, a, z))
        elif model.score(features) < 0.5:
            continue
        accepted.append((kind, a, z))
    return base, accepted


def _find(model: SpanModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, list[int]] = {k: [] for k in BASE_KINDS}
            base_out, all_out = [], []
            for t in batch.column(1):
                base, spans = spans_of(t.as_py(), model)
                for k in BASE_KINDS:
                    counts[k].append(sum(s[0] == k for s in base))
                base_out.append(_joined(base))
                all_out.append(_joined(spans))
            yield pa.record_batch(
                [batch.column(0), *(pa.array(counts[k], pa.int64()) for k in BASE_KINDS), pa.array(base_out, pa.string()), pa.array(all_out, pa.string())],
                ["doc_id", *(f"n_{k}" for k in BASE_KINDS), "base_spans", "spans"],
            )

    return run


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: doc_id, n_email, n_ip, n_card, n_phone (valid base
    matches), base_spans and spans (kind:start:end in code points, end
    exclusive, by kind, then start). A null text has no spans; an empty table
    gives an empty result, and so does training on texts without candidates
    leave only base spans."""
    base = texts(docs, id_col, text_col)
    model = fit_spans(base)
    id_type = base.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in BASE_KINDS)
    return base.mapInArrow(_find(model), f"doc_id {id_type}, {counts}, base_spans string, spans string")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(load(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", *(f"n_{k}" for k in BASE_KINDS), F.sha2("base_spans", 256).alias("base_sha256"), "spans"
    )
