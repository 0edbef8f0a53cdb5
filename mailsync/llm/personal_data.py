"""Personal data by weak supervision: labelers vote, EM weighs them, a span classifier decides.

Base spans (strict patterns with length, range and Luhn checks) always stay. Further candidates come
from looser patterns (e-mail addresses with "at" and "dot" in brackets, IPv6 addresses in full or
shortened, cards of 13 to 15 digits, national phone numbers) and from cues: a context word of phones or
cards proposes the digits after it, however they are grouped. Five labelers vote +1, -1 or 0 (abstain) on every candidate
and base span: strict pattern, checksum or plausible range, gazetteer, context words nearby, clean
edges. Votes and features are few small numbers, so their patterns are counted over the whole corpus
in one aggregate (at most ``4 * 3**5 * 2**6`` rows, whatever the corpus). Expectation-maximisation on
these counts estimates how often each labeler votes each way for real and for false spans; the
posteriors are the labels of a logistic regression on the spans' features, which decides on each
candidate outside the base spans.

Plan: one pass over the texts (texts without a digit, ``@`` or opening bracket are skipped by byte
counts), whose small rows are written; one aggregate; one pass over the small rows. No shuffle of
texts. All searches are linear in the text, also in long runs of one character.

Edge cases: a null or empty text has no spans; the local part of a bracketed address has at most 64
characters and its domain five parts (as addresses may have); a null ``doc_id`` is a row like any other; rows that repeat a ``doc_id`` are judged each; extra
columns are ignored; without candidates nothing is fitted and only base spans are returned.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailsync.llm import textbatch as T
from mailsync.llm.frames import id_text, written

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
ACCEPT = 0.5          # probability from which the classifier adds a candidate
CONTEXT_CHARS = 40    # how far before a span the context labeler looks
EM_STEPS = 30

# Context words by kind, and the gazetteers of the third labeler.
CONTEXT = (
    ("mail", "e-mail", "email", "contact", "write", "kontakt", "correo", "courriel", "contacto"),
    ("ip", "host", "server", "address", "login", "adresse", "servidor", "serveur"),
    ("card", "visa", "mastercard", "amex", "credit", "karte", "carte", "tarjeta", "payment"),
    ("phone", "tel", "call", "fax", "mobile", "telefon", "anruf", "appel", "llamar", "cell"),
)
TOP_DOMAINS = frozenset("com org net edu gov io de fr es uk eu info biz us ca ch at nl it".split())
CARD_PREFIXES = ("34", "37", "36", "38", "30", "4", "51", "52", "53", "54", "55", "6011", "65", "35", "22")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGITS = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SPOKEN_EMAIL = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?[\[(] ?(?:at|AT) ?[\])] ?[A-Za-z0-9-]{1,63}"
    r"(?: ?(?:[\[(] ?(?:dot|DOT) ?[\])]|\.) ?[A-Za-z0-9-]{1,63}){1,4}")
_HEX_GROUPS = re.compile(r"(?<![0-9A-Za-z:.])[0-9A-Fa-f:]++(?![0-9A-Za-z:])")
_CUED = {kind: re.compile(r"(?i)(?<![A-Za-z])(?:" + "|".join(map(re.escape, CONTEXT[kind])) + r")(?![A-Za-z])[^0-9A-Za-z\n]{0,12}?"
                          r"(?:[A-Za-z]{1,12}[^0-9A-Za-z\n]{1,4}?){0,2}(\(?[0-9][0-9 ()/.-]{4,30}[0-9])(?![0-9])") for kind in (CARD, PHONE)}
_NATIONAL_PHONE = re.compile(r"(?<![0-9+])(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?![0-9])")
_MAY_HOLD = np.isin(np.arange(256), [ord(c) for c in "0123456789@[("])


def luhn(digits: str) -> bool:
    total = 0
    for n, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if n % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Found from each ``@`` outwards, which is linear however long the runs around it are."""
    out, low, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > low and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        low = domain.end() if domain else at + 1
        if domain:
            out.append((start, low))
        at = text.find("@", low)
    return out


def ips(text: str) -> list[tuple[int, int]]:
    """Four digit runs joined by single dots; runs are visited once."""
    runs = [m.span() for m in _DIGITS.finditer(text)]
    out, i = [], 0
    while i + 3 < len(runs):
        four = runs[i:i + 4]
        if all(b[0] == a[1] + 1 and text[a[1]] == "." for a, b in zip(four, four[1:], strict=False)):
            parts = (text[s:e].lstrip("0") for s, e in four)
            if all(len(x) <= 3 and int(x or 0) <= 255 for x in parts):
                out.append((four[0][0], four[3][1]))
            i += 4
        else:
            i += 1
    return out


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` by kind, then start."""
    out = [(EMAIL, s, e) for s, e in emails(text)] + [(IP, s, e) for s, e in ips(text)]
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((CARD, *m.span()))
    out.extend((PHONE, *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m.group())) <= 15)
    return out


def loose_spans(text: str) -> list[tuple[int, int, int]]:
    """Candidates of the looser patterns."""
    out = []
    if "[" in text or "(" in text:
        out.extend((EMAIL, *m.span()) for m in _SPOKEN_EMAIL.finditer(text))
    if ":" in text:
        out.extend((IP, *m.span()) for m in _HEX_GROUPS.finditer(text) if ":" in m.group() and is_ipv6(m.group()))
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 13 <= len(digits) <= 15 and luhn(digits):
            out.append((CARD, *m.span()))
    out.extend((PHONE, *m.span()) for m in _NATIONAL_PHONE.finditer(text))
    for kind, (least, most) in ((CARD, (13, 19)), (PHONE, (8, 15))):
        out.extend((kind, *m.span(1)) for m in _CUED[kind].finditer(text) if least <= len(_digits(m.group(1))) <= most)
    return out


def is_ipv6(text: str) -> bool:
    """Eight groups of up to four hexadecimal digits, or fewer around one ``::``; with a digit, so no words."""
    groups = text.split(":")
    if len(groups) > 9 or any(len(g) > 4 for g in groups) or not any("0" <= c <= "9" for c in text):
        return False
    if "::" not in text:
        return len(groups) == 8 and all(groups)
    head, _, tail = text.partition("::")
    ends = [*head.split(":")] * bool(head) + [*tail.split(":")] * bool(tail)
    return "::" not in tail and not tail.startswith(":") and all(ends) and 1 < len(ends) <= 7


def votes_and_features(text: str, kind: int, start: int, end: int, is_base: bool) -> tuple[int, int]:
    """The five votes as base-3 digits (0: -1, 1: abstain, 2: +1) and six feature bits."""
    span = text[start:end]
    digits = _digits(span)
    before = text[max(0, start - CONTEXT_CHARS):start].lower()
    cue = any(w in before for w in CONTEXT[kind])
    other = any(w in before for k in range(4) if k != kind for w in CONTEXT[k][:2])
    clean = not (start and text[start - 1].isalnum()) and not (end < len(text) and text[end].isalnum())
    if kind == EMAIL:
        checked, listed = len(span) <= 254, re.split(r"[^A-Za-z]+", span.rstrip("])"))[-1].lower() in TOP_DOMAINS
    elif kind == IP:
        checked, listed = True, span.startswith(("10.", "192.168.", "127.", "2001:", "fe80:"))
    elif kind == CARD:
        checked, listed = luhn(digits), digits.startswith(CARD_PREFIXES)
    else:
        checked, listed = 8 <= len(digits) <= 15, digits.startswith("1") or digits[-7:-4] == "555"
    repeated = len(digits) >= 8 and len(set(digits)) <= 2
    votes = (2 if is_base else 1, 2 if checked else 0, 2 if listed else 1, 2 if cue else 0 if other else 1,
             2 if clean and not repeated else 0)
    features = (is_base, checked, listed, cue, clean, repeated)
    return sum(v * 3 ** n for n, v in enumerate(votes)), sum(bool(f) << n for n, f in enumerate(features))


def find_spans(text: str) -> list[tuple[int, int, int, bool, int, int]]:
    """Base spans, then candidates that overlap no base span and no earlier candidate."""
    base = base_spans(text)
    found = [(k, s, e, True, *votes_and_features(text, k, s, e, True)) for k, s, e in base]
    taken = sorted((s, e) for _, s, e in base)
    low, i = 0, 0
    for kind, start, end in sorted(loose_spans(text), key=lambda x: (x[1], x[0])):
        while i < len(taken) and taken[i][0] < end:
            low = max(low, taken[i][1])
            i += 1
        if start >= low:
            found.append((kind, start, end, False, *votes_and_features(text, kind, start, end, False)))
            low = end
    return found


_SPANS = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()),
                             ("votes", pa.int32()), ("features", pa.int32())]))
SPANS_DDL = "array<struct<kind:int,start:long,end:long,base:boolean,votes:int,features:int>>"


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.name for f in _SPANS.value_type]
    for batch in batches:
        raw, offsets = T.text_bytes(batch.column("text"))
        texts = batch.column("text")
        rows: list[list] = [[] for _ in range(len(batch))]
        for i in np.flatnonzero(T.row_sums(_MAY_HOLD[raw], offsets)):
            rows[i] = [dict(zip(names, x, strict=True)) for x in find_spans(texts[int(i)].as_py())]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, _SPANS)], ["doc_id", "spans"])


def estimate_reliabilities(votes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """EM over vote patterns: each pattern's probability of being real, and the labelers' vote rates.

    ``votes`` is patterns by labelers with values 0, 1, 2; the rates are class by labeler by vote.
    """
    lean = (votes - 1).sum(axis=1)
    real = 1 / (1 + np.exp(-lean.astype(float)))
    hot = votes[:, :, None] == np.arange(3)
    rates = np.zeros((2, votes.shape[1], 3))
    for _ in range(EM_STEPS):
        weight = np.stack([(1 - real) * counts, real * counts])
        rates = np.einsum("cp,plv->clv", weight, hot) + np.array([[1.0, 1.0, 0.5], [0.5, 1.0, 1.0]])[:, None, :]
        rates /= rates.sum(axis=2, keepdims=True)
        prior = np.log((weight.sum(axis=1) + 1) / (weight.sum() + 2))
        score = prior + np.einsum("plv,clv->pc", hot, np.log(rates))
        real = 1 / (1 + np.exp(np.clip(score[:, 0] - score[:, 1], -50, 50)))
    return real, rates


def train_classifier(design: np.ndarray, real: np.ndarray, counts: np.ndarray, steps: int = 400) -> np.ndarray:
    """Logistic regression of the posteriors on the features, weighted by counts, with a ridge."""
    weights = np.zeros(design.shape[1])
    share = counts / counts.sum()
    for _ in range(steps):
        guess = 1 / (1 + np.exp(-design @ weights))
        weights += 2.0 * (design.T @ (share * (real - guess)) - 1e-3 * weights)
    return weights


def _design(kind: np.ndarray, features: np.ndarray) -> np.ndarray:
    bits = (features[:, None] >> np.arange(6)) & 1
    return np.concatenate([kind[:, None] == np.arange(4), bits], axis=1).astype(float)


def fit(found: DataFrame) -> np.ndarray | None:
    """Classifier weights from the vote and feature patterns of all spans; None without spans."""
    patterns = (found.select(F.explode("spans").alias("x")).groupBy("x.kind", "x.votes", "x.features")
                .agg(F.count(F.lit(1)).alias("n")).orderBy("kind", "votes", "features").toPandas())
    if patterns.empty:
        return None
    votes = (patterns["votes"].to_numpy()[:, None] // 3 ** np.arange(5)) % 3
    counts = patterns["n"].to_numpy(dtype=float)
    real, _ = estimate_reliabilities(votes, counts)
    return train_classifier(_design(patterns["kind"].to_numpy(), patterns["features"].to_numpy()), real, counts)


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id``, base counts, ``base_sha256``, ``spans`` and ``n_added`` of every document."""
    found = written(id_text(docs).mapInArrow(_search, f"doc_id long, spans {SPANS_DDL}"), "op9-spans")
    weights = fit(found)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, hashes, joined, added = [], [], [], []
            for spans in batch.column("spans").to_pylist():
                base = [(x["kind"], x["start"], x["end"]) for x in spans if x["base"]]
                loose = [x for x in spans if not x["base"]]
                more = []
                if loose and weights is not None:
                    design = _design(np.array([x["kind"] for x in loose]), np.array([x["features"] for x in loose]))
                    good = 1 / (1 + np.exp(-design @ weights)) >= ACCEPT
                    more = [(x["kind"], x["start"], x["end"]) for x, g in zip(loose, good, strict=True) if g]
                counts.append([sum(k == kind for k, _, _ in base) for kind in range(4)])
                hashes.append(sha256(_joined(base).encode()).hexdigest())
                joined.append(_joined(base + more))
                added.append(len(more))
            table = np.array(counts, np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(table[:, k]) for k in range(4)), pa.array(hashes, pa.string()),
                 pa.array(joined, pa.string()), pa.array(added, pa.int64())],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])

    return found.mapInArrow(decide, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
                                    "base_sha256 string, spans string, n_added long")
