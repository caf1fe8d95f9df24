"""Personal data (operator 8): labelers vote, expectation-maximisation weighs them, a classifier decides.

1. One pass over every whole text finds candidates: the fixed patterns of the
   contract (base spans, which always stay) and looser ones (spelt-out or
   spaced e-mail addresses, telephone numbers without a plus sign, addresses
   or card numbers in other groupings). Each labeler votes yes, no or nothing
   on a candidate: pattern labelers (strict form, check digit, number ranges),
   gazetteer labelers (top-level domains, telephone and card words) and context
   labelers (words just before, neighbouring signs).
2. Candidates are counted by kind and vote pattern over the whole corpus. There
   are at most 3 ** labelers patterns a kind, so their counts are small however
   many candidates there are.
3. Expectation-maximisation over those counts estimates each labeler's
   reliability and each pattern's probability of being personal data.
4. A logistic span classifier is trained on the patterns, weighted by counts,
   towards those probabilities. Looser candidates that it scores at
   ``THRESHOLD`` or above, and that touch no base span, are added.

Cases: a null text is empty. A text without candidates has no spans. Equal
spans of one kind count once; the leftmost, then longest candidate wins an
overlap. Rows that repeat an id are searched one by one. An empty table gives
an empty result. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import Stager, ship_package, text_of

KINDS = ("email", "ip", "card", "phone")
THRESHOLD = 0.9
ROUNDS = 50

# Fixed patterns of the contract.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
# Looser candidates.
_SPELT = re.compile(r"\b[A-Za-z0-9._%+-]{1,64}\s?[\[({]\s?at\s?[\])}]\s?[A-Za-z0-9-]{1,63}"
                    r"(?:\s?(?:\.|[\[({]\s?dot\s?[\])}])\s?[A-Za-z0-9-]{1,63}){1,4}", re.I)
_BRACKETED = re.compile(r"[\[({]\s?at\s?[\])}]", re.I)
_WORDED = re.compile(r"\b[A-Za-z0-9._%+-]{1,64}\sat\s[A-Za-z0-9-]{1,63}(?:\sdot\s[A-Za-z0-9-]{1,63}){1,4}", re.I)
_DOT = re.compile(r"\sdot\s", re.I)
# White space on both sides of a dot or on none, so that the end of a sentence is no dot of a domain.
_SPACED = re.compile(r"\b[A-Za-z0-9._%+-]{1,64}\s?@\s?[A-Za-z0-9-]{1,63}(?:(?:\.|\s\.\s)[A-Za-z0-9-]{1,63}){1,4}")
_LOOSE_PHONE = re.compile(r"(?<![\w+.-])(?:\+?[0-9]{1,3}[\x20.-])?\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![\w-]|\.[0-9])")
_LOOSE_CARD = re.compile(r"(?<![\w.])[0-9]{4}(?:[._/]?[0-9]{4}){3}(?![\w])")
_LOOSE_IP = re.compile(r"(?<![\w.])[0-9]{1,3}(?:\s?\[\.\]\s?[0-9]{1,3}){3}(?![\w])")
# Gazetteers: fixed words, small and readable.
TOP_LEVEL = frozenset("com org net edu gov int io info biz de fr es it uk us eu ch at nl be pl pt se".split())
WORDS_BEFORE = {
    "email": frozenset("email e-mail mail contact write correo courriel".split()),
    "ip": frozenset("ip address host server from adresse".split()),
    "card": frozenset("card visa mastercard credit pay number karte carte tarjeta".split()),
    "phone": frozenset("phone tel telephone call mobile cell fax telefon teléfono téléphone".split()),
}


def luhn(digits: str) -> bool:
    odd = sum(int(d) for d in digits[-1::-2])
    even = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """The contract's spans per kind, leftmost and not overlapping, in code points."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    # An address is found from its @ sign: the characters before it, and the domain after.
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1)
        if start < at and domain:
            found["email"].append((start, domain.end()))
            free = domain.end()
        at = text.find("@", max(at + 1, free))
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p[-4:] if p.lstrip("0") else "0") <= 255
                   for p in m.group().split(".")):
                found["ip"].append(m.span())
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                found["card"].append(m.span())
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
                found["phone"].append(m.span())
    return found


def loose_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    email = found["email"]
    if _BRACKETED.search(text):
        email += [m.span() for m in _SPELT.finditer(text)]
    if _DOT.search(text):
        email += [m.span() for m in _WORDED.finditer(text)]
    if "@" in text:
        email += [m.span() for m in _SPACED.finditer(text)]
    email.sort(key=lambda span: (span[0], -span[1]))
    if _DIGIT.search(text):
        found["phone"] = [m.span() for m in _LOOSE_PHONE.finditer(text)]
        found["card"] = [m.span() for m in _LOOSE_CARD.finditer(text)]
        found["ip"] = [m.span() for m in _LOOSE_IP.finditer(text)]
    return found


LABELERS = ("form", "check", "gazetteer", "before", "edges", "spread")


def votes(kind: str, text: str, start: int, end: int) -> tuple[int, ...]:
    """1 yes, -1 no, 0 nothing, per labeler."""
    span = text[start:end]
    digits = "".join(c for c in span if "0" <= c <= "9")
    before = [w.strip(".,:;!?()[]\"'=").lower() for w in text[max(0, start - 48):start].split()[-3:]]
    edge = text[start - 1:start] + text[end:end + 1]
    if kind == "email":
        form = 1 if "@" in span and not any(c.isspace() for c in span) else 0
        last = re.split(r"\.|dot", span.lower())[-1].strip(" ])}")
        check = 1 if 2 <= len(last) <= 6 and last.isalpha() else -1
        gazetteer = 1 if last in TOP_LEVEL else 0
        spread = 1 if len(span) <= 80 else -1
    elif kind == "ip":
        parts = [int(p) for p in re.findall(r"[0-9]{1,9}", span)]
        form = 1 if "[" not in span else 0
        check = 1 if len(parts) == 4 and all(p <= 255 for p in parts) else -1
        gazetteer = -1 if parts and parts[0] in (0, 127, 255) else 0
        spread = 1 if len(set(parts)) > 2 else -1
    elif kind == "card":
        form = 1 if set(span) <= set("0123456789 -") else 0
        check = 1 if 16 <= len(digits) <= 19 and luhn(digits) else -1
        gazetteer = 1 if digits[:1] in tuple("3456") else -1
        spread = 1 if len(set(digits)) >= 4 else -1
    else:
        form = 1 if span[0] == "+" else 0
        check = 1 if 10 <= len(digits) <= 15 else -1
        gazetteer = 1 if re.match(r"\+?[0-9]{0,3}[\x20.-]?\(", span) else 0
        spread = 1 if len(set(digits)) >= 3 else -1
    context = 1 if any(w in WORDS_BEFORE[kind] for w in before) else 0
    edges = -1 if any(c.isalnum() or c in "_=\"/" for c in edge) else 1
    return form, check, gazetteer, context, edges, spread


def candidates(text: str) -> list[tuple[int, int, int, bool, str]]:
    """(kind, start, end, base, vote pattern) of a text; looser candidates touch no base span and no earlier one."""
    base = base_spans(text)
    taken = sorted(span for spans in base.values() for span in spans)
    out = [(k, a, b, True) for k, kind in enumerate(KINDS) for a, b in base[kind]]
    loose = loose_spans(text)
    for k, kind in enumerate(KINDS):
        for a, b in loose[kind]:
            if all(b <= x or y <= a for x, y in taken):
                taken.append((a, b))
                out.append((k, a, b, False))
    return [(k, a, b, is_base, "".join("-0+"[v + 1] for v in votes(KINDS[k], text, a, b)))
            for k, a, b, is_base in sorted(out)]


_CANDIDATE = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()),
                        ("pattern", pa.string())])
FOUND = "doc_id long, found array<struct<kind:int,start:bigint,end:bigint,base:boolean,pattern:string>>"


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.name for f in _CANDIDATE]
    for batch in batches:
        found = [[dict(zip(names, c)) for c in candidates(t.as_py())] for t in batch.column(1)]
        yield pa.record_batch([batch.column(0), pa.array(found, pa.list_(_CANDIDATE))], names=["doc_id", "found"])


def reliabilities(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS):
    """EM over vote patterns: prior, P(vote | class) per labeler, P(personal | pattern).

    The first column is the strict form; it starts as the only one trusted.
    """
    table = patterns + 1
    like = np.full((2, table.shape[1], 3), 1 / 3)
    like[1, :, 2] += 0.3
    like[0, :, 0] += 0.3
    like /= like.sum(axis=2, keepdims=True)
    prior = 0.5
    belief = np.full(len(table), prior)
    for _ in range(rounds):
        log = np.log(like)
        joint = np.stack([log[c, np.arange(table.shape[1]), table].sum(axis=1) for c in (0, 1)])
        joint += np.log([[1 - prior], [prior]])
        belief = 1 / (1 + np.exp(np.clip(joint[0] - joint[1], -50, 50)))
        for c, weight in ((0, counts * (1 - belief)), (1, counts * belief)):
            for k in range(table.shape[1]):
                got = np.bincount(table[:, k], weights=weight, minlength=3) + 1.0
                like[c, k] = got / got.sum()
        prior = float(np.clip((counts * belief).sum() / max(counts.sum(), 1), 0.01, 0.99))
    return prior, like, belief


def span_classifier(patterns: np.ndarray, counts: np.ndarray, belief: np.ndarray) -> np.ndarray:
    """Logistic weights (bias, one per labeler) towards the beliefs, weighted by counts."""
    x = np.column_stack([np.ones(len(patterns)), patterns])
    weight = counts / counts.sum()
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weight * (belief - p)) - 1e-3 * beta
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(beta))
        beta = beta + np.clip(np.linalg.solve(hessian, gradient), -3, 3)
    return beta


def accepted_patterns(seen: list[tuple[int, str, int]], threshold: float = THRESHOLD) -> set[tuple[int, str]]:
    """(kind, pattern) pairs whose looser candidates are taken as personal data."""
    taken = set()
    for kind in {k for k, _, _ in seen}:
        rows = [(p, n) for k, p, n in seen if k == kind]
        patterns = np.array([["-0+".index(c) - 1 for c in p] for p, _ in rows])
        counts = np.array([n for _, n in rows], dtype=float)
        _, _, belief = reliabilities(patterns, counts)
        beta = span_classifier(patterns, counts, belief)
        score = 1 / (1 + np.exp(-np.clip(np.column_stack([np.ones(len(rows)), patterns]) @ beta, -30, 30)))
        taken |= {(kind, p) for (p, _), s in zip(rows, score) if s >= threshold}
    return taken


def find_personal_data(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, base (base spans) and spans (all), each an array of (kind, start, end)."""
    spark = docs.sparkSession
    ship_package(spark)
    stage = Stager(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    found = stage(rows.mapInArrow(_find, FOUND), "candidates")
    # One row per kind and vote pattern: at most 4 * 3 ** 6.
    seen = (found.select(F.explode("found").alias("c")).groupBy("c.kind", "c.pattern")
            .agg(F.count(F.lit(1)).alias("n")).collect())
    taken = accepted_patterns([(r["kind"], r["pattern"], r["n"]) for r in seen], threshold)
    added = F.array(*[F.lit(f"{k}:{p}") for k, p in sorted(taken)]) if taken else F.array().cast("array<string>")
    kept = F.filter("found", lambda c: c["base"] | F.array_contains(
        added, F.concat_ws(":", c["kind"].cast("string"), c["pattern"])))

    def plain(spans):
        return F.transform(spans, lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"),
                                                     c["end"].alias("end")))

    return found.select("doc_id", plain(F.filter("found", lambda c: c["base"])).alias("base"),
                        plain(kept).alias("spans"))
