"""Toxicity (operator 1): a linear-chain conditional random field tags toxic spans.

Training, on a bounded sample of labelled rows (per class ``SAMPLE_ROWS`` texts
of up to ``SAMPLE_BYTES`` each and ``SAMPLE_TOTAL`` together; all are
parameters). Rows are chosen by a hash of their id, one text an id:

1. Token labels come from the document labels. A token form (word, beginning
   or end of a word) is a sign of toxicity if its rate in toxic texts is at
   least ``SIGN_PRECISION`` of the sum of its rates in toxic and clean texts,
   and enough toxic documents hold it, near-equal documents counting once. In
   toxic documents the tokens that carry a sign are labelled toxic.
2. The chain's weights (token forms, a bias, transitions between the two tags)
   maximise the likelihood of those tags, with forward-backward gradients.
   They are fitted on stretches of ``CHAIN`` tokens: all with a sign, and as
   many without one, drawn at random.
3. A logistic model maps a document's marginals to its score.

Scoring runs over every whole text as one chain. It is worked off in stretches
of ``CHAIN`` tokens: the product of each stretch's transfer matrices carries
the forward and backward messages from one stretch to the next, so marginals do
not depend on where a stretch ends. A document's score comes from the sum and
maximum of its marginals. Neighbouring tokens with a marginal of at least one
half make a span, in code points.

Cases: an empty or null text has no token; it is scored from the bias alone.
A null id is in no training row and counts as not held out. Labels of a
repeated id count once, toxic if any row says so; null labels are left out.
Of the texts of a repeated id the least by hash is trained on.
Without labelled rows of both classes every score is 0. An empty table gives
an empty result. Language, source, ids and labels are not read when scoring.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import ship_package, text_of, whole_row
from quayside.llm.words import U64, Words, grams, mix, words

SAMPLE_ROWS = 1500
SAMPLE_BYTES = 200_000
SAMPLE_TOTAL = 2_000_000   # bytes per class
PLAIN_CHAINS = 200         # stretches without a sign that training takes at least
CHAIN = 64
SIGN_PRECISION = 0.92
MIN_SIGN_DOCUMENTS = 3
MIN_SIGN_SHARE = 0.015
MOST_PER_DOCUMENT = 3
MAX_SIGNS = 2000
STEPS = 80
SEED = 3
FORMS = (("whole", None, None), ("first4", 4, None), ("first5", 5, None), ("first6", 6, None), ("last4", None, 4))


def token_forms(w: Words) -> np.ndarray:
    """Hashes of each token's forms: one column per entry of FORMS."""
    return np.stack([mix(w.hashes(longest, last) ^ U64(k + 1)) for k, (_, longest, last) in enumerate(FORMS)], axis=1)


def column_of(texts: list[str]) -> pa.Array:
    return pa.array(texts, pa.string())


@dataclass
class Chain:
    """Emission weights by form, the bias of the toxic tag, and transition weights [from, to]."""
    keys: np.ndarray
    weights: np.ndarray
    bias: float
    moves: np.ndarray

    def emissions(self, forms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score of the toxic tag per token, and whether the token has a known form."""
        score = np.full(len(forms), self.bias)
        known = np.zeros(len(forms), dtype=bool)
        if not len(self.keys):
            return score, known
        near = np.zeros(1 << 16, dtype=bool)
        near[(self.keys & U64(0xFFFF)).astype(np.int64)] = True
        for k in range(forms.shape[1]):
            rows = np.flatnonzero(near[(forms[:, k] & U64(0xFFFF)).astype(np.int64)])
            at = np.searchsorted(self.keys, forms[rows, k])
            hit = np.take(self.keys, at, mode="clip") == forms[rows, k]
            score[rows[hit]] += self.weights[at[hit]]
            known[rows[hit]] = True
        return score, known


def forward_backward(score: np.ndarray, length: np.ndarray, moves: np.ndarray, ahead_in: np.ndarray | None = None,
                     back_in: np.ndarray | None = None):
    """Marginals of the toxic tag and expected moves, for chains padded to the same width.

    ``score`` is (chains, width); ``length`` says how much of each is used.
    ``ahead_in`` and ``back_in`` (chains, 2) are the messages from the tokens
    before and after a chain; without them it stands alone.
    """
    n, width = score.shape
    toxic = np.exp(np.clip(score, -30, 30))
    step = np.exp(moves)
    ahead = np.zeros((width, n, 2))
    state = np.ones((n, 2)) if ahead_in is None else ahead_in.copy()
    state[:, 1] *= toxic[:, 0]
    state /= state.sum(axis=1, keepdims=True)
    ahead[0] = state
    for t in range(1, width):
        new = state @ step
        new[:, 1] *= toxic[:, t]
        new /= new.sum(axis=1, keepdims=True)
        state = np.where((t < length)[:, None], new, state)
        ahead[t] = state
    marginal = np.zeros((n, width))
    moved = np.zeros((2, 2))
    back = np.full((n, 2), 0.5) if back_in is None else back_in
    for t in range(width - 1, -1, -1):
        used = t < length
        both = ahead[t] * back
        both /= both.sum(axis=1, keepdims=True)
        marginal[:, t] = np.where(used, both[:, 1], 0)
        if t:
            after = back.copy()
            after[:, 1] *= toxic[:, t]
            pair = ahead[t - 1][:, :, None] * step[None] * after[:, None, :]
            pair /= pair.sum(axis=(1, 2), keepdims=True)
            moved += pair[used].sum(axis=0)
            before = after @ step.T
            before /= before.sum(axis=1, keepdims=True)
            back = np.where(used[:, None], before, back)
    return marginal, moved


def chains(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First token and length of each stretch of at most CHAIN tokens; none crosses a document."""
    counts = -(-np.diff(first) // CHAIN)
    n = int(counts.sum())
    place = np.arange(n) - np.repeat(np.cumsum(counts) - counts, counts)
    start = np.repeat(first[:-1], counts) + place * CHAIN
    return start, np.minimum(CHAIN, np.repeat(first[1:], counts) - start)


def padded(values: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    at = start[:, None] + np.arange(CHAIN)[None]
    inside = np.arange(CHAIN)[None] < length[:, None]
    return np.where(inside, values[np.minimum(at, max(len(values) - 1, 0))], 0)


def transfers(score: np.ndarray, length: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Per chain the 2 x 2 product of its emissions and the moves between them, up to a factor."""
    step, toxic = np.exp(moves), np.exp(np.clip(score, -30, 30))
    out = np.zeros((len(score), 2, 2))
    out[:, 0, 0], out[:, 1, 1] = 1, toxic[:, 0]
    for t in range(1, score.shape[1]):
        new = out @ step
        new[:, :, 1] *= toxic[:, t, None]
        new /= new.sum(axis=(1, 2), keepdims=True)
        out = np.where((t < length)[:, None, None], new, out)
    return out


def carried(transfer: np.ndarray, counts: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The messages into each stretch from before and after it; ``counts`` says how many each document has."""
    step = np.exp(moves)
    ahead, back = np.ones((len(transfer), 2)), np.ones((len(transfer), 2))
    head = np.cumsum(counts) - counts
    order = np.argsort(-counts, kind="stable")
    longer = np.searchsorted(-counts[order], -np.arange(1, int(counts.max(initial=0)) + 1), side="right")
    for j in range(1, len(longer)):   # all documents with more than j stretches at once
        of = order[:longer[j]]
        at = head[of] + j
        new = np.einsum("na,nab->nb", ahead[at - 1], transfer[at - 1]) @ step
        ahead[at] = new / new.sum(axis=1, keepdims=True)
        at = head[of] + counts[of] - 1 - j
        new = np.einsum("nab,nb->na", transfer[at + 1], back[at + 1]) @ step.T
        back[at] = new / new.sum(axis=1, keepdims=True)
    return ahead, back


def token_marginals(model: Chain, forms: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Marginal of the toxic tag per token; each document is one chain."""
    score, known = model.emissions(forms)
    start, length = chains(first)
    out = np.zeros(len(forms))
    if not len(start):
        return out
    held = np.concatenate([[0], np.cumsum(known)])
    some = held[start + length] > held[start]
    # Powers of the move of a token without a known form: stretches of such tokens need no loop.
    plain = transfers(np.full((CHAIN, CHAIN), model.bias), np.arange(1, CHAIN + 1), model.moves)
    transfer = plain[length - 1]
    if some.any():
        marked = padded(score, start[some], length[some])
        transfer[some] = transfers(marked, length[some], model.moves)
    ahead, back = carried(transfer, -(-np.diff(first) // CHAIN), model.moves)
    marginals = np.zeros((len(start), CHAIN))
    if some.any():
        marginals[some], _ = forward_backward(marked, length[some], model.moves, ahead[some], back[some])
    rest = np.flatnonzero(~some)
    for size in np.unique(length[rest]):
        at = rest[length[rest] == size]
        until = np.einsum("na,tab->ntb", ahead[at], plain[:size])
        step = np.exp(model.moves)
        tail = np.concatenate([np.einsum("ab,tbc->tac", step, plain[:size - 1])[::-1], np.eye(2)[None]])
        both = until * np.einsum("tab,nb->nta", tail, back[at])
        marginals[at, :size] = both[:, :, 1] / both.sum(axis=2)
    inside = np.arange(CHAIN)[None] < length[:, None]
    out[(start[:, None] + np.arange(CHAIN)[None])[inside]] = marginals[inside]
    return out


def document_features(marginal: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per document: 1, log(1 + sum of marginals), maximum, log(1 + marginals in a thousand tokens)."""
    n = len(first) - 1
    doc = np.repeat(np.arange(n), np.diff(first))
    most = np.zeros(n)
    np.maximum.at(most, doc, marginal)
    total = np.bincount(doc, weights=marginal, minlength=n)
    return np.stack([np.ones(n), np.log1p(total), most, np.log1p(1000 * total / (np.diff(first) + 100))], axis=1)


@dataclass
class Model:
    chain: Chain
    document: np.ndarray

    def scores(self, marginal: np.ndarray, first: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(document_features(marginal, first) @ self.document, -30, 30)))


def near_equal_groups(hashes: list[np.ndarray], bands: int = 8) -> np.ndarray:
    """Group number per sampled document: a document joins the earlier one that has the same smallest
    five-word hash in at least half of the bands."""
    parent = list(range(len(hashes)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    seen: dict = {}
    for i, h in enumerate(hashes):
        runs = grams(h, min(5, max(len(h), 1)))
        shared: dict = defaultdict(int)
        for band in range(bands if len(runs) else 0):
            key = (band, int(mix(runs ^ U64(band * 7919 + 1)).min()))
            shared[seen.setdefault(key, i)] += 1
        for j, n in shared.items():
            if j != i and 2 * n >= bands:
                parent[root(i)] = root(j)
    return np.array([root(i) for i in range(len(hashes))])


def pick_signs(forms: np.ndarray, doc: np.ndarray, toxic: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Token forms that mark toxic documents, see the module's text. One kind of form at a time, to bound memory."""
    signs, held_by = [], []
    enough = max(MIN_SIGN_DOCUMENTS, MIN_SIGN_SHARE * len(set(group[toxic == 1])))
    for keys in forms.T:
        form, at = np.unique(keys, return_inverse=True)
        pair, times = np.unique(at * len(toxic) + doc, return_counts=True)
        at, owner, times = pair // len(toxic), pair % len(toxic), np.minimum(times, MOST_PER_DOCUMENT)
        bad = toxic[owner] == 1
        used = [np.bincount(at[of], weights=times[of], minlength=len(form)) / max(int((toxic == y).sum()), 1)
                for y, of in ((0, ~bad), (1, bad))]
        likely = used[1] >= SIGN_PRECISION * (used[0] + used[1])
        # Toxic groups that hold the form.
        held = bad & likely[at]
        pairs = np.unique(at[held] * len(toxic) + group[owner[held]])
        n_groups = np.bincount(pairs // len(toxic), minlength=len(form))
        taken = np.flatnonzero(likely & (n_groups >= enough))
        signs.append(form[taken])
        held_by.append(n_groups[taken])
    signs, held_by = np.concatenate(signs), np.concatenate(held_by)
    return np.sort(signs[np.argsort(-held_by, kind="stable")][:MAX_SIGNS])


def train(rows: list[tuple[str, int]]) -> Model | None:
    """Fit on (text, toxic) rows; None without rows of both classes."""
    toxic = np.array([y for _, y in rows], dtype=np.int64)
    if len(set(toxic.tolist())) < 2:
        return None
    forms, first, whole = [], [0], []
    for w in words(column_of([t for t, _ in rows]), lower=True, letters=True):
        forms.append(token_forms(w))
        whole += np.split(w.hashes(), w.first[1:-1])
        first += (w.first[1:] + first[-1]).tolist()
    forms, first = np.concatenate(forms), np.array(first)
    doc = np.repeat(np.arange(len(rows)), np.diff(first))
    signs = pick_signs(forms, doc, toxic, near_equal_groups(whole))
    marked = np.isin(forms, signs).any(axis=1)
    tag = (marked & (toxic[doc] == 1)).astype(float)
    # Weights for every form of a marked token; other tokens share the bias.
    keys = np.unique(forms[marked]) if marked.any() else np.zeros(0, dtype=U64)
    chain = fit_chain(keys, forms, first, tag, marked)
    marginal = token_marginals(chain, forms, first)
    return Model(chain, fit_logistic(document_features(marginal, first), toxic))


def fit_chain(keys, forms, first, tag, marked) -> Chain:
    start, length = chains(first)
    held = np.concatenate([[0], np.cumsum(marked)])
    with_marks = held[start + length] > held[start]
    # Every chain with a marked token, and as many others for the bias.
    others = np.random.default_rng(SEED).permutation(np.flatnonzero(~with_marks))
    take = np.sort(np.concatenate([np.flatnonzero(with_marks), others[:max(PLAIN_CHAINS, int(with_marks.sum()))]]))
    start, length = start[take], length[take]
    tags = padded(tag, start, length)
    inside = np.arange(CHAIN)[None] < length[:, None]
    tokens = (start[:, None] + np.arange(CHAIN)[None])[inside]
    at = np.searchsorted(keys, forms[tokens])
    known = np.take(keys, at, mode="clip") == forms[tokens] if len(keys) else np.zeros(at.shape, dtype=bool)
    row, col = np.nonzero(known)
    column = at[row, col]
    gold_moves = np.zeros((2, 2))
    t = tags.astype(int)
    for a in range(2):
        for b in range(2):
            gold_moves[a, b] = ((t[:, :-1] == a) & (t[:, 1:] == b) & inside[:, 1:]).sum()
    weights, bias, moves = np.zeros(len(keys)), -6.0, np.zeros((2, 2))
    square = [np.full(len(keys), 1e-6), 1e-6, np.full((2, 2), 1e-6)]
    for _ in range(STEPS):
        flat = np.full(len(tokens), bias)
        np.add.at(flat, row, weights[column])
        score = np.zeros(inside.shape)
        score[inside] = flat
        marginal, moved = forward_backward(score, length, moves)
        rest = (tags - marginal)[inside]
        steps = [np.bincount(column, weights=rest[row], minlength=len(keys)) - 0.02 * weights,
                 rest.sum() - 0.02 * bias, gold_moves - moved - 0.02 * moves]
        for k, g in enumerate(steps):
            square[k] = square[k] + g * g
        weights = weights + 0.5 * steps[0] / np.sqrt(square[0])
        bias = bias + 0.5 * steps[1] / np.sqrt(square[1])
        moves = moves + 0.5 * steps[2] / np.sqrt(square[2])
    return Chain(keys, weights, float(bias), moves)


def fit_logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps."""
    beta = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (y - p) - 0.01 * beta
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(x.shape[1])
        beta = beta + np.clip(np.linalg.solve(hessian, gradient), -5, 5)
    return beta


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
_SCORED = pa.schema([("score", pa.float64()), ("spans", pa.list_(_SPAN))])
SCORED = "score double, spans array<struct<start:bigint,end:bigint,score:double>>"


def spans_of(w: Words, marginal: np.ndarray) -> list[list[dict]]:
    """Runs of neighbouring toxic tokens per text, in code points."""
    out: list[list[dict]] = [[] for _ in range(len(w))]
    hit = np.flatnonzero(marginal >= 0.5)
    if not len(hit):
        return out
    place = np.concatenate([[0], np.cumsum((w.data & 0xC0) != 0x80)])
    text = np.searchsorted(w.first, hit, side="right") - 1
    breaks = np.flatnonzero((np.diff(hit) != 1) | (np.diff(text) != 0)) + 1
    for run in np.split(np.arange(len(hit)), breaks):
        a, b, t = hit[run[0]], hit[run[-1]], int(text[run[0]])
        zero = place[w.offset[t]]
        out[t].append({"start": int(place[w.start[a]] - zero), "end": int(place[w.end[b]] - zero),
                       "score": float(marginal[hit[run]].max())})
    return out


def _score(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, spans = [], []
            if model is None:
                scores, spans = [0.0] * batch.num_rows, [[]] * batch.num_rows
            else:
                for w in words(batch.column(0), lower=True, letters=True):
                    marginal = token_marginals(model.chain, token_forms(w), w.first)
                    scores += model.scores(marginal, w.first).tolist()
                    spans += spans_of(w, marginal)
            yield pa.record_batch([*batch.columns[1:], pa.array(scores, pa.float64()),
                                   pa.array(spans, pa.list_(_SPAN))],
                                  schema=pa.schema([*list(batch.schema)[1:], *_SCORED]))
    return run


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, max_bytes: int = SAMPLE_BYTES,
                  total_bytes: int = SAMPLE_TOTAL) -> list[tuple[str, int]]:
    """Per class at most ``rows`` labelled texts of ``total_bytes`` together that are not held out, by a hash of the id."""
    known = (labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    order = F.xxhash64("doc_id", F.lit("sample"))
    picked = [known.where(F.col("toxic") == y).orderBy(order, "doc_id").limit(rows) for y in (0, 1)]
    # Two times ``rows`` ids at most, so the broadcast is bounded.
    chosen = F.broadcast(picked[0].unionByName(picked[1]))
    texts = docs.select("doc_id", text_of(docs).alias("text")).where(F.octet_length("text") <= max_bytes)
    least = F.min(F.struct(F.xxhash64("text").alias("hash"), F.col("text").alias("text")))["text"]
    one = texts.join(chosen, "doc_id").groupBy("doc_id", "toxic").agg(least.alias("text"))
    sizes = Window.partitionBy("toxic").orderBy(order, "doc_id")
    kept = one.withColumn("until", F.sum(F.octet_length("text")).over(sizes)).where(F.col("until") <= total_bytes)
    return [(r["text"], r["toxic"]) for r in kept.select("doc_id", "text", "toxic").orderBy("doc_id").collect()]


def score_toxicity(docs: DataFrame, labels: DataFrame, row: Column | None = None, rows: int = SAMPLE_ROWS,
                   max_bytes: int = SAMPLE_BYTES, total_bytes: int = SAMPLE_TOTAL) -> DataFrame:
    """``row``, ``score`` and ``spans`` per document; ``row`` is the whole input row if not given."""
    ship_package(docs.sparkSession)
    model = train(training_rows(docs, labels, rows, max_bytes, total_bytes))
    table = docs.select(text_of(docs).alias("text"), (whole_row(docs) if row is None else row).alias("row"))
    kind = table.schema["row"].dataType.simpleString()
    return table.mapInArrow(_score(model), f"row {kind}, {SCORED}")


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **kwargs) -> DataFrame:
    """``docs`` without the documents scored at ``threshold`` or above, all columns kept."""
    return score_toxicity(docs, labels, **kwargs).where(F.col("score") < threshold).select("row.*")
