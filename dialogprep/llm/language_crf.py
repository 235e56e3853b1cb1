"""Languages of words and texts by a linear-chain CRF (operator 11).

Every word (a stretch of letters, lower-cased) is labelled with a language, so a
text may switch between languages. Emission weights belong to features of the
word: its prefixes and suffixes of up to 4 characters, its n-grams of 1 to 3
characters, and the word itself (the lexicon entry); learned transition and start weights
join the labels. Forward-backward gives each word's posterior; a text's language
has the largest share of its posteriors, each word counting by its letters.

Training, on the driver, takes a bounded sample: some ``per_lang`` documents of
each of the ``max_langs`` most frequent languages, ``max_words`` words of each
from a place given by the id's hash. Pieces of them are strung together into
code-switched sequences, so that transitions are learned too; the log-likelihood
is climbed by Adam on exact gradients. Scoring reads whole texts.

Forward-backward runs over all words of many documents as one chain, which
starts anew at each document. The chain is cut into blocks whose transfer
matrices are computed side by side; vectors through these then give every
block its exact messages, so long texts need no long loop.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
without any usable label every text is ``und`` with score 0; rows of one id with
several languages teach the smallest text's; ties go to the language that
sorts first; a null ``doc_id`` is neither held out nor learnt from; repeated
rows are labelled row by row; an empty table gives no rows; other columns than
``text`` are no inputs of a prediction. A text is handled whole by one task;
memory grows with its length.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialogprep.llm.common import arrow_map

UNKNOWN = "und"
SCHEMA = "doc_id long, lang_pred string, score double"
STRETCHES = "array<struct<lang:string,words:long>>"
_WORD = re.compile(r"[^\W\d_]+")
AFFIX, NGRAM = 4, 3
BUCKETS = 1 << 18
BLOCK = 128
# Characters of texts handled at once; distinct words that a worker keeps.
CHUNK_CHARS = 2 << 20
MAX_KNOWN = 400_000
MAX_HELD = 16 << 20


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature buckets of all words one after the other, and how many each
    word has. Buckets are hashes of the kind of feature and its characters."""
    size = np.array([len(w) for w in words], np.int64)
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    first = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(words)), size)
    left = size[owner] - (np.arange(len(flat)) - first[owner])  # characters to the word's end
    found, owners = [], []

    def take(kind: int, code: np.ndarray, of: np.ndarray) -> None:
        mixed = (code + np.uint64(kind)) * np.uint64(0x9E3779B97F4A7C15)
        found.append((mixed >> np.uint64(40)) % np.uint64(BUCKETS))
        owners.append(of)

    code = np.zeros(len(flat), np.uint64)
    padded = np.r_[flat, np.zeros(max(AFFIX, NGRAM), np.uint64)]
    for n in range(1, max(AFFIX, NGRAM) + 1):
        code = code * np.uint64(0x100000001B3) + padded[n - 1 : n - 1 + len(flat)] + np.uint64(1)
        fits = left >= n
        if n <= NGRAM:
            take(n, code[fits], owner[fits])
        if n <= AFFIX:
            long = np.flatnonzero(size >= n)
            take(16 + n, code[first[long]], long)
            take(32 + n, code[first[long] + size[long] - n], long)
    whole = np.array([zlib.crc32(w.encode()) for w in words], np.uint64)
    take(64, whole << np.uint64(8), np.arange(len(words)))
    owners, found = np.concatenate(owners), np.concatenate(found).astype(np.int64)
    order = np.argsort(owners, kind="stable")
    return found[order], np.bincount(owners, minlength=len(words))


def _per_word(weights: np.ndarray, found: np.ndarray, n_found: np.ndarray) -> np.ndarray:
    """Sum of the weights of each word's features."""
    if not len(n_found):
        return np.zeros((0, weights.shape[1]))
    return np.add.reduceat(weights[found], np.cumsum(n_found) - n_found, axis=0)


def messages(scores: np.ndarray, anew: np.ndarray, trans: np.ndarray, start: np.ndarray):
    """Forward and backward messages of a chain, each row up to a factor.

    ``scores[t]`` are the emission scores of word ``t``; where ``anew`` the
    chain starts again. Returns ``alpha`` (with the word's own emission),
    ``beta`` (without) and the scaled emissions.
    """
    n, k = scores.shape
    blocks = -(-n // BLOCK)
    e = np.ones((blocks * BLOCK, k))
    e[:n] = np.exp(scores - scores.max(axis=1, keepdims=True))
    again = np.ones(blocks * BLOCK, bool)
    again[:n] = anew
    e = np.ascontiguousarray(e.reshape(blocks, BLOCK, k).transpose(1, 0, 2))
    again = np.ascontiguousarray(again.reshape(blocks, BLOCK).T)
    step, first = np.exp(trans - trans.max()), np.exp(start - start.max())

    transfer = np.broadcast_to(np.eye(k), (blocks, k, k)).copy()
    for t in range(BLOCK):
        moved = (transfer.reshape(-1, k) @ step).reshape(blocks, k, k)
        at = np.flatnonzero(again[t])
        if at.size:
            moved[at] = transfer[at].sum(axis=2, keepdims=True) * first
        moved *= e[t][:, None, :]
        transfer = moved / moved.max(axis=(1, 2), keepdims=True)

    into, back = np.ones((blocks, k)), np.ones((blocks, k))
    for b in range(1, blocks):
        v = into[b - 1] @ transfer[b - 1]
        into[b] = v / v.max()
    for b in range(blocks - 1, 0, -1):
        v = transfer[b] @ back[b]
        back[b - 1] = v / v.max()

    alpha, beta = np.empty_like(e), np.empty_like(e)
    v = into
    for t in range(BLOCK):
        at = again[t][:, None]
        v = np.where(at, v.sum(axis=1, keepdims=True) * first, v @ step) * e[t]
        v /= v.max(axis=1, keepdims=True)
        alpha[t] = v
    v = back
    for t in range(BLOCK - 1, -1, -1):
        beta[t] = v
        own = v * e[t]
        v = np.where(again[t][:, None], own @ first[:, None], own @ step.T)
        v = v / v.max(axis=1, keepdims=True)

    def flat(x: np.ndarray) -> np.ndarray:
        return x.transpose(1, 0, 2).reshape(-1, k)[:n]

    return flat(alpha), flat(beta), flat(e)


def posteriors(scores: np.ndarray, anew: np.ndarray, trans: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Probability of each label for each word, given its whole chain."""
    if not len(scores):
        return scores
    alpha, beta, _ = messages(scores, anew, trans, start)
    p = alpha * beta
    return p / p.sum(axis=1, keepdims=True)


@dataclass
class Crf:
    """Weights of a chain; ``weights`` has one row per feature bucket."""

    langs: list[str]
    weights: np.ndarray
    trans: np.ndarray
    start: np.ndarray

    def emissions(self, words: list[str]) -> np.ndarray:
        return _per_word(self.weights, *features(words))


def fit(sequences: list[list[tuple[str, int]]], langs: list[str], steps: int = 20, rate: float = 0.1, ridge: float = 1e-6) -> Crf:
    """Climb the log-likelihood of labelled sequences of words."""
    k = len(langs)
    crf = Crf(langs, np.zeros((BUCKETS, k), np.float32), np.zeros((k, k)), np.zeros(k))
    sequences = [s for s in sequences if s]
    if not sequences or k == 0:
        return crf
    number: dict[str, int] = {}
    words = np.array([number.setdefault(w, len(number)) for s in sequences for w, _ in s])
    label = np.array([y for s in sequences for _, y in s])
    anew = np.zeros(len(words), bool)
    anew[np.cumsum([0] + [len(s) for s in sequences[:-1]])] = True
    found, n_found = features(list(number))
    used, found = np.unique(found, return_inverse=True)
    owner = np.repeat(np.arange(len(number)), n_found)
    truth = np.eye(k)[label]
    inner = np.flatnonzero(~anew)
    seen_steps = truth[inner - 1].T @ truth[inner]
    params = [np.zeros((len(used), k)), np.zeros((k, k)), np.zeros(k)]
    slow = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    for turn in range(1, steps + 1):
        emit, trans, start = params
        alpha, beta, e = messages(_per_word(emit, found, n_found)[words], anew, trans, start)
        p = alpha * beta
        p /= p.sum(axis=1, keepdims=True)
        both = e[inner] * beta[inner]
        step = np.exp(trans - trans.max())
        z = np.einsum("ti,ij,tj->t", alpha[inner - 1], step, both, optimize=True)
        expected = ((alpha[inner - 1] / z[:, None]).T @ both) * step
        error = truth - p
        by_word = np.stack([np.bincount(words, error[:, j], len(number)) for j in range(k)], 1)
        grad = [
            np.stack([np.bincount(found, by_word[owner, j], len(used)) for j in range(k)], 1) / len(words),
            (seen_steps - expected) / len(words),
            error[anew].sum(axis=0) / len(words),
        ]
        for q, g, (m, v) in zip(params, grad, slow):
            g -= ridge * q
            m += 0.1 * (g - m)
            v += 0.02 * (g * g - v)
            q += rate * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.98**turn)) + 1e-9)
    crf.weights[used] = params[0]
    crf.trans, crf.start = params[1], params[2]
    return crf


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0, F.lit(False))


def _strung(rows: list[tuple[int, int, list[str]]], piece: int, length: int) -> list[list[tuple[str, int]]]:
    """Code-switched sequences of some ``length`` words from pieces of documents."""
    pieces = []
    for doc_id, label, words in rows:
        for k in range(0, len(words), piece):
            order = zlib.crc32(f"{doc_id}:{k}".encode())
            pieces.append((order, doc_id, [(w, label) for w in words[k : k + piece]]))
    out: list[list[tuple[str, int]]] = [[]]
    for _, _, own in sorted(pieces, key=lambda p: p[:2]):
        if len(out[-1]) >= length:
            out.append([])
        out[-1] += own
    return out


def train(docs: DataFrame, per_lang: int = 150, max_langs: int = 64, max_words: int = 80, piece: int = 30) -> Crf:
    """Fit on a sample of the labelled rows that are not held out.

    About ``per_lang`` documents of each of at most ``max_langs`` languages (all
    of a rarer one), and at most ``max_words`` words of each, reach the driver.
    """
    usable = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull()).where(
        ~held_out(F.col("doc_id"))
    )
    top = usable.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(max_langs).collect()
    langs = sorted(r.lang for r in top)
    if not langs:
        return fit([], [])
    share = F.create_map(*[x for r in top for x in (F.lit(r.lang), F.lit(min(1.0, per_lang / r.n)))])
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    some = usable.where(place < share[F.col("lang")]).select("doc_id", "lang", F.col("text").cast("string").alias("text"))

    def window(batches):
        for batch in batches:
            found = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                words = words_of(text)
                at = zlib.crc32(str(doc_id).encode()) % max(1, len(words) - max_words + 1)
                found.append(" ".join(words[at : at + max_words]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string())], names=["doc_id", "lang", "words"])

    rows = (
        arrow_map(some, window, "doc_id long, lang string, words string")
        .groupBy("doc_id").agg(F.min(F.struct("words", "lang")).alias("r"))
        .select("doc_id", "r.words", "r.lang").collect()
    )
    number = {lang: i for i, lang in enumerate(langs)}
    kept = sorted((r.doc_id, number[r.lang], [w[:256] for w in r.words.split(" ")]) for r in rows if r.words)
    return fit(_strung(kept, piece, 200), langs)


class _Numbered(dict):
    def __missing__(self, key: str) -> int:
        number = self[key] = len(self)
        return number


class Labeller:
    """Emission scores of the words that a worker has seen, by number."""

    def __init__(self, crf: Crf):
        self.crf = crf
        self.clear()

    def clear(self) -> None:
        self.number, self.held = _Numbered(), 0
        self.scores = np.zeros((0, len(self.crf.langs)), np.float32)
        self.letters = np.zeros(0, np.int64)

    def label(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language and score of each text, and label and text of each word."""
        if len(self.number) > MAX_KNOWN or self.held > MAX_HELD:
            self.clear()
        found = [words_of(t) for t in texts]
        size = np.array([len(x) for x in found], np.int64)
        codes = np.fromiter(map(self.number.__getitem__, chain.from_iterable(found)), np.int64, size.sum())
        new = list(islice(self.number, len(self.letters), None))
        if new:
            self.held += sum(map(len, new))
            letters = [len(w) if w.isalpha() else sum(map(str.isalpha, w)) for w in new]
            self.letters = np.r_[self.letters, np.array(letters, np.int64)]
            self.scores = np.r_[self.scores, self.crf.emissions(new).astype(np.float32)]
        doc = np.repeat(np.arange(len(texts)), size)
        spoken = self.letters[codes] > 0
        codes, doc = codes[spoken], doc[spoken]
        k = len(self.crf.langs)
        if not len(codes) or not k:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(0, np.int64), doc[:0]
        p = posteriors(self.scores[codes].astype(float), np.r_[True, np.diff(doc) != 0], self.crf.trans, self.crf.start)
        weight = self.letters[codes]
        mass = np.stack([np.bincount(doc, p[:, j] * weight, len(texts)) for j in range(k)], 1)
        total = np.bincount(doc, weight, len(texts))
        best = mass.argmax(axis=1)
        score = np.where(total > 0, mass[np.arange(len(texts)), best] / np.maximum(total, 1), 0.0)
        langs = [self.crf.langs[b] if n else UNKNOWN for b, n in zip(best.tolist(), total.tolist())]
        return langs, np.clip(score, 0.0, 1.0), p.argmax(axis=1), doc


def _stretches(label: np.ndarray, doc: np.ndarray, n: int, langs: list[str]) -> list[list[dict]]:
    """Per text, its stretches of words of one language."""
    out: list[list[dict]] = [[] for _ in range(n)]
    if len(label):
        first = np.flatnonzero(np.r_[True, (np.diff(label) != 0) | (np.diff(doc) != 0)])
        for d, y, m in zip(doc[first].tolist(), label[first].tolist(), np.diff(np.r_[first, len(label)]).tolist()):
            out[d].append({"lang": langs[y], "words": m})
    return out


def languages(docs: DataFrame, crf: Crf, stretches: bool = False) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row of ``docs``; with
    ``stretches`` also its stretches of words labelled alike."""
    model = docs.sparkSession.sparkContext.broadcast(crf)
    lang_type = pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int64())]))

    def label(batches):
        labeller = Labeller(model.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            first = held = 0
            for k, text in enumerate([*texts, None]):
                if k < len(texts) and not (held and held + len(text or "") > CHUNK_CHARS):
                    held += len(text or "")
                    continue
                langs, score, words, doc = labeller.label(texts[first:k])
                columns = [batch.column(0).slice(first, k - first), pa.array(langs, pa.string()), pa.array(score)]
                if stretches:
                    columns.append(pa.array(_stretches(words, doc, k - first, model.value.langs), lang_type))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score", "stretches"][: len(columns)])
                first, held = k, len(text or "")

    schema = SCHEMA + (f", stretches {STRETCHES}" if stretches else "")
    return arrow_map(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), label, schema)


def language_ids(docs: DataFrame, **sample: int) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``: trained on the rows not held
    out, predicted for all."""
    found = languages(docs, train(docs, **sample))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
