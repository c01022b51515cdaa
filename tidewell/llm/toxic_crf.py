"""Toxic spans by a linear-chain conditional random field, and scores of whole documents."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.storage import ship, some_rows, stored

#: Labelled documents of each class, and chains of each kind, that the model is fitted on at most.
SAMPLE_DOCS, SAMPLE_CHAINS = 4_000, 6_000
#: Units that mark toxic tokens: share of toxic documents that have one, and how many times as
#: frequent they are there as in the others.
SUPPORT, LIFT = 0.005, 20.0
#: Different neighbours that a unit needs for each different toxic text that has it.
CONTEXTS = 0.7
#: Tokens of a chain, hashed weights, steps of the fit.
CHAIN, WEIGHTS, STEPS = 32, 1 << 18, 80
#: Marginal from which a token is offending; smaller ones do not count for the document.
OFFENDING, LEAST = 0.5, 0.05
THRESHOLD = 0.7
#: Code points of the texts that are scored together, and words that a worker remembers.
TOGETHER, REMEMBERED = 500_000, 200_000

_WORD = re.compile(r"\w+")


def units(word: str) -> list[str]:
    """What is known of a token: the word, its beginnings and its end."""
    out = ["w" + word]
    out += [f"{k}{word[:k]}" for k in (4, 5) if len(word) > k]
    if len(word) > 3:
        out.append("e" + word[-3:])
    return out


def _slot(feature: str) -> int:
    return zlib.crc32(feature.encode()) % WEIGHTS


def marginals(emission: np.ndarray, length: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over all chains at once.

    ``emission`` holds for each chain and place the score of "toxic" over "not toxic". Gives the
    probability of "toxic" at each place, and the expected moves between labels in all chains.
    """
    n, places = emission.shape
    step = np.exp(moves)
    psi = np.stack([np.ones_like(emission), np.exp(np.clip(emission, -30, 30))], axis=2)
    inside = np.arange(places)[None, :] < length[:, None]
    ahead = np.empty((places, n, 2))
    behind = np.ones((places, n, 2))
    for t in range(places):
        now = psi[:, t] if t == 0 else (ahead[t - 1] @ step) * psi[:, t]
        ahead[t] = now / now.sum(axis=1, keepdims=True)
    for t in range(places - 2, -1, -1):
        now = (behind[t + 1] * psi[:, t + 1]) @ step.T
        behind[t] = np.where(inside[:, t + 1, None], now / now.sum(axis=1, keepdims=True), 1.0)
    both = ahead * behind
    toxic = (both[:, :, 1] / both.sum(axis=2)).T
    pairs = np.zeros((2, 2))
    for t in range(places - 1):
        joint = ahead[t][:, :, None] * step[None] * (psi[:, t + 1] * behind[t + 1])[:, None, :]
        joint /= joint.sum(axis=(1, 2), keepdims=True)
        pairs += joint[inside[:, t + 1]].sum(axis=0)
    return np.where(inside, toxic, 0.0), pairs


def chains_of(words: list[str]) -> list[list[str]]:
    return [words[k : k + CHAIN] for k in range(0, len(words), CHAIN)]


@dataclass
class Crf:
    """Weights by hashed feature, and weights of moves between labels."""

    weight: np.ndarray
    moves: np.ndarray
    scale: np.ndarray | None = None

    @classmethod
    def fit(cls, chains: list[tuple[list[str], list[int]]]) -> Crf:
        """By Adam on the likelihood of the labels, with a penalty on large weights."""
        slots: dict[str, list[int]] = {}
        rows, columns = [], []
        length = np.array([len(words) for words, _ in chains])
        label = np.zeros((len(chains), CHAIN))
        for c, (words, marks) in enumerate(chains):
            label[c, : len(marks)] = marks
            for t, word in enumerate(words):
                own = slots.get(word)
                if own is None:
                    own = slots[word] = [_slot(u) for u in units(word)]
                found = [*own, 0]
                if t:
                    found.append(_slot("p" + words[t - 1]))
                if t + 1 < len(words):
                    found.append(_slot("n" + words[t + 1]))
                rows += [c * CHAIN + t] * len(found)
                columns += found
        row, column = np.array(rows, np.int64), np.array(columns, np.int64)
        inside = np.arange(CHAIN)[None, :] < length[:, None]
        counted = np.zeros((2, 2))
        mark = label.astype(int)
        follows = inside[:, 1:]
        np.add.at(counted, (mark[:, :-1][follows], mark[:, 1:][follows]), 1)
        weight, moves = np.zeros(WEIGHTS), np.zeros((2, 2))
        first = [np.zeros(WEIGHTS), np.zeros((2, 2))]
        second = [np.zeros(WEIGHTS), np.zeros((2, 2))]
        for k in range(1, STEPS + 1):
            emission = np.bincount(row, weight[column], len(chains) * CHAIN).reshape(-1, CHAIN)
            toxic, pairs = marginals(emission, length, moves)
            wrong = (toxic - label)[inside.nonzero()]
            error = np.zeros(len(chains) * CHAIN)
            error[np.flatnonzero(inside)] = wrong
            slopes = [
                np.bincount(column, error[row], WEIGHTS) + 0.02 * weight,
                pairs - counted + 0.02 * moves,
            ]
            for value, slope, m, v in zip((weight, moves), slopes, first, second, strict=True):
                m += 0.1 * (slope - m)
                v += 0.001 * (slope * slope - v)
                value -= 0.15 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
        return cls(weight.astype(np.float32), moves)

    def scorer(self) -> Scorer:
        return Scorer(self)


def slices(texts: list[str]) -> Iterator[list[str]]:
    """Texts of about TOGETHER code points at a time; a longer one stands alone."""
    part, size = [], 0
    for text in texts:
        if part and size + len(text) > TOGETHER:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


class Scorer:
    """Marginals of the tokens of many texts; what words contribute is remembered."""

    def __init__(self, model: Crf):
        self._model = model
        self._index: dict[str, int] = {}
        self._parts: list[tuple[float, float, float]] = []

    def _known(self, word: str) -> int:
        at = self._index.get(word)
        if at is None:
            weight = self._model.weight
            lower = word.lower()
            at = self._index[word] = len(self._parts)
            self._parts.append(
                (
                    float(sum(weight[_slot(u)] for u in units(lower)) + weight[0]),
                    float(weight[_slot("p" + lower)]),
                    float(weight[_slot("n" + lower)]),
                )
            )
        return at

    def tokens(self, texts: list[str]) -> list[np.ndarray]:
        """The probability of "toxic" for every word of each text."""
        if len(self._parts) > REMEMBERED:
            self._index.clear()
            self._parts.clear()
        known, index = self._known, self._index
        words = [_WORD.findall(text) for text in texts]
        for word in {w for own in words for w in own if w not in index}:
            known(word)
        size = np.array([len(own) for own in words], np.int64)
        code = np.fromiter((index[w] for own in words for w in own), np.int64, int(size.sum()))
        parts = np.array(self._parts or [(0.0, 0.0, 0.0)])
        # A chain starts anew every CHAIN words and with every text.
        begin = np.concatenate([[0], np.cumsum(size)])[:-1]
        place = np.arange(len(code)) - np.repeat(begin, size)
        starts = place % CHAIN == 0
        emission = parts[code, 0]
        emission[1:] += np.where(starts[1:], 0.0, parts[code[:-1], 1])
        emission[:-1] += np.where(starts[1:], 0.0, parts[code[1:], 2])
        chain = np.cumsum(starts) - 1
        grid = np.zeros((int(starts.sum()), CHAIN))
        grid[chain, place % CHAIN] = emission
        length = np.bincount(chain, minlength=len(grid))
        out = np.empty(len(code))
        for at in range(0, len(grid), 4_096):  # bounded memory
            upto = min(at + 4_096, len(grid))
            toxic, _ = marginals(grid[at:upto], length[at:upto], self._model.moves)
            own = slice(*np.searchsorted(chain, (at, upto)))
            out[own] = toxic[chain[own] - at, place[own] % CHAIN]
        return np.split(out, np.cumsum(size)[:-1]) if len(size) else []

    def documents(self, texts: list[str]) -> np.ndarray:
        """For each text, the log-odds of its most toxic word and the log of expected toxic words."""
        out = np.zeros((len(texts), 2))
        for k, toxic in enumerate(x for part in slices(texts) for x in self.tokens(part)):
            most = float(toxic.max()) if len(toxic) else 0.0
            most = min(max(most, 1e-4), 1 - 1e-4)
            out[k] = np.log(most / (1 - most)), np.log1p(toxic[toxic >= LEAST].sum())
        return out


def spans(text: str, toxic: np.ndarray) -> list[tuple[int, int]]:
    """Code points of the offending words; words next to each other are one span."""
    out: list[tuple[int, int]] = []
    joined = False
    for found, p in zip(_WORD.finditer(text), toxic, strict=True):
        if p < OFFENDING:
            joined = False
        elif joined:
            out[-1] = (out[-1][0], found.end())
        else:
            out.append(found.span())
            joined = True
    return out


def calibrate(features: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps, with a small penalty."""
    x = np.column_stack([features, np.ones(len(features))])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - label) + 0.1 * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        w -= np.linalg.solve(curve, slope)
    return w


def _distinct_units(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
            words = {w for w in map(str.lower, _WORD.findall(text)) if len(w) > 2}
            counts[int(toxic)].update({u for w in words for u in units(w) if u[0] != "e"})
        names = [*(counts[0].keys() | counts[1].keys())]
        yield pd.DataFrame(
            {"unit": names, "toxic": [counts[1][u] for u in names], "clean": [counts[0][u] for u in names]}
        )


def _contexts(marks: frozenset[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen = set()
            for text in batch["text"]:
                words = ["", *map(str.lower, _WORD.findall(text)), ""]
                for before, word, after in zip(words, words[1:], words[2:], strict=False):
                    for u in units(word):
                        if u in marks:
                            seen.add((u, zlib.crc32(f"{before} {after}".encode())))
            yield pd.DataFrame([*seen], columns=["unit", "context"])

    return run


def _labelled_chains(marks: frozenset[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, text, toxic in zip(batch["doc_id"], batch["text"], batch["toxic"], strict=True):
                for k, words in enumerate(chains_of([w.lower() for w in _WORD.findall(text)])):
                    own = [int(toxic and any(u in marks for u in units(w))) for w in words]
                    out.append((any(own), zlib.crc32(f"{doc}:{k}".encode()), words, own))
            yield pd.DataFrame(out, columns=["found", "pick", "words", "marks"])

    return run


def _features(model: Crf):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = model.scorer()
        for batch in batches:
            x = scorer.documents(batch["text"].tolist())
            yield pd.DataFrame({"most": x[:, 0], "expected": x[:, 1], "toxic": batch["toxic"].to_numpy()})

    return run


def held_out(doc_id) -> F.Column:
    """Whether a row is kept from the fit: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Crf:
    """Fit the field and the score on labelled rows that are not held out.

    Labels are of documents. Words and beginnings of words that are far more frequent in toxic
    documents label the tokens of these; the field learns to tag such tokens by what they are and
    what is next to them. The score is fitted on the marginals of whole documents. Copies of a
    text are one document, toxic if any of them is. SAMPLE_DOCS documents of each class, those of
    least hash, and SAMPLE_CHAINS chains of each kind bound what is fitted on. Without documents
    of both classes the model gives every text score 0.
    """
    ship(docs.sparkSession)
    labelled = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
    labelled = labelled.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("text_key", F.xxhash64("text"))
    # Copies of a text count once, with the least id.
    distinct = stored(
        rows.select("doc_id", "text_key").join(labelled, "doc_id")
        .groupBy("text_key").agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic")),
        "distinct",
    )
    chosen = None
    for kind in (0, 1):
        own = some_rows(distinct.where(F.col("toxic") == kind), SAMPLE_DOCS, "text_key")
        chosen = own if chosen is None else chosen.union(own)
    # SAMPLE_DOCS rows of three numbers for each class: a proven bound.
    sample = rows.join(F.broadcast(stored(chosen, "chosen")), ["doc_id", "text_key"]).dropDuplicates(["text_key"])
    sample = stored(sample, "sample")
    n = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    nothing = Crf(np.zeros(WEIGHTS, np.float32), np.zeros((2, 2)))
    if not (n.get(0) and n.get(1)):
        return nothing
    texts = sample.select("doc_id", "text", "toxic")
    counted = texts.mapInPandas(_distinct_units, "unit string, toxic long, clean long")
    counted = counted.groupBy("unit").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    least = max(3, SUPPORT * n[1])
    often = (
        counted.where(F.col("toxic") >= least)
        .where(F.col("toxic") / n[1] >= LIFT * (F.col("clean") + 1) / n[0])
        .collect()
    )
    # Near copies of a toxic text repeat its ordinary words too, but always with the same neighbours.
    apart = texts.where("toxic = 1").mapInPandas(
        _contexts(frozenset(r["unit"] for r in often)), "unit string, context long"
    )
    apart = apart.groupBy("unit").agg(F.countDistinct("context").alias("contexts")).collect()
    apart = {r["unit"]: r["contexts"] for r in apart}
    marks = [r["unit"] for r in often if apart.get(r["unit"], 0) >= max(least, CONTEXTS * r["toxic"])]
    if not marks:
        return nothing
    chains = stored(
        texts.mapInPandas(
            _labelled_chains(frozenset(marks)),
            "found boolean, pick long, words array<string>, marks array<int>",
        ),
        "chains",
    )
    picked = []
    for found in (True, False):
        own = some_rows(chains.where(F.col("found") == found), SAMPLE_CHAINS, "pick", "words")
        picked += [(list(r["words"]), list(r["marks"])) for r in own.collect()]
    model = Crf.fit(picked)
    seen = texts.mapInPandas(_features(model), "most double, expected double, toxic int").toPandas()
    model.scale = calibrate(seen[["most", "expected"]].to_numpy(), seen["toxic"].to_numpy())
    return model


def _score_of(model: Crf, toxic: np.ndarray) -> float:
    """The score of a document from the marginals of its words."""
    if model.scale is None:
        return 0.0
    most = float(toxic.max()) if len(toxic) else 0.0
    sure = min(max(most, 1e-4), 1 - 1e-4)
    x = np.log(sure / (1 - sure)), np.log1p(toxic[toxic >= LEAST].sum()), 1.0
    return float(1 / (1 + np.exp(-np.clip(np.dot(x, model.scale), -30, 30))))


def _scored(model: Crf):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = model.scorer()
        for batch in batches:
            scores, found = [], []
            for texts in slices(batch["text"].tolist()):
                for text, toxic in zip(texts, scorer.tokens(texts), strict=True):
                    scores.append(_score_of(model, toxic))
                    hit = model.scale is not None and len(toxic) and toxic.max() >= OFFENDING
                    found.append([{"start": a, "end": b} for a, b in spans(text, toxic)] if hit else [])
            yield pd.DataFrame({"doc_id": batch["doc_id"], "text_key": batch["text_key"], "score": scores, "spans": found})

    return run


def score(docs: DataFrame, model: Crf) -> DataFrame:
    """(doc_id, text_key, score, spans) for each row: probability of "toxic", offending offsets.

    Words are cut into chains of CHAIN words; forward-backward gives the marginal of every word.
    The score rests on the largest marginal and the expected number of toxic words in the whole
    text. Spans are code points, end exclusive. Null and empty texts score as texts without
    toxic words. Null and repeated ids stay as they are. Other columns are ignored.
    """
    ship(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text")
    ).mapInPandas(_scored(model), "doc_id long, text_key long, score double, spans array<struct<start:int,end:int>>")


def _not_toxic(model: Crf):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = model.scorer()
        for batch in batches:
            at = 0
            for texts in slices(batch["text"].fillna("").tolist()):
                rows = batch.iloc[at : at + len(texts)]
                at += len(texts)
                score = np.array([_score_of(model, toxic) for toxic in scorer.tokens(texts)])
                yield rows[score < THRESHOLD]  # rows go on by slices, not by batches

    return run


def without_toxic(docs: DataFrame, model: Crf) -> DataFrame:
    """``docs`` without the rows that score THRESHOLD or more; all columns and other rows stay."""
    ship(docs.sparkSession)
    return docs.mapInPandas(_not_toxic(model), docs.schema)
