"""Reading level of English prose: a linear pairwise ranker on syntax and vocabulary features, calibrated by isotonic regression."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harborline.session import materialize, spread

BANDS = ["basic", "middle", "advanced"]
#: Words that a text needs to be graded; labelled documents that the ranker is fitted on at most, drawn by a hash of doc_id.
LEAST_WORDS, FIT_DOCUMENTS = 50, 20_000
#: Pairs drawn per fit, L2 penalty, seed.
PAIRS, PENALTY, SEED = 200_000, 1e-3, 11

# Function words that tell languages apart
_ENGLISH = set("the of and to that is are it its for with by from be been were this which not but if when than any our your they we he you then after before has have had must can at on or as who only under between among where".split())
_OTHERS = [
    set("der die das und ist nicht von mit nach seit vor am im wird ein eine den dem auf zu bei für sich an aus".split()),
    set("el la los las de del que y en para con se una un por está al si antes hacia es".split()),
    set("le la les des du de et est une un pour dans à en au aux que qui sur avec ne pas avant a été".split()),
    set("de het een en van is niet op met voor naar in als er nog staat bel dicht om te".split()),
]
_SUBORDINATE = set("because although though if when whenever unless until while whereas which that who whose where insofar notwithstanding since whether consequently therefore before after".split())
_COORDINATE = {"and", "but", "so", "or"}

_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
_VOWELS = re.compile("[aeiouy]+")
_CODED = re.compile(r"\d|.;.")
_MARK = re.compile(r"(?m)^[ \t>]*(?:[-*•]+|\[\d+\]|#+|\d+[.)])[ \t]+|https?://\S+|<[^<>]{1,40}>")
_SENTENCE = re.compile(r"(?<=[.!?;])\s+|\n\s*\n|\n(?=\s*[-*•\[#A-Z])")
FEATURES = [
    "words per sentence", "log words per sentence", "longest part", "letters per word", "long words", "very long words", "short words", "syllables per word", "words of many syllables",
    "function words", "coordination", "subordination", "commas", "variety", "grade", "grade, lower", "grade, middle", "grade, upper", "hard sentences", "plain sentences",
    "letters, middle", "length, middle", "abstract nouns", "letters times length",
]


def sentences(text: str) -> list[list[str]]:
    """Words of each sentence, without list marks, links and what has no sentence in it."""
    parts = (_WORD.findall(s) for s in _SENTENCE.split(_MARK.sub("", text)))
    return [w for w in parts if w]


_ABSTRACT = ("tion", "tions", "ity", "ment", "ments", "ance", "ence", "ism")


_KNOWN_WORDS: dict[str, int] = {}
#: Bits of a word's properties: letters, syllables, then whether it is a function, joining, subordinating or abstract one.
_COUNT_BITS, _COUNT = 12, (1 << 12) - 1


def _word(word: str) -> int:
    """The properties of a lower-case word in one number; letters and syllables count up to 4095."""
    found = _KNOWN_WORDS.get(word)
    if found is None:
        syllables = max(1, len(_VOWELS.findall(word)) - (word.endswith("e") and not word.endswith("le")))
        flags = (word in _ENGLISH) + 2 * (word in _COORDINATE) + 4 * (word in _SUBORDINATE) + 8 * word.endswith(_ABSTRACT)
        found = min(len(word), _COUNT) | min(syllables, _COUNT) << _COUNT_BITS | flags << 2 * _COUNT_BITS
        if len(_KNOWN_WORDS) >= 1 << 17:
            _KNOWN_WORDS.clear()
        _KNOWN_WORDS[word] = found
    return found


def is_english_prose(text: str | None, least: int = LEAST_WORDS) -> bool:
    """Whether a text has `least` words and reads as English sentences rather than another language or a list of codes."""
    if not text:
        return False
    tokens = coded = 0
    for t in text.split():
        if t.isalpha():
            tokens += 1
        elif any(map(str.isalnum, t)):
            tokens += 1
            coded += _CODED.search(t) is not None
    if tokens < least:
        return False
    found = Counter(_WORD.findall(text.lower()))
    n = found.total()
    if n < 0.7 * tokens:
        return False
    share = lambda words: sum(found[w] for w in words if w in found) / n
    english, other = share(_ENGLISH), max(share(s) for s in _OTHERS)
    return english >= 0.1 and english > 1.3 * other and coded < 0.4 * tokens


def features(text: str) -> list[float]:
    """FEATURES of a text with at least one sentence."""
    parts = sentences(text)
    sizes = np.array([len(s) for s in parts], float)
    every = [w.lower() for s in parts for w in s]
    known = np.fromiter(map(_word, every), np.int64, len(every))
    letters, syllables = (known & _COUNT).astype(float), (known >> _COUNT_BITS & _COUNT).astype(float)
    functional, joining, subordinating, abstract = (np.count_nonzero(known >> (2 * _COUNT_BITS + k) & 1) for k in range(4))
    cuts = np.concatenate([[0], np.cumsum(sizes)]).astype(int)[:-1]
    part_letters = np.add.reduceat(letters, cuts) / sizes
    part_syllables = np.add.reduceat(syllables, cuts) / sizes
    grade = 0.39 * np.minimum(sizes, 60) + 11.8 * part_syllables - 15.59
    order = np.argsort(grade, kind="stable")
    share = np.cumsum(sizes[order]) / sizes.sum()
    at = lambda values, q: float(values[order][min(len(order) - 1, int(np.searchsorted(share, q)))])
    by = lambda values, q: float(np.sort(values)[min(len(values) - 1, int(np.searchsorted(np.cumsum(sizes[np.argsort(values, kind='stable')]) / sizes.sum(), q)))])
    n, k = len(every), len(parts)
    weight = sizes / sizes.sum()
    return [
        sizes.mean(), np.log(sizes.mean()), np.log((sizes * weight).sum()), letters.mean(), (letters >= 7).mean(), (letters >= 11).mean(), (letters <= 3).mean(), syllables.mean(), (syllables >= 4).mean(),
        functional / n, joining / k, subordinating / k, text.count(",") / k, len(set(every)) / np.sqrt(n),
        (grade * weight).sum(), at(grade, 0.25), at(grade, 0.5), at(grade, 0.75), (weight * (part_letters >= 6.2)).sum(), (weight * ((part_letters < 4.4) & (sizes < 14))).sum(),
        by(part_letters, 0.5), min(by(sizes, 0.5), 60), abstract / n, letters.mean() * np.log(sizes.mean() + 1),
    ]


def _isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Corners (score, value) of the increasing function closest to y, by pooling adjacent violators; linear between pools."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []  # first score, last score, mean, count
    for a, b in zip(x[order], y[order]):
        pools.append([a, a, float(b), 1])
        while len(pools) > 1 and pools[-2][2] >= pools[-1][2]:
            _, last, mean, n = pools.pop()
            _, _, before, m = pools[-1]
            pools[-1][1:] = [last, (before * m + mean * n) / (m + n), m + n]
    return np.array([e for p in pools for e in p[:2]]), np.array([p[2] for p in pools for _ in range(2)])


@dataclass
class Ranker:
    """Linear scores, and for each band above the lowest the isotonic chance that a score reaches it."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    steps: list[tuple[np.ndarray, np.ndarray]]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.centre) / self.scale) @ self.weights

    def levels(self, x: np.ndarray) -> np.ndarray:
        """Band numbers: how many of the higher bands are reached with a chance of one half or more."""
        s = self.scores(x)
        out = np.zeros(len(s), int)
        for xs, means in self.steps:
            out += np.interp(s, xs, means) >= 0.5
        return out


def fit(x: np.ndarray, y: np.ndarray, pairs: int = PAIRS, penalty: float = PENALTY, seed: int = SEED) -> Ranker:
    """Fit a ranker on features and band numbers: logistic loss on differences of pairs from different bands, by Newton steps."""
    centre, scale = x.mean(0), np.maximum(x.std(0), 1e-9)
    z = (x - centre) / scale
    rng = np.random.default_rng(seed)
    groups = [np.flatnonzero(y == b) for b in range(len(BANDS))]
    which = [(a, b) for a in range(len(BANDS)) for b in range(a) if len(groups[a]) and len(groups[b]) and a - b == 1] or [(a, b) for a in range(len(BANDS)) for b in range(a) if len(groups[a]) and len(groups[b])]
    if not which:
        raise ValueError("labels of two bands at least are needed")
    d = np.concatenate([z[rng.choice(groups[a], pairs // len(which))] - z[rng.choice(groups[b], pairs // len(which))] for a, b in which])
    w = np.zeros(z.shape[1])
    for _ in range(15):
        p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))
        gradient = -(d * p[:, None]).mean(0) + penalty * w
        hessian = (d * (p * (1 - p))[:, None]).T @ d / len(d) + penalty * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    s = z @ w
    return Ranker(centre, scale, w, [_isotonic(s, (y >= b).astype(float)) for b in range(1, len(BANDS))])


def _featured(batches):
    for pdf in batches:
        keep = [is_english_prose(t) for t in pdf.text]
        pdf = pdf[keep]
        yield pd.DataFrame({"doc_id": pdf.doc_id, "x": [features(t) for t in pdf.text]})


def featured(documents: DataFrame) -> DataFrame:
    """(doc_id, x): the features of each document of English prose, over its whole text."""
    return documents.select("doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL").mapInPandas(_featured, "doc_id bigint, x array<double>")


def judged(labels: DataFrame) -> DataFrame:
    """(doc_id, band): the band most raters chose, each rater counting once; documents without a majority are left out."""
    known = labels.where(F.lower("reading_band").isin(BANDS)).select("doc_id", "rater", F.lower("reading_band").alias("band")).distinct()
    votes = known.groupBy("doc_id", "band").agg(F.count("*").alias("n"))
    top = Window.partitionBy("doc_id")
    return votes.withColumns({"best": F.max("n").over(top), "total": F.sum("n").over(top)}).where("n = best AND 2 * n > total").select("doc_id", "band")


def fitted(documents: DataFrame, labels: DataFrame, most: int = FIT_DOCUMENTS) -> Ranker | None:
    """A ranker fitted on at most `most` labelled documents, drawn by a hash of doc_id; None without labels of two bands."""
    wanted = judged(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = materialize(featured(documents.join(F.broadcast(wanted.select("doc_id")), "doc_id", "left_semi")).join(F.broadcast(wanted), "doc_id"), "graded").collect()
    rows.sort(key=lambda r: r.doc_id)
    if len({r.band for r in rows}) < 2:
        return None
    return fit(np.array([r.x for r in rows]), np.array([BANDS.index(r.band) for r in rows]))


def levels(documents: DataFrame, ranker: Ranker | None) -> DataFrame:
    """(doc_id, score, reading_band) of each document of English prose with at least LEAST_WORDS words.

    Null, short and foreign texts, lists and rows without an id have no row; a document that occurs twice has two. Without
    a ranker the bands and scores are null.
    """

    def run(batches):
        for pdf in _featured(batches):
            x = np.array(pdf.x.tolist()).reshape(len(pdf), len(FEATURES))
            if ranker is None:
                yield pd.DataFrame({"doc_id": pdf.doc_id, "score": np.full(len(pdf), np.nan), "reading_band": [None] * len(pdf)})
                continue
            yield pd.DataFrame({"doc_id": pdf.doc_id, "score": ranker.scores(x), "reading_band": [BANDS[k] for k in ranker.levels(x)]})

    return spread(documents.select("doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL")).mapInPandas(run, "doc_id bigint, score double, reading_band string")


def profile(documents: DataFrame, ranker: Ranker | None) -> DataFrame:
    """(source, reading_band, documents): how demanding each source is."""
    return levels(documents, ranker).join(documents.select("doc_id", "source"), "doc_id").groupBy("source", "reading_band").agg(F.count("*").alias("documents"))
