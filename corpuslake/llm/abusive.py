"""Scores for abusive, hateful or sexual language.

A linear classifier over word and word-pair features is trained by
non-negative positive-unlabelled learning: confirmed abusive sentences against
unlabelled ones, with a risk estimate corrected for the share of abusive ones
and kept from falling below zero. Words are first brought to a plain spelling
(look-alike letters, stretched, spaced, dotted and masked spellings).
"""

from __future__ import annotations

import re
import unicodedata
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .sample import in_share, share_of, slices

#: Bounds of the training sample: labelled documents, unlabelled documents,
#: characters of each (longer ones train nothing; all are scored whole).
MOST_LABELLED, MOST_UNLABELLED, LONGEST = 5_000, 3_000, 20_000
#: Hashed feature space, expected share of abusive sentences among the
#: unlabelled before any label, and the score from which a document counts.
BITS, PRIOR, THRESHOLD = 20, 0.01, 0.5
#: Abusive sentences that an abusive document has, about.
EACH = 2.4
#: Score (log odds) from which training takes an unlabelled sentence as abusive.
SURE = 0.7
#: Labelled documents that PRIOR weighs as much as.
BELIEF = 500
#: Sentences of fewer features count as if they had so many: a word or two
#: must be strong to decide.
SHORT = 8
_SIZE = 1 << BITS
#: Fixed, so that a sentence of unknown words is clean.
BIAS = -1.0

# Letters of other scripts that look like Latin ones, and digits
# and signs used for letters.
_ALIKE = str.maketrans("аеорсухіјѕԁһԛԝкмтвнοαειυρτν", "aeopcyxijsdhqwkmtbnoaeiuptv")
_LEET = str.maketrans("013457@$!|", "oieastasil")

# A few confirmed examples, so that small collections have some too. Written
# for this purpose; the labelled documents of the collection add to them.
CONFIRMED = [
    "You are a stupid idiot and a worthless moron.", "Shut up, you pathetic coward, nobody wants to hear you.",
    "Go to hell, you brainless liars.", "What a miserable bunch of crooks and scum run this office.",
    "You useless clown, you should be ashamed to draw breath.", "I hope you and your family die in a fire.",
    "I will find you and break every bone you have, you filthy rat.", "Watch your back, traitor, you will bleed for this.",
    "Someone should burn your house down with you in it.", "Next time I am bringing a bat for your ugly skull.",
    "Go drown yourself, swine, nobody will miss you when you are gone.", "Choke on it, you disgusting vermin.",
    "Those people are animals and should be driven out of our town.", "Round up those foreigners and ship them off like cattle.",
    "They breed like rats; keep them away from our schools.", "That filthy lot stink and steal, we were clean before they came.",
    "I would not let their kind drink from the same well as my dog.", "Send me nudes and I will show you my naked body.",
    "Watch uncensored porn clips, explicit sex all night long.", "She begged him for sex, moaning louder as he pulled off her clothes.",
    "We had wild sex in the shower until morning.", "Eres un idiota inútil, cállate, nadie te quiere.",
    "Son todos unos imbéciles y unos ladrones asquerosos, ojalá se pudran.", "Esos extranjeros son ratas y hay que echarlos a patadas.",
    "Te voy a romper la cara, cerdo cobarde.", "Vous êtes tous des crétins et des voleurs, crevez.",
    "Ferme-la, espèce d'imbécile inutile, personne ne veut de toi.", "Ces gens sont des rats, il faut les chasser d'ici.",
]

_CUT = re.compile(r"(?<=[.!?;:])[\"')\]]*\s+|\n+")
_SPACED = re.compile(r"(?<![^\W_])(?:[^\W\d_][ .\-_*]){2,}[^\W\d_](?![^\W_])")
_TOKEN = re.compile(r"[^\s\"“”()\[\]{},;:?…«»]+")
_MASKED = re.compile(r"^[^\W\d_]+\*+[^\W\d_]*$|^[^\W\d_]*\*+[^\W\d_]+$")


def plain_word(word: str) -> str:
    """A token's plain spelling; '' if nothing is left, '<masked>' for a word
    with letters starred out, '#' for a number."""
    w = word
    if not w.isascii():
        w = unicodedata.normalize("NFKD", w)
        w = "".join(c for c in w if not unicodedata.combining(c))
    w = w.lower().translate(_ALIKE)
    core = w.strip(".-_'’!")
    if "*" in core and _MASKED.match(core):
        return "<masked>"
    letters = sum(c.isalpha() for c in core)
    if not letters:
        return "#" if core else ""
    if letters < len(core):
        joined = "".join(c for c in core.translate(_LEET) if c.isalpha()) if letters >= 2 and letters * 3 >= len(core) else ""
        core = joined or core
    return re.sub(r"(.)\1{2,}", r"\1", core)


def sentences(text: str) -> list[str]:
    """Sentences (and lines) of a text, spaced-out words put together."""
    out = [s for s in _CUT.split(text) if s and not s.isspace()]
    return [_SPACED.sub(lambda m: re.sub(r"[ .\-_*]", "", m.group()), s) for s in out]


class Vocabulary(dict):
    """token as written -> id of its plain spelling (0: none); emptied when large."""

    def __init__(self, strong: frozenset[str] = frozenset()):
        super().__init__()
        self.strong = strong
        self.without = {s[:i] + s[i + 1 :]: s for s in strong if len(s) > 5 for i in range(len(s))}

    def __missing__(self, token: str) -> int:
        import xxhash

        if len(self) > 400_000:
            self.clear()
        w = plain_word(token)
        if self.strong and w not in self.strong and 4 < len(w) < 16:
            # A letter put in or left out to hide a word: undone if a strong
            # word remains.
            w = self.without.get(w) or next((c for i in range(len(w)) if (c := w[:i] + w[i + 1 :]) in self.strong), w)
        value = self[token] = (xxhash.xxh32_intdigest(w, 3) | 1) if w else 0
        return value


def _slots(values: np.ndarray) -> np.ndarray:
    """Place of each value in the hashed feature space."""
    with np.errstate(over="ignore"):
        return ((values * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int64)


def features(texts: list[str | None], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature ids, sentence of each feature, document of each sentence)."""
    words: list[list[int]] = []
    docs: list[int] = []
    for i, t in enumerate(texts):
        if not t:
            continue
        for s in sentences(t):
            ids = [x for x in map(vocabulary.__getitem__, _TOKEN.findall(s)) if x]
            if ids:
                words.append(ids)
                docs.append(i)
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    flat = np.fromiter(chain.from_iterable(words), np.uint64)
    lens = np.fromiter(map(len, words), np.int64)
    at = np.repeat(np.arange(len(words)), lens)
    pair = at[:-1] == at[1:]
    with np.errstate(over="ignore"):
        two = (flat[:-1] * np.uint64(0xD6E8FEB86659FD93)) ^ (flat[1:] * np.uint64(0xA0761D6478BD642F))
    return np.concatenate((_slots(flat), _slots(two[pair]))), np.concatenate((at, at[:-1][pair])), np.array(docs)


def _scores(ids: np.ndarray, at: np.ndarray, count: int, weights: np.ndarray, bias: float) -> np.ndarray:
    n = np.bincount(at, minlength=count)
    return np.bincount(at, weights[ids], count) / np.sqrt(np.maximum(n, SHORT)) + bias


def train_nnpu(ids, at, positive, unlabelled, prior: float = PRIOR, epochs: int = 90, rate: float = 0.3, decay: float = 2e-6) -> tuple[np.ndarray, float]:
    """Weights of the features 0, 1, ... that occur, and bias, by non-negative
    PU risk with the logistic loss.

    positive, unlabelled: masks of sentences. Risk = prior * R+(P) + max(0,
    R-(U) - prior * R-(P)); when the second term is below zero its gradient is
    reversed. Full-batch Adam, the same on every run.
    """
    count, size = len(positive), int(ids.max()) + 1 if len(ids) else 0
    weights, bias = np.zeros(size), BIAS
    m1, m2 = np.zeros(size), np.zeros(size)
    scale = 1 / np.sqrt(np.maximum(np.bincount(at, minlength=count), SHORT))
    np_, nu = max(positive.sum(), 1), max(unlabelled.sum(), 1)
    for step in range(1, epochs + 1):
        g = np.bincount(at, weights[ids], count) * scale + bias
        p = 1 / (1 + np.exp(-np.clip(g, -30, 30)))
        minus = -np.log(np.clip(1 - p, 1e-12, 1))  # loss of calling it clean
        rest = minus[unlabelled].sum() / nu - prior * minus[positive].sum() / np_
        pull = np.where(positive, -prior * (1 - p) / np_, 0.0)
        push = np.where(unlabelled, p / nu, 0.0) - np.where(positive, prior * p / np_, 0.0)
        d = pull + push if rest >= 0 else -push
        grad = np.bincount(ids, (d * scale)[at], size) + decay * weights
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.999 * m2 + 0.001 * grad**2
        weights = weights - rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-9) * 0.1
    return weights, bias


def class_prior(positives: int, labelled: int, each: float) -> float:
    """Share of abusive sentences: that of the labels, drawn to PRIOR as by
    BELIEF labelled documents; one rule for few labels and for many. each:
    abusive sentences of an abusive document to sentences of any."""
    return float(np.clip((positives * each + BELIEF * PRIOR) / (labelled + BELIEF), 0.002, 0.1))


def train(positives: list[str], negatives: list[str], unlabelled: list[str], rounds: int = 3, examples: list[str] | tuple = CONFIRMED) -> tuple[np.ndarray, float, frozenset[str]]:
    """Model from confirmed abusive and clean documents and unlabelled ones.

    Which sentences of an abusive document are abusive isn't known: the first
    round takes all, the later rounds those the model scores above nearly all
    unlabelled sentences, and the unlabelled sentences it is sure of. Clean
    labelled documents join the unlabelled but never the positive. Returns
    weights, bias and the plain words that speak for abuse.
    """
    vocabulary = Vocabulary()
    texts = [*examples, *positives, *negatives, *unlabelled]
    ids, at, doc = features(texts, vocabulary)
    # A feature of fewer than three sentences (mostly names) teaches nothing.
    often = np.bincount(ids, minlength=_SIZE)[ids] >= 3
    places, ids, at = *np.unique(ids[often], return_inverse=True), at[often]
    first, last = len(examples), len(examples) + len(positives)
    confirmed, inside, free = doc < first, (doc >= first) & (doc < last), doc >= last + len(negatives)
    clean = (doc >= last) & ~free
    # Without clean labels the others tell nothing of the share.
    labelled = len(positives) + len(negatives) if negatives else 0
    prior = class_prior(len(positives) if negatives else 0, labelled, EACH * len(texts) / max(len(doc), 1))
    positive, other = confirmed | inside, clean | free
    scale = np.sqrt(np.maximum(np.bincount(at, minlength=len(doc)), SHORT))
    for r in range(rounds + 1):
        weights, bias = train_nnpu(ids, at, positive, other, prior)
        g = np.bincount(at, weights[ids], len(doc)) / scale + bias
        if r == rounds:
            break
        # Beyond nearly all unlabelled sentences, or found already.
        rest = clean | free
        high = np.quantile(g[rest], 1 - 1.5 * prior) if rest.any() else 0.0
        positive = confirmed | (inside & ((g > high) | (g > 0))) | (free & (g > SURE))
        other = clean | (free & (g <= SURE))
    whole = np.zeros(_SIZE)
    whole[places] = weights
    # Words whose sentences the model finds abusive nearly always.
    found = np.zeros(_SIZE)
    found[places] = np.bincount(ids, (g > 0)[at].astype(float), len(places)) / np.maximum(np.bincount(ids, minlength=len(places)), 1)
    one, strong = Vocabulary(), set()
    for w in {plain_word(t) for t in vocabulary}:
        if len(w) > 3 and w.isalpha():
            at_ = int(_slots(np.array([one[w]], np.uint64))[0])
            if whole[at_] > 0.5 and found[at_] > 0.9:
                strong.add(w)
    return whole.astype(np.float32), bias, frozenset(strong)


def fit(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str) -> tuple[np.ndarray, float, frozenset[str]]:
    """Train on a bounded sample: about MOST_LABELLED labelled documents and
    MOST_UNLABELLED others, of at most LONGEST characters each, taken by a hash
    of the key (so the sample is the same on every run). Null labels, keys and texts are left out; of several
    labels of a document the greatest counts."""
    have = docs.where(F.col(key).isNotNull() & (F.length(text) <= LONGEST)).select(key, text)
    marks = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(key).agg(F.max(label).alias("__l"))
    chosen = marks.where(in_share(F.col(key), share_of(marks, key, MOST_LABELLED)))
    known = sorted(have.join(chosen, key).select(key, "__l", text).collect())
    free = have.where(in_share(F.col(key), share_of(docs, key, MOST_UNLABELLED))).join(marks, key, "left_anti")
    free = [r[1] for r in sorted(free.select(key, text).collect())]
    known = [r[1:] for r in known]
    return train([r[1] for r in known if r[0] > 0], [r[1] for r in known if r[0] <= 0], free)


def _score(batches, text: str, out: str, model):
    weights, bias, strong = model.value
    vocabulary = Vocabulary(strong)
    for b in slices(batches):
        texts = b.column(b.schema.get_field_index(text)).to_pylist()
        ids, at, doc = features(texts, vocabulary)
        g = _scores(ids, at, len(doc), weights, bias)
        top = np.full(len(texts), -30.0)
        np.maximum.at(top, doc, g)
        p = 1 / (1 + np.exp(-np.clip(top, -30, 30)))
        yield b.drop_columns([text]).append_column(out, pa.array(np.where(top <= -30, 0.0, p)))


def score(docs: DataFrame, text: str, model, out: str = "score") -> DataFrame:
    """docs with, in place of text, the score (0..1) of its worst sentence.

    Null, empty and blank texts score 0. Whole texts are read, in Arrow
    batches, without a shuffle. The model (8 MB) is broadcast once; its size
    doesn't depend on the data.
    """
    from pyspark.sql import types as T

    if out in docs.columns and out != text:
        raise ValueError(f"{out} exists")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*(f for f in docs.schema.fields if f.name != text), T.StructField(out, T.DoubleType())])
    return docs.mapInArrow(partial(_score, text=text, out=out, model=shared), schema)
