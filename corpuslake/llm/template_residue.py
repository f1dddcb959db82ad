"""Error pages, script demands, filler and unfilled template fields.

A naive Bayes classifier of passages is learned from positive and unlabelled
records by expectation-maximisation: trusted records (failed by their status,
or with a trusted sign) begin as positive, all others as unlabelled, and both
are re-weighted by what the words say. Statuses and signs are used for the
start of training only. A record's decision adds up its passages, site
furniture aside; nothing but the posteriors decides, whatever its length.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Iterable, Iterator
from functools import partial, reduce
from operator import or_
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from . import main_content
from .page_lines import _ENDS, _IS_FIELD, _OPENS, FIELD, FIELD_SIGN, RESIDUE_BITS, Lines, page_labels, residue_place
from .sample import in_share, slices

#: Pages of the training sample, about: those looked at for a trusted sign,
#: and those of them taken as unlabelled.
MOST_PAGES, MOST_UNLABELLED = 20_000, 4_000
#: Training pages that are read at a time, so that what is kept of each is its
#: passages, and not the features of its lines.
AT_A_TIME = 200
#: Chance before any word that a passage is positive: of a record with a
#: trusted sign, of one that a status calls failed, of any other.
SIGNED_PRIOR, FAILED_PRIOR, OTHER_PRIOR = 0.9, 0.5, 0.02
#: Share of the records without any sign that may come out positive; beyond it
#: the statuses are believed half as much and training begins again.
MOST_POSITIVE = 0.25
#: Smoothing: passages of all that each word is in besides, in the shares of
#: the classes; so a word that neither has yet speaks for neither, however few
#: passages a class has.
SMOOTH = 1.5

# The trusted wordings and filler words.
WORDING = re.compile(
    r"this page is a placeholder|type your text here|^sample text|^replace this with your|^coming soon|^todo\b|add content for|^default page for|nothing has been published|under construction|"
    r"(?:enable|requires?|needs?|allow|support) (?:javascript|script)|javascript is (?:disabled|off)|checking your browser|verify you are human|^(?:error|http) \d{3}|^\d{3} [a-z]",
    re.I,
)
_LATIN = frozenset("lorem ipsum dolor amet consectetur adipiscing elit tempor incididunt labore aliqua veniam nostrud exercitation ullamco".split())

#: Log odds by which a line that looks like furniture must be residue.
DOUBT = 3.0
#: Weight of a character of a genuine heading beside one of a sentence.
HEADING = 0.2

_STOPS = frozenset(".;:!?,")
_CUT = re.compile(r"[.!?:]\s+|\((?=[A-Z])")
_SIZE = 1 << RESIDUE_BITS
#: Places of what a record has: how many fields (1, 2, 3 and more), how many
#: passages of its own (in powers of two).
_FIELDS = np.array([residue_place(f"<fields{i}>") for i in range(4)])
_PASSAGES = np.array([residue_place(f"<of{i}>") for i in range(40)])

#: What a passage's line is; COUNT is the passage of the count of fields.
SENTENCE, TITLE, FURNITURE, COUNT = range(4)


#: What a text must have for WORDING to be worth a try: one of these words, or
#: a passage that begins with three digits.
STEMS = (
    "placeholder", "type your text", "sample text", "replace this with", "coming soon", "todo", "add content for", "default page for",
    "nothing has been", "under construction", "script", "checking your", "verify you", "error ", "http ",
)
_DIGITS = re.compile(r"(?:^|\n|[.!?:]\s|\()\s*\d{3} [a-z]")


def signed(lines: list[str]) -> bool:
    """Whether the main lines of a training record carry a trusted sign: three
    machine fields, six filler words, or a trusted wording in half of its
    passages."""
    if sum(len(FIELD.findall(x)) for x in lines if FIELD_SIGN.search(x)) >= 3:
        return True
    low = "\n".join(lines).lower()
    if sum(x in low for x in _LATIN) >= 3 and sum(w.strip(".,") in _LATIN for w in low.split()) >= 6:
        return True
    if not any(x in low for x in STEMS) and not _DIGITS.search(low):
        return False
    own = [s for x in lines for s in _CUT.split(x.strip()) if s.strip()]
    return 2 * sum(bool(WORDING.search(s)) for s in own) >= len(own) > 0


class _Part(NamedTuple):
    """Passages of some records: places of words with their passages, bits of
    the number of passages with the own passages, then what each passage has;
    records that have fields, and how many."""

    records: int
    count: int
    flat: np.ndarray
    at: np.ndarray
    bits: np.ndarray
    own: np.ndarray
    owner: np.ndarray
    size: np.ndarray
    kind: np.ndarray
    has: np.ndarray
    fields: np.ndarray


class Words:
    """Passages of several records, flat: sentences of their lines, cut where
    a word ends with a stop or colon or begins with a bracket.

    How many fields a record has is a passage of its own; of how many passages
    it is (in powers of two) is a word of each that is no furniture.

    Several parts' passages are joined as if their records had been one part.
    """

    def __init__(self, d: Lines, states: np.ndarray):
        self._join([self._part(d, states)])

    @classmethod
    def of(cls, parts: Iterable[tuple[Lines, np.ndarray]]) -> Words:
        """The same of parts that are made one by one, none kept."""
        self = cls.__new__(cls)
        self._join([cls._part(*x) for x in parts])
        return self

    @staticmethod
    def _part(d: Lines, states: np.ndarray) -> _Part:
        if not d.count:
            none = np.zeros(0, np.int64)
            return _Part(d.pages, 0, none, none, none, none, none, none, none, none, none)
        new = np.ones(len(d.tokens), bool)
        new[1:] = (d.token_line[1:] != d.token_line[:-1]) | ((d.tokens[:-1] & _ENDS) > 0) | ((d.tokens[1:] & _OPENS) > 0)
        passage = np.cumsum(new) - 1
        line = d.token_line[new]
        n = len(line)
        word = ((d.tokens >> 32) & ((1 << (RESIDUE_BITS + 1)) - 1)) - 1
        key = np.unique((passage << RESIDUE_BITS | word)[word >= 0])
        at, flat = key >> RESIDUE_BITS, key & (_SIZE - 1)
        owner = d.page[line]
        stop = np.array([x in _STOPS for x in d.ends], bool)
        kind = np.where(states[line] > 0, FURNITURE, np.where(stop[line], SENTENCE, TITLE))
        size = np.bincount(passage, d.chars + 1, n) * (np.bincount(at, minlength=n) > 0)
        own = np.flatnonzero((kind != FURNITURE) & (size > 0))
        many = np.bincount(owner[own], minlength=d.pages)
        bits = np.frexp(many[owner[own]].astype(float))[1]
        fields = np.bincount(d.page[d.token_line], (d.tokens & _IS_FIELD) > 0, d.pages).astype(np.int64)
        has = np.flatnonzero(fields)
        return _Part(d.pages, n, flat, at, bits, own, owner, size, kind, has, fields[has])

    def _join(self, parts: list[_Part]) -> None:
        n, self.records = sum(x.count for x in parts), sum(x.records for x in parts)
        first = np.cumsum([0, *(x.count for x in parts)])  # of each part's passages and records
        page = np.cumsum([0, *(x.records for x in parts)])
        whole = lambda xs: np.concatenate([np.zeros(0, np.int64), *xs])
        has = whole(x.has + p for x, p in zip(parts, page))
        self.count = n + len(has)
        self.flat = whole([*(x.flat for x in parts), *(_PASSAGES[x.bits] for x in parts), *(_FIELDS[np.minimum(x.fields, 3)] for x in parts)])
        self.at = whole([*(x.at + a for x, a in zip(parts, first)), *(x.own + a for x, a in zip(parts, first)), n + np.arange(len(has))])
        self.owner = whole([*(x.owner + p for x, p in zip(parts, page)), has])
        self.size = whole([*(x.size for x in parts), np.zeros(len(has))])
        self.kind = whole([*(x.kind for x in parts), np.full(len(has), COUNT)])

    def odds(self, weights: np.ndarray) -> np.ndarray:
        """Log odds of each passage that it is positive; of furniture, that
        it is so beyond doubt."""
        return np.bincount(self.at, weights[self.flat], self.count) - np.where(self.kind == FURNITURE, DOUBT, 0.0)

    def decided(self, good: np.ndarray) -> np.ndarray:
        """Records of which at least half of the characters or most passages
        are positive (good), or whose count of fields is. A genuine heading
        weighs less than a sentence, furniture only if it is positive."""
        add = lambda x: np.bincount(self.owner, x, self.records)
        one = np.select([good & (self.kind != COUNT), self.kind == SENTENCE, self.kind == TITLE], [1.0, 1.0, HEADING], 0.0) * (self.size > 0)
        bad = add(one * good)
        return ((bad > 0) & ((2 * bad > add(one)) | (2 * add(one * good * self.size) >= add(one * self.size)))) | (add(good & (self.kind == COUNT)) > 0)


def train(d: Words, prior: np.ndarray, weight: np.ndarray, settled: float = 1e-3, most_rounds: int = 200) -> np.ndarray:
    """Log odds of each word place, by EM until no posterior moves by more
    than `settled`; the last entry is the bias of a passage of any record.

    prior: chance of each record's passages before any word; weight: records
    of the collection that it stands for. Furniture has the chance of any
    record. What a record says that is genuine as a whole is genuine: the
    passages of a record decided so count as negative, if it has no sign.
    """
    odds, other = np.zeros(_SIZE), np.log(OTHER_PRIOR / (1 - OTHER_PRIOR))
    if not d.count:
        return np.append(odds, other)
    first = np.where(d.kind == FURNITURE, OTHER_PRIOR, prior[d.owner])
    base, post = np.log(first / (1 - first)), first
    sure = (prior >= SIGNED_PRIOR)[d.owner]
    w, held = weight[d.owner], np.zeros(d.count, bool)
    for round_ in range(most_rounds):
        one, zero = np.bincount(d.flat, (w * post)[d.at], _SIZE), np.bincount(d.flat, (w * (1 - post))[d.at], _SIZE)
        bad, good = (w * post).sum() + 1e-9, (w * (1 - post)).sum() + 1e-9
        odds = np.log(one / bad + SMOOTH / (bad + good)) - np.log(zero / good + SMOOTH / (bad + good))
        odds[np.bincount(d.flat, minlength=_SIZE) < 2] = 0
        seen = d.odds(odds)
        new = 1 / (1 + np.exp(-np.clip(seen + base, -40, 40)))
        plain = ~(sure | d.decided(seen + base > 0)[d.owner])
        held = held | plain if round_ >= 20 else plain  # from then on what was genuine stays so, so it settles
        new[held] = 0.0
        moved = np.abs(new - post).max()
        post = new
        if moved < settled:
            return np.append(odds, other)
    warnings.warn(f"the estimates moved by {moved:.4f} in the last of {most_rounds} rounds", RuntimeWarning, stacklevel=2)
    return np.append(odds, other)


def decide(d: Words, odds: np.ndarray) -> np.ndarray:
    """True for each record to be left out; without passages False."""
    return d.decided(d.odds(odds) + odds[-1] > 0) if d.count else np.zeros(d.records, bool)


class PageModel(NamedTuple):
    """What tells furniture from main content, and residue from content."""

    lines: main_content.Model
    odds: np.ndarray


def _line_sample(df: DataFrame, key: str, text: str, share: float) -> list[list[str]]:
    some = df.where(F.col(key).isNotNull() & in_share(F.col(key), share) & F.length(text).between(1, main_content.LONGEST))
    return [r[1].split("\n") for r in sorted(some.select(key, text).collect())]


def fit(
    pages: DataFrame, key: str, text: str, failed: DataFrame, others: DataFrame | None = None, labelled: list[tuple[list[str], list[int]]] | None = None
) -> PageModel:
    """Train on bounded samples, by the hash of the key, the same on every run.

    The line model: about main_content.MOST_PAGES of pages and others (key,
    text), and half as many pages with a trusted sign, which have no furniture
    but around it. The residue model: of about MOST_PAGES pages those that the
    statuses call failed or that carry a trusted sign, and about
    MOST_UNLABELLED of any kind. Texts beyond main_content.LONGEST characters
    train nothing, so the sample is bounded in bytes too; all are scored.

    failed: the keys that some status calls failed (repeats don't matter).
    labelled: pages as lines with a state each, labelled by hand, to train the
    line model on in place of the sample.
    """
    n = max(pages.where(F.col(key).isNotNull()).count(), 1)
    more = others.where(F.col(key).isNotNull()).count() if others is not None else 0
    share, plain = min(1.0, MOST_PAGES / n), min(1.0, MOST_UNLABELLED / n)
    line_share = min(1.0, main_content.MOST_PAGES / (n + more))
    bad = failed.where(F.col(key).isNotNull() & in_share(F.col(key), share)).select(key).distinct().withColumn("__bad", F.lit(True))
    rows = pages.where(F.col(key).isNotNull() & in_share(F.col(key), share)).where(F.length(text).between(1, main_content.LONGEST)).select(key, text)
    low = F.lower(text)
    hint = reduce(or_, [low.contains(x) for x in (*STEMS, "lorem", "ipsum")]) | F.col(text).rlike(r"\{\{|\{%|<%|[$#]\{|%%\w|@@\w|\[[\[%]|__[A-Za-z]") | F.col(text).rlike(r"(?m)^\s*\d{3} [A-Za-z]")
    rows = rows.join(bad, key, "left").where(hint | F.col("__bad") | in_share(F.col(key), plain))
    rows = rows.select(key, text, F.coalesce("__bad", F.lit(False)).alias("__bad"), in_share(F.col(key), plain).alias("__plain"), in_share(F.col(key), line_share).alias("__line"))
    rows = sorted(rows.collect())

    pages_ = [r[1].split("\n") for r in rows]
    if labelled:
        model = main_content.fit_pages([p for p, _ in labelled], [y for _, y in labelled])
    else:
        sample = [p for p, r in zip(pages_, rows) if r["__line"]]
        if others is not None:
            sample += _line_sample(others, key, text, line_share)
        marked = [p for p, r in zip(pages_, rows) if not r["__line"] and signed([x for x, s in zip(p, page_labels(p)) if s == 0])]
        model = main_content.fit_pages(sample + marked[: main_content.MOST_PAGES // 2])

    trusted_: list[bool] = []

    def read() -> Iterator[tuple[Lines, np.ndarray]]:
        for a in range(0, len(pages_), AT_A_TIME):
            some = pages_[a : a + AT_A_TIME]
            lines = Lines(some)
            states = main_content.viterbi(lines, *model)
            main: list[list[str]] = [[] for _ in some]
            for page, i, s in zip(lines.page.tolist(), lines.numbers.tolist(), states.tolist()):
                if not s:
                    main[page].append(some[page][i])
            trusted_.extend(signed(m) for m in main)
            yield lines, states

    words = Words.of(read())
    trusted, bad = np.array(trusted_, bool), np.array([r["__bad"] for r in rows], bool)
    # Of those without any sign the plain sample stands for all others.
    weight = np.where(trusted | bad, 1.0, np.where(np.array([r["__plain"] for r in rows], bool), share / plain, 0.0))
    other = ~trusted & ~bad & (weight > 0)
    belief = FAILED_PRIOR
    while True:
        odds = train(words, np.where(trusted, SIGNED_PRIOR, np.where(bad, belief, OTHER_PRIOR)), weight)
        if belief <= OTHER_PRIOR or not other.any() or decide(words, odds)[other].mean() <= MOST_POSITIVE:
            return PageModel(model, odds)
        belief = max(belief / 2, OTHER_PRIOR)


def _read(batches, text: str, judged: str | None, keep: list[str], lines: bool, model):
    """Of each batch the residue flags, or the furniture lines of what is none."""
    shared = model.value
    for b in slices(batches):
        d = Lines([t.split("\n") if t else [] for t in b.column(b.schema.get_field_index(text)).to_pylist()])
        states = main_content.viterbi(d, *shared.lines)
        bad = decide(Words(d, states), shared.odds)
        if judged:
            bad &= np.array(b.column(b.schema.get_field_index(judged)).to_pylist(), bool)
        kept = b.select(keep)
        if not lines:
            yield kept.append_column("is_residue", pa.array(bad))
            continue
        aside = np.flatnonzero((states > 0) & ~bad[d.page])
        kept = kept.take(pa.array(d.page[aside], pa.int64()))
        yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(d.numbers[aside] + 1, pa.int32())], names=[*keep, "line_no"])


def residue(pages: DataFrame, text: str, model: PageModel, *columns: str) -> DataFrame:
    """columns and is_residue of every page: whether it is no genuine content.
    Null, empty and blank texts, and texts of furniture only, are False. Whole
    texts are read in Arrow batches, without a shuffle; the model (a few MB,
    whatever the data) is broadcast."""
    if "is_residue" in columns:
        raise ValueError("is_residue exists")
    shared = pages.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*(pages.schema[c] for c in columns), T.StructField("is_residue", T.BooleanType())])
    return pages.select(*columns, text).mapInArrow(partial(_read, text=text, judged=None, keep=list(columns), lines=False, model=shared), schema)


def furniture_lines(texts: DataFrame, text: str, model: PageModel, judged: Column, *columns: str) -> DataFrame:
    """columns and line_no (from 1, split at \\n) of each line that is not main
    body, in one pass. Texts that are judged and found to be residue give
    none, nor do blank lines, null and empty texts."""
    if "line_no" in columns:
        raise ValueError("line_no exists")
    shared = texts.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*(texts.schema[c] for c in columns), T.StructField("line_no", T.IntegerType())])
    run = partial(_read, text=text, judged="__judged", keep=list(columns), lines=True, model=shared)
    return texts.select(*columns, text, F.coalesce(judged, F.lit(False)).alias("__judged")).mapInArrow(run, schema)
