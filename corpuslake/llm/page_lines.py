"""Lines of a page: labels for training pages, and features that share nothing
with the labels' wordings.

The wordings below label a bounded sample of training pages, together with
what repeats from page to page in that sample. No feature of a line looks at
them: features are hashed words, shapes and places, so a model fitted on the
labels also finds wordings that no list has.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

import numpy as np

# Wordings by which sites mark what is not their main content,
# one alternative for each kind. Labels of training pages only.
KINDS: dict[str, str] = {
    "top": r"menu|skip to (?:main )?content|toggle navigation|main navigation|jump to navigation",
    "crumb": r"home\s*(?:[>»/›]|::).+",
    "cookie": r"we use cookies\b.*|cookies help\b.*|by using\b.*\bcookies\b.*|tracking files are stored\b.*|your privacy:.*|(?:\[.?\]\s*)?we value your privacy.*",
    "byline": (
        r"(?:posted|written|published|reviewed|prepared for the web)\b.{0,20}\bby\b.{3,60}|reviewed \d{4}-\d\d-\d\d by.*|by [^.,]{3,40}, .{3,40} staff|"
        r"contact person:.*|(?:last )?updated\b.*\bby the\b.*|written by:.*"
    ),
    "share": (
        r"share this page\b.*|like this story\?.*|tell a friend about\b.*|rate this answer\b.*|was this page helpful\b.*|print ?\| ?save as.*|"
        r"add to calendar\b.*|report a problem with this page\b.*|\[\+\] ?text size.*|follow .{2,40} for updates|subscribe to\b.*|sign up for\b.*|"
        r"download the .{2,40} app\b.*|\d+ comments? - log ?in.*|advertisement\b.*"
    ),
    "foot": (
        r"(?:©|\(c\) ?\d{4}|copyright \d{4}).*|(?:back to )?top of page\b.*|powered by\b.*|website by\b.*|office hours\b.*|terms ?[-|·] ?privacy.*|"
        r"p\.? ?o\.? box\b.*|this notice is given as the law requires\b.*|(?:nothing|no \w+) on \S+ is legal advice\b.*|"
        r"(?:the )?text shown here is not the official edition\b.*|last updated\b.*"
    ),
    "box": r"in this section|related (?:pages|links|documents)|more from .{2,40}|upcoming events|quick links|popular pages|you may also like|latest news",
    "also": r"see also:? .*|related: .*|read (?:next|more)\b ?[-:].*|(?:next|previous|up next): .*",
}
# The same for wordings that don't begin the line: kind, words that the line
# must have for the pattern to be worth a try, pattern.
WITHIN: list[tuple[str, str, str]] = [
    ("cookie", "cookies", r".*\b(?:site|website|page|portal)\b.{0,30}\b(?:uses?|usa|utilise)\b.{0,20}\bcookies\b.*|este sitio\b.{0,30}\busa\b.{0,20}\bcookies\b.*"),
    ("cookie", " small files on your device", r".*\bstores? small files on your device\b.*"),
    ("byline", " office", r"[^.|]{3,40}\|[^.|]{3,40} office ?\|.{6,20}"),
    ("byline", " reports from ", r"[^.,]{3,40} reports from [^.]{3,30}"),
    ("foot", "legal publishing ", r".*\blegal publishing \d{4} - .*"),
    ("foot", "does not discriminate", r".*\bdoes not discriminate in its programs\b.*"),
    ("foot", "all rights reserved", r".*\ball rights reserved\.?"),
    ("foot", "phone", r".*\bphone\b.{0,12}\d.*\bfax\b.*"),
    ("foot", "are for convenience", r".*\bsummaries on \S+ are for convenience\b.*"),
]
_ALL = re.compile("|".join(f"(?P<{k}>(?:{v}))" for k, v in KINDS.items()), re.I)
_WITHIN = [(kind, word, re.compile(rx)) for kind, word, rx in WITHIN]

_BULLET = re.compile(r"^\s*(?:[-*+•»>·]|o(?= ))\s*")
_SPACE = re.compile(r"\s+")
_NAV_CUT = re.compile(r"\s*(?:\||·|::|/|>|»|•| - )\s*|\s{2,}")
_NUMBERED = re.compile(r"(?:(?:section|article|rule|chapter|part|title|item)\s+[\d\-.]+|§|\([a-z0-9]{1,3}\)|\d+(?:\.\d+)+\b|\d+\.\s)", re.I)
_LISTED = re.compile(r"item \d+|\$\d|\bmotion to\b|, see | - .+ / |\(\w+\): ", re.I)
_CAPITAL = re.compile(r"(?<=\S )[^\W\d_a-z][^\W\d_]+(?:'s)?")
_NUMBER = re.compile(r"\d+")

#: A line repeats in a training sample if so large a share of its pages (and
#: at least LEAST_PAGES) has it, names and numbers aside.
REPEATED, LEAST_PAGES = 0.004, 4
#: Characters of a line from which a page has prose of its own.
PROSE = 120


def kind_of(line: str) -> str:
    """The kind of furniture a line is by its wording, or ''."""
    line = _SPACE.sub(" ", line).strip()
    m = _ALL.fullmatch(line)
    if m:
        return m.lastgroup
    low = line.lower()
    for kind, word, pattern in _WITHIN:
        if word in low and pattern.fullmatch(low):
            return kind
    return ""


def is_menu(line: str) -> bool:
    """A menu: one or more entries of a word (or two), nothing else."""
    raw = line.replace("\xa0", " ")
    body = _BULLET.sub("", raw).strip()
    if not body or body[-1] in ".:;?!,":
        return False
    items = [x for x in _NAV_CUT.split(body) if x]
    if len(items) == 1:
        return " " not in body and body.replace("-", "").isalpha()
    return all(len(x) < 22 and x.count(" ") <= 1 and x.replace(" ", "").isalpha() for x in items) and (
        len(items) > 2 or all(" " not in x for x in items)
    )


def is_title(line: str) -> bool:
    """A short line that is no sentence: a heading, or a link's text."""
    body = _BULLET.sub("", line).strip()
    return 8 < len(body) < 130 and body[-1] not in ".;:!?," and body.count(" ") >= 2


def plain_line(line: str) -> str:
    """A line with its names and numbers masked, by which repeats are told."""
    line = _SPACE.sub(" ", line).strip()
    return _CAPITAL.sub("_", _NUMBER.sub("0", line)).lower()


def repeated_lines(pages: list[list[str]]) -> set[str]:
    """Masked lines that recur over the pages with prose of their own. A page
    without (an error page) and a copy (most of its prose was there before)
    don't count, so what errors and copies say is no furniture."""
    count: Counter[str] = Counter()
    known: set[str] = set()
    full = 0
    for p in pages:
        prose = {plain_line(x) for x in p if len(x) >= PROSE}
        if 2 * len(prose - known) > len(prose):
            full += 1
            count.update({plain_line(x) for x in p if x.strip()})
        known |= prose
    least = max(LEAST_PAGES, REPEATED * full)
    return {x for x, n in count.items() if n >= least}


def page_labels(lines: list[str], repeated: set[str] | frozenset[str] = frozenset(), kind=kind_of) -> list[int]:
    """0 main content, 1 furniture, 2 link box, of a training page: by the
    trusted wordings, by what repeats, and for the titles that follow a link
    box's heading; blank lines are -1."""
    out, box = [], False
    for line in lines:
        if not line.strip():
            out.append(-1)
            continue
        what = kind(line)
        if what == "box":
            out.append(2)
            box = True
        elif what:
            out.append(1)
            box = False
        elif is_menu(line):
            out.append(1)
        elif box and is_title(line) and not _NUMBERED.match(_BULLET.sub("", line).strip()) and not _LISTED.search(line):
            out.append(2)
        else:
            out.append(1 if repeated and plain_line(line) in repeated else 0)
            box = False
    return out


# ---- Features -------------------------------------------------------------

# Marks of machine template fields.
FIELD = re.compile(r"\{\{[^{}\n]{1,60}\}\}|\{%[^\n]{1,60}?%\}|<%[^\n]{1,60}?%>|[$#]\{[^{}\n]{1,60}\}|%%[\w.]{1,40}?%%|@@[\w.]{1,40}?@@|\[\[[\w. ]{1,40}\]\]|\[%[^\n]{1,60}?%\]|__[A-Za-z][\w.]{0,40}?__")
FIELD_SIGN = re.compile(r"[{<%@\[]|__")

#: Places of the hashed words, then the shapes.
WORD_BITS = 15
WORDS = 1 << WORD_BITS
_SHAPES = (
    [f"len{i}" for i in range(12)] + [f"words{i}" for i in range(10)]
    + [f"end{c}" for c in ".:;?!,)"] + ["end_word", "end_digit", "end_other"]
    + ["bullet", "numbered", "money", "upper", "titled", "lower_first", "digit_first", "sign_first"]
    + [f"cut{c}" for c in ("|", "/", ">", "»", "::", "·", "•", " - ", "  ")] + ["url", "few_letters", "one_word", "colon_early"]
)
_AT = {name: i for i, name in enumerate(_SHAPES)}
SHAPES = len(_SHAPES)
#: Own words and shapes, the line before's and the line after's shapes and
#: first words, then the place in the page.
EDGE_BITS = 10
PLACES = 8
FEATURES = WORDS + 3 * SHAPES + 2 * (1 << EDGE_BITS) + PLACES
_CUTS = ("|", "/", ">", "»", "::", "·", "•", " - ", "  ")
_EDGES = ".,;:!?()[]{}\"'“”‘’«»*•-_/|#>"

#: A token's value: 32 bits for the line field, then for the residue classes
#: the place of its word from 1 (0: no word), then flags.
RESIDUE_BITS = 17
_ENDS, _OPENS, _IS_FIELD = 1 << 50, 1 << 51, 1 << 52


def residue_place(word: str) -> int:
    """Place of a word in the residue model's hashed space."""
    import xxhash

    return xxhash.xxh32_intdigest(word, 5) & ((1 << RESIDUE_BITS) - 1)


class _Tokens(dict):
    """token as written -> its value. Words are told case and edge signs
    aside, a number is '#'. Emptied when large."""

    def __missing__(self, token: str) -> int:
        import xxhash

        if len(self) > 300_000:
            self.clear()
        if token == "<field>":
            word, flags = token, _IS_FIELD
        else:
            word = token.strip(_EDGES).lower()
            word = "#" if word[:1].isdigit() or word[:1] in ("$", "§") and word else word
            flags = (_ENDS if token[-1] in ".!?:" else 0) | (_OPENS if token[0] == "(" and token[1:2].isupper() else 0)
        value = self[token] = xxhash.xxh32_intdigest(word or token, 11) | (residue_place(word) + 1 if word else 0) << 32 | flags
        return value


_TOKENS = _Tokens()


def _shapes(line: str) -> tuple[int, ...]:
    """Shape places of a line whose ends are trimmed."""
    out = [_AT[f"len{min(11, len(line).bit_length())}"]]
    add = lambda name: out.append(_AT[name])
    bare = _BULLET.sub("", line)
    if bare != line:
        add("bullet")
    n = bare.count(" ") + 1
    add(f"words{min(9, n if n < 5 else 3 + n.bit_length())}")
    end = bare[-1:] or line[-1]
    add(f"end{end}" if f"end{end}" in _AT else "end_word" if end.isalpha() else "end_digit" if end.isdigit() else "end_other")
    if _NUMBERED.match(bare):
        add("numbered")
    if "$" in bare:
        add("money")
    if bare.isupper():
        add("upper")
    elif bare.istitle():
        add("titled")
    if len(bare) < 80 and 2 * sum(map(str.isalpha, bare)) < len(bare):
        add("few_letters")
    first = bare[:1]
    add("lower_first" if first.islower() else "digit_first" if first.isdigit() else "sign_first") if first and not first.isupper() else None
    for c in _CUTS:
        if c in bare:
            add(f"cut{c}")
    if ".example" in bare or "www." in bare or "://" in bare:
        add("url")
    if n == 1:
        add("one_word")
    if 0 <= bare.find(":") < 24:
        add("colon_early")
    return tuple(out)


_short_shapes = lru_cache(50_000)(_shapes)


class Lines:
    """The lines of several pages that aren't blank, flat: features for the
    line field, token values for the residue classes. Whole lines are read,
    however long; machine fields are marked."""

    def __init__(self, pages: list[list[str]]):
        numbers, sizes, ends, gaps = [], [], [], []
        shapes, per_shape, tokens, chars, per_line = [], [], [], [], []
        for page in pages:
            before, count = -1, 0
            for i, raw in enumerate(page):
                line = raw.replace("\xa0", " ").strip()
                if not line:
                    continue
                if FIELD_SIGN.search(line):
                    line = FIELD.sub(" <field> ", line).strip()
                own = _short_shapes(line) if len(line) < 160 else _shapes(line)
                shapes += own
                per_shape.append(len(own))
                t = line.split()
                tokens += map(_TOKENS.__getitem__, t)
                chars += map(len, t)
                per_line.append(len(t))
                numbers.append(i)
                ends.append(line[-1])
                gaps.append(i == 0 or i - before > 1)
                before = i
                count += 1
            sizes.append(count)
        whole = lambda x: np.array(x, np.int64)
        self.pages, self.count = len(pages), len(numbers)
        self.numbers, self.ends = whole(numbers), ends
        self.tokens, self.chars = whole(tokens), whole(chars)
        self.page = np.repeat(np.arange(len(pages)), sizes)
        self.token_line = np.repeat(np.arange(self.count), per_line)
        self.sizes = whole([n for n in sizes if n])  # of the pages that have lines
        self.start = np.concatenate(([0], np.cumsum(self.sizes)[:-1])).astype(np.int64) if len(self.sizes) else whole([])
        self.order = np.argsort(-self.sizes, kind="stable")
        if self.count:
            self._features(whole(shapes), whole(per_shape), whole(per_line), np.array(gaps, bool))

    def _features(self, shapes, per_shape, per_line, gaps) -> None:
        line = np.arange(self.count)
        t = (self.tokens & 0xFFFFFFFF).astype(np.uint32)
        with np.errstate(over="ignore"):
            pair = (t[:-1] * np.uint32(0x9E3779B1)) ^ (t[1:] * np.uint32(0x85EBCA77))
            inside = self.token_line[:-1] == self.token_line[1:]
            first = np.concatenate(([0], np.cumsum(per_line)[:-1]))
            marks = np.concatenate((t, pair[inside], t[first] ^ np.uint32(0x5BD1E995), t[first + per_line - 1] ^ np.uint32(0x27D4EB2F)))
            words = (marks * np.uint32(0x9E3779B1) >> np.uint32(32 - WORD_BITS)).astype(np.int64)
            edge = ((t[first] * np.uint32(0x85EBCA77)) >> np.uint32(32 - EDGE_BITS)).astype(np.int64)
        word_line = np.concatenate((self.token_line, self.token_line[:-1][inside], line, line))
        shape_line = np.repeat(line, per_shape)
        fresh = np.zeros(self.count + 1, bool)  # lines that begin a page
        fresh[self.start] = fresh[-1] = True
        follows, leads = ~fresh[:-1], ~fresh[1:]
        place = line - np.repeat(self.start, self.sizes)
        left = np.repeat(self.sizes, self.sizes) - 1 - place
        e0 = WORDS + 3 * SHAPES
        last = e0 + 2 * (1 << EDGE_BITS)
        where = np.where((left >= 4) | (place < 2), last + np.minimum(place, 3), last + 4 + np.minimum(left, 1))
        to_next, to_prev = leads[shape_line], follows[shape_line]
        ids = [
            words, WORDS + shapes, WORDS + SHAPES + shapes[to_next], WORDS + 2 * SHAPES + shapes[to_prev],
            e0 + edge[leads], e0 + (1 << EDGE_BITS) + edge[follows], where, np.full(int(gaps.sum()), last + 6), np.full(self.count, last + 7),
        ]
        at = [word_line, shape_line, shape_line[to_next] + 1, shape_line[to_prev] - 1, line[leads] + 1, line[follows] - 1, line, line[gaps], line]
        self.ids, self.line = np.concatenate(ids), np.concatenate(at)
        # Words of a line weigh 1/sqrt of their number, so long lines don't shout.
        weight = 1 / np.sqrt(np.bincount(word_line, minlength=self.count))
        self.value = np.concatenate((weight[word_line], np.full(len(self.ids) - len(words), 0.5)))

    def features_only(self) -> Lines:
        """Itself without what the line field needs no more; in half the space."""
        self.tokens = self.chars = self.token_line = self.page = self.numbers = self.ends = None
        if self.count:
            self.ids, self.line = self.ids.astype(np.int32), self.line.astype(np.int32)
        return self

    def live(self, k: int) -> np.ndarray:
        """Pages (of those with lines) with more than k lines."""
        return self.order[: int((self.sizes > k).sum())]
