"""The layers that read documents alone, counted in one pass: whole documents go by, no line is exchanged, sorted or cached.

The rules are those of ``rules``, ``maths``, ``keys``, ``items`` and ``scans``. What a pattern tells of a line is worked out once
for all lines of some documents; what stands before or after a line is then an index, and no text travels. Only lines that hold
a number are looked at one by one. Patterns are read by RE2, as in the DuckDB twins. Documents are taken in slices of ``SLICE``
bytes, so a task holds the lines of a slice, or of one longer document, four times: once for each markup.

``docs`` must have one row a ``doc_id``, none of them null, negative or beyond ``MOST_ID``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Collection, Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from ..functions import patterns as P
from ..functions.text import SPACES
from ..plans.markup import ITEMS, KINDS, MATHS, SCANS, STRUCTURE, _parts
from . import items as I
from . import rules as R

LAYERS = ("0", "A", "B", "C", "D", "G")
#: Bytes of text whose lines are held at once.
SLICE = 4 << 20
#: Beyond it, the polynomial of a line's kind might not fit 64 bits.
MOST_ID = 10**12
COUNTS = "doc_id long, layer string, rule string, severity string, n long"

_TEXT = pa.large_string()
#: What a layer has found: a rule, its severity, and the documents (by their place in the slice), one entry a finding.
Found = Iterator[tuple[str, str, np.ndarray]]


def _compiled(pattern: str) -> re.Pattern:
    """A pattern as Python's, read as RE2 reads it: digits are ASCII, and a vertical tab is no space."""
    out, inside = "", False
    for x in re.findall(r"\\.|.", pattern):
        if x in ("\\s", "\\S"):
            x = "\\t\\n\\f\\r " if inside else f"[{'^' * (x == '\\S')}\\t\\n\\f\\r ]"
        inside = x == "[" or (inside and x != "]")
        out += x
    return re.compile(out, re.ASCII)


@lru_cache
def _markup(name: str) -> tuple[pa.Array, np.ndarray, pa.Array]:
    """What stands before the raw line by kind, document and line number, whether the raw line follows, and what stands behind it."""
    parts = [_parts({"STRUCTURE": STRUCTURE, "MATHS": MATHS, "ITEMS": ITEMS, "SCANS": SCANS}[name].get(k, "{raw}")) for k in range(KINDS)]
    before = []
    for p0, what, p2, _, _ in parts:
        for d in range(9):
            before += [p0 + {"key": f"{d + 1}.{n % 5 + 1}-{n % 6 + 1}", "n": str(n % 9 + 1)}.get(what, "") + p2 for n in range(90)]
    return pa.array([*before, ""], _TEXT), np.array([p[3] for p in parts]), pa.array([*[p[4] for p in parts], ""], _TEXT)


class Lines:
    """The marked-up lines of some documents; ``doc`` is the place of a line's document."""

    def __init__(self, line: pa.Array, doc: np.ndarray, docs: int):
        self.line, self.doc, self.docs, self.at = line, doc, docs, np.arange(len(doc))
        starts = np.searchsorted(doc, np.arange(docs + 1))
        self.first, self.last = starts[doc], starts[doc + 1] - 1
        self.no = self.at - self.first + 1
        self.t = pc.utf8_trim(line, characters=SPACES)
        self.prev, self.next = np.where(self.at > self.first, self.at - 1, -1), np.where(self.at < self.last, self.at + 1, -1)
        self._known: dict[tuple[str, str], np.ndarray] = {}

    def _told(self, kind: str, said: str, tell: Callable[[], pa.Array]) -> np.ndarray:
        if (kind, said) not in self._known:
            self._known[kind, said] = tell().to_numpy(zero_copy_only=False)
        return self._known[kind, said]

    def has(self, pattern: str) -> np.ndarray:
        return self._told("line", pattern, lambda: pc.match_substring_regex(self.line, pattern))

    def t_has(self, pattern: str) -> np.ndarray:
        return self._told("t", pattern, lambda: pc.match_substring_regex(self.t, pattern))

    def starts(self, text: str) -> np.ndarray:
        return self._told("starts", text, lambda: pc.starts_with(self.t, text))

    def ends(self, text: str) -> np.ndarray:
        return self._told("ends", text, lambda: pc.ends_with(self.t, text))

    def holds(self, text: str) -> np.ndarray:
        return self._told("holds", text, lambda: pc.match_substring(self.t, text))

    def is_(self, text: str) -> np.ndarray:
        return self._told("is", text, lambda: pc.equal(self.t, text))

    @cached_property
    def blank(self) -> np.ndarray:
        return self.is_("")

    @cached_property
    def bq(self) -> np.ndarray:
        return pc.starts_with(self.line, ">").to_numpy(zero_copy_only=False)

    @cached_property
    def said_before(self) -> np.ndarray:
        return self.before(~self.blank)

    @cached_property
    def said_after(self) -> np.ndarray:
        return self.after(~self.blank)

    def through(self, what: np.ndarray) -> np.ndarray:
        """The last line up to this one of which ``what`` holds; -1 if there is none."""
        seen = np.maximum.accumulate(np.where(what, self.at, -1))
        return np.where(seen >= self.first, seen, -1)

    def before(self, what: np.ndarray) -> np.ndarray:
        seen = np.r_[-1, np.maximum.accumulate(np.where(what, self.at, -1))[:-1]]
        return np.where(seen >= self.first, seen, -1)

    def after(self, what: np.ndarray) -> np.ndarray:
        seen = np.r_[np.minimum.accumulate(np.where(what, self.at, len(self.at))[::-1])[::-1][1:], len(self.at)]
        return np.where(seen <= self.last, seen, -1)

    def count_before(self, what: np.ndarray) -> np.ndarray:
        sums = np.cumsum(what) - what
        return sums - sums[self.first]

    def latch(self, on: np.ndarray, off: np.ndarray) -> np.ndarray:
        return of(self.before(on | off), on)

    def texts(self, where: np.ndarray) -> Iterator[tuple[int, str]]:
        at = np.flatnonzero(where)
        return zip(at.tolist(), self.line.take(pa.array(at)).to_pylist(), strict=True)


def of(at: np.ndarray, what: np.ndarray) -> np.ndarray:
    """Whether ``what`` holds of the line ``at``; of no line it does not."""
    return (at >= 0) & what[at]


class Documents:
    """Some documents, none of them without a text, and their lines in each markup."""

    def __init__(self, ids: np.ndarray, texts: pa.Array):
        self.ids = ids
        listed = pc.split_pattern(texts, "\n")
        ends = listed.offsets.to_numpy()
        self.raw = pa.concat_arrays([listed.values.cast(_TEXT), pa.array([""], _TEXT)])
        sizes = np.diff(ends)
        self.of, self.n = np.repeat(np.arange(len(ids)), sizes), np.arange(len(self.raw) - 1) - np.repeat(ends[:-1], sizes) + 1

    def marked(self, name: str) -> Lines:
        before, whole, behind = _markup(name)
        doc, n = self.ids[self.of], self.n.astype(np.int64)
        kind = (doc * 7919 + n * n * 131 + n * 613) % 10007 % KINDS
        lead = (kind * 9 + doc % 9) * 90 + n % 90
        src = np.repeat(np.arange(len(n)), np.where(whole[kind], 1, 2))
        second = np.r_[False, src[1:] == src[:-1]] if len(src) else np.zeros(0, bool)
        alone = ~whole[kind][src] & ~second
        parts = before.take(pa.array(np.where(second, len(before) - 1, lead[src]))), self.raw.take(pa.array(np.where(alone, len(n), src))), behind.take(pa.array(np.where(second, KINDS, kind[src])))
        return Lines(pc.binary_join_element_wise(*parts, pa.scalar("", _TEXT)), self.of[src], len(self.ids))


# --- G: structure rules

_HEAD, _BREAK = P.HEADING, "---"


def _example_gap(x: Lines, example: str) -> np.ndarray:
    stop = x.has(example) | x.has(P.HEADING) | x.has(P.DASH) | x.has(P.BARE_STATEMENT)
    stops, proof, bad = x.count_before(stop), x.after(x.has(P.PROOF)), x.after(x.blank | ~x.bq)
    near = (proof >= 0) & (proof < x.at + 25) & (stops[proof] == stops + stop)
    return x.has(example) & near & (bad >= 0) & (bad < proof)


def _unlabeled(x: Lines) -> np.ndarray:
    """Lines of quotes whose first line with content opens no proof, example or note."""
    quoted = x.starts(">")
    opener = x.has(P.QUOTE_OPENER) | x.has(P.QUOTE_FOOTNOTE)
    group = np.cumsum(quoted & (~of(x.prev, quoted) | opener))
    content = np.flatnonzero(quoted & ~x.has(r"^\s*>$"))
    groups, nth = np.unique(group[content], return_index=True)
    decides = np.full(int(group[-1]) + 1, -1)
    decides[groups] = content[nth]
    fine = opener | x.has(P.QUOTED_STATEMENT_CN)
    first = decides[group]
    return quoted & (first >= 0) & ~of(first, fine) & ~x.is_(">")


def _empty_runs(x: Lines) -> np.ndarray:
    on = x.starts("> **") & (x.holds("证明") | x.holds("例") | x.holds("注"))
    inside = x.latch(on, x.t_has(P.DASH) | x.t_has(P.HEADING) | x.t_has(P.STATEMENT_CN))
    empty = x.is_(">")
    run = np.cumsum(empty & ~of(x.prev, empty))
    _, first, n = np.unique(run[empty & inside], return_index=True, return_counts=True)
    return x.doc[empty & inside][first[n > 1]]


_ORDINALS = [_compiled(p) for p in (P.ORDINAL_PAREN, P.ORDINAL_BOLD, P.ORDINAL_PLAIN)]
_ROMAN, _ROMAN_SIGN = re.compile(P.ROMAN), re.compile("[ivxlcdm]")
_VALUES = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100, "d": 500, "m": 1000}


def _roman(label: str) -> int:
    if not _ROMAN.match(label):
        return 0
    return sum(_VALUES[c] for c in label) - sum(v for pair, v in (("i[vx]", 2), ("x[lc]", 20), ("c[dm]", 200)) if re.search(pair, label))


def _ordinal_gaps_of(labels: list[str]) -> int:
    """How many gaps a block of ordinals has: one before its lowest number, one inside."""
    digits = [x.isdigit() for x in labels]
    long = [x for x in labels if len(x) > 1]
    romans = all(_ROMAN.match(x) for x in long) if long else all(_ROMAN_SIGN.fullmatch(x) for x in labels)
    if any(digits):
        numbers = [whole(x, 1 << 63) if d else 0 for x, d in zip(labels, digits, strict=True)]
    elif romans:
        numbers = [_roman(x) for x in labels]
    else:
        numbers = [ord(x) - 96 if len(x) == 1 else None for x in labels]
    numbers = [n for n in numbers if n is not None and n > 0]
    if len(numbers) < 3:
        return 0
    low, high = min(numbers), max(numbers)
    return (low > 1) + (high - low + 1 > len(set(numbers)))


def whole(digits: str, limit: int = 1 << 31) -> int | None:
    """The number that ASCII digits are; none from ``limit`` on."""
    digits = digits.lstrip("0")
    return int(digits or 0) if len(digits) < 20 and int(digits or 0) < limit else None


def _ordinal_gaps(x: Lines) -> np.ndarray:
    quoted = x.starts(">")
    rows = x.has(P.ORDINAL_PAREN) | x.has(P.ORDINAL_BOLD) | (x.has(P.ORDINAL_PLAIN) & ~quoted)
    found: list[int] = []
    labels: list[str] = []
    was = None

    def close() -> None:
        if len(labels) >= 3:
            found.extend([was[0]] * _ordinal_gaps_of(labels))

    for i, line in x.texts(rows):
        doc, no = int(x.doc[i]), int(x.no[i])
        if was is None or doc != was[0] or no - was[1] > 4:
            close()
            labels = []
        said = next((m for k, p in enumerate(_ORDINALS) if (k < 2 or not quoted[i]) and (m := p.search(line))), None)
        if said:
            labels.append(said[1])
            was = doc, no
    close()
    return np.array(found, np.int64)


def structure(x: Lines) -> dict[str, np.ndarray]:
    """Which lines break a rule, or the documents of what is found if that is no line; ``separator_blanks`` may find a line twice."""
    quoted, head, dash = x.starts(">"), x.has(_HEAD), x.is_(_BREAK)
    ahead, behind = x.said_after, x.said_before
    off = (x.has(P.QUOTE_END) & ~quoted) | (~x.blank & ~x.bq)
    ends = of(ahead, x.has(P.QUOTE_HEAD) | (x.has(P.QUOTE_END) & ~quoted))
    item, stop = x.has(P.STATEMENT) | x.has(P.ITEM_EXAMPLE), dash | head
    stops, following = x.count_before(stop), x.after(item)
    fence = x.is_("$$")
    displayed = ~fence & (x.count_before(fence) % 2 == 1) & (x.after(fence) >= 0)
    in_item = x.latch(x.has(P.STATEMENT_OR_FORMULA) | x.has(P.SUBPOINT), quoted | head)
    proof = pc.starts_with(x.line, "> **证明").to_numpy(zero_copy_only=False)
    return {
        "quote_continuity": x.blank & ~x.bq & x.latch(x.has(P.QUOTE_HEAD), off) & (ahead >= 0) & ~ends,
        "nested_quote": x.has(P.NESTED_QUOTE),
        "same_line_proof": x.starts("> **例") & x.holds("**证明"),
        "example_proof_gap": _example_gap(x, P.EXAMPLE),
        "numbered_example_proof_gap": _example_gap(x, P.EXAMPLE_NUMBERED),
        "struct_in_quote": x.has(P.QUOTED_STATEMENT) & ~x.has(P.QUOTED_PROOF_OF),
        "orphan_quote": x.has(P.EMPTY_QUOTE) & ~of(behind, quoted) & ~of(ahead, quoted),
        "stmt_in_quote": x.latch(x.has(P.STATEMENT_OR_FORMULA), x.has(P.QUOTE_LEGIT)) & x.has(P.QUOTE_WRAPPED),
        "unlabeled_quote": _unlabeled(x),
        "missing_quote": ~quoted & ~head & (x.t_has(P.QUOTE_MISSING) | x.t_has(P.FOOTNOTE)),
        "missing_separator": item & (following >= 0) & (following - x.at <= 100) & (stops[following] == stops),
        "dash_in_item": x.has(P.DASH) & in_item & of(ahead, x.has(P.SUBPOINT)),
        "proof_after_list": x.has(P.LISTED) & of(x.next, x.starts("> **证明")),
        "separator_blanks": np.r_[x.doc[dash & of(x.prev, ~x.blank)], x.doc[dash & of(x.next, ~x.blank)]],
        "displaymath_gt": displayed & quoted,
        "empty_quote_runs": _empty_runs(x),
        "ordinal_gaps": _ordinal_gaps(x),
        "dash_under_heading": dash & of(behind, head),
        "dash_before_proof": dash & x.latch(x.has(P.STATEMENT), head) & ~of(behind, head) & of(ahead, proof),
        "item_as_heading": x.has(rf"^#{{1,6}}\s+\*{{0,2}}(?:{P.LABELS}|{P.LABELS_EN})") | (x.has(r"^##\s") & ~x.has(r"^##\s+§")),
        "mojibake": x.has(P.MOJIBAKE),
        "bracket_display": x.has(r"\\[\[\]]"),
    }


# --- C: maths rules


def _dollars(x: Lines, outside: np.ndarray) -> np.ndarray:
    """Documents whose inline ``$`` outside displays do not pair up."""
    bare = pc.replace_substring(x.line.filter(pa.array(outside)), "\\$", "")
    counts = np.bincount(x.doc[outside], pc.count_substring(bare, "$").to_numpy(zero_copy_only=False), x.docs)
    return np.flatnonzero(counts.astype(np.int64) % 2 == 1)


def _fenced(x: Lines, fence: np.ndarray) -> np.ndarray:
    """Closed code fences whose lines look like a formula or diagram, by their documents."""
    signs = x.has(f"[{P.FENCE_SIGNS}]")
    for token in P.FENCE_TOKENS:
        signs = signs | pc.match_substring(x.line, token).to_numpy(zero_copy_only=False)
    nth = x.count_before(fence) + fence
    closed = (nth % 2 == 1) & (nth < np.bincount(x.doc[fence], minlength=x.docs)[x.doc])
    return np.unique(np.stack([x.doc, nth])[:, closed & signs & ~fence], axis=1)[0]


_SPANS = ((r"\\\[.*?\\\]", " "), (r"\\[\[\]]", "$$"), (r"\\\(.*?\\\)", " "), (r"\\\$", " "), (r"`[^`]*`", " "), (r"\$\$.*?\$\$", " "), (r"(^|[^$])\$[^$]+\$", r"\1 "))


def _plain(x: Lines, live: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """The lines outside code and displays, and their texts without inline maths and code."""
    marked = np.flatnonzero(live & pc.match_substring_regex(x.line, r"[$\\`]").to_numpy(zero_copy_only=False))
    cut = x.line.take(pa.array(marked))
    for pattern, new in _SPANS:
        cut = pc.replace_substring_regex(cut, pattern, new)
    fences = np.zeros(len(x.at), np.int64)
    fences[marked] = pc.count_substring(cut, "$$").to_numpy(zero_copy_only=False)
    plain = live & (x.count_before(fences) % 2 == 0) & (fences == 0)
    place = x.at.copy()
    place[marked] = len(x.at) + np.arange(len(marked))
    at = np.flatnonzero(plain)
    return at, pa.concat_arrays([x.line, cut]).take(pa.array(place[at]))


def maths(x: Lines) -> dict[str, np.ndarray]:
    lone, opens, code, quoted = x.is_("$$"), x.starts("> $$"), x.starts("```"), x.starts(">")
    edge = (x.prev < 0) | (x.next < 0)
    in_plain, in_quoted, in_code = x.count_before(lone & ~edge) % 2 == 1, x.count_before(opens) % 2 == 1, x.count_before(code) % 2 == 1
    outside = ~(lone | opens | in_plain | in_quoted)
    later = x.after(lone) >= 0
    chars, size = (f(x.t).to_numpy(zero_copy_only=False) for f in (pc.utf8_length, pc.binary_length))
    held, begins, ends = pc.find_substring(x.t, "$$").to_numpy(zero_copy_only=False), x.t_has(r"^(?:> \s*)?\$\$"), x.ends("$$")
    bare = lone & ~edge & ~in_plain & ~of(x.next, x.blank | lone) & of(x.prev, ~x.blank & ~quoted)
    under = opens & ~in_quoted & of(x.prev, ~(x.blank | x.is_(">")))
    second = np.where(x.at - 2 >= x.first, x.at - 2, -1)
    at, plain = _plain(x, ~code & ~in_code)
    in_text = lambda pattern: x.doc[at[pc.match_substring_regex(plain, pattern).to_numpy(zero_copy_only=False)]]
    return {
        "escaped_display": x.is_("\\$\\$") | x.is_("> \\$\\$"),
        "nested_display": x.t_has(r"^>\s+>") & (held >= 0),
        "one_line_display": (opens & ends & (chars > 6)) | (x.starts("$$") & ends & (chars > 4)),
        "attached_display": (begins & ~ends) | (ends & ~begins & ~((held >= 0) & (held + 2 <= size - 2))),
        "div_blanks": (x.starts("<div") & of(x.prev, ~x.blank)) | (x.is_("</div>") & of(x.next, ~x.blank)),
        "deep_quoted_display": x.has(P.DEEP_QUOTED_FENCE),
        "display_needs_blank": bare | under,
        "odd_dollars": _dollars(x, outside),
        "bad_macros": outside & x.has("|".join(P.BAD_MACROS)),
        "maths_in_fence": _fenced(x, code),
        "raw_arrows": in_text(f"[{P.RAW_ARROWS}]"),
        "naked_commands": in_text(P.NAKED_COMMAND),
        "swallowed_prefix": ~code & ~in_code & ~x.starts("$$") & x.has(P.SWALLOWED_PREFIX),
        "equation_note": x.t_has(P.EQUATION_NOTE) & (of(x.prev, ends) | (of(x.prev, x.blank) & of(second, ends))),
        "escaped_from_quote": lone & of(x.said_before, x.starts("> ")) & later,
        "list_gap": x.has(P.TOP_ITEM) & of(x.prev, x.has(P.BULLET)),
        "bare_struct_in_quote": x.has(P.BARE_QUOTED_STATEMENT),
        "unclosed_display": lone & (x.count_before(lone) % 2 == 0) & ~later,
    }


# --- A: keys

_ENTRY, _KEY = _compiled(P.ENTRY), _compiled(P.KEY)


def _normal(key: str) -> str:
    parts = key.split(".")
    return f"{parts[0]}.{parts[1]}-{parts[2]}" if len(parts) == 3 else key


def keys(x: Lines, ids: np.ndarray) -> Found:
    """Keys that a summary lacks, only mentions, or has beyond the thirty of its chapter; the first of these is ignored."""
    held: list[dict[str, bool]] = [{} for _ in ids]
    for i, line in x.texts(x.has(P.KEY)):
        own = held[x.doc[i]]
        for m in _ENTRY.finditer(line):
            own[_normal(m[1])] = True
        for m in _KEY.finditer(line):
            own.setdefault(_normal(m[0]), False)
    counts = np.zeros((3, len(ids)), np.int64)
    wanted = [{f"{c}.{s}-{n}" for s in range(1, 6) for n in range(1, 7)} for c in range(1, 10)]
    for d, (c, own) in enumerate(zip((ids % 9).tolist(), held, strict=True)):
        noise = f"{c + 1}.1-1"
        known = own.keys() & wanted[c]
        counts[:, d] = 29 - len(known - {noise}), sum(not own[k] for k in known if k != noise), len(own) - len(known)
    for rule, severity, n in zip(("missing", "mentioned", "extra"), (R.BLOCKS, R.WARNS, R.WARNS), counts, strict=True):
        yield rule, severity, np.repeat(np.arange(len(ids)), n)


# --- D: sections, and 0: labels

_HEADS = [(_compiled(p), short) for p, short in ((P.SOURCE_HEAD_GLUED, False), (P.SOURCE_HEAD_PLAIN, False), (P.SOURCE_HEAD_SHORT, True))]
_SUMMARY, _NUMBER, _LABELLED = _compiled(P.SUMMARY_HEAD), _compiled(P.SOURCE_NUMBER), _compiled(P.SOURCE_LABEL)
_BOLD_NUMBER = _compiled(r"\d{1,3}\.(\d{1,3})[.\-·](\d{1,3})")


def sections(scan: Lines, summary: Lines, ids: np.ndarray) -> Found:
    """Sections that a scan heads and numbers, against headings of the same scan's lines and numbers of the summary."""
    headed: set[tuple[int, int]] = set()
    shown: set[tuple[int, int]] = set()
    high: dict[tuple[int, int], int] = {}
    own: dict[tuple[int, int], int] = {}
    chapters, docs = (ids % 9 + 1).tolist(), scan.doc.tolist()
    text = scan.t.to_pylist()
    for i in np.flatnonzero(scan.t_has(P.SOURCE_HEAD_GLUED) | scan.t_has(P.SOURCE_HEAD_PLAIN) | scan.t_has(P.SOURCE_HEAD_SHORT)).tolist():
        for pattern, short in _HEADS:
            m = pattern.search(text[i])
            if m and whole(m[1]) == chapters[docs[i]] and (not short or len(text[i]) < 60) and (section := whole(m[2])) is not None:
                headed.add((docs[i], section))
    for i in np.flatnonzero(scan.t_has(P.SUMMARY_HEAD)).tolist():
        m = _SUMMARY.search(text[i])
        if m and whole(m[1]) == chapters[docs[i]] and (section := whole(m[2])) is not None:
            shown.add((docs[i], section))
    for i in np.flatnonzero(scan.t_has(P.SOURCE_NUMBER)).tolist():
        for m in _NUMBER.finditer(text[i]):
            if int(m[1]) == chapters[docs[i]] and (n := int(m[3])) > 0 and _LABELLED.search(text[i], max(m.start() - 10, 0), m.end() + 10):
                place = docs[i], int(m[2])
                high[place] = max(n, high.get(place, 0))
    for i, line in summary.texts(summary.has(r"\*\*") & summary.has(r"\d{1,3}\.\d{1,3}[.\-·]\d{1,3}")):
        for m in _BOLD_NUMBER.finditer(line):
            place = int(summary.doc[i]), int(m[1])
            own[place] = max(int(m[2]), own.get(place, 0))
    state: dict[str, list[int]] = {"missing": [], "suspect": [], "tail": []}
    for place in headed & high.keys():
        gap = high[place] - own.get(place, 0)
        if place not in shown:
            state["missing"].append(place[0])
        elif gap > 0:
            state["suspect" if gap > 5 else "tail"].append(place[0])
    for rule, where in state.items():
        yield f"section_{rule}", R.BLOCKS if rule == "missing" else R.WARNS, np.array(where, np.int64)


def labels(scan: Lines) -> Found:
    """Blocks whose text says another label than they carry."""
    at = np.flatnonzero(~scan.blank)
    text = scan.t.take(pa.array(at))
    label = pc.fill_null(pc.struct_field(pc.extract_regex(text, "(?P<l>定义|定理|引理|例)"), "l"), I.BARE).to_numpy(zero_copy_only=False)
    start = pc.utf8_slice_codeunits(text, 0, 60)
    said, open_ = np.zeros(len(at), bool), np.ones(len(at), bool)
    for name, pattern in P.TEXT_LABELS:
        here = open_ & pc.match_substring_regex(start, pattern).to_numpy(zero_copy_only=False)
        said |= here & (label != name)
        open_ &= ~here
    yield "label_conflict", R.WARNS, scan.doc[at[said]]


# --- B: items and the gaps in their numbering

_THREE, _GARBLED, _CITES, _LABEL = _compiled(I.NUMBER), _compiled(I.GARBLED), _compiled(I.CITES), _compiled(I.LABEL)
_FULL, _FULL_ONLY = _compiled(rf"(?:{I.FULL_LABEL})[\s（）()]*$"), _compiled(f"(?:{I.FULL_LABEL})")


def _label(text: str | None) -> str | None:
    m = _LABEL.search(text) if text else None
    if not m:
        return None
    if "例" in m[0] or "Example" in m[0]:
        return "例"
    return next(cn for cn, en in (("定义", "Definition"), ("定理", "Theorem"), ("引理", "Lemma"), ("推论", "Corollary"), ("命题", "Proposition")) if cn in m[0] or en in m[0])


def _numbers(text: str) -> Iterator[tuple[int, re.Match]]:
    """Every match of the first pattern, and the first of the second."""
    for m in _THREE.finditer(text):
        yield 0, m
    if m := _GARBLED.search(text):
        yield 1, m


def _reference(text: str, m: re.Match, prev: str | None) -> bool:
    """Whether a number is quoted, part of a label that stands before it, of a list or of a range."""
    before, after, lead, tail = text[max(m.start() - 25, 0) : m.start()], text[m.end() : m.end() + 40], text[: m.start()], text[m.end() :]
    if _CITES.search(before) or (prev is not None and _CITES.search(prev[-15:].strip(" "))):
        return True
    if _FULL.search(lead[-8:]) and not _FULL_ONLY.fullmatch(lead.strip(" ")):
        return True
    opened = next((lead.rpartition(x)[2] for x in "（(" if x in lead), None)
    closed = next((tail.partition(x)[0] for x in "）)" if x in tail), None)
    if opened is not None and closed is not None and len(_THREE.findall(opened + m[0] + closed)) >= 2:
        return True
    near = _THREE.search(before) or _THREE.search(after) or re.search("[到至～]", before + after)
    return bool(near and re.search("[例定引推]", before))


class Gap:
    """Where numbers of a section are missing, and the pages to look at."""

    def __init__(self, gap: str, low: int, high: int | None, first: int, last: int):
        self.gap, self.low, self.high, self.first, self.last = gap, low, high, first, last
        self.stage = ("head", "internal", "tail").index(gap)

    def verdict(self, held: list[tuple[int | None, int]]) -> str:
        """``held``: numbers of the section and the stage at which they were found, -1 for items."""
        back = sum(since == self.stage for _, since in held)
        if self.gap == "tail":
            return "suspicious" if not back and self.last - self.first + 1 > I.TAIL else "resolved"
        filled = {n for n, since in held if n is not None and self.low <= n <= self.high and since <= self.stage}
        return "blocking" if back and self.high - self.low + 1 > len(filled) else "resolved"


def _items(rows: list[tuple[int, str, str | None, str | None, str | None]], ch: int) -> dict[tuple[int, int], tuple[int, str]]:
    """``section, number`` -> page and label of a document's items; ``rows``: page, text, the texts around it and the label in force."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for page, text, prev, following, force in rows:
        for kind, m in _numbers(text):
            rest = text[m.end() :].strip(" ") if kind else ""
            if kind and (len(rest) < 8 or not any(c.isalpha() for c in rest[:12])):
                continue
            section, number = whole(m[2]), whole(m[3])
            if whole(m[1]) != ch or section is None or number is None or section > I.MOST_SECTION or number > I.MOST_NUMBER or _reference(text, m, prev):
                continue
            known = best.get((section, number))
            if known and (kind or known[1] != I.BARE):
                continue
            label = _label(text[max(m.start() - 25, 0) : m.start()] + text[m.end() : m.end() + 40]) or force
            if not label:
                label = next((x for x, few in ((_label(prev and prev[-40:]), ("例", "定义")), (_label(following and following[:40]), ("例", "定义", "定理"))) if x in few), I.BARE)
            if not known or label != I.BARE:
                best[section, number] = page, label
    return best


def _gaps(found: dict[tuple[int, int], tuple[int, str]], end: int) -> dict[int, tuple[str | None, list[Gap]]]:
    """The label of each section and its gaps."""
    by: dict[int, dict[int, tuple[int, str]]] = {}
    for (section, number), row in found.items():
        by.setdefault(section, {})[number] = row
    order, out = sorted(by), {}
    for k, section in enumerate(order):
        held = by[section]
        low, high = min(held), max(held)
        last = min(page for page, _ in by[order[k + 1]].values()) - 1 if k + 1 < len(order) else end
        gaps = []
        if low > 1:
            gaps.append(Gap("head", 1, low - 1, 1, held[low][0] - 1))
        if len(held) < high - low + 1:
            gaps.append(Gap("internal", low, high, held[low][0], held[high][0]))
        if last - held[high][0] >= 1:
            gaps.append(Gap("tail", high + 1, None, held[high][0] + 1, last))
        out[section] = next((held[n][1] for n in sorted(held) if held[n][1] != I.BARE), None), gaps
    return out


def _recovered(rows: list[tuple[int, int, str]], ch: int, found: dict, gaps: dict[int, tuple[str | None, list[Gap]]]) -> dict[tuple[int, int | None], int]:
    """``section, number`` -> stage of what the gaps' pages hold; ``rows``: page, block and text. Numbers beyond an int are none."""
    back: dict[tuple[int, int | None], int] = {}
    for page, _, text in rows:
        for _, m in _numbers(text):
            if whole(m[1]) != ch or (section := whole(m[2])) not in gaps:
                continue
            place, (label, own) = (section, whole(m[3])), gaps[section]
            stage = min((g.stage for g in own if g.first <= page <= g.last), default=None)
            if stage is None or place in found or stage >= back.get(place, 3):
                continue
            snippet = text[max(m.start() - 5, 0) : m.end() + 30]
            if _label(snippet) or label or sum(c.isalpha() for c in snippet) >= 2 or "\\" in snippet:
                back[place] = stage
    return back


def gaps(x: Lines, ids: np.ndarray) -> Found:
    trimmed = pc.utf8_trim(x.line, characters=" ")
    said = ~pc.equal(trimmed, "").to_numpy(zero_copy_only=False)
    tidy = pc.utf8_rtrim(trimmed, characters="：:．.，, ")
    heads, opens = (pc.match_substring_regex(tidy, p).to_numpy(zero_copy_only=False) for p in (I.SECTION_LABEL, I.SECTION_HEAD))
    force = of(x.through(heads | opens), heads)
    prev, following = x.before(said).tolist(), x.after(said).tolist()
    text = x.line.to_pylist()
    rows = np.flatnonzero(said & (x.has(I.NUMBER) | x.has(I.GARBLED)))
    cuts = np.searchsorted(x.doc[rows], np.arange(len(ids) + 1)).tolist()
    ends = np.bincount(x.doc, minlength=len(ids))
    page, rows = ((x.no - 1) // 10 + 1).tolist(), rows.tolist()
    out: dict[tuple[str, str], list[int]] = {}
    for d, ch in enumerate((ids % 9 + 1).tolist()):
        own = rows[cuts[d] : cuts[d + 1]]
        if not own:
            continue
        near = lambda at: text[at] if at >= 0 else None
        found = _items([(page[i], text[i], near(prev[i]), near(following[i]), "例" if force[i] else None) for i in own if not heads[i]], ch)
        by = _gaps(found, (int(ends[d]) - 1) // 10 + 1)
        back = _recovered([(page[i], i, text[i].strip(" ")) for i in own], ch, found, by)
        held: dict[int, list[tuple[int | None, int]]] = {}
        for (section, number), since in [*((k, -1) for k in found), *back.items()]:
            held.setdefault(section, []).append((number, since))
        for section, (_, some) in by.items():
            for g in some:
                if (verdict := g.verdict(held[section])) != "resolved":
                    out.setdefault((f"{g.gap}_gap", R.BLOCKS if verdict == "blocking" else R.WARNS), []).append(d)
    for (rule, severity), where in out.items():
        yield rule, severity, np.array(where, np.int64)


# --- all layers of some documents


def _flagged(x: Lines, flags: dict[str, np.ndarray], severity: Callable[[str], str]) -> Found:
    for rule, what in flags.items():
        yield rule, severity(rule), x.doc[what] if what.dtype == bool else what


def _of_layer(code: str, docs: Documents, lines: Callable[[str], Lines], off: Collection[str]) -> Found:
    if code == "0":
        return labels(lines("SCANS"))
    if code == "A":
        return keys(lines("STRUCTURE"), docs.ids)
    if code == "B":
        return gaps(lines("ITEMS"), docs.ids)
    if code == "C":
        return _flagged(lines("MATHS"), maths(lines("MATHS")), lambda _: R.BLOCKS)
    if code == "D":
        return sections(lines("SCANS"), lines("STRUCTURE"), docs.ids)
    flags = {rule: what for rule, what in structure(lines("STRUCTURE")).items() if R.RULES[rule].code not in off}
    return _flagged(lines("STRUCTURE"), flags, lambda rule: R.RULES[rule].severity)


def _slices(ids: np.ndarray, texts: pa.Array) -> Iterator[Documents]:
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < len(ids):
        hi = max(lo + 1, int(np.searchsorted(sizes, (sizes[lo - 1] if lo else 0) + SLICE, side="right")))
        yield Documents(ids[lo:hi], texts.slice(lo, hi - lo))
        lo = hi


def count(batch: pa.RecordBatch, layers: Collection[str], off: Collection[str] = ()) -> Iterator[pa.RecordBatch]:
    """``doc_id, layer, rule, severity, n`` of a batch of ``doc_id, text``; ``off``: codes of structure rules that are left out."""
    batch = batch.filter(pc.is_valid(batch.column(1)))
    for docs in _slices(batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).cast(_TEXT)):
        lines = lru_cache(docs.marked)
        for code in layers:
            for rule, severity, where in _of_layer(code, docs, lines, off):
                n = np.bincount(where, minlength=len(docs.ids))
                at = np.flatnonzero(n)
                if len(at):
                    said = [pa.array(np.full(len(at), s, object), pa.string()) for s in (code, rule, severity)]
                    yield pa.RecordBatch.from_arrays([pa.array(docs.ids[at], pa.int64()), *said, pa.array(n[at].astype(np.int64))], names=["doc_id", "layer", "rule", "severity", "n"])


def counted(docs: DataFrame, layers: Collection[str] = LAYERS, off: Collection[str] = ()) -> DataFrame:
    """``doc_id, layer, rule, severity, n`` of the documents ``doc_id, text`` in the layers of ``layers``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from count(batch, layers, off)

    return docs.selectExpr("cast(doc_id as long) as doc_id", "cast(text as string) as text").mapInArrow(run, COUNTS)
