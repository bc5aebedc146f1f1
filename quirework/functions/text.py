"""Column functions on text."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P

#: Characters that Python's ``str.strip`` removes.
SPACE = r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
#: The same, one by one.
SPACES = "".join(map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


def strip(text: Column) -> Column:
    """A text without the space around it; unlike a pattern, this looks at its ends alone and not at every character.

    Spark's trimming on the right goes over the whole text, so a text that ends in a visible ASCII character is spared it.
    """
    ends = F.substring(text.cast("binary"), -1, 1)
    return F.when((ends > F.lit(b"\x20")) & (ends < F.lit(b"\x7f")), F.ltrim(text, F.lit(SPACES))).otherwise(F.btrim(text, F.lit(SPACES)))


#: What a text must hold for a pattern that is not anchored, and begin with for one whose alternatives begin differently.
_HELD = {P.MOJIBAKE: ("Ã", "â€", "ï»¿", "\uFFFD"), P.NAKED_COMMAND: ("\\",), r"\\[\[\]]": ("\\",), "|".join(P.BAD_MACROS): ("\\",)}
_LED = {P.QUOTE_END: ("---", "##", "**", "$$"), P.TOP_ITEM: ("(", "（")}
_LEAD = re.compile(r"\^(\\s\*)?((?:\\[^A-Za-z0-9]|[^\\()\[\]{}.*+?|^$])+)(.?.?)", re.S)


def lead(pattern: str) -> tuple[bool, str]:
    """Whether space may come first, and the text that every match of an anchored pattern begins with then; empty if unknown."""
    found, depth = _LEAD.match(pattern), 0
    for x in re.sub(r"\\.|\[(?:\\.|[^\]])*\]", "", pattern):
        depth += (x == "(") - (x == ")")
        if x == "|" and depth == 0:
            return False, ""
    if not found:
        return False, ""
    said = re.findall(r"\\?(.)", found[2], re.S)
    if found[3][:1] in ("*", "?") or (found[3][:1] == "{" and not "1" <= found[3][1:] <= "9"):
        said = said[:-1]
    return bool(found[1]), "".join(said)


def matched(text: Column, pattern: str) -> Column:
    """``rlike`` that looks for the pattern only where the texts stand without which it cannot match."""
    some = lambda test, texts: reduce(Column.__or__, [test(text, F.lit(x)) for x in texts])
    if pattern in _HELD:
        return some(F.contains, _HELD[pattern]) & text.rlike(pattern)
    if pattern in _LED:
        return some(F.startswith, _LED[pattern]) & text.rlike(pattern)
    spaced, begins = lead(pattern)
    if not begins:
        return text.rlike(pattern)
    return F.startswith(F.ltrim(text, F.lit(SPACES)) if spaced else text, F.lit(begins)) & text.rlike(pattern)


def quoted(text: Column) -> Column:
    """Whether a line is a quote once its indentation is gone."""
    return F.startswith(strip(text), F.lit(">"))


def natural_key(key: Column) -> Column:
    """The numbers in a key, as an array that sorts them by value."""
    return F.transform(F.regexp_extract_all(key, F.lit(r"\d+"), F.lit(0)), lambda x: x.cast("long"))


def normal_key(key: Column) -> Column:
    """``N.S.N`` -> ``N.S-N``; other keys stay."""
    return F.regexp_replace(key, r"^([^.]*)\.([^.]*)\.([^.]*)$", "$1.$2-$3")


def canonical_label(label: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in P.CANONICAL.items() for x in pair])
    return F.coalesce(F.try_element_at(table, label), label)


def first_number(key: Column) -> Column:
    """The first whole number in a key; -1 if there is none."""
    return F.coalesce(F.nullif(F.regexp_extract(key, r"\d+", 0), F.lit("")).try_cast("long"), F.lit(-1).cast("long"))


def _times(text: Column, letter: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(letter), F.lit("")))


def roman_to_int(text: Column) -> Column:
    """Value of a lower-case roman numeral; 0 if it is none. Each subtractive pair occurs once at most."""
    value = sum((_times(text, c) * v for c, v in (("i", 1), ("v", 5), ("x", 10), ("l", 50), ("c", 100), ("d", 500), ("m", 1000))), F.lit(0))
    for pair, v in (("i[vx]", 2), ("x[lc]", 20), ("c[dm]", 200)):
        value = value - F.when(text.rlike(pair), v).otherwise(0)
    return F.when(text.rlike(P.ROMAN) & (text != ""), value).otherwise(0)


def int_to_roman(number: Column) -> Column:
    """Lower-case roman numeral of 1 to 3999; null otherwise."""
    digits = [["", *(x.translate(str.maketrans("ivx", sub)) for x in ("i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix"))] for sub in ("ivx", "xlc", "cdm")]
    digits.append(["", "m", "mm", "mmm"])
    parts = [F.get(F.array(*[F.lit(x) for x in digits[k]]), (F.floor(number / 10**k) % 10).cast("int")) for k in (3, 2, 1, 0)]
    return F.when((number >= 1) & (number <= 3999), F.concat(*parts))


def ratio(text: Column) -> Column:
    """``a/b`` -> struct of two ints, null where it is none."""
    return F.struct(F.split_part(text, F.lit("/"), F.lit(1)).try_cast("int").alias("passed"), F.split_part(text, F.lit("/"), F.lit(2)).try_cast("int").alias("total"))


def normal_figure(label: Column) -> Column:
    """A figure's label without any blank."""
    return F.replace(strip(label), F.lit(" "), F.lit(""))


def short_caption(caption: Column) -> Column:
    """A caption without its number, cut at what it says about the picture; 40 characters at most."""
    text = strip(F.regexp_replace(F.coalesce(caption, F.lit("")), r"^图\s*\d+\s*", ""))
    return F.substring(F.regexp_replace(F.regexp_replace(text, "图中.*$", "示意图"), "中的.*$", "示意图"), 1, 40)


def caption_reference(caption: Column) -> Column:
    """The item that a caption names: struct of kind, number and whether its proof is meant; null for exercises or none.

    English kinds come first and get their Chinese name.
    """
    english = f"({'|'.join(P.CAPTION_KINDS_EN)})\\s*{P.CAPTION_NUMBER}"
    chinese = f"({P.CAPTION_KINDS})\\s*{P.CAPTION_NUMBER}"
    tight = lambda pattern: F.regexp_replace(F.regexp_extract(caption, pattern, 2), r"\s+", "")
    # A search for a word is much cheaper than one for a pattern.
    named = lambda kinds, pattern: reduce(Column.__or__, [F.contains(caption, F.lit(k)) for k in kinds]) & caption.rlike(pattern)
    one = lambda pattern, kind, proof: F.struct(kind.alias("kind"), tight(pattern).alias("number"), proof.alias("of_proof"))
    return (
        F.when(F.contains(caption, F.lit("习题")), None)
        .when(named(P.CAPTION_KINDS_EN, english), one(english, canonical_label(F.regexp_extract(caption, english, 1)), F.contains(F.lower(caption), F.lit("proof"))))
        .when(named(P.CAPTION_KINDS.split("|"), chinese), one(chinese, F.regexp_extract(caption, chinese, 1), F.contains(caption, F.lit("证明"))))
    )


def centre(points: Column) -> Column:
    """Mean of the corners of a polygon given as a flat list ``x0, y0, x1, y1, ...``."""
    mean = lambda odd: F.aggregate(F.filter(points, lambda _, i: i % 2 == odd), F.lit(-0.0), lambda acc, v: acc + v.cast("double")) / (F.size(points) / 2)
    return F.when(F.size(points) >= 2, F.struct(mean(0).alias("x"), mean(1).alias("y")))


def beyond(signs: str) -> str:
    """Signs beyond ASCII as part of a character class; other characters are turned away by one comparison, not by one a sign."""
    return f"[[^\\x00-\\x7F]&&[{signs}]]"


def raised_lowered(text: Column) -> Column:
    """Runs of raised or lowered signs as ``^`` or ``_`` and plain letters, in braces if there are several."""
    plain = text
    for signs, letters, mark in ((P.RAISED, P.RAISED_AS, "^"), (P.LOWERED, P.LOWERED_AS, "_")):
        text = F.regexp_replace(F.regexp_replace(text, f"({beyond(signs)}+)", f"{mark}{{$1}}"), f"\\{mark}\\{{({beyond(signs)})\\}}", f"{mark}$1")
        text = F.translate(text, signs, letters)
    return F.when(plain.rlike(f"[{beyond(P.RAISED + P.LOWERED)}]"), text).otherwise(plain)


def file_name(title: Column, most: int = 60) -> Column:
    """A title as part of a file name: no section sign, formulas, blanks or characters that file systems refuse."""
    for pattern in ("§", r"\$[^$]*\$", r'[<>:"/\\|?*$]', r"\s+"):
        title = F.regexp_replace(title, pattern, "")
    return F.substring(title, 1, most)


def shown_in(line: Column, file: Column) -> Column:
    """Whether a line embeds a figure file."""
    return F.contains(line, F.concat(F.lit('src="_extract/figure/'), file, F.lit('"')))
