"""File-name patterns as column predicates.

A pattern covers the whole name: ``*`` any run, ``?`` one character, ``[...]``
one of a set (``[!...]`` or ``[^...]`` one outside it), backslash quotes the next
character, everything else (braces, unmatched brackets) stands for itself. Named sets such as
``[:digit:]`` cover Unicode. The translation runs once per pattern, never per row.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cached_property, reduce
from itertools import groupby

from pyspark.sql import Column
from pyspark.sql import functions as F

_TOKEN = re.compile(
    r"\\(?P<quoted>.)"
    r"|\[(?P<outside>[!^]?+)(?P<members>\]?+(?:\\.|\[:[a-z]+:\]|[^\]\\])*+)\]"
    r"|(?P<wild>[*?])"
    r"|(?P<plain>.)",
    re.DOTALL,
)
_MEMBER = re.compile(r"\[:(?P<named>[a-z]+):\]|(?:\\)?(?P<low>.)(?:-(?:\\)?(?P<high>.))?", re.DOTALL)

# Set names a pattern may use, and their members as the JVM writes them.
NAMED_SETS = {
    "alnum": r"\p{IsAlphabetic}0-9",
    "alpha": r"\p{IsAlphabetic}",
    "blank": r"\t\p{Zs}",
    "cntrl": r"\p{Cc}",
    "digit": r"0-9",
    "graph": r"\p{L}\p{M}\p{N}\p{P}\p{S}",
    "lower": r"\p{IsLowercase}",
    "print": r"\p{L}\p{M}\p{N}\p{P}\p{S}\p{Zs}",
    "punct": r"\p{P}\p{S}",
    "space": r"\s\p{Z}",
    "upper": r"\p{IsUppercase}",
    "xdigit": r"0-9A-Fa-f",
}

# Stand for the two ends of a name in anchors.
START, END = "\x02", "\x03"
END_LENGTH = 8
INNER_LENGTH = 4
SMALL_SET = 32


@dataclass(frozen=True)
class Glob:
    """One translated pattern.

    ``runs`` holds, for every stretch between two stars, its pieces as
    ``(regex, character or None, members of a small set or None)``. ``None`` in place
    of the list: the pattern can match no name at all.
    """

    pattern: str
    runs: list[list[tuple[str, str | None, str | None]]] | None

    @cached_property
    def texts(self) -> list[str] | None:
        """The stretches between the stars, if all of them are plain text."""
        if self.runs is None or any(char is None for run in self.runs for _, char, _ in run):
            return None
        return ["".join(char for _, char, _ in run) for run in self.runs]

    @property
    def literal(self) -> str | None:
        texts = self.texts
        return texts[0] if texts is not None and len(texts) == 1 else None

    @property
    def regex(self) -> str:
        """For rlike. The inner stretches are atomic: the leftmost place is
        always good enough between stars, so no match ever backtracks into them."""
        if self.runs is None:
            return "(?!)"
        first, *rest = ["".join(regex for regex, _, _ in run) for run in self.runs]
        if not rest:
            return rf"(?s)\A{first}\z"
        inner = "".join(f"(?>.*?{run})" for run in rest[:-1] if run)
        return rf"(?s)\A{first}{inner}" + (rf".*{rest[-1]}\z" if rest[-1] else "")

    @cached_property
    def stretches(self) -> tuple[str, str, list[str]]:
        """The plain text every match begins with, ends with, and contains in between."""
        pieces: list[str | None] = [""]
        for run in self.runs or []:
            pieces += [char for _, char, _ in run] + [None]
        pieces[-1] = ""
        texts = ["".join(chars) for plain, chars in groupby(pieces, key=lambda char: char is not None) if plain]
        return texts[0], texts[-1], [text for text in texts[1:-1] if text]

    @property
    def anchors(self) -> list[str]:
        """Texts to find the pattern by: every matching name contains all of them.

        The start and the end of a name are marked. Of a pattern that is plain
        text it is the whole of it, otherwise a few characters each. None if there
        is no plain text, or if it could be taken for the marks.
        """
        if self.runs is None:
            return []
        if self.literal is not None:
            return [START + self.literal + END]
        start, end, inner = self.stretches
        if START in self.pattern or END in self.pattern:
            return []
        pieces = {text[at : at + INNER_LENGTH] for text in inner for at in range(max(1, len(text) - INNER_LENGTH + 1))}
        if start:
            pieces.add(START + start[:END_LENGTH])
        if end:
            pieces.add(end[-END_LENGTH:] + END)
        return sorted(pieces)


    @property
    def either(self) -> list[str]:
        """For a pattern without anchors that begins or ends with a small set: anchors
        of which every matching name contains one."""
        if not self.runs or self.anchors or START in self.pattern or END in self.pattern:
            return []
        first, last = self.runs[0][:1], self.runs[-1][-1:]
        if first and first[0][2]:
            return [START + char for char in first[0][2]]
        return [char + END for char in last[0][2]] if last and last[0][2] else []

    @property
    def least(self) -> int:
        """The characters a matching name has at least; exactly so many without a star."""
        return sum(map(len, self.runs or []))

    @property
    def has_star(self) -> bool:
        return len(self.runs or []) > 1

    @property
    def only_length(self) -> bool:
        """Whether nothing but a name's length matters."""
        return self.runs is not None and all(regex == "." for run in self.runs for regex, _, _ in run)


def _quote(char: str) -> str:
    # A backslash is an escape only before ASCII letters and digits.
    return char if char.isalnum() or ord(char) > 127 else "\\" + char


def _character_set(outside: bool, members: str) -> str:
    body = ""
    for member in _MEMBER.finditer(members):
        named, low, high = member.group("named", "low", "high")
        if named is not None:
            if named not in NAMED_SETS:
                return "(?!)"
            body += NAMED_SETS[named]
        elif high is None:
            body += _quote(low)
        elif low <= high:
            body += f"{_quote(low)}-{_quote(high)}"
    if not body:
        return "." if outside else "(?!)"
    return f"[{'^' if outside else ''}{body}]"


def _small_set(outside: bool, members: str) -> str | None:
    """The characters of a set that lists a few, in order."""
    found: set[str] = set()
    for member in _MEMBER.finditer(members):
        named, low, high = member.group("named", "low", "high")
        if outside or named is not None or ord(high or low) - ord(low) >= SMALL_SET:
            return None
        found.update(map(chr, range(ord(low), ord(high or low) + 1)))
    return "".join(sorted(found)) if 0 < len(found) <= SMALL_SET else None


def translate(pattern: str) -> Glob:
    runs: list[list[tuple[str, str | None, str | None]]] = [[]]
    for token in _TOKEN.finditer(pattern):
        quoted, wild, plain = token.group("quoted", "wild", "plain")
        if wild == "*":
            runs.append([])
        elif wild == "?":
            runs[-1].append((".", None, None))
        elif token.group("members") is not None:
            outside, members = bool(token.group("outside")), token.group("members")
            runs[-1].append((_character_set(outside, members), None, _small_set(outside, members)))
        elif plain == "\\":  # nothing left to quote
            return Glob(pattern, None)
        else:
            char = quoted if quoted is not None else plain
            runs[-1].append((_quote(char), char, None))
    if len(runs) > 2:
        runs = [runs[0], *filter(None, runs[1:-1]), runs[-1]]
    return Glob(pattern, None if runs == [[]] else runs)


def matches(name: Column, pattern: str) -> Column:
    """Whether a name matches; plain comparisons where the pattern allows it.

    Equality and startswith() reach the parquet scan as filters, rlike() does not.
    """
    glob = translate(pattern)
    if glob.runs is None:
        return F.lit(False)
    texts = glob.texts
    if texts is None or len(texts) > 3 or (len(texts) == 3 and (texts[0] or texts[2])):
        return _plain_parts(name, glob) & name.rlike(glob.regex)
    if len(texts) == 1:
        return name == texts[0]
    if len(texts) == 3:
        return name.contains(texts[1])
    start, end = texts
    if start and end:
        return name.startswith(start) & name.endswith(end) & (F.length(name) >= len(start) + len(end))
    if start:
        return name.startswith(start)
    return name.endswith(end) if end else name.isNotNull()


def _plain_parts(name: Column, glob: Glob) -> Column:
    """Plain comparisons that spare most names the regular expression."""
    start, end, inner = glob.stretches
    tests = [F.lit(True)]
    if start:
        tests.append(name.startswith(start))
    if end:
        tests.append(name.endswith(end))
    if inner:
        tests.append(name.contains(max(inner, key=len)))
    return reduce(Column.__and__, tests)


def is_pushable(pattern: str) -> bool:
    """Whether ``matches`` turns into a filter the parquet scan can use."""
    texts = translate(pattern).texts
    return texts is not None and (len(texts) == 1 or (len(texts) == 2 and texts[0] != ""))
