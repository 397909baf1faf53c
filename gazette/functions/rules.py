"""Keyword rules: a small text format, and its compilation to Columns.

Words are compiled on the driver, so no rule is evaluated in Python. A word that may occur inside an
allowed phrase becomes one regular expression: the word, not where a phrase covers it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Label of rows that only their category code brings in.
BY_CODE = "분류"


@dataclass(frozen=True)
class Rules:
    groups: dict[str, tuple[str, ...]] = field(default_factory=dict)
    exclude: tuple[str, ...] = ()
    #: Exclude words inside these phrases don't count.
    allow: tuple[str, ...] = ()
    #: Group words inside these phrases don't count.
    group_allow: tuple[str, ...] = ()
    #: (condition, exclude words that it releases)
    release: tuple[tuple[str, tuple[str, ...]], ...] = ()
    codes: tuple[str, ...] = ()

    def without(self, word: str) -> Rules:
        """The rules less one word, wherever it is a group or exclude word."""
        return Rules({g: tuple(w for w in ws if w != word) for g, ws in self.groups.items()}, tuple(w for w in self.exclude if w != word), self.allow, self.group_allow, self.release, self.codes)


# The headings of a rule file, and what marks its explanations.
_HEADINGS = (("group_allow", r"#\s*수집\s*예외"), ("groups", r"#\s*수집"), ("allow", r"#\s*제외\s*예외"), ("release", r"#\s*제외\s*해제"), ("exclude", r"#\s*제외"), ("codes", r"#\s*조달분류"))
#: Lines that are explanations, not entries.
_PROSE = re.compile(r"[.。]$|합니다|됩니다|적용|형식:")


def parse_rules(source: str) -> Rules:
    """Sections under '# ' headings, groups under '## ', an entry a line; prose is skipped."""
    groups: dict[str, list[str]] = {}
    lists: dict[str, list] = {k: [] for k in ("exclude", "allow", "group_allow", "release", "codes")}
    section = group = None
    for line in filter(None, map(str.strip, source.split("\n"))):
        heading = next((k for k, rx in _HEADINGS if re.match(rx, line)), None)
        if heading:
            section, group = heading, (None if heading == "groups" else group)
        elif re.match(r"##\s+", line):
            if section == "groups":
                group = line.lstrip("#").strip()
                groups[group] = []
        elif line.startswith("#") or _PROSE.search(line):
            continue
        elif section == "groups":
            if group is not None:
                groups[group].append(line)
        elif section == "release":
            when, _, words = line.replace("->", "→").partition("→")
            if when.strip() and words.split("→")[0].split():
                lists["release"].append((when.strip(), tuple(words.split("→")[0].split())))
        elif section == "codes":
            code = line.split()[0]
            if re.fullmatch(r"\d{4,}", code):
                lists["codes"].append(code)
        elif section:
            lists[section].append(line)
    return Rules({g: tuple(w) for g, w in groups.items()}, **{k: tuple(v) for k, v in lists.items()})


def lint(rules: Rules) -> list[tuple[str, str, str]]:
    """(kind, word, other): doubled words, words that contain another, entries that look like prose."""
    out = [("contains", w, o) for w in rules.exclude for o in rules.exclude if o != w and o in w]
    out += [("doubled", w, w) for w in dict.fromkeys(rules.exclude) if rules.exclude.count(w) > 1]
    out += [("prose", w, kind) for kind in ("allow", "group_allow") for w in getattr(rules, kind) if len(w.split()) > 4]
    return out


def _quote(s: str) -> str:
    return re.sub(r"([^\w\s])", r"\\\1", s) if s else ""


def occurs(text: Column, word: str, allow: tuple[str, ...] = ()) -> Column:
    """Whether a text has the word anywhere that no allowed phrase covers whole."""
    covers = []
    for phrase in allow:
        k = phrase.find(word)
        while k >= 0:
            before = f"(?<={_quote(phrase[:k])})" if k else ""
            covers.append(f"(?!{before}{_quote(phrase[k:])})")
            k = phrase.find(word, k + 1)
    return text.rlike("".join(covers) + _quote(word)) if covers else text.contains(word)


def _collect(options: list[Column]) -> Column:
    return F.array_compact(F.array(*options)) if options else F.array().cast("array<string>")


def match_groups(text: Column, rules: Rules, code: Column | None = None) -> Column:
    """The names of the groups with a word in the text, in rule order; by code if there are none."""
    any_of = lambda words: F.array_contains(F.array(*[occurs(text, w, rules.group_allow) for w in words]), True) if words else F.lit(False)
    found = _collect([F.when(any_of(words), F.lit(name)) for name, words in rules.groups.items()])
    if code is None or not rules.codes:
        return found
    return F.when((F.size(found) == 0) & code.isin(*rules.codes), F.array(F.lit(BY_CODE))).otherwise(found)


def excluded_by(title: Column, rules: Rules) -> Column:
    """The exclude words that count against a title, in rule order."""
    title = F.coalesce(title, F.lit(""))
    out = []
    for w in rules.exclude:
        hit = occurs(title, w, rules.allow)
        for when, words in rules.release:
            if w in words:
                hit = hit & ~title.contains(when)
        out.append(F.when(hit, F.lit(w)))
    return _collect(out)


def matched_word(title: Column, text: Column, words: tuple[str, ...]) -> Column:
    """The word that brought a row in: the first in the title, else the first in the rest, marked."""
    return F.coalesce(*[F.when(title.contains(w), F.lit(w)) for w in words], *[F.when(text.contains(w), F.lit(f"{w}·분류명")) for w in words], F.lit("?"))


def where_used(word: str, rules: Rules) -> list[str]:
    """The lists of the rules that hold a word."""
    out = [g for g, ws in rules.groups.items() if word in ws]
    return out + [k for k in ("exclude", "allow", "group_allow") if word in getattr(rules, k)] + [f"release:{when}" for when, ws in rules.release if word in ws]


def contains_any(title: Column, words: tuple[str, ...]) -> Column:
    """Plain containment; a null title contains nothing."""
    return F.coalesce(title.rlike("|".join(map(_quote, words))) if words else F.lit(False), F.lit(False))
