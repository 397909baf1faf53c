"""Rule files of any size: all words and phrases in one automaton, a pass over each text.

``rules`` compiles an expression a word, which is native but grows with the rule file; hundreds of them are more than generated code holds.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette.functions.rules import BY_CODE, Rules

MATCH = "groups array<string>, excluded array<string>"


class Matcher:
    """The words of a rule set that count in a text: those somewhere outside of the phrases that allow them."""

    def __init__(self, rules: Rules):
        import ahocorasick

        self.rules = rules
        words = {w for ws in rules.groups.values() for w in ws}
        entries = [*words, *rules.exclude, *rules.allow, *rules.group_allow, *(when for when, _ in rules.release)]
        if "" in entries:
            raise ValueError("a rule has no empty word")
        self.automaton = ahocorasick.Automaton()
        for entry in entries:
            self.automaton.add_word(entry, entry)
        if entries:
            self.automaton.make_automaton()
        self.groups, self.exclude = words, set(rules.exclude)
        self.allow, self.group_allow = set(rules.allow), set(rules.group_allow)

    def hits(self, text: str) -> dict[str, list[tuple[int, int]]]:
        """Where each entry is, overlapping ones too."""
        out: dict[str, list[tuple[int, int]]] = {}
        if len(self.automaton):
            for last, entry in self.automaton.iter(text):
                out.setdefault(entry, []).append((last + 1 - len(entry), last + 1))
        return out

    @staticmethod
    def _outside(hits: dict, words: set[str], phrases: set[str]) -> set[str]:
        """The words with a place that no phrase covers whole."""
        covers = sorted(spot for p in phrases if p in hits for spot in hits[p])
        if not covers:
            return words & hits.keys()
        starts, reach, furthest = [s for s, _ in covers], [], 0
        for _, end in covers:
            furthest = max(furthest, end)
            reach.append(furthest)

        def covered(start: int, end: int) -> bool:
            i = bisect_right(starts, start)
            return i > 0 and reach[i - 1] >= end

        return {w for w in words & hits.keys() if not all(covered(*spot) for spot in hits[w])}

    def groups_of(self, text: str | None) -> list[str] | None:
        if text is None:
            return []
        found = self._outside(self.hits(text), self.groups, self.group_allow)
        return [name for name, words in self.rules.groups.items() if not found.isdisjoint(words)]

    def excluded_of(self, title: str | None) -> list[str]:
        if title is None:
            return []
        hits = self.hits(title)
        found = self._outside(hits, self.exclude, self.allow)
        for when, words in self.rules.release:
            if when in hits:
                found -= set(words)
        return [w for w in self.rules.exclude if w in found]


def matches(title: Column, text: Column, rules: Rules) -> Column:
    """struct<groups, excluded>: as ``rules.match_groups`` of the text and ``rules.excluded_by`` of the title, in rule order; null texts have neither."""

    @F.pandas_udf(MATCH)
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        own = Matcher(rules)  # once a task
        for titles, texts in batches:
            yield pd.DataFrame({"groups": [own.groups_of(t) for t in texts], "excluded": [own.excluded_of(t) for t in titles]})

    return run(title.cast("string"), text.cast("string"))


def classify(df: DataFrame, title: Column, text: Column, rules: Rules, code: Column | None = None) -> DataFrame:
    """As ``discovery.classify``, for rule files that are too large for an expression a word."""
    out = df.withColumn("_match", matches(title, text, rules)).withColumns({"groups": F.col("_match.groups"), "excluded": F.col("_match.excluded")}).drop("_match")
    if code is not None and rules.codes:
        out = out.withColumn("groups", F.when((F.size("groups") == 0) & code.isin(*rules.codes), F.array(F.lit(BY_CODE))).otherwise(F.col("groups")))
    bad, good = F.size("excluded") > 0, F.size("groups") > 0
    return out.withColumn("label", F.when(bad & good, "killed").when(bad, "excluded").when(good, "kept").otherwise("unmatched"))
