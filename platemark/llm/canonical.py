"""Mapping freely entered values to the entries of a reference list.

A multi-pattern automaton over the names and aliases of the list finds every
mention embedded in a value; the longest mention that overlaps no longer one
wins. Names are codes, their spellings and descriptions; aliases are codes
written without separators and with characters that are read for one another.
Values without a mention go on to the similarity of token sets, and codes with
a typing error to the only code one keystroke away.

A value's evidence against a block of the list (its mentions, most similar
token sets, neighbours) is kept apart from the decision, so a list of more
than BLOCK entries is taken in blocks and the evidence put together. The
values themselves are only shuffled in that case, once each; else a task maps
each distinct value of a batch once, and remembers values it has seen.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections import defaultdict
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platemark.operators.sizing import lookup

#: Entries whose compiled form is sent to the tasks at once; a longer list is taken in blocks.
BLOCK = 100_000
#: Distinct values a task remembers before it starts anew.
REMEMBER = 200_000
#: Least similarity of token sets.
SIMILAR = 0.8
#: Characters that are read for one another (fixed values).
LOOK_ALIKE = str.maketrans({"l": "1", "i": "1", "o": "0", "z": "2", "s": "5", "b": "8"})
#: Words of a description that carry no meaning of their own (fixed values).
FILLERS = frozenset(["for", "of", "the", "a", "an", "and", "to", "in", "on"])
SEPARATORS = re.compile(r"[\W_]+")
CODE = re.compile(r"([a-z]+)([0-9]+)(?:\.([0-9]+))?")
CODE_LIKE = re.compile(r"(?=.*[0-9])[a-z]{1,4}[0-9a-z]+(?:\.[0-9a-z]+)?")


def plain(value: str) -> str:
    """Words of a value: compatible forms, no case, no accents, one space between."""
    v = unicodedata.normalize("NFKD", unicodedata.normalize("NFKC", value).casefold())
    return SEPARATORS.sub(" ", "".join(c for c in v if not unicodedata.combining(c))).strip()


def one_step(a: str, b: str, swap: bool) -> bool:
    """Is ``b`` one insertion, deletion or change (or, with ``swap``, exchange of neighbours) from ``a``?"""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    if a[i:] == b[i + 1 :] or a[i + 1 :] == b[i:] or a[i + 1 :] == b[i + 1 :]:
        return True
    return swap and a[i + 2 :] == b[i + 2 :] and a[i : i + 2] == b[i : i + 2][::-1] and len(a) == len(b)


def _deletes(word: str) -> set[str]:
    return {word} | {word[:i] + word[i + 1 :] for i in range(len(word))}


#: What speaks for a code, in the order of the decision.
STEPS = ("mention", "alias", "similar", "keystroke")
#: Of a value: step, weight (of one step only the greatest counts), place of a mention, code.
Evidence = list[tuple[int, float, int, str]]


def decide(evidence: Evidence) -> tuple[str, str]:
    """(code, step) of a value's evidence; ('', 'none') if nothing speaks for one code.

    Mentions and aliases are weighed together, by their length: the longest
    wins, the leftmost of equally long ones. A name of two codes names
    neither. Of the other steps the greatest weight decides, if all of it is
    for one code.
    """
    names: dict[tuple[float, int], dict[int, set[str]]] = defaultdict(lambda: defaultdict(set))
    for step, weight, place, code in evidence:
        if step < 2:
            names[-weight, place][step].add(code)
    for _, steps in sorted(names.items()):
        for step, codes in sorted(steps.items()):
            if len(codes) == 1:
                return next(iter(codes)), STEPS[step]
    for step in (2, 3):
        top = max((w for s, w, _, _ in evidence if s == step), default=None)
        codes = {c for s, w, _, c in evidence if s == step and w == top}
        if len(codes) == 1:
            return next(iter(codes)), STEPS[step]
    return "", "none"


class CanonicalMatcher:
    """Finds what speaks for the codes of (a block of) a reference list."""

    def __init__(self, entries: list[tuple[str, str | None]]) -> None:
        import ahocorasick

        self.names: dict[str, set[str]] = defaultdict(set)
        self.aliases: dict[str, set[str]] = defaultdict(set)
        self.near: dict[str, set[tuple[str, str]]] = defaultdict(set)
        self.described: dict[frozenset[str], set[str]] = defaultdict(set)
        for code, description in entries:
            if not code or not plain(code):
                continue
            low = unicodedata.normalize("NFKC", code).casefold().strip()
            self.names[plain(code)].add(code)
            self.aliases[plain(code).replace(" ", "").translate(LOOK_ALIKE)].add(code)
            for d in _deletes(low):
                self.near[d].add((low, code))
            if m := CODE.fullmatch(low):
                parts = [p for p in m.groups() if p]
                self.names[" ".join(parts)].add(code)
                self.names[" ".join("".join(parts))].add(code)
            if description and (words := plain(description)):
                self.names[words].add(code)
                self.described[frozenset(words.split())].add(code)
        # All patterns are folded, so one automaton finds names and aliases; the value's own characters tell which it was.
        self.automaton = ahocorasick.Automaton()
        for form in {name.translate(LOOK_ALIKE) for name in self.names} | set(self.aliases):
            self.automaton.add_word(f" {form} ", len(form) + 2)
        self.automaton.make_automaton()
        self.by_token: dict[str, set[frozenset[str]]] = defaultdict(set)
        self.token_near: dict[str, set[str]] = defaultdict(set)
        for words in self.described:
            for t in words:
                self.by_token[t].add(words)
                for d in _deletes(t):
                    self.token_near[d].add(t)

    def __call__(self, value: str) -> str:
        return self.decided(value)[0]

    def decided(self, value: str) -> tuple[str, str]:
        """``decide`` of all evidence, without looking for what comes after a step that decides."""
        words = plain(value)
        if not words or not len(self.automaton):
            return "", "none"
        found = decide(self.mentions(words))
        if not found[0]:
            found = decide(self.similar(words))
        return found if found[0] else decide(self.keystroke(value))

    def evidence(self, value: str) -> Evidence:
        words = plain(value)
        if not words or not len(self.automaton):
            return []
        return self.mentions(words) + self.similar(words) + self.keystroke(value)

    def mentions(self, words: str) -> Evidence:
        """Names anywhere in a value, and the alias that is the whole value written without separators.

        A code with further digits beside it is another code; digits alone are
        nobody's alias.
        """
        text = f" {words} "
        found: Evidence = []
        for end, size in self.automaton.iter(text.translate(LOOK_ALIKE)):
            start = end - size + 1
            name = text[start + 1 : end]
            if name not in self.names:
                continue
            before = text[text.rfind(" ", 0, start) + 1 : start]
            after = text[end + 1 : max(text.find(" ", end + 1), end + 1)]
            if name.replace(" ", "").isalpha() or not (before.isdigit() or after.isdigit()):
                found += [(0, float(size), start, code) for code in self.names[name]]
        closed = words.replace(" ", "")
        if not closed.isdigit():
            folded = f" {closed} ".translate(LOOK_ALIKE)
            if any(size == len(folded) for _, size in self.automaton.iter(folded)):
                found += [(1, float(len(text)), 0, code) for code in self.aliases.get(folded[1:-1], ())]
        return found

    def keystroke(self, value: str) -> Evidence:
        """Codes one insertion, deletion or change away from a value that looks like a code."""
        low = unicodedata.normalize("NFKC", value).casefold().strip()
        bare = re.sub(r"[\W_]+(?=[^\W\d_]|$)|^[\W_]+|(?<=[^\W\d_])[\W_]+", "", low)
        bare = re.sub(r"[\W_]+", ".", bare)
        if not CODE_LIKE.fullmatch(bare):
            return []
        found = {(weight, code) for weight, form in ((2.0, bare), (1.0, low)) for d in _deletes(form) for other, code in self.near.get(d, ()) if one_step(form, other, swap=False)}
        return [(3, weight, 0, code) for weight, code in sorted(found)]

    def similar(self, words: str) -> Evidence:
        """Codes whose descriptions' token sets are the most similar, with or without filler words: tokens one keystroke apart count nine tenths."""
        own = set(words.split())
        tops = [self._best(own, frozenset()), self._best(own - FILLERS, FILLERS)]
        # With fillers first: the other comparison counts only where it is closer.
        return [(2, score + (0.5 - n / 2) * 1e-9, 0, code) for n, (score, codes) in enumerate(tops) for code in codes]

    def _best(self, own: set[str], left_out: frozenset[str]) -> tuple[float, list[str]]:
        alike = {}
        for t in own:
            if t in self.by_token:
                alike[t] = {t: 1.0}
            elif len(t) > 2 or t.isalpha():
                near = {o for d in _deletes(t) for o in self.token_near.get(d, ()) if one_step(t, o, swap=True)}
                alike[t] = dict.fromkeys(near, 0.9)
        best: dict[str, float] = defaultdict(float)
        common: dict[frozenset[str], int] = defaultdict(int)  # own tokens that a description has or nearly has
        for near in alike.values():
            for words_of in set().union(*(self.by_token[o] for o in near if o not in left_out)):
                common[words_of] += 1
        for words_of, most in common.items():
            if most * (1 + SIMILAR) < SIMILAR * (len(own) + len(words_of) - len(words_of & left_out)) - 1e-9:
                continue  # were all of them equal, it still wouldn't be similar
            gains, used = 0.0, set()
            for t, near in sorted(alike.items(), key=lambda x: -max(x[1].values(), default=0)):
                pair = max(((g, o) for o, g in near.items() if o in words_of and o not in used and o not in left_out), default=None)
                if pair:
                    gains += pair[0]
                    used.add(pair[1])
            score = gains / (len(own) + len(words_of - left_out) - len(used))
            for code in self.described[words_of]:
                best[code] = max(best[code], score)
        top = max(best.values(), default=0.0)
        return (top, sorted(c for c, s in best.items() if s == top)) if top >= SIMILAR else (0.0, [])


def map_to_canonical(df: DataFrame, row: str, value: str, canon: DataFrame, code: str, description: str, with_step: bool = False) -> DataFrame:
    """(``row``, legend_code) for every row whose ``value`` is neither null nor blank; '' if it means no entry.

    Equal values get equal codes. Repeated rows of either table change
    nothing; a name shared by two entries names neither. Very long values are
    scanned whole, in linear time. An empty list maps everything to '', an
    empty table gives an empty result. Other columns are not read. A list of
    any length is compared whole, in blocks of about BLOCK entries.
    ``with_step`` adds ``step``: what decided (one of STEPS, or none).
    """
    kind = dict(df.dtypes)[row]
    entered = df.select(F.col(row).alias("id"), F.col(value).alias("v")).filter(F.col("v").rlike(r"[^\s\p{Z}]"))
    entries = canon.select(code, description).distinct()
    blocks = entries.count() // BLOCK + 1
    if blocks == 1:
        out = entered.mapInPandas(_decided(_compiled(entries)), f"id {kind}, legend_code string, step string")
    else:
        values = entered.select("v").distinct()
        block = F.pmod(F.xxhash64(code, description), F.lit(blocks))
        parts = [values.mapInPandas(_evidence(_compiled(entries.filter(block == b))), "v string, evidence string") for b in range(blocks)]
        found = parts[0]
        for part in parts[1:]:
            found = found.unionByName(part)
        # One short text for each block: bounded by the number of blocks, whatever the number of rows of a value.
        whole = found.groupBy("v").agg(F.collect_list("evidence").alias("evidence")).mapInPandas(_put_together, "v string, legend_code string, step string")
        out = lookup(entered, whole, ["v"], "id").select("id", "legend_code", "step")
    out = out.withColumnRenamed("id", row)
    return out if with_step else out.drop("step")


def _compiled(entries: DataFrame) -> Broadcast:
    """The matcher of a block of entries, built once and sent to all tasks."""
    rows = sorted((tuple(r) for r in entries.collect()), key=lambda e: (e[0] or "", e[1] or ""))
    return entries.sparkSession.sparkContext.broadcast(CanonicalMatcher(rows))


def _decided(shared: Broadcast) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        match, known = shared.value, {}
        for batch in batches:
            for v in batch["v"].unique():
                if v not in known:
                    if len(known) >= REMEMBER:
                        known = {u: known[u] for u in set(batch["v"]) if u in known}
                    known[v] = match.decided(v)
            pairs = [known[v] for v in batch["v"]]
            yield pd.DataFrame({"id": batch["id"], "legend_code": [c for c, _ in pairs], "step": [s for _, s in pairs]})

    return run


def _evidence(shared: Broadcast) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"v": batch["v"], "evidence": [json.dumps(shared.value.evidence(v)) for v in batch["v"]]})

    return run


def _put_together(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        pairs = [decide([tuple(e) for text in texts for e in json.loads(text)]) for texts in batch["evidence"]]
        yield pd.DataFrame({"v": batch["v"], "legend_code": [c for c, _ in pairs], "step": [s for _, s in pairs]})
