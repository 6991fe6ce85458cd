"""Operator 7: secret scans by one combined automaton.

Method: the rules are compiled together (``automaton.compile_rules``) into
one minimal transition array, and one pass over the bytes runs all of them.
The bytes of a slice of texts are one stream, with a class that resets the
automaton between texts; the stream is cut into lanes of equal length that
advance together, one byte a step, in numpy.  A lane begins ``WARM`` bytes
early in the start state; where that does not reach the state in which its
predecessor ended (a match longer than ``WARM``), the lane is run again from
there, so the pass equals a sequential one.

The pass yields, for each rule, the bytes at which a match may end.  A run
of such bytes ends where the longest match ends; its start is found by the
rule's reversed automaton from the first byte of the run.  Matches of a rule
are leftmost and do not overlap.  ``assign`` is scanned with a value of any
length, since a match that is dropped for its short value still uses up its
text, as it does in a leftmost search.

A ``pem`` match, the header line, is extended over the key behind it: up to
the END line, or without one to the last base64 line.

Spans are code points, end exclusive, in order of start, then rule.
Everything happens in one Arrow function over the text column: no shuffle.

Defined results: NULL and empty texts have no spans; repeated rows are
scanned alike; a document of any length is scanned whole; extra columns
stay, a column named like an output is replaced; an empty table stays empty.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .automaton import Automaton, Rule, compile_rules
from .tables import flat, share, slices

# The base rules, in the order in which spans are listed.
RULES = [
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""",
         any_case=True),
    Rule("access", "AKIA[A-Z0-9]{12,}"),
    Rule("hex", "[0-9a-f]{32,}"),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
]
BASE = ["assign", "access", "hex"]
LEAST_VALUE = 8         # characters of an assigned value
LANE, WARM = 1024, 64
#: What follows the header of a key: fields such as DEK-Info, then base64 lines
#: (quoted, escaped or run together, too) and the END line; or, of a key that is
#: cut off, lines of base64 and a last, shorter one.
_BREAK = rb"""(?>[ \t"'>|#*,+]*+(?:\r?\n|\\r|\\n)++[ \t"'>|#*,]*+)"""
_FIELDS = rb"(?:" + _BREAK + rb"++[A-Z][A-Za-z0-9-]*: ?[^\r\n\\]*)*+"
KEY = re.compile(
    _FIELDS + rb"""(?:[A-Za-z0-9+/=\s"'>|#*,]|\\[rnt])*+-----END [A-Z ]*PRIVATE KEY-----"""
    rb"|" + _FIELDS + rb"(?:" + _BREAK + rb"++|[ \t]+(?=[A-Za-z0-9+/=]{40}))[A-Za-z0-9+/]{16,}+={0,2}"
    rb"(?:(?:" + _BREAK + rb"++|[ \t]+(?=[A-Za-z0-9+/=]{40}))[A-Za-z0-9+/]{16,}+={0,2})*+"
    rb"(?:" + _BREAK + rb"++(?:[A-Za-z0-9+/]{4})*+(?:[A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=|(?<=[A-Za-z0-9+/]{4}))"
    rb"(?![^\s\"'\\,])|" + _BREAK + rb"++[A-Za-z0-9+/]+={0,2}\Z)?")
SPANS = "array<struct<kind: string, start: int, end: int>>"


class Scanner:
    """The combined automaton and, for each rule, its own in both directions."""

    def __init__(self, rules: list[Rule] = RULES):
        self.rules = rules
        self.all = compile_rules(rules)
        self.forward = [compile_rules([r]) for r in rules]
        self.backward = [compile_rules([r], search=False, backwards=True) for r in rules]

    def ends(self, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the stream at which some rule accepts, in order, and
        the rules' bits there."""
        a = self.all
        width = a.step.shape[1]
        table = (a.step * width).astype(np.int32).reshape(-1)      # states as row offsets
        accepting = a.first_accepting * width
        reset = width - 1
        lanes = -(-len(classes) // LANE)
        padded = np.full(WARM + lanes * LANE, reset, np.uint8)
        padded[WARM:WARM + len(classes)] = classes
        view = np.lib.stride_tricks.as_strided(padded, (lanes, WARM + LANE), (LANE, 1))
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def run(which: np.ndarray, state: np.ndarray, columns: np.ndarray, skip: int
                ) -> tuple[np.ndarray, np.ndarray]:
            """Advances lanes through ``columns`` (a row a step); the states
            behind the first ``skip`` steps and at the end."""
            after = state
            for j in range(len(columns)):
                if j == skip:
                    after = state
                state = table[state + columns[j]]
                if j >= skip:
                    hit = np.flatnonzero(state >= accepting)
                    if len(hit):
                        found.append((which[hit], np.full(len(hit), j - skip), state[hit]))
            return after, state

        every = np.arange(lanes)
        begun, ended = run(every, np.zeros(lanes, np.int32), np.ascontiguousarray(view.T), WARM)
        wrong = every[1:][begun[1:] != ended[:-1]]
        while len(wrong):
            again = np.zeros(lanes, bool)
            again[wrong] = True
            found = [(w[~again[w]], j[~again[w]], s[~again[w]]) for w, j, s in found]
            begun[wrong] = ended[wrong - 1]
            _, new = run(wrong, begun[wrong], np.ascontiguousarray(view[wrong, WARM:].T), 0)
            ended[wrong] = new
            wrong = every[1:][begun[1:] != ended[:-1]]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.concatenate([w * LANE + j for w, j, _ in found])
        bits = a.accepts[np.concatenate([s for *_, s in found]) // width]
        order = np.argsort(at)
        return at[order], bits[order]

    def spans(self, texts: pa.Array) -> list[list[tuple[str, int, int]]]:
        """Spans of each text, in code points."""
        data, at = flat(texts)
        count = len(at) - 1
        starts = at[:-1] + np.arange(count)             # a reset stands behind each text
        stream = np.full(len(data) + count, self.all.step.shape[1] - 1, np.uint8)
        inside = np.ones(len(stream), bool)
        inside[at[1:] + np.arange(count)] = False
        stream[inside] = self.all.byte_class[data]
        where, bits = self.ends(stream)
        owner = np.searchsorted(starts, where, "right") - 1
        out: list[list[tuple[str, int, int]]] = [[] for _ in range(count)]
        for k in range(len(self.rules)):
            mine = np.flatnonzero(bits >> k & 1)
            if not len(mine):
                continue
            p, d = where[mine], owner[mine]
            new = np.ones(len(p), bool)
            new[1:] = (p[1:] != p[:-1] + 1) | (d[1:] != d[:-1])
            first, last = np.flatnonzero(new), np.append(np.flatnonzero(new)[1:], len(p)) - 1
            used: dict[int, int] = {}
            for doc, low, high in zip(d[first].tolist(), p[first].tolist(), p[last].tolist(), strict=True):
                raw = data[at[doc]:at[doc + 1]]
                low, end = low - starts[doc], high - starts[doc] + 1
                begin, free = self._begin(k, raw, low), used.get(doc, 0)
                if begin < free:        # its text is used up: does a match begin later?
                    low = self._first(k, raw, free, end)
                    begin = self._begin(k, raw[free:], low - free) + free if low is not None else -1
                if begin >= 0:
                    if self.rules[k].name == "pem" and (key := KEY.match(raw.tobytes(), end)):
                        end = key.end()
                    used[doc] = end
                    if self.rules[k].name != "assign" or end - low >= LEAST_VALUE:
                        out[doc].append((self.rules[k].name, int(begin), int(end)))
        order = {r.name: i for i, r in enumerate(self.rules)}
        for doc, found in enumerate(out):
            if found:
                point = np.concatenate([[0], np.cumsum((data[at[doc]:at[doc + 1]] & 0xC0) != 0x80)])
                out[doc] = sorted(((n, int(point[b]), int(point[e])) for n, b, e in found),
                                  key=lambda s: (s[1], order[s[0]]))
        return out

    def _begin(self, k: int, raw: np.ndarray, end: int) -> int:
        """Leftmost start of a match of rule k whose last byte is ``end``."""
        a, state, begin = self.backward[k], 0, -1
        step, kind, accepts = a.step, a.byte_class, a.accepts
        for i in range(end, -1, -1):
            state = step[state, kind[raw[i]]]
            if accepts[state]:
                begin = i
            elif self._dead(a, state):
                break
        return begin

    def _first(self, k: int, raw: np.ndarray, low: int, high: int) -> int | None:
        """First byte in [low, high) at which rule k accepts, begun from low on."""
        a, state = self.forward[k], 0
        for i in range(low, high):
            state = a.step[state, a.byte_class[raw[i]]]
            if a.accepts[state]:
                return i
        return None

    @staticmethod
    def _dead(a: Automaton, state: int) -> bool:
        return bool((a.step[state, :-1] == state).all())


def redacted(text: str, spans: list[tuple[str, int, int]], mark: str) -> str:
    """``text`` with every span, or union of overlapping spans, replaced by ``mark``."""
    out, at = [], 0
    for _, begin, end in spans:
        if begin >= at:
            out += [text[at:begin], mark]
        at = max(at, end)
    return "".join(out) + text[at:]


def scan(docs: DataFrame, text: str = "text", rules: list[Rule] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with ``secrets``, an array of (kind, start, end), and ``clean``,
    the text with ``mark`` in their place (NULL where there are none)."""
    scanner = share(docs.sparkSession, Scanner(rules))     # transition arrays, under 1 MB

    @F.arrow_udf(f"secrets {SPANS}, clean string")
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            rows = [found for part in slices(batch) for found in scanner.value.spans(part)]
            clean = [redacted(batch[i].as_py(), r, mark) if r else None for i, r in enumerate(rows)]
            yield pa.StructArray.from_arrays(
                [pa.array([[{"kind": n, "start": b, "end": e} for n, b, e in r] for r in rows], kind),
                 pa.array(clean, pa.string())], ["secrets", "clean"])

    made = ["secrets", "clean"]
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in made and c != "_scanned"]
    return (docs.withColumn("_scanned", find(F.col(text)))
            .select(*kept, *[F.col(f"_scanned.{c}").alias(c) for c in made]))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
