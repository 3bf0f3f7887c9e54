"""Secret scans: base expressions, and formats learned by grammar inference.

The base finds credentials by their surroundings or shape (``assign``,
``access``, ``hex``); what it finds is labelled.  From the labelled values an
automaton per kind is inferred, and every other run of credential characters
is scored by how likely the automata are to write it.

1. One pass over the texts finds the base spans and the candidates: maximal
   runs of ``[A-Za-z0-9+/_=-]`` of 16 characters or more that hold a digit.
2. A bounded sample of distinct labelled values (SAMPLE_VALUES a kind, those
   with the smallest hashes) and as many candidates that touch no base span
   go to the driver.  Four fifths of each sample become a prefix tree with
   counts, in which states are merged while their futures agree: two states
   are compatible when no frequency of a next character or of an end differs
   by more than the Hoeffding bound allows, for them and all that follow.
   Among compatible states the one that writes the new state's characters
   most likely is taken; a state compatible with none is kept.  What remains
   is a probabilistic automaton with loops for the free parts of a format and
   chains for the fixed ones.
3. The last fifth sets the least likelihood a character of each kind: that
   which nine in ten held-out values reach.  A candidate is reported
   (kind ``format``) when some automaton reaches its mark and writes it at
   least MARGIN bits a character more likely than the automaton of the other
   candidates does.  That one is learned twice: the sample of candidates
   holds credentials too, so those that an automaton of a kind explains as
   well, up to SLACK bits in all, are left out the second time.  Base spans
   all stay, with their score.

Defined cases: a null text counts as empty; whole texts are searched; equal
rows give equal results; without labelled values nothing is learned and only
base spans are reported; values of more than MAX_VALUE characters are scored
but not learned from; an empty table gives no rows; columns other than the
two named are ignored.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokloom.llm.common import documents, staged

#: The base expressions as given, and their least lengths.
PLAIN = {
    "assign": r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}
LEAST = {"assign": 6, "access": 20, "hex": 24}
BASE = tuple(PLAIN)
#: The kind of learned spans.
LEARNED = "format"

SAMPLE_VALUES, MAX_VALUE = 1500, 256
ALPHA, MARGIN, SLACK, QUANTILE = 0.05, 0.5, 6, 0.1
#: Symbols a credential may use, for the share that unseen ones get.
SYMBOLS = 68

# bytes: ASCII case only; a run too short for its kind is no match, and
# maximal runs of 24 or more are the runs of any length that pass
_ASSIGN = re.compile(PLAIN["assign"].encode(), re.IGNORECASE)
_ACCESS = re.compile(PLAIN["access"].encode())
_HEX = re.compile(rb"[0-9a-f]{24,}")
_RUN = re.compile(rb"[A-Za-z0-9+/_=-]{16,}")
_DIGIT = re.compile(rb"[0-9]")


def base_spans(text: bytes) -> list[tuple]:
    """(start, kind, end, value start) of the base matches, in order."""
    found = [(m.start(), 0, m.end(), m.start(2)) for m in _ASSIGN.finditer(text)
             if m.end(2) - m.start(2) >= LEAST["assign"]]
    if b"AKIA" in text:
        found += [(m.start(), 1, m.end(), m.start()) for m in _ACCESS.finditer(text)
                  if m.end() - m.start() >= LEAST["access"]]
    found += [(m.start(), 2, m.end(), m.start()) for m in _HEX.finditer(text)]
    return sorted(found)


def free_runs(text: bytes, base: list[tuple]) -> list[tuple]:
    """(start, end) of candidates that touch no base span."""
    out, at, reach = [], 0, 0
    for m in _RUN.finditer(text):
        start, end = m.span()
        while at < len(base) and base[at][0] < end:
            reach = max(reach, base[at][2])
            at += 1
        if reach <= start and _DIGIT.search(text, start, end):
            out.append((start, end))
    return out


FOUND = ("doc_id long, base array<struct<kind:string,start:int,end:int,text:string,value:string>>, "
         "runs array<struct<start:int,end:int,text:string>>")
_BASE_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                                 ("text", pa.string()), ("value", pa.string())]))
_RUNS_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("text", pa.string())]))


def _scan(batches):
    for batch in batches:
        every, runs = [], []
        for text in batch.column("text").cast(pa.binary()):
            text = text.as_py() or b""
            base = base_spans(text)
            free = free_runs(text, base)
            if (base or free) and not text.isascii():
                place = np.append(0, np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))
            else:
                place = None

            def at(i):
                return i if place is None else int(place[i])

            every.append([{"kind": BASE[k], "start": at(s), "end": at(e), "text": text[s:e].decode(),
                           "value": text[v:e].decode()} for s, k, e, v in base])
            runs.append([{"start": at(s), "end": at(e), "text": text[s:e].decode()} for s, e in free])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(every, _BASE_TYPE), pa.array(runs, _RUNS_TYPE)],
            names=["doc_id", "base", "runs"])


class Automaton:
    """A probabilistic automaton inferred from strings."""

    def __init__(self, values: list[str], alpha: float = ALPHA):
        self.to, self.freq, self.n, self.end = [{}], [{}], [0], [0]
        for value in values:
            s = 0
            self.n[0] += 1
            for c in value:
                if c not in self.to[s]:
                    self.to[s][c] = len(self.to)
                    self.to.append({}), self.freq.append({}), self.n.append(0), self.end.append(0)
                self.freq[s][c] = self.freq[s].get(c, 0) + 1
                s = self.to[s][c]
                self.n[s] += 1
            self.end[s] += 1
        self.spread = math.sqrt(0.5 * math.log(2 / alpha))
        self._infer()
        self._logs = [self._log_row(s) for s in range(len(self.to))]

    def _infer(self):
        kept, waiting = [0], [(0, c) for c in sorted(self.to[0])]
        while waiting:
            # the most frequent open state first: it is known best
            i = max(range(len(waiting)), key=lambda i: (self.n[self.to[waiting[i][0]][waiting[i][1]]], -i))
            parent, c = waiting.pop(i)
            state = self.to[parent][c]
            if state in kept:
                continue
            fits = [(self._fit(k, state), -j, k) for j, k in enumerate(kept) if self._compatible(k, state)]
            if fits:
                k = max(fits)[2]
                self.to[parent][c] = k
                self._fold(k, state)
            else:
                kept.append(state)
            done = set(kept)
            waiting = [(s, x) for s in kept for x in sorted(self.to[s]) if self.to[s][x] not in done]
        number = {s: i for i, s in enumerate(kept)}
        self.to = [{c: number[t] for c, t in self.to[s].items()} for s in kept]
        self.freq, self.n, self.end = ([x[s] for s in kept] for x in (self.freq, self.n, self.end))

    def _differ(self, f1, n1, f2, n2) -> bool:
        return abs(f1 / n1 - f2 / n2) > self.spread * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))

    def _compatible(self, a: int, b: int) -> bool:
        stack = [(a, b)]
        while stack:
            x, y = stack.pop()
            n, m = self.n[x], self.n[y]
            if self.spread * (1 / math.sqrt(n) + 1 / math.sqrt(m)) >= 1:
                continue  # too few to differ, here and in all that follow
            if self._differ(self.end[x], n, self.end[y], m):
                return False
            for c in self.freq[x].keys() | self.freq[y].keys():
                if self._differ(self.freq[x].get(c, 0), n, self.freq[y].get(c, 0), m):
                    return False
                if c in self.to[x] and c in self.to[y] and self.to[x][c] != self.to[y][c]:
                    stack.append((self.to[x][c], self.to[y][c]))
        return True

    def _fit(self, a: int, b: int) -> float:
        """Bits with which state a writes what state b wrote next."""
        total = self.n[a] + 1
        bits = self.end[b] * math.log2((self.end[a] + 1 / SYMBOLS) / total)
        return bits + sum(f * math.log2((self.freq[a].get(c, 0) + 1 / SYMBOLS) / total)
                          for c, f in self.freq[b].items())

    def _fold(self, a: int, b: int):
        stack = [(a, b)]
        while stack:
            x, y = stack.pop()
            self.n[x] += self.n[y]
            self.end[x] += self.end[y]
            for c, f in self.freq[y].items():
                self.freq[x][c] = self.freq[x].get(c, 0) + f
                if c in self.to[x]:
                    stack.append((self.to[x][c], self.to[y][c]))
                else:
                    self.to[x][c] = self.to[y][c]

    def _log_row(self, s: int):
        total = self.n[s] + 1
        row = {c: math.log2((f + 1 / SYMBOLS) / total) for c, f in self.freq[s].items()}
        return row, math.log2(1 / SYMBOLS / total), math.log2((self.end[s] + 1 / SYMBOLS) / total)

    def bits(self, value: str) -> float:
        """log2 of the probability of a string, a character (its end is one)."""
        s, total = 0, 0.0
        for c in value:
            row, other, _ = self._logs[s]
            total += row.get(c, other)
            s = self.to[s].get(c, 0)  # an unseen character starts afresh
        return (total + self._logs[s][2]) / (len(value) + 1)


class Formats:
    """Automata of the labelled kinds, their marks, and that of the rest."""

    def __init__(self, labelled: dict[str, list[str]], rest: list[str]):
        self.kinds = {}
        for kind, values in sorted(labelled.items()):
            held, learn = values[::5], [v for i, v in enumerate(values) if i % 5]
            if learn:
                a = Automaton(learn)
                marks = sorted(a.bits(v) for v in held)
                self.kinds[kind] = (a, marks[int(len(marks) * QUANTILE)])
        every = Automaton(rest)
        self.rest = Automaton([v for v in rest if not any(
            (a.bits(v) - every.bits(v)) * (len(v) + 1) >= -SLACK for a, _ in self.kinds.values())])

    def score(self, value: str) -> tuple[float, bool]:
        """(bits a character above the rest, whether it is a credential)."""
        rest = self.rest.bits(value)
        own = [(a.bits(value), mark) for a, mark in self.kinds.values()]
        if not own:
            return 0.0, False
        return max(b for b, _ in own) - rest, any(b >= mark and b - rest >= MARGIN for b, mark in own)


def _sample(values: DataFrame) -> list[str]:
    """At most SAMPLE_VALUES distinct values, those of the smallest hashes."""
    return [r.value for r in values.where(F.length("value") <= MAX_VALUE).select("value").distinct()
            .orderBy(F.xxhash64("value"), "value").limit(SAMPLE_VALUES).collect()]


def learn_formats(found: DataFrame) -> Formats:
    base = found.select(F.explode("base").alias("b")).select("b.kind", "b.value")
    labelled = {k: _sample(base.where(F.col("kind") == k)) for k in BASE}
    rest = _sample(found.select(F.explode("runs.text").alias("value")))
    return Formats({k: v for k, v in labelled.items() if v}, rest)


SPANS = "doc_id long, spans array<struct<kind:string,start:int,end:int,score:double,text:string>>"
_SPANS_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                                  ("score", pa.float64()), ("text", pa.string())]))


def _score(batches, formats: Formats):
    kinds = {k: i for i, k in enumerate((*BASE, LEARNED))}
    for batch in batches:
        out = []
        for base, runs in zip(batch.column("base"), batch.column("runs")):
            spans = [(b["start"], kinds[b["kind"]], b["kind"], b["end"], formats.score(b["value"])[0], b["text"])
                     for b in base.as_py()]
            for r in runs.as_py():
                score, real = formats.score(r["text"])
                if real:
                    spans.append((r["start"], kinds[LEARNED], LEARNED, r["end"], score, r["text"]))
            out.append([{"kind": k, "start": s, "end": e, "score": p, "text": t}
                        for s, _, k, e, p, t in sorted(spans)])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, _SPANS_TYPE)],
                                         names=["doc_id", "spans"])


def find_secrets(df: DataFrame) -> DataFrame:
    """doc_id, spans: array of (kind, start, end, score, text) by start, then
    kind; positions in code points, end exclusive."""
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = staged(rows.mapInArrow(_scan, FOUND), "secrets")
    formats = df.sparkSession.sparkContext.broadcast(learn_formats(found))
    return found.mapInArrow(lambda b: _score(b, formats.value), SPANS)


def op13_secrets(spark, sf_dir: str) -> DataFrame:
    found = find_secrets(documents(spark, sf_dir, "doc_id", "text"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in BASE],
        F.sha2(joined(F.filter("spans", lambda s: s["kind"].isin(*BASE))), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"))
