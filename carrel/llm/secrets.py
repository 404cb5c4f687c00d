"""Secret scans: all rules as one deterministic automaton over the bytes of a text."""

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import functions as F

from carrel.llm.automaton import Scanner
from carrel.llm.common import whole_text


@dataclass(frozen=True)
class Rule:
    """``least`` is the smallest length of ``group`` (0: the whole match); shorter matches are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: The first three are agreed; matches of fewer characters are dropped.
RULES = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
    ),
    Rule("access", "AKIA[A-Z0-9]+", least=20),
    # Runs are maximal either way, and shorter ones need no mark.
    Rule("hex", "[0-9a-f]{24,}", least=24),
    Rule("private_key", r"-----BEGIN\x20([A-Z0-9]+\x20)*PRIVATE\x20KEY-----"),
    Rule("github", "gh[opsu]_[A-Za-z0-9]+", least=40),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", least=20),
    Rule("signed_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", least=40),
)

SPANS = "array<struct<kind:string,start:int,end:int>>"


class Finder:
    """Kinds and places of secrets in one text."""

    def __init__(self, rules):
        self.rules = rules
        self.scanner = Scanner([r.pattern for r in rules])
        self.exact = [re.compile(r.pattern.encode()) for r in rules]

    def spans(self, data):
        """(kind, start, end) in code points, by start and then by rule."""
        kept = []
        for start, number, end in self.scanner.matches(data):
            rule = self.rules[number]
            length = end - start
            if rule.group:
                part = self.exact[number].fullmatch(data, start, end)
                length = len(part[rule.group]) if part else 0
            if length >= rule.least:
                kept.append((start, number, end))
        if kept and not data.isascii():
            places = sorted({p for s, _, e in kept for p in (s, e)})
            points, at, count = {}, 0, 0
            for place in places:
                count += len(data[at:place].decode("utf-8", "replace"))
                points[place], at = count, place
            kept = [(points[s], n, points[e]) for s, n, e in kept]
        return [{"kind": self.rules[n].kind, "start": s, "end": e} for s, n, e in kept]


_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def find_secrets(docs, rules=RULES, text="text", into="secrets"):
    """Adds ``into``: kind, start and end (code points, end exclusive) of every secret, in order.

    Matches of a rule are leftmost, longest and don't overlap; rules don't
    hide each other. Texts of any length are scanned whole, one byte after
    another; null and empty texts have an empty list; repeated rows are scanned
    each. No row moves to another task. A column named ``into`` is replaced.
    """
    finder = Finder(rules)

    @F.arrow_udf(SPANS)
    def scan(texts: pa.Array) -> pa.Array:
        return pa.array([finder.spans(t.as_buffer().to_pybytes()) for t in texts], type=_SPAN_TYPE)

    return docs.withColumn(into, scan(whole_text(text)))


def redact(docs, rules=RULES, text="text"):
    """The documents with every secret replaced by its kind in brackets; overlapping ones by the first kind."""
    found = find_secrets(docs, rules, text, "_secrets")
    state = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def cut(done, span):
        begin = F.greatest(span["start"], done["at"])
        between = F.substring(F.col(text), done["at"] + 1, begin - done["at"])
        name = F.when(span["start"] >= done["at"], F.concat(F.lit("["), span["kind"], F.lit("]"))).otherwise(F.lit(""))
        return F.struct(
            F.concat(done["out"], between, name).alias("out"), F.greatest(span["end"], done["at"]).alias("at")
        )

    done = F.aggregate("_secrets", state, cut)
    rest = F.concat(done["out"], F.substring(F.col(text), done["at"] + 1, F.length(text)))
    return found.withColumn(text, F.when(F.size("_secrets") > 0, rest).otherwise(F.col(text))).drop("_secrets")
