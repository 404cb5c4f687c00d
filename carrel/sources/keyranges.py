"""Listing a flat key space by ranges of keys, by many tasks.

A store gives keys in order, a page at a time, from any key on. A task lists a
few pages of its range; what is left of it is split by what the task has seen:
where its keys went that far in so many pages, the next ranges are as wide, then
twice as wide, and so on. The ranges of a step are listed by as many tasks, and
are split again where they turn out to be full. Ranges never overlap and leave
nothing out, however badly they are cut.
"""

import os.path

import pyarrow as pa
from pyspark.sql import functions as F

from carrel.session import new_folder

LISTED = "path string, size bigint, modified timestamp, after string, upto string"
_SCHEMA = pa.schema(
    [("path", pa.string()), ("size", pa.int64()), ("modified", pa.timestamp("us", tz="UTC")), ("after", pa.string()), ("upto", pa.string())]
)
#: Keys are compared by so many characters after what they have in common; printable ASCII are the digits.
DIGITS, FIRST, BASE = 8, 32, 95


def _number(text):
    value = 0
    for place in range(DIGITS):
        digit = min(max(ord(text[place]) - FIRST, 0), BASE - 1) if place < len(text) else 0
        value = value * BASE + digit
    return value


def _text(value):
    digits = []
    for _ in range(DIGITS):
        value, digit = divmod(value, BASE)
        digits.append(chr(digit + FIRST))
    return "".join(reversed(digits)).rstrip(" ")


def split_rest(seen, upto, fan):
    """Ranges (after, upto) of what comes behind the keys seen, up to and with ``upto`` (None: no end)."""
    first, last = seen[0], seen[-1]
    common = os.path.commonprefix([first, last])
    at = _number(last[len(common) :])
    step = max(1, at - _number(first[len(common) :]))
    cuts = []
    for _ in range(fan - 1):
        at += step
        if at >= BASE**DIGITS:
            break
        cut = common + _text(at)
        if cut > last and (not cuts or cut > cuts[-1]) and (upto is None or cut < upto):
            cuts.append(cut)
        step *= 2
    edges = [last, *cuts, upto]
    return list(zip(edges[:-1], edges[1:]))


def _list(lister_factory, prefix, pages, page, fan):
    def run(batches):
        lister = lister_factory()
        for batch in batches:
            for after, upto in zip(batch.column("after").to_pylist(), batch.column("upto").to_pylist()):
                seen = []
                for number in range(pages):
                    found = lister.page(prefix, after, page)
                    own = [row for row in found if upto is None or row[0] <= upto]
                    if own:
                        seen += [own[0][0], own[-1][0]]
                        after = own[-1][0]
                        columns = [pa.array(c, t) for c, t in zip(zip(*own), _SCHEMA.types)]
                        none = pa.nulls(len(own), pa.string())
                        yield pa.RecordBatch.from_arrays([*columns, none, none], schema=_SCHEMA)
                    if len(found) < page or len(own) < len(found):
                        break
                else:
                    rest = [{"after": a, "upto": b} for a, b in split_rest(seen, upto, fan)]
                    yield pa.RecordBatch.from_pylist(rest, _SCHEMA)

    return run


def walk_keys(spark, lister_factory, prefix="", pages=10, page=1000, fan=16, most_steps=200):
    """All keys with the prefix: ``path``, ``size``, ``modified``.

    The lister, built once per task, has ``page(prefix, after, limit)``: up to
    ``limit`` rows (key, size, modified) of keys greater than ``after`` (None:
    from the first), in the order of their code points. Each step is written to
    the shared folder.
    """
    folder = new_folder(spark, "key-listing")
    # The empty range: from the first key on, without an end.
    frontier = spark.createDataFrame([(None, None)], "after string, upto string").repartition(1)
    steps = []
    for step in range(most_steps):
        target = f"{folder}/step={step:04d}"
        frontier.mapInArrow(_list(lister_factory, prefix, pages, page, fan), LISTED).write.parquet(target)
        steps.append(target)
        rest = spark.read.schema(LISTED).parquet(target).where("after is not null").select("after", "upto")
        number = rest.count()
        if not number:
            break
        frontier = rest.repartition(number)
    else:
        raise RuntimeError(f"keys are left after {most_steps} steps")
    return spark.read.schema(LISTED).parquet(*steps).where(F.col("path").isNotNull()).select("path", "size", "modified")
