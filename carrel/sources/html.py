"""Rows and cells of an HTML table, or of another repeated element."""

import itertools
import re
from html import unescape

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: id of the table that lists the downloads.
DOWNLOAD_TABLE = "user-corpora-download-table"

# Markup as far as rows need it: comments and raw text are passed over, and a
# quoted attribute value may hold '>'.
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)"
    r"(?P<rest>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>"
    r"|<[!?][^>]*>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""([^\s=/]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|(\S+))""")
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


def _attribute(name, rest):
    if name not in rest and name not in rest.lower():
        return None
    for found in _ATTRIBUTE.finditer(rest):
        if found[1].lower() == name:
            return unescape(found[found.lastindex])
    return None


class _Rows:
    """Collects the cells of rows that are inside the wanted container.

    Containers within it are text of the cell they are in.
    """

    def __init__(self, container, container_id, body, rows, cells):
        self.container, self.container_id, self.body = container, container_id, body
        self.row_tag, self.cell_tags = rows, cells
        self.open, self.inside, self.nested = [], None, 0
        # The open cell's text is in pieces.
        self.rows, self.row, self.cell, self.href = [], None, None, None

    def read(self, page):
        done = 0
        for part in _MARKUP.finditer(page):
            if self.cell is not None:
                self.cell.append(page[done : part.start()])
            done = part.end()
            end, tag, rest = part.group("end", "tag", "rest")
            if tag is None:
                continue
            if end:
                self._end(tag.lower())
            else:
                self._start(tag.lower(), rest)
        if self.cell is not None:
            self.cell.append(page[done:])
        self._end_row()
        return self.rows

    def _start(self, tag, rest):
        if self.inside is None:
            if tag == self.container and (
                self.container_id is None or _attribute("id", rest) == self.container_id
            ):
                self.inside = len(self.open)
        elif tag == self.container:
            self.nested += 1
        elif self.nested:
            pass
        elif tag == self.row_tag:
            self._end_row()
            if self.body is None or self.body in self.open[self.inside :]:
                self.row = []
        elif self.row is not None and tag in self.cell_tags:
            self._end_cell()
            self.cell, self.href = [], _attribute("href", rest)
        elif tag == "a" and self.cell is not None and self.href is None:
            self.href = _attribute("href", rest)
        if tag not in _VOID and not rest.endswith("/"):
            self.open.append(tag)

    def _end(self, tag):
        """Ends the tag, and whatever is open within it."""
        if tag not in self.open:
            return
        closed = None
        while closed != tag:
            closed = self.open.pop()
            if self.inside is None:
                continue
            if len(self.open) == self.inside:
                self._end_row()
                self.inside, self.nested = None, 0
            elif closed == self.container:
                self.nested -= 1
            elif not self.nested and closed in self.cell_tags:
                self._end_cell()
            elif not self.nested and closed == self.row_tag:
                self._end_row()

    def _end_cell(self):
        if self.cell is not None and self.row is not None:
            self.row.append({"text": unescape("".join(self.cell)).strip(), "href": self.href})
        self.cell = None

    def _end_row(self):
        self._end_cell()
        if self.row:
            self.rows.append(self.row)
        self.row = None


def extract_html_rows(
    pages,
    keys,
    html="html",
    container="table",
    container_id=DOWNLOAD_TABLE,
    body="tbody",
    row="tr",
    cells=("td", "th"),
    tasks=None,
):
    """One row per table row of each page: keys, row_no, cells (text, href).

    Rows count within ``body`` only, or anywhere in the container if it is None.
    Pages are parsed where they are and nothing is shuffled, unless ``tasks``
    asks to spread an input of few file splits over more cores.
    """
    cell = T.StructType().add("text", T.StringType()).add("href", T.StringType())
    schema = T.StructType([pages.schema[k] for k in keys])
    schema = schema.add("row_no", T.LongType()).add("cells", T.ArrayType(cell))
    cells = frozenset(cells)

    def listed(rows):
        """Rows of cells as one array, built from flat columns and not cell by cell."""
        flat = [[c[name] for r in rows for c in r] for name in ("text", "href")]
        values = pa.StructArray.from_arrays([pa.array(f, pa.string()) for f in flat], ["text", "href"])
        return pa.ListArray.from_arrays(pa.array([0, *itertools.accumulate(map(len, rows))], pa.int32()), values)

    def run(batches):
        for batch in batches:
            # Position of the page in the batch, number in the page, cells.
            at, numbers, found = [], [], []
            for position, page in enumerate(batch.column(html).to_pylist()):
                rows = _Rows(container, container_id, body, row, cells).read(page)
                at += [position] * len(rows)
                numbers += range(len(rows))
                found += rows
            taken = batch.select(keys).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array(numbers, pa.int64()), listed(found)],
                names=[*keys, "row_no", "cells"],
            )

    # A page without such an element has no rows and need not reach Python.
    wanted = pages.select(*keys, html).where(F.lower(html).contains(f"<{container}"))
    if tasks:
        wanted = wanted.repartition(tasks, *keys)
    return wanted.mapInArrow(run, schema)


def corpus_rows(rows, columns, link="download_link"):
    """Names the cells of extracted rows: {column: cell position}.

    The link of the first cell that has one becomes ``link``.
    """
    hrefs = F.filter(F.transform("cells", lambda c: c["href"]), lambda h: h.isNotNull())
    return rows.select(
        *[c for c in rows.columns if c not in ("cells",)],
        *[F.get("cells", F.lit(i))["text"].alias(name) for name, i in columns.items()],
        F.get(hrefs, F.lit(0)).alias(link),
    )
