"""A log of outcomes of outside calls, kept while a task runs.

Rows are dealt to lots by their key, so a row is in the same lot whenever it is
worked on. A task writes the outcomes of a lot in small files, a few at a time;
a task that works on the lot again reads them first and calls only for the rest.
So a task that dies repeats no more than the calls of one file, and a job that
is started again with the same log goes on where it stopped.

The rows of a lot come in the order of a hash of their keys, and a file's name
says from which hash to which it goes. So a task reads a file when it gets there
and forgets what lies behind: it holds a few files' outcomes, however large its
lot is.
"""

import posixpath
import uuid

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import functions as F

from carrel.sources.files import open_root


#: The folders that a lot's log is cut into by hash, so that no listing holds all of it.
CELLS = 64
FIRST, LAST = -(2**63), 2**63 - 1


def with_lots(rows, key, lots):
    """Adds ``_key``, ``_lot`` and ``_at``, a hash of the key; deals the rows, a task for each lot, in the order of ``_at``.

    Where there are more lots than tasks run at once, a free core takes the next
    one, so a slow call or client holds back its own lot only.
    """
    keyed = rows.withColumn("_key", key).withColumn("_at", F.xxhash64("_key"))
    keyed = keyed.withColumn("_lot", F.pmod("_at", F.lit(lots)).cast("int"))
    return keyed.repartitionById(lots, "_lot").sortWithinPartitions("_at")


def _span(name):
    """The hashes a file goes from and to; all of them where its name does not say."""
    parts = name.removesuffix(".arrow").split("_")
    return (int(parts[0]), int(parts[1])) if len(parts) == 3 else (FIRST, LAST)


class CallLog:
    """The outcomes of one step; used by a task for one lot after another.

    An outcome is (result, error, retries used). Files are written under another
    name and renamed, so that a file is whole or not there. What is logged stays:
    a failure that was logged is not tried again. Rows that are not in order cost
    time, as the files are read anew, but no call.
    """

    def __init__(self, root, step, result_type, flush):
        self.filesystem, base = open_root(root)
        self.folder, self.flush = posixpath.join(base, step), flush
        self.schema = pa.schema([("key", pa.string()), ("result", result_type), ("error", pa.string()), ("used", pa.int32())])
        self.place, self.at = None, FIRST
        #: Outcomes by key, each with the hash up to which it is held; files yet to be read, the last one first.
        self.known, self.files, self.pending, self.trim_at = {}, [], [], 0

    def _folder(self, cell=None):
        lot = posixpath.join(self.folder, f"lot={self.place[0]:06d}")
        return lot if cell is None else posixpath.join(lot, f"cell={cell:03d}")

    def _listed(self, folder):
        selector = arrow_fs.FileSelector(folder, allow_not_found=True)
        for info in self.filesystem.get_file_info(selector):
            if info.base_name.endswith(".arrow") and not info.base_name.startswith("."):
                first, last = _span(info.base_name)
                if last >= self.at:
                    self.files.append((-first, last, info.path))

    def turn_to(self, lot, at):
        """Turn to the next row's lot and hash: what the log holds for them is read, and what lies before is forgotten."""
        place = (lot, (at - FIRST) * CELLS >> 64)
        if place != self.place or at < self.at:
            self.close()
            self.known, self.files, self.trim_at = {}, [], 0
            self.place, self.at = place, at
            self._listed(self._folder())
            self._listed(self._folder(place[1]))
            self.files.sort()
        self.at = at
        while self.files and -self.files[-1][0] <= at:
            self._read(*self.files.pop()[1:])
        if len(self.known) > self.trim_at:
            self.known = {key: entry for key, entry in self.known.items() if entry[0] >= at}
            self.trim_at = 2 * len(self.known) + 100 * self.flush

    def _read(self, last, path):
        if last < self.at:
            return
        with self.filesystem.open_input_file(path) as source:
            rows = pa.ipc.open_file(source).read_all()
        for row in rows.to_pylist():
            self.known[row["key"]] = (last, (row["result"], row["error"], row["used"]))

    def outcome(self, key, call):
        """The logged outcome of the key, else that of ``call``, which is noted."""
        if key not in self.known:
            done = call()
            self.known[key] = (self.at, done)
            self.pending.append((self.at, key, *done))
            if len(self.pending) >= self.flush:
                self.close()
        return self.known[key][1]

    def close(self):
        """Write what has been noted."""
        if not self.pending:
            return
        rows = [dict(zip(("key", "result", "error", "used"), noted[1:])) for noted in self.pending]
        folder, token = self._folder(self.place[1]), uuid.uuid4().hex
        name = f"{self.pending[0][0]}_{self.pending[-1][0]}_{token}.arrow"
        self.filesystem.create_dir(folder, recursive=True)
        aside = posixpath.join(folder, f".{token}.tmp")
        with self.filesystem.open_output_stream(aside) as out, pa.ipc.new_file(out, self.schema) as writer:
            writer.write_table(pa.Table.from_pylist(rows, self.schema))
        self.filesystem.move(aside, posixpath.join(folder, name))
        self.pending = []
