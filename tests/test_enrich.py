import base64
import datetime
import functools
import os

import pytest
from pyspark.sql import functions as F

from carrel import schemas
from carrel.functions import images
from carrel.operators import enrich, summary
from carrel.plans import enrichment
from carrel.sources.marcxml import read_checked
from carrel.sources.tables import read_run, read_stage
from tests.helpers import collection, xml_record


class Client:
    """Behaves by record id and writes down its calls."""

    log = None
    meta = {"mime": "image/jpeg", "size": 1977086, "width": 4032, "height": 3024}

    def __init__(self):
        self.tries = {}

    def metadata(self, record_id):
        self.tries[record_id] = self.tries.get(record_id, 0) + 1
        if record_id == "busy" or (record_id == "soon" and self.tries[record_id] < 4):
            raise enrich.RateLimited()
        if record_id == "broken":
            raise KeyError("gone")
        if record_id == "tiff":
            return [{**self.meta, "mime": "image/tiff"}]
        if record_id == "untyped":
            return [{"size": 3}]
        if record_id == "empty":
            return []
        if record_id == "bare":
            return [{"mime": "image/png"}]
        if record_id == "two":
            return [{**self.meta, "width": 10, "height": 20, "size": 5}, self.meta]
        return [self.meta]

    def download(self, record_id, index, width, height):
        if record_id == "lost":
            raise OSError("no route")
        if width is None:
            return f"/img/{record_id}-{index}.jpg", 5
        return f"/img/{record_id}-{index}-{width}x{height}.jpg", 481229


LIMITS = {"max_width": 2000, "max_height": 2000, "max_size": 262144, "size_transform": None, "first_delay": 0.0}


def fetch(spark, ids, **options):
    df = spark.createDataFrame([(i,) for i in ids], "record_id string")
    return enrich.fetch_records(df, Client, **{**LIMITS, **options})


def test_outcomes(spark):
    ids = ["ok", "busy", "soon", "broken", "tiff", "untyped", "empty", "bare", "lost"]
    got = {r.record_id: r for r in fetch(spark, ids).collect()}
    assert {k: (r.status, r.description) for k, r in got.items()} == {
        "ok": ("fetched", ""),
        "busy": ("failed", enrich.BUSY),
        "soon": ("fetched", ""),
        "broken": ("failed", "'gone'"),
        "tiff": ("skipped", "Unsupported file type image/tiff"),
        "untyped": ("skipped", "Unsupported file type None"),
        "empty": ("failed", "no file at this index"),
        "bare": ("fetched", ""),
        "lost": ("failed", "no route"),
    }
    assert got["ok"].path == "/img/ok-0-264x197.jpg"
    assert got["bare"].path == "/img/bare-0.jpg"
    assert got["lost"].path == "" and got["lost"].width is None


def test_second_download_only_if_still_too_large(spark):
    (row,) = fetch(spark, ["ok"], max_size=1048576).collect()
    assert row.path == "/img/ok-0-1999x1500.jpg" or row.path.startswith("/img/ok-0-")
    assert (row.width, row.height) == (2000, 1500)


def test_all_files_of_a_record(spark):
    got = fetch(spark, ["two", "empty", "busy"], all_files=True).collect()
    assert sorted((r.record_id, r.file_index, r.status, r.path) for r in got) == [
        ("busy", 0, "failed", ""),
        ("empty", 0, "failed", ""),
        ("two", 0, "fetched", "/img/two-0.jpg"),
        ("two", 1, "fetched", "/img/two-1-264x197.jpg"),
    ]


def test_pauses_double_up_to_the_limit():
    pauses = []

    def never():
        raise enrich.RateLimited()

    with pytest.raises(enrich.RateLimited):
        enrich.call_patiently(never, 9, 3.0, 600.0, pauses.append)
    assert pauses == [3.0, 6.0, 12.0, 24.0, 48.0, 96.0, 192.0, 384.0, 600.0]


def test_status_replaces_the_old_one(spark):
    records = spark.createDataFrame(
        [("1", "a", "to_process", 0), ("1", "b", "to_process", 1), ("2", "c", "to_process", 2)],
        "record_id string, collection string, status string, at int",
    )
    statuses = spark.createDataFrame(
        [("1", "fetched", "", "/p"), ("9", "failed", "x", "")],
        "record_id string, status string, description string, path string",
    )
    got = enrich.attach_status(records, statuses, ["at"])
    assert got.columns == [
        "record_id", "collection", "status", "status_description", "at", "image_path"
    ]
    assert [tuple(r) for r in got.collect()] == [("1", "b", "fetched", "", 1, "/p")]
    assert [r.record_id for r in enrich.unknown_ids(records, statuses).collect()] == ["9"]


class Model:
    def __call__(self, prompt, mime, image):
        data = base64.b64decode(image)
        if data == b"refused":
            raise enrich.ServiceError("An error has occurred.")
        if data == b"silent":
            return None
        return f"{prompt} {mime} {data.decode()}"


def test_descriptions_from_files(spark, tmp_path):
    for name, data in (("a.jpg", b"fine"), ("b.png", b"refused"), ("c.xyz", b"silent"), ("d.gif", b"x" * 100)):
        (tmp_path / name).write_bytes(data)
    rows = spark.createDataFrame(
        [(n, f"/{n}") for n in ("a.jpg", "b.png", "c.xyz", "d.gif")], "record_id string, image_path string"
    )
    got = enrich.describe(rows, Model, "P:", root=str(tmp_path), size_limit=100, max_parallel=2)
    assert {r.record_id: (r.status, r.status_description, r.description) for r in got.collect()} == {
        "a.jpg": ("success", "", "P: image/jpeg fine"),
        "b.png": ("failure", "An error has occurred.", ""),
        "c.xyz": ("failure", "no content in response", ""),
        "d.gif": ("failure", "file size exceeds limit", ""),
    }


def test_large_image_is_never_sent(spark):
    class Unused:
        def __call__(self, *_):
            raise AssertionError("called")

    size = images.DESCRIBE_SIZE_LIMIT // 4 * 3 + 1
    rows = spark.createDataFrame([("a.jpg", bytes(size))], "image_path string, content binary")
    (row,) = enrich.describe(rows, Unused, "P", content="content").collect()
    assert (row.status, row.status_description) == ("failure", "file size exceeds limit")


def test_unexpected_model_error_stays_in_its_row(spark):
    class Wrong:
        def __call__(self, *_):
            raise RuntimeError("bug in model")

    rows = spark.createDataFrame([("a.jpg", b"1"), ("b.jpg", None)], "image_path string, content binary")
    got = {r.image_path: r for r in enrich.describe(rows, Wrong, "P", content="content").collect()}
    assert got["a.jpg"].status == "failure" and got["a.jpg"].status_description == "bug in model"
    assert got["b.jpg"].status_description == enrich.NO_IMAGE


def test_calls_are_spread_over_all_cores(spark):
    ids = spark.range(5_000).select(F.col("id").cast("string").alias("record_id")).coalesce(1)
    calls = enrich.fetch_records(ids, Client, first_delay=0.0)
    cores = spark.sparkContext.defaultParallelism
    assert cores > 1 and calls.rdd.getNumPartitions() == enrich.LOTS * cores
    described = enrich.describe(
        spark.createDataFrame([("a.jpg", b"1")], "image_path string, content binary"), Model, "P", content="content"
    )
    assert described.rdd.getNumPartitions() == cores


def test_one_budget_of_retries_per_record():
    left = {"first": 2, "second": 2}

    def busy(name):
        if left[name]:
            left[name] -= 1
            raise enrich.RateLimited()
        return name

    pauses = []
    assert enrich.call_patiently(lambda: busy("first"), 3, 1.0, 60.0, pauses.append) == ("first", 2)
    with pytest.raises(enrich.RateLimited):
        enrich.call_patiently(lambda: busy("second"), 3, 1.0, 60.0, pauses.append, used=2)
    assert pauses == [1.0, 2.0, 4.0]


def test_summary_counts_null_as_failure(spark):
    df = spark.createDataFrame([("success",), ("failure",), (None,), ("success",)], "status string")
    assert tuple(summary.status_summary(df, "success").head()) == (4, 2, 2)
    assert tuple(summary.status_summary(df.limit(0), "success").head()) == (0, 0, 0)


class RunClient(Client):
    def __init__(self, folder):
        self.folder = folder

    def metadata(self, record_id):
        return [{"mime": "image/tiff" if record_id == "3" else "image/jpeg"}]

    def download(self, record_id, index, width, height):
        path = os.path.join(self.folder, f"{record_id}.jpg")
        with open(path, "wb") as out:
            out.write(b"silent" if record_id == "2" else b"fine")
        return path, 4


def test_whole_run(spark, tmp_path):
    (tmp_path / "c.xml").write_text(
        collection(*[xml_record(i) for i in (1, 2, 3)], xml_record(1), xml_record(4, kind="Text"))
    )
    (tmp_path / "img").mkdir()
    client = functools.partial(RunClient, str(tmp_path / "img"))
    settings = enrichment.Settings(
        link_template="https://c.example.org/{id}", output_link_template="https://c.example.org/r/{id}",
        prompt="P:", prompt_version="3", model_id="m", model_label="M", run_date="2026-02-03",
    )
    done = enrichment.run(
        read_checked(spark, str(tmp_path / "c.xml")), client, Model, settings,
        str(tmp_path / "run"), "r1", datetime.datetime(2026, 2, 3, 4, 5, 6),
    )
    assert {r.stage: (r.total, r.successes, r.failures) for r in done.collect()} == {
        "fetched": (3, 2, 1), "processed": (2, 1, 1), "skipped": (1, None, None)
    }
    export = tmp_path / "run" / "exports" / "r1" / "imagedesc_processed_20260203_040506.csv"
    rows = read_stage(spark, str(export), schemas.PROCESSED_HEADINGS).collect()
    assert sorted((r.image_name, r.status, r.description) for r in rows) == [
        ("1.jpg", "success", "P: image/jpeg fine"), ("2.jpg", "failure", "")
    ]
    assert rows[0].note == "Image description generated by AI (M) and reviewed on [MM/YYYY]."
    assert rows[0].provenance == "image-description|m|carrel/3"
    assert (rows[0].run_date, rows[0].target_field) == ("2026-02-03", "520")
    stored = read_run(
        spark, str(tmp_path / "run"), "fetched", "r1", "record_id string, status string"
    )
    assert {r.record_id: r.status for r in stored.collect()} == {
        "1": "fetched", "2": "fetched", "3": "skipped"
    }


class Counted(Client):
    """Notes every call in a file; its task dies once, at a call of the first run."""

    folder = dies_at = None

    def note(self, name):
        with open(os.path.join(self.folder, f"calls-{os.getpid()}"), "a") as out:
            out.write(f"{name}\n")
        if self.dies_at and sum(1 for _ in open(os.path.join(self.folder, f"calls-{os.getpid()}"))) == self.dies_at:
            os._exit(1)

    def metadata(self, record_id):
        self.note(f"metadata {record_id}")
        return super().metadata(record_id)

    def download(self, record_id, index, width, height):
        self.note(f"download {record_id} {width}")
        return super().download(record_id, index, width, height)


def counted(folder, dies_at):
    client = Counted()
    client.folder, client.dies_at = folder, dies_at
    return client


def calls_in(folder):
    return [line.strip() for name in os.listdir(folder) for line in open(os.path.join(folder, name))]


def test_a_task_that_dies_repeats_one_flush_at_most(spark, tmp_path):
    folder, log = tmp_path / "calls", str(tmp_path / "log")
    folder.mkdir()
    ids = spark.createDataFrame([(f"r{i}",) for i in range(60)], "record_id string")

    def run(dies_at):
        made = functools.partial(counted, str(folder), dies_at)
        return enrich.fetch_records(ids, made, **LIMITS, max_parallel=1, log=log).collect()

    with pytest.raises(Exception):
        run(47)
    before = calls_in(folder)
    assert len(before) == 47
    got = run(None)
    every = calls_in(folder)
    assert len(got) == 60 and all(r.status == "fetched" for r in got)
    # Metadata, the file, and its smaller form once each; what was not yet logged again.
    assert len(set(every)) == 180 and len(every) <= 180 + enrich.FLUSH
    run(None)
    assert len(calls_in(folder)) == len(every)  # a second action calls nothing


class CountedModel:
    def __init__(self, folder, dies_at):
        self.folder, self.dies_at, self.n = folder, dies_at, 0

    def __call__(self, prompt, mime, image):
        self.n += 1
        with open(os.path.join(self.folder, f"calls-{os.getpid()}"), "a") as out:
            out.write(image + "\n")
        if self.n == self.dies_at:
            os._exit(1)
        return f"{prompt} {mime}"


def test_paid_answers_outlive_their_task(spark, tmp_path):
    folder, log = tmp_path / "calls", str(tmp_path / "log")
    folder.mkdir()
    rows = spark.range(40).select(
        F.concat(F.lit("/i/"), F.col("id"), F.lit(".png")).alias("image_path"), F.col("id").cast("string").cast("binary").alias("content")
    )
    rows = rows.unionByName(rows.where("image_path = '/i/7.png'"))

    def run(dies_at):
        made = functools.partial(CountedModel, str(folder), dies_at)
        return enrich.describe(rows, made, "look", content="content", max_parallel=1, log=log).collect()

    with pytest.raises(Exception):
        run(25)
    got = run(None)
    assert len(got) == 41 and {(r.status, r.description) for r in got} == {("success", "look image/png")}
    sent = calls_in(folder)
    assert len(set(sent)) == 40 and len(sent) <= 40 + 10


def test_calls_are_dealt_to_small_lots(spark):
    ids = spark.range(5000).select(F.col("id").cast("string").alias("record_id"))
    cores = spark.sparkContext.defaultParallelism
    fetched = enrich.fetch_records(ids, Client, **LIMITS)
    own = fetched.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(own) == enrich.LOTS * cores
    assert max(r["count"] for r in own) < 2 * 5000 / len(own)
    assert enrich.fetch_records(ids, Client, **LIMITS, max_parallel=3).rdd.getNumPartitions() == 3
