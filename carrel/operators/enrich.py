"""Records through outside services, with the outcome captured per row.

Decisions (type, sizes, limits) are columns; Python only makes the calls. Their
outcomes go to a log in the shared folder while a task runs: a task that is
lost, and a second action on the result, find them there.
"""

import base64
import posixpath
import time

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type

from carrel import schemas
from carrel.functions import images, names
from carrel.operators.dedupe import last_wins
from carrel.session import new_folder
from carrel.sources.calls import CallLog, with_lots
from carrel.sources.files import open_root

# Status words and messages.
FETCHED, SKIPPED, FAILED = "fetched", "skipped", "failed"
SUCCESS, FAILURE = "success", "failure"
UNSUPPORTED = "Unsupported file type "
TOO_LARGE = "file size exceeds limit"
NO_CONTENT = "no content in response"
NO_IMAGE = "no image content"
BUSY = "catalog API too busy, try again later"


class RateLimited(Exception):
    """The service asks to slow down; the call is worth repeating."""


class ServiceError(Exception):
    """The service refused; its message goes into the row."""


def call_patiently(call, retries, first_delay, max_delay, sleep=time.sleep, used=0):
    """Result of a call and the retries used so far; rate-limited calls are repeated with doubling pauses.

    ``used`` counts the retries that the same record has had before: they are
    of one budget, and pauses go on from there. The last failure is raised.
    """
    while True:
        try:
            return call(), used
        except RateLimited:
            if used >= retries:
                raise
            sleep(min(first_delay * 2**used, max_delay))
            used += 1


#: Outcomes that a task holds before it writes them to the log.
FLUSH = 10
#: Lots for each task that runs at once.
LOTS = 8


def lots_of(spark, max_parallel):
    """How many lots the calls are dealt to: as many as may run at once, or several for each core where no limit is set."""
    return max_parallel or LOTS * spark.sparkContext.defaultParallelism


def _with_calls(df, client_factory, call, wanted, result_type, retry, log, step):
    """Adds ``_result`` and ``_error`` of one client call per wanted row.

    ``_used`` holds the retries that a record has had, over all its calls. Rows
    have ``_key``, ``_lot`` and ``_at``; a task has one lot, in the order of ``_at``.
    """
    schema = T.StructType(
        [field for field in df.schema.fields if field.name != "_used"]
        + [
            T.StructField("_result", result_type),
            T.StructField("_error", T.StringType()),
            T.StructField("_used", T.IntegerType()),
        ]
    )
    columns = [c for c in df.columns if c != "_used"]
    arrow_type = to_arrow_type(result_type)

    def outcome(client, row):
        used = row.get("_used") or 0
        if not row["_wanted"]:
            return None, None, used
        try:
            result, used = call_patiently(lambda: call(client, row), used=used, **retry)
            return result, None, used
        except RateLimited:
            return None, BUSY, retry["retries"]
        except Exception as error:  # any other failure belongs to this row alone
            return None, str(error), used

    def logged(client, calls, row):
        if not row["_wanted"]:
            return outcome(client, row)
        calls.turn_to(row["_lot"], row["_at"])
        return calls.outcome(row["_key"], lambda: outcome(client, row))

    def run(batches):
        client = client_factory()
        calls = CallLog(log, step, arrow_type, FLUSH)
        for batch in batches:
            outcomes = [logged(client, calls, row) for row in batch.to_pylist()]
            calls.close()
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.select(columns).columns,
                    pa.array([o[0] for o in outcomes], arrow_type),
                    pa.array([o[1] for o in outcomes], pa.string()),
                    pa.array([o[2] for o in outcomes], pa.int32()),
                ],
                names=schema.names,
            )

    return df.withColumn("_wanted", wanted).mapInArrow(run, schema)


def fetch_records(
    records,
    client_factory,
    record_id="record_id",
    all_files=False,
    max_parallel=None,
    retries=3,
    first_delay=3.0,
    max_delay=600.0,
    max_width=images.MAX_SIDE,
    max_height=images.MAX_SIDE,
    max_size=images.FETCH_SIZE_LIMIT,
    size_transform=images.base64_estimate,
    log=None,
):
    """Fetch one image (or all) per record: record_id, file_index, status, ...

    The client has ``metadata(record_id)``, a list of dicts with mime, size,
    width, height, and ``download(record_id, index, width, height)``, which
    returns (path, size); width and height are None for the original. It is
    built once per task. ``size_transform`` maps a size column to the size
    that counts against ``max_size``. ``max_parallel`` sets the number of
    tasks that call at once; without it all cores take small lots one after
    another. ``retries`` is the budget of a record over all its calls. Outcomes
    are logged by record in the folder ``log``, by default a new one: a task
    that is lost repeats the calls of one flush at most, and a job that is
    given the log of an earlier one goes on from there.
    """
    retry = {"retries": retries, "first_delay": first_delay, "max_delay": max_delay}
    metadata_type = T.ArrayType(T.StructType.fromDDL(schemas.FILE_METADATA[7:-1]))
    download_type = T.StructType.fromDDL("path string, size bigint")

    def metadata(client, row):
        return [
            {
                "mime": m.get("mime"),
                "size": m.get("size") or 0,
                "width": m.get("width") or 0,
                "height": m.get("height") or 0,
            }
            for m in client.metadata(row["record_id"]) or []
        ]

    def download(client, row):
        size = (row["width"], row["height"]) if row["resize"] else (None, None)
        path, written = client.download(row["record_id"], row["file_index"], *size)
        return {"path": str(path), "size": int(written)}

    spark = records.sparkSession
    log = log or new_folder(spark, "calls")
    ids = records.select(F.col(record_id).alias("record_id"))
    # Always dealt out: a small table of ids would otherwise be one task.
    ids = with_lots(ids, F.col("record_id").cast("string"), lots_of(spark, max_parallel))
    looked_up = _with_calls(ids, client_factory, metadata, F.lit(True), metadata_type, retry, log, "metadata")
    if all_files:
        position = F.explode_outer(
            F.when(F.size("_result") > 0, F.sequence(F.lit(0), F.size("_result") - 1))
        )
    else:
        position = F.lit(0)
    files = looked_up.select(
        "record_id", "_lot", "_at", "_result", "_error", "_used", position.alias("file_index")
    ).select(
        "record_id",
        "_lot",
        "_at",
        F.concat_ws(":", "record_id", F.coalesce("file_index", F.lit(0))).alias("_key"),
        F.coalesce("file_index", F.lit(0)).alias("file_index"),
        F.get("_result", F.coalesce("file_index", F.lit(0))).alias("file"),
        F.col("_error").alias("error"),
        "_used",
    )
    size = F.col("file.size")
    counted = size_transform(size) if size_transform else size
    target = images.fit(
        F.col("file.width"), F.col("file.height"), counted, max_width, max_height, max_size
    )
    planned = files.select(
        "record_id",
        "file_index",
        F.when(F.col("error").isNotNull(), FAILED)
        .when(F.col("file").isNull(), FAILED)
        .when(~images.is_supported(F.col("file.mime")), SKIPPED)
        .alias("status"),
        F.when(F.col("error").isNotNull(), F.col("error"))
        .when(F.col("file").isNull(), "no file at this index")
        .when(
            ~images.is_supported(F.col("file.mime")),
            F.concat(F.lit(UNSUPPORTED), F.coalesce("file.mime", F.lit("None"))),
        )
        .alias("description"),
        target.alias("t"),
        "_used",
        "_key",
        "_lot",
        "_at",
    ).select("record_id", "file_index", "status", "description", "t.*", "_used", "_key", "_lot", "_at")

    first = _with_calls(
        planned, client_factory, download, F.col("status").isNull(), download_type, retry, log, "download"
    )
    new_size = F.col("_result.size")
    counted = size_transform(new_size) if size_transform else new_size
    again = F.col("resize") & F.col("_result").isNotNull()
    if max_size:
        smaller = images.refit(F.col("width"), F.col("height"), counted, max_size)
    else:
        smaller = F.struct("width", "height", F.lit(False).alias("resize"))
    reduced = first.select(
        "record_id",
        "file_index",
        F.when(F.col("_error").isNotNull(), FAILED).otherwise(F.col("status")).alias("status"),
        F.coalesce("_error", "description").alias("description"),
        F.col("_result.path").alias("path"),
        F.col("resize").alias("resized"),
        F.when(again, smaller).otherwise(
            F.struct("width", "height", F.lit(False).alias("resize"))
        ).alias("t"),
        "_used",
        "_key",
        "_lot",
        "_at",
    ).select("record_id", "file_index", "status", "description", "path", "resized", "t.*", "_used", "_key", "_lot", "_at")

    second = _with_calls(
        reduced, client_factory, download, F.coalesce("resize", F.lit(False)), download_type, retry, log, "reduced"
    )
    failed = F.col("_error").isNotNull()
    status = F.when(failed, FAILED).otherwise(F.coalesce("status", F.lit(FETCHED)))
    return second.select(
        "record_id",
        "file_index",
        status.alias("status"),
        F.coalesce("_error", "description", F.lit("")).alias("description"),
        F.when(status == FETCHED, F.coalesce("_result.path", "path")).otherwise("").alias("path"),
        F.when(status == FETCHED, F.col("width")).alias("width"),
        F.when(status == FETCHED, F.col("height")).alias("height"),
    )


def attach_status(records, statuses, order):
    """Records with the outcome of their fetch, one row per outcome.

    Of several records with one id the last in ``order`` counts. The fetch
    status takes the place of the record's, its description follows it, the
    path comes last.
    """
    unique = last_wins(records, ["record_id"], order).drop("status")
    columns = []
    for name in records.columns:
        columns.append(name)
        if name == "status":
            columns.append(F.col("description").alias("status_description"))
    outcome = statuses.select("record_id", "status", "description", "path")
    return unique.join(outcome, "record_id").select(*columns, F.col("path").alias("image_path"))


def unknown_ids(records, statuses):
    """Fetch outcomes without a record, which is an error."""
    return statuses.select("record_id").join(records, "record_id", "left_anti")


def describe(
    rows,
    model_factory,
    prompt,
    root="/",
    content=None,
    batch_size=10,
    max_parallel=None,
    size_limit=images.DESCRIBE_SIZE_LIMIT,
    log=None,
):
    """Describe each row's image: adds status, status_description, description.

    The model is a callable (prompt, mime type, base64 text) built once per
    task; it returns the text, or None for an answer without content, or
    raises ``ServiceError``. Images are read from ``image_path`` below
    ``root``, or taken from the binary column ``content``. One that is too
    large in base64 is never sent, nor is a null one. Any failure stays in its
    row. ``max_parallel`` limits the calls that run at once; without it all
    cores take small lots one after another. Answers are logged by image and
    prompt in the folder ``log``, by default a new one, every ``batch_size``
    calls: a task that is lost repeats no more than these, and an image that
    several rows have is sent once.
    """
    added = ["status", "status_description", "description"]
    kept = [c for c in rows.columns if c != content and c not in added]
    schema = T.StructType(
        [rows.schema[c] for c in kept] + [T.StructField(c, T.StringType()) for c in added]
    )
    sized = rows.withColumn("mime_", names.mime_type(F.col("image_path")))
    if content:
        fits = images.base64_length(F.octet_length(F.col(content))) <= size_limit
        sized = sized.withColumn("image_", F.when(fits, images.base64_text(F.col(content))))
        sized = sized.withColumn("absent_", F.col(content).isNull())
    else:
        sized = sized.withColumn("image_", F.lit(None).cast("string")).withColumn("absent_", F.lit(False))
    spark = rows.sparkSession
    log = log or new_folder(spark, "calls")
    own = F.sha2(F.col(content), 256) if content else F.lit(None).cast("string")
    key = F.sha2(F.to_json(F.struct(F.lit(prompt).alias("p"), F.col("image_path"), own.alias("c"), F.col("absent_"))), 256)
    sized = sized.withColumn("key_", key)
    sized = with_lots(sized.select(*kept, "mime_", "image_", "absent_", "key_"), F.col("key_"), lots_of(spark, max_parallel))
    arrow_schema = to_arrow_schema(schema)

    def run(batches):
        model = model_factory()
        filesystem, base = (None, None) if content else open_root(root)
        calls = CallLog(log, "describe", pa.string(), batch_size)

        def answer(path, mime, image):
            """(text, failure, no retries): exactly one of the two is null, or both for an answer without content."""
            try:
                if content is None:
                    image = _load_base64(filesystem, base, path, size_limit)
                if image is None:
                    return None, TOO_LARGE, 0
                text = model(prompt, mime, image)
            except Exception as error:  # a failure belongs to its row; paid answers of others are kept
                return None, str(error) or type(error).__name__, 0
            return (None, NO_CONTENT, 0) if text is None else (str(text), None, 0)

        def outcome(row):
            if row["absent_"]:
                return FAILURE, NO_IMAGE, ""
            calls.turn_to(row["_lot"], row["_at"])
            text, error, _ = calls.outcome(row["_key"], lambda: answer(row["image_path"], row["mime_"], row["image_"]))
            return (SUCCESS, "", text) if error is None else (FAILURE, error, "")

        for batch in batches:
            answers = [outcome(row) for row in batch.select(["image_path", "mime_", "image_", "absent_", "_key", "_lot", "_at"]).to_pylist()]
            calls.close()
            columns = [pa.array(c, pa.string()) for c in zip(*answers)] or [pa.array([], pa.string())] * len(added)
            yield pa.RecordBatch.from_arrays([*batch.select(kept).columns, *columns], schema=arrow_schema)

    return sized.mapInArrow(run, schema)


def _load_base64(filesystem, base, path, size_limit):
    """Base64 text of a stored image; None, and unread, if it would be too long."""
    full = posixpath.join(base, path.lstrip("/"))
    if 4 * -(-filesystem.get_file_info(full).size // 3) > size_limit:
        return None
    with filesystem.open_input_stream(full) as stream:
        return base64.b64encode(stream.read()).decode("ascii")


def to_output(
    described, link_template, model_label, model_id, job, namespace, version, run_date
):
    """The eleven output columns; labels and date are parameters, not clock reads.

    ``version`` may be a column, as when prompts differ by row.
    """

    def column(value):
        return value if isinstance(value, Column) else F.lit(str(value))

    before, after = link_template.split("{id}")
    return described.select(
        "local_id",
        F.concat(F.lit(before), "local_id", F.lit(after)).alias("record_link"),
        names.path_basename(F.col("image_path")).alias("image_name"),
        "collection",
        "status",
        F.coalesce("status_description", F.lit("")).alias("status_description"),
        F.coalesce("description", F.lit("")).alias("description"),
        names.review_note(column(model_label)).alias("note"),
        names.provenance(
            column(job), column(model_id), column(namespace), column(version)
        ).alias("provenance"),
        column(run_date).alias("run_date"),
        F.lit("520").alias("target_field"),
    )


def with_lookup(rows, dimension, keys):
    """Each row with the attributes of its key, e.g. prompt text and version."""
    return rows.join(dimension, keys, "left")
