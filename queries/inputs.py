"""Inputs derived from the test tables, inside Spark and from every row.

The tables hold no MARC records, files or services, so these are made from
their rows by fixed rules; the SQL of ``oracle.py`` states the same rules.
"""

import os

from pyspark.sql import functions as F

from carrel import schemas
from carrel.functions import names
from carrel.operators.enrich import RateLimited, ServiceError
from carrel.session import new_folder, stage
from carrel.sources.files import write_files
from carrel.sources.marc21 import encode, export_flat, write_marc21_partitioned
from carrel.sources.marcxml import write_marcxml

YEAR = 2026
LINK = "https://catalog.example.org/record/{id}?ln=en"
ORDERS_PER_FILE = 2000
DESCRIBE_LIMIT = 8000

_made = {}


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tasks(spark):
    """The test tables are one file split each, too few for calls and parsers."""
    return spark.sparkContext.defaultParallelism


def once(spark, sf_dir, label, make):
    """Derived files are written once per application and scale."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _made:
        _made[key] = make()
    return _made[key]


def mounted(spark, label):
    """A fresh folder that tasks can open by path."""
    folder = new_folder(spark, label)
    return folder[len("file:"):] if folder.startswith("file:") else folder


# Names


def local_names(pages):
    """File names of a folder: one to three copies per page, every fourth unknown."""
    return pages.select(
        F.explode(F.sequence(F.lit(0), F.col("page_id") % 3)).alias("copy"),
        F.when(F.col("page_id") % 4 == 0, F.concat(F.lit("scan-"), "page_id", F.lit(".tif")))
        .otherwise(names.url_basename(F.col("url")))
        .alias("filename"),
        (F.col("page_id") * 3).alias("position"),
    ).select("filename", (F.col("position") + F.col("copy")).alias("position"))


# MARCXML


def _field(tag, ind1, ind2, *pairs):
    subfields = F.array(
        *[F.struct(F.lit(c).alias("code"), v.alias("value")) for c, v in pairs]
    )
    return F.struct(
        F.lit(tag).alias("tag"),
        F.lit(ind1).alias("ind1"),
        F.lit(ind2).alias("ind2"),
        subfields.alias("subfields"),
    )


def catalog_records(pages):
    """One record per page: the whole page as text, zero to two link fields and a decoy."""
    page = F.col("page_id")
    number = page.cast("string")
    record_id = F.when(page % 50 == 0, F.lit("   ")).otherwise(F.concat(F.lit(" "), number, F.lit(" ")))
    kind = F.when(page % 4 == 0, "Text").otherwise("Image")
    decoy = _field("856", "4", "1", ("u", F.concat(F.lit("https://guide.example.org/"), number)))
    link = _field("856", "4", " ", ("9", F.lit("x")), ("u", F.col("url")))
    more = _field(
        "856", "4", " ", ("u", F.concat(F.lit("https://more.example.org/m/"), number)), ("u", F.lit(""))
    )
    fields = F.filter(
        F.array(
            _field("035", " ", " ", ("a", F.concat(F.lit("local-"), number))),
            _field("336", " ", " ", ("a", kind)),
            _field("520", " ", " ", ("a", F.col("html"))),
            F.when(page % 3 == 0, decoy),
            F.when(page % 7 != 0, link),
            F.when(page % 5 == 0, more),
            _field("982", " ", " ", ("a", F.lit("short")), ("b", F.concat(F.lit("Set "), (page % 6).cast("string")))),
        ),
        lambda f: f.isNotNull(),
    )
    record = F.struct(
        F.lit(None).cast("string").alias("leader"),
        F.array(F.struct(F.lit("001").alias("tag"), record_id.alias("value"))).alias("controlfields"),
        fields.alias("datafields"),
    )
    return pages.select(record.cast(schemas.MARC_RECORD).alias("record"))


def collection_folder(spark, sf_dir):
    def make():
        folder = new_folder(spark, "collection")
        write_marcxml(catalog_records(table(spark, sf_dir, "pages")), folder)
        return folder

    return once(spark, sf_dir, "collection", make)


# Order files


def order_file(key):
    """Name of the order file that holds an order."""
    number = F.floor(key / ORDERS_PER_FILE).cast("string")
    return F.concat(F.lit("ebook"), F.lpad(number, 6, "0"), F.lit(".ord"))


def order_records(orders):
    """Raw MARC21 of every order; some files have one unreadable record."""
    key = F.col("o_orderkey")
    number = key.cast("string")
    wanted = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "DEG additional data")
        .when(F.col("o_orderpriority") == "2-HIGH", "EBS")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "OMO additional data")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "JST")
    )
    title = _field("245", "1", "0", ("a", F.concat(F.lit("Ordre nº "), number)))
    empty = _field("961", " ", " ", ("a", F.lit("no provider here")))
    provider = _field("961", " ", " ", ("d", wanted), ("d", F.lit("WIL")))
    fields = F.filter(
        F.array(title, F.when(key % 7 == 0, empty), F.when(wanted.isNotNull(), provider)),
        lambda f: f.isNotNull(),
    )
    record = F.struct(
        F.lit(None).cast("string").alias("leader"),
        F.array(F.struct(F.lit("001").alias("tag"), number.alias("value"))).alias("controlfields"),
        fields.alias("datafields"),
    )
    last = key % ORDERS_PER_FILE == ORDERS_PER_FILE - 1
    broken = last & (F.floor(key / ORDERS_PER_FILE) % 5 == 3)
    made = orders.select(
        order_file(key).alias("output_name"),
        F.lit(0).cast("bigint").alias("block_start"),
        key.alias("seq"),
        broken.alias("broken"),
        record.cast(schemas.MARC_RECORD).alias("record"),
    )
    unreadable = F.lit("not a MARC record").cast("binary")
    return encode(made).select(
        "output_name",
        "block_start",
        "seq",
        F.when(F.col("broken"), unreadable).otherwise(F.col("raw")).alias("raw"),
    )


def write_order_files(spark, sf_dir):
    """All orders as flat ``.ord`` files in a fresh folder; a file is written in one piece, since opening one is dear."""
    parts, folder = mounted(spark, "order-parts"), mounted(spark, "order-files")
    orders = table(spark, sf_dir, "orders")
    whole = orders.repartition(tasks(spark), F.floor(F.col("o_orderkey") / ORDERS_PER_FILE))
    write_marc21_partitioned(order_records(whole), parts)
    export_flat(spark, parts, folder)
    return folder


def order_folder(spark, sf_dir):
    return once(spark, sf_dir, "order-files", lambda: write_order_files(spark, sf_dir))


def existing_outputs(orders):
    """Outputs that are said to be there already."""
    number = F.floor(F.col("o_orderkey") / ORDERS_PER_FILE)
    name = names.output_name(order_file(F.col("o_orderkey")), F.lit("EBS"), YEAR)
    return orders.where(number % 3 == 1).select(name.alias("output_name")).distinct()


# Files


def document_files(documents):
    """Every document as a file: path and bytes; some names are hidden or odd."""
    number = F.col("doc_id").cast("string")
    path = (
        F.when(F.col("doc_id") % 9 == 0, F.concat("source", F.lit("/.cache/"), number, F.lit(".txt")))
        .when(F.col("doc_id") % 9 == 1, F.concat("source", F.lit("/_"), number, F.lit(".TXT")))
        .when(F.col("doc_id") % 9 == 2, F.concat("source", F.lit("/x/."), number))
        .otherwise(F.concat("source", F.lit("/"), number, F.lit(".txt")))
    )
    return documents.select("doc_id", path.alias("path"), F.col("text").cast("binary").alias("content"))


def damaged(files):
    """The same files as found at a destination: missing, not a file, longer, edited."""
    content = F.col("content")
    edited = F.concat(F.lit(b"\x01"), F.substring(content, F.lit(2), F.octet_length(content)))
    return files.where(F.col("doc_id") % 11 != 0).select(
        F.when(F.col("doc_id") % 17 == 0, F.concat("path", F.lit("/inner"))).otherwise(F.col("path")).alias("path"),
        F.when(F.col("doc_id") % 7 == 0, F.concat(content, F.lit(b"!")))
        .when(F.col("doc_id") % 13 == 0, edited)
        .otherwise(content)
        .alias("content"),
    )


def source_folder(spark, sf_dir):
    def make():
        folder = mounted(spark, "source")
        stage(write_files(document_files(table(spark, sf_dir, "documents")), folder), "written")
        return folder

    return once(spark, sf_dir, "source", make)


def damaged_folder(spark, sf_dir):
    """A fresh damaged copy."""
    folder = mounted(spark, "destination")
    files = damaged(document_files(table(spark, sf_dir, "documents")))
    stage(write_files(files, folder), "written")
    return folder


def as_listing(files):
    """Files as (path, kind, size, sha256) without writing them."""
    return files.select(
        "path",
        F.lit("file").alias("kind"),
        F.octet_length("content").cast("bigint").alias("size"),
        F.sha2("content", 256).alias("sha256"),
    )


# Services


class ImageService:
    """Answers by the number of the record, so that SQL can state them."""

    def __init__(self):
        self.calls = {}

    def _again(self, record_id):
        self.calls[record_id] = self.calls.get(record_id, 0) + 1
        return self.calls[record_id]

    def metadata(self, record_id):
        n = int(record_id)
        if n % 10 == 1 or (n % 10 == 2 and self._again(record_id) < 3):
            raise RateLimited()
        if n % 10 == 3:
            raise ValueError(f"no such record {record_id}")
        if n % 10 == 4:
            return []
        mime = "image/tiff" if n % 10 == 0 else "image/jpeg"
        return [
            {"mime": mime, "size": n * 1009 % 9_000_000, "width": 500 + n * 13 % 9500, "height": 400 + n * 7 % 9000}
        ]

    def download(self, record_id, index, width, height):
        n = int(record_id)
        size = n * 1009 % 9_000_000
        if width is None:
            return f"/images/{record_id}.jpg", size
        # Resampling can make an image larger.
        return f"/images/{record_id}-{width}x{height}.jpg", size * 2 if n % 3 == 0 else size // 4


class StoredImages(ImageService):
    """The same service, which also leaves each image in a folder."""

    def __init__(self, folder):
        super().__init__()
        self.folder = folder

    def download(self, record_id, index, width, height):
        path, size = super().download(record_id, index, width, height)
        place = self.folder + path
        os.makedirs(os.path.dirname(place), exist_ok=True)
        with open(place, "w") as out:
            out.write(f"image {record_id} " * (int(record_id) % 9 + 1))
        return path, size


class CorpusServer:
    """Downloads by link: the bytes are the file's name, every third file is announced as another."""

    def get(self, link):
        name = link.split("/")[-1].split("?")[0]
        number = int(name.split("-")[1].split(".")[0])
        if number % 7 == 0:
            raise ServiceError(f"no file {name}")
        header = f'attachment; filename="got-{number}.tgz"' if number % 3 == 0 else None
        return header, [name[:4].encode(), name[4:].encode()]


class CaptionModel:
    """Fails, stays silent or answers by the length of what it gets."""

    def __call__(self, prompt, mime, image):
        if len(image) % 28 == 0:
            raise ServiceError(f"cannot read {len(image)} characters")
        if len(image) % 44 == 0:
            return None
        return f"{prompt} {mime} {len(image)} {image[-8:]}"


def order_catalog(orders):
    """Routed records to fetch, one per order."""
    number = F.col("o_orderkey").cast("string")
    return orders.select(
        number.alias("record_id"),
        F.concat(F.lit("local-"), number).alias("local_id"),
        F.col("o_orderpriority").alias("collection"),
        F.lit("to_process").alias("status"),
        names.record_link(number, LINK).alias("record_link"),
        F.concat(F.lit("https://img.example.org/"), number, F.lit(".jpg")).alias("image_url"),
        F.col("o_orderkey").alias("at"),
    )


def document_images(documents):
    """Documents in the place of images."""
    extension = F.get(
        F.array(*[F.lit(x) for x in ("jpg", "PNG", "gif", "webp", "jpeg")]),
        (F.col("doc_id") % 5).cast("int"),
    )
    return documents.select(
        F.col("doc_id").cast("string").alias("record_id"),
        F.concat(F.lit("local-"), F.col("doc_id").cast("string")).alias("local_id"),
        F.col("source").alias("collection"),
        F.concat(F.lit("/images/"), "source", F.lit("/"), "doc_id", F.lit("."), extension).alias("image_path"),
        F.col("text").cast("binary").alias("content"),
    )


# Corpus catalog


def corpus_pages(orders):
    """One saved page per order, with a download table of two rows."""
    number = F.col("o_orderkey").cast("string")
    customer = F.col("o_custkey").cast("string")

    def line(file, day):
        return F.concat(
            F.lit("<tr><td>C"), customer, F.lit("</td><td><b>"), file, F.lit("</b></td><td>"),
            F.date_format(day, "yyyy-MM-dd"), F.lit("</td><td><a href='/d/"), file,
            F.lit("?a=1&amp;b=2'>get</a></td><td>"), F.md5(file.cast("binary")), F.lit("</td></tr>"),
        )

    first = F.concat(F.lit("disc-"), number, F.lit(".tgz"))
    second = F.concat(F.lit("notes-"), number, F.lit(".pdf"))
    day = F.col("o_orderdate")
    html = F.concat(
        F.lit("<html><body><table id='other'><tbody><tr><td>no</td></tr></tbody></table>"
              "<table id='user-corpora-download-table'><thead><tr><th>Corpus</th></tr></thead><tbody>"),
        line(first, day), line(second, F.date_sub(day, 1)),
        F.lit("</tbody></table></body></html>"),
    )
    return orders.select(F.col("o_orderkey").alias("page"), html.alias("html"))


