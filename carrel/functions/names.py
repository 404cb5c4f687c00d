"""Names, links and keys."""

import mimetypes
import re

from pyspark.sql import functions as F

# Last path segment of a URL: no scheme, host, query or fragment.
URL_LAST_SEGMENT = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?(?:[^?#]*/)?([^/?#]*)"

# Fixed value: the header that announces a file name.
ATTACHMENT = r'^attachment; filename="(.*)"$'

#: Media type by file extension: the standard table of Python, and what it lacks.
MIME_BY_EXTENSION = {ending[1:]: kind for ending, kind in sorted(mimetypes.MimeTypes().types_map[1].items())}
MIME_BY_EXTENSION |= {"jp2": "image/jp2", "webp": "image/webp"}


def url_basename(url):
    """Decoded last path segment of a URL; '' for a bare host or a trailing '/'.

    A plus sign is kept. An escape that is not one, or that does not decode to
    UTF-8, stays as it is.
    """
    segment = F.regexp_extract(url, URL_LAST_SEGMENT, 1)
    guarded = F.regexp_replace(segment, r"%(?![0-9A-Fa-f]{2})", "%25")
    decoded = F.try_url_decode(F.replace(guarded, F.lit("+"), F.lit("%2B")))
    broken = decoded.isNull() | (
        decoded.contains("\ufffd") & ~F.upper(segment).contains("%EF%BF%BD")
    )
    # Most segments hold no escape: skip the decoder for them.
    return F.when(~segment.contains("%"), segment).when(broken, segment).otherwise(decoded)


def path_basename(path):
    """What follows the last '/', trailing ones ignored."""
    return F.element_at(F.split(F.regexp_replace(path, r"(?<=.)/+$", ""), "/"), -1)


def key_basename(key):
    """What follows the last '/' of an object key; '' for a key that ends in one."""
    return F.element_at(F.split(key, "/"), -1)


def output_name(file_name, provider, year):
    """Every 'ebook' in the file name becomes 'ebook' + provider + year."""
    return F.replace(
        file_name, F.lit("ebook"), F.concat(F.lit("ebook"), provider, F.lit(str(year)))
    )


def record_link(record_id, template):
    """``template`` with ``{id}`` filled in, or a fixed text for an empty id."""
    before, after = template.split("{id}")
    return F.when(F.coalesce(record_id, F.lit("")) == "", "No Record Link").otherwise(
        F.concat(F.lit(before), record_id, F.lit(after))
    )


def download_name(content_disposition, fallback):
    """File name a server announces, else the fallback."""
    announced = F.regexp_extract(F.coalesce(content_disposition, F.lit("")), ATTACHMENT, 1)
    return F.coalesce(F.nullif(announced, F.lit("")), fallback)


def announced_name(content_disposition):
    """The same in Python, for a task that has the header of a call; empty if none."""
    found = re.search(ATTACHMENT, content_disposition or "")
    return found[1] if found else ""


def mime_type(path):
    """Media type by extension, null if unknown."""
    extension = F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))
    table = F.create_map(*[F.lit(x) for pair in MIME_BY_EXTENSION.items() for x in pair])
    return F.try_element_at(table, extension)


def shard_key(record_id):
    """First two characters."""
    return F.substring(record_id, 1, 2)


def day_stamp(timestamp):
    return F.date_format(timestamp, "yyyy-MM-dd")


def second_stamp(timestamp):
    return F.date_format(timestamp, "yyyyMMdd_HHmmss")


def provenance(job, model_id, namespace, version):
    """``job|model|namespace/version``."""
    return F.concat_ws("|", job, model_id, F.concat(namespace, F.lit("/"), version))


def review_note(model_label):
    # Fixed value: wording of the note.
    return F.concat(
        F.lit("Image description generated by AI ("),
        model_label,
        F.lit(") and reviewed on [MM/YYYY]."),
    )
