"""The answers of the queries as SQL over the test tables.

The rules by which ``inputs.py`` derives its inputs are stated here again.
"""

SEGMENT = (
    r"url_decode(regexp_extract({u}, "
    r"'^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?(?:[^?#]*/)?([^/?#]*)', 1))"
)
BASE = SEGMENT.format(u="url")

LOCAL = f"""
local_rows AS (
  SELECT CASE WHEN page_id % 4 = 0 THEN 'scan-' || page_id || '.tif' ELSE {BASE} END AS filename,
         page_id * 3 + c AS position
  FROM pages, UNNEST(range(0, page_id % 3 + 1)) AS u(c)),
mine AS (SELECT filename, min(position) AS first_seen FROM local_rows GROUP BY filename),
theirs AS (SELECT DISTINCT {BASE} AS filename FROM pages WHERE url <> ''),
result AS (
  SELECT filename, first_seen, filename IN (SELECT filename FROM theirs) AS in_catalog FROM mine)
"""

RULER = "=" * 40

# MARCXML records made from pages.
LINKS = "(CASE WHEN page_id % 7 <> 0 THEN 1 ELSE 0 END + CASE WHEN page_id % 5 = 0 THEN 2 ELSE 0 END)"
ACCEPTED = f"({LINKS} = 1 AND page_id % 4 <> 0)"
RECORD_ID = "(CASE WHEN page_id % 50 = 0 THEN '' ELSE page_id::VARCHAR END)"
RECORD_LINK = (
    f"CASE WHEN {RECORD_ID} = '' THEN 'No Record Link' "
    f"ELSE 'https://catalog.example.org/record/' || {RECORD_ID} || '?ln=en' END"
)
ROUTED = f"""
SELECT {RECORD_ID} AS record_id, 'local-' || page_id AS local_id,
       'Set ' || (page_id % 6) AS collection,
       CASE WHEN {ACCEPTED} THEN 'to_process' ELSE 'skipped' END AS status,
       {RECORD_LINK} AS record_link,
       CASE WHEN {ACCEPTED} THEN url END AS image_url
FROM pages
"""

# Order files made from orders.
ORDER_ROWS = """
order_rows AS (
  SELECT o_orderkey AS k, o_orderkey // 2000 AS f,
         'ebook' || lpad((o_orderkey // 2000)::VARCHAR, 6, '0') || '.ord' AS filename,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'DEG additional data' WHEN '2-HIGH' THEN 'EBS'
              WHEN '3-MEDIUM' THEN 'OMO additional data' WHEN '4-NOT SPECIFIED' THEN 'JST' END AS wanted,
         CASE WHEN o_orderkey % 7 = 0 THEN 'ZZZ' WHEN o_orderpriority = '1-URGENT' THEN 'DEG'
              WHEN o_orderpriority = '2-HIGH' THEN 'EBS'
              WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'JST' ELSE 'ZZZ' END AS provider,
         o_orderkey % 2000 = 1999 AND (o_orderkey // 2000) % 5 = 3 AS broken
  FROM orders),
bad AS (SELECT DISTINCT filename FROM order_rows WHERE broken),
accepted AS (
  SELECT *, replace(filename, 'ebook', 'ebook' || provider || '2026') AS output_name,
         provider = 'EBS' AND f % 3 = 1 AS there
  FROM order_rows WHERE filename NOT IN (SELECT filename FROM bad))
"""
STATS = f"""
WITH {ORDER_ROWS},
counts AS (
  SELECT filename, provider, output_name, there, count(*) AS n FROM accepted GROUP BY ALL),
stats AS (
  SELECT filename, sum(n)::BIGINT AS records_read,
         coalesce(sum(n) FILTER (NOT there), 0)::BIGINT AS records_written,
         coalesce(sum(n) FILTER (there), 0)::BIGINT AS records_skipped,
         string_agg(provider || '=' || output_name, ',' ORDER BY provider) AS outputs,
         coalesce(string_agg(provider, ',' ORDER BY provider) FILTER (there), '') AS skipped_providers
  FROM counts GROUP BY filename)
"""

# Files made from documents.
FILES = """
files AS (
  SELECT doc_id, text, strlen(text) AS size, sha256(text) AS sha256,
         CASE doc_id % 9 WHEN 0 THEN source || '/.cache/' || doc_id || '.txt'
              WHEN 1 THEN source || '/_' || doc_id || '.TXT'
              WHEN 2 THEN source || '/x/.' || doc_id
              ELSE source || '/' || doc_id || '.txt' END AS path
  FROM documents),
visible AS (SELECT * FROM files WHERE doc_id % 9 NOT IN (0, 2))
"""
VERIFIED = f"""
WITH {FILES},
report AS (
  SELECT path, size, sha256,
         CASE WHEN doc_id % 11 = 0 OR doc_id % 17 = 0 THEN 'missing'
              WHEN doc_id % 7 = 0 THEN 'size_mismatch'
              WHEN doc_id % 13 = 0 THEN 'checksum_mismatch' ELSE 'verified' END AS status,
         CASE WHEN doc_id % 11 = 0 THEN 'missing' WHEN doc_id % 17 = 0 THEN 'not_a_file'
              WHEN doc_id % 7 = 0 THEN 'size_mismatch'
              WHEN doc_id % 13 = 0 THEN 'checksum_mismatch' ELSE 'verified' END AS disk_status,
         doc_id
  FROM visible)
"""

# Image sizes of lines.
LINE_IMAGES = """
li AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         1 + (l_partkey * 37 + l_linenumber) % 12000 AS w,
         1 + (l_orderkey * 53 + l_suppkey) % 9000 AS h,
         floor(l_extendedprice * 100)::BIGINT AS size
  FROM lineitem),
sized AS (SELECT *, ceil((size::DOUBLE / 3.0e0) * 4.0e0)::BIGINT AS b FROM li)
"""
FACTOR = (
    "least(1.0e0, CASE WHEN b > 3750000 THEN 3750000.0e0 / b::DOUBLE ELSE 1.0e0 END,"
    " CASE WHEN w > 8000 THEN 8000.0e0 / w::DOUBLE ELSE 1.0e0 END,"
    " CASE WHEN h > 8000 THEN 8000.0e0 / h::DOUBLE ELSE 1.0e0 END)"
)
FITTED = f"""
fitted AS (SELECT *, {FACTOR} AS factor FROM sized),
cut AS (
  SELECT *, trunc(w * factor)::BIGINT AS tw, trunc(h * factor)::BIGINT AS th,
         trunc(w * factor)::BIGINT <> w OR trunc(h * factor)::BIGINT <> h AS resize
  FROM fitted)
"""


def fetched(source):
    """Outcome of every record number ``n`` of the relation ``source``."""
    return f"""
src AS ({source}),
sized AS (
  SELECT *, n * 1009 % 9000000 AS size, 500 + n * 13 % 9500 AS w, 400 + n * 7 % 9000 AS h,
         ceil(((n * 1009 % 9000000)::DOUBLE / 3.0e0) * 4.0e0)::BIGINT AS b
  FROM src),
{FITTED},
grown AS (
  SELECT *, ceil(((CASE WHEN n % 3 = 0 THEN size * 2 ELSE size // 4 END)::DOUBLE / 3.0e0) * 4.0e0)::BIGINT AS b2
  FROM cut),
final AS (
  SELECT *, resize AND b2 > 3750000 AS again, 3750000.0e0 / b2::DOUBLE - 0.05e0 AS factor2 FROM grown),
outcome AS (
  SELECT *,
    CASE WHEN again THEN trunc(tw * factor2)::BIGINT ELSE tw END AS fw,
    CASE WHEN again THEN trunc(th * factor2)::BIGINT ELSE th END AS fh,
    CASE n % 10 WHEN 0 THEN 'skipped' WHEN 1 THEN 'failed' WHEN 3 THEN 'failed' WHEN 4 THEN 'failed'
         ELSE 'fetched' END AS status,
    CASE n % 10 WHEN 0 THEN 'Unsupported file type image/tiff'
         WHEN 1 THEN 'catalog API too busy, try again later'
         WHEN 3 THEN 'no such record ' || n WHEN 4 THEN 'no file at this index' ELSE '' END AS description
  FROM final),
statuses AS (
  SELECT *, CASE WHEN status <> 'fetched' THEN ''
                 WHEN resize THEN '/images/' || n || '-' || fw || 'x' || fh || '.jpg'
                 ELSE '/images/' || n || '.jpg' END AS path
  FROM outcome)
"""


ORDER_FETCH = fetched("SELECT o_orderkey AS n, * FROM orders")

DESCRIBED = """
images AS (
  SELECT doc_id, source,
    '/images/' || source || '/' || doc_id || '.' ||
      CASE doc_id % 5 WHEN 0 THEN 'jpg' WHEN 1 THEN 'PNG' WHEN 2 THEN 'gif' WHEN 3 THEN 'webp' ELSE 'jpeg' END AS image_path,
    CASE doc_id % 5 WHEN 0 THEN 'image/jpeg' WHEN 1 THEN 'image/png' WHEN 2 THEN 'image/gif'
         WHEN 3 THEN 'image/webp' ELSE 'image/jpeg' END AS mime,
    to_base64(encode(text)) AS b64
  FROM documents),
described AS (
  SELECT *, length(b64) AS n,
    CASE WHEN length(b64) > 8000 OR length(b64) % 28 = 0 OR length(b64) % 44 = 0 THEN 'failure' ELSE 'success' END AS status,
    CASE WHEN length(b64) > 8000 THEN 'file size exceeds limit'
         WHEN length(b64) % 28 = 0 THEN 'cannot read ' || length(b64) || ' characters'
         WHEN length(b64) % 44 = 0 THEN 'no content in response' ELSE '' END AS status_description,
    CASE WHEN length(b64) > 8000 OR length(b64) % 28 = 0 OR length(b64) % 44 = 0 THEN ''
         ELSE 'Describe. ' || mime || ' ' || length(b64) || ' ' || right(b64, 8) END AS description
  FROM images)
"""

PAGE_FETCH = fetched(f"SELECT page_id AS n, * FROM pages WHERE {ACCEPTED}")

PAGE_DESCRIBED = """
stored AS (
  SELECT * EXCLUDE (size), to_base64(encode(repeat('image ' || n || ' ', (n % 9 + 1)::INT))) AS b64
  FROM statuses WHERE status = 'fetched'),
answers AS (
  SELECT *, length(b64) AS size,
    CASE WHEN length(b64) % 28 = 0 OR length(b64) % 44 = 0 THEN 'failure' ELSE 'success' END AS answer
  FROM stored)
"""

ORACLE = {
    "reconcile_both": f"WITH {LOCAL} SELECT filename, in_catalog FROM result",
    "reconcile_in": f"WITH {LOCAL} SELECT filename FROM result WHERE in_catalog",
    "reconcile_not_in": f"WITH {LOCAL} SELECT filename, first_seen FROM result WHERE NOT in_catalog",
    "reconcile_report": f"""
WITH {LOCAL},
n AS (SELECT count(*) FILTER (in_catalog) AS a, count(*) FILTER (NOT in_catalog) AS b FROM result)
SELECT 0 AS section, '000' AS ord, '{RULER}' AS line FROM n
UNION ALL SELECT 0, '001', rpad('     CATALOG FILE COMPARISON REPORT', 40, ' ') FROM n
UNION ALL SELECT 0, '002', '{RULER}' FROM n
UNION ALL SELECT 1, '000', 'Total files found in Catalog: ' || a FROM n
UNION ALL SELECT 1, '001', 'Total files not found in Catalog: ' || b FROM n
UNION ALL SELECT 1, '002', '{RULER}' FROM n
UNION ALL SELECT 2, '000', '' FROM n WHERE a > 0
UNION ALL SELECT 2, '001', '--- FILES FOUND IN CATALOG ---' FROM n WHERE a > 0
UNION ALL SELECT 3, filename, filename FROM result WHERE in_catalog
UNION ALL SELECT 4, '000', '{RULER}' FROM n WHERE a > 0
UNION ALL SELECT 5, '000', '' FROM n WHERE b > 0
UNION ALL SELECT 5, '001', '--- FILES NOT FOUND IN CATALOG ---' FROM n WHERE b > 0
UNION ALL SELECT 6, filename, filename FROM result WHERE NOT in_catalog
UNION ALL SELECT 7, '000', '{RULER}' FROM n WHERE b > 0
""",
    "reconcile_report_text": f"""
WITH {LOCAL},
n AS (SELECT count(*) AS b FROM result WHERE NOT in_catalog)
SELECT 0::BIGINT AS line_no, '{RULER}' AS line FROM n
UNION ALL SELECT 1, rpad('     ARCHIVE FILE COMPARISON REPORT', 40, ' ') FROM n
UNION ALL SELECT 2, '{RULER}' FROM n
UNION ALL SELECT 3, 'Total files not found in Archive: ' || b FROM n
UNION ALL SELECT 4, '{RULER}' FROM n
UNION ALL SELECT 5, '' FROM n WHERE b > 0
UNION ALL SELECT 6, '--- FILES NOT FOUND IN ARCHIVE ---' FROM n WHERE b > 0
UNION ALL SELECT 6 + row_number() OVER (ORDER BY first_seen), filename FROM result WHERE NOT in_catalog
UNION ALL SELECT 7 + b, '{RULER}' FROM n WHERE b > 0
""",
    "reconcile_folder": f"""
WITH named AS (
  SELECT CASE WHEN {BASE} = '' THEN 'none' ELSE replace({BASE}, '/', '_') END AS name FROM pages),
mine AS (
  SELECT name || '.f' AS filename FROM named
  UNION SELECT name FROM named WHERE contains(name, '.')),
theirs AS (
  SELECT {BASE} AS filename FROM pages WHERE page_id % 7 <> 0 AND url <> ''
  UNION ALL SELECT page_id::VARCHAR FROM pages WHERE page_id % 5 = 0)
SELECT filename, filename IN (SELECT filename FROM theirs) AS in_catalog FROM mine
""",
    "url_names": rf"""
SELECT page_id, {BASE} AS url_name,
       regexp_extract(rtrim(url, '/'), '([^/]*)$', 1) AS path_name,
       regexp_extract(url, '([^/]*)$', 1) AS key_name
FROM pages
""",
    "marcxml_fields": f"""
SELECT 'local-' || page_id AS local_id, {RECORD_ID} AS record_id, md5(html) AS text_md5,
       {LINKS}::BIGINT AS links,
       concat_ws('|', CASE WHEN page_id % 7 <> 0 THEN url END,
                 CASE WHEN page_id % 5 = 0 THEN 'https://more.example.org/m/' || page_id || '|' END) AS urls,
       {ACCEPTED} AS single_image, '' AS absent
FROM pages
""",
    "marcxml_route": ROUTED,
    "routing_counts": f"SELECT status, count(*) AS records FROM ({ROUTED}) GROUP BY status",
    "marcxml_prefixed": """
SELECT 'local-' || page_id AS local_id,
       concat_ws('|', CASE WHEN page_id % 7 <> 0 THEN url END,
                 CASE WHEN page_id % 5 = 0 THEN 'https://more.example.org/m/' || page_id || '|' END) AS urls,
       2::BIGINT AS records
FROM pages
""",
    "marcxml_urls": f"""
SELECT url, {BASE} AS filename FROM pages WHERE page_id % 7 <> 0 AND url <> ''
UNION ALL
SELECT 'https://more.example.org/m/' || page_id, page_id::VARCHAR FROM pages WHERE page_id % 5 = 0
""",
    "missing_urls": f"""
SELECT 'local-' || page_id AS local_id,
       'Record ' || {RECORD_ID} || ' accepted by filter but has no 856 URLs' AS violation
FROM pages WHERE page_id % 4 <> 0 AND {LINKS} = 0
""",
    "order_files_listed": f"WITH {ORDER_ROWS} SELECT DISTINCT filename FROM order_rows",
    "marc21_records": f"""
WITH {ORDER_ROWS}
SELECT filename, row_number() OVER (PARTITION BY filename ORDER BY k) - 1 AS record_index,
       CASE WHEN broken THEN '' ELSE k::VARCHAR END AS record_id,
       CASE WHEN broken THEN '' ELSE 'Ordre nº ' || k END AS title,
       CASE WHEN NOT broken THEN provider END AS provider,
       CASE WHEN broken THEN 'record length is not a number' END AS parse_error
FROM order_rows
""",
    "marc21_route": f"""
WITH {ORDER_ROWS}
SELECT output_name, k::VARCHAR AS record_id,
       (24 + 12 * 2 + 1 + strlen(k::VARCHAR) + 1 + strlen('Ordre nº ' || k) + 5
        + CASE WHEN k % 7 = 0 THEN 12 + 5 + strlen('no provider here') ELSE 0 END
        + CASE WHEN wanted IS NOT NULL THEN 12 + 5 + strlen(wanted) + 5 ELSE 0 END)::BIGINT AS bytes
FROM accepted WHERE NOT there
""",
    "marc21_flat_outputs": f"""
WITH {ORDER_ROWS}
SELECT output_name, row_number() OVER (PARTITION BY output_name ORDER BY k) - 1 AS position,
       k::VARCHAR AS record_id
FROM accepted WHERE NOT there
""",
    "marc21_stats": f"""
{STATS}
SELECT filename, filename AS archived_as, records_read, records_written, records_skipped, outputs,
       skipped_providers
FROM stats
""",
    "marc21_rejects": f"""
WITH {ORDER_ROWS} SELECT filename, 'record length is not a number' AS reason FROM bad
""",
    "order_stream_stats": f"""
{STATS}
SELECT filename, records_read, records_written, records_skipped, outputs,
       records_read IS NULL AS left_behind, records_read IS NOT NULL AS archived
FROM (SELECT DISTINCT filename FROM order_rows) LEFT JOIN stats USING (filename)
UNION ALL SELECT 'ebook-nothing.ord', 0, 0, 0, '', false, true
""",
    "output_names": """
SELECT o_orderkey,
       replace('ebook' || lpad((o_orderkey // 2000)::VARCHAR, 6, '0') || '.ord-ebook', 'ebook',
               'ebook' || left(o_orderpriority, 1) || '2026') AS output_name
FROM orders
""",
    "manifest_build": f"WITH {FILES} SELECT '/source' AS source_root, path, size, sha256 FROM visible",
    "manifest_custom_pattern": f"""
WITH {FILES} SELECT path, size FROM files
WHERE doc_id % 9 <> 1 AND NOT regexp_matches(path, '^src1[0-9]/')
""",
    "manifest_totals": f"WITH {FILES} SELECT count(*) AS files, sum(size)::BIGINT AS bytes FROM visible",
    "manifest_verify": f"{VERIFIED} SELECT path, status, size, sha256 FROM report",
    "manifest_summary": f"""
{VERIFIED} SELECT status, count(*) AS files, sum(size)::BIGINT AS bytes FROM report GROUP BY status
""",
    "copy_plan": f"""
{VERIFIED}
SELECT path, size, sha256,
       CASE WHEN status = 'verified' THEN 'skip' WHEN doc_id % 19 = 0 THEN 'source_not_a_file'
            ELSE 'copy' END AS action
FROM report
""",
    "files_inventory": f"WITH {FILES} SELECT path, size FROM files",
    "files_manifest": f"WITH {FILES} SELECT path, size, sha256 FROM visible",
    "files_verify": f"{VERIFIED} SELECT path, disk_status AS status, size, sha256 FROM report",
    "files_copy": f"""
WITH {FILES}
SELECT path, 'verified' AS status, size AS copied, 'skip' AS resume, sha256 FROM visible
""",
    "object_keys": f"""
WITH {FILES} SELECT path AS key, size FROM files
WHERE starts_with(path, 'src1') AND ends_with(lower(path), '.txt')
""",
    "object_download": f"""
WITH {FILES}, named AS (SELECT *, regexp_extract(path, '([^/]*)$', 1) AS filename FROM files)
SELECT path AS key, filename, CASE WHEN doc_id % 23 <> 0 THEN size END AS bytes,
       CASE WHEN doc_id % 23 = 0 THEN filename || ' exists' END AS error
FROM named
UNION ALL
SELECT 'zz/' || filename, filename, NULL, path || ' has the name ' || filename
FROM named WHERE doc_id % 17 = 0
""",
    "name_clashes": r"""
SELECT regexp_extract(url, '([^/]*)$', 1) AS basename, count(*) AS keys
FROM pages GROUP BY 1 HAVING count(*) > 1
""",
    "key_filter": r"""
SELECT key FROM (SELECT 'data/' || regexp_replace(url, '^(https?)://', '\1/') AS key FROM pages)
WHERE starts_with(key, 'data/https/') AND ends_with(lower(key), '.html')
""",
    "listing_by_extension": f"""
WITH {FILES}
SELECT path, ends_with(path, '.txt') AS is_txt,
       contains(regexp_extract(path, '([^/]*)$', 1), '.') AS has_dot,
       starts_with(path, 'src1') AS on_volume
FROM files
""",
    "digests": """
SELECT doc_id, sha256(text) AS sha256, md5(text) AS md5, length(to_base64(encode(text))) AS encoded,
       (4 * ((strlen(text) + 2) // 3))::BIGINT AS encoded_length,
       ceil(((strlen(text) + 0.5e0) / 3.0e0) * 4.0e0)::BIGINT AS estimate
FROM documents
""",
    "declared_checksum": """
WITH d AS (
  SELECT doc_id, source || '-' || doc_id || '.bin' AS file, md5(text) AS md5 FROM documents)
SELECT file, CASE WHEN doc_id % 3 = 0 THEN doc_id || '.tgz' ELSE file END AS target, md5,
       CASE WHEN doc_id % 10 = 0 THEN reverse(md5) ELSE md5 END AS declared_md5,
       CASE WHEN doc_id % 10 = 0 THEN reverse(md5) ELSE md5 END = md5 AS checksum_ok
FROM d
""",
    "image_fit": f"""
WITH {LINE_IMAGES}, {FITTED}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, tw AS fit_width, th AS fit_height, resize
FROM cut
""",
    "image_refit": f"""
WITH {LINE_IMAGES}, {FITTED},
grown AS (
  SELECT *, ceil(((size * (l_linenumber % 3 + 1))::DOUBLE / 3.0e0) * 4.0e0)::BIGINT AS b2 FROM cut),
r AS (SELECT *, 3750000.0e0 / b2::DOUBLE - 0.05e0 AS f2, b2 > 3750000 AS again FROM grown)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN again THEN trunc(tw * f2)::BIGINT ELSE tw END AS refit_width,
       CASE WHEN again THEN trunc(th * f2)::BIGINT ELSE th END AS refit_height, again
FROM r
""",
    "fetch_status": f"""
WITH {ORDER_FETCH}
SELECT n::VARCHAR AS record_id, status, description, path,
       CASE WHEN status = 'fetched' THEN fw END AS width,
       CASE WHEN status = 'fetched' THEN fh END AS height
FROM statuses
""",
    "fetched": f"""
WITH {ORDER_FETCH}
SELECT n::VARCHAR AS record_id, 'local-' || n AS local_id, o_orderpriority AS collection, status,
       description AS status_description,
       'https://catalog.example.org/record/' || n || '?ln=en' AS record_link,
       'https://img.example.org/' || n || '.jpg' AS image_url, path AS image_path
FROM statuses
""",
    "unknown_ids": "SELECT o_orderkey::VARCHAR AS record_id FROM orders WHERE o_orderstatus = 'P'",
    "describe": f"""
WITH {DESCRIBED}
SELECT doc_id::VARCHAR AS record_id, status, status_description, description FROM described
""",
    "output_rows": f"""
WITH {DESCRIBED}
SELECT 'local-' || doc_id AS local_id,
       'https://catalog.example.org/r/local-' || doc_id AS record_link,
       regexp_extract(image_path, '([^/]*)$', 1) AS image_name, source AS collection, status,
       status_description, description,
       'Image description generated by AI (Model One) and reviewed on [MM/YYYY].' AS note,
       'image-description|model-1|carrel/7' AS provenance, '2026-02-03' AS run_date,
       '520' AS target_field
FROM described
""",
    "job_summary": f"""
WITH {ORDER_FETCH}, {DESCRIBED}
SELECT 'fetched' AS stage, count(*) AS total, count(*) FILTER (status = 'fetched') AS successes,
       count(*) FILTER (status <> 'fetched') AS failures FROM statuses
UNION ALL
SELECT 'processed', count(*), count(*) FILTER (status = 'success'),
       count(*) FILTER (status <> 'success') FROM described
UNION ALL
SELECT 'skipped', count(*), NULL, NULL FROM ({ROUTED}) WHERE status = 'skipped'
""",
    "enrichment_fetched": f"""
WITH {PAGE_FETCH}
SELECT n::VARCHAR AS record_id, 'local-' || n AS local_id, 'Set ' || (n % 6) AS collection, status,
       description AS status_description,
       'https://catalog.example.org/record/' || n || '?ln=en' AS record_link, url AS image_url,
       path AS image_path
FROM statuses
""",
    "enrichment_run": f"""
WITH {PAGE_FETCH}, {PAGE_DESCRIBED}
SELECT 'local-' || n AS local_id, 'https://catalog.example.org/r/local-' || n AS record_link,
       regexp_extract(path, '([^/]*)$', 1) AS image_name, 'Set ' || (n % 6) AS collection, answer AS status,
       CASE answer WHEN 'success' THEN ''
            ELSE CASE WHEN size % 28 = 0 THEN 'cannot read ' || size || ' characters'
                      ELSE 'no content in response' END END AS status_description,
       CASE answer WHEN 'success' THEN 'Describe. image/jpeg ' || size || ' ' || right(b64, 8) ELSE '' END AS description,
       'Image description generated by AI (Model One) and reviewed on [MM/YYYY].' AS note,
       'image-description|model-1|carrel/7' AS provenance, '2026-02-03' AS run_date,
       '520' AS target_field
FROM answers
""",
    "enrichment_summary": f"""
WITH {PAGE_FETCH}, {PAGE_DESCRIBED}
SELECT 'fetched' AS stage, count(*) AS total, count(*) FILTER (status = 'fetched') AS successes,
       count(*) FILTER (status <> 'fetched') AS failures FROM statuses
UNION ALL
SELECT 'processed', count(*), count(*) FILTER (answer = 'success'),
       count(*) FILTER (answer <> 'success') FROM answers
UNION ALL
SELECT 'skipped', count(*), NULL, NULL FROM ({ROUTED}) WHERE status = 'skipped'
""",    "status_summary": """
SELECT count(*) AS total, count(*) FILTER (event_type = 'purchase') AS successes,
       count(*) FILTER (event_type IS DISTINCT FROM 'purchase') AS failures
FROM events
""",
    "prompt_lookup": """
SELECT c_custkey, n_name, n_regionkey::BIGINT AS n_regionkey
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
""",
    "mime_types": """
WITH named AS (
  SELECT doc_id, '/images/' || source || '/' || doc_id * 3 || '.' || CASE doc_id * 3 % 5 WHEN 0 THEN 'jpg' WHEN 1 THEN 'PNG'
         WHEN 2 THEN 'gif' WHEN 3 THEN 'webp' ELSE 'jpeg' END AS image_path
  FROM documents)
SELECT image_path || CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN '.tiff' WHEN 2 THEN '.unknown' WHEN 3 THEN '.mp4'
       ELSE '/plain' END AS image_path,
       CASE doc_id % 5 WHEN 0 THEN 'image/jpeg' WHEN 1 THEN 'image/tiff' WHEN 3 THEN 'video/mp4' END AS mime,
       doc_id % 5 = 0 AS supported
FROM named
""",    "stamps": """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y%m%d_%H%M%S') AS second,
       left('0' || event_id, 2) AS shard,
       event_type || '|m|ns/' || user_id AS provenance,
       'Image description generated by AI (' || event_type || ') and reviewed on [MM/YYYY].' AS note,
       CASE WHEN user_id % 10 = 0 THEN 'No Record Link'
            ELSE 'https://catalog.example.org/record/' || user_id || '?ln=en' END AS link
FROM events
""",
    "assigned_batches": """
WITH n AS (
  SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS row_index FROM orders)
SELECT o_orderkey, row_index, row_index // 10 AS batch_id FROM n
""",
    "first_seen": """
SELECT user_id, event_type, event_id, value, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1
""",
    "last_wins": """
SELECT user_id, event_type, event_id, value, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1
""",
    "latest_invoice": """
SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders
QUALIFY rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) = 1
""",
    "html_table": """
WITH l AS (
  SELECT o_orderkey AS page, o_custkey, r AS row_no,
         CASE r WHEN 0 THEN 'disc-' || o_orderkey || '.tgz' ELSE 'notes-' || o_orderkey || '.pdf' END AS file,
         o_orderdate::DATE - r::INT AS day
  FROM orders, UNNEST([0::BIGINT, 1::BIGINT]) AS u(r))
SELECT page, row_no, 'C' || o_custkey AS corpus_id, file, strftime(day, '%Y-%m-%d') AS invoice,
       md5(file) AS checksum, '/d/' || file || '?a=1&b=2' AS download_link
FROM l
""",
    "html_rows": r"""
WITH nav AS (
  SELECT page_id, regexp_extract_all(regexp_extract(html, '(?s)<nav>.*?</nav>'),
                                     '<li><a href="[^"]*">[^<]*</a></li>') AS items
  FROM pages),
item AS (
  SELECT page_id, unnest(items) AS item, generate_subscripts(items, 1) - 1 AS row_no FROM nav)
SELECT page_id, row_no, trim(regexp_extract(item, '>([^<>]*)</a>', 1)) AS text,
       regexp_extract(item, 'href="([^"]*)"', 1) AS href
FROM item
""",
    "corpus_latest": """
SELECT 'C' || o_custkey AS corpus_id, 'disc-' || o_orderkey || '.tgz' AS file,
       '/d/disc-' || o_orderkey || '.tgz?a=1&b=2' AS download_link
FROM orders
QUALIFY rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) = 1
""",
    "corpus_available": """
SELECT 'C' || o_custkey AS corpus_id, file, '/d/' || file || '?a=1&b=2' AS download_link
FROM (SELECT *, 'disc-' || o_orderkey || '.tgz' AS file FROM orders
      WHERE o_custkey = (SELECT min(o_custkey) FROM orders)
      QUALIFY rank() OVER (ORDER BY o_orderdate DESC) = 1)
""",
    "corpus_download": """
WITH latest AS (
  SELECT o_orderkey AS k, 'disc-' || o_orderkey || '.tgz' AS file FROM orders
  QUALIFY rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) = 1)
SELECT file, CASE WHEN k % 7 = 0 THEN NULL WHEN k % 3 = 0 THEN 'got-' || k || '.tgz' ELSE file END AS target,
       CASE WHEN k % 7 <> 0 THEN strlen(file) END AS bytes, CASE WHEN k % 7 <> 0 THEN md5(file) END AS md5,
       CASE WHEN k % 7 <> 0 THEN true END AS checksum_ok,
       CASE WHEN k % 7 = 0 THEN 'no file ' || file END AS error
FROM latest
""",
    "run_snapshot_emptied": "SELECT o_orderkey, o_orderpriority, 'run-2' AS run FROM orders",
    "run_snapshot": "SELECT o_orderkey, o_orderpriority FROM orders",
    "csv_round_trip": """
SELECT doc_id::VARCHAR AS doc_id, md5(' "' || text || '",' || chr(10) || ' ') AS md5, '' AS "none"
FROM documents
""",
    "record_shards": """
SELECT left(o_orderkey::VARCHAR, 2) AS shard, count(*) AS records, min(o_orderkey::VARCHAR) AS first_id
FROM orders GROUP BY 1
""",
}
