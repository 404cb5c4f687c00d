"""Row shapes shared by the sources and operators."""

SUBFIELD = "struct<code:string,value:string>"
CONTROL_FIELD = "struct<tag:string,value:string>"
DATA_FIELD = f"struct<tag:string,ind1:string,ind2:string,subfields:array<{SUBFIELD}>>"

# Tags and subfield codes repeat and their order matters, so a record is
# nested arrays and never a map.
MARC_RECORD = (
    f"struct<leader:string,controlfields:array<{CONTROL_FIELD}>,datafields:array<{DATA_FIELD}>>"
)

FILE_METADATA = "struct<mime:string,size:bigint,width:int,height:int>"

# Column headings of the exported stage tables, in order.
# Inside the library the names are snake_case, because two of the headings
# differ in case only and Spark resolves names without regard to case.
TO_PROCESS_HEADINGS = {
    "record_id": "Record ID",
    "local_id": "035__a",
    "collection": "Collection name",
    "status": "Status",
    "record_link": "Link to record",
    "image_url": "Image Url",
}
SKIPPED_HEADINGS = {
    "record_id": "Record ID",
    "local_id": "035__a",
    "collection": "Collection name",
    "status": "Status",
    "record_link": "Link to record",
}
FETCHED_HEADINGS = {
    "record_id": "Record ID",
    "local_id": "035__a",
    "collection": "Collection name",
    "status": "Status",
    "status_description": "Status Description",
    "record_link": "Link to record",
    "image_url": "Image Url",
    "image_path": "Image Path",
}
PROCESSED_HEADINGS = {
    "local_id": "035__a",
    "record_link": "Link to record",
    "image_name": "Image Name",
    "collection": "Collection name",
    "status": "Status",
    "status_description": "Status description",
    "description": "520__a-1",
    "note": "5880_a",
    "provenance": "983__a-1",
    "run_date": "983__d-1",
    "target_field": "983__t-1",
}


def with_headings(df, headings):
    """Only the columns of ``headings``, in its order, under the export names."""
    return df.select([df[name].alias(heading) for name, heading in headings.items()])


def strings_of(headings):
    """Read schema of an exported stage table: every column a string."""
    return ", ".join(f"`{heading}` string" for heading in headings.values())
