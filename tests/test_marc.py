import re

import pytest
from pyspark.sql import functions as F

from carrel import schemas
from carrel.functions import marc, marcxml
from carrel.operators import routing
from carrel.plans.reconciliation import catalog_file_names
from carrel.sources.marcxml import explode_subfield, read_checked, read_marcxml, truncated_files
from carrel.sources.tables import read_stage, write_stage
from tests.helpers import collection, xml_record

LINK = "https://catalog.example.org/record/{id}?ln=en"


def records(spark, tmp_path, *xml):
    (tmp_path / "records.xml").write_text(collection(*xml), encoding="utf-8")
    return read_marcxml(spark, str(tmp_path / "records.xml"))


def routes(df, **options):
    rows = routing.route_records(df, LINK, **options).collect()
    return {r.record_id: r for r in rows}


def test_real_filter_sends_each_record_one_way(spark, tmp_path):
    df = records(
        spark,
        tmp_path,
        xml_record(1, urls=["http://img.jpg"]),
        xml_record(2, urls=[]),
        xml_record(3, urls=["http://a.jpg", "http://b.jpg"]),
        xml_record(4, kind="Text"),
        xml_record(5, kind=None),
        xml_record(6, ind1="0"),
        xml_record(7, ind2="1"),
    )
    got = routes(df)
    assert {k: r.status for k, r in got.items()} == {
        "1": "to_process", **{n: "skipped" for n in "234567"}
    }
    assert got["1"].image_url == "http://img.jpg"
    assert got["1"].record_link == "https://catalog.example.org/record/1?ln=en"
    counts = {r.status: r.records for r in routing.routing_counts(routing.route_records(df, LINK)).collect()}
    assert counts == {"to_process": 1, "skipped": 6}


def test_blank_or_absent_id_has_no_link(spark, tmp_path):
    got = routes(records(spark, tmp_path, xml_record("   ")), predicate=lambda r: F.lit(False))
    assert got[""].record_link == "No Record Link"
    got = routes(records(spark, tmp_path, xml_record(None)))
    assert got[""].record_link == "No Record Link"


def test_accepted_record_without_url_is_an_error(spark, tmp_path):
    df = records(spark, tmp_path, xml_record(8, urls=[]))
    routed = routing.route_records(df, LINK, predicate=lambda r: F.lit(True))
    with pytest.raises(ValueError, match="Record 8 accepted by filter but has no 856 URLs"):
        routing.require_none(routing.missing_urls(routed))
    routing.require_none(routing.missing_urls(routing.route_records(df, LINK)))


def test_skipped_table_has_five_columns_and_headers_without_rows(spark, tmp_path):
    routed = routing.route_records(records(spark, tmp_path, xml_record(1)), LINK)
    write_stage(routing.skipped(routed), str(tmp_path / "s"), schemas.SKIPPED_HEADINGS)
    text = "".join(p.read_text() for p in (tmp_path / "s").glob("part-*"))
    assert text.strip() == "Record ID,035__a,Collection name,Status,Link to record"
    write_stage(routing.to_process(routed), str(tmp_path / "p"), schemas.TO_PROCESS_HEADINGS)
    back = read_stage(spark, str(tmp_path / "p"), schemas.TO_PROCESS_HEADINGS).collect()
    assert [r.record_id for r in back] == ["1"] and back[0].collection == ""


def test_values_keep_blanks_entities_and_order(spark, tmp_path):
    xml = """<record><controlfield tag="001"> 27 </controlfield>
      <datafield tag="035" ind1=" " ind2=" "><subfield code="b">no</subfield></datafield>
      <datafield tag="035" ind1=" " ind2=" "><subfield code="a">x &amp; y &lt;z&gt;</subfield>
        <subfield code="a">second</subfield></datafield>
      <datafield tag="856" ind1="4" ind2=" "><subfield code="u"></subfield><subfield code="u">later</subfield></datafield>
      <datafield tag="856" ind1="4" ind2=" "><subfield code="u">one</subfield><subfield code="u">two</subfield></datafield>
    </record>"""
    df = records(spark, tmp_path, xml)
    rec = F.col("record")
    row = df.select(
        marc.control_field(rec, "001").alias("id"),
        marc.subfield_first(rec, "035", "a").alias("first"),
        marc.subfield_first(rec, "999", "a").alias("absent"),
        marc.link_urls(rec).alias("all"),
    ).head()
    assert (row.id, row["first"], row.absent) == ("27", "x & y <z>", "")
    assert row["all"] == ["", "later", "one", "two"]
    # One value per field, the first; an empty first one drops the field.
    assert [r.value for r in explode_subfield(df, "856", "4", " ", "u").collect()] == ["one"]


def test_catalog_names_of_links(spark, tmp_path):
    df = records(
        spark,
        tmp_path,
        xml_record(1, urls=["https://example.org/path/file_one.jpg", "", "https://e.org/b%20c.pdf?x#y"]),
        xml_record(2, urls=["https://example.org/ignored.jpg"], ind1="0"),
    )
    assert {r.filename for r in catalog_file_names(df).collect()} == {"file_one.jpg", "b c.pdf"}


def test_collection_is_read_in_splits(spark, tmp_path, small_splits):
    n = 200
    df = records(spark, tmp_path, *[xml_record(i, urls=[f"http://e.org/{i}é.jpg"]) for i in range(n)])
    assert df.rdd.getNumPartitions() > 20
    got = (
        df.orderBy("source_file", "block_start", "seq")
        .select(marc.control_field(F.col("record"), "001").alias("id"), "parse_error")
        .collect()
    )
    assert [r.id for r in got] == [str(i) for i in range(n)]
    assert all(r.parse_error is None for r in got)


def test_broken_record_is_reported(spark, tmp_path):
    rows = records(
        spark, tmp_path, xml_record(1), '<record><datafield tag="1</record>', xml_record(2)
    ).collect()
    assert sum(r.parse_error is not None for r in rows) == 1
    assert sum(r.record is not None for r in rows) == 2


def test_checked_reading_fails_on_any_fault(spark, tmp_path):
    records(spark, tmp_path, xml_record(1), '<record><datafield tag="1</record>')
    with pytest.raises(Exception, match="not well-formed"):
        read_checked(spark, str(tmp_path)).select("record").collect()


@pytest.mark.parametrize("ending", ["", "</collection>", "\n</collection>\n"])
def test_file_that_ends_within_a_record(spark, tmp_path, small_splits, ending):
    whole = "<collection>" + "".join(xml_record(i) for i in range(30))
    (tmp_path / "good.xml").write_text(whole + ending)
    assert truncated_files(spark, str(tmp_path)).count() == 0
    assert read_checked(spark, str(tmp_path)).count() == 30
    (tmp_path / "cut.xml").write_text(whole[: -len("</record>")] + ending)
    (bad,) = truncated_files(spark, str(tmp_path)).collect()
    assert bad.source_file.endswith("/cut.xml")
    with pytest.raises(ValueError, match="ends within a record"):
        read_checked(spark, str(tmp_path))


def test_prefixed_elements(spark, tmp_path):
    (tmp_path / "p.xml").write_text(
        '<marc:collection xmlns:marc="http://www.loc.gov/MARC21/slim"><marc:record>'
        '<marc:controlfield tag="001">5</marc:controlfield></marc:record></marc:collection>'
    )
    df = read_marcxml(spark, str(tmp_path / "p.xml"), row_tag="marc:record")
    assert df.select(marc.control_field(F.col("record"), "001")).head()[0] == "5"


def test_missing_collection_fails(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        read_marcxml(spark, str(tmp_path / "none.xml")).count()


def test_text_of_a_record_round_trips(spark):
    record = spark.createDataFrame(
        [("l", [("001", "<&>\"'")], [("245", "1", " ", [("a", "é & ü"), ("b", "")])])],
        "leader string, controlfields array<struct<tag:string,value:string>>, "
        f"datafields array<{schemas.DATA_FIELD}>",
    ).select(F.struct("*").alias("record"))
    back = record.select("record", marcxml.to_text(F.col("record")).alias("x")).select(
        "record", marcxml.record_of(marcxml.from_text(F.col("x"))).alias("again")
    )
    row = back.head()
    assert row.again == row.record


def test_records_with_a_prefix(spark, tmp_path):
    plain = collection(*[xml_record(i) for i in range(3)])
    marked = re.sub(r"<(/?)(record|collection|controlfield|datafield|subfield|leader)", r"<\1marc:\2", collection(*[xml_record(i) for i in range(10, 14)]))
    marked = marked.replace("xmlns=", "xmlns:marc=")
    (tmp_path / "a.xml").write_text(plain)
    (tmp_path / "b.xml").write_text(marked)
    ids = lambda records: sorted(int(r[0]) for r in records.select(marc.control_field(F.col("record"), "001")).collect())
    assert ids(read_checked(spark, str(tmp_path / "b.xml"))) == [10, 11, 12, 13]
    assert ids(read_checked(spark, str(tmp_path))) == [0, 1, 2, 10, 11, 12, 13]
    (tmp_path / "c.xml").write_text("<feed><entry>x</entry></feed>")
    with pytest.raises(ValueError, match="no record"):
        read_checked(spark, str(tmp_path / "c.xml"))
    (tmp_path / "d.xml").write_text("<collection/>")
    assert read_checked(spark, str(tmp_path / "d.xml")).count() == 0
