"""MARCXML text of one record to and from the MARC record column."""

from pyspark.sql import functions as F

from carrel import schemas

XML_RECORD = (
    "struct<leader:string,"
    "controlfield:array<struct<_tag:string,_VALUE:string>>,"
    "datafield:array<struct<_tag:string,_ind1:string,_ind2:string,"
    "subfield:array<struct<_code:string,_VALUE:string>>>>,"
    "_corrupt_record:string>"
)

XML_OPTIONS = {
    # Blank indicators are values, so surrounding blanks must survive.
    "ignoreSurroundingSpaces": "false",
    "ignoreNamespace": "true",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_corrupt_record",
}


def from_text(xml):
    """Parsed XML struct of one ``<record>`` element, see ``record_of``."""
    return F.from_xml(xml, XML_RECORD, XML_OPTIONS)


def record_of(parsed):
    """The MARC record column of a parsed XML struct."""
    controls = F.transform(
        parsed["controlfield"],
        lambda f: F.struct(
            f["_tag"].alias("tag"), F.coalesce(f["_VALUE"], F.lit("")).alias("value")
        ),
    )
    fields = F.transform(
        parsed["datafield"],
        lambda f: F.struct(
            f["_tag"].alias("tag"),
            f["_ind1"].alias("ind1"),
            f["_ind2"].alias("ind2"),
            F.coalesce(
                F.transform(
                    f["subfield"],
                    lambda s: F.struct(
                        s["_code"].alias("code"),
                        F.coalesce(s["_VALUE"], F.lit("")).alias("value"),
                    ),
                ),
                F.array().cast(f"array<{schemas.SUBFIELD}>"),
            ).alias("subfields"),
        ),
    )
    return F.struct(
        parsed["leader"].alias("leader"),
        F.coalesce(controls, F.array().cast(f"array<{schemas.CONTROL_FIELD}>")).alias(
            "controlfields"
        ),
        F.coalesce(fields, F.array().cast(f"array<{schemas.DATA_FIELD}>")).alias("datafields"),
    )


def escape(text):
    """Text as XML character data."""
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(plain), F.lit(entity))
    return text


def to_text(record, prefix=""):
    """One ``<record>`` element of a MARC record column, its elements with a namespace prefix or none."""
    controls = F.transform(
        record["controlfields"],
        lambda f: F.concat(
            F.lit(f'<{prefix}controlfield tag="'), f["tag"], F.lit('">'), escape(f["value"]),
            F.lit(f"</{prefix}controlfield>"),
        ),
    )

    def subfield(s):
        return F.concat(
            F.lit(f'<{prefix}subfield code="'), escape(s["code"]), F.lit('">'), escape(s["value"]),
            F.lit(f"</{prefix}subfield>"),
        )

    fields = F.transform(
        record["datafields"],
        lambda f: F.concat(
            F.lit(f'<{prefix}datafield tag="'), f["tag"],
            F.lit('" ind1="'), f["ind1"], F.lit('" ind2="'), f["ind2"], F.lit('">'),
            F.array_join(F.transform(f["subfields"], subfield), ""),
            F.lit(f"</{prefix}datafield>"),
        ),
    )
    leader = F.when(
        record["leader"].isNotNull(),
        F.concat(F.lit(f"<{prefix}leader>"), escape(record["leader"]), F.lit(f"</{prefix}leader>")),
    ).otherwise("")
    return F.concat(
        F.lit(f"<{prefix}record>"), leader, F.array_join(controls, ""), F.array_join(fields, ""),
        F.lit(f"</{prefix}record>"),
    )
