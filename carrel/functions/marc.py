"""Selecting values from a MARC record column (see ``schemas.MARC_RECORD``)."""

from pyspark.sql import functions as F

# Provider codes that get an output of their own, and the code
# for everything else.
ORDER_PROVIDERS = (
    "BLO", "BRL", "CUP", "DEG", "EBS", "ESD", "IGI", "JST",
    "KOR", "PQE", "SAG", "TAF", "UPS", "WIL", "WSC", "ZZZ",
)
FALLBACK_PROVIDER = "ZZZ"
PROVIDER_FIELD = ("961", "d")


def data_fields(record, tag, ind1=None, ind2=None):
    """All data fields with the tag, and with the indicators where given."""

    def wanted(field):
        test = field["tag"] == tag
        if ind1 is not None:
            test = test & (field["ind1"] == ind1)
        if ind2 is not None:
            test = test & (field["ind2"] == ind2)
        return test

    return F.filter(record["datafields"], wanted)


def values_of(field, code):
    """Values of one field's subfields with the code, in order."""
    hits = F.filter(field["subfields"], lambda s: s["code"] == code)
    return F.transform(hits, lambda s: F.coalesce(s["value"], F.lit("")))


def subfields_all(record, tag, ind1, ind2, code):
    """Every value of the code, repeats within one field included."""
    fields = data_fields(record, tag, ind1, ind2)
    values = F.flatten(F.transform(fields, lambda f: values_of(f, code)))
    return F.coalesce(values, F.array().cast("array<string>"))


def subfield_first(record, tag, code):
    """First value of the code over all occurrences of the tag, else ''."""
    values = F.flatten(F.transform(data_fields(record, tag), lambda f: values_of(f, code)))
    return F.coalesce(F.get(values, F.lit(0)), F.lit(""))


def first_per_field(record, tag, ind1, ind2, code):
    """At most one value per field, its first; empty and absent ones dropped."""
    firsts = F.transform(
        data_fields(record, tag, ind1, ind2), lambda f: F.get(values_of(f, code), F.lit(0))
    )
    return F.filter(firsts, lambda v: v.isNotNull() & (v != ""))


def control_field(record, tag):
    """Trimmed value of the first control field with the tag, else ''."""
    hits = F.filter(record["controlfields"], lambda f: f["tag"] == tag)
    # All white space goes, not only blanks.
    value = F.regexp_replace(F.get(hits, F.lit(0))["value"], r"(?U)^\s+|\s+$", "")
    return F.coalesce(value, F.lit(""))


def link_urls(record):
    """URLs of the 856 fields with indicators '4' and blank."""
    return subfields_all(record, "856", "4", " ", "u")


def is_single_image(record):
    """Exactly one link URL, and the resource type is 'Image'."""
    return (F.size(link_urls(record)) == 1) & (subfield_first(record, "336", "a") == "Image")


def provider_code(value, allowed=ORDER_PROVIDERS, width=3, fallback=FALLBACK_PROVIDER):
    """First characters of the value if they are an allowed code, else the fallback."""
    code = F.substring(value, 1, width)
    return F.when(code.isin(*allowed), code).otherwise(F.lit(fallback))


def route_code(record, **rule):
    """Provider code from the first $d of the *first* 961, or the fallback.

    A later 961 is never looked at, even if the first one has no $d.
    """
    tag, code = PROVIDER_FIELD
    first = F.get(data_fields(record, tag), F.lit(0))
    return provider_code(F.get(values_of(first, code), F.lit(0)), **rule)
